"""Quality: statistics of known texts, prose in four languages and layouts against lists, tables and junk; sketches merge."""

from pyspark.sql import functions as F

from tidemark.llm.quality import STATISTICS, flags, merge_sketches, references, sketch, spreads, statistics

PROSE = {
    "en": "The board of the company said on Monday that it had not yet decided what would happen to the plant, and most of them doubt it.",
    "de": "Die Behörde in der Stadt sagte am Mittwoch, dass etwa 574 Stellen wegfallen und dass die Gespräche mit dem Werk weitergehen.",
    "es": "El regulador de la ciudad dijo el martes que el coste de la planta ha subido un 3 por ciento y que las conversaciones siguen.",
    "fr": "Le régulateur de la ville a dit dans une lettre que le coût de la mine a augmenté et que les discussions avec elle continuent.",
}
JUNK = [
    "Alpha 12.5 88.1\n" * 12,
    "| name | open | close |\n|---|---|---|\n" + "| Zed | 1.5 | 2.5 |\n" * 9,
    "Home · Help · Log in · Markets · Help · Video · Share · Log in · Home · Help",
    "0p6wd6H+hkixORCuk+XCsGkHD2vJrSeYKOT9DgI\n" * 8,
    "qhegjg agesdw heeda sql qje glldjh kqahsedjk fgwqwgg ldedfflkfs djlkgdgkk",
    "Regulator fines Zed 432 million over the unit in Lugera\n" + "- Kikuth venture revenue\n" * 20,
    "Zed revenue Skadal !! " * 30,
    "",
    "   ",
    "!!! ??? ---",
]
GOOD = [
    *PROSE.values(),
    "Headline without much in it\n\n" + PROSE["en"] + "\n" + PROSE["en"],
    PROSE["en"].upper(),
    "\n".join(PROSE["en"][i : i + 60] for i in range(0, len(PROSE["en"]), 60)),
    PROSE["fr"] * 3 + "\n- one\n- two\n- three\n" + PROSE["fr"],
    PROSE["en"] * 2000,
]


def docs(spark):
    labels = ["en", "de", "es", "fr", "en", "en", None, "fr", "en"]
    rows = [(100 * k + i, t, labels[i]) for k in range(60) for i, t in enumerate(GOOD[:-1])] + [(8, GOOD[-1], "en")]
    rows += [(10_000 + i, t, [*PROSE, None][i % 5]) for i, t in enumerate(JUNK)] + [(20_000, None, "en"), (0, GOOD[0], "en")]
    clash = {"n_words": F.lit(-1), "common_share": F.lit(0.5), "t": F.lit("x"), "key": F.lit(1)}
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns(clash)


def test_prose_and_junk(spark):
    out = flags(statistics(docs(spark))).collect()
    assert {r.doc_id for r in out if r.junk} == {*range(10_000, 10_000 + len(JUNK)), 20_000}
    assert len(out) == docs(spark).count()


def test_languages_with_much_junk(spark):
    # a third, a half and nearly all of a language is junk
    rows = [(lang, i < bad, "" if i % 2 else JUNK[0]) for lang, bad, n in (("en", 4, 12), ("de", 6, 12), ("es", 11, 12)) for i in range(n)]
    data = [(i, text if bad else PROSE[lang], lang) for i, (lang, bad, text) in enumerate(rows)]
    out = flags(statistics(spark.createDataFrame(data, "doc_id long, text string, lang string"))).collect()
    assert {r.doc_id for r in out if r.junk} == {i for i, (_, bad, _) in enumerate(rows) if bad}


def test_every_statistic_is_scored(spark):
    rows = [(i, PROSE["en"] * (1 + i % 7), "en") for i in range(70)] + [(100, "!!! ??? ---", "en"), (101, "w" * 70, "en"), (102, PROSE["en"] * 3000, "en")]
    out = {r.doc_id: r for r in flags(statistics(spark.createDataFrame(rows, "doc_id long, text string, lang string"))).collect()}
    names = STATISTICS
    assert all(out[i][f"z_{s}"] is not None for i in out for s in names)
    assert out[100].z_symbol_share > 5 and out[101].z_mean_word > 5 and out[102].z_n_words > 5 and out[100].z_n_words < -5
    median = sorted(r.mean_word for r in out.values())[len(out) // 2]
    assert all(abs(r.z_mean_word) < 1 for r in out.values() if abs(r.mean_word - median) < 0.05)


def test_statistics(spark):
    df = spark.createDataFrame([(1, "The cat, the dog!\nno end", "en"), (2, None, None)], "doc_id long, text string, lang string")
    a, b = sorted(statistics(df).collect(), key=lambda r: r.doc_id)
    assert a.n_words == 6 and abs(a.mean_word - 17 / 6) < 1e-9 and a.end_share == 0.5
    assert abs(a.symbol_share - 2 / 19) < 1e-9 and abs(a.common_share - 3 / 6) < 1e-9 and abs(a.repeat_share - 1 / 6) < 1e-9
    assert b.n_words == 0 and b.common_share == 0.0 and a.short_share == 1.0 and b.symbol_share == 0.0
    assert flags(statistics(df.limit(0))).count() == 0


def test_sketches_decide(spark):
    # the same text is junk in a language of dense prose and none in one of sparse prose: only the sketches differ
    dense, sparse = [0.5 + i / 10_000 for i in range(400)], [0.2 + i / 10_000 for i in range(400)]
    base = {"n_words": 100, "mean_word": 5.0, "symbol_share": 0.02, "end_share": 1.0, "short_share": 0.0, "repeat_share": 0.3}
    rows = [(i, lang, x, *base.values()) for lang, xs in (("a", dense), ("b", sparse)) for i, x in enumerate([*xs, 0.19])]
    stats = spark.createDataFrame(rows, ["doc_id", "lang", "common_share", *base])
    own = {lang: {r.doc_id for r in flags(stats.filter(F.col("lang") == lang)).collect() if r.junk} for lang in "ab"}
    assert own == {"a": {400}, "b": set()}


def test_a_language_of_mostly_junk(spark):
    # nine in ten Spanish documents are junk: its own distribution says nothing about prose, that of all languages does
    rows = [(i, PROSE["en"] + f" {i}", "en") for i in range(300)] + [(1000 + i, JUNK[i % 6], "es") for i in range(180)]
    rows += [(2000 + i, PROSE["es"] + f" {i}", "es") for i in range(20)]
    out = flags(statistics(spark.createDataFrame(rows, "doc_id long, text string, lang string"))).collect()
    assert {r.doc_id for r in out if r.junk} == set(range(1000, 1180))
    ref = references(sketch(statistics(spark.createDataFrame(rows, "doc_id long, text string, lang string")), ["common_share"]))
    assert {r.lang: round(r.centre, 2) > 0.3 for r in ref.collect()} == {"en": True, "es": True}


def test_sketches_merge_and_bound_the_error(spark):
    df = spark.range(1000).selectExpr("id", "'en' lang", "(id / 1000.0) * (id / 1000.0) x")
    whole = sketch(df, ["x"])
    parts = merge_sketches(sketch(df.filter("id % 3 = 0"), ["x"]), sketch(df.filter("id % 3 != 0"), ["x"]))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))
    r = spreads(whole).first()
    assert abs(r["median"] - 0.25) < 0.002 and abs(r["spread"] - (0.5625 - 0.0625) / 2 / 0.6745) < 0.003
