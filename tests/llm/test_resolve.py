"""Typed names to entries: every way of typing, ties, unmatched values, and the edit distance by brute force."""

from pyspark.sql import functions as F

from tidemark.llm.catalog import HABITS
from tidemark.llm.resolve import deletions, one_edit, resolve_values

ENTRIES = [
    ("1", "Drastilimir & Sons", "DRST", ["drastilimirgroup.example"]),
    ("2", "Brujemura Hospitality", "BRJM", ["brujemurahos.test"]),
    ("3", "Brujemura Technologies", "BURMW", None),
    ("4", "Skestisen", "SKST", ["skestisen-careers.example"]),
    ("5", "Kugoskedek Energy Limited", None, []),
    ("6", "Zobripedan Software", "ZBRP", ["zobripedan.example"]),
]
VALUES = {
    "drastilimir & sons": "1",
    "DRATSILIMIR & Sons Ltd": "1",
    "Drastilimir and Sons": "1",
    "Drastilimir": "1",
    "“Drastilimir + Sons”": "1",
    "Kito Tabralis (DRASTILIIR & Sons Inc.)": "1",
    "$DRST": "1",
    "NXE: DRST": "1",
    "DRST.QX": "1",
    "(DRST) share price today": "1",
    "drst": "",
    "https://www.drastilimir.example": "1",
    "drastilimirgroup.example/": "1",
    "Brujemura": "",
    "Brujemura Hosp.": "2",
    "Brujemura Tech": "3",
    "Hospitality, Brujemura": "2",
    "brujemurahos.example": "2",
    "https://www.brujemuratec.example ceo Hir Zurodan": "3",
    "Ｓｋｅｓｔｉｓｅｎ news": "4",
    "Skéstísén": "4",
    "SkestisenGroup": "4",
    "Energy of Kugoskedek lawsuit 2025": "5",
    "Kugoskedek_Energy": "5",
    "KugoskedekEnergy": "5",
    "zOBRIPEDAN sOFTWARE": "6",
    "Vivutrobel Retail": "",
    "TBD": "",
    "-": "",
    "x" * 20_000: "",
}


def table(spark, rows):
    return spark.createDataFrame(rows, "id string, name string, ticker string, hosts array<string>")


def test_values(spark):
    df = spark.createDataFrame([(v,) for v in [*VALUES, *VALUES, None, "", "  "]], "value string").withColumn("entry", F.lit("clash"))
    people = spark.createDataFrame([("Kito Tabralis",), ("Hir Zurodan",), (None,)], "name string")
    got = {r.value: r.entry for r in resolve_values(df, table(spark, ENTRIES), people, HABITS).collect()}
    assert {v: got.get(v) for v in VALUES} == VALUES
    assert len(got) == len(VALUES)


def test_two_entries_one_edit_away(spark):
    entries = table(spark, [("1", "Malotek Bank", None, None), ("2", "Malorek Bank", None, None)])
    df = spark.createDataFrame([("Malobek Bank",), ("Malotek Bnak",)], "value string")
    got = {r.value: r.entry for r in resolve_values(df, entries).collect()}
    assert got == {"Malobek Bank": "", "Malotek Bnak": "1"}
    assert resolve_values(df.limit(0), entries).count() == 0
    assert {r.entry for r in resolve_values(df, entries.limit(0)).collect()} == {""}


def edits(word, alphabet="ab"):
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    out = {word} | {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in alphabet}
    out |= {a + c + b[1:] for a, b in cuts if b for c in alphabet} | {a + b[1] + b[0] + b[2:] for a, b in cuts if len(b) > 1}
    return out


def test_one_edit_is_what_deletions_reach(spark):
    words = [w for n in range(1, 6) for w in ("".join(p) for p in __import__("itertools").product("ab", repeat=n))]
    pairs = [(a, b) for a in words[::3] for b in words]
    df = spark.createDataFrame(pairs, "a string, b string")
    meet = F.arrays_overlap(deletions(F.col("a")), deletions(F.col("b")))
    for r in df.select("a", "b", one_edit(F.col("a"), F.col("b")).alias("near"), meet.alias("meet")).collect():
        assert r.near == (r.b in edits(r.a)), (r.a, r.b)
        assert r.meet or not r.near
