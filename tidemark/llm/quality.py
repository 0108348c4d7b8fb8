"""Per-document text quality statistics and the documents in their tails.

Statistics are taken from whole texts in one pass over Arrow batches. Their
distributions are kept as sketches: counts per language and bucket of fixed
width, so parts merge by addition, in any order, with an error of half a bucket.
From the sketches come each language's centre and spread, and from these a
robust z-score for every statistic of every document; documents far out in the
tail of a deciding statistic are flagged.

Junk lies on one side of such a statistic and pulls a median and quartiles along.
The reference of a language is therefore read from its upper quantiles, where
prose stands alone even if most of a language is junk, and extended downwards as
a normal distribution would be.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.worker_text import BLANK, BREAK, SYMBOL, slices, take_words
from tidemark.session import durable, small

if TYPE_CHECKING:  # loaded in the workers only
    import pyarrow as pa

#: Buckets of a sketch over [0, 1].
BUCKETS = 1000
#: Common words of English, German, Spanish and French prose, folded.
COMMON = {
    "en": "the of to and in a is that for was on are with as at by be this have it from or had not an were which their has "
    "been they would will its he she his her who what there when than could no one them said about before after more because over "
    "into we you i but if so up out all can do did yet now how most of though",
    "de": "der die das und in zu den von mit ist des im nicht ein eine als auch es an auf fur sich dass dem er sie wird aus "
    "bei nach um am sind noch wie einem uber einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde hat was "
    "etwa weil schon kaum wenn wir ich",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como mas o pero sus le ha me si sin sobre "
    "este ya entre cuando todo esta ser son dos tambien fue habia era muy hasta desde nos donde dijo antes algo porque unos nadie",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec son aux d l qu "
    "mais comme ou si leur y dont sa ses cette ont ete tout nous sans n s c elle deux meme ces avant parce selon ou je vous a dit",
}


#: The statistics of a text, in the order of the columns.
STATISTICS = ("n_words", "mean_word", "symbol_share", "end_share", "short_share", "common_share", "repeat_share")
#: A line of fewer words is short, as those of lists and tables are.
SHORT_LINE = 5


def measure(texts: list[str | None], common: list[str]) -> dict[str, object]:
    """The statistics of each text as arrays; see ``statistics``."""
    import numpy as np

    w, known = take_words(texts), take_words([" ".join(common)]).hash
    n = len(texts)

    def running(flags: np.ndarray) -> np.ndarray:
        return np.r_[0, np.cumsum(flags)]

    chars = running((w.data & 0xC0) != 0x80)
    solid = running((w.kind != BLANK) & (w.kind != BREAK))
    symbols = running(w.kind == SYMBOL)
    n_words = np.bincount(w.owner, minlength=n)
    some = np.maximum(n_words, 1)
    size = chars[w.end] - chars[w.start]
    hits = np.isin(w.hash, known) & (size > 1)
    # a text's words with its number mixed in: one sort counts the distinct words of all texts
    _, first = np.unique(w.hash * np.uint64(2) ^ (w.owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    stop = np.flatnonzero(w.kind == BREAK)
    begin = np.r_[0, stop[:-1] + 1]
    filled = solid[stop] > solid[begin]
    of_line = np.searchsorted(w.text_at, stop, side="right") - 1
    lines = np.maximum(np.bincount(of_line[filled], minlength=n), 1)
    last = np.maximum.accumulate(np.where((w.kind != BLANK) & (w.kind != BREAK), np.arange(len(w.data)), 0))
    ends = np.isin(w.data[last[stop]], np.frombuffer(b".!?:;\"')", np.uint8)) & filled
    in_line = np.searchsorted(w.start, stop) - np.searchsorted(w.start, begin)
    short = filled & (in_line < SHORT_LINE)
    per_text = w.text_at
    return {
        "n_words": n_words.astype(np.int64),
        "mean_word": np.bincount(w.owner, weights=size, minlength=n) / some,
        "symbol_share": (symbols[per_text[1:]] - symbols[per_text[:-1]]) / np.maximum(solid[per_text[1:]] - solid[per_text[:-1]], 1),
        "end_share": np.bincount(of_line[ends], minlength=n) / lines,
        "short_share": np.bincount(of_line[short], minlength=n) / lines,
        "common_share": np.bincount(w.owner[hits], minlength=n) / some,
        "repeat_share": (n_words - np.bincount(w.owner[first], minlength=n)) / some,
    }


def _measured(common: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(2).to_pylist()
            for lo, hi in slices(texts):
                found = measure(texts[lo:hi], common)
                columns = [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), *(pa.array(found[s]) for s in STATISTICS)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "lang", *STATISTICS])

    return run


def statistics(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", common: dict[str, str] = COMMON) -> DataFrame:
    """Per row: ``key, lang`` and the statistics of its whole text.

    ``n_words``, ``mean_word`` (characters), ``symbol_share`` (characters that are no
    letters, digits or blanks, among those that are no blanks), ``end_share`` (lines ending in
    punctuation), ``short_share`` (lines of fewer than ``SHORT_LINE`` words), ``common_share``
    (common words of any of the languages of ``common``, whatever ``lang`` says) and
    ``repeat_share`` (words beyond the first use of each). Words are taken without case,
    accents and invisible characters. Shares of a text without words, null texts
    included, are 0; a null language is its own group.
    """
    # Single letters are left out: broken encodings are full of them.
    listed = sorted({w for ws in common.values() for w in ws.split() if len(w) > 1})
    picked = df.select(F.col(key).alias("key"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("t"))
    kind = picked.schema["key"].dataType.simpleString()
    schema = f"key {kind}, lang string, n_words bigint, " + ", ".join(f"{s} double" for s in STATISTICS[1:])
    return picked.mapInArrow(_measured(listed), schema).withColumnRenamed("key", key)


def sketch(stats: DataFrame, names: list[str], top: dict[str, float] | None = None) -> DataFrame:
    """``(lang, stat, bucket, n)``: mergeable histograms of statistics scaled to [0, 1] by ``top``."""
    top = top or {}
    cells = F.array(
        *(F.struct(F.lit(s).alias("stat"), F.least(F.floor(F.col(s) / top.get(s, 1.0) * BUCKETS), F.lit(BUCKETS)).cast("int").alias("bucket")) for s in names)
    )
    return stats.select("lang", F.explode_outer(cells).alias("c")).groupBy("lang", "c.stat", "c.bucket").agg(F.count(F.lit(1)).alias("n"))


def merge_sketches(a: DataFrame, b: DataFrame) -> DataFrame:
    """The sketch of both parts."""
    return a.unionByName(b).groupBy("lang", "stat", "bucket").agg(F.sum("n").alias("n"))


def spreads(sketched: DataFrame, top: dict[str, float] | None = None, marks: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``(lang, stat, total, median, spread, q)`` from a sketch.

    ``q`` is the array of the quantiles ``marks``; ``spread`` is half the distance of
    the quartiles over 0.6745, the standard deviation of a normal distribution with them.
    """
    w = Window.partitionBy("lang", "stat").orderBy("bucket")
    # At most BUCKETS + 1 rows stand in a group, however many documents it has.
    run = sketched.withColumn("upto", F.sum("n").over(w)).withColumn("total", F.sum("n").over(Window.partitionBy("lang", "stat")))

    def at(share: float) -> Column:
        return F.min(F.when(F.col("upto") >= share * F.col("total"), F.col("bucket"))) / BUCKETS

    scale = F.create_map(*(F.lit(x) for k, v in (top or {"": 1.0}).items() for x in (k, v)))
    unit = F.coalesce(F.try_element_at(scale, F.col("stat")), F.lit(1.0))
    got = run.groupBy("lang", "stat").agg(F.max("total").alias("total"), at(0.5).alias("m"), at(0.25).alias("lo"), at(0.75).alias("hi"), F.array(*map(at, marks)).alias("q"))
    return got.select(
        "lang", "stat", "total", (F.col("m") * unit).alias("median"), ((F.col("hi") - F.col("lo")) * unit / 2 / 0.6745).alias("spread"),
        F.transform("q", lambda x: x * unit).alias("q"),
    )


#: Upper ends of sketches of statistics that are no shares; numbers of words are sketched and scored by their logarithm.
SCALES = {"mean_word": 50.0, "n_words": 25.0}
#: The deciding statistics, high in prose: how far below prose a document must lie, and the least spread of prose to reckon
#: with (documents that agree closer repeat each other's sentences).
TAILS = {"common_share": (-4.5, 0.045)}
#: Quantiles that prose reaches alone, and where they lie in a normal distribution.
UPPER = (0.9, 0.97)
_LOW, _HIGH = 1.2816, 1.8808
#: Documents of all languages that stand in for a language with few of its own.
PRIOR = 50.0


def _scored(stats: DataFrame) -> DataFrame:
    return stats.withColumn("n_words", F.log1p("n_words"))


def references(sketched: DataFrame) -> DataFrame:
    """``(lang, stat, centre, spread)`` of the languages of a sketch.

    For statistics that decide nothing, median and spread of the quartiles. For
    ``TAILS``, centre and spread of the normal distribution through the quantiles
    ``UPPER``, drawn towards that of all languages together by ``PRIOR`` documents;
    a language whose centre lies in the tail of all languages has next to no prose
    of its own and is measured by them. A language of few turns of phrase agrees closely
    with itself: its spread is taken as that of all languages at least. Other spreads
    are two buckets at least.
    """
    every = sketched.withColumn("lang", F.lit("*")).groupBy("lang", "stat", "bucket").agg(F.sum("n").alias("n"))

    def upper(df: DataFrame) -> DataFrame:
        s = (F.col("q")[1] - F.col("q")[0]) / (_HIGH - _LOW)
        return df.withColumn("up_spread", s).withColumn("up_centre", F.col("q")[0] - _LOW * s)

    per = upper(spreads(sketched, SCALES, UPPER))
    whole = upper(spreads(every, SCALES, UPPER)).select("stat", F.col("up_centre").alias("all_centre"), F.col("up_spread").alias("all_spread"))
    scale = F.create_map(*(F.lit(x) for s in STATISTICS for x in (s, TAILS[s][1] if s in TAILS else 2.0 * SCALES.get(s, 1.0) / BUCKETS)))
    floor = F.try_element_at(scale, F.col("stat"))
    decides = F.col("stat").isin(list(TAILS))
    share = F.col("total") / (F.col("total") + PRIOR)
    joined = per.join(F.broadcast(whole), "stat")  # one row a statistic
    centre = share * F.col("up_centre") + (1 - share) * F.col("all_centre")
    spread = F.greatest(share * F.col("up_spread") + (1 - share) * F.col("all_spread"), F.col("all_spread"), floor)
    depth = F.try_element_at(F.create_map(*(F.lit(x) for s, (t, _) in TAILS.items() for x in (s, t))), F.col("stat"))
    lost = decides & (centre < F.col("all_centre") + depth * F.greatest(F.col("all_spread"), floor))
    return joined.select(
        "lang",
        "stat",
        F.when(lost, F.col("all_centre")).when(decides, centre).otherwise(F.col("median")).alias("centre"),
        F.when(lost, F.greatest("all_spread", floor)).when(decides, spread).otherwise(F.greatest("spread", floor)).alias("spread"),
    )


def flags(stats: DataFrame, sketched: DataFrame | None = None) -> DataFrame:
    """``stats`` with ``z_<stat>`` for each of ``STATISTICS`` and ``junk``.

    A document is junk if a statistic of ``TAILS`` lies further below its language's
    prose than the tail's depth. Other scores are reported. ``sketched`` may hold
    the sketches of other parts too (``merge_sketches``); by default the rows of
    ``stats`` are sketched. An empty table gives an empty result.
    """
    sketched = durable(sketched if sketched is not None else sketch(_scored(stats), list(STATISTICS), SCALES))
    wide = references(sketched).groupBy("lang").agg(
        *(F.max(F.when(F.col("stat") == s, F.col(c))).alias(f"{c}_{s}") for s in STATISTICS for c in ("centre", "spread"))
    )
    ref = wide.withColumnRenamed("lang", "ref_lang")
    joined = stats.join(small(ref), F.col("lang").eqNullSafe(F.col("ref_lang")))
    value = {s: F.log1p(s) if s == "n_words" else F.col(s) for s in STATISTICS}
    out = joined.select(stats["*"], *(((value[s] - F.col(f"centre_{s}")) / F.col(f"spread_{s}")).alias(f"z_{s}") for s in STATISTICS))
    junk = F.lit(False)
    for s, (depth, _) in TAILS.items():
        junk = junk | (F.col(f"z_{s}") < depth)
    return out.withColumn("junk", junk)
