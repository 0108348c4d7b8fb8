"""Leaks against brute force over words; invisible characters, accents, long texts, nulls."""

import random
import re
import unicodedata

from pyspark.sql import functions as F

from tidemark.llm import leakage
from tidemark.llm.leakage import leaks


def words(text):
    text = unicodedata.normalize("NFKD", text.casefold())
    text = "".join(c for c in text if not unicodedata.combining(c) and unicodedata.category(c) != "Cf")
    return re.findall(r"[^\W_]+", text)


def brute(docs, items, width):
    grams = {}
    for i, t in items:
        w = words(t or "")
        for j in range(len(w) - width + 1):
            grams.setdefault(tuple(w[j : j + width]), set()).add(i)
    return {(d, i) for d, t in docs for w in [words(t or "")] for j in range(len(w) - width + 1) for i in grams.get(tuple(w[j : j + width]), ())}


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(leakage, "PIECE", 40)
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(60)] + ["Énergie", "Straße", "naïve", "x1"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(5, 50)))) for i in range(12)]
    docs = []
    for d in range(60):
        body = [rng.choice(vocab) for _ in range(rng.randrange(0, 200))]
        if d % 2:
            src = items[d % 12][1].split()
            n = rng.choice([12, 13, 14, 30])
            at = rng.randrange(0, max(1, len(src) - n + 1))
            cut = [w.upper() if rng.random() < 0.3 else w for w in src[at : at + n]]
            sep = rng.choice([" ", ", ", "\n", " ​", "­ "])
            body[len(body) // 2 : len(body) // 2] = sep.join(cut).replace("É", "E").split(" ")
        docs.append((d, " ".join(body)))
    docs += [(900, None), (901, ""), (902, " ".join(["noise"] * 5000) + " " + items[0][1] + " " + items[1][1]), (902, "again")]
    items += [(50, None), (51, ""), (52, "too short")]
    ddf = spark.createDataFrame(docs, "doc_id int, text string").withColumns({"key": F.lit(1), "w": F.lit("x"), "m": F.lit(3)})
    idf = spark.createDataFrame(items, "item_id int, text string").withColumn("item", F.lit(0))
    got = {tuple(r) for r in leaks(ddf, idf).collect()}
    assert got == brute(docs, items, 13)
    assert leaks(ddf.limit(0), idf).count() == 0 and leaks(ddf, idf.limit(0)).count() == 0
