"""Evaluation texts leaking into training text.

A leak is a run of at least ``width`` words of a test item inside a document: the
word shingles of that run are contained in the document. Test items are short
and documents long, so a MinHash of whole texts would see nothing of it. Both
sides are therefore partitioned by size: every text is cut into sets of one size,
the shingles of ``width`` words, and texts are searched in classes of similar
length, the longest in overlapping pieces. Each set has one MinHash, the least of
its shingles' hashes; equal sets have equal minima, and a text's distinct minima
are a sketch that grows with its size. Documents whose sketch meets an item's
are candidates, and a candidate is verified by exact containment of the shingles.

Documents are read once, in Arrow batches. A bit map of the items' minima, of
fixed size, goes to the workers; only sets whose minimum it knows leave them, so
no text is ever shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.worker_text import mix, slices, take_words
from tidemark.session import durable, small

if TYPE_CHECKING:  # loaded in the workers only
    import numpy as np
    import pyarrow as pa

SHINGLE = 5
#: Words of a piece of a long text.
PIECE = 65_536
#: Bits of the map of the items' minima (2 MB), whatever the number of items.
MAP_BITS = 1 << 24


def size_classes(n_words: np.ndarray) -> np.ndarray:
    """Classes of texts of similar length: each holds texts up to four times as long as the one before."""
    import numpy as np

    return np.ceil(np.log2(np.maximum(n_words, 1)) / 2).astype(np.int64)


def shingle_hashes(hashes: np.ndarray, shingle: int) -> np.ndarray:
    """A mixed 64-bit hash of each run of ``shingle`` word hashes."""
    import numpy as np

    n = len(hashes) - shingle + 1
    out = np.zeros(n, np.uint64)
    for j in range(shingle):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n]
    return mix(out)


def set_minima(hashes: np.ndarray, width: int, shingle: int) -> np.ndarray:
    """MinHash of the shingles of each run of ``width`` words."""
    import numpy as np

    h = shingle_hashes(hashes, shingle)
    per = width - shingle + 1
    n = len(h) - per + 1
    least = h[:n].copy()
    for j in range(1, per):
        np.minimum(least, h[j : j + n], out=least)
    return least


def _scan(width: int, shingle: int, known: bytes | None):
    """Rows ``(key, m, span)`` of the sets of each text; with ``known``, only those whose minimum is in the map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa

        bits = None if known is None else np.frombuffer(known, np.uint8)

        def found(rows: np.ndarray, texts: list[str | None]) -> tuple[list[int], list[int], list[str]]:
            w = take_words(texts)
            at, minima, spans = [], [], []
            # The texts of one size class are one block of sets.
            n_words = np.bincount(w.owner, minlength=len(texts))
            classes = size_classes(n_words)
            for c in np.unique(classes[n_words >= width]):
                of_class = np.flatnonzero(classes[w.owner] == c)
                owner = w.owner[of_class]
                if len(of_class) < width:
                    continue
                for lo in range(0, len(of_class) - width + 1, PIECE):
                    piece = slice(lo, lo + PIECE + width - 1)
                    mine, who = of_class[piece], owner[piece]
                    least = set_minima(w.hash[mine], width, shingle)
                    ok = who[: len(least)] == who[width - 1 :]
                    if bits is not None:
                        slot = (least & np.uint64(len(bits) * 8 - 1)).astype(np.int64)
                        ok &= (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
                    hits = np.flatnonzero(ok)
                    at += rows[who[hits]].tolist()
                    minima += least[hits].view(np.int64).tolist()
                    for p in hits.tolist():
                        words = (w.data[w.start[i] : w.end[i]].tobytes() for i in mine[p : p + width])
                        spans.append(b" ".join(words).decode())
            return at, minima, spans

        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for lo, hi in slices(texts):
                at, minima, spans = found(np.arange(lo, hi), texts[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(at, pa.int64())), pa.array(minima, pa.int64()), pa.array(spans, pa.string())], ["key", "m", "span"]
                )

    return run


def _sets(df: DataFrame, key: str, text: str, width: int, shingle: int, known: bytes | None = None) -> DataFrame:
    picked = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("t"))
    kind = picked.schema["key"].dataType.simpleString()
    return picked.mapInArrow(_scan(width, shingle, known), f"key {kind}, m bigint, span string")


def minima_map(minima: Column, sets: DataFrame, bits: int = MAP_BITS) -> bytes:
    """A bit map of ``bits`` bits in which the low bits of every minimum are set; its size does not depend on the data."""
    import numpy as np

    slot = minima.bitwiseAND(F.lit(bits - 1)) + 1
    parts = sets.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    # At most bits / 32768 rows of 4 KB.
    for row in parts.collect():
        at = (row.bucket - 1) * 4096
        out[at : at + len(row.bits)] = np.frombuffer(bytes(row.bits), np.uint8)
    return out.tobytes()


def leaks(
    docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text", width: int = 13, shingle: int = SHINGLE
) -> DataFrame:
    """``(doc_key, item_key)`` of every document that holds ``width`` consecutive words of an item.

    A word is a run of letters and digits; case, accents, punctuation, spacing
    and invisible characters do not count. Texts that are null, empty or shorter
    than ``width`` words on either side match nothing. A document or item given
    several times counts once. Whole texts are compared, however long. The items'
    sets are sent to all executors if they are within the size limit; otherwise
    the sets that the map lets through are joined to them by a shuffle.
    """
    held = durable(_sets(items, item_key, text, width, shingle).distinct())
    known = minima_map(F.col("m"), held)
    met = _sets(docs, doc_key, text, width, shingle, known)
    right = held.select(F.col("key").alias("item"), F.col("m").alias("m_b"), F.col("span").alias("span_b"))
    # Equal spans hold the same shingles in the same order: the exact check of containment.
    proved = met.join(small(right), (F.col("m") == F.col("m_b")) & (F.col("span") == F.col("span_b")))
    return proved.select(F.col("key").alias(doc_key), F.col("item").alias(item_key)).distinct()
