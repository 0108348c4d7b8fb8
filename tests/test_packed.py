"""Packed fields: every delimiter, quoting, escapes, blanks, and the placeholder characters themselves."""

import pytest

from tidemark.operators.packed import ADDRESS_DELIMITERS, TEXT_DELIMITERS, unpack

TEXT = [
    ("a|b", ["a", "b"]),
    (" a ; b ;", ["a", "b"]),
    ("|a||b", ["a", "b"]),
    ("a｜b", ["a", "b"]),
    ("a\r\nb\n", ["a", "b"]),
    ("a\tb • c", ["a", "b", "c"]),
    ("a // b / c", ["a", "b", "c"]),
    (" // a // b", ["a", "b"]),
    ("either/or, still one", ["either/or, still one"]),
    ('"a, b","c | d"', ["a, b", "c | d"]),
    ('"a" "b"', ["a", "b"]),
    ('"""Q"" row: x; y"; plain z; "w"', ['"Q" row: x; y', "plain z", "w"]),
    ('["x \\"q\\" \\u2018y\\u2019", "z|w"]', ['x "q" ‘y’', "z|w"]),
    ('["only"]', ["only"]),
    ("[]", []),
    ('open " quote | b', ['open " quote', "b"]),
    ("nan", []),
    (" NaN ", []),
    ("", []),
    ("    ", []),
    (None, []),
    ("a|a", ["a", "a"]),
    ('xy|"p|q"', ['xy', '"p|q"']),
    ("x" * 100_000 + "|" + "y", ["x" * 100_000, "y"]),
]
SITES = [
    ("https://a.b/c/d, www.e.f", ["https://a.b/c/d", "www.e.f"]),
    ("a.b and c.d and e.f", ["a.b", "c.d", "e.f"]),
    (" and a.b and c.d", ["a.b", "c.d"]),
    ("a.b / c.d // e.f", ["a.b", "c.d", "e.f"]),
    ("a.b||c.d；e.f\ng.h", ["a.b", "c.d", "e.f", "g.h"]),
    ('"https://a.b/q 1|2,3","c.d"', ["https://a.b/q 1|2,3", "c.d"]),
    ('"https://a.b/x y", c.d', ["https://a.b/x y", "c.d"]),
    ("brandand.example", ["brandand.example"]),
]


@pytest.mark.parametrize("cells,delimiters", [(TEXT, TEXT_DELIMITERS), (SITES, ADDRESS_DELIMITERS)])
def test_values_and_places(spark, cells, delimiters):
    rows = [(i, c) for i, (c, _) in enumerate(cells)]
    df = spark.createDataFrame(rows, "id int, cell string")
    got = {}
    for r in unpack(df, "id", "cell", delimiters).collect():
        got.setdefault(int(r.row_key), []).append((r.pos, r.val))
    for i, (cell, want) in enumerate(cells):
        found = sorted(got.get(i, []))
        assert [v for _, v in found] == want, (cell or "")[:80]
        assert [p for p, _ in found] == list(range(len(want)))


def test_repeats_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a|b", "x"), (1, "a|b", "y")], "id int, cell string, val string")
    df = df.withColumnsRenamed({"val": "val"}).withColumn("pos", df.id).withColumn("row_key", df.id).withColumn("field_name", df.cell)
    assert unpack(df, "id", "cell").count() == 4
    assert unpack(df.limit(0), "id", "cell").count() == 0
    assert unpack(df.selectExpr("cast(null as int) id", "cell"), "id", "cell").filter("row_key is null").count() == 4
