"""Schema drift: each kind of change, case, nulls, broken lines, and the unified table."""

import json

import pandas as pd

from tidemark.operators.drift import LEAST_SCORE, flood, schema_changes, unified


def files(spark, *contents):
    rows = []
    for i, lines in enumerate(contents):
        for n, line in enumerate(lines):
            rows.append((i + 1, "f", 1, f"2025-01-{i + 1:02d}", n, line if isinstance(line, str) else json.dumps(line)))
    df = spark.createDataFrame(rows, "file_id long, feed string, stream int, d string, line_no int, payload string")
    return df.selectExpr("file_id", "feed", "stream", "cast(d as date) file_date", "line_no", "payload", "1 as field", "2 as kind")


def lines(count, /, **extra):
    return [{"url": f"u{i}", **{k: v(i) for k, v in extra.items()}} for i in range(count)]


def test_changes(spark):
    a = lines(6, topic=lambda i: f"t{i}", n=lambda i: i, flag=lambda i: True)
    b = lines(6, Theme=lambda i: f"t{i}", N=lambda i: str(i), extra=lambda i: [i])
    c = lines(6, theme=lambda i: {"name": f"t{i}"}, n=lambda i: None if i else "0", extra=lambda i: [i])
    got = {tuple(r) for r in schema_changes(files(spark, a, b, ["not json", "[1]", *c])).collect()}
    assert got == {
        (2, "renamed", "theme", "topic"),
        (2, "retyped", "n", ""),
        (2, "added", "extra", ""),
        (2, "removed", "flag", ""),
        (3, "retyped", "theme", ""),
    }


def test_equal_values_by_chance_are_told_apart_by_name(spark):
    a = lines(8, neg=lambda i: i % 3, neutral=lambda i: i % 3)
    b = lines(8, negatives=lambda i: i % 3, neutral_count=lambda i: i % 3)
    got = {tuple(r) for r in schema_changes(files(spark, a, b)).collect()}
    assert got == {(2, "renamed", "negatives", "neg"), (2, "renamed", "neutral_count", "neutral")}


def test_no_common_lines_and_empty(spark):
    a = lines(4, x=lambda i: i)
    b = [{"url": f"w{i}", "y": i} for i in range(4)]
    assert {r.change_kind for r in schema_changes(files(spark, a, b)).collect()} == {"added", "removed"}
    assert schema_changes(files(spark, a).limit(0)).count() == 0
    assert schema_changes(files(spark, a, ["{", "null"])).count() == 0


def test_unified(spark):
    a = lines(5, topic=lambda i: f"t{i}", n=lambda i: i)
    b = lines(5, theme=lambda i: {"name": f"t{i}"}, n=lambda i: str(i), other=lambda i: "o")
    c = lines(5, theme=lambda i: f"t{i}", n=lambda i: "many")
    b2 = [dict(x, theme=f"t{i}") for i, x in enumerate(b)]
    got = unified(files(spark, a, b2, b, c), {"topic": "string", "n": "bigint"}).orderBy("file_id", "line_no").collect()
    assert [r.topic for r in got] == [f"t{i}" for i in range(5)] * 4
    assert [r.n for r in got[:15]] == list(range(5)) * 3 and {r.n for r in got[15:]} == {None}
    assert got[6].extra["other"] == "o"


def pairs(*rows):
    """(old name, new name, old kind, new kind, old nested, new nested, agreement)"""
    return pd.DataFrame(rows, columns=["old_name", "field_name", "old_kind", "new_kind", "old_nested", "new_nested", "agree"])


def test_flooding_prefers_like_names():
    s = flood(pairs(*[(a, b, "number", "number", None, None, 0.9) for a in ("neg", "neutral") for b in ("negatives", "neutral_count")]))
    assert s[0] > s[1] and s[3] > s[2] and max(s) < 1


def test_flooding_spreads_over_kinds_and_nested_names():
    lone = flood(pairs(("a", "zz", "object", "object", None, None, None)))[0]
    # nested names that match lift a pair about whose values nothing is known
    assert flood(pairs(("a", "zz", "object", "object", ["id", "label"], ["id", "label"], None)))[0] >= LEAST_SCORE > lone
    # a pair of the same kinds that agrees lifts its neighbour through the node of their kinds
    beside = flood(pairs(("a", "zz", "object", "object", None, None, None), ("b", "b2", "object", "object", None, None, 1.0)))[0]
    assert beside > lone
    # the agreement of one stray line is not enough, disagreement outweighs a like name
    assert flood(pairs(("a", "zz", "string", "string", None, None, 0.5)))[0] < LEAST_SCORE
    assert flood(pairs(("theme", "themes", "string", "string", None, None, 0.0)))[0] < LEAST_SCORE


def test_flooding_decides(spark, monkeypatch):
    # no line is in both files: only names and kinds, settled by flooding, tell the rename from the loss
    a = lines(4, headline_topic=lambda i: f"t{i}", n=lambda i: i)
    b = [{"url": f"w{i}", "headline_topics": f"s{i}", "q": [i]} for i in range(4)]
    want = {(2, "renamed", "headline_topics", "headline_topic"), (2, "removed", "n", ""), (2, "added", "q", "")}
    assert {tuple(r) for r in schema_changes(files(spark, a, b)).collect()} == want
    # without the flooded score nothing is renamed
    assert {r.change_kind for r in schema_changes(files(spark, a, b), least=2.0).collect()} == {"removed", "added"}


def test_few_common_lines(spark):
    a = lines(2, topic=lambda i: f"t{i}")
    b = lines(2, zzz=lambda i: f"t{i}") + [{"url": f"w{i}", "zzz": "x"} for i in range(5)]
    assert {tuple(r) for r in schema_changes(files(spark, a, b)).collect()} == {(2, "renamed", "zzz", "topic")}


def test_clashing_names_and_lines_without_key(spark):
    a = [{"Url": "u", "url": "v", "A": 1, "a": 2}, {"x": 1}, {"x": 2}]
    b = [{"url": "v", "A": 1, "y": 1}, {"y": 1}, {"y": None}]
    got = schema_changes(files(spark, a, b)).collect()
    assert {r.change_kind for r in got} <= {"removed", "added", "renamed"} and got
    assert unified(files(spark, a, b), {"a": "bigint"}).count() == 6
