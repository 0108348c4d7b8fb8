"""Reference operators on small rows, one check for each rule that the tables do not show."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.functions import casts, names, series, urls, vader
from tidemark.operators import events, features, merge, resolve
from tidemark.plans import rules, selection
from tidemark.sources import readers, writers


def one(spark, fn, *values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_names(spark):
    assert one(spark, names.ingest_key, "AT&T Inc.", "Foo.com", None, "") == ["at and t inc", "foo", "", ""]
    assert one(spark, names.ingest_simple, "The Foo Holdings Co", "Insurance Co") == ["foo", ""]
    assert one(spark, names.feature_key, "Foo Inc. Corp.", "Coca-Cola Company") == ["foo inc", "cocacola"]
    assert one(spark, names.serp_brand_key, "Coca-Cola & Co.") == ["cocacola and co"]
    assert one(spark, names.serp_ceo_simple, "Foo AG Group") == ["foo"]
    assert one(spark, names.aggregate_key, "Foo Inc. Co", "Foo Co Inc.", "nan", "A.B. Corp") == ["Foo Inc", "Foo", "", "AB"]
    assert one(spark, lambda c: names.aggregate_key(c, {"pge": "Pacific Gas Company"}), "PGE") == ["Pacific Gas"]
    assert one(spark, names.alert_key, "Foo Group", "Foo Holdings Inc") == ["Foo", "Foo Holdings"]
    assert one(spark, lambda c: names.handle_tokens(c, person=True), "Ada M. Lovelace") == [["ada", "adam", "adamlovelace", "lovelace", "mlovelace"]]
    assert one(spark, names.split_alias, "a | b;;c|", None) == [["a", "b", "c"], []]
    assert one(spark, names.headline_cut, "x" * 81, "x" * 80) == ["x" * 77 + "...", "x" * 80]


def test_urls(spark):
    cases = {
        "HTTPS://www.A.com//x//y?b=2&a=1&utm_source=q#f": "https://a.com/x/y?a=1&b=2",
        "http://h.com/url?q=https%3A%2F%2Fwww.b.com%2Fz%3Fgclid%3D1": "https://b.com/z",
        "https://a.com/p?x=a b~*": "https://a.com/p?x=a+b~%2A",
        "": "",
    }
    assert one(spark, urls.normalize, *cases) == list(cases.values())
    assert one(spark, lambda c: urls.normalize(urls.normalize(c)), *cases) == list(cases.values())
    assert one(spark, urls.host, "https://www.m.A.com:80/x", "nothing", None) == ["m.a.com", "", ""]
    assert one(spark, urls.domains_of, "a.com|http://www.b.com/x|nan|c", None) == [["a.com", "b.com"], []]
    assert one(spark, urls.url_hash, "", None) == ["", ""]


def test_casts(spark):
    assert one(spark, casts.to_bool, "Yes", "0", None) == [True, False, False]
    assert one(spark, casts.to_optional_bool, "n", "maybe", None) == [False, None, None]
    assert one(spark, casts.to_rank, "3.9", "x", None) == [3, None, None]
    got = one(spark, casts.to_instant, "Sun, 29 Jun 2025 05:59:44 GMT", "2025-06-29T05:59:44Z", "junk")
    assert got[0] == got[1] == dt.datetime(2025, 6, 29, 5, 59, 44) and got[2] is None
    assert one(spark, casts.looks_like_date, "2 days ago", "3h", "Mar 4, 2025", "soon") == [True, True, True, False]
    assert one(spark, lambda c: casts.json_length(c, "$.a"), '{"a":[1,2]}', '{"a":{}}', '{"a":null}', "{", None) == [2, 0, 0, 0, 0]
    assert one(spark, casts.json_within, 'say {"a":1} ok', "none") == ['{"a":1}', None]


def test_series(spark):
    df = spark.createDataFrame([("k", "2025-01-01|bad|2025-01-03", "1|2|x"), ("k2", "2025-01-01", "1|2"), ("k3", None, None)], "k string, d string, v string")
    assert {tuple(r) for r in series.explode_history(df, ["k"], "d", "v").collect()} == {("k", dt.date(2025, 1, 1), 1.0), ("k", dt.date(2025, 1, 3), None)}
    arr = spark.createDataFrame([([1.0, 2.0, 3.0],), ([],), ([0.0, 1.0],)], "a array<double>")
    assert [r[0] for r in arr.select(series.pct_change(F.col("a"), 1)).collect()] == [50.0, None, None]


def test_merges(spark):
    t = spark.createDataFrame([(1, "a", 5), (None, "n", 1), (3, None, 9)], "k int, x string, y int")
    s = spark.createDataFrame([(1, None, 7), (None, "m", 0), (4, "d", 2)], "k int, x string, y int")
    once = merge.merge(t, s, ["k"], {"x": "fill", "y": "greatest"})
    want = {(1, "a", 7), (None, "m", 1), (3, None, 9), (4, "d", 2)}
    assert {tuple(r) for r in once.collect()} == want
    assert {tuple(r) for r in merge.merge(once, s, ["k"], {"x": "fill", "y": "greatest"}).collect()} == want
    assert {tuple(r) for r in merge.merge(t.limit(0), s, ["k"]).collect()} == {tuple(r) for r in s.collect()}
    d = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (1, 2, "new"), (2, None, "x")], "k int, o int, v string")
    assert {tuple(r) for r in merge.dedupe(d, ["k"], "o").collect()} == {(1, 2, "new"), (2, None, "x")}


def test_event_state_against_loop(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for e in range(30):
        day, prev, active = dt.date(2025, 1, 1), None, False
        for _ in range(40):
            day += dt.timedelta(days=rng.choice([1, 1, 1, 2]))
            base, carry = rng.random() < 0.1, rng.random() < 0.7
            linked = prev is not None and (day - prev).days == 1
            active = base or (active and linked and carry)
            prev = day
            rows.append((e, day, base, carry))
            want[(e, day)] = active
    df = spark.createDataFrame(rows, "e int, d date, b boolean, c boolean")
    got = {(r.e, r.d): r.active for r in events.event_state(df, ["e"], "d", F.col("b"), F.col("c")).collect()}
    assert got == want
    seeds = spark.createDataFrame([(0, min(r[1] for r in rows if r[0] == 0) - dt.timedelta(days=1), True)], "e int, d date, active boolean")
    first = events.event_state(df.filter("e = 0"), ["e"], "d", F.lit(False), F.lit(True), seeds).orderBy("d").first()
    assert first.active and first.continued


def test_resolution(spark):
    roster = spark.createDataFrame([("foo", "1"), ("foo bar", "2"), ("bar", "3"), ("", "4")], "n string, v string")
    df = spark.createDataFrame([("big foo bar news",), ("foolish",), ("the bar",), ("",)], "q string")
    assert {tuple(r) for r in resolve.contains_longest(df, "q", roster, "n", "v").collect()} == {("big foo bar news", "2"), ("the bar", "3")}
    assert {tuple(r) for r in resolve.suffix_longest(df, "q", roster, "n", "v").collect()} == {("the bar", "3", "the")}
    assert {tuple(r) for r in resolve.token_subset(df, "q", roster, "n", "v").collect()} == {("big foo bar news", "2", 2), ("the bar", "3", 1)}
    score = spark.createDataFrame([("block", "h r block"), ("foo bar", "foo bar"), ("foo", "foo bar"), ("a", "b")], "a string, b string")
    assert [r[0] for r in score.select(resolve.fuzzy_score(F.col("a"), F.col("b"))).collect()] == [50, 100, 79, 0]
    t = spark.createDataFrame([("Foo",), ("FOO BAR",), ("Foo Bar Inc.",), ("xfoo bary",), (None,), ("q",)], "name string")
    ref = spark.createDataFrame([("Foo Bar", "2"), ("Foo", "1")], "n string, v string")
    got = {r.name: (r.v, r.tier) for r in resolve.tiers(t, "name", ref, "n", "v", names.aggregate_key).collect()}
    assert got == {"Foo": ("1", "exact"), "FOO BAR": ("2", "case-insensitive"), "Foo Bar Inc.": ("2", "normalized"), "xfoo bary": ("1", "partial")}


def test_features(spark):
    docs = [
        ('{"data":{"organic_results":[{"title":"T","link":"http://a","rank":"2","time_ago":"2 days ago"},7,{"title":""}],"top_stories":{"x":1},"ai_overview":null}}',),
        ('{"organic_results":[{"title":"root"}]}',),
        ('{"data":{"related_questions":[{"question":"Q?","answer":"A","extensions":["no","Mar 4, 2025"]}]}}',),
        ('{"data":{"organic_results":[{"ti',),
        (None,),
    ]
    df = spark.createDataFrame(docs, "raw_json string").withColumn("id", F.monotonically_increasing_id())
    rows = features.explode_items(df, ["raw_json"]).collect()
    got = sorted((r.feature, r.ordinal, r.title, r.url, r.position, r.date_text) for r in rows)
    assert got == [
        ("organic", 1, "T", "http://a", 2, "2 days ago"),
        ("organic", 1, "root", "", None, ""),
        ("organic", 3, "", "", None, ""),
        ("paa_items", 1, "Q?", "", None, "Mar 4, 2025"),
    ]


def test_rules_and_selection(spark):
    rows = [(1, "Staff walk out over jobs", 0.5), (2, "Staff injured at plant", -0.5), (3, "Court hears claim", 0.9), (4, "Shares slip", None), (5, "Fine weather ahead for all of us today", 0.0)]
    df = spark.createDataFrame(rows, "id int, title string, c double").withColumns({"s": F.lit(None).cast("string"), "u": F.lit("https://news.example/x")})
    f = rules.flags(df, "title", "s", "s", "u")
    label = rules.cascade(F.col("c"), F.lit(False), F.lit(False))
    got = {r.id: (r.l, r.r_low, r.r_legal) for r in f.withColumn("l", label).collect()}
    assert got == {1: ("positive", True, False), 2: ("negative", False, False), 3: ("negative", False, True), 4: ("neutral", False, False), 5: ("neutral", False, False)}
    why = rules.uncertain_reason(F.lit("neutral"), F.col("c"), F.col("title"), F.lit(False), F.lit(False))
    assert {r.id: r.w for r in df.select("id", why.alias("w")).collect()} == {1: "short_title", 2: "short_title", 3: "short_title", 4: "short_title", 5: "low_compound"}
    g = selection.gated(df, [("score", F.col("c") > 0), ("title", F.col("title").contains("Court"))])
    assert {r.id: r.skip_reason for r in g.collect()} == {1: "title", 2: "score", 3: None, 4: "score", 5: "score"}
    ctl = spark.createDataFrame([("Foo Bar", "Foo Bar", "https://x.y/1", "t"), ("Foo Bar", "Z", "https://instagram.com/reel/1", "t"), ("Foo Bar", "Z", "https://facebook.com/foobar", "t"), ("Foo Bar", "Z", "https://www.own.com/a", "t"), ("Foo Bar", "Z", "", "t"), ("Foo Bar", "Z", "https://foobar.io/a", "t"), ("Foo Bar", "Z", "https://other.com", "t")], "c string, p string, u string, t string")
    k = rules.control_class(F.col("c"), F.col("p"), F.col("u"), F.col("t"), F.array(F.lit("own.com")))
    assert [r[0][0] for r in ctl.select(k).collect()] == ["c", "u", "c", "c", "u", "c", "u"]


def test_vader():
    s = lambda t: vader.score(t, vader.LEXICON)
    assert s(None) is None and s("  ") is None and s("plain words") == 0.0
    assert s("good") > 0 > s("not good") and s("very good") > s("good") and s("good!!") > s("good")
    assert s("good but bad") < 0


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "r.csv").write_text('﻿CEO,Company,Website(s),Stock\nA,Foo,"a.com|b.com",FO\nA,Foo,x,FO\n,nan,,\n,,,\n', encoding="utf-8")
    got = readers.roster(spark, str(tmp_path / "r.csv")).collect()
    assert [(r.ceo, r.company, r.ticker, r.sector) for r in got] == [("A", "Foo", "FO", None)]
    df = spark.createDataFrame([("2025-01-01", 1), ("2025-01-02", 2)], "date string, n int")
    writers.write_days(df, str(tmp_path / "t"))
    writers.write_days(spark.createDataFrame([("2025-01-02", 9)], "date string, n int"), str(tmp_path / "t"))
    assert sorted(r.n for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [1, 9]
    for n in (1, 2):
        writers.swap_in(df.filter(F.col("n") <= n), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 2
    assert readers.existing(spark, [str(tmp_path / "s"), str(tmp_path / "none")]) == [str(tmp_path / "s")]
    assert list(readers.dated_paths("/x", "-a.csv", "2025-01-31", "2025-02-01").values()) == ["/x/2025-01-31-a.csv", "/x/2025-02-01-a.csv"]
    assert one(spark, readers.html_text, "<p>a&amp;b</p><script>x<y</script> c") == ["a&b c"]


def test_streams(spark, tmp_path):
    from tidemark.streaming import daily

    rows = [("a", "2025-01-01 10:00:00", "negative"), ("a", "2025-01-01 11:00:00", "neutral"), ("b", "2025-01-05 00:00:00", "negative")]
    spark.createDataFrame(rows, "e string, t string, l string").selectExpr("e", "cast(t as timestamp) t", "l").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("e string, t timestamp, l string").parquet(str(tmp_path / "in"))
    q = daily.daily_counts(stream, "t", ["e"], "l").writeStream.format("memory").queryName("daily_out").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {tuple(r) for r in spark.table("daily_out").collect()} == {(dt.date(2025, 1, 1), "a", 2, 1), (dt.date(2025, 1, 5), "b", 1, 1)}
    days = [("a", "2025-01-01", True, False), ("a", "2025-01-02", False, True), ("a", "2025-01-04", False, True)]
    spark.createDataFrame(days, "k string, d string, base boolean, carry boolean").selectExpr("k", "cast(d as date) date", "base", "carry").coalesce(1).write.parquet(str(tmp_path / "st"))
    s2 = spark.readStream.schema("k string, date date, base boolean, carry boolean").parquet(str(tmp_path / "st"))
    q = daily.carried_state(s2, "k").writeStream.format("memory").queryName("state_out").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.date.day, r.active) for r in spark.table("state_out").collect()) == [(1, True), (2, True), (4, False)]


def test_entry_has_every_query():
    import __spark_entry__ as e

    known, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(known) and {f"p{n}_found" for n in (1, 2, 3, 5)} <= set(known)
