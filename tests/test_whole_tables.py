"""Registered queries over small tables of their own: no row is left out."""

import datetime as dt
import hashlib

import pytest

from tidemark.plans.reference import QUERIES


@pytest.fixture
def tables(spark, tmp_path):
    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


def test_merges_of_whole_tables(spark, tables):
    day = lambda n: dt.datetime(2025, 1, n)
    # pages 1 and 4002 would share a key modulo 4001; links of one page differ in writing only
    rows = [
        (1, "https://a.example/x", "A", None, day(3), day(4), 0),
        (2, "HTTPS://www.a.example//x?utm_source=f", None, "s", day(2), day(3), 0),
        (4002, "https://a.example/y", "B", None, day(5), day(5), 0),
        (4003, None, "N", None, day(5), day(5), 0),
        (8003, "https://a.example/x#top", None, None, day(6), day(9), 1),
        (8004, "http://www.a.example/z", "C", None, day(6), day(7), 2),
        (8005, None, "M", None, day(6), day(6), 2),
        (8006, "http://a.example/z", "D", None, day(1), day(2), 3),
    ]
    sf = tables("articles", rows, "id long, url string, publisher string, snippet string, first_seen_at timestamp, last_seen_at timestamp, batch_no int")
    x, y, z = "https://a.example/x", "https://a.example/y", "http://a.example/z"
    want = {
        "ups_overwrite_pages": [(x, 8003, None), (y, 4002, "B"), (z, 8006, "D"), ("#4003", 4003, "N"), ("#8005", 8005, "M")],
        "ups_coalesce_new_pages": [(x, "A", "s"), (y, "B", None), (z, "D", None), ("#4003", "N", None), ("#8005", "M", None)],
        "ups_min_max_seen_pages": [(x, day(2), day(9)), (y, day(5), day(5)), (z, day(1), day(7)), ("#4003", day(5), day(5)), ("#8005", day(6), day(6))],
        "ups_do_nothing_pages": [(x, 1), (y, 4002), (z, 8004), ("#4003", 4003), ("#8005", 8005)],
        "ups_update_from_pages": [(x, 1, None), (x, 2, None), (y, 4002, "B"), ("#4003", 4003, "N")],
        "ups_delete_using_pages": [(y, 4002), ("#4003", 4003)],
    }
    for name, rows in want.items():
        assert sorted(map(tuple, QUERIES[name](spark, sf).collect()), key=str) == sorted(rows, key=str), name


def test_rules_on_any_script_and_null_titles(spark, tables):
    rows = [
        (1, "Court hears ‘claim’ on Söder…", None, "P", "https://a.example/1"),
        (2, None, "Staff walk out – again", None, None),
        (3, "Éclair shares rise", "“outlook” lifts", "P", None),
        (4, "Plain court", None, "P", None),
        (5, "Sharesé and courté", None, None, None),
        (6, None, None, None, None),
        (7, "Boss named “chief”", None, "Reddit", None),
    ]
    sf = tables("articles", rows, "id long, title string, snippet string, publisher string, url string")
    got = {name: {r[0]: tuple(r)[1:] for r in QUERIES[name](spark, sf).collect()} for name in ("rule_flags", "rule_neutralised", "rule_sentiment_cascade", "nar_classify")}
    no = (False, False, False, False)
    assert got["rule_flags"] == {1: (False, True, False, True), 2: (False, False, True, False), 3: (True, False, False, False), 4: (False, True, False, True), 5: no, 6: no, 7: no}
    assert got["rule_neutralised"] == {i: (i in (2, 3),) for i in range(1, 8)}
    assert got["nar_classify"] == {1: (None, None), 2: ("labour", "crisis"), 3: ("growth", "non_crisis"), 4: (None, None), 5: (None, None), 6: (None, None), 7: ("governance", "crisis")}
    assert {i: r[0] for i, r in got["rule_sentiment_cascade"].items()} == {1: "negative", 2: "neutral", 3: "neutral", 4: "negative", 5: "neutral", 6: "neutral", 7: "negative"}


def test_typed_names_of_any_script(spark, tables):
    tables("companies", [("a", "Söder Foods"), ("b", "Numara Inc"), ("c", "Zed & Sons")], "id string, name string")
    typed = [(1, "Söder Foods"), (2, "numara\u00a0"), (3, "Numara – Group"), (4, None), (5, "Ｚｅｄ"), (6, "Zed & Sons"), (7, "")]
    sf = tables("ceo_articles_modal", typed, "row_id long, company string")
    got = {r[0]: (r[1], r[2]) for r in QUERIES["join_fallback_chain"](spark, sf).collect()}
    assert got == {1: ("a", "exact"), 2: ("b", "simple"), 3: ("b", "simple"), 4: (None, None), 5: (None, None), 6: ("c", "exact"), 7: (None, None)}


def test_control_of_items_without_an_id(spark, tables):
    tables("companies", [("a", "Numara Foods", "shop-of-n.example"), ("b", "Zed", None)], "id string, name string, websites string")
    tables("ceos", [("Ada L", "a"), ("Two Of", "a"), ("Two Of", "b")], "name string, company_id string")
    rows = [
        (1, "a", "Numara Foods", None, "https://shop-of-n.example/x", "t"),
        (2, None, "Numara Foods", None, "https://shop-of-n.example/x", "t"),
        (3, None, "Ada L", None, "https://www.shop-of-n.example/x", "t"),
        (4, None, "Two Of", None, "https://shop-of-n.example/x", "t"),
        (5, None, "Unlisted Works", "Unlisted Works", "https://u.example/x", "t"),
        (6, "gone", "Unlisted Works", None, "https://u.example/x", None),
        (7, None, None, None, None, None),
    ]
    sf = tables("serp_feature_items", rows, "item_id long, entity_id string, entity_name string, source string, url string, title string")
    got = {r.item_id: r.control for r in QUERIES["rule_control"](spark, sf).collect()}
    assert got == {i: "controlled" if i in (1, 2, 3, 5) else "uncontrolled" for i in range(1, 8)}


def test_links_moments_and_markup_of_every_row(spark, tables):
    links = ["https://a.example/x?b=2&a=1&utm_source=q", "https://a.example/x;v=1?id=3", "https://a.example/x", None]
    texts = ["A &#8211; B", "C &#x27;d&#x27; &amp; e", None, "F"]
    tables("articles", list(zip(range(4), links, texts, [None, None, "g", None])), "id long, url string, title string, snippet string")
    stamps = ["2025-06-29T05:59:44Z", "2025-06-29 05:59:44", "Sun, 29 Jun 2025 07:59:44 +0200", "soon", None]
    sf = tables("ceo_articles_modal", list(enumerate(stamps)), "row_id long, published_at string")
    got = {name: {r[0]: r[1] for r in QUERIES[name](spark, sf).collect()} for name in ("url_hash", "cast_datetime", "src_html_text")}
    forms = ["https://a.example/x?a=1&b=2", "https://a.example/x?id=3", "https://a.example/x"]
    assert got["url_hash"] == {**{i: hashlib.sha256(f.encode()).hexdigest() for i, f in enumerate(forms)}, 3: ""}
    at = dt.datetime(2025, 6, 29, 5, 59, 44)
    assert got["cast_datetime"] == {0: at, 1: at, 2: at, 3: None, 4: None}
    assert got["src_html_text"] == {0: "A – B", 1: "C 'd' & e", 2: "g", 3: "F"}
