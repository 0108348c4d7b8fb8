"""Batches against history: links, titles, slips, cut ends, names and figures; appending equals one pass; components."""

import random

from pyspark.sql import functions as F

from tidemark.llm import dedupe
from tidemark.llm.dedupe import append_batch, articles_index, canonical_link, choose_pivots, components, find_repeats, new_store

SAME_PAGE = [
    ("https://www.a.example/news/x-1", "http://A.EXAMPLE//news/x-1/?utm_source=f&gclid=3#top"),
    ("https://a.example/s?id=5&view=full", "https://a.example/s?view=full&id=5&mc_cid=9"),
    ("https://a.example/n/y", "https://go.hub.example/url?q=https%3A%2F%2Fwww.a.example%2Fn%2Fy&sa=U"),
    ("https://a.example/n/z", "HTTPS://m.a.example:443/n/z#:~:text=it?utm_campaign=q"),
]


def test_links(spark):
    df = spark.createDataFrame(SAME_PAGE, "a string, b string")
    assert all(r.a == r.b for r in df.select(canonical_link(F.col("a")).alias("a"), canonical_link(F.col("b")).alias("b")).collect())
    other = spark.createDataFrame([("https://a.example/s?id=5", "https://a.example/s?id=6"), ("https://a.example/x", "https://b.example/x")], "a string, b string")
    assert all(r.a != r.b for r in other.select(canonical_link(F.col("a")).alias("a"), canonical_link(F.col("b")).alias("b")).collect())
    none = spark.createDataFrame([("",), (None,)], "a string")
    assert {r[0] for r in none.select(canonical_link(F.col("a"))).collect()} == {None}


T = "Staff at Numara walk out over Drohokora Airways's Telodek fund, day 140"
ROWS = [  # id, batch, url, title, publisher, id of the earliest of its group
    (1, 0, "https://p.example/1", T, "Fovedan Post", 1),
    (2, 0, "https://p.example/2", "Regulator fines Skestisen 388 million over Glabodan venture in Hejel", None, 2),
    (3, 0, None, None, None, 3),
    (4, 0, None, "", None, 4),
    (5, 1, "https://q.example/5", T.upper(), "Q", 1),
    (6, 1, "https://q.example/6", "UPDATE 1-" + T + " - Fovedan Post", "Fovedan Post", 1),
    (7, 1, "https://q.example/7", T.replace("walk", "wlak"), None, 1),
    (8, 1, "https://q.example/8", "Staff at Numara walk out over Drohokora Airways&#x27;s Telodek fund…", None, 1),
    (9, 1, "https://q.example/9", T.replace("140", "141"), None, 9),
    (10, 1, "https://q.example/10", T.replace("Numara", "Numora"), None, 10),
    (11, 2, "http://www.p.example/2/?fbclid=1", "Something else entirely happened in Gozura", None, 2),
    (12, 2, "https://q.example/12", "Something else entirely happened at Gozura ", None, 2),
    (13, 2, None, None, None, 13),
    (14, 2, "https://q.example/14", "", "X", 14),
    (15, 2, "https://q.example/15", "Breaking - Regulator fines Skestisen 388 million over Glabodan venture...", None, 2),
    (16, 2, "https://q.example/16", "Regulator fines Skestisen 38 million over Glabodan venture in Hejel", None, 16),
    (17, 2, "https://q.example/17", "z" * 50_000, None, 17),
    (18, 2, "https://q.example/18", T, "Q", 1),
]


def table(spark, rows=ROWS):
    df = spark.createDataFrame([r[:5] for r in rows], "id long, batch_no int, url string, title string, publisher string")
    return df.withColumns({"node": F.lit(1), "text": F.lit("x"), "words": F.lit(0), "turn": F.lit(0), "tail": F.lit("t")})


def found(df, **more):
    return {(r.id_a, r.id_b) for r in find_repeats(df, order=("batch_no", "id"), **more).collect()}


WANT = {(r[5], r[0]) for r in ROWS if r[5] != r[0]}


def test_batches_against_history(spark):
    sources = spark.createDataFrame([("Fovedan Post",), (None,)], "source string")
    assert found(table(spark), sources=sources, batch="batch_no") == WANT
    assert found(table(spark).limit(0), batch="batch_no") == set()
    # one batch of all articles gives the same as batch after batch
    assert found(table(spark), sources=sources) == WANT


def test_the_stored_table_decides(spark, monkeypatch):
    # pivots that prune everything: near titles are found through the table or not at all
    monkeypatch.setattr(dedupe, "RADIUS", -1)
    assert found(table(spark), batch="batch_no") == WANT - {(1, 7)}


def test_a_large_batch_is_shuffled(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "BROADCAST_BATCH", 0)
    assert found(table(spark), batch="batch_no") == WANT


def test_a_batch_reads_its_ranges_only(spark):
    rng = random.Random(1)
    rows = [(i, 0, f"https://p.example/{i}", " ".join("".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(2 + i % 12)), None) for i in range(300)]
    index = articles_index(table(spark, rows), order=("batch_no", "id"), batch="batch_no")
    store = new_store(spark, choose_pivots(index))
    append_batch(store, index, 0, 300)
    before = store.facts().count()
    new = articles_index(table(spark, [(900, 1, None, rows[5][3].replace(" ", "x ", 1), None)]), order=("batch_no", "id"), batch="batch_no")
    edges = append_batch(store, new, 1, 1).collect()
    assert {(e.kind, e.node_b) for e in edges} == {("n", index.filter("id = 5").first().node)}
    near = store.facts().filter("kind = 'n'")
    reach = {p for r in near.filter("batch = 1").select("d").collect() for p in ((r.d[0] - 2) // 5, (r.d[0] + 2) // 5)}
    # the ranges that the new title and its neighbours fall in hold a part of the history
    read = near.filter("batch = 0").filter(F.col("part").isin([int(p) for p in reach])).count()
    assert len(reach) <= 2 and 0 < read < near.count() * 0.6 and store.facts().count() > before
    store.drop()


def test_waiting_batches_are_one_arrival(spark):
    # neither the jobs nor what they leave in the driver grow with the number of batches
    def run(n):
        rows = [(1000 * b + i, b, None, f"city council weighs {w} bridge repair plan {b + 10}{'…' if i else ''}", None) for b in range(n) for i, w in enumerate(("canal", "canla"))]
        spark.sparkContext.setJobGroup(f"waiting-{n}", "")
        try:
            got = found(table(spark, rows), batch="batch_no")
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert got == {(1000 * b, 1000 * b + 1) for b in range(n)}
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"waiting-{n}"))

    assert run(8) < 1.3 * run(3)


def test_each_waiting_batch_meets_what_came_before_it(spark):
    # the order of turns is not that of the batches: the page's first article is of batch 0, and has the last id
    rows = [(9, 0, "https://p.example/a", "Council opens northern depot for the city", None), (5, 1, "https://p.example/a", "Quite another thing happened", None), (2, 2, "https://p.example/a", "Third of the kind", None)]
    assert {(r.id_a, r.id_b) for r in find_repeats(table(spark, rows), batch="batch_no").collect()} == {(2, 5), (2, 9)}


def test_names_known_later(spark):
    # in capitals nothing tells names apart; the copy that comes later does
    base = "{} plans wider offer for northern depots of the city"
    rows = [(1, 0, None, base.format("Kadro").upper(), None), (2, 0, None, base.format("Kadra").upper(), None), (3, 1, None, base.format("Kadro the maker").replace(" the maker", ""), None)]
    one = [(r[0], r[1], r[2], "Talks on " + r[3] if r[0] == 3 else "TALKS ON " + r[3], r[4]) for r in rows]
    assert found(table(spark, one), batch="batch_no") == {(1, 3)}


def test_hot_groups(spark):
    # one page and one title with many copies, and many titles that differ in one word
    rows = [(i, i % 3, "https://hot.example/a", f"W{i} ordinary words about nothing at all", None) for i in range(150)]
    rows += [(1000 + i, i % 3, f"https://x.example/{i}", "The very same title for all of them here", None) for i in range(150)]
    got = found(table(spark, rows), batch="batch_no")
    assert got == {(0, i) for i in range(1, 150)} | {(1000, 1000 + i) for i in range(1, 150)}


def test_titles_cut_by_many_words(spark):
    whole = "Court hears Brabralis claim against Ganakraket Energy over faults found near Truskex depot before 244 plaintiffs met in Zolabel"
    rows = [
        (1, 0, "https://p.example/1", whole, None),
        (2, 1, "https://p.example/2", "Court hears Brabralis claim against Ganakra…", None),
        (3, 1, "https://p.example/3", "Court hears Brabralis claim…", None),
        (4, 1, "https://p.example/4", "Court hears Brabralis plea…", None),
        (5, 1, "https://p.example/5", whole.rsplit(" ", 1)[0] + "...", None),
    ]
    assert found(table(spark, rows), batch="batch_no") == {(1, 2), (1, 3), (1, 5)}


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(25)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    want = {}
    for x in parent:
        want.setdefault(find(x), set()).add(x)
    least = {x: min(g) for g in want.values() for x in g}
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "node_a long, node_b long")).collect()}
    assert {x: got.get(x, x) for x in least} == least
