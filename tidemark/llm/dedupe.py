"""New batches checked for duplicates and near-duplicates against all history.

An article's link and title are brought to a canonical form. Equal forms are
found by grouping. Near titles are found by a stored pivot-distance table: for
each distinct canonical title it holds the edit distances to a few fixed, far-apart
pivot titles, and lies in ranges of the first of them. By the triangle inequality
two titles within ``RADIUS`` edits differ by at most that from any pivot. What
arrives, one batch or several that wait, is appended and meets the titles that
agree with it in all words but one (a slip of the pen touches one), is pruned by
the pivots, and verified by the true distance of the words that differ; each of
its batches meets only what was accepted up to it. Rows of earlier batches are
never written, canonicalised or keyed again; a small arrival reads only the
ranges that its titles and their neighbours fall in, and shuffles no other rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.text import fold, squeeze, unescape_html
from tidemark.llm.resolve import one_edit
from tidemark.session import drop_folder, durable, shared_folder, small

if TYPE_CHECKING:  # loaded in the workers only
    import pyarrow as pa

RADIUS = 2
BAND = 2 * RADIUS + 1
PIVOTS = 4
#: Titles of the history among which the pivots are chosen.
PIVOT_SAMPLE = 64
#: Rows of an arrival whose keys are sent to the executors; those of a larger one are shuffled.
BROADCAST_BATCH = 50_000
#: Stored rows for each row of an arrival from which on sending its keys is less than shuffling the stored ones.
BROADCAST_SHARE = 8
#: Batches of one run.
MAX_BATCHES = 10_000
#: A cut title keeps at least this many words; it may lack any number of the whole one's.
MIN_CUT = 4

#: Marks that desks put before a headline.
MARKS = (
    r"(?i)^(?:(?:update(?:\s*\d+)?|breaking(?:\s+news)?|exclusive|watch|live|video|listen|podcast|photos?|opinion|analysis|"
    r"factbox|explainer|corrected|correction|refile|wrapup(?:\s*\d+)?|developing|just\s+in|alert|report|rpt|news)\s*[:\-–—|]+\s*)+"
)
#: Small words, which come and go between copies of a headline.
SMALL_WORDS = "a an the and or of in on at to by for from with as is are was were its s".split()
#: Query parameters that tell where a click came from, not which page it leads to.
TRACKING = (
    r"^(?:utm_[a-z_]*|gaa_[a-z_]*|mc_[ce]id|gclid|gclsrc|dclid|fbclid|msclkid|yclid|twclid|igshid|_hsenc|_hsmi|mkt_tok|cmpid|"
    r"ocid|ref|ref_src|referrer|smid|spm|ncid|sr_share|guccounter|ftag)$"
)


def canonical_link(url: Column) -> Column:
    """The page a link leads to: host, path and own parameters; null for a link without a host.

    A forwarding link stands for the address it carries. Scheme, case of the
    host, ``www.``, ``m.`` and ``amp.``, default ports, doubled and trailing
    slashes, the fragment, tracking parameters and the order of parameters do
    not count; all other parameters do.
    """
    raw = F.trim(url)
    inner = F.regexp_extract(raw, r"(?i)[?&](?:q|u|url|dest|destination|redirect|target|continue)=(https?(?::|%3a)[^&#]*)", 1)
    u = F.when(inner != "", F.coalesce(F.try_url_decode(inner), inner)).otherwise(raw)
    u = F.regexp_replace(u, "#.*$", "")
    rest = F.regexp_replace(u, r"(?i)^[a-z][a-z0-9+.-]*:/*|^//", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(?:80|443)$", ""), r"^(?:www\d?|m|mobile|amp)\.", "")
    path = F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1)
    path = F.regexp_replace(F.regexp_replace(path, "/+", "/"), r"(?:/amp|/index\.html?)?/?$", "")
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    own = F.array_sort(
        F.array_distinct(
            F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(F.regexp_extract(p, "^([^=]*)", 1)).rlike(TRACKING))
        )
    )
    return F.when(host != "", F.concat(host, path, F.lit("?"), F.array_join(own, "&")))


def titled(df: DataFrame, keep: list[str], title: str, publisher: str | None, sources: DataFrame | None) -> DataFrame:
    """``keep`` and ``(words, caps, cut)`` of each row's headline.

    ``words`` are its folded words without marks before it, the publisher after it
    and small words; ``caps`` tells which of them are written as names, null where
    the whole headline is in one case; ``cut`` says that its end was cut off. A
    publisher is the row's own or one of ``sources`` (``source``), a bounded list.
    """
    t = squeeze(unescape_html(F.coalesce(F.col(title), F.lit(""))))
    base = df.select(*keep, t.alias("t"), (F.col(publisher) if publisher else F.lit(None).cast("string")).alias("pub"))
    tail = F.lower(F.trim(F.regexp_extract("t", r"^.*\s[-–—|·]\s*([^|]{2,60})$", 1)))
    base = base.withColumn("tail", tail)
    mine = F.coalesce(F.col("tail") == F.lower(F.trim("pub")), F.lit(False))
    if sources is not None:
        known = sources.select(F.lower(F.trim("source")).alias("tail")).filter("tail is not null").distinct().withColumn("known", F.lit(True))
        base = base.join(small(known), "tail", "left")
        mine = mine | F.coalesce("known", F.lit(False))
    bare = F.when(mine & (F.col("tail") != ""), F.expr("rtrim(left(t, length(t) - length(tail)))")).otherwise(F.col("t"))
    bare = F.when(mine & (F.col("tail") != ""), F.regexp_replace(bare, r"\s*[-–—|·]\s*$", "")).otherwise(bare)
    base = base.select(*keep, F.regexp_replace(bare, MARKS, "").alias("t"))
    cut = F.col("t").rlike(r"(?:\.{3,}|…)[\s.…]*$")
    # the gap of a number ("1,000" and "1000") is no word gap
    plain = F.regexp_replace("t", r"(?<=\d)[,.](?=\d)", "")
    pieces = F.filter(F.split(plain, r"[^\p{L}\p{N}\p{M}\p{Cf}]+"), lambda p: p != "")
    pairs = F.transform(pieces, lambda p: F.struct(fold(p).alias("w"), p.rlike(r"^\p{Lu}").alias("cap"), p.rlike(r"^\p{L}").alias("let")))
    kept = F.filter(pairs, lambda p: (p["w"] != "") & ~F.array_contains(F.array(*map(F.lit, SMALL_WORDS)), p["w"]))
    base = base.select(*keep, cut.alias("cut"), pairs.alias("all"), kept.alias("kept"))
    lows = F.size(F.filter("all", lambda p: p["let"] & ~p["cap"]))
    low_kept = F.size(F.filter("kept", lambda p: p["let"] & ~p["cap"]))
    ups = F.size(F.filter("kept", lambda p: p["cap"]))
    mixed = (lows > 0) & (low_kept > 0) & (ups > 0)
    return base.select(
        *keep,
        F.transform("kept", lambda p: p["w"]).alias("words"),
        # the first word of a sentence is in capitals without being a name
        F.when(mixed, F.transform("kept", lambda p, i: p["cap"] & (i > 0))).alias("caps"),
        "cut",
    )


def articles_index(df: DataFrame, key: str = "id", order: tuple[str, ...] = ("id",), batch: str | None = None, sources: DataFrame | None = None) -> DataFrame:
    """``(id, turn, batch, link, node, words, caps, cut)`` of each article.

    ``turn`` is the order of arrival, made of the columns ``order``; ``node`` is the
    hash of the canonical title, a row without title words being a node of its
    own; ``batch`` is 0 where it is null or not given.
    """
    turn = F.struct(*(F.col(c).cast("bigint").alias(f"o{i}") for i, c in enumerate(order)))
    number = F.coalesce(F.col(batch).cast("int"), F.lit(0)) if batch else F.lit(0)
    publisher = "publisher" if "publisher" in df.columns else None
    known = [c for c in ("title", publisher) if c]
    base = df.select(F.col(key).alias("id"), turn.alias("turn"), number.alias("batch"), canonical_link(F.col("url")).alias("link"), *known)
    out = titled(base, ["id", "turn", "batch", "link"], "title", publisher, sources)
    text = F.array_join("words", " ")
    own = F.when(text != "", F.concat(F.when(F.col("cut"), "c").otherwise("w"), text)).otherwise(F.concat(F.lit("#"), F.col("id").cast("string")))
    return out.withColumn("node", F.xxhash64(own))


def _distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def choose_pivots(index: DataFrame, k: int = PIVOTS, sample: int = PIVOT_SAMPLE) -> list[str]:
    """``k`` titles far apart from each other, chosen among ``sample`` titles of least hash: the same for the same history.

    Titles are taken up to 200 characters here, as any text may be a pivot; empty
    titles are none. An empty history has the empty title as its pivots.
    """
    text = F.left(F.array_join("words", " "), F.lit(200))
    rows = index.select(text.alias("text")).filter("text != ''").distinct().orderBy(F.xxhash64("text"), "text").limit(sample).collect()
    texts = [r.text for r in rows]
    chosen = texts[:1]
    far = [_distance(t, chosen[0]) for t in texts] if texts else []
    while chosen and len(chosen) < min(k, len(texts)):
        chosen.append(texts[far.index(max(far))])
        far = [min(f, _distance(t, chosen[-1])) for f, t in zip(far, texts, strict=True)]
    return chosen + [""] * (k - len(chosen))


#: Arithmetic of 64 bits for hashes of word sequences: a word's place is a power of an odd number.
_WIDE, _ODD = (1 << 64) - 1, 0x9E3779B97F4A7C15


def _mixed(h: int) -> int:
    h = (h ^ (h >> 31)) * 0xBF58476D1CE4E5B9 & _WIDE
    h = (h ^ (h >> 29)) * 0x94D049BB133111EB & _WIDE
    h ^= h >> 32
    return h - (1 << 64) if h >> 63 else h


def title_keys(words: list[str], caps: list[bool] | None, cut: bool) -> Iterator[tuple[str, int, str, int | None]]:
    """``(kind, key, word, at)`` of a title; see ``title_facts``. Takes time in proportion to the words."""
    import xxhash

    powers, value = [], 1
    for _ in words:
        powers.append(value)
        value = value * _ODD & _WIDE
    hashed = [xxhash.xxh64_intdigest(w) * p & _WIDE for w, p in zip(words, powers, strict=True)]
    whole, begun = sum(hashed) & _WIDE, 0
    for i, w in enumerate(words):
        if i >= MIN_CUT - 1:
            key = _mixed(begun + i * _ODD & _WIDE)
            yield "h", key, w, None
            if cut and i == len(words) - 1:
                yield "c", key, w, None
        begun = begun + hashed[i] & _WIDE
        if len(words) < 2 or (caps is not None and caps[i]) or any(c.isnumeric() for c in w):
            continue
        rest = (whole - hashed[i]) * _ODD + i * len(words) & _WIDE
        subs = [""] if len(w) <= 4 else []
        if len(w) >= 4:
            subs += ["<" + w[:2], ">" + w[-2:]]
        for sub in subs:
            yield "n", _mixed(rest ^ xxhash.xxh64_intdigest(sub)), w, i + 1


def _title_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow as pa

    for batch in batches:
        rows, kinds, ends, found = [], [], [0], []
        columns = (batch.column(c).to_pylist() for c in ("words", "caps", "cut"))
        for i, (words, caps, cut) in enumerate(zip(*columns, strict=True)):
            own: dict[str, list] = {}
            for kind, *fact in title_keys(words, caps, cut):
                own.setdefault(kind, []).append(fact)
            for kind, facts in own.items():
                rows.append(i)
                kinds.append(kind)
                found += facts
                ends.append(len(found))
        key, word, at = zip(*found, strict=True) if found else ((),) * 3
        by = pa.StructArray.from_arrays([pa.array(key, pa.int64()), pa.array(word, pa.string()), pa.array(at, pa.int32())], ["key", "word", "at"])
        # distances and ranges belong to the pivot table
        all_, near = pa.array(rows, pa.int64()), pa.array([i if k == "n" else None for i, k in zip(rows, kinds, strict=True)], pa.int64())
        cols = [batch.column("batch").take(all_), pa.array(kinds, pa.string()), batch.column("near").take(near).fill_null(0)]
        cols += [batch.column("node").take(all_), batch.column("turn").take(all_), batch.column("d").take(near), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), by)]
        yield pa.RecordBatch.from_arrays(cols, ["batch", "kind", "part", "node", "turn", "d", "found"])


def title_facts(titles: DataFrame, pivots: list[str]) -> DataFrame:
    """``(batch, kind, part, node, turn, d, found)``: a row of each kind that a title has; ``found (key, word, at)`` is what it is found by.

    Kind ``n``, the pivot table, has entries for each ``word`` that a slip may touch:
    ``key`` hashes all other words with the word's place ``at``, and the word's
    first or last two letters, of which one edit leaves one pair intact (words of
    up to four letters also come without); what many titles have in common is
    split by the word itself. Words written as names and words with figures get
    none. ``d`` holds the distances to the pivots, ``part`` is the range of the first.
    Kind ``h`` has the beginnings of at least ``MIN_CUT - 1`` words with the ``word``
    that follows; ``c`` that of a title whose end was cut off: its last word may be
    cut itself, so the words before it make its beginning.
    """
    d = F.array(*(F.levenshtein(F.array_join("words", " "), F.lit(p)) for p in pivots))
    given = titles.select("batch", "node", "turn", "words", "caps", "cut", d.alias("d")).withColumn("near", F.floor(F.col("d")[0] / BAND).cast("int"))
    turn = given.schema["turn"].dataType.simpleString()
    # Ranges of even size, however the titles spread over them; titles are moved, as what they are found by is several times as much.
    return given.hint("rebalance", "batch", "near").mapInArrow(_title_rows, f"batch int, kind string, part int, node bigint, turn {turn}, d array<int>, found array<struct<key: bigint, word: string, at: int>>")


@dataclass
class Store:
    """The accepted articles as written tables under ``path``: ``facts`` (pivot table, beginnings, links) and ``edges``.

    Batches, kinds of facts and ranges are folders, so that choosing among them
    opens no file and makes no new code for each batch.
    """

    spark: SparkSession
    path: str
    pivots: list[str]
    schema: StructType | None = None
    listed: DataFrame | None = None

    def facts(self) -> DataFrame:
        """All facts; their files are listed once after each append."""
        if self.listed is None:
            self.listed = self.spark.read.schema(self.schema).parquet(f"{self.path}/facts")
        return self.listed

    def opened(self, kind: str, last: int) -> DataFrame:
        """``(batch, part, node, turn, d, key, word, at)`` of one kind up to batch ``last``: a row for each entry."""
        of = self.facts().filter((F.col("kind") == kind) & (F.col("batch") <= last))
        return of.select("batch", "part", "node", "turn", "d", F.inline("found"))

    def edges(self, batch: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/edges" if batch is None else f"{self.path}/edges/batch={batch}")

    def drop(self) -> None:
        drop_folder(self.spark, self.path)


def new_store(spark: SparkSession, pivots: list[str]) -> Store:
    """An empty store in the session's shared folder."""
    return Store(spark, f"{shared_folder(spark)}/articles-{uuid.uuid4().hex}", pivots)


def append_rows(store: Store, rows: DataFrame) -> None:
    """Appends what the titles and links of index rows are found by; each batch's own titles once, whatever their copies."""
    titles = rows.groupBy("batch", "node").agg(
        F.min(F.struct("turn", "words", "cut")).alias("r"),
        # the casing of the first copy that tells names apart
        F.min(F.when(F.col("caps").isNotNull(), F.struct("turn", "caps"))).alias("c"),
    )
    titles = titles.select("batch", "node", "r.turn", "r.words", "r.cut", F.col("c.caps").alias("caps")).filter(F.size("words") >= 2)
    none = F.lit(None)
    links = rows.filter("link is not null").groupBy("batch", "link", "node").agg(F.min("turn").alias("turn"))
    page = F.array(F.struct(F.xxhash64("link").alias("key"), F.col("link").alias("word"), none.cast("int").alias("at")))
    links = links.select("batch", F.lit("l").alias("kind"), F.lit(0).alias("part"), "node", "turn", none.cast("array<int>").alias("d"), page.alias("found"))
    fresh = title_facts(titles, store.pivots).unionByName(links.hint("rebalance", "batch"))
    store.schema, store.listed = fresh.schema, None
    fresh.write.partitionBy("batch", "kind", "part").mode("append").parquet(f"{store.path}/facts")


def meet(store: Store, first: int, last: int, few: bool) -> DataFrame:
    """Edges ``(kind, node_a, node_b, turn_b, at)`` of the appended batches ``first`` to ``last``, each to all that was accepted up to it; kept in the store.

    Slips have no ``turn_b``, as none of them is preferred to another.

    Batches that wait together are met in one go: the number of jobs, and what they
    take of the driver, does not grow with the batches. The keys of ``few`` rows go
    to the executors, and of the history only the ranges of the pivot table that
    they reach are read; else the keys of new and old rows are sorted together.
    """
    fresh = F.col("batch") >= first
    near, pages = store.opened("n", last), store.opened("l", last)
    if few:
        # The range of a title and its neighbours within the radius: at most two ranges.
        reach = F.sequence(F.floor((F.col("d")[0] - RADIUS) / BAND).cast("int"), F.floor((F.col("d")[0] + RADIUS) / BAND).cast("int"))
        sought = near.filter(fresh).select(F.explode(reach).alias("part"), "key")
        near = near.join(F.broadcast(sought), ["part", "key"], "left_semi")
        pages = pages.join(F.broadcast(pages.filter(fresh).select("key", "word")), ["key", "word"], "left_semi")
    # Most keys belong to one title, or have nothing new; what is left is little, whatever its keys.
    by_key = Window.partitionBy("key")
    shared = (F.min("node").over(by_key) != F.max("node").over(by_key)) & (F.max("batch").over(by_key) >= first)
    held = durable(near.select("batch", "node", "d", "key", "word", "at", shared.alias("shared")).filter("shared").drop("shared"))
    old = held.select("key", *(F.col(c).alias(f"old_{c}") for c in ("batch", "node", "word", "d")))
    close = F.col("word") != F.col("old_word")
    for i in range(len(store.pivots)):
        close = close & (F.abs(F.col("d")[i] - F.col("old_d")[i]) <= RADIUS)
    met = held.filter(fresh).join(old, "key").filter("old_batch <= batch and node != old_node").filter(close & one_edit(F.col("word"), F.col("old_word")))
    turn = F.lit(None).cast(store.schema["turn"].dataType).alias("turn_b")
    found = met.select(F.lit("n").alias("kind"), F.col("node").alias("node_a"), F.col("old_node").alias("node_b"), turn, "at")
    # New cut ends seek beginnings, and new beginnings seek the cut ends that were waiting for them.
    begun, none = store.opened("h", last).select("batch", "node", "turn", "key", "word"), F.lit(None).cast("int").alias("at")
    ends = store.opened("c", last).select("batch", "key", F.col("node").alias("node_a"), F.col("word").alias("end"))
    goes_on = F.when(F.col("end").rlike(r"\p{N}"), F.col("end") == F.col("word")).otherwise(F.col("word").startswith(F.col("end")))
    for seek, among in ((ends.filter(fresh), begun), (ends.filter(~fresh), begun.filter(fresh))):
        ended = among.join(small(seek.drop("batch")), "key").filter(goes_on & (F.col("node") != F.col("node_a")))
        found = found.unionByName(ended.select(F.lit("c").alias("kind"), "node_a", F.col("node").alias("node_b"), F.col("turn").alias("turn_b"), none))
    # All titles of a page are tied to the one that came first: the same one for every later batch.
    hub = F.min(F.struct("batch", "turn", "node")).over(Window.partitionBy("key", "word"))
    linked = pages.select("batch", "node", hub.alias("h")).filter(fresh & (F.col("node") != F.col("h.node")))
    found = found.unionByName(linked.select(F.lit("l").alias("kind"), F.col("node").alias("node_a"), F.col("h.node").alias("node_b"), F.col("h.turn").alias("turn_b"), none))
    found.hint("rebalance").write.parquet(f"{store.path}/edges/batch={last}")
    return store.edges(last)


def append_batch(store: Store, rows: DataFrame, batch: int, n_rows: int) -> DataFrame:
    """Appends the index rows of one batch and returns its edges to all that was accepted before; see ``meet``.

    Rows of earlier batches are neither canonicalised nor keyed again. A batch that
    was appended before must not be appended again.
    """
    append_rows(store, rows)
    return meet(store, batch, batch, n_rows <= BROADCAST_BATCH)


def accepted_links(edges: DataFrame, rows: DataFrame) -> DataFrame:
    """``(node_a, node_b)`` of the edges that hold when all rows are known.

    A title whose end was cut off goes with the earliest title that it can be the
    beginning of, and no other: what was cut may have told two stories apart. A
    slip in a word that a later copy shows to be a name is none.
    """
    cut = edges.filter("kind = 'c'").groupBy("node_a").agg(F.min(F.struct("turn_b", "node_b")).alias("b")).select("node_a", F.col("b.node_b").alias("node_b"))
    near = edges.filter("kind = 'n'").select("node_a", "node_b", "at").distinct()
    ends = near.select(F.explode_outer(F.array("node_a", "node_b")).alias("node")).distinct()
    caps = (
        rows.filter("caps is not null").join(small(ends), "node", "left_semi").groupBy("node").agg(F.min(F.struct("turn", "caps")).alias("c")).select("node", F.col("c.caps").alias("caps"))
    )
    for end in ("node_a", "node_b"):
        side = caps.select(F.col("node").alias(end), F.col("caps").alias(f"caps_{end}"))
        near = near.join(side, end, "left")
    named = F.coalesce(F.try_element_at("caps_node_a", F.col("at")), F.lit(False)) | F.coalesce(F.try_element_at("caps_node_b", F.col("at")), F.lit(False))
    same = edges.filter("kind = 'l'").select("node_a", "node_b")
    return same.unionByName(cut).unionByName(near.filter(~named).select("node_a", "node_b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)``: the least node of each connected component of ``links (node_a, node_b)``.

    Alternates large-star and small-star steps until a round changes nothing; each
    round is checkpointed. The number of rounds is logarithmic in the longest chain.
    """
    edges = durable(
        links.select(F.greatest("node_a", "node_b").alias("u"), F.least("node_a", "node_b").alias("v")).filter("u != v").distinct()
    )
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h"), F.bit_xor(F.xxhash64("v", "u", F.lit(1))).alias("g")).first()
        if state == before or state.n == 0:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        fresh = large.join(small_least, "u")
        fresh = (
            fresh.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(fresh.select("u", F.col("m").alias("v")))
            .filter("u != v")
            .distinct()
        )
        edges = durable(fresh)
    return edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")


def repeats(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``(id_a, id_b, turn)`` of every index row that is not the earliest of its group; ``links`` of ``accepted_links``.

    Rows are the same if their canonical links or titles are equal, if their
    titles differ by one slip or if one is the other with its end cut off;
    sameness carries on. Rows without words in their title and without a link
    are alone.
    """
    roots = components(links)
    nodes = rows.groupBy("node").agg(F.min(F.struct("turn", "id")).alias("first"))
    placed = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # Only nodes of several rows or of a group have repeats; the earliest row of each group by its node.
    top = placed.groupBy("root").agg(F.min("first").alias("top"))
    earliest = placed.join(top, "root").select("node", "top")
    found = rows.select("id", "turn", "node").join(earliest, "node").filter("turn != top.turn or id != top.id")
    return found.select(F.col("top.id").alias("id_a"), F.col("id").alias("id_b"), "turn")


def find_repeats(df: DataFrame, key: str = "id", order: tuple[str, ...] = ("id",), batch: str | None = None, sources: DataFrame | None = None) -> DataFrame:
    """``(id_a, id_b, turn)`` of all articles that repeat an earlier one, new batches against a stored pivot table.

    The first batch is the history, from whose titles the pivots are chosen. The
    later ones wait together and are one arrival, in which each meets only what was
    stored up to it; see ``meet`` and ``repeats``. Extra columns of ``df`` are ignored; repeated rows repeat
    themselves; an empty table gives an empty result.
    """
    spark = df.sparkSession
    store = new_store(spark, [])
    # Links and titles are brought to their canonical form once, when they arrive; each batch is a partition of its own.
    index = articles_index(df, key, order, batch, sources)
    index.hint("rebalance", "batch").write.partitionBy("batch").parquet(f"{store.path}/rows")
    rows = spark.read.schema(index.schema).parquet(f"{store.path}/rows")
    sizes = rows.groupBy("batch").count().orderBy("batch").limit(MAX_BATCHES + 1).collect()
    if len(sizes) > MAX_BATCHES:
        raise ValueError(f"more than {MAX_BATCHES} batches")
    if sizes:
        store.pivots = choose_pivots(rows.filter(F.col("batch") == sizes[0].batch))
        # What a title is found by depends on the title alone: the batches that are there already are keyed in one pass.
        append_rows(store, rows)
    if sizes:
        meet(store, sizes[0].batch, sizes[0].batch, False)
        if len(sizes) > 1:
            n_new = sum(size["count"] for size in sizes[1:])
            meet(store, sizes[1].batch, sizes[-1].batch, n_new <= min(BROADCAST_BATCH, sizes[0]["count"] // BROADCAST_SHARE))
        found = durable(repeats(rows, durable(accepted_links(store.edges(), rows))))
    else:
        found = rows.select(F.col("id").alias("id_a"), F.col("id").alias("id_b"), "turn").limit(0)
        found = spark.createDataFrame([], found.schema)
    store.drop()
    return found
