"""Schemas that drift between files: changes reported, all lines in one table.

Each file's schema is a small graph: the file owns fields, a field has a name, a
type, nested names and values. Between a file and the one before it in its
stream, every field that went is paired with every field that came, and
similarity flooding settles the pairs' scores: they start from names, types,
nested names and agreeing values, and spread along equal edges of the two graphs
until nothing changes. Pairs that are best for both ends and score high enough
against a perfect pair are renames; the rest were removed and added.

Lines are parsed and reduced to (file, field) facts before anything is compared,
so a file of any size becomes as many rows as it has fields; values are compared
as hashes, and only for fields that went or came.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import durable, small

if TYPE_CHECKING:  # loaded in the workers only
    import pandas as pd

KINDS = ("string", "number", "boolean", "array", "object")


def _kind(value: Column) -> Column:
    """One of ``KINDS`` for a variant, null for a JSON null."""
    t = F.schema_of_variant(value)
    return (
        F.when(t == "VOID", None)
        .when(t == "STRING", "string")
        .when(t == "BOOLEAN", "boolean")
        .when(t.startswith("ARRAY"), "array")
        .when(t.startswith("OBJECT"), "object")
        .otherwise("number")
    )


def canonical_value(value: Column) -> Column:
    """Text by which two JSON values compare: numbers by amount however they are written, others as they are."""
    text = value.cast("string")
    number = text.try_cast("double")
    return F.when(number.isNotNull(), number.cast("string")).otherwise(text)


#: Fields that tell which lines of two files are the same: the first group of which a line has a value.
LINE_KEYS = (("url",), ("date", "ceo", "company"))


def parsed(df: DataFrame, keep: list[str], payload: str = "payload") -> DataFrame:
    """``keep`` and ``members`` (array of ``key, value``) of each JSON object line; other lines give no rows."""
    obj = df.select(*keep, F.try_parse_json(F.col(payload)).alias("doc")).filter(F.schema_of_variant("doc").startswith("OBJECT"))
    return obj.select(*keep, F.map_entries(F.col("doc").try_cast("map<string,variant>")).alias("members"))


def line_hash(members: Column, keys: tuple[tuple[str, ...], ...] = LINE_KEYS) -> Column:
    """A hash of the line's key fields, whatever their case; null for a line without any of them."""

    def text(name: str) -> Column:
        return F.get(F.filter(members, lambda e: F.lower(e["key"]) == name), 0)["value"].cast("string")

    whole = F.lit(None).cast("bigint")
    for names in reversed(keys):
        parts = [text(n) for n in names]
        whole = F.when(F.coalesce(*parts).isNotNull(), F.xxhash64(F.lit(len(names)), *parts)).otherwise(whole)
    return whole


def fields(df: DataFrame, keep: list[str], payload: str = "payload", keys: tuple[tuple[str, ...], ...] | None = None) -> DataFrame:
    """One row for each field of each JSON object line: ``keep``, ``field`` (lower case), ``name``, ``kind``, ``val`` (text), ``nested``.

    Lines that are no JSON objects give no rows. With ``keys`` a column ``line`` holds
    the hash of the line's key, taken once a line.
    """
    lines = parsed(df, keep, payload)
    if keys is not None:
        lines = lines.select(*keep, line_hash(F.col("members"), keys).alias("line"), "members")
        keep = [*keep, "line"]
    out = lines.select(*keep, F.explode_outer("members").alias("e")).filter("e is not null").select(*keep, F.col("e.key").alias("name"), F.col("e.value").alias("v"))
    kind = _kind(F.col("v"))
    nested = F.regexp_extract_all(F.schema_of_variant("v"), F.lit(r"[<,] ?([A-Za-z_][\w]*): "), F.lit(1))
    return out.select(
        *keep,
        F.lower("name").alias("field"),
        "name",
        kind.alias("kind"),
        F.col("v").cast("string").alias("val"),
        F.when(kind == "object", nested).alias("nested"),
    )


def file_order(df: DataFrame) -> DataFrame:
    """``(file_id, feed, stream, file_date, prev_id)`` of every file; one row a file, whatever its lines."""
    files = df.groupBy("file_id").agg(F.min("feed").alias("feed"), F.min("stream").alias("stream"), F.min("file_date").alias("file_date"))
    w = Window.partitionBy("feed", "stream").orderBy("file_date", "file_id")
    return files.withColumn("prev_id", F.lag("file_id").over(w))


def file_schemas(facts: DataFrame) -> DataFrame:
    """``(file_id, field, kind, nested)``: the kind most non-null values of the file have (ties: in the order of ``KINDS``)."""
    counted = facts.groupBy("file_id", "field", "kind").agg(F.count(F.lit(1)).alias("n"), F.max("nested").alias("nested"))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    best = F.max_by(
        F.struct("kind", "nested"), F.when(F.col("kind").isNotNull(), F.struct(F.col("n"), -rank))
    )
    return counted.groupBy("file_id", "field").agg(best.alias("b")).select("file_id", "field", "b.kind", "b.nested")


def _grams(name: str) -> set[str]:
    padded = f"  {name} "
    return {padded[i : i + 3] for i in range(len(padded) - 2)}


def name_similarity(a: str, b: str) -> float:
    """Share of common trigrams of two names."""
    x, y = _grams(a), _grams(b)
    return len(x & y) / max(1, len(x | y))


#: Weights of the edges of the propagation graph.
EDGES = {"schema": 0.1, "kind": 0.3, "values": 1.0, "member": 0.5}
#: What the likeness of names counts for against agreeing values.
NAME_WEIGHT = 0.25
#: Starting scores of two different kinds, and of values about which nothing is known.
OTHER_KIND, UNKNOWN_VALUES = 0.6, 0.3
#: Least score of a rename, against the pair of equal name, kind and values.
LEAST_SCORE = 0.48


def flood(pairs: pd.DataFrame, settled: float = 1e-6, rounds: int = 1_000_000) -> list[float]:
    """Similarity flooding over the candidate pairs of one schema change; each pair's score against a perfect pair.

    ``pairs`` has a row for each (old field, new field): ``old_name, field_name,
    old_kind, new_kind, old_nested, new_nested, agree`` (share of equal values, null
    if unknown). Nodes of the propagation graph are the pair of schemas, the pairs
    of fields, of kinds, of nested names, and each field pair's values; edges tie a
    field pair to the pairs of what its fields own. A node receives, over each
    kind of edge, the mean of its neighbours' scores, on top of its own starting
    score, until nothing changes by more than ``settled``. Agreement enters
    squared: most values are not nearly all. A perfect pair stands in the graph
    as the measure. Raises if the scores do not settle.
    """
    import numpy as np

    start, src, dst, weight, label = [], [], [], [], []

    def node(score: float) -> int:
        start.append(score)
        return len(start) - 1

    def tie(i: int, j: int, edge: str) -> None:
        for a, b in ((i, j), (j, i)):
            src.append(a)
            dst.append(b)
            weight.append(EDGES[edge])
            label.append(list(EDGES).index(edge))

    schema, kinds, members = node(1.0), {}, {}

    def add(name: float, agree: float, kind: tuple, same_kind: float, nested: list[tuple[tuple, float]]) -> int:
        pair = node(NAME_WEIGHT * name)
        tie(pair, schema, "schema")
        if kind not in kinds:
            kinds[kind] = node(same_kind)
        tie(pair, kinds[kind], "kind")
        tie(pair, node(agree), "values")
        for key, score in nested:
            if key not in members:
                members[key] = node(score)
            tie(pair, members[key], "member")
        return pair

    def listed(names: object) -> list[str]:
        return [] if names is None or (isinstance(names, float)) else list(names)

    perfect = add(1.0, 1.0, ("perfect",), 1.0, [])
    at = []
    for r in pairs.itertuples():
        agree = UNKNOWN_VALUES if r.agree is None or r.agree != r.agree else r.agree**2
        # each nested name with the one most like it
        nested = []
        for m in listed(r.old_nested):
            best = max(((name_similarity(m, o), o) for o in listed(r.new_nested)), default=None)
            if best:
                nested.append(((m, best[1]), best[0]))
        alike = 1.0 if r.old_kind == r.new_kind else OTHER_KIND
        at.append(add(name_similarity(r.old_name, r.field_name), agree, (r.old_kind, r.new_kind), alike, nested))
    src, dst, weight, label, start = map(np.array, (src, dst, weight, label, start))
    _, inverse, count = np.unique(dst * len(EDGES) + label, return_inverse=True, return_counts=True)
    weight = weight / count[inverse]
    fields_at = np.array([perfect, *at])
    score = start.copy()
    for _ in range(rounds):
        fresh = start + np.bincount(dst, weight * score[src], len(score))
        fresh /= fresh[fields_at].max()
        delta, score = np.abs(fresh - score).max(), fresh
        if delta < settled:
            return (score[at] / score[perfect]).tolist()
    raise RuntimeError("similarity flooding did not settle")


def select_pairs(pairs: pd.DataFrame, least: float) -> pd.DataFrame:
    """The best consistent pairs of ``least`` score and more: each field is in one pair, and no pair left out beats both its ends'."""
    pairs = pairs.assign(score=flood(pairs), alike=[name_similarity(a, b) for a, b in zip(pairs["old_name"], pairs["field_name"], strict=True)])
    good = pairs[pairs["score"] >= least].sort_values(["score", "alike", "old_name", "field_name"], ascending=[False, False, True, True])
    old, new, kept = set(), set(), []
    for row in good.itertuples():
        if row.old_name not in old and row.field_name not in new:
            old.add(row.old_name)
            new.add(row.field_name)
            kept.append(row.Index)
    return pairs.loc[kept]


def _match(least: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        import pandas as pd

        gone, came = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        told = {(r.old_name, r.field_name): (r.equal, r.either) for r in pdf[pdf["side"] == 2].itertuples()}
        rows = []
        for a in gone.sort_values("field").itertuples():
            for b in came.sort_values("field").itertuples():
                equal, either = told.get((a.field, b.field), (0, 0))
                # a few lines prove less than many
                agree = equal / (either + 0.2) if either > 0 else None
                rows.append((int(pdf["at"].iloc[0]), a.field, b.field, a.kind, b.kind, a.nested, b.nested, agree))
        names = ["file_id", "old_name", "field_name", "old_kind", "new_kind", "old_nested", "new_nested", "agree"]
        pairs = pd.DataFrame(rows, columns=names)
        return select_pairs(pairs, least)[["file_id", "field_name", "old_name", "score"]]

    return run


def schema_changes(df: DataFrame, keys: tuple[tuple[str, ...], ...] = LINE_KEYS, least: float = LEAST_SCORE) -> DataFrame:
    """``(file_id, change_kind, field_name, old_name)`` of each file against the one before it in its stream.

    ``df`` has ``file_id, feed, stream, file_date, payload``, one JSON object a
    line. ``keys`` tells which lines of two files are the same. Every field that
    went is a candidate for every field that came; a pair is a rename if similarity
    flooding (see ``flood``) gives it ``least`` or more and neither field a better
    partner; one old name goes to one new name. On lines that both files hold,
    values must nearly all agree; fields without such lines are matched by names,
    kinds and nesting alone. Names compare without case. The first file of a
    stream, files without readable lines and fields whose values are all null
    give no retyping. Extra columns of ``df`` are ignored; repeated lines count
    once in the comparison of values; an empty table gives an empty result.
    """
    return _changes(df, keys, least)[0]


def _changes(df: DataFrame, keys: tuple[tuple[str, ...], ...], least: float) -> tuple[DataFrame, DataFrame]:
    base = df.select("file_id", "feed", "stream", "file_date", "payload")
    # (file, field) facts and the files' order: small, and read by every comparison below.
    schemas = durable(file_schemas(fields(base, ["file_id"])))
    order = durable(file_order(base))
    links = order.filter("prev_id is not null").select("file_id", "prev_id")
    now = schemas.join(links, "file_id").select("file_id", "field", F.struct("kind", "nested").alias("now"))
    before = (
        schemas.withColumnRenamed("file_id", "prev_id")
        .join(links, "prev_id")
        .select("file_id", "field", F.struct("kind", "nested").alias("before"))
    )
    # Files without any readable field have no schema to compare with.
    seen = schemas.select("file_id").distinct()
    comparable = links.join(seen, "file_id", "left_semi").join(
        seen.withColumnRenamed("file_id", "prev_id"), "prev_id", "left_semi"
    )
    both = (
        now.unionByName(before, allowMissingColumns=True)
        .groupBy("file_id", "field")
        .agg(F.max("now").alias("now"), F.max("before").alias("before"))
        .join(comparable.select("file_id", "prev_id"), "file_id")
        .filter("now is null or before is null or now.kind != before.kind")
    )
    both = durable(both)
    moved = both.filter("now is null or before is null")
    gone = moved.filter("now is null").select("file_id", "prev_id", "field", F.lit(0).alias("side"), F.col("before.kind").alias("kind"), F.col("before.nested").alias("nested"))
    came = moved.filter("before is null").select("file_id", "prev_id", "field", F.lit(1).alias("side"), F.col("now.kind").alias("kind"), F.col("now.nested").alias("nested"))
    # Only transitions where something went and something came can hold a rename.
    turns = gone.select("file_id").distinct().join(came.select("file_id").distinct(), "file_id")
    sides = durable(gone.unionByName(came).join(turns, "file_id", "left_semi").withColumnRenamed("file_id", "at"))
    wanted = sides.select(F.when(F.col("side") == 0, F.col("prev_id")).otherwise(F.col("at")).alias("file_id"), "at", "side", "field")
    # Values of moved fields only, on lines of the files concerned; the rest is not parsed again.
    concerned = base.select("file_id", "payload").join(small(wanted.select("file_id").distinct()), "file_id", "left_semi")
    val = F.when(F.col("kind").isNotNull(), F.xxhash64(canonical_value(F.col("val"))))
    values = (
        fields(concerned, ["file_id"], keys=keys)
        .filter("line is not null")
        .join(small(wanted), ["file_id", "field"])
        .select("at", "line", "side", "field", val.alias("val"))
        .repartition("at", "line")
        .groupBy("at", "line", "side", "field")
        .agg(F.max("val").alias("val"))
        .groupBy("at", "line")
        # as many entries as the file has moved fields
        .agg(F.collect_list(F.when(F.col("side") == 0, F.struct("field", "val"))).alias("old"), F.collect_list(F.when(F.col("side") == 1, F.struct("field", "val"))).alias("new"))
    )
    crossed = F.flatten(F.transform("old", lambda o: F.transform("new", lambda n: F.struct(o.alias("o"), n.alias("n")))))
    agree = (
        values.select("at", F.explode_outer(crossed).alias("p"))
        .filter("p.o.val is not null or p.n.val is not null")
        .groupBy("at", F.col("p.o.field").alias("old_name"), F.col("p.n.field").alias("field_name"))
        .agg(F.count(F.lit(1)).alias("either"), F.count_if(F.col("p.o.val") == F.col("p.n.val")).alias("equal"))
        .withColumn("side", F.lit(2))
    )
    # One group is one file's change: at most (fields gone) x (fields new) rows, however long the file.
    renamed = (
        sides.select("at", "side", "field", "kind", "nested")
        .unionByName(agree, allowMissingColumns=True)
        .groupBy("at")
        .applyInPandas(_match(least), "file_id bigint, field_name string, old_name string, score double")
    )
    renames = durable(renamed).select("file_id", F.lit("renamed").alias("change_kind"), "field_name", "old_name")
    ends = renames.select("file_id", F.explode_outer(F.array("field_name", "old_name")).alias("field"))
    single = moved.join(ends, ["file_id", "field"], "left_anti").select(
        "file_id",
        F.when(F.col("before").isNull(), "added").otherwise("removed").alias("change_kind"),
        F.col("field").alias("field_name"),
        F.lit("").alias("old_name"),
    )
    retyped = both.filter("now.kind is not null and before.kind is not null and now.kind != before.kind").select(
        "file_id", F.lit("retyped").alias("change_kind"), F.col("field").alias("field_name"), F.lit("").alias("old_name")
    )
    return renames.unionByName(single).unionByName(retyped), order


def _chain(pdf: pd.DataFrame) -> pd.DataFrame:
    """Follows one stream's renames in file order: the name each file's field had when it first came."""
    import pandas as pd

    root: dict[str, str] = {}
    out = []
    for _, file in pdf.sort_values(["file_date", "file_id"]).groupby(["file_date", "file_id"], sort=True):
        moves = file[file["change_kind"] == "renamed"]
        fresh = {r.field_name: root.get(r.old_name, r.old_name) for r in moves.itertuples()}
        for gone in moves["old_name"]:
            root.pop(gone, None)
        for gone in file.loc[file["change_kind"] == "removed", "field_name"]:
            root.pop(gone, None)
        root.update(fresh)
        file_id = int(file["file_id"].iloc[0])
        out += [(file_id, name, first) for name, first in root.items() if name != first]
    return pd.DataFrame(out, columns=["file_id", "field", "canonical"])


def unified(df: DataFrame, columns: dict[str, str], keys: tuple[tuple[str, ...], ...] = LINE_KEYS, least: float = LEAST_SCORE) -> DataFrame:
    """All lines as one table: ``file_id, line_no``, ``columns`` (name to type) and ``extra``.

    A field renamed in its stream is found under the name it first had there.
    Objects of one member stand for that member's value. Values that cannot be
    cast are null in their column and stay, as text, in the map ``extra`` along
    with all fields that have no column. Unreadable lines give a row of nulls. Of
    names in a line that differ in case only, the last in order of value counts.
    Lines are recast where they are read: only the files' lists of new names
    are joined to them.
    """
    changes, order = _changes(df, keys, least)
    told = durable(changes).filter("change_kind in ('renamed', 'removed')").join(
        order.select("file_id", "feed", "stream", "file_date"), "file_id"
    )
    # The files between two changes carry the names of the last one: a stream's list of files is short.
    quiet = order.join(told.select("file_id").distinct(), "file_id", "left_anti").select(
        "file_id", "feed", "stream", "file_date", F.lit("none").alias("change_kind"), F.lit(None).cast("string").alias("field_name"), F.lit(None).cast("string").alias("old_name")
    )
    names = (
        told.unionByName(quiet)
        .groupBy("feed", "stream")
        .applyInPandas(_chain, "file_id bigint, field string, canonical string")
        .groupBy("file_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("field", "canonical"))).alias("names"))
    )
    doc = F.try_parse_json(F.col("payload"))
    lines = df.select("file_id", "line_no", F.when(F.schema_of_variant(doc).startswith("OBJECT"), doc).alias("doc"))
    lines = lines.join(small(durable(names)), "file_id", "left")

    def entry(e: Column) -> Column:
        low, v = F.lower(e["key"]), e["value"]
        kind = F.schema_of_variant(v)
        inner = F.map_values(v.try_cast("map<string,variant>"))
        plain = F.when(kind.startswith("OBJECT") & (F.size(inner) == 1), F.get(inner, 0).cast("string")).otherwise(v.cast("string"))
        name = F.coalesce(F.when(F.col("names").isNotNull(), F.try_element_at("names", low)), low)
        return F.struct(name.alias("field"), F.when(kind != "VOID", plain).alias("val"))

    listed = F.array_sort(F.transform(F.map_entries(F.col("doc").try_cast("map<string,variant>")), entry))
    flat = lines.select("file_id", "line_no", listed.alias("es"))
    last = F.filter("es", lambda e, i: F.get("es", i + 1).isNull() | (F.get("es", i + 1)["field"] != e["field"]))
    out = flat.select("file_id", "line_no", F.map_from_entries(last).alias("m"))
    cells = {name: F.col("m")[name].try_cast(kind) for name, kind in columns.items()}
    known = F.array(*map(F.lit, columns))
    lost = F.map_filter("m", lambda k, v: v.isNotNull() & ~F.array_contains(known, k))
    return out.select("file_id", "line_no", *(c.alias(n) for n, c in cells.items()), lost.alias("extra"))
