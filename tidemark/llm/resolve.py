"""Free-entered names mapped to a canonical list by token-level repair.

Distinct values are cut into tokens; each distinct token is joined to the
vocabulary of the reference list by edit distance (one edit, a swap of
neighbours being one); the repaired tokens of a value then vote for entries by
soft TF-IDF, and an entry wins if its distinguishing token is there and no other
entry fits as well. Tickers and web addresses are tokens of their own kind.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import fold
from tidemark.session import durable, small

#: Words of legal form, and words that firms add without another meaning.
LEGAL = (
    "inc incorporated corp corporation co company ltd limited llc lp llp plc ag sa nv se gmbh kg spa ab oy as pty "
    "holdings holding group intl international the of and s"
).split()


@dataclass(frozen=True)
class Habits:
    """How the addresses and abbreviations of a reference list are written; what a list does not have is left empty.

    ``host_tails`` are words that firms hang onto their web names, ``top_levels`` the
    top-level domains that count in any case of letters (others in lower case
    only, as ``DRST.QX`` is a ticker), ``label_cut`` the number of letters of a
    name's second word that a web name may add to the first; 0 for none.
    """

    host_tails: tuple[str, ...] = ()
    top_levels: tuple[str, ...] = ("com", "net", "org")
    label_cut: int = 0

    def address(self) -> str:
        return rf"(?:(?i:https?)://)?(?:[A-Za-z0-9-]+\.)+(?:(?i:{'|'.join(self.top_levels)})|[a-z]{{2}})(?:/\S*)?(?=[\s)\"”’]|$)"

    def bare(self, host: str) -> Column:
        """The name within a host: without its top level and the words hung onto it."""
        label = F.regexp_replace(host, r"\.[a-z.]+$", "")
        return F.regexp_replace(label, f"(?:-?(?:{'|'.join(self.host_tails)}))$", "") if self.host_tails else label


#: Longest reference list that is sent to the executors.
MAX_BROADCAST_ENTRIES = 10_000


def name_tokens(text: Column) -> Column:
    """Folded letters-and-digits tokens of a name; words run together in camel case are parted, dotted initials joined."""
    parted = F.regexp_replace(text, r"(?<=\p{Ll})(?=\p{Lu}\p{Ll})", " ")
    joined = F.regexp_replace(parted, r"(?<=\b\p{L})\.(?=\p{L}\b)", "")
    return F.filter(F.split(fold(joined), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def deletions(token: Column) -> Column:
    """The token and every form of it that lacks one character: tokens one edit apart share one of these."""
    cuts = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(token), F.lit(1))),
        lambda i: F.concat(F.substring(token, F.lit(1), i - 1), F.substring(token, i + 1, F.length(token))),
    )
    return F.array_distinct(F.concat(F.array(token), cuts))


def one_edit(a: Column, b: Column) -> Column:
    """Whether two tokens differ by at most one insertion, deletion, change or swap of neighbours."""
    near = F.levenshtein(a, b)
    n = F.length(a)
    first = F.try_element_at(
        F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1))), F.lit(1)
    )
    swapped = F.concat(
        F.substring(a, F.lit(1), first - 1), F.substring(a, first + 1, F.lit(1)), F.substring(a, first, F.lit(1)), F.substring(a, first + 2, n)
    )
    return (near <= 1) | ((near == 2) & (n == F.length(b)) & F.coalesce(swapped == b, F.lit(False)))


def reference_tokens(entries: DataFrame) -> DataFrame:
    """``(token, entry, idf, head, later)`` of the reference list.

    ``entries`` has ``id, name, ticker, hosts`` (array of host names). ``head`` marks
    an entry's distinguishing token, its rarest word (the first on a tie); the
    other words of a name tell entries with one head apart. Words of legal form
    are left out unless a name has no others. ``later`` marks words that are not
    the first of a name: these are the ones that people abbreviate.
    """
    legal = F.array(*map(F.lit, LEGAL))
    base = entries.select("id", "name", "ticker", "hosts", name_tokens(F.col("name")).alias("all_tokens"))
    core = F.filter("all_tokens", lambda t: ~F.array_contains(legal, t))
    base = base.withColumn("tokens", F.when(F.size(core) > 0, core).otherwise(F.col("all_tokens")))
    total = base.agg(F.count(F.lit(1)).alias("entries"))
    flat = base.select("id", F.posexplode_outer("tokens").alias("at", "token"))
    df = flat.groupBy("token").agg(F.countDistinct("id").alias("df"))
    scored = flat.join(df, "token").crossJoin(F.broadcast(total))
    scored = scored.withColumn("idf", F.log(1 + F.col("entries") / F.col("df")))
    rarest = Window.partitionBy("id").orderBy("df", "at")
    words = scored.withColumn("head", F.row_number().over(rarest) == 1).select("token", F.col("id").alias("entry"), "idf", "head", (F.col("at") > 0).alias("later"))
    return words.groupBy("token", "entry").agg(F.max("idf").alias("idf"), F.max("head").alias("head"), F.max("later").alias("later"))


def address_keys(entries: DataFrame, habits: Habits = Habits()) -> DataFrame:
    """``(key, entry)``: host names of entries, their bare labels, and the labels their names make.

    A name makes its first word, that word with the first ``label_cut`` letters of
    the second, and all words run together. A key of several entries stays with all.
    """
    host = F.explode_outer("hosts")
    hosts = entries.select(F.col("id").alias("entry"), host.alias("host"))
    label = habits.bare("host")
    listed = hosts.select("entry", F.explode_outer(F.array("host", label)).alias("key"), F.lit(0).alias("rank"))
    t = name_tokens(F.col("name"))
    made = entries.select(
        F.col("id").alias("entry"),
        F.explode_outer(
            F.array(F.get(t, 0), F.concat(F.get(t, 0), F.substring(F.coalesce(F.get(t, 1), F.lit("")), 1, habits.label_cut)), F.array_join(t, ""))
        ).alias("key"),
        F.lit(1).alias("rank"),
    )
    both = listed.unionByName(made).filter("key is not null and key != ''").groupBy("key", "entry").agg(F.min("rank").alias("rank"))
    best = Window.partitionBy("key")
    return both.withColumn("top", F.min("rank").over(best)).filter("rank = top").select("key", "entry")


def hosts_of(text: Column) -> Column:
    """Host names within a text, lower case, without ``www.``."""
    found = F.regexp_extract_all(
        F.lower(text), F.lit(r"(?:https?://)?((?:[a-z0-9](?:[a-z0-9-]*[a-z0-9])?\.)+[a-z]{2,})(?=[/:?#\s)\"”’]|$)"), F.lit(1)
    )
    return F.transform(found, lambda h: F.regexp_replace(h, r"^www\.", ""))


def resolve_values(values: DataFrame, entries: DataFrame, people: DataFrame | None = None, habits: Habits = Habits()) -> DataFrame:
    """``(value, entry)`` for each distinct non-blank value of ``values.value``; ``entry`` is ``''`` if unmatched.

    ``entries`` is the reference list (``id, name, ticker, hosts``), ``people`` (``name``)
    holds names of persons that may stand beside an entry's name and count for
    nothing. Evidence, in this order: a web address of an entry; an entry's
    distinguishing word, one edit allowed where it has four letters or more; an
    entry's ticker in capitals. Words beside it (news, shares, persons) change
    nothing. Where several entries share the evidence, the other words of the
    names decide, also abbreviated; if they do not, the value fits several and is
    unmatched. The reference list is broadcast if it is within the size limit.
    """
    distinct = values.select("value").filter("value is not null").distinct().filter(F.regexp_replace("value", r"[\s\p{Z}\p{Cf}]+", "") != "")
    legal = F.array(*map(F.lit, LEGAL))
    toks = durable(distinct).select("value", hosts_of(F.col("value")).alias("hosts"), F.regexp_replace("value", habits.address(), " ").alias("rest"))

    # Everything made from the reference list is bounded by it: one check of its size serves all joins.
    within = entries.limit(MAX_BROADCAST_ENTRIES + 1).count() <= MAX_BROADCAST_ENTRIES
    hint = F.broadcast if within else (lambda d: d)
    ref = durable(reference_tokens(entries))
    # 1. web addresses
    keys = durable(address_keys(entries, habits))
    host = toks.select("value", F.explode_outer("hosts").alias("host"))
    label = habits.bare("host")
    full = F.regexp_replace("host", r"\.[a-z.]+$", "")
    by_host = (
        host.select("value", F.posexplode_outer(F.array("host", full, label)).alias("rank", "key"))
        .join(hint(keys), "key")
        .groupBy("value", "entry")
        .agg(F.min("rank").alias("rank"))
    )
    hosts = by_host.withColumn("top", F.min("rank").over(Window.partitionBy("value"))).filter("rank = top")
    hosts = hosts.select("value", "entry", F.lit(3).alias("grade"), F.lit(1.0).alias("score"))

    # 2. words: each distinct token is repaired once
    exploded = toks.select("value", F.posexplode_outer(name_tokens(F.col("rest"))).alias("at", "token")).filter("token is not null")
    if people is not None:
        pairs = people.select(name_tokens(F.col("name")).alias("t")).filter("size(t) >= 2")
        pairs = pairs.select(F.get("t", 0).alias("p0"), F.try_element_at("t", F.lit(-1)).alias("p1")).distinct()
        nxt = exploded.withColumn("next", F.lead("token").over(Window.partitionBy("value").orderBy("at")))
        named = nxt.join(small(pairs), (F.col("token") == F.col("p0")) & (F.col("next") == F.col("p1")))
        person = named.select("value", F.explode_outer(F.array("at", F.col("at") + 1)).alias("at")).distinct()
        exploded = exploded.join(person, ["value", "at"], "left_anti")
    vocab = ref.groupBy("token").agg(F.max("idf").alias("idf"), F.max("later").alias("later"))
    seen = exploded.select("token").distinct()
    exact = seen.join(hint(vocab.select("token")), "token", "left_semi").select("token", F.col("token").alias("word"), F.lit(1.0).alias("sim"))
    odd = seen.join(hint(vocab.select("token")), "token", "left_anti")
    variants = vocab.filter("length(token) >= 4").select(F.col("token").alias("word"), F.explode_outer(deletions(F.col("token"))).alias("form"))
    repaired = (
        odd.filter("length(token) >= 4")
        .select("token", F.explode_outer(deletions(F.col("token"))).alias("form"))
        .join(hint(variants), "form")
        .select("token", "word")
        .distinct()
        .filter(one_edit(F.col("token"), F.col("word")))
        .withColumn("sim", 1 - 1 / F.greatest(F.length("token"), F.length("word")))
    )
    # Abbreviations of words after the first: their letters in order, same first letter.
    plain = vocab.filter("later and length(token) >= 4").select(F.col("token").alias("word"), F.substring("token", 1, 1).alias("initial"))
    short = odd.filter("length(token) between 2 and 6").withColumn("initial", F.substring("token", 1, 1)).join(hint(plain), "initial")
    gaps = F.concat(F.lit("^"), F.regexp_replace("token", "(.)", "$1.*"))
    short = short.filter(F.expr("length(word) > length(token)") & F.rlike(F.col("word"), gaps))
    # A cut word (hosp) says more than skipped letters (engy).
    short = short.select("token", "word", F.when(F.col("word").startswith(F.col("token")), 0.8).otherwise(0.6).alias("sim"))
    fixes = exact.unionByName(repaired).unionByName(short).groupBy("token", "word").agg(F.max("sim").alias("sim"))
    votes = (
        exploded.join(fixes, "token")
        .groupBy("value", "word")
        .agg(F.max("sim").alias("sim"))
        .join(hint(ref.withColumnRenamed("token", "word")), "word")
        .filter(~F.array_contains(legal, F.col("word")) | F.col("head"))
        .groupBy("value", "entry")
        .agg(F.sum(F.col("sim") * F.col("idf")).alias("score"), F.max(F.when(F.col("head"), F.col("sim")).otherwise(0.0)).alias("head_sim"))
        .filter("head_sim >= 0.7")
    )
    # An exact head beats a repaired one, whatever else agrees.
    words = votes.select("value", "entry", F.lit(2).alias("grade"), (F.when(F.col("head_sim") == 1.0, 100.0).otherwise(0.0) + F.col("score")).alias("score"))

    # 3. tickers, in capitals
    caps = toks.select("value", F.explode_outer(F.array_distinct(F.regexp_extract_all("rest", F.lit(r"(?<![A-Za-z0-9])([A-Z]{2,6})(?![a-z0-9])"), F.lit(1)))).alias("ticker"))
    listed = entries.filter("ticker is not null and ticker != ''").select("ticker", F.col("id").alias("entry")).distinct()
    tickers = caps.join(hint(listed), "ticker").select("value", "entry", F.lit(1).alias("grade"), F.lit(1.0).alias("score"))

    found = hosts.unionByName(words).unionByName(tickers).groupBy("value", "grade", "entry").agg(F.max("score").alias("score"))
    w = Window.partitionBy("value")
    ranked = found.withColumn("top_grade", F.max("grade").over(w)).filter("grade = top_grade").withColumn("top", F.max("score").over(w))
    # Entries that share the address or ticker are told apart by nothing else; equal scores fit equally well.
    best = ranked.filter("score >= top - 1e-9").groupBy("value").agg(F.countDistinct("entry").alias("n"), F.min("entry").alias("one"))
    chosen = best.select("value", F.when(F.col("n") == 1, F.col("one")).otherwise("").alias("entry"))
    return toks.select("value").join(chosen, "value", "left").select("value", F.coalesce("entry", F.lit("")).alias("entry"))
