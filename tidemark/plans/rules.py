"""A rule engine over text: term tables become boolean columns, cascades become one CASE.

Term lists are data with a version, not code: a ``Terms`` table maps a rule's
name to its words. ``DEFAULT`` is a small neutral set for tests and demos; real
deployments pass their own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import handle_tokens, name_tokens, token
from tidemark.functions.urls import host, host_matches


@dataclass(frozen=True)
class Terms:
    """Term lists by rule; each entry is a literal phrase or, if it starts with ``re:``, a pattern."""

    version: str
    lists: dict[str, list[str]] = field(default_factory=dict)

    def pattern(self, name: str) -> str:
        """One case-insensitive alternation of whole words for a list."""
        parts = [t[3:] if t.startswith("re:") else t.replace(" ", r"\s+") for t in self.lists.get(name, [])]
        return rf"(?i)(?:^|[^\p{{L}}\p{{N}}_])(?:{'|'.join(parts)})(?:$|[^\p{{L}}\p{{N}}_])" if parts else "(?!)"


DEFAULT = Terms(
    "demo_1",
    {
        "finance": ["shares", "outlook", "report", "stock", "analysts", "debt"],
        "material": ["court", "fines", "inquiry", "leak", "injured"],
        "legal": ["court", "claim", "regulator", "inquiry"],
        "workforce": ["jobs", "staff", "walk out"],
        "blockers": ["injured", "court"],
        "neutral_title": ["tender", "deal", "opens"],
        "safety": ["injured", "recalls", "leak"],
        "governance": ["inquiry", "named", "boss", "chief"],
        "labour": ["jobs", "staff", "walk"],
        "deals": ["deal", "venture", "programme"],
        "growth": ["opens", "expands", "lifts"],
    },
)


def haystack(*parts: Column) -> Column:
    """Non-empty texts joined by a space."""
    return F.concat_ws(" ", *(F.nullif(F.trim(F.coalesce(p, F.lit(""))), F.lit("")) for p in parts))


def flags(df: DataFrame, title: str, snippet: str, source: str, url: str, terms: Terms = DEFAULT, forced_hosts: tuple[str, ...] = (), finance_hosts: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the rule columns ``r_finance, r_material, r_low, r_legal, r_neutral_title, r_forced``.

    A low-priority story has workforce words and no blocker. A legal story has a
    legal word and is no low-priority one; a forced host makes it legal in any case.
    Each rule is materialised once, before any cascade reads it.
    """
    h = host(F.col(url))
    text = haystack(F.col(title), F.col(snippet), F.col(source), F.col(url))
    head = haystack(F.col(title), F.col(snippet))
    short = haystack(F.col(title), F.col(snippet), F.col(source))
    forced = F.lit(False)
    for d in forced_hosts:
        forced = forced | host_matches(h, d)
    money = F.lit(False)
    for d in finance_hosts:
        money = money | host_matches(h, d)
    low = head.rlike(terms.pattern("workforce")) & ~head.rlike(terms.pattern("blockers"))
    out = df.withColumns(
        {
            "r_finance": short.rlike(terms.pattern("finance")) | money,
            "r_material": head.rlike(terms.pattern("material")),
            "r_low": low,
            "r_forced": forced,
            "r_neutral_title": F.coalesce(F.col(title), F.lit("")).rlike(terms.pattern("neutral_title")),
            "r_law": text.rlike(terms.pattern("legal")),
        }
    )
    return out.withColumn("r_legal", F.col("r_forced") | (~F.col("r_low") & F.col("r_law"))).drop("r_law")


def neutralised(label: Column) -> Column:
    """Whether a positive or negative label gives way: low priority, or finance without material risk."""
    return label.isin("positive", "negative") & (F.col("r_low") | (F.col("r_finance") & ~F.col("r_material")))


def sentiment_of(compound: Column, positive: float = 0.15, negative: float = -0.10) -> Column:
    """Label of a score; an absent score is neutral."""
    return F.when(compound >= positive, "positive").when(compound <= negative, "negative").otherwise("neutral")


def cascade(compound: Column, controlled: Column, reddit: Column) -> Column:
    """Final label: forum posts negative, legal negative, finance neutral, neutral titles neutral, else the score; owned pages positive."""
    inner = (
        F.when(reddit, "negative").when(F.col("r_legal"), "negative").when(F.col("r_finance"), "neutral").when(F.col("r_neutral_title"), "neutral").otherwise(sentiment_of(compound))
    )
    return F.when(controlled, "positive").otherwise(inner)


def uncertain_reason(label: Column, compound: Column, title: Column, finance: Column, forced: Column, short: int = 6, low: float = 0.2) -> Column:
    """Why a label is doubtful: ``low_compound``, ``short_title`` or null."""
    words = F.size(F.filter(F.split(F.trim(F.coalesce(title, F.lit(""))), r"\s+"), lambda w: w != ""))
    brief = F.when(words <= short, "short_title")
    inner = F.when(compound.isNull(), brief).when(F.abs(compound) < low, "low_compound").otherwise(brief)
    return F.when(~finance & ~forced & label.isin("negative", "neutral"), inner)


def publisher_matches(company: Column, publisher: Column, suffixes: tuple[str, ...] = ("news", "newsroom", "media", "press", "wire", "blog", "official")) -> Column:
    """Whether a publisher's name is the company's own: equal, two words shared, or its single word with a media suffix."""
    a, b = name_tokens(company, 3), name_tokens(publisher, 3)
    same = (token(company) != "") & (token(company) == token(publisher))
    shared = (F.size(a) >= 2) & (F.size(F.array_except(a, b)) == 0)
    single = (F.size(a) == 1) & F.array_contains(b, F.get(a, 0)) & (F.size(F.array_except(F.array_except(b, a), F.array(*map(F.lit, suffixes)))) == 0)
    return F.coalesce(same | shared | single, F.lit(False))


def byline(text: Column, platform: str) -> Column:
    """The name in the last ``by <name> on <platform>`` of a text."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit(rf"(?i)\bby\s+(.{{2,120}}?)\s+on\s+{platform}\b"), F.lit(1)), F.lit(-1))


def control_class(company: Column, publisher: Column, url: Column, title: Column, domains: Column) -> Column:
    """``controlled`` or ``uncontrolled`` by an ordered cascade; the first arm that applies decides.

    Publisher match; no host; profile pages of the social platforms by handle
    (reels never, single posts by byline only); app stores; the company's own
    domains (an array column); a company word that is a label of the host.
    """
    h = host(url)
    path = F.lower(F.regexp_extract(url, r"^[A-Za-z]+://[^/]+(/[^?#]*)", 1))
    names = handle_tokens(company)
    first = token(F.regexp_extract(path, r"^/@?([^/]+)", 1))
    own_handle = F.exists(names, lambda t: F.contains(first, t) & (first != ""))
    post = publisher_matches(company, byline(title, "(?:facebook|instagram|x|youtube|linkedin|threads)"))
    social = F.lit(False)
    for d in ("facebook.com", "instagram.com", "threads.net", "youtube.com", "linkedin.com", "x.com", "twitter.com", "tiktok.com"):
        social = social | host_matches(h, d)
    store = host_matches(h, "play.google.com") | host_matches(h, "apps.apple.com")
    mine = F.exists(domains, lambda d: host_matches(h, d))
    labels = F.split(h, r"\.")
    word = F.exists(names, lambda t: F.array_contains(F.slice(labels, 1, F.greatest(F.size(labels) - 1, F.lit(1))), t))
    yes = (
        F.when(publisher_matches(company, publisher), True)
        .when(h == "", False)
        .when(host_matches(h, "instagram.com") & path.startswith("/reel"), False)
        .when(social & path.rlike("/(?:p|posts?|status|photos?|videos?|watch)(?:/|$)"), post)
        .when(social, own_handle)
        .when(store, True)
        .when(F.coalesce(mine, F.lit(False)), True)
        .when(word, True)
        .otherwise(False)
    )
    return F.when(yes, "controlled").otherwise("uncontrolled")


def narrative(text: Column, terms: Terms, crisis: tuple[str, ...], other: tuple[str, ...]) -> Column:
    """Struct ``(primary_tag, primary_group, tags, is_crisis, rule_version)``; crisis tags come first."""
    hits = F.array_compact(F.array(*(F.when(text.rlike(terms.pattern(t)), F.lit(t)) for t in (*crisis, *other))))
    tag = F.get(hits, 0)
    bad = F.coalesce(tag.isin(*crisis), F.lit(False))
    return F.struct(
        tag.alias("primary_tag"),
        F.when(tag.isNull(), None).when(bad, "crisis").otherwise("non_crisis").alias("primary_group"),
        hits.alias("tags"),
        bad.alias("is_crisis"),
        F.lit(terms.version).alias("rule_version"),
    )


def narrative_day(df: DataFrame, keys: list[str], least: int = 2) -> DataFrame:
    """Per entity and day: candidates, and if there are at least ``least``, the tag most items have as their first.

    ``df`` holds one row an item with ``tag`` (its primary tag, may be null) and ``candidate``.
    Ties go to the tag first by name; where no candidate has a tag and two have
    none, it is ``Other``.
    """
    c = df.filter("candidate")
    per = c.groupBy(*keys, "tag").agg(F.count(F.lit(1)).alias("n"))
    top = per.groupBy(*keys).agg(
        F.sum("n").alias("candidates"),
        F.max(F.when(F.col("tag").isNotNull(), F.col("n"))).alias("most"),
        F.sum(F.when(F.col("tag").isNull(), F.col("n")).otherwise(0)).alias("untagged"),
    )
    first = per.join(top.select(*keys, "most"), keys).filter("tag is not null and n = most").groupBy(*keys).agg(F.min("tag").alias("tag"))
    out = top.join(first, keys, "left")
    pass_ = F.col("candidates") >= max(1, least)
    tag = F.coalesce("tag", F.when(F.col("untagged") >= 2, "Other"))
    return out.select(*keys, "candidates", pass_.alias("passed"), F.when(pass_, tag).alias("primary_tag"))
