"""Name normalisers. Feeds disagree on what a name's key is, so the profiles are kept apart and are parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of legal form that carry no identity.
FORM_TOKENS = (
    "inc incorporated corp corporation co company llc plc ltd limited group holdings holding hldgs exchange insurance".split()
)
INGEST_TOKENS = [*FORM_TOKENS, "the"]
CEO_TOKENS = [*FORM_TOKENS, "ag", "sa", "nv"]
#: Trailing forms that are cut as text.
TAILS = [" Inc.", " Inc", " Corporation", " Corp.", " Corp", " Company", " Co.", " Co", " LLC", " L.L.C.", " Ltd.", " Ltd", " Limited", " PLC", " plc", ".com", ".net", ".org"]
AGGREGATE_TAILS = [" Inc.", " Inc", " Corporation", " Corp.", " Corp", " Company", " Co.", " Co", " LLC", " L.L.C.", " LP", " L.P.", " Ltd.", " Ltd", " Limited", " PLC", " plc", ".com", ".net", ".org"]
ALERT_TAILS = [" Inc.", " Inc", " Corporation", " Corp.", " Corp", " Company", " Co.", " Co", " LLC", " L.L.C.", " Ltd.", " Ltd", " PLC", " plc", " Group", " Holdings", " .com"]
#: Words of no weight in handles and publisher names.
IGNORED = "inc incorporated corporation corp company co llc ltd limited plc group holdings holding the and of services".split()


def alternation(tails: list[str]) -> str:
    longest = sorted(tails, key=len, reverse=True)
    return "(?:" + "|".join(t.replace(".", r"\.") for t in longest) + ")$"


def _collapsed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def without_tokens(text: Column, tokens: list[str]) -> Column:
    """Space-separated words of ``text`` that are not in ``tokens``, repeats kept."""
    return F.array_join(F.filter(F.split(text, " "), lambda t: (t != "") & ~t.isin(tokens)), " ")


def _plain(name: Column) -> Column:
    text = F.replace(F.trim(F.coalesce(name, F.lit(""))), F.lit("&"), F.lit(" and "))
    for domain in (".com", ".net", ".org"):
        text = F.replace(text, F.lit(domain), F.lit(" "))
    return text


def ingest_key(name: Column) -> Column:
    """Ampersand spelled out, domain endings dropped, lower case, anything but ASCII letters and digits a space."""
    return _collapsed(F.regexp_replace(F.lower(_plain(name)), r"[^a-z0-9\s]+", " "))


def ingest_simple(name: Column) -> Column:
    """``ingest_key`` without words of legal form."""
    return without_tokens(ingest_key(name), INGEST_TOKENS)


def feature_key(name: Column) -> Column:
    """One trailing legal form cut, punctuation deleted, lower case."""
    cut = F.trim(F.regexp_replace(F.trim(F.coalesce(name, F.lit(""))), "(?i)" + alternation(TAILS), ""))
    return F.trim(F.regexp_replace(F.lower(cut), r"[^\p{L}\p{N}\s]", ""))


def serp_brand_key(name: Column) -> Column:
    """Like ``ingest_key`` but punctuation is deleted, so ``Coca-Cola`` is one word."""
    return _collapsed(F.regexp_replace(F.lower(_plain(name)), r"[^\p{L}\p{N}\s]", ""))


def serp_brand_simple(name: Column) -> Column:
    """``serp_brand_key`` without words of legal form."""
    return without_tokens(serp_brand_key(name), FORM_TOKENS)


def serp_ceo_key(name: Column) -> Column:
    """Lower case, anything but ASCII letters and digits a space."""
    return _collapsed(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), r"[^a-z0-9\s]+", " "))


def serp_ceo_simple(name: Column) -> Column:
    """``serp_ceo_key`` without words of legal form."""
    return without_tokens(serp_ceo_key(name), CEO_TOKENS)


def aggregate_key(name: Column, aliases: dict[str, str] | None = None) -> Column:
    """Alias looked up first, then every legal form cut once in list order, punctuation deleted; case is kept."""
    text = F.trim(F.coalesce(name, F.lit("")))
    if aliases:
        table = F.create_map(*(F.lit(x) for k, v in aliases.items() for x in (k, v)))
        text = F.coalesce(F.try_element_at(table, F.lower(text)), text)
    out = text
    # one reference to the inner expression a step, so the chain stays linear
    for tail in AGGREGATE_TAILS:
        out = F.trim(F.regexp_replace(out, tail.replace(".", r"\.") + "$", ""))
    out = _collapsed(F.regexp_replace(out, r"[^\p{L}\p{N}_\s]", ""))
    return F.when(text == "nan", "").otherwise(out)


def alert_key(name: Column) -> Column:
    """One trailing form cut, among them Group and Holdings; punctuation deleted, case kept."""
    cut = F.trim(F.regexp_replace(F.trim(F.coalesce(name, F.lit(""))), "(?i)" + alternation(ALERT_TAILS), ""))
    return F.regexp_replace(cut, r"[^\p{L}\p{N}_\s]", "")


def crm_key(name: Column, suffixes: list[str] | None = None) -> Column:
    """Lower-case ASCII tokens without words of legal form."""
    text = F.replace(F.lower(F.coalesce(name, F.lit(""))), F.lit("&"), F.lit(" and "))
    return without_tokens(F.regexp_replace(text, "[^a-z0-9]+", " "), suffixes or FORM_TOKENS)


@dataclass(frozen=True)
class Profile:
    """A pair of name keys: the full one and the one without legal forms."""

    key: object
    simple: object


PROFILES = {"ingest": Profile(ingest_key, ingest_simple), "serp_brand": Profile(serp_brand_key, serp_brand_simple), "serp_ceo": Profile(serp_ceo_key, serp_ceo_simple)}


def token(text: Column) -> Column:
    """Letters and digits only, lower case."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]", "")


def name_tokens(text: Column, min_len: int = 4) -> Column:
    """Words of at least ``min_len`` letters or digits that carry weight."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}]+"), token)
    return F.filter(parts, lambda t: (F.length(t) >= min_len) & ~t.isin(IGNORED))


def handle_tokens(text: Column, person: bool = False) -> Column:
    """Forms in which a name may stand in an account handle, sorted.

    The whole name run together and its first two words; for persons also the
    last two words, the first and the last one.
    """
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}_]+"), lambda w: w != "")
    n = F.size(parts)

    def run(a: Column) -> Column:
        return token(F.array_join(a, ""))

    forms = [token(text), F.when(n >= 2, run(F.slice(parts, 1, 2))) if person else run(F.slice(parts, 1, 2))]
    if person:
        forms += [F.when(n >= 2, run(F.slice(parts, F.greatest(n - 1, F.lit(1)), 2))), token(F.get(parts, 0)), token(F.get(parts, n - 1))]
    least = 3 if person else 4
    return F.array_sort(F.array_distinct(F.filter(F.array(*forms), lambda t: t.isNotNull() & (F.length(t) >= least))))


def split_alias(text: Column) -> Column:
    """Aliases of a cell parted by pipes or semicolons, trimmed, empty ones dropped."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"[|;]+"), lambda x: F.trim(x)), lambda a: a != "")


def headline_cut(title: Column, most: int = 80) -> Column:
    """A title of more than ``most`` characters cut to that length with three dots."""
    return F.when(F.length(title) > most, F.concat(F.left(title, F.lit(most - 3)), F.lit("..."))).otherwise(title)


def without_terms(text: Column, pattern: str) -> Column:
    """Text without the matches of ``pattern``, blanks collapsed."""
    return _collapsed(F.regexp_replace(F.coalesce(text, F.lit("")), pattern, " "))


def clean_text(text: Column) -> Column:
    """Blank text and ``nan`` empty, blanks collapsed."""
    out = _collapsed(F.coalesce(text, F.lit("")))
    return F.when(F.lower(out) == "nan", "").otherwise(out)
