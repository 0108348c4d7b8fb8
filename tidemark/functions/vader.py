"""Sentiment score of short texts by a lexicon table, after the published VADER algorithm (Hutto and Gilbert, 2014).

The lexicon is a parameter: ``word -> valence``. The algorithm's own constants
are those of the paper. The scorer works on Arrow batches.
"""

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A small original lexicon for tests and demos.
LEXICON = {
    "good": 1.9, "great": 3.1, "best": 3.2, "wins": 2.7, "won": 2.7, "opens": 0.8, "lifts": 1.2, "expands": 1.1, "safe": 1.9, "strong": 2.3,
    "bad": -2.5, "fines": -1.9, "fined": -1.9, "injured": -2.1, "leak": -1.6, "slip": -1.2, "cut": -1.1, "inquiry": -1.0, "blamed": -1.9,
    "faults": -1.7, "scraps": -1.3, "halts": -1.2, "complaints": -1.6, "fades": -1.0, "claim": -0.6, "risk": -1.1, "weak": -1.9, "strike": -0.7,
}
#: Fixed values of the published algorithm.
ALPHA, BOOST, NEGATE, CAPS = 15.0, 0.293, -0.74, 0.733
BOOSTERS = {"very": BOOST, "really": BOOST, "extremely": BOOST, "so": BOOST, "hardly": -BOOST, "slightly": -BOOST, "barely": -BOOST}
NEGATIONS = {"not", "no", "never", "without", "none", "nothing", "cannot", "isn't", "wasn't", "don't", "doesn't", "didn't", "won't"}


def score(text: str | None, lexicon: dict[str, float]) -> float | None:
    """Compound score in [-1, 1]; null for null or blank text, 0 for text without lexicon words."""
    if text is None or not text.strip():
        return None
    raw = re.findall(r"[\w'’-]+", text)
    low = [w.lower().replace("’", "'") for w in raw]
    shouting = any(w.isupper() for w in raw) and not all(w.isupper() for w in raw)
    values = []
    for i, w in enumerate(low):
        v = lexicon.get(w, 0.0)
        if v and w not in BOOSTERS:
            if shouting and raw[i].isupper():
                v += math.copysign(CAPS, v)
            for back, weight in ((1, 1.0), (2, 0.95), (3, 0.9)):
                if i >= back:
                    prior = low[i - back]
                    if prior in BOOSTERS:
                        v += math.copysign(BOOSTERS[prior] * weight, v) if BOOSTERS[prior] > 0 else -math.copysign(-BOOSTERS[prior] * weight, v)
                    if prior in NEGATIONS:
                        v *= NEGATE
        values.append(v)
    if "but" in low:
        at = low.index("but")
        values = [v * 0.5 if i < at else v * 1.5 if i > at else v for i, v in enumerate(values)]
    total = sum(values)
    marks = min(text.count("!"), 4) * 0.292 + (0 if text.count("?") < 2 else min(text.count("?") * 0.18, 0.96))
    total += math.copysign(marks, total) if total else 0.0
    return total / math.sqrt(total * total + ALPHA)


def compound(text: Column, lexicon: dict[str, float] | None = None) -> Column:
    """Column of ``score``, computed batch by batch."""
    import pandas as pd

    table = lexicon or LEXICON

    @F.pandas_udf(T.DoubleType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: score(t, table)).astype("float64")

    return run(text)
