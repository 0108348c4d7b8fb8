"""All queries outside the subpackage ``llm`` and their SQL."""

from tidemark.plans import extended, preparation, reference

QUERIES = {**reference.QUERIES, **extended.QUERIES, **preparation.QUERIES}
ORACLES = {**reference.ORACLES, **extended.ORACLES, **preparation.ORACLES}
