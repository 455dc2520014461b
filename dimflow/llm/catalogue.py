"""All queries of this subpackage and of the pipeline, by name, and their SQL."""

from __future__ import annotations

from corpus_pipeline import ORACLE_SQL, run
from dimflow.llm import alignment, bpe, decontaminate, langid, neardup, quality, sharding, spelling, suffixes, token_counts, token_files, urls, warc  # noqa: F401
from dimflow.llm.common import REGISTRY
from dimflow.llm.oracles import ORACLES

QUERIES = {**dict(sorted(REGISTRY.items(), key=lambda q: int(q[0][2:].split("_")[0]))), "pipeline": run}
SQL = {**ORACLES, **({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})}
