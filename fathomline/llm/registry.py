"""All queries of this subpackage and their SQL twins."""

from __future__ import annotations

import corpus_pipeline
from fathomline.llm import queries

QUERIES = queries.QUERIES | {"pipeline": corpus_pipeline.run}
ORACLE = queries.ORACLE | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
