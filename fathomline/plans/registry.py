"""All registered queries and their SQL twins."""

from __future__ import annotations

from fathomline.plans import comparisons, experiments, qualities, rollups, searches, texts, trainings

_MODULES = (rollups, experiments, texts, searches, comparisons, trainings, qualities)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
