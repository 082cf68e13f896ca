"""All queries of the engine's own operators, by name."""

from __future__ import annotations

from studyloom.plans import files, identity, inventory, matching, routing, selection

_PLANS = (inventory, identity, matching, selection, files, routing)

QUERIES = {name: query for plan in _PLANS for name, query in plan.QUERIES.items()}
ORACLE_SQL = {name: sql for plan in _PLANS for name, sql in plan.ORACLE_SQL.items()}
FLAGSHIP = inventory.a04_study_summary
