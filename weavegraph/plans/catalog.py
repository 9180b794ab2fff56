"""All registered queries on the driver tables, with the SQL that must give the same rows."""

from __future__ import annotations

from weavegraph.plans import graph_plans, locale_plans, quality_plans, rule_plans, source_plans, text_plans, walk_plans

QUERIES: dict = {}
ORACLE_SQL: dict = {}
FLAGSHIP = "reference_edges"
for _m in (graph_plans, text_plans, locale_plans, walk_plans, quality_plans, rule_plans, source_plans):
    QUERIES.update(_m.plan.queries)
    ORACLE_SQL.update(_m.plan.sql)
