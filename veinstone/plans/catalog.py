"""All queries of the analytics engine, by name, with their DuckDB SQL."""

from __future__ import annotations

from . import activity, engine_queries, linking, model_queries, programmatic, reporting, scoring
from .dialect import duck, query

TEMPLATES = activity.TEMPLATES | scoring.TEMPLATES | linking.TEMPLATES | reporting.TEMPLATES
QUERIES = {name: query(template) for name, template in TEMPLATES.items()} | programmatic.QUERIES | model_queries.QUERIES | engine_queries.QUERIES
ORACLES = {name: duck(template) for name, template in TEMPLATES.items()} | programmatic.ORACLES | model_queries.ORACLES | engine_queries.ORACLES
