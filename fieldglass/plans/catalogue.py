"""All registered queries over the driver's tables, with DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from fieldglass.plans import files, flows, identity, indicators, tournament, values

QUERIES = flows.QUERIES | tournament.QUERIES | indicators.QUERIES | identity.QUERIES | files.QUERIES | values.QUERIES

ORACLE_SQL = flows.ORACLE_SQL | tournament.ORACLE_SQL | indicators.ORACLE_SQL | identity.ORACLE_SQL | files.ORACLE_SQL | values.ORACLE_SQL
