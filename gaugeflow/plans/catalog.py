"""All queries and their reference SQL."""

from __future__ import annotations

from gaugeflow.plans import files, parameter_search, runs, station_choice, texts, topology, verification

MODULES = (verification, station_choice, runs, topology, parameter_search, texts, files)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
