"""All registered queries and their oracle SQL."""

from __future__ import annotations

from shelfmark.plans import clusters, flagship, labels, pages, relational, sequences, verdicts

_MODULES = (flagship, relational, pages, sequences, clusters, verdicts, labels)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
