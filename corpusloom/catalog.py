"""Every named query of the curation operators, with the SQL it is checked against."""

from __future__ import annotations

from corpusloom.queries import cleaning, dedup, gibberish, orthography, reports, urls

_ALL = (cleaning, urls, gibberish, orthography, dedup, reports)
QUERIES = {name: query for module in _ALL for name, query in module.QUERIES.items()}
ORACLE_SQL = {name: sql for module in _ALL for name, sql in module.ORACLE_SQL.items()}
