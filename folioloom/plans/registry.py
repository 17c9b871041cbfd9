"""All queries of the core and the SQL each one is checked against."""

from __future__ import annotations

from folioloom.plans import files, geometry, inline, layout, merge, models, nested, office, order, render, sequence, tables, text, textlayer

_MODULES = (nested, text, geometry, sequence, files, tables, render, order, layout, merge, inline, textlayer, office, models)

QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
SQL = {name: sql for m in _MODULES for name, sql in m.SQL.items()}
