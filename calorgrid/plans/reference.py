"""Queries of the inspection operators, gathered from their modules."""

from __future__ import annotations

from calorgrid.plans import boxes, frames, inventory, surveys

_ALL = (frames.query, boxes.query, inventory.query, surveys.query)
QUERIES = {name: q for r in _ALL for name, q in r.queries.items()}
SQL = {name: s for r in _ALL for name, s in r.sql.items()}
