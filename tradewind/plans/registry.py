"""All registered queries."""

from __future__ import annotations

from . import building, modelling, relational

MODULES = [relational, building, modelling]


def queries() -> dict:
    return {name: fn for module in MODULES for name, fn in module.QUERIES.items()}
