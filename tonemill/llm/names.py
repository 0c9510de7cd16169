"""Column names for work in between, beside whatever columns a table has."""

from __future__ import annotations

from collections.abc import Iterable


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, made longer until no column has it; Spark does not tell upper from lower case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
