"""Names of helper columns."""

from __future__ import annotations

import uuid


def private(name: str) -> str:
    """A column name of its own for one call, which no table has."""
    return f"_{name}_{uuid.uuid4().hex}"
