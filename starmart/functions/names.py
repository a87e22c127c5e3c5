"""Column names inside SQL expressions."""

from __future__ import annotations


def quoted(name: str) -> str:
    """The name as an SQL identifier, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"
