"""Column names: catalog, SQL aliases and rules may differ in case, so all lookups go through here."""

from __future__ import annotations

from collections.abc import Iterable


def resolve(columns: Iterable[str], name: str) -> str | None:
    """The spelling ``name`` has in ``columns``: an exact match first, then one that ignores case."""
    columns = list(columns)
    if columns.count(name) == 1:
        return name
    found = [c for c in columns if c.lower() == name.lower()]
    if len(found) > 1:
        raise ValueError(f"column name {name!r} is ambiguous: {found}")
    return found[0] if found else None


def resolve_all(columns: Iterable[str], names: Iterable[str]) -> list[str]:
    """``resolve`` for several names, all of which must be there."""
    columns = list(columns)
    found = [(name, resolve(columns, name)) for name in names]
    missing = [name for name, hit in found if hit is None]
    if missing:
        raise ValueError(f"no such column: {missing}; there are {columns}")
    return [hit for _, hit in found]


def quoted(name: str) -> str:
    """A column name as an identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def quoted_table(identifier: str) -> str:
    """``database.table`` as an identifier; names that are quoted already are left alone."""
    if "`" in identifier:
        return identifier
    return ".".join(quoted(part) for part in identifier.split("."))
