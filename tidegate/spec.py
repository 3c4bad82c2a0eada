"""Job specs: what one target table is made of.  Read and checked on the driver, before any data is."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from tidegate.functions.dates import shifted_day

# Fixed values of the spec format.
LAYERS = ("SOR", "SOT", "SPEC", "CSV")
MACHINE_TYPES = ("G.1X", "G.2X")
SPEC_FILE = "orchestration.json"
SQL_FILE = "sparksql.sql"
FILE_DATE_TOKEN = "%Y%m%d"


class SpecError(ValueError):
    """The spec cannot be run as it is written."""


@dataclass(frozen=True)
class Rule:
    """One quality rule.  ``kind`` is ``rows``, ``distinct`` or ``values``."""

    text: str
    kind: str
    column: str | None = None
    comparator: str | None = None
    bound: int | None = None
    values: tuple = ()


_ROWS = re.compile(r"RowCount\s*(>=|<=|>|<|=)\s*(-?\d+)")
_DISTINCT = re.compile(r'DistinctValuesCount\s+"([^"]+)"\s*(>=|<=|>|<|=)\s*(-?\d+)')
_VALUES = re.compile(r'ColumnValues\s+"([^"]+)"\s+in\s*(\[.*\])', re.DOTALL)


def parse_rule(text: str) -> Rule:
    """A rule text as a ``Rule``; any other form is refused."""
    body = text.strip()
    if m := _ROWS.fullmatch(body):
        return Rule(body, "rows", comparator=m[1], bound=int(m[2]))
    if m := _DISTINCT.fullmatch(body):
        return Rule(body, "distinct", column=m[1], comparator=m[2], bound=int(m[3]))
    if m := _VALUES.fullmatch(body):
        try:
            values = json.loads(m[2])
        except json.JSONDecodeError as error:
            raise SpecError(f"bad value list in rule {text!r}") from error
        if any(isinstance(v, bool) or not isinstance(v, (str, int, float)) for v in values):
            raise SpecError(f"only texts and numbers can be listed in rule {text!r}")
        return Rule(body, "values", column=m[1], values=tuple(values))
    raise SpecError(f"unknown rule {text!r}")


def parse_rules(texts) -> tuple[Rule, ...]:
    if not isinstance(texts, (list, tuple)):
        raise SpecError("Rules must be a list of texts")
    return tuple(parse_rule(t) for t in texts)


@dataclass(frozen=True)
class Predicate:
    """A filter template with one slot for a date."""

    template: str
    days: int
    pattern: str

    def render(self, as_of: datetime) -> str:
        return self.template.format(shifted_day(as_of, self.days, self.pattern))


def render_predicates(predicates, as_of: datetime) -> str:
    """All predicates of a dependency joined by AND; no predicates give an empty text."""
    return " AND ".join(f"({p.render(as_of)})" for p in predicates)


@dataclass(frozen=True)
class Dependency:
    table: str
    database: str
    predicates: tuple[Predicate, ...]
    rules: tuple[Rule, ...]
    read_if_fail: bool

    @property
    def identifier(self) -> str:
        return f"{self.database}.{self.table}"


@dataclass(frozen=True)
class JobSpec:
    layer: str
    table: str
    database: str
    dependencies: tuple[Dependency, ...]
    rules: tuple[Rule, ...]
    write_if_fail: bool
    machine: Mapping[str, Any] = field(default_factory=dict, compare=False)

    @property
    def identifier(self) -> str:
        return f"{self.database}.{self.table}"


def parse_spec(source: str | Mapping[str, Any]) -> JobSpec:
    """A spec from JSON text or a mapping, with defaults applied and everything checked."""
    raw = json.loads(source) if isinstance(source, str) else source
    layer = _text(raw, "DataLayer")
    if layer not in LAYERS:
        raise SpecError(f"DataLayer must be one of {LAYERS}, not {layer!r}")
    dependencies = tuple(_dependency(d) for d in raw.get("Dependencies") or [])
    _check_names(layer, dependencies)
    quality = _mapping(raw, "Quality")
    return JobSpec(
        layer=layer,
        table=_text(raw, "TableName"),
        database=_text(raw, "DatabaseName"),
        dependencies=dependencies,
        rules=parse_rules(_need(quality, "Rules")),
        write_if_fail=_flag(quality, "WriteIfFail"),
        machine=_machine(raw),
    )


def _check_names(layer: str, dependencies: tuple[Dependency, ...]) -> None:
    names = [d.table.lower() for d in dependencies]
    if len(set(names)) < len(names):
        raise SpecError(f"two dependencies would share one view name: {sorted(names)}")
    if layer == "CSV" and len(dependencies) != 1:
        raise SpecError("a CSV job takes exactly one dependency, which becomes its result")


def _dependency(raw: Mapping[str, Any]) -> Dependency:
    quality = _mapping(raw, "Quality")
    return Dependency(
        table=_text(raw, "TableName"),
        database=_text(raw, "DatabaseName"),
        predicates=tuple(_predicate(p) for p in _need(raw, "Predicate")),
        rules=parse_rules(_need(quality, "Rules")),
        read_if_fail=_flag(quality, "ReadIfFail"),
    )


def _predicate(raw: Mapping[str, Any]) -> Predicate:
    kind = _text(raw, "Type")
    if kind != "Date":
        raise SpecError(f"predicate type {kind!r} has no meaning here; only 'Date' has")
    predicate = Predicate(_text(raw, "PushDown"), _whole(raw, "Filter"), _text(raw, "Pattern"))
    try:
        predicate.template.format("")
    except (IndexError, KeyError, ValueError) as error:
        raise SpecError(f"bad predicate template {predicate.template!r}") from error
    return predicate


def _machine(raw: Mapping[str, Any]) -> dict[str, Any]:
    """Cluster size: checked as part of the format, used by nothing."""
    machine = _mapping(raw, "Machine")
    kind = _text(machine, "Type")
    if kind not in MACHINE_TYPES:
        raise SpecError(f"Machine.Type must be one of {MACHINE_TYPES}, not {kind!r}")
    return {"Capacity": _whole(machine, "Capacity"), "Type": kind}


def _need(raw: Mapping[str, Any], key: str) -> Any:
    if not isinstance(raw, Mapping) or raw.get(key) is None:
        raise SpecError(f"{key} is missing")
    return raw[key]


def _mapping(raw: Mapping[str, Any], key: str) -> Mapping[str, Any]:
    value = _need(raw, key)
    if not isinstance(value, Mapping):
        raise SpecError(f"{key} must be an object")
    return value


def _text(raw: Mapping[str, Any], key: str) -> str:
    value = _need(raw, key)
    if not isinstance(value, str):
        raise SpecError(f"{key} must be a text")
    return value


def _whole(raw: Mapping[str, Any], key: str) -> int:
    value = _need(raw, key)
    if isinstance(value, bool) or not re.fullmatch(r"[+-]?\d+", str(value)):
        raise SpecError(f"{key} must be a whole number")
    return int(value)


def _flag(raw: Mapping[str, Any], key: str) -> bool:
    value = str(_need(raw, key)).lower()
    if value not in ("true", "false"):
        raise SpecError(f"{key} must be true or false")
    return value == "true"
