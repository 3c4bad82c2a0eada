"""Three example jobs over the test tables: a landing ingest, a union of sources, one that is gated."""

from __future__ import annotations

from importlib.resources import files

from tidegate.spec import SPEC_FILE, SQL_FILE, JobSpec, parse_spec


def example_spec(name: str) -> JobSpec:
    return parse_spec((files(__name__) / name / SPEC_FILE).read_text("utf-8"))


def example_sql(name: str) -> str:
    return (files(__name__) / name / SQL_FILE).read_text("utf-8")
