from datetime import datetime

import pytest

from tidegate.examples import example_spec
from tidegate.spec import SpecError, parse_rule, parse_spec, render_predicates

AS_OF = datetime(2024, 3, 1, 8, 30)


def raw(**changes):
    spec = {
        "DataLayer": "SOT",
        "TableName": "t",
        "DatabaseName": "d",
        "Machine": {"Capacity": 2, "Type": "G.1X"},
        "Dependencies": [dependency("a")],
        "Quality": {"Rules": ["RowCount > 1"], "WriteIfFail": False},
    }
    spec.update(changes)
    return spec


def dependency(table, database="sor", **changes):
    made = {
        "TableName": table,
        "DatabaseName": database,
        "Predicate": [
            {"PushDown": "day > {}", "Type": "Date", "Filter": -2, "Pattern": "%Y%m%d"},
            {"PushDown": "ts < '{} 23:59:59.000'", "Type": "Date", "Filter": 0, "Pattern": "%Y-%m-%d"},
        ],
        "Quality": {"Rules": [], "ReadIfFail": True},
    }
    made.update(changes)
    return made


def test_a_full_spec():
    spec = parse_spec(raw())
    assert spec.identifier == "d.t"
    assert spec.dependencies[0].identifier == "sor.a"
    assert spec.dependencies[0].read_if_fail and not spec.write_if_fail
    assert render_predicates(spec.dependencies[0].predicates, AS_OF) == (
        "(day > 20240228) AND (ts < '2024-03-01 23:59:59.000')"
    )


def test_dates_cross_months_and_years():
    spec = parse_spec(raw())
    text = render_predicates(spec.dependencies[0].predicates[:1], datetime(2024, 1, 1))
    assert text == "(day > 20231230)"


def test_no_predicates_give_no_text():
    assert render_predicates((), AS_OF) == ""


@pytest.mark.parametrize("dependencies", [None, []])
def test_no_dependencies(dependencies):
    assert parse_spec(raw(Dependencies=dependencies)).dependencies == ()


def test_dependencies_may_be_left_out():
    spec = raw()
    del spec["Dependencies"]
    assert parse_spec(spec).dependencies == ()


def test_numbers_and_flags_may_be_text():
    spec = parse_spec(
        raw(
            Machine={"Capacity": "4", "Type": "G.2X"},
            Quality={"Rules": [], "WriteIfFail": "true"},
        )
    )
    assert spec.machine["Capacity"] == 4 and spec.write_if_fail


@pytest.mark.parametrize(
    "changes",
    [
        {"DataLayer": "GOLD"},
        {"TableName": None},
        {"Machine": {"Capacity": 2, "Type": "G.8X"}},
        {"Machine": {"Capacity": "many", "Type": "G.1X"}},
        {"Quality": {"Rules": [], "WriteIfFail": "perhaps"}},
        {"Quality": {"Rules": "RowCount > 1", "WriteIfFail": True}},
        {"Quality": {"Rules": ["RowCount between 1 and 2"], "WriteIfFail": True}},
        {"Dependencies": [dependency("a"), dependency("A", "other")]},
        {"DataLayer": "CSV", "Dependencies": [dependency("a"), dependency("b")]},
        {"DataLayer": "CSV", "Dependencies": []},
        {
            "Dependencies": [
                dependency(
                    "a",
                    Predicate=[{"PushDown": "x = {}", "Type": "Numeric", "Filter": 1, "Pattern": "x"}],
                )
            ]
        },
        {
            "Dependencies": [
                dependency("a", Predicate=[{"PushDown": "x = {}", "Type": "Date", "Filter": 1}])
            ]
        },
        {
            "Dependencies": [
                dependency(
                    "a",
                    Predicate=[
                        {"PushDown": "x = {} {}", "Type": "Date", "Filter": 1, "Pattern": "%Y"}
                    ],
                )
            ]
        },
    ],
)
def test_specs_that_cannot_run(changes):
    with pytest.raises(SpecError):
        parse_spec(raw(**changes))


@pytest.mark.parametrize(
    "text, kind, column, comparator, bound",
    [
        ("RowCount > 1000", "rows", None, ">", 1000),
        ("  RowCount<=5 ", "rows", None, "<=", 5),
        ('DistinctValuesCount "contract_id" > 1', "distinct", "contract_id", ">", 1),
        ('DistinctValuesCount "a b" = 0', "distinct", "a b", "=", 0),
    ],
)
def test_count_rules(text, kind, column, comparator, bound):
    rule = parse_rule(text)
    assert (rule.kind, rule.column, rule.comparator, rule.bound) == (kind, column, comparator, bound)


def test_value_rule():
    rule = parse_rule('ColumnValues "status" in ["Ativo", "a, b", "say \\"x\\"", 3]')
    assert rule.column == "status"
    assert rule.values == ("Ativo", "a, b", 'say "x"', 3)


@pytest.mark.parametrize(
    "text",
    [
        "RowCount",
        "RowCount > many",
        "RowCount > 1 or 2",
        'ColumnValues "a" in [x]',
        'ColumnValues "a" in [null]',
        'ColumnValues "a" > 3',
        'IsComplete "a"',
        "",
    ],
)
def test_unknown_rules(text):
    with pytest.raises(SpecError):
        parse_rule(text)


@pytest.mark.parametrize("name", ["landing_orders", "contract_totals", "contract_totals_gated"])
def test_examples_load(name):
    assert example_spec(name).table == name
