"""Corpus queries against their SQL, and inputs whose columns clash with names that operators use."""

import pytest

from tests.compare import connect, duck_rows, spark_rows
from tidegate.llm import decontaminate, jaccard_join, mixing
from tidegate.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"
CLASHES = (
    "_words _hits _doc _text _row _w _gaps _kept kept parts gaps cleaned w n h items hit_words doc id dropped _dropped "
    "whole upto draw own_source _draw size target copies taken node rep col"
).split()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    names, rows = spark_rows(QUERIES[name](spark, SF))
    want_names, want = duck_rows(connect(SF), ORACLE[name])
    assert names == want_names
    assert len(rows) == len(want) > 0
    assert rows == want


@pytest.fixture(scope="module")
def clashing(spark):
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen"
    rows = [(1, passage, "a"), (2, passage, "b"), (3, "Other words here, and more.", None), (4, None, "a"), (5, "", "b")]
    plain = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return plain.selectExpr("*", *[f"'{c} kept' AS `{c}`" for c in CLASHES], "'dot' AS `a.b`")


def kept_rows(df, gone=()):
    return sorted(tuple(r[c] for c in CLASHES if c not in gone) for r in df.collect())


def test_columns_of_any_name_stay(spark, clashing):
    items = spark.createDataFrame([("i1", clashing.first()["text"])], "item_id string, text string")
    for limit in (decontaminate.TABLE_BYTES, 0):
        judged = decontaminate.contamination(clashing, items, table_bytes=limit)
        assert kept_rows(judged, decontaminate.ADDED) == kept_rows(clashing, decontaminate.ADDED)
        assert {r["doc_id"]: r["contaminated"] for r in judged.collect()} == {1: True, 2: True, 3: False, 4: False, 5: False}
    clean = decontaminate.clean_documents(clashing, items)
    assert clean.columns == clashing.columns and kept_rows(clean) == kept_rows(clashing.where("doc_id > 2"))
    cut = decontaminate.clean_spans(clashing, items)
    assert cut.columns == clashing.columns and kept_rows(cut) == kept_rows(clashing)
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == {1: "", 2: "", 3: "Other words here, and more.", 4: None, 5: ""}
    first = jaccard_join.first_of_each(clashing)
    assert first.columns == clashing.columns and kept_rows(first) == kept_rows(clashing.where("doc_id <> 2"))
    mixed = mixing.mix(clashing)
    assert kept_rows(mixed, mixing.ADDED) == kept_rows(clashing, mixing.ADDED)
    assert mixed.count() == 5 and mixed.where("size = 13 AND copies IS NULL").count() == 0
    assert set(mixing.repeated(mixed).columns) == set(clashing.columns) - set(mixing.ADDED)


def test_item_ids_are_any_text(spark):
    text = "alpha beta gamma delta"
    ids = ["", "z", "a\nb", "\x01x", "c\x03d", "é,\\E", None]
    items = spark.createDataFrame([(i, text) for i in ids], "item_id string, text string")
    docs = spark.createDataFrame([(1, f"so {text.upper()}!"), (2, "beta alpha")], "doc_id long, text string")
    for limit in (decontaminate.TABLE_BYTES, 0):
        found = {r["doc_id"]: r for r in decontaminate.contamination(docs, items, table_bytes=limit).collect()}
        assert found[1]["items"] == sorted(i for i in ids if i is not None)
        assert (found[1]["n_hit"], found[2]["n_hit"], found[2]["items"]) == (4, 0, [])


def test_spans_of_long_texts_go(spark):
    passage = " ".join(f"p{i}" for i in range(13))
    long = ". ".join([f"{passage}, tail"] * 3000)
    docs = spark.createDataFrame([(1, long)], "doc_id long, text string")
    items = spark.createDataFrame([("i", passage)], "item_id string, text string")
    assert decontaminate.clean_spans(docs, items).first()["text"] == ", tail" * 3000
