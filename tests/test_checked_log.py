"""Lines that do not fit, columns other than declared, and sketches."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbwatch.operators.sketches import ERROR, estimated_users, user_sketches
from ebbwatch.sources.checked_log import causes, checked, land_checked, read_lines, schema_drift

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("c", T.DoubleType())])
LINES = {
    '{"a": 1, "b": "x", "c": 1.5}': None,
    '{"a": 2}': None,
    '{"a": 3, "more": [1, 2]}': None,
    '{"b": {"nested": true}, "c": 2}': None,
    '{"a": null, "b": null}': None,
    "{}": None,
    '{"a": 4, "b": "cut': "not JSON",
    "no json": "not JSON",
    "17": "not an object",
    '"text"': "not an object",
    "[]": "not an object",
    '{"a": "five", "b": "kept nowhere"}': "type of a",
    '{"a": 1.5}': "type of a",
    '{"a": 99999999999999999999}': "type of a",
    '{"a": 1, "c": "x"}': "type of c",
    "   ": "blank",
    "": "blank",
}


@pytest.fixture
def lines(spark, tmp_path):
    (tmp_path / "log.json").write_text("\n".join(LINES) + "\n")
    return read_lines(spark, str(tmp_path / "log.json"))


def test_every_line_is_a_row_or_has_a_cause(spark, lines, tmp_path):
    found = checked(lines, SCHEMA).collect()
    assert len(found) == len(LINES) and {r.file for r in found} == {"log.json"}
    broken = {r.line: r.cause for r in found if r.cause}
    assert broken == {k: v for k, v in LINES.items() if v}
    assert all((r.a, r.b, r.c) == (None, None, None) for r in found if r.cause)
    good = sorted(str((r.a, r.b, r.c)) for r in found if not r.cause)
    assert good == sorted(map(str, [(1, "x", 1.5), (2, None, None), (3, None, None), (None, '{"nested":true}', 2.0), (None, None, None), (None, None, None)]))
    rows, quarantine = land_checked(lines, f"{tmp_path}/out", SCHEMA)
    assert rows.columns == ["a", "b", "c"] and rows.count() == 6
    assert {r.cause: r.n for r in causes(quarantine).collect()} == {"not JSON": 2, "not an object": 3, "type of a": 3, "type of c": 1, "blank": 2}
    plan = quarantine._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fits" in plan  # the rows are not read for the broken lines


def test_drift(spark, lines):
    got = {r.column_name: tuple(r)[1:] for r in schema_drift(lines, T.StructType([*SCHEMA.fields, T.StructField("d", T.StringType())])).collect()}
    assert got == {
        "a": ("bigint", "mixed", 7, "changed"), "b": ("string", "mixed", 3, "changed"), "c": ("double", "mixed", 3, "changed"),
        "d": ("string", None, 0, "missing"), "more": (None, "array", 1, "new"),
    }
    rows = [{"a": 1, "b": None, "c": 2}, {"a": 2, "c": 3, "x": 0.5}, {"c": 4, "x": 1}]
    frame = spark.createDataFrame([(json.dumps(r),) for r in rows], "line string")
    got = {r.column_name: tuple(r)[1:] for r in schema_drift(frame, SCHEMA).collect()}
    assert got == {"a": ("bigint", "bigint", 2, "same"), "b": ("string", "null", 0, "empty"), "c": ("double", "bigint", 3, "same"), "x": (None, "double", 2, "new")}
    assert {r.status for r in schema_drift(frame.limit(0), SCHEMA).collect()} == {"missing"}


def test_sketches_merge_to_the_total(spark):
    rows = spark.range(0, 400_000, 1, 8).select((F.col("id") % 30).alias("date"), F.when(F.col("id") % 7 != 0, F.xxhash64(F.col("id") % 150_000)).alias("userId"))
    days = user_sketches(rows).persist()
    exact = rows.agg(F.count_distinct("userId")).first()[0]
    assert abs(estimated_users(days).first().n_users - exact) <= ERROR * exact
    by_day = {r.date: r.n_users for r in estimated_users(days, "date").collect()}
    for r in rows.groupBy("date").agg(F.count_distinct("userId").alias("n")).collect():
        assert abs(by_day[r.date] - r.n) <= ERROR * r.n
    # Sketches of parts of the rows merge to that of all.
    halves = user_sketches(rows.where("date < 10")).union(user_sketches(rows.where("date >= 10")))
    assert estimated_users(halves).first() == estimated_users(days).first()
    assert estimated_users(user_sketches(rows.limit(0))).first().n_users == 0
