"""Cast rules, one row per case (FIXTURES.md section 4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.errors.exceptions.captured import CapturedException

from martforge.config import ColumnSpec, TableSpec
from martforge.functions import casts


def _one(spark, expr, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_int_rule(spark):
    assert _one(spark, casts.int_rule, ["12", "12.0", "12.7", " ", "-", None]) == [12, 12, 12, None, None, None]


def test_int_rule_raises_on_text(spark):
    with pytest.raises(CapturedException):
        _one(spark, casts.int_rule, ["abc"])


def test_float_rule(spark):
    assert _one(spark, casts.float_rule, ["1,5", "1.5", "1.234,5", "abc", " ", "-", None]) == [
        1.5, 1.5, None, None, None, None, None]


def test_date_rule(spark):
    got = _one(spark, casts.date_rule, ["2024-01-02", "2024-01-02 13:45:00", " ", "-", None])
    assert got == [dt.date(2024, 1, 2), dt.date(2024, 1, 2), None, None, None]


def test_date_rule_raises_on_other_format(spark):
    with pytest.raises(CapturedException):
        _one(spark, casts.date_rule, ["02/01/2024"])


def test_date_rule_to_timestamp_keeps_only_the_day(spark):
    got = _one(spark, lambda c: casts.date_rule(c, "timestamp_ntz"), ["2024-01-02 13:45:00"])
    assert got == [dt.datetime(2024, 1, 2)]


def test_other_rule_boolean(spark):
    assert _one(spark, lambda c: casts.other_rule(c, "boolean"), ["True", "False", None]) == [True, False, None]


def test_na_words_become_null_at_ingest(spark):
    got = _one(spark, casts.na_to_null, ["", "NA", "NULL", "NaN", "None", "N/A", "x", " "])
    assert got == [None] * 6 + ["x", " "]


def test_blank_and_dash_match_exactly_without_trim(spark):
    # '  ' (two blanks) is not a NULL marker, so the strict int cast raises
    with pytest.raises(CapturedException):
        _one(spark, casts.int_rule, ["  "])


def _spec():
    return TableSpec(
        "t.csv",
        (ColumnSpec("ID", "int"), ColumnSpec("AMOUNT", "float"), ColumnSpec("DAY", "date"),
         ColumnSpec("FLAG", "boolean"), ColumnSpec("NAME", "string")),
        keys=("ID",),
    )


def test_typed_projection(spark):
    rows = [("1", "1,5", "2024-01-02", "True", "a"), ("2.0", "abc", "-", "False", None)]
    df = spark.createDataFrame(rows, "id string, amount string, day string, flag string, name string")
    out = casts.typed_projection(df, _spec()).collect()
    assert [tuple(r) for r in out] == [(1, 1.5, dt.date(2024, 1, 2), True, "a"), (2, None, None, False, None)]
    assert casts.typed_projection(df, _spec()).dtypes == [
        ("id", "bigint"), ("amount", "double"), ("day", "date"), ("flag", "boolean"), ("name", "string")]


def test_quarantine_split_keeps_load_going(spark):
    rows = [("1", "1,5", "2024-01-02", "True", "a"), ("x", "2", "2024-01-03", "True", "b"),
            ("3", "abc", "03/01/2024", "True", "c")]
    df = spark.createDataFrame(rows, "id string, amount string, day string, flag string, name string")
    good, bad = casts.quarantine_split(df, _spec())
    assert [r["id"] for r in good.collect()] == [1]
    rejected = {r["id"]: r["bad_column"] for r in bad.collect()}
    assert rejected == {"x": "id", "3": "day"}  # a bad float is lenient, not a rejection
