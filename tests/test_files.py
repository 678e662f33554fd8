"""File listing, the new-file anti join and the dated archive."""

import datetime as dt

from pyspark.sql import functions as F

from martforge.sources import files

from .test_pipeline import write_csv


def test_new_files_are_those_missing_from_the_ledger(spark, scratch):
    landing = f"{scratch}/landing"
    for name in ("a.csv", "b.csv", "c.csv", "_SUCCESS"):
        write_csv(landing, name, ["X", "1"])
    listed = files.list_files(spark, landing)
    assert sorted(r["file_name"] for r in listed.collect()) == ["a.csv", "b.csv", "c.csv"]
    ledger = spark.createDataFrame([("a.csv",), ("folder/",)], "file_name string")
    new = files.new_files(listed, ledger)
    assert sorted(r["file_name"] for r in new.collect()) == ["b.csv", "c.csv"]


def test_equal_base_names_in_two_folders_are_two_files(spark, scratch):
    landing = f"{scratch}/landing"
    write_csv(f"{landing}/p", "x.csv", ["X", "1"])
    write_csv(f"{landing}/q", "x.csv", ["X", "2"])
    listed = files.list_files(spark, landing)
    assert sorted(r["file_name"] for r in listed.collect()) == ["p/x.csv", "q/x.csv"]
    new = files.new_files(listed, spark.createDataFrame([("p/x.csv",)], "file_name string"))
    assert [r["file_name"] for r in new.collect()] == ["q/x.csv"]


def test_archive_by_date_replaces_only_its_batch(spark, scratch):
    folder = f"{scratch}/archive"
    rows = spark.range(10).select(F.col("id").cast("string").alias("v"))
    files.archive_by_date(rows, folder, dt.date(2024, 9, 4), "b1")
    files.archive_by_date(rows.limit(3), folder, dt.date(2024, 9, 5), "b2")
    files.archive_by_date(rows.limit(2), folder, dt.date(2024, 9, 5), "b3")  # a second file of the day
    files.archive_by_date(rows.limit(4), folder, dt.date(2024, 9, 5), "b2")  # a re-run of the first
    got = {(str(r["ingest_date"]), r["batch_id"]): r["n"] for r in
           spark.read.parquet(folder).groupBy("ingest_date", "batch_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {("2024-09-04", "b1"): 10, ("2024-09-05", "b2"): 4, ("2024-09-05", "b3"): 2}
