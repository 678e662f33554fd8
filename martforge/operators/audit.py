"""Per-batch audit rows (the reference's monitoring events, with counts).

Every load step of the reference appends ``(table code, event, status,
time)``; here one row per batch and step carries the counts that matter for
a merge: rows in, inserted, updated, deleted and rows with a NULL key part.
The counts come from one-row aggregates; only those scalars reach the driver.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("batch_id", T.StringType(), False),
        T.StructField("operation", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("partition_time", T.TimestampNTZType(), True),
        T.StructField("rows_in", T.LongType(), True),
        T.StructField("rows_inserted", T.LongType(), True),
        T.StructField("rows_updated", T.LongType(), True),
        T.StructField("rows_deleted", T.LongType(), True),
        T.StructField("null_keys", T.LongType(), True),
        T.StructField("rows_rejected", T.LongType(), True),
        T.StructField("rows_collapsed", T.LongType(), True),
        T.StructField("version", T.StringType(), True),
        T.StructField("message", T.StringType(), True),
        T.StructField("event_time", T.TimestampNTZType(), False),
    ]
)

OK, ERROR, SKIPPED = "OK", "ERROR", "SKIPPED"


@dataclass
class AuditRecord:
    table_name: str
    batch_id: str
    operation: str
    status: str
    partition_time: dt.datetime | None = None
    rows_in: int | None = None
    rows_inserted: int | None = None
    rows_updated: int | None = None
    rows_deleted: int | None = None
    null_keys: int | None = None
    rows_rejected: int | None = None
    rows_collapsed: int | None = None
    version: str | None = None
    message: str | None = None
    event_time: dt.datetime | None = None

    def as_row(self) -> tuple:
        d = asdict(self)
        if d["event_time"] is None:
            d["event_time"] = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        return tuple(d[f.name] for f in AUDIT_SCHEMA.fields)


def append_audit(spark: SparkSession, path: str, records: list[AuditRecord]) -> None:
    """Append audit rows (a handful per batch) to the audit table.

    Each table's rows have a folder of their own, so loads of several tables may append at the same time.
    """
    for name in dict.fromkeys(r.table_name for r in records):
        rows = [r.as_row() for r in records if r.table_name == name]
        spark.createDataFrame(rows, AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/{name}")


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).option("recursiveFileLookup", "true").parquet(path)
