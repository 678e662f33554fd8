"""Delimited flat files: read as text under a spec, write for export and fixtures.

Files are read as text (no type inference), by header name, so a batch
whose columns come in another order still lands right; a missing column is
an error, and so is a file set whose headers disagree or a line whose number
of fields is not the header's. The no-value words become NULL, then columns
get their lake names. Every file splits across tasks; where the spec says that
its values hold line breaks, by way of the quotes before each split
(``sources.quoted``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import FIELD_SEPARATOR, TableSpec
from ..functions.casts import na_to_null
from . import quoted

# Blanks are data (a single blank means NULL to the cast rules), so the
# writer must not trim them and the reader must keep them.
CSV_OPTIONS = {
    "sep": FIELD_SEPARATOR,
    "header": "true",
    "quote": '"',
    "escape": '"',
    "inferSchema": "false",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    # check every file's header against the columns: a file whose columns
    # come in another order fails instead of being read by position
    "enforceSchema": "false",
}
_READ_ONLY = ("inferSchema", "enforceSchema")

FAIL, KEEP = "fail", "keep"
MALFORMED = "malformed_line"


def read_flat_file(
    spark: SparkSession, path: str | list[str], spec: TableSpec, malformed: str = FAIL, with_file: bool = False,
    **options: str,
) -> DataFrame:
    """Text columns with lake names, in spec order (S1, P1, P2).

    A line with more or fewer fields than the header is malformed. ``fail``
    raises when the row is read; ``keep`` adds the column ``malformed_line``
    (the line's text, NULL for good rows), which a load sets aside.
    ``with_file`` adds the time and path of each row's file.
    """
    if malformed not in (FAIL, KEEP):
        raise ValueError(f"malformed: {malformed!r}")
    opts = {**CSV_OPTIONS, **options}
    if spec.multi_line:
        line = quoted.header_line(spark, path)
        header = quoted.header_names(line, opts["sep"])
        raw = quoted.read_quoted(spark, path, header, line, MALFORMED, opts)
        if with_file:
            times = spark.read.format("binaryFile").load(path).select(  # the listing only
                F.col("_metadata.file_path").alias("path"), F.col("modificationTime").cast("timestamp_ntz").alias("file_time"))
            raw = raw.join(times, "path").withColumnRenamed("path", "file_path")
        return _checked(raw, spec, malformed, ("file_time", "file_path") if with_file else ())
    opts["multiLine"] = "false"
    header = spark.read.options(**opts).csv(path).columns
    # every column is read, so that every line's fields are counted
    opts |= {"columnNameOfCorruptRecord": MALFORMED, "columnPruning": "false"}
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in [*header, MALFORMED]])
    origin = {"file_time": F.col("_metadata.file_modification_time").cast("timestamp_ntz"),
              "file_path": F.col("_metadata.file_path")} if with_file else {}
    raw = spark.read.schema(schema).options(**opts).csv(path).withColumns(origin)
    return _checked(raw, spec, malformed, tuple(origin))


def _checked(raw: DataFrame, spec: TableSpec, malformed: str, origin: tuple[str, ...]) -> DataFrame:
    rows = to_lake_text(raw, spec, keep=(*origin, MALFORMED))
    if malformed == KEEP:
        return rows
    line = F.concat(F.lit(f"{spec.name}: malformed line: "), F.col(MALFORMED))
    checked = [F.when(F.col(MALFORMED).isNotNull(), F.raise_error(line)).otherwise(F.col(c)).alias(c)
               for c in spec.lake_columns]
    return rows.select(*checked, *origin)


def to_lake_text(raw: DataFrame, spec: TableSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Header-named text columns -> lake-named text columns with NA words as NULL."""
    present = {c.lower(): c for c in raw.columns}
    missing = [c.source for c in spec.columns if c.source.lower() not in present]
    if missing:
        raise ValueError(f"{spec.name}: file lacks columns {missing}")
    return raw.select(
        *[na_to_null(F.col(f"`{present[c.source.lower()]}`").cast("string")).alias(c.lake) for c in spec.columns],
        *keep,
    )


def write_flat_file(df: DataFrame, path: str, spec: TableSpec, mode: str = "errorifexists", **options: str) -> None:
    """Write lake-named text columns as a ``;`` file set with the source header names."""
    opts = {k: v for k, v in {**CSV_OPTIONS, **options}.items() if k not in _READ_ONLY}
    out = df.select(*[F.col(c.lake).cast("string").alias(c.source) for c in spec.columns])
    out.write.mode(mode).options(**opts).csv(path)
