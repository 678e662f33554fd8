"""Lake layers on plain parquet: land stamp, raw history, trusted snapshots.

Layout below one root folder (a shared folder on a cluster)::

    raw/<table>/batch_id=<id>/partition_month=YYYY-MM/part-*.parquet
    quarantine/<table>/batch_id=<id>/            rows of the batch that were set aside
    trusted/<table>/v=<id>/part-*.parquet        one folder per committed batch
    trusted/<table>/_commits/part-*.parquet      one row per commit
    trusted/<table>/_numbers/<n>                 taken commit numbers (write guard)
    changes/<table>/batch_id=<id>/               rows that a merge changed, old and new (where tracked)
    refined/<mart>/v=<run>/, refined/_commits/   marts, one commit row per refresh
    state/audit/                                 append-only audit (also the watermarks)

* The raw history is keyed by batch: a re-run of a batch replaces its folder,
  whatever month the run is in, so a retried load never doubles rows (D14).
* A trusted load writes a new version folder and then appends a commit row.
  Readers take the latest committed version; a load that fails before its
  commit leaves the previous snapshot current (D11). Nothing is truncated.
* A commit takes the next commit number by an exclusive create. A writer that
  started from an older number than the last one fails instead of undoing the
  other's update.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SYSTEM_COLUMNS, SYSTEM_VALUES, TableSpec
from ..functions.dates import month_key, ntz_lit, stamp_time
from ..session import unsorted_folders

RAW_PARTITIONS = ("batch_id", "partition_month")
# where a streamed row comes from; NULL for rows of a batch load
FILE_COLUMNS = (("file_time", T.TimestampNTZType()), ("file_path", T.StringType()))
KEPT_NUMBERS = 100  # commit numbers whose marker files stay


@dataclass(frozen=True)
class LakeLayout:
    """Folder names of one lake."""

    root: str

    def raw(self, spec: TableSpec) -> str:
        return f"{self.root}/raw/{spec.table_name}"

    def trusted(self, spec: TableSpec) -> str:
        return f"{self.root}/trusted/{spec.table_name}"

    @property
    def refined_root(self) -> str:
        return f"{self.root}/refined"

    def refined(self, name: str) -> str:
        return f"{self.refined_root}/{name}"

    def quarantine(self, spec: TableSpec) -> str:
        return f"{self.root}/quarantine/{spec.table_name}"

    def archive(self, spec: TableSpec) -> str:
        return f"{self.root}/archive/{spec.table_name}"

    def changes(self, spec: TableSpec) -> str:
        return f"{self.root}/changes/{spec.table_name}"

    @property
    def audit(self) -> str:
        return f"{self.root}/state/audit"


# --- land -------------------------------------------------------------------

def stamp_land(text: DataFrame, batch_time: dt.datetime | str | None = None, with_files: bool = False) -> DataFrame:
    """Add the system columns and the batch stamp to a text batch (P3).

    Version 0, operation ``'I'``, creation version 0; ``commit_time`` and
    ``partition_time`` both get the batch stamp. ``with_files`` adds the
    columns that say which file a row came from, as the raw history keeps them.
    """
    ts = stamp_time(batch_time)
    values = {name: F.lit(SYSTEM_VALUES[name]).cast(kind) for name, kind in SYSTEM_COLUMNS if name in SYSTEM_VALUES}
    values["commit_time"] = ts
    files = [F.col(n) if n in text.columns else F.lit(None).cast(t).alias(n) for n, t in FILE_COLUMNS]
    return text.select(
        *[values[name].alias(name) for name, _ in SYSTEM_COLUMNS],
        *[c for c in text.columns if c not in dict(FILE_COLUMNS)],
        *(files if with_files else []),
        ts.alias("partition_time"),
    )


def land_schema(spec: TableSpec) -> T.StructType:
    from ..config import spark_type

    fields = [T.StructField(n, spark_type(t), True) for n, t in SYSTEM_COLUMNS]
    fields += [T.StructField(c, T.StringType(), True) for c in spec.lake_columns]
    fields += [T.StructField(n, t, True) for n, t in FILE_COLUMNS]
    fields.append(T.StructField("partition_time", T.TimestampNTZType(), True))
    return T.StructType(fields)


# --- raw --------------------------------------------------------------------

def raw_schema(spec: TableSpec) -> T.StructType:
    s = land_schema(spec)
    return T.StructType(s.fields + [T.StructField(p, T.StringType(), True) for p in RAW_PARTITIONS])


def batch_folder(root: str, batch_id: str) -> str:
    if not re.fullmatch(r"[\w.-]+", str(batch_id)):
        raise ValueError(f"batch id {batch_id!r}: only letters, digits, '.', '_' and '-'")
    return f"{root}/batch_id={batch_id}"


def append_raw(land: DataFrame, layout: LakeLayout, spec: TableSpec, batch_id: str) -> dict:
    """Write a stamped batch into the raw history (S4, S9); returns its watermark.

    One folder per batch, which a re-run replaces, and in it one per month of
    the stamp; rows are sorted by key inside each file. The row count (A1) and
    the max stamp (A2) are observed while writing, without a second pass; they
    are returned as ``{"rows_in", "partition_time"}`` (S14, kept in the audit).
    """
    mark = Observation(f"raw_{spec.table_name}_{batch_id}_{uuid.uuid4().hex[:8]}")
    out = land.withColumn("partition_month", month_key(F.col("partition_time"))).observe(
        mark, F.count(F.lit(1)).alias("rows_in"), F.max("partition_time").alias("partition_time"))
    # a batch has one stamp, hence one month: a sort by it first would compare rows by equal values
    with unsorted_folders(land.sparkSession):
        (
            (out.sortWithinPartitions(*spec.keys) if spec.keys else out)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("partition_month")
            .parquet(batch_folder(layout.raw(spec), batch_id))
        )
    return mark.get


def read_raw(spark: SparkSession, layout: LakeLayout, spec: TableSpec) -> DataFrame:
    """The whole raw history (filter it; partition columns prune folders)."""
    return spark.read.schema(raw_schema(spec)).parquet(layout.raw(spec))


def read_raw_batch(spark: SparkSession, layout: LakeLayout, spec: TableSpec, batch_id: str) -> DataFrame:
    """The raw rows of one batch; only that batch's folder is listed, however long the history grows."""
    root = layout.raw(spec)
    return spark.read.schema(raw_schema(spec)).option("basePath", root).parquet(batch_folder(root, batch_id))


def raw_batch_rows(
    spark: SparkSession, layout: LakeLayout, spec: TableSpec, stamp: dt.datetime, exact: bool, batch_id: str = ""
) -> DataFrame:
    """Raw rows of one stamp (``exact``, P6) or from it on (P7); a load names its batch and reads only that.

    Without a batch id the whole history is filtered by month and stamp, so
    only folders from the stamp's month on are read.
    """
    ts, month = ntz_lit(stamp), stamp.strftime("%Y-%m")
    raw = read_raw_batch(spark, layout, spec, batch_id) if batch_id else read_raw(spark, layout, spec)
    if exact:
        return raw.filter((F.col("partition_month") == month) & (F.col("partition_time") == ts))
    return raw.filter((F.col("partition_month") >= month) & (F.col("partition_time") >= ts))


def quarantine_schema(spec: TableSpec) -> T.StructType:
    text = [*spec.lake_columns, "malformed_line", "bad_column"]
    fields = [T.StructField(c, T.StringType(), True) for c in text]
    fields += [T.StructField("partition_time", T.TimestampNTZType(), True), T.StructField("batch_id", T.StringType(), True)]
    return T.StructType(fields)


def write_quarantine(rows: DataFrame, layout: LakeLayout, spec: TableSpec, batch_id: str, kind: str) -> int:
    """Replace the batch's rejected rows of one kind; returns how many there are (observed while writing)."""
    seen = Observation(f"quarantine_{spec.table_name}_{batch_id}_{uuid.uuid4().hex[:8]}")
    have = set(rows.columns)
    columns = [F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
               for f in quarantine_schema(spec).fields if f.name != "batch_id"]
    rows.select(*columns).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option(
        "partitionOverwriteMode", "static").parquet(f"{batch_folder(layout.quarantine(spec), batch_id)}/kind={kind}")
    return int(seen.get["n"])


def read_quarantine(spark: SparkSession, layout: LakeLayout, spec: TableSpec) -> DataFrame:
    """Rejected rows of all batches (text columns, ``malformed_line``, ``bad_column``, ``batch_id``, ``kind``)."""
    schema = T.StructType([*quarantine_schema(spec).fields, T.StructField("kind", T.StringType(), True)])
    return spark.read.schema(schema).parquet(layout.quarantine(spec))


# --- trusted snapshots --------------------------------------------------------

COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("version", T.StringType(), False),
        T.StructField("batch_id", T.StringType(), False),
        T.StructField("partition_time", T.TimestampNTZType(), True),
        T.StructField("committed_at", T.TimestampNTZType(), False),
    ]
)


def _commits_path(root: str) -> str:
    return f"{root}/_commits"


def commit_log(spark: SparkSession, root: str) -> DataFrame | None:
    """All commits below ``root``; None before the first."""
    if path_exists(spark, _commits_path(root)) is False:
        return None
    try:
        return spark.read.schema(COMMIT_SCHEMA).parquet(_commits_path(root))
    except AnalysisException as exc:  # no commit log yet
        if "PATH_NOT_FOUND" in str(exc):
            return None
        raise


@dataclass(frozen=True)
class Head:
    """What a load needs of the commit log, read in one job."""

    version: str | None = None  # current version
    batch_id: str | None = None  # its batch
    stamp: dt.datetime | None = None  # its stamp
    batch_stamp: dt.datetime | None = None  # stamp under which the asked batch was last committed


def read_head(spark: SparkSession, root: str, batch_id: str = "") -> Head:
    """The latest commit below ``root`` and, if ``batch_id`` was committed before, its stamp."""
    commits = commit_log(spark, root)
    if commits is None:
        return Head()
    order = F.struct("committed_at", "version")
    own = F.when(F.col("batch_id") == str(batch_id), order)
    row = commits.agg(
        F.max_by(F.struct("version", "batch_id", "partition_time"), order).alias("last"),
        F.max_by("partition_time", own).alias("batch_stamp"),
    ).collect()[0]
    if row["last"] is None:
        return Head()
    return Head(row["last"]["version"], row["last"]["batch_id"], row["last"]["partition_time"], row["batch_stamp"])


def current_version_at(spark: SparkSession, root: str) -> str | None:
    """The latest committed version below ``root``, or None before the first commit."""
    return read_head(spark, root).version


def path_exists(spark: SparkSession, path: str) -> bool | None:
    """Whether ``path`` exists, asked of the Hadoop file system of the session.

    None where the JVM is not reachable (Spark Connect): callers then read
    and handle a missing path themselves.
    """
    jvm = getattr(spark, "_jvm", None)
    jsc = getattr(spark, "_jsc", None)
    if jvm is None or jsc is None:
        return None
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(jsc.hadoopConfiguration()).exists(hpath))


def write_version(df: DataFrame, root: str, version: str, sort_keys=()) -> str:
    """Write a new version folder (never the one being read); returns its path."""
    path = f"{root}/v={version}"
    out = df.sortWithinPartitions(*sort_keys) if sort_keys else df
    out.write.mode("overwrite").parquet(path)
    return path


class CommitConflict(RuntimeError):
    """Another writer committed since this one read the table."""


def _hadoop(spark: SparkSession, path: str):
    """The Hadoop path and its file system, or None where the JVM is not reachable."""
    jvm, jsc = getattr(spark, "_jvm", None), getattr(spark, "_jsc", None)
    if jvm is None or jsc is None:
        return None
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(jsc.hadoopConfiguration())


def folder_bytes(spark: SparkSession, path: str) -> int:
    """The size of all files below ``path``; 0 where it does not exist or the JVM is not reachable."""
    at = _hadoop(spark, path)
    if at is None or not at[1].exists(at[0]):
        return 0
    return int(at[1].getContentSummary(at[0]).getLength())


def _taken_numbers(spark: SparkSession, root: str) -> list[int]:
    at = _hadoop(spark, f"{root}/_numbers")
    if at is None or not at[1].exists(at[0]):
        return []
    names = [st.getPath().getName() for st in at[1].listStatus(at[0])]
    return sorted(int(n) for n in names if n.isdigit())


def commit_number(spark: SparkSession, root: str) -> int:
    """The last commit number taken below ``root``; a writer reads it before it reads the table."""
    return max(_taken_numbers(spark, root), default=0)


def commit_version(spark: SparkSession, root: str, version: str, batch_id: str, stamp: dt.datetime | None,
                   after: int | None = None) -> None:
    """Make a written version current: take the next commit number, then append the commit row.

    ``after``: the commit number that the writer started from. The number's
    marker file is created exclusively, so of two writers that started from
    the same number one commits and the other raises ``CommitConflict``; its
    version folder stays uncommitted. (Object stores without an exclusive
    create, and sessions without a JVM, need one writer per table.)
    """
    if after is not None:
        at = _hadoop(spark, f"{root}/_numbers/{after + 1}")
        if at is not None:
            try:
                if commit_number(spark, root) > after:
                    raise CommitConflict(f"{root}: another load committed number {after + 1}")
                at[1].create(at[0], False).close()
            except Py4JJavaError as exc:
                if "AlreadyExists" not in str(exc.java_exception):
                    raise
                raise CommitConflict(f"{root}: another load committed number {after + 1}") from exc
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    row = spark.createDataFrame([(version, str(batch_id), stamp, now)], COMMIT_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(_commits_path(root))
    if after is not None and after % KEPT_NUMBERS == 0:
        for number in _taken_numbers(spark, root)[:-KEPT_NUMBERS]:
            path, fs = _hadoop(spark, f"{root}/_numbers/{number}")
            fs.delete(path, False)


def expire_versions(spark: SparkSession, root: str, keep: int, folders: tuple[str, ...] | None = None) -> list[str]:
    """Delete committed versions older than the ``keep`` newest commits below ``root``.

    Only versions named in the commit log and still on disk are deleted, so
    the folder of a write in progress (not yet committed) is never touched,
    and nothing is deleted twice; folders of failed writes stay. ``folders``
    are the parents of the ``v=<version>`` folders (default ``root``; a mart
    refresh commits one version for five marts). ``keep`` 0 keeps everything.
    It needs the session's JVM. Returns the expired version names.
    """
    if keep <= 0:
        return []
    at = _hadoop(spark, root)
    if at is None:
        raise RuntimeError("expiring versions needs a session with a JVM; keep all versions (0) without one")
    parents = folders or (root,)
    present: set[str] = set()
    for parent in parents:
        path, fs = _hadoop(spark, parent)
        if fs.exists(path):
            names = [st.getPath().getName() for st in fs.listStatus(path)]
            present.update(n[2:] for n in names if n.startswith("v="))
    commits = commit_log(spark, root)
    if commits is None or len(present) <= keep:
        return []
    here = spark.createDataFrame([(v,) for v in sorted(present)], "version string")
    newest = commits.join(here, "version", "left_semi").groupBy("version").agg(F.max("committed_at").alias("at"))
    # versions on disk: at most ``keep`` and those committed or failed since the last expiry
    order = [r["version"] for r in newest.orderBy(F.desc("at"), F.desc("version")).collect()]
    for version in order[keep:]:
        for parent in parents:
            path, fs = _hadoop(spark, f"{parent}/v={version}")
            fs.delete(path, True)
    return order[keep:]


def read_current(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The current version below ``root`` (None before the first commit)."""
    version = current_version_at(spark, root)
    if version is None:
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{root}/v={version}")


def current_version(spark: SparkSession, layout: LakeLayout, spec: TableSpec) -> str | None:
    return current_version_at(spark, layout.trusted(spec))


def trusted_schema(spec: TableSpec) -> T.StructType:
    return T.StructType(spec.typed_schema.fields + [T.StructField("partition_time", T.TimestampNTZType(), True)])


def version_bytes(spark: SparkSession, layout: LakeLayout, spec: TableSpec, version: str) -> int:
    """About the size of a trusted snapshot's files; key buckets of all versions are counted, as they are shared."""
    return folder_bytes(spark, layout.trusted(spec) if spec.buckets else f"{layout.trusted(spec)}/v={version}")


def read_trusted_version(spark: SparkSession, layout: LakeLayout, spec: TableSpec, version: str | None) -> DataFrame:
    """A trusted snapshot; an empty typed frame for None (before the first load)."""
    if version is None:
        return spark.createDataFrame([], trusted_schema(spec))
    if spec.buckets:
        return read_buckets(spark, spec, bucket_folders(spark, layout, spec, version).values())
    if spec.join_buckets:
        keyed, unkeyed = read_join_buckets(spark, layout, spec, version)
        return keyed.union(unkeyed)
    return spark.read.schema(trusted_schema(spec)).parquet(f"{layout.trusted(spec)}/v={version}")


def read_trusted(spark: SparkSession, layout: LakeLayout, spec: TableSpec) -> DataFrame:
    """The current trusted snapshot; an empty typed frame before the first load."""
    return read_trusted_version(spark, layout, spec, current_version(spark, layout, spec))


def cluster_by_range(df: DataFrame, keys) -> DataFrame:
    """Rows dealt out in ranges of the keys: a key is in one file, unless it alone fills several (S9).

    A hash of the whole row parts the rows of one key, so that a hot key does
    not end in one task; it is the same however often a task is run. It orders
    the rows but is no column of theirs, so it is not shuffled.
    """
    return df.repartitionByRange(*keys, F.xxhash64(*df.columns))


def write_snapshot(df: DataFrame, layout: LakeLayout, spec: TableSpec, version: str, seen: Observation | None = None,
                   *metrics) -> str:
    """Write a new trusted snapshot, rows sorted by key inside each file and, if the spec says so, in ranges of the keys.

    ``metrics`` are observed on the rows as they are written (a range sort
    reads its input twice, so they are not taken below it).
    """
    rows = cluster_by_range(df, spec.keys) if spec.cluster and spec.keys else df
    return write_version(rows.observe(seen, *metrics) if seen is not None else rows, layout.trusted(spec), version, spec.keys)


# --- snapshots of hash buckets, joined where they lie ------------------------------
#
# trusted/<table>/v=<id>/keyed/     a bucketed table: a file per hash bucket of the keys
# trusted/<table>/v=<id>/unkeyed/   the rows with a NULL key part, which match nothing

def _present(keys):
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return present


def _bucket_table(path: str) -> str:
    return f"martforge_{hashlib.md5(path.encode()).hexdigest()}"


def write_join_buckets(df: DataFrame, layout: LakeLayout, spec: TableSpec, version: str) -> None:
    """Write a snapshot as a bucketed table; ``df`` is already dealt by its keys into ``spec.join_buckets`` partitions."""
    path = f"{layout.trusted(spec)}/v={version}"
    (df.write.format("parquet").mode("errorifexists").bucketBy(spec.join_buckets, *spec.keys).sortBy(*spec.keys)
     .option("path", f"{path}/keyed").saveAsTable(_bucket_table(f"{path}/keyed")))


def write_unkeyed(df: DataFrame, layout: LakeLayout, spec: TableSpec, version: str) -> None:
    df.write.mode("overwrite").parquet(f"{layout.trusted(spec)}/v={version}/unkeyed")


def read_join_buckets(spark: SparkSession, layout: LakeLayout, spec: TableSpec, version: str | None) -> tuple[DataFrame, DataFrame]:
    """The keyed rows, as a bucketed table, and those with a NULL key part.

    The session's catalog need not know the table: it is declared over the
    version's files.
    """
    schema = trusted_schema(spec)
    if version is None:
        none = spark.createDataFrame([], schema)
        return none, none
    path = f"{layout.trusted(spec)}/v={version}"
    name = _bucket_table(f"{path}/keyed")
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        keys = ", ".join(f"`{k}`" for k in spec.keys)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (path '{path}/keyed') "
                  f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {spec.join_buckets} BUCKETS")
    return spark.table(name).select(*schema.names), spark.read.schema(schema).parquet(f"{path}/unkeyed")


# --- change rows ---------------------------------------------------------------

def write_changes(rows: DataFrame, layout: LakeLayout, spec: TableSpec, batch_id: str) -> None:
    """Store a batch's change rows; a re-run of the batch replaces them."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(batch_folder(layout.changes(spec), batch_id))


def read_changes(spark: SparkSession, layout: LakeLayout, spec: TableSpec, batch_id: str) -> DataFrame:
    """The change rows of one batch (``operators.changes``)."""
    return spark.read.parquet(batch_folder(layout.changes(spec), batch_id))


def commit_snapshot(
    spark: SparkSession, layout: LakeLayout, spec: TableSpec, version: str, batch_id: str, stamp: dt.datetime | None,
    after: int | None = None,
) -> None:
    commit_version(spark, layout.trusted(spec), version, batch_id, stamp, after)


# --- key buckets of an upsert table ---------------------------------------------
#
# trusted/<table>/v=<id>/bucket=<b>/   the buckets that this version rewrote
# trusted/<table>/_buckets/v=<id>/     the folder of every bucket of this version

def bucket_of(spec: TableSpec):
    """The bucket of a row: by all key columns, NULLs too."""
    return F.pmod(F.hash(*[F.col(k) for k in spec.keys]), F.lit(spec.buckets))


def bucket_folders(spark: SparkSession, layout: LakeLayout, spec: TableSpec, version: str | None) -> dict[int, str]:
    """Bucket -> folder of a version (at most ``spec.buckets`` rows)."""
    if version is None:
        return {}
    rows = spark.read.schema("bucket int, folder string").parquet(f"{layout.trusted(spec)}/_buckets/v={version}")
    return {r["bucket"]: f"{layout.trusted(spec)}/{r['folder']}" for r in rows.collect()}


def read_buckets(spark: SparkSession, spec: TableSpec, folders) -> DataFrame:
    paths = sorted(folders)
    if not paths:
        return spark.createDataFrame([], trusted_schema(spec))
    return spark.read.schema(trusted_schema(spec)).parquet(*paths)


def touched_buckets(rows: DataFrame, spec: TableSpec) -> list[int]:
    """The buckets that the rows' keys fall into (at most ``spec.buckets``)."""
    return sorted(r["b"] for r in rows.select(bucket_of(spec).alias("b")).distinct().collect())


def write_buckets(df: DataFrame, layout: LakeLayout, spec: TableSpec, version: str, kept: dict[int, str],
                  touched: list[int]) -> None:
    """Write the touched buckets of a new version and the list of all its folders."""
    root = layout.trusted(spec)
    df.withColumn("bucket", bucket_of(spec)).repartition("bucket").sortWithinPartitions("bucket", *spec.keys).write.mode(
        "overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{root}/v={version}")
    rows = [(b, folder.removeprefix(f"{root}/")) for b, folder in kept.items() if b not in touched]
    rows += [(b, f"v={version}/bucket={b}") for b in touched]
    df.sparkSession.createDataFrame(rows, "bucket int, folder string").coalesce(1).write.mode("overwrite").parquet(
        f"{root}/_buckets/v={version}")


# --- state tables -------------------------------------------------------------

def read_watermarks(spark: SparkSession, layout: LakeLayout) -> DataFrame:
    """Per landed batch: table, batch id, stamp and row count."""
    from ..operators.audit import OK, read_audit

    audit = read_audit(spark, layout.audit)
    return audit.filter((F.col("operation") == "INSERT RAW") & (F.col("status") == OK)).select(
        "table_name", "batch_id", "partition_time", "rows_in"
    )


def latest_watermarks(spark: SparkSession, layout: LakeLayout) -> DataFrame:
    """Per table: the newest batch stamp and the number of batches seen."""
    return read_watermarks(spark, layout).groupBy("table_name").agg(
        F.max("partition_time").alias("partition_time"), F.countDistinct("batch_id").alias("n_batches")
    )
