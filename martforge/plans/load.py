"""One batch of one table through land -> raw -> trusted, and the mart refresh.

The reference's daily load per table, as Spark jobs:

1. stamp the text batch and write it into the raw history (one pass over the file);
2. row count and stamp (the watermark) are observed during that write;
3. full load: type the rows of this stamp and write them as the new snapshot;
   merge: type the batch's rows, keep the latest row per key and
   write the merged snapshot, then classify it against the current snapshot
   on the key columns only (inserted / updated / deleted);
4. commit the snapshot and append the audit row.

Each write is the barrier for the next step (no sleeps). Everything after
step 1 reads the written raw partition, so a lost executor recomputes from
parquet, not from the source file. An empty batch is refused and the
current snapshot stays (D12).
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import LOAD_FULL, LOAD_RAW_ONLY, MERGE_UPSERT, TableSpec
from ..functions.casts import flag_rows, typed_projection
from ..functions.dates import ntz_lit
from ..operators.audit import ERROR, OK, SKIPPED, AuditRecord, append_audit
from ..operators.changes import SAME, change_rows
from ..operators.dedup import assert_unique_keys, changed_since, latest_per_key
from ..operators.merge import apply_merge, change_counts, merge_in_place
from ..session import bounded_tasks, in_bounded_tasks, shuffle_partitions_for
from ..sources import layers as L
from ..sources.files import archive_by_date
from ..sources.flatfile import FAIL, KEEP, MALFORMED, read_flat_file


@dataclass
class BatchResult:
    table_name: str
    batch_id: str
    stamp: dt.datetime | None
    rows_in: int
    rows_inserted: int = 0
    rows_updated: int = 0
    rows_deleted: int = 0
    null_keys: int = 0
    version: str | None = None
    status: str = OK
    rows_rejected: int = 0
    rows_collapsed: int = 0


def _null_key_count(keys) -> F.Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return F.count(F.when(cond, 1))


# later files of a streamed batch win; rows of a batch load have no file
_ORDER = ("partition_time", *[name for name, _ in L.FILE_COLUMNS])


def typed_batch(
    spark: SparkSession, layout: L.LakeLayout, spec: TableSpec, stamp: dt.datetime, batch_id: str = "",
    quarantine: bool = False, modified_since=None,
) -> tuple[DataFrame, int]:
    """The typed rows of a batch, before they are reduced to one per key, and the number of rejected rows.

    Full load: the rows of this stamp. Merge: the batch's rows from this stamp
    on. With ``quarantine`` rows whose text does not cast are written to the
    batch's quarantine folder (text kept, failing column named) instead of
    failing the load. ``modified_since`` keeps only rows modified since, and
    undated ones (incremental by modification date, P9).
    """
    rows = L.raw_batch_rows(spark, layout, spec, stamp, exact=spec.load_mode == LOAD_FULL, batch_id=batch_id)
    rejected = 0
    if quarantine:
        flagged = flag_rows(rows, spec, _ORDER)
        bad = flagged.filter(F.col("bad_column").isNotNull()).select(
            *[F.col(f"__text_{c}").alias(c) for c in spec.lake_columns], "partition_time", "bad_column")
        rejected = L.write_quarantine(bad, layout, spec, batch_id, "value")
        typed = flagged.filter(F.col("bad_column").isNull()).select(*spec.lake_columns, *_ORDER)
    else:
        typed = typed_projection(rows, spec, _ORDER)
    if modified_since is not None:
        typed = changed_since(typed, spec.modified, modified_since)
    return typed, rejected


def _merge_in_buckets(spark, batch: DataFrame, layout: L.LakeLayout, spec: TableSpec, old: str | None, new: str,
                      path: str) -> tuple[DataFrame, DataFrame]:
    """Write the new version of a table of join buckets; returns the batch and the target, read again."""
    present = L._present(spec.keys)
    batch.repartition(spec.join_buckets, *spec.keys).write.mode("overwrite").parquet(path)
    batch = spark.read.schema(L.trusted_schema(spec)).parquet(path)
    keyed, unkeyed = L.read_join_buckets(spark, layout, spec, old)
    dealt = batch.filter(present).repartition(spec.join_buckets, *spec.keys)
    L.write_join_buckets(merge_in_place(keyed, dealt, spec.keys, spec.merge_mode), layout, spec, new)
    rest = batch.filter(~present)
    L.write_unkeyed(rest.union(unkeyed) if spec.merge_mode == MERGE_UPSERT else rest, layout, spec, new)
    return batch, keyed.union(unkeyed)


@in_bounded_tasks
def load_batch(
    spark: SparkSession,
    spec: TableSpec,
    text: DataFrame,
    layout: L.LakeLayout,
    batch_id: str,
    batch_time: dt.datetime | str | None = None,
    quarantine: bool = False,
    force: bool = False,
    unique_keys: bool = False,
) -> BatchResult:
    """Load one text batch (lake-named string columns) into raw and trusted.

    A batch that was committed before keeps its stamp unless ``batch_time``
    says otherwise. A batch older than the committed one lands in raw only:
    applying it would bring back deleted rows (``force`` applies it).
    ``quarantine``: set malformed lines and rows that do not cast aside
    instead of failing the whole load. ``unique_keys``: refuse a merge batch
    that has several rows for a key (they are reduced to the latest, and
    counted as ``rows_collapsed``, otherwise).
    """
    audits: list[AuditRecord] = []
    table, batch_id = spec.table_name, str(batch_id)
    try:
        after = L.commit_number(spark, layout.trusted(spec))
        head = L.read_head(spark, layout.trusted(spec), batch_id)
        rejected = 0
        if MALFORMED in text.columns:
            if quarantine:
                rejected = L.write_quarantine(
                    text.filter(F.col(MALFORMED).isNotNull()), layout, spec, batch_id, "line")
            text = text.filter(F.col(MALFORMED).isNull()).drop(MALFORMED)
        land = L.stamp_land(text, batch_time or head.batch_stamp, with_files=True)
        mark = L.append_raw(land, layout, spec, batch_id)
        stamp, rows_in = mark["partition_time"], int(mark["rows_in"])
        shuffle_partitions_for(spark, L.folder_bytes(spark, L.batch_folder(layout.raw(spec), batch_id)))
        audits.append(AuditRecord(table, batch_id, "INSERT RAW", OK, stamp, rows_in=rows_in))
        skip = None
        if rows_in == 0:
            stamp, skip = None, "empty batch"
        elif spec.load_mode == LOAD_RAW_ONLY:
            skip = "raw only"
        elif head.stamp is not None and stamp < head.stamp and not force:
            skip = f"older than the committed batch {head.batch_id} ({head.stamp})"
        if skip:
            audits.append(AuditRecord(table, batch_id, "LOAD", SKIPPED, stamp, rows_in, message=skip))
            return BatchResult(table, batch_id, stamp, rows_in, status=SKIPPED, rows_rejected=rejected)

        target = L.read_trusted_version(spark, layout, spec, head.version)
        since = None
        if spec.modified and spec.load_mode != LOAD_FULL:
            since = target.agg(F.max(spec.modified).alias("m")).collect()[0]["m"]
        typed, uncast = typed_batch(spark, layout, spec, stamp, batch_id, quarantine, since)
        rejected += uncast
        version = f"{batch_id}-{uuid.uuid4().hex[:8]}"
        if spec.load_mode == LOAD_FULL:
            written = Observation(f"snapshot_{table}_{version}")
            rows = typed.drop(*[name for name, _ in L.FILE_COLUMNS])
            L.write_snapshot(rows, layout, spec, version, written, F.count(F.lit(1)).alias("n"),
                             _null_key_count(spec.keys).alias("null_keys"))
            n_new = written.get
            n_old = target.agg(F.count(F.lit(1)).alias("n")).collect()[0]
            counts = {"rows_inserted": n_new["n"], "rows_updated": 0, "rows_deleted": n_old["n"],
                      "null_keys": n_new["null_keys"]}
            operation, collapsed = "FULL LOAD", 0
        else:
            if unique_keys:
                assert_unique_keys(typed, spec.keys, f"{table} batch {batch_id}")
            seen = Observation(f"batch_{table}_{version}")
            # cast first, then the latest row per key (D8: '12' and '12.0' are one key)
            batch = latest_per_key(typed.observe(seen, F.count(F.lit(1)).alias("n")), spec.keys, _ORDER).drop(
                *[name for name, _ in L.FILE_COLUMNS])
            if spec.buckets:
                # the typed batch is written once; only the buckets of its keys are read and written again
                path = L.write_version(batch, f"{layout.trusted(spec)}/_batches", version)
                batch = spark.read.schema(L.trusted_schema(spec)).parquet(path)
                touched = L.touched_buckets(batch, spec)
                folders = L.bucket_folders(spark, layout, spec, head.version)
                target = L.read_buckets(spark, spec, [folders[b] for b in touched if b in folders])
                L.write_buckets(apply_merge(target, batch, spec.keys, spec.merge_mode), layout, spec, version, folders,
                                touched)
            elif spec.join_buckets:
                # the batch is written dealt as the target is, and joined with it bucket by bucket
                path = f"{layout.trusted(spec)}/_batches/v={version}"
                batch, target = _merge_in_buckets(spark, batch, layout, spec, head.version, version, path)
            else:
                L.write_snapshot(apply_merge(target, batch, spec.keys, spec.merge_mode), layout, spec, version)
            # what was written holds the batch's rows, by their stamp: no second pass over the text
            beside = spec.buckets or spec.join_buckets
            source = batch if beside else L.read_trusted_version(spark, layout, spec, version)
            if spec.merge_mode == MERGE_UPSERT and not beside:
                source = source.filter(F.col("partition_time") == ntz_lit(stamp))
                if head.stamp == stamp:  # rows of an earlier batch with this very stamp are not this batch's
                    source = batch
            counts = change_counts(target, source, spec.keys, spec.merge_mode).collect()[0].asDict()
            operation = "MERGE"
            if spec.track_changes:
                rows = change_rows(target, source, spec.keys, spec.merge_mode)
                L.write_changes(rows.filter(F.col("action") != SAME), layout, spec, batch_id)
            collapsed = int(seen.get["n"]) - int(counts["rows_inserted"]) - int(counts["rows_updated"])
        L.commit_snapshot(spark, layout, spec, version, batch_id, stamp, after)
        L.expire_versions(spark, layout.trusted(spec), spec.keep_versions)
        result = BatchResult(
            table, batch_id, stamp, rows_in,
            int(counts["rows_inserted"]), int(counts["rows_updated"]), int(counts["rows_deleted"]),
            int(counts["null_keys"]), version, rows_rejected=rejected, rows_collapsed=collapsed,
        )
        audits.append(AuditRecord(
            table, batch_id, operation, OK, stamp, rows_in, result.rows_inserted, result.rows_updated,
            result.rows_deleted, result.null_keys, result.rows_rejected, result.rows_collapsed, version,
        ))
        return result
    except Exception as exc:
        audits.append(AuditRecord(table, batch_id, "LOAD", ERROR, message=str(exc)))
        raise
    finally:
        append_audit(spark, layout.audit, audits)


def load_file(
    spark: SparkSession,
    spec: TableSpec,
    path: str,
    layout: L.LakeLayout,
    batch_id: str,
    batch_time: dt.datetime | str | None = None,
    quarantine: bool = False,
    force: bool = False,
    archive: bool = False,
) -> BatchResult:
    """Load a delivered file; a missing file is skipped with an audit row (D18).

    The marts can still be refreshed from the last committed snapshots.
    ``archive`` adds the file's rows, as text, to the dated archive once they are loaded.
    """
    try:
        with bounded_tasks(spark):
            text = read_flat_file(spark, path, spec, malformed=KEEP if quarantine else FAIL)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        append_audit(spark, layout.audit, [
            AuditRecord(spec.table_name, str(batch_id), "LOAD", SKIPPED, rows_in=0, message=f"missing file {path}")
        ])
        return BatchResult(spec.table_name, str(batch_id), None, 0, status=SKIPPED)
    result = load_batch(spark, spec, text, layout, batch_id, batch_time, quarantine, force)
    if archive and result.stamp is not None:
        archive_by_date(text, layout.archive(spec), result.stamp.date(), batch_id)
    return result
