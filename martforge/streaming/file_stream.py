"""Load files as they arrive: the streaming file source plus ``foreachBatch``.

The reference reacts to a bucket event by listing source and destination and
copying what is missing, then a daily job loads it. Here the streaming file
source lists the landing folder, and its checkpoint remembers which files
were taken, so each file is loaded once. Every micro-batch goes through the
same batch load (raw, trusted, audit). ``availableNow`` processes what is
there and stops, which suits a scheduled run; a processing-time trigger
keeps it running.

``foreachBatch`` is at-least-once: a failed micro-batch is replayed with the
same id. The raw history is keyed by that id and overwritten on replay, and
the trusted snapshot is rebuilt from raw, so a replay does not duplicate rows.
A batch that had been committed keeps its stamp.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import LOAD_FULL, MERGE_UPSERT, TableSpec
from ..plans.load import BatchResult, load_batch
from ..sources.flatfile import FAIL, KEEP, read_flat_file
from ..sources.layers import LakeLayout


MAX_FILES = 1000  # files of one micro-batch; the rest wait for the next


def stream_batch_id(epoch_id: int) -> str:
    return f"s{epoch_id:012d}"


def _load_files(
    spark: SparkSession, spec: TableSpec, files: list[tuple[str, dt.datetime]], layout: LakeLayout, batch_id: str,
    stamp: dt.datetime | None, quarantine: bool,
) -> list[BatchResult]:
    """The files of one micro-batch, oldest first.

    An upsert takes them together: every row carries its file's time and path,
    so the newest file decides per key. A file of a snapshot or full load is
    the whole table, so each is a batch of its own and the newest one stays.
    """
    malformed = KEEP if quarantine else FAIL
    if spec.load_mode == LOAD_FULL or spec.merge_mode != MERGE_UPSERT:
        return [load_batch(spark, spec, read_flat_file(spark, path, spec, malformed), layout,
                           f"{batch_id}-{i:06d}", stamp, quarantine) for i, (path, _) in enumerate(files)]
    text = read_flat_file(spark, [path for path, _ in files], spec, malformed, with_file=True)
    return [load_batch(spark, spec, text, layout, batch_id, stamp, quarantine)]


def _writer(
    spark: SparkSession,
    spec: TableSpec,
    landing: str,
    layout: LakeLayout,
    checkpoint: str,
    results: list[BatchResult] | None,
    clock: Callable[[int], dt.datetime | None] | None,
    max_files_per_trigger: int | None,
    archive_dir: str | None,
    quarantine: bool,
):
    # the stream finds the files; the batch reader reads them, so both take the same headers
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length bigint, content binary"
    ).option("maxFilesPerTrigger", str(max_files_per_trigger or MAX_FILES))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    arrived = reader.load(landing).select("path", "modificationTime")

    def per_batch(df: DataFrame, epoch_id: int) -> None:
        stamp = clock(epoch_id) if clock else None
        order = df.orderBy("modificationTime", "path").collect()  # at most max_files_per_trigger names
        files = [(r["path"], r["modificationTime"]) for r in order]
        loaded = _load_files(df.sparkSession, spec, files, layout, stream_batch_id(epoch_id), stamp, quarantine)
        if results is not None:  # a long-running stream keeps its results in the audit table only
            results.extend(loaded)

    return (
        arrived.writeStream.foreachBatch(per_batch)
        .option("checkpointLocation", checkpoint)
        .queryName(f"ingest_{spec.table_name}")
    )


def ingest_stream(
    spark: SparkSession,
    spec: TableSpec,
    landing: str,
    layout: LakeLayout,
    checkpoint: str,
    clock: Callable[[int], dt.datetime | None] | None = None,
    max_files_per_trigger: int | None = None,
    archive_dir: str | None = None,
    quarantine: bool = False,
) -> list[BatchResult]:
    """Load every file in ``landing`` not yet taken, then stop (``availableNow``).

    ``clock(epoch_id)`` gives the batch stamp (default: now minus 3 hours).
    ``archive_dir`` moves loaded files there (best effort: recovery relies
    on the raw history, not on the archive). ``quarantine`` sets bad rows
    aside instead of stopping the stream. Returns one result per load.
    """
    results: list[BatchResult] = []
    query = _writer(spark, spec, landing, layout, checkpoint, results, clock, max_files_per_trigger,
                    archive_dir, quarantine).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return results


def start_stream(
    spark: SparkSession,
    spec: TableSpec,
    landing: str,
    layout: LakeLayout,
    checkpoint: str,
    interval: str = "1 minute",
    max_files_per_trigger: int | None = None,
    archive_dir: str | None = None,
    quarantine: bool = False,
) -> StreamingQuery:
    """Keep loading files as they arrive, one micro-batch per ``interval``; returns the running query."""
    return _writer(spark, spec, landing, layout, checkpoint, None, None, max_files_per_trigger,
                   archive_dir, quarantine).trigger(processingTime=interval).start()
