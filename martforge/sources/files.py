"""File listings, byte copies by the executors and the dated archive.

The reference copies every source object whose name is not yet at the
destination, rescanning both listings on each event. As DataFrames that is
an anti join of two name sets, and a copy in tasks, a file at a time. For
continuous arrival the streaming file source (``streaming.file_stream``) keeps
its own ledger in the checkpoint.
"""

from __future__ import annotations

import datetime as dt
import posixpath
import re
import uuid
import zlib
from urllib.parse import quote, urlparse

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORIGINAL, PROCESSED = "original", "processed"  # fixed values: the top folders of the dated archive
COPIED, KEPT = "copied", "kept"
COPY_BYTES = 4 << 20  # of a file held at a time
COPY_SCHEMA = "file_name string, modified timestamp, length long, target string, crc32 long, status string"


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """The files below ``folder``, at any depth (``path``, ``file_name``, ``length``, ``modified``).

    ``file_name`` is the path relative to the folder, so equal base names in
    two folders are two files. Uses the binary-file source without its content
    column, so only the listing is read; ``_``/``.`` marker files are skipped,
    and so are files without a byte.
    """
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
               .option("recursiveFileLookup", "true").load(folder))
    root = urlparse(folder).path.rstrip("/") + "/"
    base = F.regexp_extract("path", r"([^/]+)$", 1)
    return listing.filter(~base.startswith("_") & ~base.startswith(".")).select(
        "path",
        F.expr("substr(path, locate(:root, path) + length(:root))".replace(":root", _sql_text(root))).alias("file_name"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def new_files(candidates: DataFrame, ledger: DataFrame, name: str = "file_name") -> DataFrame:
    """Candidate names (relative paths) not yet in the ledger (anti join on the name, J5).

    Names ending in ``/`` are folders and never candidates.
    """
    cands = candidates.select(name).filter(~F.col(name).endswith("/")).distinct()
    return cands.join(ledger.select(name).distinct(), name, "left_anti")


def archive_by_date(rows: DataFrame, folder: str, ingest_date: dt.date | str, batch_id: str) -> None:
    """Add a batch's converted rows under ``ingest_date=YYYY-MM-DD/batch_id=<id>`` (the reference's Y/M/D folders).

    Archiving the same batch again replaces that batch only; other files of the day stay.
    """
    day = ingest_date if isinstance(ingest_date, str) else ingest_date.isoformat()
    (
        rows.withColumn("ingest_date", F.lit(day))
        .withColumn("batch_id", F.lit(str(batch_id)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_date", "batch_id")
        .parquet(folder)
    )


# --- byte copies ---------------------------------------------------------------

def dated_folder(kind: str, day: dt.date) -> str:
    """The folder of a day's files: ``original/Y/M/D`` or ``processed/Y/M/D``."""
    return f"{kind}/{day:%Y/%m/%d}"


def rewritten(name: str, source_prefix: str, target_prefix: str):
    """The name at the destination: the first occurrence of ``source_prefix`` becomes ``target_prefix``."""
    if not source_prefix:
        return F.concat(F.lit(target_prefix), F.col(name))
    at = F.instr(F.col(name), source_prefix)
    return F.when(at == 0, F.col(name)).otherwise(F.concat(
        F.substring(F.col(name), F.lit(1), at - 1), F.lit(target_prefix), F.substr(F.col(name), at + len(source_prefix))))


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    at = urlparse(uri)
    if at.scheme in ("", "file"):
        return pafs.LocalFileSystem(), at.path if at.scheme == "" else uri[len("file:"):].removeprefix("//")
    return pafs.FileSystem.from_uri(f"{at.scheme}://{at.netloc}{quote(at.path)}")


def _crc32(fs: pafs.FileSystem, path: str) -> int:
    crc = 0
    with fs.open_input_stream(path) as f:
        while block := f.read(COPY_BYTES):
            crc = zlib.crc32(block, crc)
    return crc


def _copy_one(source: str, target: str, length: int) -> tuple[int, str]:
    """Copy one file under a temporary name, then rename it; returns its crc32 and what was done."""
    fs_in, path_in = _file_system(source)
    fs_out, path_out = _file_system(target)
    there = fs_out.get_file_info(path_out)
    if there.type == pafs.FileType.File and there.size == length:
        crc = _crc32(fs_in, path_in)
        if crc == _crc32(fs_out, path_out):  # an earlier run ended before it noted the file
            return crc, KEPT
    folder, base = posixpath.split(path_out)
    fs_out.create_dir(folder, recursive=True)
    aside, crc, n = f"{folder}/_copying-{uuid.uuid4().hex}-{base}", 0, 0
    try:
        with fs_in.open_input_stream(path_in) as f, fs_out.open_output_stream(aside) as out:
            while block := f.read(COPY_BYTES):
                out.write(block)
                crc, n = zlib.crc32(block, crc), n + len(block)
        if n != length:
            raise OSError(f"{source}: {n} bytes read, {length} listed")
        fs_out.move(aside, path_out)
    except BaseException:
        if fs_out.get_file_info(aside).type == pafs.FileType.File:
            fs_out.delete_file(aside)
        raise
    return crc, COPIED


def _copy_batches(batches):
    for batch in batches:
        done = [_copy_one(x["path"], x["target"], x["length"]) for x in batch.to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("file_name", "modified", "length", "target")), pa.array([crc for crc, _ in done], pa.int64()),
             pa.array([status for _, status in done], pa.string())], names=["file_name", "modified", "length", "target", "crc32", "status"])


def read_copied(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger: every file that was copied, a row a run."""
    schema = f"{COPY_SCHEMA}, run_id string"
    try:
        return spark.read.schema(schema).parquet(ledger)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], schema)


def copy_new_files(spark: SparkSession, source: str, target: str, ledger: str, run_id: str, glob: str = "*",
                   source_prefix: str = "", target_prefix: str = "", tasks: int | None = None) -> DataFrame:
    """Copy the files below ``source`` that are not whole at ``target`` yet; returns the run's ledger rows.

    A file's name below ``target`` is its name below ``source`` with the first
    ``source_prefix`` replaced (``dated_folder`` makes day folders). A file is
    done if the ledger has it with this size and date and the target still has
    a file of this size: one that was changed, half copied or lost is copied
    again. Executors copy a file each, block by block, under a temporary name
    that listings leave out, and rename it when all bytes are there, so a task
    that is run twice, or a run that is started again, leaves whole files only.
    A run's ledger rows are written after its files; run again under the same
    id, it replaces them.
    """
    if not re.fullmatch(r"[\w.-]+", run_id):
        raise ValueError(f"run id {run_id!r}: only letters, digits, '.', '_' and '-'")
    root = target.rstrip("/")
    listed = list_files(spark, source, glob).withColumn(
        "target", F.concat(F.lit(f"{root}/"), rewritten("file_name", source_prefix, target_prefix)))
    noted = read_copied(spark, ledger).filter(F.col("run_id") != run_id).select("file_name", "modified", "length").distinct()
    whole = _listed_or_none(spark, root).select(F.concat(F.lit(f"{root}/"), F.col("file_name")).alias("target"), "length")
    done = listed.join(noted, ["file_name", "modified", "length"], "left_semi").join(whole, ["target", "length"], "left_semi")
    new = listed.join(done.select("file_name"), "file_name", "left_anti")
    dealt = new.select("path", "file_name", "modified", "length", "target").repartition(
        tasks or spark.sparkContext.defaultParallelism, "file_name")
    run = f"{ledger}/run_id={run_id}"
    dealt.mapInArrow(_copy_batches, COPY_SCHEMA).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(run)
    return spark.read.schema(COPY_SCHEMA).parquet(run)


def _listed_or_none(spark: SparkSession, folder: str) -> DataFrame:
    try:
        return list_files(spark, folder)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], "path string, file_name string, length long, modified timestamp")
