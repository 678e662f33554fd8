"""Token ids as flat unsigned integer files with 64-bit document offsets, memory-mapped when read.

The documents are dealt to ranges of their id and sorted; each task writes the
ids of its range to one file, the place of each document in it (64-bit, one
more than there are documents) to a second and the document ids to a third.
A file is written under a name of the attempt's own and renamed when whole, so
a task that runs twice leaves one file. The manifest has a row per file; prefix
sums over it give the base of each partition: a document's place among the ids
of all documents is its partition's base plus its place in the file.

The folder must be one that executors can open as files (a shared mount),
since readers map the files into memory.

Defined results: a null or empty text is its end id alone; rows with a null id
come first; rows that share an id stand in order of their text's hash; an
empty table gives an empty manifest and no rows.
"""

from __future__ import annotations

import os
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import arrow_map, written
from .text import text_slices
from .tokens import END_ID, encoder

MANIFEST = "part int, path string, width int, n_nulls long, n_docs long, n_tokens long"
READ_TOKENS = 1 << 20  # ids that a reader passes on at a time


def local_path(folder: str) -> str:
    url = urlparse(folder)
    if url.scheme not in ("", "file"):
        raise ValueError(f"token files need a folder that executors can open as files, not {url.scheme}")
    return url.path


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id",
                      text_col: str = "text", end_id: int = END_ID, id_bytes: int = 2) -> DataFrame:
    """Write the files; returns the manifest with ``base``, the ids in all files before.

    ``id_bytes``: 2 for vocabularies of up to 65,536 ids, else 4; an id that does not fit is an error.
    """
    target = local_path(folder)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    by = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by)

    def write(batches):
        tokens, context = encoder(tokenizer_path, end_id), TaskContext.get()
        part = context.partitionId()
        os.makedirs(target, exist_ok=True)
        stem = f"{target}/part-{part:06d}"
        own = f"{stem}.attempt-{context.taskAttemptId()}"
        docs_seen = nulls = total = 0
        with open(f"{own}.ids", "wb") as ids_file, open(f"{own}.offsets", "wb") as offsets, open(f"{own}.docs", "wb") as names:
            np.zeros(1, "<i8").tofile(offsets)
            for rows, texts in text_slices(batches):
                ids, sizes = tokens.encode(texts)
                if len(ids) and int(ids.max()) >> 8 * id_bytes:
                    raise ValueError(f"token id {ids.max()} does not fit {id_bytes} bytes")
                ids.astype(f"<u{id_bytes}").tofile(ids_file)
                (total + np.cumsum(sizes)).astype("<i8").tofile(offsets)
                column = rows.column("doc_id")
                column.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tofile(names)
                docs_seen, nulls, total = docs_seen + rows.num_rows, nulls + column.null_count, total + len(ids)
        for kind in ("ids", "offsets", "docs"):
            if docs_seen:
                os.replace(f"{own}.{kind}", f"{stem}.{kind}")
            else:
                os.remove(f"{own}.{kind}")
        if docs_seen:
            yield pa.RecordBatch.from_pylist([{"part": part, "path": stem, "width": id_bytes, "n_nulls": nulls,
                                               "n_docs": docs_seen, "n_tokens": total}], schema=_MANIFEST_TYPE)

    manifest = written(arrow_map(dealt, write, MANIFEST), "token_manifest")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


_MANIFEST_TYPE = pa.schema([("part", pa.int32()), ("path", pa.string()), ("width", pa.int32()),
                            ("n_nulls", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])


def _read(batches):
    for batch in batches:
        for file in batch.to_pylist():
            offsets = np.memmap(f"{file['path']}.offsets", "<i8", "r")
            names = np.memmap(f"{file['path']}.docs", "<i8", "r")
            ids = np.memmap(f"{file['path']}.ids", f"<u{file['width']}", "r")
            first = 0
            while first < file["n_docs"]:
                last = int(np.searchsorted(offsets, offsets[first] + READ_TOKENS, "right")) - 1
                last = min(max(last, first + 1), file["n_docs"])
                span = np.array(offsets[first: last + 1])
                wide = ids[span[0]: span[-1]].astype("<u4")
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.array(names[first:last]), mask=np.arange(first, last) < file["n_nulls"]),
                    pa.array(file["base"] + span[:-1]), pa.array(np.diff(span)),
                    pa.array([wide[a:b].tobytes() for a, b in zip((span[:-1] - span[0]).tolist(),
                                                                  (span[1:] - span[0]).tolist())], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])
                first = last


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian unsigned 32-bit) of every document in the files."""
    files = manifest.select("part", "path", "width", "n_nulls", "n_docs", "base")
    spread = files.repartition(max(1, files.count()))  # a file to a task
    return arrow_map(spread, _read, "doc_id long, start long, n_tokens long, ids binary")
