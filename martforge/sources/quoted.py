"""Records of delimited files whose quoted values hold line breaks, read in splits.

Whether a line break ends a record depends on the quotes before it, from the
start of the file on. So the file is read twice, both times in splits as Spark
cuts it: first every split counts its quotes, and prefix sums over the splits
of a file (a row each) tell which splits start inside a quoted value. Then
every split walks through its lines with that start: a line break outside
quotes ends a record. What a split has before its first such break, and after
its last one, are pieces of records that cross splits; they are few (two a
split at most) and are put together by a small aggregate.

Both readings must cut the files alike, but the second one runs when the rows
are used, maybe under other session settings (a load bounds its tasks). So the
files are opened by a session of their own, which keeps the settings of that
moment: it is the opening session that cuts files, whichever runs the job.

A quote inside a value is written twice, as the reader's options say, so it
does not change the parity. A file whose quotes do not pair up is an error.
One record must fit in a task's memory; a file need not.
"""

from __future__ import annotations

import csv
import io
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE = '"'
MAX_SPLITS = 1 << 20  # starts of splits sent to the tasks at once: nine bytes each
_RECORD, _OPEN, _MIDDLE, _CLOSE = 0, 1, 2, 3  # a whole record; its first, a middle and its last piece
_PIECES = "path string, start long, kind int, first boolean, record string"


def _session_as_now(spark: SparkSession) -> SparkSession:
    """Another session with the settings that this one has now."""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if other.conf.get(key, None) != value and other.conf.isModifiable(key):
            other.conf.set(key, value)
    return other


def physical_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """value, path and start (of the split) of every line of the files; cut as the settings say now, whenever they are read."""
    lines = _session_as_now(spark).read.option("lineSep", "\n").text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    none = spark.sql("SELECT '' AS value, '' AS path, 0L AS start WHERE false")  # its jobs are those of ``spark``
    return none.union(lines)


def split_starts(lines: DataFrame) -> DataFrame:
    """path, start, inside: whether the split starts inside a quoted value; ``odd`` if the file's quotes do not pair up."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    splits = lines.groupBy("path", "start").agg(F.sum(quotes.cast("long")).alias("quotes"))
    of_file = Window.partitionBy("path")  # a row per split
    before = F.sum("quotes").over(of_file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    return splits.select("path", "start", (F.coalesce(before, F.lit(0)) % 2 == 1).alias("inside"),
                         (F.sum("quotes").over(of_file) % 2 == 1).alias("odd"))


class _Walk:
    """One split's lines, in order, batch by batch."""

    def __init__(self, path: str, start: int, inside: bool):
        self.path, self.start = path, start
        self.parity = self.began_inside = int(inside)
        self.held: list[pa.Array] = []  # lines of the record that is open
        self.ended = 0  # records that have ended in this split

    def take(self, lines: pa.Array) -> pa.RecordBatch | None:
        after = (self.parity + np.cumsum(pc.count_substring(lines, QUOTE).to_numpy(zero_copy_only=False))) % 2
        self.parity = int(after[-1])
        ends = np.flatnonzero(after == 0) + 1
        if not len(ends):
            self.held.append(lines)
            return None
        whole = pa.concat_arrays([*self.held, lines.slice(0, int(ends[-1]))])
        shift = len(whole) - int(ends[-1])
        offsets = pa.array(np.r_[0, ends + shift].astype(np.int32))
        records = pc.binary_join(pa.ListArray.from_arrays(offsets, whole), "\n")
        kinds = np.full(len(records), _RECORD, np.int32)
        if self.began_inside and not self.ended:
            kinds[0] = _CLOSE
        out = self._rows(records, kinds)
        self.ended += len(records)
        rest = lines.slice(int(ends[-1]))
        self.held = [rest] if len(rest) else []
        return out

    def end(self) -> pa.RecordBatch | None:
        if not self.held:
            return None
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, sum(map(len, self.held))], pa.int32()),
                                                            pa.concat_arrays(self.held)), "\n")
        kind = _MIDDLE if self.began_inside and not self.ended else _OPEN
        return self._rows(text, np.array([kind], np.int32))

    def _rows(self, records: pa.Array, kinds: np.ndarray) -> pa.RecordBatch:
        first = np.zeros(len(records), bool)
        first[0] = self.start == 0 and not self.ended
        n = len(records)
        return pa.RecordBatch.from_arrays(
            [pa.array([self.path] * n, pa.string()), pa.array(np.full(n, self.start, np.int64)), pa.array(kinds), pa.array(first),
             records.cast(pa.string())], names=["path", "start", "kind", "first", "record"])


def _pieces(known):
    """Records and pieces of the splits; a task has the lines of a split side by side and in order."""
    def run(batches):
        walk = None
        for batch in batches:
            paths, starts = batch.column("path"), batch.column("start").to_numpy()
            place = paths.dictionary_encode().indices.to_numpy()
            cuts = np.flatnonzero((np.diff(place) != 0) | (np.diff(starts) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if a == b:
                    continue
                path, start = paths[a].as_py(), int(starts[a])
                if walk is None or (walk.path, walk.start) != (path, start):
                    if walk is not None and (out := walk.end()) is not None:
                        yield out
                    own, inside = known.value[path]
                    at = bisect_left(own, start)
                    if at == len(own) or own[at] != start:
                        raise RuntimeError(f"{path}: split at {start} is not one of the first reading's")
                    walk = _Walk(path, start, bool(inside[at]))
                if (out := walk.take(batch.column("value").slice(a, b - a).cast(pa.string()))) is not None:
                    yield out
        if walk is not None and (out := walk.end()) is not None:
            yield out
    return run


def _joined(pieces: DataFrame) -> DataFrame:
    """The records of the pieces: an opening one and what follows up to its end."""
    # a split's closing piece stands before its opening one; windows over at most two rows a split
    order = Window.partitionBy("path").orderBy("start", F.col("kind") == _OPEN)
    nth = F.sum((F.col("kind") == _OPEN).cast("int")).over(order)
    grouped = pieces.withColumn("nth", nth).groupBy("path", "nth").agg(
        F.max("first").alias("first"), F.sort_array(F.collect_list(F.struct("start", "record"))).alias("parts"))
    return grouped.select("path", "first", F.array_join(F.transform("parts", lambda x: x["record"]), "\n").alias("record"))


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, first (whether it is its file's first) and record of every record that is not blank.

    The starts of the splits are found when this is called, one job over the files.
    """
    lines = physical_lines(spark, path)
    known: dict[str, tuple[list[int], list[bool]]] = {}
    rows = split_starts(lines).sort("path", "start").limit(MAX_SPLITS + 1).toLocalIterator()
    for n, row in enumerate(rows):
        if row["odd"]:
            raise ValueError(f"{row['path']}: a quoted value is not closed")
        if n == MAX_SPLITS:
            raise ValueError(f"{path}: more than {MAX_SPLITS} splits; read the files in several calls")
        own = known.setdefault(row["path"], ([], []))
        own[0].append(row["start"])
        own[1].append(row["inside"])
    pieces = lines.mapInArrow(_pieces(spark.sparkContext.broadcast(known)), _PIECES)
    whole = pieces.filter(F.col("kind") == _RECORD).select("path", "first", "record")
    if any(any(inside) for _, inside in known.values()):
        whole = whole.union(_joined(pieces.filter(F.col("kind") != _RECORD)))
    return whole.select("path", "first", F.regexp_replace("record", "\r$", "").alias("record")).filter("record <> ''")


def header_line(spark: SparkSession, path: str | list[str]) -> str:
    """The first line of one of the files (a header has no line breaks)."""
    lines = physical_lines(spark, path).filter("start = 0").select("value").limit(1).collect()
    if not lines:
        raise ValueError(f"{path}: no header")
    return lines[0]["value"].removeprefix("﻿").removesuffix("\r")


def header_names(line: str, sep: str) -> list[str]:
    return next(csv.reader(io.StringIO(line), delimiter=sep, quotechar=QUOTE), [])


def read_quoted(spark: SparkSession, path: str | list[str], names: list[str], header: str, corrupt: str, options: dict[str, str]) -> DataFrame:
    """The records' values as text columns, their ``path``, and the record in ``corrupt`` if its fields do not fit.

    All files must have the same header line.
    """
    records = read_records(spark, path)
    head = F.regexp_replace("record", "^﻿", "")
    other = F.raise_error(F.concat(F.col("path"), F.lit(": another header: "), F.col("record")))
    # a reader of single records: their line breaks stay as they are
    opts = {**{k: v for k, v in options.items() if k not in ("header", "enforceSchema", "inferSchema", "multiLine")},
            "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    schema = ", ".join(f"`{c}` string" for c in [*names, corrupt])
    body = records.filter(F.when(F.col("first") & (head != header), other.cast("boolean")).otherwise(~F.col("first")))
    parsed = body.select("path", F.from_csv("record", schema, opts).alias("row"))
    return parsed.select("path", "row.*")
