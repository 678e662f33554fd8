"""Registered queries of awkward loads: re-runs, late batches, malformed files, several files at once.

Each loads a given table (or parts of it) through files, as the other load
queries do, and returns what a user would look at afterwards.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..config import LOAD_MERGE, MERGE_SNAPSHOT, MERGE_UPSERT, NA_WORDS
from ..functions.dates import STAMP_LAG_HOURS
from ..operators import changes, deltas
from ..session import session_conf, work_dir
from ..sources import files, flatfile, layers
from ..streaming import file_stream
from . import standins as S
from .as_of import trusted_as_of
from .catalog import register
from .load import load_batch, load_file

LATER = S.BATCH1_TIME + dt.timedelta(days=31)


def _load_orders(spark, layout, sf_dir, which: int, stamp, spec=S.ORDERS_SPEC):
    batch_id = S.BATCH_IDS[which - 1]
    path = S.write_batch_file(spark, S.orders_batch_text(spark, sf_dir, which), spec, f"orders_{batch_id}.csv")
    return load_batch(spark, spec, flatfile.read_flat_file(spark, path, spec), layout, batch_id, stamp)


@register("raw_rerun", f"""
SELECT '{S.BATCH_IDS[0]}' AS batch_id, '{LATER:%Y-%m}' AS partition_month, COUNT(*) AS n_rows FROM {S.orders_batch_sql(1)}
""")
def raw_rerun(spark, sf_dir):
    """A batch that is run again in the next month stands in the raw history once."""
    layout = layers.LakeLayout(work_dir(spark, "lake"))
    for stamp in (S.BATCH1_TIME, LATER):
        _load_orders(spark, layout, sf_dir, 1, stamp)
    return layers.read_raw(spark, layout, S.ORDERS_SPEC).groupBy("batch_id", "partition_month").agg(
        F.count(F.lit(1)).alias("n_rows"))


@register("merge_out_of_order", S.orders_expected_sql(2, S.BATCH2_TIME))
def merge_out_of_order(spark, sf_dir):
    """The first batch run again after the second one brings nothing back."""
    layout = layers.LakeLayout(work_dir(spark, "lake"))
    for which, stamp in ((1, S.BATCH1_TIME), (2, S.BATCH2_TIME), (1, S.BATCH1_TIME)):
        _load_orders(spark, layout, sf_dir, which, stamp)
    return layers.read_trusted(spark, layout, S.ORDERS_SPEC)


_CHANGED = f"""(SELECT * REPLACE (CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate)
  FROM {S.orders_batch_sql(2)})"""


@register("incremental_same_day", f"""
WITH b AS (SELECT * FROM {_CHANGED}
           WHERE o_orderdate IS NULL OR o_orderdate >= (SELECT MAX(o_orderdate) FROM {S.orders_batch_sql(1)}))
SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM b
UNION ALL
SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) FROM {S.orders_batch_sql(1)}
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)
""")
def incremental_same_day(spark, sf_dir):
    """An upsert by modification date applies rows of the watermark's own day and rows without a date."""
    spec = replace(S.ORDERS_SPEC, load_mode=LOAD_MERGE, merge_mode=MERGE_UPSERT, modified="o_orderdate")
    layout = layers.LakeLayout(work_dir(spark, "lake"))
    for which, stamp in ((1, S.BATCH1_TIME), (2, S.BATCH2_TIME)):
        rows = S.orders_batch_typed(spark, sf_dir, which)
        if which == 2:
            rows = rows.withColumn("o_orderdate", F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderdate")))
        path = S.write_batch_file(spark, S.render_text(rows, spec), spec, f"orders_{which}.csv")
        load_file(spark, spec, path, layout, S.BATCH_IDS[which - 1], stamp)
    return layers.read_trusted(spark, layout, spec).select("o_orderkey", "o_totalprice", "o_orderdate")


@register("archive_two_files_one_day", f"""
SELECT DATE '{S.BATCH1_TIME.date()}' AS ingest_date, '{S.BATCH_IDS[0]}' AS batch_id, COUNT(*) AS n_rows FROM {S.orders_batch_sql(1)}
UNION ALL
SELECT DATE '{S.BATCH1_TIME.date()}', '{S.BATCH_IDS[1]}', COUNT(*) FROM {S.orders_batch_sql(2)}
""")
def archive_two_files_one_day(spark, sf_dir):
    """Both orders files, loaded and archived on one day."""
    layout = layers.LakeLayout(work_dir(spark, "lake"))
    for which, batch_id in enumerate(S.BATCH_IDS, start=1):
        path = S.write_batch_file(spark, S.orders_batch_text(spark, sf_dir, which), S.ORDERS_SPEC, f"orders_{which}.csv")
        load_file(spark, S.ORDERS_SPEC, path, layout, batch_id, S.BATCH1_TIME, archive=True)
    archived = spark.read.parquet(layout.archive(S.ORDERS_SPEC))
    return archived.groupBy(F.col("ingest_date").cast("date").alias("ingest_date"),
                            F.lpad(F.col("batch_id").cast("string"), 6, "0").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("n_rows"))


def _customer_file(spark, sf_dir, name: str, spoil: bool) -> str:
    """The customers as a delivered file; if spoiled, every hundredth line has a field too many."""
    text = S.render_text(S.table(spark, sf_dir, "customer"), S.CUSTOMER_SPEC)
    path = f"{work_dir(spark, 'landing')}/{name}"
    if spoil:
        name_of = F.concat("c_name", F.when(F.col("c_custkey").cast("bigint") % 100 == 0, F.lit(";extra")).otherwise(F.lit("")))
        text = text.withColumn("c_name", name_of)
    # a quote character that the reader does not know: the separator in the name parts fields
    flatfile.write_flat_file(text, path, S.CUSTOMER_SPEC, quote="\x01" if spoil else '"')
    return path


@register("land_csv_malformed", """
SELECT c_custkey % 100 = 0 AS is_malformed, COUNT(*) AS n_rows FROM customer GROUP BY 1
""")
def land_csv_malformed(spark, sf_dir):
    """Lines with a field too many are told from good ones."""
    path = _customer_file(spark, sf_dir, "customer.csv", True)
    rows = flatfile.read_flat_file(spark, path, S.CUSTOMER_SPEC, malformed=flatfile.KEEP)
    return rows.groupBy(F.col(flatfile.MALFORMED).isNotNull().alias("is_malformed")).agg(F.count("c_custkey").alias("n_rows"))


@register("quarantine_rerun", """
SELECT 1 AS run, COUNT(*) FILTER (c_custkey % 100 = 0) AS n_quarantined, COUNT(*) FILTER (c_custkey % 100 <> 0) AS n_trusted FROM customer
UNION ALL
SELECT 2, 0, COUNT(*) FROM customer
""")
def quarantine_rerun(spark, sf_dir):
    """A spoiled file, then the corrected one under the same batch id."""
    layout = layers.LakeLayout(work_dir(spark, "lake"))
    out = None
    for run, spoil in ((1, True), (2, False)):
        path = _customer_file(spark, sf_dir, f"customer_{run}.csv", spoil)
        result = load_file(spark, S.CUSTOMER_SPEC, path, layout, S.BATCH_IDS[0], S.BATCH1_TIME, quarantine=True)
        aside = layers.read_quarantine(spark, layout, S.CUSTOMER_SPEC).count()  # the next run replaces the folder
        trusted = layers.read_trusted_version(spark, layout, S.CUSTOMER_SPEC, result.version)
        row = trusted.agg(F.lit(run).alias("run"), F.lit(aside).cast("long").alias("n_quarantined"),
                          F.count(F.lit(1)).alias("n_trusted"))
        out = row if out is None else out.union(row)
    return out


@register("stream_two_extracts", """
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal + 1.0 ELSE c_acctbal END AS c_acctbal FROM customer
""")
def stream_two_extracts(spark, sf_dir):
    """Two extracts in one micro-batch: the newer file decides per key, whatever its name."""
    spec = replace(S.CUSTOMER_SPEC, load_mode=LOAD_MERGE, merge_mode=MERGE_UPSERT)
    landing, layout = work_dir(spark, "stream", "landing"), layers.LakeLayout(work_dir(spark, "stream", "lake"))
    customers = S.table(spark, sf_dir, "customer")
    changed = customers.filter("c_custkey % 2 = 0").withColumn("c_acctbal", F.col("c_acctbal") + F.lit(1.0))
    for folder, rows in (("z_older", customers), ("a_newer", changed)):
        flatfile.write_flat_file(S.render_text(rows, spec), f"{landing}/{folder}", spec)
    file_stream.ingest_stream(spark, spec, f"{landing}/*", layout, work_dir(spark, "stream", "checkpoint"),
                              clock=lambda epoch: S.BATCH1_TIME)
    return layers.read_trusted(spark, layout, spec).select("c_custkey", "c_acctbal")


@register("new_files_listed", """
SELECT DISTINCT 'segment=' || c_mktsegment AS folder, CAST(1 AS BIGINT) AS n_files FROM customer
WHERE c_mktsegment > (SELECT MIN(c_mktsegment) FROM customer)
""")
def new_files_listed(spark, sf_dir):
    """One customer file per segment in a folder of its own; the first segment's has been taken."""
    folder = work_dir(spark, "landing")
    customers = S.table(spark, sf_dir, "customer").withColumn("segment", F.col("c_mktsegment"))
    customers.repartition("segment").write.partitionBy("segment").option("header", "true").csv(folder)
    listed = files.list_files(spark, folder, "*.csv")
    first = listed.agg(F.min("file_name").alias("file_name"))
    new = files.new_files(listed, first)
    return new.groupBy(F.regexp_extract("file_name", "^(.*)/", 1).alias("folder")).agg(F.count(F.lit(1)).alias("n_files"))


@register("land_stamp_lag", f"SELECT CAST({STAMP_LAG_HOURS} AS BIGINT) AS lag_hours, COUNT(*) AS n_rows FROM customer")
def land_stamp_lag(spark, sf_dir):
    """The default stamp lies behind the current time."""
    stamped = layers.stamp_land(S.render_text(S.table(spark, sf_dir, "customer"), S.CUSTOMER_SPEC))
    lag = F.timestamp_diff("HOUR", F.col("partition_time"), F.localtimestamp())
    return stamped.groupBy(lag.alias("lag_hours")).agg(F.count(F.lit(1)).alias("n_rows"))


@register("upsert_buckets", f"""
SELECT o_orderkey, o_totalprice FROM {S.orders_batch_sql(2)}
UNION ALL
SELECT o_orderkey, o_totalprice FROM {S.orders_batch_sql(1)} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {S.orders_batch_sql(2)})
""")
def upsert_buckets(spark, sf_dir):
    """Both orders batches upserted into a table of key buckets."""
    spec = replace(S.ORDERS_SPEC, load_mode=LOAD_MERGE, merge_mode=MERGE_UPSERT, buckets=8)
    layout = layers.LakeLayout(work_dir(spark, "lake"))
    for which, stamp in ((1, S.BATCH1_TIME), (2, S.BATCH2_TIME)):
        path = S.write_batch_file(spark, S.render_text(S.orders_batch_typed(spark, sf_dir, which), spec), spec, f"o{which}.csv")
        load_file(spark, spec, path, layout, S.BATCH_IDS[which - 1], stamp)
    return layers.read_trusted(spark, layout, spec).select("o_orderkey", "o_totalprice")


_NA = ", ".join(f"'{w}'" for w in NA_WORDS)


@register("land_csv_quoted_breaks", f"""
SELECT doc_id, lang, source, n_chars, CASE WHEN text NOT IN ({_NA}) THEN sha256(text) END AS text_sha256,
  CASE WHEN text NOT IN ({_NA}) THEN CAST(len(text) - len(replace(text, chr(10), '')) AS BIGINT) END AS n_breaks
FROM documents
""")
def land_csv_quoted_breaks(spark, sf_dir):
    """The documents as files with line breaks inside quoted values, loaded in splits that begin anywhere."""
    spec, layout = S.DOCUMENTS_SPEC, layers.LakeLayout(work_dir(spark, "lake"))
    path = S.write_batch_file(spark, S.render_text(S.table(spark, sf_dir, "documents"), spec), spec, "documents.csv")
    with session_conf(spark, {"spark.sql.files.openCostInBytes": "65536"}):  # small files too go to all cores
        load_file(spark, spec, path, layout, S.BATCH_IDS[0], S.BATCH1_TIME)
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    return layers.read_trusted(spark, layout, spec).select(
        "doc_id", "lang", "source", "n_chars", F.sha2("text", 256).alias("text_sha256"), breaks.cast("long").alias("n_breaks"))


@register("copy_files_dated", f"""
SELECT '{files.dated_folder(files.ORIGINAL, S.BATCH1_TIME.date())}/orders/' || year(o_orderdate) AS folder,
  CAST(1 AS BIGINT) AS n_files, CAST(0 AS BIGINT) AS n_again, COUNT(*) AS n_rows, CAST(SUM(o_orderkey) AS BIGINT) AS key_sum
FROM orders GROUP BY year(o_orderdate)
""")
def copy_files_dated(spark, sf_dir):
    """One orders file per year, copied by the executors into the day's folder under another prefix; a second run copies nothing."""
    root = work_dir(spark, "copy")
    day = files.dated_folder(files.ORIGINAL, S.BATCH1_TIME.date())
    orders = S.render_text(S.table(spark, sf_dir, "orders"), S.ORDERS_SPEC).withColumn("year", F.substring("o_orderdate", 1, 4))
    orders.repartition("year").write.partitionBy("year").options(sep=";", header="true").csv(f"{root}/landing/extract")
    runs = [files.copy_new_files(spark, f"{root}/landing", f"{root}/archive", f"{root}/copied", run, "*.csv",
                                 "extract/year=", f"{day}/orders/") for run in ("run-1", "run-2")]
    folder = F.regexp_extract("name", f"({day}/orders/[0-9]+)/", 1).alias("folder")
    counts = [r.withColumn("name", F.col("target")).groupBy(folder).agg(F.count(F.lit(1)).alias(n))
              for r, n in zip(runs, ("n_files", "n_again"))]
    copied = spark.read.option("recursiveFileLookup", "true").options(sep=";", header="true").csv(f"{root}/archive")
    rows = copied.withColumn("name", F.col("_metadata.file_path")).groupBy(folder).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("o_orderkey").cast("long")).alias("key_sum"))
    return rows.join(counts[0], "folder", "left").join(counts[1], "folder", "left").select(
        "folder", "n_files", F.coalesce("n_again", F.lit(0)).alias("n_again"), "n_rows", "key_sum")


@register("trusted_key_ranges", """
SELECT CAST(0 AS BIGINT) AS n_overlapping, COUNT(*) AS n_rows, MIN(l_orderkey) AS low, MAX(l_orderkey) AS high FROM lineitem
""")
def trusted_key_ranges(spark, sf_dir):
    """The files of a trusted snapshot of the order lines: how many share a key range with the file before them."""
    spec, layout = S.star_specs()["detail"], layers.LakeLayout(work_dir(spark, "lake"))
    path = S.write_batch_file(spark, S.render_text(S.table(spark, sf_dir, "lineitem"), spec), spec, "lineitem.csv")
    with session_conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}):  # several files at any size
        load_file(spark, spec, path, layout, S.BATCH_IDS[0], S.BATCH1_TIME)
    ranges = layers.read_trusted(spark, layout, spec).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min("l_orderkey").alias("low"), F.max("l_orderkey").alias("high"), F.count(F.lit(1)).alias("n"))
    before = F.max("high").over(Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))  # a row per file
    # a key whose rows end one file and begin the next is in both
    return ranges.withColumn("before", before).agg(
        F.count(F.when(F.col("low") < F.col("before"), 1)).alias("n_overlapping"), F.sum("n").alias("n_rows"),
        F.min("low").alias("low"), F.max("high").alias("high"))


def _partly_changed(spark, sf_dir, which: int):
    """The orders batches; of batch 2 every third order keeps its price."""
    rows = S.orders_batch_typed(spark, sf_dir, which)
    if which == 2:
        price = F.col("o_totalprice") - F.when(F.col("o_orderkey") % 3 == 0, 1.0).otherwise(0.0)
        rows = rows.withColumn("o_totalprice", F.round(price, 2))
    return rows


def _load_partly_changed(spark, sf_dir, spec):
    layout = layers.LakeLayout(work_dir(spark, "lake"))
    for which, stamp in ((1, S.BATCH1_TIME), (2, S.BATCH2_TIME)):
        path = S.write_batch_file(spark, S.render_text(_partly_changed(spark, sf_dir, which), spec), spec, f"o{which}.csv")
        load_file(spark, spec, path, layout, S.BATCH_IDS[which - 1], stamp)
    return layout


_PRICE = "CAST(CAST({} AS DECIMAL(18,2)) AS DOUBLE)"
_OLD = f"(SELECT o_orderkey AS k, {_PRICE.format('o_totalprice')} AS price FROM {S.orders_batch_sql(1)})"
_NEW = (f"(SELECT o_orderkey AS k, {_PRICE.format('CASE WHEN o_orderkey % 3 = 0 THEN round(o_totalprice - 1.0, 2) ELSE o_totalprice END')} "
        f"AS price FROM {S.orders_batch_sql(2)})")


@register("merge_change_rows", f"""
SELECT coalesce(o.k, n.k) AS o_orderkey, CASE WHEN o.k IS NULL THEN 'I' WHEN n.k IS NULL THEN 'D' ELSE 'U' END AS action,
  o.price AS old_price, n.price AS new_price
FROM {_OLD} o FULL OUTER JOIN {_NEW} n ON o.k = n.k
WHERE o.k IS NULL OR n.k IS NULL OR o.price <> n.price
""")
def merge_change_rows(spark, sf_dir):
    """What the second orders batch changed: stored rows with old and new values, unchanged orders left out."""
    spec = replace(S.ORDERS_SPEC, track_changes=True)
    layout = _load_partly_changed(spark, sf_dir, spec)
    return layers.read_changes(spark, layout, spec, S.BATCH_IDS[1]).select(
        "o_orderkey", "action", F.col("old.o_totalprice").alias("old_price"), F.col("new.o_totalprice").alias("new_price"))


@register("merge_changes_applied", f"SELECT k AS o_orderkey, price AS o_totalprice FROM {_NEW}")
def merge_changes_applied(spark, sf_dir):
    """The stored changes of the second batch, applied to the snapshot of the first."""
    spec = replace(S.ORDERS_SPEC, track_changes=True)
    layout = _load_partly_changed(spark, sf_dir, spec)
    versions = layers.commit_log(spark, layout.trusted(spec)).filter(F.col("batch_id") == S.BATCH_IDS[0])
    old = layers.read_trusted_version(spark, layout, spec, versions.first()["version"])
    stored = layers.read_changes(spark, layout, spec, S.BATCH_IDS[1])
    return changes.apply_changes(old, stored, spec.keys).select("o_orderkey", "o_totalprice")


@register("merge_join_buckets", f"""
SELECT 'snapshot' AS mode, k AS o_orderkey, price AS o_totalprice FROM {_NEW}
UNION ALL
SELECT 'upsert', coalesce(n.k, o.k), coalesce(n.price, o.price) FROM {_OLD} o FULL OUTER JOIN {_NEW} n ON o.k = n.k
""")
def merge_join_buckets(spark, sf_dir):
    """Both orders batches merged into tables of hash buckets, which keep one version."""
    out = None
    for mode in (MERGE_SNAPSHOT, MERGE_UPSERT):
        spec = replace(S.ORDERS_SPEC, merge_mode=mode, join_buckets=8, keep_versions=1)
        layout = _load_partly_changed(spark, sf_dir, spec)
        rows = layers.read_trusted(spark, layout, spec).select(F.lit(mode).alias("mode"), "o_orderkey", "o_totalprice")
        out = rows if out is None else out.union(rows)
    return out


_KEPT = f"SELECT k, price FROM {_OLD} WHERE k NOT IN (SELECT k FROM {_NEW})"


@register("trusted_as_of_stamps", f"""
SELECT m.mode, 1 AS after_batch, k AS o_orderkey, price AS o_totalprice
FROM {_OLD}, (SELECT unnest(['snapshot', 'upsert']) AS mode) m
UNION ALL
SELECT m.mode, 2, k, price FROM {_NEW}, (SELECT unnest(['snapshot', 'upsert']) AS mode) m
UNION ALL
SELECT 'upsert', 2, k, price FROM ({_KEPT})
""")
def trusted_as_of_stamps(spark, sf_dir):
    """The orders as of both stamps, from the raw history; the first snapshot itself is no longer kept."""
    out = None
    for mode in (MERGE_SNAPSHOT, MERGE_UPSERT):
        spec = replace(S.ORDERS_SPEC, merge_mode=mode, keep_versions=1)
        layout = _load_partly_changed(spark, sf_dir, spec)
        for nth, stamp in ((1, S.BATCH1_TIME), (2, S.BATCH2_TIME)):
            rows = trusted_as_of(spark, layout, spec, stamp).select(
                F.lit(mode).alias("mode"), F.lit(nth).alias("after_batch"), "o_orderkey", "o_totalprice")
            out = rows if out is None else out.union(rows)
    return out


@register("mart_sums_from_changes", f"""
SELECT b.o_custkey, COUNT(*) AS n_orders, CAST(SUM(CAST(n.price AS DECIMAL(18,2))) AS DOUBLE) AS total_price
FROM {S.orders_batch_sql(2)} b JOIN {_NEW} n ON b.o_orderkey = n.k GROUP BY 1
""")
def mart_sums_from_changes(spark, sf_dir):
    """Orders and their value per customer: the sums after the first batch, kept current by the second one's change rows."""
    spec = replace(S.ORDERS_SPEC, track_changes=True)
    layout = _load_partly_changed(spark, sf_dir, spec)
    by, measures = ["o_custkey"], ["o_totalprice"]
    first = deltas.change_sums(layers.read_changes(spark, layout, spec, S.BATCH_IDS[0]), by, measures)
    path = f"{work_dir(spark, 'mart')}/sums"
    first.write.parquet(path)
    second = deltas.change_sums(layers.read_changes(spark, layout, spec, S.BATCH_IDS[1]), by, measures)
    mart = deltas.apply_sums(spark.read.parquet(path), second, by, measures)
    return mart.select("o_custkey", F.col(deltas.COUNT).alias("n_orders"), F.col("o_totalprice").cast("double").alias("total_price"))
