"""Registered queries: one per operator of the survey, each with its oracle SQL.

Every query takes ``(spark, sf_dir)``, reads the whole test tables (or data
Spark derives from them) and returns a DataFrame. The oracle SQL computes the
same rows in DuckDB over the same parquet files; column names match.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LOAD_FULL, LOAD_MERGE, MERGE_SNAPSHOT, MERGE_UPSERT
from ..functions import casts
from ..functions.dates import month_range, ntz_lit
from ..operators import audit, dedup, indicators, marts, merge
from ..session import work_dir
from ..sources import files, flatfile, layers
from ..streaming import file_stream
from . import standins as S

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return wrap


def _date_parts_sql(expr: str, prefix: str) -> str:
    return (
        f"{expr} AS {prefix}_date, CAST(year({expr}) AS INTEGER) AS {prefix}_year, "
        f"CAST(month({expr}) AS INTEGER) AS {prefix}_month, CAST(day({expr}) AS INTEGER) AS {prefix}_day"
    )


# --- marts (S8, J1-J3, A4, P10, P11) ----------------------------------------

@register("mart_pedidos", f"""
SELECT l.*, h.o_custkey, h.o_orderstatus, h.o_totalprice, h.o_orderdate, h.o_orderpriority, h.o_duedate
FROM lineitem l JOIN {S.HEADER_SQL} h ON l.l_orderkey = h.o_orderkey
""")
def mart_pedidos(spark, sf_dir):
    return marts.fact_orders(S.table(spark, sf_dir, "lineitem"), S.header(spark, sf_dir), S.TEST_STAR)


@register("mart_cliente", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def mart_cliente(spark, sf_dir):
    return marts.customer_dim(S.table(spark, sf_dir, "customer"), S.TEST_STAR)


@register("mart_produto", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def mart_produto(spark, sf_dir):
    return marts.product_dim(S.table(spark, sf_dir, "part"), S.TEST_STAR)


@register("mart_tempo", f"""
SELECT {_date_parts_sql('h.o_orderdate', 'order')}, {_date_parts_sql('h.o_duedate', 'due')},
       {_date_parts_sql('l.l_shipdate', 'ship')}
FROM part p JOIN lineitem l ON p.p_partkey = l.l_partkey JOIN {S.HEADER_SQL} h ON l.l_orderkey = h.o_orderkey
""")
def mart_tempo(spark, sf_dir):
    return marts.time_dim(
        S.table(spark, sf_dir, "part"), S.table(spark, sf_dir, "lineitem"), S.header(spark, sf_dir), S.TEST_STAR
    )


@register("mart_vendedor", """
SELECT DISTINCT l.l_suppkey, s.s_name, s.s_nationkey, s.s_acctbal
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
""")
def mart_vendedor(spark, sf_dir):
    return marts.salesperson_dim(
        S.header(spark, sf_dir), S.table(spark, sf_dir, "lineitem"), S.table(spark, sf_dir, "supplier"), S.TEST_STAR
    )


@register("mart_calendario", f"SELECT DISTINCT {_date_parts_sql('o_orderdate', 'order')} FROM orders")
def mart_calendario(spark, sf_dir):
    return marts.calendar_dim(S.header(spark, sf_dir), S.TEST_STAR)


# --- indicators (A5-A7, W2, P12) --------------------------------------------

@register("ind_orders_over_3_products", """
SELECT COUNT(*) AS n_orders FROM (
  SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING COUNT(DISTINCT l_partkey) > 3)
""")
def ind_orders_over_3_products(spark, sf_dir):
    return indicators.orders_over_n_products(S.table(spark, sf_dir, "lineitem"), S.TEST_STAR, 3)


@register("ind_top3_by_lead_time", """
SELECT p_size, p_partkey, total_qty, sales_rank FROM (
  SELECT p.p_size, p.p_partkey, s.total_qty,
         CAST(ROW_NUMBER() OVER (PARTITION BY p.p_size ORDER BY s.total_qty DESC, p.p_partkey ASC) AS INTEGER)
           AS sales_rank
  FROM (SELECT l_partkey, SUM(l_quantity) AS total_qty FROM lineitem GROUP BY l_partkey) s
  JOIN part p ON s.l_partkey = p.p_partkey)
WHERE sales_rank <= 3
""")
def ind_top3_by_lead_time(spark, sf_dir):
    return indicators.top_products_by_lead_time(
        S.table(spark, sf_dir, "lineitem"), S.table(spark, sf_dir, "part"), S.TEST_STAR, 3
    )


@register("ind_orders_per_customer", "SELECT o_custkey, COUNT(*) AS n_orders FROM orders GROUP BY o_custkey")
def ind_orders_per_customer(spark, sf_dir):
    return indicators.orders_per_customer(S.header(spark, sf_dir), S.TEST_STAR)


@register("ind_qty_by_order_date", """
SELECT o.o_orderdate, SUM(l.l_quantity) AS total_qty
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderdate
""")
def ind_qty_by_order_date(spark, sf_dir):
    return indicators.qty_by_order_date(S.table(spark, sf_dir, "lineitem"), S.header(spark, sf_dir), S.TEST_STAR)


DUE_MONTH = "1998-09"


def _due_sql(min_total: float) -> str:
    start, end = month_range(DUE_MONTH)
    return f"""
SELECT o_orderkey, o_custkey, o_totalprice, o_duedate FROM {S.HEADER_SQL} h
WHERE o_duedate >= DATE '{start}' AND o_duedate < DATE '{end}' AND o_totalprice > {min_total}
"""


def _due_query(min_total: float) -> Query:
    def run(spark, sf_dir):
        start, end = month_range(DUE_MONTH)
        return indicators.due_orders(
            S.header(spark, sf_dir), S.TEST_STAR, DUE_MONTH, min_total,
            extra_filter=S.due_month_on_order_date(start, end),
        )

    return run


register("ind_due_orders", _due_sql(1000.0))(_due_query(1000.0))
register("ind_due_orders_250k", _due_sql(250000.0))(_due_query(250000.0))


# --- cast rules (P4a-P4d) over dirty text built from whole tables ----------------
# Variant per row: (l_orderkey + l_linenumber) % n.

_V = "(l_orderkey + l_linenumber)"


def _variant(n: int):
    return (F.col("l_orderkey") + F.col("l_linenumber")) % n


@register("cast_int", f"""
WITH d AS (
  SELECT l_orderkey, l_linenumber,
         CASE {_V} % 5 WHEN 0 THEN CAST(l_partkey AS VARCHAR) WHEN 1 THEN CAST(l_partkey AS VARCHAR) || '.0'
              WHEN 2 THEN CAST(l_partkey AS VARCHAR) || '.7' WHEN 3 THEN ' ' ELSE '-' END AS text_value
  FROM lineitem)
SELECT l_orderkey, l_linenumber, text_value,
       CASE WHEN text_value = ' ' OR text_value = '-' THEN NULL
            ELSE CAST(split_part(text_value, '.', 1) AS BIGINT) END AS int_value
FROM d
""")
def cast_int(spark, sf_dir):
    li = S.table(spark, sf_dir, "lineitem")
    key = F.col("l_partkey").cast("string")
    v = _variant(5)
    text = (F.when(v == 0, key).when(v == 1, F.concat(key, F.lit(".0"))).when(v == 2, F.concat(key, F.lit(".7")))
            .when(v == 3, F.lit(" ")).otherwise(F.lit("-")))
    d = li.select("l_orderkey", "l_linenumber", text.alias("text_value"))
    return d.select("l_orderkey", "l_linenumber", "text_value", casts.int_rule(F.col("text_value")).alias("int_value"))


@register("cast_float", f"""
WITH p AS (SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS t FROM lineitem),
d AS (
  SELECT l_orderkey, l_linenumber,
         CASE {_V} % 6 WHEN 0 THEN t WHEN 1 THEN replace(t, '.', ',') WHEN 2 THEN ' ' WHEN 3 THEN '-'
              WHEN 4 THEN 'abc' ELSE '1.' || replace(t, '.', ',') END AS text_value
  FROM p)
SELECT l_orderkey, l_linenumber, text_value,
       CASE WHEN text_value = ' ' OR text_value = '-' THEN NULL
            ELSE TRY_CAST(replace(text_value, ',', '.') AS DOUBLE) END AS float_value
FROM d
""")
def cast_float(spark, sf_dir):
    li = S.table(spark, sf_dir, "lineitem")
    t = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    comma = F.replace(t, F.lit("."), F.lit(","))
    v = _variant(6)
    text = (F.when(v == 0, t).when(v == 1, comma).when(v == 2, F.lit(" ")).when(v == 3, F.lit("-"))
            .when(v == 4, F.lit("abc")).otherwise(F.concat(F.lit("1."), comma)))
    d = li.select("l_orderkey", "l_linenumber", text.alias("text_value"))
    return d.select("l_orderkey", "l_linenumber", "text_value", casts.float_rule(F.col("text_value")).alias("float_value"))


@register("cast_date", f"""
WITH d AS (
  SELECT l_orderkey, l_linenumber,
         CASE {_V} % 4 WHEN 0 THEN strftime(l_shipdate, '%Y-%m-%d')
              WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d') || ' 13:45:00' WHEN 2 THEN ' ' ELSE '-' END AS text_value
  FROM lineitem)
SELECT l_orderkey, l_linenumber, text_value,
       CASE WHEN text_value = ' ' OR text_value = '-' THEN NULL
            ELSE CAST(substr(text_value, 1, 10) AS DATE) END AS date_value
FROM d
""")
def cast_date(spark, sf_dir):
    li = S.table(spark, sf_dir, "lineitem")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    v = _variant(4)
    text = (F.when(v == 0, day).when(v == 1, F.concat(day, F.lit(" 13:45:00"))).when(v == 2, F.lit(" "))
            .otherwise(F.lit("-")))
    d = li.select("l_orderkey", "l_linenumber", text.alias("text_value"))
    return d.select("l_orderkey", "l_linenumber", "text_value", casts.date_rule(F.col("text_value")).alias("date_value"))


@register("cast_other", """
WITH d AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_returnflag = 'R' THEN 'True' ELSE 'False' END AS bool_text,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS ts_text,
         l_returnflag AS flag_text
  FROM lineitem)
SELECT l_orderkey, l_linenumber, bool_text, CAST(bool_text AS BOOLEAN) AS bool_value,
       ts_text, CAST(ts_text AS TIMESTAMP) AS ts_value, CAST(flag_text AS VARCHAR) AS flag_value
FROM d
""")
def cast_other(spark, sf_dir):
    li = S.table(spark, sf_dir, "lineitem")
    d = li.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "R", F.lit("True")).otherwise(F.lit("False")).alias("bool_text"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("ts_text"),
        F.col("l_returnflag").alias("flag_text"),
    )
    return d.select(
        "l_orderkey", "l_linenumber",
        "bool_text", casts.other_rule(F.col("bool_text"), "boolean").alias("bool_value"),
        "ts_text", casts.other_rule(F.col("ts_text"), "timestamp_ntz").alias("ts_value"),
        casts.other_rule(F.col("flag_text"), "string").alias("flag_value"),
    )


_LI_SELECTOR = "(l_orderkey + l_linenumber)"


@register("trusted_typed", S.expected_typed_sql("lineitem", S.LINEITEM_SPEC, _LI_SELECTOR))
def trusted_typed(spark, sf_dir):
    li = S.table(spark, sf_dir, "lineitem")
    text = S.render_text(li, S.LINEITEM_SPEC, F.col("l_orderkey") + F.col("l_linenumber"))
    return casts.typed_projection(text, S.LINEITEM_SPEC)


# --- de-duplication and merge (W1, A3, P7-P9, J4, M1-M5) --------------------------

_LI_KEYS = ["l_orderkey", "l_linenumber"]
_LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
            "l_linestatus"]


def _desc(cols) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


@register("latest_per_key", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY {_desc(['l_shipdate'] + _LI_REST)}) AS rn
  FROM lineitem)
WHERE rn = 1
""")
def latest_per_key_q(spark, sf_dir):
    return dedup.latest_per_key(S.table(spark, sf_dir, "lineitem"), _LI_KEYS, ["l_shipdate"])


EVENTS_WATERMARK = dt.datetime(2024, 1, 29)


@register("incremental_by_modified", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
                               ORDER BY {_desc(['ts', 'event_id', 'event_type', 'value', 'props'])}) AS rn
  FROM events WHERE ts >= TIMESTAMP '{EVENTS_WATERMARK.isoformat(sep=' ')}' OR ts IS NULL)
WHERE rn = 1
""")
def incremental_by_modified(spark, sf_dir):
    changed = dedup.changed_since(S.table(spark, sf_dir, "events"), "ts", EVENTS_WATERMARK)
    return dedup.latest_per_key(changed, ["user_id"], ["ts"])


@register("merge_key_check", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
""")
def merge_key_check(spark, sf_dir):
    return dedup.duplicate_keys(S.table(spark, sf_dir, "lineitem"), _LI_KEYS)


def _stamped(df: DataFrame, stamp: dt.datetime) -> DataFrame:
    return df.withColumn("partition_time", ntz_lit(stamp))


def _merge_inputs(spark, sf_dir):
    target = _stamped(S.orders_batch_typed(spark, sf_dir, 1), S.BATCH1_TIME)
    batch = _stamped(S.orders_batch_typed(spark, sf_dir, 2), S.BATCH2_TIME)
    return target, batch


def _stamped_sql(which: int, stamp: dt.datetime) -> str:
    return f"(SELECT *, TIMESTAMP '{stamp.isoformat(sep=' ')}' AS partition_time FROM {S.orders_batch_sql(which)})"


_T_SQL, _S_SQL = _stamped_sql(1, S.BATCH1_TIME), _stamped_sql(2, S.BATCH2_TIME)
_COUNTS_SQL = f"""
  (SELECT COUNT(*) FROM {_S_SQL} s WHERE s.o_orderkey NOT IN (SELECT o_orderkey FROM {_T_SQL})) AS ins,
  (SELECT COUNT(*) FROM {_S_SQL} s JOIN {_T_SQL} t ON s.o_orderkey = t.o_orderkey) AS upd,
  (SELECT COUNT(*) FROM {_T_SQL} t WHERE t.o_orderkey NOT IN (SELECT o_orderkey FROM {_S_SQL})) AS del
"""


@register("merge_classify", f"""
WITH c AS (SELECT {_COUNTS_SQL})
SELECT 'I' AS action, ins AS n_rows FROM c UNION ALL SELECT 'U', upd FROM c UNION ALL SELECT 'D', del FROM c
""")
def merge_classify(spark, sf_dir):
    target, batch = _merge_inputs(spark, sf_dir)
    return merge.counts_as_rows(merge.change_counts(target, batch, ["o_orderkey"]))


@register("merge_snapshot", f"SELECT * FROM {_S_SQL}")
def merge_snapshot(spark, sf_dir):
    target, batch = _merge_inputs(spark, sf_dir)
    return merge.apply_merge(target, batch, ["o_orderkey"], MERGE_SNAPSHOT)


@register("merge_upsert", f"""
SELECT * FROM {_S_SQL}
UNION ALL
SELECT * FROM {_T_SQL} t WHERE t.o_orderkey NOT IN (SELECT o_orderkey FROM {_S_SQL})
""")
def merge_upsert(spark, sf_dir):
    target, batch = _merge_inputs(spark, sf_dir)
    return merge.apply_merge(target, batch, ["o_orderkey"], MERGE_UPSERT)


# --- sources, layers and the batch load (S1-S9, S12-S14, P1-P3, P5-P7, A1, A2) -----

_CUST_TEXT_SQL = S.render_text_sql("customer", S.CUSTOMER_SPEC, "c_custkey")


def _customer_file(spark, sf_dir) -> str:
    text = S.render_text(S.table(spark, sf_dir, "customer"), S.CUSTOMER_SPEC, F.col("c_custkey"))
    return S.write_batch_file(spark, text, S.CUSTOMER_SPEC, "customer.csv")


@register("land_csv_ingest", _CUST_TEXT_SQL)
def land_csv_ingest(spark, sf_dir):
    return flatfile.read_flat_file(spark, _customer_file(spark, sf_dir), S.CUSTOMER_SPEC)


_T1 = S.BATCH1_TIME.isoformat(sep=" ")


@register("land_stamp", f"""
SELECT CAST(0 AS BIGINT) AS sys_change_version, 'I' AS sys_change_operation,
       CAST(0 AS BIGINT) AS sys_change_creation_version, TIMESTAMP '{_T1}' AS commit_time,
       c.*, TIMESTAMP '{_T1}' AS partition_time
FROM ({_CUST_TEXT_SQL}) c
""")
def land_stamp(spark, sf_dir):
    text = flatfile.read_flat_file(spark, _customer_file(spark, sf_dir), S.CUSTOMER_SPEC)
    return layers.stamp_land(text, S.BATCH1_TIME)


@register("raw_history", f"""
SELECT '{S.BATCH1_TIME:%Y-%m}' AS partition_month, '{S.BATCH_IDS[0]}' AS batch_id,
       TIMESTAMP '{_T1}' AS partition_time, COUNT(*) AS n_rows FROM {S.orders_batch_sql(1)}
UNION ALL
SELECT '{S.BATCH2_TIME:%Y-%m}', '{S.BATCH_IDS[1]}', TIMESTAMP '{S.BATCH2_TIME.isoformat(sep=' ')}', COUNT(*)
FROM {S.orders_batch_sql(2)}
""")
def raw_history(spark, sf_dir):
    layout = S.orders_pipeline(spark, sf_dir)
    raw = layers.read_raw(spark, layout, S.ORDERS_SPEC)
    return raw.groupBy("partition_month", "batch_id", "partition_time").agg(F.count(F.lit(1)).alias("n_rows"))


@register("batch_watermark", f"""
SELECT '{S.ORDERS_SPEC.table_name}' AS table_name, TIMESTAMP '{S.BATCH2_TIME.isoformat(sep=' ')}' AS partition_time,
       CAST(2 AS BIGINT) AS n_batches
UNION ALL
SELECT '{S.CUSTOMER_SPEC.table_name}', TIMESTAMP '{_T1}', CAST(1 AS BIGINT)
""")
def batch_watermark(spark, sf_dir):
    return layers.latest_watermarks(spark, S.orders_pipeline(spark, sf_dir))


@register("trusted_full_load", S.orders_expected_sql(2, S.BATCH2_TIME))
def trusted_full_load(spark, sf_dir):
    layout = S.orders_pipeline(spark, sf_dir, LOAD_FULL)
    return layers.read_trusted(spark, layout, replace(S.ORDERS_SPEC, load_mode=LOAD_FULL))


@register("trusted_merge_load", S.orders_expected_sql(2, S.BATCH2_TIME))
def trusted_merge_load(spark, sf_dir):
    layout = S.orders_pipeline(spark, sf_dir, LOAD_MERGE)
    return layers.read_trusted(spark, layout, S.ORDERS_SPEC)


@register("load_audit", f"""
WITH c AS (SELECT {_COUNTS_SQL}, (SELECT COUNT(*) FROM {_T_SQL}) AS n1, (SELECT COUNT(*) FROM {_S_SQL}) AS n2)
SELECT '{S.BATCH_IDS[0]}' AS batch_id, 'MERGE' AS operation, 'OK' AS status, n1 AS rows_in, n1 AS rows_inserted,
       CAST(0 AS BIGINT) AS rows_updated, CAST(0 AS BIGINT) AS rows_deleted, CAST(0 AS BIGINT) AS null_keys FROM c
UNION ALL
SELECT '{S.BATCH_IDS[1]}', 'MERGE', 'OK', n2, ins, upd, del, 0 FROM c
""")
def load_audit(spark, sf_dir):
    layout = S.orders_pipeline(spark, sf_dir, LOAD_MERGE)
    rows = audit.read_audit(spark, layout.audit)
    return rows.filter((F.col("table_name") == S.ORDERS_SPEC.table_name) & (F.col("operation") == "MERGE")).select(
        "batch_id", "operation", "status", "rows_in", "rows_inserted", "rows_updated", "rows_deleted", "null_keys"
    )


ARCHIVE_DATES = (S.BATCH1_TIME.date(), S.BATCH2_TIME.date())


@register("archive_by_date", f"""
SELECT DATE '{ARCHIVE_DATES[0]}' AS ingest_date, COUNT(*) AS n_rows FROM {S.orders_batch_sql(1)}
UNION ALL
SELECT DATE '{ARCHIVE_DATES[1]}', COUNT(*) FROM {S.orders_batch_sql(2)}
""")
def archive_by_date(spark, sf_dir):
    """Each delivered orders file, converted, archived under the day it arrived."""
    folder = work_dir(spark, "archive")
    for which, day in enumerate(ARCHIVE_DATES, start=1):
        name = f"orders_{S.BATCH_IDS[which - 1]}.csv"
        path = S.write_batch_file(spark, S.orders_batch_text(spark, sf_dir, which), S.ORDERS_SPEC, name)
        files.archive_by_date(flatfile.read_flat_file(spark, path, S.ORDERS_SPEC), folder, day, S.BATCH_IDS[which - 1])
    archived = spark.read.parquet(folder)
    return archived.groupBy(F.col("ingest_date").cast("date").alias("ingest_date")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


# The source folder holds one daily orders file per order date; the destination
# already has those of the days before the last snapshot window's end.
@register("new_files_anti", f"""
SELECT DISTINCT 'orders_' || strftime(o_orderdate, '%Y%m%d') || '.csv' AS file_name FROM orders
EXCEPT
SELECT DISTINCT 'orders_' || strftime(o_orderdate, '%Y%m%d') || '.csv' FROM orders
WHERE o_orderdate < DATE '{S.WINDOW_END}'
""")
def new_files_anti(spark, sf_dir):
    o = S.table(spark, sf_dir, "orders")
    name = F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".csv")).alias("file_name")
    candidates = o.select(name)
    ledger = o.filter(F.col("o_orderdate") < F.lit(S.WINDOW_END)).select(name)
    return files.new_files(candidates, ledger)


@register("stream_ingest", S.expected_typed_sql("events", S.EVENTS_SPEC, "event_id"))
def stream_ingest(spark, sf_dir):
    landing = work_dir(spark, "stream", "landing")
    text = S.render_text(S.table(spark, sf_dir, "events"), S.EVENTS_SPEC, F.col("event_id"))
    flatfile.write_flat_file(text.repartitionByRange("event_id"), landing, S.EVENTS_SPEC)
    layout = layers.LakeLayout(work_dir(spark, "stream", "lake"))
    file_stream.ingest_stream(
        spark, S.EVENTS_SPEC, landing, layout, work_dir(spark, "stream", "checkpoint"),
        clock=lambda epoch: S.BATCH1_TIME + dt.timedelta(hours=epoch), max_files_per_trigger=2,
    )
    return layers.read_trusted(spark, layout, S.EVENTS_SPEC).drop("partition_time")


# --- refined marts from loaded files (entry points A + B end to end) --------------

_LI_T = S.typed_sql("lineitem", S.LINEITEM_SPEC)
_PA_T = S.typed_sql("part", S.PART_SPEC)
_SU_T = S.typed_sql("supplier", S.SUPPLIER_SPEC)
_CU_T = S.typed_sql("customer", S.CUSTOMER_SPEC)
_HE_T = (f"(SELECT *, o_orderdate + {S.DUE_LAG_DAYS} AS o_duedate "
         f"FROM {S.typed_sql('orders', S.ORDERS_SPEC)})")


def _refined(name: str) -> Query:
    def run(spark, sf_dir):
        from .refresh import read_mart

        return read_mart(spark, S.star_pipeline(spark, sf_dir), name)

    run.__name__ = f"refined_{name}"
    return run


register("refined_pedidos", f"""
SELECT l.*, h.o_custkey, h.o_orderstatus, h.o_totalprice, h.o_orderdate, h.o_orderpriority, h.o_duedate
FROM {_LI_T} l JOIN {_HE_T} h ON l.l_orderkey = h.o_orderkey
""")(_refined("pedidos"))
register("refined_cliente", f"SELECT * FROM {_CU_T}")(_refined("cliente"))
register("refined_produto", f"SELECT * FROM {_PA_T}")(_refined("produto"))
register("refined_tempo", f"""
SELECT {_date_parts_sql('h.o_orderdate', 'order')}, {_date_parts_sql('h.o_duedate', 'due')},
       {_date_parts_sql('l.l_shipdate', 'ship')}
FROM {_PA_T} p JOIN {_LI_T} l ON p.p_partkey = l.l_partkey JOIN {_HE_T} h ON l.l_orderkey = h.o_orderkey
""")(_refined("tempo"))
register("refined_vendedor", f"""
SELECT DISTINCT l.l_suppkey, s.s_name, s.s_nationkey, s.s_acctbal
FROM {_LI_T} l JOIN {_SU_T} s ON l.l_suppkey = s.s_suppkey
""")(_refined("vendedor"))


# --- quarantine split (D3 option): bad text reported, the load goes on ------------

@register("trusted_quarantine", f"""
SELECT CASE WHEN {_V} % 7 = 0 THEN 'l_suppkey' END AS bad_column, COUNT(*) AS n_rows
FROM lineitem GROUP BY 1
""")
def trusted_quarantine(spark, sf_dir):
    li = S.table(spark, sf_dir, "lineitem")
    # every seventh line (by key) gets a supplier id that is not a number
    li = li.withColumn("__bad", (F.col("l_orderkey") + F.col("l_linenumber")) % 7 == 0)
    text = S.render_text(li, S.LINEITEM_SPEC, F.col("l_orderkey") + F.col("l_linenumber"), keep=("__bad",))
    text = text.withColumn("l_suppkey", F.when(F.col("__bad"), F.concat(F.lit("S-"), F.col("l_suppkey"))).otherwise(
        F.col("l_suppkey"))).drop("__bad")
    flagged = casts.flag_rows(text, S.LINEITEM_SPEC)
    return flagged.groupBy("bad_column").agg(F.count(F.lit(1)).alias("n_rows"))


from . import scenarios  # noqa: E402, F401  (registers its queries)
