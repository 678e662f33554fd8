"""Files -> trusted -> the five refined marts, end to end (entry points A and B)."""

from dataclasses import replace

from pyspark.sql import functions as F

from martforge.config import LOAD_FULL
from martforge.plans import refresh
from martforge.plans import standins as S
from martforge.plans.load import load_batch
from martforge.sources import layers as L
from martforge.sources.flatfile import read_flat_file

from .conftest import SMALL_SF
from .oracle import duck

TABLES = {
    "detail": ("lineitem", replace(S.LINEITEM_SPEC, load_mode=LOAD_FULL)),
    "header": ("orders", replace(S.ORDERS_SPEC, load_mode=LOAD_FULL)),
    "customer": ("customer", S.CUSTOMER_SPEC),
    "product": ("part", S.PART_SPEC),
    "person": ("supplier", S.SUPPLIER_SPEC),
}


def test_refresh_builds_the_star_from_loaded_files(spark, scratch):
    layout = L.LakeLayout(f"{scratch}/lake")
    for role, (name, spec) in TABLES.items():
        text = S.render_text(S.table(spark, SMALL_SF, name), spec)
        path = S.write_batch_file(spark, text, spec, f"{name}.csv")
        load_batch(spark, spec, read_flat_file(spark, path, spec), layout, "000001", S.BATCH1_TIME)
    specs = {role: spec for role, (_, spec) in TABLES.items()}
    due = {"header": lambda h: h.withColumn("o_duedate", F.date_add("o_orderdate", S.DUE_LAG_DAYS))}
    versions = refresh.refresh_marts(spark, layout, S.TEST_STAR, specs, prepare=due)
    assert set(versions) == set(refresh.MART_NAMES)

    con = duck(SMALL_SF)
    expect = {
        "pedidos": "SELECT COUNT(*) FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey",
        "cliente": "SELECT COUNT(*) FROM customer",
        "produto": "SELECT COUNT(*) FROM part",
        "tempo": "SELECT COUNT(*) FROM part p JOIN lineitem l ON p.p_partkey = l.l_partkey "
                 "JOIN orders o ON l.l_orderkey = o.o_orderkey",
        "vendedor": "SELECT COUNT(DISTINCT l_suppkey) FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey",
    }
    for name, sql in expect.items():
        assert refresh.read_mart(spark, layout, name).count() == con.execute(sql).fetchone()[0], name

    tempo = refresh.read_mart(spark, layout, "tempo")
    assert dict(tempo.dtypes)["order_date"] == "date"
    qty = refresh.read_mart(spark, layout, "pedidos").agg(F.sum("l_quantity")).collect()[0][0]
    assert qty == con.execute("SELECT SUM(l_quantity) FROM lineitem").fetchone()[0]
