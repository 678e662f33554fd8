"""The delivered files' own schema: specs, loads and marts with the reference's column names."""

import datetime as dt

from pyspark.sql import functions as F

from martforge.config import REFERENCE_SPECS
from martforge.operators import indicators
from martforge.operators.marts import REFERENCE_STAR
from martforge.plans import refresh
from martforge.plans.load import load_batch
from martforge.sources import layers as L
from martforge.sources.flatfile import read_flat_file

from .test_pipeline import write_csv


def _line(spec, values):
    return ";".join(values.get(c.source, "") for c in spec.columns)


def _file(scratch, name, rows):
    spec = REFERENCE_SPECS[name]
    return write_csv(f"{scratch}/landing", name, [";".join(c.source for c in spec.columns)]
                     + [_line(spec, r) for r in rows])


HEADERS = [
    {"SalesOrderID": "43659", "OrderDate": "2011-05-31 00:00:00", "DueDate": "2011-09-12 00:00:00",
     "ShipDate": "2011-06-07", "Status": "5", "OnlineOrderFlag": "False", "CustomerID": "29825",
     "SalesPersonID": "279", "SubTotal": "20565,6206", "TotalDue": "23153,2339", "RevisionNumber": "8"},
    {"SalesOrderID": "43660", "OrderDate": "2011-05-31", "DueDate": "2011-09-20", "ShipDate": "2011-06-07",
     "Status": "5", "OnlineOrderFlag": "True", "CustomerID": "29672", "SalesPersonID": "279.0",
     "SubTotal": "1294.2529", "TotalDue": "1457.3288", "RevisionNumber": "8"},
    {"SalesOrderID": "43661", "OrderDate": "2011-05-31", "DueDate": "2011-10-12", "ShipDate": "-",
     "Status": "5", "OnlineOrderFlag": "False", "CustomerID": "29734", "SalesPersonID": " ",
     "SubTotal": "32726.4786", "TotalDue": "36865.8012", "RevisionNumber": "8"},
]
DETAILS = [
    {"SalesOrderID": "43659", "SalesOrderDetailID": str(i), "OrderQty": "1", "ProductID": str(p),
     "UnitPrice": "2024,994", "LineTotal": "2024,994"}
    for i, p in enumerate([776, 777, 778, 771, 772], start=1)
] + [{"SalesOrderID": "43660", "SalesOrderDetailID": "6", "OrderQty": "3", "ProductID": "776", "LineTotal": "1"}]
PRODUCTS = [
    {"ProductID": str(p), "Name": f"Bike {p}", "ProductNumber": f"BK-{p}", "MakeFlag": "True",
     "FinishedGoodsFlag": "True", "DaysToManufacture": "4", "SellStartDate": "2011-05-31 00:00:00",
     "SellEndDate": "NULL", "ListPrice": "3399,99"}
    for p in (771, 772, 776, 777, 778)
]
CUSTOMERS = [{"CustomerID": c, "TerritoryID": "5", "AccountNumber": f"AW{c}"} for c in ("29825", "29672", "29734")]
PERSONS = [{"BusinessEntityID": "279", "NameStyle": "0", "FirstName": "Tsvi", "LastName": "Reiter",
            "EmailPromotion": "0"}]


def test_reference_files_to_marts(spark, scratch):
    layout = L.LakeLayout(f"{scratch}/lake")
    inputs = {
        "Sales.SalesOrderHeader.csv": HEADERS, "Sales.SalesOrderDetail.csv": DETAILS,
        "Production.Product.csv": PRODUCTS, "Sales.Customer.csv": CUSTOMERS, "Person.Person.csv": PERSONS,
    }
    for name, rows in inputs.items():
        spec = REFERENCE_SPECS[name]
        load_batch(spark, spec, read_flat_file(spark, _file(scratch, name, rows), spec), layout, "1",
                   dt.datetime(2024, 9, 5, 9))
    specs = {"header": REFERENCE_SPECS["Sales.SalesOrderHeader.csv"],
             "detail": REFERENCE_SPECS["Sales.SalesOrderDetail.csv"],
             "product": REFERENCE_SPECS["Production.Product.csv"],
             "customer": REFERENCE_SPECS["Sales.Customer.csv"], "person": REFERENCE_SPECS["Person.Person.csv"]}
    refresh.refresh_marts(spark, layout, REFERENCE_STAR, specs)

    pedidos = refresh.read_mart(spark, layout, "pedidos")
    assert pedidos.count() == 6
    assert set(pedidos.columns) == {  # detail + header columns, the order key once
        "sales_order_id", "sales_order_detail_id", "carrier_tracking_number", "order_qty", "product_id",
        "special_offer_id", "unit_price", "unit_price_discount", "line_total", "revision_number", "order_date",
        "due_date", "ship_date", "status", "online_order_flag", "sales_order_number", "purchase_order_number",
        "customer_id", "sales_person_id", "bill_to_address_id", "ship_method_id", "credit_card_id",
        "credit_card_approval_code", "currency_rate_id", "subtotal", "tax_amt", "freight", "total_due", "comment"}
    assert len(pedidos.columns) == 29
    tempo = refresh.read_mart(spark, layout, "tempo").collect()
    assert len(tempo) == 6
    assert {r["sell_start_year"] for r in tempo} == {2011} and {r["sell_end_date"] for r in tempo} == {None}
    vendedor = refresh.read_mart(spark, layout, "vendedor").collect()
    assert [(r["sales_person_id"], r["first_name"]) for r in vendedor] == [(279, "Tsvi")]  # '279.0' is 279
    produto = refresh.read_mart(spark, layout, "produto")
    assert produto.count() == 5 and len(produto.columns) == 19
    assert refresh.read_mart(spark, layout, "cliente").columns == list(REFERENCE_STAR.customer_columns)

    header = L.read_trusted(spark, layout, specs["header"])
    detail = L.read_trusted(spark, layout, specs["detail"])
    assert indicators.orders_over_n_products(detail, REFERENCE_STAR).collect()[0]["n_orders"] == 1
    due = indicators.due_orders(header, REFERENCE_STAR, "2011-09", 1000.0).collect()
    assert sorted(r["sales_order_id"] for r in due) == [43659, 43660]
    top = indicators.top_products_by_lead_time(detail, L.read_trusted(spark, layout, specs["product"]),
                                               REFERENCE_STAR).collect()
    assert [(r["days_to_manufacture"], r["product_id"], r["sales_rank"]) for r in top][0] == (4, 776, 1)


def test_composite_key_merge_through_a_load(spark, scratch):
    spec = REFERENCE_SPECS["Sales.SpecialOfferProduct.csv"]
    layout = L.LakeLayout(f"{scratch}/lake")
    head = "SpecialOfferID;ProductID"
    p1 = write_csv(f"{scratch}/l1", spec.name, [head, "1;1", "1;2"])
    p2 = write_csv(f"{scratch}/l2", spec.name, [head, "1;2", "2;1", "2;1.0"])
    load_batch(spark, spec, read_flat_file(spark, p1, spec), layout, "1", dt.datetime(2024, 9, 4))
    r = load_batch(spark, spec, read_flat_file(spark, p2, spec), layout, "2", dt.datetime(2024, 9, 5))
    assert (r.rows_in, r.rows_inserted, r.rows_updated, r.rows_deleted) == (3, 1, 1, 1)
    rows = sorted(tuple(x)[:2] for x in L.read_trusted(spark, layout, spec).collect())
    assert rows == [(1, 2), (2, 1)]


def test_modified_date_of_a_delivered_file(spark, scratch):
    from martforge.config import with_modified
    from martforge.sources.flatfile import write_flat_file

    spec = with_modified(REFERENCE_SPECS["Sales.Customer.csv"])
    layout = L.LakeLayout(f"{scratch}/lake")
    rows = [("1", "2024-01-05"), ("2", "2024-01-05")], [("1", "2024-01-01"), ("2", "2024-01-05"), ("3", "2024-01-09")]
    for i, batch in enumerate(rows, start=1):
        text = spark.createDataFrame([(c, None, None, f"t{i}", "AW", d) for c, d in batch],
                                     ", ".join(f"{c} string" for c in spec.lake_columns))
        write_flat_file(text, f"{scratch}/c{i}.csv", spec)
        load_batch(spark, spec, read_flat_file(spark, f"{scratch}/c{i}.csv", spec).withColumn(
            "territory_id", F.lit(str(i))), layout, str(i), dt.datetime(2024, 9, i))
    got = L.read_trusted(spark, layout, spec).select("customer_id", "territory_id").collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 2), (3, 2)]
