import pytest

from martforge.config import REFERENCE_SPECS, ColumnSpec, TableSpec, snake_case, spark_type


def test_snake_case_of_source_names():
    assert snake_case("SalesOrderID") == "sales_order_id"
    assert snake_case("BusinessEntityID") == "business_entity_id"
    assert snake_case("rowguid") == "rowguid"
    assert snake_case("L_ORDERKEY") == "l_orderkey"
    assert snake_case("Sales Order Id") == "sales_order_id"


def test_reference_specs_resolve_keys_to_lake_names():
    assert REFERENCE_SPECS["Sales.SalesOrderHeader.csv"].keys == ("sales_order_id",)
    assert REFERENCE_SPECS["Sales.SpecialOfferProduct.csv"].keys == ("special_offer_id", "product_id")
    assert REFERENCE_SPECS["Production.Product.csv"].keys == ("product_number",)
    assert REFERENCE_SPECS["Sales.SalesOrderDetail.csv"].table_name == "flatfile_sales_salesorderdetail_csv"


def test_type_class_is_case_insensitive():
    spec = TableSpec("t.csv", (ColumnSpec("A", "INT"), ColumnSpec("B", "Float")), keys=("A",))
    assert [c.source_type for c in spec.columns] == ["int", "float"]
    assert [c.target for c in spec.columns] == ["bigint", "double"]


def test_unmapped_type_and_unknown_key_fail():
    with pytest.raises(ValueError, match="no target type"):
        TableSpec("t.csv", (ColumnSpec("A", "money"),), keys=("A",))
    with pytest.raises(ValueError, match="not a column"):
        TableSpec("t.csv", (ColumnSpec("A", "int"),), keys=("B",))
    with pytest.raises(ValueError, match="duplicate"):
        TableSpec("t.csv", (ColumnSpec("A", "int"), ColumnSpec("a", "int")), keys=("A",))


def test_spark_type_names():
    assert spark_type("decimal(18, 2)").simpleString() == "decimal(18,2)"
    assert spark_type("timestamp_ntz").simpleString() == "timestamp_ntz"
    with pytest.raises(ValueError):
        spark_type("varchar2")


def test_specs_from_a_file(tmp_path):
    import json

    from martforge.config import LOAD_MERGE, read_specs

    path = tmp_path / "specs.json"
    table = {"name": "own.csv", "columns": [{"source": "ID", "source_type": "int"},
                                            {"source": "Price", "source_type": "money", "lake": "cost"}],
             "keys": ["ID"], "load_mode": LOAD_MERGE, "merge_mode": "upsert", "multi_line": True,
             "type_map": {"money": "decimal(10,2)"}}
    path.write_text(json.dumps({"tables": [table]}))
    spec = read_specs(str(path))["own.csv"]
    assert spec.lake_columns == ["id", "cost"] and spec.keys == ("id",) and spec.multi_line
    assert [c.target for c in spec.columns] == ["bigint", "decimal(10,2)"]
    path.write_text(json.dumps({"tables": [{**table, "surprise": 1}]}))
    with pytest.raises(ValueError, match="surprise"):
        read_specs(str(path))
