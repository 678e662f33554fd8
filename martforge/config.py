"""Table specs: the metadata that drives every load.

The reference keeps this metadata in a control database (file name, key list,
load type, column map, type map). Here it is plain Python, checked once when a
spec is built: key names resolve to lake column names (D5, D6), source type
classes are lower-cased (D16) and every source type must have a target (an
unmapped type is an error, not a silently dropped column).
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field, fields, replace

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Text that means "no value" in a delivered file. pandas turns these into
# NaN before the reference stringifies a frame; here they become NULL at
# ingest, in one place.
NA_WORDS = ("", "NA", "N/A", "n/a", "NULL", "null", "NaN", "nan", "None", "<NA>", "#N/A")

# Text the reference maps to NULL in the date, int and float rules: exactly
# one blank or one dash, compared without trimming.
NULL_MARKERS = (" ", "-")

# Default source-type -> target-type map (the reference's type map rows are
# not published; these are the assumed targets, see FIXTURES.md).
DEFAULT_TYPE_MAP = {
    "int": "bigint",
    "float": "double",
    "date": "date",
    "string": "string",
    "boolean": "boolean",
    "datetime": "timestamp_ntz",
    "decimal": "decimal(18,2)",
}

# Columns the land and raw layers add in front of the file's columns, and the
# values every landed row gets (commit_time takes the batch stamp).
SYSTEM_COLUMNS = (
    ("sys_change_version", "bigint"),
    ("sys_change_operation", "string"),
    ("sys_change_creation_version", "bigint"),
    ("commit_time", "timestamp_ntz"),
)
SYSTEM_VALUES = {"sys_change_version": 0, "sys_change_operation": "I", "sys_change_creation_version": 0}

# The batch stamp is the current time minus this many hours.
STAMP_LAG_HOURS = 3

# Cast rules: the date rule keeps this many leading characters; the int rule
# keeps the text before this separator; the float rule turns this decimal
# comma into a point.
DATE_TEXT_LENGTH = 10
INT_CUT_SEPARATOR = "."
DECIMAL_COMMA = ","

# Delivered files: field separator.
FIELD_SEPARATOR = ";"

# Indicator parameters as the reference states them: orders with more than 3
# products; the 3 best-selling products per lead time; orders falling due in
# month 09/11 (read as September 2011) with a value above 1,000.
MIN_PRODUCTS_PER_ORDER = 3
TOP_PRODUCTS = 3
DUE_MONTH = "2011-09"
DUE_MIN_TOTAL = 1000.0
# ---------------------------------------------------------------------------

LOAD_FULL = "full"
LOAD_MERGE = "incremental"
LOAD_RAW_ONLY = "none"  # land and keep the raw history, leave trusted as it is
MERGE_SNAPSHOT = "snapshot"
MERGE_UPSERT = "upsert"


_SIMPLE_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "smallint": T.ShortType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def spark_type(name: str) -> T.DataType:
    """Target type name -> Spark type (no session needed)."""
    key = name.strip().lower()
    if key in _SIMPLE_TYPES:
        return _SIMPLE_TYPES[key]
    m = re.fullmatch(r"decimal\((\d+),\s*(\d+)\)", key)
    if m:
        return T.DecimalType(int(m.group(1)), int(m.group(2)))
    raise ValueError(f"unknown target type {name!r}")


def snake_case(name: str) -> str:
    """Source column name -> lake column name (``SalesOrderID`` -> ``sales_order_id``)."""
    s = re.sub(r"[^0-9A-Za-z]+", "_", name.strip())
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", s)
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    return s.strip("_").lower()


@dataclass(frozen=True)
class ColumnSpec:
    """One column of a delivered file."""

    source: str  # name in the file header
    source_type: str  # type class: date, int, float or anything else
    lake: str = ""  # name in the lake; derived from ``source`` when empty
    target: str = ""  # Spark SQL type; from the type map when empty

    def resolved(self, type_map: dict[str, str]) -> "ColumnSpec":
        kind = self.source_type.strip().lower()
        target = self.target or type_map.get(kind)
        if not target:
            raise ValueError(f"no target type for source type {self.source_type!r} of column {self.source!r}")
        spark_type(target)  # fail early on a bad type name
        return ColumnSpec(self.source, kind, self.lake or snake_case(self.source), target)


@dataclass(frozen=True)
class TableSpec:
    """A delivered file and how it is kept current."""

    name: str
    columns: tuple[ColumnSpec, ...]
    keys: tuple[str, ...]
    load_mode: str = LOAD_FULL
    merge_mode: str = MERGE_SNAPSHOT
    system: str = "flatfile"
    # modification-date column: an upsert applies only rows changed after the
    # newest value already in trusted (incremental by modification date)
    modified: str = ""
    type_map: dict[str, str] = field(default_factory=lambda: dict(DEFAULT_TYPE_MAP))
    # committed trusted snapshots kept; older ones are deleted after each load.
    # 0, the default, keeps every version; a limit must outlast the longest reader.
    keep_versions: int = 0
    # an upsert table of this many key buckets: a load rewrites the buckets that
    # its keys fall into and leaves the others (0: one folder, rewritten whole).
    # Choose it so that a bucket is a few hundred megabytes; it is fixed for a table.
    buckets: int = 0
    # the files of a trusted snapshot hold disjoint ranges of the keys (else only sorted inside)
    cluster: bool = True
    # a trusted snapshot is a table of this many hash buckets of the keys: a merge
    # joins it where it lies and shuffles the batch alone (0: no buckets)
    join_buckets: int = 0
    # merges store what they changed, row by row, with the old and the new values
    track_changes: bool = False
    # quoted values of the file hold line breaks: read it twice, to know which splits start inside quotes
    multi_line: bool = False

    def __post_init__(self):
        cols = tuple(c.resolved(self.type_map) for c in self.columns)
        object.__setattr__(self, "columns", cols)
        lake = [c.lake for c in cols]
        if len(set(lake)) != len(lake):
            raise ValueError(f"{self.name}: duplicate lake column names")
        by_source = {c.source.lower(): c.lake for c in cols}
        keys = []
        for k in self.keys:
            if k in lake:
                keys.append(k)
            elif k.lower() in by_source:
                keys.append(by_source[k.lower()])
            else:
                raise ValueError(f"{self.name}: key {k!r} is not a column")
        object.__setattr__(self, "keys", tuple(keys))
        if self.modified:
            name = self.modified if self.modified in lake else by_source.get(self.modified.lower())
            if name is None:
                raise ValueError(f"{self.name}: modified column {self.modified!r} is not a column")
            if self.merge_mode != MERGE_UPSERT:
                # in a snapshot merge every key missing from the batch is deleted,
                # so filtering unchanged rows out would delete them
                raise ValueError(f"{self.name}: a modified column needs merge_mode='upsert'")
            object.__setattr__(self, "modified", name)
        if self.load_mode not in (LOAD_FULL, LOAD_MERGE, LOAD_RAW_ONLY):
            raise ValueError(f"{self.name}: load mode {self.load_mode!r}")
        if self.merge_mode not in (MERGE_SNAPSHOT, MERGE_UPSERT):
            raise ValueError(f"{self.name}: merge mode {self.merge_mode!r}")
        if self.buckets and (self.load_mode == LOAD_FULL or self.merge_mode != MERGE_UPSERT or self.keep_versions):
            # later versions name the folders of earlier ones, so none may expire
            raise ValueError(f"{self.name}: buckets need an upsert table that keeps all versions")
        if self.join_buckets and (self.load_mode != LOAD_MERGE or self.buckets):
            raise ValueError(f"{self.name}: join_buckets are for tables kept by merge, without key buckets")
        if self.track_changes and (self.load_mode != LOAD_MERGE or self.buckets):
            raise ValueError(f"{self.name}: changes are tracked in merges, of tables without key buckets")
        if self.keep_versions < 0:
            raise ValueError(f"{self.name}: keep_versions must be 0 (all) or more")

    @property
    def table_name(self) -> str:
        """Layer table name: system and file name, lower case, dots to underscores."""
        return f"{self.system.lower()}_{self.name.lower().replace('.', '_')}"

    @property
    def lake_columns(self) -> list[str]:
        return [c.lake for c in self.columns]

    @property
    def rename_map(self) -> dict[str, str]:
        return {c.source: c.lake for c in self.columns}

    @property
    def text_schema(self) -> T.StructType:
        """All-string read schema in file order (header names)."""
        return T.StructType([T.StructField(c.source, T.StringType(), True) for c in self.columns])

    @property
    def typed_schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.lake, spark_type(c.target), True) for c in self.columns]
        )

    @property
    def value_columns(self) -> list[str]:
        return [c for c in self.lake_columns if c not in self.keys]


def with_modified(spec: TableSpec, column: str = "ModifiedDate", kind: str = "date") -> TableSpec:
    """The spec with a modification-date column, loaded incrementally by it (an upsert, P9)."""
    columns = spec.columns
    if column.lower() not in {c.source.lower() for c in columns}:
        columns = (*columns, ColumnSpec(column, kind))
    return replace(spec, columns=columns, load_mode=LOAD_MERGE, merge_mode=MERGE_UPSERT, modified=column)


def read_specs(path: str) -> dict[str, TableSpec]:
    """Table specs from a JSON file: ``{"tables": [{"name": ..., "columns": [...], "keys": [...], ...}]}``.

    A column is ``{"source", "source_type"}`` with optional ``lake`` and
    ``target``; every other field of ``TableSpec`` may be given by its name.
    """
    with open(path, encoding="utf-8") as f:
        tables = json.load(f)["tables"]
    known = {x.name for x in fields(TableSpec)}
    out = {}
    for table in tables:
        if unknown := set(table) - known:
            raise ValueError(f"{path}: unknown fields {sorted(unknown)} of table {table.get('name')!r}")
        columns = tuple(ColumnSpec(**c) for c in table["columns"])
        type_map = {**DEFAULT_TYPE_MAP, **table.get("type_map", {})}
        rest = {k: v for k, v in table.items() if k not in ("columns", "keys", "type_map")}
        out[table["name"]] = TableSpec(columns=columns, keys=tuple(table["keys"]), type_map=type_map, **rest)
    return out


def _cols(*items: tuple[str, ...]) -> tuple[ColumnSpec, ...]:
    """Columns from (source, type) or (source, type, lake name)."""
    return tuple(ColumnSpec(*item) for item in items)


# The six delivered files of the sales data mart, keyed as the reference
# documents them. Types are assumptions (FIXTURES.md section 1).
REFERENCE_SPECS = {
    "Sales.SalesOrderHeader.csv": TableSpec(
        "Sales.SalesOrderHeader.csv",
        _cols(
            ("SalesOrderID", "int"), ("RevisionNumber", "int"), ("OrderDate", "date"), ("DueDate", "date"),
            ("ShipDate", "date"), ("Status", "int"), ("OnlineOrderFlag", "boolean"),
            ("SalesOrderNumber", "string"), ("PurchaseOrderNumber", "string"), ("CustomerID", "int"),
            ("SalesPersonID", "int"), ("BillToAddressID", "int"), ("ShipMethodID", "int"),
            ("CreditCardID", "int"), ("CreditCardApprovalCode", "string"), ("CurrencyRateID", "int"),
            ("SubTotal", "float", "subtotal"), ("TaxAmt", "float"), ("Freight", "float"), ("TotalDue", "float"),
            ("Comment", "string"),
        ),
        keys=("SalesOrderID",),
        load_mode=LOAD_MERGE,
    ),
    "Sales.SalesOrderDetail.csv": TableSpec(
        "Sales.SalesOrderDetail.csv",
        _cols(
            ("SalesOrderID", "int"), ("SalesOrderDetailID", "int"), ("CarrierTrackingNumber", "string"),
            ("OrderQty", "int"), ("ProductID", "int"), ("SpecialOfferID", "int"), ("UnitPrice", "float"),
            ("UnitPriceDiscount", "float"), ("LineTotal", "float"),
        ),
        keys=("SalesOrderDetailID",),
        load_mode=LOAD_MERGE,
    ),
    "Sales.Customer.csv": TableSpec(
        "Sales.Customer.csv",
        _cols(("CustomerID", "int"), ("PersonID", "int"), ("StoreID", "int"), ("TerritoryID", "int"),
              ("AccountNumber", "string")),
        keys=("CustomerID",),
    ),
    "Production.Product.csv": TableSpec(
        "Production.Product.csv",
        _cols(
            ("ProductID", "int"), ("Name", "string"), ("ProductNumber", "string"), ("MakeFlag", "boolean"),
            ("FinishedGoodsFlag", "boolean"), ("Color", "string"), ("SafetyStockLevel", "int"),
            ("ReorderPoint", "int"), ("StandardCost", "float"), ("ListPrice", "float"), ("Size", "string"),
            ("SizeUnitMeasureCode", "string"), ("Weight", "float"), ("DaysToManufacture", "int"),
            ("ProductLine", "string"), ("Class", "string"), ("Style", "string"),
            ("ProductSubcategoryID", "int"), ("ProductModelID", "int"), ("SellStartDate", "date"),
            ("SellEndDate", "date"),
        ),
        keys=("ProductNumber",),
    ),
    "Person.Person.csv": TableSpec(
        "Person.Person.csv",
        _cols(
            ("BusinessEntityID", "int"), ("NameStyle", "string"), ("Title", "string"), ("FirstName", "string"),
            ("MiddleName", "string"), ("LastName", "string"), ("Suffix", "string"), ("EmailPromotion", "int"),
            ("AdditionalContactInfo", "string"), ("Demographics", "string"),
        ),
        keys=("BusinessEntityID",),
        multi_line=True,  # Demographics is XML
    ),
    "Sales.SpecialOfferProduct.csv": TableSpec(
        "Sales.SpecialOfferProduct.csv",
        _cols(("SpecialOfferID", "int"), ("ProductID", "int")),
        keys=("SpecialOfferID", "ProductID"),
        load_mode=LOAD_MERGE,
    ),
}
