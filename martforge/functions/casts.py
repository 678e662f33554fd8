"""Text -> typed column rules (the trusted layer's typed projection).

One rule per source type class, all built-in expressions, so the whole
projection stays inside whole-stage codegen:

* date  : ``' '`` or ``'-'`` -> NULL, else the first 10 characters cast (strict)
* int   : ``' '`` or ``'-'`` -> NULL, else the text before the first ``.`` cast (strict)
* float : ``' '`` or ``'-'`` -> NULL, else ``,`` -> ``.`` and a lenient cast (bad text -> NULL)
* other : a plain cast (strict)

Strict casts raise under ANSI mode, as the reference's CAST fails a load. The
optional quarantine split keeps a load going and reports the rows instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (
    DATE_TEXT_LENGTH,
    DECIMAL_COMMA,
    INT_CUT_SEPARATOR,
    NA_WORDS,
    NULL_MARKERS,
    ColumnSpec,
    TableSpec,
    spark_type,
)


def na_to_null(c: Column) -> Column:
    """Map the file's no-value words to NULL (done once, at ingest)."""
    return F.when(c.isin(*NA_WORDS), F.lit(None).cast("string")).otherwise(c)


def _is_marker(c: Column) -> Column:
    return c.isin(*NULL_MARKERS)


def date_rule(c: Column, target: str = "date", strict: bool = True) -> Column:
    """``' '``/``'-'`` -> NULL, else ``CAST(SUBSTR(x, 1, 10) AS target)``."""
    head = F.substring(c, 1, DATE_TEXT_LENGTH)
    cast = head.cast(target) if strict else head.try_cast(target)
    return F.when(_is_marker(c), F.lit(None)).otherwise(cast)


def int_rule(c: Column, target: str = "bigint", strict: bool = True) -> Column:
    """``' '``/``'-'`` -> NULL, else the text before the first dot, cast.

    ``'12.0'`` (a pandas-stringified int column with blanks) and ``'12.7'``
    both give 12: the text is cut, never rounded.
    """
    head = F.substring_index(c, INT_CUT_SEPARATOR, 1)  # = SPLIT(x, '.')[0], without building an array
    cast = head.cast(target) if strict else head.try_cast(target)
    return F.when(_is_marker(c), F.lit(None)).otherwise(cast)


def float_rule(c: Column, target: str = "double") -> Column:
    """``' '``/``'-'`` -> NULL, else decimal comma to point and a lenient cast."""
    return F.when(_is_marker(c), F.lit(None)).otherwise(F.replace(c, F.lit(DECIMAL_COMMA), F.lit(".")).try_cast(target))


def other_rule(c: Column, target: str = "string", strict: bool = True) -> Column:
    """A plain cast for every other type class."""
    return c.cast(target) if strict else c.try_cast(target)


def cast_column(c: Column, spec: ColumnSpec, strict: bool = True) -> Column:
    """The rule for one column, chosen by its source type class."""
    kind, target = spec.source_type, spec.target
    if kind == "date":
        out = date_rule(c, target, strict)
    elif kind == "int":
        out = int_rule(c, target, strict)
    elif kind == "float":
        out = float_rule(c, target)
    else:
        out = other_rule(c, target, strict)
    return out.cast(spark_type(target)).alias(spec.lake)


def typed_columns(spec: TableSpec, strict: bool = True, prefix: str = "") -> list[Column]:
    """One typed expression per column, in file order."""
    return [cast_column(F.col(prefix + c.lake), c, strict) for c in spec.columns]


def typed_projection(df: DataFrame, spec: TableSpec, keep: tuple[str, ...] = ("partition_time",)) -> DataFrame:
    """Text lake columns -> typed columns (strict: a bad date/int/other raises)."""
    extra = [F.col(k) for k in keep if k in df.columns]
    return df.select(*typed_columns(spec, strict=True), *extra)


def flag_rows(df: DataFrame, spec: TableSpec, keep: tuple[str, ...] = ("partition_time",)) -> DataFrame:
    """Typed columns (lenient), the input text of every column (``__text_<name>``) and ``bad_column``.

    ``bad_column`` names the first column whose text is present (not NULL,
    not a NULL marker) but does not cast; NULL when the row is good. The float
    rule is lenient in the reference, so a bad float is not a rejection.
    One pass; split it with ``filter`` or write it partitioned by status.
    """
    extra = [F.col(k) for k in keep if k in df.columns]
    checked = [c for c in spec.columns if c.source_type != "float"]
    typed = df.select(
        *[F.col(c.lake).alias(f"__text_{c.lake}") for c in spec.columns],
        *typed_columns(spec, strict=False),
        *extra,
    )
    bad = [
        F.when(F.col(f"__text_{c.lake}").isNotNull() & ~_is_marker(F.col(f"__text_{c.lake}"))
               & F.col(c.lake).isNull(), F.lit(c.lake))
        for c in checked
    ]
    return typed.withColumn("bad_column", F.coalesce(*bad, F.lit(None).cast("string")))


def quarantine_split(
    df: DataFrame, spec: TableSpec, keep: tuple[str, ...] = ("partition_time",)
) -> tuple[DataFrame, DataFrame]:
    """Typed rows and rejected rows (their text and the failing column), without failing the load."""
    kept = [k for k in keep if k in df.columns]
    flagged = flag_rows(df, spec, keep)
    good = flagged.filter(F.col("bad_column").isNull()).select(*spec.lake_columns, *kept)
    rejected = flagged.filter(F.col("bad_column").isNotNull()).select(
        *[F.col(f"__text_{c.lake}").alias(c.lake) for c in spec.columns], *kept, "bad_column"
    )
    return good, rejected
