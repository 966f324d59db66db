"""A registry-shaped view of the test tables, for Spark and for the SQL oracle."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import add_age, add_date_parts, fill_missing
from ..plans.questions import Registry
from ..schema import CLEAN_COLUMNS, RAW_COLUMNS, UNKNOWN, RegistryTerms
from ..sources import lookup, read_table

AS_OF = 2001

# Registry column -> (expression on the test tables, table it comes from). The text is
# valid in both Spark SQL and DuckDB.
_COLUMNS = {
    "PERSON": ("o_orderstatus", "orders"),
    "REG_ADDR_KOATUU": ("cast(c_nationkey as {text})", "customer"),
    "OPER_CODE": ("cast(l_linenumber as {text})", "lineitem"),
    "OPER_NAME": ("l_linestatus", "lineitem"),
    "D_REG": ("cast(o_orderdate as date)", "orders"),
    "DEP_CODE": ("cast(l_suppkey as {text})", "lineitem"),
    "DEP": ("l_returnflag", "lineitem"),
    "BRAND": ("p_brand", "part"),
    "MODEL": ("p_name", "part"),
    "VIN": ("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)", "lineitem"),
    "MAKE_YEAR": ("cast(year(l_shipdate) as integer)", "lineitem"),
    "COLOR": ("nullif(split_part(p_name, ' ', 1), 'hot')", "part"),
    "KIND": ("p_type", "part"),
    "BODY": ("split_part(p_name, ' ', 2)", "part"),
    "PURPOSE": ("c_mktsegment", "customer"),
    "FUEL": ("o_orderpriority", "orders"),
    "CAPACITY": ("nullif(l_quantity, 50)", "lineitem"),
    "OWN_WEIGHT": ("p_retailprice", "part"),
    "TOTAL_WEIGHT": ("l_extendedprice", "lineitem"),
    "N_REG_NEW": ("concat_ws('-', l_partkey, l_suppkey)", "lineitem"),
}
# Text made of numbers that the joins carry: written out after them, so that every row is
# shuffled with the numbers alone.
_AFTER_JOINS = ("REG_ADDR_KOATUU", "OPER_CODE", "DEP_CODE", "VIN", "N_REG_NEW")
_DERIVED = {"AGE": "MAKE_YEAR", "REG_YEAR": "D_REG", "REG_MONTH": "D_REG"}

# What the questions ask about on this view.
TERMS = RegistryTerms(
    capital="NATION_0",
    electric="1-URGENT",
    passenger="STANDARD",
    truck="LARGE",
    brand="Brand#1",
    diesel="5-LOW",
    tracked_colours=("new", "old"),
    motorcycle="PROMO",
    special="MACHINERY",
    red="red",
    after_year=1999,
    hybrid_words=("NOT", "SPECIFIED"),
    compared_brands=("Brand#1", "Brand#2", "Brand#3"),
    light_weight=1500,
)
OPERATION_ROWS = (("1", "transfer"), ("2", "first"), ("3", "lease"))


def raw_rows(spark: SparkSession, folder: str, columns: Iterable[str] = RAW_COLUMNS) -> DataFrame:
    """The requested raw columns of the view: line items with their order, part and
    customer. All joins are done for any columns; an item that lacks one of them is not
    in the view. Columns that nobody asks for are pruned from the scans."""

    def expression(column: str) -> str:
        return _COLUMNS[column][0].format(text="string")

    def rows_of(table: str, *keys: str) -> DataFrame:
        # Other columns are computed before the join, on the smaller table.
        own = [f"{expression(c)} AS {c}" for c, (_, t) in _COLUMNS.items() if t == table and c not in _AFTER_JOINS]
        return read_table(spark, folder, table).selectExpr(*keys, *own)

    orders = rows_of("orders", "o_orderkey", "o_custkey").join(
        rows_of("customer", "c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
    )
    rows = rows_of("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(rows_of("part", "p_partkey"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.selectExpr(*[f"{expression(c)} AS {c}" if c in _AFTER_JOINS else c for c in columns])


def clean_rows(spark: SparkSession, folder: str, columns: Iterable[str] = CLEAN_COLUMNS) -> DataFrame:
    """The requested columns with features added and gaps filled; no row is removed. Only
    the two columns that can have gaps are filled, so filters on the others still reach
    the scans."""
    columns = list(columns)
    raw = raw_rows(spark, folder, dict.fromkeys(_DERIVED.get(c, c) for c in columns))
    rows = raw.transform(add_age, "MAKE_YEAR", AS_OF).transform(add_date_parts)
    return fill_missing(rows, {"CAPACITY": 0.0, "COLOR": UNKNOWN}).select(*columns)


def region_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Four of the nations, so that most rows have no region."""
    return read_table(spark, folder, "nation").filter("n_nationkey < 4").selectExpr(
        "cast(n_nationkey as string) AS REG_ADDR_KOATUU", "n_name AS REGION_NAME"
    )


def registry(spark: SparkSession, folder: str, columns: Iterable[str] = CLEAN_COLUMNS) -> Registry:
    return Registry(
        clean=clean_rows(spark, folder, columns),
        regions=region_rows(spark, folder),
        operations=lookup(spark, OPERATION_ROWS, ("OPER_CODE", "OPER_DESC")),
        terms=TERMS,
    )


def view_sql() -> str:
    """The same view as SQL common table expressions ``raw``, ``clean``, ``region`` and
    ``operation``; always with all three joins."""
    raw = ",\n    ".join(f"{e.format(text='varchar')} AS {c}" for c, (e, _) in _COLUMNS.items())
    derived = {
        "AGE": f"{AS_OF} - MAKE_YEAR",
        "REG_YEAR": "cast(year(D_REG) as integer)",
        "REG_MONTH": "cast(month(D_REG) as integer)",
        "COLOR": f"coalesce(COLOR, '{UNKNOWN}')",
        "CAPACITY": "coalesce(CAPACITY, 0.0)",
    }
    clean = ", ".join(f"{derived[c]} AS {c}" if c in derived else c for c in CLEAN_COLUMNS)
    operations = ", ".join(f"('{code}', '{text}')" for code, text in OPERATION_ROWS)
    return f"""raw AS (
  SELECT {raw}
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
), clean AS (
  SELECT {clean} FROM raw
), region AS (
  SELECT cast(n_nationkey as varchar) AS REG_ADDR_KOATUU, n_name AS REGION_NAME
  FROM nation WHERE n_nationkey < 4
), operation(OPER_CODE, OPER_DESC) AS (VALUES {operations})"""
