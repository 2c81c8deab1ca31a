"""Tables that stand in for detected boxes, manifests and outcomes.

The given tables hold no images, so boxes and the rest are made of their numbers by fixed arithmetic. They
show that operators compute what they should; they say nothing about detection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size of the image that a card's boxes are taken to lie on.
CARD_W, CARD_H = 1200, 700

BOX_COLUMNS = """
    (l_partkey * 53 + l_linenumber * 7) % 3107 AS x, (l_suppkey * 97 + l_linenumber * 131) % 4377 AS y,
    150 + CAST(floor(l_extendedprice) AS BIGINT) % 1800 AS w, 60 + CAST(floor(l_quantity) AS BIGINT) * 17 AS h,
    3 + l_linenumber % 3 AS n_vertices"""


def boxes(spark: SparkSession, sf_dir: str, per_page: int = 10) -> DataFrame:
    """(doc, page, x, y, w, h, n_vertices): ``per_page`` orders to a page, 20 pages to a document."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    page = f"l_orderkey div {per_page}"
    exprs = [e.strip() for e in f"{page} div 20 AS doc, {page} AS page,".rstrip(",").split(",")]
    return rows.selectExpr(*exprs, *_split(BOX_COLUMNS))


def _split(columns: str) -> list[str]:
    """Column expressions at the commas outside of parentheses."""
    out, depth, now = [], 0, ""
    for c in columns:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(now.strip())
            now = ""
        else:
            now += c
    return [*out, now.strip()]


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return rows.select(F.concat(F.lit("pdf_"), F.col("o_orderkey").cast("string")).alias("pdf_name"), (F.col("o_custkey") % 12 + 1).alias("n_pages"), "o_orderkey", "o_custkey", "o_orderstatus")


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, user_id, ok, seconds, free_gb, utilization)."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    cents = F.floor(F.abs("value") * 100).cast("long")
    return rows.select(
        "event_id",
        "user_id",
        (F.col("event_type") != "error").alias("ok"),
        (cents / 100).alias("seconds"),
        (F.pmod(cents, F.lit(2400)) / 100).alias("free_gb"),
        (F.col("user_id") % 101).alias("utilization"),
    )


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pdf_name, first, ok, seconds): images of the manifest's documents; what has line number 7 comes from page 1."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return rows.select(F.concat(F.lit("pdf_"), F.col("l_orderkey").cast("string")).alias("pdf_name"), (F.col("l_linenumber") == 7).alias("first"), (F.col("l_returnflag") != "R").alias("ok"), F.floor("l_quantity").cast("long").cast("double").alias("seconds"))


#: The same tables for the SQL side; {n} is the number of orders on a page.
SQL_BOXES = f"""boxes AS (SELECT (l_orderkey // {{n}}) // 20 AS doc, l_orderkey // {{n}} AS page, {BOX_COLUMNS} FROM lineitem)"""
SQL_MANIFEST = "manifest AS (SELECT 'pdf_' || o_orderkey AS pdf_name, o_custkey % 12 + 1 AS n_pages, o_orderkey, o_custkey, o_orderstatus FROM orders)"
SQL_OUTCOMES = """cents AS (SELECT *, floor(abs(value) * 100)::BIGINT AS c FROM events),
outcomes AS (SELECT event_id, user_id, event_type <> 'error' AS ok, c / 100 AS seconds, (c % 2400) / 100 AS free_gb, user_id % 101 AS utilization FROM cents)"""
SQL_IMAGES = """images AS (SELECT 'pdf_' || l_orderkey AS pdf_name, l_linenumber = 7 AS first, l_returnflag <> 'R' AS ok, floor(l_quantity)::BIGINT::DOUBLE AS seconds FROM lineitem)"""
