"""Order ⟕ stock.

SKUs are extracted from the order document, de-duplicated per order
case-insensitively (first spelling kept), and left-joined to the stock
snapshot: a missing SKU yields a 404 placeholder and never drops the order.
The result is flattened to (order, sku) rows; ``as_map`` folds it into the
order → {sku: stock} map, bounded by the distinct SKUs of one order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.jsonfmt import extract_skus


def distinct_skus(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """P13 + A8: (order_id, sku, sku_key) — first spelling of each lower-cased sku.

    An order without skus (no items, or a document that cannot be decoded) keeps one row with null sku.
    """
    skus = docs.select("order_id", F.posexplode_outer(extract_skus(doc_col)).alias("pos", "sku"))
    return (skus.withColumn("sku_key", F.lower("sku"))
            .groupBy("order_id", "sku_key")
            .agg(F.min_by("sku", "pos").alias("sku")))


def order_with_stock(docs: DataFrame, stock: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Every order's distinct skus with their stock (404 placeholder when missing).

    ``stock``: product_id, available, reserved, total; spellings of one product that differ in
    case are one sku, their amounts add up, so an order row is never doubled. An order without
    skus keeps one row with a null sku and status.
    """
    s = stock.groupBy(F.lower("product_id").alias("sku_key")).agg(
        *[F.sum(c).alias(c) for c in ("available", "reserved", "total")])
    rows = distinct_skus(docs, doc_col).join(s, "sku_key", "left")
    return rows.select("order_id", "sku", "available", "reserved", "total",
                       F.when(F.col("sku").isNotNull(), F.when(F.col("available").isNull(), F.lit(404)).otherwise(F.lit(200)))
                       .alias("stock_status"))


def as_map(rows: DataFrame) -> DataFrame:
    """Order → map sku → stock struct (per-order bounded)."""
    v = F.struct("stock_status", "available", "reserved", "total")
    entry = F.when(F.col("sku").isNotNull(), F.struct("sku", v))
    return rows.groupBy("order_id").agg(F.map_from_entries(F.collect_list(entry)).alias("stock"))
