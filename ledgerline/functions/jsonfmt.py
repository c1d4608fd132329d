"""JSON helpers: P12 items → JSON and P13 SKU extraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.config import SKU_ARRAYS

SKU_FIELDS = ["sku", "productId", "product_id"]       # q21: sku, or the product id it stands for


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def json_string(c) -> Column:
    """JSON string literal of a string column, escaped by Spark's JSON writer (control characters too)."""
    text = F.to_json(F.array(_col(c)))
    return F.when(_col(c).isNull(), F.lit("null")).otherwise(F.substring(text, F.lit(2), F.length(text) - 2))


def items_to_json(items) -> Column:
    """Serialise items for the read model; failure/absence → ``[]``.

    Field order and number formatting are fixed so the text is stable:
    ``[{"productId":"1","productName":"x","quantity":2,"unitPrice":9.9900}]``.
    """
    def one(it):
        return F.concat(
            F.lit('{"productId":'), json_string(it["product_id"]),
            F.lit(',"productName":'), json_string(it["product_name"]),
            F.lit(',"quantity":'), F.coalesce(it["quantity"].cast("string"), F.lit("null")),
            F.lit(',"unitPrice":'), F.coalesce(it["unit_price"].cast("string"), F.lit("null")),
            F.lit("}"))
    body = F.array_join(F.transform(_col(items), one), ",")
    return F.coalesce(F.concat(F.lit("["), body, F.lit("]")), F.lit("[]"))


_SKU_ELEM = T.StructType([T.StructField(f, T.StringType()) for f in SKU_FIELDS])
_SKU_DOC = T.StructType([T.StructField(a, T.ArrayType(_SKU_ELEM)) for a in SKU_ARRAYS])


def extract_skus(doc) -> Column:
    """Non-blank string skus from ``items``, ``lineItems`` and ``orderItems``.

    Elements take ``sku``, else the product id (q21). Returns array<string>
    (not yet de-duplicated; see ``stock_view.distinct_skus``).
    """
    parsed = F.from_json(_col(doc), _SKU_DOC)
    per_array = [F.coalesce(parsed[a], F.array().cast(T.ArrayType(_SKU_ELEM))) for a in SKU_ARRAYS]
    elems = F.concat(*per_array)
    skus = F.transform(elems, lambda e: F.coalesce(*[e[f] for f in SKU_FIELDS]))
    return F.filter(skus, lambda s: s.isNotNull() & (F.trim(s) != ""))
