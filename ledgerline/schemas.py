"""Declared schemas (nothing is inferred from JSON)."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(19, 4)

ORDER_ITEM = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", MONEY),
])

# Normalised order event: one shape for every topic (items empty for status events).
NORMALISED_EVENT = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("total_amount", MONEY),
    T.StructField("items", T.ArrayType(ORDER_ITEM)),
    T.StructField("status", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
])

# JSON payloads as they travel on the topics (camelCase field names).
JSON_ORDER_ITEM = T.StructType([
    T.StructField("productId", T.StringType()),
    T.StructField("productName", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unitPrice", MONEY),
])
JSON_ORDER_CREATED = T.StructType([
    T.StructField("orderId", T.StringType()),
    T.StructField("customerId", T.StringType()),
    T.StructField("items", T.ArrayType(JSON_ORDER_ITEM)),
    T.StructField("totalAmount", MONEY),
    T.StructField("createdAt", T.StringType()),
])
JSON_ORDER_STATUS = T.StructType([
    T.StructField("orderId", T.StringType()),
    T.StructField("customerId", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("totalAmount", MONEY),
    T.StructField("updatedAt", T.StringType()),
])
JSON_PAYLOAD_ITEMS = T.StructType([
    T.StructField("orderId", T.StringType()),
    T.StructField("items", T.ArrayType(JSON_ORDER_ITEM)),
])

# Raw topic record (Kafka layout; the file source carries the same columns).
TOPIC_RECORD = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

# Stock command and the fold's result row.
STOCK_COMMAND = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("kind", T.StringType()),          # reserve | release | confirm | replenish
    T.StructField("order_id", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("seq", T.LongType()),
])
STOCK_RESULT_DDL = (
    "product_id string, kind string, order_id string, quantity int, ts timestamp, seq long, line_no int, "
    "ok boolean, applied boolean, effective_quantity int, message string, "
    "available_after int, reserved_after int"
)

# Order command fold result.
ORDER_COMMAND_RESULT_DDL = (
    "order_id string, seq long, command string, ts timestamp, accepted boolean, "
    "emitted_event string, status_before string, status_after string, message string"
)
