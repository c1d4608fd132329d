"""K7 / K9 as a stream: stock commands with all-or-nothing orders, one micro-batch at a time.

The stock state lives in two keyed tables (``sources.sinks``): available stock
per product and open reservations per (product, order), both cut by product, of
which a micro-batch reads and writes the partitions it touches. Each micro-batch runs the three passes of the batch
operator on the products it touches:

1. fold every product's requests (``StockFold``), starting from the stored
   state (``restore`` / ``hold`` commands ordered first);
2. decide each order (J3 / A9);
3. release the successful items of failed orders (J4) *after* the batch,

then writes the new state of the touched products and reservations as the
batch's version. Reads only see versions before the batch, and every write
is an overwrite of the batch's own partition, so a retried batch is
idempotent. The fold results of a batch are written once (the batch's
ledger) and read back, cutting the lineage before the three passes. What a batch
writes only to read it again, and the shuffles that made it, go as soon as nothing reads them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerline import config
from ledgerline.operators import inventory as I
from ledgerline.session import drop_folder, free_shuffles
from ledgerline.sources.sinks import KeyedTable

AVAILABLE_SCHEMA = T.StructType([T.StructField("product_id", T.StringType()),
                                 T.StructField("available", T.IntegerType())])
RESERVATION_SCHEMA = T.StructType([T.StructField("product_id", T.StringType()),
                                   T.StructField("order_id", T.StringType()),
                                   T.StructField("quantity", T.IntegerType()),
                                   T.StructField("live", T.BooleanType())])


class StockState:
    def __init__(self, base: str):
        base = base.rstrip("/")
        self.base = base
        self.available = KeyedTable(f"{base}/available", ["product_id"], AVAILABLE_SCHEMA)
        self.reservations = KeyedTable(f"{base}/reservations", ["product_id", "order_id"], RESERVATION_SCHEMA, bucket_by=["product_id"], keep="live")
        self.outcomes = f"{base}/outcomes"
        self.ledger = f"{base}/ledger"

    def ensure(self, spark: SparkSession) -> None:
        self.available.ensure(spark)
        self.reservations.ensure(spark)


def _cmd(df: DataFrame, kind: str, quantity: str, order_id=None) -> DataFrame:
    return df.select("product_id", F.lit(kind).alias("kind"),
                     (F.col(order_id) if order_id else F.lit(None).cast("string")).alias("order_id"),
                     F.col(quantity).cast("int").alias("quantity"), F.lit(None).cast("timestamp").alias("ts"),
                     F.lit(None).cast("long").alias("seq"), F.lit(None).cast("int").alias("line_no"),
                     F.lit(0 if kind == "restore" else 1).alias("rank"))


def _written(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read back; what was shuffled to make it can go."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    free_shuffles(spark)
    return spark.read.schema(df.schema).parquet(path)


def reserve_batch(spark: SparkSession, lines: DataFrame, batch_id: int, state: StockState,
                  initial_stock: DataFrame, sep: str = ", ",
                  prefix: str = config.INSUFFICIENT_STOCK_PREFIX, from_files: bool = False) -> DataFrame:
    """One micro-batch of stock commands; returns the batch's order outcomes (also written).

    ``lines``: product_id, order_id, quantity, ts, seq, line_no and an
    optional ``kind`` (reserve when absent; release / confirm / replenish
    otherwise), or order records (order_id, ts, seq, items) as ``order_records``
    makes them, which no trigger can split. Reserves are all-or-nothing per order:
    a failed order also gives back what it holds from earlier batches. Lines that are
    read ``from_files`` are not written again.
    """
    if "items" in lines.columns:
        lines = lines.select("order_id", "ts", "seq", F.explode("items").alias("i")).select("i.*", "order_id", "ts", "seq")
    if "kind" not in lines.columns:
        lines = lines.withColumn("kind", F.lit("reserve"))
    input_path = f"{state.base}/input/batch_id={int(batch_id)}"
    if not from_files:      # the micro-batch is used several times below: write it once, read it back
        lines = _written(spark, lines, input_path)
    touched = lines.select("product_id").distinct()
    known = state.available.read(spark, before=batch_id, only=touched).join(touched, "product_id", "left_semi")
    fresh = (initial_stock.select("product_id", F.col("available").cast("int").alias("available"))
             .join(touched, "product_id", "left_semi").join(known.select("product_id"), "product_id", "left_anti"))
    holds = (state.reservations.read(spark, before=batch_id, only=touched)
             .join(touched, "product_id", "left_semi"))
    cmds = (_cmd(known.unionByName(fresh), "restore", "available")
            .unionByName(_cmd(holds, "hold", "quantity", "order_id"))
            .unionByName(lines.select("product_id", "kind", "order_id", F.col("quantity").cast("int").alias("quantity"),
                                      "ts", F.col("seq").cast("long").alias("seq"),
                                      F.col("line_no").cast("int").alias("line_no"), F.lit(2).alias("rank"))))
    ledger_path = f"{state.ledger}/batch_id={int(batch_id)}"
    results = _written(spark, I.apply_stock_commands(cmds), ledger_path)
    drop_folder(spark, input_path)
    touched = results.select("product_id").distinct()

    # pass 2: per-order outcome of this batch's reservation requests
    items = results.where(F.col("kind") == "reserve")
    out_path = f"{state.outcomes}/batch_id={int(batch_id)}"
    out = I.order_reservation_outcome(items, sep, prefix).withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
    out = _written(spark, out, out_path)
    # where each (product, order) stands at the end of the batch
    order_of = F.struct(*I.COMMAND_ORDER)
    changes = (results.where(F.col("applied") & F.col("order_id").isNotNull())
               .groupBy("product_id", "order_id")
               .agg(F.max_by(F.struct("kind", "effective_quantity"), order_of).alias("last")))
    changes_path = f"{state.base}/changes/batch_id={int(batch_id)}"     # several steps below start from it
    changes = _written(spark, changes, changes_path)
    held_end = changes.where(F.col("last.kind") == "reserve").select(
        "product_id", "order_id", F.col("last.effective_quantity").alias("quantity"))
    # pass 3: successful items of failed orders still held → released after the batch
    failed = out.where(~F.col("reserved")).select("order_id")
    comp = held_end.join(failed, "order_id", "left_semi")
    earlier = (state.reservations.read(spark, before=batch_id).join(failed, "order_id", "left_semi")
               .join(changes.select("product_id", "order_id"), ["product_id", "order_id"], "left_anti")
               .select("product_id", "order_id", "quantity"))
    comp = comp.select("product_id", "order_id", "quantity").unionByName(earlier)
    last = (results.groupBy("product_id")
            .agg(F.max_by("available_after", order_of).alias("after")))
    # products that only give back: their stored stock
    last = last.unionByName(state.available.read(spark, before=batch_id)
                            .join(earlier.select("product_id").distinct(), "product_id", "left_semi")
                            .join(touched, "product_id", "left_anti").select("product_id", F.col("available").alias("after")))
    back = comp.groupBy("product_id").agg(F.sum("quantity").alias("back"))
    new_available = last.join(back, "product_id", "left").select(
        "product_id", (F.col("after") + F.coalesce("back", F.lit(0))).cast("int").alias("available"))
    live = held_end.join(comp.select("product_id", "order_id"), ["product_id", "order_id"], "left_anti")
    gone = (changes.select("product_id", "order_id", F.col("last.effective_quantity").alias("quantity")).unionByName(earlier)
            .join(live.select("product_id", "order_id"), ["product_id", "order_id"], "left_anti"))
    new_reservations = live.withColumn("live", F.lit(True)).unionByName(gone.withColumn("live", F.lit(False)))
    state.available.upsert(new_available, batch_id)
    free_shuffles(spark)
    state.reservations.upsert(new_reservations, batch_id)
    drop_folder(spark, changes_path)
    free_shuffles(spark)
    return out


def start_reservation_stream(spark: SparkSession, lines_stream: DataFrame, initial_stock: DataFrame,
                             base: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Run the stock stream: order lines / stock commands (product_id, order_id, quantity,
    ts, seq, line_no[, kind]) per micro-batch."""
    state = StockState(base)
    state.ensure(spark)
    w = (lines_stream.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, batch_id: reserve_batch(spark, df, batch_id, state, initial_stock)))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def read_outcomes(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/outcomes")


def read_stock(spark: SparkSession, base: str) -> DataFrame:
    """Current state: available and reserved per product."""
    st = StockState(base)
    held = (st.reservations.read(spark).groupBy("product_id")
            .agg(F.sum("quantity").cast("long").alias("reserved")))
    return (st.available.read(spark).join(held, "product_id", "left")
            .select("product_id", F.col("available").cast("long").alias("available"),
                    F.coalesce("reserved", F.lit(0).cast("long")).alias("reserved")))


def order_records(lines: DataFrame) -> DataFrame:
    """One record per order with its items, as producers send them: (order_id, ts, seq, items)."""
    item = F.struct("line_no", "product_id", "quantity")
    return lines.groupBy("order_id", "ts", "seq").agg(F.sort_array(F.collect_list(item)).alias("items"))


def envelope_commands(env: DataFrame, created_items: DataFrame) -> DataFrame:
    """Stock commands of decoded ``order-events`` envelopes.

    q20: items of cancel/confirm taken from the Created events (``created_items``:
    order_id, items) → P5 routing → one command per item, ordered by record offset.
    """
    from ledgerline.operators import parse as P
    return _stock_commands(P.route_by_event_type(P.recover_items(env, created_items))["commands"])


def _stock_commands(routed: DataFrame) -> DataFrame:
    return routed.select("product_id", "kind", "order_id", "quantity", F.col("timestamp").alias("ts"),
                         F.col("offset").cast("long").alias("seq"), (F.col("item_pos") + 1).cast("int").alias("line_no"))


RECORD_ID = ["topic", "partition", "offset"]
OFFSET_BITS = 10                           # a block is 1,024 consecutive offsets


def _block(offset) -> Column:
    return F.shiftright(offset, OFFSET_BITS)


_ITEMS = T.ArrayType(T.StructType([T.StructField("product_id", T.StringType()), T.StructField("quantity", T.IntegerType())]))


def _schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


class ConsumerState:
    """What the inventory stream keeps beside the stock: offsets seen, items of created orders, and commands that wait for them."""

    def __init__(self, base: str):
        self.offsets = KeyedTable(f"{base}/offsets", ["topic", "partition", "block"],
                                  _schema("topic string, partition int, block long, seen array<struct<lo:long,hi:long>>"))
        self.created = KeyedTable(f"{base}/created_items", ["order_id"],
                                  T.StructType([T.StructField("order_id", T.StringType()), T.StructField("items", _ITEMS)]))
        self.pending = KeyedTable(f"{base}/pending", ["order_id", "event_type", "offset", "timestamp"],
                                  _schema("order_id string, event_type string, offset long, timestamp timestamp, waits boolean"), bucket_by=["order_id"], keep="waits")

    def ensure(self, spark: SparkSession) -> None:
        for table in (self.offsets, self.created, self.pending):
            table.ensure(spark)


def unseen(records: DataFrame, seen: DataFrame, decoded=lambda rows: rows) -> DataFrame:
    """Records of no interval of ``seen`` (topic, partition, seen), once each; those without an id are always new.
    What ``decoded`` makes of them, which keeps their ids, is dealt by blocks of offsets, once for both."""
    spans = seen.select("topic", "partition", F.explode("seen").alias("s")).select("topic", "partition", _block("s.lo").alias("block"), "s.lo", "s.hi")
    with_id = F.col("topic").isNotNull() & F.col("partition").isNotNull() & F.col("offset").isNotNull()
    fresh = decoded(records.where(with_id)).withColumn("block", _block("offset"))
    of = ["topic", "partition", "block"]
    same = [fresh[c] == spans[c] for c in of] + [fresh["offset"].between(spans["lo"], spans["hi"])]
    return (fresh.join(spans, same, "left_anti").dropDuplicates([*of, "offset"]).drop("block")
            .unionByName(decoded(records.where(~with_id))))


def with_offsets(seen: DataFrame, records: DataFrame) -> DataFrame:
    """``seen`` with the offsets of ``records``: per (topic, partition) of either and block of offsets, the block's intervals of
    consecutive offsets, merged. A row holds half a block of intervals at most, whatever the gaps, and no task a whole partition of a topic."""
    new = records.where(F.col("topic").isNotNull() & F.col("partition").isNotNull() & F.col("offset").isNotNull()).select(*RECORD_ID).distinct()
    of = ["topic", "partition", "block"]
    by = Window.partitionBy(*of).orderBy("offset")
    runs = new.withColumn("block", _block("offset")).withColumn("run", F.col("offset") - F.row_number().over(by)).groupBy(*of, "run").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"))
    spans = runs.select(*of, "lo", "hi").unionByName(seen.select("topic", "partition", F.explode("seen").alias("s")).select("topic", "partition", _block("s.lo").alias("block"), "s.lo", "s.hi"))
    order = Window.partitionBy(*of).orderBy("lo", "hi")
    reach = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = spans.withColumn("fresh", F.when(F.col("lo") <= reach + 1, 0).otherwise(1))
    island = starts.withColumn("island", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = island.groupBy(*of, "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return merged.groupBy(*of).agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("seen")).select("topic", "partition", "seen")


def consume_batch(spark: SparkSession, records: DataFrame, batch_id: int, stock: StockState, state: ConsumerState,
                  initial_stock: DataFrame) -> None:
    """One micro-batch of ``order-events`` records.

    Records whose offset an earlier batch has seen are dropped however late they come again (q12). A cancel or confirm
    without items takes those of its order's Created event, of this batch or an earlier one (q20); if that has
    not come yet, it waits and is replayed, at its own time, in the batch that brings it. Records that do not decode go to
    ``dead_letters``, handled events without any items and other types to ``warnings``; the rest become stock commands.
    """
    from ledgerline.operators import notify as N
    from ledgerline.operators import parse as P
    n, base = int(batch_id), stock.base
    blocks = records.select("topic", "partition", _block("offset").alias("block")).distinct()
    seen = state.offsets.read(spark, before=n, only=blocks).join(blocks, ["topic", "partition", "block"], "left_semi")
    decoded, items_path, events = (f"{base}/{name}/batch_id={n}" for name in ("decoded", "items", "events"))
    # records are decoded before they are dealt by their ids: of those that do decode, the raw key and value have served
    raw = {c: F.when(~F.col("ok"), F.col(c)) for c in ("key", "value")}
    env = _written(spark, unseen(records, seen, lambda rows: P.parse_envelope(rows).withColumns(raw)), decoded)
    state.offsets.upsert(with_offsets(seen, env).withColumn("block", _block(F.col("seen")[0]["lo"])), n)
    N.dead_letter(env).write.mode("overwrite").parquet(f"{base}/dead_letters/batch_id={n}")
    free_shuffles(spark)

    good = env.where("ok").select("order_id", "event_type", "items", "offset", "timestamp", "ok")
    created = good.where(F.col("event_type") == "ORDER_CREATED")
    came = created.groupBy("order_id").agg(F.min_by("items", "offset").alias("items"))
    needed = good.select("order_id").distinct()
    known = state.created.read(spark, before=n, only=needed).join(needed, "order_id", "left_semi")
    items = _written(spark, known.unionByName(came.join(known, "order_id", "left_anti")), items_path)
    state.created.upsert(items.join(known, "order_id", "left_anti"), n)
    free_shuffles(spark)

    ids = created.select("order_id").distinct()
    back = state.pending.read(spark, before=n, only=ids).join(ids, "order_id", "left_semi")
    handled = F.col("event_type").isin("ORDER_CANCELLED", "ORDER_CONFIRMED") & (F.size("items") == 0)
    rows = ["order_id", "event_type", "offset", "timestamp"]
    again = back.select(*rows).withColumns({"items": F.array().cast(_ITEMS), "ok": F.lit(True), "handled": F.lit(False)})
    fixed = P.recover_items(good.withColumn("handled", handled).unionByName(again), items, found="found")
    fixed = _written(spark, fixed.withColumn("waits", F.col("handled") & ~F.col("found")).drop("handled", "found"), events)
    state.pending.upsert(fixed.where("waits").select(*rows, "waits").unionByName(back.select(*rows).withColumn("waits", F.lit(False))), n)
    routes = P.route_by_event_type(fixed.where("not waits"))
    routes["empty"].select("order_id", "event_type", F.lit("no items").alias("warning")).unionByName(
        routes["ignored"].select("order_id", "event_type", F.lit("ignored").alias("warning"))) \
        .write.mode("overwrite").parquet(f"{base}/warnings/batch_id={n}")
    for path in (decoded, items_path):
        drop_folder(spark, path)
    free_shuffles(spark)
    reserve_batch(spark, _stock_commands(routes["commands"]), n, stock, initial_stock, from_files=True)
    drop_folder(spark, events)


def start_inventory_stream(spark: SparkSession, envelopes: DataFrame, initial_stock: DataFrame, base: str, checkpoint: str,
                           available_now: bool = True) -> StreamingQuery:
    """K9 as a stream of ``order-events`` records, without any time limit (``consume_batch``)."""
    stock, state = StockState(base), ConsumerState(base.rstrip("/"))
    stock.ensure(spark)
    state.ensure(spark)
    w = (envelopes.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, batch_id: consume_batch(spark, df, batch_id, stock, state, initial_stock)))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
