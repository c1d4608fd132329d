"""K2–K5 for hot products: the stock fold split over tasks.

``inventory.apply_stock_commands`` runs a product's commands in one task, since a refused
reservation consumes nothing. Most commands cannot be refused, though, and this operator proves
which: all rows are sorted by (product, time) over range partitions, so a product with a third of
all commands lies in many of them.

1. Per (product, order) — a small group however hot the product — it is known without the stock which
   reservation opens, which release or confirm closes it, and what either moves, if nothing is refused. An
   order that reserves one product more than once counts with all its reservations and no release.
2. The prefix sum of these moves per product (running sums in every range partition, plus the sums of the
   partitions before) never exceeds the true stock: a refused reservation only leaves more. Where it is not
   negative after a reservation, that reservation cannot be refused.
3. Only the orders for which this proof fails, and those that reserve a product twice, are folded in
   sequence, on the prefix sum of everything proven.
4. The prefix sums of what then really moved are the stock and the reserved amount after each command.

Whole rows are moved three times (to their order, to their place, and to what was decided about them), and
what one move leaves is dropped before the next; running sums are made as the sorted rows stream by, and of the sums of earlier partitions only
the first product of a partition has any, so they are as many as partitions.

Nothing of a hot product is gathered but the commands without a proof, which stream through one task.
Results equal ``apply_stock_commands`` row by row. Commands at the same place of a product's order
(equal ``COMMAND_ORDER`` columns) are taken by kind. Commands of a null product form a
product of their own; other kinds than the four are answered as unknown.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline import config
from ledgerline.operators.fold import KeyedFold, as_int_list, keyed_fold
from ledgerline.operators.inventory import COMMAND_COLS, COMMAND_ORDER, StockFold
from ledgerline.schemas import STOCK_RESULT_DDL
from ledgerline.session import drop_folder, free_shuffles, scratch_path

_DECISION_DDL = "product_id string, pos long, ok boolean, applied boolean, effective_quantity int, message string, d_available long, d_reserved long, by_available long, by_reserved long"
_DECIDED = ["ok", "applied", "effective_quantity", "message"]
_MOVES = ["d_available", "d_reserved"]
_KINDS = ["replenish", "reserve", "confirm", "release"]     # order of commands at the same place
_PART_BITS = 33                                             # ``monotonically_increasing_id`` holds the partition above these


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def _template(text: str, values: dict[str, Column]) -> Column:
    parts = []
    while "{" in text:
        head, _, text = text.partition("{")
        name, _, text = text.partition("}")
        parts += [F.lit(head), F.coalesce(values[name].cast("string"), F.lit("None"))]
    return F.concat(*parts, F.lit(text))


def _rank() -> Column:
    rank = F.lit(len(_KINDS))
    for i, kind in enumerate(_KINDS):
        rank = F.when(F.col("kind") == kind, i).otherwise(rank)
    return rank


class _Running:
    """Running sums of columns, per product, over batches sorted by product; ``sums``: {column: name of its sum}."""

    def __init__(self, sums: dict[str, str]):
        self.sums = sums

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        product, held = (), {c: 0 for c in self.sums}
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch.column("product_id").dictionary_encode(null_encoding="encode").indices.to_numpy()
            head = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
            size = np.diff(np.append(head, len(codes)))
            goes_on = product == (batch.column("product_id")[0].as_py(),)
            added = []
            for c in self.sums:
                value = batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                total = np.cumsum(value)
                before = total[head] - value[head]
                if goes_on:
                    before[0] -= held[c]
                total -= np.repeat(before, size)
                held[c] = int(total[-1])
                added.append(pa.array(total))
            product = (batch.column("product_id")[-1].as_py(),)
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *self.sums.values()])


def _with_sums(df: DataFrame, sums: dict[str, str]) -> DataFrame:
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return df.mapInArrow(_Running(sums), ", ".join([*fields, *(f"{s} long" for s in sums.values())]))


def ranged(commands: DataFrame, num_partitions: int | None = None, sums: dict[str, str] | None = None, tie: tuple[str, ...] = ()) -> DataFrame:
    """The commands sorted by product and time over range partitions, with ``part``, ``pos``, which counts up in that order,
    and running sums, per product and partition, of the columns ``sums``."""
    n = num_partitions or int(commands.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["product_id", *COMMAND_ORDER, *tie]
    rows = commands.repartitionByRange(n, *order).sortWithinPartitions(*order)
    rows = rows.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("pos"))
    return _kept(_with_sums(rows, sums) if sums else rows, "stock-ranged")


def _earlier(rows: DataFrame, moves: dict[str, Column]) -> DataFrame:
    """(product, part) with the sums of ``moves`` in the earlier partitions of the product: one row a partition at most."""
    before = Window.partitionBy("product_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("product_id", "part").agg(F.count(F.lit(1)).alias("_n"), *(F.sum(c).alias(f"_t_{name}") for name, c in moves.items()))
    sums = totals.select(F.col("product_id").alias("_product"), F.col("part").alias("_part"), F.sum("_n").over(before).alias("_n"),
                         *(F.coalesce(F.sum(f"_t_{name}").over(before), F.lit(0)).alias(f"_b_{name}") for name in moves))
    return sums.where(F.col("_n").isNotNull()).drop("_n")


def _plus_earlier(rows: DataFrame, earlier: DataFrame, sums: dict[str, str]) -> DataFrame:
    """``rows`` with the sums of earlier partitions added to their running sums; ``sums``: {name in ``earlier``: column}."""
    same = (rows["part"] == earlier["_part"]) & rows["product_id"].eqNullSafe(earlier["_product"])
    rows = rows.join(F.broadcast(earlier), same, "left")
    return rows.withColumns({s: F.col(s) + F.coalesce(f"_b_{name}", F.lit(0)) for name, s in sums.items()}).drop("_product", "_part", *(f"_b_{n}" for n in sums))


def _of_order() -> Column:
    return F.col("kind").isin("reserve", "release", "confirm")


def _valid() -> Column:
    return (F.col("kind") == "reserve") & F.coalesce(F.col("quantity") > 0, F.lit(False))


def _placed(commands: DataFrame) -> DataFrame:
    """Every command with its place in its (product, order), and what that says of it if nothing is refused: whether it ``closes`` the
    order's reservation, whether that is open (``open``) and its quantity; ``several``: the order reserves the product more than once."""
    kind = F.col("kind")
    # commands that concern no order stand alone
    pair = ["product_id", "order_id", F.when(~F.coalesce(_of_order(), F.lit(False)), F.xxhash64(*COMMAND_COLS))]
    ordered, whole = Window.partitionBy(*pair).orderBy(*COMMAND_ORDER, "rank"), Window.partitionBy(*pair)
    r = commands.select(*COMMAND_COLS, _rank().alias("rank")).withColumn("nth", F.row_number().over(ordered))
    r = r.withColumns({"opens": F.max(F.when(_valid(), F.col("nth"))).over(whole), "open_q": F.max(F.when(_valid(), F.col("quantity"))).over(whole),
                       "several": F.count(F.when(_valid(), 1)).over(whole) > 1})
    r = r.withColumn("_at", F.min(F.when(kind.isin("release", "confirm") & (F.col("nth") > F.col("opens")), F.col("nth"))).over(whole))
    nth = F.col("nth")
    return r.select(*COMMAND_COLS, "rank", "nth", "open_q", "several", F.coalesce(nth == F.col("_at"), F.lit(False)).alias("closes"),
                    F.coalesce((nth > F.col("opens")) & (F.col("_at").isNull() | (nth < F.col("_at"))), F.lit(False)).alias("open"))


def _moves() -> dict[str, Column]:
    """What a placed command moves if nothing is refused, and the least it can (``d_least``)."""
    kind, q, zero = F.col("kind"), F.col("quantity").cast("long"), F.lit(0).cast("long")
    amount = F.col("open_q").cast("long")
    available = (F.when(_valid(), -q).when((kind == "release") & F.col("closes"), amount)
                 .when((kind == "replenish") & F.coalesce(q > 0, F.lit(False)), q).otherwise(zero))
    reserved = F.when(_valid(), q).when(kind.isin("release", "confirm") & F.col("closes"), -amount).otherwise(zero)
    least = F.when(F.col("several"), F.when(_valid(), -q).otherwise(zero)).otherwise(available)
    return {"d_available": available, "d_reserved": reserved, "d_least": least}


def _answer() -> Column:
    """The answer to a placed command if nothing is refused."""
    kind, q = F.col("kind"), F.col("quantity")
    names = {"q": q, "pid": F.col("product_id"), "oid": F.col("order_id")}
    amount, none, zero = F.col("open_q"), F.lit(None).cast("string"), F.lit(0)

    def answer(ok, applied, effective, message):
        return F.struct(F.lit(ok).alias("ok"), F.lit(applied).alias("applied"), effective.cast("int").alias("effective_quantity"), message.alias("message"))

    return (F.when(_valid(), answer(True, True, q, none))
            .when((kind == "reserve") & F.col("open"), answer(True, False, amount, none))
            .when(kind == "reserve", answer(False, False, zero, _template(config.MSG_QTY_NOT_POSITIVE, names)))
            .when((kind == "release") & F.col("closes"), answer(True, True, amount, none))
            .when(kind == "release", answer(True, False, zero, none))
            .when((kind == "confirm") & F.col("closes"), answer(True, True, amount, none))
            .when(kind == "confirm", answer(False, False, zero, _template(config.MSG_NO_RESERVATION, names)))
            .when((kind == "replenish") & (q > 0), answer(True, True, q, none))
            .when(kind == "replenish", answer(False, False, zero, _template(config.MSG_REPLENISH_NOT_POSITIVE, names)))
            .otherwise(answer(False, False, zero, F.concat(F.lit("Unknown command "), F.coalesce(kind, F.lit("None"))))))


class _Unproven(KeyedFold):
    """The orders without a proof, on the stock that all others leave before each command: ``total``, the moves of all commands if
    nothing is refused, without those of the commands folded here. ``by_*``: by how much a command's moves differ from that."""

    key_cols = ("product_id",)
    out_cols = tuple(c.strip().split(" ")[0] for c in _DECISION_DDL.split(","))
    computed_cols = out_cols[2:]

    def init_state(self, key):
        return {"available": 0, "reservations": {}, "reserved": 0}

    def fold_batch(self, pdf, carry):
        out = {c: [] for c in self.computed_cols}
        pids, kinds, oids = (pdf[c].tolist() for c in ("product_id", "kind", "order_id"))
        for pid, kind, oid, q, total, available, reserved in zip(pids, kinds, oids, as_int_list(pdf["quantity"]), *(pdf[c].tolist() for c in ("total", *_MOVES))):
            if carry[1] is None or pid != carry[0]:
                carry[0], carry[1] = pid, self.init_state((pid,)) | {"moved": 0, "assumed": 0}
            state = carry[1]
            state["assumed"] += available
            state["available"], held = total - state["assumed"] + state["moved"], state["reserved"]
            before = state["available"]
            for name, value in zip(_DECIDED, StockFold._apply(state, pid, kind, oid, q)):
                out[name].append(value)
            moved, kept = state["available"] - before, state["reserved"] - held
            out["d_available"].append(moved)
            out["d_reserved"].append(kept)
            out["by_available"].append(moved - available)
            out["by_reserved"].append(kept - reserved)
            state["moved"] += moved
        return out


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``pos``, each behind the decision about it (``is_row`` false) if there is one, which takes the place of its own."""
    tail = None
    for batch in batches:
        if tail is not None:
            batch, tail = pa.Table.from_batches([tail, batch]).combine_chunks().to_batches()[0], None
        if not batch.num_rows:
            continue
        is_row = batch.column("is_row").to_numpy(zero_copy_only=False)
        if not is_row[-1]:                                   # its row comes with the next batch
            batch, tail, is_row = batch.slice(0, batch.num_rows - 1), batch.slice(batch.num_rows - 1), is_row[:-1]
        rows = np.flatnonzero(is_row)
        if len(rows):
            told = pa.array(rows - ((rows > 0) & ~is_row[rows - 1]))
            rows = pa.array(rows)
            names = [c for c in batch.schema.names if c != "is_row"]
            yield pa.RecordBatch.from_arrays([batch.column(c).take(told if c in _DECIDED or c in _MOVES else rows) for c in names], names)


def apply_stock_commands_split(commands: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """K2–K5 with every product split over range partitions; input and result as ``inventory.apply_stock_commands``."""
    spark = commands.sparkSession
    if "line_no" not in commands.columns:
        commands = commands.withColumn("line_no", F.lit(None).cast("int"))
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    moves = _moves()
    placed = _placed(commands).withColumns({c: moves[c] for c in ("d_available", "d_least")})
    placed = _kept(placed, "stock-placed")      # and what made it can go
    free_shuffles(spark)
    kept = ranged(placed, n, {"d_least": "least", "d_available": "total"}, ("rank", "order_id", "nth"))
    drop_folder(spark, placed._scratch)
    free_shuffles(spark)
    rows = _plus_earlier(kept, _earlier(kept, {c: F.col(c) for c in ("d_least", "d_available")}), {"d_least": "least", "d_available": "total"})
    rows = rows.where(_of_order()).withColumn("d_reserved", moves["d_reserved"])
    doubt = rows.where(F.col("several") | (_valid() & (F.col("least") < 0))).select(F.col("product_id").alias("_p"), F.col("order_id").alias("_o")).distinct()
    unproven = rows.join(doubt, rows["product_id"].eqNullSafe(doubt["_p"]) & rows["order_id"].eqNullSafe(doubt["_o"]), "left_semi")
    decided = keyed_fold(unproven.select("pos", "product_id", "kind", "order_id", "quantity", "total", *_MOVES), ["product_id"], ["pos"], _Unproven(),
                         _DECISION_DDL, num_partitions)
    decided = _kept(decided.withColumn("part", F.shiftright("pos", _PART_BITS).cast("int")), "stock-decided")
    free_shuffles(spark)

    own = kept.withColumns({"d_reserved": moves["d_reserved"], "a": _answer()})
    changed = own.select("product_id", "part", *_MOVES).unionByName(decided.select("product_id", "part", *(F.col(f"by_{c[2:]}").alias(c) for c in _MOVES)))
    earlier = _earlier(changed, {c: F.col(c) for c in _MOVES})
    own = own.select("part", "pos", F.lit(True).alias("is_row"), *COMMAND_COLS, "a.*", *_MOVES)
    told = decided.select("part", "pos", F.lit(False).alias("is_row"), "product_id", *_DECIDED, *_MOVES)
    placed = own.unionByName(told, allowMissingColumns=True).repartitionById(n, "part").sortWithinPartitions("pos", "is_row")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields if f.name != "is_row")
    sums = dict(zip(_MOVES, ("available_after", "reserved_after")))
    final = _plus_earlier(_with_sums(placed.mapInArrow(_decided, fields), sums), earlier, sums)
    return final.select(*(F.col(c.split(" ")[0]).cast(c.split(" ")[1]) for c in STOCK_RESULT_DDL.split(", ")))
