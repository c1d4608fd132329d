"""Stateful streaming folds: K2–K5 per product and K10 per order.

The state lives in the state store, and a batch touches only what it names:

* the products of a bucket (``transformWithState``, RocksDB) have a value with their counters
  (available, reserved), which a batch reads and writes in one piece, and a map state with an entry per open
  reservation (product, order → quantity), of which a batch reads the entries it mentions and writes
  those it changed; closed reservations are removed. Most pairs that a batch mentions have no entry, so
  eight bytes of each open one (``Known``) tell first which are worth a lookup;
* the orders of a bucket (``applyInPandasWithState``) have their statuses.

Within a trigger a bucket's rows are put in the order of the batch folds and run
through the same step functions, so batch and stream give the same results.
Stock commands travel packed, as Arrow record batches of a bucket's rows, to the call that folds them, and so do its
results, so no single row passes between the JVM and Python.
To be ordered a bucket's rows of a trigger are held: what one bucket may bring at once is
bounded by the stream's ``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``
(the registered queries set it), never by the history. Commands without
a key share a key of their own, as in the batch folds. An empty stream gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupStateTimeout

from ledgerline.operators.commands import OrderCommandFold
from ledgerline.operators.fold import as_int_list
from ledgerline.operators.inventory import COMMAND_COLS, COMMAND_ORDER, StockFold
from ledgerline.schemas import ORDER_COMMAND_RESULT_DDL, STOCK_RESULT_DDL

PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ORDER_COMMAND_COLS = ["order_id", "seq", "command", "ts"]
ORDER_STATE_DDL = "order_ids array<string>, statuses array<string>"
BUCKETS, BUCKET = 4096, "bucket"           # keys are handled by buckets: a call, and the state's round trips, serve many of them
STOCK_BUCKETS = 1024                       # of products
OUTPUT_ROWS = 10_000                       # result rows of one key handed to Spark at a time
PACK_ROWS = 500_000                        # rows of a task that are packed by bucket at a time
_TEXT, _INT, _LONG, _TIME = pa.string(), pa.int32(), pa.int64(), pa.timestamp("us", "UTC")
_COMMAND_TYPES = dict(zip(COMMAND_COLS, (_TEXT, _TEXT, _TEXT, _INT, _TIME, _LONG, _INT), strict=True))
_PACKED = pa.schema([*_COMMAND_TYPES.items(), ("pair", _LONG)])
_RESULTS = pa.schema([*_COMMAND_TYPES.items(), ("ok", pa.bool_()), ("applied", pa.bool_()), ("effective_quantity", _INT), ("message", _TEXT),
                      ("available_after", _INT), ("reserved_after", _INT)])


def start_with_rocksdb(spark: SparkSession, writer):
    """Start a stream of this module; the session's own state store provider is set back afterwards."""
    before = spark.conf.get(PROVIDER_KEY, None)
    spark.conf.set(PROVIDER_KEY, ROCKSDB)
    try:
        return writer.start()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER_KEY)
        else:
            spark.conf.set(PROVIDER_KEY, before)


def _in_order(rows: Iterable[tuple], names: list[str], order: list[str]) -> Iterator[dict]:
    """A key's rows of one trigger, ordered as the batch folds order them (missing values first)."""
    at = [names.index(c) for c in order]
    missing = lambda v: v is None or v != v                                        # noqa: E731
    for row in sorted(rows, key=lambda row: tuple((False, 0) if missing(row[i]) else (True, row[i]) for i in at)):
        yield dict(zip(names, row, strict=True))


def _frames(results: Iterator[dict], columns) -> Iterator[pd.DataFrame]:
    while part := list(islice(results, OUTPUT_ROWS)):
        yield pd.DataFrame.from_records(part, columns=list(columns))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by bucket: one record batch of all columns but the bucket, as bytes, for each bucket of some ``PACK_ROWS`` rows."""
    held, n = [], 0

    def packed():
        table = pa.Table.from_batches(held)
        buckets = table.column(BUCKET).to_numpy()
        order = np.argsort(buckets, kind="stable")
        rows = table.select(_PACKED.names).cast(_PACKED).take(pa.array(order)).combine_chunks().to_batches()[0]
        starts = np.flatnonzero(np.diff(buckets[order], prepend=-1))
        data = [rows.slice(a, b - a).serialize().to_pybytes() for a, b in zip(starts, [*starts[1:], len(order)])]
        return pa.RecordBatch.from_arrays([pa.array(buckets[order][starts], _INT), pa.array(data, pa.binary())], [BUCKET, "data"])

    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= PACK_ROWS:
            yield packed()
            held, n = [], 0
    if n:
        yield packed()


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column("data"):
            yield pa.ipc.read_record_batch(data.as_buffer(), _RESULTS)


class Known:
    """Which (product, order) pairs of a bucket may have an open reservation, by 64-bit hashes of all that are open: those of
    ``base``, and those opened since that was written less those closed. The latter are few beside the former (``LATE``), so
    a trigger writes little of what earlier ones opened. Equal hashes count each by itself, so a pair that is open is never missed."""

    LATE = 32                              # times the root of the base

    def __init__(self, base: bytes, opened: bytes, closed: bytes):
        self.base, self.opened, self.closed = (np.frombuffer(x, np.int64) for x in (base, opened, closed))

    def maybe(self, pairs: np.ndarray) -> np.ndarray:
        return np.isin(pairs, self.base) | np.isin(pairs, self.opened)

    def change(self, opened: list[int], closed: list[int]) -> bool:
        """Take in what a trigger opened and closed; whether the base is another then."""
        self.opened, self.closed = np.append(self.opened, np.array(opened, np.int64)), np.append(self.closed, np.array(closed, np.int64))
        if len(self.opened) + len(self.closed) <= self.LATE * len(self.base) ** 0.5:
            return False
        self.base = _less(np.append(self.base, self.opened), self.closed)
        self.opened = self.closed = np.array([], np.int64)
        return True


def _less(values: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """``values``, each as often as it has more of them than ``gone``; sorted."""
    kinds, n = np.unique(values, return_counts=True)
    gone, n_gone = np.unique(gone, return_counts=True)
    n[np.searchsorted(kinds, gone)] -= n_gone
    return np.repeat(kinds, n)


class StockProcessor(StatefulProcessor):
    """K2–K5 for the products of a bucket: their counters in one value, open reservations in a map state."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.fold = StockFold()
        self.counters = handle.getValueState("counters", "products array<string>, available array<bigint>, reserved array<bigint>, opened binary, closed binary")
        self.base = handle.getValueState("base", "hashes binary")
        self.entries = handle.getMapState("reservations", "product string, order_id string", "quantity long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        table = pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(row.data), _PACKED) for row in rows]).combine_chunks()
        order = pc.sort_indices(table, sort_keys=[(c, "ascending") for c in ("product_id", *COMMAND_ORDER)], null_placement="at_start")
        products, available, reserved, *late = self.counters.get() or ([], [], [], b"", b"")
        states = {p: {"available": a, "reserved": r, "reservations": {}} for p, a, r in zip(products, available, reserved, strict=True)}
        known = Known(*(self.base.get() or (b"",)), *late)
        before = self._open(table.filter(pa.array(known.maybe(table.column("pair").to_numpy()))))
        for (product, oid), quantity in before.items():
            states[product]["reservations"][oid] = quantity
        for at in range(0, len(order), OUTPUT_ROWS):
            yield Row(data=self._folded(table.take(order.slice(at, OUTPUT_ROWS)), states))
        self._write(table, states, before, known)

    def _open(self, table: pa.Table) -> dict[tuple, int]:
        """The open reservations of earlier triggers among the pairs of ``table``."""
        found = {pair: self.entries.getValue(_entry(*pair)) for pair in set(zip(_list(table, "product_id"), _list(table, "order_id")))}
        return {pair: int(entry[0]) for pair, entry in found.items() if entry is not None}

    def _folded(self, table: pa.Table, states: dict) -> bytes:
        """The results of commands that are in order; ``states`` are then as they leave them."""
        columns = [_list(table, c) for c in ("product_id", "kind", "order_id")]
        out, available, reserved = [], [], []
        for product, kind, oid, quantity in zip(*columns, as_int_list(table.column("quantity").to_pandas()), strict=True):
            state = states.get(product)
            if state is None:
                state = states[product] = self.fold.init_state((product,))
            out.append(self.fold._apply(state, product, kind, oid, quantity))
            available.append(state["available"])
            reserved.append(state["reserved"])
        computed = [*zip(*out), available, reserved]
        rows = table.select(COMMAND_COLS).combine_chunks().to_batches()[0]
        arrays = [pa.array(values, f.type) for values, f in zip(computed, list(_RESULTS)[len(COMMAND_COLS):], strict=True)]
        return pa.RecordBatch.from_arrays([*rows.columns, *arrays], schema=_RESULTS).serialize().to_pybytes()

    def _write(self, table: pa.Table, states: dict, before: dict, known: Known) -> None:
        """Write what changed: all counters, and the entries that differ from ``before``."""
        now = {(product, oid): quantity for product, state in states.items() for oid, quantity in state["reservations"].items()}
        opened, closed = [pair for pair in now if pair not in before], [pair for pair in before if pair not in now]
        for pair, quantity in now.items():
            if before.get(pair) != quantity:
                self.entries.updateValue(_entry(*pair), (quantity,))
        for pair in closed:
            self.entries.removeKey(_entry(*pair))
        hashes = dict(zip(zip(_list(table, "product_id"), _list(table, "order_id")), _list(table, "pair"))) if opened or closed else {}
        if known.change([hashes[pair] for pair in opened], [hashes[pair] for pair in closed]):
            self.base.update((known.base.tobytes(),))
        self.counters.update((list(states), [s["available"] for s in states.values()], [s["reserved"] for s in states.values()],
                              known.opened.tobytes(), known.closed.tobytes()))

    def close(self) -> None:
        pass


def _list(table: pa.Table, column: str) -> list:
    return table.column(column).to_numpy().tolist()


def _entry(product: str | None, oid: str | None) -> tuple:
    return "-" if product is None else "+" + product, oid


def _bucket(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET)


def stock_fold_stream(commands: DataFrame) -> DataFrame:
    """Streaming K2–K5: stock command stream → result rows (append mode); start it by ``start_with_rocksdb``."""
    pair = F.xxhash64("product_id", "order_id").alias("pair")
    packed = commands.select(*COMMAND_COLS, pair, _bucket("product_id", STOCK_BUCKETS)).mapInArrow(_packed, f"{BUCKET} int, data binary")
    return (packed.groupBy(BUCKET).transformWithState(StockProcessor(), "data binary", "append", "none")
            .mapInArrow(_unpacked, STOCK_RESULT_DDL))


def _order_fn(key, pdfs, state):
    fold = OrderCommandFold()
    held = dict(zip(*state.get, strict=True)) if state.exists else {}
    rows = (row for pdf in pdfs for row in zip(*(pdf[c].tolist() for c in ORDER_COMMAND_COLS), strict=True))

    def results():
        for row in _in_order(rows, ORDER_COMMAND_COLS, ["seq", "ts"]):
            st = {"status": held.get(row["order_id"])}
            yield fold.step(st, row)
            held[row["order_id"]] = st["status"]

    yield from _frames(results(), fold.out_cols)
    known = {oid: status for oid, status in held.items() if status is not None}
    state.update((list(known), list(known.values())))


def order_command_stream(commands: DataFrame) -> DataFrame:
    """Streaming K10: order command stream → decision rows (append mode)."""
    return (commands.select(*ORDER_COMMAND_COLS, _bucket("order_id")).groupBy(BUCKET)
            .applyInPandasWithState(_order_fn, ORDER_COMMAND_RESULT_DDL, ORDER_STATE_DDL, "append",
                                    GroupStateTimeout.NoTimeout))
