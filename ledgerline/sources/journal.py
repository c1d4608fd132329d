"""An event log that is written with positions, read on from a stored position, and audited.

The log has one row per event with its aggregate (``order_id``), the event's number in the aggregate
(``seq``, from 0, without holes) and a global ``position``. A consumer keeps, under a folder of its own, the
position it has read to, the highest ``seq`` per aggregate up to there, and what was wrong:

* ``gap``: the event's number is not the one after the highest before it; ``from_seq`` to ``to_seq`` are missing,
* ``repeat``: its number is not above the highest before it,
* ``unnumbered``: it has none.

Events are compared with the ones before them by position, also across runs. The rows are sorted by
(aggregate, position) over range partitions, and the highest number before a row is the local running
maximum and the maximum of the partitions before, so an aggregate with a third of all events is read by
many tasks. Events without an aggregate are one aggregate of their own; an empty log gives no findings.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.session import scratch_path
from ledgerline.sources.sinks import KeyedTable

FINDINGS_DDL = "order_id string, position long, seq long, finding string, from_seq long, to_seq long"
_MARKS = T.StructType([T.StructField("order_id", T.StringType()), T.StructField("last_seq", T.LongType())])


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _ranged(df: DataFrame, *order: str) -> DataFrame:
    """``df`` over range partitions in ``order``, written, with the partition as ``_part``."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "journal-ranges")
    ranged = df.repartitionByRange(_partitions(df), *order).withColumn("_part", F.spark_partition_id())
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)


def write_journal(events: DataFrame, path: str, *order: str) -> None:
    """Write ``events`` as a log: ``position`` counts from 0 in ``order`` (which should tell events apart)."""
    rows = _ranged(events, *order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)         # one row a range partition
    firsts = rows.groupBy("_part").agg(F.count("*").alias("n")).select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    numbered = rows.withColumn("_local", local).join(firsts, "_part")
    (numbered.withColumn("position", (F.col("_first") + F.col("_local")).cast("long"))
     .select(*events.columns, "position").write.parquet(path))


def read_journal(spark: SparkSession, path: str, after: int | None = None, upto: int | None = None) -> DataFrame:
    """The log's rows with ``after`` < position <= ``upto``; the bounds reach the scan."""
    log = spark.read.parquet(path)
    if after is not None:
        log = log.where(F.col("position") > after)
    return log if upto is None else log.where(F.col("position") <= upto)


def audit_journal(rows: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """Gaps, repeats and unnumbered events of ``rows``; ``marks`` (order_id, last_seq) is what came before them."""
    part = _ranged(rows.select("order_id", "position", "seq"), "order_id", "position")
    earlier = Window.partitionBy("order_id", "_part").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    parts_before = Window.partitionBy("order_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    highs = part.groupBy("order_id", "_part").agg(F.max("seq").alias("_high")).withColumn("_before", F.max("_high").over(parts_before))
    if marks is None:
        highs = highs.withColumn("last_seq", F.lit(None).cast("long"))
    else:
        m = marks.select(F.col("order_id").alias("_of"), "last_seq")
        highs = highs.join(m, F.col("order_id").eqNullSafe(F.col("_of")), "left")
    highs = highs.select(F.col("order_id").alias("_of"), F.col("_part").alias("_in"), "_before", "last_seq")
    on = F.col("order_id").eqNullSafe(F.col("_of")) & (F.col("_part") == F.col("_in"))
    high: Column = F.coalesce(F.greatest("_local", "_before", "last_seq"), F.lit(-1))
    seq = F.col("seq")
    found = part.withColumn("_local", F.max("seq").over(earlier)).join(highs, on).withColumn("_seen", high)
    what = (F.when(seq.isNull(), "unnumbered").when(seq <= F.col("_seen"), "repeat").when(seq > F.col("_seen") + 1, "gap"))
    missing = F.col("finding") == "gap"
    return (found.withColumn("finding", what).where("finding IS NOT NULL")
            .select("order_id", "position", "seq", "finding", F.when(missing, F.col("_seen") + 1).alias("from_seq"),
                    F.when(missing, seq - 1).alias("to_seq")))


class JournalConsumer:
    """Reads a log run by run: each run starts behind the last one's end and is audited against all before it."""

    def __init__(self, spark: SparkSession, path: str, base: str):
        self.spark, self.path, self.base = spark, path, base.rstrip("/")
        self.marks = KeyedTable(f"{self.base}/marks", ["order_id"], _MARKS)

    def position(self) -> int | None:
        """The position read to; None before the first run."""
        try:
            return self.spark.read.schema("upto long").parquet(f"{self.base}/read").agg(F.max("upto")).first()[0]
        except AnalysisException:
            return None

    def run(self, upto: int | None = None) -> DataFrame | None:
        """Audit and return the rows behind the stored position (up to ``upto``); None if there are none.

        The position is written last, so a run that was lost is done anew and overwrites what it had written.
        """
        after = self.position()
        rows = read_journal(self.spark, self.path, after, upto)
        end = rows.agg(F.max("position")).first()[0]
        if end is None:
            return None
        rows = read_journal(self.spark, self.path, after, end)
        run = -1 if after is None else after
        seen = self.marks.read(self.spark, before=run + 1)
        audit_journal(rows, seen).write.mode("overwrite").parquet(f"{self.base}/findings/after={run}")
        new = rows.groupBy("order_id").agg(F.max("seq").alias("new_seq"))
        both = new.join(seen.withColumnRenamed("order_id", "_of"), F.col("order_id").eqNullSafe(F.col("_of")), "left")
        self.marks.upsert(both.select("order_id", F.greatest("new_seq", "last_seq").alias("last_seq")), run + 1)
        self.spark.range(1).select(F.lit(end).cast("long").alias("upto")).write.mode("overwrite").parquet(f"{self.base}/read/after={run}")
        return rows

    def findings(self) -> DataFrame:
        try:
            return self.spark.read.schema(FINDINGS_DDL).parquet(f"{self.base}/findings").select(*(c.split()[0] for c in FINDINGS_DDL.split(", ")))
        except AnalysisException:
            return self.spark.createDataFrame([], FINDINGS_DDL)
