"""Keyed result tables on plain parquet.

A keyed table is cut into partitions by its key: by a column of the key that follows time (hourly
metrics by day, so a batch touches the few days it has events of), else by a hash of the key. An upsert
reads the partitions that hold keys of the batch, merges the batch into them, and writes each as a new
version, ``bucket=B/batch_id=N``. Other partitions are neither read nor written, so what a batch costs
follows from the partitions it touches and not from the batches before it. Readers take the newest version
of each partition. The version before is kept until the one after it is written, so a batch that is retried
starts from what it started from (``before``), overwrites its own version and gives the same table (q15),
and no write ever replaces the only copy. Which versions exist is read from the folder names.

Where a MERGE-capable catalog table exists, ``DataFrame.mergeInto`` is the drop-in replacement.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_COL, BUCKET_COL = "batch_id", "bucket"
#: Partitions of a table that is cut by a hash of its key.
HASH_BUCKETS = 16

HOURLY_METRICS_SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("order_count", T.LongType()),
    T.StructField("total_revenue", T.DecimalType(29, 4)),
    T.StructField("avg_order_value", T.DoubleType()),
])
TOP_PRODUCTS_SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("total_quantity", T.LongType()),
    T.StructField("total_revenue", T.DecimalType(29, 4)),
])
HOURLY_KEYS = ["window_start", "window_end"]        # q4: both bounds
TOP_PRODUCT_KEYS = ["product_id", "window_start"]


class KeyedTable:
    def __init__(self, path: str, keys: list[str], schema: T.StructType, buckets: int = HASH_BUCKETS, day_of: str | None = None,
                 bucket_by: list[str] | None = None, keep: str | None = None):
        """``day_of``: the key column whose day is the partition; without one a hash of the keys (or of ``bucket_by``, some of
        them) is, modulo ``buckets``. ``keep``: a boolean column; rows where it is not true leave the table."""
        self.path, self.keys, self.schema = path.rstrip("/"), list(keys), schema
        self.buckets, self.day_of, self.bucket_by, self.keep = buckets, day_of, bucket_by or self.keys, keep

    def bucket(self) -> Column:
        if self.day_of:
            return F.coalesce(F.unix_date(F.to_date(self.day_of)), F.lit(-1)).cast("int")
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    def ensure(self, spark: SparkSession) -> None:
        """Create the table (empty, with its schema) if it does not exist."""
        try:
            spark.read.parquet(self.path).schema
        except AnalysisException:
            empty = spark.createDataFrame([], self.schema).withColumn(BUCKET_COL, F.lit(-1)).withColumn(BATCH_COL, F.lit(-1).cast("long"))
            empty.write.mode("ignore").parquet(f"{self.path}/{BUCKET_COL}=-1/{BATCH_COL}=-1")

    # -- versions

    def _fs(self, spark: SparkSession, path: str):
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _folders(self, spark: SparkSession, path: str, column: str) -> dict[int, str]:
        at, fs = self._fs(spark, path)
        if not fs.exists(at):
            return {}
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return {int(n.split("=", 1)[1]): f"{path}/{n}" for n in names if n.startswith(f"{column}=")}

    def versions(self, spark: SparkSession, only: set[int] | None = None) -> dict[int, dict[int, str]]:
        """{bucket: {batch: folder}}, of the buckets ``only`` if given."""
        buckets = self._folders(spark, self.path, BUCKET_COL)
        return {b: self._folders(spark, p, BATCH_COL) for b, p in buckets.items() if only is None or b in only}

    def _newest(self, spark: SparkSession, before: int | None, only: set[int] | None) -> list[str]:
        out = []
        for found in self.versions(spark, only).values():
            known = [n for n in found if before is None or n < before]
            if known:
                out.append(found[max(known)])
        return out

    def _load(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        return spark.read.schema(self.schema).parquet(*folders) if folders else spark.createDataFrame([], self.schema)

    def touched(self, batch: DataFrame) -> set[int]:
        """The buckets that hold keys of ``batch``: at most the table's partitions."""
        return {r[0] for r in batch.select(self.bucket().alias("b")).distinct().collect()}

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """Insert-or-update by key; idempotent per ``batch_id``. Where a batch holds a key twice, one of its rows is kept."""
        spark, n = batch.sparkSession, int(batch_id)
        rows = batch.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]).withColumn(BUCKET_COL, self.bucket())
        staged = f"{self.path}__staged/{BATCH_COL}={n}"
        rows.dropDuplicates(self.keys).write.mode("overwrite").parquet(staged)
        rows = spark.read.schema(rows.schema).parquet(staged)
        touched = {r[0] for r in rows.select(BUCKET_COL).distinct().collect()}
        if touched:
            held = self._load(spark, self._newest(spark, n, touched)).withColumn(BUCKET_COL, self.bucket())
            same = [held[k].eqNullSafe(rows[k]) for k in [BUCKET_COL, *self.keys]]
            merged = held.join(rows, same, "left_anti").unionByName(rows.where(self.keep) if self.keep else rows).withColumn(BATCH_COL, F.lit(n).cast("long"))
            if self.keep:
                self._empty(spark, touched, n)
            (merged.repartition(BUCKET_COL).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(BUCKET_COL, BATCH_COL).parquet(self.path))
            self._forget(spark, touched, n)
        at, fs = self._fs(spark, staged)
        fs.delete(at, True)

    def _empty(self, spark: SparkSession, touched: set[int], batch_id: int) -> None:
        """An empty version of each touched bucket, which stays where all of its rows leave the table."""
        for b in touched:
            at, fs = self._fs(spark, f"{self.path}/{BUCKET_COL}={b}/{BATCH_COL}={batch_id}")
            fs.delete(at, True)
            fs.mkdirs(at)

    def _forget(self, spark: SparkSession, touched: set[int], batch_id: int) -> None:
        """Delete the versions of touched buckets that neither readers nor a retry of this batch need."""
        for found in self.versions(spark, touched).values():
            older = sorted(n for n in found if n < batch_id)
            for n in older[:-1]:
                at, fs = self._fs(spark, found[n])
                fs.delete(at, True)

    def read(self, spark: SparkSession, before: int | None = None, only: DataFrame | None = None) -> DataFrame:
        """Current table (versions < ``before`` if given, so a retried batch never reads its own output);
        with ``only`` the partitions that hold its keys."""
        return self._load(spark, self._newest(spark, before, None if only is None else self.touched(only)))


def hourly_metrics_table(base: str) -> KeyedTable:
    return KeyedTable(f"{base.rstrip('/')}/hourly_metrics", HOURLY_KEYS, HOURLY_METRICS_SCHEMA, day_of="window_start")


def top_products_table(base: str) -> KeyedTable:
    return KeyedTable(f"{base.rstrip('/')}/top_products", TOP_PRODUCT_KEYS, TOP_PRODUCTS_SCHEMA, day_of="window_start")


def ensure_tables(spark: SparkSession, base: str) -> tuple[KeyedTable, KeyedTable]:
    """Both result tables, created if missing."""
    h, p = hourly_metrics_table(base), top_products_table(base)
    h.ensure(spark)
    p.ensure(spark)
    return h, p
