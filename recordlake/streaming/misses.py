"""Runs of misses as files arrive, in whatever order: state by series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What RocksDB, which holds the state, needs to be told of.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
STATUS = "series string, steps int, hits int, stop int, misses int"


def miss_status(files: DataFrame, threshold: int) -> DataFrame:
    """A stream's (series, step, hit) as a stream of what each series has come to: steps, hits, stop (the step at which the first run of threshold misses ends it, or null) and the misses up to there.

    Rows come in any order, and again: hit says that a file is linked, a row without a hit that a step is expected, and
    so are all before it. A later row tells of the series as it is then. The state of a series is the last step expected
    so far and the steps that were hit, which Spark's own aggregation keeps; no Python handles a series.
    """
    rows = files.filter("series IS NOT NULL AND step IS NOT NULL").select("series", F.col("step").cast("int").alias("step"), F.coalesce("hit", F.lit(False)).alias("hit"))
    known = rows.groupBy("series").agg(F.max("step").alias("last"), F.array_sort(F.collect_set(F.when(F.col("hit") & (F.col("step") >= 0), F.col("step")))).alias("_hits"))
    # what lies between a hit and the next one, or the ends, is a run of misses
    between = F.zip_with(F.concat(F.array(F.lit(-1)), "_hits"), F.concat("_hits", F.array(F.col("last") + 1)), lambda a, b: F.struct((a + 1).alias("a"), (b - 1).alias("b")))
    runs = known.withColumn("_runs", F.filter(between, lambda r: r["a"] <= r["b"]))
    long = F.get(F.filter("_runs", lambda r: r["b"] - r["a"] + 1 >= threshold), F.lit(0))
    at = runs.withColumn("stop", long["a"] + threshold - 1).withColumn("_end", F.coalesce("stop", "last"))
    own = F.get(F.filter("_runs", lambda r: (r["a"] <= F.col("_end")) & (F.col("_end") <= r["b"])), F.lit(0))
    misses = F.coalesce(F.col("_end") - own["a"] + 1, F.lit(0)).alias("misses")
    return at.select("series", (F.col("last") + 1).alias("steps"), F.size("_hits").alias("hits"), "stop", misses)


def run_miss_status(files: DataFrame, threshold: int, target: str, checkpoint: str) -> None:
    """Keep miss_status() of what has arrived since the last run in a table; newest_status() reads it."""
    spark = files.sparkSession
    before = spark.conf.get(PROVIDER[0], None)
    spark.conf.set(*PROVIDER)
    try:

        def put(rows: DataFrame, batch_id: int) -> None:
            rows.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")  # a micro-batch that runs again writes the same

        query = miss_status(files, threshold).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER[0])
        else:
            spark.conf.set(PROVIDER[0], before)


def newest_status(rows: DataFrame) -> DataFrame:
    """The last that was told of each series; rows have the column batch."""
    cols = [c.split()[0] for c in STATUS.split(", ")[1:]]
    return rows.groupBy("series").agg(F.max_by(F.struct(*cols), "batch").alias("s")).select("series", "s.*")
