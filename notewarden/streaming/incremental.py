"""Processing only what changed.

A streaming file source never sees a file again that was rewritten, so changes are found by a state table
(path, mtime) and an anti-join; new files can also come from an availableNow stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATE = "path string, mtime timestamp, ok boolean"


def state(spark: SparkSession, state_path: str) -> DataFrame:
    """The newest state of each path; empty before the first run."""
    try:
        runs = spark.read.schema(f"{STATE}, run bigint").parquet(state_path)
        runs.isEmpty()
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], STATE)
    return runs.groupBy("path").agg(F.max_by(F.struct("mtime", "ok"), "run").alias("x")).select("path", "x.mtime", "x.ok")


def changed(notes: DataFrame, known: DataFrame) -> DataFrame:
    """Notes whose modification time, in whole seconds, is not that of a successful run."""
    done = known.where("ok").select("path", F.unix_seconds("mtime").alias("__sec"))
    return notes.withColumn("__sec", F.unix_seconds("mtime")).join(done, ["path", "__sec"], "left_anti").drop("__sec")


def process(spark: SparkSession, notes: DataFrame, state_path: str, work: Callable[[DataFrame], DataFrame], out_path: str) -> int:
    """Works on the changed notes, appends the result and then the state; returns how many notes were processed.

    work returns rows with path and, if it can fail for a note, ok."""
    known = state(spark, state_path)
    todo = changed(notes, known)
    run = (spark.read.parquet(state_path).agg(F.max("run")).first()[0] or 0) + 1 if not known.isEmpty() else 1
    result = work(todo)
    if "ok" not in result.columns:
        result = result.withColumn("ok", F.lit(True))
    target = f"{out_path}/run={run}"
    result.write.mode("overwrite").parquet(target)
    done = spark.read.parquet(target).groupBy("path").agg(F.bool_and("ok").alias("ok"))
    new = todo.select("path", "mtime").distinct().join(done, "path").select("path", "mtime", "ok", F.lit(run).cast("bigint").alias("run"))
    new.write.mode("append").parquet(state_path)
    return spark.read.parquet(state_path).where(F.col("run") == run).count()


def new_files(spark: SparkSession, root: str, checkpoint: str, sink: Callable[[DataFrame, int], None]) -> None:
    """Hands files not seen before to sink, once, and returns when all are done."""
    source = spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.[mM][dD]").schema("value string").load(root)
    rows = source.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("mtime"), F.col("value").alias("text"))
    query = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
