"""Document quality and corpus analytics on PySpark."""

from __future__ import annotations

import functools
from pathlib import Path


#: Bytes that a Python worker gets at once, where the session leaves Spark's default of 64 MB.
BATCH, DEFAULT, BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", str(4 << 20)


def prepare(spark) -> None:
    """Bounds the batches of Python workers, whose rows may be long texts, and lets the workers import this package from
    where the driver has it, unless it is installed there."""
    if spark.conf.get(BATCH, DEFAULT) == DEFAULT:
        spark.conf.set(BATCH, BYTES)
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parent.parent)
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        env["PYTHONPATH"] = ":".join([*paths, root])


def prepared(query):
    """The query, on a prepared session."""

    @functools.wraps(query)
    def run(spark, *args):
        prepare(spark)
        return query(spark, *args)

    return run
