"""Packing into length buckets that minimise padding, with token-budget batches.

The histogram of text lengths, a row for each length that occurs, is aggregated over the whole corpus; its size follows the range of
lengths and not the number of documents (d different lengths need d * d / 2 words).  Dynamic programming over the histogram chooses the bucket
boundaries of least total padding; best former boundaries only move up with the length, so each bucket takes n log n steps, done with numpy for a
whole level at a time.
Documents of a bucket are numbered in parts: a hash deals each bucket to parts of about ``part_rows``
rows, the few part sizes give each part its offset, and rows are numbered inside their part; so no bucket is
sorted in one task.  A batch is ``budget // boundary`` consecutive numbers of a bucket, at least one.

Defined results: a null or empty text has length 0 and is packed like any other (no padding if its bucket's boundary is 0); a very long text,
longer than the budget, is a batch of its own with boundary tokens; of several best choices of boundaries the one with the smallest
former boundaries is taken; repeated rows are packed separately; an empty table gives no rows.
A column that is named like a result is replaced by it.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewarden.llm.common import cut, space_words

BUCKETS = 16
BUDGET = 8192
PART_ROWS = 20_000


def length_words(text: Column) -> Column:
    return F.size(space_words(text)).cast("bigint")


def boundaries(lengths: np.ndarray, count: np.ndarray, buckets: int) -> tuple[list[int], int]:
    """Bucket boundaries (ascending) of least padding, and that padding, for ascending lengths with their numbers of texts."""
    n = len(lengths)
    if not n:
        return [], 0
    lengths = lengths.astype(np.int64)
    c = np.concatenate(([0], np.cumsum(count, dtype=np.int64)))
    s = np.concatenate(([0], np.cumsum(count * lengths, dtype=np.int64)))
    best, back = c[1:] * lengths - s[1:], [np.zeros(n, np.int64)]  # of the first j + 1 lengths in one bucket
    for _ in range(min(buckets, n) - 1):
        best, split = _one_more(best, lengths, c, s)
        back.append(split)
    out, j = [], n
    for split in reversed(back):
        if j:
            out.append(int(lengths[j - 1]))
            j = int(split[j - 1])
    return sorted(out), int(best[-1])


def _one_more(best: np.ndarray, lengths: np.ndarray, c: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least padding of the first j + 1 lengths with one more bucket, and how many lengths lie before the last bucket.

    Middles of ranges are solved level by level; each looks only between the solutions beside its range."""
    n = len(best)
    now, split = np.empty(n, np.int64), np.zeros(n, np.int64)
    before = np.concatenate(([0], best))  # padding of the first i lengths
    lo, hi, low, high = (np.array([x]) for x in (0, n, 0, n - 1))  # ranges of j, and of their splits
    while len(lo):
        mid = (lo + hi) // 2
        top = np.minimum(high, mid)
        width = top - low + 1
        first = np.concatenate(([0], np.cumsum(width)[:-1]))
        j = np.repeat(mid, width)
        i = np.arange(width.sum()) - np.repeat(first - low, width)
        cost = before[i] + (c[j + 1] - c[i]) * lengths[j] - (s[j + 1] - s[i])
        least = np.minimum.reduceat(cost, first)
        at = np.flatnonzero(cost == np.repeat(least, width))
        found = i[at[np.searchsorted(at, first)]]
        now[mid], split[mid] = least, found
        lo, hi, low, high = np.concatenate((lo, mid + 1)), np.concatenate((mid, hi)), np.concatenate((low, found)), np.concatenate((found, high))
        left = lo < hi
        lo, hi, low, high = lo[left], hi[left], low[left], high[left]
        order = np.argsort(lo)
        lo, hi, low, high = lo[order], hi[order], low[order], high[order]
    return now, split


def pack(documents: DataFrame, length: Column, order: str = "doc_id", buckets: int = BUCKETS, budget: int = BUDGET, part_rows: int = PART_ROWS) -> DataFrame:
    """Adds n_tokens, bucket (from 0), bucket_len, batch (from 0 in its bucket), slot (from 0 in its batch) and padding.

    documents should hold what packing has to carry along, such as ids, not texts: the table is checkpointed once."""
    df = cut(documents.withColumn("n_tokens", length))  # read twice below, and its partitions salt the parts
    hist = df.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()  # bounded by the range of lengths
    tops, counts = (np.array(x, np.int64) for x in zip(*sorted((r.n_tokens, r.n) for r in hist), strict=True)) if hist else (np.empty(0, np.int64),) * 2
    bounds, _ = boundaries(tops, counts, buckets)
    parts = max(1, math.ceil(counts.sum() / part_rows))
    bucket = F.lit(len(bounds))
    for k in range(len(bounds) - 1, -1, -1):
        bucket = F.when(F.col("n_tokens") <= bounds[k], F.lit(k)).otherwise(bucket)
    bound = F.element_at(F.array(*[F.lit(b).cast("bigint") for b in bounds or [0]]), F.col("bucket") + 1)
    df = df.withColumn("bucket", bucket).withColumn("bucket_len", bound)
    # the partition is a salt for an id that is repeated without end
    df = df.withColumn("__part", F.pmod(F.xxhash64(F.col(order), F.spark_partition_id()), F.lit(parts)).cast("int"))
    return _numbered(df, order, budget)


def _numbered(df: DataFrame, order: str, budget: int) -> DataFrame:
    from pyspark.sql import Window

    sizes = df.groupBy("bucket", "__part").agg(F.count("*").alias("n"))
    # one row for each bucket and part: a running sum over at most rows / part_rows numbers of a bucket
    before = F.sum("n").over(Window.partitionBy("bucket").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("bucket", "__part", F.coalesce(before, F.lit(0)).alias("__before"))
    at = F.row_number().over(Window.partitionBy("bucket", "__part").orderBy(F.col(order).asc_nulls_first(), "n_tokens")) - 1
    df = df.withColumn("__at", at).join(sizes, ["bucket", "__part"])
    number = F.col("__at") + F.col("__before")
    per = F.greatest(F.expr(f"{budget} div greatest(bucket_len, 1)"), F.lit(1).cast("bigint"))
    return df.withColumns(
        {"batch": F.floor(number / per).cast("bigint"), "slot": (number % per).cast("bigint"), "padding": F.col("bucket_len") - F.col("n_tokens")}
    ).drop("__at", "__before", "__part")


def op7(documents: DataFrame) -> DataFrame:
    out = pack(documents.select("doc_id", length_words(F.col("text")).alias("__len")), F.col("__len"))
    return out.select("doc_id", "n_tokens", "bucket", "bucket_len", "batch", "slot", "padding")
