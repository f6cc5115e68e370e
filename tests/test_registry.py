"""Every registered document query against its SQL on the smallest tables, and independence of partitioning."""

import pytest
from oracle import SF, same
from pyspark.sql import functions as F

from notewarden.operators import segment
from notewarden.plans import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle(spark, name):
    assert same(spark, registry.queries()[name], registry.oracle_sql()[name]) > 0


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_rows(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0


def test_partitioning_does_not_matter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id").alias("doc"), "text")
    one, many = (segment.chunks(docs.repartition(n), max_chars=500) for n in (1, 13))
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_chunks_cover_the_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id").alias("doc"), "text")
    squeezed = lambda c: F.regexp_replace(c, r"\s", "")
    whole = docs.select("doc", squeezed("text").alias("a"))
    parts = segment.chunks(docs, max_chars=700, overlap_chars=0)
    joined = parts.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("ord", "text"))).alias("p"))
    joined = joined.select("doc", squeezed(F.array_join(F.transform("p", lambda x: x["text"]), "")).alias("b"))
    assert whole.join(joined, "doc").where("a <> b").count() == 0
