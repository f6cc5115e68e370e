"""Search by an index of words and their letter groups, so that a query reads its postings and the texts of the best candidates only.

For each word of a text (a run of letters that a query is not split at) the index holds in how many lines it stands.  A query's word lies within a word of a line, so the
lines of the words that hold it bound the lines with it, and the sum over the query's words bounds a text's score.  The words that hold a query's word are found by its groups of
one to three letters, which are kept for each distinct word only.  Texts are scored in the order of their bounds: after a first few, only those whose bound reaches the k-th best
score are read, and the result is that of a scan.  Groups and postings are dealt to folders by their group or word, texts by their path: all are pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewarden.functions import text as T
from notewarden.operators.corpus import _top, relevance
from notewarden.tables import cut

GRAM = 3
BUCKETS = 64
#: What queries are not split at.
WORD = T.QUERY_SPLIT.replace("[", "[^", 1)
#: Texts that are scored first, for each row of the result.
FIRST = 4


def _bucket(c) -> F.Column:
    return F.pmod(F.xxhash64(c), F.lit(BUCKETS)).cast("int")


def build(notes: DataFrame, index: str, file: str = "file", text: str = "text", order: str = "path") -> None:
    """Writes the index of notes (file, path, text) to a folder; paths name notes."""
    own = notes.where(T.text(F.col(text)) != "").select(F.col(file).cast("string").alias("file"), F.col(order).cast("string").alias("path"), F.col(order).alias("key"), F.col(text).alias("text"))
    own.withColumn("bucket", _bucket(F.col("path"))).repartition("bucket").write.partitionBy("bucket").parquet(f"{index}/texts")
    words = F.flatten(F.transform(T.lines(F.col("text")), lambda x: F.array_distinct(T.all_matches(F.lower(T.strip(x)), WORD))))
    postings = own.select("path", F.explode(words).alias("token")).groupBy("token", "path").agg(F.count("*").cast("int").alias("lines")).withColumn("bucket", _bucket(F.col("token")))
    # ranges of paths part the postings of a frequent word
    postings.repartitionByRange("bucket", "token", "path").sortWithinPartitions("bucket", "token").write.partitionBy("bucket").parquet(f"{index}/postings")
    tokens = notes.sparkSession.read.schema("token string").parquet(f"{index}/postings").select("token").distinct()
    groups = lambda n: F.when(F.length("token") >= n, F.transform(F.sequence(F.lit(1), F.length("token") - n + 1), lambda i: F.substring(F.col("token"), i, F.lit(n)))).otherwise(T.texts())
    grams = tokens.select("token", F.explode(F.array_distinct(F.flatten(F.array(*[groups(n) for n in range(1, GRAM + 1)])))).alias("gram")).withColumn("bucket", _bucket(F.col("gram")))
    # ranges of words part the words of a frequent group
    grams.repartitionByRange("bucket", "gram", "token").sortWithinPartitions("bucket", "gram").write.partitionBy("bucket").parquet(f"{index}/words")


def words_of(spark: SparkSession, query: str) -> list[str]:
    return spark.range(1).select(T.query_words(F.lit(query)).alias("w")).first().w


def bounds(spark: SparkSession, index: str, words: list[str]) -> DataFrame:
    """(path, bound): texts that may hold a word, with the most their score can be."""
    needs = sorted({(w, g) for w in words for g in ({w} if len(w) <= GRAM else {w[i : i + GRAM] for i in range(len(w) - GRAM + 1)})})
    asked = spark.createDataFrame(needs or [("", "")], "word string, gram string")  # of the query
    grams = sorted({g for _, g in needs})
    places = [r.b for r in spark.createDataFrame([(g,) for g in grams] or [("",)], "g string").select(_bucket(F.col("g")).alias("b")).distinct().collect()]
    found = spark.read.schema("token string, gram string, bucket int").parquet(f"{index}/words").where(F.col("bucket").isin(places) & F.col("gram").isin(grams))
    by_word = found.join(F.broadcast(asked), "gram").groupBy("token", "word").agg(F.count("*").alias("n"))
    whole = asked.groupBy("word").agg(F.count("*").alias("n"))
    holding = by_word.join(F.broadcast(whole), ["word", "n"]).where(F.contains("token", F.col("word"))).select("token", "word", _bucket(F.col("token")).alias("bucket"))
    holding = cut(holding)
    places = [r.bucket for r in holding.select("bucket").distinct().collect()]  # as many as there are folders at most
    postings = spark.read.schema("token string, path string, lines int, bucket int").parquet(f"{index}/postings").where(F.col("bucket").isin(places))
    return postings.join(holding, ["bucket", "token"]).groupBy("path").agg(F.sum("lines").alias("bound"))


def search(spark: SparkSession, index: str, query: str, top_k: int = 5) -> DataFrame:
    """(file, score, hits) as corpus.search gives them."""
    top_k = max(1, top_k)
    texts = spark.read.parquet(f"{index}/texts")
    candidates = cut(bounds(spark, index, words_of(spark, query)).withColumn("bucket", _bucket(F.col("path"))))
    scored = lambda some: texts.join(F.broadcast(some) if some is first else some, ["bucket", "path"], "left_semi").select("file", F.col("key").alias("path"), relevance(F.col("text"), query).alias("x"))
    first = candidates.orderBy(F.desc("bound"), "path").limit(FIRST * top_k)  # a few rows
    reached = scored(first).orderBy(F.desc("x.score")).limit(top_k).agg(F.count("*").alias("n"), F.min("x.score").alias("least")).first()
    least = reached.least if reached.n == top_k else 1
    return _top(scored(candidates.where(F.col("bound") >= least)), top_k)
