"""Markdown notes rendered from the relational tables, equal in Spark and in SQL.

For each order: a source note with a numbered section for each line item, and a rewritten note with frontmatter, where items whose
part key is divisible by seven are lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate", "l_discount", "l_tax")


#: What texts hang on; of line items that are equal in these, the others decide on nothing.
MOVED = ORDER[:6]


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, r): the line items of each order in their order, as numbers. Only these are moved and sorted; texts are written where they lie."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.struct(*MOVED).alias("x"))
    return li.repartition("k").groupBy("k").agg(F.sort_array(F.collect_list("x")).alias("r"))


def _text(c: Column, kind: str) -> Column:
    return c.cast(kind).cast("string")


def _src(x: Column, i: Column) -> Column:
    return F.concat(
        F.lit("## "), i + 1, F.lit(". part\n\nPart "), x["l_partkey"], F.lit(" was ordered "), _text(x["l_quantity"], "decimal(18,2)"), F.lit(" times at the price of "),
        _text(x["l_extendedprice"], "decimal(18,2)"), F.lit(" and was shipped on "), _text(x["l_shipdate"], "date"), F.lit(" by supplier "), x["l_suppkey"], F.lit(".\n"),
    )


def _note(x: Column, i: Column) -> Column:
    """Null for a lost item, which array_join leaves out."""
    text = F.concat(
        F.lit("### "), i + 1, F.lit(" · part\n\n| part | "), x["l_partkey"], F.lit(" |\n\nOrdered "), _text(x["l_quantity"], "decimal(18,2)"), F.lit(" times, price "),
        _text(x["l_extendedprice"], "decimal(18,2)"), F.lit(", see [[supplier_"), x["l_suppkey"], F.lit(".md#top|supplier]] and **Brand "), F.element_at(F.array(*[F.lit(b) for b in "ABCDE"]), (x["l_partkey"] % 5 + 1).cast("int")), F.lit(" Line**.\n"),
    )
    return F.when(x["l_partkey"] % 7 != 0, text)


FRONT = "---\ntitle: Order {k}\ntype: note\ntags: [order, part]\nconfidence: {c}\nnext: supplier_{n}.md#top\n---\n\n# Order {k}\n\nA summary of order {k}.\n\n"


def _filled(template: str) -> list:
    parts = {"{k}": F.col("k").cast("string"), "{c}": F.element_at(F.array(*[F.lit(x) for x in ("high", "low", "sure")]), (F.col("k") % 3 + 1).cast("int")), "{n}": (F.col("k") % 150).cast("string")}
    out, rest = [], template
    while rest:
        at = rest.find("{")
        if at < 0:
            out.append(F.lit(rest))
            break
        out += [F.lit(rest[:at]), parts[rest[at : at + 3]]]
        rest = rest[at + 3 :]
    return out


def file_of(k: Column) -> Column:
    return F.concat(F.lit("order_"), k, F.lit(".md"))


def src_of(k: Column, r: Column) -> Column:
    return F.concat(F.lit("# Order "), k, F.lit("\n\n"), F.array_join(F.transform(r, _src), "\n"))


def note_of(r: Column) -> Column:
    return F.concat(*_filled(FRONT), F.array_join(F.transform(r, _note), "\n"))


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, path, file, src, note): one row for each order."""
    k, r, file = F.col("k"), F.col("r"), file_of(F.col("k"))
    return rows(spark, sf_dir).select("k", F.concat(F.lit("notes/"), file).alias("path"), file.alias("file"), src_of(k, r).alias("src"), note_of(r).alias("note"))


SQL = r"""
WITH RECURSIVE it AS (SELECT l_orderkey AS k, l_partkey AS p, l_suppkey AS s, l_quantity::DECIMAL(18,2)::VARCHAR AS q,
    l_extendedprice::DECIMAL(18,2)::VARCHAR AS e, l_shipdate::DATE::VARCHAR AS d,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_discount, l_tax) AS rn
  FROM lineitem),
tx AS (SELECT k, rn, p,
    '## ' || rn || '. part' || chr(10) || chr(10) || 'Part ' || p || ' was ordered ' || q || ' times at the price of ' || e || ' and was shipped on ' || d || ' by supplier ' || s || '.' || chr(10) AS src,
    '### ' || rn || ' · part' || chr(10) || chr(10) || '| part | ' || p || ' |' || chr(10) || chr(10) || 'Ordered ' || q || ' times, price ' || e || ', see [[supplier_' || s || '.md#top|supplier]] and **Brand '
      || ['A','B','C','D','E'][p % 5 + 1] || ' Line**.' || chr(10) AS note FROM it),
n AS (SELECT k, 'order_' || k || '.md' AS file,
    '# Order ' || k || chr(10) || chr(10) || string_agg(src, chr(10) ORDER BY rn) AS src,
    '---' || chr(10) || 'title: Order ' || k || chr(10) || 'type: note' || chr(10) || 'tags: [order, part]' || chr(10) || 'confidence: ' || ['high','low','sure'][k % 3 + 1] || chr(10)
      || 'next: supplier_' || (k % 150) || '.md#top' || chr(10) || '---' || chr(10) || chr(10) || '# Order ' || k || chr(10) || chr(10) || 'A summary of order ' || k || '.' || chr(10) || chr(10)
      || coalesce(string_agg(note, chr(10) ORDER BY rn) FILTER (WHERE p % 7 <> 0), '') AS note FROM tx GROUP BY k)
"""
