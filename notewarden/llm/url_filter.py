"""URL filters by host-suffix and path-prefix expressions.

Each URL is expanded into every host suffix crossed with its path prefixes of the lengths that rules
have.  Expressions are joined to the rules on a short prefix of their SHA-256, the full digest then
confirms a match, and the longest rule decides.  Everything is built-in column work: one narrow
expansion, a join whose rule side is broadcast only below ``broadcast_rules`` rows, and one
aggregation on a unique row number, so no host is a hot key.  Above that size URLs meet rules by (short hash,
salt), where each rule stands once for each of ``SALTS`` salts, so an expression that every URL has (``com/``) is spread over as many tasks.

Defined results: very long URLs are expanded to the lengths that rules have only; an empty table gives no rows; a null URL or one without ``://`` has an empty host and path and no rule; without a
rule the verdict is ``default``, and ``hostless`` where the host is empty; rules of equal length are
ordered by host, then path, the greatest first; null rules fit nothing; repeated rows stay
repeated; other columns pass through, also where they are named like the helper columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewarden.llm.common import cut, lower_ascii

#: (host, path, verdict)
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
PREFIX_HEX = 8
BROADCAST_RULES = 100_000
SALTS = 32


def host_of(url: Column) -> Column:
    u = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(u, r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    u = F.coalesce(url, F.lit(""))
    return F.regexp_extract(u, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def url_verdicts(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = "allow",
    hostless: str = "block",
    prefix_hex: int = PREFIX_HEX,
    broadcast_rules: int = BROADCAST_RULES,
) -> DataFrame:
    """Adds host, path, rule and verdict to pages; rules has host, path and verdict."""
    ranked = (
        rules.where("host is not null and path is not null and verdict is not null")
        .groupBy("host", "path")
        .agg(F.min("verdict").alias("verdict"))
        .orderBy(F.length(F.concat("host", "path")), "host", "path")
        .select(
            F.monotonically_increasing_id().alias("__rank"),
            F.concat("host", "path").alias("rule"),
            F.col("verdict").alias("__verdict"),
            F.length("path").alias("__len"),
            _digest(F.col("host"), F.col("path")).alias("__full"),
        )
        .withColumn("__short", F.substring("__full", 1, prefix_hex))
    )
    ranked = cut(ranked)
    n = ranked.agg(F.count("*").alias("n"), F.sort_array(F.collect_set("__len")).alias("l")).first()
    lengths = F.array(*[F.lit(x) for x in n.l]) if n.l else F.array().cast("array<int>")
    met_by = ["__short"]
    index = ranked.select("__short", "__full", "__rank")
    if n.n <= broadcast_rules:
        index, ranked = F.broadcast(index), F.broadcast(ranked)
    else:
        index, met_by = index.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["__short", "__salt"]

    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    base = pages.select(*[F.col(f"`{c}`").alias(f"__own{i}") for i, c in enumerate(own)], host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    base = base.withColumn("__id", F.monotonically_increasing_id())
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    paths = F.transform(F.filter(lengths, lambda k: k <= F.length("path")), lambda k: F.substring(F.col("path"), F.lit(1), k))
    digests = F.flatten(F.transform(suffixes, lambda h: F.transform(paths, lambda p: _digest(h, p))))
    asked = base.withColumn("__asked", F.explode_outer(digests))  # rows without an expression keep one null
    asked = asked.withColumn("__short", F.substring("__asked", 1, prefix_hex))
    asked = asked.withColumn("__salt", (F.col("__id") % SALTS).cast("int"))
    met = asked.join(index, met_by, "left")
    # the rows of one URL lie together in one task, so the partial aggregate leaves one row for each URL
    best = F.max(F.when(F.col("__asked") == F.col("__full"), F.col("__rank"))).alias("__rank")
    one = met.groupBy(*base.columns).agg(best).join(ranked.select("__rank", "rule", "__verdict"), "__rank", "left")
    return one.select(
        *[F.col(f"__own{i}").alias(c) for i, c in enumerate(own)],
        "host",
        "path",
        "rule",
        F.coalesce("__verdict", F.when(F.col("host") == "", F.lit(hostless)).otherwise(F.lit(default))).alias("verdict"),
    )


def op4(pages: DataFrame) -> DataFrame:
    rules = pages.sparkSession.createDataFrame(RULES, "host string, path string, verdict string")
    return url_verdicts(pages.select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


SQL = r"""
WITH p AS (SELECT row_number() OVER () AS r, page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules(rh, rp, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
m AS (SELECT r, rh || rp AS rule, v, row_number() OVER (PARTITION BY r ORDER BY length(rh || rp) DESC, rh DESC, rp DESC) AS k
  FROM p JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN host = '' THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN (SELECT * FROM m WHERE k = 1) USING (r)
"""
