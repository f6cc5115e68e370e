"""Quality rules whose cutoffs are chosen under a bound on false rejection.

Whole-text statistics are built-in column work, one narrow projection.  Each rule turns them into an
integer level: 0 for what prose shows, ``LEVELS`` for the extreme.  A document's severity is its highest level, and a
cutoff c rejects every document of severity c or above, so the risk that is controlled is that of all rules together.

For every stratum (a language), the labelled good documents are the holdout: with k of n good documents rejected, a
cutoff is admitted if the exact binomial probability of k or fewer at rejection rate alpha is at most ``delta``
divided by the number of strata (the correction for multiple tests), which is the exact (Clopper-Pearson) upper bound lying at or below
alpha.  Rejections only grow as the cutoff falls, so the cutoffs of a stratum are tested in that fixed order and need no further
correction.  The lowest admitted cutoff is taken.  So with probability 1 - delta every stratum falsely rejects at most its alpha of the good documents.

alpha is the target ``ALPHA`` where a stratum has labels enough to certify it, else the smallest per mille that its number of labels
can certify, up to ``MAX_ALPHA``; beyond that (fewer than 86 labels in four strata) no bound can be given and the rules reject nothing there.  It follows from the
number of labels alone, not from what they show, so the bound stays exact.

With ``pooled``, the cutoff over all strata together is tested too (which counts in the correction), and strata with too
few labels use it: its bound holds for their mixture, not for each.  The registered query does without.

All labelled documents count.  Counts are pre-aggregated to (stratum, level), so their size does
not follow the input and a hot stratum is no hot task; the cutoff table is broadcast
only after its size was checked.

Defined results: a null or empty text has zero statistics and fails the base rule (fewer than 10 words); very long texts are
measured whole; a null stratum value is the stratum ``und``; documents without label are judged, never learnt from;
repeated documents and labels all count; a severity equal to the cutoff is rejected; without labels only the base rule rejects; an empty table gives
no rows; columns of documents other than id, text and stratum are not read, so none can clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewarden.llm.common import SPACE_CHARS, cut, space_words

SYMBOLS = "#*$%&|<>"
LEVELS = 100
ALPHA = 0.005
MAX_ALPHA = 0.05
DELTA = 0.05
BROADCAST_CUTOFFS = 100_000
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: rule: level as SQL over the statistics, each an integer quotient that both engines divide alike.
RULES = {
    "symbols": "least((100 * n_symbols) div greatest(n_words, 1), 100)",
    "dup_lines": "least((400 * n_dup_lines) div greatest(n_words, 1), 100)",
    "repeats": "least((100 * n_repeat_words) div greatest(n_words, 1), 100)",
    "long_words": "least((10 * greatest(word_chars - 8 * n_words, 0)) div greatest(n_words, 1), 100)",
    "short_words": "least((40 * greatest(3 * n_words - word_chars, 0)) div greatest(n_words, 1), 100)",
}


def statistics(documents: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of whole texts."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = documents.withColumn("__words", space_words(F.col(text)))
    df = df.withColumn("__lines", F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != ""))
    words, n = F.col("__words"), F.size("__words")
    window = lambda i: F.xxhash64(*[words[i + j] for j in range(5)])
    df = df.withColumn("__grams", F.when(n >= 5, F.transform(F.sequence(F.lit(0), n - 5), window)).otherwise(F.array().cast("array<bigint>")))
    grams = F.col("__grams")
    df = df.withColumn("__twice", F.size(F.array_distinct(grams)) < F.size(grams))
    # only texts with a repeated window pay for a sort of (window, place)
    placed = F.when(F.col("__twice"), F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.withColumn("__placed", placed)
    p = F.col("__placed")
    last = F.size(p) - 1
    again = F.filter(
        F.sequence(F.lit(0), last),
        lambda k: ((k > 0) & (p[F.greatest(k - 1, F.lit(0))]["h"] == p[k]["h"])) | ((k < last) & (p[F.least(k + 1, last)]["h"] == p[k]["h"])),
    )
    df = df.withColumn("__at", F.when(F.col("__twice"), F.sort_array(F.transform(again, lambda k: p[k]["i"]))))
    covered = F.aggregate(
        "__at",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, i: F.struct((s["n"] + i + 5 - F.greatest(i, s["end"])).alias("n"), (i + 5).alias("end")),
        lambda s: s["n"],
    )
    return df.withColumns(
        {
            "n_words": n.cast("bigint"),
            "word_chars": F.length(F.translate(t, SPACE_CHARS, "")).cast("bigint"),
            "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("bigint"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"),
            "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("bigint"),
        }
    ).drop("__words", "__lines", "__grams", "__twice", "__placed", "__at")


def certified_alpha(n: Column, level: Column, alpha: float = ALPHA) -> Column:
    """The smallest rejection rate that n good documents, none of them rejected, certify at the level; in per mille, at least alpha."""
    return F.greatest(F.lit(alpha), F.ceil(1000 * (1 - F.pow(level, 1 / n))) / 1000)


def most_rejected(n: Column, alpha: Column, level: Column) -> Column:
    """The largest k with P(Bin(n, alpha) <= k) <= level, -1 if there is none; exact, summed in logarithms."""
    odds = F.log(alpha / (1 - alpha))

    def step(s: Column, k: Column) -> Column:
        term = s["term"] + F.log(n - k + 1) - F.log(k.cast("double")) + odds
        total = F.greatest(s["total"], term) + F.log1p(F.exp(-F.abs(s["total"] - term)))
        return F.struct(term.alias("term"), total.alias("total"), F.when(total <= F.log(level), k).otherwise(s["k"]).alias("k"))

    first = n * F.log(1 - alpha)
    start = F.struct(first.alias("term"), first.alias("total"), F.when(first <= F.log(level), F.lit(0).cast("bigint")).otherwise(F.lit(-1).cast("bigint")).alias("k"))
    # P(X <= k) is at least about a half from the mean on, so no larger k can pass
    ks = F.when(n * alpha >= 1, F.sequence(F.lit(1).cast("bigint"), F.ceil(n * alpha))).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(ks, start, step, lambda s: s["k"])


def severity(rules: dict = RULES) -> Column:
    return F.greatest(*[F.expr(e) for e in rules.values()])


def learn_cutoffs(labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA, max_alpha: float = MAX_ALPHA, rules: dict = RULES, pooled: bool = False) -> DataFrame:
    """(stratum, alpha, cutoff) from good documents with statistics, stratum and weight; a null cutoff where the labels are too few,
    one over LEVELS where none is admitted.  With pooled, a null stratum has the cutoff over all."""
    counts = labelled.groupBy("stratum", severity(rules).alias("level")).agg(F.sum("weight").alias("n"))
    if pooled:
        counts = cut(counts)
        counts = counts.union(counts.groupBy("level").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string"), "level", "n"))
    # at most 101 levels for each stratum from here on
    by = cut(counts.groupBy("stratum").agg(F.sum("n").alias("total"), F.collect_list(F.struct("level", "n")).alias("hist")))
    level = F.lit(delta / max(1, by.count()))
    by = by.withColumn("alpha", certified_alpha(F.col("total"), level, alpha))
    by = by.withColumn("most", most_rejected(F.col("total"), F.col("alpha"), level))
    rejected = lambda c: F.aggregate("hist", F.lit(0).cast("bigint"), lambda s, x: s + F.when(x["level"] >= c, x["n"]).otherwise(0))
    cutoff = F.array_min(F.filter(F.sequence(F.lit(1), F.lit(LEVELS)), lambda c: rejected(c) <= F.col("most")))
    return by.select("stratum", "alpha", F.when(F.col("alpha") <= max_alpha, F.coalesce(cutoff, F.lit(LEVELS + 1))).alias("cutoff"))


def quality_rules(
    documents: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    good: str = "quality = 1",
    alpha: float = ALPHA,
    delta: float = DELTA,
    max_alpha: float = MAX_ALPHA,
    pooled: bool = False,
) -> DataFrame:
    """(doc_id, the statistics, base_failed, kept, failed_rules) for each document row; labels has doc_id."""
    part = F.coalesce(F.col(stratum).cast("string"), F.lit("und")) if stratum else F.lit("all")
    stats = statistics(documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), part.alias("stratum"))).drop("text")
    stats = cut(stats)  # a few numbers for each document, used to learn and to judge
    holdout = labels.where(good).groupBy(F.col(doc_id).alias("doc_id")).agg(F.count("*").alias("weight"))
    cutoffs = cut(learn_cutoffs(stats.join(holdout, "doc_id"), alpha, delta, max_alpha, pooled=pooled))
    over_all = cutoffs.where("stratum is null").first() if pooled else None
    if cutoffs.count() <= BROADCAST_CUTOFFS:
        cutoffs = F.broadcast(cutoffs)
    judged = stats.join(cutoffs, "stratum", "left")
    limit = F.coalesce("cutoff", F.lit(over_all and over_all.cutoff).cast("int"), F.lit(LEVELS + 1))
    failed = F.array_compact(F.array(*[F.when(F.expr(e) >= limit, F.lit(r)) for r, e in RULES.items()]))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.select("doc_id", *STATS, base.alias("base_failed"), (~base & (severity() < limit)).alias("kept"), failed.alias("failed_rules"))


def op2(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return quality_rules(documents, labels).drop("failed_rules")


def _sql() -> str:
    rule = {r: e.replace(" div ", " // ") for r, e in RULES.items()}
    level = f"greatest({', '.join(rule.values())})"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce(lang, 'und') AS stratum,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS c FROM
  (SELECT r, i, array_to_string(w[i + 1 : i + 5], ' ') AS x FROM (SELECT r, w, unnest(range(0, len(w) - 4)) AS i FROM d WHERE len(w) >= 5))),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM g WHERE c > 1) GROUP BY r),
l AS (SELECT r, count(*) - count(DISTINCT x) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r),
s AS (SELECT d.r, doc_id, stratum, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN l USING (r) LEFT JOIN rep USING (r)),
good AS (SELECT s.* FROM s JOIN labels USING (doc_id) WHERE quality = 1),
lv AS (SELECT stratum, {level} AS level FROM good),
tot AS (SELECT stratum, n, greatest({ALPHA}, ceil(1000 * (1 - pow({DELTA} / (SELECT count(DISTINCT stratum) FROM lv), 1.0::DOUBLE / n))) / 1000)::DOUBLE AS alpha
  FROM (SELECT stratum, count(*) AS n FROM lv GROUP BY stratum)),
pr AS (SELECT stratum, k, sum(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(alpha) + (n - k) * ln(1 - alpha)))
    OVER (PARTITION BY stratum ORDER BY k) AS p
  FROM (SELECT stratum, n, alpha, unnest(range(0, n + 1)) AS k FROM tot WHERE alpha <= {MAX_ALPHA})),
most AS (SELECT stratum, max(k) AS most FROM pr WHERE p <= {DELTA} / (SELECT count(*) FROM tot) GROUP BY ALL),
c AS (SELECT stratum, min(cut) AS cutoff FROM
  (SELECT m.stratum, cut, most, count(lv.level) AS k FROM most m CROSS JOIN range(1, {LEVELS + 1}) AS x(cut)
   LEFT JOIN lv ON lv.stratum = m.stratum AND lv.level >= cut GROUP BY ALL) WHERE k <= most GROUP BY ALL)
SELECT doc_id, {', '.join(STATS)}, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR coalesce({level} >= cutoff, false)) AS kept FROM s LEFT JOIN c USING (stratum)
"""


SQL = _sql()
