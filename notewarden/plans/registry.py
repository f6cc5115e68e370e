"""Registered queries of the document operators, and the same in SQL.

Queries read the whole given tables: pages, documents, conversations, labels, or notes rendered from the line items."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from notewarden.functions import text as T
from notewarden.operators import corpus, filters, quality, rolling, search_index, segment, toc
from notewarden.plans import rendered
from notewarden.plans.rendered import table
from notewarden.streaming import incremental, links
from notewarden.tables import new_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
N = rendered.SQL


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


def _notes(spark, d, text: str = "note") -> DataFrame:
    return rendered.notes(spark, d).select("k", "path", "file", F.col(text).alias("text"))


TOKENS = r"regexp_extract_all({x}, '[A-Za-z]+|[0-9]+(?:\.[0-9]+)?|[一-鿿]{{2,}}')"


def _facts(x: str) -> str:
    t = TOKENS.format(x=x)
    return (
        f"list_distinct(list_filter({t}, lambda t: regexp_matches(t, '^[0-9]') AND length(replace(t, '.', '')) BETWEEN 2 AND 9))",
        f"list_distinct(list_transform(list_filter({t}, lambda t: regexp_matches(t, '^[A-Za-z]') AND length(t) >= 3), lambda t: lower(t)))",
    )


def _reconcile_sql(source: str, note: str, key: str, head: str) -> str:
    a, b = _facts(source), _facts(note)
    return f"""{head}, f AS (SELECT {key}, {a[0]} AS sn, {a[1]} AS sw, {b[0]} AS dn, {b[1]} AS dw FROM base),
g AS (SELECT {key}, len(sn) AS total, list_sort(list_filter(sn, lambda t: len(list_filter(dn, lambda d: contains(d, t))) = 0)) AS missing,
  list_sort(list_filter(sw, lambda w: NOT list_contains(dw, w))) AS warn FROM f)
SELECT {key}, total::INT AS total, len(missing)::INT AS n_missing, array_to_string(missing[1:10], ',') AS missing,
  (total = 0 OR 1.0 - len(missing) / total >= 0.9) AS ok, array_to_string(warn[1:10], ',') AS warnings FROM g"""


def _reconciled(df: DataFrame, key: str) -> DataFrame:
    r = df.select(key, quality.reconcile(F.col("src"), F.col("note")).alias("r"))
    return r.select(
        key, F.col("r.total").cast("int").alias("total"), F.col("r.n_missing").cast("int").alias("n_missing"), F.array_join("r.missing", ",").alias("missing"), "r.ok", F.array_join("r.warnings", ",").alias("warnings")
    )


@query(_reconcile_sql("src", "note", "page_id", "WITH base AS (SELECT page_id, coalesce(html, '') AS src, left(coalesce(html, ''), CAST(floor(length(coalesce(html, '')) * 3 / 4) AS BIGINT)) AS note FROM pages)"))
def reconcile_pages(spark, d):
    """Which pages lose facts when only three quarters of them are kept?"""
    html = T.text(F.col("html"))
    return _reconciled(table(spark, d, "pages").select("page_id", html.alias("src"), F.left(html, F.floor(F.length(html) * 3 / 4).cast("int")).alias("note")), "page_id")


@query(_reconcile_sql("src", "note", "k", N + ", base AS (SELECT k, src, note FROM n)"))
def reconcile_notes(spark, d):
    return _reconciled(rendered.notes(spark, d), "k")


_CONTENT = r"length(regexp_replace(regexp_replace({x}, '^---\n(?s:.*?)\n---\n', ''), '[#*`|>\-\[\]()]|\s', '', 'g'))"


@query(f"SELECT page_id, {_CONTENT.format(x='html')}::INT AS content_chars FROM pages")
def content_length(spark, d):
    return table(spark, d, "pages").select("page_id", T.content_length(F.col("html")).alias("content_chars"))


@query(f"{N} SELECT k, {_CONTENT.format(x='note')} / {_CONTENT.format(x='src')} AS ratio FROM n")
def expansion_ratio(spark, d):
    return rendered.notes(spark, d).select("k", T.ratio(F.col("note"), F.col("src")).alias("ratio"))


_VERDICT = rf"""{N}, ln AS (SELECT k, unnest(string_split(note, chr(10))) AS x FROM n),
ca AS (SELECT k, sum(CASE WHEN starts_with(x, '|') THEN length(x) ELSE 0 END) AS carry, sum(CASE WHEN regexp_matches(x, '^#{{2,3}} ') THEN 1 ELSE 0 END) AS kp_note FROM ln GROUP BY k),
su AS (SELECT k, rn, {_CONTENT.format(x='src')} AS size FROM tx), nu AS (SELECT k, rn, {_CONTENT.format(x='note')} AS size FROM tx WHERE p % 7 <> 0),
uu AS (SELECT k, count(*) AS kp_src FROM su WHERE size > 50 GROUP BY k),
ra AS (SELECT su.k, list_sort(list(nu.size / su.size)) AS r FROM su JOIN nu USING (k, rn) WHERE su.size > 50 GROUP BY su.k),
v AS (SELECT n.k, {_CONTENT.format(x='note')} / {_CONTENT.format(x='src')} AS ratio, carry, kp_note, coalesce(kp_src, 0) AS kp_src,
  coalesce(r[len(r) // 2 + 1], 1.0) AS med, coalesce(len(r), 0) AS pairs FROM n JOIN ca USING (k) LEFT JOIN uu USING (k) LEFT JOIN ra USING (k)),
w AS (SELECT *, ratio < 0.8 AND ratio >= 0.3 AND (kp_src = 0 OR kp_note / kp_src >= 0.8) AND carry >= 10 AND (pairs = 0 OR med >= 0.4) AS exempt FROM v)
SELECT k, carry::INT AS carry, kp_note::INT AS kp_note, kp_src::INT AS kp_src, med AS unit_median, exempt, (ratio >= 0.8 OR exempt) AS ok FROM w"""


@query(_VERDICT)
def expansion_verdict(spark, d):
    """Richness of rewritten notes: ratio, points, structure and the upper median over units."""
    df = rendered.notes(spark, d)
    v = df.select("k", quality.expansion(F.col("src"), F.col("note")).alias("v"))
    return v.select("k", "v.carry", "v.kp_note", "v.kp_src", F.col("v.unit_median_exact").alias("unit_median"), "v.exempt", "v.ok")


@query(f"{N}, x AS (SELECT k, unnest(generate_series(1, len(string_split(note, chr(10))))) AS pos, unnest(string_split(note, chr(10))) AS line FROM n) SELECT k, (pos - 1)::INT AS pos, line FROM x WHERE NOT (line = '' AND pos = (SELECT max(pos) FROM x y WHERE y.k = x.k))")
def line_explode(spark, d):
    return rendered.notes(spark, d).select("k", F.posexplode(T.lines(F.col("note"))).alias("pos", "line"))


_BLOCKS = rf"""{N}, l0 AS (SELECT k, unnest(range(0, len(string_split(note, chr(10))))) AS pos, unnest(string_split(note, chr(10))) AS line FROM n),
l AS (SELECT * FROM l0 WHERE pos >= 7),
h AS (SELECT k, pos, line, CASE WHEN regexp_matches(line, '^#{{1,6}}\s+\S') THEN length(regexp_extract(line, '^(#+)', 1)) END AS lv FROM l),
g AS (SELECT *, count(lv) OVER (PARTITION BY k ORDER BY pos) AS b FROM h),
q AS (SELECT k, b, max(lv) AS level, max(CASE WHEN lv IS NOT NULL THEN trim(regexp_replace(line, '^#+\s+', '')) END) AS title,
  count(*) FILTER (WHERE lv IS NULL AND line <> '') AS n_text, min(pos) AS pos FROM g WHERE b > 0 GROUP BY k, b)"""


@query(f"{_BLOCKS} SELECT k, (b - 1)::INT AS ord, level::INT AS level, title, n_text::INT AS n_text, CASE WHEN level = 1 THEN title ELSE 'Order ' || k || ' > ' || title END AS path FROM q")
def assemble_blocks(spark, d):
    """Heading blocks of rewritten notes with their breadcrumb."""
    b = segment.blocks(_notes(spark, d), "k", "text")
    n_text = F.size(F.filter("lines", lambda x: ~T.is_blank(x)))
    return b.select("k", "ord", "level", "title", n_text.alias("n_text"), F.array_join("breadcrumb", " > ").alias("path"))


@query(f"{_BLOCKS} SELECT k, (b - 1)::INT AS ord, coalesce(lead(title) OVER (PARTITION BY k ORDER BY b), '') AS next_title FROM q")
def context_next_title(spark, d):
    return segment.with_next_title(segment.blocks(_notes(spark, d), "k", "text"), "k").select("k", "ord", "next_title")


@query(f"{N}, l AS (SELECT k, len(list_filter(string_split_regex(src, chr(10) || chr(10) || '+'), lambda x: trim(x, ' ' || chr(10)) <> '')) AS p FROM n) SELECT k, p::INT AS paragraphs FROM l")
def paragraph_groups(spark, d):
    return rendered.notes(spark, d).select("k", F.size(segment.paragraphs(T.lines(F.col("src")))).alias("paragraphs"))


@query(
    f"{_BLOCKS}, t AS (SELECT * FROM q WHERE level > 1) SELECT k, '## 📑 本篇目录' || chr(10) || chr(10) || string_agg(repeat('  ', CAST(level - 3 AS INT)) || '- [' || title || '](#' || "
    "replace(regexp_replace(lower(title), '[^a-z0-9_ -]', '', 'g'), ' ', '-') || ')', chr(10) ORDER BY b) || chr(10) || chr(10) || '---' || chr(10) AS toc FROM t GROUP BY k"
)
def toc_render(spark, d):
    """The contents block that a rewritten note gets."""
    built = _notes(spark, d).select("k", toc.build(F.col("text"))["headings"].alias("h"))
    return built.where(F.size("h") > 0).select("k", toc.render(F.col("h")).alias("toc"))


@query(
    f"{N}, t AS (SELECT k, note, string_agg('- [' || rn || ' · part](#' || rn || '--part)', chr(10) ORDER BY rn) AS e FROM n JOIN tx USING (k) WHERE p % 7 <> 0 GROUP BY k, n.note)"
    " SELECT n.k, md5(CASE WHEN e IS NULL THEN n.note ELSE rtrim(replace(n.note, chr(10) || '# Order ' || n.k || chr(10), chr(10) || '# Order ' || n.k || chr(10) || '## 📑 本篇目录' || chr(10) || chr(10) || e || chr(10) || chr(10) || '---' || chr(10) || chr(10)), chr(10)) END) AS note_md5 FROM n LEFT JOIN t USING (k)".replace(
        "n.note)", "n.note)"
    ).replace("SELECT k, note, string_agg", "SELECT k, string_agg")
)
def toc_insert(spark, d):
    """Notes with their contents block inserted; building it again changes nothing."""
    built = _notes(spark, d).select("k", F.col("text").alias("old"), toc.build(F.col("text")).alias("b"))
    again = F.when(F.size("b.headings") > 0, toc.build(F.col("b.text"), listed_too=False)["text"]).otherwise(F.col("old"))
    return built.select("k", F.md5(again).alias("note_md5"))


@query(f"{N} SELECT k, 'Order ' || k AS title, 'order,part' AS tags, 'A summary of order ' || k || '.' AS summary, 7 AS front_end, 'Order ' || k AS heading FROM n")
def frontmatter_fields(spark, d):
    heads = _notes(spark, d).select("k", T.head(F.col("text")).alias("h"))
    tags = F.array_join(F.try_element_at("h.front", F.lit("tags"))["items"], ",")
    return heads.select("k", T.front_scalar(F.col("h.front"), "title").alias("title"), tags.alias("tags"), "h.summary", "h.front_end", "h.heading")


@query(f"{N} SELECT k, md5(regexp_replace(regexp_replace(regexp_replace(src, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}', ' ', 'g'), '\\b[0-9]{{1,2}}\\.[0-9]{{1,2}}\\b', ' ', 'g'), '\\b[0-9]{{3,}}\\.[0-9]{{1,3}}\\b', ' ', 'g')) AS scrubbed_md5 FROM n")
def metadata_scrub(spark, d):
    return rendered.notes(spark, d).select("k", F.md5(T.scrub_meta(F.col("src"))).alias("scrubbed_md5"))


@query(f"{N}, s AS (SELECT k, rn, {_CONTENT.format(x='src')} AS size FROM tx) SELECT k, rn::BIGINT AS num, size::INT AS size FROM s WHERE size > 50")
def source_units(spark, d):
    u = rendered.notes(spark, d).select("k", F.explode(T.source_units(F.col("src"))).alias("u"))
    return u.select("k", F.col("u.num").try_cast("bigint").alias("num"), "u.size")


_SCORE = r"""WITH l AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '\S')) AS ls FROM documents),
s AS (SELECT doc_id, ls, len(list_filter(ls, lambda x: regexp_matches(x, '^#{1,6}\s'))) > 0 AS head, len(list_filter(ls, lambda x: length(x) <= 1 AND NOT regexp_matches(x, '[一-鿿A-Za-z0-9]'))) AS noise FROM l)
SELECT doc_id, (CASE WHEN len(ls) = 0 THEN 0 ELSE 40 + CASE WHEN head THEN 20 ELSE 0 END + CASE WHEN len(ls) >= 5 THEN 20 ELSE 0 END + CASE WHEN noise = 0 THEN 20 ELSE 10 END END)::DOUBLE AS score FROM s"""


@query(_SCORE)
def score_document(spark, d):
    return table(spark, d, "documents").select("doc_id", quality.score(F.col("text")).alias("score"))


WORDS = "the and, of trash that"


@query(
    r"""WITH w(x) AS (VALUES ('the'), ('and'), ('of'), ('trash'), ('that')),
l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
s AS (SELECT doc_id, count(*) AS score FROM l JOIN w ON contains(lower(line), x) GROUP BY doc_id)
SELECT doc_id, score::BIGINT AS score FROM s ORDER BY score DESC, doc_id LIMIT 20"""
)
def search_topk(spark, d):
    """Top documents for a query of five words; ties in the order of ids."""
    docs = table(spark, d, "documents")
    found = corpus.search(docs, WORDS, 20, file="doc_id", order="doc_id")
    return found.select(F.col("file").alias("doc_id"), F.col("score").cast("bigint").alias("score"))


@query(
    r"""WITH w(x) AS (VALUES ('the'), ('and'), ('of'), ('trash'), ('that')),
l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
s AS (SELECT doc_id, count(*) AS score FROM l JOIN w ON contains(lower(line), x) GROUP BY doc_id)
SELECT doc_id, score::BIGINT AS score FROM s ORDER BY score DESC, doc_id LIMIT 20"""
)
def search_indexed(spark, d):
    """The same rows by an index of letter groups, whose bounds tell what texts have to be read."""
    index = new_dir(spark, "index")
    search_index.build(table(spark, d, "documents"), index, "doc_id", order="doc_id")
    found = search_index.search(spark, index, WORDS, 20)
    return found.select(F.col("file").cast("bigint").alias("doc_id"), F.col("score").cast("bigint").alias("score"))


@query(
    f"""{N}, e AS (SELECT k, s, row_number() OVER (PARTITION BY k ORDER BY rn) - 1 AS pos FROM tx JOIN it USING (k, rn) WHERE tx.p % 7 <> 0)
SELECT 'notes/order_' || k || '.md' AS path, pos::INT AS pos, 'supplier_' || s || '.md' AS target FROM e WHERE k % 10 > 1 AND s % 3 = 0"""
)
def incremental_links(spark, d):
    """Dangling links after a second run, which brings new orders, the notes of suppliers, orders that have lost their links, and orders that are gone."""
    state, notes = new_dir(spark, "links"), rendered.notes(spark, d)
    rows = notes.select("path", "file", F.col("note").alias("text"), (F.col("k") % 10).alias("m"), "src")
    links.update(spark, state, rows.where("m <> 2").select("path", "file", "text"))
    suppliers = _suppliers(spark, d).select(F.concat(F.lit("suppliers/"), "target").alias("path"), F.col("target").alias("file"), F.lit("").alias("text"))
    changed = rows.where("m = 2").select("path", "file", "text").union(rows.where("m = 0").select("path", "file", "src")).union(suppliers)
    links.update(spark, state, changed, rows.where("m = 1").select("path"))
    return links.dangling(spark, state)


@query(f"{N} SELECT 'brand ' || lower(['A','B','C','D','E'][p % 5 + 1]) || ' line' AS term, 'Brand ' || ['A','B','C','D','E'][p % 5 + 1] || ' Line' AS name, count(DISTINCT k)::INT AS n_files, min('order_' || k || '.md') AS first_file FROM tx WHERE p % 7 <> 0 GROUP BY ALL")
def term_index(spark, d):
    """Inverted index of bold terms."""
    return corpus.concept_index(_notes(spark, d))


@query(
    f"{N}, c AS (SELECT 'brand ' || lower(['A','B','C','D','E'][p % 5 + 1]) || ' line' AS term, 'order_' || k || '.md' AS file, rn, string_split(note, chr(10))[5] AS line FROM tx WHERE p % 7 <> 0),"
    " r AS (SELECT *, row_number() OVER (PARTITION BY term, file ORDER BY rn) AS i FROM c) SELECT term, file, md5(string_agg(line, chr(10) ORDER BY rn)) AS contexts_md5 FROM r WHERE i <= 3 GROUP BY ALL"
)
def term_contexts(spark, d):
    """The first lines that name each concept in each file."""
    return corpus.concept_contexts(_notes(spark, d)).select("term", "file", F.md5(F.array_join("contexts", "\n")).alias("contexts_md5"))


def _suppliers(spark, d) -> DataFrame:
    s = table(spark, d, "supplier").where("s_suppkey % 3 <> 0")
    return s.select(F.concat(F.lit("supplier_"), "s_suppkey", F.lit(".md")).alias("target"))


_KNOWN = "kn AS (SELECT 'supplier_' || s_suppkey || '.md' AS target FROM supplier WHERE s_suppkey % 3 <> 0)"


@query(f"{N}, {_KNOWN}, e AS (SELECT k, rn, regexp_extract(note, 'supplier_[0-9]+\\.md') AS target FROM tx WHERE p % 7 <> 0) SELECT 'notes/order_' || k || '.md' AS path, target, count(*)::BIGINT AS n FROM e WHERE target NOT IN (SELECT target FROM kn) GROUP BY ALL")
def dangling_links(spark, d):
    """Links of notes to suppliers that have no note: an anti-join."""
    return corpus.dangling_links(_notes(spark, d), _suppliers(spark, d)).groupBy("path", "target").agg(F.count("*").alias("n"))


@query(f"{N}, {_KNOWN} SELECT 'notes/order_' || k || '.md' AS path, 'prerequisites,related' AS missing, CASE WHEN 'supplier_' || (k % 150) || '.md' IN (SELECT target FROM kn) THEN '' ELSE 'next=supplier_' || (k % 150) || '.md#top' END AS broken FROM n")
def relation_check(spark, d):
    r = corpus.relation_check(_notes(spark, d), _suppliers(spark, d))
    return r.select("path", F.array_join("missing", ",").alias("missing"), F.array_join("broken", ",").alias("broken"))


@query(f"{N} SELECT k, CASE WHEN k % 3 = 2 THEN 'confidence invalid: sure' ELSE '' END AS issues, true AS schema_ok FROM n")
def field_checks(spark, d):
    front = _notes(spark, d).select("k", T.frontmatter(F.col("text")).alias("front"))
    return front.select("k", F.array_join(corpus.confidence_issues(F.col("front")), ",").alias("issues"), corpus.schema_check(F.col("front"))["ok"].alias("schema_ok"))


@query(
    f"{N}, b AS (SELECT k, count(*) AS c FROM tx WHERE p % 7 <> 0 GROUP BY k), t AS (SELECT n.k, coalesce(c, 0) AS c FROM n LEFT JOIN b USING (k)) "
    "SELECT count(*)::BIGINT AS notes, sum(c)::BIGINT AS links, sum(least(c, 10))::BIGINT AS broken_total, sum(c)::BIGINT AS all_broken, count(*)::BIGINT AS relation_broken,"
    " (2 * count(*))::BIGINT AS relation_missing, 0::BIGINT AS citation_total, count(*) FILTER (WHERE k % 3 = 2)::BIGINT AS confidence_issues, 0::BIGINT AS schema_issues,"
    " count(*) FILTER (WHERE k % 3 = 1)::BIGINT AS low_confidence, false AS ok FROM t"
)
def corpus_report(spark, d):
    """Totals of the link, relation, citation, confidence and schema checks over all notes."""
    return corpus.validation_totals(corpus.validation(_notes(spark, d)))


@query(f"{N} SELECT k % 100 AS course, row_number() OVER (PARTITION BY k % 100 ORDER BY k)::INT AS n, file, 'Order ' || k AS title, 'A summary of order ' || k || '.' AS summary FROM n")
def course_entries(spark, d):
    """Notes of each course in natural order with title and summary."""
    own = _notes(spark, d).withColumn("course", F.col("k") % 100)
    return corpus.course_entries(own, ["course"]).select("course", "n", "file", "title", "summary")


@query(
    f"{N}, e AS (SELECT k % 100 AS course, row_number() OVER (PARTITION BY k % 100 ORDER BY k) AS i, file, k FROM n), c AS (SELECT course, count(*) AS m FROM e GROUP BY course) "
    "SELECT course, 0::INT AS section, 0::INT AS n, '---' || chr(10) || 'okf_version: v0.2' || chr(10) || 'type: course-index' || chr(10) || 'course: C' || course || chr(10) || 'notes: ' || m || chr(10) || '---' || chr(10) || chr(10) || '# C' || course || "
    "' · 课程索引' || chr(10) || chr(10) || '> AI 先读本索引定位讲次与顺序，再按需打开具体笔记，勿整目录倾倒。' || chr(10) || chr(10) || '## 讲次地图' || chr(10) AS line FROM c "
    "UNION ALL SELECT course, 1, i::INT, i || '. [[' || file || '|Order ' || k || ']] — A summary of order ' || k || '.' FROM e "
    "UNION ALL SELECT course, 2, 0, chr(10) || '## 统计' || chr(10) || chr(10) || '- 讲次总数：' || m || chr(10) || '- 链接全部指向本课程笔记，AI 按需点开。' || chr(10) FROM c"
)
def course_index(spark, d):
    """The lines of the index of each course."""
    own = _notes(spark, d).withColumn("course", F.col("k") % 100)
    return corpus.course_index(own, F.concat(F.lit("C"), "course"), ["course"])


@query(
    "SELECT doc_id, CASE WHEN quality = 1 AND toxic = 0 AND doc_id % 101 >= 95 THEN 'pass' WHEN doc_id % 3 > 0 THEN 'repair' ELSE 'hang' END AS action, (quality = 1 AND toxic = 0 AND doc_id % 101 >= 95) AS pass FROM labels"
)
def gate_state(spark, d):
    """Pass, repair or hang from labels: quality as the mechanical check, toxic as an issue."""
    g = quality.gate(F.col("quality") == 1, F.col("toxic"), F.col("doc_id") % 101, F.col("doc_id") % 3)
    return table(spark, d, "labels").select("doc_id", g.alias("g")).select("doc_id", "g.action", "g.pass")


_MARKED = "CASE rn % 4 WHEN 1 THEN '## 插图笔记：' || rn WHEN 2 THEN '## 图片内容（OCR）' WHEN 3 THEN '## References' ELSE '## Section ' || rn END || chr(10) || 'see http://x.y/' || rn || ' and ' || p || chr(10)"


def _marked(spark, d) -> DataFrame:
    rn = F.col("rn")
    head = F.when(rn % 4 == 1, F.concat(F.lit("## 插图笔记："), rn)).when(rn % 4 == 2, F.lit("## 图片内容（OCR）")).when(rn % 4 == 3, F.lit("## References")).otherwise(F.concat(F.lit("## Section "), rn))
    li = table(spark, d, "lineitem")
    num = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*rendered.ORDER))
    li = li.select(F.col("l_orderkey").alias("k"), num.alias("rn"), F.col("l_partkey").alias("p"))
    li = li.select("k", "rn", F.concat(head, F.lit("\nsee http://x.y/"), "rn", F.lit(" and "), "p", F.lit("\n")).alias("t"))
    rows = li.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("rn", "t"))).alias("r"))
    return rows.select("k", F.array_join(F.transform("r", lambda x: x["t"]), "").alias("text"))


@query(f"{N}, m AS (SELECT k, rn, {_MARKED} AS t FROM tx) SELECT k, md5(coalesce(string_agg(t, '' ORDER BY rn) FILTER (WHERE rn % 4 NOT IN (1, 2)), '')) AS text_md5, count(*) FILTER (WHERE rn % 4 = 1)::INT AS figures, count(*) FILTER (WHERE rn % 4 = 2)::INT AS ocr FROM m GROUP BY k")
def ebook_filter(spark, d):
    """Sources without their illustration blocks."""
    f = _marked(spark, d).select("k", filters.drop_figures(F.col("text")).alias("f"))
    return f.select("k", F.md5("f.text").alias("text_md5"), "f.figures", "f.ocr")


@query(f"{N}, m AS (SELECT k, rn, '## Section ' || rn || chr(10) || 'see   and ' || p AS t FROM tx) SELECT k, md5(coalesce(string_agg(t, chr(10) ORDER BY rn) FILTER (WHERE rn % 4 = 0), '')) AS text_md5 FROM m GROUP BY k")
def nonprose_strip(spark, d):
    """Sources without figure blocks, references and URLs."""
    return _marked(spark, d).select("k", F.md5(filters.strip_nonprose(F.col("text"))).alias("text_md5"))


LINE_RULES = filters.LineRules(noise_first=(r"\b[0-9]*7[0-9]* times",), noise_last=(r"\.[0-9]*9",), short_line=40, anchored="Part", skip=(("## 3. ", "## 5. "),))


@query(
    rf"""{N}, l AS (SELECT k, unnest(range(0, len(string_split(src, chr(10))))) AS pos, unnest(string_split(src, chr(10))) AS line FROM n),
f AS (SELECT k, pos, line, coalesce(last_value(CASE WHEN starts_with(line, '## 3. ') THEN true WHEN starts_with(line, '## 5. ') THEN false END IGNORE NULLS) OVER (PARTITION BY k ORDER BY pos), false) AS skip FROM l
  WHERE NOT (line = '' AND pos = (SELECT len(string_split(src, chr(10))) - 1 FROM n WHERE n.k = l.k))),
j AS (SELECT *, NOT skip AND NOT regexp_matches(line, '\b[0-9]*7[0-9]* times') AND (starts_with(line, '#') OR starts_with(line, 'Part') OR (NOT regexp_matches(line, '\.[0-9]*9') AND length(line) < 40)) AS keep FROM f)
SELECT k, count(*) FILTER (WHERE keep)::BIGINT AS kept, count(*) FILTER (WHERE NOT keep)::BIGINT AS dropped, md5(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE keep), '')) AS text_md5 FROM j GROUP BY k"""
)
def line_filter(spark, d):
    """Rule-driven noise filter over the lines of sources."""
    f = filters.filter_lines(rendered.notes(spark, d).select("k", "src"), LINE_RULES, "k", "src")
    return f.select("k", "kept", "dropped", F.md5("text").alias("text_md5"))


RULE_SETS = {
    "0": LINE_RULES,
    "1": filters.LineRules(noise_first=(r"^## [24]\.", "supplier 1"), short_line=9),
    None: filters.LineRules(short_line=12, short_needs="[0-9]", anywhere="price of 1", skip=(("## 1.", "## 2."), ("## 4.", "## 6."))),
}


@query(
    rf"""{N}, l AS (SELECT k, k % 3 AS c, unnest(range(0, len(string_split(src, chr(10))))) AS pos, unnest(string_split(src, chr(10))) AS line, len(string_split(src, chr(10))) - 1 AS last FROM n),
f AS (SELECT *, last_value(CASE WHEN starts_with(line, '## 3. ') THEN 1 WHEN starts_with(line, '## 5. ') THEN 0 END IGNORE NULLS) OVER w AS a,
  last_value(CASE WHEN starts_with(line, '## 1.') THEN 1 WHEN starts_with(line, '## 2.') THEN 0 END IGNORE NULLS) OVER w AS b,
  last_value(CASE WHEN starts_with(line, '## 4.') THEN 1 WHEN starts_with(line, '## 6.') THEN 0 END IGNORE NULLS) OVER w AS d FROM l WHERE NOT (line = '' AND pos = last) WINDOW w AS (PARTITION BY k ORDER BY pos)),
j AS (SELECT k, c, pos, line, starts_with(line, '#') AS head, CASE c
  WHEN 0 THEN coalesce(a, 0) = 0 AND NOT regexp_matches(line, '\b[0-9]*7[0-9]* times') AND (head OR starts_with(line, 'Part') OR (NOT regexp_matches(line, '\.[0-9]*9') AND length(line) < 40))
  WHEN 1 THEN NOT regexp_matches(line, '^## [24]\.|supplier 1') AND (head OR length(line) < 9)
  ELSE coalesce(b, 0) = 0 AND coalesce(d, 0) = 0 AND (head OR contains(line, 'price of 1') OR (length(line) < 12 AND regexp_matches(line, '[0-9]'))) END AS keep FROM f)
SELECT k, count(*) FILTER (WHERE keep)::BIGINT AS kept, count(*) FILTER (WHERE NOT keep)::BIGINT AS dropped, md5(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE keep), '')) AS text_md5 FROM j GROUP BY k"""
)
def line_filter_sets(spark, d):
    """Three rule sets over sources in one plan, chosen by their chapter; one of them is for all chapters that have none of their own."""
    docs = rendered.notes(spark, d).select("k", "src", (F.col("k") % 3).cast("string").alias("chapter"))
    f = filters.filter_lines(docs, RULE_SETS, "k", "src", "chapter")
    return f.select("k", "kept", "dropped", F.md5("text").alias("text_md5"))


@query(
    "WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i, role, replace(coalesce(text, ''), chr(10), ' ') AS x FROM conversations) "
    "SELECT conv_id, md5(CASE WHEN count(*) FILTER (WHERE role = 'user' AND x <> '') > 0 THEN string_agg(x, chr(10) ORDER BY i) FILTER (WHERE role = 'user' AND x <> '') ELSE string_agg('[0' || i || ':00] ' || CASE WHEN role = 'user' THEN '🎤 ' ELSE '📷 ' END || x, chr(10) ORDER BY i) END) AS speech_md5 FROM t GROUP BY conv_id"
)
def speech_track(spark, d):
    """The speech lines of conversations written as time-coded transcripts."""
    t = table(spark, d, "conversations")
    i = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    line = F.concat(F.lit("[0"), i, F.lit(":00] "), F.when(F.col("role") == "user", "🎤 ").otherwise("📷 "), F.translate(T.text(F.col("text")), "\n", " "))
    rows = t.select("conv_id", F.struct(i.alias("i"), line.alias("x")).alias("r")).groupBy("conv_id").agg(F.array_sort(F.collect_list("r")).alias("r"))
    return rows.select("conv_id", F.md5(T.speech(F.array_join(F.transform("r", lambda x: x["x"]), "\n"))).alias("speech_md5"))


PARTS = list(quality.SIX_PARTS)
_POINT = (
    "'### 知识点 ' || rn || '.1 · part' || chr(10) || '- **定义**：' || p || chr(10) || '- **通俗类比**：x' || chr(10) || '- **原理**：x' || chr(10) || CASE WHEN p % 2 = 0 THEN '- **示例**：x' || chr(10) ELSE '' END"
    " || '- **为什么重要**：x' || chr(10) || CASE WHEN p % 3 = 0 THEN '- **易错点**：①②' || chr(10) ELSE '' END || '- **❓ 示范角度**：' || repeat('①', CAST(p % 4 AS INT)) || chr(10)"
)


def _pointed(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    rn = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*rendered.ORDER))
    li = li.select(F.col("l_orderkey").alias("k"), rn.alias("rn"), F.col("l_partkey").alias("p"))
    t = F.concat(
        F.lit("### 知识点 "), "rn", F.lit(".1 · part\n- **定义**："), "p", F.lit("\n- **通俗类比**：x\n- **原理**：x\n"), F.when(F.col("p") % 2 == 0, "- **示例**：x\n").otherwise(""),
        F.lit("- **为什么重要**：x\n"), F.when(F.col("p") % 3 == 0, "- **易错点**：①②\n").otherwise(""), F.lit("- **❓ 示范角度**："), F.repeat(F.lit("①"), (F.col("p") % 4).cast("int")), F.lit("\n"),
    )
    rows = li.select("k", "rn", t.alias("t")).groupBy("k").agg(F.array_sort(F.collect_list(F.struct("rn", "t"))).alias("r"))
    return rows.select("k", F.array_join(F.transform("r", lambda x: x["t"]), "\n").alias("note"))


@query(f"{N}, m AS (SELECT k, rn || '.1' AS kp, concat_ws(',', CASE WHEN p % 2 <> 0 THEN '示例' END, CASE WHEN p % 3 <> 0 THEN '易错点' END) AS miss FROM tx) SELECT k, kp, miss FROM m WHERE miss <> ''")
def six_sets(spark, d):
    """Knowledge points without all their parts."""
    m = _pointed(spark, d).select("k", F.explode(quality.six_sets(F.col("note"))["missing"]).alias("m"))
    return m.select("k", "m.kp", F.array_join("m.miss", ",").alias("miss"))


@query(f"{N} SELECT k, rn || '.1' AS kp, (p % 4)::INT AS n FROM tx WHERE p % 4 < 2")
def demo_angles(spark, d):
    """Knowledge points with too few demonstration angles."""
    return _pointed(spark, d).select("k", F.explode(quality.demo_angles(F.col("note"))["low"]).alias("m")).select("k", "m.kp", "m.n")


_SCRUBBED = r"regexp_replace(regexp_replace(regexp_replace(src, '[0-9]{4}-[0-9]{2}-[0-9]{2}', ' ', 'g'), '\b[0-9]{1,2}\.[0-9]{1,2}\b', ' ', 'g'), '\b[0-9]{3,}\.[0-9]{1,3}\b', ' ', 'g')"


@query(
    _VERDICT[: _VERDICT.index("SELECT k, carry::INT AS carry, kp_note")]
    + f""", fa AS (SELECT k, {_facts('src')[0]} AS sn, {_facts('note')[0]} AS dn FROM (SELECT k, {_SCRUBBED} AS src, note FROM n)),
ga AS (SELECT k, len(sn) AS total, len(list_filter(sn, lambda t: len(list_filter(dn, lambda d: contains(d, t))) = 0)) AS miss FROM fa),
re AS (SELECT k, (ratio >= 0.8 OR exempt) AS rich, CASE WHEN ratio >= 0.8 THEN 'rich enough' WHEN ratio < 0.3 THEN 'below the red line' WHEN exempt THEN 'condensed into structure'
  ELSE concat_ws('; ', CASE WHEN NOT (kp_src = 0 OR kp_note / kp_src >= 0.8) THEN 'points not covered' END, CASE WHEN carry < 10 THEN 'no tables or code' END,
    CASE WHEN NOT (pairs = 0 OR med >= 0.4) THEN 'units squeezed' END) END AS reason FROM w),
al AS (SELECT *, (total = 0 OR 1.0 - miss / total >= 0.9) AS facts_ok FROM ga JOIN re USING (k))
SELECT k, false AS pass, round_even(CASE WHEN total = 0 THEN 1.0 ELSE 1.0 - miss / total END, 3)::DOUBLE AS coverage, facts_ok, rich, 0::INT AS n_variants,
  concat_ws('; ', CASE WHEN NOT facts_ok THEN 'facts missing' END, 'no knowledge points', 'no knowledge points', CASE WHEN NOT rich THEN 'not rich enough: ' || reason END) AS problems FROM al"""
)
def gate_reports(spark, d):
    """The whole gate report of every rendered pair."""
    r = quality.gate_report(rendered.notes(spark, d), "k", "note", "src")
    return r.select("k", "pass", F.col("reconcile.coverage").alias("coverage"), F.col("reconcile.ok").alias("facts_ok"), F.col("expansion.ok").alias("rich"), F.size("variants").alias("n_variants"), F.array_join("problems", "; ").alias("problems"))


@query(
    N
    + "SELECT file, 1::INT AS run, md5(note) AS text_md5, k % 5 <> 0 AS ok FROM n"
    + " UNION ALL SELECT file, 2::INT, md5(CASE WHEN k % 3 = 0 THEN note || 'More.' ELSE note END), true FROM n WHERE k % 3 = 0 OR k % 5 = 0"
    + " UNION ALL SELECT file, 3::INT, md5(CASE WHEN k % 3 = 0 THEN note || 'More.' ELSE note END), true FROM n WHERE k % 7 = 0"
)
def incremental_notes(spark, d):
    """What each of three runs over all notes works on: every fifth note fails in the first, every third is written anew before the second, every seventh touched before the third."""
    base, k, rows = new_dir(spark, "runs"), F.col("k"), rendered.rows(spark, d)
    # times are compared without the texts, which are written behind that for the notes to be worked on
    path = F.concat(F.lit("notes/"), rendered.file_of(k))
    notes = rows.select("k", path.alias("path"), F.timestamp_seconds(k + 1_700_000_000).alias("mtime"), F.lit(False).alias("more"))
    later = notes.withColumns({"more": k % 3 == 0, "mtime": F.when(k % 3 == 0, F.timestamp_seconds(k + 1_700_100_000)).otherwise(F.col("mtime"))})
    touched = later.withColumn("mtime", F.when(k % 7 == 0, F.timestamp_seconds(k + 1_700_200_000)).otherwise(F.col("mtime")))
    text = F.concat(rendered.note_of(F.col("r")), F.when(F.col("more"), "More.").otherwise(""))
    for run, now in enumerate((notes, later, touched)):
        failing = (k % 5 == 0) & F.lit(run == 0)
        incremental.process(spark, now, f"{base}/state", lambda todo, failing=failing: todo.join(rows, "k", "left").select("path", F.md5(text).alias("text_md5"), (~failing).alias("ok")), f"{base}/out")
    return spark.read.parquet(f"{base}/out").select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("run").cast("int").alias("run"), "text_md5", "ok")


@query(
    """WITH c AS (SELECT doc_id, replace(translate(regexp_replace(text, '[A-Za-z]+', ' ', 'g'), 'éèêçàüöäßñóíáú', '一二三四五六七八九十百千万亿'), ' ', '') AS src FROM documents),
x AS (SELECT doc_id, list_filter(regexp_extract_all(src, '[一-鿿]{2,}'), lambda e: length(e) >= 4) AS x FROM c),
t AS (SELECT doc_id, list_filter(x, lambda e, i: list_position(x, e) = i) AS s FROM x),
s AS (SELECT doc_id, unnest(s) AS term, generate_subscripts(s, 1) - 1 AS pos FROM t),
v AS (SELECT DISTINCT doc_id, translate(term, '四', '五') AS v, length(term) AS n FROM s),
p AS (SELECT DISTINCT s.doc_id, pos, term, n FROM s JOIN v USING (doc_id) WHERE n <= length(term)),
w AS (SELECT doc_id, pos, term, n, i, substr(term, i, n) AS w FROM (SELECT *, unnest(range(1, length(term) - n + 2)) AS i FROM p)),
m AS (SELECT w.*, v, len(list_filter(range(1, n + 1), lambda x: substr(w, x, 1) <> substr(v, x, 1))) AS dist FROM w JOIN v USING (doc_id, n)
  WHERE len(list_filter(range(1, n + 1), lambda x: substr(w, x, 1) <> substr(v, x, 1))) <= 1 AND (n = length(term) OR NOT contains('"""
    + quality.STOP_HEADS
    + """', left(w, 1)))),
h AS (SELECT *, min(CASE WHEN dist = 0 THEN i END) OVER (PARTITION BY doc_id, pos, n) AS stop FROM m),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id, pos ORDER BY n DESC, i DESC, v) AS r FROM h WHERE dist = 1 AND (stop IS NULL OR i < stop)),
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS place FROM b WHERE r = 1)
SELECT doc_id, pos::INT AS pos, w AS term, v AS variant, 1::INT AS distance FROM o WHERE place <= 10"""
)
def term_variants(spark, d):
    """Near-miss spellings: each document's longer words outside ASCII against a copy that swaps one letter."""
    docs = table(spark, d, "documents").select("doc_id", F.regexp_replace("text", "[A-Za-z]+", " ").alias("src"))
    cjk = F.translate("src", "éèêçàüöäßñóíáú", "一二三四五六七八九十百千万亿")
    pairs = docs.select("doc_id", F.regexp_replace(cjk, " ", "").alias("src")).withColumn("note", F.translate("src", "四", "五"))
    return quality.term_variants(pairs, "doc_id", F.col("src"), F.col("note"))


@query(
    r"""WITH RECURSIVE d AS (SELECT doc_id AS doc, text AS t FROM documents WHERE regexp_matches(coalesce(text, ''), '\S')),
l AS (SELECT doc, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d WHERE length(replace(t, chr(10), '')) > 2000),
c AS (SELECT *, unnest(range(0, cut + 1)) AS j FROM (SELECT *, greatest(ceil(length(line) / 2000)::INT - 1, 0) AS cut FROM l)),
p AS (SELECT doc, substr(line, j * 2000 + 1, 2000) AS x, j < cut AS alone, row_number() OVER (PARTITION BY doc ORDER BY i, j) AS n FROM c),
g AS (SELECT doc, n, length(x) AS size, alone, 0 AS pack FROM p WHERE n = 1
  UNION ALL SELECT p.doc, p.n, length(x) + CASE WHEN g.alone OR p.alone OR size + length(x) > 2000 THEN 0 ELSE size END, p.alone, pack + CASE WHEN g.alone OR p.alone OR size + length(x) > 2000 THEN 1 ELSE 0 END
  FROM g JOIN p ON p.doc = g.doc AND p.n = g.n + 1),
o AS (SELECT doc, pack AS ord, string_agg(x, chr(10) ORDER BY n) AS t, true AS overlap FROM g JOIN p USING (doc, n) GROUP BY doc, pack
  UNION ALL SELECT doc, 0, t, length(t) > 2000 FROM d WHERE length(replace(t, chr(10), '')) <= 2000)
SELECT doc, ord::INT AS ord, length(t)::INT AS chars, md5(t) AS text_md5, overlap FROM o"""
)
def chunk_documents(spark, d):
    """Chunks of whole documents with overlap; these have neither headings nor blank lines, so the SQL packs lines and slices."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("doc"), "text")
    c = segment.chunks(docs, max_chars=2000, overlap_chars=100)
    return c.select("doc", "ord", F.length("text").alias("chars"), F.md5("text").alias("text_md5"), "overlap")


_BLOCKS = "'# Order ' || k || ' > ' || rn || '. part' || chr(10) || split_part(src, chr(10), 3)"


@query(
    f"""{N}, b AS (SELECT k, 0 AS i, '# Order ' || k AS t, 'Order ' || k AS crumb FROM n UNION ALL SELECT k, rn, {_BLOCKS}, rn || '. part' FROM tx),
w AS (SELECT k, i, t AS cur, length(t) AS size, false AS tail, 0 AS ord FROM b WHERE i = 0
  UNION ALL SELECT k, b.i, CASE WHEN size + length(t) > 300 THEN right(cur, 40) ELSE cur END || chr(10) || t, length(t) + CASE WHEN size + length(t) > 300 THEN least(40, length(cur)) ELSE size END,
    tail OR size + length(t) > 300, ord + CASE WHEN size + length(t) > 300 THEN 1 ELSE 0 END FROM w JOIN b USING (k) WHERE b.i = w.i + 1),
z AS (SELECT k, ord, max(i) AS i, arg_max(cur, i) AS t, bool_or(tail) AS tail FROM w GROUP BY k, ord)
SELECT z.k, z.ord::INT AS ord, md5(z.t) AS text_md5, z.tail AS overlap, coalesce(x.crumb, y.crumb) AS crumb FROM z JOIN b y ON y.k = z.k AND y.i = z.i LEFT JOIN b x ON x.k = z.k AND x.i = z.i + 1"""
)
def chunk_notes(spark, d):
    """Blocks of rendered sources packed into chunks that open with the end of the chunk before."""
    c = segment.chunks(_notes(spark, d, "src"), "k", max_chars=300, overlap_chars=40)
    return c.select("k", "ord", F.md5("text").alias("text_md5"), "overlap", F.element_at("breadcrumb", -1).alias("crumb"))


@query(
    "WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS ord, text, role FROM conversations WHERE regexp_matches(coalesce(text, ''), '\\S')), "
    "g AS (SELECT *, sum(CASE WHEN prev = 'user' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY ord) - 1 AS unit FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY ord) AS prev FROM t)) "
    "SELECT conv_id, unit::INT AS ord, count(*)::INT AS merged_blocks, md5(string_agg(text, chr(10) ORDER BY ord)) AS text_md5 FROM g GROUP BY conv_id, unit"
)
def rolling_compile(spark, d):
    """The rolling fold over conversations; a user's turn asks to be merged with the next."""
    t = table(spark, d, "conversations")
    order = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")) - 1
    chunks = t.select("conv_id", order.alias("ord"), F.concat(F.when(F.col("role") == "user", "u").otherwise("-"), T.text(F.col("text"))).alias("text"), F.array(F.col("role")).alias("breadcrumb"))
    chunks = chunks.where(F.regexp_like(F.substring("text", 2, 1 << 30), F.lit(r"\S")))
    units = rolling.rolling_compile(chunks, lambda text, summary: (text[1:], summary, text[0] == "u"), key="conv_id")  # a null id is one document
    return units.select("conv_id", "ord", "merged_blocks", F.md5("rewritten").alias("text_md5"))


_P = _facts("coalesce(html, '')")


@query(f"SELECT page_id, len({_P[0]})::INT AS n_numbers, len({_P[1]})::INT AS n_words, array_to_string(list_sort({_P[0]}), ',') AS numbers FROM pages")
def keypoints(spark, d):
    """Distinct facts of each page."""
    k = table(spark, d, "pages").select("page_id", T.keypoints(F.col("html")).alias("k"), F.array_sort(T.numbers(F.col("html"))).alias("n"))
    return k.select("page_id", F.size("n").alias("n_numbers"), (F.size("k") - F.size("n")).alias("n_words"), F.array_join("n", ",").alias("numbers"))


@query("SELECT p_partkey, levenshtein(p_name, p_type)::INT AS distance, CASE WHEN levenshtein(p_name, p_type) <= 12 THEN levenshtein(p_name, p_type) ELSE -1 END::INT AS bounded FROM part")
def edit_distance(spark, d):
    """Edit distance of two texts, plain and with an early end."""
    return table(spark, d, "part").select("p_partkey", F.levenshtein("p_name", "p_type").alias("distance"), F.levenshtein("p_name", "p_type", 12).alias("bounded"))


@query("SELECT event_id, regexp_extract(props, '\"k\": *([0-9]+)', 1)::BIGINT AS k, NULLIF(event_type, '') AS kind FROM events")
def json_replies(spark, d):
    """Model-like replies: a JSON object inside prose, and the key: value fallback."""
    e = table(spark, d, "events").select("event_id", F.concat(F.lit("Here is the result:\n"), "props", F.lit("\nDone.")).alias("r"), F.concat(F.lit('kind: "'), "event_type", F.lit('",')).alias("f"))
    return e.select("event_id", T.json_object(F.col("r"), "k bigint")["k"].alias("k"), F.try_element_at(T.key_values(F.col("f")), F.lit("kind")).alias("kind"))


@query(
    f"{N}, l AS (SELECT k, rn, '示例 ' || rn || ' of part ' || p || CASE WHEN p % 3 = 0 THEN '（来源：catalog）' ELSE '' END AS x, p FROM tx), m AS (SELECT k, x, row_number() OVER (PARTITION BY k ORDER BY rn) AS i FROM l WHERE p % 3 <> 0)"
    " SELECT n.k, coalesce(string_agg(left(x, 40), '|' ORDER BY i) FILTER (WHERE i <= 10), '') AS missing FROM n LEFT JOIN m USING (k) GROUP BY n.k"
)
def missing_citations(spark, d):
    """Example lines that name no source, ten a note at most."""
    li = table(spark, d, "lineitem")
    rn = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*rendered.ORDER))
    li = li.select(F.col("l_orderkey").alias("k"), rn.alias("rn"), F.col("l_partkey").alias("p"))
    line = F.concat(F.lit("示例 "), "rn", F.lit(" of part "), "p", F.when(F.col("p") % 3 == 0, "（来源：catalog）").otherwise(""))
    rows = li.select("k", "rn", line.alias("x")).groupBy("k").agg(F.array_sort(F.collect_list(F.struct("rn", "x"))).alias("r"))
    return rows.select("k", F.array_join(T.missing_sources(F.array_join(F.transform("r", lambda x: x["x"]), "\n")), "|").alias("missing"))


@query(f"{N} SELECT file AS target FROM n UNION SELECT 'order_' || k FROM n")
def known_targets(spark, d):
    """What links may point at: file names with and without extension."""
    return corpus.known_targets(_notes(spark, d))


@query(
    f"{N}, o AS (SELECT DISTINCT 'Brand ' || ['A','B','C','D','E'][p % 5 + 1] || ' Line' AS name, k FROM tx WHERE p % 7 <> 0), b AS (SELECT k, name, min(rn) AS a FROM o JOIN tx USING (k) WHERE name = 'Brand ' || ['A','B','C','D','E'][p % 5 + 1] || ' Line' AND p % 7 <> 0 GROUP BY k, name), "
    "c AS (SELECT k, rn, sum(length(note) + 1) OVER (PARTITION BY k ORDER BY rn) AS z FROM tx WHERE p % 7 <> 0) "
    "SELECT n.k, coalesce((SELECT string_agg(name, '|' ORDER BY a) FROM b WHERE b.k = n.k), '') AS bold, true AS has_title FROM n"
)
def concept_map(spark, d):
    """Bold terms of each note, and whether its title is among the breadcrumbs of its chunks."""
    found = segment.concept_map(_notes(spark, d), "k").join(_notes(spark, d).select("k", F.size(T.bold_terms(F.col("text"))).alias("n")), "k")
    return found.select("k", F.array_join(F.slice("terms", 1, F.col("n")), "|").alias("bold"), F.array_contains("terms", F.concat(F.lit("Order "), "k")).alias("has_title"))


@query(
    f"{N}, o AS (SELECT ['A','B','C','D','E'][p % 5 + 1] AS b, k, rn, string_split(note, chr(10))[5] AS line FROM tx WHERE p % 7 <> 0), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY b, k ORDER BY rn) AS i FROM o), g AS (SELECT DISTINCT b FROM o), "
    "u AS (SELECT b, 0 AS section, '' AS file, 0 AS i, '---' || chr(10) || 'type: concept' || chr(10) || 'name: Brand ' || b || ' Line' || chr(10) || '---' || chr(10) || chr(10) || '# Brand ' || b || ' Line' || chr(10) || chr(10) || '## 出现讲次' || chr(10) AS line FROM g "
    "UNION ALL SELECT b, 2, '', 0, chr(10) || '## 摘录定义' || chr(10) FROM g UNION ALL SELECT b, 3, '', 0, chr(10) || '> 概念页由机械抽取打底，可人工完善定义与概念关系。' || chr(10) FROM g "
    "UNION ALL SELECT DISTINCT b, 1, 'order_' || k || '.md', 0, '- [[order_' || k || '.md]]' FROM o UNION ALL SELECT b, 2, 'order_' || k || '.md', i, '- `' || line || '`' FROM r WHERE i <= 3) "
    "SELECT 'brand_' || lower(b) || '_line.md' AS page, 'Brand ' || b || ' Line' AS name, section::INT AS section, file, i::INT AS i, line FROM u"
)
def concept_pages(spark, d):
    """The lines of a rendered page for each concept, with a link for each of its files and its first quotes there."""
    return corpus.concept_pages(_notes(spark, d))


_CHUNKED = f"""{N}, c AS (SELECT k, rn, CASE WHEN rn = 1 THEN '# Order ' || k || chr(10) ELSE '' END || {_BLOCKS} AS t FROM tx),
u AS (SELECT k, rn, t, string_agg('|' || length(t), '') OVER (PARTITION BY k ORDER BY rn) AS s,
  sum(CASE WHEN rn > 1 AND (rn - 1) % 3 = 0 THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY rn) AS unit FROM c)"""
_MORE = "\nand more\nlines\nfor the\nscore\n"


def _third(text: str) -> bool:
    """Whether a chunk is that of every third part."""
    return int(text.split(" > ")[1].split(".")[0]) % 3 == 0


@query(
    f"""{_CHUNKED}, g AS (SELECT k, unit, string_agg(t, chr(10) ORDER BY rn) || repeat('[AI推断]', (k % 2)::INT) || '{_MORE}' || arg_max(s, rn) AS r FROM u GROUP BY k, unit),
o AS (SELECT k, count(*) AS units, string_agg(r, chr(10) || chr(10) ORDER BY unit) AS output FROM g GROUP BY k)
SELECT k, k % 5 <> 0 AS ok, CASE WHEN k % 5 = 0 THEN 'ValueError: order ' || k END AS error, CASE WHEN k % 5 = 0 THEN 0 ELSE units END::INT AS units,
  CASE WHEN k % 5 = 0 THEN 0 ELSE (k % 2) * units END::INT AS inferred, md5(CASE WHEN k % 5 = 0 THEN '' ELSE output END) AS output_md5 FROM o"""
)
def process_notes(spark, d):
    """The whole rewrite with a fixed caller, chunk by chunk: it loses all numbers at first, repairs itself where it is told so, merges what follows every third
    part, marks odd orders, sums up the lengths so far, and fails for every fifth order."""

    def caller(text: str, summary: str, hint: str = ""):
        number = int(text.split("Order ")[1].split()[0])
        if number % 5 == 0:
            raise ValueError(f"order {number}")
        if hint:
            return text + rolling.INFERRED * (number % 2) + _MORE + summary, "", False
        return "nothing", f"{summary}|{len(text)}", _third(text)

    src = rendered.notes(spark, d).select("path", "k", F.col("src").alias("text"))
    done = rolling.process(src.drop("k"), caller, max_chars=160, overlap_chars=0).join(src.select("path", "k"), "path")
    return done.select("k", "ok", "error", "units", "inferred", F.md5("output").alias("output_md5"))


@query(
    f"""{_CHUNKED}, g AS (SELECT k, string_agg(t || '{_MORE}' || s, chr(10) || chr(10) ORDER BY rn) AS output, count(*) AS units FROM u GROUP BY k)
SELECT k, k % 3 <> 0 OR units = 1 AS resumed, units::INT AS units, md5(output) AS output_md5 FROM g"""
)
def resume_notes(spark, d):
    """A rewrite that ends in the middle of every third order, and its second run: what was finished is not asked for again, and the rest goes on behind its last unit."""

    def caller(fails: bool):
        def call(text: str, summary: str, hint: str = ""):
            if fails and int(text.split("Order ")[1].split()[0]) % 3 == 0 and " > 1. part" not in text:
                raise OSError("ended")
            return f"{text}{_MORE}{summary}|{len(text)}", f"{summary}|{len(text)}", False

        return call

    src = rendered.notes(spark, d).select("path", "k", F.col("src").alias("text"))
    state = new_dir(spark, "resume")
    for fails in (True, False):
        done = rolling.process(src.drop("k"), caller(fails), max_chars=160, overlap_chars=0, state=state, task_calls=5000)
    return done.join(src.select("path", "k"), "path").select("k", "resumed", "units", F.md5("output").alias("output_md5"))


@query(f"{N}, m AS (SELECT k, length(note) - length(replace(note, '**Brand', '')) AS d FROM n) SELECT k, (d // 7)::INT AS marks FROM m")
def marker_counts(spark, d):
    """How often a literal mark stands in each note."""
    return _notes(spark, d).select("k", T.count_literal(F.col("text"), "**Brand").cast("int").alias("marks"))


@query(f"{N} SELECT k, md5(note) AS note_md5 FROM n")
def toc_strip(spark, d):
    """Taking the contents block out of a note that got one gives the note back."""
    built = _notes(spark, d).select("k", F.col("text").alias("old"), toc.build(F.col("text"))["text"].alias("new"))
    lean = lambda c: T.strip(F.regexp_replace(c, r"\n+", "\n"))
    same = lean(toc.strip_toc(F.col("new"))) == lean(F.col("old"))
    return built.select("k", F.when(same, F.md5("old")).otherwise("changed").alias("note_md5"))


@query(
    f"{N}, c AS (SELECT k, src, note, {_facts('src')[0]} AS s, {_facts('note')[0]} AS t, list_filter(string_split(note, chr(10)), lambda x: trim(x) <> '') AS ls FROM n), "
    "g AS (SELECT k, len(s) AS total, len(list_filter(s, lambda x: len(list_filter(t, lambda y: contains(y, x))) = 0)) AS miss, ls FROM c), "
    "q AS (SELECT k, total, miss, ls, round_even(CASE WHEN total = 0 THEN 1.0 ELSE 1.0 - miss / total END, 3) AS cov FROM g), "
    "z AS (SELECT *, greatest(0.0, least(100.0, round_even(40 + 20 + CASE WHEN len(ls) >= 5 THEN 20 ELSE 0 END + CASE WHEN len(list_filter(ls, lambda x: length(x) <= 1 AND NOT regexp_matches(x, '[一-鿿A-Za-z0-9]'))) > 0 THEN 10 ELSE 20 END + (cov - 0.9) * 100, 1))) AS score FROM q) "
    "SELECT k, score::DOUBLE AS score, ((total = 0 OR 1.0 - miss / total >= 0.9) AND score >= 80) AS pass FROM z"
)
def check_notes(spark, d):
    """The combined check of every rendered pair: facts, score, emptiness."""
    c = rendered.notes(spark, d).select("k", quality.check(F.col("src"), F.col("note")).alias("c"))
    return c.select("k", "c.score", "c.pass")
