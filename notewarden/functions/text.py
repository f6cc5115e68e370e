"""Column expressions over Markdown text.

All are built-in functions, so they stay inside the JVM and fuse with the scan.  Text semantics that engines
disagree on are settled here once: line ends, Unicode white space, anchors that see ``\\n`` only, half-even rounding.
Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the document conventions that results have to follow ---
LINE_END = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\x{2028}\x{2029}]"
#: Line ends besides \n.
RARE_ENDS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
SPACE = r"[\s\x1C-\x1F\x85\p{Z}]"
#: The characters of SPACE.
SPACES = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
HASH_HEADING = r"^(#{1,6})\s+(.+?)\s*$"
ORDINAL_HEADING = r"^第[一二三四五六七八九十百0-9]+\s*[章讲节篇课部分]"
WORD_HEADINGS = (
    "绪论 引言 概述 小结 总结 结语 结论 复习 练习 习题 作业 思考题 案例 举例 例题 定义 原理 概念 特点 分类 作用 意义 目标"
    " 重点 难点 拓展 延伸 参考资料 学习目标 随堂测验 课后作业 实战演练 知识拓展 温馨提示 注意事项 常见问题 易错点 预习 导入 导学"
).split()
PLAIN_HEADING_MAX = 30
TOKEN = r"[A-Za-z]+|\d+(?:\.\d+)?|[一-鿿]{2,}"
LINK = r"\[\[([^\]|#]+)(?:#[^\]|]+)?(?:\|[^\]]+)?\]\]"
BOLD_TERM = r"\*\*([A-Za-z][A-Za-z0-9\-. ]{2,})\*\*"
MARKS = r"[#*`|>\-\[\]()]"
FRONT_LINE = r"^([A-Za-z_]\w*)\s*:\s*(.+?)\s*$"
TOC_LINK = r"^[-*]\s+\[.+\]\(#.+\)"
QUERY_SPLIT = r"[\s,，。;；:：、.!！?？\"'“”‘’()（）\[\]【】《》<>]+"
SUMMARY_MAX = 60
KEY_VALUE = r"^\s*[\"']?([\w一-鿿]+)[\"']?\s*[:：]\s*(.+?)\s*$"
# --- end of fixed values ---

NO_TEXTS = "array<string>"
HEAD_LINES = 8


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once for each row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def after(a: Column, n: Column) -> Column:
    """The elements of an array behind the first n."""
    return F.slice(a, n + 1, F.greatest(F.size(a), F.lit(1)))


def lines(c: Column) -> Column:
    """The lines of a text; a final line end opens no further line.

    A split at a single letter is no regular expression, and most texts need no other."""
    rare = lambda x: reduce(lambda a, b: a | b, [F.contains(x, F.lit(e)) for e in RARE_ENDS])
    parts = lambda x: F.when(rare(x), F.split(x, LINE_END, -1)).otherwise(F.split(x, "\n", -1))
    return let(let(text(c), parts), lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, 1, F.size(p) - 1)).otherwise(p))


def strip(c: Column) -> Column:
    """Without white space (of any script) at both ends."""
    return F.btrim(c, F.lit(SPACES))


def is_blank(c: Column) -> Column:
    return ~F.regexp_like(text(c), F.lit(r"[^\s\x1C-\x1F\x85\p{Z}]"))


def texts() -> Column:
    return F.array().cast(NO_TEXTS)


def round_even(c: Column, digits: int) -> Column:
    return F.bround(c, digits)


def all_matches(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text(c), F.lit(pattern), F.lit(group))


def count_matches(c: Column, pattern: str) -> Column:
    return F.regexp_count(text(c), F.lit(pattern))


def without_bom(c: Column) -> Column:
    return F.ltrim(text(c), F.lit("\ufeff"))


# headings


def heading(line: Column) -> Column:
    """struct(level, title) of a heading line, else null: hash headings, ordinal ones, and listed words."""
    hashes = F.when(line.startswith("#"), F.regexp_extract(line, HASH_HEADING, 1)).otherwise("")

    def plain(bare: Column) -> Column:
        named = F.regexp_like(bare, F.lit(ORDINAL_HEADING)) | bare.isin(WORD_HEADINGS)
        return F.when((F.length(bare) <= PLAIN_HEADING_MAX) & named, F.struct(F.lit(2).alias("level"), bare.alias("title")))

    marked = F.struct(F.length(hashes).alias("level"), strip(F.regexp_extract(line, HASH_HEADING, 2)).alias("title"))
    return F.when(hashes != "", marked).otherwise(let(strip(line), plain))


def _is_rule(x: Column) -> Column:
    return F.contains(x, F.lit("---")) & (strip(x) == "---")


def _front_end(ls: Column) -> Column:
    """Number of lines of a closed frontmatter block, else 0."""
    close = F.array_position(F.transform(F.slice(ls, 2, F.greatest(F.size(ls), F.lit(1))), _is_rule), True).cast("int")
    opened = F.coalesce(_is_rule(F.get(ls, 0)), F.lit(False))
    return F.when(opened, let(close, lambda n: F.when(n > 0, n + 1).otherwise(0))).otherwise(F.lit(0))


def front_end(c: Column) -> Column:
    """1-based number of the line that closes the frontmatter, 0 without one."""
    return let(lines(without_bom(c)), _front_end)


def body_lines(c: Column) -> Column:
    return let(lines(without_bom(c)), lambda ls: after(ls, _front_end(ls)))


def skip_frontmatter(c: Column) -> Column:
    bare = without_bom(c)
    return let(lines(bare), lambda ls: let(_front_end(ls), lambda n: F.when(n > 0, F.array_join(after(ls, n), "\n")).otherwise(bare)))


def frontmatter(c: Column) -> Column:
    """map(key -> struct(is_list, items)); the last of equal keys wins; an open block goes on to the end."""
    # lines behind a closing rule say nothing, so they are not told apart
    closed = lambda x: let(F.locate("\n---\n", x), lambda at: F.when(at > 0, F.left(x, at + 4)).otherwise(x))
    return let(lines(let(without_bom(c), closed)), lambda ls: let(_front_end(ls), lambda n: _frontmatter(ls, n)))


def _frontmatter(ls: Column, n: Column) -> Column:
    own = F.slice(ls, 2, F.when(n > 0, n - 2).otherwise(F.size(ls)))
    inner = F.when(F.coalesce(_is_rule(F.get(ls, 0)), F.lit(False)), own).otherwise(texts())
    kept = F.filter(inner, lambda x: F.regexp_like(x, F.lit(FRONT_LINE)))
    pairs = F.transform(kept, lambda x: F.struct(F.regexp_extract(x, FRONT_LINE, 1).alias("k"), F.regexp_extract(x, FRONT_LINE, 2).alias("v")))
    return F.map_from_entries(F.transform(let(pairs, lambda p: last_of_each(p)), lambda p: F.struct(p["k"], _front_value(p["v"]))))


def one_of_each(elements: Column, name: str, last: bool = False) -> Column:
    """Of array elements with an equal field the first, or the last, in the order of the array; by one sort."""

    def ends(s: Column) -> Column:
        beside = lambda x, i: F.coalesce(F.get(s, i + (1 if last else -1))["k"] != x["k"], F.lit(True))
        return F.filter(s, beside)

    keyed = F.sort_array(F.transform(elements, lambda x, i: F.struct(x[name].alias("k"), i.alias("i"))))
    places = F.sort_array(F.transform(let(keyed, ends), lambda x: x["i"]))
    return let(elements, lambda e: F.transform(places, lambda i: F.get(e, i)))


def last_of_each(pairs: Column, name: str = "k") -> Column:
    return one_of_each(pairs, name, last=True)


def _front_value(v: Column) -> Column:
    quoted = lambda x: F.regexp_replace(strip(x), "^[\"']+|[\"']+\\z", "")
    is_list = v.startswith("[") & v.endswith("]")
    items = F.filter(F.transform(F.split(F.substring(v, F.lit(2), F.length(v) - 2), ","), quoted), lambda x: x != "")
    return F.struct(is_list.alias("is_list"), F.when(is_list, items).otherwise(F.array(quoted(v))).alias("items"))


def front_scalar(front: Column, key: str) -> Column:
    """A scalar entry's value, null if it is absent or a list."""
    return let(F.try_element_at(front, F.lit(key)), lambda e: F.when(~e["is_list"], F.get(e["items"], 0)))


def first_of(ls: Column, fits: Callable[[Column], Column]) -> Column:
    """The first stripped line that fits, null for none; the lines behind the first few are looked at only if none of these fits."""
    hit = lambda some: F.get(F.filter(F.transform(some, strip), fits), 0)
    return F.coalesce(hit(F.slice(ls, 1, HEAD_LINES)), hit(after(ls, F.lit(HEAD_LINES))))


def is_hashed(x: Column) -> Column:
    return x.startswith("#") & F.regexp_like(x, F.lit(HASH_HEADING))


def first_heading(c: Column) -> Column:
    return _first_heading(body_lines(c))


def _first_heading(body: Column) -> Column:
    return let(first_of(body, is_hashed), lambda x: F.coalesce(strip(F.regexp_extract(x, HASH_HEADING, 2)), F.lit("")))


def summary_line(c: Column, most: int = SUMMARY_MAX) -> Column:
    return _summary_line(body_lines(c), most)


def _summary_line(body: Column, most: int = SUMMARY_MAX) -> Column:
    entry = lambda x: (x.startswith("-") | x.startswith("*")) & F.regexp_like(x, F.lit(TOC_LINK))
    plain = lambda x: (x != "") & ~is_hashed(x) & ~x.isin("---", ">") & ~entry(x)
    return F.coalesce(F.left(first_of(body, plain), F.lit(most)), F.lit(""))


def clean_summary(front: Column, c: Column) -> Column:
    """The description of the frontmatter if there is one, else the summary line, without its label and bold marks."""
    return _clean_summary(front, summary_line(c))


def _clean_summary(front: Column, line: Column) -> Column:
    own = F.nullif(front_scalar(front, "description"), F.lit(""))
    return F.regexp_replace(F.regexp_replace(F.coalesce(own, line), r"^>\s*一句话总结[:：]\s*", ""), r"\*\*", "")


def head(c: Column) -> Column:
    """struct(front, front_end, heading, summary) of a note whose lines are told apart once: frontmatter, front_end, first_heading and clean_summary."""

    def fields(ls: Column, n: Column) -> Column:
        return let(_frontmatter(ls, n), lambda front: let(after(ls, n), lambda body: F.struct(
            front.alias("front"), n.alias("front_end"), _first_heading(body).alias("heading"), _clean_summary(front, _summary_line(body)).alias("summary"),
        )))

    return let(lines(without_bom(c)), lambda ls: let(_front_end(ls), lambda n: fields(ls, n)))


# facts, terms, links


def keypoints(c: Column) -> Column:
    """Distinct facts: English words of three letters or more in lower case, numbers of 2 to 9 digits."""
    return F.concat(numbers(c), words(c))


def words(c: Column) -> Column:
    """Distinct English words of three letters or more in lower case: the runs of letters among the tokens."""
    return F.array_distinct(F.transform(F.array_distinct(all_matches(c, "[A-Za-z]{3,}")), F.lower))


def numbers(c: Column) -> Column:
    """Distinct numbers of 2 to 9 digits; no other token takes a digit or a point from them."""
    digits = lambda t: F.length(t) - F.contains(t, F.lit(".")).cast("int")
    return F.filter(F.array_distinct(all_matches(c, r"\d+(?:\.\d+)?")), lambda t: digits(t).between(2, 9))


def is_number(t: Column) -> Column:
    return F.regexp_like(t, F.lit(r"^\d"))


def links(c: Column) -> Column:
    """Targets of [[target#anchor|label]], repeats kept."""
    return F.transform(all_matches(c, LINK, 1), strip)


def bold_terms(c: Column) -> Column:
    """Bold Latin terms in order; of equal spellings (without regard to case) the first stays."""
    found = F.transform(all_matches(c, BOLD_TERM, 1), lambda t: F.struct(strip(t).alias("t"), F.lower(strip(t)).alias("low")))
    return F.transform(let(found, lambda all_: one_of_each(all_, "low")), lambda t: t["t"])


def query_words(q: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(text(q)), QUERY_SPLIT), lambda w: w != ""))


def contexts(c: Column, concept: Column, most: int = 3, longest: int = 200) -> Column:
    """The first lines that name a concept."""
    return line_contexts(F.transform(lines(c), strip), concept, most, longest)


def line_contexts(stripped: Column, concept: Column, most: int = 3, longest: int = 200) -> Column:
    """The first of the stripped lines that name a concept."""
    fits = lambda x: F.length(x).between(1, longest) & F.contains(F.lower(x), F.lower(concept))
    return F.slice(F.filter(stripped, fits), 1, most)


def speech(c: Column) -> Column:
    """The speech lines of a time-coded transcript, or the whole text where it has none."""
    said = all_matches(c, r"\[\d+:\d+\] 🎤 (.+)", 1)
    return let(said, lambda s: F.when(F.size(s) > 0, F.array_join(s, "\n")).otherwise(text(c)))


def slug(title: Column) -> Column:
    """Anchor of a heading: lower case, punctuation deleted, every space a hyphen."""
    return F.translate(F.regexp_replace(F.lower(strip(title)), "(?U)[^\\w一-鿿 -]", ""), " ", "-")


# sizes


def content_length(c: Column) -> Column:
    """Characters without frontmatter, Markdown marks and white space."""
    body = F.when(text(c).startswith("---"), F.regexp_replace(text(c), r"(?s)\A---\n.*?\n---\n", "")).otherwise(text(c))
    return F.length(F.regexp_replace(body, rf"{MARKS}|{SPACE}", ""))


def ratio(note: Column, source: Column) -> Column:
    return let(content_length(source), lambda n: F.when(n == 0, F.lit(0.0)).otherwise(content_length(note) / n))


def carry_chars(c: Column) -> Column:
    """Characters of lines inside code fences and of table rows outside."""
    ls = F.transform(lines(c), strip)
    start = F.struct(F.lit(False).alias("code"), F.lit(0).alias("n"))

    def step(s: Column, x: Column) -> Column:
        fence = x.startswith("```")
        counted = ~fence & (s["code"] | x.startswith("|"))
        return F.struct((s["code"] != fence).alias("code"), (s["n"] + F.when(counted, F.length(x)).otherwise(0)).alias("n"))

    return F.aggregate(ls, start, step, lambda s: s["n"])


def note_points(c: Column) -> Column:
    return count_matches(c, r"(?md)^#{2,3} ")


def source_sections(c: Column) -> Column:
    numbered = count_matches(c, r"(?md)^## \d+[.\d]*[ ，,．.、]")
    return F.when(numbered > 0, numbered).otherwise(count_matches(c, r"(?md)^## "))


def numbered_sections(c: Column, pattern: str) -> Column:
    """array(num, size) of the sections that a numbered heading opens, each up to the next such heading; num is a text of digits."""
    own = F.filter(F.split(text(c), rf"(?md)(?={pattern})"), lambda p: F.regexp_like(p, F.lit(rf"(?md)\A{pattern}")))
    return F.transform(own, lambda p: F.struct(_digits(F.regexp_extract(p, rf"(?md)\A{pattern}", 1)).alias("num"), content_length(p).alias("size")))


def _digits(c: Column) -> Column:
    """A number of any length without leading zeros, so that equal numbers are equal texts."""
    return F.regexp_replace(c, r"^0+(?=\d)", "")


SOURCE_UNIT = r"^##\s*(\d+)[.\d]*[ ，,．.、]"
NOTE_UNIT = r"^###\s*(?:知识点\s*)?(\d+)\s*·"
UNIT_MIN = 50


def source_units(c: Column, least: int = UNIT_MIN) -> Column:
    return F.filter(numbered_sections(c, SOURCE_UNIT), lambda u: u["size"] > least)


def unit_ratios(source: Column, note: Column, least: int = UNIT_MIN) -> Column:
    """Note size over source size of the units that both have; of units with one number the last counts."""
    theirs = let(numbered_sections(note, NOTE_UNIT), lambda u: last_of_each(u, "num"))
    ours = F.filter(let(numbered_sections(source, SOURCE_UNIT), lambda u: last_of_each(u, "num")), lambda u: u["size"] > least)
    by_num = lambda t: F.map_from_entries(F.transform(t, lambda u: F.struct(u["num"], u["size"])))
    sizes = lambda m: F.transform(ours, lambda u: F.try_element_at(m, u["num"]) / u["size"])
    return F.array_compact(let(by_num(theirs), sizes))


def upper_median(values: Column) -> Column:
    """The element at size // 2 of the sorted values, null for none."""
    return let(F.array_sort(values), lambda v: F.get(v, F.floor(F.size(v) / 2).cast("int")))


# cleaning


def scrub_meta(c: Column) -> Column:
    """Dates, section numbers and long decimals as a space."""
    out = F.regexp_replace(text(c), r"\d{4}-\d{2}-\d{2}", " ")
    out = F.regexp_replace(out, r"\b\d{1,2}\.\d{1,2}\b", " ")
    return F.regexp_replace(out, r"\b\d{3,}\.\d{1,3}\b", " ")


def missing_sources(c: Column, most: int = 10, longest: int = 40) -> Column:
    """Example lines that name no source."""
    example = lambda x: F.regexp_like(x, F.lit("示例|原句|例如"))
    odd = lambda x: example(x) & ~F.regexp_like(x, F.lit("[（(]来源[:：]"))
    found = F.slice(F.transform(F.filter(F.transform(lines(c), strip), odd), lambda x: F.left(x, F.lit(longest))), 1, most)
    return F.when(example(text(c)), found).otherwise(texts())


def count_literal(c: Column, literal: str) -> Column:
    return count_matches(c, r"\Q" + literal + r"\E")


def natural_key(name: Column) -> Column:
    """Sort key of file names: names with numbers first, by their numbers (of any length), then by name."""
    nums = F.transform(F.regexp_extract_all(name, F.lit(r"(\d+)"), F.lit(1)), lambda x: F.struct(F.length(_digits(x)).alias("n"), _digits(x).alias("d")))
    return F.struct((F.size(nums) == 0).alias("plain"), nums.alias("nums"), name.alias("name"))


def json_object(c: Column, schema: str) -> Column:
    """The first JSON object in a reply; raw line breaks inside its strings are accepted."""
    return F.from_json(F.regexp_extract(text(c), r"(?s)\{.*\}", 0), schema, {"allowUnquotedControlChars": "true"})


def key_values(c: Column) -> Column:
    """map of ``key: value`` lines, the fallback for replies without JSON."""
    own = F.filter(lines(c), lambda x: F.regexp_like(x, F.lit(KEY_VALUE)))
    value = lambda x: F.regexp_replace(F.regexp_extract(x, KEY_VALUE, 2), "^[\"',]+|[\"',]+\\z", "")
    pairs = F.transform(own, lambda x: F.struct(F.regexp_extract(x, KEY_VALUE, 1).alias("k"), value(x).alias("v")))
    return F.map_from_entries(let(pairs, lambda p: last_of_each(p)))
