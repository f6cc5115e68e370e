"""Tables of contents inside notes, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from notewarden.functions import text as T

# --- fixed values ---
TITLE = "📑 本篇目录"
HEADING = r"^(#{1,4})\s+(.+?)\s*$"
# --- end of fixed values ---


def headings(c: Column) -> Column:
    """array(level, title) of the headings of level 1 to 4 outside frontmatter, code fences and an existing contents block.

    Fence lines cut a text into parts, of which every second one is code; a contents block goes up to the next heading, so its own title is
    all that it hides."""
    return _headings(T.body_lines(c))


def _headings(body: Column) -> Column:
    def prose(ls: Column) -> Column:
        parts = F.filter(F.split(F.array_join(ls, "\n"), r"(?m)^```[^\n]*(?:\n|\z)", -1), lambda _, i: i % 2 == 0)
        return F.when(F.exists(ls, lambda x: x.startswith("```")), F.split(F.array_join(parts, "\n"), "\n")).otherwise(ls)

    listed = lambda x: x.startswith("#") & F.regexp_like(x, F.lit(HEADING)) & ~F.contains(x, F.lit(TITLE))
    one = lambda x: F.struct(F.length(F.regexp_extract(x, HEADING, 1)).alias("level"), T.strip(F.regexp_extract(x, HEADING, 2)).alias("title"))
    asked = F.filter(body, lambda x: F.contains(x, F.lit("#")) | F.contains(x, F.lit("```")))
    return F.transform(F.filter(T.let(F.transform(asked, T.strip), prose), listed), one)


def render(heads: Column) -> Column:
    """The contents block of array(level, title), empty for none."""

    def block(hs: Column) -> Column:
        base = F.array_min(hs["level"])
        item = lambda h, b: F.concat(F.repeat(F.lit("  "), h["level"] - b), F.lit("- ["), h["title"], F.lit("](#"), T.slug(h["title"]), F.lit(")"))
        items = T.let(base, lambda b: F.transform(hs, lambda h: item(h, b)))
        return F.when(F.size(hs) > 0, F.concat(F.lit(f"## {TITLE}\n\n"), F.array_join(items, "\n"), F.lit("\n\n---\n"))).otherwise(F.lit(""))

    return T.let(heads, block)


def _is_title(x: Column) -> Column:
    return F.contains(x, F.lit(TITLE)) & T.strip(x).startswith("##")


def has_toc(c: Column) -> Column:
    return F.contains(T.text(c), F.lit(TITLE)) & F.exists(T.lines(c), _is_title)


def _cut(ls: Column) -> Column:
    """Lines without the contents block that they hold."""
    at = F.array_position(F.transform(ls, _is_title), True).cast("int")

    def block_end(rest: Column) -> Column:
        foreign = F.array_position(F.transform(rest, lambda x: ~((x == "") | x.startswith("- ["))), True).cast("int")
        return T.let(foreign, lambda n: F.when(n == 0, F.size(rest)).when(F.get(rest, n - 1) == "---", n).otherwise(n - 1))

    def blanks(rest: Column) -> Column:
        first = F.array_position(F.transform(rest, lambda x: x != ""), True).cast("int")
        return T.let(first, lambda n: F.when(n == 0, F.size(rest)).otherwise(n - 1))

    def without(a: Column) -> Column:
        tail = F.transform(T.after(ls, a), T.strip)
        gone = T.let(tail, lambda r: T.let(block_end(r), lambda n: n + blanks(T.after(r, n))))
        return F.concat(F.slice(ls, 1, a - 1), T.after(ls, a + gone))

    return T.let(at, without)


def strip_toc(c: Column) -> Column:
    """Without the contents block: its title, entries and blank lines, its closing rule and the blank lines after that."""
    return F.when(has_toc(c), F.array_join(T.let(T.lines(c), _cut), "\n")).otherwise(T.text(c))


def _insert(text: Column, heads: Column, front: Column) -> Column:
    """The text with the contents block of its headings; front is the number of its frontmatter's lines."""

    def place(ls: Column, front: Column) -> Column:
        body = T.after(ls, front)
        at = lambda some: F.nullif(F.array_position(F.transform(some, lambda x: T.strip(x) != ""), True).cast("int"), F.lit(0))
        first = F.coalesce(at(F.slice(body, 1, T.HEAD_LINES)), at(body), F.lit(0))
        main = lambda n: (n > 0) & F.regexp_like(T.strip(F.coalesce(F.get(ls, front + n - 1), F.lit(""))), F.lit(r"^#\s+"))
        return T.let(first, lambda n: F.when(main(n), front + n).otherwise(front))

    def joined(ls: Column) -> Column:
        return T.let(place(ls, front), lambda n: F.array_join(F.concat(F.slice(ls, 1, n), F.array(render(heads)), T.after(ls, n)), "\n"))

    return T.let(T.lines(text), joined)


def build(c: Column, refresh: bool = False, listed_too: bool = True) -> Column:
    """struct(text, headings): with a contents block after the frontmatter or a leading main heading.

    A text that has one stays as it is unless refresh is set; the main heading itself is not listed.  Without listed_too only the text is asked for, and
    headings of a text that stays are not looked up."""
    none = F.array().cast("array<struct<level:int,title:string>>")
    listed = lambda hs: F.when(F.get(hs, 0)["level"] == 1, T.after(hs, F.lit(1))).otherwise(hs)
    pair = lambda text, hs: F.struct(text.alias("text"), hs.alias("headings"))

    def made(text: Column) -> Column:
        new = lambda hs, front: pair(F.when(F.size(hs) > 0, _insert(text, hs, front)).otherwise(text), hs)
        of_lines = lambda ls, front: T.let(T.let(_headings(T.after(ls, front)), listed), lambda hs: new(hs, front))
        return T.let(T.lines(T.without_bom(text)), lambda ls: T.let(T._front_end(ls), lambda front: of_lines(ls, front)))

    def of(bare: Column) -> Column:
        stays = F.lit(False) if refresh else has_toc(bare)
        return F.when(stays, pair(bare, headings(bare) if listed_too else none)).otherwise(T.let(strip_toc(bare), made))

    return F.when(T.is_blank(c), pair(T.text(c), none)).otherwise(T.let(T.without_bom(c), of))
