"""Golden values of the column expressions."""

import pytest
from pyspark.sql import functions as F

from notewarden.functions import text as T
from notewarden.operators import filters, toc


def value(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t")).alias("x")).first()["x"]


def pair(spark, a, b, column):
    return spark.createDataFrame([(a, b)], "a string, b string").select(column(F.col("a"), F.col("b")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "want"),
    [("a\nb\n", ["a", "b"]), ("a\r\nb\rc", ["a", "b", "c"]), ("a\x0bb\x85c\u2028d", ["a", "b", "c", "d"]), ("", []), (None, []), ("\n", [""]), ("a\n\nb", ["a", "", "b"])],
)
def test_lines(spark, text, want):
    assert value(spark, text, T.lines) == want


@pytest.mark.parametrize("space", ["\t", "\xa0", "\u3000", "\x85", "\x1c", " \n"])
def test_strip(spark, space):
    assert value(spark, f"{space}a b{space}", T.strip) == "a b"


@pytest.mark.parametrize(
    ("line", "want"),
    [
        ("## 二级  ", (2, "二级")),
        ("#no", None),
        ("第1章 绪论", (2, "第1章 绪论")),
        ("  总结 ", (2, "总结")),
        ("第1章 " + "长" * 30, None),
        ("1.2 节", None),
        ("####### x", None),
        ("", None),
    ],
)
def test_heading(spark, line, want):
    got = value(spark, line, T.heading)
    assert (tuple(got) if got else None) == want


def test_keypoints(spark):
    assert set(value(spark, "这里是一下 3000 其实 Python 说明", T.keypoints)) == {"python", "3000"}
    kept = set(value(spark, "端口 0 版本 3 版本 3.12 端口 300 视频ID 7657102214691634809 ab", T.keypoints))
    assert kept == {"3.12", "300"}


def test_content_length(spark):
    assert value(spark, "# 标题\n\n- **加粗**：内容\n", T.content_length) == len("标题加粗：内容")
    assert value(spark, "---\na: b\n---\nxy", T.content_length) == 2
    assert value(spark, None, T.content_length) == 0
    assert pair(spark, "a", "", T.ratio) == 0.0


def test_sections(spark):
    assert value(spark, "## 1，题A\n\n## 3, 题B\n", T.source_sections) == 2
    assert value(spark, "## a\n## b\n", T.source_sections) == 2
    long = "x" * 60
    units = value(spark, f"## 1. a\n{long}\n## 2. b\nshort\n## 3.1 c\n{long}", T.source_units)
    assert [u["num"] for u in units] == ["1", "3"]
    assert pair(spark, f"## 1. a\n{long}\n", f"### 1 · a\n{long}{long}\n", T.unit_ratios) == pytest.approx([122 / 63], rel=0.05)
    assert pair(spark, f"## 3.1 a\n{long}\n## 3.2 b\n{long}{long}\n", f"### 3 · a\n{long}\n", T.unit_ratios)[0] < 0.6  # the last of equal numbers counts


def test_upper_median(spark):
    df = spark.createDataFrame([([0.4, 0.1, 0.3, 0.2],), ([],)], "v array<double>")
    assert [r.m for r in df.select(T.upper_median(F.col("v")).alias("m")).collect()] == [0.3, None]


def test_links(spark):
    text = "[[01_第1讲.md#变量|变量]]、[[02_第2讲.md]]、[[03_第3讲.md|循环]] [[02_第2讲.md]]"
    assert value(spark, text, T.links) == ["01_第1讲.md", "02_第2讲.md", "03_第3讲.md", "02_第2讲.md"]


def test_terms(spark):
    text = "**Hidden Markov Model** and **hidden markov model**, **Baum-Welch**, **ab**"
    assert value(spark, text, T.bold_terms) == ["Hidden Markov Model", "Baum-Welch"]


def test_query_words(spark):
    assert value(spark, "隐 Markov,隐 Markov", T.query_words) == ["隐", "markov"]


def test_frontmatter(spark):
    text = "---\ntitle: 'A'\ntags: [PDF, Scrapy, 教程]\nempty:\ntitle: B\n---\n# H\n\nFirst line\n"
    got = value(spark, text, T.frontmatter)
    assert got["title"]["items"] == ["B"] and not got["title"]["is_list"]
    assert got["tags"]["items"] == ["PDF", "Scrapy", "教程"] and got["tags"]["is_list"]
    assert "empty" not in got
    assert value(spark, text, T.front_end) == 6
    assert value(spark, text, T.first_heading) == "H"
    assert value(spark, text, T.summary_line) == "First line"
    assert value(spark, "﻿---\na: b\nc: d", T.frontmatter).keys() == {"a", "c"}  # an open block goes on to the end
    assert value(spark, "---\na: b\nc: d", T.skip_frontmatter) == "---\na: b\nc: d"
    assert value(spark, None, T.frontmatter) == {}


def test_slug(spark):
    assert value(spark, "知识点 2.1 · IP 地址与子网掩码：网段怎么判断", T.slug) == "知识点-21--ip-地址与子网掩码网段怎么判断"


def test_speech(spark):
    assert value(spark, "[00:00] 🎤 第一句。\n[00:02] 📷 图\n[00:05] 🎤 第二句。", T.speech) == "第一句。\n第二句。"
    assert value(spark, "plain", T.speech) == "plain"


def test_carry(spark):
    assert value(spark, "a\n```\ncode\n| x |\n```\n| row |\n", T.carry_chars) == 4 + 5 + 7


def test_scrub_and_sources(spark):
    assert value(spark, "on 2024-01-02 see 1.2 and 3.141 and 123.45", T.scrub_meta).split() == ["on", "see", "and", "3.141", "and"]
    assert value(spark, "示例：x\n例如 y（来源：书）\n无", T.missing_sources) == ["示例：x"]


def test_natural_order(spark):
    df = spark.createDataFrame([(x,) for x in ["第10讲.md", "第2讲.md", "b.md", "a.md"]], "f string")
    assert [r.f for r in df.orderBy(T.natural_key(F.col("f"))).collect()] == ["第2讲.md", "第10讲.md", "a.md", "b.md"]


def test_json_replies(spark):
    assert value(spark, 'x {"score": 5, "t": "a\nb"} y', lambda c: T.json_object(c, "score int, t string"))["score"] == 5
    assert value(spark, "score: 7\nreason：ok,", T.key_values) == {"score": "7", "reason": "ok"}


NOTE = "---\na: b\n---\n# Main\n\n## 一 A\ntext\n```\n# code\n```\n### B\n##### deep\n"


def test_toc(spark):
    heads = [tuple(h) for h in value(spark, NOTE, toc.headings)]
    assert heads == [(1, "Main"), (2, "一 A"), (3, "B")]
    once = value(spark, NOTE, toc.build)["text"]
    assert once.startswith("---\na: b\n---\n# Main\n## 📑 本篇目录\n\n- [一 A](#一-a)\n  - [B](#b)\n\n---\n\n")
    assert value(spark, once, toc.build)["text"] == once
    fresh = value(spark, once, lambda c: toc.build(c, refresh=True))["text"]
    assert fresh == once.replace("---\n\n\n##", "---\n\n##") and value(spark, fresh, lambda c: toc.build(c, refresh=True))["text"] == fresh
    assert value(spark, once, toc.strip_toc) == NOTE.replace("# Main\n\n", "# Main\n").rstrip("\n")
    assert value(spark, "no headings", toc.build)["text"] == "no headings"
    assert value(spark, None, toc.build)["text"] == ""
    foreign = "## 📑 本篇目录\n- [x](#x)\n> quote\n## x\n"
    assert value(spark, foreign, toc.strip_toc) == "> quote\n## x"


def test_filters(spark):
    text = "keep 1\n## 插图笔记：a\n## 图片内容（OCR）\n6350\n## GLM 画面理解\n6250\n## Next\nsee http://a.b/c now\n### References\n12\n"
    assert value(spark, text, filters.strip_nonprose).rstrip() == "keep 1\n## Next\nsee   now"
    got = value(spark, text, filters.drop_figures)
    assert (got["figures"], got["ocr"], got["readings"]) == (1, 1, 1)
    assert "6350" not in got["text"] and "6250" not in got["text"]
    assert "6250" in value(spark, text, lambda c: filters.drop_figures(c, keep_reading=True))["text"]


def test_line_filter(spark):
    rules = filters.LineRules(noise_first=("noise",), noise_last=(r"\d{5}",), short_line=10, anchored="key", skip=(("## 2", "## 3"),), drop_fragments=True)
    text = "## 1\nkey = 1\n中文 noise\n中文行很好\n碎片\n## 2\nkey lost\n## 3\nshort\n12345\na very long line of nothing\n"
    docs = spark.createDataFrame([("d", text), ("e", "")], "doc string, text string")
    rows = {r.doc: r for r in filters.filter_lines(docs, rules).collect()}
    assert rows["d"].text == "## 1\nkey = 1\n中文行很好\n## 3\nshort"
    assert rows["d"].kept == 5
