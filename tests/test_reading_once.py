"""Texts are written, moved and read no more often than a result needs, and mean the same when they are told apart faster."""

import re

import pytest
from oracle import SF
from pyspark.sql import functions as F

from notewarden.functions import text as T
from notewarden.operators import corpus, quality, toc
from notewarden.plans import registry, rendered

ODD = ["", " ", "\n", "---", "---\na: 1\n---", "---\na: 1\n --- \nb: 2\n---\n# H", "---\r\na: 1\r\n---\r\n# H\r\n", "﻿---\ntitle: x\n---\nbody", "---\na: 1\nno end", "x\n---\na: 1\n---\n", "---\n---\n\n#  A \n", "a b\x85c\x1cd\n", "　---　\nk: v\n---x\n---\n"]


def test_rendered_notes_move_numbers_only(spark):
    plan = registry.queries()["toc_insert"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange") :]
    assert "Ordered" not in below and "was ordered" not in plan and plan.count("Exchange") == 1
    assert dict(rendered.rows(spark, SF).dtypes)["r"].startswith("array<struct<l_linenumber")


@pytest.mark.parametrize("check", [lambda n: corpus.relation_check(n, n.select(F.col("file").alias("target"))), corpus.validation])
def test_checks_read_texts_once(spark, check):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(x):
        read.add(1)
        return x

    notes = spark.createDataFrame([(f"n/{i}.md", f"{i}.md", f"---\nnext: {i + 1}.md\n---\n[[{i + 2}.md]]\n") for i in range(5)], "path string, file string, text string")
    assert check(notes.withColumn("text", seen.asNondeterministic()("text"))).count() == 5
    assert read.value == 5


def test_strip_and_lines_of_odd_texts(spark):
    every = [chr(i) for i in range(0x3100) if re.fullmatch(r"[\s\x1c-\x1f\x85]", chr(i))]
    rows = [(f"{a}x{a}y{a}{b}",) for a in every for b in ("", " ")] + [(x,) for x in ODD]
    df = spark.createDataFrame(rows, "t string")
    old = F.regexp_replace("t", f"^{T.SPACE}+|{T.SPACE}+\\z", "")
    cut = F.split("t", T.LINE_END, -1)
    ls = F.when(F.element_at(cut, -1) == "", F.slice(cut, 1, F.size(cut) - 1)).otherwise(cut)
    assert df.where((T.strip(F.col("t")) != old) | (T.lines(F.col("t")) != ls)).count() == 0


def test_head_is_its_parts(spark):
    df = spark.createDataFrame([(x,) for x in [*ODD, "\n" * 20 + "text\n# late", "---\ndescription: d\n---\n# H\n"]], "t string")
    t, h = F.col("t"), T.head(F.col("t"))
    front = F.sort_array(F.map_entries(T.frontmatter(t)))
    whole = F.sort_array(F.map_entries(h["front"]))
    same = (whole == front) & (h["front_end"] == T.front_end(t)) & (h["heading"] == T.first_heading(t)) & (h["summary"] == T.clean_summary(T.frontmatter(t), t))
    assert df.where(~same).count() == 0


def test_rebuilt_contents_without_their_list(spark):
    df = spark.createDataFrame([("# A\n\n## B\n```\n# no\n```\n### C #\n",), ("\n" * 12 + "# late\n## B\n",), ("x\n## 📑 本篇目录\n\n- [B](#b)\n\n---\n## B\n",)], "t string")
    a, b = toc.build(F.col("t")), toc.build(F.col("t"), listed_too=False)
    assert df.where(a["text"] != b["text"]).count() == 0
    assert [[x.title for x in r.h] for r in df.select(a["headings"].alias("h")).collect()] == [["B", "C #"], ["B"], ["B"]]


@pytest.mark.parametrize("few", [0, 32])
def test_few_numbers_and_many_are_looked_up_alike(spark, monkeypatch, few):
    monkeypatch.setattr(quality, "FEW", few)
    df = spark.createDataFrame([(["12", "3.5", "77", "2024", "99"], ["13.57", "1123", "77", "202"]), (["12"], []), ([], ["1.5"])], "m array<string>, t array<string>")
    got = df.select(quality.uncovered(F.col("m"), F.col("t")).alias("x")).collect()
    assert [r.x for r in got] == [["2024", "99"], ["12"], []]


def test_near_miss_terms_read_texts_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(x):
        read.add(1)
        return x

    pairs = spark.createDataFrame([(1, "一二三四五", "一二三四六"), (2, "甲乙丙丁", "x")], "k int, s string, n string")
    found = quality.term_variants(pairs.withColumn("s", seen.asNondeterministic()("s")), "k", F.col("s"), F.col("n"))
    assert [(r.k, r.variant) for r in found.collect()] == [(1, "一二三四六")]
    assert read.value == 2
