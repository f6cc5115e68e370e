"""Line dedup against brute force, and its minimal perfect hash against dictionaries."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from notewarden.llm import line_dedup
from notewarden.llm.line_dedup import Lines

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOC)


def key(line):
    line = line.strip(" \t\n\x0b\f\r")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)


def brute(rows, min_chars=20, min_docs=3):
    holders = {}
    for r, (i, t) in enumerate(rows):
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= min_chars:
                holders.setdefault(k, []).append((r, i))
    out = []
    for i, t in rows:
        lines, kept = (t or "").split("\n"), []
        for x in lines:
            own = holders.get(key(x), [])
            ids = [j for _, j in own if j is not None]
            if len(own) < min_docs or i == max(ids, default=None):
                kept.append(x)
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n=120):
    rng = random.Random(seed)
    pool = [f"shared line number {k} " + "".join(rng.choices("abc ÄÖé漢", k=rng.randint(0, 12))) for k in range(25)]
    odd = ["exactly nineteen ch", "exactly twenty chars", "ä" * 19, "ä" * 20, " " + "x" * 19, "İ" * 20, "  padded shared line of text \t", "PADDED Shared line of text"]
    rows = []
    for i in range(n):
        lines = [rng.choice(rng.choice([pool, odd, [""], [f"unique line of document {i} and {rng.random()}"]])) for _ in range(rng.randint(0, 12))]
        if i % 3 == 0:
            lines.insert(rng.randint(0, len(lines)), "A LINE in a third of all rows\r")
        rows.append((i, "\n".join(lines)))
    return rows


EDGE = [(None, "a line that has no id at all\nexactly twenty chars"), (None, "a line that has no id at all"), (None, "A line that has no id at all "), (3, None), (4, ""), (5, "\n\n"), (900, "one row three times over\nx"), (900, "one row three times over\nx"), (900, "one row three times over\nx"), (-(1 << 62), "exactly twenty chars"), (901, "long line " * 20_000 + "\n" + "exactly twenty chars\n" * 5000)]


@pytest.mark.parametrize("hot", [1, 20, 1 << 16])
def test_op13(spark, hot):
    rows = corpus(7) + EDGE
    df = frame(spark, rows).repartition(5)
    out = line_dedup.drop_lines(df.withColumns({"lines": F.lit(1), "gone": F.lit("mine")}), hot=hot, shard=50, shards=7)
    assert {(r.gone, r.lang) for r in out.select("gone", "lang").distinct().collect()} == {("mine", "en")}
    got = [(r.doc_id, r.lines.n_lines, r.lines.n_dropped, hashlib.sha256(r.lines.text.encode()).hexdigest()) for r in out.collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_op13_query(spark):
    rows = corpus(11) + EDGE
    got = [tuple(r) for r in line_dedup.op13(frame(spark, rows)).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()]
    assert sorted(got, key=repr) == brute(rows)
    assert line_dedup.op13(frame(spark, [])).count() == 0
    assert [tuple(r)[1:3] for r in line_dedup.op13(frame(spark, [(1, None), (2, "short")])).collect()] == [(1, 0)] * 2


def test_minimal_perfect_hash():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 63, 64, 1000, 50_000):
        h, f = rng.integers(-(1 << 63), 1 << 63, n, np.int64), rng.integers(-(1 << 31), 1 << 31, n, np.int32)
        if n > 10:
            h[: n // 2] = h[0]  # equal in 64 bits of the 96
            f[: n // 2] = np.arange(n // 2)
        made = Lines.build(h, f, np.arange(n), np.arange(n) * 7)
        again = Lines.of(*made.row())
        slot = again.find(h, f)
        assert sorted(slot.tolist()) == list(range(n))  # minimal and perfect
        assert np.array_equal(again.counts[slot], np.arange(n)) and np.array_equal(again.last[slot], np.arange(n) * 7)
        assert len(made.bits) * 64 <= 4.5 * n + 64 * 40
        if n == 50_000:  # strangers
            other = again.find(rng.integers(-(1 << 63), 1 << 63, n, np.int64), rng.integers(-(1 << 31), 1 << 31, n, np.int32))
            assert (other >= 0).sum() <= 2
