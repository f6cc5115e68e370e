"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from notewarden.llm import spelling

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(n):
    out = {}
    for w in n:
        near = [v for v in n if one_edit(w, v)]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        out[w] = [best if best and n[best] >= 5 * n[w] else None, len(near)]
    rows = []
    for w, (form, many) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n[w], many, n[form] if form else None))
    return sorted(rows)


def brute_counts(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def some_words(rng, number, letters="abcdeäÉ", low=6, high=9):
    base = ["".join(rng.choices(letters, k=rng.randint(low, high))) for _ in range(number)]
    for _ in range(2 * number):
        w, i, c = rng.choice(base), rng.randint(0, low - 1), rng.choice(letters)
        base.append(rng.choice([w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w[:i] + w[i + 1 :], "".join(sorted(w)), w[::-1]]))
    return sorted({w for w in base if len(w) >= 6})


@pytest.mark.parametrize(("cell_words", "sample"), [(8192, 10**6), (20, 10**6), (20, 60)])
def test_near_words(spark, cell_words, sample):
    rng = random.Random(cell_words)
    words = some_words(rng, 150)
    words += ["".join(p) for p in {tuple(rng.sample("abcdefgh", 8)) for _ in range(200)}]  # words of equal counts
    long = "abcdefghij" * 30
    words += [long, long + "k", long[:-1] + "x", "z" * 70, "z" * 71, "z" * 72]
    n = {w: rng.choice([5, 6, 25, 25, 125, 700, 10**9]) for w in set(words)}
    df = spark.createDataFrame(list(n.items()), "word string, n bigint").repartition(5)
    got = spelling.variants(df, cell_words=cell_words, sample=sample)
    assert sorted(tuple(r) for r in got.select("word", "form", "root", "n", "n_near", "form_n").collect()) == brute_words(n)


def test_op12(spark):
    rng = random.Random(3)
    words = some_words(rng, 40, letters="abcDÄß×÷é")
    weights = [rng.choice([1, 3, 30]) for _ in words]
    rows = [(i, " ".join(rng.choices(words, weights, k=200)).replace(" ", rng.choice([" ", "-", "\n", "1"]))) for i in range(60)]
    rows += [(None, "KELVIN kelvin Kelvin Straße straße " * 9), (None, None), (3, ""), (4, "lonely"), (5, "x" * 3000 + " " + "x" * 2999), (5, ("x" * 3000 + " ") * 5), (5, ("x" * 2999 + " ") * 5), (5, ("x" * 2999 + " ") * 5)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOC).withColumnRenamed("lang", "word")
    got = spelling.op12(df.repartition(4)).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(tuple(r) for r in got.collect()) == brute_words(brute_counts(rows))
    assert spelling.op12(spark.createDataFrame([], DOC)).count() == 0


def test_kd_tree():
    rng = np.random.default_rng(2)
    for loose in (False, True):
        for n, d in ((1, 3), (40, 4), (400, 8)):
            points = rng.poisson(0.8, (n, d)).astype(np.uint8)
            tree = spelling.KDTree(points, 7, loose=loose)
            assert sorted(np.concatenate(tree.members).tolist()) == list(range(n))
            queries = rng.poisson(0.8, (100, d)).astype(np.uint8)
            for radius in (0, 1, 2):
                found = {(int(q), int(p)) for a, b in tree.leaves(queries, radius) for q, leaf in zip(a, b, strict=True) for p in tree.members[leaf]}
                want = {(q, p) for q in range(100) for p in range(n) if np.abs(queries[q].astype(int) - points[p]).sum() <= radius}
                assert want <= found
            if loose:  # every point of the space lies in exactly one leaf
                assert np.bincount(np.concatenate([q for q, _ in tree.leaves(queries, 0)]), minlength=100).tolist() == [1] * 100
