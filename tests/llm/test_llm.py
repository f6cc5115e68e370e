"""The training-data operators against brute force on small inputs, with nulls, empties, ties, repeats and clashing columns."""

import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from notewarden.llm import decontaminate, html_text, language_id, license_scan, near_dups, packing, quality_model, quality_rules, substring_dedup, url_filter

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
RNG = random.Random(7)
VOCAB = ["".join(RNG.choices("abcdefghij", k=RNG.randint(1, 6))) for _ in range(300)]


def words(n, rng=RNG):
    return " ".join(rng.choices(VOCAB, k=n))


def frame(spark, rows, schema=DOC):
    full = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows]
    return spark.createDataFrame(full, schema)


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


EDGE = [(1, None), (2, ""), (3, "   \n\t"), (4, "one"), (5, "İÉ K Straße 漢字 x"), (None, words(40)), (7, words(30)), (7, words(30)), (8, "a " * 30000)]


def empty(spark):
    return spark.createDataFrame([], DOC)


def test_op1(spark):
    items = [(1, words(20)), (2, "Short Item, five words here"), (2, "Short Item, five words here"), (None, words(14)), (4, ""), (5, None), (10, words(13))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = [*EDGE, (20, words(50) + " " + items[0][1].upper() + "; " + words(10)), (21, "x, SHORT item five-words HERE y " + words(100)), (22, items[3][1]), (23, items[6][1] + " " + items[6][1])]
    got = {(r.doc_id, r.n_words): r for r in decontaminate.op1(frame(spark, docs), bench).collect()}
    for i, text in docs:
        w, hit, ids = alnum(text), set(), set()
        for item, t in items:
            v = alnum(t)
            k = min(13, len(v))
            wins = {tuple(v[j : j + k]) for j in range(len(v) - k + 1)} if v else set()
            for j in range(len(w) - k + 1):
                if k and tuple(w[j : j + k]) in wins:
                    hit |= set(range(j, j + k))
                    ids |= {str(item)} if item is not None else set()
        r = got[i, len(w)]
        assert (r.n_hit, r.n_items) == (len(hit), len(ids))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))
    spans = {r.doc_id: r for r in decontaminate.decontaminate(frame(spark, docs), bench).collect()}
    s = spans[20].spans[0]
    assert alnum(spans[20].text[s.c0 : s.c1]) == alnum(items[0][1])
    blocks = decontaminate.decontaminate(frame(spark, docs), bench, block_bytes=90)
    assert {(r.doc_id, r.n_hit) for r in blocks.collect()} == {(r.doc_id, r.n_hit) for r in spans.values()} | {(7, 0)}
    assert decontaminate.op1(empty(spark), bench).count() == 0
    assert decontaminate.op1(frame(spark, docs), bench.limit(0)).where("n_hit > 0").count() == 0


def test_op1_windows():
    """Hits of pieces grow to exactly the windows that stand in the text, also where items share pieces, repeat words or overlap."""
    rng = random.Random(53)
    for window in (1, 2, 5, 13):
        for _ in range(30):
            vocab = "abcd"[: rng.randint(1, 4)]
            items = [(str(i), " ".join(rng.choices(vocab, k=rng.randint(0, 40)))) for i in range(rng.randint(0, 6))]
            items += [(f"{i}+", f"{t} {t}") for i, t in items[:2]]
            text = " ".join(rng.choice([" ".join(rng.choices(vocab + "x", k=rng.randint(1, 30))), rng.choice(items)[1] if items else "y"]) for _ in range(6))
            w, hit, ids = text.split(), set(), set()
            for item, t in items:
                v = t.split()
                k = min(window, len(v))
                wins = {tuple(v[j : j + k]) for j in range(len(v) - k + 1)} if v else set()
                at = [j for j in range(len(w) - k + 1) if tuple(w[j : j + k]) in wins]
                hit |= {j + x for j in at for x in range(k)}
                ids |= {item} if at else set()
            n, spans, found, _ = decontaminate._scan([text.encode()], decontaminate.Block(items, window))[0]
            assert (n, {j for a, b in spans for j in range(a, b)}, set(found)) == (len(w), hit, ids)


def test_op1_memory():
    """A block of benchmark text keeps an automaton of bounded size: about a node for each word of text."""
    rng = random.Random(59)
    size = 1 << 20
    lexicon = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 10))) for _ in range(30_000)]
    items, total = [], 0
    while total < size:
        items.append((str(len(items)), " ".join(rng.choices(lexicon, k=rng.randint(10, 80)))))
        total += len(items[-1][1])
    block = decontaminate.Block(items, 13)
    arrays = [x for x in vars(block.automaton).values() if isinstance(x, np.ndarray)]
    assert len(block.automaton.fail) < size / 4 and sum(x.nbytes for x in arrays) < 12 * size
    text = f"x {items[5][1]} y".encode()
    assert decontaminate._scan([text], block)[0][2] == ["5"]


def test_op1_repetitive_items():
    """An item of one word, or of a short period, costs no more than its length and that of the text."""
    for item in ("a " * 50_000, "a b c " * 20_000):
        block = decontaminate.Block([("1", item), ("2", f"{item} z")], 13)
        [(n, spans, ids, _)] = decontaminate._scan([(item * 3).encode()], block)
        assert (spans, ids) == ([(0, n)], ["1", "2"])


def test_op1_blocks(spark):
    """Blocks of a large benchmark give the rows of a single one, also for repeated and null texts and clashing columns."""
    rng = random.Random(67)
    items = [(i, " ".join(rng.choices("abcdefgh", k=rng.randint(1, 40)))) for i in range(40)]
    docs = [(i % 50, rng.choice([None, "", "x", " ".join(rng.choice(items)[1] + " y" for _ in range(rng.randint(1, 5)))])) for i in range(80)]
    docs = frame(spark, [*docs, *docs[:30]]).withColumn("spans", F.lit("mine")).withColumn("extra", F.col("doc_id"))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    columns = ["doc_id", "text", "extra", "n_words", "n_hit", "item_ids", "contaminated"]
    one = decontaminate.decontaminate(docs, bench).select(columns)
    many = decontaminate.decontaminate(docs, bench, block_bytes=300).select(columns)
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0 and one.count() == 110 and one.where("n_hit > 0").count() > 20


def test_op2_statistics(spark):
    docs = [*EDGE, (30, "a b c d e f\na b c d e f\nx\n\n  \nx"), (31, "w " * 9), (32, "#a $b **")]
    got = quality_rules.statistics(frame(spark, docs)).collect()
    for r in got:
        w, seen, dup, lines = spaced(r.text), {}, set(), [x for x in (r.text or "").split("\n") if spaced(x)]
        for j in range(len(w) - 4):
            seen.setdefault(tuple(w[j : j + 5]), []).append(j)
        for places in seen.values():
            if len(places) > 1:
                dup |= {j + k for j in places for k in range(5)}
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", r.text or "")), len(lines) - len(set(lines)), len(dup))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want


@pytest.mark.parametrize(("n", "alpha", "level"), [(0, 0.01, 0.05), (10, 0.01, 0.05), (2000, 0.01, 0.01), (300, 0.2, 0.001), (50_000, 0.005, 0.0025)])
def test_op2_binomial(spark, n, alpha, level):
    got = spark.range(1).select(quality_rules.most_rejected(F.lit(n).cast("bigint"), F.lit(alpha), F.lit(level)).alias("k")).first().k
    total, want = 0.0, -1
    for k in range(n + 1):
        total += math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(alpha) + (n - k) * math.log(1 - alpha))
        if total > level:
            break
        want = k
    assert got == want


def test_op2_false_rejection_is_bounded(spark):
    rng = random.Random(1)
    good = [(i, words(60, rng)) for i in range(4000)]
    bad = [(10_000 + i, " ".join(w + "***" for w in words(60, rng).split())) for i in range(200)]
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(None, 1, 0), (5, None, None)], "doc_id bigint, quality int, toxic int")
    got = quality_rules.op2(frame(spark, [*good, *bad, (77_777, None), (77_778, words(20))]), labels).collect()
    kept = {r.doc_id: r.kept for r in got}
    assert len(got) == 4202 and not kept[77_777]
    assert sum(not kept[i] for i, _ in good) <= 0.025 * len(good)
    assert sum(kept[i] for i, _ in bad) == 0
    assert quality_rules.op2(empty(spark), labels).count() == 0
    assert quality_rules.op2(frame(spark, good[:20]), labels.limit(0)).where("kept").count() == 20


def test_op2_joint_bound(spark):
    """Cutoffs at which all rules together would reject more than alpha of the good documents are seldom admitted."""
    rng = random.Random(41)
    trials, rows = 60, []
    for t in range(trials):  # 0.6 % of good documents break one rule, another 0.6 % a second one at level 60
        rows += [(f"s{t:02}", 100 if rng.random() < 0.006 else 0, 15 if rng.random() < 0.006 else 0) for _ in range(300)]
    df = spark.createDataFrame(rows, "stratum string, n_symbols bigint, n_dup_lines bigint")
    df = df.selectExpr("*", "100L AS n_words", "500L AS word_chars", "0L AS n_repeat_words", "1L AS weight")
    got = quality_rules.learn_cutoffs(df, delta=0.05 * trials).collect()  # each stratum is a trial at 0.05
    assert len(got) == trials and all(r.alpha == 0.01 for r in got)  # 300 documents certify 1 % at best
    assert sum(r.cutoff <= 60 for r in got) <= 0.05 * trials + 3  # 1.2 % together
    assert sum(60 < r.cutoff <= 100 for r in got) >= 3  # 0.6 %


def test_op2_strata(spark):
    """Strata with labels enough reject junk by their own cutoff; one with too few only by the pooled one."""
    rng = random.Random(37)
    rows = [(i, words(60, rng), ("a", "b", "c", None)[i % 4], "s", 1) for i in range(2400)]
    rows += [(10_000 + i, " ".join(w + "***" for w in words(60, rng).split()), ("a", "b", "c", None, "rare")[i % 5], "s", 1) for i in range(100)]
    docs = spark.createDataFrame(rows, DOC)
    labels = spark.createDataFrame([(i, int(i < 10_000), 0) for i, *_ in rows], "doc_id bigint, quality int, toxic int")
    kept = {p: {r.doc_id for r in quality_rules.quality_rules(docs, labels, pooled=p).where("kept").collect()} for p in (False, True)}
    assert {i for i in kept[False] if i >= 10_000} == {i for i in range(10_000, 10_100) if i % 5 == 4}
    assert not [i for i in kept[True] if i >= 10_000] and len(kept[True]) >= 0.975 * 2400
    few = labels.where("doc_id < 200")  # 50 a stratum: no bound can be given
    assert quality_rules.quality_rules(docs, few).where("kept").count() >= 2400 + 95
    assert quality_rules.quality_rules(docs, labels.limit(0), pooled=True).where("kept").count() >= 2400
    clash = docs.withColumns({"stratum": F.lit("x"), "kept": F.lit(1), "n_words": F.lit("y"), "cutoff": F.lit(0)})
    assert sorted(map(str, quality_rules.op2(clash, labels).collect())) == sorted(map(str, quality_rules.op2(docs, labels).collect()))


def test_op3(spark):
    mit = license_scan.TEMPLATES[0][1]
    docs = [*EDGE, (40, "x Under the MIT License, y under the mit-license"), (41, "CC BY-NC; Apache License, Version 2"), (42, words(30) + " " + mit.title() + " " + words(10)), (43, mit.replace("without restriction", "x y")), (44, " ".join(reversed(mit.split())))]
    got = {r.doc_id: r for r in license_scan.op3(frame(spark, docs)).collect()}
    r = got[40]
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == (10, 2, 1, 6, "mit", "mit")
    assert (got[41].base_labels, got[41].n_base) == ("apache-2,cc-by-nc", 2)
    assert (got[42].base_labels, got[42].labels) == ("", "mit") and got[42].score > 0.9
    assert got[43].labels == "" and got[44].labels == ""
    assert (got[1].n_words, got[1].first_word, got[1].score) == (0, None, 0.0)
    assert all(r.n_words == len(alnum(t)) for i, t in docs if (r := got[i]) and i != 7)
    assert license_scan.op3(empty(spark)).count() == 0
    clash = frame(spark, docs).withColumns({"labels": F.lit(1), "__at": F.lit(2), "n_words": F.lit("z")})
    assert sorted(r.labels for r in license_scan.license_scan(clash).collect()) == sorted(r.labels for r in license_scan.op3(frame(spark, docs)).collect())


def brute_licenses(texts, templates, rare):
    """labels and best share of each text, by counting over all alignments."""
    docs = [alnum(t) for t in texts]
    df = lambda w: sum(w in d for d in docs)
    out = []
    for d in docs:
        line, found = f" {' '.join(d)} ", {}
        for label, passage, keys in templates:
            v = alnum(passage)
            top = sorted(set(v), key=lambda w: (df(w), -len(w), w))[:rare]
            places = [(w, p) for p, w in enumerate(v) if w in top]
            best = max((sum(0 <= x + p < len(d) and d[x + p] == w for w, p in places) for x in range(-len(v), len(d))), default=0)
            if places and 5 * best >= 3 * len(places) and all(f" {' '.join(alnum(k))} " in line for k in keys):
                found[label] = max(found.get(label, 0.0), best / len(places))
        out.append((",".join(sorted(found)), max(found.values(), default=0.0)))
    return out


def test_op3_catalogue(spark):
    """A catalogue given as a table, against counting over all alignments; the index follows the corpus' frequencies."""
    rng = random.Random(43)
    templates = [(f"l{i % 5}", words(rng.randint(3, 40), rng), [words(1, rng)] if i % 3 else []) for i in range(12)]
    templates = [(x, p + " " + " ".join(k), k) for x, p, k in templates]
    texts = [None, "", "..."]
    for i in range(80):
        parts = [words(rng.randint(0, 30), rng), rng.choice(templates)[1], words(5, rng), rng.choice(templates)[1]]
        mess = [w if rng.random() < 0.85 else rng.choice(VOCAB) for w in " ".join(parts[: rng.randint(1, 4)]).split()]
        texts.append(" ".join(mess))
    table = spark.createDataFrame([*templates, ("none", "...", []), (None, "x", []), ("null", None, None), templates[0]], "label string, passage string, phrases array<string>")
    got = {r.doc_id: r for r in license_scan.license_scan(frame(spark, list(enumerate(texts))), table, phrases={"zzz": "z"}, rare=6).collect()}
    want = brute_licenses(texts, templates, 6)
    assert sum(bool(w) for w, _ in want) > 30
    for i, (labels, share) in enumerate(want):
        assert (got[i].labels, round(got[i].score, 9)) == (labels, round(share, 9))
    assert license_scan.license_scan(frame(spark, [(1, "x y")]), table.limit(0)).first().labels == ""


def test_op4(spark):
    urls = [
        "http://a.example.org/es/x", "https://EXAMPLE.org/en/12?q=/es/", "http://x.com/fr/a#b", "http://com/de/", "http://xcom/de/", "http://example.org", "http://example.org?x",
        "http://b.org/q", None, "", "no scheme", "http:///es/", "http://x.example.org/es", "ftp://u.com/fr", "http://x.com/fr/://y.org/es/",
    ]
    pages = spark.createDataFrame([(i, u, "r", "h") for i, u in enumerate(urls)] + [(0, urls[0], "r", "h")], "page_id bigint, url string, rule string, host string")
    rules = spark.createDataFrame([*url_filter.RULES, (None, "/", "block"), ("org", "/", "allow")], "host string, path string, verdict string")
    rows = url_filter.url_verdicts(pages, rules).collect()
    assert len(rows) == len(urls) + 1
    for r in rows:
        u = r.url or ""
        m = re.match(r".*?://([^/?#]*)([^?#]*)", u)
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fits = [(len(h + p), h, p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        assert (r.host, r.path) == (host, path)
        assert (r.rule, r.verdict) == ((best[1] + best[2], best[3]) if best else (None, "block" if host == "" else "allow"))
    wide = url_filter.url_verdicts(pages, rules, broadcast_rules=0)
    assert sorted(map(str, wide.collect())) == sorted(map(str, rows))
    assert url_filter.op4(pages.limit(0)).count() == 0
    assert url_filter.url_verdicts(pages, rules.limit(0)).where("rule is not null").count() == 0


def test_op5(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality_model.op5(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum((r.score >= 0.5) == (r.quality == 1) for r in got) >= 0.95 * len(got)
    odd = quality_model.op5(frame(spark, EDGE), labels).collect()
    assert len(odd) == len(EDGE) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in odd)
    assert all(r.score == 0.5 for r in quality_model.op5(frame(spark, EDGE), labels.limit(0)).collect())
    assert quality_model.op5(empty(spark), labels).count() == 0


def test_op5_trees():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] < -0.2)).astype(float)
    forest = quality_model.fit(x[:2000], y[:2000], trees=40, depth=3)
    assert ((forest.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95
    assert np.allclose(quality_model.fit(x[:50], np.ones(50)).score(x[:3]), 51 / 52)


def test_op5_walk():
    """Flattened arrays give what a walk from node to node gives."""
    rng = np.random.default_rng(3)
    for depth in (1, 2, 4):
        inner = 2**depth - 1
        forest = quality_model.Forest(rng.integers(0, 6, (9, inner)), rng.normal(size=(9, inner)), rng.normal(size=(9, inner + 1)), 0.25)
        forest.threshold[rng.random((9, inner)) < 0.2] = np.inf  # a node that was not split
        x = rng.normal(size=(200, 6))
        for row, got in zip(x, forest.score(x), strict=True):
            total = 0.25
            for t in range(9):
                node = 0
                while node < inner:
                    node = 2 * node + (2 if row[forest.feature[t, node]] > forest.threshold[t, node] else 1)
                total += forest.value[t, node - inner]
            assert math.isclose(got, 1 / (1 + math.exp(-total)))


def naive_tree(x, grad, hess, rows, edges, depth, min_leaf, leaves):
    """Appends the leaves (rows, value without rate) of a tree that tries every threshold of every statistic in turn."""
    best = (1e-9, None)
    if depth:
        g, h = sum(grad[i] for i in rows), sum(hess[i] for i in rows)
        for f, cuts in enumerate(edges):
            for c in cuts:
                left = [i for i in rows if x[i][f] <= c]
                if min_leaf <= len(left) <= len(rows) - min_leaf:
                    gl, hl = sum(grad[i] for i in left), sum(hess[i] for i in left)
                    gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                    if gain > best[0] * (1 + 1e-9) + 1e-12:
                        best = (gain, (f, c))
    if best[1] is None:
        leaves.append((rows, sum(grad[i] for i in rows) / (sum(hess[i] for i in rows) + 1)))
        return
    f, c = best[1]
    naive_tree(x, grad, hess, [i for i in rows if x[i][f] <= c], edges, depth - 1, min_leaf, leaves)
    naive_tree(x, grad, hess, [i for i in rows if x[i][f] > c], edges, depth - 1, min_leaf, leaves)


def test_op5_fit():
    """The histogram fit finds the trees of a plain search over all thresholds."""
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(150, 4)), 1)
    y = ((x[:, 0] + x[:, 1] * x[:, 2] > 0.2) ^ (rng.random(150) < 0.1)).astype(float)
    got = quality_model.fit(x, y, trees=4, depth=3, bins=8, rate=0.3, min_leaf=5).score(x)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 9)[1:-1])) for j in range(4)]
    share = (y.sum() + 1) / (len(y) + 2)
    raw = [math.log(share / (1 - share))] * len(y)
    for _ in range(4):
        prob = [1 / (1 + math.exp(-r)) for r in raw]
        leaves = []
        naive_tree(x.tolist(), [b - a for a, b in zip(prob, y, strict=True)], [q * (1 - q) for q in prob], list(range(len(y))), edges, 3, 5, leaves)
        for rows, value in leaves:
            for i in rows:
                raw[i] += 0.3 * value
    assert np.allclose(got, [1 / (1 + math.exp(-r)) for r in raw])


def test_op5_columns(spark):
    """Columns named like helpers or results change nothing; repeated rows keep their scores; labels may be null."""
    rng = random.Random(71)
    rows = [(i, words(40, rng) if i % 2 else " ".join(w + "|" for w in words(40, rng).split())) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(150)] + [(3, None, 1), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    docs = frame(spark, [*rows, rows[0], rows[1]])
    clash = docs.withColumns({"score": F.lit("x"), "x": F.lit(1), "__id": F.lit(2), "t": F.lit(3), "__y": F.lit(4), "quality": F.lit(0)})
    plain = sorted((r.doc_id, r.score) for r in quality_model.op5(docs, labels).collect())
    assert sorted((r.doc_id, r.score) for r in quality_model.op5(clash, labels).collect()) == plain
    assert len(plain) == 202 and sum((s > 0.5) == bool(i % 2) for i, s in plain) >= 195


def test_op1_columns(spark):
    """Columns named like helpers or results are replaced by results; null texts and very long ones beside each other."""
    item = words(15)
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string").withColumn("i", F.lit(5))
    docs = frame(spark, [(1, item), (2, None), (3, f"{words(30_000)} {item}")]).withColumns({"n_words": F.lit("x"), "spans": F.lit(1), "item_ids": F.lit(2), "i": F.lit(0)})
    got = {r.doc_id: r for r in decontaminate.decontaminate(docs, bench).collect()}
    assert [got[i].contaminated for i in (1, 2, 3)] == [True, False, False] and got[3].n_hit == 15 and got[3].i == 0 and got[2].n_words == 0


def test_op4_long_and_hot(spark):
    """Very long URLs, and a rule side that is joined by shuffle where one expression is in every URL."""
    urls = [(i, f"http://h{i}.com/de/{'a/' * 3000}") for i in range(300)] + [(300, "http://" + "a." * 300 + "org/x")]
    pages = spark.createDataFrame(urls, "page_id bigint, url string")
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")
    got = url_filter.url_verdicts(pages, rules, broadcast_rules=0).groupBy("rule", "verdict").count().collect()
    assert sorted((r["rule"], r["verdict"], r["count"]) for r in got) == [("com/de/", "block", 300), ("org/", "allow", 1)]


def test_op6(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.op6(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.97 * len(got)
    odd = {r.doc_id: r for r in language_id.op6(frame(spark, [*EDGE, (50, "123 !!!"), (51, "漢字")])).collect()}
    assert [odd[i].lang_pred for i in (1, 2, 3, 50)] == ["und"] * 4 and odd[51].lang_pred == "en"
    assert language_id.op6(empty(spark)).count() == 0
    assert {r.lang_pred for r in language_id.op6(frame(spark, EDGE).withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def brute_phrases(text, source):
    n, i = 0, 0
    while i < len(text):
        k = 1
        while i + k < len(text) and text[i : i + k + 1] in source:
            k += 1
        n, i = n + 1, i + k
    return n


def test_op6_phrases():
    model = language_id.LanguageModel({"a": ["abracadabra"], "b": ["hello world hello"]})

    def brute(text, lang):
        text = language_id.squeezed(text)
        return brute_phrases(text, {"a": "abracadabra", "b": "hello world hello"}[lang])

    texts = ["abra cad", "hello", "world hello abrac", "zzz", "drab low"]
    got = model.phrases([model.codes(language_id.squeezed(t)) for t in texts])
    assert got.tolist() == [[brute(t, lang) for lang in model.langs] for t in texts]


def test_op6_scripts(spark, monkeypatch):
    """Every script of the samples counts, also where far more characters than one flat table takes are in use."""
    rng = random.Random(31)
    scripts = {"ar": (0x621, 26), "de": (0x61, 26), "hi": (0x905, 48), "ja": (0x3041, 80), "ru": (0x430, 32), "zh": (0x4E00, 900), "zz": (0x10D0, 33)}
    lexicon = {lang: ["".join(chr(a + rng.randrange(n)) for _ in range(rng.randint(2, 5))) for _ in range(120)] for lang, (a, n) in scripts.items()}
    lexicon["zh"] = ["".join(chr(0x4E00 + rng.randrange(900)) for _ in range(2)) for _ in range(300)]
    lexicon["zz"] = lexicon["zh"][:60] + lexicon["ja"]  # two languages that share a script
    rows = [(i, " ".join(rng.choices(lexicon[lang], k=80)), lang, "s", 1) for i, lang in enumerate(sorted(scripts) * 40)]
    docs = spark.createDataFrame(rows, DOC)
    got = language_id.op6(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    wrong = [r for r in got if r.lang_pred != r.lang]
    assert len(got) > 50 and len(wrong) <= 2 and all({r.lang, r.lang_pred} == {"ja", "zz"} for r in wrong)  # zz has all words of ja
    samples = {lang: [t for _, t, x, _, _ in rows if x == lang][:3] for lang in scripts}
    model = language_id.LanguageModel(samples)
    source = {lang: " ".join(map(language_id.squeezed, parts)) for lang, parts in samples.items()}
    # whole predictions of texts of several pieces, also where pieces meet the state before them late or never
    texts = [language_id.squeezed(" ".join(rng.choice(rows)[1] for _ in range(20)) + " ㍿ǆ") for _ in range(3)]
    texts += [source["zh"] * 4, source["ja"][:300] * 20, texts[0][:500], "x", texts[1][:1024], texts[1][:1280]]
    assert len(texts[0]) > 5000
    got = model.phrases([model.codes(t) for t in texts])
    assert got.tolist() == [[brute_phrases(t, source[lang]) for lang in model.langs] for t in texts]
    langs, _ = model.predict(texts)
    assert langs == [model.langs[int(np.argmin([brute_phrases(t, source[x]) * math.log2(len(source[x]) + 1) for x in model.langs]))] for t in texts]
    monkeypatch.setattr(language_id, "WARM", 1)  # hardly any piece meets the state before it
    assert (model.phrases([model.codes(t) for t in texts]) == got).all()
    strange = ["ሀሁሂሃ ለሉሊላ ሐሑሒሓ መሙሚማ ሠሡሢሣ", rows[0][1], "ok", None]
    assert model.predict(strange, reject=True)[0] == ["und", "ar", model.predict(["ok"])[0][0], "und"] and model.predict(strange)[0][0] != "und"
    longer = docs.withColumn("text", F.when(F.col("lang") == "de", F.repeat(F.concat("text", F.lit(" ")), 60)).otherwise(F.col("text")))
    clash = longer.withColumns({"l": F.lit(1), "__d": F.lit(2), "lang_pred": F.lit(3), "score": F.lit("x")})
    for one in (longer, clash):  # a language that has only long texts is learnt from slices
        got = language_id.op6(one).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
        assert sum(r.lang_pred != r.lang for r in got) <= 3
    monkeypatch.setattr(language_id, "MAX_LANGS", 1)
    with pytest.raises(ValueError, match="languages"):
        language_id.learn(docs)


def test_op7_boundaries():
    rng = random.Random(3)
    for n in range(60):
        tops = sorted(rng.sample(range(0, 60), rng.randint(1, 9)))
        counts = [rng.randint(1, 9) for _ in tops]
        k = rng.randint(1, 5)
        bounds, pad = packing.boundaries(np.array(tops), np.array(counts), k)
        cost = lambda bs: sum(c * (min(b for b in bs if b >= t) - t) for t, c in zip(tops, counts, strict=True))
        best = min(cost([*bs, tops[-1]]) for n in range(min(k, len(tops))) for bs in itertools.combinations(tops[:-1], n))
        assert pad == best == cost(bounds) and len(bounds) <= k
    tops = np.unique((np.random.default_rng(1).pareto(1.2, 3000) * 500).astype(np.int64))  # long lengths, against the plain recursion
    counts = np.random.default_rng(2).integers(1, 1000, len(tops))
    c, s = np.concatenate(([0], np.cumsum(counts))), np.concatenate(([0], np.cumsum(counts * tops)))
    best = np.concatenate(([0], np.full(len(tops), 1 << 60)))
    for _ in range(7):
        best = np.array([0] + [min(int(best[i]) + int(c[j] - c[i]) * int(tops[j - 1]) - int(s[j] - s[i]) for i in range(max(0, j - 400), j)) for j in range(1, len(tops) + 1)])
    bounds, pad = packing.boundaries(tops, counts, 7)
    assert pad <= best[-1] and pad == sum(int(k) * (min(b for b in bounds if b >= t) - int(t)) for t, k in zip(tops, counts, strict=True)) and len(bounds) == 7


def test_op7(spark):
    rng = random.Random(5)
    docs = [*EDGE, *((100 + i, words(int(rng.expovariate(0.02)) + 1, rng)) for i in range(400))]
    lengths = packing.length_words(F.col("text"))
    table = frame(spark, docs).withColumns({"__at": F.lit(1), "n": F.lit(2), "bucket": F.lit("x"), "__part": F.lit(0)})
    got = packing.pack(table.drop("n_chars"), lengths, buckets=6, budget=300, part_rows=40).collect()
    sizes = sorted(len(spaced(t)) for _, t in docs)
    assert sorted({r.bucket_len for r in got}) == packing.boundaries(*np.unique(sizes, return_counts=True), 6)[0]
    assert sorted(r.n_tokens for r in got) == sorted(len(spaced(t)) for _, t in docs)
    places = {}
    for r in got:
        assert r.n_tokens <= r.bucket_len and r.padding == r.bucket_len - r.n_tokens
        places.setdefault((r.bucket, r.batch), []).append(r)
    for rows in places.values():
        assert len(rows) == 1 or len(rows) * max(1, rows[0].bucket_len) <= 300
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
    for b in {r.bucket for r in got}:
        sizes = [len(places[b, k]) for k in range(max(x for y, x in places if y == b) + 1)]
        assert len(set(sizes[:-1])) <= 1  # only the last batch of a bucket is not full
    assert packing.op7(empty(spark)).count() == 0
    assert packing.op7(frame(spark, EDGE)).count() == len(EDGE)


def brute_dedup(docs):
    first = {}
    for i, t in docs:
        w = spaced(t)
        if i is not None:
            for j in range(len(w) - 12):
                k = tuple(w[j : j + 13])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, t in docs:
        w, gone = spaced(t), set()
        if i is not None:
            for j in range(len(w) - 12):
                if first[tuple(w[j : j + 13])] < i:
                    gone |= set(range(j, j + 13))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("most_runs", [256, 2])
def test_op8(spark, monkeypatch, most_runs):
    monkeypatch.setattr(substring_dedup, "MOST_RUNS", most_runs)
    rng = random.Random(11)
    passages = [words(n, rng) for n in (12, 13, 14, 20, 60, 200)]
    docs = list(EDGE)
    for i in range(100, 260):
        docs.append((i, "\n".join(rng.choice([words(rng.randint(1, 40), rng), rng.choice(passages)]) for _ in range(rng.randint(1, 6)))))
    line = words(8, rng)
    docs += [(i, f"{words(30, rng)} {line} {words(30, rng)}") for i in range(300, 340)]
    copy = words(90, rng).split()
    for i in range(400, 420):
        one = list(copy)
        one[rng.randrange(90)] = "edit"
        docs.append((i, " ".join(one)))
    docs += [docs[40], (docs[41][0], docs[50][1])]
    got = substring_dedup.op8(frame(spark, docs).repartition(5)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_dedup(docs)


def test_op8_frequent_anchor(spark):
    """An anchor with more different runs than one automaton takes is resolved by its windows."""
    rng = random.Random(13)
    line = words(16, rng)
    docs = [(i, f"{words(20, rng)} {line} {words(20, rng)}") for i in range(700)]
    got = substring_dedup.op8(frame(spark, docs)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_dedup(docs)
    assert substring_dedup.op8(empty(spark)).count() == 0


def test_op8_hot_anchors_and_text_ids(spark, monkeypatch):
    """Anchors found hot in a sample are dealt by run, and ids may be texts; both change nothing in the result."""
    rng = random.Random(61)
    line = words(16, rng)
    docs = [(i, f"{words(rng.randint(0, 20), rng)} {line} {words(20, rng)}") for i in range(200)] + [(3, line), (None, line)]
    some = spark.createDataFrame([(i, 1, t.encode()) for i, t in docs if i is not None], "doc bigint, key bigint, text binary")
    often = substring_dedup.hot_anchors(some, len(docs), 1, sample_docs=100)
    assert 0 < len(often) <= 8
    monkeypatch.setattr(substring_dedup, "hot_anchors", lambda *_: often)
    got = substring_dedup.op8(frame(spark, docs).repartition(6)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_dedup(docs)
    named = frame(spark, docs).withColumn("doc_id", F.concat(F.lit("id-"), F.lpad(F.col("doc_id").cast("string"), 5, "0")))
    texts = substring_dedup.op8(named).collect()
    assert sorted((r.n_words, r.n_removed, r.kept_sha256) for r in texts) == sorted((r.n_words, r.n_removed, r.kept_sha256) for r in got)


def test_op8_columns(spark):
    docs = frame(spark, [(1, words(30)), (2, None)]).withColumns({"doc": F.lit(1), "key": F.lit("k"), "row": F.lit(2), "full": F.lit(3)})
    out = substring_dedup.dedup_substrings(docs)
    assert out.columns == docs.columns and sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))


def test_op8_sides():
    """Different runs of one anchor that share a window agree on a side, so none of them escapes the automata."""
    rng = random.Random(67)
    base = [rng.choice(VOCAB) for _ in range(400)]
    texts = []
    for _ in range(60):
        one, at = list(base), rng.randrange(380)
        for _ in range(rng.randint(0, 25)):
            one[rng.randrange(400)] = rng.choice(VOCAB)
        texts.append(" ".join(one[at : at + rng.randint(13, 120)]).encode())
    w = substring_dedup.words_of([*texts, b"", b"one"])
    r = substring_dedup.runs_of(w)
    side = substring_dedup.sides_of(r)
    word = [w.joined[i:j] for i, j in zip(w.start, w.end, strict=True)]
    windows = [{tuple(word[j : j + 13]) for j in range(i, k + 1)} for i, k in zip(r.first, r.last, strict=True)]
    shared = 0
    for i, j in itertools.combinations(range(len(windows)), 2):
        if r.run[i] != r.run[j] and windows[i] & windows[j]:
            shared += 1
            both = [(int(side[k]) >> 16, int(side[k]) & 0xFFFF) for k in (i, j)]
            assert r.fp[i] == r.fp[j] and any(x == y != 0 for x, y in zip(*both, strict=True))
    assert shared > 100
    assert len(substring_dedup.sides_of(substring_dedup.runs_of(substring_dedup.words_of([b"", b"a b c"])))) == 0


def test_op8_automaton():
    rng = random.Random(2)
    auto, parts = substring_dedup.SuffixAutomaton(), []
    for _ in range(30):
        part = rng.choices("abc", k=rng.randint(1, 15))
        auto.add(part)
        parts.append("".join(part))
    query = rng.choices("abcd", k=200)
    for i, n in enumerate(auto.matches(query)):
        tail = "".join(query[: i + 1])
        want = max((k for k in range(i + 2) if any(tail[i + 1 - k :] in p for p in parts)), default=0)
        assert n == want


def brute_components(ids, fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if bin((fps[i] ^ fps[j]) & (2**64 - 1)).count("1") <= 3:
            root[find(i)] = find(j)
    low = {}
    for i, x in enumerate(ids):
        if x is not None:
            low[find(i)] = min(low.get(find(i), x), x)
    return [low.get(find(i)) for i in range(len(ids))]


def brute_simhash(text):
    from xxhash import xxh64_intdigest

    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hs = [xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_op9(spark):
    rng = random.Random(17)
    docs = [*EDGE, (None, None)]
    for base in range(6):
        text = words(300, rng).split()
        for k in range(8):
            one = list(text)
            one[rng.randrange(300)] = "edit"
            docs.append((1000 + 10 * base + k, " ".join(one)))
    got = near_dups.op9(frame(spark, docs).repartition(4)).collect()
    fps = [brute_simhash(t) for _, t in docs]
    want = sorted((str(i), f"{f:016x}", str(c)) for (i, _), f, c in zip(docs, fps, brute_components([i for i, _ in docs], fps), strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    assert len({r.component_id for r in got}) < len(docs) - 10
    split = near_dups.near_duplicates(frame(spark, docs), shard_nodes=2).collect()  # shards are split as often as they can be
    assert sorted((str(r.doc_id), str(r.component_id)) for r in split) == sorted((x, c) for x, _, c in want)
    assert near_dups.op9(empty(spark)).count() == 0
    kept = near_dups.drop_near_duplicates(frame(spark, docs).withColumn("fp", F.lit(1)))
    assert kept.count() == len(set(brute_components(range(len(docs)), fps)))
    assert kept.columns[-1] == "fp"


def test_op9_trees():
    rng = np.random.default_rng(4)
    points = rng.integers(0, 2**63, 300).astype(np.uint64)
    points = np.unique(np.concatenate([points, *(points[:100] ^ (np.uint64(1) << rng.integers(0, 60, 100).astype(np.uint64)) for _ in range(3))]))
    shard = np.sort(rng.integers(0, 3, len(points)))
    got = {(a, b) for q, v in near_dups.BKForest(shard, points).links(3) for a, b in zip(q.tolist(), v.tolist(), strict=True)}
    near = lambda i, j: bin(int(points[i]) ^ int(points[j])).count("1") <= 3
    want = {(i, j) for i in range(len(points)) for j in range(len(points)) if i != j and shard[i] == shard[j] and near(i, j)}
    assert got == want and len(want) > 300
    # where points of the largest class are not asked any more, the classes stay the same
    points = np.unique(np.concatenate([points, *(points[:3, None] ^ (np.uint64(1) << rng.integers(0, 60, (3, 200)).astype(np.uint64))).tolist()]).astype(np.uint64))
    shard = np.repeat([0, 1], [len(points) - 100, 100])
    whole, lazy = np.arange(len(points)), np.arange(len(points))
    forest = near_dups.BKForest(shard, points)
    asked = [0, 0]
    for k, (label, pairs) in enumerate(((whole, forest.links(3)), (lazy, forest.links(3, lazy, block=32)))):
        for q, v in pairs:
            asked[k] += len(q)
            near_dups._merge(label, q, v)
    assert (whole == lazy).all() and asked[1] < asked[0]


def test_op9_shards(spark):
    """Fingerprints within three bits share a key at every level of splitting."""
    rng = random.Random(67)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = {f ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(0, 3))}) for f in base for _ in range(6)} | set(base)
    fps |= {base[0] ^ sum({1 << rng.randrange(8) for _ in range(3)}) for _ in range(60)}  # many with long common parts
    nodes = spark.createDataFrame([(near_dups._signed(f),) for f in fps], "fp bigint")
    for most in (1, 20, 50_000):
        keys = {}
        for r in near_dups.shards(nodes, most).collect():
            keys.setdefault(r.fp & (2**64 - 1), set()).add(r.key)
        assert all(keys[x] & keys[y] for x, y in itertools.combinations(sorted(fps), 2) if bin(x ^ y).count("1") <= 3)


def test_op9_chain(spark):
    chain = [(i + 1, i) for i in range(60)] + [(200, 100), (300, 200), (300, 299)]
    got = {r.u: r.root for r in near_dups.components(spark.createDataFrame(chain, "u bigint, v bigint")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {200: 100, 300: 100, 299: 100}


def test_pipeline_near_copies(spark):
    """Word edits that move more than three bits of a SimHash are near copies while five-word shingles agree to 0.8."""
    rng = random.Random(29)
    docs = [*EDGE, (None, None), (1, None)]
    for base in range(8):
        text = words(200, rng).split()
        for k in range(9):
            one = list(text)
            for j in rng.sample(range(200), k):
                one[j] = f"edit{base}x{k}"
            docs.append((1000 + 10 * base + k, "\n".join(one)))

    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets, root = [shingles(t) for _, t in docs], list(range(len(docs)))
    for i, j in itertools.combinations(range(len(docs)), 2):
        if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
            a, b = root[i], root[j]
            root = [a if r == b else r for r in root]
    df = frame(spark, docs).repartition(3)
    want = sorted(min((d is None, d or 0) for (d, _), r in zip(docs, root, strict=True) if r == x) for x in set(root))
    got = corpus_pipeline.near_duplicates(spark, df, "")
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == want and got.columns == df.columns
    groups = {}
    for block in (near_dups.BLOCK_SHINGLES, 500):
        rows = near_dups.near_copies(df, block=block).collect()
        groups[block] = {frozenset((str(r.doc_id), r.text_hash) for r in rows if r.root == x) for x in {r.root for r in rows}}
        assert len(rows) == len(docs) and len(groups[block]) == len(set(root))
    assert groups[500] == groups[near_dups.BLOCK_SHINGLES]
    assert corpus_pipeline.near_duplicates(spark, empty(spark), "").count() == 0
    assert near_dups.drop_near_duplicates(df).count() > len(want)


def test_near_copies_set_links():
    """Links of the asked sets join the given components, as all comparisons would."""
    rng = random.Random(71)
    for _ in range(60):
        bases = [[rng.getrandbits(60) for _ in range(30)] for _ in range(3)]
        sets = []
        for _ in range(rng.randint(1, 25)):
            one = list(rng.choice(bases))
            for j in rng.sample(range(30), rng.randint(0, 6)):
                one[j] = rng.getrandbits(60)
            sets.append(np.unique(np.array(one, np.uint64)))
        n = len(sets)
        label, ask = np.arange(n), np.array([rng.random() < 0.5 for _ in range(n)])
        for i in range(1, n):
            if rng.random() < 0.3:
                label[label == label[i]] = label[0]
        label = np.unique(label, return_index=True)[1][np.unique(label, return_inverse=True)[1]]
        for given, asked in ((None, None), (label, None), (label, ask)):
            root = list(range(n) if given is None else given)
            for i, j in itertools.combinations(range(n), 2):
                both = len(set(sets[i].tolist()) & set(sets[j].tolist()))
                if (asked is None or asked[i] or asked[j]) and 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                    root = [root[i] if r == root[j] else r for r in root]
            got = near_dups.set_links(sets, given, asked)
            assert len({*zip(root, got.tolist(), strict=True)}) == len(set(root)) == len(set(got.tolist()))


def test_near_copies_trees(monkeypatch):
    """Near copies of any size are found by the BK-trees of their fingerprints, in several shards at once; few other pairs reach the exact check."""
    rng = random.Random(79)
    sets, shard = [], []
    for k in range(12):
        for _ in range(8 if k % 3 else 1):
            base = [rng.getrandbits(60) for _ in range(rng.choice((4, 9, 30, 400)))]
            for _ in range(rng.randint(1, 6)):
                one = base + [rng.getrandbits(60)] if len(base) == 4 and rng.random() < 0.5 else list(base)
                for j in rng.sample(range(len(one)), rng.randint(0, len(one) // 8)):
                    one[j] = rng.getrandbits(60)
                sets.append(np.unique(np.array(one, np.uint64)))
                shard.append(k)
    shard, n = np.array(shard), len(sets)
    same = [(i, j) for i, j in itertools.combinations(range(n), 2) if shard[i] == shard[j]]
    both = {(i, j): len(set(sets[i].tolist()) & set(sets[j].tolist())) for i, j in same}
    near = [(i, j) for i, j in same if 9 * both[i, j] >= 4 * (len(sets[i]) + len(sets[j]))]
    prints = np.array([near_dups.set_print(s) for s in sets])
    for s, own in zip(sets[:20], prints, strict=False):
        hashes = [[int(x) for x in near_dups._mixed(np.array([v]) ^ near_dups._WORDS)] for v in s]
        assert own.tolist() == [sum(1 << b for b in range(64) if 2 * sum(h[w] >> b & 1 for h in hashes) > len(s)) for w in range(4)]
    close = lambda i, j: int(np.bitwise_count(prints[i] ^ prints[j]).sum()) <= near_dups.COPY_RADIUS
    found = {(a, b) for q, v in near_dups.BKForest(shard, prints).search(np.arange(n), near_dups.COPY_RADIUS) for a, b in zip(q.tolist(), v.tolist(), strict=True)}
    assert found == {x for i, j in same if close(i, j) for x in ((i, j), (j, i))}
    assert len(near) > 50 and all(close(i, j) for i, j in near)
    root = list(range(n))
    for i, j in near:
        root = [root[i] if r == root[j] else r for r in root]
    checked, common = [], near_dups._in_common
    monkeypatch.setattr(near_dups, "_in_common", lambda own, others, mark: checked.append(len(others)) or common(own, others, mark))
    for given in (None, prints):
        got = near_dups.set_links(sets, shard=shard, prints=given)
        assert len({*zip(root, got.tolist(), strict=True)}) == len(set(root)) == len(set(got.tolist()))
    assert sum(checked) < len(same) / 2
    # a pair whose fingerprints are not within the radius is not compared
    monkeypatch.setattr(near_dups, "COPY_RADIUS", 0)
    checked.clear()
    apart = np.random.default_rng(5).integers(0, 1 << 63, prints.shape).astype(np.uint64)
    assert near_dups.set_links(sets, shard=shard, prints=apart).tolist() == list(range(n)) and not checked


def test_near_copies_hot_group(spark):
    """A large group of near copies is united by its pivot: blocks do not meet in pairs."""
    rng = random.Random(73)
    base = words(100, rng).split()
    docs = []
    for i in range(300):
        one = list(base)
        one[rng.randrange(100)] = f"edit{i}"
        docs.append((i, " ".join(one)))
    found = near_dups.near_copies(frame(spark, docs), block=2_000).collect()
    assert len({r.root for r in found}) == 1 and len(found) == 300
    nodes = spark.range(300).withColumnRenamed("id", "node").withColumns({"key": F.lit(1).cast("bigint"), "blocks": F.lit(15)})
    seen = []
    linked = nodes.where("node > 0 and node < 290").select(F.col("node").alias("u"), F.lit(0).cast("bigint").alias("root"))
    compared, near_dups._compared = near_dups._compared, lambda rows, sets: seen.append(rows.count()) or rows
    try:
        near_dups._between_blocks(nodes, None, linked)
    finally:
        near_dups._compared = compared
    assert seen == [10 * 15 + 300]  # ten nodes in all blocks, all nodes in one


PAGE = """<html><head><title>T</title><script>var a="</p>";</script></head><body><header><h1>Site</h1></header><nav><a href=1>x</a></nav>
<div id="cookie-notice">We use cookies, accept them please now.</div><div class="wrap"><div class="content"><h1>Title &amp; more</h1>
<p>First para, with commas, and some&nbsp;text that is
long enough to score.<p>Second <a href=2>link</a> here, fine.<ul><li>one<li>two</ul></div><aside>side, bar</aside>
<div class="comments"><p>A reader's comment, quite long, with lots, of commas, and more words than the article, has, itself, ok, yes.</p></div></div>
<form>f</form><footer>foot</footer></body></html>"""


def test_op10(spark):
    assert html_text.main_text(PAGE) == "Title & more\nFirst para, with commas, and some text that is long enough to score.\nSecond link here, fine.\none\ntwo"
    assert [html_text.main_text(x) for x in (None, "", "<p>", "<script>x", "plain &lt; text", "<article><h1>Only</h1></article>")] == ["", "", "", "", "plain < text", "Only"]
    assert html_text.main_text("<div>" * 3000 + "deep, text" + "</div>" * 10) == "deep, text"
    deep = "<div>" * 20_000 + "<p>" + "word, " * 40_000
    assert html_text.main_text(deep) == ("word, " * 40_000).strip()
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, None)], "page_id bigint, url string, html string, text string")
    got = html_text.op10(pages).collect()
    assert sorted(r.n_chars for r in got)[0] == 0 and len(got) == 3
    assert html_text.op10(pages.limit(0)).count() == 0


def brute_points(tree, above=()):
    """Points of every element of a tree (tag, children or text), each block handing them on to each ancestor by itself."""
    points = {}

    def walk(node, up):
        tag, kids = node[0], node[1]
        points.setdefault(id(node), 0.0)
        chain = [node, *up]
        if isinstance(kids, str):
            own = 1 + kids.count(",") + min(len(kids) / 100, 3)
            for level, x in enumerate(chain if tag in html_text.CONTAINERS else chain[1:]):
                points[id(x)] = points.get(id(x), 0.0) + own / 2**level
        else:
            for k in kids:
                walk(k, chain)

    walk(tree, [])
    return points


def test_op10_score_decides():
    """Pages without article or main: the container of the most points is kept, as found by handing points on one by one."""
    rng = random.Random(47)
    for _ in range(60):
        serial = itertools.count()

        def text():
            n = next(serial)
            return f"w{n} " + ", ".join(words(rng.randint(1, 12), rng) for _ in range(rng.randint(1, 5)))

        def grow(depth):
            kids = [("p", text()) for _ in range(rng.randint(0, 4))] + [grow(depth - 1) for _ in range(rng.randint(0, 3) if depth else 0)]
            rng.shuffle(kids)
            return "div", kids or [("p", text())]

        body = ("body", [grow(3) for _ in range(rng.randint(1, 3))])
        render = lambda x: f"<{x[0]}>{x[1] if isinstance(x[1], str) else ''.join(map(render, x[1]))}</{x[0]}>"
        nodes, leaves = [], lambda x: [x[1]] if isinstance(x[1], str) else [t for k in x[1] for t in leaves(k)]

        def collect(x, up):
            nodes.append((x, up))
            for k in () if isinstance(x[1], str) else x[1]:
                collect(k, x)

        collect(body, None)
        points = brute_points(("html", [body]))
        score = lambda x: points[id(x)] + html_text.WEIGHT.get(x[0], 0) if points[id(x)] else 0.0
        top, up = max(nodes, key=lambda x: score(x[0]))
        beside = [x for x in (up[1] if up else []) if x is not top]
        keep = {id(top)} | {id(x) for x in beside if points[id(x)] >= max(10.0, 0.2 * score(top)) or x[0] == "p"}
        want = [t for x in (up[1] if up else [top]) if id(x) in keep for t in leaves(x)]
        got = html_text.main_text(f"<html>{render(body)}</html>").split("\n")
        assert got == [" ".join(t.split()) for t in want]
    teasers = "".join(f"<article><h2>Other {i}</h2><p>Teaser {i}.</p></article>" for i in range(3))
    long = "".join(f"<p>Paragraph {i} of the story, with commas, and enough words to weigh.</p>" for i in range(4))
    assert html_text.main_text(f"<body>{teasers}<article><h1>Story</h1>{long}</article></body>").startswith("Story\nParagraph 0")
    page = f"<body><main><h1>Story</h1><article>{long}</article><div class='related'><p>Read, also, this, and that, please, now.</p></div></main></body>"
    assert html_text.main_text(page) == "Story\n" + "\n".join(f"Paragraph {i} of the story, with commas, and enough words to weigh." for i in range(4))


def test_op10_is_linear():
    """Pages that would make a scan quadratic: four times the page takes about four times as long."""
    import time

    bad = {
        "<div>x": "", "<a ": "", "<a '": ">", "<b>x": "", "<b ='<c =\"": ">", "<!x": "", "<!--": "", "&": "", "<": "", "<li>x<div>": "", "<table><tr><td>x": "", "<i></b>": "",
        "<p a=": ">", "a": "", "<p>x</div>": "", "<script>": "", "<hr>": "",
    }
    for part, end in bad.items():
        seconds = []
        for size in (40_000, 160_000):
            page = "<p>start</p><b>" + part * (size // len(part)) + end
            t = time.perf_counter()
            html_text.main_text(page)
            seconds.append(time.perf_counter() - t)
        assert seconds[1] < 10 * seconds[0] + 0.5, part
    assert html_text.main_text("<p>a <a href='x>y' title=it's>b</a> <x y='z>c</p>") == "a b c"


def test_op10_keeps_the_whole_article():
    para = "A paragraph of the article, with commas, and enough words in it, to score well among the others."
    parts = "".join(f"<section id='{x}'><h2 id='{x}-h'>{x}</h2><p>{para} {x}</p></section>" for x in ("related-work", "discussion", "privacy", "legal", "feedback", "search", "responses", "promotion"))
    odd = "<p>See <a href=1>first</a> and <a href=2>second</a>.</p><table><tr><td><a href=1>one</a></td><td><a href=2>two</a></td></tr></table><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> hold.</p>"
    ads = f"<div class='ad'><p>{para} bought</p></div><div class='comments'><p>{para} said</p></div>"
    for outer in ("article", "main", "div class='content'"):
        text = html_text.main_text(f"<body><div id='sidebar'><p>aside, {para}</p></div><{outer}><h1>T</h1><p>{para}</p>{parts}<div id='related-links'><p>{para} kept</p></div>{odd}{ads}</{outer.split()[0]}></body>")
        lines = text.split("\n")
        assert [x for x in ("related-work", "discussion", "privacy", "legal", "feedback", "search", "responses", "promotion") if x not in lines or f"{para} {x}" not in lines] == []
        assert {f"{para} kept", "See first and second.", "one", "two", "Let x=1 hold."} <= set(lines)
        assert "bought" not in text and "said" not in text and "aside" not in text


SIDE_CONTENT = (
    "<div class='notice'>{}</div>", "<div class='promo box'><p>{}</p></div>", "<aside>{}</aside>", "<section class='responses'><h2>Responses</h2><p>{}</p></section>", "<p class='promo'>{}</p>",
    "<nav><a href=1>{}</a></nav>", "<footer>{}</footer>", "<form>{}<input></form>", "<ul class='menu'><li><a href=1>{}</a></li></ul>", "<div class='comments'><p>{}</p></div>", "<script>{}</script>", "<style>{}</style>",
    "<div class='ad'>{}</div>", "<div role='navigation'><p>{}</p></div>", "<div class='newsletter-signup'>{}</div>", "<div class='cookie-banner'>{}</div>", "<!-- {} -->", "<div class='teasers'><a href=1>{}</a> <a href=2>more</a></div>",
    "<div class='comment' id='c1'><p>{}</p></div>", "<section class='recommended'><p>{}</p></section>", "<div hidden>{}</div>",
)
ARTICLE_PARTS = (
    "<p>{}</p>", "<p class='lead'>{}</p>", "<h2 id='related-work'>{}</h2>", "<section id='comments-on-method'><p>{}</p></section>", "<blockquote>{}</blockquote>", "<table><tr><td>{}</td></tr></table>", "<ul><li>{}</li></ul>",
    "<ul><li><a href=1>{}</a></li></ul>", "<div class='figure-with-caption'><p>{}</p></div>", "<pre class='comment'>{}</pre>", "<section class='discussion'><p>{}</p></section>", "<p>{} <a href=1>link</a></p>", "<header><h2>{}</h2></header>",
)


def test_op10_side_content():
    """Two hundred pages whose parts are known: what is the article stays in order, what is not goes, inside the article and beside it."""
    rng = random.Random(61)
    for n in range(200):
        want, serial = [], itertools.count()

        def piece(kinds, kept):
            text = f"{'keep' if kept else 'drop'}{next(serial)} " + ", ".join(words(rng.randint(2, 9), rng) for _ in range(rng.randint(1, 4)))
            shape = rng.choice(kinds)
            if kept:
                want.append(f"{text} link" if "{} <a" in shape else text)
            return shape.format(text)

        inner = "<header><h1>The title</h1><p>By somebody, share</p></header>"
        want.append("The title")
        for _ in range(rng.randint(3, 12)):
            inner += piece(*((ARTICLE_PARTS, True) if rng.random() < 0.6 else (SIDE_CONTENT, False)))
        inner += "<p>last one, of the article, and long enough, with commas, to weigh something at all in any case, whatever else</p>" * 3
        want += ["last one, of the article, and long enough, with commas, to weigh something at all in any case, whatever else"] * 3
        before, after = ("".join(piece(SIDE_CONTENT, False) for _ in range(rng.randint(0, 4))) for _ in range(2))
        page = f"<html><head><title>t</title></head><body><header>drop <h1>Site</h1></header>{before}<article>{inner}</article>{after}</body></html>"
        if n % 2:  # without an article: a container of the most points
            page = page.replace("<article>", "<div class='content'>").replace("</article>", "</div>")
            want = [w for w in want if w != "The title"]  # a header outside an article is the page's
            got = [x for x in html_text.main_text(page).split("\n")]
            assert not [x for x in got if x.startswith("drop")], page
            assert {w for w in want if w.startswith("last")} <= set(got), page
        else:
            assert html_text.main_text(page).split("\n") == want, page


def test_pipeline(spark, tmp_path):
    rng = random.Random(23)
    item = words(20, rng)
    passage = words(60, rng)
    base = words(200, rng)
    rows = [(1, None), (2, "123"), (3, base), (4, base), (5, base.replace(" ", "\n", 1)), (6, f"{words(50, rng)} {passage} {words(50, rng)}"), (7, f"{words(50, rng)} {passage} {words(40, rng)}"), (8, f"{words(40, rng)} {item}"), (9, words(30, rng))]
    docs = frame(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = docs
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, str(tmp_path))
        ids = sorted(r.doc_id for r in kept.select("doc_id").collect())
        seen.append((name, ids))
        if name != "packing":
            assert kept.dtypes == docs.dtypes
        if name == "substring_dedup":
            texts = {r.doc_id: r for r in kept.collect()}
            assert passage in texts[6].text and passage not in texts[7].text and texts[7].n_chars == len(texts[7].text)
    assert [s[1] for s in seen] == [[3, 4, 5, 6, 7, 8, 9], [3, 6, 7, 8, 9], [3, 6, 7, 8, 9], [3, 6, 7, 9], [3, 6, 7, 9]]
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r.doc_id for r in out.collect()) == [3, 6, 7, 9]
    clash = ["row", "key", "doc", "fp", "root", "node", "n", "bucket", "score", "l", "text_hash", "k", "i", "spans", "n_words"]
    wide = docs.withColumns({c: F.lit(i) for i, c in enumerate(clash)})
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), str(tmp_path)).count() == 0
        wide = stage(spark, wide, str(tmp_path))
        if name != "packing":
            assert wide.columns == [*docs.columns, *clash]
    assert sorted(r.doc_id for r in wide.collect()) == [3, 6, 7, 9]


def test_pipeline_resumes(spark, tmp_path, monkeypatch):
    """A run that names its folder goes on behind its last finished stage; without a folder a failed run leaves nothing. Null ids pass all stages."""
    rng = random.Random(29)
    frame(spark, [(None, words(40, rng)), (None, words(40, rng)), (3, words(40, rng)), (4, None)]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, words(20, rng))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages, calls, broken = corpus_pipeline.STAGES, [], [True]

    def counted(name, stage):
        def run(spark, docs, sf_dir):
            calls.append(name)
            if name == "substring_dedup" and broken[0]:
                raise RuntimeError("lost")
            return stage(spark, docs, sf_dir)

        return run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, counted(n, s)) for n, s in stages])
    monkeypatch.setattr(corpus_pipeline, "shared_dir", lambda _: str(tmp_path / "shared"))
    names, folder = [n for n, _ in stages], tmp_path / "run"
    for where in (None, str(folder)):
        with pytest.raises(RuntimeError):
            corpus_pipeline.run(spark, str(tmp_path), where)
    assert not list((tmp_path / "shared").glob("*/*")) and [p.name for p in folder.iterdir()] == [names[1]]
    calls.clear()
    broken[0] = False
    first = corpus_pipeline.run(spark, str(tmp_path), str(folder))
    assert calls == names[2:] and [p.name for p in folder.iterdir()] == [names[-1]]
    again = corpus_pipeline.run(spark, str(tmp_path), str(folder))
    assert calls == names[2:] and sorted(map(str, again.collect())) == sorted(map(str, first.collect()))
    assert sorted(str(r.doc_id) for r in first.collect()) == ["3", "None", "None"]
