"""Grouping of spelling variants: k-d trees over the letter counts of words.

One edit changes the counts of letters by at most two in all (a replacement: exactly two; an inserted letter: exactly one), so the words near a word lie within
that L1 distance of its letter counts.  For each pair of lengths (equal, or one apart) a tree of the longer words is searched: boxes farther away than the
distance are pruned, words of the leaves that are left are compared by their counts, and at last letter by letter.

The words of a length are dealt to cells by the upper part of a tree, fitted on a sample of at most about ``SAMPLE`` words (which only balances the
cells: every word lies in exactly one, every word within reach of a cell is sent there).  Each cell builds its own tree in one task and is searched
by a stream of words; it hands on a count and the best near word for each word, no pairs.  Cells hold about ``CELL_WORDS`` words, or
a ``CELLS``-th of all, so the upper trees that go to all tasks take 12 MB at most; a cell that holds more letters than that all the same (words of equal counts cannot be parted) is cut into
blocks by a hash, and each block is searched by itself.

Defined results: null or empty texts hold no words; texts and words may have any length; a null id counts as the empty text in the hash; repeated rows count again; an empty
table gives no rows; of near words that are equally frequent the smallest is the form.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewarden.llm.common import cut, lower_ascii, release_memory

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
TYPO_EVERY = 199
CELL_WORDS, CELLS, SAMPLE = 8192, 16_384, 100_000
#: Words longer than this share one cell a length, without an upper tree; an average word has so many letters.
LONG, LETTERS = 64, 12
LEAF = 12
#: Pairs that are compared at once.
CHUNK = 1 << 17

#: Code points of the letters: a-z and U+00C0 to U+00FF.
ALPHABET = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], np.uint32)


def codes(words: list[str], length: int) -> np.ndarray:
    """Words of one length as rows of code points."""
    return np.array(words, f"<U{length}").view(np.uint32).reshape(len(words), length)


def letter_counts(code: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Counts of the given letters (ascending), and last of all others."""
    n, d = len(code), len(letters) + 1
    at = np.searchsorted(letters, code)
    other = np.append(letters, 0)[at] != code
    at[other] = d - 1
    count = np.bincount((at + np.arange(n)[:, None] * d).ravel(), minlength=n * d).reshape(n, d)
    return count.astype(np.uint8 if code.shape[1] < 256 else np.uint32)


class KDTree:
    """A k-d tree over rows of counts; boxes are tight, or loose: then the boxes of the leaves part the whole space."""

    def __init__(self, points: np.ndarray, leaf: int, loose: bool = False):
        kids, low, high, self.members = [], [], [], []
        top = np.iinfo(points.dtype).max
        work = [(np.arange(len(points)), np.zeros(points.shape[1], points.dtype), np.full(points.shape[1], top, points.dtype), -1, 0)]
        while work:
            rows, lo, hi, parent, side = work.pop()
            own = points[rows]
            if not loose and len(rows):
                lo, hi = own.min(axis=0), own.max(axis=0)
            node = len(kids)
            low.append(lo)
            high.append(hi)
            kids.append([-1, -1])
            if parent >= 0:
                kids[parent][side] = node
            found = self._split(own) if len(rows) > leaf else None
            if found is None:
                kids[node] = [-1, len(self.members)]
                self.members.append(rows)
                continue
            dim, value = found
            left = own[:, dim] <= value
            below, above = hi.copy(), lo.copy()
            below[dim], above[dim] = value, value + 1
            work.append((rows[left], lo, below, node, 0))
            work.append((rows[~left], above, hi, node, 1))
        self.kids, self.low, self.high = np.array(kids), np.array(low), np.array(high)

    @staticmethod
    def _split(own: np.ndarray) -> tuple[int, int] | None:
        """The dimension of most variance, and the largest value of its lower part."""
        spread = own.var(axis=0)
        dim = int(spread.argmax())
        if not spread[dim]:
            return None
        column = own[:, dim]
        value = int(np.median(column))
        return dim, value if value < column.max() else int(column[column < value].max())

    def leaves(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (query, leaf) for leaves whose box is within the radius."""
        work = [(np.arange(len(queries)), np.zeros(len(queries), np.int64))] if len(queries) else []
        while work:
            query, node = work.pop()
            if len(query) > CHUNK:
                half = len(query) // 2
                work += [(query[:half], node[:half]), (query[half:], node[half:])]
                continue
            q = queries[query]
            away = (np.maximum(self.low[node], q) - np.minimum(self.high[node], q)).sum(axis=1, dtype=np.int64)
            near = away <= radius
            query, node = query[near], node[near]
            kid = self.kids[node]
            leaf = kid[:, 0] < 0
            if leaf.any():
                yield query[leaf], kid[leaf, 1]
            if not leaf.all():
                inner, q = kid[~leaf], query[~leaf]
                work.append((np.concatenate((q, q)), np.concatenate((inner[:, 0], inner[:, 1]))))


class Cell:
    """The words of one length of a cell, ready to be searched."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.words, self.n, self.length = words, n, len(words[0])
        self.code = codes(words, self.length)
        self.letters = np.unique(self.code)
        self.counts = letter_counts(self.code, self.letters)
        self.tree = KDTree(self.counts, LEAF)
        sizes = np.array([len(m) for m in self.tree.members])
        self.start = np.concatenate(([0], np.cumsum(sizes)))
        self.order = np.concatenate(self.tree.members)

    def near(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (query, own word) that are one edit apart; queries all have the cell's length, or all one letter less."""
        length = len(words[0])
        code, radius = codes(words, length), 2 if length == self.length else 1
        counts = letter_counts(code, self.letters).astype(self.counts.dtype, copy=False)
        verify = self._replaced if radius == 2 else self._inserted
        for query, leaf in self.tree.leaves(counts, radius):
            first, width = self.start[leaf], self.start[leaf + 1] - self.start[leaf]
            ends = np.cumsum(width)
            for a in range(0, int(ends[-1]), CHUNK):  # a leaf may hold any number of words of equal counts
                lo, hi = np.searchsorted(ends, a, "right"), np.searchsorted(ends, min(a + CHUNK, ends[-1]), "left") + 1
                w, f = width[lo:hi].copy(), first[lo:hi].copy()
                skip, over = a - (ends[lo] - width[lo]), max(0, ends[hi - 1] - (a + CHUNK))
                f[0], w[0] = f[0] + skip, w[0] - skip
                w[-1] -= over
                at = np.repeat(f - np.concatenate(([0], np.cumsum(w)[:-1])), w) + np.arange(w.sum())
                q, v = np.repeat(query[lo:hi], w), self.order[at]
                x, y = counts[q], self.counts[v]
                near = (np.maximum(x, y) - np.minimum(x, y)).sum(axis=1, dtype=np.int64) == radius
                q, v = q[near], v[near]
                if len(q):
                    one = verify(code[q], self.code[v])
                    yield q[one], v[one]

    @staticmethod
    def _replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a != b).sum(axis=1) == 1

    @staticmethod
    def _inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
        """Whether the equal letters in front and behind make up the shorter word."""
        front = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(axis=1)
        back = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
        return front + back >= short.shape[1]


def _best(key: np.ndarray, other: np.ndarray, n: np.ndarray, words: list[str], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each key: how many others, and the most frequent of them (ties: the smallest)."""
    rank = np.empty(len(words), np.int64)
    rank[np.argsort(np.array(words, f"<U{length}"), kind="stable")] = np.arange(len(words))
    order = np.lexsort((rank[other], -n[other], key))
    key, other = key[order], other[order]
    head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[head], np.diff(np.append(head, len(key))), other[head]


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, block, asks, word, n) in order -> (word, n_near, best_n, best) for each word that has near ones there."""

    def told(words: list[str], key, count, others: list[str], n: np.ndarray, best) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([words[i] for i in key], pa.string()), pa.array(count, pa.int64()), pa.array(n[best], pa.int64()), pa.array([others[i] for i in best], pa.string())],
            ["word", "n_near", "best_n", "best"],
        )

    def search(cell: Cell, words: list[str], n: np.ndarray) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(w) for w in words])
        for length in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == length)
            asked, count = [words[i] for i in own], n[own]
            found = list(cell.near(asked))
            if not found:
                continue
            q, v = (np.concatenate(x) for x in zip(*found, strict=True))
            if not len(q):
                continue
            key, many, best = _best(q, v, cell.n, cell.words, cell.length)
            yield told(asked, key, many, cell.words, cell.n, best)
            if length < cell.length:  # the longer words do not ask for shorter ones
                key, many, best = _best(v, q, count, asked, length)
                yield told(cell.words, key, many, asked, count, best)

    held, cell, now = [], None, None
    for b in batches:
        place = np.rec.fromarrays([b.column(k).to_numpy() for k in (0, 1)])
        asks = b.column(2).to_numpy()
        cuts = [0, *(np.flatnonzero((place[1:] != place[:-1]) | (asks[1:] != asks[:-1])) + 1).tolist(), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if lo == hi:
                continue
            if now != place[lo].tolist():
                held, cell, now = [], None, place[lo].tolist()
            words, n = b.column(3).slice(lo, hi - lo), b.column(4).slice(lo, hi - lo)
            if not asks[lo]:
                held.append((words, n))
                continue
            if cell is None and held:
                cell = Cell([w for x, _ in held for w in x.to_pylist()], np.concatenate([y.to_numpy() for _, y in held]))
                held = []
            if cell is not None:
                yield from search(cell, words.to_pylist(), n.to_numpy())
    release_memory()


def _routed(trees: dict[int, KDTree], blocks: dict[int, int], asks: bool):
    """(word, n) -> (cell, block, asks, word, n): each word in its own cell, and with asks also in all within its reach."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = pc.utf8_length(b.column(0)).to_numpy()
            rows, cells, kinds = [], [], []

            def put(at: np.ndarray, length: int, leaf: np.ndarray, kind: int) -> None:
                rows.append(at)
                cells.append((length << 20) + leaf)
                kinds.append(np.full(len(at), kind, np.int32))

            for length in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == length)
                counts = letter_counts(codes(b.column(0).take(pa.array(at)).to_pylist(), length), ALPHABET) if length <= LONG + 1 else None
                for size, radius, kind in ((length, 0, 0), (length, 2, 1), (length + 1, 1, 1))[: 3 if asks else 1]:
                    if size in trees:
                        for q, leaf in trees[size].leaves(counts, radius):
                            put(at[q], size, leaf, kind)
                    else:
                        put(at, size, np.zeros(len(at), np.int64), kind)
            row, cell, kind = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (rows, cells, kinds))
            kind = kind.astype(np.int32)
            number = np.array([blocks.get(c, 1) for c in cell.tolist()], np.int64)
            block = np.zeros(len(cell), np.int64)
            for i in np.flatnonzero((number > 1) & (kind == 0)).tolist():
                block[i] = xxhash.xxh32_intdigest(b.column(0)[int(row[i])].as_py()) % int(number[i])
            copies = np.where(kind == 1, number, 1)
            at = np.repeat(np.arange(len(cell)), copies)
            block = np.where(kind[at] == 1, np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies), block[at])
            words = b.take(pa.array(row[at], pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(cell[at], pa.int64()), pa.array(block.astype(np.int32)), pa.array(kind[at]), *words.columns], ["cell", "block", "asks", "word", "n"])

    return step


PLACED = "cell bigint, block int, asks int, word string, n bigint"


def upper_trees(words: DataFrame, total: int, cell_words: int = CELL_WORDS, sample: int = SAMPLE) -> dict[int, KDTree]:
    """For each length with more words than a cell takes: a tree whose leaves are the cells."""
    share = min(1.0, sample / max(total, 1))
    top = 1 << 30
    taken = words.where((F.length("word") <= LONG) & (F.pmod(F.xxhash64("word"), F.lit(top)) < int(share * top))) if share < 1 else words.where(F.length("word") <= LONG)
    by_length: dict[int, list[str]] = {}
    for r in taken.select("word").collect():  # about `sample` words
        by_length.setdefault(len(r.word), []).append(r.word)
    leaf = max(1, int(max(cell_words, total / CELLS) * share))
    return {k: KDTree(letter_counts(codes(v, k), ALPHABET), leaf, loose=True) for k, v in by_length.items() if len(v) > leaf}


def near_words(words: DataFrame, cell_words: int = CELL_WORDS, sample: int = SAMPLE) -> DataFrame:
    """(word, n) with distinct words -> (word, n_near, best_n, best) for words one edit away from others."""
    total = words.count()
    trees = upper_trees(words, total, cell_words, sample)
    most = max(cell_words, total / CELLS)
    letters = words.mapInArrow(_routed(trees, {}, False), PLACED).groupBy("cell").agg(F.sum(F.length("word")).alias("letters"))
    # cells that the trees did not part well enough: fewer than all letters / (2 * LETTERS * most)
    over = letters.where(F.col("letters") > 2 * LETTERS * most).collect()
    blocks = {r.cell: math.ceil(r.letters / (LETTERS * most)) for r in over}
    placed = words.mapInArrow(_routed(trees, blocks, True), PLACED)
    found = placed.repartition("cell", "block").sortWithinPartitions("cell", "block", "asks").mapInArrow(_searched, "word string, n_near bigint, best_n bigint, best string")
    first = F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("first")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first).select("word", "n_near", (-F.col("first.n")).alias("best_n"), "first.best")


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """(word, form) -> (word, root), by doubling of the way; a form is RATIO times as frequent, so ways are short."""
    steps = max(1, math.ceil(math.log(max(most, 1), RATIO)))
    out = cut(forms.select("word", F.col("form").alias("root")))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        on = out.select(F.col("word").alias("root"), F.col("root").alias("further"))
        out = cut(out.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")))
    return out


def typo(doc_id: Column, run: Column) -> Column:
    """The run, without one letter if the hash of id and run says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    less = F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length(run)))
    return F.when(h % TYPO_EVERY == 0, less).otherwise(run)


def vocabulary(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of at least MIN_LENGTH letters and min_count occurrences; counted in part before they are shuffled."""
    runs = F.explode(F.regexp_extract_all(lower_ascii(documents[text]), F.lit(f"[a-zÀ-ÿ]{{{MIN_LENGTH},}}"), F.lit(0)))
    words = documents.select(documents[doc_id].alias("id"), runs.alias("run")).select(typo(F.col("id"), F.col("run")).alias("word"))
    return words.where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def variants(words: DataFrame, ratio: int = RATIO, cell_words: int = CELL_WORDS, sample: int = SAMPLE) -> DataFrame:
    """(word, n) -> (word, form, root, n, n_near, form_n)."""
    words = cut(words)
    near = near_words(words, cell_words, sample)
    rows = words.join(near, "word", "left")
    is_form = F.col("best_n") >= ratio * F.col("n")
    rows = rows.select("word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"))
    rows = cut(rows)
    most = words.agg(F.max("n")).first()[0] or 1
    roots = _roots(rows.where("form is not null"), most)
    out = rows.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12(documents: DataFrame) -> DataFrame:
    return variants(vocabulary(documents))


SQL = r"""
WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda b: list_reduce([b] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
d AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+') AS runs FROM documents),
r AS (SELECT id, run, count(*) AS n FROM (SELECT id, unnest(runs) AS run FROM d) WHERE length(run) >= 6 GROUP BY id, run),
x AS (SELECT id, run, n, hex(encode(id || ':' || run)) AS x FROM r),
h AS (SELECT run, n, xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT),
  lambda c, b: xor(c >> 8, t.crc[xor(c & 255, b) + 1])), 4294967295) AS h FROM x, t),
w AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
v AS (SELECT word, sum(n)::BIGINT AS n FROM w WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
g AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (SELECT a.word, b.word AS near, b.n FROM g a JOIN g b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM v a JOIN g b ON a.word = b.less
  UNION SELECT b.word, a.word, a.n FROM v a JOIN g b ON a.word = b.less),
m AS (SELECT word, count(*) AS n_near, max(n) AS top FROM p GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(m.n_near, 0)::BIGINT AS n_near, CASE WHEN m.top >= 5 * v.n THEN m.top END AS form_n FROM v LEFT JOIN m ON m.word = v.word),
c AS (SELECT f.word, min(p.near) AS form FROM f JOIN p ON p.word = f.word AND p.n = f.form_n GROUP BY f.word),
s AS (SELECT word, form AS root, 1 AS k FROM c UNION ALL SELECT s.word, c.form, k + 1 FROM s JOIN c ON c.word = s.root)
SELECT f.word, c.form, coalesce(z.root, f.word) AS root, f.n, f.n_near, f.form_n
FROM f LEFT JOIN c ON c.word = f.word LEFT JOIN (SELECT word, arg_max(root, k) AS root FROM s GROUP BY word) z ON z.word = f.word
"""
