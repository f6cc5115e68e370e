"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark texts are normalised to letter-and-digit words.  A window of 13 consecutive words holds one of the pieces of 7
words that start at every seventh word of its item, so these pieces (and items of less than 13 words as a whole) are the
patterns of an automaton over word numbers: flat sorted arrays with a node for about each word of the benchmark.  The texts of a batch are normalised
once by a byte map and scanned once, in stretches that step through the automaton together.  Around each piece that is hit, the windows of the text are
looked up by a hash that tells all windows of the benchmark apart, and compared word by word; no alignment is grown, so a
repetitive item costs no more than any other.  Hits are mapped back to character offsets of the original text.

The automaton is built in each Python worker from a broadcast block of the benchmark of ``block_bytes`` of text at most, which bounds the
memory of a worker (12 bytes for a byte of text in words of four letters, three times that while it is built).  A larger benchmark is cut into blocks by a hash of
its text.  All blocks but the last leave only the digests of the texts they hit, with the hits, which join the scan of the last one; no text is
written between passes, and no worker or driver holds two blocks.  Documents are shuffled only for that join, and only where the hits are too many to be broadcast.

Defined results: null or empty texts have no words and no hits; very long texts are scanned whole; items without words match nothing;
items with a null id mark words but are not listed; repeated items are listed once; repeated
document rows get the same result each; an empty benchmark hits nothing, an empty table gives no rows; other columns pass through.
A column that is named like a result is replaced by it.
"""

from __future__ import annotations

import functools
import math
from array import array
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewarden.llm.common import WORD_BYTES, cut, release_memory

WINDOW = 13
BLOCK_BYTES = 16 << 20
#: Words of a stretch of text that one lane of the scan steps through.
STRETCH = 128
HITS = "struct<n_words:bigint,spans:array<struct<w0:bigint,w1:bigint,c0:bigint,c1:bigint>>,items:array<string>>"


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_BYTES).split()


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (size[0] numbers), then those of first[1], and so on."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)


class Automaton:
    """Pieces of the benchmark's items as an Aho-Corasick automaton over word numbers, and the items' distinct windows.

    Words are numbered from 1; 0 stands for any other word.  Node 0 is the root; the edges, ordered by node and word, lead to nodes 1, 2, ..."""

    def __init__(self, texts: list[str], window: int):
        self.window, self.numbers, flat, starts = window, {}, array("i"), [0]
        for text in texts:
            flat.extend([self.numbers.setdefault(w, len(self.numbers) + 1) for w in _words(text.encode())])
            starts.append(len(flat))
        self.flat, self.base = np.array(flat, np.int32), len(self.numbers) + 1
        start, length = np.array(starts[:-1], np.int64), np.diff(np.array(starts, np.int64))
        self._index_windows(start, length)
        self._build(start, length)

    def _index_windows(self, start: np.ndarray, length: np.ndarray) -> None:
        size = np.minimum(length, self.window)
        count = np.where(length > 0, length - size + 1, 0)
        at, size, item = _ranges(start, count), np.repeat(size, count), np.repeat(np.arange(len(start)), count)
        for self.seed in range(1, 100):  # the first under which no two windows share a hash: in practice the very first
            h = self._hash(self.flat, at, size)
            order = np.argsort(h, kind="stable")  # so that the items of a window ascend
            h = h[order]
            new = np.concatenate(([True], h[1:] != h[:-1])) if len(h) else np.empty(0, bool)
            first, group = order[new], np.cumsum(new) - 1
            again, model = order[~new], first[group[~new]]
            if (size[again] == size[model]).all() and all(self._agree(at[again], at[model], size[again] > j, j) for j in range(self.window)):
                break
        else:
            raise ValueError("windows of the benchmark cannot be told apart")
        # of the distinct windows, ascending by hash; and the items of each, one after another
        self.hashes, self.place, self.size = h[new], at[first].astype(np.int32), size[first].astype(np.int32)
        item = item[order]
        other = new | np.concatenate(([True], item[1:] != item[:-1])) if len(h) else new
        self.owner = item[other].astype(np.int32)
        self.owners = np.append(np.flatnonzero(new[other]), len(self.owner)).astype(np.int32)

    def _agree(self, a: np.ndarray, b: np.ndarray, on: np.ndarray, j: int) -> bool:
        return bool((self.flat[a[on] + j] == self.flat[b[on] + j]).all())

    def _hash(self, words: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """A hash of words[at : at + size] for each place."""
        h = size.astype(np.uint64) + np.uint64(self.seed)
        for j in range(int(size.max()) if len(size) else 0):
            on = size > j
            w = words[at[on] + j].astype(np.uint64)
            x = (h[on] ^ (w * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
            h[on] = x ^ (x >> np.uint64(32))
        return h

    def _build(self, start: np.ndarray, length: np.ndarray) -> None:
        step = (self.window + 1) // 2
        whole = length < self.window
        count = np.where(whole, np.minimum(length, 1), length // step)
        nth = _ranges(np.zeros(len(start), np.int64), count)
        at = np.repeat(start, count) + step * nth
        size = np.where(np.repeat(whole, count), np.repeat(length, count), step)
        node, nodes, levels = np.zeros(len(at), np.int64), 1, []
        for depth in range(int(size.max()) if len(size) else 0):
            on = size > depth
            edges, to = np.unique(node[on] * self.base + self.flat[at[on] + depth], return_inverse=True)
            node[on] = nodes + to
            levels.append((nodes, edges))
            nodes += len(edges)
        self.depth = len(levels)
        self.edges = np.concatenate([e for _, e in levels]) if levels else np.empty(0, np.int64)
        self.root = np.zeros(self.base, np.int32)
        self.fail, self.longest = np.zeros(nodes, np.int32), np.zeros(nodes, np.int32)  # longest: the next pattern that ends here too
        ends, self.piece = np.zeros(nodes, bool), np.zeros(nodes, bool)
        ends[node], self.piece[node[~np.repeat(whole, count)]] = True, True
        self.whole = np.full(nodes, -1, np.int32)  # the window that a pattern is
        short = np.repeat(whole, count)
        self.whole[node[short]] = np.searchsorted(self.hashes, self._hash(self.flat, at[short], size[short]))
        for level, (first, edges) in enumerate(levels):
            if level == 0:
                self.root[edges] = first + np.arange(len(edges))
            else:
                self.fail[first : first + len(edges)] = self._next(self.fail[edges // self.base], edges % self.base)
            fail = self.fail[first : first + len(edges)]
            self.longest[first : first + len(edges)] = np.where(ends[fail], fail, self.longest[fail])
        self.ends = ends

    def _next(self, node: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Where each node goes with its word."""
        out = self.root[word]
        left = np.flatnonzero((node != 0) & (word != 0))
        node = node[left].astype(np.int64)
        while len(left):
            edge = node * self.base + word[left]
            i = np.minimum(np.searchsorted(self.edges, edge), len(self.edges) - 1)
            on = self.edges[i] == edge
            out[left[on]] = i[on] + 1
            left, node = left[~on], self.fail[node[~on]].astype(np.int64)
            left, node = left[node != 0], node[node != 0]
        return out

    def windows(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, window) of each occurrence of a window in the words."""
        at, node = self._patterns(words)
        piece = np.flatnonzero(self.piece[node])
        whole = np.flatnonzero(self.whole[node] >= 0)
        step = (self.window + 1) // 2
        near = np.unique((at[piece] + 1 - self.window)[:, None] + np.arange(self.window - step + 1)[None, :])
        near = near[(near >= 0) & (near + self.window <= len(words))]
        h = self._hash(words, near, np.full(len(near), self.window))
        i = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        on = (self.hashes[i] == h) & (self.size[i] == self.window) if len(near) else np.empty(0, bool)
        near, i = near[on], i[on]
        same = np.ones(len(near), bool)
        for j in range(self.window if len(near) else 0):
            same &= words[near + j] == self.flat[self.place[i] + j]
        short = self.whole[node[whole]]
        return np.concatenate((near[same], at[whole] + 1 - self.size[short])), np.concatenate((i[same], short))

    def _patterns(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of its last word, node) of each pattern in the words; a stretch starts as many words early as the longest pattern has."""
        lanes = np.arange(0, len(words), STRETCH)
        padded = np.concatenate((np.zeros(self.depth, np.int32), words, np.zeros(STRETCH, np.int32)))
        node, places, nodes = np.zeros(len(lanes), np.int32), [np.empty(0, np.int64)], [np.empty(0, np.int32)]
        for t in range(self.depth + STRETCH):
            node = self._next(node, padded[lanes + t])
            if t >= self.depth:
                on = np.flatnonzero(self.ends[node] | (self.longest[node] != 0))
                places.append(lanes[on] + t - self.depth)
                nodes.append(node[on])
        at, node = np.concatenate(places), np.concatenate(nodes)
        places, nodes = [], []
        while True:
            on = self.ends[node]
            places.append(at[on])
            nodes.append(node[on])
            if not len(node):
                return np.concatenate(places), np.concatenate(nodes)
            node = self.longest[node]
            at, node = at[node != 0], node[node != 0]


class Block:
    """A block of (item id, text); its automaton is built once in each worker."""

    def __init__(self, items: list[tuple], window: int):
        self.items, self.window = items, window

    def __getstate__(self):
        return {"items": self.items, "window": self.window}

    @functools.cached_property
    def automaton(self) -> Automaton:
        return Automaton([text for _, text in self.items], self.window)


def _scan(texts: list[bytes | None], block: Block) -> list[tuple]:
    """(number of words, word spans, item ids, character spans) of each text."""
    auto = block.automaton
    words = [_words(t) for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(counts + 1)  # an unknown word between texts keeps them apart
    begins = ends - counts - 1
    if not auto.depth:
        return [(len(w), [], [], []) for w in words]
    known = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
    for w, a in zip(words, begins, strict=True):
        known[a : a + len(w)] = np.fromiter(map(auto.numbers.get, w, repeat(0)), np.int32, len(w))
    start, found = auto.windows(known)
    edge = np.zeros(len(known) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + auto.size[found], -1)
    covered = np.concatenate(([False], np.cumsum(edge)[:-1] > 0, [False]))
    lo, hi = (np.flatnonzero(covered[1:-1] & ~covered[:-2]), np.flatnonzero(covered[1:-1] & ~covered[2:]) + 1)
    spans: list[list] = [[] for _ in words]
    for a, b, row in zip(lo, hi, np.searchsorted(ends, lo, "right"), strict=True):
        spans[row].append((int(a - begins[row]), int(b - begins[row])))
    pairs = np.unique(np.searchsorted(ends, start, "right") * len(auto.size) + found)
    row, found = pairs // len(auto.size), pairs % len(auto.size)
    many = auto.owners[found + 1] - auto.owners[found]
    listed = np.unique(np.repeat(row, many) * len(block.items) + auto.owner[_ranges(auto.owners[found], many)])
    items: list[set] = [set() for _ in words]
    for r, i in zip(listed // len(block.items), listed % len(block.items), strict=True):
        items[r].add(block.items[i][0])
    return [
        (len(w), s, sorted(x for x in i if x is not None), _offsets(t, w, s)) for t, w, s, i in zip(texts, words, spans, items, strict=True)
    ]


def _offsets(text: bytes | None, words: list[bytes], spans: list[list[int]]) -> list[tuple[int, int]]:
    """Character offsets in the original text of word spans."""
    if not spans:
        return []
    flat, starts, at = text.translate(WORD_BYTES), [], 0
    for w in words:
        at = flat.index(w, at)
        starts.append(at)
        at += len(w)
    out, byte, char = [], 0, 0
    for a, b in spans:
        first, last = starts[a], starts[b - 1] + len(words[b - 1])
        c0 = char + len(text[byte:first].decode())
        c1 = c0 + len(text[first:last].decode())
        out.append((c0, c1))
        byte, char = last, c1
    return out


def _scanner(shared):
    @F.pandas_udf(HITS)
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = [
            (n, [{"w0": a, "w1": b, "c0": c, "c1": d} for (a, b), (c, d) in zip(spans, chars, strict=True)], items)
            for n, spans, items, chars in _scan(list(texts), shared.value)
        ]
        release_memory()
        return pd.DataFrame(rows, columns=["n_words", "spans", "items"])

    return scan.asNondeterministic()  # else a filter on the result would compute it twice


def benchmark_blocks(benchmark: DataFrame, item_id: str, text: str, window: int, block_bytes: int):
    """Yields the benchmark in blocks of about block_bytes at most, one block in memory at a time."""
    items = benchmark.select(F.col(item_id).cast("string").alias("i"), F.coalesce(F.col(text), F.lit("")).alias("t")).distinct()
    total = items.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    place = F.pmod(F.xxhash64("i", "t"), F.lit(n))
    for b in range(n):
        yield b + 1 == n, Block([(r.i, r.t) for r in items.where(place == b).collect()], window)


def decontaminate(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    share: int = 20,
    block_bytes: int = BLOCK_BYTES,
    prefix: str = "",
) -> DataFrame:
    """Adds n_words, n_hit, item_ids (sorted texts), spans (of the original text: word and character
    ranges) and contaminated (n_hit > 0 and share * n_hit >= n_words), each named with the prefix."""
    digest = F.sha2(F.coalesce(F.col(text).cast("binary"), F.lit(b"")), 256)
    out, before = documents, []
    for last, block in benchmark_blocks(benchmark, item_id, item_text, window, block_bytes):
        shared = documents.sparkSession.sparkContext.broadcast(block)
        scanned = _scanner(shared)(F.col(text).cast("binary"))
        if last:
            out = out.withColumn("__hits", scanned)
        else:  # hits follow from the text alone, so its digest is their key
            hit = documents.select(digest.alias("__digest"), scanned.alias("__hits")).where(F.size("__hits.spans") > 0)
            before.append(cut(hit.select("__digest", "__hits.spans", "__hits.items").dropDuplicates(["__digest"])))
            shared.unpersist()
    spans, items = F.col("__hits.spans"), F.col("__hits.items")
    if before:  # of one digest, at most one row a block
        found = functools.reduce(DataFrame.union, before).groupBy("__digest")
        found = found.agg(F.flatten(F.collect_list("spans")).alias("__spans"), F.flatten(F.collect_list("items")).alias("__items"))
        out = out.withColumn("__digest", digest).join(found, "__digest", "left")
        with_former = lambda c, more: F.concat(c, F.coalesce(more, F.slice(c, 1, 0)))
        spans, items = with_former(spans, F.col("__spans")), with_former(items, F.col("__items"))
    out = out.withColumns(
        {
            f"{prefix}n_words": F.col("__hits.n_words"),
            f"{prefix}spans": F.array_sort(spans),
            f"{prefix}item_ids": F.array_sort(F.array_distinct(items)),
        }
    )
    out = out.withColumn(f"{prefix}n_hit", _united(F.col(f"{prefix}spans")))
    hit, n = F.col(f"{prefix}n_hit"), F.col(f"{prefix}n_words")
    return out.withColumn(f"{prefix}contaminated", (hit > 0) & (hit * share >= n)).drop("__hits", "__digest", "__spans", "__items")


def _united(spans: Column) -> Column:
    """Words in the union of sorted word ranges."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end"))

    def step(s, x):
        return F.struct(
            (s["n"] + F.greatest(x["w1"] - F.greatest(x["w0"], s["end"]), F.lit(0).cast("bigint"))).alias("n"),
            F.greatest(s["end"], x["w1"]).alias("end"),
        )

    return F.aggregate(spans, start, step, lambda s: s["n"])


def op1(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's digest columns: one row for each document row."""
    found = decontaminate(documents.select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS x
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT r, k, i, array_to_string(w[i : i + k - 1], ' ') AS x
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
m AS (SELECT r, dw.k, i, item_id FROM dw JOIN bw USING (k, x)),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + k)) AS p FROM m) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM m WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""
