"""Substring deduplication with suffix automata of reference shards.

A word goes if a window of ``WINDOW`` = 13 words that covers it also starts in a document of a smaller id.

1. Every document is read once.  Of the nine 5-word grams in a window the one with the smallest hash is the window's
   anchor, so a window has the same anchor wherever it stands, and consecutive windows with one anchor form a run.
   A run is one row (anchor, hash of the run's words, id): about one row for five words.  Equal runs within a batch are
   resolved on the spot (map-side combine), so a frequent passage sends one row a batch.
2. Rows meet by anchor, sorted, and are streamed: of equal runs all but those of the smallest id are repeats.  Different
   runs of one anchor may still share windows.  A window has eight words around its anchor, so four at least on one side:
   runs can only share one if the four words before the anchor or the four after it are the same in both.  Such runs are contested;
   16 bits of the hash of either side tell, and equal bits of different words only add work.
3. Contested runs form the reference shards: for each anchor, passages are taken in the order of ids, matched
   against a suffix automaton of all passages of smaller ids (matching statistics; 13 words or more
   are a repeat), and then added to it.  The automata are built where their shard lies, not broadcast: repeats grow
   with the corpus, so no bound would hold for a broadcast.  An anchor with more than ``MOST_RUNS`` contested runs
   (a frequent line in many contexts) is resolved exactly by its windows instead: the smallest id for each window.
   Anchors that would fill a task (found in a sample of documents, at most ``HOT_SHARE`` for each partition) are dealt
   by anchor and run, and taken by windows as well; which ones they are changes the work, never the result.
4. Repeats are gathered for each document and cut out of its text.  Texts are moved only for documents that may
   have repeats: a bitmap of ``BITMAP_BITS`` hashed document keys, a fixed 2 MB, is collected and tested before the join;
   where it saturates, more texts move and the result stays the same.

Runs are equal in step 1 and 2 if their anchors' and their own 64-bit hashes are equal, so only runs around the same 5 words could be
mistaken for each other; in step 3 words are compared by their text, windows by SHA-256.

Defined results: null and empty texts and texts below 13 words lose nothing (a null text stays null); very long texts are taken whole; rows with a null
id lose nothing and count as no reference; repeated rows with one id are no reference for each other; ids that are no whole numbers are
replaced by their rank; an empty table gives no rows; other columns pass through, whatever their names.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewarden.llm.common import cut, release_memory, space_words

WINDOW = 13
GRAM = 5
SIDE = (WINDOW - GRAM) // 2
MOST_RUNS = 256
BATCH_BYTES = 600_000
BITMAP_BITS = 1 << 24
SAMPLE_DOCS = 20_000
HOT_SHARE = 8

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True
_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _BASE)  # a fixed random number for each byte
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 16) + (n >> 1)
        _powers["up"] = np.cumprod(np.concatenate(([_U(1)], np.full(size, _BASE))))
        _powers["down"] = np.cumprod(np.concatenate(([_U(1)], np.full(size, _INVERSE))))
    return _powers["up"], _powers["down"]


def _range_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each range of the values, the same wherever the range stands."""
    up, down = _power(len(values) + 1)
    sums = np.concatenate(([_U(0)], np.cumsum(values * up[: len(values)])))
    return _mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


class Words(NamedTuple):
    """The words of several texts, one after the other."""

    text: np.ndarray  # number of each word's text
    start: np.ndarray  # its first and last byte + 1 in the joined texts
    end: np.ndarray
    first: np.ndarray  # number of the first word of each text
    joined: bytes


def words_of(texts: list[bytes]) -> Words:
    joined = b"\n".join(texts)
    space = np.concatenate(([True], _SPACE[np.frombuffer(joined, np.uint8)], [True]))
    edge = np.flatnonzero(space[1:] != space[:-1])
    start, end = edge[0::2], edge[1::2]
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    first = np.searchsorted(start, begins[:-1])
    text = np.repeat(np.arange(len(texts)), np.diff(np.append(first, len(start))))
    return Words(text, start, end, first, joined)


class Runs(NamedTuple):
    """Of each run: text, number of the first word of its first and last window and of its anchor, hashes of anchor and words."""

    text: np.ndarray
    first: np.ndarray
    last: np.ndarray
    at: np.ndarray
    fp: np.ndarray
    run: np.ndarray
    code: np.ndarray  # a hash of each word of the texts


def runs_of(w: Words) -> Runs:
    total = len(w.start)
    size, width = total - WINDOW + 1, WINDOW - GRAM + 1
    start = np.flatnonzero(w.text[WINDOW - 1 :] == w.text[:size]) if size > 0 else []
    if not len(start):
        return Runs(*[np.empty(0, np.int64)] * 6, np.empty(0, np.uint64))
    code = _range_hash(_BYTE[np.frombuffer(w.joined, np.uint8)], w.start, w.end)
    gram = np.zeros(total - GRAM + 1, np.uint64)
    for j in range(GRAM):
        gram = gram * _BASE + code[j : total - GRAM + 1 + j]
    gram = _mix(gram)
    low, at = gram[:size].copy(), np.zeros(size, np.int8)
    for j in range(1, width):
        less = gram[j : size + j] < low
        np.copyto(low, gram[j : size + j], where=less)
        at[less] = j
    text, anchor = w.text[start], start + at[start]
    head = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))))
    a, b = start[head], start[np.append(head[1:], len(start)) - 1]
    run = _range_hash(code, a, b + WINDOW)
    return Runs(text[head], a, b, anchor[head], gram[anchor[head]].view(np.int64), run.view(np.int64), code)


def sides_of(r: Runs) -> np.ndarray:
    """32 bits of each run: 16 for the SIDE words before its anchor, 16 for those after it; 0 where the run has fewer there."""
    before, after = r.at - SIDE, r.at + GRAM
    has_left, has_right = before >= r.first, after + SIDE <= r.last + WINDOW
    start = np.concatenate((before[has_left], after[has_right]))
    sides = _range_hash(r.code, start, start + SIDE) % _U(0xFFFF) + _U(1)
    out = np.zeros((2, len(r.at)), np.uint64)
    out[0, has_left], out[1, has_right] = sides[: has_left.sum()], sides[has_left.sum() :]
    return (out[0] << _U(16) | out[1]).astype(np.int64)


def _batches(frames, most: int = BATCH_BYTES):
    """Pieces of the frames with about most bytes of text each."""
    for f in frames:
        sizes = f["text"].map(len).to_numpy().cumsum() // most
        for k in np.unique(sizes):
            yield f[sizes == k]
        release_memory()


def _run_rows(frames):
    """Rows of runs; tag is the key of the document's text and below it the sides of the run, 32 bits each."""
    for f in _batches(frames):
        r = runs_of(words_of(list(f["text"])))
        doc, tag = f["doc"].to_numpy()[r.text], f["key"].to_numpy()[r.text] << 32 | sides_of(r)
        order = np.lexsort((doc, r.run))
        fp, run, doc, tag = r.fp[order], r.run[order], doc[order], tag[order]
        same = np.concatenate(([False], (fp[1:] == fp[:-1]) & (run[1:] == run[:-1])))[: len(fp)]
        low = doc[np.maximum.accumulate(np.where(same, 0, np.arange(len(doc))))]
        again = same & np.concatenate(([False], (doc[1:] == doc[:-1]) & (tag[1:] == tag[:-1])))[: len(fp)]
        yield pd.DataFrame({"fp": fp, "run": run, "doc": doc, "tag": tag, "sure": doc > low})[~again]


def _shared(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether another element of the group has the same value, other than 0."""
    order = np.lexsort((value, group))
    g, v = group[order], value[order]
    same = (g[1:] == g[:-1]) & (v[1:] == v[:-1]) & (v[1:] != 0)
    out = np.zeros(len(order), bool)
    out[order] = np.concatenate(([False], same)) | np.concatenate((same, [False]))
    return out


def _verdicts(frames, often=()):
    """Streams rows sorted by (sure, fp, run, doc, tag): kind 0 repeat, 1 contested, 2 contested by many runs."""
    cols = ["fp", "run", "doc", "tag"]
    often = np.array(sorted(often), np.int64)
    held = pd.DataFrame(columns=cols).astype("int64")
    hot: tuple[int, int, int] | None = None  # anchor under way, its last run and that run's smallest id

    def judge(f: pd.DataFrame, last: bool):
        nonlocal hot
        fp, run, doc, tag = (f[c].to_numpy() for c in cols)
        if not len(fp):
            return answer(f, np.empty(0, np.int32))
        new_fp = np.concatenate(([True], fp[1:] != fp[:-1]))
        new_run = new_fp | np.concatenate(([True], run[1:] != run[:-1]))
        low = doc[np.maximum.accumulate(np.where(new_run, np.arange(len(doc)), 0))]
        group, number = np.cumsum(new_fp) - 1, np.cumsum(new_run) - 1
        side, of = tag[new_run] & 0xFFFFFFFF, group[new_run]
        contested = _shared(of, side >> 16) | _shared(of, side & 0xFFFF)
        apart = np.isin(fp[new_fp], often)  # anchors whose runs are not all here
        if hot and fp[0] == hot[0]:
            apart[0] = True
            if run[0] == hot[1]:
                low[: (np.flatnonzero(new_run)[1:].tolist() or [len(low)])[0]] = hot[2]
        if not last:
            apart[-1] = True
            hot = (fp[-1], run[-1], low[-1])
        many = np.bincount(of, contested) > MOST_RUNS
        of_run = np.where(apart[of] | contested & many[of], 2, np.where(contested, 1, 3))
        kind = np.where(doc > low, 0, of_run[number])
        again = ~new_run & np.concatenate(([False], (doc[1:] == doc[:-1]) & (tag[1:] == tag[:-1])))
        return answer(f, kind)[(kind < 3) & ~again]

    def answer(f: pd.DataFrame, kind) -> pd.DataFrame:
        return pd.DataFrame({"run": f["run"], "doc": f["doc"], "key": f["tag"].to_numpy() >> 32, "kind": np.asarray(kind, np.int32)})

    for f in frames:
        sure = f[f["sure"]]
        yield answer(sure, np.zeros(len(sure)))
        held = pd.concat([held, f.loc[~f["sure"], cols]])
        if len(held):
            fp = held["fp"].to_numpy()
            done = int(np.argmax(fp == fp[-1]))
            if done:
                yield judge(held.iloc[:done], True)
                held = held.iloc[done:]
            if len(held) > 50_000:  # one anchor; it has many rows, so it is taken by windows from here on
                yield judge(held, False)
                held = held.iloc[:0]
    yield judge(held, True)


class SuffixAutomaton:
    """Suffix automaton of several word sequences."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, words: list) -> None:
        last = 0
        for w in words:
            last = self._extend(last, w)

    def _state(self, length: int, link: int, trans: dict) -> int:
        self.next.append(trans)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, q: int, w) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, p: int, w) -> int:
        q = self.next[p].get(w)
        if q is not None:
            return q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        cur = self._state(self.length[p] + 1, 0, {})
        while p != -1 and w not in self.next[p]:
            self.next[p][w] = cur
            p = self.link[p]
        if p != -1:
            q = self.next[p][w]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return cur

    def matches(self, words: list) -> list[int]:
        """Matching statistics: at each word, the length of the longest known sequence that ends there."""
        out, state, n = [], 0, 0
        for w in words:
            while state and w not in self.next[state]:
                state = self.link[state]
                n = self.length[state]
            if w in self.next[state]:
                state, n = self.next[state][w], n + 1
            out.append(n)
        return out


def _match_shards(frames):
    """(fp, doc, key, run, passage) sorted by (fp, doc) -> (doc, key, run, mask of repeated windows)."""
    out, held = [], None
    fp_now, doc_now, auto, waiting = None, None, SuffixAutomaton(), []
    for f in frames:
        for fp, doc, key, run, passage in zip(f["fp"], f["doc"], f["key"], f["run"], f["passage"], strict=True):
            if (fp, doc, key, run) == held:
                continue  # a repeated row
            held = (fp, doc, key, run)
            if fp != fp_now:
                fp_now, doc_now, auto, waiting = fp, doc, SuffixAutomaton(), []
            elif doc != doc_now:
                for words in waiting:
                    auto.add(words)
                doc_now, waiting = doc, []
            words = passage.split(b" ")
            mask = 0
            for i, n in enumerate(auto.matches(words)):
                if n >= WINDOW:
                    mask |= 1 << (i - WINDOW + 1)
            if mask:
                out.append((doc, key, run, mask))
            if mask != (1 << (len(words) - WINDOW + 1)) - 1:
                waiting.append(words)
        yield pd.DataFrame(out, columns=["doc", "key", "run", "mask"]).astype("int64")
        out = []


def _passages(frames):
    """Contested runs of each text with their words; runs of frequent anchors (kind 2) with each of their windows."""
    for f in _batches(frames):
        w = words_of(list(f["text"]))
        d, a, b, _, fp, run, _ = runs_of(w)
        few = [set(x) for x in f["few"]]
        many = [set(x) for x in f["many"]]
        asked = np.flatnonzero(np.isin(run, [r for s in (*few, *many) for r in s]))
        docs, keys, rows = f["doc"].to_numpy(), f["key"].to_numpy(), []
        part = lambda i, j: b" ".join(w.joined[w.start[i] : w.end[j - 1]].split())
        for k, i, r, p, x, y in zip(asked.tolist(), d[asked].tolist(), run[asked].tolist(), fp[asked].tolist(), a[asked].tolist(), b[asked].tolist(), strict=True):
            if r in few[i]:
                rows.append((p, docs[i], keys[i], r, part(x, y + WINDOW), None))
            elif r in many[i]:
                rows.append((p, docs[i], keys[i], r, None, [part(j, j + WINDOW) for j in range(x, y + 1)]))
        yield pd.DataFrame(rows, columns=["fp", "doc", "key", "run", "passage", "windows"])


def _without(texts: list[bytes], removed: np.ndarray, w: Words) -> list[str]:
    """The texts without the words that are marked as removed."""
    out = []
    ends = np.append(w.first[1:], len(w.start))
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    for i, text in enumerate(texts):
        gone = removed[w.first[i] : ends[i]]
        if not gone.any():
            out.append(text.decode())
            continue
        kept = np.flatnonzero(~gone) + w.first[i]
        turn = np.flatnonzero(np.diff(kept) > 1) + 1
        lo = w.start[kept[np.concatenate(([0], turn))]].tolist() if len(kept) else []
        hi = w.end[kept[np.concatenate((turn - 1, [len(kept) - 1]))]].tolist() if len(kept) else []
        pieces = []
        for k, (x, y) in enumerate(zip(lo, hi, strict=True)):
            if k:
                pieces.append(b"\n" if b"\n" in w.joined[hi[k - 1] : x] else b" ")
            pieces.append(w.joined[x:y])
        assert not lo or lo[0] >= begins[i]
        out.append(b"".join(pieces).decode())
    return out


def _cut_out(texts: list[bytes], full: list, partial: list) -> list[str]:
    w = words_of(texts)
    d, a, b, _, _, run, _ = runs_of(w)
    whole = [set(x) if x is not None else set() for x in full]
    masks: list[dict[int, int]] = []
    for parts in partial:
        own: dict[int, int] = {}
        for p in parts if parts is not None else ():
            own[p["run"]] = own.get(p["run"], 0) | p["mask"]
        masks.append(own)
    asked = np.flatnonzero(np.isin(run, [r for s in (*whole, *masks) for r in s]))
    change = np.zeros(len(w.start) + 1, np.int64)
    for i, r, x, y in zip(d[asked].tolist(), run[asked].tolist(), a[asked].tolist(), b[asked].tolist(), strict=True):
        if r in whole[i]:
            change[x] += 1
            change[y + WINDOW] -= 1
        elif mask := masks[i].get(r, 0):
            for j in range(x, y + 1):
                if mask >> (j - x) & 1:
                    change[j] += 1
                    change[j + WINDOW] -= 1
    return _without(texts, np.cumsum(change)[:-1] > 0, w)


def _bitmap(keys: DataFrame, bits: int = BITMAP_BITS) -> DataFrame:
    """Which hashed document keys occur: at most bits / 32768 rows of 4 kB."""
    place = F.pmod(F.xxhash64("doc", "key"), F.lit(bits))
    return keys.groupBy(F.floor(place / 32768).alias("__bucket")).agg(F.bitmap_construct_agg(place % 32768).alias("__bits"))


def _with_hit(docs: DataFrame, bitmap: DataFrame, bits: int = BITMAP_BITS) -> DataFrame:
    """Adds __hit: false only for documents that are surely not among the keys."""
    place = F.pmod(F.xxhash64("doc", "key"), F.lit(bits))
    docs = docs.withColumn("__bucket", F.floor(place / 32768)).join(F.broadcast(bitmap), "__bucket", "left")
    at = (place % 32768).cast("int")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0, F.lit(False))
    return docs.withColumn("__hit", hit).drop("__bucket", "__bits")


def hot_anchors(some: DataFrame, n_docs: int, partitions: int, sample_docs: int = SAMPLE_DOCS) -> list[int]:
    """Anchors with over 1 / (HOT_SHARE * partitions) of all runs of a sample, so at most HOT_SHARE * partitions of them."""
    sample = some.where(F.pmod(F.xxhash64("doc", "key", F.lit("sample")), F.lit(max(1, n_docs // sample_docs))) == 0)
    counts = sample.mapInPandas(_run_rows, RUN_ROWS).groupBy("fp").agg(F.count("*").alias("n"))
    counts = cut(counts.where("n > 1"))
    total = sample.agg(F.sum(F.octet_length("text"))).first()[0] or 0  # about 35 bytes of text a run
    least = max(16.0, total / 35 / (HOT_SHARE * partitions))
    return [r.fp for r in counts.where(F.col("n") > least).orderBy(F.desc("n"), "fp").limit(HOT_SHARE * partitions).collect()]


def _ranked(documents: DataFrame, doc_id: str) -> DataFrame:
    """Adds __doc: the id, or its rank among all ids where it is no whole number."""
    if documents.schema[doc_id].dataType.typeName() in ("byte", "short", "integer", "long"):
        return documents.withColumn("__doc", F.col(doc_id).cast("bigint"))
    ids = documents.select(F.col(doc_id).alias("__id")).where("__id is not null").distinct().orderBy("__id")
    ids = cut(ids.select("__id", F.monotonically_increasing_id().alias("__doc")))  # ascending over sorted partitions
    return documents.join(ids, F.col(doc_id) == F.col("__id"), "left").drop("__id")


RUN_ROWS = "fp bigint, run bigint, doc bigint, tag bigint, sure boolean"


def dedup_substrings(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with repeats cut out of their text; the other columns are kept."""
    cols = documents.columns
    key = F.hash(text).cast("bigint")  # tells rows with one id apart; verdicts depend on ids and words, so equal keys only share a row of them
    docs = _ranked(documents, doc_id).select(F.struct(*[F.col(f"`{c}`") for c in cols if c != text]).alias("row"), F.col(text).alias("text"), F.col("__doc").alias("doc"), key.alias("key"))
    read = docs.select("doc", "key", F.col("text").cast("binary").alias("text"))
    some = read.where("doc is not null and octet_length(text) >= 25")  # 13 words and 12 spaces at least
    often = hot_anchors(some, documents.count(), int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    rows = some.mapInPandas(_run_rows, RUN_ROWS)
    place = F.when(F.col("sure"), F.xxhash64("doc", "run")).when(F.col("fp").isin(often), F.xxhash64("fp", "run")).otherwise(F.col("fp"))
    dealt = rows.repartition(place).sortWithinPartitions("sure", "fp", "run", "doc", "tag")
    judged = dealt.mapInPandas(lambda frames: _verdicts(frames, often), "run bigint, doc bigint, key bigint, kind int")
    of_kind = lambda k: F.collect_set(F.when(F.col("kind") == k, F.col("run")))
    found = cut(judged.groupBy("doc", "key").agg(of_kind(0).alias("full"), of_kind(1).alias("few"), of_kind(2).alias("many")))

    asked = found.where("size(few) > 0 or size(many) > 0").select("doc", "key", "few", "many")
    texts = _with_hit(some, _bitmap(asked)).where("__hit").drop("__hit").join(asked, ["doc", "key"])
    runs = cut(texts.mapInPandas(_passages, "fp bigint, doc bigint, key bigint, run bigint, passage binary, windows array<binary>"))
    shards = runs.where("passage is not null").select("fp", "doc", "key", "run", "passage").repartition("fp").sortWithinPartitions("fp", "doc", "key", "run")
    matched = shards.mapInPandas(_match_shards, "doc bigint, key bigint, run bigint, mask bigint")
    one = runs.where("windows is not null").select("doc", "key", "run", F.posexplode("windows").alias("i", "w")).withColumn("w", F.sha2("w", 256))
    low = cut(one.groupBy("w").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("w", "low"))  # plain tables, so Spark may split a frequent window
    by_window = one.join(low, "w").where("doc > low").select("doc", "key", "run", F.expr("shiftleft(1L, i)").alias("mask"))
    masks = matched.union(by_window).groupBy("doc", "key").agg(F.collect_list(F.struct("run", "mask")).alias("partial"))
    changes = cut(found.select("doc", "key", "full").join(masks, ["doc", "key"], "left").where("size(full) > 0 or partial is not null"))

    marked = _with_hit(docs, _bitmap(changes))
    free = marked.where("not __hit").select("row.*", "text")
    hit = marked.where("__hit").drop("__hit").join(changes, ["doc", "key"], "left")
    changed = hit.select("row", "text", F.when(F.col("full").isNotNull(), _cutter()("text", "full", "partial")).otherwise(F.col("text")).alias("__kept"))
    changed = changed.select("row.*", F.when(F.col("text").isNull(), F.lit(None)).otherwise(F.col("__kept")).alias("text"))
    return free.union(changed).withColumnRenamed("text", text).select(*[F.col(f"`{c}`") for c in cols])


def _cutter():
    @F.pandas_udf("string")
    def cut_out(texts: pd.Series, full: pd.Series, partial: pd.Series) -> pd.Series:
        out: list = list(texts)
        some = [i for i, (t, f) in enumerate(zip(texts, full, strict=True)) if t is not None and f is not None]
        size = np.cumsum([len(out[i]) for i in some]) // BATCH_BYTES if some else np.empty(0, np.int64)
        for k in np.unique(size):
            part = [i for i, n in zip(some, size, strict=True) if n == k]
            new = _cut_out([out[i].encode() for i in part], [full.iloc[i] for i in part], [partial.iloc[i] for i in part])
            for i, t in zip(part, new, strict=True):
                out[i] = t
        release_memory()
        return pd.Series(out, dtype=object)

    return cut_out.asNondeterministic()  # else a filter on the text would compute it twice


def op8(documents: DataFrame) -> DataFrame:
    docs = documents.select("doc_id", "text", F.size(space_words(F.col("text"))).cast("bigint").alias("n_words"))
    out = dedup_substrings(docs).withColumn("__kept", space_words(F.col("text")))
    return out.select(
        "doc_id",
        "n_words",
        (F.col("n_words") - F.size("__kept")).cast("bigint").alias("n_removed"),
        F.sha2(F.array_join("__kept", " "), 256).alias("kept_sha256"),
    )


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
x AS (SELECT r, doc_id, i, hash(w[i : i + 12]) AS h, md5(array_to_string(w[i : i + 12], ' ')) AS m
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
f AS (SELECT r, i, doc_id > min(doc_id) OVER (PARTITION BY h, m) AS again FROM x),
g AS (SELECT r, list(DISTINCT p) AS gone FROM (SELECT r, unnest(range(i, i + 13)) AS p FROM f WHERE again) GROUP BY r),
k AS (SELECT doc_id, w, coalesce(gone, []) AS gone FROM d LEFT JOIN g USING (r))
SELECT doc_id, len(w)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed,
  sha256(array_to_string(list_filter(w, lambda e, i: NOT list_contains(gone, i)), ' ')) AS kept_sha256 FROM k
"""
