"""SimHash near-duplicates with BK-trees.

Fingerprints are 64-bit SimHashes of word shingles.  Two fingerprints that differ in at most ``RADIUS`` = 3
bits agree in at least two of five bit blocks, so each distinct fingerprint goes to ten shards, one for
each pair of blocks; a shard key holds at least 25 bits, so shards stay small as the corpus grows.  A shard of over ``SHARD_NODES`` nodes is
split: of four groups of its other bits one must agree too, so its nodes go to four shards with longer keys, and so on.  The BK-tree of every
shard (children keyed by the integer Hamming distance to their parent) is built where the shard lies, instead of
being broadcast: all trees together grow with the corpus, so no bound would hold for them.  A query follows only
edges within the radius.  Trees are built and searched level by level with numpy for all shards of a batch.

Each shard yields at most one link for each fingerprint (to the smallest of its local component), and the
links meet in connected components over DataFrames (alternating large and small stars, a checkpoint each round).
Exact copies share a fingerprint and are one node, pre-aggregated before the shuffle.

Defined results: a null or empty text has fingerprint 0 and is linked like any other; fewer words than a
shingle are one shingle; very long texts are read whole; of bits set in exactly half the shingles none is set; repeated rows stay and share a component; a component's id is its smallest
non-null id, null where all ids are null; an empty table gives no rows.  Ids of any type that can be ordered will do, and only id and text are read, so no other column can clash.

``near_copies`` is the whole similarity join by the same method: it links documents whose sets of five-word shingles have a
Jaccard similarity of at least 0.8.  Such sets have SimHashes that differ in 15 % of the bits, at most 19 % (sets of four and five
shingles).  Its fingerprints have ``PRINT`` = 4 words of 64 bits, of which more than ``COPY_RADIUS`` = 96 differ for one such
pair in 10 ** 12, while two random ones differ in fewer for 4 pairs in 10 ** 5.  The BK-trees of the shards find all pairs within that radius, and their
exact sets decide on each pair that is not yet linked.  No block of bits agrees at that distance, so instead of bit blocks
``BANDS`` min-hash bands are the shard keys (a pair at 0.8 shares none with a chance below 0.00003, a more similar one still more seldom).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewarden.llm.common import cut, release_memory

SHINGLE = 3
RADIUS = 3
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))  # (first bit, bits)
SHARD_NODES = 50_000
SEED = 42
COPY_SHINGLE = 5
SIMILAR = (4, 5)  # Jaccard similarity of near copies, as a fraction
BANDS, ROWS = 20, 4
PRINT, COPY_RADIUS = 4, 96  # 64-bit words of a near copy's fingerprint, and the bits by which near copies may differ
BLOCK_SHINGLES = 1 << 21  # of a block of a shard; blocks of larger shards meet in pairs
FOREST_SHINGLES = 1 << 19  # of small shards whose trees are searched together


def simhash(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of a UTF-8 text."""
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    k = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - k + 1].tolist()
    ends = (ends[k - 1 :] - 1).tolist()
    n = len(starts)
    hashes = np.fromiter((xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, ends, strict=True)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for a in range(0, n, 1 << 14):
        ones += np.unpackbits(hashes[a : a + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprint(shingle: int = SHINGLE):
    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        found = pd.Series([simhash(t, shingle) for t in texts], dtype="int64")
        release_memory()
        return found

    return of


class BKForest:
    """The BK-trees of several shards: node i holds points[i] (64 bits, or a row of words of 64 bits); its parent's distance to it is edge[i]."""

    def __init__(self, shard: np.ndarray, points: np.ndarray):
        n = len(points)
        self.far = 64 if points.ndim == 1 else 64 * points.shape[1]
        self.points = points
        self.shard = shard
        self.root = np.zeros(n, np.int64)  # of each point's shard
        parent, edge = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        left, group = np.arange(n), shard.astype(np.int64)
        above, above_edge = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        while len(left):
            order = np.argsort(group, kind="stable")
            left, group, above, above_edge = left[order], group[order], above[order], above_edge[order]
            head = np.concatenate(([True], group[1:] != group[:-1]))
            pivot = left[head][np.cumsum(head) - 1]
            parent[left[head]], edge[left[head]] = above[head], above_edge[head]
            if above[0] == -1 and not self.root.any():
                self.root[left] = pivot
            rest = ~head
            left, pivot = left[rest], pivot[rest]
            d = self._distance(left, pivot)
            above, above_edge, group = pivot, d, pivot * (self.far + 1) + d
        kids = np.flatnonzero(parent >= 0)
        key = parent[kids] * (self.far + 1) + edge[kids]
        order = np.argsort(key)
        self.kid, self.kid_key = kids[order], key[order]

    def _distance(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        d = np.bitwise_count(self.points[a] ^ self.points[b])
        return d.astype(np.int64) if d.ndim == 1 else d.sum(1, dtype=np.int64)

    def links(self, radius: int, label: np.ndarray | None = None, most: int = 1 << 20, block: int = 4096):
        """Blocks of (query, node) pairs of equal shards within the radius; all points are queries.

        With label, the classes found so far (which the caller unites after each block), points of the largest class of a shard of over block
        points are not asked any more: a link to another class is found from there."""
        first = np.flatnonzero(np.concatenate(([True], self.shard[1:] != self.shard[:-1]))) if len(self.shard) else np.empty(0, np.int64)
        last = np.append(first[1:], len(self.points))
        for a in range(0, len(self.points), block):
            query = np.arange(a, min(a + block, len(self.points)))
            if label is not None:
                size = np.bincount(label, minlength=len(label)) if (last - first).max() > block else None
                for lo, hi in zip(first, last, strict=True) if size is not None else ():
                    if hi - lo > block and lo <= query[-1] and hi > query[0]:
                        query = query[label[query] != lo + size[lo:hi].argmax()]
                        if not len(query):
                            break
            yield from self.search(query, radius, most)

    def search(self, query: np.ndarray, radius: int, most: int = 1 << 20):
        """Blocks of (query, node) pairs of equal shards within the radius, for the points asked."""
        work = [(query, self.root[query])]
        while work:
            query, node = work.pop()
            if len(query) > most and len(query) > 1:
                half = len(query) // 2
                work += [(query[:half], node[:half]), (query[half:], node[half:])]
                continue
            d = self._distance(query, node)
            near = (d <= radius) & (query != node)
            if near.any():
                yield query[near], node[near]
            lo = np.searchsorted(self.kid_key, node * (self.far + 1) + np.maximum(d - radius, 0))
            hi = np.searchsorted(self.kid_key, node * (self.far + 1) + np.minimum(d + radius, self.far), side="right")
            width = hi - lo
            if width.any():
                at = np.repeat(lo - np.concatenate(([0], np.cumsum(width)[:-1])), width) + np.arange(width.sum())
                work.append((np.repeat(query, width), self.kid[at]))


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unites the classes of linked points; label points at smaller members of the class."""
    while True:
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))


def shard_links(batches, radius: int = RADIUS):
    """(key, fp) sorted by key -> (u, v) with v the smallest fingerprint of u's component in the shard."""

    def found(keys: np.ndarray, fps: np.ndarray) -> pd.DataFrame:
        shard = np.concatenate(([0], np.cumsum(keys[1:] != keys[:-1])))
        size = np.bincount(shard)[shard] > 1
        shard, fps = shard[size], fps[size]
        order = np.lexsort((fps, shard))
        shard, fps = shard[order], fps[order]
        label = np.arange(len(fps))
        for q, v in BKForest(shard, fps.view(np.uint64)).links(radius, label):
            _merge(label, q, v)
        own = label != np.arange(len(fps))
        return pd.DataFrame({"u": fps[own], "v": fps[label[own]]})

    held: list[tuple[np.ndarray, np.ndarray]] = []  # the last shard may go on in the next batch
    for b in batches:
        keys, fps = b["key"].to_numpy(), b["fp"].to_numpy()
        if not len(keys):
            continue
        done = int(np.searchsorted(keys, keys[-1])) if not held or keys[-1] != held[0][0][0] else 0
        if done or held and keys[-1] != held[0][0][0]:
            yield found(*map(np.concatenate, zip(*held, (keys[:done], fps[:done]), strict=True)))
            held = []
        held.append((keys[done:], fps[done:]))
    if held:
        yield found(*map(np.concatenate, zip(*held, strict=True)))


def _groups(mask: int, n: int = 4) -> list[int]:
    """The mask with each of n groups of the bits outside it."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | sum(1 << b for b in free[g::n]) for g in range(n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shards(nodes: DataFrame, most: int = SHARD_NODES) -> DataFrame:
    """(key, fp): any two fingerprints that differ in at most three bits share a key."""
    block = [((1 << size) - 1) << first for first, size in BLOCKS]
    masks = [x | y for x, y in combinations(block, 2)]
    rows, out = nodes.select("fp", F.explode(F.sequence(F.lit(0), F.lit(len(masks) - 1))).alias("m")), None
    for level in range(4):  # after three splits a key holds over 47 bits, and a shard at most 2 ** 17 fingerprints
        bits = F.element_at(F.lit([_signed(m) for m in masks]).cast("array<bigint>"), F.col("m") + 1)
        rows = rows.select("fp", "m", F.xxhash64(F.lit(level), "m", F.col("fp").bitwiseAND(bits)).alias("key"))
        hot = cut(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > most).select("key", F.lit(True).alias("hot"))) if level < 3 else None
        if hot is None or hot.isEmpty():
            return out.union(rows.select("key", "fp")) if out else rows.select("key", "fp")
        rows = rows.join(hot, "key", "left")  # both sides are plain tables, so Spark may broadcast the few keys or split a hot one
        small = rows.where("hot is null").select("key", "fp")
        out = out.union(small) if out else small
        masks = [g for m in masks for g in _groups(m)]
        rows = rows.where("hot").select("fp", F.explode(F.sequence(4 * F.col("m"), 4 * F.col("m") + 3)).alias("m"))
    return out


def components(links: DataFrame) -> DataFrame:
    """(u, root) for every linked u: root is the smallest value of its connected component.

    Each round brings nodes nearer to their root, at least by a constant factor, until nothing changes (so a number of rounds in the order of
    the logarithm squared).  Joins read written tables, so that Spark can split the rows of a hub."""
    links = cut(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = cut(large)
        low = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        links = cut(small.where("u <> v").distinct())
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return links.select("u", F.col("v").alias("root"))
        before = now


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """(doc_id, text_hash, fp, component_id, root) for each document row; root names the component."""
    if radius > RADIUS:
        raise ValueError(f"shards meet for {RADIUS} bits at most")
    prints = documents.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), fingerprint(shingle)(F.col(text).cast("binary")).alias("fp"))
    prints = cut(prints)  # three numbers for each document; the texts are read once
    nodes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    dealt = shards(nodes, shard_nodes).repartition("key").sortWithinPartitions("key")
    links = dealt.mapInPandas(lambda it: shard_links(it, radius), "u bigint, v bigint")
    linked = components(links)
    ids = linked.union(linked.select("root", "root").distinct()).toDF("fp", "root")
    named = ids.join(nodes, "fp")
    first = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(first, "root").select("fp", "root", "component_id")
    table = nodes.join(named, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("component_id")).alias("component_id"))
    # both sides come from written tables: a plain sort-merge join, whose hot fingerprints Spark splits
    return prints.join(cut(table), "fp", "left").select("doc_id", "text_hash", "fp", "component_id", "root")


def _first_of_each(documents: DataFrame, found: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row of each root in found (doc_id, text_hash, root) stays: that of the smallest (id, hash of the text)."""
    one = found.groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    best = one.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "n")).alias("k"))
    keep = cut(best.select(F.col("k.doc_id").alias("__nd_id"), F.col("k.text_hash").alias("__nd_hash"), (F.col("k.n") > 1).alias("__nd_again")))
    docs = documents.withColumns({"__nd_i": F.col(doc_id), "__nd_h": F.xxhash64(text)})
    met = docs.join(keep, F.col("__nd_i").eqNullSafe(F.col("__nd_id")) & (F.col("__nd_h") == F.col("__nd_hash")))
    once, again = met.where(~F.col("__nd_again")), met.where("__nd_again").dropDuplicates(["__nd_i", "__nd_h"])
    return once.union(again).select(*[F.col(f"`{c}`") for c in documents.columns])


def drop_near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each component stays: that of the smallest (id, hash of the text); all columns are kept."""
    return _first_of_each(documents, near_duplicates(documents, doc_id, text, shingle, radius), doc_id, text)


def shingle_set(text: bytes | None, shingle: int = COPY_SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a UTF-8 text."""
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    k = min(shingle, len(words))
    each = np.fromiter((xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))
    out = np.full(len(words) - k + 1, k, np.uint64)
    for j in range(k):
        out = _mixed(out ^ each[j : j + len(out)])
    return np.unique(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the end of SplitMix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, (2, BANDS * ROWS, 1)).astype(np.uint64)


def bands(hashes: np.ndarray) -> np.ndarray:
    """Min-hash band keys of a shingle set."""
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(hashes), 1024):
        low = np.minimum(low, (hashes[None, a : a + 1024] * (_FACTORS[0] | np.uint64(1)) + _FACTORS[1]).min(1))
    key = np.arange(BANDS, dtype=np.uint64)
    for column in low.reshape(BANDS, ROWS).T:
        key = _mixed(key ^ column)
    return key.view(np.int64)


_WORDS = np.random.default_rng(SEED + 1).integers(0, 1 << 63, PRINT).astype(np.uint64)


def set_print(hashes: np.ndarray) -> np.ndarray:
    """SimHash of a shingle set, in PRINT words of 64 bits; of bits set in exactly half the shingles none is set."""
    ones = np.zeros(64 * PRINT, np.int64)
    for a in range(0, len(hashes), 1024):
        own = _mixed(hashes[a : a + 1024, None] ^ _WORDS)
        ones += np.unpackbits(own.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)


def _signature(shingle: int):
    @F.pandas_udf("struct<node:bigint,size:bigint,keys:array<bigint>>")
    def of(texts: pd.Series) -> pd.DataFrame:
        from xxhash import xxh64_intdigest

        node, size, keys = [], [], []
        for t in texts:
            own = shingle_set(t, shingle)
            node.append(xxh64_intdigest(own.tobytes(), SEED) if len(own) else 0)
            size.append(len(own))
            keys.append(bands(own) if len(own) else np.empty(0, np.int64))
        release_memory()
        return pd.DataFrame({"node": np.array(node, np.uint64).view(np.int64), "size": size, "keys": keys})

    return of.asNondeterministic()


def _sets(shingle: int):
    @F.pandas_udf("struct<hashes:binary,print:binary>")
    def of(texts: pd.Series) -> pd.DataFrame:
        found = []
        for t in texts:
            own = shingle_set(t, shingle)
            found.append((own.tobytes(), set_print(own).tobytes()))
        release_memory()
        return pd.DataFrame(found, columns=["hashes", "print"], dtype=object)

    return of.asNondeterministic()


def _in_common(own: np.ndarray, others: list[np.ndarray], mark: np.ndarray) -> np.ndarray:
    """How many numbers each of the other sets shares with a set; mark is 0 for every number."""
    ends = np.cumsum([len(s) for s in others])
    mark[own] = 1
    both = np.add.reduceat(mark[np.concatenate(others)], np.append(0, ends[:-1]))
    mark[own] = 0
    return both


def set_links(sets: list[np.ndarray], label: np.ndarray | None = None, ask: np.ndarray | None = None, shard: np.ndarray | None = None, prints: np.ndarray | None = None) -> np.ndarray:
    """label[i]: a member of i's component under links of Jaccard similarity at least SIMILAR within a shard (0, 1, ... in ascending order).

    The BK-trees of the fingerprints find the pairs, exact sets decide on those of different components.  label may give components that
    are known already, ask the sets whose links are wanted (all of them otherwise).  A set is asked unless all others of its shard were, or it
    lies in the largest component there and all sets outside that are asked; then their own links join all components.  First one set of each
    shard is asked, then twice as many each time, so that a large group is united before its members are asked."""
    n, (p, q) = len(sets), SIMILAR
    size = np.array([len(s) for s in sets])
    label = np.arange(n) if label is None else label.copy()
    ask = np.ones(n, bool) if ask is None else ask
    shard = np.zeros(n, np.int64) if shard is None else shard
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    numbers, mark = np.split(at, np.cumsum(size)[:-1]), np.zeros(len(values), np.int64)
    forest = BKForest(shard, np.array([set_print(s) for s in sets]) if prints is None else prints)
    first = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
    last = np.append(first[1:], n)
    asked, most = np.zeros(n, bool), 1
    while True:
        count = np.bincount(label, minlength=n)
        largest = np.minimum.reduceat(np.where(count == np.maximum.reduceat(count, first)[shard], np.arange(n), n), first)
        outside = label != largest[shard]
        left = ask & ~asked & (outside | np.logical_or.reduceat(outside & ~ask, first)[shard])
        left &= (np.add.reduceat((~asked).astype(np.int64), first) > 1)[shard]
        rank = np.cumsum(left)
        query = np.flatnonzero(left & (rank - (rank - left)[first][shard] <= most))
        if not len(query):
            return label
        turn = np.full(n, -1)  # a pair is decided once, by the set asked first
        turn[~asked] = n
        turn[query] = query
        asked[query] = True
        most *= 2
        for a, b in forest.search(query, COPY_RADIUS, 1 << 18):
            open_ = np.flatnonzero((label[a] != label[b]) & (turn[b] > turn[a]))
            open_ = open_[np.argsort(a[open_], kind="stable")]
            a, b = a[open_], b[open_]
            start = np.flatnonzero(np.diff(a, prepend=-1))
            for lo, hi in zip(start, np.append(start, len(a))[1:], strict=True):
                i = a[lo]
                near = b[lo:hi][label[b[lo:hi]] != label[i]]
                if not len(near):
                    continue
                both = _in_common(numbers[i], [numbers[j] for j in near], mark)
                near = near[(p + q) * both >= p * (size[near] + size[i])]  # both / (a + b - both) >= p / q
                if len(near):
                    joined = np.append(label[near], label[i])
                    own = label[first[shard[i]] : last[shard[i]]]
                    own[np.isin(own, joined)] = joined.min()


def _exact_links(batches):
    """(key, node, root, ask, hashes, print) sorted by key -> (u, v): links between members of components that meet in a shard."""

    def found(rows: list[tuple]) -> pd.DataFrame:
        key, node, root, ask, sets, prints = zip(*rows, strict=True)
        key, node = np.array(key, np.int64), np.array(node, np.int64)
        shard = np.cumsum(np.append(False, key[1:] != key[:-1]))
        _, first, of = np.unique(np.stack([shard, np.array(root, np.int64)], 1), axis=0, return_index=True, return_inverse=True)
        prints = np.frombuffer(b"".join(prints), np.uint64).reshape(-1, PRINT)
        label = set_links([np.frombuffer(s, np.uint64) for s in sets], first[of.ravel()], np.array(ask, bool), shard, prints)
        moved = first[label[first] != first]
        return pd.DataFrame({"u": node[moved], "v": node[label[moved]]})

    rows, held = [], 0
    for b in batches:
        for row in zip(b["key"], b["node"], b["root"], b["ask"], b["hashes"], b["print"], strict=True):
            if held >= 8 * FOREST_SHINGLES and row[0] != rows[-1][0]:
                yield found(rows)
                rows, held = [], 0
            rows.append(row)
            held += len(row[4])
    if rows:
        yield found(rows)
    release_memory()


def _compared(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of the shards in rows (key, node, root, ask)."""
    met = rows.join(sets, "node").repartition("key").sortWithinPartitions("key")
    return met.select("key", "node", "root", "ask", "hashes", "print").mapInPandas(_exact_links, "u bigint, v bigint")


def _within_blocks(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links within each block of each shard (key, node, blocks), and to the shard's pivot, which is in all its blocks."""
    pivot = members.where("blocks > 1").groupBy("key", "blocks").agg(F.min("node").alias("node"))
    pivot = pivot.select("key", "node", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"))
    rows = members.select("key", "node", _block_of("blocks").alias("b")).union(pivot)
    return _compared(rows.select(F.xxhash64("key", "b").alias("key"), "node", F.col("node").alias("root"), F.lit(True).alias("ask")), sets)


def _between_blocks(members: DataFrame, sets: DataFrame, found: DataFrame) -> DataFrame:
    """All other links of the shards with several blocks, given the components found (u, root).

    Only nodes outside the largest component of their shard are asked: in blocks of their own they meet all blocks of the shard."""
    big = members.where("blocks > 1").join(found.withColumnRenamed("u", "node"), "node", "left")
    big = cut(big.select("key", "node", "blocks", F.coalesce("root", "node").alias("root")))
    top = big.groupBy("key", "root").agg(F.count("*").alias("n")).groupBy("key").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("total"))
    top = top.where("top.n < total").select("key", F.col("top.root").alias("top"), (1 - F.col("top.n") / F.col("total")).alias("share"))
    big = cut(big.join(top, "key").withColumn("others", F.ceil(F.col("share") * F.col("blocks")).cast("int")))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = big.where("root <> top").select("key", "node", "root", F.lit(True).alias("ask"), _block_of("others").alias("o"), each("blocks").alias("b"))
    rows = asked.union(big.select("key", "node", "root", F.lit(False), each("others").alias("o"), _block_of("blocks").alias("b")))
    return _compared(rows.select(F.xxhash64("key", "o", "b").alias("key"), "node", "root", "ask"), sets)


def _block_of(blocks: str):
    return F.pmod(F.xxhash64("node", F.lit("block")), F.col(blocks)).cast("int")


def near_copies(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = COPY_SHINGLE, block: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc_id, text_hash, node, root) for each document row; root names the component of near copies.

    Texts of equal shingle sets are one node.  Links are found by the BK-trees of the nodes' fingerprints and confirmed by exact sets.
    Shards with the same members are worked once; a shard of over block shingles is dealt out in blocks, each with a tree of its own.  A block is worked by itself and with the shard's pivot, which unites most of a large group;
    only the nodes that are left outside the shard's largest component then meet the other blocks."""
    prints = documents.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), _signature(shingle)(F.col(text).cast("binary")).alias("s"))
    prints = cut(prints.select("doc_id", "text_hash", "s.node", "s.size", "s.keys"))
    nodes = cut(prints.groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("rep"), F.first("size").alias("size"), F.first("keys").alias("keys")))
    members = nodes.select(F.explode("keys").alias("key"), "node", "size")
    shards = members.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("total"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("a"), F.bit_xor("node").alias("b"))
    shards = shards.where("n > 1").groupBy("n", "total", "a", "b").agg(F.min("key").alias("key"))
    members = cut(members.join(shards.select("key", F.ceil(F.col("total") / block).cast("int").alias("blocks")), "key").select("key", "node", "blocks"))
    needed = members.select("node").distinct().join(nodes.select("node", "rep"), "node")
    needed = cut(needed.select("node", F.col("rep.doc_id").alias("__i"), F.col("rep.text_hash").alias("__h")))
    docs = documents.select(F.col(doc_id).alias("__d"), F.xxhash64(text).alias("__x"), F.col(text).cast("binary").alias("__t"))
    met = docs.join(needed, F.col("__d").eqNullSafe(F.col("__i")) & (F.col("__x") == F.col("__h"))).select("node", _sets(shingle)("__t").alias("s"))
    sets = cut(met.groupBy("node").agg(F.first("s").alias("s")).select("node", "s.hashes", "s.print"))  # a row may be repeated as a whole
    linked = cut(components(_within_blocks(members, sets)))
    if not members.where("blocks > 1").isEmpty():
        links = _between_blocks(members, sets, linked)
        linked = cut(components(linked.withColumnRenamed("root", "v").union(links)))
    ids = prints.select("doc_id", "text_hash", "node").join(linked.select(F.col("u").alias("node"), "root"), "node", "left")
    return ids.select("doc_id", "text_hash", "node", F.coalesce("root", "node").alias("root"))


def drop_near_copies(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = COPY_SHINGLE) -> DataFrame:
    """One row of each component of near copies stays: that of the smallest (id, hash of the text); all columns are kept."""
    return _first_of_each(documents, near_copies(documents, doc_id, text, shingle), doc_id, text)


def op9(documents: DataFrame) -> DataFrame:
    found = near_duplicates(documents)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
