"""Removal of lines that many documents share, by minimal perfect hashes over the distinct lines.

A line's key is hashed to 96 bits.  The distinct hashes with the number of their documents and their largest id are dealt to shards; each shard
gets a minimal perfect hash: in each level keys that are alone at their bit keep it, the others go on to the next level, and the
number of set bits before a key's bit is its slot.  Slots index plain arrays of fingerprints (32 of the 96 bits), counts and largest ids.
Documents send the hashes of their lines, not the lines, to the shards and probe the arrays there; a shard's arrays are one row, which comes before its probes,
so a task holds one shard's arrays and a batch of probes.  What is to be dropped goes back to the documents by their ids.

A shard holds about ``SHARD`` probes on average.  Keys of more than one ``HOT``-th of all probes would still fill it; there are fewer than
``HOT`` of them, whatever the corpus, and they make one more shard that every task gets (20 bytes a key, 1.4 MB at most) and probes in place.

Defined results: a null or empty text is one empty line; texts may have any length; rows are documents, so repeated rows count as often as they stand there and all rows of
the largest id keep their lines; a null id is smaller than any other; ids are whole numbers.  Lines of fewer than ``min_chars`` code points in their key
stay.  An empty table gives no rows.  Columns of the table stay, whatever their names; one named like the result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewarden.llm.common import SPACE_CHARS, cut, release_memory

MIN_CHARS, MIN_DOCS = 20, 3
#: Probes of a shard on average, and least number of shards.
SHARD, SHARDS = 1 << 18, 1024
#: Bound on the keys that every task gets.
HOT = 1 << 16
#: Bits for each key of a level of the hash.
GAMMA = 2
HELPER = "__nw"
NO_ID = -(1 << 63)
SPACE = SPACE_CHARS.encode()
#: Bytes of UTF-8 that continue a code point.
CONTINUED = bytes(range(0x80, 0xC0))
ARRAYS = "sizes array<bigint>, bits binary, prints binary, counts binary, last binary"


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """Spreads 64-bit numbers evenly."""
    x = x + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bit(h: np.ndarray, f: np.ndarray, level: int, size: int) -> np.ndarray:
    """Bit of a key in a level; two keys that agree in one level don't have to in the next."""
    with np.errstate(over="ignore"):
        return ((_mixed(h.view(np.uint64), 2 * level) ^ _mixed(f.view(np.uint32).astype(np.uint64), 2 * level + 1)) % np.uint64(size)).astype(np.int64)


@dataclass
class Lines:
    """A minimal perfect hash with its arrays.  Keys are pairs of h (64 bits) and f (32 bits)."""

    sizes: np.ndarray
    bits: np.ndarray
    prints: np.ndarray
    counts: np.ndarray
    last: np.ndarray

    def __post_init__(self) -> None:
        self.rank = np.concatenate(([0], np.cumsum(np.bitwise_count(self.bits), dtype=np.int64)))

    @classmethod
    def build(cls, h: np.ndarray, f: np.ndarray, n: np.ndarray, last: np.ndarray) -> Lines:
        """Keys must be distinct."""
        sizes, levels, left = [], [], np.arange(len(h))
        while len(left):
            size = -(-GAMMA * len(left) // 64) * 64
            at = _bit(h[left], f[left], len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            left = left[~alone[at]]
        out = cls(np.array(sizes, np.int64), np.concatenate(levels) if levels else np.empty(0, np.uint64), np.zeros(len(h), np.uint32), np.zeros(len(h), np.uint32), np.zeros(len(h), np.int64))
        slot = out._slots(h, f)
        out.prints[slot] = f.view(np.uint32)
        out.counts[slot] = np.minimum(n, (1 << 32) - 1)
        out.last[slot] = last
        return out

    def _slots(self, h: np.ndarray, f: np.ndarray) -> np.ndarray:
        slot, left, start = np.full(len(h), -1, np.int64), np.arange(len(h)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = _bit(h[left], f[left], level, size) + start
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            value = self.bits[word]
            set_ = (value >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(value & ((np.uint64(1) << bit) - np.uint64(1)))
            slot[left[set_]] = (self.rank[word] + below)[set_]
            left, start = left[~set_], start + size
        return slot

    def find(self, h: np.ndarray, f: np.ndarray) -> np.ndarray:
        """Slots of keys, -1 for one that is not in the index (32 bits may deceive)."""
        slot = self._slots(h, f)
        return np.where((slot >= 0) & (self.prints[slot] == f.view(np.uint32)), slot, -1) if len(self.prints) else slot

    def gone(self, h: np.ndarray, f: np.ndarray, doc_id: np.ndarray, min_docs: int) -> np.ndarray:
        """Whether a document loses a line: enough documents hold it, and another one of a larger id does."""
        slot = self.find(h, f)
        return (slot >= 0) & (self.counts[slot] >= min_docs) & (self.last[slot] != doc_id) if len(self.prints) else slot >= 0

    def row(self) -> list:
        return [self.sizes.tolist(), self.bits.tobytes(), self.prints.tobytes(), self.counts.tobytes(), self.last.tobytes()]

    @classmethod
    def of(cls, sizes: list[int], bits: bytes, prints: bytes, counts: bytes, last: bytes) -> Lines:
        return cls(np.array(sizes, np.int64), np.frombuffer(bits, np.uint64), np.frombuffer(prints, np.uint32), np.frombuffer(counts, np.uint32), np.frombuffer(last, np.int64))


def _keys(lines: list[bytes], min_chars: int) -> tuple[list[int], bytes]:
    """Numbers of the lines whose key is long enough, and their hashes (16 bytes each)."""
    at, found = [], []
    for i, line in enumerate(lines):
        if len(line) >= min_chars:
            key = line.strip(SPACE)
            if len(key) >= min_chars and (key.isascii() or len(key.translate(None, CONTINUED)) >= min_chars):
                at.append(i)
                found.append(xxhash.xxh3_128_digest(key.lower()))
    return at, b"".join(found)


def _parts(digests: bytes) -> tuple[np.ndarray, np.ndarray]:
    whole = np.frombuffer(digests, [("h", "<i8"), ("f", "<i4"), ("rest", "<i4")])
    return np.ascontiguousarray(whole["h"]), np.ascontiguousarray(whole["f"])


def _held(min_chars: int):
    """(doc_id, text hash, text) -> a row for each distinct key of the text."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            count, digests = [], []
            for text in b.column(2):
                raw = text.as_buffer()
                found = _keys(raw.to_pybytes().split(b"\n"), min_chars)[1] if raw else b""
                own = {found[i : i + 16] for i in range(0, len(found), 16)}
                count.append(len(own))
                digests.extend(own)
            h, f = _parts(b"".join(digests))
            at = pa.array(np.repeat(np.arange(b.num_rows), count))
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(h), pa.array(f)], ["doc_id", "text_hash", "h", "f"])
        release_memory()

    return step


def _column(rows: list[pa.RecordBatch], name: str) -> np.ndarray:
    return np.concatenate([b.column(b.schema.get_field_index(name)).to_numpy(zero_copy_only=False) for b in rows])


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of equal shards of sorted batches."""
    for b in batches:
        shard = b.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if lo < hi:
                yield int(shard[lo]), b.slice(lo, hi - lo)


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, h, f, n, last) sorted by shard -> a row of arrays for each shard."""

    def made(shard: int, rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        row = Lines.build(*(_column(rows, c) for c in ("h", "f", "n", "last"))).row()
        kinds = [pa.int32(), pa.list_(pa.int64()), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip([shard, *row], kinds, strict=True)], ["shard", "sizes", "bits", "prints", "counts", "last"])

    held, now = [], None
    for shard, rows in _by_shard(batches):
        if shard != now and held:
            yield made(now, held)
            held = []
        now = shard
        held.append(rows)
    if held:
        yield made(now, held)


def _probed(min_docs: int):
    """(shard, ids, key, arrays) sorted by shard with its arrays first -> (ids, key) of what is to be dropped."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, now = None, None
        for shard, rows in _by_shard(batches):
            if shard != now:
                index, now = Lines.of(*(rows.column(k)[0].as_py() for k in range(5, 10))), shard
                rows = rows.slice(1)
            if rows.num_rows:
                ids, text, h, f = (rows.column(k) for k in range(1, 5))
                gone = index.gone(h.to_numpy(), f.to_numpy(), ids.to_numpy(), min_docs)
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(gone)) for c in (ids, text, h, f)], ["doc_id", "text_hash", "h", "f"])

    return step


def _cold(hot: Lines):
    """Rows whose key is not in the index."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(hot.find(b.column(2).to_numpy(), b.column(3).to_numpy()) < 0))

    return step


def index(held: DataFrame, hot: int = HOT, shard: int = SHARD, shards: int = SHARDS) -> tuple[Lines, DataFrame, int]:
    """The shard of the keys that are frequent, all others as a table of shards, and how many those are."""
    keys = cut(held.groupBy("h", "f").agg(F.count("*").alias("n"), F.max("doc_id").alias("last")))
    probes = keys.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") > probes // hot  # fewer than `hot` keys
    rows = keys.where(often).toArrow()
    found = Lines.build(*(rows.column(c).to_numpy() for c in ("h", "f", "n", "last")))
    number = max(shards, -(-probes // shard))
    dealt = keys.where(~often).select(F.pmod("h", F.lit(number)).cast("int").alias("shard"), "h", "f", "n", "last")
    return found, dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(_built, f"shard int, {ARRAYS}"), number


def _dropped(held: DataFrame, hot: Lines, shards: DataFrame, number: int, min_docs: int) -> DataFrame:
    """(doc_id, text_hash, keys) for documents that lose lines, apart from the frequent ones."""
    probes = held.mapInArrow(_cold(hot), held.schema).select(F.pmod("h", F.lit(number)).cast("int").alias("shard"), "doc_id", "text_hash", "h", "f")
    both = shards.unionByName(probes, allowMissingColumns=True).select("shard", "doc_id", "text_hash", "h", "f", "sizes", "bits", "prints", "counts", "last")
    found = both.repartition("shard").sortWithinPartitions("shard", F.col("h").isNotNull()).mapInArrow(_probed(min_docs), held.schema)
    # no more keys for a text than it has lines
    return found.distinct().groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("h", "f")).alias("gone"))


def _kept(hot: Lines, min_chars: int, min_docs: int, to: str):
    """Rows with text, id and keys to drop as their last columns -> rows with the lines that stay."""
    kind = pa.struct([("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("text", pa.string())])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            *others, ids, texts, gone = b.columns
            ids, out = ids.to_numpy(), {"n_lines": [], "n_dropped": [], "text": []}
            for i, text in enumerate(texts):
                raw = text.as_buffer()
                lines = raw.to_pybytes().split(b"\n") if raw else [b""]
                at, digests = _keys(lines, min_chars)
                h, f = _parts(digests)
                lost = hot.gone(h, f, ids[i], min_docs) if at else np.zeros(0, bool)
                own = gone[i].as_py()
                if own:
                    pairs = {(x["h"], x["f"]) for x in own}
                    lost = lost | np.array([p in pairs for p in zip(h.tolist(), f.tolist(), strict=True)], bool)
                out["n_lines"].append(len(lines))
                out["n_dropped"].append(int(lost.sum()))
                if lost.any():
                    away = {at[k] for k in np.flatnonzero(lost)}
                    lines = [x for k, x in enumerate(lines) if k not in away]
                out["text"].append(b"\n".join(lines))
            made = [pa.array(out["n_lines"], pa.int64()), pa.array(out["n_dropped"], pa.int64()), pa.array(out["text"], pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*others, pa.StructArray.from_arrays(made, fields=list(kind))], [*b.schema.names[: len(others)], to])
        release_memory()

    return step


def drop_lines(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", to: str = "lines", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, hot: int = HOT, shard: int = SHARD, shards: int = SHARDS) -> DataFrame:
    """All rows with a struct column `to`: n_lines before, n_dropped, text of the lines that stay."""
    ids, raw = F.coalesce(documents[doc_id].cast("bigint"), F.lit(NO_ID)), documents[text].cast("binary")
    narrow = documents.select(ids.alias("doc_id"), F.xxhash64(documents[text]).alias("text_hash"), raw.alias("text"))
    held = cut(narrow.mapInArrow(_held(min_chars), "doc_id bigint, text_hash bigint, h bigint, f int"))  # read twice
    frequent, table, number = index(held, hot, shard, shards)
    lost = _dropped(held, frequent, table, number, min_docs).toDF(f"{HELPER}id", f"{HELPER}hash", f"{HELPER}gone")
    kept = [documents[f"`{c}`"] for c in documents.columns if c.lower() != to.lower()]
    rows = documents.select(*kept, ids.alias(f"{HELPER}id"), F.xxhash64(documents[text]).alias(f"{HELPER}hash"), raw.alias(f"{HELPER}text"))
    rows = rows.join(lost.hint("shuffle_hash"), [f"{HELPER}id", f"{HELPER}hash"], "left").select(*(f"`{c.replace('`', '``')}`" for c in [*(x for x in documents.columns if x.lower() != to.lower()), f"{HELPER}id", f"{HELPER}text", f"{HELPER}gone"]))
    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.schema[:-3]]
    return rows.mapInArrow(_kept(frequent, min_chars, min_docs, to), ", ".join([*fields, f"`{to}` struct<n_lines: bigint, n_dropped: bigint, text: string>"]))


def op13(documents: DataFrame) -> DataFrame:
    out = drop_lines(documents.select("doc_id", "text"), to=HELPER)
    return out.select("doc_id", f"{HELPER}.n_lines", f"{HELPER}.n_dropped", F.sha2(f"{HELPER}.text", 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (SELECT r, doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
m AS (SELECT key, count(DISTINCT r) AS n, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT r) >= 3),
g AS (SELECT k.r, k.doc_id, k.i, k.line, m.key IS NOT NULL AND k.doc_id IS DISTINCT FROM m.last AS gone FROM k LEFT JOIN m ON k.key = m.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM g GROUP BY r, doc_id
"""
