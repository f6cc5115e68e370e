"""Language identification by cross-parsing entropy over suffix automata.

For each language a suffix automaton of labelled text is built.  A text is cut greedily into the longest
phrases that occur in that language's text; the entropy estimate is phrases * log2(training
length) / text length, and the language with the fewest such normalised phrases wins.

Training takes a bounded sample: ``docs_per_lang`` documents of each language (one from each of so many
hash groups of ids, so the choice is spread over the corpus and pre-aggregated before its shuffle; texts of
``USUAL`` characters are preferred), of which whole texts are taken while they fit ``chars_per_lang`` characters.  A language that has only
longer texts is learnt from slices spread evenly over one of them.  More than ``MAX_LANGS`` times ``docs_per_lang`` documents to learn from are an error.
Every character of the sample has a code.  Transitions by the ``SYMBOLS`` - 1 most frequent ones are flat tables
(state x symbol), those by any other (of a further script, say) a sorted list; both have a size fixed by
these bounds, and are broadcast.

Texts are parsed whole.  Parsing runs over all texts of an Arrow batch in lockstep with numpy; so that a long text does not hold
up a batch, it is parsed in pieces at once, each from ``WARM`` characters before its start.  Where a piece has not met the state in which the
one before it ends, it is parsed again from there, so the phrases are those of one pass.

Defined results: null texts and texts without a letter give ``und`` with score 0; with nothing to learn
from every text gives ``und``; ties go to the alphabetically first language; repeated rows get the same result each; an empty table
gives no rows; a language's name is never an input of a prediction.
A column that is named like a result is replaced by it.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewarden.llm.common import release_memory

DOCS_PER_LANG = 48
CHARS_PER_LANG = 8_000
MAX_LANGS = 200
SYMBOLS = 96
PIECE, WARM = 1024, 256
USUAL = (100, 1_000)
SLICES = 8
UNKNOWN = (20, 0.75)  # characters from which, and phrases a character beyond which, a text is in none of the languages
LETTER = re.compile(r"[^\W\d_]")
SQUEEZE = re.compile(r"[\W\d_]+")


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a code sequence; state 0 is the start."""
    trans: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        cur = len(trans)
        trans.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in trans[p]:
            trans[p][c] = cur
            p = link[p]
        if p != -1:
            q = trans[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(trans)
                trans.append(dict(trans[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p != -1 and trans[p].get(c) == q:
                    trans[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return trans


def squeezed(text: str) -> str:
    """Lower-case letters; runs of anything else are one space."""
    return SQUEEZE.sub(" ", text.lower()).strip()


def _fitting(texts: list[str], most: int) -> list[str]:
    """The first text, and of the others those that still fit."""
    out, size = texts[:1], sum(map(len, texts[:1]))
    for t in texts[1:]:
        if size + len(t) + 1 <= most:
            out.append(t)
            size += len(t) + 1
    return out


class LanguageModel:
    """Alphabet, transition tables of all languages in one array, and the weight of a phrase."""

    def __init__(self, samples: dict[str, list[str]], chars_per_lang: int = CHARS_PER_LANG):
        texts = {lang: " ".join(_fitting([t for t in map(squeezed, parts) if t], chars_per_lang)) for lang, parts in samples.items()}
        self.langs = sorted(lang for lang, t in texts.items() if t)
        count: dict[str, int] = {}
        for lang in self.langs:
            for ch in texts[lang]:
                count[ch] = count.get(ch, 0) + 1
        kept = sorted(count, key=lambda ch: (-count[ch], ch))  # 0 stands for a character that no sample has
        self.alphabet = {ch: i + 1 for i, ch in enumerate(kept)}
        self.width = len(kept) + 1
        size, tables, starts, at, rare = min(SYMBOLS, self.width), [], [], 0, {}
        for lang in self.langs:
            trans = suffix_automaton([self.alphabet[ch] for ch in texts[lang]])
            flat = np.full((len(trans), size), -1, np.int32)
            for s, row in enumerate(trans):
                for c, to in row.items():
                    if c < size:
                        flat[s, c] = to + at
                    else:
                        rare[(s + at) * self.width + c] = to + at
            starts.append(at)
            tables.append(flat)
            at += len(trans)
        self.size = size
        self.table = np.concatenate(tables).ravel() if tables else np.empty(0, np.int32)
        self.rare = np.array(sorted(rare), np.int64)
        self.rare_to = np.array([rare[k] for k in self.rare.tolist()], np.int32)
        self.starts = np.array(starts, np.int32)
        self.weight = np.array([math.log2(len(texts[lang]) + 1) for lang in self.langs])

    def codes(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        lut = self._lut()
        return lut[np.minimum(points, len(lut) - 1)]

    def _lut(self):
        """Codes by code point; the last cell is that of all unknown characters."""
        if not hasattr(self, "_codes"):
            self._codes = np.zeros(max(map(ord, self.alphabet), default=0) + 2, np.min_scalar_type(self.width))
            for ch, c in self.alphabet.items():
                self._codes[ord(ch)] = c
        return self._codes

    def _rare(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Where states go by characters outside the flat tables, -1 for nowhere."""
        key = state.astype(np.int64) * self.width + c
        at = np.minimum(np.searchsorted(self.rare, key), len(self.rare) - 1)
        return np.where(self.rare[at] == key, self.rare_to[at], -1)

    def _parse(self, pieces: list[np.ndarray], state: np.ndarray, warm: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases of each piece (columns) in each language (rows) behind its warm-up, and the states there and at its end."""
        lengths = np.array([len(p) for p in pieces])
        order = np.argsort(-lengths, kind="stable")
        grid = np.zeros((lengths.max(initial=0), len(pieces)), np.min_scalar_type(self.width))
        for col, i in enumerate(order):
            grid[: lengths[i], col] = pieces[i]
        alive = np.searchsorted(-lengths[order], -np.arange(len(grid)), side="left")
        warmed = np.flatnonzero(warm[order])
        n_lang = len(self.langs)
        count = np.zeros((n_lang, len(pieces)), np.int32)
        state = state[:, order].copy()
        met = state.copy()
        root = self.starts[:, None]
        first = np.stack([self.table[s * self.size : (s + 1) * self.size] for s in self.starts])
        first = np.where(first < 0, root, first)  # an unknown symbol is a phrase of its own
        for t, live in enumerate(alive):
            if t == WARM and len(warmed):
                count[:, warmed] = 0
                met[:, warmed] = state[:, warmed]
            c = grid[t, :live].astype(np.int32)
            s = state[:, :live]
            odd = np.flatnonzero(c >= self.size)
            far = c[odd]
            c[odd] = 0
            to = self.table[s * self.size + c]
            if len(odd):
                to[:, odd] = self._rare(s[:, odd], far)
            ends = to < 0
            count[:, :live] += ends | (s == root)  # a phrase begins at the start, where the last one ends, and behind an unknown symbol
            again = first[:, c]
            if len(odd):
                begun = self._rare(np.broadcast_to(root, (n_lang, len(odd))), far)
                again[:, odd] = np.where(begun < 0, root, begun)
            state[:, :live] = np.where(ends, again, to)
        back = np.argsort(order)
        return count[:, back], met[:, back], state[:, back]

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text's codes (rows) in each language (columns)."""
        pieces, owner, nth = [], [], []
        for i, t in enumerate(texts):
            for k, a in enumerate(range(0, max(1, len(t)), PIECE)):
                pieces.append(t[max(0, a - WARM) : a + PIECE])
                owner.append(i)
                nth.append(k)
        owner, nth = np.array(owner, np.int64), np.array(nth, np.int64)
        root = np.repeat(self.starts[:, None], len(pieces), 1)
        count, met, final = self._parse(pieces, root, nth > 0)
        for k in range(1, int(nth.max(initial=0)) + 1):
            at = np.flatnonzero(nth == k)
            at = at[(met[:, at] != final[:, at - 1]).any(0)]
            if len(at):
                count[:, at], _, final[:, at] = self._parse([pieces[i][WARM:] for i in at], final[:, at - 1], np.zeros(len(at), bool))
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        np.add.at(out, owner, count.T)
        return out

    def predict(self, texts: list[str | None], reject: bool = False) -> tuple[list[str], list[float]]:
        """Languages and scores; with reject, texts that are in none of the languages give und as well."""
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        some = [i for i, t in enumerate(texts) if t and LETTER.search(t)] if self.langs else []
        if not some:
            return langs, scores
        codes = [self.codes(squeezed(texts[i])) for i in some]
        n = np.array([max(1, len(c)) for c in codes])
        total = self.phrases(codes)
        entropy = total * self.weight / n[:, None]
        best = entropy.argmin(1)
        # share of the winner among exp(-excess phrases), as a softmax over total code length
        excess = np.minimum((entropy - entropy.min(1, keepdims=True)) * n[:, None], 700.0)
        share = 1 / np.exp(-excess).sum(1)
        strange = (n >= UNKNOWN[0]) & (total[np.arange(len(some)), best] > UNKNOWN[1] * n) & reject
        for k in np.flatnonzero(~strange).tolist():
            langs[some[k]], scores[some[k]] = self.langs[best[k]], float(share[k])
        return langs, scores


def _whole_or_slices(text: Column, most: int) -> Column:
    """The text, or SLICES slices spread over it if it is longer than most."""
    part, n = most // SLICES, F.length(text)
    at = lambda k: F.lit(1) + F.floor((n - part) * k / (SLICES - 1)).cast("int")
    return F.when(n <= most, text).otherwise(F.concat_ws(" ", *[F.substring(text, at(k), F.lit(part)) for k in range(SLICES)]))


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", docs_per_lang: int = DOCS_PER_LANG, chars_per_lang: int = CHARS_PER_LANG) -> LanguageModel:
    """A model from the rows with a non-null language; at most docs_per_lang rows of each reach the driver."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    size = F.length(F.col(text))
    order = F.struct(~size.between(*USUAL), size > chars_per_lang, F.xxhash64(F.col(doc_id), F.lit("language")), F.xxhash64(F.col(text)))
    group = F.pmod(F.xxhash64(F.col(doc_id), F.lit("group")), F.lit(docs_per_lang))
    picked = rows.groupBy(F.col(lang).cast("string").alias("lang"), group.alias("g")).agg(F.min_by(F.struct(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("h")), order).alias("k"))
    picked = picked.where("k.id is not null")
    few = F.broadcast(picked.orderBy("lang", "g").limit(MAX_LANGS * docs_per_lang + 1).select(F.col("lang").alias("__l"), F.col("k.id").alias("__id"), F.col("k.h").alias("__h")))
    # ids first, then their texts: the long texts of the corpus are never shuffled
    texts = rows.select(F.col(doc_id).alias("__d"), F.col(lang).cast("string").alias("l"), F.xxhash64(F.col(text)).alias("__x"), F.col(text).alias("t"))
    texts = texts.join(few, (F.col("__d") == F.col("__id")) & (F.col("l") == F.col("__l")) & (F.col("__x") == F.col("__h")))
    texts = texts.select("l", "__d", _whole_or_slices(F.col("t"), chars_per_lang).alias("t")).distinct()  # one of repeated rows
    samples: dict[str, list[tuple]] = {}
    found = texts.collect()
    if len(found) > MAX_LANGS * docs_per_lang:
        raise ValueError(f"more than {MAX_LANGS * docs_per_lang} documents to learn from: over {MAX_LANGS} languages")
    for r in found:
        short = USUAL[0] <= len(r["t"]) <= USUAL[1]
        samples.setdefault(r["l"], []).append((not short, str(r["__d"]), r["t"]))
    return LanguageModel({lang: [t for *_, t in sorted(parts)] for lang, parts in samples.items()}, chars_per_lang)


def predictor(spark, model: LanguageModel, reject: bool = False):
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang:string,score:double>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        langs, scores = [], []
        for a in range(0, len(texts), 1000):
            found = shared.value.predict(list(texts.iloc[a : a + 1000]), reject)
            langs += found[0]
            scores += found[1]
        release_memory()
        return pd.DataFrame({"lang": langs, "score": scores})

    return predict.asNondeterministic()  # else a filter on the result would compute it twice


def with_language(documents: DataFrame, model: LanguageModel, text: str = "text", to: str = "lang_pred", reject: bool = False) -> DataFrame:
    """Adds a struct (lang, score) named to; with reject, lang is und also for texts in none of the languages."""
    return documents.withColumn(to, predictor(documents.sparkSession, model, reject)(F.col(text).cast("string")))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def op6(documents: DataFrame) -> DataFrame:
    docs = documents.select("doc_id", "text", "lang")
    model = learn(docs.where(~held_out(F.col("doc_id"))))
    found = with_language(docs.select("doc_id", "text"), model, to="__found")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__found.lang").alias("lang_pred"), F.col("__found.score").alias("score"))
