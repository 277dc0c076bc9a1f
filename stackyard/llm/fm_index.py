"""Substring dedup on words with compressed FM-indexes (operator 10).

A word is removed if a run of ``words`` words that covers it also starts
earlier in the corpus (smaller doc_id, or earlier in the document).
:mod:`segments` brings the texts in which that can happen together by
content; each shard then builds an FM-index of its segments and streams them
through it:

* the index is the Burrows-Wheeler transform of the shard's word numbers in a
  wavelet matrix: one bit vector for each bit of a word number, packed in
  64-bit words with counts for each of them;
* every run of words is searched backwards, all of the shard's runs one word
  at a time together, and leaves the search as soon as it matches at one
  place only; its matching statistic is the number of words matched;
* the intervals of runs that reach ``words`` words hold all their places, of
  which the earliest stays.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import merge_intervals, saved, small, small_batches
from .segments import (distinct_segments, exact_hash, per_document, runs_of, shared_segments, solve_hot, solve_shards,
                       with_texts)
from .words import _VALUES, Texts, window_hashes

WORDS = 20
#: Words of the grams whose smallest hash is a run's key.
GRAM = 6
#: Words of one shard's text.
SHARD_WORDS = 150_000


class WaveletMatrix:
    """rank(c, i): how often c is among the first i values."""

    def __init__(self, values: np.ndarray, size: int):
        self.bits = max(1, int(size - 1).bit_length())
        self.levels, self.zeros = [], []
        v = values
        for b in range(self.bits - 1, -1, -1):
            bit = (v >> b) & 1
            packed = np.packbits(bit.astype(np.uint8), bitorder="little")
            word = np.zeros(len(v) // 64 + 1, np.uint64)
            word.view(np.uint8)[:len(packed)] = packed
            ones = np.zeros(len(word), np.int32)
            np.cumsum(np.bitwise_count(word[:-1]), out=ones[1:])
            self.levels.append((word, ones))
            self.zeros.append(int(len(v) - bit.sum()))
            v = np.concatenate((v[bit == 0], v[bit == 1]))
        # where the values equal to c start after all levels
        count = np.bincount(values, minlength=1 << self.bits)
        reverse = np.zeros(1 << self.bits, np.int64)
        for b in range(self.bits):
            reverse |= ((np.arange(1 << self.bits) >> b) & 1) << (self.bits - 1 - b)
        order = np.argsort(reverse, kind="stable")
        self.start = np.empty(1 << self.bits, np.int64)
        self.start[order] = np.cumsum(count[order]) - count[order]

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, ((word, ones), zeros) in enumerate(zip(self.levels, self.zeros)):
            at = i >> 6
            n = ones[at] + np.bitwise_count(word[at] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)))
            i = np.where((c >> (self.bits - 1 - level)) & 1, zeros + n, i - n)
        return i - self.start[c]


def sorted_suffixes(t: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes by their first ``depth`` values or more (doubling). A backward
    search for patterns of up to ``depth`` values needs no finer order."""
    rank, h = t.astype(np.int64), 1
    n = len(t)
    while True:
        if h >= depth:
            return np.argsort(rank, kind="stable")
        second = np.zeros(n, np.int64)
        if h < n:
            second[:-h] = rank[h:] + 1
        key = rank * (max(n, int(rank.max()) + 1) + 1) + second
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
        h *= 2


class FMIndex:
    """Backward search over a string of numbers 0 .. size-1."""

    def __init__(self, t: np.ndarray, size: int, depth: int):
        sa = sorted_suffixes(t, depth)
        self.n = len(t)
        self.bwt = WaveletMatrix(t[sa - 1], size)
        count = np.bincount(t, minlength=size)
        self.first = np.cumsum(count) - count

    def match(self, t: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of the runs t[s:s+length], from their last value
        backwards: (values matched while at two places or more, interval start)."""
        lo = np.zeros(len(start), np.int64)
        hi = np.full(len(start), self.n, np.int64)
        matched = np.zeros(len(start), np.int64)
        live = np.arange(len(start))
        for j in range(length - 1, -1, -1):
            c = t[start[live] + j]
            a = self.first[c] + self.bwt.rank(c, lo[live])
            b = self.first[c] + self.bwt.rank(c, hi[live])
            lo[live], hi[live] = a, b
            more = b - a > 1
            live = live[more]
            matched[live] += 1
            if not len(live):
                break
        return matched, lo


def earlier_windows(bodies: list[np.ndarray], place: np.ndarray, words: int) -> list[np.ndarray]:
    """For each body (word hashes), which of its runs also start earlier.

    ``place`` is the number of each body's (document, first word) in order
    of the corpus, as three columns: doc_id (null first), text hash, word.
    """
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
    values, number = np.unique(np.concatenate(bodies), return_inverse=True)
    first = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    t = np.zeros(int((sizes + 1).sum()) + 1, np.int64)  # 0 ends a body
    own = np.repeat(np.arange(len(bodies)), sizes)
    t[np.arange(len(own)) + own] = number + 1
    t[-1] = 0
    index = FMIndex(t, len(values) + 1, words)
    runs = np.maximum(sizes - words + 1, 0)
    body = np.repeat(np.arange(len(bodies)), runs)
    offset = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
    matched, interval = index.match(t, first[body] + offset, words)
    again = np.flatnonzero(matched == words)
    flags = np.zeros(len(body), bool)
    if len(again):
        # runs with one interval are equal: all but those at the earliest place go
        doc, th, word = (place[body[again], c] for c in range(3))
        at = np.stack((doc, th, word + offset[again]))
        order = np.lexsort((at[2], at[1], at[0], interval[again]))
        i, at = interval[again][order], at[:, order]
        new = np.concatenate(([True], i[1:] != i[:-1]))
        least = np.flatnonzero(new)[np.cumsum(new) - 1]
        flags[again[order]] = (at != at[:, least]).any(axis=0)
    return np.split(flags, np.cumsum(runs)[:-1])


def _word_hashes(t: Texts) -> np.ndarray:
    """Hashes that stand for the words themselves."""
    return exact_hash(_VALUES[t.data])(t.start, t.end) if len(t.start) else np.zeros(0, np.uint64)


def _units(texts: list[bytes]):
    t = Texts(texts)
    h = _word_hashes(t)
    return h, t.first[:-1], t.first[1:], window_hashes(h, GRAM, 1)


def earlier_ranges(docs: DataFrame, words: int = WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, th, first, windows): the runs of windows that also start earlier."""
    shared = shared_segments(docs, _units, words, GRAM)
    distinct = distinct_segments(shared, shard_words, words - 1)

    def cut(text, starts, counts):
        own = text.split()
        return [b" ".join(own[s:s + n + words - 1]) for s, n in zip(starts, counts)]

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        least = np.iinfo(np.int64).min
        doc = np.array([least if pd.isna(x) else int(x) for x in pdf["doc_id"]], np.int64)
        place = np.stack((doc, pdf["th"].to_numpy(), pdf["start"].to_numpy()), axis=1)
        t = Texts(pdf["body"].tolist())
        flags = earlier_windows(np.split(_word_hashes(t), t.first[1:-1]), place, words)
        rows = []
        for key, content, n, f in zip(pdf["key"], pdf["content"], pdf["n"], flags):
            rows += [(key, content, n, a, k) for a, k in zip(*runs_of(f))]
        return pd.DataFrame(rows, columns=["key", "content", "n", "first", "windows"])

    def later_windows(each: DataFrame) -> DataFrame:
        at = F.struct("doc_id", "th", "start")
        least = saved(each.groupBy("key", "h").agg(F.min(at).alias("least"), F.count(F.lit(1)).alias("c")).where("c > 1")
                      .select("key", "h", "least"), "windows-first")
        return each.join(small(least), ["key", "h"]).where(~at.eqNullSafe(F.col("least")))

    found = solve_shards(with_texts(distinct.where("solve and not hot"), docs, cut, shard_words, words - 1), solve)
    hot = distinct.where("hot")
    if not hot.isEmpty():
        found = found.union(solve_hot(with_texts(hot, docs, cut, shard_words, words - 1), _units, words, later_windows))
    own = ["key", "content", "n"]
    at = F.struct("doc_id", "th", "start")
    firsts = distinct.select(*own, F.struct("doc_id", "th", "start").alias("p"), "copies")
    # the first of equal segments loses what the index found, the others everything
    first = found.join(firsts, own).select("p.doc_id", "p.th", (F.col("p.start") + F.col("first")).alias("first"), "windows")
    later = (shared.select("doc_id", "th", "start", *own).join(firsts.where("copies > 1"), own).where(~at.eqNullSafe(F.col("p")))
             .select("doc_id", "th", F.col("start").alias("first"), F.col("n").alias("windows")))
    return first.union(later)


def remove_repeated_words(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text",
                          keep_text: bool = False, **options) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept]) of every row.

    Words are runs of bytes other than ASCII white space, unchanged. Runs are
    judged on the input; null ids come first; rows with the same id and text
    are one document and keep the same words. Null texts have no words; an
    empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    ranges = earlier_ranges(docs, words, **options)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept binary" if keep_text else "")

    def finish(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(5)]
            for doc_id, text, at in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "at"))):
                own = text.split()
                first = np.array([x["first"] for x in at or []], np.int64)
                n = np.array([x["windows"] for x in at or []], np.int64)
                a, e = merge_intervals(first, first + n + words - 1)
                left = own
                if len(a):
                    left = [w for i, j in zip([0, *e.tolist()], [*a.tolist(), len(own)]) for w in own[i:j]]
                kept = b" ".join(left)
                for c, v in zip(out, (doc_id, len(own), len(own) - len(left), hashlib.sha256(kept).hexdigest(), kept)):
                    c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            names = [c.split()[0] for c in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in list(zip(out, kinds))[:len(names)]], names=names)

    return per_document(docs, ranges, finish, schema)
