"""Benchmark decontamination by SimHash windows (operator 8).

For every benchmark item, the document windows of the item's word count (a
document of fewer words is one window) are compared with it: SimHash fingerprints of both, a multi-index over blocks of
the fingerprint for all items within a Hamming radius, then the weighted
(multiset) Jaccard similarity of the word shingles, computed exactly.

Most windows need no fingerprint: a window as similar as asked shares at
least ``2 s / (1 + s)`` of its shingles with the item, so only windows with
that many shingles of any item are looked at. This bound loses nothing.

The benchmark is the stated query set: it is taken in blocks of bounded size,
and each block's index is broadcast to one pass over the documents.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_hash, saved, small, stream_texts, without
from .tokens import chunks
from .words import Texts, window_hashes

#: Items of one block, and the words they may have together.
BLOCK_ITEMS = 20_000
BLOCK_WORDS = 4_000_000
#: Fingerprint blocks: with 64 bits in 8 blocks, two fingerprints at most
#: ``radius`` bits apart have a block with at most radius // 8 bits apart.
BLOCKS = 8
RADIUS = 18


def votes(hashes: np.ndarray) -> np.ndarray:
    """SimHash of each row of shingle hashes (repeats vote as often)."""
    n, k = hashes.shape
    out = np.empty(n, np.uint64)
    step = max(1, 500_000 // k)
    for i in range(0, n, step):
        bits = np.unpackbits(hashes[i:i + step].astype(">u8").view(np.uint8).reshape(-1, k, 8), axis=2)
        out[i:i + step] = np.packbits(2 * bits.sum(axis=1, dtype=np.int64) > k, axis=1).view(">u8").ravel()
    return out


def fold(texts: list[bytes]) -> Texts:
    """Words in lower case, in any script."""
    return Texts([x.lower() if x.isascii() else x.decode().lower().encode() for x in texts])


class ItemIndex:
    """Fingerprints, block tables and shingles of one block of items."""

    def __init__(self, ids: list[int], texts: list[bytes], shingle: int, similarity: float, radius: int):
        t = fold(texts)
        h = t.hashes()
        self.radius, self.similarity, self.shingle = radius, similarity, shingle
        self.ids, self.words, self.shingles, self.weights = [], [], [], []
        rows = []
        for i, item in enumerate(ids):
            own = h[t.first[i]:t.first[i + 1]]
            if len(own):
                s = window_hashes(own, min(shingle, len(own)))
                self.ids.append(item)
                self.words.append(len(own))
                rows.append(votes(s[None, :])[0])
                u, n = np.unique(s, return_counts=True)
                self.shingles.append(u)
                self.weights.append(n)
        self.fp = np.array(rows, np.uint64)
        self.words = np.array(self.words, np.int64)
        #: by shingle length: all shingles of items that use it
        self.known = {}
        for k in sorted({min(shingle, int(n)) for n in self.words}):
            own = [s for s, n in zip(self.shingles, self.words) if min(shingle, n) == k]
            self.known[k] = np.unique(np.concatenate(own))
        self.lengths = sorted({int(n) for n in self.words})
        near = [np.flatnonzero(np.bitwise_count(np.arange(256, dtype=np.uint8) ^ np.uint8(v)) <= radius // BLOCKS)
                for v in range(256)]
        self.table: dict[tuple[int, int], list[int]] = {}
        for i, f in enumerate(self.fp.view(np.uint8).reshape(-1, 8)):
            for b in range(BLOCKS):
                for v in near[f[b]]:
                    self.table.setdefault((b, int(v)), []).append(i)

    def within(self, fp: np.uint64, n_words: int, longer: bool = False) -> list[int]:
        """All items of ``n_words`` words (with ``longer``, of more words but one
        shingle length) whose fingerprint is within the radius."""
        got: set[int] = set()
        for b, v in enumerate(np.array([fp], np.uint64).view(np.uint8).tolist()):
            got.update(self.table.get((b, v), ()))
        if not got:
            return []
        at = np.fromiter(got, np.int64, len(got))
        own = (self.words[at] > n_words) & (n_words >= self.shingle) if longer else self.words[at] == n_words
        at = at[own & (np.bitwise_count(self.fp[at] ^ fp) <= self.radius)]
        return np.sort(at).tolist()

    def weighted_similarity(self, shingles: np.ndarray, item: int) -> float:
        u, n = np.unique(shingles, return_counts=True)
        _, x, y = np.intersect1d(u, self.shingles[item], assume_unique=True, return_indices=True)
        both = int(np.minimum(n[x], self.weights[item][y]).sum())
        return both / (int(n.sum()) + int(self.weights[item].sum()) - both)

    def windows(self, known_at: np.ndarray, n: int) -> np.ndarray:
        """First shingles of the windows of ``n`` shingles with enough known ones."""
        need = max(1, math.ceil(2 * self.similarity / (1 + self.similarity) * n - 1e-9))
        if len(known_at) < need:
            return np.zeros(0, np.int64)
        a, b = known_at[:len(known_at) - need + 1], known_at[need - 1:]
        k = b - a < n
        lo, hi = np.maximum(b[k] - n + 1, 0), a[k] + 1
        size = hi - lo
        if not len(size):
            return np.zeros(0, np.int64)
        at = np.repeat(lo - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        return np.unique(at)

    def matches(self, texts: list[bytes]) -> list[tuple[int, int, int, int, int, float]]:
        """(text, first word, words, item, bits apart, similarity) of every match."""
        t = fold(texts)
        h = t.hashes()
        out = []
        memo: dict[tuple[int, bytes], list] = {}
        for k, known in self.known.items():
            s = window_hashes(h, k)
            if not len(s):
                continue
            at = np.minimum(np.searchsorted(known, s), len(known) - 1)
            known_at = np.flatnonzero((known[at] == s) & t.whole_windows(k))
            if not len(known_at):
                continue
            for n_words in self.lengths:
                if min(self.shingle, n_words) != k:
                    continue
                n = n_words - k + 1
                first = self.windows(known_at, n)
                first = first[first + n_words <= len(h)]
                first = first[t.text_of[first] == t.text_of[first + n_words - 1]]
                if not len(first):
                    continue
                rows = s[first[:, None] + np.arange(n)]
                for w, row, fp in zip(first.tolist(), rows, votes(rows)):
                    key = (n_words, row.tobytes())
                    if key not in memo:
                        found = []
                        for item in self.within(fp, n_words):
                            sim = self.weighted_similarity(row, item)
                            if sim >= self.similarity:
                                found.append((item, int(np.bitwise_count(self.fp[item] ^ fp)), sim))
                        memo[key] = found
                    text = int(t.text_of[w])
                    out += [(text, w - int(t.first[text]), n_words, item, d, sim) for item, d, sim in memo[key]]
        return out + self.whole_texts(t, h)

    def whole_texts(self, t: Texts, h: np.ndarray) -> list[tuple[int, int, int, int, int, float]]:
        """The matches of texts with items of more words than the text, which is
        the one window. A text of ``n`` shingles is that similar only to items of
        at most ``n / similarity`` shingles, and shares ``similarity * n`` at least."""
        known = self.known.get(self.shingle)
        if known is None:
            return []
        out = []
        n_shingles = t.n_words - self.shingle + 1
        for text in np.flatnonzero((n_shingles > 0) & (t.n_words < self.lengths[-1])).tolist():
            n = int(n_shingles[text])
            # the next length that an item has
            more = self.lengths[np.searchsorted(self.lengths, t.n_words[text], side="right")] - self.shingle + 1
            if n < self.similarity * more - 1e-9:
                continue
            row = window_hashes(h[t.first[text]:t.first[text + 1]], self.shingle)
            if np.isin(row, known).sum() < self.similarity * n - 1e-9:
                continue
            fp = votes(row[None, :])[0]
            for item in self.within(fp, n + self.shingle - 1, longer=True):
                sim = self.weighted_similarity(row, item)
                if sim >= self.similarity:
                    out.append((text, 0, n + self.shingle - 1, item, int(np.bitwise_count(self.fp[item] ^ fp)), sim))
        return out


def _blocks(items: DataFrame, id_col: str, text_col: str):
    """Items in blocks: lists of (id, text) of bounded number and size."""
    block, words = [], 0
    rows = items.select(F.col(f"`{id_col}`").cast("long").alias("item_id"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    for r in rows.toLocalIterator():
        n = len(r["text"]) // 2
        if block and (len(block) == BLOCK_ITEMS or words + n > BLOCK_WORDS):
            yield block
            block, words = [], 0
        block.append((r["item_id"], r["text"].encode()))
        words += n
    if block:
        yield block


def leak_matches(docs: DataFrame, items: DataFrame, shingle: int = 5, similarity: float = 0.8, radius: int = RADIUS,
                 id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                 item_text_col: str = "text") -> DataFrame:
    """(doc_id, th, item_id, first_word, n_words, bits, similarity), the best
    window of each (document, item) pair. A document is an id with the hash
    ``th`` of its text: different texts under one id, or without an id, are judged
    on their own.

    Items without words match nothing; items of fewer words than a shingle
    are one shingle and match only the same words. Null and empty texts match
    nothing; an empty table on either side gives an empty result; repeated
    rows give one match per document and item.
    """
    spark = docs.sparkSession
    docs = docs.withColumn("__th", row_hash(text_col))
    schema = "doc_id long, th long, item_id long, first_word long, n_words long, bits int, similarity double"
    found = None
    for block in _blocks(items, item_id_col, item_text_col):
        index = ItemIndex([i for i, _ in block], [x for _, x in block], shingle, similarity, radius)
        if not index.lengths:
            continue
        sent = spark.sparkContext.broadcast(index)

        def batch(batches, sent=sent):
            index = sent.value
            for b in batches:
                rows = []
                known = list(zip(b.column("doc_id").to_pylist(), b.column("__th").to_pylist()))
                for own, texts in chunks(known, b.column("text").to_pylist()):
                    rows += [(*own[i], index.ids[item], w, n, d, sim) for i, w, n, item, d, sim in index.matches(texts)]
                cols = list(zip(*rows)) or [()] * 7
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(cols, types)],
                                                 names=["doc_id", "th", "item_id", "first_word", "n_words", "bits", "similarity"])

        own = stream_texts(docs, id_col, text_col, batch, schema, ["__th"])
        found = own if found is None else found.union(own)
    if found is None:
        return spark.createDataFrame([], schema)
    best = F.min(F.struct((-F.col("similarity")).alias("_s"), "first_word", "n_words", "bits")).alias("w")
    return (found.groupBy("doc_id", "th", "item_id").agg(best)
            .select("doc_id", "th", "item_id", "w.first_word", "w.n_words", "w.bits", (-F.col("w._s")).alias("similarity")))


def mark_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: (doc_id, contaminated, item_ids, similarity).

    Each row is judged by its own text, also where rows share an id or have
    none; null and empty texts hold nothing; equal rows are marked alike; an empty
    table gives no rows.
    """
    leaks = saved(leak_matches(docs, items, id_col=id_col, text_col=text_col, **options), "leaks")
    per = small(saved(leaks.groupBy("doc_id", "th").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"),
                                                        F.max("similarity").alias("similarity")), "leaks-of-documents"))
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), row_hash(text_col).alias("th")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d.th") == F.col("p.th"))
    return (own.join(per.alias("p"), same, "left")
            .select("d.doc_id", F.col("item_ids").isNotNull().alias("contaminated"),
                    F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"), "similarity"))


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text holds no passage of the benchmark, all
    columns. Rows that share an id (or have none) go or stay by their own texts;
    null and empty texts stay; repeated rows are treated alike."""
    leaks = leak_matches(docs, items, id_col=id_col, text_col=text_col, **options)
    return without(docs, leaks, id_col, text_col)
