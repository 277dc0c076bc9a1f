"""SimHash near-duplicates with vantage-point trees (operator 1).

Fingerprints: every word shingle votes with the bits of its XXH64. Distinct
fingerprints (not documents) are then searched for pairs within a Hamming
radius:

* a tree of vantage points, fitted on a bounded sample, splits the
  fingerprints into shards by their distance to each vantage point. By the
  triangle inequality a pair within the radius is either on one side of a
  split, or its inner member lies in the ring of ``radius`` distances at the
  boundary; only those ring members are copied to the outer side, so every
  pair meets in a shard;
* in a shard the same splits go on down to small leaves, which are compared
  in full, and the shard reports its links as a spanning forest, never as all
  pairs;
* the links of all shards are joined by distributed union-find.

Every fingerprint goes through the trees, only their fit is on a sample:
pairs are exact, whatever the sample.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_hash, saved, stream_texts, without
from .components import components
from .tokens import chunks
from .words import Texts

#: Fingerprints that a shard should hold, leaves compared in full, and the most
#: leaves of one tree; its fit uses SAMPLE_PER_LEAF fingerprints per leaf.
SHARD_SIZE = 20_000
LEAF_SIZE = 192
TREE_LEAVES = 1024
SAMPLE_PER_LEAF = 48


def fingerprints(texts: list[bytes], shingle: int = 3, seed: int = 42) -> np.ndarray:
    """SimHash of each text (A-Z lower-cased): uint64; 0 for a text without words.

    A bit is set if over half of the shingles' hashes have it. A text of
    fewer words is one shingle of all its words.
    """
    out = np.zeros(len(texts), np.uint64)
    t = Texts(texts, lower=True)
    # the words again, one space apart, so that a shingle is a slice
    data = t.data.tobytes()
    first = t.first.tolist()
    h: list[int] = []
    rows: list[int] = []
    digest = xxhash.xxh64_intdigest
    for i in range(len(texts)):
        a, b = first[i], first[i + 1]
        if a == b:
            continue
        start, end = t.start[a:b], t.end[a:b]
        if (start[1:] - end[:-1] == 1).all():
            own = data[start[0]:end[-1]].translate(_ONE_SPACE)
            start, end = (start - start[0]).tolist(), (end - start[0]).tolist()
        else:
            words = data[start[0]:end[-1]].split()
            own = b" ".join(words)
            size = np.fromiter(map(len, words), np.int64, len(words)) + 1
            end = np.cumsum(size) - 1
            start, end = (end - size + 1).tolist(), end.tolist()
        if b - a < shingle:
            h.append(digest(own, seed))
            rows.append(1)
        else:
            h += [digest(own[s:e], seed) for s, e in zip(start, end[shingle - 1:])]
            rows.append(b - a - shingle + 1)
    with_words = np.flatnonzero(np.diff(t.first))
    if len(with_words):
        bits = np.unpackbits(np.array(h, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        n = np.array(rows)
        votes = np.add.reduceat(bits, np.concatenate(([0], np.cumsum(n)[:-1])), axis=0, dtype=np.int64)
        out[with_words] = np.packbits(2 * votes > n[:, None], axis=1).view(">u8").ravel()
    return out


_ONE_SPACE = bytes(0x20 if i in (0x20, *range(0x09, 0x0E)) else i for i in range(256))


def fingerprint_table(docs: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """(doc_id, th, fp): the text's hash, and the fingerprint as a signed long.
    Null texts have no words."""
    def batch(batches):
        for b in batches:
            fps = [fingerprints(texts, shingle, seed)
                   for _, texts in chunks([None] * b.num_rows, b.column("text").to_pylist(), 1_000_000)]
            fp = np.concatenate([*fps, np.zeros(0, np.uint64)])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), pa.array(fp.view(np.int64))],
                                             names=["doc_id", "th", "fp"])

    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), row_hash(text_col).alias("th"))
    return stream_texts(own, "doc_id", "text", batch, "doc_id long, th long, fp long", ["th"])


def _split(fp: np.ndarray, radius: int, rng: np.random.Generator) -> tuple[np.uint64, int]:
    """A vantage point and the distance that splits best: few copies, even sides."""
    best = (2.0, np.uint64(0), 0)
    for v in fp[rng.integers(0, len(fp), 5)]:
        n = np.bincount(np.bitwise_count(fp ^ v), minlength=65)
        inner = np.cumsum(n)
        ring = inner - np.concatenate((np.zeros(radius, np.int64), inner[:-radius])) if radius else np.zeros(65, np.int64)
        outer = len(fp) - inner + ring  # with its copies
        cost = np.maximum(inner, outer) / len(fp) + ring / len(fp)
        mu = int(np.argmin(cost))
        if cost[mu] < best[0]:
            best = (float(cost[mu]), v, mu)
    return best[1], best[2]


def _sides(fp: np.ndarray, v: np.uint64, mu: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows on the inner side, and on the outer side with the ring's copies."""
    d = np.bitwise_count(fp ^ v).astype(np.int64)
    return np.flatnonzero(d <= mu), np.flatnonzero(d > mu - radius)


def fit_tree(sample: np.ndarray, leaves: int, radius: int, seed: int = 7) -> list:
    """A nested list [vantage point, distance, inner, outer]; None is a leaf."""
    rng = np.random.default_rng(seed)

    def grow(fp: np.ndarray, leaves: int):
        if leaves <= 1 or len(fp) < 8:
            return None
        v, mu = _split(fp, radius, rng)
        a, b = _sides(fp, v, mu, radius)
        if max(len(a), len(b)) > 0.95 * len(fp):
            return None
        share = round(leaves * len(a) / (len(a) + len(b)))
        return [int(v), mu, grow(fp[a], share), grow(fp[b], leaves - share)]

    return grow(sample, leaves)


def route(tree: list, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of every fingerprint; boundary rows have several leaves."""
    rows, leaves = [], []
    count = 0

    def go(node, at):
        nonlocal count
        if node is None:
            rows.append(at)
            leaves.append(np.full(len(at), count, np.int64))
            count += 1
            return
        a, b = _sides(fp[at], np.uint64(node[0]), node[1], radius)
        go(node[2], at[a])
        go(node[3], at[b])

    go(tree, np.arange(len(fp)))
    return np.concatenate(rows), np.concatenate(leaves)


class _Forest:
    """Union-find over row numbers, by arrays of links at a time."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root[a], self.root[b]
            k = ra != rb
            if not k.any():
                return
            a, b, ra, rb = a[k], b[k], ra[k], rb[k]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:  # flatten
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def link_shard(fp: np.ndarray, radius: int, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs within ``radius``: rows and their roots."""
    forest = _Forest(len(fp))
    rng = np.random.default_rng(seed)
    ends: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    stack = [np.arange(len(fp))]
    while stack:
        at = stack.pop()
        if len(at) < 2:
            continue
        own = fp[at]
        if len(at) > LEAF_SIZE:
            v, mu = _split(own, radius, rng)
            a, b = _sides(own, v, mu, radius)
            if max(len(a), len(b)) < 0.95 * len(at):
                stack += [at[a], at[b]]
                continue
        step = max(1, 2_000_000 // len(at))
        for i in range(0, len(at), step):
            x, y = np.nonzero(np.bitwise_count(own[i:i + step, None] ^ own[None, i:]) <= radius)
            k = y > x
            if k.any():
                ends.append((at[i + x[k]], at[i + y[k]]))
                held += int(k.sum())
        if held > 1_000_000:
            forest.link(*(np.concatenate(c) for c in zip(*ends)))
            ends, held = [], 0
    if ends:
        forest.link(*(np.concatenate(c) for c in zip(*ends)))
    child = np.flatnonzero(forest.root != np.arange(len(fp)))
    return child, forest.root[child]


def near_links(distinct: DataFrame, radius: int, shard_size: int = SHARD_SIZE) -> DataFrame:
    """Links (a, b) that connect all fingerprints within ``radius`` of each other.

    ``distinct`` is a saved table of distinct ``fp``.
    """
    spark = distinct.sparkSession
    n = distinct.count()
    shards = math.ceil(n / shard_size)
    trees = []
    if shards > 1:
        levels = math.ceil(math.log(shards) / math.log(TREE_LEAVES)) if shards > TREE_LEAVES else 1
        leaves = math.ceil(shards ** (1 / levels))
        size = SAMPLE_PER_LEAF * leaves  # bounded by SAMPLE_PER_LEAF * TREE_LEAVES
        # the fingerprints with the smallest hashes: the same sample on every run
        for level in range(levels):
            got = (distinct.select("fp", F.xxhash64("fp", F.lit(level)).alias("_h")).where(
                F.pmod("_h", F.lit(max(1, n // (2 * size)))) == 0).orderBy("_h").limit(size).collect())
            trees.append(fit_tree(np.array([r[0] for r in got], np.int64).view(np.uint64), leaves, radius, seed=level))
    table = spark.sparkContext.broadcast(trees)

    def deal(batches):
        for b in batches:
            fp = b.column("fp").to_numpy().view(np.uint64)
            shard = np.zeros(len(fp), np.int64)
            for tree in table.value:
                rows, leaf = route(tree, fp, radius)
                fp, shard = fp[rows], shard[rows] * 4 * TREE_LEAVES + leaf
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(fp.view(np.int64))], names=["shard", "fp"])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = np.unique(pdf["fp"].to_numpy().view(np.uint64))
        child, root = link_shard(fp, radius)
        return pd.DataFrame({"a": fp[child].view(np.int64), "b": fp[root].view(np.int64)})

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
    dealt = distinct.select("fp").mapInArrow(deal, "shard long, fp long")
    return dealt.groupBy("shard").applyInPandas(solve, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, seed: int = 42,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, fp, component_id) of every row; component_id is the smallest
    doc_id reachable over fingerprints at most ``radius`` bits apart.

    Texts without words (null, empty, white space) have fingerprint zero and
    link like any other; rows with equal texts, or a repeated doc_id, are
    rows of their own; a null doc_id is never chosen as component_id unless
    its component has no other; an empty table gives an empty result.
    """
    rows = saved(fingerprint_table(docs, shingle, seed, id_col, text_col), "simhash-rows")
    distinct = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    parts = saved(components(saved(near_links(distinct, radius), "simhash-links")), "simhash-parts")
    # components of more than one fingerprint; all others stand alone
    joined = distinct.join(parts, F.col("fp") == F.col("node"))
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    grouped = parts.join(least, "root").select(F.col("node").alias("fp"), "component_id")
    ids = distinct.join(grouped, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return rows.join(ids, "fp").select("doc_id", "th", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2, seed: int = 42, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row
    with the smallest (doc_id, text hash) stays, null ids last; all columns."""
    rows = saved(near_duplicates(docs, shingle, radius, seed, id_col, text_col), "simhash-parts")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")
    least = rows.groupBy("component_id").agg(F.min(order).alias("m"), F.count(F.lit(1)).alias("c")).where("c > 1")
    gone = (rows.alias("r").join(least.alias("l"), F.col("r.component_id").eqNullSafe(F.col("l.component_id")))
            .where(~(F.col("r.doc_id").eqNullSafe(F.col("l.m.doc_id")) & (F.col("r.th") == F.col("l.m.th"))))
            .select("r.doc_id", "r.th"))
    kept = without(docs, gone, id_col, text_col)
    if rows.groupBy("doc_id", "th").count().where("count > 1").isEmpty():
        return kept
    # rows that repeat an id and a text: one of them
    return kept.withColumn("__th", row_hash(text_col)).dropDuplicates([id_col, "__th"]).drop("__th")
