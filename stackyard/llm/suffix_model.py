"""Language-model scoring with a probabilistic suffix tree (operator 7).

The model predicts a text byte by byte: its words in lower case, one space
apart, then an end mark. A context of up to ``depth`` bytes is a state of the
tree if it occurs at least ``min_count`` times in training and its next-byte
distribution diverges from its parent's (the context without its oldest byte)
by more than its size explains. A state's distribution is smoothed with its
parent's, down to the uniform one, and every position is scored by the longest
suffix of its past that is a state.

The tree is a partitioned table and never on the driver; all counts are
absolute, so a larger corpus keeps more contexts, and no result depends on how
rows are dealt to tasks:

A  one pass over all texts. A unit (consecutive rows of a task, ``UNIT`` bytes)
   gives its distinct grams (``depth`` bytes and the next one) with their
   training counts (0: only in held-out texts), its words and its normal texts;
B  level by level, the counts of (context, next byte) are joined with the
   parent's probabilities; sums over a context (at most 256 rows) test its
   divergence. A row holds the probability under the longest state, so the last
   level holds that of every gram of the corpus, seen in training or not;
C  a unit's distinct grams fetch their probabilities by a join, go back to the
   unit in packs, and its texts are scored behind them in a sorted stream.

The baseline's most frequent words (at most ``FREQUENT``) are broadcast, other
words are joined.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BATCH_ROWS, Saved, release, stream_texts
from .tokens import chunks
from .words import Texts

DEPTH = 6  # at most 6: a gram is a positive long
#: Contexts seen less often in training are no states.
MIN_COUNT = 4
#: Strength of the parent in a state's smoothed distribution, for each byte
#: that has followed the state (Witten-Bell).
SMOOTHING = 2.0
#: A state's divergence, in nats over all its positions, per byte it predicts.
DIVERGENCE = 2.0
FREQUENT = 1 << 17
#: Bytes of texts that share their grams' way to the model, and the distinct
#: grams after which a unit ends before that; bytes counted or scored at once.
UNIT = 16_000_000
UNIT_GRAMS = 1_500_000
BLOCK = 2_000_000
#: Grams that a task packs together on their way back to their units.
PACK = 1 << 20
END = 0x0A  # never inside a word


def normal(text: bytes) -> bytes:
    return b" ".join(text.translate(_LOWER).split())


_LOWER = bytes(b + 32 if ord("A") <= b <= ord("Z") else b for b in range(256))


def in_training(doc_id: int | None) -> bool:
    """All rows but those whose crc32 (of the id as text; null: empty) leaves 2 by 7."""
    return zlib.crc32(str(doc_id).encode() if doc_id is not None else b"") % 7 != 2


def _blocks(texts: list[bytes], depth: int):
    """Pieces of at most BLOCK bytes, together some BLOCK bytes: their texts'
    numbers and the pieces. A piece's first ``depth`` bytes are context only,
    end marks before a text's start."""
    of, pieces, held = [], [], 0
    for i, t in enumerate(texts):
        full = b"".join((bytes([END]) * depth, t, bytes([END])))
        for a in range(0, len(full) - depth, BLOCK):
            of.append(i)
            pieces.append(full[a:a + BLOCK + depth])
            held += len(pieces[-1])
            if held >= BLOCK:
                yield of, pieces
                of, pieces, held = [], [], 0
    if pieces:
        yield of, pieces


def _grams(pieces: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram of every predicted position (newest context byte highest, next
    byte lowest), and the number of positions of each piece."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    start = np.cumsum(size) - size
    own = np.ones(len(data), bool)
    own[(start[:, None] + np.arange(depth)).ravel()] = False
    key = data[depth:].astype(np.int64)
    for j in range(1, depth + 1):
        key |= data[depth - j:len(data) - j].astype(np.int64) << (8 * (depth + 1 - j))
    return key[own[depth:]], size - depth


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts."""
    key = np.concatenate([k for k, _ in parts])
    n = np.concatenate([m for _, m in parts])
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else []
    return key[new], np.add.reduceat(n, new) if len(key) else n


def _counted(of: list[int], pieces: list[bytes], train: list[bool], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of the pieces and how often training texts hold them."""
    key, size = _grams(pieces, depth)
    flag = np.repeat(np.array([train[i] for i in of], np.int64), size)
    both, n = np.unique((key << 1) | flag, return_counts=True)
    return _merge([(both >> 1, np.where(both & 1, n, 0))])


_GRAM, _TEXT, _WORD, _TEXTS = 0, 1, 2, 3
_UNIT_SCHEMA = pa.schema([("unit", pa.int64()), ("kind", pa.int32()), ("key", pa.int64()), ("n", pa.int64()),
                          ("doc_id", pa.int64()), ("text", pa.binary())])


def _unit_rows(unit: int, kind: int, key, n=None, ids=None, texts=None) -> pa.RecordBatch:
    m = len(key)
    cols = [np.full(m, unit), np.full(m, kind, np.int32), key, n, ids, texts]
    return pa.RecordBatch.from_arrays([pa.nulls(m, f.type) if c is None else pa.array(c, f.type)
                                       for c, f in zip(cols, _UNIT_SCHEMA)], schema=_UNIT_SCHEMA)


def read_units(docs: DataFrame, depth: int) -> Saved:
    """Pass A: (unit, kind, key, n, doc_id, text) of the grams of a unit, its
    normal texts (key: a number for each row), training words and texts."""
    def batch(batches):
        part = TaskContext.get().partitionId() << 40
        unit, row, held, parts, words = part, part, 0, [], []
        for b in batches:
            for ids, texts in chunks(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), BLOCK):
                texts = [normal(t) for t in texts]
                train = [in_training(i) for i in ids]
                yield _unit_rows(unit, _TEXT, np.arange(row, row + len(ids)), ids=ids, texts=texts)
                row += len(ids)
                own = [t for t, yes in zip(texts, train) if yes]
                word, n = np.unique(Texts(own).hashes().view(np.int64), return_counts=True)
                words.append((word, n))
                if sum(len(k) for k, _ in words) > UNIT_GRAMS:
                    words = [_merge(words)]
                yield _unit_rows(unit, _TEXTS, [0], [len(own)])
                for of, pieces in _blocks(texts, depth):
                    parts.append(_counted(of, pieces, train, depth))
                    if sum(len(k) for k, _ in parts) > UNIT_GRAMS:
                        parts = [_merge(parts)]
                held += sum(map(len, texts)) + len(texts)
                if held >= UNIT or (parts and len(parts[0][0]) > UNIT_GRAMS):
                    yield _unit_rows(unit, _GRAM, *_merge(parts))
                    yield _unit_rows(unit, _WORD, *_merge(words))
                    unit, held, parts, words = unit + 1, 0, [], []
        if parts:
            yield _unit_rows(unit, _GRAM, *_merge(parts))
            yield _unit_rows(unit, _WORD, *_merge(words))

    schema = "unit long, kind int, key long, n long, doc_id long, text binary"
    return Saved(stream_texts(docs, "doc_id", "text", batch, schema), "lm-units", "zstd")


def suffix_tree(grams: DataFrame, depth: int, divergence: float = DIVERGENCE, smoothing: float = SMOOTHING,
                min_count: int = MIN_COUNT) -> list[Saved]:
    """Pass B: for each length 0 .. ``depth``, (context, next, p, state) of every
    context of the grams (key, n). ``p`` is the next byte's probability under
    the longest state that ends the context, ``state`` whether that is itself."""
    spark = grams.sparkSession
    following = F.col("key").bitwiseAND(F.lit(255)).cast("int").alias("next")
    counts = {depth: grams.select(F.shiftright("key", 8).alias("context"), following, "n")}
    tables = {}
    for k in range(depth - 1, -1, -1):
        shorter = (counts[k + 1].groupBy(F.shiftright("context", 8).alias("context"), "next").agg(F.sum("n").alias("n")))
        tables[k] = Saved(shorter, "lm-counts")
        counts[k] = tables[k].df
    total = counts[0].agg(F.sum("n")).first()[0] or 0
    p = (F.col("n") + 1 / 257) / (total + 1.0)
    levels = [Saved(counts[0].select("context", "next", p.alias("p"), F.lit(True).alias("state")), "lm-level")]
    # in the order of the next byte: a sum of doubles then has one result only
    whole = Window.partitionBy("context").orderBy("next").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    for k in range(1, depth + 1):
        parent = levels[-1].df.select(F.col("context").alias("parent"), "next", F.col("p").alias("q"))
        n = F.col("n")
        rows = counts[k].withColumn("parent", F.shiftright("context", 8)).join(parent, ["parent", "next"]).withColumns(
            {"total": F.sum("n").over(whole), "types": F.sum((n > 0).cast("int")).over(whole)})
        rows = rows.withColumn("gain", F.sum(F.when(n > 0, n * F.log(n / F.col("total") / F.col("q"))).otherwise(0.0)).over(whole))
        weight = F.col("types") * smoothing
        state = (F.col("total") >= min_count) & (F.col("gain") > F.col("types") * divergence)
        p = F.when(state, (n + weight * F.col("q")) / (F.col("total") + weight)).otherwise(F.col("q"))
        levels.append(Saved(rows.select("context", "next", p.alias("p"), state.alias("state")), "lm-level"))
        release(spark, *[tables.pop(j) for j in list(tables) if j <= k])
    return levels


def pack_grams(batches):
    """Rows (unit, key, logp) as packs of one unit: differences of its ascending
    keys, then their values, compressed; ``doc_id`` has their number."""
    def packs(parts):
        unit, key, logp = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((key, unit))
        unit, key, logp = unit[order], key[order], logp[order]
        cut = np.append(np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1]))), len(unit))
        blobs = [pa.compress(np.diff(key[a:e], prepend=0).tobytes() + logp[a:e].tobytes(), codec="zstd", asbytes=True)
                 for a, e in zip(cut[:-1], cut[1:])]
        m = len(blobs)
        return pa.RecordBatch.from_arrays([pa.array(unit[cut[:-1]]), pa.array(np.full(m, _GRAM, np.int32)), pa.array(np.zeros(m, np.int64)),
                                           pa.array(np.diff(cut)), pa.array(blobs, pa.binary())],
                                          names=["unit", "kind", "key", "doc_id", "text"])

    parts, held = [], 0
    for b in batches:
        if b.num_rows:
            parts.append([b.column(c).to_numpy().copy() for c in ("unit", "key", "logp")])
            held += b.num_rows
        if held >= PACK:
            yield packs(parts)
            parts, held = [], 0
    if parts:
        yield packs(parts)


def _unpacked(n: list[int], blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All keys of packs, ascending, and their values."""
    raw = [pa.decompress(b, decompressed_size=12 * m, codec="zstd", asbytes=True) for m, b in zip(n, blobs)]
    key = np.concatenate([np.cumsum(np.frombuffer(r, np.int64, m)) for m, r in zip(n, raw)])
    logp = np.concatenate([np.frombuffer(r, np.float32, m, 8 * m) for m, r in zip(n, raw)])
    order = np.argsort(key)
    return key[order], logp[order]


def _summed(key: np.ndarray, logp: np.ndarray, texts: list[bytes], depth: int) -> np.ndarray:
    """log10 probability of each text by its unit's grams (ascending) and theirs."""
    out = np.zeros(len(texts))
    for of, pieces in _blocks(texts, depth):
        gram, size = _grams(pieces, depth)
        at = np.minimum(np.searchsorted(key, gram), len(key) - 1)
        if not np.array_equal(key[at], gram):
            raise ValueError("a unit's grams are incomplete")
        np.add.at(out, of, np.add.reduceat(logp[at].astype(np.float64), np.cumsum(size) - size))
    return out


def score_documents(docs: DataFrame, depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text",
                    **options) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Rows are held out by the crc32 of their id (:func:`in_training`). Null
    and empty texts are the end mark alone. Repeated rows count, and are
    scored, each. Without training rows the counts are zero and all
    distributions uniform; an empty table gives an empty result. ``options``
    are those of :func:`suffix_tree`.
    """
    if not 1 <= depth <= 6:
        raise ValueError("depth must be 1 to 6")
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    units = read_units(docs, depth)
    of_kind = lambda kind: units.df.where(F.col("kind") == kind)
    grams = Saved(of_kind(_GRAM).groupBy("key").agg(F.sum("n").alias("n")), "lm-grams")
    release(spark)
    levels = suffix_tree(grams.df, depth, **options)
    release(spark, grams, *levels[:-1])

    words = Saved(of_kind(_WORD).groupBy("key").agg(F.sum("n").alias("n")), "lm-words").df
    n_texts = of_kind(_TEXTS).agg(F.sum("n")).first()[0] or 0
    # words by the power of two of their count: at most 64 rows
    sizes = {r[0]: (r[1], r[2]) for r in words.groupBy(F.floor(F.log2("n")).cast("int").alias("e"))
             .agg(F.count(F.lit(1)), F.sum("n")).collect()}
    n_tokens = sum(n for _, n in sizes.values()) + n_texts
    n_types = sum(c for c, _ in sizes.values()) + (n_texts > 0)
    least, held = 64, 0
    for e in sorted(sizes, reverse=True):
        held += sizes[e][0]
        if held > FREQUENT:
            break
        least = e
    common = words.where(F.col("n") >= (1 << least) if least < 63 else F.lit(False)).toArrow()
    order = np.argsort(common.column("key").to_numpy().view(np.uint64))
    frequent = (common.column("key").to_numpy().view(np.uint64)[order], common.column("n").to_numpy()[order])
    sent = spark.sparkContext.broadcast((frequent, n_texts))
    schema = ("row long, doc_id long, held_out boolean, n_tokens long, known long, part double, score double, "
              "rare array<long>, times array<int>")

    def scored_rows(row, ids, texts, key, logp):
        (word, n), n_texts = sent.value
        score = _summed(key, logp, texts, depth)
        t = Texts(texts)
        h = t.hashes()
        at = np.minimum(np.searchsorted(word, h), max(len(word) - 1, 0))
        hit = word[at] == h if len(word) else np.zeros(len(h), bool)
        known = np.bincount(t.text_of[hit], minlength=len(ids)) + (n_texts > 0)
        part = np.bincount(t.text_of[hit], weights=np.log10(n[at[hit]] + 1.0), minlength=len(ids))
        part = part + np.log10(n_texts + 1.0)
        rest, of = h[~hit], t.text_of[~hit]
        order = np.lexsort((rest, of))
        rest, of = rest[order], of[order]
        new = np.flatnonzero(np.concatenate(([True], (rest[1:] != rest[:-1]) | (of[1:] != of[:-1])))) if len(rest) else []
        times = np.diff(np.append(new, len(rest))).astype(np.int32)
        rest, of = rest[new].view(np.int64) if len(rest) else rest.view(np.int64), of[new] if len(of) else of
        cut = np.searchsorted(of, np.arange(len(ids) + 1)).astype(np.int32)
        arrays = [pa.ListArray.from_arrays(pa.array(cut), pa.array(x)) for x in (rest, times)]
        held_out = [not in_training(i) for i in ids]
        names = [c.split()[0] for c in schema.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(ids, pa.int64()), pa.array(held_out),
                                           pa.array(t.n_words + 1, pa.int64()), pa.array(known, pa.int64()), pa.array(part),
                                           pa.array(score), *arrays], names=names)

    def score_units(batches):
        unit, sizes, blobs, model = None, [], [], None
        for b in batches:
            of, kind = b.column("unit").to_numpy(), b.column("kind").to_numpy()
            cut = np.flatnonzero(np.concatenate(([True], (of[1:] != of[:-1]) | (kind[1:] != kind[:-1]), [True])))
            for a, e in zip(cut[:-1], cut[1:]):
                if of[a] != unit:
                    unit, sizes, blobs, model = of[a], [], [], None
                rows = b.slice(a, e - a)
                ids, texts = rows.column("doc_id").to_pylist(), rows.column("text").to_pylist()
                if kind[a] == _GRAM:
                    sizes += ids
                    blobs += texts
                    continue
                if model is None:
                    model, sizes, blobs = _unpacked(sizes, blobs), [], []
                numbers, at = rows.column("key").to_pylist(), 0
                for own, part in chunks(ids, texts, BLOCK):
                    yield scored_rows(numbers[at:at + len(own)], own, part, *model)
                    at += len(own)

    last = levels[-1].df.select(F.shiftleft("context", 8).bitwiseOR(F.col("next").cast("long")).alias("key"), F.log10("p").cast("float").alias("logp"))
    fetched = of_kind(_GRAM).select("unit", "key").join(last, "key")
    packs = Saved(fetched.select("unit", "key", "logp").mapInArrow(pack_grams, "unit long, kind int, key long, doc_id long, text binary"),
                  "lm-packs")
    release(spark, levels[-1])  # and the join's shuffle, before the texts move
    rows = (packs.df.union(of_kind(_TEXT).select("unit", "kind", "key", "doc_id", "text"))
            .repartition("unit").sortWithinPartitions("unit", "kind", "key"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(4 * BATCH_ROWS))
    scored = Saved(rows.mapInArrow(score_units, schema), "lm-scores").df
    release(spark, units, packs)
    rare = (scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w"))
            .select("row", F.col("w.rare").alias("key"), F.col("w.times").alias("times")).join(words, "key")
            .groupBy("row").agg(F.sum("times").alias("known2"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("part2")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    base = F.col("part") + zero("part2") - F.col("n_tokens") * float(np.log10(n_tokens + n_types + 1))
    return scored.join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + zero("known2")).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
