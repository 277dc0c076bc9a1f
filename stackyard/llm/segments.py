"""Windows of a fixed length, dealt out by content.

Two operators look for windows (400 bytes, 20 words) that occur more than
once anywhere. Equal windows meet without comparing all pairs of documents:

* a window's key is the smallest hash of the k-grams in it, so equal windows
  have equal keys, wherever they are;
* neighbouring windows share a key most of the time; a run of them is one
  segment (first window, number of windows, key, hash of its whole text);
* a key whose gram is at one place of the corpus only has no equal windows,
  and its segments are done;
* equal segments of a key are one, with a count, before anything is moved by
  key: a passage that many documents share costs one row for each task;
* what is left, different segments that share a key, goes with its text to
  the shard of the key, where the operator's own index finds equal windows;
* a key whose different segments are larger than a shard is split by content:
  its windows are keyed by a hash of their whole text, so that no task holds
  all segments of a key, however many.

A document is known by its id and the XXH64 of its text. Runs of more than
``MAX_RUN`` windows (periodic text) are cut, so a segment's size is bounded.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, saved, stream_texts
from .tokens import chunks
from .words import powers

MAX_RUN = 4096


def prefix_hash(values: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Hashes of slices (start, end) of a sequence of 64-bit values."""
    up, down = powers(len(values) + 1)
    c = np.zeros(len(values) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(values * up[:len(values)], out=c[1:])

    def of(start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((c[end] - c[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))

    return of


#: Two primes below 2**31 and a base for each: products of two residues fit 64 bits.
_PRIMES = ((2147483647, 1103515245), (2147483629, 362436069))
_residues: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _residue_powers(p: int, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo p for i < n (at least), kept between calls."""
    def grown(have: np.ndarray, b: int) -> np.ndarray:
        while len(have) < n:
            have = np.concatenate([have, have * np.uint64(pow(b, len(have), p)) % np.uint64(p)])
        return have

    up, down = _residues.get(p, (np.ones(1, np.uint64), np.ones(1, np.uint64)))
    if len(up) < n:
        _residues[p] = up, down = grown(up, base), grown(down, pow(base, -1, p))
    return up, down


def exact_hash(values: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Hashes of slices (start, end) for deciding equality: polynomials modulo
    two primes. Modulo a power of two (as :func:`prefix_hash`) some regular
    sequences have equal hashes whatever the base."""
    parts = []
    for (p, base), v in zip(_PRIMES, (values >> np.uint64(33), values & np.uint64(0x7FFFFFFF))):
        up, down = _residue_powers(p, base, len(values) + 1)
        c = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(v * up[:len(values)] % np.uint64(p), out=c[1:])
        parts.append((np.uint64(p), c, down))

    def of(start: np.ndarray, end: np.ndarray) -> np.ndarray:
        a, b = ((c[end] - c[start]) % p * down[start] % p for p, c, down in parts)
        return mix((a << np.uint64(32) | b) ^ mix((end - start).astype(np.uint64)))

    return of


def sliding_min(g: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values."""
    m, size = g, 1
    while 2 * size <= w:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    return np.minimum(m[:len(g) - w + 1], m[w - size:w - size + len(g) - w + 1]) if size < w else m


def find_segments(grams: np.ndarray, w: int, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, key, grams at the key) of the runs of valid windows.

    ``grams`` has the hash of the k-gram at each place, a window has ``w`` of
    them, ``valid`` says which windows lie in one text.
    """
    empty = np.zeros(0, np.int64)
    if len(grams) < w or not valid.any():
        return empty, empty, empty.astype(np.uint64), empty
    m = sliding_min(grams, w)
    valid = valid[:len(m)]
    new = np.ones(len(m), bool)
    new[1:] = (m[1:] != m[:-1]) | ~valid[:-1]
    start = np.flatnonzero(new & valid)
    stop = np.append(np.flatnonzero(~valid | new), len(m))
    end = stop[np.searchsorted(stop, start, side="right")]
    size = end - start
    if (size > MAX_RUN).any():
        parts = -(-size // MAX_RUN)
        at = np.arange(parts.sum()) - np.repeat(np.concatenate(([0], np.cumsum(parts)[:-1])), parts)
        start, size = np.repeat(start, parts) + at * MAX_RUN, np.minimum(MAX_RUN, np.repeat(size, parts) - at * MAX_RUN)
    key = m[start]
    # places of the key's gram: those in the first window, then those that enter
    enters = np.zeros(len(m) + 1, np.int64)
    np.cumsum(grams[w - 1:w - 1 + len(m)] == m, out=enters[1:])
    n = enters[start + size] - enters[start + 1]
    step = max(1, 4_000_000 // w)
    windows = np.lib.stride_tricks.sliding_window_view(grams, w)
    for i in range(0, len(start), step):
        s = start[i:i + step]
        n[i:i + step] += (windows[s] == key[i:i + step, None]).sum(axis=1)
    return start, size, key, n


SEGMENT_SCHEMA = "doc_id long, th long, start long, n int, key long, content long, places int"
#: Bits of the map of shared keys: 16 MB whatever the corpus.
MAP_BITS = 1 << 27


def segment_table(docs: DataFrame, units: Callable, w: int, k: int, may_share: Broadcast | None = None) -> DataFrame:
    """The segments of all texts.

    ``units(texts)`` gives (values, first and last unit of each text, gram
    hashes) of texts laid out one after another; a window is ``w`` units. With
    ``may_share`` (a bit map of keys) only segments whose key may be in it.
    """
    names = [c.split()[0] for c in SEGMENT_SCHEMA.split(", ")]

    def batch(batches):
        for b in batches:
            for ids, texts in chunks(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                values, first, last, grams = units(texts)
                valid = np.zeros(max(0, len(values) - w + 1) + 1, np.int8)
                room = np.maximum(last - first - w + 1, 0)
                own = np.flatnonzero(room)
                valid[first[own]] += 1
                np.add.at(valid, first[own] + room[own], -1)
                valid = np.cumsum(valid[:-1], dtype=np.int8) > 0
                start, n, key, places = find_segments(grams, w - k + 1, valid)
                if may_share is not None:
                    keep = _in_map(may_share.value, key)
                    start, n, key, places = start[keep], n[keep], key[keep], places[keep]
                # the first reading only counts keys
                content = np.zeros(len(start), np.uint64) if may_share is None else exact_hash(values)(start, start + n + w - 1)
                text = np.searchsorted(first, start, side="right") - 1
                th = np.array([xxhash.xxh64_intdigest(t, 42) for t in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()).take(pa.array(text)), pa.array(th[text]), pa.array(start - first[text]),
                     pa.array(n.astype(np.int32)), pa.array(key.view(np.int64)), pa.array(content.view(np.int64)),
                     pa.array(np.minimum(places, 2).astype(np.int32))], names=names)

    return stream_texts(docs, "doc_id", "text", batch, SEGMENT_SCHEMA)


def _in_map(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    at = (key.view(np.int64) & np.int64(MAP_BITS - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _key_map(keys: DataFrame) -> Broadcast:
    """The bit map of a table of keys, broadcast: its size is fixed, so on a
    large corpus it only lets more keys through to the exact join."""
    at = F.col("key").bitwiseAND(F.lit(MAP_BITS - 1)) + 1
    rows = (keys.select(F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())  # 4 kB each
    bits = np.zeros(MAP_BITS // 8, np.uint8)
    for r in rows:
        own = np.frombuffer(r["bits"], np.uint8)
        bits[(r["bucket"] - 1) * 4096:(r["bucket"] - 1) * 4096 + len(own)] = own
    return keys.sparkSession.sparkContext.broadcast(bits)


def shared_segments(docs: DataFrame, units: Callable, w: int, k: int) -> DataFrame:
    """The segments whose key's gram is at two places or more, saved. The texts
    are read twice; the first time only the keys are counted."""
    keys = saved(segment_table(docs, units, w, k).select("key", "places").groupBy("key")
                 .agg(F.sum("places").alias("c")).where("c > 1").select("key"), "segment-keys")
    return saved(segment_table(docs, units, w, k, _key_map(keys)).join(keys, "key"), "segments-shared")


def distinct_segments(shared: DataFrame, per_shard: int, width: int) -> DataFrame:
    """Equal segments as one, saved: key, content, n, copies, first place, solve, hot.

    ``solve``: the key has other segments, or its gram is twice in this one.
    ``hot``: the key's different segments have more than ``per_shard`` units.
    """
    place = F.min(F.struct("doc_id", "th", "start")).alias("p")
    one = saved(shared.groupBy("key", "content", "n").agg(F.count(F.lit(1)).alias("copies"), F.max("places").alias("places"), place),
                "segments-distinct")
    keys = (one.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.max("places").alias("m"), F.sum(F.col("n") + width).alias("units"))
            .where("c > 1 or m > 1").select("key", (F.col("units") > per_shard).alias("hot")))
    some = one.join(keys.withColumn("solve", F.lit(True)), "key", "left")
    no = F.lit(False)
    return some.select("key", "content", "n", "copies", "p.doc_id", "p.th", "p.start",
                       F.coalesce("solve", no).alias("solve"), F.coalesce("hot", no).alias("hot"))


def with_texts(places: DataFrame, docs: DataFrame, cut: Callable, per_shard: int, width: int) -> DataFrame:
    """(shard, key, content, n, copies, doc_id, th, start, body): the text of each segment.

    Only documents that may have one of the places (by a bit map) are moved to them.
    ``cut(text, starts, counts)`` gives the bodies; ``per_shard`` units make a shard.
    """
    total = places.agg(F.sum(F.col("n") + width)).first()[0] or 0
    shards = max(1, math.ceil(total / per_shard))
    schema = "shard int, key long, content long, n int, copies long, doc_id long, th long, start long, body binary"
    item = F.struct("key", "content", "n", "copies", "start")
    per = saved(places.groupBy("doc_id", "th").agg(F.collect_list(item).alias("items")), "segment-items")
    own = _texts_in(_hashed(docs), _key_map(per.select(F.col("th").alias("key")))).alias("d")
    # merged at any size: whether small lists are broadcast must not decide how the disk grows
    joined = (own.join(per.hint("merge").alias("p"), F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d.th") == F.col("p.th")))
              .select("d.doc_id", "d.th", "d.text", "p.items"))

    def batch(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(9)]
            for doc_id, th, text, items in zip(*(b.column(c).to_pylist() for c in ("doc_id", "th", "text", "items"))):
                bodies = cut(text, [x["start"] for x in items], [x["n"] for x in items])
                for x, body in zip(items, bodies):
                    shard = int(mix(np.array([x["key"]], np.int64).view(np.uint64), 5)[0] % np.uint64(shards))
                    for c, v in zip(out, (shard, x["key"], x["content"], x["n"], x["copies"], doc_id, th, x["start"], body)):
                        c.append(v)
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)],
                                             names=[c.split()[0] for c in schema.split(", ")])

    return joined.mapInArrow(batch, schema).dropDuplicates(["key", "content", "n"])


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", document_hash(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("th"))


def _picked(b: pa.RecordBatch, touched: Broadcast, inside: bool) -> pa.RecordBatch:
    return b.filter(pa.array(_in_map(touched.value, b.column("th").to_numpy()) == inside))


def _texts_in(hashed: DataFrame, touched: Broadcast) -> DataFrame:
    """(doc_id, th, text as bytes) of the documents whose text hash is in the map."""
    def move(batches):
        for b in batches:
            yield _picked(b, touched, True).select(["doc_id", "th", "text"])

    return stream_texts(hashed, "doc_id", "text", move, "doc_id long, th long, text binary", ["th"])


def document_hash(text):
    """XXH64 of a text (seed 42), as the segments' ``th`` has it."""
    return F.xxhash64(text)


FOUND_SCHEMA = "key long, content long, n int, first int, windows int"


def solve_shards(rows: DataFrame, solver: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """Runs of windows that the shard's index reports: a row for each run of
    windows of a segment."""
    return saved(rows.groupBy("shard").applyInPandas(solver, FOUND_SCHEMA), "segments-found")


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return edge[::2], edge[1::2] - edge[::2]


def solve_hot(rows: DataFrame, units: Callable, w: int, repeated: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """As :func:`solve_shards`, for segments (with texts) whose keys are larger than a shard.

    Every window is a row with the hash ``h`` of its text (equal windows have
    equal keys as well); ``repeated`` gets
    (h, key, content, n, copies, doc_id, th, start, at), ``start`` and ``at``
    the window's place in its document and segment, and keeps the windows to
    report. Equal windows are counted in each task before they are moved.
    """
    schema = "h long, key long, content long, n int, copies long, doc_id long, th long, start long, at int"
    names = [c.split()[0] for c in schema.split(", ")]

    def windows(batches):
        for b in batches:
            for i in range(0, b.num_rows, 64):
                own = b.slice(i, 64)
                values, first, _, _ = units(own.column("body").to_pylist())
                n = own.column("n").to_numpy().astype(np.int64)
                of = np.repeat(np.arange(len(n)), n)
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                place = first[of] + at
                cols = {c: own.column(c).take(pa.array(of)) for c in ("key", "content", "n", "copies", "doc_id", "th")}
                cols["h"] = pa.array(exact_hash(values)(place, place + w).view(np.int64))
                cols["start"] = pa.array(own.column("start").to_numpy()[of] + at)
                cols["at"] = pa.array(at.astype(np.int32))
                yield pa.RecordBatch.from_arrays([cols[c] for c in names], names=names)

    def join_up(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(5)]
            for key, content, n, at in zip(*(b.column(c).to_pylist() for c in ("key", "content", "n", "at"))):
                flags = np.zeros(n, bool)
                flags[at] = True
                for first, size in zip(*runs_of(flags)):
                    for c, v in zip(out, (key, content, n, int(first), int(size))):
                        c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)],
                                             names=[c.split()[0] for c in FOUND_SCHEMA.split(", ")])

    each = saved(rows.select("key", "content", "n", "copies", "doc_id", "th", "start", "body").mapInArrow(windows, schema), "segments-windows")
    # a segment has at most MAX_RUN windows
    per = repeated(each).groupBy("key", "content", "n").agg(F.collect_list("at").alias("at"))
    return saved(per.mapInArrow(join_up, FOUND_SCHEMA), "segments-found")


def per_document(docs: DataFrame, ranges: DataFrame, func: Callable, schema: str) -> DataFrame:
    """``func`` over Arrow batches of (doc_id, text, at) with the documents'
    window runs ``at`` (list of first window, windows; null for none).

    Only documents that may have runs (by a bit map of their text hashes) are
    moved to them; the others are finished where they are read.
    """
    per = saved(ranges.groupBy("doc_id", "th").agg(F.collect_list(F.struct("first", "windows")).alias("at")), "segment-ranges")
    touched = _key_map(per.select(F.col("th").alias("key")))
    own = _hashed(docs)
    runs = pa.list_(pa.struct([("first", pa.int64()), ("windows", pa.int64())]))

    def finish(batches):
        for b in batches:
            b = _picked(b, touched, False)
            yield from func([pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"), pa.nulls(b.num_rows, runs)],
                                                        names=["doc_id", "text", "at"])])

    d = _texts_in(own, touched).alias("d")
    joined = d.join(per.hint("merge").alias("r"), F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("d.th") == F.col("r.th")), "left")
    return (joined.select("d.doc_id", "d.text", "r.at").mapInArrow(func, schema)
            .union(stream_texts(own, "doc_id", "text", finish, schema, ["th"])))
