"""Best-fit packing of documents into fixed-length sequences (operator 5).

Bin packing needs only how many pieces of each length there are: at most
``max_len`` numbers, whatever the corpus. The driver plans on that histogram
(Martello-Toth dominance first, best-fit decreasing for the rest) and gets
runs of equal sequences; the pieces then take their places in the runs by
their rank among the pieces of their length, computed by Spark.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, stream_texts
from .tokens import chunks, encoder


def _fix_dominant(counts: list[int], cap: int) -> list[tuple[int, list[int]]]:
    """Remove item sets that dominate every alternative; returns (n, lengths) runs.

    For the largest item of length x, every other set of items that could
    share its bin can be exchanged for the chosen one without using more bins:

    * nothing fits beside it: it stays alone;
    * an item of length cap - x exists: the pair fills the bin;
    * only one more item fits (the two smallest do not): the largest that fits;
    * only two more fit, and the largest single fit is at least as long as the
      longest pair that fits: that single item.

    The scan goes down from the largest length and stops being repeated when
    a pass fixes nothing.
    """
    fixed: list[tuple[int, list[int]]] = []

    def smallest(k: int) -> list[int]:
        out: list[int] = []
        for w in range(1, cap + 1):
            out += [w] * min(counts[w], k - len(out))
            if len(out) == k:
                break
        return out

    def largest_fit(x: int, room: int) -> int:
        for w in range(room, 0, -1):
            if counts[w] - (w == x) > 0:
                return w
        return 0

    def longest_pair(x: int, room: int) -> int:
        have = [w for w in range(1, room) if counts[w] - (w == x) > 0]
        best, i, j = 0, 0, len(have) - 1
        while i <= j:
            total = have[i] + have[j]
            if total > room:
                j -= 1
            else:
                if i != j or counts[have[i]] - (have[i] == x) > 1:
                    best = max(best, total)
                i += 1
        return best

    changed = True
    while changed:
        changed = False
        for x in range(cap, 0, -1):
            while counts[x]:
                room = cap - x
                small = smallest(3)
                if not room or small[0] > room or (counts[x] == 1 and len(small) == 1):
                    n, mates = counts[x], []
                elif room == x and counts[x] > 1:
                    n, mates = counts[x] // 2, [x]
                elif room != x and counts[room]:
                    n, mates = min(counts[x], counts[room]), [room]
                else:
                    mate = largest_fit(x, room)
                    if not mate:
                        break
                    if len(small) > 1 and small[0] + small[1] <= room and (
                            len(small) == 3 and sum(small) <= room or longest_pair(x, room) > mate):
                        break
                    n, mates = (counts[x] // 2 if mate == x else min(counts[x], counts[mate])), [mate]
                if not n:
                    break
                fixed.append((n, [x, *mates]))
                for w in (x, *mates):
                    counts[w] -= n
                changed = True
    return fixed


def _best_fit(counts: list[int], cap: int) -> list[tuple[int, list[int]]]:
    """Best-fit decreasing, all items of one length at once.

    Open bins are kept as runs of equal bins: by free room, [count, lengths].
    """
    done: list[tuple[int, list[int]]] = []
    rooms: list[int] = []  # sorted free rooms that have open runs
    runs: dict[int, list[list]] = {}

    def put(room: int, n: int, lengths: list[int]) -> None:
        if not room:
            done.append((n, lengths))
            return
        if room not in runs:
            runs[room] = []
            insort(rooms, room)
        runs[room].append([n, lengths])

    for x in range(cap, 0, -1):
        left = counts[x]
        while left:
            i = bisect_left(rooms, x)
            if i < len(rooms):  # the fullest bins that still take the item
                room = rooms[i]
                run = runs[room][-1]
                n = min(left, run[0])
                run[0] -= n
                if not run[0]:
                    runs[room].pop()
                    if not runs[room]:
                        del runs[room]
                        rooms.pop(i)
                put(room - x, n, [*run[1], x])
                left -= n
            else:  # new bins; a bin takes as many of these items as fit
                k = cap // x
                if left >= k:
                    n = left // k
                    put(cap - k * x, n, [x] * k)
                    left -= n * k
                else:
                    put(cap - left * x, 1, [x] * left)
                    left = 0
    return done + [(n, lengths) for room in rooms for n, lengths in runs[room]]


def plan_packing(histogram: dict[int, int], cap: int) -> list[tuple[int, list[int]]]:
    """Runs (number of equal sequences, lengths in each) that hold all pieces."""
    if any(not 1 <= w <= cap for w in histogram):
        raise ValueError(f"piece lengths must lie in 1..{cap}")
    counts = [0] * (cap + 1)
    for w, n in histogram.items():
        counts[w] += n
    return _fix_dominant(counts, cap) + _best_fit(counts, cap)


def place_table(runs: list[tuple[int, list[int]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first rank of each place in a run (ascending), the run's first
    sequence id, the offset in the sequence."""
    used: dict[int, int] = {}
    places: dict[int, list[tuple[int, int, int]]] = {}
    base = 0
    for n, lengths in runs:
        offset = 0
        for w in lengths:
            places.setdefault(w, []).append((used.get(w, 0), base, offset))
            used[w] = used.get(w, 0) + n
            offset += w
        base += n
    return {w: tuple(np.array(c, np.int64) for c in zip(*rows)) for w, rows in places.items()}


def pack_pieces(pieces: DataFrame, max_len: int) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a saved table with ``length`` and ``_part``.

    ``_part`` numbers bounded groups of rows (the task that made them); ranks
    inside a length are the rank inside (part, length) plus the counts of the
    parts before, so a length that many pieces share has no task of its own.
    """
    spark = pieces.sparkSession
    per = pieces.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n"))
    per = saved(per, "pack-counts")
    histogram = {r[0]: r[1] for r in per.groupBy("length").agg(F.sum("_n")).collect()}  # at most max_len rows
    table = spark.sparkContext.broadcast(place_table(plan_packing(histogram, max_len)))
    upto = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = per.select("_part", "length", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_part", "length").orderBy("doc_id", "piece")
    ranked = (pieces.withColumn("_rank", F.row_number().over(within) - 1)
              .join(before, ["_part", "length"])
              .withColumn("_rank", (F.col("_rank") + F.col("_before")).cast("long")))
    cols = [c for c in pieces.columns if c != "_part"]
    kept = [f for f in pieces.schema.fields if f.name in cols]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", sequence_id long, offset long"

    def place(batches):
        for b in batches:
            length = b.column("length").to_numpy()
            rank = b.column("_rank").to_numpy()
            seq = np.empty(len(length), np.int64)
            off = np.empty(len(length), np.int64)
            for w in np.unique(length):
                at = np.flatnonzero(length == w)
                first, base, offset = table.value[int(w)]
                i = np.searchsorted(first, rank[at], side="right") - 1
                seq[at] = base[i] + rank[at] - first[i]
                off[at] = offset[i]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in cols] + [pa.array(seq), pa.array(off)],
                                             names=[*cols, "sequence_id", "offset"])

    return ranked.select(*cols, "_rank").mapInArrow(place, schema)


def token_pieces(docs: DataFrame, tokenizer: str, max_len: int, end_id: int,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, _part), saved.

    A document's ids are its text's ids, then ``end_id``; only documents of
    more than ``max_len`` ids are cut, into pieces of ``max_len``.
    """
    def cut(batches):
        enc = encoder(tokenizer)
        part = TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for ids, texts in chunks(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                for doc_id, code in zip(ids, enc.encode(texts)):
                    code += end
                    for k in range(0, len(code), 4 * max_len):
                        own = code[k:k + 4 * max_len]
                        for c, v in zip(out, (doc_id, k // (4 * max_len), k // 4, len(own) // 4, zlib.crc32(own))):
                            c.append(v)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)]
                                             + [pa.array([part] * len(out[0]), pa.int32())],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "_part"])

    return saved(stream_texts(docs, id_col, text_col, cut,
                              "doc_id long, piece int, start long, length long, ids_crc32 long, _part int"), "pack-pieces")


def pack_documents(docs: DataFrame, tokenizer: str, max_len: int = 2048, end_id: int = 0,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents into as few sequences of at most ``max_len`` ids as
    dominance and best fit find.

    Null and empty texts are one piece that holds the end id alone; rows that
    repeat a doc_id or a text are packed like any other; an empty table gives
    an empty result; other columns of ``docs`` are ignored.
    """
    return pack_pieces(token_pieces(docs, tokenizer, max_len, end_id, id_col, text_col), max_len)
