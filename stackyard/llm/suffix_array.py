"""Exact removal of repeated byte strings with suffix arrays (operator 2).

Every byte covered by a string of ``length`` bytes that also starts anywhere
else in the corpus is removed. :mod:`segments` brings the texts in which
that can happen together by content; each shard then builds a suffix array:

* suffixes are classified as S or L, and the leftmost S ones (LMS) found;
* the LMS substrings are sorted by induction and named; if names repeat, the
  LMS suffixes are ranked on the string of names, a third of the text or less,
  by doubling the compared length (names have no small alphabet, so the
  bucket-wise induction does not pay there);
* the whole array is induced from them, L suffixes left to right, then S
  suffixes right to left, a bucket's entries at a time;
* common prefixes are computed in text order: where the byte before differs
  from the one before the neighbour by direct comparison, elsewhere one less
  than the value before (permuted LCP, Karkkainen, Manzini, Puglisi 2009).

A window repeats if its common prefix with a neighbour in the array has
``length`` bytes, or its segment stands for several equal ones.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import merge_intervals, saved, small, small_batches
from .segments import (distinct_segments, exact_hash, per_document, prefix_hash, runs_of, shared_segments,
                       solve_hot, solve_shards, with_texts)
from .words import _VALUES

LENGTH = 400
#: Bytes of the grams whose smallest hash is a window's key.
GRAM = 32
#: Bytes of one shard's text.
SHARD_BYTES = 1_500_000


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (S); the last is S."""
    n = len(t)
    differs = np.append(t[:-1] != t[1:], True)
    nearest = np.where(differs, np.arange(n), n)
    nearest = np.minimum.accumulate(nearest[::-1])[::-1]
    less = np.append(t[:-1] < t[1:], True)
    return less[nearest]


def _induce(t: np.ndarray, s_type: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    """Suffix array from LMS suffixes in the wanted order."""
    n = len(t)
    count = np.bincount(t, minlength=size)
    end = np.cumsum(count)
    begin = end - count
    sa = np.full(n, -1, np.int64)
    of = t[lms]
    at_bucket = np.bincount(of, minlength=size)
    # each bucket's LMS suffixes at its end, in the given order
    order = np.argsort(of, kind="stable")
    first = np.cumsum(at_bucket) - at_bucket
    sa[(end - at_bucket)[of[order]] + np.arange(len(lms)) - first[of[order]]] = lms[order]

    def place(found: np.ndarray, chars: np.ndarray, point: np.ndarray, up: bool) -> None:
        order = np.argsort(chars.astype(np.uint16), kind="stable")
        chars, found = chars[order], found[order]
        k = np.bincount(chars, minlength=size)
        inside = np.arange(len(chars)) - (np.cumsum(k) - k)[chars]
        if up:
            sa[point[chars] + inside] = found
            point += k
        else:
            sa[point[chars] - 1 - inside] = found
            point -= k

    point = begin.copy()
    for c in range(size):  # L suffixes, smallest bucket first
        if not count[c]:
            continue
        done = begin[c]
        while done < point[c]:
            now = sa[done:point[c]]
            done = point[c]
            before = now[now > 0] - 1
            before = before[~s_type[before]]
            place(before, t[before], point, True)
        before = sa[end[c] - at_bucket[c]:end[c]]
        before = before[before > 0] - 1
        before = before[~s_type[before]]
        place(before, t[before], point, True)
    # the LMS entries are placed anew by the second scan
    top = end.copy()
    for c in range(size - 1, -1, -1):  # S suffixes, largest bucket first, right to left
        if not count[c]:
            continue
        done = end[c]
        while done > top[c]:
            now = sa[top[c]:done][::-1]
            done = top[c]
            before = now[now > 0] - 1
            before = before[s_type[before]]
            place(before, t[before], top, False)
        before = sa[begin[c]:point[c]][::-1]
        before = before[before > 0] - 1
        before = before[s_type[before]]
        place(before, t[before], top, False)
    return sa


def _rank_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names, by doubling."""
    n = len(names)
    rank = names.astype(np.int64)
    h = 1
    while True:
        second = np.zeros(n, np.int64)
        if h < n:
            second[:-h] = rank[h:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        new = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        h *= 2


def suffix_array(t: np.ndarray, size: int) -> np.ndarray:
    """Suffix array of ``t`` (values below ``size``; the last one is 0 and nowhere else)."""
    if len(t) == 1:
        return np.zeros(1, np.int64)
    s_type = _types(t)
    lms = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1
    # sort LMS substrings: induce from the LMS suffixes in text order
    sa = _induce(t, s_type, lms, size)
    is_lms = np.zeros(len(t), bool)
    is_lms[lms] = True
    by_substring = sa[is_lms[sa]]
    # name them: equal substrings have the same length and bytes
    number = np.empty(len(t), np.int64)
    number[lms] = np.arange(len(lms))
    end = np.append(lms[1:] + 1, len(t))
    i = number[by_substring]
    content = exact_hash(_VALUES_ALL[t])(lms, end)
    same = (content[i][1:] == content[i][:-1]) & ((end - lms)[i][1:] == (end - lms)[i][:-1])
    name = np.concatenate(([0], np.cumsum(~same)))
    names = np.empty(len(lms), np.int64)
    names[i] = name
    order = i if name[-1] == len(lms) - 1 else _rank_names(names)
    return _induce(t, s_type, lms[order], size)


_VALUES_ALL = np.concatenate((_VALUES, _VALUES[:2] ^ np.uint64(0x5DEECE66D0B1A2C3)))


def permuted_lcp(t: np.ndarray, sa: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(plcp, phi): the common prefix of each suffix with the one before it in
    the array, at most ``room``; and that suffix (-1 for the first)."""
    n = len(t)
    phi = np.empty(n, np.int64)
    phi[sa[0]] = -1
    phi[sa[1:]] = sa[:-1]
    direct = np.ones(n, bool)
    direct[1:] = (phi[1:] <= 0) | (t[:-1] != t[phi[1:] - 1]) | (room[:-1] == 0)
    at = np.flatnonzero(direct & (phi >= 0))
    length = np.zeros(n, np.int64)
    # eight symbols at a time (two words of four)
    w = np.zeros(n + 8, np.uint64)
    w[:n] = t
    w = w[:-1] | (w[1:] << np.uint64(16))
    w = w[:-2] | (w[2:] << np.uint64(32))
    a, b = at, phi[at]
    most = np.minimum(room[a], room[b])
    done = np.zeros(len(at), np.int64)
    live = np.arange(len(at))
    while len(live):
        x = w[a[live] + done[live]] ^ w[b[live] + done[live]]
        same = x == 0
        low = x & (~x + np.uint64(1))
        done[live] += np.where(same, 4, np.bitwise_count(low - np.uint64(1)).astype(np.int64) // 16)
        live = live[same & (done[live] < most[live])]
    length[at] = np.minimum(done, most)
    # elsewhere one less than at the position before
    last = np.maximum.accumulate(np.where(direct, np.arange(n), 0))
    return np.maximum(length[last] - (np.arange(n) - last), 0), phi


def repeated_windows(bodies: list[bytes], copies: np.ndarray, length: int) -> list[np.ndarray]:
    """For each body, which of its windows occur anywhere else."""
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
    start = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    raw = np.frombuffer(b"\0".join(bodies) + b"\0\0", np.uint8)
    t = raw.astype(np.int64) + 2
    t[start + sizes] = 1  # between bodies
    t[-1] = 0
    room = np.zeros(len(t), np.int64)
    own = np.repeat(np.arange(len(bodies)), sizes + 1)
    room[:len(own)] = (start + sizes)[own] - np.arange(len(own))
    sa = suffix_array(t, 258)
    plcp, phi = permuted_lcp(t, sa, room)
    twice = plcp >= length
    twice[phi[np.flatnonzero(twice)]] = True
    return [twice[s:s + n - length + 1] | (c > 1) for s, n, c in zip(start.tolist(), sizes.tolist(), copies.tolist())]


def _units(texts: list[bytes]):
    data = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
    n = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.concatenate(([0], np.cumsum(n + 1)[:-1]))
    values = _VALUES[data]
    if len(data) < GRAM:
        return values, first, first + n, np.zeros(0, np.uint64)
    at = np.arange(len(data) - GRAM + 1)
    return values, first, first + n, prefix_hash(values)(at, at + GRAM)


def repeated_ranges(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, th, first, windows): the runs of windows that occur elsewhere too."""
    shared = shared_segments(docs, _units, length, GRAM)
    distinct = distinct_segments(shared, shard_bytes, length - 1)

    def cut(text, starts, counts):
        return [text[s:s + n + length - 1] for s, n in zip(starts, counts)]

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        flags = repeated_windows(pdf["body"].tolist(), pdf["copies"].to_numpy(), length)
        for key, content, n, f in zip(pdf["key"], pdf["content"], pdf["n"], flags):
            rows += [(key, content, n, a, k) for a, k in zip(*runs_of(f))]
        return pd.DataFrame(rows, columns=["key", "content", "n", "first", "windows"])

    def again(each: DataFrame) -> DataFrame:
        twice = saved(each.groupBy("key", "h").agg(F.sum("copies").alias("c")).where("c > 1").select("key", "h"), "windows-twice")
        return each.join(small(twice), ["key", "h"])

    found = solve_shards(with_texts(distinct.where("solve and not hot"), docs, cut, shard_bytes, length - 1), solve)
    hot = distinct.where("hot")
    if not hot.isEmpty():
        found = found.union(solve_hot(with_texts(hot, docs, cut, shard_bytes, length - 1), _units, length, again))
    # equal segments whose key has no other: every window occurs in each of them
    alone = (distinct.where("not solve and copies > 1").select("key", "content", "n", F.lit(0).alias("first"), F.col("n").alias("windows")))
    places = shared.select("doc_id", "th", "start", "key", "content", "n")
    return (places.join(found.union(alone), ["key", "content", "n"])
            .select("doc_id", "th", (F.col("start") + F.col("first")).alias("first"), "windows"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                   keep_text: bool = False, **options) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) of every row.

    Strings are judged on the input, in any document or the same one, also
    overlapping; matches never cross documents. Null texts are empty. Two
    rows with the same id and text are two documents: all their strings of
    ``length`` bytes repeat. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    ranges = repeated_ranges(docs, length, **options)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if keep_text else "")

    def finish(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(6)]
            for doc_id, text, at in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "at"))):
                first = np.array([x["first"] for x in at or []], np.int64)
                n = np.array([x["windows"] for x in at or []], np.int64)
                a, e = merge_intervals(first, first + n + length - 1)
                kept = text
                if len(a):
                    kept = b"".join(text[i:j] for i, j in zip([0, *e.tolist()], [*a.tolist(), len(text)]))
                for c, v in zip(out, (doc_id, len(text), len(text) - len(kept), len(a), hashlib.sha256(kept).hexdigest(), kept)):
                    c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            names = [c.split()[0] for c in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in list(zip(out, kinds))[:len(names)]], names=names)

    return per_document(docs, ranges, finish, schema)
