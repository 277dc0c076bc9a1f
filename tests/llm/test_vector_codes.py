"""Vector codes against a full search in Python integers."""

import hashlib
import math

import duckdb
import numpy as np
import pytest

from stackyard.llm import queries
from stackyard.llm import vector_codes as V

SF = "/root/testdata/sf0.001"


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """rows: (vec_id, vector, label), vectors of one length -> {vec_id: (code, error, label_error, sha)}."""
    kept = [(i, [math.floor(4096 * x) for x in v], g) for i, v, g in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return {}
    w = len(kept[0][1]) // parts
    cut = [[v[p * w:(p + 1) * w] for _, v, _ in kept] for p in range(parts)]
    books = [[list(x) for x in c[:entries]] for c in cut]

    def nearest(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for x in cut[p]:
                groups.setdefault(nearest(books[p], x)[1], []).append(x)
            for k, xs in groups.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[nearest(books[p], cut[p][i]) for p in range(parts)] for i in range(len(kept))]
    errors = [min(sum(d for d, _ in f), V.LONG_MAX) for f in found]
    total = {}
    for (_, _, g), e in zip(kept, errors):
        total[g] = total.get(g, 0) + e
    return sorted(((i, "".join(f"{k:02x}" for _, k in f), e, min(total[g], V.LONG_MAX), sha) for (i, _, g), f, e in zip(kept, found, errors)), key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_whole_table(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert rows_of(queries.op11_vector_codes(spark, SF)) == plain_codes(table)


def test_sql_twin(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = sorted(con.execute(queries.SQL["op11_vector_codes"]).fetchall(), key=str)
    assert rows_of(queries.op11_vector_codes(spark, SF)) == want


NAN, INF = float("nan"), float("inf")


def coded(spark, rows, **kw):
    schema = "vec_id long, embedding array<double>, label int, code string, v int"
    df = spark.createDataFrame([(i, v, g, "clash", 1) for i, v, g in rows], schema)
    out, books = V.compress_vectors(df, **kw)
    return sorted(((*r, books.digest()) for r in out.drop("label").collect()), key=str)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(size=16).tolist(), int(i) % 3 if i % 5 else None) for i in rng.permutation(60)]
    rows += [(61, None, 1), (62, [None] + [0.0] * 15, 1), (63, [NAN] * 16, 2), (64, [INF] + [1.0] * 15, 2), (None, [0.25] * 16, 0)]
    rows += [rows[0]] * 20 + [(65, [0.0] * 16, None)] * 3  # repeats
    rows += [(66, [1e5] + [-1e5] * 15, 7), (67, [2e8] * 16, 7)]  # beyond 32 bits, and beyond the fast kind
    assert coded(spark, rows) == plain_codes(rows)


def test_fewer_rows_than_entries_and_ties(spark):
    rows = [(1, [0.0] * 8, 0), (2, [2.0] * 8, 0), (3, [1.0] * 8, None), (3, [1.0] * 8, None)]
    assert coded(spark, rows) == plain_codes(rows)


def test_other_lengths_go_and_parts_are_filled_up(spark):
    rows = [(1, [0.5] * 9, 0), (2, [0.25] * 9, 0), (3, [1.0] * 8, 0), (4, [], 1)]
    got = coded(spark, rows)
    assert [r[0] for r in got] == [1, 2]
    assert got == plain_codes([(i, v + [0.0] * 7, g) for i, v, g in rows[:2]])


def test_empty_table_and_empty_vectors(spark):
    assert coded(spark, []) == []
    assert coded(spark, [(1, None, 0)]) == []
    assert [r[1:4] for r in coded(spark, [(1, [], 0), (2, [], 0)])] == [("00" * 8, 0, 0)] * 2


def test_huge_errors_end_at_the_greatest_long(spark):
    got = coded(spark, [(i, [(-1.0) ** i * 1e300] * 8, 0) for i in range(40)], entries=1)
    assert {r[2] for r in got} == {V.LONG_MAX} and {r[3] for r in got} == {V.LONG_MAX}


def test_partitions_do_not_matter(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    one, books = V.compress_vectors(df.coalesce(1))
    many, again = V.compress_vectors(df.repartition(9))
    assert books.books == again.books and rows_of(one) == rows_of(many)


@pytest.mark.parametrize("spread", [3, 40, 3000])
def test_grid_finds_the_nearest_entry(spread):
    rng = np.random.default_rng(spread)
    book = rng.integers(-spread, spread, (16, 5))
    part = np.concatenate([rng.integers(-spread, spread, (500, 5)), book, book[:4]])
    memo = V.GridMemo(book)
    for _ in range(2):
        entry, dist = memo.nearest(part)
        full = ((part[:, None] - book[None]) ** 2).sum(axis=2)
        assert (entry == full.argmin(axis=1)).all() and (dist == full.min(axis=1)).all()
    cells = len(memo.memo)
    memo.nearest(part)
    assert len(memo.memo) == cells  # known cells are not worked out again


def test_cells_that_share_a_hash_are_kept_apart(monkeypatch):
    monkeypatch.setattr(V, "cell_hashes", lambda cells: np.zeros(len(cells), np.uint64))
    rng = np.random.default_rng(9)
    book, part = rng.integers(-900, 900, (16, 4)), rng.integers(-900, 900, (300, 4))
    full = ((part[:, None] - book[None]) ** 2).sum(axis=2)
    assert (V.GridMemo(book).nearest(part)[0] == full.argmin(axis=1)).all()


def test_dominated_entries_are_not_evaluated():
    book = np.array([[0, 0], [10, 0], [5000, 5000], [5010, 5000]])
    memo = V.GridMemo(book)
    part = np.random.default_rng(2).integers(0, 20, (1000, 2))
    memo.nearest(part)
    assert memo.evaluated == 2 * len(part)
