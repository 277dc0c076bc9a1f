"""Moments of many columns, ranks, selection, text ranges, leave-fold-out encoders, CSV rules."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stackyard.operators import assoc as AS
from stackyard.operators import encode as E
from stackyard.operators import folds as FO
from stackyard.operators import moments as MM
from stackyard.operators.ordering import row_index, running
from stackyard.sources.tables import read_csv_table

NAN = float("nan")


@pytest.fixture(scope="module")
def holed(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 6)) * [1, 10, 1e-3, 1, 1, 0] + [0, 1e7, 0, 5, 0, 3.25]
    x[:, 4] = x[:, 0] * 2 + rng.normal(size=300)
    x[rng.random((300, 6)) < 0.2] = np.nan
    x[:, 3][::7] = np.nan
    rows = [(i, *[None if np.isnan(v) and i % 2 else float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, e double, f double").persist(), x


def test_moments_equal_pairwise_complete_numpy(spark, holed):
    d, x = holed
    cols = list("abcdef")
    m = MM.pair_moments(d, cols)
    r = m.correlations()
    for i in range(6):
        for j in range(6):
            ok = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            assert m.n[i, j] == ok.sum()
            if i == 5 or j == 5:  # a constant column has no correlation
                assert np.isnan(r[i, j])
            else:
                assert r[i, j] == pytest.approx(np.corrcoef(x[ok, i], x[ok, j])[0, 1], abs=1e-9)
    assert m.missing().tolist() == np.isnan(x).sum(axis=0).tolist()


def test_blocks_of_columns_give_the_same_moments(spark, holed, monkeypatch):
    d, _ = holed
    whole = MM.pair_moments(d, list("abcde"))
    monkeypatch.setattr(MM, "BLOCK", 2)
    cut = MM.pair_moments(d, list("abcde"))
    for f in ("n", "total", "square", "product"):
        assert np.allclose(getattr(whole, f), getattr(cut, f))


def test_pairs_from_moments_equal_those_from_aggregates(spark, holed, monkeypatch):
    d, _ = holed
    d = d.select(*[F.when(F.isnan(c), None).otherwise(F.col(c)).alias(c) for c in "abcde"])
    cols = list("abcde")
    calls = [lambda: AS.pearson(d, cols), lambda: AS.column_pairs_long(d, cols), lambda: AS.null_pattern_pairs(d, cols)]
    want = [{(r[0], r[1]): r[2] for r in c().collect()} for c in calls]
    monkeypatch.setattr(AS, "PAIR_BATCH", 3)
    for c, w in zip(calls, want):
        assert {(r[0], r[1]): r[2] for r in c().collect()} == pytest.approx(w)


def test_empty_table_has_no_moments(spark, holed):
    d, _ = holed
    m = MM.pair_moments(d.limit(0), ["a", "b"])
    assert m.rows == 0 and np.isnan(m.correlations()).all()
    assert MM.sums_of_products(d.limit(0), ["a"]) == {("a", "a"): 0.0}


def _ranks(v):
    order = sorted(v)
    return [(order.index(x) + len(order) - order[::-1].index(x) + 1) / 2 for x in v]


def test_spearman_with_different_nulls_and_ties(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(400):
        a, b, c = rnd.randint(0, 9), rnd.gauss(0, 1), rnd.randint(0, 300)
        rows.append((i, float(a) if i % 5 else None, b if i % 3 else None, float(c), float(a + c) if i % 5 else None))
    d = spark.createDataFrame(rows, "id long, a double, b double, c double, e double")
    pairs = [("a", "b"), ("a", "c"), ("b", "c"), ("a", "e"), ("b", "e")]
    got = {(r["col_a"], r["col_b"]): r["rho"] for r in AS.spearman(d, pairs).collect()}
    at = {"a": 1, "b": 2, "c": 3, "e": 4}
    for x, y in pairs:
        both = [(r[at[x]], r[at[y]]) for r in rows if r[at[x]] is not None and r[at[y]] is not None]
        want = np.corrcoef(_ranks([p for p, _ in both]), _ranks([q for _, q in both]))[0, 1]
        assert got[x, y] == pytest.approx(want), (x, y)


def test_columns_of_one_null_pattern_share_their_ranks(spark):
    d = spark.createDataFrame([(1, None, None, 1.0, None), (2, 1.0, 2.0, None, 3.0), (3, 2.0, 1.0, 2.0, None)], "id long, a double, b double, c double, e double")
    p = AS._null_patterns(d, ["a", "b", "c", "e", "id"])
    assert p["a"] == p["b"] and len({p["a"], p["c"], p["e"]}) == 3 and p["id"] is None


def test_incomplete_beta_against_integration(spark):
    cases = [(0.3, 2.0, 5.0), (0.9, 40.0, 0.5), (0.999, 5000.0, 0.5), (0.5, 0.5, 0.5), (0.02, 1.0, 3.0), (0.99995, 50_000.0, 2.0)]

    def plain(x, a, b):
        t = (np.arange(400_000) + 0.5) / 400_000
        # t = u^(1/a) near 0 and its mirror near 1 are smooth enough here: split at x
        lo, hi = t * x, x + t * (1 - x)
        ln = lambda v: (a - 1) * np.log(v) + (b - 1) * np.log1p(-v)
        top = max(ln(lo).max(), ln(hi).max())
        left, right = np.exp(ln(lo) - top).mean() * x, np.exp(ln(hi) - top).mean() * (1 - x)
        return left / (left + right)

    d = spark.createDataFrame(cases, "x double, a double, b double")
    got = [r[0] for r in d.select(AS.incomplete_beta(F.col("x"), F.col("a"), F.col("b"))).collect()]
    for g, c in zip(got, cases):
        assert g == pytest.approx(plain(*c), abs=3e-3)
    exact = spark.createDataFrame([(0.25, 1.0, 1.0), (0.25, 3.0, 1.0), (0.0, 2.0, 2.0), (1.0, 2.0, 2.0)], "x double, a double, b double")
    got = [r[0] for r in exact.select(AS.incomplete_beta(F.col("x"), F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([0.25, 0.25 ** 3, 0.0, 1.0], abs=1e-12)


def test_selection_ties_by_name_and_all(spark):
    rows = [(i % 2, float(i % 2 + i % 3), float(i % 2 + i % 3), 1.0, float(i % 5)) for i in range(60)]
    d = spark.createDataFrame(rows, "y int, b double, a double, flat double, noise double")
    cols = ["b", "a", "flat", "noise"]
    ranked = {r["name"]: r["rank"] for r in AS.select_features(d, cols, "y", k=1).collect()}
    assert ranked == {"a": 1, "b": 2, "noise": 3, "flat": 4}
    assert AS.selected_columns(d, cols, "y", k=1) == ["a"]
    assert AS.selected_columns(d, cols, "y", k="all") == cols
    assert AS.selected_columns(d, cols, "y", percentile=50) == ["b", "a"]
    assert AS.selected_columns(d, cols, "y", k=4) == ["b", "a", "noise"]  # no F without spread
    with pytest.raises(ValueError):
        AS.select_features(d, cols, "y")


def test_contingency_refuses_too_many_values(spark):
    d = spark.range(0, 40).select(F.col("id").cast("string").alias("a"), (F.col("id") % 3).alias("b"))
    with pytest.raises(ValueError):
        AS.contingency(d, "a", "b", max_values=39)
    assert AS.contingency(d, "a", "b", max_values=40).count() == 40


# ------------------------------------------------------------ order

@pytest.mark.parametrize("values", [[f"Customer#{i:09d}" for i in range(500)], ["same"] * 300, ["", "a", "ä", "zz" * 40, "zz" * 40 + "b", None] * 20])
def test_text_keys_are_numbered_in_order(spark, values):
    rnd = random.Random(1)
    rows = [(i, v) for i, v in enumerate(values)]
    rnd.shuffle(rows)
    d = spark.createDataFrame(rows, "id long, v string").repartition(5)
    got = {r["id"]: r["row_idx"] for r in row_index(d, ["v", "id"]).collect()}
    want = sorted(range(len(values)), key=lambda i: (values[i] is not None, (values[i] or "").encode(), i))
    assert [got[i] for i in want] == list(range(len(values)))


def test_text_ranges_are_not_capped(spark):
    from stackyard.operators.ordering import _with_range_id
    d = spark.range(0, 20_000).select(F.format_string("Customer#%09d", "id").alias("v"))
    assert _with_range_id(d, F.col("v"), 1000).select("__rid").distinct().count() > 600


def test_dates_are_numbered_in_order(spark):
    d = spark.range(0, 300).select(F.expr("date_add(date'2020-01-01', cast((id * 37) % 300 as int))").alias("day"))
    got = [r["day"] for r in row_index(d, ["day"]).orderBy("row_idx").collect()]
    assert got == sorted(got)


def test_running_sums_and_previous_value(spark):
    rnd = random.Random(6)
    rows = [(g, float(i) / 7, rnd.randint(0, 9), rnd.randint(0, 9)) for g in (0, 1, 2) for i in range(200)]
    d = spark.createDataFrame(rows, "g int, v double, a long, b long")
    out = {(r["g"], r["v"]): (r["sa"], r["sb"], r["before"]) for r in running(d, "v", {"sa": "a", "sb": "b"}, by=["g"], previous="before").collect()}
    for g in (0, 1, 2):
        a = b = 0
        last = None
        for _, v, x, y in sorted(r for r in rows if r[0] == g):
            assert out[g, v] == (a, b, last)
            a, b, last = a + x, b + y, v


@pytest.mark.parametrize("k", [2, 3])
def test_cut_folds_are_stratified_by_each_cut(spark, k):
    rnd = random.Random(3)
    rows = [(i * 3, rnd.randint(1, 4)) for i in range(101)]
    d = spark.createDataFrame(rows, "id long, y int").repartition(4)
    got = FO.ordinal_cut_folds(d, "y", 4, k).collect()
    for cut in range(1, 4):
        for side in (True, False):
            own = sorted((r["id"], r[f"fold{cut - 1}"]) for r in got if (r["y"] <= cut) == side)
            folds = [f for _, f in own]
            assert folds == sorted(folds)  # contiguous blocks in key order
            sizes = [folds.count(f) for f in range(k)]
            assert max(sizes) - min(sizes) <= 1


# ------------------------------------------------------------ leave-fold-out encoders

ROWS = [(i, ["a", "b", "c", None][i % 4] if i != 41 else "only", i % 3 if i % 5 else None, float((i * 7) % 4 == 0) if i % 5 else None, i % 5 != 0)
        for i in range(60)]


@pytest.fixture(scope="module")
def folded(spark):
    return spark.createDataFrame(ROWS, "id long, c string, fold int, target double, is_train boolean")


def others(row, same):
    """Targets of the train rows of other folds in the row's category."""
    return [t for _, c, f, t, tr in ROWS if tr and same(c) and (row[2] is None or f != row[2])]


def category(c):
    sides = {tr for _, v, _, _, tr in ROWS if v == c}
    return "Missing" if c is None else c if sides == {True, False} else "Orphans"


def test_target_stats_by_fold_leave_the_fold_out(spark, folded):
    got = {r["id"]: (r["c_avg"], r["c_std"]) for r in E.target_stats_by_fold(folded, "c", "fold", min_support=5).collect()}
    for row in ROWS:
        y = others(row, lambda c: category(c) == category(row[1]))
        want = (np.mean(y), np.std(y, ddof=1)) if len(y) >= 5 else (None, None)
        assert got[row[0]] == pytest.approx(want), row


def test_target_weight_by_fold(spark, folded):
    got = {r["id"]: r["cweight"] for r in E.target_weight_by_fold(folded, "c", "fold").collect()}
    for row in ROWS:
        y = others(row, lambda c: c == row[1]) if row[1] is not None else []
        s, n = sum(y), len(y)
        want = 0.5 if not n else 0.5 + 0.5 * s / n if s > n - s else 0.5 + 0.5 * (s - n) / n
        assert got[row[0]] == pytest.approx(want), row


def test_naive_bayes_by_fold_equals_fits_without_the_fold(spark, folded):
    got = {r["id"]: r["c"] for r in E.bernoulli_nb_by_fold(folded, "c", "fold").collect()}
    for f in (0, 1, 2, None):
        rows = folded.where("fold IS NULL") if f is None else folded.where(f"fold = {f} OR (is_train AND fold <> {f})")
        side = rows.withColumn("is_train", F.col("is_train") & (F.lit(True) if f is None else F.col("fold") != f))
        if f is None:
            side = folded
        want = {r["id"]: r["c"] for r in E.bernoulli_nb_encode(side, "c").collect()}
        for row in ROWS:
            if row[2] == f:
                assert got[row[0]] == pytest.approx(want[row[0]]), row


def test_naive_bayes_by_fold_with_one_class_left(spark):
    d = spark.createDataFrame([(1, "a", 0, 1.0, True), (2, "b", 0, 0.0, True), (3, "a", 1, 1.0, True), (4, "a", None, None, False)],
                              "id long, c string, fold int, target double, is_train boolean")
    got = {r["id"]: r["c"] for r in E.bernoulli_nb_by_fold(d, "c", "fold").collect()}
    assert got[1] == got[2] == 1.0  # only fold 1's positive row is left


def test_fold_encoders_above_the_broadcast_limit(spark, folded):
    want = sorted(map(str, E.target_stats_by_fold(folded, "c", "fold", min_support=5).collect()))
    spark.conf.set("stackyard.broadcast.maxRows", "1")
    try:
        assert sorted(map(str, E.target_stats_by_fold(folded, "c", "fold", min_support=5).collect())) == want
    finally:
        spark.conf.unset("stackyard.broadcast.maxRows")


# ------------------------------------------------------------ typed one-hot, CSV rules

@pytest.mark.parametrize("kind, values", [("boolean", [True, False]), ("double", [1e20, 0.0001, 3.0]), ("int", [7, -2]), ("decimal(9,2)", ["1.50", "2.00"]),
                                          ("date", ["2020-01-31", "1999-12-01"]), ("string", ["x", "nan"])])
def test_fitted_one_hot_marks_every_typed_value(spark, kind, values):
    d = spark.createDataFrame([(i, str(v)) for i, v in enumerate(values * 2)], "id long, t string").select("id", F.col("t").cast(kind).alias("c"))
    out = E.binarize(d, "c", E.onehot_fit(d, "c"))
    flags = [c for c in out.columns if c != "id"]
    assert len(flags) == len(values)
    assert all(sum(r[c] for c in flags) == 1 for r in out.collect())
    assert all(sum(r[c] for r in out.collect()) == 2 for c in flags)


def test_csv_rules(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,note,id\n1.5,hi,1\nNaN,,2\nbad,q,3\n")
    path = str(tmp_path / "a.csv")
    got = read_csv_table(spark, path, "id long, x double, other string", index_col="x")
    assert got.columns == ["x", "id", "other"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == [(1.5, 1, None), (None, 2, None), (None, 3, None)]
    with pytest.raises(ValueError):
        read_csv_table(spark, path, "id long, x double", extra="error")
    with pytest.raises(FileNotFoundError):
        read_csv_table(spark, str(tmp_path / "none*.csv"), "id long")
    empty = read_csv_table(spark, str(tmp_path / "none*.csv"), "id long, x double", missing="empty")
    assert empty.count() == 0 and empty.columns == ["id", "x"]


def test_interactions_have_four_columns_each(spark):
    from stackyard.functions.scalar import interactions
    d = spark.createDataFrame([(2.0, 3.0, 5.0, 7.0)], "f double, a double, b double, c double").select(*interactions(["f"], "a", "b", "c"))
    assert d.first().asDict() == {"f_x_a_b": 16.0, "f_x_a_c": 20.0, "f_x_c_b": 24.0, "f_x_a_b_c": 30.0}
    assert math.isclose(d.first()[0], 16.0)
