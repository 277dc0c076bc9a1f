"""Property tests: invariants that must hold for any input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stackyard.operators import blend as BL
from stackyard.operators import encode as E
from stackyard.operators import folds as FO
from stackyard.operators import metrics as ME
from stackyard.operators.ordering import row_index

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.sampled_from(["a", "b", "c", "dd", "e"]), min_size=1, max_size=40))
def test_label_encoding_is_a_bijection(spark, values):
    d = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, s string")
    codes = E.fit_sorted_codes(d, "s")
    table = {r["s"]: r["code"] for r in codes.table.collect()}
    assert sorted(table.values()) == list(range(len(set(values))))
    assert [k for k, _ in sorted(table.items(), key=lambda kv: kv[1])] == sorted(set(values))


@SETTINGS
@given(st.lists(st.integers(0, 2), min_size=3, max_size=60), st.integers(2, 5))
def test_folds_partition_rows_and_balance_classes(spark, ys, k):
    d = spark.createDataFrame([(i, y) for i, y in enumerate(ys)], "id long, y int")
    f = FO.stratified_kfold(d, "y", k).collect()
    assert len(f) == len(ys)
    for y in set(ys):
        sizes = [sum(1 for r in f if r["y"] == y and r["fold"] == j) for j in range(k)]
        assert max(sizes) - min(sizes) <= 1


@SETTINGS
@given(st.lists(st.integers(1, 8), min_size=2, max_size=50))
def test_kappa_of_identical_ratings_is_one(spark, ys):
    d = spark.createDataFrame([(y, float(y)) for y in ys], "y int, p double")
    k = ME.kappa(d, "y", "p").first()[0]
    assert abs(k - 1.0) < 1e-9


@SETTINGS
@given(st.lists(st.tuples(*[st.floats(0, 1) for _ in range(5)]), min_size=1, max_size=30))
def test_blend_within_row_range(spark, rows):
    cols = ["a", "b", "c", "d", "e"]
    d = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols))
    out = d.select(*cols, BL.weak_blend(cols, 4, 2).alias("w")).collect()
    for r in out:
        vals = [r[c] for c in cols]
        assert min(vals) - 1e-12 <= r["w"] <= max(vals) + 1e-12


@SETTINGS
@given(st.integers(1, 300), st.integers(1, 9))
def test_row_index_invariant_to_partitioning(spark, n, parts):
    d = spark.range(0, n).withColumn("g", F.col("id") % 3).repartition(parts)
    got = {r["id"]: r["pos"] for r in row_index(d, ["id"], name="pos").collect()}
    assert got == {i: i for i in range(n)}
    byg = row_index(d, ["id"], by=["g"], name="pos").collect()
    assert all(r["pos"] == r["id"] // 3 for r in byg)


def test_folds_do_not_depend_on_shuffle_partitions(spark):
    """Fold numbers are a function of the data only: re-running with another
    number of ranges (as after a restart on a different cluster) agrees."""
    d = spark.range(0, 500).withColumn("y", (F.col("id") % 3 == 0).cast("int"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = {r["id"]: r["fold"] for r in FO.stratified_kfold(d, "y", 4).collect()}
        spark.conf.set("spark.sql.shuffle.partitions", "11")
        b = {r["id"]: r["fold"] for r in FO.stratified_kfold(d, "y", 4).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b
