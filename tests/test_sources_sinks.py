"""Scans and sinks round trips (S1-S12) on data derived from the fixtures."""

import os

from pyspark.sql import functions as F

from stackyard.sources import fixtures as fx
from stackyard.sources import sinks as SK
from stackyard.sources.tables import read_csv_table
from tests.conftest import SF_SMALL


def test_score_sink_and_typed_csv_scan(spark, tmp_path):
    p = fx.predictions(spark, SF_SMALL).where("target IS NULL")
    path = str(tmp_path / "scores")
    SK.write_scores(p, path, "id", "m3")
    back = read_csv_table(spark, path, "ID long, PredictedProb double", index_col="ID")
    assert back.columns == ["ID", "PredictedProb"]
    want = p.select(F.col("id").alias("ID"), F.col("m3").alias("PredictedProb"))
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0


def test_gather_prediction_files_by_key(spark, tmp_path):
    p = fx.predictions(spark, SF_SMALL)
    root = tmp_path / "preds"
    for m in ("m3", "m7", "m11"):
        # each file in a different row order: gathering must align by key
        SK.write_scores(p.orderBy(F.desc(m)).coalesce(1), str(root / m), "id", m)
    wide = SK.gather_predictions(spark, str(root / "*" / "*.csv"), models=["m3", "m7", "m11"])
    want = p.select("id", "m3", "m7", "m11")
    assert wide.exceptAll(want).count() == 0 and want.exceptAll(wide).count() == 0


def test_materialise_and_column_groups(spark, tmp_path):
    d = fx.claims(spark, SF_SMALL)
    m = SK.materialise(d, str(tmp_path / "feat"), partition_by=["is_train"])
    assert m.count() == d.count()
    assign = spark.createDataFrame([("a", "g1"), ("b", "g1"), ("c", "g2"), ("d", None)], "name string, g string")
    groups = SK.column_groups(assign, "g", "name")
    SK.write_column_groups(groups, str(tmp_path / "groups"))
    assert SK.read_column_groups(spark, str(tmp_path / "groups")) == {"g1": ["a", "b"], "g2": ["c"]}


def test_feature_map_stamp_report(spark, tmp_path):
    fm = SK.feature_map(spark, ["x", "y"])
    SK.write_feature_map(fm, str(tmp_path / "fmap"))
    lines = sorted(r[0] for r in spark.read.text(str(tmp_path / "fmap")).collect())
    assert lines == ["0\tx\tq", "1\ty\tq"]
    p = fx.predictions(spark, SF_SMALL).select("id", F.col("m3").alias("pred"))
    SK.write_stamped(SK.stamp(p, "run1", 0.45), str(tmp_path / "runs"))
    SK.write_stamped(SK.stamp(p, "run2", 0.46), str(tmp_path / "runs"))
    runs = spark.read.parquet(str(tmp_path / "runs"))
    assert runs.select("run_id").distinct().count() == 2
    SK.write_report(p, str(tmp_path / "report"))
    assert os.path.isdir(str(tmp_path / "report"))


def test_template_fill_keeps_unmatched_rows(spark):
    t = spark.createDataFrame([(1, 0.0), (2, 0.0), (3, 0.0)], "id long, Response double")
    p = spark.createDataFrame([(2, 5.0)], "id long, pred double")
    got = {r["id"]: r["Response"] for r in SK.fill_template(t, p, "id", "Response").collect()}
    assert got == {1: 0.0, 2: 5.0, 3: 0.0}


def test_gathered_models_are_one_grouping(spark):
    long = spark.createDataFrame([(1, "m3", 0.5), (1, "m7", 0.25), (2, "m3", 0.125), (None, "m7", 1.0), (2, "m9", 9.0)],
                                 "id long, model string, pred double")
    wide = SK.pivot_predictions(long, ["m3", "m7"])
    assert wide.columns == ["id", "m3", "m7"]
    assert {tuple(r) for r in wide.collect()} == {(1, 0.5, 0.25), (2, 0.125, None), (None, None, 1.0)}
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_gathered_file_names_need_no_pattern(spark, tmp_path):
    p = spark.createDataFrame([(1, 0.5)], "id long, pred double")
    SK.write_scores(p, str(tmp_path / "m3"))
    (tmp_path / "flat").mkdir()
    (tmp_path / "flat" / "m7.csv").write_text("ID,PredictedProb\n1,0.25\n")
    for path, model in ((tmp_path / "*", "m3"), (tmp_path / "flat" / "*.csv", "m7")):
        wide = SK.gather_predictions(spark, str(path), models=[model])
        assert (1, 0.5 if model == "m3" else 0.25) in {tuple(r) for r in wide.collect()}
