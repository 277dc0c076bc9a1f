"""Sinks (S4-S12): score files, template fill, append logs, materialised
feature tables, column-group metadata, feature maps and gathered
prediction sets. Writers are plain DataFrame writers (distributed, one file
per partition); nothing is collected to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackyard.sources.tables import read_csv_table


def write_scores(df: DataFrame, path: str, key: str = "id", pred: str = "pred",
                 fmt: str = "csv", id_name: str = "ID", pred_name: str = "PredictedProb") -> None:
    """``(ID, PredictedProb)`` submission."""
    out = df.select(F.col(key).alias(id_name), F.col(pred).alias(pred_name))
    w = out.write.mode("overwrite")
    (w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path))


def fill_template(template: DataFrame, preds: DataFrame, key: str, col: str, pred: str = "pred") -> DataFrame:
    """Replace the template's ``col`` by predictions, joined on key
    (rows without a prediction keep the template value)."""
    j = template.join(preds.select(key, F.col(pred).alias("__p")), key, "left")
    return j.select(*[F.coalesce(F.col("__p"), F.col(c)).alias(c) if c == col else F.col(c)
                      for c in template.columns])


def append_log(row: DataFrame, path: str) -> None:
    """Append experiment result rows (``models.LOG_SCHEMA``; Parquet, append mode)."""
    row.coalesce(1).write.mode("append").parquet(path)


def materialise(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a feature table as a barrier between jobs and read it back
    (cuts lineage, survives executor loss)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def column_groups(assign: DataFrame, group_col: str, name_col: str) -> DataFrame:
    """Metadata table ``(group, columns array<string>)`` from a
    column → group assignment (one row per column, so small)."""
    return (assign.where(F.col(group_col).isNotNull())
                  .groupBy(F.col(group_col).alias("group"))
                  .agg(F.array_sort(F.collect_list(name_col)).alias("columns")))


def write_column_groups(groups: DataFrame, path: str) -> None:
    groups.write.mode("overwrite").parquet(path)


def read_column_groups(spark: SparkSession, path: str) -> dict[str, list[str]]:
    return {r["group"]: list(r["columns"]) for r in spark.read.parquet(path).collect()}


def feature_map(spark: SparkSession, names: list[str], kind: str = "q") -> DataFrame:
    """``(pos, name, kind)`` lines of a feature map (schema metadata)."""
    df = spark.createDataFrame([(names,)], "names array<string>")
    return df.select(F.posexplode("names").alias("pos", "name"), F.lit(kind).alias("kind"))


def write_feature_map(fm: DataFrame, path: str) -> None:
    (fm.select(F.concat_ws("\t", F.col("pos").cast("string"), "name", "kind").alias("line"))
       .coalesce(1).write.mode("overwrite").text(path))


def stamp(df: DataFrame, run_id: str, score: float) -> DataFrame:
    """Scores stamped with the run and its validation score."""
    return df.select("*", F.lit(run_id).alias("run_id"), F.lit(float(score)).alias("score"))


def write_stamped(df: DataFrame, root: str) -> None:
    df.write.mode("append").partitionBy("run_id").parquet(root)


def gather_predictions(spark: SparkSession, path_glob: str, key: str = "ID",
                       pred: str = "PredictedProb", models: list[str] | None = None) -> DataFrame:
    """Many ``(ID, PredictedProb)`` CSV files → long
    ``(id, model, pred)`` with the model named by its file, then one pivot
    on the key (rows align by id, not by position)."""
    # model name: the folder of a Spark part file, else the file name stem (no regular
    # expression for part files: the name is worked out for every row)
    path = F.input_file_name()
    base = F.substring_index(path, "/", -1)
    model = (F.when(base.startswith("part-"), F.substring_index(F.substring_index(path, "/", -2), "/", 1))
             .otherwise(F.regexp_extract(path, r"([^/]+?)(\.csv)?$", 1)))
    raw = read_csv_table(spark, path_glob, f"{key} long, {pred} double").withColumn("model", model)
    long = raw.select(F.col(key).alias("id"), "model", F.col(pred).alias("pred"))
    return pivot_predictions(long, models)


def pivot_predictions(long: DataFrame, models: list[str] | None = None) -> DataFrame:
    """Long ``(id, model, pred)`` → wide, one column per model. An explicit
    model list avoids the extra job that discovers pivot values, and its columns
    come from one grouping by the key (``pivot`` groups by key and model first)."""
    g = long.groupBy("id")
    if not models:
        return g.pivot("model").agg(F.first("pred"))
    return g.agg(*[F.first(F.when(F.col("model") == m, F.col("pred")), ignorenulls=True).alias(m) for m in models])


def write_report(df: DataFrame, path: str) -> None:
    """Model-disagreement report."""
    df.coalesce(1).write.mode("overwrite").parquet(path)
