"""Stream-static scoring with fitted code tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackyard.operators.encode import Codes


def apply_codes(stream: DataFrame, fitted: list[Codes]) -> DataFrame:
    """Replace each fitted column by its code (stream-static left join; the
    static side is a measured code table, broadcast when small)."""
    out = stream
    for c in fitted:
        out = c.transform(out)
    return out


def score_stream(stream: DataFrame, path: str, checkpoint: str, key: str = "id",
                 cols: list[str] | None = None, available_now: bool = True):
    """Append scored micro-batches as Parquet; progress is kept in
    ``checkpoint`` (a shared folder on a cluster), so a restarted query
    resumes without duplicates."""
    sel = stream.select(key, *(cols or [c for c in stream.columns if c != key]))
    w = (sel.writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def encoded_events_stream(spark, src_dir: str, fitted: list[Codes]) -> DataFrame:
    """Example: the events table read as a file stream, encoded."""
    schema = spark.read.parquet(f"{src_dir}/events.parquet").schema
    s = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
              .option("maxFilesPerTrigger", 1).parquet(src_dir))
    s = s.select(F.col("event_id").cast("bigint").alias("id"), "event_type", "value")
    return apply_codes(s, fitted)
