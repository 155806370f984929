"""Reports as a stream: new files are extracted once and upserted by table key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.extract import candidates, report_id_of

REPORT = "value string"


def report_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """Stream of (report_id, source_path, content), one row per *_extracted.txt that arrives under folder."""
    raw = (
        spark.readStream.schema(REPORT).option("recursiveFileLookup", True).option("pathGlobFilter", "*_extracted.txt").option("wholetext", True)
        .option("maxFilesPerTrigger", files_per_trigger).format("text").load(folder)
    )
    path = F.col("_metadata.file_path")
    return raw.select(report_id_of(path).alias("report_id"), path.alias("source_path"), F.col("value").alias("content"))


def ingest(spark: SparkSession, folder: str, out: str, state: str) -> StreamingQuery:
    """Run over what is there and stop. Each batch writes the tables of its reports under out/batch=...

    A batch that is run again after a loss replaces exactly its own folder, so every table of it stands once; there are as
    many folders as batches, not as reports. `latest` has the tables of reports that came again.
    """

    def write(batch: DataFrame, number: int) -> None:
        tables = candidates(batch).withColumn("table_key", F.concat_ws("|", "report_id", F.col("line_position").cast("string"))).withColumn("batch", F.lit(number))
        tables.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    return report_stream(spark, folder).writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()


def latest(tables: DataFrame) -> DataFrame:
    """Of reports that came in several batches the tables of the last one."""
    last = tables.groupBy("report_id").agg(F.max("batch").alias("batch"))
    return tables.join(last, ["report_id", "batch"], "left_semi")


def windowed_counts(events: DataFrame, size: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Events per window and type, for streams and tables alike; events later than `late` are dropped by a stream only."""
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if events.isStreaming:
        events = events.withWatermark("ts", late)
    g = events.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")
