"""Landed files as a stream: each micro-batch goes into bronze like a daily load, once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from marketlens import schemas
from marketlens.plans import pipeline
from marketlens.sources import tables


def stream_landed(
    spark: SparkSession,
    landing_dir: str,
    root: str,
    checkpoint: str,
    file_format: str = "parquet",
    features: bool = False,
) -> StreamingQuery:
    """Take in every file not seen yet, then stop.

    Start it again for the next day's files: the checkpoint, which belongs in a
    folder all executors reach, remembers which ones were read. Its name and the
    number of a batch go into bronze's version with the batch, so a batch that is
    repeated after a failure adds nothing.
    """

    def take_in(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        pipeline.ingest(session, root, batch, batch=(checkpoint, number))
        if features:
            pipeline.advance_features(session, root)

    tables.create_tables(spark, root)
    reader = spark.readStream.schema(schemas.LANDED_BARS)
    if file_format == "csv":
        reader = reader.option("header", True)
    return (
        reader.format(file_format)
        .load(landing_dir)
        .writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
