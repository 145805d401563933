"""Circulars as a stream: the same stateless transformation over a file source, written micro-batch by micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.operators.registry import records


def document_stream(spark: SparkSession, path: str, schema: str = "doc_id bigint, text string", **options: str) -> DataFrame:
    """Stream of documents from Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).options(**options).parquet(path)


def record_stream(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """Records of a stream of documents. Stateless: a document depends on no other, so there is no watermark and no state store."""
    return records(documents, key)


def write_records(stream: DataFrame, path: str, checkpoint: str, once: bool = True):
    """Writes records to Parquet; with ``once`` everything that has arrived is processed and the query ends."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()


def late_counts(stream: DataFrame, time: str = "recibido_en", period: str = "1 day", lateness: str = "7 days") -> DataFrame:
    """Documents per period of arrival, with late ones accepted up to ``lateness``."""
    return stream.withWatermark(time, lateness).groupBy(F.window(time, period)).count()
