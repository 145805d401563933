"""File readers and writers.

Files of attribute rows use ``;``, quoted fields, ``CRLF`` line ends and a byte order mark; a directory of them is read as one
table with the file as key. Writers leave the partitioning to the caller's data: one task writes one part file.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.operators import eav as E

CSV = {"sep": ";", "header": "true", "quoteAll": "true", "escape": '"', "encoding": "UTF-8"}
EAV_SCHEMA = "bloque string, campo string, valor_extraido string"


def read_eav_csv(spark: SparkSession, path: str) -> DataFrame:
    """``(file, row_no, bloque, campo, valor_extraido)`` of one extraction file, a directory or a glob.

    Values may hold line ends. ``row_no`` counts the rows of a file from 0; a file is read by one task, as quoted line ends
    don't split. A byte order mark is dropped. A file without the three columns gives rows of nulls, never an error.
    """
    rows = spark.read.options(**CSV).option("multiLine", True).option("mode", "PERMISSIVE").schema(EAV_SCHEMA).csv(path)
    place = F.monotonically_increasing_id()
    named = rows.select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), place.alias("_p"), "bloque", "campo", "valor_extraido")
    from pyspark.sql import Window

    w = Window.partitionBy("file").orderBy("_p")
    return named.withColumn("row_no", (F.row_number().over(w) - 1).cast("int")).select("file", "row_no", "bloque", "campo", "valor_extraido")


def read_master_csv(spark: SparkSession, path: str) -> DataFrame:
    """The master file with its 14 text columns."""
    return spark.read.options(**CSV).option("multiLine", True).schema(", ".join(f"{c} string" for c, _ in E.MASTER)).csv(path)


def write_eav_csv(records: DataFrame, key: str, path: str) -> None:
    """One directory per record below ``path`` (``{key}=…``) with its 15 attribute rows in presentation order.

    The order survives because the rows of one record come from one input row and stay in one task. This is the exchange format of single
    circulars; for many records use :func:`write_eav_buckets`, as every record becomes a file.
    """
    rows = E.unpivot(records, key).select(key, "bloque", "campo", "valor_extraido")
    rows.write.mode("overwrite").partitionBy(key).options(**CSV, lineSep="\r\n").csv(path)


def write_eav_buckets(records: DataFrame, key: str, path: str, buckets: int = 64) -> None:
    """The attribute rows of many records in ``buckets`` directories by the hash of the key, which stays a column with the order of the rows."""
    rows = E.unpivot(records, key).withColumn("cubo", F.pmod(F.xxhash64(key), F.lit(buckets)))
    rows.repartition("cubo").write.mode("overwrite").partitionBy("cubo").options(**CSV, lineSep="\r\n").csv(path)


def read_eav_buckets(spark: SparkSession, path: str) -> DataFrame:
    """``(file, row_no, bloque, campo, valor_extraido)`` of :func:`write_eav_buckets`; the key is read as text."""
    rows = spark.read.options(**CSV).option("multiLine", True).schema(f"file string, row_no int, {EAV_SCHEMA}").csv(path)
    return rows.select("file", "row_no", "bloque", "campo", "valor_extraido")


def write_master_csv(records: DataFrame, path: str, single: bool = False) -> None:
    """The master file: one row per record. ``single`` makes one part file, for small results only."""
    out = E.master(records)
    (out.coalesce(1) if single else out).write.mode("overwrite").options(**CSV, lineSep="\r\n").csv(path)


def write_table_csv(tables: DataFrame, path: str) -> None:
    """Tables ``(tabla_id, orden, celdas ARRAY<STRING>)`` as delimited lines, one directory per table."""
    quoted = F.array_join(F.transform("celdas", lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))), ";")
    tables.select("tabla_id", quoted.alias("value")).write.mode("overwrite").partitionBy("tabla_id").option("lineSep", "\r\n").text(path)


def write_documents(df: DataFrame, key: str, column: str, path: str) -> None:
    """One directory per key with the text of ``column`` (XML or Turtle)."""
    df.select(key, F.col(column).alias("value")).write.mode("overwrite").partitionBy(key).text(path)


def read_documents(spark: SparkSession, path: str, parse: Callable[[bytes], list[str]] | None = None, skip_empty: bool = False) -> DataFrame:
    """``(file, text, error)`` of binary documents, page texts joined by line feeds.

    ``parse`` turns the bytes of a file into page texts; without it the optional library pypdf is used, and where that is
    missing each file has an error instead of a text. ``skip_empty`` leaves out pages without text.
    """
    raw = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")

    def pages(data: bytes) -> list[str]:
        import io

        from pypdf import PdfReader

        return [p.extract_text() or "" for p in PdfReader(io.BytesIO(data)).pages]

    reader = parse or pages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, errors = [], []
            for data in b.column(1).to_pylist():
                try:
                    got = reader(data)
                    texts.append("\n".join(p for p in got if p or not skip_empty))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - one bad file must not end the job
                    texts.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(errors, pa.string())], names=["file", "text", "error"])

    return raw.mapInArrow(run, "file string, text string, error string")
