"""Extractors from the command line: ``python -m acervo.cli EXTRACTOR PATH`` prints one JSON line per document.

PATH is a text file, a PDF (with the optional library), or a directory or glob of such; EXTRACTOR is a name of the registry, or ``todo``
for the whole record.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, path: str) -> DataFrame:
    """``(file, text, error)`` of text or binary documents."""
    from acervo.sources.files import read_documents

    raw = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("content").cast("string").alias("text"))
    plain = raw.where(~F.lower("file").endswith(".pdf")).withColumn("error", F.lit(None).cast("string"))
    pdf = read_documents(spark, path).where(F.lower("file").endswith(".pdf"))
    return plain.unionByName(pdf)


def extract(spark: SparkSession, extractor: str, path: str) -> DataFrame:
    """``(file, json)`` of each document; one that cannot be read gives its error."""
    from acervo.operators import registry

    docs = documents(spark, path)
    if extractor == "todo":
        got = registry.records(docs, "file")
    else:
        one = registry.Registry()
        one.register(extractor)(registry.REGISTRY.all()[extractor])
        got = registry.blocks(docs, "file", registry=one)
    body = F.struct(*[c for c in got.columns if c != "file"])
    return docs.select("file", "error").join(got.select("file", body.alias("_b")), "file").select("file", F.when(F.col("error").isNull(), F.to_json("_b")).otherwise(F.to_json(F.struct("error"))).alias("json"))


def main(args: list[str] | None = None) -> None:
    from acervo.operators import registry
    from acervo.session import build_session

    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("extractor", choices=[*registry.REGISTRY.all(), "todo"])
    parser.add_argument("path")
    got = parser.parse_args(args)
    for r in extract(build_session("acervo.cli"), got.extractor, got.path).toLocalIterator():
        print(r["json"])


if __name__ == "__main__":
    main()
