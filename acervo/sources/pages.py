"""What lies on the pages of binary documents: table cells, text blocks, images and read signatures, as relations.

Each scan is one Arrow pass over ``binaryFile`` rows and takes the function that opens a document (its *engine*) as an argument; the
default engines use optional libraries. A document that cannot be opened gives one row with its error and nulls, so no file ends a job.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.operators import predicates as P

CELLS = "page int, table_no int, row_no int, col_no int, text string"
BLOCKS = "page int, block_no int, x0 double, y0 double, x1 double, y1 double, text string, type int"
IMAGES = "page int, xref int, w int, h int, bytes int, page_w double, page_h double, x0 double, y0 double, x1 double, y1 double, content binary"
READ = "orden int, text string"
_TYPES = {"int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary()}

# How lines of a page are joined into tables, in points.
TABLE_SETTINGS = {"vertical_strategy": "lines", "horizontal_strategy": "lines", "snap_tolerance": 5, "join_tolerance": 5, "edge_min_length": 10}

Engine = Callable[[bytes], Iterable[tuple]]


def scan(spark: SparkSession, path: str, engine: Engine, schema: str) -> DataFrame:
    """``(file, <schema>, error)``: the rows that ``engine`` yields for the bytes of each document below ``path``."""
    fields = [f.split() for f in schema.split(", ")]
    source = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")

    def rows(data: bytes) -> list[tuple]:
        try:
            return [(*r, None) for r in engine(data)]
        except Exception as e:  # noqa: BLE001 - one bad document must not end the job
            return [(*[None] * len(fields), f"{type(e).__name__}: {e}")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got = rows(data)
                columns = [pa.array([r[i] for r in got], _TYPES[t]) for i, (_, t) in enumerate(fields)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(got), pa.string()), *columns, pa.array([r[-1] for r in got], pa.string())], names=["file", *[n for n, _ in fields], "error"]
                )

    return source.mapInArrow(run, f"file string, {schema}, error string")


def _cells(data: bytes) -> Iterator[tuple]:
    import io

    import pdfplumber

    with pdfplumber.open(io.BytesIO(data)) as pdf:
        for page, p in enumerate(pdf.pages, 1):
            for table, rows in enumerate(p.extract_tables(table_settings=TABLE_SETTINGS) or [], 1):
                for r, row in enumerate(rows):
                    yield from ((page, table, r, c, cell) for c, cell in enumerate(row))


def _blocks(data: bytes) -> Iterator[tuple]:
    import fitz

    with fitz.open(stream=data) as doc:
        for page, p in enumerate(doc, 1):
            for x0, y0, x1, y1, text, number, kind in p.get_text("blocks"):
                yield page, number, x0, y0, x1, y1, text, kind


def _images(data: bytes) -> Iterator[tuple]:
    import fitz

    with fitz.open(stream=data) as doc:
        for page, p in enumerate(doc, 1):
            for xref in dict.fromkeys(i[0] for i in p.get_images()):
                image = doc.extract_image(xref) or {}
                content = image.get("image", b"")
                for box in p.get_image_rects(xref):
                    yield page, xref, image.get("width", 0), image.get("height", 0), len(content), p.rect.width, p.rect.height, box.x0, box.y0, box.x1, box.y1, content


def read_cells(spark: SparkSession, path: str, engine: Engine = _cells) -> DataFrame:
    """Table cells ``(file, page, table_no, row_no, col_no, text, error)``; the input of the merges in :mod:`acervo.operators.tables`."""
    return scan(spark, path, engine, CELLS)


def read_blocks(spark: SparkSession, path: str, engine: Engine = _blocks) -> DataFrame:
    """Text blocks with their boxes, as :func:`acervo.operators.tables.place_blocks` takes them."""
    return scan(spark, path, engine, BLOCKS)


def read_images(spark: SparkSession, path: str, engine: Engine = _images) -> DataFrame:
    """Images with their boxes and bytes, as :func:`acervo.operators.images.image_manifest` takes them."""
    return scan(spark, path, engine, IMAGES)


def read_signatures(spark: SparkSession, path: str, engine: Engine) -> DataFrame:
    """``(file, orden, text, error)``: what ``engine`` (a crop of the signature and a reader of its letters) reads on each document, in order."""
    return scan(spark, path, engine, READ)


def signer_read(rows: DataFrame, repairs: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """``(file, nombre)``: the nearest person above the first line that names the post, among lines read from a signature.

    Lines of the greeting and lines under five letters are passed by; ``repairs`` are pairs of a pattern and its replacement for names that
    were read as one word. A file without a post or a person gives no row.
    """

    def fixed(c: Column) -> Column:
        for pattern, by in repairs:
            c = F.regexp_replace(c, pattern, by)
        return F.trim(c)

    lines = rows.where("error is null and text is not null").groupBy("file").agg(F.transform(F.array_sort(F.collect_list(F.struct("orden", "text"))), lambda x: x["text"]).alias("l"))
    is_post = lambda l: P.Phrases(holds=("jefe division", "jefe divisi", "desarrollo urbano", "division")).column(l)
    at = F.array_position(F.transform("l", is_post), True)
    above = F.reverse(F.slice("l", F.lit(1), F.greatest(at - 1, F.lit(0)).cast("int")))
    usable = F.filter(F.transform(above, fixed), lambda l: (F.length(l) >= 5) & ~l.rlike(r"(?i)saluda|atentamente|ud\.|\bde\b") & P.is_person_name(l))
    return lines.where(at > 0).select("file", F.get(usable, F.lit(0)).alias("nombre")).where("nombre is not null")


def write_images(images: DataFrame, folder: str) -> DataFrame:
    """Writes ``content`` of ``(archivo_anexo, content)`` below a folder that all executors see; gives ``(archivo_anexo, bytes, error)``.

    Names must stay below the folder. Equal names are written once more by whoever comes last.
    """
    base = re.sub("^file://", "", folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pathlib import Path

        for b in batches:
            sizes, errors = [], []
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    to = (Path(base) / name).resolve()
                    if not to.is_relative_to(Path(base).resolve()):
                        raise ValueError("outside the folder")
                    to.parent.mkdir(parents=True, exist_ok=True)
                    to.write_bytes(data)
                    sizes.append(len(data))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001
                    sizes.append(0)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(errors, pa.string())], names=["archivo_anexo", "bytes", "error"])

    return images.select("archivo_anexo", "content").mapInArrow(run, "archivo_anexo string, bytes bigint, error string")
