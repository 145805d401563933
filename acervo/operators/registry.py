"""Registry of extractors and the record they make together.

An extractor is a function ``(text, lines) -> Column | dict[str, Column]`` under a block name. Registered extractors run as
expressions over one row; a column that nobody selects is never computed. A Python extractor (``register_python``) runs in one
Arrow pass with its faults isolated: an exception gives a null value and a message instead of ending the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo.functions.regex import let, rx
from acervo.operators import body, distribution, fields, images, manifest, signer, tables
from acervo.operators.lines import with_lines

Extractor = Callable[[Column, Column], "Column | dict[str, Column]"]
RESULT = "struct<nombre_bloque:string,exito:boolean,datos:map<string,string>,confianza:double,observaciones:string>"


class Registry:
    """Extractors by block name, in order of registration."""

    def __init__(self) -> None:
        self._all: dict[str, Extractor] = {}

    def register(self, name: str) -> Callable[[Extractor], Extractor]:
        def add(f: Extractor) -> Extractor:
            self._all[name] = f
            return f

        return add

    def all(self) -> dict[str, Extractor]:
        return dict(self._all)

    def clear(self) -> None:
        self._all.clear()


REGISTRY = Registry()
REGISTRY.register("encabezado")(lambda t, l: {"numero": fields.number(t, l)})
REGISTRY.register("acto_administrativo")(lambda t, l: {"numero_ord": fields.ord_number(t, l)})
REGISTRY.register("antecedentes")(lambda t, l: {"antecedentes": fields.background(t, l)})
REGISTRY.register("materia")(lambda t, l: {"materia": fields.subject(t, l)})
REGISTRY.register("descriptores")(lambda t, l: {"descriptores": fields.descriptors(t, l)})
REGISTRY.register("fecha_lugar")(lambda t, l: fields.date_and_place(t, l))
REGISTRY.register("destinatarios")(lambda t, l: {"destinatarios": fields.recipient(t, l)})
REGISTRY.register("emisor")(lambda t, l: {"emisor": fields.issuer(t, l)})
REGISTRY.register("nota_al_pie")(lambda t, l: {"notas_al_pie": fields.footnotes(t, l)})
REGISTRY.register("firma")(lambda t, l: signer.signer(t, l))
REGISTRY.register("distribucion")(lambda t, l: {"distribucion_texto": distribution.distribution_text(distribution.distribution(t, l))})
REGISTRY.register("modificaciones_posteriores")(lambda t, l: {"modificaciones_posteriores": fields.amendments(t, l)})


def block_result(name: str, values: dict[str, Column]) -> Column:
    """Result of one extractor: name, success, data, confidence 1 or 0, remark."""
    data = F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)])

    def result(m: Column) -> Column:
        some = F.exists(F.map_values(m), lambda v: F.coalesce(v, F.lit("")) != "")
        remark = F.when(some, F.lit("")).otherwise(F.lit(f"Sin resultado en el bloque {name}."))
        return F.struct(F.lit(name).alias("nombre_bloque"), some.alias("exito"), m.alias("datos"), some.cast("int").cast("double").alias("confianza"), remark.alias("observaciones"))

    return let(data, result)


def blocks(df: DataFrame, key: str = "doc_id", text: str = "text", registry: Registry = REGISTRY) -> DataFrame:
    """``(key, nombre_bloque, exito, datos, confianza, observaciones)``: one row per document and extractor."""
    rows = with_lines(df.select(key, F.coalesce(F.col(text), F.lit("")).alias("text")))
    results = [_isolated(n, f) for n, f in registry.all().items()]
    return rows.select(key, F.explode(F.array(*results)).alias("r")).select(key, "r.*")


def _isolated(name: str, f: Extractor) -> Column:
    """Result of an extractor; one whose expressions cannot be built gives a failed result and leaves the others alone."""
    try:
        return block_result(name, _columns(name, f(F.col("text"), F.col("lines"))))
    except Exception as e:  # noqa: BLE001 - a fault of one extractor must not end the others
        none, note = F.create_map().cast("map<string,string>"), f"{type(e).__name__}: {e}"
        return F.struct(F.lit(name).alias("nombre_bloque"), F.lit(False).alias("exito"), none.alias("datos"), F.lit(0.0).alias("confianza"), F.lit(note).alias("observaciones"))


def _columns(name: str, got: Column | dict[str, Column]) -> dict[str, Column]:
    return got if isinstance(got, dict) else {name: got}


def records(df: DataFrame, key: str = "doc_id", text: str = "text", name: str | None = None, with_body: bool = True) -> DataFrame:
    """One record per document with all header fields, manifests and (``with_body``) sections.

    ``name`` is a column with the file name, from which a missing number is taken. The issuer has a default. Extra columns of
    ``df`` are left out; texts that are null or empty give records of empty fields.
    """
    rows = with_lines(df.select(key, F.coalesce(F.col(text), F.lit("")).alias("text"), *([F.col(name).alias("_name")] if name else [])))
    t, l = F.col("text"), F.col("lines")
    out: dict[str, Column] = {}
    for block, f in REGISTRY.all().items():
        out |= _columns(block, f(t, l))
    num = out["numero"]
    if name:
        of_file = F.regexp_extract(F.coalesce("_name", F.lit("")), r"\b(\d+)\b", 1)
        num = F.when(num != "", num).when(of_file != "", F.concat(F.lit("DDU "), of_file)).otherwise("")
    out["numero"] = num
    out["emisor"] = F.when(out["emisor"] != "", out["emisor"]).otherwise(F.lit(fields.DEFAULT_ISSUER))
    rows = rows.select(key, "text", "lines", *[c.alias(n) for n, c in out.items()])
    digits = F.coalesce(F.when(F.regexp_extract("text", r"(?iu)DDU\s*(\d+)", 1) != "", F.regexp_extract("text", r"(?iu)DDU\s*(\d+)", 1)), F.lit("desconocido"))
    entries = tables.manifest(tables.markdown_tables(l), digits)
    drawings = images.markdown_images(l, digits)
    rows = rows.withColumn("tablas_manifiesto", manifest.format_structs(entries, ["id", "nombre", "paginas", "filas", "columnas", "archivo_anexo"], lists=("paginas",)))
    rows = rows.withColumn("imagenes_manifiesto", manifest.format_structs(drawings, ["id", "nombre", "pagina", "tipo", "formato", "dimensiones", "ancho", "alto", "xref", "descripcion", "archivo_anexo"]))
    if not with_body:
        return rows.drop("text", "lines")
    carried = [c for c in rows.columns if c not in ("text", "lines")]
    return _with_body(rows, key, carried)


def _with_body(rows: DataFrame, key: str, carried: list[str]) -> DataFrame:
    """Adds sections and body in the same pass: the record travels beside its lines, so no join is needed."""
    packed = rows.select(F.struct(*carried).alias("_k"), "lines")
    done = body.sections(packed, "_k", "lines")
    return done.select("_k.*", "secciones", "cuerpo")


def python_extractor(df: DataFrame, function: Callable[[str, list[str]], dict[str, str]], name: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Runs a Python extractor over documents with fault isolation: ``(key, nombre_bloque, exito, datos, observaciones)``."""
    source = with_lines(df.select(key, text), text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok, data, notes = [], [], []
            for t, ls in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                try:
                    got = {k: str(v) for k, v in function(t or "", ls or []).items()}
                    ok.append(any(got.values()))
                    notes.append("")
                except Exception as e:  # noqa: BLE001 - a fault of one document must not end the job
                    got = {}
                    ok.append(False)
                    notes.append(f"{type(e).__name__}: {e}")
                data.append(list(got.items()))
            n = len(ok)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([name] * n), pa.array(ok), pa.array(data, pa.map_(pa.string(), pa.string())), pa.array(notes, pa.string())], names=[key, "nombre_bloque", "exito", "datos", "observaciones"]
            )

    return source.mapInArrow(run, f"{key} {source.schema[key].dataType.simpleString()}, nombre_bloque string, exito boolean, datos map<string,string>, observaciones string")


__all__ = ["REGISTRY", "Registry", "block_result", "blocks", "python_extractor", "records", "rx"]
