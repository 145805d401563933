"""Records as attribute rows and back, in the fixed order of the individual extraction file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo.functions.regex import strip

# Blocks and attributes of an extraction file, in order, with the record column each one takes its value from.
LAYOUT = (
    ("Encabezado", "numero_ddu", "numero"), ("Acto Administrativo", "numero_ord", "numero_ord"), ("Antecedentes", "antecedentes", "antecedentes"), ("Materia", "materia", "materia"),
    ("Descriptores", "descriptores", "descriptores"), ("Fecha y Lugar", "fecha_emision", "fecha_lugar"), ("Destinatarios", "destinatarios", "destinatarios"), ("Emisión", "emisor", "emisor"),
    ("Cuerpo", "cuerpo", "cuerpo"), ("Tablas", "tablas", "tablas_manifiesto"), ("Imágenes", "imagenes", "imagenes_manifiesto"),
    ("Modificaciones Posteriores", "modificaciones_posteriores", "modificaciones_posteriores"), ("Nota al Pie", "notas_al_pie", "notas_al_pie"), ("Firma", "firmante", "firmante"),
    ("Distribución", "lista_distribucion", "distribucion_texto"),
)
# Columns of the master file, with the record column each one takes its value from.
MASTER = (
    ("numero_ddu", "numero"), ("numero_ord", "numero_ord"), ("antecedentes", "antecedentes"), ("materia", "materia"), ("descriptores", "descriptores"), ("fecha_emision", "fecha"), ("lugar", "lugar"),
    ("destinatarios", "destinatarios"), ("emisor", "emisor"), ("cuerpo_resumen", "cuerpo"), ("modificaciones_posteriores", "modificaciones_posteriores"), ("notas_al_pie", "notas_al_pie"),
    ("firmante", "firmante"), ("lista_distribucion", "distribucion_texto"),
)


def _text(df: DataFrame, c: str) -> Column:
    return F.coalesce(strip(F.col(c).cast("string")), F.lit("")) if c in df.columns else F.lit("")


def unpivot(records: DataFrame, key: str) -> DataFrame:
    """``(key, orden, bloque, campo, valor_extraido)``: 15 rows per record in presentation order; missing columns give empty values."""
    rows = F.array(*[F.struct(F.lit(i).alias("orden"), F.lit(b).alias("bloque"), F.lit(c).alias("campo"), _text(records, s).alias("valor_extraido")) for i, (b, c, s) in enumerate(LAYOUT)])
    return records.select(key, F.explode(rows).alias("r")).select(key, "r.*")


def pivot(eav: DataFrame, key: str = "file", order: str = "row_no") -> DataFrame:
    """One row per file with a text column per attribute of :data:`LAYOUT`; of several rows the last one decides.

    One aggregation with a conditional maximum per attribute (no pivot scan); names are trimmed, values too.
    """
    name = strip(F.col("campo"))
    last = [F.max(F.when(name == c, F.struct(order, strip(F.coalesce("valor_extraido", F.lit(""))).alias("v"))))["v"].alias(c) for _, c, _ in LAYOUT]
    return eav.groupBy(key).agg(*last)


def record(wide: DataFrame, resegmented: bool = True) -> DataFrame:
    """Records from pivoted files: date and place split at the first comma, the body as sections.

    ``resegmented`` splits the body into sections and paragraphs, else it stays one paragraph.
    """
    from acervo.operators.body import SECTIONS, resegment

    v = lambda c: F.coalesce(F.col(c), F.lit(""))
    when, comma = v("fecha_emision"), v("fecha_emision").contains(",")
    whole = F.when(v("cuerpo") == "", F.array().cast(SECTIONS)).otherwise(F.array(F.struct(F.lit("").alias("titulo"), F.array(v("cuerpo")).alias("parrafos"))))
    return wide.select(
        "*", v("numero_ddu").alias("numero"), F.when(comma, strip(F.regexp_replace(when, r"(?s)^[^,]*,", ""))).otherwise(when).alias("fecha"),
        F.when(comma, strip(F.regexp_extract(when, r"(?s)^([^,]*),", 1))).otherwise(F.lit("Santiago")).alias("lugar"), when.alias("fecha_lugar"),
        (resegment(v("cuerpo")) if resegmented else whole).alias("secciones"), v("lista_distribucion").alias("distribucion_texto"), v("tablas").alias("tablas_manifiesto"), v("imagenes").alias("imagenes_manifiesto"),
    )


def master(records: DataFrame) -> DataFrame:
    """The 14 columns of the master file."""
    return records.select(*[_text(records, s).alias(c) for c, s in MASTER])
