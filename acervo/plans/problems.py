"""Queries of the general training-data problems: packed fields, wide tables, orphan references."""

from __future__ import annotations

from pyspark.sql import functions as F

from acervo.functions import casts
from acervo.operators import orphans as O
from acervo.operators import packed, wide
from acervo.plans.catalog import CORE
from acervo.session import spread, table


def _list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


@CORE.query("p1_found")
def p1_found(spark, sf_dir):
    fields = spread(table(spark, sf_dir, "circulares", "circular_id", *packed.FIELDS))
    return packed.packed_values(fields)


@CORE.query("p1_resumen")
def p1_resumen(spark, sf_dir):
    """Values, records and longest list per packed field."""
    return p1_found(spark, sf_dir).groupBy("campo").agg(
        F.count("*").alias("valores"), F.countDistinct("circular_id").alias("registros"), F.max("pos").alias("mas_larga")
    )


_WIDE = rf"""
WITH n AS (SELECT DISTINCT nombre, campo, tipo FROM campos_eav),
e AS (SELECT file, row_no, valor_extraido AS v,
        regexp_replace(regexp_replace(lower(campo), '[\s\-_./\x{{A0}}]+', '_', 'g'), '^_+|_+$', '', 'g') AS k FROM eav WHERE file IS NOT NULL),
last AS (SELECT e.file, n.campo, n.tipo, e.row_no, e.v,
           row_number() OVER (PARTITION BY e.file, n.campo ORDER BY e.row_no DESC, e.v DESC NULLS LAST) AS r
         FROM e JOIN n ON e.k = n.nombre),
p AS (SELECT *, lower(trim(regexp_replace(v, '[\s\x{{A0}}]+', ' ', 'g'))) AS t FROM last WHERE r = 1),
q AS (SELECT *, CASE tipo
    WHEN 'texto' THEN true
    WHEN 'entero' THEN try_cast(replace(regexp_extract(t, '{casts.INTEGER}', 1), '.', '') AS BIGINT) IS NOT NULL
    WHEN 'decimal' THEN regexp_matches(t, '{casts.DECIMAL}')
    WHEN 'booleano' THEN t IN ({_list(casts.TRUE + casts.FALSE)})
    WHEN 'fecha' THEN coalesce(
      try_cast(CASE WHEN regexp_matches(t, '{casts.DATE_ISO}') THEN regexp_extract(t, '{casts.DATE_ISO}', 1) || '-' ||
        lpad(regexp_extract(t, '{casts.DATE_ISO}', 2), 2, '0') || '-' || lpad(regexp_extract(t, '{casts.DATE_ISO}', 3), 2, '0') END AS DATE),
      try_cast(CASE WHEN regexp_matches(t, '{casts.DATE_DMY}') THEN
        CASE WHEN length(regexp_extract(t, '{casts.DATE_DMY}', 3)) = 2 THEN '20' ELSE '' END || regexp_extract(t, '{casts.DATE_DMY}', 3) || '-' ||
        lpad(regexp_extract(t, '{casts.DATE_DMY}', 2), 2, '0') || '-' || lpad(regexp_extract(t, '{casts.DATE_DMY}', 1), 2, '0') END AS DATE),
      try_cast(CASE WHEN regexp_matches(t, '{casts.DATE_LONG}') THEN regexp_extract(t, '{casts.DATE_LONG}', 3) || '-' || lpad(CAST(
        CASE regexp_extract(t, '{casts.DATE_LONG}', 2) {" ".join(f"WHEN '{k}' THEN {v}" for k, v in casts.MONTHS.items())} END AS VARCHAR), 2, '0')
        || '-' || lpad(regexp_extract(t, '{casts.DATE_LONG}', 1), 2, '0') END AS DATE)) IS NOT NULL
    END AS legible FROM p WHERE t <> '' AND t NOT IN ({_list(casts.UNKNOWN)}))
"""


@CORE.query("p3_found", _WIDE + "SELECT file, campo, row_no FROM q WHERE legible")
def p3_found(spark, sf_dir):
    eav = spread(table(spark, sf_dir, "eav", "file", "row_no", "campo", "valor_extraido"))
    return wide.filled_cells(eav, table(spark, sf_dir, "campos_eav"))


@CORE.query("p3_ancha")
def p3_ancha(spark, sf_dir):
    """The wide table itself: one typed row per extraction file."""
    eav = spread(table(spark, sf_dir, "eav", "file", "row_no", "campo", "valor_extraido"))
    return wide.wide_table(eav, table(spark, sf_dir, "campos_eav"))


_SQL_NUMBER, _SQL_CITED = O.NUMBER, O.CITED
_ORPHANS = f"""
WITH r AS (
  SELECT circular_id, recibido_en, 'numero' AS campo, unnest(list_distinct(list_transform(
    regexp_extract_all(numero, '{_SQL_NUMBER}'), lambda x: try_cast(replace(x, '.', '') AS INT)))) AS num FROM circulares
  UNION ALL
  SELECT circular_id, recibido_en, 'modificaciones_posteriores', unnest(list_distinct(list_transform(flatten(list_transform(
    regexp_extract_all(modificaciones_posteriores, '{_SQL_CITED}', 1), lambda t: regexp_extract_all(t, '{_SQL_NUMBER}'))),
    lambda x: try_cast(replace(x, '.', '') AS INT)))) FROM circulares),
f AS (SELECT * FROM r WHERE num IS NOT NULL AND NOT EXISTS (SELECT 1 FROM circular_registry g WHERE g.num = r.num
  AND r.recibido_en >= g.alta_en AND (g.baja_en IS NULL OR r.recibido_en < g.baja_en)))
"""


def _found(spark, sf_dir):
    refs = O.references(table(spark, sf_dir, "circulares", "circular_id", "recibido_en", "numero", "modificaciones_posteriores"))
    return O.orphans(refs, table(spark, sf_dir, "circular_registry", "num", "alta_en", "baja_en"))


@CORE.query("p4_found", _ORPHANS + "SELECT circular_id, campo, num FROM f")
def p4_found(spark, sf_dir):
    return _found(spark, sf_dir).select("circular_id", "campo", "num")


@CORE.query(
    "p4_informe",
    _ORPHANS + """SELECT campo, strftime(recibido_en, '%Y-%m') AS periodo, count(*) AS referencias, count(DISTINCT num) AS numeros,
      count(DISTINCT circular_id) AS registros FROM f GROUP BY 1, 2""",
)
def p4_informe(spark, sf_dir):
    return O.orphan_report(_found(spark, sf_dir))
