"""Queries of the engine's own operators over whole tables, with oracles where SQL can express them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from acervo.functions import casts, dates, text as T
from acervo.functions.regex import ci, rx, squeeze, upper_share
from acervo.operators import body, distribution, eav, fields, graph as G, images, manifest, predicates as P, registry, render, signer, tables
from acervo.operators.lines import explode_lines, head, lines_of, with_lines
from acervo.plans import sql as S
from acervo.plans.catalog import CORE
from acervo.session import small, spread, table

query = CORE.query


def docs(spark, sf_dir, *columns):
    return spread(table(spark, sf_dir, "documents", "doc_id", "text", *columns))


def doc_lines(spark, sf_dir):
    return explode_lines(docs(spark, sf_dir))


def circ(spark, sf_dir, *columns):
    return spread(table(spark, sf_dir, "circulares", "circular_id", *columns))


_L = "WITH " + S.lines()
_C = "WITH " + S.lines("circulares", "circular_id", "cuerpo")


# -- scans, heads, prefixes


@query("lines_explode", _L + " SELECT doc_id, line_no, line FROM l")
def _(spark, sf_dir):
    return doc_lines(spark, sf_dir)


@query("lines_head_n", _L + " SELECT doc_id, count(*) FILTER (line <> '') AS lineas, max(length(line)) AS mas_larga FROM l WHERE line_no < 25 GROUP BY doc_id")
def _(spark, sf_dir):
    h = docs(spark, sf_dir).select("doc_id", head(lines_of(F.col("text")), 25).alias("h")).where("size(h) > 0")
    return h.select("doc_id", F.size(F.filter("h", lambda l: l != "")).cast("bigint").alias("lineas"), F.array_max(F.transform("h", lambda l: F.length(l))).cast("bigint").alias("mas_larga"))


_PREFIX = r"\b(A|PARA)\s*:\s*[^\n]+"


@query("text_prefix_search", f"SELECT doc_id FROM documents WHERE {S.rx('substring(text, 1, 1500)', _PREFIX)}")
def _(spark, sf_dir):
    return docs(spark, sf_dir).where(rx(F.substring("text", 1, 1500), _PREFIX)).select("doc_id")


@query("document_join_pages", "SELECT num, string_agg(text, chr(10) ORDER BY doc_id) AS texto, count(*) AS paginas FROM documents WHERE coalesce(text, '') <> '' AND num IS NOT NULL GROUP BY num")
def _(spark, sf_dir):
    """Texts of one circular as the pages of a document, empty ones skipped."""
    pages = docs(spark, sf_dir, "num").where("coalesce(text, '') <> '' and num is not null")
    got = pages.groupBy("num").agg(F.array_sort(F.collect_list(F.struct("doc_id", "text"))).alias("p"), F.count("*").alias("paginas"))
    return got.select("num", F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("texto"), "paginas")


@query(
    "json_manifest_scan",
    """SELECT circular_id, len(json_extract(tablas_manifiesto, '$[*].id')) AS entradas FROM circulares
    WHERE tablas_manifiesto LIKE '[%' AND json_valid(tablas_manifiesto)""",
)
def _(spark, sf_dir):
    got = circ(spark, sf_dir, "tablas_manifiesto").where("tablas_manifiesto like '[%'").withColumn("m", F.from_json("tablas_manifiesto", manifest.MAPS))
    return got.where("m is not null").select("circular_id", F.size("m").cast("bigint").alias("entradas"))


# -- predicates


@query("line_upper_ratio", _L + f", u AS (SELECT doc_id, {S.upper_share('line')} AS s FROM l) SELECT doc_id, count(*) FILTER (s >= 0.65) AS mayusculas, round(avg(s), 6) AS media FROM u GROUP BY doc_id")
def _(spark, sf_dir):
    u = doc_lines(spark, sf_dir).select("doc_id", upper_share(F.col("line")).alias("s"))
    return u.groupBy("doc_id").agg(F.sum((F.coalesce(F.col("s") >= 0.65, F.lit(False))).cast("bigint")).alias("mayusculas"), F.round(F.avg("s"), 6).alias("media"))


# The oracles of the line predicates are written out here from what the predicates mean, not from the engine's phrases.
_W = "(' ' || trim(regexp_replace(translate(lower(line), 'áéíóúüñàèìòùâêîôûäëïöãõç', 'aeiouunaeiouaeiouaeioaoc'), '[^a-z0-9]+', ' ', 'g')) || ' ')"


def _w(pattern: str) -> str:
    return f"regexp_matches({_W}, '{pattern}')"


_UP = f"coalesce({S.upper_share('line')}"
_DESC_LINE = (
    "(NOT " + _w("^ (a|de (jefe|ministro|subsecretari[oa]|directora?|secretari[oa]|division)|ddu|circular|ord|oro|ant|mat|santiago|valparaiso|complementa|trabajando|gobierno|ministerio) ")
    + rf" AND NOT regexp_matches(line, '(?i)^(DE\s*:|[0-9]+\.)') AND {_UP} >= 0.65, false))"
)
_DESC_START = (
    "(" + _w("^ (permisos|vigencia|recepciones|de la planificacion|modificacion|aprobaciones|estudios de riesgo|plan regulador|normas) ")
    + f" OR (length(regexp_replace(line, '\\P{{L}}', '', 'g')) >= 5 AND {_UP} >= 0.75, false) AND (contains(line, ';') OR "
    + _w("planificacion|regulador|seccional|permisos|recepciones|riesgo|aprobaciones|modificacion|normas|urbanisticas|edificacion|pisos|mecanicos|altura") + ")))"
)
_FOOT = (
    "regexp_matches(regexp_replace(translate(lower(line), 'áéíóúüñàèìòùâêîôûäëïöãõç', 'aeiouunaeiouaeiouaeioaoc'), " + S.q(S.BLANK + "+") + ", '', 'g'), "
    "'pagina[0-9]|ministeriodevivienda|alameda924|santiago-chile|gobiernodechile|^!+$')"
)
_TITLE = rf"(line <> '' AND NOT {_FOOT} AND NOT regexp_matches(line, '(?i)^([0-9]+|[ivxlcdm]+|[l1]+)[.]\s+') AND NOT regexp_matches(line, '(?i)^(saluda|distribuci(ó|Ó|o)n)') AND {_UP} >= 0.65, false))"


@query(
    "caps_line_filter",
    _L + f" SELECT doc_id, count(*) FILTER ({_DESC_LINE}) AS descriptor, count(*) FILTER ({_DESC_START}) AS inicio, count(*) FILTER ({_TITLE}) AS titulo FROM l GROUP BY doc_id",
)
def _(spark, sf_dir):
    l, n = F.col("line"), lambda c: F.sum(c.cast("bigint"))
    return doc_lines(spark, sf_dir).groupBy("doc_id").agg(
        n(P.is_descriptor_line(l)).alias("descriptor"), n(P.is_descriptor_start(l)).alias("inicio"), n(P.is_title_continuation(l)).alias("titulo")
    )


_DIAGRAM = _w(" (planta azotea|corte esquematico|sin escala) ")
_LABEL = (
    f"(regexp_matches(line, '^[½¼¾�?]+$') OR {_DIAGRAM} OR (length(line) < 80 AND "
    + _w("^ (edificio|piscinas?|chimeneas?|pergolas?|ascensores|barandas?|paramentos( perimetrales)?|perimetrales|escalera|jardineras|ornamentales|quinchos?|otros|salida caja de( escalera)?|terraza( terraza)?|vegetacion( jardineras)?|maximo 25 de la superficie de la azotea|altura maxima de edificacion permitida por el ipt|piscinas vegetacion jardineras elementos ornamentales|salas de maquinas cajas de escalera chimeneas|con un maximo de 99|pergolas quinchos otros) $")
    + "))"
)
_TABLE = (
    "(" + _w("^ (tipo de gestion|casos que comprende|n circular|ddu n n ord|n ord) | materia s que se modifica n |^ (ddu n|materia de la circular|motivos consideraciones|modificaciones) $")
    + " OR (starts_with(line, '|') AND " + _w("^ (circular|tipo de gestion|ddu n) ") + "))"
)


@query("diagram_and_table_lines", _L + f" SELECT doc_id, line_no, {_DIAGRAM} AS diagrama, {_LABEL} AS etiqueta, {_TABLE} AS tabla FROM l WHERE {_LABEL} OR {_TABLE}")
def _(spark, sf_dir):
    l = F.col("line")
    return doc_lines(spark, sf_dir).where(P.is_drawing_label(l) | P.is_table_start(l)).select(
        "doc_id", "line_no", P.is_drawing_title(l).alias("diagrama"), P.is_drawing_label(l).alias("etiqueta"), P.is_table_start(l).alias("tabla")
    )


_M = "WITH " + S.lines("circulares", "circular_id", "modificaciones_posteriores")


@query(
    "margin_note_lines",
    _M + " SELECT circular_id, line_no, line FROM l WHERE "
    + _w(" (circular modificada por|modificada por circular|dejada sin efecto por) |^ circular ord (n )?[0-9]+ $|^ de fecha [0-9]+ de [a-z]+( de [0-9]+)? $|^ de [0-9]+ ddu [0-9]+ $|^ numeral [0-9]+ $"),
)
def _(spark, sf_dir):
    notes = explode_lines(circ(spark, sf_dir, "modificaciones_posteriores"), "circular_id", "modificaciones_posteriores")
    return notes.where(P.is_margin_note(F.col("line")))


_NOTE = (
    r"(regexp_matches(line, '^[0-9]{1,2}\s*([a-z]\))?\s+[\p{Lu}\"“''‘(]') AND NOT regexp_matches(line, '^[0-9]{1,2}\. ') AND NOT "
    + _w("^ [0-9]+ (o mas|para todas|y cumplan|de la (ley|lguc|oguc)|de (enero|febrero|marzo|abril|mayo|junio|julio|agosto|septiembre|setiembre|octubre|noviembre|diciembre)) ") + ")"
)
_INDEX = f"(regexp_matches(regexp_replace({_W}, '^( [ivxlcdm0-9]+)+ ', ' '), '^ (indice|tabla de contenidos?|contenidos?) ') OR regexp_matches(line, '\\.{{4,}}|\\.{{3,}}\\s*[0-9]+$'))"


@query("footnote_footer_index_lines", _L + f" SELECT doc_id, count(*) FILTER ({_NOTE}) AS notas, count(*) FILTER ({_FOOT}) AS pies, count(*) FILTER ({_INDEX}) AS indice FROM l GROUP BY doc_id")
def _(spark, sf_dir):
    l, n = F.col("line"), lambda c: F.sum(c.cast("bigint"))
    return doc_lines(spark, sf_dir).groupBy("doc_id").agg(n(P.is_note_start(l)).alias("notas"), n(P.is_page_foot(l)).alias("pies"), n(P.is_index_line(l)).alias("indice"))


_RESIDUE = (
    "(" + _w("^ (tipo de gestion|casos que comprende|n circular|ddu n n ord|n ord fecha|materia de la circular|motivos consideraciones|modificaciones) ")
    + r" OR regexp_matches(line, '^[0-9]{3}\s+[0-9]+\s+[0-9]{2}[-.][0-9]{2}[-.][0-9]{2}') OR (starts_with(line, 'La ejecución de obras de urbanización') AND contains(line, 'Art. 2.2.1.'))"
    + r""" OR regexp_matches(line, '^(1\. Loteos \(Art\. 2\.2\.4\.|2\. Proyectos que se acojan al régimen de copropiedad|3\. División afecta a declaratoria de utilidad|1\. Obras de urbanización voluntarias en el espacio|2\. Obras de urbanización voluntarias al interior|Cualquiera de las obras de urbanización contempladas en el artículo 134|Específica |Se aborda esta materia en la presente circular|Expiró el plazo que se informaba|[12]\. En el punto 2|[12]\. Se reemplaza el punto|3\. En el punto 4|2\. En el punto 3|Se deja sin efecto por completo la Circular)'))"""
)
_RECIPIENT = r"(regexp_matches(line, '^([0-9]+\.\s+)?\p{Lu}') AND " + _w("^ ([0-9]+ )?(sra?|sres|biblioteca|colegio|instituto|camara|depto|archivo|jefe|oirs|oficina) ") + ")"
_KEPT = f"NOT (regexp_matches(line, '\\.{{5,}}|\\.{{3,}}\\s*[0-9]+$') OR {S.rx('line', '(^|[^a-zA-Z0-9_])[IÍ]NDICE' + chr(92) + 's*:')} OR {_NOTE} OR {_RESIDUE} OR {_RECIPIENT})"


@query("table_residue_filter", _C + f" SELECT circular_id, count(*) AS lineas, count(*) FILTER ({_RESIDUE}) AS restos, count(*) FILTER ({_KEPT}) AS quedan FROM l GROUP BY circular_id")
def _(spark, sf_dir):
    l, n = F.col("line"), lambda c: F.sum(c.cast("bigint"))
    rows = explode_lines(circ(spark, sf_dir, "cuerpo"), "circular_id", "cuerpo")
    return rows.groupBy("circular_id").agg(F.count("*").alias("lineas"), n(P.is_table_residue(l)).alias("restos"), n(P.is_body_paragraph(l)).alias("quedan"))


_WORDS = "list_filter(regexp_split_to_array(regexp_replace(nombre_firmante, '[^A-ZÁÉÍÓÚÑa-z]', ' ', 'g'), '\\s+'), lambda w: regexp_matches(w, '^[A-ZÁÉÍÓÚÑ].+$'))"


_NO_PERSON = S.in_list(
    """MOTIVO CONSIDERACIONES MATERIA MATERIAS OBSERVACIONES ANTECEDENTES CIRCULAR TABLA CUADRO MODIFICA MODIFICAN DISTRIBUCION DISTRIBUCIÓN MINISTERIO VIVIENDA URBANISMO DIVISIÓN DIVISION DESARROLLO
    URBANO GOBIERNO CHILE ORD DDU OFPA ANT MAT DE A PARA SANTIAGO SALUDA ATENTAMENTE PÁGINA PAGINA FECHA SUBSECRETARIO SUBSECRETARIA MINISTRO MINISTRA CONTRALOR CONTRALORA""".split()
)


@query(
    "person_name_predicate",
    f"SELECT circular_id, len({_WORDS}) >= 2 AND len(list_filter({_WORDS}, lambda w: upper(w) IN ({_NO_PERSON}))) = 0 AS persona FROM circulares WHERE nombre_firmante IS NOT NULL",
)
def _(spark, sf_dir):
    return circ(spark, sf_dir, "nombre_firmante").where("nombre_firmante is not null").select("circular_id", P.is_person_name(F.col("nombre_firmante")).alias("persona"))


_TERMS = (
    "regexp_matches(lower(line), 'ddu n|n[°º] circular|n[°º] ord|ord|fecha|materia de la circular|motivos / consideraciones|modificaciones|tipo de gestión|casos que comprende|circular"
    r"|materia\(s\) que se modifica|motivo y/o|consideraciones')"
)


@query("header_row_predicate", _L + f" SELECT doc_id, line_no, {_TERMS} AS encabezado FROM l WHERE line LIKE '|%|'")
def _(spark, sf_dir):
    rows = doc_lines(spark, sf_dir).where("line like '|%|'")
    return rows.select("doc_id", "line_no", P.is_header_row(F.array("line")).alias("encabezado"))


# -- text repair

_JOIN_SQL = f"regexp_replace(text, '([a-zA-ZáéíóúÁÉÍÓÚñÑ]{{3,}})\\s+(s|S|os|as|mo|ren)([^\\p{{L}}\\p{{N}}_]|$)', '\\1\\2\\3', 'g')"


@query(
    "ocr_suffix_join",
    r"""WITH t AS (SELECT doc_id, list_filter(regexp_extract_all(text, '([\p{L}\p{N}_]+)\s+(?:s|S|os|as|mo|ren)(?:[^\p{L}\p{N}_]|$)', 1), lambda w: regexp_matches(w, '^[a-zA-ZáéíóúÁÉÍÓÚñÑ]{3,}$')) AS w FROM documents)
    SELECT doc_id, len(w) AS unidas FROM t WHERE len(w) > 0""",
)
def _(spark, sf_dir):
    """How many endings the repair joins in each text."""
    from acervo.functions.regex import END, LETTERS, START

    hits = F.regexp_count("text", F.lit(rf"{START}[{LETTERS}]{{3,}}\s+(?:[sS]|os|as|mo|ren){END}"))
    return docs(spark, sf_dir).select("doc_id", hits.cast("bigint").alias("unidas")).where("unidas > 0")


@query("space_before_punct", f"SELECT doc_id, md5(regexp_replace(text, '{S.BLANK}+([,.:;])', '\\1', 'g')) AS huella FROM documents WHERE text IS NOT NULL")
def _(spark, sf_dir):
    return docs(spark, sf_dir).where("text is not null").select("doc_id", F.md5(F.regexp_replace("text", r"(?U)\s+([,.:;])", "$1")).alias("huella"))


@query("whitespace_squeeze", f"SELECT doc_id, md5({S.squeeze('text')}) AS huella FROM documents WHERE text IS NOT NULL")
def _(spark, sf_dir):
    return docs(spark, sf_dir).where("text is not null").select("doc_id", F.md5(squeeze(F.col("text"))).alias("huella"))


# Repairs, written out here: known words torn at any place (head and tail of each split; borders are taken in and given back), endings, blanks.
_NB, _LT = r"[^\p{L}\p{N}_]", "a-zA-ZáéíóúÁÉÍÓÚñÑ"


def _torn_sql(x: str, known: str) -> str:
    loose = lambda t: "".join({"á": "[aá]", "é": "[eé]", "í": "[ií]", "ó": "[oó]", "ú": "[uú]"}.get(c, c) for c in t)
    for w in known.split():
        stem = w.rstrip("*")
        for i in range(1, len(stem)):
            if stem[i:] in ("a", "es") and stem[i - 1] in "lrdn":
                continue
            end, back = ("", "") if w.endswith("*") else (f"({_NB}|$)", r"\4")
            x = f"regexp_replace({x}, '(?i)(^|{_NB})({loose(stem[:i])})\\s+({loose(stem[i:])}){end}', '\\1\\2\\3{back}', 'g')"
    return x


def _endings_sql(x: str, endings: str, ignore: str = "", word: str = f"[{_LT}]{{3,}}") -> str:
    return f"regexp_replace({x}, '{ignore}(^|{_NB})({word})\\s+({endings})({_NB}|$)', '\\1\\2\\3\\4', 'g')"


def _words_sql(x: str, known: str = "artícul* superior* secret* ordenanz* vigésim* arquitectónicos territorial inmobiliarios considerar instituto por") -> str:
    x = _endings_sql(_torn_sql(x, known), "s|S|os|as|mo|ren")
    return S.strip(f"regexp_replace(regexp_replace({x}, {S.q(S.BLANK + '+([,.:;])')}, '\\1', 'g'), '[ \\t]+', ' ', 'g')")


_REPAIRED = _words_sql("text")


@query("text_repair", f"SELECT doc_id, {_REPAIRED} AS texto FROM documents")
def _(spark, sf_dir):
    """All repairs of torn words on every text."""
    return docs(spark, sf_dir).select("doc_id", T.fix_words(F.col("text")).alias("texto"))


_BODY_KNOWN = """artícul* superior* secret* ordenanz* vigésim* arquitectónicos territorial inmobiliarios considerar instituto por instrumento instrucci* permiso permisos edificad* edificaci* incremento incrementos
  circunscribirse porcentual porcentuales antes aplicable aplicables modificad* modificaci* específic* construida construidas construido construidos correspondient* circular* superfici* disposici* urbanístic*
  territorial* solicitud* aprobad* aprobaci* expuesto expuestos expuesta expuestas"""
_LEADS = (r"se\s+dejan\s+sin\s+efecto\s+las\s+siguientes\s+circulares", r"se\s+modifican\s+las\s+siguientes\s+circulares\s+en\s+la\s+forma\s+que\s+se\s+indica", r"la\s+urbanizaci[óo]n\s+solo\s+comprende\s+los\s+siguientes\s+tipos\s+de\s+gesti[óo]n")
_BODY = f"regexp_replace({_words_sql('cuerpo', _BODY_KNOWN)}, '(^|{_NB})OS\\s+33({_NB}|$)', '\\1DS 33\\2', 'g')"
_BODY = rf"regexp_replace({_BODY}, '(?i)\(?\s*(circular\s+modificada\s+por|modificada\s+por\s+circular|dejada\s+sin\s+efecto\s+por)\s+circular\s+ord\.?\s*n[°º?]?\s*[0-9]+[^\n)]*\)?', '', 'g')"
_AT_END = r"'(?is)\s*(circular\s+)?materia\(s\)\s+que\s+se\s+modifica\(n\).*$'"


@query(
    "body_text_repair",
    f"WITH a AS (SELECT circular_id, {_BODY} AS x FROM circulares), b AS (SELECT circular_id, {S.squeeze(f'CASE WHEN regexp_matches(x, {_AT_END}) THEN regexp_replace({S.strip(f"regexp_replace(x, {_AT_END}, {S.q('')})")}, {S.q(';$')}, {S.q(':')}) ELSE x END')} AS c0 FROM a)"
    + "".join(f", l{i} AS (SELECT circular_id, CASE WHEN regexp_matches(c{i}, '(?i){p}') THEN {S.strip(f'regexp_extract(c{i}, {S.q("(?is)^(.*?" + p + ")")}, 1)')} || ':' ELSE c{i} END AS c{i + 1} FROM {'b' if not i else f'l{i - 1}'})" for i, p in enumerate(_LEADS))
    + " SELECT circular_id, c3 AS cuerpo FROM l2",
)
def _(spark, sf_dir):
    return circ(spark, sf_dir, "cuerpo").select("circular_id", T.cut_after_lead_in(T.fix_body(F.col("cuerpo"))).alias("cuerpo"))


def _notes_sql(x: str) -> str:
    x = _endings_sql(_torn_sql(x, "containers artículo artículos"), "i[óo]n|iones", "(?i)", f"[{_LT}]+c")
    x = _endings_sql(x, "res|les|nes|dos|das|tos|tas|mente|nicos|nica|nicas")
    return S.squeeze(_endings_sql(x, "[rlns]", "", f"[{_LT}]{{3,}}[a-záéíóúñ]"))


@query("footnote_text_repair", f"SELECT circular_id, {_notes_sql('notas_al_pie')} AS notas_al_pie FROM circulares")
def _(spark, sf_dir):
    return circ(spark, sf_dir, "notas_al_pie").select("circular_id", T.fix_notes(F.col("notas_al_pie")).alias("notas_al_pie"))


_RECIPIENT_KNOWN = """urbanismo urbanistas regional regionales secretaria secretarias secretarios subsecretaria desarrollo desarrolladores inmobiliarios territorial directores revisores independientes biblioteca
  ministerio ministeriales instituto planificación ordenamiento ambiente división nacional contralora contraloría ejecutivo municipalidades documentación interna minvu seremi serviu"""
_REC = "lista_distribucion"
for _p, _r in ((r"^[,!;:_\s-]+([0-9]+)", r"\1"), (r"^[lIi|][.!;:,_\s-]+\s*", "1. "), (r"^([0-9]+)[!;:,_-]+\s*", r"\1. "), (r"^([0-9]+)\s*\.\s*", r"\1. ")):
    _REC = f"regexp_replace({_REC}, '{_p}', '{_r}')"
_REC = _endings_sql(_torn_sql(_REC, _RECIPIENT_KNOWN), "i[óo]n|iones", "(?i)", f"[{_LT}]+c")
_REC = _endings_sql(_REC, "res|les|nes|dos|das|tos|tas|ria|rias|rios|tiva|tivas|ial|rial|loría")
_REC = _endings_sql(_REC, "[rlns]", "(?i)", f"[{_LT}]{{3,}}[a-záéíóúñ]")
_REC = rf"regexp_replace(regexp_replace(regexp_replace({_REC}, '[\s;]+$', ''), '\s*;\s*', ' ', 'g'), '\s+\.', '.', 'g')"


@query("recipient_text_repair", f"SELECT circular_id, {S.squeeze(_REC)} AS lista FROM circulares")
def _(spark, sf_dir):
    return circ(spark, sf_dir, "lista_distribucion").select("circular_id", T.fix_recipient(F.col("lista_distribucion")).alias("lista"))


_SIGN = _words_sql("firmante")
for _p, _r in (
    (r"(D\s+VISI|IS[IÍÓ?�\s]+N)\s+DE\s+DESARROLLO\s+URBANO", "DIVISIÓN DE DESARROLLO URBANO"), (r"D\s+VISI[ÓO?I�\s]+N", "DIVISIÓN"), (r"MINIST\s*RIO|IS\s+RIO", "MINISTERIO"),
):
    _SIGN = f"regexp_replace({_SIGN}, '(?i)(^|{_NB})(?:{_p})({_NB}|$)', '\\1{_r}\\{2 if '(D' not in _p else 3}', 'g')"
_SIGN = f"regexp_replace(regexp_replace({_SIGN}, '(^|{_NB})DIVISI[ÓO?I�\\s]+N({_NB}|$)', '\\1DIVISIÓN\\2', 'g'), '(^|{_NB})Divisi[ÓOóo?I�\\s]+[Nn]({_NB}|$)', '\\1División\\2', 'g')"


@query("signer_text_repair", f"SELECT circular_id, {_SIGN} AS firmante FROM circulares")
def _(spark, sf_dir):
    return circ(spark, sf_dir, "firmante").select("circular_id", T.fix_signer(F.col("firmante")).alias("firmante"))


_YEARS = """(SELECT circular_id, CASE circular_id % 4 WHEN 0 THEN y WHEN 1 THEN replace(y, '0', 'o') WHEN 2 THEN replace(replace(y, '1', 'l'), '6', 'b') ELSE replace(replace(y, '20', '23'), '2', '2') END AS anio
  FROM (SELECT circular_id, substr(fecha, 1, 4) AS y FROM circulares WHERE fecha IS NOT NULL))"""


@query(
    "year_digit_repair",
    f"""SELECT circular_id, anio, CASE WHEN length(anio) = 4 AND starts_with(anio, '2') THEN '2' || CASE WHEN anio[2] IN ('3', 'o', 'O', 'Q', 'b') THEN '0' ELSE anio[2] END
      || CASE WHEN anio[3] IN ('2', 'l', 'I', '|') THEN '2' ELSE anio[3] END
      || CASE WHEN anio[4] = 'b' OR (anio[4] IN ('5', '3') AND (anio[2] IN ('3', 'o', 'O', 'Q', 'b') OR anio[3] IN ('l', 'I'))) THEN '6' ELSE anio[4] END
      ELSE anio END AS reparado FROM {_YEARS}""",
)
def _(spark, sf_dir):
    """Years of issue as scanners misread them."""
    y, k = F.substring("fecha", 1, 4), F.col("circular_id") % 4
    r = lambda c, a, b: F.replace(c, F.lit(a), F.lit(b))
    read = F.when(k == 0, y).when(k == 1, r(y, "0", "o")).when(k == 2, r(r(y, "1", "l"), "6", "b")).otherwise(r(y, "20", "23"))
    return circ(spark, sf_dir, "fecha").where("fecha is not null").select("circular_id", read.alias("anio")).withColumn("reparado", dates.fix_year(F.col("anio")))


_NUMERAL = "line"
for _p, _r in ((r"^([0-9]+)\s+\.\s*", r"\1. "), (r"^[l|]\.\s+", "1. "), (r"^[Ss§]\.\s+", "5. "), (r"^B\.\s+", "8. "), (r"^Z\.\s+", "2. ")):
    _NUMERAL = f"regexp_replace({_NUMERAL}, {S.q(_p)}, {S.q(_r)})"


@query("numeral_prefix_repair", _L + f" SELECT doc_id, line_no, {_NUMERAL} AS line FROM l WHERE regexp_matches(line, '^(\\d+\\s*\\.|[l|SsBZ§]\\.)')")
def _(spark, sf_dir):
    rows = doc_lines(spark, sf_dir).where(F.col("line").rlike(r"^(\d+\s*\.|[l|SsBZ§]\.)"))
    return rows.select("doc_id", "line_no", T.numeral_prefix(F.col("line")).alias("line"))


# Calls: numbers apart behind the known phrases, then numbers glued to a word or closing mark, except behind the words whose number is none.
_CALLED = "cuerpo"
for _p, _n in (
    (r"n[°º]\s*97\s*/2007", 1), ("im[áa]genes", 2), (r"al\s+interior\s+de\s+un\s+predio", 3), (r"[áa]rea\s+verde", 3), (r"exigencias\s+y\s+efectos\s+aplicables", 5), (r"superficie\s+de\s+este", 7),
    (r"permiso\s+de\s+urbanizaci[óo]n\s+de\s+la\s+dom\)", 9), ("urbanizaci[óo]n", 10), (r"pendientes\)", 12), (r"2\.2\.1\.\s+de\s+la\s+oguc", 13), (r"subdivisi[óo]n\s+del\s+predio", 15), (r"permiso\s+de\s+la\s+dom", 16),
    (r"3\.1\.8\.\s+de\s+la\s+oguc", 18), ("p[úu]blico", 20), ("anteproyectos", 22), (r"a\s+trav[ée]s\s+de\s+servidumbres", 24), (r"presentados\s+a\s+la\s+dom", 26), (r"2\.2\.9\.?\s+de\s+la\s+oguc", 28),
    (r"de\s+ese\s+inciso", 30), (r"art[íi]culo\s+1\.1\.2\.", 31),
):
    _CALLED = f"regexp_replace({_CALLED}, '(?i)(^|{_NB})({_p})\\s+{_n}([.,;:\\s]|$)', '\\1\\2 [{_n}]\\3', 'g')"
for _p in (f"(^|{_NB})([{_LT}]{{3,}})", '()([)\\]”"»])'):
    _CALLED = f"regexp_replace({_CALLED}, '{_p}([0-9]{{1,2}})([;:\\s]|$)', '\\1\\2 [\\3]\\4', 'g')"
    _CALLED = f"regexp_replace({_CALLED}, '{_p}([0-9]{{1,2}})([.,])([^0-9]|$)', '\\1\\2 [\\3]\\4\\5', 'g')"
_CALLED = f"regexp_replace({_CALLED}, '(?i)(^|{_NB})(artículo|ley|decreto|año|punto|letra|numeral|página|n|no|ds|ddu|ord|bis|inciso|párrafo|tabla|figura) \\[([0-9]{{1,2}})\\]', '\\1\\2\\3', 'g')"


@query("footnote_call_format", f"SELECT circular_id, {_CALLED} AS cuerpo FROM circulares WHERE cuerpo IS NOT NULL")
def _(spark, sf_dir):
    return circ(spark, sf_dir, "cuerpo").where("cuerpo is not null").select("circular_id", T.note_calls(F.col("cuerpo")).alias("cuerpo"))


_SECTION = r"^([IVXLCDMivxlcdm]+|l+|[0-9]+)\.\s+(.+)$"


@query(
    "roman_numeral_repair",
    _L + f""", s AS (SELECT doc_id, line_no, regexp_extract(line, {S.q(_SECTION)}, 1) AS p, regexp_extract(line, {S.q(_SECTION)}, 2) AS t FROM l WHERE regexp_matches(line, {S.q(_SECTION)})),
    r AS (SELECT doc_id, line_no, CASE WHEN {S.rx('t', '[IÍ]NDICE|TABLA' + chr(92) + 's+DE' + chr(92) + 's+CONTENIDO')} OR contains(t, '....') OR coalesce({S.upper_share('t')}, 0) < 0.65 THEN NULL
      WHEN regexp_matches(upper(p), '^(I{{1,3}}|IV|VI{{0,3}}|IX|XI{{0,2}})$') THEN upper(p) WHEN lower(p) IN ('l', '1') THEN 'I' WHEN lower(p) IN ('11', 'll', '1l', 'l1') THEN 'II'
      WHEN lower(p) IN ('111', 'lll') THEN 'III' END AS n FROM s)
    SELECT doc_id, line_no, n || '.' AS romano FROM r WHERE n IS NOT NULL""",
)
def _(spark, sf_dir):
    l = F.col("line")
    rows = doc_lines(spark, sf_dir).where(l.rlike(_SECTION))
    return rows.select("doc_id", "line_no", T.roman_numeral(F.regexp_extract(l, _SECTION, 1), F.regexp_extract(l, _SECTION, 2)).alias("romano")).where("romano is not null")


_OPENER = (
    r"^((?:[a-záéíó]|[ivx]{1,4})\)\s+|[a-záéíó]\.\s+|[0-9]+[.)]\s+|[-•*]\s+|por\s+la\s+siguiente:|reempl[aá]zase|mediante\s+circular|se\s+deja\s+sin\s+efecto|lo\s+anterior|en\s+el\s+mismo\s+contexto"
    r"|luego,\s+el\s+art[ií]culo|a\s+su\s+vez,\s+el\s+primer|luego,\s+el\s+inciso|«art[ií]culo\s+134|el\s+art[ií]culo\s+1\.1\.2\.|“?5\.\s+obras\s+de)"
)


@query(
    "table_cell_text",
    f"""WITH a AS (SELECT circular_id, string_split({_words_sql("coalesce(notas_al_pie, '')")}, chr(10)) AS r FROM circulares), b AS (SELECT circular_id, list_filter(list_transform(r, lambda x: {S.strip('x')}), lambda x: x <> '') AS r FROM a)
    SELECT circular_id, {S.strip("regexp_replace(array_to_string(list_transform(r, lambda x, i: CASE WHEN i = 1 THEN x WHEN regexp_matches(x, " + S.q("(?i)" + _OPENER) + ") THEN chr(10) || x ELSE ' ' || x END), ''), ' +', ' ', 'g')")} AS celda FROM b""",
)
def _(spark, sf_dir):
    """Cells as the lines of the notes: joined, but for lines that open a block."""
    return circ(spark, sf_dir, "notas_al_pie").select("circular_id", T.cell_text(F.col("notas_al_pie")).alias("celda"))


_MODS = _words_sql(S.strip("modificaciones_posteriores"))
for _a, _b in (("en Joteos", "en loteos"), ("/as plantaciones", "las plantaciones"), ("iluminacin.", "iluminación,"), ("iluminación.", "iluminación,"), ("correspondientes. como", "correspondientes, como")):
    _MODS = f"replace({_MODS}, '{_a}', '{_b}')"
_MODS = rf"""regexp_replace(regexp_replace({_MODS}, '[''"]+Urbanizar[''"]+:', '“«Urbanizar»:', 'g'), '(?i)cuando\s*\n+\s*un\s+proyecto', 'cuando un proyecto', 'g')"""
_MODS = rf"regexp_replace({_MODS}, '([^\n])\s+([0-9]+\.\s|Lo\s+anterior|En\s+el\s+mismo\s+contexto|Luego,\s+el\s+art[ií]culo|A\s+su\s+vez,\s+el\s+primer|Luego,\s+el\s+inciso|«Art[ií]culo\s+134|El\s+art[ií]culo\s+1\.1\.2\.|“?5\.\s+Obras\s+de)', '\1' || chr(10) || chr(10) || '\2', 'g')"


@query("modification_cell_format", f"SELECT circular_id, array_to_string(list_filter(list_transform(string_split({_MODS}, chr(10)), lambda x: {S.strip('x')}), lambda x: x <> ''), chr(10) || chr(10)) AS celda FROM circulares")
def _(spark, sf_dir):
    return circ(spark, sf_dir, "modificaciones_posteriores").select("circular_id", T.modification_cell(F.col("modificaciones_posteriores")).alias("celda"))


_SINGULAR = f"""CASE WHEN NOT regexp_matches(w, '^[a-z0-9]+$') OR regexp_matches(w, '^({T.NO_SINGULAR})$') OR NOT ends_with(w, 's') THEN w WHEN ends_with(w, 'ces') THEN regexp_replace(w, 'ces$', 'z')
 WHEN regexp_matches(w, '^.+[bcdfghjklmnpqrstvwxyz]es$') AND length(w) > 3 THEN regexp_replace(w, 'es$', '') ELSE regexp_replace(w, 's$', '') END"""


def _uri_sql(x: str) -> str:
    t = f"regexp_replace(translate(regexp_replace(lower({x}), '\\s*,\\s*', '_', 'g'), {S.q(T.ACCENTED)}, {S.q(T.BASE)}), '[^a-z0-9\\s_-]', '', 'g')"
    t = f"array_to_string(list_transform(regexp_extract_all({t}, '[a-z0-9_]+|[^a-z0-9_]+'), lambda w: {_SINGULAR}), '')"
    for p, r in ((r"\s+", "-"), ("-+", "-"), ("_+", "_"), ("-_|_-", "_"), ("^[-_]+|[-_]+$", "")):
        t = f"regexp_replace({t}, {S.q(p)}, {S.q(r)}, 'g')"
    return t


@query(
    "uri_normalize",
    f"""SELECT DISTINCT n AS nombre, {_uri_sql('n')} AS uri FROM (SELECT emisor AS n FROM circulares UNION ALL SELECT destinatarios FROM circulares UNION ALL SELECT n_name FROM nation
      UNION ALL SELECT r_name FROM region UNION ALL SELECT c_name FROM customer) WHERE n IS NOT NULL""",
)
def _(spark, sf_dir):
    c = circ(spark, sf_dir, "emisor", "destinatarios")
    names = c.select(F.col("emisor").alias("nombre")).unionByName(c.select(F.col("destinatarios").alias("nombre")))
    for t, col in (("nation", "n_name"), ("region", "r_name"), ("customer", "c_name")):
        names = names.unionByName(table(spark, sf_dir, t, col).select(F.col(col).alias("nombre")))
    return names.where("nombre is not null").distinct().select("nombre", T.uri_name(F.col("nombre")).alias("uri"))


@query("xml_escape", "SELECT doc_id, md5(replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&apos;')) AS huella FROM documents WHERE text IS NOT NULL")
def _(spark, sf_dir):
    return docs(spark, sf_dir).where("text is not null").select("doc_id", F.md5(T.xml_escape(F.col("text"))).alias("huella"))


@query("turtle_escape", "SELECT doc_id, md5(replace(replace(text, '\\', '\\\\'), '\"', '\\\"')) AS huella FROM documents WHERE text IS NOT NULL")
def _(spark, sf_dir):
    return docs(spark, sf_dir).where("text is not null").select("doc_id", F.md5(T.turtle_escape(F.col("text"))).alias("huella"))


# -- dates, numbers, defaults

_MONTHS = "CASE lower(m) " + " ".join(f"WHEN '{k}' THEN '{v:02d}'" for k, v in casts.MONTHS.items()) + " ELSE '01' END"
_LONG, _NUM = dates.LONG.replace(r"\d", "[0-9]"), dates.NUMERIC.replace(r"\d", "[0-9]")


@query(
    "spanish_date_parse",
    f"""WITH t AS (SELECT circular_id, modificaciones_posteriores AS x, regexp_extract(modificaciones_posteriores, {S.q(_LONG)}, 2) AS m FROM circulares WHERE modificaciones_posteriores IS NOT NULL)
    SELECT circular_id, CASE WHEN regexp_matches(x, {S.q(_LONG)}) THEN regexp_extract(x, {S.q(_LONG)}, 3) || '-' || {_MONTHS} || '-' || lpad(regexp_extract(x, {S.q(_LONG)}, 1), 2, '0')
      WHEN regexp_matches(x, {S.q(_NUM)}) THEN regexp_extract(x, {S.q(_NUM)}, 3) || '-' || regexp_extract(x, {S.q(_NUM)}, 2) || '-' || regexp_extract(x, {S.q(_NUM)}, 1) ELSE '0000-00-00' END AS fecha FROM t""",
)
def _(spark, sf_dir):
    return circ(spark, sf_dir, "modificaciones_posteriores").where("modificaciones_posteriores is not null").select("circular_id", dates.spanish_to_iso(F.col("modificaciones_posteriores")).alias("fecha"))


_NAMES = "CASE p[2] " + " ".join(f"WHEN '{n:02d}' THEN '{name}'" for n, name in sorted(dates.NAMES.items())) + " ELSE 'de' END"


@query(
    "spanish_date_format",
    f"""WITH t AS (SELECT circular_id, fecha, string_split(fecha, '-') AS p FROM circulares WHERE fecha IS NOT NULL)
    SELECT circular_id, CASE WHEN len(p) = 3 THEN coalesce(try_cast(p[3] AS INT)::VARCHAR, p[3]) || ' de ' || {_NAMES} || ' de ' || p[1] ELSE fecha END AS legible FROM t""",
)
def _(spark, sf_dir):
    return circ(spark, sf_dir, "fecha").where("fecha is not null").select("circular_id", dates.iso_to_spanish(F.col("fecha")).alias("legible"))


@query(
    "numero_normalize",
    """SELECT circular_id, CASE WHEN trim(numero) = '' THEN CASE WHEN a <> '' THEN 'DDU ' || a ELSE '' END WHEN starts_with(upper(trim(numero)), 'DDU') THEN trim(numero) ELSE 'DDU ' || trim(numero) END AS numero
    FROM (SELECT circular_id, coalesce(numero, '') AS numero, coalesce(regexp_extract(archivo, '([0-9]+)', 1), '') AS a FROM circulares)""",
)
def _(spark, sf_dir):
    n, a = F.trim(F.coalesce("numero", F.lit(""))), F.coalesce(F.regexp_extract("archivo", "([0-9]+)", 1), F.lit(""))
    fixed = F.when(n == "", F.when(a != "", F.concat(F.lit("DDU "), a)).otherwise("")).when(F.upper(n).startswith("DDU"), n).otherwise(F.concat(F.lit("DDU "), n))
    return circ(spark, sf_dir, "numero", "archivo").select("circular_id", fixed.alias("numero"))


@query("default_coalesce", f"SELECT circular_id, coalesce(nullif(emisor, ''), {S.q(fields.DEFAULT_ISSUER)}) AS emisor, coalesce(nullif(lugar, ''), {S.q(fields.DEFAULT_PLACE)}) AS lugar FROM circulares")
def _(spark, sf_dir):
    return circ(spark, sf_dir, "emisor", "lugar").select(
        "circular_id", F.coalesce(F.nullif("emisor", F.lit("")), F.lit(fields.DEFAULT_ISSUER)).alias("emisor"), F.coalesce(F.nullif("lugar", F.lit("")), F.lit(fields.DEFAULT_PLACE)).alias("lugar")
    )


@query("issue_date_compose", "SELECT circular_id, CASE WHEN coalesce(lugar, '') <> '' AND coalesce(fecha, '') <> '' THEN lugar || ', ' || fecha ELSE coalesce(nullif(fecha, ''), nullif(lugar, ''), '') END AS fecha_emision FROM circulares")
def _(spark, sf_dir):
    parts = F.concat_ws(", ", F.nullif("lugar", F.lit("")), F.nullif("fecha", F.lit("")))
    return circ(spark, sf_dir, "lugar", "fecha").select("circular_id", parts.alias("fecha_emision"))


@query(
    "issue_date_split",
    f"""SELECT file, row_no, CASE WHEN contains(v, ',') THEN {S.strip("regexp_replace(v, '(?s)^[^,]*,', '')")} ELSE v END AS fecha, CASE WHEN contains(v, ',') THEN {S.strip("split_part(v, ',', 1)")} ELSE 'Santiago' END AS lugar
    FROM (SELECT file, row_no, valor_extraido AS v FROM eav WHERE campo = 'fecha_emision' AND valor_extraido IS NOT NULL)""",
)
def _(spark, sf_dir):
    v = F.col("valor_extraido")
    e = table(spark, sf_dir, "eav", "file", "row_no", "campo", "valor_extraido").where("campo = 'fecha_emision' and valor_extraido is not null")
    strip = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    return e.select("file", "row_no", F.when(v.contains(","), strip(F.regexp_replace(v, r"(?s)^[^,]*,", ""))).otherwise(v).alias("fecha"), F.when(v.contains(","), strip(F.regexp_extract(v, r"(?s)^([^,]*),", 1))).otherwise(F.lit("Santiago")).alias("lugar"))


# -- field extractors

_DDU = r"\bDDU\s*N?[°oº]?\s*([0-9]+)\b"


@query(
    "first_match_by_line",
    _L + f""", h AS (SELECT doc_id, arg_min(regexp_extract(line, {S.q('(?i)' + _DDU)}, 1), line_no) AS n FROM l WHERE line_no < 30 AND {S.rx('line', _DDU)} GROUP BY doc_id)
    SELECT d.doc_id, CASE WHEN coalesce(h.n, regexp_extract(d.text, {S.q('(?i)' + _DDU)}, 1), '') <> '' THEN 'DDU ' || coalesce(h.n, regexp_extract(d.text, {S.q('(?i)' + _DDU)}, 1)) ELSE '' END AS numero
    FROM documents d LEFT JOIN h USING (doc_id) WHERE d.text IS NOT NULL""",
)
def _(spark, sf_dir):
    d = with_lines(docs(spark, sf_dir).where("text is not null"))
    return d.select("doc_id", fields.number(F.col("text"), F.col("lines")).alias("numero"))


@query("last_match_by_line", _L + f" SELECT doc_id, arg_max(regexp_extract(line, {S.q('(?i)' + _DDU)}, 1), line_no) AS ultimo, max(line_no) AS linea FROM l WHERE {S.rx('line', _DDU)} GROUP BY doc_id")
def _(spark, sf_dir):
    hits = doc_lines(spark, sf_dir).where(rx(F.col("line"), _DDU))
    return hits.groupBy("doc_id").agg(F.max_by(F.regexp_extract("line", ci(_DDU), 1), "line_no").alias("ultimo"), F.max("line_no").alias("linea"))


def _field(name, build, sql=None):
    @query(name, sql)
    def run(spark, sf_dir):
        d = with_lines(docs(spark, sf_dir).withColumn("text", F.coalesce("text", F.lit(""))))
        got = build(F.col("text"), F.col("lines"))
        return d.select("doc_id", *([c.alias(n) for n, c in got.items()] if isinstance(got, dict) else [got.alias("valor")]))

    return run


# The act: misread ones among digits, then all digits behind the first mark of an order.
_ONES = "regexp_replace(line, '[\"'']', '', 'g')"
for _ in range(2):
    _ONES = f"regexp_replace({_ONES}, '(?i)([0-9_\\s°º?])l([0-9_\\s°º?,/-]|$)', '\\11\\2', 'g')"
_ONES = f"regexp_replace({_ONES}, '(?i)^l([0-9_\\s°º?,/-])', '1\\1')"
for _ in range(2):
    _ONES = f"regexp_replace({_ONES}, '(\\s)[I|](\\s)', '\\11\\2', 'g')"
_ORD = r"(?i)(?:CIRCULAR\s+)?(?:ORD|ORO|OR0|OR)\.?\s*(?:N[°oº?\s_-]*\s*)?([0-9\s_lI|·,°º.;~''/-]+)"
_DIGITS = "regexp_replace({}, '[^0-9]', '', 'g')"
_field(
    "ord_number", fields.ord_number,
    _L + f""", o AS (SELECT doc_id, line_no, {_ONES} AS line FROM l WHERE line_no < 25 AND regexp_matches(line, '(?i)(^|[^\\p{{L}}\\p{{N}}_])(CIRCULAR\\s+)?(ORD|ORO|OR0|OR)([^\\p{{L}}\\p{{N}}_]|$)')),
    n AS (SELECT doc_id, line_no, coalesce(nullif({_DIGITS.format(f"regexp_extract(line, '{_ORD}', 1)")}, ''), {_DIGITS.format('line')}) AS d FROM o),
    f AS (SELECT doc_id, arg_min(d, line_no) AS d FROM n WHERE d <> '' GROUP BY doc_id),
    t AS (SELECT doc_id, {_DIGITS.format(_ONES.replace('line', f"regexp_extract(substring(coalesce(text, ''), 1, 1500), '{_ORD}', 1)"))} AS d FROM documents)
    SELECT doc_id, CASE WHEN coalesce(f.d, t.d) <> '' THEN 'CIRCULAR ORD. N° ' || coalesce(f.d, t.d) ELSE '' END AS valor FROM t LEFT JOIN f USING (doc_id)""",
)
_KEYWORDS = r"regexp_matches(line, '^[\p{Lu}0-9\s;]{3,}(,\s*[\p{Lu}0-9\s;]{3,})+\.?$')"
_STOPS = r"DE\s*:|DE\s+(JEFE|MINISTRO|DIRECTOR|DIVISI[ÓOóo]N)\b|A\s*:|A\s+SEG[ÚUúu]N\b|(SANTIAGO|VALPARA[ÍIíi]SO|CONCEPCI[ÓOóo]N|I\.)\b"


def _block_sql(start: str, stop: str, most: int, which: str) -> str:
    """Blocks between blank and stop lines, each from its first opening line; the first or last of them."""
    return _L + f""", m AS (SELECT doc_id, line_no, line, line = '' OR {stop} AS b, regexp_matches(line, '{start}') AS s FROM l WHERE line_no < {most}),
    g AS (SELECT *, sum(b::INT) OVER (PARTITION BY doc_id ORDER BY line_no) AS isla FROM m),
    o AS (SELECT doc_id, isla, min(line_no) AS de FROM g WHERE s AND NOT b GROUP BY 1, 2), c AS (SELECT doc_id, {which}(isla) AS isla FROM o GROUP BY 1),
    t AS (SELECT doc_id, string_agg(CASE WHEN line_no = de THEN regexp_extract(line, '{start}', 1) ELSE line END, ' ' ORDER BY line_no) AS v FROM g JOIN o USING (doc_id, isla) JOIN c USING (doc_id, isla) WHERE line_no >= de AND NOT b GROUP BY 1)
    """


_field("block_capture_last", fields.background, _block_sql(r"(?i)^(?:ANT|ANTECEDENTES)[\s.:]+(.+)$", r"regexp_matches(line, '(?i)^((MAT|MATERIA)\.?(\s*:\s*|\s+)|CIRCULAR\b|" + _STOPS + ")') OR " + _KEYWORDS, 60, "max") + f"SELECT d.doc_id, coalesce({S.squeeze('v')}, '') AS valor FROM documents d LEFT JOIN t USING (doc_id)")
_ENDING = r"regexp_replace(regexp_replace({}, '([a-zA-ZáéíóúÁÉÍÓÚñÑ]{{3,}})\s+(s|S|os|as|mo|ren)([^\p{{L}}\p{{N}}_]|$)', '\1\2\3', 'g'), '\s+([,.:;])', '\1', 'g')"
_field("block_capture_first", fields.subject, _block_sql(r"(?i)^(?:MAT|MATERIA)\s*[.:]+\s*(.+)$", r"regexp_matches(line, '(?i)^((ANT|ANTECEDENTES)\.?(\s*:\s*|\s+)|" + _STOPS + ")') OR " + _KEYWORDS + f" OR {_DESC_START}", 50, "min") + f"SELECT d.doc_id, coalesce({S.strip(_ENDING.format(S.squeeze('v')))}, '') AS valor FROM documents d LEFT JOIN t USING (doc_id)")
_LABELLED = r"(?i)^(?:DESCRIPTORES|VOCABLOS|PALABRAS\s+CLAVE)\.?(?:\s*:\s*|\s+)(.+)$"
_field(
    "descriptor_lines", fields.descriptors,
    _L + rf""", b AS (SELECT doc_id, max(line_no) + 1 AS de FROM l WHERE line_no < 15 AND regexp_matches(line, '(?i)^(MAT\s*:|ANT\s*:|CIRCULAR\s+ORD|DDU\s+[0-9]+|ORD\b)') GROUP BY 1),
    c AS (SELECT l.doc_id, line_no, line, regexp_matches(line, '{_LABELLED}') OR {_DESC_LINE} AS toma, regexp_matches(line, '(?i)^(DE\s+(JEFE|MINISTRO|SUBSECRETARI|DIRECTOR|SECRETARI|DIVISI[ÓOóo]N)|DE\s*:|A\s*:|SANTIAGO|VALPARA[ÍIíi]SO)') AS fin
      FROM l LEFT JOIN b USING (doc_id) WHERE line_no >= coalesce(de, 0) AND line_no < 35 AND line <> ''),
    p AS (SELECT doc_id, min(line_no) AS p FROM c WHERE toma GROUP BY 1), f AS (SELECT doc_id, min(line_no) AS f FROM c JOIN p USING (doc_id) WHERE NOT toma AND fin AND line_no > p GROUP BY 1),
    t AS (SELECT doc_id, string_agg(CASE WHEN regexp_matches(line, '{_LABELLED}') THEN trim(regexp_extract(line, '{_LABELLED}', 1)) ELSE line END, ' ' ORDER BY line_no) AS v FROM c LEFT JOIN f USING (doc_id) WHERE toma AND line_no < coalesce(f, 99) GROUP BY 1)
    SELECT d.doc_id, coalesce({S.squeeze('v')}, '') AS valor FROM documents d LEFT JOIN t USING (doc_id)""",
)
_field("date_place_extract", fields.date_and_place)
_TO = r"(?i)^(?:A(?:\s|:)|PARA\s*:)\s*:?\s*(.+)$"
_LATE = "coalesce(trim(regexp_extract(substring(coalesce(text, ''), 1, 1500), {}, 1)), '')"
_field(
    "recipient_line", fields.recipient,
    _L + rf""", h AS (SELECT doc_id, arg_min(regexp_extract(line, '{_TO}', 1), line_no) AS v FROM l WHERE line_no < 40 AND regexp_matches(line, '{_TO}') AND NOT regexp_matches(regexp_extract(line, '{_TO}', 1), '(?i)^\s*LA\s+FECHA') GROUP BY 1),
    t AS (SELECT doc_id, {S.strip(_LATE.format("'(?i)" + chr(92) + "b(?:A|PARA)" + chr(92) + "s*:" + chr(92) + "s*([^" + chr(92) + "n]+)'"))} AS x FROM documents)
    SELECT doc_id, {S.squeeze("coalesce(nullif(v, ''), CASE WHEN regexp_matches(x, '(?i)^LA" + chr(92) + "s+FECHA') THEN '' ELSE x END)")} AS valor FROM t LEFT JOIN h USING (doc_id)""",
)
_FROM_SQL = r"CASE WHEN regexp_matches(line, '(?i)^DE\s*:\s*.+$') THEN regexp_extract(line, '(?i)^DE\s*:\s*(.+)$', 1) WHEN regexp_matches(line, '(?i)^DE\s+(JEFE|MINISTRO|SUBSECRETARI[OA]|DIRECTOR|DIVISI[ÓOóo]N)\b') THEN regexp_extract(line, '(?i)^DE\s+(.+)$', 1) END"
_field(
    "issuer_line", fields.issuer,
    _L + rf""", h AS (SELECT doc_id, arg_min({_FROM_SQL}, line_no) AS v FROM l WHERE line_no < 40 AND {_FROM_SQL} IS NOT NULL GROUP BY 1),
    t AS (SELECT doc_id, {_LATE.format("'(?i)" + chr(92) + "bDE" + chr(92) + "s*:" + chr(92) + "s*([^" + chr(92) + "n]+)'")} AS x FROM documents)
    SELECT doc_id, {S.squeeze("regexp_replace(" + S.strip("coalesce(nullif(v, ''), x)") + ", '" + chr(92) + ".$', '')")} AS valor FROM t LEFT JOIN h USING (doc_id)""",
)
_FLUSH = r"regexp_matches(line, '(?i)p[áa]gina\s+[0-9]+\s+de\s+[0-9]+|saluda\s+atent|distribuci[óo?i\s]+n|gobierno\s+de\s+chile|alameda\s+924')"
_OPENS = (
    r"(regexp_matches(line, '^[0-9]{1,2}\s+[A-ZÁÉÍÓÚÑ\"“”''‘’«(].+$') AND try_cast(regexp_extract(line, '^([0-9]{1,2})\s', 1) AS INT) BETWEEN 1 AND 60 AND NOT regexp_matches(line, '^[0-9]{1,2}\. ') AND NOT "
    + _w("^ [0-9]+ (o mas|para todas|y cumplan|de la (ley|lguc|oguc)|de (enero|febrero|marzo|abril|mayo|junio|julio|agosto|septiembre|setiembre|octubre|noviembre|diciembre)) ") + ")"
)
_field(
    "footnote_islands", fields.footnotes,
    _L + rf""", m AS (SELECT doc_id, line_no, line, {_FLUSH} AS c, {_OPENS} AS o FROM l WHERE line <> ''), g AS (SELECT *, sum((c OR o)::INT) OVER (PARTITION BY doc_id ORDER BY line_no) AS isla FROM m),
    n AS (SELECT doc_id, isla, string_agg(CASE WHEN o THEN regexp_replace(line, '^([0-9]{{1,2}})\s+', '\1 ') ELSE line END, ' ' ORDER BY line_no) AS t FROM g WHERE NOT c GROUP BY 1, 2 HAVING bool_or(o)),
    r AS (SELECT doc_id, isla, {_notes_sql('t')} AS t FROM n), t AS (SELECT doc_id, string_agg(t, ' | ' ORDER BY isla) FILTER (t <> '') AS t FROM r GROUP BY 1)
    SELECT d.doc_id, coalesce({_notes_sql('t.t')}, '') AS valor FROM documents d LEFT JOIN t USING (doc_id)""",
)
_NOTES = [r"Circular\s+Modificada\s+por", r"Dejada\s+sin\s+efecto\s+por\s+Circular", r"Aclarada\s+por\s+Circular", r"Complementada\s+por\s+Circular"]
_field(
    "amendment_notes", fields.amendments,
    "WITH r AS (SELECT doc_id, " + _REPAIRED + """ AS t FROM documents), b AS (SELECT doc_id, t, regexp_extract(t, '(?i)(Circular\\s+Modificada\\s+por\\s*Circular\\s+Ord\\.?\\s*N[°º?]?\\s*[0-9]+[^\\n]*(?:\\n[^\\n]*){0,4}\\bDDU\\s*[0-9]+[^\\n]*(?:\\s*\\([^)]+\\))?)', 1) AS blk FROM r),
    n AS (SELECT doc_id, """ + S.squeeze("blk") + " AS blk, list_concat(" + ", ".join(f"regexp_extract_all(t, '(?i)({p}\\b[^\\n]+)', 1)" for p in _NOTES).replace("list_concat(", "") + """) AS l FROM b),
    u AS (SELECT doc_id, blk, list_transform(l, lambda x: """ + S.squeeze("x") + """) AS l FROM n)
    SELECT doc_id, coalesce(CASE WHEN blk <> '' THEN blk ELSE array_to_string(list_filter(list_reverse(list_distinct(list_reverse(l))), lambda x: x <> ''), '; ') END, '') AS valor FROM u""",
)
_field("signer_fields", signer.signer)
_field("distribution_items", lambda t, l: distribution.distribution(t, l))


@query(
    "islands_paragraphs",
    _C + """, m AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^[0-9]+\\.') THEN 1 ELSE 0 END) OVER (PARTITION BY circular_id ORDER BY line_no) AS par_no FROM l WHERE line <> '')
    SELECT circular_id, par_no::BIGINT AS par_no, string_agg(line, ' ' ORDER BY line_no) AS parrafo, count(*) AS lineas FROM m GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    rows = explode_lines(circ(spark, sf_dir, "cuerpo"), "circular_id", "cuerpo")
    return body.simple_paragraphs(rows, "circular_id")


@query("body_sections")
def _(spark, sf_dir):
    return body.sections(with_lines(docs(spark, sf_dir)))


# Flat bodies: a mark (character 1) before each section title, then (character 2) before each numeral that opens a sentence.
_TITLE_AT = r"[IVX]+\.\s+[A-ZÁÉÍÓÚÑ\s0-9]+\s*:"


def _segments_sql(x: str) -> str:
    """A list of ``{t: title, p: paragraphs}``."""
    blocks = rf"list_filter(list_transform(string_split(regexp_replace({x}, '(\||\n|^)\s*({_TITLE_AT})', chr(1) || '\2', 'g'), chr(1)), lambda b: {S.strip('b')}), lambda b: b <> '')"
    rest = S.strip(f"regexp_replace(b, '^({_TITLE_AT})', '')")
    pars = rf"list_filter(list_transform(regexp_split_to_array(regexp_replace({rest}, '([.:)|]\s)([0-9]{{1,2}}\.\s+[A-ZÁÉÍÓÚÑa-z])', '\1' || chr(2) || '\2', 'g'), '\n+|\x02'), lambda q: {S.strip('q')}), lambda q: q <> '')"
    title = S.strip(f"regexp_extract(b, '^({_TITLE_AT})', 1)")
    return f"list_transform({blocks}, lambda b: {{'t': {title}, 'p': {pars}}})"


@query(
    "csv_body_resegment",
    f"""WITH s AS (SELECT circular_id, {_segments_sql('cuerpo')} AS s FROM circulares WHERE coalesce({S.strip('cuerpo')}, '') <> ''), e AS (SELECT circular_id, generate_subscripts(s, 1)::INT AS seccion, unnest(s) AS x FROM s)
    SELECT circular_id, seccion, x.t AS titulo, len(x.p)::INT AS parrafos, array_to_string(x.p, ' | ') AS texto FROM e""",
)
def _(spark, sf_dir):
    """Sections of every flat body with their paragraphs."""
    rows = circ(spark, sf_dir, "cuerpo").select("circular_id", F.posexplode(body.resegment(F.col("cuerpo"))).alias("i", "s"))
    return rows.select("circular_id", (F.col("i") + 1).alias("seccion"), F.col("s.titulo").alias("titulo"), F.size("s.parrafos").alias("parrafos"), F.array_join("s.parrafos", " | ").alias("texto"))


@query("extractor_registry")
def _(spark, sf_dir):
    return registry.blocks(docs(spark, sf_dir))


@query("circular_records")
def _(spark, sf_dir):
    """The record of every document: all fields, manifests, sections and body."""
    return registry.records(docs(spark, sf_dir))


@query("record_json")
def _(spark, sf_dir):
    return registry.records(docs(spark, sf_dir), with_body=False).select("doc_id", F.to_json(F.struct("*")).alias("json"))


# -- aggregations, pivots, manifests


@query("ordered_string_agg", _L + " SELECT doc_id, md5(string_agg(line, ' | ' ORDER BY line_no)) AS huella, count(*) AS lineas FROM l WHERE line <> '' GROUP BY doc_id")
def _(spark, sf_dir):
    rows = doc_lines(spark, sf_dir).where("line <> ''").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("a"), F.count("*").alias("lineas"))
    return rows.select("doc_id", F.md5(F.array_join(F.transform("a", lambda x: x["line"]), " | ")).alias("huella"), "lineas")


@query("distinct_sorted_set", "SELECT src_num, predicate, array_to_string(list_sort(list(DISTINCT dst_uri)), ', ') AS destinos FROM edges GROUP BY 1, 2")
def _(spark, sf_dir):
    return table(spark, sf_dir, "edges", "src_num", "predicate", "dst_uri").groupBy("src_num", "predicate").agg(F.array_join(F.array_sort(F.collect_set("dst_uri")), ", ").alias("destinos"))


@query(
    "ordered_distinct",
    "WITH f AS (SELECT file, campo, min(row_no) AS r FROM eav WHERE file IS NOT NULL AND campo IS NOT NULL GROUP BY 1, 2) SELECT file, string_agg(campo, ' | ' ORDER BY r, campo) AS campos FROM f GROUP BY file",
)
def _(spark, sf_dir):
    """Attributes of a file in order of their first row; reduced per attribute before they meet, so a huge file stays small."""
    first = table(spark, sf_dir, "eav", "file", "row_no", "campo").where("file is not null and campo is not null").groupBy("file", "campo").agg(F.min("row_no").alias("r"))
    return first.groupBy("file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "campo"))), lambda x: x["campo"]), " | ").alias("campos"))


_PIVOT = ", ".join(f"arg_max(v, row_no) FILTER (c = {S.q(c)}) AS {c}" for _, c, _ in eav.LAYOUT)


@query(
    "eav_pivot",
    f"WITH e AS (SELECT DISTINCT file, row_no, {S.strip('campo')} AS c, {S.strip('coalesce(valor_extraido, chr(32))')} AS v FROM eav) SELECT file, {_PIVOT} FROM e GROUP BY file",
)
def _(spark, sf_dir):
    return eav.pivot(table(spark, sf_dir, "eav", "file", "row_no", "campo", "valor_extraido"))


_UNPIVOT = " UNION ALL ".join(
    f"SELECT circular_id, {i}::INT AS orden, {S.q(b)} AS bloque, {S.q(c)} AS campo, "
    + (S.strip(f"coalesce({src}, '')") if src in ("numero", "numero_ord", "antecedentes", "materia", "descriptores", "destinatarios", "emisor", "cuerpo", "tablas_manifiesto", "modificaciones_posteriores", "notas_al_pie", "firmante") else "''")
    + " AS valor_extraido FROM circulares"
    for i, (b, c, src) in enumerate(eav.LAYOUT)
)


@query("eav_unpivot", _UNPIVOT)
def _(spark, sf_dir):
    cols = ("numero", "numero_ord", "antecedentes", "materia", "descriptores", "destinatarios", "emisor", "cuerpo", "tablas_manifiesto", "modificaciones_posteriores", "notas_al_pie", "firmante")
    return eav.unpivot(circ(spark, sf_dir, *cols), "circular_id")


@query("master_rows", "SELECT " + ", ".join((S.strip(f"coalesce({s}, '')") if s not in ("distribucion_texto",) else "''") + f" AS {c}" for c, s in eav.MASTER) + " FROM circulares")
def _(spark, sf_dir):
    cols = [s for _, s in eav.MASTER if s != "distribucion_texto"]
    return eav.master(circ(spark, sf_dir, *cols))


_FLAT = "tablas_manifiesto IS NOT NULL AND NOT starts_with(tablas_manifiesto, '[') AND NOT contains(tablas_manifiesto, '\"') AND NOT contains(tablas_manifiesto, chr(10)) AND NOT regexp_matches(tablas_manifiesto, '[^ |][|]|[|][^ |]')"


@query(
    "manifest_parse",
    f"""WITH b AS (SELECT circular_id, generate_subscripts(string_split(tablas_manifiesto, ' || '), 1)::INT AS n, unnest(string_split(tablas_manifiesto, ' || ')) AS t FROM circulares WHERE {_FLAT} AND trim(tablas_manifiesto) <> '')
    SELECT circular_id, n, trim(regexp_extract(t, '(?:^|; )id: ([^;]*)', 1)) AS id, trim(regexp_extract(t, '(?:^|; )nombre: ([^;]*)', 1)) AS nombre FROM b""",
)
def _(spark, sf_dir):
    flat = circ(spark, sf_dir, "tablas_manifiesto").where("tablas_manifiesto is not null and not startswith(tablas_manifiesto, '[') and not contains(tablas_manifiesto, '\"') and not contains(tablas_manifiesto, '\n') and not tablas_manifiesto rlike '[^ |][|]|[|][^ |]'")
    rows = flat.select("circular_id", F.posexplode(manifest.parse(F.col("tablas_manifiesto"))).alias("i", "m"))
    return rows.select("circular_id", (F.col("i") + 1).alias("n"), F.try_element_at("m", F.lit("id")).alias("id"), F.try_element_at("m", F.lit("nombre")).alias("nombre"))


@query(
    "manifest_format",
    """SELECT file, string_agg('campo: ' || campo || '; filas: ' || n, ' || ' ORDER BY campo) AS manifiesto FROM (SELECT file, campo, count(*) AS n FROM eav WHERE file IS NOT NULL AND campo IS NOT NULL GROUP BY 1, 2) GROUP BY file""",
)
def _(spark, sf_dir):
    n = table(spark, sf_dir, "eav", "file", "campo").where("file is not null and campo is not null").groupBy("file", "campo").agg(F.count("*").alias("filas"))
    items = n.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("campo", "filas"))).alias("a"))
    return items.select("file", manifest.format_structs(F.col("a"), ["campo", "filas"]).alias("manifiesto"))


# -- tables

# Cells of tables: the rows of an extraction file as rows of three cells, in pages of 20 rows; rows without a block go on with the row above.


def cell_rows(spark, sf_dir):
    """``(file, pagina, row_no, c0, c1, c2)`` from the attribute rows, exact repeats once."""
    e = table(spark, sf_dir, "eav", "file", "row_no", "bloque", "campo", "valor_extraido").where("file is not null and row_no is not null").distinct()
    text = lambda c: F.coalesce(F.trim(c), F.lit(""))
    return e.select("file", F.expr("row_no div 20").cast("int").alias("pagina"), "row_no", text("bloque").alias("c0"), text("campo").alias("c1"), text("valor_extraido").alias("c2"))


_CELLS = "SELECT DISTINCT file, (row_no // 20)::INT AS pagina, row_no, coalesce(trim(bloque), '') AS c0, coalesce(trim(campo), '') AS c1, coalesce(trim(valor_extraido), '') AS c2 FROM eav WHERE file IS NOT NULL AND row_no IS NOT NULL"


def _glued_sql(c: str, order: str = "row_no") -> str:
    """Pieces of a cell in order: a line end before a piece that has lines or a numeral, else a blank."""
    return f"coalesce(substr(string_agg(CASE WHEN contains({c}, chr(10)) OR regexp_matches({c}, '^[0-9]+\\.') THEN chr(10) ELSE ' ' END || {c}, '' ORDER BY {order}) FILTER ({c} <> ''), 2), '')"


@query(
    "table_subrow_merge",
    f"""WITH c AS ({_CELLS}), g AS (SELECT *, sum(CASE WHEN c0 <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY file, pagina ORDER BY row_no)::BIGINT AS grupo FROM c)
    SELECT file, pagina, grupo, {_glued_sql('c0')} AS c0, {_glued_sql('c1')} AS c1, {_glued_sql('c2')} AS c2 FROM g GROUP BY 1, 2, 3""",
)
def _(spark, sf_dir):
    return tables.merge_subrows_rows(cell_rows(spark, sf_dir), ["file", "pagina"], "row_no", ["c0", "c1", "c2"])


# Tables over two pages: the lines of an order behind a header, of which every third has no first cell; page 2 begins at the fourth line.
_ITEMS = """SELECT l_orderkey, n, CASE WHEN n % 3 = 0 OR n = 4 AND l_orderkey % 2 = 0 THEN '' ELSE 'pieza ' || l_partkey END AS c0, 'lugar ' || l_suppkey AS c1, 'estado ' || l_returnflag || l_linestatus AS c2,
  CASE WHEN n < 4 THEN 1 ELSE 2 END AS pagina FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus) AS n FROM lineitem)"""


@query(
    "table_page_merge",
    f"""WITH i AS ({_ITEMS}), g AS (SELECT *, sum(CASE WHEN c0 <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey ORDER BY n) AS grupo FROM i),
    f AS (SELECT l_orderkey, grupo, string_agg(c0, '') AS c0, string_agg(c1, ' ' ORDER BY n) AS c1, string_agg(c2, ' ' ORDER BY n) AS c2 FROM g GROUP BY 1, 2),
    p AS (SELECT l_orderkey, CASE WHEN max(pagina) = 2 THEN '1,2' ELSE '1' END AS paginas FROM i GROUP BY 1)
    SELECT f.l_orderkey, 'Circular, Materia, Motivo' AS encabezados, count(*)::INT AS filas, any_value(paginas) AS paginas, string_agg(c0 || ':' || c1 || ':' || c2, '; ' ORDER BY grupo) AS celdas
    FROM f JOIN p USING (l_orderkey) GROUP BY 1""",
)
def _(spark, sf_dir):
    cols = ("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    i = table(spark, sf_dir, "lineitem", "l_orderkey", *cols).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("x"))
    none = lambda n: (n % 3 == 0) | ((n == 4) & (F.col("l_orderkey") % 2 == 0))
    row = lambda x, k: F.array(F.when(none(k + 1), "").otherwise(F.concat_ws(" ", F.lit("pieza"), x["l_partkey"])), F.concat_ws(" ", F.lit("lugar"), x["l_suppkey"]), F.concat(F.lit("estado "), x["l_returnflag"], x["l_linestatus"]))
    rows = i.select("l_orderkey", F.transform("x", row).alias("f"))
    head = F.array(F.array(*[F.lit(x) for x in ("Circular", "Materia", "Motivo")]))
    page = lambda k, rows: F.struct(F.lit(k).alias("pagina"), rows.alias("filas"))
    parts = F.array(page(1, F.concat(head, F.slice("f", 1, 3))), page(2, F.slice("f", 4, 1000)))
    t = rows.select("l_orderkey", F.explode(tables.merge_pages(parts)).alias("t"))
    return t.select(
        "l_orderkey", F.array_join("t.encabezados", ", ").alias("encabezados"), F.size("t.filas").alias("filas"), F.array_join(F.col("t.paginas").cast("array<string>"), ",").alias("paginas"),
        F.array_join(F.transform("t.filas", lambda r: F.array_join(r, ":")), "; ").alias("celdas"),
    )


@query(
    "header_zip_merge",
    f"""WITH c AS ({_CELLS}), p AS (SELECT file, row_no, c0, c1, lead(c0) OVER w AS d0, lead(c1) OVER w AS d1 FROM c WINDOW w AS (PARTITION BY file, pagina ORDER BY row_no)),
    j AS (SELECT file, row_no, c0, c1, [CASE WHEN c0 <> '' AND d0 <> '' AND c0 <> d0 THEN c0 || ' ' || d0 WHEN c0 <> '' THEN c0 ELSE d0 END, CASE WHEN c1 <> '' AND d1 <> '' AND c1 <> d1 THEN c1 || ' ' || d1 WHEN c1 <> '' THEN c1 ELSE d1 END, ''] AS h FROM p WHERE d0 IS NOT NULL),
    o AS (SELECT *, CASE WHEN h[1] = '' AND h[2] = '' THEN [] WHEN h[2] = '' THEN [h[1]] ELSE [h[1], h[2]] END AS x FROM j)
    SELECT file, row_no, array_to_string(CASE WHEN len(x) > 0 THEN x ELSE list_filter([c0, c1, ''], lambda v: v <> '') END, '|') AS encabezados FROM o""",
)
def _(spark, sf_dir):
    """Each row of a page with the next one as two header rows; the third column has no name in either."""
    w = Window.partitionBy("file", "pagina").orderBy("row_no")
    rows = cell_rows(spark, sf_dir).select("file", "row_no", "c0", "c1", F.lead("c0").over(w).alias("d0"), F.lead("c1").over(w).alias("d1")).where("d0 is not null")
    return rows.select("file", "row_no", F.array_join(tables.joined_headers(F.array("c0", "c1", F.lit("")), F.array("d0", "d1", F.lit(""))), "|").alias("encabezados"))


@query(
    "column_collapse",
    """WITH c AS (SELECT circular_id, list_transform([numero, lugar, fuente, fecha, numero_ord], lambda x: CASE WHEN lower(trim(x)) = 'none' THEN '' ELSE coalesce(trim(x), '') END) AS r FROM circulares)
    SELECT circular_id, r[1] || '|' || trim(r[2] || ' ' || r[3]) || '|' || trim(r[4] || ' ' || r[5]) AS fila FROM c""",
)
def _(spark, sf_dir):
    five = F.array(F.array("numero", "lugar", "fuente", "fecha", "numero_ord"))
    return circ(spark, sf_dir, "numero", "lugar", "fuente", "fecha", "numero_ord").select("circular_id", F.array_join(F.get(tables.collapse_five(five), F.lit(0)), "|").alias("fila"))


@query("row_pad", _L + " SELECT doc_id, line_no, array_to_string(list_transform(range(1, 6), lambda i: coalesce(trim(string_split(line[2:-2], '|')[i]), '')), '~') AS fila FROM l WHERE line LIKE '|%|' AND length(line) > 1")
def _(spark, sf_dir):
    rows = doc_lines(spark, sf_dir).where("line like '|%|' and length(line) > 1")
    cells = F.transform(F.split(F.expr("substring(line, 2, length(line) - 2)"), r"\|", -1), lambda c: F.trim(c))
    return rows.select("doc_id", "line_no", F.array_join(tables.pad(cells, 5), "~").alias("fila"))


@query(
    "table_naming",
    """WITH c AS (SELECT circular_id, coalesce(materia, '') AS h, coalesce(modificaciones_posteriores, '') AS m, circular_id % 9 + 1 AS p, circular_id % 2 AS q FROM circulares),
    t AS (SELECT *, CASE circular_id % 5 WHEN 0 THEN 'Circular' WHEN 1 THEN 'MOTIVOS / CONSIDERACIONES' WHEN 2 THEN 'Modificaciones' WHEN 3 THEN 'TIPO DE GESTIÓN' ELSE 'Plazo' END AS k,
      '(Pág. ' || p || CASE WHEN q = 1 THEN '-' || (p + 1) ELSE '' END || ')' AS s FROM c)
    SELECT circular_id, CASE WHEN contains(h || ' ' || m, 'DDU 339') OR contains(h || ' ' || m, 'DDU 322') OR contains(h || ' ' || m, 'DDU 168') THEN 'Modificaciones Normativas (' || array_to_string(list_filter(['DDU 339', 'DDU 322', 'DDU 168'], lambda d: contains(h || ' ' || m, d)), ', ') || ')'
      WHEN regexp_matches(lower(k), 'motivos') OR contains(lower(h), 'dejan sin efecto') OR contains(lower(h), 'motivos') THEN 'Tabla de Circulares Dejadas sin Efecto ' || s
      WHEN k = 'Modificaciones' OR contains(lower(h), 'modificaciones') THEN 'Tabla de Circulares Modificadas ' || s WHEN k = 'TIPO DE GESTIÓN' OR contains(lower(h), 'tipo de gestión') THEN 'Tabla: TIPO DE GESTIÓN, CASOS QUE COMPRENDE: ' || s
      WHEN k = 'Circular' OR regexp_matches(lower(h), 'modifica|circular') THEN 'Tabla de Modificaciones Normativas ' || s ELSE 'Tabla: ' || k || ', ' || h || ' ' || s END AS nombre FROM t""",
)
def _(spark, sf_dir):
    """Tables with one known column, the subject as the other, and the notes of amendment as their cells."""
    k, p = F.col("circular_id") % 5, (F.col("circular_id") % 9 + 1).cast("int")
    name = F.when(k == 0, "Circular").when(k == 1, "MOTIVOS / CONSIDERACIONES").when(k == 2, "Modificaciones").when(k == 3, "TIPO DE GESTIÓN").otherwise("Plazo")
    pages = F.when(F.col("circular_id") % 2 == 1, F.array(p, p + 1)).otherwise(F.array(p))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    got = tables.table_name(F.array(name, text("materia")), F.array(F.array(text("modificaciones_posteriores"))), pages)
    return circ(spark, sf_dir, "materia", "modificaciones_posteriores").select("circular_id", got.alias("nombre"))


@query(
    "table_compact_markdown",
    """WITH c AS (SELECT circular_id, 'T' || circular_id AS t, 'v' || (circular_id * 7 % 1000) AS v, CASE WHEN num_ok THEN 'x' || length(numero) ELSE '' END AS x FROM (SELECT circular_id, numero, numero IS NOT NULL AND circular_id % 3 <> 0 AS num_ok FROM circulares))
    SELECT circular_id, '| ' || t || ' | B |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || v || ' | ' || x || ' |' || chr(10) || CASE WHEN x <> '' THEN '| ' || x || ' |  |' || chr(10) ELSE '' END || '| z | ' || v || ' |' AS markdown FROM c""",
)
def _(spark, sf_dir):
    """Tables of three columns of which the second has no name; a row without text is dropped, a row of two cells is put in order."""
    t, v = F.concat(F.lit("T"), F.col("circular_id").cast("string")), F.concat(F.lit("v"), (F.col("circular_id") * 7 % 1000).cast("string"))
    x = F.when(F.col("numero").isNotNull() & (F.col("circular_id") % 3 != 0), F.concat(F.lit("x"), F.length("numero").cast("string"))).otherwise("")
    none = F.lit(None).cast("string")
    rows = F.array(F.array(t, F.lit(""), F.lit("B")), F.array(v, F.lit("fuera"), x), F.array(none, none, none), F.array(x, F.lit(""), F.lit("")), F.array(F.lit("z"), v))
    return circ(spark, sf_dir, "numero").select("circular_id", tables.compact(rows)["markdown"].alias("markdown"))


@query(
    "markdown_table_scan",
    _L + """, r AS (SELECT *, line LIKE '|%|' AND length(line) > 1 AS p FROM l),
    g AS (SELECT *, line_no - row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS isla FROM r WHERE p),
    t AS (SELECT doc_id, isla, count(*) AS n, arg_min(line, line_no) AS cab FROM g GROUP BY 1, 2 HAVING count(*) >= 3 AND length(regexp_replace(arg_min(line, line_no), '[^|]', '', 'g')) >= 3)
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY isla) AS tabla, (length(regexp_replace(cab, '[^|]', '', 'g')) - 1)::INT AS columnas, (n - 2)::INT AS filas FROM t""",
)
def _(spark, sf_dir):
    d = with_lines(docs(spark, sf_dir).where("text like '%|%'"))
    rows = d.select("doc_id", F.posexplode(tables.markdown_tables(F.col("lines"))).alias("i", "t"))
    return rows.select("doc_id", (F.col("i") + 1).cast("bigint").alias("tabla"), F.size("t.encabezados").alias("columnas"), F.size("t.filas").alias("filas"))


@query("table_row_filters", _L + " SELECT doc_id, count(*) AS filas, count(*) FILTER (regexp_matches(line, '[^|\\s]')) AS con_texto, count(*) FILTER (length(regexp_replace(line, '[^|]', '', 'g')) > 2) AS anchas FROM l WHERE line LIKE '|%|' GROUP BY doc_id")
def _(spark, sf_dir):
    rows = doc_lines(spark, sf_dir).where("line like '|%|'")
    cells = F.transform(F.split(F.regexp_replace("line", r"^\||\|$", ""), r"\|", -1), lambda c: F.trim(c))
    n = lambda c: F.sum(c.cast("bigint"))
    return rows.withColumn("c", cells).groupBy("doc_id").agg(F.count("*").alias("filas"), n(tables.has_text(F.col("c"))).alias("con_texto"), n(F.size("c") > 1).alias("anchas"))


# -- graph

# The oracles of the citations are written out here.
_OGUC, _LGUC = r"(?:ordenanza\s+general\s+de\s+urbanismo\s+y\s+construcciones|oguc)\b", r"(?:(?:ley\s+general\s+de\s+urbanismo\s+y\s+construcciones|lguc|d\.f\.l\.\s*(?:n[°oº]\s*)?458(?:\s+de\s+1975)?|dfl\s*(?:n[°oº]\s*)?458)\b|l\.g\.u\.c\.)"
_CITE = (
    rf"(?i)\bart(?:[ií]c(?:ulo)?)?\.?\s+[0-9]+(?:\.[0-9]+){{2,}}\.?(?:\s+de(?:l|\s+la)\s+{_OGUC}|\b)|\bart(?:[ií]c(?:ulo)?)?\.?\s+[0-9]+(?:\s+(?:bis|ter|quater))?\.?\s+de(?:l|\s+la)\s+{_LGUC}"
    rf"|\b{_OGUC}|\b{_LGUC}"
)


@query(
    "citation_extract",
    f"""WITH c AS (SELECT doc_id, unnest(regexp_extract_all(text, {S.q(_CITE)})) AS cita FROM documents WHERE text IS NOT NULL) SELECT doc_id, {S.squeeze('cita')} AS cita, count(*) AS veces FROM c GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    c = docs(spark, sf_dir).where("text is not null").select("doc_id", F.explode_outer(G.citations(F.col("text"))).alias("cita")).where("cita is not null")
    return c.groupBy("doc_id", squeeze(F.col("cita")).alias("cita")).agg(F.count("*").alias("veces"))


_DOT, _PLAIN = r"(?i)^art\S*\s+([0-9]+\.[0-9]+\.[0-9]+(?:\.[0-9]+)*)", r"(?i)^art\S*\s+([0-9]+(?:\s+(?:bis|ter|quater))?)"
_URI = f"""CASE WHEN regexp_matches(h, {S.q(_DOT)}) THEN '{G.OGUC}/seccion/articulo-' || regexp_extract(h, {S.q(_DOT)}, 1)
 WHEN regexp_matches(h, {S.q(_PLAIN)}) THEN '{G.LGUC}/seccion/articulo-' || regexp_replace(lower(regexp_extract(h, {S.q(_PLAIN)}, 1)), '\\s', '-', 'g')
 WHEN regexp_matches(h, '(?i)^(OGUC|Ordenanza)') THEN '{G.OGUC}' ELSE '{G.LGUC}' END"""


@query("citation_uri_set", f"WITH c AS (SELECT doc_id, unnest(regexp_extract_all(text, {S.q(_CITE)})) AS h FROM documents WHERE text IS NOT NULL) SELECT doc_id, array_to_string(list_sort(list(DISTINCT {_URI})), ' ') AS uris FROM c GROUP BY doc_id")
def _(spark, sf_dir):
    d = docs(spark, sf_dir).where("text is not null").select("doc_id", G.uri_set(F.col("text")).alias("u"))
    return d.where("size(u) > 0").select("doc_id", F.array_join("u", " ").alias("uris"))


@query(
    "citation_inline_ref",
    f"""WITH t AS (SELECT doc_id, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(39), '&apos;') AS x FROM documents),
    p AS (SELECT doc_id, x, regexp_split_to_array(x, {S.q(_CITE)}) AS a, regexp_extract_all(x, {S.q(_CITE)}) AS c FROM t)
    SELECT doc_id, CASE WHEN x IS NOT NULL THEN array_to_string(list_transform(a, lambda v, i: v || CASE WHEN i <= len(c) THEN '<ref id="ref_' || i || '" href="' || list_transform([c[i]], lambda h: {_URI})[1] || '">' || c[i] || '</ref>' ELSE '' END), '') END AS texto FROM p""",
)
def _(spark, sf_dir):
    """Texts with their citations as references; a null text stays null."""
    return docs(spark, sf_dir).select("doc_id", G.with_references(T.xml_escape(F.col("text")), F.lit("ref")).alias("texto"))


_CITED = r"(?i)(?:circular\s+(?:ddu\s+)?|\bddu\s+)n?[°oº]?\s*[0-9]+\b"


@query(
    "circular_edges",
    f"""WITH c AS (SELECT doc_id, num, unnest(list_distinct(list_transform(regexp_extract_all(text, {S.q(_CITED)}), lambda h: try_cast(regexp_extract(h, '([0-9]+)$', 1) AS INT)))) AS dst FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, num AS src_num, dst AS dst_num FROM c WHERE dst IS NOT NULL AND (num IS NULL OR dst <> num)""",
)
def _(spark, sf_dir):
    d = docs(spark, sf_dir, "num").where("text is not null")
    rows = d.select("doc_id", F.col("num").alias("src_num"), F.explode_outer(G.cited_numbers(F.col("text"))).alias("dst_num"))
    return rows.where("dst_num is not null and (src_num is null or dst_num <> src_num)")


_AMEND = r"(?i)\b(?:circular\s+(?:ord\.?\s+)?(?:n[°oº]?\s*[0-9]+,?\s+de\s+fecha\s+[^,]+,\s+)?(?:ddu\s+)?|ddu\s+)[0-9]+\b"


@query(
    "amendment_edges",
    f"""WITH c AS (SELECT circular_id, try_cast(regexp_extract(numero, '([0-9]+)', 1) AS INT) AS src, unnest(list_distinct(list_transform(regexp_extract_all(modificaciones_posteriores, {S.q(_AMEND)}),
      lambda h: try_cast(regexp_extract(h, '([0-9]+)$', 1) AS INT)))) AS dst FROM circulares)
    SELECT circular_id, src AS src_num, dst AS dst_num FROM c WHERE dst IS NOT NULL AND (src IS NULL OR src <> dst)""",
)
def _(spark, sf_dir):
    e = G.edges(circ(spark, sf_dir, "numero", "modificaciones_posteriores").withColumn("vacio", F.lit("")), "circular_id", "numero", ["vacio"], "modificaciones_posteriores")
    return e.where("predicate = 'modificadaPor'").select("circular_id", "src_num", "dst_num")


@query(
    "amendment_info",
    f"""WITH t AS (SELECT circular_id, trim(modificaciones_posteriores) AS x, regexp_extract(modificaciones_posteriores, '(?i)\\bDDU\\s*([0-9]+)\\b', 1) AS n, regexp_extract(modificaciones_posteriores, '(?i)numeral\\s*([0-9]+)', 1) AS k,
      regexp_extract(trim(modificaciones_posteriores), {S.q(_LONG)}, 2) AS m FROM circulares WHERE modificaciones_posteriores IS NOT NULL)
    SELECT circular_id, n AS ddu_num, CASE WHEN regexp_matches(x, {S.q(_LONG)}) THEN regexp_extract(x, {S.q(_LONG)}, 3) || '-' || {_MONTHS} || '-' || lpad(regexp_extract(x, {S.q(_LONG)}, 1), 2, '0')
      WHEN regexp_matches(x, {S.q(_NUM)}) THEN regexp_extract(x, {S.q(_NUM)}, 3) || '-' || regexp_extract(x, {S.q(_NUM)}, 2) || '-' || regexp_extract(x, {S.q(_NUM)}, 1) ELSE '0000-00-00' END AS fecha,
      '#par_1_' || CASE WHEN k <> '' THEN k ELSE '1' END AS numeral_dest FROM t WHERE n <> ''""",
)
def _(spark, sf_dir):
    a = circ(spark, sf_dir, "modificaciones_posteriores").select("circular_id", G.amendment(F.col("modificaciones_posteriores")).alias("a")).where("a is not null")
    return a.select("circular_id", "a.ddu_num", "a.fecha", "a.numeral_dest")


@query(
    "edge_date_left_join",
    """WITH r AS (SELECT num, min(fecha) AS f FROM circular_registry WHERE fecha IS NOT NULL GROUP BY num)
    SELECT e.src_num, e.predicate, e.dst_num, coalesce(r.f, '0000-00-00') AS fecha, count(*) AS veces FROM edges e LEFT JOIN r ON e.dst_num = r.num WHERE e.dst_num IS NOT NULL GROUP BY 1, 2, 3, 4""",
)
def _(spark, sf_dir):
    """Equal edges are counted before the join, so a much cited circular is not one huge group."""
    e = table(spark, sf_dir, "edges", "src_num", "predicate", "dst_num").where("dst_num is not null").groupBy("src_num", "predicate", "dst_num").agg(F.count("*").alias("veces"))
    return G.dated(e, table(spark, sf_dir, "circular_registry", "num", "fecha"))


@query("self_exclusion", "SELECT src_num, dst_num, count(*) AS veces FROM edges WHERE dst_num <> src_num GROUP BY 1, 2")
def _(spark, sf_dir):
    return table(spark, sf_dir, "edges", "src_num", "dst_num").where("dst_num <> src_num").groupBy("src_num", "dst_num").agg(F.count("*").alias("veces"))


@query(
    "edge_uri_spellings",
    "SELECT dst_num, count(DISTINCT dst_uri) AS formas, count(*) AS citas, count(DISTINCT src_num) AS desde FROM edges WHERE dst_num IS NOT NULL GROUP BY dst_num",
)
def _(spark, sf_dir):
    e = table(spark, sf_dir, "edges", "src_num", "dst_num", "dst_uri").where("dst_num is not null")
    return e.groupBy("dst_num").agg(F.countDistinct("dst_uri").alias("formas"), F.count("*").alias("citas"), F.countDistinct("src_num").alias("desde"))


@query(
    "issuer_uri",
    f"""SELECT DISTINCT emisor, CASE WHEN contains(lower(emisor), 'desarrollo urbano') THEN '{G.ORGANISATION}/ministerio-de-vivienda-y-urbanismo/division-de-desarrollo-urbano'
      WHEN contains(lower(emisor), 'vivienda') THEN '{G.ORGANISATION}/ministerio-de-vivienda-y-urbanismo' ELSE '{G.ORGANISATION}/' || {_uri_sql('emisor')} END AS uri FROM circulares WHERE emisor IS NOT NULL""",
)
def _(spark, sf_dir):
    return circ(spark, sf_dir, "emisor").where("emisor is not null").select("emisor").distinct().select("emisor", G.issuer_uri(F.col("emisor")).alias("uri"))


# -- joins by geometry, dictionaries, sets

_BANDS = [("a", 0.0, 10.0), ("b", 10.0, 25.0), ("c", 25.0, 51.0)]


@query(
    "range_join_blocks",
    "SELECT b.k AS banda, count(*) AS filas, round(sum(l.l_extendedprice), 2) AS monto FROM lineitem l JOIN (VALUES ('a', 0.0, 10.0), ('b', 10.0, 25.0), ('c', 25.0, 51.0)) AS b(k, lo, hi) ON l.l_quantity BETWEEN b.lo AND b.hi GROUP BY 1",
)
def _(spark, sf_dir):
    """Rows placed in bands whose both ends count: a value on a shared edge lies in two bands. The bands are a few fixed rows."""
    l = table(spark, sf_dir, "lineitem", "l_quantity", "l_extendedprice")
    b = spark.createDataFrame(_BANDS, "banda string, lo double, hi double")
    return l.join(small(b), F.col("l_quantity").between(F.col("lo"), F.col("hi"))).groupBy("banda").agg(F.count("*").alias("filas"), F.round(F.sum("l_extendedprice"), 2).alias("monto"))


_BLOCKS = """SELECT doc_id, (line_no // 40)::INT AS page, line_no AS block_no, CASE WHEN line_no % 3 = 0 THEN 380.0 WHEN line_no % 7 = 0 THEN 100.0 ELSE 230.0 END AS x0, (line_no % 40) * 20.0 AS y0, 'l' || line_no AS t FROM l WHERE line <> '' AND line_no % 5 <> 4"""


@query(
    "block_placement",
    _L + f""", b AS ({_BLOCKS}), r AS (SELECT unnest(range(8)) AS k), d AS (SELECT DISTINCT doc_id, page FROM b),
    p AS (SELECT b.doc_id, b.page, 'r' || k AS row_key, CASE WHEN x0 + 50 BETWEEN 225 AND 322 THEN 'izquierda' WHEN x0 + 50 > 322 THEN 'derecha' END AS lado, block_no, t FROM b JOIN d USING (doc_id, page) JOIN r ON b.y0 BETWEEN k * 100.0 AND (k + 1) * 100.0)
    SELECT doc_id, page, row_key, lado, string_agg(t, ' ' ORDER BY block_no) AS texto, count(*) AS bloques FROM p WHERE lado IS NOT NULL GROUP BY 1, 2, 3, 4""",
)
def _(spark, sf_dir):
    """Lines of documents as text blocks (every fifth is none) placed in bands of 100 points that share their edges."""
    n = F.col("line_no")
    x0 = F.when(n % 3 == 0, 380.0).when(n % 7 == 0, 100.0).otherwise(230.0)
    y0 = (n % 40) * F.lit(20.0)
    blocks = doc_lines(spark, sf_dir).where("line <> ''").select(
        "doc_id", F.expr("line_no div 40").cast("int").alias("page"), n.alias("block_no"), x0.alias("x0"), y0.alias("y0"), (x0 + 100).alias("x1"), (y0 + 12).alias("y1"),
        F.concat(F.lit("l"), n.cast("string")).alias("text"), (n % 5 == 4).cast("int").alias("type"),
    )
    k = F.explode(F.sequence(F.lit(0), F.lit(7)))
    bands = blocks.where("type = 0").select("doc_id", "page").distinct().select("doc_id", "page", k.alias("k")).select(
        "doc_id", "page", F.concat(F.lit("r"), F.col("k").cast("string")).alias("row_key"), (F.col("k") * 100.0).alias("y_min"), ((F.col("k") + 1) * 100.0).alias("y_max")
    )
    return tables.place_blocks(blocks, bands, 322.0, 225.0)


_LABELS = {"OGUC": G.OGUC, "LGUC": G.LGUC}


@query(
    "label_dictionary_join",
    f"""WITH h AS (SELECT doc_id, unnest(regexp_extract_all(text, '\\b(OGUC|LGUC)\\b', 1)) AS sigla FROM documents WHERE text IS NOT NULL)
    SELECT h.doc_id, d.uri, count(*) AS veces FROM h JOIN (VALUES ('OGUC', '{G.OGUC}'), ('LGUC', '{G.LGUC}')) AS d(sigla, uri) USING (sigla) GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    hits = docs(spark, sf_dir).where("text is not null").select("doc_id", F.explode_outer(F.regexp_extract_all("text", F.lit(r"\b(OGUC|LGUC)\b"), F.lit(1))).alias("sigla"))
    d = spark.createDataFrame(list(_LABELS.items()), "sigla string, uri string")
    return hits.join(small(d), "sigla").groupBy("doc_id", "uri").agg(F.count("*").alias("veces"))


@query("set_except", "SELECT num FROM circular_registry EXCEPT SELECT try_cast(regexp_extract(replace(numero, '.', ''), '([0-9]+)', 1) AS INT) FROM circulares")
def _(spark, sf_dir):
    known = circ(spark, sf_dir, "numero").select(F.regexp_extract(F.replace("numero", F.lit("."), F.lit("")), "([0-9]+)", 1).try_cast("int").alias("num")).distinct()
    return table(spark, sf_dir, "circular_registry", "num").distinct().join(known, "num", "left_anti")


_HEAD_WORDS = sorted(signer.HEADINGS)


@query(
    "subset_test",
    _L + f""" SELECT doc_id, line_no FROM l WHERE len(list_filter(regexp_extract_all(upper(line), '[A-ZÁÉÍÓÚÑ]+'), lambda w: w <> '')) > 0
      AND len(list_filter(regexp_extract_all(upper(line), '[A-ZÁÉÍÓÚÑ]+'), lambda w: w NOT IN ({S.in_list(_HEAD_WORDS)}))) = 0""",
)
def _(spark, sf_dir):
    words = F.regexp_extract_all(F.upper("line"), F.lit("([A-ZÁÉÍÓÚÑ]+)"), F.lit(1))
    rows = doc_lines(spark, sf_dir).withColumn("w", words)
    return rows.where((F.size("w") > 0) & (F.size(F.array_except("w", F.array(*[F.lit(x) for x in _HEAD_WORDS]))) == 0)).select("doc_id", "line_no")


@query("union_append", "SELECT origen, count(*) AS filas FROM (SELECT 'circulares' AS origen FROM circulares UNION ALL SELECT source FROM documents) GROUP BY origen")
def _(spark, sf_dir):
    both = circ(spark, sf_dir).select(F.lit("circulares").alias("origen")).unionByName(table(spark, sf_dir, "documents", "source").withColumnRenamed("source", "origen"))
    return both.groupBy("origen").agg(F.count("*").alias("filas"))


# -- windows


@query("running_ids", _L + " SELECT doc_id, line_no, 'DDU_' || doc_id || '_linea_' || row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS id FROM l WHERE line <> ''")
def _(spark, sf_dir):
    w = Window.partitionBy("doc_id").orderBy("line_no")
    return doc_lines(spark, sf_dir).where("line <> ''").select("doc_id", "line_no", F.concat_ws("_", F.lit("DDU"), F.col("doc_id").cast("string"), F.lit("linea"), F.row_number().over(w).cast("string")).alias("id"))


@query("lookahead_lead", _L + ", w AS (SELECT doc_id, line_no, line, lead(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS sig FROM l) SELECT doc_id, line_no, sig FROM w WHERE regexp_matches(line, '^Saluda')")
def _(spark, sf_dir):
    w = Window.partitionBy("doc_id").orderBy("line_no")
    return doc_lines(spark, sf_dir).withColumn("sig", F.lead("line").over(w)).where(F.col("line").rlike("^Saluda")).select("doc_id", "line_no", "sig")


@query(
    "nearest_above",
    _L + """, w AS (SELECT doc_id, line_no, line, last_value(CASE WHEN regexp_matches(line, '^[0-9]+\\. ') THEN line_no END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS numeral FROM l)
    SELECT doc_id, line_no, numeral FROM w WHERE regexp_matches(line, '^JEFE')""",
)
def _(spark, sf_dir):
    w = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    near = F.last(F.when(F.col("line").rlike(r"^[0-9]+\. "), F.col("line_no")), ignorenulls=True).over(w)
    return doc_lines(spark, sf_dir).withColumn("numeral", near).where(F.col("line").rlike("^JEFE")).select("doc_id", "line_no", "numeral")


@query(
    "bounded_frame_after",
    _L + """, w AS (SELECT doc_id, line_no, line, count(*) FILTER (line <> '') OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND 15 FOLLOWING) AS siguientes FROM l)
    SELECT doc_id, line_no, siguientes FROM w WHERE regexp_matches(line, '(?i)saluda')""",
)
def _(spark, sf_dir):
    w = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(1, 15)
    n = F.count(F.when(F.col("line") != "", 1)).over(w)
    return doc_lines(spark, sf_dir).withColumn("siguientes", n).where(rx(F.col("line"), "saluda")).select("doc_id", "line_no", "siguientes")


# -- images

# Images of documents: the lines of an order as the pictures on its pages, two lines to a page.


def image_rows(spark, sf_dir):
    """``(doc_id, num, page, xref, w, h, bytes, page_w, page_h, x0, y0, x1, y1)`` from the order lines."""
    i = lambda c: F.expr(c).cast("int")
    l = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return l.select(
        F.col("l_orderkey").alias("doc_id"), F.col("l_orderkey").alias("num"), i("(l_linenumber + 1) div 2").alias("page"), i("l_partkey % 6").alias("xref"), i("l_suppkey * 37 % 900").alias("w"), i("l_partkey * 13 % 700").alias("h"),
        i("l_partkey * 31 % 9000").alias("bytes"), F.lit(600.0).alias("page_w"), F.lit(800.0).alias("page_h"), F.expr("cast(l_quantity as double)").alias("x0"), i("l_partkey % 70 * 10").cast("double").alias("y0"),
        F.expr("cast(l_quantity as double) + l_suppkey * 37 % 900").alias("x1"), (i("l_partkey % 70 * 10") + i("l_partkey * 13 % 700")).cast("double").alias("y1"),
    )


_IMAGE_ROWS = """i AS (SELECT l_orderkey AS doc_id, (l_linenumber + 1) // 2 AS page, l_partkey % 6 AS xref, l_suppkey * 37 % 900 AS w, l_partkey * 13 % 700 AS h, l_partkey * 31 % 9000 AS bytes,
  l_quantity::DOUBLE AS x0, (l_partkey % 70 * 10)::DOUBLE AS y0, l_quantity::DOUBLE + l_suppkey * 37 % 900 AS x1, (l_partkey % 70 * 10 + l_partkey * 13 % 700)::DOUBLE AS y1 FROM lineitem)"""
_IMAGE_OK = "h >= 60 AND w >= 60 AND bytes >= 1000 AND NOT (page = 1 AND y0 < 150) AND NOT (x1 - x0 >= 540 AND y1 - y0 >= 720)"


@query("image_filter", f"WITH {_IMAGE_ROWS} SELECT doc_id, page::INT AS page, xref::INT AS xref, w::INT AS w, h::INT AS h FROM i WHERE {_IMAGE_OK}")
def _(spark, sf_dir):
    return image_rows(spark, sf_dir).where(images.is_drawing()).select("doc_id", "page", "xref", "w", "h")


@query(
    "image_manifest",
    f"""WITH {_IMAGE_ROWS}, k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, xref ORDER BY page, w, h) AS r FROM i WHERE {_IMAGE_OK}),
    n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page, xref) AS n FROM k WHERE r = 1)
    SELECT 'DDU_' || doc_id || '_img_' || n AS id, page::INT AS pagina, 'Esquema técnico' AS tipo, w || 'x' || h AS dimensiones, 'Esquema / diagrama técnico en página ' || page || ' (' || w || 'x' || h || ' px)' AS descripcion FROM n""",
)
def _(spark, sf_dir):
    return images.image_manifest(image_rows(spark, sf_dir)).select("id", "pagina", "tipo", "dimensiones", "descripcion")


@query(
    "image_description",
    """SELECT circular_id, CASE circular_id % 6 WHEN 0 THEN 'Esquema ilustrativo: Urbanizaciones voluntarias desvinculadas del proceso de división del suelo' WHEN 1 THEN 'Esquema ilustrativo: Planta azotea y corte esquemático'
      WHEN 2 THEN 'Esquema técnico: Planta azotea' WHEN 3 THEN 'Se muestra el esquema del sitio n' || length(numero) WHEN 4 THEN 'Figura ' || length(numero) || ': Vista del predio'
      ELSE 'Esquema / diagrama técnico en página ' || (circular_id % 7) || ' (10x20 px)' END AS descripcion FROM circulares WHERE numero IS NOT NULL""",
)
def _(spark, sf_dir):
    k, n = F.col("circular_id") % 6, F.length("numero").cast("string")
    text = (
        F.when(k == 0, "las urbanizaciones voluntarias desvinculadas del proceso").when(k == 1, "PLANTA AZOTEA y CORTE ESQUEMÁTICO").when(k == 2, "planta azotea")
        .when(k == 3, F.concat(F.lit("A continuación se muestra el esquema del sitio n"), n, F.lit(". Otra"))).when(k == 4, F.concat(F.lit("Figura "), n, F.lit(": Vista del predio"))).otherwise("nada")
    )
    return circ(spark, sf_dir, "numero").where("numero is not null").select("circular_id", images.description(text, (F.col("circular_id") % 7).cast("int"), F.lit(10), F.lit(20)).alias("descripcion"))


@query(
    "markdown_image_scan",
    f"""WITH c AS (SELECT circular_id, [CASE WHEN lugar IS NOT NULL THEN '![Esquema de ' || lugar || '](a.png)' END, 'texto', 'x ![ ](' || circular_id || '.png) ![' || coalesce(fuente, '') || '](b.png)'] AS l FROM circulares),
    a AS (SELECT circular_id, i, unnest(regexp_extract_all(coalesce(l[i], ''), '!\\[([^\\]]*)\\]\\([^)]+\\)', 1)) AS alt, generate_subscripts(regexp_extract_all(coalesce(l[i], ''), '!\\[([^\\]]*)\\]\\([^)]+\\)', 1), 1) AS j FROM c, (SELECT unnest([1, 2, 3]) AS i)),
    n AS (SELECT circular_id, CASE WHEN trim(alt) <> '' THEN {S.strip('alt')} ELSE 'Imagen referenciada en línea ' || i END AS nombre, row_number() OVER (PARTITION BY circular_id ORDER BY i, j) AS k FROM a)
    SELECT circular_id, 'DDU_9_img_' || k AS id, nombre, CASE WHEN contains(lower(nombre), 'esquema') THEN 'Esquema técnico' ELSE 'Imagen / Diagrama' END AS tipo FROM n""",
)
def _(spark, sf_dir):
    no = F.col("circular_id").cast("string")
    lines = F.array(
        F.coalesce(F.when(F.col("lugar").isNotNull(), F.concat(F.lit("![Esquema de "), "lugar", F.lit("](a.png)"))), F.lit("")), F.lit("texto"),
        F.concat(F.lit("x ![ ]("), no, F.lit(".png) !["), F.coalesce("fuente", F.lit("")), F.lit("](b.png)")),
    )
    rows = circ(spark, sf_dir, "lugar", "fuente").select("circular_id", F.explode(images.markdown_images(lines, F.lit("9"))).alias("m"))
    return rows.select("circular_id", "m.id", "m.nombre", "m.tipo")


@query("bbox_minmax", f"WITH {_IMAGE_ROWS} SELECT doc_id, page::INT AS page, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM i WHERE y1 < 750 AND y0 > 100 GROUP BY 1, 2")
def _(spark, sf_dir):
    inner = image_rows(spark, sf_dir).where("y1 < page_h - 50 and y0 > 100")
    return inner.groupBy("doc_id", "page").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


_STEP = """SELECT doc_id, page, n + 1 AS n, CASE WHEN f THEN least(a0, x0) ELSE a0 END AS a0, CASE WHEN f THEN least(b0, y0) ELSE b0 END AS b0, CASE WHEN f THEN greatest(a1, x1) ELSE a1 END AS a1, CASE WHEN f THEN greatest(b1, y1) ELSE b1 END AS b1
  FROM (SELECT g.*, x0, y0, x1, y1, coalesce(y0 >= 60 AND y1 <= 760 AND y0 >= b0 - 25 AND y1 <= b1 + 25 AND x0 >= a0 - 60 AND x1 <= a1 + 60, false) AS f FROM g{k} g LEFT JOIN t ON t.doc_id = g.doc_id AND t.page = g.page AND t.block_no = {k} + 1)"""


@query(
    "bbox_grow",
    f"""WITH {_IMAGE_ROWS}, g0 AS (SELECT doc_id, page, 0 AS n, min(x0) AS a0, min(y0) AS b0, max(x1) AS a1, max(y1) AS b1 FROM i WHERE y1 < 750 AND y0 > 100 GROUP BY 1, 2),
    t AS (SELECT l_orderkey AS doc_id, (l_linenumber + 1) // 2 AS page, (l_linenumber + 1) % 2 + 1 AS block_no, min(l_quantity)::DOUBLE - 30 AS x0, min(l_partkey % 70 * 10)::DOUBLE - 20 AS y0, min(l_quantity)::DOUBLE + 200 AS x1,
      min(l_partkey % 70 * 10)::DOUBLE + 40 AS y1 FROM lineitem WHERE l_suppkey % 4 <> 0 GROUP BY 1, 2, 3),
    g1 AS ({_STEP.format(k=0)}), g2 AS ({_STEP.format(k=1)})
    SELECT doc_id, page::INT AS page, greatest(20.0, a0 - 8)::DOUBLE AS x0, greatest(40.0, b0 - 8)::DOUBLE AS y0, least(580.0, a1 + 8)::DOUBLE AS x1, least(780.0, b1 + 8)::DOUBLE AS y1 FROM g2""",
)
def _(spark, sf_dir):
    """The boxes of all pages grown over the labels beside them; blocks that open a numbered paragraph are no labels."""
    l = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    page, number = F.expr("(l_linenumber + 1) div 2").cast("int"), F.expr("(l_linenumber + 1) % 2 + 1 + if(l_suppkey % 4 = 0, 2, 0)").cast("int")
    placed = l.groupBy(F.col("l_orderkey").alias("doc_id"), page.alias("page"), number.alias("block_no")).agg(F.min("l_quantity").cast("double").alias("x"), F.min(F.expr("l_partkey % 70 * 10")).cast("double").alias("y"))
    text = F.when(F.col("block_no") > 2, "1. De conformidad con lo dispuesto").otherwise(F.concat(F.lit("Cota "), F.col("block_no").cast("string")))
    blocks = placed.select("doc_id", "page", "block_no", (F.col("x") - 30).alias("x0"), (F.col("y") - 20).alias("y0"), (F.col("x") + 200).alias("x1"), (F.col("y") + 40).alias("y1"), text.alias("text"))
    return images.drawing_box(image_rows(spark, sf_dir), blocks).select("doc_id", "page", "x0", "y0", "x1", "y1")


_PARS = "SELECT circular_id AS doc_id, (line_no // 10 + 1)::INT AS sec_no, (line_no % 10 + 1)::INT AS par_no, CASE WHEN line_no % 7 = circular_id % 7 THEN line || ' Ver el siguiente esquema.' ELSE line END AS texto FROM l WHERE line <> ''"


@query(
    "image_first_trigger",
    _C + f", p AS ({_PARS}) SELECT doc_id, arg_min('par_' || sec_no || '_' || par_no, sec_no * 1000 + par_no) AS par_id FROM p WHERE regexp_matches(texto, '(?i)esquema ilustrativo|siguiente esquema|siguiente figura') GROUP BY doc_id",
)
def _(spark, sf_dir):
    """Lines of bodies as paragraphs, ten to a section; one in seven introduces a drawing."""
    n = F.col("line_no")
    rows = explode_lines(circ(spark, sf_dir, "cuerpo"), "circular_id", "cuerpo").where("line <> ''")
    sec, par = F.expr("line_no div 10 + 1").cast("int"), (n % 10 + 1).cast("int")
    text = F.when(n % 7 == F.col("circular_id") % 7, F.concat("line", F.lit(" Ver el siguiente esquema."))).otherwise(F.col("line"))
    named = rows.select(F.col("circular_id").alias("doc_id"), sec.alias("sec_no"), par.alias("par_no"), F.concat_ws("_", F.lit("par"), sec.cast("string"), par.cast("string")).alias("par_id"), text.alias("texto"))
    return images.first_trigger(named)


# -- files and renderers


def _records_of_files(spark, sf_dir, resegmented=True):
    return eav.record(eav.pivot(table(spark, sf_dir, "eav", "file", "row_no", "campo", "valor_extraido").where("file is not null")), resegmented)


_PIVOTED = f"WITH e AS (SELECT DISTINCT file, row_no, {S.strip('campo')} AS c, {S.strip('coalesce(valor_extraido, chr(32))')} AS v FROM eav WHERE file IS NOT NULL), w AS (SELECT file, {_PIVOT} FROM e GROUP BY file)"


@query(
    "csv_records",
    _PIVOTED + f""", r AS (SELECT file, coalesce(numero_ddu, '') AS numero, coalesce(fecha_emision, '') AS f, CASE WHEN coalesce(cuerpo, '') = '' THEN [] ELSE {_segments_sql('cuerpo')} END AS s FROM w)
    SELECT file, numero, CASE WHEN contains(f, ',') THEN {S.strip("regexp_replace(f, '(?s)^[^,]*,', '')")} ELSE f END AS fecha, CASE WHEN contains(f, ',') THEN {S.strip("split_part(f, ',', 1)")} ELSE 'Santiago' END AS lugar,
      len(s)::INT AS secciones, coalesce(list_sum(list_transform(s, lambda x: len(x.p))), 0)::INT AS parrafos FROM r""",
)
def _(spark, sf_dir):
    """Records read back from the attribute rows of every file, bodies split into sections."""
    r = _records_of_files(spark, sf_dir)
    return r.select("file", "numero", "fecha", "lugar", F.size("secciones").alias("secciones"), F.aggregate("secciones", F.lit(0), lambda a, s: a + F.size(s["parrafos"])).alias("parrafos"))


_WRITTEN = {"numero": "numero", "materia": "materia", "notas_al_pie": "notas_al_pie", "firmante": "firmante", "emisor": "emisor"}
_ROUND = " UNION ALL ".join(
    f"SELECT {S.q(c)} AS campo, count(*) AS filas, sum(length(v)) AS caracteres FROM (SELECT nullif({S.strip(src) if src in _WRITTEN else 'NULL::VARCHAR'}, '') AS v FROM circulares)" for _, c, src in eav.LAYOUT
)


@query("csv_roundtrip", _ROUND)
def _(spark, sf_dir):
    """Records written as extraction files in buckets and read again; the files lie in the shared folder of the session."""
    import uuid

    from acervo.session import cut, shared_dir
    from acervo.sources.files import read_eav_buckets, write_eav_buckets

    cols = ("numero", "materia", "notas_al_pie", "firmante", "emisor")
    path = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    write_eav_buckets(circ(spark, sf_dir, *cols), "circular_id", path, 8)
    back = cut(read_eav_buckets(spark, path).groupBy("campo").agg(F.count("*").alias("filas"), F.sum(F.length("valor_extraido")).alias("caracteres")))
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return back


@query("akoma_xml")
def _(spark, sf_dir):
    return render.akoma_xml(_records_of_files(spark, sf_dir), as_of="2026-01-01").select("file", "xml")


def _iso_sql(x: str) -> str:
    """Date of a text in Spanish words or figures."""
    return f"""CASE WHEN regexp_matches({x}, {S.q(_LONG)}) THEN regexp_extract({x}, {S.q(_LONG)}, 3) || '-' || {_MONTHS.replace('lower(m)', f"lower(regexp_extract({x}, {S.q(_LONG)}, 2))")} || '-' || lpad(regexp_extract({x}, {S.q(_LONG)}, 1), 2, '0')
      WHEN regexp_matches({x}, {S.q(_NUM)}) THEN regexp_extract({x}, {S.q(_NUM)}, 3) || '-' || regexp_extract({x}, {S.q(_NUM)}, 2) || '-' || regexp_extract({x}, {S.q(_NUM)}, 1) ELSE '0000-00-00' END"""


def _year_sql(x: str) -> str:
    """Year near the first mention of circular ``n`` that has one."""
    near = rf"regexp_extract_all({x}, '(?is).{{0,100}}\b(?:circular\s+(?:ddu\s+)?|ddu\s+)n?[°oº]?\s*' || n || '\b.{{0,100}}')"
    return rf"coalesce(list_filter(list_transform({near}, lambda m: regexp_extract(m, '\b((?:19|20)[0-9]{{2}})\b', 1)), lambda y: y <> '')[1] || '-00-00', '0000-00-00')"


def _own_out(x: str, pattern: str) -> str:
    return f"list_filter(list_distinct(list_transform(regexp_extract_all({x}, {S.q(pattern)}), lambda h: try_cast(regexp_extract(h, '([0-9]+)$', 1) AS INT))), lambda v: v IS NOT NULL AND (own IS NULL OR v <> own))"


@query(
    "rdf_triples",
    _PIVOTED + f""", f AS (SELECT *, coalesce(fecha_emision, '') AS fe FROM w),
    r AS (SELECT trim(numero_ddu) AS numero, trim(CASE WHEN contains(fe, ',') THEN {S.strip("regexp_replace(fe, '(?s)^[^,]*,', '')")} ELSE fe END) AS fecha, trim(coalesce(materia, '')) AS titulo, coalesce(emisor, '') AS emisor,
      {S.squeeze("concat_ws(' ', materia, antecedentes, cuerpo)")} AS t, coalesce(modificaciones_posteriores, '') AS nota, try_cast(regexp_extract(numero_ddu, '([0-9]+)', 1) AS INT) AS own FROM f),
    k AS (SELECT *, '{G.CIRCULAR}/' || fecha || '/' || numero AS s FROM r WHERE coalesce(numero, '') <> '' AND fecha <> ''),
    c AS (SELECT s, t, unnest({_own_out('t', _CITED)}) AS n FROM k), m AS (SELECT s, nota, unnest({_own_out('nota', _AMEND)}) AS n FROM k), u AS (SELECT s, unnest(regexp_extract_all(t, {S.q(_CITE)})) AS h FROM k),
    x AS (SELECT s, 'rdf:type' AS p, 'minvu-ddu:CircularDDU' AS o, 'uri' AS o_kind, NULL AS o_type FROM k UNION ALL SELECT s, 'bcn-norms:hasNumber', numero, 'literal', NULL FROM k UNION ALL SELECT s, 'bcn-norms:publishDate', fecha, 'literal', 'xsd:date' FROM k
      UNION ALL SELECT s, 'dc:title', titulo, 'literal', NULL FROM k UNION ALL SELECT s, 'bcn-norms:createdBy', CASE WHEN contains(lower(emisor), 'desarrollo urbano') THEN '{G.ORGANISATION}/ministerio-de-vivienda-y-urbanismo/division-de-desarrollo-urbano'
        WHEN contains(lower(emisor), 'vivienda') THEN '{G.ORGANISATION}/ministerio-de-vivienda-y-urbanismo' ELSE '{G.ORGANISATION}/' || {_uri_sql('emisor')} END, 'uri', NULL FROM k
      UNION ALL SELECT s, 'bcn-resources:tieneDocumentoAkomaNtoso', s || '/espanol/datos.xml', 'uri', NULL FROM k UNION ALL SELECT s, 'minvu-ddu:interpretaA', {_URI}, 'uri', NULL FROM u
      UNION ALL SELECT s, 'minvu-ddu:complementaA', '{G.CIRCULAR}/' || {_year_sql('t')} || '/' || n, 'uri', NULL FROM c
      UNION ALL SELECT s, 'minvu-ddu:modificadaPor', '{G.CIRCULAR}/' || CASE WHEN {_year_sql('nota')} = '0000-00-00' THEN {_iso_sql('nota')} ELSE {_year_sql('nota')} END || '/DDU ' || n, 'uri', NULL FROM m)
    SELECT DISTINCT s, p, o, o_kind, o_type FROM x""",
)
def _(spark, sf_dir):
    return G.triples(_records_of_files(spark, sf_dir, resegmented=False))


_HEAD = """@prefix rdf: <http://www.w3.org/1999/02/22-rdf-syntax-ns#> .
@prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> .
@prefix owl: <http://www.w3.org/2002/07/owl#> .
@prefix dc: <http://purl.org/dc/elements/1.1/> .
@prefix bcn-norms: <http://datos.bcn.cl/ontologies/bcn-norms#> .
@prefix minvu-ddu: <http://datos.bcn.cl/ontologies/minvu-ddu#> .
@prefix bcn-resources: <http://datos.bcn.cl/ontologies/bcn-resources#> .
@prefix xsd: <http://www.w3.org/2001/XMLSchema#> .

minvu-ddu:CircularDDU rdfs:subClassOf bcn-norms:Norm .

<"""


@query(
    "turtle_render",
    f"""WITH z AS ({CORE.oracles['rdf_triples']}), o AS (SELECT s, p, CASE WHEN o_kind = 'uri' AND starts_with(o, 'http') THEN '<' || o || '>' WHEN o_kind = 'uri' THEN o
      WHEN p = 'dc:title' THEN '\"\"\"' || replace(replace(o, '\\', '\\\\'), '"', '\\"') || '\"\"\"' ELSE '"' || o || '"' || coalesce('^^' || o_type, '') END AS o FROM z),
    g AS (SELECT s, p, string_agg(DISTINCT o, ', ' ORDER BY o) AS o FROM o GROUP BY 1, 2)
    SELECT s, {S.q(_HEAD)} || s || '>' || chr(10) || string_agg('    ' || p || ' ' || o, ' ;' || chr(10) ORDER BY list_position(['rdf:type', 'bcn-norms:hasNumber', 'bcn-norms:publishDate', 'dc:title', 'bcn-norms:createdBy', 'minvu-ddu:interpretaA',
      'minvu-ddu:complementaA', 'minvu-ddu:modificadaPor', 'bcn-resources:tieneDocumentoAkomaNtoso'], p)) || ' .' || chr(10) AS ttl FROM g GROUP BY s""",
)
def _(spark, sf_dir):
    return render.turtle(G.triples(_records_of_files(spark, sf_dir, resegmented=False)))
