"""Renderers: records as legal XML and as Turtle, built from column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo.functions import dates, text as T
from acervo.functions.regex import ci, let, strip
from acervo.operators import graph as G
from acervo.operators import manifest as M

TRIGGERS = r"(?iu)esquema ilustrativo|siguiente esquema|siguiente figura"
HEADING = r"^([A-ZÁÉÍÓÚÑ\s\d\"'()─\-–—:]+[.:])\s+(.+)$"


def _line(depth: int, *parts) -> Column:
    return F.concat(F.lit("  " * depth), *[F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts])


def _if(test: Column, rows: Column) -> Column:
    return F.when(test, rows).otherwise(F.array().cast("array<string>"))


def _paragraph(sec: Column, par: Column, text: Column, images: Column, here: Column, compat: bool) -> Column:
    """Lines of one paragraph; ``here`` says whether the document's images attach to it."""
    numbered = r"(?s)^(\d+(?:\.\d+)*\.?)\s+(.+)$"
    ident = F.concat_ws("_", F.lit("par"), sec.cast("string"), par.cast("string"))

    def of(t: Column) -> Column:
        num = F.regexp_extract(t, numbered, 1)
        rest = F.when(num != "", F.regexp_extract(t, numbered, 2)).otherwise(t)
        heading = strip(F.regexp_extract(rest, HEADING, 1))
        body = F.when(heading != "", strip(F.regexp_extract(rest, HEADING, 2))).otherwise(rest)
        content = G.with_references(T.xml_escape(body), F.concat(F.lit("ref_"), ident))
        content = F.regexp_replace(content, r"\s+([a-z\d]+\)\s+)" if compat else r"(?<![\(\p{L}])\s+([a-z\d]{1,2}\)\s+)", "<eol/>$1")
        shown = F.transform(
            images,
            lambda m: _line(
                6, '<p><img id="', T.xml_escape(F.try_element_at(m, F.lit("id"))), '" src="', T.xml_escape(F.try_element_at(m, F.lit("archivo_anexo"))), '" alt="',
                T.xml_escape(F.coalesce(F.try_element_at(m, F.lit("descripcion")), F.try_element_at(m, F.lit("nombre")))), '" width="', F.try_element_at(m, F.lit("ancho")), '" height="', F.try_element_at(m, F.lit("alto")), '"/></p>',
            ),
        )
        return F.concat(
            F.array(_line(3, '<paragraph id="', ident, '">')), _if(num != "", F.array(_line(4, "<num>", T.xml_escape(num), "</num>"))), _if(heading != "", F.array(_line(4, "<heading>", T.xml_escape(heading), "</heading>"))),
            F.array(_line(4, "<content>"), _line(5, "<p>", content, "</p>")), _if(here, F.transform(shown, lambda x: F.substring(x, F.lit(3), F.length(x)))), F.array(_line(4, "</content>"), _line(3, "</paragraph>")),
        )

    return let(strip(text), of)


def _sections(sections: Column, images: Column, compat: bool) -> Column:
    """Lines of the main body. All images of a document attach to its first paragraph that introduces a drawing."""
    at = F.flatten(F.transform(sections, lambda s, i: F.transform(s["parrafos"], lambda p, j: F.struct((i + 1).alias("s"), (j + 1).alias("p"), p.rlike(TRIGGERS).alias("t")))))
    first = F.get(F.filter(at, lambda x: x["t"]), F.lit(0))
    roman = r"(?iu)^([IVXLCDM]+\.?)\s+(.+)$"

    def one(s: Column, i: Column) -> Column:
        title = strip(F.coalesce(s["titulo"], F.lit("")))
        num = F.regexp_extract(title, roman, 1)
        head = F.when(num != "", F.regexp_extract(title, roman, 2)).otherwise(title)
        n = i + 1
        kept = F.filter(F.transform(s["parrafos"], lambda p, j: F.struct(p.alias("t"), (j + 1).alias("j"))), lambda x: strip(F.coalesce(x["t"], F.lit(""))) != "")
        pars = F.flatten(F.transform(kept, lambda x: _paragraph(n, x["j"], x["t"], images, F.coalesce((first["s"] == n) & (first["p"] == x["j"]), F.lit(False)) & (F.size(images) > 0), compat)))
        return F.concat(
            F.array(_line(2, '<section id="sec_', n.cast("string"), '">')), _if(num != "", F.array(_line(3, "<num>", T.xml_escape(num), "</num>"))), _if(head != "", F.array(_line(3, "<heading>", T.xml_escape(head), "</heading>"))),
            pars, F.array(_line(2, "</section>")),
        )

    return F.flatten(F.transform(F.coalesce(sections, F.array().cast("array<struct<titulo:string,parrafos:array<string>>>")), one))


def akoma_xml(records: DataFrame, as_of: str, compat: bool = False) -> DataFrame:
    """Adds ``xml``: the legal document of each record. ``as_of`` is the date of generation (an argument, so that runs agree).

    ``compat`` inserts ``<eol/>`` also before ordinary parentheses, as older output did. Missing columns count as empty.
    """
    has = set(records.columns)
    v = lambda c: strip(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in has else F.lit("")
    num, date, subject, words = v("numero"), v("fecha"), v("materia"), v("descriptores")
    work = F.concat(F.lit(f"{G.CIRCULAR}/"), date, F.lit("/"), num)
    rows = records.withColumn("_mod", G.amendment(v("modificaciones_posteriores"))).withColumn("_img", M.parse(v("imagenes_manifiesto"))).withColumn("_tab", M.parse(v("tablas_manifiesto")))
    mod, amended = F.col("_mod"), F.col("_mod").isNotNull()

    def level(name: str, uri: Column, day: Column, day_name: str, author: str, last: str) -> Column:
        return F.array(
            _line(3, f"<FRBR{name}>"), _line(4, '<FRBRthis value="', uri, "" if name == "Manifestation" else "/main", '"/>'), _line(4, '<FRBRuri value="', uri, '"/>'),
            _line(4, '<FRBRdate date="', day, f'" name="{day_name}"/>'), _line(4, f'<FRBRauthor href="#{author}" as="#{"editor" if author == "redactor" else "autor"}"/>'), _line(4, last), _line(3, f"</FRBR{name}>"),
        )

    published = "fecha-publicacion"
    org = G.ORGANISATION
    refs = (
        f'<TLCOrganization id="redactor" href="{org}/biblioteca-del-congreso-nacional" showAs="Biblioteca del Congreso Nacional"/>',
        f'<TLCOrganization id="minvu" href="{org}/ministerio-de-vivienda-y-urbanismo" showAs="Ministerio de Vivienda y Urbanismo"/>',
        f'<TLCOrganization id="minvu-ddu" href="{org}/ministerio-de-vivienda-y-urbanismo/division-de-desarrollo-urbano" showAs="División de Desarrollo Urbanismo"/>',
        f'<TLCPerson id="jefe-division-desarrollo-urbano" href="{G.BASE}/persona/jefe-division-desarrollo-urbano" showAs="Jefe División de Desarrollo Urbano"/>',
        f'<TLCRole id="autor" href="{G.BASE}/rol/autor" showAs="Autor"/>', f'<TLCRole id="editor" href="{G.BASE}/rol/editor" showAs="Editor"/>',
    )
    bare = strip(F.regexp_replace(num, ci(r"^DDU\s*"), ""))
    signer, notes, list_text = v("firmante"), v("notas_al_pie"), v("distribucion_texto")
    esc = T.xml_escape
    meta = F.concat(
        F.array(
            F.lit('<?xml version="1.0" encoding="utf-8"?>'), F.lit('<doc name="circular"'), _line(1, 'xmlns="http://www.akomantoso.org/2.0"'), _line(1, 'xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance"'),
            _line(1, 'xsi:schemaLocation="http://www.akomantoso.org/2.0 ../bcn%20-%20documentaci%C3%B3n/Esquema%20Akoma-Ntoso%20BCN.xsd">'), F.lit("<meta>"), _line(1, '<identification source="#redactor">'),
        ),
        F.transform(F.concat(
            level("Work", work, date, published, "minvu-ddu", '<FRBRcountry value="cl"/>'), level("Expression", F.concat(work, F.lit("/espanol")), date, published, "minvu-ddu", '<FRBRlanguage language="es"/>'),
            level("Manifestation", F.concat(work, F.lit("/espanol/datos.xml")), F.lit(as_of), "fecha-generacion", "redactor", '<FRBRformat value="xml"/>'),
        ), lambda l: F.substring(l, F.lit(3), F.length(l))),
        F.array(_line(1, "</identification>")),
        _if(words != "", F.array(_line(1, '<classification source="#minvu-ddu">'), _line(2, '<keyword value="', esc(words), f'" showAs="Descriptores" dictionary="{G.BASE}/descriptores"/>'), _line(1, "</classification>"))),
        _if(amended, F.array(
            _line(1, '<lifecycle source="#minvu-ddu">'), _line(2, '<eventRef id="evento_mod_1" date="', mod["fecha"], '" source="#', mod["ddu_id"], '" type="amendment"/>'), _line(1, "</lifecycle>"),
            _line(1, '<analysis source="#redactor">'), _line(2, "<passiveModifications>"), _line(3, '<textualMod id="mod_1" type="substitution">'), _line(4, '<source href="', mod["uri"], '"/>'),
            _line(4, '<destination href="', mod["numeral_dest"], '"/>'), _line(3, "</textualMod>"), _line(2, "</passiveModifications>"), _line(1, "</analysis>"),
        )),
        F.array(_line(1, '<references source="#redactor">'), *[_line(2, r) for r in refs]),
        _if(amended, F.array(_line(2, '<TLCReference id="', mod["ddu_id"], '" name="circular-modificadora" href="', mod["uri"], '" showAs="Circular DDU ', mod["ddu_num"], '"/>'))),
        F.array(_line(1, "</references>"), F.lit("</meta>")),
    )
    preface = F.concat(
        F.array(
            F.lit("<preface>"), _line(1, "<p><docType>CIRCULAR</docType></p>"), _line(1, "<p><docNumber>DDU ", bare, "</docNumber></p>"),
            _line(1, '<p><docDate date="', date, '">', dates.iso_to_spanish(date), "</docDate></p>"), _line(1, "<p><docTitle>", esc(subject), "</docTitle></p>"),
        ),
        _if(words != "", F.array(_line(1, "<p>Descriptores: ", esc(words), "</p>"))), F.array(F.lit("</preface>")),
    )
    body = F.concat(F.array(F.lit("<mainBody>")), F.transform(_sections(F.col("secciones"), F.col("_img"), compat), lambda l: F.substring(l, F.lit(3), F.length(l))), F.array(F.lit("</mainBody>")))
    closing = _if((signer != "") | (notes != "") | (list_text != ""), F.concat(
        F.array(F.lit("<conclusions>")), _if(signer != "", F.array(_line(1, '<p><span refersTo="#jefe-division-desarrollo-urbano">', esc(signer), "</span></p>"))),
        _if(notes != "", F.array(_line(1, '<p><authorialNote id="fn_1" placement="bottom"><p>Notas al Pie: ', esc(notes), "</p></authorialNote></p>"))),
        _if(list_text != "", F.array(_line(1, "<p>Distribución: ", esc(list_text), "</p>"))), F.array(F.lit("</conclusions>")),
    ))
    attached = _if(F.size("_tab") > 0, F.concat(
        F.array(F.lit("<attachments>")),
        F.transform("_tab", lambda m: _line(1, '<componentRef id="', esc(F.try_element_at(m, F.lit("id"))), '" src="', esc(F.try_element_at(m, F.lit("archivo_anexo"))), '" showAs="', esc(F.coalesce(F.try_element_at(m, F.lit("nombre")), F.lit("Tabla de Modificaciones Normativas"))), '"/>')),
        F.array(F.lit("</attachments>")),
    ))
    return rows.withColumn("xml", F.array_join(F.concat(meta, preface, body, closing, attached, F.array(F.lit("</doc>"))), "\n")).drop("_mod", "_img", "_tab")


# Prefixes and class axiom of a Turtle document.
PREFIXES = (
    "@prefix rdf: <http://www.w3.org/1999/02/22-rdf-syntax-ns#> .", "@prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> .", "@prefix owl: <http://www.w3.org/2002/07/owl#> .",
    "@prefix dc: <http://purl.org/dc/elements/1.1/> .", "@prefix bcn-norms: <http://datos.bcn.cl/ontologies/bcn-norms#> .", "@prefix minvu-ddu: <http://datos.bcn.cl/ontologies/minvu-ddu#> .",
    "@prefix bcn-resources: <http://datos.bcn.cl/ontologies/bcn-resources#> .", "@prefix xsd: <http://www.w3.org/2001/XMLSchema#> .", "", "minvu-ddu:CircularDDU rdfs:subClassOf bcn-norms:Norm .", "",
)
PREDICATES = (
    "rdf:type", "bcn-norms:hasNumber", "bcn-norms:publishDate", "dc:title", "bcn-norms:createdBy", "minvu-ddu:interpretaA", "minvu-ddu:complementaA", "minvu-ddu:modificadaPor",
    "bcn-resources:tieneDocumentoAkomaNtoso",
)


def turtle(triples: DataFrame) -> DataFrame:
    """``(s, ttl)``: one Turtle document per subject, predicates in a fixed order, objects sorted."""
    order = F.create_map(*[x for i, p in enumerate(PREDICATES) for x in (F.lit(p), F.lit(i))])
    quoted = F.when(F.col("p") == "dc:title", F.concat(F.lit('"""'), T.turtle_escape(F.col("o")), F.lit('"""'))).otherwise(F.concat(F.lit('"'), F.col("o"), F.lit('"')))
    obj = (
        F.when((F.col("o_kind") == "uri") & F.col("o").startswith("http"), F.concat(F.lit("<"), F.col("o"), F.lit(">"))).when(F.col("o_kind") == "uri", F.col("o"))
        .otherwise(F.concat(quoted, F.coalesce(F.concat(F.lit("^^"), F.col("o_type")), F.lit(""))))
    )
    per = triples.groupBy("s", "p").agg(F.array_join(F.array_sort(F.collect_set(obj)), ", ").alias("o"))
    doc = per.groupBy("s").agg(F.array_sort(F.collect_list(F.struct(F.try_element_at(order, F.col("p")).alias("i"), "p", "o"))).alias("ps"))
    rows = F.array_join(F.transform("ps", lambda x: F.concat(F.lit("    "), x["p"], F.lit(" "), x["o"])), " ;\n")
    return doc.select("s", F.concat(F.lit("\n".join(PREFIXES)), F.lit("\n<"), F.col("s"), F.lit(">\n"), rows, F.lit(" .\n")).alias("ttl"))
