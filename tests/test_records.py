"""Extractors, segmentation and renderers on invented circulars."""

import xml.dom.minidom

import pytest
from pyspark.sql import functions as F

from acervo.operators import body, distribution, fields, graph, manifest, registry, render, signer
from acervo.operators.lines import lines_of, with_lines

CIRCULAR = """DDU 900
CIRCULAR ORD. N° 0112 /
ANT.: 1) Decreto Supremo N° 33 (V. y U.) de 2024.
2) Artículo 120 de la LGUC.
MAT.: Aplicación a rtículo 2.6.3. inciso s vigésimo de la OGUC.
PERMISOS, VIGENCIA, RECEPCIONES.
SANTIAGO, 27 FEB 2026
DE: JEFE DIVISIÓN DE DESARROLLO URBANO.
A: SEGÚN DISTRIBUCIÓN.
1. De conformidad con lo previsto en el artículo 4° de la LGUC, se instruye
lo que sigue.
2. La presente circular complementa la Circular DDU 510 de 2023 y DDU 328.
1 Nota explicativa de prueba.
sigue la nota
Página 1 de 2
Ministerio de Vivienda y Urbanismo - Alameda 924
II. NORMATIVA APLICABLE
QUE SIGUE
3. Ver el siguiente esquema a) uno.
Saluda atentamente a Ud.,
MARÍA PRUEBA EJEMPLO
JEFE DIVISIÓN DE DESARROLLO URBANO
DISTRIBUCIÓN:
1. Sr. Ministro de Prueba.
Biblioteca
de Prueba.
3. Archivo"""
INVERTED = """DDU 120
MAT.: Interpretación.
SANTIAGO, 15 MAR 2005
DE JEFE DIVISIÓN DE DESARROLLO URBANO
A SEÑORES ALCALDES
1. Texto uno."""


@pytest.fixture(scope="module")
def got(spark):
    df = spark.createDataFrame([(1, CIRCULAR, "x"), (2, INVERTED, "y"), (3, None, "z"), (4, "", "w"), (5, "sin nada reconocible", None)], "doc_id int, text string, numero string")
    return {r["doc_id"]: r.asDict(recursive=True) for r in registry.records(df).collect()}


def test_header_fields(got):
    r = got[1]
    assert r["numero"] == "DDU 900" and r["numero_ord"] == "CIRCULAR ORD. N° 0112"
    assert r["antecedentes"] == "1) Decreto Supremo N° 33 (V. y U.) de 2024. 2) Artículo 120 de la LGUC."
    assert r["materia"] == "Aplicación artículo 2.6.3. incisos vigésimo de la OGUC."
    assert r["descriptores"] == "PERMISOS, VIGENCIA, RECEPCIONES."
    assert (r["fecha"], r["lugar"], r["fecha_lugar"]) == ("2026-02-27", "Santiago", "Santiago, 2026-02-27")
    assert r["emisor"] == "JEFE DIVISIÓN DE DESARROLLO URBANO" and r["destinatarios"] == "SEGÚN DISTRIBUCIÓN."


def test_inverted_order_and_defaults(got):
    assert got[2]["destinatarios"] == "SEÑORES ALCALDES" and got[2]["fecha"] == "2005-03-15"
    for k in (3, 4, 5):
        assert got[k]["numero"] == "" and got[k]["emisor"] == fields.DEFAULT_ISSUER and got[k]["lugar"] == "Santiago"
    assert got[3]["secciones"] == [] and got[5]["cuerpo"] == "sin nada reconocible"


def test_body_signer_and_list(got):
    r = got[1]
    assert [s["titulo"] for s in r["secciones"]] == ["", "II. NORMATIVA APLICABLE QUE SIGUE"]
    assert r["secciones"][0]["parrafos"][0] == "1. De conformidad con lo previsto en el artículo 4° de la LGUC, se instruye lo que sigue."
    assert "Nota explicativa" not in r["cuerpo"] and r["notas_al_pie"] == "1 Nota explicativa de prueba. sigue la nota"
    assert r["nombre_firmante"] == "MARÍA PRUEBA EJEMPLO" and r["cargo_firmante"] == "JEFE DIVISIÓN DE DESARROLLO URBANO"
    assert r["distribucion_texto"] == "1. Sr. Ministro de Prueba.; 2. Biblioteca de Prueba.; 3. Archivo"


def test_damaged_date(spark):
    df = spark.createDataFrame([("SANTIAGO, 1 7 FEB 2�l23",), ("complementa la de 1 MAR 2020\n3 de abril de 2019",)], "t string")
    rows = [r["fecha"] for r in df.select(fields.date_and_place(F.col("t"), lines_of(F.col("t")))["fecha"].alias("fecha")).collect()]
    assert rows == ["2023-02-17", "2019-04-03"]


def test_lines(one):
    assert one(lines_of, "a\r\nb\n\n c \n", "", None, "x\x0by\x85z", "\n") == [["a", "b", "", "c"], [], [], ["x", "y", "z"], [""]]


def test_segmentation_skips():
    lines = ["DE: JEFE DIVISIÓN", "1. Uno.", "ÍNDICE", "1. Cosa ........ 2", "2. Dos.", "PLANTA AZOTEA", "Piscina", "3. Tres;", "| Circular | Materia |", "| x | y |", "5. Cinco.", "12", "MARCO NORMATIVO", "y sigue", "7",
             "10, de acuerdo a eso.", "Saluda atentamente", "6. No."]
    got = body.segment(lines)
    assert got == [("", ["1. Uno.", "2. Dos.", "3. Tres:", "5. Cinco.", "12. MARCO NORMATIVO y sigue [7] [10], de acuerdo a eso."])]
    assert body.segment([]) == [] and body.segment(["", ""]) == []


def test_long_document(spark):
    text = "DE: JEFE DIVISIÓN\n" + "\n".join(f"{i}. Párrafo número uno de la prueba larga." for i in range(1, 4001))
    df = with_lines(spark.createDataFrame([(1, text)], "doc_id int, text string"))
    assert len(body.sections(df).first()["secciones"][0]["parrafos"]) == 4000


def test_resegment(one):
    got = one(body.resegment, "I. ANTECEDENTES: 1. Uno. 2. Dos, N° 3. sigue | II. NORMAS: 3. Tres.", "", None)
    assert [(s["titulo"], s["parrafos"]) for s in got[0]] == [("I. ANTECEDENTES:", ["1. Uno.", "2. Dos, N° 3. sigue"]), ("II. NORMAS:", ["3. Tres."])]
    assert got[1] == [] and got[2] == []


def test_amendments(one):
    notes = "Circular Modificada por Circular Ord. N°214, de fecha 02 de mayo de 2024, DDU 498 (numeral 7.)"
    assert one(lambda c: fields.amendments(c, c), f"a\n{notes}\nb", "nada", None) == [notes, "", ""]
    a = one(graph.amendment, notes, "sin circular", None)
    assert (a[0]["ddu_num"], a[0]["fecha"], a[0]["numeral_dest"]) == ("498", "2024-05-02", "#par_1_7") and a[1] is None and a[2] is None


def test_citations(one):
    text = "el artículo 2.6.3. de la OGUC, el art. 120 bis de la LGUC, la Ordenanza General de Urbanismo y Construcciones y el artículo 4°"
    assert one(graph.uri_set, text) == sorted([f"{graph.OGUC}/seccion/articulo-2.6.3", f"{graph.LGUC}/seccion/articulo-120-bis", graph.OGUC])
    assert one(lambda c: graph.with_references(c, F.lit("r")), "ver OGUC y LGUC.") == f'ver <ref id="r_1" href="{graph.OGUC}">OGUC</ref> y <ref id="r_2" href="{graph.LGUC}">LGUC</ref>.'
    assert one(graph.cited_numbers, "Circular DDU 510 de 2023, DDU N° 328 y DDU 510", None) == [[510, 328], None]


def test_render(spark, got):
    df = registry.records(spark.createDataFrame([(1, CIRCULAR.replace("uno.", "uno & <dos>."))], "doc_id int, text string"))
    xml_text = render.akoma_xml(df.withColumn("imagenes_manifiesto", F.lit("id: DDU_900_img_1; nombre: Plano; ancho: 10; alto: 20; archivo_anexo: a.png; descripcion: Plano")), as_of="2026-01-01").first()["xml"]
    tree = xml.dom.minidom.parseString(xml_text.encode())
    assert len(tree.getElementsByTagName("section")) == 2 and len(tree.getElementsByTagName("paragraph")) == 3 and len(tree.getElementsByTagName("img")) == 1
    ids = [e.getAttribute("id") for e in tree.getElementsByTagName("ref")]
    assert len(ids) == len(set(ids)) > 0
    ttl = render.turtle(graph.triples(df)).first()["ttl"]
    assert 'bcn-norms:hasNumber "DDU 900" ;' in ttl and f"<{graph.CIRCULAR}/2023-00-00/510>" in ttl and ttl.endswith(" .\n")


def test_triples_need_number_and_date(spark):
    r = spark.createDataFrame([("", "2020-01-01", "m", "e", "", None, "")], "numero string, fecha string, materia string, emisor string, antecedentes string, secciones array<struct<titulo:string,parrafos:array<string>>>, modificaciones_posteriores string")
    assert graph.triples(r).count() == 0


def test_manifest(spark, one):
    df = spark.createDataFrame([([(1, "a", [5, 6])],), (None,), ([],)], "m array<struct<id:int,nombre:string,paginas:array<int>>>")
    assert [r[0] for r in df.select(manifest.format_structs(F.col("m"), ["id", "nombre", "paginas"], ("paginas",))).collect()] == ["id: 1; nombre: a; paginas: 5, 6", "", ""]
    got = one(manifest.parse, "id: 1; nombre: a: b || id: 2", "", None, "sin dos puntos", "k: 1; k: 2")
    assert got == [[{"id": "1", "nombre": "a: b"}, {"id": "2"}], [], [], [], [{"k": "2"}]]
    assert one(manifest.from_json_or_text, '[{"id": "x", "pagina": 3}]', "texto", "", "[roto") == ["id: x; pagina: 3", "texto", "", "[roto"]


def test_registry(spark):
    r = registry.Registry()
    r.register("largo")(lambda t, l: {"n": F.length(t).cast("string")})
    df = spark.createDataFrame([(1, "abc"), (2, None)], "doc_id int, text string")
    rows = {x["doc_id"]: x for x in registry.blocks(df, registry=r).collect()}
    assert rows[1]["datos"] == {"n": "3"} and rows[1]["confianza"] == 1.0 and set(registry.REGISTRY.all()) >= {"encabezado", "materia", "firma", "distribucion"}
    bad = registry.python_extractor(df, lambda t, ls: {"x": str(1 // len(t))}, "malo").collect()
    assert {x["doc_id"]: x["exito"] for x in bad} == {1: True, 2: False} and any("ZeroDivisionError" in x["observaciones"] for x in bad)
    r.register("roto")(lambda t, l: 1 // 0)
    rows = {(x["doc_id"], x["nombre_bloque"]): x for x in registry.blocks(df, registry=r).collect()}
    assert rows[1, "largo"]["exito"] and not rows[1, "roto"]["exito"] and "ZeroDivisionError" in rows[1, "roto"]["observaciones"]
    r.clear()
    assert r.all() == {}


def test_distribution_header_clears(spark):
    df = spark.createDataFrame([(["Saluda atentamente", "Sr. Uno.", "DISTRIBUCIÓN:", "Sr. Dos,", "y Tres", "GOBIERNO DE CHILE", "4. Cuatro"],)], "l array<string>")
    assert df.select(distribution.distribution(F.lit(""), F.col("l"))).first()[0] == ["1. Sr. Dos y Tres", "4. Cuatro"]


def test_signer_sources(spark):
    rows = [(["DE: PEDRO LÓPEZ MUÑOZ, JEFE DIVISIÓN", "1. Texto"],), (["Saluda atentamente a Ud.,", "Jefe División de Desarrollo Urbano", "Ana Pérez Soto"],), ([],)]
    df = spark.createDataFrame(rows, "l array<string>")
    got = [tuple(r) for r in df.select(*signer.signer(F.lit(""), F.col("l")).values()).collect()]
    assert got[0][1:] == ("PEDRO LÓPEZ MUÑOZ", "JEFE DIVISIÓN") and got[1][1:] == ("Ana Pérez Soto", "Jefe División de Desarrollo Urbano") and got[2] == ("", "", "")
