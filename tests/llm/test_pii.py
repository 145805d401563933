"""Personal information: parsers, decoys, and the shape of results."""

import pytest
from pyspark.sql import functions as F

from acervo.llm import pii


def rut(n):
    total = sum(int(d) * (2 + i % 6) for i, d in enumerate(reversed(str(n))))
    return {11: "0", 10: "K"}.get(11 - total % 11, str(11 - total % 11))


GOOD, BAD = f"12.345.678-{rut(12345678)}", f"12.345.678-{'1' if rut(12345678) != '1' else '2'}"
CASES = {
    f"Quien suscribe, Ana Pérez Soto, RUT {GOOD}, consulta.": {("nombre", "Ana Pérez Soto"), ("identidad", GOOD)},
    f"Folio {GOOD}, RUT {BAD}.": set(),
    "Mi correo es ana.perez+x@correo.example.": {("correo", "ana.perez+x@correo.example")},
    "escriba a ana[at]obras[dot]muni[dot]test o ana_2 (arroba) mail.test.": {("correo", "ana[at]obras[dot]muni[dot]test"), ("correo", "ana_2 (arroba) mail.test")},
    "El aviso se publica en @cuenta y en www.sitio.example/x.": set(),
    "Fono de contacto +56 9 1234 5678, también (02) 21234 5678.": {("telefono", "+56 9 1234 5678"), ("telefono", "(02) 21234 5678")},
    "Se adjunta el comprobante de ingreso 912345678; el código 12.345.678 y $ 9.123.456.": set(),
    "vivo en Av. Las Rosas 4748, depto. 12 y trabajo en Parcela 7, Los Álamos.": {("direccion", "Av. Las Rosas 4748, depto. 12"), ("direccion", "Parcela 7, Los Álamos")},
    "predio de Camino a Pueblo km 15,5, propiedad de doña Rosa Mora viuda de Vera.": {("direccion", "Camino a Pueblo km 15,5"), ("nombre", "Rosa Mora viuda de Vera")},
    "la esquina de las calles Los Álamos y Las Rosas; Circular DDU 227; Decreto Supremo N° 33 de 2024": set(),
    "Asisten: Juan M. Vera Soto; Mora Soto, Elena; A. Pinto Ríos.": {("nombre", "Juan M. Vera Soto"), ("nombre", "Mora Soto, Elena"), ("nombre", "A. Pinto Ríos")},
    "la vecina mónica letusumaz señala: por norma especial": {("nombre", "mónica letusumaz")},
    "Saluda,\nPEDRO DE LA CRUZ VERA\nJEFE DIVISIÓN": {("nombre", "PEDRO DE LA CRUZ VERA")},
    "La empresa Inmobiliaria Rosa Limitada presentó el proyecto.": set(),
    "pasaporte N° F8333100": {("identidad", "F8333100")},
    "Mónica Vera Soto firma": {("nombre", "Mónica Vera Soto")},
    "": set(),
    " \n ": set(),
}


@pytest.mark.parametrize("text", CASES)
def test_cases(text):
    assert {(k, " ".join(text[s:e].split())) for s, e, k in pii.find(text)} == CASES[text]


def test_spans_do_not_overlap_and_long_text_is_linear():
    text = ("Quien suscribe, Ana Pérez Soto, vive en Av. Las Rosas 4748. Su correo es a@b.example. " + "x " * 40) * 2000
    spans = pii.find(text)
    assert len(spans) == 6000 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_tables(spark):
    df = spark.createDataFrame([(1, "don Juan Vera y don Juan\nVera, a@b.example"), (2, None), (3, ""), (1, "a@b.example")], "doc_id bigint, text string").withColumn("tipo", F.lit("z")).withColumn("valor", F.lit(1))
    got = sorted(tuple(r) for r in pii.found_items(df).collect())
    assert got == [(1, "correo", "a@b.example"), (1, "correo", "a@b.example"), (1, "nombre", "Juan Vera")]
    red = {r["text"] for r in pii.redacted(df).collect()}
    assert red == {"don [NOMBRE] y don [NOMBRE], [CORREO]", None, "", "[CORREO]"}
    assert pii.found_items(df.limit(0)).count() == 0


def test_check_digit():
    assert all(pii.valid_rut(f"{n}-{rut(n)}") for n in (1234567, 30686957, 11111111, 40296072)) and not pii.valid_rut(BAD) and not pii.valid_rut("1-9")


def test_long_attendance_list():
    """A list of names is read to its end, however long it is."""
    text = "Asisten: " + "; ".join(f"{'ABCDEFGH'[i % 8]}. Soto Mora" for i in range(3000))
    assert sum(k == "nombre" for _, _, k in pii.find(text)) == 3000


UNSEEN = ["Gladys", "Wilson", "Wilmer", "Millaray", "Nahuel", "Yanara", "Ingeborg", "Tancredo", "Saúl", "Brígida"]
PHRASES = ["Firma: {}", "Asisten: {}; Ana Pérez Soto.", "comparece don {} y pide", "la señora {}, domiciliada ahí", "{}, RUT 12.345.678-5, solicita", "Mi nombre es {}.", "Quien suscribe, {}, consulta"]


def test_unseen_names_and_phrasings():
    """Given names that are in no list are found by a strong cue or an identity number, and by their shape."""
    found = total = 0
    for g in UNSEEN:
        for s in ("Pizarro Soto", "Aguirre", "Rojas de la Fuente"):
            for p in PHRASES:
                name = f"{g} {s}"
                total += 1
                found += name in [p.format(name)[a:b] for a, b, k in pii.find(p.format(name)) if k == "nombre"]
    assert found >= 0.95 * total, (found, total)
    for t in ("don Director de Obras", "señor Alcalde de Nufofadi", "Firma: Constructora Los Robles Limitada", "la Ordenanza General de Urbanismo"):
        assert not [k for _, _, k in pii.find(t) if k == "nombre"], t


def test_no_window_cuts_an_item():
    for n in (10, 100, 5000):
        mail = "a" * n + ".b@mail.example.cl"
        assert [t for t in (f"escriba a {mail} hoy"[a:b] for a, b, k in pii.find(f"escriba a {mail} hoy") if k == "correo")] == [mail]
    t = "Llame al 9 8765 4321"
    assert [(t[a:b], k) for a, b, k in pii.find(t)] == [("9 8765 4321", "telefono")]


def test_overlaps_against_brute_force():
    import random

    rng = random.Random(3)
    spans, at = [], 0
    for _ in range(200):
        at += rng.randint(0, 5)
        spans.append((at, at + rng.randint(1, 6), "correo"))
        at = spans[-1][1]
    ends = [e for _, e, _ in spans]
    for _ in range(2000):
        a = rng.randint(0, at)
        one = (a, a + rng.randint(1, 9), "nombre")
        assert pii.overlaps(spans, ends, one) == any(s < one[1] and one[0] < e for s, e, _ in spans)
