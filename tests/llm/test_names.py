"""Variant spellings: the segment join against brute force, and links of invented people and offices."""

import random

from pyspark.sql import functions as F

from acervo.llm import names


def osa(a, b):
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_segment_join_finds_every_pair(spark, monkeypatch):
    monkeypatch.setattr(names, "HOT", 5)  # so that segments are split
    rng = random.Random(2)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(260)}
    df = spark.createDataFrame([("g", w) for w in words] + [("h", "abcabc")], "grupo string, a string")
    got = {(r["grupo"], r["a"], r["b"], r["d"]) for r in names.segment_join(df, df.withColumnRenamed("a", "b")).collect()}
    far = {(a, b) for a in words for b in words if min(len(a), len(b)) >= names.LEAST and osa(a, b) == 1}
    assert got == {("g", w, w, 0) for w in words} | {("g", a, b, 1) for a, b in far} | {("h", "abcabc", "abcabc", 0)}


GROUPS = {
    "nombre_firmante": [
        ["Tomás Guillermo Pugemamel Llancabel", "  Tomás  Guillermo Pugemamel Llancabel", "TOMSÁ PUGEMAMEL LLANCABEL", "Pugemamel Llancabel, T.", "T. Pugemamel Llancabel", "Tomás G. Pugemamel L.", "PUGEMAMEL LLANCABEL TOMÁS",
         "Tomás Pugemamel", "Arq. Tomás Pugemamel-Llancabel", "TOMÁS GUILERMO PUGEMAMEL LLANCABEL", "TOMÁS PUGE MAMEL LLANCABEL", "Guillermo Pugemamel Llancabel"],
        ["Rosa Elena Pugemamel Llancabel", "R. Pugemamel Llancabel"], ["Isabel Vera Mora", "Chabela Vera Mora", 'Isabel "Chabela" Vera Mora'], ["Isabel Soto Ríos", "ING. SOTO RÍOS", "ISABL SOTO RÍOS"], ["Inés Carmen Buritamos Ertuvia", "INS BURITAMOS ERTUVIA", "SRA. BURITAMOS ERTUVIA", "Burtamos, Inés Carmen", "Buritamos"],
    ],
    "emisor": [["JEFE DIVISIÓN DE DESARROLLO URBANO", "Jefe Div. Des. Urbano", "JEFE DIVISIÓ N DE DESARROLLO URBANO", "JEFA DIVISIÓN DE DESARROLLO URBANO (S)", "Jefe DDU"], ["JEFE DIVISIÓN JURÍDICA"],
               ["SEREMI ALTO SALAR", "SEREMI ALTO SAALR", "Alto Salar, SEREMI", "SRM REGIÓN DE ALTO SALAR", "SECRETARIO REGIONAL MINISTERIAL REGIÓN DE ALTO SALAR"]],
    "destinatarios": [["ALCALDE DE NUFOFADI", "ALACLDE DE NUFOFADI", "Nufofadi (Alcaldía)", "Sra. Alcaldesa de Nufofadi"], ["DOM Nufofadi", "D.O.M. NUFOFADI", "Dirección de Obras Municipales, I. Municipalidad de Nufofadi"], ["DOM Lipotegi"]],
}


def test_links(spark):
    rows = [(f, n) for f, gs in GROUPS.items() for g in gs for n in g for _ in range(2)] + [("destinatarios", x) for x in ("SEGÚN DISTRIBUCIÓN.", "Según distribución", "", " ", None)]
    rows += [("destinatarios", "DOM Pobupige"), ("destinatarios", "ALCALDE DE POBUPIGE")]
    df = spark.createDataFrame(rows, "campo string, nombre string").withColumn("entidad", F.lit("choca"))
    got = {tuple(r) for r in names.pairs(names.entities(df)).collect()}
    want = {(f, *sorted((a, b))) for f, gs in GROUPS.items() for g in gs for i, a in enumerate(g) for b in g[i + 1 :]}
    assert got == want


def test_empty_and_long(spark):
    df = spark.createDataFrame([("emisor", "x " * 3000)], "campo string, nombre string")
    assert names.pairs(names.entities(df)).count() == 0 and names.entities(df.limit(0)).count() == 0
