"""Packed fields: cases, edge cases, and a round trip against a plain reading."""

import random

import pytest
from pyspark.sql import functions as F

from acervo.operators import packed

CASES = {
    "A; B;C; ;": ["A", "B", "C"],
    '"A; uno"; «B; dos»; C «x» y': ["A; uno", "B; dos", "C «x» y"],
    '"A ""x"" y", "B, uno", "C"': ['A "x" y', "B, uno", "C"],
    '["A \\"x\\" y", "B; uno"]': ['A "x" y', "B; uno"],
    "1. A.; 2. B, con coma.; 3. C.": ["A", "B, con coma", "C"],
    "1) A; con copia 2) B 3) C": ["A; con copia", "B", "C"],
    "- A; b.\r\n- C.": ["A; b", "C"],
    "• A\n\n• B": ["A", "B"],
    "A // B || C | D\nE": ["A", "B", "C", "D", "E"],
    "«Centro «Taller» de X»; B": ["Centro «Taller» de X", "B"],
    "0; B": ["0", "B"],
    " \t\n ": [],
    "": [],
    None: [],
    "solo": ["solo"],
}


def values(spark, field, texts):
    schema = "circular_id bigint, campo string, pos int, " + ", ".join(f"{f} string" for f in packed.FIELDS)
    rows = [(i, "choca", 7, *[t if f == field else None for f in packed.FIELDS]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, schema)
    out = {i: [] for i in range(len(rows))}
    for r in packed.packed_values(df.drop("campo", "pos").withColumn("valor", F.lit("choca"))).orderBy("circular_id", "campo", "pos").collect():
        assert r["campo"] == field and r["pos"] == len(out[r["circular_id"]]) + 1
        out[r["circular_id"]].append(r["valor"])
    return list(out.values())


def test_cases(spark):
    assert values(spark, "lista_distribucion", list(CASES)) == list(CASES.values())


def test_notes(spark):
    cases = {
        "[1] Uno; sigue. [2] Dos": ["Uno; sigue", "Dos"],
        "1 Uno (2) x\n3 nada\n2 Dos": ["Uno (2) x 3 nada", "Dos"],
        "(1) Uno | (2) Dos\ncortado": ["Uno", "Dos cortado"],
        "Uno ¶ Dos; sigue ¶": ["Uno", "Dos; sigue"],
        '"Uno; x."; "Dos."': ["Uno; x", "Dos"],
        "Uno\nsigue": ["Uno sigue"],
    }
    assert values(spark, "notas_al_pie", list(cases)) == list(cases.values())


def test_manifest_ids(spark):
    cases = {
        'id: a; nombre: "x; id: no || y" || nombre: z; id: b': ["a", "b"],
        '[{"id": "a", "nombre": "x, {\\"id\\": 1}"}, {"nombre": "y", "id": "b"}]': ["a", "b"],
        "id: a\nid: b ||": ["a", "b"],
        "nombre: x": [],
    }
    assert values(spark, "tablas_manifiesto", list(cases)) == list(cases.values())


def test_placeholders_never_collide(spark):
    odd = f'"a{packed.OPEN}0{packed.CLOSE}; b"; {packed.OPEN}0{packed.CLOSE}; {packed.ESC}1'
    assert values(spark, "lista_distribucion", [odd]) == [[f"a{packed.OPEN}0{packed.CLOSE}; b", f"{packed.OPEN}0{packed.CLOSE}", f"{packed.ESC}1"]]


@pytest.mark.parametrize("seed", range(2))
def test_round_trip(spark, seed):
    rng = random.Random(seed)
    pool = ["Mesa Técnica", "Sr. Jefe, Depto. de X", "Unidad; con copia", "Grupo \"A\" de B", "Centro «C» de D", "Archivo"]
    texts, truth = [], []
    for _ in range(60):
        items = [rng.choice(pool) for _ in range(rng.randint(1, 9))]
        sep = rng.choice(["; ", ";", " | ", " // ", " || "])
        quote = lambda x: '"' + x.replace('"', '""') + '"'
        shown = [quote(x) if any(s.strip() and s.strip() in x for s in (";", "|", "//")) or rng.random() < 0.2 else x for x in items]
        texts.append(sep.join(shown))
        truth.append(items)
    assert values(spark, "lista_distribucion", texts) == truth


def test_long_value_and_repeated_rows(spark):
    long = "; ".join(f'"v {i}; x"' for i in range(3000))
    got = values(spark, "lista_distribucion", [long])
    assert len(got[0]) == 3000 and got[0][-1] == "v 2999; x"
    row = [(1, "A; B", None, None, None)] * 2
    df = spark.createDataFrame(row, "circular_id bigint, lista_distribucion string, descriptores string, notas_al_pie string, tablas_manifiesto string")
    assert packed.packed_values(df).count() == 4 and packed.packed_values(df.limit(0)).count() == 0
