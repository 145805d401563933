"""Wide tables and orphan references against brute force."""

import datetime as dt
import random

from pyspark.sql import functions as F

from acervo.operators import orphans as O
from acervo.operators import wide

NAMES = [("num_ddu", "numero_ddu", "Encabezado", "entero"), ("numero_ddu", "numero_ddu", "Encabezado", "entero"), ("fecha", "fecha", "F", "fecha"), ("firmado", "firmado", "F", "booleano"), ("materia", "materia", "M", "texto")]


def names(spark):
    return spark.createDataFrame(NAMES, "nombre string, campo string, bloque string, tipo string")


def test_wide(spark):
    rows = [
        ("a", 1, "Num DDU", "DDU 1.008"), ("a", 2, " NUMERO-DDU ", "ilegible"), ("a", 3, "materia", "x"), ("a", 3, "materia", "x"), ("a", 4, "desconocida", "y"), ("a", 5, "Fecha", "2001-02-31"),
        ("b", 1, "numero_ddu", "ilegible"), ("b", 2, "num_ddu", "12"), ("b", 3, "firmado", "Sí"), ("b", 4, "materia", "S/I"), ("b", 5, None, "z"), ("b", 6, "fecha", None), ("c", 1, "otra", "x"), (None, 1, "materia", "x"),
    ]
    eav = spark.createDataFrame(rows, "file string, row_no int, campo string, valor_extraido string").withColumn("pos", F.lit("choca")).withColumn("v", F.lit(1))
    table = {r["file"]: r.asDict() for r in wide.wide_table(eav, names(spark)).collect()}
    assert table["a"] == {"file": "a", "fecha": None, "firmado": None, "materia": "x", "numero_ddu": None}
    assert table["b"] == {"file": "b", "fecha": None, "firmado": True, "materia": None, "numero_ddu": 12}
    assert set(table) == {"a", "b", "c"}
    cells = sorted(tuple(r) for r in wide.filled_cells(eav, names(spark)).collect())
    assert cells == [("a", "materia", 3), ("b", "firmado", 3), ("b", "numero_ddu", 2)]
    assert wide.filled_cells(eav.limit(0), names(spark)).count() == 0 and wide.filled_cells(eav, names(spark).limit(0)).count() == 0


def at(day):
    return dt.datetime(2020, 1, 1) + dt.timedelta(days=day)


def test_orphans_against_brute_force(spark):
    rng = random.Random(3)
    registry = [(rng.choice([1, 2, 3, 5, 8, None]), at(rng.randint(0, 50)), rng.choice([None, at(rng.randint(20, 90))])) for _ in range(40)] + [(9, None, None)]
    refs = [(i, rng.choice([at(rng.randint(0, 100)), None]) if i % 17 == 0 else at(rng.randint(0, 100)), "numero", rng.choice([1, 1, 1, 2, 3, 4, 5, 9, 1000])) for i in range(300)]
    r = spark.createDataFrame(registry, "num int, alta_en timestamp, baja_en timestamp")
    c = spark.createDataFrame(refs, "circular_id bigint, recibido_en timestamp, campo string, num int")
    got = sorted((x["circular_id"], x["num"]) for x in O.orphans(c, r).collect())
    known = lambda t, n: t is not None and any(m == n and a is not None and a <= t and (b is None or t < b) for m, a, b in registry)
    assert got == sorted((i, n) for i, t, _, n in refs if not known(t, n))
    never = {x["num"] for x in O.orphans(c, r).where("nunca").collect()}
    assert never <= {4, 1000}
    assert O.orphans(c, r.limit(0)).count() == 300 and O.orphans(c.limit(0), r).count() == 0


def test_references(spark):
    notes = {
        "Ver DDU Nos. 227, 2.613 y 2611": [227, 2613, 2611], "modif. DDU-1288; ord. 781/1994": [1288], "D.D.U. 416.": [416], "NOTA: (DDU 3695, punto 9)": [3695], "Modificada por Ley N° 20.507": [],
        "DDU227 y DDU N°227": [227], "Circular Ord. N°9, de fecha 27.06.1995, ddu n° 1661 (numeral 9.)": [1661], "DDU 147, de fecha 19.07.2022": [147], "": [], None: [], "DDU 99999999999999": [],
    }
    df = spark.createDataFrame([(i, None, " DDU  1.453 ", n) for i, n in enumerate(notes)], "circular_id int, recibido_en timestamp, numero string, modificaciones_posteriores string")
    out = {i: [] for i in range(len(notes))}
    for r in O.references(df).collect():
        if r["campo"] == "numero":
            assert r["num"] == 1453
        else:
            out[r["circular_id"]].append(r["num"])
    assert list(out.values()) == list(notes.values())


def test_bloom_has_no_false_negative(spark):
    keys = spark.range(5000).select((F.col("id") * 7).cast("int").alias("num"))
    bits = O.filter_bits(5000)
    words = O.bloom_words(keys, "num", bits).scalar()
    seen = spark.range(70000).select(F.col("id").cast("int").alias("k")).withColumn("m", O.might_contain(words, F.col("k"), bits))
    assert seen.where("k < 35000 and k % 7 = 0 and not m").count() == 0
    assert seen.where("k >= 35000 and m").count() < 0.05 * 35000


def test_dealt_join_gives_the_same_rows(spark):
    """Hot keys, null keys, repeated rows and keys without a partner: the dealt join equals the plain one."""
    from acervo.session import dealt

    left = spark.createDataFrame([(1, i) for i in range(50)] + [(1, 3), (2, 0), (None, 1), (4, 7)], "k int, v int")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (5, "e")], "k int, w string")
    for hot in (2, 1000):
        a, b, keys = dealt(left, right, ["k"], hot)
        assert (keys == ["k"]) == (hot == 1000)
        for how in ("inner", "left"):
            got = sorted(map(str, a.join(b, keys, how).select("k", "v", "w").collect()))
            assert got == sorted(map(str, left.join(right, ["k"], how).select("k", "v", "w").collect()))
