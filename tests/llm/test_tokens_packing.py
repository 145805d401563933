"""Encoding against public tokenizers, and packing against its constraints."""

import random

import pytest
from pyspark.sql import functions as F

from acervo.llm import packing, tokens

ALPHABET = "aaabbé ñ\n\t\r   ½²٣á😀\x1c\x85᠎<|endoftext|>'s'll12.,;中文ÁÉ​_-"


@pytest.fixture(scope="module")
def vocabulary():
    try:
        with open(tokens.BYTE_BPE_50K, "rb") as f:
            return f.read()
    except OSError:
        pytest.skip("no vocabulary file")


def test_same_ids_as_two_libraries(vocabulary):
    import base64

    import tiktoken
    from tokenizers import Tokenizer

    rng = random.Random(3)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 80))) for _ in range(1500)] + ["a" * 5000, "ab" * 3000, "\n" * 2000, "", "¡Artículo 4° de la Ley!"]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    k = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    t = Tokenizer.from_file(tokens.BYTE_BPE_50K.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    e = tokens.PairIndexEncoder(vocabulary)
    got = e.encode(texts).to_pylist()
    assert got == [k.encode_ordinary(x) for x in texts] == [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]
    assert e.lengths(texts).tolist() == [len(x) for x in got]
    e.reset()
    assert e.encode(texts).to_pylist() == got
    assert [k.decode(x) for x in got[:200]] == texts[:200]


def test_table(spark, vocabulary):
    df = spark.createDataFrame([(1, "hola"), (1, "hola"), (None, "x"), (2, None), (3, ""), (4, " "), (5, "ñ" * 30000)], "doc_id bigint, text string").withColumn("ids", F.lit(1)).withColumn("tokens", F.lit("z"))
    rows = tokens.token_ids(df).collect()
    assert sorted(len(r["ids"]) for r in rows if r["doc_id"] in (2, 3)) == [0, 0] and len(rows) == 7
    counts = {(r["doc_id"], r["tokens"]) for r in tokens.token_counts(df).collect()}
    assert counts == {(r["doc_id"], len(r["ids"])) for r in rows}
    assert tokens.token_ids(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 97, 1000])
    histogram = {rng.randint(1, capacity): rng.randint(1, 400) for _ in range(60)}
    runs, used = packing.plan_runs(histogram, capacity)
    room, seen = {}, {}
    for length, rank, n, first, per in runs:
        for i in range(n):
            room[first + i // per] = room.get(first + i // per, 0) + length
            assert (length, rank + i) not in seen
            seen[(length, rank + i)] = 1
    assert len(seen) == sum(histogram.values()) and max(room.values()) <= capacity and set(room) == set(range(used))
    total = sum(k * v for k, v in histogram.items())
    assert used <= 1.2 * -(-total // capacity) + 2 and len(runs) <= 6 * len(histogram) + 6


def test_pack(spark):
    rng = random.Random(5)
    sizes = [0, 0, 0, 64, 128, 1000, 64] + [rng.choice([7, 7, 7, 7, rng.randint(1, 63)]) for _ in range(600)]
    counts = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)] + [(None, 5), (None, 5), (3000, None)], "doc_id bigint, tokens bigint").withColumn("largo", F.lit("z"))
    kinds = spark.createDataFrame([("chico", 64), ("grande", 640), ("malo", 0), (None, 5)], "contenedor string, capacidad int")
    rows = packing.pack(counts, kinds).collect()
    for kind, cap in (("chico", 64), ("grande", 640)):
        mine = [r for r in rows if r["contenedor"] == kind]
        per, texts = {}, {}
        for r in mine:
            per[r["contenedor_no"]] = per.get(r["contenedor_no"], 0) + r["largo"]
            texts.setdefault(r["doc_id"], []).append((r["desde"], r["largo"]))
        assert max(per.values()) <= cap and set(per) == set(range(len(per)))
        for i, n in enumerate(sizes):
            got = sorted(texts[i])
            assert sum(l for _, l in got) == n and (len(got) == 1 or n > cap) and [d for d, _ in got] == [sum(l for _, l in got[:k]) for k in range(len(got))]
        assert sum(l for _, l in texts[None]) == 10 and len(per) <= 1.1 * (sum(sizes) + 10) / cap + 2
    assert {r["contenedor"] for r in rows} == {"chico", "grande"}
    assert packing.pack(counts.limit(0), kinds).count() == 0 and packing.pack(counts, kinds.limit(0)).count() == 0
    report = {r["contenedor"]: r for r in packing.fill_report(packing.pack(counts, kinds), kinds).collect()}
    assert report["grande"]["mas_lleno"] <= 640 and report["grande"]["contenedores"] >= report["grande"]["minimo"]


def test_proof_of_a_packing(spark):
    """Nothing is overfull, lost, repeated or divided without need; also with texts beyond the capacity and without tokens."""
    rng = random.Random(9)
    sizes = [(i, rng.choice([0, 1, 7, 30, 64, 65, 200, 1000])) for i in range(400)]
    counts = spark.createDataFrame(sizes, "doc_id bigint, tokens bigint")
    kinds = spark.createDataFrame([("chico", 64), ("grande", 512)], "contenedor string, capacidad int")
    rows = packing.proof(counts, kinds).collect()
    assert {tuple(r) for r in rows} == {("chico", 0, 0, 0, 0), ("grande", 0, 0, 0, 0)}


def test_driver_gets_one_row_per_kind(spark, monkeypatch):
    """Neither histograms nor plans of the many kinds of containers pass through the driver."""
    sizes = [(i, i % 250) for i in range(500)]
    counts = spark.createDataFrame(sizes, "doc_id bigint, tokens bigint")
    kinds = spark.createDataFrame([(f"k{i}", 150 + i) for i in range(20)], "contenedor string, capacidad int")
    frame, collected = type(counts), []
    collect, create = frame.collect, type(spark).createDataFrame
    monkeypatch.setattr(frame, "collect", lambda self: collected.append(collect(self)) or collected[-1])
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **k: collected.append(data) or create(self, data, *a, **k))
    packed = packing.pack(counts, kinds)
    monkeypatch.undo()
    assert collected and max(map(len, collected)) <= 20
    packed = packed.cache()
    fullest = packed.groupBy("contenedor", "contenedor_no").agg(F.sum("largo").alias("t")).groupBy("contenedor").agg(F.max("t").alias("t"), F.count("*").alias("n"), F.max("contenedor_no").alias("last")).collect()
    assert len(fullest) == 20 and all(r["t"] <= 150 + int(r["contenedor"][1:]) and r["n"] == r["last"] + 1 for r in fullest)
    placed = packed.groupBy("contenedor", "doc_id").agg(F.sum("largo").alias("l")).collect()
    packed.unpersist()
    assert len(placed) == 20 * len(sizes) and all(r["l"] == r["doc_id"] % 250 for r in placed)


def test_columns_travel_with_counts(spark):
    df = spark.createDataFrame([(None, "uno dos", "a"), (1, None, None), (1, "", "b"), (1, "uno dos", "a")], "doc_id bigint, text string, source string")
    got = sorted((str(r["doc_id"]), str(r["source"]), r["tokens"]) for r in tokens.token_counts(df, also=("source",)).collect())
    assert [(a, b, t > 0) for a, b, t in got] == [("1", "None", False), ("1", "a", True), ("1", "b", False), ("None", "a", True)]
