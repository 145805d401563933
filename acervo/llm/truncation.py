"""Values whose end was lost, at a field limit or in transfer.

Method: a backward character n-gram model. For the characters before a place it counts how often the text ends there and
how often it goes on (within a word, at the end of a clause, otherwise). The final context of each value is looked up from
the longest order downwards; the log-odds of end against continuation, less what the length of the value says about a
limit of its source, are compared with a threshold per language and column. Ends are learnt from values closed by a full
stop, so cut values don't teach that a text may end where they were cut.

Contexts are 64-bit rolling hashes; continuations are counted only for contexts that close some value (a broadcast bitmap
of bounded size says which), so what is shuffled follows the different ends and not the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acervo.session import cut, dealt, small

#: Orders of the model, longest first, and the events an order must have seen to be believed.
ORDERS, EVIDENCE = (24, 16, 10, 6, 4), 4
#: Added to counts; share of clause ends that count as ends.
SMOOTH, CLAUSE = 0.3, 0.5
#: Bounds of the threshold, and the share of closed values below it from which it is learnt.
LOW, HIGH, SHARE = -2.5, -1.0, 0.025
#: A length counts as a limit if it is this many times (as a logarithm) as frequent as its surroundings, and at least so often.
LIMIT_LOG, LIMIT_LEAST, AROUND, GAP = 1.5, 8, 30, 6
#: Bounds of the bitmap in bits.
MIN_BITS, MAX_BITS = 1 << 18, 1 << 26
BLOCK = 1 << 20

# Marks that say themselves that a text goes on, and frequent English words.
MARK = r"(?:\.\.\.|…|�|\[(?:\.\.\.|…)\]|\((?:\.\.\.|…)\)|\((?:cont|sigue)[^()]*\)?)\s*$"
ENGLISH = r"(?i)\b(?:the|of|and|is|for|with|shall)\b"
SPANISH = r"(?i)\b(?:el|la|los|las|de|del|y|en|que|para|con)\b"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PAD = "\x02" * max(ORDERS)
_ITEM = re.compile(r"\. [0-9]{1,2}\)")


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


@lru_cache(maxsize=2)
def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(_BASE, n), _powers(_INVERSE, n)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalnum() for i in range(1 << 16)])


def rolling(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` characters before each place from ``n`` to the end, as signed 64-bit numbers."""
    size = 1 << max(12, int(len(codes) + 1).bit_length())
    up, down = _tables(size)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(codes.astype(np.uint64) * up[: len(codes)], dtype=np.uint64)])
    h = (sums[n:] - sums[:-n]) * down[: len(sums) - n]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h.view(np.int64)


def core(value: str) -> tuple[str, str]:
    """The text of a value without padding blanks and closing mark, and its kind.

    E: with a mark that it goes on; P: closed; Q: closed, over several lines (its last word may be broken or misread); N: open.
    """
    t = " ".join(value.split())
    m = re.search(MARK, t)
    if m:
        return t[: m.start()].rstrip(" ."), "E"
    if t.endswith("."):
        return t[:-1], "Q" if "\n" in value.strip() else "P"
    return t, "N"


def _codes(t: str) -> np.ndarray:
    return np.frombuffer((_PAD + t).encode("utf-32-le", "surrogatepass"), np.uint32)


def values(df: DataFrame, key: str, source: str, fields: tuple[str, ...]) -> DataFrame:
    """``(key, fuente, campo, lengua, texto)`` of the fields that are not null or blank."""
    each = df.select(key, F.col(source).alias("fuente"), F.explode(F.array(*[F.struct(F.lit(f).alias("campo"), F.col(f).alias("texto")) for f in fields])).alias("v"))
    rows = each.select(key, "fuente", "v.*").where(r"texto rlike '\\S'")
    english, spanish = F.regexp_count("texto", F.lit(ENGLISH)), F.regexp_count("texto", F.lit(SPANISH))
    return rows.withColumn("lengua", F.when(english > spanish, "en").otherwise("es"))


def endings(rows: DataFrame, key: str) -> DataFrame:
    """``(key, fuente, campo, lengua, tipo, largo, fin ARRAY<BIGINT>)``: kind, length and hashed final contexts of each value."""
    kept = [key, "fuente", "campo", "lengua"]
    source = rows.select(*kept, "texto")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kinds, sizes, hashes = [], [], []
            for v in b.column(4).to_pylist():
                t, kind = core(v)
                c = _codes(t)
                kinds.append(kind)
                sizes.append(len(v))
                hashes.append([int(rolling(c[-n:], n)[0]) for n in ORDERS])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], pa.array(kinds, pa.string()), pa.array(sizes, pa.int32()), pa.array(hashes, pa.list_(pa.int64()))], names=[*kept, "tipo", "largo", "fin"]
            )

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields[:4])
    return source.mapInArrow(run, f"{ddl}, tipo string, largo int, fin array<bigint>")


def bitmap(ends: DataFrame, bits: int) -> np.ndarray:
    """The bits of all final contexts; at most ``bits / 64`` rows come to the driver."""
    at = ends.select(F.explode("fin").alias("h")).select(F.pmod("h", F.lit(bits)).alias("p"))
    words = at.select(F.floor(F.col("p") / 64).cast("int").alias("w"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    out = np.zeros(bits // 64, np.int64)
    got = words.toPandas()
    out[got["w"].to_numpy(np.int64)] = got["b"].to_numpy(np.int64)
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool) if bits <= MAX_BITS else out


def counts(rows: DataFrame, bits: np.ndarray) -> DataFrame:
    """``(campo, lengua, orden, h, fines, clausulas, letras, otros)``: what follows each context that closes some value."""
    packed = rows.sparkSession.sparkContext.broadcast(np.packbits(bits))
    size = len(bits)
    source = rows.select("campo", "lengua", "texto")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(packed.value).astype(bool)
        for b in batches:
            groups: dict[tuple[str, str], list[str]] = {}
            for f, g, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                groups.setdefault((f, g), []).append(v)
            for (f, g), texts in groups.items():
                for order, h, events in followed(texts, known, size):
                    n = len(h)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f] * n, pa.string()), pa.array([g] * n, pa.string()), pa.array([order] * n, pa.int32()), pa.array(h), *[pa.array(e, pa.int64()) for e in events]],
                        names=["campo", "lengua", "orden", "h", "fines", "clausulas", "letras", "otros"],
                    )

    parts = source.mapInArrow(run, "campo string, lengua string, orden int, h bigint, fines bigint, clausulas bigint, letras bigint, otros bigint")
    return parts.groupBy("campo", "lengua", "orden", "h").agg(*[F.sum(c).alias(c) for c in ("fines", "clausulas", "letras", "otros")])


def followed(texts: list[str], known: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each order: contexts and how often an end, a clause end, a letter or something else follows them."""
    start = 0
    while start < len(texts):
        codes, events, total = [], [], 0
        while start < len(texts) and (total < BLOCK or not codes):
            t, kind = core(texts[start])
            start += 1
            c = _codes(t)
            k = len(_PAD)
            # event at each place: 0 none, 1 end, 2 clause end, 3 letter, 4 other
            e = np.zeros(len(c) + 1, np.uint8)
            body = c[k:]
            if len(body) > 1:
                nxt = body[1:]
                e[k + 1 : -1] = np.where(_letters()[np.minimum(nxt, 0xFFFF)], 3, 4)
                stop = np.isin(nxt, [44, 59, 40, 41])
                after = np.concatenate([stop[1:], [False]])
                e[k + 1 : -1][stop | ((nxt == 32) & after)] = 2
                for m in _ITEM.finditer(t):
                    e[k + m.start()] = 1
            if kind in "PQ":
                e[-1] = 1
            codes.append(c)
            events.append(e[1:])
            total += len(c)
        c, e = np.concatenate(codes), np.concatenate(events)
        for n in ORDERS:
            h = rolling(c, n)
            ev = e[n - 1 :]
            ok = (ev > 0) & known[h % size]
            u, back = np.unique(h[ok], return_inverse=True)
            if len(u):
                yield n, u, np.array([np.bincount(back[ev[ok] == k], minlength=len(u)) for k in (1, 2, 3, 4)])


def _odds(good: Column, bad: Column) -> Column:
    return F.log((good + SMOOTH) / (bad + SMOOTH))


def scored(ends: DataFrame, model: DataFrame) -> DataFrame:
    """``ends`` with ``logodds`` (end against continuation) and ``en_palabra`` (the same, against letters only).

    Different final contexts are scored once; a closed value does not count as evidence for itself. Without evidence at any
    order both are null.
    """
    place = F.col("fin")[0].alias("c")
    different = ends.select("campo", "lengua", F.col("tipo").isin("P", "Q").alias("propio"), place, "fin").distinct()
    orders = F.array(*[F.struct(F.lit(n).alias("orden"), F.col("fin")[i].alias("h")) for i, n in enumerate(ORDERS)])
    each = different.select("campo", "lengua", "propio", "c", F.explode(orders).alias("o")).select("campo", "lengua", "propio", "c", "o.*")
    # Short contexts are shared by very many values; one row of the model meets them in several tasks.
    left, right, keys = dealt(each, model, ["campo", "lengua", "orden", "h"])
    seen = left.join(right, keys).withColumn("fines", F.col("fines") - F.col("propio").cast("int"))
    seen = seen.where(F.col("fines") + F.col("clausulas") + F.col("letras") + F.col("otros") >= EVIDENCE)
    main = _odds(F.col("fines") + CLAUSE * F.col("clausulas"), F.col("letras") + F.col("otros") + (1 - CLAUSE) * F.col("clausulas"))
    word = _odds(F.col("fines") + F.col("clausulas") + F.col("otros"), F.col("letras"))
    best = seen.groupBy("campo", "lengua", "propio", "c").agg(F.max(F.struct("orden", main.alias("m"), word.alias("w"))).alias("b"))
    scores = best.select("campo", "lengua", "propio", "c", F.col("b.m").alias("logodds"), F.col("b.w").alias("en_palabra"))
    named = ends.withColumn("propio", F.col("tipo").isin("P", "Q")).withColumn("c", F.col("fin")[0])
    left, right, keys = dealt(named, scores, ["campo", "lengua", "propio", "c"])
    return left.join(right, keys, "left").drop("propio", "c", "fin", "_sal")


def limits(ends: DataFrame) -> DataFrame:
    """``(fuente, campo, largo, limite)``: how much the length of an open value speaks for a limit of its source.

    One row per source, column and length; the windows run over this histogram, which is bounded by the longest value.
    """
    counts = ends.where("tipo = 'N'").groupBy("fuente", "campo", "largo").agg(F.count("*").alias("n"))
    by = Window.partitionBy("fuente", "campo").orderBy("largo")
    wide = F.coalesce(F.sum("n").over(by.rangeBetween(-AROUND, AROUND)), F.lit(0)) - F.coalesce(F.sum("n").over(by.rangeBetween(-GAP, GAP)), F.lit(0))
    usual = wide / (2 * (AROUND - GAP)) + 0.5
    ratio = F.log((F.col("n") + 0.5) / usual) - LIMIT_LOG
    return counts.select("fuente", "campo", "largo", F.when((F.col("n") >= LIMIT_LEAST) & (ratio > 0), ratio).otherwise(F.lit(0.0)).alias("limite"))


def judged(df: DataFrame, key: str = "circular_id", source: str = "fuente", fields: tuple[str, ...] = ("materia", "antecedentes")) -> DataFrame:
    """``(key, fuente, campo, tipo, logodds, cortado)``: one row per value that is not null or blank.

    A value with a mark that it goes on is cut. An open value is cut if its log-odds, less what its length says, are below
    the threshold of its language and column. A closed value of one line is cut only if it ends within a word. A value without evidence
    counts as whole unless its length is a limit. Repeated rows give repeated rows; a null source is a source of its own.
    """
    rows = values(df, key, source, fields)
    ends = cut(endings(rows, key))
    n = ends.select(F.approx_count_distinct(F.col("fin")[0])).first()[0]
    bits = bitmap(ends, min(MAX_BITS, max(MIN_BITS, 1 << (int(n) * len(ORDERS) * 8).bit_length())))
    marks = cut(scored(ends, counts(rows, bits)))
    learnt = marks.where("tipo in ('P', 'Q') and logodds is not null").groupBy("campo", "lengua").agg(F.percentile_approx("logodds", SHARE).alias("q"))
    thresholds = learnt.select("campo", "lengua", F.greatest(F.least("q", F.lit(HIGH)), F.lit(LOW)).alias("umbral"))
    length = limits(marks).withColumnRenamed("fuente", "_f")
    whole = marks.join(small(thresholds), ["campo", "lengua"], "left").join(
        length.withColumnRenamed("campo", "_c").withColumnRenamed("largo", "_l"),
        F.col("fuente").eqNullSafe(F.col("_f")) & (F.col("campo") == F.col("_c")) & (F.col("largo") == F.col("_l")), "left",
    )
    bound = F.coalesce("umbral", F.lit(LOW))
    open_cut = F.coalesce("logodds", F.lit(0.0)) - F.coalesce("limite", F.lit(0.0)) < bound
    closed_cut = F.coalesce("en_palabra", F.lit(0.0)) < F.lit(LOW)
    decision = F.when(F.col("tipo") == "E", True).when(F.col("tipo") == "N", open_cut).when(F.col("tipo").isin("P", "Q"), closed_cut).otherwise(False)
    return whole.select(key, "fuente", "campo", "tipo", "logodds", decision.alias("cortado"))


def cut_rates(judgements: DataFrame) -> DataFrame:
    """Values, cut values and their share per source and column."""
    return judgements.groupBy("fuente", "campo").agg(
        F.count("*").alias("valores"), F.sum(F.col("cortado").cast("bigint")).alias("cortados"), F.round(F.avg(F.col("cortado").cast("double")), 6).alias("tasa")
    )
