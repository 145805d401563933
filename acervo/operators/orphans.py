"""References to keys that no row of the parent table holds at the time of the reference.

Method: a broadcast Bloom filter of the parent keys proves definite orphans; only the references that pass it are
verified by an exact join, then both parts are counted per field and period.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo.session import cut, dealt

#: Bounds of the Bloom filter in bits. The upper one bounds what is broadcast (8 MB); with more keys than it suits, the
#: filter only passes more references on to the exact join.
MIN_BITS, MAX_BITS = 1 << 12, 1 << 26
HASHES = 4
#: References of one key that one task verifies; the references of a key with more are dealt over copies of its parent rows.
HOT = 100_000

#: A circular number, with or without thousands points, and a list of such numbers behind the mark "DDU".
NUMBER = r"[0-9]{1,3}(?:\.[0-9]{3})+|[0-9]+"
CITED = (
    r"(?i)\bD\.?\s?D\.?\s?U\.?[\s:-]*(?:n[°ºo]?s?\.?|n[°º]s|nros?\.?|n[uú]ms?\.?|n[uú]meros?)?[\s:-]*"
    rf"((?:{NUMBER})(?:\s*(?:,|y|e)\s*(?:n[°º]\s*)?(?:{NUMBER}))*)"
)


def _positions(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(HASHES)]


def filter_bits(keys: int) -> int:
    """Bits of a filter for so many keys: about 10 a key, a power of two within the bounds."""
    return min(MAX_BITS, max(MIN_BITS, 1 << math.ceil(math.log2(max(1, 10 * keys)))))


def bloom_words(parents: DataFrame, key: str, bits: int) -> DataFrame:
    """One row with the Bloom filter of ``key`` as an array of ``bits / 64`` longs.

    The bits are combined on the map side into at most ``bits / 64`` words, so a parent table of any size shuffles a
    bounded number of rows.
    """
    spark = parents.sparkSession
    at = F.explode(F.array(*_positions(F.col(key), bits)))
    words = parents.where(F.col(key).isNotNull()).select(at.alias("p")).select(
        F.floor(F.col("p") / 64).cast("int").alias("w"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("b")
    )
    empty = spark.range(bits // 64).select(F.col("id").cast("int").alias("w"), F.lit(0).cast("bigint").alias("b"))
    full = words.groupBy("w").agg(F.bit_or("b").alias("b")).unionByName(empty).groupBy("w").agg(F.bit_or("b").alias("b"))
    return full.agg(F.array_sort(F.collect_list(F.struct("w", "b"))).alias("a")).select(F.transform("a", lambda x: x["b"]).alias("words"))


def might_contain(words: Column, key: Column, bits: int) -> Column:
    """False only if the filter proves that ``key`` is no parent key."""
    hit = F.lit(True)
    for p in _positions(key, bits):
        word = F.get(words, F.floor(p / 64).cast("int"))
        hit = hit & (F.call_function("getbit", word, F.pmod(p, F.lit(64)).cast("int")) == 1)
    return F.coalesce(hit, F.lit(False))


def references(circulares: DataFrame) -> DataFrame:
    """``(circular_id, recibido_en, campo, num)``: each circular number named in ``numero`` or ``modificaciones_posteriores``.

    In the latter only numbers behind the mark DDU count. A number counts once per record and field; numbers beyond INT
    are no circular numbers. Null, empty and blank fields give no row.
    """

    def numbers(texts: Column) -> Column:
        parts = F.flatten(F.transform(texts, lambda t: F.regexp_extract_all(t, F.lit(f"({NUMBER})"), F.lit(1))))
        ints = F.transform(parts, lambda x: F.replace(x, F.lit("."), F.lit("")).try_cast("int"))
        return F.array_distinct(F.filter(ints, lambda x: x.isNotNull()))

    fields = F.array(
        F.struct(F.lit("numero").alias("campo"), numbers(F.array("numero")).alias("nums")),
        F.struct(F.lit("modificaciones_posteriores").alias("campo"), numbers(F.regexp_extract_all("modificaciones_posteriores", F.lit(CITED), F.lit(1))).alias("nums")),
    )
    return (
        circulares.select("circular_id", "recibido_en", F.explode(fields).alias("f"))
        .select("circular_id", "recibido_en", F.col("f.campo").alias("campo"), F.explode_outer("f.nums").alias("num"))
        .where("num is not null")  # the outer form keeps the numbers from being computed again in an inferred filter
    )


def orphans(refs: DataFrame, registry: DataFrame) -> DataFrame:
    """The rows of ``refs`` for whose ``num`` no registry row is in force at ``recibido_en``, plus ``nunca``.

    ``nunca`` is true if the filter proves that the number was never registered. A registry row is in force from
    ``alta_en`` (inclusive; null: never) to ``baja_en`` (exclusive; null: still). A reference without a time has no row in
    force and is an orphan. The references are read and marked once and written to the shared folder; only those that pass
    the filter are shuffled. In the exact join the references of one number are dealt over as many copies of its parent
    rows as their count asks for (:data:`HOT`), so a number that a third of all references name doesn't end in one task.
    """
    keys = registry.agg(F.approx_count_distinct("num").alias("n")).collect()[0]["n"]
    bits = filter_bits(keys)
    words = bloom_words(registry.select("num"), "num", bits).scalar()
    seen = cut(refs.withColumn("_w", words).select(*refs.columns, (~might_contain(F.col("_w"), F.col("num"), bits)).alias("nunca")))
    never, maybe = seen.where("nunca"), seen.where("not nunca")
    spans = registry.where(F.col("num").isNotNull() & F.col("alta_en").isNotNull()).select("num", "alta_en", "baja_en")
    left, right, keys = dealt(maybe, spans, ["num"], HOT)
    r = right.select(*[F.col(c).alias(f"_{c}") for c in right.columns])
    in_force = (F.col("recibido_en") >= F.col("_alta_en")) & (F.col("_baja_en").isNull() | (F.col("recibido_en") < F.col("_baja_en")))
    for k in keys:
        in_force = in_force & (F.col(k) == F.col(f"_{k}"))
    return never.unionByName(left.join(r, in_force, "left_anti").select(*never.columns))


def orphan_report(found: DataFrame) -> DataFrame:
    """Orphans per field and month of loading: references, different numbers and records concerned."""
    return found.groupBy("campo", F.date_format("recibido_en", "yyyy-MM").alias("periodo")).agg(
        F.count("*").alias("referencias"), F.countDistinct("num").alias("numeros"), F.countDistinct("circular_id").alias("registros")
    )
