"""Filling containers of fixed capacity with items of varying length.

Method: length-histogram planning. Best-fit-decreasing runs over the counts of lengths, not over items, and gives runs of
slots; then items take the planned slots by joining on their rank within their length. The histogram and the plan of a
kind of container are bounded by its capacity, whatever the number of items. Each kind is planned in one task and its plan
is written to the shared folder; the driver gets one row per kind.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acervo.session import cut, small

#: Slots made by one task row at a time, and items of one group in the ranking; both only bound the work of a task.
SLOT_BLOCK = 50_000
GROUP_ROWS = 250_000
#: Most kinds of containers handled at once; their list is read by the driver.
MAX_KINDS = 100


def plan_runs(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best-fit-decreasing over counts.

    Returns runs ``(length, first rank, slots, first container, slots per container)`` and the number of containers.
    Containers with the same room are handled together: a group splits in at most three parts per length, so the number
    of runs is in the order of the number of lengths.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    rooms: list[int] = []  # sorted rooms with groups
    groups: dict[int, list[tuple[int, int]]] = {}  # room -> (first container, containers)
    used = 0

    def put(room: int, first: int, n: int) -> None:
        if n <= 0 or room <= 0:
            return
        if room not in groups:
            insort(rooms, room)
            groups[room] = []
        groups[room].append((first, n))

    for length in sorted((x for x in histogram if x > 0), reverse=True):
        left, rank = histogram[length], 0
        while left:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                first, n = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[i]
            else:
                per = capacity // length
                room, first, n = capacity, used, -(-left // per)
                used += n
            per = room // length
            full = min(n, left // per)
            if full:
                runs.append((length, rank, full * per, first, per))
                put(room - per * length, first, full)
                rank, left = rank + full * per, left - full * per
            rest = n - full
            if rest and left and left < per:
                runs.append((length, rank, left, first + full, left))
                put(room - left * length, first + full, 1)
                rank, left, full, rest = rank + left, 0, full + 1, rest - 1
            put(room, first + full, rest)
    return runs, used


def planned(parts: DataFrame, kinds: list[tuple[str, int]]) -> DataFrame:
    """``(contenedor, largo, primero, n, desde_no, por)``: the runs of :func:`plan_runs` of each kind, planned in one task a kind.

    Items without length have one run per kind that names no container (``por`` 0); it holds their number.
    """
    capacity = dict(kinds)
    columns = ["largo", "primero", "n", "desde_no", "por"]

    def run(kind: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        name = kind[0].as_py()
        histogram = dict(zip(rows["largo"].to_pylist(), rows["n"].to_pylist()))
        runs, _ = plan_runs(histogram, capacity[name])
        runs += [(length, 0, n, 0, 0) for length, n in histogram.items() if length <= 0]
        return pa.table([pa.array([name] * len(runs), pa.string()), *[pa.array([r[i] for r in runs], pa.int64()) for i in range(5)]], names=["contenedor", *columns])

    histograms = parts.groupBy("contenedor", "largo").agg(F.count("*").alias("n"))
    return histograms.groupBy("contenedor").applyInArrow(run, "contenedor string, " + ", ".join(f"{c} bigint" for c in columns))


def items(counts: DataFrame, kinds: list[tuple[str, int]], key: str = "doc_id", size: str = "tokens") -> DataFrame:
    """``(contenedor, key, pieza, desde, largo)``: the items of each kind of container.

    A text is one item unless it alone exceeds the capacity; then it is divided into pieces of the capacity and a rest.
    """
    kind = F.explode(F.array(*[F.struct(F.lit(n).alias("contenedor"), F.lit(c).cast("bigint").alias("cap")) for n, c in kinds]))
    each = counts.select(F.col(key), F.coalesce(F.col(size), F.lit(0)).cast("bigint").alias("n"), kind.alias("k")).select(key, "n", "k.*")
    pieces = each.withColumn("pieza", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / F.col("cap")) - 1, F.lit(0)).cast("int"))))
    start = F.col("pieza") * F.col("cap")
    return pieces.select("contenedor", key, "pieza", start.alias("desde"), F.least(F.col("cap"), F.col("n") - start).alias("largo"))


def ranked(df: DataFrame, groups: int, key: str = "doc_id") -> DataFrame:
    """Adds ``orden``, the rank from 0 within ``(contenedor, largo)``.

    A length may hold a large part of all items, so each is dealt over ``groups`` sub-groups by a hash; ranks within a
    sub-group are shifted by the sizes of the sub-groups before it.
    """
    dealt = df.withColumn("_g", F.pmod(F.xxhash64(key, "pieza"), F.lit(groups)).cast("int"))
    sizes = dealt.groupBy("contenedor", "largo", "_g").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("contenedor", "largo").orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("contenedor", "largo", "_g", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_s"))
    inner = Window.partitionBy("contenedor", "largo", "_g").orderBy(key, "pieza")
    return (
        dealt.withColumn("_r", F.row_number().over(inner) - 1)
        .join(shifts, ["contenedor", "largo", "_g"])
        .withColumn("orden", F.col("_r") + F.col("_s"))
        .drop("_g", "_r", "_s")
    )


def pack(counts: DataFrame, containers: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(contenedor, contenedor_no, key, pieza, desde, largo)``: every text in a container of every kind.

    ``counts`` has ``key`` and ``tokens``; ``containers`` has ``contenedor`` and ``capacidad`` (at least 1; other kinds are
    left out). Container numbers count from 0 within their kind. A text without tokens (null or empty) takes no room; such
    texts are dealt evenly over the planned containers (number 0 if there is none). Repeated and null keys are items of
    their own. ``counts`` is written once to the shared folder, as it feeds the histogram and the ranks, and so is the plan.
    """
    spark = counts.sparkSession
    rows = containers.where("contenedor is not null and capacidad >= 1").groupBy("contenedor").agg(F.min("capacidad").alias("c")).limit(MAX_KINDS + 1).collect()
    if len(rows) > MAX_KINDS:
        raise ValueError(f"more than {MAX_KINDS} kinds of containers")
    kinds = sorted((r["contenedor"], int(r["c"])) for r in rows)
    schema = f"contenedor string, contenedor_no bigint, {key} {counts.schema[key].dataType.simpleString()}, pieza int, desde bigint, largo bigint"
    if not kinds:
        return spark.createDataFrame([], schema)
    parts = items(cut(counts), kinds, key)
    plan = cut(planned(parts, kinds))
    end = F.when(F.col("por") > 0, F.col("desde_no") + F.ceil(F.col("n") / F.col("por")))
    by_length = plan.groupBy("contenedor", "largo").agg(F.sum("n").alias("n"), F.max(end).alias("fin"))
    ends = by_length.groupBy("contenedor").agg(F.max("n").alias("n"), F.max("fin").alias("fin")).collect()  # one row per kind
    used = {n: 0 for n, _ in kinds} | {r["contenedor"]: r["fin"] or 0 for r in ends}
    groups = max(16, -(-max((r["n"] for r in ends), default=0) // GROUP_ROWS))
    runs = plan.where("por > 0")
    blocks = runs.withColumn("b", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / SLOT_BLOCK)))).repartition("contenedor", "largo", "b")
    low = F.col("b") * SLOT_BLOCK
    slots = blocks.withColumn("i", F.explode(F.sequence(low, F.least(low + SLOT_BLOCK, F.col("n")) - 1))).select(
        "contenedor", "largo", (F.col("primero") + F.col("i")).alias("orden"), (F.col("desde_no") + F.floor(F.col("i") / F.col("por"))).alias("contenedor_no")
    )
    at = ranked(parts, groups, key)
    filled = at.where("largo > 0").join(slots.hint("merge"), ["contenedor", "largo", "orden"])  # the plan's estimate says nothing of its slots
    number = F.create_map(*[F.lit(x) for n, c in used.items() for x in (n, max(c, 1))])
    empty = at.where("largo <= 0").withColumn("contenedor_no", F.pmod(F.col("orden"), F.element_at(number, F.col("contenedor"))).cast("bigint"))
    columns = ["contenedor", "contenedor_no", key, "pieza", "desde", "largo"]
    return filled.select(*columns).unionByName(empty.select(*columns))


def fill_report(packed: DataFrame, containers: DataFrame) -> DataFrame:
    """Per kind: containers used, least possible number, tokens, share of room filled and the fullest container."""
    each = packed.groupBy("contenedor", "contenedor_no").agg(F.sum("largo").alias("t"), F.count("*").alias("piezas"))
    by = each.groupBy("contenedor").agg(F.count("*").alias("contenedores"), F.sum("t").alias("tokens"), F.sum("piezas").alias("piezas"), F.max("t").alias("mas_lleno"))
    return by.join(small(containers.select("contenedor", "capacidad")), "contenedor").select(
        "contenedor", "capacidad", "contenedores", F.ceil(F.col("tokens") / F.col("capacidad")).alias("minimo"), "tokens", "piezas", "mas_lleno",
        F.round(F.col("tokens") / (F.col("contenedores") * F.col("capacidad")), 6).alias("llenado"),
    )


def proof(counts: DataFrame, containers: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(contenedor, rebalsados, sin_lugar, repetidos, divididos_de_mas)`` of a packing, all of them 0 if it is right.

    Containers with more tokens than their capacity; texts whose pieces don't add up to their tokens; pieces that overlap the piece before
    them; texts of more than one piece that would have fit into one container. Keys are taken as different.
    """
    counts = cut(counts)
    packed = cut(pack(counts, containers, key))
    kinds = containers.where("contenedor is not null and capacidad >= 1").groupBy("contenedor").agg(F.min("capacidad").alias("c"))
    full = packed.groupBy("contenedor", "contenedor_no").agg(F.sum("largo").alias("t")).join(small(kinds), "contenedor").groupBy("contenedor").agg(F.sum((F.col("t") > F.col("c")).cast("bigint")).alias("rebalsados"))
    # The pieces of a text lie end to end from 0, so their starts add up to what their number and the full capacity say.
    texts = packed.groupBy("contenedor", key).agg(F.sum("largo").alias("l"), F.count("*").alias("n"), F.max(F.col("desde") + F.col("largo")).alias("fin")).join(small(kinds), "contenedor")
    each = texts.join(counts.select(F.col(key).alias("_k"), "tokens"), F.col(key).eqNullSafe(F.col("_k")))
    flaw = lambda c: F.sum(c.cast("bigint"))
    by = each.groupBy("contenedor").agg(
        flaw(F.col("l") != F.col("tokens")).alias("sin_lugar"), flaw(F.col("fin") != F.col("tokens")).alias("repetidos"), flaw((F.col("n") > 1) & (F.col("tokens") <= F.col("c"))).alias("divididos_de_mas")
    )
    return full.join(by, "contenedor")
