"""Attribute-value rows into one typed row per entity.

Method: the entity-by-attribute grid is completed, the values are left joined to it, an array sorted by attribute
position is collected per entity, and its fixed indices are projected through type-specific try casts.

One shuffle: the rows of an entity are reduced to the deciding row per attribute on the map side and meet once, by entity. Its
values then travel as a map beside it, so that the grid (one row per entity and attribute), the left join (a lookup in the map
of the same entity) and the collection keep the partitioning by entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo.functions.casts import READERS, read_as
from acervo.session import small

#: Most attributes of a wide table. They become columns, so they are part of the schema and not of the data.
MAX_ATTRIBUTES = 2000
#: Up to so many attributes are reduced side by side in one aggregation; more take one aggregation per attribute and one per entity.
IN_ONE = 96
_ENTRIES = "array<struct<pos:int,v:struct<row_no:int,valor:string>>>"


def attribute_key(c: Column) -> Column:
    """A name without differences of case, blanks and separators."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"(?U)[\s\-_./]+", "_"), "^_+|_+$", "")


def attributes(names: DataFrame) -> list[tuple[str, str]]:
    """``(column, type)`` in order of the column names; the list fixes the schema of the wide table."""
    rows = names.where(F.col("campo").isNotNull()).groupBy("campo").agg(F.min("tipo").alias("tipo")).orderBy("campo").limit(MAX_ATTRIBUTES + 1).collect()
    if len(rows) > MAX_ATTRIBUTES:
        raise ValueError(f"more than {MAX_ATTRIBUTES} attributes")
    return [(r["campo"], r["tipo"] if r["tipo"] in READERS else "texto") for r in rows]


def widen(eav: DataFrame, names: DataFrame) -> DataFrame:
    """One row per ``file`` with a struct ``(valor, row_no)`` per attribute; ``valor`` has the attribute's type.

    ``eav`` has ``file, row_no, campo, valor_extraido``; ``names`` maps ``nombre`` to ``campo`` and ``tipo``. The row with the
    highest ``row_no`` of a file and column decides alone, even if its value is empty or unreadable (then both parts are
    null); of several rows with this ``row_no`` the greatest value decides. Names that are not in ``names`` are ignored, a
    file with only such names gives a row of nulls, and rows without a file belong to no entity. A file that holds a large
    part of all rows is reduced to one row per attribute before the shuffle.
    """
    columns = attributes(names)
    position = F.create_map(*[x for i, (n, _) in enumerate(columns) for x in (F.lit(n), F.lit(i))]) if columns else F.create_map().cast("map<string,int>")
    known = (
        names.where(F.col("nombre").isNotNull() & F.col("campo").isNotNull())
        .select(attribute_key("nombre").alias("k"), F.try_element_at(position, F.col("campo")).alias("pos"))
        .groupBy("k").agg(F.min("pos").alias("pos"))
    )
    rows = eav.select("file", "row_no", attribute_key(F.col("campo")).alias("k"), F.col("valor_extraido").alias("valor")).where(F.col("file").isNotNull())
    placed = rows.join(small(known), "k", "left")
    n = len(columns)
    if not n:
        found, entries = placed.select("file").distinct(), F.array().cast(_ENTRIES)
    elif n <= IN_ONE:
        found = placed.groupBy("file").agg(*[F.max(F.when(F.col("pos") == i, F.struct("row_no", "valor"))).alias(f"c{i}") for i in range(n)])
        entries = F.array(*[F.struct(F.lit(i).alias("pos"), F.col(f"c{i}").alias("v")) for i in range(n)])
    else:
        values = placed.groupBy("file", "pos").agg(F.max(F.struct("row_no", "valor")).alias("v"))
        found = values.groupBy("file").agg(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "v"))).alias("e"))
        entries = F.col("e")
    values = found.select("file", F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull())).alias("valores"))
    grid = values.select("file", "valores", F.explode(F.sequence(F.lit(0), F.lit(max(n - 1, 0)))).alias("pos"))
    joined = grid.select("file", "pos", F.try_element_at("valores", F.col("pos")).alias("v"))
    cells = joined.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("pos", "v"))).alias("cells"))

    def cell(i: int, kind: str) -> Column:
        got = F.get("cells", F.lit(i))["v"]
        value = read_as(got["valor"], kind)
        return F.struct(value.alias("valor"), F.when(value.isNotNull(), got["row_no"]).alias("row_no"))

    return cells.select("file", *[cell(i, kind).alias(name) for i, (name, kind) in enumerate(columns)])


def wide_table(eav: DataFrame, names: DataFrame) -> DataFrame:
    """One row per ``file`` with one typed column per attribute; see :func:`widen`."""
    w = widen(eav, names)
    return w.select("file", *[F.col(f"`{c}`.valor").alias(c) for c in w.columns[1:]])


def filled_cells(eav: DataFrame, names: DataFrame) -> DataFrame:
    """One row ``(file, campo, row_no)`` per filled cell of the wide table; see :func:`widen`."""
    w = widen(eav, names)
    if not w.columns[1:]:  # no attribute is known, so no cell can be filled
        return w.select("file", F.lit("").alias("campo"), F.lit(0).alias("row_no")).where(F.lit(False))
    cells = F.array(*[F.struct(F.lit(c).alias("campo"), F.col(f"`{c}`.row_no").alias("row_no")) for c in w.columns[1:]])
    return w.select("file", F.explode(F.filter(cells, lambda x: x["row_no"].isNotNull())).alias("c")).select("file", "c.campo", "c.row_no")
