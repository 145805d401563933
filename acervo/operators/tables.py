"""Tables of circulars: scan of Markdown tables, headers, sub-row and page merges, names, and blocks placed by geometry.

A table is an array of rows; merges that carry state are folds over that array, so a table never leaves its row. The relational
forms (:func:`merge_subrows_rows`, :func:`place_blocks`) work on cell relations with a running count as the island's number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acervo.functions import text as T
from acervo.functions.regex import let, rx, strip
from acervo.operators import predicates as P
from acervo.overrides import NAMED_TABLES

ROWS = "array<array<string>>"
TABLE = "struct<encabezados:array<string>,filas:array<array<string>>,paginas:array<int>>"
DATED = r"\d{2}[-.]\d{2}[-.]\d{2}"


def pad(row: Column, n: Column | int) -> Column:
    """A row filled up with empty cells, or cut, to ``n`` cells."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.slice(F.concat(row, F.array_repeat(F.lit(""), n)), F.lit(1), n)


def has_text(row: Column) -> Column:
    """True if a cell of a row is not empty."""
    return F.exists(row, lambda c: F.coalesce(c, F.lit("")) != "")


def is_new_row(row: Column, columns: Column | int) -> Column:
    """True if a row begins a logical row: its first cell is filled, or, with four columns or more, the second is a number or the third holds a date."""
    n = F.lit(columns) if isinstance(columns, int) else columns
    wide = (n >= 4) & (F.get(row, F.lit(1)).rlike(r"^\d+$") | F.get(row, F.lit(2)).rlike(DATED))
    return (F.get(row, F.lit(0)) != "") | F.coalesce(wide, F.lit(False))


def _glue(old: Column, new: Column) -> Column:
    """A cell with its continuation: a line end before what has lines or a numeral, else a blank."""
    sep = F.when(new.contains("\n") | new.rlike(r"^\d+\."), F.lit("\n")).otherwise(F.lit(" "))
    return F.when(new == "", old).when(old == "", new).otherwise(T.cell(F.concat(old, sep, new)))


def merge_subrows(rows: Column, columns: Column | int) -> Column:
    """Rows of one table with their sub-rows folded into the logical rows; empty rows are dropped."""
    cells = F.transform(rows, lambda r: pad(F.transform(r, T.cell), columns))

    def step(acc: Column, r: Column) -> Column:
        new = (F.size(acc) == 0) | is_new_row(r, columns)
        grown = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.zip_with(F.element_at(acc, -1), r, _glue)))
        return F.when(new, F.concat(acc, F.array(r))).otherwise(grown)

    return F.aggregate(F.filter(cells, has_text), F.array().cast(ROWS), step)


def merge_subrows_rows(cells: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """Relational form over one row per table row: islands by a running count, then ordered joins per column."""
    w = Window.partitionBy(*keys).orderBy(order)
    filled = cells.select(*keys, order, *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns])
    island = F.sum((F.col(columns[0]) != "").cast("int")).over(w)
    got = filled.withColumn("grupo", island)

    def glued(c: str) -> Column:
        pieces = F.transform(F.array_sort(F.collect_list(F.when(F.col(c) != "", F.struct(F.col(order), F.col(c).alias("t"))))), lambda x: x["t"])
        return F.aggregate(pieces, F.lit(""), lambda acc, t: F.when(acc == "", t).otherwise(F.concat(acc, F.when(t.contains("\n") | t.rlike(r"^\d+\."), "\n").otherwise(" "), t)))

    return got.groupBy(*keys, "grupo").agg(*[glued(c).alias(c) for c in columns])


def joined_headers(a: Column, b: Column) -> Column:
    """Two header rows as one; runs of empty names count once and those at the end not at all."""
    plain = lambda c: F.replace(T.cell(c), F.lit("\n"), F.lit(" "))
    n = F.greatest(F.size(a), F.size(b))
    both = F.zip_with(pad(F.transform(a, plain), n), pad(F.transform(b, plain), n), lambda x, y: F.when((x != "") & (y != "") & (x != y), F.concat(x, F.lit(" "), y)).when(x != "", x).otherwise(y))
    step = lambda acc, h: F.when((h == "") & (F.size(acc) > 0) & (F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit("")) == ""), acc).otherwise(F.concat(acc, F.array(h)))
    once = F.aggregate(both, F.array().cast("array<string>"), step)
    trimmed = F.when(F.coalesce(F.try_element_at(once, F.lit(-1)), F.lit("")) == "", F.slice(once, F.lit(1), F.greatest(F.size(once) - 1, F.lit(0)))).otherwise(once)
    return F.when(F.size(trimmed) > 0, trimmed).otherwise(F.filter(F.transform(a, T.cell), lambda h: h != ""))


def collapse_five(rows: Column) -> Column:
    """Rows of five cells of the spanning layout as three: 1, 2 with 3, 4 with 5."""
    pair = lambda a, b: F.trim(F.concat(T.clean_cell(a), F.lit(" "), T.clean_cell(b)))
    return F.transform(rows, lambda r: F.array(T.clean_cell(F.get(r, F.lit(0))), pair(F.get(r, F.lit(1)), F.get(r, F.lit(2))), pair(F.get(r, F.lit(3)), F.get(r, F.lit(4)))))


def needs_collapse(rows: Column) -> Column:
    """True for the spanning layout: five cells, and the header of amended subjects or an empty second cell after ``circular``."""
    r0 = F.transform(F.get(rows, F.lit(0)), lambda c: F.lower(T.clean_cell(c)))
    return (F.size(r0) == 5) & (F.array_join(r0, " ").contains("materia(s) que se modifica") | ((F.get(r0, F.lit(0)) == "circular") & (F.get(r0, F.lit(1)) == "")))


def split_header(rows: Column) -> Column:
    """``struct(encabezados, datos, tiene)`` of raw rows: no, one or two header rows are taken off."""

    def of(clean: Column) -> Column:
        r0, r1 = F.get(clean, F.lit(0)), F.coalesce(F.get(clean, F.lit(1)), F.array().cast("array<string>"))
        has = P.is_header_row(r0)
        two = has & (F.size(clean) >= 3) & P.is_header_row(r1) & ~F.exists(r1, lambda c: c.rlike(r"^\d+$"))
        one = F.filter(F.transform(r0, lambda c: F.replace(T.cell(c), F.lit("\n"), F.lit(" "))), lambda c: c != "")
        names = F.when(two, joined_headers(r0, r1)).when(has, one).otherwise(F.array().cast("array<string>"))
        names = F.transform(names, lambda h: F.when(h.rlike("^Motivo y/o:?$"), F.lit("Motivo y/o Consideraciones")).otherwise(h))
        skip = F.when(two, 2).when(has, 1).otherwise(0)
        data = F.slice(clean, skip + 1, F.greatest(F.size(clean), F.lit(1)))
        return F.struct(names.alias("encabezados"), data.alias("datos"), has.alias("tiene"), F.size(r0).alias("ancho"))

    return let(F.transform(rows, lambda r: F.transform(r, T.clean_cell)), of)


def merge_pages(parts: Column) -> Column:
    """Tables of a document from its page tables, in order.

    ``parts`` is an array of ``struct(pagina, filas)``. A page table goes on with the table before it if it has no header or
    the same one and fits its width; its first row, if it begins no logical row, is folded into the last one.
    """
    zero = F.array().cast(f"array<{TABLE}>")

    def step(acc: Column, part: Column) -> Column:
        def put(h: Column) -> Column:
            prev = F.try_element_at(acc, F.lit(-1))
            width = F.size(prev["encabezados"])
            same = (F.size(h["encabezados"]) == 0) | (h["encabezados"] == prev["encabezados"]) | (h["ancho"] == width)
            goes_on = (F.size(acc) > 0) & same & (~h["tiene"] | (h["encabezados"] == prev["encabezados"]))
            n = F.when(F.size(h["encabezados"]) > 0, F.size(h["encabezados"])).otherwise(h["ancho"])
            names = F.when(F.size(h["encabezados"]) > 0, h["encabezados"]).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(h["ancho"], F.lit(1))), lambda k: F.concat(F.lit("Columna "), k.cast("string"))))
            page = F.array(part["pagina"].cast("int"))
            alone = F.struct(names.alias("encabezados"), merge_subrows(h["datos"], n).alias("filas"), page.alias("paginas"))

            def extended(rows: Column) -> Column:
                first = F.get(rows, F.lit(0))
                folds = (F.size(rows) > 0) & (F.size(prev["filas"]) > 0) & ~F.coalesce((F.get(first, F.lit(0)) != "") | ((width >= 2) & F.get(first, F.lit(1)).rlike(r"^\d+$")), F.lit(True))
                last = F.concat(F.slice(prev["filas"], F.lit(1), F.greatest(F.size(prev["filas"]) - 1, F.lit(0))), F.array(F.zip_with(F.try_element_at(prev["filas"], F.lit(-1)), first, _glue)))
                merged = F.when(folds, F.concat(last, F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0))))).otherwise(F.concat(prev["filas"], rows))
                pages = F.when(F.array_contains(prev["paginas"], part["pagina"].cast("int")), prev["paginas"]).otherwise(F.concat(prev["paginas"], page))
                return F.struct(prev["encabezados"].alias("encabezados"), merged.alias("filas"), pages.alias("paginas"))

            longer = F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(let(merge_subrows(h["datos"], F.greatest(width, F.lit(1))), extended)))
            return F.when(goes_on, longer).otherwise(F.concat(acc, F.array(alone)))

        return let(split_header(part["filas"]), put)

    kept = F.transform(parts, lambda p: F.struct(p["pagina"].alias("pagina"), F.filter(p["filas"], lambda r: F.exists(r, lambda c: T.clean_cell(c) != "")).alias("filas")))
    wide = F.filter(kept, lambda p: (F.size(p["filas"]) > 0) & (F.size(F.get(p["filas"], F.lit(0))) > 1))
    flat = F.transform(wide, lambda p: F.struct(p["pagina"].alias("pagina"), F.when(needs_collapse(p["filas"]), collapse_five(p["filas"])).otherwise(p["filas"]).alias("filas")))
    return F.aggregate(flat, zero, step)


def table_name(headers: Column, rows: Column, pages: Column, circulars: tuple[str, ...] = NAMED_TABLES) -> Column:
    """Name of a table by its contents, the first rule that fits; the mention of one of ``circulars`` names a table."""
    everything = F.array_join(F.concat(headers, F.flatten(rows)), " ")
    named = F.filter(F.array(*[F.when(everything.contains(d), F.lit(d)) for d in circulars]), lambda d: d.isNotNull())
    first, last = F.get(pages, F.lit(0)).cast("string"), F.try_element_at(pages, F.lit(-1)).cast("string")
    span = F.concat(F.lit("(Pág. "), first, F.when(F.size(pages) > 1, F.concat(F.lit("-"), last)).otherwise(""), F.lit(")"))
    any_header = lambda p: F.exists(headers, lambda h: F.lower(h).rlike(p))
    titled = lambda t: F.concat(F.lit(t + " "), span)
    return (
        F.when(F.size(named) > 0, F.concat(F.lit("Modificaciones Normativas ("), F.array_join(named, ", "), F.lit(")")))
        .when(any_header("dejan sin efecto|motivos"), titled("Tabla de Circulares Dejadas sin Efecto"))
        .when(any_header("modificaciones"), titled("Tabla de Circulares Modificadas"))
        .when(any_header("tipo de gestión"), titled("Tabla: TIPO DE GESTIÓN, CASOS QUE COMPRENDE:"))
        .when(any_header("modifica|circular"), titled("Tabla de Modificaciones Normativas"))
        .when(F.size(headers) > 0, F.concat(F.lit("Tabla: "), F.array_join(F.slice(headers, 1, 2), ", "), F.lit(" "), span))
        .otherwise(titled("Tabla técnica"))
    )


def markdown_tables(lines: Column) -> Column:
    """Array of ``struct(encabezados, filas, paginas)`` of the Markdown tables in lines: runs of at least three lines between bars."""
    zero = F.array().cast("array<array<string>>")
    is_row = lambda l: l.startswith("|") & l.endswith("|") & (F.length(l) > 1)

    def step(acc: Column, x: Column) -> Column:
        goes_on = x["p"] & (F.size(acc) > 0)
        grown = F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.concat(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.array().cast("array<string>")), F.array(x["l"]))))
        return F.when(~is_row(x["l"]), acc).when(goes_on, grown).otherwise(F.concat(acc, F.array(F.array(x["l"]))))

    marked = F.transform(lines, lambda l, i: F.struct(l.alias("l"), F.coalesce(is_row(F.get(lines, i - 1)), F.lit(False)).alias("p")))
    runs = F.filter(F.aggregate(marked, zero, step), lambda r: (F.size(r) >= 3) & (F.length(F.regexp_replace(F.get(r, F.lit(0)), r"[^|]", "")) >= 3))
    cells = lambda l: F.transform(F.split(F.regexp_replace(l, r"^\||\|$", ""), r"\|", -1), T.cell)
    one = lambda r: F.struct(cells(F.get(r, F.lit(0))).alias("encabezados"), F.transform(F.slice(r, F.lit(3), F.size(r)), cells).alias("filas"), F.array(F.lit(1)).alias("paginas"))
    return F.filter(F.transform(runs, one), lambda t: F.size(t["filas"]) > 0)


def compact(rows: Column) -> Column:
    """``struct(encabezados, filas, markdown)`` of a raw table; null if it has no header or no row with text."""
    clean = F.filter(F.transform(rows, lambda r: F.transform(r, T.cell)), has_text)

    def of(c: Column) -> Column:
        r0, r1 = F.get(c, F.lit(0)), F.get(c, F.lit(1))
        two = (F.size(c) >= 3) & P.is_header_row(r1) & ~F.exists(r1, lambda x: x.rlike(r"^\d+$"))
        raw = F.when(two, joined_headers(r0, r1)).otherwise(r0)
        data = F.slice(c, F.when(two, 3).otherwise(2), F.size(c))

        def shaped(raw: Column) -> Column:
            kept = F.filter(F.transform(raw, lambda h, i: F.struct(i.alias("i"), F.trim(F.replace(h, F.lit("\n"), F.lit(" "))).alias("h"))), lambda x: x["h"] != "")
            names = F.when(F.size(kept) > 0, F.transform(kept, lambda x: x["h"])).otherwise(F.transform(raw, lambda h, i: F.concat(F.lit("Columna "), (i + 1).cast("string"))))
            n = F.size(names)
            by_place = lambda r: F.transform(kept, lambda x: F.coalesce(F.get(r, x["i"]), F.lit("")))
            by_order = lambda r: pad(F.filter(r, lambda v: v != ""), n)
            filas = F.transform(data, lambda r: F.when((F.size(kept) == n) & (F.size(r) == F.size(raw)), by_place(r)).otherwise(by_order(r)))
            bar = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
            md = F.concat(F.array(bar(names), bar(F.array_repeat(F.lit("---"), n))), F.transform(filas, lambda r: bar(F.transform(r, lambda x: F.replace(x, F.lit("\n"), F.lit(" "))))))
            return F.struct(names.alias("encabezados"), filas.alias("filas"), F.array_join(md, "\n").alias("markdown"))

        return F.when(F.size(data) > 0, let(raw, shaped))

    return let(clean, lambda c: F.when(F.size(c) >= 2, of(c)))


def manifest(tables: Column, num: Column) -> Column:
    """Manifest entries of the tables of one document, numbered from 1."""
    return F.transform(
        tables,
        lambda t, i: F.struct(
            F.concat(F.lit("DDU_"), num, F.lit("_tabla_"), (i + 1).cast("string")).alias("id"), table_name(t["encabezados"], t["filas"], t["paginas"]).alias("nombre"), t["paginas"].alias("paginas"),
            F.size(t["filas"]).alias("filas"), F.size(t["encabezados"]).alias("columnas"),
            F.concat(F.lit("salidas_tablas/DDU_"), num, F.lit("_tabla_"), (i + 1).cast("string"), F.lit(".csv")).alias("archivo_anexo"),
        ),
    )


def place_blocks(blocks: DataFrame, bands: DataFrame, split_x: float, left_x: float) -> DataFrame:
    """Text blocks placed in row bands by geometry (a range join) and in two columns by their middle.

    ``blocks`` has ``doc_id, page, block_no, x0, y0, x1, y1, text, type``; ``bands`` has ``doc_id, page, row_key, y_min, y_max``.
    Both band ends count, so a block on a shared edge lies in both rows. Blocks of a page meet bands of the same page only.
    """
    b, r = blocks.where("type = 0").alias("b"), bands.alias("r")
    inside = b.join(r, (F.col("b.doc_id") == F.col("r.doc_id")) & (F.col("b.page") == F.col("r.page")) & F.col("b.y0").between(F.col("r.y_min"), F.col("r.y_max")))
    middle = (F.col("b.x0") + F.col("b.x1")) / 2
    side = F.when(middle.between(left_x, split_x), "izquierda").when(middle > split_x, "derecha")
    cells = inside.select("r.doc_id", "r.page", "r.row_key", side.alias("lado"), "b.block_no", T.cell(F.col("b.text")).alias("t")).where("lado is not null")
    return cells.groupBy("doc_id", "page", "row_key", "lado").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_no", "t"))), lambda x: x["t"]), " ").alias("texto"), F.count("*").alias("bloques")
    )


__all__ = [n for n in dir() if not n.startswith("_")] + ["rx", "strip"]
