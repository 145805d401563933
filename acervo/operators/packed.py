"""Values packed in one field: split into one row per value, with its position.

Method: quoted spans are replaced by collision-free indexed placeholders, the remaining delimiters are split,
the spans are restored through an array lookup, and the pieces are exploded with their positions. All steps are
built-in column expressions; nothing is shuffled, so the operator streams over a table of any size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo.session import squeeze

#: Private-use characters of the placeholders. Their occurrences in the input are escaped first, so that a
#: placeholder never collides with text.
OPEN, CLOSE, ESC = "", "", ""
HOLE = f"{OPEN}[0-9]+{CLOSE}"

#: A quoted span: double quotes (with ``""`` or ``\"`` inside), guillemets, or curly double quotes.
QUOTED = r'"[^"\\]*+(?:(?:\\.|"")[^"\\]*+)*+"|«[^«»]*+(?:«[^«»]*+»[^«»]*+)*+»|“[^“”]*+”'

#: Enumerators by style, tried in this order; group 1 is the number.
ENUMERATORS = (r"\[([0-9]{1,3})\] ?", r"\(([0-9]{1,3})\) ?", r"([0-9]{1,3})\) ?", r"([0-9]{1,3})\.-? ", r"([0-9]{1,3}) ")

BULLET = r"[-–—•*·▪◦] "


@dataclass(frozen=True)
class Style:
    """How a field packs values.

    ``strong`` separates whenever it occurs outside quotes, ``weak`` only when no ``strong`` separator occurs,
    ``lines`` says whether a line feed separates (a field whose values are wrapped over lines has it off).
    """

    strong: str
    weak: str | None = None
    lines: bool = True


STYLES = {
    "lista_distribucion": Style(strong=r";|\|\|?|//|¶|\t| · "),
    "descriptores": Style(strong=r";|\|\|?|/|¶|\t|·| [-–—] ", weak=","),
    "notas_al_pie": Style(strong=r"\|\|?|¶", lines=False),
}


def let(c: Column, body) -> Column:
    """``body(c)`` with ``c`` evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(c), body), F.lit(0))


def escape(c: Column) -> Column:
    """Makes room for placeholders: private-use characters of the input get an escape pair."""
    for k, ch in enumerate((ESC, OPEN, CLOSE)):
        c = F.replace(c, F.lit(ch), F.lit(f"{ESC}{k}"))
    return c


def unescape(c: Column) -> Column:
    """Inverse of :func:`escape`."""
    for k, ch in reversed(list(enumerate((ESC, OPEN, CLOSE)))):
        c = F.replace(c, F.lit(f"{ESC}{k}"), F.lit(ch))
    return c


def quoted_spans(c: Column) -> Column:
    """Array of the quoted spans of an escaped value, in order."""
    return F.regexp_extract_all(c, F.lit(f"({QUOTED})"), F.lit(1))


def mask(c: Column) -> Column:
    """Replaces the k-th quoted span of an escaped value by the placeholder of index k."""
    gaps = F.split(c, QUOTED, -1)
    last = F.size(gaps) - 1
    return F.array_join(
        F.transform(gaps, lambda g, i: F.when(i < last, F.concat(g, F.lit(OPEN), i.cast("string"), F.lit(CLOSE))).otherwise(g)), ""
    )


def restore(piece: Column, spans: Column) -> Column:
    """Puts the spans back into a piece by looking their indices up in the array of spans."""
    text = F.split(piece, HOLE, -1)
    index = F.regexp_extract_all(piece, F.lit(f"{OPEN}([0-9]+){CLOSE}"), F.lit(1))
    return F.array_join(F.zip_with(text, index, lambda t, i: F.concat(t, F.coalesce(F.get(spans, i.cast("int")), F.lit("")))), "")


def unquote(c: Column) -> Column:
    """Removes the quotes that enclose a whole value; a quote mark escaped inside becomes one mark."""
    inner = lambda x: F.regexp_replace(F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"')), r"\\(.)", "$1")
    return let(c, lambda x: F.when(x.rlike(f"(?s)^(?:{QUOTED})$"), inner(x)).otherwise(x))


def bare(c: Column) -> Column:
    """A value without its enclosing quotes and closing full stop; blanks squeezed. The stop may stand inside the quotes."""
    stop = r"(?<!\.)\.$"
    c = squeeze(c)
    c = squeeze(F.regexp_replace(c, stop, ""))
    return squeeze(F.regexp_replace(squeeze(unquote(c)), stop, ""))


def _lead(style: str) -> str:
    return r"^\s*(?:" + style + ")"


def _in_sequence(m: Column, style: str, between: str) -> Column:
    """Splits at enumerators of one style and joins pieces whose number is not the next one to the piece before.

    An enumerator stands after a separator (``between``), or after whitespace if an upper-case letter follows. A number
    inside a value (a page number, a reference) is out of sequence and therefore splits nothing.
    """
    pieces = F.split(m, rf"(?:{between})\s*(?={style}\S)|\s+(?={style}[\p{{Lu}}{OPEN}])", -1)
    number = lambda p: F.regexp_extract(p, _lead(style), 1).try_cast("int")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"), F.lit(0).alias("n"))

    def fold(numbered: Column) -> Column:
        first = F.coalesce(F.get(numbered, F.lit(0))["k"], F.lit(1))

        def step(acc: Column, p: Column) -> Column:
            opens = F.coalesce(p["k"] == first + acc["n"], F.lit(False))
            flushed = F.when(acc["n"] > 0, F.concat(acc["done"], F.array(acc["cur"]))).otherwise(acc["done"])
            return F.struct(
                F.when(opens, flushed).otherwise(acc["done"]).alias("done"),
                F.when(opens, F.regexp_replace(p["p"], _lead(style), "")).otherwise(F.concat(acc["cur"], F.lit(" "), p["p"])).alias("cur"),
                (acc["n"] + opens.cast("int")).alias("n"),
            )

        return F.aggregate(numbered, start, step, lambda acc: F.concat(acc["done"], F.array(acc["cur"])))

    return let(F.transform(pieces, lambda p: F.struct(p.alias("p"), number(p).alias("k"))), fold)


def tidy(c: Column) -> Column:
    """Line ends as line feeds, blank ends trimmed."""
    return F.regexp_replace(F.regexp_replace(c, r"\r\n?", "\n"), r"^\s+|\s+$", "")


def pieces(m: Column, style: Style) -> Column:
    """Array of the masked pieces of a masked value; pieces may be blank."""
    seps = style.strong + (r"|\n" if style.lines else "")
    only_quoted = m.rlike(rf"^\[?\s*{HOLE}(?:\s*[,;]\s*{HOLE})*+\s*[,;]?\s*\]?$")
    commas = F.split(F.regexp_replace(m, r"^\[|\]$", ""), r"\s*[,;]\s*", -1)
    bullets = F.split(F.regexp_replace(m, rf"^(?:{BULLET})", ""), rf"\n+\s*(?:{BULLET})", -1)
    plain = F.split(m, rf"\s*(?:{seps})\s*", -1)
    if style.weak:
        plain = F.when(m.rlike(seps), plain).otherwise(F.split(m, rf"\s*(?:{style.weak})\s*", -1))
    out = F.when(only_quoted, commas).when(m.rlike(rf"^(?:{BULLET})"), bullets)
    for e in ENUMERATORS:
        out = out.when(m.rlike(rf"^(?:{e})\S"), _in_sequence(m, e, rf"\s*(?:{style.strong})"))
    loose = rf"^(?:\s|{seps}|,)+|(?:\s|{seps}|,)+$"
    return F.transform(out.otherwise(plain), lambda p: F.regexp_replace(p, loose, ""))


def entries(m: Column) -> Column:
    """Array of the masked entries of a manifest: ``k: v; k: v || ...``, one entry per line, or JSON objects."""
    json = F.split(F.regexp_replace(m, r"^\[\s*\{|\}\s*\]$", ""), r"\}\s*,\s*\{", -1)
    return F.when(m.rlike(r"^\[\s*\{"), json).otherwise(F.split(m, r"\s*(?:\|\||[\r\n]+)\s*", -1))


def entry_id(entry: Column, spans: Column) -> Column:
    """The value of the key ``id`` of one masked manifest entry, null if it has none."""
    flat = F.regexp_extract(entry, r"(?i)(?:^|;)\s*id\s*[:=]\s*([^;]+)", 1)
    keys = F.transform(spans, lambda s: F.lower(s))
    held = F.regexp_extract_all(entry, F.lit(rf"{OPEN}([0-9]+){CLOSE}\s*:\s*(?:{HOLE}|[^,{OPEN}]+)"), F.lit(1))
    values = F.regexp_extract_all(entry, F.lit(rf"{OPEN}[0-9]+{CLOSE}\s*:\s*({HOLE}|[^,{OPEN}]+)"), F.lit(1))
    at = F.array_position(F.transform(held, lambda i: F.get(keys, i.cast("int"))), F.lit('"id"')).cast("int")
    pair = F.get(values, at - 1)
    return F.when(flat != "", restore(flat, spans)).when(at > 0, restore(pair, spans))


def unpack(df: DataFrame, key: str, fields: dict[str, Style | None]) -> DataFrame:
    """One row ``(key, campo, pos, valor)`` for each value packed in one of ``fields``.

    A field with style ``None`` is a manifest whose values are the ``id`` of its entries. ``pos`` counts from 1 in
    written order; empty pieces are skipped. Null, empty and blank fields give no row; extra columns are ignored;
    repeated rows give repeated values. The table is read once and nothing is shuffled.
    """

    texts = F.explode(F.array(*[F.struct(F.lit(n).alias("campo"), F.col(n).alias("text")) for n in fields])).alias("f")
    rows = df.select(F.col(key), texts).select(key, "f.*").where(r"text rlike '\\S'").withColumn("text", tidy(escape(F.col("text"))))
    rows = rows.withColumn("spans", quoted_spans(F.col("text"))).withColumn("masked", tidy(mask(F.col("text"))))
    spans = F.col("spans")
    got = F.lit(None).cast("array<string>")
    for name, style in fields.items():
        if style is None:
            value = F.transform(entries(F.col("masked")), lambda p: entry_id(p, spans))
        else:
            value = F.transform(pieces(F.col("masked"), style), lambda p: restore(p, spans))
        got = F.when(F.col("campo") == name, value).otherwise(got)
    rows = rows.withColumn("v", F.filter(F.transform(got, lambda v: unescape(bare(v))), lambda v: v.isNotNull() & (v != "")))
    # The outer form keeps the optimizer from evaluating "v" a second and third time in an inferred filter.
    each = rows.select(key, "campo", F.posexplode_outer("v").alias("i", "valor")).where("valor is not null")
    return each.select(key, "campo", (F.col("i") + 1).cast("int").alias("pos"), "valor")


#: The packed fields of ``circulares``.
FIELDS: dict[str, Style | None] = {**STYLES, "tablas_manifiesto": None}


def packed_values(circulares: DataFrame) -> DataFrame:
    """The values packed in the four fields of ``circulares``; see :func:`unpack`."""
    return unpack(circulares, "circular_id", FIELDS)
