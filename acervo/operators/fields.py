"""Header fields of a circular: each extractor is a set of expressions over the text and its lines; no row leaves its partition."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from acervo.functions import dates, text as T
from acervo.functions.regex import any_of, ci, first_match, let, rx, squeeze, strip, sub
from acervo.operators import predicates as P
from acervo.operators.lines import capture, first_index, head, indexed, last_index

# The issuer and the place that hold if none is found.
DEFAULT_ISSUER, DEFAULT_PLACE = "JEFE DIVISION DE DESARROLLO URBANO", "Santiago"

# How circulars write their number, the mark of the act (with its misreadings), sender, recipient and the lines that end a block (patterns).
NUMBER = r"\bDDU\s*N?[°oº]?\s*(\d+)\b"
ORD_LINE = r"\b(CIRCULAR\s+)?(ORD|ORO|OR0|OR)\b"
ORD_NUMBER = r"(?:CIRCULAR\s+)?(?:ORD|ORO|OR0|OR)\.?\s*(?:N[°oº?\s_-]*\s*)?([0-9\s_lI|·\-,°º.;~'/]+)"
OFFICE = r"JEFE|MINISTRO|SUBSECRETARI[OA]|DIRECTOR|DIVISI[ÓO]N"
FROM = rf"^DE(?:\s*:\s*|\s+(?=(?:{OFFICE})\b))(.+)$"
TO = r"^(?:A(?:\s|:)|PARA\s*:)\s*:?\s*(.+)$"
HEADER_STOPS = (r"^DE\s*:", rf"^DE\s+(JEFE|MINISTRO|DIRECTOR|DIVISI[ÓO]N)\b", r"^A\s*:", r"^A\s+SEGÚN\b")


def number(text: Column, lines: Column) -> Column:
    """``DDU n`` from the first 30 lines, else from the text; empty if there is none."""
    n = F.coalesce(first_match(head(lines, 30), NUMBER), F.regexp_extract(text, ci(NUMBER), 1))
    return F.when(F.coalesce(n, F.lit("")) != "", F.concat(F.lit("DDU "), n)).otherwise("")


def _ones(l: Column) -> Column:
    """Misread ones among digits."""
    l = F.regexp_replace(l, "[\"']", "")
    l = sub(l, r"(?<=[0-9_\s°º?])l(?=[0-9_\s°º?,/\-]|$)", "1")
    l = sub(l, r"^l(?=[0-9_\s°º?,/\-])", "1")
    return F.regexp_replace(l, r"(?<=\s)[I|](?=\s)", "1")


def ord_number(text: Column, lines: Column) -> Column:
    """``CIRCULAR ORD. N° d`` with all digits of the first line of the act in 25 lines, else of the first 1500 characters; zeros stay."""
    digits = lambda s: F.regexp_replace(s, "[^0-9]", "")

    def of_line(l: Column) -> Column:
        got = digits(F.regexp_extract(l, ci(ORD_NUMBER), 1))
        return F.when(got != "", got).otherwise(digits(l))

    candidates = F.filter(F.transform(F.filter(head(lines, 25), lambda l: rx(l, ORD_LINE)), lambda l: of_line(_ones(l))), lambda d: d != "")
    late = digits(_ones(F.regexp_extract(F.substring(text, 1, 1500), ci(ORD_NUMBER), 1)))
    d = F.coalesce(F.get(candidates, F.lit(0)), late, F.lit(""))
    return F.when(d != "", F.concat(F.lit("CIRCULAR ORD. N° "), d)).otherwise("")


def background(text: Column, lines: Column) -> Column:
    """Block ``ANT.`` of the first 60 lines; of several the last counts."""
    stops = (r"^(MAT|MATERIA)\.?(\s*:\s*|\s+)", *HEADER_STOPS, r"^(CIRCULAR|SANTIAGO|VALPARAÍSO|CONCEPCIÓN|I\.)\b")
    return squeeze(capture(head(lines, 60), ci(r"^(?:ANT|ANTECEDENTES)[\s.:]+(.+)$"), lambda l: any_of(l, stops) | l.rlike(P.KEYWORD_LIST), keep="last"))


def subject(text: Column, lines: Column) -> Column:
    """Block ``MAT.`` of the first 50 lines, repaired; of several the first counts."""
    stops = (r"^(ANT|ANTECEDENTES)\.?(\s*:\s*|\s+)", *HEADER_STOPS, r"^(SANTIAGO|VALPARAÍSO|CONCEPCIÓN|I\.)\b")
    stop = lambda l: any_of(l, stops) | l.rlike(P.KEYWORD_LIST) | P.is_descriptor_start(l)
    return T.fix_words(squeeze(capture(head(lines, 50), ci(r"^(?:MAT|MATERIA)\s*[.:]+\s*(.+)$"), stop, keep="first")))


def descriptors(text: Column, lines: Column) -> Column:
    """Descriptor lines after the last header-like line of the first 15, up to line 35; a sender or city ends them once begun."""
    begin = last_index(head(lines, 15), lambda l: rx(l, r"^(MAT\s*:|ANT\s*:|CIRCULAR\s+ORD|DDU\s+\d+|ORD\b)")) + 1
    label = ci(r"^(?:DESCRIPTORES|VOCABLOS|PALABRAS\s+CLAVE)\.?(?:\s*:\s*|\s+)(.+)$")
    end = r"^(DE\s+(JEFE|MINISTRO|SUBSECRETARI|DIRECTOR|SECRETARI|DIVISI[ÓO]N)|DE\s*:|A\s*:|SANTIAGO|VALPARA[ÍI]SO)"
    zero = F.struct(F.lit(False).alias("over"), F.array().cast("array<string>").alias("got"))

    def step(s: Column, l: Column) -> Column:
        takes = ~s["over"] & (l.rlike(label) | P.is_descriptor_line(l))
        piece = F.when(l.rlike(label), strip(F.regexp_extract(l, label, 1))).otherwise(l)
        return F.struct(
            (s["over"] | (~takes & (F.size(s["got"]) > 0) & rx(l, end))).alias("over"),
            F.when(takes, F.concat(s["got"], F.array(piece))).otherwise(s["got"]).alias("got"),
        )

    chosen = F.filter(F.filter(indexed(head(lines, 35)), lambda x: x["i"] >= begin), lambda x: x["l"] != "")
    return squeeze(F.array_join(F.aggregate(F.transform(chosen, lambda x: x["l"]), zero, step, lambda s: s["got"]), " "))


def date_and_place(text: Column, lines: Column, compat: bool = False) -> dict[str, Column]:
    """ISO date and city: first from lines that name a city, else from the first 50 lines that speak of no other circular."""
    year = r"([0-9lI|oO3b]{4}|\d{2,4})"
    pattern = dates.DATE.replace(r"(\d{2,4})", year)
    near = F.filter(indexed(F.split(text, "\r\n|[\n\r]", -1)), lambda x: x["l"].rlike(r"\d") & rx(x["l"], dates.MONTH))
    rows = F.transform(near, lambda x: F.struct(x["i"].alias("i"), dates.fix_dates(x["l"]).alias("l")))
    dated = F.filter(rows, lambda x: rx(x["l"], pattern))

    def of(line: Column) -> Column:
        g = lambda k: F.regexp_extract(line, ci(pattern), k)
        date = F.when(line.isNull(), F.lit("")).otherwise(dates.iso_from(g(2), g(3), dates.fix_year(g(4), compat)))
        return F.struct(date.alias("fecha"), F.when(line.isNotNull() & (g(1) != ""), F.initcap(g(1))).otherwise(F.lit(DEFAULT_PLACE)).alias("lugar"))

    def chosen(dated: Column) -> Column:
        city = F.filter(dated, lambda x: rx(x["l"], "santiago|valpara[ií]so|concepci[oó]n"))
        other = F.filter(dated, lambda x: (x["i"] < 50) & ~rx(x["l"], "complementa|modifica|deroga"))
        return let(F.coalesce(F.get(city, F.lit(0))["l"], F.get(other, F.lit(0))["l"]), of)

    got = let(dated, chosen)
    date, place = got["fecha"], got["lugar"]
    return {"fecha": date, "lugar": place, "fecha_lugar": F.concat_ws(", ", place, F.when(date != "", date))}


def recipient(text: Column, lines: Column) -> Column:
    """The line ``A:`` or ``PARA:`` of the first 40, else of the first 1500 characters."""
    got = first_match(head(lines, 40), TO, where=lambda l: ~rx(F.regexp_extract(l, ci(TO), 1), r"^\s*LA\s+FECHA"))
    late = strip(F.regexp_extract(F.substring(text, 1, 1500), ci(r"\b(?:A|PARA)\s*:\s*([^\n]+)"), 1))
    late = F.when(rx(late, r"^LA\s+FECHA"), F.lit("")).otherwise(late)
    return squeeze(F.coalesce(F.when(F.coalesce(got, F.lit("")) != "", got), late, F.lit("")))


def issuer(text: Column, lines: Column) -> Column:
    """The line ``DE:`` or ``DE JEFE…`` of the first 40, else of the first 1500 characters, without its full stop."""
    got = first_match(head(lines, 40), FROM)
    late = F.regexp_extract(F.substring(text, 1, 1500), ci(r"\bDE\s*:\s*([^\n]+)"), 1)
    return squeeze(F.regexp_replace(strip(F.coalesce(F.when(F.coalesce(got, F.lit("")) != "", got), late, F.lit(""))), r"\.$", ""))


# Lines that close a footnote and how one opens (patterns).
NOTE_FLUSH = (r"P[áa]gina\s+\d+\s+de\s+\d+", r"Saluda\s+atent|DISTRIBUCI[ÓO?I\s]+N|GOBIERNO\s+DE\s+CHILE|Alameda\s+924")
NOTE_OPEN = r"^\d{1,2}\s+[A-ZÁÉÍÓÚÑ\"“”'‘’«(].+$"


def footnotes(text: Column, lines: Column) -> Column:
    """Footnotes of the text joined by `` | ``: a number from 1 to 60 and a capital open one, further lines go on, page feet close it."""
    zero = F.struct(F.array().cast("array<string>").alias("got"), F.lit("").alias("cur"))

    def flush(s: Column) -> Column:
        return F.when(s["cur"] != "", F.concat(s["got"], F.array(s["cur"]))).otherwise(s["got"])

    def step(s: Column, l: Column) -> Column:
        n = F.regexp_extract(l, r"^(\d{1,2})\s", 1).try_cast("int")
        closes = any_of(l, NOTE_FLUSH)
        opens = l.rlike(NOTE_OPEN) & n.between(1, 60) & ~P.NO_NOTE.column(l) & ~l.rlike(P.NUMERAL)
        return (
            F.when(closes | opens, F.struct(flush(s).alias("got"), F.when(closes, F.lit("")).otherwise(F.regexp_replace(l, r"^(\d{1,2})\s+", "$1 ")).alias("cur")))
            .otherwise(F.struct(s["got"].alias("got"), F.when(s["cur"] != "", F.concat(s["cur"], F.lit(" "), l)).otherwise(s["cur"]).alias("cur")))
        )

    notes = F.aggregate(F.filter(lines, lambda l: l != ""), zero, step, flush)
    return T.fix_notes(F.array_join(F.filter(F.transform(notes, T.fix_notes), lambda x: x != ""), " | "))


# How margin notes speak of later circulars (patterns).
AMENDED_BLOCK = r"Circular\s+Modificada\s+por\s*Circular\s+Ord\.?\s*N[°º?]?\s*\d+[^\n]*(?:\n[^\n]*){0,4}\bDDU\s*\d+[^\n]*(?:\s*\([^)]+\))?"
AMENDED_LINES = (r"Circular\s+Modificada\s+por", r"Dejada\s+sin\s+efecto\s+por\s+Circular", r"Aclarada\s+por\s+Circular", r"Complementada\s+por\s+Circular")


def amendments(text: Column, lines: Column) -> Column:
    """Margin notes of later amendments joined by ``; ``: one block over several lines, else each different note in a line."""

    def found(t: Column) -> Column:
        block = squeeze(F.regexp_extract(t, ci(f"({AMENDED_BLOCK})"), 1))
        single = F.flatten(F.array(*[F.regexp_extract_all(t, F.lit(ci(rf"({p}\b[^\n]+)")), F.lit(1)) for p in AMENDED_LINES]))
        notes = F.array_distinct(F.filter(F.transform(single, squeeze), lambda n: n != ""))
        return F.when(block != "", block).otherwise(F.array_join(notes, "; "))

    named = any_of(text, (r"Modificada\s+por", r"sin\s+efecto\s+por\s+Circular", r"Aclarada\s+por\s+Circular", r"Complementada\s+por\s+Circular"))
    return F.when(named, F.coalesce(let(T.fix_words(text), found), F.lit(""))).otherwise("")


def subject_index(lines: Column) -> Column:
    """Index of the line that opens the subject, -1 if none does."""
    return first_index(head(lines, 50), lambda l: rx(l, r"^(MAT|MATERIA)\s*[.:]+"))
