"""Dates of circulars: repair of scanned dates, and conversion between ISO and Spanish wording. Partial dates stay text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from acervo.functions.casts import MONTHS, month_number
from acervo.functions.regex import let, sub

NAMES = {n: name for name, n in MONTHS.items() if len(name) > 4 and name != "setiembre"} | {3: "marzo", 5: "mayo"}
MONTH = "(?:enero|febrero|marzo|abril|mayo|junio|julio|agosto|septiembre|setiembre|octubre|noviembre|diciembre|ene|feb|mar|abr|may|jun|jul|ago|sep|oct|nov|dic)"
#: A date in words with or without one of the cities of issue before it.
DATE = rf"(Santiago|Valpara[íi]so|Concepci[óo]n)?\s*,?\s*(\d{{1,2}})\s+(?:de\s+)?({MONTH})\.?\s*(?:de\s+)?(\d{{2,4}})"


def fix_year(y: Column, compat: bool = False) -> Column:
    """Misread digits of a year of this century: ``2o2b`` is 2026.

    The last digit is repaired only if it is no digit, or another digit of the year was misread. ``compat=True`` also turns
    a final 3 or 5 of every year 20xx into 6, as older output did.
    """
    second, third, last = F.substring(y, 2, 1), F.substring(y, 3, 1), F.substring(y, 4, 1)
    misread = second.isin("3", "o", "O", "Q", "b") | third.isin("l", "I")
    if compat:
        misread = second.isin("3", "o", "O", "0") | third.isin("2", "l", "I")
    fixed = F.concat(
        F.lit("2"), F.when(second.isin("3", "o", "O", "Q", "b"), "0").otherwise(second), F.when(third.isin("2", "l", "I", "|"), "2").otherwise(third),
        F.when((last.isin("5", "3", "b") & misread) | (last == "b"), "6").otherwise(last),
    )
    return F.when((F.length(y) == 4) & y.startswith("2"), fixed).otherwise(y)


def fix_dates(text: Column) -> Column:
    """Scanned dates: split day digits joined, ``O`` in a day read as 0, damaged centuries repaired."""
    t = F.translate(text, "�–—", "0--")
    t = sub(t, rf"\b([123])\s+[Oo0]\s+(?={MONTH})", "$10 ")
    t = sub(t, rf"\b([123])\s+([0-9])\s+(?={MONTH})", "$1$2 ")
    t = F.regexp_replace(t, r"\b([0-3])\s+([0-9])\b", "$1$2")
    t = F.regexp_replace(t, r"\b2[0oO]\s*[lI|]\s*(\d{2})\b", "20$1")
    return F.regexp_replace(t, r"\b2[^\d\s]{1,3}(\d{2})\b", "20$1")


def iso_from(day: Column, month: Column, year: Column) -> Column:
    """``YYYY-MM-DD`` as text, month 00 if unknown; a year of two digits gets 2000 added."""
    y = F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(F.lpad(year, 4, "0"))
    m = F.coalesce(F.lpad(month_number(F.lower(month)).cast("string"), 2, "0"), F.lit("00"))
    return F.concat_ws("-", y, m, F.lpad(day, 2, "0"))


LONG = r"(\d{1,2})\s+de\s+([a-zA-ZáéíóúÁÉÍÓÚ]+)\s+de\s+(\d{4})"
NUMERIC = r"(\d{2})[./](\d{2})[./](\d{4})"


def spanish_to_iso(text: Column) -> Column:
    """ISO date of the first date in a text, in words or numbers; an unknown month counts as 01, no date gives ``0000-00-00``."""
    g = lambda p, k: F.regexp_extract(text, p, k)
    month = F.coalesce(F.lpad(month_number(F.lower(g(LONG, 2))).cast("string"), 2, "0"), F.lit("01"))
    return (
        F.when(text.rlike(LONG), F.concat_ws("-", g(LONG, 3), month, F.lpad(g(LONG, 1), 2, "0")))
        .when(text.rlike(NUMERIC), F.concat_ws("-", g(NUMERIC, 3), g(NUMERIC, 2), g(NUMERIC, 1)))
        .otherwise(F.lit("0000-00-00"))
    )


def iso_to_spanish(iso: Column) -> Column:
    """``2023-02-17`` as ``17 de febrero de 2023``; what has not three parts stays, an unknown month becomes ``de``."""
    table = F.create_map(*[F.lit(x) for n, name in sorted(NAMES.items()) for x in (f"{n:02d}", name)])

    def words(p: Column) -> Column:
        y, m, d = F.get(p, F.lit(0)), F.get(p, F.lit(1)), F.get(p, F.lit(2))
        day = F.coalesce(d.try_cast("int").cast("string"), d)
        return F.concat_ws(" de ", day, F.coalesce(F.try_element_at(table, m), F.lit("de")), y)

    return let(F.split(iso, "-", -1), lambda p: F.when(F.size(p) == 3, words(p)).otherwise(iso))
