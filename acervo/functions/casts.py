"""Readings of loosely typed Spanish values as one value of a type. All are column expressions; unreadable gives null.

The patterns use no lookaround, so the same text serves the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names and abbreviations with their numbers.
MONTHS = {
    "enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6, "julio": 7, "agosto": 8, "septiembre": 9, "setiembre": 9,
    "octubre": 10, "noviembre": 11, "diciembre": 12, "ene": 1, "feb": 2, "mar": 3, "abr": 4, "may": 5, "jun": 6, "jul": 7, "ago": 8,
    "sep": 9, "sept": 9, "set": 9, "oct": 10, "nov": 11, "dic": 12,
}

# Ways to say that nothing is known, lower case.
UNKNOWN = (
    "-", "--", "---", "?", "??", "¿?", ".", "...", "n/a", "na", "n.a.", "n/d", "nd", "n.d.", "s/i", "si/", "s.i.", "s/d", "s.d.", "s/inf",
    "null", "none", "nan", "nulo", "vacío", "vacio", "(vacío)", "(vacio)", "sin información", "sin informacion", "sin datos", "sin dato",
    "no registra", "no registrado", "no informa", "no informado", "no aplica", "no disponible", "no consta", "desconocido", "se desconoce",
    "sin antecedentes", "sin especificar", "no especificado", "no especifica",
)

# Readings of truth values, lower case.
TRUE, FALSE = ("si", "sí", "s", "1", "true", "t", "verdadero", "v", "x"), ("no", "n", "0", "false", "f", "falso")

_PREFIX = r"^[a-zà-ÿ°º.:#\s-]*?"
INTEGER = _PREFIX + r"([0-9]{1,3}(?:\.[0-9]{3})+|[0-9]+)(?:[.,]0+)?[a-zà-ÿ°º.\s]*$"
DECIMAL = (
    _PREFIX + r"([0-9]{1,3}(?:\.[0-9]{3})+(?:,[0-9]+)?|[0-9]{1,3}(?:,[0-9]{3})+\.[0-9]+|[0-9]+(?:[.,][0-9]+)?)"
    r"\s*(%|m2|m²|mts2?|ha|[a-zà-ÿ.\s]*)$"
)
_CITY = r"^(?:[a-zà-ÿ. ]+,\s*)?"
DATE_ISO = _CITY + r"([0-9]{4})[-/.]([0-9]{1,2})[-/.]([0-9]{1,2})$"
DATE_DMY = _CITY + r"([0-9]{1,2})[-/.]([0-9]{1,2})[-/.]([0-9]{4}|[0-9]{2})$"
DATE_LONG = _CITY + r"([0-9]{1,2})\s*(?:de\s+)?([a-z]+)\.?\s*(?:de\s+|del\s+)?([0-9]{4})$"


def plain(c: Column) -> Column:
    """Lower case, blanks squeezed and trimmed."""
    return F.lower(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")))


def is_known(c: Column) -> Column:
    """True if a value is not null or blank and does not merely say that nothing is known."""
    p = plain(c)
    return F.coalesce((p != "") & ~p.isin(*UNKNOWN), F.lit(False))


def read_integer(c: Column) -> Column:
    """One whole number; a prefix (``DDU N°``), a unit and thousands points are allowed, two numbers are not."""
    return F.replace(F.regexp_extract(plain(c), INTEGER, 1), F.lit("."), F.lit("")).try_cast("bigint")


def read_decimal(c: Column) -> Column:
    """One decimal number in any of the styles ``1.234,5``, ``1234,5``, ``1234.5``, ``1,234.5``; ``%`` divides by 100.

    A single point before exactly three digits separates thousands, unless the number begins with 0.
    """
    p = plain(c)
    n, unit = F.regexp_extract(p, DECIMAL, 1), F.regexp_extract(p, DECIMAL, 2)
    n = (
        F.when(n.rlike(r"^[0-9]{1,3}(,[0-9]{3})+\.[0-9]+$"), F.replace(n, F.lit(","), F.lit("")))
        .when(n.rlike(r"^[1-9][0-9]{0,2}(\.[0-9]{3})+(,[0-9]+)?$"), F.replace(F.replace(n, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
        .otherwise(F.replace(n, F.lit(","), F.lit(".")))
    )
    value = n.try_cast("decimal(20,6)")
    return F.when(unit == "%", value / 100).otherwise(value).cast("decimal(20,6)")


def read_boolean(c: Column) -> Column:
    """A truth value written in Spanish or English, or 0/1."""
    p = plain(c)
    return F.when(p.isin(*TRUE), F.lit(True)).when(p.isin(*FALSE), F.lit(False))


def month_number(name: Column) -> Column:
    """Number of a lower-case month name or abbreviation, null if it is none."""
    table = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])
    return F.try_element_at(table, name)


def iso(y: Column, m: Column, d: Column) -> Column:
    """The date of three texts, null if the calendar has no such day; a year of two digits gets 2000 added."""
    y = F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y)
    return F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")).try_cast("date")


def read_date(c: Column) -> Column:
    """A full calendar date (ISO, day-month-year or in words, with or without a city before it); partial dates give null."""
    p = plain(c)
    part = lambda pattern, g: F.regexp_extract(p, pattern, g)
    return F.coalesce(
        F.when(p.rlike(DATE_ISO), iso(part(DATE_ISO, 1), part(DATE_ISO, 2), part(DATE_ISO, 3))),
        F.when(p.rlike(DATE_DMY), iso(part(DATE_DMY, 3), part(DATE_DMY, 2), part(DATE_DMY, 1))),
        F.when(p.rlike(DATE_LONG), iso(part(DATE_LONG, 3), month_number(part(DATE_LONG, 2)).cast("string"), part(DATE_LONG, 1))),
    )


#: Reader and SQL type of each type name of the attribute list.
READERS = {
    "texto": (lambda c: c, "string"),
    "entero": (read_integer, "bigint"),
    "decimal": (read_decimal, "decimal(20,6)"),
    "booleano": (read_boolean, "boolean"),
    "fecha": (read_date, "date"),
}


def read_as(c: Column, kind: str) -> Column:
    """A known value read as ``kind``; null if it is unknown or unreadable."""
    reader, _ = READERS[kind]
    return F.when(is_known(c), reader(c))
