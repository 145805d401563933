"""Patterns in the common part of the regex dialects of Spark and of the SQL oracle.

A pattern built here has no lookaround and no named group; :func:`ci` ignores case in both engines. Where a word border
beside accented letters matters, the Spark side uses lookaround classes and the oracle is written out on its own.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Line ends as Python's ``splitlines`` knows them.
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"

#: Letters of the Spanish word classes that the rules name.
LETTERS = "a-zA-ZáéíóúÁÉÍÓÚñÑ"
UPPER = "A-ZÁÉÍÓÚÑ"

#: Borders of a word, for accented text.
START, END = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"


def ci(pattern: str) -> str:
    """The pattern with case ignored, also for accented letters."""
    return f"(?iu){pattern}"


def rx(c: Column, pattern: str) -> Column:
    """True if a case-ignoring pattern occurs."""
    return c.rlike(ci(pattern))


def any_of(c: Column, patterns) -> Column:
    """True if one of several case-ignoring patterns occurs; one alternation, so the text is read once."""
    return c.rlike(ci("|".join(f"(?:{p})" for p in patterns)))


def sub(c: Column, pattern: str, by: str) -> Column:
    """Replaces a case-ignoring pattern everywhere."""
    return F.regexp_replace(c, ci(pattern), by)


def strip(c: Column) -> Column:
    """Without Unicode blanks at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """Each run of Unicode blanks as one blank, trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def upper_share(c: Column) -> Column:
    """Share of capitals among the letters; null without letters."""
    letters = F.length(F.regexp_replace(c, r"\P{L}", ""))
    return F.when(letters > 0, F.length(F.regexp_replace(c, r"\P{Lu}", "")) / letters)


def let(c: Column, body) -> Column:
    """``body(c)`` with ``c`` evaluated once."""
    return F.get(F.transform(F.array(c), body), F.lit(0))


def guarded(c: Column, patterns, chain) -> Column:
    """``chain(c)`` where one of several patterns occurs, else ``c``: sound text is read once instead of once per rule."""
    return let(c, lambda x: F.when(any_of(x, patterns), chain(x)).otherwise(x))


def first_match(lines: Column, pattern: str, group: int = 1, where=None) -> Column:
    """Group of a case-ignoring pattern in the first of several lines that has it; null if none has."""
    fits = lambda l: rx(l, pattern) & (where(l) if where is not None else F.lit(True))
    return let(F.get(F.filter(lines, fits), F.lit(0)), lambda l: F.when(l.isNotNull(), F.regexp_extract(l, ci(pattern), group)))
