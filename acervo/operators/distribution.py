"""Distribution list of a circular: an ordered fold over its lines with the carried number of the next item."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from acervo.functions import text as T
from acervo.functions.regex import any_of, ci, let, rx, strip
from acervo.operators.lines import first_index, last_index
from acervo.operators.signer import DISTRIBUTION

# Lines that open a distribution list without its heading (patterns).
OPENERS = r"^((\d+\.|\d+!|l\.|I\.)\s*)?(Sr\.|Sra\.|Sres\.)\s+(Ministr|Subsecretari|Contralor|Gobernador|Director|Jefe)"
LATE_OPENERS = r"^(Sr\.|Sra\.|1\.|1!)"
# Page feet, rules and headings between the items. Names of signers are data: pass them as ``skip``.
SKIPPED = (
    r"P[áa]gina\s+\d+", r"Ministerio\s+de\s+Vivienda\s+y\s+Urban\s*ismo\s*-\s*Alameda", r"GOBIERNO\s+DE\s+CHILE", r"Alameda\s+924", r"Santiago\s*-\s*Chile", r"^[=:\-~\s]{4,}$", r"^!+$",
    r"^(JEFE\s+DIVISI[ÓO]N|DIVISI[ÓO]N\s+DE\s+DESARROLLO|MINISTERIO\s+DE\s+VIVIENDA)\b", r"^[.,\s~]+\s*k1",
)
CONNECTOR = r"(y|e|de|del|al|para|en|la|el|los|las|,)$"


def distribution(text: Column, lines: Column, skip: tuple[str, ...] = ()) -> Column:
    """Array of the numbered recipients.

    A distribution header opens the list and clears what was found before; without one, the greeting, a numbered authority or
    a late ``Sr.`` opens it. An item without a number is joined to the one before if that ends in a connector or without a
    full stop, else it takes the next number.
    """
    total = F.size(lines)
    zero = F.struct(F.lit(False).alias("on"), F.array().cast("array<string>").alias("got"), F.lit(1).alias("n"))
    state = lambda on, got, n: F.struct(on.alias("on"), got.alias("got"), n.alias("n"))
    number = lambda x: F.regexp_extract(x, r"^(\d+)\.", 1).try_cast("int")
    numbered = lambda x: x.rlike(r"^\d+\.")
    empty = F.array().cast("array<string>")

    def add(on: Column, got: Column, n: Column, raw: Column, joins: bool) -> Column:
        def put(item: Column) -> Column:
            last = F.element_at(got, -1)
            continues = F.lit(joins) & (F.size(got) > 0) & ~numbered(item) & (rx(last, CONNECTOR) | ~last.endswith("."))
            grown = F.concat(F.slice(got, 1, F.size(got) - 1), F.array(F.concat(F.regexp_replace(last, ",+$", ""), F.lit(" "), item)))
            return (
                F.when(F.length(item) < (3 if joins else 1), state(on, got, n))
                .when(numbered(item), state(on, F.concat(got, F.array(item)), F.coalesce(number(item) + 1, n) if joins else n))
                .when(F.when(F.size(got) > 0, continues).otherwise(F.lit(False)), state(on, F.when(F.size(got) > 0, grown).otherwise(got), n))
                .otherwise(state(on, F.concat(got, F.array(F.concat(n.cast("string"), F.lit(". "), item))), n + 1))
            )

        return let(T.fix_recipient(raw), put)

    def step(s: Column, x: Column) -> Column:
        l = x["l"]
        header = rx(l, DISTRIBUTION) & ~rx(l, r"^(A|PARA)\b")
        rest = strip(F.regexp_replace(l, ci(DISTRIBUTION), ""))
        greeting = ~s["on"] & rx(l, r"Saluda\s+atent")
        on = s["on"] | rx(l, OPENERS) | ((x["i"] >= total - 50) & rx(l, LATE_OPENERS))
        return (
            F.when(header & ((rest == "") | rest.rlike(r"^\d+$")), state(F.lit(True), empty, F.lit(1)))
            .when(header, add(F.lit(True), empty, F.lit(1), rest, False))
            .when(greeting, state(F.lit(True), s["got"], s["n"]))
            .when(~on | any_of(l, (*SKIPPED, *skip)), state(on, s["got"], s["n"]))
            .otherwise(add(on, s["got"], s["n"], l, True))
        )

    # A header clears what was found before, so the fold starts at the last one; without a header it starts at the first line
    # that can open the list, and without such a line there is no list.
    is_header = lambda l: rx(l, DISTRIBUTION) & ~rx(l, r"^(A|PARA)\b")
    opener = first_index(lines, lambda l: any_of(l, (DISTRIBUTION, OPENERS, LATE_OPENERS, r"Saluda\s+atent")))

    def folded(start: Column) -> Column:
        rows = F.filter(F.transform(lines, lambda l, i: F.struct(i.alias("i"), l.alias("l"))), lambda x: (x["i"] >= start) & (x["l"] != ""))
        return F.when(start >= 0, F.aggregate(rows, zero, step, lambda s: s["got"])).otherwise(empty)

    return let(let(last_index(lines, is_header), lambda h: F.when(h >= 0, h).otherwise(opener)), folded)


def distribution_text(items: Column) -> Column:
    """The list as one text."""
    return F.array_join(items, "; ")
