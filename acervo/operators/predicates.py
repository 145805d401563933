"""Predicates over one line.

A line is compared with phrases that are written as plain text, word by word: case, accents, and all marks and blanks between words
make no difference, as scanners lose and add them. A few features of the line itself (its capitals, its first number) complete them.
The same phrases serve the column expressions here, as one pattern that reads a line once, and the automaton of the body, over the word
form of a line (:func:`words_of`).
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column
from pyspark.sql import functions as F

from acervo import overrides
from acervo.functions.casts import MONTHS
from acervo.functions.regex import any_of, ci, rx, upper_share

_FOLDED, _BASE = "áéíóúüñàèìòùâêîôûäëïöãõç", "aeiouunaeiouaeiouaeioaoc"
_PAIRS = tuple(zip(_FOLDED, _BASE))
#: What stands between words, and the forms of a letter.
GAP = f"[^a-z0-9{_FOLDED}]"
_FORMS = {b: f"[{b}{''.join(x for x, y in _PAIRS if y == b)}]" for b in sorted(set(_BASE))}


def folded(line: str) -> str:
    """A Python string in lower case without accents."""
    low = line.lower()
    if not low.isascii():
        for a, b in _PAIRS:
            if a in low:
                low = low.replace(a, b)
    return low


_GAPS = re.compile("[^a-z0-9]+")


def words_of(line: str) -> str:
    """:func:`words` of a Python string."""
    return f" {_GAPS.sub(' ', folded(line)).strip()} "


@dataclass(frozen=True)
class Phrases:
    """Phrases in word form that a line begins with, holds, or is. ``#`` stands for a number and ``*`` for a word."""

    begins: tuple[str, ...] = ()
    holds: tuple[str, ...] = ()
    is_: tuple[str, ...] = ()

    @cached_property
    def pattern(self) -> str:
        parts = [f"^ {p} " for p in self.begins] + [f" {p} " for p in self.holds] + [f"^ {p} $" for p in self.is_]
        return "|".join(parts).replace("#", "[0-9]+").replace("*", "[a-z]+")

    @cached_property
    def _compiled(self) -> re.Pattern:
        return re.compile(self.pattern)

    def column(self, l: Column, lead: str = "") -> Column:
        """The test as a column; ``lead`` is a pattern that may stand before a beginning."""
        spell = lambda p: f"{GAP}+".join("".join({"#": "[0-9]+", "*": f"[a-z{_FOLDED}]+"}.get(c, _FORMS.get(c, c)) for c in w) for w in p.split())
        parts = [f"^{lead}{GAP}*{spell(p)}(?={GAP}|$)" for p in self.begins] + [f"(?<!{GAP[:1]}{GAP[2:]}){spell(p)}(?={GAP}|$)" for p in self.holds] + [f"^{GAP}*{spell(p)}{GAP}*$" for p in self.is_]
        return l.rlike(ci("|".join(parts)))

    def test(self, w: str) -> bool:
        return bool(self._compiled.search(w))


# What the lines of circulars say, in word form.
DRAWING = Phrases(holds=("planta azotea", "corte esquematico", "sin escala"))
LABELS = Phrases(is_=overrides.DRAWING_LABELS)
TABLE_HEADS = ("tipo de gestion", "casos que comprende", "n circular", "ddu n n ord")
TABLE = Phrases(begins=(*TABLE_HEADS, "n ord"), holds=("materia s que se modifica n",), is_=("ddu n", "materia de la circular", "motivos consideraciones", "modificaciones"))
BARRED_TABLE = Phrases(begins=("circular", "tipo de gestion", "ddu n"))
TABLE_REST = Phrases(begins=(*TABLE_HEADS, "n ord fecha", "materia de la circular", "motivos consideraciones", "modificaciones"))
MARGIN = Phrases(
    holds=("circular modificada por", "modificada por circular", "dejada sin efecto por"),
    is_=("circular ord n #", "circular ord #", "de fecha # de *", "de fecha # de * de #", "de # ddu #", "numeral #"),
)
NO_NOTE = Phrases(begins=("# o mas", "# para todas", "# y cumplan", "# de la ley", "# de la lguc", "# de la oguc", *(f"# de {m}" for m in MONTHS)))
INDEX = Phrases(begins=("indice", "tabla de contenido", "tabla de contenidos", "contenido", "contenidos"))
#: Page feet, compared without blanks, as their letters are often set apart; and a page number.
FEET = ("ministeriodevivienda", "alameda924", "santiago-chile", "gobiernodechile")
PAGE_NUMBER = "pagina[0-9]"
RECIPIENTS = Phrases(begins=tuple(f"{n}{w}" for n in ("", "# ") for w in ("sr", "sra", "sres", "biblioteca", "colegio", "instituto", "camara", "depto", "archivo", "jefe", "oirs", "oficina")))
DESCRIPTORS = Phrases(
    begins=(
        "permisos", "vigencia", "recepciones", "de la planificacion", "modificacion", "aprobaciones", "estudios de riesgo", "plan regulador", "normas", "normas urbanisticas",
    )
)
DESCRIPTOR_WORDS = (
    "planificacion", "regulador", "seccional", "permisos", "recepciones", "riesgo", "aprobaciones", "modificacion", "normas", "urbanisticas", "edificacion", "pisos", "mecanicos", "altura",
)
NO_DESCRIPTOR = Phrases(
    begins=(
        "a", "de jefe", "de ministro", "de subsecretario", "de subsecretaria", "de director", "de directora", "de secretario", "de secretaria", "de division", "ddu", "circular", "ord", "oro", "ant", "mat",
        "santiago", "valparaiso", "complementa", "trabajando", "gobierno", "ministerio",
    )
)
# Names of the columns of the known tables, and words of offices and headings that are no person's name.
HEADER_TERMS = (
    "ddu n", "n° circular", "nº circular", "n° ord", "nº ord", "ord", "fecha", "materia de la circular", "motivos / consideraciones", "modificaciones", "tipo de gestión", "casos que comprende",
    "circular", "materia(s) que se modifica", "motivo y/o", "consideraciones",
)
NO_PERSON = (
    "MOTIVO", "CONSIDERACIONES", "MATERIA", "MATERIAS", "OBSERVACIONES", "ANTECEDENTES", "CIRCULAR", "TABLA", "CUADRO", "MODIFICA", "MODIFICAN", "DISTRIBUCION", "DISTRIBUCIÓN", "MINISTERIO",
    "VIVIENDA", "URBANISMO", "DIVISIÓN", "DIVISION", "DESARROLLO", "URBANO", "GOBIERNO", "CHILE", "ORD", "DDU", "OFPA", "ANT", "MAT", "DE", "A", "PARA", "SANTIAGO", "SALUDA", "ATENTAMENTE",
    "PÁGINA", "PAGINA", "FECHA", "SUBSECRETARIO", "SUBSECRETARIA", "MINISTRO", "MINISTRA", "CONTRALOR", "CONTRALORA",
)

FRACTIONS = "^[½¼¾�?]+$"
LEADERS = r"\.{4,}|\.{3,}\s*\d+$"
NUMERAL = r"^\d{1,2}\. "
#: A footnote: its number, perhaps a letter, and a capital or quote behind a blank.
NOTE = r"^\d{1,2}\s*(?:[a-z]\))?\s+[\p{Lu}\"“'‘(]"
KEYWORD_LIST = r"^[\p{Lu}0-9\s;]{3,}(,\s*[\p{Lu}0-9\s;]{3,})+\.?$"


def is_drawing_title(l: Column) -> Column:
    return DRAWING.column(l)


def is_drawing_label(l: Column) -> Column:
    """A label of a drawing: fractions, a drawing title, or one of the short labels."""
    return l.rlike(FRACTIONS) | DRAWING.column(l) | ((F.length(l) < 80) & LABELS.column(l))


def is_table_start(l: Column) -> Column:
    return TABLE.column(l) | (l.startswith("|") & BARRED_TABLE.column(l))


def is_margin_note(l: Column) -> Column:
    """A margin note that says the circular was amended later."""
    return MARGIN.column(l)


def is_note_start(l: Column) -> Column:
    """Start of a footnote, not a quantity, date or numeral."""
    return l.rlike(NOTE) & ~NO_NOTE.column(l) & ~l.rlike(NUMERAL)


def is_page_foot(l: Column) -> Column:
    """A page number, a line of the letterhead, or exclamation marks only (rests of a rule)."""
    torn = "|".join(r"\s*".join(_FORMS.get(c, c) for c in f) for f in FEET)
    return l.rlike(ci(rf"p\s*[aá]\s*g\s*i\s*n\s*a\s*[0-9]|{torn}|^[!\s]*!\s*$"))


def is_index_start(l: Column) -> Column:
    return INDEX.column(l, lead=f"(?:{GAP}*[ivxlcdm0-9]+{GAP}+)*")


def is_index_line(l: Column) -> Column:
    return is_index_start(l) | l.rlike(LEADERS)


def is_table_residue(p: Column, cells: tuple[str, ...] = overrides.TABLE_CELLS) -> Column:
    """A paragraph that is left over from a table: a heading, a numbered row with a date, or one of the known cells."""
    known = F.lit(False)
    for c in cells:
        known = known | p.startswith(c)
    return TABLE_REST.column(p) | p.rlike(r"^\d{3}\s+\d+\s+\d\d[-.]\d\d[-.]\d\d") | known | (p.startswith("La ejecución de obras de urbanización") & p.contains("Art. 2.2.1."))


def is_recipient(p: Column) -> Column:
    """A recipient, numbered or not, that begins with a capital. ``Sr.`` and its forms count also before a blank."""
    return p.rlike(r"^(?:\d+\.\s+)?\p{Lu}") & RECIPIENTS.column(p)


def is_body_paragraph(p: Column) -> Column:
    """A paragraph that stays in the body: no dot leaders, index, footnote, table residue or recipient."""
    return ~(p.rlike(r"\.{5,}|\.{3,}\s*\d+$") | rx(p, r"\b[IÍ]NDICE\b\s*:") | is_note_start(p) | is_table_residue(p) | is_recipient(p))


def is_upper(l: Column, share: float = 0.65) -> Column:
    """At least this share of the letters are capitals; false without letters."""
    return F.coalesce(upper_share(l) >= share, F.lit(False))


def is_descriptor_line(l: Column) -> Column:
    return is_upper(l) & ~(NO_DESCRIPTOR.column(l) | l.rlike(r"(?i)^(?:DE\s*:|\d+\.)"))


def is_descriptor_start(l: Column) -> Column:
    """A line that opens the descriptors: a known beginning, or mostly capitals with a known word or semicolon."""
    letters = F.length(F.regexp_replace(l, r"\P{L}", ""))
    spelt = "|".join("".join(_FORMS.get(c, c) for c in w) for w in DESCRIPTOR_WORDS)
    return DESCRIPTORS.column(l) | ((letters >= 5) & is_upper(l, 0.75) & (l.contains(";") | rx(l, spelt)))


def is_person_name(l: Column) -> Column:
    """At least two words of two letters or more that begin with a capital, none of them a word of offices and headings."""
    named = F.filter(F.split(F.regexp_replace(l, "[^A-ZÁÉÍÓÚÑa-z]", " "), r"\s+"), lambda w: w.rlike("^[A-ZÁÉÍÓÚÑ].+$"))
    stop = F.array(*[F.lit(x) for x in NO_PERSON])
    return (F.size(named) >= 2) & ~F.exists(named, lambda w: F.array_contains(stop, F.upper(w)))


def is_header_row(cells: Column) -> Column:
    """A row of column names of the known tables."""
    text = F.lower(F.array_join(F.filter(cells, lambda c: c != ""), " "))
    return (text != "") & any_of(text, [t.replace("(", r"\(").replace(")", r"\)") for t in HEADER_TERMS])


def is_title_continuation(l: Column) -> Column:
    """A further line of a section title: mostly capitals, no numeral, closing or page foot."""
    numeral = rx(l, r"^(?:\d+|[IVXLCDM]+|[l1]+)\.\s+")
    return (l != "") & ~is_page_foot(l) & ~numeral & ~l.rlike(ci(r"^(?:Saluda|Distribuci[óo]n)")) & is_upper(l)


__all__ = [n for n in dir() if n.startswith("is_")] + ["ci"]
