"""Signer of a circular: name and post from the lines around the greeting, by priority of candidates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from acervo.functions import text as T
from acervo.functions.regex import ci, let, rx, squeeze, strip
from acervo.operators import predicates as P
from acervo.operators.lines import first_index, head, indexed, last_index

# The greeting, posts, the heading of the distribution list with its misreadings, and the foot of the last page (patterns).
GREETING = r"Saluda\s+atentamente|^Atentamente\b"
POST = r"JEFE|DIRECTOR|MINISTRO|SUBSECRETARI[OA]|SECRETARI[OA]|DIVISI[ÓO?I�\s]+N\s+DE\s+DESARROLLO\s+URBANO"
DISTRIBUTION = r"^(DISTRIBUCI[OÓ?I\s]+N|BUCI[OÓ?I\s]+N|STRIBUCI[OÓ?I\s]+N|D\s*STRIBUC[I?OÓ\s]*N|RIB[a-z\s)?]*[ÓO]N)[\s:]*"
CLOSING = r"Ministerio\s+de\s+Vivienda\s+y\s+Urbanismo\s*-\s*Alameda"
# Headings that may stand between greeting and signature.
HEADINGS = frozenset("MOTIVO CONSIDERACIONES MATERIA MATERIAS OBSERVACIONES ANTECEDENTES CIRCULAR TABLA CUADRO MODIFICA MODIFICAN".split())


def _until(lines: Column, stop) -> Column:
    """Lines before the first stop line."""
    at = first_index(lines, stop)
    return F.when(at >= 0, F.slice(lines, F.lit(1), at)).otherwise(lines)


def _only_headings(l: Column) -> Column:
    words = F.array_distinct(F.regexp_extract_all(F.upper(l), F.lit("([A-ZÁÉÍÓÚÑ]+)"), F.lit(1)))
    return (F.size(words) > 0) & (F.size(F.array_except(words, F.array(*[F.lit(w) for w in sorted(HEADINGS)]))) == 0)


def _letters(l: Column) -> Column:
    return strip(F.regexp_replace(l, "[^\\p{L}\\s]", ""))


def signature_lines(lines: Column) -> Column:
    """Up to 15 lines after the first greeting, cleaned, before distribution or page foot; none without a greeting."""
    at = first_index(lines, lambda l: rx(l, GREETING))
    after = F.when(at >= 0, F.slice(lines, at + 2, F.lit(15))).otherwise(F.array().cast("array<string>"))
    kept = F.filter(
        _until(after, lambda l: rx(l, DISTRIBUTION) | rx(l, CLOSING)), lambda l: (l != "") & ~_only_headings(l) & ~l.rlike(r"^[\d/\-(),.\s:_~|]+$")
    )
    return F.filter(F.transform(kept, lambda l: T.fix_signer(strip(F.regexp_replace(l, r"^[_\s\-|.~:]+", "")))), lambda l: l != "")


def signer(text: Column, lines: Column) -> dict[str, Column]:
    """``nombre_firmante``, ``cargo_firmante`` and both as ``firmante``.

    The post is the first line that names one, with the ministry in the line below it. The name is, in this order: the nearest
    person above the post, the first person below it, the nearest person in the ten lines before the final distribution list,
    and the person in the line ``DE:``.
    """
    parts = signature_lines(lines)

    def chosen(p: Column) -> Column:
        at = first_index(p, lambda l: rx(l, POST))
        below = F.get(p, at + 1)
        post = F.when(at >= 0, F.when(F.coalesce(rx(below, r"MINISTERIO\s+DE\s+VIVIENDA"), F.lit(False)), F.concat_ws(", ", F.get(p, at), below)).otherwise(F.get(p, at)))
        upper = F.when(at >= 0, F.slice(p, F.lit(1), at)).otherwise(p)
        above = F.try_element_at(F.filter(upper, P.is_person_name), F.lit(-1))
        under = F.get(F.filter(F.when(at >= 0, F.slice(p, at + 2, F.lit(15))).otherwise(F.array().cast("array<string>")), lambda l: ~rx(l, "MINISTERIO") & P.is_person_name(l)), F.lit(0))
        plain = F.filter(p, lambda l: ~l.rlike(r"[/~*<>();\\]") & l.rlike("[A-ZÁÉÍÓÚÑa-z]{3,}") & ~rx(l, "|".join(sorted(HEADINGS))))
        loose = F.when((at < 0) & (F.size(plain) > 0), F.array_join(plain, ", "))
        return F.struct(_letters(F.coalesce(above, under)).alias("name"), F.coalesce(post, loose).alias("post"))

    closing = last_index(lines, lambda l: rx(l, r"^(DISTRIBUCI[ÓO]N|1\.\s+Sr\.\s+Ministro|Sr\.\s+Ministro\s+de\s+Vivienda)"))
    near = F.when(closing > F.size(lines) / 2, F.slice(lines, F.greatest(closing - 9, F.lit(1)), F.least(closing, F.lit(10))))
    tail = F.filter(F.transform(F.coalesce(near, F.array().cast("array<string>")), T.fix_signer), lambda l: l != "")
    from_line = F.get(F.filter(head(lines, 30), lambda l: rx(l, r"^\s*DE\s*(:|\s+(JEFE|DIRECTOR|MINISTRO|SUBSECRETARI|SECRETARI))")), F.lit(0))
    pieces = F.transform(F.split(F.regexp_replace(F.regexp_replace(from_line, ci(r"^\s*DE\s*:?\s*"), ""), r"\.$", ""), r"\s*[,–—-]\s*"), T.fix_signer)
    by = let(parts, lambda p: let(p, chosen))
    nonempty = lambda c: F.when(c != "", c)
    name = F.coalesce(nonempty(by["name"]), nonempty(_letters(F.try_element_at(F.filter(tail, P.is_person_name), F.lit(-1)))), F.get(F.filter(pieces, P.is_person_name), F.lit(0)), F.lit(""))
    post = F.coalesce(
        nonempty(by["post"]), F.get(F.filter(tail, lambda l: rx(l, POST)), F.lit(0)), F.get(F.filter(pieces, lambda l: rx(l, POST) & ~P.is_person_name(l)), F.lit(0)), F.lit("")
    )

    def together(p: Column) -> Column:
        both = F.when((p["n"] != "") & (p["c"] != ""), F.concat_ws(", ", p["n"], p["c"])).otherwise(F.concat(p["n"], p["c"]))
        return F.struct(F.regexp_replace(squeeze(both), r"\.$", "").alias("firmante"), p["n"].alias("nombre_firmante"), p["c"].alias("cargo_firmante"))

    # A text without greeting, list or sender has no signer; one look at its lines spares the rest.
    marked = F.exists(lines, lambda l: rx(l, rf"{GREETING}|^DISTRIBUCI[ÓO]N|^(1\.\s+)?Sr\.\s+Ministro|^\s*DE\s*(:|\s+(JEFE|DIRECTOR|MINISTRO|SUBSECRETARI|SECRETARI))"))
    parts_of = F.struct(strip(T.fix_signer(name)).alias("n"), strip(T.fix_signer(post)).alias("c"))
    got = let(F.when(F.coalesce(marked, F.lit(False)), parts_of).otherwise(F.struct(F.lit("").alias("n"), F.lit("").alias("c"))), together)
    return {c: got[c] for c in ("firmante", "nombre_firmante", "cargo_firmante")}


__all__ = ["indexed", "signature_lines", "signer"]
