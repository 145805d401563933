"""Variant spellings of names typed by people: linking those that name the same person or office.

Method: pigeonhole segment join. Each string is normalised to one name (case, accents, titles, order of the parts, nicknames, kinds of
offices); these whole names, and the shorter forms that a full name may be written in (initials, no second part), are cut into k + 1 = 2
segments that go into an inverted index; each name looks up its own position-shifted substrings there, for the lengths that one edit
allows, and what is found is verified with a banded edit distance. One edit is tolerated, a swap of neighbours counting as one; a third
key, the outer quarters, finds the swaps and edits across the border of the two segments. All links are made so, also those between names
that are equal once normalised: a full name takes the best supported full name within one edit, any other name the only full name
that has such a form. Different given names with the same surnames are relatives and stay apart.

Everything runs over different normalised names, which are counted first. A segment that very many names share is split: its entries
are dealt over as many parts as their number asks for, and the names that look it up meet all of them. Pairs are made only within one
entity, as the result asks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo.llm.lexicon import FOLD, GIVEN, NICKNAMES
from acervo.session import cut, dealt

#: Shortest name (without its kind) in which an edit is tolerated; entries of one segment that one task takes.
LEAST, HOT = 4, 1000

PERSONS, OFFICES = ("nombre_firmante",), ("emisor", "destinatarios")

# Titles before and marks after a person's name, particles, folded.
TITLES = frozenset("arq arquitecto arquitecta ing ingeniero ingeniera abog abogado abogada don dona sr sra srta senor senora dr dra prof lic mg s sub subrogante".split())
PARTICLES = frozenset("de del la las los da di viuda vda".split())

# Words by which an office is known, in order of decision.
ROLES = (
    ("distribucion", frozenset(("distribucion",))),
    ("dom", frozenset(("dom", "obras"))),
    ("secpla", frozenset(("secpla", "secplan", "secplac", "planificacion"))),
    ("alcalde", frozenset(("alcalde", "alcaldesa", "alcaldia"))),
    ("subsecretaria", frozenset(("subsecretario", "subsecretaria", "subsec"))),
    ("juridica", frozenset(("juridica", "juridico"))),
    ("ddu", frozenset(("ddu", "desarrollo", "des"))),
    ("seremi", frozenset(("seremi", "srm", "ministerial", "regional"))),
)
# Words of offices that do not tell one office of a kind from another.
COMMON = frozenset(
    """de del la las los el y e i a comuna ilustre municipalidad municipal municipales mun muni region sr sra srta senor senora don dona director directora direccion dir obras
    secretario secretaria sec com comunal planificacion ministerial regional reg v u vivienda urbanismo s jefe jefa jefatura division div des desarrollo urbano subsecretario
    subsecretaria alcalde alcaldesa alcaldia dom secpla secplan secplac seremi srm ddu juridica juridico""".split()
)

GIVEN_SET = frozenset(GIVEN)
NICK = {k.translate(FOLD): v for k, v in NICKNAMES.items()}
ALL_GIVEN = GIVEN_SET | frozenset(NICK)
OFFICE_WORDS = COMMON | frozenset().union(*(known for _, known in ROLES))


def fold(text: str) -> str:
    return text.lower().translate(FOLD)


@lru_cache(maxsize=200_000)
def near(word: str, known: frozenset[str], least: int) -> str | None:
    """The only known word within one edit (a swap of neighbours is one) of a word; the word itself if it is known."""
    if word in known:
        return word
    if len(word) < least:
        return None
    letters = "abcdefghijklmnopqrstuvwxyz"
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    edits = {a + b[1:] for a, b in cuts if b} | {a + b[1] + b[0] + b[2:] for a, b in cuts if len(b) > 1}
    edits |= {a + c + b[1:] for a, b in cuts if b for c in letters} | {a + c + b for a, b in cuts for c in letters}
    got = {e for e in edits if e in known}
    return got.pop() if len(got) == 1 else None


def words(name: str, person: bool) -> tuple[list[str], int, bool]:
    """Folded parts of a name in natural order, how many of them stood behind a comma (persons; -1 without comma), and if it had a title."""
    t = fold(name) if person else re.sub(r"\b((?:[a-z]\.){2,})", lambda m: m[1].replace(".", "") + " ", fold(name))
    split = lambda x: re.findall(r"[^\W_]+", x)
    if not person:
        return split(t), -1, False
    last, comma, first = t.partition(",")
    every = [split(x) for x in ((first, last) if comma else (last,))]
    kept = [[w for i, w in enumerate(ws) if w not in TITLES or (len(w) == 1 and (i or comma))] for ws in every]
    return sum(kept, []), len(kept[0]) if comma else -1, sum(map(len, kept)) < sum(map(len, every))


def given(word: str) -> str | None:
    """The given name or nickname that a part is, or is one edit away from."""
    return near(word, ALL_GIVEN, 4) or (near(word, ALL_GIVEN, 3) if len(word) == 3 else None)


def parse_person(parts: list[str], behind: int, titled: bool) -> tuple[list[str], str | None, list[str]]:
    """``(meanings of the first given name, second given name, surnames)``; initials stay single letters.

    Without a comma the given names are told from surnames by the list of given names (as written, then within one edit), else by their place:
    three parts or more begin with a given name, as do two without a title; two behind a title are surnames.
    """
    parts = [p for p in parts if p not in PARTICLES]
    if behind >= 0:
        first, rest = parts[:behind], parts[behind:]
    else:
        is_given = [p in ALL_GIVEN for p in parts]
        if not any(is_given):
            is_given = [given(p) is not None and (len(parts) > 2 or i == 0) for i, p in enumerate(parts)]
        whole = [i for i, p in enumerate(parts) if not is_given[i] and len(p) > 1]
        if not whole:
            first, rest = parts[:1], parts[1:]
        elif is_given[-1] and not is_given[0] and len(parts[0]) > 1:  # surnames first
            k = next(i for i, g in enumerate(is_given) if g)
            first, rest = parts[k:], parts[:k]
        elif len(parts[-1]) == 1 and not any(is_given) and len(parts[0]) > 1:  # surnames and an initial
            first, rest = parts[-1:], parts[:-1]
        elif whole[0] == 0 and titled and len(parts) == 2:
            first, rest = [], parts
        elif whole[0] == 0:
            first, rest = parts[:1], parts[1:]
        else:
            k = whole[0]
            if len(parts) - k > 2 and k == 1 and given(parts[k]) and len(parts[k]) > 3:  # a misspelt second given name
                k += 1
            first, rest = parts[:k], parts[k:]
    first = [p if len(p) == 1 else given(p) or p for p in first]
    main = first[0] if first else None
    more = [g for g in first[1:] if main not in NICK.get(g, ())]  # a nickname beside its given name
    return list(NICK.get(main, (main,))) if main else [], (more[0] if more else None), rest


def parse_office(parts: list[str]) -> tuple[str, str] | None:
    """``(kind, rest of the name)`` of an office; None for names of no office. Misspelt and torn words of offices are known."""
    words: list[str] = []
    for p in parts:
        if words and p not in OFFICE_WORDS and words[-1] not in OFFICE_WORDS and near(words[-1] + p, OFFICE_WORDS, 99):
            words[-1] += p
        else:
            words.append(p)
    words = [near(w, OFFICE_WORDS, 5) or w for w in words]
    held = set(words)
    kind = next((r for r, known in ROLES if held & known), None)
    if kind == "distribucion" or not words:
        return None
    if kind is None:
        return "?", " ".join(sorted(held - {"de", "del", "la", "las", "los", "el", "y"}))
    return kind, "".join(w for w in words if w not in COMMON)


# -- the segment join


def _swapped(a: Column, b: Column) -> Column:
    """True if swapping two neighbours turns one string into the other."""
    at = lambda i: F.concat(F.substring(b, F.lit(1), i - 1), F.substring(b, i + 1, F.lit(1)), F.substring(b, i, F.lit(1)), F.substring(b, i + 2, F.length(b)))
    return (F.length(a) == F.length(b)) & (F.length(b) > 1) & F.exists(F.sequence(F.lit(1), F.greatest(F.length(b) - 1, F.lit(1))), lambda i: a == at(i))


def segment_join(names: DataFrame, index: DataFrame) -> DataFrame:
    """``(grupo, a, b, d)``: names ``a`` of ``names (grupo, a)`` and entries ``b`` of ``index (grupo, b)`` of one group within ``d`` = 0 or 1 edits.

    Both sides are different strings per group. A name of n characters is cut into its first n/2 characters and the rest; whoever is within one
    edit of it has one of the two segments whole, shifted by at most the difference of the lengths, or, if the edit or swap lies on the
    border, its outer quarters. Names shorter than :data:`LEAST` meet only their equals.
    """
    n = F.length("b")
    half, quarter = F.floor(n / 2).cast("int"), F.floor(n / 4).cast("int")
    key = lambda n, k, s: F.struct(n.cast("int").alias("n"), F.lit(k).alias("k"), s.alias("s"))
    long = n >= LEAST
    entries = index.select(
        "grupo", "b", F.explode(F.array_compact(F.array(
            F.when(long, key(n, 0, F.substring("b", F.lit(1), half))), F.when(long, key(n, 1, F.substring("b", half + 1, n))),
            F.when(long, key(n, 2, F.concat(F.substring("b", F.lit(1), quarter), F.lit("\0"), F.substring("b", n - quarter + 1, n)))), F.when(~long, key(n, 3, F.col("b"))),
        ))).alias("e"),
    ).select("grupo", "b", "e.*")
    n = F.length("a")
    quarter = F.floor(n / 4).cast("int")
    looked = [F.when(n >= LEAST, key(n, 2, F.concat(F.substring("a", F.lit(1), quarter), F.lit("\0"), F.substring("a", n - quarter + 1, n)))), F.when(n < LEAST, key(n, 3, F.col("a")))]
    for d in (-1, 0, 1):  # the entry is so much longer
        m = n + d
        h = F.floor(m / 2).cast("int")
        ok = (m >= LEAST) & (n >= LEAST)
        looked.append(F.when(ok, key(m, 0, F.substring("a", F.lit(1), h))))
        looked.append(F.when(ok, key(m, 1, F.substring("a", h + 1 - d, n))))
    queries = names.select("grupo", "a", F.explode(F.array_compact(F.array(*looked))).alias("e")).select("grupo", "a", "e.*")
    index_side, query_side, keys = dealt(entries, queries, ["grupo", "n", "k", "s"], HOT)
    found = query_side.join(index_side, keys).select("grupo", "a", "b").distinct()
    edits = F.levenshtein("a", "b", 2)
    long = F.least(F.length("a"), F.length("b")) >= LEAST
    d = F.when(F.col("a") == F.col("b"), 0).when(long & ((edits == 1) | ((edits == 2) & _swapped(F.col("a"), F.col("b")))), 1)
    return found.withColumn("d", d).where("d is not null")


def best_supported(names: DataFrame, may: Column | None = None) -> DataFrame:
    """``(grupo, a, b)``: each name with the name that it is a spelling of: the best supported one within one edit, or itself.

    ``names`` has ``grupo, clave, apoyo`` (an orderable support, different for different names); ``may`` is a further condition on ``a`` and
    ``b``. A name within one edit of a spelling takes what the spelling takes.
    """
    found = segment_join(names.select("grupo", F.col("clave").alias("a")), names.select("grupo", F.col("clave").alias("b")))
    if may is not None:
        found = found.where((F.col("d") == 0) | may)
    support = names.select("grupo", F.col("clave").alias("b"), "apoyo")
    best = cut(found.join(support, ["grupo", "b"]).groupBy("grupo", "a").agg(F.max(F.struct("apoyo", "b"))["b"].alias("b")))
    further = best.where("a <> b").select("grupo", F.col("a").alias("b"), F.col("b").alias("c"))
    return best.join(further, ["grupo", "b"], "left").select("grupo", "a", F.coalesce("c", "b").alias("b"))


# -- names to entities

_ROW = "clase string, campo string, nombre string, veces bigint, tipo string, g1 string, g2 string, s1 string, s2 string, apellidos string, varios boolean"


def normalised(names: DataFrame) -> DataFrame:
    """One row per different ``(campo, nombre)`` and meaning: an office as ``tipo`` and ``apellidos`` (the rest of its name), or the parts of a person.

    ``apellidos`` are all surnames without blanks, so that a torn one makes no difference. A nickname with several meanings gives a row for
    each, with ``varios`` true. Names of one part have a surname only.
    """
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), *[pa.string()] * 6, pa.bool_()]
    columns = [x.split()[0] for x in _ROW.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for field, name, times in zip(*(c.to_pylist() for c in b.columns)):
                person = field in PERSONS
                parts, behind, titled = words(name, person)
                if not parts:
                    continue
                if not person:
                    office = parse_office(parts)
                    if office:
                        out.append(("o", field, name, times, office[0], None, None, None, None, office[1], False))
                    continue
                first, second, rest = parse_person(parts, behind, titled)
                if not rest:
                    first, rest = [], parts[:1]
                full = [p for p in rest if len(p) > 1]
                other = "".join(full[1:]) or (rest[1] if len(rest) > 1 else None)
                for g in first or [None]:
                    out.append(("p", field, name, times, None, g, second, rest[0], other, "".join(full), len(first) > 1))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=columns)

    return names.select("campo", "nombre", "veces").mapInArrow(run, _ROW)


def _full(c: str) -> Column:
    return F.coalesce(F.length(c) > 1, F.lit(False))


#: What a name may have of its second surname, given name and second given name: in full, as initial, not at all.
_FORMS = [(a, b, c) for a in "fin" for b in "fin" for c in "fin" if not (b == "n" and c != "n")]


def _form(form: tuple[str, str, str]) -> Column:
    """A name in one form; with both surnames in full these stand together."""
    part = lambda kind, c: {"f": F.coalesce(F.col(c), F.lit("")), "i": F.coalesce(F.substring(c, 1, 1), F.lit("")), "n": F.lit("")}[kind]
    surnames = F.col("apellidos") if form[0] == "f" else F.concat(F.col("s1"), F.lit("|"), part(form[0], "s2"))
    return F.concat_ws("|", surnames, part(form[1], "g1"), part(form[2], "g2"))


def _own_form() -> tuple[Column, Column]:
    """``(form, name in it)`` of what a name has."""
    kind = lambda c: F.when(F.col(c).isNull(), "n").when(F.length(c) > 1, "f").otherwise("i")
    which = F.concat(kind("s2"), kind("g1"), kind("g2"))
    own = F.lit(None).cast("string")
    for form in _FORMS:
        own = F.when(which == "".join(form), _form(form)).otherwise(own)
    return which, own


def forms_of(entities: DataFrame, rank: int) -> DataFrame:
    """``(grupo, b, entidad, rango)``: the forms in which the names of some entities may be written; one entity, one row per form."""
    each = F.array(*[F.struct(F.lit("".join(f)).alias("forma"), _form(f).alias("b")) for f in _FORMS])
    return entities.select("campo", "entidad", F.explode(each).alias("e")).select(
        F.concat_ws("|", "campo", "e.forma").alias("grupo"), F.col("e.b").alias("b"), "entidad", F.lit(rank).alias("rango")
    )


def linked(rows: DataFrame, forms: DataFrame) -> DataFrame:
    """``(campo, nombre, entidad)`` of names that are within one edit of a form of only one entity; the nearest forms of the first rank count."""
    which, own = _own_form()
    asked = rows.select("campo", "nombre", F.concat_ws("|", "campo", which).alias("grupo"), own.alias("a")).where("a is not null").distinct()
    found = segment_join(asked.select("grupo", "a").distinct(), forms.select("grupo", "b").distinct())
    near_entities = found.join(forms, ["grupo", "b"]).groupBy("grupo", "a", F.struct("d", "rango").alias("cerca")).agg(F.min("entidad").alias("una"), F.max("entidad").alias("otra"))
    # A name has few candidates: one for each distance and rank of each of its meanings.
    each = asked.join(near_entities, ["grupo", "a"]).groupBy("campo", "nombre").agg(F.collect_list(F.struct("cerca", "una", "otra")).alias("x"))
    nearest = F.filter("x", lambda e: e["cerca"] == F.array_min(F.transform("x", lambda y: y["cerca"])))
    only = each.select("campo", "nombre", F.array_min(F.transform(nearest, lambda e: e["una"])).alias("entidad"), F.array_max(F.transform(nearest, lambda e: e["otra"])).alias("otra"))
    return only.where("entidad = otra").drop("otra")


def persons(rows: DataFrame) -> DataFrame:
    """``(campo, nombre, entidad)`` of parsed persons; ``base`` is the best supported spelling of a name in full.

    Names with a given name and two surnames in full make the entities: each takes the best supported one within one edit, unless both given names are
    in use; second given names that differ in full split them, and an entity with one given name joins the only one that has it as
    second given name. Every other name joins the only entity that has a form within one edit of it. Names that fit no entity, or
    several, make entities of their own by what they have.
    """
    g = lambda c: F.substring_index(c, "|", 1)
    known = rows.where("base is not null")
    # The parts of an entity are those of the names that are spelt as its base; a torn surname is no part.
    spelt = known.where("clave = base").groupBy("campo", "base", "s1", "s2").agg(F.count("*").alias("n")).groupBy("campo", "base").agg(F.max(F.struct("n", "s1", "s2")).alias("s"))
    doubled = known.where(_full("g2")).groupBy("campo", "base").agg(F.countDistinct("g2").alias("n2"))
    known = known.join(doubled, ["campo", "base"], "left").withColumn("doble", F.coalesce("n2", F.lit(0)) > 1)
    settled = cut(known.where(~F.col("doble") | _full("g2")).withColumn("entidad", F.concat_ws("|", "base", F.when(F.col("doble"), F.col("g2")))))
    every = settled.groupBy("campo", "base", "entidad").agg(F.max(F.when(_full("g2"), F.col("g2"))).alias("g2")).join(spelt, ["campo", "base"]).select(
        "campo", "entidad", g("base").alias("g1"), "g2", F.col("s.s1").alias("s1"), F.col("s.s2").alias("s2"), F.substring_index("base", "|", -1).alias("apellidos")
    )
    every = cut(every)
    doubles, single = every.where("g2 is not null"), every.where("g2 is null")
    by_second = forms_of(doubles.withColumn("g1", F.col("g2")).withColumn("g2", F.lit(None).cast("string")), 1)
    # An entity with one given name that is the second one of another, or within an edit of its first one with no full name of its own.
    whole_forms = forms_of(doubles, 0).where("grupo like '%|ffn'")
    alone = linked(single.withColumn("nombre", F.col("entidad")), by_second.unionByName(whole_forms))
    moved = cut(alone.select("campo", F.col("nombre").alias("entidad"), F.col("entidad").alias("una")))
    out = settled.join(moved, ["campo", "entidad"], "left").select("campo", "nombre", F.coalesce("una", "entidad").alias("entidad"))
    forms = cut(forms_of(every.join(moved, ["campo", "entidad"], "left_anti"), 0).unionByName(by_second))
    partial = cut(rows.where("base is null").unionByName(known.where(F.col("doble") & ~_full("g2")).select(*rows.columns)))
    got = cut(linked(partial, forms))
    left = partial.join(got, ["campo", "nombre"], "left_anti")
    which, own = _own_form()
    group = F.concat_ws("|", "campo", which)
    halves = left.where(_full("g1")).withColumn("entidad", F.concat_ws("|", F.lit("~"), "s1", "g1"))
    half_forms = forms_of(halves.groupBy("campo", "entidad", "s1", "g1").agg(F.max("s2").alias("s2"), F.max("g2").alias("g2"), F.max("apellidos").alias("apellidos")), 0)
    third = half_forms.groupBy("grupo", "b").agg(F.min("entidad").alias("e"), F.max("entidad").alias("otra")).where("e = otra").drop("otra")
    rest = left.where(~_full("g1")).select("campo", "nombre", group.alias("grupo"), own.alias("b"), F.concat(F.lit("~"), which, own).alias("propia"))
    last = rest.join(third, ["grupo", "b"], "left").select("campo", "nombre", F.coalesce("e", "propia").alias("entidad"))
    return out.unionByName(got).unionByName(halves.select("campo", "nombre", "entidad")).unionByName(last).distinct()


def _meant(whole: DataFrame) -> DataFrame:
    """Of the meanings of a nickname, those that another full name of these surnames bears out; else the first."""
    base = ["campo", "apellidos", "g1"]
    borne = whole.where("not varios").select(*base).distinct().withColumn("hay", F.lit(1))
    several = whole.where("varios").join(borne, base, "left").withColumn("hay", F.coalesce("hay", F.lit(0)))
    best = several.groupBy("campo", "nombre").agg(F.max("hay").alias("tope"), F.min("g1").alias("primero"))
    kept = several.join(best, ["campo", "nombre"]).where(((F.col("tope") == 1) & (F.col("hay") == 1)) | ((F.col("tope") == 0) & (F.col("g1") == F.col("primero"))))
    return whole.where("not varios").unionByName(kept.select(*whole.columns))


def entities(names: DataFrame) -> DataFrame:
    """``(campo, nombre, entidad)`` of different strings; those that name no one are left out.

    ``names`` has ``campo`` and ``nombre``. Null, empty and blank names and forms of "según distribución" name no one. A name of one part
    belongs to the only person with this surname, else it is an entity of its own.
    """
    different = names.where(r"nombre rlike '\\S'").groupBy("campo", "nombre").agg(F.count("*").alias("veces"))
    rows = cut(normalised(different))
    is_whole = (F.col("clase") == "p") & _full("g1") & _full("s2")
    whole = _meant(rows.where(is_whole)).withColumn("clave", F.concat_ws("|", "g1", "apellidos")).withColumn("grupo", F.concat_ws("|", "clase", "campo"))
    places = rows.where("clase = 'o'").withColumn("clave", F.col("apellidos")).withColumn("grupo", F.concat_ws("|", "clase", "campo", "tipo"))
    named = cut(whole.unionByName(places))
    counted = named.groupBy("grupo", "clave").agg(F.countDistinct("nombre").alias("n"), F.sum("veces").alias("v"), F.max(_full("g2").cast("int")).alias("g"))
    support = counted.select("grupo", "clave", F.struct("n", "v", "g", F.length("clave").alias("l"), F.col("clave").alias("c")).alias("apoyo"))
    first = lambda c: F.substring_index(c, "|", 1)
    relatives = F.startswith("grupo", F.lit("p")) & first("a").isin(*GIVEN) & first("b").isin(*GIVEN) & (first("a") != first("b"))
    spelt = named.join(best_supported(support, ~relatives).select("grupo", F.col("a").alias("clave"), F.col("b").alias("base")), ["grupo", "clave"])
    spelt = cut(spelt.unionByName(rows.where("clase = 'p'").where(~is_whole), allowMissingColumns=True))
    offices = spelt.where("clase = 'o'").select("campo", "nombre", F.concat_ws("|", "tipo", "base").alias("entidad"))
    return offices.unionByName(persons(spelt.where("clase = 'p'")))


def typed_names(circulares: DataFrame) -> DataFrame:
    """``(campo, nombre)``: the names typed in the three fields of ``circulares``."""
    fields = [*PERSONS, *OFFICES]
    return circulares.select(F.explode(F.array(*[F.struct(F.lit(c).alias("campo"), F.col(c).alias("nombre")) for c in fields])).alias("f")).select("f.*")


def pairs(linked: DataFrame) -> DataFrame:
    """``(campo, nombre_a, nombre_b)``: all pairs of different strings of one entity, in order of code points."""
    a = linked.select("campo", "entidad", F.col("nombre").alias("nombre_a"))
    b = linked.select("campo", "entidad", F.col("nombre").alias("nombre_b"))
    return a.join(b, ["campo", "entidad"]).where("nombre_a < nombre_b").select("campo", "nombre_a", "nombre_b").distinct()
