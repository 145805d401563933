"""Manifests: lists of attribute records as flat text ``k: v; k: v || k: v``, and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from acervo.functions.regex import strip

MAPS = "array<map<string,string>>"


def format_structs(items: Column, fields: list[str], lists: tuple[str, ...] = ()) -> Column:
    """Flat text of an array of structs; the fields in the given order, values of ``lists`` joined by ``, ``. Null and empty give empty text."""
    value = lambda m, f: F.array_join(m[f].cast("array<string>"), ", ") if f in lists else F.coalesce(m[f].cast("string"), F.lit(""))
    one = lambda m: F.array_join(F.array(*[F.concat(F.lit(f"{f}: "), value(m, f)) for f in fields]), "; ")
    return F.coalesce(F.array_join(F.transform(items, one), " || "), F.lit(""))


def format_maps(items: Column) -> Column:
    """Flat text of an array of maps, keys in their order."""
    one = lambda m: F.array_join(F.transform(F.map_entries(m), lambda e: F.concat_ws(": ", e["key"], F.coalesce(e["value"], F.lit("")))), "; ")
    return F.coalesce(F.array_join(F.transform(items, one), " || "), F.lit(""))


def parse(flat: Column) -> Column:
    """Array of maps of a flat manifest; parts without a colon are left out, later colons belong to the value, empty blocks give nothing."""

    def block(b: Column) -> Column:
        parts = F.filter(F.split(b, "; ", -1), lambda p: p.contains(":"))
        pairs = F.transform(parts, lambda p: F.struct(strip(F.regexp_extract(p, r"(?s)^([^:]*):", 1)).alias("k"), strip(F.regexp_replace(p, r"(?s)^[^:]*:", "")).alias("v")))
        once = F.filter(F.transform(pairs, lambda p, i: F.when(F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda q: q["k"] == p["k"]), None).otherwise(p)), lambda p: p.isNotNull())
        return F.map_from_entries(once)

    text = strip(F.coalesce(flat, F.lit("")))
    return F.when(text == "", F.array().cast(MAPS)).otherwise(F.filter(F.transform(F.split(text, r" \|\| ", -1), block), lambda m: F.size(m) > 0))


def from_json_or_text(text: Column) -> Column:
    """Flat manifest of a JSON list or object of records; other text passes as it is, as does invalid JSON."""
    s = F.coalesce(text, F.lit(""))
    as_list = F.from_json(F.when(strip(s).startswith("{"), F.concat(F.lit("["), s, F.lit("]"))).otherwise(s), MAPS, {"mode": "PERMISSIVE"})
    clean = lambda v: F.regexp_replace(F.regexp_replace(v, r'^\[|\]$|"', ""), r",\s*", ", ")
    lists = F.transform(as_list, lambda m: F.transform_values(m, lambda _, v: F.when(v.startswith("["), clean(v)).otherwise(v)))
    return F.when(s.rlike(r"^\s*[\[{]") & as_list.isNotNull() & ~F.exists(F.coalesce(as_list, F.array().cast(MAPS)), lambda m: m.isNull()), format_maps(lists)).otherwise(s)
