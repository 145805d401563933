"""Documents as ordered lines: the base relation of all extractors.

A document keeps its lines in one array, so extractors are expressions over a row and nothing is shuffled; :func:`explode_lines`
gives the relational form where lines of different documents meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo.functions.regex import LINE_END, let, rx, strip


def lines_of(text: Column) -> Column:
    """Array of the trimmed lines of a text; blank lines stay, a final line end opens no line, null and empty give no line."""
    body = F.regexp_replace(text, f"(?:{LINE_END})\\z", "")
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(body, LINE_END, -1), strip))


def with_lines(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``lines`` to documents."""
    return df.withColumn("lines", lines_of(F.col(text)))


def explode_lines(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, line_no, line)``: one row per line, numbered from 0. A text without lines gives no row."""
    rows = df.select(key, F.posexplode_outer(lines_of(F.col(text))).alias("line_no", "line"))
    return rows.where("line is not null")


def head(lines: Column, n: int) -> Column:
    """The first ``n`` lines, blank ones counted."""
    return F.slice(lines, 1, n)


def indexed(lines: Column) -> Column:
    """Lines with their index from 0."""
    return F.transform(lines, lambda l, i: F.struct(i.alias("i"), l.alias("l")))


def first_index(lines: Column, test) -> Column:
    """Index of the first line that passes a test, -1 if none does."""
    return F.coalesce(F.get(F.filter(indexed(lines), lambda x: test(x["l"])), F.lit(0))["i"], F.lit(-1))


def last_index(lines: Column, test) -> Column:
    """Index of the last line that passes a test, -1 if none does."""
    return F.coalesce(F.try_element_at(F.filter(indexed(lines), lambda x: test(x["l"])), F.lit(-1))["i"], F.lit(-1))


def capture(lines: Column, start: str, stop, keep: str = "first") -> Column:
    """Text of a block: from the line that a pattern with one group opens, over the lines that follow, up to a blank or stop line.

    With ``keep="first"`` the first block counts, with ``"last"`` the last one; pieces are joined by blanks. Empty if there is none.
    """
    zero = F.struct(F.lit(False).alias("on"), F.lit("").alias("t"))
    opened = lambda l: F.regexp_extract(l, start, 1)

    def step(s: Column, l: Column) -> Column:
        begins = l.rlike(start) & (F.lit(True) if keep == "last" else s["t"] == "")
        goes_on = s["on"] & (l != "") & ~stop(l)
        return F.struct(
            (goes_on | (~s["on"] & begins)).alias("on"),
            F.when(goes_on, F.concat(s["t"], F.lit(" "), l)).when(~s["on"] & begins, strip(opened(l))).otherwise(s["t"]).alias("t"),
        )

    return F.aggregate(lines, zero, step, lambda s: s["t"])


def paragraphs(lines: Column, opener: str) -> Column:
    """Array of paragraphs: a line that matches ``opener`` begins one, other non-blank lines are appended with a blank."""

    def step(acc: Column, l: Column) -> Column:
        new = (F.size(acc) == 0) | l.rlike(opener)
        grown = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.concat(F.element_at(acc, -1), F.lit(" "), l)))
        return F.when(l == "", acc).when(new, F.concat(acc, F.array(l))).otherwise(grown)

    return F.aggregate(lines, F.array().cast("array<string>"), step)


__all__ = ["capture", "explode_lines", "first_index", "head", "indexed", "last_index", "let", "lines_of", "paragraphs", "rx", "with_lines"]
