"""Common parts of the SQL oracles."""

from __future__ import annotations

#: Blanks as both engines are told to see them.
BLANK = r"[\t\n\x0b\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
LINE_END = r"(?:\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}])"


def q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(f'^{BLANK}+|{BLANK}+$')}, '', 'g')"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, {q(BLANK + '+')}, ' ', 'g'))"


def lines(table: str = "documents", key: str = "doc_id", text: str = "text", name: str = "l") -> str:
    """CTEs ending in ``l(key, line_no, line)``."""
    return f"""{name}0 AS (SELECT {key}, regexp_split_to_array(regexp_replace({text}, {q(LINE_END + chr(92) + 'z')}, ''), {q(LINE_END)}) AS a FROM {table} WHERE coalesce({text}, '') <> ''),
{name}1 AS (SELECT {key}, unnest(range(len(a)))::INT AS line_no, unnest(a) AS raw FROM {name}0),
{name} AS (SELECT {key}, line_no, {strip('raw')} AS line FROM {name}1)"""


def upper_share(x: str) -> str:
    return f"(length(regexp_replace({x}, '\\P{{Lu}}', '', 'g'))::DOUBLE / nullif(length(regexp_replace({x}, '\\P{{L}}', '', 'g')), 0))"


def rx(x: str, pattern: str, ignore_case: bool = True) -> str:
    """A pattern test."""
    return f"regexp_matches({x}, {q(('(?i)' if ignore_case else '') + pattern)})"


def in_list(values) -> str:
    return ", ".join(q(v) for v in values)
