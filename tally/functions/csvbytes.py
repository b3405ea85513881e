"""Exact CSV byte sizes, computed as column expressions before anything is written.

The sinks write with: header, UTF-8, BOM on the header, '"' as quote and escape,
empty strings as nothing, whitespace kept.  Under those options a field is
quoted when it contains a comma, a quote, CR or LF, or -- first field of a line
only, where it would read as a comment -- starts with '#'; quotes inside are
doubled.  A row is its fields joined by ',' plus '\\n'.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally import schemas as S

CSV_WRITE_OPTIONS = {
    "header": "true",
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "lineSep": "\n",
}


# The same for lines made one at a time (`to_csv` writes neither header nor line end).
CSV_LINE_OPTIONS = {k: v for k, v in CSV_WRITE_OPTIONS.items() if k not in ("header", "encoding", "lineSep")}


def field_text(c: Column, dtype: T.DataType) -> Column:
    """The text the CSV writer emits for a value (templates hold text and numbers)."""
    if isinstance(dtype, T.StringType):
        return c
    return c.cast("string")


def field_bytes(c: Column, dtype: T.DataType, first: bool = False) -> Column:
    s = field_text(c, dtype)
    n = F.octet_length(s)
    # a comma, quote, CR or LF anywhere (plain substring tests, generated code)
    needs_quote = s.contains(",") | s.contains('"') | s.contains("\r") | s.contains("\n")
    if first:
        needs_quote = needs_quote | s.startswith("#")
    quotes = F.length(s) - F.length(F.replace(s, F.lit('"'), F.lit("")))
    b = F.when(needs_quote, n + 2 + quotes).otherwise(n)
    return F.coalesce(b, F.lit(0)).cast("long")


def row_bytes(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Bytes of one CSV data line (fields, separators and the newline)."""
    cols = columns or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    total = F.lit(len(cols)).cast("long")  # (n-1) commas + 1 newline
    for i, name in enumerate(cols):
        total = total + field_bytes(F.col(f"`{name}`"), types[name], first=(i == 0))
    return total


def _text_field_bytes(text: str, first: bool = False) -> int:
    b = len(text.encode("utf-8"))
    if any(ch in text for ch in ',"\r\n') or (first and text.startswith("#")):
        b += 2 + text.count('"')
    return b


def header_line(columns: list[str], bom: bool = True) -> str:
    """The header as the sinks write it, with its line end."""
    def quoted(i: int, c: str) -> str:
        return '"' + c.replace('"', '""') + '"' if any(ch in c for ch in ',"\r\n') or (i == 0 and not bom and c.startswith("#")) else c

    return (S.CSV_BOM if bom else "") + ",".join(quoted(i, c) for i, c in enumerate(columns)) + "\n"


def header_bytes(columns: list[str], bom: bool = True) -> int:
    """Bytes of the header line, plus the 3-byte BOM when written with one."""
    line = sum(_text_field_bytes(c, i == 0 and not bom) for i, c in enumerate(columns)) + len(columns)
    return line + (S.BOM_BYTES if bom else 0)
