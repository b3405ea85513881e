"""Template conformance (P-13, P-14, P-19, P-24) and export formatting.

Both are a single ``select``: one projection per template column, so the
whole step is a narrow, codegen'd map over the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally import schemas as S
from tally.functions import scalars as fx


def resolve(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """P-24: the first spelling of a label present in ``df`` (or None)."""
    for c in candidates:
        if c in df.columns:
            return c
    return None


def date_columns(columns: Sequence[str], words: Sequence[str] = S.DATE_COLUMN_WORDS) -> list[str]:
    """P-14: columns whose lower-cased label contains one of ``words``."""
    return [c for c in columns if any(w in c.lower() for w in words)]


def _dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def _default(kind: str) -> Column:
    if kind == "money":
        return F.lit(0).cast(S.MONEY)
    if kind in ("int", "flag"):
        return F.lit(0)
    return F.lit("")


def format_value(c: Column, kind: str, dtype: T.DataType | None) -> Column:
    """Per-kind cell formatting; null or empty text gives the kind's default (P-15..P-21)."""
    if kind == "money":
        return fx.to_money(c, dtype, default=0)
    if kind == "int":
        return fx.to_int(c, dtype, default=0)
    if kind == "flag":
        return fx.positive_flag(c, dtype)
    if kind == "date":
        return F.coalesce(fx.format_date(c, dtype), F.lit(""))
    text = c.cast("string")
    blank = text.isNull() | (text == F.lit(""))
    if kind == "status":
        return F.when(blank, F.lit("")).otherwise(fx.status_relabel(text))
    if kind == "taxid":
        return F.when(blank, F.lit("")).otherwise(fx.digits_only(text))
    return F.when(blank, F.lit("")).otherwise(text)


def conform(df: DataFrame, template: S.Template, renames: Mapping[str, str] | None = None,
            keep: Sequence[str] = ()) -> DataFrame:
    """P-13: add missing template columns with typed defaults, order them, drop the rest.

    ``renames`` maps a source label to the template label it feeds (payables
    export labels differ from the template's).  ``keep`` lists extra columns to
    carry after the template columns (e.g. helper keys).
    """
    sources = {}
    for src, dst in (renames or {}).items():
        if src in df.columns:
            sources.setdefault(dst, src)
    cols = []
    for label in template.columns:
        kind = template.kind(label)
        src = label if label in df.columns else sources.get(label)
        if src is None:
            cols.append(_default(kind).alias(label))
        else:
            cols.append(format_value(F.col(f"`{src}`"), kind, _dtype(df, src)).alias(label))
    cols += [F.col(f"`{k}`") for k in keep if k not in template.columns]
    return df.select(*cols)


NUMERIC_EXPORT_LABELS = {"Valor documento", "Saldo", "Taxas", "Estabelecimento_id", "Contribuinte",
                         "Limite de crédito", "Numero no banco"}


def export_format(df: DataFrame, columns: Sequence[str], dataset: str) -> DataFrame:
    """Spreadsheet export step: complete/ordered columns, dates as 'dd/MM/yyyy'.

    Missing columns get a typed default (0 for numeric labels, '' else).
    Contacts: Contribuinte is normalised from truthy tokens and forced to 1 for
    legal persons.
    """
    dates = set(date_columns(columns))
    cols = []
    for label in columns:
        if label in df.columns:
            c = F.col(f"`{label}`")
            if label in dates:
                c = fx.format_date(c, _dtype(df, label))
        else:
            c = F.lit(0) if label in NUMERIC_EXPORT_LABELS else F.lit("")
        cols.append(c.alias(label))
    out = df.select(*cols)
    if dataset == "contatos" and "Contribuinte" in columns:
        flag = fx.truthy(F.col("Contribuinte"))
        if "Tipo pessoa" in columns:
            flag = F.when(F.col("`Tipo pessoa`") == F.lit(S.LEGAL_PERSON), F.lit(1)).otherwise(flag)
        out = out.withColumn("Contribuinte", flag)
    return out
