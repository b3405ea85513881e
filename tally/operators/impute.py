"""Missing-value imputation (I1-I11), all as column expressions with an explicit as_of."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally import schemas as S
from tally.functions import scalars as fx
from tally.operators.conform import resolve


def _col(n: str) -> Column:
    return F.col(f"`{n}`")


def _fill(df: DataFrame, label: str, value: Column) -> Column:
    """The column with ``value`` where it is missing (null, or blank text)."""
    return F.coalesce(fx.present(_col(label), df.schema[label].dataType), value)


def _fill_date(df: DataFrame, label: str, fallback: Column) -> tuple[Column, Column]:
    """(output column, parsed value) for a date filled with ``fallback`` (a timestamp)."""
    dtype = df.schema[label].dataType
    parsed = F.coalesce(fx.parse_date(_col(label), dtype), fallback)
    if isinstance(dtype, T.StringType):
        return F.date_format(parsed, fx.OUT_DATE), parsed
    return parsed.cast(dtype), parsed


def _id_text(df: DataFrame) -> Column:
    idc = resolve(df, S.VARIANTS["id"])
    return F.coalesce(_col(idc).cast("string"), F.lit("")) if idc else F.lit("")


def impute(df: DataFrame, dataset: str, as_of: dt.datetime) -> DataFrame:
    """Fill gaps with the dataset's defaults; other columns pass through."""
    now = fx.ts_literal(as_of)
    repl: dict[str, Column] = {}
    ident = _id_text(df)

    if dataset == "contatos":
        if "Data nascimento" in df.columns:
            repl["Data nascimento"] = _fill_date(df, "Data nascimento", now)[0]
        taxid = resolve(df, S.VARIANTS["taxid"])
        if taxid:
            ptype = resolve(df, S.VARIANTS["person_type"])
            zeros = F.lit(S.TAXID_DEFAULT_NATURAL)
            if ptype:
                zeros = F.when(_col(ptype) == F.lit(S.LEGAL_PERSON), F.lit(S.TAXID_DEFAULT_LEGAL)).otherwise(zeros)
            repl[taxid] = F.coalesce(fx.present(_col(taxid).cast("string")), zeros)
        if "Nome" in df.columns:
            repl["Nome"] = _fill(df, "Nome", F.concat(F.lit(S.NAME_DEFAULT_PREFIX), ident))
        for label in S.CONTACT_TEXT_IMPUTE_COLUMNS:
            if label in df.columns:
                repl[label] = _fill(df, label, F.lit(S.TEXT_DEFAULT))
        if "Estado" in df.columns:
            repl["Estado"] = _fill(df, "Estado", F.lit(S.STATE_DEFAULT))
        if "E-mail" in df.columns:
            repl["E-mail"] = _fill(
                df, "E-mail", F.concat(F.lit(S.EMAIL_DEFAULT_PREFIX), ident, F.lit(S.EMAIL_DEFAULT_SUFFIX)))
    else:
        issue = resolve(df, S.VARIANTS["issue_date"])
        issue_value = now
        if issue:
            repl[issue], issue_value = _fill_date(df, issue, now)
        due = resolve(df, S.VARIANTS["due_date"])
        if due:
            repl[due] = _fill_date(df, due, issue_value)[0]
        party = resolve(df, S.VARIANTS["party"])
        if party:
            repl[party] = _fill(df, party, F.concat(F.lit(S.NAME_DEFAULT_PREFIX), ident))
        amount = resolve(df, S.VARIANTS["amount"])
        if amount:
            dtype = df.schema[amount].dataType
            default = F.lit(S.AMOUNT_DEFAULT).cast(dtype if isinstance(dtype, T.NumericType) else S.MONEY)
            repl[amount] = _fill(df, amount, default.cast(dtype))
        status = resolve(df, S.VARIANTS["status"])
        if status:
            repl[status] = _fill(df, status, F.lit(S.STATUS_OPEN))

    return df.select(*[(repl[c].alias(c) if c in repl else _col(c)) for c in df.columns])
