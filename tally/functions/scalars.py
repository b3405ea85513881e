"""Scalar column functions.  Every one is a native Catalyst expression (no UDF)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally import schemas as S

# Text date patterns accepted, in order: day-first, ISO date, ISO date-time.
DAY_FIRST = "d/M/yyyy"
ISO_DATE = "yyyy-MM-dd"
ISO_DATETIME = "yyyy-MM-dd HH:mm:ss"
OUT_DATE = "dd/MM/yyyy"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(value) -> Column:
    """A timestamp_ntz literal from a Python datetime/date, independent of any time zone."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def parse_date(c, dtype: T.DataType | None = None) -> Column:
    """Text or typed date -> timestamp_ntz at day precision for text; bad text -> null.

    Day-first is tried before ISO, so '03/01/2020' is 3 January (never a guess
    between orders).
    """
    c = _col(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("timestamp_ntz")
    if isinstance(dtype, T.DateType):
        return c.cast("timestamp_ntz")
    s = F.trim(c.cast("string"))
    return F.coalesce(
        F.try_to_date(s, DAY_FIRST),
        F.try_to_date(s, ISO_DATE),
        F.to_date(F.try_to_timestamp(s, F.lit(ISO_DATETIME))),
    ).cast("timestamp_ntz")


def format_date(c, dtype: T.DataType | None = None) -> Column:
    """'dd/MM/yyyy' text; null when missing or unparseable (formatted from the date: zone-free)."""
    return F.date_format(F.to_date(parse_date(c, dtype)), OUT_DATE)


def competence_month(c) -> Column:
    """Competence month 'yyyy-MM' of a date."""
    return F.date_format(F.to_date(_col(c)), "yyyy-MM")


def null_or_empty(c) -> Column:
    c = _col(c)
    return c.isNull() | (c.cast("string") == F.lit(""))


def missing(c, dtype: T.DataType | None = None) -> Column:
    """Null, or blank where the column is text: as a blank cell of a file reads back."""
    c = _col(c)
    return null_or_empty(c) if dtype is None or isinstance(dtype, T.StringType) else c.isNull()


def present(c, dtype: T.DataType | None = None) -> Column:
    """The value, or null where it is missing."""
    return F.when(~missing(c, dtype), _col(c))


def to_money(c, dtype: T.DataType | None = None, default=0) -> Column:
    """Numeric coercion to decimal(22,6); blank/bad -> default (null keeps null)."""
    c = _col(c)
    if isinstance(dtype, T.NumericType):
        v = c.try_cast(S.MONEY)
    else:
        v = _try_decimal(F.trim(c.cast("string")))
    if default is None:
        return v
    return F.coalesce(v, F.lit(default).cast(S.MONEY))


def _try_decimal(s: Column) -> Column:
    # try_cast keeps ANSI mode from failing the whole task on a dirty cell.
    return s.try_cast(S.MONEY)


def to_int(c, dtype: T.DataType | None = None, default=0) -> Column:
    c = _col(c)
    if isinstance(dtype, T.IntegralType):
        v = c.try_cast("int")
    else:
        v = F.trim(c.cast("string")).try_cast(S.MONEY).try_cast("int")
    return v if default is None else F.coalesce(v, F.lit(default).cast("int"))


def positive_flag(c, dtype: T.DataType | None = None) -> Column:
    """1 when the value is a number > 0, else 0."""
    v = to_money(c, dtype, default=None)
    return F.when(v > 0, F.lit(1)).otherwise(F.lit(0))


def truthy(c) -> Column:
    """1 when the text is a truthy token (case-insensitive), else 0.

    A trailing '.0' (a whole number read as float) is dropped first.
    """
    s = F.lower(_col(c).cast("string"))
    s = F.regexp_replace(s, r"^(-?\d+)\.0$", "$1")
    return F.when(s.isin(*S.TRUTHY_TOKENS), F.lit(1)).otherwise(F.lit(0))


def decode(c, mapping: Mapping, default) -> Column:
    """CASE c WHEN k THEN v ... ELSE default."""
    c = _col(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default))


def person_type(c) -> Column:
    return decode(c, S.PERSON_TYPE, S.PERSON_TYPE_OTHER)


def active_label(c) -> Column:
    return F.when(_col(c) == F.lit(True), F.lit(S.ACTIVE)).otherwise(F.lit(S.INACTIVE))


def marital_label(c) -> Column:
    return decode(c, S.MARITAL_STATUS, S.MARITAL_STATUS_OTHER)


def sex_label(c) -> Column:
    return decode(c, S.SEX, S.SEX_OTHER)


def taxpayer_flag(person_type_code) -> Column:
    return F.when(_col(person_type_code) == F.lit(2), F.lit(1)).otherwise(F.lit(0))


def balance_by_settlement(settle_date, amount) -> Column:
    """Open balance: 0 once settled, else the installment value."""
    return F.when(_col(settle_date).isNotNull(), F.lit(0).cast(S.MONEY)).otherwise(_col(amount))


def balance_by_amount(amount, paid) -> Column:
    """Open balance: installment value minus what was paid."""
    return _col(amount) - F.coalesce(_col(paid), F.lit(0).cast(S.MONEY))


def status_text(settle_date) -> Column:
    return F.when(_col(settle_date).isNull(), F.lit(S.STATUS_OPEN)).otherwise(F.lit(S.STATUS_SETTLED))


def paid_flag(settle_date) -> Column:
    return F.when(_col(settle_date).isNotNull(), F.lit(S.PAID_YES)).otherwise(F.lit(S.PAID_NO))


def digits_only(c) -> Column:
    return F.regexp_replace(_col(c).cast("string"), "[^0-9]", "")


def status_relabel(c) -> Column:
    c = _col(c)
    return F.when(F.lower(c) == F.lit("liquidado"), F.lit(S.STATUS_SETTLED_TEMPLATE)).otherwise(c)


def due_month(c, dtype: T.DataType | None = None, with_year: bool = False) -> Column:
    """Month key of a date: '1'..'12' (or 'yyyy-MM' with_year), 'sem_data' when missing."""
    d = parse_date(c, dtype)
    key = F.date_format(d, "yyyy-MM") if with_year else F.month(d).cast("string")
    return F.coalesce(key, F.lit(S.NO_DATE))


def month_label(month_key) -> Column:
    """Month key -> file-name label: 'jan'..'dez', 'sem_data', else 'mes_desconhecido'."""
    k = _col(month_key)
    expr = F.when(k == F.lit(S.NO_DATE), F.lit(S.NO_DATE))
    for num, abbrev in S.MONTH_ABBREV.items():
        expr = expr.when(k == F.lit(str(num)), F.lit(abbrev))
    return expr.otherwise(F.lit(S.UNKNOWN_MONTH))


def safe_label(c) -> Column:
    """File-name-safe label: spaces -> '_', ':' removed."""
    return F.replace(F.replace(_col(c), F.lit(" "), F.lit("_")), F.lit(":"), F.lit(""))


def part_number_text(c, width: int = 3) -> Column:
    """A part's number with at least ``width`` digits; longer numbers stay whole."""
    text = _col(c).cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))
