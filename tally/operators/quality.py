"""Data-quality rules (D1-D7), null counts (A2), error summary (A10), samples.

``audit`` evaluates every rule in one pass: each row builds the array of rules
it breaks and is exploded into the long violations table, instead of one scan
(and one report file) per rule.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally import schemas as S
from tally.functions import scalars as fx
from tally.operators.conform import resolve

CATEGORY = {
    S.RULE_NULL: "nulos",
    S.RULE_FUTURE_DATE: "datas_futuro",
    S.RULE_OLD_DATE: "datas_antigas",
    S.RULE_DUE_BEFORE_ISSUE: "inconsistencias",
    S.RULE_SETTLED_BEFORE_ISSUE: "inconsistencias",
    S.RULE_BAD_AMOUNT: "inconsistencias",
    S.RULE_BAD_TAXID: "inconsistencias",
}

ACCOUNTS = ("contas_pagar", "contas_receber")


def shift_years(ts: dt.datetime, years: int) -> dt.datetime:
    """Calendar shift by whole years; 29 Feb falls back to 28 Feb."""
    try:
        return ts.replace(year=ts.year + years)
    except ValueError:
        return ts.replace(year=ts.year + years, day=28)


def outlier_limits(as_of: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    """(future limit, past limit): as_of + 10 years and as_of - 20 years."""
    return shift_years(as_of, S.FUTURE_YEARS), shift_years(as_of, -S.PAST_YEARS)


def split_date_column(df: DataFrame, dataset: str) -> str | None:
    """The date column a dataset is split (and outlier-checked) by."""
    if dataset in ACCOUNTS:
        return resolve(df, S.VARIANTS["issue_date"])
    cands = [c for c in df.columns if "data" in c.lower()]
    return cands[0] if cands else None


def rules(df: DataFrame, dataset: str, as_of: dt.datetime | None = None,
          date_col: str | None = None, important: Sequence[str] | None = None,
          only: Sequence[str] | None = None) -> list[tuple[str, str, Column]]:
    """(rule, column label, predicate) triples for a dataset; with ``only``, of these rules.

    Rules left out here ask for no column, so their inputs are not scanned.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    col = lambda n: F.col(f"`{n}`")
    out: list[tuple[str, str, Column]] = []

    wanted = list(important) if important is not None else S.IMPORTANT_COLUMNS.get(dataset, [])
    for label in wanted:
        present = label if label in df.columns else None
        if present is None and label in S.VARIANTS["taxid"]:
            present = resolve(df, S.VARIANTS["taxid"])
        if present is not None:
            out.append((S.RULE_NULL, label, fx.missing(col(present), types[present])))

    if dataset in ACCOUNTS:
        issue = resolve(df, S.VARIANTS["issue_date"])
        due = resolve(df, S.VARIANTS["due_date"])
        settle = resolve(df, S.VARIANTS["settle_date"])
        if issue:
            di = fx.parse_date(col(issue), types[issue])
            if due:
                dd = fx.parse_date(col(due), types[due])
                out.append((S.RULE_DUE_BEFORE_ISSUE, due, di.isNotNull() & dd.isNotNull() & (dd < di)))
            if settle:
                ds = fx.parse_date(col(settle), types[settle])
                out.append((S.RULE_SETTLED_BEFORE_ISSUE, settle, di.isNotNull() & ds.isNotNull() & (ds < di)))
        amount = resolve(df, S.VARIANTS["amount"])
        if amount:
            out.append((S.RULE_BAD_AMOUNT, amount, fx.to_money(col(amount), types[amount], default=None) <= 0))
    elif dataset == "contatos":
        taxid = resolve(df, S.VARIANTS["taxid"])
        if taxid:
            n = F.length(fx.digits_only(col(taxid)))
            out.append((S.RULE_BAD_TAXID, taxid, ~n.isin(*S.VALID_TAXID_LENGTHS) & (n > 0)))

    date_col = date_col or split_date_column(df, dataset)
    if as_of is not None and date_col:
        future, past = outlier_limits(as_of)
        d = fx.parse_date(col(date_col), types[date_col])
        out.append((S.RULE_FUTURE_DATE, date_col, d > fx.ts_literal(future)))
        out.append((S.RULE_OLD_DATE, date_col, d < fx.ts_literal(past)))
    return [r for r in out if only is None or r[0] in only]


def audit(df: DataFrame, dataset: str, as_of: dt.datetime | None = None, id_col: str | None = None,
          date_col: str | None = None, important: Sequence[str] | None = None,
          with_record: bool = False, only: Sequence[str] | None = None) -> DataFrame:
    """Long violations table (dataset, rule, category, coluna, record_id[, record]).

    One row per (row, broken rule); ``record`` holds the offending row as JSON.
    """
    id_col = id_col or resolve(df, S.VARIANTS["id"])
    checks = rules(df, dataset, as_of, date_col, important, only)
    if not checks:
        return df.sparkSession.createDataFrame(
            [], "dataset string, rule string, category string, coluna string, record_id string"
                + (", record string" if with_record else ""))
    # Clean rows are dropped by one OR of the predicates (generated code); only rows that
    # break a rule are exploded into one row per broken rule.
    any_hit = F.lit(False)
    for _, _, pred in checks:
        any_hit = any_hit | F.coalesce(pred, F.lit(False))
    hits = F.array(*[
        F.when(pred, F.struct(F.lit(rule).alias("rule"), F.lit(CATEGORY[rule]).alias("category"),
                              F.lit(label).alias("coluna")))
        for rule, label, pred in checks
    ])
    rid = F.col(f"`{id_col}`").cast("string") if id_col else F.lit(None).cast("string")
    cols = [rid.alias("record_id"), F.explode(hits).alias("_h")]
    if with_record:
        cols.append(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("record"))
    v = df.where(any_hit).select(*cols).where(F.col("_h").isNotNull())
    out = [F.lit(dataset).alias("dataset"), F.col("_h.rule").alias("rule"),
           F.col("_h.category").alias("category"), F.col("_h.coluna").alias("coluna"), "record_id"]
    if with_record:
        out.append("record")
    return v.select(*out)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A2: count of missing values per column in one aggregation pass, long form (coluna, nulls)."""
    columns = list(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    agg = df.agg(*[F.count_if(fx.missing(F.col(f"`{c}`"), types[c])).alias(f"c{i}") for i, c in enumerate(columns)])
    stack = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', c{i}" for i, c in enumerate(columns))
    return agg.selectExpr(f"stack({len(columns)}, {stack}) AS (coluna, nulls)")


def error_summary(violations: DataFrame, datasets: Sequence[str]) -> DataFrame:
    """A10: violations per dataset and category, categories as columns (fixed list, no extra job).

    Every one of ``datasets`` has a row; without violations its counts are 0.
    """
    spark = violations.sparkSession
    listed = spark.createDataFrame([(d,) for d in datasets], "dataset string")
    p = violations.groupBy("dataset").pivot("category", S.SUMMARY_CATEGORIES).count()
    return F.broadcast(listed).join(p, "dataset", "left").select(
        "dataset", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in S.SUMMARY_CATEGORIES])


def sample_violations(violations: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` violations per (dataset, rule, column) by record id.

    Spark plans this as a WindowGroupLimit, which trims each group to ``n``
    rows before the shuffle, so a rule with a billion hits moves n rows per task.
    """
    order = [F.col("record_id").try_cast("long").asc_nulls_last(), F.col("record_id").asc_nulls_last()]
    w = Window.partitionBy("dataset", "rule", "coluna").orderBy(*order)
    return violations.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
