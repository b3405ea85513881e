"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables through the ledger view, so its work grows
with the data.  Outputs use ASCII snake_case names and doubles for money so the
DuckDB oracle can be compared value for value.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally import schemas as S
from tally.functions import csvbytes as cb
from tally.functions import scalars as fx
from tally.operators import buckets as bk
from tally.operators import constraints as cn
from tally.operators import parts as pt
from tally.operators import quality as qa
from tally.operators import verify as vf
from tally.operators.impute import impute
from tally.plans import pipelines as pl
from tally.plans import views
from tally.sources.ledger_view import Ledger, from_driver_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def oracle_frame(df: DataFrame) -> DataFrame:
    """snake_case names, decimals as double, timestamps as ISO text (the comparison form)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampNTZType):
            c = c.cast("string")          # zone-free text (no DST gap can move it)
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(S.snake(f.name)))
    return df.select(*cols)


_LEDGERS: dict = {}


def ledger(spark: SparkSession, sf_dir: str) -> Ledger:
    """The ledger view for a folder; plan objects are immutable, so one per session and folder is reused."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LEDGERS:
        _LEDGERS[key] = from_driver_tables(spark, sf_dir)
    return _LEDGERS[key]


# --- W1-W4, J6 ---------------------------------------------------------------

@register("payables")
def q_payables(spark, sf_dir):
    return oracle_frame(views.payables(ledger(spark, sf_dir)))


@register("receivables")
def q_receivables(spark, sf_dir):
    return oracle_frame(views.receivables(ledger(spark, sf_dir)))


@register("contacts")
def q_contacts(spark, sf_dir):
    return oracle_frame(views.contacts(ledger(spark, sf_dir)))


@register("payables_simple")
def q_payables_simple(spark, sf_dir):
    return oracle_frame(views.payables_simple(ledger(spark, sf_dir)))


@register("receivables_simple")
def q_receivables_simple(spark, sf_dir):
    return oracle_frame(views.receivables_simple(ledger(spark, sf_dir)))


@register("contacts_simple")
def q_contacts_simple(spark, sf_dir):
    return oracle_frame(views.contacts_simple(ledger(spark, sf_dir)))


@register("default_contact_top1")
def q_default_contact(spark, sf_dir):
    t = ledger(spark, sf_dir)
    return views.default_contact(t.CONTATO).select(F.col("PESSOA_ID").alias("pessoa_id"),
                                                   F.col("Fone").alias("fone"))


# --- shared inputs ---------------------------------------------------------------

AS_OF = _dt.datetime(2001, 1, 1)
SMALL_LIMIT = 16000  # a split limit small enough to give several parts per group on the test scales
MEASURED_LIMIT = 4000  # bytes of a compressed file
TINY_LIMIT = 1000    # a few rows per part: first-round slices overflow and get halved


def _snake_select(df: DataFrame, cols) -> DataFrame:
    return oracle_frame(df.select(*[F.col(f"`{c}`") for c in cols]))


# --- P-3..P-21: scalar functions over derived columns ------------------------------

@register("status_paid_flags")
def q_status_paid_flags(spark, sf_dir):
    i = ledger(spark, sf_dir).DOC_FINANCEIRO_PARCELA
    q, v, paid = F.col("DT_DFINP_QUIT"), F.col("VL_DFINP_PARC"), F.col("VL_DFINP_QUIT")
    return i.select(F.col("DOC_FINANCEIRO_PARCELA_ID").alias("id"),
                    fx.balance_by_settlement(q, v).cast("double").alias("saldo_por_liquidacao"),
                    fx.balance_by_amount(v, paid).cast("double").alias("saldo_por_valor"),
                    fx.status_text(q).alias("situacao"), fx.paid_flag(q).alias("pago"))


@register("competence_month")
def q_competence_month(spark, sf_dir):
    d = ledger(spark, sf_dir).DOC_FINANCEIRO
    return d.select(F.col("DOC_FINANCEIRO_ID").alias("id"),
                    fx.competence_month(F.col("DT_DFIN_EMISS")).alias("competencia"))


@register("decode_person")
def q_decode_person(spark, sf_dir):
    p = ledger(spark, sf_dir).PESSOA
    return p.select(F.col("PESSOA_ID").alias("id"), fx.person_type("NO_PESS_TIPO").alias("tipo_pessoa"),
                    fx.active_label("ID_PESS_ATIVA").alias("situacao"),
                    fx.marital_label("NO_PESS_EST_CIVIL").alias("estado_civil"),
                    fx.sex_label("NO_PESS_SEXO").alias("sexo"),
                    fx.taxpayer_flag("NO_PESS_TIPO").alias("contribuinte"))


TOKEN_CHOICES = ["1", "sim", "yes", "true", "verdadeiro", "y", "s", "t", "v", "0", "não", "1.0", "talvez"]


def _token(c):
    expr = None
    for i, tok in enumerate(TOKEN_CHOICES):
        expr = F.when(c % 14 == i, F.lit(tok)) if expr is None else expr.when(c % 14 == i, F.lit(tok))
    tok = expr  # 13 -> null
    return F.when(c % 4 == 1, F.upper(tok)).otherwise(tok)


@register("truthy_tokens")
def q_truthy_tokens(spark, sf_dir):
    p = ledger(spark, sf_dir).PESSOA
    c = F.col("PESSOA_ID")
    x = p.select(c.alias("id"), _token(c).alias("token"), fx.person_type("NO_PESS_TIPO").alias("tipo_pessoa"))
    flag = fx.truthy(F.col("token"))
    return x.select("id", "token", flag.alias("flag"),
                    F.when(F.col("tipo_pessoa") == S.LEGAL_PERSON, F.lit(1)).otherwise(flag).alias("contribuinte"))


def _amount_text(i):
    ln = F.col("CD_DFINP_IDT")
    return (F.when(ln == 1, F.col("VL_DFINP_PARC").cast("decimal(22,2)").cast("string"))
             .when(ln == 2, F.lit(""))
             .when(ln == 3, F.lit("abc"))
             .when(ln == 4, F.concat(F.lit(" "), F.col("VL_DMOVI_TXCOBR").cast("decimal(22,2)").cast("string"),
                                     F.lit(" ")))
             .when(ln == 5, F.lit(None).cast("string"))
             .when(ln == 6, F.lit("-1"))
             .otherwise(F.lit("0")))


@register("numeric_coerce")
def q_numeric_coerce(spark, sf_dir):
    i = ledger(spark, sf_dir).DOC_FINANCEIRO_PARCELA
    x = i.select(F.col("DOC_FINANCEIRO_PARCELA_ID").alias("id"), _amount_text(i).alias("texto"))
    return x.select("id", "texto", fx.to_money(F.col("texto")).cast("double").alias("valor"))


@register("positive_flag")
def q_positive_flag(spark, sf_dir):
    i = ledger(spark, sf_dir).DOC_FINANCEIRO_PARCELA
    x = i.select(F.col("DOC_FINANCEIRO_PARCELA_ID").alias("id"), _amount_text(i).alias("texto"))
    return x.select("id", "texto", fx.positive_flag(F.col("texto")).alias("positivo"))


def _date_text():
    ln, d = F.col("CD_DFINP_IDT"), F.col("DT_DFINP_VENC")
    return (F.when(ln == 1, F.date_format(d, "dd/MM/yyyy"))
             .when(ln == 2, F.date_format(d, "yyyy-MM-dd"))
             .when(ln == 3, F.concat(F.lit("31/02/"), F.year(d).cast("string")))
             .when(ln == 4, F.lit(""))
             .when(ln == 5, F.lit(None).cast("string"))
             .when(ln == 6, F.lit("abc"))
             .when(ln == 7, d.cast("string"))
             .otherwise(F.date_format(d, "d/M/yyyy")))


@register("date_coerce_format")
def q_date_coerce_format(spark, sf_dir):
    i = ledger(spark, sf_dir).DOC_FINANCEIRO_PARCELA
    x = i.select(F.col("DOC_FINANCEIRO_PARCELA_ID").alias("id"), F.col("CD_DFINP_IDT").alias("linha"),
                 _date_text().alias("texto"))
    return x.select("id", "linha", "texto", F.coalesce(fx.format_date(F.col("texto")), F.lit("")).alias("data"))


@register("digits_only")
def q_digits_only(spark, sf_dir):
    p = ledger(spark, sf_dir).PESSOA
    return p.select(F.col("PESSOA_ID").alias("id"), F.col("NO_PESS_CNPJ_CPF").alias("cnpj_cpf"),
                    fx.digits_only("NO_PESS_CNPJ_CPF").alias("digitos"))


@register("status_relabel")
def q_status_relabel(spark, sf_dir):
    i = ledger(spark, sf_dir).DOC_FINANCEIRO_PARCELA
    ln = F.col("CD_DFINP_IDT")
    text = (F.when(ln % 4 == 0, F.lit("Liquidado")).when(ln % 4 == 1, F.lit("LIQUIDADO"))
             .when(ln % 4 == 2, F.lit("liquidado ")).otherwise(fx.status_text(F.col("DT_DFINP_QUIT"))))
    x = i.select(F.col("DOC_FINANCEIRO_PARCELA_ID").alias("id"), text.alias("texto"))
    return x.select("id", "texto", fx.status_relabel(F.col("texto")).alias("situacao"))


# --- P-13, P-19, P-24, I1-I11: templates and imputation -------------------------------

@register("conform_payables")
def q_conform_payables(spark, sf_dir):
    return oracle_frame(pl.template_rows(ledger(spark, sf_dir), "contas_pagar", AS_OF))


@register("conform_receivables")
def q_conform_receivables(spark, sf_dir):
    return oracle_frame(pl.template_rows(ledger(spark, sf_dir), "contas_receber", AS_OF))


@register("conform_contacts")
def q_conform_contacts(spark, sf_dir):
    return oracle_frame(pl.template_rows(ledger(spark, sf_dir), "contatos", AS_OF))


@register("impute_accounts")
def q_impute_accounts(spark, sf_dir):
    df = impute(pl.export(ledger(spark, sf_dir), "contas_pagar"), "contas_pagar", AS_OF)
    return oracle_frame(df)


@register("impute_contacts")
def q_impute_contacts(spark, sf_dir):
    df = impute(pl.export(ledger(spark, sf_dir), "contatos"), "contatos", AS_OF)
    return _snake_select(df, ["ID", "Nome", "CNPJ / CPF", "Endereço", "Bairro", "Cidade", "Estado", "Situação",
                              "E-mail", "Data nascimento", "Tipo pessoa"])


def _blanked(df: DataFrame, blanks: dict) -> DataFrame:
    """Blank cells where ID % m = r for each column -> (m, r); as an empty cell in a hand-made sheet."""
    return df.withColumns({c: F.when(F.col("ID") % m == r, F.lit("")).otherwise(F.col(f"`{c}`"))
                           for c, (m, r) in blanks.items()})


def _blanked_contacts(spark, sf_dir):
    return _blanked(pl.export(ledger(spark, sf_dir), "contatos"), {
        "Nome": (5, 1), "Endereço": (6, 1), "Bairro": (7, 2), "Cidade": (8, 3), "Estado": (9, 4), "E-mail": (10, 5),
        "Situação": (11, 6)})


@register("impute_blank_accounts")
def q_impute_blank_accounts(spark, sf_dir):
    df = _blanked(pl.export(ledger(spark, sf_dir), "contas_pagar"),
                  {"Situação": (29, 1), "Fornecedor": (31, 1), "Data emissao": (37, 1)})
    df = df.withColumn("Situação", F.when(F.col("ID") % 29 != 2, F.col("Situação")))
    return oracle_frame(impute(df, "contas_pagar", AS_OF))


@register("impute_blank_contacts")
def q_impute_blank_contacts(spark, sf_dir):
    return _snake_select(impute(_blanked_contacts(spark, sf_dir), "contatos", AS_OF), [
        "ID", "Nome", "CNPJ / CPF", "Endereço", "Bairro", "Cidade", "Estado", "Situação", "E-mail", "Data nascimento"])


@register("null_audit_blank")
def q_null_audit_blank(spark, sf_dir):
    return qa.audit(_blanked_contacts(spark, sf_dir), "contatos", only=[S.RULE_NULL]).select("coluna", "record_id")


# --- D1-D7, A2, A3, A10, R3: audit ------------------------------------------------------

VIOLATION_COLS = ["dataset", "rule", "coluna", "record_id"]


def _violations(spark, sf_dir):
    return pl.audit_all(ledger(spark, sf_dir), AS_OF)


def _rule_query(rule, datasets=None):
    def q(spark, sf_dir):
        return pl.audit_all(ledger(spark, sf_dir), AS_OF, only=[rule], datasets=datasets).select(*VIOLATION_COLS)
    return q


register("null_audit")(_rule_query(S.RULE_NULL))
register("due_before_issue")(_rule_query(S.RULE_DUE_BEFORE_ISSUE, qa.ACCOUNTS))
register("settled_before_issue")(_rule_query(S.RULE_SETTLED_BEFORE_ISSUE, qa.ACCOUNTS))
register("nonpositive_amount")(_rule_query(S.RULE_BAD_AMOUNT, qa.ACCOUNTS))
register("bad_taxid")(_rule_query(S.RULE_BAD_TAXID, ["contatos"]))
register("future_dates")(_rule_query(S.RULE_FUTURE_DATE))
register("old_dates")(_rule_query(S.RULE_OLD_DATE))


@register("violations_sample5")
def q_violations_sample5(spark, sf_dir):
    return qa.sample_violations(_violations(spark, sf_dir), 5).select(*VIOLATION_COLS, "rn")


@register("error_summary")
def q_error_summary(spark, sf_dir):
    return qa.error_summary(_violations(spark, sf_dir), list(pl.DATASETS))


@register("null_counts")
def q_null_counts(spark, sf_dir):
    return qa.null_counts(pl.export(ledger(spark, sf_dir), "contas_pagar"))


@register("date_range")
def q_date_range(spark, sf_dir):
    t = ledger(spark, sf_dir)
    frames = []
    for ds in pl.DATASETS:
        df = pl.export(t, ds)
        col = qa.split_date_column(df, ds)
        d = fx.parse_date(F.col(f"`{col}`"))
        frames.append(df.agg(F.date_format(F.min(d), "yyyy-MM-dd").alias("min_date"),
                             F.date_format(F.max(d), "yyyy-MM-dd").alias("max_date"))
                      .select(F.lit(ds).alias("dataset"), "min_date", "max_date"))
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


# --- T1-T6: buckets --------------------------------------------------------------------

def _bucket_input(spark, sf_dir):
    rows = pl.template_rows(ledger(spark, sf_dir), "contas_pagar", AS_OF)
    cols = list(S.PAYABLES_TEMPLATE.columns)
    x = pl.with_row_bytes(rows, cols).withColumn("_d", fx.parse_date(F.col("`Data Emissao`")))
    daily = bk.daily_sizes(x, F.col("_d"), "_bytes").where(F.col("day").isNotNull())
    return bk.level_sizes(daily, cb.header_bytes(cols))


def _bucket_query(level):
    def q(spark, sf_dir):
        s = _bucket_input(spark, sf_dir).where(F.col("level") == level)
        return s.select("label", F.col("rows").cast("long").alias("rows"), "bytes")
    return q


for _lv, _name in [("5y", "bucket_5y"), ("year", "bucket_year"), ("month", "bucket_month"),
                   ("week", "bucket_week"), ("day", "bucket_day")]:
    register(_name)(_bucket_query(_lv))


@register("size_index_levels")
def q_size_index_levels(spark, sf_dir):
    """The level chosen from a size index that three batches extended, one of them written twice."""
    from tally.session import scratch_path

    cols = list(S.PAYABLES_TEMPLATE.columns)
    x = pl.with_row_bytes(pl.template_rows(ledger(spark, sf_dir), "contas_pagar", AS_OF), cols)
    x = x.withColumn("_d", fx.parse_date(F.col("`Data Emissao`"))).select("Id", "_d", "_bytes").checkpoint(eager=True)
    path = scratch_path(spark, "size-index")
    batch = F.coalesce(F.pmod(F.col("Id").cast("long"), F.lit(3)), F.lit(0))
    for k in (0, 1, 2, 1):
        bk.index_batch(x.where(batch == k), F.col("_d"), "_bytes", path, f"b{k}")
    daily = bk.size_index(spark, path).where(F.col("day").isNotNull())
    return bk.level_summary(bk.level_sizes(daily, cb.header_bytes(cols)), S.TEMPLATE_SPLIT_LIMIT).select(
        "level", "buckets", "max_bytes", F.col("rows").cast("long").alias("rows"), "fits", "chosen")


@register("adaptive_granularity")
def q_adaptive_granularity(spark, sf_dir):
    sizes = _bucket_input(spark, sf_dir)
    return bk.level_summary(sizes, S.TEMPLATE_SPLIT_LIMIT).select(
        "level", "buckets", "max_bytes", F.col("rows").cast("long").alias("rows"), "fits", "chosen")


# --- A6-A8, P-22, P-23, R1, R5, K9: parts ------------------------------------------------

def _est_month(spark, sf_dir, limit=S.TEMPLATE_SPLIT_LIMIT):
    rows = pl.template_rows(ledger(spark, sf_dir), "contas_pagar", AS_OF)
    return pl.split_by_establishment_month(rows, limit=limit)


@register("est_month_groups")
def q_est_month_groups(spark, sf_dir):
    rows = pl.template_rows(ledger(spark, sf_dir), "contas_pagar", AS_OF)
    rows = rows.where(F.col("Estabelecimento_id").isin(*S.TARGET_ESTABLISHMENTS))
    x = pl.with_row_bytes(rows, list(S.PAYABLES_TEMPLATE.columns)).withColumn(
        "mes", fx.due_month(F.col("`Data vencimento`")))
    g = x.groupBy(F.col("Estabelecimento_id").alias("estabelecimento_id"), "mes").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("_bytes").alias("bytes"))
    months = x.groupBy(F.col("Estabelecimento_id").alias("estabelecimento_id")).agg(
        F.countDistinct("mes").alias("meses"))
    return g.join(months, "estabelecimento_id").withColumn("mes_label", fx.month_label(F.col("mes")))


@register("est_month_parts")
def q_est_month_parts(spark, sf_dir):
    out = _est_month(spark, sf_dir)
    return out.select(F.col("Id").alias("id"), F.col("Estabelecimento_id").alias("estabelecimento_id"),
                      "mes", "pos", "parte", "n_parts")


@register("est_month_parts_small_limit")
def q_est_month_parts_small(spark, sf_dir):
    out = _est_month(spark, sf_dir, SMALL_LIMIT)
    return out.select(F.col("Id").alias("id"), F.col("Estabelecimento_id").alias("estabelecimento_id"),
                      "mes", "pos", "parte", "n_parts")


@register("est_month_parts_receivables")
def q_est_month_parts_receivables(spark, sf_dir):
    rows = pl.template_rows(ledger(spark, sf_dir), "contas_receber", AS_OF)
    out = pl.split_by_establishment_month(rows, S.RECEIVABLES_TEMPLATE, SMALL_LIMIT, prefix="contas_a_receber")
    return out.select(F.col("Id").alias("id"), F.col("Estabelecimento_id").alias("estabelecimento_id"),
                      "mes", "pos", "parte", "n_parts")


@register("part_manifest")
def q_part_manifest(spark, sf_dir):
    out = _est_month(spark, sf_dir, SMALL_LIMIT)
    header = cb.header_bytes(list(S.PAYABLES_TEMPLATE.columns))
    return pt.manifest(out, ["Estabelecimento_id", "mes", "parte", "file_name"], "_bytes", header) \
        .withColumnRenamed("Estabelecimento_id", "estabelecimento_id")


@register("row_parts")
def q_row_parts(spark, sf_dir):
    rows = pl.template_rows(ledger(spark, sf_dir), "contatos", AS_OF)
    out = pl.split_contacts_rows(rows, limit=SMALL_LIMIT)
    return out.select(F.col("ID").alias("id"), "pos", "parte", "n_parts", "file_name")


@register("row_parts_many")
def q_row_parts_many(spark, sf_dir):
    """P-27: a row or two a part, so that part numbers pass 999."""
    rows = pl.template_rows(ledger(spark, sf_dir), "contatos", AS_OF)
    out = pl.split_contacts_rows(rows, limit=400)
    return out.select(F.col("ID").alias("id"), "pos", "parte", "n_parts", "file_name")


# --- R2, T7-T9, K8: data-dependent splits (recursive CTEs in the oracle) ----------------------

@register("recursive_parts")
def q_recursive_parts(spark, sf_dir):
    rows = pl.template_rows(ledger(spark, sf_dir), "contas_pagar", AS_OF)
    out = pl.split_by_rows(rows, limit=S.TEMPLATE_SPLIT_LIMIT, columns=list(S.PAYABLES_TEMPLATE.columns))
    header = cb.header_bytes(list(S.PAYABLES_TEMPLATE.columns))
    return pt.manifest(out, ["parte"], "_bytes", header)


@register("recursive_parts_small_limit")
def q_recursive_parts_small(spark, sf_dir):
    """R2 with a limit of a few rows per part, so slices overflow and are halved."""
    rows = pl.template_rows(ledger(spark, sf_dir), "contas_pagar", AS_OF)
    cols = list(S.PAYABLES_TEMPLATE.columns)
    out = pl.split_by_rows(rows, limit=TINY_LIMIT, columns=cols)
    return pt.manifest(out, ["parte"], "_bytes", cb.header_bytes(cols))


@register("date_split")
def q_date_split(spark, sf_dir):
    rows = pl.template_rows(ledger(spark, sf_dir), "contas_pagar", AS_OF)
    cols = list(S.PAYABLES_TEMPLATE.columns)
    out, level = pl.split_by_date(rows, "Data Emissao", S.TEMPLATE_SPLIT_LIMIT, cols, prefix="contas_a_pagar")
    return pt.manifest(out, ["date_label", "file_name"], "_bytes", cb.header_bytes(cols)) \
        .withColumn("level", F.lit(level))


@register("date_split_small_limit")
def q_date_split_small(spark, sf_dir):
    """T6/T7 with a limit below the largest day: the day level is chosen and big days are row-split."""
    rows = pl.template_rows(ledger(spark, sf_dir), "contas_pagar", AS_OF)
    cols = list(S.PAYABLES_TEMPLATE.columns)
    out, level = pl.split_by_date(rows, "Data Emissao", 2 * TINY_LIMIT, cols, prefix="contas_a_pagar")
    return pt.manifest(out, ["date_label", "file_name"], "_bytes", cb.header_bytes(cols)) \
        .withColumn("level", F.lit(level))


def _contacts_date_split(spark, sf_dir, limit):
    rows = pl.template_rows(ledger(spark, sf_dir), "contatos", AS_OF)
    cols = list(S.CONTACTS_TEMPLATE.columns)
    out, level = pl.split_by_date(rows, "Data nascimento", limit, cols, prefix="contatos")
    return pt.manifest(out, ["date_label", "file_name"], "_bytes", cb.header_bytes(cols)) \
        .withColumn("level", F.lit(level))


@register("date_split_contacts")
def q_date_split_contacts(spark, sf_dir):
    return _contacts_date_split(spark, sf_dir, 60_000)


@register("date_split_fits")
def q_date_split_fits(spark, sf_dir):
    """With a limit above the whole dataset nothing is split."""
    return _contacts_date_split(spark, sf_dir, S.DATE_SPLIT_LIMIT * 1000)


@register("resplit_parts")
def q_resplit_parts(spark, sf_dir):
    rows = pl.template_rows(ledger(spark, sf_dir), "contas_pagar", AS_OF)
    cols = list(S.PAYABLES_TEMPLATE.columns)
    header = cb.header_bytes(cols)
    out, _ = pl.split_by_date(rows, "Data Emissao", S.DATE_SPLIT_LIMIT, cols, prefix="contas_a_pagar")
    threshold = S.RESPLIT_THRESHOLD * SMALL_LIMIT / S.DATE_SPLIT_LIMIT
    re = pt.resplit(out.drop("pos"), ["date_label"], pl.total_order(out, [F.col("_d")], cols), "_bytes", header,
                    threshold=threshold, limit=SMALL_LIMIT)
    return pt.manifest(re, ["date_label", "sub", "subsub"], "_bytes", header)


# --- V1-V6, J7, U1-U3: verification -------------------------------------------------------

def _verify_inputs(spark, sf_dir):
    rows = pl.template_rows(ledger(spark, sf_dir), "contas_pagar", AS_OF)
    rows = rows.checkpoint(eager=True)          # both sides read it; the export join runs once
    original = rows.where(F.col("Estabelecimento_id").isin(*S.TARGET_ESTABLISHMENTS))
    parts = pl.split_by_establishment_month(rows, limit=SMALL_LIMIT)
    return original, parts


SUM_COLS = ["Valor documento", "Saldo", "Taxas"]


@register("verify_counts")
def q_verify_counts(spark, sf_dir):
    original, parts = _verify_inputs(spark, sf_dir)
    return vf.verify(original, parts, "Id", SUM_COLS).where(F.col("check") == "row_count")


@register("verify_ids")
def q_verify_ids(spark, sf_dir):
    original, parts = _verify_inputs(spark, sf_dir)
    return vf.verify(original, parts, "Id", SUM_COLS).where(F.col("check").startswith("ids_"))


@register("verify_sums")
def q_verify_sums(spark, sf_dir):
    original, parts = _verify_inputs(spark, sf_dir)
    return vf.verify(original, parts, "Id", SUM_COLS).where(F.col("check").startswith("sum:"))


def _damage(df: DataFrame) -> DataFrame:
    """Rows lost, ids changed and balances changed."""
    n = F.col("Id").cast("long")
    return df.where(n % 50 != 1).withColumns({
        "Id": F.when(n % 4000 == 21, F.concat(F.lit("-"), F.col("Id"))).otherwise(F.col("Id")),
        "Saldo": F.when(n % 30 == 3, F.col("Saldo") + F.lit("0.5").cast(S.MONEY)).otherwise(F.col("Saldo")).cast(S.MONEY)})


def _damaged_checks(spark, sf_dir):
    """The original and a damaged copy."""
    rows = pl.template_rows(ledger(spark, sf_dir), "contas_pagar", AS_OF)
    original = rows.where(F.col("Estabelecimento_id").isin(*S.TARGET_ESTABLISHMENTS))
    return original, _damage(original)


@register("verify_damaged")
def q_verify_damaged(spark, sf_dir):
    return vf.verify(*_damaged_checks(spark, sf_dir), "Id", SUM_COLS)


@register("verify_overall")
def q_verify_overall(spark, sf_dir):
    return vf.overall(vf.verify(*_damaged_checks(spark, sf_dir), "Id", SUM_COLS)).select("passed", "checks")


@register("verify_id_listing")
def q_verify_id_listing(spark, sf_dir):
    return vf.id_listing(*_damaged_checks(spark, sf_dir), "Id")


@register("verify_manifest")
def q_verify_manifest(spark, sf_dir):
    """V1/V3/V5: damaged parts against the digests and sums that the manifest keeps."""
    from tally.session import scratch_path

    _, parts = _verify_inputs(spark, sf_dir)
    path = scratch_path(spark, "digests")
    vf.part_digests(parts, ["file_name"], "Id", SUM_COLS).write.parquet(path)
    found = vf.part_digests(_damage(parts), ["file_name"], "Id", SUM_COLS)
    return vf.check_parts(spark.read.parquet(path), found, ["file_name"], SUM_COLS)


@register("measured_parts")
def q_measured_parts(spark, sf_dir):
    """K7: gzip parts divided until their written files fit; by due month what they hold, and files over the limit."""
    from tally.session import scratch_path
    from tally.sources.tables import read_once, read_parts

    rows = pl.template_rows(ledger(spark, sf_dir), "contas_pagar", AS_OF)
    cols = list(S.PAYABLES_TEMPLATE.columns)
    path = scratch_path(spark, "measured")
    pl.split_measured(rows, path, MEASURED_LIMIT, cols)
    back = read_once(read_parts(spark, path, columns=cols, glob="*.csv*"), ["Id", "Data vencimento", "Valor documento"])
    over = back.groupBy("_part_file").agg(F.max("_part_size").alias("bytes"), F.count(F.lit(1)).alias("n")) \
        .agg(F.count_if((F.col("bytes") > MEASURED_LIMIT) & (F.col("n") > 1)).alias("files_over"))
    months = back.groupBy(fx.due_month(F.col("`Data vencimento`")).alias("mes")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("Id").alias("ids"),
        F.sum(F.col("`Valor documento`").cast(S.MONEY)).cast("double").alias("valor"))
    return months.crossJoin(F.broadcast(over))          # one row


@register("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    """Write est x month parts as BOM CSV, read them back, verify."""
    from tally.session import scratch_path
    from tally.sinks.writers import write_parts
    from tally.sources.tables import part_headers, part_name, read_once, read_parts

    original, parts = _verify_inputs(spark, sf_dir)
    cols = list(S.PAYABLES_TEMPLATE.columns)
    path = scratch_path(spark, "parts")
    write_parts(parts, path, ["file_name"], ["pos"], columns=cols)
    back = read_once(read_parts(spark, path, columns=cols), ["Id", *SUM_COLS])
    checks = vf.verify(original, back, "Id", SUM_COLS)
    files = back.groupBy("_part_file").agg(F.max("_part_size").alias("bytes"))      # names are made by file, not by row
    sizes = files.groupBy(part_name("_part_file").alias("file_name")).agg(F.max("bytes").alias("bytes"))
    expect = pt.part_sizes(parts, ["file_name"], "_bytes", cb.header_bytes(cols))
    size_ok = sizes.join(expect.withColumnRenamed("bytes", "expected"), "file_name", "full") \
        .agg(F.count_if(F.col("bytes") == F.col("expected")).cast("double").alias("actual"),
             F.count(F.lit(1)).cast("double").alias("expected")) \
        .select(F.lit("file_bytes_exact").alias("check"), "expected", "actual",
                (F.col("expected") == F.col("actual")).alias("passed"))
    cols_ok = vf.column_checks(cols, part_headers(spark, path)) \
        .agg(F.count_if("passed").cast("double").alias("actual"), F.count(F.lit(1)).cast("double").alias("expected")) \
        .select(F.lit("columns").alias("check"), "expected", "actual", (F.col("expected") == F.col("actual")).alias("passed"))
    return checks.unionByName(size_ok).unionByName(cols_ok)


@register("verify_columns")
def q_verify_columns(spark, sf_dir):
    """Write the parts, read each file's header, compare with the template columns."""
    from tally.session import scratch_path
    from tally.sinks.writers import write_parts
    from tally.sources.tables import part_headers, part_name

    _, parts = _verify_inputs(spark, sf_dir)
    cols = list(S.PAYABLES_TEMPLATE.columns)
    path = scratch_path(spark, "columns")
    write_parts(parts, path, ["file_name"], ["pos"], columns=cols)
    checks = vf.column_checks(cols, part_headers(spark, path))
    return checks.select(part_name("_part_file").alias("file_name"), F.array_join("missing_columns", ",").alias("missing_columns"),
                         F.array_join("extra_columns", ",").alias("extra_columns"), "passed")


# --- C-N1..C-N5: declared constraints ---------------------------------------------------

@register("pk_duplicates")
def q_pk_duplicates(spark, sf_dir):
    return cn.pk_duplicates(ledger(spark, sf_dir))


@register("fk_orphans")
def q_fk_orphans(spark, sf_dir):
    return cn.fk_orphans(ledger(spark, sf_dir))


@register("not_null_audit")
def q_not_null_audit(spark, sf_dir):
    return cn.not_null_violations(ledger(spark, sf_dir))


@register("length_audit")
def q_length_audit(spark, sf_dir):
    return cn.length_violations(ledger(spark, sf_dir))


@register("defaults_applied")
def q_defaults_applied(spark, sf_dir):
    i = cn.apply_defaults(ledger(spark, sf_dir).DOC_FINANCEIRO_PARCELA, "DOC_FINANCEIRO_PARCELA")
    return i.groupBy(F.col("TIPO_COBR_ID").alias("tipo_cobr_id")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("VL_DMOVI_TXCOBR").cast("double").alias("taxas"))
