"""Ledger exports: payables, receivables, contacts.

Joins are declared and left to Catalyst/AQE: the filters on document type and
establishment reach the scan; the dimension tables (payment terms, collection
types, cities, states) are broadcast only after a bounded row-count check
(``broadcast_if_small``); the two large joins (installment->document,
document->party) are left to the planner's size estimate -- broadcast when the
filtered side is small, else a shuffle join on the key, where AQE splits a
skewed key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally import schemas as S
from tally.functions import scalars as fx
from tally.operators.sizing import broadcast_if_small
from tally.sources.ledger_view import Ledger


def _installments(t: Ledger, doc_type: int, establishments: Sequence[int] | None) -> DataFrame:
    doc = t.DOC_FINANCEIRO.where(F.col("NO_DFIN_TIPO") == doc_type)
    if establishments is not None:
        doc = doc.where(F.col("ESTABELECIMENTO_ID").isin(list(establishments)))
    i = t.DOC_FINANCEIRO_PARCELA.alias("i")
    d = doc.alias("d")
    p = t.PESSOA.alias("p")
    # documents meet their parties first (the smaller join), so the installment rows --
    # the largest table -- are shuffled once, on the document key, instead of twice
    dp = d.join(p, F.col("d.PESSOA_ID") == F.col("p.PESSOA_ID"), "inner")
    return i.join(dp, F.col("i.DOC_FINANCEIRO_ID") == F.col("d.DOC_FINANCEIRO_ID"), "inner")


def _with_dims(base: DataFrame, t: Ledger) -> DataFrame:
    cp = broadcast_if_small(t.COND_PAGTO).alias("cp")
    tc = broadcast_if_small(t.TIPO_COBR).alias("tc")
    return (base.join(cp, F.col("d.COND_PAGTO_ID") == F.col("cp.COND_PAGTO_ID"), "left")
                .join(tc, F.col("i.TIPO_COBR_ID") == F.col("tc.TIPO_COBR_ID"), "left"))


def payables(t: Ledger, establishments: Sequence[int] | None = S.TARGET_ESTABLISHMENTS) -> DataFrame:
    """Accounts payable of the target establishments, export labels."""
    df = _with_dims(_installments(t, S.DOC_TYPE_PAYABLE, establishments), t)
    quit_ = F.col("i.DT_DFINP_QUIT")
    return df.select(
        F.col("i.DOC_FINANCEIRO_PARCELA_ID").alias("ID"),
        F.col("p.NM_PESS_IDENT").alias("Fornecedor"),
        F.col("d.DT_DFIN_EMISS").alias("Data emissao"),
        F.col("i.DT_DFINP_VENC").alias("Data vencimento"),
        quit_.alias("Data Liquidacao"),
        F.col("i.VL_DFINP_PARC").alias("Valor documento"),
        fx.balance_by_settlement(quit_, F.col("i.VL_DFINP_PARC")).alias("Saldo"),
        fx.status_text(quit_).alias("Situação"),
        F.col("d.CD_DFIN_DOCUM").alias("Numero documento"),
        F.col("cp.DS_CPAG_IDENT").alias("Categoria"),
        F.col("i.DS_DFINP_HIST").alias("Historico"),
        fx.paid_flag(quit_).alias("Pago"),
        fx.competence_month(F.col("d.DT_DFIN_EMISS")).alias("Competencia"),
        F.col("tc.DS_TCOBR_IDENT").alias("Forma Pagamento"),
        F.col("d.ESTABELECIMENTO_ID").alias("Estabelecimento_id"),
    )


def receivables(t: Ledger, establishments: Sequence[int] | None = S.TARGET_ESTABLISHMENTS,
                fee_column: str = "VL_DFINP_TXCOBR") -> DataFrame:
    """Accounts receivable; Taxas comes from ``fee_column`` only if that column exists."""
    df = _with_dims(_installments(t, S.DOC_TYPE_RECEIVABLE, establishments), t)
    quit_ = F.col("i.DT_DFINP_QUIT")
    fee = F.col(f"i.{fee_column}") if fee_column in t.DOC_FINANCEIRO_PARCELA.columns \
        else F.lit(0).cast(S.MONEY)
    return df.select(
        F.col("i.DOC_FINANCEIRO_PARCELA_ID").alias("Id"),
        F.col("p.NM_PESS_IDENT").alias("Cliente"),
        F.col("d.DT_DFIN_EMISS").alias("Data Emissao"),
        F.col("i.DT_DFINP_VENC").alias("Data vencimento"),
        quit_.alias("Data Liquidacao"),
        F.col("i.VL_DFINP_PARC").alias("Valor documento"),
        fx.balance_by_settlement(quit_, F.col("i.VL_DFINP_PARC")).alias("Saldo"),
        fx.status_text(quit_).alias("Situacao"),
        F.col("d.CD_DFIN_DOCUM").alias("Numero do documento"),
        F.col("i.NO_DFINP_COBR_ELE").alias("Numero no banco"),
        F.col("cp.DS_CPAG_IDENT").alias("Categoria"),
        F.col("i.DS_DFINP_HIST").alias("Historico"),
        F.col("tc.DS_TCOBR_IDENT").alias("Forma de recebimento"),
        F.lit("").alias("Meio de recebimento"),
        fee.cast(S.MONEY).alias("Taxas"),
        F.col("d.ESTABELECIMENTO_ID").alias("Estabelecimento_id"),
    )


def default_contact(contato: DataFrame) -> DataFrame:
    """Per party, the phone of its default contact with the lowest id.

    An aggregate (min_by) instead of a per-party window: it combines map-side,
    so a party owning a third of all contacts still costs one row per task.
    """
    return (contato.where(F.col("ID_CTT_PADR"))
                   .groupBy("PESSOA_ID")
                   .agg(F.min_by("DS_CTT_TTRM", "CONTATO_ID").alias("Fone")))


def contacts(t: Ledger) -> DataFrame:
    """One row per party, export labels, decoded codes and looked-up names."""
    p = t.PESSOA.alias("p")
    m = broadcast_if_small(t.MUNICIPIO).alias("m")
    u = broadcast_if_small(t.UF).alias("u")
    fone = default_contact(t.CONTATO).alias("f")
    df = (p.join(m, F.col("p.MUNICIPIO_ID") == F.col("m.MUNICIPIO_ID"), "left")
           .join(u, F.col("m.UF_ID") == F.col("u.UF_ID"), "left")
           .join(fone, F.col("p.PESSOA_ID") == F.col("f.PESSOA_ID"), "left"))
    blank = F.lit("")
    return df.select(
        F.col("p.PESSOA_ID").alias("ID"),
        F.col("p.NO_PESS_IDENT").alias("Código"),
        F.col("p.NM_PESS_IDENT").alias("Nome"),
        F.col("p.DS_PESS_FANTA").alias("Fantasia"),
        F.col("p.DS_PESS_ENDER").alias("Endereço"),
        F.col("p.NO_PESS_ENDER").alias("Número"),
        F.col("p.DS_PESS_ENDER_COMPL").alias("Complemento"),
        F.col("p.DS_PESS_BAIRRO").alias("Bairro"),
        F.col("p.NO_PESS_CEP").alias("CEP"),
        F.col("m.DS_MUN_IDENT").alias("Cidade"),
        F.col("u.CD_UF_IDT").alias("Estado"),
        F.col("p.DS_PESS_ENDER_REFER").alias("Observações do contato"),
        F.col("f.Fone").alias("Fone"),
        blank.alias("Fax"),
        blank.alias("Celular"),
        F.col("p.NO_PESS_EMAIL_COBR").alias("E-mail"),
        blank.alias("Web Site"),
        fx.person_type(F.col("p.NO_PESS_TIPO")).alias("Tipo pessoa"),
        F.col("p.NO_PESS_CNPJ_CPF").alias("CNPJ / CPF"),
        F.col("p.NO_PESS_INSCR_ESTAD").alias("IE / RG"),
        F.lit(S.IE_EXEMPT_DEFAULT).alias("IE isento"),
        fx.active_label(F.col("p.ID_PESS_ATIVA")).alias("Situação"),
        F.col("p.DS_PESS_OBS").alias("Observações"),
        fx.marital_label(F.col("p.NO_PESS_EST_CIVIL")).alias("Estado civil"),
        F.col("p.DS_PESS_CARG").alias("Profissão"),
        fx.sex_label(F.col("p.NO_PESS_SEXO")).alias("Sexo"),
        F.col("p.DT_PESS_NASC").alias("Data nascimento"),
        F.col("p.DS_PESS_NATUR").alias("Naturalidade"),
        blank.alias("Nome pai"),
        blank.alias("CPF pai"),
        blank.alias("Nome mãe"),
        blank.alias("CPF mãe"),
        blank.alias("Lista de Preço"),
        blank.alias("Vendedor"),
        F.col("p.NO_PESS_EMAIL_COBR").alias("E-mail para envio de NFe"),
        blank.alias("Tipos de Contatos"),
        fx.taxpayer_flag(F.col("p.NO_PESS_TIPO")).alias("Contribuinte"),
        blank.alias("Código de regime tributário"),
        F.lit(0).alias("Limite de crédito"),
    )


def payables_simple(t: Ledger) -> DataFrame:
    """Payables without dimensions or establishment filter; balance = value - paid."""
    df = _installments(t, S.DOC_TYPE_PAYABLE, None)
    return df.select(
        F.col("i.DOC_FINANCEIRO_PARCELA_ID").alias("ID"),
        F.col("p.NM_PESS_IDENT").alias("Fornecedor"),
        F.col("d.DT_DFIN_EMISS").alias("Data emissao"),
        F.col("i.DT_DFINP_VENC").alias("Data vencimento"),
        F.col("i.DT_DFINP_QUIT").alias("Data Liquidacao"),
        F.col("i.VL_DFINP_PARC").alias("Valor documento"),
        fx.balance_by_amount(F.col("i.VL_DFINP_PARC"), F.col("i.VL_DFINP_QUIT")).alias("Saldo"),
        fx.status_text(F.col("i.DT_DFINP_QUIT")).alias("Situação"),
        F.col("d.CD_DFIN_DOCUM").alias("Numero documento"),
    )


def receivables_simple(t: Ledger) -> DataFrame:
    """Receivables without dimensions or establishment filter."""
    df = _installments(t, S.DOC_TYPE_RECEIVABLE, None)
    return df.select(
        F.col("i.DOC_FINANCEIRO_PARCELA_ID").alias("Id"),
        F.col("p.NM_PESS_IDENT").alias("Cliente"),
        F.col("d.DT_DFIN_EMISS").alias("Data Emissao"),
        F.col("i.DT_DFINP_VENC").alias("Data vencimento"),
        F.col("i.DT_DFINP_QUIT").alias("Data Liquidacao"),
        F.col("i.VL_DFINP_PARC").alias("Valor documento"),
        fx.balance_by_amount(F.col("i.VL_DFINP_PARC"), F.col("i.VL_DFINP_QUIT")).alias("Saldo"),
    )


def contacts_simple(t: Ledger) -> DataFrame:
    """The party list with five columns."""
    return t.PESSOA.select(
        F.col("PESSOA_ID").alias("Id"),
        F.col("NM_PESS_IDENT").alias("Nome"),
        F.col("DS_PESS_FANTA").alias("Fantasia"),
        F.col("DS_PESS_ENDER").alias("Endereço"),
        F.col("NO_PESS_CNPJ_CPF").alias("CNPJ/CPF"),
    )
