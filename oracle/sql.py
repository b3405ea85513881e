"""DuckDB oracle SQL, one string per registered query (tables: the driver's views)."""

from __future__ import annotations

from oracle.ledger import with_ctes

SQL: dict[str, str] = {}

_EXPORT_FROM = """
FROM parc i
JOIN doc d ON i.DOC_FINANCEIRO_ID = d.DOC_FINANCEIRO_ID
JOIN pessoa p ON d.PESSOA_ID = p.PESSOA_ID
LEFT JOIN cond cp ON d.COND_PAGTO_ID = cp.COND_PAGTO_ID
LEFT JOIN tipo tc ON i.TIPO_COBR_ID = tc.TIPO_COBR_ID
"""

# Export column expressions (aliases are the snake_case labels).
PAYABLES_COLS = """
  i.DOC_FINANCEIRO_PARCELA_ID AS id,
  p.NM_PESS_IDENT AS fornecedor,
  strftime(d.DT_DFIN_EMISS, '%Y-%m-%d %H:%M:%S') AS data_emissao,
  strftime(i.DT_DFINP_VENC, '%Y-%m-%d %H:%M:%S') AS data_vencimento,
  strftime(i.DT_DFINP_QUIT, '%Y-%m-%d %H:%M:%S') AS data_liquidacao,
  i.VL_DFINP_PARC AS valor_documento,
  CASE WHEN i.DT_DFINP_QUIT IS NOT NULL THEN CAST(0 AS DECIMAL(22,6)) ELSE i.VL_DFINP_PARC END AS saldo,
  CASE WHEN i.DT_DFINP_QUIT IS NULL THEN 'Em Aberto' ELSE 'Liquidado' END AS situacao,
  d.CD_DFIN_DOCUM AS numero_documento,
  cp.DS_CPAG_IDENT AS categoria,
  i.DS_DFINP_HIST AS historico,
  CASE WHEN i.DT_DFINP_QUIT IS NOT NULL THEN 'Sim' ELSE 'Não' END AS pago,
  strftime(d.DT_DFIN_EMISS, '%Y-%m') AS competencia,
  tc.DS_TCOBR_IDENT AS forma_pagamento,
  d.ESTABELECIMENTO_ID AS estabelecimento_id"""

RECEIVABLES_COLS = """
  i.DOC_FINANCEIRO_PARCELA_ID AS id,
  p.NM_PESS_IDENT AS cliente,
  strftime(d.DT_DFIN_EMISS, '%Y-%m-%d %H:%M:%S') AS data_emissao,
  strftime(i.DT_DFINP_VENC, '%Y-%m-%d %H:%M:%S') AS data_vencimento,
  strftime(i.DT_DFINP_QUIT, '%Y-%m-%d %H:%M:%S') AS data_liquidacao,
  i.VL_DFINP_PARC AS valor_documento,
  CASE WHEN i.DT_DFINP_QUIT IS NOT NULL THEN CAST(0 AS DECIMAL(22,6)) ELSE i.VL_DFINP_PARC END AS saldo,
  CASE WHEN i.DT_DFINP_QUIT IS NULL THEN 'Em Aberto' ELSE 'Liquidado' END AS situacao,
  d.CD_DFIN_DOCUM AS numero_do_documento,
  i.NO_DFINP_COBR_ELE AS numero_no_banco,
  cp.DS_CPAG_IDENT AS categoria,
  i.DS_DFINP_HIST AS historico,
  tc.DS_TCOBR_IDENT AS forma_de_recebimento,
  '' AS meio_de_recebimento,
  CAST(0 AS DECIMAL(22,6)) AS taxas,
  d.ESTABELECIMENTO_ID AS estabelecimento_id"""


def _money_to_double(select_sql: str, money_cols: list[str]) -> str:
    cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in money_cols)
    return f"SELECT * REPLACE ({cols}) FROM ({select_sql}) q"


SQL["payables"] = (with_ctes("doc", "parc", "pessoa", "cond", "tipo")
                   + _money_to_double(f"SELECT {PAYABLES_COLS} {_EXPORT_FROM} "
                                      "WHERE d.NO_DFIN_TIPO = 2 AND d.ESTABELECIMENTO_ID IN (2, 5)",
                                      ["valor_documento", "saldo"]))
SQL["receivables"] = (with_ctes("doc", "parc", "pessoa", "cond", "tipo")
                      + _money_to_double(f"SELECT {RECEIVABLES_COLS} {_EXPORT_FROM} "
                                         "WHERE d.NO_DFIN_TIPO = 1 AND d.ESTABELECIMENTO_ID IN (2, 5)",
                                         ["valor_documento", "saldo", "taxas"]))

DEFAULT_CONTACT = """
fone AS (
  SELECT PESSOA_ID, arg_min(DS_CTT_TTRM, CONTATO_ID) AS Fone
  FROM contato WHERE ID_CTT_PADR GROUP BY PESSOA_ID)"""

CONTACTS_COLS = """
  p.PESSOA_ID AS id,
  p.NO_PESS_IDENT AS codigo,
  p.NM_PESS_IDENT AS nome,
  p.DS_PESS_FANTA AS fantasia,
  p.DS_PESS_ENDER AS endereco,
  p.NO_PESS_ENDER AS numero,
  p.DS_PESS_ENDER_COMPL AS complemento,
  p.DS_PESS_BAIRRO AS bairro,
  p.NO_PESS_CEP AS cep,
  m.DS_MUN_IDENT AS cidade,
  u.CD_UF_IDT AS estado,
  p.DS_PESS_ENDER_REFER AS observacoes_do_contato,
  f.Fone AS fone,
  '' AS fax,
  '' AS celular,
  p.NO_PESS_EMAIL_COBR AS e_mail,
  '' AS web_site,
  CASE p.NO_PESS_TIPO WHEN 1 THEN 'Física' WHEN 2 THEN 'Jurídica' ELSE 'Outro' END AS tipo_pessoa,
  p.NO_PESS_CNPJ_CPF AS cnpj_cpf,
  p.NO_PESS_INSCR_ESTAD AS ie_rg,
  'Não' AS ie_isento,
  CASE WHEN p.ID_PESS_ATIVA THEN 'Ativo' ELSE 'Inativo' END AS situacao,
  p.DS_PESS_OBS AS observacoes,
  CASE p.NO_PESS_EST_CIVIL WHEN 1 THEN 'Solteiro(a)' WHEN 2 THEN 'Casado(a)' WHEN 3 THEN 'Divorciado(a)'
       WHEN 4 THEN 'Viúvo(a)' ELSE '' END AS estado_civil,
  p.DS_PESS_CARG AS profissao,
  CASE p.NO_PESS_SEXO WHEN 1 THEN 'Masculino' WHEN 2 THEN 'Feminino' ELSE 'Outro' END AS sexo,
  strftime(p.DT_PESS_NASC, '%Y-%m-%d %H:%M:%S') AS data_nascimento,
  p.DS_PESS_NATUR AS naturalidade,
  '' AS nome_pai,
  '' AS cpf_pai,
  '' AS nome_mae,
  '' AS cpf_mae,
  '' AS lista_de_preco,
  '' AS vendedor,
  p.NO_PESS_EMAIL_COBR AS e_mail_para_envio_de_nfe,
  '' AS tipos_de_contatos,
  CASE WHEN p.NO_PESS_TIPO = 2 THEN 1 ELSE 0 END AS contribuinte,
  '' AS codigo_de_regime_tributario,
  0 AS limite_de_credito"""

CONTACTS_FROM = """
FROM pessoa p
LEFT JOIN municipio m ON p.MUNICIPIO_ID = m.MUNICIPIO_ID
LEFT JOIN uf u ON m.UF_ID = u.UF_ID
LEFT JOIN fone f ON p.PESSOA_ID = f.PESSOA_ID
"""

SQL["contacts"] = (with_ctes("pessoa", "municipio", "uf", "contato", extra=[DEFAULT_CONTACT])
                   + f"SELECT {CONTACTS_COLS} {CONTACTS_FROM}")

SQL["payables_simple"] = (with_ctes("doc", "parc", "pessoa") + """
SELECT i.DOC_FINANCEIRO_PARCELA_ID AS id, p.NM_PESS_IDENT AS fornecedor, strftime(d.DT_DFIN_EMISS, '%Y-%m-%d %H:%M:%S') AS data_emissao,
       strftime(i.DT_DFINP_VENC, '%Y-%m-%d %H:%M:%S') AS data_vencimento, strftime(i.DT_DFINP_QUIT, '%Y-%m-%d %H:%M:%S') AS data_liquidacao,
       CAST(i.VL_DFINP_PARC AS DOUBLE) AS valor_documento,
       CAST(i.VL_DFINP_PARC - coalesce(i.VL_DFINP_QUIT, 0) AS DOUBLE) AS saldo,
       CASE WHEN i.DT_DFINP_QUIT IS NULL THEN 'Em Aberto' ELSE 'Liquidado' END AS situacao,
       d.CD_DFIN_DOCUM AS numero_documento
FROM parc i JOIN doc d ON i.DOC_FINANCEIRO_ID = d.DOC_FINANCEIRO_ID JOIN pessoa p ON d.PESSOA_ID = p.PESSOA_ID
WHERE d.NO_DFIN_TIPO = 2""")

SQL["receivables_simple"] = (with_ctes("doc", "parc", "pessoa") + """
SELECT i.DOC_FINANCEIRO_PARCELA_ID AS id, p.NM_PESS_IDENT AS cliente, strftime(d.DT_DFIN_EMISS, '%Y-%m-%d %H:%M:%S') AS data_emissao,
       strftime(i.DT_DFINP_VENC, '%Y-%m-%d %H:%M:%S') AS data_vencimento, strftime(i.DT_DFINP_QUIT, '%Y-%m-%d %H:%M:%S') AS data_liquidacao,
       CAST(i.VL_DFINP_PARC AS DOUBLE) AS valor_documento,
       CAST(i.VL_DFINP_PARC - coalesce(i.VL_DFINP_QUIT, 0) AS DOUBLE) AS saldo
FROM parc i JOIN doc d ON i.DOC_FINANCEIRO_ID = d.DOC_FINANCEIRO_ID JOIN pessoa p ON d.PESSOA_ID = p.PESSOA_ID
WHERE d.NO_DFIN_TIPO = 1""")

SQL["contacts_simple"] = (with_ctes("pessoa") + """
SELECT PESSOA_ID AS id, NM_PESS_IDENT AS nome, DS_PESS_FANTA AS fantasia, DS_PESS_ENDER AS endereco,
       NO_PESS_CNPJ_CPF AS cnpj_cpf
FROM pessoa""")

SQL["default_contact_top1"] = (with_ctes("contato", extra=[DEFAULT_CONTACT])
                               + "SELECT PESSOA_ID AS pessoa_id, Fone AS fone FROM fone")


# ---------------------------------------------------------------------------
# Scalars, templates, audit, buckets, parts, verification, constraints.
# ---------------------------------------------------------------------------

from oracle import templates as TP  # noqa: E402
from oracle.templates import FUTURE, PAST, field_bytes, fmt, header_bytes, parse, q, row_bytes  # noqa: E402
from tally import schemas as S  # noqa: E402

SQL["status_paid_flags"] = with_ctes("parc") + """
SELECT DOC_FINANCEIRO_PARCELA_ID AS id,
       CAST(CASE WHEN DT_DFINP_QUIT IS NOT NULL THEN 0 ELSE VL_DFINP_PARC END AS DOUBLE) AS saldo_por_liquidacao,
       CAST(VL_DFINP_PARC - coalesce(VL_DFINP_QUIT, 0) AS DOUBLE) AS saldo_por_valor,
       CASE WHEN DT_DFINP_QUIT IS NULL THEN 'Em Aberto' ELSE 'Liquidado' END AS situacao,
       CASE WHEN DT_DFINP_QUIT IS NOT NULL THEN 'Sim' ELSE 'Não' END AS pago
FROM parc"""

SQL["competence_month"] = with_ctes("doc") + """
SELECT DOC_FINANCEIRO_ID AS id, strftime(DT_DFIN_EMISS, '%Y-%m') AS competencia FROM doc"""

SQL["decode_person"] = with_ctes("pessoa") + """
SELECT PESSOA_ID AS id,
       CASE NO_PESS_TIPO WHEN 1 THEN 'Física' WHEN 2 THEN 'Jurídica' ELSE 'Outro' END AS tipo_pessoa,
       CASE WHEN ID_PESS_ATIVA THEN 'Ativo' ELSE 'Inativo' END AS situacao,
       CASE NO_PESS_EST_CIVIL WHEN 1 THEN 'Solteiro(a)' WHEN 2 THEN 'Casado(a)' WHEN 3 THEN 'Divorciado(a)'
            WHEN 4 THEN 'Viúvo(a)' ELSE '' END AS estado_civil,
       CASE NO_PESS_SEXO WHEN 1 THEN 'Masculino' WHEN 2 THEN 'Feminino' ELSE 'Outro' END AS sexo,
       CASE WHEN NO_PESS_TIPO = 2 THEN 1 ELSE 0 END AS contribuinte
FROM pessoa"""

_TOKENS = ["1", "sim", "yes", "true", "verdadeiro", "y", "s", "t", "v", "0", "não", "1.0", "talvez"]
_TOK = "CASE PESSOA_ID % 14 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(_TOKENS)) + " END"
_TRUTHY = "('" + "', '".join(S.TRUTHY_TOKENS) + "')"
SQL["truthy_tokens"] = with_ctes("pessoa") + f"""
, tk AS (
  SELECT PESSOA_ID AS id,
         CASE WHEN PESSOA_ID % 4 = 1 THEN upper({_TOK}) ELSE {_TOK} END AS token,
         NO_PESS_TIPO
  FROM pessoa)
SELECT id, token,
       CASE WHEN regexp_replace(lower(token), '^(-?[0-9]+)\\.0$', '\\1') IN {_TRUTHY} THEN 1 ELSE 0 END AS flag,
       CASE WHEN NO_PESS_TIPO = 2 THEN 1
            WHEN regexp_replace(lower(token), '^(-?[0-9]+)\\.0$', '\\1') IN {_TRUTHY} THEN 1 ELSE 0 END AS contribuinte
FROM tk"""

_AMOUNT_TEXT = """CASE CD_DFINP_IDT
    WHEN 1 THEN CAST(CAST(VL_DFINP_PARC AS DECIMAL(22,2)) AS VARCHAR)
    WHEN 2 THEN ''
    WHEN 3 THEN 'abc'
    WHEN 4 THEN ' ' || CAST(CAST(VL_DMOVI_TXCOBR AS DECIMAL(22,2)) AS VARCHAR) || ' '
    WHEN 5 THEN NULL
    WHEN 6 THEN '-1'
    ELSE '0' END"""

SQL["numeric_coerce"] = with_ctes("parc") + f"""
, t AS (SELECT DOC_FINANCEIRO_PARCELA_ID AS id, {_AMOUNT_TEXT} AS texto FROM parc)
SELECT id, texto, CAST(coalesce(TRY_CAST(trim(texto) AS DECIMAL(22,6)), 0) AS DOUBLE) AS valor FROM t"""

SQL["positive_flag"] = with_ctes("parc") + f"""
, t AS (SELECT DOC_FINANCEIRO_PARCELA_ID AS id, {_AMOUNT_TEXT} AS texto FROM parc)
SELECT id, texto, CASE WHEN TRY_CAST(trim(texto) AS DECIMAL(22,6)) > 0 THEN 1 ELSE 0 END AS positivo FROM t"""

SQL["date_coerce_format"] = with_ctes("parc") + f"""
, t AS (
  SELECT DOC_FINANCEIRO_PARCELA_ID AS id, CD_DFINP_IDT AS linha,
         CASE CD_DFINP_IDT
           WHEN 1 THEN strftime(DT_DFINP_VENC, '%d/%m/%Y')
           WHEN 2 THEN strftime(DT_DFINP_VENC, '%Y-%m-%d')
           WHEN 3 THEN '31/02/' || CAST(year(DT_DFINP_VENC) AS VARCHAR)
           WHEN 4 THEN ''
           WHEN 5 THEN NULL
           WHEN 6 THEN 'abc'
           WHEN 7 THEN strftime(DT_DFINP_VENC, '%Y-%m-%d %H:%M:%S')
           ELSE strftime(DT_DFINP_VENC, '%-d/%-m/%Y') END AS texto
  FROM parc)
SELECT id, linha, texto, coalesce({fmt(parse('texto'))}, '') AS data FROM t"""

SQL["digits_only"] = with_ctes("pessoa") + """
SELECT PESSOA_ID AS id, NO_PESS_CNPJ_CPF AS cnpj_cpf, regexp_replace(NO_PESS_CNPJ_CPF, '[^0-9]', '', 'g') AS digitos
FROM pessoa"""

SQL["status_relabel"] = with_ctes("parc") + """
, t AS (
  SELECT DOC_FINANCEIRO_PARCELA_ID AS id,
         CASE WHEN CD_DFINP_IDT % 4 = 0 THEN 'Liquidado' WHEN CD_DFINP_IDT % 4 = 1 THEN 'LIQUIDADO'
              WHEN CD_DFINP_IDT % 4 = 2 THEN 'liquidado '
              ELSE CASE WHEN DT_DFINP_QUIT IS NULL THEN 'Em Aberto' ELSE 'Liquidado' END END AS texto
  FROM parc)
SELECT id, texto, CASE WHEN lower(texto) = 'liquidado' THEN 'paga' ELSE texto END AS situacao FROM t"""

# --- templates ------------------------------------------------------------------------

PAY_CTES = with_ctes("doc", "parc", "pessoa", "cond", "tipo", extra=[TP.PAY_EXPORT, TP.PAY_IMPUTE, TP.PAY_CONFORM])
REC_CTES = with_ctes("doc", "parc", "pessoa", "cond", "tipo", extra=[TP.REC_EXPORT, TP.REC_IMPUTE, TP.REC_CONFORM])
CON_CTES = with_ctes("pessoa", "municipio", "uf", "contato", extra=[TP.FONE, TP.CON_EXPORT, TP.CON_IMPUTE,
                                                                     TP.CON_CONFORM])

SQL["conform_payables"] = PAY_CTES + TP.snake_select("pconf", S.PAYABLES_TEMPLATE.columns,
                                                     TP.money_cols(S.PAYABLES_TEMPLATE))
SQL["conform_receivables"] = REC_CTES + TP.snake_select("rconf", S.RECEIVABLES_TEMPLATE.columns,
                                                        TP.money_cols(S.RECEIVABLES_TEMPLATE))
SQL["conform_contacts"] = CON_CTES + TP.snake_select("cconf", S.CONTACTS_TEMPLATE.columns,
                                                     TP.money_cols(S.CONTACTS_TEMPLATE))
SQL["impute_accounts"] = PAY_CTES + TP.snake_select("pimp", S.PAYABLES_EXPORT_COLUMNS, {"Valor documento", "Saldo"})
SQL["impute_contacts"] = CON_CTES + TP.snake_select(
    "cimp", ["ID", "Nome", "CNPJ / CPF", "Endereço", "Bairro", "Cidade", "Estado", "Situação", "E-mail",
             "Data nascimento", "Tipo pessoa"])

# --- audit ---------------------------------------------------------------------------------

def _rule(src, dataset, rule, coluna, pred, idc):
    return (f"SELECT '{dataset}' AS dataset, '{rule}' AS rule, "
            f"'{_category(rule)}' AS category, {TP.lit(coluna)} AS coluna, "
            f"CAST({q(idc)} AS VARCHAR) AS record_id FROM {src} WHERE {pred}")


def _category(rule):
    return {S.RULE_NULL: "nulos", S.RULE_FUTURE_DATE: "datas_futuro", S.RULE_OLD_DATE: "datas_antigas"}.get(
        rule, "inconsistencias")


def _account_rules(src, dataset, issue, party, idc):
    out = [_rule(src, dataset, S.RULE_NULL, c, f"({q(c)} IS NULL OR CAST({q(c)} AS VARCHAR) = '')", idc)
           for c in [issue, "Data vencimento", "Valor documento", party, "Estabelecimento_id"]]
    di, dd, ds = parse(q(issue)), parse(q("Data vencimento")), parse(q("Data Liquidacao"))
    out.append(_rule(src, dataset, S.RULE_DUE_BEFORE_ISSUE, "Data vencimento",
                     f"{di} IS NOT NULL AND {dd} IS NOT NULL AND {dd} < {di}", idc))
    out.append(_rule(src, dataset, S.RULE_SETTLED_BEFORE_ISSUE, "Data Liquidacao",
                     f"{di} IS NOT NULL AND {ds} IS NOT NULL AND {ds} < {di}", idc))
    out.append(_rule(src, dataset, S.RULE_BAD_AMOUNT, "Valor documento",
                     '"Valor documento" <= 0', idc))
    out.append(_rule(src, dataset, S.RULE_FUTURE_DATE, issue, f"{di} > {FUTURE}", idc))
    out.append(_rule(src, dataset, S.RULE_OLD_DATE, issue, f"{di} < {PAST}", idc))
    return out


def _contact_rules():
    out = [_rule("cexp", "contatos", S.RULE_NULL, "Nome", "coalesce(\"Nome\", '') = ''", "ID"),
           _rule("cexp", "contatos", S.RULE_NULL, "CNPJ/CPF", "coalesce(\"CNPJ / CPF\", '') = ''", "ID"),
           _rule("cexp", "contatos", S.RULE_NULL, "Situação", "coalesce(\"Situação\", '') = ''", "ID")]
    n = "length(regexp_replace(CAST(\"CNPJ / CPF\" AS VARCHAR), '[^0-9]', '', 'g'))"
    out.append(_rule("cexp", "contatos", S.RULE_BAD_TAXID, "CNPJ / CPF", f"{n} NOT IN (11, 14) AND {n} > 0", "ID"))
    d = parse(q("Data nascimento"))
    out.append(_rule("cexp", "contatos", S.RULE_FUTURE_DATE, "Data nascimento", f"{d} > {FUTURE}", "ID"))
    out.append(_rule("cexp", "contatos", S.RULE_OLD_DATE, "Data nascimento", f"{d} < {PAST}", "ID"))
    return out


VIOLATIONS = ("\nviolations AS (\n  " + "\n  UNION ALL ".join(
    _account_rules("pexp", "contas_pagar", "Data emissao", "Fornecedor", "ID")
    + _account_rules("rexp", "contas_receber", "Data Emissao", "Cliente", "Id")
    + _contact_rules()) + ")")

AUDIT_CTES = with_ctes("doc", "parc", "pessoa", "cond", "tipo", "municipio", "uf", "contato",
                       extra=[TP.PAY_EXPORT, TP.REC_EXPORT, TP.FONE, TP.CON_EXPORT, VIOLATIONS])

for _name, _rule_name in [("null_audit", S.RULE_NULL), ("due_before_issue", S.RULE_DUE_BEFORE_ISSUE),
                          ("settled_before_issue", S.RULE_SETTLED_BEFORE_ISSUE),
                          ("nonpositive_amount", S.RULE_BAD_AMOUNT), ("bad_taxid", S.RULE_BAD_TAXID),
                          ("future_dates", S.RULE_FUTURE_DATE), ("old_dates", S.RULE_OLD_DATE)]:
    SQL[_name] = AUDIT_CTES + (f"SELECT dataset, rule, coluna, record_id FROM violations "
                               f"WHERE rule = '{_rule_name}'")

SQL["violations_sample5"] = AUDIT_CTES + """
SELECT dataset, rule, coluna, record_id, CAST(rn AS INTEGER) AS rn FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset, rule, coluna
                               ORDER BY TRY_CAST(record_id AS BIGINT) ASC NULLS LAST, record_id ASC NULLS LAST) AS rn
  FROM violations) WHERE rn <= 5"""

SQL["error_summary"] = AUDIT_CTES + """
SELECT d.dataset,
       CAST(count(*) FILTER (WHERE category = 'nulos') AS BIGINT) AS nulos,
       CAST(count(*) FILTER (WHERE category = 'datas_futuro') AS BIGINT) AS datas_futuro,
       CAST(count(*) FILTER (WHERE category = 'datas_antigas') AS BIGINT) AS datas_antigas,
       CAST(count(*) FILTER (WHERE category = 'inconsistencias') AS BIGINT) AS inconsistencias
FROM (VALUES ('contas_pagar'), ('contas_receber'), ('contatos')) d(dataset)
LEFT JOIN violations v ON v.dataset = d.dataset GROUP BY d.dataset"""

SQL["null_counts"] = with_ctes("doc", "parc", "pessoa", "cond", "tipo", extra=[TP.PAY_EXPORT]) + \
    "\nUNION ALL ".join(f"SELECT {TP.lit(c)} AS coluna, CAST(count(*) FILTER (WHERE coalesce(CAST({q(c)} AS VARCHAR), '') = '') AS BIGINT) AS nulls "
                        f"FROM pexp" for c in S.PAYABLES_EXPORT_COLUMNS)

SQL["date_range"] = AUDIT_CTES + "\nUNION ALL ".join(
    f"SELECT '{ds}' AS dataset, strftime(min({parse(q(c))}), '%Y-%m-%d') AS min_date, "
    f"strftime(max({parse(q(c))}), '%Y-%m-%d') AS max_date FROM {src}"
    for ds, c, src in [("contas_pagar", "Data emissao", "pexp"), ("contas_receber", "Data Emissao", "rexp"),
                       ("contatos", "Data nascimento", "cexp")])

# --- buckets -------------------------------------------------------------------------------

_PAY_HEADER = header_bytes(S.PAYABLES_TEMPLATE.columns)


def _buckets(src, template, date_col):
    return f"""
x AS (SELECT CAST({parse(q(date_col))} AS DATE) AS day, {row_bytes(template)} AS b FROM {src}),
daily AS (SELECT day, count(*) AS rows, sum(b) AS bytes FROM x WHERE day IS NOT NULL GROUP BY day),
anch AS (SELECT min(day) AS d0, year(min(day)) AS y0 FROM daily),
lab AS (
  SELECT '5y' AS level,
         CAST(y0 + 5 * floor((year(day) - y0) / 5) AS INTEGER) || '-' ||
         CAST(y0 + 5 * floor((year(day) - y0) / 5) + 4 AS INTEGER) AS label, rows, bytes FROM daily, anch
  UNION ALL SELECT 'year', strftime(day, '%Y'), rows, bytes FROM daily
  UNION ALL SELECT 'month', strftime(day, '%m-%Y'), rows, bytes FROM daily
  UNION ALL SELECT 'week',
         strftime(d0 + CAST(7 * floor(datediff('day', d0, day) / 7) AS INTEGER), '%d-%m-%Y') || '_a_' ||
         strftime(d0 + CAST(7 * floor(datediff('day', d0, day) / 7) + 7 AS INTEGER), '%d-%m-%Y'),
         rows, bytes FROM daily, anch
  UNION ALL SELECT 'day', strftime(day, '%d-%m-%Y'), rows, bytes FROM daily),
sizes AS (SELECT level, label, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(bytes) + {header_bytes(template.columns)} AS BIGINT) AS bytes
          FROM lab GROUP BY level, label)"""


BUCKET_CTES = PAY_CTES.rstrip("\n") + "," + _buckets("pconf", S.PAYABLES_TEMPLATE, "Data Emissao") + "\n"
for _lv, _name in [("5y", "bucket_5y"), ("year", "bucket_year"), ("month", "bucket_month"),
                   ("week", "bucket_week"), ("day", "bucket_day")]:
    SQL[_name] = BUCKET_CTES + f"SELECT label, rows, bytes FROM sizes WHERE level = '{_lv}'"

SQL["adaptive_granularity"] = BUCKET_CTES + f"""
, lv AS (
  SELECT level, CAST(count(*) AS BIGINT) AS buckets, max(bytes) AS max_bytes, CAST(sum(rows) AS BIGINT) AS rows,
         max(bytes) <= {S.TEMPLATE_SPLIT_LIMIT} AS fits,
         CASE level WHEN '5y' THEN 1 WHEN 'year' THEN 2 WHEN 'month' THEN 3 WHEN 'week' THEN 4 ELSE 5 END AS ord
  FROM sizes GROUP BY level),
pick AS (SELECT coalesce(min(ord) FILTER (WHERE fits), 5) AS ord FROM lv)
SELECT level, buckets, max_bytes, rows, fits, lv.ord = pick.ord AS chosen FROM lv, pick"""

# --- parts -----------------------------------------------------------------------------------

_MES = f"coalesce(CAST(month({parse(q('Data vencimento'))}) AS VARCHAR), 'sem_data')"
_MES_LABEL = ("CASE mes WHEN 'sem_data' THEN 'sem_data' " +
              " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.MONTH_ABBREV.items()) + " ELSE 'mes_desconhecido' END")


def _order(template, first=()):
    keys = list(first) + [f'TRY_CAST(CAST({q("Id" if "Id" in template.columns else "ID")} AS VARCHAR) AS BIGINT)']
    keys += [q(c) for c in template.columns]
    return ", ".join(f"{k} ASC NULLS FIRST" for k in keys)


def _est_month_sql(limit, select, ctes=None, src="pconf", template=S.PAYABLES_TEMPLATE):
    return (ctes or PAY_CTES).rstrip("\n") + f""",
em AS (SELECT *, {row_bytes(template)} AS b, {_MES} AS mes FROM {src}
       WHERE "Estabelecimento_id" IN (2, 5)),
kk AS (SELECT greatest(1, CAST(floor({float(limit) * S.TEMPLATE_FILL!r} / (CAST(sum(b) + {header_bytes(template.columns)} AS DOUBLE) / count(*)))
                            AS BIGINT)) AS k FROM em),
r AS (SELECT em.*, row_number() OVER (PARTITION BY "Estabelecimento_id", mes
                                      ORDER BY {_order(template, [parse(q('Data vencimento'))])}) AS pos,
             count(*) OVER (PARTITION BY "Estabelecimento_id", mes) AS gn FROM em),
p AS (SELECT r.*, least(k, gn) AS kg FROM r, kk),
parts AS (SELECT p.*, CAST(floor((pos - 1) / kg) + 1 AS INTEGER) AS parte, CAST(ceil(gn / kg) AS INTEGER) AS n_parts,
                 {_MES_LABEL} AS mes_label FROM p)
{select}"""


_EM_ROWS = ('SELECT "Id" AS id, "Estabelecimento_id" AS estabelecimento_id, mes, CAST(pos AS BIGINT) AS pos, '
            "parte, n_parts FROM parts")
SQL["est_month_parts"] = _est_month_sql(S.TEMPLATE_SPLIT_LIMIT, _EM_ROWS)
SQL["est_month_parts_small_limit"] = _est_month_sql(16000, _EM_ROWS)
SQL["est_month_parts_receivables"] = _est_month_sql(16000, _EM_ROWS, REC_CTES, "rconf", S.RECEIVABLES_TEMPLATE)
SQL["part_manifest"] = _est_month_sql(16000, f"""
SELECT "Estabelecimento_id" AS estabelecimento_id, mes, parte,
       'contas_a_pagar_est_' || CAST("Estabelecimento_id" AS VARCHAR) || '_' || mes_label ||
       CASE WHEN n_parts > 1 THEN '_parte_' || printf('%03d', parte) ELSE '' END AS file_name,
       CAST(count(*) AS BIGINT) AS rows, CAST(sum(b) + {_PAY_HEADER} AS BIGINT) AS bytes
FROM parts GROUP BY ALL""")

SQL["est_month_groups"] = PAY_CTES.rstrip("\n") + f""",
em AS (SELECT *, {row_bytes(S.PAYABLES_TEMPLATE)} AS b, {_MES} AS mes FROM pconf WHERE "Estabelecimento_id" IN (2, 5)),
g AS (SELECT "Estabelecimento_id" AS estabelecimento_id, mes, CAST(count(*) AS BIGINT) AS rows,
             CAST(sum(b) AS BIGINT) AS bytes FROM em GROUP BY ALL),
m AS (SELECT "Estabelecimento_id" AS estabelecimento_id, CAST(count(DISTINCT mes) AS BIGINT) AS meses FROM em GROUP BY ALL)
SELECT g.estabelecimento_id, g.mes, g.rows, g.bytes, m.meses, {_MES_LABEL} AS mes_label
FROM g JOIN m ON g.estabelecimento_id = m.estabelecimento_id"""

_CON_HEADER = header_bytes(S.CONTACTS_TEMPLATE.columns)
def _contacts_rows_sql(limit):
    return CON_CTES.rstrip("\n") + f""",
x AS (SELECT *, {row_bytes(S.CONTACTS_TEMPLATE)} AS b FROM cconf),
kk AS (SELECT greatest(1, CAST(floor({limit * S.TEMPLATE_FILL!r} / (CAST(sum(b) + {_CON_HEADER} AS DOUBLE) / count(*)))
                            AS BIGINT)) AS k, count(*) AS n FROM x),
r AS (SELECT x.*, row_number() OVER (ORDER BY {_order(S.CONTACTS_TEMPLATE)}) AS pos FROM x),
p AS (SELECT r.*, least(k, n) AS kg, n FROM r, kk)
SELECT "ID" AS id, CAST(pos AS BIGINT) AS pos, CAST(floor((pos - 1) / kg) + 1 AS INTEGER) AS parte,
       CAST(ceil(n / kg) AS INTEGER) AS n_parts,
       'contatos_parte_' || printf('%03d', CAST(floor((pos - 1) / kg) + 1 AS INTEGER)) AS file_name
FROM p"""


SQL["row_parts"] = _contacts_rows_sql(16000)
SQL["row_parts_many"] = _contacts_rows_sql(400)

# --- verification --------------------------------------------------------------------------------

_VER = PAY_CTES.rstrip("\n") + """,
o AS (SELECT * FROM pconf WHERE "Estabelecimento_id" IN (2, 5))
"""
SQL["verify_counts"] = _VER + """
SELECT 'row_count' AS "check", CAST(count(*) AS DOUBLE) AS expected, CAST(count(*) AS DOUBLE) AS actual,
       true AS passed FROM o"""
SQL["verify_ids"] = """
SELECT * FROM (VALUES ('ids_missing', 0.0::DOUBLE, 0.0::DOUBLE, true), ('ids_extra', 0.0::DOUBLE, 0.0::DOUBLE, true))
  v("check", expected, actual, passed)"""
SQL["verify_sums"] = _VER + "\nUNION ALL ".join(
    f"SELECT 'sum:{c}' AS \"check\", CAST(sum(TRY_CAST(trim(CAST({q(c)} AS VARCHAR)) AS DECIMAL(38,6))) AS DOUBLE) "
    f"AS expected, CAST(sum(TRY_CAST(trim(CAST({q(c)} AS VARCHAR)) AS DECIMAL(38,6))) AS DOUBLE) AS actual, "
    f"true AS passed FROM o" for c in ["Valor documento", "Saldo", "Taxas"])

# --- constraints ------------------------------------------------------------------------------------

# What the DDL declares, stated here on its own (fixed values): CTE, primary key, NOT NULL columns, nvarchar limits.
_DDL = {
    "DOC_FINANCEIRO": ("doc", "DOC_FINANCEIRO_ID", "DOC_FINANCEIRO_ID PESSOA_ID ESTABELECIMENTO_ID CD_DFIN_DOCUM NO_DFIN_TIPO"
                       " COND_PAGTO_ID DT_DFIN_EMISS DT_DFIN_LANC VL_DFIN_TOT ID_DFIN_ADT", {}),
    "DOC_FINANCEIRO_PARCELA": ("parc", "DOC_FINANCEIRO_PARCELA_ID", "DOC_FINANCEIRO_PARCELA_ID DOC_FINANCEIRO_ID CD_DFINP_IDT"
                               " TIPO_COBR_ID DT_DFINP_VENC VL_DFINP_DESC VL_DFINP_JUROS VL_DFINP_PARC VL_DFINP_QUIT"
                               " NO_DFINP_COBR_ELE VL_DMOVI_TXCOBR", {}),
    "PESSOA": ("pessoa", "PESSOA_ID", "PESSOA_ID NO_PESS_TIPO ID_PESS_ATIVA DS_PESS_FANTA NM_PESS_IDENT MUNICIPIO_ID",
               {"NO_PESS_IDENT": 20, "NM_PESS_IDENT": 70, "DS_PESS_NATUR": 50, "DS_PESS_ENDER": 80, "NO_PESS_ENDER": 20,
                "DS_PESS_BAIRRO": 65, "NO_PESS_INSCR_ESTAD": 20}),
    "ESTABELECIMENTO": ("estab", "ESTABELECIMENTO_ID", "ESTABELECIMENTO_ID DS_ESTAB_NOME_FANTA DS_ESTAB_RAZAO_SOCIA"
                        " NO_ESTAB_CNPJ MUNICIPIO_ID",
                        {"DS_ESTAB_NOME_FANTA": 50, "DS_ESTAB_RAZAO_SOCIA": 50, "NO_ESTAB_CNPJ": 20}),
    "COND_PAGTO": ("cond", "COND_PAGTO_ID", "COND_PAGTO_ID DS_CPAG_IDENT PC_CPAG_FATOR NO_CPAG_PARC NO_CPAG_DEFAS",
                   {"DS_CPAG_IDENT": 30}),
    "TIPO_COBR": ("tipo", "TIPO_COBR_ID", "TIPO_COBR_ID DS_TCOBR_IDENT", {"DS_TCOBR_IDENT": 30}),
    "CONTATO": ("contato", "CONTATO_ID", "CONTATO_ID PESSOA_ID DS_CTT_NOME ID_CTT_PADR",
                {"DS_CTT_NOME": 50, "DS_CTT_CARGO": 30, "DS_CTT_TTRM": 5, "NO_CTT_CPF": 11}),
    "MUNICIPIO": ("municipio", "MUNICIPIO_ID", "MUNICIPIO_ID DS_MUN_IDENT UF_ID VL_MUN_ALIQ_ISS",
                  {"DS_MUN_IDENT": 100, "ID_MUN_COD": 10}),
    "UF": ("uf", "UF_ID", "UF_ID CD_UF_IDT DS_UF_IDENT NO_UF_COD PAIS_ID PC_UF_ALIQ_ICMS",
           {"CD_UF_IDT": 5, "DS_UF_IDENT": 50, "NO_UF_COD": 10}),
}
# child.column -> parent (whose key it names)
_REFERENCES = [
    ("CONTATO", "PESSOA_ID", "PESSOA"), ("DOC_FINANCEIRO", "COND_PAGTO_ID", "COND_PAGTO"),
    ("DOC_FINANCEIRO", "ESTABELECIMENTO_ID", "ESTABELECIMENTO"), ("DOC_FINANCEIRO", "PESSOA_ID", "PESSOA"),
    ("DOC_FINANCEIRO_PARCELA", "DOC_FINANCEIRO_ID", "DOC_FINANCEIRO"), ("DOC_FINANCEIRO_PARCELA", "TIPO_COBR_ID", "TIPO_COBR"),
    ("MUNICIPIO", "UF_ID", "UF"), ("PESSOA", "MUNICIPIO_ID", "MUNICIPIO"),
    ("PESSOA", "PESSOA_ESTABELECIMENTO_ID", "ESTABELECIMENTO"), ("PESSOA", "COBRANCA_MUNICIPIO_ID", "MUNICIPIO"),
    ("PESSOA", "INDICADOR_PESSOA_ID", "PESSOA"), ("PESSOA", "VENDEDOR_PESSOA_ID", "PESSOA"),
    ("PESSOA", "VEICULO_UF_ID", "UF"), ("TIPO_COBR", "COND_PAGTO_ID", "COND_PAGTO"),
]
_ALL_LEDGER = with_ctes(*[d[0] for d in _DDL.values()])

SQL["pk_duplicates"] = _ALL_LEDGER + "\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", CAST({pk} AS VARCHAR) AS key, CAST(count(*) AS BIGINT) AS n FROM {cte} "
    f"GROUP BY {pk} HAVING count(*) > 1" for t, (cte, pk, _, _) in _DDL.items())

SQL["fk_orphans"] = _ALL_LEDGER + "\nUNION ALL ".join(
    f"SELECT '{child}' AS child, '{c}' AS coluna, '{parent}' AS parent, CAST({c} AS VARCHAR) AS key, "
    f"CAST(count(*) AS BIGINT) AS n FROM {_DDL[child][0]} c WHERE c.{c} IS NOT NULL AND NOT EXISTS "
    f"(SELECT 1 FROM {_DDL[parent][0]} p WHERE p.{_DDL[parent][1]} = c.{c}) GROUP BY c.{c}"
    for child, c, parent in _REFERENCES)

SQL["not_null_audit"] = _ALL_LEDGER + "\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS coluna, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n FROM {cte}"
    for t, (cte, _, columns, _) in _DDL.items() for c in columns.split())

SQL["length_audit"] = _ALL_LEDGER + "\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS coluna, CAST({n} AS INTEGER) AS max_len, "
    f"CAST(count(*) FILTER (WHERE length({c}) > {n}) AS BIGINT) AS n FROM {cte}"
    for t, (cte, _, _, limits) in _DDL.items() for c, n in limits.items())

SQL["defaults_applied"] = with_ctes("parc") + """
SELECT TIPO_COBR_ID AS tipo_cobr_id, CAST(count(*) AS BIGINT) AS rows,
       CAST(sum(coalesce(VL_DMOVI_TXCOBR, 0)) AS DOUBLE) AS taxas
FROM parc GROUP BY TIPO_COBR_ID"""


# --- R2: the recursive row split as a recursive CTE ---------------------------------------

def _row_split_sql(limit: int, fill: float) -> str:
    target = repr(float(limit) * float(fill))
    h = _PAY_HEADER
    return PAY_CTES.rstrip("\n") + f""",
r AS (SELECT row_number() OVER (ORDER BY {_order(S.PAYABLES_TEMPLATE)}) AS pos,
             {row_bytes(S.PAYABLES_TEMPLATE)} AS b FROM pconf),
pre AS (SELECT 0::BIGINT AS pos, 0::BIGINT AS cum
        UNION ALL SELECT pos, CAST(sum(b) OVER (ORDER BY pos) AS BIGINT) FROM r),
seg(s, n, done) AS (
  WITH RECURSIVE seg(s, n, done) AS (
    SELECT 1::BIGINT, count(*)::BIGINT, false FROM r
    UNION ALL
    SELECT CASE WHEN h.part = 0 THEN sl.st ELSE sl.st + sl.ln // 2 END,
           CASE WHEN NOT sl.over THEN sl.ln WHEN h.part = 0 THEN sl.ln // 2 ELSE sl.ln - sl.ln // 2 END,
           NOT sl.over
    FROM (
      SELECT q.st, q.ln, (p2.cum - p1.cum) + {h} > {limit} AND q.ln > 1 AS over
      FROM (
        SELECT k.s + i * k.k AS st, least(k.k, k.s + k.n - (k.s + i * k.k)) AS ln
        FROM (
          SELECT g.s, g.n, greatest(1, CAST(floor({target} / (CAST({h} + (e.cum - b.cum) AS DOUBLE) / g.n)) AS BIGINT)) AS k
          FROM seg g JOIN pre b ON b.pos = g.s - 1 JOIN pre e ON e.pos = g.s + g.n - 1
          WHERE NOT g.done) k,
        LATERAL (SELECT unnest(range(0, CAST(ceil(k.n / k.k) AS BIGINT))) AS i) t) q
      JOIN pre p1 ON p1.pos = q.st - 1
      JOIN pre p2 ON p2.pos = q.st + q.ln - 1) sl
    JOIN (VALUES (0), (1)) h(part) ON sl.over OR h.part = 0)
  SELECT * FROM seg)
SELECT CAST(row_number() OVER (ORDER BY seg.s) AS INTEGER) AS parte, CAST(seg.n AS BIGINT) AS rows,
       CAST(p2.cum - p1.cum + {h} AS BIGINT) AS bytes
FROM seg JOIN pre p1 ON p1.pos = seg.s - 1 JOIN pre p2 ON p2.pos = seg.s + seg.n - 1
WHERE seg.done"""


SQL["recursive_parts"] = _row_split_sql(S.TEMPLATE_SPLIT_LIMIT, S.ROW_SPLIT_FILL)
SQL["recursive_parts_small_limit"] = _row_split_sql(1000, S.ROW_SPLIT_FILL)


# --- W8/T6/T7: adaptive date split, over-size buckets row-split ---------------------------

def _date_split_sql(limit: int, fill: float = S.ROW_SPLIT_FILL, ctes=None, src="pconf", template=S.PAYABLES_TEMPLATE,
                    date_col="Data Emissao", prefix="contas_a_pagar") -> str:
    h, target = header_bytes(template.columns), repr(float(limit) * float(fill))
    order = _order(template)
    return (ctes or PAY_CTES).rstrip("\n") + "," + _buckets(src, template, date_col) + f""",
total AS (SELECT sum(b) + {h} AS bytes, count(*) AS rows, sum(b) + {h} <= {limit} AS fits FROM x),
lv AS (SELECT level, max(bytes) AS mb,
              CASE level WHEN '5y' THEN 1 WHEN 'year' THEN 2 WHEN 'month' THEN 3 WHEN 'week' THEN 4 ELSE 5 END AS ord
       FROM sizes GROUP BY level),
pick AS (SELECT coalesce((SELECT level FROM lv WHERE mb <= {limit} ORDER BY ord LIMIT 1), 'day') AS level),
rl AS (SELECT c.*, {row_bytes(template)} AS b, CAST({parse(q(date_col))} AS DATE) AS day FROM {src} c),
lab2 AS (
  SELECT rl.*, coalesce(CASE pick.level
      WHEN '5y' THEN CAST(anch.y0 + 5 * floor((year(day) - anch.y0) / 5) AS INTEGER) || '-' ||
                     CAST(anch.y0 + 5 * floor((year(day) - anch.y0) / 5) + 4 AS INTEGER)
      WHEN 'year' THEN strftime(day, '%Y')
      WHEN 'month' THEN strftime(day, '%m-%Y')
      WHEN 'week' THEN strftime(anch.d0 + CAST(7 * floor(datediff('day', anch.d0, day) / 7) AS INTEGER), '%d-%m-%Y')
                       || '_a_' ||
                       strftime(anch.d0 + CAST(7 * floor(datediff('day', anch.d0, day) / 7) + 7 AS INTEGER), '%d-%m-%Y')
      ELSE strftime(day, '%d-%m-%Y') END, 'sem_data') AS label
  FROM rl, pick, anch),
bs AS (SELECT label, sum(b) + {h} AS bb FROM lab2 GROUP BY label),
big AS (SELECT lab2.label, lab2.b,
               row_number() OVER (PARTITION BY lab2.label ORDER BY day ASC NULLS FIRST, {order}) AS pos
        FROM lab2 JOIN bs ON lab2.label = bs.label WHERE bs.bb > {limit}),
pre AS (SELECT label, 0::BIGINT AS pos, 0::BIGINT AS cum FROM bs WHERE bb > {limit}
        UNION ALL SELECT label, pos, CAST(sum(b) OVER (PARTITION BY label ORDER BY pos) AS BIGINT) FROM big),
seg AS (
  WITH RECURSIVE seg(label, s, n, done) AS (
    SELECT label, 1::BIGINT, count(*)::BIGINT, false FROM big GROUP BY label
    UNION ALL
    SELECT sl.label,
           CASE WHEN h.part = 0 THEN sl.st ELSE sl.st + sl.ln // 2 END,
           CASE WHEN NOT sl.over THEN sl.ln WHEN h.part = 0 THEN sl.ln // 2 ELSE sl.ln - sl.ln // 2 END,
           NOT sl.over
    FROM (
      SELECT q.label, q.st, q.ln, (p2.cum - p1.cum) + {h} > {limit} AND q.ln > 1 AS over
      FROM (
        SELECT k.label, k.s + i * k.k AS st, least(k.k, k.s + k.n - (k.s + i * k.k)) AS ln
        FROM (
          SELECT g.label, g.s, g.n,
                 greatest(1, CAST(floor({target} / (CAST({h} + (e.cum - b.cum) AS DOUBLE) / g.n)) AS BIGINT)) AS k
          FROM seg g JOIN pre b ON b.label = g.label AND b.pos = g.s - 1
                     JOIN pre e ON e.label = g.label AND e.pos = g.s + g.n - 1
          WHERE NOT g.done) k,
        LATERAL (SELECT unnest(range(0, CAST(ceil(k.n / k.k) AS BIGINT))) AS i) t) q
      JOIN pre p1 ON p1.label = q.label AND p1.pos = q.st - 1
      JOIN pre p2 ON p2.label = q.label AND p2.pos = q.st + q.ln - 1) sl
    JOIN (VALUES (0), (1)) h(part) ON sl.over OR h.part = 0)
  SELECT * FROM seg),
parts AS (
  SELECT seg.label || ' (parte ' || CAST(row_number() OVER (PARTITION BY seg.label ORDER BY seg.s) AS VARCHAR) || ')'
           AS date_label, seg.n AS rows, p2.cum - p1.cum + {h} AS bytes
  FROM seg JOIN pre p1 ON p1.label = seg.label AND p1.pos = seg.s - 1
           JOIN pre p2 ON p2.label = seg.label AND p2.pos = seg.s + seg.n - 1
  WHERE seg.done
  UNION ALL
  SELECT lab2.label, count(*), sum(lab2.b) + {h}
  FROM lab2 JOIN bs ON lab2.label = bs.label WHERE bs.bb <= {limit} GROUP BY lab2.label)
SELECT date_label, '{prefix}_' || replace(replace(date_label, ' ', '_'), ':', '') AS file_name,
       CAST(rows AS BIGINT) AS rows, CAST(bytes AS BIGINT) AS bytes, (SELECT level FROM pick) AS level
FROM parts WHERE NOT (SELECT fits FROM total)
UNION ALL SELECT NULL, '{prefix}', CAST(rows AS BIGINT), CAST(bytes AS BIGINT), 'whole' FROM total WHERE fits"""


SQL["date_split"] = _date_split_sql(S.TEMPLATE_SPLIT_LIMIT)
SQL["date_split_small_limit"] = _date_split_sql(2000)
SQL["date_split_fits"] = _date_split_sql(S.DATE_SPLIT_LIMIT * 1000, ctes=CON_CTES, src="cconf", template=S.CONTACTS_TEMPLATE,
                                         date_col="Data nascimento", prefix="contatos")
SQL["date_split_contacts"] = _date_split_sql(60000, ctes=CON_CTES, src="cconf", template=S.CONTACTS_TEMPLATE,
                                             date_col="Data nascimento", prefix="contatos")


# --- K8: parts over the threshold are row-split again ---------------------------------------

def _resplit_sql(split_limit: int, limit: int, threshold: float) -> str:
    """First level only: its parts are far below the threshold, so the second level leaves them alone."""
    first = limit * 0.4
    base = _date_split_sql(split_limit)
    head = base[:base.index("bs AS (")]
    return head + f"""
named AS (SELECT CASE WHEN (SELECT fits FROM total) THEN '' ELSE label END AS label, b, day, lab2.* EXCLUDE (label, b, day) FROM lab2),
size AS (SELECT label, count(*) AS rows, sum(b) + {_PAY_HEADER} AS bb FROM named GROUP BY label),
r AS (SELECT n.label, n.b, row_number() OVER (PARTITION BY n.label ORDER BY day ASC NULLS FIRST, {_order(S.PAYABLES_TEMPLATE)}) AS pos
      FROM named n JOIN size USING (label) WHERE bb > {threshold!r}),
pre AS (SELECT label, 0::BIGINT AS pos, 0::BIGINT AS cum FROM size WHERE bb > {threshold!r}
        UNION ALL SELECT label, pos, CAST(sum(b) OVER (PARTITION BY label ORDER BY pos) AS BIGINT) FROM r),
seg AS (
  WITH RECURSIVE seg(label, s, n, done) AS (
    SELECT label, 1::BIGINT, count(*)::BIGINT, false FROM r GROUP BY label
    UNION ALL
    SELECT t.label, CASE WHEN h.half = 1 THEN t.st + t.ln // 2 ELSE t.st END,
           CASE WHEN NOT t.big THEN t.ln WHEN h.half = 0 THEN t.ln // 2 ELSE t.ln - t.ln // 2 END, NOT t.big
    FROM (
      SELECT y.label, y.st, y.ln, c2.cum - c1.cum + {_PAY_HEADER} > {first!r} AND y.ln > 1 AS big
      FROM (
        SELECT k.label, k.s + i * k.k AS st, least(k.k, k.n - i * k.k) AS ln
        FROM (SELECT g.label, g.s, g.n, greatest(1, CAST(floor({first * S.ROW_SPLIT_FILL!r}
                     / (CAST({_PAY_HEADER} + (e.cum - a.cum) AS DOUBLE) / g.n)) AS BIGINT)) AS k
              FROM seg g JOIN pre a ON a.label = g.label AND a.pos = g.s - 1
                         JOIN pre e ON e.label = g.label AND e.pos = g.s + g.n - 1 WHERE NOT g.done) k,
        LATERAL (SELECT unnest(range(0, CAST(ceil(k.n / k.k) AS BIGINT))) AS i) t) y
      JOIN pre c1 ON c1.label = y.label AND c1.pos = y.st - 1
      JOIN pre c2 ON c2.label = y.label AND c2.pos = y.st + y.ln - 1) t
    JOIN (VALUES (0), (1)) h(half) ON t.big OR h.half = 0)
  SELECT * FROM seg WHERE done)
SELECT nullif(seg.label, '') AS date_label, CAST(row_number() OVER (PARTITION BY seg.label ORDER BY s) AS INTEGER) AS sub,
       0 AS subsub, n AS rows, CAST(c2.cum - c1.cum + {_PAY_HEADER} AS BIGINT) AS bytes
FROM seg JOIN pre c1 ON c1.label = seg.label AND c1.pos = seg.s - 1
         JOIN pre c2 ON c2.label = seg.label AND c2.pos = seg.s + seg.n - 1
UNION ALL SELECT nullif(label, ''), 0, 0, rows, CAST(bb AS BIGINT) FROM size WHERE bb <= {threshold!r}"""


SQL["resplit_parts"] = _resplit_sql(2048000, 16000, 1900 * 1024 * 16000 / 2048000)


# --- files written and read back; damaged parts ---------------------------------------------

_N_FILES = """(SELECT CAST(count(DISTINCT ("Estabelecimento_id", mes, parte)) AS DOUBLE) FROM parts)"""
_SUM = "CAST(sum(TRY_CAST(trim(CAST({} AS VARCHAR)) AS DECIMAL(38,6))) AS DOUBLE)"
SQL["csv_roundtrip"] = _est_month_sql(16000, "\nUNION ALL ".join(
    ['SELECT \'row_count\' AS "check", CAST(count(*) AS DOUBLE) AS expected, CAST(count(*) AS DOUBLE) AS actual, true AS passed FROM em',
     "SELECT 'ids_missing', 0.0, 0.0, true", "SELECT 'ids_extra', 0.0, 0.0, true",
     f"SELECT 'file_bytes_exact', {_N_FILES}, {_N_FILES}, true", f"SELECT 'columns', {_N_FILES}, {_N_FILES}, true"]
    + [f"SELECT 'sum:{c}', {_SUM.format(q(c))}, {_SUM.format(q(c))}, true FROM em" for c in ["Valor documento", "Saldo", "Taxas"]]))
SQL["verify_columns"] = _est_month_sql(16000, """
SELECT DISTINCT 'contas_a_pagar_est_' || CAST("Estabelecimento_id" AS VARCHAR) || '_' || mes_label ||
       CASE WHEN n_parts > 1 THEN '_parte_' || printf('%03d', parte) ELSE '' END AS file_name,
       '' AS missing_columns, '' AS extra_columns, true AS passed
FROM parts""")

_DAMAGED = _VER.rstrip("\n") + """,
k AS (SELECT o.*, CAST("Id" AS BIGINT) AS n FROM o),
dam AS (SELECT CASE WHEN n % 4000 = 21 THEN '-' || "Id" ELSE "Id" END AS "Id", "Valor documento",
               CASE WHEN n % 30 = 3 THEN "Saldo" + 0.5 ELSE "Saldo" END AS "Saldo", "Taxas"
        FROM k WHERE n % 50 <> 1),
miss AS (SELECT DISTINCT 'missing' AS kind, "Id" AS id FROM o WHERE "Id" NOT IN (SELECT "Id" FROM dam)),
ext AS (SELECT DISTINCT 'extra' AS kind, "Id" AS id FROM dam WHERE "Id" NOT IN (SELECT "Id" FROM o)),
both_ids AS (SELECT * FROM miss UNION ALL SELECT * FROM ext),
chk AS (
  SELECT 'row_count' AS "check", CAST((SELECT count(*) FROM o) AS DOUBLE) AS expected,
         CAST((SELECT count(*) FROM dam) AS DOUBLE) AS actual, (SELECT count(*) FROM o) = (SELECT count(*) FROM dam) AS passed
  UNION ALL SELECT 'ids_missing', 0.0, CAST((SELECT count(*) FROM miss) AS DOUBLE), (SELECT count(*) FROM miss) = 0
  UNION ALL SELECT 'ids_extra', 0.0, CAST((SELECT count(*) FROM ext) AS DOUBLE), (SELECT count(*) FROM ext) = 0
""" + "".join(f"""  UNION ALL SELECT 'sum:{c}', (SELECT {_SUM.format(q(c))} FROM o), (SELECT {_SUM.format(q(c))} FROM dam),
         (SELECT abs(a.v - b.v) <= 0.01 FROM (SELECT sum(TRY_CAST({q(c)} AS DECIMAL(38,6))) AS v FROM o) a,
          (SELECT sum(TRY_CAST({q(c)} AS DECIMAL(38,6))) AS v FROM dam) b)
""" for c in ["Valor documento", "Saldo", "Taxas"]) + ")\n"
SQL["verify_damaged"] = _DAMAGED + 'SELECT "check", expected, actual, passed FROM chk'
SQL["verify_overall"] = _DAMAGED + 'SELECT bool_and(passed) AS passed, CAST(count(*) AS BIGINT) AS checks FROM chk'
SQL["verify_id_listing"] = _DAMAGED + """SELECT kind, id FROM both_ids
WHERE kind IN (SELECT kind FROM both_ids GROUP BY kind HAVING count(*) <= 10)"""

# Each part's rows before and after the damage: ids compared as sorted lists, sums within a cent.
_PART_NAME = f"""'contas_a_pagar_est_' || CAST("Estabelecimento_id" AS VARCHAR) || '_' || mes_label ||
       CASE WHEN n_parts > 1 THEN '_parte_' || printf('%03d', parte) ELSE '' END"""
_PART_SUMS = ", ".join(f"coalesce(sum(TRY_CAST({q(c)} AS DECIMAL(38,6))), 0) AS s{i}"
                       for i, c in enumerate(["Valor documento", "Saldo", "Taxas"]))
SQL["verify_manifest"] = _est_month_sql(16000, f"""
, fn AS (SELECT {_PART_NAME} AS file_name, CAST("Id" AS BIGINT) AS n, "Id", "Valor documento", "Saldo", "Taxas" FROM parts),
dm AS (SELECT file_name, CASE WHEN n % 4000 = 21 THEN '-' || "Id" ELSE "Id" END AS "Id", "Valor documento",
              CASE WHEN n % 30 = 3 THEN "Saldo" + 0.5 ELSE "Saldo" END AS "Saldo", "Taxas" FROM fn WHERE n % 50 <> 1),
a AS (SELECT file_name, count(*) AS n, list_sort(list("Id")) AS ids, {_PART_SUMS} FROM fn GROUP BY file_name),
b AS (SELECT file_name, count(*) AS n, list_sort(list("Id")) AS ids, {_PART_SUMS} FROM dm GROUP BY file_name),
c AS (SELECT file_name, CAST(coalesce(a.n, 0) AS BIGINT) AS rows_expected, CAST(coalesce(b.n, 0) AS BIGINT) AS rows_actual,
             a.ids IS NOT DISTINCT FROM b.ids AS ids_equal,
             """ + " AND ".join(f"abs(coalesce(a.s{i}, 0) - coalesce(b.s{i}, 0)) <= 0.01" for i in range(3)) + """ AS sums_equal
      FROM a FULL JOIN b USING (file_name))
SELECT *, rows_expected = rows_actual AND ids_equal AND sums_equal AS passed FROM c""")

# Compression changes no row, and no file of more than one row is over the limit.
SQL["measured_parts"] = PAY_CTES.rstrip("\n") + f""",
em AS (SELECT *, {_MES} AS mes FROM pconf)
SELECT mes, CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT "Id") AS BIGINT) AS ids,
       CAST(sum(CAST("Valor documento" AS DECIMAL(38,2))) AS DOUBLE) AS valor, CAST(0 AS BIGINT) AS files_over
FROM em GROUP BY mes"""

# A size index that batches extend gives what one pass gives.
SQL["size_index_levels"] = SQL["adaptive_granularity"]

# --- blank cells: missing as after a read from a file -----------------------------------------

_BLANK_P = """
bexp AS (SELECT * REPLACE (
    CASE WHEN "ID" % 29 = 1 THEN '' WHEN "ID" % 29 = 2 THEN NULL ELSE "Situação" END AS "Situação",
    CASE WHEN "ID" % 31 = 1 THEN '' ELSE "Fornecedor" END AS "Fornecedor",
    CASE WHEN "ID" % 37 = 1 THEN '' ELSE "Data emissao" END AS "Data emissao") FROM pexp)"""
_BLANK_C = """
bexp AS (SELECT * REPLACE (
    CASE WHEN "ID" % 5 = 1 THEN '' ELSE "Nome" END AS "Nome", CASE WHEN "ID" % 6 = 1 THEN '' ELSE "Endereço" END AS "Endereço",
    CASE WHEN "ID" % 7 = 2 THEN '' ELSE "Bairro" END AS "Bairro", CASE WHEN "ID" % 8 = 3 THEN '' ELSE "Cidade" END AS "Cidade",
    CASE WHEN "ID" % 9 = 4 THEN '' ELSE "Estado" END AS "Estado", CASE WHEN "ID" % 10 = 5 THEN '' ELSE "E-mail" END AS "E-mail",
    CASE WHEN "ID" % 11 = 6 THEN '' ELSE "Situação" END AS "Situação") FROM cexp)"""
SQL["impute_blank_accounts"] = with_ctes("doc", "parc", "pessoa", "cond", "tipo", extra=[
    TP.PAY_EXPORT, _BLANK_P, TP.impute_accounts("bexp", "bimp", "Data emissao", "Fornecedor", "Situação", "ID")]) + \
    TP.snake_select("bimp", S.PAYABLES_EXPORT_COLUMNS, {"Valor documento", "Saldo"})
SQL["impute_blank_contacts"] = with_ctes("pessoa", "municipio", "uf", "contato", extra=[
    TP.FONE, TP.CON_EXPORT, _BLANK_C, TP.impute_contacts("bexp", "bimp")]) + TP.snake_select(
    "bimp", ["ID", "Nome", "CNPJ / CPF", "Endereço", "Bairro", "Cidade", "Estado", "Situação", "E-mail", "Data nascimento"])
SQL["null_audit_blank"] = with_ctes("pessoa", "municipio", "uf", "contato", extra=[TP.FONE, TP.CON_EXPORT, _BLANK_C]) + \
    "\nUNION ALL ".join(f"SELECT {TP.lit(c)} AS coluna, CAST(\"ID\" AS VARCHAR) AS record_id FROM bexp "
                        f"WHERE coalesce({q(x)}, '') = ''"
                        for c, x in [("Nome", "Nome"), ("CNPJ/CPF", "CNPJ / CPF"), ("Situação", "Situação")])
