"""SQL builders for the export / impute / conform / byte-size steps (DuckDB dialect)."""

from __future__ import annotations

from tally import schemas as S
from tally.schemas import snake

AS_OF = "TIMESTAMP '2001-01-01 00:00:00'"
FUTURE = "TIMESTAMP '2011-01-01 00:00:00'"
PAST = "TIMESTAMP '1981-01-01 00:00:00'"


def q(label: str) -> str:
    return '"' + label.replace('"', '""') + '"'


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def parse(x: str) -> str:
    s = f"trim(CAST({x} AS VARCHAR))"
    return ("CAST(coalesce("
            f"CAST(try_strptime({s}, '%d/%m/%Y') AS DATE), "
            f"CAST(try_strptime({s}, '%Y-%m-%d') AS DATE), "
            f"CAST(try_strptime({s}, '%Y-%m-%d %H:%M:%S') AS DATE)) AS TIMESTAMP)")


def fmt(ts: str) -> str:
    return f"strftime({ts}, '%d/%m/%Y')"


def field_bytes(s: str, first: bool = False) -> str:
    lead = f" OR starts_with({s}, '#')" if first else ""
    return (f"CASE WHEN {s} IS NULL THEN 0 "
            rf"""WHEN regexp_matches({s}, '[,"\r\n]'){lead} """
            f"""THEN strlen({s}) + 2 + (length({s}) - length(replace({s}, '"', ''))) """
            f"ELSE strlen({s}) END")


def row_bytes(template: S.Template) -> str:
    parts = []
    for i, label in enumerate(template.columns):
        kind = template.kind(label)
        s = q(label) if kind not in ("money", "int", "flag") else f"CAST({q(label)} AS VARCHAR)"
        parts.append(f"({field_bytes(s, first=(i == 0))})")
    return f"CAST({len(template.columns)} + " + " + ".join(parts) + " AS BIGINT)"


def header_bytes(columns) -> int:
    total = 3 + len(columns)
    for i, c in enumerate(columns):
        b = len(c.encode("utf-8"))
        if any(ch in c for ch in ',"\r\n') or (i == 0 and c.startswith("#")):
            b += 2 + c.count('"')
        total += b
    return total


# --- export (labels, dates as dd/MM/yyyy) ----------------------------------------------

_EXPORT_FROM = """
  FROM parc i
  JOIN doc d ON i.DOC_FINANCEIRO_ID = d.DOC_FINANCEIRO_ID
  JOIN pessoa p ON d.PESSOA_ID = p.PESSOA_ID
  LEFT JOIN cond cp ON d.COND_PAGTO_ID = cp.COND_PAGTO_ID
  LEFT JOIN tipo tc ON i.TIPO_COBR_ID = tc.TIPO_COBR_ID"""

SALDO = "CASE WHEN i.DT_DFINP_QUIT IS NOT NULL THEN CAST(0 AS DECIMAL(22,6)) ELSE i.VL_DFINP_PARC END"
SITUACAO = "CASE WHEN i.DT_DFINP_QUIT IS NULL THEN 'Em Aberto' ELSE 'Liquidado' END"

PAY_EXPORT = f"""
pexp AS (
  SELECT i.DOC_FINANCEIRO_PARCELA_ID AS "ID", p.NM_PESS_IDENT AS "Fornecedor",
         {fmt('d.DT_DFIN_EMISS')} AS "Data emissao", {fmt('i.DT_DFINP_VENC')} AS "Data vencimento",
         {fmt('i.DT_DFINP_QUIT')} AS "Data Liquidacao", i.VL_DFINP_PARC AS "Valor documento",
         {SALDO} AS "Saldo", {SITUACAO} AS "Situação", d.CD_DFIN_DOCUM AS "Numero documento",
         cp.DS_CPAG_IDENT AS "Categoria", i.DS_DFINP_HIST AS "Historico",
         CASE WHEN i.DT_DFINP_QUIT IS NOT NULL THEN 'Sim' ELSE 'Não' END AS "Pago",
         strftime(d.DT_DFIN_EMISS, '%Y-%m') AS "Competencia", tc.DS_TCOBR_IDENT AS "Forma Pagamento",
         d.ESTABELECIMENTO_ID AS "Estabelecimento_id"
  {_EXPORT_FROM}
  WHERE d.NO_DFIN_TIPO = 2 AND d.ESTABELECIMENTO_ID IN (2, 5))"""

REC_EXPORT = f"""
rexp AS (
  SELECT i.DOC_FINANCEIRO_PARCELA_ID AS "Id", p.NM_PESS_IDENT AS "Cliente",
         {fmt('d.DT_DFIN_EMISS')} AS "Data Emissao", {fmt('i.DT_DFINP_VENC')} AS "Data vencimento",
         {fmt('i.DT_DFINP_QUIT')} AS "Data Liquidacao", i.VL_DFINP_PARC AS "Valor documento",
         {SALDO} AS "Saldo", {SITUACAO} AS "Situacao", d.CD_DFIN_DOCUM AS "Numero do documento",
         i.NO_DFINP_COBR_ELE AS "Numero no banco", cp.DS_CPAG_IDENT AS "Categoria",
         i.DS_DFINP_HIST AS "Historico", tc.DS_TCOBR_IDENT AS "Forma de recebimento",
         '' AS "Meio de recebimento", CAST(0 AS DECIMAL(22,6)) AS "Taxas",
         d.ESTABELECIMENTO_ID AS "Estabelecimento_id"
  {_EXPORT_FROM}
  WHERE d.NO_DFIN_TIPO = 1 AND d.ESTABELECIMENTO_ID IN (2, 5))"""

FONE = """
fone AS (
  SELECT PESSOA_ID, arg_min(DS_CTT_TTRM, CONTATO_ID) AS Fone
  FROM contato WHERE ID_CTT_PADR GROUP BY PESSOA_ID)"""

CON_EXPORT = f"""
cexp AS (
  SELECT p.PESSOA_ID AS "ID", p.NO_PESS_IDENT AS "Código", p.NM_PESS_IDENT AS "Nome",
         p.DS_PESS_FANTA AS "Fantasia", p.DS_PESS_ENDER AS "Endereço", p.NO_PESS_ENDER AS "Número",
         p.DS_PESS_ENDER_COMPL AS "Complemento", p.DS_PESS_BAIRRO AS "Bairro", p.NO_PESS_CEP AS "CEP",
         m.DS_MUN_IDENT AS "Cidade", u.CD_UF_IDT AS "Estado", p.DS_PESS_ENDER_REFER AS "Observações do contato",
         f.Fone AS "Fone", '' AS "Fax", '' AS "Celular", p.NO_PESS_EMAIL_COBR AS "E-mail", '' AS "Web Site",
         CASE p.NO_PESS_TIPO WHEN 1 THEN 'Física' WHEN 2 THEN 'Jurídica' ELSE 'Outro' END AS "Tipo pessoa",
         p.NO_PESS_CNPJ_CPF AS "CNPJ / CPF", p.NO_PESS_INSCR_ESTAD AS "IE / RG", 'Não' AS "IE isento",
         CASE WHEN p.ID_PESS_ATIVA THEN 'Ativo' ELSE 'Inativo' END AS "Situação", p.DS_PESS_OBS AS "Observações",
         CASE p.NO_PESS_EST_CIVIL WHEN 1 THEN 'Solteiro(a)' WHEN 2 THEN 'Casado(a)' WHEN 3 THEN 'Divorciado(a)'
              WHEN 4 THEN 'Viúvo(a)' ELSE '' END AS "Estado civil",
         p.DS_PESS_CARG AS "Profissão",
         CASE p.NO_PESS_SEXO WHEN 1 THEN 'Masculino' WHEN 2 THEN 'Feminino' ELSE 'Outro' END AS "Sexo",
         {fmt('p.DT_PESS_NASC')} AS "Data nascimento", p.DS_PESS_NATUR AS "Naturalidade",
         '' AS "Nome pai", '' AS "CPF pai", '' AS "Nome mãe", '' AS "CPF mãe", '' AS "Lista de Preço",
         '' AS "Vendedor", p.NO_PESS_EMAIL_COBR AS "E-mail para envio de NFe", '' AS "Tipos de Contatos",
         CASE WHEN p.NO_PESS_TIPO = 2 THEN 1 ELSE 0 END AS "Contribuinte",
         '' AS "Código de regime tributário", 0 AS "Limite de crédito"
  FROM pessoa p
  LEFT JOIN municipio m ON p.MUNICIPIO_ID = m.MUNICIPIO_ID
  LEFT JOIN uf u ON m.UF_ID = u.UF_ID
  LEFT JOIN fone f ON p.PESSOA_ID = f.PESSOA_ID)"""


# --- imputation ---------------------------------------------------------------------------

def _ident(idc: str) -> str:
    return f"coalesce(CAST({q(idc)} AS VARCHAR), '')"


def impute_accounts(src: str, name: str, issue: str, party: str, status: str, idc: str) -> str:
    issue_v = f"coalesce({parse(q(issue))}, {AS_OF})"
    return f"""
{name} AS (
  SELECT * REPLACE (
    {fmt(issue_v)} AS {q(issue)},
    {fmt(f"coalesce({parse(q('Data vencimento'))}, {issue_v})")} AS "Data vencimento",
    coalesce(nullif({q(party)}, ''), 'Cliente ' || {_ident(idc)}) AS {q(party)},
    coalesce("Valor documento", CAST(1.00 AS DECIMAL(22,6))) AS "Valor documento",
    coalesce(nullif({q(status)}, ''), 'Em Aberto') AS {q(status)})
  FROM {src})"""


PAY_IMPUTE = impute_accounts("pexp", "pimp", "Data emissao", "Fornecedor", "Situação", "ID")
REC_IMPUTE = impute_accounts("rexp", "rimp", "Data Emissao", "Cliente", "Situacao", "Id")

def impute_contacts(src: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT * REPLACE (
    {fmt(f"coalesce({parse(q('Data nascimento'))}, {AS_OF})")} AS "Data nascimento",
    coalesce(nullif(CAST("CNPJ / CPF" AS VARCHAR), ''), CASE WHEN "Tipo pessoa" = 'Jurídica' THEN '00000000000000'
             ELSE '00000000000' END) AS "CNPJ / CPF",
    coalesce(nullif("Nome", ''), 'Cliente ' || {_ident('ID')}) AS "Nome",
    coalesce(nullif("Endereço", ''), 'N/A') AS "Endereço",
    coalesce(nullif("Bairro", ''), 'N/A') AS "Bairro",
    coalesce(nullif("Cidade", ''), 'N/A') AS "Cidade",
    coalesce(nullif("Situação", ''), 'N/A') AS "Situação",
    coalesce(nullif("Estado", ''), 'UF') AS "Estado",
    coalesce(nullif("E-mail", ''), 'contato' || {_ident('ID')} || '@exemplo.com') AS "E-mail")
  FROM {src})"""


CON_IMPUTE = impute_contacts("cexp", "cimp")


# --- conform to template -------------------------------------------------------------------

def _blank(x: str) -> str:
    return f"(CAST({x} AS VARCHAR) IS NULL OR CAST({x} AS VARCHAR) = '')"


def conform_expr(x: str | None, kind: str, numeric_source: bool) -> str:
    if x is None:
        return {"money": "CAST(0 AS DECIMAL(22,6))", "int": "0", "flag": "0"}.get(kind, "''")
    if kind == "money":
        v = f"CAST({x} AS DECIMAL(22,6))" if numeric_source else f"TRY_CAST(trim(CAST({x} AS VARCHAR)) AS DECIMAL(22,6))"
        return f"coalesce({v}, CAST(0 AS DECIMAL(22,6)))"
    if kind == "int":
        v = f"CAST({x} AS INTEGER)" if numeric_source else \
            f"CAST(TRY_CAST(trim(CAST({x} AS VARCHAR)) AS DECIMAL(22,6)) AS INTEGER)"
        return f"coalesce({v}, 0)"
    if kind == "flag":
        v = f"CAST({x} AS DECIMAL(22,6))" if numeric_source else f"TRY_CAST(trim(CAST({x} AS VARCHAR)) AS DECIMAL(22,6))"
        return f"CASE WHEN {v} > 0 THEN 1 ELSE 0 END"
    if kind == "date":
        return f"coalesce({fmt(parse(x))}, '')"
    t = f"CAST({x} AS VARCHAR)"
    if kind == "status":
        return f"CASE WHEN {_blank(x)} THEN '' WHEN lower({t}) = 'liquidado' THEN 'paga' ELSE {t} END"
    if kind == "taxid":
        return f"CASE WHEN {_blank(x)} THEN '' ELSE regexp_replace({t}, '[^0-9]', '', 'g') END"
    return f"CASE WHEN {_blank(x)} THEN '' ELSE {t} END"


def conform(src: str, name: str, template: S.Template, source_cols, numeric_cols, renames=None) -> str:
    inv = {}
    for a, b in (renames or {}).items():
        if a in source_cols:
            inv.setdefault(b, a)
    cols = []
    for label in template.columns:
        srcc = label if label in source_cols else inv.get(label)
        x = q(srcc) if srcc else None
        cols.append(f"{conform_expr(x, template.kind(label), srcc in numeric_cols)} AS {q(label)}")
    return f"\n{name} AS (\n  SELECT " + ",\n         ".join(cols) + f"\n  FROM {src})"


PAY_NUMERIC = {"ID", "Valor documento", "Saldo", "Estabelecimento_id"}
REC_NUMERIC = {"Id", "Valor documento", "Saldo", "Numero no banco", "Taxas", "Estabelecimento_id"}
CON_NUMERIC = {"ID", "Contribuinte", "Limite de crédito"}

PAY_CONFORM = conform("pimp", "pconf", S.PAYABLES_TEMPLATE, S.PAYABLES_EXPORT_COLUMNS, PAY_NUMERIC, S.PAYABLES_RENAMES)
REC_CONFORM = conform("rimp", "rconf", S.RECEIVABLES_TEMPLATE, S.RECEIVABLES_EXPORT_COLUMNS, REC_NUMERIC)
CON_CONFORM = conform("cimp", "cconf", S.CONTACTS_TEMPLATE, S.CONTACTS_COLUMNS, CON_NUMERIC)


def snake_select(src: str, columns, money=(), alias_map=None) -> str:
    out = []
    for c in columns:
        e = q(c)
        if c in money:
            e = f"CAST({e} AS DOUBLE)"
        out.append(f"{e} AS {snake(c)}")
    return "SELECT " + ", ".join(out) + f" FROM {src}"


def money_cols(template: S.Template):
    return {c for c in template.columns if template.kind(c) == "money"}
