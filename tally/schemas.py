"""Schemas, templates and the fixed values the outputs must reproduce.

Everything in the "fixed values" block below is data, not logic: column labels
of the import templates, decode tables, tokens and limits.  They are kept
together, in their natural order, because downstream systems read these exact
strings.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's spellings and numbers).
# ---------------------------------------------------------------------------

# Export column lists (what the ledger queries produce).
PAYABLES_EXPORT_COLUMNS = [
    "ID", "Fornecedor", "Data emissao", "Data vencimento", "Data Liquidacao",
    "Valor documento", "Saldo", "Situação", "Numero documento", "Categoria",
    "Historico", "Pago", "Competencia", "Forma Pagamento", "Estabelecimento_id",
]
RECEIVABLES_EXPORT_COLUMNS = [
    "Id", "Cliente", "Data Emissao", "Data vencimento", "Data Liquidacao",
    "Valor documento", "Saldo", "Situacao", "Numero do documento", "Numero no banco",
    "Categoria", "Historico", "Forma de recebimento", "Meio de recebimento",
    "Taxas", "Estabelecimento_id",
]
CONTACTS_COLUMNS = [
    "ID", "Código", "Nome", "Fantasia", "Endereço", "Número", "Complemento",
    "Bairro", "CEP", "Cidade", "Estado", "Observações do contato", "Fone",
    "Fax", "Celular", "E-mail", "Web Site", "Tipo pessoa", "CNPJ / CPF",
    "IE / RG", "IE isento", "Situação", "Observações", "Estado civil",
    "Profissão", "Sexo", "Data nascimento", "Naturalidade", "Nome pai",
    "CPF pai", "Nome mãe", "CPF mãe", "Lista de Preço", "Vendedor",
    "E-mail para envio de NFe", "Tipos de Contatos", "Contribuinte",
    "Código de regime tributário", "Limite de crédito",
]

# Import templates used by the splitters.
PAYABLES_TEMPLATE_COLUMNS = [
    "Id", "Fornecedor", "Data Emissao", "Data vencimento", "Data Liquidacao",
    "Valor documento", "Saldo", "Situacao", "Numero do documento", "Numero no banco",
    "Categoria", "Historico", "Forma de pagamento", "Meio de pagamento",
    "Taxas", "Estabelecimento_id",
]
RECEIVABLES_TEMPLATE_COLUMNS = [
    "Id", "Cliente", "Data Emissao", "Data vencimento", "Data Liquidacao",
    "Valor documento", "Saldo", "Situacao", "Numero do documento", "Numero no banco",
    "Categoria", "Historico", "Forma de recebimento", "Meio de recebimento",
    "Taxas", "Estabelecimento_id",
]
CONTACTS_TEMPLATE_COLUMNS = CONTACTS_COLUMNS

# Export label -> template label for payables (the export and template spell five labels differently).
PAYABLES_RENAMES = {
    "ID": "Id",
    "Data emissao": "Data Emissao",
    "Situação": "Situacao",
    "Numero documento": "Numero do documento",
    "Forma Pagamento": "Forma de pagamento",
}

# Document type codes and target establishments.
DOC_TYPE_RECEIVABLE = 1
DOC_TYPE_PAYABLE = 2
TARGET_ESTABLISHMENTS = (2, 5)

# Status / flag texts.
STATUS_OPEN = "Em Aberto"
STATUS_SETTLED = "Liquidado"
PAID_YES = "Sim"
PAID_NO = "Não"
STATUS_SETTLED_TEMPLATE = "paga"          # 'liquidado' (any case) is relabelled to this
IE_EXEMPT_DEFAULT = "Não"

# Decode tables: code -> label, then the label for any other code.
PERSON_TYPE = {1: "Física", 2: "Jurídica"}
PERSON_TYPE_OTHER = "Outro"
LEGAL_PERSON = "Jurídica"
ACTIVE = "Ativo"
INACTIVE = "Inativo"
MARITAL_STATUS = {1: "Solteiro(a)", 2: "Casado(a)", 3: "Divorciado(a)", 4: "Viúvo(a)"}
MARITAL_STATUS_OTHER = ""
SEX = {1: "Masculino", 2: "Feminino"}
SEX_OTHER = "Outro"

# Truthy tokens (compared lower-case).
TRUTHY_TOKENS = ["1", "sim", "yes", "true", "verdadeiro", "y", "s", "t", "v"]

# Month number -> file-name abbreviation.
MONTH_ABBREV = {
    1: "jan", 2: "fev", 3: "mar", 4: "abr", 5: "mai", 6: "jun",
    7: "jul", 8: "ago", 9: "set", 10: "out", 11: "nov", 12: "dez",
}
NO_DATE = "sem_data"
UNKNOWN_MONTH = "mes_desconhecido"

# Words that mark a date column (lower-case substring test).
DATE_COLUMN_WORDS = ["data", "emissao", "nascimento", "vencimento", "liquidacao"]

# Audit: important columns per dataset (null audit) and rule names.
IMPORTANT_COLUMNS = {
    "contas_pagar": ["Data emissao", "Data vencimento", "Valor documento", "Fornecedor", "Estabelecimento_id"],
    "contas_receber": ["Data Emissao", "Data vencimento", "Valor documento", "Cliente", "Estabelecimento_id"],
    "contatos": ["Nome", "CNPJ/CPF", "Situação"],
}
RULE_NULL = "nulos"
RULE_DUE_BEFORE_ISSUE = "vencimento_anterior_emissao"
RULE_SETTLED_BEFORE_ISSUE = "liquidacao_anterior_emissao"
RULE_BAD_AMOUNT = "valor_documento_invalido"
RULE_BAD_TAXID = "cpf_cnpj_invalido"
RULE_FUTURE_DATE = "datas_futuras"
RULE_OLD_DATE = "datas_antigas"
# Summary categories in report order.
SUMMARY_CATEGORIES = ["nulos", "datas_futuro", "datas_antigas", "inconsistencias"]
VALID_TAXID_LENGTHS = (11, 14)
FUTURE_YEARS = 10
PAST_YEARS = 20

# Imputation defaults.
TAXID_DEFAULT_NATURAL = "00000000000"
TAXID_DEFAULT_LEGAL = "00000000000000"
NAME_DEFAULT_PREFIX = "Cliente "
TEXT_DEFAULT = "N/A"
STATE_DEFAULT = "UF"
EMAIL_DEFAULT_PREFIX = "contato"
EMAIL_DEFAULT_SUFFIX = "@exemplo.com"
AMOUNT_DEFAULT = "1.00"
CONTACT_TEXT_IMPUTE_COLUMNS = ["Endereço", "Bairro", "Cidade", "Situação"]

# Size limits (bytes) and fill factors.
DATE_SPLIT_LIMIT = 2000 * 1024
TEMPLATE_SPLIT_LIMIT = 500 * 1024
TEMPLATE_FILL = 0.95
ROW_SPLIT_FILL = 0.90
RESPLIT_THRESHOLD = 1900 * 1024
RESPLIT_TARGETS = (0.4, 0.25)
SUM_TOLERANCE = 0.01
CSV_BOM = "\ufeff"
BOM_BYTES = 3

# Label spelling variants resolved at run time (first present wins).
VARIANTS = {
    "issue_date": ["Data emissao", "Data Emissao"],
    "due_date": ["Data vencimento"],
    "settle_date": ["Data Liquidacao"],
    "amount": ["Valor documento"],
    "party": ["Cliente", "Fornecedor"],
    "status": ["Situacao", "Situação"],
    "taxid": ["CNPJ/CPF", "CNPJ / CPF"],
    "person_type": ["Tipo Pessoa", "Tipo pessoa"],
    "id": ["Id", "ID"],
    "establishment": ["Estabelecimento_id"],
}

MONEY = T.DecimalType(22, 6)

# ---------------------------------------------------------------------------
# Templates with per-column kinds (drive formatting and typed defaults).
# ---------------------------------------------------------------------------

#   text   -> string, default ''
#   money  -> decimal(22,6), default 0
#   int    -> int, default 0
#   date   -> 'dd/MM/yyyy' string, '' when missing or unparseable
#   status -> text with 'liquidado' relabelled
#   taxid  -> digits only
#   flag   -> 0/1 from a positive number


@dataclass(frozen=True)
class Template:
    name: str
    columns: tuple[str, ...]
    kinds: dict = field(default_factory=dict)

    def kind(self, label: str) -> str:
        return self.kinds.get(label, "text")


PAYABLES_TEMPLATE = Template(
    "contas_pagar",
    tuple(PAYABLES_TEMPLATE_COLUMNS),
    {"Valor documento": "money", "Saldo": "money", "Taxas": "money", "Estabelecimento_id": "int",
     "Data Emissao": "date", "Data vencimento": "date", "Data Liquidacao": "date", "Situacao": "status"},
)
RECEIVABLES_TEMPLATE = Template(
    "contas_receber",
    tuple(RECEIVABLES_TEMPLATE_COLUMNS),
    {"Valor documento": "money", "Saldo": "money", "Taxas": "money", "Estabelecimento_id": "int",
     "Data Emissao": "date", "Data vencimento": "date", "Data Liquidacao": "date", "Situacao": "status"},
)
CONTACTS_TEMPLATE = Template(
    "contatos",
    tuple(CONTACTS_TEMPLATE_COLUMNS),
    {"CNPJ / CPF": "taxid", "CPF pai": "taxid", "CPF mãe": "taxid", "Data nascimento": "date",
     "Contribuinte": "flag", "Limite de crédito": "money"},
)


def snake(label: str) -> str:
    """ASCII snake_case name for a business label ('Situação' -> 'situacao')."""
    text = unicodedata.normalize("NFKD", label)
    text = "".join(ch for ch in text if not unicodedata.combining(ch)).lower()
    out, prev_us = [], False
    for ch in text:
        if ch.isalnum():
            out.append(ch)
            prev_us = False
        elif not prev_us:
            out.append("_")
            prev_us = True
    return "".join(out).strip("_")


# ---------------------------------------------------------------------------
# The nine ledger tables: columns read by the engine, keys and constraints.
# ---------------------------------------------------------------------------

def _s(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


I, L, S, B, TS = T.IntegerType(), T.LongType(), T.StringType(), T.BooleanType(), T.TimestampNTZType()

# Key columns are LongType: the source declares int, but a 100 TB ledger outgrows 2^31 ids.
LEDGER_SCHEMAS = {
    "DOC_FINANCEIRO": _s(
        ("DOC_FINANCEIRO_ID", L, False), ("PESSOA_ID", L, False), ("ESTABELECIMENTO_ID", I, False),
        ("CD_DFIN_DOCUM", S, False), ("NO_DFIN_TIPO", I, False), ("COND_PAGTO_ID", I, False),
        ("DT_DFIN_EMISS", TS, False), ("DT_DFIN_LANC", TS, False), ("DS_DFIN_HIST", S, True),
        ("VL_DFIN_TOT", MONEY, False), ("ID_DFIN_ADT", B, False)),
    "DOC_FINANCEIRO_PARCELA": _s(
        ("DOC_FINANCEIRO_PARCELA_ID", L, False), ("DOC_FINANCEIRO_ID", L, False), ("CD_DFINP_IDT", I, False),
        ("TIPO_COBR_ID", I, False), ("DT_DFINP_VENC", TS, False), ("DT_DFINP_QUIT", TS, True),
        ("VL_DFINP_DESC", MONEY, False), ("VL_DFINP_JUROS", MONEY, False), ("VL_DFINP_PARC", MONEY, False),
        ("VL_DFINP_QUIT", MONEY, False), ("DS_DFINP_HIST", S, True), ("NO_DFINP_COBR_ELE", I, False),
        ("VL_DMOVI_TXCOBR", MONEY, False)),
    "PESSOA": _s(
        ("PESSOA_ID", L, False), ("NO_PESS_TIPO", I, False), ("ID_PESS_ATIVA", B, False),
        ("DS_PESS_FANTA", S, False), ("NO_PESS_IDENT", S, True), ("NO_PESS_EST_CIVIL", I, True),
        ("NM_PESS_IDENT", S, False), ("DS_PESS_NATUR", S, True), ("NO_PESS_SEXO", I, True),
        ("NO_PESS_CNPJ_CPF", S, True), ("DS_PESS_ENDER", S, True), ("NO_PESS_ENDER", S, True),
        ("DS_PESS_ENDER_COMPL", S, True), ("DS_PESS_BAIRRO", S, True), ("MUNICIPIO_ID", L, False),
        ("DT_PESS_NASC", TS, True), ("NO_PESS_CEP", S, True), ("NO_PESS_INSCR_ESTAD", S, True),
        ("DS_PESS_ENDER_REFER", S, True), ("NO_PESS_EMAIL_COBR", S, True), ("DS_PESS_OBS", S, True),
        ("DS_PESS_CARG", S, True), ("PESSOA_ESTABELECIMENTO_ID", I, True), ("COBRANCA_MUNICIPIO_ID", L, True),
        ("INDICADOR_PESSOA_ID", L, True), ("VENDEDOR_PESSOA_ID", L, True), ("VEICULO_UF_ID", I, True)),
    "ESTABELECIMENTO": _s(
        ("ESTABELECIMENTO_ID", I, False), ("DS_ESTAB_NOME_FANTA", S, False), ("DS_ESTAB_RAZAO_SOCIA", S, False),
        ("NO_ESTAB_CNPJ", S, False), ("MUNICIPIO_ID", L, False)),
    "COND_PAGTO": _s(
        ("COND_PAGTO_ID", I, False), ("DS_CPAG_IDENT", S, False), ("PC_CPAG_FATOR", MONEY, False),
        ("NO_CPAG_PARC", I, False), ("NO_CPAG_DEFAS", I, False)),
    "TIPO_COBR": _s(("TIPO_COBR_ID", I, False), ("DS_TCOBR_IDENT", S, False), ("COND_PAGTO_ID", I, True)),
    "CONTATO": _s(
        ("CONTATO_ID", L, False), ("PESSOA_ID", L, False), ("DS_CTT_NOME", S, False),
        ("DS_CTT_CARGO", S, True), ("DT_CTT_NASC", TS, True), ("DS_CTT_TTRM", S, True),
        ("NO_CTT_CPF", S, True), ("ID_CTT_PADR", B, False)),
    "MUNICIPIO": _s(
        ("MUNICIPIO_ID", L, False), ("DS_MUN_IDENT", S, False), ("UF_ID", I, False),
        ("ID_MUN_COD", S, True), ("VL_MUN_ALIQ_ISS", MONEY, False)),
    "UF": _s(
        ("UF_ID", I, False), ("CD_UF_IDT", S, False), ("DS_UF_IDENT", S, False),
        ("NO_UF_COD", S, False), ("PAIS_ID", I, False), ("PC_UF_ALIQ_ICMS", MONEY, False)),
}

PRIMARY_KEYS = {
    "DOC_FINANCEIRO": ["DOC_FINANCEIRO_ID"],
    "DOC_FINANCEIRO_PARCELA": ["DOC_FINANCEIRO_PARCELA_ID"],
    "PESSOA": ["PESSOA_ID"],
    "ESTABELECIMENTO": ["ESTABELECIMENTO_ID"],
    "COND_PAGTO": ["COND_PAGTO_ID"],
    "TIPO_COBR": ["TIPO_COBR_ID"],
    "CONTATO": ["CONTATO_ID"],
    "MUNICIPIO": ["MUNICIPIO_ID"],
    "UF": ["UF_ID"],
}

# (child table, child columns, parent table, parent columns) among the tables in scope.
FOREIGN_KEYS = [
    ("CONTATO", ["PESSOA_ID"], "PESSOA", ["PESSOA_ID"]),
    ("DOC_FINANCEIRO", ["COND_PAGTO_ID"], "COND_PAGTO", ["COND_PAGTO_ID"]),
    ("DOC_FINANCEIRO", ["ESTABELECIMENTO_ID"], "ESTABELECIMENTO", ["ESTABELECIMENTO_ID"]),
    ("DOC_FINANCEIRO", ["PESSOA_ID"], "PESSOA", ["PESSOA_ID"]),
    ("DOC_FINANCEIRO_PARCELA", ["DOC_FINANCEIRO_ID"], "DOC_FINANCEIRO", ["DOC_FINANCEIRO_ID"]),
    ("DOC_FINANCEIRO_PARCELA", ["TIPO_COBR_ID"], "TIPO_COBR", ["TIPO_COBR_ID"]),
    ("MUNICIPIO", ["UF_ID"], "UF", ["UF_ID"]),
    ("PESSOA", ["MUNICIPIO_ID"], "MUNICIPIO", ["MUNICIPIO_ID"]),
    ("PESSOA", ["PESSOA_ESTABELECIMENTO_ID"], "ESTABELECIMENTO", ["ESTABELECIMENTO_ID"]),
    ("PESSOA", ["COBRANCA_MUNICIPIO_ID"], "MUNICIPIO", ["MUNICIPIO_ID"]),
    ("PESSOA", ["INDICADOR_PESSOA_ID"], "PESSOA", ["PESSOA_ID"]),
    ("PESSOA", ["VENDEDOR_PESSOA_ID"], "PESSOA", ["PESSOA_ID"]),
    ("PESSOA", ["VEICULO_UF_ID"], "UF", ["UF_ID"]),
    ("TIPO_COBR", ["COND_PAGTO_ID"], "COND_PAGTO", ["COND_PAGTO_ID"]),
]

# nvarchar(n) limits of the columns in scope.
LENGTH_LIMITS = {
    "PESSOA": {"NO_PESS_IDENT": 20, "NM_PESS_IDENT": 70, "DS_PESS_NATUR": 50, "DS_PESS_ENDER": 80,
               "NO_PESS_ENDER": 20, "DS_PESS_BAIRRO": 65, "NO_PESS_INSCR_ESTAD": 20},
    "ESTABELECIMENTO": {"DS_ESTAB_NOME_FANTA": 50, "DS_ESTAB_RAZAO_SOCIA": 50, "NO_ESTAB_CNPJ": 20},
    "COND_PAGTO": {"DS_CPAG_IDENT": 30},
    "TIPO_COBR": {"DS_TCOBR_IDENT": 30},
    "CONTATO": {"DS_CTT_NOME": 50, "DS_CTT_CARGO": 30, "DS_CTT_TTRM": 5, "NO_CTT_CPF": 11},
    "MUNICIPIO": {"DS_MUN_IDENT": 100, "ID_MUN_COD": 10},
    "UF": {"CD_UF_IDT": 5, "DS_UF_IDENT": 50, "NO_UF_COD": 10},
}

# Column defaults declared by the DDL for the columns in scope.
COLUMN_DEFAULTS = {
    "DOC_FINANCEIRO": {"ID_DFIN_ADT": False},
    "DOC_FINANCEIRO_PARCELA": {"VL_DMOVI_TXCOBR": 0},
    "UF": {"PC_UF_ALIQ_ICMS": 0},
}


def not_null_columns(table: str) -> list[str]:
    return [f.name for f in LEDGER_SCHEMAS[table].fields if not f.nullable]
