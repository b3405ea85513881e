"""DuckDB SQL for the ledger view over the driver tables (same rules as tally.sources.ledger_view)."""

DOC = """
doc AS (
  SELECT o_orderkey AS DOC_FINANCEIRO_ID,
         o_custkey AS PESSOA_ID,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS ESTABELECIMENTO_ID,
         CAST(o_orderkey AS VARCHAR) AS CD_DFIN_DOCUM,
         CAST(CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 3 END AS INTEGER) AS NO_DFIN_TIPO,
         CAST(o_orderkey % 4 AS INTEGER) AS COND_PAGTO_ID,
         CAST(CASE WHEN o_orderkey % 211 = 5 THEN NULL ELSE o_orderdate END AS TIMESTAMP) AS DT_DFIN_EMISS,
         CAST(o_orderdate AS TIMESTAMP) AS DT_DFIN_LANC,
         CAST(o_totalprice AS DECIMAL(22,6)) AS VL_DFIN_TOT,
         false AS ID_DFIN_ADT
  FROM orders)"""

PARC = """
parc AS (
  SELECT l_orderkey * 10 + l_linenumber AS DOC_FINANCEIRO_PARCELA_ID,
         l_orderkey AS DOC_FINANCEIRO_ID,
         l_linenumber AS CD_DFINP_IDT,
         CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 9 END AS INTEGER) AS TIPO_COBR_ID,
         CAST(CASE WHEN l_orderkey % 223 <> 9 THEN l_shipdate END AS TIMESTAMP) AS DT_DFINP_VENC,
         CAST(0 AS DECIMAL(22,6)) AS VL_DFINP_DESC,
         CAST(0 AS DECIMAL(22,6)) AS VL_DFINP_JUROS,
         CAST(CASE WHEN l_linestatus = 'F' THEN l_shipdate + to_days(l_linenumber) END AS TIMESTAMP) AS DT_DFINP_QUIT,
         CASE WHEN l_orderkey % 131 = 7 THEN NULL
              WHEN l_orderkey % 97 = 3 THEN CAST(-l_extendedprice AS DECIMAL(22,6))
              WHEN l_orderkey % 97 = 4 THEN CAST(0 AS DECIMAL(22,6))
              ELSE CAST(l_extendedprice AS DECIMAL(22,6)) END AS VL_DFINP_PARC,
         CASE WHEN l_linestatus = 'F' AND l_linenumber = 2 THEN CAST(l_extendedprice * 0.5 AS DECIMAL(22,6))
              WHEN l_linestatus = 'F' THEN
                CASE WHEN l_orderkey % 131 = 7 THEN NULL
              WHEN l_orderkey % 97 = 3 THEN CAST(-l_extendedprice AS DECIMAL(22,6))
                     WHEN l_orderkey % 97 = 4 THEN CAST(0 AS DECIMAL(22,6))
                     ELSE CAST(l_extendedprice AS DECIMAL(22,6)) END
              ELSE CAST(0 AS DECIMAL(22,6)) END AS VL_DFINP_QUIT,
         CASE WHEN l_linenumber % 3 = 0 THEN NULL
              WHEN l_linenumber = 4 THEN 'Parcela 4, "revisada" do pedido ' || CAST(l_orderkey AS VARCHAR)
              ELSE 'Parcela ' || CAST(l_linenumber AS VARCHAR) || ' do pedido ' || CAST(l_orderkey AS VARCHAR)
         END AS DS_DFINP_HIST,
         CAST(l_suppkey AS INTEGER) AS NO_DFINP_COBR_ELE,
         CASE WHEN l_orderkey % 13 <> 5 THEN CAST(l_extendedprice * l_tax AS DECIMAL(22,6)) END AS VL_DMOVI_TXCOBR
  FROM lineitem)"""

PESSOA = """
pessoa AS (
  SELECT c_custkey AS PESSOA_ID,
         CAST(CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 2
                   WHEN c_mktsegment = 'HOUSEHOLD' THEN 3 ELSE 1 END AS INTEGER) AS NO_PESS_TIPO,
         c_acctbal > 0 AS ID_PESS_ATIVA,
         'Fantasia ' || CAST(c_custkey AS VARCHAR) AS DS_PESS_FANTA,
         lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS NO_PESS_IDENT,
         CAST(c_custkey % 6 AS INTEGER) AS NO_PESS_EST_CIVIL,
         CASE WHEN c_custkey % 89 = 7 THEN NULL ELSE c_name END AS NM_PESS_IDENT,
         CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'Cidade ' || CAST(c_nationkey AS VARCHAR) END AS DS_PESS_NATUR,
         CAST(c_custkey % 3 AS INTEGER) AS NO_PESS_SEXO,
         CASE c_custkey % 7
           WHEN 0 THEN lpad(CAST(c_custkey AS VARCHAR), 11, '0')
           WHEN 1 THEN lpad(CAST(c_custkey AS VARCHAR), 14, '0')
           WHEN 2 THEN substr(lpad(CAST(c_custkey AS VARCHAR), 11, '0'), 1, 3) || '.' ||
                       substr(lpad(CAST(c_custkey AS VARCHAR), 11, '0'), 4, 3) || '.' ||
                       substr(lpad(CAST(c_custkey AS VARCHAR), 11, '0'), 7, 3) || '-' ||
                       substr(lpad(CAST(c_custkey AS VARCHAR), 11, '0'), 10, 2)
           WHEN 3 THEN lpad(CAST(c_custkey AS VARCHAR), 10, '0')
           WHEN 4 THEN NULL
           WHEN 5 THEN ''
           ELSE substr(lpad(CAST(c_custkey AS VARCHAR), 14, '0'), 1, 2) || '.' ||
                substr(lpad(CAST(c_custkey AS VARCHAR), 14, '0'), 3, 3) || '.' ||
                substr(lpad(CAST(c_custkey AS VARCHAR), 14, '0'), 6, 3) || '/' ||
                substr(lpad(CAST(c_custkey AS VARCHAR), 14, '0'), 9, 4) || '-' ||
                substr(lpad(CAST(c_custkey AS VARCHAR), 14, '0'), 13, 2)
         END AS NO_PESS_CNPJ_CPF,
         CASE WHEN c_custkey % 10 = 3 THEN NULL ELSE 'Rua ' || CAST(c_custkey % 500 AS VARCHAR) END AS DS_PESS_ENDER,
         CAST(c_custkey % 1000 AS VARCHAR) AS NO_PESS_ENDER,
         CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE 'Sala ' || CAST(c_custkey % 50 AS VARCHAR) END AS DS_PESS_ENDER_COMPL,
         CASE WHEN c_custkey % 11 = 4 THEN NULL ELSE 'Bairro ' || CAST(c_custkey % 40 AS VARCHAR) END AS DS_PESS_BAIRRO,
         CAST(CASE WHEN c_custkey % 13 = 6 THEN 99 ELSE c_nationkey END AS BIGINT) AS MUNICIPIO_ID,
         CASE WHEN c_custkey % 9 = 2 THEN NULL
              ELSE TIMESTAMP '1940-01-01 00:00:00' + to_days(CAST((c_custkey * 7919) % 36500 AS INTEGER)) END AS DT_PESS_NASC,
         lpad(CAST((c_custkey * 37) % 100000000 AS VARCHAR), 8, '0') AS NO_PESS_CEP,
         CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE lpad(CAST(c_custkey AS VARCHAR), 9, '0') END AS NO_PESS_INSCR_ESTAD,
         CASE WHEN c_custkey % 5 = 0 THEN 'Perto da praca ' || CAST(c_custkey % 30 AS VARCHAR) END AS DS_PESS_ENDER_REFER,
         CASE WHEN c_custkey % 8 = 1 THEN NULL ELSE 'cliente' || CAST(c_custkey AS VARCHAR) || '@mail.test' END AS NO_PESS_EMAIL_COBR,
         CASE WHEN c_custkey % 50 = 0 THEN 'Obs, "vip"' WHEN c_custkey % 50 = 1 THEN '#interno' END AS DS_PESS_OBS,
         lower(c_mktsegment) AS DS_PESS_CARG,
         CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey % 17 AS INTEGER) END AS PESSOA_ESTABELECIMENTO_ID,
         CASE WHEN c_custkey % 3 <> 0 THEN c_custkey % 30 END AS COBRANCA_MUNICIPIO_ID,
         CASE WHEN c_custkey % 4 <> 0 THEN c_custkey - 1 END AS INDICADOR_PESSOA_ID,
         CASE WHEN c_custkey % 6 = 1 THEN c_custkey * 2 END AS VENDEDOR_PESSOA_ID,
         CASE WHEN c_custkey % 10 = 7 THEN CAST(c_custkey % 8 AS INTEGER) END AS VEICULO_UF_ID
  FROM customer)"""

MUNICIPIO = """
municipio AS (
  SELECT CAST(n_nationkey AS BIGINT) AS MUNICIPIO_ID, n_name AS DS_MUN_IDENT, n_regionkey AS UF_ID,
         lpad(CAST(n_nationkey AS VARCHAR), 7, '0') AS ID_MUN_COD,
         CAST(0 AS DECIMAL(22,6)) AS VL_MUN_ALIQ_ISS
  FROM nation)"""

UF = """
uf AS (
  SELECT r_regionkey AS UF_ID, upper(substr(r_name, 1, 2)) AS CD_UF_IDT, r_name AS DS_UF_IDENT,
         CAST(r_regionkey AS VARCHAR) AS NO_UF_COD,
         1 AS PAIS_ID,
         CAST(0 AS DECIMAL(22,6)) AS PC_UF_ALIQ_ICMS
  FROM region)"""

CONTATO = """
contato AS (
  SELECT event_id AS CONTATO_ID, user_id AS PESSOA_ID,
         'Contato ' || CAST(event_id AS VARCHAR) AS DS_CTT_NOME,
         CAST(NULL AS VARCHAR) AS DS_CTT_CARGO,
         CAST(NULL AS VARCHAR) AS NO_CTT_CPF,
         CASE WHEN event_type = 'click' THEN '9' || lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0')
              ELSE event_type END AS DS_CTT_TTRM,
         event_type = 'click' AS ID_CTT_PADR
  FROM events)"""

COND = """
cond AS (
  SELECT COND_PAGTO_ID, DS_CPAG_IDENT, CAST(1 AS DECIMAL(22,6)) AS PC_CPAG_FATOR, NO_CPAG_PARC, NO_CPAG_DEFAS
  FROM (VALUES (0, 'A vista', 1, 0), (1, '30 dias', 1, 30), (2, '30/60 dias', 2, 30))
       v(COND_PAGTO_ID, DS_CPAG_IDENT, NO_CPAG_PARC, NO_CPAG_DEFAS))"""

TIPO = """
tipo AS (
  SELECT * FROM (VALUES (1, 'Boleto', 1), (2, 'Pix', 9)) v(TIPO_COBR_ID, DS_TCOBR_IDENT, COND_PAGTO_ID))"""

ESTAB = """
estab AS (
  SELECT CAST(s_suppkey AS INTEGER) AS ESTABELECIMENTO_ID, s_name AS DS_ESTAB_NOME_FANTA,
         s_name || ' Ltda' AS DS_ESTAB_RAZAO_SOCIA, lpad(CAST(s_suppkey AS VARCHAR), 14, '0') AS NO_ESTAB_CNPJ,
         CAST(s_nationkey AS BIGINT) AS MUNICIPIO_ID
  FROM supplier)"""

ALL = {"doc": DOC, "parc": PARC, "pessoa": PESSOA, "municipio": MUNICIPIO, "uf": UF,
       "contato": CONTATO, "cond": COND, "tipo": TIPO, "estab": ESTAB}


def with_ctes(*names: str, extra: list[str] | None = None) -> str:
    """A WITH clause holding the named ledger CTEs followed by ``extra`` CTE texts."""
    parts = [ALL[n] for n in names] + list(extra or [])
    return "WITH " + ",".join(parts) + "\n"
