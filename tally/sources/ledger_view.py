"""The nine ledger tables, as one object, from parquet, JDBC or the driver tables.

``from_driver_tables`` maps the TPC-H-style test tables onto the ledger model
(orders -> documents, lineitem -> installments, customer -> parties,
nation/region -> city/state, events -> contacts).  The test tables carry no
nulls or dirt, so some are derived from key arithmetic; the DuckDB oracle
derives the same values with the same rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally import schemas as S
from tally.sources.tables import read_table

MONEY = S.MONEY


class Ledger:
    """The nine tables by name; each is built on first use (a plan, not data)."""

    def __init__(self, **tables):
        self._tables: dict = {}
        self._builders: dict = {}
        for name, value in tables.items():
            if callable(value) and not isinstance(value, DataFrame):
                self._builders[name] = value
            else:
                self._tables[name] = value

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._builders.pop(name)()
        return self._tables[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in S.LEDGER_SCHEMAS:
            return self.table(name)
        raise AttributeError(name)

    def replace(self, **tables) -> "Ledger":
        """A copy with some tables replaced."""
        merged = {n: self.table(n) for n in S.LEDGER_SCHEMAS}
        merged.update(tables)
        return Ledger(**merged)

    def names(self) -> list[str]:
        return list(S.LEDGER_SCHEMAS)


def from_parquet(spark: SparkSession, folder: str) -> Ledger:
    """Ledger tables stored as ``<folder>/<TABLE>.parquet``."""
    return Ledger(**{t: read_table(spark, t, path=f"{folder}/{t}.parquet") for t in S.LEDGER_SCHEMAS})


def from_jdbc(spark: SparkSession, url: str, properties: dict, partitioning: dict | None = None) -> Ledger:
    """Ledger tables straight from the relational source.

    ``partitioning`` maps a table to (column, lower, upper, partitions) for
    parallel range reads of the big tables.
    """
    partitioning = partitioning or {}
    out = {}
    for t in S.LEDGER_SCHEMAS:
        p = partitioning.get(t)
        kw = {}
        if p:
            kw = dict(partition_column=p[0], lower_bound=p[1], upper_bound=p[2], num_partitions=p[3])
        out[t] = read_table(spark, f"dbo.{t}", url=url, properties=properties, **kw)
    return Ledger(**out)


def _money(c: Column) -> Column:
    return c.cast(MONEY)


def _lpad_key(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _days_after(ts: Column, days: Column) -> Column:
    return F.timestamp_add("DAY", days, ts)


def from_driver_tables(spark: SparkSession, sf_dir: str) -> Ledger:
    """Ledger view over the driver tables; each table's plan is built when first used."""
    def r(name):
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    return Ledger(DOC_FINANCEIRO=lambda: _doc(r("orders")), DOC_FINANCEIRO_PARCELA=lambda: _parc(r("lineitem")),
                  PESSOA=lambda: _pessoa(r("customer")), COND_PAGTO=lambda: _cond(spark),
                  TIPO_COBR=lambda: _tipo(spark), CONTATO=lambda: _contato(r("events")),
                  MUNICIPIO=lambda: _municipio(r("nation")), UF=lambda: _uf(r("region")),
                  ESTABELECIMENTO=lambda: _estabelecimento(r("supplier")))


def _doc(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    return orders.select(
        k.alias("DOC_FINANCEIRO_ID"),
        F.col("o_custkey").alias("PESSOA_ID"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("ESTABELECIMENTO_ID"),
        k.cast("string").alias("CD_DFIN_DOCUM"),
        F.when(F.col("o_orderstatus") == "F", 2).when(F.col("o_orderstatus") == "O", 1)
         .otherwise(3).alias("NO_DFIN_TIPO"),
        (k % 4).cast("int").alias("COND_PAGTO_ID"),
        F.when(k % 211 == 5, F.lit(None)).otherwise(F.col("o_orderdate")).cast("timestamp_ntz")
         .alias("DT_DFIN_EMISS"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("DT_DFIN_LANC"),
        F.lit(None).cast("string").alias("DS_DFIN_HIST"),
        _money(F.col("o_totalprice")).alias("VL_DFIN_TOT"),
        F.lit(False).alias("ID_DFIN_ADT"),
    )


def _parc(lineitem: DataFrame) -> DataFrame:
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    price = F.col("l_extendedprice")
    parc_value = (F.when(ok % 131 == 7, F.lit(None).cast(MONEY))
                  .when(ok % 97 == 3, _money(-price))
                  .when(ok % 97 == 4, _money(F.lit(0)))
                  .otherwise(_money(price)))
    settled = F.col("l_linestatus") == "F"
    return lineitem.select(
        (ok * 10 + ln).alias("DOC_FINANCEIRO_PARCELA_ID"),
        ok.alias("DOC_FINANCEIRO_ID"),
        ln.alias("CD_DFINP_IDT"),
        F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2)
         .otherwise(9).alias("TIPO_COBR_ID"),
        F.when(ok % 223 != 9, F.col("l_shipdate")).cast("timestamp_ntz").alias("DT_DFINP_VENC"),
        F.when(settled, _days_after(F.col("l_shipdate"), ln)).cast("timestamp_ntz").alias("DT_DFINP_QUIT"),
        _money(F.lit(0)).alias("VL_DFINP_DESC"),
        _money(F.lit(0)).alias("VL_DFINP_JUROS"),
        parc_value.alias("VL_DFINP_PARC"),
        F.when(settled & (ln == 2), _money(price * 0.5))
         .when(settled, parc_value)
         .otherwise(_money(F.lit(0))).alias("VL_DFINP_QUIT"),
        F.when(ln % 3 == 0, F.lit(None).cast("string"))
         .when(ln == 4, F.concat(F.lit('Parcela 4, "revisada" do pedido '), ok.cast("string")))
         .otherwise(F.concat(F.lit("Parcela "), ln.cast("string"), F.lit(" do pedido "), ok.cast("string")))
         .alias("DS_DFINP_HIST"),
        F.col("l_suppkey").cast("int").alias("NO_DFINP_COBR_ELE"),
        F.when(ok % 13 != 5, _money(price * F.col("l_tax"))).alias("VL_DMOVI_TXCOBR"),
    )


def _pessoa(customer: DataFrame) -> DataFrame:
    c = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    tax11, tax14 = _lpad_key(c, 11), _lpad_key(c, 14)
    taxid = (F.when(c % 7 == 0, tax11)
             .when(c % 7 == 1, tax14)
             .when(c % 7 == 2, F.concat(F.substring(tax11, 1, 3), F.lit("."), F.substring(tax11, 4, 3),
                                        F.lit("."), F.substring(tax11, 7, 3), F.lit("-"),
                                        F.substring(tax11, 10, 2)))
             .when(c % 7 == 3, _lpad_key(c, 10))
             .when(c % 7 == 4, F.lit(None).cast("string"))
             .when(c % 7 == 5, F.lit(""))
             .otherwise(F.concat(F.substring(tax14, 1, 2), F.lit("."), F.substring(tax14, 3, 3), F.lit("."),
                                 F.substring(tax14, 6, 3), F.lit("/"), F.substring(tax14, 9, 4), F.lit("-"),
                                 F.substring(tax14, 13, 2))))
    return customer.select(
        c.alias("PESSOA_ID"),
        F.when(seg.isin("BUILDING", "MACHINERY"), 2).when(seg == "HOUSEHOLD", 3).otherwise(1).alias("NO_PESS_TIPO"),
        (F.col("c_acctbal") > 0).alias("ID_PESS_ATIVA"),
        F.concat(F.lit("Fantasia "), c.cast("string")).alias("DS_PESS_FANTA"),
        _lpad_key(c, 6).alias("NO_PESS_IDENT"),
        (c % 6).cast("int").alias("NO_PESS_EST_CIVIL"),
        F.when(c % 89 == 7, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("NM_PESS_IDENT"),
        F.when(c % 4 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Cidade "), F.col("c_nationkey").cast("string"))).alias("DS_PESS_NATUR"),
        (c % 3).cast("int").alias("NO_PESS_SEXO"),
        taxid.alias("NO_PESS_CNPJ_CPF"),
        F.when(c % 10 == 3, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Rua "), (c % 500).cast("string"))).alias("DS_PESS_ENDER"),
        (c % 1000).cast("string").alias("NO_PESS_ENDER"),
        F.when(c % 2 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Sala "), (c % 50).cast("string"))).alias("DS_PESS_ENDER_COMPL"),
        F.when(c % 11 == 4, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Bairro "), (c % 40).cast("string"))).alias("DS_PESS_BAIRRO"),
        F.when(c % 13 == 6, F.lit(99)).otherwise(F.col("c_nationkey")).cast("long").alias("MUNICIPIO_ID"),
        F.when(c % 9 == 2, F.lit(None).cast("timestamp_ntz"))
         .otherwise(_days_after(F.lit("1940-01-01 00:00:00").cast("timestamp_ntz"), (c * 7919) % 36500))
         .alias("DT_PESS_NASC"),
        _lpad_key((c * 37) % 100000000, 8).alias("NO_PESS_CEP"),
        F.when(c % 2 == 0, F.lit(None).cast("string")).otherwise(_lpad_key(c, 9)).alias("NO_PESS_INSCR_ESTAD"),
        F.when(c % 5 == 0, F.concat(F.lit("Perto da praca "), (c % 30).cast("string")))
         .alias("DS_PESS_ENDER_REFER"),
        F.when(c % 8 == 1, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("cliente"), c.cast("string"), F.lit("@mail.test"))).alias("NO_PESS_EMAIL_COBR"),
        F.when(c % 50 == 0, F.lit('Obs, "vip"')).when(c % 50 == 1, F.lit("#interno"))
         .alias("DS_PESS_OBS"),
        F.lower(seg).alias("DS_PESS_CARG"),
        F.when(c % 5 != 0, c % 17).cast("int").alias("PESSOA_ESTABELECIMENTO_ID"),
        F.when(c % 3 != 0, c % 30).cast("long").alias("COBRANCA_MUNICIPIO_ID"),
        F.when(c % 4 != 0, c - 1).cast("long").alias("INDICADOR_PESSOA_ID"),
        F.when(c % 6 == 1, c * 2).cast("long").alias("VENDEDOR_PESSOA_ID"),
        F.when(c % 10 == 7, c % 8).cast("int").alias("VEICULO_UF_ID"),
    )


def _estabelecimento(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    return supplier.select(
        k.cast("int").alias("ESTABELECIMENTO_ID"),
        F.col("s_name").alias("DS_ESTAB_NOME_FANTA"),
        F.concat(F.col("s_name"), F.lit(" Ltda")).alias("DS_ESTAB_RAZAO_SOCIA"),
        _lpad_key(k, 14).alias("NO_ESTAB_CNPJ"),
        F.col("s_nationkey").cast("long").alias("MUNICIPIO_ID"),
    )


def _municipio(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_nationkey").cast("long").alias("MUNICIPIO_ID"),
        F.col("n_name").alias("DS_MUN_IDENT"),
        F.col("n_regionkey").alias("UF_ID"),
        _lpad_key(F.col("n_nationkey"), 7).alias("ID_MUN_COD"),
        _money(F.lit(0)).alias("VL_MUN_ALIQ_ISS"),
    )


def _uf(region: DataFrame) -> DataFrame:
    return region.select(
        F.col("r_regionkey").alias("UF_ID"),
        F.upper(F.substring("r_name", 1, 2)).alias("CD_UF_IDT"),
        F.col("r_name").alias("DS_UF_IDENT"),
        F.col("r_regionkey").cast("string").alias("NO_UF_COD"),
        F.lit(1).alias("PAIS_ID"),
        _money(F.lit(0)).alias("PC_UF_ALIQ_ICMS"),
    )


def _contato(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    click = F.col("event_type") == "click"
    return events.select(
        e.alias("CONTATO_ID"),
        F.col("user_id").alias("PESSOA_ID"),
        F.concat(F.lit("Contato "), e.cast("string")).alias("DS_CTT_NOME"),
        F.lit(None).cast("string").alias("DS_CTT_CARGO"),
        F.lit(None).cast("timestamp_ntz").alias("DT_CTT_NASC"),
        F.when(click, F.concat(F.lit("9"), _lpad_key(e % 10000, 4))).otherwise(F.col("event_type"))
         .alias("DS_CTT_TTRM"),
        F.lit(None).cast("string").alias("NO_CTT_CPF"),
        click.alias("ID_CTT_PADR"),
    )


def _cond(spark: SparkSession) -> DataFrame:
    # Inline reference rows as SQL VALUES: a local relation with known size.
    return spark.sql(
        "SELECT CAST(COND_PAGTO_ID AS INT) AS COND_PAGTO_ID, DS_CPAG_IDENT, "
        "CAST(1 AS DECIMAL(22,6)) AS PC_CPAG_FATOR, CAST(NO_CPAG_PARC AS INT) AS NO_CPAG_PARC, "
        "CAST(NO_CPAG_DEFAS AS INT) AS NO_CPAG_DEFAS "
        "FROM VALUES (0, 'A vista', 1, 0), (1, '30 dias', 1, 30), (2, '30/60 dias', 2, 30) "
        "AS v(COND_PAGTO_ID, DS_CPAG_IDENT, NO_CPAG_PARC, NO_CPAG_DEFAS)")


def _tipo(spark: SparkSession) -> DataFrame:
    return spark.sql(
        "SELECT CAST(TIPO_COBR_ID AS INT) AS TIPO_COBR_ID, DS_TCOBR_IDENT, CAST(COND_PAGTO_ID AS INT) AS COND_PAGTO_ID "
        "FROM VALUES (1, 'Boleto', 1), (2, 'Pix', 9) AS v(TIPO_COBR_ID, DS_TCOBR_IDENT, COND_PAGTO_ID)")
