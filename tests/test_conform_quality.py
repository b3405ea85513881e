"""Template conformance (P-13/P-19/P-24), audit rules (D1-D7), summary (A10), imputation."""

import datetime as dt

from tally import schemas as S
from tally.operators import quality as qa
from tally.operators.conform import conform, date_columns, export_format, resolve
from tally.operators.impute import impute

AS_OF = dt.datetime(2001, 1, 1)


def test_conform_missing_extra_order_and_variant(spark):
    df = spark.createDataFrame(
        [("7", "15/03/2021", "Liquidado", "10.5", "x", "2")],
        "`Estabelecimento_id` string, `Data emissao` string, `Situação` string, `Valor documento` string, "
        "extra string, ID string")
    out = conform(df, S.PAYABLES_TEMPLATE, S.PAYABLES_RENAMES)
    assert out.columns == list(S.PAYABLES_TEMPLATE.columns)
    r = out.first().asDict()
    assert r["Id"] == "2" and r["Data Emissao"] == "15/03/2021" and r["Situacao"] == "paga"
    assert float(r["Valor documento"]) == 10.5 and float(r["Saldo"]) == 0.0 and float(r["Taxas"]) == 0.0
    assert r["Estabelecimento_id"] == 7 and r["Fornecedor"] == "" and r["Numero no banco"] == ""
    exact = conform(df, S.PAYABLES_TEMPLATE, {}).first().asDict()
    assert exact["Id"] == "" and exact["Data Emissao"] == ""   # exact-name mode leaves them blank


def test_resolve_and_date_discovery(spark):
    df = spark.createDataFrame([(1, 2)], "`Data Emissao` int, `CNPJ / CPF` int")
    assert resolve(df, S.VARIANTS["issue_date"]) == "Data Emissao"
    assert resolve(df, S.VARIANTS["taxid"]) == "CNPJ / CPF"
    assert date_columns(S.PAYABLES_EXPORT_COLUMNS) == ["Data emissao", "Data vencimento", "Data Liquidacao"]


def test_export_contacts_taxpayer(spark):
    df = spark.createDataFrame([("Jurídica", "0"), ("Física", "sim"), ("Física", "0")],
                               "`Tipo pessoa` string, Contribuinte string")
    out = export_format(df, S.CONTACTS_COLUMNS, "contatos")
    assert [r["Contribuinte"] for r in out.collect()] == [1, 1, 0]


def _accounts(spark, rows):
    from decimal import Decimal
    rows = [tuple(Decimal(v) if i == 5 and v is not None else v for i, v in enumerate(r)) for r in rows]
    return spark.createDataFrame(rows, "Id string, Cliente string, `Data Emissao` string, `Data vencimento` string, "
                                       "`Data Liquidacao` string, `Valor documento` decimal(22,6), "
                                       "Situacao string, Estabelecimento_id int")


def test_date_order_rules(spark):
    rows = [("1", "a", "10/01/2021", "09/01/2021", None, 1, "x", 2),          # due before issue
            ("2", "a", "10/01/2021", "10/01/2021", "10/01/2021", 1, "x", 2),  # equal: fine
            ("3", "a", "10/01/2021", "11/01/2021", "01/01/2021", 1, "x", 2),  # settled before issue
            ("4", "a", None, "01/01/2020", "01/01/2020", 1, "x", 2),          # null issue: no order rule
            ("5", "a", "10/01/2021", None, None, 0, "x", 2)]                  # amount 0, null due
    v = qa.audit(_accounts(spark, rows), "contas_receber")
    got = sorted((r.rule, r.record_id) for r in v.collect())
    assert ("vencimento_anterior_emissao", "1") in got
    assert ("liquidacao_anterior_emissao", "3") in got
    assert ("valor_documento_invalido", "5") in got
    assert ("nulos", "4") in got and ("nulos", "5") in got
    assert not any(r == "vencimento_anterior_emissao" and i in ("2", "4") for r, i in got)


def test_outlier_boundaries(spark):
    rows = [("1", "2011-01-01"), ("2", "2011-01-01 00:00:01"), ("3", "1981-01-01"), ("4", "1980-12-31")]
    df = spark.createDataFrame(rows, "ID string, `Data nascimento` string")
    v = qa.audit(df, "contatos", AS_OF, important=[])
    got = sorted((r.rule, r.record_id) for r in v.collect())
    # day precision: one second past the limit is the same day, so not beyond it
    assert got == [("datas_antigas", "4")]
    ts = spark.createDataFrame([("1", dt.datetime(2011, 1, 1)), ("2", dt.datetime(2011, 1, 1, 0, 0, 1))],
                               "ID string, `Data nascimento` timestamp_ntz")
    got = sorted((r.rule, r.record_id) for r in qa.audit(ts, "contatos", AS_OF, important=[]).collect())
    assert got == [("datas_futuras", "2")]


def test_taxid_rule_and_summary(spark):
    rows = [("1", "12345678901"), ("2", "1234567890"), ("3", ""), ("4", None), ("5", "12.345.678/0001-99")]
    df = spark.createDataFrame(rows, "ID string, `CNPJ / CPF` string").withColumn("Nome", __import__(
        "pyspark.sql.functions", fromlist=["lit"]).lit("n")).withColumn("Situação", __import__(
            "pyspark.sql.functions", fromlist=["lit"]).lit("Ativo"))
    v = qa.audit(df, "contatos")
    assert sorted((r.rule, r.record_id) for r in v.collect()) == [
        ("cpf_cnpj_invalido", "2"), ("nulos", "3"), ("nulos", "4")]      # blank text is missing as null is
    s = {r.dataset: r.asDict() for r in qa.error_summary(v, ["contatos", "contas_pagar"]).collect()}
    assert s["contatos"] == {"dataset": "contatos", "nulos": 2, "datas_futuro": 0, "datas_antigas": 0, "inconsistencias": 1}
    assert s["contas_pagar"] == {"dataset": "contas_pagar", "nulos": 0, "datas_futuro": 0, "datas_antigas": 0,
                                 "inconsistencias": 0}           # a clean dataset has its row


def test_blank_text_counts_the_same_in_memory_and_from_a_file(spark):
    from tally.session import scratch_path
    from tally.sinks.writers import write_csv
    from tally.sources.tables import read_sheet
    cols = ["ID", "Nome", "CNPJ / CPF", "Endereço", "Bairro", "Cidade", "Estado", "Situação", "E-mail", "Data nascimento"]
    rows = [("1", *[""] * 9), ("2", "Ana", "12345678901", "Rua", "B", "C", "SP", "Ativo", "a@b", "01/01/1990")]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))
    path = scratch_path(spark, "blank")
    write_csv(df.coalesce(1), path)
    back = read_sheet(spark, path, columns=cols)
    seen = [sorted(map(tuple, impute(x, "contatos", AS_OF).collect())) for x in (df, back)]
    assert seen[0] == seen[1]
    assert seen[0][0] == ("1", "Cliente 1", "00000000000", "N/A", "N/A", "N/A", "UF", "N/A", "contato1@exemplo.com",
                          "01/01/2001")
    found = [sorted((r.rule, r.coluna, r.record_id) for r in qa.audit(x, "contatos", AS_OF).collect()) for x in (df, back)]
    assert found[0] == found[1] == [("nulos", "CNPJ/CPF", "1"), ("nulos", "Nome", "1"), ("nulos", "Situação", "1")]


def test_numbers_out_of_range_are_bad_numbers(spark):
    from tally.functions import scalars as fx
    df = spark.createDataFrame([(1e20, 2 ** 40), (5.5, 7)], "a double, b long")
    types = {f.name: f.dataType for f in df.schema.fields}
    got = df.select(fx.to_money("a", types["a"]).cast("double"), fx.to_int("b", types["b"])).collect()
    assert [tuple(r) for r in got] == [(0.0, 0), (5.5, 7)]


def test_one_rule_scans_only_its_inputs(spark):
    from tally.plans.catalog import QUERIES
    for name, scans in [("bad_taxid", {"customer"}), ("nonpositive_amount", {"orders", "lineitem", "customer"})]:
        files = {f.rsplit("/", 1)[-1].split(".")[0] for f in QUERIES[name](spark, "/root/testdata/sf0.001").inputFiles()}
        assert files <= scans | {"nation", "region", "events"}, (name, files)


def test_sample_keeps_first_five_by_id(spark):
    rows = [("d", "r", "c", str(i)) for i in [12, 3, 7, 1, 100, 20, 5]]
    v = spark.createDataFrame(rows, "dataset string, rule string, coluna string, record_id string")
    got = [r.record_id for r in qa.sample_violations(v, 5).orderBy("rn").collect()]
    assert got == ["1", "3", "5", "7", "12"]


def test_impute_accounts(spark):
    rows = [(None, None, None, None, None, None, None, 2),
            ("9", "b", "bad", "05/05/2020", None, 3, "Liquidado", 2)]
    out = impute(_accounts(spark, rows), "contas_receber", AS_OF).collect()
    a, b = out[0].asDict(), out[1].asDict()
    assert a["Data Emissao"] == "01/01/2001" and a["Data vencimento"] == "01/01/2001"
    assert a["Cliente"] == "Cliente " and float(a["Valor documento"]) == 1.0 and a["Situacao"] == "Em Aberto"
    assert b["Data Emissao"] == "01/01/2001" and b["Data vencimento"] == "05/05/2020" and b["Cliente"] == "b"


def test_impute_contacts(spark):
    rows = [(1, None, None, "Jurídica", None, None), (2, "Ana", None, "Física", "x@y", "01/02/1990")]
    df = spark.createDataFrame(rows, "ID long, Nome string, `CNPJ / CPF` string, `Tipo pessoa` string, "
                                     "`E-mail` string, `Data nascimento` string")
    a, b = [r.asDict() for r in impute(df, "contatos", AS_OF).orderBy("ID").collect()]
    assert a["Nome"] == "Cliente 1" and a["CNPJ / CPF"] == "00000000000000" and a["E-mail"] == \
        "contato1@exemplo.com" and a["Data nascimento"] == "01/01/2001"
    assert b["CNPJ / CPF"] == "00000000000" and b["Data nascimento"] == "01/02/1990"
