"""P-* scalar functions on hand-made rows (FIXTURES section 3)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tally.functions import scalars as fx


def _one(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_dates_day_first_then_iso(spark):
    vals = ["28/10/2021", "03/01/2020", "31/02/2021", "2021-10-28", "", None, "abc", " 5/1/2020 "]
    got = _one(spark, vals, fx.format_date)
    assert got == ["28/10/2021", "03/01/2020", None, "28/10/2021", None, None, None, "05/01/2020"]


def test_parse_keeps_typed_timestamps(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 1, 5, 13, 0),)], "v timestamp_ntz")
    assert df.select(fx.parse_date(F.col("v"), df.schema["v"].dataType)).first()[0] == dt.datetime(2021, 1, 5, 13, 0)


def test_amount_coercion(spark):
    vals = ["10.50", "0", "-1", "", None, "abc", "  7.25 "]
    assert _one(spark, vals, fx.to_money) == [Decimal("10.500000"), Decimal("0E-6"), Decimal("-1.000000"),
                                              Decimal("0E-6"), Decimal("0E-6"), Decimal("0E-6"),
                                              Decimal("7.250000")]
    assert _one(spark, vals, fx.positive_flag) == [1, 0, 0, 0, 0, 0, 1]


def test_tax_ids_digits(spark):
    vals = ["12345678901", "12345678000199", "123.456.789-01", "1234567890", "", None, "00012345678"]
    assert _one(spark, vals, fx.digits_only) == ["12345678901", "12345678000199", "12345678901", "1234567890",
                                                 "", None, "00012345678"]


def test_truthy_tokens(spark):
    vals = ["1", "SIM", "Yes", "TRUE", "Verdadeiro", "y", "S", "t", "V", "0", "não", "1.0", None, "sim "]
    assert _one(spark, vals, fx.truthy) == [1, 1, 1, 1, 1, 1, 1, 1, 1, 0, 0, 1, 0, 0]


def test_decode_with_default(spark):
    assert _one(spark, [1, 2, 3, None], fx.person_type, "int") == ["Física", "Jurídica", "Outro", "Outro"]
    assert _one(spark, [1, 2, 3, 4, 5, None], fx.marital_label, "int") == [
        "Solteiro(a)", "Casado(a)", "Divorciado(a)", "Viúvo(a)", "", ""]
    assert _one(spark, [1, 2, 0], fx.sex_label, "int") == ["Masculino", "Feminino", "Outro"]
    assert _one(spark, [True, False, None], fx.active_label, "boolean") == ["Ativo", "Inativo", "Inativo"]


def test_two_balance_rules_differ_on_partial_payment(spark):
    rows = [(dt.datetime(2021, 1, 1), Decimal("100"), Decimal("100")),   # settled
            (None, Decimal("100"), Decimal("0")),                         # open
            (dt.datetime(2021, 1, 1), Decimal("100"), Decimal("40"))]     # partly paid
    df = spark.createDataFrame(rows, "q timestamp_ntz, v decimal(22,6), p decimal(22,6)")
    out = df.select(fx.balance_by_settlement("q", "v").alias("a"), fx.balance_by_amount("v", "p").alias("b"),
                    fx.status_text("q").alias("s"), fx.paid_flag("q").alias("f")).collect()
    assert [(float(r.a), float(r.b), r.s, r.f) for r in out] == [
        (0.0, 0.0, "Liquidado", "Sim"), (100.0, 100.0, "Em Aberto", "Não"), (0.0, 60.0, "Liquidado", "Sim")]


def test_month_keys_and_labels(spark):
    vals = ["15/01/2021", "31/12/2020", "", None, "29/02/2020"]
    assert _one(spark, vals, fx.due_month) == ["1", "12", "sem_data", "sem_data", "2"]
    assert _one(spark, ["1", "12", "sem_data", "13"], fx.month_label) == ["jan", "dez", "sem_data",
                                                                          "mes_desconhecido"]


def test_status_relabel_and_safe_label(spark):
    assert _one(spark, ["Liquidado", "LIQUIDADO", "Em Aberto", "liquidado "], fx.status_relabel) == [
        "paga", "paga", "Em Aberto", "liquidado "]
    assert _one(spark, ["05-2021 (parte 1)", "a:b"], fx.safe_label) == ["05-2021_(parte_1)", "ab"]
