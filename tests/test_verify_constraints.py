"""Verification (V1-V6) and declared-constraint audits (C-N1..C-N5)."""

from decimal import Decimal

from pyspark.sql import functions as F

from tally.operators import constraints as cn
from tally.operators import verify as vf
from tally.sources.ledger_view import from_driver_tables


def _frame(spark, rows):
    return spark.createDataFrame([(i, Decimal(v)) for i, v in rows], "Id string, `Valor documento` decimal(22,6)")


def _checks(spark, original, parts):
    out = vf.verify(_frame(spark, original), _frame(spark, parts), "Id", ["Valor documento"])
    return {r.check: r.passed for r in out.collect()}


def test_verify_equal_missing_extra_and_sums(spark):
    base = [("1", "10.00"), ("2", "20.00")]
    assert all(_checks(spark, base, base).values())
    c = _checks(spark, base, [("1", "10.00")])
    assert not c["row_count"] and not c["ids_missing"] and c["ids_extra"]
    c = _checks(spark, base, base + [("3", "0")])
    assert not c["ids_extra"] and c["ids_missing"]
    assert _checks(spark, base, [("1", "10.01"), ("2", "20.00")])["sum:Valor documento"]      # off by 0.01
    assert not _checks(spark, base, [("1", "10.02"), ("2", "20.00")])["sum:Valor documento"]  # off by 0.02


def test_column_checks(spark):
    headers = spark.createDataFrame([("f1", ["Id", "Valor"]), ("f2", ["Id"])], "_part_file string, columns array<string>")
    got = {r._part_file: (r.missing_columns, r.passed) for r in vf.column_checks(["Id", "Valor"], headers).collect()}
    assert got == {"f1": ([], True), "f2": (["Valor"], False)}


def test_constraint_audits_on_ledger(spark):
    t = from_driver_tables(spark, "/root/testdata/sf0.001")
    pk = cn.pk_duplicates(t)
    assert pk.where("table != 'DOC_FINANCEIRO_PARCELA'").count() == 0
    orphans = {(r.child, r.coluna) for r in cn.fk_orphans(t).collect()}
    assert ("DOC_FINANCEIRO", "COND_PAGTO_ID") in orphans and ("PESSOA", "MUNICIPIO_ID") in orphans
    nn = {(r.table, r.coluna): r.n for r in cn.not_null_violations(t).collect()}
    assert nn[("PESSOA", "NM_PESS_IDENT")] > 0 and nn[("DOC_FINANCEIRO", "PESSOA_ID")] == 0
    ln = {(r.table, r.coluna): r.n for r in cn.length_violations(t).collect()}
    assert ln[("CONTATO", "DS_CTT_TTRM")] > 0


def test_constraint_edges(spark):
    t = from_driver_tables(spark, "/root/testdata/sf0.001")
    contato = spark.createDataFrame(
        [(1, 1, "n", None, None, "123456", None, True), (1, 999999, "n", None, None, None, None, False)],
        t.CONTATO.schema)
    t2 = t.replace(CONTATO=contato)
    assert cn.pk_duplicates(t2).where("table = 'CONTATO'").first().n == 2
    assert cn.fk_orphans(t2).where("child = 'CONTATO'").first().key == "999999"
    assert {r.coluna: r.n for r in cn.length_violations(t2).where("table = 'CONTATO'").collect()}["DS_CTT_TTRM"] == 1
    d = spark.createDataFrame([(1, None)], "id int, VL_DMOVI_TXCOBR decimal(22,6)")
    assert float(cn.apply_defaults(d, "DOC_FINANCEIRO_PARCELA").first().VL_DMOVI_TXCOBR) == 0.0
    assert F  # keep import used


def test_default_contact_cases(spark):
    from tally.plans.views import default_contact
    rows = [(10, 1, "n", None, None, "1111", None, True),                       # one default
            (20, 2, "n", None, None, "2222", None, True),                       # two defaults: lowest id wins
            (21, 2, "n", None, None, "2121", None, True),
            (19, 2, "n", None, None, "1919", None, False),                      # lower id but not default
            (30, 3, "n", None, None, "3333", None, False)]                      # only non-default
    schema = ("CONTATO_ID long, PESSOA_ID long, DS_CTT_NOME string, DS_CTT_CARGO string, "
              "DT_CTT_NASC timestamp_ntz, DS_CTT_TTRM string, NO_CTT_CPF string, ID_CTT_PADR boolean")
    got = {r.PESSOA_ID: r.Fone for r in default_contact(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: "1111", 2: "2222"}                                        # person 3 and 4 (none): no row


def test_orphans_settle_in_one_shuffle(spark):
    """All references meet in one aggregate: one exchange, no join."""
    from tally.operators import constraints as cn
    from tally.sources.ledger_view import from_driver_tables
    from tally.sources.ledger_view import from_parquet
    from tally.session import scratch_path
    t = from_driver_tables(spark, "/root/testdata/sf0.001")
    folder = scratch_path(spark, "fk-ledger")
    for name in t.names():
        t.table(name).write.parquet(f"{folder}/{name}.parquet")
    plan = cn.fk_orphans(from_parquet(spark, folder))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
