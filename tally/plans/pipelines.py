"""End-to-end pipelines (W5-W11): export -> audit -> impute -> conform -> split -> write -> verify."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally import schemas as S
from tally.functions import csvbytes as cb
from tally.functions import scalars as fx
from tally.operators import buckets as bk
from tally.operators import parts as pt
from tally.operators.conform import conform, export_format
from tally.operators.impute import impute
from tally.operators.positions import positions
from tally.operators.quality import audit
from tally.plans import views
from tally.sources.ledger_view import Ledger

DATASETS = {
    "contas_pagar": (S.PAYABLES_EXPORT_COLUMNS, S.PAYABLES_TEMPLATE, S.PAYABLES_RENAMES, "contas_a_pagar"),
    "contas_receber": (S.RECEIVABLES_EXPORT_COLUMNS, S.RECEIVABLES_TEMPLATE, {}, "contas_a_receber"),
    "contatos": (S.CONTACTS_COLUMNS, S.CONTACTS_TEMPLATE, {}, "contatos"),
}


def export(t: Ledger, dataset: str, establishments: Sequence[int] = S.TARGET_ESTABLISHMENTS) -> DataFrame:
    """The dataset as exported: business labels, dates as 'dd/MM/yyyy' text."""
    columns = DATASETS[dataset][0]
    if dataset == "contas_pagar":
        df = views.payables(t, establishments)
    elif dataset == "contas_receber":
        df = views.receivables(t, establishments)
    else:
        df = views.contacts(t)
    return export_format(df, columns, dataset)


def template_rows(t: Ledger, dataset: str, as_of: dt.datetime | None = None,
                  establishments: Sequence[int] = S.TARGET_ESTABLISHMENTS,
                  imputed: bool = True) -> DataFrame:
    """Export -> (impute) -> conform to the import template (Q6: imputed rows flow on)."""
    _, template, renames, _ = DATASETS[dataset]
    df = export(t, dataset, establishments)
    if imputed and as_of is not None:
        df = impute(df, dataset, as_of)
    return conform(df, template, renames)


def with_row_bytes(df: DataFrame, columns: Sequence[str] | None = None, col: str = "_bytes") -> DataFrame:
    cols = list(columns or df.columns)
    return df.withColumn(col, cb.row_bytes(df, cols))


def total_order(df: DataFrame, first: Sequence[Column] = (), columns: Sequence[str] | None = None) -> list[Column]:
    """Sort keys making the row order total: ``first``, numeric id, then every column."""
    cols = list(columns or df.columns)
    keys = list(first)
    idc = next((c for c in S.VARIANTS["id"] if c in cols), None)
    if idc:
        keys.append(F.col(f"`{idc}`").cast("string").try_cast("long"))
    keys += [F.col(f"`{c}`") for c in cols]
    return keys


# --- W7: establishment x month x part -----------------------------------------

def split_by_establishment_month(df: DataFrame, template: S.Template = S.PAYABLES_TEMPLATE,
                                 limit: float = S.TEMPLATE_SPLIT_LIMIT,
                                 establishments: Sequence[int] | None = S.TARGET_ESTABLISHMENTS,
                                 with_year: bool = False, prefix: str = "contas_a_pagar") -> DataFrame:
    """Template rows of the target establishments with ``mes``, ``parte``, ``n_parts`` and ``file_name``.

    Parts hold k rows, k from the average CSV row size of the rows being
    split; rows are ordered by due date, then id, then every column.
    """
    cols = list(template.columns)
    if establishments is not None:
        df = df.where(F.col("Estabelecimento_id").isin(list(establishments)))
    df = df.withColumn("mes", fx.due_month(F.col("`Data vencimento`"), with_year=with_year))
    df = with_row_bytes(df, cols)
    header = cb.header_bytes(cols)
    order = total_order(df, [fx.parse_date(F.col("`Data vencimento`"))], cols)
    out = pt.equal_row_parts(df, ["Estabelecimento_id", "mes"], order, "_bytes", limit, header)
    mes_label = F.col("mes") if with_year else fx.month_label(F.col("mes"))
    base = F.concat(F.lit(f"{prefix}_est_"), F.col("Estabelecimento_id").cast("string"), F.lit("_"), mes_label)
    name = F.when(F.col("n_parts") > 1, F.concat(base, F.lit("_parte_"), fx.part_number_text(F.col("parte"))))\
            .otherwise(base)
    return out.withColumn("mes_label", mes_label).withColumn("file_name", name)


# --- W9: row split --------------------------------------------------------------

def split_contacts_rows(df: DataFrame, template: S.Template = S.CONTACTS_TEMPLATE,
                        limit: float = S.TEMPLATE_SPLIT_LIMIT, prefix: str = "contatos") -> DataFrame:
    """Whole-table equal-row parts (contacts splitter): ``parte`` and ``file_name``."""
    cols = list(template.columns)
    df = with_row_bytes(df, cols)
    out = pt.equal_row_parts(df, [], total_order(df, [], cols), "_bytes", limit, cb.header_bytes(cols))
    return out.withColumn("file_name", F.concat(F.lit(f"{prefix}_parte_"), fx.part_number_text(F.col("parte"))))


def split_by_rows(df: DataFrame, limit: float = S.DATE_SPLIT_LIMIT, columns: Sequence[str] | None = None,
                  order: Sequence[Column] | None = None, fill: float = S.ROW_SPLIT_FILL,
                  prefix: str = "parte") -> DataFrame:
    """Recursive row split of the whole table (``parte`` 1..n)."""
    cols = list(columns or [c for c in df.columns if not c.startswith("_")])
    if "_bytes" not in df.columns:
        df = with_row_bytes(df, cols)
    order = list(order) if order is not None else total_order(df, [], cols)
    with_pos = positions(df, [], order)
    out = pt.recursive_parts(with_pos, [], "_bytes", limit, cb.header_bytes(cols), fill)
    return out.withColumn("file_name", F.concat(F.lit(f"{prefix}_parte_"), F.col("parte").cast("string")))


# Plain bytes of a part before it is compressed, in units of the written limit; what a task measures is bounded by it.
PLAIN_PER_WRITTEN = 16


def split_measured(df: DataFrame, path: str, limit: float = S.DATE_SPLIT_LIMIT, columns: Sequence[str] | None = None,
                   compression: str = "gzip", prefix: str = "parte", plain: float = PLAIN_PER_WRITTEN) -> DataFrame:
    """K7: row parts as compressed CSV whose written files fit ``limit``; (file_name, bytes) of the files.

    Parts are cut at ``plain * limit`` bytes of CSV, written, measured, and divided again where they are over.
    """
    from tally.sinks.writers import write_parts
    from tally.sources.tables import part_headers, part_name

    cols = list(columns or [c for c in df.columns if not c.startswith("_")])
    parts = split_by_rows(df, plain * limit, cols, prefix=prefix)
    write_parts(parts, path, ["file_name"], ["pos"], columns=cols, compression=compression, limit=limit)
    return part_headers(df.sparkSession, path, glob="*.csv*").select(
        part_name("_part_file").alias("file_name"), F.col("_part_size").alias("bytes"))


# --- W8: adaptive date split --------------------------------------------------

def split_by_date(df: DataFrame, date_col: str, limit: float = S.DATE_SPLIT_LIMIT,
                  columns: Sequence[str] | None = None, prefix: str = "part") -> tuple[DataFrame, str]:
    """Adaptive date-range split: returns (rows with ``date_label``/``parte``/``file_name``, level).

    The level is the coarsest of 5y/year/month/week/day whose largest bucket
    fits; buckets still over the limit at that level are row-split (R2) into
    '<label> (parte i)'.  Rows without a date form a 'sem_data' bucket.  When all
    rows fit into one file nothing is split (T9): level 'whole', no label.
    """
    cols = list(columns or df.columns)
    header = cb.header_bytes(cols)
    dtype = df.schema[date_col].dataType
    base = with_row_bytes(df, cols).withColumn("_d", fx.parse_date(F.col(f"`{date_col}`"), dtype))
    base = base.checkpoint(eager=True)  # read by the size pass, the bucket pass and the split
    daily = bk.daily_sizes(base, F.col("_d"), "_bytes")
    total = daily.agg(F.sum("bytes")).first()[0]
    if total is not None and total + header <= limit:
        whole = base.withColumns({"parte": F.lit(0), "date_label": F.lit(None).cast("string"), "file_name": F.lit(prefix)})
        return whole, "whole"
    dated = daily.where(F.col("day").isNotNull())
    anchors = dated.agg(F.min("day").alias("d0")).first()
    if anchors["d0"] is None:
        out = split_by_rows(base, limit, cols, total_order(base, [], cols), prefix=prefix)
        return out.withColumn("date_label", F.lit(None).cast("string")), "rows"
    sizes = bk.level_sizes(dated, header)
    level = bk.choose_level(sizes, limit)
    d0 = anchors["d0"]
    label, _start = bk.bucket_expr(F.col("_d"), level, F.lit(d0), F.lit(d0.year))
    x = base.withColumn("_label", label)
    bsize = x.groupBy("_label").agg((F.sum("_bytes") + F.lit(header)).alias("_bb"))
    x = pt._join(x, bsize, ["_label"])       # one row per bucket: bounded by the calendar span, not by rows
    fits = x.where(F.col("_bb") <= F.lit(limit)).withColumn("parte", F.lit(0))
    big = x.where(F.col("_bb") > F.lit(limit))
    big = positions(big, ["_label"], total_order(big, [F.col("_d")], cols), total_bytes=total)
    big = pt.recursive_parts(big, ["_label"], "_bytes", limit, header, S.ROW_SPLIT_FILL).drop("pos")
    out = fits.unionByName(big).drop("_bb")
    final = F.when(F.col("parte") > 0, F.concat(F.col("_label"), F.lit(" (parte "), F.col("parte").cast("string"),
                                                 F.lit(")"))).otherwise(F.col("_label"))
    out = out.withColumn("date_label", final)
    return out.withColumn("file_name", F.concat(F.lit(f"{prefix}_"), fx.safe_label(F.col("date_label")))), level


# --- W5 + W6: audit and impute -------------------------------------------------

def audit_dataset(t: Ledger, dataset: str, as_of: dt.datetime,
                  establishments: Sequence[int] = S.TARGET_ESTABLISHMENTS, with_record: bool = False,
                  only: Sequence[str] | None = None) -> DataFrame:
    return audit(export(t, dataset, establishments), dataset, as_of, with_record=with_record, only=only)


def audit_all(t: Ledger, as_of: dt.datetime, establishments: Sequence[int] = S.TARGET_ESTABLISHMENTS,
              only: Sequence[str] | None = None, datasets: Sequence[str] | None = None) -> DataFrame:
    """Violations of all datasets (or of ``datasets``), of all rules (or of ``only``)."""
    frames = [audit_dataset(t, d, as_of, establishments, only=only) for d in datasets or DATASETS]
    return reduce(DataFrame.unionByName, frames)


# --- the whole job --------------------------------------------------------------------------

def run_dataset(t: Ledger, dataset: str, out_dir: str, as_of: dt.datetime,
                establishments: Sequence[int] = S.TARGET_ESTABLISHMENTS, split: str = "template",
                limit: float | None = None, impute_rows: bool = True) -> DataFrame:
    """Export, audit, impute, write the full copy, split, write the parts, verify them.

    ``split``: 'template' (establishment x month for accounts, row parts for
    contacts, at the template limit), 'date' (adaptive date ranges at the date
    limit) or 'rows' (recursive row split).  Writes under ``out_dir``:
    ``violations/`` (K6), ``<name>_completo/`` (K1), ``parts/`` (one CSV per part,
    K2-K5) and ``manifest/`` (K9, with each part's id digests and sums, see ``verify.check_parts``).  Returns the verification checks (W10), made
    by reading the written part files back, and an ``overall`` row (V6).
    """
    from tally.operators.verify import check_parts, column_checks, overall, part_digests, verify
    from tally.sinks.writers import write_full, write_parts, write_violations
    from tally.sources.tables import part_headers, part_name, read_parts

    _, template, renames, name = DATASETS[dataset]
    cols = list(template.columns)
    exported = export(t, dataset, establishments)
    write_violations(audit(exported, dataset, as_of, with_record=True), f"{out_dir}/violations")
    rows = impute(exported, dataset, as_of) if impute_rows else exported
    rows = conform(rows, template, renames)
    write_full(rows, f"{out_dir}/{name}_completo")
    rows = t.PESSOA.sparkSession.read.schema(rows.schema).parquet(f"{out_dir}/{name}_completo")     # the export runs no second time
    header = cb.header_bytes(cols)
    if split == "template" and dataset != "contatos":
        parts = split_by_establishment_month(rows, template, limit or S.TEMPLATE_SPLIT_LIMIT, establishments,
                                             prefix=name)
        original = rows.where(F.col("Estabelecimento_id").isin(list(establishments)))
        order = ["pos"]
    elif split == "template":
        parts = split_contacts_rows(rows, template, limit or S.TEMPLATE_SPLIT_LIMIT, prefix=name)
        original, order = rows, ["pos"]
    elif split == "date":
        date_col = "Data Emissao" if dataset != "contatos" else "Data nascimento"
        parts, _ = split_by_date(rows, date_col, limit or S.DATE_SPLIT_LIMIT, cols, prefix=name)
        original, order = rows, [F.col("_d")] + total_order(rows, [], cols)
    else:
        parts = split_by_rows(rows, limit or S.DATE_SPLIT_LIMIT, cols, prefix=name)
        original, order = rows, ["pos"]
    parts = parts.checkpoint(eager=True)  # written and reported from one materialisation
    write_parts(parts, f"{out_dir}/parts", ["file_name"], order, columns=cols)
    idc = cols[0]
    sums = [c for c in cols if template.kind(c) == "money"]
    sizes = pt.manifest(parts, ["file_name"], "_bytes", header).drop("rows")
    sizes.join(part_digests(parts, ["file_name"], idc, sums), "file_name").write.mode("overwrite").parquet(f"{out_dir}/manifest")
    # fields with line breaks need a reader that does not cut files at lines
    text = [F.col(f"`{c}`") for c in cols if template.kind(c) not in ("money", "int", "flag")]
    broken = reduce(lambda a, b: a | b, [F.coalesce(c.rlike("[\\r\\n]"), F.lit(False)) for c in text])
    back = read_parts(t.PESSOA.sparkSession, f"{out_dir}/parts", columns=cols, multi_line=not parts.where(broken).isEmpty())
    checks = verify(original, back, idc, sums)
    heads = column_checks(cols, part_headers(t.PESSOA.sparkSession, f"{out_dir}/parts"))
    col_check = heads.agg(F.count_if("passed").cast("double").alias("actual"),
                          F.count(F.lit(1)).cast("double").alias("expected")) \
        .select(F.lit("columns").alias("check"), "expected", "actual",
                (F.col("expected") == F.col("actual")).alias("passed"))
    stored = t.PESSOA.sparkSession.read.parquet(f"{out_dir}/manifest")
    found = part_digests(back.withColumn("file_name", part_name("_part_file")), ["file_name"], idc, sums)
    part_check = check_parts(stored, found, ["file_name"], sums).agg(
        F.count_if("passed").cast("double").alias("actual"), F.count(F.lit(1)).cast("double").alias("expected")) \
        .select(F.lit("parts").alias("check"), "expected", "actual", (F.col("expected") == F.col("actual")).alias("passed"))
    checks = checks.unionByName(col_check).unionByName(part_check).checkpoint(eager=True)
    return checks.unionByName(overall(checks).select(
        F.lit("overall").alias("check"), F.col("checks").cast("double").alias("expected"),
        F.col("passed_checks").cast("double").alias("actual"), "passed"))


def resplit_written_parts(spark, path: str, columns: Sequence[str], out_path: str,
                          threshold: float = S.RESPLIT_THRESHOLD, targets: Sequence[float] = S.RESPLIT_TARGETS,
                          limit: float = S.DATE_SPLIT_LIMIT, order: Sequence[Column] | None = None,
                          multi_line: bool = False, known: DataFrame | None = None) -> DataFrame:
    """Second pass over written part files; files over ``threshold`` bytes are split again.

    Sizes come from the listing: files up to ``threshold`` are not opened but stay where they are, and the
    manifest refers to them.  A filter on the file size leaves them out of the scan, so the rows read are
    those of over-size files; they keep their order in the file, unless ``order`` gives another.  New parts
    are ``<out_path>/<file>_parte_<i>.csv`` or ``<file>_parte_<i>_<j>.csv``.  Returns the manifest: file_name, rows, bytes,
    path.  Rows of files that stay come from ``known`` (file_name, rows), the manifest of the first pass; else they are null.
    """
    from tally.sinks.writers import write_parts
    from tally.sources.tables import part_headers, part_name, read_parts

    cols = list(columns)
    header = cb.header_bytes(cols)
    listed = part_headers(spark, path).select(part_name("_part_file").alias("file_name"), F.col("_part_size").alias("bytes"),
                                              F.col("_part_file").alias("path"))
    stay = listed.where(F.col("bytes") <= threshold)
    if known is not None:
        stay = stay.join(known.select("file_name", "rows"), "file_name", "left")
    else:
        stay = stay.withColumn("rows", F.lit(None).cast("long"))
    rows = read_parts(spark, path, columns=cols, multi_line=multi_line, larger_than=threshold)
    rows = rows.withColumn("_line", F.monotonically_increasing_id()).withColumn("_base", part_name("_part_file"))
    rows = with_row_bytes(rows, cols).select(*[F.col(f"`{c}`") for c in cols], "_base", "_bytes", "_part_start", "_line")
    rows = rows.checkpoint(eager=True)                  # fixes the line numbers
    # a file's blocks in order, and the lines of a block as its one task met them
    order = list(order) if order is not None else ["_part_start", "_line"]
    rows = positions(rows, ["_base"], order, pos_col="_pos")
    out = pt.resplit(rows, ["_base"], ["_pos"], "_bytes", header, threshold, targets, limit)
    sub, subsub = F.col("sub"), F.col("subsub")
    name = F.when(sub == 0, F.col("_base")).when(subsub == 0, F.concat_ws("_", "_base", F.lit("parte"), sub)) \
        .otherwise(F.concat_ws("_", "_base", F.lit("parte"), sub, subsub))
    out = out.withColumn("file_name", name).checkpoint(eager=True)
    write_parts(out, out_path, ["file_name"], ["_pos"], columns=cols)
    made = pt.manifest(out, ["file_name"], "_bytes", header).withColumn(
        "path", F.concat(F.lit(out_path.rstrip("/") + "/"), F.col("file_name"), F.lit(".csv")))
    return made.unionByName(stay).orderBy("file_name")
