"""Randomised properties of the split operators against plain pandas statements."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tally.operators import parts as pt

rows_strategy = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(1, 400)), min_size=0, max_size=60)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, limit=st.integers(300, 3000))
def test_equal_row_parts_property(spark, rows, limit):
    data = [(g, i, b) for i, (g, b) in enumerate(rows)]
    df = spark.createDataFrame(data, "g string, id long, b long")
    out = pt.equal_row_parts(df, ["g"], ["id"], "b", limit, 50).toPandas()
    if not data:
        assert out.empty
        return
    pdf = pd.DataFrame(data, columns=["g", "id", "b"])
    k = max(1, int((limit * 0.95) / ((pdf.b.sum() + 50) / len(pdf))))
    pdf = pdf.sort_values(["g", "id"])
    pdf["pos"] = pdf.groupby("g").cumcount() + 1
    pdf["n"] = pdf.groupby("g")["id"].transform("size")
    pdf["kg"] = pdf["n"].clip(upper=k)
    pdf["parte"] = (pdf["pos"] - 1) // pdf["kg"] + 1
    pdf["n_parts"] = pdf.apply(lambda r: math.ceil(r.n / r.kg), axis=1)
    got = out.sort_values(["g", "id"])[["g", "id", "pos", "parte", "n_parts"]].reset_index(drop=True)
    want = pdf[["g", "id", "pos", "parte", "n_parts"]].reset_index(drop=True)
    assert got.astype(str).equals(want.astype(str))
