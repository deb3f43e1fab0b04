import math

import pandas as pd


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def rows(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(out, key=repr)


def assert_same(spark_pdf, duck_pdf):
    sc, sr = rows(spark_pdf)
    dc, dr = rows(duck_pdf)
    assert sc == dc, (sc, dc)
    assert len(sr) == len(dr), (len(sr), len(dr))
    for a, b in zip(sr, dr):
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, float):
                assert math.isclose(x, y, rel_tol=1e-12, abs_tol=1e-12), (a, b)
            else:
                assert x == y, (a, b)
