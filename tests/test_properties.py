"""Property tests (hypothesis) for the pure column logic, checked against plain Python models."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bandwise.functions.scoring import SALES_BANDS, band_of, uplift
from bandwise.operators.sampling import threshold_hex


def _band_py(v):
    for i, (lo, hi) in enumerate(SALES_BANDS):
        if v is not None and lo <= v <= hi:
            return i + 1
    return None


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-10, 4000), st.floats(-5, 3100, allow_nan=False)), min_size=1, max_size=200))
def test_band_of_matches_python(spark, values):
    df = spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "v double")
    got = [r[0] for r in df.select(band_of(F.col("v"))).collect()]
    assert got == [_band_py(v) for v in values]


@given(st.floats(0, 1), st.floats(0, 1))
def test_threshold_is_monotone_and_fixed_width(a, b):
    ta, tb = threshold_hex(a), threshold_hex(b)
    assert len(ta) == len(tb) == 8
    if a <= b:
        assert ta <= tb


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 31)), st.floats(0, 1000, allow_nan=False)), min_size=1, max_size=50))
def test_uplift_matches_python(spark, rows):
    df = spark.createDataFrame(rows, "d int, p double")
    got = [r[0] for r in df.select(uplift(F.col("p"), F.col("d"))).collect()]
    want = [p + p / 2 if d == 1 else (p + p / 2.5 if d is not None and 2 <= d <= 5 else p) for d, p in rows]
    assert got == want
