"""The original module read headed CSV without a schema, so every column was text.
The whole feature flow must give the same cleaned rows from all-string inputs."""

from pyspark.sql import functions as F

from bandwise.operators import clean as cl
from bandwise.plans import features as fe
from bandwise.plans import registry
from bandwise.session import fresh_path
from bandwise.sources import files
from bandwise.sources import fixtures as fx
from tests.conftest import SMALL


def _as_csv(spark, df, name):
    path = fresh_path(spark, name)
    df.write.option("header", "true").csv(path)
    return files.read_file(spark, path, "csv")  # no schema: every column is a string


def test_feature_flow_from_headed_csv_without_schema(spark):
    sales = _as_csv(spark, fx.sales(spark, SMALL).withColumnRenamed("BranchCode", "Branchcode"), "t_sales")
    ps = _as_csv(spark, fx.price_sensitivity(spark, SMALL), "t_ps")
    tier = _as_csv(spark, fx.tier(spark, SMALL), "t_tier")
    wf = _as_csv(spark, fx.welfare_branches(spark, SMALL), "t_wf")
    assert all(t == "string" for _, t in sales.dtypes + ps.dtypes + tier.dtypes + wf.dtypes)
    bw = registry._branch_weather(spark, SMALL).select("BranchCode", "name", "temp")
    got = cl.clean(fe.prepare_features(sales, ps, tier, wf, bw), "full")
    want = registry.q_clean_full(spark, SMALL)
    cols = [c for c in want.columns if c not in ("SalDate", "Tier", "temp")]
    got_rows = got.select(F.to_date("SalDate").alias("SalDate"), *cols).exceptAll(want.select("SalDate", *cols))
    assert got.count() == want.count() and got_rows.count() == 0
