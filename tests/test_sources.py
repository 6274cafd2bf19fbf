import pytest

from bandwise.session import fresh_path, shared_dir
from bandwise.sources import files
from bandwise.sources import fixtures as fx
from tests.conftest import SMALL


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_read_file_any_format_with_schema(spark, fmt):
    s = fx.sales(spark, SMALL)
    path = fresh_path(spark, f"src_{fmt}")
    files.write_table(s, path, fmt=fmt) if fmt != "csv" else s.write.option("header", "true").csv(path)
    back = files.read_file(spark, path, fmt, schema=s.schema)
    assert back.schema == s.schema
    assert back.exceptAll(s).count() == 0 and s.exceptAll(back).count() == 0


def test_report_csv_is_one_headed_file(spark):
    import glob

    rep = spark.sql("SELECT 1 AS band_id, 'x' AS Range")
    path = files.write_report_csv(rep, fresh_path(spark, "rep"))
    parts = glob.glob(path.replace("file:", "") + "/part-*.csv")
    assert len(parts) == 1 and open(parts[0]).readline().strip() == "band_id,Range"


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.sparkContext.getCheckpointDir()
    assert fresh_path(spark, "a") != fresh_path(spark, "a")


def test_no_shared_folder_is_an_error():
    class Context:
        def getCheckpointDir(self):  # noqa: N802
            return None

    class Session:
        sparkContext = Context()  # noqa: N815

        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_bucketed_tables_join_without_shuffle(spark):
    from bandwise.operators import enrich as en

    sales = fx.sales(spark, SMALL)
    ps = en.price_sensitivity_dim(fx.price_sensitivity(spark, SMALL)).withColumnsRenamed(
        {"BC2": "BranchCode", "MC2": "MaterialCode"}
    )
    keys = ["BranchCode", "MaterialCode"]
    s_b = files.write_bucketed(sales, "t_sales_b", keys, 8, fresh_path(spark, "sales_b"))
    p_b = files.write_bucketed(ps, "t_ps_b", keys, 8, fresh_path(spark, "ps_b"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = s_b.join(p_b, keys, "left")
        n = joined.count()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert n == sales.count()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_feature_operators_keep_bucketing(spark):
    from bandwise.functions.calendar import encode_calendar
    from bandwise.operators import enrich as en

    keys = ["BranchCode", "MaterialCode"]
    s_b = files.write_bucketed(fx.sales(spark, SMALL), "t_sales_b2", keys, 8, fresh_path(spark, "sales_b2"))
    raw = fx.price_sensitivity(spark, SMALL).withColumnsRenamed({"Branch": "BranchCode"})
    p_b = files.write_bucketed(raw, "t_ps_b2", keys, 8, fresh_path(spark, "ps_b2")).withColumnsRenamed(
        {"BranchCode": "Branch"}
    )
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = en.join_price_sensitivity(encode_calendar(s_b), en.price_sensitivity_dim(p_b))
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
