from bandwise.session import fresh_path
from bandwise.sources import fixtures as fx
from bandwise.streaming.features import sales_stream, stream_features, stream_scores, write_stream
from tests.conftest import SMALL


def test_stream_features_and_scores(spark):
    s = fx.sales(spark, SMALL)
    src, sink = fresh_path(spark, "t_src"), fresh_path(spark, "t_sink")
    s.write.parquet(src)
    lv1, lv2 = fx.fixed_predictors()
    q = write_stream(stream_scores(stream_features(sales_stream(spark, src, s.schema)), lv1, lv2), sink)
    q.awaitTermination()
    out = spark.read.parquet(sink)
    assert out.count() == s.count()
    assert {"Holiday", "Welfare", "welfareFlagDay", "pred_final"} <= set(out.columns)


def test_stream_resumes_from_checkpoint(spark):
    from pyspark.sql import functions as F

    s = fx.sales(spark, SMALL)
    src, sink, ckpt = fresh_path(spark, "r_src"), fresh_path(spark, "r_sink"), fresh_path(spark, "r_ckpt")
    first, second = s.filter(F.col("BranchCode") % 2 == 0), s.filter(F.col("BranchCode") % 2 == 1)
    first.write.parquet(src + "/a")
    stream = sales_stream(spark, src + "/*", s.schema)
    write_stream(stream_features(stream), sink, ckpt).awaitTermination()
    n1 = spark.read.parquet(sink).count()
    second.write.parquet(src + "/b")
    write_stream(stream_features(sales_stream(spark, src + "/*", s.schema)), sink, ckpt).awaitTermination()
    assert n1 == first.count()
    assert spark.read.parquet(sink).count() == s.count()  # only the new file was added
