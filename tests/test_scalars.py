import decimal

from pyspark.sql import functions as F

from alertlens.functions import constants as C
from alertlens.functions import scalars as S
from alertlens.options import PORT, RECORD


def _col(spark, values, typ):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_latency_bucket_edges(spark):
    vals = [-1.0, 0.0, 0.5, 1800.0, 1800.4, 1801.0, 3600.0, 36000.0, 36000.1, 86400.0, 259200.0, 259201.0, None]
    df = _col(spark, vals, "double")
    rec = [r[0][:2] for r in df.select(S.latency_bucket(F.col("x"), RECORD)).collect()]
    assert rec == ["00", "01", "01", "01", "02", "02", "02", "11", "12", "12", "14", "15", "99"]
    port = [r[0][:2] for r in df.select(S.latency_bucket(F.col("x"), PORT)).collect()]
    assert port[1] == "00" and port[0] == "00" and port[2:] == rec[2:]
    sla = [r[0] for r in df.select(S.sla_flag(F.col("x"))).collect()]
    assert sla == ["Y", "Y", "Y", "Y", "N", "N", "N", "N", "N", "N", "N", "N", "N"]
    assert len(C.ALL_BUCKETS) == 17


def test_sub_second_latency(spark):
    df = spark.createDataFrame([("2024-01-01 00:30:00.400000", "2024-01-01 00:00:00")], "a string, b string")
    r = df.select(S.latency_seconds(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")).alias("s")).first()
    assert abs(r.s - 1800.4) < 1e-9
    assert df.select(S.latency_bucket(F.lit(r.s))).first()[0].startswith("02")


def test_null_rules(spark):
    df = spark.createDataFrame([(None, 5), (1, None), (None, None), (1, 5), (5, 1)], "a int, b int")
    rec = [r[0] for r in df.select(S.threshold_check(F.col("a"), F.col("b"), RECORD)).collect()]
    port = [r[0] for r in df.select(S.threshold_check(F.col("a"), F.col("b"), PORT)).collect()]
    assert rec == ["Y", "N", "N", "Y", "N"]
    assert port == ["N", "N", "N", "Y", "N"]
    gt = [r[0] for r in df.select(S.gt(F.col("a"), F.col("b"), "low")).collect()]
    assert gt == [False, True, False, False, True]


def test_safe_ts_forms(spark):
    vals = ["2024-01-02T03:04:05.123456Z", "2024-01-02 03:04:05.123456", "2024-01-02T03:04:05", "2024-01-02",
            "garbage", None, "2024-13-40 00:00:00"]
    out = [r[0] for r in _col(spark, vals, "string").select(S.safe_ts(F.col("x"))).collect()]
    assert out[0] == out[1] and out[0].microsecond == 123456
    assert out[2].second == 5 and out[3].hour == 0
    assert out[4:] == [None, None, None]


def test_safe_decimal(spark):
    vals = ["12.5", "123456789.99", "1234567890.99", "12345678901.5", "abc", None, "-0.005"]
    out = [r[0] for r in _col(spark, vals, "string").select(S.safe_decimal(F.col("x"))).collect()]
    assert out[0] == decimal.Decimal("12.50")
    assert out[1] == decimal.Decimal("123456789.99")
    assert out[2] == decimal.Decimal("1234567890.99")
    assert out[3] is None and out[4] is None and out[5] is None
    ten = [r[0] for r in _col(spark, ["123456789.99"], "string").select(S.safe_decimal(F.col("x"), 10, 2)).collect()]
    assert ten == [None]


def test_mask_and_blank(spark):
    df = _col(spark, ["000000123", "0000001234", "12", None], "string")
    rec = [r[0] for r in df.select(S.mask_id(F.col("x"), RECORD)).collect()]
    port = [r[0] for r in df.select(S.mask_id(F.col("x"), PORT)).collect()]
    assert rec[:3] == ["******123", "******123", "******"] and rec[3] is None
    assert port[:3] == ["******123", "******234", "******12"]
    b = _col(spark, ["", "  ", "a", None, " a "], "string")
    assert [r[0] for r in b.select(S.blank_to_null(F.col("x"))).collect()] == [None, None, "a", None, " a "]
    assert [r[0] for r in b.select(S.blank_label(F.col("x"))).collect()] == ["Blank", "Blank", "Not Blank", "Blank", "Not Blank"]


def test_partition_to_date_and_ceil(spark):
    df = _col(spark, ["20240105", "2024010", "20240230", None], "string")
    out = [r[0] for r in df.select(S.partition_to_date(F.col("x"))).collect()]
    assert str(out[0]) == "2024-01-05" and out[1:] == [None, None, None]
    m = _col(spark, [0.0, 0.1, 60.0, 60.1, -30.0, None], "double").select(S.ceil_minutes(F.col("x"))).collect()
    assert [r[0] for r in m] == [0, 1, 1, 2, 0, None]


def test_lookup(spark):
    df = _col(spark, ["COM16", "COM19", "X", None], "string")
    out = [r[0] for r in df.select(S.lookup(F.col("x"), C.DEFAULT_COMMENTS)).collect()]
    assert out[:2] == [C.DEFAULT_COMMENTS["COM16"], C.DEFAULT_COMMENTS["COM19"]] and out[2:] == [None, None]
