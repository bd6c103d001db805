import random

import pytest
from pyspark.sql import functions as F

import flowloom.functions as fn


def values(spark, expressions, texts, kind="string"):
    df = spark.createDataFrame([(t,) for t in texts], f"t {kind}")
    return [tuple(r) if len(r) > 1 else r[0] for r in df.select(*expressions).collect()]


def test_ip_to_int_edges(spark):
    texts = [None, "", "a.b.c.d", "10.1.2", "10.1.2.3", "255.255.255.255", "256.1.1.1", "1.2.3.4.5", "128.0.0.0", " 1.2.3.4"]
    expected = [None, None, None, None, 167838211, 4294967295, None, None, 2147483648, None]
    assert values(spark, [fn.ip_to_int(F.col("t"))], texts) == expected


def test_ip_round_trip(spark):
    rng = random.Random(1)
    numbers = [0, 1, 255, 256, 2**31, 2**32 - 1] + [rng.randrange(2**32) for _ in range(500)]
    back = values(spark, [fn.ip_to_int(fn.int_to_ip(F.col("t")))], numbers, "bigint")
    assert back == numbers
    assert values(spark, [fn.int_to_ip(F.col("t"))], [-1, 2**32, None], "bigint") == [None, None, None]


@pytest.mark.parametrize("prefix,last", [(24, 255), (31, 1), (32, 0), (8, 2**24 - 1)])
def test_cidr_end(spark, prefix, last):
    assert values(spark, [fn.cidr_end(F.col("t"), F.lit(prefix))], [0], "bigint") == [last]


def test_open_sequence(spark):
    df = spark.createDataFrame([(5, 4), (5, 5), (5, 6), (5, 7), (5, 9)], "a bigint, b bigint")
    assert [r[0] for r in df.select(fn.open_sequence(F.col("a"), F.col("b"))).collect()] == [[], [], [], [6], [6, 7, 8]]


def test_internal_ip(spark):
    texts = ["10.1.2.3", "10.1.2", "110.1.2.3", "10.1", None, "192.168.0.1"]
    strict, loose = fn.is_internal_ip(F.col("t")), fn.is_internal_ip(F.col("t"), False)
    assert values(spark, [strict, loose], texts) == [
        (True, True), (False, True), (False, True), (False, False), (False, False), (False, False)]


def test_text_functions(spark):
    assert values(spark, [fn.basename(F.col("t"))], ["/a/b/c.csv", "c.csv", "/a/b/", "/"]) == ["c.csv", "c.csv", "b", ""]
    assert values(spark, [fn.safe_int(F.col("t"))], ["12", "-3", "NA", "", None, "1.5", "99999999999"]) == [12, -3, -1, -1, -1, -1, -1]
    assert values(spark, [fn.list_size(F.col("t"))], [None, "", "a", "a,b,,", ",a"]) == [0, 0, 1, 2, 1]
    assert values(spark, [fn.gb_to_mb(F.col("t"))], ["1,5", "2", "NA", None, "0,0004"]) == [1500, 2000, 0, 0, 0]
    assert values(spark, [fn.sanitize_label(F.col("t"))], ["a b|c (d)"]) == ["a_b&c_-d"]
    assert values(spark, [fn.normalize_user(F.col("t"), ".corp.example")], ["Ann@D.CORP.example", "Ann@Dxcorp.example"]) == ["ann@d", "ann@dxcorp.example"]
    assert values(spark, [fn.default_site(F.col("t"))], [None, "", "S1"]) == ["nf", "nf", "S1"]


def test_dates(spark):
    texts = ["03-JAN-16", "03-jan-2016", "03-01-16", "03-01-2016", "99-01-16", "x", None]
    assert [str(v) for v in values(spark, [fn.normalize_date(F.col("t"))], texts)] == ["2016-01-03"] * 4 + ["None"] * 3
    assert [str(v) for v in values(spark, [fn.parse_compact_ts(F.col("t"))], ["20160503-0710", "bad"])] == ["2016-05-03 07:10:00", "None"]
    assert values(spark, [fn.hour_of(F.col("t"))], ["2016-05-03T04:00:00", "junk"]) == [4, None]


def test_metric_names(spark):
    tags = fn.metric_tags(F.col("t"))
    texts = ["iostat:mount=/d,device=/dev/sd", "iostat:mount=C:", "sysstat", "iostat:"]
    assert values(spark, [tags, fn.tag_get(tags, "mount"), fn.tag_get(tags, "device")], texts) == [
        ("mount=/d,device=/dev/sd", "/d", "/dev/sd"), ("mount=C:", "C:", ""), (None, "", ""), ("", "", "")]
    shown = ["PROCESSOR Utilization - Overall CPU", "MemPhysUsage:x^^%", "Ldsk:/v (/dev/a):Used^^MB", "Ldiskq (C:)^^#", "Other"]
    assert values(spark, [fn.stream_table(F.col("t")), fn.stream_metric(F.col("t"))], shown) == [
        ("sysstat", "processor utilization - overall cpu"), ("sysstat", "x_percent"),
        ("iostat:mount=:/v,device=/dev/a", "used_mb"), ("iostat:mount=C:", "diskq_count"), ("app", "other")]


def test_decode_port(spark):
    parts = list(fn.decode_port(F.col("t")).values())
    assert values(spark, parts, ["10013", "24000", "8080"]) == [
        ("front", "ECC", "HTTPS", "n+3"), ("back", "ECM", "HTTP", "n"), ("front", "ECC", "HTTP", "n")]
