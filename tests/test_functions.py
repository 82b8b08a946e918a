from pyspark.sql import functions as F

from burstguard.functions import (
    csv_time_ms,
    first_not_blank,
    flex_time_ms,
    group_key,
    is_sensitive_action,
    is_small_payment,
    is_suspicious_payment,
    normalize_action,
    safe_double,
    safe_long,
    transaction_time_ms,
)


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v"))).first()[0]


def test_actions(spark):
    cases = {" view ": "VIEW", "add_to_cart": "ADD_CART", "Remove_From_Cart": "REMOVE_CART", "cart": "CART", None: None}
    for text, name in cases.items():
        assert one(spark, text, normalize_action) == name
    assert one(spark, "withdraw", is_sensitive_action) is True
    assert one(spark, None, is_sensitive_action) is False


def test_payments(spark):
    nan = float("nan")
    rows = [("PAYMENT", 99.99), ("PAYMENT", 100.0), ("PAYMENT", 1000.0), ("PAYMENT_FRAUD", None), ("PAYMENT", None),
            ("PAYMENT", nan), ("ORDER", 5.0)]
    df = spark.createDataFrame(rows, "a string, v double")
    got = df.select(is_small_payment(F.col("a"), F.col("v")), is_suspicious_payment(F.col("a"), F.col("v"))).collect()
    assert [tuple(r) for r in got] == [
        (True, False), (False, False), (False, True), (False, True), (False, False), (False, False), (False, False)
    ]


def test_times(spark):
    cases = {
        "2019-10-01 00:00:01": 1569888001000,
        "2019-10-01T00:00:01.250": 1569888001250,
        "2019-10-01T00:00:01.250Z": 1569888001250,
        "1569888001": 1569888001000,
        " 1569888001000 ": 1569888001000,
        "2019-02-31 00:00:00": 1551312000000,
        "2019-13-01 00:00:00": None,
        "2019-10-01": None,
        "-5": None,
        "": None,
        None: None,
    }
    for text, ms in cases.items():
        assert one(spark, text, flex_time_ms) == ms, text
    assert one(spark, "2019-10-01 00:00:01 UTC", csv_time_ms) == 1569888001000
    assert one(spark, "soon", csv_time_ms) == -1
    assert one(spark, 1000, transaction_time_ms, "long") == 1512087400000
    assert one(spark, 0, transaction_time_ms, "long") is None


def test_times_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert one(spark, "2019-10-01 00:00:01", flex_time_ms) == 1569888001000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_numbers(spark):
    assert [one(spark, t, safe_long) for t in ["12", "12.5", "x", None]] == [12, -1, -1, -1]
    assert [one(spark, t, safe_double) for t in ["1.5", "x", None]] == [1.5, None, None]


def test_first_not_blank_ignores_case(spark):
    df = spark.createDataFrame([("  ", " b "), (None, None)], "`User ID` string, UID string")
    got = df.select(first_not_blank(df.columns, "user id", "uid", "missing")).collect()
    assert [r[0] for r in got] == ["b", None]


def test_group_keys(spark):
    df = spark.createDataFrame([("u", "i", None, "")], "userId string, ip string, deviceId string, sessionId string")
    kinds = ["BY_USER_ID", "BY_IP", "BY_DEVICE_ID", "BY_SESSION_ID", None]
    got = [df.select(group_key(F.lit("r"), F.lit(k).cast("string"))).first()[0] for k in kinds]
    assert got == ["r:u", "r:i", "r:UNKNOWN", "r:UNKNOWN", "r:u"]
