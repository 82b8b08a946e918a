"""Behaviour, rule and alert views over the test tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from burstguard.operators.rules import rules_frame
from burstguard.session import prepare

HOUR = 3_600_000

FIXTURE_RULES = [
    ("fx-stuffing", "CREDENTIAL_STUFFING", "BY_IP", "LOGIN_FAIL", 24, 3, 2.0, 2.0),
    ("fx-order", "ORDER_BRUSH", "BY_USER_ID", "PAYMENT", 72, 3, 1.8, 2.0),
    ("fx-view", "HIGH_FREQ_ACCESS", "BY_SESSION_ID", "VIEW", 24, 2, 1.3, 1.5),
    ("fx-login", "ABNORMAL_LOGIN", "BY_USER_ID", "LOGIN", 24, 2, 1.6, 1.5),
    ("fx-pay", "PAYMENT_FRAUD", "BY_USER_ID", "PAYMENT", 120, 2, 2.5, 2.5),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def event_ms(column: str = "ts") -> Column:
    return F.unix_millis(F.col(column).cast("timestamp"))


def events_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as behaviour events; ``seq`` is its id."""
    k = F.col("k")
    kind = F.col("event_type")
    action = (
        F.when(kind == "error", "LOGIN_FAIL")
        .when(kind == "signup", "LOGIN")
        .when(kind == "purchase", "PAYMENT")
        .when(kind == "view", "VIEW")
        .when((kind == "click") & (k % 4 == 0), "CHANGE_PASSWORD")
        .when(kind == "click", "ADD_CART")
    )
    user = F.col("user_id").cast("string")
    read = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return read.select(
        F.col("event_id").alias("seq"),
        user.alias("userId"),
        action.alias("actionType"),
        F.concat(F.lit("10.0.0."), (k % 20).cast("string")).alias("ip"),
        event_ms().alias("timestamp"),
        F.concat(user, F.lit(":"), F.date_format("ts", "yyyy-MM-dd")).alias("sessionId"),
        F.when(k % 10 != 0, F.concat(F.lit("d"), (k % 7).cast("string"))).alias("deviceId"),
        F.lit(None).cast("string").alias("productId"),
        (F.col("value") * 10).alias("amount"),
        F.col("props").alias("extra"),
    )


def fixture_rules(spark: SparkSession) -> DataFrame:
    names = ["ruleId", "ruleType", "groupKeyType", "targetActionType", "hours", "threshold",
             "severityWeight", "scoreThreshold"]
    rows = [dict(zip(names, r)) for r in FIXTURE_RULES]
    return rules_frame(
        spark,
        [r | {"windowSizeMs": r["hours"] * HOUR, "ruleName": r["ruleId"], "version": 1} for r in rows],
    )


def rule_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule changelog derived from ``orders``: customers stand for rules, orders for changes."""
    status, version = F.col("o_orderstatus"), F.col("o_orderkey") % 7
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"),
        F.concat(F.lit("r"), F.col("o_custkey")).alias("ruleId"),
        F.concat(F.lit("rule "), F.col("o_custkey")).alias("ruleName"),
        F.when(F.col("o_custkey") % 3 == 0, "ORDER_BRUSH").otherwise("HIGH_FREQ_ACCESS").alias("ruleType"),
        F.when(F.col("o_orderkey") % 5 == 0, "DISABLED")
        .when(F.col("o_orderkey") % 11 != 0, "ENABLED")
        .alias("status"),
        F.when(F.col("o_orderpriority") != "5-LOW", "PAYMENT").alias("targetActionType"),
        ((F.col("o_orderkey") % 9) * 60000).cast("bigint").alias("windowSizeMs"),
        (F.col("o_orderkey") % 4 + 1).cast("int").alias("threshold"),
        F.when(status == "F", "BY_USER_ID").otherwise("BY_IP").alias("groupKeyType"),
        F.lit(100).alias("priority"),
        F.lit(1.0).alias("severityWeight"),
        F.lit(1.0).alias("scoreThreshold"),
        F.lit(None).cast("string").alias("description"),
        version.cast("bigint").alias("version"),
        F.lit(0).cast("bigint").alias("updateTimestamp"),
    )


def event_documents_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as JSON documents in the ways producers really write them: other field
    names, four forms of time, amounts as text, and documents cut off in transit."""
    e = F.col("event_id")
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS")
    time = (
        F.when(e % 4 == 0, F.concat(F.lit('"timestamp":'), event_ms().cast("string")))
        .when(e % 4 == 1, F.concat(F.lit('"event_time":"'), at, F.lit('"')))
        .when(e % 4 == 2, F.concat(F.lit('"event_time":"'), F.replace(at, F.lit(" "), F.lit("T")), F.lit('Z"')))
        .otherwise(F.concat(F.lit('"TransactionDT":'), F.floor(event_ms() / 1000 - 1512086400).cast("string")))
    )
    action = (
        F.when(F.col("event_type") == "click", " add_to_cart ")
        .when(F.col("event_type") == "signup", "Remove_From_Cart")
        .otherwise(F.col("event_type"))
    )
    user = F.when(e % 50 == 0, "null").otherwise(F.col("user_id").cast("string"))
    amount = F.when(e % 53 == 0, '"much"').otherwise(F.concat(F.lit('"'), F.col("value").cast("string"), F.lit('"')))
    text = F.concat(
        F.lit('{"user_id":'), user, F.lit(',"event_type":"'), action, F.lit('",'), time,
        F.lit(',"ip_address":"10.0.0.'), (e % 20).cast("string"), F.lit('","user_session":"s'),
        (e % 7).cast("string"), F.lit('","amount":'), amount, F.lit(',"unknown":[1,{"a":2}]}'),
    )
    cut = F.when(e % 61 == 0, F.substring(text, 1, 40)).otherwise(text)
    return table(spark, sf_dir, "events").select(e.alias("seq"), cut.alias("value"))


def rule_documents_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule documents derived from ``orders``: absent, null and unknown values included."""
    k = F.col("o_orderkey")
    status = (
        F.when(k % 4 == 0, "")
        .when(k % 4 == 1, ',"status":null')
        .when(k % 4 == 2, ',"status":"PAUSED"')
        .otherwise(',"status":"DISABLED"')
    )
    weight = F.when(k % 3 == 0, "").when(k % 3 == 1, ',"severityWeight":null').otherwise(',"severityWeight":"2.5"')
    kind = F.when(k % 6 == 0, "NO_SUCH_TYPE").otherwise("ORDER_BRUSH")
    window = F.when(k % 10 == 9, '"soon"').otherwise(((k % 9) * 1000).cast("string"))
    text = F.concat(
        F.lit('{"ruleId":"r'), F.col("o_custkey"), F.lit('","ruleType":"'), kind, F.lit('","targetActionType":"ORDER"'),
        status, weight, F.lit(',"windowSizeMs":'), window, F.lit(',"threshold":'), (k % 5).cast("string"),
        F.lit(',"version":'), k.cast("string"), F.lit(',"enabled":true}'),
    )
    return table(spark, sf_dir, "orders").select(
        k.alias("seq"), F.when(k % 13 == 0, F.lit("not json")).otherwise(text).alias("value")
    )


def rule_log_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A changelog in the arrival order of ``events``, derived from ``supplier``: every nation is a
    rule, every supplier a change of it, 100 events apart."""
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    action = F.when(n % 3 == 0, "PAYMENT").when(n % 3 == 1, "VIEW").otherwise("ADD_CART")
    return table(spark, sf_dir, "supplier").select(
        (k * 100).alias("seq"),
        F.concat(F.lit("n"), n).alias("ruleId"),
        F.concat(F.lit("n"), n).alias("ruleName"),
        F.lit("HIGH_FREQ_ACCESS").alias("ruleType"),
        F.when(k % 4 == 0, "DISABLED").otherwise("ENABLED").alias("status"),
        action.alias("targetActionType"),
        F.lit(3_600_000).cast("bigint").alias("windowSizeMs"),
        (k % 3 + 1).cast("int").alias("threshold"),
        F.when(n % 2 == 0, "BY_IP").otherwise("BY_DEVICE_ID").alias("groupKeyType"),
        F.lit(100).alias("priority"),
        F.lit(1.0).alias("severityWeight"),
        F.lit(1.0).alias("scoreThreshold"),
        F.lit(None).cast("string").alias("description"),
        (k % 5).cast("bigint").alias("version"),
        F.lit(0).cast("bigint").alias("updateTimestamp"),
    )


def time_texts_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time texts of many forms derived from ``orders``."""
    k = F.col("o_orderkey")
    at = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    seconds = F.floor(F.unix_millis(F.col("o_orderdate").cast("timestamp")) / 1000)
    text = (
        F.when(k % 8 == 0, at)
        .when(k % 8 == 1, F.concat(F.replace(at, F.lit(" "), F.lit("T")), F.lit(".250Z")))
        .when(k % 8 == 2, seconds.cast("string"))
        .when(k % 8 == 3, (seconds * 1000).cast("string"))
        .when(k % 8 == 4, F.concat(at, F.lit(" UTC")))
        .when(k % 8 == 5, F.concat(F.lit(" "), at, F.lit(".125 ")))
        .when(k % 8 == 6, F.concat(F.lit("-"), k.cast("string")))
        .otherwise(F.lit("yesterday"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", text.alias("text"))


def csv_view(spark: SparkSession, sf_dir: str, profile: str) -> DataFrame:
    """``orders`` in the column layouts of the CSV profiles, every cell text, some blank."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    orders = table(spark, sf_dir, "orders")
    user = F.when(k % 7 == 0, "  ").otherwise(c.cast("string"))
    session = F.when(k % 11 == 0, "").otherwise(F.concat(F.lit("s"), c % 100))
    at = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    price = F.col("o_totalprice").cast("string")
    if profile == "multi_category":
        return orders.select(
            k.alias("row"),
            F.when(k % 13 == 0, "never").otherwise(F.concat(at, F.lit(" UTC"))).alias("event_time"),
            F.when(k % 3 == 0, "remove_from_cart").when(k % 3 == 1, "purchase").otherwise("").alias("Event_Type"),
            F.concat(F.lit(" p"), k % 50, F.lit(" ")).alias("product_id"),
            F.when(k % 17 == 0, "free").otherwise(price).alias("price"),
            user.alias("user_id"),
            session.alias("user_session"),
        )
    if profile == "clickstream":
        return orders.select(
            k.alias("row"),
            F.year("o_orderdate").cast("string").alias("year"),
            F.when(k % 19 == 0, "13").otherwise(F.month("o_orderdate").cast("string")).alias("month"),
            F.dayofmonth("o_orderdate").cast("string").alias("day"),
            session.alias("session ID"),
            F.when(k % 5 == 0, "").otherwise((c % 30).cast("string")).alias("country"),
            F.concat(F.lit("B"), k % 40).alias("page 2 (clothing model)"),
        )
    if profile == "ieee_cis":
        return orders.select(
            k.alias("row"),
            k.cast("string").alias("TransactionID"),
            F.when(k % 23 == 0, "").otherwise((k * 60).cast("string")).alias("TransactionDT"),
            price.alias("TransactionAmt"),
            F.when(k % 29 == 0, "1").when(k % 29 == 1, "1.0").otherwise("0").alias("isFraud"),
            user.alias("card1"),
            F.when(k % 3 == 0, "").otherwise((c % 300).cast("string")).alias("addr1"),
            F.when(k % 4 == 0, "").otherwise("87").alias("addr2"),
        )
    return orders.select(
        k.alias("row"),
        user.alias("uid"),
        F.when(k % 2 == 0, "add_to_cart").otherwise("order").alias("action_type"),
        F.when(k % 5 == 0, "").otherwise((c % 30).cast("string")).alias("country"),
        F.when(k % 13 == 0, "").otherwise(at).alias("timestamp"),
        session.alias("session_id"),
        price.alias("amount"),
    )
