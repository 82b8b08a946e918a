"""Column layouts shared by the whole package.

Names follow the JSON field names of the event, rule and alert documents, so a
row written with ``to_json`` is directly a document of the matching kind.
"""

from pyspark.sql import types as T

BEHAVIOR_FIELDS = [
    ("userId", T.StringType()),
    ("actionType", T.StringType()),
    ("ip", T.StringType()),
    ("timestamp", T.LongType()),
    ("sessionId", T.StringType()),
    ("deviceId", T.StringType()),
    ("productId", T.StringType()),
    ("amount", T.DoubleType()),
    ("extra", T.StringType()),
]
BEHAVIOR = T.StructType([T.StructField(n, t) for n, t in BEHAVIOR_FIELDS])
BEHAVIOR_COLUMNS = BEHAVIOR.fieldNames()

RULE = T.StructType(
    [
        T.StructField("ruleId", T.StringType()),
        T.StructField("ruleName", T.StringType()),
        T.StructField("ruleType", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("targetActionType", T.StringType()),
        T.StructField("windowSizeMs", T.LongType()),
        T.StructField("threshold", T.IntegerType()),
        T.StructField("groupKeyType", T.StringType()),
        T.StructField("priority", T.IntegerType()),
        T.StructField("severityWeight", T.DoubleType()),
        T.StructField("scoreThreshold", T.DoubleType()),
        T.StructField("description", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("updateTimestamp", T.LongType()),
    ]
)
RULE_COLUMNS = RULE.fieldNames()

ALERT = T.StructType(
    [
        T.StructField("alertId", T.StringType()),
        T.StructField("ruleId", T.StringType()),
        T.StructField("ruleType", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("userId", T.StringType()),
        T.StructField("ip", T.StringType()),
        T.StructField("deviceId", T.StringType()),
        T.StructField("triggerEvents", T.ArrayType(BEHAVIOR)),
        T.StructField("matchCount", T.IntegerType()),
        T.StructField("riskScore", T.DoubleType()),
        T.StructField("alertTimestamp", T.LongType()),
        T.StructField("firstEventTimestamp", T.LongType()),
        T.StructField("lastEventTimestamp", T.LongType()),
        T.StructField("processingLagMs", T.LongType()),
        T.StructField("message", T.StringType()),
        T.StructField("extra", T.StringType()),
    ]
)

# Enumerations of the document formats.
RULE_TYPES = [
    "CREDENTIAL_STUFFING",
    "ORDER_BRUSH",
    "ABNORMAL_LOGIN",
    "HIGH_FREQ_ACCESS",
    "PAYMENT_FRAUD",
    "CUSTOM",
]
RULE_STATUSES = ["ENABLED", "DISABLED"]
GROUP_KEY_TYPES = ["BY_USER_ID", "BY_IP", "BY_DEVICE_ID", "BY_SESSION_ID"]
ALERT_LEVELS = {"LOW": 1, "MEDIUM": 2, "HIGH": 3, "CRITICAL": 4}

# Fixed value: how far behind the newest event of its key a row may arrive (ms).
LATENESS_MS = 5000
