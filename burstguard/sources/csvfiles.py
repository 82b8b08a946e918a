"""CSV files of several public layouts to behaviour events."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation

from burstguard.functions.actions import normalize_action
from burstguard.functions.text import first_not_blank, non_empty_or_default, safe_double, safe_long
from burstguard.functions.times import csv_time_ms, transaction_time_ms
from burstguard.schemas import BEHAVIOR, BEHAVIOR_COLUMNS
from burstguard.sources.decode import is_valid_event

# Columns that give a layout away, in order of precedence.
PROFILE_MARKS = [
    ("ieee_cis", ["TransactionDT", "TransactionID", "isFraud"]),
    ("multi_category", ["event_time", "event_type", "user_session"]),
    ("clickstream", ["session ID", "page 1 (main category)", "page 2 (clothing model)"]),
]


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every cell as trimmed text; columns by header, no pass over the data to guess types."""
    return spark.read.csv(
        path, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, escape='"', multiLine=False
    )


def detect_profile(columns: list[str]) -> str:
    lower = {c.lower() for c in columns}
    for profile, marks in PROFILE_MARKS:
        if any(m.lower() in lower for m in marks):
            return profile
    return "generic"


def _event(**fields: Column) -> list[Column]:
    kinds = {f.name: f.dataType for f in BEHAVIOR.fields}
    return [fields.get(n, F.lit(None)).cast(kinds[n]).alias(n) for n in BEHAVIOR_COLUMNS]


def _multi_category(cols: list[str], now: Column) -> list[Column]:
    def pick(*names):
        return first_not_blank(cols, *names)

    session = pick("user_session", "session_id", "sessionId")
    return _event(
        userId=non_empty_or_default(pick("user_id", "userId"), session, "unknown-user"),
        actionType=normalize_action(F.coalesce(pick("event_type", "action_type", "actionType"), F.lit("VIEW"))),
        ip=F.coalesce(pick("ip", "ip_address"), F.lit("unknown-ip")),
        timestamp=csv_time_ms(pick("event_time", "timestamp")),
        sessionId=session,
        productId=pick("product_id", "productId"),
        amount=safe_double(pick("price", "amount", "TransactionAmt")),
    )


def _date_ms(year: Column, month: Column, day: Column) -> Column:
    """Midnight UTC of a date given in parts; null when there is no such date."""
    text = F.format_string("%04d-%02d-%02d", year, month, day)
    real = (year >= 1) & (year <= 9999) & (month >= 1) & (month <= 12) & (day >= 1) & (day <= 31)
    return F.when(real, F.unix_date(text.try_cast("date")).cast("bigint") * 86_400_000)


def _clickstream(cols: list[str], now: Column) -> list[Column]:
    def pick(*names):
        return first_not_blank(cols, *names)

    def part(name, default):
        return safe_long(F.coalesce(pick(name), F.lit(default)))

    session = pick("session ID", "session_id", "sessionId", "user_session")
    return _event(
        userId=non_empty_or_default(F.coalesce(pick("user_id", "userId"), session), session, "unknown-user"),
        actionType=normalize_action(F.coalesce(pick("event_type", "action_type"), F.lit("VIEW"))),
        ip=F.coalesce(pick("country", "ip"), F.lit("unknown-ip")),
        timestamp=F.coalesce(_date_ms(part("year", "1970"), part("month", "1"), part("day", "1")), now),
        sessionId=session,
        productId=pick("page 2 (clothing model)", "product_id"),
    )


def _ieee(cols: list[str], now: Column) -> list[Column]:
    def pick(*names):
        return first_not_blank(cols, *names)

    address = [F.coalesce(pick(n), F.lit("na")) for n in ["addr1", "addr2"]]
    fraud = safe_long(F.coalesce(pick("isFraud"), F.lit("0"))) == 1
    return _event(
        userId=F.coalesce(pick("card1", "user_id", "TransactionID"), F.lit("unknown-user")),
        actionType=F.when(fraud, "PAYMENT_FRAUD").otherwise("PAYMENT"),
        ip=F.concat(F.lit("addr-"), address[0], F.lit("-"), address[1]),
        timestamp=F.coalesce(transaction_time_ms(safe_long(pick("TransactionDT"))), now),
        sessionId=pick("TransactionID", "session_id"),
        amount=safe_double(pick("TransactionAmt", "amount")),
    )


def _generic(cols: list[str], now: Column) -> list[Column]:
    def pick(*names):
        return first_not_blank(cols, *names)

    session = pick("sessionId", "session_id", "user_session")
    when = csv_time_ms(pick("timestamp", "event_time", "TransactionDT"))
    return _event(
        userId=non_empty_or_default(pick("userId", "user_id", "uid", "id"), session, "unknown-user"),
        actionType=normalize_action(F.coalesce(pick("actionType", "action_type", "event_type"), F.lit("VIEW"))),
        ip=F.coalesce(pick("ip", "ip_address", "country"), F.lit("unknown-ip")),
        timestamp=F.when(when > 0, when).otherwise(now),
        sessionId=session,
        productId=pick("productId", "product_id"),
        amount=safe_double(pick("amount", "price", "TransactionAmt")),
    )


MAPPERS = {"multi_category": _multi_category, "clickstream": _clickstream, "ieee_cis": _ieee, "generic": _generic}


def map_csv(rows: DataFrame, profile: str = "auto", now_ms: int | None = None, keep: list[str] = ()) -> DataFrame:
    """Event columns for each CSV row; ``now_ms`` stands in for missing times of some layouts.

    The layout is settled from the header while the plan is built, so only its columns are read.
    """
    chosen = detect_profile(rows.columns) if profile == "auto" else profile
    if chosen not in MAPPERS:
        raise ValueError(f"unknown profile {profile!r}; known: auto, {', '.join(MAPPERS)}")
    now = F.unix_millis(F.current_timestamp()) if now_ms is None else F.lit(now_ms)
    return rows.select(*keep, *MAPPERS[chosen](rows.columns, now.cast("bigint")))


def import_rows(mapped: DataFrame) -> tuple[DataFrame, Observation]:
    """Valid rows, and counters filled while they are used.

    The counters (``total``, ``converted``, ``invalid``) come from the same pass as the rows.
    """
    counters = Observation("import")
    valid = is_valid_event()
    seen = mapped.observe(
        counters,
        F.count(F.lit(1)).alias("total"),
        F.count_if(valid).alias("converted"),
        F.count_if(~valid).alias("invalid"),
    )
    return seen.where(valid), counters


def import_counts(mapped: DataFrame) -> DataFrame:
    valid = is_valid_event()
    return mapped.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(valid).alias("converted"),
        F.count_if(~valid).alias("invalid"),
    )
