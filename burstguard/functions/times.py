"""Event times as epoch milliseconds. Text without a zone is UTC, whatever the session zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from burstguard.functions.text import integer_or_null

# Start of the transaction clock (2017-12-01T00:00:00Z) and the
# limit below which a number is taken as seconds.
TRANSACTION_EPOCH_MS = 1512086400000
SECONDS_BELOW = 10_000_000_000

# The accepted local forms (space or T, with or without milliseconds) and the instant form.
LOCAL_TIME = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d{3})?$"
INSTANT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?Z$"


def unix_to_ms(raw: Column) -> Column:
    """Seconds or milliseconds to milliseconds; null when not positive."""
    return F.when(raw > 0, F.when(raw < SECONDS_BELOW, raw * 1000).otherwise(raw))


def _local_to_ms(text: Column) -> Column:
    # Days 29-31 past the month's end fall back to its last day.
    month = F.concat(F.substring(text, 1, 8), F.lit("01")).try_cast("date")
    day = F.substring(text, 9, 2).try_cast("int")
    last = F.dayofmonth(F.last_day(month))
    fixed = F.when(
        (day > last) & (day <= 31),
        F.concat(F.substring(text, 1, 8), last.cast("string"), F.substring(text, 11, 13)),
    ).otherwise(text)
    return F.unix_millis(F.concat(fixed, F.lit("Z")).try_cast("timestamp"))


def _text_to_ms(text: Column) -> Column:
    return F.when(text.rlike(LOCAL_TIME), _local_to_ms(text)).when(
        text.rlike(INSTANT), F.unix_millis(text.try_cast("timestamp"))
    )


def flex_time_ms(text: Column) -> Column:
    """Number, numeric text, instant or local time text to epoch ms; null when unusable."""
    value = F.trim(text)
    number = integer_or_null(value)
    return F.when(number.isNotNull(), unix_to_ms(number)).otherwise(_text_to_ms(value))


def csv_time_ms(text: Column) -> Column:
    """As ``flex_time_ms`` after dropping a trailing `` UTC``; -1 when unusable."""
    value = F.trim(F.regexp_replace(F.trim(text), " UTC$", ""))
    number = integer_or_null(value)
    parsed = F.when(number > 0, unix_to_ms(number)).otherwise(_text_to_ms(value))
    return F.coalesce(parsed, F.lit(-1).cast("bigint"))


def transaction_time_ms(seconds: Column) -> Column:
    """Offset in seconds from the transaction clock's start; null when not positive."""
    return F.when(seconds > 0, F.lit(TRANSACTION_EPOCH_MS) + seconds * 1000)
