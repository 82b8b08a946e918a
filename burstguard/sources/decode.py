"""Event and rule JSON to columns, keeping what cannot be used as rejects."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstguard.functions.actions import normalize_action
from burstguard.functions.text import integer_or_null
from burstguard.functions.times import flex_time_ms, transaction_time_ms
from burstguard.operators import registry
from burstguard.operators.rules import RULE_DEFAULTS
from burstguard.schemas import BEHAVIOR_COLUMNS, RULE, RULE_STATUSES

# Other names under which an event document may carry a field.
EVENT_ALIASES = {
    "userId": ["user_id"],
    "actionType": ["event_type"],
    "sessionId": ["session_id", "user_session"],
    "productId": ["product_id"],
    "ip": ["ip_address"],
}

def is_valid_event() -> Column:
    return (
        F.coalesce(F.col("userId") != "", F.lit(False))
        & F.coalesce(F.col("actionType") != "", F.lit(False))
        & F.coalesce(F.col("timestamp") > 0, F.lit(False))
    )


def _text_schema(names: list[str]) -> str:
    return ", ".join(f"`{n}` STRING" for n in [*names, "_corrupt"])


def parse_once(value: str, names: list[str]) -> Column:
    """A document with every field as text, so one badly typed field can be told from a missing one.

    The optimizer copies a plain ``from_json`` into every filter and column that uses it; it does not look into a
    generator, so each document is parsed once.
    """
    parsed = F.from_json(value, _text_schema(names), {"columnNameOfCorruptRecord": "_corrupt"})
    return F.explode(F.array(parsed))


def _once(columns: list[Column]) -> Column:
    """Computed columns as one struct behind a generator, see ``parse_once``: what filters and later columns read of them is
    not computed again."""
    return F.explode(F.array(F.struct(*columns)))


def _number_to_long(text: Column) -> Column:
    """Whole numbers as they are, decimal numbers cut, empty text 0, anything else null."""
    value = F.trim(text)
    return F.when(value == "", F.lit(0).cast("bigint")).otherwise(F.coalesce(integer_or_null(value), _cut(value)))


def _cut(value: Column) -> Column:
    return value.try_cast("double").try_cast("bigint")


def decode_events(raw: DataFrame, value: str = "value") -> DataFrame:
    """Event columns plus ``rejected``: null for a usable row, else its whole text.

    A document that is not an object, or whose ``timestamp`` or ``amount`` holds text that is
    no number, is rejected whole. Where a field and its alias are both present the field wins.
    Other columns of ``raw`` (such as ``seq``) are kept.
    """
    aliases = [a for names in EVENT_ALIASES.values() for a in names]
    names = BEHAVIOR_COLUMNS + aliases + ["event_time", "TransactionDT"]
    kept = [c for c in raw.columns if c != value]
    j = raw.select(*kept, F.col(value).alias("_raw"), parse_once(value, names).alias("_j"))
    field = {n: F.col("_j")[n] for n in names}
    numbers = [
        _number_to_long(field["timestamp"]).alias("stated"), _whole(field["TransactionDT"]).alias("transaction"),
        F.nullif(F.trim(field["amount"]), F.lit("")).try_cast("double").alias("amount"),
    ]
    j = j.select(*kept, "_raw", "_j", _once(numbers).alias("_n"))

    def text(name: str) -> Column:
        return F.coalesce(field[name], *[field[a] for a in EVENT_ALIASES.get(name, [])])

    stated, amount = F.col("_n")["stated"], F.col("_n")["amount"]
    when = F.coalesce(
        F.when(stated != 0, stated),
        flex_time_ms(field["event_time"]),
        transaction_time_ms(F.col("_n")["transaction"]),
        F.lit(0).cast("bigint"),
    )
    unusable = (
        F.col("_j").isNull()
        | F.col("_j")["_corrupt"].isNotNull()
        | (field["timestamp"].isNotNull() & stated.isNull())
        | ((F.trim(field["amount"]) != "") & amount.isNull())
    )
    rejected = F.when(F.coalesce(unusable, F.lit(False)), F.coalesce("_raw", F.lit("")))
    columns = [
        text("userId").alias("userId"),
        normalize_action(text("actionType")).alias("actionType"),
        text("ip").alias("ip"),
        when.alias("timestamp"),
        text("sessionId").alias("sessionId"),
        field["deviceId"].alias("deviceId"),
        text("productId").alias("productId"),
        amount.alias("amount"),
        field["extra"].alias("extra"),
        rejected.alias("rejected"),
    ]
    return j.select(*kept, _once(columns).alias("_r")).select(*kept, "_r.*")


def _whole(text: Column) -> Column:
    return F.coalesce(integer_or_null(text), _cut(F.when(text.rlike(r"^\s*[+-]?[0-9.eE+-]+\s*$"), F.trim(text))))


def good_events(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("rejected").isNull() & is_valid_event()).drop("rejected")


def rejects(decoded: DataFrame) -> DataFrame:
    kept = [c for c in decoded.columns if c not in BEHAVIOR_COLUMNS]
    return decoded.where(F.col("rejected").isNotNull()).select(*kept)


def decode_rules(raw: DataFrame, value: str = "value") -> DataFrame:
    """Rule columns from rule JSON; documents that are no usable object are dropped.

    A missing field takes its default, an explicit null stays null (0 for numbers), and an
    unknown name in a list of fixed names becomes null.
    """
    names = RULE.fieldNames()
    kept = [c for c in raw.columns if c != value]
    j = raw.select(*kept, F.json_object_keys(value).alias("_keys"), parse_once(value, names).alias("_j")).where(F.col("_keys").isNotNull() & F.col("_j")["_corrupt"].isNull())
    fixed = {"ruleType": list(registry.RULE_TYPES), "status": RULE_STATUSES, "groupKeyType": registry.key_types()}
    kinds = {f.name: f.dataType.simpleString() for f in RULE.fields}

    def parsed(name: str, text: Column, kind: str) -> Column:
        if name in fixed:
            return F.when(text.isin(fixed[name]), text)
        if kind == "string":
            return text
        number = _number_to_long(text) if kind in ("int", "bigint") else F.coalesce(
            F.when(F.trim(text) == "", F.lit(0.0)), F.trim(text).try_cast("double")
        )
        return number.try_cast(kind)

    rules = j.select(
        *kept, "_keys", "_j",
        _once([parsed(n, F.col("_j")[n], kind).alias(n) for n, kind in kinds.items()]).alias("_r"),
    )
    columns, broken = [], F.lit(False)
    for name, kind in kinds.items():
        value = F.col("_r")[name]
        if name not in fixed and kind != "string":
            broken = broken | (F.col("_j")[name].isNotNull() & value.isNull())
            value = F.coalesce(value, F.lit(0).cast(kind))
        if name in RULE_DEFAULTS:
            default = F.lit(RULE_DEFAULTS[name]).cast(kind)
            value = F.when(F.array_contains("_keys", name), value).otherwise(default)
        columns.append(value.alias(name))
    return rules.where(~broken).select(*kept, *columns)


def decode_rejected_rules(raw: DataFrame, value: str = "value") -> DataFrame:
    """Rule texts that are no JSON object."""
    return raw.where(F.json_object_keys(value).isNull())
