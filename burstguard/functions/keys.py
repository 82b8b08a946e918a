"""Grouping keys."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "UNKNOWN"

# Which event field a rule groups by; anything else (null included) means the user.
KEY_FIELDS = {"BY_IP": "ip", "BY_DEVICE_ID": "deviceId", "BY_SESSION_ID": "sessionId"}

# Further kinds of keys, see ``operators.registry``: an expression over the columns of an event.
OTHER_KEYS: dict[str, Callable[[], Column]] = {}


def group_key(rule_id: Column, key_type: Column, fields: dict[str, Column] | None = None) -> Column:
    """``ruleId:value``; rows whose key field is null or empty share the value UNKNOWN."""
    fields = fields or {name: F.col(name) for name in ["userId", *KEY_FIELDS.values()]}
    value = fields["userId"]
    for name, field in KEY_FIELDS.items():
        value = F.when(key_type == name, fields[field]).otherwise(value)
    for name, other in OTHER_KEYS.items():
        value = F.when(key_type == name, other().cast("string")).otherwise(value)
    return F.concat(rule_id, F.lit(":"), F.coalesce(F.nullif(value, F.lit("")), F.lit(UNKNOWN)))


def by_user_id(user: Column) -> Column:
    return F.coalesce(user, F.lit(UNKNOWN))


def by_ip(ip: Column) -> Column:
    return F.coalesce(ip, F.lit(UNKNOWN))


def by_device_id(device: Column) -> Column:
    return F.coalesce(device, F.lit(UNKNOWN))
