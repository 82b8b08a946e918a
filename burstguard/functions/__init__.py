from burstguard.functions.actions import (
    is_login_fail,
    is_login_success,
    is_payment,
    is_payment_fraud,
    is_sensitive_action,
    is_small_payment,
    is_suspicious_payment,
    normalize_action,
)
from burstguard.functions.keys import by_device_id, by_ip, by_user_id, group_key
from burstguard.functions.text import first_not_blank, non_empty_or_default, safe_double, safe_long
from burstguard.functions.times import csv_time_ms, flex_time_ms, transaction_time_ms, unix_to_ms

__all__ = [
    "by_device_id",
    "by_ip",
    "by_user_id",
    "csv_time_ms",
    "first_not_blank",
    "flex_time_ms",
    "group_key",
    "is_login_fail",
    "is_login_success",
    "is_payment",
    "is_payment_fraud",
    "is_sensitive_action",
    "is_small_payment",
    "is_suspicious_payment",
    "non_empty_or_default",
    "normalize_action",
    "safe_double",
    "safe_long",
    "transaction_time_ms",
    "unix_to_ms",
]
