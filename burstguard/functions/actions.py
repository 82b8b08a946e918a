"""Action names and the predicates the detectors use. All are null-safe: null gives false."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Action names with a meaning of their own.
RENAMED_ACTIONS = {"REMOVE_FROM_CART": "REMOVE_CART", "ADD_TO_CART": "ADD_CART"}
LOGIN_FAIL = ["LOGIN_FAIL"]
LOGIN_SUCCESS = ["LOGIN_SUCCESS", "LOGIN"]
SENSITIVE = ["CHANGE_PASSWORD", "BIND_PHONE", "WITHDRAW", "LARGE_TRANSFER"]
PAYMENT = ["PAYMENT"]
PAYMENT_FRAUD = ["PAYMENT_FRAUD"]
ORDER_PLACED = ["ORDER", "PLACE_ORDER"]

# Payment limits.
SMALL_BELOW = 100.0
LARGE_FROM = 1000.0


def normalize_action(action: Column) -> Column:
    name = F.upper(F.trim(action))
    for old, new in RENAMED_ACTIONS.items():
        name = F.when(F.upper(F.trim(action)) == old, new).otherwise(name)
    return name


def _one_of(action: Column, names: list[str]) -> Column:
    return F.coalesce(F.upper(action).isin(names), F.lit(False))


def is_login_fail(action: Column) -> Column:
    return _one_of(action, LOGIN_FAIL)


def is_login_success(action: Column) -> Column:
    return _one_of(action, LOGIN_SUCCESS)


def is_sensitive_action(action: Column) -> Column:
    return _one_of(action, SENSITIVE)


def is_payment(action: Column) -> Column:
    return _one_of(action, PAYMENT)


def is_payment_fraud(action: Column) -> Column:
    return _one_of(action, PAYMENT_FRAUD)


def is_small_payment(action: Column, amount: Column, below: float = SMALL_BELOW) -> Column:
    # Spark orders NaN above every number, so NaN is never small; it must not be large either.
    return is_payment(action) & F.coalesce(amount < below, F.lit(False))


def is_large_payment(action: Column, amount: Column, from_: float = LARGE_FROM) -> Column:
    large = F.coalesce((amount >= from_) & ~F.isnan(amount), F.lit(False))
    return is_payment(action) & large


def is_suspicious_payment(action: Column, amount: Column, from_: float = LARGE_FROM) -> Column:
    return is_payment_fraud(action) | is_large_payment(action, amount, from_)
