from titlemart.quality.checks import (
    CheckFailed,
    check_interval,
    check_non_empty,
    check_truthy,
    check_unique,
    check_value,
    check_written,
    interval_ratios,
    repeated_keys,
    uniqueness,
)

__all__ = [
    "CheckFailed",
    "check_interval",
    "check_non_empty",
    "check_truthy",
    "check_unique",
    "check_value",
    "check_written",
    "interval_ratios",
    "repeated_keys",
    "uniqueness",
]
