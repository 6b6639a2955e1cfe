"""Column expressions shared by the plans."""

from cartflow.functions.exact import rounded_mean, rounded_percent, rounded_ratio, to_whole
from cartflow.functions.times import iso_text, month_of, whole_days, whole_seconds

__all__ = [
    "iso_text",
    "month_of",
    "rounded_mean",
    "rounded_percent",
    "rounded_ratio",
    "to_whole",
    "whole_days",
    "whole_seconds",
]
