"""Column functions shared by the operators."""

from herdloom.functions.attributes import (
    attr_text,
    attributes,
    first_gps,
    milk_total_lenient,
    milk_total_strict,
    with_attr_texts,
    with_attributes,
)
from herdloom.functions.dates import (
    day_label,
    days_between,
    day_range,
    month_label,
    months_apart,
    period,
    sunday_week,
    whole_weeks,
)
from herdloom.functions.text import capitalise, last_word, lenient_num, same_name, strict_num

__all__ = [
    "attr_text",
    "attributes",
    "capitalise",
    "day_label",
    "day_range",
    "days_between",
    "first_gps",
    "last_word",
    "lenient_num",
    "milk_total_lenient",
    "milk_total_strict",
    "month_label",
    "months_apart",
    "period",
    "same_name",
    "strict_num",
    "sunday_week",
    "whole_weeks",
    "with_attr_texts",
    "with_attributes",
]
