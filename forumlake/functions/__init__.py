"""Column functions; all stay inside Spark's own expressions."""

from forumlake.functions.keys import surrogate_key
from forumlake.functions.raw_json import parsed_fields
from forumlake.functions.times import date_key, date_spine, day_string, whole_units
from forumlake.functions.urls import url_host

__all__ = [
    "date_key",
    "date_spine",
    "day_string",
    "parsed_fields",
    "surrogate_key",
    "url_host",
    "whole_units",
]
