from tripflow.functions.calendar import date_key, iso_day_of_week, month_text, ntz
from tripflow.functions.keys import KEY_FIELDS, add_trip_id, canonical_text, key_digest
from tripflow.functions.numbers import exact_average, half_even_int, money, no_nan, ratio

__all__ = [
    "KEY_FIELDS",
    "add_trip_id",
    "canonical_text",
    "date_key",
    "exact_average",
    "half_even_int",
    "iso_day_of_week",
    "key_digest",
    "money",
    "month_text",
    "no_nan",
    "ntz",
    "ratio",
]
