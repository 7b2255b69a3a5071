"""Column expressions (all Catalyst built-ins, so they stay inside whole-stage codegen)."""

from rental_mart.functions.clean import (  # noqa: F401
    AGE_OTHER, AGE_UNKNOWN, GENDER_FEMALE, GENDER_MALE, GENDER_UNKNOWN, RENT_TYPE_UNKNOWN,
    age_type, any_date, blank_decimal, blank_double, blank_int, compact_text,
    gender, iso_date, iso_text, period_bounds, rent_type, station_name, station_number,
    timestamp_literal,
)
