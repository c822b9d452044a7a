"""Strict JSON fields and lenient ISO-8601 times."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

#: Fixed value: the accepted forms; a date with hours and minutes, then seconds, a fraction, an offset.
ISO = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}((:\d{2}(\.\d{1,9})?)?|:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2}))$"


def blank(text: Column) -> Column:
    return text.isNull() | text.rlike(r"^\s*$")


def lenient_timestamp(text: Column) -> Column:
    """ISO-8601 with or without an offset (then UTC), floored to seconds; NULL for blanks and all else. The session's
    time zone has to be UTC."""
    plain = F.trim(text)
    return F.when(plain.rlike(ISO), F.date_trunc("second", F.try_to_timestamp(plain)))


def bad_timestamp(text: Column) -> Column:
    """Whether a text that isn't blank is no time: a failure to parse, where a blank is a missing time."""
    return ~blank(text) & lenient_timestamp(text).isNull()


def unknown_fields(json: Column, known: Iterable[str]) -> Column:
    """Whether a JSON object has a field outside `known`; NULL where it is no object."""
    return F.size(F.array_except(F.json_object_keys(json), F.array(*map(F.lit, known)))) > 0
