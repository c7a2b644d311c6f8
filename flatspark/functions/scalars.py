"""Scalar expressions used by the mappings. All of them are built-in Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reference_id(ref: Column) -> Column:
    """``Type/id`` -> ``id``; null when there is no slash."""
    return F.get(F.split(ref, "/"), F.lit(1))


def trailing_token(ref: Column) -> Column:
    """Text after the last ``-``: the kind of thing a reference points to."""
    return F.element_at(F.split(ref, "-"), -1)


def profile_short(url: Column) -> Column:
    """First two dash tokens of the fifth path token of a profile URL."""
    tail = F.split(F.get(F.split(url, "/"), F.lit(4)), "-")
    return F.concat_ws("-", F.get(tail, F.lit(0)), F.get(tail, F.lit(1)))


def full_name_parts(given: Column) -> tuple[Column, Column]:
    """(first name, middle initial) out of an array of given names.

    The names are joined by a comma and split again, so a name that itself holds a
    comma counts as two.
    """
    parts = F.split(F.concat_ws(",", given), ",")
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def full_name(first: Column, middle: Column, last: Column) -> Column:
    """``first middle last `` with nulls as empty text; the trailing blank stays."""
    blank = F.lit("")
    return F.concat(
        F.coalesce(first, blank), F.lit(" "),
        F.coalesce(middle, blank), F.lit(" "),
        F.coalesce(last, blank), F.lit(" "),
    )


def joined_record(*fields: Column, sep: str = ",") -> Column:
    """Several fields as one text, nulls as empty fields."""
    return F.concat_ws(sep, *[F.coalesce(f, F.lit("")) for f in fields])


def printed_list(
    values: Column,
    sep: str = "~",
    *,
    bracketed: bool = True,
    empty_as_null: bool = True,
    split_on: str | None = None,
    blank_length: int = 0,
) -> Column:
    """An array of texts as one delimited text, e.g. ``[a~b]``.

    ``split_on`` is the text at which the printed form breaks into list items, which
    shows as ``, ``. A text no longer than ``blank_length`` counts as nothing to print, which
    gives null, or stays with ``empty_as_null=False``.
    """
    text = F.array_join(values, sep)
    shown = F.replace(text, F.lit(split_on), F.lit(", ")) if split_on else text
    shown = F.concat(F.lit("["), shown, F.lit("]")) if bracketed else shown
    return F.when(F.length(text) > blank_length, shown) if empty_as_null else shown


def yes_no(condition: Column) -> Column:
    """``Y`` where the condition holds, ``N`` where it is false or null."""
    return F.when(condition, F.lit("Y")).otherwise(F.lit("N"))


def zero_pad(part: Column) -> Column:
    """A one-character value with a zero in front; longer values stay as they are."""
    text = part.cast("string")
    return F.when(F.length(text) == 1, F.concat(F.lit("0"), text)).otherwise(text)


def partition_date(year: Column, month: Column, day: Column) -> Column:
    """The date a year/month/day partition stands for."""
    return F.concat_ws("-", year, month, day).cast("date")
