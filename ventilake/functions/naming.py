"""File-name and timestamp helpers (box id, file kind, file day, timestamp parse)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed as X


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_file_name(raw_name) -> Column:
    """Decode ``_metadata.file_name`` (URL-encoded, spaces as %20).

    A literal '+' is protected first because ``url_decode`` turns it into a space.
    """
    return F.url_decode(F.replace(_c(raw_name), F.lit("+"), F.lit("%2B")))


def box_id(name) -> Column:
    """the last word before ' le dd MM yyyy.acq' ('' when the name does not match)."""
    return F.regexp_extract(_c(name), X.BOX_PATTERN, 1)


def file_day(name) -> Column:
    """Day written in the file name, as a DATE (null when absent)."""
    text = F.regexp_extract(_c(name), X.BOX_PATTERN, 2)
    return F.try_to_date(F.nullif(text, F.lit("")), X.FILE_DATE_FORMAT)


def household_pattern(boxes: Sequence[str] = X.HOUSEHOLD_BOXES) -> str:
    """Household file: one of the boxes, preceded by at least one character,
    right before ' le <date>.acq' at the end of the name.

    Same matches as the original ``.+(b1|b2|...)+ le <date>.acq$`` searched
    anywhere in the name (a repeated group matches exactly when its last
    repetition does), without the nested quantifier that makes the regex
    engine backtrack."""
    alternatives = "|".join(boxes)
    return rf".(?:{alternatives}) le {X.FILE_DATE_PATTERN}\.acq$"


def caisson_pattern() -> str:
    return rf"{X.CAISSON_PREFIX}+.+le {X.FILE_DATE_PATTERN}\.acq$"


def station_pattern() -> str:
    return rf"{X.STATION_PREFIX}+.+le {X.FILE_DATE_PATTERN}\.acq$"


def is_household_file(name, boxes: Sequence[str] = X.HOUSEHOLD_BOXES) -> Column:
    return _c(name).rlike(household_pattern(boxes))


def is_caisson_file(name) -> Column:
    return _c(name).rlike(caisson_pattern())


def is_station_file(name) -> Column:
    return _c(name).rlike(station_pattern())


def parse_acq_timestamp(text, fmt: str = X.ACQ_TIMESTAMP_FORMAT) -> Column:
    """Parse 'dd/MM/yyyy HH:mm' to TIMESTAMP_NTZ; unparsable text gives null."""
    return F.try_to_timestamp(_c(text), F.lit(fmt)).cast("timestamp_ntz")


def day_of(ts) -> Column:
    """Start of the calendar day of a TIMESTAMP_NTZ, kept as TIMESTAMP_NTZ."""
    return _c(ts).cast("date").cast("timestamp_ntz")


def ntz_literal(value) -> Column:
    """TIMESTAMP_NTZ literal from a date, datetime or ISO text, independent of time zones."""
    text = value.isoformat(sep=" ") if hasattr(value, "hour") else str(value)
    return F.lit(text).cast("timestamp_ntz")
