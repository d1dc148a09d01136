"""Number, time, URL and key expressions."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from postsignal.functions.text import normalize_text

# The suffixes of compact counts, and the constant part of a live search URL.
COUNT_SUFFIXES = {"K": 1_000, "M": 1_000_000, "B": 1_000_000_000}
SEARCH_BASE_URL = "https://x.com/search"
SEARCH_PARAMETERS = "src=typed_query&f=live"

_COMPACT_COUNT = r"([0-9]+(?:\.[0-9]+)?)([KMBkmb]?)"

# A time of day, extended (10:00:00.5) or basic (100000.5); the second may be followed by a fraction.
_CLOCK = r"\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?|\d{2}(?:\d{2}(?:[.,]?\d+)?)?)?"
# Group 1 calendar date, 2 week date, 3 time, 4 offset sign, 5 offset.
_ISO = (
    r"^(?:(\d{4}-\d{2}-\d{2}|\d{8})"
    r"|(\d{4}-W\d{2}(?:-\d(?!\d))?|\d{4}W\d{2}(?:(?=\d(?!\d)|(?:\d\d)+(?!\d))\d)?))"
    rf"(?:[\s\S]({_CLOCK})(?:([+-])({_CLOCK}))?)?\z"
)
_PLAIN_ISO = (
    r"^(?!0000)\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|[+-](?:0\d|1[0-7]):[0-5]\d)?\z"
)
_DAY_MICROS = 86_400_000_000


def _clock_digits(clock: Column) -> Column:
    """HHMMSS and six digits of fraction; absent ones read as zero."""
    return F.rpad(F.regexp_replace(clock, "[:.,]", ""), 12, "0")


def _part(digits: Column, start: int, length: int = 2) -> Column:
    return F.substring(digits, start, length).cast("bigint")


def _micros(digits: Column) -> Column:
    seconds = _part(digits, 1) * 3600 + _part(digits, 3) * 60 + _part(digits, 5)
    return seconds * 1_000_000 + _part(digits, 7, 6)


def _calendar_date(text: Column) -> Column:
    digits = F.replace(text, F.lit("-"), F.lit(""))
    parts = (F.substring(digits, start, length) for start, length in ((1, 4), (5, 2), (7, 2)))
    return F.concat_ws("-", *parts).try_cast("date")


def _week_date(text: Column) -> Column:
    year = F.substring(text, 1, 4).cast("int")
    week = F.regexp_extract(text, r"W(\d{2})", 1).cast("int")
    day_text = F.nullif(F.regexp_extract(text, r"W\d{2}-?(\d)$", 1), F.lit(""))
    day = F.coalesce(day_text.cast("int"), F.lit(1))
    fourth = F.make_date(year, F.lit(1), F.lit(4))
    monday = F.date_add(fourth, (week - 1) * 7 - F.weekday(fourth))
    valid = day.between(1, 7) & (F.year(F.date_add(monday, 3)) == year)
    return F.when(valid, F.date_add(monday, day - 1))


def _from_parts(parts: Column) -> Column:
    """Local time minus its offset, from the pieces of an ISO-8601 text."""
    calendar, week, clock = parts["calendar"], parts["week"], parts["clock"]
    day = F.when(calendar != "", _calendar_date(calendar)).otherwise(_week_date(week))
    size = _micros(parts["offset"])
    offset = F.when(parts["sign"] == "-", -size).otherwise(size)
    valid = (
        (F.year(day) > 0)
        & (_part(clock, 1) < 24)
        & (_part(clock, 3) < 60)
        & (_part(clock, 5) < 60)
        & (size < _DAY_MICROS)
    )
    local = F.unix_date(day).cast("bigint") * _DAY_MICROS + _micros(clock)
    return F.when(valid, F.timestamp_micros(local - offset))


def _general_iso(text: Column) -> Column:
    """Any accepted ISO-8601 text; the lambda binds its pieces, so each is cut out once."""
    calendar, week, clock, sign, offset = (F.regexp_extract(text, _ISO, i) for i in range(1, 6))
    parts = F.struct(
        calendar.alias("calendar"),
        week.alias("week"),
        _clock_digits(clock).alias("clock"),
        sign.alias("sign"),
        _clock_digits(offset).alias("offset"),
    )
    return F.get(F.transform(F.array(parts), _from_parts), 0)


def parse_timestamp(text: Column) -> Column:
    """ISO-8601 text to an instant. No offset means UTC; anything unreadable becomes null.

    Run with ``spark.sql.session.timeZone=UTC``: texts in the usual shape are read by Spark's own
    cast, the rarer shapes (basic format, week dates, partial times, odd separators) by arithmetic.
    """
    swapped = F.replace(text, F.lit("Z"), F.lit("+00:00"))
    return (
        F.when(text.rlike(_PLAIN_ISO), swapped.try_cast("timestamp"))
        .when(swapped.rlike(_ISO), _general_iso(swapped))
        .otherwise(F.lit(None).cast("timestamp"))
    )


def as_utc(value: datetime) -> datetime:
    """A naive datetime is taken as UTC, an aware one is converted."""
    return value.replace(tzinfo=timezone.utc) if value.tzinfo is None else value.astimezone(timezone.utc)


def as_of_column(as_of: datetime | Column | None) -> Column:
    """Reference time as a column: the given instant, or the query's own start time."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_utc(as_of))


def safe_int(value: Column) -> Column:
    """Text count to long: null, blank and unreadable become 0, fractions are cut."""
    whole = value.try_cast("bigint")
    return F.coalesce(whole, value.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def parse_count(text: Column) -> Column:
    """First compact count in the text (``1.2K``, ``3M``, ``1,234``), scaled in double and cut."""
    bare = F.replace(text, F.lit(","), F.lit(""))
    number = F.nullif(F.regexp_extract(bare, _COMPACT_COUNT, 1), F.lit(""))
    suffix = F.upper(F.regexp_extract(bare, _COMPACT_COUNT, 2))
    scale = F.lit(1.0)
    for letter, factor in COUNT_SUFFIXES.items():
        scale = F.when(suffix == letter, F.lit(float(factor))).otherwise(scale)
    return (number.cast("double") * scale).try_cast("bigint")


def first_count(*candidates: Column) -> Column:
    """First candidate text that holds a count."""
    return F.coalesce(*(parse_count(candidate) for candidate in candidates))


def url_without_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def post_id_from_url(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, "/status/([0-9]+)", 1), F.lit(""))


def username_from_url(url: Column) -> Column:
    """First path segment of a URL that has at least two."""
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    path = F.regexp_replace(path, ";[^/]*$", "")
    segments = F.filter(F.split(path, "/"), lambda segment: segment != "")
    return F.when(F.size(segments) >= 2, F.get(segments, 0))


def search_url(query: Column, base_url: str = SEARCH_BASE_URL) -> Column:
    """Live search URL with the query percent-encoded (space is %20, only -_.~ stay bare)."""
    encoded = F.url_encode(query)
    for found, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(found), F.lit(wanted))
    return F.concat(F.lit(f"{base_url}?q="), encoded, F.lit(f"&{SEARCH_PARAMETERS}"))


def _non_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def record_key(tweet_id: Column, username: Column, content: Column) -> Column:
    """Key of a raw post: its id, else its normalized author and text."""
    text_key = F.concat(normalize_text(username), F.lit(":"), normalize_text(content))
    return F.coalesce(_non_empty(tweet_id), text_key)


def cleaned_key(tweet_id: Column, content_clean: Column) -> Column:
    """Key of a cleaned post: its id, else its cleaned text; the author plays no part."""
    return F.coalesce(_non_empty(tweet_id), content_clean, F.lit("None"))
