from datetime import datetime, timedelta, timezone
from itertools import product
from urllib.parse import quote, urlencode, urlparse

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from postsignal.functions import scalars

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def column(spark, expression, values, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row[0] for row in frame.orderBy("i").select(expression(F.col("v"))).collect()]


def printed(instant):
    """An instant in many notations, with what each can hold of it: notation and microseconds since 1970."""
    year, week, day = instant.isocalendar()
    dates = [f"{instant:%Y-%m-%d}", f"{instant:%Y%m%d}", f"{year}-W{week:02}-{day}", f"{year}W{week:02}{day}"]
    seconds = instant.hour * 3600 + instant.minute * 60 + instant.second
    micros = instant.microsecond
    times = [
        (f"{instant:%H}", seconds // 3600 * 3600 * 10**6),
        (f"{instant:%H:%M}", seconds // 60 * 60 * 10**6),
        (f"{instant:%H%M}", seconds // 60 * 60 * 10**6),
        (f"{instant:%H:%M:%S}", seconds * 10**6),
        (f"{instant:%H%M%S}.{micros // 10**4:02}", seconds * 10**6 + micros // 10**4 * 10**4),
        (f"{instant:%H:%M:%S},{micros:06}9", seconds * 10**6 + micros),
    ]
    offsets = [("", 0), ("Z", 0), ("+05:30", 19800), ("-08", -28800), ("+0530", 19800), ("+05:30:15", 19815)]
    midnight = instant.toordinal() - EPOCH.toordinal()
    for date in dates:
        yield date, midnight * 86_400 * 10**6
        for (time, own), (offset, shift) in product(times, offsets):
            yield f"{date}T{time}{offset}", midnight * 86_400 * 10**6 + own - shift * 10**6
            yield f"{date} {time}{offset}", midnight * 86_400 * 10**6 + own - shift * 10**6


def test_timestamps_in_every_notation(spark):
    instants = [datetime(2031, 3, 9, 7, 5, 41, 620_817), datetime(2024, 2, 29, 23, 59, 59, 999_999), datetime(2021, 1, 1), datetime(1969, 12, 31, 12)]
    rows = [row for instant in instants for row in printed(instant)]
    got = column(spark, lambda c: F.unix_micros(scalars.parse_timestamp(c)), [text for text, _ in rows])
    assert [(t, g, w) for (t, w), g in zip(rows, got) if g != w] == []


def test_unreadable_timestamps_are_null(spark):
    texts = ["2031-13-01", "2023-02-29", "2031-3-9", "2031", "2031-03-09T", "2031-03-09T1", "2031-03-09T10:60", "2031-03-09T10:00+", "2031-03-09T10:00-24:00", "2021-W54-1", "0000-01-01", "soon", "", " ", None]
    assert column(spark, lambda c: F.unix_micros(scalars.parse_timestamp(c)), texts) == [None] * len(texts)


def test_counts(spark):
    texts = ["7.5K", "8M", "4.1M", "2.01K", "9,876", "seen 6.5k times", "2B", "", "none", None, ".5"]
    assert column(spark, scalars.parse_count, texts) == [
        7500, 8000000, 4099999, 2009, 9876, 6500, 2000000000, None, None, None, 5,
    ]
    frame = spark.createDataFrame([("x", "", "7 likes")], "a string, b string, c string")
    assert frame.select(scalars.first_count(*map(F.col, "abc"))).first()[0] == 7


def test_safe_int(spark):
    texts = ["5", " 6 ", "1.9", "1.5", "abc", "", None, "-3", "1e3"]
    assert column(spark, scalars.safe_int, texts) == [5, 6, 1, 1, 0, 0, 0, -3, 1000]


def test_urls(spark):
    urls = [
        "https://x.com/u/status/1?s=2", "https://x.com/u", "x.com/u/status/2", "/u/status/3", "",
        "https://x.com/u/;x", "https://x.com//u//status/77;p=1#z", "mailto:a/b", "1a:/x/y",
        "https://x.com/a b/status/5", "http:x/y", "https://x.com?x=/a/b", None,
    ]

    def username(url):
        parts = [p for p in urlparse(url).path.split("/") if p] if url else []
        return parts[0] if len(parts) >= 2 else None

    def post_id(url):
        match = re.search(r"/status/(\d+)", url or "")
        return match.group(1) if match else None

    assert column(spark, scalars.username_from_url, urls) == [username(u) for u in urls]
    assert column(spark, scalars.post_id_from_url, urls) == [post_id(u) for u in urls]
    bare = column(spark, scalars.url_without_query, urls)
    assert bare == [u.split("?", 1)[0] if u is not None else None for u in urls]


def test_search_url(spark):
    queries = ["NIFTY breakout", "a+b*c~d/e&f=g \u00e9\u20b9 -_.!'()", "%7E %2A", "#x"]
    wanted = [
        scalars.SEARCH_BASE_URL + "?" + urlencode({"q": q, "src": "typed_query", "f": "live"}, quote_via=quote)
        for q in queries
    ]
    assert column(spark, scalars.search_url, queries) == wanted


def test_keys(spark):
    rows = [("1", "A", "x"), ("", "A", "Hello  World"), (None, None, None)]
    frame = spark.createDataFrame(rows, "i string, u string, c string").coalesce(1)
    record = scalars.sha256_hex(scalars.record_key(F.col("i"), F.col("u"), F.col("c")))
    wanted = [hashlib.sha256(k.encode()).hexdigest() for k in ("1", "a:hello world", ":")]
    assert [r[0] for r in frame.select(record).collect()] == wanted
    cleaned = scalars.cleaned_key(F.col("i"), F.col("c"))
    assert [r[0] for r in frame.select(cleaned).collect()] == ["1", "Hello  World", "None"]


@pytest.mark.parametrize(
    "value",
    [datetime(2026, 7, 1, 10), datetime(2026, 7, 1, 15, 30, tzinfo=timezone(timedelta(hours=5, minutes=30)))],
)
def test_as_of_is_utc(spark, value):
    assert scalars.as_utc(value) == datetime(2026, 7, 1, 10, tzinfo=timezone.utc)
    micros = spark.range(1).select(F.unix_micros(scalars.as_of_column(value))).first()[0]
    assert micros == (scalars.as_utc(value) - EPOCH) // timedelta(microseconds=1)
