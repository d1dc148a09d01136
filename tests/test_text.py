"""Text expressions against plain Python definitions of the same results."""

import random
import re
import unicodedata

from pyspark.sql import functions as F

from postsignal.functions import text

PIECES = [
    "http://", "https://", "a", "B", "\u00c9", "e\u0301", "\ufb01", "\u2460", "\U0001f680", " ",
    "\u00a0", "\n", "\u2028", "#", "@", "\u0928\u093f\u092b\u094d\u091f\u0940", "\u20b9", "://", "/",
    "_", "\u0130", "\u03a3", "\uff48\uff54\uff54\uff50\uff1a\uff0f\uff0f", "%", "\x1c", "\u212b",
    "\u1100\u1161", "'", '"', ";", "$", "-", "+", ".", ",", ":", "\u00bd", "\u0663", "\u200b", "\t", "K9",
]


SPACE = {"Zs", "Zl", "Zp"}
CONTROL_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85"


def is_space(c):
    return unicodedata.category(c) in SPACE or c in CONTROL_SPACE


def is_word(c):
    return c == "_" or unicodedata.category(c)[0] == "L" or unicodedata.category(c) in ("Nd", "Nl", "No")


def normalized(value):
    """Scan character by character: skip links, blank out what may not stay, join by single spaces."""
    value = unicodedata.normalize("NFKC", value or "")
    parts, at = [""], 0
    while at < len(value):
        scheme = next((p for p in ("https://", "http://") if value.startswith(p, at)), None)
        rest = at + len(scheme or "")
        if scheme and rest < len(value) and not is_space(value[rest]):
            while rest < len(value) and not is_space(value[rest]):
                rest += 1
            parts.append("")
            at = rest
            continue
        if is_word(value[at]) or value[at] in "#@%$,.:+-\u20b9":
            parts[-1] += value[at]
        else:
            parts.append("")
        at += 1
    return " ".join(part for part in parts if part).lower()


def tags(value):
    """Every # that begins the text or follows white space opens a tag up to white space, # or @."""
    found = []
    for at, c in enumerate(value):
        if c != "#" or (at and not is_space(value[at - 1])):
            continue
        end = at + 1
        while end < len(value) and value[end] not in "#@" and not is_space(value[end]):
            end += 1
        body = list(value[at + 1 : end])
        while body and body[-1] in TRIMMED:
            body.pop()
        while body and body[0] in TRIMMED:
            body.pop(0)
        if body:
            found.append("".join(body))
    return found


# Punctuation cut from the ends of a tag.
TRIMMED = set(".,:;!?)]}'\"")


def one(spark, expression, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v"))).first()[0]


def test_random_texts_match_python(spark):
    random.seed(7)
    texts = sorted({"".join(random.choices(PIECES, k=random.randint(0, 14))) for _ in range(4000)})
    value = F.col("v")
    rows = (
        spark.createDataFrame([(t,) for t in texts], "v string")
        .select(
            "v",
            text.normalize_text(value).alias("normalized"),
            text.extract_hashtags(value).alias("tags"),
            text.extract_mentions(value).alias("mentions"),
            text.tokens(value).alias("tokens"),
            text.first_line(value).alias("line"),
        )
        .collect()
    )
    for row in rows:
        stripped = row.v.strip()
        assert row.normalized == normalized(row.v), ascii(row.v)
        assert row.tags == tags(row.v), ascii(row.v)
        assert row.mentions == re.findall(r"(?<!\w)@([A-Za-z0-9_]+)", row.v), ascii(row.v)
        assert row.tokens == re.findall(r"[a-zA-Z][a-zA-Z0-9_]{1,}", row.v.lower()), ascii(row.v)
        line = stripped.splitlines()[0].strip() or None if stripped else None
        assert row.line == line, ascii(row.v)


def test_nfkc_of_every_assigned_character(spark):
    points = [p for p in range(1, 0x110000) if not 0xD800 <= p <= 0xDFFF]
    frame = spark.range(1, 0x110000).where("id NOT BETWEEN 55296 AND 57343")
    character = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    rows = frame.select("id", text.nfkc(character).alias("n")).where(F.col("n") != character).collect()
    changed = {row.id: row.n for row in rows}
    for point in points:
        if unicodedata.category(chr(point)) != "Cn":
            assert changed.get(point, chr(point)) == unicodedata.normalize("NFKC", chr(point)), hex(point)


def test_long_runs_do_not_overflow(spark):
    noisy = "\U0001f680" * 50_000 + " a " + "http://x " * 20_000 + " " * 50_000 + "end"
    assert one(spark, text.normalize_text, noisy) == "a end"


def test_normalization_examples(spark):
    assert one(spark, text.normalize_text, "\tGold\u2003falls 3% \u2603 see https://ex.org/a?b, says @Desk") == (
        "gold falls 3% see says @desk"
    )
    assert one(spark, text.normalize_text, None) == ""
    tag = "#\u0915\u093f\u0924\u093e\u092c"
    assert one(spark, text.normalize_text, tag) == "#\u0915 \u0924 \u092c"
    assert one(spark, lambda c: text.normalize_text(c, keep_marks=True), tag) == tag


def test_entities(spark):
    values = ["#Oil", "@@DESK", None, "", "#", " C d ", "oil", "#Oil"]
    assert one(spark, text.normalize_entities, values, "array<string>") == ["oil", "desk", "c d", "oil", "oil"]
    assert one(spark, text.normalize_entities, None, "array<string>") == []


def test_entity_examples(spark):
    assert one(spark, text.extract_hashtags, "#up2 then #down! not a#tag (#x) \u2003#\u03b1\u03b2;") == ["up2", "down", "\u03b1\u03b2"]
    assert one(spark, text.extract_mentions, "cc @desk_1, mail me@site.org, @\u00e9 (@Ops)") == ["desk_1", "Ops"]
    assert one(spark, text.tokens, "9lives go on_2 q \u00fcber z9") == ["lives", "go", "on_2", "ber", "z9"]


def test_markers(spark):
    check = lambda c: text.contains_any(c, ("log in", "sign in"))
    assert one(spark, check, "Please LOG IN now") is True
    assert one(spark, check, "hello") is False
    assert one(spark, check, None) is False
