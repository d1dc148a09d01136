"""Text expressions: normalization, entity extraction, tokens.

Everything here is a plain Column expression, so text never leaves the JVM. Whitespace and word
classes are spelled out because Java's ``\\s`` is ASCII-only and its ``\\w`` differs from the
letters-digits-underscore class the results are defined on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode whitespace set, and punctuation that survives normalization.
WHITESPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD = r"\p{L}\p{N}_"
KEPT_SYMBOLS = "#@%$₹.,:+-"
TAG_EDGE_PUNCTUATION = ".,:;!?)]}'\""

URL_PATTERN = rf"https?://[^{WHITESPACE}]+"
# The sign comes first and the look behind spans it: most positions then fail on one comparison.
HASHTAG_PATTERN = rf"#(?<![^{WHITESPACE}]#)([^{WHITESPACE}#@]+)"
MENTION_PATTERN = rf"@(?<![{WORD}]@)([A-Za-z0-9_]+)"
# Of lower-case text; a plus, because Java walks a counted repeat much slower.
TOKEN_PATTERN = r"[a-z][a-z0-9_]+"

_WHITESPACE_CHARACTERS = "".join(filter(str.isspace, map(chr, range(0x3001))))
_ICU_NORMALIZER = "com.ibm.icu.text.Normalizer"


def _is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def strip(text: Column) -> Column:
    """Remove Unicode whitespace at both ends (``F.trim`` only knows U+0020)."""
    return F.btrim(text, F.lit(_WHITESPACE_CHARACTERS))


def nfkc(text: Column) -> Column:
    """NFKC form, by the ICU library that ships with Spark; ASCII text is already in NFKC."""
    text = F.coalesce(text, F.lit(""))
    composed = F.call_function(
        "reflect", F.lit(_ICU_NORMALIZER), F.lit("compose"), text, F.lit(True)
    )
    return F.when(_is_ascii(text), text).otherwise(composed)


def normalize_text(text: Column, keep_marks: bool = False) -> Column:
    """NFKC, URLs and unwanted symbols to spaces, single spaces, trimmed, lower case.

    Unwanted symbols and whitespace share one pattern: a run of either becomes one space, which is
    what replacing them one after the other gives. ``keep_marks`` keeps combining marks, so that
    Indic vowel signs survive; by default they are cut.
    """
    text = F.coalesce(text, F.lit(""))
    marks = r"\p{M}" if keep_marks else ""
    without_urls = F.when(_is_ascii(text) & ~text.contains("://"), text).otherwise(
        F.regexp_replace(nfkc(text), URL_PATTERN, " ")
    )
    spaced = F.regexp_replace(without_urls, f"[^{WORD}{marks}{KEPT_SYMBOLS}]+", " ")
    return F.lower(F.trim(spaced))


def normalize_entities(values: Column, keep_marks: bool = False) -> Column:
    """Normalize tags or mentions, drop leading # and @, drop empties; order and repeats stay."""

    def normalize_one(value: Column) -> Column:
        return F.trim(F.ltrim(normalize_text(value, keep_marks), F.lit("#@")))

    values = F.coalesce(values, F.array().cast("array<string>"))
    return F.filter(F.transform(values, normalize_one), lambda value: value != "")


def extract_hashtags(text: Column) -> Column:
    """Tags without the leading #, case kept, edge punctuation removed."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(HASHTAG_PATTERN), 1)
    trimmed = F.transform(found, lambda tag: F.btrim(tag, F.lit(TAG_EDGE_PUNCTUATION)))
    return F.filter(trimmed, lambda tag: tag != "")


def extract_mentions(text: Column) -> Column:
    """Mentioned names without the leading @, case kept; e-mail addresses do not count."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(MENTION_PATTERN), 1)


def tokens(text: Column) -> Column:
    """Lower-case ASCII word tokens of at least two characters."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), 0)


def contains_any(text: Column, markers: tuple[str, ...]) -> Column:
    """True where the lower-cased text contains one of the markers; false for null text."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    hit = F.lit(False)
    for marker in markers:
        hit = hit | lowered.contains(marker)
    return hit


def first_line(text: Column) -> Column:
    """First line of the stripped text; null when there is none."""
    head = F.regexp_extract(
        strip(F.coalesce(text, F.lit(""))), r"^[^\n-\r\x1c-\x1e\x85\u2028\u2029]*", 0
    )
    return F.nullif(strip(head), F.lit(""))
