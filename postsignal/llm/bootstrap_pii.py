"""PII by bootstrapped contextual extraction.

Seeds are matches of strict forms: e-mail, IP address, card, phone number, and secrets such as keys. Each
candidate (an identifier-like string with a digit, alone or in a token such as a query string or a JSON line)
has a lexical pattern: its key, or what stands before it. Spark
scores the graph of patterns and instances in rounds: a pattern is as sure of a kind as the share of its
instances that belong to it, and an instance as sure as its best pattern. Patterns with enough support and
certainty then mark identifiers that no strict form knows.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsignal.llm.common import batches, staged

#: Rounds, distinct instances known of a kind that a pattern needs, and its least certainty.
ROUNDS = 3
SUPPORT = 5
CERTAINTY = 0.7
KINDS = ("email", "ip", "card", "phone", "secret")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SECRET = re.compile(r"(?<![0-9A-Za-z])(?:AKIA[0-9A-Z]{16}|(?=[0-9]*[a-f])(?=[a-f]*[0-9])[0-9a-f]{16,}+)(?![0-9A-Za-z])")
_CANDIDATE = re.compile(r"(?<!\S)[^\s0-9]*+[0-9]\S*+")
_PART = re.compile(r"[^\s=:,;&?|\"'`(){}<>\[\]]+")
_INSTANCE = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+@/-]{4,}[A-Za-z0-9]")
_BEFORE = re.compile(r"(\S+)[ \t]+(\S+)[ \t]+$|(\S+)[ \t]+$")

SPAN = "struct<kind: string, start: int, end: int>"
FOUND = "struct<pattern: string, instance: string, kind: string, start: int, end: int>"


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches that do not overlap, found from their at signs."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (match := _DOMAIN.match(text, at)):
            out.append((start, match.end()))
            done = match.end()
        at = text.find("@", max(at + 1, done))
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        n = int(digit) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def strict_spans(text: str) -> list[tuple[str, int, int]]:
    """``kind, start, end`` of all base matches, by start and then kind; places in code points, end exclusive."""
    spans = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    for match in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match[0].split(".")):
            spans.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 12 and 12 <= len(digits := _digits(match[0])) <= 19 and _luhn(digits):
            spans.append(("card", *match.span()))
    if "+" in text:
        spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def pattern_before(text: str, start: int, low: int) -> str:
    """What stands before a place: the last word, or the last two where the last has no letter or digit."""
    match = _BEFORE.search(text, low, start)
    if not match:
        return ""
    two, one, alone = match.groups()
    last = one or alone
    if two and not any(c.isalnum() for c in last):
        last = f"{two} {last}"
    return re.sub("[0-9]", "0", last.lower())


def secrets(text: str) -> list[tuple[str, int, int]]:
    """``kind, start, end`` of the keys known by their form, wherever they stand."""
    return [("secret", *match.span()) for match in _SECRET.finditer(text)]


def _parts(text: str, low: int, high: int):
    """``pattern, start, end`` of the identifier-like strings of a token: its key, or else what stands before it.

    The parts of a token lie between marks such as quotes, commas, ``=`` and ``:``.
    """
    last, done = "", low
    for part in _PART.finditer(text, low, high):
        for own in _INSTANCE.finditer(text, *part.span()):
            mark = re.search("[=:]", text[done : part.start()]) if last else None
            if own.start() > part.start() and (inner := text[max(part.start(), own.start() - 80) : own.start()]).strip("._%+@/-"):
                yield re.sub("[0-9]", "0", inner.lower()), *own.span()
            elif mark:
                yield last.lower() + mark[0], *own.span()
            elif last:
                yield re.sub("[0-9]", "0", last.lower()) + text[done : part.start()].strip("\"'`")[:1], *own.span()
            else:
                yield pattern_before(text, low, max(0, low - 80)), *own.span()
        last, done = part[0][-80:], part.end()


def candidates(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, str, str | None, int, int]]:
    """``pattern, instance, kind, start, end`` of identifier-like strings; kind is null where no strict form matches."""
    out = []
    at = 0
    for match in _CANDIDATE.finditer(text):
        for pattern, start, end in _parts(text, *match.span()):
            own = text[start:end]
            if not pattern or not re.search("[0-9]", own):
                continue
            while at < len(spans) and spans[at][2] <= start:
                at += 1
            kind = spans[at][0] if at < len(spans) and spans[at][1] < end else None
            out.append((pattern, own, kind, start, end))
    return out


def _found(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, str, str | None, int, int]]:
    """The candidates, and every secret under an empty pattern."""
    forms = secrets(text)
    known = sorted(spans + forms, key=lambda s: (s[1], KINDS.index(s[0])))
    return candidates(text, known) + [("", text[a:b], kind, a, b) for kind, a, b in forms]


def _scanned(documents: DataFrame) -> DataFrame:
    """One pass over ``doc_id, text, key``: base spans and candidates of every row, with its key."""

    def work(parts):
        for part in parts:
            spans, found = [], []
            for value in part.column(1):
                text = value.as_py() or ""
                own = strict_spans(text)
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in own])
                found.append([{"pattern": p, "instance": i, "kind": k, "start": a, "end": b} for p, i, k, a, b in _found(text, own)])
            kind_of_span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
            kind_of_found = pa.struct([("pattern", pa.string()), ("instance", pa.string()), ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
            base = [",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in own) for own in spans]
            digest = [hashlib.sha256(b.encode()).hexdigest() for b in base]
            yield pa.record_batch(
                [part.column(0), part.column(2), pa.array(digest), pa.array(spans, pa.list_(kind_of_span)), pa.array(found, pa.list_(kind_of_found))],
                ["doc_id", "row", "base_sha256", "base", "found"],
            )

    return batches(documents, work, f"doc_id long, row long, base_sha256 string, base array<{SPAN}>, found array<{FOUND}>")


def sure_patterns(found: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, certainty: float = CERTAINTY) -> DataFrame:
    """``pattern, kind`` of high-confidence patterns, from rows ``pattern, instance, kind``."""
    graph = staged(found.filter("pattern <> ''").groupBy("pattern", "instance").agg(F.max("kind").alias("kind")), "graph")
    sizes = staged(graph.groupBy("pattern").agg(F.count("*").alias("size")), "sizes")
    seeds = graph.filter("kind IS NOT NULL").select("instance", "kind").distinct().withColumn("score", F.lit(1.0))
    known = seeds
    scored = None
    for _ in range(rounds):
        held = graph.select("pattern", "instance").join(known, "instance").groupBy("pattern", "kind")
        held = held.agg(F.sum("score").alias("mass"), F.sum((F.col("score") >= certainty).cast("int")).alias("known"))
        sure = F.col("mass") / (F.col("size") + 1)
        scored = staged(
            held.join(sizes, "pattern")
            .withColumn("certainty", sure)
            .filter((F.col("known") >= support) & (F.col("certainty") >= certainty))
            .select("pattern", "kind", "certainty"),
            "patterns",
        )
        new = graph.filter("kind IS NULL").select("pattern", "instance").join(scored, "pattern")
        known = seeds.union(new.groupBy("instance", "kind").agg(F.max("certainty").alias("score")))
    return scored.select("pattern", "kind")


def _added(scan: DataFrame) -> DataFrame:
    """Per row key, the spans that are no base spans: secrets by form, and candidates of sure patterns."""
    found = scan.select("row", F.explode("found").alias("f")).select("row", "f.*")
    patterns = sure_patterns(found.select("pattern", "instance", "kind"))
    secret = found.filter("kind = 'secret' AND pattern = ''").select("row", "kind", "start", "end")
    unseen = found.filter("kind IS NULL").drop("kind").join(patterns, "pattern").select("row", "kind", "start", "end")
    return secret.union(unseen).distinct().groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))


def personal_data(documents: DataFrame) -> DataFrame:
    """Per row: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``.

    The counts and the digest cover the base spans; ``spans`` also has the added ones. A null or empty text has
    none. Repeated rows stay. Other columns are not read.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scan = staged(_scanned(documents.withColumn("row", F.monotonically_increasing_id())), "scan")
    rows = scan.drop("found").join(_added(scan), "row", "left")
    none = F.array().cast(f"array<{SPAN}>")
    order = F.array(*(F.lit(k) for k in KINDS))
    spans = F.transform(
        F.concat("base", F.coalesce("added", none)),
        lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("place"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    text = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = '{k}')) AS BIGINT) AS n_{k}") for k in KINDS[:4]]
    return rows.select("doc_id", *counts, "base_sha256", F.array_join(text, ",").alias("spans"))


def redacted(documents: DataFrame) -> DataFrame:
    """All rows and columns of ``documents``; in ``text`` every span stands as its kind in brackets.

    Overlapping spans become one, named by the first. ``n_chars``, where there, is counted anew for changed texts.
    """
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text"))
    names = documents.columns
    keyed = documents.withColumn("pii row key", key)
    scan = staged(_scanned(keyed.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("pii row key").alias("row"))), "scan")
    spans = _added(scan.filter(F.size("found") > 0)).withColumnsRenamed({"row": "pii row key", "added": "pii spans"})
    joined = keyed.join(spans, "pii row key", "left").select(*(f"`{n}`" for n in names), "pii spans")
    at = names.index("text")
    size = names.index("n_chars") if "n_chars" in names else None

    def work(parts):
        for part in parts:
            texts, sizes = part.column(at).to_pylist(), part.column(size).to_pylist() if size is not None else []
            for i, (text, added) in enumerate(zip(texts, part.column(len(names)))):
                spans = strict_spans(text or "") + [(s["kind"], s["start"], s["end"]) for s in added.as_py() or ()]
                if spans:
                    texts[i] = _masked(text, spans)
                    if size is not None:
                        sizes[i] = len(texts[i])
            columns = list(part.columns[:-1])
            columns[at] = pa.array(texts, part.column(at).type)
            if size is not None:
                columns[size] = pa.array(sizes, part.column(size).type)
            yield pa.record_batch(columns, names)

    return batches(joined, work, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema))


def _masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    out, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:]
