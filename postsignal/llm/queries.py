"""One query per operator over the driver's tables, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsignal.llm import (
    bitmap_merkle,
    bootstrap_pii,
    elias_fano_lm,
    knn_quality,
    license_join,
    nb_toxicity,
    orchard_codes,
    partenum,
    prefix_forest,
    template_leaks,
    two_fit_packing,
    uniform_shards,
    warc_index,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return elias_fano_lm.model_scores(_table(spark, sf_dir, "documents"))


def op2_best_two_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_fit_packing.pack_documents(_table(spark, sf_dir, "documents"))


def op3_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_leaks.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_nb_char_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nb_toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_license_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_join.licenses(_table(spark, sf_dir, "documents"))


def op6_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bootstrap_pii.personal_data(_table(spark, sf_dir, "documents"))


def op7_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc_index.archived(_table(spark, sf_dir, "pages"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_partenum_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.similar_groups(_table(spark, sf_dir, "documents"))


def op9_knn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn_quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_prefix_forest_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_forest.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uniform_shards.shard_digest(uniform_shards.shuffled(_table(spark, sf_dir, "documents"), in_place=True))


def op12_bitmap_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitmap_merkle.manifest(_table(spark, sf_dir, "documents"))


def op13_orchard_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchard_codes.compressed(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    own = (
        op1_elias_fano_lm,
        op2_best_two_fit_packing,
        op3_template_decontamination,
        op4_nb_char_toxicity,
        op5_license_set_join,
        op6_bootstrapped_pii,
        op7_warc_index_merge,
        op8_partenum_jaccard,
        op9_knn_quality,
        op10_prefix_forest_search,
        op11_hypergeometric_shards,
        op12_bitmap_merkle,
        op13_orchard_codes,
    )
    return {query.__name__: query for query in own}


def _lower(text: str) -> str:
    return f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _licenses() -> str:
    words = r"'[0-9a-z\x{80}-\x{10FFFF}]+'"
    phrases = [
        (phrase.split(), label, " AND ".join(f"w[i + {k}] = {_quoted(word)}" for k, word in enumerate(phrase.split())))
        for phrase, label in license_join.PHRASES.items()
    ]
    places = ", ".join(f"list_transform(list_filter(range(1, len(w) + 1), lambda i: {test}), lambda i: i - 1) AS p{n}" for n, (_, _, test) in enumerate(phrases))
    base = ", ".join(f"CASE WHEN len(p{n}) > 0 THEN {_quoted(label)} END" for n, (_, label, _) in enumerate(phrases))
    every = " || ".join(f"p{n}" for n in range(len(phrases)))
    num, den = license_join.CONTAINMENT
    templates = ", ".join(f"({_quoted(label)}, {_quoted(text)})" for label, text in license_join.TEMPLATES.items())
    return f"""
WITH words AS (SELECT rowid AS r, doc_id, {_lower('text')} AS t, regexp_extract_all({_lower('text')}, {words}) AS w
               FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)),
places AS (SELECT r, doc_id, len(w) AS n_words, {places} FROM words),
based AS (SELECT r, doc_id, n_words, list_sort({every}) AS p, list_filter([{base}], lambda x: x IS NOT NULL) AS b FROM places),
templates AS (SELECT label, list_distinct(regexp_extract_all({_lower('text')}, {words})) AS ws FROM (VALUES {templates}) v(label, text)),
lines AS (SELECT r, list_distinct(regexp_extract_all(line, {words})) AS ws FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM words)),
shares AS (SELECT r, label, max(CAST(len(list_intersect(l.ws, t.ws)) AS DOUBLE) / len(t.ws)) AS share FROM lines l, templates t
           WHERE {den} * len(list_intersect(l.ws, t.ws)) >= {num} * len(t.ws) GROUP BY ALL),
found AS (SELECT r, list(label) AS labels, max(share) AS share FROM shares GROUP BY r)
SELECT doc_id, n_words, CAST(len(p) AS BIGINT) AS n_base, CAST(p[1] AS BIGINT) AS first_word, CAST(p[len(p)] AS BIGINT) AS last_word,
       array_to_string(list_sort(list_distinct(b)), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(b || coalesce(labels, []))), ',') AS labels,
       coalesce(share, CASE WHEN len(p) > 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS score
FROM based LEFT JOIN found USING (r)"""


def _groups() -> str:
    n, num, den = partenum.WORDS, partenum.NUMERATOR, partenum.DENOMINATOR
    run = " || ' ' || ".join(f"w[i + {k}]" for k in range(n))
    return f"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({_lower('text')}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {n} THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - {n - 2}), lambda i: {run})) END AS s FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS x, any_value(b.n) AS y, count(*) AS c
           FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM shared WHERE {den} * c >= {num} * (x + y - c)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, (SELECT min(b) FROM reach WHERE reach.a = sets.doc_id) AS component_id FROM sets"""


def _archives() -> str:
    least = warc_index.LEAST_BYTES
    return f"""
WITH payloads AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
last AS (SELECT d, max(page_id) AS page FROM payloads WHERE n >= {least} GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= {least} AND page <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {least} AND page <> page_id THEN page END AS refers_to
FROM payloads LEFT JOIN last USING (d)"""


#: Levels of a tree that the statement spells out: enough for 16 ** 5 leaves a source and 16 ** 4 sources.
_LEAF_LEVELS, _SOURCE_LEVELS = 5, 4


def _tree(name: str, group: str, levels: int) -> str:
    """Statements ``{name}1`` ... from ``{name}0 (g, i, h)``: nodes of each level with the digests around them, ``m`` nodes in all."""
    out = []
    for k in range(levels + 1):
        run = "OVER (PARTITION BY g, i // 16 ORDER BY i ROWS BETWEEN"
        out.append(
            f"""{name}s{k} AS (SELECT *, count(*) OVER (PARTITION BY g) AS m, coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
            coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a FROM {name}{k})"""
        )
        if k < levels:
            up = "CASE WHEN any_value(m) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END"
            out.append(f"{name}{k + 1} AS (SELECT g, i // 16 AS i, {up} AS h FROM {name}s{k} GROUP BY g, i // 16)")
    return ",\n".join(out)


def _manifest() -> str:
    def part(value: str) -> str:
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        own = [part(f"CAST({c} AS VARCHAR)") for c in ("doc_id", "source", "lang", "n_chars")]
        return f"sha256({' || '.join([*own, part(text)])})"

    step = "CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END"
    byte = f"list_reduce([xor(c, d), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: {step})"
    digits = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {digits}), lambda c, d: {byte}), 4294967295)"
    lower = f"translate(text, '{bitmap_merkle.UPPER}', '{bitmap_merkle.LOWER}')"
    proof = "''"
    folded, joins = "changed", []
    for name, levels, place, group in (("l", _LEAF_LEVELS, "i", "r.g"), ("t", _SOURCE_LEVELS, "n", "0")):
        for k in range(levels):
            at = f"{name}_{k}"
            joins.append(f"JOIN {name}s{k} {at} ON {at}.g = {group} AND {at}.i = r.{place} // {16**k}")
            proof += f" || {at}.b || {at}.a"
            folded = f"CASE WHEN {at}.m = 1 THEN {folded} ELSE sha256({at}.b || {folded} || {at}.a) END"
    return f"""
WITH leaves AS (SELECT doc_id, source, {leaf('text')} AS h, CASE WHEN coalesce({crc}, 0) % 5 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS changed FROM documents),
named AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS g FROM (SELECT DISTINCT source FROM documents)),
rows_ AS MATERIALIZED (SELECT doc_id, h, changed, g, g AS n, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i
          FROM leaves JOIN named ON leaves.source IS NOT DISTINCT FROM named.source),
l0 AS (SELECT g, i, h FROM rows_),
{_tree("l", "g", _LEAF_LEVELS)},
t0 AS (SELECT 0 AS g, g AS i, h FROM l{_LEAF_LEVELS}),
{_tree("t", "g", _SOURCE_LEVELS)},
done AS (SELECT r.doc_id, r.h AS leaf, t_0.h AS subroot, (SELECT h FROM t{_SOURCE_LEVELS}) AS root, sha256({proof}) AS proof_sha256, {folded} AS folded_root
         FROM rows_ r {' '.join(joins)})
SELECT *, folded_root = root AS verified FROM done"""


def _codes() -> str:
    scale, n, entries = orchard_codes.SCALE, orchard_codes.PARTS, orchard_codes.ENTRIES
    bad = "list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))"
    apart = "list_sum(list_transform(range(1, len(v) + 1), lambda i: (v[i] - c[i]) * (v[i] - c[i])))"
    rounds = []
    for r in range(orchard_codes.ROUNDS + 1):
        rounds.append(
            f"near{r} AS MATERIALIZED (SELECT id, p, v, min({{'d': CAST({apart} AS BIGINT), 'e': e}}) AS best FROM parts JOIN book{r} USING (p) GROUP BY id, p, v)"
        )
        if r < orchard_codes.ROUNDS:
            rounds.append(
                f"""means{r} AS (SELECT p, best.e AS e, i, CAST(floor(sum(v[i]) / count(*)) AS BIGINT) AS x FROM near{r}, range(1, len(v) + 1) t(i) GROUP BY ALL),
book{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN (SELECT p, e, list(x ORDER BY i) AS c FROM means{r} GROUP BY p, e) m USING (p, e))"""
            )
    last = orchard_codes.ROUNDS
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id, vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS g
              FROM embeddings WHERE embedding IS NOT NULL AND len({bad}) = 0),
parts AS MATERIALIZED (SELECT id, p, g[p * len(g) // {n} + 1:(p + 1) * len(g) // {n}] AS v FROM kept, range({n}) t(p)),
book0 AS MATERIALIZED (SELECT p, id AS e, v AS c FROM parts WHERE id < {entries}),
{(',' + chr(10)).join(rounds)},
coded AS (SELECT id, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM near{last} GROUP BY id),
digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{last})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded JOIN kept USING (id), digest"""


def oracle_sql() -> dict[str, str]:
    return {
        "op12_bitmap_merkle": _manifest(),
        "op13_orchard_codes": _codes(),
        "op5_license_set_join": _licenses(),
        "op7_warc_index_merge": _archives(),
        "op8_partenum_jaccard": _groups(),
    }
