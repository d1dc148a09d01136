"""TF-IDF over a top-k vocabulary, in long form and as one column per term."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postsignal.functions.text import tokens
from postsignal.operators.order import running_before, value_at_rank
from postsignal.sinks.tables import stage

DEFAULT_TERMS = 25
# A token and its repeats in sorted tokens, each followed by a space.
_RUN_PATTERN = r"([a-z0-9_]++ )\1*+"


@dataclass(frozen=True)
class Term:
    """A vocabulary entry with its corpus statistics; ``rank`` starts at 1."""

    rank: int
    term: str
    corpus_count: int
    document_count: int
    corpus_size: int

    @property
    def idf(self) -> float:
        return math.log((1 + self.corpus_size) / (1 + self.document_count)) + 1.0


def _check_size(top_k: int) -> None:
    if top_k < 0:
        raise ValueError("top_k must not be negative")


def vocabulary(
    posts: DataFrame, top_k: int = DEFAULT_TERMS, text: str = "content_clean", order: str = "ingest_seq"
) -> DataFrame:
    """``top_k`` terms by corpus count; ties go to the term that occurs first.

    Each post yields a row without term that counts the post, then its distinct tokens in order of
    appearance, then all its tokens. A single hash aggregation by term then has every count and the
    first occurrence; nothing is grouped by post, so the shuffle carries at most one row per term and
    task. ``order`` should be a bigint: other types make Spark sort before it aggregates.
    """
    _check_size(top_k)
    words = posts.select(F.col(order).alias("_order"), tokens(F.col(text)).alias("_words"))
    words = words.withColumn("_distinct", F.array_distinct("_words"))
    post_mark = F.array(F.lit(None).cast("string"))
    rows = words.select(
        "_order",
        F.size("_distinct").alias("_n_distinct"),
        F.posexplode(F.concat(post_mark, "_distinct", "_words")).alias("place", "term"),
    )
    is_distinct = F.col("place").between(1, F.col("_n_distinct"))
    by_post = F.when(is_distinct, F.col("_order"))
    counts = rows.groupBy("term").agg(
        F.count_if(~is_distinct).alias("corpus_count"),
        F.count_if(is_distinct).alias("document_count"),
        F.min(by_post).alias("first_post"),
        F.min_by("place", by_post).alias("first_place"),
    )
    # The post count sorts first, so it survives the limit; the window sees top_k + 1 rows.
    best = counts.orderBy(
        F.col("term").isNotNull(), F.desc("corpus_count"), "first_post", "first_place"
    ).limit(top_k + 1)
    post_count = F.max(F.when(F.col("term").isNull(), F.col("corpus_count")))
    corpus_size = post_count.over(Window.partitionBy(F.lit(0)))
    return (
        best.withColumn("corpus_size", corpus_size)
        .where(F.col("term").isNotNull())
        .withColumn("idf", F.log((1 + F.col("corpus_size")) / (1 + F.col("document_count"))) + 1)
    )


def fit_terms(
    posts: DataFrame, top_k: int = DEFAULT_TERMS, text: str = "content_clean", order: str = "ingest_seq"
) -> list[Term]:
    """The vocabulary on the driver, best term first (never more than ``top_k`` rows)."""
    rows = vocabulary(posts, top_k, text, order).collect()
    rows.sort(key=lambda row: (-row["corpus_count"], row["first_post"], row["first_place"]))
    return [
        Term(rank, row["term"], row["corpus_count"], row["document_count"], row["corpus_size"])
        for rank, row in enumerate(rows, start=1)
    ]


def terms_frame(spark: SparkSession, terms: list[Term]) -> DataFrame:
    rows = [(t.rank, t.term, t.corpus_count, t.document_count, t.corpus_size, t.idf) for t in terms]
    return spark.createDataFrame(
        rows,
        "rank int, term string, corpus_count bigint, document_count bigint, corpus_size bigint, idf double",
    )


def with_words(posts: DataFrame, text: str = "content_clean") -> DataFrame:
    """``_words``, the tokens of each post, a column of its own: they are cut once for all its readers."""
    return posts.withColumn("_words", tokens(F.col(text)))


def _with_hits(words: DataFrame, terms: list[Term]) -> DataFrame:
    """Token count and the vocabulary tokens of each post with ``_words``; a hash lookup per token."""
    names = [t.term for t in terms]
    return words.withColumns(
        {
            "_n_tokens": F.size("_words"),
            "_hits": F.filter("_words", lambda word: word.isin(names)),
        }
    ).drop("_words")


def _histogram() -> Column:
    """How often each vocabulary token occurs in the post, as a map; each distinct token is counted once."""
    return F.map_from_entries(
        F.transform(F.array_distinct("_hits"), lambda term: F.struct(term, F.size(F.filter("_hits", lambda word: word == term))))
    )


def _frequency(count: Column) -> Column:
    """Share of the post's tokens; a post without tokens has share 0."""
    return F.coalesce(F.try_divide(count, F.col("_n_tokens")), F.lit(0.0))


def tfidf_long(
    posts: DataFrame,
    terms: list[Term],
    keys: tuple[str, ...] = ("ingest_seq",),
    text: str = "content_clean",
) -> DataFrame:
    """One row per post and vocabulary term in it: ``term, tf, idf, tfidf``. No shuffle.

    Tokens outside the vocabulary are gone before anything is exploded; the idf comes from the
    vocabulary table, broadcast because ``top_k`` bounds it.
    """
    found = _with_hits(with_words(posts.select(*keys, text), text), terms).select(*keys, "_n_tokens", F.explode(_histogram()).alias("term", "n"))
    idf = F.broadcast(terms_frame(posts.sparkSession, terms).select("term", "idf"))
    tf = _frequency(F.col("n"))
    return found.join(idf, "term").select(
        *keys, "term", tf.alias("tf"), "idf", (tf * F.col("idf")).alias("tfidf")
    )


def tfidf_wide(posts: DataFrame, terms: list[Term], text: str = "content_clean") -> DataFrame:
    """One ``tfidf_<term>`` column per term in vocabulary order, 0 where the term is absent.

    Without terms the posts come back unchanged.
    """
    return words_tfidf_wide(with_words(posts, text), terms)


def _occurrences(term: str) -> Column:
    """How often a term stands in ``_line``, by what its removal takes away."""
    rest = F.replace("_line", F.lit(f" {term} "), F.lit(""))
    return ((F.octet_length("_line") - F.octet_length(rest)) / (len(term.encode()) + 2)).cast("int")


def words_tfidf_wide(words: DataFrame, terms: list[Term]) -> DataFrame:
    """``tfidf_wide`` of posts that have their tokens in ``_words`` (see ``with_words``), which is dropped.

    The vocabulary tokens of a post are put in a line, each between two spaces, and counted there: terms hold no
    spaces, and no work is done for each pair of tokens.
    """
    kept = [name for name in words.columns if name != "_words"]
    if not terms:
        return words.select(*kept)
    line = F.concat(F.lit(" "), F.array_join("_hits", "  "), F.lit(" "))
    counted = _with_hits(words, terms).withColumn("_line", line)
    scores = [(_frequency(_occurrences(t.term)) * F.lit(t.idf)).alias(f"tfidf_{t.term}") for t in terms]
    return counted.select(*kept, *scores)


def _counted_words(posts: DataFrame, text: str, *keys: str) -> DataFrame:
    """``keys, n_tokens, place, term, n``: each distinct token of each post; a post without any has one row of nulls.

    Sorted tokens come in runs. A pattern finds each run whole (tokens hold no spaces), and its length gives the count, so
    nothing is interpreted token by token. ``place`` numbers the rows of a post from 0.
    """
    words = posts.select(*keys, tokens(F.coalesce(F.col(text), F.lit(""))).alias("_words"))
    joined = F.concat(F.array_join(F.sort_array("_words"), " "), F.lit(" "))
    runs = words.select(*keys, F.size("_words").alias("_size"), F.regexp_extract_all(joined, F.lit(_RUN_PATTERN), 0).alias("_runs"))
    runs = runs.select(*keys, F.nullif("_size", F.lit(0)).alias("n_tokens"), F.posexplode_outer("_runs").alias("place", "_run"))
    runs = runs.withColumn("term", F.substring_index("_run", " ", 1))
    n = (F.octet_length("_run") / (F.octet_length("term") + 1)).cast("int")
    return runs.select(*keys, "n_tokens", "place", "term", n.alias("n"))


def vocabulary_table(
    posts: DataFrame, top_k: int, text: str = "content_clean", order: str = "ingest_seq"
) -> DataFrame:
    """A vocabulary of any size as a table that never visits the driver, with ``index`` from 0, best term first.

    ``term, index, corpus_count, document_count, corpus_size, idf``. The count of the term at place ``top_k`` is found by its
    digits; only terms with that count or more are looked up again for their first occurrence, which settles ties. The
    table is written, so that Spark knows its size before it plans a join.
    """
    _check_size(top_k)
    words = _counted_words(posts.select(F.col(order).alias("_order"), text), text, "_order")
    counts = words.groupBy("term").agg(
        F.sum("n").alias("corpus_count"), F.count(F.lit(1)).alias("document_count"), F.min("_order").alias("_post")
    )
    counts = stage(counts.where(F.col("term").isNotNull()).withColumn("_less", -F.col("corpus_count")), "terms")
    last = value_at_rank(counts, top_k, "_less").first()
    candidates = counts if last is None else counts.where(F.col("_less") <= last[0])
    candidates = stage(candidates.where(F.lit(top_k > 0)), "candidates")
    # Only posts in which a candidate occurs first are cut into tokens again.
    firsts = posts.select(F.col(order).alias("_post"), text).join(candidates.select("_post").distinct(), "_post", "left_semi")
    places = firsts.select("_post", F.array_distinct(tokens(F.col(text))).alias("_words"))
    places = places.select("_post", F.posexplode("_words").alias("_place", "term")).join(candidates.select("term", "_post"), ["term", "_post"], "left_semi")
    firsts = places.groupBy("term", "_post").agg(F.min("_place").alias("_place"))
    candidates = candidates.join(firsts, ["term", "_post"])
    ordered = running_before(candidates.withColumn("_one", F.lit(1)), ["_less", "_post", "_place"], "_one", "index")
    kept = ordered.where(F.col("index") < top_k)
    size = F.lit(max(1, posts.count()))
    idf = F.log((1 + size) / (1 + F.col("document_count"))) + 1
    kept = kept.select("term", "index", "corpus_count", "document_count", size.cast("bigint").alias("corpus_size"), idf.alias("idf"))
    return stage(kept, "vocabulary")


def tfidf_sparse(
    posts: DataFrame, terms: DataFrame, keys: tuple[str, ...] = ("ingest_seq",), text: str = "content_clean"
) -> DataFrame:
    """``keys, indices, values``: a sparse vector for every post over a vocabulary table of any size.

    Each distinct token of a post meets the vocabulary once, broadcast where Spark finds that small enough. Keys must
    be unique; a post without vocabulary terms has an empty vector.
    """
    words = _counted_words(posts, text, *keys)
    met = words.join(terms.select("term", "index", "idf"), "term", "left")
    # Of the tokens without an index only a post's first stays, which keeps the post.
    met = met.where(F.col("index").isNotNull() | (F.coalesce("place", F.lit(0)) == 0))
    score = F.struct(F.col("index"), (F.try_divide("n", "n_tokens") * F.col("idf")).alias("value"))
    vectors = met.groupBy(*keys).agg(F.array_sort(F.collect_list(F.when(F.col("index").isNotNull(), score))).alias("_vector"))
    return vectors.select(*keys, F.col("_vector.index").alias("indices"), F.col("_vector.value").alias("values"))
