"""Word statistics, TF-IDF, co-occurrence and text neighbours on the document tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.functions.text import contains_flag, is_blank, path_segment
from tamarack.operators import cube as cubes
from tamarack.operators import text as words
from tamarack.operators.neighbors import majority_vote, nearest_sparse
from tamarack.plans.registry import registry
from tamarack.sources.lines import tagged_documents
from tamarack.sources.tables import table
from tamarack.staging import Stage, spread

QUERIES, ORACLES, register = registry()

VOCABULARY = words.VOCABULARY_SIZE
PAIR_WORDS = 2_000
NEIGHBOURS = 10

WORDS_SQL = """
    words AS MATERIALIZED (
        SELECT doc_id, lower(w) AS word FROM (
            SELECT doc_id, unnest(string_split_regex(text, '[^a-zA-Z]+')) AS w FROM documents) WHERE w <> '')
"""


def vocabulary_sql(size: int) -> str:
    return f"""{WORDS_SQL},
    vocab AS MATERIALIZED (
        SELECT word, ROW_NUMBER() OVER (ORDER BY n DESC, word) - 1 AS idx, n FROM (
            SELECT word, COUNT(*) AS n FROM words GROUP BY 1 ORDER BY n DESC, word LIMIT {size}))
    """


def tf_idf_sql(size: int) -> str:
    return f"""{vocabulary_sql(size)},
    counts AS MATERIALIZED (
        SELECT w.doc_id, v.idx, COUNT(*) AS n FROM words w JOIN vocab v ON v.word = w.word GROUP BY 1, 2),
    tf AS (SELECT doc_id, idx, n / SUM(n) OVER (PARTITION BY doc_id) AS tf FROM counts),
    idf AS (
        SELECT idx, ln((SELECT COUNT(*) FROM documents)::DOUBLE / COUNT(*)) AS idf FROM counts GROUP BY 1),
    tfidf AS MATERIALIZED (SELECT t.doc_id, t.idx, t.tf * i.idf AS value FROM tf t JOIN idf i ON i.idx = t.idx)
    """


def moments_sql(size: int) -> str:
    return f"""{tf_idf_sql(size)},
    present AS (SELECT COUNT(DISTINCT doc_id)::DOUBLE AS n FROM counts),
    means AS (SELECT idx, SUM(value) / (SELECT n FROM present) AS mean FROM tfidf GROUP BY 1),
    moments AS MATERIALIZED (
        SELECT t.idx, m.mean, sqrt((SUM((t.value - m.mean) ** 2)
               + ((SELECT n FROM present) - COUNT(*)) * m.mean ** 2) / (SELECT n FROM present)) AS std
        FROM tfidf t JOIN means m ON m.idx = t.idx GROUP BY t.idx, m.mean)
    """


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, text), spread over the cores because splitting text into words is the costly part."""
    return spread(documents(spark, sf).select("doc_id", "text"), "doc_id")


def index(spark: SparkSession, sf: str, size: int = VOCABULARY) -> words.TermIndex:
    # Measured from the scan, as the spread texts would be shuffled for it.
    return words.TermIndex(texts(spark, sf), size=size, measured=words.text_size(documents(spark, sf)))


_KEPT = "list_transform(list_filter(string_split_regex(line, '[ \t\n\r\f]+'), lambda t: regexp_full_match(t, '[a-zA-Z]+')), lambda t: lower(t))"
_LINES = "lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)"


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return texts(spark, sf).select(F.explode(F.split("text", "\n")).alias("value"))


@register(
    "word_count",
    f"WITH {_LINES} SELECT word, COUNT(*) AS n FROM (SELECT unnest({_KEPT}) AS word FROM lines) GROUP BY 1",
)
def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return words.word_count(lines(spark, sf))


@register(
    "bigram_count",
    f"""
    WITH {_LINES}, kept AS (SELECT {_KEPT} AS t FROM lines),
    pairs AS (SELECT t, unnest(range(1, len(t))) AS i FROM kept)
    SELECT t[i] AS w1, t[i + 1] AS w2, COUNT(*) AS n FROM pairs GROUP BY 1, 2 HAVING COUNT(*) > 20
    """,
)
def bigram_count(spark: SparkSession, sf: str) -> DataFrame:
    return words.bigram_count(lines(spark, sf))


@register(
    "blank_lines",
    f"WITH {_LINES} SELECT regexp_full_match(line, '\\s*') AS blank, COUNT(*) AS n FROM lines GROUP BY 1",
)
def blank_lines(spark: SparkSession, sf: str) -> DataFrame:
    return lines(spark, sf).groupBy(is_blank(F.col("value")).alias("blank")).agg(F.count("*").alias("n"))


@register(
    "tagged_documents",
    """
    SELECT source || '/' || lang || '/' || doc_id AS doc_id, lang AS label,
           CASE WHEN contains(source, '1') THEN 1::BIGINT ELSE 0 END AS flag,
           length(text) AS n_chars, md5(replace(text, chr(10), ' ')) AS digest
    FROM documents
    """,
)
def tagged(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as one tagged line each, then taken apart again."""
    identity = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    line = F.concat(
        F.lit('<doc id="'), identity, F.lit('" url="http://example.org/'), F.col("doc_id").cast("string"),
        F.lit('" title="x">'), F.translate("text", "\n", " "),
    )
    parsed = tagged_documents(documents(spark, sf).select(line.alias("value")))
    return parsed.select(
        "doc_id",
        path_segment(F.col("doc_id"), 1).alias("label"),
        contains_flag(path_segment(F.col("doc_id"), 0), "1").cast("long").alias("flag"),
        F.length("text").cast("long").alias("n_chars"),
        F.md5("text").alias("digest"),
    )


@register(
    "rule_labels",
    """
    SELECT split_part(url, '/', 4) AS segment, CASE WHEN contains(url, '.org') THEN 1::BIGINT ELSE 0 END AS flag,
           COUNT(*) AS n
    FROM pages GROUP BY 1, 2
    """,
)
def rule_labels(spark: SparkSession, sf: str) -> DataFrame:
    url = F.col("url")
    labels = table(spark, sf, "pages").select(
        path_segment(url, 3).alias("segment"), contains_flag(url, ".org").cast("long").alias("flag")
    )
    return labels.groupBy("segment", "flag").agg(F.count("*").alias("n"))


@register("vocabulary", f"WITH {vocabulary_sql(VOCABULARY)} SELECT word, idx, n AS count FROM vocab")
def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return words.vocabulary(words.document_words(texts(spark, sf)))


@register(
    "word_ranks",
    f"""
    WITH {vocabulary_sql(VOCABULARY)}
    SELECT v.word, v.idx FROM vocab v WHERE v.word IN (
        SELECT lower(w) FROM (SELECT unnest(string_split_regex(text, '[^a-zA-Z]+')) AS w FROM benchmark))
    """,
)
def word_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """Vocabulary positions of the words that the benchmark texts use."""
    asked = words.document_words(table(spark, sf, "benchmark"), doc="item_id")
    return words.word_ranks(vocabulary(spark, sf), asked)


@register("term_counts", f"WITH {tf_idf_sql(VOCABULARY)} SELECT doc_id, idx, n FROM counts")
def term_counts(spark: SparkSession, sf: str) -> DataFrame:
    return index(spark, sf).counts


@register("term_frequency", f"WITH {tf_idf_sql(VOCABULARY)} SELECT doc_id, idx, ROUND(tf, 9) AS tf FROM tf")
def term_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return index(spark, sf).tf().withColumn("tf", F.round("tf", 9))


@register(
    "document_frequency",
    f"WITH {tf_idf_sql(VOCABULARY)} SELECT idx, COUNT(*) AS df FROM counts GROUP BY 1",
)
def document_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return words.document_frequency(index(spark, sf).counts)


@register(
    "inverse_document_frequency", f"WITH {tf_idf_sql(VOCABULARY)} SELECT idx, ROUND(idf, 9) AS idf FROM idf"
)
def inverse_document_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return index(spark, sf).idf().withColumn("idf", F.round("idf", 9))


@register("tf_idf", f"WITH {tf_idf_sql(VOCABULARY)} SELECT doc_id, idx, ROUND(value, 9) AS value FROM tfidf")
def tf_idf(spark: SparkSession, sf: str) -> DataFrame:
    return index(spark, sf).tf_idf().withColumn("value", F.round("value", 9))


@register(
    "vector_sizes",
    f"""
    WITH {tf_idf_sql(VOCABULARY)}
    SELECT c.doc_id, COUNT(*) AS n_words, CAST(SUM(c.n) AS BIGINT) AS n_tokens,
           CAST(SUM(CASE WHEN t.value <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_weighted
    FROM counts c JOIN tfidf t ON t.doc_id = c.doc_id AND t.idx = c.idx GROUP BY 1
    """,
)
def vector_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Non-zero entries of every document's count and TF-IDF vectors."""
    fitted = index(spark, sf)
    weighted = fitted.tf_idf().groupBy("doc_id").agg(F.sum(F.when(F.col("value") != 0, 1).otherwise(0)).alias("n_weighted"))
    sizes = fitted.counts.groupBy("doc_id").agg(F.count("*").alias("n_words"), F.sum("n").alias("n_tokens"))
    return sizes.join(weighted, "doc_id")


@register(
    "feature_moments",
    f"WITH {moments_sql(VOCABULARY)} SELECT idx, ROUND(mean, 9) AS mean, ROUND(std, 9) AS std FROM moments",
)
def feature_moments(spark: SparkSession, sf: str) -> DataFrame:
    return index(spark, sf).moments().select("idx", F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"))


@register(
    "standardised_tf_idf",
    f"""
    WITH {moments_sql(VOCABULARY)}
    SELECT t.doc_id, t.idx, ROUND(CASE WHEN m.std = 0 THEN 0.0 ELSE (t.value - m.mean) / m.std END, 6) AS value
    FROM tfidf t JOIN moments m ON m.idx = t.idx
    """,
)
def standardised_tf_idf(spark: SparkSession, sf: str) -> DataFrame:
    fitted = index(spark, sf)
    return words.standardised(fitted.tf_idf(), fitted.moments()).withColumn("value", F.round("value", 6))


@register(
    "applied_tf_idf",
    f"""
    WITH {tf_idf_sql(VOCABULARY)},
    asked AS (
        SELECT item_id, v.idx, COUNT(*) AS n FROM (
            SELECT item_id, unnest(string_split_regex(text, '[^a-zA-Z]+')) AS w FROM benchmark) b
        JOIN vocab v ON v.word = lower(b.w) GROUP BY 1, 2)
    SELECT a.item_id, a.idx, ROUND(a.n / SUM(a.n) OVER (PARTITION BY a.item_id) * i.idf, 9) AS value
    FROM asked a JOIN idf i ON i.idx = a.idx
    """,
)
def applied_tf_idf(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark texts weighed by the vocabulary and idf fitted on the documents."""
    weighed = index(spark, sf).transform(table(spark, sf, "benchmark"), doc="item_id", text="text")
    return weighed.withColumn("value", F.round("value", 9))


@register(
    "co_occurrence",
    f"""
    WITH {vocabulary_sql(PAIR_WORDS)},
    presence AS (SELECT DISTINCT w.doc_id, v.idx FROM words w JOIN vocab v ON v.word = w.word)
    SELECT a.idx AS w1, b.idx AS w2, COUNT(*) AS n_docs
    FROM presence a JOIN presence b ON a.doc_id = b.doc_id GROUP BY 1, 2
    """,
)
def co_occurrence(spark: SparkSession, sf: str) -> DataFrame:
    presence = index(spark, sf, PAIR_WORDS).counts.select("doc_id", "idx")
    return words.co_occurrence(presence, size=PAIR_WORDS)


@register(
    "co_occurrence_all",
    f"""
    WITH {WORDS_SQL},
    vocab AS MATERIALIZED (
        SELECT word, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, word) - 1 AS idx FROM words GROUP BY word),
    presence AS MATERIALIZED (SELECT DISTINCT w.doc_id, v.idx FROM words w JOIN vocab v ON v.word = w.word),
    pairs AS (SELECT a.idx AS w1, b.idx AS w2, COUNT(*) AS n FROM presence a JOIN presence b ON a.doc_id = b.doc_id GROUP BY 1, 2)
    SELECT w1, COUNT(*) AS n_words, CAST(SUM(n) AS BIGINT) AS n_docs, MAX(n) FILTER (w2 <> w1) AS most,
        CAST(-MAX(n * 1000000000 - w2) FILTER (w2 <> w1) + 1000000000 * MAX(n) FILTER (w2 <> w1) AS BIGINT) AS partner,
        CAST(SUM(n * (w2 % 1009 + 1)) AS BIGINT) AS mark
    FROM pairs GROUP BY 1
    """,
)
def co_occurrence_all(spark: SparkSession, sf: str) -> DataFrame:
    """What each word of the corpus shares documents with, by all pairs of all words."""
    said = words.document_words(texts(spark, sf))
    vocab = Stage(words.indexed_words(said), "all-words", {"n": F.count("*")})
    asked = documents(spark, sf).filter("doc_id IS NOT NULL").select("doc_id", "text")
    laid = words.by_document(asked, chars=words.text_size(documents(spark, sf))[1])
    presence = words.document_words(laid).distinct().join(vocab.df, "word").select("doc_id", "idx")
    # Folded where they are found: of rows for all pairs there would be billions at 0.1 GB.
    return words.co_occurrence_profile(words.co_occurrence(presence, size=vocab.sums["n"], folded=True))


def count_cube(spark: SparkSession, sf: str) -> DataFrame:
    """(doc, topic, word, n): sources as documents, languages as topics, all words of the corpus."""
    axes = F.struct(F.col("source").alias("doc"), F.col("lang").alias("topic")).alias("axes")
    said = words.document_words(documents(spark, sf).select(axes, "text"), doc="axes")
    return said.groupBy(F.col("axes.doc").alias("doc"), F.col("axes.topic").alias("topic"), "word").agg(F.count("*").alias("n"))


_CUBE = f"""{WORDS_SQL},
    cube_cells AS (
        SELECT d.source AS doc, d.lang AS topic, w.word, COUNT(*) AS n
        FROM words w JOIN documents d ON d.doc_id = w.doc_id GROUP BY 1, 2, 3)
"""


@register(
    "cube_slice",
    f"WITH {_CUBE} SELECT CAST(SUM(n) AS BIGINT) AS n FROM cube_cells WHERE doc = 'src7' AND topic BETWEEN 'de' AND 'es'",
)
def cube_slice(spark: SparkSession, sf: str) -> DataFrame:
    """One document's total over a range of topics."""
    return cubes.slice_total(count_cube(spark, sf), (F.col("doc") == "src7") & F.col("topic").between("de", "es"))


@register("cube_total", f"WITH {_CUBE} SELECT CAST(SUM(n) AS BIGINT) AS n FROM cube_cells")
def cube_total(spark: SparkSession, sf: str) -> DataFrame:
    return cubes.slice_total(count_cube(spark, sf))


@register("cube_topic_totals", f"WITH {_CUBE} SELECT topic, CAST(SUM(n) AS BIGINT) AS n FROM cube_cells GROUP BY 1")
def cube_topic_totals(spark: SparkSession, sf: str) -> DataFrame:
    return cubes.axis_totals(count_cube(spark, sf), "topic")


@register(
    "cube_topic_words",
    f"""
    WITH {_CUBE}
    SELECT word, CAST(SUM(CASE WHEN topic = 'de' THEN n ELSE 0 END) AS BIGINT) AS n FROM cube_cells GROUP BY 1
    """,
)
def cube_topic_words(spark: SparkSession, sf: str) -> DataFrame:
    """Word vector of one topic, zeros included."""
    cells = count_cube(spark, sf)
    return cubes.axis_vector(cells, "word", F.col("topic") == "de", cells.select("word").distinct())


@register(
    "cube_topic_argmax",
    f"""
    WITH {_CUBE}, s AS (SELECT word, topic, CAST(SUM(n) AS BIGINT) AS n FROM cube_cells GROUP BY 1, 2)
    SELECT word, topic, n FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY word ORDER BY n DESC, topic) AS r FROM s) WHERE r = 1
    """,
)
def cube_topic_argmax(spark: SparkSession, sf: str) -> DataFrame:
    return cubes.leading_topic(count_cube(spark, sf))


_NEIGHBOURS = f"""{tf_idf_sql(VOCABULARY)},
    asked AS (
        SELECT item_id, v.idx, COUNT(*) AS n FROM (
            SELECT item_id, unnest(string_split_regex(text, '[^a-zA-Z]+')) AS w FROM benchmark) b
        JOIN vocab v ON v.word = lower(b.w) GROUP BY 1, 2),
    q AS MATERIALIZED (
        SELECT a.item_id, a.idx, a.n / SUM(a.n) OVER (PARTITION BY a.item_id) * i.idf AS value
        FROM asked a JOIN idf i ON i.idx = a.idx),
    q2 AS (SELECT b.item_id, COALESCE(SUM(q.value * q.value), 0) AS s FROM benchmark b LEFT JOIN q ON q.item_id = b.item_id GROUP BY 1),
    d2 AS (SELECT doc_id, SUM(value * value) AS s FROM tfidf GROUP BY 1),
    dots AS (SELECT q.item_id, t.doc_id, SUM(q.value * t.value) AS s FROM q JOIN tfidf t ON t.idx = q.idx GROUP BY 1, 2),
    dist AS (
        SELECT q2.item_id, d2.doc_id, ROUND(sqrt(greatest(q2.s + d2.s - 2 * COALESCE(dots.s, 0), 0)), 9) AS distance
        FROM q2 CROSS JOIN d2 LEFT JOIN dots ON dots.item_id = q2.item_id AND dots.doc_id = d2.doc_id),
    near AS (
        SELECT * FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY distance, doc_id) AS place FROM dist)
        WHERE place <= {NEIGHBOURS})
"""


def text_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    fitted = index(spark, sf)
    corpus = words.pack_vectors(fitted.tf_idf(), doc="doc_id").withColumnRenamed("doc_id", "id")
    asked = table(spark, sf, "benchmark")
    vectors = words.pack_vectors(fitted.transform(asked, doc="item_id", text="text"), doc="item_id")
    # A query without any known word is the zero vector.
    queries = asked.select("item_id").join(vectors, "item_id", "left").select(
        F.col("item_id").alias("id"),
        F.coalesce("idx", F.array().cast("array<bigint>")).alias("idx"),
        F.coalesce("val", F.array().cast("array<double>")).alias("val"),
    )
    return nearest_sparse(queries, corpus, NEIGHBOURS, sizes=(asked.count(), fitted.n_docs))


@register(
    "text_neighbours",
    f"WITH {_NEIGHBOURS} SELECT item_id, doc_id, place, ROUND(distance, 7) AS distance FROM near",
)
def text_neighbours_query(spark: SparkSession, sf: str) -> DataFrame:
    near = text_neighbours(spark, sf)
    return near.select(
        F.col("query_id").alias("item_id"),
        F.col("point_id").alias("doc_id"),
        F.col("place").cast("long").alias("place"),
        F.round("distance", 7).alias("distance"),
    )


@register(
    "text_knn",
    f"""
    WITH {_NEIGHBOURS},
    votes AS (
        SELECT n.item_id, d.lang AS label, COUNT(*) AS votes, MIN(n.distance) AS nearest
        FROM near n JOIN documents d ON d.doc_id = n.doc_id GROUP BY 1, 2)
    SELECT item_id, label FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY votes DESC, nearest, label) AS r FROM votes)
    WHERE r = 1
    """,
)
def text_knn(spark: SparkSession, sf: str) -> DataFrame:
    """Language of each benchmark text by vote of its ten nearest documents."""
    labels = documents(spark, sf).select(F.col("doc_id").alias("point_id"), F.col("lang").alias("label"))
    near = text_neighbours(spark, sf).join(labels, "point_id")
    return majority_vote(near).select(F.col("query_id").alias("item_id"), "label")
