import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from conftest import rows
from tamarack.operators import cube, text
from tamarack.operators.relational import lookup
from tamarack.sources.generators import topic_corpus


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def documents(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")


def test_word_count_drops_mixed_tokens_whole(spark):
    got = text.word_count(lines(spark, ["Dog dog, dog2 DOG\tcat\fcat", "", "  ", "café naïve cat", "end "]))
    assert rows(got) == [("cat", 3), ("dog", 2)]


def test_bigrams_bridge_dropped_tokens_but_not_lines(spark):
    got = text.bigram_count(lines(spark, ["a 1 b", "A b c", "a", "", "b"]), min_exclusive=0)
    assert rows(got) == [("a", "b", 2), ("b", "c", 1)]


def test_bigram_bound_applies_to_the_final_count(spark):
    spread = lines(spark, ["x y"] * 21 + ["u v"] * 20).repartition(16)
    assert rows(text.bigram_count(spread)) == [("x", "y", 21)]


def test_vocabulary_breaks_ties_by_word_and_may_be_short(spark):
    words = text.document_words(documents(spark, ["b a c c", "B2d a"]))
    got = sorted(tuple(r) for r in text.vocabulary(words, size=100).collect())
    assert got == [("a", 0, 2), ("b", 1, 2), ("c", 2, 2), ("d", 3, 1)]
    assert sorted(r["word"] for r in text.vocabulary(words, size=2).collect()) == ["a", "b"]


CORPUS = ["the cat sat the mat", "the dog", "the", "", "42 !!", "the cat dog dog"]


def brute(corpus):
    docs = {i: [w.lower() for w in "".join(c if c.isascii() and c.isalpha() else " " for c in t).split()] for i, t in enumerate(corpus)}
    counts = Counter(w for ws in docs.values() for w in ws)
    vocab = {w: i for i, (w, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0])))}
    rows_ = {(d, vocab[w]): n for d, ws in docs.items() for w, n in Counter(ws).items()}
    df = Counter(i for _, i in rows_)
    total = {d: len(ws) for d, ws in docs.items()}
    return {(d, i): n / total[d] * math.log(len(corpus) / df[i]) for (d, i), n in rows_.items()}, vocab


def test_tf_idf_counts_documents_without_words_in_n(spark):
    index = text.TermIndex(documents(spark, CORPUS), size=100)
    expected, _ = brute(CORPUS)
    got = {(r["doc_id"], r["idx"]): r["value"] for r in index.tf_idf().collect()}
    assert got.keys() == expected.keys()
    assert all(math.isclose(got[k], expected[k], abs_tol=1e-12) for k in got)
    assert index.n_docs == 6 and index.n_present() == 4 and index.n_words() == 5


def test_word_in_every_document_weighs_nothing(spark):
    index = text.TermIndex(documents(spark, ["a b", "a c", "a"]), size=10)
    values = {(r["doc_id"], r["idx"]): r["value"] for r in index.tf_idf().collect()}
    assert [v for (_, i), v in values.items() if i == 0] == [0.0, 0.0, 0.0]
    assert index.tf_idf().filter("value <> 0").count() == index.counts.count() - 3


def test_moments_match_dense(spark):
    index = text.TermIndex(documents(spark, CORPUS), size=100)
    values, vocab = brute(CORPUS)
    present = sorted({d for d, _ in values})
    dense = np.zeros((len(present), len(vocab)))
    for (d, i), v in values.items():
        dense[present.index(d), i] = v
    got = {r["idx"]: (r["mean"], r["std"]) for r in index.moments().collect()}
    for i in range(len(vocab)):
        assert np.allclose(got[i], (dense[:, i].mean(), dense[:, i].std()))
    z = {(r["doc_id"], r["idx"]): r["value"] for r in text.standardised(index.tf_idf(), index.moments()).collect()}
    for (d, i), v in z.items():
        std = dense[:, i].std()
        assert math.isclose(v, 0 if std == 0 else (dense[present.index(d), i] - dense[:, i].mean()) / std, abs_tol=1e-9)


def test_transform_uses_the_fitted_vocabulary(spark):
    index = text.TermIndex(documents(spark, CORPUS), size=100)
    other = spark.createDataFrame([(9, "cat zebra cat dog"), (8, "zebra")], "q long, body string")
    got = {(r["q"], r["idx"]): r["value"] for r in index.transform(other, doc="q", text="body").collect()}
    _, vocab = brute(CORPUS)
    assert set(got) == {(9, vocab["cat"]), (9, vocab["dog"])}
    assert math.isclose(got[9, vocab["cat"]], 2 / 3 * math.log(6 / 2))


def test_counts_are_dealt_to_tasks_by_the_size_of_the_texts(spark, monkeypatch):
    corpus = [f"a b{i % 7 * 'x'} {'long ' * 40}" for i in range(300)]
    docs = documents(spark, corpus).repartition(64, "doc_id")
    expected = rows(text.TermIndex(docs, size=100).counts)
    n, chars = text.text_size(docs)
    assert (n, chars) == (300, sum(map(len, corpus))) and text.text_size(docs.limit(0)) == (0, 0)
    laid = text.by_document(docs, chars=chars, task_chars=500)
    assert laid.rdd.getNumPartitions() == -(-chars // 500) > 64
    # Each document lies in one task, and no task holds much more than its share.
    held = laid.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(F.length("text")).alias("c"), F.collect_list("doc_id").alias("d")).collect()
    assert sorted(d for r in held for d in r["d"]) == list(range(300)) and max(r["c"] for r in held) < chars / 20
    seen = []
    dealt = text.by_document
    monkeypatch.setattr(text, "by_document", lambda docs, **given: seen.append(given["chars"]) or dealt(docs, task_chars=500, **given))
    index = text.TermIndex(docs, size=100)
    assert rows(index.counts) == expected and seen == [chars]
    index.transform(documents(spark, ["a long", None]), doc="doc_id", text="text")
    assert seen == [chars, 6]


def test_word_ranks_and_lookup(spark):
    index = text.TermIndex(documents(spark, CORPUS), size=100)
    asked = spark.createDataFrame([("the",), ("nope",), ("dog",)], "word string")
    assert rows(text.word_ranks(index.vocab, asked)) == [("dog", 1), ("the", 0)]


def test_lookup_of_one_document(spark):
    index = text.TermIndex(documents(spark, CORPUS), size=100)
    assert rows(lookup(index.counts, "doc_id", 0)) == [(0, 0, 2), (0, 2, 1), (0, 3, 1), (0, 4, 1)]
    assert rows(lookup(index.vocab, "word", "the").select("idx")) == [(0,)]


def test_pack_vectors_sorted(spark):
    df = spark.createDataFrame([(1, 5, 0.5), (1, 2, 0.25), (2, 1, 1.0)], "d long, idx long, value double")
    assert rows(text.pack_vectors(df, doc="d")) == [(1, [2, 5], [0.25, 0.5]), (2, [1], [1.0])]


def test_co_occurrence_single_and_many_tiles(spark):
    rng = np.random.default_rng(1)
    presence = sorted({(int(d), int(w)) for d, w in zip(rng.integers(0, 40, 400), rng.integers(0, 30, 400))})
    presence += [(99, 3)]
    expected = Counter()
    by_doc = {}
    for d, w in presence:
        by_doc.setdefault(d, []).append(w)
    for ws in by_doc.values():
        for a in ws:
            for b in ws:
                expected[a, b] += 1
    df = spark.createDataFrame(presence, "doc_id long, idx long")
    for cells in (8_000_000, 30 * 7, 30):
        got = {(r["w1"], r["w2"]): r["n_docs"] for r in text.co_occurrence(df, size=30, tile_cells=cells).collect()}
        assert got == dict(expected)
    # Tiles above the bound are dealt to several tasks and summed again.
    dealt = text.co_occurrence(df, size=30, tile_cells=100, task_pairs=40).collect()
    assert {(r["w1"], r["w2"]): r["n_docs"] for r in dealt} == dict(expected) and len(dealt) == len(expected)
    nothing = text.co_occurrence(df.limit(0), size=1)
    assert nothing.count() == text.co_occurrence_profile(nothing).count() == 0


def test_co_occurrence_profile_and_unbounded_vocabulary(spark):
    docs = spark.createDataFrame([(1, "b a c a"), (2, "a B"), (3, "a"), (4, "")], "doc_id long, text string")
    said = text.document_words(docs)
    vocab = text.indexed_words(said)
    assert rows(vocab) == [("a", 0, 4), ("b", 1, 2), ("c", 2, 1)]
    presence = said.distinct().join(vocab, "word").select("doc_id", "idx")
    got = rows(text.co_occurrence_profile(text.co_occurrence(presence, size=3)))
    assert got == [(0, 3, 6, 2, 1, 3 * 1 + 2 * 2 + 1 * 3), (1, 3, 5, 2, 0, 2 * 1 + 2 * 2 + 1 * 3), (2, 3, 3, 1, 0, 1 + 2 + 3)]


def test_folded_pairs_are_those_of_the_product(spark, monkeypatch):
    rng = np.random.default_rng(4)
    words = np.minimum(rng.geometric(0.05, 900) - 1, 49)
    presence = sorted({(int(d), int(w)) for d, w in zip(rng.integers(0, 60, 900), words)}) + [(99, 50), (None, 3), (None, 51)]
    df = spark.createDataFrame(presence, "doc_id long, idx long")
    expected = rows(text.co_occurrence_profile(text.co_occurrence(df, size=52)))
    assert (50, 1, 1, None, None, 51) in expected and len(expected) < 52
    monkeypatch.setattr(text, "parallelism", lambda spark: 2)
    for given in ({}, {"task_entries": 400}, {"task_entries": 60, "sorted_pairs": 30}):
        folded = text._folded(df, size=52, doc="doc_id", **given)
        assert rows(text.co_occurrence_profile(folded)) == expected
        # No pair leaves its task: there is a row per word.
        assert folded.count() == len(expected)
    asked = text.co_occurrence_profile(text.co_occurrence(df, size=52, folded=True))
    assert rows(asked) == expected
    assert text.co_occurrence_profile(text.co_occurrence(df.limit(0), size=1, folded=True)).count() == 0


def test_cube_totals_and_ties(spark):
    cells = topic_corpus(spark, docs=10, topics=8, words=40, length=100, seed=3).cache()
    data = {(r["doc"], r["topic"], r["word"]): r["n"] for r in cells.collect()}
    assert cube.slice_total(cells).first()[0] == 1000
    got = cube.slice_total(cells, (F.col("doc") == 3) & F.col("topic").between(2, 5)).first()[0]
    assert got == sum(n for (d, t, _), n in data.items() if d == 3 and 2 <= t <= 5)
    assert cube.slice_total(cells, F.col("doc") == 77).first()[0] == 0
    members = spark.range(40).withColumnRenamed("id", "word")
    vector = dict(rows(cube.axis_vector(cells, "word", F.col("topic") == 5, members)))
    assert vector == {w: sum(n for (_, t, x), n in data.items() if t == 5 and x == w) for w in range(40)}
    sums = Counter()
    for (_, t, w), n in data.items():
        sums[w, t] += n
    expected = {w: min((-n, t) for (x, t), n in sums.items() if x == w)[1] for w, _ in sums}
    assert {r["word"]: r["topic"] for r in cube.leading_topic(cells).collect()} == expected
    tie = spark.createDataFrame([(0, 2, 1, 4), (0, 1, 1, 4)], "doc long, topic long, word long, n long")
    assert rows(cube.leading_topic(tie)) == [(1, 1, 4)]


def test_folded_lists_are_read_in_place_by_all_blocks(spark, monkeypatch):
    """Long and short lists, words on both sides of ``LOW_WORDS``, and a word whose documents no task can keep."""
    monkeypatch.setattr(text, "LOW_WORDS", 20)
    monkeypatch.setattr(text, "ROW_ENTRIES", 25)
    rng = np.random.default_rng(8)
    presence = {(d, int(w)) for d in range(50) for w in np.minimum(rng.geometric(0.04, rng.integers(1, 40)) - 1, 89)}
    presence = sorted(presence | {(d, 0) for d in range(50)} | {(d, 40) for d in range(40)} | {(77, 89)})
    df = spark.createDataFrame(presence, "doc_id long, idx long")
    expected = rows(text.co_occurrence_profile(text.co_occurrence(df, size=90)))
    for entries, pairs in ((10_000, 1_000_000), (900, 1_000_000), (900, 20), (150, 20)):
        folded = text._folded(df, size=90, doc="doc_id", task_entries=entries, sorted_pairs=pairs)
        assert rows(text.co_occurrence_profile(folded)) == expected
        assert folded.rdd.getNumPartitions() > (1 if entries > 150 else 50)
        # No list is copied to a block through a shuffle.
        assert "Exchange" not in folded._jdf.queryExecution().executedPlan().toString()
