"""Word statistics of document collections, kept as long sparse rows (doc_id, idx, value)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarack.functions.numeric import ratio_or_zero
from tamarack.functions.text import NON_LETTERS, is_letters, kept_tokens, letter_words, space_tokens
from tamarack.operators.ordering import global_index, running_totals
from tamarack.staging import Stage, broadcast_if_bounded, parallelism, written

VOCABULARY_SIZE = 20_000
TASK_CHARS = 16_000_000  # characters of text whose words one task counts
MOST_TILE_TASKS = 100_000
BLOCK_ENTRIES = 200_000_000  # units of documents' words that a task holds, two bytes each
LOW_WORDS = 1 << 16  # the most frequent words, of which a document's list holds two bytes each
ROW_ENTRIES = 250_000  # words of documents in a row of their packed lists
DOCUMENT_UNITS = 8  # of a document, and of a word that it holds, beside the words' own
FOLDED_FIELDS = "w1 long, n_words long, n_docs long, top struct<n: bigint, w: bigint>, mark long"


def word_count(lines: DataFrame, *, text: str = "value") -> DataFrame:
    """(word, n) over letter-only tokens, lower-cased after the test."""
    tokens = lines.select(F.explode(space_tokens(F.col(text))).alias("_t"))
    return tokens.filter(is_letters(F.col("_t"))).groupBy(F.lower("_t").alias("word")).agg(F.count("*").alias("n"))


def bigram_count(lines: DataFrame, *, text: str = "value", min_exclusive: int = 20) -> DataFrame:
    """(w1, w2, n) of neighbouring kept tokens within a line, for n above the bound.

    The bound applies to the final count, never to partial counts.
    """
    kept = lines.select(kept_tokens(F.col(text)).alias("_t")).filter(F.size("_t") > 1)
    size = F.size("_t") - 1
    pairs = F.explode(F.arrays_zip(F.slice("_t", 1, size).alias("w1"), F.slice("_t", 2, size).alias("w2")))
    return (
        kept.select(pairs.alias("_p"))
        .groupBy(F.col("_p.w1").alias("w1"), F.col("_p.w2").alias("w2"))
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > min_exclusive)
    )


def by_document(docs: DataFrame, *, chars: int, doc: str = "doc_id", task_chars: int = TASK_CHARS) -> DataFrame:
    """Texts of ``chars`` characters in all, hashed by document to as many tasks as keep each one's counts small.

    A task counts (doc, idx) in memory and needs no further shuffle for it, so its share must not grow with the corpus; the
    splits of a scan, or a fixed number of tasks, would let it.
    """
    return docs.repartition(max(2 * parallelism(docs.sparkSession), -(-chars // task_chars)), doc)


def text_size(docs: DataFrame, *, text: str = "text") -> tuple[int, int]:
    """Number of documents, and of characters of their texts."""
    n, chars = docs.agg(F.count("*"), F.sum(F.length(text))).first()
    return n, chars or 0


def document_words(docs: DataFrame, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, word): one row per occurrence of a lower-cased run of letters."""
    return (
        docs.select(doc, F.explode(letter_words(F.col(text))).alias("word"))
        .filter(F.col("word") != "")
        .withColumn("word", F.lower("word"))
    )


def vocabulary(words: DataFrame, *, size: int = VOCABULARY_SIZE) -> DataFrame:
    """(word, idx, count): the ``size`` most frequent words, indexed by (count desc, word)."""
    counts = words.groupBy("word").agg(F.count("*").alias("count"))
    top = counts.orderBy(F.col("count").desc(), "word").limit(size)
    # At most ``size`` rows reach this window.
    rank = F.row_number().over(Window.orderBy(F.col("count").desc(), "word")) - 1
    return top.select("word", rank.cast("long").alias("idx"), "count")


def term_counts(words: DataFrame, vocab: DataFrame, *, size: int = VOCABULARY_SIZE, doc: str = "doc_id") -> DataFrame:
    """(doc, idx, n); words outside the vocabulary and documents without any of its words drop out."""
    known = words.join(broadcast_if_bounded(vocab.select("word", "idx"), size), "word")
    return known.groupBy(doc, "idx").agg(F.count("*").alias("n"))


def with_totals(counts: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """Add ``total``, the document's in-vocabulary tokens.

    A window holds one document's distinct vocabulary words, so at most the vocabulary size.
    """
    return counts.withColumn("total", F.sum("n").over(Window.partitionBy(doc)))


def term_frequency(totals: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """(doc, idx, tf): share among the document's in-vocabulary tokens."""
    return totals.select(doc, "idx", (F.col("n") / F.col("total")).alias("tf"))


def document_frequency(counts: DataFrame) -> DataFrame:
    """(idx, df): documents that contain the word."""
    return counts.groupBy("idx").agg(F.count("*").alias("df"))


def inverse_document_frequency(counts: DataFrame, n_docs: int) -> DataFrame:
    """(idx, idf): ln(N / df), not smoothed; N includes documents without vocabulary words."""
    return document_frequency(counts).select("idx", F.log(F.lit(float(n_docs)) / F.col("df")).alias("idf"))


def weigh(tf: DataFrame, idf: DataFrame, *, size: int = VOCABULARY_SIZE, doc: str = "doc_id") -> DataFrame:
    """(doc, idx, value): tf * idf; a word of every document keeps a row with value 0."""
    return tf.join(broadcast_if_bounded(idf, size), "idx").select(doc, "idx", (F.col("tf") * F.col("idf")).alias("value"))


def feature_moments(features: DataFrame, n_docs: int) -> DataFrame:
    """(idx, mean, std) over N documents whose absent entries are 0; population std.

    One pass: the non-zeros' mean and variance are merged with a block of N - nnz zeros.
    """
    stats = features.groupBy("idx").agg(
        F.count("*").cast("double").alias("_c"), F.avg("value").alias("_m"), F.var_pop("value").alias("_v")
    )
    n = F.lit(float(n_docs))
    share = F.col("_c") / n
    variance = share * F.col("_v") + share * (F.lit(1.0) - share) * F.col("_m") * F.col("_m")
    return stats.select("idx", (share * F.col("_m")).alias("mean"), F.sqrt(variance).alias("std"))


def standardised(features: DataFrame, moments: DataFrame, *, size: int = VOCABULARY_SIZE, doc: str = "doc_id") -> DataFrame:
    """(doc, idx, value): (x - mean) / std of the present entries, 0 where std is 0.

    An absent entry stands for -mean / std; see ``learning`` for how it is folded into scores.
    """
    z = ratio_or_zero(F.col("value") - F.col("mean"), F.col("std"))
    return features.join(broadcast_if_bounded(moments, size), "idx").select(doc, "idx", z.alias("value"))


class TermIndex:
    """A vocabulary fitted on a corpus, with that corpus's counts, both written once.

    Everything else derives from the small written tables, so the text is tokenised twice in all:
    for the vocabulary, then for the counts.
    """

    def __init__(
        self,
        docs: DataFrame,
        *,
        size: int = VOCABULARY_SIZE,
        doc: str = "doc_id",
        text: str = "text",
        measured: tuple[int, int] | None = None,
    ):
        """``measured``: the ``text_size`` of the documents, where it is known or cheaper to find than from ``docs``."""
        self.size, self.doc, self.text = size, doc, text
        words = document_words(docs, doc=doc, text=text)
        self.vocab = written(vocabulary(words, size=size), "vocabulary")
        self.n_docs, chars = measured or text_size(docs, text=text)
        laid = by_document(docs.select(doc, text), chars=chars, doc=doc)
        counts = with_totals(term_counts(document_words(laid, doc=doc, text=text), self.vocab, size=size, doc=doc), doc=doc)
        self._totals = written(counts, "term-counts")
        self.counts = self._totals.select(doc, "idx", "n")

    def tf(self) -> DataFrame:
        return term_frequency(self._totals, doc=self.doc)

    def idf(self) -> DataFrame:
        return inverse_document_frequency(self.counts, self.n_docs)

    def tf_idf(self) -> DataFrame:
        return weigh(self.tf(), self.idf(), size=self.size, doc=self.doc)

    def transform(self, docs: DataFrame, *, doc: str, text: str) -> DataFrame:
        """TF-IDF of other documents under this vocabulary and this corpus's idf."""
        laid = by_document(docs.select(doc, text), chars=text_size(docs, text=text)[1], doc=doc)
        counts = term_counts(document_words(laid, doc=doc, text=text), self.vocab, size=self.size, doc=doc)
        return weigh(term_frequency(with_totals(counts, doc=doc), doc=doc), self.idf(), size=self.size, doc=doc)

    def n_words(self) -> int:
        """Words in the vocabulary, fewer than ``size`` if the corpus has fewer."""
        return self.vocab.count()

    def n_present(self) -> int:
        """Documents with at least one vocabulary word."""
        return self.counts.select(self.doc).distinct().count()

    def moments(self) -> DataFrame:
        return feature_moments(self.tf_idf(), self.n_present())


def word_ranks(vocab: DataFrame, words: DataFrame) -> DataFrame:
    """(word, idx) of the given words that the vocabulary holds."""
    return vocab.join(words.select("word").distinct(), "word", "left_semi").select("word", "idx")


def pack_vectors(features: DataFrame, *, doc: str, value: str = "value") -> DataFrame:
    """(doc, idx ARRAY, val ARRAY), idx ascending; at most one entry per vocabulary word."""
    entries = F.sort_array(F.collect_list(F.struct("idx", F.col(value).alias("v"))))
    return (
        features.groupBy(doc)
        .agg(entries.alias("_e"))
        .select(doc, F.col("_e.idx").alias("idx"), F.col("_e.v").alias("val"))
    )


def indexed_words(words: DataFrame) -> DataFrame:
    """(word, idx, count) of all words, indexed by (count desc, word): ``vocabulary`` without a bound."""
    counts = words.groupBy("word").agg(F.count("*").alias("count"))
    return global_index(counts, [F.col("count").desc(), "word"], index="idx").select("word", "idx", "count")


def co_occurrence(
    presence: DataFrame,
    *,
    size: int,
    doc: str = "doc_id",
    tile_cells: int = 4_194_304,
    task_pairs: int = 50_000_000,
    folded: bool = False,
) -> DataFrame:
    """(w1, w2, n_docs): documents that hold both words, diagonal and both orders included.

    ``folded``: the same pairs, added up to the rows of ``co_occurrence_profile`` where they are found; see ``_folded``.

    ``presence`` has distinct (doc, idx) with idx in [0, size).  A sparse product by blocks of words: a document's words
    are cut into a list per block, its lists meet in pairs of blocks, and a task adds up one pair of blocks at a time in
    a tile of ``tile_cells`` counts, whatever the number of words.  A pair of words is emitted once by each task that
    holds its blocks.  Of how many tasks that are follows from the sums of squared list lengths, which bound a tile's
    pairs (Cauchy-Schwarz): tiles above ``task_pairs`` are dealt to several by document, and only theirs are summed again.
    """
    if folded:
        return _folded(presence, size=size, doc=doc)
    width = max(1, math.isqrt(tile_cells))
    spark = presence.sparkSession
    block = F.expr(f"cast(idx div {width} as int)")
    offset = F.expr(f"cast(idx % {width} as int)")
    lists = presence.groupBy(F.col(doc).alias("doc"), block.alias("block")).agg(F.collect_list(offset).alias("held"))
    lists = Stage(lists, "word-blocks")
    # One number per block, so at most size / width of them.
    length = F.size("held").cast("double")
    squares = {r["block"]: r["q"] for r in lists.df.groupBy("block").agg(F.sum(length * length).alias("q")).collect()}
    load = spark.createDataFrame([(b, math.sqrt(q)) for b, q in squares.items()], "block int, load double")
    weighed = lists.df.join(broadcast_if_bounded(load, -(-size // width)), "block")
    first = weighed.select("doc", F.col("block").alias("b1"), F.col("held").alias("held1"), F.col("load").alias("load1"))
    second = weighed.select("doc", F.col("block").alias("b2"), F.col("held").alias("held2"), F.col("load").alias("load2"))
    deals = F.ceil(F.col("load1") * F.col("load2") / task_pairs)
    met = (
        first.join(second, "doc")
        .filter(F.col("b1") <= F.col("b2"))
        .select("b1", "b2", F.pmod(F.xxhash64("doc"), deals).alias("deal"), (deals > 1).alias("dealt"), "held1", "held2")
    )
    tasks = sum(math.ceil(math.sqrt(p * q) / task_pairs) for i, p in squares.items() for j, q in squares.items() if i <= j)
    laid = met.repartition(min(max(tasks, 1), MOST_TILE_TASKS), "b1", "b2", "deal").sortWithinPartitions("b1", "b2", "deal")

    def multiply(batches):
        import numpy as np
        import pyarrow as pa

        tile = np.zeros(width * width, np.int32)

        def emit(b1, b2, dealt):
            cells = np.flatnonzero(tile)
            for at in range(0, len(cells), 100_000):
                here = cells[at : at + 100_000]
                w1, w2, n = here // width + b1 * width, here % width + b2 * width, tile[here].astype(np.int64)
                # Of a block with itself, the lower half is the upper one mirrored.
                up = w1 <= w2
                columns = [pa.array(c[up]) for c in (w1, w2, n)] + [pa.array(np.full(int(up.sum()), dealt))]
                yield pa.RecordBatch.from_arrays(columns, names=["w1", "w2", "n", "dealt"])
            tile[cells] = 0

        current = None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("b1", "b2", "deal", "dealt")), strict=True))
            one, two = batch.column("held1"), batch.column("held2")
            flat1, flat2 = (c.flatten().to_numpy(zero_copy_only=False) for c in (one, two))
            ends1, ends2 = (np.cumsum(c.value_lengths().to_numpy(zero_copy_only=False)) for c in (one, two))
            start1 = start2 = 0
            for key, end1, end2 in zip(keys, ends1.tolist(), ends2.tolist(), strict=True):
                if current is not None and key != current:
                    yield from emit(current[0], current[1], current[3])
                current = key
                # Words of a list are distinct, so no cell occurs twice.
                cells = (flat1[start1:end1, None] * width + flat2[start2:end2]).ravel()
                tile[cells] += 1
                start1, start2 = end1, end2
        if current is not None:
            yield from emit(current[0], current[1], current[3])

    cells = laid.mapInArrow(multiply, "w1 long, w2 long, n long, dealt boolean")
    if any(math.sqrt(p * q) > task_pairs for p in squares.values() for q in squares.values()):
        cells = Stage(cells, "word-pairs").df
        again = cells.filter("dealt").groupBy("w1", "w2").agg(F.sum("n").alias("n"))
        cells = cells.filter("NOT dealt").select("w1", "w2", "n").unionByName(again)
    pair, mirrored = F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w1").alias("w2"))
    both = F.when(F.col("w1") == F.col("w2"), F.array(pair)).otherwise(F.array(pair, mirrored))
    return cells.select(F.explode(both).alias("p"), F.col("n").alias("n_docs")).select("p.w1", "p.w2", "n_docs")


def _packed_lists(presence: DataFrame, doc: str) -> DataFrame:
    """Rows of some documents each, with their words: those below ``LOW_WORDS``, document by document, in two bytes, and the
    others in four.  ``units``: what the lists take in a task, in two bytes; ``load``: that of each word's documents, summed.
    """
    lists = presence.filter(F.col(doc).isNotNull()).groupBy(doc).agg(F.collect_list(F.col("idx").cast("int")).alias("words"))

    def pack(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            flat = batch.column(0).flatten().to_numpy()
            lengths = batch.column(0).value_lengths().to_numpy().astype(np.int64)
            ends = np.cumsum(lengths)
            part = (ends - lengths) // ROW_ENTRIES
            cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
            for first, last in zip(cuts, cuts[1:], strict=False):
                if first == last:
                    continue
                own = flat[ends[first] - lengths[first] : ends[last - 1]]
                low = own < LOW_WORDS
                of = np.repeat(np.arange(last - first), lengths[first:last])
                n_low = np.bincount(of[low], minlength=last - first)
                n_high = lengths[first:last] - n_low
                units = n_low + 2 * n_high + DOCUMENT_UNITS
                packed = [n_low.astype(np.int32), own[low].astype(np.uint16), n_high.astype(np.int32), own[~low].astype(np.int32)]
                sums = [pa.array([int(units.sum())]), pa.array([int((units * lengths[first:last]).sum())])]
                yield pa.RecordBatch.from_arrays(
                    [*sums, *(pa.array([x.tobytes()], pa.binary()) for x in packed)], names=["units", "load", "n_low", "low", "n_high", "high"]
                )

    return lists.select("words").mapInArrow(pack, "units long, load long, n_low binary, low binary, n_high binary, high binary")


def _unpacked(batch):
    """(n_low, low, n_high, high) of each row of ``_packed_lists``."""
    import numpy as np

    kinds = {"n_low": np.int32, "low": np.uint16, "n_high": np.int32, "high": np.int32}
    columns = [batch.column(batch.schema.get_field_index(c)) for c in kinds]
    for i in range(batch.num_rows):
        yield [np.frombuffer(c[i].as_buffer(), kind) for c, kind in zip(columns, kinds.values(), strict=True)]


def _word_loads(lists: DataFrame) -> DataFrame:
    """(idx, load, df) of the words of ``_packed_lists``: the units of a word's documents, and their number."""

    def count(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            words, units = [], []
            for n_low, low, n_high, high in _unpacked(batch):
                own = n_low.astype(np.int64) + 2 * n_high + DOCUMENT_UNITS
                words += [low.astype(np.int32), high]
                units += [np.repeat(own, n_low), np.repeat(own, n_high)]
            word = np.concatenate(words)
            order = np.argsort(word, kind="stable")
            word, unit = word[order], np.concatenate(units)[order]
            if not len(word):
                continue
            at = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            columns = [word[at].astype(np.int64), np.add.reduceat(unit, at), np.diff(np.r_[at, len(word)]).astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["idx", "load", "df"])

    counted = lists.select("n_low", "low", "n_high", "high").mapInArrow(count, "idx long, load long, df long")
    return counted.groupBy("idx").agg(F.sum("load").alias("load"), F.sum("df").alias("df"))


def _folded(
    presence: DataFrame, *, size: int, doc: str, task_entries: int = BLOCK_ENTRIES, sorted_pairs: int = 2_000_000
) -> DataFrame:
    """A row per word, (w1, n_words, n_docs, top, mark), of all its pairs, none of which leaves the task that counts it.

    A word's pairs are the words of all its documents.  Words are cut into blocks of about equal numbers of those, and the task of
    a block reads the lists of all documents where they are written, and keeps those that hold a word of its block: nothing is
    copied on disk, whatever the number of blocks.  It then counts one word after the other, a frequent one in an array over all
    words, rare ones by sorting ``sorted_pairs`` pairs at a time.  It keeps the documents of one block, at most some 2
    ``task_entries`` units; a word whose documents have more than a block's is counted as they pass, and none of them is kept.
    """
    spark = presence.sparkSession
    lists = Stage(_packed_lists(presence, doc), "word-lists", {"units": F.sum("units"), "load": F.sum("load")})
    units, load = lists.sums["units"] or 0, lists.sums["load"] or 0
    if not units:
        return spark.createDataFrame([], FOLDED_FIELDS)
    # While all lists fit a task, blocks serve the cores; above that, they bound what a task keeps: lists, and who holds a word.
    share = max(1, -(-load // (4 * parallelism(spark))) if units <= task_entries else task_entries)
    entered = F.ceil(F.col("df") * (DOCUMENT_UNITS * share / task_entries))
    weight = F.least(F.greatest("load", entered), F.lit(share))
    weighed = _word_loads(lists.df).select("idx", (F.col("load") > share).alias("passing"), weight.alias("weight"))
    totals = running_totals(weighed, ["idx"], {"upto": "weight"})
    block = F.floor((F.col("upto") - F.col("weight")) / share).alias("block")
    # A row per block. In each is one word at most that is counted as its documents pass, as it weighs a whole share.
    bounds = totals.groupBy(block).agg(F.min("idx").alias("first"), F.max(F.when(F.col("passing"), F.col("idx"))).alias("passing"))
    bounds = sorted((r["first"], -1 if r["passing"] is None else r["passing"]) for r in bounds.collect())
    firsts, passing = [b[0] for b in bounds] + [size], [b[1] for b in bounds]

    def fold(batches):
        import numpy as np
        import pyarrow as pa

        def rows(word, w1, w2, n):
            """The row of each word, of pairs that are sorted by ``w1``; ``word``: the distinct ones."""
            at = np.flatnonzero(np.r_[True, w1[1:] != w1[:-1]])
            best = np.maximum.reduceat(np.where(w1 == w2, -1, n * size + (size - 1 - w2)), at)
            other = best < 0
            columns = [
                pa.array(word),
                pa.array(np.diff(np.r_[at, len(w1)]).astype(np.int64)),
                pa.array(np.add.reduceat(n, at)),
                pa.StructArray.from_arrays(
                    [pa.array(best // size, mask=other), pa.array(best % size - size + 1, mask=other)], names=["n", "w"], mask=pa.array(other)
                ),
                pa.array(np.add.reduceat(n * (w2 % 1009 + 1), at)),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["w1", "n_words", "n_docs", "top", "mark"])

        def counted(word, counts):
            w2 = np.flatnonzero(counts)
            return rows(np.array([word], np.int64), np.full(len(w2), word, np.int64), w2, counts[w2].astype(np.int64))

        def joined(parts, kind):
            """One array of many, which go as they are copied."""
            out, at = np.empty(sum(map(len, parts)), kind), 0
            parts.reverse()
            while parts:
                part = parts.pop()
                out[at : at + len(part)] = part
                at += len(part)
            return out

        def gathered(flat, starts, lengths, rows):
            """The lists of ``rows``, one after the other."""
            n = lengths[rows]
            return flat[np.repeat(starts[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())]

        class Block:
            def __init__(self, block):
                self.first, self.last, self.passing = firsts[block], firsts[block + 1], passing[block]
                self.counts, self.waiting = None, []
                self.n, self.word, self.row = 0, [], []
                self.n_low, self.low, self.n_high, self.high = [], [], [], []

            def add_waiting(self):
                if self.waiting:
                    self.counts += np.bincount(np.concatenate(self.waiting), minlength=size)
                    self.waiting = []

            def pass_by(self, docs, n_low, low, n_high, high):
                if self.counts is None:
                    self.counts = np.zeros(size, np.int64)
                own = np.bincount(low[np.repeat(docs, n_low)])
                self.counts[: len(own)] += own
                self.waiting.append(high[np.repeat(docs, n_high)])
                if sum(map(len, self.waiting)) > size:
                    self.add_waiting()

            def take(self, n_low, low, n_high, high):
                found_low = np.flatnonzero((low >= self.first) & (low <= min(self.last, LOW_WORDS) - 1)) if self.first < LOW_WORDS else np.zeros(0, int)
                found_high = np.flatnonzero((high >= self.first) & (high < self.last)) if self.last > LOW_WORDS else np.zeros(0, int)
                word = np.concatenate([low[found_low].astype(np.int32), high[found_high]])
                if not len(word):
                    return
                row = np.concatenate([np.searchsorted(np.cumsum(n), at, side="right") for n, at in ((n_low, found_low), (n_high, found_high))])
                passes = word == self.passing
                docs = np.zeros(len(n_low), bool)
                if passes.any():
                    docs[row[passes]] = True
                    self.pass_by(docs, n_low, low, n_high, high)
                    word, row = word[~passes], row[~passes]
                    docs[:] = False
                docs[row] = True
                self.word.append(word)
                self.row.append((np.cumsum(docs) - 1)[row] + self.n)
                self.n += int(docs.sum())
                for held, x in ((self.n_low, n_low[docs]), (self.low, low[np.repeat(docs, n_low)]), (self.n_high, n_high[docs]), (self.high, high[np.repeat(docs, n_high)])):
                    held.append(x)

            def finished(self):
                if self.counts is not None:
                    self.add_waiting()
                    yield counted(self.passing, self.counts)
                    self.counts = None
                if not self.n:
                    return
                word, row = joined(self.word, np.int32), joined(self.row, np.int32)
                low, high = joined(self.low, np.uint16), joined(self.high, np.int32)
                n_low, n_high = joined(self.n_low, np.int64), joined(self.n_high, np.int64)
                from_low, from_high = np.cumsum(n_low) - n_low, np.cumsum(n_high) - n_high
                order = np.argsort(word, kind="stable")
                word, row = word[order], row[order]
                del order
                at = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
                names, ends = word[at].astype(np.int64), np.r_[at[1:], len(word)]
                loads = np.add.reduceat((n_low + n_high)[row], at)
                # Words of many pairs alone; of others as many as are sorted at a time, and no more than 32 bits tell apart.
                many = loads > size // 8
                weights = np.where(many, 0, np.maximum(loads, sorted_pairs // max(1, (1 << 32) // size) + 1))
                group = (np.cumsum(weights) - weights) // sorted_pairs
                fresh = np.r_[True, (group[1:] != group[:-1]) | many[1:] | many[:-1]]
                cuts = [*np.flatnonzero(fresh).tolist(), len(names)]
                for i, j in zip(cuts, cuts[1:], strict=False):
                    own = row[at[i] : ends[j - 1]]
                    if many[i]:
                        counts = np.zeros(size, np.int64)
                        step = max(1, len(own) * sorted_pairs // int(loads[i]))
                        for k in range(0, len(own), step):
                            some = own[k : k + step]
                            n = np.bincount(gathered(low, from_low, n_low, some))
                            counts[: len(n)] += n
                        # An array over all words for each step would take longer than the pairs.
                        step = max(1, len(own) * max(sorted_pairs, size) // int(loads[i]))
                        for k in range(0, len(own), step):
                            some = gathered(high, from_high, n_high, own[k : k + step])
                            if len(some):
                                counts += np.bincount(some, minlength=size)
                        yield counted(names[i], counts)
                        continue
                    span = (j - i) * size
                    kind = np.uint32 if span < 1 << 32 else np.int64
                    first = np.repeat(np.arange(j - i, dtype=np.int64) * size, ends[i:j] - at[i:j]).astype(kind)
                    keys = np.concatenate([
                        np.repeat(first, n[own]) + gathered(flat, starts, n, own).astype(kind)
                        for flat, starts, n in ((low, from_low, n_low), (high, from_high, n_high))
                    ])
                    keys.sort()
                    pair = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                    n, keys = np.diff(np.r_[pair, len(keys)]), keys[pair].astype(np.int64)
                    yield rows(names[i:j], names[i:j][keys // size], keys % size, n)

        blocks = {}
        for batch in batches:
            for block, lists in zip(batch.column(batch.schema.get_field_index("block")).to_pylist(), _unpacked(batch), strict=True):
                if block not in blocks:
                    blocks[block] = Block(block)
                blocks[block].take(*lists)
        for block in list(blocks):
            yield from blocks.pop(block).finished()

    # All lists as one partition, which each task reads anew; on the other side a partition per block.
    numbers = spark.range(0, len(passing), 1, len(passing)).select(F.col("id").cast("int").alias("block"))
    read = lists.df.select("n_low", "low", "n_high", "high").coalesce(1)
    return read.hint("shuffle_replicate_nl").crossJoin(numbers).mapInArrow(fold, FOLDED_FIELDS)


def co_occurrence_profile(pairs: DataFrame) -> DataFrame:
    """(w1, n_words, n_docs, most, partner, mark) of each word's pairs: how many words it meets, in how many documents in all
    and at most, the first other word that it meets most often, and a sum over all its pairs that tells them apart.

    ``pairs`` may come folded, as sums of some or all of a word's pairs.
    """
    if "mark" not in pairs.columns:
        other = F.when(F.col("w1") != F.col("w2"), F.struct(F.col("n_docs").alias("n"), (-F.col("w2")).alias("w")))
        mark = F.col("n_docs") * (F.col("w2") % 1009 + 1)
        pairs = pairs.select("w1", F.lit(1).alias("n_words"), "n_docs", other.alias("top"), mark.alias("mark"))
    profile = pairs.groupBy("w1").agg(
        F.sum("n_words").alias("n_words"), F.sum("n_docs").alias("sum_docs"), F.max("top").alias("top"), F.sum("mark").alias("mark")
    )
    return profile.select("w1", "n_words", F.col("sum_docs").alias("n_docs"), F.col("top.n").alias("most"), (-F.col("top.w")).alias("partner"), "mark")
