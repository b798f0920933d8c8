"""Training and scoring queries.

Texts are classified by a marker in their source from standardised TF-IDF; embeddings by the half of
the label range they are in.  Both descents run to their tolerance.  Loss and gradient at given weights have
SQL; hundreds of steps over all words are too slow in it, so the queries named in ``FITTED`` have none, and are
held against a brute-force fit in ``tests/test_fitted.py``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.functions import vectors as vec
from tamarack.functions.hashing import sample_key
from tamarack.functions.numeric import hinge, sigmoid, softplus
from tamarack.functions.text import contains_flag
from tamarack.operators import learning, metrics, models, sampling
from tamarack.operators.text import TermIndex
from tamarack.plans import text as texts
from tamarack.plans.registry import registry
from tamarack.sources.tables import table
from tamarack.staging import Stage, spread, written

QUERIES, ORACLES, register = registry()

MARKER = "src1"
WORDS = texts.VOCABULARY
FITTED = (
    "logistic_descent logistic_losses logistic_warm_start indicative_words threshold_scores classification_metrics "
    "false_positives unseen_metrics"
).split()
TOLERANCE = 1e-5
REG = 0.5
CUTOFF = 0.06
SAMPLE_SEED = 11
SAMPLE_FRACTION = 0.3
DIMS = 64
SVM_STEPS = 80  # that the SQL is unrolled to; it stands still once settled
SVM_TOLERANCE = 1e-3
SVM_C = 1.0


def fixed_weights(size: int) -> np.ndarray:
    """Given weights, for evaluating a loss and its gradient at a known place."""
    return np.array([(i * 37 % 101 - 50) / 1000.0 for i in range(size)])


class TextTask:
    """Rows and scaling of the task whether a document's source contains the marker."""

    def __init__(self, spark: SparkSession, sf: str, docs: DataFrame | None = None):
        self.index: TermIndex = texts.index(spark, sf, WORDS) if docs is None else TermIndex(docs, size=WORDS)
        self.size = self.index.n_words()
        self.features = self.index.tf_idf()
        self.labels = texts.documents(spark, sf).select("doc_id", contains_flag(F.col("source"), MARKER).alias("label"))
        self.rows = learning.sparse_rows(self.features, self.labels).df
        self.scaler = learning.Standardiser.from_moments(self.index.moments(), self.size)

    def fit(self) -> learning.Fit:
        return learning.train_logistic(self.rows, size=self.size, scaler=self.scaler, tolerance=TOLERANCE)

    def predictions(self, spark: SparkSession) -> DataFrame:
        weights, offset = learning.standardised_weights(spark, self.fit().weights, self.scaler)
        scores = learning.sparse_scores(self.features, weights, size=self.size, offset=offset)
        return learning.predict_above(scores, cutoff=CUTOFF).join(self.labels, "doc_id")


_TASK = f"""{texts.moments_sql(WORDS)},
    docs AS MATERIALIZED (
        SELECT doc_id, CASE WHEN contains(source, '{MARKER}') THEN 1 ELSE 0 END AS y FROM documents
        WHERE doc_id IN (SELECT doc_id FROM counts)),
    scale AS MATERIALIZED (SELECT idx, mean, CASE WHEN std = 0 THEN 0 ELSE 1 / std END AS inv FROM moments)
"""

_COPIES_ALL = "SELECT doc_id, y, 1 AS copies FROM docs"


def _descent_sql(prefix: str, rows: str, start: str, steps: int) -> str:
    """Unrolled descent: weights {prefix}w0..n, losses {prefix}l0..n."""
    parts = [
        f"{prefix}rows AS MATERIALIZED ({rows})",
        f"{prefix}n AS (SELECT SUM(copies)::DOUBLE AS n FROM {prefix}rows)",
        f"{prefix}w0 AS MATERIALIZED ({start})",
    ]
    for i in range(steps + 1):
        parts.append(
            f"""{prefix}t{i} AS MATERIALIZED (
            SELECT r.doc_id, r.y, r.copies, SUM(x.value * m.inv * w.weight)
                   - (SELECT SUM(m.mean * m.inv * w.weight) FROM scale m JOIN {prefix}w{i} w ON w.idx = m.idx) AS theta
            FROM {prefix}rows r JOIN tfidf x ON x.doc_id = r.doc_id JOIN {prefix}w{i} w ON w.idx = x.idx
            JOIN scale m ON m.idx = x.idx GROUP BY 1, 2, 3)"""
        )
        parts.append(
            f"""{prefix}l{i} AS MATERIALIZED (
            SELECT SUM(copies * (greatest(theta, 0) + ln(1 + exp(-abs(theta))) - y * theta)) / (SELECT n FROM {prefix}n) AS loss
            FROM {prefix}t{i})"""
        )
        if i == steps:
            break
        rate = "0.1::DOUBLE" if i == 0 else (
            f"(SELECT rate FROM {prefix}a{i - 1}) * CASE WHEN (SELECT loss FROM {prefix}l{i}) > (SELECT loss FROM {prefix}l{i - 1})"
            " THEN 0.5::DOUBLE ELSE 1.1::DOUBLE END"
        )
        parts.append(f"{prefix}a{i} AS MATERIALIZED (SELECT {rate} AS rate)")
        parts.append(
            f"{prefix}e{i} AS MATERIALIZED (SELECT doc_id, copies * (1 / (1 + exp(-theta)) - y) AS e FROM {prefix}t{i})"
        )
        parts.append(
            f"""{prefix}g{i} AS MATERIALIZED (
            SELECT m.idx, (COALESCE(h.s, 0) - m.mean * (SELECT SUM(e) FROM {prefix}e{i})) * m.inv / (SELECT n FROM {prefix}n) AS g
            FROM scale m LEFT JOIN (
                SELECT x.idx, SUM(e.e * x.value) AS s FROM {prefix}e{i} e JOIN tfidf x ON x.doc_id = e.doc_id GROUP BY 1
            ) h ON h.idx = m.idx)"""
        )
        parts.append(
            f"""{prefix}w{i + 1} AS MATERIALIZED (
            SELECT w.idx, w.weight - (SELECT rate FROM {prefix}a{i}) * g.g AS weight
            FROM {prefix}w{i} w JOIN {prefix}g{i} g ON g.idx = w.idx)"""
        )
    return ",\n".join(parts)


_FIXED = "SELECT idx, ((idx * 37) % 101 - 50) / 1000.0::DOUBLE AS weight FROM moments"


@register(
    "logistic_loss",
    f"WITH {_TASK}, {_descent_sql('', _COPIES_ALL, _FIXED, 0)} SELECT ROUND(loss, 9) AS loss FROM l0",
)
def logistic_loss(spark: SparkSession, sf: str) -> DataFrame:
    """Mean logistic loss at given weights, from scores as columns."""
    task = TextTask(spark, sf)
    weights, offset = learning.standardised_weights(spark, fixed_weights(task.size), task.scaler)
    scores = learning.sparse_scores(task.features, weights, size=task.size, offset=offset).join(task.labels, "doc_id")
    theta = F.col("score")
    return scores.agg(F.round(F.avg(softplus(theta) - F.col("label") * theta), 9).alias("loss"))


@register(
    "logistic_probabilities",
    f"""
    WITH {_TASK}, {_descent_sql('', _COPIES_ALL, _FIXED, 0)}
    SELECT doc_id, ROUND(1 / (1 + exp(-theta)), 9) AS p FROM t0
    """,
)
def logistic_probabilities(spark: SparkSession, sf: str) -> DataFrame:
    task = TextTask(spark, sf)
    weights, offset = learning.standardised_weights(spark, fixed_weights(task.size), task.scaler)
    scores = learning.sparse_scores(task.features, weights, size=task.size, offset=offset)
    return scores.select("doc_id", F.round(sigmoid(F.col("score")), 9).alias("p"))


@register(
    "logistic_gradient",
    f"WITH {_TASK}, {_descent_sql('', _COPIES_ALL, _FIXED, 1)} SELECT idx, ROUND(g, 9) AS gradient FROM g0",
)
def logistic_gradient(spark: SparkSession, sf: str) -> DataFrame:
    task = TextTask(spark, sf)
    _, gradient = learning.logistic_pass(task.rows, fixed_weights(task.size), task.scaler, 0.0)
    return learning.weight_table(spark, gradient).select("idx", F.round("weight", 9).alias("gradient"))


@register(
    "regularised_loss",
    f"""
    WITH {_TASK}, {_descent_sql('', _COPIES_ALL, _FIXED, 0)}
    SELECT ROUND(loss + {REG} * (SELECT SUM(weight * weight) FROM w0) / (SELECT n FROM n), 9) AS loss FROM l0
    """,
)
def regularised_loss(spark: SparkSession, sf: str) -> DataFrame:
    task = TextTask(spark, sf)
    loss, _ = learning.logistic_pass(task.rows, fixed_weights(task.size), task.scaler, REG)
    return spark.createDataFrame([(loss,)], "loss double").select(F.round("loss", 9).alias("loss"))


@register(
    "regularised_gradient",
    f"""
    WITH {_TASK}, {_descent_sql('', _COPIES_ALL, _FIXED, 1)}
    SELECT g0.idx, ROUND(g + 2 * {REG} * weight / (SELECT n FROM n), 9) AS gradient FROM g0 JOIN w0 ON w0.idx = g0.idx
    """,
)
def regularised_gradient(spark: SparkSession, sf: str) -> DataFrame:
    task = TextTask(spark, sf)
    _, gradient = learning.logistic_pass(task.rows, fixed_weights(task.size), task.scaler, REG)
    return learning.weight_table(spark, gradient).select("idx", F.round("weight", 9).alias("gradient"))


@register("logistic_descent")
def logistic_descent(spark: SparkSession, sf: str) -> DataFrame:
    return TextTask(spark, sf).fit().table(spark).withColumn("weight", F.round("weight", 9))


@register("logistic_losses")
def logistic_losses(spark: SparkSession, sf: str) -> DataFrame:
    """Loss before the first step and after each one."""
    losses = [(i, loss) for i, loss in enumerate(TextTask(spark, sf).fit().losses)]
    return spark.createDataFrame(losses, "step long, loss double").withColumn("loss", F.round("loss", 9))


def poisson_copies_sql(key: str) -> str:
    u = f"CAST(('0x' || substr(md5(concat_ws('|', '{SAMPLE_SEED}', {key})), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE"
    return " + ".join(f"CASE WHEN {t!r}::DOUBLE <= {u} THEN 1 ELSE 0 END" for t in sampling.poisson_steps(SAMPLE_FRACTION))


@register("logistic_warm_start")
def logistic_warm_start(spark: SparkSession, sf: str) -> DataFrame:
    """Weights found on a sample with replacement, then improved on everything."""
    task = TextTask(spark, sf)
    sample = sampling.poisson_sample(task.rows, ids=["doc_id"], fraction=SAMPLE_FRACTION, seed=SAMPLE_SEED)
    fit = learning.train_logistic_warm(task.rows, sample, size=task.size, scaler=task.scaler, tolerance=TOLERANCE)
    return fit.table(spark).withColumn("weight", F.round("weight", 9))


@register("indicative_words")
def indicative_words(spark: SparkSession, sf: str) -> DataFrame:
    task = TextTask(spark, sf)
    weights = task.fit().table(spark).withColumn("weight", F.round("weight", 9))
    return learning.indicative_words(weights, task.index.vocab, n=50)


@register("threshold_scores")
def threshold_scores(spark: SparkSession, sf: str) -> DataFrame:
    return TextTask(spark, sf).predictions(spark).select(
        "doc_id", F.round("score", 7).alias("score"), F.col("predicted").cast("long").alias("predicted")
    )


def _metrics_sql(rows: str, actual: str, predicted: str, correct: str) -> str:
    return f"""
    tally AS (
        SELECT COUNT(*)::DOUBLE AS n, SUM(CASE WHEN {correct} THEN 1 ELSE 0 END)::DOUBLE AS n_correct,
               SUM(CASE WHEN {actual} AND {predicted} THEN 1 ELSE 0 END)::DOUBLE AS tp,
               SUM(CASE WHEN {actual} THEN 1 ELSE 0 END)::DOUBLE AS actual,
               SUM(CASE WHEN {predicted} THEN 1 ELSE 0 END)::DOUBLE AS predicted
        FROM {rows}),
    rated AS (
        SELECT n, n_correct, n_correct / n AS accuracy, tp / nullif(predicted, 0) AS precision, tp / nullif(actual, 0) AS recall
        FROM tally)
    SELECT n, n_correct, ROUND(accuracy, 9) AS accuracy, ROUND(precision, 9) AS precision, ROUND(recall, 9) AS recall,
           ROUND(2 * precision * recall / nullif(precision + recall, 0), 9) AS f1
    FROM rated
    """


def _rounded(m: DataFrame) -> DataFrame:
    return m.select("n", "n_correct", *[F.round(c, 9).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@register("classification_metrics")
def classification_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.flag_metrics(TextTask(spark, sf).predictions(spark)))


@register("false_positives")
def false_positives(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.false_positives(TextTask(spark, sf).predictions(spark), identity="doc_id")


def unseen(doc: str = "doc_id") -> Column:
    """One document in five, by a hash of its id."""
    return sample_key(SAMPLE_SEED, F.col(doc)) % 5 == 0


@register("unseen_metrics")
def unseen_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of texts that neither vocabulary, idf and moments nor weights were fitted on, by the model as written."""
    docs = texts.documents(spark, sf)
    task = TextTask(spark, sf, docs.filter(~unseen()))
    model = Stage(models.model_table(task.index, task.fit().weights), "text-model")
    scores = models.score_texts(model.df, docs.filter(unseen()), size=WORDS)
    return _rounded(metrics.flag_metrics(learning.predict_above(scores, cutoff=CUTOFF).join(task.labels, "doc_id")))


def svm_rows(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "embeddings"), "vec_id").select(
        "vec_id", F.when(F.col("label") < 5, 1).otherwise(-1).alias("label"), vec.as_doubles(F.col("embedding")).alias("features")
    )


_SVM = f"""
    cells AS MATERIALIZED (
        SELECT vec_id, CASE WHEN label < 5 THEN 1 ELSE -1 END AS y,
               unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(0, len(embedding))) AS pos FROM embeddings),
    total AS (SELECT COUNT(*)::DOUBLE AS n FROM embeddings)
"""


def _svm_sql(start: str, steps: int) -> str:
    parts = [f"w0 AS MATERIALIZED ({start})"]
    penalty = f"1.0::DOUBLE / ((SELECT n FROM total) * {SVM_C})"
    for i in range(steps + 1):
        parts.append(
            f"""s{i} AS MATERIALIZED (
            SELECT c.vec_id, c.y, SUM(c.x * w.weight) AS score FROM cells c JOIN w{i} w ON w.pos = c.pos GROUP BY 1, 2)"""
        )
        parts.append(
            f"""l{i} AS MATERIALIZED (
            SELECT (SELECT SUM(weight * weight) FROM w{i}) * {penalty} / 2
                   + (SELECT AVG(greatest(0, 1 - y * score)) FROM s{i}) AS loss)"""
        )
        if i == steps:
            break
        rate = "1.0::DOUBLE" if i == 0 else (
            f"(SELECT rate FROM a{i - 1}) * (SELECT CASE WHEN abs(b.loss - a.loss) <= {SVM_TOLERANCE} THEN 0"
            f" WHEN b.loss > a.loss THEN 0.5::DOUBLE ELSE 1.1::DOUBLE END FROM l{i - 1} a, l{i} b)"
        )
        parts.append(f"a{i} AS MATERIALIZED (SELECT {rate} AS rate)")
        parts.append(
            f"""g{i} AS MATERIALIZED (
            SELECT w.pos, w.weight * {penalty} - COALESCE(h.s, 0) / (SELECT n FROM total) AS g FROM w{i} w LEFT JOIN (
                SELECT c.pos, SUM(c.y * c.x) AS s FROM cells c JOIN s{i} s ON s.vec_id = c.vec_id
                WHERE 1 - s.y * s.score >= 0 GROUP BY 1) h ON h.pos = w.pos)"""
        )
        parts.append(
            f"w{i + 1} AS MATERIALIZED (SELECT w.pos, w.weight - (SELECT rate FROM a{i}) * g.g AS weight FROM w{i} w JOIN g{i} g ON g.pos = w.pos)"
        )
    return ",\n".join(parts)


_SVM_FIXED = f"SELECT range AS pos, ((range * 37) % 101 - 50) / 1000.0::DOUBLE AS weight FROM range({DIMS})"
_SVM_ZERO = f"SELECT range AS pos, 0.0::DOUBLE AS weight FROM range({DIMS})"


@register("hinge_loss", f"WITH {_SVM}, {_svm_sql(_SVM_FIXED, 0)} SELECT ROUND(loss, 9) AS loss FROM l0")
def hinge_loss(spark: SparkSession, sf: str) -> DataFrame:
    """Regularised hinge loss at given weights, as column expressions."""
    weights = fixed_weights(DIMS)
    w = F.array(*[F.lit(float(x)) for x in weights])
    rows = svm_rows(spark, sf)
    penalty = F.lit(float(weights @ weights) / 2.0 / SVM_C) / F.count("*")
    mean = F.avg(hinge(F.col("label"), vec.dot(F.col("features"), w)))
    return rows.agg(F.round(penalty + mean, 9).alias("loss"))


@register(
    "hinge_gradient", f"WITH {_SVM}, {_svm_sql(_SVM_FIXED, 1)} SELECT pos AS idx, ROUND(g, 9) AS gradient FROM g0"
)
def hinge_gradient(spark: SparkSession, sf: str) -> DataFrame:
    _, gradient = learning.hinge_pass(svm_rows(spark, sf), fixed_weights(DIMS), SVM_C)
    return learning.weight_table(spark, gradient).select("idx", F.round("weight", 9).alias("gradient"))


def _svm_fit(spark: SparkSession, sf: str) -> learning.Fit:
    # Every step reads the rows again, so they are laid out once.
    rows = written(svm_rows(spark, sf), "svm-rows")
    return learning.train_svm(rows, size=DIMS, c=SVM_C, tolerance=SVM_TOLERANCE)


@register(
    "svm_descent",
    f"WITH {_SVM}, {_svm_sql(_SVM_ZERO, SVM_STEPS)} SELECT pos AS idx, ROUND(weight, 9) AS weight FROM w{SVM_STEPS}",
)
def svm_descent(spark: SparkSession, sf: str) -> DataFrame:
    return _svm_fit(spark, sf).table(spark).withColumn("weight", F.round("weight", 9))


def svm_scores(spark: SparkSession, sf: str) -> DataFrame:
    w = F.array(*[F.lit(float(x)) for x in _svm_fit(spark, sf).weights])
    return svm_rows(spark, sf).select("vec_id", "label", vec.dot(F.col("features"), w).alias("score"))


@register(
    "svm_outcomes",
    f"""
    WITH {_SVM}, {_svm_sql(_SVM_ZERO, SVM_STEPS)}
    SELECT vec_id, ROUND(score, 9) AS score, CASE WHEN score * y > 0 THEN 'success' ELSE 'failure' END AS outcome
    FROM s{SVM_STEPS}
    """,
)
def svm_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Success or failure of every row."""
    right = F.col("score") * F.col("label") > 0
    return svm_scores(spark, sf).select(
        "vec_id", F.round("score", 9).alias("score"), F.when(right, "success").otherwise("failure").alias("outcome")
    )


@register(
    "svm_metrics",
    f"WITH {_SVM}, {_svm_sql(_SVM_ZERO, SVM_STEPS)}, {_metrics_sql(f's{SVM_STEPS}', 'y > 0', 'score > 0', 'score * y > 0')}",
)
def svm_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.margin_metrics(svm_scores(spark, sf)))


def _em_sql(steps: int) -> str:
    parts = [
        """obs AS MATERIALIZED (
        SELECT user_id, COUNT(*) AS n, SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS k FROM events GROUP BY 1)""",
        "p0 AS (SELECT 0.79::DOUBLE AS p1, 0.51::DOUBLE AS p2)",
    ]
    for i in range(1, steps + 1):
        parts.append(
            f"""p{i} AS MATERIALIZED (
            SELECT SUM(r * k) / SUM(r * n) AS p1, SUM((1 - r) * k) / SUM((1 - r) * n) AS p2 FROM (
                SELECT k, n, 1 / (1 + exp(-least(greatest(k * (ln(p1) - ln(p2)) + (n - k) * (ln(1 - p1) - ln(1 - p2)), -700), 700))) AS r
                FROM obs CROSS JOIN p{i - 1}))"""
        )
    rows = " UNION ALL ".join(
        f"SELECT {i}::BIGINT AS step, ROUND(p1, 9) AS p1, ROUND(p2, 9) AS p2 FROM p{i}" for i in range(1, steps + 1)
    )
    return "WITH " + ",\n".join(parts) + " " + rows


@register("em_binomial", _em_sql(20))
def em_binomial(spark: SparkSession, sf: str) -> DataFrame:
    """Two kinds of users by their share of purchases."""
    bought = F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0))
    users = table(spark, sf, "events").groupBy("user_id").agg(F.count("*").alias("n"), bought.alias("k"))
    trace = learning.em_binomial(users)
    return trace.select("step", F.round("p1", 9).alias("p1"), F.round("p2", 9).alias("p2"))
