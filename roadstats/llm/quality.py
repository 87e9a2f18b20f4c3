"""Quality classifier: ordinal cumulative-link regression over hashed text.

A document has a grade 0 .. K-1. One weight vector over hashed features gives f(x); ordered
thresholds t_1 < ... < t_{K-1} cut it: P(grade >= k) = sigmoid(f(x) - t_k). All grades share the
weights. From these come the expected grade and the tail probability that selects documents.

Features are the shares of lower-cased words, of raw byte trigrams (which carry case and
symbols) and of words that repeat the one before them, each hashed to ``FEATURES`` slots. Ratings come from ``labels``: grade 0 is quality 0,
grade 1 quality 1 but marked toxic, grade 2 quality 1 and not marked toxic (see ``grade``); any
column of grades can be used instead.

The fit is maximum likelihood with an L2 penalty (L-BFGS) on a bounded sample: labelled rows in the
order of their ids' hashes, at most ``FIT_ROWS`` of them with at most ``FIT_BYTES`` of text in all (a
longer text is not fitted). One task fits, and the driver gets the weights alone. Fold 2 of
the ids (see ``folds.fold``) is held out. Scoring covers every row, whole texts.

Defined results: null and empty texts have no features and score f = 0. Repeated rows score
alike; a repeated id is fitted once. With fewer than two grades among the rated rows nothing can
be learnt: every tail probability is 1 and the expected grade the one seen (or null). Null ids
and grades are not fitted. An empty table gives no rows. ``select_documents`` keeps all columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadstats.llm.fitting import minimise
from roadstats.llm.folds import fold, free_name
from roadstats.llm.words import mix, row_means, split_words, text_bytes
from roadstats.session import new_work_dir

FEATURES = 1 << 18
FIT_ROWS, FIT_BYTES = 8192, 32 << 20
GRADES = 3
PENALTY = 1e-5
#: Shares are small numbers; this scale lets the penalty leave useful weights.
SCALE = 20.0
_TRIGRAMS, _WORDS = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
#: Slots of a word that repeats the one before it and of one that does not.
_REPEATS = (1, 2)


def grade(quality: Column, toxic: Column) -> Column:
    """Grade of a labelled row: 0, 1 or 2; null without a quality label."""
    return F.when(quality == 0, 0).when(F.coalesce(toxic, F.lit(0)) > 0, 1).when(quality > 0, 2)


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(FEATURES - 1)).astype(np.int64)


def features(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, trigram slots, trigrams by row, word slots, repetition slots, words by row) of
    whole rows."""
    raw, offs = text_bytes(column)
    for group in split_words(column):
        lo, hi = group.first, group.first + len(group.counts)
        text = raw[offs[lo] : offs[hi]].astype(np.uint64)
        sizes = np.diff(offs[lo : hi + 1])
        grams = np.zeros(0, dtype=np.uint64)
        if len(text) > 2:
            grams = text[:-2] << np.uint64(16) | text[1:-1] << np.uint64(8) | text[2:]
            ends = np.cumsum(sizes)[:-1]
            across = np.concatenate((ends - 1, ends - 2))  # trigrams over a row's end
            inside = np.ones(len(grams), dtype=bool)
            inside[across[(across >= 0) & (across < len(grams))]] = False
            if (short := sizes < 2).any():  # the rows around a short one
                at = np.concatenate(([0], np.cumsum(sizes)))
                row_of = np.searchsorted(at, np.arange(len(grams)), side="right") - 1
                inside = np.arange(len(grams)) + 3 <= at[row_of + 1]
            grams = grams[inside]
        again = np.zeros(len(group.hashes), dtype=bool)
        again[1:] = group.hashes[1:] == group.hashes[:-1]
        again[group.bounds()[:-1][group.counts > 0]] = False
        words, repeats = _slots(mix(group.hashes * _WORDS)), np.where(again, *_REPEATS)
        yield lo, _slots(mix(grams * _TRIGRAMS)), np.maximum(sizes - 2, 0), words, repeats, group.counts


def text_values(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    """f(x) of each row."""
    out = np.zeros(len(column))
    for first, grams, n_grams, words, repeats, n_words in features(column):
        value = SCALE * (row_means(weights[grams], n_grams) + row_means(weights[words] + weights[repeats], n_words))
        out[first : first + len(n_grams)] = value
    return out


def _rows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sparse features (slots, values) of each row."""
    for _, grams, n_grams, words, repeats, n_words in features(column):
        a, b = np.concatenate(([0], np.cumsum(n_grams))), np.concatenate(([0], np.cumsum(n_words)))
        for r in range(len(n_grams)):
            own = slice(b[r], b[r + 1])
            slots, at = np.unique(np.concatenate((grams[a[r] : a[r + 1]], words[own], repeats[own])), return_inverse=True)
            share = np.repeat([SCALE / max(n_grams[r], 1), SCALE / max(n_words[r], 1)], [n_grams[r], 2 * n_words[r]])
            yield slots.astype(np.int32), np.bincount(at, weights=share, minlength=len(slots)).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _row_groups(ends: np.ndarray, values: int = 1 << 18) -> list[tuple[int, int]]:
    """Runs of rows with about ``values`` features each, so that the fit's temporaries stay small."""
    out, lo = [], 0
    while lo < len(ends) - 1:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + values, side="right")) - 1)
        out.append((lo, hi))
        lo = hi
    return out


def fit_weights(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int, steps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) that maximise the cumulative-link likelihood.

    Thresholds are the first one and log-steps between the others, so they stay ordered.
    """
    slots = np.concatenate([s for s, _ in rows])
    values = np.concatenate([v for _, v in rows])
    ends = np.cumsum([0, *(len(s) for s, _ in rows)])
    rows_of = _row_groups(ends)
    cuts = n_grades - 1

    def thresholds(tail: np.ndarray) -> np.ndarray:
        return tail[0] + np.concatenate(([0.0], np.cumsum(np.exp(tail[1:]))))

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, tail = x[:FEATURES], x[FEATURES:]
        t, f = thresholds(tail), np.zeros(len(grades))
        for lo, hi in rows_of:
            part = slice(ends[lo], ends[hi])
            row = np.repeat(np.arange(hi - lo), np.diff(ends[lo : hi + 1]))
            f[lo:hi] = np.bincount(row, weights=values[part] * w[slots[part]], minlength=hi - lo)
        edge = np.concatenate(([-np.inf], t, [np.inf]))
        upper, lower = _sigmoid(edge[grades + 1] - f), _sigmoid(edge[grades] - f)
        upper, lower = np.where(grades == cuts, 1.0, upper), np.where(grades == 0, 0.0, lower)
        p = np.maximum(upper - lower, 1e-12)
        by_f = -(upper + lower - 1) / len(grades)
        by_t = np.zeros(cuts)
        np.add.at(by_t, np.minimum(grades, cuts - 1), np.where(grades < cuts, -upper * (1 - upper) / p, 0.0) / len(grades))
        np.add.at(by_t, np.maximum(grades - 1, 0), np.where(grades > 0, lower * (1 - lower) / p, 0.0) / len(grades))
        by_w = 2 * PENALTY * w
        for lo, hi in rows_of:
            part = slice(ends[lo], ends[hi])
            by_w += np.bincount(slots[part], weights=values[part] * np.repeat(by_f[lo:hi], np.diff(ends[lo : hi + 1])), minlength=FEATURES)
        later = np.cumsum(by_t[::-1])[::-1]
        by_tail = np.concatenate(([later[0]], later[1:] * np.exp(tail[1:])))
        return float(-np.log(p).mean() + PENALTY * (w @ w)), np.concatenate((by_w, by_tail))

    share = np.array([(np.sum(grades < k) + 1) / (len(grades) + 2) for k in range(1, n_grades)])
    first = np.log(share / (1 - share))
    tail = np.concatenate((first[:1], np.log(np.maximum(np.diff(first), 1e-2))))
    best = minimise(loss, np.concatenate((np.zeros(FEATURES), tail)), steps)
    return best[:FEATURES].astype(np.float32), thresholds(best[FEATURES:])


class Model:
    """Weights (1 MB, broadcast) and ordered thresholds; ``only`` is set if one grade was seen."""

    def __init__(self, spark: SparkSession, weights: np.ndarray | None, thresholds: np.ndarray, only: int | None = None):
        self.shared = spark.sparkContext.broadcast(weights) if weights is not None else None
        self.thresholds, self.only = [float(t) for t in thresholds], only

    def value(self, text: Column | str) -> Column:
        if self.shared is None:
            return F.lit(0.0)
        shared = self.shared

        @F.arrow_udf("double")
        def run(column: pa.Array) -> pa.Array:
            return pa.array(text_values(column, shared.value))

        return run(F.col(text) if isinstance(text, str) else text)

    def tail(self, value: Column, k: int = 1) -> Column:
        """P(grade >= k)."""
        if self.shared is None:
            return F.lit(1.0)
        return 1.0 / (1.0 + F.exp(F.lit(self.thresholds[k - 1]) - value))

    def expected(self, value: Column) -> Column:
        """Expected grade: the sum of the tail probabilities."""
        if self.shared is None:
            return F.lit(self.only).cast("double")
        return sum((self.tail(value, k) for k in range(1, len(self.thresholds) + 1)), F.lit(0.0))


def fit(
    docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_grades: int = GRADES,
    rows: int = FIT_ROWS, most_bytes: int = FIT_BYTES,
) -> Model:
    """Fit on at most ``rows`` rows of ``ratings`` (doc_id, grade) outside fold 2 with at most
    ``most_bytes`` of text."""
    spark, root = docs.sparkSession, new_work_dir(docs.sparkSession, "quality")
    rated = ratings.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("grade").cast("int").alias("grade"))
    rated = rated.where(F.col("doc_id").isNotNull() & F.col("grade").between(0, n_grades - 1) & (fold() != 2))
    # Only ratings of these documents count: docs may be a part of what the ratings cover. A
    # repeated id has the size of all its texts.
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    sizes = texts.groupBy("doc_id").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("size")).where(F.col("size") <= most_bytes)
    rated = rated.groupBy("doc_id").agg(F.min("grade").alias("grade")).join(sizes, "doc_id")
    order = F.xxhash64("doc_id")
    sample = rated.withColumn("order", order).orderBy("order", "doc_id").limit(rows)
    before = Window.orderBy("order", "doc_id").rowsBetween(Window.unboundedPreceding, 0)  # of ``rows`` rows
    sample.withColumn("total", F.sum("size").over(before)).where(F.col("total") <= most_bytes).select("doc_id", "grade").write.parquet(f"{root}/sample")
    sample = spark.read.schema("doc_id bigint, grade int").parquet(f"{root}/sample")
    joined = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "grade", "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_rows(batch.column(2)))
            packed = [pa.array([x[k].tobytes() for x in found], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *packed], ["doc_id", "grade", "slots", "shares"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grades, pairs = [], []
        for batch in batches:
            grades += batch.column(0).to_pylist()
            pairs += [(np.frombuffer(s.as_py(), np.int32), np.frombuffer(v.as_py(), np.float32)) for s, v in zip(batch.column(1), batch.column(2))]
        if not grades:
            return
        weights, thresholds = b"", b""
        if len(set(grades)) > 1:
            weights, thresholds = (x.tobytes() for x in fit_weights(pairs, np.array(grades, dtype=np.int64), n_grades))
        yield pa.RecordBatch.from_arrays([pa.array([weights]), pa.array([thresholds]), pa.array([grades[0]], pa.int32())], ["weights", "thresholds", "only"])

    found = joined.mapInArrow(read, "doc_id bigint, grade int, slots binary, shares binary")
    once = found.groupBy("doc_id").agg(F.min(F.struct("grade", "slots", "shares")).alias("row")).select("doc_id", "row.*")
    ordered = once.repartition(1).sortWithinPartitions("doc_id").select("grade", "slots", "shares")
    got = ordered.mapInArrow(solve, "weights binary, thresholds binary, only int").collect()
    if not got:
        return Model(spark, None, np.zeros(0))
    if not got[0]["weights"]:
        return Model(spark, None, np.zeros(0), got[0]["only"])
    return Model(spark, np.frombuffer(got[0]["weights"], np.float32), np.frombuffer(got[0]["thresholds"], np.float64))


def ratings_of(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", grade(F.col("quality"), F.col("toxic")).alias("grade"))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, expected_grade, p_acceptable, selected) of every row."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), model.value(text_col).alias("value"))
    return rows.select(
        "doc_id",
        (fold() == 2).alias("held_out"),
        model.expected(F.col("value")).alias("expected_grade"),
        model.tail(F.col("value")).alias("p_acceptable"),
        (model.tail(F.col("value")) >= 0.5).alias("selected"),
    )


def select_documents(docs: DataFrame, labels: DataFrame, at_least: int = 1, probability: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (all columns) with P(grade >= at_least) >= probability."""
    model = fit(docs, ratings_of(labels))
    value = free_name(docs, "_value")
    valued = docs.select("*", model.value("text").alias(value))
    return valued.where(model.tail(F.col(value), at_least) >= probability).select(*docs.columns)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = sf_dir.rstrip("/")
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{root}/labels.parquet").select("doc_id", "quality", "toxic")
    return score(docs, fit(docs, ratings_of(labels)))
