"""Toxicity: non-negative positive-unlabelled learning over hashed words.

Only confirmed toxic documents carry a label; every other text the learner sees is unlabelled and
may be toxic too.  With `prior` the share of toxic documents, the risk of a classifier f is

    prior * R+(toxic) + max(0, R-(unlabelled) - prior * R-(toxic))

with sigmoid loss.  Where the second part falls below zero, the model has begun to memorise the
toxic texts, and the step goes up that part instead, as the non-negative estimator prescribes.
The classifier is linear over hashed words and their first bytes, present or not, twice or not; it is fitted in numpy by Adam.  Only
words that the toxic texts hold far oftener than the unlabelled ones (SURPLUS standard deviations,
fewer where there are few toxic texts), and that mark a toxic text with probability PURITY by the
class prior, get a column: thousands of words without evidence would add up to noise in long texts.

Training takes at most POSITIVES toxic and UNLABELLED other documents, both by smallest hash of
doc_id and none from the held-out fold, copies of a text once; the prior is the share of toxic rows among the labelled
ones unless given.  Scoring reads every whole text, in slices, without a shuffle.

Defined results: null, empty or wordless texts score the intercept; null labels and doc_ids are
not learnt from; several labels of one document count as their largest; without any toxic row the
model is empty and every score is (nearly) 0; of rows that share an id one is learnt from, and all are
scored; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.llm.common import Words, mix, one_value, prefix_hash, range_hash, slices
from tablelift.llm.quality import held_out, one_text_each, sample_labels

BITS = 18
POSITIVES = 2000
UNLABELLED = 6000
SURPLUS = 10.0
PURITY = 0.75
TWICE = 1 << 40  # what tells "twice" columns from the others
STEMS = (4, 6)  # bytes of a word that count as its beginning
STEPS = 400
BANDS, BAND = 3, 4  # training texts that share all values of a band are copies
THRESHOLD = 0.5
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def columns(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashed words and word beginnings of every text, again if they occur twice, and their n + 1 bounds."""
    words = Words(texts, SEPARATORS)
    sums = prefix_hash(words.data, lower=True)
    stems = [range_hash(sums, words.start, np.minimum(words.end, words.start + k)) + np.uint64(k) for k in STEMS]
    index = (mix(np.concatenate([words.hash, *stems])) >> np.uint64(64 - bits)).astype(np.int64)
    key, counts = np.unique(np.tile(words.text_of.astype(np.int64), 1 + len(STEMS)) << bits | index, return_counts=True)
    text, index = key >> bits, key & ((1 << bits) - 1)
    again = (mix(index[counts > 1].astype(np.uint64) + np.uint64(TWICE)) >> np.uint64(64 - bits)).astype(np.int64)
    key = np.unique(np.concatenate([key, text[counts > 1] << bits | again]))
    bounds = np.searchsorted(key, np.arange(len(texts) + 1, dtype=np.int64) << bits)
    return key & ((1 << bits) - 1), bounds


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(values)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def once_per_text(rows: list[np.ndarray]) -> list[int]:
    """Indexes of rows without the copies of earlier ones, edited copies too, by bands of MinHash values.

    Many copies of one toxic text would make all its words look toxic.
    """
    seen: set[tuple[int, int, int]] = set()
    kept = []
    for i, row in enumerate(rows):
        values = row.astype(np.uint64)
        keys = []
        for band in range(BANDS):
            least = [int(mix(values * np.uint64(2 * (band * BAND + k) + 1) + np.uint64(k)).min()) if len(values) else 0 for k in range(BAND)]
            keys.append((band, len(least), hash(tuple(least))))
        if len(values) == 0 or seen.isdisjoint(keys):
            kept.append(i)
        seen.update(keys)
    return kept


def fit(
    index: np.ndarray, bounds: np.ndarray, toxic: np.ndarray, prior: float, bits: int = BITS,
    steps: int = STEPS, rate: float = 0.05, l2: float = 1e-5,
) -> tuple[np.ndarray, float]:
    """Weights and intercept minimising the non-negative risk of the rows, toxic or unlabelled."""
    size = 1 << bits
    rows = np.repeat(np.arange(len(toxic)), np.diff(bounds))
    w, b = np.zeros(size), -1.0
    n_toxic, n_other = max(int(toxic.sum()), 1), max(int((~toxic).sum()), 1)
    if not toxic.any():
        return w, -35.0
    held = np.bincount(index[toxic[rows]], minlength=size)
    expected = np.bincount(index[~toxic[rows]], minlength=size) * (n_toxic / n_other)
    surplus = min(SURPLUS, 1.0 + 0.5 * np.sqrt(n_toxic))
    purity = prior * held / np.maximum(np.maximum(expected, prior * held), 1e-9)  # share of toxic texts among all that hold the column
    columns_used = np.flatnonzero((held - expected >= surplus * np.sqrt(expected + 1.0)) & (purity >= PURITY))
    place = np.full(size, -1)
    place[columns_used] = np.arange(len(columns_used))
    used = place[index] >= 0
    index, rows = place[index[used]], rows[used]
    size = len(columns_used)
    v = np.zeros(size)
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        f = np.bincount(rows, v[index], minlength=len(toxic)) + b
        up = 1.0 / (1.0 + np.exp(-np.clip(f, -35, 35)))  # loss of f as a clean text; 1 - up as a toxic one
        slope = up * (1.0 - up)
        clean_part = up[~toxic].sum() / n_other - prior * up[toxic].sum() / n_toxic
        gain = np.where(toxic, -prior * slope / n_toxic, 0.0)
        part = np.where(toxic, -prior * slope / n_toxic, slope / n_other)
        g = gain + part if clean_part >= 0 else -part
        gradient = np.append(np.bincount(index, g[rows], minlength=size) + l2 * v, g.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient * gradient
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-6)
        v -= move[:-1]
        b -= move[-1]
    w[columns_used] = v
    return w, float(b)


def train(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, prior: float | None = None,
    positives: int = POSITIVES, unlabelled: int = UNLABELLED,
) -> tuple[np.ndarray, float]:
    """The model learnt from a bounded number of toxic and unlabelled documents, in one task."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    if prior is None:
        prior = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    confirmed = sample_labels(known.where("toxic = 1"), "toxic", positives)
    free = docs.select("doc_id").where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()
    others = free.withColumn("order", F.xxhash64("doc_id", F.lit(1))).orderBy("order", "doc_id").limit(unlabelled)
    chosen = others.select("doc_id", F.lit(0).alias("label"), "order").unionByName(confirmed).groupBy("doc_id").agg(
        F.max("label").alias("label"), F.min("order").alias("order")
    )
    texts = one_text_each(docs, chosen)  # at most positives + unlabelled rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, toxic, order = [], [], []
        for part in slices(batches, "text"):
            index, bounds = columns(part.column("text"))
            parts += [index[bounds[i] : bounds[i + 1]] for i in range(part.num_rows)]
            toxic += part.column("label").to_pylist()
            order += part.column("order").to_pylist()
        ranked = sorted(range(len(order)), key=lambda i: (order[i], len(parts[i]), int(parts[i].sum())))
        ranked = [ranked[i] for i in once_per_text([parts[i] for i in ranked])]
        rows = [parts[i] for i in ranked]
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        weights, intercept = fit(flat, bounds, np.array([toxic[i] == 1 for i in ranked], bool), prior)
        model = np.append(weights, intercept).astype("<f8").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])

    learnt = one_value(texts.repartition(1).mapInArrow(run, "model binary"))
    model = np.append(np.zeros(1 << BITS), -35.0) if learnt is None else np.frombuffer(learnt, "<f8")
    return model[:-1], float(model[-1])


def score(docs: DataFrame, model: tuple[np.ndarray, float], keep: list[str]) -> DataFrame:
    """The `keep` columns of every document with its score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits numbers
    chosen = docs.select(*[c for c in keep if c != "text"], "text")
    out = docs.select(*keep, F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercept = shared.value
        for part in slices(batches, "text"):
            index, bounds = columns(part.column("text"))
            logit = row_sums(weights[index], bounds) + intercept
            chance = 1.0 / (1.0 + np.exp(-np.clip(logit, -35.0, 35.0)))
            yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [pa.array(chance)], [*keep, "score"])

    return chosen.mapInArrow(run, out)
