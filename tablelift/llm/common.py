"""Helpers shared by the operators: shared scratch tables, Arrow batches cut by bytes, vectorised words.

Nothing here decides a result.  Word hashes have 64 bits; operators that compare whole
corpora group by two independent hashes, operators that compare two texts need only one.
"""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 19  # text handled at once inside a task; one longer text makes a slice of its own
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


# ---------------------------------------------------------------- Spark side


def scratch(spark: SparkSession) -> str:
    """The shared folder the cluster names; only a local session (tests) may get one of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared folder and read back: lineage ends here, a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def one_value(df: DataFrame):
    """The only value of a one-row table, None where an empty input left no row."""
    row = df.first()
    return None if row is None else row[0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- Arrow side


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose `column` holds about `limit` bytes of text; no text is cut."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.diff(flat(batch.column(column))[1])
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts in one array and the n + 1 offsets between them; null is empty."""
    if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type):
        texts = texts.fill_null(b"").cast(pa.large_binary())
    else:
        texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows that agree in `keys`; the rows come sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        values = [batch.column(c).to_numpy() for c in keys]
        change = np.flatnonzero(np.any([x[1:] != x[:-1] for x in values], axis=0)) + 1
        bounds = [0, *change.tolist(), batch.num_rows]
        for k, (start, stop) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            if held and (k > 0 or any(held[-1].column(c)[0].as_py() != x[0] for c, x in zip(keys, values, strict=True))):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
    if held:
        yield pa.Table.from_batches(held)


class Unions:
    """Disjoint sets over the distinct values of `names`; what joins two sets is worth passing on."""

    def __init__(self, names: np.ndarray):
        self.names, self.label = np.unique(names, return_inverse=True)
        self.up = list(range(len(self.names)))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
        """Joins the sets of rows left[k] and right[k]; (larger, smaller) names of the joins that were news."""
        news = []
        for a, b in zip(self.label[left].tolist(), self.label[right].tolist(), strict=True):
            x, y = self.root(a), self.root(b)
            if x != y:
                self.up[max(x, y)] = min(x, y)
                news.append((int(self.names[max(a, b)]), int(self.names[min(a, b)])))
        if news:
            self.label = np.array([self.root(i) for i in range(len(self.up))])[self.label]
        return news


def int64_list(rows: list[np.ndarray]) -> pa.Array:
    """Arrays of longs as one Arrow list column, without going through Python numbers."""
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    values = np.concatenate(rows).astype(np.int64, copy=False) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


# ---------------------------------------------------------------- words


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (finaliser of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@functools.lru_cache(maxsize=4)
def byte_codes(seed: int, lower: bool) -> np.ndarray:
    """A random 64-bit code per byte; with `lower`, A-Z share the codes of a-z."""
    codes = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03) + np.uint64(seed))
    if lower:
        codes[65:91] = codes[97:123]
    return codes


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(cls.up):
            size = max(n, SLICE_BYTES + (1 << 16))
            steps = np.full(size, _MULTIPLIER, np.uint64)
            back = np.full(size, _INVERSE, np.uint64)
            steps[0] = back[0] = 1
            up, down = np.cumprod(steps, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)
            if size > 4 * SLICE_BYTES:  # an oversized text; its tables are not kept
                return up, down
            cls.up, cls.down = up, down
        return cls.up, cls.down


def prefix_hash(data: np.ndarray, seed: int = 1, lower: bool = False) -> np.ndarray:
    """Running polynomial sums, from which `range_hash` has the hash of any range."""
    up, _ = _Powers.of(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte_codes(seed, lower)[data] * up[: len(data)], out=sums[1:])
    return sums


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes start..end-1, the same wherever they stand."""
    _, down = _Powers.of(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


@functools.lru_cache(maxsize=4)
def _is_separator(separators: bytes) -> np.ndarray:
    marks = np.zeros(256, bool)
    marks[np.frombuffer(separators, np.uint8)] = True
    return marks


class Words:
    """The words of several texts: their text, place in the bytes and hash."""

    def __init__(self, texts: pa.Array, separators: bytes = WHITE, lower: bool = True, seed: int = 1):
        self.data, self.offsets = flat(texts)
        inside = ~_is_separator(separators)[self.data]
        first, last = inside.copy(), inside.copy()
        if len(self.data):
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            edges = self.offsets[1:-1]
            edges = edges[(edges > 0) & (edges < len(self.data))]
            first[edges] = inside[edges]
            last[edges - 1] = inside[edges - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.start, self.offsets)  # words of text i: bounds[i]..bounds[i+1]-1
        self.counts = np.diff(self.bounds)
        self.hash = range_hash(prefix_hash(self.data, seed, lower), self.start, self.end)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words and their n + 1 bounds per text, in order, repeats included.

    A text with fewer words, but at least one, has its whole sequence as its only shingle.
    """
    h, bounds, counts = words.hash, words.bounds, words.counts
    total = len(h)
    grams = np.zeros(total, np.uint64)
    for k in range(min(n, total)):
        factor = np.uint64(pow(_MULTIPLIER, 2 * k + 3, 1 << 64))
        grams[: total - k] += h[k:] * factor
    keep = np.ones(total, bool)
    for k in range(1, n):  # the last n - 1 words of a text start no full run
        at = bounds[1:] - k
        keep[at[at >= bounds[:-1]]] = False
    for i in np.flatnonzero((counts > 0) & (counts < n)):
        run = h[bounds[i] : bounds[i + 1]]
        factors = np.array([pow(_MULTIPLIER, 2 * k + 3, 1 << 64) for k in range(len(run))], np.uint64)
        grams[bounds[i]] = (run * factors).sum(dtype=np.uint64) + np.uint64(len(run))
        keep[bounds[i]] = True
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    return mix(grams[keep]), np.concatenate([[0], np.cumsum(sizes)])


# ---------------------------------------------------------------- joins and components


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def class_join(rows: DataFrame, classes: DataFrame, keys: list[str], values: list[str], count: str, spread: list[str]) -> DataFrame:
    """`rows` inner-joined to one row per key of `classes`, when one key may hold a third of the rows.

    Classes with more than a partition's fair share of the counted rows number fewer than the
    partitions, so they are broadcast whatever the input; the rows of all others are shuffled.  The
    rows of broadcast classes get a key of their own from `spread`, so none of them meets again.
    """
    spark = rows.sparkSession
    parts = partitions(spark)
    total = classes.agg(F.sum(count)).first()[0] or 0
    heavy = F.col(count) * parts > F.lit(total)
    packed = F.struct(*values).alias("__value")
    hot = F.broadcast(classes.where(heavy).select(*keys, packed))  # fewer rows than partitions
    cold = classes.where(~heavy).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.struct(*values).alias("__cold"))
    marked = rows.join(hot, keys, "left")
    is_hot = F.col("__value").isNotNull()
    own = F.when(is_hot, F.xxhash64(*spread)).otherwise(F.col(keys[0]))
    marked = marked.withColumn("__own", own).withColumn("__is_hot", is_hot)
    match = (F.col("__own") == F.col("__k0")) & ~F.col("__is_hot")
    for i, k in enumerate(keys[1:], 1):
        match &= F.col(k) == F.col(f"__k{i}")
    found = marked.join(cold.withColumn("__no", F.lit(False)), match & (F.col("__is_hot") == F.col("__no")), "left")
    value = F.coalesce("__value", "__cold")
    return found.where(value.isNotNull()).select(*rows.columns, *[value[v].alias(v) for v in values])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the `edges` (a, b): root is the smallest node it is connected with.

    Each round hooks every node to its smallest neighbour, follows the pointers by doubling and
    carries the edges over to the roots; the nodes left at least halve per round.  Every round is
    written to the shared folder, and only counts reach the driver.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct()
    both = written(both, "edges")
    labels = None
    while both.limit(1).count():
        up = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "roots")
        while True:  # pointer doubling: the forest's depth halves
            above = up.select(F.col("node").alias("root"), F.col("root").alias("__next"))
            moved = written(up.join(above, "root").select("node", F.col("__next").alias("root"), (F.col("root") != F.col("__next")).alias("moved")), "roots")
            up = moved.select("node", "root")
            if not moved.where("moved").limit(1).count():
                break
        if labels is None:
            labels = up
        else:
            renamed = up.select(F.col("node").alias("root"), F.col("root").alias("__next"))
            labels = labels.join(renamed, "root", "left").select("node", F.coalesce("__next", "root").alias("root"))
            labels = written(labels, "labels")
        of_a = up.select(F.col("node").alias("a"), F.col("root").alias("__a"))
        of_b = up.select(F.col("node").alias("b"), F.col("root").alias("__b"))
        both = written(both.join(of_a, "a").join(of_b, "b").select(F.col("__a").alias("a"), F.col("__b").alias("b")).where("a != b").distinct(), "edges")
    return both.select(F.col("a").alias("node"), F.col("b").alias("root")) if labels is None else labels
