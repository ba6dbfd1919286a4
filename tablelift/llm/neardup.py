"""Near duplicates by bottom-k sketches of one hash function.

A document's set is its distinct runs of `n` words, hashed once; its sketch is the SKETCH smallest
values.  Documents with equal sets are one class from the start.  Inverted lists hold, for every two
neighbouring values among a sketch's smallest KEYED, the classes that retain both; documents as
alike as the threshold share about 20 such pairs, and the chance that they share none is below
1e-9 (for sets that the sketch holds whole it is 0).  An overlap in a list is judged by the union
sketch: the share of common values among the values of both sketches up to where both are
complete.  What the estimate does not rule out (five standard deviations below the threshold) is
confirmed on the full sets.

Lists may hold a third of all rows.  First every class is compared only with the hub of each of its
lists, the member whose lists are longest in all: among edited copies that is the text they were
made from, which is nearer to each of them than they are to one another.  Those links make
components, and in every list only classes of different components are left to compare, in blocks
of BLOCK rows.  From each block comes a tree of the components that estimated matches join, not the
matches; components so joined are a cluster, whose full sets meet once, again in blocks, and again
only what exact links join comes out.  So no group is expanded into pairs, and no link between
different components is missed.

Defined results: null, empty and wordless texts have an empty set and are linked with nothing; a
text of fewer than `n` words has its whole sequence as only element; rows that share a doc_id are
one document; rows without a doc_id are linked with nothing, have a null component and are kept;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import Unions, Words, class_join, components, groups, int64_list, mix, partitions, shingles, slices, written

SKETCH = 64
KEYED = 33
ESTIMATE = 0.55
BLOCK = 1024  # rows of one list or cluster that meet another such block in one task
TILE = 256  # sets compared at once
COLUMNS = 1 << 14  # values of them counted at once
PAIRS = 1 << 13  # pairs estimated at once
BROADCAST_IDS = 2_000_000
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def sets_of(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct 63-bit hashes of every text's shingles."""
    grams, bounds = shingles(Words(texts), n)
    grams >>= np.uint64(1)
    return [np.unique(grams[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def sketches(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, n_shingles, fp1, fp2, sketch) of every document; fp1 and fp2 name its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = sets_of(part.column("text"), n)
            sizes = np.array([len(s) for s in sets], np.int64)
            prints = [[mix(s + np.uint64(k)).sum(dtype=np.uint64).astype(np.int64) for s in sets] for k in (1, 2)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(sizes), pa.array(prints[0], pa.int64()), pa.array(prints[1], pa.int64()), int64_list([s[:SKETCH] for s in sets])],
                ["doc_id", "n_shingles", "fp1", "fp2", "sketch"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, fp1 long, fp2 long, sketch array<long>")


def sketch_matrix(lists: pa.Array) -> np.ndarray:
    """Sketches as rows, padded with the largest number."""
    bounds = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy().astype(np.uint64)
    out = np.full((len(lists), SKETCH), FULL, np.uint64)
    counts = np.diff(bounds)
    rows = np.repeat(np.arange(len(lists)), counts)
    out[rows, np.arange(bounds[0], bounds[-1]) - np.repeat(bounds[:-1], counts)] = values[bounds[0] : bounds[-1]]
    return out


def similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of sketch rows, from the part of the union both hold completely."""
    until = np.minimum(a[:, -1], b[:, -1])  # FULL where a sketch is the whole set
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    inside = (both <= until[:, None]) & (both != FULL)
    same = (both[:, 1:] == both[:, :-1]) & inside[:, 1:]
    common = same.sum(axis=1)
    return common / np.maximum(inside.sum(axis=1) - common, 1)


def list_keys(sketch: np.ndarray) -> np.ndarray:
    """Codes of the neighbouring values among the KEYED smallest of each sketch row; FULL where there are none."""
    low, high = sketch[:, : KEYED - 1], sketch[:, 1:KEYED]
    codes = mix(low * np.uint64(0x9E3779B97F4A7C15) + high) >> np.uint64(1)
    return np.where(high == FULL, FULL, codes)


def keyed(reps: DataFrame) -> DataFrame:
    """(doc, key) for every list a class stands in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = list_keys(sketch_matrix(batch.column("sketch")))
            row, column = np.nonzero(codes != FULL)
            keys = codes[row, column].astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc").take(pa.array(row)), pa.array(keys)], ["doc", "key"])

    return reps.select("doc", "sketch").mapInArrow(run, "doc long, key long")


def star_matches(pairs: DataFrame) -> DataFrame:
    """The (a, b) whose sketches (sa, sb) may reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, PAIRS):
                part = batch.slice(start, PAIRS)
                alike = similarity(sketch_matrix(part.column("sa")), sketch_matrix(part.column("sb"))) >= ESTIMATE
                yield pa.RecordBatch.from_arrays([part.column(c).filter(pa.array(alike)) for c in "ab"], ["a", "b"])

    return pairs.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def cell_pairs(sizes: np.ndarray, unions: Unions, blocks: np.ndarray, across: bool, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of one cell that are not joined yet and whose sizes allow the threshold.

    Rows come sorted by size, so the partners of a row are the ones after it up to its size limit.
    """
    until = np.searchsorted(sizes, sizes / least + 1e-9, "right")
    counts = until - np.arange(len(sizes)) - 1
    reached = np.cumsum(counts)
    start, chunk = 0, PAIRS >> 6
    while start < len(sizes):
        before = reached[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(reached, before + chunk, "right")))
        number = counts[start:stop]
        left = np.repeat(np.arange(start, stop), number)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(number) - number, number)
        keep = unions.label[left] != unions.label[right]
        if across:
            keep &= blocks[left] != blocks[right]
        if keep.any():
            yield left[keep], right[keep]
        start, chunk = stop, min(2 * chunk, PAIRS)


def edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], ["a", "b"])


def matched_roots(lists: DataFrame, least: float) -> DataFrame:
    """(a, b): roots that estimated matches within the (key, i, j) cells of `lists` join, a tree per cell and not all pairs."""
    chosen = lists.select("key", "i", "j", "n", "doc", "root", "own", "sketch")
    cells = chosen.repartition(partitions(lists.sparkSession), "key", "i", "j").sortWithinPartitions("key", "i", "j", "n", "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges: list[tuple[int, int]] = []
        for cell in groups(batches, ["key", "i", "j"]):
            sizes, roots, own, i, j = (cell.column(c).to_numpy() for c in ("n", "root", "own", "i", "j"))
            sketch = sketch_matrix(cell.column("sketch").combine_chunks())
            unions = Unions(roots)
            for left, right in cell_pairs(sizes, unions, own, bool(i[0] != j[0]), least):
                alike = similarity(sketch[left], sketch[right]) >= ESTIMATE
                edges += unions.join(left[alike], right[alike])
            if len(edges) >= PAIRS:
                yield edge_batch(edges)
                edges = []
        yield edge_batch(edges)

    return cells.mapInArrow(run, "a long, b long")


def common_sizes(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, by products of their incidence matrices."""
    values = np.unique(np.concatenate(left + right))
    total = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, len(values), COLUMNS):
        some = values[start : start + COLUMNS]
        tables = []
        for sets in (left, right):
            table = np.zeros((len(sets), len(some)), np.float32)
            for r, s in enumerate(sets):
                part = s[np.searchsorted(s, some[0]) : np.searchsorted(s, some[-1], "right")]
                table[r, np.searchsorted(some, part)] = 1.0
            tables.append(table)
        total += tables[0] @ tables[1].T
    return total.astype(np.int64)


def confirmed_roots(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): roots that exact links join, within the (cluster, i, j) cells of `members`."""
    chosen = members.select("cluster", "i", "j", "doc", "root", "own", "set")
    cells = chosen.repartition(partitions(members.sparkSession), "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "own", "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in groups(batches, ["cluster", "i", "j"]):
            roots, own = cell.column("root").to_numpy(), cell.column("own").to_numpy()
            lists = cell.column("set").combine_chunks()
            bounds, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            sets = [values[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            sizes = np.diff(bounds).astype(np.int64)
            unions = Unions(roots)
            edges: list[tuple[int, int]] = []
            half = int(np.searchsorted(own, own[-1])) if own[0] != own[-1] else 0
            firsts, others = (range(half), range(half, len(sets))) if half else (range(len(sets)), range(len(sets)))
            for a in range(0, len(firsts), TILE):
                rows = np.array(firsts[a : a + TILE])
                for b in range(0 if half else a, len(others), TILE):
                    columns = np.array(others[b : b + TILE])
                    if len(np.unique(unions.label[np.concatenate([rows, columns])])) == 1:
                        continue
                    common = common_sizes([sets[r] for r in rows], [sets[c] for c in columns])
                    union = sizes[rows][:, None] + sizes[columns][None, :] - common
                    x, y = np.nonzero((100 * common >= percent * union) & (unions.label[rows][:, None] != unions.label[columns][None, :]))
                    edges += unions.join(rows[x], columns[y])
            yield edge_batch(edges)

    return cells.mapInArrow(run, "a long, b long")


def in_cells(rows: DataFrame, key: str) -> DataFrame:
    """(key, doc, root, own, i, j): groups of `rows` rows cut into blocks, every two blocks meeting in one cell."""
    blocks = F.ceil(F.col("rows") / F.lit(BLOCK)).cast("long")
    dealt = rows.withColumn("own", F.pmod(F.xxhash64("doc"), blocks))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    return dealt.select(key, "doc", "root", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))


def full_sets(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """(doc, set) of the documents in `ids`."""
    small = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS  # 8 bytes each
    wanted = ids.select(F.col("doc").alias("doc_id"))
    chosen = docs.select("doc_id", "text").join(F.broadcast(wanted) if small else wanted, "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), int64_list(sets_of(part.column("text"), n))], ["doc", "set"])

    return chosen.mapInArrow(run, "doc long, set array<long>")


def confirmed(docs: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    ids = pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc"))).distinct()
    sets = full_sets(docs, ids, n)
    of_a = sets.select(F.col("doc").alias("a"), F.col("set").alias("xa"))
    of_b = sets.select(F.col("doc").alias("b"), F.col("set").alias("xb"))
    met = pairs.join(of_a, "a").join(of_b, "b")
    common = F.size(F.array_intersect("xa", "xb"))
    return met.where(100 * common >= percent * (F.size("xa") + F.size("xb") - common)).select("a", "b")


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of `docs`; links need `percent` similarity."""
    rows = written(sketches(docs, n), "sketches")
    known = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    prints = ["fp1", "fp2", "n_shingles"]
    classes = written(known.groupBy(*prints).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")), "classes")
    reps = known.join(classes.select(F.col("rep").alias("doc_id"), *prints), ["doc_id", *prints], "left_semi")
    reps = written(reps.dropDuplicates(["doc_id", *prints]).select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), "sketch"), "reps")

    listed = keyed(reps)
    lists = written(listed.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1"), "lists")
    members = written(class_join(listed, lists, ["key"], ["rows"], "rows", ["doc", "key"]), "members")
    central = members.groupBy("doc").agg(F.sum("rows").alias("weight"))
    hubs = members.join(central, "doc").groupBy("key").agg(F.max(F.struct("weight", -F.col("doc"), "doc"))["doc"].alias("hub"), F.count(F.lit(1)).alias("rows"))
    star = class_join(members.select("key", "doc"), written(hubs, "hubs"), ["key"], ["hub"], "rows", ["doc", "key"])
    star = star.where("doc != hub").select(F.greatest("doc", "hub").alias("a"), F.least("doc", "hub").alias("b")).distinct()

    of_a = reps.select(F.col("doc").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    of_b = reps.select(F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    fits = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    star = star_matches(star.join(of_a, "a").join(of_b, "b").where(fits))
    links = written(confirmed(docs, written(star, "star"), n, percent), "links")
    first = components(links)

    rooted = members.join(first.select(F.col("node").alias("doc"), "root"), "doc", "left").withColumn("root", F.coalesce("root", "doc"))
    rooted = written(rooted, "rooted")
    mixed = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("rows"))
    mixed = mixed.where("low != high").select("key", "rows")
    open_lists = class_join(rooted.select("key", "doc", "root"), written(mixed, "mixed"), ["key"], ["rows"], "rows", ["doc", "key"])
    near = written(matched_roots(in_cells(open_lists, "key").join(reps, "doc"), percent / 100), "near")
    clusters = components(near).select(F.col("node").alias("root"), F.col("root").alias("cluster"))
    linked = reps.select("doc").join(first.select(F.col("node").alias("doc"), "root"), "doc", "left")
    linked = linked.withColumn("root", F.coalesce("root", "doc")).join(clusters, "root").select("cluster", "doc", "root").distinct()
    linked = written(linked, "linked")
    counted = written(linked.groupBy("cluster").agg(F.count(F.lit(1)).alias("rows")), "clusters")
    linked = written(class_join(linked, counted, ["cluster"], ["rows"], "rows", ["doc"]), "linked")
    more = confirmed_roots(in_cells(linked, "cluster").join(full_sets(docs, linked.select("doc"), n), "doc"), percent)
    more = written(more, "more")

    several = known.groupBy("doc_id").agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("fp1", "fp2")])
    several = several.where("min_fp1 != max_fp1 OR min_fp2 != max_fp2").select("doc_id")  # one document, several sets
    same = known.join(several, "doc_id").join(classes, prints).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    joined = components(links.unionByName(more).unionByName(same))

    top = joined.select(F.col("node").alias("rep"), "root")
    named = written(classes.join(top, "rep", "left").select(*prints, "n", F.coalesce("root", "rep").alias("root")), "named")
    placed = class_join(known.select("doc_id", *prints), named, prints, ["root"], "n", ["doc_id"])
    rest = rows.where("n_shingles = 0 OR doc_id IS NULL").select("doc_id", *prints, F.col("doc_id").alias("root"))
    every = placed.unionByName(rest)
    return every.select("doc_id", "n_shingles", F.col("root").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("root"), F.lit(True)).alias("kept"))


def one_per_id(docs: DataFrame) -> DataFrame:
    """`docs` with one row per doc_id, any of equal ones; rows without an id all stay.

    Only ids that occur more than once are shuffled with their texts.
    """
    repeats = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 AND doc_id IS NOT NULL").select("doc_id")
    repeats = written(repeats, "repeats")
    single = docs.join(repeats, "doc_id", "left_anti").select(*docs.columns)
    several = docs.join(repeats, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    return single.unionByName(several)
