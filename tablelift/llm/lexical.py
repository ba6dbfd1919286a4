"""Ranked lexical search: the best documents of every item by exact inner product, found with ball trees.

Terms are the runs of digits, letters and characters beyond ASCII, A-Z lower-cased.  With N documents
that hold a term, L terms in all, n in one document, df documents holding a term and tf occurrences, a
term weighs w = floor(1000 ln((2N + 2) / (2 df + 1))), a document's m is 10 + (90 n N) div L, and its
score for an item sums w ((10^9 tf) div (1000 tf + 8 m)) over the item's terms.  That is the inner
product of the item's 0/1 vector with the document's sparse vector of such products.

One pass over the texts keeps of every document n and the (term, tf) that may occur in an item: the
items' term hashes set bits of a table of 2^22 bits, whose size is fixed however many items there are.
What is written so is read for N, L, df and the search.  The search takes the items in blocks of about
QUERY_TERMS (item, term) pairs, one broadcast of bounded size each; documents stay where they are and
are not shuffled.  Every task goes through its documents in blocks of BLOCK and builds a ball tree over
each: nodes are split at the median between two far members, down to LEAF documents; a node has
its centroid and, as the farthest member's distance, its radius.  No member of a node scores more for
the item q than q.centroid + |q| radius.  A distance to the centroid counts all terms of a document, most
of which are not the item's, so a node also has a radius along every term, how far a member exceeds the
centroid there, and the sum of centroid and radius over the item's terms bounds its members too; the
smaller bound counts.  Both are floats, so they are raised by more than they can have lost.  For each
item the nodes are opened best bound first, leaves are scored exactly in 64-bit integers, and the search
of a tree ends when the best open bound is below the item's tenth best score in the task so far, so
whole subtrees are never looked at (README has the shares).  The tasks' best are merged in two steps, of SPREAD tasks and of all.

Equal terms are told by a 64-bit hash.  Numbers are exact as long as 90 n N stays below 2^63.

Defined results: null, empty and wordless texts have no terms and are in no statistics; rows of documents
that share an id, or have none, are documents of their own, those without an id rank after others of
equal score; rows of items that share an id are one item with the terms of all, items without an id take
no part; fewer documents with a score above 0 give fewer rows; empty tables give none; other columns are
ignored, whatever their names; ids are whole numbers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablelift.llm.common import Words, class_join, int64_list, slices, written

SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
TOP = 10
MASK_WORDS = 1 << 16  # 64 bits each
QUERY_TERMS = 1 << 20
BLOCK = 8192
LEAF = 8
SPREAD = 64
ROUNDING = 1e-9  # of the numbers a bound is made of: far more than sums in double precision lose

ORACLE = r"""
WITH words AS (
    SELECT row_number() OVER () AS d, doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS word
    FROM documents),
terms AS (
    SELECT d, any_value(doc_id) AS doc_id, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term, count(*) AS tf
    FROM words GROUP BY d, term),
sizes AS (SELECT d, sum(tf)::BIGINT AS n FROM terms GROUP BY d),
totals AS (SELECT count(*)::BIGINT AS all_n, sum(n)::BIGINT AS all_l FROM sizes),
weights AS (
    SELECT term, floor(1000 * ln((2 * all_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM terms, totals GROUP BY term, all_n),
asked AS (
    SELECT DISTINCT item_id, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
    FROM (SELECT item_id, unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS word FROM benchmark)
    WHERE item_id IS NOT NULL),
scored AS (
    SELECT item_id, d, any_value(doc_id) AS doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * all_n) // all_l)))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN terms USING (term) JOIN sizes USING (d), totals
    GROUP BY item_id, d),
ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
    FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


# ---------------------------------------------------------------- terms


def mask_place(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (hashes >> np.uint64(48)).astype(np.int64), (hashes >> np.uint64(42)) & np.uint64(63)


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term) of every distinct term hash of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words = Words(part.column("text"), SEPARATORS)
            held = [np.unique(words.hash[a:b]) for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("item_id"), int64_list([h.view(np.int64) for h in held])], ["item_id", "terms"])

    asked = items.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    return asked.mapInArrow(run, "item_id long, terms array<long>").select("item_id", F.explode("terms").alias("term")).distinct()


def mask_of(terms: DataFrame) -> np.ndarray:
    """The bit table of the terms; at most MASK_WORDS numbers reach the driver."""
    word = F.shiftrightunsigned("term", 48).cast("int")
    bit = F.shiftrightunsigned("term", 42).bitwiseAND(F.lit(63)).cast("int")
    marks = terms.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit"))
    mask = np.zeros(MASK_WORDS, np.int64)
    for row in marks.groupBy("word").agg(F.bit_or("bit")).collect():
        mask[row[0]] = row[1]
    return mask.view(np.uint64)


def postings_of(docs: DataFrame, mask: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term; of its terms those that may be an item's."""
    sent = docs.sparkSession.sparkContext.broadcast(mask)  # 512 KiB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words = Words(part.column("text"), SEPARATORS)
            at, bit = mask_place(words.hash)
            asked = np.flatnonzero((sent.value[at] >> bit) & np.uint64(1))
            text, term = words.text_of[asked], words.hash[asked]
            order = np.lexsort((term, text))
            text, term = text[order], term[order]
            first = np.ones(len(term), bool)
            first[1:] = (text[1:] != text[:-1]) | (term[1:] != term[:-1])
            start = np.flatnonzero(first)
            count = np.diff(np.append(start, len(term)))
            bounds = np.searchsorted(text[start], np.arange(len(words.counts) + 1)).astype(np.int32)
            columns = [
                part.column("doc_id"), pa.array(words.counts.astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(bounds), pa.array(term[start].view(np.int64))),
                pa.ListArray.from_arrays(pa.array(bounds), pa.array(count.astype(np.int64))),
            ]
            batch = pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "tfs"])
            yield batch.filter(pa.array(words.counts > 0))

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return chosen.mapInArrow(run, "doc_id long, n long, terms array<long>, tfs array<long>")


# ---------------------------------------------------------------- ball trees


class Rows:
    """Sparse vectors: terms and values of row i at ptr[i]..ptr[i + 1] - 1; no row is empty."""

    def __init__(self, ptr: np.ndarray, term: np.ndarray, value: np.ndarray):
        self.ptr, self.term, self.value = ptr, term, value

    def take(self, rows: np.ndarray) -> Rows:
        sizes = self.ptr[rows + 1] - self.ptr[rows]
        ptr = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(ptr[-1]) + np.repeat(self.ptr[rows] - ptr[:-1], sizes)
        return Rows(ptr, self.term[at], self.value[at])

    def sums(self, each: np.ndarray) -> np.ndarray:
        return np.add.reduceat(each, self.ptr[:-1])


class BallTree:
    """A ball tree over the rows, which are put into the order of its leaves."""

    def __init__(self, rows: Rows, weight: np.ndarray, leaf: int = LEAF):
        self.width = len(weight)
        scaled = Rows(rows.ptr, rows.term, rows.value * weight[rows.term].astype(np.float64))
        self.order = np.arange(len(rows.ptr) - 1)
        self.nodes = [(0, len(self.order), -1)]  # first row, end row, left child (the right one follows), -1 in a leaf
        radii: list[float] = []
        centres: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for k, (start, end, _) in enumerate(self.nodes):  # grows meanwhile
            held = scaled.take(self.order[start:end])
            radius, centre, ahead = self.describe(held)
            radii.append(radius)
            centres.append(centre)
            if end - start > leaf and radius > 0:
                self.order[start:end] = self.order[start:end][np.argsort(ahead, kind="stable")]
                middle = (start + end) // 2
                self.nodes[k] = (start, end, len(self.nodes))
                self.nodes += [(start, middle, -1), (middle, end, -1)]
        term = np.concatenate([c[0] for c in centres])
        by_term = np.argsort(term, kind="stable")
        self.node = np.repeat(np.arange(len(centres)), [len(c[0]) for c in centres])[by_term]
        self.centre = np.concatenate([c[1] for c in centres])[by_term]
        self.reach = np.concatenate([c[2] for c in centres])[by_term]
        self.ptr = np.searchsorted(term[by_term], np.arange(self.width + 1))
        self.radii = np.array(radii)
        self.rows = rows.take(self.order)

    def describe(self, held: Rows) -> tuple[float, tuple, np.ndarray]:
        """Radius, (terms, centroid, centroid + radius of each term), and how much nearer each member is to one far member than to another."""
        n = len(held.ptr) - 1
        centre = np.bincount(held.term, held.value, self.width) / n
        farthest = np.zeros(self.width)
        np.maximum.at(farthest, held.term, held.value)
        there = np.flatnonzero(farthest)
        sparse = (there, centre[there], farthest[there])
        length = held.sums(held.value**2)
        middle = centre @ centre
        apart = length - 2 * held.sums(held.value * centre[held.term]) + middle
        if len(there) == held.ptr[1] and (held.value == farthest[held.term]).all() and len(held.term) == n * len(there):
            return 0.0, sparse, apart  # all members are equal
        radius = float(np.sqrt(np.maximum(apart, 0).max() + ROUNDING * (length.max() + middle)))
        away = self.from_member(held, int(np.argmax(apart)), length)
        return radius, sparse, away - self.from_member(held, int(np.argmax(away)), length)

    def from_member(self, held: Rows, k: int, length: np.ndarray) -> np.ndarray:
        dense = np.zeros(self.width)
        at = slice(held.ptr[k], held.ptr[k + 1])
        dense[held.term[at]] = held.value[at]
        return length - 2 * held.sums(held.value * dense[held.term])

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """What no member of each node exceeds for the item of these terms."""
        spans = [slice(self.ptr[t], self.ptr[t + 1]) for t in query.tolist()]
        node = np.concatenate([self.node[s] for s in spans])
        near = np.bincount(node, np.concatenate([self.centre[s] for s in spans]), len(self.nodes))
        most = np.bincount(node, np.concatenate([self.reach[s] for s in spans]), len(self.nodes))
        return np.minimum(near + np.sqrt(len(query)) * self.radii, most) * (1 + ROUNDING)

    def search(self, query: np.ndarray, dense: np.ndarray, ids: list, best: Best) -> int:
        """Offers all rows that may be among the best; returns how many were scored.  `dense` has the weights of the query's terms."""
        bounds = self.bounds(query)
        open_nodes = [(-bounds[0], 0)]
        scored = 0
        while open_nodes:
            bound, k = heapq.heappop(open_nodes)
            if -bound < best.floor:
                break
            start, end, child = self.nodes[k]
            if child < 0:
                a, b = self.rows.ptr[start], self.rows.ptr[end]
                products = self.rows.value[a:b] * dense[self.rows.term[a:b]]
                scores = np.add.reduceat(products, self.rows.ptr[start:end] - a)
                scored += end - start
                for i in np.flatnonzero(scores >= best.floor).tolist():
                    best.offer(int(scores[i]), ids[self.order[start + i]])
            else:
                for c in (child, child + 1):
                    limit = min(bounds[c], -bound)
                    if limit >= best.floor:
                        heapq.heappush(open_nodes, (-limit, c))
        return scored


class Best:
    """The TOP best (score, id) seen; ties go to the smaller id, none comes last."""

    def __init__(self, top: int, least: int = 1):
        self.top, self.least, self.held = top, least, []
        self.floor = least  # a score that is worth offering

    def offer(self, score: int, doc_id: int | None) -> None:
        entry = (score, doc_id is not None, -(doc_id or 0))
        if len(self.held) < self.top:
            heapq.heappush(self.held, entry)
        elif entry > self.held[0]:
            heapq.heapreplace(self.held, entry)
        if len(self.held) == self.top:
            self.floor = max(self.least, self.held[0][0])


class Queries:
    """A block of items: the sorted terms of all, their weights, and each item's terms by place."""

    def __init__(self, asked: pa.Table):
        item, term, weight = (asked.column(c).to_numpy() for c in ("item_id", "term", "w"))
        self.terms, first = np.unique(term, return_index=True)
        self.weight = weight[first]
        order = np.argsort(item, kind="stable")
        self.ids, starts = np.unique(item[order], return_index=True)
        self.items = np.split(np.searchsorted(self.terms, term[order]), starts[1:])

    def rows(self, batch: pa.RecordBatch, docs: int, words: int) -> tuple[Rows, np.ndarray]:
        """Document vectors (before weights) over the block's terms and the places of their documents; others have score 0."""
        terms, tfs = batch.column("terms"), batch.column("tfs")
        term, tf = terms.flatten().to_numpy(), tfs.flatten().to_numpy()
        bounds = np.frombuffer(terms.buffers()[1], np.int32)[terms.offset : terms.offset + len(terms) + 1]
        n = np.repeat(batch.column("n").to_numpy(), np.diff(bounds))
        text = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
        place = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
        known = self.terms[place] == term
        place, tf, n, text = place[known], tf[known], n[known], text[known]
        value = (1_000_000_000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // words))
        held, starts = np.unique(text, return_index=True)
        return Rows(np.append(starts, len(text)), place, value), held

    def search(self, batches: Iterator[pa.RecordBatch], docs: int, words: int, top: int, block: int, leaf: int) -> tuple[list[Best], list[int]]:
        """The best documents of every item over all batches, and (documents scored, documents) in all."""
        best = [Best(top) for _ in self.items]
        dense = np.zeros(len(self.terms), np.int64)
        seen = [0, 0]
        for whole in batches:
            for start in range(0, whole.num_rows, block):
                rows, held = self.rows(whole.slice(start, block), docs, words)
                if not len(held):
                    continue
                ids = whole.column("doc_id").slice(start, block).take(pa.array(held)).to_pylist()
                tree = BallTree(rows, self.weight, leaf)
                for query, found in zip(self.items, best, strict=True):
                    dense[query] = self.weight[query]
                    seen[0] += tree.search(query, dense, ids, found)
                    dense[query] = 0
                seen[1] += len(held) * len(self.items)
        return best, seen


# ---------------------------------------------------------------- search


def search_block(postings: DataFrame, asked: pa.Table, docs: int, words: int, top: int, block: int, leaf: int) -> DataFrame:
    """(item_id, doc_id, score, task): every task's best for one block of items."""
    sent = postings.sparkSession.sparkContext.broadcast(asked)  # about QUERY_TERMS rows of 24 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        queries = Queries(sent.value)
        best, _ = queries.search(batches, docs, words, top, block, leaf)
        out: tuple[list, list, list] = ([], [], [])
        for item, found in zip(queries.ids.tolist(), best, strict=True):
            for score, named, doc_id in found.held:
                out[0].append(item)
                out[1].append(-doc_id if named else None)
                out[2].append(score)
        task = pa.array([TaskContext.get().partitionId()] * len(out[0]), pa.int64())
        yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in out], task], ["item_id", "doc_id", "score", "task"])

    return postings.mapInArrow(run, "item_id long, doc_id long, score long, task long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, query_terms: int = QUERY_TERMS, block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` best documents of every item."""
    asked = written(item_terms(items), "asked")
    postings = written(postings_of(docs, mask_of(asked)), "postings")
    n_docs, n_words = postings.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    wanted = asked.groupBy("term").agg(F.count(F.lit(1)).alias("n_items"))
    weight = F.floor(F.lit(1000) * F.log(F.lit(2 * n_docs + 2).cast("double") / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weights = written(wanted.join(df, "term").select("term", "n_items", weight.alias("w")).where("w > 0"), "weights")
    weighted = class_join(asked, weights, ["term"], ["w"], "n_items", ["item_id"])
    blocks = max(1, -(-weighted.count() // query_terms))
    queries = written(weighted.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks))), "queries")
    found = None
    for k in range(blocks):
        block_rows = queries.where(F.col("block") == k).select("item_id", "term", "w").toArrow()
        if block_rows.num_rows:
            part = written(search_block(postings, block_rows, n_docs, n_words, top, block, leaf), "best")
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = asked.sparkSession.createDataFrame([], "item_id long, doc_id long, score long, task long")
    group = F.floor(F.col("task") / SPREAD)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    few = found.withColumn("group", group).withColumn("nth", F.row_number().over(Window.partitionBy("item_id", "group").orderBy(*order)))
    ranked = few.where(F.col("nth") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
