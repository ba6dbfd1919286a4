"""Removal of repeated passages: every byte in a 100-byte string that also starts earlier.

Strings are grouped before they are sorted.  A window of LENGTH bytes has an anchor, the GRAM-byte run
of least hash in it (the leftmost of equal ones), which depends on the window's bytes alone; so equal
windows have equal anchors at equal places.  The windows of one document that share an anchor are
consecutive and make a piece, LENGTH bytes and a little more.  A piece is divided by the place of the anchor in
the window, and the bytes common to all windows of a part are its key: equal windows meet under
equal keys, and a key that occurs once holds nothing repeated.

Under a key, parts of equal text are one class, found by a combined minimum before any shuffle; all but the
class's first occurrence are repeats as a whole.  What differs is decided by suffix order: the distinct
texts of a key, first occurrences all, form one text with separators, whose suffix array is built by
linear grouping (`suffix_groups`), for all keys of a task in step.  Neighbours in that order with LENGTH equal
bytes are equal windows; each set of them keeps the one that starts first and the others are repeats.

A key with more than TEXTS distinct texts (a passage in very many documents, with other text around
it) is divided further, into places 8 apart and then one by one, where equal keys are equal windows.  So
no key, however frequent, goes to one task whole, and none is left out.

Two passes over the documents find the parts: one counts keys, and the other keeps parts whose
key occurs more than once according to a bit table of fixed size.  Only texts of undecided parts and
of documents with repeats are shuffled.

Defined results: null and empty texts have 0 bytes, no spans and the hash of nothing; matches never
cross documents; rows that share a doc_id are each judged against smaller ids and themselves, never
against one another; rows without a doc_id stay whole and remove nothing elsewhere; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import class_join, flat, mix, one_value, partitions, prefix_hash, range_hash, slices, written
from tablelift.llm.suffix_groups import suffix_arrays

LENGTH = 100
GRAM = 24
PLACES = LENGTH - GRAM + 1  # where an anchor may stand in a window
TEXTS = 8  # distinct texts of one key that are sorted together
BITS = 27  # a bit table of 16 MB
VALUE_BITS = 40  # of a key, by which keys are counted; collisions only let more through
SORT_BYTES = 1 << 20  # text whose suffixes are sorted in step
BROADCAST_IDS = 2_000_000
# Levels: how wide the groups of anchor places are that share a key.
HALVES, EIGHTHS, SINGLES = 39, 8, 1


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of all texts: (hash of the anchor, its place, first window, last window), in byte positions."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none.astype(np.uint64), none, none, none
    sums = prefix_hash(data, 1)
    at = np.arange(len(data) - GRAM + 1)
    value = range_hash(sums, at, at + GRAM)
    bits = max(24, int(len(data)).bit_length())
    low = np.uint64((1 << bits) - 1)
    least = value & ~low | at.astype(np.uint64)  # by hash, then from the left
    span, windows = 1, len(data) - LENGTH + 1
    while 2 * span <= PLACES:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[:windows], least[PLACES - span : PLACES - span + windows])
    place = (least & low).astype(np.int64)
    ends = np.repeat(offsets[1:], np.diff(offsets))[:windows]
    valid = np.arange(windows) + LENGTH <= ends
    begin = valid.copy()
    begin[1:] &= ~valid[:-1] | (place[1:] != place[:-1])
    # A window of the next text never shares its place with this one's: places lie inside the window.
    first = np.flatnonzero(begin)
    stop = valid.copy()
    stop[:-1] &= ~valid[1:] | (place[1:] != place[:-1])
    last = np.flatnonzero(stop)
    return value[place[first]], place[first], first, last


def divide(place: np.ndarray, first: np.ndarray, last: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Parts of pieces by anchor place: (index of the piece, number of the group, first, last window)."""
    high, low = (place - first) // width, (place - last) // width  # an earlier window has the anchor further on
    number = high - low + 1
    piece = np.repeat(np.arange(len(place)), number)
    within = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    group = high[piece] - within
    part_first = np.maximum(first[piece], place[piece] - (group + 1) * width + 1)
    part_last = np.minimum(last[piece], place[piece] - group * width)
    return piece, group, part_first, part_last


def part_keys(sums: np.ndarray, place: np.ndarray, group: np.ndarray, width: int) -> np.ndarray:
    """Hash of the bytes that all windows of a group have in common, and of the group."""
    start = place - group * width
    common = range_hash(sums, start, place - np.minimum((group + 1) * width - 1, PLACES - 1) + LENGTH)
    return mix(common + (group * 2 + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(width))


def bit_table(values: DataFrame) -> np.ndarray:
    """A table of 2**BITS bits with those of the VALUE_BITS-bit numbers in column `value` set, by their first bits."""
    at = F.shiftright("value", VALUE_BITS - BITS)
    bit = F.expr(f"shiftleft(1L, cast((shiftright(value, {VALUE_BITS - BITS}) & 31) as int))")
    words = values.groupBy(F.shiftright(at, 5).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << (BITS - 5), np.uint32)
        for batch in batches:
            table[batch.column("word").to_numpy()] = batch.column("bits").to_numpy().astype(np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array([table.tobytes()], pa.binary())], ["table"])

    made = one_value(words.repartition(1).mapInArrow(run, "table binary"))
    return np.zeros(1 << (BITS - 5), np.uint32) if made is None else np.frombuffer(made, np.uint32)


def has_bit(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - BITS)
    return (table[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.uint32) & np.uint32(1)).astype(bool)


def keyed_parts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, anchor place, first and last window) of the halves of all pieces, and the running hash of the bytes."""
    _, place, first, last = anchors(data, offsets)
    sums = prefix_hash(data, 2)
    piece, group, first, last = divide(place, first, last, HALVES)
    return part_keys(sums, place[piece], group, HALVES), place[piece], first, last, sums


def repeated_keys(docs: DataFrame) -> DataFrame:
    """(value): the first VALUE_BITS bits of the keys that occur more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found, counts = np.unique(keyed_parts(*flat(part.column("text")))[0] >> np.uint64(64 - VALUE_BITS), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(counts.astype(np.int64))], ["value", "n"])

    counted = docs.select("text").mapInArrow(run, "value long, n long").groupBy("value").agg(F.sum("n").alias("n"))
    return counted.where("n > 1").select("value")


def repeated_parts(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """Parts whose key may occur twice: (key, same, doc, place, first, last, own).

    Positions count from the document's start.  `same` is the hash of the part's text.  Within one document the
    first of equal parts is passed on and the others are repeats already (`own`).
    """
    shared = docs.sparkSession.sparkContext.broadcast(table)  # 2**BITS bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in slices(batches, "text"):
            data, offsets = flat(batch.column("text"))
            key, place, first, last, sums = keyed_parts(data, offsets)
            known = has_bit(table, key)
            key, place, first, last = key[known], place[known], first[known], last[known]
            same = range_hash(sums, first, last + LENGTH)
            row = np.searchsorted(offsets, first, "right") - 1
            order = np.lexsort((first, same, key, row))
            again = np.zeros(len(order), bool)
            again[1:] = np.all([x[order][1:] == x[order][:-1] for x in (row, key, same)], axis=0)
            own = np.zeros(len(order), bool)
            own[order] = again
            start = offsets[row]
            ids = batch.column("doc_id").take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.astype(np.int64)), pa.array(same.astype(np.int64)), ids.cast(pa.int64()), batch.column("row").take(pa.array(row))]
                + [pa.array((x - start).astype(np.int32)) for x in (place, first, last)] + [pa.array(own)],
                ["key", "same", "doc", "row", "place", "first", "last", "own"],
            )

    return docs.select("doc_id", "text", row_hash()).mapInArrow(run, "key long, same long, doc long, row long, place int, first int, last int, own boolean")


def row_hash() -> Column:
    """What tells rows of one doc_id apart; rows of equal text are one."""
    return F.xxhash64("text").alias("row")


def spans_of(parts: DataFrame) -> DataFrame:
    """(doc, row, start, end) of the bytes of parts that are repeats as a whole."""
    return parts.select("doc", "row", F.col("first").alias("start"), (F.col("last") + LENGTH).alias("end"))


def with_texts(docs: DataFrame, parts: DataFrame) -> DataFrame:
    """(key, doc, row, place, first, texts, text) of the parts: their bytes, cut out of the documents."""
    lists = written(parts.groupBy("doc", "row").agg(F.collect_list(F.struct("key", "place", "first", "last", "texts")).alias("parts")), "parts")
    lists = lists.withColumnRenamed("doc", "doc_id")  # one document's parts, fewer than its bytes
    ids = lists.select("doc_id", "row")
    chosen = docs.select("doc_id", "text", row_hash())
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:  # 16 bytes each
        chosen = chosen.join(F.broadcast(ids), ["doc_id", "row"], "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            data, offsets = flat(part.column("text"))
            raw = data.tobytes()
            lists = part.column("parts")
            row = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
            fields = lists.flatten()
            key, place, first, last, number = (fields.field(i) for i in range(5))
            start, end = offsets[row] + first.to_numpy(), offsets[row] + last.to_numpy() + LENGTH
            texts = [raw[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
            taken = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [key, part.column("doc_id").cast(pa.int64()).take(taken), part.column("row").take(taken), place, first, number, pa.array(texts, pa.binary())],
                ["key", "doc", "row", "place", "first", "texts", "text"],
            )

    return chosen.join(lists, ["doc_id", "row"]).mapInArrow(run, "key long, doc long, row long, place int, first int, texts long, text binary")


def subdivide(parts: DataFrame, width: int) -> DataFrame:
    """The parts (key, doc, row, place, first, text) of crowded keys, divided into groups of `width` places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            data, offsets = flat(part.column("text"))
            shift = offsets[:-1] - part.column("first").to_numpy()  # document position to place in `data`
            first = offsets[:-1]
            last = offsets[1:] - LENGTH
            place = part.column("place").to_numpy() + shift
            row, group, first, last = divide(place, first, last, width)  # `row` counts within the batch
            key = mix(part.column("key").to_numpy().astype(np.uint64)[row] ^ part_keys(prefix_hash(data, 3), place[row], group, width))
            raw = data.tobytes()
            texts = [raw[a : b + LENGTH] for a, b in zip(first.tolist(), last.tolist(), strict=True)]
            taken = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.astype(np.int64)), part.column("doc").take(taken), part.column("row").take(taken), part.column("place").take(taken), pa.array((first - shift[row]).astype(np.int32)), pa.array(texts, pa.binary())],
                ["key", "doc", "row", "place", "first", "text"],
            )

    return parts.select("key", "doc", "row", "place", "first", "text").mapInArrow(run, "key long, doc long, row long, place int, first int, text binary")


def collapse(parts: DataFrame, go_on: bool) -> tuple[DataFrame, DataFrame | None]:
    """(spans of repeats, parts still open with the number of texts of their key), equal texts of a key being one.

    A class's first occurrence goes on, if its key has other texts, in each row of the smallest doc; all
    others are repeats as a whole.  The groupings combine before they shuffle.
    """
    parts = parts.withColumn("same", F.xxhash64("text"))
    marked = written(parts, "divided")
    classes = marked.groupBy("key", "same").agg(F.min("doc").alias("lead"), F.count(F.lit(1)).alias("n"))
    classes = written(classes, "classes")
    copied = marked.select("key", "same", "doc", "row", "first", F.length("text").alias("size"))
    copied = written(class_join(copied, classes.where("n > 1"), ["key", "same"], ["lead"], "n", ["doc", "first"]), "copied")
    begun = copied.where("doc = lead").groupBy("key", "same", "doc", "row").agg(F.min("first").alias("begun"))
    later = copied.where("doc = lead").join(begun, ["key", "same", "doc", "row"]).where("first > begun").drop("begun")
    copied = copied.where("doc > lead").unionByName(later)
    spans = copied.select("doc", "row", F.col("first").alias("start"), (F.col("first") + F.col("size")).cast("int").alias("end"))
    if not go_on:
        return spans, None
    several = classes.groupBy("key").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1").select("key")
    leads = marked.join(classes.join(several, "key").select("key", "same", F.col("lead").alias("doc")), ["key", "same", "doc"])
    firsts = written(leads.groupBy("key", "same", "doc", "row").agg(F.min("first").alias("first")), "firsts")
    texts = firsts.groupBy("key").agg(F.count(F.lit(1)).alias("texts"))
    still = marked.join(firsts.join(texts, "key"), ["key", "same", "doc", "row", "first"]).dropDuplicates(["key", "same", "row"])
    return spans, written(still.select("key", "doc", "row", "place", "first", "text", "texts"), "open")


def equal_windows(texts: list[bytes], keys: np.ndarray, doc: np.ndarray, first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc, row, start, end) of windows that equal one of a smaller doc or an earlier one of their row, under the same key.

    The texts come ordered by key; `rows` tells rows of one doc apart.

    The texts of a key are one string with separators; neighbours in suffix order with LENGTH equal bytes are equal windows.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1  # every text is followed by a separator, symbol 0
    symbols = np.zeros(int((sizes + 1).sum()), np.uint16)
    inside = np.ones(len(symbols), bool)
    inside[begins + sizes] = False
    symbols[inside] = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint16) + 1
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    bounds = np.append(begins[new], len(symbols))
    order = suffix_arrays(symbols, bounds)
    row = np.repeat(np.arange(len(texts)), sizes + 1)
    whole = (np.arange(len(symbols)) - begins[row] + LENGTH) <= sizes[row]  # positions that begin a window
    order = order[whole[order]]
    if len(order) < 2:
        return doc[:0], rows[:0], first[:0], first[:0]
    # Suffixes between two equal windows are equal to them too, so leaving out the others loses no neighbours.
    same = keys[row[order[1:]]] == keys[row[order[:-1]]]
    a, b = order[:-1][same], order[1:][same]
    alike = np.arange(len(a))
    for step in range(0, LENGTH, 4):
        eight = np.zeros(len(alike), bool)
        for k in range(step, step + 4):
            eight |= symbols[a[alike] + k] != symbols[b[alike] + k]
        alike = alike[~eight]
    joined = np.zeros(len(order), bool)  # equal to the suffix before
    joined[np.flatnonzero(same)[alike] + 1] = True
    class_of = np.cumsum(~joined)
    at_doc, at_row, at = doc[row[order]], rows[row[order]], first[row[order]] + (order - begins[row[order]])
    by = np.lexsort((at, at_row, at_doc, class_of))
    set_of, by_doc, by_row, by_at = class_of[by], at_doc[by], at_row[by], at[by]
    fresh = np.ones(len(by), bool)
    fresh[1:] = set_of[1:] != set_of[:-1]
    leads = np.maximum.accumulate(np.where(fresh, np.arange(len(by)), 0))
    fresh[1:] |= (by_doc[1:] != by_doc[:-1]) | (by_row[1:] != by_row[:-1])
    begun = np.maximum.accumulate(np.where(fresh, np.arange(len(by)), 0))
    found = by[(by_doc != by_doc[leads]) | (by_at != by_at[begun])]
    found_doc, found_row, found_at = at_doc[found], at_row[found], at[found]
    rank = np.lexsort((found_at, found_row, found_doc))
    found_doc, found_row, found_at = found_doc[rank], found_row[rank], found_at[rank]
    begin = np.ones(len(rank), bool)
    begin[1:] = (found_doc[1:] != found_doc[:-1]) | (found_row[1:] != found_row[:-1]) | (found_at[1:] > found_at[:-1] + 1)
    starts = np.flatnonzero(begin)
    ends = np.append(starts[1:], len(rank)) - 1
    return found_doc[starts], found_row[starts], found_at[starts], found_at[ends] + LENGTH


def sorted_windows(parts: DataFrame) -> DataFrame:
    """(doc, row, start, end) of repeats among the different texts of each key, at most TEXTS per key."""
    dealt = parts.select("key", "doc", "row", "first", "text").repartition(partitions(parts.sparkSession), "key").sortWithinPartitions("key", "doc", "row", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def judge(table: pa.Table) -> Iterator[pa.RecordBatch]:
            keys, doc, first, row = (table.column(c).to_numpy() for c in ("key", "doc", "first", "row"))
            texts = table.column("text").to_pylist()
            # Keys of about equal size go through the rounds together.
            new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            stop = np.append(new[1:], len(keys))
            size = np.add.reduceat(np.array([len(t) for t in texts]), new)
            ranked = np.argsort(size, kind="stable")
            lot = np.cumsum(size[ranked]) // SORT_BYTES
            for chosen in np.split(ranked, np.flatnonzero(np.diff(lot)) + 1):
                rows = np.concatenate([np.arange(new[g], stop[g]) for g in chosen])
                found = equal_windows([texts[r] for r in rows], keys[rows], doc[rows], first[rows].astype(np.int64), row[rows])
                yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])] + [pa.array(x.astype(np.int32)) for x in found[2:]], ["doc", "row", "start", "end"])

        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            keys = batch.column("key").to_numpy()
            change = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            if held and rows >= 1 << 15:  # the part of this batch that ends the last key goes with it
                cut = 0 if batch.num_rows and keys[0] != held[-1].column("key")[-1].as_py() else int(change[0]) if len(change) else batch.num_rows
                held.append(batch.slice(0, cut))
                if cut < batch.num_rows:
                    yield from judge(pa.Table.from_batches(held))
                    held, rows = [], 0
                    batch = batch.slice(cut)
                else:
                    continue
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
        if held:
            yield from judge(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "doc long, row long, start int, end int")


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """The union of byte ranges as maximal runs."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    begin = np.ones(len(starts), bool)
    begin[1:] = starts[1:] > reach[:-1]
    at = np.flatnonzero(begin)
    return list(zip(starts[at].tolist(), reach[np.append(at[1:], len(starts)) - 1].tolist(), strict=True))


OUT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,end:int>>, kept binary"


def cut(docs: DataFrame, spans: DataFrame, texts: bool) -> DataFrame:
    """Every document with what is removed and what is left; `texts` adds the bytes left."""
    lists = spans.groupBy("doc", "row").agg(F.collect_set(F.struct("start", "end")).alias("spans"))  # within one text, whose copies have the same
    lists = written(lists.withColumnRenamed("doc", "doc_id"), "spans")
    ids = lists.select("doc_id", "row")
    chosen = docs.select("doc_id", "text", row_hash())
    kind = lists.schema["spans"].dataType
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:  # only documents with repeats are shuffled
        touched = chosen.join(F.broadcast(ids), ["doc_id", "row"], "left_semi").join(lists, ["doc_id", "row"])
        clean = chosen.join(F.broadcast(ids), ["doc_id", "row"], "left_anti").withColumn("spans", F.lit(None).cast(kind))
        rows = touched.select("doc_id", "text", "spans").unionByName(clean.select("doc_id", "text", "spans"))
    else:
        rows = chosen.join(lists, ["doc_id", "row"], "left").select("doc_id", "text", "spans")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            data, offsets = flat(part.column("text"))
            lists = part.column("spans")
            bounds, fields = lists.offsets.to_numpy(), lists.values
            starts, ends = fields.field(0).to_numpy(), fields.field(1).to_numpy()
            out: list[list] = [[] for _ in names[1:]]
            for i in range(part.num_rows):
                raw = data[offsets[i] : offsets[i + 1]].tobytes()
                a, b = starts[bounds[i] : bounds[i + 1]], ends[bounds[i] : bounds[i + 1]]
                runs = merged(a, b) if len(a) and lists[i].is_valid else []
                left = b"".join(raw[x:y] for x, y in zip([0, *[r[1] for r in runs]], [*[r[0] for r in runs], len(raw)], strict=True))
                row = (len(raw), len(raw) - len(left), len(runs), hashlib.sha256(left).hexdigest(), [{"start": x, "end": y} for x, y in runs], left if texts else None)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.binary()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(c, k) for c, k in zip(out, kinds, strict=True)]], names)

    return rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {OUT}")


def remove_repeats(docs: DataFrame, texts: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, the removed spans and, if wanted, the kept bytes."""
    numbered = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    table = bit_table(written(repeated_keys(numbered), "keys"))
    parts = written(repeated_parts(numbered, table), "repeated")
    leads = parts.where("NOT own")
    classes = leads.groupBy("key", "same").agg(F.min("doc").alias("lead"), F.count(F.lit(1)).alias("n"))
    classes = written(classes, "classes")
    several = classes.groupBy("key").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1")
    flagged = classes.join(written(several, "keys"), "key", "left").withColumn("open", F.col("classes").isNotNull()).where("n > 1 OR open")
    placed = class_join(leads, written(flagged, "flagged"), ["key", "same"], ["lead", "open"], "n", ["doc", "first"])
    placed = written(placed.where("doc > lead OR (doc = lead AND open)"), "placed")
    copies = placed.where("doc > lead")
    firsts = written(placed.where("doc = lead").dropDuplicates(["key", "same", "row"]), "firsts")
    counted = written(firsts.groupBy("key").agg(F.count(F.lit(1)).alias("texts")), "texts")
    firsts = class_join(firsts.select("key", "doc", "row", "place", "first", "last"), counted, ["key"], ["texts"], "texts", ["doc", "first"])
    halves = written(with_texts(numbered, firsts.select("key", "doc", "row", "place", "first", "last", "texts")), "halves")
    few = F.col("texts") <= TEXTS
    eighths_spans, eighths = collapse(subdivide(halves.where(~few), EIGHTHS), True)
    singles_spans, _ = collapse(subdivide(eighths.where(~few), SINGLES), False)
    decided = sorted_windows(halves.where(few).unionByName(eighths.where(few)))
    whole = spans_of(parts.where("own")).unionByName(spans_of(copies))
    return cut(docs, whole.unionByName(eighths_spans).unionByName(singles_spans).unionByName(decided), texts)
