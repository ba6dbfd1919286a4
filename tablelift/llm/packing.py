"""Token ids in binary form: best-fit-decreasing packing with a segment tree over free capacities.

Every document becomes its token ids (a public byte-level BPE, whose file is a parameter) and the
end id.  What exceeds a row of `length` ids is split at multiples of `length`, so nothing is lost and
`piece_at` tells where each piece stood in its document.  Pieces go, longest first, into the
fullest row that still has room: a segment tree over capacities 0..length counts the open rows of
each capacity and finds the least sufficient one in log2(length) steps.

Packing is done within a task for each `horizon` of ids, so memory is bounded by the horizon and
not by the partition; a retried task packs the same rows again, as its input has an order.

A row has: the ids as little-endian numbers padded with the end id to `length` (one line of an id
matrix), cumulative segment lengths from 0 to the ids used, the places where positions restart at
0, and for each segment its doc_id and first id within the document.

The pattern's engine recurses once per character of white space, and would overflow in a run of a million.
Runs of more than WHITE_RUN characters are therefore taken out before it sees the text, but for the last
character, which belongs to the next word, and are encoded WHITE_RUN characters at a time: the ids of
such a run are not the fewest, and nothing is lost.  All other texts have the ids of the pattern as it is.

Defined results: null and empty texts have the end id alone; ids may be of any plain type, and null ones
stay null in the lists; repeated documents are packed each; an empty table packs to no rows; texts that hold the name of a
special token are ordinary text; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tablelift.llm.common import slices

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern that belongs to the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LENGTH = 2048
HORIZON = 2 << 20  # ids packed together
SCHEMA = "pack_id long, n_tokens int, ids binary, cu_seqlens array<int>, resets array<int>, doc_ids array<{}>, piece_at array<long>"
WHITE_RUN = 4096
# Fixed value: the characters that the pattern's `\s` stands for.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_WHITE = re.compile(f"[{WHITE}]{{{WHITE_RUN + 1},}}")


def encoder(ranks_file: bytes):
    """The tokenizer of a rank file's bytes, and its end id (one beyond the ranks)."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks_file.splitlines() if line)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), max(ranks.values()) + 1


def token_ids(encoding, text: str) -> array:
    """The ids of a text; long white space goes past the pattern in pieces."""
    ids, start = array("I"), 0
    for run in LONG_WHITE.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids.extend(encoding.encode_ordinary(text[start : run.start()]))
        for at in range(run.start(), end, WHITE_RUN):
            ids.extend(encoding.encode_ordinary(text[at : min(end, at + WHITE_RUN)]))
        start = end
    ids.extend(encoding.encode_ordinary(text[start:]))
    return ids


class Capacities:
    """Open rows by free capacity; a segment tree answers which least capacity suffices."""

    def __init__(self, length: int):
        self.base = 1 << length.bit_length()
        self.open = bytearray(2 * self.base)  # does this part of the tree hold an open row?
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def put(self, capacity: int, row: int) -> None:
        held = self.rows[capacity]
        held.append(row)
        if len(held) == 1:
            node = self.base + capacity
            while node and not self.open[node]:
                self.open[node] = 1
                node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The (capacity, row) of least capacity >= need, removed; None if there is none."""
        node, tree = self.base + need, self.open
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node ^ 1]):
                node >>= 1
            if node <= 1:
                return None
            node ^= 1
            while node < self.base:
                node = 2 * node if tree[2 * node] else 2 * node + 1
        capacity = node - self.base
        row = self.rows[capacity].pop()
        if not self.rows[capacity]:
            while node and not (node < self.base and (tree[2 * node] or tree[2 * node + 1])):
                tree[node] = 0
                node >>= 1
        return capacity, row


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Rows as lists of indexes into `sizes`, every size at most `length`; longest first, best fit."""
    rows: list[list[int]] = []
    free = Capacities(length)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = free.take(sizes[i])
        if found is None:
            rows.append([])
            found = (length, len(rows) - 1)
        capacity, row = found
        rows[row].append(i)
        if capacity > sizes[i]:
            free.put(capacity - sizes[i], row)
    return rows


def pack_pieces(pieces: list[tuple[object, int, np.ndarray]], length: int, pad: int, first_id: int, id_type: pa.DataType) -> pa.RecordBatch:
    """Packed rows of the (doc_id, place in the document, ids) pieces."""
    rows = best_fit([len(p[2]) for p in pieces], length)
    kind = np.uint16 if pad < 1 << 16 else np.uint32
    ids, used, lengths, docs, at = [], [], [], [], []
    for row in rows:
        matrix_row = np.full(length, pad, kind)
        ends = np.cumsum([len(pieces[i][2]) for i in row])
        matrix_row[: ends[-1]] = np.concatenate([pieces[i][2] for i in row])
        ids.append(matrix_row.astype(np.dtype(kind).newbyteorder("<")).tobytes())
        used.append(int(ends[-1]))
        lengths.append([0, *ends.tolist()])
        docs.append([pieces[i][0] for i in row])
        at.append([pieces[i][1] for i in row])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(range(first_id, first_id + len(rows)), pa.int64()), pa.array(used, pa.int32()), pa.array(ids, pa.binary()),
            pa.array(lengths, pa.list_(pa.int32())), pa.array([x[:-1] for x in lengths], pa.list_(pa.int32())),
            pa.array(docs, pa.list_(id_type)), pa.array(at, pa.list_(pa.int64())),
        ],
        ["pack_id", "n_tokens", "ids", "cu_seqlens", "resets", "doc_ids", "piece_at"],
    )


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH, horizon: int = HORIZON) -> DataFrame:
    """Packed rows of all documents; `vocabulary` is read by the driver and sent to the tasks."""
    spark: SparkSession = docs.sparkSession
    ranks = spark.sparkContext.broadcast(Path(vocabulary).read_bytes())  # under 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoding, end = encoder(ranks.value)
        kind = np.uint16 if end < 1 << 16 else np.uint32
        pieces, held = [], 0
        next_id, id_type = TaskContext.get().partitionId() << 40, pa.null()
        for part in slices(batches, "text"):
            id_type = part.schema.field("doc_id").type
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                tokens = token_ids(encoding, text or "")
                tokens.append(end)
                ids = np.frombuffer(tokens, np.uint32).astype(kind)
                pieces += [(doc_id, at, ids[at : at + length]) for at in range(0, len(ids), length)]
                held += len(ids)
            if held >= horizon:
                packed = pack_pieces(pieces, length, end, next_id, id_type)
                next_id += packed.num_rows
                pieces, held = [], 0
                yield packed
        if pieces:
            yield pack_pieces(pieces, length, end, next_id, id_type)

    chosen = docs.select("doc_id", "text")
    return chosen.mapInArrow(run, SCHEMA.format(chosen.schema["doc_id"].dataType.simpleString()))


def documents_of(packed: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, piece_at, text bytes) of every segment: the way back, for checks and readers."""
    ranks = packed.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, end = encoder(ranks.value)
        kind = "<u2" if end < 1 << 16 else "<u4"
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            id_type = batch.schema.field("doc_ids").type.value_type
            for ids, bounds, docs, at in zip(*(batch.column(c).to_pylist() for c in ("ids", "cu_seqlens", "doc_ids", "piece_at")), strict=True):
                row = np.frombuffer(ids, kind)
                for k, doc_id in enumerate(docs):
                    tokens = row[bounds[k] : bounds[k + 1]]
                    out[0].append(doc_id)
                    out[1].append(at[k])
                    out[2].append(encoding.decode_bytes(tokens[tokens != end].tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], id_type), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], ["doc_id", "piece_at", "piece"]
            )

    id_kind = packed.schema["doc_ids"].dataType.elementType.simpleString()
    return packed.mapInArrow(run, f"doc_id {id_kind}, piece_at long, piece binary")
