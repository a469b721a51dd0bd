"""Packing: shortest-pack-first over the length histogram.

Documents become ids by a tokenizer, followed by an end id, and are cut into pieces of the
sequence length; what is left over is packed with others. Only the histogram of piece lengths (at
most as many rows as a sequence has ids) reaches the driver. There lengths are placed longest
first, always onto the packs with the most room, and packs with the same content are one pattern
with a count. Pieces of a length are numbered without a global sort, and a piece's number says
which pattern's slot it fills.

Where the order of documents matters, stored documents are packed in ranges of ``RANGE`` pieces in
the order of files and of rows in files, each range by itself in a task. Ids of sequences rise with
the ranges; inside a range the order is free.

Defined results: null and empty texts are the end id alone; repeated rows are packed each; ties in
length go by place in the table, so any order is valid; a null doc_id is kept. Other columns are
ignored. An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import batch_of, in_batches
from aerolake.plans.tables import stage
from aerolake.sources.order import number_rows

RANGE = 4096  # pieces packed together where the order of documents matters
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary"
)

PLACE = "file_no bigint, file string, row bigint"


def _pieces(batches: Iterator[pa.RecordBatch], vocabulary: str, end: int, size: int, keep: bool):
    from aerolake.llm.tokens import chunk_ids, ids_of_texts

    narrow = max(chunk_ids(vocabulary).tokenizer.get_vocab_size(), end + 1) <= 2**16
    for batch in batches:
        keys = batch.column(0).to_pylist()
        carried = list(batch.schema)[2:]
        others = list(zip(*(c.to_pylist() for c in batch.columns[2:]))) or [()] * len(keys)
        rows: list[tuple] = []
        held = 0
        for key, other, ids in zip(keys, others, ids_of_texts(batch.column(1), vocabulary)):
            raw = memoryview(np.append(ids, np.uint32(end)).astype("<u4").tobytes())
            total = len(raw) // 4
            for start in range(0, total, size):
                part = raw[4 * start : 4 * (start + size)]
                held += len(part)
                kept = ids_bytes(part, narrow) if keep else None
                rows.append((key, start, len(part) // 4, zlib.crc32(part), total, kept, *other))
            if held > 16_000_000 and keep:
                yield _piece_batch(rows, carried)
                rows, held = [], 0
        if rows:
            yield _piece_batch(rows, carried)
        pa.default_memory_pool().release_unused()


def ids_bytes(part: memoryview, narrow: bool) -> bytes:
    """32-bit ids as they are, or in 16 bits."""
    return np.frombuffer(part, "<u4").astype("<u2").tobytes() if narrow else bytes(part)


def _piece_batch(rows: list[tuple], carried: list[pa.Field]) -> pa.RecordBatch:
    names = [part.split()[0] for part in PIECES.split(", ")] + [f.name for f in carried]
    kinds = [pa.int64()] * 5 + [pa.binary()] + [f.type for f in carried]
    return batch_of({n: (list(v), k) for n, v, k in zip(names, zip(*rows), kinds)})


def pieces_of(
    docs: DataFrame,
    vocabulary: str,
    end: int = 2,
    size: int = 4096,
    keep_ids: bool = True,
    ordered: bool = False,
) -> DataFrame:
    """Pieces (``PIECES``) of every document; ``ordered`` adds its file and row (``PLACE``).

    The checksum is of little-endian unsigned 32-bit ids; the ids themselves are kept in 16 bits
    if the vocabulary allows it.
    """
    place = [
        F.regexp_extract("_metadata.file_name", "^part-([0-9]+)", 1).try_cast("bigint").alias("file_no"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    ]
    rows = docs.select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string"), *(place if ordered else [])
    )
    work = partial(_pieces, vocabulary=vocabulary, end=end, size=size, keep=keep_ids)
    return in_batches(rows, work, f"{PIECES}, {PLACE}" if ordered else PIECES)


@dataclass
class Pattern:
    count: int
    runs: list[tuple[int, int]]  # (length, how often in a row)


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[Pattern]:
    """Patterns of lengths that fit a sequence, with how often each is used.

    Each length goes onto the packs with the most room. A new pack is the one with the most
    room until it is no longer, so it takes several pieces of a length at once.
    """
    by_room: dict[int, list[Pattern]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max(by_room, default=0)
            if room < length:
                copies = size // length
                if left >= copies:
                    new = Pattern(left // copies, [(length, copies)])
                    by_room.setdefault(size - length * copies, []).append(new)
                if left % copies:
                    new = Pattern(1, [(length, left % copies)])
                    by_room.setdefault(size - length * (left % copies), []).append(new)
                break
            pattern = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
            used = min(left, pattern.count)
            if used < pattern.count:
                rest = Pattern(pattern.count - used, pattern.runs)
                by_room.setdefault(room, []).append(rest)
            ahead = (room - max(by_room, default=0)) // length + 1
            copies = max(min(room // length, left // used, ahead), 1)
            grown = Pattern(used, [*pattern.runs, (length, copies)])
            by_room.setdefault(room - length * copies, []).append(grown)
            left -= used * copies
    return [pattern for patterns in by_room.values() for pattern in patterns]


@dataclass
class Slots:
    """Where the pieces of each length go: sorted by length, then by number within the length."""

    size: int
    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, histogram: dict[int, int], size: int) -> Slots:
        rows, given, sequence = [], dict.fromkeys(histogram, 0), 0
        for pattern in shortest_pack_first(histogram, size):
            offset = 0
            for length, copies in pattern.runs:
                for _ in range(copies):
                    rows.append((length, given[length], sequence, offset))
                    given[length] += pattern.count
                    offset += length
            sequence += pattern.count
        if given != dict(histogram):
            raise AssertionError("patterns do not hold every piece once")
        columns = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4).T
        return cls(size, *columns)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # one number of both: a length has far fewer than 2 ** 44 pieces
        key = (self.length << 44) + self.first
        at = np.searchsorted(key, (length << 44) + rank, side="right") - 1
        return self.sequence[at] + rank - self.first[at], self.offset[at]


def _assign(batches: Iterator[pa.RecordBatch], slots: Slots, names: list[str]):
    for batch in batches:
        columns = dict(zip(batch.schema.names, batch.columns))
        length = columns["length"].to_numpy(zero_copy_only=False)
        rank = columns.pop("_rank").to_numpy(zero_copy_only=False)
        sequence, offset = slots.find(length, rank)
        columns["sequence_id"] = pa.array(sequence, pa.int64())
        columns["offset"] = pa.array(offset, pa.int64())
        yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)


_KEPT = ["piece", "doc_id", "start", "length", "ids_crc32", "doc_tokens"]


def stored_pieces(
    docs: DataFrame, vocabulary: str, end: int, size: int, keep_ids: bool, ordered: bool = False
) -> DataFrame:
    """The pieces as a stored table, each with a number of its own (``piece``)."""
    made = pieces_of(docs, vocabulary, end, size, keep_ids, ordered)
    return stage(made.withColumn("piece", F.monotonically_increasing_id()), "pieces")


def pack(pieces: DataFrame, size: int = 4096) -> DataFrame:
    """Stored pieces with sequence_id and offset; ids stay out of the shuffle."""
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    slots = Slots.of(histogram, size)
    light = pieces.select(*_KEPT, F.shiftright("piece", 13).alias("_chunk"))
    ranked = number_rows(light, ["length", "_chunk"], ["piece"], "_rank", per=["length"])
    names = [*_KEPT, "sequence_id", "offset"]
    schema = ", ".join(f"{n} bigint" for n in names)
    return in_batches(
        ranked.select(*_KEPT, "_rank"), partial(_assign, slots=slots, names=names), schema
    )


def _assign_ranges(batches: Iterator[pa.RecordBatch], most: int, size: int):
    """Sequences of each range; rows come in the order of ranges, each of at most ``most`` pieces."""

    def packed(rows: pa.Table) -> pa.RecordBatch:
        length = rows.column("length").to_numpy()
        order = np.argsort(length, kind="stable")
        values, first, counts = np.unique(length[order], return_index=True, return_counts=True)
        rank = np.empty(len(length), np.int64)
        rank[order] = np.arange(len(length)) - np.repeat(first, counts)
        slots = Slots.of(dict(zip(values.tolist(), counts.tolist())), size)
        sequence, offset = slots.find(length, rank)
        return batch_of(
            {
                "piece": (rows.column("piece").to_numpy(), pa.int64()),
                "sequence_id": (rows.column("range")[0].as_py() * most + sequence, pa.int64()),
                "offset": (offset, pa.int64()),
            }
        )

    held: list[pa.RecordBatch] = []
    for batch in batches:
        ranges = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(ranges)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ranges)]):
            if a == b:
                continue
            if held and held[0].column(0)[0].as_py() != ranges[a]:
                yield packed(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield packed(pa.Table.from_batches(held))


def pack_in_order(pieces: DataFrame, size: int = 4096, most: int | None = None) -> DataFrame:
    """piece, sequence_id and offset of stored pieces with their place, packed in ranges."""
    most = most or RANGE
    files = ["file_no", "file"]
    light = pieces.select("piece", "length", "start", *(F.coalesce(c, F.lit(d)).alias(c) for c, d in zip(files, (0, ""))),
                          "row", F.shiftright("row", 13).alias("_chunk"))
    placed = number_rows(light, [*files, "_chunk"], ["row", "start"]).select(
        F.floor(F.col("position") / most).cast("bigint").alias("range"), "position", "piece", "length"
    )
    together = placed.repartition("range").sortWithinPartitions("range", "position")
    work = partial(_assign_ranges, most=most, size=size)
    return in_batches(together, work, "piece bigint, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, vocabulary: str, end: int = 2, size: int = 4096) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return pack(stored_pieces(docs, vocabulary, end, size, False), size).drop("piece")


def sequences(
    docs: DataFrame, vocabulary: str, end: int = 2, size: int = 4096, ordered: bool = False
) -> DataFrame:
    """sequence_id, n_tokens, ids and pieces (offset, doc_id, start, length) of every sequence.

    ``ids`` are the bytes of little-endian ids of 16 bits, or 32 for larger vocabularies. A group
    is one sequence, at most ``size`` ids. ``ordered``: sequence_id follows the order of ``docs``,
    a table of Parquet files, by ranges of ``RANGE`` pieces.
    """
    stored = stored_pieces(docs, vocabulary, end, size, True, ordered)
    packed = pack_in_order(stored, size) if ordered else pack(stored, size)
    packed = packed.select("piece", "sequence_id", "offset")
    filled = stored.join(packed, "piece").groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.sort_array(
            F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids"))
        ).alias("parts"),
    )
    empty = F.lit(b"")
    return filled.select(
        "sequence_id",
        "n_tokens",
        F.aggregate("parts", empty, lambda ids, part: F.concat(ids, part["ids"])).alias("ids"),
        F.transform(
            "parts", lambda p: F.struct(p["offset"], p["doc_id"], p["start"], p["length"])
        ).alias("pieces"),
    )
