"""Cross-tokenizer alignment of two tokenizers over exactly deduplicated texts.

Texts are shuffled whole, so that each distinct one is tokenised and aligned once; its copies weigh
its pair counts, and its measures go back to the documents by a SHA-256 of the text.

Both tokenizers start a new token at every space after something that is not white space: the first
parts text there before it merges, the second has no piece that holds a space after anything else.
A text is therefore a row of *units* cut at these places, and ids, groups and links of a text are
those of its units in order. A task numbers the distinct units of a slice of texts, so a unit is
tokenised once for each slice, or less, as a worker remembers recent ones. Units whose tokens do
not give back their bytes spoil the whole text.

Pair counts need no list of pairs in one place: a slice emits each of its pairs once with its
weighted count, these are summed over slices, compared with the highest of their second id, and
joined back to the slices, where units and then texts are summed.

Defined results: null and empty texts, and those that either tokenizer changes, have no tokens:
zeros, and an empty ``groups_sha256``. Every row of docs gives one row, repeated ones and those
without doc_id too. Other columns are ignored. An empty table gives no rows. Ties for the highest
count are all best.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import batch_of, in_batches
from aerolake.plans.tables import stage

SLICE_BYTES = 6_000_000  # of distinct texts that share one list of units
_REMEMBERED = 100_000  # units, for each of two generations
_ROWS = 50_000  # of a batch that goes back to Spark
_KEPT = ["key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

SLICES = (
    "slice bigint, kind int, at bigint, key binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint,"
    " groups_sha256 string, units binary, a bigint, b bigint, n bigint"
)
_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
TEXT, UNITS, PAIR = 0, 1, 2
MARKS = (",", "|", ";", "")  # after an id: in a side of a group, after one, after a group, after a unit
INSIDE, SIDE_END, GROUP_END, UNIT_END = range(4)
MEASURES = (
    "key binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string,"
    " n_best bigint, count_sum bigint"
)


# --- units -----------------------------------------------------------------------------------


def unit_starts(text: np.ndarray) -> np.ndarray:
    """Places of the spaces that follow a character other than white space.

    Multi-byte white space is told by its whole code: U+0085, U+00A0, U+1680, U+2000 to U+200A,
    U+2028, U+2029, U+202F, U+205F and U+3000.
    """
    at = np.flatnonzero(text == 0x20)
    at = at[at > 0]
    one, two, three = (text[np.maximum(at - back, 0)] for back in (1, 2, 3))
    white = (one == 0x20) | ((one >= 0x09) & (one <= 0x0D)) | ((one >= 0x1C) & (one <= 0x1F))
    white |= (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
    white |= (three == 0xE1) & (two == 0x9A) & (one == 0x80)
    general = ((one >= 0x80) & (one <= 0x8A)) | (one == 0xA8) | (one == 0xA9) | (one == 0xAF)
    white |= (three == 0xE2) & (((two == 0x80) & general) | ((two == 0x81) & (one == 0x9F)))
    white |= (three == 0xE3) & (two == 0x80) & (one == 0x80)
    return at[~white]


class Unit:
    """What a unit adds to a text: numbers, its groups as text, and its links as pairs of ids."""

    __slots__ = ("groups", "n_a", "n_b", "n_groups", "pairs")

    def __init__(self, n_a: int, n_b: int, n_groups: int, groups: bytes, pairs: bytes):
        self.n_a, self.n_b, self.n_groups, self.groups, self.pairs = n_a, n_b, n_groups, groups, pairs


class Tokenizers:
    """Both tokenizers with the bytes of every id, and the units seen lately."""

    def __init__(self, first: str, second: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        from aerolake.llm.tokens import _byte_letters

        self.first = Tokenizer.from_file(first)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=second)
        back = {letter: byte for byte, letter in enumerate(_byte_letters())}
        self.first_bytes = {
            i: bytes(back[c] for c in entry) for entry, i in self.first.get_vocab(with_added_tokens=False).items()
        }
        self.second_bytes = [self._piece(i) for i in range(self.second.get_piece_size())]
        size = max(self.first_bytes) + 1
        self.tables = tuple(
            pa.array(table, pa.binary())
            for table in ([self.first_bytes.get(i, b"") for i in range(size)], self.second_bytes)
        )
        most = max(size, len(self.second_bytes))
        # every id followed by each of the marks
        self.spelt = pa.array([f"{i}{mark}" for mark in MARKS for i in range(most)])
        self.space = self.second.piece_to_id("▁")
        self.new: dict[bytes, Unit | None] = {}
        self.old: dict[bytes, Unit | None] = {}

    def _piece(self, i: int) -> bytes:
        piece = self.second.id_to_piece(i)
        if self.second.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def ids(self, units: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        texts = [unit.decode() for unit in units]
        a = [e.ids for e in self.first.encode_batch_fast(texts, add_special_tokens=False)]
        # the second tokenizer adds the space itself, but not to an empty text
        b = self.second.encode([text[1:] for text in texts], num_threads=1)
        return a, [ids if len(text) > 1 else [self.space] for ids, text in zip(b, texts)]

    def find(self, units: list[bytes]) -> list[Unit | None]:
        """None for a unit that a tokenizer changes."""
        missing = [u for u in units if u not in self.new and u not in self.old]
        found = dict(zip(missing, self._align(missing))) if missing else {}
        out = [found[u] if u in found else self.new[u] if u in self.new else self.old[u] for u in units]
        if len(self.new) + len(found) > _REMEMBERED:
            self.old, self.new = self.new, {}
        self.new.update(list(found.items())[:_REMEMBERED])
        return out

    def _align(self, units: list[bytes]) -> list[Unit | None]:
        out: list[Unit | None] = []
        for at in range(0, len(units), 20_000):
            part = units[at : at + 20_000]
            sides = [Side(ids, table) for ids, table in zip(self.ids(part), self.tables)]
            wanted = pa.array(part, pa.large_binary())
            good = np.logical_and(*(side.gives_back(wanted) for side in sides))
            found = iter(aligned(*(side.only(good) for side in sides), self.spelt))
            out += [next(found) if ok else None for ok in good.tolist()]
        return out


class Side:
    """The ids of one tokenizer for some units, one after the other."""

    def __init__(self, ids: list[list[int]], table: pa.Array):
        self.sizes = np.fromiter(map(len, ids), np.int64, len(ids))  # in tokens
        self.ids = np.fromiter(chain.from_iterable(ids), np.int64, int(self.sizes.sum()))
        self.spelt = table.take(pa.array(self.ids)).cast(pa.large_binary())
        self.lengths = pc.binary_length(self.spelt).to_numpy(zero_copy_only=False).astype(np.int64)

    def gives_back(self, units: pa.Array) -> np.ndarray:
        """Whether the bytes of the tokens of each unit are the unit."""
        ends = np.concatenate(([0], np.cumsum(self.lengths)))
        offsets = ends[np.concatenate(([0], np.cumsum(self.sizes)))]
        buffers = [None, pa.py_buffer(offsets), self.spelt.buffers()[2]]
        joined = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(units), buffers)
        return pc.equal(joined, units).to_numpy(zero_copy_only=False)

    def only(self, good: np.ndarray) -> Side:
        """The same without the other units."""
        if good.all():
            return self
        out = object.__new__(Side)
        kept = np.repeat(good, self.sizes)
        out.sizes, out.ids, out.lengths = self.sizes[good], self.ids[kept], self.lengths[kept]
        return out


def aligned(a: Side, b: Side, spelt: pa.Array) -> list[Unit]:
    """Units from the tokens of both sides, each of which covers the same bytes."""
    a_ends, b_ends = np.cumsum(a.lengths), np.cumsum(b.lengths)
    # tokens of b that a token of a meets: from the first that ends after its start
    low = np.searchsorted(b_ends, a_ends - a.lengths, "right")
    counts = np.searchsorted(b_ends, a_ends, "left") - low + 1
    met = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
    pairs = (np.repeat(a.ids, counts) << 32) + b.ids[met]
    links = np.concatenate(([0], np.cumsum(counts)))
    # groups end where both sides end a token
    a_cut = b_ends[np.minimum(np.searchsorted(b_ends, a_ends), max(len(b_ends) - 1, 0))] == a_ends
    b_cut = a_ends[np.minimum(np.searchsorted(a_ends, b_ends), max(len(a_ends) - 1, 0))] == b_ends
    a_stops, b_stops = np.cumsum(a.sizes), np.cumsum(b.sizes)
    in_groups = np.cumsum(a_cut)  # groups that end with or before each token of a
    groups = np.diff(np.concatenate(([0], in_groups[a_stops - 1]))) if len(a_stops) else a_stops
    # tokens in the order of the text of groups: a's of a group, then b's; marks follow each
    a_group, b_group = (np.cumsum(cut) - cut for cut in (a_cut, b_cut))
    order = np.argsort(np.concatenate((2 * a_group, 2 * b_group + 1)), kind="stable")
    b_marks = np.where(b_cut, GROUP_END, INSIDE)
    b_marks[b_stops - 1] = UNIT_END
    marks = np.concatenate((np.where(a_cut, SIDE_END, INSIDE), b_marks))
    ids = np.concatenate((a.ids, b.ids))
    text = spelt.take(pa.array((marks * (len(spelt) // len(MARKS)) + ids)[order])).cast(pa.large_string())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[: len(order) + 1]
    raw = text.buffers()[2].to_pybytes() if len(order) else b""
    at = offsets[np.concatenate(([0], a_stops + b_stops))].tolist()
    link_at = links[np.concatenate(([0], a_stops))].tolist()
    return [
        Unit(n_a, n_b, n, raw[i:j], pairs[x:y].tobytes())
        for n_a, n_b, n, i, j, x, y in zip(
            a.sizes.tolist(), b.sizes.tolist(), groups.tolist(), at, at[1:], link_at, link_at[1:]
        )
    ]


@lru_cache(maxsize=1)
def tokenizers(first: str, second: str) -> Tokenizers:
    return Tokenizers(first, second)


# --- slices ----------------------------------------------------------------------------------


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of 32-bit numbers, low bytes first."""
    parts = [np.array([len(x) for x in (arrays)], "<u4").tobytes()]
    parts += [x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for x in arrays]
    return zstandard.compress(b"".join(parts), 1)


def _unpacked(raw: bytes, n: int) -> list[np.ndarray]:
    whole = np.frombuffer(zstandard.decompress(raw), np.uint8)
    sizes, at, out = whole[: 4 * n].view("<u4"), 4 * n, []
    for size in sizes.tolist():
        out.append(np.ascontiguousarray(whole[at : at + 4 * size].reshape(4, -1).T).view("<u4").ravel())
        at += 4 * size
    return out


def _rows(number: int, kind: int, **columns) -> Iterator[pa.RecordBatch]:
    """Batches of ``SLICES`` rows of one kind."""
    total = len(next(iter(columns.values())))
    fields = [part.split() for part in SLICES.split(", ")]
    for at in range(0, total, _ROWS):
        n = min(_ROWS, total - at)
        part = {name: values[at : at + n] for name, values in columns.items()}
        part |= {"slice": np.full(n, number), "kind": np.full(n, kind, np.int32), "at": np.arange(at, at + n)}
        yield batch_of({f: (part.get(f, pa.nulls(n, _KINDS[k])), _KINDS[k]) for f, k in fields})


def _slice(number: int, keys: list[bytes], texts: list[bytes], copies: np.ndarray, both: Tokenizers):
    """Measures of the texts, their units, and the weighted pairs of a slice."""
    text = np.frombuffer(b"".join([b" " + t for t in texts]), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    firsts = np.concatenate(([0], ends[:-1]))
    starts = np.unique(np.concatenate((unit_starts(text), firsts)))
    offsets = np.append(starts, len(text)).astype(np.int64)
    whole = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(text)]
    )
    coded = whole.dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False)
    units = both.find(coded.dictionary.to_pylist())
    del whole, coded, text
    firsts = np.searchsorted(starts, firsts)
    sizes = np.diff(np.append(firsts, len(starts)))
    spoilt = np.array([u is None for u in units])
    bad = np.logical_or.reduceat(spoilt[ids], firsts)
    units = [u or Unit(0, 0, 0, b"", b"") for u in units]
    links = np.array([len(u.pairs) // 8 for u in units])
    measured = {
        name: np.where(bad, 0, np.add.reduceat(np.array(values)[ids], firsts))
        for name, values in (
            ("n_a", [u.n_a for u in units]),
            ("n_b", [u.n_b for u in units]),
            ("n_groups", [u.n_groups for u in units]),
            ("n_links", links),
        )
    }
    groups = [u.groups for u in units]
    digests = []
    for first, size, spoils in zip(firsts.tolist(), sizes.tolist(), bad.tolist()):
        inside = ids[first : first + size].tolist()
        joined = b"" if spoils else b";".join([groups[i] for i in inside])
        digests.append("" if spoils else hashlib.sha256(joined).hexdigest())
    yield from _rows(number, TEXT, key=keys, groups_sha256=digests, **measured)
    # weights are whole numbers, exact as doubles up to 2 ** 53
    weights = np.bincount(ids, np.repeat(np.where(bad, 0, copies), sizes), len(units)).astype(np.int64)
    flat = pa.Array.from_buffers(
        pa.int64(), int(links.sum()), [None, pa.py_buffer(b"".join([u.pairs for u in units]))]
    ).dictionary_encode()
    known, place = (x.to_numpy(zero_copy_only=False) for x in (flat.dictionary, flat.indices))
    n = np.bincount(place, np.repeat(weights, links), len(known)).astype(np.int64)
    # a spoilt text keeps its units here: they have no part in its zeros
    yield from _rows(number, UNITS, units=[_packed(sizes, ids, links, place)])
    yield from _rows(number, PAIR, a=known >> 32, b=known & 0xFFFFFFFF, n=n)


def _slices(batches: Iterator[pa.RecordBatch], first: str, second: str, most: int):
    both = tokenizers(first, second)
    partition, made = TaskContext.get().partitionId(), 0
    keys, texts, copies, held = [], [], [], 0
    for batch in batches:
        for key, text, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            keys.append(key)
            texts.append(text.as_buffer().to_pybytes())
            copies.append(n)
            held += len(texts[-1])
            if held >= most:
                yield from _slice((partition << 24) + made, keys, texts, np.array(copies), both)
                made += 1
                keys, texts, copies, held = [], [], [], 0
                pa.default_memory_pool().release_unused()
    if texts:
        yield from _slice((partition << 24) + made, keys, texts, np.array(copies), both)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their best links and summed counts; rows come slice by slice and by kind."""
    fields = [part.split() for part in MEASURES.split(", ")]

    def finish(rows: pa.Table) -> pa.RecordBatch:
        kinds = rows.column("kind").to_numpy()
        texts, pairs = (rows.filter(pa.array(kinds == kind)) for kind in (TEXT, PAIR))
        blob = rows.filter(pa.array(kinds == UNITS)).column("units")[0]
        sizes, ids, links, place = (x.astype(np.int64) for x in _unpacked(blob.as_buffer(), 4))
        firsts = np.cumsum(sizes) - sizes
        at = pairs.column("at").to_numpy()
        columns = {name: texts.column(name).combine_chunks() for name in _KEPT}
        good = texts.column("groups_sha256").to_numpy(zero_copy_only=False) != ""
        for name in ("n_best", "count_sum"):
            of_pair = np.zeros(len(at), np.int64)
            of_pair[at] = pairs.column(name).to_numpy()
            sums = np.concatenate(([0], np.cumsum(of_pair[place])))  # of the units' pairs, one after the other
            stops = np.cumsum(links)
            of_unit = sums[stops] - sums[stops - links]
            columns[name] = np.where(good, np.add.reduceat(of_unit[ids], firsts), 0)
        return batch_of({f: (columns[f], _KINDS[k]) for f, k in fields})

    held: list[pa.RecordBatch] = []
    for batch in batches:
        numbers = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and held[0].column(0)[0].as_py() != numbers[a]:
                yield finish(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield finish(pa.Table.from_batches(held))


# --- corpus ----------------------------------------------------------------------------------


def _key(text) -> F.Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def pair_counts(slices: DataFrame) -> DataFrame:
    """a, b, count (links of the corpus that hold the pair) and best (highest of its b)."""
    pairs = slices.filter(F.col("kind") == PAIR).groupBy("a", "b").agg(F.sum("n").alias("count"))
    highest = pairs.groupBy("b").agg(F.max("count").alias("_most"))
    return pairs.join(highest, "b").select("a", "b", "count", (F.col("count") == F.col("_most")).alias("best"))


def text_slices(docs: DataFrame, first: str, second: str, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Stored slices (``SLICES``) of the distinct texts of docs."""
    texts = docs.select(F.col("text").cast("string").alias("text")).filter("text <> ''")
    once = texts.groupBy("text").agg(F.count("*").alias("copies"))
    rows = once.select(_key(F.col("text")), F.col("text").cast("binary"), "copies")
    work = partial(_slices, first=first, second=second, most=slice_bytes)
    return stage(in_batches(rows, work, SLICES), "alignment")


def align(docs: DataFrame, first: str, second: str, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row for each row of docs: doc_id and the measures of its text.

    ``first`` is the path of a byte-level tokenizer, ``second`` of a piece model that puts a space
    before a text.
    """
    slices = text_slices(docs, first, second, slice_bytes)
    counted = slices.filter(F.col("kind") == PAIR).select("slice", "kind", "at", "a", "b", F.col("n"))
    counted = counted.join(pair_counts(slices), ["a", "b"]).select(
        "slice", "kind", "at", (F.col("best") & (F.col("n") > 0)).cast("bigint").alias("n_best"),
        F.col("count").alias("count_sum"),
    )
    rest = slices.filter(F.col("kind") != PAIR).select("slice", "kind", "at", "units", *_KEPT)
    together = rest.unionByName(counted, allowMissingColumns=True).repartition("slice")
    measures = in_batches(together.sortWithinPartitions("slice", "kind", "at"), _measured, MEASURES)
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _key(F.col("text").cast("string")).alias("key"))
    return keyed.join(measures, "key", "left").select(
        "doc_id",
        *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers),
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
