"""N-gram Jaccard join by chosen paths.

Texts are sets of five-word shingles; equal texts are one class. A sketch holds for each of 64
positions the shingle with the smallest hash, by a hash of each position's own, so that two sets of
any size agree in a position as often as their Jaccard similarity, independently of the others. Chosen paths split the classes recursively: a node
picks each position with probability 1 / (threshold * 64), the same for all its members, and sends
a member to one child for each picked position, named by the position and the member's shingle.
Small nodes are leaves and are compared by brute force; nodes still large at the last level are
compared in blocks, pair of blocks by pair of blocks. A pair at the threshold stays together on
average on one path, so runs are repeated until the target recall is reached.

A leaf first compares sketches, then exact sets of what is left. A pair counts in the smallest of
the leaves both have, so links are counted without writing pairs, and a leaf passes on one edge for
each member. Connected components of these edges are the near-duplicate classes.

Defined results: null texts are empty; empty texts have no shingles and equal only each other; a
text of one to four words is one shingle of all its words; repeated rows are copies; a null doc_id
is kept and is never the smallest. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import batch_of, in_batches
from aerolake.plans.tables import stage

POSITIONS = 64
LEAF = 256  # largest leaf, and size of a block of a larger one
LEVELS = 3
SHINGLE = 5


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over an array of unsigned integers."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _constants() -> np.ndarray:
    """One constant for each position, spread evenly over the first bits."""
    low = mix(np.arange(1, POSITIONS + 1)) >> np.uint64(6)
    return (np.arange(POSITIONS, dtype=np.uint64) << np.uint64(58)) | low


def shingles_of(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts one after another, and the number of each text's."""
    import xxhash

    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = pc.list_flatten(lists).dictionary_encode()
    chunks = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    codes = np.fromiter((xxhash.xxh3_64_intdigest(c) for c in chunks), np.uint64, len(chunks))
    places = coded.indices.to_numpy(zero_copy_only=False)
    owner = np.repeat(
        np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    )
    real = np.fromiter((c != "" for c in chunks), bool, len(chunks))[places]
    words, owner = codes[places][real], owner[real]
    n_words = np.bincount(owner, minlength=len(lists))
    with np.errstate(over="ignore"):
        if len(words) >= size:
            value = np.zeros(len(words) - size + 1, np.uint64)
            for at in range(size):
                value = mix(value * np.uint64(31) + words[at : at + len(value)])
            whole = owner[: len(value)] == owner[size - 1 :]
            value, own = value[whole], owner[: len(value)][whole]
        else:
            value, own = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        # short texts: one shingle of all words
        few = np.flatnonzero((n_words > 0) & (n_words < size))
        if len(few):
            starts = np.searchsorted(owner, few)
            extra = np.array(
                [_fold(words[s : s + n_words[row]]) for s, row in zip(starts, few)], np.uint64
            )
            value, own = np.concatenate([value, extra]), np.concatenate([own, few])
            order = np.argsort(own, kind="stable")
            value, own = value[order], own[order]
    return value, np.bincount(own, minlength=len(lists))


def _fold(words: np.ndarray) -> int:
    value = np.uint64(len(words))
    with np.errstate(over="ignore"):
        for word in words:
            value = mix(np.array([value * np.uint64(31) + word]))[0]
    return value


def _hashed(value: np.ndarray, constant: np.uint64) -> np.ndarray:
    """A hash of its own for a position. The nearest to a constant alone would not do: of few
    shingles one is then the nearest to many constants, and positions agree or differ together."""
    out = value ^ constant
    with np.errstate(over="ignore"):
        out *= np.uint64(0xFF51AFD7ED558CCD)
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xC4CEB9FE1A85EC53)
        out ^= out >> np.uint64(32)
    return out


def _sketch(batches: Iterator[pa.RecordBatch]):
    from aerolake.llm.tokens import slices

    for batch in batches:
        texts = batch.column(2)
        for start, length in slices(texts):
            value, sizes = shingles_of(texts.slice(start, length))
            some = np.flatnonzero(sizes)
            out = np.zeros((len(some), POSITIONS), np.uint32)
            if len(some):
                starts = (np.cumsum(sizes) - sizes)[some]
                for at, constant in enumerate(_constants()):
                    out[:, at] = np.minimum.reduceat(_hashed(value, constant), starts).astype(np.uint32)
            raw: list[bytes | None] = [None] * length
            for row, cells in zip(some, out):
                raw[row] = cells.tobytes()
            yield batch_of(
                {
                    "doc_id": (batch.column(0).slice(start, length), None),
                    "text_id": (batch.column(1).slice(start, length), None),
                    "sketch": (raw, pa.binary()),
                }
            )


def _cells(column: pa.Array) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.uint32).reshape(-1, POSITIONS)


def _children(nodes: np.ndarray, cells: np.ndarray, chosen: np.ndarray):
    """(row, child) for each picked position of each row."""
    row, at = np.nonzero(chosen)
    with np.errstate(over="ignore"):
        name = mix(nodes[row] * np.uint64(31) + at.astype(np.uint64))
        return row, mix(name * np.uint64(31) + cells[row, at])


def _picked(nodes: np.ndarray, threshold: float) -> np.ndarray:
    """Which positions each node picks: a matrix of nodes by positions."""
    share = np.uint64(int(2**64 / (threshold * POSITIONS)))
    with np.errstate(over="ignore"):
        place = np.arange(POSITIONS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mix(nodes[:, None] ^ mix(place + np.uint64(7))[None, :]) < share


def _roots(batches: Iterator[pa.RecordBatch], runs: int, threshold: float):
    roots = mix(np.arange(1, runs + 1, dtype=np.uint64))
    picks = _picked(roots, threshold)
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        cells = _cells(batch.column(1))
        for root, picked in zip(roots, picks):
            if not picked.any():
                continue
            chosen = np.broadcast_to(picked, cells.shape)
            row, child = _children(np.full(len(ids), root), cells, chosen)
            yield batch_of(
                {"node": (child.view(np.int64), pa.int64()), "text_id": (ids[row], pa.int64())}
            )


def _split(batches: Iterator[pa.RecordBatch], threshold: float):
    for batch in batches:
        nodes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        ids = batch.column(1).to_numpy(zero_copy_only=False)
        cells = _cells(batch.column(2))
        row, child = _children(nodes, cells, _picked(nodes, threshold))
        yield batch_of(
            {"node": (child.view(np.int64), pa.int64()), "text_id": (ids[row], pa.int64())}
        )


def runs_for(recall: float, levels: int = LEVELS) -> int:
    """Runs after which a pair at the threshold has met in a leaf with this probability.

    Two such sets share on average one picked position at each level, nearly Poisson.
    """
    together = 1.0
    for _ in range(levels):
        together = 1 - math.exp(-together)
    return math.ceil(math.log(1 - recall) / math.log(1 - together))


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches cut so that the rows of a unit (node, low, high), which are adjacent, stay whole."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        if held:
            last = held[-1]
            if any(last.column(i)[-1] != batch.column(i)[0] for i in range(3)):
                yield pa.Table.from_batches(held)
                held = []
        if len(new):
            cut = int(new[-1])
            held.append(batch.slice(0, cut))
            yield pa.Table.from_batches(held)
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _unit_starts(table: pa.Table) -> np.ndarray:
    keys = [table.column(i).to_numpy() for i in range(3)]
    new = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.concatenate(([0], np.flatnonzero(new) + 1, [table.num_rows]))


def _earlier(nodes: list, node: int) -> np.ndarray:
    """Which pairs of members already share a smaller leaf."""
    flat = np.concatenate([np.array(n, np.int64) for n in nodes])
    row = np.repeat(np.arange(len(nodes)), [len(n) for n in nodes])
    before = flat < node
    values, column = np.unique(flat[before], return_inverse=True)
    member = np.zeros((len(nodes), len(values)), np.float32)
    member[row[before], column] = 1
    return member @ member.T > 0


def _likely(batches: Iterator[pa.RecordBatch], threshold: float):
    """Members that have a likely new partner in their unit, by bytes of the sketches."""
    spread = math.sqrt(threshold * (1 - threshold) / POSITIONS)
    least = int(POSITIONS * (threshold - 4.4 * spread))
    for table in _units(batches):
        unit = np.repeat(np.arange(len(_unit_starts(table)) - 1), np.diff(_unit_starts(table)))
        starts = _unit_starts(table)
        ids = table.column("text_id").to_numpy()
        blocks = table.column("block").to_numpy()
        across = table.column("low").to_numpy() != table.column("high").to_numpy()
        cells = np.frombuffer(b"".join(table.column("brief").to_pylist()), np.uint8)
        cells = cells.reshape(-1, POSITIONS)
        left, right = [], []
        for step in range(1, int(np.diff(starts).max())):
            one = np.flatnonzero(unit[:-step] == unit[step:])
            two = one + step
            fit = ~across[one] | (blocks[one] != blocks[two])
            one, two = one[fit], two[fit]
            same = (cells[one] == cells[two]).sum(axis=1) >= least
            left.append(one[same])
            right.append(two[same])
        if not left or not sum(map(len, left)):
            continue
        one, two = np.concatenate(left), np.concatenate(right)
        keep = np.zeros(len(ids), bool)
        order = np.argsort(unit[one], kind="stable")
        one, two = one[order], two[order]
        nodes = table.column("node").to_numpy()
        lists = table.column("nodes")
        for group in np.split(np.arange(len(one)), np.flatnonzero(np.diff(unit[one])) + 1):
            members = np.unique(np.concatenate([one[group], two[group]]))
            seen = _earlier([lists[int(m)].as_py() for m in members], nodes[members[0]])
            a, b = np.searchsorted(members, one[group]), np.searchsorted(members, two[group])
            new = ~seen[a, b]
            keep[one[group][new]] = True
            keep[two[group][new]] = True
        if keep.any():
            yield table.filter(pa.array(keep)).select(
                ["node", "low", "high", "text_id", "block", "nodes"]
            ).combine_chunks().to_batches()[0]


def _sets(batches: Iterator[pa.RecordBatch]):
    from aerolake.llm.tokens import slices

    for batch in batches:
        for start, length in slices(batch.column(1)):
            value, sizes = shingles_of(batch.column(1).slice(start, length))
            parts = np.split(value, np.cumsum(sizes)[:-1])
            yield batch_of(
                {
                    "text_id": (batch.column(0).slice(start, length), None),
                    "shingles": ([np.unique(p).tobytes() for p in parts], pa.binary()),
                }
            )


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each pair of sets shares."""
    size = len(sets)
    if size <= 6:
        out = np.zeros((size, size), np.int64)
        for i in range(size):
            for j in range(i + 1, size):
                out[i, j] = out[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return out
    row = np.repeat(np.arange(size), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = count[column] > 1
    row, column = row[several], column[several]
    _, column = np.unique(column, return_inverse=True)
    out = np.zeros((size, size), np.float64)
    step = 8192
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for first in range(0, int(column.max(initial=-1)) + 1, step):
        a, b = np.searchsorted(column, [first, first + step])
        member = np.zeros((size, step), np.float32)
        member[row[a:b], column[a:b] - first] = 1
        out += member @ member.T
    return out.astype(np.int64)


def _verify(batches: Iterator[pa.RecordBatch], threshold: float):
    """(text_id, n_links, root) of members with links: new links, and a tree over all links."""
    for table in _units(batches):
        starts = _unit_starts(table)
        ids_all = table.column("text_id").to_numpy()
        blocks_all = table.column("block").to_numpy()
        node_all = table.column("node").to_numpy()
        across = table.column("low").to_numpy() != table.column("high").to_numpy()
        out_ids, out_links, out_roots = [], [], []
        for a, b in zip(starts[:-1], starts[1:]):
            if b - a < 2:
                continue
            sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles")[a:b].to_pylist()]
            size = np.array([len(s) for s in sets])
            shared = _shared(sets)
            linked = shared >= threshold * (size[:, None] + size[None, :] - shared) - 1e-9
            np.fill_diagonal(linked, False)
            if across[a]:
                block = blocks_all[a:b]
                linked &= block[:, None] != block[None, :]
            if not linked.any():
                continue
            seen = _earlier(table.column("nodes")[a:b].to_pylist(), node_all[a])
            ids = ids_all[a:b]
            roots = _tree(linked, ids)
            some = linked.any(axis=1)
            out_ids.append(ids[some])
            out_links.append((linked & ~seen).sum(axis=1)[some])
            out_roots.append(roots[some])
        if out_ids:
            yield batch_of(
                {
                    "text_id": (np.concatenate(out_ids), pa.int64()),
                    "n_links": (np.concatenate(out_links).astype(np.int64), pa.int64()),
                    "root": (np.concatenate(out_roots), pa.int64()),
                }
            )


def _tree(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id of each member's component inside a unit."""
    roots = ids.copy()
    while True:
        near = np.where(linked, roots[None, :], np.iinfo(np.int64).max).min(axis=1)
        new = np.minimum(roots, near)
        if (new == roots).all():
            return roots
        roots = new


def text_id(text: str = "text") -> F.Column:
    """The id of a text's class of copies."""
    return F.xxhash64(F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))))


def components(edges: DataFrame) -> DataFrame:
    """(text_id, component): the smallest id that edges (text_id, root) connect.

    Labels fall to the smallest neighbour's and then jump to their label's label, until none
    changes; each round is a stored table.
    """
    both = edges.select("text_id", "root").filter("text_id <> root").distinct()
    both = stage(both.union(both.select("root", "text_id")), "join-edges")
    labels = stage(
        both.groupBy("text_id").agg(F.least(F.min("root"), F.col("text_id")).alias("component")),
        "join-labels",
    )
    while True:
        known = labels.select(F.col("text_id").alias("root"), F.col("component").alias("near"))
        fallen = (
            both.join(known, "root")
            .groupBy("text_id")
            .agg(F.min("near").alias("near"))
            .join(labels, "text_id")
            .select("text_id", "component", F.least("near", "component").alias("next"))
        )
        jump = labels.select(
            F.col("text_id").alias("next"), F.col("component").alias("further")
        )
        new = fallen.join(jump, "next", "left").select(
            "text_id",
            F.least("next", F.coalesce("further", "next")).alias("next"),
            "component",
        )
        new = stage(new, "join-labels")
        changed = not new.filter("next <> component").isEmpty()
        labels = new.select("text_id", F.col("next").alias("component"))
        if not changed:
            return labels


def near_duplicates(
    docs: DataFrame, threshold: float = 0.8, recall: float = 0.999
) -> DataFrame:
    """(text_id, component, n_links) of texts that are similar to another text."""
    rows = docs.select("doc_id", text_id().alias("text_id"), F.col("text").cast("string"))
    sketched = stage(
        in_batches(rows, _sketch, "doc_id bigint, text_id bigint, sketch binary"), "join-sketches"
    )
    classes = stage(
        sketched.filter(F.col("sketch").isNotNull())
        .groupBy("text_id")
        .agg(F.min("doc_id").alias("first_id"), F.max("sketch").alias("sketch")),
        "join-classes",
    )
    cells = classes.select("text_id", "sketch")
    paths = in_batches(
        cells, partial(_roots, runs=runs_for(recall), threshold=threshold), "node bigint, text_id bigint"
    )
    leaves = None
    for level in range(1, LEVELS + 1):
        counted = paths.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1")
        placed = stage(paths.join(counted, "node"), "join-nodes")
        done = placed if level == LEVELS else placed.filter(F.col("n") <= LEAF)
        leaves = done if leaves is None else leaves.unionByName(done)
        large = placed.filter(F.col("n") > LEAF).select("node", "text_id").join(cells, "text_id")
        paths = in_batches(
            large.select("node", "text_id", "sketch"),
            partial(_split, threshold=threshold),
            "node bigint, text_id bigint",
        )
    # a class is in a bounded number of leaves, set by the runs and levels
    leaves = stage(leaves, "join-leaves")
    own = leaves.groupBy("text_id").agg(F.sort_array(F.collect_list("node")).alias("nodes"))
    brief = in_batches(cells, _brief, "text_id bigint, brief binary")
    told = stage(own.join(brief, "text_id"), "join-members")
    n_blocks = F.ceil(F.col("n") / LEAF)
    block = F.when(F.col("n") > LEAF, F.pmod(F.xxhash64("text_id", "node"), n_blocks)).otherwise(F.lit(0))
    other = F.explode(
        F.when(F.col("n") > LEAF, F.sequence(F.lit(0).cast("bigint"), n_blocks - 1)).otherwise(
            F.array(F.lit(0).cast("bigint"))
        )
    )
    units = leaves.withColumn("block", block.cast("bigint")).withColumn("other", other).select(
        "node",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "text_id",
        "block",
    )
    unit = ["node", "low", "high"]
    met = (
        units.join(told, "text_id")
        .repartition(*unit)
        .sortWithinPartitions(*unit, "text_id")
        .select(*unit, "text_id", "block", "nodes", "brief")
    )
    kinds = "node bigint, low bigint, high bigint, text_id bigint, block bigint, nodes array<bigint>"
    likely = stage(in_batches(met, partial(_likely, threshold=threshold), kinds), "join-likely")
    # exact sets of one document of each class that is left
    wanted = likely.select("text_id").distinct().join(
        classes.select("text_id", "first_id"), "text_id"
    )
    texts = (
        rows.join(wanted, "text_id")
        .filter(F.col("doc_id").eqNullSafe(F.col("first_id")))
        .select("text_id", "text")
    )
    sets = in_batches(texts, _sets, "text_id bigint, shingles binary")
    sets = sets.groupBy("text_id").agg(F.first("shingles").alias("shingles"))
    checked = (
        likely.join(sets, "text_id")
        .repartition(*unit)
        .sortWithinPartitions(*unit, "text_id")
        .select(*unit, "text_id", "block", "nodes", "shingles")
    )
    links = stage(
        in_batches(
            checked, partial(_verify, threshold=threshold), "text_id bigint, n_links bigint, root bigint"
        ),
        "join-links",
    )
    totals = links.groupBy("text_id").agg(F.sum("n_links").alias("n_links"))
    return totals.join(components(links), "text_id", "left").select(
        "text_id", F.coalesce("component", "text_id").alias("component"), "n_links"
    )


def _brief(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        cells = (_cells(batch.column(1)) & 255).astype(np.uint8)
        yield batch_of(
            {
                "text_id": (batch.column(0), None),
                "brief": ([row.tobytes() for row in cells], pa.binary()),
            }
        )


def join(docs: DataFrame, threshold: float = 0.8, recall: float = 0.999) -> DataFrame:
    """One row for each document: doc_id, copy_id, class_id, n_links.

    ``copy_id`` is the smallest document of the same text, ``class_id`` the smallest of all that
    links connect, ``n_links`` the number of different texts it is similar to.
    """
    near = stage(near_duplicates(docs, threshold, recall), "join-near")
    keyed = stage(docs.select("doc_id", text_id().alias("text_id")), "join-keys")
    copies = keyed.groupBy("text_id").agg(F.min("doc_id").alias("copy_id"))
    classes = copies.join(near, "text_id", "left").withColumn(
        "component", F.coalesce("component", "text_id")
    )
    classes = stage(classes, "join-classes")
    smallest = classes.groupBy("component").agg(F.min("copy_id").alias("class_id"))
    full = classes.join(smallest, "component").select(
        "text_id", "copy_id", "class_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links")
    )
    return keyed.join(full, "text_id").select("doc_id", "copy_id", "class_id", "n_links")
