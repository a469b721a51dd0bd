"""Collocations: FM-indexes of shards over word ids, phrases by interval extension, counts summed.

A shard is a bounded run of texts of one language (``SHARD_BYTES``; a text is cut only between
pieces, so a shard is larger only if one piece is). Its words become local ids, breaks between
pieces id 0. Rotations sorted by three words give the shard's transform (the word before each
rotation) and, read backwards, the reverse transform (the word after). Both are stored in blocks.

Counts are settled from short to long, so that a shard emits a phrase only if every pair of
neighbouring words in it is frequent in the whole corpus:

1. words of all shards are summed; those with enough occurrences get an id;
2. each shard extends the intervals of frequent words to the left, and the pairs are summed, first
   over a team of shards (``TEAM_WORDS`` words of a language) in a task, then over teams;
3. each shard takes the intervals of frequent pairs in both directions, extends them to the left to
   three words (from the transform) and those to the right to four (from the reverse transform).

What is longer than a candidate by one word is its left and right extensions, so they decide
whether it goes; two words more can never be needed, as the phrase between counts at least as much.

Memory of a task is some 150 bytes for each word of one shard, and 12 for each pair of the shards of
its team, which are merged in parts of ``_MERGED`` pairs. Hot words, phrases and languages are spread by
shards; nothing is broadcast by hand.

Defined results: null and empty texts have no words; a null language is ``und``; repeated rows
count each; doc_id and other columns are ignored. An empty table gives no rows. Phrases that tie in
score and count go by their UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.common import batch_of, in_batches
from aerolake.plans.tables import stage

SHARD_BYTES = 8_000_000  # of text
TEAM_WORDS = 8_000_000  # of a language whose shards one task counts, one after the other
BLOCK = 1 << 18  # words of a stored block of a transform
_ROWS = 100_000  # of a batch that goes back to Spark
_MERGED = 500_000  # pairs of a team merged at a time
_PIECE_ENDS = b".,;:!?\x0b\x0c\r"
_PLAIN = bytes(
    10 if c in _PIECE_ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256)
)
_BREAK = 0

INDEX = (
    "shard bigint, lang string, block int, forward binary, backward binary,"
    " local int, word string, n bigint"
)


# --- one shard -------------------------------------------------------------------------------


def local_ids(text: bytes) -> tuple[np.ndarray, pa.Array]:
    """Words of plain text as ids from 1, with 0 before, between and after pieces; the words."""
    spaced = b"\n " + text.replace(b"\n", b" \n ")
    parts = pc.list_flatten(pc.split_pattern(pa.array([spaced], pa.large_binary()), " "))
    coded = parts.dictionary_encode()
    found = coded.dictionary
    ids = coded.indices.to_numpy(zero_copy_only=False)
    special = pa.array([b"", b"\n"], pa.large_binary())
    words = found.filter(pc.invert(pc.is_in(found, value_set=special)))
    renamed = np.zeros(len(found), np.int64)
    renamed[pc.is_in(found, value_set=words).to_numpy(zero_copy_only=False)] = np.arange(1, len(words) + 1)
    empty = pc.index(found, pa.scalar(b"", pa.large_binary())).as_py()
    ids = renamed[ids[ids != empty]]
    repeated = np.zeros(len(ids), bool)
    repeated[1:] = (ids[1:] == _BREAK) & (ids[:-1] == _BREAK)
    return ids[~repeated], words.cast(pa.binary()).cast(pa.string())


def _order(first: np.ndarray, second: np.ndarray, third: np.ndarray, size: int) -> np.ndarray:
    """Positions sorted by three words; ties in any order."""
    if size < 2**21:
        return np.argsort((first * size + second) * size + third)
    pairs = np.unique(first * size + second, return_inverse=True)[1]
    return np.argsort(pairs * size + third)  # fewer pairs than words in a shard


def transforms(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The word before each sorted rotation, and after each sorted reverse rotation."""
    before, after = np.roll(ids, 1), np.roll(ids, -1)
    forward = before[_order(ids, after, np.roll(ids, -2), size)]
    backward = after[_order(ids, before, np.roll(ids, 2), size)]
    return forward, backward


def first_words(transform: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the rotations of each word start, and the first word of each rotation."""
    counts = np.bincount(transform)
    starts = np.concatenate(([0], np.cumsum(counts)))
    return starts, np.repeat(np.arange(len(counts)), counts)


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal sorted keys."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return starts, np.diff(np.append(starts, len(keys)))


def _cover(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions of some intervals, and the number of the interval of each."""
    owner = np.repeat(np.arange(len(starts)), lengths)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return starts[owner] + offset, owner


def pairs_of(forward: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Left extensions of every word: first word, second word, count, start in reverse order.

    A pair's reverse interval starts where the smaller words before the second one end.
    """
    size = int(forward.max()) + 1
    _, second = first_words(forward)
    keys = np.sort(second * size + forward)
    starts, counts = runs(keys)
    return keys[starts] % size, keys[starts] // size, counts, starts


def _forward_starts(forward: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Start of a pair's interval: rotations of the first word before it, by rank in the transform."""
    total = len(forward)
    starts, _ = first_words(forward)
    # rows of the transform by word, then by place; the k-th row of a word leads to its k-th rotation
    places = np.sort(forward * total + np.arange(total))
    return np.searchsorted(places, first * total + starts[second])


def longer_phrases(
    forward: np.ndarray, backward: np.ndarray, first: np.ndarray, second: np.ndarray
) -> Iterator[tuple[np.ndarray, ...]]:
    """(words..., counts) of three, then of four words; neighbours in them are the given pairs."""
    size = int(forward.max()) + 1
    one, two, counts, backs = pairs_of(forward)
    known = np.sort(first * size + second)

    def among(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * size + b
        at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
        return known[at] == keys if len(known) else np.zeros(len(keys), bool)

    kept = among(one, two)
    one, two, counts, backs = one[kept], two[kept], counts[kept], backs[kept]
    at, owner = _cover(_forward_starts(forward, one, two), counts)
    keys = np.sort(owner * size + forward[at])  # intervals, in them the words to the left
    starts, threes = runs(keys)
    owner, left = keys[starts] // size, keys[starts] % size
    # a longer phrase's reverse interval: inside that of its pair, after the smaller words
    backs = backs[owner] + starts - (np.cumsum(counts) - counts)[owner]
    kept = among(left, one[owner])
    left, owner, threes, backs = left[kept], owner[kept], threes[kept], backs[kept]
    yield left, one[owner], two[owner], threes
    at, trio = _cover(backs, threes)
    keys = np.sort(trio * size + backward[at])
    starts, fours = runs(keys)
    trio, right = keys[starts] // size, keys[starts] % size
    kept = among(two[owner[trio]], right)
    trio, right, fours = trio[kept], right[kept], fours[kept]
    yield left[trio], one[owner[trio]], two[owner[trio]], right, fours


def packed(ids: np.ndarray) -> bytes:
    """A block of ids, low bytes first: the high ones are nearly all zero."""
    planes = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.compress(planes, 1)


def unpacked(block: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(block), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


# --- tasks -----------------------------------------------------------------------------------


def _cut(text: bytes, most: int) -> Iterator[bytes]:
    """A text in parts of about ``most`` bytes, cut between pieces."""
    start = 0
    while len(text) - start > most:
        stop = text.rfind(b"\n", start, start + most)
        if stop <= start:
            stop = text.find(b"\n", start + most)
            if stop < 0:
                break
        yield text[start:stop]
        start = stop + 1
    yield text[start:]


def _index_rows(shard: int, lang: str, text: bytes) -> Iterator[pa.RecordBatch]:
    ids, words = local_ids(text)
    counts = np.bincount(ids, minlength=len(words) + 1)[1:]
    if not len(words):
        return
    both = transforms(ids, len(words) + 1)
    schema = [pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.string(), pa.int64()]
    names = [part.split()[0] for part in INDEX.split(", ")]

    def batch(rows: int, **given) -> pa.RecordBatch:
        given |= {"shard": np.full(rows, shard), "lang": [lang] * rows}
        return batch_of({k: (given.get(k, pa.nulls(rows, t)), t) for k, t in zip(names, schema)})

    for block, at in enumerate(range(0, len(ids), BLOCK)):
        forward, backward = (packed(t[at : at + BLOCK]) for t in both)
        yield batch(1, block=[block], forward=[forward], backward=[backward])
    for at in range(0, len(words), 50_000):
        part = slice(at, at + 50_000)
        n = len(counts[part])
        local = np.arange(at + 1, at + n + 1, dtype=np.int32)
        yield batch(n, local=local, word=words[part], n=counts[part])


def _index(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Transforms and words of the shards of a task's texts."""
    partition = TaskContext.get().partitionId()
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    made = 0

    def flush(lang: str) -> Iterator[pa.RecordBatch]:
        nonlocal made
        text = b"\n".join(held.pop(lang))
        del sizes[lang]
        yield from _index_rows((partition << 24) + made, lang, text)
        made += 1
        pa.default_memory_pool().release_unused()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for part in _cut(text.as_buffer().to_pybytes().translate(_PLAIN), most):
                if sizes.get(lang, 0) + len(part) > most and lang in held:
                    yield from flush(lang)
                held.setdefault(lang, []).append(part)
                sizes[lang] = sizes.get(lang, 0) + len(part) + 1
    for lang in list(held):
        yield from flush(lang)


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int | None, pa.Table]]:
    """team, shard and rows; they come team by team, and in it shard by shard (null first)."""
    held: list[pa.RecordBatch] = []

    def key(batch: pa.RecordBatch) -> tuple:
        return batch.column(0)[0].as_py(), batch.column(1)[0].as_py()

    for batch in batches:
        team, shard = (pc.fill_null(c, -1).to_numpy(zero_copy_only=False) for c in batch.columns[:2])
        changes = np.flatnonzero((np.diff(team) != 0) | (np.diff(shard) != 0)) + 1
        cuts = [0, *changes.tolist(), len(batch)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            part = batch.slice(a, b - a)
            if held and key(held[0]) != key(part):
                yield *key(held[0]), pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield *key(held[0]), pa.Table.from_batches(held)


def _read_shard(rows: pa.Table, *names: str) -> list[np.ndarray]:
    """The named transforms, and the id of each local word (-1: not frequent)."""
    kinds = rows.column("kind").to_numpy()
    blocks = rows.filter(pa.array(kinds == 0))
    whole = [
        np.concatenate([unpacked(x.as_buffer()) for x in blocks.column(name)]).astype(np.int64)
        for name in names
    ]
    a, b = (rows.column(name).to_numpy()[kinds == 1] for name in ("a", "b"))
    ids = np.full(int(whole[0].max()) + 1, -1, np.int64)
    ids[a] = b
    return [*whole, ids]


def _batches(columns: dict[str, np.ndarray | None], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of bigint columns; None is a column of nulls."""
    for at in range(0, rows, _ROWS):
        n = min(_ROWS, rows - at)
        part = {k: pa.nulls(n, pa.int64()) if v is None else v[at : at + n] for k, v in columns.items()}
        yield batch_of({k: (v, pa.int64()) for k, v in part.items()})


class ShardPairs:
    """Pairs of frequent words of a shard, sorted by second and first word: 12 bytes each."""

    def __init__(self, ids: np.ndarray, first: np.ndarray, second: np.ndarray, n: np.ndarray):
        self.names = np.unique(ids[ids >= 0])
        kept = (ids[first] >= 0) & (ids[second] >= 0)
        places = np.searchsorted(self.names, ids)
        first, second, n = places[first[kept]], places[second[kept]], n[kept]
        order = np.argsort(second * len(self.names) + first)
        self.first, self.second, self.n = (x[order].astype(np.int32) for x in (first, second, n))


def summed(shards: list[ShardPairs], most: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Distinct pairs of all shards with their sums, some ``most`` pairs of shards at a time."""
    names = np.unique(np.concatenate([s.names for s in shards]))
    places = [np.searchsorted(names, s.names) for s in shards]
    counts = np.zeros(len(names), np.int64)  # pairs by second word
    for shard, place in zip(shards, places):
        counts[place] += np.bincount(shard.second, minlength=len(place))
    total = np.cumsum(counts)
    cuts = np.searchsorted(total, np.arange(most, int(counts.sum()), most)) + 1
    bounds = np.unique(np.concatenate(([0], cuts, [len(names)])))
    for low, high in zip(bounds[:-1], bounds[1:]):
        keys, sums = [], []
        for shard, place in zip(shards, places):
            rows = slice(*np.searchsorted(shard.second, np.searchsorted(place, (low, high))))
            keys.append(place[shard.second[rows]] * len(names) + place[shard.first[rows]])
            sums.append(shard.n[rows])
        keys, n = np.concatenate(keys), np.concatenate(sums).astype(np.int64)
        if not len(keys):
            continue
        order = np.argsort(keys)
        keys = keys[order]
        starts, _ = runs(keys)
        n = np.add.reduceat(n[order], starts)
        keys = keys[starts]
        yield names[keys % len(names)], names[keys // len(names)], n


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of frequent words of each team."""
    held: list[ShardPairs] = []

    def flush(team: int) -> Iterator[pa.RecordBatch]:
        for first, second, n in summed(held, _MERGED):
            yield from _batches({"w1": first, "w2": second, "team": np.full(len(n), team), "n": n}, len(n))
        held.clear()
        pa.default_memory_pool().release_unused()

    last = None
    for team, _, rows in _by_shard(batches):
        if held and team != last:
            yield from flush(last)
        last = team
        forward, ids = _read_shard(rows, "forward")
        first, second, counts, _ = pairs_of(forward)
        held.append(ShardPairs(ids, first, second, counts))
    if held:
        yield from flush(last)


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases of three and four words of each shard, by the pairs that its team is given."""
    of, pairs = None, None
    for team, shard, rows in _by_shard(batches):
        if shard is None:
            of, pairs = team, [rows.column(name).to_numpy() for name in ("a", "b")]
            continue
        if team != of:
            continue  # none of its pairs is frequent
        forward, backward, ids = _read_shard(rows, "forward", "backward")
        known = np.flatnonzero(ids >= 0)
        known = known[np.argsort(ids[known])]
        if not len(known):
            continue
        places = [np.minimum(np.searchsorted(ids[known], w), len(known) - 1) for w in pairs]
        here = np.logical_and(*(ids[known[at]] == w for at, w in zip(places, pairs)))
        for *words, counts in longer_phrases(forward, backward, *(known[at[here]] for at in places)):
            found = {f"w{i + 1}": ids[w] for i, w in enumerate(words)}
            found.setdefault("w4", None)
            yield from _batches(found | {"n": counts}, len(counts))
        pa.default_memory_pool().release_unused()


# --- counts of the corpus --------------------------------------------------------------------


def index_texts(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The stored shards (``INDEX``): blocks of both transforms, and words with counts."""
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")), F.col("text").cast("string").cast("binary")
    ).toDF("lang", "text")
    rows = rows.filter("length(text) > 0")
    return stage(in_batches(rows, partial(_index, most=shard_bytes), INDEX), "collocation-index")


def _fed(teams: int, *parts: DataFrame) -> DataFrame:
    """Rows of each team, what has no shard first, then one shard after the other."""
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    wide = max(teams, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(wide, "team").sortWithinPartitions("team", "shard", "kind", "a")


def _with_team(rows: DataFrame, langs: DataFrame, tasks: int) -> DataFrame:
    """Rows of shards with the team of the shard: neighbouring tasks of the index, by language."""
    part = F.floor(F.shiftright("shard", 24) * F.col("teams") / tasks).cast("bigint")
    team = F.shiftleft(F.col("number").cast("bigint"), 32) + part
    return rows.join(langs.select("lang", "teams", "number"), "lang").withColumn("team", team)


def count_phrases(index: DataFrame, least: int, team_words: int = TEAM_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Languages (lang, n), frequent words (id, lang, word, f), phrases (words, f).

    ``words`` is an array of ids: all phrases of 1 to 4 words with f >= ``least``.
    """
    vocabulary = index.filter("local IS NOT NULL").select("shard", "lang", "local", "word", "n")
    words = vocabulary.groupBy("lang", "word").agg(F.sum("n").alias("f"))
    by_name = Window.orderBy("lang")  # one row for each language
    langs = stage(
        vocabulary.groupBy("lang")
        .agg(F.sum("n").alias("n"), F.max(F.shiftright("shard", 24)).alias("last"))
        .withColumn("teams", F.ceil(F.col("n") / team_words).cast("bigint"))
        .withColumn("number", F.row_number().over(by_name)),
        "collocation-languages",
    )
    sizes = langs.agg(F.max("last"), F.sum("teams")).first()
    tasks, teams = (sizes[0] or 0) + 1, sizes[1] or 0
    frequent = stage(
        words.filter(F.col("f") >= least).withColumn("id", F.monotonically_increasing_id()),
        "collocation-words",
    )
    known = vocabulary.join(frequent.select("lang", "word", "id"), ["lang", "word"])
    known = stage(
        _with_team(known, langs, tasks).select(
            "team", "shard", F.lit(1).alias("kind"), F.col("local").cast("bigint").alias("a"), F.col("id").alias("b")
        ),
        "collocation-local",
    )
    blocks = index.filter("block IS NOT NULL").select("shard", "lang", "block", "forward", "backward")
    blocks = _with_team(blocks, langs, tasks).select(
        "team", "shard", F.lit(0).alias("kind"), F.col("block").cast("bigint").alias("a"), "forward", "backward"
    )
    local = in_batches(
        _fed(teams, blocks.drop("backward"), known), _pairs, "w1 bigint, w2 bigint, team bigint, n bigint"
    )
    # every row of a pair is of another team, so there is nothing to sum before the shuffle
    everywhere = Window.partitionBy("w1", "w2")
    pairs = stage(
        local.withColumn("f", F.sum("n").over(everywhere)).filter(F.col("f") >= least),
        "collocation-pairs",
    )
    wanted = pairs.select(
        "team", F.lit(None).cast("bigint").alias("shard"), F.lit(2).alias("kind"),
        F.col("w1").alias("a"), F.col("w2").alias("b"),
    )
    longer = in_batches(
        _fed(teams, blocks, known, wanted), _phrases, "w1 bigint, w2 bigint, w3 bigint, w4 bigint, n bigint"
    )
    longer = longer.groupBy("w1", "w2", "w3", "w4").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    phrases = (
        frequent.select(F.array("id").alias("words"), "f")
        .unionByName(pairs.groupBy("w1", "w2").agg(F.max("f").alias("f")).select(F.array("w1", "w2").alias("words"), "f"))
        .unionByName(
            longer.select(F.filter(F.array("w1", "w2", "w3", "w4"), lambda w: w.isNotNull()).alias("words"), "f")
        )
    )
    return langs, frequent, stage(phrases, "collocation-phrases")


# --- scores ----------------------------------------------------------------------------------


def scored(phrases: DataFrame) -> DataFrame:
    """words, a, k, l, r and score of every phrase of two words or more.

    score = floor(2000000 a / (l + r)) of the lowest-scoring cut, the first of several; decimals
    hold the product of any counts.
    """
    words = F.col("words")
    cuts = F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    cut = phrases.filter(F.size("words") > 1).select("words", F.col("f").alias("a"), cuts)
    left = phrases.select(F.col("words").alias("left"), F.col("f").alias("l"))
    right = phrases.select(F.col("words").alias("right"), F.col("f").alias("r"))
    cut = cut.select(
        "*", F.slice(words, 1, F.col("k")).alias("left"),
        F.slice(words, F.col("k") + 1, F.size("words") - F.col("k")).alias("right"),
    )
    cut = cut.join(left, "left").join(right, "right")
    score = F.expr("cast(cast(2000000 as decimal(8, 0)) * cast(a as decimal(20, 0)) div (cast(l as decimal(20, 0)) + r) as bigint)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("low")
    return cut.groupBy("words", "a").agg(lowest).select("words", "a", "low.*")


def longest_matter(candidates: DataFrame, phrases: DataFrame) -> DataFrame:
    """Candidates without those that a longer phrase covers in 4 of 5 occurrences or more."""
    n = F.size("words")
    inner = F.explode(F.array(F.slice("words", 1, n - 1), F.slice("words", F.lit(2), n - 1)))
    longer = phrases.filter(n > 2).select(inner.alias("words"), "f")
    longest = longer.groupBy("words").agg(F.max("f").alias("longest"))
    kept = F.coalesce(100 * F.col("longest").cast("decimal(20, 0)") < 80 * F.col("a").cast("decimal(20, 0)"), F.lit(True))
    return candidates.join(longest, "words", "left").filter(kept).drop("longest")


def collocations(
    docs: DataFrame,
    least: int = 30,
    most: int = 2000,
    shard_bytes: int = SHARD_BYTES,
    team_words: int = TEAM_WORDS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, k: the first ``most`` phrases of every language."""
    languages, frequent, phrases = count_phrases(index_texts(docs, shard_bytes), least, team_words)
    kept = longest_matter(scored(phrases), phrases)
    first_word = frequent.select(F.col("id").alias("_first"), "lang")
    kept = kept.withColumn("_first", F.element_at("words", 1)).join(first_word, "_first")
    # words of phrases are needed only up to the last place, all that tie there included
    first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    kept = stage(kept.withColumn("_rank", F.rank().over(first)).filter(F.col("_rank") <= most), "collocations")
    spelt = (
        kept.select("words", F.posexplode("words").alias("_at", "id"))
        .join(frequent.select("id", "word"), "id")
        .groupBy("words")
        .agg(F.sort_array(F.collect_list(F.struct("_at", "word"))).alias("_spelt"))
        .select("words", F.concat_ws(" ", F.col("_spelt.word")).alias("phrase"))
    )
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.join(spelt, "words").withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= most)
    whole = ["a", "l", "r", "n", "score", "k"]
    return ranked.join(languages.select("lang", "n"), "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", *(F.col(c).cast("bigint").alias(c) for c in whole)
    )
