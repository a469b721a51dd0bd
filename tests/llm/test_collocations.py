"""Collocations against counts by brute force, with shards of a few words and of whole texts."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from helpers import DOCS, awkward_docs

from aerolake.llm import collocations


def plain_words(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n\x0b\x0c\r]", text)]


def plain_collocations(rows, least, most):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for words in plain_words(text):
            totals[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, found in counts.items():
        kept = []
        longest = Counter()
        for phrase, f in found.items():
            for size in range(2, len(phrase)):
                for i in range(len(phrase) - size + 1):
                    inner = phrase[i : i + size]
                    longest[inner] = max(longest[inner], f)
        for phrase, a in found.items():
            if a < least or len(phrase) < 2 or 100 * longest[phrase] >= 80 * a:
                continue
            cuts = [(phrase[:k], phrase[k:]) for k in range(1, len(phrase))]
            score, k = min((2000000 * a // (found[x] + found[y]), k) for k, (x, y) in enumerate(cuts))
            l, r = (found[part] for part in cuts[k])
            kept.append((-score, -a, " ".join(phrase).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


FIELDS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def found(spark, rows, least, most, shard_bytes, team_words=10**6):
    docs = spark.createDataFrame(rows, DOCS)
    out = collocations.collocations(docs, least, most, shard_bytes, team_words).collect()
    return sorted(tuple(r[f] for f in FIELDS) for r in out)


@pytest.mark.parametrize("shard_bytes, team_words", [(150, 400), (4000, 10**6)])
def test_collocations_equal_brute_force(spark, shard_bytes, team_words):
    rng = random.Random(3)
    vocabulary = ["New", "york", "é", "the", "of", "\x01", "a", "City", "zß", "x"]
    rows = awkward_docs()
    for i in range(160):
        text = "".join(
            rng.choices(vocabulary, [5, 5, 2, 6, 4, 1, 3, 4, 1, 2])[0]
            + rng.choices([" ", "\t ", ". ", ",", "\n", " new york city "], [12, 1, 2, 1, 1, 3])[0]
            for _ in range(rng.randrange(1, 60))
        )
        rows.append((i, text, rng.choice(["en", None, "und", "fr"]), "s", 0, 0.0, None))
    for least, most in ((3, 2000), (8, 7)):
        assert found(spark, rows, least, most, shard_bytes, team_words) == plain_collocations(
            [(r[1], r[2]) for r in rows], least, most
        )


def test_collocations_of_nothing(spark):
    assert found(spark, [], 2, 10, 1000) == []
    assert found(spark, [(1, None, "en", None, None, None, None), (2, ".,", "en", "", 0, 0.0, "")], 1, 10, 1000) == []


def test_one_piece_longer_than_a_shard(spark):
    rows = [(1, "tick tock " * 500, "en", None, None, None, None)]
    assert found(spark, rows, 30, 10, 64) == plain_collocations([(rows[0][1], "en")], 30, 10)


def test_scores_are_exact_beyond_64_bits(spark):
    rows = [([1], 6 * 10**18), ([2], 5 * 10**18), ([1, 2], 4 * 10**18), ([3], 5 * 10**18), ([2, 3], 39 * 10**17),
            ([1, 2, 3], 32 * 10**17 - 1)]
    phrases = spark.createDataFrame(rows, "words array<bigint>, f bigint")
    out = {tuple(r["words"]): (r["k"], r["score"]) for r in collocations.scored(phrases).collect()}
    assert out[1, 2] == (1, 2000000 * 4 * 10**18 // (11 * 10**18))
    a = 32 * 10**17 - 1
    cuts = {1: 2000000 * a // (6 * 10**18 + 39 * 10**17), 2: 2000000 * a // (9 * 10**18)}
    assert out[1, 2, 3] == min((k, s) for k, s in cuts.items() if s == min(cuts.values()))
    kept = {tuple(r["words"]) for r in collocations.longest_matter(collocations.scored(phrases), phrases).collect()}
    assert kept == {(1, 2), (1, 2, 3)}  # 80 % of (2, 3) is less than the longer one's count


def test_intervals_of_one_shard():
    """Pairs and longer phrases by extension are those of the text."""
    rng = np.random.default_rng(4)
    ids = np.concatenate(([0], rng.integers(0, 6, 3000)))
    forward, backward = collocations.transforms(ids, 6)
    first, second, counts, _ = collocations.pairs_of(forward)
    keep = (first > 0) & (second > 0)
    longer = list(collocations.longer_phrases(forward, backward, first[keep], second[keep]))
    have = [dict(zip(zip(first[keep].tolist(), second[keep].tolist()), counts[keep].tolist()))]
    have += [dict(zip(zip(*(w.tolist() for w in words)), n.tolist())) for *words, n in longer]
    for size, got in zip((2, 3, 4), have):
        want = Counter(tuple(ids[i : i + size].tolist()) for i in range(len(ids) - size + 1))
        assert got == {k: v for k, v in want.items() if 0 not in k}


def test_wide_alphabets_sort_alike():
    rng = np.random.default_rng(5)
    words = [rng.integers(0, 50, 500) for _ in range(3)]
    orders = [collocations._order(*words, size) for size in (50, 2**21)]
    keys = [list(zip(*(w[o].tolist() for w in words))) for o in orders]
    assert keys[0] == keys[1] == sorted(keys[0])


def test_pairs_of_a_team_take_little_memory():
    rng = np.random.default_rng(5)
    vocabulary = np.array([f"w{i}" for i in range(2000)])
    counts, batches, longest = Counter(), [], 0
    for shard in range(8):
        text = vocabulary[rng.integers(0, 2000, 200_000)]
        counts.update(zip(text.tolist(), text[1:].tolist()))
        index = pa.Table.from_batches(list(collocations._index_rows(shard, "en", " ".join(text).encode())))
        blocks = index.filter(pc.is_valid(index["block"])).select(["shard", "block", "forward"])
        local = index.filter(pc.is_valid(index["local"])).select(["shard", "local", "word"])
        ids = pa.array([int(w[1:]) << 33 for w in local["word"].to_pylist()])  # as Spark numbers rows
        for rows, kind, a, b, forward in (
            (blocks, 0, blocks["block"], pa.nulls(len(blocks), pa.int64()), blocks["forward"]),
            (local, 1, local["local"], ids, pa.nulls(len(local), pa.binary())),
        ):
            columns = {"team": pa.array([7] * len(rows)), "shard": rows["shard"], "kind": pa.array([kind] * len(rows)),
                       "a": a.cast(pa.int64()), "b": b, "forward": forward}
            batches += pa.table(columns).to_batches()
        longest = max(longest, len(text))
    pairs = 0
    out = Counter()
    tracemalloc.start()
    for batch in collocations._pairs(iter(batches)):
        pairs += len(batch)
        if pairs <= 200_000:  # the generator holds all shards by now
            for first, second, team, n in zip(*(c.to_pylist() for c in batch.columns)):
                assert team == 7
                out[f"w{first >> 33}", f"w{second >> 33}"] += n
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert pairs == len(counts)
    assert out and all(counts[key] == n for key, n in out.items())
    # some 1.6 million pairs of shards; merged at once they took 150 bytes each
    assert peak < 150 * longest + 60 * 8 * longest
