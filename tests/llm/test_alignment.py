"""Alignment of two tokenizers against whole texts, token by token."""

import hashlib
import random
import sys
from collections import Counter, defaultdict, deque

import numpy as np
import pytest
from helpers import DOCS, awkward_docs

from aerolake.llm import alignment

FIELDS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def paths():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain_tokens(both, text):
    """(id, bytes) of both sides of a whole text, or nothing if a side changes it."""
    a = both.first.encode(" " + text, add_special_tokens=False).ids
    b = both.second.encode(text)
    sides = [[(i, both.first_bytes[i]) for i in a], [(i, both.second_bytes[i]) for i in b]]
    whole = (" " + text).encode()
    return sides if text and all(b"".join(t for _, t in side) == whole for side in sides) else None


def plain(both, rows):
    """All measures with loops over tokens and bytes."""
    aligned, counts = {}, Counter()
    for _, text in rows:
        sides = plain_tokens(both, text or "")
        if sides is None:
            continue
        links = []
        spans = []
        for side in sides:
            end, found = 0, []
            for i, token in side:
                found.append((i, end, end + len(token)))
                end += len(token)
            spans.append(found)
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        owner = defaultdict(list)
        for i, start, end in spans[1]:
            for byte in range(start, end):
                owner[byte] = (i, start)
        for i, start, end in spans[0]:
            links += [(i, b) for b, _ in dict.fromkeys(owner[byte] for byte in range(start, end))]
        texts = []
        for side in spans:
            parts, left = [[]], deque(cuts)
            for i, _, end in side:
                parts[-1].append(str(i))
                if end == left[0]:
                    left.popleft()
                    parts.append([])
            texts.append([",".join(part) for part in parts[:-1]])
        aligned[text] = (len(spans[0]), len(spans[1]), len(cuts), links, ";".join(map("|".join, zip(*texts))))
        counts.update(links)
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for doc_id, text in rows:
        if text not in aligned:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, links, groups = aligned[text]
        best = sum(counts[p] == highest[p[1]] for p in links)
        digest = hashlib.sha256(groups.encode()).hexdigest()
        out.append((doc_id, n_a, n_b, n_groups, len(links), best, sum(counts[p] for p in links), digest))
    return Counter(out)


ODD = [
    "don't  stop\n\n 's  ", " ", "  ", "a ", " a", "x▁y z", "▁", "<|endoftext|> and </s> <s> <unk> <0x41>",
    "a  b  c  d　 e\u0085 f \u0085 g", "café à ï è fin", "\x00 a\x00 b", "\x1c a \x1d b\x1f c",
    "你好 世界 \U0001f600\U0001f600 ok", "é ﬁ Å", "tab\t tab \t\ttab\r\n end\n", "﻿ bom", "1234567 12 3", "  a  b",
    "  a  b  c", "...   ,,, !!", "a" * 300, "word " * 400,
]


@pytest.mark.parametrize("slice_bytes", [300, 10**6])
def test_alignment_equals_whole_texts(spark, paths, slice_bytes):
    rng = random.Random(8)
    alphabet = ["the", "Straße", "don't", "it's", " ", "  ", "\n", ".", "été", "token", "ization", "42", "\t", " ", "_x"]
    rows = awkward_docs()
    rows += [(200 + i, text, "en", None, None, None, None) for i, text in enumerate(ODD + ODD[:5])]
    for i in range(80):
        text = "".join(rng.choice(alphabet) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(1, 50)))
        rows += [(300 + i, text, None, "s", 0, 0.0, "")] * rng.choice([1, 1, 3])
    out = alignment.align(spark.createDataFrame(rows, DOCS), *paths, slice_bytes).collect()
    have = Counter(tuple(r[f] for f in FIELDS) for r in out)
    assert have == plain(alignment.tokenizers(*paths), [r[:2] for r in rows])


def test_alignment_of_nothing(spark, paths):
    assert alignment.align(spark.createDataFrame([], DOCS), *paths).collect() == []
    rows = [(1, None, "", "", 0, 0.0, ""), (2, "▁", "", "", 0, 0.0, "")]
    out = alignment.align(spark.createDataFrame(rows, DOCS), *paths).collect()
    assert sorted(tuple(r[f] for f in FIELDS) for r in out) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


def test_units_are_tokenised_like_whole_texts(paths):
    both = alignment.tokenizers(*paths)
    rng = random.Random(9)
    letters = [" ", " ", " ", "a", "b", "'", "s", "1", ".", "\n", "\t", " ", " ", "\u0085", "é", "日", "　", "​"]
    for _ in range(3000):
        text = "".join(rng.choices(letters, k=rng.randrange(1, 14)))
        raw = np.frombuffer((" " + text).encode(), np.uint8)
        starts = [0, *alignment.unit_starts(raw).tolist(), len(raw)]
        units = [raw[a:b].tobytes() for a, b in zip(starts, starts[1:])]
        first, second = both.ids(units)
        assert sum(first, []) == both.first.encode(" " + text, add_special_tokens=False).ids, text
        assert sum(second, []) == both.second.encode(text), text


def test_remembered_units_are_forgotten_in_turn(paths, monkeypatch):
    monkeypatch.setattr(alignment, "_REMEMBERED", 3)
    both = alignment.Tokenizers(*paths)
    units = [f" w{i}".encode() for i in range(9)]
    for part in (units[:2], units[2:7], units, units[:1], units[5:]):
        assert [u.groups for u in both.find(part)] == [u.groups for u in both._align(part)]
    assert len(both.new) <= 3


def test_alignment_works_on_batches_of_units(paths):
    both = alignment.Tokenizers(*paths)
    rng = random.Random(12)
    units = {f" {''.join(rng.choices('abcdeéß日.19', k=rng.randrange(1, 12)))}".encode() for _ in range(4000)}
    units = sorted(units)
    calls = 0

    def count(frame, event, _):
        nonlocal calls
        calls += event == "call" and frame.f_code.co_filename == alignment.__file__

    tokens = both.ids(units)
    both.ids = lambda _: tokens
    sys.setprofile(count)
    try:
        found = both._align(units)
    finally:
        sys.setprofile(None)
    assert calls < 1.5 * len(units)  # one object each; was six for a unit
    for unit, first, second, got in zip(units, *tokens, found):
        texts = [b"".join(table[i] for i in ids) for table, ids in ((both.first_bytes, first), (both.second_bytes, second))]
        assert (got is not None) == (texts == [unit, unit])
        if got is not None:
            groups = [group.split("|") for group in got.groups.decode().split(";")]
            sides = [[int(i) for group in groups for i in group[side].split(",")] for side in (0, 1)]
            assert sides == [first, second] and (got.n_a, got.n_b, got.n_groups) == (len(first), len(second), len(groups))
