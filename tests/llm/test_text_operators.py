"""Quality rules, packing, mixing, personal data and toxicity against plain versions."""

import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import DOCS, awkward_docs, words

from aerolake.llm import mixing, packing, pii, quality, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text):
    text = text or ""
    found = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    seen = Counter(zip(found, found[1:], found[2:]))
    inside = set()
    for i in range(len(found) - 2):
        if seen[tuple(found[i : i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    return (
        len(found),
        sum(map(len, found)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(inside),
    )


def test_quality_counts(spark):
    rng = random.Random(1)
    rows = awkward_docs()
    rows += [(100 + i, words(rng, 80, 6 + i), "de", "s", 0, None, None) for i in range(30)]
    rows += [(200, "a b a b a b a b\na b\na b\n\n\x0b# |", "de", "s", 0, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    out = quality.judge(docs, labels).collect()
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    have = Counter((r["doc_id"], *(r[f] for f in fields)) for r in out)
    assert have == Counter((r[0], *plain_measures(r[1])) for r in rows)
    for r in out:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed)


def test_binomial_tail(spark):
    from math import comb

    rows = [(k, n) for n in (1, 7, 40, 300) for k in (0, 1, 5, 39) if k <= n]
    frame = spark.createDataFrame(rows, "k bigint, n bigint")
    for row in frame.select("k", "n", quality.binomial_tail(frame.k, frame.n, 0.07).alias("p")).collect():
        exact = sum(comb(row["n"], i) * 0.07**i * 0.93 ** (row["n"] - i) for i in range(row["k"] + 1))
        assert row["p"] == pytest.approx(exact, rel=1e-9)


def test_quality_cutoffs_hold_the_risk(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(1600):
        good = i % 4 > 0
        noise = "" if good else " ### | $$$ ***" * 30
        rows.append((i, words(rng, 60, 5000) + noise, "en" if i % 2 else "fr", "s", 0, None, None))
        labels.append((i, int(good)))
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id bigint, quality int")
    truth = dict(labels)
    out = quality.judge(docs, known).collect()
    assert not any(r["kept"] for r in out if not truth[r["doc_id"]])
    lost = [r for r in out if truth[r["doc_id"]] and not r["kept"]]
    assert len(lost) <= 0.02 * 1200
    few = quality.judge(docs.limit(40), known).collect()  # too few labels to certify anything
    assert all(r["kept"] == (not r["base_failed"]) for r in few)


def test_quality_of_nothing(spark):
    docs = spark.createDataFrame([], DOCS)
    assert quality.judge(docs, spark.createDataFrame([], "doc_id bigint, quality int")).count() == 0


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def test_ids_equal_the_tokenizer(vocabulary):
    import pyarrow as pa
    from tokenizers import Tokenizer

    from aerolake.llm.tokens import ids_of_texts

    texts = [None, "", "Don't STOP</s> a\x1cb ΣΑΣ İstanbul ①② 12345 ", "<|endoftext|>x ...!? a.b,c. ÀÉ. über,"]
    texts += ["ŒUVRE ŉ ĸ ǅ ſ ̀x  thin\x0bspace", "word, word. Word WORD " * 50, "y" * 3000]
    tokenizer = Tokenizer.from_file(vocabulary)
    for text, ids in zip(texts, ids_of_texts(pa.array(texts), vocabulary)):
        assert ids.tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_packing_is_whole_and_tight(spark, vocabulary):
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    rng = random.Random(3)
    rows = awkward_docs() + [(300 + i, words(rng, rng.randrange(1, 90)), "en", "s", 0, None, None) for i in range(300)]
    docs = spark.createDataFrame(rows, DOCS)
    out = packing.pack_documents(docs, vocabulary, end=2, size=256).collect()
    tokenizer = Tokenizer.from_file(vocabulary)
    want = Counter()
    for doc_id, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        for start in range(0, len(ids), 256):
            part = np.array(ids[start : start + 256], "<u4").tobytes()
            want[doc_id, start, len(part) // 4, zlib.crc32(part), len(ids)] += 1
    assert want == Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out)
    used = defaultdict(list)
    for r in out:
        used[r.sequence_id].append((r.offset, r.length))
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r.length for r in out)
    assert total / (256 * len(used)) > 0.97
    packed = packing.sequences(docs, vocabulary, end=2, size=256).collect()
    assert sorted(s.sequence_id for s in packed) == sorted(used)
    for s in packed:
        assert len(s.ids) == 2 * s.n_tokens == 2 * sum(p.length for p in s.pieces)
    assert packing.pack_documents(docs.limit(0), vocabulary).count() == 0


def test_patterns_hold_the_histogram():
    rng = random.Random(4)
    for histogram in (
        {100: 10_000}, {1: 50_000}, {4096: 5, 1: 3}, {3000: 10, 1000: 25, 7: 1000},
        {rng.randrange(1, 4097): rng.randrange(1, 500) for _ in range(800)},
    ):
        patterns = packing.shortest_pack_first(histogram, 4096)
        held = Counter()
        for p in patterns:
            assert sum(length * copies for length, copies in p.runs) <= 4096
            for length, copies in p.runs:
                held[length] += copies * p.count
        assert held == Counter(histogram)


def test_period_stays_within_a_block():
    rng = random.Random(6)
    for count in (1, 2, 7, 60):
        weights = {f"s{i}": rng.random() ** 3 + 1e-6 for i in range(count)}
        parts = mixing.whole_parts(weights, 512)
        assert sum(parts.values()) == 512 and min(parts.values()) >= 1
        given = Counter()
        for slot, name in enumerate(mixing.one_period(parts), 1):
            given[name] += 1
            for source, part in parts.items():
                assert abs(given[source] - slot * part / 512) < 1


def test_mixing_places_every_document(spark):
    rng = random.Random(7)
    rows = awkward_docs()
    rows += [(500 + i, "t" * rng.randrange(1, 90), "en", rng.choice("aaaabbc"), 0, None, None) for i in range(900)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    out = mixing.mix(docs, {"a": 1.0, "b": 2.0, "c": 1.0}, block=100, period=64).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    # a slot belongs to one block of one source, and blocks come in order
    owner, last = {}, defaultdict(int)
    for r in sorted(out, key=lambda r: (r.slot, r.place)):
        assert owner.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
        assert r.block == r.place // 100 and r.place >= last[r.source]
        last[r.source] = r.place
    # while all sources last, each slot's share is kept to less than a block
    slots = mixing.schedule({"a": 200, "b": 200, "c": 50}, {"a": 1.0, "b": 2.0, "c": 1.0}, 64)
    assert [sorted(p.slots) for p in slots] == [["a", "b", "c"], ["a", "b"], ["a"]]
    assert mixing.mix(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, {"a": 0.0})


@pytest.mark.parametrize("weights", [None, {"s0": 3.0, "s7": 1.0, "elsewhere": 9.0}])
def test_mixing_of_more_sources_than_entries(spark, weights):
    rng = random.Random(9)
    rows = [(i, "t" * rng.randrange(1, 60), f"s{i % 2100}") for i in range(4000)]
    rows += [(10_000 + i, "t" * 500, "s0") for i in range(2000)]  # a third of the rows in one source
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    out = mixing.mix(docs, weights, block=200).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    assert len({r.source for r in out}) == 2100
    large = [r for r in out if r.source == "s0"]
    assert sorted(r.place for r in large)[0] == 0 and len({r.place for r in large}) == len(large)
    owner = {}  # a slot of a source of its own holds no other source
    for r in out:
        owner.setdefault(r.slot, set()).add(r.source)
    assert all(len(names) == 1 for names in owner.values() if "s0" in names)
    # within a slot, places tell the documents apart
    assert len({(r.slot, r.place) for r in out}) == len(out)


def test_sources_in_groups_keep_their_shares(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ENTRIES", 6)
    monkeypatch.setattr(mixing, "SHARED", 2)
    monkeypatch.setattr(mixing, "GROUP", 4)
    # in the order of the table each source comes whole, and each lasts for 12 blocks
    rows = [(s * 100 + i, "t" * 50, f"s{s:02}") for s in range(40) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").coalesce(1)
    weights = {f"s{s:02}": 1.0 + s % 2 for s in range(40)}
    out = mixing.mix(docs, weights, block=100).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    owner = {r.slot: (r.source, r.block) for r in out}
    assert sorted(owner) == list(range(40 * 12)) and len(set(owner.values())) == 40 * 12
    assert all(owner[r.slot] == (r.source, r.block) for r in out)
    assert all(r.block == r.place // 100 for r in out)
    given, last = Counter(), {}
    for slot in range(40 * 12):
        source, block = owner[slot]
        assert last.get(source, -1) == block - 1
        last[source] = block
        if slot < 200:  # all sources last
            given[source] += 1
            # less than a block on each of four levels
            assert all(abs(given[s] - (slot + 1) * w / 60) < 4 for s, w in weights.items())


@pytest.mark.parametrize("count", [1, 5, 40])
def test_schedule_gives_every_slot_once(count):
    rng = random.Random(count)
    blocks = {f"s{i}": rng.choice([1, 1, 2, 7, 300]) for i in range(count)}
    phases = mixing.schedule(blocks, {n: rng.random() + 0.01 for n in blocks}, 64)
    slots = [mixing.slots_of(phases, n, np.arange(b)).tolist() for n, b in blocks.items()]
    assert all(own == sorted(own) for own in slots)
    assert sorted(x for own in slots for x in own) == list(range(sum(blocks.values())))


def plain_spans(text):
    def luhn(digits):
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0

    out = []
    for kind, pattern in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if (
                kind == "email"
                or (kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")))
                or (kind == "card" and 14 <= len(digits) <= 19 and luhn(digits))
                or (kind == "phone" and 10 <= len(digits) <= 15)
            ):
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], pii.ORDER[s[0]]))


def test_base_spans_equal_the_patterns():
    rng = random.Random(8)
    pieces = ["a@b.c", "x@y@z.com", "@", ".", "1.2.3.4", "300.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "-", " ",
              "+1 (555) 123-4567", "+", "12", "é", "a.b+c@d-e.f.g", "0000.0255.1.1", "4111-1111-1111-1111", "\n"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_candidates_overlap_nothing():
    rng = random.Random(9)
    marks = ["4012 8888 8888 1881", "+49 171 2345678", "a.b@c.example", "password: h7Gk29LmQ0zX", "Dr. Anna Berg",
             "778812345", "10.2.3.4", "Q7w8E9r0T1y2U3i4O5p6", "word"]
    for _ in range(200):
        text = "".join(rng.choice(marks) + rng.choice([" ", "", "-", " +"]) for _ in range(rng.randrange(12)))
        base = pii.base_spans(text)
        out = pii.candidates(text, base)
        spans = sorted((c["start"], c["end"]) for c in out)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
        assert not any(a < end and start < b for a, b in spans for _, start, end in base)


def test_many_numbers_in_a_text():
    text = " und ".join(str(778800000 + i) for i in range(100_000))  # a space alone would join two
    begun = time.process_time()
    assert len(pii.candidates(text, [])) == 100_000
    assert time.process_time() - begun < 60  # minutes if each were compared with all others


def test_pii_adds_secrets_only(spark):
    rows = awkward_docs()
    secrets = [f"so AKIA{'ABCDEFGH2345JKLM'[i:] + 'ABCDEFGH2345JKLM'[:i]} it goes" for i in range(12)]
    secrets += [f"then password=q{i}w8e7r6t5y4u3i{i} here" for i in range(12)]
    rows += [(1000 + i, t, "en", "s", 0, None, None) for i, t in enumerate(secrets)]
    rows += [(2000 + i, f"page 12345678{i} and version 2.0", "en", "s", 0, None, None) for i in range(9)]
    docs = spark.createDataFrame(rows, DOCS)
    out = pii.find_spans(docs).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    for r in out:
        wanted = r.doc_id is not None and 1000 <= r.doc_id < 2000
        assert r.n_added == int(wanted) and ("secret:" in r.spans) == wanted
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert clean[1000] == "so <SECRET> it goes" and clean[0] is None and clean[2000] == rows[-9][1]
    assert pii.find_spans(docs.limit(0)).count() == 0


def test_reliabilities_are_found():
    import numpy as np

    rng = np.random.default_rng(9)
    truth = rng.random(4000) < 0.3
    votes = np.stack([np.where(rng.random(4000) < a, truth, ~truth) * 2 - 1 for a in (0.9, 0.8, 0.7)], axis=1)
    found = pii.aggregate_votes(votes, np.ones(4000)) > 0.5
    assert (found == truth).mean() > 0.88


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i:] == b[i + 1 :] or (len(a) == len(b) and a[i + 1 :] == b[i + 1 :])


def test_automaton_equals_edit_distance():
    rng = random.Random(10)
    make = lambda n: "".join(rng.choice("abc") for _ in range(n))
    terms = sorted({make(rng.randrange(5, 9)) for _ in range(30)})
    lexicon = toxicity.Lexicon(dict.fromkeys(terms, 1.0), {})
    for _ in range(4000):
        word = make(rng.randrange(3, 10))
        near = [t for t in terms if t == word or one_edit(t, word)]
        assert lexicon.misspelled(word) == (near[0] if near else None)


def toxic_rows(n):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        said = words(rng, 60).split()
        if toxic:
            for _ in range(3):
                said.insert(rng.randrange(60), rng.choice(["vileword", "badterm", f"grr{rng.randrange(99)}"]))
        rows.append((i, " ".join(said), "en", "s", 0, 0.0, None))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_is_learned(spark):
    rows, labels = toxic_rows(1500)
    base = words(random.Random(12), 60)
    extra = [(5000, f"{base} vilewrd {base} badtrem", "en", "s", 0, 0.0, None),
             (5001, f"{base} vileword, you badterm", "en", "s", 0, 0.0, None),
             (5002, base, "en", "s", 0, 0.0, None)]
    docs = spark.createDataFrame(rows + extra + awkward_docs()[:5], DOCS)
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.fit(docs, known.filter(~toxicity.held_out()))
    assert {"vileword", "badterm"} <= set(model.words) | set(model.beginnings)
    scored = toxicity.with_score(docs, model)
    assert scored.columns.count("score") == 1
    out = {r.doc_id: r.score for r in scored.collect()}
    test = [r.doc_id for r in known.filter(toxicity.held_out()).collect()]
    right = sum((out[i] >= 0.5) == (i % 5 == 0) for i in test)
    assert right / len(test) > 0.97
    assert out[5001] > 0.5 > out[5002] and 0 <= out[1] <= 1


def test_words_beside_their_beginning_keep_the_misspelling_search(spark):
    rng = random.Random(14)
    rows, labels = [], []
    for i in range(1500):
        said = words(rng, 40).split()
        if i % 5 == 0:
            said += [("loser", "scum")[i % 2], f"grr{rng.randrange(99)}"]
        else:
            said += [rng.choice(["scam", "closer", "fine"])] + [f"lose{'abcdefghijklm'[i % 13]}q"] * (i % 50 == 1)
        rows.append((i, " ".join(said), "en", "s", 0, 0.0, None))
        labels.append((i, int(i % 5 == 0)))
    docs = spark.createDataFrame(rows, DOCS)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    lexicon = toxicity.Lexicon(model.words, model.beginnings, model.clean)
    for said, term in {"loser": "loser", "looser": "loser", "lozer": "loser", "l0ser": "loser", "scvm": "scum"}.items():
        assert lexicon.find(said)[:2] == (term, model.words[term])
    assert lexicon.find("grr77x")[0].startswith("grr")
    for said in ("losesartaga", "scam", "closer", "fine"):
        assert lexicon.find(said) is None


def test_quotation_counts_less():
    hit = ("vileword", 3.0, True)
    direct = toxicity.features(40, [(5, hit, ["oh", "you"], "vileword", ["there"])])
    quoted = toxicity.features(40, [(5, hit, ["the", "word"], '"vileword"', ["is", "old"])])
    assert quoted[1] < direct[1] and quoted[5] > 0 and direct[6] > 0


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame(awkward_docs(), DOCS)
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert {r.score for r in toxicity.with_score(docs, model).collect()} == {0.0}
    assert toxicity.with_score(docs.limit(0), model).count() == 0


def test_lexicon_is_whole_and_repeated_ids_are_defined(spark):
    rows, labels = [], []
    bad = [f"zq{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}x" for i in range(3200)]
    for i in range(120):
        rows.append((i, " ".join(bad) if i % 2 else "calm plain words"))
        labels.append((i, i % 2))
    rows.append((0, "aaa calm"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert set(bad) <= set(model.words)  # more than 3000
