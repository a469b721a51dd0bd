"""Toxicity: Levenshtein automata over a lexicon trie, and scores of the words around each hit.

The lexicon (words, and word beginnings that many words share) is learned from labelled documents
by its likelihood ratio; a beginning needs evidence besides its strongest word. Words of a text that are not in it run through the Levenshtein automaton of the trie of all learned
words, made deterministic as it is used, so that a misspelled term costs a few table look-ups and
any other word usually leaves the automaton after some letters. Words that clean documents use are
no misspellings. Each hit gets a
context: inside quotation marks or beside words of report it counts less, beside words of address
it counts as abuse. A logistic regression of these scores gives the probability of the label.

The model is fitted on at most ``MAX_LABELLED`` labelled documents of each class for the lexicon
and as many for the regression (smallest hashes first); scoring covers all whole texts.

Defined results: null and empty texts are scored as texts without words; repeated rows are scored
each; labels repeated for a document count once, toxic if any says so; without both classes among
the labels the lexicon is empty and every score is the share of toxic labels (0 without labels).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import WORD_GAP, in_batches
from aerolake.plans.tables import stage

MAX_LABELLED = 6000  # of each class, for the lexicon and for the regression
LEAST_RATIO = 25.0  # likelihood ratio statistic of a term
LEAST_WEIGHT = 2.0  # log likelihood ratio of a term
COMMON = 2  # clean documents that make a word one of its own, not a misspelling
BEGINNINGS = (4, 5, 6, 7)
FUZZY_LETTERS = 4  # shortest term that may be misspelled
NEAR, WINDOW = 6, 32  # words around a hit
_EDGE = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~«»“”„‘’‚‹›…–—¿¡"
_OPENING, _CLOSING = "\"'«“„‘‚‹", "\"'»”“’‘›"
# Words of report and of address, and look-alike characters.
_REPORT = frozenset(
    "said says say saying quote quoted quotes wrote called word words term phrase insult slur means "
    "dit disait mot sagte sagt wort nannte dijo dice palabra llamó".split()
)
_ADDRESS = frozenset(
    "you your youre are u du dich dir bist ihr tu toi te vous es eres tú usted ustedes".split()
)
_LOOKALIKE = str.maketrans("01345@$!7", "oieasasit")


class Lexicon:
    """Words and beginnings with weights, and the automaton that finds misspelled words."""

    def __init__(
        self, words: dict[str, float], beginnings: dict[str, float], clean: frozenset[str] = frozenset()
    ):
        self.words, self.beginnings, self.clean = words, beginnings, clean
        self.lengths = sorted({len(b) for b in beginnings})
        self.nodes: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        for word in sorted(words):
            if len(word) >= FUZZY_LETTERS and word.isalpha():
                self._add(word)
        self.states: dict[frozenset, int] = {}
        self.members: list[frozenset] = []
        self.ends: list[str | None] = []
        self.steps: dict[tuple[int, str], int] = {}
        self.start = self._state(self._closure({(0, 1)}))

    def _add(self, word: str) -> None:
        node = 0
        for letter in word:
            if letter not in self.nodes[node]:
                self.nodes[node][letter] = len(self.nodes)
                self.nodes.append({})
                self.term.append(None)
            node = self.nodes[node][letter]
        self.term[node] = word

    def _closure(self, items: set) -> frozenset:
        """With the term letters that the word may lack."""
        out, left = set(items), list(items)
        while left:
            node, edits = left.pop()
            if edits:
                for child in self.nodes[node].values():
                    if (child, edits - 1) not in out:
                        out.add((child, edits - 1))
                        left.append((child, edits - 1))
        # of the same node, the one with more edits left says all
        best: dict[int, int] = {}
        for node, edits in out:
            best[node] = max(edits, best.get(node, 0))
        return frozenset(best.items())

    def _state(self, items: frozenset) -> int:
        known = self.states.get(items)
        if known is None:
            known = self.states[items] = len(self.members)
            self.members.append(items)
            ends = [self.term[node] for node, _ in items if self.term[node]]
            self.ends.append(min(ends) if ends else None)
        return known

    def _step(self, state: int, letter: str) -> int:
        out = set()
        for node, edits in self.members[state]:
            child = self.nodes[node].get(letter)
            if child is not None:
                out.add((child, edits))
            if edits:
                out.add((node, edits - 1))  # a letter too many
                out.update((c, edits - 1) for c in self.nodes[node].values())  # another letter
        known = self.steps[state, letter] = self._state(self._closure(out)) if out else -1
        return known

    def misspelled(self, word: str) -> str | None:
        """A term at most one edit away, the first in order."""
        state, steps = self.start, self.steps
        for letter in word:
            state = steps.get((state, letter), -2)
            if state == -2:
                return self._slow(word)
            if state < 0:
                return None
        return self.ends[state]

    def _slow(self, word: str) -> str | None:
        if len(self.members) > 200_000:  # start the tables anew, they are only a memory
            self.states, self.members, self.ends, self.steps = {}, [], [], {}
            self.start = self._state(self._closure({(0, 1)}))
        state = self.start
        for letter in word:
            known = self.steps.get((state, letter))
            state = self._step(state, letter) if known is None else known
            if state < 0:
                return None
        return self.ends[state]

    def find(self, chunk: str) -> tuple[str, float, bool] | None:
        """(term, weight, exact) of a piece of text between white space."""
        word = chunk.strip(_EDGE).lower()
        if len(word) < 3:
            return None
        weight = self.words.get(word)
        if weight is not None:
            return word, weight, True
        for length in self.lengths:
            weight = self.beginnings.get(word[:length]) if len(word) >= length else None
            if weight is not None:
                return word[:length], weight, True
        if not word.isalpha():
            plain = chunk.lower().translate(_LOOKALIKE).strip(_EDGE)
            if plain in self.words:
                return plain, self.words[plain], False
            word = plain
        if len(word) >= FUZZY_LETTERS - 1 and word not in self.clean and (term := self.misspelled(word)):
            return term, self.words[term], False
        return None


def _quoted(before: list[str], chunk: str, after: list[str]) -> bool:
    opened = chunk[:1] in _OPENING or any(w[:1] in _OPENING and w[-1:] not in _CLOSING for w in before)
    closed = chunk.rstrip(".,;:!?")[-1:] in _CLOSING or any(
        w.rstrip(".,;:!?")[-1:] in _CLOSING and w[:1] not in _OPENING for w in after
    )
    return opened and closed


FEATURES = 9


def features(n_words: int, hits: list[tuple[int, tuple, list[str], str, list[str]]]) -> np.ndarray:
    """Scores of one document from its hits: (place, found, words before, chunk, words after)."""
    out = np.zeros(FEATURES)
    out[0] = math.log1p(n_words) / 10
    if not hits:
        return out
    exact = fuzzy = quoted = abuse = 0.0
    for _, (_, weight, sure), before, chunk, after in hits:
        near = {w.strip(_EDGE).lower() for w in before + after}
        share = 1.0
        if _quoted(before, chunk, after):
            share, quoted = 0.25, quoted + 1
        elif near & _REPORT:
            share = 0.5
        if near & _ADDRESS:
            abuse += share
        if sure:
            exact += share * weight
        else:
            fuzzy += share * weight
    places = [hit[0] for hit in hits]
    most = max(sum(p <= q < p + WINDOW for q in places[i : i + WINDOW]) for i, p in enumerate(places))
    out[1:] = (
        math.log1p(exact), math.log1p(fuzzy), math.log1p(len({h[1][0] for h in hits})),
        math.log1p(most), math.log1p(quoted), math.log1p(abuse),
        exact > 0, len(hits) / math.sqrt(n_words),
    )
    return out


@dataclass
class ToxicityModel:
    words: dict[str, float] = field(default_factory=dict)
    beginnings: dict[str, float] = field(default_factory=dict)
    weights: list[float] | None = None
    share: float = 0.0
    clean: frozenset[str] = frozenset()  # words near a term that are not misspellings of it

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(rows), self.share)
        w = np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(rows @ w[1:] + w[0], -30, 30)))


def _features_of(texts: pa.Array, lexicon: Lexicon, known: dict) -> np.ndarray:
    from aerolake.llm.tokens import slices

    texts = pc.fill_null(texts, "")
    out = np.zeros((len(texts), FEATURES))
    for start, length in slices(texts):
        lists = pc.ascii_split_whitespace(texts.slice(start, length))
        coded = pc.list_flatten(lists).dictionary_encode()
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        chunks = coded.dictionary.to_numpy(zero_copy_only=False)
        places = coded.indices.to_numpy(zero_copy_only=False)
        if len(known) > 300_000:
            known.clear()
        found = []
        for chunk in chunks.tolist():
            hit = known.get(chunk, 0)
            if hit == 0:
                hit = known[chunk] = lexicon.find(chunk)
            found.append(hit)
        marked = np.fromiter((x is not None for x in found), bool, len(found))
        ends = np.cumsum(sizes)
        real = np.fromiter((c != "" for c in chunks.tolist()), bool, len(chunks))
        counted = np.concatenate(([0], np.cumsum(real[places])))
        n_words = counted[ends] - counted[ends - sizes]
        hits: dict[int, list] = {}
        spots = np.flatnonzero(marked[places])
        for at, row in zip(spots.tolist(), np.searchsorted(ends, spots, side="right").tolist()):
            first, last = int(ends[row] - sizes[row]), int(ends[row])
            before = chunks[places[max(first, at - NEAR) : at]].tolist()
            after = chunks[places[at + 1 : min(last, at + 1 + NEAR)]].tolist()
            place = places[at]
            hits.setdefault(row, []).append((at, found[place], before, chunks[place], after))
        for row in range(length):
            out[start + row] = features(int(n_words[row]), hits.get(row, []))
    return out


def _score(batches: Iterator[pa.RecordBatch], model: ToxicityModel, name: str, raw: bool):
    lexicon = Lexicon(model.words, model.beginnings, model.clean)
    known: dict = {}
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text"))
        rows = _features_of(texts, lexicon, known)
        if raw:
            new = pa.array(list(rows), pa.list_(pa.float64()))
        else:
            new = pa.array(model.score(rows), pa.float64())
        columns = [*batch.columns, new]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, name])
        pa.default_memory_pool().release_unused()


def with_score(
    docs: DataFrame, model: ToxicityModel, name: str = "score", raw: bool = False
) -> DataFrame:
    """All columns of ``docs`` and the score of ``text``; a column of that name is replaced."""
    rows = docs.drop(name)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    kind = "array<double>" if raw else "double"
    work = partial(_score, model=model, name=name, raw=raw)
    return in_batches(rows, work, f"{fields}, `{name}` {kind}")


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights by Newton's method, the intercept first and without penalty."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _ratio(toxic: F.Column, clean: F.Column, n_toxic: int, n_clean: int) -> F.Column:
    """Likelihood ratio statistic of a term being as common in both classes."""
    share = n_toxic / (n_toxic + n_clean)
    both = toxic + clean

    def part(seen: F.Column, expected: F.Column) -> F.Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    return 2 * (part(toxic, both * share) + part(clean, both * (1 - share)))


def _weight(n_toxic: int, n_clean: int) -> F.Column:
    toxic, clean = F.col("toxic"), F.col("clean")
    return F.log((toxic + 0.5) / (n_toxic + 1.0)) - F.log((clean + 0.5) / (n_clean + 1.0))


def _terms(counted: DataFrame, n_toxic: int, n_clean: int, least_words: int) -> dict[str, float]:
    """All significant terms. They come from at most ``2 * MAX_LABELLED`` texts, and a term needs
    several of them to be significant, so the sample bounds their number."""
    toxic, clean = F.col("toxic"), F.col("clean")
    weight = _weight(n_toxic, n_clean)
    ratio = _ratio(toxic, clean, n_toxic, n_clean)
    rows = (
        counted.select("term", "n_terms", weight.alias("weight"), ratio.alias("ratio"))
        .filter((F.col("ratio") >= LEAST_RATIO) & (F.col("weight") >= LEAST_WEIGHT))
        .filter(F.col("n_terms") >= least_words)
        .orderBy("term")
        .collect()
    )
    return {row["term"]: row["weight"] for row in rows}


def _near(batches: Iterator[pa.RecordBatch], terms: dict[str, float]):
    """The words that the automaton takes for misspelled terms."""
    lexicon = Lexicon(terms, {})
    for batch in batches:
        near = [lexicon.misspelled(word) is not None for word in batch.column(0).to_pylist()]
        yield batch.filter(pa.array(near, pa.bool_()))


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """A model of ``labels`` (doc_id, toxic), which may all be used for learning.

    It learns from at most ``MAX_LABELLED`` documents of each class for the lexicon and as many for
    the regression. An id with several labels is toxic if one says so, one with several texts
    gives the smallest.
    """
    truth = labels.filter(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # two thirds for the lexicon, the rest for the regression, so it sees the lexicon's mistakes
    part = F.when(F.pmod(F.xxhash64("doc_id"), F.lit(3)) < 2, "lexicon").otherwise("regression")
    by_hash = [F.xxhash64(F.col("doc_id"), F.lit("sample")), F.col("doc_id")]
    chosen = None
    for name in ("lexicon", "regression"):
        for toxic in (0, 1):
            one = truth.withColumn("part", part).filter((F.col("part") == name) & (F.col("toxic") == toxic))
            one = one.orderBy(*by_hash).limit(MAX_LABELLED)
            chosen = one if chosen is None else chosen.unionByName(one)
    chosen = stage(chosen, "toxicity-labels")
    known = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most 4 MAX_LABELLED
    single = known.groupBy("doc_id", "part", "toxic").agg(F.min("text").alias("text"))
    known = stage(single, "toxicity-sample")
    sizes = {(r["part"], r["toxic"]): r["count"] for r in known.groupBy("part", "toxic").count().collect()}
    n = [sum(v for (_, t), v in sizes.items() if t == toxic) for toxic in (0, 1)]
    share = n[1] / (n[0] + n[1]) if sum(n) else 0.0
    clean, toxic = (sizes.get(("lexicon", t), 0) for t in (0, 1))
    if not clean or not toxic:
        return ToxicityModel(share=share)
    chunks = F.split(F.lower(F.coalesce("text", F.lit(""))), WORD_GAP)
    edge = "[" + re.escape(_EDGE) + "]+"
    bare = F.transform(chunks, lambda w: F.regexp_replace(w, f"^{edge}|{edge}$", ""))
    words = (
        known.filter(F.col("part") == "lexicon")
        .select("toxic", F.explode(F.array_distinct(bare)).alias("term"))
        .filter(F.length("term") >= 3)
        .groupBy("term")
        .agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean"))
        .withColumn("n_terms", F.lit(1))
    )
    words = stage(words, "toxicity-words")
    model = ToxicityModel(_terms(words, toxic, clean, 1), share=share)
    starts = F.array(*[F.substring("term", 1, size) for size in BEGINNINGS])
    shared = words.filter(F.length("term") > BEGINNINGS[0]).select(
        "toxic", "clean", F.explode(F.array_distinct(starts)).alias("term")
    )
    # one word speaks for itself: the strongest is left out, and several need to be seen in toxic texts
    beginnings = (
        shared.groupBy("term")
        .agg(
            F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"),
            F.count_if(F.col("toxic") > 0).alias("n_terms"),
            F.max(F.struct("toxic", (-F.col("clean")).alias("clean"))).alias("most"),
        )
        .select(
            "term", "n_terms",
            (F.col("toxic") - F.col("most.toxic")).alias("toxic"),
            (F.col("clean") + F.col("most.clean")).alias("clean"),
        )
    )
    model.beginnings = _terms(beginnings, toxic, clean, 4)
    # a longer beginning says nothing that its own beginning does not
    model.beginnings = {
        b: w for b, w in model.beginnings.items()
        if not any(b[:size] in model.beginnings for size in BEGINNINGS if size < len(b))
    }
    usual = words.filter((F.col("clean") >= COMMON) & (_weight(toxic, clean) < LEAST_WEIGHT))
    near = in_batches(usual.select("term"), partial(_near, terms=model.words), "term string")
    model.clean = frozenset(row["term"] for row in near.collect())  # one edit from a term
    seen = with_score(known.filter(F.col("part") == "regression"), model, "x", raw=True)
    rows = seen.select("x", "toxic").collect()  # at most 2 MAX_LABELLED rows of numbers
    y = np.array([row["toxic"] for row in rows], dtype=float)
    if len(set(y.tolist())) == 2:
        model.weights = _logistic(np.array([row["x"] for row in rows]), y).tolist()
    return model


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows of a fifth of the ids, never used for learning."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0
