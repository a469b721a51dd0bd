"""Personal data: base patterns, and spans added by weakly supervised labelers.

Besides the base patterns, wide candidate patterns propose spans: secrets, numbers of people, and
names. Labelers (patterns, gazetteers, words of the context) vote on each candidate. Expectation
maximisation over the counts of all vote patterns in the corpus estimates how reliable each labeler
is and how likely each pattern is personal data. These likelihoods train a logistic classifier of
votes and the shape of the span, whose verdict decides which candidates become spans.

What reaches the driver is one row for each combination of votes and shape, whose number is
bounded by the labelers, not by the corpus.

Defined results: null text is empty; repeated rows are searched each; where candidates overlap the
longest, then the first, is kept; a candidate that overlaps a base span is dropped. Other columns
are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import batch_of, in_batches
from aerolake.plans.tables import stage

BASE = ("email", "ip", "card", "phone")
ADDED = ("secret", "number", "name")
ORDER = {kind: place for place, kind in enumerate(BASE + ADDED)}
LEAST = 0.9  # probability from which a candidate is a span

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# starting only where a run of digits starts finds the same, and long runs stay cheap
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Words that name what follows or tell what a number is.
_KEYS = "password passwd pwd passwort contraseña token secret apikey api_key access_key auth bearer"
_KEY_WORDS = frozenset(_KEYS.split())
_PERSON_WORDS = frozenset(
    "phone tel telephone mobile cell fax call ssn passport account iban telefon anruf konto "
    "téléphone compte teléfono cuenta móvil id dob born contact".split()
)
_PLAIN_WORDS = frozenset(
    "version page chapter section isbn issn figure table line total price order step part volume "
    "seite kapitel página capítulo chapitre vol no nr".split()
)
_TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sr|Sra"
_GIVEN = (
    "Anna|Maria|John|James|Robert|Michael|William|David|Richard|Thomas|Mary|Patricia|Jennifer|Linda|"
    "Elizabeth|Susan|Sarah|Karen|Peter|Hans|Klaus|Jürgen|Wolfgang|Ursula|Monika|Pierre|Jean|Marie|"
    "François|Nathalie|Isabelle|José|Juan|Carlos|Carmen|Francisco|Antonio|Laura|Paul|George|Alice"
)
_ASSIGNED = re.compile(rf"\b({'|'.join(_KEYS.split())})\s*[=:]\s*[\"']?([^\s\"',;]{{6,}})[\"']?", re.I)
_LONG = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/_-])")
_NUMBER = re.compile(r"(?<![\w.+-])\(?[0-9](?:[\x20()/-]{0,2}[0-9]){6,18}(?![\w-])")
_NAME = re.compile(
    rf"\b(?:(?:{_TITLES})\.? [A-ZÀ-Ý][a-zß-ÿ]{{2,}}|(?:{_GIVEN}) [A-ZÀ-Ý][a-zß-ÿ]{{2,}})"
    r"(?: [A-ZÀ-Ý][a-zß-ÿ]{2,})?\b"
)
_SECRET_FORMS = re.compile(
    r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abp]-[A-Za-z0-9-]{10,}"
    r"|sk-[A-Za-z0-9]{20,}|[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}"
)
_NUMBER_FORMS = re.compile(
    r"\(?[0-9]{3}\)?[ -][0-9]{3}-[0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}|0[0-9]{1,4}[ /-][0-9 -]{5,}"
)
#: A text without any of these has neither base spans nor candidates.
_ANY = rf"[0-9@]|(?i:{'|'.join(_KEYS.split())})|\b(?:{_TITLES})\.? |\b(?:{_GIVEN}) "


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        if place % 2:
            digit = digit * 2 - 9 * (digit > 4)
        total += digit
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by start and kind."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            done = match.end()
            out.append(("email", start, done))
        at = text.find("@", max(done, at + 1))
    for match in _IP.finditer(text):
        if all(int(part[-4:]) <= 255 and len(part.lstrip("0")) <= 3 for part in match[0].split(".")):
            out.append(("ip", match.start(), match.end()))
    for match in _CARD.finditer(text):
        digits = match[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", match.start(), match.end()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, match[0])) <= 15:
                out.append(("phone", match.start(), match.end()))
    return sorted(out, key=lambda span: (span[1], ORDER[span[0]], span[2]))


def _entropy(value: str) -> float:
    counts = Counter(value).values()
    return -sum(c / len(value) * math.log2(c / len(value)) for c in counts)


def _mixed(value: str) -> bool:
    return any(map(str.isdigit, value)) and any(map(str.isalpha, value))


LABELERS = 6


def votes_of(kind: str, value: str, before: list[str], after: str, keyed: bool) -> list[int]:
    """Votes (1 for, -1 against, 0 none) of pattern, gazetteer and context labelers."""
    words = [w.strip(".,;:!?()\"'=").lower() for w in before]
    digits = sum(map(str.isdigit, value))
    near = set(words[-4:])
    if kind == "secret":
        return [
            1 if _SECRET_FORMS.fullmatch(value) else 0,
            1 if keyed else 0,
            1 if near & _KEY_WORDS else 0,
            1 if _entropy(value) >= 3.0 and _mixed(value) else -1,
            -1 if value.isalpha() or value.islower() and digits == 0 else 0,
            -1 if value.count("-") + value.count("/") + value.count("_") > 3 else 0,
        ]
    if kind == "number":
        return [
            1 if _NUMBER_FORMS.fullmatch(value) else 0,
            1 if near & _PERSON_WORDS else 0,
            -1 if near & _PLAIN_WORDS else 0,
            -1 if value.isdigit() else 1,
            1 if 9 <= digits <= 11 else -1,
            -1 if len(set(filter(str.isdigit, value))) <= 2 else 0,
        ]
    first = value.split()[0].rstrip(".")
    return [
        1 if re.fullmatch(_TITLES, first) else 0,
        1 if re.search(rf"\b(?:{_GIVEN})\b", value) else 0,
        1 if near & {"name", "named", "by", "author", "contact", "dear", "signed", "von", "par", "por"} else 0,
        -1 if before and before[-1][-1:] in ".!?" else 0,
        1 if len(value.split()) > 2 else 0,
        -1 if after.split(" ", 1)[0][:1].isupper() else 0,
    ]


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[dict]:
    """Candidate spans that overlap neither base spans nor each other."""
    found: list[tuple[int, int, str, bool]] = []
    for match in _ASSIGNED.finditer(text):
        found.append((match.start(2), match.end(2), "secret", True))
    for match in _LONG.finditer(text):
        if _mixed(match[0]):
            found.append((match.start(), match.end(), "secret", False))
    for match in _NUMBER.finditer(text):
        found.append((match.start(), match.end(), "number", False))
    for match in _NAME.finditer(text):
        found.append((match.start(), match.end(), "name", False))
    # disjoint spans in order, by their starts and their ends
    starts: list[int] = []
    ends: list[int] = []
    for start, end in sorted((start, end) for _, start, end in base):
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    out = []
    for start, end, kind, keyed in sorted(set(found), key=lambda f: (not f[3], f[0] - f[1], f[0], f[2])):
        place = bisect_left(starts, end)
        if place and ends[place - 1] > start:
            continue
        starts.insert(place, start)
        ends.insert(place, end)
        value = text[start:end]
        votes = votes_of(kind, value, text[max(0, start - 60) : start].split(), text[end + 1 : end + 30], keyed)
        shape = [min(len(value) // 8, 4), int(_entropy(value) >= 3.0), int(value.isdigit())]
        out.append({"kind": kind, "start": start, "end": end, "votes": votes, "shape": shape})
    return out


_FOUND = (
    "doc_id bigint, base array<struct<kind:string,start:bigint,end:bigint>>, "
    "found array<struct<kind:string,start:bigint,end:bigint,votes:array<int>,shape:array<int>>>"
)
_SPAN = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]
_BASE_TYPE = pa.list_(pa.struct(_SPAN))
_FOUND_TYPE = pa.list_(
    pa.struct([*_SPAN, ("votes", pa.list_(pa.int32())), ("shape", pa.list_(pa.int32()))])
)


def _search(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        texts = pc.fill_null(batch.column(1), "")
        some = pc.match_substring_regex(texts, _ANY).to_pylist()
        bases: list[list] = [[] for _ in some]
        found: list[list] = [[] for _ in some]
        for row, hit in enumerate(some):
            if hit:
                text = texts[row].as_py()
                spans = base_spans(text)
                bases[row] = [{"kind": k, "start": a, "end": b} for k, a, b in spans]
                found[row] = candidates(text, spans)
        yield batch_of(
            {
                "doc_id": (batch.column(0), None),
                "base": (bases, _BASE_TYPE),
                "found": (found, _FOUND_TYPE),
            }
        )


def aggregate_votes(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Probability of each vote pattern being positive, by expectation maximisation.

    A labeler that votes is right with a reliability of its own; one that abstains says nothing.
    Reliabilities start at 0.8 with the weight of ten votes and stay better than chance, which
    keeps the classes from changing places.
    """
    reliability = np.full(votes.shape[1], 0.8)
    share, posterior = 0.5, np.full(len(votes), 0.5)
    for _ in range(rounds):
        weight = np.log(reliability / (1 - reliability))
        new = 1 / (1 + np.exp(-np.clip(votes @ weight + math.log(share / (1 - share)), -50, 50)))
        if np.abs(new - posterior).max() < 1e-9:
            break
        posterior = new
        right = (votes == 1) * posterior[:, None] + (votes == -1) * (1 - posterior[:, None])
        given = (votes != 0) * counts[:, None]
        reliability = (8 + (right * counts[:, None]).sum(axis=0)) / (10 + given.sum(axis=0))
        reliability = np.clip(reliability, 0.55, 0.99)
        share = float(np.clip((posterior @ counts + 1) / (counts.sum() + 2), 0.02, 0.98))
    return posterior


def _vector(kind: str, votes: list[int], shape: list[int]) -> np.ndarray:
    out = np.zeros(len(ADDED) * (1 + LABELERS) + 7)
    at = ADDED.index(kind) * (1 + LABELERS)
    out[at] = 1
    out[at + 1 : at + 1 + LABELERS] = votes
    tail = len(ADDED) * (1 + LABELERS)
    out[tail + shape[0]] = 1
    out[tail + 5 : tail + 7] = shape[1:]
    return out


def train(found: DataFrame) -> list[float]:
    """Weights of the span classifier, from the votes of all candidates."""
    spans = found.select(F.explode("found").alias("x")).select("x.kind", "x.votes", "x.shape")
    rows = spans.groupBy("kind", "votes", "shape").count().collect()  # votes by shapes, bounded
    if not rows:
        return []
    counts = np.array([r["count"] for r in rows], dtype=float)
    target = np.zeros(len(rows))
    for kind in ADDED:
        mine = np.array([i for i, r in enumerate(rows) if r["kind"] == kind], dtype=int)
        if len(mine):
            target[mine] = aggregate_votes(np.array([rows[i]["votes"] for i in mine]), counts[mine])
    x = np.array([_vector(r["kind"], r["votes"], r["shape"]) for r in rows])
    w = np.zeros(x.shape[1])
    scale = counts / counts.sum()
    for _ in range(100):  # Newton's method, soft targets
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (scale * (p - target)) + 1e-4 * w
        curve = (x * (scale * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w.tolist()


_RESULT = (
    "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
    "base_sha256 string, spans string, n_added bigint"
)


def _decide(batches: Iterator[pa.RecordBatch], weights: list[float], least: float):
    w = np.array(weights)
    names = [part.split()[0] for part in _RESULT.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.int64()]
    for batch in batches:
        rows = []
        for doc_id, base, found in zip(*(column.to_pylist() for column in batch.columns)):
            base = [(s["kind"], s["start"], s["end"]) for s in base or []]
            added = []
            for span in found or []:
                z = float(_vector(span["kind"], span["votes"], span["shape"]) @ w)
                if z >= math.log(least / (1 - least)):
                    added.append((span["kind"], span["start"], span["end"]))
            n = Counter(kind for kind, _, _ in base)
            digest = hashlib.sha256(joined(base).encode()).hexdigest()
            every = sorted(base + added, key=lambda s: (s[1], ORDER[s[0]], s[2]))
            rows.append((doc_id, *(n[k] for k in BASE), digest, joined(every), len(added)))
        if rows:
            yield batch_of({n: (list(v), k) for n, v, k in zip(names, zip(*rows), kinds)})


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find_spans(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, counts and digest of the base spans, all spans and the number of added ones."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    found = stage(in_batches(rows, _search, _FOUND), "pii")
    return in_batches(found, partial(_decide, weights=train(found), least=least), _RESULT)


def _redact(batches: Iterator[pa.RecordBatch], weights: list[float], least: float):
    w, edge = np.array(weights), math.log(least / (1 - least))
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts = batch.column(at)
        some = pc.match_substring_regex(pc.fill_null(texts, ""), _ANY).to_pylist()
        out = texts.to_pylist()
        for row, hit in enumerate(some):
            if hit:
                base = base_spans(out[row])
                added = [
                    (s["kind"], s["start"], s["end"])
                    for s in candidates(out[row], base)
                    if float(_vector(s["kind"], s["votes"], s["shape"]) @ w) >= edge
                ]
                out[row] = masked(out[row], base + added)
        columns = list(batch.columns)
        columns[at] = pa.array(out, pa.string())
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with spans, overlapping ones merged, replaced by ``<KIND>`` of the first."""
    out, at = [], 0
    merged: list[list] = []
    for kind, start, end in sorted(spans, key=lambda s: (s[1], ORDER[s[0]], s[2])):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([kind, start, end])
    for kind, start, end in merged:
        out += [text[at:start], f"<{kind.upper()}>"]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind; other columns stay."""
    rows = docs.select(F.lit(None).cast("bigint").alias("doc_id"), F.col("text").cast("string"))
    weights = train(stage(in_batches(rows, _search, _FOUND), "pii"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return in_batches(docs, partial(_redact, weights=weights, least=least), fields)
