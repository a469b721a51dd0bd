"""Ids of whole texts by a public tokenizer, with repeated words looked up once.

The tokenizer never joins what white space parts, so a text's ids are those of its chunks in
order. Chunks of a batch are dictionary-encoded, and each worker keeps the ids of recent chunks.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CACHE_ENTRIES = 250_000  # for each of two generations
# Lower-case Latin letters: one composed code point each, so a chunk of them is one pre-token.
_PLAIN = re.compile("[a-zß-öø-ÿ]+")
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
SLICE_BYTES = 6_000_000


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself, or the next free code point from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class ChunkIds:
    """Ids of white-space-free chunks as bytes of unsigned 32-bit integers."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        # The short way below holds for tokenizers that lower the case of words with ends.
        self.lowers = "Lowercase" in str(described.get("normalizer")) and bool(
            described["model"].get("end_of_word_suffix")
        )
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.letters = _byte_letters()

    def _encode(self, chunk: str) -> bytes:
        ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def of(self, chunk: str) -> bytes:
        if not chunk:
            return b""
        found = self.new.get(chunk)
        if found is not None:
            return found
        found = self.old.get(chunk)
        if found is None:
            found = self._find(chunk)
        if len(self.new) >= _CACHE_ENTRIES:
            self.old, self.new = self.new, {}
        self.new[chunk] = found
        return found

    def _find(self, chunk: str) -> bytes:
        if not self.lowers:
            return self._encode(chunk)
        if _PLAIN.fullmatch(chunk):
            word = chunk if chunk.isascii() else "".join(self.letters[b] for b in chunk.encode())
            return np.array([t.id for t in self.tokenizer.model.tokenize(word)], "<u4").tobytes()
        if chunk[-1] in ".," and len(chunk) > 1 and _LETTERS.fullmatch(chunk, 0, len(chunk) - 1):
            return self.of(chunk[:-1]) + self.of(chunk[-1])
        if _LETTERS.fullmatch(chunk):
            return self.of(chunk.lower())
        return self._encode(chunk)


@lru_cache(maxsize=2)
def chunk_ids(path: str) -> ChunkIds:
    return ChunkIds(path)


def slices(texts: pa.Array) -> list[tuple[int, int]]:
    """(start, length) of runs of rows with about SLICE_BYTES of text."""
    if not len(texts):
        return []
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    out, start = [], 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, base + SLICE_BYTES, "right")), start + 1)
        out.append((start, stop - start))
        start = stop
    return out


def _flat(texts: pa.Array, ids: ChunkIds) -> tuple[np.ndarray, np.ndarray]:
    """All ids of some texts, and the number of ids of each text."""
    lists = pc.ascii_split_whitespace(texts)
    flat = pc.list_flatten(lists)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    coded = flat.dictionary_encode()
    places = coded.indices.to_numpy(zero_copy_only=False)
    chunks = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    found = [x or ids.of(chunk) for x, chunk in zip(map(ids.new.get, chunks), chunks)]
    lengths = np.fromiter(map(len, found), np.int32, len(found)) // 4
    pool = np.frombuffer(b"".join(found), "<u4")
    starts = np.cumsum(lengths, dtype=np.int32) - lengths
    own = lengths[places]
    ends = np.cumsum(own, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(starts[places] - (ends - own).astype(np.int32), own)
    at += np.arange(total, dtype=np.int32)
    out = pool[at]
    bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(sizes)))]
    return out, np.diff(bounds)


def _long(text: str, ids: ChunkIds) -> np.ndarray:
    """Ids of one very long text, piece by piece between white space."""
    parts, start, step = [], 0, SLICE_BYTES // 4
    while start < len(text):
        stop = min(start + step, len(text))
        while stop < len(text) and text[stop] not in " \t\n\x0b\x0c\r":
            stop += 1
        parts.append(_flat(pa.array([text[start:stop]]), ids)[0])
        start = stop
    return np.concatenate(parts)


def ids_of_texts(texts: pa.Array, path: str):
    """Yield an array of ids for each text, null as an empty one."""
    ids = chunk_ids(path)
    texts = pc.fill_null(texts, "")
    for start, length in slices(texts):
        part = texts.slice(start, length)
        if length == 1 and pc.binary_length(part)[0].as_py() > SLICE_BYTES:
            yield _long(part[0].as_py(), ids)
            continue
        flat, sizes = _flat(part, ids)
        yield from np.split(flat, np.cumsum(sizes)[:-1])
