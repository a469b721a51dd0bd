"""Small frames with every awkward case, shared by the tests."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, row string"


def words(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward_docs() -> list[tuple]:
    """Nulls, empty and very long texts, repeats, and columns that clash with results."""
    rng = random.Random(5)
    long = words(rng, 30_000)
    texts = [None, "", "  \n\t ", "one", "one two three four", words(rng, 60), long, words(rng, 200)]
    rows = [(i, t, "en", "a" if i % 3 else None, None, 0.5, "x") for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, "no id here", None, None, None, None, None)]
    rows += [(90, rows[5][1], "fr", "b", 1, None, None), (91, "x" * 100_000, None, "b", 1, None, None)]
    return rows
