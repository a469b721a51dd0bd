"""Queries of the training-data operators over the given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm import (
    alignment,
    chat,
    collocations,
    html_text,
    licenses,
    mixing,
    ngram_join,
    packing,
    pii,
    quality,
    topk,
    toxicity,
    warc,
)
from aerolake.llm.common import table


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best other vectors of every vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5, scale=256.0)


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and risk-controlled verdict of every document."""
    judged = quality.judge(
        table(spark, sf_dir, "documents", "doc_id", "text", "lang"),
        table(spark, sf_dir, "labels", "doc_id", "quality"),
    )
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in the mixture of sources."""
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "source", "size", "block", "slot", "place")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every document."""
    return ngram_join.join(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 ids."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack_documents(docs, _vocabulary("word_bpe_49k.json"), end=2, size=4096)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return licenses.scan(docs).select("doc_id", "license", "containment")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.find_spans(table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat windows of all conversations and of conversation -1, read back."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    windows = chat.format_chats(rows.unionByName(extra), _vocabulary("byte_bpe_50k.tiktoken"))
    return chat.read_back(windows)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; the held-out fifth of the labels is not learned from."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    model = toxicity.fit(docs, labels.filter(~toxicity.held_out()))
    return toxicity.with_score(docs, model).select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of every page, written to bundles and read back."""
    return warc.archive(table(spark, sf_dir, "pages", "page_id", "url", "html"), least=0)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of every language."""
    found = collocations.collocations(table(spark, sf_dir, "documents", "lang", "text"), 30, 2000)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two tokenizers cut every document, and how common its links are."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return alignment.align(docs, _vocabulary("byte_bpe_50k.json"), _vocabulary("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_topk": op1_exact_topk,
    "op2_html_text": op2_html_text,
    "op3_quality_rules": op3_quality_rules,
    "op4_source_mixing": op4_source_mixing,
    "op5_ngram_join": op5_ngram_join,
    "op6_packing": op6_packing,
    "op7_license_scan": op7_license_scan,
    "op8_pii": op8_pii,
    "op9_chat_windows": op9_chat_windows,
    "op10_toxicity": op10_toxicity,
    "op11_warc": op11_warc,
    "op12_collocations": op12_collocations,
    "op13_alignment": op13_alignment,
    "pipeline": corpus_pipeline.run,
}

SQL: dict[str, str] = {}

SQL["op1_exact_topk"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS cells
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_inner_product(q.cells, c.cells) AS BIGINT) AS score
    FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place
    FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""

SQL["op5_ngram_join"] = """
WITH RECURSIVE texts AS (
    SELECT coalesce(text, '') AS text, min(doc_id) AS copy_id FROM documents GROUP BY 1
), worded AS (
    SELECT copy_id, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'),
                                lambda w: w <> '') AS words
    FROM texts
), shingles AS (
    SELECT DISTINCT copy_id, unnest(
        CASE WHEN len(words) >= 5
             THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
             WHEN len(words) > 0 THEN [array_to_string(words, ' ')]
             ELSE CAST([] AS VARCHAR[]) END) AS shingle
    FROM worded
), sizes AS (
    SELECT copy_id, count(*) AS n FROM shingles GROUP BY 1
), shared AS (
    SELECT a.copy_id AS one, b.copy_id AS two, count(*) AS n
    FROM shingles AS a JOIN shingles AS b ON a.shingle = b.shingle AND a.copy_id <> b.copy_id
    GROUP BY 1, 2
), links AS (
    SELECT one, two FROM shared
    JOIN sizes AS s ON s.copy_id = one JOIN sizes AS t ON t.copy_id = two
    WHERE 10 * shared.n >= 8 * (s.n + t.n - shared.n)
), reach(one, two) AS (
    SELECT copy_id, copy_id FROM texts
    UNION
    SELECT reach.one, links.two FROM reach JOIN links ON links.one = reach.two
), classes AS (
    SELECT one AS copy_id, min(two) AS class_id FROM reach GROUP BY 1
), degrees AS (
    SELECT one AS copy_id, count(*) AS n FROM links GROUP BY 1
)
SELECT d.doc_id, t.copy_id, c.class_id, CAST(coalesce(g.n, 0) AS BIGINT) AS n_links
FROM documents AS d JOIN texts AS t ON t.text = coalesce(d.text, '')
JOIN classes AS c ON c.copy_id = t.copy_id LEFT JOIN degrees AS g ON g.copy_id = t.copy_id
"""


def _license_sql() -> str:
    rows = ", ".join(
        f"('{name}', {number}, '{' '.join(licenses.template_words(text))}')"
        for name, texts in licenses.TEMPLATES.items()
        for number, text in enumerate(texts)
    )
    shingles = """
        SELECT DISTINCT {key}, unnest(
            CASE WHEN len(words) >= 5
                 THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
                 WHEN len(words) > 0 THEN [array_to_string(words, ' ')]
                 ELSE CAST([] AS VARCHAR[]) END) AS shingle
        FROM {source}"""
    return f"""
WITH templates(license, template, text) AS (VALUES {rows}
), t AS (
    SELECT license, template, string_split(text, ' ') AS words FROM templates
), ts AS ({shingles.format(key="license, template", source="t")}
), d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'),
                               lambda w: w <> '') AS words
    FROM documents
), ds AS ({shingles.format(key="doc_id", source="d")}
), sizes AS (
    SELECT license, template, count(*) AS n FROM ts GROUP BY 1, 2
), met AS (
    SELECT ds.doc_id, ts.license, ts.template, count(*) AS n
    FROM ts JOIN ds ON ds.shingle = ts.shingle GROUP BY 1, 2, 3
)
SELECT doc_id, license, max(met.n / sizes.n) AS containment
FROM met JOIN sizes USING (license, template) WHERE met.n >= 0.8 * sizes.n GROUP BY 1, 2
"""


SQL["op7_license_scan"] = _license_sql()

SQL["op11_warc"] = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload, row_number() OVER () AS place FROM pages
), hashed AS (
    SELECT page_id, payload, place, strlen(payload) AS payload_bytes, sha1(payload) AS hex,
           first_value(place) OVER w AS first_place, first_value(page_id) OVER w AS first_id
    FROM payloads WINDOW w AS (PARTITION BY payload ORDER BY page_id DESC NULLS LAST, place DESC
                               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
           ((CAST('0x' || substr(hex, 10 * (i // 8) + 1, 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31) + 1 AS INTEGER),
           1)), '') AS payload_digest,
       CASE WHEN place = first_place THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place <> first_place THEN first_id END AS refers_to
FROM hashed
"""

SQL["op12_collocations"] = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS words
    FROM pieces
), grams AS (
    SELECT lang, words[i:i + size - 1] AS phrase, count(*) AS f
    FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i
          FROM worded, (VALUES (1), (2), (3), (4)) AS sizes(size) WHERE len(words) >= size)
    GROUP BY 1, 2 HAVING count(*) >= 30
), totals AS (
    SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM worded GROUP BY 1
), cuts AS (
    SELECT lang, phrase, f AS a, unnest(range(1, len(phrase))) AS k FROM grams WHERE len(phrase) > 1
), scores AS (
    SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
           CAST(CAST(2000000 AS HUGEINT) * c.a // (x.f + y.f) AS BIGINT) AS score
    FROM cuts AS c JOIN grams AS x ON x.lang = c.lang AND x.phrase = c.phrase[1:c.k]
    JOIN grams AS y ON y.lang = c.lang AND y.phrase = c.phrase[c.k + 1:]
), lowest AS (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scores
), inner_phrases AS (
    SELECT lang, phrase[i:i + size - 1] AS phrase, max(f) AS longest
    FROM grams, (VALUES (2, 1), (2, 2), (2, 3), (3, 1), (3, 2)) AS parts(size, i)
    WHERE len(phrase) > size AND i + size - 1 <= len(phrase) GROUP BY 1, 2
), kept AS (
    SELECT l.* FROM lowest AS l LEFT JOIN inner_phrases AS i ON i.lang = l.lang AND i.phrase = l.phrase
    WHERE l.place = 1 AND (i.longest IS NULL OR 100 * i.longest < 80 * l.a)
), ranked AS (
    SELECT lang, array_to_string(phrase, ' ') AS phrase, a, l, r, score,
           row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(phrase, ' ')) AS rank
    FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
