"""A training corpus from documents: filter, deduplicate, redact, mix and pack.

Each stage takes (spark, docs, sf_dir) and gets what its predecessor wrote; all but the last
return the columns of documents.

Defined results: null texts are scored, compared, placed and packed as empty ones and stay null
until then. A null id counts as an id of its own, after all others. Repeated rows and equal texts are one
near-duplicate class, of which the smallest id stays, so null and empty texts leave one document.
A null source is the source with an empty name. Texts are taken whole, however long. Other columns
are left out, whatever their names. Without documents every stage gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm import mixing, ngram_join, packing, pii, toxicity
from aerolake.llm.common import table
from aerolake.plans.tables import stage, staging

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject. It learns from the given documents."""
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    model = toxicity.fit(table(spark, sf_dir, "documents", "doc_id", "text"), labels)
    return toxicity.with_score(docs.select(COLUMNS), model, "_score").filter("_score < 0.5").select(COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the smallest id."""
    near = stage(ngram_join.near_duplicates(docs), "pipeline-near")
    keyed = docs.select(COLUMNS).withColumn("_text_id", ngram_join.text_id())
    light = keyed.select("doc_id", F.col("_text_id").alias("text_id"))
    grouped = light.join(near, "text_id", "left").select(
        "doc_id", "text_id", F.coalesce("component", "text_id").alias("component")
    )
    # a null id comes last
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_id")
    first = grouped.groupBy("component").agg(F.min(key).alias("first"))
    kept = first.select(F.col("first.doc_id").alias("_id"), F.col("first.text_id").alias("_text_id"))
    same = ["_text_id"]
    chosen = keyed.join(kept, same).filter(F.col("doc_id").eqNullSafe(F.col("_id")))
    # repeated rows of the chosen id and text
    return chosen.dropDuplicates(["_text_id"]).select(COLUMNS)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind, and their new length."""
    clean = pii.redact(docs.select(COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("bigint")).select(COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the mixture: files, and rows in files, follow the schedule."""
    numbered = stage(
        docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), "pipeline-numbered"
    )
    light = numbered.select(
        "row",
        F.coalesce("source", F.lit("")).alias("source"),
        F.greatest(F.length(F.coalesce("text", F.lit(""))), F.lit(1)).cast("bigint").alias("size"),
    )
    placed = mixing.place(light, None, mixing.BLOCK, mixing.PERIOD, 0.5).select("row", "slot", "place")
    ordered = numbered.join(placed, "row").repartitionByRange("slot", "place", "row")
    return ordered.sortWithinPartitions("slot", "place", "row").select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 ids with the pieces of documents they hold.

    Their ids follow the order of the mixture, by ranges of ``packing.RANGE`` pieces.
    """
    import public_tokenizers

    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return packing.sequences(docs, vocabulary, end=2, size=4096, ordered=True)


STAGES = [
    ("toxicity", toxic_out),
    ("near_duplicates", one_of_each),
    ("pii", redacted),
    ("mixing", mixed),
    ("packing", packed),
]

#: The stages fit models and tokenize, which SQL cannot express.
ORACLE_SQL = None


def _written(spark: SparkSession, sf_dir: str, count: int) -> DataFrame:
    """What the first ``count`` stages keep. Whatever a stage read or staged goes once it is written."""
    if not count:
        return table(spark, sf_dir, "documents")
    name, function = STAGES[count - 1]
    with staging(spark):
        docs = _written(spark, sf_dir, count - 1)
        return stage(function(spark, docs, sf_dir), f"pipeline-{name}", kept=True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written before the next reads it."""
    return STAGES[-1][1](spark, _written(spark, sf_dir, len(STAGES) - 1), sf_dir)
