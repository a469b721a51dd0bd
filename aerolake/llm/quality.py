"""Quality rules with risk-controlled cutoffs, in DataFrame operations only.

Measures of every whole text are compared with cutoffs. A ladder of cutoffs, each step stricter,
is taken from the quantiles of good documents in one half of the labels. The other half is the
holdout: a step is certified for a stratum if an exact binomial test shows that it rejects less
than ``risk`` of the good documents there. Steps are tested from the loosest on and testing stops
at the first failure (fixed sequence, so no correction is needed along the ladder); the level of
error is divided by the number of strata (Bonferroni), so that all strata hold together. Of the
certified steps the loosest one counts that finds nearly as many bad documents as the strictest.
A stratum without a certified step rejects nothing beyond the base rules.

Defined results: a null text has no words; a null stratum is a stratum of its own; repeated rows
are judged each; labels repeated for a document count once, bad if any says so. Other columns are
ignored. Empty tables give an empty result, no labels certify nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.common import WORD_GAP
from aerolake.plans.tables import stage

#: Measures that reject a document when they are above a cutoff.
RULES = ("symbol_share", "dup_line_share", "repeat_share", "upper_share", "bang_share", "word_length")
#: Shares of good documents above the cutoff at each step of the ladder, loosest first.
LADDER = (0.0, 0.0005, 0.001, 0.002, 0.004, 0.008, 0.012, 0.016, 0.02)
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def _repeat_words(windows: Column) -> Column:
    """Words inside windows, given the sorted start places of those found twice or more."""
    steps = F.transform(
        windows, lambda at, i: F.least(F.lit(3), F.coalesce(F.get(windows, i + 1) - at, F.lit(3)))
    )
    return F.coalesce(F.aggregate(steps, F.lit(0), lambda a, b: a + b), F.lit(0))


def measures(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, stratum, the counts of the base rules and the measures of ``RULES``.

    Three-word windows are compared by 64-bit hashes inside one text: sorted with their places,
    equal neighbours are repeats, so a text of n words takes n log n steps.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    split = docs.select(
        "doc_id",
        F.col(stratum).cast("string").alias("stratum"),
        F.array_remove(F.split(text, WORD_GAP), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.regexp_count(text, F.lit("!")).alias("n_bangs"),
        F.regexp_count(text, F.lit("\\p{Lu}")).alias("n_upper"),
    )
    hashed = split.select(
        "doc_id", "stratum", "n_symbols", "n_bangs", "n_upper",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform(
            F.slice("words", 1, F.greatest(F.size("words") - 2, F.lit(0))),
            lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)),
        ).alias("hashes"),
    )
    light = [c for c in hashed.columns if c != "hashes"]
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    placed = hashed.select(
        *light,
        F.when(
            repeats,
            F.sort_array(
                F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("at")))
            ),
        ).alias("placed"),
    )
    again = placed.select(
        *light,
        F.sort_array(
            F.transform(
                F.filter(
                    "placed",
                    lambda x, i: x["h"].eqNullSafe(F.get("placed", i - 1)["h"])
                    | x["h"].eqNullSafe(F.get("placed", i + 1)["h"]),
                ),
                lambda x: x["at"],
            )
        ).alias("again"),
    )
    counted = again.select(
        *light, _repeat_words(F.col("again")).cast("bigint").alias("n_repeat_words")
    )
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    return counted.select(
        "doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words",
        (
            (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
        ).alias("base_failed"),
        share("n_symbols", "n_words").alias("symbol_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("n_upper", "word_chars").alias("upper_share"),
        share("n_bangs", "n_words").alias("bang_share"),
        share("word_chars", "n_words").alias("word_length"),
    )


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Bin(n, p), summed exactly in logarithms."""
    odds = p / (1 - p)
    first = n * F.log(F.lit(1 - p))

    def step(state: Column, i: Column) -> Column:
        term = state["term"] + F.log((n - i + 1) / i * odds)
        top = F.greatest(state["total"], term)
        total = top + F.log(F.exp(state["total"] - top) + F.exp(term - top))
        return F.struct(term.alias("term"), total.alias("total"))

    # from 1 to k; for k = 0 there is nothing to add
    places = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k.cast("bigint"))).otherwise(
        F.array().cast("array<bigint>")
    )
    start = F.struct(first.alias("term"), first.alias("total"))
    return F.aggregate(places, start, step, lambda s: F.least(F.exp(s["total"]), F.lit(1.0)))


def cutoffs(
    measured: DataFrame, labels: DataFrame, risk: float = 0.02, error: float = 0.05
) -> DataFrame:
    """stratum and one cutoff for each rule, for strata with a certified step.

    Both halves of the labels are aggregated over all labelled documents; what is left is one
    row for each stratum and step.
    """
    truth = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = (
        measured.filter(~F.col("base_failed"))
        .join(truth.filter(F.col("quality").isin(0, 1)), "doc_id")
        .withColumn("held_out", F.crc32(F.col("doc_id").cast("string")) % 2 == 1)
    )
    points = F.array(*[F.lit(1 - x) for x in LADDER])
    # one row of len(LADDER) numbers for each rule
    fitted = known.filter(~F.col("held_out") & (F.col("quality") == 1)).agg(
        *[F.percentile(rule, points).alias(rule) for rule in RULES]
    ).first()
    if fitted[RULES[0]] is None:  # no good document to take quantiles of
        steps = []
    else:
        steps = [(i, *[fitted[rule][i] for rule in RULES]) for i in range(len(LADDER))]
    names = ["step", *[f"cut_{rule}" for rule in RULES]]
    kinds = "step int, " + ", ".join(f"cut_{rule} double" for rule in RULES)

    def rejects(step: tuple) -> Column:
        found = F.lit(False)
        for rule, cut in zip(RULES, step[1:]):
            found = found | (F.col(rule) > cut)
        return F.struct(F.lit(step[0]).alias("step"), found.alias("rejected"))

    tried = known.filter("held_out").select(
        "stratum",
        "quality",
        F.explode(F.array(*map(rejects, steps)).cast("array<struct<step:int,rejected:boolean>>")).alias("x"),
    )
    good, gone = F.col("quality") == 1, F.col("x.rejected")
    tries = tried.groupBy("stratum", F.col("x.step").alias("step")).agg(
        F.count_if(good).alias("n"),
        F.count_if(good & gone).alias("k"),
        F.count_if(~good & gone).alias("found"),
    )
    tries = stage(tries, "quality-ladder")
    n_strata = max(tries.select("stratum").distinct().count(), 1)
    tested = tries.withColumn(
        "sound", binomial_tail(F.col("k"), F.col("n"), risk) * n_strata <= error
    )
    along = Window.partitionBy("stratum").orderBy("step")
    certified = tested.withColumn("certified", F.min("sound").over(along)).filter("certified")
    best = F.max("found").over(Window.partitionBy("stratum"))
    chosen = (
        certified.withColumn("best", best)
        .filter(F.col("found") >= 0.98 * F.col("best"))
        .groupBy("stratum")
        .agg(F.min("step").alias("step"))
    )
    ladder = measured.sparkSession.createDataFrame(steps, kinds)
    return chosen.join(ladder, "step").select("stratum", *names)


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **options) -> DataFrame:
    """Every document with its counts, ``base_failed``, the step of its stratum and ``kept``."""
    measured = stage(measures(docs, stratum), "quality")
    limits = cutoffs(measured, labels, **options).withColumnRenamed("stratum", "_stratum")
    rejected = F.lit(False)
    for rule in RULES:
        rejected = rejected | F.coalesce(F.col(rule) > F.col(f"cut_{rule}"), F.lit(False))
    joined = measured.join(limits, F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    return joined.select(
        "doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "step",
        (~F.col("base_failed") & ~rejected).alias("kept"),
        *RULES,
    )
