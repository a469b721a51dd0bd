"""A small corpus on disk for the pipeline test."""

import random

from helpers import words


def toxic_corpus(spark, folder):
    rng = random.Random(13)
    rows, labels = [], []
    for i in range(600):
        said = words(rng, 80, 9999).split()
        if i % 6 == 0:
            for _ in range(4):
                said.insert(rng.randrange(80), rng.choice(["vileword", "badterm"]))
        rows.append((i, " ".join(said), "en", f"s{i % 3}", 0))
        labels.append((i, 1, int(i % 6 == 0)))
    twin = "mail jo@ex.org " + words(rng, 90, 9999)
    rows += [(901, twin, "en", "s1", 0), (902, twin + " end", "en", "s2", 0), (903, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    docs.write.parquet(f"{folder}/documents.parquet")
    known.write.parquet(f"{folder}/labels.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet"), known, folder
