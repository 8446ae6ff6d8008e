"""Small tables with what real ones hold: nulls, empty and long texts, ties, copies and other columns."""

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use for themselves.
CLASHING = ("id", "rank", "shard", "length", "score", "size", "first", "last", "items", "values", "n", "key", "label", "word_runs")


def documents(spark: SparkSession, texts: list, langs: list | None = None) -> DataFrame:
    rows = [(i, t, langs[i] if langs else "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return frame(spark, rows)


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    out = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return out.selectExpr("*", *[f"'clash' AS `{c}`" for c in CLASHING])


def prose(rng: random.Random, words: int, vocabulary: int = 500) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def mixed_texts(seed: int = 1) -> list:
    rng = random.Random(seed)
    base = prose(rng, 120)
    near = [base.replace(f" w{i} ", " changed ") for i in range(0, 40, 4)]
    return [
        None, "", " \n\t", "a", "a b", "A B", base, base, base.upper(), *near,
        *[prose(rng, rng.randrange(1, 300)) for _ in range(20)], prose(rng, 9_000, 50_000),
        "é ü ß 日本 ́ İstanbul <|endoftext|> don't", "x" * 30_000, "ab" * 500, "ab" * 500,
    ]
