"""Cleaning and packing of a corpus: five stages, each an operator of
aerocast.llm, each over all rows its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from aerocast.llm import common as c
from aerocast.llm import lines, ngram_jaccard, packing, pii, toxicity

#: Near copies: five-word shingles, similarity 0.8.
SHINGLE, SIMILAR, OF = 5, 80, 100


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject; it is fitted
    on the labelled rows of the corpus' own tables."""
    model = toxicity.train(c.read(spark, sf_dir, "documents"), c.read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("toxicity_score < 0.5").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of which a near copy occurs earlier; a
    document that loses all its words goes."""
    out = lines.dedupe_lines(docs)
    out = out.where((F.col("lines_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return out.withColumn("n_chars", F.when(F.col("lines_removed") > 0, F.length("text").cast("long"))
                          .otherwise(F.col("n_chars"))).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near
    copies; of rows that repeat id and text one."""
    return ngram_jaccard.drop_near_copies(docs, SHINGLE, SIMILAR, OF)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    out = pii.find(docs, redacted=True)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 1024 ids."""
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_copies),
    ("PII", hide_personal_data),
    ("packing", pack),
]

#: The classifier, SimHash links and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared
    folder and read again."""
    c.prepare(spark)
    docs = c.read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = c.stored(docs, f"pipeline-{i}")
    return docs
