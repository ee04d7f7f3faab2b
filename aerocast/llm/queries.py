"""Registered queries of the corpus operators: each applies its operator
with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aerocast.llm import common as c
from aerocast.llm import sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op1_ngram_jaccard_join": sql.JACCARD,
    "op2_substring_dedup": sql.SUBSTRING,
    "op4_exact_top_k": sql.TOP_K,
    "op10_nearest_neighbours": sql.NEAREST,
    "op11_source_divergence": sql.DIVERGENCE,
    "op12_quality_rules": sql.perplexity(),
    "op13_vector_codes": sql.BALL,
}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_ngram_jaccard_join(spark, sf_dir):
    """Components of documents whose 4-word shingle sets have a Jaccard
    similarity of 0.85 or more."""
    from aerocast.llm.ngram_jaccard import jaccard_components
    return jaccard_components(c.read(spark, sf_dir, "documents"))


@query
def op8_toxicity(spark, sf_dir):
    """Toxicity score of every text by the string-kernel SVM."""
    from pyspark.sql import functions as F

    from aerocast.llm import toxicity
    from aerocast.llm.labelled import remainder
    docs = c.read(spark, sf_dir, "documents")
    model = toxicity.train(docs, c.read(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"),
        F.col("toxicity_score").alias("score"), (F.col("toxicity_score") >= 0.5).cast("int").alias("predicted"))


@query
def op5_packing(spark, sf_dir):
    """All documents packed into sequences of at most 1024 ids."""
    import public_tokenizers

    from aerocast.llm.packing import pack
    return pack(c.read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_pii(spark, sf_dir):
    """Personal data in every whole text."""
    from aerocast.llm.pii import find
    docs = c.read(spark, sf_dir, "documents").select("doc_id", "text")
    return find(docs).selectExpr("doc_id", "pii_email n_email", "pii_ip n_ip", "pii_card n_card", "pii_phone n_phone",
                                 "pii_base_sha256 base_sha256", "pii_spans spans")


@query
def op3_line_dedup(spark, sf_dir):
    """Near-duplicate lines removed from all documents but the first."""
    from pyspark.sql import functions as F

    from aerocast.llm.lines import dedupe_lines
    out = dedupe_lines(c.read(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.coalesce("text", F.lit(""))
    return out.select("doc_id", F.col("lines").alias("n_lines"), F.col("lines_removed").alias("n_removed"), F.sha2(kept, 256).alias("kept_sha256"))


@query
def op2_substring_dedup(spark, sf_dir):
    """Words of all documents without repeated passages of 20 words."""
    from pyspark.sql import functions as F

    from aerocast.llm.substring import dedupe_substrings
    return dedupe_substrings(c.read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op9_quality(spark, sf_dir):
    """Quality score of every text by compression."""
    from pyspark.sql import functions as F

    from aerocast.llm import quality
    from aerocast.llm.labelled import remainder
    docs = c.read(spark, sf_dir, "documents")
    model = quality.train(docs, c.read(spark, sf_dir, "labels"))
    return quality.score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"),
        F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.7).cast("int").alias("predicted"))


@query
def op10_nearest_neighbours(spark, sf_dir):
    """Five nearest rows by cosine of every 50th embedding."""
    from aerocast.llm.ann import nearest
    e = c.read(spark, sf_dir, "embeddings")
    return nearest(e, e.where("vec_id % 50 = 0"))


@query
def op4_exact_top_k(spark, sf_dir):
    """Five largest integer inner products of every 50th embedding."""
    from aerocast.llm.mtree import top_k
    e = c.read(spark, sf_dir, "embeddings")
    return top_k(e, e.where("vec_id % 50 = 0"))


@query
def op7_sentencepiece(spark, sf_dir):
    """Ids of every whole text by the transducer, and the way back."""
    import public_tokenizers

    from aerocast.llm.wfst import digests
    return digests(c.read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op11_source_divergence(spark, sf_dir):
    """How the sources of each language differ in words."""
    from aerocast.llm.divergence import audit
    return audit(c.read(spark, sf_dir, "documents"))


@query
def op12_quality_rules(spark, sf_dir):
    """Base rules and perplexity bands over every whole text."""
    from aerocast.llm.perplexity import rules
    return rules(c.read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op13_vector_codes(spark, sf_dir):
    """Codes of all embeddings by ball k-means over four parts."""
    from pyspark.sql import functions as F

    from aerocast.llm import ball_kmeans
    coded, books = ball_kmeans.compress(c.read(spark, sf_dir, "embeddings"), keep=("label",))
    labels = coded.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    return coded.join(labels, F.col("label").eqNullSafe(F.col("same"))).select(
        "vec_id", ball_kmeans.hex_code().alias("code"), "error", "label_error", F.lit(ball_kmeans.digest(books)).alias("codebooks_sha256"))
