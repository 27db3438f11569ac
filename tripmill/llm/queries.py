"""The registered queries of the corpus operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import (
    decontaminate,
    language,
    line_dedup,
    lm_score,
    near_dup,
    packing,
    pii,
    pivots,
    resampling,
    secret_scan,
    template,
    toxicity,
    whitening,
)
from tripmill.llm.common import table

# The key of a production run comes from its secret store; this one makes results repeatable.
PSEUDONYM_KEY = "tripmill public demonstration key"


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), count="removed_lines")
    return docs.select("doc_id", "removed_lines", "text")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with all evidence, and documents with their source for a host."""
    docs = table(spark, sf_dir, "documents")
    names, logs = language.train(docs)
    pages = language.identify(language.evidence_from_pages(table(spark, sf_dir, "pages")), names, logs)
    texts = language.identify(language.evidence_from_documents(docs), names, logs, markup=False)
    both = pages.union(texts.select(*pages.columns))
    return both.select(
        F.expr("if(kind = 'pages', id, null)").alias("page_id"),
        F.expr("if(kind = 'documents', id, null)").alias("doc_id"),
        "lang", "confidence", "text_lang", "declared", "suffix", "host",
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_minhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles of four words, as this query's contract has it."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), near_dup.NearDuplicates(shingle=4))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op8_embedding_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    done = pii.pseudonyms(docs, pii.Pseudonyms(PSEUDONYM_KEY), kinds="kinds")
    return done.select("doc_id", F.array_join("kinds", ",").alias("kinds"), "text")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.findings(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    spans = F.transform("found.spans", lambda s: F.concat_ws(":", s["item_id"], s["start"], s["end"], s["edits"]))
    return found.select(
        "doc_id",
        (F.size("found.items") > 0).alias("contaminated"),
        F.array_join(F.transform("found.items", lambda x: x.cast("string")), ",").alias("items"),
        F.array_join(spans, ",").alias("spans"),
    )


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deviations as longs; one that a long cannot hold is null here."""
    done = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return done.withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template.main_text(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scores": op1_lm_scores,
    "op2_line_dedup": op2_line_dedup,
    "op3_language_id": op3_language_id,
    "op4_secret_scan": op4_secret_scan,
    "op5_toxicity": op5_toxicity,
    "op6_minhash_near_dups": op6_minhash_near_dups,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_embedding_near_dups": op8_embedding_near_dups,
    "op9_pii_pseudonyms": op9_pii_pseudonyms,
    "op10_decontamination": op10_decontamination,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_html_extraction": op13_html_extraction,
}
