"""Language identification by Bayesian fusion of evidence.

Four kinds of evidence add up in log space: the likelihood of the text under a model
of character trigrams for each language; the language that the markup declares; the
suffix of the address (a language path, else the last part of the host); and a prior
for the host. Reliability of declarations and suffixes is counted, not assumed: how
often each value meets each language as the text alone suggests it. Host priors are
smoothed along a hierarchy: all pages, the domain, the host, each level pulled towards
the one above. All of this is grouped aggregation over the whole tables.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import fold_of, saved

SCRIPTS = re.compile(r"(?is)<(script|style)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)")
TAGS = re.compile(r"(?s)<[^>]*>")


@dataclass(frozen=True)
class LanguageModel:
    """``bits``: trigram buckets; ``evidence``: how many independent trigrams a text is
    taken for at most, since its trigrams are not independent; ``strength``: weight of
    a level's prior in the one below. ``most_languages`` guards the size of what each
    task holds, 2^bits numbers a language: more declared languages raise an error.
    """

    bits: int = 14
    evidence: float = 40.0
    strength: float = 10.0
    folds: int = 5
    held_out: int = 1
    most_languages: int = 400


def plain(page: str) -> str:
    """The text of a page without scripts, comments, tags and entities."""
    return entities.unescape(TAGS.sub(" ", SCRIPTS.sub(" ", page)))


def trigrams(text: str, bits: int) -> np.ndarray:
    """How often each bucket of character trigrams occurs; digits and marks count as blanks."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = ((codes >= 97) & (codes <= 122)) | (codes >= 0xAA)
    codes = np.concatenate([[32], np.where(letters, codes, 32), [32]]).astype(np.uint64)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    codes = codes[keep]
    if len(codes) < 3:
        return np.zeros(1 << bits, np.int64)
    mixed = (codes[:-2] << np.uint64(42)) ^ (codes[1:-1] << np.uint64(21)) ^ codes[2:]
    mixed = (mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
    return np.bincount(mixed.astype(np.int64), minlength=1 << bits)


def _counter(languages: list[str], bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(languages), 1 << bits), np.int64)
        number = {name: k for k, name in enumerate(languages)}
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                total[number[lang]] += trigrams(text or "", bits)
        lang, bucket = np.nonzero(total)
        yield pd.DataFrame({"lang": lang.astype(np.int32), "bucket": bucket.astype(np.int32), "n": total[lang, bucket]})

    return run


def train(docs: DataFrame, m: LanguageModel = LanguageModel()) -> tuple[list[str], np.ndarray]:
    """Languages and their log trigram probabilities, from the training folds of ``docs``.

    A null or blank language or id, or a null text, trains nothing.
    """
    known = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.lower(F.trim(F.col("lang").cast("string"))).alias("lang"),
    ).filter("doc_id is not null and text is not null and lang <> ''")
    known = known.filter(fold_of(F.col("doc_id"), m.folds) != m.held_out)
    names = sorted(r[0] for r in known.select("lang").distinct().limit(m.most_languages + 1).collect())
    if len(names) > m.most_languages:
        raise ValueError(f"more than {m.most_languages} languages are declared")
    counts = np.zeros((len(names), 1 << m.bits))
    if names:
        parts = known.select("text", "lang").mapInPandas(_counter(names, m.bits), "lang int, bucket int, n long")
        # at most languages x buckets rows
        total = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
        counts[total["lang"], total["bucket"]] = total["n"]
    smooth = counts + 0.1
    return names, np.log(smooth / smooth.sum(axis=1, keepdims=True))


def _likelihood(logs: np.ndarray, m: LanguageModel, markup: bool):
    """Log likelihoods of a text, tempered; zeros for a text without letters."""
    table = logs.astype(np.float32)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for text in batch:
                counts = trigrams(plain(text or "") if markup else text or "", m.bits)
                n = counts.sum()
                where = np.flatnonzero(counts)
                value = table[:, where].astype(np.float64) @ counts[where]
                out.append(value * (min(n, m.evidence) / n) if n else np.zeros(len(table)))
            yield pd.Series(out)

    return F.pandas_udf(run, "array<double>")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def domain_of(host: Column) -> Column:
    """The last two parts of a host."""
    return F.substring_index(host, ".", -2)


def suffix_of(url: Column) -> Column:
    """A first path part of two letters, else the host's last part; empty without either."""
    path = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^:/?#]+://[^/?#]*/([A-Za-z]{2})(?:[/?#]|$)", 1))
    host = host_of(url)
    top = F.when(host.contains("."), F.concat(F.lit("."), F.substring_index(host, ".", -1))).otherwise("")
    return F.when(path != "", F.concat(F.lit("/"), path)).otherwise(top)


def declared_in(page: Column) -> Column:
    """The primary language tag that the html element declares; empty without one."""
    tag = F.regexp_extract(F.coalesce(page, F.lit("")), r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?\s*([A-Za-z]{2,3})""", 1)
    return F.lower(tag)


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda t, y: t + y))


def _sums(column: str, k: int) -> list[Column]:
    return [F.sum(F.get(F.col(column), F.lit(i))).alias(f"s{i}") for i in range(k)]


def evidence_from_documents(docs: DataFrame) -> DataFrame:
    """Documents as evidence rows: the source stands for the host, nothing is declared."""
    return docs.select(
        F.lit("documents").alias("kind"), F.col("doc_id").cast("long").alias("id"),
        F.col("text").cast("string").alias("text"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"),
        F.lit("").alias("domain"), F.lit("").alias("suffix"), F.lit("").alias("declared"),
    )


def evidence_from_pages(pages: DataFrame) -> DataFrame:
    url = F.col("url").cast("string")
    return pages.select(
        F.lit("pages").alias("kind"), F.col("page_id").cast("long").alias("id"), F.col("html").cast("string").alias("text"),
        host_of(url).alias("host"), domain_of(host_of(url)).alias("domain"), suffix_of(url).alias("suffix"),
        declared_in(F.col("html").cast("string")).alias("declared"),
    )


def identify(rows: DataFrame, names: list[str], logs: np.ndarray, m: LanguageModel = LanguageModel(), markup: bool = True) -> DataFrame:
    """(kind, id, lang, confidence, text_lang, declared, suffix, host) for each evidence row.

    Missing evidence (no letters, nothing declared, no address) says nothing either way:
    then the prior decides. Equal probabilities go to the language that sorts first.
    Null ids and repeated rows stay as they are. Without a language ``lang`` is null and
    the confidence 0.
    """
    shown = ["kind", "id", "declared", "suffix", "host"]
    if not names:
        none = F.lit(None).cast("string")
        return rows.select(*shown, none.alias("lang"), F.lit(0.0).alias("confidence"), none.alias("text_lang"))
    n = len(names)
    seen = saved(
        rows.withColumn("logs", _likelihood(logs, m, markup)("text")).drop("text").withColumn("soft", _softmax(F.col("logs")))
    )
    whole = seen.agg(*_sums("soft", n)).first()
    counted = np.array([x or 0.0 for x in whole]) + 1.0
    prior = counted / counted.sum()

    def level(key: list[str], above: Column) -> tuple[DataFrame, Column]:
        """Counts of a level, and its prior: pulled towards ``above`` by ``strength``."""
        sums = seen.groupBy(*[F.col(k).alias(f"by_{k}") for k in key]).agg(*_sums("soft", n), F.count("*").alias("many"))
        counts = sums.select(*[f"by_{k}" for k in key], F.array(*[f"s{i}" for i in range(n)]).alias("counts"), "many")
        return counts, F.zip_with(above, "counts", lambda a, c: (c + m.strength * a) / (F.col("many") + m.strength))

    top = F.array(*[F.lit(float(x)) for x in prior])
    domains, domain_prior = level(["domain"], top)
    hosts, host_prior = level(["domain", "host"], F.col("above"))
    domains = domains.select("by_domain", domain_prior.alias("above"))
    hosts = hosts.withColumnRenamed("by_domain", "in_domain").join(domains, F.expr("in_domain = by_domain"))
    hosts = hosts.select("in_domain", "by_host", host_prior.alias("prior"))

    def signal(name: str) -> DataFrame:
        """log P(value | language) of a declaration or suffix, smoothed by its overall share."""
        sums = seen.filter(F.col(name) != "").groupBy(F.col(name).alias(f"at_{name}")).agg(*_sums("soft", n), F.count("*").alias("many"))
        total = seen.filter(F.col(name) != "").agg(*_sums("soft", n), F.count("*").alias("many")).first()
        if not total["many"]:
            return sums.select(f"at_{name}", F.expr("cast(array() as array<double>)").alias(f"log_{name}"))
        logs_of = [
            F.log((F.col(f"s{i}") + m.strength * F.col("many") / total["many"]) / (total[f"s{i}"] + m.strength)) for i in range(n)
        ]
        return sums.select(f"at_{name}", F.array(*logs_of).alias(f"log_{name}"))

    zero = F.array(*[F.lit(0.0)] * n)
    fused = (
        seen.join(hosts, F.expr("domain = in_domain and host = by_host"))
        .join(signal("declared"), F.expr("declared = at_declared"), "left")
        .join(signal("suffix"), F.expr("suffix = at_suffix"), "left")
    )
    total = F.transform("prior", lambda x: F.log(x))
    for part in ("logs", "log_declared", "log_suffix"):
        total = F.zip_with(total, F.coalesce(F.col(part), zero), lambda a, b: a + b)
    chance = fused.withColumn("chance", _softmax(total))
    tags = F.array(*[F.lit(x) for x in names])
    best = F.array_max("chance")
    return chance.select(
        *shown,
        F.get(tags, (F.array_position("chance", best) - 1).cast("int")).alias("lang"),
        best.alias("confidence"),
        F.get(tags, (F.array_position("soft", F.array_max("soft")) - 1).cast("int")).alias("text_lang"),
    )
