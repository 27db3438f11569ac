"""Secret scans over a ledger of content-addressed blobs, natively.

Every version of every text is a blob, named by its SHA-256. The ledger holds what
each version of each rule found in each blob. A scan looks only at pairs of blob and
rule version that the ledger lacks, once a blob however many paths hold it, and its
findings are joined back to all paths.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import saved

LEDGER = "blob string, rule string, spans array<struct<start: int, end: int>>"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and without overlap, whose ``group`` has ``least``
    characters or more. ``hint``, where given, is a string that every match holds.
    """

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    version: int = 1
    hint: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base kinds as the query's contract states them.
BASE = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=6,
        group=2,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20, hint="AKIA"),
    # a run of 24 or more is found whole either way, without a match for each letter of a word
    Rule("hex", r"[0-9a-f]{24,}", least=24),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", hint="PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+", hint=".eyJ"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", hint="gh"),
)
RULES = BASE + MORE


def _spans(text: Column, rule: Rule) -> Column:
    """Start and end of each match, in code points: the texts between matches give the places."""
    none = F.expr("cast(array() as array<struct<start: int, end: int>>)")
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    size = F.transform(hits, F.length)
    part = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), F.length) if rule.group else size
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    steps = F.arrays_zip(F.slice(gaps, 1, F.size(size)).alias("gap"), size.alias("size"), part.alias("part"))

    def add(done: Column, step: Column) -> Column:
        start = done["at"] + step["gap"]
        end = start + step["size"]
        span = F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"))
        more = F.when(step["part"] >= rule.least, F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
        return F.struct(end.cast("int").alias("at"), more.alias("spans"))

    walked = F.aggregate(steps, F.struct(F.lit(0).alias("at"), none.alias("spans")), add)["spans"]
    possible = text.rlike(rule.pattern) if rule.hint is None else F.contains(text, F.lit(rule.hint))
    return F.when(possible, walked).otherwise(none)


def blob_of(text: Column) -> Column:
    """The content address of a text; a null text is an empty one."""
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256)


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """New ledger rows (blob, rule, spans) for the texts of ``versions`` (doc_id, text).

    A row of ``ledger`` means that this rule version has seen this blob. Append the
    result to the ledger, and the next scan skips these pairs. Empty texts count as
    scanned as well. A path that names a blob repeatedly changes nothing.
    """
    texts = versions.select(
        F.xxhash64("doc_id").alias("path"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("blob", blob_of(F.col("text")))
    names = F.array(*[F.lit(r.name) for r in rules])
    # one path stands for a blob, so that texts are neither grouped nor sorted
    heads = texts.groupBy(F.col("blob").alias("new")).agg(F.min("path").alias("head")).withColumn("todo", names)
    if ledger is not None:
        seen = ledger.filter(F.col("rule").isin([r.name for r in rules])).groupBy(F.col("blob").alias("old"))
        heads = heads.join(seen.agg(F.collect_set("rule").alias("done")), F.col("new") == F.col("old"), "left")
        heads = heads.select("new", "head", F.array_except(names, F.coalesce("done", F.array().cast("array<string>"))).alias("todo"))
        heads = heads.filter(F.size("todo") > 0)
    unseen = texts.join(heads, F.expr("blob = new and path = head"))
    results = F.array(
        *[
            F.when(
                F.array_contains("todo", r.name), F.struct(F.lit(r.name).alias("rule"), _spans(F.col("text"), r).alias("spans"))
            )
            for r in rules
        ]
    )
    rows = unseen.select("blob", F.filter(results, lambda x: x.isNotNull()).alias("results")).dropDuplicates(["blob"])
    return rows.select("blob", F.inline("results")).select("blob", "rule", "spans")


def findings(versions: DataFrame, ledger: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(doc_id, blob, rule spans by kind) for every path, from a ledger that covers them.

    ``found`` maps each rule's kind to its spans. Each row of ``versions`` gives one row.
    """
    kinds = F.create_map(*[x for r in rules for x in (F.lit(r.name), F.lit(r.kind))])
    known = ledger.filter(F.col("rule").isin([r.name for r in rules])).filter(F.size("spans") > 0)
    pairs = F.collect_list(F.struct(kinds[F.col("rule")].alias("kind"), "spans"))
    found = known.dropDuplicates(["blob", "rule"]).groupBy(F.col("blob").alias("named")).agg(F.map_from_entries(pairs).alias("found"))
    paths = versions.select(F.col("doc_id").cast("long").alias("doc_id"), blob_of(F.col("text")).alias("blob"))
    return paths.join(found, F.col("blob") == F.col("named"), "left").select("doc_id", "blob", "found")


def report(found: DataFrame, rules: Sequence[Rule] = RULES, base: Sequence[Rule] = BASE) -> DataFrame:
    """Counts and digests of the findings of each path: the form of the registered query."""

    def named(rule: Rule, number: int):
        return lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(number).alias("n"),
            F.concat_ws(":", F.lit(rule.kind), s["start"].cast("string"), s["end"].cast("string")).alias("name"),
        )

    def joined(kinds: Sequence[Rule]) -> Column:
        none = F.expr("cast(array() as array<struct<start: int, end: int>>)")
        parts = [F.transform(F.coalesce(F.col("found")[r.kind], none), named(r, k)) for k, r in enumerate(kinds)]
        return F.array_join(F.transform(F.array_sort(F.concat(*parts)), lambda s: s["name"]), ",")

    counts = [F.greatest(F.size(F.col("found")[r.kind]), F.lit(0)).cast("long") for r in base]
    return found.select(
        "doc_id",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(f"n_{r.kind}") for c, r in zip(counts, base)],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(rules).alias("spans"),
    )


def secret_report(docs: DataFrame, ledger: DataFrame | None = None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Scans what the ledger lacks and reports every row of ``docs`` (doc_id, text).

    Null texts are empty and have no findings, a null id stays null, repeated rows get
    a row each, and no rows give no rows. Other columns are not read.
    """
    fresh = saved(scan(docs, ledger, rules))
    whole = fresh if ledger is None else ledger.select("blob", "rule", "spans").union(fresh)
    return report(findings(docs, whole, rules), rules)
