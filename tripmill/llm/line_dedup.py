"""Removes passages of lines that repeat anywhere in the corpus, natively.

A rolling hash over the hashes of neighbouring lines chooses boundaries, so equal passages
are cut at equal lines wherever they stand. Chunks from boundary to boundary are counted
over the whole corpus. A chunk that occurs once cannot lie in a repeated passage, and only
what is around repeated chunks, or too short to hold one, is looked at further: the
shortest runs of lines with enough words, from each line on and up to each line, which
cover every passage that is long enough exactly. Runs with equal hashes point to the
first of them; those of a document that overlap or touch and continue each other in one
first occurrence form a passage, and passages that are byte for byte those of the first
occurrence are removed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BREAK = "\n"
KEY = ["dedup_id", "dedup_text"]
WORD = r"[^\\x20\\x09-\\x0D]+"


@dataclass(frozen=True)
class LineDedup:
    """``least_words``: the shortest passage removed.

    A line ends a chunk if the hash of it and the lines before it, ``rolling`` in all, is
    divisible by ``divisor``: these change the work, not the result.
    """

    least_words: int = 50
    rolling: int = 2
    divisor: int = 2


def _keyed(docs: DataFrame) -> DataFrame:
    """The key of a document is its id and its text's hash; a null id counts as the lowest."""
    return docs.withColumns(
        {
            "dedup_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))),
            "dedup_text": F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))),
        }
    )


def _cut(array: str, first: str, last: str, kind: str) -> str:
    """Elements first .. last - 1; slice() would copy the whole array each time."""
    return f"if({last} > {first}, transform(sequence({first}, {last} - 1), i -> {array}[i]), cast(array() as array<{kind}>))"


def _lines(docs: DataFrame, p: LineDedup) -> DataFrame:
    """Per document the hashes of its lines, and the lines that end a chunk."""
    lines = docs.filter("text is not null and text <> ''").select(*KEY, F.split("text", BREAK, -1).alias("lines"))
    hashed = lines.select(*KEY, "lines", F.expr("transform(lines, l -> xxhash64(l))").alias("h"))
    rolled = ", ".join(f"h[i - {k}]" for k in range(p.rolling))
    ends = f"""if(size(h) < {p.rolling}, cast(array() as array<int>), filter(sequence({p.rolling - 1}, size(h) - 1),
        i -> pmod(xxhash64({rolled}), {p.divisor}) = 0))"""
    return hashed.withColumn("ends", F.expr(ends))


def _chunk(k: str, p: LineDedup) -> tuple[str, str]:
    """First and last line of the chunk after end ``k``, with the lines that chose its boundaries."""
    return f"(ends[{k}] - {p.rolling - 1})", f"ends[{k} + 1]"


def repeated_chunks(docs: DataFrame, p: LineDedup) -> DataFrame:
    """(repeated): hashes of the chunks that occur more than once; partial counts meet, not chunks."""
    first, last = _chunk("k", p)
    hashes = f"""if(size(ends) < 2, cast(array() as array<bigint>),
        transform(sequence(0, size(ends) - 2), k -> xxhash64({_cut("h", first, f"{last} + 1", "bigint")})))"""
    chunks = _lines(docs, p).select(F.explode(F.expr(hashes)).alias("repeated"))
    return chunks.groupBy("repeated").agg(F.count("*").alias("times")).filter("times > 1").select("repeated")


def _windows(docs: DataFrame, p: LineDedup) -> DataFrame:
    """One row a window: key, start, end (its last line), hash, and the chunk it holds, if any."""
    # the line of each word, and for each line the next end after it
    spread = f"flatten(transform(lines, (l, i) -> array_repeat(i, regexp_count(l, '{WORD}'))))"
    following = "flatten(transform(ends, (e, k) -> array_repeat(k, e - if(k = 0, 0, ends[k - 1]))))"
    hashed = _lines(docs, p).select(*KEY, "h", "ends", F.expr(spread).alias("w"), F.expr(following).alias("next"))
    last = p.least_words - 1
    # so many words in a row that begin or end with a line; both ends in a long
    spans = hashed.select(
        *KEY, "h", "ends", "next",
        F.expr(
            f"""if(size(w) > {last}, array_distinct(transform(
                filter(sequence(0, size(w) - 1 - {last}), j -> j = 0 or w[j] <> w[j - 1]
                    or j + {last} = size(w) - 1 or w[j + {last}] <> w[j + {last} + 1]),
                j -> w[j] * 4294967296L + w[j + {last}])), cast(array() as array<bigint>))"""
        ).alias("spans"),
    )
    # the first chunk whose boundaries are chosen at or after a window's start
    from_line = f"s.a + {p.rolling - 2}"
    number = f"if({from_line} < 0, 0, get(next, {from_line}))"
    first, end = _chunk("s.k", p)
    held = f"if(get(ends, s.k + 1) <= s.b, xxhash64({_cut('h', first, f'{end} + 1', 'bigint')}), null)"
    window = f"""transform(transform(transform(spans,
        s -> struct(cast(shiftright(s, 32) as int) as a, cast(s & 4294967295L as int) as b)),
        s -> struct(s.a as a, s.b as b, {number} as k)),
        s -> struct(s.a as start, s.b as end, xxhash64({_cut("h", "s.a", "s.b + 1", "bigint")}) as window, {held} as chunk))"""
    return spans.select(*KEY, F.inline(F.expr(window)))


def matches(docs: DataFrame, p: LineDedup) -> DataFrame:
    """(key, start, size, first key, first start): passages that occur earlier, by hash."""
    # windows without a chunk meet no chunk, and are spread by their own hash
    windows = _windows(docs, p).withColumn("meets", F.coalesce("chunk", "window"))
    near = windows.join(repeated_chunks(docs, p), F.col("meets") == F.col("repeated"), "left")
    near = near.filter("chunk is null or repeated is not null").select(*KEY, "start", "end", "window")
    place = F.struct(*KEY, "start", "end")
    first = near.groupBy(F.col("window").alias("same")).agg(F.count("*").alias("times"), F.min(place).alias("at"))
    later = near.join(first.filter("times > 1"), F.col("window") == F.col("same")).filter(place != F.col("at"))
    # of windows in their order both ends grow, so a run ends where the next begins further on
    runs = (
        later.groupBy(
            *KEY, F.col("at.dedup_id").alias("first_id"), F.col("at.dedup_text").alias("first_text"),
            (F.col("start") - F.col("at.start")).alias("shift"),
        )
        .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("found"))
        .withColumn("heads", F.expr("filter(found, (f, k) -> k = 0 or f.start > found[k - 1].end + 1)"))
        .withColumn("tails", F.expr("filter(found, (f, k) -> k = size(found) - 1 or found[k + 1].start > f.end + 1)"))
        .select(
            *KEY, "first_id", "first_text", "shift",
            F.inline(F.expr("transform(heads, (f, k) -> struct(f.start as start, tails[k].end - f.start + 1 as size))")),
        )
    )
    return runs.select(*KEY, "start", "size", "first_id", "first_text", (F.col("start") - F.col("shift")).alias("first_start"))


def dedup_lines(docs: DataFrame, p: LineDedup = LineDedup(), count: str | None = None) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text``.

    Of a passage's occurrences the first stays: the one with the least id, then text
    hash, then line. Rows that agree in id and text are one document and are treated
    alike; a row without id counts as the least id. A null or empty text stays as it
    is; a document may become empty but never goes, and becomes empty where only blank
    lines are left. Passages may also repeat within a document. A column ``n_chars``,
    where there is one, follows the text; all other columns, whatever their names, stay.
    ``count`` names a column for the number of lines taken out.
    """
    others = [c for c in docs.columns if c != "text"]
    packed = docs.select(
        F.struct(*[F.col(c) for c in others]).alias("dedup_row"), "doc_id", F.col("text").cast("string").alias("text")
    )
    keyed = _keyed(packed)
    found = matches(keyed.select(*KEY, "text"), p)
    source = keyed.select(F.col("dedup_id").alias("first_id"), F.col("dedup_text").alias("first_text"), "text")
    # repeated rows give a passage several times: the array holds it several times, which changes nothing
    shown = (
        found.join(source, ["first_id", "first_text"])
        .withColumn("first_lines", F.split("text", BREAK, -1))
        .select(*KEY, "start", "size", F.expr(f"array_join({_cut('first_lines', 'first_start', 'first_start + size', 'string')}, '\\n')").alias("passage"))
    )
    by_doc = shown.groupBy(*KEY).agg(F.collect_list(F.struct("start", "size", "passage")).alias("found"))
    step = keyed.join(by_doc, KEY, "left")
    step = step.withColumn("lines", F.when(F.col("found").isNotNull(), F.split("text", BREAK, -1)))
    # each passage has enough words in one first occurrence; only lines that are its, byte for byte
    own = _cut("lines", "f.start", "f.start + f.size", "string")
    step = step.withColumn("found", F.expr(f"filter(found, f -> array_join({own}, '\\n') = f.passage)"))
    spots = "array_sort(array_distinct(flatten(transform(found, f -> sequence(f.start, f.start + f.size - 1)))))"
    step = step.withColumn("gone", F.coalesce(F.expr(spots), F.expr("cast(array() as array<int>)")))
    left = "array_except(sequence(0, size(lines) - 1), gone)"
    # blank lines that nothing is left between go too
    blank = f"size(gone) > 0 and not exists({left}, i -> lines[i] rlike '{WORD}')"
    step = step.withColumn("gone", F.expr(f"if({blank}, sequence(0, size(lines) - 1), gone)"))
    text = f"if(size(gone) > 0, array_join(transform({left}, i -> lines[i]), '\\n'), text)"
    done = step.withColumn("text", F.expr(text)).withColumn("removed", F.greatest(F.size("gone"), F.lit(0)))
    columns = []
    for name in docs.columns:
        kept = F.col("text") if name == "text" else F.col("dedup_row")[name]
        if name == "n_chars":
            kept = F.when(F.col("removed") > 0, F.length("text")).otherwise(kept).cast(docs.schema[name].dataType)
        columns.append(kept.alias(name))
    return done.select(*columns, *([F.col("removed").alias(count)] if count else []))
