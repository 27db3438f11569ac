"""Format-preserving pseudonyms for personal numbers, dates and addresses, natively.

A value that passes its validation is cut into symbols, each with a radix of its own,
and run through a Feistel network: symbols at odd and even places are the two halves,
and each round adds to the one half a keyed hash of the other, modulo each radix. Numbers
that are valid within bounds count by their rank among the valid ones. That
is a permutation of all values of the same format, so equal values get equal
pseudonyms in all documents, different ones different, and the key's holder can undo it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
# A Gregorian cycle of 400 years has 146,097 = 189 * 773 days. Valid social security
# numbers have areas 001 to 899 but for 666, groups from 01 and serials from 0001.
AREAS, NO_AREA, GROUPS, SERIALS = 898, 666, 99, 9999
CYCLE_START, CYCLE_END, CYCLE = "1800-01-01", "2200-01-01", (189, 773)

# What each kind looks like in a text. Order decides where two could start at one place.
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IP = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
ISO_DATE = r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])"
OTHER_DATE = r"(?<![0-9./])[0-9]{2}(?:\.[0-9]{2}\.|/[0-9]{2}/)[0-9]{4}(?![0-9/]|\.[0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
CARD = r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])"
OTHERS = "|".join([EMAIL, IP, ISO_DATE, OTHER_DATE, SSN, PHONE])
# Groups of digits up to where another kind begins; cards are sought among them.
GROUP = f"(?!{OTHERS})[0-9]++(?![A-Za-z])"
RUN = f"(?<![0-9A-Za-z])(?=[0-9](?:[ -]?[0-9]){{12}}){GROUP}(?:[ -]{GROUP})*+"
ANY = f"{OTHERS}|{RUN}"
# Card numbers are written like this, or in one group.
USUAL = [[4, 4, 4, 4], [4, 6, 5], [4, 6, 4]]


@dataclass(frozen=True)
class Pseudonyms:
    """``key``: the secret that fixes all permutations."""

    key: str


def feistel(values: Column, radices: Column, key: Column, back: bool = False) -> Column:
    """A keyed permutation of ``values``, each below its radix; ``back`` undoes it."""

    def turn(now: Column, r: Column) -> Column:
        other = F.filter(now, lambda v, i: i % 2 != r % 2)
        message = F.concat_ws("|", key, r.cast("string"), F.array_join(F.transform(other, lambda v: v.cast("string")), ","))

        def one(v: Column, i: Column) -> Column:
            digest = F.sha2(F.concat_ws("|", message, i.cast("string")).cast("binary"), 256)
            drawn = F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")
            return F.when(i % 2 == r % 2, F.pmod(v - drawn if back else v + drawn, F.get(radices, i))).otherwise(v)

        return F.transform(now, one)

    rounds = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    return F.aggregate(F.array(*[F.lit(r) for r in rounds]), values, turn)


def shuffled(value: Column, radix: Column, key: Column, back: bool = False) -> Column:
    """A keyed permutation of a single symbol, whose network would have an empty half: all its values by keyed hash."""

    def keyed(i: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", key, F.lit("single"), radix.cast("string"), i.cast("string")).cast("binary"), 256)
        return F.struct(digest.alias("h"), i.alias("i"))

    order = F.transform(F.array_sort(F.transform(F.sequence(F.lit(0).cast("long"), radix - 1), keyed)), lambda s: s["i"])
    return F.array_position(order, value) - 1 if back else F.get(order, value.cast("int"))


def _symbols(text: Column) -> Column:
    """Characters of a text with the class that a pseudonym keeps: value, radix, first of the class."""

    def one(c: Column) -> Column:
        code = F.ascii(c)

        def kind(first: str, radix: int) -> Column:
            at = F.lit(ord(first))
            return F.struct((code - at).cast("long").alias("v"), F.lit(radix).cast("long").alias("radix"), at.alias("base"))

        return (
            F.when(c.between("0", "9"), kind("0", 10))
            .when(c.between("a", "z"), kind("a", 26))
            .when(c.between("A", "Z"), kind("A", 26))
            .otherwise(F.struct(F.lit(0).cast("long").alias("v"), F.lit(1).cast("long").alias("radix"), code.alias("base")))
        )

    return F.transform(F.filter(F.split(text, ""), lambda c: c != ""), one)


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a digit string with its check digit."""
    values = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c: c.cast("int"))

    def add(total: Column, x: Column) -> Column:
        twice = x["v"] * 2
        return total + F.when(x["i"] % 2 == 0, x["v"]).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(values, lambda v, i: F.struct(v.alias("v"), i.alias("i"))), F.lit(0), add)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _kind(hit: Column) -> Column:
    """The kind of a hit that passes its check, else "none"."""
    numbers = _digits(hit)
    octets = F.transform(F.split(hit, r"\."), lambda o: (o.cast("int") <= 255) & (o.cast("int").cast("string") == o))
    day = _day(hit)
    in_cycle = (day >= F.lit(CYCLE_START).cast("date")) & (day < F.lit(CYCLE_END).cast("date"))
    return (
        F.when(hit.contains("@"), "email")
        .when(hit.rlike(f"^{IP}$") & F.forall(octets, lambda good: good), "ip")
        .when(hit.rlike(f"^{ISO_DATE}$") & in_cycle, "date")
        .when(hit.rlike(f"^{OTHER_DATE}$") & in_cycle, "day")
        .when(hit.rlike(f"^{SSN}$") & ~hit.rlike("^(000|666|9)|-00-|-0000$"), "ssn")
        .when(hit.rlike(f"^{CARD}$") & (luhn_sum(numbers) % 10 == 0), "card")
        .when(hit.rlike(f"^{PHONE}$"), "phone")
        .otherwise("none")
    )


def _day(hit: Column) -> Column:
    """The day that an ISO date or one with the day first names; null for anything else."""
    turned = F.concat_ws("-", F.substring(hit, 7, 4), F.substring(hit, 4, 2), F.substring(hit, 1, 2))
    return F.coalesce(F.try_to_date(hit, "yyyy-MM-dd"), F.try_to_date(turned, "yyyy-MM-dd"))


def _parsed(x: Column) -> Column:
    """Of a hit and its kind: what stays before and after, and the symbols to permute."""
    hit, kind = x["hit"], x["kind"]
    code = F.regexp_extract(hit, r"^(?:\+[0-9]{1,3}(?=[ .(-])[ .-]?)?", 0)
    days = F.datediff(_day(hit), F.lit(CYCLE_START).cast("date")).cast("long")
    body = (
        F.when(kind == "email", F.substring_index(hit, "@", 1))
        .when(kind == "phone", F.substring(hit, F.length(code) + 1, F.length(hit)))
        .when(kind == "card", F.substring(hit, F.lit(1), F.length(hit) - 1))
        .otherwise("")
    )

    def plain(v: Column, radix: int) -> Column:
        return F.struct(v.cast("long").alias("v"), F.lit(radix).cast("long").alias("radix"), F.lit(0).alias("base"))

    area = F.substring(hit, 1, 3).cast("int")
    ranks = F.array(
        plain(area - 1 - (area > NO_AREA).cast("int"), AREAS),
        plain(F.substring(hit, 5, 2).cast("int") - 1, GROUPS),
        plain(F.substring(hit, 8, 4).cast("int") - 1, SERIALS),
    )
    symbols = (
        F.when(kind == "ssn", ranks)
        .when(kind == "ip", F.transform(F.split(hit, r"\."), lambda o: plain(o, 256)))
        .when(kind.isin("date", "day"), F.array(plain(F.floor(days / CYCLE[1]), CYCLE[0]), plain(F.pmod(days, F.lit(CYCLE[1])), CYCLE[1])))
        .otherwise(_symbols(body))
    )
    return F.struct(hit.alias("hit"), kind.alias("kind"), code.alias("code"), symbols.alias("symbols"))


def _moved(p: Pseudonyms, back: bool):
    def one(x: Column) -> Column:
        free = F.filter(x["symbols"], lambda s: s["radix"] > 1)
        values, radices = F.transform(free, lambda s: s["v"]), F.transform(free, lambda s: s["radix"])
        key = F.concat_ws("|", F.lit(p.key), x["kind"])
        alone = F.array(shuffled(F.get(values, F.lit(0)), F.get(radices, F.lit(0)), key, back))
        moved = F.when(F.size(free) == 1, alone).otherwise(feistel(values, radices, key, back))
        return F.struct(x["hit"].alias("hit"), x["kind"].alias("kind"), x["code"].alias("code"), x["symbols"].alias("symbols"), moved.alias("moved"))

    return one


def _written(x: Column) -> Column:
    """The pseudonym as text."""
    symbols, moved = x["symbols"], x["moved"]

    def character(s: Column, i: Column) -> Column:
        before = F.size(F.filter(F.slice(symbols, F.lit(1), i), lambda b: b["radix"] > 1))
        return F.char(s["base"] + F.when(s["radix"] == 1, 0).otherwise(F.get(moved, before)).cast("int"))

    text = F.array_join(F.transform(symbols, character), "")
    day = F.date_add(F.lit(CYCLE_START).cast("date"), (F.get(moved, F.lit(0)) * CYCLE[1] + F.get(moved, F.lit(1))).cast("int"))
    mark = F.substring(x["hit"], 3, 1)
    rank = F.get(moved, F.lit(0))
    area = rank + 1 + (rank + 1 >= NO_AREA).cast("int")
    parts = [(area, 3), (F.get(moved, F.lit(1)) + 1, 2), (F.get(moved, F.lit(2)) + 1, 4)]
    return F.struct(
        x["hit"].alias("hit"), x["kind"].alias("kind"), x["code"].alias("code"), text.alias("text"),
        F.when(x["kind"] == "ip", F.array_join(F.transform(moved, lambda v: v.cast("string")), "."))
        .when(x["kind"] == "ssn", F.concat_ws("-", *[F.lpad(v.cast("string"), n, "0") for v, n in parts]))
        .when(x["kind"] == "date", F.date_format(day, "yyyy-MM-dd"))
        .when(x["kind"] == "day", F.concat(F.date_format(day, "dd"), mark, F.date_format(day, "MM"), mark, F.date_format(day, "yyyy")))
        .alias("whole"),
    )


def _final(x: Column) -> Column:
    check = F.pmod(-luhn_sum(F.concat(_digits(x["text"]), F.lit("0"))), F.lit(10))
    return (
        F.when(x["kind"] == "none", x["hit"])
        .when(x["kind"] == "email", F.concat(x["text"], F.lit("@"), F.substring_index(x["hit"], "@", -1)))
        .when(x["kind"] == "phone", F.concat(x["code"], x["text"]))
        .when(x["kind"] == "card", F.concat(x["text"], check.cast("string")))
        .otherwise(x["whole"])
    )


def _tokens(hit: Column) -> Column:
    """A hit and, where it is a run of digits, its groups, each with the separator before it."""
    run = hit.rlike("^[0-9](?:[ -]?[0-9]){12,}$")
    groups = F.when(run, F.split(hit, "(?=[ -])")).otherwise(F.array().cast("array<string>"))
    return F.struct(hit.alias("hit"), groups.alias("tokens"), F.transform(groups, lambda t: F.length(_digits(t))).alias("sizes"))


def _part(tokens: Column, start: Column, end: Column) -> Column:
    """Tokens start .. end - 1 as text."""
    empty = F.array().cast("array<string>")
    return F.array_join(F.when(end > start, F.transform(F.sequence(start, end - 1), lambda i: F.get(tokens, i))).otherwise(empty), "")


def _usual_ends(x: Column) -> Column:
    """For each group the end of the usually written, valid card that starts there, else 0."""
    tokens, sizes = x["tokens"], x["sizes"]

    def end(size: Column, i: Column) -> Column:
        groups = F.when(size.between(13, 19), 1)
        for shape in USUAL:
            same = size == shape[0]
            for k, n in enumerate(shape[1:], 1):
                same = same & F.coalesce(F.get(sizes, i + k) == n, F.lit(False))
            groups = groups.when(same, len(shape))
        groups = groups.otherwise(0)
        return F.when((groups > 0) & (luhn_sum(_digits(_part(tokens, i, i + groups))) % 10 == 0), i + groups).otherwise(0)

    return F.struct(x["hit"].alias("hit"), tokens.alias("tokens"), sizes.alias("sizes"), F.transform(sizes, end).alias("usual"))


def _ends(x: Column) -> Column:
    """For each group the end of the card that starts there, else 0: a usual one, else the longest without a usual one inside."""
    tokens, sizes, usual = x["tokens"], x["sizes"], x["usual"]

    def end(own: Column, i: Column) -> Column:
        # a card has 19 digits at most
        ahead = F.sequence(i + 1, F.least(i + 19, F.size(sizes)))

        def valid(e: Column) -> Column:
            digits = F.aggregate(F.sequence(i, e - 1), F.lit(0), lambda n, k: n + F.get(sizes, k))
            free = F.forall(F.sequence(i, e - 1), lambda k: F.get(usual, k) == 0)
            return F.when(digits.between(13, 19) & free, luhn_sum(_digits(_part(tokens, i, e))) % 10 == 0).otherwise(False)

        return F.when(own > 0, own).otherwise(F.coalesce(F.array_max(F.filter(ahead, valid)), F.lit(0)))

    return F.struct(x["hit"].alias("hit"), tokens.alias("tokens"), F.transform(usual, end).alias("ends"))


def _picks(x: Column) -> Column:
    """The cards of a run from left to right: first group and end."""
    starts = F.transform(x["ends"], lambda e, i: F.struct(i.alias("start"), e.alias("end")))
    none = F.array().cast("array<struct<start:int,end:int>>")

    def pick(state: Column, s: Column) -> Column:
        new = F.struct(s["end"].alias("free"), F.concat(state["picks"], F.array(s)).alias("picks"))
        return F.when((s["end"] > 0) & (s["start"] >= state["free"]), new).otherwise(state)

    picked = F.aggregate(starts, F.struct(F.lit(0).alias("free"), none.alias("picks")), pick, lambda state: state["picks"])
    return F.struct(x["hit"].alias("hit"), x["tokens"].alias("tokens"), picked.alias("picks"))


def _pieces(x: Column) -> Column:
    """A hit's text in pieces, each card of a run one of them."""
    tokens, picks = x["tokens"], x["picks"]

    def cut(pick: Column, k: Column) -> Column:
        before = F.when(k > 0, F.get(picks, k - 1)["end"]).otherwise(0)
        first = F.get(tokens, pick["start"])
        mark = F.regexp_extract(first, "^[ -]?", 0)
        card = F.substring(_part(tokens, pick["start"], pick["end"]), F.length(mark) + 1, F.lit(100))
        return F.array(F.concat(_part(tokens, before, pick["start"]), mark), card)

    rest = F.array(_part(tokens, F.get(picks, F.size(picks) - 1)["end"], F.size(tokens)))
    return F.when(F.size(picks) > 0, F.concat(F.flatten(F.transform(picks, cut)), rest)).otherwise(F.array(x["hit"]))


def pseudonyms(docs: DataFrame, p: Pseudonyms, back: bool = False, kinds: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms in ``text``; rows, nulls and all other columns stay.

    Valid values are e-mail addresses (the part before the @), IPv4 addresses, card
    numbers with a right check digit, phone numbers (all but the country code), social
    security numbers, and dates from 1800 to 2199, ISO or with the day first; what fails
    its check stays. In a longer run of digits, cards are the valid ones among its groups,
    those written as usual first and then the longest. A null or empty text stays as it is. Equal values get equal
    pseudonyms wherever they stand; ``back`` restores the originals, except where new
    digits happen to make other groups of a run a valid card, as with four more digits
    before one or with cards that are not written as usual. ``kinds`` names a column for
    the kinds of the values found, in their order.
    """
    text = F.col("text").cast("string")
    row = docs.select(F.struct(*docs.columns).alias("pii_row"), text.alias("text"))
    none = F.array().cast("array<string>")
    found = row.withColumn("hits", F.when(F.col("text").rlike(ANY), F.regexp_extract_all("text", F.lit(ANY), F.lit(0))))
    step = found
    for change in (_tokens, _usual_ends, _ends, _picks, _pieces):
        step = step.withColumn("hits", F.transform("hits", change))
    gaps = F.zip_with(F.split("text", ANY, -1), "hits", lambda g, h: F.concat(F.array(g), F.array_repeat(F.lit(""), F.coalesce(F.size(h), F.lit(1)) - 1)))
    step = step.withColumn("gaps", F.when(F.size("hits") > 0, F.flatten(gaps))).withColumn("hits", F.flatten("hits"))
    step = step.withColumn("hits", F.transform("hits", lambda h: F.struct(h.alias("hit"), _kind(h).alias("kind"))))
    step = step.withColumn("named", F.filter(F.transform("hits", lambda x: x["kind"]), lambda k: k != "none"))
    for change in (_parsed, _moved(p, back), _written, _final):
        step = step.withColumn("hits", F.transform("hits", change))
    whole = F.array_join(F.zip_with("gaps", F.concat("hits", F.array(F.lit(""))), lambda g, m: F.concat(g, m)), "")
    done = step.withColumn("text", F.when(F.size("hits") > 0, whole).otherwise(F.col("text")))
    columns = [(F.col("text") if c == "text" else F.col("pii_row")[c]).alias(c) for c in docs.columns]
    return done.select(*columns, *([F.coalesce("named", none).alias(kinds)] if kinds else []))
