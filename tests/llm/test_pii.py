import datetime as dt
import random
import re

from helpers import documents

from tripmill.llm.pii import ANY, Pseudonyms, feistel, pseudonyms
from pyspark.sql import functions as F


def luhn(digits):
    values = [int(c) for c in reversed(digits)]
    return sum(v if k % 2 == 0 else 2 * v - 9 * (v > 4) for k, v in enumerate(values)) % 10 == 0


def card(seed):
    body = "".join(random.Random(seed).choice("0123456789") for _ in range(15))
    return next(body + c for c in "0123456789" if luhn(body + c))


VALID = [
    card(1), card(2), f"{card(3)[:4]} {card(3)[4:8]} {card(3)[8:12]} {card(3)[12:]}", "152.143.123.131", "0.0.0.0", "2024-02-29",
    "1800-01-01", "2199-12-31", "31.12.1999", "01/02/2003", "+1 (980) 555-2833", "555-123-4567", "219-09-9999", "the.72@mail3.example.com",
    "A.b-9@x.org",
]
INVALID = [
    str(int(card(1)) + 1).zfill(16), "256.1.1.1", "1.2.3.4.5", "2023-02-29", "32.12.1999", "000-12-1234", "01.2.3.4", "12345",
    "version 1.2.3", "2024-13-01", "@home", "1799-12-31", f"a{card(1)}", f"{card(1)}f",
]
P = Pseudonyms("k1")


def change(spark, texts, p=P, **more):
    docs = documents(spark, list(enumerate(texts)), clash=True)
    return [r.text for r in sorted(pseudonyms(docs, p, **more).collect(), key=lambda r: r.doc_id)]


def shape(text):
    return re.sub("[0-9]", "0", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", text)))


def test_values_change_within_their_format_and_back(spark):
    texts = [f"é {v} and {v}, ({v})" for v in VALID]
    got = change(spark, texts)
    for value, text in zip(VALID, got):
        one = re.fullmatch(r"é (.*) and (.*), \((.*)\)", text)
        assert one and one[1] == one[2] == one[3] != value
        new = one[1]
        if value.count(".") == 3 and "@" not in value:
            assert all(0 <= int(x) <= 255 and str(int(x)) == x for x in new.split("."))
        else:
            assert shape(new) == shape(value)
        if "@" in value:
            assert new.split("@")[1] == value.split("@")[1]
        if len(re.sub("[^0-9]", "", value)) == 16:
            assert luhn(re.sub("[^0-9]", "", new))
        if re.fullmatch(r"\d{4}-\d\d-\d\d", value):
            assert 1800 <= dt.date.fromisoformat(new).year <= 2199
        if value.startswith("+1"):
            assert new.startswith("+1 (")
        assert re.search(ANY, new)
    assert change(spark, got, back=True) == texts
    assert change(spark, texts, Pseudonyms("k2")) != got


def test_what_fails_its_check_stays(spark):
    texts = [f"a {v} b" for v in INVALID] + ["", " \n", "nothing here"]
    assert change(spark, texts) == texts


def test_rows_and_columns_stay(spark):
    rows = [(None, VALID[0]), (1, None), (2, ""), (3, VALID[0]), (3, VALID[0]), (4, "x " * 50_000 + VALID[0])]
    docs = documents(spark, rows, clash=True)
    done = pseudonyms(docs, P)
    assert done.columns == docs.columns
    got = done.collect()
    assert len(got) == len(rows) and len({r.text for r in got if r.doc_id in (None, 3)}) == 1
    assert [r.text for r in got if r.doc_id in (1, 2)] == [None, ""]
    assert pseudonyms(documents(spark, []), P).collect() == []


def test_the_network_is_a_permutation(spark):
    for radices in ([7], [3, 5], [10, 10, 4], [189, 3]):
        size = 1
        for r in radices:
            size *= r
        rows = spark.range(size)
        values, rest = [], F.col("id")
        for r in radices:
            values.append(F.pmod(rest, F.lit(r)))
            rest = F.floor(rest / r)
        base = F.array(*[F.lit(r).cast("long") for r in radices])
        there = feistel(F.array(*values), base, F.lit("key"))
        back = feistel(F.col("there"), base, F.lit("key"), back=True)
        got = rows.select(F.array(*values).alias("v"), there.alias("there")).withColumn("back", back).collect()
        assert len({tuple(r.there) for r in got}) == size
        assert all(r.back == r.v and all(0 <= x < b for x, b in zip(r.there, radices)) for r in got)


def test_equal_values_stay_linked_in_the_given_documents(spark, table):
    docs = {r.doc_id: r.text for r in table("documents").collect()}
    done = pseudonyms(table("documents"), P, kinds="kinds").collect()
    linked = {}
    for r in done:
        before, after = (re.findall(r"\d{1,3}(?:\.\d{1,3}){3}", t) for t in (docs[r.doc_id], r.text))
        assert len(before) == len(after)
        if not r.kinds:
            assert r.text == docs[r.doc_id]
        for a, b in zip(before, after):
            assert linked.setdefault(a, b) == b
    assert linked and len(set(linked.values())) == len(linked)


def test_numbers_followed_or_led_by_more_digits(spark):
    c = card(1)
    spaced = " ".join(c[k : k + 4] for k in range(0, 16, 4))
    phone, other = "555-123-4567", "555-987-6543"
    alone = dict(zip([spaced, c, phone, other, "10.0.0.1", "31.12.1999", "2024-02-29"], change(spark, [spaced, c, phone, other, "10.0.0.1", "31.12.1999", "2024-02-29"])))
    texts = [
        [spaced, " 123"], [spaced, " 12/27"], [c, "-99"], [c, " 12/27 123"], ["12 ", spaced, " 7"], [spaced, " ", c, " ", spaced],
        [phone, " ", other], [phone, " 2024"], ["2024 ", phone, " 1"], [spaced, " ", phone], [c, " 555 ", other],
        [spaced, " ", "10.0.0.1"], [spaced, " ", "31.12.1999"], ["123 ", "2024-02-29", " 12345"], ["1 22 333 ", spaced, " 55555"],
    ]
    got = change(spark, ["call " + "".join(t) + " now" for t in texts])
    assert got == ["call " + "".join(alone.get(x, x) for x in t) + " now" for t in texts]
    assert all(alone[x] != x for x in alone)
    assert change(spark, got, back=True) == ["call " + "".join(t) + " now" for t in texts]
    assert luhn(re.sub("[^0-9]", "", alone[spaced]))


def test_ssns_stay_valid_and_come_back(spark):
    draw = random.Random(11)
    areas = [a for a in range(1, 900) if a != 666]
    given = sorted({f"{draw.choice(areas):03d}-{draw.randrange(1, 100):02d}-{draw.randrange(1, 10_000):04d}" for _ in range(10_000)})
    given += ["001-01-0001", "665-99-9999", "667-01-0001", "899-99-9999"]
    given = sorted(set(given))
    p = Pseudonyms("k")
    docs = documents(spark, [(k, " and ".join(given[k : k + 100])) for k in range(0, len(given), 100)])
    moved = pseudonyms(docs, p, kinds="kinds").orderBy("doc_id").collect()
    new = [x for r in moved for x in r.text.split(" and ")]
    assert len(set(new)) == len(given) and {k for r in moved for k in r.kinds} == {"ssn"}
    assert all(len(r.kinds) == len(r.text.split(" and ")) for r in moved)
    assert not any(re.search(r"^(000|666|9)|-00-|-0000$", x) for x in new)
    back = pseudonyms(spark.createDataFrame([(r.doc_id, r.text) for r in moved], "doc_id long, text string"), p, back=True)
    assert [x for r in back.orderBy("doc_id").collect() for x in r.text.split(" and ")] == given


def test_one_letter_names_are_permuted_not_shifted(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    docs = documents(spark, [(k, f"{c}@x.org") for k, c in enumerate(letters)])
    new = [r.text[0] for r in pseudonyms(docs, Pseudonyms("k")).orderBy("doc_id").collect()]
    assert sorted(new) == list(letters)
    assert len({(ord(a) - ord(b)) % 26 for a, b in zip(new, letters)}) > 5
    moved = documents(spark, [(k, f"{c}@x.org") for k, c in enumerate(new)])
    assert [r.text[0] for r in pseudonyms(moved, Pseudonyms("k"), back=True).orderBy("doc_id").collect()] == list(letters)
