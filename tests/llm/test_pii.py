import random
import re
import time

import pytest
from pyspark.sql import functions as F

from riskloom.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for n, d in enumerate(map(int, reversed(digits))):
        total += (2 * d - 9 if d > 4 else 2 * d) if n % 2 else d
    return total % 10 == 0


def valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    return {
        "email": True,
        "ip": kind == "ip" and all(int(p) <= 255 for p in found.split(".")),
        "card": 14 <= len(digits) <= 19 and luhn(digits),
        "phone": 10 <= len(digits) <= 15,
    }[kind]


def by_hand(text):
    out = []
    for n, (kind, pattern) in enumerate(PLAIN.items()):
        if kind == "email" and "@" not in (text or ""):
            continue  # the plain pattern takes time in the square of a long word
        out += [(m.start(), n, m.end(), kind) for m in re.finditer(pattern, text or "") if valid(kind, m[0])]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


HARD = [
    "a@b.c%d@e.f", "x@y", "é@b.co a.b@c.d.e-", "1.2.3.4.5.6.7.8", "256.1.1.1 001.002.003.0004 0000000000255.1.1.1",
    "4808875255130719 4808-8752 5513 0719", "+1 (017) 555-7713 +12", "1" * 60, "+" * 20 + "1234567890 ",
    "a" * 3000 + "@b.c", "@@a@b.c@d.e", "9" * 50 + ".1.1.1", "日本 a@b.cc 1.1.1.1",
]


def test_base_spans_equal_the_plain_patterns(documents, odd_rows):
    rng = random.Random(3)
    texts = HARD + ["".join(rng.choice("a1 0.-+@()b4é") for _ in range(60)) for _ in range(800)]
    rows = [*odd_rows, *((100 + n, t) for n, t in enumerate(texts))]
    got = pii.find_personal_data(documents(rows), pii.Selector()).collect()
    assert sorted((str(r["doc_id"]), r["base"]) for r in got) == sorted((str(i), by_hand(t)) for i, t in rows)
    assert all(r["spans"] == r["base"] for r in got)
    assert all(r["n_ip"] == r["base"].count("ip:") for r in got)


@pytest.fixture
def trained(documents):
    """Texts with numbers in base form, local ones, and plain digits."""
    rng = random.Random(4)
    rows = []
    for n in range(600):
        number = f"({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"
        shown = [f"+1 {number}", number, f"v{rng.randrange(10)}.{rng.randrange(10**8)}", f"{rng.randrange(10**8)}x"]
        rows.append((n, f"{rng.choice(['call me at', 'text of'])} {rng.choice(shown)} and ann{n}@mail.example.com ok"))
    df = documents(rows)
    return df, pii.train(df)


def test_added_spans_keep_base_ones_apart(trained):
    df, selector = trained
    assert selector._trees
    for row in pii.find_personal_data(df, selector).collect():
        base, every = set(row["base"].split(",")), set(row["spans"].split(","))
        assert base <= every
        for span in every - base:
            _, a, b = span.split(":")
            assert all(int(b) <= int(s.split(":")[1]) or int(a) >= int(s.split(":")[2]) for s in base if s)


def test_expression_equals_the_trained_trees(trained):
    df, selector = trained
    one = F.struct(*(F.lit(float(n % 5)).alias(name) for n, name in enumerate(pii.FEATURES)))
    total = 0.0
    for tree, weight in zip(selector._trees, selector._weights):
        node = tree
        while node.getClass().getSimpleName() != "LeafNode":
            split = node.split()
            node = node.leftChild() if split.featureIndex() % 5 <= split.threshold() else node.rightChild()
        total += node.prediction() * weight
    assert abs(df.limit(1).select(selector.margin(one).alias("m")).first()["m"] - total) < 1e-9


def test_no_python_in_the_plan(trained):
    plan = pii.find_personal_data(*trained)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def found(selector, documents, text):
    row = pii.find_personal_data(documents([(1, text)]), selector).first()
    return [(k, text[int(a) : int(b)]) for k, a, b in (x.split(":") for x in row["spans"].split(",") if x)]


@pytest.fixture(scope="module")
def learned(spark):
    """A selector that has seen base forms among plain numbers only."""
    rng = random.Random(6)
    rows = []
    for n in range(1500):
        digits = "".join(rng.choice("0123456789") for _ in range(15))
        card = next(digits + d for d in "0123456789" if luhn(digits + d))
        shown = [
            f"+49 30 555 {rng.randrange(1000, 9999)}", f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}",
            rng.choice([f"ann.{n}@mail{n % 9}.example.com", f"bo{'bo' * (n % 4)}@example.org", f"j.d-{n % 3}@mail.co"]), ".".join(str(rng.randrange(256)) for _ in range(4)), card,
            str(rng.randrange(10**9, 10**12)), f"{rng.randrange(1000)}.{rng.randrange(10**5)}", digits + "77",
        ]
        rows.append((n, f"{rng.choice(['we saw', 'text of', 'the'])} {rng.choice(shown)} and more {rng.choice(shown)}."))
    return pii.train(spark.createDataFrame(rows, "doc_id bigint, text string"))


def test_loose_forms_are_added_and_plain_numbers_are_not(learned, documents):
    assert set(learned.least) == set(pii.KINDS)
    for kind, text, form in [
        ("phone", "my phone: 0175557713 ok", "0175557713"),
        ("phone", "so (017) 555-7713 it is", "(017) 555-7713"),
        ("email", "to ann (at) mail.example.com now", "ann (at) mail.example.com"),
        ("ip", "on 10[.]1[.]2[.]33 now", "10[.]1[.]2[.]33"),
        ("card", "by 4808.8752.5513.0719 now", "4808.8752.5513.0719"),
    ]:
        assert (kind, form) in found(learned, documents, text), text
    for text in ["in 20231201 we", "of 1234567890 rows", "on 999[.]1[.]2[.]33", "by 4808.8752.5513.0718.", "look at me. So", "x@y"]:
        assert found(learned, documents, text) == [], text


def test_added_spans_overlap_no_base_span(learned, documents):
    rng = random.Random(8)
    parts = ["+1 (017) 555-7713", "(017) 555-7713", "a@b.co", "é@b.co", "1.2.3.4", "1[.]2[.]3[.]4", "4808 8752 5513 0719", " ", "x"]
    rows = [(n, rng.choice(["", " "]).join(rng.choice(parts) for _ in range(40))) for n in range(60)]
    more = 0
    for row in pii.find_personal_data(documents(rows), learned).collect():
        spans = lambda x: [(int(a), int(b), k) for k, a, b in (s.split(":") for s in x.split(",") if s)]
        base, every = spans(row["base"]), spans(row["spans"])
        added = set(every) - set(base)
        more += len(added)
        assert set(base) <= set(every) and len(every) == len(base) + len(added)
        assert not any(a < d and c < b for a, b, _ in added for c, d, _ in base)
    assert more


def test_long_text_with_many_matches(learned, documents):
    text = "1.2.3.4 a " * 60_000 + "é" + "(017) 555-7713 x " * 30_000
    began = time.monotonic()
    row = pii.find_personal_data(documents([(1, text)]), learned).first()
    assert row["n_ip"] == 60_000 and row["spans"].count("phone:") == 30_000
    assert row["redacted"] == "[ip] a " * 60_000 + "é" + "[phone] x " * 30_000
    assert time.monotonic() - began < 120


def test_running_values_cross_blocks(spark):
    df = spark.range(1).select(F.sequence(F.lit(1), F.lit(1000)).alias("v"))
    sums = df.select(pii.running(F.col("v"), 0, lambda a, b: a + b).alias("r")).first()["r"]
    assert sums == [n * (n + 1) // 2 for n in range(1, 1001)]
    assert df.select(pii.running(F.slice("v", 1, F.lit(0)), 0, lambda a, b: a + b).alias("r")).first()["r"] == []


def test_redaction(documents):
    text = "to a@b.cc from +1 (017) 555-7713 é 1.2.3.4"
    row = pii.find_personal_data(documents([(1, text)]), pii.Selector()).first()
    assert row["redacted"] == "to [email] from [phone] é [ip]"


def test_training_without_candidates(documents):
    for rows in ([], [(1, None), (2, "no candidates")]):
        assert pii.find_personal_data(documents(rows), pii.train(documents(rows))).count() == len(rows)


def test_every_text_is_learned_from(spark):
    """More texts than were once drawn: each one's examples count."""
    rows = spark.range(0, 24_000, 1, 8).select(F.col("id").alias("doc_id"), F.lit("see 1.2.3.4 or a@b.cc").alias("text"))
    few = pii._counted(rows.where("doc_id < 600"), "doc_id", "text").agg(F.sum("weight")).first()[0]
    counted = pii._counted(rows, "doc_id", "text").agg(F.sum("weight"), F.count("*")).first()
    assert few and counted[0] == 40 * few and counted[1] < 100


def test_a_kind_of_few_texts_among_many_gets_its_threshold(spark):
    """The only texts with addresses are ones that a draw of 20,000 from these would leave out."""
    number = F.concat(F.lit("+49 30 555 "), F.lpad((F.col("id") % 9000 + 1000).cast("string"), 4, "0"), F.lit(" or "), F.col("id"))
    drawn = F.pmod(F.xxhash64(F.lit(7), F.col("id")), F.lit(1 << 20)) < int(20 / 24 * (1 << 20))
    ip = F.concat(F.lit(" and 10.1.2."), F.col("id") % 250)
    text = F.concat(number, F.when(~drawn, ip).otherwise(""))
    selector = pii.train(spark.range(0, 24_000, 1, 8).select(F.col("id").alias("doc_id"), text.alias("text")))
    assert {"phone", "ip"} <= set(selector.least)
