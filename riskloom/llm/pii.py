"""Personal data by DataFrame functions alone.

Base kinds are fixed patterns. ``split`` gives what lies between the matches of
a pattern and ``regexp_extract_all`` the matches, both from left to right, so
the lengths of the two add up to where every match stands.

Beyond them, loose generators propose overlapping candidates: addresses spelled
out, local numbers, defanged hosts, cards in unusual groups. Boosted trees see a
candidate's format and its surroundings. They learn from evidence that does not
depend on what the base kinds cover: a base match rewritten into a loose form, in
its own surroundings, is personal data; one whose check digit, range or length
was spoilt is not, nor is a proposal that fails its format or is a bare number
without a word that announces it. Proposals with neither evidence are not
learned from. A threshold per kind, calibrated on examples kept aside, selects
what is redacted too. The trees are written out as one expression, so scoring
stays in the scan of the texts: nothing is exploded, shuffled or joined.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import isqrt

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import whole

KINDS = ("email", "ip", "card", "phone")

# The base patterns. Possessive quantifiers and the condition on what
# precedes an e-mail match the same runs as the plain patterns would, without going
# back; a card's run is as long as it can be, so asking for 14 digits finds the same runs.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# End of fixed values.

#: A text without this cannot hold the kind, so its pattern is not tried.
_NEEDS = {"email": "@", "ip": ".", "phone": "+"}

#: Loose generators, by the kind a candidate of theirs would be.
GENERATORS = {
    "email": r"[^\s@<>\"]{1,64}+@[^\s@<>\"]{1,255}+"
    r"|(?<![\w.%+-])[\w.%+-]{1,64}+\x20?(?:\[at\]|\(at\)|(?<=\x20)at(?=\x20))\x20?[\w-]++"
    r"(?:(?:\x20?(?:\[dot\]|\(dot\))\x20?|\x20dot\x20|\.)[\w-]++)+",
    "ip": r"(?<![0-9A-Za-z])[0-9]{1,4}(?:(?:\[\.\]|\(\.\)|\x20?[\[(]dot[\])]\x20?|\x20\.\x20?|\.\x20)[0-9]{1,4}){3}(?![0-9])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[\x20._/-]{0,3}[0-9]){12,18}+(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z])[+(]?[0-9](?:[\x20().-]{0,2}[0-9]){6,18}+",
}

#: Texts without a match of this have no candidate of the kind.
_MAY_HOLD = {"email": r"@|[\[(\x20]at[\])\x20]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}

#: Words before a candidate that announce its kind.
CUES = {
    "email": r"(?i)\b(e-?mail|contact|write|reach)\b",
    "ip": r"(?i)\b(ip|host|server|address|from)\b",
    "card": r"(?i)\b(card|visa|credit|debit|account|pay|paid)\b",
    "phone": r"(?i)\b(phone|tel|telephone|fax|mobile|cell|call|number)\b",
}

#: Characters before a candidate that the trees see, as far as the candidate before it.
CONTEXT = 24

#: Trees and their depth.
TREES, DEPTH = 12, 3

#: Share of the selected examples that must be personal data, among those of a kind kept aside.
PRECISION = 0.95

#: Elements that a running value is carried through at a time, and characters of a text's pieces.
_BLOCK = 128
_PIECE = 4096

_SPANS = "array<struct<start:int,end:int,found:string,before:string,after:string>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, zero: int, combine: Callable[[Column, Column], Column]) -> Column:
    """``combine`` of all values up to each one, of an array of int.

    An array grows by copying, so values are taken in blocks: a text with many matches takes time in
    proportion to them.
    """

    def over(items: Column) -> Column:
        def block(state: Column, n: Column) -> Column:
            begin = F.struct(state["at"].alias("at"), F.array().cast("array<int>").alias("out"))

            def step(inner: Column, value: Column) -> Column:
                at = combine(inner["at"], value)
                return F.struct(at.alias("at"), F.concat(inner["out"], F.array(at)).alias("out"))

            done = F.aggregate(F.slice(items, n * _BLOCK + 1, F.lit(_BLOCK)), begin, step)
            return _let(done, lambda d: F.struct(
                d["at"].alias("at"), F.concat(state["out"], F.array(d["out"])).alias("out")
            ))

        begin = F.struct(F.lit(zero).alias("at"), F.array().cast("array<array<int>>").alias("out"))
        blocks = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(items) / _BLOCK).cast("int") - 1, F.lit(0)))
        return F.aggregate(blocks, begin, block, lambda state: F.flatten(state["out"]))

    return _let(values, over)


def matches(text: Column, pattern: str) -> Column:
    """Matches of ``pattern`` from left to right: array of (start, end, found, before, after).

    Places are in code points. ``before`` has at most CONTEXT characters and ``after`` one; neither
    reaches into another match.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(m: Column, gaps: Column) -> Column:
        sizes = F.zip_with(F.slice(gaps, F.lit(1), F.size(m)), m, lambda g, f: F.length(g) + F.length(f))
        return _let(running(sizes, 0, lambda at, n: at + n), lambda ends: F.transform(m, lambda f, i: F.struct(
            (ends[i] - F.length(f)).alias("start"),
            ends[i].alias("end"),
            f.alias("found"),
            F.right(gaps[i], F.lit(CONTEXT)).alias("before"),
            F.left(gaps[i + 1], F.lit(1)).alias("after"),
        )))

    some = lambda m: _let(F.split(text, pattern, -1), lambda gaps: placed(m, gaps))
    return _let(found, lambda m: F.when(F.size(m) > 0, some(m)).otherwise(F.array().cast(_SPANS)))


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the last digit checks the others."""
    code = F.transform(F.split(F.reverse(digits), ""), lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))
    twice = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    weighed = F.transform(code, lambda d, n: F.when(n % 2 == 1, twice(d)).otherwise(d))
    return F.aggregate(weighed, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    digits = _digits(found)
    if kind == "ip":
        # Four parts of any length; zeros in front do not make a part larger.
        part = lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3
        value = lambda p: F.coalesce(F.when(part(p), p.try_cast("decimal(38,0)")), F.lit(999)) <= 255
        return F.forall(F.split(found, r"\."), lambda p: value(F.right(p, F.lit(38))) & part(p))
    if kind == "card":
        return F.length(digits).between(14, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Spans of one base kind, failing matches dropped."""
    found = F.filter(matches(text, BASE[kind]), lambda m: _valid(kind, m["found"]))
    if kind in _NEEDS:
        return F.when(F.contains(text, F.lit(_NEEDS[kind])), found).otherwise(F.array().cast(_SPANS))
    return found


FEATURES = ("length", "digits", "letters", "plus", "dots", "dashes", "spaces", "parens", "groups", "at", "after_at",
            "fits", "bare", "before_word", "before_digit", "after_word", "cue", *(f"is_{kind}" for kind in KINDS))

_PROPOSAL = f"struct<kind:string,start:int,end:int,{','.join(f'{name}:double' for name in FEATURES)}>"


def _fits(kind: str, found: Column) -> Column:
    """Whether a loose form passes the check of its kind."""
    if kind == "email":
        return F.regexp_like(found, F.lit(r"(?:@|\bat\b).*(?:\.|\bdot\b)[\])\x20]*\p{L}{2,}\W*$"))
    if kind == "ip":
        parts = F.regexp_extract_all(found, F.lit("[0-9]+"), F.lit(0))
        return (F.size(parts) == 4) & F.forall(parts, lambda p: p.cast("int") <= 255)
    digits = _digits(found)
    if kind == "card":
        return F.length(digits).between(13, 19) & luhn(digits)
    return F.length(digits).between(7, 15)


def _seen(kind: str, start: Column, end: Column, found: Column, before: Column, after: Column) -> Column:
    """A proposal with what the trees see of it."""
    size = F.length(found)
    many = lambda p: size - F.length(F.regexp_replace(found, p, ""))
    values = {
        "length": size,
        "digits": many("[0-9]"),
        "letters": many(r"\p{L}"),
        "plus": F.startswith(found, F.lit("+")),
        "dots": many(r"\."),
        "dashes": many("-"),
        "spaces": many(" "),
        "parens": many("[()]"),
        "groups": F.size(F.regexp_extract_all(found, F.lit("[0-9]+"), F.lit(0))),
        "at": many("@"),
        "after_at": F.length(F.regexp_extract(found, "@(.*)$", 1)),
        "fits": _fits(kind, found),
        "bare": F.regexp_like(found, F.lit("^[0-9]+$")),
        "before_word": F.regexp_like(before, F.lit(r"\w$")),
        "before_digit": F.regexp_like(before, F.lit("[0-9][.-]?$")),
        "after_word": F.regexp_like(after, F.lit(r"^\w")),
        "cue": F.regexp_like(before, F.lit(CUES[kind])),
        **{f"is_{other}": F.lit(other == kind) for other in KINDS},
    }
    fields = [values[name].cast("double").alias(name) for name in FEATURES]
    return F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), *fields)


def candidates(text: Column) -> Column:
    """Overlapping proposals of all generators with what the trees see of each."""

    def proposed(kind: str) -> Column:
        one = lambda m: _seen(kind, m["start"], m["end"], m["found"], m["before"], m["after"])
        some = F.transform(matches(text, GENERATORS[kind]), one)
        return F.when(F.regexp_like(text, F.lit(_MAY_HOLD[kind])), some).otherwise(F.array().cast(f"array<{_PROPOSAL}>"))

    return F.concat(*map(proposed, KINDS))


def _apart(spans: Column, items: Column) -> Column:
    """``items`` that overlap none of ``spans``, by start. Both have ``start`` and ``end``."""
    far = 2**31 - 1

    def event(item: bool) -> Callable[[Column], Column]:
        return lambda s, n: F.struct(s["start"].alias("start"), F.lit(item).alias("item"), s["end"].alias("end"), n.alias("n"))

    def kept(events: Column) -> Column:
        ends = F.transform(events, lambda e: F.when(e["item"], 0).otherwise(e["end"]))
        starts = F.transform(F.reverse(events), lambda e: F.when(e["item"], far).otherwise(e["start"]))
        reach = running(ends, 0, lambda a, b: F.greatest(a, b))
        following = F.reverse(running(starts, far, lambda a, b: F.least(a, b)))
        free = lambda e, i, r, f: e["item"] & (r[i] <= e["start"]) & (f[i] >= e["end"])
        return _let(reach, lambda r: _let(following, lambda f: F.filter(events, lambda e, i: free(e, i, r, f))))

    found = F.concat(F.transform(spans, event(False)), F.transform(items, event(True)))
    some = _let(items, lambda all_: F.transform(_let(F.sort_array(found), kept), lambda e: all_[e["n"]]))
    return F.when(F.size(items) > 0, some).otherwise(items)


def _loose(kind: str, m: Column) -> list[tuple[Column, Column]]:
    """Loose forms of a base match that are personal data still, each with what stands before it."""
    found, before = m["found"], m["before"]
    if kind == "email":
        local, domain = F.substring_index(found, "@", 1), F.substring_index(found, "@", -1)
        spelled = F.concat(local, F.lit(" [at] "), F.regexp_replace(domain, r"\.", " [dot] "))
        forms = [F.concat(local, F.lit(" (at) "), domain), spelled, F.regexp_replace(found, "@", "é@")]
    elif kind == "ip":
        forms = [F.regexp_replace(found, r"\.", with_) for with_ in ("[.]", " . ", "(dot)")]
    elif kind == "card":
        forms = [F.regexp_replace(_digits(found), "([0-9]{4})(?=[0-9])", f"$1{by}") for by in (".", " - ", "/")]
    else:
        local = F.regexp_replace(found, r"^\+[0-9]{1,3}[\x20.-]*", "")
        digits = _digits(local)
        forms = [local, *(F.regexp_replace(digits, "^([0-9]{3})([0-9]{3,4})([0-9]+)$", f"$1{by}$2{by}$3") for by in ".- ")]
        marked = [F.when(~F.regexp_like(form, F.lit("^[0-9]+$")), form) for form in forms]
        return [*((form, before) for form in marked), (digits, F.lit("phone: "))]
    return [(form, before) for form in forms]


def _spoilt(kind: str, m: Column) -> list[tuple[Column, Column]]:
    """Rewritten base matches that are no personal data any more, each with what stands before it."""
    found, before = m["found"], m["before"]
    if kind == "email":
        forms = [F.regexp_replace(found, r"\.(?=[^@]*$)", "")]
    elif kind == "ip":
        forms = [F.regexp_replace(F.regexp_replace(found, "^[0-9]+", "999"), r"\.", by) for by in ("[.]", " . ", "(dot)")]
    elif kind == "card":
        digits = _digits(found)
        last = (F.right(digits, F.lit(1)).cast("int") + 1) % 10
        changed = F.concat(F.left(digits, F.length(digits) - 1), last.cast("string"))
        forms = [F.regexp_replace(changed, "([0-9]{4})(?=[0-9])", f"$1{by}") for by in (".", " - ", "/", "")]
    else:
        digits = _digits(found)
        return [(digits, F.lit(" ")), (F.left(F.concat(digits, digits), F.lit(18)), before), (F.left(digits, F.lit(8)), F.lit("in "))]
    return [(form, before) for form in forms]


def _tree(node, one: Column) -> Column:
    """A trained tree as nested conditions over a candidate's fields."""
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(float(node.prediction()))
    split = node.split()
    name = FEATURES[split.featureIndex()]
    return F.when(one[name] <= float(split.threshold()), _tree(node.leftChild(), one)).otherwise(
        _tree(node.rightChild(), one)
    )


class Selector:
    """Boosted trees and the least margin that redacts, by kind; without trees it selects nothing."""

    def __init__(self, model=None, least: dict[str, float] | None = None):
        self._trees = [t._call_java("rootNode") for t in model.trees] if model else []
        self._weights = list(model.treeWeights) if model else []
        self.least = dict(least or {})

    def margin(self, one: Column) -> Column:
        parts = [_tree(t, one) * float(w) for t, w in zip(self._trees, self._weights)]
        return reduce(Column.__add__, parts, F.lit(0.0))

    def selects(self, one: Column) -> Column:
        if not self._trees or not self.least:
            return F.lit(False)
        bounds = [F.when(one["kind"] == kind, F.lit(least)) for kind, least in self.least.items()]
        return F.coalesce(self.margin(one) >= F.coalesce(*bounds), F.lit(False))


def _sides(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text) with the spans of each base kind and all candidates."""
    body = whole(text)
    base = documents.select(F.col(key).alias("key"), body.alias("text"))
    base = base.select("*", *(base_spans(F.col("text"), k).alias(k) for k in KINDS))
    return base.withColumn("candidates", candidates(F.col("text")))


def _examples(kind: str) -> Column:
    """Proposals made from the base matches of a kind by rewriting them, with their label."""

    def made(m: Column) -> Column:
        pairs = [(*pair, 1.0) for pair in _loose(kind, m)] + [(*pair, 0.0) for pair in _spoilt(kind, m)]
        forms = [F.struct(f.alias("found"), b.alias("before"), F.lit(label).alias("label")) for f, b, label in pairs]
        # Only what the generator would propose as a whole.
        whole_ = F.filter(F.array(*forms), lambda x: F.regexp_extract(x["found"], GENERATORS[kind], 0) == x["found"])
        return F.transform(whole_, lambda x: F.struct(
            _seen(kind, m["start"], m["end"], x["found"], x["before"], m["after"]).alias("one"), x["label"].alias("label")
        ))

    return F.flatten(F.transform(kind, made))


def _refuted(one: Column) -> Column:
    """Whether a proposal's format or surroundings speak against it."""
    glued = one["before_word"] + one["before_digit"] + one["after_word"] + one["bare"] > 0
    return (one["fits"] == 0) | ((one["cue"] == 0) & glued)


def _counted(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(kind, FEATURES, label, side, weight): the examples of all texts, each distinct one with its number.

    By a hash of the key, side 0 is for learning and side 1 for calibration.
    """
    sides = _sides(documents, key, text)
    made = sides.select("key", F.explode(F.concat(*map(_examples, KINDS))).alias("x")).select("key", "x.one", "x.label")
    spans = F.concat(*(F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for k in KINDS))
    free = sides.select("key", F.explode(_apart(spans, F.col("candidates"))).alias("one"))
    free = free.where(_refuted(F.col("one"))).withColumn("label", F.lit(0.0))
    side = F.pmod(F.xxhash64(F.lit(11), "key"), F.lit(2)).alias("side")
    columns = ["kind", *FEATURES, "label", "side"]
    every = made.unionByName(free).select("one.*", "label", side)
    # Few and small numbers describe a candidate, so most are like many others.
    return every.groupBy(*columns).agg(F.count("*").cast("double").alias("weight")).sortWithinPartitions(*columns)


def train(documents: DataFrame, key: str = "doc_id", text: str = "text") -> Selector:
    """Fit trees and thresholds on all texts.

    The examples of half of the texts calibrate. A kind without base matches there gets no
    threshold and adds nothing; without examples of both labels no kind does.
    """
    found = stage(_counted(documents, key, text), "candidates")
    table = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found)
    learn, check = table.where("side = 0"), table.where("side = 1")
    if learn.select("label").distinct().count() < 2:
        return Selector()
    # MLlib looks at the square of the bins of rows for its splits, so that these are all there are.
    bins = max(32, isqrt(learn.count()) + 1)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=bins, seed=5, labelCol="label", weightCol="weight")
    selector = Selector(trees.fit(learn))
    one = F.struct(*FEATURES)
    margins = check.select("kind", F.round(selector.margin(one), 3).alias("margin"), "label", "weight")
    # Margins of a few small trees take few values.
    steps = margins.groupBy("kind", "margin").agg(
        F.sum(F.col("label") * F.col("weight")).alias("good"), F.sum("weight").alias("n")
    ).orderBy(F.desc("margin")).collect()
    good, n = dict.fromkeys(KINDS, 0.0), dict.fromkeys(KINDS, 0.0)
    for row in steps:
        kind = row["kind"]
        good[kind], n[kind] = good[kind] + row["good"], n[kind] + row["n"]
        if good[kind] and good[kind] >= PRECISION * n[kind]:
            selector.least[kind] = row["margin"] - 0.0005
    return selector


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_personal_data(
    documents: DataFrame, selector: Selector, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Personal data of every text: (key, n_email, n_ip, n_card, n_phone, base, spans,
    redacted), a row per row.

    Spans are ``kind:start:end`` in code points, by start and then kind, joined by
    commas; ``spans`` has those of ``base`` and what the selector adds outside
    them, which may overlap each other. Null and empty texts have none. An empty
    table gives no rows. A text takes time in proportion to its length and matches.
    """
    order = {kind: n for n, kind in enumerate(KINDS)}

    def placed(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(
            s["start"].alias("start"), F.lit(order[kind]).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")
        ))

    sides = _sides(documents, key, text)
    sides = sides.withColumn("base", F.sort_array(F.concat(*map(placed, KINDS))))
    rank = F.create_map(*(F.lit(x) for pair in order.items() for x in pair))
    chosen = F.transform(F.filter("candidates", selector.selects), lambda c: F.struct(
        c["start"].alias("start"), rank[c["kind"]].alias("rank"), c["end"].alias("end"), c["kind"].alias("kind")
    ))
    sides = sides.withColumn("chosen", chosen)
    every = F.concat("base", _apart(F.col("base"), F.col("chosen")))
    sides = sides.withColumn("every", F.sort_array(every))
    return sides.select(
        F.col("key").alias(key),
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        _joined(F.col("base")).alias("base"),
        _joined(F.col("every")).alias("spans"),
        redacted(F.col("text"), F.col("every")).alias("redacted"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; of overlapping spans the first is shown."""

    def cut(pieces: Column, start: Column, end: Column) -> Column:
        first = F.floor(start / _PIECE).cast("int")
        held = F.array_join(F.slice(pieces, first + 1, F.floor(end / _PIECE).cast("int") - first + 1), "")
        return F.substring(held, start - first * _PIECE + 1, F.greatest(end - start, F.lit(0)))

    def over(pieces: Column, reach: Column) -> Column:
        def shown(s: Column, i: Column) -> Column:
            since = F.when(i > 0, F.get(reach, i - 1)).otherwise(0)
            put = F.concat(cut(pieces, since, s["start"]), F.lit("["), s["kind"], F.lit("]"))
            return F.when(s["start"] >= since, put).otherwise("")

        rest = cut(pieces, F.element_at(reach, -1), F.length(text))
        return F.concat(F.array_join(F.transform(spans, shown), ""), rest)

    ends = running(F.transform(spans, lambda s: s["end"]), 0, lambda a, b: F.greatest(a, b))
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0))
    some = _let(pieces, lambda p: _let(ends, lambda reach: over(p, reach)))
    return F.when(F.size(spans) > 0, some).otherwise(text)
