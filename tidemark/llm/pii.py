"""Personal data: proposed spans, scored by boosted trees, with calibrated thresholds.

Generators propose spans with much recall: the four base patterns, and looser ones (masked e-mail
signs, digit groups inside longer runs, telephone numbers without a plus), which may overlap. Base
matches that pass their check are always kept. Boosted trees score the others by format (digits,
groups, separators, check sum, octets) and context (characters and words around).

Their labels do not come from the checks. Passages of a bounded sample of documents get a span
planted: personal data as people write them, with and without words that announce them and with
mistyped check digits, or numbers and signs that only look alike (versions, amounts, dates, order and
part numbers, prices). A candidate is positive if it is a planted span of its kind, negative if it
lies in a look-alike or is only a part of a span, or of another kind. A held-out part of the planted
passages sets, for each kind, the least score with the wanted precision among candidates that the
base check leaves out; ``quality_of`` tells precision and recall there. Looser candidates above it
that touch no base span are added, of overlapping ones the best. The trees become one built-in
expression, so the main path is a projection of each document without a shuffle.

Cases: a null or empty text has no spans; rows are independent, so null ids, ties and equal rows
need no rule; however few documents there are, as many passages are planted; an empty table gives an
empty table. Columns of the input come back only inside ``row``, by ``carry``, so no name clashes.
No pattern crosses a line, and patterns are possessive, so long runs cost linear time. Places in a
text are summed up in an array that is copied per match: 10,000 matches in one text are cheap, a
million take minutes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_or_empty
from tidemark.session import freeze

KINDS = ("email", "ip", "card", "phone")
OPEN, CLOSE, OTHER = "\ue000", "\ue001", "\ufffd"

#: (kind, pattern, what a text must hold). A run that cannot start a match is entered at its first
#: character only, or where the match before ended.
BASE = (
    (
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
    ),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    ("card", r"(?<![0-9])[0-9](?:[ -]?[0-9])++", r"[0-9][ -]?[0-9]"),
    ("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]"),
)
LOOSE = (
    (
        "email",
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++"
        r"(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)++",
        r"\(at\)|\[at\]|@",
    ),
    ("card", r"(?<![0-9])[0-9]{12,19}(?![0-9])", r"[0-9]{12}"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9])", r"[0-9]{4}[ -][0-9]{4}"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])", r"[0-9]\.[0-9]"),
    (
        "phone",
        r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])",
        r"\+[0-9]",
    ),
    (
        "phone",
        r"(?<![0-9])(?:00[0-9]{1,3}[ .-])?\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])",
        r"[0-9][ .-][0-9]",
    ),
)
CONTEXT = 24
#: Words before a span that speak for its kind.
HINTS = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "addr"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("tel", "phone", "call", "fon", "mobile", "fax"),
}
#: Words before a number that speak against personal data.
AGAINST = (
    "order", "ref", "no\\.", "nr", "version", "section", "isbn", "serial", "tracking", "total", "sum",
    "amount", "invoice", "part", "chapter", "release", "build", "eur", "usd", "price", "dated", "stamp",
)
FEATURES = (
    "kind", "n_chars", "n_digits", "n_groups", "first_group", "last_group", "luhn", "octets", "at",
    "paren", "plus", "n_dots", "n_spaces", "n_hyphens", "word_before", "word_after", "hint",
    "against", "like_date", "money_after", "spaced_at",
)

#: Planted passages used for fitting and calibration.
SAMPLE = 20_000
TREES, DEPTH = 24, 4
#: Characters of a document on each side of a planted span.
PASSAGE = 80
#: Wanted precision on the held-out part of the sample.
PRECISION = 0.99


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check sum of a string of digits holds."""
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(back, i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    places = F.sequence(F.lit(1), F.char_length(digits))
    total = F.aggregate(places, F.lit(0), add)
    return F.when(F.char_length(digits) == 0, F.lit(False)).otherwise(total % 10 == 0)


def octets(text: Column) -> Column:
    """Whether all dotted parts are at most 255."""

    def small(part: Column) -> Column:
        bare = F.ltrim(part, F.lit("0"))
        short = bare.rlike("^[0-9]{0,3}$")
        return short & (F.when(short & (bare != ""), bare).otherwise(F.lit("0")).cast("int") <= 255)

    return F.forall(F.split(text, "\\."), small)


def is_valid(kind: Column, text: Column) -> Column:
    """The check of a base match."""
    digits = _digits(text)
    n = F.char_length(digits)
    return (
        F.when(kind == 0, F.lit(True))
        .when(kind == 1, octets(text))
        .when(kind == 2, n.between(12, 19) & luhn(digits))
        .otherwise(n.between(9, 15))
    )


def _span_of(column: str, kind: int):
    """The k-th match as a struct; the piece at k starts with it."""

    def span(k: Column) -> Column:
        piece = F.get(column, k)
        text = F.substring_index(piece, CLOSE, 1)
        start = F.get(f"{column}_at", k)
        earlier = F.replace(F.get(column, k - 1), F.lit(CLOSE), F.lit(""))
        return F.struct(
            F.lit(kind).alias("kind"),
            start.alias("s"),
            (start + F.char_length(text)).alias("e"),
            text.alias("t"),
            F.right(earlier, F.lit(CONTEXT)).alias("before"),
            F.left(F.substring_index(piece, CLOSE, -1), F.lit(1)).alias("after"),
        )

    return span


def _with_spans(rows: DataFrame, generators: Sequence[tuple[str, str, str]], name: str) -> DataFrame:
    """Adds ``name``: an array of kind, s, e (end exclusive), t, before, after, in code points."""
    names = [f"{name}{i}" for i in range(len(generators))]
    for column, (_, pattern, needs) in zip(names, generators):
        marked = F.regexp_replace("body", pattern, f"{OPEN}$0{CLOSE}")
        rows = rows.withColumn(column, F.when(F.col("body").rlike(needs), F.split(marked, OPEN)))
    for column in names:
        lengths = F.transform(column, lambda p: F.char_length(F.replace(p, F.lit(CLOSE), F.lit(""))))
        ends = F.aggregate(
            lengths,
            F.array(F.lit(0)),
            lambda sums, n: F.concat(sums, F.array(F.element_at(sums, -1) + n)),
        )
        rows = rows.withColumn(f"{column}_at", F.when(F.size(column) > 1, ends))
    found = []
    for column, (kind, _, _) in zip(names, generators):
        span = _span_of(column, KINDS.index(kind))
        spans = F.transform(F.sequence(F.lit(1), F.size(column) - 1), span)
        none = F.array().cast(
            "array<struct<kind:int,s:int,e:int,t:string,before:string,after:string>>"
        )
        found.append(F.coalesce(F.when(F.col(f"{column}_at").isNotNull(), spans), none))
    rows = rows.withColumn(name, F.concat(*found))
    return rows.drop(*names, *[f"{c}_at" for c in names])


def candidates(docs: DataFrame, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``row`` (the carried columns), ``base`` (valid), ``failed`` and ``loose`` candidates."""
    body = F.replace(F.replace(text_or_empty(text), F.lit(OPEN), F.lit(OTHER)), F.lit(CLOSE), F.lit(OTHER))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), body.alias("body"))
    rows = _with_spans(rows, BASE, "proposed")
    rows = _with_spans(rows, LOOSE, "wide")
    rows = rows.drop("body").withColumn(
        "checked",
        F.transform("proposed", lambda x: x.withField("ok", is_valid(x["kind"], x["t"]))),
    )
    fields = ("kind", "s", "e", "t", "before", "after")
    plain = lambda x: F.struct(*[x[f].alias(f) for f in fields])
    rows = rows.select(
        "row",
        "wide",
        F.array_sort(
            F.transform(F.filter("checked", lambda x: x["ok"]), plain),
            lambda a, b: F.when(a["s"] != b["s"], F.signum(a["s"] - b["s"]).cast("int")).otherwise(
                a["kind"] - b["kind"]
            ),
        ).alias("base"),
        F.transform(F.filter("checked", lambda x: ~x["ok"]), plain).alias("failed"),
    )
    return rows.select(
        "row", "base", "failed",
        F.array_distinct(F.filter("wide", lambda x: ~_among(x, F.col("base")))).alias("loose"),
    )


def _among(x: Column, spans: Column) -> Column:
    same = lambda b: (b["kind"] == x["kind"]) & (b["s"] == x["s"]) & (b["e"] == x["e"])
    return F.exists(spans, same)


def _touches(x: Column, spans: Column) -> Column:
    return F.exists(spans, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))


def features(x: Column) -> list[Column]:
    """The features of a candidate, in the order of FEATURES."""
    text, digits = x["t"], _digits(x["t"])
    groups = F.filter(F.split(text, "[^0-9]+"), lambda g: g != "")
    count = lambda c: F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c)))
    before = F.lower(x["before"])
    hint = reduce(
        lambda a, b: a | b,
        [
            (x["kind"] == k) & before.rlike("|".join(HINTS[kind]))
            for k, kind in enumerate(KINDS)
        ],
    )
    word = "[\\p{L}0-9]"
    values = [
        x["kind"], F.char_length(text), F.char_length(digits), F.size(groups),
        F.coalesce(F.char_length(F.get(groups, F.lit(0))), F.lit(0)),
        F.coalesce(F.char_length(F.element_at(F.concat(F.array(F.lit("")), groups), -1)), F.lit(0)),
        luhn(digits), octets(text) & (count(".") == 3),
        text.contains("@"), text.contains("("), text.startswith("+"),
        count("."), count(" "), count("-"),
        x["before"].rlike(word + "$"), x["after"].rlike("^" + word), hint,
        before.rlike("(?:" + "|".join(AGAINST) + ")[ .:#]{0,3}$"),
        digits.rlike("^(?:19|20)[0-9]{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01])"),
        x["after"].isin("%", "€", "$", "£"),
        text.rlike("@ | @"),
    ]
    return [v.cast("double") for v in values]


def _digits_of(k: int, n: int) -> Column:
    """The k-th drawn number of n digits of a planted passage."""
    return F.lpad(F.pmod(F.xxhash64("h", F.lit(k)), F.lit(10**n)).cast("string"), n, "0")


def _below(k: int, n: int) -> Column:
    return F.pmod(F.xxhash64("h", F.lit(k)), F.lit(n)).cast("string")


def _word(k: int) -> Column:
    names = ["anna", "b.meyer", "li", "j_smith", "office", "support", "maria", "tom.k", "info", "kay"]
    return F.array(*[F.lit(n) for n in names])[F.pmod(F.xxhash64("h", F.lit(k)), F.lit(len(names))).cast("int")]


def _planted_spans() -> list[tuple[str, bool, str, list, str]]:
    """(kind, whether it is personal, what stands before, the pieces of the span, what stands after)."""
    d, o, w = _digits_of, lambda k: _below(k, 256), _word
    short = lambda k: _below(k, 40)
    check = F.concat(F.element_at(
        F.filter(F.array(*[F.lit(str(i)) for i in range(10)]), lambda c: luhn(F.concat(d(40, 15), c))), 1))
    ip = [o(1), ".", o(2), ".", o(3), ".", o(4)]
    long_ = [d(5, 8), d(6, 8)]
    four = lambda sep: [d(5, 4), sep, d(6, 4), sep, d(7, 4), sep, d(8, 4)]
    return [
        ("email", True, "", [w(1), " (at) ", w(2), " (dot) org"], ""),
        ("email", True, "mail ", [w(1), "[at]example[dot]com"], "."),
        ("email", True, "contact: ", [w(1), " @ mail", d(3, 1), ".example.com"], ","),
        ("email", True, "", [w(1), d(3, 2), " @ example.net"], ""),
        ("email", False, "open ", [short(1), " @ ", short(2), ".", d(3, 2)], " each"),
        ("email", False, "meet ", [w(1), " @ ", short(2), ".", d(3, 2)], ""),
        ("ip", True, "", ip, ""),
        ("ip", True, "host ", ip, ","),
        ("ip", False, "version ", [short(1), ".", short(2), ".", d(3, 3), ".", short(4)], ""),
        ("ip", False, "section ", [short(1), ".", short(2), ".", short(3), ".", d(4, 3)], ""),
        ("ip", False, "release ", [d(1, 3), ".", d(2, 3), ".", d(3, 3), ".", d(4, 3)], " of"),
        ("card", True, "", long_, ""),
        ("card", True, "", long_, "!"),
        ("card", True, "", [*long_, " ", d(9, 8), d(10, 8)], ""),
        ("card", True, "card ", long_, "."),
        ("card", True, "", four(" "), ""),
        ("card", True, "visa: ", four("-"), ","),
        ("card", True, "", [d(40, 15), check], ""),
        ("card", False, "order no. ", long_, ""),
        ("card", False, "tracking ", long_, ","),
        ("card", False, "ref: ", four("-"), ""),
        ("card", False, "dated ", ["20", d(1, 2), "1", _below(2, 3), "2", d(3, 1), d(4, 6)], ""),
        ("card", False, "", ["20", d(1, 2), "0", F.concat(F.lit("7")), "1", d(3, 1), d(4, 6)], ""),
        ("card", False, "total ", [d(1, 12)], "€"),
        ("card", False, "isbn ", ["978", d(1, 10)], ""),
        ("card", False, "", [d(1, 9), d(2, 10)], ""),
        ("phone", True, "call ", ["(", d(1, 3), ") ", d(2, 3), "-", d(3, 4)], ""),
        ("phone", True, "tel ", [d(1, 3), "-", d(2, 3), "-", d(3, 4)], "."),
        ("phone", True, "", ["(0", d(1, 2), ") ", d(2, 4), " ", d(3, 4)], ""),
        ("phone", True, "", ["00", d(4, 2), " ", d(1, 3), " ", d(2, 3), " ", d(3, 4)], ""),
        ("phone", False, "sum ", [d(1, 3), " ", d(2, 3), " ", d(3, 3)], "€"),
        ("phone", False, "part ", [d(1, 2), "-", d(2, 4), "-", d(3, 4)], ""),
        ("phone", False, "", ["20", d(1, 2), " ", d(2, 3), " ", d(3, 3)], "%"),
        ("phone", False, "invoice ", [d(1, 4), "-", d(2, 3), "-", d(3, 4)], ""),
    ]


def planted_passages(docs: DataFrame, text: str, size: int, seed: int = 0) -> DataFrame:
    """About ``size`` passages: h, t, and the planted span p (kind, personal, s, e).

    The documents are drawn by a hash; of each one a short stretch at a drawn place is used.
    """
    spans = _planted_spans()
    wanted = -(-size // len(spans))
    body = F.replace(F.replace(text_or_empty(text), F.lit(OPEN), F.lit(OTHER)), F.lit(CLOSE), F.lit(OTHER))
    drawn = docs.select(body.alias("body")).withColumn("h", F.xxhash64(F.lit(seed), "body"))
    place = F.pmod("h", F.greatest(F.lit(1), F.char_length("body") - 2 * PASSAGE)).cast("int")
    cut = lambda at: F.substring("body", place + 1 + at, F.lit(PASSAGE))
    # Digits and signs of the document itself are no part of what is learnt.
    plain = lambda c: F.regexp_replace(c, "[0-9@+(]", "x")
    some = drawn.select("h", plain(cut(0)).alias("left"), plain(cut(PASSAGE)).alias("right"))
    some = freeze(some.orderBy("h").limit(wanted))
    many = max(1, some.count())
    again = F.explode(F.sequence(F.lit(0), F.lit(-(-wanted // many) - 1)))
    some = some.select("left", "right", "h", again.alias("turn")).withColumn("h", F.xxhash64("h", "turn"))
    piece = lambda x: x if isinstance(x, Column) else F.lit(x)
    forms = F.array(
        *[
            F.struct(
                F.lit(i).alias("form"), F.lit(KINDS.index(kind)).alias("kind"), F.lit(personal).alias("personal"),
                F.lit(before).alias("before"), F.concat(*[piece(x) for x in pieces]).alias("span"),
                F.lit(after).alias("after"),
            )
            for i, (kind, personal, before, pieces, after) in enumerate(spans)
        ]
    )
    each = some.select("h", "left", "right", F.explode(forms).alias("f"))
    lead = F.concat(F.rtrim("left"), F.lit(" "), F.col("f.before"))
    start = F.char_length(lead)
    span = F.struct(
        F.col("f.kind").alias("kind"), F.col("f.personal").alias("personal"), start.alias("s"),
        (start + F.char_length("f.span")).alias("e"),
    )
    whole = F.concat(lead, F.col("f.span"), F.col("f.after"), F.lit(" "), F.ltrim("right"))
    return each.select(F.xxhash64("h", "f.form").alias("h"), whole.alias("t"), span.alias("p"))


def labelled_sample(docs: DataFrame, text: str, size: int, seed: int = 0) -> DataFrame:
    """Candidates of planted passages: label, held_out, checked (a valid base match), the features."""
    passages = freeze(planted_passages(docs, text, size, seed))
    found = candidates(passages, "t", ["h", "p"])
    tagged = lambda spans, ok: F.transform(
        spans, lambda x: F.struct(F.lit(ok).alias("checked"), x.alias("x"))
    )
    failed = F.filter("failed", lambda x: ~F.exists("loose", lambda y: (y["s"] == x["s"]) & (y["e"] == x["e"]) & (y["kind"] == x["kind"])))
    every = F.concat(tagged(F.col("base"), True), tagged(F.col("loose"), False), tagged(failed, False))
    each = found.select("row.h", "row.p", F.explode(every).alias("c")).select("h", "p", "c.checked", "c.x")
    x, p = F.col("x"), F.col("p")
    each = each.filter((x["s"] < p["e"]) & (p["s"] < x["e"]))
    same = (x["kind"] == p["kind"]) & (F.abs(x["s"] - p["s"]) <= 1) & (F.abs(x["e"] - p["e"]) <= 1)
    # Of two numbers side by side each one is a span.
    inner = (x["kind"] == 2) & (p["kind"] == 2) & ~x["t"].contains(" ") & ~x["after"].rlike("[0-9]")
    label = F.col("p.personal") & (same | inner)
    return each.select(
        label.cast("double").alias("label"), (F.pmod(F.xxhash64(F.lit(3), "h"), F.lit(4)) == 0).alias("held_out"),
        "checked", *[f.alias(n) for f, n in zip(features(x), FEATURES)],
    )


def _tree(node, values: Sequence[Column]) -> Column:
    """One fitted tree as nested conditions."""
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(float(node.prediction()))
    split = node.split()
    left, right = _tree(node.leftChild(), values), _tree(node.rightChild(), values)
    return F.when(values[split.featureIndex()] <= float(split.threshold()), left).otherwise(right)


class SpanModel:
    """Boosted trees and a threshold for each kind."""

    def __init__(self, trees: list, weights: list[float], thresholds: dict[int, float]):
        self.trees, self.weights, self.thresholds = trees, weights, thresholds

    def margin(self, values: Sequence[Column]) -> Column:
        parts = [F.lit(w) * _tree(t, values) for t, w in zip(self.trees, self.weights)]
        return reduce(lambda a, b: a + b, parts)


def fit(docs: DataFrame, text: str = "text", size: int = SAMPLE, precision: float = PRECISION) -> SpanModel | None:
    """A model fitted on planted passages; None if there are no documents to plant in."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    sample = freeze(labelled_sample(docs, text, size))
    fitting = sample.filter("not held_out")
    counts = {(k, y): n for k, y, n in fitting.groupBy("kind", "label").count().collect()}
    if not any(y == 1 for _, y in counts) or not any(y == 0 for _, y in counts):
        return None
    # Each kind and class weighs the same, so that rare ones are learnt too.
    weights = F.create_map(
        *[F.lit(v) for (k, y), n in counts.items() for v in (f"{k:g} {y:g}", 100.0 / n)]
    )
    name = F.concat_ws(" ", F.col("kind").cast("int"), F.col("label").cast("int"))
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
        fitting.withColumn("weight", weights[name])
    )
    booster = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, maxBins=64, weightCol="weight"
    )
    # The sample is bounded, so it fits one partition.
    fitted = booster.fit(rows.coalesce(1))
    trees = [t._java_obj.rootNode() for t in fitted.trees]
    model = SpanModel(trees, list(fitted.treeWeights), {})
    for kind, pairs in _scored(model, sample.filter("held_out and not checked")).items():
        right, least = 0.0, None
        for n, (score, label) in enumerate(pairs, 1):
            right += label
            last = n == len(pairs) or pairs[n][0] < score
            if last and right >= precision * n:
                least = score
        if least is not None:
            model.thresholds[kind] = max(least, 0.0)
    return model


def _scored(model: SpanModel, sample: DataFrame) -> dict[int, list[tuple[float, float]]]:
    """For each kind the scores and labels of a bounded sample, highest scores first."""
    rows = sample.select(
        F.col("kind").cast("int").alias("kind"), "label",
        model.margin([F.col(n) for n in FEATURES]).alias("score"),
    )
    by_kind: dict[int, list] = {}
    for kind, label, score in rows.collect():
        by_kind.setdefault(kind, []).append((score, label))
    return {kind: sorted(pairs, reverse=True) for kind, pairs in by_kind.items()}


def quality_of(model: SpanModel, docs: DataFrame, text: str = "text", size: int = SAMPLE, seed: int = 1) -> dict[str, tuple[float, float]]:
    """Precision and recall per kind among candidates that the base check leaves out.

    They are measured on passages planted anew, with another seed.
    """
    found = {}
    for kind, pairs in _scored(model, labelled_sample(docs, text, size, seed).filter("not checked")).items():
        least = model.thresholds.get(kind, float("inf"))
        taken = [label for score, label in pairs if score >= least]
        positive = sum(label for _, label in pairs)
        found[KINDS[kind]] = (
            sum(taken) / len(taken) if taken else 1.0, sum(taken) / positive if positive else 1.0
        )
    return found


def find_private(
    docs: DataFrame, text: str = "text", carry: Sequence[str] = ("doc_id",),
    sample: int = SAMPLE, precision: float = PRECISION,
) -> DataFrame:
    """``row``, ``base`` and ``spans`` (base and added), both sorted by start and kind."""
    found = freeze(candidates(docs, text, carry))
    model = fit(docs, text, sample, precision)
    if model is None or not model.thresholds:
        return found.select("row", "base", F.col("base").alias("spans"))
    limits = F.create_map(*[F.lit(v) for kv in model.thresholds.items() for v in kv])
    free = F.filter("loose", lambda x: ~_touches(x, F.col("base")) & (x["e"] > x["s"]))
    rows = found.select("row", "base", free.alias("free"))
    rows = rows.withColumn(
        "valued",
        F.transform(
            "free",
            lambda x: F.struct(
                x.alias("x"), F.struct(*[f.alias(n) for f, n in zip(features(x), FEATURES)]).alias("f")
            ),
        ),
    )
    rows = rows.withColumn(
        "scored",
        F.transform(
            "valued",
            lambda v: v["x"].withField("score", model.margin([v["f"][n] for n in FEATURES])),
        ),
    )
    passing = F.filter(
        "scored", lambda x: x["score"] >= F.coalesce(limits[x["kind"]], F.lit(float("inf")))
    )
    rows = rows.withColumn("passing", passing)

    def best(x: Column) -> Column:
        rank = lambda y: F.struct(y["score"], y["e"] - y["s"], -y["s"], -y["kind"])
        rival = lambda y: (y["s"] < x["e"]) & (x["s"] < y["e"]) & (rank(y) > rank(x))
        return ~F.exists("passing", rival)

    fields = ("kind", "s", "e", "t", "before", "after")
    added = F.transform(
        F.filter("passing", best), lambda x: F.struct(*[x[f].alias(f) for f in fields])
    )
    order = lambda a, b: F.when(
        a["s"] != b["s"], F.signum(a["s"] - b["s"]).cast("int")
    ).otherwise(a["kind"] - b["kind"])
    return rows.select("row", "base", F.array_sort(F.concat("base", added), order).alias("spans"))


def spelled(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"], x["e"])), ","
    )


def redacted(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents with each span replaced by its kind in brackets; a null text stays null."""
    found = find_private(docs, text, carry=docs.columns, **options)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    body = F.col(f"row.`{text}`")

    def step(state: Column, x: Column) -> Column:
        new = F.concat(
            state["out"],
            F.substring(body, state["at"] + 1, x["s"] - state["at"]),
            F.get(names, x["kind"]),
        )
        fresh = x["s"] >= state["at"]
        return F.struct(
            F.when(fresh, x["e"]).otherwise(F.greatest(state["at"], x["e"])).alias("at"),
            F.when(fresh, new).otherwise(state["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(
        "spans", start, step,
        lambda s: F.concat(s["out"], F.substring(body, s["at"] + 1, F.char_length(body))),
    )
    return found.select(
        *[(done if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
    )
