"""Secrets: strong matches by themselves, weak ones where the parts of a credential stand together.

Base matches (assignments, access identifiers, hexadecimal strings) that pass their check are always
kept. A credential often has several parts that say little alone: an *identifier* (who), a *secret*
(proof) and an *endpoint* (where). Generators propose such parts with much recall: labelled names and
numbers, labelled or opaque strings, short matches that failed a base check, addresses, and the parts
of addresses that carry a user and a password. Base matches count as parts too.

Linking is an interval join inside a text. A scope is a paragraph, the lines between two blank ones.
Two parts are linked if they lie in one scope, at most ``reach`` code points apart and do not
overlap; parts of each role are kept sorted, so each part looks up its neighbours by bisection. A
weak candidate is reported only with complementary parts:

* an identifier with a secret;
* a labelled secret with an identifier or an endpoint, an opaque one with an identifier;
* an endpoint with both an identifier and a secret.

Parts that other weak parts lean on must hold themselves, so the rule is applied until nothing
changes. Reported parts that touch a base match add nothing and are left out; of overlapping ones
the first, then the longest, stays.

Cases: a null or empty text has no spans; rows are independent, so null ids, ties and equal rows need
no rule and give one row each; columns of the input come back only inside ``row``, by ``carry``, so
no name clashes; an empty table gives an empty table. Patterns enter a run of characters once, so a
long text costs linear time, and memory grows with the longest text and its number of parts.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from math import log2
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import text_or_empty

KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
ASSIGN, ACCESS, HEX, IDENTIFIER, SECRET, ENDPOINT = range(6)
#: Code points between linked parts at most.
REACH = 240
#: Bits per character that an opaque string has at least.
ENTROPY = 3.5

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")

#: What stands between a label and its value.
_IS = r"""["']?[\x20\t]{0,8}(?:[:=]|=>|->)[\x20\t]{0,8}["'<]?"""
_IS_SAID = _IS.replace("->", r"->|\bis\b")
_IDENTIFIER = re.compile(
    r"(?<![A-Za-z0-9])(?:(?:access|client|account|app|application|tenant|project|service|key|user|login|consumer)"
    rf"(?:[_\x20-]?(?:key[_\x20-]?)?(?:id|name|identifier))|username|user|login){_IS}([A-Za-z0-9][A-Za-z0-9_.@+-]{{2,127}})",
    re.IGNORECASE | re.ASCII,
)
#: Key names by their prefix; one digit at least.
_PREFIXES = ("AKIA", "ASIA", "AIDA", "AROA", "AGPA")
_KEY_NAME = re.compile(
    rf"(?<![A-Za-z0-9])(?=[A-Z]{{4,20}}[0-9])(?:{'|'.join(_PREFIXES)})[A-Z0-9]{{8,124}}(?![A-Za-z0-9])"
)
_LABELLED = re.compile(
    r"(?<![A-Za-z0-9])(?:pwd|pass|passphrase|passcode|pin|credentials?|auth|authorization|bearer|private[_\x20-]?key"
    rf"|(?:secret|shared|account|access|signing|encryption)[_\x20-](?:access[_\x20-])?key){_IS_SAID}"
    r"(?:bearer[\x20])?([A-Za-z0-9+/_.!@#$%^&*=~-]{4,512})",
    re.IGNORECASE | re.ASCII,
)
_OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,512}={0,2}(?![A-Za-z0-9+/_=-])", re.ASCII)
#: scheme://user:password@host, or an address without them; or a labelled host.
_ADDRESS = re.compile(
    r"(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]{1,31}://(?:([^\s:/@\"'<>]{1,256}):([^\s/@\"'<>]{1,256})@)?"
    r"([A-Za-z0-9][A-Za-z0-9.-]{0,254}(?::[0-9]{1,5})?[^\s\"'<>,;]{0,1024})",
    re.ASCII,
)
_HOST = re.compile(
    rf"(?<![A-Za-z0-9])(?:host|hostname|server|endpoint|base[_\x20-]?url|data[\x20_]?source|bucket|region){_IS}"
    r"([A-Za-z0-9][A-Za-z0-9.-]{2,254}(?::[0-9]{1,5})?)",
    re.IGNORECASE | re.ASCII,
)
_BLANK = re.compile(r"\n[\x20\t\r]*\n")


class Part(NamedTuple):
    start: int
    end: int
    #: IDENTIFIER, SECRET or ENDPOINT.
    role: int
    #: Whether it is a base match, and whether a label names it.
    strong: bool
    labelled: bool


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches that pass their check, sorted."""
    found = [(m.start(), ASSIGN, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), ACCESS, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), HEX, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def entropy(value: str) -> float:
    """Bits per character of the letters as they are distributed in the string itself."""
    n = len(value)
    return -sum(c / n * log2(c / n) for c in Counter(value).values())


def _is_opaque(value: str) -> bool:
    classes = (any(map(str.islower, value)), any(map(str.isupper, value)), any(map(str.isdigit, value)))
    return sum(classes) >= 2 and classes[2] and entropy(value) >= ENTROPY


def parts_of(text: str, base: list[tuple[int, int, int]]) -> list[Part]:
    """All parts of credentials in a text, strong and weak, sorted."""
    strong = [
        Part(start, end, IDENTIFIER if kind == ACCESS else SECRET, True, True) for start, kind, end in base
    ]
    weak = set()
    add = lambda m, group, role, labelled: weak.add(
        Part(m.start(group), m.end(group), role, False, labelled)
    )
    if any(p in text for p in _PREFIXES):
        for m in _KEY_NAME.finditer(text):
            add(m, 0, IDENTIFIER, True)
    signs = ":" in text or "=" in text or "->" in text
    if signs:
        for m in _IDENTIFIER.finditer(text):
            add(m, 1, IDENTIFIER, True)
        for m in _HOST.finditer(text):
            add(m, 1, ENDPOINT, True)
    if "://" in text:
        for m in _ADDRESS.finditer(text):
            if m[1] is not None:
                add(m, 1, IDENTIFIER, True)
                add(m, 2, SECRET, True)
            add(m, 3, ENDPOINT, False)
    if not weak and not any(p.role == IDENTIFIER for p in strong):
        return strong  # secrets alone hold nothing up
    for m in _LABELLED.finditer(text):
        add(m, 1, SECRET, True)
    for m in _ASSIGN.finditer(text):
        if m.end(2) - m.start(2) < 6:
            add(m, 2, SECRET, True)
    for m in _OPAQUE.finditer(text):
        if _is_opaque(m[0]):
            add(m, 0, SECRET, False)
    # A weak part that touches a strong one says nothing new.
    starts, ends = _union(base)
    for p in weak:
        before = bisect_left(starts, p.end) - 1
        if before < 0 or ends[before] <= p.start:
            strong.append(p)
    return sorted(strong)


def _union(spans: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that sorted spans cover."""
    starts: list[int] = []
    ends: list[int] = []
    for start, _, end in spans:
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def linked(text: str, parts: list[Part], reach: int = REACH) -> list[Part]:
    """The weak parts that complementary parts hold up."""
    if all(p.strong for p in parts):
        return []
    borders = [m.start() for m in _BLANK.finditer(text)]
    scope = lambda p: bisect_left(borders, p.start)
    alive = list(parts)
    while True:
        roles: dict[int, list[Part]] = {IDENTIFIER: [], SECRET: [], ENDPOINT: []}
        for p in alive:
            roles[p.role].append(p)
        # Running greatest ends, so that bisection holds where parts of a role overlap.
        ends = {role: _running_ends(of) for role, of in roles.items()}

        def near(p: Part, role: int, roles=roles, ends=ends) -> bool:
            of = roles[role]
            for k in range(bisect_left(ends[role], p.start - reach), len(of)):
                y = of[k]
                if y.start > p.end + reach:
                    return False
                apart = y.end <= p.start or p.end <= y.start
                if apart and y.end >= p.start - reach and scope(y) == scope(p):
                    return True
            return False

        def held(p: Part, near=near) -> bool:
            if p.strong:
                return True
            if p.role == IDENTIFIER:
                return near(p, SECRET)
            if p.role == SECRET:
                return near(p, IDENTIFIER) or (p.labelled and near(p, ENDPOINT))
            # An address is not needed to hold up others, so it must not vanish before them.
            return near(p, IDENTIFIER) or near(p, SECRET)

        kept = [p for p in alive if held(p)]
        if len(kept) == len(alive):
            return [
                p for p in alive
                if not p.strong and (p.role != ENDPOINT or (near(p, IDENTIFIER) and near(p, SECRET)))
            ]
        alive = kept


def _running_ends(parts: list[Part]) -> list[int]:
    out, most = [], 0
    for p in parts:
        most = max(most, p.end)
        out.append(most)
    return out


def spans_of(text: str, reach: int = REACH) -> tuple[list[tuple], list[tuple]]:
    """(start, kind, end): the base spans, and all spans; both sorted by start, then kind."""
    base = base_spans(text)
    free, last = [], 0
    for p in sorted(linked(text, parts_of(text, base), reach), key=lambda p: (p.start, -p.end, p.role)):
        if p.start >= last:
            free.append((p.start, p.role, p.end))
            last = p.end
    return base, sorted(base + free)


def masked(text: str, spans: list[tuple]) -> str:
    """The text with what spans cover replaced by their kinds in brackets."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def find_secrets(
    docs: DataFrame, text: str = "text", carry: Sequence[str] = ("doc_id",), reach: int = REACH
) -> DataFrame:
    """``row`` (the carried columns), ``base`` and ``spans`` (kind, start, end) and ``redacted``.

    ``redacted`` is the text without its spans, null where there are none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases, every, clean = [], [], []
            for body in batch.column(1).to_pylist():
                base, spans = spans_of(body, reach)
                bases.append([(KINDS[k], s, e) for s, k, e in base])
                every.append([(KINDS[k], s, e) for s, k, e in spans])
                clean.append(masked(body, spans) if spans else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _span_lists(bases), _span_lists(every), pa.array(clean, pa.string())],
                ["row", "base", "spans", "redacted"],
            )

    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), text_or_empty(text).alias("body")
    )
    spans = T.ArrayType(
        T.StructType(
            [T.StructField("kind", T.StringType())]
            + [T.StructField(n, T.LongType()) for n in ("start", "end")]
        )
    )
    schema = T.StructType(
        [
            rows.schema["row"], T.StructField("base", spans), T.StructField("spans", spans),
            T.StructField("redacted", T.StringType()),
        ]
    )
    return rows.mapInArrow(run, schema)


def _span_lists(lists: list[list[tuple]]) -> pa.Array:
    return pa.array([[dict(zip(("kind", "start", "end"), x)) for x in l] for l in lists], pa.list_(_SPAN))


def without_secrets(docs: DataFrame, text: str = "text", reach: int = REACH) -> DataFrame:
    """The documents with each span replaced by its kind in brackets; a null text stays null."""
    found = find_secrets(docs, text, docs.columns, reach)
    body = F.coalesce("redacted", F.col(f"row.`{text}`"))
    return found.select(*[(body if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def spelled(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
