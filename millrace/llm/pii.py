"""Personal data by fixed patterns and a skip-chain conditional random field.

Nodes are the mentions of a document: places that the patterns find, whose labels
are given, and looser ones (digit groups with other separators, spelled-out
addresses), whose labels are inferred.  Neighbouring mentions share a chain
potential.  Mentions with the same characters once separators, case and country
codes are dropped share a skip potential, however far apart: each is tied to the
next one like it, so a document has at most two edges a mention.  Loopy message
passing gives each mention's label; a looser mention becomes a span if its label is
a kind and a mention like it is given that label, or if the label's share reaches
``ACCEPT`` and the mention passes the kind's check.

Weights are learned by pseudo-likelihood from a bounded sample of documents.  Of the
patterns' own mentions a share is shown as it would be written loosely, alone and
with one like it, so that the model learns what loose forms and their ties say.

Defined results: a null or empty text has no spans; matches that fail a check are
dropped and not retried; equal spans of one kind count once; places are code points,
end exclusive; rows are judged one by one.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import named_again, plain_names

# The kinds in order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
DOMAIN = r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: Documents that the weights are learned from, about.
SAMPLE_ROWS = 20_000
#: Rounds of message passing, at most.
ROUNDS = 10
#: Mentions farther apart aren't neighbours on the chain.
CHAIN_CHARS = 40
#: One in so many of the patterns' mentions is shown in a looser form in learning.
MASKED = 3
#: Least share of a looser mention's label, if the patterns found none like it.
ACCEPT = 0.8

_DOMAIN, _CARD, _PHONE = re.compile(DOMAIN), re.compile(CARD), re.compile(PHONE)
# A match starts where a run of digits does, or nowhere in that run.
_IP = re.compile(r"(?<![0-9])" + IP)
_DIGIT = re.compile(r"[0-9]")
_GAP = r"(?:[\x20.,/:_-]|\)\x20?|\x20?\(|\[\.\]|\x20-\x20)?"
_LOOSE_DIGITS = re.compile(rf"\(?[0-9](?:{_GAP}[0-9])+")
_FOUR = re.compile(r"[0-9]{1,3}(?:(?:\.|\[\.\]|[,_-])[0-9]{1,3}){3}")
_LOOSE_MAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:\[at\]|\(at\))\x20?[A-Za-z0-9-]{1,64}"
    r"(?:\x20?(?:\[dot\]|\(dot\)|\.)\x20?[A-Za-z0-9-]{1,64})+",
    re.I,
)
_LOCAL_PHONE = re.compile(r"(?:1[\x20./-])?(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20./-])[0-9]{3}[\x20./-][0-9]{4}")
_CUES = tuple(
    re.compile(rf"(?:{words})\W*$", re.I)
    for words in ("e-?mail|mail|contact", "ip|host|server|address", "card|visa|credit|payment", "tel|phone|call|fax|mobile")
)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses around each @, from the left; the local part is as long as it can be."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(end, at + 1))


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all that the patterns find, by kind, then start."""
    found = [(0, a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                found.append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                    found.append((3, m.start(), m.end()))
    return found


class Mentions:
    """The mentions of a text in order: places, given labels (0: to be inferred), marks, edges."""

    def __init__(self, text: str, base: list[tuple[int, int, int]]):
        places = [(a, b, kind + 1) for kind, a, b in base]
        places += [(a, b, 0) for a, b in _loose(text, base)]
        places.sort()
        self.places = [(a, b) for a, b, _ in places]
        self.given = np.array([k for _, _, k in places], np.int64)
        self.marks = [_marks(text, a, b) for a, b, _ in places]
        keys = [_key(text[a:b]) for a, b, _ in places]
        self.chain = [(i, i + 1) for i in range(len(places) - 1) if places[i + 1][0] - places[i][1] <= CHAIN_CHARS]
        last: dict[str, int] = {}
        self.skip = []
        # The labels given among the mentions alike.
        self.known: list[set[int]] = []
        groups: dict[str, set[int]] = {}
        for i, key in enumerate(keys):
            self.known.append(groups.setdefault(key, set()))
            self.known[i].add(int(self.given[i]))
            if key in last:
                self.skip.append((last[key], i))
            last[key] = i


def _loose(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    lower = text.lower()
    spelled = "at]" in lower or "at)" in lower
    if not spelled and not _DIGIT.search(text):
        return []
    hidden = list(text)
    for _, a, b in base:
        hidden[a:b] = "\0" * (b - a)
    text = "".join(hidden)
    found = [(m.start(), m.end()) for m in _LOOSE_DIGITS.finditer(text) if len(_DIGIT.findall(m[0])) >= 7 or _FOUR.fullmatch(m[0])]
    if spelled:
        found += [(m.start(), m.end()) for m in _LOOSE_MAIL.finditer(text)]
    return found


def _key(mention: str) -> str:
    if "@" in mention or re.search(r"[\[(]at[\])]", mention, re.I):
        plain = re.sub(r"[\[(]at[\])]", "@", mention.lower())
        return re.sub(r"[^a-z0-9@.]", "", re.sub(r"[\[(]dot[\])]", ".", plain))
    if _FOUR.fullmatch(mention):
        return ".".join(re.findall("[0-9]+", mention))
    digits = "".join(_DIGIT.findall(mention))
    # A number with and without its country code is the same one.
    return digits[-10:] if len(digits) <= 13 else digits


def _marks(text: str, start: int, end: int) -> int:
    """What is seen of a mention, as bits."""
    mention, before = text[start:end], text[max(0, start - 16) : start]
    n = len(_DIGIT.findall(mention))
    seen = [
        "@" in mention,
        bool(re.search(r"[\[(]at[\])]", mention, re.I)),
        mention.startswith("+"),
        "(" in mention,
        bool(_FOUR.fullmatch(mention)),
        n < 9,
        9 <= n <= 12,
        13 <= n <= 19,
        n > 19,
        " " in mention or "-" in mention,
        *[bool(c.search(before)) for c in _CUES],
        13 <= n <= 19 and _luhn("".join(_DIGIT.findall(mention))),
        _octets(mention),
        n == len(mention),
        text[max(0, start - 1) : start].isalnum() or text[end : end + 1].isalnum(),
    ]
    return sum(1 << i for i, x in enumerate(seen) if x)


N_MARKS = 18


def _octets(mention: str) -> bool:
    return bool(_FOUR.fullmatch(mention)) and all(int(x) <= 255 for x in re.findall("[0-9]+", mention))


def _passes(label: int, text: str, start: int, end: int) -> bool:
    """Whether a looser mention may be of a kind without one like it among the patterns' own."""
    mention, before = text[start:end], text[max(0, start - 16) : start]
    digits = "".join(_DIGIT.findall(mention))
    if label == 1:
        return bool(_LOOSE_MAIL.fullmatch(mention))
    if text[max(0, start - 1) : start].isalnum() or text[end : end + 1].isalnum():
        return False
    if label == 2:
        return _octets(mention) and ("[.]" in mention or bool(_CUES[1].search(before)))
    if label == 3:
        return 13 <= len(digits) <= 19 and _luhn(digits)
    # Dates, book and order numbers have as many digits: the groups or a word before must tell.
    return bool(_LOCAL_PHONE.fullmatch(mention)) or 7 <= len(digits) <= 15 and bool(_CUES[3].search(before))


def _loosened(kind: int, mention: str) -> str:
    """A mention of the patterns as it would be written loosely."""
    form = zlib.crc32(mention.encode()) // MASKED % 3
    if kind == 0:
        return mention.replace("@", ("[at]", " [at] ", "(at)")[form])
    if kind == 1:
        return mention.replace(".", ("[.]", ",", "-")[form])
    digits = "".join(_DIGIT.findall(mention))
    if kind == 2:
        return (".", "/", "_")[form].join(digits[i : i + 4] for i in range(0, len(digits), 4))
    area, office, line = digits[-10:-7], digits[-7:-4], digits[-4:]
    return (f"({area}) {office}-{line}", f"{area}.{office}.{line}", f"{area}-{office}-{line}")[form]


def _row(marks: np.ndarray, before: np.ndarray, alike: np.ndarray) -> np.ndarray:
    """Indicator rows: bias, marks, the chain neighbour's label, the label of one alike (5: none)."""
    bits = (marks[:, None] >> np.arange(N_MARKS)) & 1
    eye = np.eye(6)
    return np.concatenate([np.ones((len(marks), 1)), bits, eye[before], eye[alike]], 1)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mentions with the labels around them."""
    for batch in batches:
        rows = []
        for text in batch["text"].to_pylist():
            found = Mentions(text, base_spans(text)) if text else None
            if not found or not found.places:
                continue
            before, alike = [5] * len(found.places), [5] * len(found.places)
            for i, j in found.chain:
                before[j] = int(found.given[i])
            for i, j in found.skip:
                alike[i], alike[j] = int(found.given[j]), int(found.given[i])
            for i, (a, b) in enumerate(found.places):
                label, marks = int(found.given[i]), found.marks[i]
                if label == 0 and alike[i] not in (0, 5):
                    continue  # what this one is, is the question
                if label and zlib.crc32(text[a:b].encode()) % MASKED == 0:
                    loose = _loosened(label - 1, text[a:b])
                    marks_of = _marks(text[max(0, a - 16) : a] + loose + text[b : b + 1], min(a, 16), min(a, 16) + len(loose))
                    rows += [(marks_of, 5, label, label), (marks_of, before[i], 5, label), (marks_of, 5, 5, label)]
                rows.append((marks, before[i], alike[i], label))
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        yield pa.record_batch({n: pa.array(c, pa.int64()) for n, c in zip(("marks", "before", "alike", "label"), columns, strict=True)})


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE_ROWS) -> np.ndarray:
    """Weights (labels x features) by pseudo-likelihood, from about ``sample`` documents.

    The driver gets counts of patterns of marks and labels, of which there are at most
    2 ** 18 * 6 * 6 * 5 whatever the corpus, and a few hundred in fact.
    """
    n = docs.count()
    parts = 1 << 30
    at = F.pmod(F.xxhash64(F.col(doc_id), F.lit(5)), F.lit(parts))
    picked = docs.filter(at < min(parts, parts * sample // max(n, 1))).select(F.col(text).cast("string").alias("text"))
    names = ["marks", "before", "alike", "label"]
    found = picked.mapInArrow(_examples, ", ".join(f"{n} long" for n in names)).groupBy(*names).count()
    rows = np.array(sorted(tuple(r) for r in found.collect()), np.int64).reshape(-1, 5)
    return _fit(rows)


def _fit(rows: np.ndarray, steps: int = 400, decay: float = 1e-3) -> np.ndarray:
    weights = np.zeros((5, 1 + N_MARKS + 12))
    if not len(rows):
        return weights
    x, y = _row(rows[:, 0], rows[:, 1], rows[:, 2]), np.eye(5)[rows[:, 3]]
    share = rows[:, 4] / rows[:, 4].sum()
    for _ in range(steps):
        logits = x @ weights.T
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        weights -= 2.0 * (((p - y) * share[:, None]).T @ x + decay * weights)
    return weights


def marginals(found: Mentions, weights: np.ndarray) -> np.ndarray:
    """Each mention's label distribution, by loopy sum-product message passing."""
    n = len(found.places)
    none = np.full(n, 5)
    bias = _row(np.array(found.marks, np.int64), none, none)
    bias[:, 1 + N_MARKS :] = 0
    unary = bias @ weights.T
    known = found.given > 0
    unary[known] = np.where(np.eye(5)[found.given[known]] > 0, 0.0, -50.0)
    # Potentials by (label of the one, label of the other), relative to no neighbour.
    chain = weights[:, 1 + N_MARKS : 6 + N_MARKS].T - weights[:, 6 + N_MARKS]
    skip = weights[:, 7 + N_MARKS : 12 + N_MARKS].T - weights[:, 12 + N_MARKS]
    skip = (skip + skip.T) / 2
    edges = np.array(found.chain + found.skip, np.int64).reshape(-1, 2)
    table = np.concatenate([np.broadcast_to(chain, (len(found.chain), 5, 5)), np.broadcast_to(skip, (len(found.skip), 5, 5))])
    source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
    table = np.exp(np.concatenate([table, table.transpose(0, 2, 1)]))
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    messages = np.zeros((len(source), 5))
    for _ in range(ROUNDS if len(source) else 0):
        belief = unary.copy()
        np.add.at(belief, target, messages)
        out = belief[source] - messages[back]
        out = np.exp(out - out.max(1, keepdims=True))
        sent = np.log(np.einsum("ei,eij->ej", out, table))
        sent -= sent.max(1, keepdims=True)
        moved = np.abs(sent - messages).max()
        messages = (sent + messages) / 2
        if moved < 1e-4:
            break
    belief = unary.copy()
    np.add.at(belief, target, messages)
    belief = np.exp(belief - belief.max(1, keepdims=True))
    return belief / belief.sum(1, keepdims=True)


def all_spans(text: str | None, weights: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The patterns' spans, and those with what the field adds."""
    if not text:
        return [], []
    base = base_spans(text)
    found = Mentions(text, base)
    if not len(found.given) or found.given.all():
        return base, base
    shares = marginals(found, weights)
    added = []
    for i, (a, b) in enumerate(found.places):
        label = int(shares[i].argmax())
        if found.given[i] or not label:
            continue
        if label in found.known[i] or shares[i, label] >= ACCEPT and _passes(label, text, a, b):
            added.append((label - 1, a, b))
    return base, sorted({*base, *added})


@cache
def _span_type() -> pa.DataType:
    return pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _spans(weights: Callable[[], np.ndarray], text: str, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = weights()
        for batch in batches:
            found = [all_spans(x.as_py(), own) for x in batch[text]]
            made = [
                pa.array([[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in spans] for spans in column], _span_type())
                for column in zip(*found, strict=True)
            ]
            made = made or [pa.array([], _span_type())] * 2
            yield pa.record_batch([batch[n] for n in names] + made, [*names, "base", "spans"])

    return run


def find(docs: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """Add ``base`` and ``spans``, arrays of (kind, start, end), to each row."""
    plain, names = plain_names(docs)
    plain = plain.withColumn(names[text], F.col(names[text]).cast("string"))
    held = plain.sparkSession.sparkContext.broadcast(weights)
    kind = "array<struct<kind: string, start: int, end: int>>"
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields] + [f"base {kind}", f"spans {kind}"])
    found = plain.mapInArrow(_spans(lambda: held.value, names[text], plain.columns), schema)
    return named_again(found, names, base="base", spans="spans")
