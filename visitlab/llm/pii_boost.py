"""Personal data: rule spans plus boosted trees over the candidates of high-recall generators.

Rules find e-mail addresses, IPv4 addresses, payment cards and international phone numbers.  Generators propose
further, possibly overlapping spans (written-out addresses, national phone numbers, social security, bank account and
IPv6 numbers).  Gradient-boosted trees score each candidate by its format and its context; a candidate counts from
its kind's threshold on, the lowest at which PRECISION of the kind's calibration candidates are right.  Among
overlapping candidates the best score wins, and none may touch a rule span.

Training uses generated lines for every kind, right and wrong, and a bounded sample of documents (MAX_DOCS, at most
PER_DOC candidates of each): rule matches, right or refused, and generator spans behind a harmless cue, which are wrong.
All other generator spans of documents are unlabelled, so what a corpus is full of is not learnt to be harmless.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
MORE = ("x_email", "x_phone", "x_ssn", "x_iban", "x_ip6")
KINDS = BASE + MORE
MAX_DOCS, PER_DOC = 2000, 30
TREES, DEPTH, SHRINK, BINS, LEAF = 60, 3, 0.2, 24, 8
PRECISION = 0.98
SPANS = "doc_id long, spans array<struct<kind: string, start: long, end: long>>"

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_GENERATORS = {
    "x_email": re.compile(r"[A-Za-z0-9._%+-]{2,40}[ ]?(?:\(at\)|\[at\]|\{at\}|<at>)[ ]?[A-Za-z0-9-]{2,40}"
                          r"(?:[ ]?(?:\.|\(dot\)|\[dot\]|\{dot\}|<dot>)[ ]?[A-Za-z0-9-]{2,20})+", re.I),
    "x_phone": re.compile(r"\(?[0-9]{2,4}[)\-./ ]{1,2}[0-9]{3,4}[\-./ ][0-9]{3,4}(?:[\-./ ][0-9]{2,4})?"),
    "x_ssn": re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
    "x_iban": re.compile(r"[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){3,7}(?:[ ]?[A-Z0-9]{1,4})?"),
    "x_ip6": re.compile(r"(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}"),
}
# Words that speak for or against personal data in front of a candidate.
_CUES = {"phone": ("tel", "phone", "call", "fax", "mobile", "cell", "whatsapp", "telefon", "tél"),
         "mail": ("mail", "email", "contact", "write", "reach", "address", "kontakt"),
         "number": ("ssn", "social", "security", "iban", "account", "konto", "bank", "card", "visa"),
         "net": ("ip", "host", "server", "ping", "addr"),
         "harmless": ("order", "invoice", "page", "version", "isbn", "part", "item", "no", "ref", "room", "chapter",
                      "score", "ratio", "serial", "build", "id", "time", "between", "from")}
_HARMLESS = -3  # place of the harmless cue among a candidate's features; the four others stand before it
_WORD = re.compile(r"[^\W\d_]+")


class Tree(NamedTuple):
    feature: np.ndarray  # -1 at a leaf
    cut: np.ndarray  # go right above it
    value: np.ndarray  # nodes in heap order: children of i at 2i + 1 and 2i + 2


class Model(NamedTuple):
    trees: list
    bias: float
    thresholds: dict


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return _NOT_DIGIT.sub("", s)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def rule_matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(kind, start, end, right) of every rule match, leftmost and non-overlapping per kind; wrong ones fail a check."""
    if "@" in text:
        for m in _EMAIL.finditer(text):
            yield 0, m.start(), m.end(), True
    if not any(map(text.__contains__, "0123456789")):
        return
    if "." in text:
        for m in _IP.finditer(text):
            yield 1, m.start(), m.end(), all(map(_small, m.group().split(".")))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            d = _digits(m.group())
            yield 2, m.start(), m.end(), 13 <= len(d) <= 19 and luhn(d)
    if "+" in text:
        for m in _PHONE.finditer(text):
            yield 3, m.start(), m.end(), 9 <= len(_digits(m.group())) <= 15


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    return [(k, s, e) for k, s, e, right in rule_matches(text) if right]


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the generators' spans; they may overlap."""
    out = []
    low = text.lower() if "at" in text or "AT" in text else ""
    if any(x in low for x in ("(at)", "[at]", "{at}", "<at>")):
        out += [(4, m.start(), m.end()) for m in _GENERATORS["x_email"].finditer(text)]
    if any(map(text.__contains__, "0123456789")):
        for k, name in enumerate(MORE):
            if k:
                out += [(4 + k, m.start(), m.end()) for m in _GENERATORS[name].finditer(text)]
    return out


def describe(text: str, kind: int, s: int, e: int) -> list[float]:
    """Format and context of a candidate."""
    body, before, after = text[s:e], text[max(0, s - 40):s], text[e:e + 10]
    digits = _digits(body)
    groups = [len(g) for g in re.split(r"[^0-9A-Za-z]+", body) if g]
    words = _WORD.findall(before.lower())[-4:]
    cues = [float(any(w in v for w in words)) for v in _CUES.values()]
    return [*(float(kind == k) for k in range(len(KINDS))), float(len(body)), float(len(digits)),
            float(sum(map(str.isalpha, body))), float(len(set(digits))), float(len(groups)), float(max(groups, default=0)),
            float(min(groups, default=0)), float(body.count("-")), float(body.count(" ")), float(body.count(".")),
            float(body.count("(")), float(body.count("/")), float(luhn(digits)) if digits else 0.0,
            float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:] in "-./+$#" and before != ""),
            float(after[:1] in "-/%" and after != ""), float(":" in before[-3:]), *cues,
            float(digits[:3] in ("000", "666") or digits[:1] == "9"), float(digits[:1] in ("0", "1"))]


def _grow(x: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, hess: np.ndarray) -> Tree:
    """One tree by exact gain over the binned features."""
    size = 2 ** (DEPTH + 1) - 1
    tree = Tree(np.full(size, -1), np.zeros(size), np.zeros(size))
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        g, h = grad[rows].sum(), hess[rows].sum()
        tree.value[node] = g / (h + 1.0)
        best = (1e-3, None, None)
        if 2 * node + 2 < size and len(rows) >= 2 * LEAF:
            for f, points in enumerate(cuts):
                if len(points) == 0:
                    continue
                at = np.searchsorted(points, x[rows, f], side="left")
                gs = np.cumsum(np.bincount(at, grad[rows], len(points) + 1))[:-1]
                hs = np.cumsum(np.bincount(at, hess[rows], len(points) + 1))[:-1]
                ns = np.cumsum(np.bincount(at, minlength=len(points) + 1))[:-1]
                gain = gs ** 2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g ** 2 / (h + 1)
                gain[(ns < LEAF) | (len(rows) - ns < LEAF)] = 0
                i = int(gain.argmax())
                if gain[i] > best[0]:
                    best = (gain[i], f, points[i])
        if best[1] is not None:
            tree.feature[node], tree.cut[node] = best[1], best[2]
            right = x[rows, best[1]] > best[2]
            todo += [(2 * node + 1, rows[~right]), (2 * node + 2, rows[right])]
    return tree


def _apply(tree: Tree, x: np.ndarray) -> np.ndarray:
    node = np.zeros(len(x), int)
    for _ in range(DEPTH):
        f = tree.feature[node]
        inner = f >= 0
        right = x[np.arange(len(x)), np.maximum(f, 0)] > tree.cut[node]
        node = np.where(inner, 2 * node + 1 + right, node)
    return tree.value[node]


def score(model: Model, x: np.ndarray) -> np.ndarray:
    z = np.full(len(x), model.bias)
    for t in model.trees:
        z += SHRINK * _apply(t, x)
    return 1 / (1 + np.exp(-z))


def fit(x: np.ndarray, y: np.ndarray, kind: np.ndarray, seed: int = 5) -> Model:
    """Boosted trees on 4/5 of the rows; the rest sets each kind's threshold (0.5 at least; none right: above 1)."""
    order = np.random.RandomState(seed).permutation(len(y))
    held, rest = order[:len(y) // 5], order[len(y) // 5:]
    cuts = []
    for f in range(x.shape[1]):
        points = np.unique(np.quantile(x[rest, f], np.linspace(0, 1, BINS)))
        cuts.append(points[:-1])
    mean = np.clip(y[rest].mean(), 0.01, 0.99)
    bias, trees = float(np.log(mean / (1 - mean))), []
    z = np.full(len(rest), bias)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        trees.append(_grow(x[rest], cuts, y[rest] - p, p * (1 - p)))
        z += SHRINK * _apply(trees[-1], x[rest])
    model = Model(trees, bias, {})
    p = score(model, x[held])
    for k in range(len(KINDS)):
        own = np.flatnonzero(kind[held] == k)
        own = own[np.argsort(-p[own], kind="stable")]
        right = np.cumsum(y[held][own])
        good = np.flatnonzero(right >= PRECISION * np.arange(1, len(own) + 1))
        model.thresholds[k] = max(0.5, float(p[own[good[-1]]])) if len(good) and right[good[-1]] else 2.0
    return model


# Contexts of generated candidates.
_RIGHT = {4: ("contact {}", "mail me at {}", "write to {}", "e-mail: {}", "{}"),
          5: ("call {}", "phone: {}", "tel. {}", "fax {}", "mobile {} any time"),
          6: ("ssn {}", "SSN: {}", "social security number {}", "social security: {}", "ssn is {}"),
          7: ("iban {}", "account {}", "pay to bank account {}", "IBAN: {}", "konto {}"),
          8: ("ip {}", "host {}", "server {} is up", "ping {}", "addr: {}")}
_WRONG = ("order {}", "invoice no {}", "part {}", "version {}", "page {}", "score {}", "between {} and", "serial {}", "the {} of",
          "ref {}", "at time {}", "isbn {}")


def generated(count: int = 2000, seed: int = 23) -> list[tuple[list[float], int, int]]:
    """(features, label, kind) of generated candidates, half right and half wrong."""
    rng = np.random.RandomState(seed)

    def word(n: int) -> str:
        return "".join("etaoinshrdlucmfwypbgvkjxqz"[i] for i in np.minimum(rng.randint(0, 40, n), rng.randint(0, 26, n)))

    def name() -> str:
        a, b = word(rng.randint(2, 9)), word(rng.randint(3, 11))
        return (f"{a}.{b}", f"{a}{b}", f"{b}{rng.randint(1, 100)}", f"{a}_{b}", f"{a[0]}.{b}", f"{a}-{b}", b)[rng.randint(0, 7)]

    def host(dot: str) -> str:
        a, b = word(rng.randint(3, 11)), word(rng.randint(3, 7))
        top = ("com", "org", "net", "de", "fr", "info", f"co{dot}uk")[rng.randint(0, 7)]
        return dot.join((f"{a}", f"{a}-{b}", f"{a}{dot}{b}", f"{a}{rng.randint(1, 100)}")[rng.randint(0, 4)].split("|") + [top])

    def number(n: int) -> str:
        return "".join(str(d) for d in rng.randint(0, 10, n))

    out = []
    for i in range(count):
        kind, right = 4 + i % 5, i // 5 % 2 == 0
        space = (" ", "")[rng.randint(0, 2)]
        at, dot = (f"{space}{a}at{z}{space}" for a, z in [("()", "[]", "{}", "<>")[rng.randint(0, 4)]] * 2)
        dot = (dot.replace("at", "dot"), ".")[rng.randint(0, 2)]
        if kind == 4:
            body = f"{name()}{at}{host(dot)}" if right else f"{word(2)}{at}{number(3)}{dot}{number(2)}"
        elif kind == 5:
            body = (f"({rng.randint(201, 989)}) {number(3)}-{number(4)}", f"{rng.randint(201, 989)}-{number(3)}-{number(4)}",
                    f"0{number(3)} {number(3)} {number(4)}")[rng.randint(0, 3)]
            if not right:
                body = (body, f"{number(4)}/{number(4)}/{number(4)}", f"{number(3)} {number(3)} {number(3)}")[rng.randint(0, 3)]
        elif kind == 6:
            body = f"{rng.randint(100, 665)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}"
        elif kind == 7:
            body = f"DE{number(2)} " + " ".join(number(4) for _ in range(4)) + f" {number(2)}"
            if not right:
                body = f"{word(2).upper()}{number(2)}" + "".join(word(4).upper() for _ in range(3))
        else:
            body = ":".join(f"{x:x}" for x in rng.randint(0, 65536, 8))
            if not right:
                body = ":".join(number(2) for _ in range(6))
        lines = _RIGHT[kind] if right else _WRONG
        line = lines[rng.randint(0, len(lines))].format(body)
        text = f"{word(4)} {word(6)}{'. ' if rng.randint(2) else ' '}{line} {word(5)}"
        for k, s, e in candidates(text):
            if k == kind:
                out.append((describe(text, k, s, e), int(right), k))
    return out


def _weak(text: str) -> Iterator[tuple[list[float], int, int]]:
    """Rule matches, right or refused, and generator spans that no rule agrees with and only a harmless cue speaks for."""
    found = list(rule_matches(text))
    rules = [(s, e) for _, s, e, right in found if right]
    for n, (k, s, e, right) in enumerate(found):
        if n >= PER_DOC:
            break
        yield describe(text, k, s, e), int(right), k
    for n, (k, s, e) in enumerate(candidates(text)):
        if n >= PER_DOC:
            break
        x = describe(text, k, s, e)
        if x[_HARMLESS] and not any(x[_HARMLESS - 4:_HARMLESS]) and not any(a < e and s < b for a, b in rules):
            yield x, 0, k


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_docs: int = MAX_DOCS) -> Model:
    """Fit on generated lines and at most max_docs documents, the first by a hash of doc_id."""
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    chosen = ids.orderBy(F.xxhash64("doc_id", F.lit(10)), "doc_id").limit(max_docs)
    sample = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
              .join(F.broadcast(chosen), "doc_id").where("text is not null").orderBy("doc_id", F.xxhash64("text")).limit(max_docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [r for t in b.column("text").to_pylist() for r in _weak(t)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.list_(pa.float64())),
                                              pa.array([r[1] for r in rows], pa.int32()),
                                              pa.array([r[2] for r in rows], pa.int32())], ["x", "y", "kind"])

    rows = sample.mapInArrow(run, "x array<double>, y int, kind int").collect()
    rows = generated() + sorted((list(r[0]), r[1], r[2]) for r in rows)
    return fit(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float), np.array([r[2] for r in rows]))


def spans(text: str | None, model: Model) -> list[tuple[int, int, int]]:
    """(kind, start, end), by kind, then start: the rules' spans and the accepted candidates."""
    if not text:
        return []
    rules = rule_spans(text)
    taken = sorted((s, e) for _, s, e in rules)
    free = [c for c in candidates(text) if not any(a < c[2] and c[1] < b for a, b in taken)]
    out = list(rules)
    if free:
        p = score(model, np.array([describe(text, *c) for c in free]))
        chosen: list[tuple[int, int]] = []
        for i in np.lexsort(([c[1] for c in free], -p)):
            k, s, e = free[i]
            if p[i] >= model.thresholds[k] and not any(a < e and s < b for a, b in chosen):
                chosen.append((s, e))
                out.append((k, s, e))
    return sorted(out)


def find_personal_data(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every row; spans (kind, start, end) by kind, then start, in code points, end exclusive.

    Null and empty texts have no spans; repeated rows are scanned each; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        ([tuple(t) for t in model.trees], model.bias, model.thresholds))
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, bias, thresholds = shared.value
        model = Model([Tree(*t) for t in trees], bias, thresholds)
        for b in batches:
            found = [[{"kind": KINDS[k], "start": s, "end": e} for k, s, e in spans(t, model)]
                     for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(item))], ["doc_id", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SPANS)


def redact(text: str, found: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one mark of the first."""
    out, at = [], 0
    for k, s, e in sorted(found, key=lambda x: (x[1], x[0])):
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].removeprefix('x_').upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]
