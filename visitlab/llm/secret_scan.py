"""Secret scan: rule spans plus a linear-chain conditional random field decoded by Viterbi.

Rules find assignments, access keys and long hex runs.  The field tags tokens as secret begin (B), inside (I) or
outside (O).  Only a token that mixes letters and digits and has 12 characters or more may be B or I, and I must
follow such a token directly (one joining character apart).  Every other token is O for certain, and a certain state
cuts the chain, so decoding each maximal run of such tokens by itself gives the Viterbi path of the whole text.

Features: the token's shape (character classes, length, entropy, known prefixes), the words and marks around it, and
the file (share of symbols, other candidates, assignment marks on the line).  Training uses generated snippets of
common formats and a bounded sample of documents (MAX_DOCS, at most PER_DOC runs of each) labelled by the rules.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlab.llm.textnp import pieces

KINDS = ("assign", "access", "hex", "crf")  # the last is the field's
MAX_DOCS, PER_DOC = 2000, 20
FEATURES = 1 << 12
EPOCHS, STEP, L2 = 10, 0.3, 1e-5
SPANS = "doc_id long, spans array<struct<kind: string, start: long, end: long>>"
MARK = "[SECRET]"

_ASSIGN = re.compile(r'''(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)''', re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # runs are maximal, so a length bound in the pattern equals one after it
_HEX = re.compile(r"[0-9a-f]{16,}")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{12,}={0,2}")
_WORD = re.compile(r"[A-Za-z_]+")
_PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "sk_", "pk_", "sk-", "xox", "eyJ", "AIza", "glpat-")


class Model(NamedTuple):
    emit: np.ndarray  # FEATURES x 3 (O, B, I)
    step: np.ndarray  # 3 x 3, from a tag to the next


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted: the rules' matches, leftmost and non-overlapping per kind."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def _hash(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) % FEATURES


def _shape(token: str) -> list[str]:
    n = len(token)
    digits = sum(c.isdigit() for c in token)
    lower = sum("a" <= c <= "z" for c in token)
    upper = sum("A" <= c <= "Z" for c in token)
    classes = f"{int(digits > 0)}{int(lower > 0)}{int(upper > 0)}{int(n > digits + lower + upper)}"
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(token).values())
    switches = sum(a.isdigit() != b.isdigit() for a, b in zip(token, token[1:], strict=False))
    hexed = all(c in "0123456789abcdefABCDEF" for c in token)
    parts = re.split(r"[-_/+=]", token)
    out = [f"class:{classes}", f"len:{min(n // 6, 9)}", f"ent:{int(entropy * 2)}", f"digits:{10 * digits // n}",
           f"switch:{min(10, 20 * switches // n)}", f"hex:{hexed}", f"parts:{min(len(parts), 6)}",
           f"longest:{min(max(map(len, parts)) // 4, 9)}", f"class-switch:{classes}{min(6, 20 * switches // n)}"]
    return out + [f"prefix:{p}" for p in _PREFIXES if token.startswith(p)]


def runs(text: str) -> Iterator[list[tuple[int, int, list[int]]]]:
    """Maximal runs of candidate tokens, each token as (start, end, features)."""
    if not _DIGIT.search(text):
        return
    found = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
    found = [(s, e) for s, e in found if _DIGIT.search(text, s, e) and _WORD.search(text, s, e)]
    if not found:
        return
    n = len(text)
    file = [f"file-symbols:{min(9, 100 * sum(map(text.count, '{}[]();=<>')) // n)}", f"file-cands:{min(5, len(found))}"]
    open_run: list = []
    for s, e in found:
        before, after = text[max(0, s - 40):s], text[e:e + 20]
        line = before.rpartition("\n")[2]
        words = _WORD.findall(line.lower())
        names = [*_shape(text[s:e]), *file, f"left:{before[-2:]}", f"right:{after[:1]}", f"tight:{before[-1:].isspace()}",
                 f"w1:{words[-1] if words else ''}", f"w2:{words[-2] if len(words) > 1 else ''}",
                 f"next:{(_WORD.findall(after.lower()) or [''])[0]}", f"line-assign:{'=' in line or ':' in line}",
                 "bias"]
        token = (s, e, [_hash(x) for x in names])
        if open_run and s == open_run[-1][1] + 1 and text[s - 1] in ".\n:":
            open_run.append(token)
        else:
            if open_run:
                yield open_run
            open_run = [token]
    yield open_run


def viterbi(emit: np.ndarray, step: np.ndarray) -> list[int]:
    """Best tags of one run that stands between O tokens; I cannot follow O."""
    score = emit[0] + step[0]
    score[2] = -np.inf
    back = []
    for e in emit[1:]:
        ways = score[:, None] + step
        ways[0, 2] = -np.inf
        back.append(ways.argmax(axis=0))
        score = ways.max(axis=0) + e
    tags = [int((score + step[:, 0]).argmax())]
    for b in reversed(back):
        tags.append(int(b[tags[-1]]))
    return tags[::-1]


def _expected(emit: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tag and transition probabilities of one run (forward-backward); the runs' O borders are included."""
    step = step.copy()
    step[0, 2] = -30.0
    n = len(emit)
    fwd, bwd = np.zeros((n, 3)), np.zeros((n, 3))
    fwd[0] = emit[0] + step[0]
    for i in range(1, n):
        fwd[i] = emit[i] + np.logaddexp.reduce(fwd[i - 1][:, None] + step, axis=0)
    bwd[-1] = step[:, 0]
    for i in range(n - 2, -1, -1):
        bwd[i] = np.logaddexp.reduce(step + emit[i + 1] + bwd[i + 1], axis=1)
    z = np.logaddexp.reduce(fwd[-1] + bwd[-1])
    tags, moves = np.exp(fwd + bwd - z), np.zeros((3, 3))
    moves[0] += tags[0]
    moves[:, 0] += tags[-1]
    for i in range(1, n):
        moves += np.exp(fwd[i - 1][:, None] + step + emit[i] + bwd[i] - z)
    return tags, moves


def fit(examples: list[tuple[list[list[int]], list[int]]], seed: int = 3) -> Model:
    """Maximum likelihood with a little L2, by AdaGrad over runs of (features per token, tags)."""
    emit, step = np.zeros((FEATURES, 3)), np.zeros((3, 3))
    ge, gs = np.full((FEATURES, 3), 1e-2), np.full((3, 3), 1e-2)
    rng = np.random.RandomState(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(examples)):
            feats, tags = examples[i]
            scores = np.stack([emit[f].sum(axis=0) for f in feats])
            p, moves = _expected(scores, step)
            p[np.arange(len(tags)), tags] -= 1
            path = [0, *tags, 0]
            for a, b in zip(path, path[1:], strict=False):
                moves[a, b] -= 1
            gs += moves ** 2
            step -= STEP * moves / np.sqrt(gs)
            for f, g in zip(feats, p, strict=True):
                f = np.unique(f)
                g = g + L2 * emit[f]
                ge[f] += g ** 2
                emit[f] -= STEP * g / np.sqrt(ge[f])
    return Model(emit.astype(np.float32), step)


_STRETCH = re.compile(r"[A-Za-z0-9]{12,}")

# Letters, contexts of generated secrets and of harmless tokens that look alike.
_B62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
_SECRET_LINES = ('password = "{}"', "api_key: {}", "export API_TOKEN={}", "client_secret: '{}'", "Authorization: Bearer {}",
                 "aws_secret_access_key = {}", "secret={}", "auth_token: {}", "DB_PASSWORD={}", "private key {}",
                 "access key {}", "set-cookie: session={}", "x-api-key: {}", "the token is {}", "curl -u user:{}")
_HARMLESS_LINES = ("see {}", "file {} was saved", "order {} of", "the {} and", "version {}", "page {} in", "https://example.org/{}",
                   "img src={}", "id {}", "call {} now", "on {} at", "section {} says", "{}", "part no {}", "class={}")


def generated(count: int = 900, seed: int = 11) -> list[tuple[list[list[int]], list[int]]]:
    rng = np.random.RandomState(seed)

    def chars(alphabet: str, n: int) -> str:
        return "".join(alphabet[i] for i in rng.randint(0, len(alphabet), n))

    def word() -> str:
        return chars("etaoinshrdlu", rng.randint(3, 9))

    out = []
    for i in range(count):
        n = int(rng.randint(16, 44))
        if i % 2 == 0:
            body = (chars(_B62, n), chars("0123456789abcdef", n), chars(_B62 + "+/", n), "ghp_" + chars(_B62, 36),
                    "sk_live_" + chars(_B62, 24), "xoxb-" + chars("0123456789", 11) + "-" + chars(_B62, 24),
                    "eyJ" + chars(_B62, 20) + "." + chars(_B62, 40) + "." + chars(_B62, 43))[rng.randint(0, 7)]
            line = _SECRET_LINES[rng.randint(0, len(_SECRET_LINES))]
        else:
            body = (f"{word()}_{word()}_{rng.randint(1, 99)}", f"20{rng.randint(10, 30)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}T10",
                    f"{word()}-{word()}-{rng.randint(1900, 2030)}", f"{word()}/{word()}/{rng.randint(1, 9999)}",
                    f"v{rng.randint(1, 9)}-{word()}-build{rng.randint(100, 999)}", f"{word()}{word()}{rng.randint(1, 99)}",
                    f"{rng.randint(100, 999)}-{rng.randint(100, 999)}-{rng.randint(1000, 9999)}x",
                    f"{word()}{rng.randint(1, 9)}{word()}{word()}")[rng.randint(0, 8)]
            line = _HARMLESS_LINES[rng.randint(0, len(_HARMLESS_LINES))]
        pad = " ".join(word() for _ in range(rng.randint(0, 12)))
        for run in runs(f"{pad}\n{line.format(body)} {word()}"):
            out.append(([t[2] for t in run], [0] * len(run) if i % 2 else [1] + [2] * (len(run) - 1)))
    return out


def _unclear(text: str) -> bool:
    """Whether a stretch of 12 letters and digits or more changes between small, capital and digit as random ones do."""
    for part in _STRETCH.findall(text):
        kinds = [2 if c.isdigit() else int(c.isupper()) for c in part]
        if 10 * sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) >= 3 * (len(part) - 1):
            return True
    return False


def _weak(text: str) -> Iterator[tuple[list[list[int]], list[int]]]:
    """Runs of a document tagged by the rules: assignments and access keys are secrets.  Runs beyond all rules are not, but
    for those of a secret's shape: they stay unlabelled, so secrets that a corpus is full of are not learnt as harmless."""
    rules = rule_spans(text)
    for k, run in enumerate(runs(text)):
        if k >= PER_DOC:
            return
        s, e = run[0][0], run[-1][1]
        met = {kind for a, kind, b in rules if a < e and s < b}
        if met & {0, 1}:
            yield [t[2] for t in run], [1] + [2] * (len(run) - 1)
        elif not met and not _unclear(text[s:e]):
            yield [t[2] for t in run], [0] * len(run)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_docs: int = MAX_DOCS) -> Model:
    """Fit on generated snippets and at most max_docs documents, the first by a hash of doc_id."""
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    chosen = ids.orderBy(F.xxhash64("doc_id", F.lit(2)), "doc_id").limit(max_docs)
    sample = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
              .join(F.broadcast(chosen), "doc_id").where("text is not null").orderBy("doc_id", F.xxhash64("text")).limit(max_docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(x, y) for t in b.column("text").to_pylist() for x, y in _weak(t)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.list_(pa.list_(pa.int32()))),
                                              pa.array([r[1] for r in rows], pa.list_(pa.int32()))], ["feats", "tags"])

    rows = sample.mapInArrow(run, "feats array<array<int>>, tags array<int>").collect()
    weak = sorted(([list(f) for f in r[0]], list(r[1])) for r in rows)
    return fit(generated() + weak)


def spans(text: str | None, model: Model) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted: the rules' spans and those of the field that touch none of them."""
    if not text:
        return []
    rules = rule_spans(text)
    out = list(rules)
    for run in runs(text):
        if any(a < run[-1][1] and run[0][0] < b for a, _, b in rules):
            run = [t for t in run if not any(a < t[1] and t[0] < b for a, _, b in rules)]
            if not run:
                continue
        tags = viterbi(np.stack([model.emit[t[2]].sum(axis=0) for t in run]), model.step)
        start = end = None
        for (s, e, _), tag in zip([*run, (0, 0, None)], [*tags, 0], strict=True):
            if tag != 2 and start is not None:
                out.append((start, 3, end))
                start = None
            if tag == 1:
                start = s
            end = e
    return sorted(out)


def find_secrets(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every row; spans (kind, start, end) by start, then kind, in code points, end exclusive.

    Null and empty texts have no spans; repeated rows are scanned each; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for b in batches:
            found = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans(t, model)]
                     for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(item))], ["doc_id", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SPANS)


def redact(text: str, found: list[tuple[int, int, int]], mark: str = MARK) -> str:
    """The text with every span, overlapping ones joined, replaced by the mark."""
    out, at = [], 0
    for s, _, e in found:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:]


def redact_secrets(docs: DataFrame, model: Model, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """All rows and columns, the text's secrets replaced by a mark and chars_col (if there) brought up to date."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for b in pieces(batches):
            text = [t and redact(t, spans(t, model)) for t in b.column(at).to_pylist()]
            yield b.set_column(at, b.schema.field(at), pa.array(text, b.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    if chars_col not in docs.columns:
        return out
    return out.withColumn(chars_col, F.when(F.col(text_col).isNull(), F.col(chars_col))
                          .otherwise(F.length(text_col)).cast(docs.schema[chars_col].dataType)).select(*docs.columns)


def count_kind(found: str, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def digest(found: Column, base: tuple[str, ...]) -> tuple[Column, Column]:
    """(hex SHA-256 of the base spans, all spans) as kind:start:end strings, comma-joined."""
    def joined(x: Column) -> Column:
        return F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                  s["end"].cast("string"))), ",")
    return F.sha2(joined(F.filter(found, lambda s: s["kind"].isin(*base))), 256), joined(found)
