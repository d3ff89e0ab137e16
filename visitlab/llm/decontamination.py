"""Benchmark decontamination by pigeonhole edit matching.

Texts are normalised (lower case, every run of other than letters and digits becomes one space).  A test item of m
characters allows k = floor(rate * m) edits and is cut into k + 1 pieces: k edits leave one piece intact, so each
match has an exact piece hit.  Piece hits come from an Aho-Corasick automaton run over whole texts; each hit gives a
window, and Myers' bit-parallel distance verifies it.  Nothing is shuffled.  Items under MIN_CHARS allow no edit and
have to stand between word borders.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlab.llm.textnp import pieces as pieces_of

RATE = 0.08  # edits per character of an item
MIN_CHARS = 20  # shorter items (normalised) match word for word only
BLOCK_CHARS = 8_000_000  # item text on the driver, and in one automaton, at a time
MATCHES = "doc_id long, item_id long, start long, end long, distance long"

_ASCII = bytes(c if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in range(256))
_OTHER = re.compile(r"[^\w\x00-\x7f]")
_TOKEN = re.compile(r"[^\W_]+")


def normalise(text: str) -> str:
    text = text.lower()
    if not text.isascii():
        text = _OTHER.sub(" ", text)
    return b" ".join(text.encode("utf-8", "replace").translate(_ASCII).split()).decode()


def _origin(text: str) -> list[tuple[int, int, int]]:
    """(place in the normalised text, start, end) of each token of the text."""
    out, at = [], 0
    for m in _TOKEN.finditer(text):
        out.append((at, m.start(), m.end()))
        at += len(normalise(m.group())) + 1
    return out


def myers(pattern: str, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to any substring of the text, and that substring's first end."""
    m = len(pattern)
    mask, high = (1 << m) - 1, 1 << (m - 1)
    eq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        eq[c] = eq.get(c, 0) | 1 << i
    pv, mv, score, best, end = mask, 0, m, m, 0
    for j, c in enumerate(text, 1):
        e = eq.get(c, 0)
        xv = e | mv
        xh = (((e & pv) + pv) ^ pv) | e
        ph, mh = mv | ~(xh | pv) & mask, pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        if score < best:
            best, end = score, j
        ph, mh = ph << 1 & mask, mh << 1 & mask
        pv, mv = mh | ~(xv | ph) & mask, ph & xv
    return best, end


def _edits(item: str, rate: float, min_chars: int) -> int:
    return int(rate * len(item)) if len(item) >= min_chars else 0


def pieces(item: str, k: int) -> list[tuple[str, int]]:
    n = len(item)
    return [(item[n * j // (k + 1):n * (j + 1) // (k + 1)], n * j // (k + 1)) for j in range(k + 1)]


def _automaton(items: list[tuple[int, str]], rate: float, min_chars: int = MIN_CHARS) -> ahocorasick.Automaton:
    found: dict[str, list[tuple[int, int]]] = {}
    for i, (_, text) in enumerate(items):
        for piece, at in pieces(text, _edits(text, rate, min_chars)):
            found.setdefault(piece, []).append((i, at))
    a = ahocorasick.Automaton()
    for piece, owners in found.items():
        a.add_word(piece, (len(piece), owners))
    a.make_automaton()
    return a


def _windows(text: str, a: ahocorasick.Automaton, items: list[tuple[int, str]], rate: float,
             min_chars: int = MIN_CHARS) -> Iterator[tuple[int, int, int]]:
    """(item, from, to): the windows of an item's hits, those that overlap joined."""
    starts: dict[int, set[int]] = {}
    for last, (length, owners) in a.iter(text):
        whole = text[last - length:last - length + 1] in ("", " ") and text[last + 1:last + 2] in ("", " ")
        for i, at in owners:
            if not whole and len(items[i][1]) < min_chars:
                continue
            starts.setdefault(i, set()).add(last - length + 1 - at)
    for i, found in starts.items():
        m = len(items[i][1])
        k = _edits(items[i][1], rate, min_chars)
        lo = hi = None
        for s in sorted(found):
            if hi is not None and s - k <= hi:
                hi = s + m + k
                continue
            if hi is not None:
                yield i, lo, hi
            lo, hi = s - k, s + m + k
        yield i, lo, hi


def find(text: str | None, a, items: list[tuple[int, str]], rate: float, min_chars: int = MIN_CHARS
         ) -> list[tuple[int, int, int, int]]:
    """(item_id, start, end, distance): the best match of each item within its error budget, in code points of text."""
    plain = normalise(text or "")
    best: dict[int, tuple[int, int, int]] = {}
    for i, lo, hi in _windows(plain, a, items, rate, min_chars):
        item_id, item = items[i]
        lo = max(0, lo)
        d, end = myers(item, plain[lo:hi])
        if d <= _edits(item, rate, min_chars) and (i not in best or d < best[i][0]):
            # the start: the reversed item against the text before the end
            back = myers(item[::-1], plain[lo:lo + end][::-1])[1]
            best[i] = (d, lo + end - back, lo + end)
    if not best:
        return []
    tokens, out = _origin(text), []
    for i, (d, s, e) in sorted(best.items()):
        inside = [t for t in tokens if t[0] < e and t[0] + (t[2] - t[1]) > s]
        out.append((items[i][0], inside[0][1] if inside else 0, inside[-1][2] if inside else 0, d))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", rate: float = RATE,
                 min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Matches (doc_id, item_id, start, end, distance), one row per document and item in it.

    start and end are code points of the original text, widened to whole tokens.  Null or empty texts match nothing;
    items under min_chars match word for word; items without an id or a text are left out; equal items each report; a
    repeated document row reports again.  The benchmark is taken in blocks of at most block_chars of text (a longer single item is its own block),
    so the driver and the tasks hold a bounded part whatever its size; every block is run against all documents.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for items in _blocks(benchmark, item_col, item_text_col, block_chars, True):
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            a = _automaton(items, rate, min_chars)
            for b in batches:
                rows = [(doc_id, *m) for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                                             strict=True)
                        if text for m in find(text, a, items, rate, min_chars)]
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                                 ["doc_id", "item_id", "start", "end", "distance"])

        found = docs.mapInArrow(run, MATCHES)
        out = found if out is None else out.union(found)
    return out if out is not None else spark.createDataFrame([], MATCHES)


def _blocks(benchmark: DataFrame, item_col: str, item_text_col: str, block_chars: int, named: bool
            ) -> Iterator[list[tuple[int, str]]]:
    """Normalised items (id, text), a bounded part of the benchmark at a time; named: only those with an id."""
    bench = (benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
             .where("text is not null and item_id is not null" if named else "text is not null"))
    total = bench.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-2 * total // block_chars)  # half full on average, as hashing is uneven
    for block in range(max(1, blocks)):
        own = bench if blocks <= 1 else bench.where(
            F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        items = [(r[0], normalise(r[1])) for r in own.collect()]
        items = sorted({x for x in items if x[1]}, key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        if items:
            yield items


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", rate: float = RATE, min_chars: int = MIN_CHARS,
                  block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows whose text holds no item, all columns as they came: a filter, without a shuffle or a need for ids.

    Neither the rows nor the items need an id; items under min_chars match word for word.
    """
    at = docs.columns.index(text_col)
    for items in _blocks(benchmark, item_col, item_text_col, block_chars, False):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            a = _automaton(items, rate, min_chars)
            for b in pieces_of(batches):
                yield b.filter(pa.array([not (t and find(t, a, items, rate, min_chars))
                                         for t in b.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
