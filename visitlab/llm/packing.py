"""Cost-balanced packing of tokenised documents into training sequences.

A document is its ids by a vocabulary file of the ``tokenizers`` library, then one end id.  Its cost in a sequence is
estimated as linear plus quadratic (attention) work, and descending documents go to the sequence of lowest cost that has
room for them.  Sequences hold exactly as many ids as all documents together: as many full sequences as these fill, and
for the rest one sequence per power of two in it, so no sequence needs padding.

How that runs on any number of documents:

* One scan encodes the documents and stores their ids.  Runs of a full sequence leave a document first; only its tail,
  shorter than a sequence, has to be placed, and tails of equal length are alike.
* So the greedy assignment works on the histogram of tail lengths (at most ``capacity`` numbers) with groups of equal
  sequences, on the driver: its effort depends on the sequence length, not on the corpus.  It is the assignment that
  going through all documents one by one, longest first, would make.
* It says which ranks among the tails of a length go where.  A tail's rank is its place within its input partition plus
  the count of that length in earlier partitions, one small join; nothing else is shuffled.

A tail for which no sequence has room left is cut at the largest room, and its rest is placed as a shorter one.

Defined results: null or empty text: the end id alone.  Repeated rows are documents of their own, a null id is carried.
An empty table gives no rows.  Special tokens' strings inside a text are ordinary text.  Ties among costs go to the
earliest sequence.  Reruns over the same input partitions agree; another partitioning may swap tails of equal length.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlab.llm.scratch import store
from visitlab.llm.textnp import small

#: Offsets up to this many rows (three numbers each) are broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 1_000_000
# Fixed value: the pattern by which byte-level vocabularies split texts.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPACE = ("[\\x{09}-\\x{0d}\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}"
          "\\x{3000}]")  # white space of any kind
_MEMO = 600_000  # pieces whose ids an encoder keeps
_ROWS = 500  # texts whose ids are gathered together
_SLICE = 8 << 20  # bytes of text encoded together
_FULL = 1 << 40  # ids of sequences that one document fills lie above this, by partition


@dataclass(frozen=True)
class Cost:
    """Work of a run of ``n`` ids that attend to each other only: ``6 * width * n + n * n`` (whole numbers, so sums of
    equal runs are equal)."""

    width: int = 1024

    def __call__(self, n: int) -> int:
        return 6 * self.width * n + n * n


class Encoder:
    """Ids of whole texts.

    With a byte-level vocabulary that splits texts by its own pattern and normalises nothing, no split piece goes over a
    space that follows a character other than white space.  So texts are cut there, each different piece of a batch is
    encoded once, and the ids are gathered.  If such a vocabulary's merges are in the order of their ids, merging by rank
    is the same as merging by that list, and ``tiktoken`` does it for many pieces at once, several times faster than
    ``tokenizers`` and with its ids.  Texts with other white space before a space, and all texts with other vocabularies,
    are encoded whole.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        made = json.loads(vocabulary)
        pre, model = made.get("pre_tokenizer") or {}, made["model"]
        self.by_piece = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                         and not made.get("normalizer") and model["type"] == "BPE" and not model.get("dropout"))
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = True
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.ranks = _by_rank(model["vocab"], model["merges"]) if self.by_piece else None
        self._forget()

    def _forget(self) -> None:
        """Slots of pieces: where their ids are in the pool.  Slot 0 is empty."""
        self.slots: dict[str, int] = {}
        self.pool, self.sizes = np.zeros(0, self.dtype), np.zeros(1, np.int64)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, each with a space before it, and how many each has."""
        if self.ranks is None:
            found = [self.whole(" " + p) for p in pieces]
            return np.concatenate([*found, self.pool[:0]]), np.array([len(f) for f in found], np.int64)
        simple = ~np.asarray(pc.match_substring_regex(pa.array(pieces, pa.string()), _SPACE))
        sizes, other = np.zeros(len(pieces), np.int64), []
        for i in np.flatnonzero(~simple).tolist():
            other.append(np.array(self.ranks.encode_ordinary(" " + pieces[i]), self.dtype))
            sizes[i] = len(other[-1])
        # A line end between simple pieces is a piece of its own.
        joined = "\n".join([" " + p for p, s in zip(pieces, simple.tolist(), strict=True) if s])
        ids = self.ranks.encode_to_numpy(joined, disallowed_special=()).astype(self.dtype)
        mark = ids == self.ranks.encode_ordinary("\n")[0]
        if simple.any():
            sizes[simple] = np.diff(np.append(np.flatnonzero(mark), len(ids)), prepend=-1) - 1
        out = np.zeros(int(sizes.sum()), self.dtype)
        own = np.repeat(simple, sizes)
        out[own], out[~own] = ids[~mark], np.concatenate([*other, out[:0]])
        return out, sizes

    def _known(self, pieces: list[str]) -> np.ndarray:
        """The pieces' slots, after encoding those that have none."""
        get = self.slots.get
        found = np.fromiter((get(p, -1) for p in pieces), np.int64, len(pieces))
        new = np.flatnonzero(found < 0)
        if len(self.slots) + len(new) > _MEMO:
            self._forget()
            new = np.arange(len(pieces))
        if len(new):
            names = [pieces[i] for i in new.tolist()]
            ids, sizes = self._pieces(names)
            found[new] = len(self.sizes) + np.arange(len(new))
            self.slots.update(zip(names, found[new].tolist(), strict=True))
            self.pool, self.sizes = np.concatenate([self.pool, ids]), np.concatenate([self.sizes, sizes])
        return found

    def __call__(self, column: pa.Array) -> list[bytes]:
        """Each text's ids, as bytes of ``dtype``."""
        texts = pc.fill_null(column, "")
        if not self.by_piece or not len(texts):
            return [self.whole(t).tobytes() for t in texts.to_pylist()]
        cut = pc.split_pattern(texts.cast(pa.large_string()), " ")
        at = np.asarray(cut.offsets).astype(np.int64)
        at -= at[0]
        first, last = at[:-1], at[1:] - 1
        pieces = cut.flatten().dictionary_encode()
        index, names = pieces.indices.to_numpy(), pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        open_end = np.array([not p or p[-1].isspace() for p in names], bool)[index]
        open_end[last] = False
        at_once = np.add.reduceat(open_end, first) > 0
        slot = self._known(names)[index]
        # A row's first piece has no space before it, or its text is encoded whole.
        own = [self.whole(texts[i].as_py() if w else names[k])
               for i, (w, k) in enumerate(zip(at_once.tolist(), index[first].tolist(), strict=True))]
        slot[first] = 0
        slot[np.repeat(at_once, np.diff(at))] = 0
        starts, out = np.cumsum(self.sizes) - self.sizes, []
        for a in range(0, len(own), _ROWS):
            z = min(a + _ROWS, len(own))
            s = slot[at[a]:at[z]]
            n = self.sizes[s]
            ends = np.cumsum(n)
            ids = self.pool[np.repeat(starts[s] - ends + n, n) + np.arange(int(n.sum()))].tobytes()
            to = (ends[last[a:z] - at[a]] * self.dtype.itemsize).tolist()
            out += [x.tobytes() + ids[i:j] for x, i, j in zip(own[a:z], [0, *to], to, strict=False)]
        return out


def _by_rank(vocab: dict[str, int], merges: list):
    """An encoder by rank for a byte-level vocabulary, None if its merges are not in the order of their ids."""
    import tiktoken

    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves
    rest = [b for b in range(256) if b not in shown]  # the others are written from U+0100 on
    byte = {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(rest)}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
    if sorted(vocab.get(c, -1) for c in byte) != list(range(256)) or any(
            vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)):
        return None
    names = [*byte, *(a + b for a, b in pairs)]
    ranks = {bytes(byte[c] for c in name): vocab[name] for name in names}
    return tiktoken.Encoding("by_rank", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """(id, ids binary, n_tokens, part, tail, place, full_at): each document's ids, its tail's length and place among
    equal tails of its partition, and the number of full runs before it there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        end = np.array([end_id], encoder.dtype).tobytes()
        part = TaskContext.get().partitionId()
        seen, full = np.zeros(capacity, np.int64), 0
        for b in small(batches, "text", _SLICE):
            ids = [x + end for x in encoder(b.column("text"))]
            n = np.array([len(x) // encoder.dtype.itemsize for x in ids], np.int64)
            place, full_at = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            for i, k in enumerate(n.tolist()):
                place[i], full_at[i] = seen[k % capacity], full
                seen[k % capacity] += 1
                full += k // capacity
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(ids, pa.binary()), pa.array(n), pa.array(np.full(len(n), part, np.int32)),
                 pa.array((n % capacity).astype(np.int32)), pa.array(place), pa.array(full_at)],
                ["id", "ids", "n_tokens", "part", "tail", "place", "full_at"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids binary, n_tokens long, part int, tail int, place long, full_at long")


def assign(tails: dict[int, int], capacity: int, cost=Cost()) -> np.ndarray:
    """Where tails go: rows (level, tail, rank, count, start, length, sequence, offset).

    The row takes ``length`` ids from ``start`` of the tails of that length with ranks ``rank`` to ``rank + count`` to as
    many sequences from ``sequence`` on, each at ``offset``.  Level 0 is a tail's first run, 1 the next after a cut.
    """
    total = sum(n * c for n, c in tails.items())
    heap: list = []  # groups of equal sequences by (cost, first sequence): (cost, first, how many, room, used)
    full = total // capacity
    if full:
        heap.append((0, 0, full, capacity, 0))
    first = full
    for bit in reversed(range(capacity.bit_length())):
        if (total - full * capacity) >> bit & 1:
            heapq.heappush(heap, (0, first, 1, 1 << bit, 0))
            first += 1
    short: list = []  # groups without room for the tails in turn, by largest room
    items = [(-n, 0, n, 0, c, 0) for n, c in tails.items() if n and c]  # (-length, level, tail, rank, count, start)
    heapq.heapify(items)
    out = []
    while items:
        size, level, tail, rank, count, start = heapq.heappop(items)
        size = -size
        while short and -short[0][0] >= size:
            heapq.heappush(heap, heapq.heappop(short)[1])
        while heap and heap[0][3] < size:
            g = heapq.heappop(heap)
            heapq.heappush(short, (-g[3], g))
        spent, at, many, room, used = heapq.heappop(heap) if heap else heapq.heappop(short)[1]
        length, n = min(size, room), min(count, many)
        out.append((level, tail, rank, n, start, length, at, used))
        left = [(spent, at + n, many - n, room, used)] if many > n else []
        if room > length:
            left.append((spent + cost(length), at, n, room - length, used + length))
        for g in left:
            heapq.heappush(heap, g) if g[3] >= size else heapq.heappush(short, (-g[3], g))
        if count > n:
            heapq.heappush(items, (-size, level, tail, rank + n, count - n, start))
        if length < size:
            heapq.heappush(items, (length - size, level + 1, tail, rank, n, start + length))
    table = np.array(out, np.int64).reshape(-1, 8)
    return table[np.lexsort((table[:, 2], table[:, 1], table[:, 0]))]


def _runs(plan: np.ndarray, tail: np.ndarray, rank: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per level: the rows that have a run there, and the plan's row for each."""
    rows = np.flatnonzero(tail > 0)
    for level in range(int(plan[-1, 0]) + 1 if len(plan) else 0):
        part = plan[np.searchsorted(plan[:, 0], level):np.searchsorted(plan[:, 0], level, side="right")]
        at = np.searchsorted((part[:, 1] << 42) + part[:, 2], (tail[rows] << 42) + rank[rows], side="right") - 1
        found = part[np.maximum(at, 0)]
        hit = (at >= 0) & (found[:, 1] == tail[rows]) & (rank[rows] < found[:, 2] + found[:, 3])
        rows, found = rows[hit], found[hit]
        if not len(rows):
            return
        yield rows, found


def pack(docs: DataFrame, vocabulary_path: str, end_id: int = 1, capacity: int = 2048, cost=Cost(),
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per run of ids of a document in a sequence: (id column, start, length, doc_tokens, sequence_id, offset,
    ids): ``ids`` are little-endian unsigned 32-bit numbers."""
    vocabulary = Path(vocabulary_path).read_text(encoding="utf-8")  # shipped to executors, a few MB
    tokens = store(encode(docs, vocabulary, end_id, capacity, id_col, text_col), "packing-tokens")
    counts = store(tokens.groupBy("part", "tail").agg(F.count(F.lit(1)).alias("n")), "packing-counts")
    tails = {r[0]: r[1] for r in counts.where("tail > 0").groupBy("tail").agg(F.sum("n")).collect()}  # < capacity rows
    plan = assign(tails, capacity, cost)
    earlier = Window.partitionBy("tail").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "tail", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    if counts.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    wide = tokens.schema["id"].dataType.simpleString()
    width = Encoder(vocabulary).dtype
    shared = docs.sparkSession.sparkContext.broadcast(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for b in small(batches, "ids", 1 << 20):
            n, tail, rank, part, full_at = (b.column(c).to_numpy() for c in ("n_tokens", "tail", "rank", "part", "full_at"))
            row, start, length, seq, offset = [], [], [], [], []
            for i in np.flatnonzero(n >= capacity).tolist():
                k = int(n[i]) // capacity
                row += [i] * k
                start += range(0, k * capacity, capacity)
                length += [capacity] * k
                base = (int(part[i]) + 1) * _FULL + int(full_at[i])
                seq += range(base, base + k)
                offset += [0] * k
            for rows, found in _runs(plan, tail.astype(np.int64), rank):
                row += rows.tolist()
                start += (found[:, 4] + n[rows] - tail[rows]).tolist()
                length += found[:, 5].tolist()
                seq += (found[:, 6] + rank[rows] - found[:, 2]).tolist()
                offset += found[:, 7].tolist()
            ids = [np.frombuffer(x.as_buffer(), width) for x in b.column("ids")]
            cut = [ids[i][s:s + k].astype("<u4").tobytes() for i, s, k in zip(row, start, length, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(n[row] if row else n[:0]), pa.array(seq, pa.int64()), pa.array(offset, pa.int64()),
                 pa.array(cut, pa.binary())],
                [id_col, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    ranked = tokens.join(offsets, ["part", "tail"]).select(
        "id", "ids", "n_tokens", "part", "tail", "full_at", (F.col("place") + F.col("before")).alias("rank"))
    return ranked.mapInArrow(run, f"{id_col} {wide}, start long, length long, doc_tokens long, sequence_id long, "
                                  "offset long, ids binary")
