"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

A transcript is a sequence of rows (conversation, sequence number, text); every line of a row is one step.  Hidden
states are a role at the head of a turn or inside one.  A line emits its speaker marker (read off its front) and
line features (length, question, blank line before, list or code look, first line).  Parameters are smoothed counts
of a bounded labelled sample, mixed with a prior in which a marker mostly tells the truth.

Viterbi over a sequence is a product of max-plus matrices, so it needs no whole conversation in one task.  Rows are
range-partitioned by (conversation, sequence); a conversation cut by a partition border becomes pieces.  Pass 1 gives
each cut piece's matrix (states x states), pass 2 joins the few pieces in order (at most two per partition) and fixes
the state at every border, pass 3 decodes each piece between its borders.  Only the turns at the borders of a cut
conversation, two per piece, are then put together by their running number; all others come straight from their piece.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlab.llm.scratch import store
from visitlab.llm.textnp import mix

ROLES = ("system", "user", "assistant")
STATES = tuple((r, head) for r in range(len(ROLES)) for head in (True, False))
MAX_CONVERSATIONS = 2000
# Speaker markers, by role.
MARKERS = {"system": ("system", "instructions", "context"), "user": ("user", "human", "question", "q", "me", "customer"),
           "assistant": ("assistant", "ai", "bot", "answer", "a", "agent", "model")}
_MARKER = re.compile(r"\s*(?:#{1,3}\s*|\*\*|\[|<\|)?(" + "|".join(x for v in MARKERS.values() for x in v)
                     + r")(?:\*\*|\]|\|>)?\s*[:>]\s*|\s*<\|(" + "|".join(x for v in MARKERS.values() for x in v)
                     + r")\|>\s*", re.I)
_ROLE_OF = {x: i for i, v in enumerate(MARKERS.values()) for x in v}
N_OBS = 4 * 2 * 4 * 2  # marker, question, length, first line of a row
PIECE_LINES = 20_000  # lines of one conversation in a task


class Model(NamedTuple):
    start: np.ndarray  # log, per state
    move: np.ndarray  # log, state to state
    emit: np.ndarray  # log, state x observation


def marker(line: str) -> tuple[int, int]:
    """(role, length of the marker), or (-1, 0)."""
    m = _MARKER.match(line)
    return (_ROLE_OF[(m.group(1) or m.group(2)).lower()], m.end()) if m else (-1, 0)


def observe(text: str) -> list[int]:
    """One symbol per line of a row."""
    out = []
    for i, line in enumerate(text.split("\n")):
        role, n = marker(line)
        size = len(line) - n
        out.append((((role + 1) * 2 + ("?" in line)) * 4 + (size > 20) + (size > 80) + (size > 300)) * 2 + (i == 0))
    return out


def prior() -> Model:
    """Counts before any data: markers are mostly true, turns alternate, roles open in their usual order."""
    s = len(STATES)
    start, move, emit = np.full(s, 0.01), np.full((s, s), 0.01), np.full((s, N_OBS), 0.02)
    for i, (r, head) in enumerate(STATES):
        if head:
            start[i] = (1.0, 2.0, 0.2)[r]
        for j, (q, other) in enumerate(STATES):
            if not other and q == r:
                move[i, j] = 2.0
            elif other and q != r:
                move[i, j] = (0.05, 2.0, 2.0)[q]
            elif other:
                move[i, j] = 0.2
        for o in range(N_OBS):
            said, first = o // 16 - 1, o % 2
            if said >= 0:
                emit[i, o] = 2.0 if head and said == r else 0.02
            else:
                emit[i, o] = (0.5 if head else 1.0) * (1.0 if bool(first) == head else 0.3)
    return Model(start, move, emit)


def fit(sequences: list[list[tuple[int, int]]]) -> Model:
    """Log probabilities from (state, observation) sequences, one per conversation, on top of the prior."""
    start, move, emit = (x.copy() for x in prior())
    for seq in sequences:
        start[seq[0][0]] += 1
        for state, o in seq:
            emit[state, o] += 1
        for (a, _), (b, _) in zip(seq, seq[1:], strict=False):
            move[a, b] += 1
    return Model(np.log(start / start.sum()), np.log(move / move.sum(axis=1, keepdims=True)),
                 np.log(emit / emit.sum(axis=1, keepdims=True)))


def _rows(df: DataFrame, conv: str, seq: str, text: str, *more: Column) -> DataFrame:
    return df.select(F.coalesce(F.col(conv).cast("string"), F.lit("")).alias("conv"),
                     F.coalesce(F.col(seq).cast("long"), F.lit(-1)).alias("seq"),
                     F.coalesce(F.col(text), F.lit("")).alias("text"), *more)


def train(transcripts: DataFrame, conv_col: str = "conv_id", seq_col: str = "turn", text_col: str = "text",
          role_col: str = "role", max_conversations: int = MAX_CONVERSATIONS) -> Model:
    """Fit on at most max_conversations labelled conversations, the first by a hash of their id, and of each the rows
    with a known role up to the 1,000th, at most 20 * max_conversations rows in all.  Without labels the prior alone is
    the model."""
    rows = _rows(transcripts, conv_col, seq_col, text_col, F.lower(F.col(role_col)).alias("role")).where(
        F.col("role").isin(*ROLES))
    ids = rows.select("conv").distinct().orderBy(F.xxhash64("conv"), "conv").limit(max_conversations)
    sample = rows.join(F.broadcast(ids), "conv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("conv"), b.column("seq"), b.column("role"),
                 pa.array([observe(t) for t in b.column("text").to_pylist()], pa.list_(pa.int32()))],
                ["conv", "seq", "role", "obs"])

    sample = sample.mapInArrow(run, "conv string, seq long, role string, obs array<int>")
    found: dict[str, list] = {}
    for r in sample.where("seq < 1000").orderBy("conv", "seq", "role").limit(max_conversations * 20).collect():
        k = ROLES.index(r["role"])
        found.setdefault(r["conv"], []).extend(
            (STATES.index((k, i == 0)), o) for i, o in enumerate(r["obs"]))
    return fit(list(found.values()))


def _nudges(rows: list) -> np.ndarray:
    """A millionth at most per line and state, from a hash of the line's place (sequence, line): it decides between paths
    of equal score, and the same way however the conversation is cut."""
    place = [(seq, i) for _, seq, text in rows for i in range(text.count("\n") + 1)]
    seq, line = np.array(place, np.int64).T.astype(np.uint64)
    h = mix(seq * np.uint64(0x9E3779B97F4A7C15) + line)[:, None] + np.arange(len(STATES), dtype=np.uint64)[None]
    return (mix(h) >> np.uint64(11)).astype(float) * (1e-6 / (1 << 53))


def _emitted(obs: list[int], model: Model, nudge: np.ndarray | None) -> np.ndarray:
    e = model.emit[:, obs].T
    return e if nudge is None else e + nudge


def _matrix(obs: list[int], model: Model, first: bool, nudge: np.ndarray | None = None) -> np.ndarray:
    """Best score of a path through the lines, by the state before them (first: one virtual state) and the last."""
    e = _emitted(obs, model, nudge)
    m = (model.start[None, :] if first else model.move) + e[0]
    for x in e[1:]:
        m = (m[:, :, None] + model.move[None]).max(axis=1) + x
    return m


def _path(obs: list[int], model: Model, before: int | None, last: int | None, nudge: np.ndarray | None = None) -> list[int]:
    """Viterbi path of lines that follow state ``before`` (None: they open the conversation) and end in ``last``."""
    e = _emitted(obs, model, nudge)
    score = (model.start if before is None else model.move[before]) + e[0]
    back = []
    for x in e[1:]:
        ways = score[:, None] + model.move
        back.append(ways.argmax(axis=0))
        score = ways.max(axis=0) + x
    out = [int(score.argmax()) if last is None else last]
    for b in reversed(back):
        out.append(int(b[out[-1]]))
    return out[::-1]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a partition, numbered by piece: a piece ends with its conversation or at PIECE_LINES lines."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    piece, conv, lines = 0, None, 0
    for b in batches:
        pieces = []
        for c, t in zip(b.column("conv").to_pylist(), b.column("text").to_pylist(), strict=True):
            if conv is not None and (c != conv or lines >= PIECE_LINES):
                piece, lines = piece + 1, 0
            conv, lines = c, lines + t.count("\n") + 1
            pieces.append(piece)
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array([part] * len(pieces), pa.int32()), pa.array(pieces, pa.int32())],
            [*b.schema.names, "part", "piece"])


def _grouped(batches: Iterator[pa.RecordBatch], more: tuple[str, ...] = ()) -> Iterator[tuple[tuple, list, tuple]]:
    """((part, piece), its rows (conv, seq, text), its first row's further columns) from rows sorted by piece."""
    key, rows, extra = None, [], ()
    names = ("part", "piece", "conv", "seq", "text", *more)
    for b in batches:
        for r in zip(*(b.column(x).to_pylist() for x in names), strict=True):
            if r[:2] != key:
                if rows:
                    yield key, rows, extra
                key, rows, extra = r[:2], [], r[5:]
            rows.append(r[2:5])
    if rows:
        yield key, rows, extra


def _borders(model: Model):
    """Per piece of one conversation the state before it and its last state, by max-plus products of the pieces.

    A group holds one row of states x states numbers for every PIECE_LINES lines of its conversation.
    """
    import pandas as pd

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["part", "piece"])
        m = [np.frombuffer(x).reshape(len(STATES), len(STATES)) for x in rows["matrix"]]
        score, back = m[0][0], []
        for x in m[1:]:
            ways = score[:, None] + x
            back.append(ways.argmax(axis=0))
            score = ways.max(axis=0)
        last = [int(score.argmax())]
        for b in reversed(back):
            last.append(int(b[last[-1]]))
        last = last[::-1]
        return pd.DataFrame({"part": rows["part"].to_numpy(), "piece": rows["piece"].to_numpy(),
                             "before": [-1, *last[:-1]], "last": last})
    return run


def parse(transcripts: DataFrame, model: Model, conv_col: str = "conv_id", seq_col: str = "turn",
          text_col: str = "text") -> DataFrame:
    """Recovered turns (conv, seq, line, role, opens, content, rendered), markers taken off.

    seq and line say where the turn begins.  rendered is the canonical form: ``<|role|>``, a line break, the content
    and a line break; a header ends the turn before it.  opens is true: every row is a whole turn, however its
    conversation was cut.

    Null ids make one conversation "", null numbers are -1, null texts are one empty line; rows equal in
    conversation and number are ordered by text; between paths of (nearly) equal score a hash of the lines' places decides.
    Other columns are ignored; an empty table gives no rows.
    """
    shared = transcripts.sparkSession.sparkContext.broadcast(tuple(model))
    order = ["conv", "seq", "text"]
    rows = store(_rows(transcripts, conv_col, seq_col, text_col).repartitionByRange(*order).sortWithinPartitions(*order)
                 .mapInArrow(_cut, "conv string, seq long, text string, part int, piece int"), "op3-rows")
    several = (rows.groupBy("conv").agg(F.min(F.struct("part", "piece")).alias("a"),
                                        F.max(F.struct("part", "piece")).alias("b")).where("a <> b"))
    several = store(several.select("conv", F.col("a.part").alias("p0"), F.col("a.piece").alias("q0")), "op3-cut")

    def by_piece(df: DataFrame) -> DataFrame:
        return df.repartition("part", "piece").sortWithinPartitions("part", "piece", *order)

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for (part, piece), found, (p0, q0) in _grouped(batches, ("p0", "q0")):
            obs = [o for _, _, t in found for o in observe(t)]
            m = _matrix(obs, model, (part, piece) == (p0, q0), _nudges(found))
            m = np.broadcast_to(m, (len(STATES), len(STATES)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([found[0][0]]), pa.array([part], pa.int32()), pa.array([piece], pa.int32()),
                 pa.array([np.ascontiguousarray(m).tobytes()])], ["conv", "part", "piece", "matrix"])

    borders = store(by_piece(rows.join(several, "conv"))
                    .mapInArrow(matrices, "conv string, part int, piece int, matrix binary")
                    .groupBy("conv").applyInPandas(_borders(model), "part int, piece int, before int, last int"),
                    "op3-borders")

    def decode(edges: bool):
        """The turns of every piece, without those at a border or (``edges``) only those."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = Model(*shared.value)
            for (part, piece), found, (before, last) in _grouped(batches, ("before", "last")):
                obs, lines = [], []
                for conv, seq, text in found:
                    obs += observe(text)
                    lines += [(conv, seq, i, x) for i, x in enumerate(text.split("\n"))]
                path = _path(obs, model, None if before in (None, -1) else before, last, _nudges(found))
                turns = list(_turns(lines, path, before))
                at_border = [before is not None and (i == len(turns) - 1 or not t[2]) for i, t in enumerate(turns)]
                turns = [t for t, x in zip(turns, at_border, strict=True) if x == edges]
                if edges:
                    made = [(*first[:3], ROLES[role], opens, "\n".join(words), part, piece) for first, role, opens, words in turns]
                else:
                    made = [_turn(*t) for t in turns]
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made, strict=True)], _EDGE if edges else _TURN)
        return run

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [_turn((c, s, i), ROLES.index(r), True, t.split("\n")) for c, s, i, r, t in zip(
                *(b.column(x).to_pylist() for x in ("conv", "seq", "line", "role", "text")), strict=True)]
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made, strict=True)], _TURN)

    turn = "conv string, seq long, line long, role string, opens boolean, content string, rendered string"
    plain = by_piece(rows.join(borders, ["part", "piece"], "left")).mapInArrow(decode(False), turn)
    # The turns at borders: a fragment goes on the turn that was opened last in its conversation.
    edges = store(by_piece(rows.join(borders, ["part", "piece"])).mapInArrow(
        decode(True), "conv string, seq long, line long, role string, opens boolean, text string, part long, piece long"),
        "op3-edges")
    place = ["conv", "part", "piece", "opens"]  # a fragment comes before the turn opened in the same piece
    number = F.sum(F.col("opens").cast("int")).over(Window.partitionBy("conv").orderBy("part", "piece", "opens"))
    opened = [F.max(F.when(F.col("opens"), F.col(c))).alias(c) for c in ("seq", "line", "role")]
    parts = F.array_sort(F.collect_list(F.struct("part", "piece", "opens", "text")))
    joined = (edges.join(edges.select(*place, number.alias("turn")), place).groupBy("conv", "turn")
              .agg(*opened, F.array_join(F.transform(parts, lambda x: x["text"]), "\n").alias("text")))
    return plain.union(joined.select("conv", "seq", "line", "role", "text").mapInArrow(whole, turn))


_TURN = ["conv", "seq", "line", "role", "opens", "content", "rendered"]
_EDGE = [*_TURN[:5], "text", "part", "piece"]


def _turns(lines: list[tuple], path: list[int], before: int | None) -> Iterator[tuple]:
    """Lines and states of one piece to turns (first line, role, opens, lines); a turn opens at a head or where the role
    changes."""
    role = None if before in (None, -1) else STATES[before][0]
    first, opens, words = lines[0], False, []
    for (conv, seq, i, text), state in zip(lines, path, strict=True):
        r, head = STATES[state]
        if head or r != role:
            if words:
                yield first, role, opens, words
            first, role, opens, words = (conv, seq, i, text), r, True, []
            text = text[marker(text)[1]:]
        words.append(text)
    yield first, role, opens, words


def _turn(first: tuple, role: int, opens: bool, words: list[str]) -> tuple:
    content = "\n".join(words[1:] if len(words) > 1 and not words[0].strip() else words)
    return (*first[:3], ROLES[role], opens, content, f"<|{ROLES[role]}|>\n{content}\n")
