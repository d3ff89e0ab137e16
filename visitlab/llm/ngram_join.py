"""N-gram Jaccard self-join: rare-first prefix filter with length, positional and suffix filters.

Steps, each a Spark job over stored tables:

1. One scan makes every document's set of word n-gram hashes, an order-free 128-bit fingerprint of it, and a frequency
   sketch: document counts of 2^SKETCH_BITS hash ranges, summed over all documents.  Documents with equal sets
   (same fingerprint and size) form one class, stood for by its smallest doc_id.
2. A set is ordered rare-first by (sketched frequency, hash).  Any one order makes the prefix filter exact, so the
   sketch may be coarse: it costs candidates, never links.  The first n - ceil(t*n) + 1 n-grams are the prefix.
3. Prefix postings are range-partitioned by (n-gram, class) and sorted, so a hot n-gram spreads over tasks.  Each run
   of equal n-grams is streamed: postings alone in their run die; the others are kept with the run's first class as
   pivot.
4. ``ngram_jaccard_links``: all pairs of a run are formed, filtered and verified.  A run is cut into blocks of classes,
   and each two blocks meet under a key of their own, so a hot n-gram spreads over tasks.
   ``ngram_jaccard_components``: pivot pairs (a number linear in the postings) are filtered, verified once, and closed to
   components.  The pairs still needed are those in one run but in different components.  They are formed between the
   few distinct (set size, position) groups of a run, filtered there, and only then between their classes.  So a group
   of near copies, once closed, makes no pairs: its components are exact, its links are only some of them.
5. Verification: the suffix filter (the overlap is at most the sum over hash cells of the smaller cell counts), then
   the exact intersection of the two sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlab.llm import bloom
from visitlab.llm.blobs import merge, packed, packed_places
from visitlab.llm.components import connected_components
from visitlab.llm.scratch import store
from visitlab.llm.textnp import mix, shingle_sets, small

SKETCH_BITS = 22  # 4M counters: 16 MB while counting, 4 MB as broadcast ranks; raise it for larger corpora
_CHUNK = 1 << 16  # counters per stored piece of a sketch
CELLS = 128  # hash cells of the suffix filter
_SLICE = 2 << 20  # bytes of text worked on at a time
RUN_BLOCK = 512  # classes of a run that meet those of another block in one task

_CLASS_SCHEMA = "doc_id long, n long, fa long, fb long, chunk int, counts binary"
_PREFIX_SCHEMA = "doc_id long, n long, fa long, grams array<long>, cells binary"


class JoinResult(NamedTuple):
    documents: DataFrame  # doc_id, n_shingles, class_id, component_id: one row per input row
    links: DataFrame  # a, b, n_a, n_b, overlap: verified pairs that tie the components, not all links


class LinkResult(NamedTuple):
    documents: DataFrame  # doc_id, n_shingles, class_id, n_links: one row per input row
    links: DataFrame  # a, b, n_a, n_b, overlap: all verified pairs between class representatives


class _Prepared(NamedTuple):
    docs: DataFrame  # doc_id, text
    rows: DataFrame  # doc_id, n, fa, fb: one row per input row
    members: DataFrame  # doc_id, n, node, class_id: one row per input row that takes part
    same: DataFrame  # a, b: classes tied by a doc_id with several different sets
    profile: DataFrame  # node, n, doc_id, fa, cells: per class, the document that stands for it and its set's fingerprint
    live: DataFrame  # postings that share their n-gram, with the pivot of their run
    renamed: bool  # some nodes are no doc_ids
    n_rows: int
    n_live: int


def _prefix_length(n: int, num: int, den: int) -> int:
    return n - -(-n * num // den) + 1


def _fingerprints(every: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit sums over each row's hashes (0 without any)."""
    full = np.flatnonzero(size)
    at = np.concatenate([[0], np.cumsum(size[full])[:-1]]).astype(np.int64) if len(full) else full
    out = np.zeros((2, len(size)), np.uint64)
    for f, seed in zip(out, (0x51ED270B, 0x2545F491), strict=True):
        if len(full):
            f[full] = np.add.reduceat(mix(every ^ np.uint64(seed)), at)
    return out[0].view(np.int64), out[1].view(np.int64)


def _scan(k: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, waiting = None, []
        shift = np.uint64(64 - bits)

        def counted() -> tuple[np.ndarray, np.ndarray]:
            found = np.unique(np.concatenate(waiting), return_counts=True)
            waiting.clear()
            return found

        for b in small(batches, "text", _SLICE):
            sets = list(shingle_sets(b.column(1), k))
            size = np.array([len(s) for s in sets], np.int64)
            every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            waiting.append((every >> shift).astype(np.int32))
            if sum(map(len, waiting)) > 1 << 21:
                at, n = counted()
                counts = np.zeros(1 << bits, np.int32) if counts is None else counts
                counts[at] += n.astype(np.int32)
            none = pa.nulls(len(size))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size), *map(pa.array, _fingerprints(every, size)),
                                              none.cast(pa.int32()), none.cast(pa.binary())],
                                             ["doc_id", "n", "fa", "fb", "chunk", "counts"])
        if not waiting and counts is None:
            return
        at, n = counted() if waiting else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        pieces = {}
        if counts is not None:
            counts[at] += n.astype(np.int32)
            for i in range(0, len(counts), _CHUNK):
                if counts[i:i + _CHUNK].any():
                    pieces[i // _CHUNK] = packed(counts[i:i + _CHUNK].astype("<i8"))
        else:
            for i in np.unique(at // _CHUNK).tolist():
                a, z = np.searchsorted(at, [i * _CHUNK, (i + 1) * _CHUNK])
                pieces[i] = packed_places(at[a:z] - i * _CHUNK, n[a:z].astype("<i8"), min(_CHUNK, 1 << bits))
        none = pa.nulls(len(pieces), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(list(pieces), pa.int32()),
                                          pa.array(list(pieces.values()), pa.binary())],
                                         ["doc_id", "n", "fa", "fb", "chunk", "counts"])
    return run


def _ranks(scanned: DataFrame, bits: int) -> np.ndarray:
    """One byte per hash range: its document count on a logarithmic scale (a broadcast of 2^bits bytes)."""
    out = np.zeros(1 << bits, np.uint8)
    for i, c in merge(scanned.where("chunk is not null"), "<i8", "sum").items():
        out[i * _CHUNK:i * _CHUNK + len(c)] = np.minimum(255, 8 * np.log2(1 + c))
    return out


def _prefixes(k: int, num: int, den: int, bits: int, ranks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, shift, cell = ranks.value, np.uint64(64 - bits), np.uint64((1 << 64) // CELLS)
        for b in small(batches, "text", _SLICE):
            ids, sizes, marks, grams, cells = [], [], [], [], []
            for doc_id, s in zip(b.column(0).to_pylist(), shingle_sets(b.column(1), k), strict=True):
                if len(s) == 0 or doc_id is None:
                    continue
                order = np.lexsort((s, rank[(s >> shift).astype(np.int64)]))
                ids.append(doc_id)
                sizes.append(len(s))
                marks.append(_fingerprints(s, np.array([len(s)]))[0])
                grams.append(s[order[:_prefix_length(len(s), num, den)]].view(np.int64))
                c = np.bincount((s // cell).astype(np.int64), minlength=CELLS)
                cells.append(c.astype("<u2").tobytes() if c.max() < 65536 else b"")
            if not ids:
                continue
            at = np.concatenate([[0], np.cumsum([len(g) for g in grams])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(np.concatenate(marks)),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(grams))), pa.array(cells, pa.binary())],
                ["doc_id", "n", "fa", "grams", "cells"])
    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (h, node, n, pos) in; postings that share their h out, with the run's first posting as pivot.

    Holds one batch and one row, the pivot of the open run.  The first and the last run of a partition may go on in
    the next one, so they are given out even if they are a single posting here.
    """
    names = ["h", "node", "n", "pos", "piv", "piv_n", "piv_pos"]
    pivot, alone, begun = None, False, False
    for b in batches:
        if b.num_rows == 0:
            continue
        rows = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
        if pivot is not None:  # the open run goes on in front of this batch
            rows = np.concatenate([pivot[:, None], rows], axis=1)
        h = rows[0]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        head = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
        shared = ~new
        shared[:-1] |= ~new[1:]
        keep = shared.copy()
        if pivot is not None and not alone:
            keep[0] = False  # it was given out with an earlier batch
        if not begun:
            keep[0] = begun = True
        out = np.concatenate([rows, rows[1:, head]])[:, keep]
        # a last row that opens a run waits for the next batch, unless it is out already
        pivot, alone = rows[:, head[-1]], bool(new[-1]) and not keep[-1]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in out], names)
    if alone:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*pivot, *pivot[1:])], names)


def _may_link(na: str, pa_: str, nb: str, pb: str, num: int, den: int) -> Column:
    """Length and positional filter on two sets that meet at positions pa_ and pb of their orders."""
    best = f"least({na} - {pa_}, {nb} - {pb})"
    return F.expr(f"{den} * least({na}, {nb}) >= {num} * greatest({na}, {nb}) "
                  f"and ({num} + {den}) * {best} >= {num} * ({na} + {nb})")


_NEAR = ["a", "na", "b", "nb", "doc_a", "fa_a", "doc_b", "fa_b"]


def _suffix_filter(num: int, den: int):
    """Upper bound of the overlap from the cell counts of both sets; an empty profile gives no bound."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ca, cb = b.column("cells_a").to_pylist(), b.column("cells_b").to_pylist()
            known = np.array([len(x) == len(y) == 2 * CELLS for x, y in zip(ca, cb, strict=True)], bool)
            ok = ~known
            if known.any():
                x = np.frombuffer(b"".join(c for c, f in zip(ca, known, strict=True) if f), "<u2").reshape(-1, CELLS)
                y = np.frombuffer(b"".join(c for c, f in zip(cb, known, strict=True) if f), "<u2").reshape(-1, CELLS)
                bound = np.minimum(x, y).sum(axis=1, dtype=np.int64)
                n = (b.column("na").to_numpy() + b.column("nb").to_numpy())[known]
                ok[known] = (num + den) * bound >= num * n
            yield b.select(_NEAR).filter(pa.array(ok))
    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, "text", _SLICE):
            sets = list(shingle_sets(b.column(1), k))
            size = np.array([len(s) for s in sets], np.int64)
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            at = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size), pa.array(_fingerprints(flat, size)[0]),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(flat.view(np.int64)))], ["doc_id", "n", "fa", "grams"])
    return run


def _prepare(docs: DataFrame, id_col: str, text_col: str, k: int, num: int, den: int, sketch_bits: int) -> _Prepared:
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    # 1. sets -> fingerprints, classes, sketch
    scanned = store(docs.mapInArrow(_scan(k, sketch_bits), _CLASS_SCHEMA), "op9-scan")
    ranks = spark.sparkContext.broadcast(_ranks(scanned, sketch_bits))
    rows = scanned.where("chunk is null").select("doc_id", "n", "fa", "fb")
    n_rows = rows.count()
    some = rows.where("doc_id is not null and n > 0")
    classes = store(some.groupBy("fa", "fb", "n").agg(F.min("doc_id").alias("class_id")), "op9-classes", n_rows)
    # Classes of one size with the same smallest doc_id (it has several texts) get a number of their own as node.
    twice = store(classes.groupBy("class_id", "n").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
                  .select("class_id", "n"), "op9-twice", n_rows)
    renamed = not twice.isEmpty()
    classes = classes.withColumn("node", F.col("class_id"))
    if renamed:
        own = F.expr("-2 - (xxhash64(fa, fb, n) & 4611686018427387903)")
        classes = store(classes.drop("node").join(twice.withColumn("again", F.lit(True)), ["class_id", "n"], "left")
                        .withColumn("node", F.when(F.col("again"), own).otherwise(F.col("class_id"))).drop("again"),
                        "op9-nodes", n_rows)
    members = store(some.join(classes, ["fa", "fb", "n"]).select("doc_id", "n", "node", "class_id"), "op9-members", n_rows)
    # a doc_id with several different sets ties their classes together
    several = members.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b")
    same = (members.join(store(several.select("doc_id", "a"), "op9-several", n_rows), "doc_id")
            .where("a <> node").select("a", F.col("node").alias("b")).distinct())

    # 2. rare-first prefixes of the representatives
    prefix = docs.mapInArrow(_prefixes(k, num, den, sketch_bits, ranks), _PREFIX_SCHEMA)
    reps = classes.select("node", "n", F.col("class_id").alias("doc_id"), "fa")
    prefix = store(prefix.join(reps, ["doc_id", "n", "fa"]), "op9-prefix", 20 * n_rows)
    profile = prefix.select("node", "n", "doc_id", "fa", "cells").dropDuplicates(["node", "n"])
    postings = prefix.select("node", "n", F.posexplode("grams").alias("pos", "h")) \
        .select("h", "node", "n", F.col("pos").cast("long"))

    # 3. runs and their pivots
    live = store(postings.repartitionByRange("h", "node").sortWithinPartitions("h", "node")
                 .mapInArrow(_runs, "h long, node long, n long, pos long, piv long, piv_n long, piv_pos long"),
                 "op9-live", 100 * n_rows)
    return _Prepared(docs, rows, members, same, profile, live, renamed, n_rows, live.count())


def ngram_jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4,
                             num: int = 85, den: int = 100, sketch_bits: int = SKETCH_BITS) -> JoinResult:
    """Components of documents whose k-word shingle sets have den * |intersection| >= num * |union|; exact.

    A shortcut: pairs already known to be in one component are not verified, so ``links`` ties every component but is
    not the join; ``ngram_jaccard_links`` is.

    Every row comes back once.  Null or blank texts have an empty set and link with nothing; fewer than k words make
    one shingle.  Rows with one doc_id are one document: they share its component.  Rows without a doc_id come back
    with null class and component and take no part.  Extra columns are ignored.
    """
    p = _prepare(docs, id_col, text_col, k, num, den, sketch_bits)
    live, n_live = p.live, p.n_live
    spokes = (live.where("piv <> node").where(_may_link("n", "pos", "piv_n", "piv_pos", num, den))
              .select(F.col("piv").alias("a"), F.col("piv_n").alias("na"), F.col("node").alias("b"),
                      F.col("n").alias("nb")).distinct())
    tried, links = _verify(p, spokes, n_live, k, num, den)
    tied = links.select("a", "b").union(p.same)
    parts = connected_components(tied, rows=n_live + p.n_rows)
    rest = _across(live, n_live, parts, num, den)
    rest = rest.join(tried, ["a", "na", "b", "nb"], "left_anti")
    _, more = _verify(p, rest, n_live, k, num, den)
    links = store(links.union(more), "op9-links", n_live)
    parts = connected_components(tied.union(more.select("a", "b")), rows=n_live + p.n_rows)

    joined = p.members.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    if p.renamed:  # nodes are not all doc_ids: the component's smallest doc_id is looked up
        joined = store(joined, "op9-joined", p.n_rows)
        least = store(joined.groupBy("component").agg(F.min("doc_id").alias("least")), "op9-least", p.n_rows)
        joined = joined.join(least, "component").withColumn("component", F.col("least"))
    joined = joined.select("doc_id", F.col("n").alias("n_shingles"), "class_id", F.col("component").alias("component_id"))
    alone = p.rows.where("doc_id is null or n = 0").select("doc_id", F.col("n").alias("n_shingles"),
                                                           F.col("doc_id").alias("class_id"),
                                                           F.col("doc_id").alias("component_id"))
    return JoinResult(joined.union(alone), links)


#: The components under their former name.
ngram_jaccard_join = ngram_jaccard_components


def ngram_jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, num: int = 85,
                        den: int = 100, sketch_bits: int = SKETCH_BITS, block: int = RUN_BLOCK) -> LinkResult:
    """The whole join: all pairs of classes with den * |intersection| >= num * |union|, no pair is lost.

    Classes of equal sets stand for their documents, so exact copies make no pairs; a group of near copies has as many
    links as it has pairs.  ``n_links`` of a row counts the other doc_ids that have an equal or a linked set; it is 0
    for an empty set and null without a doc_id.  Rows are treated as by ``ngram_jaccard_components``.
    A class is called by its smallest doc_id, or by a negative number of its own where that doc_id stands for several
    sets of one size.
    """
    p = _prepare(docs, id_col, text_col, k, num, den, sketch_bits)
    rows, members = p.rows, p.members.drop("class_id")
    _, links = _verify(p, _within(p.live, num, den, block), None, k, num, den)

    held = store(members.distinct(), "op9-held")
    size = store(held.groupBy("node", "n").agg(F.count(F.lit(1)).alias("size")), "op9-size")
    around = store(links.select(F.col("a").alias("node"), F.col("n_a").alias("n"), F.col("b").alias("near"),
                                F.col("n_b").alias("near_n"))
                   .union(links.select("b", "n_b", "a", "n_a"))
                   .union(size.select("node", "n", "node", "n")), "op9-around")
    total = (around.join(size.select(F.col("node").alias("near"), F.col("n").alias("near_n"), "size"),
                         ["near", "near_n"]).groupBy("node", "n").agg(F.sum("size").alias("total")))
    # a doc_id in several classes around a class counts once
    several = held.groupBy("doc_id").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("doc_id")
    several = store(held.join(several, "doc_id").select("doc_id", F.col("node").alias("near"),
                                                        F.col("n").alias("near_n")), "op9-several")
    again = (around.join(several, ["near", "near_n"]).groupBy("node", "n", "doc_id").agg(F.count(F.lit(1)).alias("m"))
             .groupBy("node", "n").agg(F.sum(F.col("m") - 1).alias("again")))
    counts = store(total.join(again, ["node", "n"], "left")
                   .select("node", "n", (F.col("total") - F.coalesce("again", F.lit(0)) - 1).alias("n_links")),
                   "op9-counts")
    joined = p.members.join(counts, ["node", "n"]).select("doc_id", F.col("n").alias("n_shingles"), "class_id", "n_links")
    alone = rows.where("doc_id is null or n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("class_id"),
        F.expr("if(doc_id is null, null, 0L)").alias("n_links"))
    return LinkResult(joined.union(alone), links)


def _within(live: DataFrame, num: int, den: int, block: int) -> DataFrame:
    """Distinct pairs ((a, na) < (b, nb)) that share a run and pass both filters; each two blocks of a run meet once."""
    runs = live.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    runs = store(runs.select("h", F.ceil(F.col("m") / block).cast("int").alias("blocks")), "op9-runs")
    post = store(live.select("h", "node", "n", "pos").join(runs, "h")
                 .withColumn("at", F.expr("cast(pmod(xxhash64(node, n), blocks) as int)")), "op9-blocks")
    left = post.select("h", F.col("at").alias("i"), F.expr("explode(sequence(at, blocks - 1))").alias("j"),
                       F.col("node").alias("u"), F.col("n").alias("nu"), F.col("pos").alias("pu"))
    right = post.select("h", F.expr("explode(sequence(0, at))").alias("i"), F.col("at").alias("j"),
                        F.col("node").alias("v"), F.col("n").alias("nv"), F.col("pos").alias("pv"))
    pairs = (left.join(right, ["h", "i", "j"]).where("i < j or u < v or u = v and nu < nv")
             .where(_may_link("nu", "pu", "nv", "pv", num, den)))
    swap = F.expr("u > v or u = v and nu > nv")
    return pairs.select(F.least("u", "v").alias("a"), F.when(swap, F.col("nv")).otherwise(F.col("nu")).alias("na"),
                        F.greatest("u", "v").alias("b"), F.when(swap, F.col("nu")).otherwise(F.col("nv")).alias("nb")
                        ).distinct()


def _across(live: DataFrame, n_live: int, parts: DataFrame, num: int, den: int) -> DataFrame:
    """Distinct pairs (a < b) that share a run, lie in different components and pass both filters."""
    post = live.select("h", "node", "n", "pos", "piv")
    post = store(post.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node")), "op9-post",
                 n_live)
    mixed = post.groupBy("h").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                  F.count(F.lit(1)).alias("m"), F.min("piv").alias("p"), F.max("piv").alias("q")
                                  ).where("lo < hi and (m > 2 or p <> q)").select("h")
    post = store(post.join(store(mixed, "op9-mixed", n_live), "h"), "op9-open", n_live)
    groups = store(post.groupBy("h", "n", "pos").agg(F.min("component").alias("lo"), F.max("component").alias("hi")),
                   "op9-groups", n_live)
    x = groups.select("h", F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("lo").alias("lo1"),
                      F.col("hi").alias("hi1"))
    y = groups.select("h", F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("lo").alias("lo2"),
                      F.col("hi").alias("hi2"))
    meet = store(x.join(y, "h").where(_may_link("na", "pa", "nb", "pb", num, den))
                 .where("(na < nb or na = nb and pa <= pb) and not (lo1 = hi1 and lo2 = hi2 and lo1 = lo2)")
                 .select("h", "na", "pa", "nb", "pb"), "op9-meet")
    left = post.select("h", F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("node").alias("u"),
                       F.col("component").alias("cu"))
    right = post.select("h", F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("node").alias("v"),
                        F.col("component").alias("cv"))
    pairs = (meet.join(left, ["h", "na", "pa"]).join(right, ["h", "nb", "pb"]).where("cu <> cv and u <> v"))
    swap = F.col("u") > F.col("v")
    return pairs.select(F.least("u", "v").alias("a"), F.when(swap, F.col("nb")).otherwise(F.col("na")).alias("na"),
                        F.greatest("u", "v").alias("b"), F.when(swap, F.col("na")).otherwise(F.col("nb")).alias("nb")
                        ).distinct()


def _verify(p: _Prepared, pairs: DataFrame, at_most: int | None, k: int, num: int, den: int
            ) -> tuple[DataFrame, DataFrame]:
    """(pairs looked at, links among them).  Sets are made again, only for documents in a pair that is left; a set is
    that of its class if the fingerprint says so.  ``at_most`` bounds the number of pairs, if that is known."""
    pairs = store(pairs, "op9-pairs", at_most)
    n_pairs = pairs.count()
    side = {x: p.profile.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("doc_id").alias(f"doc_{x}"),
                                F.col("fa").alias(f"fa_{x}"), F.col("cells").alias(f"cells_{x}")) for x in "ab"}
    near = store(pairs.join(side["a"], ["a", "na"]).join(side["b"], ["b", "nb"]).select(*_NEAR, "cells_a", "cells_b")
                 .mapInArrow(_suffix_filter(num, den), ", ".join(f"{c} long" for c in _NEAR)), "op9-near", n_pairs)
    n_near = near.count()
    needed = store(near.select(F.col("a").alias("node"), F.col("na").alias("n"), F.col("doc_a").alias("doc_id"),
                               F.col("fa_a").alias("fa"))
                   .union(near.select("b", "nb", "doc_b", "fa_b")).distinct(), "op9-needed", 2 * n_near)
    ids = store(needed.select("doc_id").distinct(), "op9-ids", 2 * n_near)
    rows = bloom.rows_of(p.docs, "doc_id", ids, ids.count())
    sets = store(rows.mapInArrow(_sets(k), "doc_id long, n long, fa long, grams array<long>")
                 .join(needed, ["doc_id", "n", "fa"]).select("node", "n", "grams"), "op9-sets",
                 40 * n_near).dropDuplicates(["node", "n"])
    sa = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("grams").alias("ga"))
    sb = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("grams").alias("gb"))
    overlap = F.size(F.array_intersect("ga", "gb")).cast("long")
    found = (near.join(sa, ["a", "na"]).join(sb, ["b", "nb"])
             .select("a", "b", F.col("na").alias("n_a"), F.col("nb").alias("n_b"), overlap.alias("overlap"))
             .where(f"({num} + {den}) * overlap >= {num} * (n_a + n_b)"))
    return pairs, store(found, "op9-links", 40 * n_near)
