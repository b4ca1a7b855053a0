"""Problem 3: near-duplicate examples by exact set similarity search.

Token-group matrix.  A text is the set of its runs of ``WIDTH`` words, each
run hashed to 64 bits (a *token*).  Texts with the same set form one class.
Classes are partitioned into groups of similar texts, those with the same
rarest token; near copies nearly always share it.  The matrix says which groups
hold a token.  A query text Q and a group G are bounded twice before any set is
moved:

1. In any common order of the tokens, two sets of similarity t share at least a
   share L of their tokens among the first (1 - t + L) of either.  So only that
   prefix of each set is kept in the matrix, rarest first, and a group that
   holds fewer of a query's prefix tokens is passed over.
2. The token union of each group is stored, as ``BITS`` hash bits.  For every S in G

       |Q and S| / |Q or S|  <=  |Q and union(G)| / |Q|

   and every bit of Q that the union has not stands for at least one token that
   is missing, so a group whose bound is below the threshold is never opened.

The sets of the groups that qualify are compared in full, so the result is exact.
A token that a third of all texts hold has its queries spread over many tasks,
each with the few rows of the matrix that name its groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.forest import spanning_forest
from gristmill.llm.wordhash import mix, word_hashes
from gristmill.session import durable

#: Words in a run.
WIDTH = 3
#: Buckets of the token counts that order the tokens: 8 MB, whatever the data's size.
COUNT_BUCKETS = 1 << 21
COUNT_CHUNKS = 64
#: Members of a group that are compared in one task, and queries that meet them there.
GROUP_MEMBERS = 1024
GROUP_QUERIES = 4096
#: A class of equal texts of up to so many ids is written as all its pairs, a larger one as pairs with its least id.
EXPAND_CLASS = 32
#: Ids up to this number may be broadcast to pick the texts that are compared.
BROADCAST_IDS = 250_000
#: Postings of one partition of the matrix.
BUCKET_POSTINGS = 1_000_000
#: Queries of one token that stay together; the queries of a token in more texts than this are spread.
HOT = 250_000
#: Bits of a stored union, in whole words of 64, and the columns that hold them.
BITS = 512
WORDS_OF = [f"b{i}" for i in range(BITS // 64)]
#: Pairs of a query and a row of the matrix that are looked at together.
MEETINGS = 2_000_000
#: Share of a set's tokens by which its prefix is longer than the least, and which a group must hold of it.
EXTRA = 0.06

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def token_sets(texts: list[str], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct tokens of each text, end to end, and the offsets of the texts.

    A text of fewer than ``width`` words, but at least one, is one token; a text
    without words has none.
    """
    ids, counts = word_hashes(texts)
    total = len(ids)
    start = np.concatenate([[0], np.cumsum(counts)])
    with np.errstate(over="ignore"):
        h = np.zeros(total, np.uint64)
        room = np.repeat(start[1:], counts) - np.arange(total)  # words from here to the text's end
        short = np.repeat(counts < width, counts)
        for k, m in zip(range(width), [_M1, _M2, _M3] * width):
            shifted = np.zeros(total, np.uint64)
            if total > k:
                shifted[: total - k] = ids[k:]
            shifted[room <= k] = np.uint64(0x9E37)
            h = mix(h * m + shifted + np.uint64(k + 1))
        first = np.zeros(total, bool)
        first[start[:-1][counts > 0]] = True
        keep = np.where(short, first, room >= width)
    doc = np.repeat(np.arange(len(texts)), counts)[keep]
    tok = h[keep]
    order = np.lexsort((tok, doc))
    doc, tok = doc[order], tok[order]
    new = np.ones(len(tok), bool)
    new[1:] = (tok[1:] != tok[:-1]) | (doc[1:] != doc[:-1])
    doc, tok = doc[new], tok[new]
    return tok, np.searchsorted(doc, np.arange(len(texts) + 1))


def dedup_text(messages: pa.Array) -> list[str]:
    """Contents of the user and assistant messages of each row, joined by line feeds."""
    flat = messages.flatten()
    role, content = (flat.field(f).to_pylist() for f in ("role", "content")) if len(flat) else ([], [])
    out, at = [], 0
    for n in np.asarray(pa.compute.fill_null(pa.compute.list_value_length(messages), 0)).tolist():
        out.append("\n".join(content[i] or "" for i in range(at, at + n) if role[i] in ("user", "assistant")))
        at += n
    return out


def _extra(n: np.ndarray) -> np.ndarray:
    return np.maximum(1, np.floor(EXTRA * n + 1e-9).astype(np.int64))


def _prefix(n: np.ndarray, threshold: float) -> np.ndarray:
    """Tokens of the prefix of sets of ``n`` tokens."""
    return np.where(n > 0, n - np.ceil(threshold * n - 1e-9).astype(np.int64) + _extra(n), 0)


def _held(n: np.ndarray, threshold: float) -> np.ndarray:
    """Prefix tokens of a set of ``n`` that a similar set of at most ``n`` tokens holds in its own prefix."""
    return _extra(np.ceil(threshold * n - 1e-9).astype(np.int64))


def _class_refs(tok: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each token set."""
    n = np.diff(off)
    with np.errstate(over="ignore"):
        out = []
        for m in (_M1, _M2):
            sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(tok ^ m), dtype=np.uint64)])
            out.append(mix(sums[off[1:]] - sums[off[:-1]] + n.astype(np.uint64)))
    return out[0], out[1]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    for b in batches:
        for at in range(0, b.num_rows, 1000):
            part = b.slice(at, 1000)
            yield part.column(0).to_pylist(), dedup_text(part.column(1))


def token_counts(examples: DataFrame, width: int) -> np.ndarray:
    """In how many texts the tokens of each bucket occur: fixed size, counted over all texts."""

    def count(batches):
        seen = np.zeros(COUNT_BUCKETS, np.int64)
        for _, texts in _texts(batches):
            tok, _ = token_sets(texts, width)
            seen += np.bincount((tok & np.uint64(COUNT_BUCKETS - 1)).astype(np.int64), minlength=COUNT_BUCKETS)
        if seen.any():
            size = COUNT_BUCKETS // COUNT_CHUNKS
            yield pa.record_batch([pa.array(range(COUNT_CHUNKS), pa.int32()), pa.array([seen[i * size : (i + 1) * size].astype(np.int64).tobytes() for i in range(COUNT_CHUNKS)], pa.binary())], names=["chunk", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(COUNT_BUCKETS // COUNT_CHUNKS, np.int64)
        for x in table.column("counts").to_pylist():
            total += np.frombuffer(x, np.int64)
        small = np.minimum(total, 2**31 - 1).astype(np.int32)
        return pa.table({"chunk": table.column("chunk")[:1], "counts": pa.array([small.tobytes()], pa.binary())})

    parts = examples.mapInArrow(count, "chunk int, counts binary").groupBy("chunk").applyInArrow(add, "chunk int, counts binary").collect()  # 64 rows, 8 MB
    out = np.zeros(COUNT_BUCKETS, np.int32)
    size = COUNT_BUCKETS // COUNT_CHUNKS
    for r in parts:
        out[r["chunk"] * size : (r["chunk"] + 1) * size] = np.frombuffer(r["counts"], np.int32)
    return out


def _bits(tok: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Hash bits of each text's tokens, a row of words for each text."""
    at = (mix(tok ^ _M3) >> np.uint64(40)).astype(np.int64) % BITS
    out = np.zeros((docs, BITS), np.uint8)
    out[doc, at] = 1
    return np.packbits(out, axis=1, bitorder="little").view(np.uint64)


def _pack(where: np.ndarray, tok: np.ndarray, cls: np.ndarray, n: np.ndarray, grp: np.ndarray, role: np.ndarray) -> list[tuple]:
    """Postings by bucket as packed arrays; the class of a posting is an index into the packed classes."""
    order = np.argsort(where, kind="stable")
    where, tok, cls, n, grp, role = (x[order] for x in (where, tok, cls, n, grp, role))
    cuts = np.flatnonzero(np.diff(where, prepend=-1, append=-1))
    rows = []
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        c, first, inv = np.unique(cls[lo:hi], return_index=True, return_inverse=True)
        parts = tok[lo:hi], inv.astype(np.uint32), c, n[lo:hi][first].astype(np.int32), grp[lo:hi][first], role[lo:hi]
        rows.append((int(where[lo]), *(x.tobytes() for x in parts)))
    return rows


_BOTH, _QUERY, _GROUP = 0, 1, 2


def _sketch(examples: DataFrame, counts: np.ndarray, buckets: int, threshold: float, width: int) -> DataFrame:
    """One scan gives both a row for each text and, by bucket of tokens, the prefixes.

    Kind 0: ``id, c1, c2`` (class), ``n`` (tokens), ``grp`` (the rarest token:
    the group), and the text's hash bits.  Kind 1: ``bucket`` and packed arrays:
    tokens, the class each belongs to, the classes' references, sizes and groups,
    and whether a posting is a query, a row of the matrix or both.  A token that
    only one text holds is not listed.  Of a hot token the queries are spread over
    parts, and every part gets its rows of the matrix, one for each group and size.
    """
    shared = examples.sparkSession.sparkContext.broadcast(counts)  # 8 MB, whatever the data's size
    schema = "kind int, id string, c1 long, c2 long, n int, grp long, " + ", ".join(f"{b} long" for b in WORDS_OF) + ", bucket int, tok binary, idx binary, cls binary, sizes binary, groups binary, roles binary"
    names = [c.split()[0] for c in schema.split(", ")]
    packed = names[names.index("bucket") + 1 :]

    def none(t, m):
        return pa.nulls(m, t)

    def postings(rows: list[tuple]) -> pa.RecordBatch:
        m, cols = len(rows), list(zip(*rows))
        first = [pa.array(np.ones(m, np.int32)), none(pa.string(), m), none(pa.int64(), m), none(pa.int64(), m), none(pa.int32(), m), none(pa.int64(), m), *[none(pa.int64(), m)] * len(WORDS_OF)]
        return pa.record_batch([*first, pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]], names=names)

    def place(mixed: np.ndarray, part: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix(mixed + part.astype(np.uint64) * _M1) % np.uint64(buckets)).astype(np.int64)

    def compact(hot: list[tuple]) -> list[tuple]:
        """Of equal token, group and size the least class."""
        mixed, cls, n, grp, parts = (np.concatenate(x) for x in zip(*hot))
        order = np.lexsort((cls, n, grp, mixed))
        mixed, cls, n, grp, parts = (x[order] for x in (mixed, cls, n, grp, parts))
        new = np.ones(len(mixed), bool)
        new[1:] = (mixed[1:] != mixed[:-1]) | (n[1:] != n[:-1]) | (grp[1:] != grp[:-1])
        return [tuple(x[new] for x in (mixed, cls, n, grp, parts))]

    def scan(batches):
        count = shared.value
        hot: list[tuple] = []
        for ids, texts in _texts(batches):
            tok, off = token_sets(texts, width)
            n = np.diff(off)
            c1, c2 = _class_refs(tok, off)
            doc = np.repeat(np.arange(len(ids)), n)
            bits = _bits(tok, doc, len(ids))
            freq = count[(tok & np.uint64(COUNT_BUCKETS - 1)).astype(np.int64)]
            order = np.lexsort((tok, freq, doc))
            tok, doc, freq = tok[order], doc[order], freq[order]
            grp = np.zeros(len(ids), np.uint64)
            grp[n > 0] = tok[off[:-1][n > 0]]
            k = len(ids)
            i64 = lambda a: pa.array(np.ascontiguousarray(a).view(np.int64))
            yield pa.record_batch(
                [pa.array(np.zeros(k, np.int32)), pa.array(ids, pa.string()), i64(c1), i64(c2), pa.array(n.astype(np.int32)), i64(grp), *[i64(bits[:, b]) for b in range(bits.shape[1])], none(pa.int32(), k), *[none(pa.binary(), k)] * len(packed)],
                names=names,
            )
            rank = np.arange(len(tok)) - off[:-1][doc]
            _, first = np.unique(c1, return_index=True)  # of equal texts in this batch, one
            keep = (rank < _prefix(n, threshold)[doc]) & np.isin(doc, first) & (freq > 1)
            tok, doc, freq = tok[keep], doc[keep], freq[keep]
            if not len(tok):
                continue
            mixed = mix(tok)
            short = (mixed >> np.uint64(32)).astype(np.uint32)  # a rare clash only makes a bound larger
            parts = -(-freq.astype(np.int64) // HOT)
            spread = np.where(parts > 1, (c1[doc] >> np.uint64(20)).astype(np.int64) % parts, 0)
            role = np.where(parts > 1, _QUERY, _BOTH).astype(np.uint8)
            yield postings(_pack(place(mixed, spread), short, c1[doc], n[doc], grp[doc], role))
            of_hot = parts > 1
            if of_hot.any():
                d = doc[of_hot]
                hot.append((mixed[of_hot], c1[d], n[d], grp[d], parts[of_hot]))
                if sum(len(x[0]) for x in hot) > MEETINGS:
                    hot = compact(hot)
        if hot:
            for mixed, cls, n, grp, parts in compact(hot):
                rows = np.repeat(np.arange(len(mixed)), parts)
                part = np.arange(len(rows)) - np.repeat(np.cumsum(parts) - parts, parts)
                mixed, cls, n, grp = mixed[rows], cls[rows], n[rows], grp[rows]
                short = (mixed >> np.uint64(32)).astype(np.uint32)
                yield postings(_pack(place(mixed, part), short, cls, n, grp, np.full(len(rows), _GROUP, np.uint8)))

    return examples.mapInArrow(scan, schema)


def _meet(threshold: float, tok: np.ndarray, cls: np.ndarray, n: np.ndarray, grp: np.ndarray, role: np.ndarray) -> Iterator[tuple]:
    """``query, group, tokens held, tokens needed`` for the postings of one bucket.

    Of two classes the one with more tokens (then the greater reference) is the
    query, so each pair is met once.
    """
    held = role != _QUERY
    m_tok, m_cls, m_n, m_grp = (x[held] for x in (tok, cls, n, grp))
    order = np.lexsort((m_cls, m_grp, m_n, m_tok))
    m_tok, m_cls, m_n, m_grp = (x[order] for x in (m_tok, m_cls, m_n, m_grp))
    new = np.ones(len(m_tok), bool)
    new[1:] = (m_tok[1:] != m_tok[:-1]) | (m_n[1:] != m_n[:-1]) | (m_grp[1:] != m_grp[:-1])
    m_tok, m_cls, m_n, m_grp = (x[new] for x in (m_tok, m_cls, m_n, m_grp))
    asks = role != _GROUP
    q_tok, q_cls, q_n = (x[asks] for x in (tok, cls, n))
    order = np.lexsort((q_cls, q_tok))
    q_tok, q_cls, q_n = (x[order] for x in (q_tok, q_cls, q_n))
    new = np.ones(len(q_tok), bool)
    new[1:] = (q_tok[1:] != q_tok[:-1]) | (q_cls[1:] != q_cls[:-1])
    q_tok, q_cls, q_n = (x[new] for x in (q_tok, q_cls, q_n))
    key = lambda t, k: (t.astype(np.uint64) << np.uint64(32)) | k.astype(np.uint64)
    have = key(m_tok, m_n)
    lo = np.searchsorted(have, key(q_tok, np.ceil(threshold * q_n - 1e-9)), "left")
    hi = np.searchsorted(have, key(q_tok, q_n), "right")
    width = np.maximum(hi - lo, 0)
    need = _held(q_n.astype(np.int64), threshold)
    ends = np.cumsum(width)
    at = 0
    while at < len(width):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + MEETINGS, "right")))
        w = width[at:to]
        q = np.repeat(np.arange(at, to), w)
        m = np.arange(len(q)) - np.repeat(np.cumsum(w) - w, w) + lo[q]
        at = to
        ok = (m_n[m] < q_n[q]) | (m_cls[m] < q_cls[q])
        q, g = q[ok], m_grp[m[ok]]
        if not len(q):
            continue
        order = np.lexsort((g, q))
        q, g = q[order], g[order]
        new = np.ones(len(q), bool)
        new[1:] = (q[1:] != q[:-1]) | (g[1:] != g[:-1])
        q, g = q[new], g[new]
        with np.errstate(over="ignore"):
            _, one, count = np.unique(mix(q_cls[q] ^ mix(g)), return_index=True, return_counts=True)
        yield q_cls[q][one], g[one], count, need[q][one]


def _candidates(matrix: DataFrame, buckets: int, threshold: float) -> DataFrame:
    """``q, grp``: classes and the groups that hold enough of their prefix tokens."""
    cols = ("bucket", "tok", "idx", "cls", "sizes", "groups", "roles")

    def meet(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        if parts:
            for q, g, held, need in _meet(threshold, *(np.concatenate(x) for x in zip(*parts))):
                yield pa.record_batch([pa.array(q.view(np.int64)), pa.array(g.view(np.int64)), pa.array(held.astype(np.int32)), pa.array(need.astype(np.int32))], names=["q", "grp", "held", "need"])

    def probe(batches):
        """Rows come sorted by bucket: one bucket at a time is in memory."""
        at, parts = None, []
        for b in batches:
            for bucket, tok, idx, cls, sizes, groups, roles in zip(*(b.column(c).to_pylist() for c in cols)):
                if bucket != at:
                    yield from meet(parts)
                    at, parts = bucket, []
                i = np.frombuffer(idx, np.uint32)
                parts.append((np.frombuffer(tok, np.uint32), np.frombuffer(cls, np.uint64)[i], np.frombuffer(sizes, np.int32)[i], np.frombuffer(groups, np.uint64)[i], np.frombuffer(roles, np.uint8)))
        yield from meet(parts)

    spread = matrix.where("kind = 1").select(*cols).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    held = spread.mapInArrow(probe, "q long, grp long, held int, need int").groupBy("q", "grp").agg(F.sum("held").alias("held"), F.max("need").alias("need"))
    return held.where("held >= need").select("q", "grp")


def _within_bound(cand: DataFrame, some: DataFrame, sketch: DataFrame, threshold: float) -> DataFrame:
    """``grp, cls, c1, members`` of the queries that the stored union of a group may hold enough tokens of.

    Only the bits of the classes concerned, queries and members of a group asked, leave the sketch.
    """
    inside = durable(some.join(cand.select("grp").distinct(), "grp").select("grp", "c1"))
    needed = durable(inside.select("c1").unionByName(cand.select(F.col("q").alias("c1"))).distinct())
    small = needed.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    bits = sketch.where("kind = 0").select("c1", *WORDS_OF).join(F.broadcast(needed) if small else needed, "c1", "left_semi")
    bits = durable(bits.groupBy("c1").agg(*[F.max(b).alias(b) for b in WORDS_OF]))  # the same for all texts of a class
    unions = inside.join(bits, "c1").groupBy("grp").agg(F.count("*").alias("members"), *[F.bit_or(b).alias(f"u{b}") for b in WORDS_OF])
    asks = some.select("c1", "cls", "n").join(bits, "c1").withColumnRenamed("c1", "q")
    missing = sum((F.bit_count(F.col(b).bitwiseAND(F.bitwise_not(F.col(f"u{b}")))) for b in WORDS_OF[1:]), F.bit_count(F.col(WORDS_OF[0]).bitwiseAND(F.bitwise_not(F.col(f"u{WORDS_OF[0]}")))))
    bounded = cand.join(unions, "grp").join(asks, "q").where(F.col("n") - missing >= threshold * F.col("n") - 1e-9)
    return bounded.select("grp", "cls", F.col("q").alias("c1"), "members")


def similar_classes(examples: DataFrame, threshold: float = 0.7, width: int = WIDTH, spanning: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(members, links)`` for ``examples (id, messages)``.

    ``members``: ``id, cls`` for every id, ``cls`` being the least id with the
    same set of tokens, and ``n``, the number of tokens.  ``links``: ``a, b,
    similarity`` for every two classes of at least ``threshold``, ``a < b``.
    With ``spanning``, ``links`` has of the links found together only those that
    join two so far unjoined classes, and, as rows without ``b``, the number
    of links of each class in ``similarity``: what groups need, in room that grows
    with the classes and not with their pairs.  Rows of one id are one example.
    Texts without words are in no link and each its own class.  Null messages or
    contents count as empty.
    """
    wanted = examples.where("id is not null").select("id", "messages")
    counts = token_counts(wanted, width)
    postings = float(counts.sum(dtype=np.int64)) * (1 - threshold + EXTRA)
    buckets = max(16, math.ceil(postings / BUCKET_POSTINGS))
    sketch = durable(_sketch(wanted, counts, buckets, threshold, width))
    docs = sketch.where("kind = 0").groupBy("id").agg(F.max(F.struct("c1", "c2", "n", "grp")).alias("d")).select("id", "d.*")
    alone = F.when(F.col("n") == 0, F.xxhash64("id")).otherwise(F.lit(0).cast("long"))
    docs = docs.withColumn("alone", alone)
    classes = durable(docs.groupBy("c1", "c2", "alone").agg(F.min("id").alias("cls"), *[F.first(c).alias(c) for c in ("n", "grp")]))
    members = durable(docs.select("id", "c1", "c2", "alone").join(classes.select("c1", "c2", "alone", "cls", "n"), ["c1", "c2", "alone"]).select("id", "cls", "n"))

    some = classes.where("n > 0")
    held = durable(_candidates(sketch, buckets, threshold))
    cand = durable(_within_bound(held, some, sketch, threshold))
    asked = cand.groupBy("grp").agg(F.count("*").alias("queries"), F.max("members").alias("members"))
    asked = asked.select("grp", F.ceil(F.col("members") / GROUP_MEMBERS).cast("int").alias("mparts"), F.ceil(F.col("queries") / GROUP_QUERIES).cast("int").alias("qparts"))
    asked = durable(asked)
    part = lambda key, n: F.pmod(F.xxhash64(key), F.greatest(F.lit(1), F.col(n))).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    queries = cand.join(asked, "grp").withColumn("qp", part("cls", "qparts")).withColumn("mp", every("mparts")).select("grp", "mp", "qp", "cls", "c1", F.lit(True).alias("query"))
    opened = some.join(asked, "grp").withColumn("mp", part("cls", "mparts")).withColumn("qp", every("qparts")).select("grp", "mp", "qp", "cls", "c1", F.lit(False).alias("query"))
    meets = durable(queries.unionByName(opened))
    needed = durable(meets.select("cls").distinct())
    small = needed.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    compared = wanted.withColumnRenamed("id", "cls").join(F.broadcast(needed) if small else needed, "cls", "left_semi")

    def sets(batches):
        for ids, texts in _texts(batches):
            tok, off = token_sets(texts, width)
            yield pa.record_batch([pa.array(ids, pa.string()), pa.array([tok[a:b].tobytes() for a, b in zip(off, off[1:])], pa.binary())], names=["cls", "tok"])

    def open_group(rows: list[tuple]) -> list[tuple]:
        """Compare each query of one group with the members that the pair is met with: those of fewer tokens."""
        mask = (1 << 64) - 1
        members = {cls: (c1 & mask, np.frombuffer(tok, np.uint64)) for cls, c1, query, tok in rows if not query}
        names = list(members)
        if not names:
            return []
        sizes = np.array([len(members[x][1]) for x in names])
        refs = np.array([members[x][0] for x in names], np.uint64)
        tok = np.concatenate([members[x][1] for x in names])
        of = np.repeat(np.arange(len(names)), sizes)
        order = np.argsort(tok, kind="stable")
        tok, of = tok[order], of[order]
        out = []
        root: dict[str, str] = {}
        degree: dict[str, int] = {}

        def find(x: str) -> str:
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for cls, (ref, mine) in {cls: (np.uint64(c1 & mask), np.frombuffer(t, np.uint64)) for cls, c1, query, t in rows if query}.items():
            lo, hi = np.searchsorted(tok, mine, "left"), np.searchsorted(tok, mine, "right")
            in_union = hi > lo
            if in_union.sum() < threshold * len(mine) - 1e-9:
                continue  # the bound by the union itself
            lo, n = lo[in_union], (hi - lo)[in_union]
            hits = of[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
            common = np.bincount(hits, minlength=len(names))
            similar = (common >= threshold * (len(mine) + sizes - common) - 1e-9) & ((sizes < len(mine)) | ((sizes == len(mine)) & (refs < ref)))
            for m in np.flatnonzero(similar):
                a, b = min(cls, names[m]), max(cls, names[m])
                if spanning:
                    degree[a], degree[b] = degree.get(a, 0) + 1, degree.get(b, 0) + 1
                    ra, rb = find(a), find(b)
                    if ra == rb:
                        continue
                    root[ra] = rb
                out.append((a, b, float(common[m] / (len(mine) + sizes[m] - common[m]))))
        return out + [(x, None, float(k)) for x, k in degree.items()]

    def open_groups(batches):
        """Rows come sorted by group: one group at a time is in memory."""
        at, rows = None, []
        for b in batches:
            out = []
            for grp, mp, qp, *row in zip(*(b.column(c).to_pylist() for c in ("grp", "mp", "qp", "cls", "c1", "query", "tok"))):
                if (grp, mp, qp) != at:
                    out += open_group(rows)
                    at, rows = (grp, mp, qp), []
                rows.append(row)
            yield _links(out)
        yield _links(open_group(rows))

    def _links(out: list[tuple]) -> pa.RecordBatch:
        a, b, s = zip(*out) if out else ((), (), ())
        return pa.record_batch([pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(s, pa.float64())], names=["a", "b", "similarity"])

    texts = compared.mapInArrow(sets, "cls string, tok binary").groupBy("cls").agg(F.first("tok").alias("tok"))
    meeting = meets.join(texts, "cls").select("grp", "mp", "qp", "cls", "c1", "query", "tok").repartition("grp", "mp", "qp")
    links = meeting.sortWithinPartitions("grp", "mp", "qp").mapInArrow(open_groups, "a string, b string, similarity double")
    return members, durable(links)


def near_pairs(members: DataFrame, links: DataFrame, expand: int = EXPAND_CLASS) -> DataFrame:
    """``id_a, id_b`` (id_a < id_b) of near or full duplicates.

    All pairs of ids where the classes have up to ``expand`` ids; the ids of a
    larger class of equal texts are paired with its least id only, which stands
    for it in the links.
    """
    size = members.groupBy("cls").agg(F.count("*").alias("k"))
    sized = durable(members.where("n > 0").join(size, "cls").select("cls", "id", "k"))
    stands = sized.where((F.col("k") <= expand) | (F.col("id") == F.col("cls")))
    a, b = (stands.select(F.col("cls").alias(c), F.col("id").alias(f"id_{c}")) for c in "ab")
    across = links.select("a", "b").join(a, "a").join(b, "b").select("id_a", "id_b")
    small = sized.where(f"k > 1 and k <= {int(expand)}").groupBy("cls").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    inner = small.select(F.posexplode("ids").alias("i", "id_a"), "ids").select("id_a", F.explode(F.slice("ids", F.col("i") + 2, F.size("ids"))).alias("id_b"))
    large = sized.where((F.col("k") > expand) & (F.col("id") != F.col("cls"))).select(F.col("cls").alias("id_a"), F.col("id").alias("id_b"))
    return across.unionByName(inner).unionByName(large).select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))


def near_groups(members: DataFrame, links: DataFrame) -> DataFrame:
    """``id, cls, grp, links``: for every id its class, its group (the tree of the links) and its class's links to other texts.

    ``links`` are all links or, of a ``spanning`` search, those that span the groups and the counts.
    """
    labels, _ = spanning_forest(links.where("b is not null").select(F.col("a").alias("u"), F.col("b").alias("v")))
    least = labels.groupBy("root").agg(F.min("node").alias("grp"))
    labels = labels.join(least, "root").select(F.col("node").alias("cls"), "grp")
    counted = links.where("b is null").select(F.col("a").alias("cls"), F.col("similarity").cast("long").alias("k"))
    if counted.isEmpty():
        counted = links.select(F.explode(F.array("a", "b")).alias("cls"), F.lit(1).cast("long").alias("k"))
    degree = counted.groupBy("cls").agg(F.sum("k").alias("links"))
    return members.join(labels, "cls", "left").join(degree, "cls", "left").select("id", "cls", F.coalesce("grp", "cls").alias("grp"), F.coalesce("links", F.lit(0)).cast("long").alias("links"))
