"""Problem 6: evaluation texts that leak into training text.

The test items form a BM25 inverted index whose terms are pairs of neighbouring
words: single words say too little, as any two rare ones would reach the
threshold.  Every passage of every document is a query against it, answered document-at-a-time by block-max WAND: each term of
a passage has a cursor into its sorted postings, the pivot is the first item at
which the terms' greatest scores add up to the threshold, and where the maxima
of the pivot's block do not reach it, all cursors leap behind the block.  All
passages of a batch move in step, as arrays.  The threshold is no guess: it is,
for each item, the least BM25 score of any of its runs of ``RUN`` words, so no
passage that holds such a run can be skipped; items are numbered by ascending
threshold, so the one of the first cursor holds for all that follow.  Retrieved
pairs are verified word for word, for the item's question and its answer.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.session import durable

#: Consecutive words that make a leak.
RUN = 12
#: Words of a passage; neighbours overlap by RUN - 1, so every run lies inside one.
PASSAGE = 24
#: Items of a block of postings.
BLOCK = 4
#: Documents whose passages are looked up together, and passages whose cursors move in step.
DOCS_AT_ONCE = 256
PASSAGES_AT_ONCE = 8192
#: Characters of the items in one part of the index; every worker holds one part, a larger test set is searched part by part.
PART_CHARS = 4_000_000
K1, B = 1.2, 0.75

_ESCAPE = re.compile(r"\\+(?:u\{?([0-9a-fA-F]{4,6})\}?|x([0-9a-fA-F]{2})|U([0-9a-fA-F]{8})|[nrtbfv0])")
_LINE_NUMBER = re.compile(r"(?m)^([^\w\n]*)\d+[^\S\n]*[.):|\]\-][^\S\n]?")
_BARE_NUMBER = re.compile(r"(?m)^([^\w\n]*)\d+(?=\s)")
_LIST_MARK = re.compile(r"(?m)^([^\w\n]*)(?:\(?[a-zA-Z]\)|[a-zA-Z]\.|[ivxIVX]+[.)]|REM|rem|dnl)[^\S\n]")
_WORD = re.compile(r"[^\W_]+")


def _char(m: re.Match) -> str:
    code = m.group(1) or m.group(2) or m.group(3)
    if not code:
        return "\n"
    try:
        return chr(int(code, 16))
    except (ValueError, OverflowError):
        return " "


def plain_text(text: str) -> str:
    """Undo HTML and string escapes, width variants and invisible characters; lower case."""
    if "&" in text:
        text = html.unescape(html.unescape(text))
    if "\\" in text:
        text = _ESCAPE.sub(_char, text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
        if any(unicodedata.category(c) == "Cf" or "\ufe00" <= c <= "\ufe0f" or c == "\u034f" for c in set(text)):
            text = "".join(c for c in text if not (unicodedata.category(c) == "Cf" or "\ufe00" <= c <= "\ufe0f" or c == "\u034f"))
        text = unicodedata.normalize("NFKC", text.casefold())
    return text.lower()


def readings(text: str | None) -> list[list[str]]:
    """Word sequences a text may be read as: with what begins its lines, and without it.

    A number at the start of a line may be a line number or a word of the
    passage, so both readings are tried; null has none.
    """
    if not text:
        return []
    plain = plain_text(text)
    out = [plain]
    for pattern in (_LINE_NUMBER, _LIST_MARK, _BARE_NUMBER):
        for base in (out[0], out[-1]):
            other = pattern.sub(r"\1 ", base)
            if other not in out:
                out.append(other)
    read = []
    for t in out:
        words = _WORD.findall(t)
        if words not in read:
            read.append(words)
    return read


_ANSWER = re.compile(r"==\s*(.+)\s*\Z|>>>[^\n]*\n\s*([^\n]+)(?:\n\W*)?\Z")


def answer_of(text: str) -> str:
    """The answer that ends an item: what its last assertion or example call gives; empty where it states none."""
    m = _ANSWER.search(text)
    return next(g for g in m.groups() if g is not None) if m else ""


class ItemIndex:
    """BM25 postings of the items with block maxima, and their words for verification."""

    def __init__(self, items: list[tuple[int, str]], run: int = RUN):
        self.run = run
        words = [(i, _WORD.findall(plain_text(t or "")), _WORD.findall(plain_text(answer_of(t or "")))) for i, t in items]
        words = [x for x in words if len(x[1]) >= run]
        n = len(words)
        df = Counter(t for _, w, _ in words for t in set(pairwise(w)))
        mean = sum(len(w) for _, w, _ in words) / max(1, n)
        scored = []
        for item, w, answer in words:
            terms = list(pairwise(w))
            score = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * f * (K1 + 1) / (f + K1 * (1 - B + B * len(w) / mean)) for t, f in Counter(terms).items()}
            least = min(sum(score[t] for t in set(terms[k : k + run - 1])) for k in range(len(w) - run + 1))
            scored.append((least * (1 - 1e-9), item, w, answer, score))
        scored.sort(key=lambda x: x[:2])
        self.least = np.array([x[0] for x in scored])
        self.items = [x[1] for x in scored]
        self.words = [x[2] for x in scored]
        self.answers = [x[3] for x in scored]
        self.word = {w: k for k, w in enumerate(sorted({w for t in df for w in t}))}
        number = {t: k for k, t in enumerate(sorted(df))}
        self.term = np.array([self.word[a] * len(self.word) + self.word[b] for a, b in number], np.int64)
        #: Postings of all terms, by term and item; an end mark beyond every item closes the last list.
        triples = sorted((number[t], d, s) for d, x in enumerate(scored) for t, s in x[4].items())
        self.end = n
        self.width = n + 1
        self.key = np.array([t * self.width + d for t, d, _ in triples], np.int64)
        self.score = np.array([s for _, _, s in triples])
        term, doc = self.key // self.width, self.key % self.width
        self.term_at = np.searchsorted(term, np.arange(len(number) + 1))
        self.most = np.array([self.score[a:b].max() for a, b in zip(self.term_at[:-1], self.term_at[1:])])
        self.block_key, first = np.unique(term * self.width + doc // BLOCK, return_index=True)
        self.block_most = np.maximum.reduceat(self.score, first) if len(first) else np.zeros(0)
        self.runs = [{tuple(w[k : k + run]) for k in range(len(w) - run + 1)} for w in self.words]

    def _seek(self, terms: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each term, the first posting at or after an item: its place and its item (``end`` where there is none)."""
        at = np.searchsorted(self.key, terms * self.width + item)
        inside = at < self.term_at[terms + 1]
        return at, np.where(inside, self.key[np.minimum(at, len(self.key) - 1)] % self.width, self.end)

    def _block_bound(self, terms: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Greatest score of each term in the block of an item, 0 where the block has no posting of it."""
        key = terms * self.width + item // BLOCK
        at = np.minimum(np.searchsorted(self.block_key, key), len(self.block_key) - 1)
        return np.where(self.block_key[at] == key, self.block_most[at], 0.0)

    def retrieve(self, passages: np.ndarray) -> np.ndarray:
        """``(passage, item)`` rows of every item whose score for a passage reaches the item's threshold.

        ``passages`` has a row of term numbers for each passage, -1 for a pair that no item has.
        """
        if not len(self.items) or not passages.size:
            return np.zeros((0, 2), np.int64)
        terms = np.sort(passages, axis=1)
        terms[:, 1:][terms[:, 1:] == terms[:, :-1]] = -1
        most = np.where(terms >= 0, self.most[terms], 0.0)
        # the first pivot test: passages whose bounds never reach the least threshold have no pivot
        live = np.flatnonzero(most.sum(axis=1) >= self.least[0])
        found = [self._wand(live[k : k + PASSAGES_AT_ONCE], terms, most) for k in range(0, len(live), PASSAGES_AT_ONCE)]
        return np.concatenate(found) if found else np.zeros((0, 2), np.int64)

    def _wand(self, rows: np.ndarray, terms: np.ndarray, most: np.ndarray) -> np.ndarray:
        end = self.end
        rest_least = np.append(self.least, np.inf)
        terms, most = np.maximum(terms[rows], 0), most[rows]
        none = most == 0
        at, cur = self._seek(terms, np.zeros_like(terms))
        cur[none] = end
        out = []
        while len(rows):
            order = np.argsort(cur, axis=1, kind="stable")
            terms, most, at, cur = (np.take_along_axis(x, order, axis=1) for x in (terms, most, at, cur))
            reach = np.cumsum(most, axis=1) >= rest_least[cur[:, 0]][:, None]
            pivot_at = reach.argmax(axis=1)
            pivot = np.where(reach.any(axis=1), np.take_along_axis(cur, pivot_at[:, None], axis=1)[:, 0], end)
            on = pivot < end
            if not on.all():
                rows, terms, most, at, cur, pivot = (x[on] for x in (rows, terms, most, at, cur, pivot))
                if not len(rows):
                    break
            upto = cur <= pivot[:, None]  # the terms that can score the pivot
            ahead = np.broadcast_to(pivot[:, None], cur.shape)
            bound = np.where(upto, self._block_bound(terms, ahead), 0.0).sum(axis=1)
            leap = bound < self.least[pivot]
            ready = ~leap & (cur[:, 0] == pivot)
            if ready.any():
                here = cur[ready] == pivot[ready, None]
                total = np.where(here, self.score[np.minimum(at[ready], len(self.score) - 1)], 0.0).sum(axis=1)
                hit = total >= self.least[pivot[ready]]
                out.append(np.stack([rows[ready][hit], pivot[ready][hit]], axis=1))
            # behind the block, but not past a cursor that the bound did not count; behind a scored pivot; or up to the pivot
            beyond = np.where(upto, end, cur).min(axis=1)
            goal = np.where(leap, np.minimum((pivot // BLOCK + 1) * BLOCK, np.maximum(beyond, pivot + 1)), np.where(ready, pivot + 1, pivot))
            goal = np.minimum(goal, end)
            move = upto & (cur < goal[:, None])
            at_new, cur_new = self._seek(terms[move], np.broadcast_to(goal[:, None], cur.shape)[move])
            at[move], cur[move] = at_new, cur_new
        return np.concatenate(out) if out else np.zeros((0, 2), np.int64)

    def terms(self, words: list[str]) -> np.ndarray:
        """Numbers of the pairs of neighbouring words, -1 for a pair that no item has."""
        ids = np.fromiter(map(self.word.get, words, repeat(-1)), np.int64, len(words))
        a, b = ids[:-1], ids[1:]
        out = np.full(len(a), -1, np.int64)
        known = np.flatnonzero((a >= 0) & (b >= 0))
        if len(known) and len(self.term):
            key = a[known] * len(self.word) + b[known]
            at = np.minimum(np.searchsorted(self.term, key), len(self.term) - 1)
            out[known] = np.where(self.term[at] == key, at, -1)
        return out

    def leaks(self, sequences: list[list[str]]) -> list[dict[int, set]]:
        """For each word sequence, the items of which it holds a run, with the starts of the runs.

        All passages of all sequences are one batch of queries.
        """
        step = PASSAGE - self.run + 1
        flat, origin = [], []
        for r, words in enumerate(sequences):
            starts = np.arange(0, max(1, len(words) - self.run + 1), step)
            ids = np.concatenate([self.terms(words), np.full(PASSAGE, -1)])
            flat.append(ids[starts[:, None] + np.arange(PASSAGE - 1)])
            origin.append(np.stack([np.full(len(starts), r), starts], axis=1))
        found: list[dict[int, set]] = [{} for _ in sequences]
        if not flat:
            return found
        passages, source = np.concatenate(flat), np.concatenate(origin)
        for p, d in self.retrieve(passages).tolist():
            r, s = source[p].tolist()
            passage = sequences[r][s : s + PASSAGE]
            for k in range(len(passage) - self.run + 1):
                if tuple(passage[k : k + self.run]) in self.runs[d]:
                    found[r].setdefault(d, set()).add(s + k)
        return found

    def overlap(self, d: int, words: list[str], starts: set[int]) -> tuple[int, float, float | None]:
        """Of an item that leaked: the longest stretch in words, the share of its runs, and the share of its answer's words that follow."""
        longest = stretch = 0
        for k in sorted(starts):
            stretch = stretch + 1 if k - 1 in starts else 1
            longest = max(longest, stretch)
        seen = {tuple(words[k : k + self.run]) for k in starts}
        answer = self.answers[d]
        near = Counter(words[min(starts) : max(starts) + self.run + len(self.words[d])])
        share = sum((Counter(answer) & near).values()) / len(answer) if answer else None
        return longest + self.run - 1, len(seen) / len(self.runs[d]), share


def item_parts(benchmark: DataFrame, run: int = RUN, part_chars: int = PART_CHARS) -> Iterator[ItemIndex]:
    """Indexes of a test set (``item_id, text``), one for each ``part_chars`` characters, about; one part at a time is in memory."""
    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = 1 + size // part_chars
    part = F.pmod(F.xxhash64("item_id"), F.lit(parts))
    for k in range(parts):
        rows = items.where(part == k).distinct().collect()  # about ``part_chars`` characters
        yield ItemIndex(sorted((r["item_id"], r["text"]) for r in rows), run)


def leaks(documents: DataFrame, benchmark: DataFrame, run: int = RUN, part_chars: int = PART_CHARS) -> DataFrame:
    """``doc_id, item_id, run_words, item_share, answer_share`` of every document that holds a run of an item.

    ``run_words`` is the longest stretch of the item found, ``item_share`` the
    share of the item's runs that occur, ``answer_share`` the share of the words
    of its answer that stand with them (null where the item states none).  Null
    or empty texts leak nothing, rows without ``doc_id`` or ``item_id`` cannot be
    named, equal texts under several ids are each reported.  Documents are
    scanned where they lie, once for each part of the index: nothing is shuffled.
    """
    found = [_scan(documents, ix) for ix in item_parts(benchmark, run, part_chars)]
    if len(found) > 1:
        found = [durable(x) for x in found]
    whole = found[0]
    for x in found[1:]:
        whole = whole.unionByName(x)
    return whole


def _scan(documents: DataFrame, index: ItemIndex) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(index)  # PART_CHARS characters of items
    types = (pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64())
    names = ["doc_id", "item_id", "run_words", "item_share", "answer_share"]

    def scan(batches):
        ix = shared.value
        for b in batches:
            out = []
            for at in range(0, b.num_rows, DOCS_AT_ONCE):
                part = b.slice(at, DOCS_AT_ONCE)
                read = [(i, words) for i, text in enumerate(part.column(1).to_pylist()) for words in readings(text)]
                best: dict[tuple, tuple] = {}
                for (i, words), found in zip(read, ix.leaks([w for _, w in read])):
                    for d, starts in found.items():
                        new = ix.overlap(d, words, starts)
                        best[i, d] = max(best.get((i, d), (0,)), new, key=lambda x: tuple(v or 0.0 for v in x))
                ids = part.column(0).to_pylist()
                out += [(ids[i], ix.items[d], *v) for (i, d), v in best.items()]
            cols = list(zip(*out)) if out else [()] * len(types)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    scanned = documents.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long"), "text")
    return scanned.mapInArrow(scan, "doc_id long, item_id long, run_words int, item_share double, answer_share double")
