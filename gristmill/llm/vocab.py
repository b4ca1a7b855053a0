"""The existing tokenizer of table ``tokenizer_vocab``: exact token counts.

White space parts a text and costs nothing.  From left to right the longest
piece that matches is one token; a character that no piece fits costs one token
for each byte of its UTF-8 form.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A vocabulary is held by the driver and by each worker; a table beyond this size is refused.
MAX_PIECES = 2_000_000
#: Distinct words whose count a worker keeps.
CACHE_WORDS = 400_000


class Vocab:
    """Greedy longest-match tokenizer over a fixed set of pieces."""

    def __init__(self, pieces: Iterable[str]):
        self.pieces = frozenset(p for p in pieces if p)
        self.longest = max(map(len, self.pieces), default=1)
        self._joined = frozenset(p[i : i + 2] for p in self.pieces for i in range(len(p) - 1))
        self._counts: dict[str, int] | None = None

    def __getstate__(self):
        return self.pieces

    def __setstate__(self, pieces):
        self.__init__(pieces)

    def _word(self, word: str) -> int:
        pieces, n, i, end = self.pieces, 0, 0, len(word)
        while i < end:
            for j in range(min(end, i + self.longest), i, -1):
                if word[i:j] in pieces:
                    n += 1
                    i = j
                    break
            else:
                n += len(word[i].encode("utf-8", "surrogatepass"))
                i += 1
        return n

    def count(self, text: str | None) -> int:
        """Tokens of a text; null counts as empty."""
        if not text:
            return 0
        if self._counts is None:
            outer = self

            class Counts(dict):
                def __missing__(self, word: str) -> int:
                    n = outer._word(word)
                    if len(word) <= 64:
                        if len(self) >= CACHE_WORDS:
                            self.clear()
                        self[word] = n
                    return n

            self._counts = Counts()
        return sum(map(self._counts.__getitem__, text.split()))

    def free_cut(self, text: str, at: int) -> int:
        """First place at or after ``at`` where no token can reach across.

        A token is one piece or one character, and no piece holds the two
        characters beside the place next to each other, so the counts of the
        two parts add up to the count of the whole.  White space always is such
        a place.
        """
        for i in range(max(1, at), len(text)):
            if text[i - 1 : i + 1] not in self._joined:
                return i
        return len(text)

    def cut(self, text: str, size: int) -> list[str]:
        """Parts of about ``size`` characters whose counts add up to the text's."""
        parts, start = [], 0
        while start < len(text):
            end = self.free_cut(text, start + size) if start + size < len(text) else len(text)
            parts.append(text[start:end])
            start = end
        return parts


def load_vocab(df: DataFrame) -> Vocab:
    """The vocabulary of a ``tokenizer_vocab`` table (null pieces are left out)."""
    rows = df.select("piece").where(F.col("piece").isNotNull()).limit(MAX_PIECES + 1).collect()
    if len(rows) > MAX_PIECES:
        raise ValueError(f"a vocabulary of more than {MAX_PIECES} pieces is not held in memory")
    return Vocab(r.piece for r in rows)


def message_tokens(messages: Column, vocab: Vocab, cut_chars: int) -> Column:
    """Tokens of each message's content as ``array<int>``; -1 where the content is longer than ``cut_chars``."""

    @F.arrow_udf("array<int>")
    def count(col: pa.Array) -> pa.Array:
        flat = col.flatten()
        texts = flat.field("content").to_pylist() if len(flat) else []
        n = [-1 if x is not None and len(x) > cut_chars else vocab.count(x) for x in texts]
        sizes = [len(x) if x.is_valid else None for x in col]
        offsets, at = [], 0
        for s in sizes:
            offsets.append(None if s is None else at)
            at += s or 0
        return pa.ListArray.from_arrays(pa.array([*offsets, at], pa.int32()), pa.array(n, pa.int32()))

    return count(messages)


def text_tokens(text: Column, vocab: Vocab) -> Column:
    """Tokens of a text as int; null counts as empty."""

    @F.arrow_udf("int")
    def count(col: pa.Array) -> pa.Array:
        return pa.array([vocab.count(x) for x in col.to_pylist()], pa.int32())

    return count(text)


def cut_texts(text: Column, vocab: Vocab, size: int) -> Column:
    """Parts of a text at independent boundaries as ``array<string>``."""

    @F.arrow_udf("array<string>")
    def cut(col: pa.Array) -> pa.Array:
        return pa.array([vocab.cut(x or "", size) for x in col.to_pylist()], pa.list_(pa.string()))

    return cut(text)


def row_tokens(df: DataFrame, key: list[str], text: str, vocab: Vocab, cut_chars: int = 1 << 18) -> DataFrame:
    """Add ``tokens`` (long): the exact token count of a text column, which is dropped.

    ``key`` names the row.  Texts of up to ``cut_chars`` characters are counted
    where they are scanned; longer ones are cut at independent boundaries, the
    parts salted across the workers, and their counts summed.
    """
    long = F.length(text) > cut_chars
    counted = df.withColumn("tokens", F.when(long, F.lit(None)).otherwise(text_tokens(F.when(long, F.lit(None)).otherwise(F.col(text)), vocab)).cast("long")).drop(text)
    big = df.where(long).select(*key, text)
    if not big.take(1):
        return counted
    parts = big.select(*key, F.posexplode(cut_texts(F.col(text), vocab, cut_chars)).alias("_at", "_part")).repartition(*key, "_at")
    sums = parts.select(*key, text_tokens(F.col("_part"), vocab).cast("long").alias("_n")).groupBy(*key).agg(F.sum("_n").alias("_n"))
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in key]
    on = same[0]
    for c in same[1:]:
        on = on & c
    joined = counted.alias("l").join(sums.alias("r"), on, "left")
    return joined.select(*[F.coalesce("l.tokens", "r._n").alias(c) if c == "tokens" else F.col(f"l.{c}") for c in counted.columns])
