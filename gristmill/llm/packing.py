"""Problem 2: training sequences of fixed capacity filled with examples.

Vector bin packing: every item is a vector of tokens, segments and loss-bearing
tokens, and a sequence limits all three at once.  The dot-product heuristic
keeps one sequence open and adds, of the items that still fit, the one whose
demand vector has the greatest weighted dot product with the room left.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.token_budget import TOKENS_PER_MESSAGE, message_lengths, true_length
from gristmill.llm.vocab import Vocab
from gristmill.session import durable

#: Items that one task packs together.
BLOCK_ITEMS = 4096
#: Tokens of a sequence that each allowed segment stands for.
TOKENS_PER_SEGMENT = 128
#: Share of a sequence's tokens that may bear loss.
LOSS_SHARE = 0.75
#: Sequences filled less than this are opened again in the second round.
FULL_ENOUGH = 0.985


def dot_product_pack(demand: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Bin number of each item.

    ``demand`` is items x dimensions, ``limits`` the capacity in each
    dimension.  An item that alone exceeds a limit gets a bin of its own.
    Ties go to the item that comes first.
    """
    n = len(demand)
    bins = np.full(n, -1, np.int64)
    size = demand / limits
    alone = (size > 1).any(axis=1)
    count = 0
    for i in np.flatnonzero(alone):
        bins[i] = count
        count += 1
    left = np.flatnonzero(~alone)
    weight = size[left].mean(axis=0) if len(left) else np.ones(len(limits))
    weighted = size * weight
    while len(left):
        room = np.ones(len(limits))
        have, weigh = size[left], weighted[left]
        taken = np.zeros(len(left), bool)
        while True:
            fits = (have <= room + 1e-12).all(axis=1) & ~taken
            if not fits.any():
                break
            best = int(np.argmax(np.where(fits, weigh @ room, -1.0)))
            taken[best] = True
            room = room - have[best]
        bins[left[taken]] = count
        count += 1
        left = left[~taken]
    return bins


def items(lengths: DataFrame, limits: DataFrame) -> DataFrame:
    """Items of each stage: an example whole or, only where it is longer than the capacity, its pieces.

    Columns ``stage, capacity, key, id, piece, pieces, start, tokens, loss``.
    Tokens of assistant contents bear loss; their number in a piece is exact.
    """
    stages = limits.select("stage", F.col("capacity").cast("long").alias("capacity")).where("stage is not null and capacity > 0")
    d = lengths.crossJoin(F.broadcast(stages))  # stage_limits: a fixed table of a few rows
    d = d.withColumn("pieces", F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.col("capacity"))).cast("int"))
    d = d.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    d = d.withColumn("start", F.col("piece") * F.col("capacity")).withColumn("end", F.least("tokens", F.col("start") + F.col("capacity")))
    spans = F.zip_with("roles", "msg_tokens", lambda r, n: F.struct(r.alias("role"), F.coalesce(n, F.lit(0)).cast("long").alias("n")))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("loss"))

    def step(acc, m):
        first = acc.at + TOKENS_PER_MESSAGE
        last = first + m.n
        inside = F.greatest(F.lit(0).cast("long"), F.least(last, F.col("end")) - F.greatest(first, F.col("start")))
        return F.struct(last.alias("at"), (acc.loss + F.when(m.role == "assistant", inside).otherwise(0)).alias("loss"))

    loss = F.coalesce(F.aggregate(spans, zero, step, lambda a: a.loss), F.lit(0).cast("long"))
    return d.select("stage", "capacity", "key", "id", "piece", "pieces", "start", (F.col("end") - F.col("start")).alias("tokens"), loss.alias("loss"))


def _round(todo: DataFrame, blocks: DataFrame, number: int, block_items: int, loss_share: float, per_segment: int) -> DataFrame:
    schema = todo.schema.simpleString()[len("struct<") : -1].replace(":", " ") + ", sequence string, filled long"

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        stage, block = key
        pdf = pdf.sort_values(["tokens", "loss", "key", "piece"], ascending=[False, False, True, True], kind="stable").reset_index(drop=True)
        cap = int(pdf["capacity"].iloc[0])
        demand = np.column_stack([pdf["tokens"], np.ones(len(pdf)), pdf["loss"]]).astype(float)
        limits = np.array([cap, max(1, cap // per_segment), max(1.0, cap * loss_share)], float)
        bins = dot_product_pack(demand, limits)
        filled = pdf.groupby(bins)["tokens"].sum()
        out = pdf.drop(columns=["block"])
        out["sequence"] = [f"{stage}-{number}-{block}-{b}" for b in bins]
        out["filled"] = filled.reindex(bins).to_numpy()
        return out

    sized = todo.join(F.broadcast(blocks), "stage")
    salted = sized.withColumn("block", F.pmod(F.xxhash64(F.lit(number), "key", "piece"), F.greatest(F.lit(1), F.ceil(F.col("n") / block_items))).cast("int"))
    return salted.drop("n").select(*todo.columns, "block").groupBy("stage", "block").applyInPandas(pack, schema)


def pack(
    examples: DataFrame, limits: DataFrame, vocab: Vocab, block_items: int = BLOCK_ITEMS,
    loss_share: float = LOSS_SHARE, per_segment: int = TOKENS_PER_SEGMENT,
) -> DataFrame:
    """Assign every distinct example to sequences of each stage's capacity.

    Columns ``stage, capacity, key, id, piece, pieces, start, tokens, loss,
    sequence, filled``.  Items are dealt by hash to blocks of about
    ``block_items``, whatever source or repository they come from, and each
    block is packed by :func:`dot_product_pack`; the items of sequences with
    room left are dealt and packed a second time, so what stays empty is about
    one sequence for each block of the second round.  Ties are settled by key;
    an example without tokens still takes a segment; empty tables give an empty
    result.
    """
    wanted = examples.select("id", "messages", "loaded_at")
    lengths = true_length(message_lengths(wanted, vocab, ["id"]))
    todo = items(lengths, limits)

    def blocks(df: DataFrame) -> DataFrame:
        return df.groupBy("stage").agg(F.count("*").alias("n"))

    first = durable(_round(todo, blocks(todo), 1, block_items, loss_share, per_segment))
    open_again = F.col("filled") < F.col("capacity") * FULL_ENOUGH
    again = first.where(open_again).drop("sequence", "filled")
    second = _round(again, blocks(again), 2, block_items, loss_share, per_segment)
    return first.where(~open_again).unionByName(second)


def split_examples(packed: DataFrame, stage: str) -> DataFrame:
    """Ids of the examples that had to be split in a stage: those longer than its capacity."""
    return packed.where((F.col("stage") == stage) & (F.col("pieces") > 1) & F.col("id").isNotNull()).select("id").distinct()


def fill_report(packed: DataFrame) -> DataFrame:
    """For each stage: examples, sequences, tokens, and the share of the capacity in use."""
    by_sequence = packed.groupBy("stage", "capacity", "sequence").agg(
        F.sum("tokens").alias("tokens"), F.count("*").alias("segments"), F.sum("loss").alias("loss"),
        F.sum((F.col("piece") == 0).cast("long")).alias("examples"),
        F.sum(((F.col("piece") == 0) & (F.col("pieces") > 1)).cast("long")).alias("split"),
    )
    return by_sequence.groupBy("stage", "capacity").agg(
        F.sum("examples").alias("examples"), F.sum("split").alias("split_examples"), F.count("*").alias("sequences"),
        F.sum("tokens").alias("tokens"), F.max("segments").alias("most_segments"), F.max("loss").alias("most_loss"),
        (F.sum("tokens") / (F.count("*") * F.col("capacity"))).alias("used_share"),
    )
