"""MinHash signatures and banded candidate pairs.

Two hash families, never to be mixed.  ``compat`` derives all slots from one
64-bit digest, as existing corpora were deduplicated with it: every slot picks
the same run, so a similarity is in practice 0 or 1.  ``independent`` mixes the
digest anew for each slot, so the share of equal slots estimates the Jaccard
similarity.  ``sha`` and ``sha_independent`` are these formulas over SHA-256, which SQL can express.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.text import normalize
from gristmill.session import durable

PRIME = (1 << 61) - 1
SLOTS = 64
BANDS = 8
_SEEDS = np.arange(SLOTS, dtype=np.int64)


def _blake(run: str) -> int:
    return int.from_bytes(hashlib.blake2b(run.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big") % PRIME


def _sha(run: str) -> int:
    return int(hashlib.sha256(run.encode("utf-8", "surrogatepass")).hexdigest()[:15], 16) % PRIME


# The formula of the compat slots, and the modulus.
# The formulas of the slots and their modulus.
def _compat(v: np.ndarray) -> np.ndarray:
    step = (v >> 29) | 1
    return (v[:, None] + step[:, None] * (_SEEDS + 1) + _SEEDS * _SEEDS) % PRIME


def _independent(v: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = v.astype(np.uint64)[:, None] + (_SEEDS + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) % np.uint64(PRIME)).astype(np.int64)


#: Runs whose slots are computed together: a matrix that stays in the cache.
_RUNS_AT_ONCE = 1024


def _signatures(texts: list[str | None], slots, digest, width: int) -> np.ndarray:
    """A row of ``SLOTS`` least values for each text; runs are hashed one by one, their slots as matrices."""
    out = np.zeros((len(texts), SLOTS), np.int64)
    for i, normal in enumerate(texts):
        v = np.fromiter(map(digest, _runs(normal, width)), np.int64)
        if len(v):
            out[i] = slots(v[:_RUNS_AT_ONCE]).min(axis=0)
            for at in range(_RUNS_AT_ONCE, len(v), _RUNS_AT_ONCE):
                np.minimum(out[i], slots(v[at : at + _RUNS_AT_ONCE]).min(axis=0), out=out[i])
    return out


def _runs(normal: str | None, width: int) -> set[str]:
    words = normal.split(" ") if normal else []
    if len(words) < width:
        return {normal} if normal else set()
    return {" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}


def signature(text: Column, family: str = "compat", width: int = 5) -> Column:
    """Signature of a text's runs of ``width`` words as ``array<bigint>`` of 64; no words give zeros.

    The text is normalized in the JVM and goes to Python once, as Arrow batches:
    nested lambdas over runs are many times slower.
    """
    hashed, digest = {"compat": (_compat, _blake), "independent": (_independent, _blake), "sha": (_compat, _sha), "sha_independent": (_independent, _sha)}[family]

    @F.arrow_udf("array<long>")
    def sign(col: pa.Array) -> pa.Array:
        flat = _signatures(col.to_pylist(), hashed, digest, width).ravel()
        return pa.ListArray.from_arrays(np.arange(len(col) + 1, dtype=np.int32) * SLOTS, flat)

    return sign(normalize(text))


def similarity(a: Column, b: Column) -> Column:
    """Share of equal slots; signatures of different lengths are an error."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.size(a)
    return F.when(F.size(a) == F.size(b), same).otherwise(F.raise_error(F.lit("signatures differ in length")))


def banded(df: DataFrame, key: str, sig: str = "sig", bands: int = BANDS) -> DataFrame:
    """``key, band, h``: one row for each band, its slots hashed to 64 bits."""
    if SLOTS % bands:
        raise ValueError("bands must divide the slots")
    rows = SLOTS // bands
    hashes = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.xxhash64(b, F.slice(F.col(sig), b * rows + 1, rows)))
    return df.select(key, F.posexplode(hashes).alias("band", "h"))


#: Representatives that share one band and are still compared with each other directly.
HOT_BAND = 1_000


def _candidates(b: DataFrame) -> DataFrame:
    """``lo, hi`` of every two representatives that share all columns beside ``_rep``."""
    keys = [c for c in b.columns if c != "_rep"]
    l, r = b.withColumnRenamed("_rep", "lo"), b.withColumnRenamed("_rep", "hi")  # noqa: E741
    return l.join(r, keys).where("lo < hi").select("lo", "hi")


def _parts_of_hot_bands(hot: DataFrame, reps: DataFrame, sig: str, bands: int, threshold: float) -> DataFrame:
    """``_rep, band, h, part, ph``: the members of hot bands, by parts of their other slots.

    Two signatures that reach the threshold differ in few slots.  The slots beside
    the band are cut into more parts than may differ, so such a pair shares at
    least one part, and members meet only where they do.
    """
    rows = SLOTS // bands
    differ = SLOTS - int(np.ceil(threshold * SLOTS - 1e-9))
    width = max(1, (SLOTS - rows) // (differ + 1))
    other = F.concat(F.slice(F.col(sig), F.lit(1), F.col("band") * rows), F.slice(F.col(sig), (F.col("band") + 1) * rows + 1, F.lit(SLOTS)))
    parts = F.transform(F.sequence(F.lit(0), F.lit((SLOTS - rows) // width - 1)), lambda p: F.xxhash64(p, F.slice(F.col("_o"), p * width + 1, F.lit(width))))
    d = hot.join(reps, "_rep").withColumn("_o", other)
    return d.select("_rep", "band", "h", F.posexplode(parts).alias("part", "ph"))


def similar_pairs(df: DataFrame, key: str, threshold: float = 0.85, sig: str = "sig", bands: int = BANDS) -> DataFrame:
    """``lo, hi, similarity`` of keys whose signatures share a band and reach the threshold.

    Equal signatures are one class first: a class is linked to its least key by
    one pair each (similarity 1), and only the classes' representatives meet in
    the bands, so a hot group of copies makes no quadratic list.  In a band that
    many representatives share, those meet that share a part of the other slots
    as well (:func:`_parts_of_hot_bands`); no pair of the threshold is lost.
    """
    df = durable(df.select(key, sig))
    reps = durable(df.groupBy(sig).agg(F.min(key).alias("_rep")))
    members = df.join(reps, sig)
    copies = members.where(F.col(key) != F.col("_rep")).select(F.col("_rep").alias("lo"), F.col(key).alias("hi"), F.lit(1.0).alias("similarity"))
    b = banded(reps, "_rep", sig, bands)
    shared = b.groupBy("band", "h").agg(F.count("*").alias("n")).where("n > 1")
    b = durable(b.join(shared, ["band", "h"]))
    cand = _candidates(b.where(F.col("n") <= HOT_BAND).drop("n"))
    hot = b.where(F.col("n") > HOT_BAND).drop("n")
    if not hot.isEmpty():
        cand = cand.unionByName(_candidates(_parts_of_hot_bands(hot, reps, sig, bands, threshold)))
    cand = cand.distinct()
    both = cand.join(reps.select(F.col("_rep").alias("lo"), F.col(sig).alias("_a")), "lo").join(reps.select(F.col("_rep").alias("hi"), F.col(sig).alias("_b")), "hi")
    near = both.withColumn("similarity", similarity(F.col("_a"), F.col("_b"))).where(F.col("similarity") >= threshold)
    return near.select("lo", "hi", "similarity").unionByName(copies)
