"""Exact positions in a seeded hash order, without sorting or ranking everything.

Shuffles and samples are defined as "the first n keys ordered by md5(seed:key)".
Instead of ranking all keys, the key standing at a cut position is found by distributed
selection:

1. keys are counted per bucket of ``width`` hexadecimal digits (16**width counts at most);
2. running totals over those counts tell which bucket holds the position, and where in it;
3. the keys of that bucket alone are counted by their next digits, and so on, until the
   bucket holds at most ``most`` keys; only those are ranked.

Membership is then a map-side comparison of (md5, key) with the cut, so rows need
no join back and no window over the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from threadlens.schema import SEED
from threadlens.sources.scratch import materialize

WIDTH = 3      # hexadecimal digits counted at once
RANKED = 4_096  # keys ranked in one task at most


def hash_key(col: Column, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), col.cast("string")))


def cut_keys(keys: DataFrame, key: str, positions: dict[str, Callable[[int], int]], *,
             seed: int = SEED, width: int = WIDTH, most: int = RANKED, sizes: list[int] | None = None) -> dict[str, tuple[str, str] | None]:
    """Per named position the (h, k) standing at that 1-based rank.

    ``positions`` maps a name to a function of the total key count.  A position of
    0 or less gives None; one past the end gives the last key.  ``keys`` must hold
    unique keys.  ``sizes`` collects the number of keys ranked for each position.

    The driver sees bucket counts (at most 16**width a round) and one key a position.  Every round but the
    first reads the bucket of the round before only, written where it is large.
    """
    keyed = keys.select(F.col(key).cast("string").alias("k")).withColumn("h", hash_key(F.col("k"), seed))
    first = bucket_counts(keyed, "", width)
    total = sum(n for _, n in first)
    found: dict[str, tuple[str, str] | None] = {}
    rows: dict[str, DataFrame] = {"": keyed}
    counted: dict[str, list[tuple[str, int]]] = {"": first}
    for name, place in positions.items():
        rank, prefix, n = min(int(place(total)), total), "", total
        if rank <= 0:
            found[name] = None
            continue
        while n > most and len(prefix) < 32:
            if prefix not in counted:
                counted[prefix] = bucket_counts(rows[prefix], prefix, width)
            inside, rank, n = locate(counted[prefix], rank)
            if inside not in rows:
                rows[inside] = rows[prefix].where(F.col("h").startswith(inside))
                if n > most:  # read again by the next rounds
                    rows[inside] = materialize(rows[inside], "bucket")
            prefix = inside
        if sizes is not None:
            sizes.append(n)
        # at most ``most`` keys, or keys of one and the same hash
        ranked = rows[prefix].orderBy("h", "k").limit(rank).orderBy(F.desc("h"), F.desc("k")).limit(1).first()
        found[name] = (ranked.h, ranked.k)
    return found


def bucket_counts(rows: DataFrame, prefix: str, width: int) -> list[tuple[str, int]]:
    """(prefix and next digits, keys) in order; at most 16**width rows."""
    counts = rows.groupBy(F.substring("h", 1, len(prefix) + width).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    return sorted((r.b, r.n) for r in counts)


def locate(counts: list[tuple[str, int]], rank: int) -> tuple[str, int, int]:
    """(bucket that holds the rank, rank inside it, keys in it)."""
    for bucket, n in counts:
        if rank <= n:
            return bucket, rank, n
        rank -= n
    raise ValueError("rank past the last key")


def at_or_before(col: Column, cut: tuple[str, str] | None, seed: int = SEED) -> Column:
    """True where the key stands at or before the cut in hash order; false for null keys, and without a cut."""
    if cut is None:
        return F.lit(False)
    me = F.struct(hash_key(col, seed).alias("h"), col.cast("string").alias("k"))
    return F.coalesce(me <= F.struct(F.lit(cut[0]).alias("h"), F.lit(cut[1]).alias("k")), F.lit(False))


def hash_sample(df: DataFrame, n: int, key: str, *, seed: int = SEED, width: int = WIDTH) -> DataFrame:
    """The n rows first in hash order of the unique column ``key`` (all rows with a key if fewer).

    Rows without a key have no place in the order: they neither count nor are chosen.
    """
    df = df.where(F.col(key).isNotNull())
    cut = cut_keys(df, key, {"last": lambda total: n}, seed=seed, width=width)["last"]
    return df.where(at_or_before(F.col(key), cut, seed))
