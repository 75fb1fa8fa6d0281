"""Dimension lookups (J1): a plain join that AQE plans, and one that salts measured hot keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehand.constants import SCD_CURRENT

#: A key with more than this share of all rows is hot; there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 1 / 1000


def salted_join(fact: DataFrame, dim: DataFrame, on, how: str = "inner", salt_buckets: int = 16) -> DataFrame:
    """Equi-join whose fact side may hold hot keys: each fact row gets a
    deterministic salt (a hash of the whole row, so task retries agree) and every
    dimension row is replicated once per salt value.  A hot key is then spread
    over ``salt_buckets`` tasks; the dimension grows ``salt_buckets`` times."""
    on = [on] if isinstance(on, str) else list(on)
    salted = fact.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns]),
                                              F.lit(salt_buckets)))
    rep = dim.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salt_buckets - 1).cast("long"))))
    return salted.join(rep, on + ["__salt"], how).drop("__salt")


def hot_keys(fact: DataFrame, on: list[str], share: float = HOT_SHARE) -> DataFrame:
    """The keys that more than ``share`` of all rows hold, so ``1 / share`` rows at most.

    Rows are counted per key, combined before the shuffle, and compared with their number in
    one plan; nothing comes to the driver.
    """
    counts = fact.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
    return counts.where(F.col("__n") > fact.agg(F.count(F.lit(1))).scalar() * F.lit(share)).select(*on)


def hot_salted_join(fact: DataFrame, dim: DataFrame, on, how: str = "inner", salt_buckets: int = 16,
                    share: float = HOT_SHARE) -> DataFrame:
    """Equi-join in which only measured hot keys are salted: their rows go to ``salt_buckets`` tasks by a
    hash of the row, and the dimension's rows of these keys alone are copied.  The hot keys are
    broadcast; their number is bounded by ``share``, whatever the fact's size."""
    on = [on] if isinstance(on, str) else list(on)
    hot = F.broadcast(hot_keys(fact, on, share).select(*[F.col(c).alias(f"__h{i}") for i, c in enumerate(on)], F.lit(True).alias("__hot")))
    is_hot = reduce(lambda x, y: x & y, [F.col(c) == F.col(f"__h{i}") for i, c in enumerate(on)])
    drop = ["__hot", *[f"__h{i}" for i in range(len(on))]]
    salt = F.when(F.col("__hot"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns]), F.lit(salt_buckets))).otherwise(0)
    copies = F.when(F.col("__hot"), F.sequence(F.lit(0).cast("long"), F.lit(salt_buckets - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    salted = fact.join(hot, is_hot, "left").withColumn("__salt", salt.cast("long")).drop(*drop)
    spread = dim.join(hot, is_hot, "left").withColumn("__salt", F.explode(copies)).drop(*drop)
    return salted.join(spread, [*on, "__salt"], how).drop("__salt")


def lookup(fact: DataFrame, dim: DataFrame, on, how: str = "inner", versions: str = "current",
           dim_columns=None, salt_buckets: int | None = None) -> DataFrame:
    """Fact -> dimension lookup on (natural key, organisation) columns.

    ``versions="current"`` joins only current dimension rows, so dimension history
    cannot multiply facts; ``"all"`` keeps the reference behaviour (N6).  The join is
    AQE's to plan: it broadcasts a dimension whose measured size allows it and splits skewed
    partitions.  ``salt_buckets`` spreads measured hot keys before that
    (:func:`hot_salted_join`), for keys that one split of a partition cannot relieve.
    """
    on = [on] if isinstance(on, str) else list(on)
    if versions == "current" and SCD_CURRENT in dim.columns:
        dim = dim.where(F.col(SCD_CURRENT) == 1)
    if dim_columns:
        dim = dim.select(*on, *[c for c in dim_columns if c not in on])
    if salt_buckets and how in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        return hot_salted_join(fact, dim, on, how, salt_buckets)
    return fact.join(dim, on, how)
