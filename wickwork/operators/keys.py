"""Key constraints as joins: insert-or-ignore, upsert, referential checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, pinned
from .dedupe import _first_by


def _one_per_key(new: DataFrame, keys: list[str], order: list | None) -> DataFrame:
    """Without an order the smallest row wins, so that reruns agree."""
    return _first_by(new, keys, order or [F.col(c) for c in new.columns if c not in keys])


def insert_ignore(
    old: DataFrame, new: DataFrame, keys: list[str], order: list | None = None
) -> DataFrame:
    """New rows whose key is not taken yet; ``order`` picks among equal new keys.

    Both sides shrink to one row per key before they meet, so many copies of one
    key cost a partial aggregation, not a skewed join.
    """
    taken = old.select(*keys).distinct()
    return _one_per_key(new, keys, order).join(taken, keys, "left_anti")


def upsert(
    old: DataFrame, new: DataFrame, keys: list[str], order: list | None = None
) -> DataFrame:
    """The table after replacing or adding the new rows.

    The replaced keys are materialised: while they are few, the old rows stay where
    they are; beyond that both sides are shuffled on the key.
    """
    replaced = broadcast_if_small(pinned(new.select(*keys).distinct()))
    return old.join(replaced, keys, "left_anti").unionByName(_one_per_key(new, keys, order))


def fk_violations(
    child: DataFrame, parent: DataFrame, keys: dict[str, str] | list[str]
) -> DataFrame:
    """Child rows whose complete key has no parent; a NULL in the key passes.

    The orphaned keys are found among distinct keys, so neither a key with very many
    child rows nor repeated parents skew the join; the child rows themselves move
    only if there are too many orphaned keys to broadcast.
    """
    pairs = keys if isinstance(keys, dict) else {k: k for k in keys}
    columns = list(pairs)
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    parents = parent.select(*[F.col(p).alias(c) for c, p in pairs.items()]).distinct()
    used = child.where(complete).select(*columns).distinct()
    orphans = pinned(used.join(parents, columns, "left_anti"))
    return child.join(broadcast_if_small(orphans), columns, "left_semi").select(*child.columns)


def active_version(versions: DataFrame) -> DataFrame:
    """The newest active version, at most one row."""
    return (
        versions.where("is_active")
        .orderBy(F.col("created_at").desc(), "version_id")
        .limit(1)
        .select("version_id")
    )


def cross_active_version(df: DataFrame, versions: DataFrame, strict: bool = False) -> DataFrame:
    """Tag every row with the active version.

    Without an active version the result is empty, or an error when ``strict``.
    The broadcast side has one row by construction.
    """
    active = active_version(versions)
    if strict and not active.take(1):
        raise RuntimeError("No active version")
    return df.crossJoin(F.broadcast(active))


def duplicate_keys(df: DataFrame, keys: list[str], count: str = "copies") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).where(F.col(count) > 1)


def top_per_group(df: DataFrame, group: list[str], order: list, n: int) -> DataFrame:
    """First n rows of each group; reduced to n per group and task before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
