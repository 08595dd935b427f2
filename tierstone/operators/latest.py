"""Newest row per key, and the upsert and the signed changes built on it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.scratch import kept

_NEWEST, _LONE, _OLD = "__newest", "__lone", "__old_"
#: +1 for a row that is now there, -1 for one that no longer is.
CHANGE = "change"


def has_key(keys: Sequence[str]) -> Column:
    """Whether every part of the key is there."""
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    return whole


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest `newest_by`, then the greatest rest.
    A row that lacks part of its key is nobody's older version: all such rows stay.

    An aggregate rather than a ranked window: rows of one key are reduced before
    the shuffle, so a key with a huge history never lands whole in one task. A row
    without a whole key is a group of its own, so these rows spread as well.
    """
    rest = [name for name in df.columns if name not in {*keys, *newest_by}]
    lone = F.when(~has_key(keys), F.monotonically_increasing_id())
    ranked = df.withColumn(_LONE, lone).groupBy(*keys, _LONE).agg(
        F.max(F.struct(*newest_by, *rest)).alias(_NEWEST)
    )
    return ranked.select(
        *(name if name in keys else F.col(f"{_NEWEST}.{name}").alias(name) for name in df.columns)
    )


def _as_old(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(name).alias(_OLD + name) for name in df.columns))


def _all(conditions: list[Column]) -> Column:
    return reduce(Column.__and__, conditions)


def _not_older(ours: list[tuple[str, str]], theirs: list[tuple[str, str]]) -> Column:
    """Whether one row's `newest_by` is not below another's; NULL is below everything."""
    one, other = (F.struct(*(F.col(c).alias(name) for name, c in side)) for side in (ours, theirs))
    return one >= other


def upsert(
    current: DataFrame, incoming: DataFrame, keys: Sequence[str], newest_by: Sequence[str]
) -> DataFrame:
    """Current rows with newer incoming versions applied; on a tie incoming wins.

    `current` has one row per key, as an upsert leaves it. The delivery is reduced once,
    into the shared folder. Current rows pass by one join with it, which is a broadcast where the delivery is
    small, and take the newer version; what the delivery has beyond them is found by those
    of their keys that it names. Rows without a whole key, current or incoming, are all kept.
    """
    delivered = kept(latest_per_key(incoming, keys, newest_by), "delivery")
    # The delivery is the side under other names, so that `current` may be any plan.
    named = _as_old(delivered.select(*current.columns))
    found = current.join(named, _all([F.col(k) == F.col(_OLD + k) for k in keys]), "left")
    wins = F.col(_OLD + keys[0]).isNotNull() & _not_older(
        [(c, _OLD + c) for c in newest_by], [(c, c) for c in newest_by]
    )
    settled = found.select(
        *(c if c in keys else F.when(wins, F.col(_OLD + c)).otherwise(F.col(c)).alias(c) for c in current.columns)
    )
    there = current.select(*keys).join(delivered.select(*keys), list(keys), "left_semi")
    return settled.unionByName(delivered.join(there, list(keys), "left_anti"))


def changes(
    current: DataFrame, incoming: DataFrame, keys: Sequence[str], newest_by: Sequence[str]
) -> DataFrame:
    """What an upsert changes, as signed rows: -1 the row that goes, +1 the row that comes.

    A delivered row that is older than the current one, or equal to it in every column,
    changes nothing, so a replayed delivery gives no rows. Incoming rows without a whole
    key are new each time.
    """
    delivered = kept(latest_per_key(incoming, keys, newest_by).select(*current.columns), "delivery")
    touched = _as_old(current.join(delivered.select(*keys), list(keys), "left_semi"))
    met = delivered.join(touched, _all([F.col(k) == F.col(_OLD + k) for k in keys]), "left")
    known = F.col(_OLD + keys[0]).isNotNull()
    newer = _not_older([(c, c) for c in newest_by], [(c, _OLD + c) for c in newest_by])
    equal = _all([F.equal_null(c, _OLD + c) for c in current.columns])

    def signed(sign: int, prefix: str) -> Column:
        return F.struct(*(F.col(prefix + c).alias(c) for c in current.columns), F.lit(sign).alias(CHANGE))

    comes, goes = F.array(signed(1, "")), F.array(signed(-1, _OLD), signed(1, ""))
    moved = F.when(~known, comes).when(newer & ~equal, goes)
    return met.select(F.explode(moved).alias("row")).select("row.*")
