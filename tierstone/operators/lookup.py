"""Left lookup of dimension columns for a fact table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KEY, _SALT = "__lookup_key", "__lookup_salt"


def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    take: dict[str, str],
    salts: int = 1,
    hot: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Add dimension columns to the facts; facts without a match keep NULLs.

    `take` maps dimension columns to their new names. Only these and the key are
    read from the dimension. A dimension under Spark's broadcast threshold costs
    no shuffle; a larger one is a sort-merge join whose hot keys AQE splits.

    With `salts` > 1 the hot keys are spread before the shuffle instead: keys for
    which `hot` holds (see `hot_keys`; by default those with a hundredth of these
    facts) are scattered over `salts` partitions, and only their dimension rows are
    repeated. Facts without a key have no partner and are scattered as well. The salt
    is a hash of the row, so a retried task sends every row where it went before;
    identical rows stay together and are left to AQE.
    """
    wanted = dimension.select(
        F.col(dimension_key).alias(_KEY),
        *(F.col(source).alias(target) for source, target in take.items()),
    )
    if salts <= 1:
        matched = facts.join(wanted, facts[fact_key] == wanted[_KEY], "left")
        return matched.drop(_KEY)

    hot = hot or hot_keys(facts, [fact_key])[fact_key]
    spread = F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int")
    salted_facts = facts.withColumn(
        _SALT, F.when(hot(F.col(fact_key)) | F.col(fact_key).isNull(), spread).otherwise(0)
    )
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    salted_wanted = wanted.withColumn(
        _SALT, F.explode(F.when(hot(F.col(_KEY)), every_salt).otherwise(F.array(F.lit(0))))
    )
    condition = (salted_facts[fact_key] == salted_wanted[_KEY]) & (
        salted_facts[_SALT] == salted_wanted[_SALT]
    )
    matched = salted_facts.join(salted_wanted, condition, "left")
    return matched.select(*facts.columns, *take.values())


def hot_keys(
    facts: DataFrame, keys: Sequence[str], share: float = 0.01
) -> dict[str, Callable[[Column], Column]]:
    """For each key column a test for values that hold at least `share` of the facts.

    One pass over the key columns of the facts, which should be the narrow source of
    all lookups, before any join. Values are counted by partial sums per task, and at
    most 1 / `share` of them per column survive, so no task merges more than it is sent
    by the shuffle.
    """
    pairs = F.array(
        *(F.struct(F.lit(i).alias("at"), F.col(k).cast("string").alias("v")) for i, k in enumerate(keys))
    )
    counted = (
        facts.select(F.explode(pairs).alias("pair"))
        .groupBy("pair.at", "pair.v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Every fact is counted once per key column.
    total = facts.agg(F.count(F.lit(1)).alias("n")).scalar()
    frequent = counted.where((F.col("n") >= share * total) & F.col("v").isNotNull())

    def test(position: int) -> Callable[[Column], Column]:
        def is_hot(candidate: Column) -> Column:
            values = frequent.agg(F.collect_set(F.when(F.col("at") == position, F.col("v")))).scalar()
            return F.coalesce(F.array_contains(values, candidate.cast("string")), F.lit(False))

        return is_hot

    return {key: test(i) for i, key in enumerate(keys)}
