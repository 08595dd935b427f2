"""Bring any source to a declared set of columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.contracts import Contract


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Select the declared columns in order, cast to the declared types.

    A value that does not fit becomes NULL instead of failing a load of many
    terabytes on one bad row; `quality.lost_values` counts them in the source.
    """
    have = {field.name: field.dataType for field in df.schema.fields}
    missing = [name for name in contract.columns if name not in have]
    if missing:
        raise ValueError(f"{contract.name}: source lacks {', '.join(missing)}")
    return df.select(
        *(
            F.col(name) if have[name] == kind else F.col(name).try_cast(kind).alias(name)
            for name, kind in contract.fields
        )
    )
