"""Create-or-update of dimension rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.functions.times import instant
from aerolake.operators.keys import keep_last


def merge_dimension(
    target: DataFrame,
    batch: DataFrame,
    key: str,
    now: datetime | Column,
    order: list[str] | None = None,
    touch: str | None = "updated_at",
    ignore_unknown: bool = False,
    null_overwrites: bool = True,
) -> DataFrame:
    """``target`` after create-or-update with ``batch``.

    Columns that the batch supplies overwrite, also with NULL unless ``null_overwrites`` is
    off (for sources that leave out what they do not know); columns it lacks keep their old
    value. ``order`` resolves repeated keys (the last row wins); without it the batch
    must be unique by key. Rows without a key are left out here; ``DimensionTable`` refuses
    them. ``touch`` is set to ``now`` on updated and created rows. The added column ``change``
    is ``created``, ``updated`` or ``unchanged``.
    """
    order = order or []
    unknown = [c for c in batch.columns if c not in target.columns and c not in order]
    if unknown and not ignore_unknown:
        raise ValueError(f"unknown columns {unknown}")
    supplied = [c for c in batch.columns if c in target.columns and c not in order]
    batch = batch.filter(F.col(key).isNotNull())
    if order:
        batch = keep_last(batch.select(*supplied, *order), [key], order)
    now = now if isinstance(now, Column) else instant(now)
    new = batch.select(*[F.col(name).alias(f"_new_{name}") for name in supplied])
    joined = target.join(new, F.col(key) == F.col(f"_new_{key}"), "full_outer")
    hit = F.col(f"_new_{key}").isNotNull()
    types = {field.name: field.dataType for field in target.schema.fields}

    def merged(name: str) -> Column:
        if name == touch:
            return F.when(hit, now.cast(types[name])).otherwise(F.col(name))
        if name == "created_at" and name not in supplied:
            return F.when(F.col(key).isNull(), now.cast(types[name])).otherwise(F.col(name))
        if name in supplied:
            new_value = F.col(f"_new_{name}").cast(types[name])
            if not null_overwrites:
                return F.coalesce(new_value, F.col(name))
            return F.when(hit, new_value).otherwise(F.col(name))
        return F.col(name)

    change = (
        F.when(~hit, "unchanged")
        .when(F.col(key).isNull(), "created")
        .otherwise("updated")
    )
    return joined.select(
        *[merged(name).alias(name) for name in target.columns], change.alias("change")
    )


def merge_pollutants(target: DataFrame, batch: DataFrame, now: datetime | Column) -> DataFrame:
    """Pollutants have no ``updated_at``, and unknown fields are ignored."""
    return merge_dimension(target, batch, "pollutant_code", now, touch=None, ignore_unknown=True)
