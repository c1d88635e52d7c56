"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    newest: Sequence[str] = (),
    tiebreak: Sequence[Column] | None = None,
) -> DataFrame:
    """The newest row of each key; rows with equal times are ranked by ``tiebreak``.

    Without a tiebreak the rank is a hash over the whole row, so the same input
    always keeps the same row. Spark applies the ``== 1`` limit before the
    shuffle too, so a key with very many copies sends one row per task.
    """
    order = [F.col(c).desc_nulls_last() for c in newest]
    order += list(tiebreak) if tiebreak is not None else [F.xxhash64(*df.columns).asc()]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def latest_where_keyed(df: DataFrame, key: str, newest: Sequence[str], tiebreak=None) -> DataFrame:
    """As ``latest_per_key``, but rows without a key are all kept: they are not copies of one another.

    Each of them gets a number of its own as a second key, so the source is read once and they spread over all tasks.
    """
    order = tiebreak if tiebreak is not None else [F.xxhash64(*df.columns).asc()]
    lone = df.withColumn("_lone", F.when(F.col(key).isNull(), F.monotonically_increasing_id()))
    return latest_per_key(lone, [key, "_lone"], newest, order).drop("_lone")


def latest_with_row_key(df: DataFrame, key: str, newest: Sequence[str], tiebreak=None) -> DataFrame:
    """As ``latest_where_keyed`` for a text key, but ``key`` becomes ``_key`` and ``_keyed``.

    ``_key`` is the key, or a random text of its own for a row that has none (``_keyed`` false). Rows are dealt by this
    one column, so a join by it that follows needs no shuffle of them. ``restore_key`` brings the key back.
    """
    order = tiebreak if tiebreak is not None else [F.xxhash64(*df.columns).asc()]
    dealt = df.withColumns({"_key": F.coalesce(F.col(key), F.uuid()), "_keyed": F.col(key).isNotNull()})
    if tiebreak is not None:
        dealt = dealt.drop(key)
    return latest_per_key(dealt, ["_key"], newest, order).drop(key)


def restore_key(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(key, F.when(F.col("_keyed"), F.col("_key"))).drop("_key", "_keyed")
