"""Merging a batch into keyed rows.

The batch is called stage, the rows it lands on core. A primary key is unique in core, so hashing
on it spreads evenly. Where a stage may repeat a key, repeats are reduced before any shuffle: by
partial counts, or by the row-number limit that Spark applies in each map task first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or hold a NULL, with their row counts."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter((F.col("n_rows") > 1) | _any_null(keys))


def _any_null(keys: Sequence[str]) -> Column:
    test = F.lit(False)
    for key in keys:
        test = test | F.col(key).isNull()
    return test


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    return df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows, failing at run time where a key is NULL or repeated.

    Only the key columns are aggregated for the test; the rows themselves are not moved.
    """
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    kind = F.when(_any_null(keys), F.lit("null in key: ")).otherwise(F.lit("duplicate key: "))
    said = F.concat(kind, shown)
    found = key_violations(df, keys).agg(
        F.concat(F.max(said), F.lit("; first of them "), F.min(said), F.lit("; keys at fault: "), F.count("*")).alias("broken")
    )
    broken = found.scalar()
    return df.filter(F.when(broken.isNull(), F.lit(True)).otherwise(F.raise_error(broken).cast("boolean")))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last by ``order``, NULLs first."""
    newest = [F.col(c).desc_nulls_last() for c in order]
    return _ranked(df, keys, newest).filter(F.col(_RANK) == 1).drop(_RANK)


def upsert_update(
    core: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    order: Sequence[str] = (),
) -> DataFrame:
    """Core with stage rows inserted, or put in place of the rows with their key.

    A key that stage holds twice is an error, or with ``on_duplicate="latest"`` its last row by
    ``order`` wins. ``order`` columns that core lacks are used for that choice and dropped.
    """
    if on_duplicate == "latest":
        incoming = latest_per_key(stage, keys, [*order, *[c for c in core.columns if c not in keys]])
    elif on_duplicate == "error":
        incoming = require_keys(stage, keys)
    else:
        raise ValueError(f"on_duplicate must be 'error' or 'latest', not {on_duplicate!r}")
    # the reduced stage: one row per key, so no hot key on the side that can't be split
    kept = core.join(incoming.select(*keys), list(keys), "left_anti").select(*core.columns)
    return kept.unionByName(incoming.select(*core.columns))


def upsert_ignore(core: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Core with the stage rows whose key it lacks; what is there stays as it is.

    Of several stage rows with one key the smallest by its other columns goes in.
    """
    others = [F.col(c).asc_nulls_last() for c in core.columns if c not in keys]
    first = _ranked(stage, keys, others or list(keys)).filter(F.col(_RANK) == 1)
    absent = first.join(core.select(*keys), list(keys), "left_anti").select(*core.columns)
    return core.unionByName(absent)


def upsert_or_drop(core: DataFrame, stage: DataFrame, keys: Sequence[str], gone: str = "gone") -> DataFrame:
    """Like ``upsert_update``, but a stage row marked ``gone`` takes the row of its key away."""
    incoming = require_keys(stage, keys)
    kept = core.join(incoming.select(*keys), list(keys), "left_anti").select(*core.columns)
    return kept.unionByName(incoming.filter(~F.col(gone)).select(*core.columns))


def upsert_fill(core: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Like ``upsert_ignore``, and NULL values in core take the stage's value for their key."""
    others = [c for c in core.columns if c not in keys]
    first = _ranked(stage, keys, [F.col(c).asc_nulls_last() for c in others] or list(keys))
    first = first.filter(F.col(_RANK) == 1).select(*core.columns)
    joined = core.alias("c").join(first.alias("s"), list(keys), "full_outer")
    return joined.select(
        *[F.col(c) if c in keys else F.coalesce(f"c.{c}", f"s.{c}").alias(c) for c in core.columns]
    )


def survivors(df: DataFrame, keys: Sequence[str], order: Sequence[str], origin: str | None = None) -> DataFrame:
    """One row per key: of each other column the newest value, by ``order``, that is not NULL.

    One aggregation with partial maxima, whatever the number of columns and of rows a key has. ``origin`` (a column) is
    told for each value as ``{column}_from``. Of values of one place in the order the largest counts. A row moves with its
    place beside each value, so ``order`` should be narrow."""
    values = [c for c in df.columns if c not in (*keys, *order) and c != origin]
    found = []
    for c in values:
        told = [F.col(origin).alias("origin")] if origin else []
        place = F.struct(*order, F.col(c).alias("value"), *told)
        found.append(F.max(F.when(F.col(c).isNotNull(), place)).alias(c))
    picked = [F.col(f"{c}.value").alias(c) for c in values]
    told = [F.col(f"{c}.origin").alias(f"{c}_from") for c in values] if origin else []
    # rows are sorted by the grouping; keys go from the general to the special, whose values seldom tie
    return df.groupBy(*reversed(keys)).agg(*found).select(*keys, *picked, *told)
