"""Persistent integer surrogates for string ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflume.model import SURROGATE_KEYS, int_name
from orderflume.operators.lookup import lookup_join

# Hex digits of the key's md5 that pick its numbering bucket: 16**3 buckets. Keys are
# distinct and md5 is even, so buckets are too; raise it when a bucket outgrows a task.
BUCKET_DIGITS = 3


def discover_keys(frames: list[DataFrame], key: str) -> DataFrame:
    """Distinct non-null ids over all frames that hold the id."""
    columns = [f.selectExpr(f"cast({key} as string) as {key}") for f in frames]
    return reduce(DataFrame.union, columns).where(f"{key} is not null").distinct()


def known_mappings(registry: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """History restricted to the ids of this batch, one surrogate per id also where deltas
    overlap.

    The semi join comes first: its runtime filter lets the history scan drop what the batch
    cannot contain before anything is shuffled, and the grouping keeps its partitioning.
    """
    number = int_name(key)
    found = registry.select(key, number).join(batch, key, "left_semi")
    return found.groupBy(key).agg(F.expr(f"cast(min({number}) as bigint) as {number}"))


def max_surrogate(registry: DataFrame, key: str) -> DataFrame:
    """One row: highest surrogate given out so far, 0 for an empty history."""
    return registry.selectExpr(f"cast(coalesce(max({int_name(key)}), 0) as bigint) as current_max")


def new_keys(batch: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return batch.join(known, key, "left_anti")


def match_registry(batch: DataFrame, registry: DataFrame, key: str) -> DataFrame:
    """Batch ids with their surrogate, null for new ids."""
    return batch.join(known_mappings(registry, batch, key), key, "left")


def assign_surrogates(
    fresh: DataFrame, key: str, current_max: int, digits: int = BUCKET_DIGITS
) -> DataFrame:
    """Dense surrogates ``current_max + 1 ... current_max + n`` for distinct new ids.

    Ids are numbered inside buckets of their hash and each bucket is shifted by the size of
    the buckets before it, i.e. ids are ordered by (bucket, id). The number depends on the
    set of ids alone, never on task or partition placement, so a lost executor recomputes
    the same one. Only bucket sizes are broadcast: at most ``16 ** digits`` rows.
    """
    number = int_name(key)
    bucketed = fresh.selectExpr(key, f"substring(md5({key}), 1, {digits}) as _bucket")
    numbered = bucketed.selectExpr(
        key, "_bucket", f"row_number() over (partition by _bucket order by {key}) as _place"
    )
    # Running totals over one row per bucket: a bounded handful, whatever the number of ids.
    shifts = (
        bucketed.groupBy("_bucket")
        .agg(F.expr("count(1) as _size"))
        .selectExpr("_bucket", "sum(_size) over (order by _bucket) - _size as _shift")
    )
    return numbered.join(F.broadcast(shifts), "_bucket").selectExpr(
        key, f"{current_max}L + _shift + _place as {number}"
    )


def resolve_mapping(batch: DataFrame, registry: DataFrame | None, key: str, current_max: int) -> DataFrame:
    """Mapping for a batch: surrogates from history, then fresh ones (lazy form)."""
    if registry is None:
        return assign_surrogates(batch, key, current_max)
    known = known_mappings(registry, batch, key)
    return known.unionByName(assign_surrogates(new_keys(batch, known, key), key, current_max))


def attach_surrogates(
    df: DataFrame,
    mappings: dict[str, DataFrame],
    scan: DataFrame | None = None,
    unique: tuple[str, ...] = (),
) -> DataFrame:
    """Adds ``<id>_int`` for every id in the table that has none yet.

    One seller, customer or product may fill most of a table, which ``lookup_join`` takes
    care of; ``scan`` is the stored frame it may look for such ids in. ``unique`` names the
    ids the table is known to hold once.
    """
    for key in SURROGATE_KEYS:
        if key in df.columns and key in mappings and int_name(key) not in df.columns:
            df = lookup_join(df, mappings[key], key, scan=scan, unique=key in unique)
    return df
