"""Join of a possibly skewed frame to a lookup that holds each key once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot if it holds more than 1/HOT_SHARE of the rows (and is frequent at all). By
# counting, fewer than HOT_SHARE keys can be hot, whatever the data: none is left out, what
# is broadcast is bounded, and no other key is heavier than that share.
HOT_SHARE = 50_000
HOT_MIN_ROWS = 10_000


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of a frame (what its own broadcast rule looks at)."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; -1 when switched off."""
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """All hot keys, found in one pass and handed on as a local table of under HOT_SHARE rows."""
    found = df.sparkSession.sql(
        f"""
        with counts as (
          select {key}, count(1) as n from {{counted}} where {key} is not null group by {key}
        )
        select {key} from counts
        where n >= {HOT_MIN_ROWS} and n > (select sum(n) from counts) / {HOT_SHARE}
        """,
        counted=df.select(key),
    )
    return df.sparkSession.createDataFrame(found.toArrow())


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    *,
    scan: DataFrame | None = None,
    unique: bool = False,
    repeats: bool = False,
    small: int | None = None,
) -> DataFrame:
    """``df`` left-joined to ``lookup`` on ``key``; ``lookup`` must be unique per key.

    Below the broadcast threshold this is a plain join, which Spark broadcasts. Above it the
    join shuffles, and then the rows of hot keys (and of null keys) would pile up in one
    task: those get their answer from a broadcast of fewer than HOT_SHARE lookup rows and are
    spread over all partitions by a hash of the row, which is stable under task retries. A
    hash keeps copies of one row together; where there may be many (``repeats``), hot rows
    are answered in a scan of their own and are not shuffled at all.

    Hot keys are looked for in ``scan``: a stored frame ``df`` comes from, of which only the
    key column is read. Without it ``df`` itself is evaluated for them. Which keys are taken
    for hot decides where rows go, never what they get. Where a gate has established that
    ``df`` holds each key once (``unique``), there is nothing to look for.
    """
    limit = broadcast_limit(df) if small is None else small
    values = [c for c in lookup.columns if c != key]
    if unique or estimated_bytes(lookup) <= limit:
        return df.join(lookup, key, "left").select(*df.columns, *values)

    hot = hot_keys(df if scan is None else scan, key)
    hot_rows = lookup.join(F.broadcast(hot), key, "left_semi")
    answers = hot.join(F.broadcast(hot_rows), key, "left").selectExpr(
        key, "true as _hot", *[f"{v} as _hot_{v}" for v in values]
    )
    answered = df.join(F.broadcast(answers), key, "left")
    if repeats:
        staying = answered.where(f"_hot or {key} is null")
        moving = answered.where(f"_hot is null and {key} is not null").select(*df.columns)
        return staying.selectExpr(
            *[f"`{c}`" for c in df.columns], *[f"_hot_{v} as {v}" for v in values]
        ).unionByName(moving.join(lookup, key, "left").select(*df.columns, *values))
    row = ", ".join(f"`{c}`" for c in df.columns)
    marked = answered.selectExpr(
        "*", f"case when _hot or {key} is null then xxhash64({row}) | 1L else 0L end as _salt"
    )
    # Lookup rows all carry salt 0, so spread rows (odd salts) meet none of them and stay
    # where they are. It is computed: a literal would be folded out of the join key.
    salted = lookup.selectExpr("*", f"pmod(xxhash64({key}), 1L) as _salt")
    joined = marked.join(salted, [key, "_salt"], "left")
    return joined.selectExpr(
        *[f"`{c}`" for c in df.columns], *[f"coalesce(_hot_{v}, {v}) as {v}" for v in values]
    )
