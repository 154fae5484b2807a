"""Weekly facts kept up to date from mergeable partial aggregates.

Every delta leaves, per entity and ISO week, sums, counts and a minimum that can be added to those of other deltas. They
lie in a zone table, one partition per delta, far smaller than the events. A fact is their merge. When a delta comes, or
comes again, only the weeks that it has now or had before are merged anew, and only those partitions of the fact table
are replaced; events of other deltas are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflume.functions.rows import frozen
from orderflume.functions.temporal import week_start
from orderflume.model import weekly_fact_schema
from orderflume.sources import storage
from orderflume.sources.zones import DELTA, put_delta, zone_scan

WEEK = "order_year_week"
_SUMS = {
    "orders": "count(order_id_int)",
    "delivered": "count_if(order_status = 'delivered')",
    "cancelled": "count_if(order_status = 'cancelled')",
    "revenue": "sum(cast(order_revenue as double))",
    "lead_days": "sum(lead_time_days)",
    "lead_known": "count(lead_time_days)",
    "delay_days": "sum(delivery_delay_days)",
    "delay_known": "count(delivery_delay_days)",
    "lag_days": "sum(approval_lag_days)",
    "lag_known": "count(approval_lag_days)",
}


def partial_schema(entity: str) -> T.StructType:
    sums = [T.StructField(c, T.DoubleType() if c == "revenue" else T.LongType()) for c in _SUMS]
    return T.StructType([T.StructField(f"{entity}_id_int", T.LongType()), T.StructField(WEEK, T.StringType()), T.StructField("week_start_date", T.TimestampNTZType()), *sums])


def partial_fact(events: DataFrame, entity: str) -> DataFrame:
    """What one set of events adds to every (entity, week); merging is addition and the lesser start."""
    return events.groupBy(f"{entity}_id_int", WEEK).agg(
        F.expr(f"min({week_start('order_date')}) as week_start_date"),
        *[F.expr(f"{how} as {name}") for name, how in _SUMS.items()],
    )


def merge_partials(partials: DataFrame, entity: str) -> DataFrame:
    """The weekly fact that all the merged events have."""
    merged = partials.groupBy(f"{entity}_id_int", WEEK).agg(
        F.min("week_start_date").alias("week_start_date"), *[F.sum(c).alias(c) for c in _SUMS]
    )
    fact = merged.selectExpr(
        f"{entity}_id_int",
        WEEK,
        "week_start_date",
        "orders as weekly_order_count",
        "delivered as weekly_delivered_orders",
        "cancelled as weekly_cancelled_orders",
        "coalesce(revenue, 0D) as weekly_revenue",
        "try_divide(lead_days, lead_known) as weekly_avg_lead_time",
        "coalesce(lead_days, 0L) as weekly_total_lead_time",
        "try_divide(delay_days, delay_known) as weekly_avg_delivery_delay",
        "coalesce(delay_days, 0L) as weekly_total_delivery_delay",
        "try_divide(lag_days, lag_known) as weekly_avg_approval_lag",
    )
    return frozen(fact, weekly_fact_schema(entity))


class KeptFact:
    """The fact of one entity under ``root``, with the partials that it is made of."""

    def __init__(self, spark: SparkSession, root: str, entity: str):
        self.spark, self.entity = spark, entity
        self.partials_path, self.fact_path = f"{root}/{entity}_partials", f"{root}/{entity}_weekly_fact"

    def partials(self) -> DataFrame:
        return zone_scan(self.spark, self.partials_path, partial_schema(self.entity))

    def fact(self) -> DataFrame:
        schema = weekly_fact_schema(self.entity)
        if not storage.entries(self.spark, self.fact_path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.fact_path).select(schema.names)

    def _weeks(self, condition: Column) -> set[str | None]:
        """Weeks of some partials: a few hundred labels."""
        return {r[0] for r in self.partials().where(condition).select(WEEK).distinct().collect()}

    def merged(self, weeks: set[str | None]) -> DataFrame:
        """The fact of some weeks; the condition reaches the scan of the partials."""
        return merge_partials(self.partials().where(_one_of(weeks)), self.entity)

    def refresh(self, events: DataFrame, date: str) -> list[str | None]:
        """Take the events of one delta, in place of what the delta had before; returns the weeks that were merged."""
        of_delta = F.col(DELTA) == F.lit(date).cast("date")
        weeks = self._weeks(of_delta)
        put_delta(partial_fact(events, self.entity), self.partials_path, date)
        weeks |= self._weeks(of_delta)
        if weeks:
            self._replace(weeks)
        return sorted(weeks, key=lambda w: (w is None, w))

    def _replace(self, weeks: set[str | None]) -> None:
        rows = self.merged(weeks).hint("rebalance", F.col(WEEK))  # few files a week, large weeks in several
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(WEEK).parquet(self.fact_path)
        # Dynamic overwrite leaves a week alone that has no rows any more.
        empty = {f"{WEEK}={_folder(w)}" for w in weeks - self._weeks(_one_of(weeks))}
        for name, _ in storage.entries(self.spark, self.fact_path):
            if name in empty:
                storage.remove_directory(self.spark, f"{self.fact_path}/{name}")


def _one_of(weeks: set[str | None]) -> Column:
    known = F.col(WEEK).isin(sorted(w for w in weeks if w is not None))
    return known | F.col(WEEK).isNull() if None in weeks else known


def _folder(week: str | None) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if week is None else week
