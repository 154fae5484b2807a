"""One query per operator over the test tables; each takes (spark, sf_dir)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflume.functions.rows import frozen
from orderflume.functions.temporal import infer_layout, parsed
from orderflume.model import (
    ASSEMBLED,
    ENTITY_REFERENCE,
    SELLER_DIM,
    TABLES,
    TableSpec,
    dimension_schema,
    int_name,
    weekly_fact_schema,
)
from orderflume.operators import assembly, contract, ledger, partials, semantic, surrogates, validation
from orderflume.plans.inputs import Inputs
from orderflume.plans.jobs import together
from orderflume.plans.pipeline import EVENT_TABLES, Run
from orderflume.plans.workspace import Workspace
from orderflume.sources import deltas, storage, zones
from orderflume.sources.file_ledger import FileLedger
from orderflume.sources.registry import Registry
from orderflume.streaming.deliveries import stream_deliveries
from orderflume.sources.ingest import HANDSHAKE_FILE, HANDSHAKE_TEXT, ingest_batch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[function.__name__] = lambda spark, sf_dir: function(Inputs(spark, sf_dir))
    return function


def _rounded(df: DataFrame) -> DataFrame:
    """Money to cents and averages to six places: sums of doubles depend on their order."""
    digits = {"weekly_revenue": 2, "order_revenue": 2}
    return df.selectExpr(
        *[
            f"round(cast({f.name} as double), {digits.get(f.name, 6)}) as {f.name}"
            if f.dataType.simpleString() in ("float", "double")
            else f.name
            for f in df.schema
        ]
    )


# --- sources ----------------------------------------------------------------------------

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


@query
def latest_delta(i: Inputs) -> DataFrame:
    """Orders arrive as an older CSV delta and, for the last year, a parquet one."""
    orders = i.source("orders").select(ORDER_COLUMNS)
    last = orders.selectExpr("max(year(o_orderdate))").first()[0]
    base = f"{i.stage.root}/raw"
    older = orders.where(f"year(o_orderdate) < {last}")
    older.write.option("header", True).csv(f"{base}/df_orders_{last - 1}_12_31.csv")
    orders.where(f"year(o_orderdate) = {last}").write.parquet(f"{base}/df_orders_{last}_12_31.parquet")
    return deltas.latest_delta(i.spark, base, "df_orders")[0]


@query
def csv_scan(i: Inputs) -> DataFrame:
    path = f"{i.stage.root}/df_customers.csv"
    i.raw("df_customers").write.option("header", True).csv(path)
    return deltas.read_csv(i.spark, path)


@query
def historical_scan(i: Inputs) -> DataFrame:
    """Deltas whose key is stored as int in one and bigint in the other, repeats kept."""
    lines = i.source("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    returned = i.source("lineitem").where("l_returnflag = 'R'").selectExpr(
        "cast(l_orderkey as int) as l_orderkey", "l_linenumber", "l_quantity"
    )
    base = f"{i.stage.root}/history"
    returned.write.parquet(f"{base}/lines_2026_01_01.parquet")
    lines.write.parquet(f"{base}/lines_2026_02_01.parquet")
    return deltas.historical_scan(i.spark, base, "lines")


@query
def historical_scan_declared(i: Inputs) -> DataFrame:
    """The same with a declared schema: one scan that widens the narrow delta."""
    lines = i.source("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    returned = i.source("lineitem").where("l_returnflag = 'R'").selectExpr(
        "cast(l_orderkey as int) as l_orderkey", "l_linenumber", "l_quantity"
    )
    base = f"{i.stage.root}/history"
    returned.write.parquet(f"{base}/lines_2026_01_01.parquet")
    lines.write.parquet(f"{base}/lines_2026_02_01.parquet")
    return deltas.historical_scan(i.spark, base, "lines", lines.schema)


@query
def catalog_scan(i: Inputs) -> DataFrame:
    path = f"{i.stage.root}/external_orders"
    i.source("orders").select(ORDER_COLUMNS).write.parquet(path)
    name = f"external_orders_{uuid.uuid4().hex}"
    i.spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    return deltas.catalog_scan(i.spark, name)


@query
def ingest_once(i: Inputs) -> DataFrame:
    """A delivered folder taken over twice lands once."""
    folder, base = f"{i.stage.root}/delivery/delivery_2026_03_25", f"{i.stage.root}/lake"
    i.raw("df_orders").write.option("header", True).csv(f"{folder}/df_orders_2026_03_25.csv")
    storage.write_text(i.spark, f"{folder}/{HANDSHAKE_FILE}", HANDSHAKE_TEXT)
    for _ in range(2):
        ingest_batch(i.spark, folder, base)
    return i.spark.read.parquet(f"{base}/raw/df_orders_2026_03_25.parquet")


@query
def stream_ingest(i: Inputs) -> DataFrame:
    """Two deliveries, each taken over by its own call of the stream."""
    landing, base = f"{i.stage.root}/landing", f"{i.stage.root}/lake"
    orders = i.raw("df_orders")
    first = F.col("order_status") == "delivered"
    for day, part in (("2026_03_25", orders.where(first)), ("2026_03_26", orders.where(~first))):
        part.write.option("header", True).csv(f"{landing}/df_orders_{day}.csv")
        stream_deliveries(i.spark, landing, "df_orders", base).awaitTermination()
    return deltas.historical_scan(i.spark, f"{base}/raw", "df_orders", orders.schema)


@query
def ingest_mixed_formats(i: Inputs) -> DataFrame:
    """One delta delivered as a CSV and a parquet file of the same stem."""
    folder, base = f"{i.stage.root}/delivery/delivery_2026_03_26", f"{i.stage.root}/lake"
    orders = i.raw("df_orders")
    first = F.col("order_status") == "delivered"
    orders.where(first).write.option("header", True).csv(f"{folder}/df_orders_2026_03_26.csv")
    orders.where(~first).write.parquet(f"{folder}/df_orders_2026_03_26.parquet")
    storage.write_text(i.spark, f"{folder}/{HANDSHAKE_FILE}", HANDSHAKE_TEXT)
    ingest_batch(i.spark, folder, base)
    return i.spark.read.parquet(f"{base}/raw/df_orders_2026_03_26.parquet")


@query
def stream_late_parts(i: Inputs) -> DataFrame:
    """One delivery whose parts arrive over two calls of the stream."""
    landing, base = f"{i.stage.root}/landing", f"{i.stage.root}/lake"
    orders = i.raw("df_orders")
    first = F.col("order_status") == "delivered"
    for part in (orders.where(first), orders.where(~first)):
        part.write.mode("append").option("header", True).csv(f"{landing}/df_orders_2026-03-25.csv")
        stream_deliveries(i.spark, landing, "df_orders", base).awaitTermination()
    return i.spark.read.parquet(f"{base}/raw/df_orders_2026-03-25.parquet")


# --- contract rules ---------------------------------------------------------------------


@query
def enforce_schema(i: Inputs) -> DataFrame:
    return contract.conform(i.raw("df_orders"), TABLES["df_orders"])


@query
def remove_unparsable_ts(i: Inputs) -> DataFrame:
    raw = i.raw("df_orders")
    return contract.keep_rows(raw, contract.unparsable_timestamp(raw))


@query
def remove_impossible_ts(i: Inputs) -> DataFrame:
    raw = i.raw("df_orders")
    return contract.keep_rows(raw, contract.impossible_timestamp(raw))


@query
def remove_null_rows(i: Inputs) -> DataFrame:
    rule = contract.null_violation(TABLES["df_orders"].non_nullable)
    return contract.keep_rows(i.raw("df_orders"), rule)


@query
def rejected_order_ids(i: Inputs) -> DataFrame:
    raw = i.raw("df_orders")
    return contract.rejected_ids(raw, contract.impossible_timestamp(raw))


@query
def dedupe_exact(i: Inputs) -> DataFrame:
    return contract.deduplicate(i.raw("df_orders"))


@query
def dedupe_exact_text(i: Inputs) -> DataFrame:
    return contract.deduplicate(i.source("documents").select("text", "lang"))


@query
def cascade_drop(i: Inputs) -> DataFrame:
    invalid = contract.invalid_orders(i.membership("df_order_items"))
    return contract.cascade_drop(i.raw("df_order_items"), invalid)


@query
def enforce_parent(i: Inputs) -> DataFrame:
    valid = contract.valid_orders(i.membership("df_order_items"))
    return contract.enforce_parent(i.raw("df_order_items"), valid)


@query
def invalid_orders(i: Inputs) -> DataFrame:
    return contract.invalid_orders(i.membership("df_payments"))


@query
def contract_orders(i: Inputs) -> DataFrame:
    return i.contracted("df_orders")


@query
def contract_items(i: Inputs) -> DataFrame:
    return i.contracted("df_order_items")


@query
def contract_payments(i: Inputs) -> DataFrame:
    return i.contracted("df_payments")


@query
def contract_customers(i: Inputs) -> DataFrame:
    return i.contracted("df_customers")


@query
def contract_products(i: Inputs) -> DataFrame:
    return i.contracted("df_products")


@query
def contract_metrics(i: Inputs) -> DataFrame:
    children = ("df_order_items", "df_payments")
    i.prepare(*TABLES)
    return reduce(
        DataFrame.unionByName,
        [
            contract.contract_metrics(
                i.flagged(t), spec, i.membership(t) if t in children else None
            )
            for t, spec in TABLES.items()
        ],
    )


@query
def order_ledger(i: Inputs) -> DataFrame:
    """Counters per order id that gate and contract share."""
    together(i.spark, *[lambda t=t: i.flagged(t) for t in ledger.SHORT_NAMES])
    return ledger.order_ledger({t: i.flagged(t) for t in ledger.SHORT_NAMES})


# --- validation -------------------------------------------------------------------------


def _counts(counts: dict[str, str]) -> list[str]:
    return [f"{n} as {name}" for name, n in counts.items()]


@query
def null_counts(i: Inputs) -> DataFrame:
    collapsed = contract.collapse(i.raw("df_orders"))
    return collapsed.selectExpr(*_counts(validation.null_counts(TABLES["df_orders"].non_nullable)))


@query
def null_pk_count(i: Inputs) -> DataFrame:
    """Items by seller, the id that some of them lack."""
    columns = T.StructType([T.StructField("seller_id", T.StringType()), T.StructField("product_id", T.StringType())])
    collapsed = contract.collapse(i.raw("df_order_items").select(columns.names))
    rules = validation.row_checks(collapsed, TableSpec("items_by_seller", ENTITY_REFERENCE, ("seller_id",), columns))
    return collapsed.selectExpr(*[f"{n} as null_keys" for rule, _, _, n in rules if rule == "null_primary_key"])


@query
def negative_counts(i: Inputs) -> DataFrame:
    collapsed = contract.collapse(i.raw("df_payments_refunds"))
    return collapsed.selectExpr(*_counts(validation.negative_counts(collapsed)))


@query
def unparsable_counts(i: Inputs) -> DataFrame:
    collapsed = contract.collapse(i.raw("df_orders"))
    return collapsed.selectExpr(*_counts(validation.unparsable_counts(collapsed)))


@query
def chronology_counts(i: Inputs) -> DataFrame:
    collapsed = contract.collapse(i.raw("df_orders"))
    return collapsed.selectExpr(*_counts(validation.chronology_counts(collapsed)))


@query
def repairable_dups(i: Inputs) -> DataFrame:
    collapsed = contract.collapse(i.raw("df_orders"))
    return validation.key_profile(collapsed, ["order_id"])


@query
def pk_conflicts(i: Inputs) -> DataFrame:
    collapsed = contract.collapse(i.source("lineitem"))
    return validation.key_profile(collapsed, ["l_orderkey", "l_linenumber"])


@query
def orphan_items(i: Inputs) -> DataFrame:
    return validation.orphan_count(i.raw("df_order_items"), i.raw("df_orders"))


@query
def orphan_payments(i: Inputs) -> DataFrame:
    """Against the contracted orders, which lost some parents."""
    return validation.orphan_count(i.raw("df_payments"), i.contracted("df_orders"))


def _validate(i: Inputs, table: str, source: str | None = None) -> DataFrame:
    return validation.validate_table(i.raw(source or table), TABLES[table])


@query
def validate_orders(i: Inputs) -> DataFrame:
    return _validate(i, "df_orders")


@query
def validate_items(i: Inputs) -> DataFrame:
    return _validate(i, "df_order_items")


@query
def validate_payments(i: Inputs) -> DataFrame:
    return _validate(i, "df_payments", "df_payments_refunds")


@query
def validate_customers(i: Inputs) -> DataFrame:
    """Two versions of the customers of one nation: a key conflict stops the other checks."""
    raw = i.raw("df_customers")
    moved = raw.where("customer_city = 'city7'").selectExpr(
        "customer_id", "customer_state", "'elsewhere' as customer_city",
        "customer_segment", "account_creation_date",
    )
    return validation.validate_table(raw.unionByName(moved), TABLES["df_customers"])


@query
def validate_products(i: Inputs) -> DataFrame:
    """Products without a declared column."""
    raw = i.raw("df_products").drop("supplier_tier")
    return validation.validate_table(raw, TABLES["df_products"])


@query
def validation_report(i: Inputs) -> DataFrame:
    together(i.spark, *[lambda t=t: i.flagged(t) for t in TABLES])
    return validation.validate_tables({t: i.flagged(t) for t in TABLES})


# --- surrogates -------------------------------------------------------------------------


def _order_batch(i: Inputs) -> DataFrame:
    """Order ids of this run, staged because matching and numbering both read them."""
    tables = ("df_orders", "df_order_items", "df_payments")
    batch = surrogates.discover_keys([i.raw(t) for t in tables], "order_id")
    return i.stage.put("order_batch", batch)


def _order_registry(i: Inputs) -> DataFrame:
    """History of an earlier run: it had seen the delivered orders."""
    earlier = i.raw("df_orders").where("order_status = 'delivered'")
    keys = surrogates.discover_keys([earlier], "order_id")
    return i.stage.put("registry", surrogates.assign_surrogates(keys, "order_id", 0))


@query
def discover_keys(i: Inputs) -> DataFrame:
    return surrogates.discover_keys([i.raw("df_orders"), i.raw("df_customers")], "customer_id")


def _registry_and_batch(i: Inputs) -> tuple[DataFrame, DataFrame]:
    return tuple(together(i.spark, lambda: _order_registry(i), lambda: _order_batch(i)))


@query
def known_mappings(i: Inputs) -> DataFrame:
    return surrogates.known_mappings(*_registry_and_batch(i), "order_id")


@query
def new_keys(i: Inputs) -> DataFrame:
    registry, batch = _registry_and_batch(i)
    known = surrogates.known_mappings(registry, batch, "order_id")
    return surrogates.new_keys(batch, known, "order_id")


@query
def max_surrogate(i: Inputs) -> DataFrame:
    return surrogates.max_surrogate(_order_registry(i), "order_id")


@query
def assign_surrogates(i: Inputs) -> DataFrame:
    return surrogates.assign_surrogates(_order_batch(i), "order_id", 5)


@query
def resolve_mapping(i: Inputs) -> DataFrame:
    registry, batch = _registry_and_batch(i)
    current = surrogates.max_surrogate(registry, "order_id").first()[0]
    return surrogates.resolve_mapping(batch, registry, "order_id", current)


@query
def attach_surrogates(i: Inputs) -> DataFrame:
    def number(key: str, *tables: str) -> DataFrame:
        batch = surrogates.discover_keys([i.raw(t) for t in tables], key)
        return i.stage.put(f"map_{key}", surrogates.assign_surrogates(batch, key, 0))

    order_ids, customer_ids, _ = together(
        i.spark,
        lambda: number("order_id", "df_orders", "df_order_items", "df_payments"),
        lambda: number("customer_id", "df_orders", "df_customers"),
        lambda: i.flagged("df_orders"),
    )
    mappings = {"order_id": order_ids, "customer_id": customer_ids}
    orders = i.contracted("df_orders").select("order_id", "customer_id", "order_status")
    return surrogates.attach_surrogates(orders, mappings)


# --- assembly ---------------------------------------------------------------------------


@query
def payments_by_order(i: Inputs) -> DataFrame:
    paid = i.source("lineitem").selectExpr(
        "l_orderkey as order_id_int", "l_extendedprice as payment_value"
    )
    return _rounded(assembly.payments_by_order(paid))


@query
def items_by_order(i: Inputs) -> DataFrame:
    items = i.source("lineitem").selectExpr(
        "l_orderkey as order_id_int", "l_partkey as product_id_int", "l_suppkey as seller_id_int"
    )
    return assembly.items_by_order(items)


@query
def items_by_order_wide(i: Inputs) -> DataFrame:
    """Surrogates beyond 32 bits."""
    wide = [f"{c} + {2**33} as {n}_id_int" for c, n in (("l_partkey", "product"), ("l_suppkey", "seller"))]
    return assembly.items_by_order(i.source("lineitem").selectExpr("l_orderkey as order_id_int", *wide))


@query
def assemble_inner(i: Inputs) -> DataFrame:
    items = assembly.items_by_order(i.keyed("df_order_items"))
    return i.keyed("df_orders").select("order_id_int", "order_status").join(items, "order_id_int")


@query
def derive_fields(i: Inputs) -> DataFrame:
    return assembly.derive_fields(
        i.keyed("df_orders").select(
            "order_id_int",
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_timestamp",
            "order_estimated_delivery_date",
        )
    )


@query
def assembled_events(i: Inputs) -> DataFrame:
    return _rounded(i.assembled())


@query
def assembled_from_lines(i: Inputs) -> DataFrame:
    """Events of orders with several items: every line of ``lineitem``, one event an order."""
    orders, _, payments = i.event_tables()
    lines = i.source("lineitem").selectExpr(
        "l_orderkey as order_id_int", "l_partkey as product_id_int", "l_suppkey as seller_id_int"
    )
    return _rounded(assembly.assemble_events(orders, lines, payments))


@query
def historical_scan_layouts(i: Inputs) -> DataFrame:
    """One delta a month; the key is an int in some years, and later deltas carry one more column type."""
    base = f"{i.stage.root}/history"
    lines = i.source("lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_quantity", "date_format(l_shipdate, 'yyyy_MM') as month"
    )
    months = [r["month"] for r in lines.select("month").distinct().orderBy("month").collect()][-24:]
    by_month = f"{i.stage.root}/by_month"  # the lines are read once; every delta then reads its own month
    lines.where(F.col("month").isin(months)).write.partitionBy("month").parquet(by_month)

    def write(month: str, k: int) -> None:
        narrow = "cast(l_orderkey as int) as l_orderkey" if k % 12 < 6 else "l_orderkey"
        rows = i.spark.read.schema(lines.drop("month").schema).parquet(f"{by_month}/month={month}")
        rows.selectExpr(narrow, "l_linenumber", "l_quantity").write.parquet(f"{base}/lines_{month}_01.parquet")

    together(i.spark, *[lambda m=m, k=k: write(m, k) for k, m in enumerate(months)])
    return deltas.historical_scan(i.spark, base, "lines")


@query
def freeze_assembled(i: Inputs) -> DataFrame:
    """The frozen event table as it is stored, 32-bit floats included."""
    return frozen(i.assembled(), ASSEMBLED)


@query
def grain_check(i: Inputs) -> DataFrame:
    return semantic.grain_check(
        {
            "orders": (i.source("orders"), ["o_orderkey"]),
            "lineitem": (i.source("lineitem"), ["l_orderkey", "l_linenumber"]),
            "seller_weekly_fact": (
                semantic.weekly_fact(i.assembled(), "seller"),
                ["seller_id_int", "order_year_week"],
            ),
        }
    )


# --- semantic ---------------------------------------------------------------------------


def _weekly(i: Inputs, entity: str) -> DataFrame:
    fact = semantic.weekly_fact(i.assembled(), entity)
    return _rounded(frozen(fact, weekly_fact_schema(entity)))


@query
def seller_weekly_fact(i: Inputs) -> DataFrame:
    return _weekly(i, "seller")


@query
def customer_weekly_fact(i: Inputs) -> DataFrame:
    return _weekly(i, "customer")


@query
def product_weekly_fact(i: Inputs) -> DataFrame:
    return _weekly(i, "product")


@query
def seller_dim(i: Inputs) -> DataFrame:
    return frozen(semantic.seller_dim(i.assembled()), SELLER_DIM)


def _dimension(i: Inputs, table: str, changed: str) -> DataFrame:
    """Two deltas of a reference table; the second repeats all keys with one column new."""
    first = i.keyed(table)
    second = first.withColumn(changed, F.concat(F.lit("A "), F.col(changed)))
    key = int_name(TABLES[table].primary_key[0])
    return _rounded(
        assembly.dimension_reference(first.unionByName(second), key, dimension_schema(table))
    )


@query
def customer_dim(i: Inputs) -> DataFrame:
    return _dimension(i, "df_customers", "customer_segment")


@query
def product_dim(i: Inputs) -> DataFrame:
    return _dimension(i, "df_products", "product_category_name")


# --- history, registry and increments -----------------------------------------------------


@query
def promote_twice(i: Inputs) -> DataFrame:
    """Two days of orders, of which the second is delivered again with fewer rows."""
    orders, path = i.contracted("df_orders"), f"{i.stage.root}/history/df_orders"
    rest = orders.where("order_status <> 'delivered'")
    zones.put_delta(orders.where("order_status = 'delivered'"), path, "2026-03-25")
    zones.put_delta(rest, path, "2026-03-26")
    zones.put_delta(rest.where("order_status = 'shipped'"), path, "2026-03-26")
    return zones.zone_scan(i.spark, path, orders.schema).withColumn("delta_date", F.col("delta_date").cast("string"))


@query
def latest_partition(i: Inputs) -> DataFrame:
    """Orders with one partition per year; only the last is opened."""
    orders, path = i.source("orders").select(ORDER_COLUMNS), f"{i.stage.root}/orders"
    dated = orders.withColumn(zones.DELTA, F.expr("make_date(year(o_orderdate), 12, 31)"))
    dated.write.partitionBy(zones.DELTA).parquet(path)
    return zones.latest_of_zone(i.spark, path, orders.schema)[0]


@query
def silver_gate_counts(i: Inputs) -> DataFrame:
    """Row checks of three tables with faults, counted while they are written."""
    sources = {"df_orders": "df_orders", "df_order_items": "df_order_items", "df_payments": "df_payments_refunds"}
    watched = {t: validation.WatchedTable(i.raw(raw), TABLES[t]) for t, raw in sources.items()}
    together(i.spark, *[lambda t=t, w=w: i.stage.put(f"watched_{t}", w.frame) for t, w in watched.items()])
    return i.spark.createDataFrame([f for w in watched.values() for f in w.findings()], validation.CHECKS)


@query
def known_mappings_runs(i: Inputs) -> DataFrame:
    """A registry filled by three runs, one per order status, meets the ids of the items."""
    registry = Registry(i.spark, f"{i.stage.root}/id_mapping", "order_id")
    for status in ("delivered", "shipped", "cancelled"):
        orders = i.raw("df_orders").where(f"order_status = '{status}'")
        batch = i.stage.put(f"batch_{status}", surrogates.discover_keys([orders], "order_id"))
        history = registry.table()
        current = surrogates.max_surrogate(history, "order_id").first()[0]
        known = surrogates.known_mappings(history, batch, "order_id")
        fresh = i.stage.put(f"fresh_{status}", surrogates.new_keys(batch, known, "order_id"))
        registry.append(i.stage.put(f"ids_{status}", surrogates.assign_surrogates(fresh, "order_id", current)))
    wanted = i.stage.put("wanted", surrogates.discover_keys([i.raw("df_order_items")], "order_id"))
    return surrogates.known_mappings(registry.table(), wanted, "order_id")


@query
def discover_all_deltas(i: Inputs) -> DataFrame:
    """Ids of every raw delta, CSV and parquet, and the run that saw them first.

    The second run opens only what came since; most of that it knows already.
    """
    base, ledger = f"{i.stage.root}/raw", FileLedger(i.spark, f"{i.stage.root}/files")
    orders = i.raw("df_orders")

    def new_ids(run: int) -> DataFrame:
        names, files = deltas.unread_deltas(i.spark, base, "df_orders", ledger)
        ids = surrogates.discover_keys(deltas.key_scan(i.spark, base, "df_orders", "order_id", names), "order_id")
        found = i.stage.put(f"ids_{run}", ids)
        ledger.record(i.stage.put(f"files_{run}", files))
        return found

    orders.where("order_status = 'delivered'").write.option("header", True).csv(f"{base}/df_orders_2026_03_24.csv")
    orders.where("order_status = 'shipped'").write.parquet(f"{base}/df_orders_2026_03_25.parquet")
    first = new_ids(1)
    orders.where("order_status <> 'delivered'").write.parquet(f"{base}/df_orders_2026_03_26.parquet")
    second = surrogates.new_keys(new_ids(2), first, "order_id")
    return first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2)))


@query
def assembled_from_catalog(i: Inputs) -> DataFrame:
    """Events from external tables that grow between two calls; the second reads new files only."""
    keyed = dict(zip(EVENT_TABLES, i.event_tables()))
    staged = together(i.spark, *[lambda t=t, df=df: i.stage.put(f"keyed_{t}", df) for t, df in keyed.items()])
    tables = dict(zip(EVENT_TABLES, staged))  # both halves are taken from it
    names = {t: f"external_{t}_{uuid.uuid4().hex}" for t in tables}
    ledgers = {t: FileLedger(i.spark, f"{i.stage.root}/files/{t}") for t in tables}

    def take(t: str, call: int) -> DataFrame:
        rows, files = deltas.catalog_increment(i.spark, names[t], ledgers[t])
        ledgers[t].record(i.stage.put(f"files_{t}_{call}", files))
        return rows  # a scan of files that it names and nobody changes

    def deliver(half: str) -> None:
        paths = {t: f"{i.stage.root}/external/{t}" for t in tables}
        together(i.spark, *[lambda t=t: tables[t].where(half).write.mode("append").parquet(paths[t]) for t in tables])

    even = "order_id_int % 2 = 0"
    deliver(even)
    for t in tables:
        i.spark.sql(f"CREATE TABLE {names[t]} USING parquet LOCATION '{i.stage.root}/external/{t}'")
    first = together(i.spark, *[lambda t=t: take(t, 1) for t in tables])
    deliver(f"not ({even})")
    second = together(i.spark, *[lambda t=t: take(t, 2) for t in tables])
    return _rounded(assembly.assemble_events(*[a.unionByName(b) for a, b in zip(first, second)]))


@query
def facts_by_delta(i: Inputs) -> DataFrame:
    """Seller facts from two deltas of events; the first comes again with more rows."""
    events = i.stage.put("events", i.assembled())
    kept = partials.KeptFact(i.spark, f"{i.stage.root}/facts", "seller")
    even = "order_id_int % 2 = 0"
    kept.refresh(events.where(f"{even} and order_id_int % 3 = 0"), "2026-03-25")
    kept.refresh(events.where(f"not ({even})"), "2026-03-26")
    kept.refresh(events.where(even), "2026-03-25")
    return _rounded(kept.fact())


@query
def inferred_timestamps(i: Inputs) -> DataFrame:
    """Creation dates with a T and fractions, some as plain days, some no dates at all."""
    number = "cast(substring(customer_id, 2) as bigint)"
    raw = i.raw("df_customers").selectExpr(
        "customer_id",
        f"case {number} % 50 when 3 then 'unknown' when 7 then substring(account_creation_date, 1, 10)"
        " else concat(replace(account_creation_date, ' ', 'T'), '.250') end as account_creation_date",
    )
    found = infer_layout(raw, ["account_creation_date"])["account_creation_date"]
    return raw.selectExpr(
        "customer_id",
        f"{parsed(raw, 'account_creation_date', found)} as account_creation_date",
        f"{found.unmatched}L as unmatched",
        f"'{found.layout}' as layout",
    )


# --- the whole pipeline -----------------------------------------------------------------


def _published_run(i: Inputs) -> Workspace:
    """The raw tables delivered as deltas, then every stage up to the published views."""
    base = f"{i.stage.root}/lake"
    together(
        i.spark,
        *[
            lambda t=t: i.raw(t).write.parquet(f"{base}/raw/{t}_2026_03_25.parquet")
            for t in TABLES
        ],
    )
    ws = Workspace(base)
    Run(i.spark, ws).execute()
    return ws


@query
def end_to_end_run(i: Inputs) -> DataFrame:
    ws = _published_run(i)
    published = f"{ws.version}/seller_semantic/seller_weekly_fact_*.parquet"
    return _rounded(i.spark.read.parquet(published))


@query
def published_view(i: Inputs) -> DataFrame:
    ws = _published_run(i)
    versioned = i.spark.table(f"customer_semantic.customer_dim_v{ws.run_id}").columns
    return i.spark.table("customer_semantic.published_customer_dim").select(versioned)


@query
def end_to_end_second_run(i: Inputs) -> DataFrame:
    """Two runs over one lake, each with half of the orders: facts of both, and whether sellers kept their numbers."""
    base, numbers = f"{i.stage.root}/lake", []
    even = "coalesce(try_cast(substring(order_id, 2) as bigint) % 2 = 0, false)"
    for day, half in (("2026_03_25", even), ("2026_03_26", f"not {even}")):
        raw = {t: i.raw(t).where(half) if "order_id" in TABLES[t].required else i.raw(t) for t in TABLES}
        together(i.spark, *[lambda t=t: raw[t].write.parquet(f"{base}/raw/{t}_{day}.parquet") for t in raw])
        ws = Workspace(base)
        Run(i.spark, ws).execute()
        numbers.append(i.stage.put(f"sellers_{day}", Registry(i.spark, ws.id_mapping, "seller_id").table()))
    before, now = numbers[0].withColumnRenamed("seller_id_int", "before"), numbers[1]
    sellers = now.join(before, "seller_id", "left").selectExpr(
        "seller_id", "seller_id_int", "coalesce(before = seller_id_int, true) as same_number"
    )
    fact = i.spark.read.parquet(f"{ws.version}/seller_semantic/seller_weekly_fact_*.parquet")
    return _rounded(fact.join(sellers, "seller_id_int").drop("seller_id_int"))
