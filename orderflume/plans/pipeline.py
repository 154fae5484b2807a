"""The whole batch: raw deltas in, published weekly facts out.

Stages hand over parquet tables, so a stage restarts from disk and no plan grows across
stages. Raw text is parsed once, when each table is collapsed and flagged; validation, id
discovery and the contract all read that staged form.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflume.functions.rows import frozen
from orderflume.functions.temporal import inferred_formats
from orderflume.model import (
    ASSEMBLED,
    ENTITY_REFERENCE,
    SEMANTIC_MODULES,
    SURROGATE_KEYS,
    TABLES,
    TRANSACTION_DETAIL,
    dimension_schema,
    int_name,
    silver_schema,
    tables_with,
)
from orderflume.operators import surrogates
from orderflume.operators.assembly import assemble_events, dimension_reference
from orderflume.operators.contract import (
    COPIES,
    REASON,
    conform,
    contract_metrics,
    data_columns,
    flag_rows,
    kept,
    prune_children,
)
from orderflume.operators.ledger import (
    CHILDREN,
    SHORT_NAMES,
    child_metrics,
    key_numbers,
    ledger_membership,
    ledger_summary,
    order_ledger,
)
from orderflume.operators.semantic import build_module, grain_check
from orderflume.operators.validation import (
    CHECKS,
    ERROR,
    WARNING,
    WatchedTable,
    repeated_keys,
    validate_table,
)
from orderflume.plans.jobs import together
from orderflume.plans.publish import publish
from orderflume.plans.workspace import Workspace
from orderflume.sources import storage
from orderflume.sources.deltas import (
    catalog_scan,
    dated_scan,
    delta_names,
    historical_scan,
    key_scan,
    latest_delta,
    latest_name,
    unread_deltas,
)
from orderflume.sources.file_ledger import FileLedger
from orderflume.sources.registry import Registry
from orderflume.sources.sinks import dated_name, export
from orderflume.sources.storage import Stage
from orderflume.sources.zones import DELTA, delta_date, put_delta, zone_scan

EVENT_TABLES = ("df_orders", "df_order_items", "df_payments")
DIMENSION_TABLES = tuple(t for t, spec in TABLES.items() if spec.role == ENTITY_REFERENCE)


class StageFailure(RuntimeError):
    """A gate or stage that ends the run."""


def orphan_findings(summary: dict[str, int]) -> list[dict]:
    counts = {t: summary[f"{SHORT_NAMES[t]}_orphans"] for t in CHILDREN}
    return [dict(zip(CHECKS.names, (t, "orphan_rows", "order_id", WARNING, n))) for t, n in counts.items() if n]


class Run:
    """One run of the pipeline and its stage reports."""

    def __init__(self, spark: SparkSession, ws: Workspace, catalog: dict[str, str] | None = None):
        self.spark, self.ws = spark, ws
        self.catalog = catalog or {}  # contracted tables that are read from the catalog
        self.watched: dict[str, WatchedTable] = {}
        self.stage = Stage(spark, ws.staging)
        self.reports: dict[str, object] = {}
        self.stems: dict[str, str] = {}
        self.ledger: DataFrame | None = None
        self.summary: dict[str, int] | None = None

    def record(self, name: str, report: object) -> None:
        self.reports[name] = report
        payload = {"run_id": self.ws.run_id, "report": report}
        storage.write_json(self.spark, f"{self.ws.logs}/{name}.json", payload)

    def write(self, df: DataFrame, path: str) -> None:
        if not export(df, path, "errorifexists"):
            raise StageFailure(f"could not write {path}")

    # --- raw ------------------------------------------------------------------------------

    def load_raw(self) -> tuple[dict[str, DataFrame], frozenset[str]]:
        """Latest delta of every table, collapsed, flagged and staged."""

        def load(table: str) -> tuple[DataFrame, bool]:
            raw, stem = latest_delta(self.spark, self.ws.raw, table)
            self.stems[table] = stem
            spec = TABLES[table]
            if set(spec.required) - set(raw.columns):
                return raw, False  # the gate reports it and stops the run
            # by type, whatever file a column comes from: ingested deltas are text as well
            textual = any(t == "string" for _, t in raw.dtypes)
            formats = inferred_formats(raw, spec)
            if formats:
                self.record(f"timestamp_formats_{table}", {c: found._asdict() for c, found in formats.items()})
            return self.stage.put(f"flagged_{table}", flag_rows(raw, spec, formats)), textual

        loaded = together(self.spark, *[lambda t=t: load(t) for t in TABLES])
        flagged = {t: df for t, (df, _) in zip(TABLES, loaded)}
        return flagged, frozenset(t for t, (_, text) in zip(TABLES, loaded) if text)

    def report(self, name: str, findings: list[dict], fatal: Callable[[dict], bool]) -> None:
        self.record(name, {"status": "failed" if findings else "success", "findings": findings})
        stopping = [f for f in findings if fatal(f)]
        if stopping:
            raise StageFailure(f"{name}: {stopping}")

    def gate(
        self,
        name: str,
        tables: dict[str, DataFrame],
        summary: dict[str, int] | None,
        textual: frozenset[str],
        fatal: Callable[[dict], bool],
    ) -> None:
        """Findings are a few rows per table and column, whatever the size of the data.

        ``summary`` holds what the order ledger has counted; without it (a table lacks its
        columns) every table is checked on its own.
        """

        def check(table: str) -> list[dict]:
            known = key_numbers(summary, table) if summary and table in SHORT_NAMES else None
            report = validate_table(tables[table], TABLES[table], table in textual, known)
            return [row.asDict() for row in report.collect()]

        checked = together(self.spark, *[lambda t=t: check(t) for t in tables])
        findings = [finding for part in checked for finding in part]
        self.report(name, findings + (orphan_findings(summary) if summary else []), fatal)

    def take_ledger(self, flagged: dict[str, DataFrame]) -> None:
        """Gather what is known per order id, once for gate, surrogates and contract."""
        self.ledger = self.stage.put("order_ledger", order_ledger(flagged))
        self.summary = ledger_summary(self.ledger).first().asDict()

    def raw_gate(self, flagged: dict[str, DataFrame], textual: frozenset[str]) -> None:
        """Only errors stop a run here; the contract removes what is merely a warning."""
        if all(REASON in flagged[t].columns for t in SHORT_NAMES):
            self.take_ledger(flagged)
        self.gate(
            "initial_validation", flagged, self.summary, textual, lambda f: f["severity"] == ERROR
        )

    # --- surrogates -----------------------------------------------------------------------

    def earlier_ids(self, key: str) -> tuple[list[DataFrame], list[Callable[[], None]]]:
        """Ids in raw deltas that no run has opened, and what puts those deltas on record."""
        frames, records = [], []
        for table in tables_with(key):
            ledger = FileLedger(self.spark, f"{self.ws.id_mapping}/{key}.files/{table}")
            names, files = unread_deltas(self.spark, self.ws.raw, table, ledger)
            if names:
                latest = latest_name(self.spark, self.ws.raw, table)  # its rows are in the batch already
                frames += key_scan(self.spark, self.ws.raw, table, key, [n for n in names if n != latest])
                files = self.stage.put(f"files_{key}_{table}", files)
                records.append(lambda ledger=ledger, files=files: ledger.record(files))
        return frames, records

    def resolve_key(self, key: str, flagged: dict[str, DataFrame]) -> DataFrame:
        """Mapping of one id for this run; new ids, those of unopened older deltas too, are registered."""
        number = int_name(key)
        registry = Registry(self.spark, self.ws.id_mapping, key)
        if key == "order_id":
            batch = self.ledger.where("order_id is not null").select("order_id")
        else:
            batch = surrogates.discover_keys([flagged[t] for t in tables_with(key)], key)
        earlier, records = self.earlier_ids(key)
        if earlier:
            batch = surrogates.discover_keys([batch, *earlier], key)
        history = registry.table()
        current = surrogates.max_surrogate(history, key).first()[0]
        matched = self.stage.put(f"ids_{key}", surrogates.match_registry(batch, history, key))
        known = matched.where(F.col(number).isNotNull())
        fresh = matched.where(F.col(number).isNull()).select(key)
        if not fresh.isEmpty():
            numbered = self.stage.put(f"new_{key}", surrogates.assign_surrogates(fresh, key, current))
            registry.append(numbered)
            known = known.unionByName(numbered)
        for record in records:
            record()
        return known

    def resolve_mappings(self, flagged: dict[str, DataFrame]) -> dict[str, DataFrame]:
        jobs = [lambda k=k: self.resolve_key(k, flagged) for k in SURROGATE_KEYS]
        return dict(zip(SURROGATE_KEYS, together(self.spark, *jobs)))

    # --- contract -------------------------------------------------------------------------

    def contract(self, flagged: dict[str, DataFrame], mappings: dict[str, DataFrame]) -> None:
        """Contracted tables of this run, waiting next to the history for the second gate."""
        lines = self.stage.put(
            "order_lines", self.ledger.join(mappings["order_id"], "order_id", "left")
        )
        memberships = {t: ledger_membership(lines, t) for t in CHILDREN}
        check_parent = self.summary["valid_orders"] > 0

        # The raw gate let no key through that has two different rows, so a collapsed table
        # holds its primary key once; null keys were rejected.
        def write(table: str) -> None:
            spec, rows = TABLES[table], flagged[table]
            if spec.role == TRANSACTION_DETAIL:
                pruned = prune_children(rows, memberships[table], check_parent, unique=True)
                conformed = conform(pruned, spec, keep=(int_name("order_id"),))
            else:
                conformed = conform(kept(rows), spec)
            silver = surrogates.attach_surrogates(
                conformed, mappings, scan=rows, unique=spec.primary_key
            )
            self.watched[table] = WatchedTable(frozen(silver, silver_schema(table)), spec)
            self.watched[table].frame.write.parquet(f"{self.ws.pending}/{self.stems[table]}.parquet")

        def count(table: str) -> dict:
            cut = len(data_columns(flagged[table])) - len(TABLES[table].required)
            if table in CHILDREN:
                return child_metrics(self.summary, table, cut)
            return contract_metrics(flagged[table], TABLES[table]).first().asDict()

        done = together(
            self.spark,
            *[lambda t=t: write(t) for t in TABLES],
            *[lambda t=t: count(t) for t in TABLES],
        )
        self.record("contract_application", done[len(TABLES) :])

    def silver(self, table: str) -> DataFrame:
        """What this run's contract wrote."""
        path = f"{self.ws.pending}/{self.stems[table]}.parquet"
        return self.spark.read.schema(silver_schema(table)).parquet(path)

    def silver_gate(self) -> None:
        """After the contract nothing may be left to report.

        Nulls, timestamps and signs were counted while the tables were written. What is left is whether keys are unique
        and children have parents, for which only the keys are read.
        """
        keys = {t: self.silver(t).selectExpr("order_id", f"1L as {COPIES}", f"cast(null as string) as {REASON}") for t in SHORT_NAMES}
        others = [t for t in TABLES if t not in SHORT_NAMES]
        summary, *unique = together(
            self.spark,
            lambda: ledger_summary(order_ledger(keys)).first().asDict(),
            *[lambda t=t: repeated_keys(self.silver(t), list(TABLES[t].primary_key)).isEmpty() for t in others],
        )
        if not all(unique) or any(key_numbers(summary, t) != (0, 0) for t in SHORT_NAMES):
            tables = {t: self.silver(t) for t in TABLES}  # find out exactly what repeats
            self.gate("post_contract_validation", tables, None, frozenset(), lambda finding: True)
            raise StageFailure("post_contract_validation: repeated keys")
        findings = [f for t in TABLES for f in self.watched[t].findings()]
        self.report("post_contract_validation", findings + orphan_findings(summary), lambda finding: True)

    def promote(self) -> None:
        """The run's rows take the place of their days in the history."""

        def put(table: str) -> None:
            date = delta_date(self.stems[table], self.ws.run_date)
            put_delta(self.silver(table), f"{self.ws.contracted}/{table}", date)

        together(self.spark, *[lambda t=t: put(t) for t in TABLES])

    # --- events and facts -----------------------------------------------------------------

    def assemble(self) -> None:
        spark, ws = self.spark, self.ws

        def history(table: str) -> DataFrame:
            if table in self.catalog:
                return frozen(catalog_scan(spark, self.catalog[table]), silver_schema(table))
            days = zone_scan(spark, f"{ws.contracted}/{table}", silver_schema(table)).drop(DELTA)
            if not delta_names(spark, ws.contracted, table, ("parquet",)):
                return days
            return days.unionByName(historical_scan(spark, ws.contracted, table, silver_schema(table)))

        def events() -> None:
            events = assemble_events(*[history(t) for t in EVENT_TABLES])
            self.write(events, f"{ws.assembled}/{dated_name('assembled_events', ws.run_id)}.parquet")

        def dimension(table: str) -> None:
            key = int_name(TABLES[table].primary_key[0])
            reference = dimension_reference(history(table), key, dimension_schema(table))
            self.write(reference, f"{ws.assembled}/{dated_name(table, ws.run_id)}.parquet")

        together(spark, events, *[lambda t=t: dimension(t) for t in DIMENSION_TABLES])
        self.record("assemble_events", {"status": "success"})

    def model(self) -> None:
        spark, ws = self.spark, self.ws
        events = dated_scan(spark, ws.assembled, "assembled_events", ASSEMBLED)
        dimensions = {
            t: dated_scan(spark, ws.assembled, t, dimension_schema(t)) for t in DIMENSION_TABLES
        }

        def write(module: str, table: str, df: DataFrame) -> None:
            self.write(df, f"{ws.semantic}/{module}/{dated_name(table, ws.run_id)}.parquet")

        jobs = [
            lambda m=module, t=table, d=df: write(m, t, d)
            for module in SEMANTIC_MODULES
            for table, df in build_module(module, events, dimensions).items()
        ]
        together(spark, *jobs)
        # Facts and dimensions are grouped by their grain; events are unique only if no order
        # came in two deltas, which is worth a report.
        grains = grain_check({"assembled_events": (events.select("order_id_int"), ["order_id_int"])})
        self.record("semantic_modeling", {"status": "success", "grain": grains.first().asDict()})

    def publish(self) -> None:
        report = publish(self.spark, self.ws)
        self.record("prepublishing_validation", report)
        if report["status"] == "failed":
            raise StageFailure(f"publish: {report['failed_step']}")

    # --- all of it ------------------------------------------------------------------------

    def execute(self) -> dict[str, object]:
        started = datetime.now(timezone.utc)
        status = "FAILED"
        try:
            flagged, textual = self.load_raw()
            self.raw_gate(flagged, textual)
            self.contract(flagged, self.resolve_mappings(flagged))
            self.silver_gate()
            self.promote()
            self.assemble()
            self.model()
            self.publish()
            status = "SUCCESS"
            # As large as the raw data and of no use to anyone now; a failed run keeps it.
            storage.remove_directory(self.spark, self.ws.staging)
        finally:
            ended = datetime.now(timezone.utc)
            storage.write_json(
                self.spark,
                self.ws.metadata,
                {
                    "run_id": self.ws.run_id,
                    "status": status,
                    "started_at": started.isoformat(),
                    "completed_at": ended.isoformat(),
                    "run_seconds": (ended - started).total_seconds(),
                    "published": status == "SUCCESS",
                },
            )
        return self.reports


def run_pipeline(
    spark: SparkSession, base: str, run_id: str | None = None, catalog: dict[str, str] | None = None
) -> Workspace:
    """Run every stage under ``base``; raises at the first gate or stage that fails.

    ``catalog`` names catalog tables that hold the contracted history of some tables.
    """
    ws = Workspace(base, run_id) if run_id else Workspace(base)
    Run(spark, ws, catalog).execute()
    return ws
