"""Publishing a run: gate, immutable version, stable views, pointer."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from orderflume.model import SEMANTIC_MODULES, SemanticTable
from orderflume.plans.jobs import together
from orderflume.plans.workspace import Workspace
from orderflume.sources import storage
from orderflume.sources.sinks import dated_name


def _report(*errors: str) -> dict:
    return {"status": "failed" if errors else "success", "errors": list(errors)}


# What a run holds or ought to hold: () for its folder, (module,), (module, table file) or (module, table file, column).
Part = tuple[str, ...]


def declared_parts(run_id: str) -> set[Part]:
    parts: set[Part] = {()}
    for module, tables in SEMANTIC_MODULES.items():
        for table in tables:
            name = f"{dated_name(table.name, run_id)}.parquet"
            parts |= {(module,), (module, name)} | {(module, name, column) for column in table.schema.names}
    return parts


def written_parts(spark: SparkSession, folder: str) -> set[Part]:
    """From names and parquet footers alone; the footers are read side by side."""
    modules = [name for name, is_dir in storage.entries(spark, folder) if is_dir]
    files = [(m, n) for m in modules for n, _ in storage.entries(spark, f"{folder}/{m}") if n.endswith(".parquet")]
    columns = together(spark, *[lambda p="/".join((folder, *f)): spark.read.parquet(p).columns for f in files]) if files else []
    root = {()} if storage.exists(spark, folder) else set()
    return root | {(m,) for m in modules} | set(files) | {(*f, c) for f, names in zip(files, columns) for c in names}


def integrity_gate(spark: SparkSession, ws: Workspace) -> dict:
    """The run's semantic folder holds the declared modules, tables and columns, and no others of the first two.

    All differences are reported at once, by what they are parts of; what lies in something that is missing or
    unexpected as a whole is not named again.
    """
    declared, written = declared_parts(ws.run_id), written_parts(spark, ws.semantic)
    differences: dict[Part, list[str]] = {}
    for mark, parts in (("without", declared - written), ("besides", written - declared)):
        for part in sorted(parts):
            if part[:-1] not in parts - {part} and (mark == "without" or len(part) < 3):
                differences.setdefault(part[:-1] if part else ("",), []).append(f"{mark} {part[-1]}" if part else "")
    errors = []
    for whole, found in sorted(differences.items()):
        if whole == ("",):
            errors.append("semantic directory is missing")
        elif not whole:
            errors.append(f"semantic modules differ: {', '.join(found)}")
        elif len(whole) == 1:
            errors.append(f"{whole[0]}: table set differs: {', '.join(found)}")
        else:
            errors.append(f"{whole[1]}: missing required columns: {', '.join(found)}")
    return _report(*errors)


def promote_version(spark: SparkSession, ws: Workspace) -> dict:
    """Copy the run's semantic tables to ``published/v<run_id>``, never over an older one."""
    if storage.exists(spark, ws.version):
        return _report("version directory already exists")

    def copy(module: str, table: SemanticTable) -> None:
        name = f"{module}/{dated_name(table.name, ws.run_id)}.parquet"
        rows = spark.read.schema(table.schema).parquet(f"{ws.semantic}/{name}")
        rows.write.mode("errorifexists").parquet(f"{ws.version}/{name}")

    try:
        together(
            spark,
            *[
                lambda m=module, t=table: copy(m, t)
                for module, tables in SEMANTIC_MODULES.items()
                for table in tables
            ],
        )
    except Exception as failure:
        return _report(str(failure))
    return _report()


def swap_views(spark: SparkSession, ws: Workspace) -> dict:
    """Point ``<module>.published_<table>`` at an external table over this version."""
    try:
        for module, tables in SEMANTIC_MODULES.items():
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {module}")
            for table in tables:
                versioned = f"{module}.{table.name}_v{ws.run_id}"
                location = f"{ws.version}/{module}/{dated_name(table.name, ws.run_id)}.parquet"
                spark.sql(f"DROP TABLE IF EXISTS {versioned}")
                columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
                spark.sql(
                    f"CREATE TABLE {versioned} ({columns}) USING parquet LOCATION '{location}'"
                )
                spark.sql(
                    f"CREATE OR REPLACE VIEW {module}.published_{table.name} AS"
                    f" SELECT * FROM {versioned}"
                )
    except Exception as failure:
        return _report(str(failure))
    return _report()


def pointer_names(spark: SparkSession, ws: Workspace) -> list[str]:
    return [name for name, _ in storage.entries(spark, ws.pointers) if name.endswith(".json")]


def current_pointer(spark: SparkSession, ws: Workspace) -> dict | None:
    """The pointer of the highest number; one whose writer died halfway does not count."""
    for name in reversed(pointer_names(spark, ws)):
        try:
            return json.loads(storage.read_text(spark, f"{ws.pointers}/{name}"))
        except ValueError:
            continue
    return None


def activate_version(spark: SparkSession, ws: Workspace) -> dict:
    """Make this version the current one: the next number in a log of pointers that are never changed.

    A pointer is created only if its number is free, which object stores can promise where they cannot rename. Of two
    runs that race for a number one wins; the other reports it. ``_latest.json`` is a copy for readers of one file.
    """
    started = datetime.strptime(ws.run_id[:15], "%Y%m%dT%H%M%S")
    taken = pointer_names(spark, ws)
    number = int(taken[-1].partition(".")[0]) + 1 if taken else 1
    pointer = {
        "number": number,
        "run_id": ws.run_id,
        "version": f"v{ws.run_id}",
        "run_year": started.year,
        "run_month": started.month,
        "run_week_of_month": (started.day - 1) // 7 + 1,
        "published_at": datetime.now(timezone.utc).isoformat(),
    }
    try:
        storage.create_text(spark, f"{ws.pointers}/{number:010d}.json", json.dumps(pointer, indent=2))
        storage.replace_text(spark, ws.latest_pointer, json.dumps(pointer, indent=2))
    except FileExistsError:
        return _report(f"another run published as number {number} first; publish {ws.run_id} again")
    except Exception as failure:
        return _report(str(failure))
    return _report()


STEPS = {
    "integrity_gate": integrity_gate,
    "promotion": promote_version,
    "sql_view": swap_views,
    "activation": activate_version,
}


def publish(spark: SparkSession, ws: Workspace) -> dict:
    """All steps in order; the first that fails ends the run before the pointer moves."""
    report: dict = {"status": "success", "steps": {}}
    for name, step in STEPS.items():
        outcome = step(spark, ws)
        report["steps"][name] = outcome
        if outcome["status"] == "failed":
            return {**report, "status": "failed", "failed_step": name}
    return report
