"""Command line: run, status, inspect, schema export, schema validate, smoke-test."""

from __future__ import annotations

import argparse
import logging
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.config import resolve
from millrace.operators import audit, drift, flatten, smoke
from millrace.operators.store import Store, now
from millrace.plans.contract import compiled
from millrace.plans.runner import Run, exit_code
from millrace.sources import fetch, landing, rest
from millrace.sources.fetch import Fetcher

RUN_COLUMNS = ("started_at", "stage", *audit.COUNTERS, "status")
METADATA_COLUMNS = ("key", "value", "updated_at")


def parser() -> argparse.ArgumentParser:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--warehouse", "--db", help="where the tables are")
    common.add_argument("--raw-dir")
    common.add_argument("--verbose", action="store_true")
    top = argparse.ArgumentParser(prog="millrace")
    commands = top.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", parents=[common])
    run.add_argument("--strict", action="store_true")
    run.add_argument("--base-url", help="fetch from this API first; without it the landing folder alone is read")
    run.add_argument("--rate", type=positive, default=rest.DEFAULT_RATE, help=f"documents a second, at most {rest.MAX_RATE:g}")
    run.add_argument("--force", action="store_true", help="fetch again what has landed already")
    for name in ("status", "inspect"):
        commands.add_parser(name, parents=[common])
    commands.add_parser("smoke-test", parents=[common]).add_argument("--base-url", help="fetch the two core documents and the first players first")
    schema = commands.add_parser("schema").add_subparsers(dest="action", required=True)
    schema.add_parser("export", parents=[common]).add_argument("--out")
    schema.add_parser("validate", parents=[common])
    return top


def positive(text: str) -> float:
    value = float(text)
    if not value > 0:
        raise argparse.ArgumentTypeError("must be greater than 0")
    return value


def aligned(rows: list, columns: tuple[str, ...], nothing: str) -> list[str]:
    """Lines with the columns below each other, names first; ``nothing`` if there are no rows."""
    if not rows:
        return [nothing]
    cells = [list(columns), *[["-" if r[c] is None else str(r[c]) for c in columns] for r in rows]]
    widths = [max(map(len, column)) for column in zip(*cells, strict=True)]
    return ["  ".join(cell.ljust(w) for cell, w in zip(line, widths, strict=True)).rstrip() for line in cells]


def report_lines(report: drift.Report) -> list[str]:
    kinds = {
        "missing table": report.missing_tables, "missing column": report.missing_columns, "extra column": report.extra_columns,
        "other type": report.type_mismatches, "other constraint": report.constraint_mismatches,
    }
    return [f"schema: {report.status}", *[f"  {kind}: {name}" for kind, names in kinds.items() for name in names]]


def smoke_lines(outcomes: dict[str, smoke.Outcome]) -> list[str]:
    each = [[f"{name}: {'ok' if o.ok else 'failed'}", *[f"  {p}" for p in o.problems]] for name, o in outcomes.items()]
    return [line for lines in each for line in lines]


def smoke_outcomes(spark: SparkSession, raw_dir: str, fetcher: Fetcher | None) -> dict[str, smoke.Outcome]:
    """Checks of the newest documents: fetched now, fetched before, or else landed as files; what isn't there is a problem."""
    stamp = now()

    def newest(name: str, files: str) -> DataFrame:
        found = fetch.documents(spark, raw_dir, name)
        found = found.where(F.col("fetched_at") == stamp) if fetcher else found
        found = found.select("path", "document")
        landed = f"{raw_dir}/{files}"
        return landing.documents(spark, landed) if not fetcher and found.isEmpty() and landing.exists(spark, landed) else found

    contract = compiled()
    if fetcher:
        for name in ("bootstrap", "fixtures"):
            fetcher.land(name, None, stamp)
    core = newest("bootstrap", "bootstrap.json")
    if fetcher:
        players = flatten.bootstrap_list(core, "elements").orderBy("pos").limit(smoke.SAMPLE).select(F.try_variant_get("record", "$.id", "bigint")).collect()
        fetcher.land("history", [r[0] for r in players if r[0] is not None], stamp)
    return {
        "bootstrap": smoke.bootstrap(core, contract),
        "fixtures": smoke.fixtures(newest("fixtures", "fixtures.json"), contract),
        "history": smoke.history(newest("history", "players/*.json"), contract),
    }


def show(lines: list[str]) -> None:
    print("\n".join(lines))


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    given = sys.argv[1:] if args is None else args
    own = parser().parse_args(given if given and not given[0].startswith("-") or {"-h", "--help"} & set(given) else ["run", *given])
    logging.basicConfig(level=logging.DEBUG if own.verbose else logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    config = resolve(own.warehouse, own.raw_dir)
    if own.command == "schema" and own.action == "export":
        text = compiled().as_json()
        Path(own.out).write_text(text) if own.out else print(text, end="")
        return 0
    spark = spark or SparkSession.builder.appName("millrace").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    store = Store(spark, config.warehouse)
    if own.command == "run":
        base_url = own.base_url or config.base_url
        fetcher = Fetcher(spark, base_url, config.raw_dir, rest.clamped_rate(own.rate)) if base_url else None
        run = Run(spark, store, config.raw_dir, strict=own.strict, fetcher=fetcher, force=own.force)
        status = run.run()
        for result in run.results:
            logging.info("%s (%.1f s)", result, run.seconds[result.stage])
        logging.info("status: %s", status)
        return exit_code(status)
    if own.command in ("status", "inspect"):
        runs = audit.recent(store.read("_runs"), 1 if own.command == "status" else audit.RECENT).collect()
        metadata = audit.latest_metadata(store.read("_metadata")).collect()
        show([*aligned(runs, RUN_COLUMNS, "no runs yet"), "", *aligned(metadata, METADATA_COLUMNS, "no metadata yet")])
        return 0
    if own.command == "smoke-test":
        base_url = own.base_url or config.base_url
        outcomes = smoke_outcomes(spark, config.raw_dir, Fetcher(spark, base_url, config.raw_dir) if base_url else None)
        show(smoke_lines(outcomes))
        return int(not all(o.ok for o in outcomes.values()))
    report = store.validate()
    show(report_lines(report))
    return report.exit_code


if __name__ == "__main__":
    sys.exit(main())
