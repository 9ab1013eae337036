"""Command line over a folder of state tables (Parquet): runs, stages, exports, reports, named queries.

Exit codes: 0, 2 for configuration errors, 3 for errors at run time.
"""

from __future__ import annotations

import argparse
import datetime
import shutil
import sys
import time
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge import config
from tallyforge.operators import control, mart, state
from tallyforge.operators.extraction import FixedProvider
from tallyforge.plans import pipeline, registry
from tallyforge.session import local_session
from tallyforge.sources.files import write_sheets
from tallyforge.sources.xlsx import write_workbook

OK, CONFIG, RUNTIME = 0, 2, 3


class Store:
    """Tables of a state folder: each write is a new snapshot folder, then one rename of the pointer file."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, Path(folder)

    def read(self, name: str) -> DataFrame:
        pointer = self.folder / f"{name}.current"
        return self.spark.read.parquet(str(self.folder / pointer.read_text())) if pointer.exists() else self.spark.read.parquet(str(self.folder / f"{name}.parquet"))

    def has(self, name: str) -> bool:
        return (self.folder / f"{name}.current").exists() or (self.folder / f"{name}.parquet").exists()

    def write(self, name: str, df: DataFrame) -> DataFrame:
        snapshot = f"{name}-{uuid.uuid4().hex}"
        df.write.parquet(str(self.folder / snapshot))
        temporary = self.folder / f"{name}.{uuid.uuid4().hex}.next"
        temporary.write_text(snapshot)
        temporary.replace(self.folder / f"{name}.current")
        return self.spark.read.parquet(str(self.folder / snapshot))

    def scratch(self, df: DataFrame) -> DataFrame:
        path = str(self.folder / "_scratch" / uuid.uuid4().hex)
        df.write.parquet(path)
        return self.spark.read.parquet(path)


def _state(s: Store) -> pipeline.State:
    return pipeline.State(s.read("publications"), s.read("documents"), s.read("metrics"), s.read("qa_issues"))


def _run(s: Store, a: argparse.Namespace) -> None:
    found = s.read("found")
    if a.ticker:
        found = found.where(F.col("ticker").isin(*a.ticker))
    known = s.read("answers") if (s.folder / "answers.current").exists() else None
    new, answers = pipeline.run(_state(s), found, FixedProvider, s.scratch, known, a.full_reload)
    s.write("answers", answers if known is None else known.unionByName(answers))
    for name, df in (("publications", new.publications), ("metrics", new.metrics), ("qa_issues", new.issues)):
        s.write(name, df)
    mart.status_counts(new.publications).orderBy("status").show(50, False)


STAGES: dict[str, Callable[[Store], pipeline.State]] = {
    "discover": lambda s: pipeline.discover(_state(s), s.read("found")),
    "classify": lambda s: pipeline.advance(_state(s)),
    "validate": lambda s: pipeline.validate(_state(s), s.spark.createDataFrame([], "publication_id string")),
}


def _stage(s: Store, a: argparse.Namespace) -> None:
    new = STAGES[a.verb](s)
    s.write("publications", new.publications)
    if a.verb == "validate":
        s.write("qa_issues", new.issues)


def _export(s: Store, a: argparse.Namespace) -> None:
    p = s.read("publications")
    rows = mart.metric_sheet(s.read("metrics"), s.read("documents"), p)
    sheets = {"metrics": rows.withColumn("number_format", mart.number_format(F.col("value"))).orderBy(*mart.SHEET_ORDER)}
    if s.has("events"):
        sheets["events"] = s.read("events").orderBy(F.desc("event_date"), "event_id")
    if s.has("tickers"):
        stored = p.select("ticker").distinct().withColumn("name", F.col("ticker"))
        sheets["tickers"] = mart.ticker_sheet(stored, s.read("tickers")).orderBy("ticker")
    sheets["meta"] = mart.status_counts(p).orderBy("status")
    sheets["qa_issues"] = s.read("qa_issues").orderBy("publication_id", "code")
    if a.format == "xlsx":
        write_workbook(sheets, f"{a.out}/mart.xlsx")
    else:
        write_sheets(sheets, a.out, a.format)
    s.write("publications", state.promote_validated(p))


def _status(s: Store, a: argparse.Namespace) -> None:
    s.read("runs").orderBy(F.desc("run_id")).limit(a.limit).show(a.limit, False)


def _prune(s: Store, a: argparse.Namespace) -> None:
    cutoff = time.time() - config.duration(a.older_than).total_seconds()
    old = [p for p in (s.folder / "_scratch").glob("*") if p.stat().st_mtime < cutoff]
    for p in old:
        shutil.rmtree(p)
    print(f"removed {len(old)}")


def _evolve(s: Store, a: argparse.Namespace) -> None:
    now = datetime.datetime.now(datetime.UTC)
    if a.action == "status":
        s.read("ticks").orderBy(F.desc("tick_id")).limit(a.limit).show(a.limit, False)
    elif a.action == "report":
        mart.tick_report(s.read("ticks"), (now - datetime.timedelta(days=7)).date().isoformat()).show(50, False)
        s.read("skiplist").groupBy("reason").count().show(50, False)
    elif a.action == "reset":
        s.write("skiplist", state.reset_skiplist(s.read("skiplist"), s.spark.createDataFrame([(a.company,)], "company_id string")))
    elif a.action == "tick":
        none = s.spark.createDataFrame([], "company_id string")
        batch, listed = control.next_batch(s.read("companies"), s.read("skiplist"), s.read("ticks"), none, now.strftime("%Y-%m-%d %H:%M:%S"), a.limit)
        s.write("skiplist", listed)
        batch.show(a.limit, False)
    elif a.action == "cleanup":
        cutoff = (now - config.duration(a.older_than)).isoformat()
        control.purgeable(s.read("ticks"), cutoff).select("tick_id").show(1000, False)
    elif a.action == "canary":
        s.write("canary_baseline", mart.snapshot(s.read("tickers"), s.read("publications"), s.read("documents"), s.read("metrics"), s.read("qa_issues")))


def _query(s: Store, a: argparse.Namespace) -> None:
    df = registry.queries()[a.name](s.spark, str(s.folder))
    df.write.mode("overwrite").parquet(a.out) if a.out else df.show(a.limit, False)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tallyforge")
    p.add_argument("--state", default="state", help="folder of the state tables")
    verbs = p.add_subparsers(dest="verb", required=True)
    for name in ("update", "run"):
        v = verbs.add_parser(name)
        v.add_argument("--full-reload", metavar="SINCE")
        v.add_argument("--ticker", nargs="*")
        v.set_defaults(do=_run)
    for name in STAGES:
        verbs.add_parser(name).set_defaults(do=_stage)
    v = verbs.add_parser("export")
    v.add_argument("out")
    v.add_argument("--format", default="parquet", choices=("parquet", "csv", "json", "xlsx"))
    v.set_defaults(do=_export)
    v = verbs.add_parser("status")
    v.add_argument("--limit", type=int, default=10)
    v.set_defaults(do=_status)
    v = verbs.add_parser("prune")
    v.add_argument("--older-than", default="30d")
    v.set_defaults(do=_prune)
    v = verbs.add_parser("evolve")
    v.add_argument("action", choices=("tick", "status", "report", "reset", "cleanup", "canary"))
    v.add_argument("--company")
    v.add_argument("--limit", type=int, default=3)
    v.add_argument("--older-than", default="30d")
    v.set_defaults(do=_evolve)
    v = verbs.add_parser("query")
    v.add_argument("name")
    v.add_argument("--out")
    v.add_argument("--limit", type=int, default=20)
    v.set_defaults(do=_query)
    v = verbs.add_parser("config")
    v.add_argument("folder")
    v.set_defaults(do=None)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        if a.verb == "config":
            print(config.dump(config.load(a.folder)))
            return OK
        a.do(Store(spark or local_session("*"), a.state), a)
    except config.ConfigError as e:
        print(f"config error: {e}", file=sys.stderr)
        return CONFIG
    except Exception as e:  # noqa: BLE001  the verb's outcome is its exit code
        print(f"error: {e}", file=sys.stderr)
        return RUNTIME
    return OK


if __name__ == "__main__":
    sys.exit(main())
