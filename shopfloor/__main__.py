"""Run one step of the path-addressed lake: ``python -m shopfloor bronze --landing DIR --lake DIR``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor import schemas
from shopfloor.operators.telemetry import clean_readings
from shopfloor.plans import medallion
from shopfloor.plans.prediction import predict_failures
from shopfloor.plans.warehouse import Warehouse
from shopfloor.session import drop_staged, get_spark
from shopfloor.sources import catalog, files


def build_catalog(spark: SparkSession, landing: str, schema: str, location: str | None, fmt: str, effective: str | None) -> Warehouse:
    """All tables of the catalog form from the landed files: bronze, silver, gold and the machine history."""
    catalog.use(spark, schema)
    store = Warehouse(spark, location, fmt)

    def landed(folder: str, pattern: str | None, contract) -> DataFrame:
        found = files.read_landed(spark, f"{landing.rstrip('/')}/{folder}", contract, pattern)
        return found.select(*contract.names)

    sources = {name: landed(*[medallion.SOURCES[name][k] for k in (0, 1, 2)]) for name in medallion.SOURCES}
    events = f"{landing.rstrip('/')}/downtime"
    downtime = landed("downtime", None, schemas.DOWNTIME_EVENTS) if files.path_exists(spark, events, "text") else spark.createDataFrame([], schemas.DOWNTIME_EVENTS)
    runs = sources["mes_runs"].withColumn("run_date", F.to_date("run_date"))
    # The catalog form has the machine's age; whole years up to the effective day.
    day = F.lit(effective).cast("date") if effective else F.current_date()
    machines = sources["dim_machines"].withColumn("age_years", F.floor(F.months_between(day, F.to_date("install_date")) / 12))
    store.bronze(machines, sources["dim_products"], runs, downtime, clean_readings(sources["sensors"]), sources["quality"])
    store.silver(planned="planned_production_min")
    store.gold()
    store.machine_history(spark.table("bronze_dim_machines"), effective)
    return store


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="shopfloor")
    parser.add_argument("step", choices=["bronze", "ingest", "silver", "history", "gold", "all", "refresh", "catalog", "predict"])
    parser.add_argument("--landing", help="folder with mes/, sensors/ and quality/ (bronze, ingest, all)")
    parser.add_argument("--lake", help="root folder of the layers")
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--infer", action="store_true", help="infer JSON schemas instead of using the contracts")
    parser.add_argument("--effective", help="day on which machine changes take effect (default: today)")
    parser.add_argument("--seed-csv", help="seed file (predict)")
    parser.add_argument("--metrics", help="folder of the metrics table (predict)")
    parser.add_argument("--schema", default="manufacturing", help="schema of the catalog tables (catalog)")
    parser.add_argument("--location", help="folder of external catalog tables (catalog; default: managed tables)")
    parser.add_argument("--master")
    args = parser.parse_args(argv)

    spark = get_spark(f"shopfloor-{args.step}", args.master)
    if args.step == "predict":
        if not args.seed_csv:
            parser.error("predict needs --seed-csv")
        report = predict_failures(spark, args.seed_csv, args.metrics)
        for table in (report.balance, report.duplicates, report.metrics, report.importances):
            table.show(truncate=False)
        drop_staged(spark)
        return
    if args.step == "catalog":
        if not args.landing:
            parser.error("catalog needs --landing")
        build_catalog(spark, args.landing, args.schema, args.location, args.format, args.effective)
        drop_staged(spark)
        return
    if not args.lake or (args.step in ("bronze", "ingest", "refresh", "all") and not args.landing):
        parser.error("--lake is needed, and --landing for bronze, ingest, refresh and all")
    lake = medallion.Lake(args.lake, args.format)
    if args.step in ("bronze", "all"):
        print("bronze", medallion.bronze(spark, args.landing, lake, args.infer))
    if args.step == "ingest":
        medallion.bronze_incremental(spark, args.landing, lake)
    if args.step == "refresh":
        print("refresh", medallion.refresh(spark, args.landing, lake))
    if args.step in ("silver", "all"):
        print("silver", medallion.silver(spark, lake))
    if args.step in ("history", "all"):
        print("history version", medallion.machine_history(spark, lake, args.effective))
    if args.step in ("gold", "all"):
        print("gold", medallion.gold(spark, lake))
    drop_staged(spark)


if __name__ == "__main__":
    main()
