"""Run one job: ``spark-submit … -m starmart`` or ``python -m starmart <job> --raw … --root …``."""

from __future__ import annotations

import argparse
from datetime import datetime, timedelta

from starmart.plans.warehouse import REBUILT, STAR, Warehouse
from starmart.session import build_session
from starmart.sources.writers import JdbcTarget
from starmart.streaming.marks import set_mark


def parser() -> argparse.ArgumentParser:
    args = argparse.ArgumentParser(prog="starmart")
    args.add_argument("--root", required=True, help="warehouse folder")
    args.add_argument("--raw", default="", help="folder of the raw CSV files")
    args.add_argument(
        "--raw-name",
        action="append",
        default=[],
        metavar="TABLE=FILE",
        help="raw file that is not called TABLE.csv",
    )
    args.add_argument("--infer-types", action="store_true", help="scan CSV files for types")
    args.add_argument("--master", help="Spark master, if not given by spark-submit")
    jobs = args.add_subparsers(dest="job", required=True)

    everything = jobs.add_parser("all", help="load, rebuild and connect everything")
    everything.add_argument("--lookback-days", type=float, default=0)
    jobs.add_parser("init-marks", help="set all marks to the start")
    mark = jobs.add_parser("set-mark", help="set the mark of one table")
    mark.add_argument("table")
    mark.add_argument("ts", type=datetime.fromisoformat)
    load = jobs.add_parser("silver", help="load or rebuild one cleaned table")
    load.add_argument("table", choices=["orders", "reviews", *REBUILT])
    load.add_argument("--lookback-days", type=float, default=0)
    dimension = jobs.add_parser("dimension", help="build one dimension")
    dimension.add_argument("table", choices=STAR[:-1])
    jobs.add_parser("fact", help="build the sales fact")
    jobs.add_parser("quality", help="report on all raw tables")
    jobs.add_parser("malformed", help="report unreadable values of all raw tables")
    jobs.add_parser("keys", help="report orphan and repeated keys of the cleaned tables")
    merge = jobs.add_parser("merge-orders", help="bring loaded orders to the state of the raw file")
    merge.add_argument("--delete-missing", action="store_true", help="the raw file is complete")
    mock = jobs.add_parser("mock", help="write made-up orders")
    mock.add_argument("--rows", type=int, default=500)
    mock.add_argument("--seed", type=int, default=1)
    revenue = jobs.add_parser("revenue", help="monthly revenue of the made-up orders as CSV")
    revenue.add_argument("path")
    export = jobs.add_parser("export", help="replace the star tables in a JDBC database")
    export.add_argument("url")
    export.add_argument("--driver", default=JdbcTarget.driver)
    export.add_argument("--connections", type=int, default=JdbcTarget.connections)
    return args


def run(options: argparse.Namespace, house: Warehouse) -> object:
    def silver():
        lookback = timedelta(days=options.lookback_days)
        if options.table == "orders":
            return house.load_orders(lookback)
        if options.table == "reviews":
            return house.load_reviews(lookback)
        return house.rebuild_silver(options.table)

    jobs = {
        "all": lambda: house.run_all(timedelta(days=options.lookback_days)),
        "init-marks": house.init_control,
        "set-mark": lambda: set_mark(house.spark, house.control_path, options.table, options.ts),
        "silver": silver,
        "dimension": lambda: house.build_dimension(options.table),
        "fact": house.build_fact,
        "quality": lambda: house.report_quality().show(100, truncate=False),
        "malformed": lambda: house.report_malformed().show(100, truncate=False),
        "keys": lambda: [report.show(100, truncate=False) for report in house.report_keys()] and None,
        "merge-orders": lambda: house.merge_orders(options.delete_missing),
        "mock": lambda: house.write_mock_orders(options.rows, options.seed),
        "revenue": lambda: house.report_monthly_revenue(options.path).show(),
        "export": lambda: house.export_star(JdbcTarget(options.url, options.driver, options.connections)),
    }
    return jobs[options.job]()


def main(arguments: list[str] | None = None) -> None:
    options = parser().parse_args(arguments)
    names = dict(pair.split("=", 1) for pair in options.raw_name)
    spark = build_session(f"starmart-{options.job}", options.master)
    house = Warehouse(spark, options.raw, options.root, names, options.infer_types)
    result = run(options, house)
    if result is not None:
        print(result)


if __name__ == "__main__":
    main()
