"""Command line of the job.

With two paths, or a base folder and a year, it turns records into silver; naming a gold
table runs all three stages. An option that would have no effect is an error.
"""

from __future__ import annotations

import argparse
import logging

from paylake.plans.stages import JobConfig, process_records, run_stages
from paylake.session import build_session

_GOLD_OPTIONS = (
    "staging_table",
    "gold_path",
    "copy_staging",
    "max_bad_share",
    "unique_key",
    "keep_versions",
    "summary",
    "summary_path",
    "all_years",
    "lookup",
    "run_log",
    "manifest",
)
_SILVER_OPTIONS = ("quarantine_path", "refuse_malformed", "layouts_path")


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="paylake")
    parser.add_argument("--input_path", help="folder or file of CSV records")
    parser.add_argument("--output_path", help="folder for silver Parquet")
    parser.add_argument("--base_path", help="instead of the paths: base folder of all years")
    parser.add_argument("--year", type=int, help="program year under the base folder")
    parser.add_argument("--staging_table", help="with gold: name of the staging table")
    parser.add_argument("--gold_table", help="run all stages and replace this table")
    parser.add_argument("--gold_path", help="with gold: folder of the table's files")
    parser.add_argument("--copy_staging", action="store_true", help="with gold: copy silver")
    parser.add_argument("--max_bad_share", type=float, help="with gold: limit of bad rows")
    parser.add_argument("--unique_key", action="store_true", help="with gold: refuse double keys")
    parser.add_argument("--keep_versions", type=int, help="with gold: earlier versions that stay")
    parser.add_argument("--all_years", help="with gold and year: name that shows all years")
    parser.add_argument("--lookup", nargs="+", help="with gold: columns looked up by value")
    parser.add_argument("--summary", action="store_true", help="with gold: its cube for reports")
    parser.add_argument("--summary_path", help="with gold: folder of the cube's files")
    parser.add_argument("--run_log", help="with gold: folder that each run is recorded in")
    parser.add_argument("--manifest", help="with gold: folder of what is done, to go on from there")
    parser.add_argument("--quarantine_path", help="folder for the records that are refused")
    parser.add_argument(
        "--refuse_malformed", action="store_true", help="with a quarantine: wrong field counts too"
    )
    parser.add_argument("--layouts_path", help="folder of layout files: bind columns by name")
    parser.add_argument("--strict_header", action="store_true", help="refuse other headers")
    parser.add_argument("--single_line", action="store_true", help="no record crosses lines")
    parser.add_argument("--show_sample", action="store_true", help="print schema and five rows")
    args = parser.parse_args(argv)
    by_path, by_year = (args.input_path, args.output_path), (args.base_path, args.year)
    if any(x is not None for x in by_year):
        if None in by_year or any(x is not None for x in by_path):
            parser.error("base_path and year are required together, and stand for both paths")
    elif None in by_path:
        parser.error("input_path and output_path are required")
    unused = [
        f"--{x}"
        for x in _GOLD_OPTIONS
        if not args.gold_table and getattr(args, x) is not None and getattr(args, x) is not False
    ]
    if unused:
        parser.error(f"no effect without --gold_table: {', '.join(unused)}")
    if args.all_years and args.year is None:
        parser.error("no effect without --year: --all_years")
    if args.layouts_path and (args.strict_header or args.quarantine_path):
        parser.error("--layouts_path resolves headers: no --strict_header, no --quarantine_path")
    if args.refuse_malformed and not args.quarantine_path:
        parser.error("no effect without --quarantine_path: --refuse_malformed")
    return args


def config(args: argparse.Namespace) -> JobConfig:
    given = {name: getattr(args, name) for name in (*_GOLD_OPTIONS, *_SILVER_OPTIONS, "gold_table")}
    settings = {name: value for name, value in given.items() if value is not None}
    if args.lookup:
        settings["lookup"] = tuple(args.lookup)
    settings |= {
        "strict_header": args.strict_header,
        "multi_line": not args.single_line,
        "show_sample": args.show_sample,
    }
    if args.year is not None:
        return JobConfig.for_year(args.base_path, args.year, **settings)
    return JobConfig(input_path=args.input_path, silver_path=args.output_path, **settings)


def _more(cfg: JobConfig) -> dict[str, object]:
    """Settings of the first stage that were given."""
    given = {name: getattr(cfg, name) for name in _SILVER_OPTIONS}
    return {name: value for name, value in given.items() if value}


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    cfg = config(args)
    spark = build_session()
    try:
        if args.gold_table:
            logging.info("rows per layer: %s", run_stages(spark, cfg))
        else:
            counts = process_records(
                spark,
                cfg.input_path,
                cfg.silver_path,
                show_sample=cfg.show_sample,
                strict_header=cfg.strict_header,
                multi_line=cfg.multi_line,
                **_more(cfg),
            )
            logging.info("wrote %s to %s", counts, cfg.silver_path)
    finally:
        spark.stop()
