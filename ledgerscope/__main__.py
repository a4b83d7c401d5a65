"""Command line: sources, collect-pages, collect-pncp, collect-pncp-contracts, build-db, concentration."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from ledgerscope.operators import concentration
from ledgerscope.operators.scope import BRANCH_POWER
from ledgerscope.plans import build, collect, store
from ledgerscope.sources.city import open_workspace


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ledgerscope")
    parser.add_argument("--repo-root", default=".")
    parser.add_argument("--city", required=True, help="slug of a folder under cities/")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("sources")
    commands.add_parser("collect-pages").add_argument("--out")
    for name in ("collect-pncp", "collect-pncp-contracts"):
        one = commands.add_parser(name)
        one.add_argument("--start", type=date.fromisoformat, required=True)
        one.add_argument("--end", type=date.fromisoformat, required=True)
        one.add_argument("--scope", choices=[*BRANCH_POWER], default="executivo")
        one.add_argument("--out")
        one.add_argument("--resume", action="store_true", help="go on after the pages that earlier runs have logged")
        one.add_argument("--replay", action="store_true", help="take all pages from the archive, without a request")
    one.add_argument("--from-procurements", action="append", default=[])
    one.add_argument("--agency-cnpj", action="append", default=[])
    one = commands.add_parser("build-db")
    one.add_argument("--db")
    one.add_argument("--pncp", action="append", default=[])
    one.add_argument("--contracts", action="append", default=[])
    commands.add_parser("concentration").add_argument("--db")
    return parser


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> str:
    args = arguments().parse_args(argv)
    workspace = open_workspace(args.repo_root, args.city)
    spark = spark or SparkSession.builder.appName("ledgerscope").getOrCreate()
    raw, tables = workspace.raw, str(workspace.data / "tables")
    if args.command == "sources":
        said = collect.as_json(workspace.sources(spark))
    elif args.command == "collect-pages":
        said = collect.as_json(collect.collect_pages(workspace.sources(spark), args.out or str(raw / "pages")))
    elif args.command == "collect-pncp":
        said = collect.collect_procurements(spark, workspace.city, args.start, args.end, args.out or str(raw / "pncp"), args.scope, resume=args.resume, replay=args.replay)
    elif args.command == "collect-pncp-contracts":
        cnpjs = collect.union_cnpjs(spark, workspace.city, args.agency_cnpj, args.from_procurements)
        said = collect.collect_contracts(spark, workspace.city, args.start, args.end, args.out or str(raw / "pncp_contracts"), cnpjs, args.scope, resume=args.resume, replay=args.replay)
    elif args.command == "build-db":
        build.build(spark, workspace, args.db or tables, args.pncp, args.contracts)
        said = args.db or tables
    else:
        contracts = store.read(spark, args.db or tables, "contracts")
        said = collect.as_json(concentration.of_city(contracts, workspace.city.slug))
    print(said)
    return said


if __name__ == "__main__":
    main()
