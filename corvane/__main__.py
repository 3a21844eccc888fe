"""The facade on the command line: `python -m corvane stats|tree|show|find|ask --atlas <parquet> ...`, JSON lines out."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane import api
from corvane.session import local_session


def parsed(arguments: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="corvane")
    parser.add_argument("--atlas", required=True, help="Parquet table of merged records")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("stats")
    tree = commands.add_parser("tree")
    tree.add_argument("--cwe")
    tree.add_argument("--project")
    tree.add_argument("--limit", type=int)
    show = commands.add_parser("show")
    show.add_argument("id")
    show.add_argument("--project")
    for name, limit in (("find", 20), ("ask", 5)):
        command = commands.add_parser(name)
        command.add_argument("text")
        command.add_argument("--limit", type=int, default=limit)
    return parser.parse_args(arguments)


def answer(atlas: DataFrame, options: argparse.Namespace) -> DataFrame:
    if options.command == "stats":
        return api.stats(atlas)
    if options.command == "tree":
        return api.tree(atlas, options.cwe, options.project, options.limit)
    if options.command == "show":
        return api.show(atlas, options.id, options.project)
    return (api.find if options.command == "find" else api.ask)(atlas, options.text, options.limit)


def main(arguments: list[str]) -> int:
    """Prints one JSON object per row; 1 if there is none."""
    options = parsed(arguments)
    spark = local_session()
    found = answer(spark.read.parquet(options.atlas), options)
    rows = found.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).limit(api.MOST).collect()  # at most MOST rows
    print("\n".join(r[0] for r in rows))
    return 0 if rows else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
