"""Command line: cleaning a project, and annotating a folder of papers.

    python -m texloom clean SOURCE TARGET [--tex main.tex ...]
    python -m texloom annotate SOURCE TARGET [--discipline cs]

Spark's settings come from the command's session (spark-submit or spark-defaults).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession, functions as F

from .operators import clean
from .sources import files


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="texloom", description=__doc__.split("\n")[0])
    commands = parser.add_subparsers(dest="command", required=True)
    one = commands.add_parser("clean", help="writes the files of a project that its documents need, cleaned")
    one.add_argument("--tex", nargs="*", help="documents to keep, as paths below the source; else all that are found")
    two = commands.add_parser("annotate", help="adds the mentions and statuses of a folder's papers (discipline/paper/file) to the target")
    two.add_argument("--discipline")
    for each in (one, two):
        each.add_argument("source")
        each.add_argument("target")
    asked = parser.parse_args(arguments)
    spark = SparkSession.builder.getOrCreate()
    if asked.command == "clean":
        print(clean.clean_folder(spark, asked.source, asked.target, asked.tex or None), "files")
        return 0
    found = files.files(spark, asked.source, ".tex").withColumn("path", F.regexp_replace("path", "^file:/*", "/"))
    said = clean.process_discipline(found, len(asked.source.rstrip("/").split("/")), asked.target, asked.discipline)
    for r in said.groupBy("status").count().collect():
        print(r["count"], r["status"])
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
