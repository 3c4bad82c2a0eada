"""Run the job of one table: ``python -m tidegate --table_name T --lake ROOT``."""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import SparkSession

from tidegate.operators.gates import POLICIES
from tidegate.plans.job import run_table
from tidegate.storage import Lake


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidegate")
    parser.add_argument("--table_name", required=True, help="the table whose job is run")
    parser.add_argument("--lake", required=True, help="root path of the lake")
    parser.add_argument("--as_of", default=None, help="the run's date and time, ISO; now if left out")
    parser.add_argument("--policy", choices=POLICIES, default="strict")
    given = parser.parse_args(arguments)
    as_of = datetime.fromisoformat(given.as_of) if given.as_of else datetime.now()
    spark = SparkSession.builder.appName(f"tidegate-{given.table_name}").getOrCreate()
    report = run_table(spark, Lake.under(given.lake), given.table_name, as_of, policy=given.policy)
    print(f"{report.table}: {report.write} {report.path}")


if __name__ == "__main__":
    main()
