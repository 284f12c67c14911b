"""The two jobs, for ``spark-submit``: load workbooks, then build the models.

    spark-submit --py-files tablekit.zip tablekit/jobs.py load  --workbooks s3a://…/raw/*.xlsx \\
        --database shop --base-path s3a://…/tables
    spark-submit --py-files tablekit.zip tablekit/jobs.py model --database shop --base-path s3a://…/tables
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tablekit.plans.models import build_models
from tablekit.plans.pipeline import RunReport, run_pipeline
from tablekit.plans.specs import RENTAL_STORE_SPECS
from tablekit.sinks.tables import MODES, TableSink
from tablekit.sources.sheets import sheet_sources


def load(
    spark: SparkSession,
    workbooks: str,
    database: str,
    base_path: str,
    mode: str = "append",
    name: str | None = None,
    only_new: bool = False,
) -> RunReport:
    """Sheets of the workbooks to checked tables and their error tables.

    A ``name`` makes the load one that can be started again after a failure; with
    ``only_new`` workbooks that were loaded before are left out.
    """
    sink = TableSink(spark, database, base_path)
    with sheet_sources(spark, workbooks, list(RENTAL_STORE_SPECS), sink if only_new else None) as sources:
        return run_pipeline(RENTAL_STORE_SPECS.values(), sources, sink, mode, name)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=("load", "model"))
    parser.add_argument("--workbooks", help="path or glob of the workbooks to load")
    parser.add_argument("--database", required=True)
    parser.add_argument("--base-path", required=True)
    parser.add_argument("--mode", choices=MODES, default="append")
    parser.add_argument("--name", help="name of the load: started again, it leaves out what it had done")
    parser.add_argument("--only-new", action="store_true", help="leave out workbooks loaded before")
    args = parser.parse_args()
    if args.job == "load" and not args.workbooks:
        parser.error("load needs --workbooks")

    spark = SparkSession.builder.appName(f"tablekit {args.job}").getOrCreate()
    if args.job == "load":
        report = load(spark, args.workbooks, args.database, args.base_path, args.mode, args.name, args.only_new)
        report.frame(spark).show(truncate=False)
    else:
        build_models(spark, args.database, args.base_path, args.mode)


if __name__ == "__main__":
    main()
