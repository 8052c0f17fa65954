"""Commands over files: synthesize, clean, train, evaluate. ``python -m bazaarlens.cli COMMAND --help`` lists the flags."""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.functions import text as X
from bazaarlens.operators import models as M
from bazaarlens.operators.rules import report_text
from bazaarlens.operators.valuation import as_json, as_lines, evaluate
from bazaarlens.plans.clean import STORAGES, Settings, clean
from bazaarlens.plans.training import price_features
from bazaarlens.session import cut_lineage, get_spark, share_package
from bazaarlens.sources import files
from bazaarlens.sources.catalog import catalog, names
from bazaarlens.sources.synthetic import synthetic_listings


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="bazaarlens", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    made = commands.add_parser("synthesize", help="raw listings drawn from a seed")
    made.add_argument("output")
    made.add_argument("--rows", type=int, default=3000)
    made.add_argument("--seed", type=int, default=42)
    cleaned = commands.add_parser("clean", help="raw listings to clean ones, with a report of the drops")
    cleaned.add_argument("input")
    cleaned.add_argument("output")
    cleaned.add_argument("--outliers", choices=("none", "iqr", "isolation_forest", "both"), default="iqr")
    cleaned.add_argument("--limit", type=int, help="read the first rows of the input only")
    trained = commands.add_parser("train", help="compare models by cross-validation and keep the best")
    trained.add_argument("input")
    trained.add_argument("output")
    trained.add_argument("--models", nargs="+", default=[M.LogLinear.name], choices=(M.LogLinear.name, M.BoostedTrees.name))
    trained.add_argument("--folds", type=int, default=5)
    trained.add_argument("--metrics", help="file for the document of scores")
    valued = commands.add_parser("evaluate", help="asked prices against the model's; a table of queries, or one typed query")
    valued.add_argument("model")
    valued.add_argument("--queries", help="CSV with model, storage, condition, price, battery, region as typed")
    for flag in ("phone", "storage", "condition", "battery", "price", "region"):
        valued.add_argument(f"--{flag}")
    valued.add_argument("--threshold", type=float, default=10.0)
    valued.add_argument("--json", action="store_true")
    return parser


def typed_queries(rows: DataFrame) -> DataFrame:
    """Queries from columns of typed text; what cannot be read is null and becomes the query's error."""
    have = {c.lower() for c in rows.columns}
    c = lambda name: (F.col(name) if name in have else F.lit(None)).cast("string")
    return rows.select(
        X.model_name(c("model"), names(), False).alias("model"), X.typed_storage(c("storage"), STORAGES).alias("storage_gb"), X.typed_condition(c("condition")).alias("condition"), X.typed_price(c("price")).alias("asking_price"), X.typed_percent(c("battery")).alias("battery_health"), c("region").alias("region"),
    )


def _train(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = files.read_csv(spark, a.input, files.CLEAN_SCHEMA)
    features = cut_lineage(price_features(rows, catalog(spark), "item_id").where("price > 0"))
    found = M.select_and_refit({name: (lambda name=name: M.make_model(name)) for name in a.models}, features, "item_id", a.folds)
    statistics = M.training_statistics(rows)
    document = M.metrics_document(found, statistics)
    M.save_bundle(spark, found["model"], a.output, **statistics, typical_error=found["typical_error"], metrics=document)
    if a.metrics:
        files.write_json(document, a.metrics)
    print(M.scores_table(found))


def _evaluate(spark: SparkSession, a: argparse.Namespace) -> int:
    model, statistics = M.load_bundle(spark, a.model)
    if a.queries:
        rows = spark.read.option("header", True).csv(a.queries)
    else:
        rows = spark.createDataFrame([(a.phone, a.storage, a.condition, a.battery, a.price, a.region)], "model string, storage string, condition string, battery string, price string, region string")
    valued = evaluate(typed_queries(rows), catalog(spark), model.predict, statistics, dt.datetime.now(dt.UTC).date(), a.threshold)
    for row in (as_json(valued, statistics.get("typical_error")) if a.json else as_lines(valued)).toLocalIterator():
        print(row["value"])
    return 2 if not a.queries and valued.first()["error"] else 0


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    """0 if all went well, 1 if a file or setting is wrong, 2 if the one typed query is."""
    a = _parser().parse_args(argv)
    spark = spark or get_spark("bazaarlens", "local[*]")
    share_package(spark)
    try:
        if a.command == "synthesize":
            files.write_csv(synthetic_listings(spark, a.rows, a.seed), a.output)
        elif a.command == "clean":
            raw = files.read_csv(spark, a.input, files.RAW_SCHEMA)
            kept, report = clean(raw.limit(a.limit) if a.limit else raw, catalog(spark), Settings(method=a.outliers))
            files.write_csv(kept, a.output)
            print(report_text(report))
        elif a.command == "train":
            _train(spark, a)
        else:
            return _evaluate(spark, a)
    except (FileNotFoundError, ValueError, AnalysisException) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
