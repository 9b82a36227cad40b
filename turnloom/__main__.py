"""Run a query and write its result, or run the pipeline: python -m turnloom QUERY|pipeline TABLES OUT [options].

The pipeline's judge is the offline one unless --backend http names an endpoint for chat completions (--url, --model,
optionally --fallback-model; the key is read from the environment variable named by --key-variable).
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from turnloom.inference import http_chat
from turnloom.operators import prompts
from turnloom.plans import pipeline
from turnloom.plans.queries import queries
from turnloom.session import ship


def judge_of(a: argparse.Namespace) -> pipeline.Judge | None:
    """The judge that the arguments name; null for the offline one."""
    if a.backend == "mock":
        return None
    key = os.environ.get(a.key_variable) if a.key_variable else None
    load = lambda model: http_chat(a.url, model, prompts.JUDGE_SYSTEM, a.workers, key=key)
    second = pipeline.Judge(load(a.fallback_model), a.fallback_model, "http", 0, a.batch) if a.fallback_model else None
    return pipeline.Judge(load(a.model), a.model, "http", a.retries, a.batch, second)


def main(argv: list[str] | None = None) -> int:
    """Parse arguments, run, write."""
    p = argparse.ArgumentParser(prog="turnloom")
    p.add_argument("query", choices=[*sorted(queries()), "pipeline"])
    p.add_argument("tables")
    p.add_argument("out")
    p.add_argument("--format", default="parquet", choices=["parquet", "json", "csv"])
    p.add_argument("--stage", default="all", choices=[*pipeline.GROUPS, *pipeline.STAGES])
    p.add_argument("--backend", default="mock", choices=["mock", "http"])
    for name in ("--url", "--model", "--fallback-model", "--key-variable"):
        p.add_argument(name)
    p.add_argument("--retries", type=int, default=1)
    p.add_argument("--workers", type=int, default=8)
    p.add_argument("--batch", type=int, default=64)
    a = p.parse_args(argv)
    if a.backend == "http" and not (a.url and a.model):
        p.error("--backend http needs --url and --model")
    if a.backend == "mock" and (a.url or a.model):
        p.error("--url and --model need --backend http")
    spark = SparkSession.builder.appName("turnloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ship(spark)
    if a.query == "pipeline":
        pipeline.run(spark, a.tables, a.out, a.stage, judge_of(a))
        return 0
    queries()[a.query](spark, a.tables).write.mode("overwrite").format(a.format).save(a.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
