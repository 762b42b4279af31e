"""Command line: ``python -m medallion <job> [options]`` (spark-submit friendly).

Jobs: ``silver``, ``gold``, ``land``, ``wordcount``, ``sql``. Every job uses the
session's configuration; ``--master`` is only for local runs.
"""

from __future__ import annotations

import argparse
import json
import sys

from medallion.session import build_session


def _load(ref: str):
    """``module:function`` to the function."""
    import importlib

    module, _, name = ref.partition(":")
    return getattr(importlib.import_module(module), name)


def main(argv: list[str] | None = None, spark=None) -> int:
    """Run one job; a given ``spark`` session is used and left running."""
    p = argparse.ArgumentParser(prog="medallion")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="job", required=True)
    s = sub.add_parser("silver", help="refine landed sources into <root>/silver")
    s.add_argument("--data-root", required=True)
    s.add_argument("--gazetteer", help="Parquet with address, latitude, longitude, score")
    s.add_argument("--years", default="2021-2025")
    s.add_argument("--place", default="75")
    s.add_argument("--bronze-transactions", help="landed Parquet table to refine instead of the CSV files")
    s.add_argument("--bronze", help="folder of landed tables, one per dataset, read before <root>/<dataset>")
    s.add_argument("--max-calls", type=int, help="provider calls at a time")
    s.add_argument("--provider", help="module:function taking a pandas Series of addresses and returning "
                                      "a DataFrame with latitude and longitude (used when no gazetteer)")
    s.add_argument("--provider-cache", help="Parquet folder keeping provider answers across runs")
    s.add_argument("--transaction-schema", help="DDL of the transaction files' columns, e.g. '`Code postal` string, …'")
    s.add_argument("--quarantine", action="store_true", help="put odd transaction lines and files aside (needs the schema)")
    s.add_argument("--fuzzy-edits", type=int, default=0, help="let an address the gazetteer lacks take the nearest within so many edits")
    g = sub.add_parser("gold", help="build the marts into <root>/gold")
    g.add_argument("--data-root", required=True)
    g.add_argument("--strict-decimal", action="store_true", help="a decimal comma makes the price NULL")
    g.add_argument("--map-files", type=int, help="lay each point mart out for a map, in about so many files")
    la = sub.add_parser("land", help="ingest new files of a folder once, into a bronze table")
    la.add_argument("--source", required=True)
    la.add_argument("--bronze", required=True)
    la.add_argument("--checkpoint", required=True)
    la.add_argument("--format", default="binaryFile")
    la.add_argument("--schema", help="DDL schema for parsed formats, e.g. 'doc_id bigint, text string'")
    la.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                    help="reader option, repeatable (e.g. header=true)")
    la.add_argument("--max-files-per-trigger", type=int, default=None,
                    help="bound each micro-batch when a large backlog is landed")
    la.add_argument("--ranges", action="store_true", help="copy files byte for byte, as ranges dealt to tasks")
    w = sub.add_parser("wordcount", help="word count of text files")
    w.add_argument("--input", required=True)
    w.add_argument("--output", required=True)
    q = sub.add_parser("sql", help="run one SQL statement and show the result")
    q.add_argument("statement")
    q.add_argument("--rows", type=int, default=20)
    a = p.parse_args(argv)

    owned = spark is None
    if owned:
        spark = build_session(a.master, app=f"medallion-{a.job}",
                              profile="cluster" if a.master is None else "local")
    if a.job == "silver":
        from pyspark.sql.types import StructType

        from medallion.plans.jobs import silver_job
        first, last = (int(x) for x in a.years.split("-"))
        gaz = spark.read.parquet(a.gazetteer) if a.gazetteer else None
        tx = spark.read.parquet(a.bronze_transactions) if a.bronze_transactions else None
        provider = _load(a.provider) if a.provider else None
        res = silver_job(spark, a.data_root, gazetteer=gaz, provider=provider, code=a.place,
                         years=(first, last), transactions=tx, provider_cache=a.provider_cache,
                         bronze=a.bronze, max_calls=a.max_calls, quarantine=a.quarantine, fuzzy_edits=a.fuzzy_edits,
                         transaction_schema=StructType.fromDDL(a.transaction_schema) if a.transaction_schema else None)
        if res.transactions:
            print(json.dumps(res.transactions.__dict__))
        res.status.show(res.status.count(), truncate=False)
    elif a.job == "gold":
        from medallion.plans.jobs import gold_job
        status = gold_job(spark, a.data_root, decimal_sep=None if a.strict_decimal else ",", map_files=a.map_files)
        status.show(status.count(), truncate=False)
    elif a.job == "land":
        from medallion.streaming.landing import land, land_ranges
        options = dict(o.split("=", 1) for o in a.option)
        if a.ranges:
            run = land_ranges(spark, a.source, a.bronze, a.checkpoint, max_files_per_trigger=a.max_files_per_trigger)
        else:
            run = land(spark, a.source, a.bronze, a.checkpoint, fmt=a.format, schema=a.schema, options=options,
                       max_files_per_trigger=a.max_files_per_trigger)
        print(json.dumps(run.__dict__))
    elif a.job == "wordcount":
        from medallion.operators.text import word_count
        from medallion.sinks.writers import write_text
        write_text(word_count(spark.read.text(a.input)), a.output)
    elif a.job == "sql":
        spark.sql(a.statement).show(a.rows, truncate=False)
    if owned:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
