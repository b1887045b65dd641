"""Build the immigration star schema: ``python -m starloom --help``."""

from __future__ import annotations

import argparse

from starloom.plans.immigration import Inputs, Settings, run_star_schema
from starloom.session import build_session


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="starloom", description=__doc__.split(":")[0])
    for name in ("airports", "cities", "countries", "ports", "modes", "states", "visas", "arrivals"):
        parser.add_argument(f"--{name}", required=True, metavar="PATH")
    parser.add_argument("--arrivals-format", default="parquet", help="any format Spark has a reader for")
    parser.add_argument("--output", required=True, metavar="PATH", help="folder for the tables")
    parser.add_argument("--directory-per-airport", action="store_true", help="partition airports by code as well")
    parser.add_argument("--unique-dimensions", action="store_true", help="a repeated airport code does not repeat facts")
    parser.add_argument("--largest-shuffle-gb", type=int, default=None, help="to size the shuffles of a big run")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> int:
    chosen = parse(arguments)
    shuffle = None if chosen.largest_shuffle_gb is None else chosen.largest_shuffle_gb * 1024**3
    spark = build_session("star schema", largest_shuffle_bytes=shuffle)
    inputs = Inputs(
        *(getattr(chosen, name) for name in ("airports", "cities", "countries", "ports", "modes", "states", "visas")),
        arrivals=chosen.arrivals,
        arrivals_format=chosen.arrivals_format,
    )
    settings = Settings(
        airport_partitions=("state", "local_code") if chosen.directory_per_airport else ("state",),
        unique_dimensions=chosen.unique_dimensions,
    )
    outcome = run_star_schema(spark, inputs, chosen.output.rstrip("/"), settings)
    outcome.top_settlements.show(truncate=False)
    checks = outcome.checks.collect()
    for row in sorted(checks):
        print(f"{row.status:6s} {row.table_name}: {row.n_rows} rows")
    return int(any(row.status != "ok" for row in checks))


if __name__ == "__main__":
    raise SystemExit(main())
