"""Command line: ``python -m brindle.cli run --landed DIR --names FILE --output DIR``."""

from __future__ import annotations

import argparse
import sys

from . import config as settings
from .plans import runs
from .schemas import PACKAGE, SCRAPE
from .session import session
from .sources import readers, sinks


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="brindle")
    p.add_argument("--config")
    p.add_argument("--production", action="store_true")
    p.add_argument("--batch-size", type=int)
    p.add_argument("--workers", type=int)
    p.add_argument("--max-retries", type=int)
    p.add_argument("--max-tokens", type=int)
    p.add_argument("--provider")
    p.add_argument("--model")
    p.add_argument("--url")
    p.add_argument("--budget", type=float)
    p.add_argument("--limit", type=int)
    p.add_argument("--skip-enrichment", action="store_true", default=None)
    p.add_argument("--output-dir")
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="packages from landed JSON lines")
    run.add_argument("--landed", required=True)
    run.add_argument("--names", required=True)
    trace = sub.add_parser("trace", help="traces from landed scrapes")
    trace.add_argument("--scrapes", required=True)
    check = sub.add_parser("verify", help="a dataset against a source of truth")
    check.add_argument("--dataset", required=True)
    check.add_argument("--truth", required=True)
    check.add_argument("--sample", type=int, default=20)
    know = sub.add_parser("knowledge", help="create and fill the knowledge base")
    know.add_argument("--code")
    know.add_argument("--repo")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    flags = {k: getattr(args, k) for k in ("batch_size", "workers", "max_retries", "max_tokens", "provider", "model", "url", "budget", "limit", "skip_enrichment", "output_dir")}
    config = settings.load(args.config, args.production, flags)
    spark = session()
    root = sinks.output_dir(spark, config.output_dir)
    if args.command == "run":
        names = readers.names_of(spark, args.names, required=True)
        if config.limit:
            names = names.orderBy("name").limit(config.limit)
        runs.batch_run(names, readers.json_lines(spark, args.landed, PACKAGE), config, root=root)
    elif args.command == "trace":
        runs.trace_run(spark, readers.json_lines(spark, args.scrapes, SCRAPE), config, root)
    elif args.command == "verify":
        runs.verification_run(readers.json_lines(spark, args.dataset, PACKAGE), readers.json_lines(spark, args.truth, PACKAGE), args.sample, root)
    else:
        runs.knowledge_run(spark, root, args.code, args.repo)
    print(root)
    return 0


if __name__ == "__main__":
    sys.exit(main())
