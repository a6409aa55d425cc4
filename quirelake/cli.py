"""Command line: ``chunk``, ``review``, ``export-citations`` and ``typeset`` over a folder of saved documents."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from quirelake.config import load_config
from quirelake.operators.chunk import chunk_markdown
from quirelake.operators.resolve import export_citations
from quirelake.operators.typeset import prepare
from quirelake.session import get_session
from quirelake.sources import readers, writers


def main(argv: list[str] | None = None) -> int:
    """Exit code 0 when something was done (for ``review``: when nothing was missing), else 1."""
    parser = argparse.ArgumentParser(prog="quirelake", description=__doc__)
    parser.add_argument("command", choices=("chunk", "review", "export-citations", "typeset"))
    parser.add_argument("path", help="folder or glob of the saved documents")
    parser.add_argument("out", help="folder to write to")
    parser.add_argument("--config", default=None)
    parser.add_argument("--all", action="store_true", help="export unverified references too")
    args = parser.parse_args(argv)
    config = load_config(args.config)
    spark = get_session("quirelake-cli")
    if args.command == "export-citations":
        rows = export_citations(readers.read_citations(spark, args.path), not args.all)
        rows.write.mode("overwrite").json(args.out)
        return 0
    docs = readers.read_markdown(spark, args.path)
    if args.command == "chunk":
        made = chunk_markdown(docs, config=config.chunk)
        writers.write_texts(writers.chunk_manifests(made), args.out)
        return int(made.isEmpty())
    if args.command == "typeset":
        writers.write_texts(prepare(docs), args.out, text="markdown")
        return int(docs.isEmpty())
    missing = docs.where(F.trim(F.coalesce("markdown", F.lit(""))) == "").count()
    writers.write_texts(writers.review_copies(docs), args.out, text="markdown")
    return int(missing > 0)


if __name__ == "__main__":
    sys.exit(main())
