"""The whole way from layout regions to chunks and linked, resolved references, for a corpus at once.

A single document is a corpus of one. Each stage can also be entered with saved tables.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelake.config import EngineConfig
from quirelake.functions import blocks
from quirelake.operators import chunk, extraction, linking, parse, references, resolve
from quirelake.session import stage


class Refined(NamedTuple):
    """B1: what a run gives; ``failed`` has documents without text, with a reason."""

    markdown: DataFrame
    references: DataFrame
    resolved: DataFrame
    links: DataFrame
    chunks: DataFrame
    failed: DataFrame
    extracted: DataFrame


def refine(
    regions: DataFrame, catalogue: DataFrame, config: EngineConfig = EngineConfig(), model: Callable[[list[str]], list[dict]] = extraction.rule_extractor, layers: DataFrame | None = None, cache: DataFrame | None = None, misses: bool = True
) -> Refined:
    """B1 and B2: regions parsed, bibliographies repaired, references extracted and resolved, markers linked on the printed fields and rewritten with the resolved keys, text chunked.

    ``model`` reads a batch of entries; a batch it fails on gives empty rows and doesn't stop the rest. Batches in
    ``cache`` (an earlier run's :func:`quirelake.operators.extraction.cache_entries`) don't go to it; ``extracted`` gives the next one's.
    Without ``misses`` unverified references have no near miss. A document whose regions hold no text ends in ``failed`` and has no chunks.
    """
    markdown, _, raw = parse.parse_regions(regions)
    docs = stage(markdown.withColumn("markdown", blocks.repair_fences_column("markdown")))
    refs = stage(references.drop_index_entries(references.repair_references(raw, layers=layers).drop("ref_idx").withColumnRenamed("position", "ref_idx")))
    guess = stage(extraction.extract_batches(refs, model, config.citations.batch_size, cache))
    named = refs.select("doc_id", "ref_idx", F.col("text").alias("raw_text")).join(guess.select("doc_id", "ref_idx", *extraction.FIELDS), ["doc_id", "ref_idx"], "left")
    resolved = stage(resolve.resolve(named, catalogue, config=config.citations, misses=misses))
    links = stage(linking.scan_markers(docs, named))
    written = linking.rewrite(docs, linking.marker_keys(links, linking.citekeys(resolved)))
    empty = F.trim(F.regexp_replace("markdown", r"<page_number>\d+</page_number>", ""), F.lit(" \n\t")) == ""
    failed = docs.where(empty).select("doc_id", F.lit("no text").alias("reason"))
    chunks = chunk.chunk_markdown(written.where(~empty), config=config.chunk)
    return Refined(written, refs, resolved, links, chunks, failed, guess)
