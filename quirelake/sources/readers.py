"""Readers: documents, regions, manifests, checkpoints and answers of providers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake import schemas


def read_pdfs(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``content``, ``sha256`` and ``n_pages`` of PDF files; pages are counted by their objects, null where a file hides them in streams."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "true").load(path)
    body = F.decode("content", "ISO-8859-1")
    pages = F.size(F.regexp_extract_all(body, F.lit(r"/Type\s*/Page\b(?!s)"), F.lit(0)))
    return files.select("path", "content", F.sha2("content", 256).alias("sha256"), F.when(pages > 0, pages).alias("n_pages"))


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """S3: layout regions as JSON lines; a document without any region is an error that the caller's count shows."""
    return spark.read.schema(schemas.REGIONS).json(path)


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``doc_id`` (the folder's name) and ``markdown`` of whole files."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("markdown"))
    return files.withColumn("doc_id", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1))


def read_citations(spark: SparkSession, path: str) -> DataFrame:
    """The references of citation manifests, a row for each."""
    rows = spark.read.option("multiLine", "true").json(path)
    return rows.select("docname", F.posexplode("references").alias("ref_idx", "r")).select(F.col("docname").alias("doc_id"), "ref_idx", "r.*")


def join_meta(docs: DataFrame, meta: DataFrame) -> DataFrame:
    """Documents with the metadata of their path, both made absolute; nulls where there is none."""
    plain = lambda c: F.regexp_replace(F.regexp_replace(c, "^file:", ""), "/+", "/")
    return docs.withColumn("__p", plain(F.col("path"))).join(meta.withColumn("__p", plain(F.col("path"))).drop("path"), "__p", "left").drop("__p")


def manifest_key(version: str, content_id: str, settings: dict[str, object]) -> "F.Column":
    """The key of a checkpoint: version, content and the settings that change the output."""
    return F.sha2(F.to_json(F.struct(F.lit(version).alias("version"), F.col(content_id).alias("content_id"), *(F.lit(str(v)).alias(k) for k, v in sorted(settings.items())))), 256)


def split_by_checkpoint(wanted: DataFrame, done: DataFrame, key: str = "manifest_key") -> tuple[DataFrame, DataFrame]:
    """Rows whose key a checkpoint has, with its columns, and rows that are to be worked again."""
    return wanted.join(done.dropDuplicates([key]), key), wanted.join(done.select(key).distinct(), key, "left_anti")


def secret_free(value: "F.Column", secrets: list[str]) -> "F.Column":
    """Text with known secrets masked, also URL-quoted, the longest first."""
    from urllib.parse import quote

    for secret in sorted({s for x in secrets if x for s in (x, quote(x, safe=""))}, key=len, reverse=True):
        value = F.replace(value, F.lit(secret), F.lit("***"))
    return value


