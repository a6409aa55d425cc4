"""Markdown prepared for typesetting: heading levels, chapters, footnotes, formulas.

Headings are rows (``doc_id``, ``pos`` from 0, ``line_no`` from 1, ``mark``, ``text``), so the rules are
windows over them and the lines are put together again at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirelake.functions import blocks
from quirelake.functions import text as X
from quirelake.operators.enrich import lines_of

LEVELS = ("chapter", "section", "not_heading")
_HEADING = r"^(#{1,2})\s+(.*)$"


def headings(docs: DataFrame, doc: str = "doc_id", text: str = "markdown") -> DataFrame:
    """All headings of the first two levels."""
    rows = lines_of(docs, doc, text).where(F.col("line").rlike(_HEADING))
    return rows.select(doc, (F.row_number().over(Window.partitionBy(doc).orderBy("line_no")) - 1).alias("pos"), "line_no", F.regexp_extract("line", _HEADING, 1).alias("mark"), F.regexp_extract("line", _HEADING, 2).alias("text"))


def heading_candidates(docs: DataFrame, most: int = 220, doc: str = "doc_id", text: str = "markdown") -> DataFrame:
    """``doc``, ``pos``, ``preceding`` heading, ``text`` and the ``following`` text up to the next heading, its lines trimmed and joined, cut at ``most``."""
    lines = lines_of(docs, doc, text)
    w = Window.partitionBy(doc).orderBy("line_no")
    rows = lines.withColumn("__h", F.col("line").rlike(_HEADING)).withColumn("pos", F.sum(F.col("__h").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    body = rows.where(~F.col("__h") & (F.col("pos") >= 0)).where(F.trim("line", F.lit(" \t")) != "").groupBy(doc, "pos").agg(F.array_sort(F.collect_list(F.struct("line_no", F.trim("line", F.lit(" \t")).alias("l")))).alias("ls"))
    found = headings(docs, doc, text)
    out = found.join(body, [doc, "pos"], "left").withColumn("preceding", F.coalesce(F.lag("text").over(Window.partitionBy(doc).orderBy("pos")), F.lit("")))
    return out.select(doc, "pos", "preceding", "text", F.coalesce(F.substring(F.array_join(F.transform("ls", lambda x: x["l"]), " "), 1, most), F.lit("")).alias("following"))


def resolve_levels(found: DataFrame, levels: DataFrame | None = None, doc: str = "doc_id") -> DataFrame:
    """Headings with ``level``: that of ``levels`` (``doc``, ``pos``, ``level``), by default and where unknown a section; one equal to the last kept heading is none.

    Without given levels the last kept heading has the text of the last heading, so a lag decides;
    with them the fold runs over each document's headings.
    """
    rows = found.withColumn("__norm", X.heading_text("text"))
    order = Window.partitionBy(doc).orderBy("pos")
    if levels is None:
        return rows.withColumn("level", F.when(F.col("__norm").eqNullSafe(F.lag("__norm").over(order)), "not_heading").otherwise("section")).drop("__norm")
    given = levels.select(doc, "pos", F.when(F.col("level").isin(*LEVELS), F.col("level")).alias("__given"))
    rows = rows.join(given, [doc, "pos"], "left").withColumn("__given", F.coalesce("__given", F.lit("section")))
    lists = rows.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("pos", F.col("__norm").alias("norm"), F.col("__given").alias("given")))).alias("hs"))
    start = F.struct(F.array().cast("array<struct<pos:int,level:string>>").alias("out"), F.lit(None).cast("string").alias("last"))

    def step(s, h):
        level = F.when(h["norm"].eqNullSafe(s["last"]), "not_heading").otherwise(h["given"])
        return F.struct(F.concat(s["out"], F.array(F.struct(h["pos"].cast("int").alias("pos"), level.alias("level")))).alias("out"), F.when(level == "not_heading", s["last"]).otherwise(h["norm"]).alias("last"))

    judged = lists.select(doc, F.explode(F.aggregate("hs", start, step, lambda s: s["out"])).alias("x")).select(doc, "x.pos", "x.level")
    return rows.drop("__norm", "__given").join(judged, [doc, "pos"])


def promote_orphans(found: DataFrame, doc: str = "doc_id") -> DataFrame:
    """A kept section right before a kept ``N-1.`` heading is a chapter, unless it is EXERCISES."""
    kept = found.where("level <> 'not_heading'")
    after = F.lead("text").over(Window.partitionBy(doc).orderBy("pos"))
    up = kept.withColumn("__next", after).where((F.col("level") == "section") & F.trim("__next").rlike(r"^\d+-1\.") & (X.heading_text("text") != "EXERCISES")).select(doc, "pos", F.lit(True).alias("__up"))
    return found.join(up, [doc, "pos"], "left").withColumn("level", F.when(F.col("__up"), "chapter").otherwise(F.col("level"))).drop("__up")


def heading_lines(found: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``doc``, ``line_no`` and ``new``: neighbouring chapters as one first-level heading joined by colons, later ones null (dropped); sections second-level; others plain."""
    order = Window.partitionBy(doc).orderBy("pos")
    rows = found.withColumn("__lag", F.lag("level").over(order)).withColumn("__new", F.when((F.col("level") == "chapter") & F.coalesce(F.col("__lag") == "chapter", F.lit(False)), 0).otherwise(1))
    rows = rows.withColumn("__run", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = rows.groupBy(doc, "__run").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), ": ").alias("__all"))
    new = F.when(F.col("level") == "chapter", F.when(F.col("__new") == 1, F.concat(F.lit("# "), "__all"))).when(F.col("level") == "section", F.concat(F.lit("## "), "text")).otherwise(F.col("text"))
    return rows.join(joined, [doc, "__run"]).select(doc, "line_no", new.alias("new"))


def apply_levels(docs: DataFrame, levels: DataFrame | None = None, doc: str = "doc_id", text: str = "markdown") -> DataFrame:
    """W13 to W15 applied: ``doc`` and ``markdown``."""
    found = resolve_levels(headings(docs, doc, text), levels, doc)
    changes = heading_lines(promote_orphans(found, doc) if levels is not None else found, doc).withColumn("__h", F.lit(True))
    rows = lines_of(docs, doc, text).join(changes, [doc, "line_no"], "left")
    rows = rows.withColumn("line", F.when(F.col("__h"), F.col("new")).otherwise(F.col("line")))
    lists = rows.where("line IS NOT NULL").groupBy(doc).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("markdown"))
    return docs.select(doc).join(lists, doc, "left")


def convert_footnotes(docs: DataFrame, doc: str = "doc_id", text: str = "markdown") -> DataFrame:
    """``> **Footnote:** …`` paragraphs as numbered notes, each referred to at the end of the block before; one that opens the text stays."""
    paragraphs = F.split(F.col(text), "\n\n", -1)
    note = r"(?s)\A> \*\*Footnote:\*\* (.+)\z"
    trimmed = lambda p: F.trim(p, F.lit(" \n\t"))
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("n"))

    def step(s, p):
        is_note = trimmed(p).rlike(note) & (F.size(s["out"]) > 0)
        n = (s["n"] + 1).cast("string")
        before = F.concat(F.slice(s["out"], 1, F.greatest(F.size(s["out"]) - 1, F.lit(0))), F.array(F.concat(F.element_at(s["out"], -1), F.lit("[^"), n, F.lit("]"))))
        added = F.concat(before, F.array(F.concat(F.lit("[^"), n, F.lit("]: "), F.regexp_extract(trimmed(p), note, 1))))
        return F.when(is_note, F.struct(added.alias("out"), (s["n"] + 1).alias("n"))).otherwise(F.struct(F.concat(s["out"], F.array(p)).alias("out"), s["n"].alias("n")))

    made = F.aggregate(paragraphs, start, step, lambda s: F.array_join(s["out"], "\n\n"))
    return docs.select(doc, made.alias("markdown"))


def prepare(docs: DataFrame, levels: DataFrame | None = None, doc: str = "doc_id", text: str = "markdown") -> DataFrame:
    """The input of the typesetter: no page markers, levels applied, footnotes as notes, no crop names, formulas normalised."""
    bare = docs.select(doc, X.strip_page_markers(text).alias("markdown"))
    rows = convert_footnotes(apply_levels(bare, levels, doc), doc)
    return rows.select(doc, blocks.normalise_math_column(F.regexp_replace("markdown", r"!\[FIGURE(?:_CROP)?[^\]]*\]", "![]")).alias("markdown"))


def error_counts(logs: DataFrame, doc: str = "doc_id", text: str = "log") -> DataFrame:
    """Distinct error lines of typesetting logs by document, with ``n`` and ``rank``, the most frequent first, then the first met."""
    each = logs.select(doc, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(r"(?m)^! (.+)$"), F.lit(1))).alias("at", "error"))
    counts = each.groupBy(doc, "error").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy(doc).orderBy(F.desc("n"), "first"))).drop("first")


def render(docs: DataFrame, command: list[str] | None = None) -> DataFrame:
    """K9: ``doc_id`` and ``pdf``: each prepared document through an external typesetter (``pandoc`` by default), null where it fails or isn't there."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("pdf", T.BinaryType())])
    argv = command or ["pandoc", "-f", "markdown", "--pdf-engine=xelatex", "-o"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pathlib
        import shutil
        import subprocess
        import tempfile

        for batch in batches:
            made = []
            for value in batch.column(1).to_pylist():
                made.append(None)
                if value is not None and shutil.which(argv[0]):
                    with tempfile.TemporaryDirectory() as folder:
                        out = pathlib.Path(folder, "out.pdf")
                        subprocess.run([*argv, str(out)], input=value.encode(), capture_output=True, timeout=600, check=False)
                        made[-1] = out.read_bytes() if out.exists() else None
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["doc_id", "pdf"])

    return docs.select("doc_id", "markdown").mapInArrow(run, schema)
