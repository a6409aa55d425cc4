"""Queries of the package's operators, over whole tables, and the SQL they can be held against."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.llm import lookalike, markup, matching, mixing, names, neardup, reading, scans, splitting, tokens
from quirelake.session import table

#: The text columns of the domain's tables that problems 1, 3, 6 and 7 name: table, key, text.
NAMES = (("author_names", "name_id", "family"), ("extracted_refs", "ext_id", "title"))


def _texts(spark: SparkSession, root: str, which: tuple[tuple[str, str, str], ...]) -> DataFrame:
    parts = [table(spark, root, t).select(F.lit(t).alias("tbl"), F.col(k).cast("bigint").alias("rec_id"), F.col(c).alias("text")) for t, k, c in which]
    return reduce(DataFrame.unionByName, parts)


MARKED = (("chunks", "chunk_id", "text"), ("parse_results", "paper_id", "markdown"))


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    made = markup.clean_markup(_texts(spark, root, MARKED), ("tbl", "rec_id"))
    return made.where("n_marks > 0").select("tbl", "rec_id")


def p1_clean(spark: SparkSession, root: str) -> DataFrame:
    return markup.clean_markup(_texts(spark, root, MARKED), ("tbl", "rec_id"))


SCANNED = (("parse_results", "paper_id", "markdown"), ("raw_refs", "ref_id", "text"))


def _repaired(spark: SparkSession, root: str, with_text: bool) -> DataFrame:
    return scans.repair_scans(_texts(spark, root, SCANNED), ("tbl", "rec_id"), one_line="tbl = 'raw_refs'", with_text=with_text)


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    return _repaired(spark, root, False).where("n_hyphens + n_misread + n_edges > 0").select("tbl", "rec_id")


def p3_repaired(spark: SparkSession, root: str) -> DataFrame:
    return _repaired(spark, root, True)


def p2_groups(spark: SparkSession, root: str) -> DataFrame:
    return neardup.entry_groups(table(spark, root, "raw_refs"), links=True)


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    return neardup.pairs_within(neardup.entry_groups(table(spark, root, "raw_refs")), "ref_id", "entry", ("ref_id_a", "ref_id_b"))


def p4_entities(spark: SparkSession, root: str) -> DataFrame:
    return names.link_names(table(spark, root, "author_names"), table(spark, root, "given_aliases"))


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    return neardup.pairs_within(p4_entities(spark, root), "name_id", "entity", ("name_id_a", "name_id_b"))


def p5_matches(spark: SparkSession, root: str) -> DataFrame:
    return matching.match_records(table(spark, root, "extracted_refs"), table(spark, root, "candidates"), ("ext_id", "cand_id"))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    return p5_matches(spark, root).select("ext_id", "cand_id")


def p7_pieces(spark: SparkSession, root: str) -> DataFrame:
    return splitting.split_oversized(_texts(spark, root, MARKED), ("tbl", "rec_id"))


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    made = splitting.split_oversized(_texts(spark, root, MARKED), ("tbl", "rec_id"), with_text=False)
    return made.where("piece = 1").select("tbl", "rec_id")


def p6_unified(spark: SparkSession, root: str) -> DataFrame:
    return lookalike.unify_text(_texts(spark, root, NAMES), "text").select("tbl", "rec_id", "form", F.array_join("traits", ",").alias("traits"))


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    return p6_unified(spark, root).where("traits <> ''").select("tbl", "rec_id")


def p8_ids(spark: SparkSession, root: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, root, "documents"))


def p8_decoded(spark: SparkSession, root: str) -> DataFrame:
    back = tokens.decode_corpus(p8_ids(spark, root))
    return back.select("doc_id", "text", F.octet_length("raw").cast("bigint").alias("n_bytes"))


def _sizes(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").where("source IS NOT NULL")
    wanted = docs.select(F.struct("doc_id", "source").alias("key"), "text")
    return tokens.encode_corpus(wanted, "key", counts_only=True).select("key.doc_id", "key.source", "n_tokens")


def _mixed(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    return mixing.mix_sources(_sizes(spark, root), table(spark, root, "mix_targets"))


def p9_mix(spark: SparkSession, root: str) -> DataFrame:
    return _mixed(spark, root)[0]


def p9_shares(spark: SparkSession, root: str) -> DataFrame:
    return _mixed(spark, root)[1]


def p10_levels(spark: SparkSession, root: str) -> DataFrame:
    documents = table(spark, root, "documents")
    return reading.reading_levels(documents, reading.fit_levels(documents, table(spark, root, "level_labels")))


def p10_found(spark: SparkSession, root: str) -> DataFrame:
    return p10_levels(spark, root).where(f"english AND n_words >= {reading.LEAST_WORDS} AND level IS NOT NULL").select("doc_id", "level")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_clean": p1_clean,
    "p2_found": p2_found,
    "p2_groups": p2_groups,
    "p3_found": p3_found,
    "p3_repaired": p3_repaired,
    "p4_found": p4_found,
    "p4_entities": p4_entities,
    "p5_found": p5_found,
    "p5_matches": p5_matches,
    "p6_found": p6_found,
    "p6_unified": p6_unified,
    "p7_found": p7_found,
    "p7_pieces": p7_pieces,
    "p8_ids": p8_ids,
    "p8_decoded": p8_decoded,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_levels": p10_levels,
}

_HIDDEN = r"\x{AD}\x{34F}\x{61C}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180F}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{3164}\x{FE00}-\x{FE0F}\x{FEFF}\x{FFA0}\x{FFF0}-\x{FFF8}\x{1BCA0}-\x{1BCA3}\x{1D173}-\x{1D17A}\x{E0000}-\x{E0FFF}\x{0}-\x{8}\x{E}-\x{1B}\x{7F}-\x{84}\x{86}-\x{9F}"
_SHOWN = (
    r"[\x{FF01}-\x{FF60}\x{FFE0}-\x{FFE6}\x{FF61}-\x{FF9F}\x{FB00}-\x{FB06}\x{FB13}-\x{FB17}\x{132}\x{133}\x{149}\x{1C4}-\x{1CC}\x{1F1}-\x{1F3}\x{300}-\x{36F}\x{1AB0}-\x{1AFF}\x{1DC0}-\x{1DFF}\x{20D0}-\x{20FF}\x{FE20}-\x{FE2F}"
    + _HIDDEN + r"\t\n\r\x{B}\x{C}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
_MIXED = r"\p{Latin}\p{L}*[\p{Greek}\p{Cyrillic}]|[\p{Greek}\p{Cyrillic}]\p{L}*\p{Latin}|\p{Greek}\p{L}*\p{Cyrillic}|\p{Cyrillic}\p{L}*\p{Greek}"

ORACLES: dict[str, str] = {
    "p6_found": f"""WITH t AS (SELECT 'author_names' AS tbl, name_id AS rec_id, family AS text FROM author_names UNION ALL SELECT 'extracted_refs', ext_id, title FROM extracted_refs)
        SELECT tbl, rec_id FROM t WHERE regexp_matches(text, '{_SHOWN}') OR regexp_matches(regexp_replace(text, '[{_HIDDEN}]', '', 'g'), '{_MIXED}')""",
    "p7_found": """SELECT 'parse_results' AS tbl, paper_id AS rec_id FROM parse_results WHERE length(markdown) > 6000
        UNION ALL SELECT 'chunks', chunk_id FROM chunks WHERE length(text) > 6000""",
    "p8_decoded": "SELECT doc_id, coalesce(text, '') AS text, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n_bytes FROM documents",
}
