"""Problem 2: groups of records that print the same thing with small edits, found with a token-group matrix.

Records with the same tokens are one class. Classes of one block with the same rarest token form a
group of bounded size, known by the union of its members' tokens. A query class must share a certain
weight of tokens with any partner, so it looks only at groups that hold one of its rarest tokens,
bounds from the union how much any member can share, and opens only the groups that qualify.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirelake.functions.entries import read_entry
from quirelake.llm.components import components
from quirelake.session import release, stage

#: Tokens in a smaller share of the sets than one in so many weigh alike. So at most so many tokens, times the mean size of a set, have
#: counts of their own, whatever the number of sets: these go to the tasks.
RAREST = 1 << 16
#: Members of a group at most; larger ones are split.
GROUP = 256
#: Classes that are compared at once, and parts that all of them are divided into at most: only one part's shuffles are on disk at a time.
PART_SETS, PARTS = 100_000, 16
#: A token is a number whose last bits are its weight in thousandths.
_WEIGHT_BITS, _WEIGHT = 16, (1 << 16) - 1


def _total(items: Column) -> Column:
    """The weight of weighted tokens."""
    return F.aggregate(items, F.lit(0).cast("bigint"), lambda a, x: a + x.bitwiseAND(F.lit(_WEIGHT).cast("bigint")))


def weighted_sets(sets: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``sets`` (``id``, ``tokens`` and others) with ``items``, the weighted tokens from the rarest on, and ``weight``, their sum, in place of the tokens.

    A token's weight is the logarithm of how many times more sets there are than sets with it, plus
    1, in thousandths; it is part of the token's number, so that common tokens can be summed up
    wherever they meet. Sets without tokens fall out. By one pre-aggregated count and a map.
    """
    total = max(1, sets.count())
    hashed = sets.withColumn("__h", F.transform(tokens, lambda t: F.shiftrightunsigned(F.xxhash64(t), _WEIGHT_BITS + 1))).drop(tokens)
    counts = hashed.select(F.explode("__h").alias("t")).groupBy("t").agg(F.count("*").alias("df")).where(f"df > {total / RAREST!r}").toPandas()
    shared = sets.sparkSession.sparkContext.broadcast((counts["t"].to_numpy(np.int64)[(order := np.argsort(counts["t"].to_numpy(np.int64)))], counts["df"].to_numpy(np.int64)[order]))
    kept = [f for f in hashed.schema.fields if f.name != "__h"]
    names = [*(f.name for f in kept), "items", "weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, df = shared.value
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("__h"))
            flat, ends = column.values.to_numpy(zero_copy_only=False).astype(np.int64), column.offsets.to_numpy()
            flat, ends = flat[ends[0] : ends[-1]], ends - ends[0]
            n = np.full(len(flat), total / RAREST)
            if len(known) and len(flat):
                at = np.minimum(np.searchsorted(known, flat), len(known) - 1)
                n = np.where(known[at] == flat, np.maximum(df[at], n), n)
            weight = np.rint(1000 * (1 + np.log(total / np.maximum(n, 1)))).astype(np.int64)
            item = (flat << _WEIGHT_BITS) | weight
            row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            order = np.lexsort((item, -weight, row))
            sums = np.bincount(row, weights=weight, minlength=len(ends) - 1).astype(np.int64)
            items = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(item[order]))
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(f.name)) for f in kept), items, pa.array(sums)], names)

    schema = T.StructType([*kept, T.StructField("items", T.ArrayType(T.LongType())), T.StructField("weight", T.LongType())])
    return hashed.where("size(__h) > 0").select(*(f.name for f in kept), "__h").mapInArrow(run, schema)


def token_group_pairs(weighed: DataFrame) -> DataFrame:
    """Pairs ``a`` < ``b`` of ids in the same ``block`` whose weighted Jaccard similarity is at least their ``threshold``, with ``similarity``, ``tag_a`` and ``tag_b``.

    ``weighed`` has ``id``, ``block`` (pairs across blocks don't count; null is no block of its own, it
    is compared with null only), ``threshold`` (one for each block), ``tag`` (any number, handed on), and the ``items`` and ``weight`` of
    :func:`weighted_sets`. Exact: no bucket is capped. Sets of a block must be distinct for the cost to stay low: give one for each
    class of equal ones.
    """
    return _matrix_pairs(_grouped(weighed))


def _grouped(weighed: DataFrame) -> DataFrame:
    """The sets with their probes and their group, written."""
    # the rarest items, up to where the rest weighs less than the threshold's share: partners' probes meet
    probe = F.aggregate(
        "items",
        F.struct(F.array().cast("array<bigint>").alias("kept"), F.col("weight").alias("rest")),
        lambda s, x: F.when(s["rest"] >= F.col("threshold") * F.col("weight"), F.struct(F.concat(s["kept"], F.array(x)).alias("kept"), (s["rest"] - x.bitwiseAND(F.lit(_WEIGHT).cast("bigint"))).alias("rest"))).otherwise(s),
    )["kept"]
    blocked = weighed.withColumn("block", F.xxhash64(F.coalesce(F.col("block").cast("string"), F.lit("?"))))
    # the group of a set: its block, its rarest token and its size on a logarithmic scale; of a large group a part by the id
    keyed = blocked.withColumn("g", F.xxhash64("block", F.col("items")[0], F.floor(F.log("weight") * 4)))
    large = keyed.groupBy("g").agg(F.count("*").alias("n")).where(f"n > {GROUP}")
    parted = keyed.join(large, "g", "left").withColumn("grp", F.when(F.col("n").isNull(), F.col("g")).otherwise(F.xxhash64("g", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / GROUP).cast("bigint")))))
    return stage(parted.withColumn("probe", probe).select("id", "block", "threshold", "tag", "items", "weight", "probe", "grp"))


def _matrix_pairs(rows: DataFrame) -> DataFrame:
    """The pairs of :func:`token_group_pairs` of sets with their groups."""
    member = F.struct("id", "tag", "items", "weight")
    matrix = rows.groupBy("grp").agg(F.array_distinct(F.flatten(F.collect_list("items"))).alias("union"), F.collect_list(member).alias("members"))
    probes = rows.select(F.col("id").alias("a"), "block", "threshold", "weight", F.explode("probe").alias("token"))
    cells = rows.select("grp", "block", "weight", F.explode("probe").alias("token")).groupBy("block", "token", "grp").agg(F.min("weight").alias("lightest"), F.max("weight").alias("heaviest"))
    fits = (F.col("lightest") * F.col("threshold") <= F.col("weight")) & (F.col("heaviest") >= F.col("threshold") * F.col("weight"))
    asked = probes.join(cells, ["block", "token"]).where(fits).select("a", "block", "grp").repartition("a").distinct()
    queries = rows.select(F.col("id").alias("a"), "block", "threshold", F.col("tag").alias("tag_a"), F.col("items").alias("items_a"), F.col("weight").alias("weight_a"))
    # bound from the union: only qualifying groups are opened
    met = asked.join(queries, ["a", "block"]).join(matrix, "grp").where(_total(F.array_intersect("items_a", "union")) >= F.col("threshold") * F.col("weight_a"))
    inside = met.select("a", "threshold", "tag_a", "items_a", "weight_a", F.explode("members").alias("m")).where("a <> m.id AND least(weight_a, m.weight) >= threshold * greatest(weight_a, m.weight)")
    shared = inside.withColumn("shared", _total(F.array_intersect("items_a", "m.items"))).withColumn("similarity", F.col("shared") / (F.col("weight_a") + F.col("m.weight") - F.col("shared")))
    found = shared.where("similarity >= threshold").select("a", F.col("m.id").alias("b"), "tag_a", F.col("m.tag").alias("tag_b"), F.round("similarity", 6).alias("similarity"))
    turn = F.col("a") > F.col("b")
    side = lambda x, y: F.when(turn, F.col(y)).otherwise(F.col(x))
    return found.select(side("a", "b").alias("a"), side("b", "a").alias("b"), side("tag_a", "tag_b").alias("tag_a"), side("tag_b", "tag_a").alias("tag_b"), "similarity").distinct()


def read_entries(refs: DataFrame, key: str = "ref_id", text: str = "text") -> DataFrame:
    """``key``, ``words``, ``year``, ``pages``, ``sequel`` and ``tokens`` of each entry, by a map without shuffle."""
    schema = T.StructType(
        [refs.schema[key], T.StructField("words", T.IntegerType()), T.StructField("year", T.IntegerType()), T.StructField("pages", T.StringType()), T.StructField("sequel", T.StringType()), T.StructField("tokens", T.ArrayType(T.StringType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [read_entry(v) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([m[i] for m in made], f) for i, f in enumerate((pa.int32(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.string()))))], schema.names)

    return refs.select(key, F.col(text).cast("string")).mapInArrow(run, schema)


#: Similarity of two entries' weighted tokens: with the same pages, without pages, with other pages.
SAME_PAGES, NO_PAGES, OTHER_PAGES = 0.45, 0.62, 0.9
LEAST_WORDS = 8


def entry_groups(refs: DataFrame, key: str = "ref_id", text: str = "text", links: bool = False) -> DataFrame:
    """``key``, ``entry`` (the least key of the rows that print the same entry) and ``class`` (the least key of the rows that read the same).

    ``links`` adds ``n_links``, with how many other classes the row's own is linked.

    Rows of fewer than eight words have null for both, as have null and empty texts. Two rows
    print one entry when they tell the same year (or none), the same signs of a sequel, and their
    weighted tokens agree well enough in view of their pages. Copies and readings of the same words
    are one class and are compared once, however many they are. The key must be unique and not null.
    """
    read = stage(read_entries(refs.where(F.col(key).isNotNull()), key, text))
    mark = F.xxhash64("year", "sequel", "pages", F.concat_ws(" ", "tokens"))
    able = read.where(f"words >= {LEAST_WORDS} AND size(tokens) > 0").withColumn("mark", mark)
    classes = stage(able.groupBy("mark").agg(F.min(key).alias("id"), F.first("year").alias("year"), F.first("sequel").alias("sequel"), F.first("pages").alias("pages"), F.first("tokens").alias("tokens")))
    found = stage(able.select(key, "mark").join(classes.select("mark", F.col("id").alias("class")), "mark").select(key, "class"))
    release(read)
    when = F.concat_ws("|", F.coalesce(F.col("year").cast("string"), F.lit("?")), "sequel")
    weighed = weighted_sets(classes.select("id", when.alias("when"), F.xxhash64("pages").alias("tag"), F.col("pages").isNotNull().alias("paged"), "tokens"))
    # pairs are of one year and sequel, so what these have in common is compared in one part
    parts, n_parts = _parts(classes.groupBy(when.alias("when")).agg(F.count("*").alias("n")))
    weighed = stage(weighed.withColumn("tag", F.when(F.col("paged"), F.col("tag"))).join(parts, "when", "left"), ("part",))
    release(classes)
    # a class with pages is in two blocks: with those of the same pages, and with all of its year
    same = F.struct(F.concat_ws("|", "when", F.col("tag").cast("string")).alias("block"), F.lit(SAME_PAGES).alias("threshold"))
    dated = F.struct(F.col("when").alias("block"), F.lit(NO_PAGES).alias("threshold"))
    blocks = weighed.withColumn("b", F.explode(F.when(F.col("paged"), F.array(dated, same)).otherwise(F.array(dated)))).select("id", "tag", "items", "weight", "b.block", "b.threshold", "part")
    agreed = (F.col("tag_a").isNull() | F.col("tag_b").isNull()) | (F.col("tag_a") == F.col("tag_b")) | (F.col("similarity") >= OTHER_PAGES)
    of_part = []
    for part in range(n_parts):
        grouped = _grouped(blocks.where(F.col("part") == part).drop("part"))
        of_part.append(stage(_matrix_pairs(grouped).where(agreed).select("a", "b").distinct()))
        release(grouped)
    release(weighed)
    pairs = reduce(DataFrame.union, of_part)
    linked = components(pairs)
    found = found.join(linked.withColumnRenamed("node", "class"), "class", "left").select(key, F.coalesce("component", "class").alias("entry"), "class")
    if links:
        degrees = pairs.union(pairs.select("b", "a")).groupBy(F.col("a").alias("class")).agg(F.count("*").alias("n_links"))
        found = found.join(degrees, "class", "left").select(key, "entry", "class", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return refs.select(key).join(found, key, "left")


def _parts(loads: DataFrame) -> tuple[DataFrame, int]:
    """``when`` and ``part``, and the number of parts, for the ``when`` and ``n`` (classes) of ``loads``: parts of like size, the largest given out first.

    There are as many rows as years with signs of a sequel are printed, which doesn't grow with the classes; one of them isn't divided.
    """
    counted = sorted(((r.n, r.when) for r in loads.collect()), reverse=True)
    held = [0] * max(1, min(PARTS, -(-sum(n for n, _ in counted) // PART_SETS)))
    given = []
    for n, when in counted:
        part = held.index(min(held))
        held[part] += n
        given.append((when, part))
    return loads.sparkSession.createDataFrame(given, "when string, part int"), len(held)


def pairs_within(rows: DataFrame, key: str, group: str, names: tuple[str, str]) -> DataFrame:
    """All pairs of ``key`` within a ``group``, the smaller first, named ``names``. Rows of no group (null) have none.

    This is the expansion that a list of all pairs asks for; its size is that of the result. The groups are written once.
    """
    side = stage(rows.where(F.col(group).isNotNull()).select(group, key))
    left, right = side.withColumnRenamed(key, names[0]), side.withColumnRenamed(key, names[1])
    return left.join(right, group).where(F.col(names[0]) < F.col(names[1])).select(*names)
