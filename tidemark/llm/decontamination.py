"""Benchmark decontamination: size-partitioned MinHash containment search, exact verification.

Items are short, documents long, so Jaccard estimates of the two say little; the search keeps
MinHash sketches made for containment.  A set's sketch at scale ``s`` holds the hashes of its word
shingles that fall in the lowest 1/s of the hash range, and containment is estimated from sketches
of the same scale, whatever the sizes of the sets.  Items are partitioned by size: each gets the
largest power-of-two scale at which its sketch still has ``SKETCH_LEAST`` shingles, so small items
keep all of theirs and large ones a fixed-size part.  A document's shingles are hashed once; those
that can be in some item's sketch (at the smallest scale in use) are looked up.

Candidates are verified on the shingles themselves: ``|item & document| / |item|``, exactly.  An item
of containment 0.8 with 16 or more sketch shingles is missed by the search only if each of them is
among the absent fifth (less than 1e-11); an item whose sketch is whole is never missed, and a text
that holds too little of such a sketch is no candidate.

Documents meet the items only through distinct sketch hashes; the item table is broadcast by
Spark only where its measured size permits, and is shuffled on the hash otherwise.  Hits are
made distinct per (text, item, hash) in the map tasks before they are shuffled.  Verification joins rows
(text, shingle) of distinct candidate texts with rows (candidate, shingle) and counts them, so neither a
passage that many items share nor a text that many documents repeat gathers in one row or task; verdicts are a
table, joined to the documents by a shuffle that Spark can split where a text has many copies.

Shingles are five lower-cased words; an item with fewer words is one shingle and matches texts
that have those words in a row.

Defined cases: null and empty texts match nothing and are kept; items that are null or without
words match nothing; equal items are reported each; equal texts get equal results and every row
stays; no items leaves everything clean; input columns named like an output column are replaced,
others are passed through; texts of any length are searched whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, quoted, read_table, settled, without

WIDTH = 5
CONTAINMENT = 0.8
SKETCH_LEAST = 16
_SPACE = r"[ \t\n\x0B\f\r]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _SPACE, -1), lambda w: w != "")


def shingles(words: Column, width: Column) -> Column:
    """Distinct shingles of ``width`` words, joined by a space."""
    return F.array_distinct(
        F.when(
            F.size(words) >= width,
            F.transform(F.sequence(F.lit(1), F.size(words) - width + F.lit(1)), lambda i: F.array_join(F.slice(words, i, width), " ")),
        ).otherwise(F.array().cast("array<string>"))
    )


def shingle_hashes(words: Column, width: int) -> Column:
    return F.when(
        F.size(words) >= width,
        F.transform(F.sequence(F.lit(1), F.size(words) - F.lit(width - 1)), lambda i: F.xxhash64(F.array_join(F.slice(words, i, F.lit(width)), " "))),
    ).otherwise(F.array().cast("array<bigint>"))


def items_with_sketches(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """One row per item: id, width of its shingles, the shingles, its scale and its sketch."""
    words = F.col("w")
    out = items.select(quoted(item_id).alias("item"), settled(words_of(quoted(text))).alias("w")).where(F.size("w") > 0)
    out = out.withColumn("width", settled(F.least(F.size("w"), F.lit(WIDTH)))).withColumn("item_shingles", settled(shingles(words, F.col("width"))))
    out = out.withColumn("hashes", settled(F.transform("item_shingles", lambda s: F.xxhash64(s)))).drop("w")
    # the largest scale that leaves SKETCH_LEAST hashes; the SKETCH_LEAST-th lowest hash decides
    low = F.get(F.array_sort(F.transform("hashes", lambda h: F.shiftrightunsigned(h, 1))), F.lit(SKETCH_LEAST - 1))
    scale = F.when(low > 0, F.greatest(F.lit(0), F.lit(62) - F.floor(F.log2(low.cast("double"))).cast("int"))).otherwise(F.lit(0))
    out = out.withColumn("scale", settled(scale))
    # the scale is named twice, so that the optimiser keeps it a column and doesn't work it out per hash
    own = F.filter("hashes", lambda h: F.shiftrightunsigned(h, 1) < F.pow(F.lit(2.0), F.lit(63) - F.col("scale")))
    return out.withColumn("sketch", F.when(F.col("scale") >= 0, own))


def _lookups(words: Column, width: int, scale: int, tagged: bool) -> Column:
    """Hashes of a text's shingles that can be in a sketch of ``scale`` or above; ``tagged`` with their width."""
    found = shingle_hashes(words, width)
    if scale:
        found = F.filter(found, lambda h: F.shiftrightunsigned(h, 1) < F.lit(1 << (63 - scale)))
    return F.transform(found, lambda h: F.struct(F.lit(width).alias("width"), h.alias("h"))) if tagged else found


def candidates(docs: DataFrame, known: DataFrame, text: str, containment: float) -> DataFrame:
    """Pairs (__tm_k1, __tm_k2, i, width) of texts and items that may be contained in them."""
    shapes = known.groupBy("width").agg(F.min("scale").alias("scale")).collect()  # WIDTH rows at most
    index = known.select("i", "width", F.explode("sketch").alias("h"))
    body = docs.where(quoted(text).isNotNull()).select(*text_key(quoted(text)), settled(words_of(quoted(text))).alias("w"))
    arrays = [_lookups(F.col("w"), row["width"], row["scale"], len(shapes) > 1) for row in sorted(shapes, key=lambda r: r["width"])]
    if not arrays:
        return body.select("__tm_k1", "__tm_k2", F.lit(0).cast("bigint").alias("i"), F.lit(WIDTH).alias("width")).limit(0)
    if len(arrays) > 1:
        hits = body.select("__tm_k1", "__tm_k2", F.explode(F.concat(*arrays)).alias("x")).select("__tm_k1", "__tm_k2", "x.width", "x.h")
        hits = hits.join(index, ["width", "h"])
    else:
        hits = body.select("__tm_k1", "__tm_k2", F.explode(arrays[0]).alias("h")).join(index.drop("width"), "h")
    pairs = hits.select("__tm_k1", "__tm_k2", "i", "h").distinct().groupBy("__tm_k1", "__tm_k2", "i").agg(F.count(F.lit(1)).alias("n"))
    sizes = known.select("i", "width", "scale", F.size("sketch").alias("sketch_size"))
    # a whole sketch tells the containment; a hash too few is allowed for two shingles of one hash
    enough = (F.col("scale") > 0) | (F.col("n") >= F.ceil(F.lit(containment) * F.col("sketch_size")) - 1)
    return pairs.join(sizes, "i").where(enough).select("__tm_k1", "__tm_k2", "i", "width")


def verified(docs: DataFrame, known: DataFrame, pairs: DataFrame, text: str, containment: float) -> DataFrame:
    """The ``pairs`` with ``share`` (exact containment) where it suffices."""
    keys = pairs.select("__tm_k1", "__tm_k2", "width").distinct()
    body = docs.where(quoted(text).isNotNull()).select(*text_key(quoted(text)), quoted(text).alias("t"))
    # all rows of one key have one text
    texts = body.join(keys.select("__tm_k1", "__tm_k2").distinct(), ["__tm_k1", "__tm_k2"], "semi").groupBy("__tm_k1", "__tm_k2").agg(F.max("t").alias("t"))
    own = texts.select("__tm_k1", "__tm_k2", settled(words_of(F.col("t"))).alias("w")).join(keys, ["__tm_k1", "__tm_k2"])
    own = own.select("__tm_k1", "__tm_k2", "width", F.explode(shingles(F.col("w"), F.col("width"))).alias("s"))
    asked = pairs.join(known.select("i", F.size("item_shingles").alias("size"), F.explode("item_shingles").alias("s")), "i")
    share = F.count(F.lit(1)) / F.first("size")
    return asked.join(own, ["__tm_k1", "__tm_k2", "width", "s"]).groupBy("__tm_k1", "__tm_k2", "i").agg(share.alias("share")).where(F.col("share") >= containment)


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(text).alias("__tm_k1"), F.xxhash64(F.lit(1), text).alias("__tm_k2")]


def decontaminate(
    df: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    containment: float = CONTAINMENT,
) -> DataFrame:
    """``df`` with ``items`` (ids of the benchmark items each text contains), ``containment`` and ``contaminated``."""
    outputs = ["items", "max_containment", "contaminated"]
    rest = without(df, outputs).columns
    scratch = Scratch(df.sparkSession, "decontamination")
    known = scratch.table(items_with_sketches(items, item_id, item_text).withColumn("i", F.monotonically_increasing_id()))
    pairs = scratch.table(candidates(df, known, text, containment))
    found = verified(df, known, pairs, text, containment).join(known.select("i", "item"), "i")
    verdicts = found.groupBy(F.col("__tm_k1").alias("v_k1"), F.col("__tm_k2").alias("v_k2")).agg(
        F.array_sort(F.collect_list(F.struct("item"))).alias("__tm_items"), F.max("share").alias("__tm_share")
    )
    verdicts = scratch.table(verdicts)
    k1, k2 = text_key(quoted(text))
    joined = df.withColumns({"__tm_k1": k1, "__tm_k2": k2}).join(verdicts, (F.col("__tm_k1") == F.col("v_k1")) & (F.col("__tm_k2") == F.col("v_k2")), "left")
    id_type = items.schema[item_id].dataType
    return joined.select(
        *[quoted(c) for c in rest],
        F.coalesce(F.transform("__tm_items", lambda x: x["item"]), F.array().cast(f"array<{id_type.simpleString()}>")).alias("items"),
        F.coalesce("__tm_share", F.lit(0.0)).alias("max_containment"),
        settled(F.col("__tm_share").isNotNull()).alias("contaminated"),
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", F.size("items").cast("long").alias("n_items"), F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("items"))


OP5_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), i AS (
  SELECT item_id, list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark WHERE text IS NOT NULL
), isize AS (
  SELECT item_id, w, least(len(w), {WIDTH}) AS width FROM i WHERE len(w) > 0
), ish AS (
  SELECT DISTINCT item_id, width, array_to_string(list_slice(w, k, k + width - 1), ' ') AS s
  FROM (SELECT item_id, width, w, unnest(range(1, len(w) - width + 2)) AS k FROM isize)
), dsh AS (
  SELECT DISTINCT rid, doc_id, width, array_to_string(list_slice(w, k, k + width - 1), ' ') AS s
  FROM (SELECT rid, doc_id, width, w, unnest(range(1, len(w) - width + 2)) AS k FROM d, (SELECT DISTINCT width FROM isize) WHERE len(w) >= width)
), hits AS (
  SELECT rid, doc_id, item_id, count(*) AS n FROM dsh JOIN ish USING (width, s) GROUP BY ALL
), sizes AS (
  SELECT item_id, count(*) AS n FROM ish GROUP BY item_id
), found AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id) AS items
  FROM hits JOIN sizes USING (item_id) WHERE hits.n / sizes.n >= {CONTAINMENT} GROUP BY rid
)
SELECT doc_id, f.rid IS NOT NULL AS contaminated, coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items, '') AS items FROM d LEFT JOIN found f ON d.rid = f.rid
"""
