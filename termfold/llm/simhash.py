"""Document fingerprints by SimHash, in DataFrame functions only.

Terms are pairs of adjacent words (the last word pairs with the end of the text); a longer pair weighs more, up to
4, and a repeated pair counts each time. Each term's 64-bit hash votes with its weight, for or against, on 64
bits. Votes are summed two bits to a long: 32 sums a document, 32 bits to each count, with map-side aggregation.

All fingerprints within a Hamming radius r are found with permuted block tables: 64 bits are cut into 2r blocks; two
fingerprints within r agree on at least r whole blocks, so every choice of r blocks is a table keyed by their
bits. Equal fingerprints are first collapsed into one row with its members counted.

Defined results: null text is empty; a text without words has fingerprint 0000000000000000; equal texts have equal
fingerprints. The next document is that with the next higher doc_id (null ids first, ties by a hash of the text);
the last document's is the first. A single document is its own next. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termfold.llm.shared import GAP, table
from termfold.operators.staging import staged

BITS = 64
LANES = 32
MASK = 0x0000000100000001
HEAVIEST = 4


def terms(text: Column) -> Column:
    """Array of (hash, weight), one for each pair of adjacent words."""
    words = F.filter(F.split(text, GAP, -1), lambda w: w != "")
    return F.zip_with(
        words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))),
        lambda a, b: F.struct(
            F.xxhash64(a, b).alias("h"),
            F.least(F.lit(HEAVIEST), 1 + F.shiftright(F.length(a) + F.coalesce(F.length(b), F.lit(0)), 3)).cast("long").alias("w"),
        ),
    )


def votes() -> list[Column]:
    """Aggregates over rows with columns h and w: total weight, and 32 sums that hold two bits' counts each."""
    lanes = [F.sum(F.shiftrightunsigned("h", s).bitwiseAND(F.lit(MASK)) * F.col("w")).alias(f"_v{s}") for s in range(LANES)]
    return [F.sum("w").alias("_w"), *lanes]


def fingerprint() -> Column:
    """64 bits as a long from the sums of ``votes``: a bit is set if more than half of the weight votes for it."""
    bits = F.lit(0).cast("long")
    for s in range(LANES):
        low = F.col(f"_v{s}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(f"_v{s}", 32)
        bits = bits.bitwiseOR(F.when(2 * low > F.col("_w"), F.lit(1 << s)).otherwise(F.lit(0)).cast("long"))
        top = s + 32
        value = (1 << top) if top < 63 else -(1 << 63)
        bits = bits.bitwiseOR(F.when(2 * high > F.col("_w"), F.lit(value)).otherwise(F.lit(0)).cast("long"))
    return F.coalesce(bits, F.lit(0).cast("long"))


def as_text(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1.0 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def fingerprints(rows: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys and ``bits`` (a long), for one row per distinct ``keys``."""
    exploded = rows.select(*keys, F.explode_outer(terms(F.coalesce(F.col(text), F.lit("")))).alias("t"))
    return (
        exploded.select(*keys, "t.h", "t.w").groupBy(*keys).agg(*votes()).select(*keys, fingerprint().alias("bits"))
    )


def near_fingerprints(prints: DataFrame, radius: int = 3) -> tuple[DataFrame, DataFrame]:
    """(pairs, members) of ``prints`` (doc_id, bits).

    pairs: a, b (a < b) and distance of all different fingerprints at most ``radius`` bits apart; members: each
    document with its fingerprint. Copies share a fingerprint and are not expanded into pairs.
    """
    if not 1 <= radius <= 8:
        raise ValueError("radius must be 1 to 8 bits")
    distinct = prints.groupBy("bits").agg(F.count(F.lit(1)).alias("documents"))
    blocks, edges = 2 * radius, [round(i * BITS / (2 * radius)) for i in range(2 * radius + 1)]
    masks = [sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in chosen) for chosen in combinations(range(blocks), radius)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    tables = F.array(*[F.struct(F.lit(i).alias("table"), F.col("bits").bitwiseAND(F.lit(m).cast("long")).alias("key")) for i, m in enumerate(signed)])
    listed = distinct.select("bits", F.explode(tables).alias("t")).select("bits", "t.table", "t.key")
    left, right = listed.withColumnRenamed("bits", "a"), listed.withColumnRenamed("bits", "b")
    pairs = (
        left.join(right, ["table", "key"])
        .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
        .select("a", "b").distinct()
        .withColumn("distance", F.bit_count(F.col("a").bitwiseXOR(F.col("b"))))
    )
    return pairs, prints.select("doc_id", "bits")


def _bucket(bounds: list, key: Column) -> Column:
    """How many of the sorted bounds are at most the key, by binary search; null keys come first."""
    if not bounds:
        return F.lit(0)
    steps = max(1, len(bounds).bit_length())
    listed = F.array(*[F.lit(b) for b in bounds])
    found = F.aggregate(
        F.array(*[F.lit(1 << k) for k in reversed(range(steps))]), F.lit(0),
        lambda n, step: F.when((n + step <= len(bounds)) & (F.get(listed, n + step - 1) <= key), n + step).otherwise(n),
    )
    return F.when(key.isNull(), F.lit(0)).otherwise(found)


def with_next(docs: DataFrame, buckets: int) -> DataFrame:
    """bucket, place, doc_id, text and next_text: neighbours by ascending doc_id.

    Documents are dealt into ranges of doc_id (bounds from a percentile sketch of all ids), each put in order by
    itself; the first document of the next range follows the last of a range.
    """
    spark = docs.sparkSession
    quantiles = [i / buckets for i in range(1, buckets)]
    row = docs.agg(F.percentile_approx("doc_id", F.lit(quantiles) if quantiles else F.lit([0.5]), F.lit(max(100, 20 * buckets)))).first()
    bounds = sorted(set(row[0] or [])) if quantiles else []
    keyed = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), _bucket(bounds, F.col("doc_id")).alias("bucket"),
    ).withColumn("h", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("h")]
    firsts = staged(
        keyed.groupBy("bucket").agg(F.min(F.struct(F.coalesce(F.col("doc_id").isNotNull(), F.lit(False)).alias("known"), "doc_id", "h")).alias("f"))
    )
    whole = Window.partitionBy()
    following = firsts.select(
        "bucket",
        F.coalesce(F.lead("f").over(whole.orderBy("bucket")), F.min(F.struct("bucket", "f")).over(whole)["f"]).alias("f"),
    ).select(F.col("bucket").alias("_of"), F.col("f.doc_id").alias("_id"), F.col("f.h").alias("_h"))
    # one row per range: as many as there are ranges, a setting
    beyond = (
        keyed.join(F.broadcast(following), keyed["doc_id"].eqNullSafe(F.col("_id")) & (keyed["h"] == F.col("_h")))
        .groupBy("_of").agg(F.min("text").alias("_beyond")).withColumnRenamed("_of", "bucket")
    )
    beyond = staged(beyond)
    w = Window.partitionBy("bucket").orderBy(*order)
    placed = keyed.select(
        "bucket", F.row_number().over(w).alias("place"), "doc_id", "text", F.lead("text").over(w).alias("_lead"),
    )
    return placed.join(beyond.hint("merge"), "bucket", "left").select(
        "bucket", "place", "doc_id", "text",
        F.coalesce("_lead", "_beyond").alias("next_text"), F.col("_lead").isNull().alias("at_end"),
    )


def compared(docs: DataFrame, buckets: int) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness.

    Edited text: the last floor(n_chars / 4) code points are replaced by the first as many of the next document.
    """
    paired = with_next(docs, buckets)
    n = F.length("text")
    part = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - part), F.substring("next_text", F.lit(1), part))
    ready = paired.select(
        "bucket", "place", "doc_id", n.cast("long").alias("n_chars"), "at_end", "text", "next_text", edited.alias("edited"),
    ).withColumn("edited_sha256", F.sha2(F.encode("edited", "UTF-8"), 256))
    keys = ["bucket", "place", "doc_id", "n_chars", "edited_sha256"]
    kinds = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("t")),
        F.struct(F.lit(1).alias("kind"), F.col("edited").alias("t")),
        # the last of a range is compared with a document of another range, fingerprinted here as well
        F.struct(F.lit(2).alias("kind"), F.when(F.col("at_end"), F.col("next_text")).alias("t")),
    )
    each = ready.select(*keys, F.explode(kinds).alias("x")).select(*keys, "x.kind", F.col("x.t").alias("t")).where("kind < 2 OR t IS NOT NULL")
    prints = fingerprints(each, [*keys, "kind"], "t")
    sides = prints.groupBy(*keys).agg(*[F.max(F.when(F.col("kind") == k, F.col("bits"))).alias(f"b{k}") for k in range(3)])
    w = Window.partitionBy("bucket").orderBy("place")
    following = F.coalesce(F.lead("b0").over(w), F.col("b2"))
    return sides.withColumn("bn", following).select(
        "doc_id", "n_chars", "edited_sha256",
        as_text(F.col("b0")).alias("fingerprint"), as_text(F.col("b1")).alias("edited_fingerprint"),
        likeness(F.col("b0"), F.col("b1")).alias("near_edited"), likeness(F.col("b0"), F.col("bn")).alias("near_next"),
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(table(spark, sf_dir, "documents"), int(spark.conf.get("spark.sql.shuffle.partitions")))
