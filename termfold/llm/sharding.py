"""Sharding by vector bin packing: bytes, words and rows are balanced jointly.

Equal texts are a group. A group is placed where the dot product of its load (bytes, words, rows, each as a share of a
shard's capacity) with the shard's residual capacity is highest, largest groups first.

What is placed one by one is bounded, whatever the input: groups with more than 1 / GRAIN of a shard in any measure
(3 x shards x GRAIN of them at most) and, of all others, BUNDLES bundles by their hash. Large groups are found without
grouping all texts: loads are summed by hash bucket first, and only buckets with that much load are grouped exactly.
A group beyond a whole shard, such as a text that a third of all rows have, is cut into pieces of measured
load, which share as few shards as they need; each copy goes to the piece of its row.

No text is shuffled: one scan gives a narrow table, placements are joined by broadcast, and slots come from counts
per partition and shard, so neither a hot text nor a hot id meets in one task.

Defined results: null text is empty (size 16); null and repeated ids are rows like any others; repeated rows are copies;
shards may stay empty if there are fewer groups; slots number a shard's rows in stored order; an empty table gives an
empty result. Two texts with one hash (1 pair in 10^19) would be placed together, which does no harm.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termfold.llm.shared import WORD, ship_package, table
from termfold.operators.coarsen import local_table
from termfold.operators.joins import lookup_join
from termfold.operators.staging import staged

SHARDS = 40
#: Bytes that a document takes besides its text.
OVERHEAD = 16
#: Groups with more than this part of a shard are placed by themselves.
GRAIN = 256
#: Hash buckets by which loads are summed first; bundles of the groups that are not placed by themselves.
BUCKETS, BUNDLES = 1 << 20, 1 << 14
#: Pieces into which a group that exceeds a shard is cut for each shard's worth of it (3 x shards x PIECES at most in all).
PIECES = 64
#: Part of a shard that one such group takes at most, so that other documents even out the rest.
FILL = 0.75
LOADS = ["bytes", "words", "rows"]
#: How much each load counts in the dot product: bytes are the law, the others go with them.
WEIGHTS = (16.0, 1.0, 1.0)


def narrow(docs: DataFrame) -> DataFrame:
    """doc_id, bytes, words, rows (1), text_crc32, hash of the text, bucket, and a random number of the row: a written table."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return staged(
        docs.select("doc_id", text.alias("text")).select(
            "doc_id", (F.octet_length("text") + OVERHEAD).cast("long").alias("bytes"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
            F.lit(1).cast("long").alias("rows"), F.crc32("text").alias("text_crc32"), F.xxhash64("text").alias("hash"),
            F.xxhash64(F.monotonically_increasing_id()).alias("deal"),
        ).withColumn("bucket", F.pmod("hash", F.lit(BUCKETS)))
    )


def _piece():
    """Piece of a row whose group is cut into ``cut``; null for all others."""
    return F.pmod("deal", "cut")


def _sums() -> list:
    return [F.sum(c).alias(c) for c in LOADS]


def items(rows: DataFrame, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """What is to be placed: (kind, hash or bundle, piece, number of pieces) and loads as shares of a shard's capacity.

    kind 0 is a bundle, 1 a whole group, 2 a piece of a group beyond a shard.
    """
    buckets = staged(rows.groupBy("bucket").agg(*_sums()))
    total = buckets.agg(*_sums()).first()
    if total["rows"] is None:
        return np.empty((0, 4), np.int64), np.empty((0, 3))
    capacity = {c: max(1, total[c]) / shards for c in LOADS}
    beyond = lambda part: " OR ".join(f"{c} > {capacity[c] * part!r}D" for c in LOADS)
    full = buckets.where(beyond(1 / GRAIN)).select("bucket")               # 3 x shards x GRAIN rows at most
    large = staged(rows.join(F.broadcast(full), "bucket").groupBy("hash", "bucket").agg(*_sums()).where(beyond(1 / GRAIN)))
    most = F.greatest(*[F.col(c) / capacity[c] for c in LOADS])
    over = large.where(beyond(1.0)).select("hash", F.ceil(most * PIECES).alias("cut"))     # 3 x shards rows at most
    pieces = rows.join(F.broadcast(over), "hash").groupBy("hash", "cut", _piece().alias("piece")).agg(*_sums())
    bundle = (F.col("bucket") % BUNDLES).alias("bundle")
    minus = large.select("bucket", *[(-F.col(c)).alias(c) for c in LOADS])
    bundles = buckets.select("bucket", *LOADS).unionByName(minus).groupBy(bundle).agg(*_sums()).where("rows > 0")
    whole = large.where(f"NOT ({beyond(1.0)})")
    zero = F.lit(0).cast("long")
    found = (
        bundles.select(F.lit(0).alias("kind"), F.col("bundle").alias("id"), zero.alias("piece"), zero.alias("cut"), *LOADS)
        .unionByName(whole.select(F.lit(1).alias("kind"), F.col("hash").alias("id"), zero.alias("piece"), zero.alias("cut"), *LOADS))
        .unionByName(pieces.select(F.lit(2).alias("kind"), F.col("hash").alias("id"), "piece", "cut", *LOADS))
    ).collect()
    found.sort(key=lambda r: tuple(r)[:3])
    keys = np.array([tuple(r)[:4] for r in found], np.int64).reshape(-1, 4)
    return keys, np.array([[r[c] / capacity[c] for c in LOADS] for r in found])


def pack(keys: np.ndarray, loads: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each item: where the dot product with the residual capacity is highest, ties to the first shard.

    Items come by bytes or words, whichever is the larger share, so that short texts even out the end. Pieces of one group come first, and share as few shards as leave FILL of each to it at most: one piece after the
    other goes to the group's shard until it holds an even part.
    """
    residual = np.ones((shards, loads.shape[1]))
    out, weights = np.zeros(len(keys), np.int64), np.array(WEIGHTS)
    order = np.lexsort((keys[:, 2], keys[:, 1], -loads[:, 2], -loads[:, :2].max(axis=1)))

    def place(i: int, at: int | None = None) -> int:
        at = int(np.argmax(residual @ (loads[i] * weights))) if at is None else at
        residual[at] -= loads[i]
        out[i] = at
        return at

    for group in np.unique(keys[keys[:, 0] == 2, 1]):
        mine = np.flatnonzero((keys[:, 0] == 2) & (keys[:, 1] == group))
        even = loads[mine].sum(axis=0).max()
        even /= max(1, min(np.ceil(even / FILL), shards))
        at, held = None, 0.0
        for i in mine[np.argsort(keys[mine, 2])]:
            if at is not None and held + loads[i].max() / 2 > even:
                at, held = None, 0.0
            at = place(i, at)
            held += loads[i].max()
    for i in order[keys[order, 0] != 2]:
        place(i)
    return out


def placed(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``rows`` of ``narrow`` with their shard."""
    spark = rows.sparkSession
    keys, loads = items(rows, shards)
    at = pack(keys, loads, shards)

    def mapping(kind: int, *names: str) -> DataFrame:
        mine = keys[:, 0] == kind
        every = dict(zip(("id", "_piece", "cut", "shard"), (*keys[mine, 1:].T.tolist(), at[mine].tolist())))
        return local_table(spark, {"_bit_" + k: v for k, v in every.items()}).select(
            *[F.col("_bit_" + k).alias(n) for k, n in zip(("id", "shard", "_piece", "cut"), names)])

    pieces = mapping(2, "hash", "_piece_shard", "_piece", "cut")
    cuts = pieces.select("hash", "cut").distinct()
    pieces, groups, bundles = pieces.drop("cut"), mapping(1, "hash", "_group_shard"), mapping(0, "_bundle", "_bundle_shard")
    return (
        rows.withColumn("_bundle", F.col("bucket") % BUNDLES)
        .join(F.broadcast(cuts), "hash", "left").withColumn("_piece", _piece())
        .join(F.broadcast(pieces), ["hash", "_piece"], "left")
        .join(F.broadcast(groups), "hash", "left")
        .join(F.broadcast(bundles), "_bundle", "left")
        .withColumn("shard", F.coalesce("_piece_shard", "_group_shard", "_bundle_shard").cast("int"))
        .select(*rows.columns, "shard")
    )


def _numbered(batches, shards: int, at: int):
    """Adds the partition, and each row's place among the partition's rows of its shard."""
    part, seen = TaskContext.get().partitionId(), np.zeros(shards, np.int64)
    for b in batches:
        shard = b.column(at).to_numpy(zero_copy_only=False)
        order = np.argsort(shard, kind="stable")
        counts = np.bincount(shard, minlength=shards)
        local = np.empty(len(shard), np.int64)
        local[order] = np.arange(len(shard)) - np.repeat(np.cumsum(counts) - counts, counts)
        local += seen[shard]
        seen += counts
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(shard), part, np.int64)), pa.array(local)], names=[*b.schema.names, "_part", "_local"])


def slotted(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Adds slot, gapless from 0 in each shard: the place in the partition plus the rows of partitions before."""
    wide = rows.select("*", F.lit(0).cast("long").alias("_part"), F.lit(0).cast("long").alias("_local"))
    local = staged(rows.mapInArrow(partial(_numbered, shards=shards, at=rows.columns.index("shard")), wide.schema))
    counts = staged(local.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n")))     # a row per shard and partition
    before = F.sum("_n").over(Window.partitionBy("shard").orderBy("_part")) - F.col("_n")
    offsets = counts.select("shard", "_part", before.alias("_before"))
    return lookup_join(local, offsets, ["shard", "_part"]).withColumn("slot", F.col("_local") + F.col("_before")).select(*rows.columns, "slot")


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, bytes, words, text_crc32, hash, shard and slot of every document."""
    ship_package(docs.sparkSession)
    rows = slotted(placed(narrow(docs), shards), shards)
    return rows.select("doc_id", "bytes", "words", "text_crc32", "hash", "shard", "slot")


def op11_sharding(spark, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("bytes").alias("size"), F.col("text_crc32").cast("long").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "words",
    )
