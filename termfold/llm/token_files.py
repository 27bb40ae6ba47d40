"""Token-id files with keyed access through a minimal perfect hash.

Documents are put in ascending order of doc_id by ranges. A shard is a run of whole documents with about
``shard_ids`` ids (a longer document is a shard of its own): the raw ids as little-endian unsigned 32-bit integers,
the end of each document in them, and an index. The index is a minimal perfect hash over the shard's keys: levels
of bit arrays in which a set bit is a key's alone, its rank the key's slot; a slot stores a fingerprint of its key, the
key's first document and how many documents bear it. A lookup reads a few bits, one slot and the ids asked for,
whatever the shard's size. Shards are rows of a Parquet table, so any store that Spark reaches holds them; first and
last key of each row let a lookup skip the rest of the files.

Defined results: null text is empty, and its ids are the end id alone; documents without doc_id come first, outside of
the hash; repeated ids keep all their documents, in order of a hash of the text. An empty table writes no shard.
"""

from __future__ import annotations

import gc
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termfold.llm.bpe_tree import Words
from termfold.llm.library_words import LibraryWords, encode_column
from termfold.llm.shared import ship_package, table, tidy
from termfold.operators.staging import new_path

END_ID = 2
SHARD_IDS = 1 << 20
#: Words that a worker keeps encoded, twice.
KEPT_WORDS = 200_000
#: Bits of a level for each key that it is given.
ROOM = 1.6
LEVELS = 48
RANK_STEP = 64

SHARDS = (
    "part int, seq int, first_key long, last_key long, n_docs int, n_ids long, null_docs int, keys binary, "
    "payload binary, ends binary, sizes binary, bits binary, ranks binary, fingerprints binary, first_doc binary, copies binary"
)

_words: dict[str, Words] = {}


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of 64-bit numbers for each seed."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_mixed(keys, LEVELS + 1) >> np.uint64(32)).astype(np.uint32)


def build_index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sizes of the levels, their bits end to end) of a minimal perfect hash over distinct 64-bit keys."""
    sizes, levels, left = [], [], keys.view(np.uint64)
    for level in range(LEVELS):
        if not len(left):
            break
        size = max(64, int(len(left) * ROOM))
        spot = (_mixed(left, level) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(spot, minlength=size) == 1
        sizes.append(size)
        levels.append(alone)
        left = left[~alone[spot]]
    if len(left):
        raise ValueError("keys must be distinct")
    return np.array(sizes, np.int64), np.concatenate(levels) if levels else np.zeros(0, bool)


def slots(keys: np.ndarray, sizes: np.ndarray, bits: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Slot of each key, -1 for one that meets no set bit; others may meet a slot that is not theirs."""
    keys, out = keys.view(np.uint64), np.full(len(keys), -1, np.int64)
    open_, base = np.arange(len(keys)), 0
    for level, size in enumerate(sizes.tolist()):
        spot = base + (_mixed(keys[open_], level) % np.uint64(size)).astype(np.int64)
        hit = bits[spot]
        at = spot[hit]
        block = at // RANK_STEP
        within = bits[(block * RANK_STEP)[:, None] + np.arange(RANK_STEP)] & (np.arange(RANK_STEP) < (at % RANK_STEP)[:, None])
        out[open_[hit]] = ranks[block] + within.sum(1)
        open_, base = open_[~hit], base + size
        if not len(open_):
            break
    return out


def _padded(bits: np.ndarray) -> np.ndarray:
    return np.concatenate([bits, np.zeros(-len(bits) % RANK_STEP + RANK_STEP, bool)])


def shard_row(part: int, seq: int, keys: list, ids: list[np.ndarray]) -> dict:
    """One shard of documents in key order, nulls first."""
    nulls = sum(k is None for k in keys)
    known = np.array(keys[nulls:], np.int64)
    distinct, first, copies = np.unique(known, return_index=True, return_counts=True)
    sizes, bits = build_index(distinct)
    wide = _padded(bits)
    ranks = np.concatenate([[0], np.cumsum(wide.reshape(-1, RANK_STEP).sum(1))[:-1]])
    slot = slots(distinct, sizes, wide, ranks)
    order = np.argsort(slot)
    ends = np.cumsum([len(x) for x in ids]).astype("<i8")
    return {
        "part": part, "seq": seq, "first_key": int(known[0]) if len(known) else None, "last_key": int(known[-1]) if len(known) else None,
        "n_docs": len(keys), "n_ids": int(ends[-1]), "null_docs": nulls, "keys": known.astype("<i8").tobytes(),
        "payload": np.concatenate(ids).astype("<u4").tobytes(), "ends": ends.tobytes(),
        "sizes": sizes.astype("<i8").tobytes(), "bits": np.packbits(wide).tobytes(), "ranks": ranks.astype("<u4").tobytes(),
        "fingerprints": _fingerprint(distinct[order]).astype("<u4").tobytes(),
        "first_doc": (first[order] + nulls).astype("<u4").tobytes(), "copies": copies[order].astype("<u4").tobytes(),
    }


class Shard:
    """Keyed access to one shard."""

    def __init__(self, row: dict):
        get = lambda name, kind: np.frombuffer(row[name], kind)
        self.payload, self.ends, self.null_docs = row["payload"], get("ends", "<i8"), row["null_docs"]
        self.sizes, self.ranks = get("sizes", "<i8"), get("ranks", "<u4").astype(np.int64)
        self.bits = np.unpackbits(get("bits", np.uint8)).astype(bool)
        self.fingerprints, self.first, self.copies = get("fingerprints", "<u4"), get("first_doc", "<u4"), get("copies", "<u4")

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(keys, first document, number of documents) of those keys that are here."""
        slot = slots(keys, self.sizes, self.bits, self.ranks)
        here = slot >= 0
        here[here] = self.fingerprints[slot[here]] == _fingerprint(keys[here])
        return keys[here], self.first[slot[here]].astype(np.int64), self.copies[slot[here]].astype(np.int64)

    def document(self, n: int) -> tuple[int, bytes]:
        """(start in the shard, raw ids) of its n-th document."""
        start = int(self.ends[n - 1]) if n else 0
        return start, self.payload[4 * start : 4 * int(self.ends[n])]


def _encoder(path: str) -> Words:
    """Encodes with the library. Its pieces never cross white space, so each different word is encoded once."""
    if path not in _words:
        _words[path] = Words(LibraryWords(path), KEPT_WORDS)
    return _words[path]


@tidy
def _shards(batches, path: str, end_id: int, shard_ids: int):
    import os

    from pyspark import TaskContext

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    gc.disable()                       # nothing here is cyclic, and looking through a full cache takes a fifth of the time
    words, part, seq = _encoder(path), TaskContext.get().partitionId(), 0
    end = np.array([end_id], np.uint32)
    keys, ids, held = [], [], 0

    def flushed():
        nonlocal keys, ids, held, seq
        row = shard_row(part, seq, keys, ids)
        keys, ids, held, seq = [], [], 0, seq + 1
        return pa.RecordBatch.from_pylist([row], schema=_SCHEMA)

    for b in batches:
        for key, x in zip(b.column(0).to_pylist(), encode_column(words, b.column(1))):
            if keys and held + len(x) + 1 > shard_ids:
                yield flushed()
            keys.append(key)
            ids.append(np.concatenate([x, end]))
            held += len(x) + 1
    if keys:
        yield flushed()


_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
_SCHEMA = pa.schema([(n, _KINDS[k]) for n, k in (x.split() for x in SHARDS.split(", "))])


def write_token_files(docs: DataFrame, out: str, path: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> None:
    """Writes ``out``/shards, and ``out``/starts with the number of ids before each shard."""
    spark = docs.sparkSession
    ship_package(spark)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("_tie")]
    dealt = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("_tie"))
        .repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("doc_id", "text")
    )
    dealt.mapInArrow(partial(_shards, path=path, end_id=end_id, shard_ids=shard_ids), SHARDS).write.parquet(f"{out}/shards")
    shards = spark.read.schema(SHARDS).parquet(f"{out}/shards").select("part", "seq", "n_ids")
    whole = Window.orderBy("part")
    # one row per range: as many as there are ranges, a setting
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("_ids")).select("part", (F.sum("_ids").over(whole) - F.col("_ids")).alias("_before"))
    inside = Window.partitionBy("part").orderBy("seq")
    starts = shards.withColumn("_upto", F.sum("n_ids").over(inside) - F.col("n_ids")).join(parts, "part")
    starts.select("part", "seq", (F.col("_before") + F.col("_upto")).alias("shard_start")).write.parquet(f"{out}/starts")


def _read(batches):
    for b in batches:
        for row in b.to_pylist():
            shard = Shard(row)
            keys, first, copies = shard.find(np.unique(np.frombuffer(row["keys"], "<i8")))
            found = [(None, n) for n in range(shard.null_docs)]
            found += [(k, n) for k, f, c in zip(keys.tolist(), first.tolist(), copies.tolist()) for n in range(f, f + c)]
            yield _documents(shard, row, found)


def _documents(shard: Shard, row: dict, found: list) -> pa.RecordBatch:
    starts, raw = [], []
    for _, n in found:
        start, ids = shard.document(n)
        starts.append(start)
        raw.append(ids)
    return pa.RecordBatch.from_arrays(
        [pa.array([row["part"]] * len(found), pa.int32()), pa.array([row["seq"]] * len(found), pa.int32()),
         pa.array([k for k, _ in found], pa.int64()), pa.array(starts, pa.int64()),
         pa.array([len(x) // 4 for x in raw], pa.int64()), pa.array([zlib.crc32(x) for x in raw], pa.int64())],
        names=["part", "seq", "doc_id", "local_start", "n_tokens", "ids_crc32"],
    )


def read_documents(spark: SparkSession, out: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files, each found through its shard's index."""
    ship_package(spark)
    shards = spark.read.schema(SHARDS).parquet(f"{out}/shards")
    found = shards.mapInArrow(_read, "part int, seq int, doc_id long, local_start long, n_tokens long, ids_crc32 long")
    starts = spark.read.schema("part int, seq int, shard_start long").parquet(f"{out}/starts")
    return found.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("shard_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def _lookup(batches, keys):
    wanted = np.array(sorted(set(keys)), np.int64)
    for b in batches:
        rows = []
        for row in b.to_pylist():
            shard = Shard(row)
            for k, f, c in zip(*(x.tolist() for x in shard.find(wanted))):
                for n in range(f, f + c):
                    rows.append({"doc_id": k, "ids": np.frombuffer(shard.document(n)[1], "<u4").tolist()})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))]))


def lookup(spark: SparkSession, out: str, keys: list[int]) -> DataFrame:
    """doc_id and ids of the documents with the given keys; shards that cannot hold one are skipped by the scan.

    A fingerprint of 32 bits may let a key that is not there pass for another's once in 4 billion tries.
    """
    ship_package(spark)
    shards = spark.read.schema(SHARDS).parquet(f"{out}/shards")
    near = F.lit(False)
    for k in keys:
        near = near | ((F.col("first_key") <= k) & (F.col("last_key") >= k))
    return shards.where(near).mapInArrow(partial(_lookup, keys=list(keys)), "doc_id long, ids array<long>")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = new_path(spark)
    write_token_files(table(spark, sf_dir, "documents"), out, public_tokenizers.path("word_bpe_49k.json"))
    return read_documents(spark, out)
