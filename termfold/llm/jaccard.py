"""Exact Jaccard self-join on word shingles with set-relation skipping.

Documents with the same set are one class from the start. A class lists its rarest shingles (its prefix: all but the
share that a linked set must have in common) in an inverted index; rarity is that of a sketch of fixed size, counted
over all documents, and any order gives the same links. Index lists are kept by set size in blocks of positions:

* Index skipping. Between blocks, and between entries of a block, pairs are skipped when sizes are too far apart, when
  the positions leave too few shingles in common, or when bucket counts of the two sets differ by more than linked
  sets may differ. Entries without a partner of like size are dropped before anything else.
* Answer skipping. First every set of a block is compared with the most similar set only (a spanning forest by the
  bucket counts). A linked set takes over the answers of the set that it is linked with, its component so far;
  pairs within it are settled. The second time only pairs across components are compared, so copies and near copies,
  however many, are never expanded into pairs. What is left is compared in full: no link between components is lost.

Pairs are verified on the whole sets. Shingles are 64-bit hashes, classes 64-bit sums of them: two different sets fall
into one class by chance once in 4 billion documents. ``n`` words and ``percent`` are parameters.

Defined results: null text is empty; A-Z are lower-cased; fewer than n words are one shingle; a text without words has
an empty set, is linked with nothing and is its own component; component_id is the smallest doc_id reachable, null if
all are null; repeated rows are copies; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termfold.llm.components import components
from termfold.llm.shared import ship_package, sliced, table, tidy, unused_prefix
from termfold.operators.staging import mark, release, staged

WORDS, PERCENT = 3, 90
#: Rows that a task remembers so as to pass each once.
SEEN = 1_000_000
#: Counters of the sketch of shingle frequencies (4 bytes each), and those sent in one row.
SKETCH, SKETCH_PART = 1 << 20, 1 << 13
#: Bucket counts kept of each set.
BUCKETS = 128
#: Bits of the filter that names the sets needed for verification.
FILTER_BITS, FILTER_PART = 1 << 23, 1 << 16
#: Entries of a list in one block, and those that a block repeats from the one before.
BLOCK, OVERLAP = 1024, 16

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def shingles(text: bytes, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of n words."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return np.zeros(0, _U)
    h = np.fromiter(map(xxh64_intdigest, words), _U, len(words))
    few = len(h) < n
    m = 1 if few else len(h) - n + 1
    with np.errstate(over="ignore"):
        out = h[:m] ^ _U(0xA5A5A5A5 + len(h) if few else 0)
        for k in range(1, len(h) if few else n):
            out = _mix(out * _U(0x9E3779B97F4A7C15) + h[k : k + m])
    return np.unique(out)


def _class_of(s: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int((_mix(s + _U(0x51ED270B)).sum(dtype=_U) + _U(len(s))).astype(np.int64))


def _buckets(s: np.ndarray) -> bytes:
    return np.minimum(np.bincount((s >> _U(40)).astype(np.int64) % BUCKETS, minlength=BUCKETS), 255).astype(np.uint8).tobytes()


def common_needed(a, b, percent: int):
    """Least intersection of linked sets with sizes a and b: 100 i >= percent (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


@tidy
def _scan(batches, n: int):
    """A row per document (kind 0); at the end the partition's sketch (kind 1), each different set counted once."""
    seen: set[int] = set()
    sketch = np.zeros(SKETCH, np.int64)
    for b in sliced(batches):
        ids, sizes, classes, buckets, held = b.column(0), [], [], [], []
        for t in b.column(1).cast(pa.binary()).to_pylist():
            s = shingles(t or b"", n)
            c = _class_of(s) if len(s) else None
            sizes.append(len(s))
            classes.append(c)
            fresh = c is not None and c not in seen
            buckets.append(_buckets(s) if fresh else None)
            if fresh:
                seen.add(c)
                held.append(s)
                if len(held) >= 512:
                    sketch += np.bincount((np.concatenate(held) & _U(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
                    held = []
        if held:
            sketch += np.bincount((np.concatenate(held) & _U(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
        k = b.num_rows
        yield _batch(SCAN, [[0] * k, ids, sizes, classes, buckets, [None] * k, [None] * k])
    parts = [(i, sketch[i * SKETCH_PART : (i + 1) * SKETCH_PART]) for i in range(SKETCH // SKETCH_PART)]
    parts = [(i, zlib.compress(p.astype("<u4").tobytes(), 1)) for i, p in parts if p.any()]
    k = len(parts)
    none = [None] * k
    yield _batch(SCAN, [[1] * k, none, none, none, none, [i for i, _ in parts], [p for _, p in parts]])


SCAN = "kind int, doc_id long, n_shingles long, class long, buckets binary, part int, data binary"
POSTING = "token long, class long, size int, pos int"
LISTED = "token long, block int, last boolean, lo int, hi int, classes array<long>, sizes binary, buckets binary"
_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}


def _batch(ddl: str, columns: list) -> pa.RecordBatch:
    fields = [x.split() for x in ddl.split(", ")]
    arrays = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, _KINDS[k]) for c, (_, k) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[f for f, _ in fields])


def _summed(key, frames: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(SKETCH_PART, np.int64)
    for x in frames["data"]:
        total += np.frombuffer(zlib.decompress(x), "<u4")
    return pd.DataFrame({"part": [key[0]], "data": [np.minimum(total, 2**32 - 1).astype("<u4").tobytes()]})


@tidy
def _postings(batches, n: int, percent: int, sketch):
    """The prefix of each different set: token, class, size and position."""
    counts, seen = sketch.value, set()
    for b in sliced(batches):
        tokens, classes, sizes, lengths = [np.zeros(0, np.int64)], [], [], []
        for t in b.column(0).cast(pa.binary()).to_pylist():
            s = shingles(t or b"", n)
            if not len(s) or (c := _class_of(s)) in seen:
                continue
            seen.add(c)
            p = len(s) - -(-percent * len(s) // 100) + 1
            rarity = counts[(s & _U(SKETCH - 1)).astype(np.int64)]
            classes.append(c)
            sizes.append(len(s))
            lengths.append(p)
            if 2 * p < len(s):                                   # the rest of the order is never asked for
                low = rarity <= np.partition(rarity, p - 1)[p - 1]
                s, rarity = s[low], rarity[low]
            tokens.append(s[np.lexsort((s, rarity))[:p]].view(np.int64))
        lengths = np.array(lengths, np.int64)
        places = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        yield _batch(POSTING, [
            pa.array(np.concatenate(tokens)), pa.array(np.repeat(np.array(classes, np.int64), lengths)),
            pa.array(np.repeat(np.array(sizes, np.int32), lengths)), pa.array(places.astype(np.int32)),
        ])


@tidy
def _partnered(batches, percent: int):
    """Entries that have another of like size in their list; rows come by token, size and class."""
    held = None
    for b in batches:
        got = [b.column(i).to_numpy() for i in range(4)]
        got = got if held is None else [np.concatenate([x, y]) for x, y in zip(held, got)]
        # the last entry waits for the next batch, with the one before it
        yield from _like(got, percent, 0 if held is None else 1, len(got[0]) - 1)
        held = [x[-2:] for x in got]
        if len(held[0]) == 1:
            held = [np.concatenate([[0], x]).astype(x.dtype) for x in held]
            held[2][0] = 0
    if held is not None:
        yield from _like(held, percent, 1, len(held[0]))


def _like(rows: list[np.ndarray], percent: int, first: int, end: int):
    token, cls, size, _ = rows
    near = (token[1:] == token[:-1]) & (percent * size[1:].astype(np.int64) <= 100 * size[:-1].astype(np.int64))
    keep = np.zeros(len(token), bool)
    keep[1:] |= near
    keep[:-1] |= near
    again = np.zeros(len(token), bool)                           # a class that several tasks listed
    again[1:] = (token[1:] == token[:-1]) & (cls[1:] == cls[:-1])
    keep &= ~again
    keep[:first] = False
    keep[end:] = False
    if keep.any():
        yield _batch(POSTING, [pa.array(x[keep]) for x in rows])


@tidy
def _listed(batches, size: int):
    """Lists cut into blocks; rows come by token, size and class, with bucket counts."""
    token, rows = None, []
    block = 0

    def out(last: bool):
        sizes = np.array([(r[1], r[2]) for r in rows], "<i4")
        return [token, block, last, rows[0][1], rows[-1][1], [r[0] for r in rows], sizes.tobytes(), b"".join(r[3] for r in rows)]

    pending = []
    for b in batches:
        for t, c, n, p, k in zip(*(b.column(i).to_pylist() for i in range(5))):
            if t != token:
                if len(rows) > 1 or block:
                    pending.append(out(True))
                token, rows, block = t, [], 0
            if len(rows) >= size:
                pending.append(out(False))
                rows, block = rows[-OVERLAP:], block + 1
            rows.append((c, n, p, k))
        yield _batch(LISTED, list(map(list, zip(*pending))) if pending else [[]] * 8)
        pending = []
    if len(rows) > 1 or block:
        yield _batch(LISTED, [[x] for x in out(True)])


class _Block:
    def __init__(self, classes: list[int], sizes: bytes, buckets: bytes):
        self.classes = np.array(classes, np.int64)
        both = np.frombuffer(sizes, "<i4").reshape(-1, 2).astype(np.int64)
        self.size, self.pos = both[:, 0], both[:, 1]
        self.buckets = np.frombuffer(buckets, np.uint8).reshape(len(self.classes), BUCKETS).astype(np.int16)

    def possible(self, i: int, other: "_Block", percent: int) -> tuple[np.ndarray, np.ndarray]:
        """(whether entry i may be linked with each of the other block, the least number by which the sets differ)."""
        a, b = self.size[i], other.size
        need = common_needed(a, b, percent)
        left = 1 + np.minimum(a - 1 - self.pos[i], b - 1 - other.pos)
        may = (percent * np.maximum(a, b) <= 100 * np.minimum(a, b)) & (left >= need)
        apart = np.full(len(b), 1 << 30, np.int64)
        at = np.flatnonzero(may)
        apart[at] = np.abs(other.buckets[at] - self.buckets[i]).sum(1)
        may &= apart <= a + b - 2 * need
        apart[~may] = 1 << 30
        return may, apart


@tidy
def _forests(batches, percent: int):
    """Per block, every set with the most similar one: a spanning forest of the possible links."""
    done: set[tuple[int, int]] = set()
    for b in batches:
        out = []
        for classes, sizes, buckets in zip(*(b.column(i).to_pylist() for i in range(3))):
            x = _Block(classes, sizes, buckets)
            m = len(x.classes)
            best, source = np.full(m, 1 << 30, np.int64), np.zeros(m, np.int64)
            inside = np.zeros(m, bool)
            i = 0
            for _ in range(m):
                inside[i] = True
                if best[i] < 1 << 30:
                    pair = tuple(sorted((int(x.classes[i]), int(x.classes[source[i]]))))
                    if pair[0] != pair[1] and pair not in done:
                        done.add(pair)
                        out.append(pair)
                _, apart = x.possible(i, x, percent)
                nearer = ~inside & (apart < best)
                best[nearer], source[nearer] = apart[nearer], i
                i = int(np.where(inside, 1 << 31, best).argmin())
        yield _batch("a long, b long", [[p for p, _ in out], [q for _, q in out]])


@tidy
def _across(batches, percent: int):
    """Possible links of entries in different components, within a block or between two."""
    done: set[tuple[int, int]] = set()
    for batch in batches:
        out = []
        for classes, sizes, buckets, roots, classes2, sizes2, buckets2, roots2 in zip(*(batch.column(i).to_pylist() for i in range(8))):
            x, rx = _Block(classes, sizes, buckets), _roots(classes, roots)
            same = classes2 is None
            y, ry = (x, rx) if same else (_Block(classes2, sizes2, buckets2), _roots(classes2, roots2))
            for i in range(len(x.classes)):
                other = ry != rx[i]
                if same:
                    other[: i + 1] = False
                if not other.any():
                    continue
                may, _ = x.possible(i, y, percent)
                for c in y.classes[may & other].tolist():
                    pair = tuple(sorted((int(x.classes[i]), c)))
                    if pair not in done:
                        done.add(pair)
                        out.append(pair)
        yield _batch("a long, b long", [[p for p, _ in out], [q for _, q in out]])


def _roots(classes: list[int], roots: list) -> np.ndarray:
    known = {r["class"]: r["root"] for r in roots}
    return np.array([known[c] for c in classes], np.int64)


@tidy
def _filter_parts(batches):
    """Bits of the classes of a partition."""
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for b in batches:
        h = (_mix(b.column(0).to_numpy().view(_U)) & _U(FILTER_BITS - 1)).astype(np.int64)
        np.bitwise_or.at(bits, h >> 3, (1 << (h & 7)).astype(np.uint8))
    parts = [(i, bits[i * FILTER_PART : (i + 1) * FILTER_PART]) for i in range(len(bits) // FILTER_PART)]
    parts = [(i, p.tobytes()) for i, p in parts if p.any()]
    yield _batch("part int, data binary", [[i for i, _ in parts], [p for _, p in parts]])


def _either(key, frames: pd.DataFrame) -> pd.DataFrame:
    bits = np.zeros(FILTER_PART, np.uint8)
    for x in frames["data"]:
        bits |= np.frombuffer(x, np.uint8)
    return pd.DataFrame({"part": [key[0]], "data": [bits.tobytes()]})


def _wanted(values: np.ndarray, bits: np.ndarray) -> np.ndarray:
    h = (_mix(values.view(_U)) & _U(FILTER_BITS - 1)).astype(np.int64)
    return (bits[h >> 3] >> (h & 7)) & 1 == 1


@tidy
def _sets(batches, n: int, bits):
    """The sets of the classes that the filter names."""
    seen: set[int] = set()
    for b in sliced(batches):
        classes, sets = [], []
        for t in b.column(0).cast(pa.binary()).to_pylist():
            s = shingles(t or b"", n)
            if not len(s) or (c := _class_of(s)) in seen or not _wanted(np.array([c], np.int64), bits.value)[0]:
                continue
            seen.add(c)
            classes.append(c)
            sets.append(s.tobytes())
        yield _batch("class long, tokens binary", [classes, sets])


@tidy
def _verified(batches, percent: int):
    for b in sliced(batches):
        out = []
        for a, c, x, y in zip(*(b.column(i).to_pylist() for i in range(4))):
            x, y = np.frombuffer(x, _U), np.frombuffer(y, _U)
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= percent * (len(x) + len(y) - both):
                out.append((a, c))
        yield _batch("u long, v long", [[p for p, _ in out], [q for _, q in out]])


def _gathered(parts: DataFrame, whole: int, part: int, kind) -> np.ndarray:
    """An array of fixed size from its parts."""
    out = np.zeros(whole, kind)
    for r in parts.toPandas().itertuples():
        out[r.part * part : (r.part + 1) * part] = np.frombuffer(r.data, kind)
    return out


def _links(docs: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that are linked, compared on their whole sets."""
    spark = docs.sparkSession
    pairs = staged(pairs.distinct())
    named = pairs.select(F.explode(F.array("a", "b")).alias("c")).mapInArrow(_filter_parts, "part int, data binary")
    bits = _gathered(named.groupBy("part").applyInPandas(_either, "part int, data binary"), FILTER_BITS // 8, FILTER_PART, np.uint8)
    shared = spark.sparkContext.broadcast(bits)
    sets = staged(docs.select("text").mapInArrow(partial(_sets, n=n, bits=shared), "class long, tokens binary").dropDuplicates(["class"]))
    left, right = sets.toDF("a", "x"), sets.toDF("b", "y")
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return staged(both.mapInArrow(partial(_verified, percent=percent), "u long, v long"))


def linked_classes(docs: DataFrame, n: int = WORDS, percent: int = PERCENT, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(rows, roots): doc_id, n_shingles and class of each document; node and root of the classes that are linked."""
    spark = docs.sparkSession
    ship_package(spark)
    since = mark()
    scan = staged(docs.select("doc_id", "text").mapInArrow(partial(_scan, n=n), SCAN))
    rows = scan.where("kind = 0").select("doc_id", "n_shingles", "class")
    sketch = _gathered(
        scan.where("kind = 1").select("part", "data").groupBy("part").applyInPandas(_summed, "part int, data binary"), SKETCH, SKETCH_PART, np.dtype("<u4")
    )
    shared = spark.sparkContext.broadcast(sketch)
    listed = (
        docs.select("text").mapInArrow(partial(_postings, n=n, percent=percent, sketch=shared), POSTING)
        .repartition("token").sortWithinPartitions("token", "size", "class")
        .mapInArrow(partial(_partnered, percent=percent), POSTING)
    )
    entries = staged(listed)
    buckets = scan.where("kind = 0 AND buckets IS NOT NULL").groupBy("class").agg(F.min("buckets").alias("buckets"))
    blocks = staged(
        entries.join(buckets, "class").select("token", "class", "size", "pos", "buckets")
        .repartition("token").sortWithinPartitions("token", "size", "class")
        .mapInArrow(partial(_listed, size=block), LISTED)
    )
    release(spark, since, keep=(scan, blocks))
    parts = ["classes", "sizes", "buckets"]
    first = _links(docs, blocks.select(*parts).mapInArrow(partial(_forests, percent=percent), "a long, b long"), n, percent)
    roots = staged(components(first))
    release(spark, since, keep=(scan, blocks, roots))

    entry = blocks.select("token", "block", F.explode("classes").alias("class")).join(
        roots.withColumnRenamed("node", "class"), "class", "left").select("token", "block", "class", F.coalesce("root", "class").alias("root"))
    entry = staged(entry)
    open_ = entry.groupBy("token").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi")).where("_lo <> _hi").select("token")
    known = entry.groupBy("token", "block").agg(F.collect_set(F.struct("class", "root")).alias("roots"))
    still = staged(blocks.join(open_, "token", "left_semi").join(known, ["token", "block"]))
    none = [F.lit(None).cast(still.schema[c].dataType).alias(f"{c}2") for c in [*parts, "roots"]]
    inside = still.select(*parts, "roots", *none)
    long_ = still.where(~F.col("last") | (F.col("block") > 0))
    a, b = long_.alias("a"), long_.alias("b")
    between = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.block") < F.col("b.block"))
                     & (percent * F.col("b.lo") <= 100 * F.col("a.hi"))).select(
        *[F.col(f"a.{c}").alias(c) for c in [*parts, "roots"]], *[F.col(f"b.{c}").alias(f"{c}2") for c in [*parts, "roots"]])
    across = inside.unionByName(between).mapInArrow(partial(_across, percent=percent), "a long, b long")
    second = _links(docs, across, n, percent)
    lifted = (
        second.join(roots.toDF("u", "ru"), "u", "left").join(roots.toDF("v", "rv"), "v", "left")
        .select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v"))
    )
    merged = staged(components(lifted))
    last = merged.toDF("root", "last")
    linked = staged(roots.join(last, "root", "left").select("node", F.coalesce("last", "root").alias("root")).union(merged))
    release(spark, since, keep=(rows, linked))
    return rows, linked


def join(docs: DataFrame, n: int = WORDS, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles and component_id of each document."""
    rows, roots = linked_classes(docs, n, percent, block)
    least = rows.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("least"))
    rooted = least.join(roots.toDF("class", "root"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    rooted = staged(rooted)
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = staged(rooted.join(ids, "root").select("class", "component_id"))
    some = rows.where(F.col("class").isNotNull()).join(of_class, "class").select("doc_id", "n_shingles", "component_id")
    empty = rows.where(F.col("class").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return some.union(empty)


def distinct_documents(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, that with the smallest doc_id (null last) and class, with all its columns.

    Rows are judged by doc_id and class: an id with several texts is several documents, and rows without an id go like
    others. Of rows with an id and no words one stays for each id; those without either can't be told apart, and all
    stay. Only rows that may go, named by a filter of fixed size, travel to be compared with the list of those that do.
    """
    spark = docs.sparkSession
    rows, roots = linked_classes(docs, n, percent)
    by_class = rows.where(F.col("class").isNotNull()).groupBy("class").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id")).alias("least"))
    rooted = staged(by_class.join(roots.toDF("class", "root"), "class", "left").withColumn("root", F.coalesce("root", "class")))
    by_root = rooted.groupBy("root").agg(F.sum("n").alias("_n"), F.min(F.struct("least", "class")).alias("stays")).where("_n > 1")
    several = staged(rooted.join(by_root, "root").select("class", F.col("stays.class").alias("_class"), F.col("stays.least.doc_id").alias("_id")))
    stays = (F.col("class") == F.col("_class")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    judged = rows.join(several, "class").select("doc_id", "class", stays.alias("stays")).distinct()
    wordless = rows.where(F.col("class").isNull() & F.col("doc_id").isNotNull()).groupBy("doc_id", "class").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    own = unused_prefix(docs.columns)
    asked_id, asked_class, of_class, stays = (own + c for c in ("asked_id", "asked_class", "of_class", "stays"))
    asked = staged(judged.unionByName(wordless.select("doc_id", "class", F.lit(True).alias("stays"))).toDF(asked_id, asked_class, stays))
    named = asked.where(F.col(asked_id).isNotNull()).select(F.col(asked_id).alias("_asked_id")).distinct().mapInArrow(_filter_parts, "part int, data binary")
    bits = spark.sparkContext.broadcast(
        _gathered(named.groupBy("part").applyInPandas(_either, "part int, data binary"), FILTER_BITS // 8, FILTER_PART, np.uint8))
    at = {"column": docs.columns.index("doc_id"), "text": docs.columns.index("text"), "n": n, "bits": bits, "added": of_class}
    clear = docs.mapInArrow(partial(_named, named=False, **at), docs.schema)
    unclear = docs.mapInArrow(partial(_named, named=True, **at), T.StructType([*docs.schema.fields, T.StructField(of_class, T.LongType())]))
    same = F.col("doc_id").eqNullSafe(F.col(asked_id)) & F.col(of_class).eqNullSafe(F.col(asked_class))
    stay = unclear.join(asked, same, "left").where(F.coalesce(stays, F.lit(True))).dropDuplicates(["doc_id", of_class])
    return clear.unionByName(stay.select(*docs.columns))


@tidy
def _named(batches, bits, column: int, text: int, n: int, named: bool, added: str):
    """Rows whose doc_id the filter names or that have none, with their class and each id and class once; or the others.

    Rows with neither id nor words are among the others.
    """
    seen: set[tuple] = set()
    for b in sliced(batches):
        ids = b.column(column)
        valid = np.array(ids.is_valid(), bool)
        hit = ~valid | _wanted(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), bits.value)
        classes: list[int | None] = [None] * b.num_rows
        places = np.flatnonzero(hit)
        for i, t in zip(places, b.column(text).cast(pa.binary()).take(pa.array(places)).to_pylist()):
            s = shingles(t or b"", n)
            classes[i] = _class_of(s) if len(s) else None
            hit[i] = valid[i] or len(s) > 0
        if not named:
            yield b.filter(pa.array(~hit))
            continue
        for i in np.flatnonzero(hit):
            key = (ids[i].as_py(), classes[i])
            hit[i] = key not in seen                             # one of them stays at most
            seen.add(key)
            if len(seen) > SEEN:                                 # repeats go later all the same
                seen.clear()
        more = pa.RecordBatch.from_arrays([*b.columns, pa.array(classes, pa.int64())], names=[*b.schema.names, added])
        yield more.filter(pa.array(hit))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))




ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM w),
sized AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n FROM sets),
each AS (SELECT doc_id, unnest(g) AS g FROM sets),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM each a JOIN each b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sized UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT sized.doc_id, n AS n_shingles, min(reach.b) AS component_id FROM sized JOIN reach ON reach.a = sized.doc_id GROUP BY 1, 2
"""
