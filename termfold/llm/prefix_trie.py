"""Trie of conversation prefixes, with count-min screening of prefix digests.

A prefix of d turns has a digest: the exclusive or of d hashes, each of a turn's place, role and text (2 x 64 bits; two
different prefixes meet by chance once in 10^38 pairs). Turns are put in order by ranges of (conversation, turn), and
places and digests are running values over them, so one conversation with a third of all turns is spread like the rest.

* Screening. Every task counts the digests it sees in a count-min sketch of counters 0, 1 and 2-or-more; sketches are
  merged slice by slice. The sketch never counts too low, so an estimate of one proves that a prefix belongs to a single
  conversation. Such tails are emitted where they are, and only their first turn asks for its parent.
* Exact grouping. What may be shared is grouped by digest, with map-side aggregation, and no row is expanded: a node
  knows its smallest member (its owner) and each node is counted for its owner alone. A conversation owns a chain of
  nodes down to its end, so sums over a subtree are sums over the members of what they own, less what the node's
  owner owns above it.
* Ends. Ids of the conversations that end in a node are sorted by ranges and joined to pieces in parallel; the hash of
  a node's pieces runs through them in order, with a piece in memory at a time.

``rebuilt`` puts conversations together from another's first turns, as the contract of op12 asks; ``trie`` takes any
table of (conv_id, depth, a, b, words, ends), made by ``turns`` for conversations as they are.

Defined results: null role or text is empty; turns are in order of turn (null first), role and a hash
of the text; rows without
conv_id take no part, as they belong to no conversation; repeated rows are repeated turns; an empty table gives an empty
result. The sketch has ``CELLS`` counters at most: beyond that size more prefixes count as possibly shared, which costs
shuffling and changes no result.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termfold.llm.running import running
from termfold.llm.shared import WORD, ship_package, table
from termfold.operators.joins import lookup_join
from termfold.operators.staging import staged

#: Counters in each of the sketch's rows at most, for each prefix, and in a slice of the sketch; number of rows.
CELLS, PER_PREFIX, SLICE, HASHES = 1 << 24, 4, 1 << 16, 3
#: Ids that one piece of a node's list of ends holds.
PIECE = 512
#: Conversations that share their first turns, and how many turns at most (less one).
BLOCK, SHARED = 20, 4


def contents(conversations: DataFrame) -> DataFrame:
    """Written rows conv_id, turn, role's and text's 128-bit hash (a, b), words of the text, and a number of the row."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    half = lambda at: F.conv(F.substring(digest, at, 16), 16, -10).cast("long")
    return staged(
        conversations.where(F.col("conv_id").isNotNull()).select(
            F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), half(1).alias("a"), half(17).alias("b"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
            F.monotonically_increasing_id().alias("row"), F.lit(1).cast("long").alias("one"),
        )
    )


def placed(conversations: DataFrame) -> DataFrame:
    """conv_id, at (place of the turn, from 0), a, b, words: a written table."""
    rows = running(contents(conversations), "conv_id", ["turn", "role", "a", "b", "row"], sums=["one"])
    return staged(rows.select("conv_id", (F.col("run_one") - 1).alias("at"), "a", "b", "words"))


def _sizes(rows: DataFrame, heads: int) -> DataFrame:
    """One row per conversation: n turns, and the first ``heads`` of them as a0, b0, w0, a1 ..."""
    firsts = [F.max(F.when(F.col("at") == i, F.col(c))).alias(f"{n}{i}") for i in range(heads) for n, c in (("a", "a"), ("b", "b"), ("w", "words"))]
    return rows.groupBy("conv_id").agg((F.max("at") + 1).alias("n"), *firsts)


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, a, b, words and ends of all turns, and a row of depth 0 for each conversation."""
    rows = placed(conversations)
    own = lookup_join(rows, _sizes(rows, 0), ["conv_id"])
    none = F.lit(0).cast("long")
    root = own.where("at = 0").select("conv_id", none.alias("depth"), none.alias("a"), none.alias("b"), none.alias("words"), F.lit(False).alias("ends"))
    return own.select("conv_id", (F.col("at") + 1).alias("depth"), "a", "b", "words", (F.col("at") + 1 == F.col("n")).alias("ends")).unionByName(root)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """The same of conversations that begin with the first turns of another one.

    Conversation c takes the first h turns of conversation c - c % 20 in place of its own, h = crc32(c) % 4.
    """
    rows = placed(conversations)
    sizes = staged(_sizes(rows, SHARED - 1))
    base = sizes.select(F.col("conv_id").alias("_base"), F.col("n").alias("_n"), *[c for c in sizes.columns if c[0] in "abw"])
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(SHARED)).cast("long")
    info = staged(
        sizes.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("_base")).join(base, "_base", "left")
        .withColumn("m", F.least("h", F.coalesce("_n", F.lit(0).cast("long"))))
        .withColumn("length", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    )
    taken = [F.struct(F.lit(i + 1).cast("long").alias("depth"), F.col(f"a{i}").alias("a"), F.col(f"b{i}").alias("b"), F.col(f"w{i}").alias("words")) for i in range(SHARED - 1)]
    none = F.lit(0).cast("long")
    root = F.struct(none.alias("depth"), none.alias("a"), none.alias("b"), none.alias("words"))
    begin = info.select("conv_id", "length", F.explode(F.slice(F.array(root, *taken), F.lit(1), (F.col("m") + 1).cast("int"))).alias("t")).select(
        "conv_id", "t.*", (F.col("t.depth") == F.col("length")).alias("ends"))
    own = lookup_join(rows, info.select("conv_id", "h", "m", "length"), ["conv_id"]).where(F.col("at") >= F.col("h"))
    depth = F.col("at") - F.col("h") + F.col("m") + 1
    return begin.unionByName(own.select("conv_id", depth.alias("depth"), "a", "b", "words", (depth == F.col("length")).alias("ends")))


# --- screening ---------------------------------------------------------------

def _cells(a: np.ndarray, b: np.ndarray, width: int) -> list[np.ndarray]:
    """A digest's counter in each row of the sketch."""
    a, b = a.view(np.uint64), b.view(np.uint64) | np.uint64(1)
    return [((a + np.uint64(i) * b) & np.uint64(width - 1)).astype(np.int64) + i * width for i in range(HASHES)]


def _column(b: pa.RecordBatch, name: str) -> np.ndarray:
    return b.column(b.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _sketched(batches, width: int):
    """Sketch of one partition, in slices: bits of counters that are at least one, and at least two."""
    once, twice = np.zeros(HASHES * width, bool), np.zeros(HASHES * width, bool)
    for b in batches:
        for cells in _cells(_column(b, "da"), _column(b, "db"), width):
            different, counts = np.unique(cells, return_counts=True)
            twice[different[(counts > 1) | once[different]]] = True
            once[different] = True
    size = min(SLICE, HASHES * width)
    for i in range(0, HASHES * width, size):
        if once[i : i + size].any():
            yield _slices([(i // size, np.packbits(once[i : i + size]).tobytes(), np.packbits(twice[i : i + size]).tobytes())])


def _slices(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
        names=["slice", "once", "twice"])


def _merged(batches):
    """Slices in order of their number, equal ones merged, one in memory at a time."""
    now = once = twice = None
    for b in batches:
        for i, x, y in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
            x, y = np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8)
            if i != now:
                if now is not None:
                    yield _slices([(now, once.tobytes(), twice.tobytes())])
                now, once, twice = i, x.copy(), y.copy()
            else:
                twice |= y | (once & x)
                once |= x
    if now is not None:
        yield _slices([(now, once.tobytes(), twice.tobytes())])


def sketch(digests: DataFrame, cells: int = CELLS) -> np.ndarray:
    """Bits of the sketch's counters that are two or more, of all rows (da, db)."""
    rows = max(1, digests.count())
    width = 1 << min(cells.bit_length() - 1, max(12, (PER_PREFIX * rows - 1).bit_length()))
    size = min(SLICE, HASHES * width)
    parts = digests.select("da", "db").mapInArrow(partial(_sketched, width=width), "slice long, once binary, twice binary")
    merged = parts.repartition("slice").sortWithinPartitions("slice").mapInArrow(_merged, parts.schema)
    out = np.zeros(HASHES * width // 8, np.uint8)
    for r in merged.select("slice", "twice").collect():           # a few MB, whatever the input
        out[r["slice"] * size // 8 :][: size // 8] = np.frombuffer(r["twice"], np.uint8)
    return out


def _screened(batches, bits):
    """Adds shared (may belong to several conversations) and top (first turn of a tail of one conversation)."""
    bits = bits.value
    width = len(bits) * 8 // HASHES

    def several(a, b):
        out = np.ones(len(a), bool)
        for cells in _cells(a, b, width):
            out &= ((bits[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1).astype(bool)
        return out

    for b in batches:
        depth = _column(b, "depth")
        shared = several(_column(b, "da"), _column(b, "db")) | (depth == 0)
        top = ~shared & (several(_column(b, "pa"), _column(b, "pb")) | (depth == 1))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shared), pa.array(top)], names=[*b.schema.names, "shared", "top"])


def prefixes(rows: DataFrame) -> DataFrame:
    """conv_id, depth, words, ends and the digests of each prefix (da, db) and of the one before (pa, pb)."""
    bound = lambda *c: F.when(F.col("depth") > 0, F.xxhash64(*c)).otherwise(F.lit(0).cast("long"))
    bounded = staged(rows.select("conv_id", "depth", "words", "ends",
                                 bound("depth", "a", "b").alias("ta"), bound("b", "a", "depth", F.lit(1)).alias("tb")))
    run = running(bounded, "conv_id", ["depth"], xors=["ta", "tb"])
    return run.select("conv_id", "depth", "words", "ends", F.col("run_ta").alias("da"), F.col("run_tb").alias("db"),
                      F.col("run_ta").bitwiseXOR(F.col("ta")).alias("pa"), F.col("run_tb").bitwiseXOR(F.col("tb")).alias("pb"))


def screened(rows: DataFrame, cells: int = CELLS) -> DataFrame:
    """The prefixes of ``rows`` with shared and top, as a written table."""
    spark = rows.sparkSession
    found = staged(prefixes(rows))
    bits = spark.sparkContext.broadcast(sketch(found.where("depth > 0"), cells))
    schema = found.select("*", F.lit(True).alias("shared"), F.lit(True).alias("top")).schema
    return staged(found.mapInArrow(partial(_screened, bits=bits), schema))


# --- ends --------------------------------------------------------------------

def _pieces(batches):
    """Ids of a node that stand next to each other, joined by commas: at most PIECE of them in a row."""
    key, first, held = None, None, []
    out: list[tuple] = []
    for b in batches:
        for da, db, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            if (da, db) != key or len(held) == PIECE:
                if held:
                    out.append((*key, first, ",".join(held)))
                key, first, held = (da, db), c, []
                if len(out) == PIECE:
                    yield _rows(out, "da long, db long, first long, ids string")
                    out = []
            held.append(str(c))
    if held:
        out.append((*key, first, ",".join(held)))
    if out:
        yield _rows(out, "da long, db long, first long, ids string")


def _hashed(batches):
    """SHA-256 of each node's pieces, which come in order."""
    key, state = None, None
    for b in batches:
        out = []
        for da, db, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3)):
            if (da, db) != key:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (da, db), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.as_buffer())
        if out:
            yield _rows(out, "da long, db long, sha string")
    if key is not None:
        yield _rows([(*key, state.hexdigest())], "da long, db long, sha string")


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], names=[n for n, _ in fields])


def ends_hashes(ends: DataFrame) -> DataFrame:
    """da, db and sha: SHA-256 of the sorted ids (conv_id) of each node, joined by commas."""
    by = ["da", "db", "conv_id"]
    pieces = ends.select(*by).repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(_pieces, "da long, db long, first long, ids string")
    return staged(pieces).repartition("da", "db").sortWithinPartitions("da", "db", "first").mapInArrow(_hashed, "da long, db long, sha string")


# --- trie --------------------------------------------------------------------

def _sha(c: Column) -> Column:
    return F.sha2(c.cast("string"), 256)


NO_ENDS = hashlib.sha256(b"").hexdigest()


def trie(rows: DataFrame, cells: int = CELLS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    ship_package(rows.sparkSession)
    all_ = screened(rows, cells)
    may, tails = all_.where("shared"), all_.where("NOT shared")
    key = ["da", "db"]
    nodes = staged(
        may.groupBy(*key).agg(
            F.min("conv_id").alias("owner"), F.min("depth").alias("depth"), F.min("pa").alias("pa"), F.min("pb").alias("pb"),
            F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
            F.sum(F.col("ends").cast("long")).alias("n_ends"), F.min(F.when(F.col("ends"), F.col("conv_id"))).alias("ending"),
        ).withColumn("saves", (F.col("n_convs") - 1) * F.col("words"))
    )
    asking = nodes.where("depth > 0").select(F.col("owner").alias("conv_id"), *key, "pa", "pb").unionByName(
        tails.where("top").select("conv_id", *key, "pa", "pb"))
    children = staged(asking.groupBy(F.col("pa").alias("da"), F.col("pb").alias("db")).agg(F.count(F.lit(1)).alias("n_children")))
    above = nodes.select(F.col("da").alias("pa"), F.col("db").alias("pb"), F.col("owner").alias("parent"))
    parents = staged(lookup_join(asking, above, ["pa", "pb"]).select("conv_id", *key, F.coalesce("parent", "conv_id").alias("parent_conv_id")))

    # what a conversation owns: tokens saved by its nodes, and one leaf if its end is a leaf of its own
    leaf = (F.col("n_convs") == F.col("n_ends")).cast("long")
    owned = nodes.select("owner", "saves", leaf.alias("leaf")).unionByName(
        tails.where("ends").select(F.col("conv_id").alias("owner"), F.lit(0).cast("long").alias("saves"), F.lit(1).cast("long").alias("leaf")))
    worth = owned.groupBy(F.col("owner").alias("conv_id")).agg(F.sum("saves").alias("own_saves"), F.sum("leaf").alias("own_leaves")).where(
        "own_saves > 0 OR own_leaves > 0")
    below = lookup_join(may.select(*key, "conv_id"), worth, ["conv_id"]).groupBy(*key).agg(
        F.coalesce(F.sum("own_saves"), F.lit(0)).alias("all_saves"), F.coalesce(F.sum("own_leaves"), F.lit(0)).alias("n_leaves"))
    chain = running(nodes.select(*key, "owner", "depth", "saves"), "owner", ["depth"], sums=["saves"]).select(
        *key, (F.col("run_saves") - F.col("saves")).alias("saved_above"))
    hashes = ends_hashes(may.where("ends"))

    exact = (
        nodes.join(below, key, "left").join(chain, key, "left").join(children, key, "left").join(hashes, key, "left")
        .join(parents.select(*key, F.col("conv_id").alias("owner"), "parent_conv_id"), [*key, "owner"], "left")
        .select(
            F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
            "n_leaves", (F.col("all_saves") - F.col("saved_above")).alias("saved_tokens"), F.coalesce("sha", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")

    def tail(rows: DataFrame, parent: Column) -> DataFrame:
        return rows.select(
            "conv_id", "depth", parent.alias("parent_conv_id"), one.alias("n_convs"), F.when(F.col("ends"), none).otherwise(one).alias("n_children"),
            one.alias("n_leaves"), none.alias("saved_tokens"), F.when(F.col("ends"), _sha(F.col("conv_id"))).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"),
        )

    tops = tails.where("top").join(parents, ["conv_id", *key])
    return exact.unionByName(tail(tails.where("NOT top"), F.col("conv_id"))).unionByName(tail(tops, F.col("parent_conv_id")))


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return trie(rebuilt(table(spark, sf_dir, "conversations")))


ORACLE = r"""
WITH RECURSIVE
t AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS at_, role, text FROM t),
ids AS (SELECT conv_id, COUNT(*) AS n FROM o GROUP BY conv_id),
crc AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS s, CAST(4294967295 AS BIGINT) AS c, 0 AS step FROM ids
  UNION ALL
  SELECT conv_id, s, CASE WHEN x % 2 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END, step + 1
  FROM (SELECT conv_id, s, step, CASE WHEN step % 8 = 0 THEN xor(c, CAST(ascii(s[step // 8 + 1]) AS BIGINT)) ELSE c END AS x
        FROM crc WHERE step < 8 * length(s))),
h AS (SELECT conv_id, xor(c, CAST(4294967295 AS BIGINT)) % 4 AS h, conv_id - conv_id % 20 AS base FROM crc WHERE step = 8 * length(s)),
r AS (
  SELECT h.conv_id, o.at_ AS d, role, text FROM h JOIN o ON o.conv_id = h.base AND o.at_ <= h.h
  UNION ALL
  SELECT h.conv_id, o.at_ - h.h + LEAST(h.h, COALESCE(b.n, 0)), role, text
  FROM h JOIN o ON o.conv_id = h.conv_id LEFT JOIN ids b ON b.conv_id = h.base WHERE o.at_ > h.h),
p AS (
  SELECT conv_id, 0 AS d, 0 AS words, '' AS path FROM ids
  UNION ALL
  SELECT conv_id, d, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')),
         md5(string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY d)) FROM r),
l AS (SELECT *, d = MAX(d) OVER (PARTITION BY conv_id) AS ends FROM p),
nodes AS (
  SELECT path, d, MIN(conv_id) AS owner, COUNT(*) AS n, MAX(words) AS w,
         string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS ends FROM l GROUP BY path, d),
up AS (SELECT v.path AS child, v.d AS child_d, v.n, v.w, a.path, a.d FROM nodes v JOIN p a ON a.conv_id = v.owner AND a.d <= v.d),
kids AS (SELECT path, d, COUNT(*) AS n_children FROM up WHERE d = child_d - 1 GROUP BY path, d),
sums AS (
  SELECT up.path, up.d, SUM((up.n - 1) * up.w) AS saved, SUM(CASE WHEN k.path IS NULL THEN 1 ELSE 0 END) AS leaves
  FROM up LEFT JOIN kids k ON k.path = up.child AND k.d = up.child_d GROUP BY up.path, up.d)
SELECT v.owner AS conv_id, CAST(v.d AS BIGINT) AS depth, a.owner AS parent_conv_id, CAST(v.n AS BIGINT) AS n_convs,
       CAST(COALESCE(k.n_children, 0) AS BIGINT) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, sha256(COALESCE(v.ends, '')) AS ends_sha256
FROM nodes v JOIN sums s USING (path, d) LEFT JOIN kids k USING (path, d)
LEFT JOIN up u ON u.child = v.path AND u.child_d = v.d AND u.d = v.d - 1
LEFT JOIN nodes a ON a.path = u.path AND a.d = u.d
"""
