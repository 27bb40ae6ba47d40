"""Approximate nearest neighbours with a hierarchical k-means tree.

The tree is fitted on a bounded sample (``sample`` vectors, chosen by a hash of the id) and has as many leaves as
keep about ``leaf_rows`` of all vectors in each. Every vector is sent down to its leaf. A query visits leaves
best bin first: a priority queue holds unopened branches by the distance to their centre. How many leaves to visit
is calibrated: ``CALIBRATION`` vectors outside the sample are answered exactly, by one scan of all vectors, and visits
are widened until the wanted recall is reached for these, with a margin; where the sample is the whole table, they are
vectors of the sample.

Leaves that lie together in the tree share a slot; a leaf with more rows than a slot should have is dealt over several. A
query goes once to each slot of its leaves. A task holds the queries of a slot (at most ``PART_BYTES`` of them, else they
are dealt over several parts) and takes the slot's vectors a few leaves at a time. A product of matrices with a bound on
its rounding error tells which vectors may be among a query's nearest; those are compared exactly, in double precision.
The nearest of each slot are merged per query. Results are in order of distance, then of vec_id.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor do rows
without vec_id; vectors of another length than most are an error; repeated rows of one vec_id are each a
candidate for other queries, a query's own id never is, and of repeated query rows that with the smallest vector is
taken; with fewer candidates than k all are returned. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termfold.llm.shared import ship_package, sliced, table, tidy
from termfold.operators.staging import staged

K = 10
SAMPLE = 20_000
LEAF_ROWS = 256
BRANCHES = 16
#: Rows of a slot: with fewer, a task's queries cost more than its vectors.
SLOT_ROWS = 16_384
LEAST_SLOTS = 16
#: Bytes of a block of vectors, of the blocks that a task packs at a time, of the vectors it searches at a time, and
#: of the queries it holds.
BLOCK_BYTES = 256 << 10
PACKED_BYTES = 32 << 20
ROUND_BYTES = 16 << 20
PART_BYTES = 64 << 20
#: Queries packed together, and queries and vectors of one product of matrices.
QUERY_ROWS = 512
PRODUCT = (512, 1024)
#: Pairs compared exactly at a time, and rows given out at a time.
EXACT_ROWS = 16_384
GIVEN_ROWS = 65_536
RECALL = 0.95
CALIBRATION = 200
#: Most leaves of a tree, whatever the input: the tree goes to every task.
MOST_LEAVES = 20_000
ITERATIONS = 8


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and v (array of float as it is, else array of double) of the rows that take part."""
    v = F.col(column)
    if not _floats(vectors.select(v)):
        v = v.cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False))).select("vec_id", v.alias("v"))


def _kind(vectors: DataFrame) -> str:
    return "<f4" if _floats(vectors.select("v")) else "<f8"


def _floats(df: DataFrame) -> bool:
    kind = df.schema[-1].dataType
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)


class Tree:
    """Nodes in arrays: centres, children of each node (none: a leaf), number of each leaf."""

    def __init__(self, data: np.ndarray, leaves: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.centres, self.children, self.leaf = [data.mean(0)], [[]], [-1]
        open_ = [(-len(data), 0, np.arange(len(data)))]
        n = 1
        while n < leaves and open_:
            size, node, rows = heapq.heappop(open_)          # the fullest leaf is split next
            k = min(BRANCHES, leaves - n + 1, -size)
            parts = _kmeans(data, rows, k, rng) if k > 1 else []
            if len(parts) < 2:
                continue
            for part in parts:
                self.centres.append(data[part].mean(0))
                self.children.append([])
                self.leaf.append(-1)
                self.children[node].append(len(self.centres) - 1)
                heapq.heappush(open_, (-len(part), len(self.centres) - 1, part))
            n += len(parts) - 1
        self.centres = np.array(self.centres)
        ends = [i for i, c in enumerate(self.children) if not c]
        for number, i in enumerate(ends):
            self.leaf[i] = number
        self.leaves = len(ends)
        self.children = [np.array(c, np.int64) for c in self.children]
        self.ends = np.array(ends, np.int64)
        self.parent = np.zeros(len(self.centres), np.int64)
        self.levels, level = [], np.zeros(1, np.int64)
        while len(level):
            for i in level.tolist():
                self.parent[self.children[i]] = i
            level = np.concatenate([self.children[i] for i in level.tolist()]).astype(np.int64)
            self.levels.append(level)

    def in_order(self) -> list[int]:
        """Numbers of the leaves, those of one branch together."""
        out, todo = [], [0]
        while todo:
            node = todo.pop()
            todo += self.children[node].tolist()[::-1]
            if not len(self.children[node]):
                out.append(self.leaf[node])
        return out

    def assign(self, data: np.ndarray) -> np.ndarray:
        """Leaf of each vector: the nearest child at every level."""
        out = np.zeros(len(data), np.int64)
        todo = [(0, np.arange(len(data)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not len(kids):
                out[rows] = self.leaf[node]
                continue
            nearest = _distances(data[rows], self.centres[kids]).argmin(1)
            todo += [(kids[i], rows[nearest == i]) for i in np.unique(nearest)]
        return out

    def best_bins(self, query: np.ndarray):
        """Leaves in best-bin-first order."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not len(kids):
                yield self.leaf[node]
                continue
            far = ((self.centres[kids] - query) ** 2).sum(1)
            for d, k in zip(far.tolist(), kids.tolist()):
                heapq.heappush(queue, (d, k))


    def first_bins(self, queries: np.ndarray, visits: int) -> tuple[np.ndarray, np.ndarray]:
        """Row of the query and leaf, for the first ``visits`` leaves that ``best_bins`` opens for each of many queries.

        A leaf is opened once the furthest branch on its way is: those below the bound that so holds ``visits`` leaves are
        all opened, and only leaves behind the branch at the bound itself are put in order with a queue.
        """
        if visits >= self.leaves:
            return np.repeat(np.arange(len(queries)), self.leaves), np.tile(np.arange(self.leaves), len(queries))
        far = np.maximum(_distances(queries - self.centres[0], self.centres - self.centres[0]), 0.0)
        bound = np.full_like(far, -1.0)
        for level in self.levels:
            bound[:, level] = np.maximum(far[:, level], bound[:, self.parent[level]])
        reached = bound[:, self.ends]
        last = np.partition(reached, visits - 1, axis=1)[:, visits - 1]
        opened = reached <= last[:, None]
        for q in np.flatnonzero(np.count_nonzero(opened, axis=1) > visits).tolist():
            opened[q] = reached[q] < last[q]
            more = visits - np.count_nonzero(opened[q])
            at = (bound[q] == last[q]) & (bound[q][self.parent] < last[q])
            queue = [(far[q, node], node) for node in np.flatnonzero(at).tolist()]
            heapq.heapify(queue)
            while more:
                _, node = heapq.heappop(queue)
                kids = self.children[node]
                if not len(kids):
                    opened[q, self.leaf[node]] = True
                    more -= 1
                    continue
                for kid in kids[far[q, kids] <= last[q]].tolist():
                    heapq.heappush(queue, (far[q, kid], kid))
        return np.nonzero(opened)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances, good enough to choose a centre."""
    return (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)


def _kmeans(data: np.ndarray, rows: np.ndarray, k: int, rng) -> list[np.ndarray]:
    own = data[rows]
    centres = own[rng.choice(len(own), k, replace=False)]
    for _ in range(ITERATIONS):
        at = _distances(own, centres).argmin(1)
        centres = np.array([own[at == i].mean(0) if (at == i).any() else centres[i] for i in range(k)])
    at = _distances(own, centres).argmin(1)
    return [rows[at == i] for i in range(k) if (at == i).any()]


def calibrate(tree: Tree, data: np.ndarray, total: int, recall: float, k: int = K, queries: int = CALIBRATION) -> int:
    """Leaves to visit so that sample queries find ``recall`` of their nearest in the sample, which is the whole table.

    Half of the missing share is kept as a margin.
    """
    at = tree.assign(data)
    near = []
    for q in np.linspace(0, len(data) - 1, min(queries, len(data))).astype(np.int64).tolist():
        d = ((data - data[q]) ** 2).sum(1)
        d[q] = np.inf
        near.append((data[q], at[np.argsort(d, kind="stable")[: min(k, len(data) - 1)]]))
    return _visits(tree, near, recall)


def _visits(tree: Tree, near: list[tuple[np.ndarray, np.ndarray]], recall: float) -> int:
    """Leaves to visit, from queries and the leaves in which their true neighbours lie."""
    needed = []
    for query, leaves in near:
        wanted: dict[int, int] = {}
        for leaf in leaves.tolist():
            wanted[leaf] = wanted.get(leaf, 0) + 1
        for visit, leaf in enumerate(tree.best_bins(query) if wanted else (), 1):
            if leaf in wanted:
                needed += [visit] * wanted.pop(leaf)
                if not wanted:
                    break
    if not needed:
        return 1
    goal = recall + (1 - recall) / 2
    return int(np.sort(needed)[min(len(needed) - 1, int(np.ceil(goal * len(needed))) - 1)])


@tidy
def _true_leaves(batches, shared, kind: str, k: int):
    """Sample queries with the leaves and distances of their nearest in a task's vectors, but the queries' own rows."""
    tree, queries, own = shared.value
    none = np.zeros(len(queries), "<i4").tobytes()
    block = [(-1 - np.arange(len(queries))).astype("<i8").tobytes(), queries.astype(kind).tobytes(), none, np.arange(len(queries), dtype="<i4").tobytes()]
    nearest = Nearest([block], tree.centres[0], kind, k)
    for b in batches:
        data = _matrix(b.column(1), queries.shape[1], kind)[~np.isin(b.column(0).to_numpy(), own)]
        if len(data):
            leaves = tree.assign(data.astype(np.float64)).astype("<i8")
            nearest.search([(leaves.tobytes(), data.tobytes(), np.zeros(len(data), "<i4").tobytes())])
    yield from nearest.batches()


def calibrate_on(vectors: DataFrame, tree: Tree, ids: np.ndarray, queries: np.ndarray, recall: float, k: int = K) -> int:
    """``calibrate`` for a table beyond the sample: queries outside it, and their nearest of all vectors, by one scan.

    The centres were fitted on the sample, so its own vectors lie nearer to their centres than others do: by the
    sample alone too few leaves would seem to do.
    """
    shared = vectors.sparkSession.sparkContext.broadcast((tree, queries, ids))
    found = vectors.mapInArrow(partial(_true_leaves, shared=shared, kind=_kind(vectors), k=k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    rows = found.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k).select("query_id", "vec_id").collect()
    leaves: dict[int, list[int]] = {}
    for r in rows:
        leaves.setdefault(-1 - r.query_id, []).append(r.vec_id)
    return _visits(tree, [(queries[q], np.array(x)) for q, x in sorted(leaves.items())], recall)


def fit(spark: SparkSession, vectors: DataFrame, sample: int = SAMPLE, leaf_rows: int = LEAF_ROWS, recall: float = RECALL):
    """(tree, leaves to visit, share of each leaf, vectors) from a sample of at most about ``sample`` staged vectors.

    The tree is None for an empty table.
    """
    total = vectors.count()
    if not total:
        return None, 0, None, 0
    scale = 1 << 30
    share = min(scale, int(scale * sample / total))
    also = min(scale, share + share * CALIBRATION // sample)
    mark = F.pmod(F.xxhash64("vec_id"), F.lit(scale))
    got = vectors.where(mark < also).select("vec_id", "v", (mark >= share).alias("other")).toPandas()
    got = got.assign(key=[x.tobytes() for x in (np.asarray(v, np.float64) for v in got["v"])]).sort_values(["vec_id", "key"])
    other, got = got[got["other"]], got[~got["other"]]
    if not len(got):
        got = vectors.limit(1).toPandas()
    data = np.array(got["v"].tolist(), np.float64)
    leaves = int(min(MOST_LEAVES, max(1, total // leaf_rows), max(1, len(data) // 4)))
    tree = Tree(data, leaves)
    share = np.bincount(tree.assign(data), minlength=tree.leaves) / len(data)
    if len(data) == total:
        visits = calibrate(tree, data, total, recall)
    else:
        some = other if len(other) else got
        some = some.iloc[np.linspace(0, len(some) - 1, min(CALIBRATION, len(some))).astype(np.int64)]
        visits = calibrate_on(vectors, tree, some["vec_id"].to_numpy(), np.array(some["v"].tolist(), np.float64), recall)
    return tree, visits, share, total


class Slots:
    """Where each leaf is searched: its first slot, in how many slots its vectors lie, and its round in the slot."""

    def __init__(self, tree: Tree, share: np.ndarray, total: int, queries: int, width: int):
        # a slot costs a copy of its queries and a result of theirs: no more slots than keep these below the vectors
        self.slots = max(1, min(total // SLOT_ROWS, max(LEAST_SLOTS, total // (2 * max(1, queries)))))
        self.parts = max(1, -(-queries * width // PART_BYTES))
        self.first, self.copies, self.round = (np.zeros(tree.leaves, np.int64) for _ in range(3))
        most, rows = 1 / self.slots, max(1, ROUND_BYTES // width)
        slot, full, at = 0, 0.0, 0
        for leaf in tree.in_order():
            own = float(share[leaf])
            if full and full + own > 1.25 * most:
                slot, full, at = slot + 1, 0.0, 0
            self.first[leaf], self.round[leaf] = slot, at
            full += own
            if own > 1.25 * most:
                self.copies[leaf] = int(np.ceil(own / most))
                slot, full, at = slot + int(self.copies[leaf]), 0.0, 0
                continue
            self.copies[leaf] = 1
            at = int(full * total / rows)
        self.slots = slot + 1
        self.tasks = self.slots * self.parts


def _matrix(column: pa.Array, dims: int, kind: str) -> np.ndarray:
    """The vectors of a list column as the rows of a matrix."""
    lengths = pc.list_value_length(column)
    if other := [n for n in pc.unique(lengths).to_pylist() if n != dims]:
        raise ValueError(f"a vector has {other[0]} components, others have {dims}")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(kind, copy=False)


MEETING = "task int, kind int, round int, ids binary, data binary, leaves binary, places binary"


def _meeting(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32()] * 3 + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=[x.split()[0] for x in MEETING.split(", ")])


def _given(rows):
    """Packed rows as batches of a few megabytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(map(len, row[3:]))
        if size >= PACKED_BYTES // 4:
            yield _meeting(held)
            held, size = [], 0
    if held:
        yield _meeting(held)


@tidy
def _blocks(batches, shared, kind: str):
    """Vectors packed into blocks, a block's in leaves of one slot and round; each part of the queries gets them."""
    tree, slots, _ = shared.value
    dims = tree.centres.shape[1]
    at = np.zeros(tree.leaves, np.int64) + TaskContext.get().partitionId()

    def packed(held, least: int):
        for (slot, turn), parts in list(held.items()):
            if sum(x[1].nbytes for x in parts) < least:
                continue
            ids, data, leaves = (np.concatenate(x) for x in zip(*held.pop((slot, turn))))
            rows = max(1, BLOCK_BYTES // data[0].nbytes)
            for i in range(0, len(ids), rows):
                own = [x[i : i + rows].tobytes() for x in (ids, data, leaves)]
                for part in range(slots.parts):
                    yield (int(slot) * slots.parts + part, 1, int(turn), *own, b"")

    def rows():
        held: dict[tuple[int, int], list] = {}
        size = 0
        for b in batches:
            data = _matrix(b.column(1), dims, kind)
            leaf = tree.assign(data.astype(np.float64))
            order = np.argsort(leaf, kind="stable")
            ids, data, leaf = b.column(0).to_numpy()[order], data[order], leaf[order]
            there, start, count = np.unique(leaf, return_index=True, return_counts=True)
            number = np.arange(len(leaf)) - np.repeat(start, count)
            slot = slots.first[leaf] + (at[leaf] + number) % slots.copies[leaf]
            at[there] += count
            turn = slots.round[leaf]
            order = np.lexsort((turn, slot))
            ends = np.flatnonzero(np.diff(slot[order]) | np.diff(turn[order])) + 1
            for own in np.split(order, ends):
                if len(own):
                    held.setdefault((slot[own[0]], turn[own[0]]), []).append((ids[own].astype("<i8"), data[own], leaf[own].astype("<i4")))
            size += data.nbytes
            if size >= PACKED_BYTES:
                yield from packed(held, BLOCK_BYTES)
                size = sum(x[1].nbytes for parts in held.values() for x in parts)
                if size >= PACKED_BYTES // 2:
                    yield from packed(held, 0)
                    size = 0
        yield from packed(held, 0)

    yield from _given(rows())


@tidy
def _asked(batches, shared, kind: str):
    """The queries of each slot, packed, with the leaves that they visit there."""
    tree, slots, visits = shared.value
    dims = tree.centres.shape[1]

    def rows():
        for b in sliced(batches, QUERY_ROWS):
            if not b.num_rows:
                continue
            ids, data = b.column(0).to_numpy(), _matrix(b.column(1), dims, kind)
            query, leaf = tree.first_bins(data.astype(np.float64), visits)
            copies = slots.copies[leaf]
            number = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
            query, leaf = np.repeat(query, copies), np.repeat(leaf, copies)
            task = (slots.first[leaf] + number) * slots.parts + ids[query] % slots.parts
            order = np.lexsort((query, task))
            for own in np.split(order, np.flatnonzero(np.diff(task[order])) + 1):
                here, place = np.unique(query[own], return_inverse=True)
                yield (int(task[own[0]]), 0, 0, ids[here].astype("<i8").tobytes(), data[here].tobytes(),
                       leaf[own].astype("<i4").tobytes(), place.astype("<i4").tobytes())

    yield from _given(rows())


class Nearest:
    """The k nearest so far of a task's queries."""

    def __init__(self, blocks: list[tuple], centre: np.ndarray, kind: str, k: int):
        ids = np.concatenate([np.frombuffer(x[0], "<i8") for x in blocks])
        order = np.argsort(ids)
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        starts = np.cumsum([0] + [len(x[0]) // 8 for x in blocks])
        self.k, self.ids, self.centre, self.kind = k, ids[order], centre, kind
        self.raw = np.concatenate([np.frombuffer(x[1], kind).reshape(-1, len(centre)) for x in blocks])[order]
        leaves = np.concatenate([np.frombuffer(x[2], "<i4") for x in blocks])
        rows = back[np.concatenate([np.frombuffer(x[3], "<i4") + at for x, at in zip(blocks, starts)])].astype(np.int32)
        by_leaf = np.lexsort((rows, leaves))
        self.leaves, self.rows = leaves[by_leaf], rows[by_leaf]
        self.norm = np.concatenate([_norms(self._moved(self.raw[i : i + EXACT_ROWS])) for i in range(0, len(order), EXACT_ROWS)])
        # no vector yet: NaN, which comes after every distance
        self.score, self.found = np.full((len(order), k), np.nan), np.zeros((len(order), k), np.int64)
        self.most = np.full(len(order), np.inf)
        self.sides: dict[str, np.ndarray] = {}

    def _moved(self, data: np.ndarray) -> np.ndarray:
        return data.astype(np.float64) - self.centre

    def search(self, blocks: list[tuple]) -> None:
        """Takes in the vectors of some leaves."""
        ids = np.concatenate([np.frombuffer(x[0], "<i8") for x in blocks])
        raw = np.concatenate([np.frombuffer(x[1], self.kind).reshape(-1, len(self.centre)) for x in blocks])
        leaves = np.concatenate([np.frombuffer(x[2], "<i4") for x in blocks])
        kept = _needed(ids, raw, self.k)
        kept = kept[np.argsort(leaves[kept], kind="stable")]
        ids, raw, leaves = ids[kept], raw[kept], leaves[kept]
        moved = self._moved(raw)
        norm = _norms(moved)
        # single precision where its range allows, else double, else every pair is compared exactly
        longest = float(max(norm.max(), self.norm.max()))
        reach = longest * longest
        width = next((x for x in ("f4", "f8") if reach < float(np.finfo(x).max) / 1e6), None)
        side = None
        if width:
            if width not in self.sides:
                self.sides[width] = self._queries(width)
            with np.errstate(under="ignore"):
                side = np.concatenate([moved, -0.5 * (norm**2)[:, None]], axis=1).astype(width)
        own = np.searchsorted(self.ids, ids)
        own[(own == len(self.ids)) | (self.ids[np.minimum(own, len(self.ids) - 1)] != ids)] = -1
        ends = np.flatnonzero(np.diff(leaves)) + 1
        for start, end in zip([0, *ends.tolist()], [*ends.tolist(), len(ids)]):
            a, b = np.searchsorted(self.leaves, [leaves[start], leaves[start] + 1])
            for i in range(a, b, PRODUCT[0]):
                rows = self.rows[i : min(b, i + PRODUCT[0])]
                for j in range(start, end, PRODUCT[1]):
                    here = slice(j, min(end, j + PRODUCT[1]))
                    pairs = self._near(rows, side[here], norm[here].max(), own[here], width) if width else self._all(rows, ids[here])
                    for r, c in pairs:
                        self._take(r, ids[here][c], raw[here][c])

    def _queries(self, width: str) -> np.ndarray:
        out = np.ones((len(self.ids), len(self.centre) + 1), width)
        for i in range(0, len(out), EXACT_ROWS):
            out[i : i + EXACT_ROWS, :-1] = self._moved(self.raw[i : i + EXACT_ROWS])
        return out

    def _all(self, rows: np.ndarray, ids: np.ndarray):
        step = max(1, EXACT_ROWS // len(ids))
        for i in range(0, len(rows), step):
            r = rows[i : i + step]
            yield np.repeat(r, len(ids)), np.tile(np.arange(len(ids)), len(r))

    def _near(self, rows: np.ndarray, side: np.ndarray, longest: float, own: np.ndarray, width: str):
        """(rows of queries, places of vectors) that may be among the nearest: all that are, and few others.

        The square of a distance is |q|^2 - 2 (q x - |x|^2 / 2); the product is the bracket, and off by ``error`` at most.
        """
        value, norm = self.sides[width][rows] @ side.T, self.norm[rows]
        limit, dims = np.finfo(width), len(self.centre)
        error = (dims + 8) * (limit.eps * longest * (norm + longest) + limit.tiny)
        error += 2.0**-48 * (np.abs(self.centre).max() * dims + norm + longest) * (norm + longest)
        mine = np.flatnonzero(own >= 0)
        if len(mine):
            at = np.searchsorted(rows, own[mine])
            there = (at < len(rows)) & (rows[np.minimum(at, len(rows) - 1)] == own[mine])
            value[at[there], mine[there]] = -np.inf
        with np.errstate(invalid="ignore", over="ignore"):
            least = 0.5 * (norm**2 - self.most[rows] ** 2 * (1 + 1e-12)) - error
        free = np.flatnonzero(np.isinf(self.most[rows])) if value.shape[1] > 4 * self.k else np.zeros(0, np.int64)
        if len(free):
            least[free] = self._kth(value[free]) - 2 * error[free]
        near = np.flatnonzero((value >= _below(least, width)[:, None]).ravel())
        r = near // value.shape[1]
        many = np.flatnonzero(np.bincount(r, minlength=len(rows)) > 4 * self.k)
        if len(many):
            least[many] = np.maximum(least[many], self._kth(value[many]) - 2 * error[many])
            fine = value.ravel()[near] >= _below(least, width)[r]
            near, r = near[fine], r[fine]
        c = near - r * value.shape[1]
        for i in range(0, len(r), EXACT_ROWS):
            yield rows[r[i : i + EXACT_ROWS]], c[i : i + EXACT_ROWS]

    def _kth(self, value: np.ndarray) -> np.ndarray:
        return np.partition(value, -self.k, axis=1)[:, -self.k].astype(np.float64)

    def _take(self, rows: np.ndarray, ids: np.ndarray, raw: np.ndarray) -> None:
        """Compares pairs exactly and keeps the k nearest of each query."""
        with np.errstate(over="ignore"):
            score = np.sqrt(((raw.astype(np.float64) - self.raw[rows].astype(np.float64)) ** 2).sum(1))
        fine = np.flatnonzero((self.ids[rows] != ids) & (score <= self.most[rows]))
        if not len(fine):
            return
        rows, ids, score = rows[fine], ids[fine], score[fine]
        here = np.unique(rows)
        rows = np.concatenate([np.repeat(here, self.k), rows])
        ids = np.concatenate([self.found[here].ravel(), ids])
        score = np.concatenate([self.score[here].ravel(), score])
        order = np.lexsort((ids, score, rows))
        start = np.searchsorted(rows[order], here)
        best = order[(start[:, None] + np.arange(self.k)).ravel()]
        self.score[here], self.found[here] = score[best].reshape(-1, self.k), ids[best].reshape(-1, self.k)
        last = self.score[here, -1]
        self.most[here] = np.where(np.isnan(last), np.inf, last)

    def batches(self):
        for i in range(0, len(self.ids), max(1, GIVEN_ROWS // self.k)):
            here = slice(i, i + max(1, GIVEN_ROWS // self.k))
            there = ~np.isnan(self.score[here])
            yield _found(np.repeat(self.ids[here], there.sum(1)), self.found[here][there], self.score[here][there])


def _norms(data: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", under="ignore"):
        return np.sqrt((data**2).sum(1))


def _below(bound: np.ndarray, width: str) -> np.ndarray:
    return np.nextafter(bound.astype(width), -np.inf, dtype=width)


def _found(queries, ids, scores) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(queries, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.float64())],
                                      names=["query_id", "vec_id", "score"])


def _needed(ids: np.ndarray, raw: np.ndarray, k: int) -> np.ndarray:
    """Rows that can be among any query's k nearest: of equal vectors the smallest 2 k ids, of equal rows k.

    Equal vectors are equally near, so smaller ids come first; a query leaves out one id, its own.
    """
    words = np.ascontiguousarray(raw).view("<u4").reshape(len(raw), -1)
    odd = np.random.default_rng(5).integers(1, 1 << 62, words.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    mark = np.concatenate([(words[i : i + EXACT_ROWS] * odd).sum(1, dtype=np.uint64) for i in range(0, len(words), EXACT_ROWS)])
    if len(np.unique(mark)) == len(mark):
        return np.arange(len(mark))
    order = np.lexsort((ids, mark))
    start = np.concatenate([[True], mark[order][1:] != mark[order][:-1]])
    leader = order[np.flatnonzero(start)[np.cumsum(start) - 1]]
    if (words[order] != words[leader]).any():                  # two vectors of one mark
        return np.arange(len(mark))
    few = np.flatnonzero(_ranks(start | np.concatenate([[True], ids[order][1:] != ids[order][:-1]])) < k)
    marks = mark[order][few]
    rank = _ranks(np.concatenate([[True], marks[1:] != marks[:-1]]))
    return np.sort(order[few[rank < 2 * k]])


def _ranks(start: np.ndarray) -> np.ndarray:
    """Place of each row in its run, where runs begin at ``start``."""
    at = np.arange(len(start))
    return at - np.maximum.accumulate(np.where(start, at, 0))


@tidy
def _search(batches, shared, kind: str, k: int):
    """The k nearest of each query among the vectors of a task's slot: queries come first, then vectors round by round."""
    centre = shared.value[0].centres[0]
    asked, nearest, held, size, turn = [], None, [], 0, None
    for b in batches:
        for what, own, *block in zip(*(b.column(i).to_pylist() for i in range(6))):
            if what == 0:
                asked.append(block)
                continue
            if not asked and nearest is None:
                continue
            if nearest is None:
                nearest, asked = Nearest(asked, centre, kind, k), []
            if held and (own != turn or size >= 2 * ROUND_BYTES):
                nearest.search(held)
                held, size = [], 0
            turn, size = own, size + len(block[1])
            held.append(block)
    if held:
        nearest.search(held)
    if nearest is not None:
        yield from nearest.batches()


def search(vectors: DataFrame, queries: DataFrame, k: int = K, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query (both: vec_id, v)."""
    spark = vectors.sparkSession
    ship_package(spark)
    result = "query_id long, rank int, vec_id long, score double"
    kind = max(_kind(vectors), _kind(queries))
    width, v = (4, F.col("v")) if kind == "<f4" else (8, F.col("v").cast("array<double>"))
    vectors = staged(vectors.select("vec_id", v.alias("v")))
    tree, visits, share, total = fit(spark, vectors, recall=recall)
    if tree is None:
        return spark.createDataFrame([], result)
    asked = staged(queries.select("vec_id", v.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v")))
    slots = Slots(tree, share, total, asked.count(), width * tree.centres.shape[1])
    shared = spark.sparkContext.broadcast((tree, slots, visits))
    met = vectors.mapInArrow(partial(_blocks, shared=shared, kind=kind), MEETING).unionAll(
        asked.mapInArrow(partial(_asked, shared=shared, kind=kind), MEETING))
    found = met.repartitionById(slots.tasks, "task").sortWithinPartitions("kind", "round").drop("task").mapInArrow(
        partial(_search, shared=shared, kind=kind, k=k), "query_id long, vec_id long, score double"
    )
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable(table(spark, sf_dir, "embeddings"))
    return search(vectors, vectors.where(F.col("vec_id") % 100 == 0))
