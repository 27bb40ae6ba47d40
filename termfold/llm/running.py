"""Running sums by key over range-sorted partitions, for keys of any number of rows.

Rows are dealt by ranges of (key, order), so a long key spans several partitions and none is a task of its own. Each
partition sums up by itself; what a key brings from the partitions before follows from one row per partition.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termfold.llm.shared import ship_package
from termfold.operators.coarsen import local_table
from termfold.operators.staging import staged


def _run(values: np.ndarray, starts: np.ndarray, begun, combine: np.ufunc, undo: np.ufunc) -> np.ndarray:
    """Inclusive running values of segments that begin at ``starts``; the first goes on from ``begun``."""
    total = combine.accumulate(values)
    before = np.concatenate([[0], total[starts[1:] - 1]]).astype(values.dtype)
    offsets = np.repeat(before, np.diff(np.append(starts, len(values))))
    out = undo(total, offsets)
    first = starts[1] if len(starts) > 1 else len(values)
    out[:first] = combine(out[:first], begun)
    return out


def _local(key: str, sums: list[str], xors: list[str], batches):
    """Running values within one partition, its number and the place of each row in it."""
    part, at, last, carried = TaskContext.get().partitionId(), 0, None, {}
    for b in batches:
        if not b.num_rows:
            continue
        keys = b.column(b.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        goes_on = last is not None and keys[0] == last
        columns, names = list(b.columns), list(b.schema.names)
        for name, combine, undo in [(n, np.add, np.subtract) for n in sums] + [(n, np.bitwise_xor, np.bitwise_xor) for n in xors]:
            values = b.column(b.schema.get_field_index(name)).to_numpy(zero_copy_only=False).astype(np.int64)
            run = _run(values, starts, carried.get(name, np.int64(0)) if goes_on else np.int64(0), combine, undo)
            carried[name] = run[-1]
            columns.append(pa.array(run, pa.int64()))
            names.append("run_" + name)
        last = keys[-1]
        columns += [pa.array(np.full(b.num_rows, part, np.int64)), pa.array(np.arange(at, at + b.num_rows, dtype=np.int64))]
        at += b.num_rows
        yield pa.RecordBatch.from_arrays(columns, names=[*names, "_part", "_at"])


def running(rows: DataFrame, key: str, order: list[str], sums: list[str] = (), xors: list[str] = ()) -> DataFrame:
    """A written table: ``rows`` and, for each of ``sums`` and ``xors``, ``run_<name>`` up to and with the row.

    ``key`` and the values are long and not null. ``rows`` should be a written table, since range bounds are sampled from it.
    """
    ship_package(rows.sparkSession)
    sums, xors = list(sums), list(xors)
    runs = ["run_" + n for n in [*sums, *xors]]
    schema = T.StructType([*rows.schema.fields, *[T.StructField(n, T.LongType()) for n in [*runs, "_part", "_at"]]])
    by = [F.col(c).asc_nulls_first() for c in [key, *order]]
    local = staged(rows.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(partial(_local, key, sums, xors), schema))
    ends = local.groupBy("_part").agg(
        F.min(F.struct("_at", key))[key].alias("first"), F.max(F.struct("_at", F.col(key).alias("key"), *runs)).alias("last")
    ).orderBy("_part").collect()
    carried, now, at = [], None, [0] * len(runs)
    for e in ends:
        goes_on = e["first"] == now
        if goes_on:
            carried.append((e["_part"], now, *at))
        whole = goes_on and e["last"]["key"] == now            # the partition holds nothing but this key
        values = [e["last"][r] for r in runs]
        at = [_joined(a, v, i < len(sums)) for i, (a, v) in enumerate(zip(at, values))] if whole else values
        now = e["last"]["key"]
    if not carried:
        return local.drop("_part", "_at")
    table = local_table(rows.sparkSession, {
        n: [c[i] for c in carried] for i, n in enumerate(["_bit_part", "_bit_key", *["_bit_" + r for r in runs]])
    })
    joined = local.join(F.broadcast(table), (F.col("_part") == F.col("_bit_part")) & (F.col(key) == F.col("_bit_key")), "left")
    added = {
        r: F.col(r) + F.coalesce(F.col("_bit_" + r), F.lit(0)) if i < len(sums) else F.col(r).bitwiseXOR(F.coalesce(F.col("_bit_" + r), F.lit(0)))
        for i, r in enumerate(runs)
    }
    return joined.withColumns(added).select(*rows.columns, *runs)


def _joined(a: int, b: int, is_sum: bool) -> int:
    return a + b if is_sum else a ^ b
