"""Rows dealt once, in order, by range bounds that come from a sample of their keys.

A global sort samples its whole input, with every join and column, before it deals the rows. Here the bounds come
from the key columns alone, and a row's partition is an expression, so the rows are computed and shuffled once.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sorts before all other characters, so that texts compare as the values they are made of.
END = "\x00"
#: Sampled keys per partition; bounds that one step of the search compares with.
OVERSAMPLE, FAN = 40, 32
#: Rows that a partition should hold at least, where there are fewer partitions to fill than the session has.
PART_ROWS = 20_000


def order_text(*parts: Column) -> Column:
    """One text that sorts as its parts do; NULL as empty text."""
    return F.concat_ws(END, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def parts_for(spark, rows: int) -> int:
    """Partitions for so many rows: those of the session, fewer for few rows."""
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // PART_ROWS)))


def bounds(keys: DataFrame, rows: int, parts: int) -> list[str]:
    """At most ``parts`` - 1 texts that cut the ``_order`` of ``keys`` into parts of about equal ``_weight``.

    About OVERSAMPLE rows a part are drawn and counted by key, which bounds what the driver gets. A key that is heavier
    than a part is cut by the salt that ``salted`` puts behind it.
    """
    if parts < 2:
        return []
    every = max(1, rows // (parts * OVERSAMPLE))
    drawn = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(every)) == 0
    sample = keys.where(drawn).groupBy("_order").agg(F.sum("_weight").alias("w"))
    found = sorted((r["_order"], r["w"]) for r in sample.collect())
    total, before, out = sum(w for _, w in found), 0, []
    for text, w in found:
        first, last = -(-before * parts // total), (before + w) * parts // total
        for i in range(first, min(last, parts - 1) + 1):
            cut = (i * total / parts - before) / w if i else 0        # share of this key's rows that lie below the cut
            if i and cut < 1:
                out.append(text + END + f"{min(int(cut * (1 << 32)), (1 << 32) - 1):08x}")
        before += w
    return sorted(set(out))


def salted(text: Column, columns: list[str]) -> Column:
    """The text with a salt from the row and its partition, which a repeated task draws again."""
    salt = F.lpad(F.lower(F.hex(F.pmod(F.xxhash64(F.spark_partition_id(), *columns), F.lit(1 << 32)))), 8, "0")
    return F.concat(text, F.lit(END), salt)


def place(text: Column, cuts: list[str]) -> Column:
    """How many of the sorted ``cuts`` are not above the text: a search in steps of FAN comparisons."""
    if not cuts:
        return F.lit(0)
    step = 1
    while step * FAN < len(cuts):
        step *= FAN
    at = None
    while step:
        level = F.array(*[F.lit(c) for c in cuts[::step]])
        if at is None:
            at = F.size(F.filter(level, lambda c: c <= text))
        else:
            start = (at - 1) * FAN
            at = F.when(at > 0, start + F.size(F.filter(F.slice(level, start + 1, F.lit(FAN)), lambda c: c <= text))).otherwise(F.lit(0))
        step //= FAN
    return at


def place_of(text: str, cuts: list[str]) -> int:
    """``place`` of a driver-side constant."""
    return bisect_right(cuts, text)
