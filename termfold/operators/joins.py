"""Joins of terms with lookup tables that may be large, on keys that may be hot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termfold.functions.text import like_any, norm
from termfold.operators.staging import measure, staged, staged_and_measured

# A key is hot when it holds more than one row in HOT_SHARE, so there are fewer
# than HOT_SHARE hot keys whatever the size of the data: safe to broadcast.
HOT_SHARE = 10_000
SCATTER = 1 << 20
# Words of a key filter (64 bits each) and bits set by a key, all in one word. Its size is fixed: safe to broadcast.
FILTER_WORDS = 1 << 18
FILTER_BITS = 4


def join_broadcast(left: DataFrame, right: DataFrame, on: list[str], only: Column | None = None) -> DataFrame:
    """Left join with a table measured to be small."""
    joined = left.join(F.broadcast(right), on, "left")
    if only is None:
        return joined
    return joined.withColumns({c: F.when(only, F.col(c)) for c in right.columns if c not in on})


def join_beside_hot(
    left: DataFrame, right: DataFrame, on: list[str], hot: DataFrame, only: Column | None = None
) -> DataFrame:
    """Left join with ``right`` (one row per key), hot keys served by broadcast.

    ``hot`` has the columns of ``right`` for every hot key. Rows whose key is hot or
    NULL, or which ``only`` leaves out, need nothing from the shuffled side: a slot
    number beside the key spreads them evenly instead of sending them to one task.
    The slot is drawn from the row and its partition, so a repeated task draws the
    same one.
    """
    payload = [c for c in right.columns if c not in on]
    columns = left.columns
    served = hot.select(*on, F.lit(True).alias("_served"), *[F.col(c).alias("_hot_" + c) for c in payload])
    wanted = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])
    if only is not None:
        wanted = wanted & F.coalesce(only, F.lit(False))
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *columns), F.lit(SCATTER)) + 1
    cold = wanted & F.col("_served").isNull()
    slotted = left.join(F.broadcast(served), on, "left").withColumn("_slot", F.when(cold, F.lit(0)).otherwise(spread))
    # Always 0, but not a literal: a literal would be folded out of the join key.
    zero = F.pmod(F.xxhash64(*on), F.lit(1))
    joined = slotted.join(right.withColumn("_slot", zero), [*on, "_slot"], "left")
    found = [F.when(wanted, F.coalesce(F.col("_hot_" + c), F.col(c))).alias(c) for c in payload]
    return joined.select(*columns, *found)


def lookup_join(
    left: DataFrame, right: DataFrame, on: list[str], only: Column | None = None, local: bool = False
) -> DataFrame:
    """Left join with a lookup table of unknown size, one row per key.

    The lookup is written once and measured: small, it is broadcast; otherwise the
    hot keys of the left side are, and the rest is shuffled. ``local``: it comes from
    rows that the driver holds, which bounds it; it is broadcast as it is.
    """
    if local:
        return join_broadcast(left, right, on, only)
    right, size = staged_and_measured(right)
    if size.broadcastable:
        return join_broadcast(left, right, on, only)
    keys = left if only is None else left.where(only)
    sizes, counted = staged_and_measured(keys.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")), "_rows")
    hot = sizes.where(F.col("_rows") * HOT_SHARE > counted.total).select(*on)
    matched = right.join(F.broadcast(hot), on, "left_semi")
    return join_beside_hot(left, right, on, hot.join(F.broadcast(matched), on, "left"), only)


def join_counts(left: DataFrame, sizes: DataFrame, on: list[str], count: str) -> DataFrame:
    """Left join with the staged row counts of the left side's own keys."""
    size = measure(sizes, count)
    if size.broadcastable:
        return join_broadcast(left, sizes, on)
    return join_beside_hot(left, sizes, on, sizes.where(F.col(count) * HOT_SHARE > size.total))


def _filter_word(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(FILTER_WORDS))


def _filter_mask(key: str) -> Column:
    bits = F.xxhash64(F.col(key), F.lit("bits"))
    places = [F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(FILTER_BITS)]
    return reduce(lambda a, b: a.bitwiseOR(b), [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in places])


def key_filter(keys: DataFrame, key: str) -> DataFrame:
    """A Bloom filter of a column's values, as at most FILTER_WORDS rows: _word and its bits _bits."""
    masks = keys.where(F.col(key).isNotNull()).select(_filter_word(key).alias("_word"), _filter_mask(key).alias("_mask"))
    return staged(masks.groupBy("_word").agg(F.bit_or("_mask").alias("_bits")))


def passed_share(filtered: DataFrame) -> float:
    """Share of keys not in a filter that pass it all the same, by the bits that are set."""
    full = F.sum(F.pow(F.bit_count("_bits") / 64.0, F.lit(FILTER_BITS)))
    return (filtered.agg(full).first()[0] or 0.0) / FILTER_WORDS


def prefiltered(left: DataFrame, filtered: DataFrame, key: str) -> DataFrame:
    """Rows whose key a filter may hold: all that it holds, and ``passed_share`` of the others. NULL never passes."""
    found = left.withColumn("_word", _filter_word(key)).join(F.broadcast(filtered), "_word")
    mask = _filter_mask(key)
    return found.where(F.col(key).isNotNull() & (F.col("_bits").bitwiseAND(mask) == mask)).select(*left.columns)


def part_weights(part: DataFrame, weights: DataFrame) -> DataFrame:
    """One weight per part name: that of the smallest part number of type 1."""
    names = (
        part.where(F.col("TYPE") == 1)
        .groupBy(norm("PART").alias("_part"))
        .agg(norm(F.min("PART_NUM")).alias("_num"))
    )
    values = weights.groupBy(norm("PartNum").alias("_num")).agg(
        F.min("Molecular_weight_COMBINED").alias("MOLECULAR_WEIGHT")
    )
    # parts without a number have no weight: they stay out of the join, where they would meet in one task
    numbered = names.where(F.col("_num").isNotNull()).join(values, "_num", "left").select("_part", "MOLECULAR_WEIGHT")
    weightless = names.where(F.col("_num").isNull()).select("_part", F.lit(None).cast(values.schema["MOLECULAR_WEIGHT"].dataType).alias("MOLECULAR_WEIGHT"))
    return numbered.union(weightless)


def add_molecular_weights(
    terms: DataFrame, part: DataFrame, weights: DataFrame, only: Column | None = None
) -> DataFrame:
    """MOLECULAR_WEIGHT of the part named like the whole COMPONENT."""
    keyed = terms.withColumn("_part", norm("COMPONENT"))
    return lookup_join(keyed, part_weights(part, weights), ["_part"], only).drop("_part")


def components_like(terms: DataFrame, detail: DataFrame, patterns: list[str]) -> DataFrame:
    """Distinct COMPONENTs, over all classes, whose core part is like a pattern.

    The numbers are written and measured; few, they are broadcast and no term is shuffled. Beyond that, only
    terms that pass a filter of the numbers, of fixed size, are shuffled; a LOINC_NUM names one term, so the join needs no
    care for hot keys but NULL, which is left out.
    """
    numbers, size = staged_and_measured(
        detail.where(like_any("COMPONENTCORE", patterns) & F.col("LOINC_NUM").isNotNull())
        .select(norm("LOINC_NUM").alias("_num"))
        .distinct()
    )
    asked = terms.select("COMPONENT", norm("LOINC_NUM").alias("_num")).where(F.col("COMPONENT").isNotNull() & F.col("_num").isNotNull())
    if not size.broadcastable:
        asked = prefiltered(asked, key_filter(numbers, "_num"), "_num")
    return (
        asked.join(F.broadcast(numbers) if size.broadcastable else numbers, "_num", "left_semi")
        .groupBy(norm("COMPONENT").alias("_component"))
        .agg(F.min("COMPONENT").alias("COMPONENT"))
    )


def flag_components(terms: DataFrame, components: DataFrame, flag: str, only: Column | None = None) -> DataFrame:
    """Boolean column: is the COMPONENT in the list? Every term stays."""
    listed = components.select("_component", F.lit(True).alias("_listed"))
    keyed = terms.withColumn("_component", norm("COMPONENT"))
    return (
        lookup_join(keyed, listed, ["_component"], only)
        .withColumn(flag, F.coalesce(F.col("_listed"), F.lit(False)))
        .drop("_component", "_listed")
    )


def mapping_groups(mapping: DataFrame, group_column: str, name: str = "Name") -> DataFrame:
    """A mapping table's groups, one row per name."""
    return (
        mapping.where(F.col(group_column).isNotNull())
        .groupBy(norm(name).alias("_name"))
        .agg(F.min(group_column).alias("_group"))
    )


def mapping_table_group(
    terms: DataFrame, column: str, mapping: DataFrame, group_column: str, name: str = "Name"
) -> DataFrame:
    """Replace whole values of a column by a mapping table's group where it has one."""
    keyed = terms.withColumn("_name", norm(column))
    return (
        lookup_join(keyed, mapping_groups(mapping, group_column, name), ["_name"], local=mapping.isLocal())
        .withColumn(column, F.coalesce(F.col("_group"), F.col(column)))
        .drop("_name", "_group")
    )


def override_by_core(
    terms: DataFrame, source: str, column: str, mapping: DataFrame, group_column: str,
    detail: DataFrame, groupers: DataFrame,
) -> DataFrame:
    """Second mapping of a column for terms whose core component has a grouper."""
    cores = (
        groupers.where(F.col("STDGrouper").isNotNull() & F.col("Name").isNotNull())
        .select(norm("Name").alias("_core"), F.lit(True).alias("_has"))
        .distinct()
    )
    cored = detail.select(norm("LOINC_NUM").alias("_num"), norm("COMPONENTCORE").alias("_core"))
    numbers = (
        lookup_join(cored, cores, ["_core"]).where("_has")
        .select("_num", F.lit(True).alias("_listed"))
        .distinct()
    )
    keyed = terms.withColumns({"_num": norm("LOINC_NUM"), "_name": norm(source)})
    mapped = lookup_join(keyed, mapping_groups(mapping, group_column), ["_name"], local=mapping.isLocal())
    found = lookup_join(mapped, numbers, ["_num"])
    text = F.when(F.col("_listed") & F.col("_group").isNotNull(), F.col("_group")).otherwise(F.col(column))
    return found.withColumn(column, text).drop("_num", "_listed", "_name", "_group")
