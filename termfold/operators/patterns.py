"""LIKE patterns of any number, kept in a table.

Each pattern is filed under one gram: a few characters of its longest literal run, the rarest of them among the values. A
value that is like the pattern holds that gram, so values, cut into the same grams, meet candidates only; these are
then compared by LIKE. Values are compared once each, however often they occur.

A pattern without any literal (``%``, ``_``, ``[set]`` alone) is filed under the empty gram, which all values
hold: the work of such patterns is their number times that of the different values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termfold.functions.text import HAT, head, norm, regroup
from termfold.operators.joins import lookup_join
from termfold.operators.staging import staged, staged_and_measured

#: Characters of the longest grams.
GRAM = 3
SET = r"\[[^\]]*\]"
WILD = r"[%_\[]"


def literal_run(pattern: Column) -> Column:
    """Longest run of a pattern without wildcards and sets, in lower case; '' without any."""
    runs = F.split(F.regexp_replace(F.lower(pattern), SET, "%"), "[%_]+")
    return F.array_max(F.transform(runs, lambda r: F.struct(F.length(r).alias("n"), r.alias("run"))))["run"]


def grams(text: Column, size: Column | int) -> Column:
    """All different runs of ``size`` characters; the empty one for size 0."""
    size = F.lit(size) if isinstance(size, int) else size
    last = F.length(text) - size + 1
    cut = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(text, i, size))
    return F.when(size == 0, F.array(F.lit(""))).when(last < 1, F.array().cast("array<string>")).otherwise(F.array_distinct(cut))


def regex(pattern: Column) -> Column:
    """``functions.text.like_regex`` of a column: %, _ and [set]."""
    def part(t: Column) -> Column:
        members = F.regexp_replace(F.regexp_replace(t, r"^\[\^?|\]$", ""), r"([\\\[\]&^])", r"\\$1")
        return (
            F.when(t == "%", ".*").when(t == "_", ".").when(t == "[]", "(?!)")
            .when(F.length(t) > 1, F.concat(F.when(t.startswith("[^"), "[^").otherwise("["), members, F.lit("]")))
            .otherwise(F.regexp_replace(t, r"([^\w\s])", r"\\$1"))
        )
    parts = F.regexp_extract_all(pattern, F.lit(f"(?s)({SET}|.)"), 1)
    return F.concat(F.lit(r"(?is)\A"), F.array_join(F.transform(parts, part), ""), F.lit(r"\z"))


def is_like(value: Column, pattern: Column) -> Column:
    """Case-insensitive LIKE with a pattern from a column; only sets need a regular expression."""
    # an unescaped pattern compared by LIKE takes a backslash for an escape
    plain = F.replace(pattern, F.lit("\\"), F.lit("\\\\"))
    return F.when(pattern.rlike(SET), F.call_function("rlike", value, regex(pattern))).otherwise(F.call_function("ilike", value, plain))


def first_like(values: DataFrame, patterns: DataFrame) -> DataFrame:
    """Of each different ``value`` that is like any pattern, the least ``seq`` of those; patterns have seq and pattern."""
    size = F.least(F.lit(GRAM), F.length("run"))
    filed = staged(
        patterns.where(F.col("pattern").isNotNull()).select("seq", "pattern", literal_run(F.col("pattern")).alias("run"))
        .select("seq", "pattern", F.explode(grams(F.col("run"), size)).alias("gram"))
    )
    sizes = sorted(r["n"] for r in filed.select(F.length("gram").alias("n")).distinct().collect())
    different = values.where(F.col("value").isNotNull()).select("value").distinct()
    cut = F.flatten(F.array(*[grams(F.lower("value"), n) for n in sizes])) if sizes else F.array().cast("array<string>")
    held = staged(different.select("value", F.explode(cut).alias("gram")).join(F.broadcast(_few(filed.select("gram").distinct())), "gram", "left_semi"))
    often = held.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = (
        filed.join(often, "gram").groupBy("seq", "pattern").agg(F.min(F.struct("n", "gram"))["gram"].alias("gram"))
    )
    index, size_of = staged_and_measured(rarest)
    met = held.join(F.broadcast(index) if size_of.broadcastable else index, "gram")
    return met.where(is_like(F.col("value"), F.col("pattern"))).groupBy("value").agg(F.min("seq").alias("seq"))


def _few(grams_: DataFrame) -> DataFrame:
    """Distinct grams of GRAM characters: no more than there are combinations of the characters in use; measured."""
    table, size = staged_and_measured(grams_)
    return table if size.broadcastable else table.hint("shuffle_hash")


def like_any_of(df: DataFrame, column: str | Column, patterns: DataFrame, flag: str) -> DataFrame:
    """Boolean column: is the value like any pattern of the table (column ``pattern``)? NULL for NULL."""
    numbered = patterns.select("pattern").distinct().withColumn("seq", F.lit(1).cast("long"))
    value = F.col(column) if isinstance(column, str) else column
    keyed = df.withColumn("_value", value)
    found = first_like(keyed.select(F.col("_value").alias("value")), numbered).select(F.col("value").alias("_value"), F.lit(True).alias("_like"))
    out = lookup_join(keyed, found, ["_value"])
    return out.withColumn(flag, F.when(F.col("_value").isNotNull(), F.coalesce("_like", F.lit(False)))).select(*df.columns, flag)


def skip_pattern_table(df: DataFrame, column: str, patterns: DataFrame, group: str) -> DataFrame:
    """Put the group name in place of every head that is like none of the table's patterns."""
    flagged = like_any_of(df, head(column), patterns, "_kept")
    return flagged.withColumn(column, F.when(~F.col("_kept"), regroup(group, column)).otherwise(F.col(column))).select(*df.columns)


def default_group_table(df: DataFrame, column: str, siblings: DataFrame, patterns: DataFrame, group: str) -> DataFrame:
    """The default group beside groups of any number (column ``grp``): it takes what is in none of them and whose head is
    like no pattern.

    A value is in a group if it is its name, or begins with the name and ``^``. Names are literal text but for those
    with wildcards, which are patterns then.
    """
    names = staged(siblings.where(F.col("grp").isNotNull()).select("grp").distinct())
    whole = names.select(norm("grp").alias("_whole"), F.lit(True).alias("_named")).distinct()
    plain = ~F.col("grp").rlike(WILD) & ~F.col("grp").contains(HAT)
    heads = names.where(plain).select(F.lower("grp").alias("_head"), F.lit(True).alias("_begun")).distinct()
    others = names.where(~plain).select(F.concat("grp", F.lit(HAT + "%")).alias("pattern"))
    keyed = df.withColumns({"_whole": norm(column), "_head": F.when(F.col(column).contains(HAT), F.lower(head(column)))})
    taken = lookup_join(lookup_join(keyed, whole, ["_whole"]), heads, ["_head"])
    taken = like_any_of(taken, column, others, "_alike")
    free = ~F.coalesce("_named", F.lit(False)) & ~F.coalesce("_begun", F.lit(False)) & ~F.col("_alike")
    flagged = like_any_of(taken.withColumn("_free", free), head(column), patterns, "_kept")
    return flagged.withColumn(column, F.when(F.col("_free") & ~F.col("_kept"), regroup(group, column)).otherwise(F.col(column))).select(*df.columns)
