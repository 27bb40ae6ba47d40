"""Mixing sources to target weights.

Each document gets a hash-random key. A source's keys are dealt into equal key ranges; word counts are summed
per range with map-side aggregation, and prefix sums over the ranges of a source find the one range in which its
budget ends. Only that range is put in order. Its prefix sums give the cut key, so the mix needs no shuffle of
documents: whether, and how often, a document is taken follows from its key and its source's cut.

Defined results: a null text has size 0; a null source is a source of its own, last in order; a source without
words has target 0; repeated rows of one id and text share one key and are cut alike (the words left at the cut
are divided evenly among them, rounded down); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termfold.llm.shared import WORD, table, unused_prefix
from termfold.operators.staging import staged

#: Weights by a source's place in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: The mix has so many times the words of all sources; a source gives at most MOST times its own.
SHARE, MOST = 1.5, 2.0
#: Documents of a source that one key range holds, on average.
RANGE_ROWS = 4096


def _size() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def _key() -> Column:
    return F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words and the hash-random key of each document."""
    return docs.select("doc_id", "source", _size().alias("size"), _key().alias("mix_key"))


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Adds ``target`` words to one row per source (source, rows, source_size).

    Sharing by weight and resharing what exceeds a source's limit ends at one level: target =
    min(limit, weight * level). Sources in order of limit / weight reach their limits first; the level is that of
    the first source whose limit is not reached by an even share of what is left.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("_n") - 1, F.lit(len(weights))) + 1).cast("int"))
    by_level = Window.orderBy("_reach", "_n")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))) / (
        F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    )
    return (
        sources.withColumn("_n", F.row_number().over(order))
        .withColumn("_w", weight)
        .withColumn("_limit", most * F.col("source_size"))
        .withColumn("_reach", F.col("_limit") / F.col("_w"))
        .withColumn("_level", level)
        .withColumn("_level", F.min(F.when(F.col("_level") <= F.col("_reach"), F.struct("_reach", "_n", "_level"))).over(everything)["_level"])
        .withColumn("target", F.least("_limit", F.coalesce(F.col("_level") * F.col("_w"), F.col("_limit"))))
        .select("source", "rows", "source_size", "target")
    )


def _range(n_ranges):
    """Number of the key range, from the first 32 bits of the key."""
    part = F.conv(F.substring("mix_key", 1, 8), 16, 10).cast("double") / float(1 << 32)
    return F.floor(part * n_ranges).cast("long")


def cuts(keyed: DataFrame, sources: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per source: source_size, target, epochs, cut_key and cut_words.

    A source gives every document ``epochs`` times, those with a key before ``cut_key`` once more, and
    ``cut_words`` words of those at the cut.
    """
    planned = (
        sources.withColumn("_budget", F.round("target").cast("long"))
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("_budget div source_size")).otherwise(F.lit(0)).cast("long"))
        .withColumn("_rest", F.col("_budget") - F.col("epochs") * F.col("source_size"))
        .withColumn("_ranges", F.ceil(F.col("rows") / range_rows))
        .withColumnRenamed("source", "_source")
    )
    ranged = keyed.join(planned.select("_source", "_ranges", "_rest"), F.col("source").eqNullSafe(F.col("_source"))).withColumn("_range", _range(F.col("_ranges")))
    sums = ranged.groupBy("_source", "_range", "_rest").agg(F.sum("size").alias("_words"))
    upto = Window.partitionBy("_source").orderBy("_range")
    crossing = (
        sums.withColumn("_before", F.sum("_words").over(upto) - F.col("_words"))
        .where((F.col("_before") <= F.col("_rest")) & (F.col("_before") + F.col("_words") > F.col("_rest")))
        .select(F.col("_source").alias("_at"), F.col("_range").alias("_at_range"), "_before")
    )
    inside = (
        ranged.join(crossing, F.col("source").eqNullSafe(F.col("_at")) & (F.col("_range") == F.col("_at_range")))
        .groupBy("_source", "mix_key", "_before", "_rest")
        .agg(F.sum("size").alias("_words"), F.count(F.lit(1)).alias("_ties"))
    )
    by_key = Window.partitionBy("_source").orderBy("mix_key")
    cut = (
        inside.withColumn("_start", F.col("_before") + F.sum("_words").over(by_key) - F.col("_words"))
        .where((F.col("_start") <= F.col("_rest")) & (F.col("_start") + F.col("_words") > F.col("_rest")))
        .select(F.col("_source").alias("_cut_source"), F.col("mix_key").alias("cut_key"),
                F.expr("(_rest - _start) div _ties").alias("cut_words"))
    )
    return planned.join(cut, F.col("_source").eqNullSafe(F.col("_cut_source")), "left").select(
        "_source", "source_size", "target", "epochs", "cut_key", "cut_words"
    )


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """doc_id, source, mix_key, size, source_size, target and taken (words, repeats counted) of every document."""
    keyed = staged(sized(docs))
    return _taken(keyed, _cut_table(keyed, weights, share, most))


def _cut_table(keyed: DataFrame, weights, share: float, most: float) -> DataFrame:
    sources = staged(keyed.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("source_size")))
    return staged(cuts(keyed, staged(targets(sources, weights, share, most))))


def _taken(keyed: DataFrame, cut: DataFrame) -> DataFrame:
    part = (
        F.when(F.col("cut_key").isNull() | (F.col("mix_key") > F.col("cut_key")), F.lit(0))
        .when(F.col("mix_key") < F.col("cut_key"), F.col("size"))
        .otherwise(F.col("cut_words"))
    )
    return keyed.join(cut, F.col("source").eqNullSafe(F.col("_source"))).select(
        *keyed.columns, "source_size", "target", "epochs",
        (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The mix itself, in whole documents: a document is repeated as often as it is taken.

    The document at a source's cut is kept whole if at least half of it is within the budget. Documents without
    words go with their key like all others. The columns are those of ``docs``.
    """
    own = unused_prefix(docs.columns)
    cut = _cut_table(staged(sized(docs)), weights, share, most)
    cut = cut.select(*[F.col(c).alias(own + c) for c in cut.columns])
    key, size, copies = (F.col(own + c) for c in ("mix_key", "size", "copies"))
    once_more = (
        F.when(F.col(own + "cut_key").isNull() | (key > F.col(own + "cut_key")), F.lit(0))
        .when(key < F.col(own + "cut_key"), F.lit(1))
        .otherwise(F.when(2 * F.col(own + "cut_words") >= size, F.lit(1)).otherwise(F.lit(0)))
    )
    return (
        docs.withColumns({own + "mix_key": _key(), own + "size": _size()})
        .join(cut, F.col("source").eqNullSafe(F.col(own + "_source")))
        .withColumn(own + "copies", (F.col(own + "epochs") + once_more).cast("int"))
        .where(copies > 0)
        .withColumn(own + "copy", F.explode(F.sequence(F.lit(1), copies)))
        .select(*docs.columns)
    )


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(concat_ws(':', COALESCE(CAST(doc_id AS VARCHAR), ''), COALESCE(text, ''))) AS k
  FROM documents),
s AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS n FROM s),
w2 AS (SELECT *, CASE (n - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS wt,
              2.0::DOUBLE * source_size AS lim FROM w),
w3 AS (SELECT *, lim / wt AS reach FROM w2),
w4 AS (SELECT *, (1.5::DOUBLE * SUM(source_size) OVER ()
                  - COALESCE(SUM(lim) OVER (ORDER BY reach, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / (SUM(wt) OVER ()
                  - COALESCE(SUM(wt) OVER (ORDER BY reach, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lev
       FROM w3),
lev AS (SELECT lev FROM w4 WHERE lev <= reach ORDER BY reach, n LIMIT 1),
t AS (SELECT source, source_size, LEAST(lim, COALESCE((SELECT lev FROM lev) * wt, lim)) AS target FROM w4),
b AS (SELECT *, CAST(round(target) AS BIGINT) AS budget FROM t),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM b),
r AS (SELECT sized.doc_id, sized.size, e.source_size, e.target, e.epochs, e.budget - e.epochs * e.source_size AS rest, sized.k, sized.source,
             SUM(sized.size) OVER (PARTITION BY sized.source ORDER BY sized.k) AS upto,
             SUM(sized.size) OVER (PARTITION BY sized.source, sized.k) AS tied,
             COUNT(*) OVER (PARTITION BY sized.source, sized.k) AS ties
      FROM sized JOIN e ON sized.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + CASE WHEN upto <= rest THEN size
                                 WHEN upto - tied >= rest THEN 0
                                 ELSE (rest - (upto - tied)) // ties END AS BIGINT) AS taken
FROM r
"""
