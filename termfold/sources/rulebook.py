"""Rule sets from files: the source of user-defined groups."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termfold.functions.text import HAT, head, norm, regroup
from termfold.operators import rules as R
from termfold.operators.joins import lookup_join
from termfold.operators.staging import staged

# Rules that the driver folds are written by hand; a larger table of listed values stays in Spark.
DRIVER_RULE_ROWS = 100_000


def rule_table(spark: SparkSession, rules: list[R.Rule]) -> DataFrame:
    """Rules in long form, one row per value."""
    columns = list(zip(*R.to_rows(rules)))
    return spark.createDataFrame(pa.table({
        name: pa.array(values, pa.int32() if kind == "int" else pa.string())
        for (name, kind), values in zip((c.split() for c in R.LONG_SCHEMA.split(",")), columns)
    }))


def read_rules(table: DataFrame) -> list[R.Rule]:
    """Rules of all kinds from their long form, for the driver.

    Listed values in any number are applied without the driver: see ``apply_rule_table``.
    """
    names = [c.split()[0] for c in R.LONG_SCHEMA.split(",")]
    rows = table.select(*names).limit(DRIVER_RULE_ROWS + 1).collect()
    if len(rows) > DRIVER_RULE_ROWS:
        raise ValueError(f"more than {DRIVER_RULE_ROWS} rule rows; use apply_rule_table for listed values")
    return R.from_rows([tuple(r) for r in rows])


def fold_table(table: DataFrame) -> DataFrame:
    """Listed values of a rule table (seq, value, grp) as a lookup: _head and the _text it ends as.

    Rules apply by seq, each seeing what the earlier ones left. Every value follows its chain: of the rules that
    list it, the first with a greater seq than the last one applied, until none does.
    """
    listed = staged(
        table.where(F.col("value").isNotNull() & ~F.col("value").contains(HAT))
        .select(norm("value").alias("_value"), "seq", "grp").groupBy("_value", "seq").agg(F.max("grp").alias("grp"))
    )
    firsts = listed.groupBy("_value").agg(F.min(F.struct("seq", "grp")).alias("r"))
    done, open_ = None, staged(firsts.select(F.col("_value").alias("_head"), F.col("r.seq").alias("_seq"), F.col("r.grp").alias("_text")))
    while True:
        now = norm(head("_text"))
        later = (
            open_.withColumn("_now", now).join(listed, (F.col("_now") == F.col("_value")) & (F.col("seq") > F.col("_seq")))
            .groupBy("_head").agg(F.min(F.struct("seq", "grp")).alias("r"))
        )
        step = staged(open_.join(later, "_head", "left"))
        settled = step.where(F.col("r").isNull()).select("_head", "_text")
        done = settled if done is None else done.union(settled)
        moved = step.where(F.col("r").isNotNull())
        if moved.isEmpty():
            return done
        rest = F.expr("substring(_text, length(_h) + 1, length(_text))")
        open_ = staged(
            moved.withColumn("_h", head("_text")).select("_head", F.col("r.seq").alias("_seq"), F.concat("r.grp", rest).alias("_text"))
        )


def apply_rule_table(df: DataFrame, column: str, table: DataFrame) -> DataFrame:
    """Replace values of a column by the groups of a rule table of any size."""
    keyed = df.withColumn("_head", norm(head(column)))
    found = lookup_join(keyed, fold_table(table), ["_head"])
    return found.withColumn(column, F.when(F.col("_text").isNotNull(), regroup(F.col("_text"), column)).otherwise(F.col(column))).drop("_head", "_text")


def read_spec(path: str) -> dict:
    """``{column: {group: [values]}}`` from a JSON file, order kept."""
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def rule_hits(terms: DataFrame, rules: list[R.Rule], sources: dict[str, str]) -> DataFrame:
    """Number of terms whose original head equals each listed value.

    ``sources``: revised column -> original column. Heads that no rule lists are
    dropped before the count, so little is shuffled.
    """
    keys = ["profile", "target_col", "_value"]
    table = rule_table(terms.sparkSession, rules)
    listed = table.where(F.col("kind").isin(R.EQ, R.EXCEPT_VALUES)).withColumn("_value", norm("value"))
    heads = terms.select(
        "profile",
        F.explode(F.array(*[
            F.struct(F.lit(target).alias("target_col"), norm(head(F.coalesce(F.col(source), F.lit("")))).alias("_value"))
            for target, source in sources.items()
        ])).alias("_head"),
    ).select("profile", "_head.*")
    found = (
        heads.join(F.broadcast(listed.select(keys).distinct()), keys, "left_semi")
        .groupBy(keys).agg(F.count(F.lit(1)).alias("n_terms"))
    )
    return (
        listed.join(F.broadcast(found), keys, "left").drop("_value")
        .withColumn("n_terms", F.coalesce(F.col("n_terms"), F.lit(0)))
    )
