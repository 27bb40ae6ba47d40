"""Rules of several columns, kept in a table: AND over columns, OR over the values listed for each.

Terms are compared once per different combination of the columns' values. Each rule is filed under one of its columns:
the one whose listed values are rarest among the combinations. A combination meets the rules filed under its values
there; for these the hits on the other columns are counted by an equality join, and a rule with all its columns hit
holds. Of several the latest counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termfold.functions.text import norm
from termfold.operators.joins import lookup_join
from termfold.operators.staging import staged, staged_and_measured


def add_warning_table(terms: DataFrame, rules: DataFrame, name: str = "WARNING") -> DataFrame:
    """``name``: the message of the last rule (greatest ``seq``) whose columns all hold a listed value, else NULL.

    ``rules``: seq, message, col and value, a row for each listed value; all rows of a seq have one message (else the
    greatest). Values compare without case and trailing blanks; NULL is no value. A rule that names a column which the
    terms lack never holds.
    """
    listed = staged(
        rules.where(F.col("value").isNotNull() & F.col("col").isNotNull())
        .select("seq", "col", norm("value").alias("value")).distinct()
    )
    named = sorted(r["col"] for r in rules.select("col").distinct().collect() if r["col"] in terms.columns)
    if not named:
        return terms.withColumn(name, F.lit(None).cast("string"))
    needed = rules.groupBy("seq").agg(F.count_distinct("col").alias("needed"), F.max("message").alias("message"))
    keys = {f"_key_{i}": norm(F.coalesce(F.col(c).cast("string"), F.lit(""))) for i, c in enumerate(named)}
    keyed = terms.withColumns(keys)
    combinations = staged(keyed.select(*keys).distinct())
    values = [F.struct(F.lit(c).alias("col"), F.col(k).alias("value")) for k, c in zip(keys, named)]
    cells = staged(combinations.select(*keys, F.explode(F.array(*values)).alias("cell")).select(*keys, "cell.*"))

    often = cells.groupBy("col", "value").agg(F.count(F.lit(1)).alias("n"))
    costs = listed.join(often, ["col", "value"], "left").groupBy("seq", "col").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"))
    filed_at = costs.groupBy("seq").agg(F.min(F.struct("n", "col"))["col"].alias("col"))
    filed, size = staged_and_measured(listed.join(filed_at, ["seq", "col"]))
    met = staged(cells.join(F.broadcast(filed) if size.broadcastable else filed, ["col", "value"]).select(*keys, "seq"))
    checked = met.select(*keys, "seq", F.explode(F.array(*values)).alias("cell")).select(*keys, "seq", "cell.*")
    rest, size = staged_and_measured(listed.join(met.select("seq").distinct(), "seq", "left_semi"))
    hits = (
        checked.join(F.broadcast(rest) if size.broadcastable else rest, ["seq", "col", "value"])
        .groupBy(*keys, "seq").agg(F.count(F.lit(1)).alias("hits"))
        .join(needed, "seq").where("hits = needed")
    )
    last = hits.groupBy(*keys).agg(F.max(F.struct("seq", "message"))["message"].alias("_message"))
    return lookup_join(keyed, last, list(keys)).withColumn(name, F.col("_message")).select(*terms.columns, name)
