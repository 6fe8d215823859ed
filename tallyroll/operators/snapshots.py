"""What changed between two deliveries of a table: a multiset difference in one aggregation.

Every row becomes a digest with the sign of its side; the sum of the signs is how many
copies came or went. Only keys and digests are shuffled; the contents of the few rows
that differ are fetched by a semi join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.operators.keys import c


def digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 of a row. NULL differs from every text, values can't run into each other, and -0.0 is 0.0."""
    value = lambda n: c(n) + F.lit(0.0) if df.schema[n].dataType.simpleString() in ("float", "double") else c(n)
    return F.unhex(F.sha2(F.to_json(F.struct(*[value(n).alias(f"f{k}") for k, n in enumerate(columns)]), {"ignoreNullFields": "false"}), 256))


def _signed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(key columns, _digest, _old, _new): how many rows with this content each side has."""
    columns = new.columns
    side = lambda df, a, b: df.select(*[c(k) for k in keys], digest(new, columns).alias("_digest"), F.lit(a).alias("_o"), F.lit(b).alias("_n"))
    both = side(old.select(*[c(n) for n in columns]), 1, 0).unionByName(side(new, 0, 1))
    return both.groupBy(*[c(k) for k in keys], "_digest").agg(F.sum("_o").alias("_old"), F.sum("_n").alias("_new"))


def multiset_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that occur more often on one side, with `difference`: copies in the new table less copies in the old one.

    Positive rows are new EXCEPT ALL old, negative ones old EXCEPT ALL new. Both tables
    have the same columns by name. NULLs equal NULLs, repeated rows count.
    """
    changed = _signed(old, new, []).filter("_old <> _new").select("_digest", (F.col("_new") - F.col("_old")).alias("difference"))
    columns = new.columns
    both = old.select(*[c(n) for n in columns]).unionByName(new)
    found = both.withColumn("_of", digest(new, columns)).join(changed, F.col("_of") == F.col("_digest"))
    return found.groupBy(*[c(n) for n in columns]).agg(F.max("difference").alias("difference"))


def changes_by_key(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each key whose rows differ: the keys, change, removed, added (numbers of rows).

    inserted: the key is new. deleted: it is gone. changed: rows of other content took
    the place of others. repeated / merged: only the number of equal rows grew / shrank.
    A NULL in a key is a value like others.
    """
    own = _signed(old, new, keys)
    gone, came = F.greatest(F.col("_old") - F.col("_new"), F.lit(0)), F.greatest(F.col("_new") - F.col("_old"), F.lit(0))
    per_key = own.groupBy(*[c(k) for k in keys]).agg(
        F.sum("_old").alias("_old"), F.sum("_new").alias("_new"), F.sum(gone).alias("removed"), F.sum(came).alias("added"),
        F.max((F.col("_old") == 0) | (F.col("_new") == 0)).alias("_other")).filter("removed > 0 OR added > 0")
    change = (F.when(F.col("_old") == 0, "inserted").when(F.col("_new") == 0, "deleted").when(F.col("_other"), "changed")
              .when(F.col("removed") == 0, "repeated").when(F.col("added") == 0, "merged").otherwise("changed"))
    return per_key.select(*[c(k) for k in keys], change.alias("change"), "removed", "added")


def change_counts(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys and rows by kind of change."""
    return changes_by_key(old, new, keys).groupBy("change").agg(F.count(F.lit(1)).alias("keys"), F.sum("removed").alias("removed"), F.sum("added").alias("added"))
