"""What several operators share: words, row ids, written intermediate tables."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

SPACES = " \t\n\x0b\f\r"
SPLIT = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text: runs of anything but space, tab, newline, VT, FF and CR. Null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPLIT, -1), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else unchanged, so that every engine agrees."""
    return F.translate(text, UPPER, LOWER)


def settle(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written below the shared folder and read back (see ``session.cut``).

    The plan behind it, and so its shuffle files, become garbage that Spark's cleaner may drop.
    """
    out = cut(df, f"llm-{tag}")
    gc.collect()
    return out


SHARES = 1024  # a key with more than this part of all rows is salted


def salted_join(rows: DataFrame, keys: DataFrame, on: list[str], spread: Column, count: str, per_task: int, how: str = "inner") -> DataFrame:
    """Equi-join of ``rows`` with ``keys``, without one task per hot key.

    ``keys`` holds each key once with the number of rows that have it (``count``, at least). Keys with more than
    ``per_task`` rows and more than 1/1,024 of all of them get salts by their own rows; there are fewer than 1,024 of
    these, which is what is broadcast. Every other key is there once.
    """
    total = keys.agg(F.sum(count)).first()[0] or 0
    salts = (F.col(count) / per_task).cast("int") + 1
    hot = F.broadcast(keys.where(F.col(count) > max(per_task, int(total) // SHARES)).select(*on, salts.alias("_salts")))
    salt = F.coalesce(F.pmod(F.xxhash64(spread), F.col("_salts")), F.lit(0)).cast("int")
    left = rows.join(hot, on, "left").withColumn("_salt", salt).drop("_salts")
    every = F.sequence(F.lit(0), F.coalesce(F.col("_salts") - 1, F.lit(0)))
    right = keys.drop(count).join(hot, on, "left").withColumn("_salt", F.explode(every)).drop("_salts")
    return left.join(right, [*on, "_salt"], how).drop("_salt")
