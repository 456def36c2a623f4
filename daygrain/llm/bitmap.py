"""A bitmap over hashed keys, so that rows that can't join stay out of a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23
WORD = 64


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def split_by(df: DataFrame, keys: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be among ``keys``, rows whose key is not), by a bitmap over the hash of ``columns``.

    The bitmap is a table of at most 131,072 words of 64 bits, whatever the number of keys, so it can be broadcast.  It
    only spares rows a shuffle before an exact join; one that fills up spares none.
    """
    bit = F.pmod(F.xxhash64(*columns), F.lit(BITS))
    words = keys.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / WORD).alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, int(pmod(bit, {WORD}))))").alias("bits")
    )
    word, bits, own = (free_name(df, n) for n in ("word", "bits", "bit"))
    marked = df.withColumn(own, bit).join(
        F.broadcast(words.select(F.col("word").alias(word), F.col("bits").alias(bits))),
        F.floor(F.col(own) / WORD) == F.col(word), "left",
    )
    hit = F.expr(f"coalesce(shiftrightunsigned(`{bits}`, int(pmod(`{own}`, {WORD}))) & 1L = 1L, false)")
    kept = [F.col(f"`{c}`") for c in df.columns]
    return marked.where(hit).select(*kept), marked.where(~hit).select(*kept)


