"""Connected components and bounded semi-join filters, both without collecting rows that grow with the input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import star_components
from .common import checkpointed

#: Bits of a filter at most (8 MB as a table of words of 64 bits), bits for each key, and keys from which on a filter lets everything pass.
MOST_BITS, BITS_A_KEY, MOST_KEYS = 1 << 25, 32, 1 << 24


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node it is connected with) for every node that has a link to another.

    Null ends and self links are ignored.  Star rounds on edges, checkpointed after each.
    """
    edges = star_components(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


class KeyFilter:
    """A table of bits of hashed keys that never misses a key; it has at most ``MOST_BITS``, so it may be broadcast at every size.

    With so many keys that most bits would be set it holds none and lets everything pass.
    """

    def __init__(self, keys: DataFrame, key: str):
        n = keys.agg(F.approx_count_distinct(key)).first()[0]
        self.open = n > MOST_KEYS
        self.size = min(MOST_BITS, 1 << max(6, (n * BITS_A_KEY).bit_length()))
        bits = keys.select(self.bit(key).alias("bit")).selectExpr("bit div 64 as _word", "shiftleft(1L, cast(bit % 64 as int)) as x")
        self.words = None if self.open else checkpointed(bits.groupBy("_word").agg(F.bit_or("x").alias("_bits")))

    def bit(self, key: str):
        return F.pmod(F.xxhash64(F.lit(11), key), F.lit(self.size))


def maybe_in(df: DataFrame, key: str, keys: KeyFilter, inside: bool = True) -> DataFrame:
    """Rows whose key may be among the filter's keys, for an exact join on the key; or else (``inside`` false) those whose key is not.

    A lookup in a broadcast table of bounded size: no shuffle, and no Python.  The columns _bit, _word and _bits are used in between.
    """
    if keys.open:
        return df if inside else df.limit(0)
    own = df.withColumn("_bit", keys.bit(key)).withColumn("_word", F.expr("_bit div 64"))
    found = own.join(F.broadcast(keys.words), "_word", "left")
    hit = F.coalesce(F.expr("shiftright(_bits, cast(_bit % 64 as int)) & 1"), F.lit(0)) == int(inside)
    return found.where(hit).select(*[F.col(f"`{c}`") for c in df.columns])
