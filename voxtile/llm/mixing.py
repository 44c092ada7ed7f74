"""Mixing sources to target weights by pivotal dependent rounding, with DataFrame functions only.

A source whose target is r times its size gives each text floor(r) copies and one more with probability r - floor(r).
Those probabilities are rounded together: two texts of a source pair up, and mass (words times probability) moves from one to
the other until one of them is at 0 or 1.  The direction is drawn so that each text keeps its probability, and
the moved words are equal on both sides, so a source's expected words stay exact until one text is left.
Chunks of about ``CHUNK`` texts are rounded by themselves; what is left of each goes to the next level of the tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.graph import dense_ids
from .common import WORD, checkpointed, documents

#: Fixed by the task: weights of the sources in turn, and the copies that no text exceeds.
WEIGHTS, MOST_COPIES = (5, 2, 1), 3
#: Texts that one fold rounds, on average, and the seed of all draws.
CHUNK, SEED = 64, 20_240_101


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, source: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, share: float = 1.0) -> DataFrame:
    """``sizes`` (source, source_size) with weight and target: ``share`` of all words, by weight, at most ``most`` times a source's size.

    What the capped sources leave goes to the others by weight until none is above its cap.  Words for each unit of weight (the level) rise
    from round to round, each an aggregation; so however many sources there are, no task sorts them all.  Null is the last source.
    """
    placed = dense_ids(sizes.select(F.col(source).isNull().alias("none"), F.col(source).alias("source"), "source_size"), ["none", "source"], "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    table = checkpointed(placed.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * float(most)).alias("cap")))
    whole, level = (table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]) * share, 0.0
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("weight")
        used, open_ = table.agg(F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        rest = (whole - used) / open_ if open_ else level
        if rest <= level:
            break
        level = rest
    return table.select(F.col("source").alias(source), "source_size", "weight", F.least("cap", F.lit(level) * F.col("weight")).alias("target"))


def _round_chunk(items: Column) -> Column:
    """Fold an array of (key, size, mass) into struct(left, done): done has (key, up) for all but one."""

    def pair(state: Column, b: Column) -> Column:
        a = state["left"]
        up = F.least(a["size"] - a["mass"], b["mass"])  # to a
        down = F.least(a["mass"], b["size"] - b["mass"])  # to b
        draw = F.pmod(F.xxhash64(F.lit(SEED), a["key"], b["key"]), F.lit(1 << 52)) / F.lit(float(1 << 52))
        to_a = draw * (up + down) < down
        mass_a = F.when(to_a, F.when(up == a["size"] - a["mass"], a["size"]).otherwise(a["mass"] + up)).otherwise(F.when(down == a["mass"], F.lit(0.0)).otherwise(a["mass"] - down))
        mass_b = F.when(to_a, F.when(up == b["mass"], F.lit(0.0)).otherwise(b["mass"] - up)).otherwise(F.when(down == b["size"] - b["mass"], b["size"]).otherwise(b["mass"] + down))
        item = lambda x, mass: F.struct(x["key"].alias("key"), x["size"].alias("size"), mass.alias("mass"))
        ended = lambda x, mass: F.struct(x["key"].alias("key"), (mass > 0).alias("up"))
        settled_a = (mass_a == 0.0) | (mass_a == a["size"])
        return F.struct(
            F.when(settled_a, item(b, mass_b)).otherwise(item(a, mass_a)).alias("left"),
            F.concat(state["done"], F.array(F.when(settled_a, ended(a, mass_a)).otherwise(ended(b, mass_b)))).alias("done"),
        )

    start = F.struct(F.element_at(items, 1).alias("left"), F.expr("cast(array() as array<struct<key:struct<id:long,row:long,nth:long>,up:boolean>>)").alias("done"))
    return F.aggregate(F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))), start, pair)


def rounded(items: DataFrame) -> DataFrame:
    """key, up for each row of (source, key, size, mass) with 0 < mass < size; ``key`` is struct(id, row, nth)."""
    counts = items.groupBy("source").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("source", "_of")
    most = counts.agg(F.max("n")).first()[0] or 0
    left = items.join(counts, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")
    done = items.select("key", F.lit(False).alias("up")).limit(0)
    level = 0
    while most:
        chunks = F.ceil(F.col("n") / CHUNK)
        chunk = F.pmod(F.xxhash64(F.lit(SEED + level), "key"), chunks)
        grouped = left.withColumn("chunk", chunk).groupBy("source", "n", "chunk").agg(F.sort_array(F.collect_list(F.struct("key", "size", "mass"))).alias("items"))
        folded = checkpointed(grouped.select("source", chunks.alias("n"), _round_chunk(F.col("items")).alias("f")))
        draw = F.pmod(F.xxhash64(F.lit(SEED - 1), "f.left.key"), F.lit(1 << 52)) / F.lit(float(1 << 52))
        last = folded.where("n = 1").select(F.col("f.left.key").alias("key"), (draw * F.col("f.left.size") < F.col("f.left.mass")).alias("up"))
        done = done.union(folded.select(F.explode("f.done").alias("d")).select("d.key", "d.up")).union(last)
        left = folded.where("n > 1").select("source", "f.left.key", "f.left.size", "f.left.mass", "n")
        most = -(-most // CHUNK) if most > CHUNK else 0
        level += 1
    return done


def copies(df: DataFrame, row_id: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, share: float = 1.0) -> DataFrame:
    """id, row, check, nth, source, size, source_size, target, copies: a row for each row of ``df``.

    ``row`` and ``check`` are hashes of all columns; equal rows are numbered by ``nth``.  Null texts have size 0, and texts of size 0 get floor(r) copies.
    The same rows give the same copies in any order or partitioning.  An empty table gives no rows.  ``row_id`` holds whole numbers (or NULL); text ids are
    an error, and so are columns of maps, which can't be hashed.
    """
    flat = df.select(F.col(row_id).cast("long").alias("id"), F.col(source).alias("source"), word_count(text).alias("size"), F.xxhash64(*df.columns).alias("row"), F.xxhash64(F.lit(31), *df.columns).alias("check"))
    rows = checkpointed(flat.groupBy("id", "source", "size", "row", "check").agg(F.count(F.lit(1)).alias("times")))
    sizes = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("source_size"))
    plan = checkpointed(targets(sizes, "source", weights, most, share)).withColumnRenamed("source", "_of")
    each = rows.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).drop("times")
    each = each.join(plan, F.col("source").eqNullSafe(F.col("_of"))).drop("_of", "weight")
    ratio = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    each = each.withColumn("whole", F.floor(ratio)).withColumn("part", ratio - F.floor(ratio))
    items = each.where("size > 0 and part > 0").select("source", F.struct("id", "row", "nth").alias("key"), F.col("size").cast("double").alias("size"), (F.col("size") * F.col("part")).alias("mass"))
    up = rounded(items).select(F.col("key.id").alias("id_"), F.col("key.row").alias("row_"), F.col("key.nth").alias("nth_"), "up")
    same = F.col("id").eqNullSafe(F.col("id_")) & (F.col("row") == F.col("row_")) & (F.col("nth") == F.col("nth_"))
    number = (F.col("whole") + F.coalesce(F.col("up"), F.lit(False)).cast("long")).cast("long")
    return each.join(up, same, "left").select("id", "row", "check", "nth", "source", "size", "source_size", "target", number.alias("copies"))


def mixed(df: DataFrame, row_id: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it; equal rows share their copies out among them.

    Rows meet their numbers by id, two independent hashes of all columns; no column of ``df`` is changed, whatever its name.  ``row_id`` holds whole numbers, and no column may be a map.
    """
    hashes = [F.xxhash64(*df.columns).alias("row"), F.xxhash64(F.lit(31), *df.columns).alias("check")]
    keyed = df.select(F.struct(*df.columns).alias("own"), F.col(row_id).cast("long").alias("id"), *hashes)
    number = copies(df, row_id, source, text, **options).groupBy("id", "row", "check").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("times"))
    same = keyed.id.eqNullSafe(number.id) & (keyed["row"] == number["row"]) & (keyed["check"] == number["check"])
    both = keyed.join(number.where("copies > 0"), same).select("own", keyed["id"], keyed["row"], "copies", "times")
    # a row that is there once takes all; of equal rows each takes an even share, and the first ones the rest
    once = both.where("times = 1").select("own", "copies")
    place = F.row_number().over(Window.partitionBy("id", "row").orderBy(F.lit(1)))
    more = both.where("times > 1").withColumn("n", place)
    more = more.select("own", (F.floor(F.col("copies") / F.col("times")) + F.when(F.col("n") <= F.col("copies") % F.col("times"), 1).otherwise(0)).alias("copies"))
    return once.union(more).where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies").cast("long")))).select("own.*")


def op5_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    out = copies(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
