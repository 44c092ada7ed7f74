"""Helpers shared by the text operators.

A *word* is a maximal run of characters other than U+0020 and U+0009..U+000D.
UTF-8 keeps these characters as single bytes, so ``bytes.split()`` finds words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.graph import checkpointed, released, stored  # noqa: F401

#: The word pattern of this package, for Spark's and other engines' regular expressions.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that one step of a vectorised Python operator takes at once.
BLOCK_BYTES = 2_000_000


#: Rows and bytes of an Arrow batch between Spark and Python at most; texts may be long.
BATCH_ROWS, BATCH_BYTES = 1_000, 4_000_000


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches to ``BATCH_ROWS`` rows and ``BATCH_BYTES`` bytes in this session, for good, unless they are smaller already."""
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(name).rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(name, most)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary())
    return [x if x is not None else b"" for x in column.to_pylist()]


def blocks(batch: pa.RecordBatch, column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``most`` bytes, at least one row each."""
    if not batch.num_rows:
        return
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
    part = (np.cumsum(lengths, dtype=np.int64) - lengths) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def gathered(batches: Iterator[pa.RecordBatch], column: str, least: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until their texts have ``least`` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= least:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def map_blocks(
    df: DataFrame, column: str, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: T.StructType | str, most: int = BLOCK_BYTES, fill: bool = False
) -> DataFrame:
    """``map_arrow`` with slices of bounded text; ``make`` runs once a task and returns the function of a slice.  With ``fill``, batches below the bound are put together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in gathered(batches, column, most) if fill else batches:
            for part in blocks(batch, column, most):
                yield step(part)

    return map_arrow(df, run, schema)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` whose workers give their free memory back at the end of a task; column names may have dots in them."""
    names = df.columns
    dotted = any("." in c or "`" in c for c in names)
    if dotted:
        schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        out = [f"c{i}" for i in range(len(schema))]
        given, schema = schema.names, T.StructType([T.StructField(c, f.dataType, f.nullable) for c, f in zip(out, schema)])
        df = df.toDF(*[f"c{i}" for i in range(len(names))])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if dotted:
            for batch in run(x.rename_columns(names) for x in batches):
                yield batch.rename_columns(out)
        else:
            yield from run(batches)
        give_back()

    made = df.mapInArrow(whole, schema)
    return made.toDF(*given) if dotted else made


def give_back() -> None:
    """Return the free memory of Arrow's pool and, where the C library has a call for it, of the heap to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts one after another (binary), and the number of words of each text; null has none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(column, ""))
    flat = lists.flatten().cast(pa.binary())
    some = np.asarray(pc.binary_length(flat)) > 0  # a text that begins or ends with a separator has empty parts there
    before = np.concatenate([[0], np.cumsum(some)])
    at = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists)), dtype=np.int64)])
    return flat.filter(pa.array(some)), np.diff(before[at])


def hash_words(words: list[bytes], cache: dict[bytes, int]) -> np.ndarray:
    """64-bit hashes of words (xxh3, equal in every process); ``cache`` holds those seen and is emptied when large."""
    if len(cache) > 150_000:
        cache.clear()
    from xxhash import xxh3_64_intdigest as digest

    get = cache.get
    out = [get(w) for w in words]
    if None in out:
        for i, v in enumerate(out):
            if v is None:
                w = words[i]
                v = get(w)
                if v is None:
                    v = cache[w] = digest(w)
                out[i] = v
    return np.array(out, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def windows(h: np.ndarray, width: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hashes of all runs of ``width`` values, mod 2**64 (doubling: about log2(width) passes)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, done, have, step, power = None, 0, h, 1, np.uint64(base | 1)
    with np.errstate(over="ignore"):
        while width >> 0:
            if width & step:
                part = have[done : done + n]
                out = part.copy() if out is None else out * power + part
                done += step
            if done == width:
                break
            have = have[:-step] * power + have[step:] if len(have) > step else have[:0]
            power = power * power
            step *= 2
    return mix(out)


def most_frequent(df: DataFrame, bound: int, n: str = "n") -> DataFrame:
    """The rows with the largest counts, at most ``bound`` of them: those from some count on.

    The count comes from a histogram with four bins to a power of two, so that no task sends its own largest rows to the driver.
    """
    bin_of = F.floor(4 * F.log2(F.col(n)))
    sizes = sorted(df.where(F.col(n) > 0).groupBy(bin_of.alias("b")).agg(F.count(F.lit(1)).alias("m")).collect(), reverse=True)
    total, least = 0, None
    for b, m in sizes:
        total += m
        if total > bound:
            break
        least = b
    return df.where((F.col(n) > 0) & (bin_of >= least)) if least is not None else df.limit(0)


def crc32_fold(column: str, folds: int):
    """crc32 of a value's text, modulo ``folds``; null counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(folds))

