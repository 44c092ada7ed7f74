"""Document fingerprints by order min-hash.

Character k-mers are numbered by occurrence and hashed; the hash space is cut into equal bins.
In each bin the ``TUPLE`` smallest numbered k-mers are chosen, put back into text order, and the
tuple of their k-mers is hashed to 16 bits.  Two texts agree in a bin if they hold the same chosen k-mers in the same
order, so the share of agreeing bins falls with edits and also with moves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, documents, map_blocks, mix, windows

#: Characters of a k-mer, k-mers of a tuple, bins of a fingerprint.
K, TUPLE, BINS = 8, 2, 64
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _sorted(major: np.ndarray, minor: np.ndarray, minor_bits: int) -> np.ndarray:
    """Places in the order of (major, minor, place); packed into one sort where 64 bits are enough."""
    n = len(major)
    place_bits = max(1, (n - 1).bit_length())
    if int(major[-1] if n else 0).bit_length() + minor_bits + place_bits > 64:
        return np.lexsort((np.arange(n), minor, major))
    packed = (major.astype(np.uint64) << np.uint64(minor_bits) | minor) << np.uint64(place_bits) | np.arange(n, dtype=np.uint64)
    packed.sort()
    return (packed & np.uint64((1 << place_bits) - 1)).astype(np.int64)


def _settled(by: np.ndarray, doc: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """An order by (text, upper half of the hash, place) with the rare k-mers that share only the upper half put apart."""
    d, g = doc[by], gram[by]
    same = (d[1:] == d[:-1]) & (g[1:] >> np.uint64(32) == g[:-1] >> np.uint64(32))
    mixed = same & (g[1:] != g[:-1])
    if mixed.any():
        run = np.concatenate([[0], np.cumsum(~same)])
        of = np.zeros(run[-1] + 1, bool)
        of[run[1:][mixed]] = True
        at = np.flatnonzero(of[run])  # only these few are sorted again
        by[at] = by[at][np.lexsort((by[at], g[at], run[at]))]
    return by


def signatures(texts: list[str | None], k: int = K, size: int = TUPLE, bins: int = BINS) -> np.ndarray:
    """A row of ``bins`` 16-bit values for each text; 0 is an empty bin.  A text shorter than k is one k-mer."""
    out = np.zeros((len(texts), bins), "<u2")
    raw = [np.frombuffer((x or "").encode("utf-32-le", "surrogatepass"), "<u4") for x in texts]
    raw = [np.pad(x, (0, max(0, k - len(x)))) if len(x) else x for x in raw]
    length = np.array([len(x) for x in raw], np.int64)
    if not length.any():
        return out
    gram = windows(np.concatenate(raw).astype(np.uint64), k)
    start = np.cumsum(length) - length
    count = np.maximum(length - k + 1, 0)
    doc = np.repeat(np.arange(len(texts)), count)
    gram = gram[np.arange(len(doc)) + np.repeat(start - (np.cumsum(count) - count), count)]
    with np.errstate(over="ignore"):
        by = _sorted(doc, gram >> np.uint64(32), 32)
        by = _settled(by, doc, gram)
        new = np.concatenate([[True], (np.diff(doc[by]) != 0) | (np.diff(gram[by]) != 0)])
        occurrence = np.arange(len(by)) - np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
        numbered = np.empty(len(by), np.uint64)
        numbered[by] = mix(gram[by] + occurrence.astype(np.uint64) * _GOLD)
        bits = (bins - 1).bit_length()
        low = numbered >> np.uint64(64 - 28)  # bin and value
        by = _sorted(doc, low, 28)
        cell = doc[by] * bins + (low[by] >> np.uint64(28 - bits)).astype(np.int64)
        new = np.concatenate([[True], np.diff(cell) != 0])
        nth = np.arange(len(by)) - np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
        chosen, cell = by[nth < size], cell[nth < size]
        order = np.lexsort((chosen, cell))
        chosen, cell = chosen[order], cell[order]
        first = np.flatnonzero(np.concatenate([[True], np.diff(cell) != 0]))
        nth = np.arange(len(cell)) - np.repeat(first, np.diff(np.append(first, len(cell))))
        terms = mix(gram[chosen] + (nth.astype(np.uint64) + np.uint64(1)) * _GOLD)
        value = mix(np.add.reduceat(terms, first)) >> np.uint64(48)
    out.reshape(-1)[cell[first]] = np.maximum(value, 1)
    return out


def fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint", packed: str | None = None) -> DataFrame:
    """Add the packed signature of each whole text as ``out`` (binary, two bytes a bin).

    Null and empty texts give zeros.  Equal texts give equal fingerprints, in any row, file or process.
    A column of that name is replaced.  With ``packed``, a column of that name holds the compressed text in
    place of the text, for a shuffle; see ``edit_tails``.
    """
    df = df.drop(out)
    fields = [T.StructField(packed, T.BinaryType(), False) if packed and f.name == text else f for f in df.schema.fields]
    schema = T.StructType([*fields, T.StructField(out, T.BinaryType(), False)])

    def make():
        press = zstandard.ZstdCompressor(level=3)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            columns, names = list(batch.columns), batch.schema.names
            rows = [x.tobytes() for x in signatures(batch.column(text).to_pylist())]
            if packed:
                columns[names.index(text)] = pa.array([press.compress(x) for x in as_bytes(batch.column(text))], pa.binary())
            return pa.RecordBatch.from_arrays([*columns, pa.array(rows, pa.binary())], [packed if packed and x == text else x for x in names] + [out])

        return step

    return map_blocks(df, text, make, schema)


def edit_tails(df: DataFrame, packed: str = "packed", following: str = "next_packed") -> DataFrame:
    """Replace two compressed texts by n_chars and ``edited``: the last quarter of the first text (rounded down) gives way to as much of the start of the other."""
    rest = [f for f in df.schema.fields if f.name not in (packed, following)]
    schema = T.StructType([*rest, T.StructField("n_chars", T.LongType(), False), T.StructField("edited", T.StringType(), False)])

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            counts, edited = [], []
            for a, b in zip(batch.column(packed).to_pylist(), batch.column(following).to_pylist()):
                x, y = unpack.decompress(a).decode(), unpack.decompress(b).decode()
                quarter = len(x) // 4
                counts.append(len(x))
                edited.append(x[: len(x) - quarter] + y[:quarter])
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in rest), pa.array(counts, pa.int64()), pa.array(edited, pa.string())], schema.names)

    return df.mapInArrow(run, schema)


def likeness(a: Column, b: Column, bins: int = BINS) -> Column:
    """Share of the bins, filled in either hexadecimal fingerprint, that agree; 1 for equal ones."""
    at = F.sequence(F.lit(0), F.lit(bins - 1))
    cut = lambda c, i: F.substring(c, i * 4 + 1, F.lit(4))
    agree = F.size(F.filter(at, lambda i: (cut(a, i) == cut(b, i)) & (cut(a, i) != "0000")))
    either = F.size(F.filter(at, lambda i: (cut(a, i) != "0000") | (cut(b, i) != "0000")))
    return F.when(a == b, 1.0).otherwise(agree / F.greatest(either, F.lit(1)))


def _ranges(batch: pa.RecordBatch, key: str, edges: np.ndarray) -> np.ndarray:
    """Number of the range of each key: 0 for null keys, then by the edges that are not above the key."""
    keys = batch.column(key)
    found = np.searchsorted(edges, pc.fill_null(keys, 0).to_numpy(zero_copy_only=False), side="right") + 1
    return np.where(keys.is_null().to_numpy(zero_copy_only=False), 0, found).astype(np.int32)


def with_next(df: DataFrame, key: str, columns: list[str], keys: DataFrame | None = None, buckets: int | None = None) -> DataFrame:
    """Add next_{c} for each column: the values of the row with the next key (an integer); after the last row those of the first.

    Rows go to ranges of the key, bounded by quantiles; the first row of a range is also sent to the range before
    it, so no task sees more than its range.  The tasks get the bounds as an array, and search them.  Null keys come first; equal keys are ordered
    by the columns' values.  ``keys`` may give the keys of ``df`` more cheaply than ``df`` does.
    """
    session = df.sparkSession
    keys = (df if keys is None else keys).select(key)
    buckets = buckets or 4 * int(session.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / buckets for i in range(1, buckets)]
    edges = np.array(sorted(set(keys.approxQuantile(key, shares, 0.2 / buckets))) if shares else [], np.int64)

    def lowest(batches):
        for batch in batches:
            of = _ranges(batch, key, edges)
            table = pa.table({"range": of, "first": batch.column(key)}).group_by("range").aggregate([("first", "min")])
            yield from table.select(["range", "first_min"]).rename_columns(["range", "first"]).combine_chunks().to_batches()

    heads = {r["range"]: r["first"] for r in keys.mapInArrow(lowest, "range int, first long").groupBy("range").agg(F.min("first").alias("first")).collect()}
    if not heads:
        return df.select("*", *[F.lit(None).cast(df.schema[c].dataType).alias(f"next_{c}") for c in columns])
    order = sorted(heads)
    before = {b: order[i - 1] for i, b in enumerate(order)}
    fields = T.StructType([T.StructField("own", T.StructType(df.schema.fields)), T.StructField("range", T.IntegerType()), T.StructField("before", T.IntegerType())])

    def dealt(batches):
        for batch in batches:
            of = _ranges(batch, key, edges)
            is_first = [k == heads[b] for b, k in zip(of.tolist(), batch.column(key).to_pylist())]
            to = pa.array([before[b] if f else None for b, f in zip(of.tolist(), is_first)], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.to_struct_array(), pa.array(of), to], ["own", "range", "before"])

    place = F.struct(F.col("range").alias("to"), F.lit(0).alias("after"))
    copy = F.struct(F.col("before").alias("to"), F.lit(1).alias("after"))
    sent = df.mapInArrow(dealt, fields).withColumn("place", F.explode(F.when(F.col("before").isNotNull(), F.array(place, copy)).otherwise(F.array(place))))
    own = lambda c: F.col("own")[c]
    window = Window.partitionBy("place.to").orderBy("place.after", own(key).asc_nulls_first(), *[own(c) for c in columns])
    following = F.lead(F.struct(*[own(c).alias(c) for c in columns])).over(window)
    return sent.withColumn("following", following).where("place.after = 0").select(*[own(c).alias(c) for c in df.columns], *[F.col("following")[c].alias(f"next_{c}") for c in columns])


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and their likeness to each other and to the next text."""
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    pairs = with_next(fingerprint(docs, packed="packed"), "doc_id", ["packed", "fingerprint"], keys=docs)
    edited = edit_tails(pairs)
    out = fingerprint(edited, "edited", "edited_fingerprint").withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint", "next_fingerprint")})
    return out.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
