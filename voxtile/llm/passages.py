"""Removal of passages that recur, located with sharded Aho-Corasick automata.

A window is a run of 35 words.  Its anchor is the smallest hash of the runs of 8 words in it, so that equal windows have
equal anchors.

1. Every text gives its distinct anchors; anchors seen once in the corpus are dropped.
2. Texts that keep an anchor give the hashes of the windows it stands for; windows seen once are dropped.
   This confirms the recurring windows, by two independent hashes of 64 bits, and names one text for each.
3. The runs of confirmed windows of the named texts are the passages, a table of phrases without places.
4. The texts are dealt to slices by their smallest recurring anchor, so that texts with common passages meet, and each slice gets the passages that may occur in it, by
   their anchors, or by their windows where many passages have an anchor.  It compiles the first words of the passages' blocks of 18 words, shard by shard, into automata and streams its texts through each; whatever a window of 35 words shares with
   a passage holds a whole block, so a match of one is extended both ways, word by word, to the run that text and passage have in common.
   The words of runs of 35 words or more are removed.

Whatever a slice finds twice itself is settled there and sent on once, so an anchor or window that a third of
all texts have costs one row for each slice.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pandas.util import hash_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import col
from .common import as_bytes, checkpointed, documents, map_arrow, map_blocks, mix, released, stored, windows, words_of
from .graph import KeyFilter, maybe_in

#: Words of a window and of the runs its anchor is chosen from.
WINDOW, RUN = 35, 8
#: Words of a pattern of the automata.
LEAD = 6
#: Characters of the patterns that one automaton holds (each takes about 50 bytes), and bytes of the texts of a slice, which stream through its automata at once.
SHARD_CHARS, STREAM_BYTES = 600_000, 2_000_000
#: Passages of an anchor up to which all of them go where a text has it.
FEW = 8
#: One row a word run of the text: the separators of the word rule, for Spark's regular expressions.
_GAP = r"[\x20\x09-\x0D]+"


def _word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of words (SipHash, equal in every process); each different word of a block is hashed once, in C."""
    every = words.dictionary_encode()
    return hash_array(every.dictionary.to_numpy(zero_copy_only=False), categorize=False)[np.asarray(every.indices)] if len(words) else np.empty(0, np.uint64)


def _window_hashes(words: list[list[bytes]], _: object, width: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of all texts: anchor, hash, number of the text, first word."""
    return _windows(_word_hashes(pa.array([w for x in words for w in x], pa.binary())), np.array([len(x) for x in words], np.int64), width, run)


def _windows_of(texts: pa.Array, width: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same of texts that Arrow splits."""
    flat, length = words_of(texts)
    return _windows(_word_hashes(flat), length, width, run)


def _windows(h: np.ndarray, length: np.ndarray, width: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    if length.sum() < width:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    whole = windows(h, width, 0xD6E8FEB86659FD93)
    least = windows(h, run)
    have, span = 1, width - run + 1
    while have * 2 <= span:
        least = np.minimum(least[:-have], least[have:]) if len(least) > have else least[:0]
        have *= 2
    if have < span and len(least):
        least = np.minimum(least[: len(least) - (span - have)], least[span - have :])
    count = np.maximum(length - width + 1, 0)
    of = np.repeat(np.arange(len(length)), count)
    first = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    at = first + np.repeat(np.cumsum(length) - length, count)
    return least[at], whole[at], of, first


def _of_text(h: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Keys of hashes and the numbers of their texts."""
    with np.errstate(over="ignore"):
        return mix(h + mix(of.astype(np.uint64)))


def _runs(anchor: np.ndarray, of: np.ndarray) -> np.ndarray:
    """First windows of the runs of windows of one text with one anchor."""
    return np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1])])) if len(anchor) else np.empty(0, np.int64)


def _listed(lists: pa.ListArray) -> np.ndarray:
    """Keys of the hashes that are listed for each text of a block."""
    return _of_text(lists.flatten().to_numpy().view(np.uint64), np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())))


def _anchors(df: DataFrame, width: int, run: int) -> DataFrame:
    """anchor, text_hash, times, settled: a settled row is known to recur; a row of two times without a text tells the others."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            hashes, texts, times = {}, [], []
            for k, th in enumerate(batch.column("text_hash").to_pylist()):
                if th in hashes:
                    times[hashes[th]] += 1
                else:
                    hashes[th] = len(texts)
                    texts.append(k)
                    times.append(1)
            ids, times = np.array(list(hashes), np.int64), np.array(times, np.int64)
            anchor, whole, of, _ = _windows_of(batch.column("text").take(pa.array(texts, pa.int64())), width, run)
            # an anchor of several windows of one text counts once; the same window twice counts twice
            first = _runs(anchor, of)
            _, at = np.unique(_of_text(anchor[first], of[first]), return_index=True)
            anchor_of, of_text = anchor[first[at]], of[first[at]]
            same = _of_text(anchor ^ whole, of)
            ordered = np.sort(same)
            twice = np.isin(same, ordered[1:][ordered[1:] == ordered[:-1]])
            value, inverse = np.unique(anchor_of, return_inverse=True)
            total = np.bincount(inverse, weights=times[of_text], minlength=len(value))
            total[np.isin(value, anchor[twice])] += 1
            settled = total[inverse] >= 2
            told = value[total >= 2]
            columns = [
                pa.array(np.concatenate([anchor_of, told]).view(np.int64)),
                pa.concat_arrays([pa.array(ids[of_text], pa.int64()), pa.nulls(len(told), pa.int64())]),
                pa.array(np.concatenate([np.ones(len(of_text), np.int32), np.full(len(told), 2, np.int32)])),
                pa.array(np.concatenate([settled, np.zeros(len(told), bool)])),
            ]
            return pa.RecordBatch.from_arrays(columns, ["anchor", "text_hash", "times", "settled"])

        return step

    return map_blocks(df.select("text_hash", "text"), "text", make, "anchor long, text_hash long, times int, settled boolean")


def _candidates(df: DataFrame, width: int, run: int) -> DataFrame:
    """The distinct windows of a slice whose anchor recurs, as lists by the text that has them first; times is 2 for those that the slice has twice."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            copies = batch.column("copies").to_numpy()
            anchor, whole, of, _ = _windows_of(batch.column("text"), width, run)
            run_at = _runs(anchor, of)
            keep = np.repeat(np.isin(_of_text(anchor[run_at], of[run_at]), _listed(batch.column("anchors"))), np.diff(np.append(run_at, len(anchor))))
            anchor, whole, of = anchor[keep], whole[keep], of[keep]
            with np.errstate(over="ignore"):
                _, at, inverse = np.unique(mix(anchor) + whole, return_index=True, return_inverse=True)
            times = np.minimum(np.bincount(inverse, weights=copies[of], minlength=len(at)), 2).astype(np.int32)
            by = np.argsort(at)
            at, times = at[by], times[by]
            text, first = np.unique(of[at], return_index=True)
            offsets = pa.array(np.append(first, len(at)), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (anchor[at].view(np.int64), whole[at].view(np.int64), times)]
            return pa.RecordBatch.from_arrays([batch.column("text_hash").take(pa.array(text)), *lists], ["text_hash", "anchor", "whole", "times"])

        return step

    return map_blocks(df, "text", make, "text_hash long, anchor array<long>, whole array<long>, times array<int>")


def consecutive(starts: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Passages: spans of windows that follow word by word."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1) + 1
    return [(int(x[0]), int(x[-1]) + width) for x in np.split(starts, cut)]


def _phrases(df: DataFrame, width: int, run: int) -> DataFrame:
    """passage, anchors: the runs of confirmed windows (``whole``) of each text."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [x.split() for x in as_bytes(batch.column("text"))]
            anchor, whole, of, first = _window_hashes(texts, None, width, run)
            edge = np.searchsorted(of, np.arange(len(texts) + 1))
            named = np.isin(_of_text(whole, of), _listed(batch.column("whole")))
            passages, anchors = [], []
            for k, words in enumerate(texts):
                a, b = edge[k], edge[k + 1]
                for x, y in consecutive(first[a:b][named[a:b]], width):
                    passages.append(b" ".join(words[x:y]).decode())
                    anchors.append(np.unique(anchor[a + x : a + y - width + 1]).view(np.int64))
            return pa.RecordBatch.from_arrays([pa.array(passages, pa.string()), pa.array(anchors, pa.list_(pa.int64()))], ["passage", "anchors"])

        return step

    return map_blocks(df, "text", make, "passage string, anchors array<long>")


def agreeing(one: list[str], x: int, other: list[str], y: int, way: int = 1) -> int:
    """How many words from place x of one list and y of the other on, or before them (``way`` -1), are equal; by slices that double and, after a difference, halve."""
    most = min(len(one) - x, len(other) - y) if way > 0 else min(x, y)
    n, step, met = 0, 8, False
    while n < most:
        k = min(step, most - n)
        if one[x + n : x + n + k] == other[y + n : y + n + k] if way > 0 else one[x - n - k : x - n] == other[y - n - k : y - n]:
            n += k
            step = step if met else 2 * step
        elif k == 1:
            break
        else:
            met, step = True, k // 2
    return n


def locate(texts: list[bytes], passages: list[str], width: int, shard_chars: int = SHARD_CHARS) -> list[np.ndarray]:
    """For each text, which of its words lie in a run of ``width`` words or more that it has in common with a passage (words joined by a space).

    The passages are compiled shard by shard, each with patterns of at most ``shard_chars`` characters or those of one passage; every text streams through
    each automaton.  Its patterns are the first ``LEAD`` words of the passages' blocks; where one is met, the text's whole block is looked up among those that begin with it.
    """
    import ahocorasick

    block = (width + 1) // 2
    lead = min(block, LEAD)
    starts: list[bytearray | None] = [None] * len(texts)
    at = 0
    while at < len(passages) or at == 0:
        size, found = 0, {}
        while at < len(passages) and (not found or size < shard_chars):
            own = passages[at].split(" ")
            for i in range(0, len(own) - block + 1, block):
                pattern = f" {' '.join(own[i : i + lead])} "
                begun = found.get(pattern)
                if begun is None:
                    begun = found[pattern] = {}
                    size += len(pattern)
                begun.setdefault(tuple(own[i + lead : i + block]), []).append((own, i))
            at += 1
        automaton = ahocorasick.Automaton()
        for pattern, begun in found.items():
            automaton.add_word(pattern, begun)
        del found
        if len(automaton):
            automaton.make_automaton()
        for k, text in enumerate(texts):
            joined = b" ".join(text.split())
            known = starts[k]
            if known is None:
                known = starts[k] = bytearray(joined.count(b" ") + 1 if joined else 0)  # 1 where a recurring window starts
            total = len(known)
            if total < width or not len(automaton) or known.count(1) > total - width:
                continue
            spaced, words = f" {joined.decode()} ", None
            word_at = seen = 0  # words before character ``seen``
            for end, begun in automaton.iter(spaced):
                word_at += spaced.count(" ", seen, end)
                seen, p = end, word_at - lead
                if p + block > total:
                    break
                # nothing new if every window that holds this block is known to recur
                low, high = max(0, p + block - width), min(p, total - width)
                if known.count(1, low, high + 1) == high + 1 - low:
                    continue
                words = words or joined.decode().split(" ")
                for own, i in begun.get(tuple(words[p + lead : p + block]), ()):
                    a, b = p - agreeing(words, p, own, i, -1), p + block + agreeing(words, p + block, own, i + block)
                    if b - a >= width:
                        known[a : b - width + 1] = b"\x01" * (b - width + 1 - a)
                        if known.count(1, low, high + 1) == high + 1 - low:
                            break
        if at >= len(passages):
            break
    out = []
    for known in starts:
        flags = np.zeros(len(known) + width + 1, np.int32)
        some = np.flatnonzero(np.frombuffer(known, np.uint8)) if known else np.empty(0, int)
        np.add.at(flags, some, 1)
        np.add.at(flags, some + width, -1)
        out.append((np.cumsum(flags) > 0)[: len(known)])
    return out


_SPAN = "array<struct<start:long,end:long>>"


def _located(df: DataFrame, width: int) -> DataFrame:
    """text_hash, text_check, n_removed, spans, kept for each text with anything removed, from rows by slice: passages first, then texts."""
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    names = ["text_hash", "text_check", "n_removed", "spans", "kept"]

    def run(batches):
        key, passages, held, size = None, [], [], 0

        def result():
            found = locate([x for _, _, x in held], passages, width)
            rows = []
            for (h, check, text), flags in zip(held, found):
                if flags.any():
                    words = text.split()
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
                    spans = [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])]
                    rows.append((h, check, int(flags.sum()), spans, b" ".join([w for w, f in zip(words, flags) if not f]).decode()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), span_type, pa.string())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

        for batch in batches:
            for slice_, is_text, h, check, text in zip(*(batch.column(c).to_pylist() for c in ("slice", "is_text", "text_hash", "text_check")), as_bytes(batch.column("text"))):
                if slice_ != key or size >= 2 * STREAM_BYTES:  # rarely: a slice has about half of that
                    if held:
                        yield result()
                    held, size = [], 0
                    if slice_ != key:
                        key, passages = slice_, []
                if is_text:
                    held.append((h, check, text))
                    size += len(text)
                else:
                    passages.append(text.decode())
        if held:
            yield result()

    return map_arrow(df.select("slice", "is_text", "text_hash", "text_check", "text"), run, f"text_hash long, text_check long, n_removed long, spans {_SPAN}, kept string")


def _keys(text) -> list:
    """What tells texts apart: two independent hashes of 64 bits."""
    return [F.xxhash64(text).alias("text_hash"), F.xxhash64(F.lit(17), text).alias("text_check")]


def in_slices(texts: DataFrame, stream_bytes: int | None = None) -> DataFrame:
    """``texts`` (text_hash, anchors, size and others) with ``slice``: texts with the same smallest anchor meet, as they share passages.

    So a passage goes to few slices, however many texts have it.  Texts with one smallest anchor are dealt out by text in parts of about half a slice.
    """
    stream_bytes = stream_bytes or STREAM_BYTES
    slices = max(1, -(-(texts.agg(F.sum("size")).first()[0] or 0) // stream_bytes))
    least = texts.withColumn("least", F.array_min("anchors"))
    part = max(1, stream_bytes // 2)
    # at most two rows a slice
    many = checkpointed(least.groupBy("least").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > part).select("least", F.ceil(F.col("bytes") / part).alias("parts")))
    salt = F.pmod(F.xxhash64(F.lit(31), "text_hash"), F.coalesce("parts", F.lit(1)))
    slice_ = F.pmod(F.xxhash64(F.lit(29), "least", salt), F.lit(slices)).alias("slice")
    return least.join(F.broadcast(many), "least", "left").select(*texts.columns, slice_)


def _windows_with(df: DataFrame, key: str, width: int, run: int) -> DataFrame:
    """``key`` and a hash of anchor and window for each different window of each text whose anchor is in the text's list."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            anchor, whole, of, _ = _windows_of(batch.column("text"), width, run)
            run_at = _runs(anchor, of)
            keep = np.repeat(np.isin(_of_text(anchor[run_at], of[run_at]), _listed(batch.column("anchors"))), np.diff(np.append(run_at, len(anchor))))
            with np.errstate(over="ignore"):
                window = mix(anchor[keep]) + whole[keep]
            of = of[keep]
            _, at = np.unique(_of_text(window, of), return_index=True)
            return pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(of[at])), pa.array(window[at].view(np.int64))], [key, "window"])

        return step

    return map_blocks(df.select(key, "text", "anchors"), "text", make, f"{key} {df.schema[key].dataType.simpleString()}, window long")


def met_by(placed: DataFrame, phrases: DataFrame, width: int, run: int) -> DataFrame:
    """slice, id: the passages (id, passage, anchors) that share a window with a text of a slice (slice, text_hash, text, anchors), and a few others.

    A passage that is cut off inside a common line of text has that line's anchor, and so has every other one that is, and every text with the line.
    Anchors of more than ``FEW`` passages therefore lead to slices only by the windows that both have, not by the product of both.
    """
    of_phrases = phrases.select("id", F.explode("anchors").alias("anchor"))
    crowded = checkpointed(of_phrases.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > FEW).select("anchor"))
    of_texts = placed.select("slice", "text_hash", F.explode("anchors").alias("anchor"))
    few = of_texts.select("slice", "anchor").distinct().join(of_phrases.join(crowded, "anchor", "left_anti"), "anchor").select("slice", "id")

    def some(df: DataFrame, entries: DataFrame, key: str) -> DataFrame:
        own = checkpointed(entries.join(crowded, "anchor").groupBy(key).agg(F.collect_list("anchor").alias("anchors")))
        return _windows_with(maybe_in(df, key, KeyFilter(own, key)).join(own, key), key, width, run)

    texts = some(placed.select("text_hash", "text"), of_texts, "text_hash").join(placed.select("text_hash", "slice"), "text_hash").select("slice", "window").distinct()
    many = texts.join(some(phrases.select("id", F.col("passage").alias("text")), of_phrases, "id"), "window").select("slice", "id")
    return few.union(many).distinct()


def recurring_passages(df: DataFrame, text: str = "text", width: int = WINDOW, run: int = RUN) -> DataFrame:
    """text_hash, text_check, n_removed, spans, kept: a row for each different text that holds a recurring window.

    ``text_hash`` is ``xxhash64(text)``, ``text_check`` another hash; ``spans`` are [start, end) word positions, ``kept`` the other words
    joined by one space.  A window recurs if its words, unchanged, also start anywhere else, in the same text or in another row.
    Null and empty texts, and those shorter than a window, have none.  Repeated rows recur as a whole.
    """
    docs = df.select(*_keys(col(text)), col(text).alias("text")).where("text is not null")
    anchors = stored(_anchors(docs.drop("text_check"), width, run), "anchors")
    times = F.sum("times").over(Window.partitionBy("anchor"))
    open_ = anchors.where("not settled").withColumn("total", times).where("total >= 2 and text_hash is not null").select("text_hash", "anchor")
    touched = anchors.where("settled").select("text_hash", "anchor").union(open_)
    touched = checkpointed(touched.groupBy("text_hash").agg(F.collect_set("anchor").alias("anchors")))
    released(anchors)

    near = maybe_in(docs, "text_hash", KeyFilter(touched, "text_hash"))
    copies = near.groupBy("text_hash", "text_check").agg(F.least(F.count(F.lit(1)), F.lit(2)).alias("copies"), F.min("text").alias("text"))
    texts = stored(copies.join(touched, "text_hash").withColumn("size", F.octet_length("text").cast("long")), "texts")
    each = _candidates(texts.select("text_hash", "copies", "text", "anchors"), width, run).select("text_hash", F.inline(F.arrays_zip("anchor", "whole", "times")))
    confirmed = each.groupBy("anchor", "whole").agg(F.sum("times").alias("total"), F.min("text_hash").alias("text_hash")).where("total >= 2")
    named = confirmed.groupBy("text_hash").agg(F.collect_list("whole").alias("whole"))
    phrases = _phrases(texts.select("text_hash", "text").join(named, "text_hash"), width, run)
    phrases = stored(phrases.withColumn("id", F.md5("passage")).groupBy("id").agg(F.min("passage").alias("passage"), F.first("anchors").alias("anchors")), "passages")

    placed = in_slices(texts)
    met = met_by(placed, phrases, width, run)
    none = F.lit(None).cast("long")
    streamed = met.join(phrases.select("id", "passage"), "id").select("slice", F.lit(False).alias("is_text"), none.alias("text_hash"), none.alias("text_check"), F.col("passage").alias("text"))
    streamed = streamed.union(placed.select("slice", F.lit(True), "text_hash", "text_check", "text"))
    return _located(streamed.repartition("slice").sortWithinPartitions("slice", "is_text"), width)


def words_joined(text):
    """The words of a text joined by one space; empty for null."""
    return F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), _GAP, " "))


def count_words(joined):
    return F.when(joined == "", F.lit(0)).otherwise(F.size(F.split(joined, " "))).cast("long")


def _whole(df: DataFrame) -> DataFrame:
    """``df`` with n_words and whole_sha256, of the words joined by one space, in place of its last column, the text."""
    names = [*df.columns[:-1], "n_words", "whole_sha256"]

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            words = [x.split() for x in as_bytes(batch.column("text"))]
            digest = pa.array([hashlib.sha256(b" ".join(x)).hexdigest() for x in words], pa.string())
            return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([len(x) for x in words], pa.int64()), digest], names)

        return step

    return map_blocks(df, "text", make, T.StructType([*df.schema.fields[:-1], T.StructField("n_words", T.LongType()), T.StructField("whole_sha256", T.StringType())]))


def remove_passages(df: DataFrame, text: str = "text", width: int = WINDOW) -> DataFrame:
    """``df`` with recurring passages taken out of ``text``, and n_removed added; texts without any stay as they are.

    Only rows that a filter by the changed texts lets through are shuffled to them.
    """
    found = stored(recurring_passages(df, text, width).select("text_hash", "text_check", "n_removed", "kept"), "found")
    columns = [c for c in df.columns if c != "n_removed"]
    keyed = df.select(F.struct(*[col(c) for c in columns]).alias("row"), *_keys(col(text)))
    keys = KeyFilter(found, "text_hash")
    near = maybe_in(keyed, "text_hash", keys).join(found, ["text_hash", "text_check"], "left")
    own = lambda c: F.coalesce("kept", F.col("row")[c]) if c == text else F.col("row")[c]
    changed = near.select(*[own(c).alias(c) for c in columns], F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"))
    return changed.union(maybe_in(keyed, "text_hash", keys, inside=False).select(*[F.col("row")[c].alias(c) for c in columns], F.lit(0).cast("long").alias("n_removed")))


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every whole text."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = recurring_passages(docs).select("text_hash", "text_check", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
    whole = _whole(docs.select("doc_id", *_keys(F.col("text")), "text"))
    out = whole.join(checkpointed(found), ["text_hash", "text_check"], "left")
    return out.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"))
