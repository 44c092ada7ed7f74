"""Quality rules on repetition: word-level suffix arrays and their longest-common-prefix intervals."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, documents, map_blocks

#: Fixed by the base rule: words of a window that counts as repeated, least words of a text, per cent covered at most.
MIN_REPEAT, MIN_WORDS, MAX_COVERED = 5, 10, 0.20
#: The longest repeat may have this share of the words, and in any case so many words.
MAX_LONGEST, LONGEST_FREE = 0.10, 20

_WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_IN_WORD = ~_WHITE & ((np.arange(256) & 0xC0) != 0x80)  # first byte of a character of a word
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))


def _order(first: np.ndarray, second: np.ndarray, most: int) -> np.ndarray:
    """Order by two keys below ``most``; one sort of packed numbers if both keys and the place fit in 63 bits."""
    bits = int(max(most, len(first))).bit_length()
    if 3 * bits > 63:
        return np.lexsort((second, first))
    packed = ((first << bits | second) << bits) | np.arange(len(first))
    packed.sort()
    return packed & ((1 << bits) - 1)


def suffix_levels(token: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of many texts at once, by prefix doubling.

    Suffixes are ordered by text, then by words, to the end of their text.  Only suffixes that
    still share their prefix are sorted again, so the work follows the repeated part.  Also
    returned: the ranks after each doubling, 1, 2, 4... words; equal ranks mean equal prefixes.
    """
    n = len(token)
    end = np.searchsorted(doc, doc, side="right")
    key = doc * (int(token.max()) + 1) + token
    order = _order(doc, token, max(int(token.max()), int(doc[-1])) + 1)
    step = np.concatenate([[True], np.diff(key[order]) != 0])
    first = np.maximum.accumulate(np.where(step, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = first
    levels, k = [rank.astype(np.int32)], 1
    shared = np.bincount(first, minlength=n)[rank] > 1
    active = np.flatnonzero(shared)
    while len(active):
        at = active + k
        second = np.where(at < end[active], rank[np.minimum(at, n - 1)] + 1, 0)
        by = _order(rank[active], second, n + 1)
        active, second = active[by], second[by]
        group = rank[active]
        new_group = np.concatenate([[True], np.diff(group) != 0])
        base = np.maximum.accumulate(np.where(new_group, np.arange(len(active)), 0))
        new = new_group | np.concatenate([[True], np.diff(second) != 0])
        start = np.maximum.accumulate(np.where(new, np.arange(len(active)), 0))
        rank[active] = group + (start - base)
        size = np.bincount(start, minlength=len(active))[start]
        k *= 2
        if (size > 1).any():
            levels.append(rank.astype(np.int32))
        active = np.sort(active[size > 1])
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    return suffixes, levels


def repeat_lengths(token: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest run of words that starts there and also elsewhere in its text.

    That is the value of the deepest longest-common-prefix interval that holds the suffix.
    """
    n = len(token)
    if n == 0:
        return np.zeros(0, np.int64)
    suffixes, levels = suffix_levels(token, doc)
    lcp = np.zeros(n + 1, np.int64)
    pair = np.arange(1, n)
    a, b = suffixes[:-1].copy(), suffixes[1:].copy()
    for level in range(len(levels) - 1, -1, -1):
        rank = levels[level]
        inside = np.flatnonzero((a < n) & (b < n))
        same = inside[(rank[a[inside]] == rank[b[inside]]) & (doc[a[inside]] == doc[b[inside]])]
        lcp[pair[same]] += 1 << level
        a[same] += 1 << level
        b[same] += 1 << level
    longest = np.empty(n, np.int64)
    longest[suffixes] = np.maximum(lcp[:-1], lcp[1:])
    return longest


def union_of_spans(longest: np.ndarray, doc: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the united spans [i, i + longest[i]) with at least ``least`` words; spans of two texts stay apart, even if they touch."""
    at = np.flatnonzero(longest >= least)
    if not len(at):
        return at, at
    reach = np.maximum.accumulate(at + longest[at])
    new = np.concatenate([[True], (at[1:] > reach[:-1]) | (doc[at][1:] != doc[at][:-1])])
    return at[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(at) - 1]])]


def repetition(df: DataFrame, text: str = "text", least: int = MIN_REPEAT) -> DataFrame:
    """Add counts of a text's words, symbols, repeated lines and repeated runs of words.

    ``repeats`` holds the united spans of the maximal repeats of at least ``least`` words, as
    [start, end) word positions; ``n_repeat_words`` is their size and ``longest_repeat`` the
    longest single repeat.  Null and empty texts give zeros and no spans.  Repeated rows are
    treated each by itself; repeats of one length don't compete, as their spans are united.  Columns that already have these names are replaced.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "longest_repeat"]
    df = df.drop(*names, "repeats")
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False)]), False)
    schema = T.StructType([*df.schema.fields, *(T.StructField(x, T.LongType(), False) for x in names), T.StructField("repeats", span, False)])

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = as_bytes(batch.column(text))
            ids: dict[bytes, int] = {}
            n_words, tokens, lines = [], [], []
            for x in texts:
                words = x.split()
                n_words.append(len(words))
                tokens.extend([ids.setdefault(w, len(ids)) for w in words])
                real = [y for y in x.split(b"\n") if y.strip()]
                lines.append(len(real) - len(set(real)))
            n_words = np.array(n_words, np.int64)
            raw = np.frombuffer(b"".join(texts), np.uint8)
            edge = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
            per_text = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[edge])
            doc = np.repeat(np.arange(len(texts)), n_words)
            first = np.concatenate([[0], np.cumsum(n_words)])
            longest = repeat_lengths(np.array(tokens, np.int64), doc)
            start, end = union_of_spans(longest, doc, least)
            of = doc[start] if len(start) else np.zeros(0, np.int64)
            covered = np.bincount(of, weights=end - start, minlength=len(texts)).astype(np.int64)
            most = np.zeros(len(texts), np.int64)
            np.maximum.at(most, doc, longest)
            spans = pa.StructArray.from_arrays([pa.array(start - first[of], pa.int64()), pa.array(end - first[of], pa.int64())], fields=[pa.field("start", pa.int64(), False), pa.field("end", pa.int64(), False)])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(texts) + 1)), pa.int32()), spans)
            counts = [n_words, per_text(_IN_WORD[raw]), per_text(_SYMBOL[raw]), np.array(lines), covered, most]
            return pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x, pa.int64()) for x in counts), lists], [*batch.schema.names, *names, "repeats"])

        return step

    return map_blocks(df, text, make, schema)


def verdict(n_words="n_words", covered="n_repeat_words", longest="longest_repeat", max_covered=MAX_COVERED, max_longest=MAX_LONGEST, free=LONGEST_FREE):
    """Whether the repeats leave a text fit: their share of the words, and the longest, are within limits."""
    return (F.col(covered) <= max_covered * F.col(n_words)) & (F.col(longest) <= F.greatest(F.lit(float(free)), max_longest * F.col(n_words)))


def op7_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every whole text, whether the base rule drops it, and whether the text is kept."""
    counted = repetition(documents(spark, sf_dir).select("doc_id", "text")).drop("text", "repeats")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict()).drop("longest_repeat")
