"""Which sources of a language use other words than the rest: an audit over mergeable radix tries of terms.

Tasks count the terms of their documents in byte tries, one a language, whose leaves hold the documents of a term and its occurrences
by source.  A trie is cut into prefix ranges and packed; the ranges of all tries meet and are merged range by range, and terms of
too few documents go.  The merged tries are then walked in the order of UTF-8: the walk adds up the divergence of every two sources term by
term, and keeps each source's leading terms, of equal ones the first.
"""

from __future__ import annotations

import gc
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.graph import dense_ids
from .common import blocks, checkpointed, documents, map_arrow

#: Fixed by the task: what a term consists of, the documents a kept term needs at least, the scale of shares, the terms reported for each group.
TERM, LEAST_DOCS, SCALE_STEPS, TOP = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", 10, 3, 10
#: Leaves that a task's tries have at most before they are sent on (between documents), bytes of text that are counted at once, and
#: documents and terms that the bounds of the prefix ranges are taken from; they balance the work, the results don't depend on them.
MOST_LEAVES, COUNT_BYTES, SAMPLE_DOCS, SAMPLE_TERMS = 250_000, 6_000_000, 2_000, 20_000
#: Sources that are compared with as many others in one piece of work, cells of a step of it, and parts that the tries of one language are dealt to.
BLOCK, CELLS, PARTS = 512, 400_000, 64

_BYTE = np.arange(256)
_UPPER, _LOWER = (_BYTE >= 65) & (_BYTE <= 90), (_BYTE >= 97) & (_BYTE <= 122)
_FOLD = np.where(_UPPER, _BYTE + 32, np.where(_LOWER | (_BYTE >= 128), _BYTE, 32)).astype(np.uint8).tobytes()
_DOCS = -1


@contextmanager
def no_collector() -> Iterator[None]:
    """The collector of cycles rests: tries have none, and it would walk through all of their nodes again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def terms_of(text: bytes) -> list[bytes]:
    """Runs of letters A-Z, a-z and characters beyond ASCII, with A-Z lower-cased; UTF-8 keeps those characters apart from ASCII bytes."""
    return text.translate(_FOLD).split()


class RadixTrie:
    """Byte trie with whole labels on its edges.  A node is [label, children by their first byte, leaf]; a leaf maps sources to occurrences, and -1 to documents."""

    __slots__ = ("root", "leaves")

    def __init__(self):
        self.root, self.leaves = [b"", {}, None], 0

    def leaf(self, term: bytes) -> dict[int, int]:
        """The leaf of a term; the nodes it needs are made, and a label that only partly fits is split."""
        node, at, n = self.root, 0, len(term)
        while at < n:
            children = node[1]
            child = children.get(term[at])
            if child is None:
                node = children[term[at]] = [term[at:], {}, None]
                break
            label = child[0]
            if not term.startswith(label, at):
                k = 1
                while at + k < n and term[at + k] == label[k]:  # the label goes on where the term ends or differs
                    k += 1
                upper = children[term[at]] = [label[:k], {label[k]: child}, None]
                child[0] = label[k:]
                child, label = upper, upper[0]
            node = child
            at += len(label)
        if node[2] is None:
            node[2] = {_DOCS: 0}
            self.leaves += 1
        return node[2]

    def walk(self) -> Iterator[tuple[int, bytes, dict[int, int]]]:
        """(bytes shared with the term before, term, leaf) of all terms in the order of their bytes."""
        stack, low = [(self.root, b"")], 0
        while stack:
            node, before = stack.pop()
            low = min(low, len(before))
            term = before + node[0]
            if node[2] is not None:
                yield low, term, node[2]
                low = len(term)
            children = node[1]
            if children:
                stack += [(children[b], term) for b in sorted(children, reverse=True)]

    def absorb(self, packed: bytes, number: list[int]) -> None:
        """Merge a packed trie into this one; ``number`` has this trie's source for each of the other's."""
        shared, length, docs, size, source, count, text = unpack(packed)
        term, at, first = b"", 0, 0
        source = np.array(number, np.int64)[source].tolist() if len(source) else []
        count = count.tolist()
        for s, n, d, k in zip(shared.tolist(), length.tolist(), docs.tolist(), size.tolist()):
            term = term[:s] + text[at : at + n]
            at += n
            leaf = self.leaf(term)
            leaf[_DOCS] += d
            for x, c in zip(source[first : first + k], count[first : first + k]):
                leaf[x] = leaf.get(x, 0) + c
            first += k


def pack(entries: Iterable[tuple[int, bytes, dict[int, int]]]) -> bytes:
    """A walk, or a part of one, as bytes: columns of numbers of the least width, then what each term adds to the one before."""
    shared, length, docs, size, source, count, text = [], [], [], [], [], [], []
    for s, term, leaf in entries:
        s = s if shared else 0  # the first term of a part has nothing before it
        shared.append(s)
        length.append(len(term) - s)
        text.append(term[s:])
        docs.append(leaf[_DOCS])
        size.append(len(leaf) - 1)
        source.extend(leaf)
        count.extend(leaf.values())
    source, count = np.array(source, np.int64), np.array(count, np.int64)
    real = source != _DOCS
    out = []
    for column in (shared, length, docs, size, source[real], count[real]):
        values = np.array(column, np.uint64)
        values = values.astype(np.min_scalar_type(int(values.max())) if len(values) else np.uint8)
        out += [np.array([values.itemsize, len(values)], "<u8").tobytes(), values.astype(values.dtype.newbyteorder("<")).tobytes()]
    return b"".join([*out, *text])


def unpack(packed: bytes) -> tuple[np.ndarray, ...]:
    """Columns of ``pack`` as 64-bit numbers, and the bytes of the terms."""
    columns, at = [], 0
    for _ in range(6):
        width, n = np.frombuffer(packed, "<u8", 2, at).tolist()
        columns.append(np.frombuffer(packed, f"<u{width}", n, at + 16).astype(np.int64))
        at += 16 + width * n
    return (*columns, packed[at:])


def _folded(text: Column) -> Column:
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def prefix_bounds(docs: DataFrame, ranges: int) -> list[tuple[bytes, bytes]]:
    """At most ``ranges`` - 1 pairs of language and term, in order of their bytes, that cut the distinct terms of a bounded sample evenly."""
    rows = docs.count()
    sample = docs.sample(fraction=min(1.0, SAMPLE_DOCS / max(rows, 1)), seed=1)
    terms = checkpointed(sample.select("lang", F.explode(F.array_distinct(F.regexp_extract_all(_folded(F.col("text")), F.lit(TERM), F.lit(0)))).alias("term")).distinct())
    share = min(1.0, SAMPLE_TERMS / max(terms.count(), 1))
    drawn = terms.where(F.pmod(F.xxhash64(F.lit(13), "lang", "term"), F.lit(1 << 30)) < share * (1 << 30)).collect()
    ordered = sorted((r["lang"].encode(), r["term"].encode()) for r in drawn)
    return sorted({ordered[len(ordered) * i // ranges] for i in range(1, ranges)}) if ordered else []


def counted_tries(docs: DataFrame, bounds: list[tuple[bytes, bytes]]) -> DataFrame:
    """range, lang, sources, trie: the packed tries of the tasks, cut at ``bounds``."""

    def send(tries: dict[str, RadixTrie], sources: dict[str, dict[str, int]]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for lang, trie in tries.items():
            names, key = list(sources[lang]), lang.encode()
            part: list = []
            at = bisect_right(bounds, (key, b""))
            nth = at
            for entry in trie.walk():
                if at < len(bounds) and bounds[at] <= (key, entry[1]):
                    at = bisect_right(bounds, (key, entry[1]))
                    if part:
                        rows.append((nth, lang, names, pack(part)))
                        size += len(rows[-1][-1])
                        part = []
                    nth = at
                part.append(entry)
            if part:
                rows.append((nth, lang, names, pack(part)))
        if rows:
            columns = list(zip(*rows))
            for a in range(0, len(rows), 500):
                yield pa.RecordBatch.from_arrays([pa.array(c[a : a + 500], t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.list_(pa.string()), pa.binary()))], ["range", "lang", "sources", "trie"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries: dict[str, RadixTrie] = {}
        sources: dict[str, dict[str, int]] = {}
        leaves: dict[str, dict[bytes, dict[int, int]]] = {}  # the leaves by term, so that a walk from the root is only made for new terms
        found: dict[tuple[str, str], Counter] = {}
        docs_with: dict[str, Counter] = {}
        size = 0

        def add() -> None:
            for lang, counts in docs_with.items():
                trie = tries.get(lang) or tries.setdefault(lang, RadixTrie())
                at = leaves.setdefault(lang, {})
                for term, n in counts.items():
                    leaf = at.get(term)
                    if leaf is None:
                        leaf = at[term] = trie.leaf(term)
                    leaf[_DOCS] += n
            for (lang, source), counts in found.items():
                names = sources.setdefault(lang, {})
                number, at = names.setdefault(source, len(names)), leaves[lang]
                for term, n in counts.items():
                    leaf = at[term]
                    leaf[number] = leaf.get(number, 0) + n
            found.clear()
            docs_with.clear()

        with no_collector():
            for whole in batches:
                for batch in blocks(whole, "text", COUNT_BYTES):
                    for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                        if terms := terms_of(text.encode()):
                            found.setdefault((lang, source), Counter()).update(terms)
                            docs_with.setdefault(lang, Counter()).update(set(terms))
                            size += len(text)
                    if size >= COUNT_BYTES:
                        add()
                        size = 0
                        if sum(t.leaves for t in tries.values()) > MOST_LEAVES:
                            yield from send(tries, sources)
                            tries.clear(), sources.clear(), leaves.clear()
            add()
            yield from send(tries, sources)

    return map_arrow(docs.select("lang", "source", "text"), run, "range int, lang string, sources array<string>, trie binary")


def merged_tries(parts: DataFrame, least_docs: int) -> DataFrame:
    """lang, n_terms, sources, totals, trie: one trie for each language and range, with the terms of at least so many documents, and their occurrences by source.

    A task holds one range of one language at a time.
    """

    def finished(lang: str, trie: RadixTrie, sources: dict[str, int]) -> Iterator[pa.RecordBatch]:
        # a term that goes leaves the ones around it: what they share is the least of what the walk says in between
        kept, low = [], 1 << 60
        totals = [0] * len(sources)
        for shared, term, leaf in trie.walk():
            low = min(low, shared)
            if leaf[_DOCS] >= least_docs:
                kept.append((low, term, leaf))
                low = 1 << 60
                for x, c in leaf.items():
                    if x >= 0:
                        totals[x] += c
        if kept:
            columns = [[lang], [len(kept)], [list(sources)], [totals], [pack(kept)]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary()))], ["lang", "n_terms", "sources", "totals", "trie"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, trie, sources = None, RadixTrie(), {}
        with no_collector():
            for batch in batches:
                for nth, lang, names, packed in zip(*(batch.column(c).to_pylist() for c in ("range", "lang", "sources", "trie"))):
                    if (nth, lang) != now:
                        if now is not None:
                            yield from finished(now[1], trie, sources)
                        now, trie, sources = (nth, lang), RadixTrie(), {}
                    trie.absorb(packed, [sources.setdefault(x, len(sources)) for x in names])
            if now is not None:
                yield from finished(now[1], trie, sources)

    ordered = parts.repartition("range").sortWithinPartitions("range", "lang")
    return map_arrow(ordered, run, "lang string, n_terms long, sources array<string>, totals array<long>, trie binary")


def shares(count: np.ndarray, whole: np.ndarray | int) -> np.ndarray:
    """1 + floor(10**9 * count / whole) in 64-bit integers: three digits at a time, so whole numbers up to 9 * 10**15 stay exact."""
    q, r = count // whole, count % whole
    for _ in range(SCALE_STEPS):
        r = r * 1000
        q, r = q * 1000 + r // whole, r % whole
    return q + 1


def contrast(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def walked(work: DataFrame, top: int) -> DataFrame:
    """lang, source, part, item, value: sums over some tries of the divergence of sources, and leading terms of each, from rows of a trie and two blocks of sources."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pairs, best = None, np.zeros((0, 0), np.int64), {}
        names: tuple[list[str], list[str]] = ([], [])

        def finished() -> Iterator[pa.RecordBatch]:
            if now is None:
                return
            (one, two), same = names, now[1] == now[2]
            i, j = np.nonzero(pairs)
            rows = [(one[a], "pair", two[b].encode(), v) for a, b, v in zip(i.tolist(), j.tolist(), pairs[i, j].tolist())]
            rows += [(two[b], "pair", one[a].encode(), v) for a, b, v in zip(i.tolist(), j.tolist(), pairs[i, j].tolist())]
            rows += [(one[a], "term", term, -v) for a, items in best.items() for v, term in items] if same else []
            for a in range(0, len(rows), 10_000):
                columns = list(zip(*rows[a : a + 10_000]))
                yield pa.RecordBatch.from_arrays([pa.array([now[0]] * len(columns[0])), *(pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.binary(), pa.int64())))], ["lang", "source", "part", "item", "value"])

        for batch in batches:
            for row in batch.to_pylist():
                key = (row["lang"], row["block_a"], row["block_b"])
                if key != now:
                    yield from finished()
                    now, names, best = key, tuple([g["source"] for g in row[x]] for x in ("a", "b")), {}
                    whole = tuple(np.array([g["total"] for g in row[x]], np.int64) + 2 * row["kept"] for x in ("a", "b"))
                    pairs = np.zeros((len(names[0]), len(names[1])), np.int64)
                same = key[1] == key[2]
                shared, length, _, size, source, count, text = unpack(row["trie"])
                edge = np.concatenate([[0], np.cumsum(size)])
                place = [np.array([{s: i for i, s in enumerate(names[x])}.get(s, -1) for s in row["sources"]], np.int64)[source] for x in (0, 1)]
                terms, term, at = [], b"", 0
                for s, n in zip(shared.tolist(), length.tolist()):
                    term = term[:s] + text[at : at + n]
                    at += n
                    terms.append(term)
                step = max(1, CELLS // max(len(names[0]), len(names[1]), 1))
                for first in range(0, len(terms), step):
                    last = min(first + step, len(terms))
                    of = np.repeat(np.arange(last - first), size[first:last])
                    inside = slice(edge[first], edge[last])
                    cells = []
                    for x in (0, 1):
                        cell = np.zeros((last - first, len(names[x])), np.int64)
                        have = place[x][inside] >= 0
                        cell[of[have], place[x][inside][have]] = count[inside][have]
                        cells.append(cell)
                    p, other = shares(cells[0] + 2, whole[0]), shares(cells[1] + 2, whole[1])
                    for i in range(len(names[0])):
                        begin = i + 1 if same else 0
                        pairs[i, begin:] += contrast(p[:, i : i + 1], other[:, begin:]).sum(axis=0)
                    if same:
                        every = np.zeros(last - first, np.int64)
                        np.add.at(every, of, count[inside])
                        q = shares(every[:, None] + 2, row["total"] + 2 * row["kept"])
                        leads = (cells[0] > 0) & (p > q)
                        value = contrast(p, q)
                        for i in np.flatnonzero(leads.any(axis=0)).tolist():
                            at_ = np.flatnonzero(leads[:, i])
                            most = at_[np.argsort(-value[at_, i], kind="stable")[:top]]
                            best[i] = sorted([*best.get(i, []), *((-int(value[k, i]), terms[first + k]) for k in most)])[:top]
        yield from finished()

    return map_arrow(work, run, "lang string, source string, part string, item binary, value long")


def source_divergence(df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = LEAST_DOCS, top: int = TOP, ranges: int | None = None) -> DataFrame:
    """lang, source, part, item, value, rank: what sets each source of a language apart, from every other source (``pair``) and in its leading terms (``term``).

    Null languages, sources and texts count as empty texts.  A row counts as a document, also if it is repeated.  Equal values rank by the bytes of
    the item.  A language without a kept term has pairs of value 0, and one with a single source no pairs.  Other columns of ``df`` are not looked at; an empty table gives no rows.
    The result doesn't depend on ``ranges``, the number of prefix ranges (by default twice the shuffle partitions, at most 4,096).
    """
    spark = df.sparkSession
    plain = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    docs = df.select(plain(lang).alias("lang"), plain(source).alias("source"), plain(text).alias("text"))
    ranges = ranges or min(4096, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    tries = checkpointed(merged_tries(counted_tries(docs, prefix_bounds(docs, ranges)), least_docs))

    # groups with their totals, in blocks of bounded size
    totals = tries.select("lang", F.explode(F.arrays_zip("sources", "totals")).alias("x")).groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.totals").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").select("lang", "source", F.coalesce("total", F.lit(0)).cast("long").alias("total"))
    placed = checkpointed(dense_ids(groups, ["lang", "source"], "place"))
    langs = placed.groupBy("lang").agg(F.min("place").alias("first"), F.sum("total").alias("lang_total"))
    kept = tries.groupBy("lang").agg(F.sum("n_terms").alias("kept"))
    member = F.struct("place", "source", "total")
    in_blocks = placed.join(langs, "lang").groupBy("lang", "lang_total", F.expr(f"(place - first) div {BLOCK}").alias("block")).agg(F.sort_array(F.collect_list(member)).alias("members"))
    two = lambda x: in_blocks.select("lang", *(["lang_total"] if x == "a" else []), F.col("block").alias(f"block_{x}"), F.col("members").alias(x))
    pieces = two("a").join(two("b"), "lang").where("block_a <= block_b").join(kept, "lang").withColumnRenamed("lang_total", "total")
    part = F.pmod(F.xxhash64(F.lit(17), "trie"), F.lit(PARTS))
    dealt = pieces.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
    work = tries.select("lang", "sources", "trie", part.alias("deal")).join(dealt, ["lang", "deal"])
    found = checkpointed(walked(work, top))

    sums = found.where("part = 'pair'").groupBy("lang", "source", F.col("item").cast("string").alias("item")).agg(F.sum("value").alias("value"))
    others = placed.select("lang", F.col("source").alias("item"))
    pairs = placed.select("lang", "source").join(others, "lang").where("source != item").join(sums, ["lang", "source", "item"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    terms = found.where("part = 'term'").select("lang", "source", "part", F.col("item").cast("string").alias("item"), "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return pairs.union(terms).withColumn("rank", rank).where(f"part = 'pair' or rank <= {top}")


#: The same rows by one statement: every kept term by every group, shares in 128-bit integers.
ORACLE_SQL = rf"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT r, lang, source, term, count(*) AS c FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
k AS (SELECT lang, term FROM c GROUP BY ALL HAVING count(*) >= {LEAST_DOCS}),
s AS (SELECT lang, source, term, sum(c) AS c FROM c SEMI JOIN k USING (lang, term) GROUP BY ALL),
f AS (SELECT lang, source, term, CAST(coalesce(c, 0) AS HUGEINT) AS c FROM g JOIN k USING (lang) LEFT JOIN s USING (lang, source, term)),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY 1),
p AS (SELECT lang, source, term, c, 1 + (1000000000 * (c + 2)) // (sum(c) OVER (PARTITION BY lang, source) + 2 * v) AS p FROM f JOIN v USING (lang)),
l AS (SELECT lang, term, sum(c) AS c FROM f GROUP BY ALL),
q AS (SELECT lang, term, 1 + (1000000000 * (c + 2)) // (sum(c) OVER (PARTITION BY lang) + 2 * v) AS q FROM l JOIN v USING (lang)),
two AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN two t ON t.lang = a.lang AND t.source = a.source AND t.item = b.source
UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM o) WHERE part = 'pair' OR rank <= {TOP}"""


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lang, source, part, item, value, rank over all documents."""
    return source_divergence(documents(spark, sf_dir))
