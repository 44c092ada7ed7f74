"""N-gram Jaccard join by T-occurrence search, and the groups it links.

A text's set holds the hashes of its distinct word shingles.  Sets that are equal form a class; only classes are compared.
Two sets of n and m shingles must share at least T = ceil(s (n + m) / (1 + s)); a set's n - ceil(s n) + 1 rarest shingles are its
lists, and what the other shingles can add to an overlap is bounded by their number (``rest``).

1. Of each list the two classes whose lists are longest on average are its centres, and a class is compared with up to ``CENTRES`` of
   those that most of its lists have.  An original is in all the lists of its copies, so it becomes their centre.
2. A centre with many classes is their home c.  Their sets are told by what differs from c, D = set xor c: two of them link
   if |D_x xor D_y| = |set_x xor set_y| is small enough, so they must share part of their differences, and differences are rarely
   shared by many.  So a group of near copies, linked or not, isn't paired within the lists that it has in common.
3. T-occurrence search of what is left: between homes by the lists of the sets, within a home by the lists of the differences.
   A task gets the lists that meet a block of sets of one home.  DivideSkip takes the longest L of a set's lists, L being what the least threshold
   allows, merges the others with a heap, and probes the long ones by binary search for those that reach the threshold less L.
   Pairs that reach the threshold are tested on the whole sets, after an exact bound by counts of shingles in 256 parts of the hash space.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import as_bytes, blocks, checkpointed, documents, hash_words, map_arrow, map_blocks, mix, most_frequent, released, stored, windows
from .graph import KeyFilter, components, maybe_in

#: Words of a shingle, and the least similarity as a ratio of integers.
SHINGLE, SIMILAR = 5, (75, 100)
#: Centres a class is compared with, and the share of its lists that must have one; shingles that are put last as the most frequent (a bound of what is broadcast).
CENTRES, VOTES, FREQUENT = 3, 0.1, 65_536
#: Entries of a list that are looked at two by two at most.
SHORT = 64
#: Classes from which on a centre is a home, sets of a block, and entries of a part of a list, on average.
HOME, BLOCK, PART = 16, 512, 4096
#: A shingle is counted towards the frequent ones where a slice of texts has it so often; shingles of a slice.
OFTEN, COUNTED = 3, 1 << 21


def shingle_sets(texts: list[bytes], cache: dict[bytes, int], width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, A-Z in lower case; a shorter text is one shingle, one without words has none."""
    words = [x.lower().split() for x in texts]
    length = [len(x) for x in words]
    h = hash_words([w for x in words for w in x], cache)
    grams = windows(h, width)
    out, at = [], 0
    for n in length:
        if n >= width:
            g = np.sort(grams[at : at + n - width + 1])
            out.append(g[np.concatenate([[True], g[1:] != g[:-1]])])
        elif n:
            with np.errstate(over="ignore"):
                out.append(mix(windows(h[at : at + n], n) + np.uint64(n)))
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out


def _signature(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def _sketch(s: np.ndarray) -> bytes:
    """Shingles in each 256th of the hash space, 255 at most: the overlap of two sets is not above the sum of the smaller counts."""
    return np.minimum(np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=256), 255).astype(np.uint8).tobytes()


def _may_link(pairs: DataFrame, sketches: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) that their sketches don't rule out; exact, as the bound is, and far smaller than the sets."""
    up, low = similar
    both = pairs.join(sketches.withColumnsRenamed({"node": "a", "sketch": "sketch_a"}), "a").join(sketches.withColumnsRenamed({"node": "b", "sketch": "sketch_b"}), "b")

    def bound(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, 256).astype(np.int64) for c in ("sketch_a", "sketch_b"))
            common = np.minimum(x, y).sum(axis=1)
            keep = low * common >= up * (x.sum(axis=1) + y.sum(axis=1) - common)
            yield batch.filter(pa.array(keep | ((x == 255) | (y == 255)).any(axis=1))).select(["a", "b"])

    return map_arrow(both.select("a", "b", "sketch_a", "sketch_b"), bound, "a long, b long")


def often(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that ``OFTEN`` sets or more have, and how many."""
    every = np.concatenate(sets)
    every.sort()
    new = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.empty(0, int)
    count = np.diff(np.append(new, len(every)))
    return every[new[count >= OFTEN]], count[count >= OFTEN]


def _summaries(df: DataFrame) -> DataFrame:
    """A row for each text: hash of the text, signature, size and sketch of its set; and rows of counts of shingles a slice has often.

    A slice has ``COUNTED`` shingles, so that what a small share of all texts has in common is counted somewhere, however many texts there are.
    """
    id_type = df.schema["row_id"].dataType.simpleString()

    def counts(sets: list[np.ndarray], row_id: pa.DataType) -> pa.RecordBatch:
        shingles, count = often(sets)
        k = len(shingles)
        columns = [pa.nulls(k, row_id), pa.nulls(k, pa.int64()), pa.array(shingles.view(np.int64)), pa.array(count, pa.int64()), pa.array(np.ones(k, bool)), pa.nulls(k, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["row_id", "text_hash", "node", "n", "is_count", "sketch"])

    def run(batches):
        cache: dict[bytes, int] = {}
        held, size, kind = [], 0, None
        for batch in batches:
            for part in blocks(batch, "text"):
                sets = shingle_sets(as_bytes(part.column("text")), cache)
                kind = part.schema.field("row_id").type
                columns = [
                    part.column("row_id"),
                    part.column("text_hash"),
                    pa.array([_signature(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(np.zeros(len(sets), bool)),
                    pa.array([_sketch(s) if len(s) else None for s in sets], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["row_id", "text_hash", "node", "n", "is_count", "sketch"])
                held += sets
                size += sum(map(len, sets))
                if size >= COUNTED:
                    yield counts(held, kind)
                    held, size = [], 0
        if held:
            yield counts(held, kind)

    return map_arrow(df, run, f"row_id {id_type}, text_hash long, node long, n long, is_count boolean, sketch binary")


def _prefix_rows(df: DataFrame, frequent: np.ndarray, similar: tuple[int, int]) -> DataFrame:
    """shingle, node, n for the short lists of each set, copies within a slice once."""
    by = np.argsort(frequent)
    sent = df.sparkSession.sparkContext.broadcast((frequent[by], by))
    up, low = similar

    def make():
        cache: dict[bytes, int] = {}
        keys, rank = sent.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            grams, nodes, sizes, seen = [], [], [], set()
            for s in shingle_sets(as_bytes(batch.column("text")), cache):
                n = len(s)
                node = _signature(s) if n else None
                if n == 0 or (node, n) in seen:
                    continue
                seen.add((node, n))
                take = n - -(-up * n // low) + 1
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
                    hit = keys[at] == s
                    if hit.any():
                        s = np.concatenate([s[~hit], s[hit][np.argsort(rank[at[hit]])]])
                grams.append(s[:take])
                nodes.append(np.full(take, node, np.int64))
                sizes.append(np.full(take, n, np.int32))
            parts = [np.concatenate(x) if x else np.empty(0, t) for x, t in ((grams, np.uint64), (nodes, np.int64), (sizes, np.int32))]
            return pa.RecordBatch.from_arrays([pa.array(parts[0].view(np.int64)), pa.array(parts[1]), pa.array(parts[2])], ["shingle", "node", "n"])

        return step

    return map_blocks(df.select("text"), "text", make, "shingle long, node long, n int")


def hopeful(n: np.ndarray, met: np.ndarray, size: np.ndarray, similar: tuple[int, int]) -> np.ndarray:
    """Which entries of short lists, one after the other and of the given sizes, have another one beside them that may link.

    ``n`` is the size of an entry's set, ``met`` the number of its lists that other sets have, too: two sets may only link if both are
    in as many lists as the least overlap of their lists asks for.
    """
    up, low = similar
    first = np.repeat(np.cumsum(size) - size, size)
    each = np.repeat(size, size)
    a = np.repeat(np.arange(len(n)), each)
    b = np.arange(len(a)) - np.repeat(np.cumsum(each) - each, each) + first[a]
    rest = -(-up * n // low) - 1
    needed = -(-up * (n[a] + n[b]) // (up + low)) - np.maximum(rest[a], rest[b])
    good = (a != b) & (up * np.maximum(n[a], n[b]) <= low * np.minimum(n[a], n[b])) & (needed <= np.minimum(met[a], met[b]))
    return np.bincount(a[good], minlength=len(n)) > 0


def _hopeful_entries(lists: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """shingle, node, n, size of the entries that may lead to a link; lists of more than ``SHORT`` entries stay whole."""
    met = lists.groupBy("node").agg(F.count(F.lit(1)).cast("int").alias("met"))
    known = lists.join(met, "node")
    short = known.where(F.col("size") <= SHORT).groupBy("shingle").agg(F.collect_list(F.struct("node", "n", "met")).alias("own"))

    def run(batches):
        for batch in batches:
            own = batch.column("own")
            flat, size = own.flatten(), np.diff(own.offsets.to_numpy())
            node, n, met = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("node", "n", "met"))
            keep = hopeful(n.astype(np.int64), met.astype(np.int64), size, similar)
            shingle = np.repeat(batch.column("shingle").to_numpy(), size)
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (shingle, node, n.astype(np.int32), np.repeat(size, size).astype(np.int64))], ["shingle", "node", "n", "size"])

    return map_arrow(short, run, "shingle long, node long, n int, size long").union(known.where(F.col("size") > SHORT).select("shingle", "node", "n", "size"))


def _sets_of(df: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, shingles (packed, sorted) of the wanted classes, from one text of each (``text_hash``)."""

    def make():
        cache: dict[bytes, int] = {}

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = {_signature(s): s.tobytes() for s in shingle_sets(as_bytes(batch.column("text")), cache) if len(s)}
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())], ["node", "shingles"])

        return step

    near = maybe_in(df.select("text_hash", "text"), "text_hash", KeyFilter(wanted, "text_hash"))
    return map_blocks(near, "text", make, "node long, shingles binary").dropDuplicates(["node"])


def differences(x: np.ndarray, c: np.ndarray, linked: bool, similar: tuple[int, int]) -> tuple[int, np.ndarray]:
    """Size of x xor c, and its lists towards the other sets compared with c: what c lacks comes first.

    Two sets that both link with c need no test of each other.  If x links with c, its partners don't, and if not, they may be any.
    In both cases the least overlap of differences follows from the sizes; what is above it has to be listed, plus one.
    """
    up, low = similar
    q, r = low + up, low - up
    own, lost = np.setdiff1d(x, c, assume_unique=True), np.setdiff1d(c, x, assume_unique=True)
    d, n, m = len(own) + len(lost), len(x), len(c)
    if linked:
        least = (q * d + r * (m - n)) // (2 * q) + 1
    else:
        other = max(0, -(-(q * d - r * (n + m)) // (q + r)))  # the partner's difference at least
        least = max(1, -(-(q * d + (q - r) * other - r * (n + m)) // (2 * q)))
    return d, np.concatenate([own, lost])[: max(0, d - least + 1)]


def _compared(pairs: DataFrame, classes: DataFrame, df: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """For pairs (a, b, at_home), which are read twice: a, b, linked, n, d, lists; the shingles of one set are probed in the other.

    With at_home, d and lists (packed) tell the difference of a from b; they are null otherwise.
    """
    up, low = similar
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = checkpointed(classes.join(ends, "node").select("text_hash"))
    sets = _sets_of(df, wanted)
    both = pairs.join(sets.withColumnsRenamed({"node": "a", "shingles": "set_a"}), "a").join(sets.withColumnsRenamed({"node": "b", "shingles": "set_b"}), "b")

    def probe(batches):
        for batch in batches:
            linked, n, d, lists = [], [], [], []
            for x, y, home in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), batch.column("at_home").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                p, q = (x, y) if len(x) <= len(y) else (y, x)
                common = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum())
                linked.append(low * common >= up * (len(p) + len(q) - common))
                n.append(len(x))
                size, own = differences(x, y, linked[-1], similar) if home else (None, None)
                d.append(size)
                lists.append(own.tobytes() if home else None)
            columns = [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_()), pa.array(n, pa.int32()), pa.array(d, pa.int32()), pa.array(lists, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "linked", "n", "d", "lists"])

    return map_arrow(both.select("a", "b", "at_home", "set_a", "set_b"), probe, "a long, b long, linked boolean, n int, d int, lists binary")


def _unpacked(told: DataFrame) -> DataFrame:
    """key, node, n, d, rest, home, inner for each difference that is listed; the key holds the home."""

    def run(batches):
        for batch in batches:
            lists = [np.frombuffer(x, np.uint64) for x in batch.column("lists").to_pylist()]
            size = np.array([len(x) for x in lists], np.int64)
            col = lambda c, t: np.repeat(batch.column(c).to_numpy().astype(t), size)
            home, d = col("b", np.int64), col("d", np.int32)
            with np.errstate(over="ignore"):
                key = mix(np.concatenate([*lists, np.empty(0, np.uint64)]) + mix(home.view(np.uint64)))
            columns = [key.view(np.int64), col("a", np.int64), col("n", np.int32), d, d - np.repeat(size, size).astype(np.int32), home]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["key", "node", "n", "d", "rest", "home"])

    return map_arrow(told.where("d is not null").select("a", "b", "n", "d", "lists"), run, "key long, node long, n int, d int, rest int, home long").withColumn("inner", F.lit(True))


_FIELDS = ("node", "component", "home", "n", "d", "rest")


def divide_skip(lists: list[list[int]], needed: dict[int, int]) -> list[int]:
    """The ids that as many of the sorted lists hold as ``needed`` asks for, at least one; ids without an entry there are not sought.

    With the least number asked for, t, the t - 1 longest lists are not merged: an id is in one of the others at least, and is then
    looked up in the long ones.
    """
    least = min(needed.values())
    lists = sorted(lists, key=len)
    cut = max(0, len(lists) - least + 1)
    short, long = lists[:cut], lists[cut:]
    out, last, count = [], -1, 0

    def settle() -> None:
        total, most = count, needed.get(last)
        if most is None or total + len(long) < most:
            return
        for own in long:
            at = bisect_left(own, last)
            total += at < len(own) and own[at] == last
        if total >= most:
            out.append(last)

    for x in heapq.merge(*short):
        if x == last:
            count += 1
        else:
            settle()
            last, count = x, 1
    settle()
    return out


def searched(inner: np.ndarray, sets: list[dict[str, np.ndarray]], lists: list[dict[str, np.ndarray]], similar: tuple[int, int]) -> tuple[list[int], list[int]]:
    """Pairs (a, b) that reach the threshold: for each list that meets the block, the block's sets in it and all of its sets.

    Pairs of one component are not sought, nor those of one home outside its own (``inner``) lists; of other pairs the smaller set searches.
    """
    up, low = similar
    q, r = low + up, low - up
    a_out: list[int] = []
    b_out: list[int] = []
    for kind in (False, True):
        rows = np.flatnonzero(inner == kind)
        if not len(rows):
            continue
        every = {k: np.concatenate([lists[i][k] for i in rows]) for k in _FIELDS}
        nodes, first = np.unique(every["node"], return_index=True)
        component, home, n, d, rest = (every[k][first].astype(np.int64) for k in _FIELDS[1:])
        own = {k: np.concatenate([sets[i][k] for i in rows]) for k in _FIELDS}
        of = np.repeat(rows, [len(sets[i]["node"]) for i in rows])
        by = np.argsort(own["node"], kind="stable")
        cut = np.flatnonzero(np.diff(own["node"][by])) + 1
        ids: dict[int, list[int]] = {}
        for group in np.split(by, cut):
            node, c, h, size, diff, left = (int(own[k][group[0]]) for k in _FIELDS)
            ok = (component != c) & ((home == h) == kind) & ((n > size) | ((n == size) & (nodes > node)))
            ok &= up * np.maximum(n, size) <= low * np.minimum(n, size)
            some = np.flatnonzero(ok)
            if len(some):
                needed = -(-(q * (d[some] + diff) - r * (n[some] + size)) // (2 * q)) - np.maximum(rest[some], left)
                near = needed <= len(group)
                some, needed = some[near], np.maximum(needed[near], 1)
            if len(some):
                at = of[group].tolist()
                for i in at:
                    if i not in ids:
                        ids[i] = np.sort(np.searchsorted(nodes, lists[i]["node"])).tolist()
                hits = divide_skip([ids[i] for i in at], dict(zip(some.tolist(), needed.tolist())))
                a_out += [node] * len(hits)
                b_out += nodes[hits].tolist()
    return a_out, b_out


def _search(entries: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Candidate pairs (a, b) from list entries (key, inner, block, and the fields of a set); lists of one component, or of one home and not inner, are left out.

    A list goes to each block that has a set in it, so sets that have long lists in common should have one block (``near_lists``).
    """
    ends = entries.groupBy("key", "inner").agg(
        F.min("component").alias("c0"), F.max("component").alias("c1"), F.min("home").alias("h0"), F.max("home").alias("h1"), F.count(F.lit(1)).alias("size")
    )
    open_ = ends.where("c0 < c1 and (inner or h0 < h1)").select("key", "inner", "size")
    entries = stored(entries.join(open_, ["key", "inner"]), "entries")
    most, sets = entries.agg(F.coalesce(F.max("size"), F.lit(0)), F.approx_count_distinct("node")).first()
    slices = 1 << max(0, (most // PART).bit_length())
    spread = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "node"), F.lit(n))
    bounded = F.pmod("block", F.lit(max(1, sets // BLOCK)))  # of sets without a home
    placed = entries.withColumn("block", F.when(F.col("home") == F.col("node"), bounded).otherwise(F.col("block")))
    fields = F.struct(*_FIELDS)
    queries = placed.groupBy("key", "inner", "block").agg(F.collect_list(fields).alias("sets"))
    lists = entries.groupBy("key", "inner", spread(23, slices).alias("slice")).agg(F.collect_list(fields).alias("list"))
    met = queries.join(lists, ["key", "inner"]).select("block", "slice", "inner", "sets", "list")
    dealt = met.repartition("block", "slice").sortWithinPartitions("block", "slice")

    def unpacked(column: pa.ListArray) -> list[dict[str, np.ndarray]]:
        flat = column.flatten()
        edge = column.offsets.to_numpy() - column.offsets[0].as_py()
        parts = {k: flat.field(k).to_numpy(zero_copy_only=False) for k in _FIELDS}
        return [{k: v[a:b] for k, v in parts.items()} for a, b in zip(edge, edge[1:])]

    def run(batches):
        key, inner, sets_, lists_ = None, [], [], []

        def result():
            a, b = searched(np.array(inner), sets_, lists_, similar)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            for own, kind, x, y in zip(zip(batch.column("block").to_pylist(), batch.column("slice").to_pylist()), batch.column("inner").to_pylist(), unpacked(batch.column("sets")), unpacked(batch.column("list"))):
                if own != key and key is not None:
                    yield result()
                    inner, sets_, lists_ = [], [], []
                key = own
                inner.append(kind)
                sets_.append(x)
                lists_.append(y)
        if key is not None:
            yield result()

    found = stored(map_arrow(dealt, run, "a long, b long"), "candidates")
    released(entries)
    return found


def near_lists(entries: DataFrame) -> DataFrame:
    """``entries`` (key, node, size of the list, block or null) with a block for the sets that have none: that of their longest list, dealt out in parts of ``BLOCK`` sets.

    So a list of m sets goes to about m / ``BLOCK`` blocks, and not to one for each of its sets.
    """
    longest = F.max(F.struct("size", "key")).over(Window.partitionBy("node"))
    part = F.pmod(F.xxhash64(F.lit(21), "node"), F.ceil(F.col("longest.size") / BLOCK))
    return entries.withColumn("longest", longest).withColumn("block", F.coalesce("block", F.xxhash64("longest.key", part))).drop("longest", "size")


def jaccard_groups(df: DataFrame, row_id: str = "doc_id", text: str = "text", similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """``row_id``, n_shingles, component_id and class_id for each row of ``df``.

    Rows link when the Jaccard similarity of their shingle sets is at least the ratio ``similar``; ``component_id`` is the
    smallest row id that links reach, ``class_id`` the signature of the set (null without words), so that rows of
    one class have equal sets.  Null and empty texts have no shingles and stay alone.  Repeated rows are
    linked with each other; a null row id is kept, and reached only by other ids' links.
    All links between different classes that matter for a component are tested exactly.
    """
    up, low = similar
    df = df.select(F.col(row_id).alias("row_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"))
    found = checkpointed(_summaries(df))
    rows = found.where("not is_count").drop("is_count", "sketch")
    sketches = found.where("n > 0 and not is_count").groupBy("node").agg(F.min("sketch").alias("sketch"))
    classes = checkpointed(rows.where("n > 0").groupBy("node", "n").agg(F.min("row_id").alias("first_id"), F.min("text_hash").alias("text_hash")))

    # short lists of two classes or more
    counted = most_frequent(found.where("is_count").groupBy("node").agg(F.sum("n").alias("n")), FREQUENT).toPandas().sort_values(["n", "node"])
    frequent = counted["node"].to_numpy(np.int64).view(np.uint64)  # the most frequent one last
    same = Window.partitionBy("shingle")
    lists = _prefix_rows(df, frequent, similar).withColumns({"lo": F.min("node").over(same), "hi": F.max("node").over(same)}).where("lo < hi")
    whole = stored(lists.select("shingle", "node", "n").distinct().withColumn("size", F.count(F.lit(1)).over(same)), "lists")
    lists = stored(_hopeful_entries(whole, similar), "hopeful")
    released(whole)

    # centres and homes
    fits = lambda x, y: (low * F.least(x, y) >= up * F.greatest(x, y))
    rest = F.ceil(F.lit(up) * F.col("n") / F.lit(low)) - 1
    short = F.col("n") - rest
    popular = lists.groupBy("node").agg((F.sum("size") / F.max(short)).alias("popularity"))
    place = F.row_number().over(same.orderBy(F.desc("popularity"), "node"))
    centres = lists.join(popular, "node").withColumn("place", place).where("place <= 2").select("shingle", F.col("node").alias("b"), F.col("n").alias("nb"))
    votes = lists.join(centres, "shingle").where((F.col("node") != F.col("b")) & fits(F.col("n"), F.col("nb"))).groupBy("node", "n", "b").agg(F.count(F.lit(1)).alias("votes"))
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("votes"), "b"))
    star = checkpointed(votes.where(F.col("votes") >= VOTES * short).withColumn("place", place).where(F.col("place") <= CENTRES).select(F.col("node").alias("a"), "b", "place"))
    hosts = star.where("place = 1").groupBy("b").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") >= HOME)
    part = F.pmod(F.xxhash64(F.lit(22), "a"), F.ceil(F.col("m") / BLOCK))
    at_home = checkpointed(star.where("place = 1").join(hosts, "b").join(hosts.select(F.col("b").alias("a")), "a", "left_anti").select("a", "b", F.xxhash64("b", part).alias("block")))
    others = _may_link(star.join(at_home, ["a", "b"], "left_anti").select("a", "b"), sketches, similar)
    known = checkpointed(at_home.select("a", "b", F.lit(True).alias("at_home")).union(others.withColumn("at_home", F.lit(False))))
    told = checkpointed(_compared(known, classes, df, similar))
    links = told.where("linked").select("a", "b")
    groups = checkpointed(components(links))

    # T-occurrence search between groups
    homes = at_home.select(F.col("a").alias("node"), F.col("b").alias("home"), "block")
    of_sets = lists.select(F.col("shingle").alias("key"), "node", "n", F.col("n").alias("d"), rest.cast("int").alias("rest"), F.lit(False).alias("inner"), "size")
    of_sets = near_lists(of_sets.join(homes, "node", "left").join(groups, "node", "left")).withColumn("home", F.coalesce("home", "node"))
    every = of_sets.unionByName(_unpacked(told).join(homes.select("node", "block"), "node").join(groups, "node", "left")).withColumn("component", F.coalesce("component", "node"))
    candidates = _search(every, similar)
    released(lists)
    cross = checkpointed(_may_link(candidates, sketches, similar))
    released(candidates)
    links = links.union(_compared(cross.withColumn("at_home", F.lit(False)), classes, df, similar).where("linked").select("a", "b"))
    groups = checkpointed(components(links))

    ids = classes.select("node", "n", "first_id").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = ids.groupBy("component").agg(F.min("first_id").alias("component_id"))
    ids = ids.join(smallest, "component").select("node", "n", "component_id")
    out = rows.select("row_id", "node", "n").join(ids, ["node", "n"], "left")
    return out.select(F.col("row_id").alias(row_id), F.col("n").alias("n_shingles"), F.coalesce("component_id", "row_id").alias("component_id"), F.col("node").alias("class_id"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id of every whole text: five words, similarity 0.75 or more."""
    return jaccard_groups(documents(spark, sf_dir).select("doc_id", "text")).drop("class_id")
