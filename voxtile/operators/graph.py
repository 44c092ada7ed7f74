"""Voxel graphs: skeleton edges, nodes and edges with dense ids, connected components."""

from __future__ import annotations

import itertools
import tempfile
import uuid
from collections.abc import Iterable
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expressions import affine, norm
from ..sources.tables import concatenated, require_columns
from .tiles import AXES, TILE, Block, tiled

VOXEL = ("vox_x", "vox_y", "vox_z")
EDGE_COLUMNS = ["channel", *(f"{e}_{v}" for e in ("src", "dst") for v in VOXEL), *(f"{e}_{a}" for e in ("src", "dst") for a in "xyz"), "src_radius", "dst_radius", "edge_length"]


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which all executors share; a local session without it, as in tests, gets one of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="voxtile-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


@contextmanager
def _short_lived(df: DataFrame):
    """``df``, planned so that the files of its shuffles go as soon as an action on it ends, not when the driver happens to collect its garbage."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        yield df.select("*")
    finally:
        conf.set(key, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable copy of ``df`` in the shared folder, without lineage; its shuffles leave no files."""
    shared_folder(df.sparkSession)
    with _short_lived(df) as own:
        return own.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again; its shuffles leave no files."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}.parquet"
    with _short_lived(df) as own:
        own.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def released(*tables: DataFrame) -> None:
    """Remove the files of ``stored`` tables that nothing reads any more."""
    for table in tables:
        context = table.sparkSession.sparkContext
        for folder in {x.rpartition("/")[0] for x in table.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI(folder))
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def star_round(edges: DataFrame) -> DataFrame:
    """A large-star and a small-star round on distinct edges u > v; both ends of an edge come from one row, so that nothing is planned twice for a union."""
    ends = lambda *pairs: F.inline(F.array(*[F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in pairs]))
    least = edges.select(ends(("u", "v"), ("v", "u"))).groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = edges.join(least.withColumnRenamed("u", "v"), "v").select("u", F.col("m").alias("v"))  # a row an edge
    pairs = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
    return pairs.select(ends(("v", "m"), ("u", "m"))).where("u != v").distinct()


def star_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """u, v for each linked node u that isn't the smallest of its group, with the smallest one v; ``edges`` has u > v.

    Large-star and small-star rounds (Kiveris et al., 2014), each two aggregations and joins on nodes, until the count and a hash sum of
    the edges stay; the rounds grow about as the logarithm of the largest group.
    """
    edges, state = checkpointed(edges.distinct()), None
    for _ in range(most_rounds):
        edges, before = checkpointed(star_round(edges)), state
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges
        edges = edges.coalesce(max(1, state[0] // 50_000))  # few edges in many partitions would cost a file each in every shuffle
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def dense_ids(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """0, 1, 2... in a total order: ranges are sorted, numbered by themselves and written, then shifted by the rows before them.

    Only the number of rows of each range meets in one task.  Equal rows get neighbouring numbers.
    """
    numbered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    path = f"{shared_folder(df.sparkSession)}/ranges-{uuid.uuid4().hex}"
    numbered.write.parquet(path)
    ranged = df.sparkSession.read.schema(numbered.schema).parquet(path)
    part = F.shiftright("_at", 33)  # the range; the other bits count its rows
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.select("_part", F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    out = ranged.withColumn("_part", part).join(F.broadcast(before), "_part")  # a row for each range
    return out.withColumn(name, (F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).cast("long")).drop("_part", "_before", "_at")


_LATER = [d for d in itertools.product((-1, 0, 1), repeat=3) if d > (0, 0, 0)]


def _tile_edges(names: list[str]):
    """Function of a tile: its voxels with those of their 13 later neighbours that are there, and the values of both."""

    def step(block: Block) -> dict[str, np.ndarray]:
        src, dst = [], []
        core = block.core
        own = np.argwhere(block.there[core]) + np.array(block.halo)
        for d in _LATER:
            beside = own + np.array(d)
            both = block.there[tuple(beside.T)]
            src.append(own[both])
            dst.append(beside[both])
        src, dst = np.concatenate(src), np.concatenate(dst)
        out = {f"{e}_v{a}": x[:, i] + block.low[i] for e, x in (("src", src), ("dst", dst)) for i, a in enumerate("xyz")}
        return out | {f"{e}_{n}": block.values[n][tuple(x.T)] for e, x in (("src", src), ("dst", dst)) for n in names}

    return step


def _tile_ends(names: list[str]):
    """Function of a tile: its voxels that touch another one, with their values."""

    def step(block: Block) -> dict[str, np.ndarray]:
        own = np.argwhere(block.there[block.core]) + np.array(block.halo)
        touching = np.zeros(len(own), bool)
        for d in [*_LATER, *(tuple(-x for x in d) for d in _LATER)]:
            touching |= block.there[tuple((own + np.array(d)).T)]
        own = own[touching]
        return {a: own[:, i] + block.low[i] for i, a in enumerate(AXES)} | {n: block.values[n][tuple(own.T)] for n in names}

    return step


def _placed(skeleton: DataFrame) -> DataFrame:
    """channel, vx, vy, vz, the radius without its sign, and whether it is NULL; voxels without a place or channel touch none."""
    where = skeleton.where(" and ".join(f"{c} is not null" for c in ("channel", *VOXEL)))
    radius = F.abs("radius").cast("double")
    return where.select("channel", *[F.col(v).alias(a) for v, a in zip(VOXEL, AXES)], F.coalesce(radius, F.lit(0.0)).alias("radius"), radius.isNull().alias("none"))


def skeleton_edges(skeleton: DataFrame, matrix: list[list[float]], tile: int | tuple[int, int, int] = TILE) -> DataFrame:
    """Edge list of a skeleton: a row for each two voxels (of one channel) that touch, by face, edge or corner.

    ``skeleton`` has channel, vox_x, vox_y, vox_z and radius; repeated voxels count once.  Of the 26 neighbours the 13 that come later in (x, y, z) order
    are looked up in tiles with a halo, so each edge appears once, from the smaller voxel on.  A skeleton without neighbours gives no rows.
    """
    columns = ", ".join([f"{e}_v{a} long" for e in ("src", "dst") for a in "xyz"] + [f"{e}_radius double, {e}_none boolean" for e in ("src", "dst")])
    found = tiled(_placed(skeleton), _tile_edges(["radius", "none"]), columns, 1, tile, ("channel",))
    kinds = {c: skeleton.schema[c].dataType for c in (*VOXEL, "radius")}
    edges = found.select(
        "channel", *[F.col(f"{e}_v{v[-1]}").cast(kinds[v]).alias(f"{e}_{v}") for e in ("src", "dst") for v in VOXEL],
        *[F.when(~F.col(f"{e}_none"), F.col(f"{e}_radius")).cast(kinds["radius"]).alias(f"{e}_radius") for e in ("src", "dst")],
    )
    return _measured(edges, matrix).select(*EDGE_COLUMNS)


def _measured(edges: DataFrame, matrix: list[list[float]]) -> DataFrame:
    """Add the positions of both ends and edge_length."""
    for e in ("src", "dst"):
        edges = edges.withColumns({f"{e}_{a}": c for a, c in zip("xyz", affine(matrix, *[F.col(f"{e}_{v}") for v in VOXEL]))})
    return edges.withColumn("edge_length", norm(*[F.col(f"dst_{a}") - F.col(f"src_{a}") for a in "xyz"]))


def skeleton_nodes(skeleton: DataFrame, matrix: list[list[float]], tile: int | tuple[int, int, int] = TILE) -> DataFrame:
    """What ``nodes_of(skeleton_edges(...))`` gives, without the edges: the voxels that touch another one, numbered."""
    ends = tiled(_placed(skeleton), _tile_ends(["radius", "none"]), "vx long, vy long, vz long, radius double, none boolean", 1, tile, ("channel",))
    nodes = dense_ids(ends, ["channel", "vz", "vy", "vx"], "node_id")
    at = affine(matrix, *[F.col(a) for a in AXES])
    return nodes.select("node_id", "channel", *[F.col(a).cast(skeleton.schema[v].dataType).alias(v) for v, a in zip(VOXEL, AXES)], *[c.alias(a) for a, c in zip("xyz", at)], F.when(~F.col("none"), F.col("radius")).alias("radius"))


def skeleton_graph_edges(nodes: DataFrame, matrix: list[list[float]], tile: int | tuple[int, int, int] = TILE) -> DataFrame:
    """What ``edges_with_nodes(skeleton_edges(...), nodes)`` gives, from the nodes of a skeleton alone: tiles know the numbers of both ends, so nothing is joined."""
    placed = nodes.select("channel", *[F.col(v).alias(a) for v, a in zip(VOXEL, AXES)], "node_id")
    columns = ", ".join([f"{e}_v{a} long" for e in ("src", "dst") for a in "xyz"] + ["src_node_id long", "dst_node_id long"])
    found = tiled(placed, _tile_edges(["node_id"]), columns, 1, tile, ("channel",))
    order, voxel = ["channel", "src_node_id", "dst_node_id"], [f"{e}_{v}" for e in ("src", "dst") for v in VOXEL]
    named = found.select(*order, *[F.col(f"{e}_v{v[-1]}").cast(nodes.schema[v].dataType).alias(f"{e}_{v}") for e in ("src", "dst") for v in VOXEL])
    return _measured(dense_ids(named, order, "edge_id"), matrix).select("edge_id", *order, "edge_length", *voxel)


def distinct_edges(edges: DataFrame) -> DataFrame:
    """One row for each channel and pair of voxels."""
    return edges.dropDuplicates(["channel", *(f"{e}_{v}" for e in ("src", "dst") for v in VOXEL)])


def edges_of_blocks(spark: SparkSession, blocks: Iterable[DataFrame | None]) -> DataFrame:
    """One edge list from the edge tables of blocks, ordered by channel and voxels; an edge that blocks share stays once.

    Blocks may be None or empty, and may lack columns (NULL).  Without any there is an empty table with all columns.
    """
    kinds = {**dict.fromkeys(EDGE_COLUMNS, "double"), **{f"{e}_{v}": "long" for e in ("src", "dst") for v in VOXEL}, "channel": "long"}
    every = concatenated(spark, blocks, ", ".join(f"{c} {kinds[c]}" for c in EDGE_COLUMNS))
    return distinct_edges(every).orderBy("channel", *(f"{e}_{v}" for e in ("src", "dst") for v in VOXEL))


def nodes_of(edges: DataFrame) -> DataFrame:
    """node_id, channel, voxel, mean position and mean radius of every end of an edge."""
    require_columns(edges, EDGE_COLUMNS)
    end = lambda e: F.struct(*[F.col(f"{e}_{c}").alias(c) for c in (*VOXEL, *"xyz", "radius")])
    ends = edges.select("channel", F.explode(F.array(end("src"), end("dst"))).alias("e")).select("channel", "e.*")
    nodes = ends.groupBy("channel", *VOXEL).agg(*[F.avg(c).alias(c) for c in (*"xyz", "radius")])
    return dense_ids(nodes, ["channel", "vox_z", "vox_y", "vox_x"], "node_id").select("node_id", "channel", *VOXEL, *"xyz", "radius")


def edges_with_nodes(edges: DataFrame, nodes: DataFrame, check: bool = True) -> DataFrame:
    """edge_id, channel, src_node_id, dst_node_id, edge_length and voxels.  ValueError if an end is not among the nodes."""
    require_columns(edges, EDGE_COLUMNS)
    voxel = [f"{e}_{v}" for e in ("src", "dst") for v in VOXEL]
    out = edges.select("channel", *voxel, "edge_length")
    for e in ("src", "dst"):
        named = nodes.select("channel", *[F.col(v).alias(f"{e}_{v}") for v in VOXEL], F.col("node_id").alias(f"{e}_node_id"))
        out = out.join(named, ["channel", *(f"{e}_{v}" for v in VOXEL)], "left")
    order = ["channel", "src_node_id", "dst_node_id"]
    out = dense_ids(out, order, "edge_id").select("edge_id", *order, "edge_length", *voxel)  # written once, read for the test and the result
    if check and not out.where("src_node_id is null or dst_node_id is null").isEmpty():
        raise ValueError("an edge ends at a voxel that is not a node")
    return out


def _local_roots(there: np.ndarray, steps: list[tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """Places (flat) of the voxels of an array, and for each the number of the first one of its group, by union and find over all links at once."""
    at = np.flatnonzero(there)
    number = np.full(there.shape, -1, np.int64)
    number.ravel()[at] = np.arange(len(at))
    u, v = [], []
    for d in steps:
        here = tuple(slice(max(0, -x), n - max(0, x)) for x, n in zip(d, there.shape))
        next_ = tuple(slice(max(0, x), n - max(0, -x)) for x, n in zip(d, there.shape))
        both = there[here] & there[next_]
        u.append(number[here][both])
        v.append(number[next_][both])
    u, v = np.concatenate(u), np.concatenate(v)
    parent = np.arange(len(at))
    while len(u):
        a, b = parent[u], parent[v]
        apart = a != b
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while (parent[parent] != parent).any():
            parent = parent[parent]
    return at, parent


def _tile_groups(steps: list[tuple[int, ...]]):
    """Function of a tile: its own voxels with the smallest number of their group in the tile, and the voxels beyond it that touch a group."""

    def step(block: Block) -> dict[str, np.ndarray]:
        ids, core = block.values["id"], block.core
        at, parent = _local_roots(block.there[core], steps)
        root = np.full(block.there.shape, -1, np.int64)
        inner = np.unravel_index(at, block.there[core].shape)
        own_ids = ids[core][inner]
        root[core][inner] = own_ids[parent]
        beyond = block.there.copy()
        beyond[core] = False
        touched = []
        for d in [*steps, *(tuple(-x for x in d) for d in steps)]:
            here = tuple(slice(max(0, -x), n - max(0, x)) for x, n in zip(d, ids.shape))
            next_ = tuple(slice(max(0, x), n - max(0, -x)) for x, n in zip(d, ids.shape))
            both = beyond[next_] & (root[here] >= 0)
            touched.append(np.stack([ids[next_][both], root[here][both]], axis=1))
        pairs = np.unique(np.concatenate(touched), axis=0)
        none = np.zeros(len(pairs), np.int64)
        own = block.rows(root >= 0, id=ids, root=root)
        more = {**dict.fromkeys(AXES, none), "id": pairs[:, 0], "root": pairs[:, 1]}
        return {k: np.concatenate([own[k], more[k]]) for k in own} | {"own": np.arange(len(own["id"]) + len(pairs)) < len(own["id"])}

    return step


def voxel_components(voxels: DataFrame, connectivity: int = 26, tile: int | tuple[int, int, int] = TILE) -> DataFrame:
    """Add label, the smallest voxel number of each connected group; ``voxels`` has vx, vy, vz of the foreground.

    Groups are found within each tile first.  Then only the groups that touch voxels of other tiles are linked, and their numbers shrink by star rounds,
    so the rows of the rounds grow with the tiles' borders.  Repeated voxels count once; the tiles' size doesn't change the result.
    """
    numbered = checkpointed(dense_ids(voxels.select(*AXES).distinct(), list(AXES), "id"))
    later = [d for d in itertools.product((-1, 0, 1), repeat=3) if d > (0, 0, 0) and sum(map(abs, d)) <= {6: 1, 18: 2, 26: 3}[connectivity]]
    found = checkpointed(tiled(numbered, _tile_groups(later), "vx long, vy long, vz long, id long, root long, own boolean", 1, tile))
    touched = found.where("not own").select("id", F.col("root").alias("other"))
    meet = found.where("own").join(touched, "id").where("root != other").select(F.greatest("root", "other").alias("u"), F.least("root", "other").alias("v"))
    edges = star_components(meet)
    out = found.where("own").join(edges.select(F.col("u").alias("root"), F.col("v").alias("label")), "root", "left")
    return out.select(*AXES, F.coalesce("label", "root").alias("label"))


def component_objects(components: DataFrame, matrix: list[list[float]], least_voxels: int = 1) -> DataFrame:
    """Objects of at least so many voxels: mean physical position and nvoxels."""
    objects = components.groupBy("label").agg(F.count(F.lit(1)).alias("nvoxels"), *[F.avg(f"v{a}").alias(a) for a in "xyz"]).where(F.col("nvoxels") >= least_voxels)
    at = affine(matrix, F.col("x"), F.col("y"), F.col("z"))
    return objects.select(*[c.alias(f"pos_{a}") for a, c in zip("xyz", at)], "nvoxels")


