"""Dense tiles with a halo: the runner of all operators that need a voxel's neighbourhood.

A voxel goes to the tile that owns it and to those whose halo it lies in.  A task gets its tiles one after the other as dense blocks of
bounded size, hands them to a function of arrays, and keeps what the function says of the tile's own voxels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

AXES = ("vx", "vy", "vz")
#: Voxels of a tile along each axis, and bytes that one dense array of a tile with its halo may have.
TILE, BLOCK_BYTES = (32, 32, 32), 256_000_000


class Block:
    """A tile with its halo: ``there`` tells the voxels of the table, the other arrays have their values (0 elsewhere); ``low`` is the place of the first one."""

    def __init__(self, low: np.ndarray, shape: tuple[int, ...], halo: tuple[int, ...], points: np.ndarray, values: dict[str, np.ndarray]):
        self.low, self.halo = low, halo
        at = tuple((points - low).T)
        self.there = np.zeros(shape, bool)
        self.there[at] = True
        self.values = {}
        for name, v in values.items():
            self.values[name] = np.zeros(shape, v.dtype)
            self.values[name][at] = v

    @property
    def core(self) -> tuple[slice, ...]:
        return tuple(slice(h, n - h) for h, n in zip(self.halo, self.there.shape))

    def rows(self, chosen: np.ndarray, **columns: np.ndarray) -> dict[str, np.ndarray]:
        """The tile's own voxels among ``chosen``, with their places and the values that arrays of the block have there."""
        own = np.zeros_like(chosen)
        own[self.core] = chosen[self.core]
        at = np.nonzero(own)
        return {a: i.astype(np.int64) + int(o) for a, i, o in zip(AXES, at, self.low)} | {k: v[at] for k, v in columns.items()}


def tiled(
    voxels: DataFrame, function: Callable[[Block], dict[str, np.ndarray]], schema: T.StructType | str, halo: int | tuple[int, int, int] = 1, tile: int | tuple[int, int, int] = TILE, by: tuple[str, ...] = ()
) -> DataFrame:
    """The rows that ``function`` makes of every tile that has a voxel of its own; what it returns are columns of one length by name.

    ``voxels`` has vx, vy, vz (whole numbers without NULL, each place once; of several rows one counts) and columns of numbers.  The result of a stencil
    whose reach is within the halo doesn't depend on the tiles.  Tiles are dealt by their place, a task holds one at a time, and
    one whose dense array would be above ``BLOCK_BYTES`` is refused at once.  An empty table gives no rows.
    Columns named in ``by`` (without NULL) tell volumes apart that have tiles of their own; they come first in the result.
    """
    halo, tile = ((x,) * 3 if isinstance(x, int) else tuple(x) for x in (halo, tile))
    shape = tuple(n + 2 * h for n, h in zip(tile, halo))
    if 8 * int(np.prod(shape, dtype=float)) > BLOCK_BYTES:
        raise ValueError(f"a tile of {tile} with a halo of {halo} has more than {BLOCK_BYTES} bytes")
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = {T.LongType(): pa.int64(), T.DoubleType(): pa.float64(), T.BooleanType(): pa.bool_(), T.IntegerType(): pa.int32()}
    full = T.StructType([*(voxels.schema[c] for c in by), *schema])
    names = [c for c in voxels.columns if c not in (*AXES, *by)]
    keys = [f"_t{a}" for a in AXES]
    dealt = voxels.select(*[F.col(a).cast("long").alias(a) for a in AXES], *[F.col(f"`{c}`") for c in (*by, *names)])
    for a, k, n, h in zip(AXES, keys, tile, halo):
        own = F.floor(F.col(a) / n)
        dealt = dealt.withColumn(k, F.explode(F.sequence(F.floor((F.col(a) - h) / n), F.floor((F.col(a) + h) / n))) if h else own)
        dealt = dealt.withColumn(f"_own{k}", F.col(k) == own)
    # a tile without a voxel of its own has nothing to say
    owned = F.col(f"_own{keys[0]}") & F.col(f"_own{keys[1]}") & F.col(f"_own{keys[2]}")
    dealt = dealt.withColumn("_own", owned).select(*by, *keys, "_own", *AXES, *names)

    def solved(volume: tuple, key: tuple, parts: list[dict[str, np.ndarray]]) -> pa.RecordBatch | None:
        v = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
        if not v["_own"].any():
            return None
        low = np.array(key) * tile - halo
        out = function(Block(low, shape, halo, np.stack([v[a] for a in AXES], axis=1), {c: v[c] for c in names}))
        columns = [pa.array(out[f.name], arrow[f.dataType]) for f in schema]
        return pa.RecordBatch.from_arrays([*(pa.repeat(x, len(columns[0])) for x in volume), *columns], full.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            v = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("_own", *AXES, *names)}
            place = np.stack([batch.column(k).to_numpy() for k in keys], axis=1)
            changes = (np.diff(place, axis=0) != 0).any(axis=1)
            for c in by:
                x = batch.column(c).to_numpy(zero_copy_only=False)
                changes |= x[1:] != x[:-1]
            cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), len(place)]
            for a, b in zip(cuts, cuts[1:]):
                key = (tuple(batch.column(c)[a] for c in by), tuple(place[a].tolist()))
                if key != now and held:
                    if (out := solved(*now, held)) is not None:
                        yield out
                    held = []
                now = key
                held.append({c: x[a:b] for c, x in v.items()})
        if held and (out := solved(*now, held)) is not None:
            yield out

    return dealt.repartition(*by, *keys).sortWithinPartitions(*by, *keys).mapInArrow(run, full)


def box_mean(voxels: DataFrame, reach: int = 1, value: str = "value", tile: int | tuple[int, int, int] = TILE) -> DataFrame:
    """Each voxel with ``mean`` and ``n``, of the voxels that are there within ``reach`` along every axis."""

    def summed(x: np.ndarray) -> np.ndarray:
        for axis in range(3):
            total = np.cumsum(np.pad(x, [(reach + 1, reach) if i == axis else (0, 0) for i in range(3)]), axis=axis)
            at = lambda a, b: tuple(slice(a, b) if i == axis else slice(None) for i in range(3))
            x = total[at(2 * reach + 1, None)] - total[at(None, -2 * reach - 1)]
        return x

    def step(block: Block) -> dict[str, np.ndarray]:
        n = summed(block.there.astype(np.int64))
        return block.rows(block.there, mean=summed(block.values[value].astype(float)) / np.maximum(n, 1), n=n)

    return tiled(voxels.select(*AXES, value), step, "vx long, vy long, vz long, mean double, n long", reach, tile)
