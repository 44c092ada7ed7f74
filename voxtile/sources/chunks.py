"""Volumes as folders of chunk files: a data source and sink of Spark, and volumes of labels with their table.

A folder has ``head.json`` and a data folder that the head names.  The head holds, for each level, shape, chunk, spacing and translation, besides the channels and the
type of the numbers.  A chunk is one file, ``<level>/<channel>/<x>.<y>.<z>``: its voxels as little-endian numbers in the order of x, y, z, compressed; one without
any value but 0 has no file.  A head is only written when all chunks of a new data folder are there, so readers see one state or the other.
"""

from __future__ import annotations

import itertools
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

AXES = ("vx", "vy", "vz")
FORMAT, SCHEMA = "voxel_chunks", "level int, channel string, vx long, vy long, vz long, value double"
#: Bytes of voxels (uncompressed) that a partition of a scan reads, unless one chunk has more.
PARTITION_BYTES = 64_000_000


def level_head(shape: tuple[int, int, int], chunk: tuple[int, int, int], spacing: tuple[float, float, float] = (1.0, 1.0, 1.0), translation: tuple[float, float, float] = (0.0, 0.0, 0.0)) -> dict:
    return {"shape": list(shape), "chunk": list(chunk), "spacing": list(spacing), "translation": list(translation)}


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and place of a path or URI; Hadoop's ``file:/x`` is ``file:///x`` here."""
    path = path.rstrip("/")
    return pafs.FileSystem.from_uri(f"file://{path[5:]}" if path.startswith("file:/") and not path.startswith("file://") else path)


def read_head(path: str) -> dict:
    fs, at = _open(path)
    with fs.open_input_stream(f"{at}/head.json") as f:
        return json.loads(f.read())


def matrix_of(level: dict) -> list[list[float]]:
    """Affine matrix from voxels of a level to physical places."""
    rows = [[s if i == j else 0.0 for j in range(3)] + [t] for i, (s, t) in enumerate(zip(level["spacing"], level["translation"]))]
    return [*rows, [0.0, 0.0, 0.0, 1.0]]


@dataclass
class ChunkRange(InputPartition):
    """Some chunks in a row of those of one level and channel that a box meets."""

    level: int
    channel: int
    first: int
    last: int


class VoxelChunks(DataSource):
    """``spark.read.format("voxel_chunks")`` with the options path, level (default: all), channel (name, default: all), box (``x0:x1,y0:y1,z0:z1``, ends excluded), zeros (also voxels of value 0)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ChunkReader:
        return ChunkReader(self.options)

    def writer(self, schema, overwrite: bool) -> ChunkWriter:
        return ChunkWriter(self.options, overwrite)


class ChunkReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.head = options["path"], read_head(options["path"])
        self.zeros = str(options.get("zeros", "false")).lower() == "true"
        self.levels = {int(options["level"])} if "level" in options else set(range(len(self.head["levels"])))
        self.channels = {options["channel"]} if "channel" in options else set(self.head["channels"])
        if unknown := self.channels - set(self.head["channels"]):
            raise ValueError(f"no such channel: {', '.join(sorted(unknown))}")
        if not self.levels <= set(range(len(self.head["levels"]))):
            raise ValueError("no such level")
        ends = [x.split(":") for x in options["box"].split(",")] if "box" in options else [("", "")] * 3
        self.low, self.high = [int(a or 0) for a, _ in ends], [int(b) if b else None for _, b in ends]

    def pushFilters(self, filters: list[Filter]):
        """Comparisons of a place, level or channel with constants narrow the scan; Spark keeps the others."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            value = getattr(f, "value", None)
            if name in AXES and isinstance(value, int) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                i = AXES.index(name)
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.low[i] = max(self.low[i], value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    end = value + (not isinstance(f, LessThan))
                    self.high[i] = end if self.high[i] is None else min(self.high[i], end)
            elif name in ("level", "channel") and isinstance(f, (EqualTo, In)):
                wanted = {value} if isinstance(f, EqualTo) else set(value)
                self.levels, self.channels = (self.levels & wanted, self.channels) if name == "level" else (self.levels, self.channels & wanted)
            else:
                yield f

    def _box(self, level: int) -> tuple[list[int], list[int], list[int], list[int]]:
        """First voxel and end of the box on a level, first chunk and number of chunks along each axis."""
        shape, chunk = self.head["levels"][level]["shape"], self.head["levels"][level]["chunk"]
        low = [max(0, a) for a in self.low]
        high = [n if b is None else min(n, b) for n, b in zip(shape, self.high)]
        first = [a // c for a, c in zip(low, chunk)]
        return low, high, first, [max(0, -(-b // c) - a) if b > l else 0 for l, b, c, a in zip(low, high, chunk, first)]

    def partitions(self) -> list[InputPartition]:
        out: list[InputPartition] = []
        for level in sorted(self.levels):
            n = int(np.prod(self._box(level)[3]))
            step = max(1, PARTITION_BYTES // (int(np.prod(self.head["levels"][level]["chunk"])) * np.dtype(self.head["dtype"]).itemsize))
            for channel in sorted(self.channels):
                out += [ChunkRange(level, self.head["channels"].index(channel), a, min(a + step, n)) for a in range(0, n, step)]
        return out or [ChunkRange(0, 0, 0, 0)]

    def read(self, partition: ChunkRange) -> Iterator[pa.RecordBatch]:
        fs, at = _open(self.path)
        info = self.head["levels"][partition.level]
        low, high, first, number = self._box(partition.level)
        name = self.head["channels"][partition.channel]
        for k in range(partition.first, partition.last):
            index = [a + int(i) for a, i in zip(first, np.unravel_index(k, number))]
            corner = [i * c for i, c in zip(index, info["chunk"])]
            size = [min(c, n - o) for c, n, o in zip(info["chunk"], info["shape"], corner)]
            try:
                with fs.open_input_stream(f"{at}/{self.head['data']}/{partition.level}/{partition.channel}/{'.'.join(map(str, index))}", compression=None) as f:
                    block = np.frombuffer(zlib.decompress(f.read()), self.head["dtype"]).reshape(size)
            except FileNotFoundError:  # nothing but 0
                if not self.zeros:
                    continue
                block = np.zeros(size, self.head["dtype"])
            inside = tuple(slice(max(0, a - o), max(0, min(n, b - o))) for a, b, o, n in zip(low, high, corner, size))
            block = block[inside]
            place = np.nonzero(np.ones(block.shape, bool) if self.zeros else block)
            n = len(place[0])
            if not n:
                continue
            places = [pa.array(p.astype(np.int64) + o + s.start) for p, o, s in zip(place, corner, inside)]
            values = pa.array(block[place].astype(np.float64))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, partition.level, np.int32)), pa.DictionaryArray.from_arrays(pa.array(np.zeros(n, np.int32)), [name]).cast(pa.string()), *places, values], ["level", "channel", *AXES, "value"])


@dataclass
class Written(WriterCommitMessage):
    chunks: int


class ChunkWriter(DataSourceArrowWriter):
    """Writes rows that come chunk by chunk (see ``write_chunks``); each chunk goes to a file of another name first, which then gets its own."""

    def __init__(self, options, overwrite: bool):
        self.path, self.head = options["path"], json.loads(options["head"])
        self.head["data"] = f"data-{uuid.uuid4().hex}"
        fs, at = _open(self.path)
        self.before = None
        if fs.get_file_info(f"{at}/head.json").type == pafs.FileType.File:
            if not overwrite:
                raise ValueError(f"{self.path} has a volume already")
            self.before = read_head(self.path)["data"]

    def _chunk(self, fs: pafs.FileSystem, folder: str, level: int, channel: str, index: tuple[int, ...], places: np.ndarray, values: np.ndarray) -> int:
        info = self.head["levels"][level]
        corner = np.array(index) * info["chunk"]
        size = [int(min(c, n - o)) for c, n, o in zip(info["chunk"], info["shape"], corner)]
        if (places < 0).any() or (places >= info["shape"]).any():
            raise ValueError(f"a voxel lies outside of level {level}")
        block = np.zeros(size, self.head["dtype"])
        block[tuple((places - corner).T)] = values
        if not block.any():
            return 0
        to = f"{folder}/{level}/{self.head['channels'].index(channel)}"
        fs.create_dir(to, recursive=True)
        draft = f"{to}/_{uuid.uuid4().hex}"
        with fs.open_output_stream(draft, compression=None) as f:
            f.write(zlib.compress(block.tobytes(), 1))
        fs.move(draft, f"{to}/{'.'.join(map(str, index))}")
        return 1

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, at = _open(self.path)
        folder, chunks, now, held = f"{at}/{self.head['data']}", 0, None, []

        def finished() -> int:
            return self._chunk(fs, folder, *now, np.concatenate([p for p, _ in held]), np.concatenate([v for _, v in held])) if held else 0

        for batch in iterator:
            if not batch.num_rows:
                continue
            places = np.stack([batch.column(a).to_numpy() for a in AXES], axis=1)
            values = batch.column("value").to_numpy()
            levels, channels = batch.column("level").to_pylist(), batch.column("channel").to_pylist()
            for a, b in _runs(levels, channels, places, self.head):
                key = (levels[a], channels[a], tuple((places[a] // self.head["levels"][levels[a]]["chunk"]).tolist()))
                if key != now:
                    chunks += finished()
                    now, held = key, []
                held.append((places[a:b], values[a:b]))
        return Written(chunks + finished())

    def commit(self, messages: list[Written | None]) -> None:
        fs, at = _open(self.path)
        fs.create_dir(f"{at}/{self.head['data']}", recursive=True)
        self.head["chunks"] = sum(m.chunks for m in messages if m is not None)
        draft = f"{at}/_{uuid.uuid4().hex}"
        with fs.open_output_stream(draft) as f:
            f.write(json.dumps(self.head, indent=1).encode())
        fs.move(draft, f"{at}/head.json")
        if self.before:
            fs.delete_dir(f"{at}/{self.before}")

    def abort(self, messages: list[Written | None]) -> None:
        fs, at = _open(self.path)
        if fs.get_file_info(f"{at}/{self.head['data']}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{at}/{self.head['data']}")


def _runs(levels: list[int], channels: list[str], places: np.ndarray, head: dict) -> Iterator[tuple[int, int]]:
    """Rows in a row of one chunk: starts and ends."""
    chunk = np.array([head["levels"][k]["chunk"] for k in levels])
    index = places // chunk
    names = {c: i for i, c in enumerate(head["channels"])}
    if unknown := set(channels) - names.keys():
        raise ValueError(f"no such channel: {', '.join(sorted(map(str, unknown)))}")
    key = np.column_stack([levels, [names[c] for c in channels], index])
    cuts = [0, *(np.flatnonzero((np.diff(key, axis=0) != 0).any(axis=1)) + 1).tolist(), len(key)]
    yield from itertools.pairwise(cuts)


def _registered(spark: SparkSession) -> None:
    """Make the format known to the session, and let filters reach sources in Python, which this one needs."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(VoxelChunks)


def write_chunks(voxels: DataFrame, path: str, levels: list[dict], channels: list[str], dtype: str = "<f8", mode: str = "overwrite") -> None:
    """Write voxels (vx, vy, vz, value, and level and channel unless there is one of them) as a folder of chunks; every chunk is made by one task.

    ``levels`` are heads by ``level_head``.  Missing voxels, and values of NULL, are 0; of a repeated place the largest value counts.  A voxel outside of its level, or a channel that
    isn't named, is an error, and nothing of a failed write stays.  A table without rows gives a volume of 0, which reads as a table with the same columns.  ``mode`` is overwrite, or append for a new folder only.
    """
    _registered(voxels.sparkSession)
    level = F.col("level").cast("int") if "level" in voxels.columns else F.lit(0)
    channel = F.col("channel") if "channel" in voxels.columns else F.lit(channels[0])
    own = voxels.select(level.alias("level"), channel.alias("channel"), *[F.col(a).cast("long").alias(a) for a in AXES], F.col("value").cast("double").alias("value")).where("value is not null")
    width = [F.element_at(F.array(*[F.lit(int(h["chunk"][i])) for h in levels]), F.col("level") + 1) for i in range(3)]
    keys = ["level", "channel", *(F.floor(F.col(a) / w) for a, w in zip(AXES, width))]
    dealt = own.repartition(*keys).sortWithinPartitions(*keys, "value")
    dealt.write.format(FORMAT).option("path", path).option("head", json.dumps({"levels": levels, "channels": channels, "dtype": dtype})).mode(mode).save()


def read_chunks(spark: SparkSession, path: str, level: int | None = None, channel: str | None = None, box: tuple[tuple[int, int], ...] | None = None, zeros: bool = False) -> DataFrame:
    """level, channel, vx, vy, vz, value of the voxels of a folder that aren't 0 (with ``zeros``: of all); only chunks that meet the box, level and channel are opened.

    Filters on these columns narrow the scan as well.
    """
    _registered(spark)
    options = {"path": path, "zeros": str(zeros).lower()} | ({"level": str(level)} if level is not None else {}) | ({"channel": channel} if channel is not None else {})
    if box is not None:
        options["box"] = ",".join(f"{a}:{b}" for a, b in box)
    return spark.read.format(FORMAT).options(**options).load()


def label_check(voxels: DataFrame, labels: DataFrame) -> DataFrame:
    """index, name, n_voxels, in_table of every label that the grid or the table has; background (0) and NULL are left out."""
    counts = voxels.where("index > 0").groupBy("index").agg(F.count(F.lit(1)).alias("n_voxels"))
    table = labels.where("index > 0").groupBy(F.col("index").cast("long").alias("index")).agg(F.min("name").alias("name"), F.lit(True).alias("in_table"))
    both = counts.join(table, "index", "full")
    return both.select("index", "name", F.coalesce("n_voxels", F.lit(0)).cast("long").alias("n_voxels"), F.coalesce("in_table", F.lit(False)).alias("in_table"))


def read_atlas(spark: SparkSession, path: str, labels: DataFrame, level: int = 0, channel: str | None = None, box: tuple[tuple[int, int], ...] | None = None, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """A volume of labels (vx, vy, vz, index) with its label table; ValueError if ``strict`` and the grid has a label that the table lacks."""
    voxels = read_chunks(spark, path, level, channel, box).select(*AXES, F.col("value").cast("long").alias("index"))
    if strict and (lost := label_check(voxels, labels).where("not in_table").orderBy("index").limit(10).collect()):
        raise ValueError(f"labels that the table lacks: {', '.join(str(r['index']) for r in lost)}")
    return voxels, labels
