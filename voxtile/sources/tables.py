"""Readers and writers: Parquet, tab-separated tables, label tables and metadata."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import MISSING, col, path_entity, rgb_hex

LABELS = T.StructType([T.StructField("index", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("abbreviation", T.StringType()), T.StructField("color", T.StringType())])


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """ValueError that lists the columns of ``names`` that the table lacks."""
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"missing expected columns: {', '.join(missing)}")
    return df


def concatenated(spark: SparkSession, parts: Iterable[DataFrame | None], schema: T.StructType | str) -> DataFrame:
    """The rows of all parts under one schema: parts that are None are passed over, columns that a part lacks are NULL, others are left out."""
    fields = (T._parse_datatype_string(schema) if isinstance(schema, str) else schema).fields
    out = spark.createDataFrame([], T.StructType(fields))
    for part in parts:
        if part is not None:
            out = out.unionByName(part.select(*[(col(f.name) if f.name in part.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]))
    return out


def without_missing(df: DataFrame) -> DataFrame:
    """NULL for the tokens that stand for a missing value, in text columns."""
    return df.select(*[F.when(~col(f.name).isin(*MISSING), col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else col(f.name) for f in df.schema.fields])


def read_tsv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """Tab-separated table with a header.

    Without a schema every column is text first; one that holds only numbers becomes long or double (one job over all columns).
    Give ``color`` columns a schema, or leading zeros are lost.
    """
    return _typed(without_missing(spark.read.option("quote", '"').csv(path, sep="\t", header=True)), schema)


def _typed(raw: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Columns of text as numbers where they hold nothing else, or as the schema has them."""
    if schema is not None:
        return raw.select(*[col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    if not raw.columns:
        return raw
    tests = [F.count_if(col(c).isNotNull() & ~F.coalesce(col(c).rlike(p), F.lit(False))) for c in raw.columns for p in (r"^[+-]?\d{1,18}$", r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")]
    odd = raw.agg(*[t.alias(f"t{i}") for i, t in enumerate(tests)], *[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(raw.columns)]).first()
    kinds = [("long" if odd[f"t{2 * i}"] == 0 else "double" if odd[f"t{2 * i + 1}"] == 0 else "string") if odd[f"n{i}"] else "string" for i in range(len(raw.columns))]
    return raw.select(*[col(c).cast(k).alias(c) for c, k in zip(raw.columns, kinds)])


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a Parquet file or tab-separated table, without its rows."""
    return spark.read.parquet(path).columns if path.rstrip("/").endswith(".parquet") else spark.read.csv(path, sep="\t", header=True).columns


def read_labels_csv(spark: SparkSession, path: str) -> DataFrame:
    """Label table without a header: abbreviation, name, index."""
    schema = T.StructType([T.StructField("abbreviation", T.StringType()), T.StructField("name", T.StringType()), T.StructField("index", T.IntegerType())])
    return spark.read.schema(schema).csv(path, header=False).select("index", "name", "abbreviation")


def read_labels_itksnap(spark: SparkSession, path: str) -> DataFrame:
    """Label description file: index, R, G, B, A, visibility, mesh and a quoted label; # starts a comment."""
    row = r'^\s*(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\S+)\s+(\S+)\s+(\S+)\s+"?([^"]*?)"?\s*$'
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^\s*(#|$)"))
    part = lambda i: F.regexp_extract("value", row, i)
    return lines.where(F.col("value").rlike(row)).select(part(1).cast("int").alias("index"), part(8).alias("name"), rgb_hex(part(2), part(3), part(4)).alias("color"))


def read_labels_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON array of [index, color, abbreviation, name] rows."""
    text = spark.read.text(path, wholetext=True)
    rows = text.select(F.explode(F.from_json("value", "array<array<string>>")).alias("r"))
    return rows.select(F.col("r")[0].cast("int").alias("index"), F.col("r")[3].alias("name"), F.col("r")[2].alias("abbreviation"), F.col("r")[1].alias("color"))


def read_sidecar(spark: SparkSession, path: str, default: dict | None = None) -> dict:
    """A small JSON object of settings; ``default`` if there is no such file."""
    from pyspark.errors import AnalysisException

    try:
        text = spark.read.text(path, wholetext=True).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return default or {}
    return json.loads(text[0]) if text else default or {}


def as_list(text: str) -> F.Column:
    """A JSON value that is a text or a list of texts, as an array."""
    value = F.trim(F.col(text))
    return F.when(value.startswith("["), F.from_json(value, "array<string>")).when(value.isNotNull(), F.array(F.regexp_replace(value, '^"|"$', "")))


def read_many(spark: SparkSession, paths: list[str], prefix: str = "sub-", column: str = "participant_id", kind: str = "tsv") -> DataFrame:
    """Files of one table read together, each row with the first part of its path that starts with ``prefix``.

    Rows of files without such a part are left out; columns that a file lacks are NULL.  ValueError for an empty list.
    """
    if not paths:
        raise ValueError("no input files")
    if kind == "parquet":
        df = spark.read.option("mergeSchema", True).parquet(*paths)
        df = df.withColumn(column, path_entity(F.col("_metadata.file_path"), prefix))
    else:
        first = spark.read.text(paths).where("_metadata.file_block_start = 0").select("value", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("line"))
        lines = first.groupBy("path").agg(F.min_by("value", "line").alias("header"))
        raw = None
        for r in lines.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("header").collect():  # a scan for each different header
            part = without_missing(spark.read.option("quote", '"').csv(r["paths"], sep="\t", header=True)).withColumn(column, path_entity(F.col("_metadata.file_path"), prefix))
            raw = part if raw is None else raw.unionByName(part, allowMissingColumns=True)
        if raw is None:
            raise ValueError("no input files with a header")
        df = _typed(raw)
    return df.where(col(column).isNotNull())


def write_tsv(df: DataFrame, path: str, columns: list[str] | None = None, single: bool = False) -> None:
    """Tab-separated table with a header; missing values are n/a."""
    df = df.select(*columns) if columns else df
    (df.coalesce(1) if single else df).write.mode("overwrite").csv(path, sep="\t", header=True, nullValue="n/a")


# The lines that a label description file begins with, and the label of what is outside.
LABEL_FILE_HEADER = """################################################
# ITK-SnAP Label Description File
# File format:
# IDX   -R-  -G-  -B-  -A--  VIS MSH  LABEL
# Fields:
#    IDX:   Zero-based index
#    -R-:   Red color component (0..255)
#    -G-:   Green color component (0..255)
#    -B-:   Blue color component (0..255)
#    -A-:   Label transparency (0.00 .. 1.00)
#    VIS:   Label visibility (0 or 1)
#    IDX:   Label mesh visibility (0 or 1)
#  LABEL:   Label description
################################################"""
# The twenty colours of the qualitative palette for labels without a colour.
PALETTE = (
    "1f77b4", "aec7e8", "ff7f0e", "ffbb78", "2ca02c", "98df8a", "d62728", "ff9896", "9467bd", "c5b0d5",
    "8c564b", "c49c94", "e377c2", "f7b6d2", "7f7f7f", "c7c7c7", "bcbd22", "dbdb8d", "17becf", "9edae5",
)


def with_colors(labels: DataFrame) -> DataFrame:
    """``labels`` with a colour each: its own, or the palette's at i / (n - 1) for row i of n in the order of the index."""
    order = Window.partitionBy().orderBy("index", "name")  # a label table, not data
    place = (F.row_number().over(order) - 1) / F.greatest(F.count(F.lit(1)).over(Window.partitionBy()) - 1, F.lit(1))
    shade = F.element_at(F.array(*[F.lit(x) for x in PALETTE]), F.least(F.floor(place * len(PALETTE)), F.lit(len(PALETTE) - 1)).cast("int") + 1)
    own = col("color") if "color" in labels.columns else F.lit(None).cast("string")
    return labels.withColumn("color", F.coalesce(own, shade))


def itksnap_lines(labels: DataFrame) -> DataFrame:
    """index, value: the line of each label in a label description file."""
    from ..functions.expressions import hex_channel

    value = [hex_channel(F.col("color"), i).cast("int") for i in range(3)]
    seen = F.when(F.row_number().over(Window.partitionBy().orderBy("index", "name")) == 1, 0).otherwise(1)  # the background isn't shown
    line = F.concat_ws("\t", F.col("index"), *value, seen, seen, seen, F.concat(F.lit('"'), F.col("name"), F.lit('"')))
    return with_colors(labels).select("index", line.alias("value"))


def write_itksnap(labels: DataFrame, path: str) -> None:
    """A label description file (a folder with one part): its header, then a line for each label by index."""
    head = labels.sparkSession.createDataFrame([(-1, LABEL_FILE_HEADER)], "index long, value string")
    both = head.union(itksnap_lines(labels).select(F.col("index").cast("long"), "value"))
    both.coalesce(1).sortWithinPartitions("index").select("value").write.mode("overwrite").text(path)


def write_sidecar(spark: SparkSession, descriptions: dict[str, dict], path: str) -> None:
    """Descriptions of columns as one JSON object in a text file (a folder with one part)."""
    text = json.dumps(descriptions, indent=2, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_cohort(spark: SparkSession, path: str, columns: list[str] = (), key: str = "participant_id") -> DataFrame:
    """Table of a study's subjects.  FileNotFoundError without the file, ValueError without ``key`` or one of ``columns``, or if a subject comes twice."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        raise FileNotFoundError(f"no table of subjects at {path}")
    cohort = require_columns(read_tsv(spark, path), [key, *columns])
    twice = cohort.groupBy(col(key).alias("k")).count().where("count > 1 and k is not null").orderBy("k").limit(5).collect()
    if twice:
        raise ValueError(f"subjects that come more than once: {', '.join(str(r['k']) for r in twice)}")
    return cohort


def column_dictionary(df: DataFrame, descriptions: dict[str, dict]) -> DataFrame:
    """column, long_name, description, units and n_values (rows with a value) of each column, in one aggregation of the table.

    What a column's description lacks is NULL; a table without rows has 0 values.
    """
    word = lambda c, key: F.lit(descriptions.get(c, {}).get(key)).cast("string")
    rows = [F.struct(F.lit(c).alias("column"), word(c, "LongName").alias("long_name"), word(c, "Description").alias("description"), word(c, "Units").alias("units"), F.col(f"n{i}").alias("n_values")) for i, c in enumerate(df.columns)]
    return df.agg(*[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)]).select(F.inline(F.array(*rows)))


def entities(paths: DataFrame, keys: tuple[str, ...] = ("sub", "ses", "sample", "acq", "stain", "space", "desc")) -> DataFrame:
    """``paths`` as a catalogue of files: a column for each ``key-value`` part of its path's name or folders (NULL without), suffix and extension."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    of = lambda k: F.nullif(F.regexp_extract("path", rf"(?:^|[/_]){k}-([A-Za-z0-9+]+)(?=[/_.]|$)", 1), F.lit(""))
    return paths.select("*", *[of(k).alias(k) for k in keys], F.nullif(F.regexp_extract(name, r"_?([A-Za-z0-9]+)\.[^/]*$", 1), F.lit("")).alias("suffix"), F.regexp_extract(name, r"(\..+)$", 1).alias("extension"))


def discovered(catalogue: DataFrame, filters: dict[str, str | list[str]] | None = None, include: list[str] = (), exclude: list[str] = ()) -> DataFrame:
    """Files whose columns have the wanted values, of the participants to be included (all if none are named) and not excluded."""
    out = catalogue
    for k, x in (filters or {}).items():
        out = out.where(col(k).isin([x] if isinstance(x, str) else list(x)))
    bare = lambda names: [n.removeprefix("sub-") for n in names]
    if include:
        out = out.where(col("sub").isin(bare(include)))
    return out.where(~F.coalesce(col("sub").isin(bare(exclude)), F.lit(False))) if exclude else out


def write_run(df: DataFrame, path: str, label: str) -> None:
    """Results of a named run beside those of others: ``run_label`` is a partition of the output, and only its own is replaced."""
    df.withColumn("run_label", F.lit(label)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_label").parquet(path)
