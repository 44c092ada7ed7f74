"""Fill-in-the-middle transformation by SQL on Arrow batches, one DuckDB connection a task.

A text is cut into lines, the lines into prefix, middle and suffix at two places that a hash of the document's key draws; the parts
are then joined with marks, prefix first (``psm``) or suffix first (``spm``).  A text that holds a mark stays as it is (``plain``), so
the parts can always be told apart again.  All work on texts is SQL over a registered batch; no row passes through Python by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.expressions import col
from .common import blocks, documents, map_arrow

#: Fixed by the task: marks, the seed's text, per cent of texts that are transformed, and per cent of those with the suffix first.
PREFIX_MARK, SUFFIX_MARK, MIDDLE_MARK = "<P>", "<S>", "<M>"
SEED, PERCENT, SUFFIX_FIRST = 7, 100, 50
#: A line with its end, or a last line without one.
LINE = r"[^\n]*\n|[^\n]+"
#: Bytes of text that one statement takes, unless a single text is longer; a text is held about six times in a statement.
STATEMENT_BYTES = 4_000_000


def transform_sql(seed: int = SEED, percent: int = PERCENT, suffix_first: int = SUFFIX_FIRST, source: str = "batch") -> str:
    """SQL from (row, key, text) to (row, n, form, prefix_chars, middle_chars, output)."""
    group = lambda i: f"CAST('0x' || digest[{8 * i + 1}:{8 * i + 8}] AS BIGINT)"
    marked = " OR ".join(f"contains(text, '{m}')" for m in (PREFIX_MARK, SUFFIX_MARK, MIDDLE_MARK))
    piece = lambda a, b: f"coalesce(array_to_string(list_slice(units, {a}, {b}), ''), '')"
    return f"""WITH hashed AS (
    SELECT row, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{LINE}') AS units, sha256('{seed}:' || coalesce(CAST(key AS VARCHAR), '')) AS digest FROM {source}),
drawn AS (
    SELECT row, text, units, CAST(len(units) AS BIGINT) AS n, {group(0)} % (len(units) + 1) AS one, {group(1)} % (len(units) + 1) AS two,
        CASE WHEN text = '' OR {marked} OR {group(2)} % 100 >= {percent} THEN 'plain' WHEN {group(3)} % 100 < {suffix_first} THEN 'spm' ELSE 'psm' END AS form FROM hashed),
cut AS (
    SELECT row, n, form, CASE WHEN form = 'plain' THEN text END AS text, {piece("1", "least(one, two)")} AS prefix,
        {piece("least(one, two) + 1", "greatest(one, two)")} AS middle, {piece("greatest(one, two) + 1", "n")} AS suffix FROM drawn)
SELECT row, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
    CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX_MARK}' || prefix || '{SUFFIX_MARK}' || suffix || '{MIDDLE_MARK}' || middle
        ELSE '{SUFFIX_MARK}' || suffix || '{PREFIX_MARK}' || prefix || '{MIDDLE_MARK}' || middle END AS output FROM cut"""


def restore_sql(source: str) -> str:
    """SQL from (row, form, output) to (row, restored): the text before the transformation.

    No mark has its first character anywhere else, and the parts hold no mark, so the first place of each mark is the one that was set.
    """
    a, z = len(PREFIX_MARK) + 1, len(MIDDLE_MARK)
    return f"""WITH found AS (
    SELECT row, form, output, strpos(output, CASE form WHEN 'psm' THEN '{SUFFIX_MARK}' ELSE '{PREFIX_MARK}' END) AS second, strpos(output, '{MIDDLE_MARK}') AS third FROM {source}),
parts AS (
    SELECT *, substring(output, {a}, second - {a}) AS one, substring(output, second + {z}, third - second - {z}) AS two, substring(output, third + {z}) AS middle FROM found)
SELECT row, CASE form WHEN 'plain' THEN output WHEN 'psm' THEN one || middle || two ELSE two || middle || one END AS restored FROM parts"""


def _by_sql(df: DataFrame, columns: dict[str, str], text: str, sql: str, added: T.StructType) -> DataFrame:
    """``df`` with the columns ``added`` that ``sql`` makes of ``batch``: the row's number as ``row``, and ``columns`` under their names there.

    Columns that already have an added name are replaced.  The other columns stay in Arrow as they are, whatever their types.
    """
    df = df.select(*[col(c) for c in df.columns if c not in added.names])
    schema = T.StructType([*df.schema.fields, *added.fields])
    types = {"long": pa.int64(), "string": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        with duckdb.connect(config={"threads": 1, "temp_directory": "", "autoinstall_known_extensions": False}) as con:
            for whole in batches:
                for batch in blocks(whole, text, STATEMENT_BYTES):
                    own = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows), pa.int64()), *(batch.column(c) for c in columns)], ["row", *columns.values()])
                    con.register("batch", pa.Table.from_batches([own]))
                    out = con.execute(f"SELECT * EXCLUDE (row) FROM ({sql}) ORDER BY row").to_arrow_table().combine_chunks()
                    con.unregister("batch")
                    made = [out.column(f.name).combine_chunks().cast(types["long" if isinstance(f.dataType, T.LongType) else "string"]) for f in added.fields]
                    made = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in made]
                    yield pa.RecordBatch.from_arrays([*batch.columns, *made], schema.names)

    return map_arrow(df, run, schema)


_FORM = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType())]


def fill_in_middle(df: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, percent: int = PERCENT, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """Add n (lines), form, prefix_chars, middle_chars (NULL where plain) and output (the text to train on) to every row.

    ``key`` has integers or texts; a null key draws as the empty text, a null text counts as empty and stays plain.  Repeated rows and
    equal keys get the same draw.  Columns of these names are replaced; an empty table gives no rows.
    """
    added = T.StructType([*_FORM, T.StructField("output", T.StringType())])
    return _by_sql(df, {key: "key", text: "text"}, text, transform_sql(seed, percent, suffix_first), added)


def restored(df: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """Add ``restored``, the text that ``fill_in_middle`` made ``output`` of; NULL for a null output or form."""
    sql = f"SELECT row, CASE WHEN form IS NOT NULL THEN restored END AS restored FROM batch JOIN ({restore_sql('batch')}) USING (row)"
    return _by_sql(df, {output: "output", form: "form"}, output, sql, T.StructType([T.StructField("restored", T.StringType())]))


def digests(df: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, percent: int = PERCENT, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """Like ``fill_in_middle``, with SHA-256 of the output and of the text restored from it instead of the output, so that no text leaves the worker."""
    sql = f"""WITH made AS MATERIALIZED ({transform_sql(seed, percent, suffix_first)}), back AS ({restore_sql("made")})
SELECT row, n, form, prefix_chars, middle_chars, sha256(output) AS output_sha256, sha256(restored) AS restored_sha256 FROM made JOIN back USING (row)"""
    added = T.StructType([*_FORM, T.StructField("output_sha256", T.StringType()), T.StructField("restored_sha256", T.StringType())])
    return _by_sql(df, {key: "key", text: "text"}, text, sql, added)


#: The same rows by one statement over the whole table; the restored text must be the text itself.
ORACLE_SQL = f"""WITH u AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{LINE}') AS w, sha256('{SEED}:' || doc_id) AS s FROM documents),
h AS (SELECT doc_id, t, w, len(w) AS n, list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(s, i, 8) AS BIGINT)) AS h FROM u),
f AS (SELECT doc_id, t, w, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b, CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') THEN 'plain' WHEN h[4] % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT doc_id, t, n, form, array_to_string(w[:a], '') AS x, array_to_string(w[a + 1:b], '') AS m, array_to_string(w[b + 1:], '') AS y FROM (SELECT * REPLACE (CASE WHEN n = 0 THEN [''] ELSE w END AS w) FROM f))
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(x) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN concat('{PREFIX_MARK}', x, '{SUFFIX_MARK}', y, '{MIDDLE_MARK}', m) ELSE concat('{SUFFIX_MARK}', y, '{PREFIX_MARK}', x, '{MIDDLE_MARK}', m) END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 of every whole text."""
    return digests(documents(spark, sf_dir).select("doc_id", "text")).drop("text")
