"""Fill-in-the-middle: against a plain version, row by row."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from voxtile.llm import fill_middle

LONG = "".join(f"line {i} é😀\n" for i in range(200_000))
TEXTS = ["", None, "one line", "one\n", "\n", "\n\n\n", "a\nb\nc\nd\ne", "a\nb\n\nc\n", "has <P> in it\nx", "x <S>", "<M>", "<\nP>\nS\n>", "<<P\n<S\n<\n", "é\n😀\r\nü z\x85\n", "nul\x00\nx", "  \t\n  ", LONG, "tail <\nP>"]


def plain(key, text, seed=7, percent=100, first=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    assert "".join(units) == text
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return len(units), "plain", None, None, text
    x, m, y = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < first else "psm"
    return len(units), form, len(x), len(m), f"<P>{x}<S>{y}<M>{m}" if form == "psm" else f"<S>{y}<P>{x}<M>{m}"


def rows_of(spark, keys="long"):
    rows = [(i * len(TEXTS) + j, t, 5, "mine", {"a": 1}) for i in range(6) for j, t in enumerate(TEXTS) if t != LONG or i < 2]
    rows += [(None, "a\nb\nc", 5, "mine", {"a": 1})] * 2 + [(3, "a\nb\nc", 5, None, None)] * 2
    return spark.createDataFrame(rows, f"doc_id {keys}, text string, n int, output string, row map<string,int>")


@pytest.mark.parametrize("options", [{}, {"seed": 3, "percent": 40, "suffix_first": 90}])
def test_against_a_plain_version(spark, options):
    df = rows_of(spark)
    out = fill_middle.fill_in_middle(df, **options)
    assert out.columns == ["doc_id", "text", "row", "n", "form", "prefix_chars", "middle_chars", "output"]
    back = fill_middle.restored(out.drop("row")).collect()
    assert len(back) == df.count() and {r["form"] for r in back} == {"plain", "psm", "spm"}
    seed = {"seed": options.get("seed", 7), "percent": options.get("percent", 100), "first": options.get("suffix_first", 50)}
    for r in back:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain(r["doc_id"], r["text"], **seed)
        assert r["restored"] == (r["text"] or "")


def test_digests(spark):
    for r in fill_middle.digests(rows_of(spark)).collect():
        *_, output = want = plain(r["doc_id"], r["text"])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == want[:4]
        assert r["output_sha256"] == hashlib.sha256(output.encode()).hexdigest() and r["restored_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_odd_tables(spark):
    df = rows_of(spark).where("length(text) < 100")
    assert fill_middle.fill_in_middle(df.limit(0)).count() == 0 and fill_middle.digests(df.limit(0)).count() == 0
    named = df.select(F.concat(F.lit("k"), "doc_id").alias("a.key"), F.col("text").alias("key"))
    for r in fill_middle.fill_in_middle(named, "a.key", "key").collect():
        assert r["output"] == plain(r["a.key"], r["key"])[-1]
    lost = spark.createDataFrame([(None, "psm"), ("x", None)], "output string, form string")
    assert [r["restored"] for r in fill_middle.restored(lost).collect()] == [None, None]
