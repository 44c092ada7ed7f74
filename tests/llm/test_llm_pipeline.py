"""The pipeline's stages on a small table, and the registry without the subpackage."""

import os
import shutil
import subprocess
import sys
import time

import corpus_pipeline
from voxtile.llm import jaccard_join, passages


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kinds, kept = docs.dtypes, docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = corpus_pipeline.stored(stage(spark, docs, sf), name)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.dtypes == kinds, name
        if name == "near_duplicates":
            groups = jaccard_join.jaccard_groups(before).selectExpr("component_id").distinct().count()
            assert docs.count() == groups < kept
            assert jaccard_join.jaccard_groups(docs).where("doc_id != component_id").count() == 0
        if name == "repeated_passages":
            assert docs.count() == before.count() and docs.selectExpr("sum(n_chars)").first()[0] < before.selectExpr("sum(n_chars)").first()[0]
            assert passages.recurring_passages(before).count() > 0
        if name == "encode":
            assert docs.where("not round_trip").count() == 0 and docs.count() == before.count() > 0


def test_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0, name


def test_library_stands_without_the_subpackage(tmp_path):
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    shutil.copytree(root, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "spark-warehouse", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 40 and 'pipeline' not in q and not any(k.startswith('op1_') for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", env=os.environ | {"PYTHONPATH": ""}, check=True)


def test_near_duplicates_leave_no_files_of_their_steps(spark, sf):
    """Shuffles and lists of the join go when they are read, whenever the driver collects its garbage."""
    import glob

    from voxtile.operators.graph import shared_folder

    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    own = lambda: {x: os.path.getsize(x) for x in files.getAllFiles().mkString(" ").split() if "shuffle" in x and os.path.exists(x)}
    docs = corpus_pipeline.stored(spark.read.parquet(f"{sf}/documents.parquet"), "all")
    text = docs.selectExpr("sum(octet_length(text))").first()[0]
    had = own()
    out = corpus_pipeline.stored(corpus_pipeline.near_duplicates(spark, docs, sf), "kept")
    time.sleep(1)
    assert 0 < out.count() < docs.count()
    assert sum(v for k, v in own().items() if k not in had) < 0.2 * text
    assert not [x for name in ("lists", "hopeful", "entries", "candidates") for x in glob.glob(f"{shared_folder(spark).removeprefix('file:')}/{name}-*")]
