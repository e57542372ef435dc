"""The pipeline's stages, each on its own input, and the register of queries."""

import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from tests.llm.test_texts import components_of

REPO = Path(__file__).resolve().parents[2]


def test_stages(spark, sf_dir, documents, labels, tmp_path):
    assert [k for k, _ in corpus_pipeline.STAGES] == ["toxicity", "n-gram Jaccard join", "suffix-array dedup", "mixing sources", "byte-level BPE"]
    before, kept = documents, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, before, sf_dir)
        if i < 4:
            assert out.columns == documents.columns
        out.write.parquet(str(tmp_path / str(i)))
        kept[name], before = before, spark.read.parquet(str(tmp_path / str(i)))
    after = {name: spark.read.parquet(str(tmp_path / str(i))) for i, (name, _) in enumerate(corpus_pipeline.STAGES)}

    gone = documents.join(after["toxicity"], "doc_id", "left_anti").join(labels, "doc_id")
    assert gone.filter("toxic = 1").count() >= 0.9 * gone.filter("toxic IS NOT NULL").count() > 0
    rows = {r["doc_id"]: r["text"] for r in kept["n-gram Jaccard join"].collect()}
    ids = sorted(rows)
    least = {ids[c] for _, c in components_of([rows[i] for i in ids], 5, 80)}
    assert {r["doc_id"] for r in after["n-gram Jaccard join"].collect()} == least
    assert after["suffix-array dedup"].count() == len(least)
    sources = {r["doc_id"] for r in after["mixing sources"].collect()}
    assert sources == least
    last = after["byte-level BPE"].collect()
    texts = {r["doc_id"]: r["text"] for r in after["mixing sources"].collect()}
    assert all(bytes(r["decoded"]).decode() == texts[r["doc_id"]] for r in last)


def test_stages_take_odd_rows(spark, sf_dir, odd_docs, no_docs, documents):
    columns = documents.columns
    for rows in (odd_docs.select(columns), no_docs.select(columns), odd_docs):
        before = rows
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            before = stage(spark, before, sf_dir)
            if i < 4:
                assert before.columns == rows.columns
        assert (before.count() == 0) == (rows.count() == 0)


def test_the_library_is_whole_without_this_part(tmp_path):
    """A copy without the two folders and the pipeline still lists its queries."""
    import shutil

    for name in ("marketlens", "__spark_entry__.py"):
        source = REPO / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; assert not [q for q in e.queries() if q.startswith('op')]; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
