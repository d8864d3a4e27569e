"""The pipeline against brute force."""

import inspect

import pytest

from lakelayers.sources import workspace

from . import brute

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "simhash_near_dedup", "decontamination", "mixing"
    ]
    assert all(list(inspect.signature(f).parameters) == ["spark", "docs", "sf_dir"] for _, f in corpus_pipeline.STAGES)


def test_run_equals_brute_force(spark, tmp_path):
    small = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{small}/documents.parquet")
    more = [(9001, "12 34 ... !!", "en", None, 12), (9002, None, None, "src1", 0), (9003, "", "de", "src2", 0)]
    extra = [(9100 + i, f"Eine Zeile, die in drei Dokumenten steht\n{'wort ' * i}der {i} und die das von", "de", None, 0) for i in range(4)]
    given.unionByName(spark.createDataFrame(more + extra, given.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{small}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/benchmark.parquet").select("item_id", "text").collect()]

    docs = [d for d in docs if any(c.isalpha() for c in d[1] or "")]
    kept = brute.dedup_lines([d[:2] for d in docs])
    docs = [(d[0], kept[d[0]][2], *d[2:]) for d in docs]
    near = brute.near_fingerprints([d[:2] for d in docs])
    docs = [d for d in docs if near[d[0]] == d[0]]
    hit = brute.contaminated([d[:2] for d in docs], items)
    docs = [d for d in docs if not hit[d[0]][1]]
    by_id = {d[0]: d for d in docs}
    taken = brute.mixed([(d[0], d[1], d[3]) for d in docs])

    found = [tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    exact = sorted((*map(repr, by_id[doc_id]), turn, float(finish)) for finish, _, turn, _, doc_id in taken)
    found = sorted((*map(repr, r[:5]), r[5], r[6]) for r in found)
    assert [r[:6] for r in found] == [r[:6] for r in exact]
    assert [r[6] for r in found] == pytest.approx([r[6] for r in exact])


def test_entry_without_the_subpackage(tmp_path):
    """The entry module imports, without these queries, if they are not there."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(corpus_pipeline.__file__).resolve().parent
    shutil.copytree(root / "lakelayers", tmp_path / "lakelayers", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and sorted(q) == sorted(e.oracle_sql()), 1; assert 'pipeline' not in q"
    assert subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin"}).returncode == 0


def test_run_leaves_only_its_result(spark, tmp_path, monkeypatch):
    """Tables on the way are removed once their stage is written."""
    monkeypatch.setattr(workspace, "shared_dir", lambda spark: str(tmp_path))
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert found.count() > 0
    assert [p.name.partition("-")[0] for p in (tmp_path / "lakelayers").iterdir()] == ["mixing"]
