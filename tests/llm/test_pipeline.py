import importlib
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from .test_mixing import by_hand as targets_by_hand
from .test_simhash import by_hand as fingerprint_by_hand
from .test_simhash import classes
from wattloom.llm import attention, mixing, tiling
from wattloom.session import stored

corpus_pipeline = importlib.import_module("corpus_pipeline")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Documents before the first stage and after each."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF), "stage"))
    return out


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_quality(spark, stages):
    docs = stages[0].collect()
    model = attention.fit(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    score = model.scores([attention.encode((r["text"] or "").encode()) for r in docs])
    assert rows(stages[1]) == Counter(tuple(r) for r, s in zip(docs, score, strict=True) if s >= 0.7)
    assert 0 < stages[1].count() < len(docs)


def test_near_duplicates(stages):
    docs = sorted(stages[1].collect())
    found = classes([fingerprint_by_hand(r["text"] or "") for r in docs], lambda a, b: (a ^ b).bit_count() <= 3)
    assert rows(stages[2]) == Counter(tuple(docs[i]) for i in set(found))


def test_leaks(spark, stages):
    items = [tiling.tokens(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = Counter()
    for r in stages[2].collect():
        words = tiling.tokens(r["text"])
        ids = {w: k for k, w in enumerate(dict.fromkeys(words))}
        doc = np.array([ids[w] for w in words])
        covered = [sum(n for *_, n in tiling.tile(np.array([ids.get(w, -1 - k) for k, w in enumerate(x)]), doc)) / len(x) for x in items]
        if max(covered) < 0.8:
            kept[tuple(r)] = 1
    assert rows(stages[3]) == kept


def test_mix(stages):
    docs = stages[3].collect()
    con = duckdb.connect()
    documents = stages[3].toArrow()  # noqa: F841
    taken = {r[0]: r[4] // max(1, r[1]) for r in con.execute(mixing.ORACLE).fetchall() if r[1]}
    assert rows(stages[4]) == Counter({tuple(r): taken[r["doc_id"]] for r in docs if taken.get(r["doc_id"])})
    sizes = Counter()
    for r in docs:
        sizes[r["source"]] += len((r["text"] or "").encode().split())
    assert abs(sum(targets_by_hand(sizes).values()) - 1.5 * sum(sizes.values())) < 1e-6 * sum(sizes.values()) + 1


def test_shards(stages):
    final = stages[5]
    assert rows(final.select(*stages[4].columns)) == rows(stages[4])
    loads = Counter(r["shard"] for r in final.collect())
    assert max(loads.values()) - min(loads.values()) <= 1


def test_run_gives_the_last_stage(spark, stages):
    assert rows(corpus_pipeline.run(spark, SF)) == rows(stages[5])


def test_the_rest_works_without_these_folders(tmp_path):
    root = Path(corpus_pipeline.__file__).parent
    for name in ("__spark_entry__.py", "checks"):
        (tmp_path / name).symlink_to(root / name)
    package = tmp_path / "wattloom"
    package.mkdir()
    for path in (root / "wattloom").iterdir():
        if path.name not in ("llm", "__pycache__"):
            (package / path.name).symlink_to(path)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), [n for n in q if n.startswith('op') and n[2].isdigit() or n == 'pipeline'])"
    # the entry puts its own folder first, so run a copy
    (tmp_path / "__spark_entry__.py").unlink()
    (tmp_path / "__spark_entry__.py").write_text((root / "__spark_entry__.py").read_text())
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120, env={"PATH": "/usr/bin:/bin"})
    assert done.returncode == 0, done.stderr
    assert done.stdout.strip().endswith("[]") and int(done.stdout.split()[0]) > 100
