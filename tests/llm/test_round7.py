"""What the driver is sent of lookups, and what pairs of vectors move."""

import os
import random

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from tickwarden import session
from tickwarden.llm import common, embeddings, simhash


@pytest.fixture
def plans(monkeypatch):
    """The plans, by label, of what is stored."""
    found, stored = {}, common.stored

    def noted(df, label):
        found.setdefault(label, []).append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, label)

    monkeypatch.setattr(common, "stored", noted)
    return found


def test_lookups_are_not_broadcast(spark, plans, monkeypatch):
    """Spark took 34 lookups for one row: of 235,653 fingerprints they were a broadcast of 940 MB."""
    monkeypatch.setattr(simhash, "FEW_CELLS", -1)
    prints = spark.createDataFrame([(random.Random(i).getrandbits(63),) for i in range(300)], "_fp long")
    links = simhash.links(prints)
    assert len(plans["lookups"]) == 1
    for plan in [*plans["lookups"], links._jdf.queryExecution().executedPlan().toString()]:
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert links.count() == 0


def test_the_pipeline_does_not_broadcast_lookups(spark, plans):
    rows = [(i, f"some words of document {i} that no other has {i * i}" if i % 3 else "the same words everywhere") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("s"))
    kept = corpus_pipeline.drop_near_copies(spark, docs, None)
    assert "SortMergeJoin" in plans["lookups"][0] and "Broadcast" not in plans["lookups"][0]
    assert [r["doc_id"] for r in kept.filter("doc_id % 3 = 0").collect()] == [0]


def _vectors(n, size, kind=np.float64):
    mixer = np.random.default_rng(n)
    centre = mixer.standard_normal((n // 12, size))
    return (centre[mixer.integers(0, len(centre), n)] + 0.08 * mixer.standard_normal((n, size))).astype(kind)


def _brute(x, label):
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    linked = (u @ u.T >= 0.98) & (label[:, None] == label[None, :])
    root, before = np.arange(len(x)), None
    while before is None or (before != root).any():
        before, root = root, np.where(linked, root[None, :], len(x)).min(1)
    return linked.sum(1) - 1, root


@pytest.mark.parametrize("kind", ["float", "double"])
def test_vectors_of_several_groups_are_all_compared(spark, monkeypatch, kind):
    """One large label, a small one, copies, lengths of their own: whatever the groups, the links of brute force."""
    monkeypatch.setattr(embeddings, "LEAST_GROUP", 40)
    monkeypatch.setattr(embeddings, "TILE", 8)
    x = _vectors(500, 20, np.float32 if kind == "float" else np.float64)
    x[400:420] = x[:20]
    x[420] = -x[421]
    label = np.where(np.arange(500) % 7 == 3, 1, 0)
    rows = [(i, v.tolist(), int(at)) for i, (v, at) in enumerate(zip(x, label))]
    rows += [(600 + i, v.tolist()[:9], 0) for i, v in enumerate(x[:90])] + [(900, None, 0), (901, [0.0] * 20, 0), (902, [], 0)]
    got = {r["vec_id"]: r for r in embeddings.near_vectors(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")).collect()}
    n, root = _brute(x, label)
    assert n.max() > 5 and (n == 0).any()
    assert [(got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) for i in range(500)] == [(a, b, b == i) for i, (a, b) in enumerate(zip(n, root))]
    n, root = _brute(x[:90, :9], label[:90] * 0)
    assert [(got[600 + i]["n_links"], got[600 + i]["component_id"]) for i in range(90)] == [(a, 600 + b) for a, b in zip(n, root)]
    assert all((got[i]["n_links"], got[i]["component_id"]) == (0, i) for i in (900, 901, 902))


def test_vectors_are_not_copied_to_where_they_meet(spark, monkeypatch):
    """A vector went whole, as doubles, to each cell it visits, and the files of that exchange stayed."""
    monkeypatch.setattr(embeddings, "LEAST_GROUP", 500)
    x, raw = _vectors(6000, 64, np.float32), 6000 * 64 * 4
    table = spark.createDataFrame([(i, v.tolist(), i % 2) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    table = common.stored(table, "vectors")
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    tops = [f.toString() for f in manager.localDirs()]
    files = lambda: {f"{d}/{f}" for top in tops for d, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}
    folder, before, most = session.checkpoint_dir(spark).removeprefix("file:"), files(), []
    held = lambda: sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(folder) for f in names)
    first, stored = held(), common.stored

    def noted(df, label):
        made = stored(df, label)
        most.append(held() - first + sum(os.path.getsize(f) for f in files() - before if os.path.exists(f)))
        return made

    monkeypatch.setattr(common, "stored", noted)
    assert embeddings.near_vectors(table).agg(F.sum("n_links")).first()[0] > 0
    assert max(most) < 4 * raw and len(most) > 3
