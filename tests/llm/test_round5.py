"""What the steps of the suffix tree send and leave on disk."""

import os
import time

import numpy as np
from pyspark.sql import functions as F

from tickwarden.llm import common, suffix_tree


def test_suffix_tree_asks_for_pairs_and_contexts_by_small_numbers():
    """A hash of 52 bits took some five bytes of a key, be it of a pair or of a context."""
    n, pack = 20_000, suffix_tree._pack
    words = np.append(np.random.default_rng(3).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2), np.uint64(suffix_tree.END))
    row = {
        "sizes": np.array([n + 1], np.int64).tobytes(), "ids": np.array([1], np.int64).tobytes(), "named": np.array([True]).tobytes(),
        "held": np.array([False]).tobytes(), "words": words.tobytes(), "codes": pack(np.arange(n + 1, dtype=np.uint32)),
    }
    answers = {suffix_tree.WORDS: {0: pack(np.full(n + 1, 12.0))}, suffix_tree.PAIRS: {0: pack(np.full(n, 12, np.float32))}}
    chunk = suffix_tree.Chunk(row, answers, 1, 1e6, n + 1)
    with np.errstate(over="ignore"):
        chunk.know_words()
        [(_, _, pairs, raw, _)] = chunk.ask_pairs()
        assert pairs == n and len(raw) < 3 * n
        chunk.know_pairs()
        [(_, _, contexts, raw, _)] = chunk.ask_nodes1()
        assert contexts == n and len(raw) < n


def test_exchanges_of_a_placed_table_leave_no_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    tops = [f.toString() for f in manager.localDirs()]
    files = lambda: {f for top in tops for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}
    before, adaptive = files(), spark.conf.get("spark.sql.adaptive.enabled")
    placed = common.placed_by(spark.range(10_000).groupBy((F.col("id") % 997).alias("key")).count(), "key")
    end = time.time() + 10
    while files() - before and time.time() < end:
        time.sleep(0.1)
    assert not files() - before
    assert placed.count() == 997 and placed.agg(F.sum("count")).first()[0] == 10_000
    assert spark.conf.get("spark.sql.adaptive.enabled") == adaptive
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
