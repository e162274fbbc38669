"""What a Python worker holds while toxicity is learnt and texts are encoded, and what goes to the one task that fits."""

import os
import random
import tracemalloc

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickwarden.llm import bpe, toxicity


def _labelled(spark, texts, toxic):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return docs, spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")


def test_the_fitting_task_gets_features_and_no_texts(spark):
    """A word of 200,000 letters has four features; its text went to that task whole."""
    mixer = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    texts = ["".join(mixer.choices(letters, k=200_000)) for _ in range(40)]
    docs, labels = _labelled(spark, texts, [i % 2 for i in range(40)])
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    tops = [f.toString() for f in manager.localDirs()]
    files = lambda: {f"{d}/{f}" for top in tops for d, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}
    before = files()
    toxicity.train(docs, labels)
    sizes = [os.path.getsize(f) for f in files() - before if os.path.exists(f)]
    assert sizes and sum(sizes) < 500_000


def test_training_equals_the_rows_at_hand(spark):
    """NULL texts, repeated ids, repeated and NULL labels, a label without a document."""
    mixer = random.Random(5)
    words = ["good", "fine", "day", "müde", "awful", "vile"]
    texts = [None, ""] + [" ".join(mixer.choice(words[:4] if i % 2 else words) for _ in range(8)) for i in range(300)]
    toxic = [None if i % 17 == 3 else int(any(w in (t or "") for w in words[4:])) for i, t in enumerate(texts)]
    docs, labels = _labelled(spark, texts, toxic)
    docs = docs.unionByName(docs.filter("doc_id % 50 = 7"))
    labels = labels.unionByName(labels.filter("doc_id % 40 = 9")).unionByName(spark.createDataFrame([(999, 1)], labels.schema))
    used, weights, bias = toxicity.train(docs, labels)
    kept = labels.filter("toxic IS NOT NULL AND crc32(cast(cast(doc_id AS string) AS binary)) % 5 <> 0").distinct()
    order = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30))
    rows = docs.join(kept, "doc_id").select(order.alias("order"), F.col("doc_id").alias("doc"), F.coalesce("text", F.lit("")).alias("text"), "toxic")
    want = toxicity._fit(rows.toPandas()).sort_values("feature")
    assert len(used) > 3
    assert used.tolist() == want["feature"].tolist()[1:]
    assert [bias, *weights] == pytest.approx(want["weight"].tolist(), rel=1e-9)


def test_hashes_of_words_are_forgotten():
    hashes = toxicity._Hashes()
    for i in range(300_000):
        hashes[b"word %d" % i]
    assert len(hashes) <= 100_000


def test_encoding_holds_the_ids_of_a_batch_only():
    """A block of 10 MB with five million words had all their ids, and places of 8 bytes for each, at once."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    run = bpe.encoder(ranks, public_tokenizers.PATTERN, "text", "ids")
    batch = pa.RecordBatch.from_arrays([pa.array(range(500)), pa.array(["a b c d e f " * 167] * 500)], ["doc_id", "text"])
    tracemalloc.start()
    rows = tokens = 0
    for made in run(iter([batch] * 10)):
        rows += len(made)
        tokens += len(made.column("ids").flatten())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    words = 5_000 * 167 * 6
    assert rows == 5_000 and tokens >= words
    assert peak < 6 * words, peak / words
    assert made.schema.field("ids").type == pa.list_(pa.int32())
