"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwarden.llm import common

BITS = 22
# Labelled rows (expected number) the model is fitted on; fewer if there are fewer.
SAMPLE_ROWS = 16_000
PASSES = 5
ALPHA, BETA, L1, L2 = 0.5, 1.0, 8.0, 0.0
# Hashes of words a worker remembers, some 200 bytes each.
HASHES = 100_000
# Endings vary, so words also count by how they begin.
STEMS = (4, 5, 6)
# Columns of the rows that are fitted, and of what they give.
FITTED, MODEL = ["order", "doc", "toxic", "features"], ["feature", "weight"]
# ASCII letters and digits (lowered) and all bytes of other characters make words.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= HASHES:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 7)
        return value


def features(text: bytes | None, hashes: _Hashes) -> np.ndarray:
    """Hashed words, words cut to their first STEMS bytes, pairs of neighbours, and pairs with one word between."""
    words = (text or b"").translate(_WORDS).split()
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    odd = np.uint64(0x9E3779B97F4A7C15)
    all_of = [h * odd, (h[:-1] * np.uint64(31) + h[1:]) * odd + np.uint64(1), (h[:-2] * np.uint64(37) + h[2:]) * odd + np.uint64(2)]
    for size in STEMS:
        cut = [w[:size] for w in words if len(w) > size]
        all_of.append(np.fromiter(map(hashes.__getitem__, cut), np.uint64, len(cut)) * odd + np.uint64(size))
    mixed = np.concatenate(all_of)
    mixed ^= mixed >> np.uint64(29)
    return (mixed * odd >> np.uint64(64 - BITS)).astype(np.int32)


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    """The model of the rows at hand, as `train` learns it from a table's: texts, labels, and their order."""
    rows = rows.sort_values(["order", "doc"], kind="stable")
    hashes = _Hashes()
    x = [np.unique(features(t, hashes)) for t in rows["text"].str.encode("utf-8")]
    return pd.DataFrame(dict(zip(MODEL, _learnt(x, rows["toxic"].to_numpy(np.float64)))))


def _learnt(x: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and weights learnt by going through the rows PASSES times; -1 is the bias."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias = np.log((y.sum() + 1) / (len(y) - y.sum() + 2))
    bias_n, mixer = 0.0, np.random.default_rng(5)
    for _ in range(PASSES):
        for i in mixer.permutation(len(y)):
            at = x[i]
            zi, ni = z[at], n[at]
            root = np.sqrt(ni)
            w = np.where(np.abs(zi) <= L1, 0, (np.sign(zi) * L1 - zi) / ((BETA + root) / ALPHA + L2))
            g = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -35, 35))) - y[i]
            z[at] = zi + g - (np.sqrt(ni + g * g) - root) / ALPHA * w
            n[at] = ni + g * g
            bias_n += g * g
            bias -= ALPHA / (BETA + np.sqrt(bias_n)) * g
    used = np.flatnonzero(np.abs(z) > L1)
    w = (np.sign(z[used]) * L1 - z[used]) / ((BETA + np.sqrt(n[used])) / ALPHA + L2)
    return np.append(used, -1), np.append(w, bias)


def _featured(batches):
    """Texts replaced by their distinct features, four bytes each."""
    hashes = _Hashes()
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        packed = pa.array([np.unique(features(t, hashes)).tobytes() for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in FITTED[:-1]), packed], FITTED)


def _model(batches):
    """The model of featured rows, which come in order; of all of them only features and labels are held."""
    x, y = [], []
    for batch in batches:
        x += [np.frombuffer(f, np.int32) for f in batch.column("features").to_pylist()]
        y += batch.column("toxic").to_pylist()
    if x:
        feature, weight = _learnt(x, np.array(y, np.float64))
        yield pa.RecordBatch.from_arrays([pa.array(feature, pa.int64()), pa.array(weight, pa.float64())], MODEL)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """Sorted features, their weights, and the bias; at most 2**BITS entries, of which L1 leaves few.

    Learns from labelled documents whose crc32(doc_id as text) mod 5 is not 0.  Of these a sample by a hash
    of the id, of `sample_rows` rows in expectation, is taken at any size of the input.  Labels
    that are NULL are ignored; of several for one document the largest counts.  Without labelled rows the model is
    a bias that rejects nothing.
    """
    usable = labels.filter((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0) & F.col("toxic").isNotNull())
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, sample_rows / max(1, usable.count()))
    order = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30))
    taken = usable.withColumn("order", order).filter(F.col("order") < int(share * (1 << 30)))
    # at most about sample_rows rows of 20 bytes
    rows = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(taken), "doc_id")
    fitted = rows.select("order", F.col("doc_id").alias("doc"), F.col("toxic").cast("int"), "text")
    # texts become features where they lie; one task then goes through the rows, some 7 kB each, a batch at a time
    fitted = fitted.mapInArrow(_featured, f"order long, doc {fitted.schema['doc'].dataType.simpleString()}, toxic int, features binary")
    fitted = fitted.repartition(1).sortWithinPartitions(*FITTED)
    found = fitted.mapInArrow(_model, "feature long, weight double").toPandas().sort_values("feature")
    if not len(found):
        return np.zeros(0, np.int32), np.zeros(0), float(np.log(0.5))
    return found["feature"].to_numpy(np.int32)[1:], found["weight"].to_numpy()[1:], float(found["weight"].iat[0])


def score(docs: DataFrame, model, text: str = "text", out: str = "toxicity") -> DataFrame:
    """`docs` with the probability of toxicity of each whole text as column `out` (replaced if there).

    NULL and empty texts get the bias alone.
    """
    used, weights, bias = model
    kept = [c for c in docs.columns if c != out]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != out)

    def run(batches):
        hashes = _Hashes()
        dense = np.zeros(1 << BITS, np.float32)
        dense[used] = weights

        def one(t):
            at = features(t, hashes)
            at = np.unique(at[dense[at] != 0])
            return 1 / (1 + np.exp(-np.clip(bias + float(dense[at].sum(dtype=np.float64)), -35, 35)))

        for batch in batches:
            texts = batch.column(text).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([one(t) for t in texts], pa.float64())], [*kept, out])

    return docs.select(*kept).mapInArrow(run, f"{schema}, `{out}` double")


def op3_toxicity(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, common.table(spark, sf_dir, "labels"))
    return score(docs, model, out="score").select(
        "doc_id",
        (F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
