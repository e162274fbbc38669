"""Hard negatives: one-bit codes of rotated vectors bound every score, and only what may count is scored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwarden.llm import common
from tickwarden.llm.embeddings import rotation

# Bytes of vectors that a task holds while the anchors stream past.
CHUNK_BYTES = 96_000_000
# Vectors of a chunk at the least.
LEAST_CHUNK = 512
# Bits of an anchor's coordinates when they meet codes.
PLANES = 4
_ROWS = "row long, vec_id long, label long, anchor boolean, size int, x binary, code binary, align double, norm double"


def codes(vectors: DataFrame, scale: int) -> DataFrame:
    """Usable vectors (row, vec_id, label, v, anchor) as integers with a code.

    x: the components floor(scale * c) as int16, or int32 where one needs it, held within +-min(2**31 - 1,
    sqrt(2**62 / size)), so that any score fits a long.  code: the signs of the rotated x; align: the rotated x times
    the code as a unit vector; norm: the length of x.  Left out: vectors that are NULL, empty, or hold NULL or
    non-finite components.
    """
    names = [part.split()[0] for part in _ROWS.split(", ")]

    def run(batches):
        turns = {}
        for batch in batches:
            lists = batch.column("v")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            offsets, sizes = offsets[:-1] - offsets[0], np.diff(offsets)
            for size in np.unique(sizes[sizes > 0]).tolist():
                own = np.flatnonzero(sizes == size)
                x = values[offsets[own][:, None] + np.arange(size)]
                good = np.isfinite(x).all(1)
                own, x = own[good], x[good]
                most = min(2**31 - 1, int(np.sqrt(2.0**62 / size)))
                with np.errstate(over="ignore"):
                    x = np.clip(np.floor(scale * x), -most, most)
                if size not in turns:
                    turns[size] = rotation(size)
                y = x @ turns[size]
                narrow = (np.abs(x) <= 32767).all(1)
                packed = [r.astype(np.int16 if n else np.int32).tobytes() for r, n in zip(x, narrow)]
                bits = np.zeros((len(own), -(-size // 64) * 64), bool)
                bits[:, :size] = y > 0
                at = pa.array(own)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(at) for c in names[:4]), pa.array(np.full(len(own), size, np.int32)), pa.array(packed, pa.binary()),
                     pa.array([b.tobytes() for b in np.packbits(bits, axis=1)], pa.binary()), pa.array(np.abs(y).sum(1) / np.sqrt(size)), pa.array(np.linalg.norm(x, axis=1))],
                    names,
                )

    return vectors.filter("v IS NOT NULL").mapInArrow(run, _ROWS)


def _vectors(blobs: list[bytes], size: int) -> np.ndarray:
    if all(len(b) == 2 * size for b in blobs):
        return np.frombuffer(b"".join(blobs), np.int16).reshape(-1, size)
    return np.stack([np.frombuffer(b, np.int16 if len(b) == 2 * size else np.int32).astype(np.int32) for b in blobs])


class Chunk:
    """Vectors of one length, by label."""

    def __init__(self, rows: dict, size: int):
        label = np.array(rows["label"], np.int64)
        order = np.argsort(label, kind="stable")
        pick = lambda name, kind: np.array(rows[name], kind)[order]
        self.size, self.label = size, label[order]
        self.row, self.vec_id = pick("row", np.int64), pick("vec_id", np.int64)
        self.align, norm = pick("align", np.float64), pick("norm", np.float64)
        self.norm, self.rest = norm, np.sqrt(np.maximum(0, norm**2 - self.align**2) + 1e-9 * norm**2)
        self.x = _vectors(rows["x"], size)[order]
        self.code = np.frombuffer(b"".join(rows["code"]), np.uint64).reshape(len(order), -1)[order]
        self.ones = np.bitwise_count(self.code).sum(1, dtype=np.int64)
        self.turn = rotation(size)

    def same(self, label: int) -> slice:
        return slice(int(np.searchsorted(self.label, label)), int(np.searchsorted(self.label, label, side="right")))

    def interval(self, q: np.ndarray, part: slice) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the scores of `part` with the anchor q, from codes alone.

        A rotated x is align * c + r, with c its code as a unit vector and r orthogonal to c.  So its score is
        align * <q, c> + <q, r>; the first is counted bit by bit from an anchor rounded to PLANES bits, the second is at
        most |q - <q, c> c| |r| by Cauchy and Schwarz, and rounding adds at most the sum of its errors.
        """
        q = q.astype(np.float64)
        turned = q @ self.turn
        root = np.sqrt(self.size)
        low, step = turned.min(), max((turned.max() - turned.min()) / (2**PLANES - 1), 1e-300)
        level = np.clip(np.rint((turned - low) / step), 0, 2**PLANES - 1).astype(np.uint8)
        near = low + step * level
        lost = np.abs(turned - near).sum() / root
        bits = np.zeros((PLANES, self.code.shape[1] * 64), bool)
        bits[:, : self.size] = level >> np.arange(PLANES, dtype=np.uint8)[:, None] & 1
        counted = np.zeros(part.stop - part.start, np.int64)
        for j, plane in enumerate(np.packbits(bits, axis=1)):
            counted += np.bitwise_count(self.code[part] & plane.view(np.uint64)).sum(1, dtype=np.int64) << j
        along = (2 * (low * self.ones[part] + step * counted) - near.sum()) / root
        across = np.sqrt(np.maximum(0, q @ q - np.maximum(0, np.abs(along) - lost) ** 2))
        middle = self.align[part] * along
        reach = self.align[part] * lost + across * self.rest[part] + 1e-9 * np.sqrt(q @ q) * self.norm[part] + 1e-6
        return middle - reach, middle + reach

    def scores(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.x[at].astype(np.int64) @ q

    def best(self, at: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
        """Places in `at` of the n first: higher scores, then smaller ids."""
        if len(at) > 4 * n:
            some = np.flatnonzero(scores >= np.partition(scores, len(scores) - n)[len(scores) - n])
        else:
            some = np.arange(len(at))
        return some[np.lexsort([self.vec_id[at[some]], -scores[some]])[:n]]

    def positives(self, anchor: dict, q: np.ndarray, n: int):
        part = self.same(anchor["label"])
        low, high = self.interval(q, part)
        itself = self.row[part] == anchor["row"]
        low[itself] = high[itself] = -np.inf
        least = np.partition(low, len(low) - n)[len(low) - n] if len(low) > n else -np.inf
        at = np.flatnonzero((high >= least) & ~itself)
        scores = self.scores(q, at + part.start)
        for i in self.best(at + part.start, scores, n):
            yield anchor["row"], int(self.vec_id[at[i] + part.start]), int(scores[i])

    def negatives(self, anchor: dict, q: np.ndarray, n: int, least: int, most: int):
        ranges = [(w, -(-least * w["score"] // 100), most * w["score"] // 100) for w in anchor["wanted"]]
        low, high = self.interval(q, slice(0, len(self.row)))
        own = self.same(anchor["label"])
        low[own] = high[own] = -np.inf
        needed = np.zeros(len(low), bool)
        for _, a, b in ranges:
            may = (high >= a) & (low <= b)
            sure = low[(low >= a) & (high <= b)]
            if len(sure) > n:
                may &= high >= np.partition(sure, len(sure) - n)[len(sure) - n]
            needed |= may
        at = np.flatnonzero(needed)
        scores = self.scores(q, at)
        for w, a, b in ranges:
            inside = np.flatnonzero((scores >= a) & (scores <= b))
            for i in inside[self.best(at[inside], scores[inside], n)]:
                yield anchor["row"], w["place"], w["id"], w["score"], int(self.vec_id[at[i]]), int(scores[i])


def _search(vectors: DataFrame, anchors: DataFrame, chunks: int, find, names: list[str]) -> DataFrame:
    """`find(chunk, anchor, q)` of every anchor with every chunk of the vectors.

    The vectors are dealt into chunks by row number, whatever their label; the anchors go to each chunk, after its
    vectors, and pass a batch at a time.
    """
    dealt = vectors.withColumn("chunk", F.pmod("row", F.lit(chunks)).cast("int")).withColumn("kind", F.lit(0))
    dealt = dealt.withColumn("wanted", F.lit(None).cast("array<struct<place: int, id: long, score: long>>"))
    asked = anchors.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).withColumn("kind", F.lit(1))
    both = dealt.unionByName(asked).repartition(common.partitions(vectors.sparkSession), "chunk").sortWithinPartitions("chunk", "kind")
    schema = pa.schema([(n, pa.int64()) for n in names])

    def run(batches):
        now, held, tables = None, [], None
        for batch in batches:
            chunk, kind = (batch.column(c).to_numpy() for c in ("chunk", "kind"))
            cuts = np.flatnonzero((np.diff(chunk) != 0) | (np.diff(kind) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(chunk)]):
                if not b:
                    continue
                if chunk[a] != now:
                    now, held, tables = chunk[a], [], None
                part = batch.slice(a, b - a)
                if kind[a] == 0:
                    held.append(part.drop_columns(["wanted"]))
                    continue
                if not held:
                    continue
                if tables is None:
                    rows, tables = pa.Table.from_batches(held), {}
                    sizes = rows.column("size").to_numpy()
                    for size in np.unique(sizes).tolist():
                        tables[size] = Chunk(rows.take(np.flatnonzero(sizes == size)).to_pydict(), size)
                    held = [True]
                found = []
                for anchor in part.to_pylist():
                    if own := tables.get(anchor["size"]):
                        found += find(own, anchor, _vectors([anchor["x"]], own.size)[0].astype(np.int64))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], schema=schema)

    return both.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def hard_negatives(
    table: DataFrame, anchor: str | Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, scale: int = 256,
    vec_id: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where `anchor` holds.

    A score is the inner product of vectors in integers (see `codes`).  An anchor's positives are its first other
    rows of the same label, its negatives for each the first rows of another label whose score is from `least` to
    `most` percent of the positive's; higher scores first, ties by smaller id.  rank: place among those.

    First the positives, then the negatives: every chunk of the vectors meets all anchors, intervals of the scores
    come from one-bit codes, and rows whose interval cannot reach what is sought are passed over, never others; the
    rest is scored in integers.  A chunk's best go on, at most 5 or 3 of a search, to a ranking per anchor.  The anchors
    are copied to each chunk, so what is shuffled grows with anchors times vectors over CHUNK_BYTES.

    Rows without id, label or a usable vector take no part; vectors of different length never meet.  Each
    of several rows with the same id counts by itself.  Of other columns nothing is used, whatever their names.
    """
    spark = table.sparkSession
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"),
                        (F.col(label) if isinstance(label, str) else label).alias("label"),
                        F.coalesce(F.expr(anchor) if isinstance(anchor, str) else anchor, F.lit(False)).alias("anchor"))
    rows = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").withColumn("label", F.xxhash64("label"))
    coded = common.stored(codes(rows.withColumn("row", F.monotonically_increasing_id()), scale), "coded-vectors")
    n, size = coded.agg(F.count("*"), F.sum(F.length("x") + F.length("code") + 64)).first()
    chunks = max(-(-(size or 0) // CHUNK_BYTES), min(3 * common.partitions(spark), -(-n // LEAST_CHUNK)), 1)
    anchors = coded.filter("anchor")
    first = F.row_number().over(Window.partitionBy("anchor_row").orderBy(F.desc("score"), "id"))
    found = _search(
        coded, anchors.withColumn("wanted", F.lit(None).cast("array<struct<place: int, id: long, score: long>>")), chunks,
        lambda chunk, anchor, q: chunk.positives(anchor, q, positives), ["anchor_row", "id", "score"],
    )
    found = found.withColumn("place", first).filter(F.col("place") <= positives)
    # a negative score leaves no room between its shares
    wanted = found.filter("score >= 0").groupBy("anchor_row").agg(F.collect_list(F.struct("place", "id", "score")).alias("wanted"))
    asked = common.stored(anchors.join(wanted, F.col("row") == F.col("anchor_row")).drop("anchor_row"), "anchors")
    names = ["anchor_row", "place", "positive_id", "positive_score", "negative_id", "negative_score"]
    found = _search(coded, asked, chunks, lambda chunk, anchor, q: chunk.negatives(anchor, q, negatives, least, most), names)
    rank = F.row_number().over(Window.partitionBy("anchor_row", "place").orderBy(F.desc("negative_score"), "negative_id"))
    found = found.withColumn("rank", rank).filter(F.col("rank") <= negatives)
    known = asked.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    return found.join(known, "anchor_row").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND list_aggregate(list_transform(embedding, lambda x: CASE WHEN x IS NULL OR NOT isfinite(x) THEN 1 ELSE 0 END), 'sum') = 0
), parts AS (SELECT vec_id, label, unnest(e) AS c, generate_subscripts(e, 1) AS i FROM v),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(sum(a.c * b.c) AS BIGINT) AS score
  FROM parts a JOIN parts b ON a.i = b.i AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0 GROUP BY ALL
), positive AS (
  SELECT anchor_id, id, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), ranked AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank
  FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""


def op12_negatives(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(common.table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", label=moved)
