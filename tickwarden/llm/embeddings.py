"""Near-duplicate vectors: groups of vectors stored once, joined by range over blocks of rotated coordinates."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwarden import session
from tickwarden.llm import common
from tickwarden.llm.components import components

BLOCK = 8  # coordinates in a block
LEADING = 2  # blocks that bound distances before whole vectors are looked at
TILE = 1024  # neighbouring vectors under one range of the leading coordinates
# Groups of a label, unless their vectors are fewer than LEAST_GROUP or, as doubles, more than GROUP_BYTES.  Every vector
# is counted once for each group that holds links of it.
GROUPS, LEAST_GROUP, GROUP_BYTES = 16, 4096, 64_000_000
FEW_LABELS = 20_000  # labels with several groups that may be broadcast, 60 bytes each
FEW_ASKED = 200_000  # vectors of pairs at the bound that may be broadcast by id, 16 bytes each
SEED = 11
# How far rounding may move a cosine in doubles; nearer to the bound the given components decide.
ROUNDING = 1e-9
# How far rounding to floats may move half a squared distance.
FLOATS = 1e-5
# Components of pairs that are held at once while they are looked at.
GAP_VALUES = 4_000_000
# Tiles of which so large a share may be linked are multiplied out.
DENSE = 1 / 32
# Links that are held before they are joined into trees.
LINKS = 200_000


def rotation(size: int, columns: int | None = None) -> np.ndarray:
    """A fixed random orthogonal matrix, or so many orthonormal columns."""
    q, r = np.linalg.qr(np.random.default_rng(SEED + size).standard_normal((size, columns or size)))
    return q * np.sign(np.diag(r))


def unit_rows(lists: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the usable ones of vectors of one length, and these as they are."""
    x = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    at = np.flatnonzero(np.isfinite(x).all(1) & (x != 0).any(1))
    return at, x[at]


class Forest:
    """Which places are linked: `root` is the least one of each tree."""

    def __init__(self, root: np.ndarray):
        self.root, self.held, self.n = root, [], 0

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        i, j = self.root[i], self.root[j]
        apart = i != j
        if apart.any():
            size = len(self.root)
            found = np.unique(np.minimum(i[apart], j[apart]) * size + np.maximum(i[apart], j[apart]))
            self.held.append(found)
            self.n += len(found)
            if self.n > LINKS:
                self.settle()

    def settle(self) -> np.ndarray:
        if self.held:
            low, high = np.divmod(np.concatenate(self.held), len(self.root))
            self.held, self.n = [], 0
            while True:
                a, b = self.root[low], self.root[high]
                apart = a != b
                if not apart.any():
                    break
                low, high = low[apart], high[apart]
                np.minimum.at(self.root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
                while (self.root[self.root] != self.root).any():
                    self.root = self.root[self.root]
        return self.root


class Group:
    """Usable vectors of one label and length, neighbours beside one another, and bounds of each tile's leading coordinates."""

    def __init__(self, cid: np.ndarray, many: np.ndarray, x: np.ndarray, tile: int, root: np.ndarray | None = None):
        lead = self._leading(x)
        if root is None:
            order = _neighbours(lead, tile)
            cid, many, x, lead, root = cid[order], many[order], x[order], lead[order], np.arange(len(order))
            self.units = self.units[order]
        self.cid, self.many, self.x, self.root, self.tile = cid, many, x, root, tile
        lead = lead.astype(np.float32)
        starts = np.arange(0, len(lead), tile)
        self.low, self.high = np.minimum.reduceat(lead, starts), np.maximum.reduceat(lead, starts)
        half, one = -np.square(lead).sum(1, keepdims=True) / 2, np.ones((len(lead), 1), np.float32)
        # the product of two such rows is minus half their squared distance
        self.lead, self.as_left, self.as_right = lead, np.hstack([lead, half, one]), np.hstack([lead, one, half])
        self.total = np.zeros(len(lead), np.int64)

    def _leading(self, x: np.ndarray) -> np.ndarray:
        self.units = np.empty(x.shape, np.float64)
        for at in range(0, len(x), 16384):
            part = x[at : at + 16384].astype(np.float64)
            part /= np.abs(part).max(1, keepdims=True)
            self.units[at : at + 16384] = part / np.linalg.norm(part, axis=1, keepdims=True)
        return self.units @ rotation(x.shape[1], min(x.shape[1], BLOCK * LEADING))

    def write(self, folder: str) -> str:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base)
        name = uuid.uuid4().hex
        with store.open_output_stream(f"{base}/{name}.part") as out:
            for part in (np.array([self.x.itemsize, *self.x.shape], np.int64), self.cid, self.many, self.root, self.x):
                out.write(np.ascontiguousarray(part).tobytes())
        store.move(f"{base}/{name}.part", f"{base}/{name}.group")
        return f"{folder}/{name}.group"

    @classmethod
    def read(cls, path: str, tile: int) -> Group:
        store, own = fs.FileSystem.from_uri(path)
        with store.open_input_stream(own) as data:
            item, n, size = np.frombuffer(data.read(24), np.int64).tolist()
            cid, many, root = (np.frombuffer(data.read(8 * n), np.int64) for _ in range(3))
            x = np.frombuffer(data.read(item * n * size), np.float32 if item == 4 else np.float64).reshape(n, size)
        return cls(cid, many, x, tile, root)


def _neighbours(lead: np.ndarray, tile: int) -> np.ndarray:
    """An order in which each `tile` rows lie near each other: halved at the coordinate that varies most, again and again."""
    out, left = [], [np.arange(len(lead))]
    while left:
        at = left.pop()
        if len(at) <= tile:
            out.append(at)
            continue
        part = lead[at]
        half = tile * -(-len(at) // (2 * tile))
        order = np.argpartition(part[:, part.std(0).argmax()], half)
        left += [at[order[half:]], at[order[:half]]]
    return np.concatenate(out)


def _within(rows: np.ndarray, low: np.ndarray, high: np.ndarray, budget: float) -> np.ndarray:
    """Places of the rows that are within the budget of a range."""
    gap = np.maximum(np.maximum(low - rows, rows - high), 0)
    return np.flatnonzero(np.einsum("ij,ij->i", gap, gap) <= budget)


def linked(left: Group, right: Group, least: float, forest: Forest):
    """Pairs with cosine >= `least`: counted in the totals and joined in `forest`; yields (i, j) of those at the bound.

    Within one group each pair is looked at once.  Unit vectors with cosine c are 2 - 2c apart (squared), in all
    coordinates and so in the leading ones at most.  Tiles whose ranges are farther apart are passed over, so are
    rows farther from the other tile's range, then pairs; cosines of the rest are computed from all components.
    """
    budget, tile, itself = 2 - 2 * least + 2 * FLOATS, left.tile, left is right
    after = 0 if itself else len(left.cid)
    for a, (low, high) in enumerate(zip(left.low, left.high)):
        gap = np.maximum(np.maximum(right.low - high, low - right.high), 0)
        near = np.flatnonzero(np.einsum("ij,ij->i", gap, gap) <= budget)
        for b in near[near >= a] if itself else near:
            rows, cols = slice(a * tile, (a + 1) * tile), slice(b * tile, (b + 1) * tile)
            i = _within(left.lead[rows], right.low[b], right.high[b], budget) + rows.start
            j = _within(right.lead[cols], low, high, budget) + cols.start
            if not len(i) or not len(j):
                continue
            may = left.as_left[i] @ right.as_right[j].T >= -budget / 2
            met = np.flatnonzero(may)
            if not len(met):
                continue
            if len(met) > DENSE * may.size:
                cosine = left.units[i] @ right.units[j].T
                if itself and a == b:
                    cosine[i[:, None] >= j[None, :]] = -np.inf
                sure = cosine >= least + ROUNDING
                p, q = np.nonzero((cosine >= least - ROUNDING) & ~sure)
                if len(p):
                    yield i[p], j[q]
                left.total[i] += (sure @ right.many[j].astype(np.float64)).astype(np.int64)
                right.total[j] += (left.many[i].astype(np.float64) @ sure).astype(np.int64)
                p, q = np.nonzero(sure & (forest.root[i][:, None] != forest.root[j + after][None, :]))
                forest.link(i[p], j[q] + after)
                continue
            p, q = np.divmod(met, len(j))
            if itself and a == b:
                once = i[p] < j[q]
                p, q = p[once], q[once]
            cosine, step = np.empty(len(p)), max(1, GAP_VALUES // left.x.shape[1])
            for at in range(0, len(p), step):
                own = slice(at, at + step)
                cosine[own] = np.einsum("ij,ij->i", left.units[i[p[own]]], right.units[j[q[own]]])
            sure = cosine >= least + ROUNDING
            p, q, unsure = i[p], j[q], (cosine >= least - ROUNDING) & ~sure
            if unsure.any():
                yield p[unsure], q[unsure]
            i, j = p[sure], q[sure]
            if len(i):
                left.total[rows] += np.bincount(i - rows.start, right.many[j], len(left.total[rows])).astype(np.int64)
                right.total[cols] += np.bincount(j - cols.start, left.many[i], len(right.total[cols])).astype(np.int64)
                forest.link(i, j + after)


def near_vectors(
    table: DataFrame, least: float = 0.98, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row: links to rows of equal label with cosine >= `least`.

    Equal vectors are folded into one beforehand.  The vectors of a label are dealt into groups, at most GROUP_BYTES each,
    which lie in files of the shared folder; every two groups of a label meet in a task that reads both, so no vector is
    copied to where it is compared.  Where groups meet, vectors are joined by range: after a rotation, tiles of
    neighbours, rows and pairs that are too far apart in the first blocks of coordinates are passed over, and the
    cosines of all others are computed in double precision (see `linked`).  Of two groups only counts and a spanning set
    of links among what was not yet linked within them leave.

    NULL labels, and vectors that are NULL, empty, zero or hold NULL or non-finite components, have no
    links; vectors of different lengths neither.  Repeated rows are linked with each other.  component_id
    is the smallest id reachable; NULL ids name no component.  Classes are named by a 64-bit hash of label and
    vector (n classes collide with probability n**2 / 2**65).
    """
    spark = table.sparkSession
    rows = table.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("v"), F.col(label).alias("label"))
    rows = rows.withColumn("cid", F.when(F.col("label").isNotNull() & F.col("v").isNotNull(), F.xxhash64("label", "v")))
    named = common.stored(rows.select("vec_id", "cid"), "vector-ids")
    given = rows.schema["v"].dataType
    if not isinstance(given, T.ArrayType) or not isinstance(given.elementType, T.FloatType):
        rows = rows.withColumn("v", F.col("v").cast("array<double>"))
    classes = rows.filter("cid IS NOT NULL").groupBy("cid").agg(
        F.first("label").cast("string").alias("label"), F.first("v").alias("v"), F.count("*").alias("many")
    )
    held, folder = (session.scratch_path(spark, f"llm-vector-{what}") for what in ("classes", "files"))
    with common.exchanges_deleted(spark):
        classes = session.stored_at(classes, held)
        groups = common.stored(_within_groups(classes, least, folder), "vector-groups")
        across = common.stored(_across_groups(groups, least), "vector-links")
        found = groups.filter("path IS NULL").select("a", "b", "n").union(across)
        found = _decided(found, classes, least)
        session.discard(spark, held, folder)
        roots = components(found.filter("b IS NOT NULL").select("a", "b"))
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("n"))
    own = named.groupBy("cid").agg(F.min("vec_id").alias("least"))
    own = own.join(roots, F.col("cid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cid"))
    smallest = own.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = own.join(smallest, "root").join(counts, "cid").select("cid", "component_id", "n")
    # classes without a usable vector are not in counts, so their rows stay alone
    return named.join(by_class, "cid", "left").select(
        "vec_id",
        F.coalesce(F.col("n") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(F.col("n").isNull(), F.lit(True)).otherwise(F.col("vec_id").eqNullSafe(F.col("component_id"))).alias("kept"),
    )


def _decided(found: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Pairs at the bound (n = -1) become links and counts if the cosine of the components as given says so."""
    asked = found.filter("n = -1").select("a", "b")
    if asked.isEmpty():
        return found

    def scaled(x):
        # a power of two takes no digits away, and keeps squares of very large or small numbers in range
        size = F.array_max(F.transform(x, lambda c: F.abs(c.cast("double"))))
        return F.transform(x, lambda c: c.cast("double") / F.pow(F.lit(2.0), F.floor(F.log2(size))))

    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    asked = common.stored(asked, "vectors-asked")
    # both directions are there
    ids = asked.select(F.col("a").alias("cid")).distinct()
    ids = F.broadcast(ids) if asked.count() <= FEW_ASKED else ids.hint("merge")
    known = common.stored(classes.join(ids, "cid"), "vectors-known")
    left = known.select(F.col("cid").alias("a"), F.col("v").alias("xa"))
    right = known.select(F.col("cid").alias("b"), F.col("v").alias("xb"), "many")
    pairs = asked.join(left, "a").join(right, "b").withColumns({"xa": scaled(F.col("xa")), "xb": scaled(F.col("xb"))})
    cosine = dot(F.col("xa"), F.col("xb")) / (F.sqrt(dot(F.col("xa"), F.col("xa"))) * F.sqrt(dot(F.col("xb"), F.col("xb"))))
    links = pairs.filter(cosine >= least)
    both = F.array(F.struct(F.col("b"), F.lit(0).cast("long").alias("n")), F.struct(F.lit(None).cast("long").alias("b"), F.col("many").alias("n")))
    links = links.select("a", F.explode(both).alias("l")).select("a", "l.b", "l.n")
    return found.filter("n >= 0").unionByName(common.stored(links, "vector-decided"))


def _within_groups(classes: DataFrame, least: float, folder: str) -> DataFrame:
    """(a, b, n, label, size, g, path): rows of `_across_groups` for pairs of the same group, and a row with the file of each group that meets others."""
    spark, tile = classes.sparkSession, TILE
    sized = classes.withColumn("size", F.size("v")).filter("size > 0")
    large = sized.groupBy("label", "size").agg(F.count("*").alias("all"))
    most = F.greatest(F.lit(LEAST_GROUP), F.ceil(F.col("all") / GROUPS))
    most = F.least(most, F.greatest(F.lit(1), F.floor(F.lit(GROUP_BYTES) / (8 * F.col("size")))))
    large = large.filter(F.col("all") > most)
    large = common.stored(large.select("label", "size", F.ceil(F.col("all") / most).cast("int").alias("groups")), "large-labels")
    large = F.broadcast(large) if large.count() <= FEW_LABELS else large.hint("merge")
    dealt = sized.join(large, ["label", "size"], "left").withColumn("groups", F.coalesce("groups", F.lit(1)))
    dealt = dealt.select("label", "size", F.pmod("cid", "groups").cast("int").alias("g"), "groups", "cid", "many", "v")
    dealt = dealt.repartition(common.partitions(spark), "label", "size", "g").sortWithinPartitions("label", "size", "g")
    schema = "a long, b long, n long, label string, size int, g int, path string"

    def finish(parts):
        key = {name: parts[0].column(name)[0].as_py() for name in ("label", "size", "g", "groups")}
        x = [unit_rows(part.column("v"), key["size"]) for part in parts]
        cid, many = (np.concatenate([part.column(c).to_numpy()[at] for part, (at, _) in zip(parts, x)]) for c in ("cid", "many"))
        if not len(cid):
            return
        yield from _meet(own := Group(cid, many, np.concatenate([v for _, v in x]), tile), own, least)
        if key["groups"] > 1:
            path = own.write(folder)
            yield [[None], [None], [None], [key["label"]], [key["size"]], [key["g"]], [path]]

    def run(batches):
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string()]
        names = [part.split()[0] for part in schema.split(", ")]

        def made(parts):
            for columns in finish(parts):
                columns = [*columns, *[[None] * len(columns[0])] * (7 - len(columns))]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        held, now = [], None
        for batch in batches:
            label, size, g = (batch.column(c).to_pylist() for c in ("label", "size", "g"))
            keys = list(zip(label, size, g))
            cuts = [at for at in range(len(keys)) if at and keys[at] != keys[at - 1]]
            for a, b in zip([0, *cuts], [*cuts, len(keys)]):
                if a < b and keys[a] != now:
                    if held:
                        yield from made(held)
                    held, now = [], keys[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from made(held)

    return dealt.mapInArrow(run, schema)


def _meet(left: Group, right: Group, least: float):
    """Columns a, b, n: counts and links of the classes of two groups, or of one."""
    itself = left is right
    starts = left.root if itself else np.concatenate([left.root, right.root + len(left.root)])
    cid = left.cid if itself else np.concatenate([left.cid, right.cid])
    forest, nothing = Forest(starts.copy()), lambda n: pa.nulls(n, pa.int64())
    for i, j in linked(left, right, least, forest):
        a, b = np.concatenate([left.cid[i], right.cid[j]]), np.concatenate([right.cid[j], left.cid[i]])
        yield [a, b, np.full(len(a), -1)]
    roots = forest.settle()
    if itself:
        left.root = roots
        yield [cid, nothing(len(cid)), left.total + left.many]
    else:
        total = np.concatenate([left.total, right.total])
        some = np.flatnonzero(total)
        yield [cid[some], nothing(len(some)), total[some]]
    # what was linked before has the same root as its first one
    moved = np.flatnonzero((roots != np.arange(len(roots))) & (starts == np.arange(len(roots))))
    yield [cid[moved], cid[roots[moved]], np.zeros(len(moved), np.int64)]


def _across_groups(groups: DataFrame, least: float) -> DataFrame:
    """(a, b, n): with b NULL, the rows linked to class a; else a link, or with n = -1 a pair at the bound.  Of pairs of different groups."""
    tile = TILE
    files = groups.filter("path IS NOT NULL").select("label", "size", "g", "path")
    other = files.select("label", "size", F.col("g").alias("h"), F.col("path").alias("with"))
    pairs = common.stored(files.join(other, ["label", "size"]).filter("g < h").select("path", "with"), "vector-pairs")
    spark = groups.sparkSession
    tasks = max(1, min(pairs.count(), 4 * common.partitions(spark)))

    def run(batches):
        path = left = None
        for batch in batches:
            for row in sorted(batch.to_pylist(), key=lambda r: r["path"]):
                if row["path"] != path:
                    path, left = row["path"], Group.read(row["path"], tile)
                left.total[:] = 0
                for a, b, n in _meet(left, Group.read(row["with"], tile), least):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, pa.int64()), pa.array(n)], ["a", "b", "n"])

    return pairs.repartition(tasks).mapInArrow(run, "a long, b long, n long")


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND list_aggregate(list_transform(embedding, lambda x: CASE WHEN x IS NULL OR NOT isfinite(x) THEN 1 ELSE 0 END), 'sum') = 0
    AND list_aggregate(list_transform(embedding, lambda x: CASE WHEN x <> 0 THEN 1 ELSE 0 END), 'sum') > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id AS node, vec_id AS root FROM embeddings
  UNION SELECT l.b, r.root FROM reach r JOIN link l ON l.a = r.node
), low AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node),
n AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, low.component_id, e.vec_id = low.component_id AS kept
FROM embeddings e JOIN low ON low.node = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""


def op5_embeddings(spark, sf_dir):
    return near_vectors(common.table(spark, sf_dir, "embeddings"))
