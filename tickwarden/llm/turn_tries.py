"""Conversation prefix tries: double arrays per shard of sorted paths, shared upper nodes merged."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwarden.llm import common
from tickwarden.llm.chat import _batches, _rows, _streamed

# Turns of a conversation that travel as one row.
SEGMENT = 64
# Turns after which a task packs another trie.
SHARD_TURNS = 200_000
# Shared nodes that may be broadcast, some 40 bytes each.
FEW_NODES = 200_000
# Copies of the shared nodes where they are too many for that.
SALTS = 16
ROOT = bytes(16)
KEY = 16
NOTHING = hashlib.sha256(b"").hexdigest()


def _down(key: bytes, turn: bytes) -> bytes:
    """The key of a node from its parent's and its last turn's."""
    return hashlib.blake2b(key + turn, digest_size=KEY).digest()


def segments(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, root, keys, chars, last): runs of at most SEGMENT turns of a conversation.

    root, depth: key and depth of the node before the run; keys: 16 bytes a turn; chars: int64 a turn; last: the
    conversation ends here.  A conversation without turns is one empty run.
    """
    kinds = [("conv_id", pa.int64()), ("depth", pa.int64()), ("root", pa.binary()), ("keys", pa.binary()), ("chars", pa.binary()), ("last", pa.bool_())]

    def run(batches):
        conv, depth, root, keys, chars = None, 0, ROOT, [], []

        def cut(last):
            return conv, depth, root, b"".join(keys), np.array(chars, np.int64).tobytes(), last

        for r in _rows(batches):
            if r["conv_id"] != conv:
                if conv is not None:
                    yield cut(True)
                conv, depth, root, keys, chars = r["conv_id"], 0, ROOT, [], []
            if r["key"] is None:
                continue
            if len(keys) == SEGMENT:
                yield cut(False)
                for key in keys:
                    root = _down(root, key)
                depth, keys, chars = depth + SEGMENT, [], []
            keys.append(r["key"])
            chars.append(r["chars"])
        if conv is not None:
            yield cut(True)

    return _streamed(
        turns.select("conv_id", "place", "key", "chars"), ["conv_id"], ["place"], lambda b: _batches(run(b), kinds),
        "conv_id long, depth long, root binary, keys binary, chars binary, last boolean",
    )


class DoubleArray:
    """A trie over dense symbols from 0 on: state s goes by symbol c to BASE[s] + c if CHECK there is s."""

    def __init__(self, parents: np.ndarray, symbols: np.ndarray, n_roots: int):
        """Node i, from n_roots on, is the child by symbols[i] of parents[i], which is smaller; the others are roots."""
        n = len(parents)
        size = 2 * n + int(symbols.max(initial=0)) + 64
        self.base, self.check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        self.state = np.empty(n, np.int64)
        # roots stand first and belong to no state
        self.state[:n_roots] = np.arange(n_roots)
        self.check[:n_roots] = -2
        free = n_roots
        order = n_roots + np.lexsort([symbols[n_roots:], parents[n_roots:]])
        heads = np.flatnonzero(np.diff(parents[order], prepend=-1))
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(order)]):
            own = order[a:b]
            codes = symbols[own]
            while self.check[free] != -1:
                free += 1
            at = free if b - a == 1 else self._fit(codes - codes[0], free)
            place = at + codes - codes[0]
            parent = self.state[parents[own[0]]]
            self.base[parent] = at - codes[0]
            self.check[place] = parent
            self.state[own] = place

    def _fit(self, shape: np.ndarray, free: int) -> int:
        """The first place from `free` on where all of `shape` is free; looked for in a window, else at the end."""
        span = int(shape[-1]) + 1
        window = np.flatnonzero(self.check[free : free + 256] == -1) + free
        window = window[window + span <= len(self.check)]
        fits = np.flatnonzero((self.check[window[:, None] + shape] == -1).all(1)) if len(window) * len(shape) < 1 << 20 else []
        if len(fits):
            return int(window[fits[0]])
        end = int(np.flatnonzero(self.check != -1)[-1]) + 1
        if end + span + 64 > len(self.check):
            more = max(len(self.check), span + 64)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])
        return end

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Where the states go; -1 where there is no way."""
        to = self.base[states] + symbols
        inside = (to >= 0) & (to < len(self.check))
        to = np.where(inside, to, 0)
        return np.where(inside & (self.check[to] == states), to, -1)


def _pack(paths: list[np.ndarray], root_of: np.ndarray, n_roots: int, n_symbols: int) -> DoubleArray:
    """The trie of paths below their roots, found level by level."""
    sizes = np.array([len(p) for p in paths])
    starts = np.cumsum(sizes) - sizes
    flat = np.concatenate([*paths, np.zeros(0, np.int64)])
    parents, symbols, total = [np.full(n_roots, -1)], [np.full(n_roots, -1)], n_roots
    node = root_of.copy()
    for level in range(int(sizes.max(initial=0))):
        at = np.flatnonzero(sizes > level)
        pair = node[at] * n_symbols + flat[starts[at] + level]
        fresh, which = np.unique(pair, return_inverse=True)
        parents.append(fresh // n_symbols)
        symbols.append(fresh % n_symbols)
        node[at] = total + which
        total += len(fresh)
    return DoubleArray(np.concatenate(parents).astype(np.int64), np.concatenate(symbols).astype(np.int64), n_roots)


def shard_nodes(rows: list[dict]) -> list[tuple]:
    """The nodes of one shard: `rows` of segments, sorted by root, keys and conv_id.

    Nodes on the way to the first or last row, roots, and nodes that lead to the end of a full segment may go on
    in other shards: these are marked as shared, and give what this shard adds to them.  The others are complete.
    """
    number: dict[bytes, int] = {}
    roots: dict[bytes, int] = {}
    paths, depths = [], []
    for r in rows:
        paths.append(np.array([number.setdefault(r["keys"][i : i + KEY], len(number)) for i in range(0, len(r["keys"]), KEY)], np.int64))
        if r["root"] not in roots:
            roots[r["root"]] = len(roots)
            depths.append(r["depth"])
    turns = list(number)
    root_of = np.array([roots[r["root"]] for r in rows])
    trie = _pack(paths, root_of, len(roots), max(1, len(number)))

    states = len(trie.check)
    depth, chars, count = np.zeros(states, np.int64), np.zeros(states, np.int64), np.zeros(states, np.int64)
    least = np.full(states, np.iinfo(np.int64).max)
    shared = np.zeros(states, bool)
    keys: dict[int, bytes] = dict(enumerate(roots))
    depth[: len(roots)], shared[: len(roots)] = depths, True
    conv = np.array([r["conv_id"] for r in rows], np.int64)
    sizes = np.array([len(p) for p in paths])
    state = root_of.copy()
    # a later segment's root was counted at the end of the one before
    begin = np.flatnonzero(np.array(depths)[root_of] == 0)
    np.add.at(count, state[begin], 1)
    np.minimum.at(least, state[begin], conv[begin])
    open_end = (sizes == SEGMENT) | (np.arange(len(rows)) == 0) | (np.arange(len(rows)) == len(rows) - 1)
    levels = []
    for level in range(int(sizes.max(initial=0))):
        at = np.flatnonzero(sizes > level)
        state[at] = trie.step(state[at], np.array([paths[i][level] for i in at]))
        count += np.bincount(state[at], minlength=states)
        np.minimum.at(least, state[at], conv[at])
        shared[state[at[open_end[at]]]] = True
        found, where = np.unique(state[at], return_index=True)
        levels.append(found)
        depth[found] = depth[trie.check[found]] + 1
        for s, i in zip(found.tolist(), at[where].tolist()):
            keys[s] = _down(keys[int(trie.check[s])], turns[paths[i][level]])
            chars[s] = np.frombuffer(rows[i]["chars"], np.int64)[level]
    ends: dict[int, list[int]] = {}
    for i in np.flatnonzero([r["last"] for r in rows]).tolist():
        ends.setdefault(int(state[i]), []).append(int(conv[i]))

    inner = np.concatenate([f[~shared[f]] for f in levels]) if levels else np.zeros(0, np.int64)
    children = np.bincount(trie.check[inner], minlength=states)
    leaves = np.where(shared, 0, children == 0).astype(np.int64)
    saved = np.where(shared, 0, (count - 1) * chars)
    for found in reversed(levels):
        own = found[~shared[found]]
        np.add.at(leaves, trie.check[own], leaves[own])
        np.add.at(saved, trie.check[own], saved[own])

    out = []
    for s in [*range(len(roots)), *(int(x) for f in levels for x in f)]:
        text = ",".join(map(str, ends.get(s, ())))
        top = s < len(roots)
        known = None if least[s] == np.iinfo(np.int64).max else int(least[s])
        sums = int(count[s]), int(children[s]), int(leaves[s]), int(saved[s])
        if shared[s]:
            parent = None if top else keys[int(trie.check[s])]
            out.append((True, keys[s], parent, int(depth[s]), known, None, None if top and depth[s] else int(chars[s]), *sums, ends[s][0] if s in ends else None, text))
        else:
            above = int(trie.check[s])
            out.append((False, None, keys[above] if shared[above] else None, int(depth[s]), known, None if shared[above] else int(least[above]), None, *sums, None,
                        hashlib.sha256(text.encode()).hexdigest()))
    return out


def _shards(runs: DataFrame) -> DataFrame:
    order = ["root", "keys", "conv_id"]
    dealt = runs.repartitionByRange(common.partitions(runs.sparkSession), *order).sortWithinPartitions(*order)
    numbers = ("depth", "conv_id", "parent_conv_id", "chars", "n_convs", "n_children", "n_leaves", "saved", "first_end")
    kinds = [("shared", pa.bool_()), ("key", pa.binary()), ("parent", pa.binary()), *((n, pa.int64()) for n in numbers), ("ends", pa.string())]

    def run(batches):
        held, turns = [], 0
        for r in _rows(batches):
            held.append(r)
            turns += 1 + len(r["keys"]) // KEY
            if turns >= SHARD_TURNS:
                yield from shard_nodes(held)
                held, turns = [], 0
        if held:
            yield from shard_nodes(held)

    schema = "shared boolean, key binary, parent binary, " + ", ".join(f"{n} long" for n in numbers) + ", ends string"
    return dealt.mapInArrow(lambda b: _batches(run(b), kinds), schema)


def _merged(parts: DataFrame) -> DataFrame:
    """Shared nodes from what the shards add to them: (key, parent, depth, conv_id, n_convs, n_children, n_leaves, saved, ends)."""
    nodes = parts.groupBy("key").agg(
        F.max("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
    )
    nodes = common.stored(nodes, "shared-nodes")
    below = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("above")).agg(F.count("*").alias("more"))
    nodes = nodes.join(below, F.col("key") == F.col("above"), "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    nodes = nodes.withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("long"))
    nodes = nodes.withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * F.coalesce("chars", F.lit(0)))

    def digest(batches):
        key, state = None, None
        for r in _rows(batches):
            if r["key"] != key:
                if state:
                    yield key, state.hexdigest()
                key, state = r["key"], hashlib.sha256(r["ends"].encode())
            else:
                state.update(f",{r['ends']}".encode())
        if state:
            yield key, state.hexdigest()

    pieces = parts.filter("first_end IS NOT NULL").select("key", "first_end", "ends")
    kinds = [("ended", pa.binary()), ("sha", pa.string())]
    digests = _streamed(pieces, ["key"], ["first_end"], lambda b: _batches(digest(b), kinds), "ended binary, sha string")
    nodes = nodes.join(digests, F.col("key") == F.col("ended"), "left").withColumn("ends", F.coalesce("sha", F.lit(NOTHING)))
    nodes = common.stored(nodes.select("key", "parent", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends"), "merged-nodes")

    # sums over subtrees: after round k a node has those less than 2**k below it, and knows its ancestor 2**k above
    sums = nodes.select("key", F.col("parent").alias("up"), "n_leaves", "saved")
    while sums.filter("up IS NOT NULL").limit(1).count():
        given = sums.filter("up IS NOT NULL").groupBy(F.col("up").alias("to")).agg(F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
        higher = sums.select(F.col("key").alias("via"), F.col("up").alias("next"))
        sums = sums.join(given, F.col("key") == F.col("to"), "left").join(higher, F.col("up") == F.col("via"), "left")
        sums = sums.select("key", F.col("next").alias("up"), (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"))
        sums = common.stored(sums, "subtree-sums")
    return nodes.drop("n_leaves", "saved").join(sums.drop("up"), "key")


def prefix_nodes(turns: DataFrame) -> DataFrame:
    """The nodes of all conversations' prefix tree: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    `turns`: conv_id, place (order), key (16 bytes that name a turn), chars; and a row with NULL key per conversation, at
    the least place, so that conversations without turns count.  Sorted by path, conversations are dealt into ranges,
    whatever how many share a turn or are equal; each range is cut into shards of SHARD_TURNS turns, and a shard's
    turns, numbered densely, are packed into BASE and CHECK arrays and walked.  Only nodes that may lie in several
    shards are merged by key; subtree sums climb among these in as many rounds as their depth has bits.

    Rows without conv_id take no part; a table without rows has no root.  Repeated rows are repeated turns.
    Columns of other names are not read.
    """
    runs = common.stored(segments(turns.filter("conv_id IS NOT NULL")), "segments")
    made = common.stored(_shards(runs), "shard-nodes")
    above = common.stored(_merged(made.filter("shared")), "upper-nodes")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256")]
    inner = made.filter("NOT shared")
    named = above.select(F.col("key").alias("above"), F.col("conv_id").alias("above_conv"))
    hanging = inner.filter("parent IS NOT NULL")
    if named.count() <= FEW_NODES:
        hanging = hanging.join(F.broadcast(named), F.col("parent") == F.col("above"))
    else:
        salted = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        hanging = hanging.withColumn("own_salt", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS)))
        hanging = hanging.join(salted, (F.col("parent") == F.col("above")) & (F.col("own_salt") == F.col("salt")))
    hanging = hanging.withColumn("parent_conv_id", F.col("above_conv")).select(*columns)
    upper = above.join(named, F.col("parent") == F.col("above"), "left").withColumnRenamed("above_conv", "parent_conv_id")
    return inner.filter("parent IS NULL").select(*columns).unionByName(hanging).unionByName(upper.select(*columns))


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, key, chars): turns in order from 1 on; NULL turns first, ties by role and text, both NULL as empty.

    Of the texts only those of tied turns are shuffled.
    """
    said = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    name = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    said = said.withColumn("key", F.unhex(F.substring(name, 1, 2 * KEY))).withColumn("chars", F.length("text").cast("long"))
    ties = said.groupBy("conv_id", "turn").agg(F.min("key").alias("a"), F.max("key").alias("b")).filter("a <> b").select("conv_id", "turn")
    ties = common.small(common.stored(ties.withColumn("tied", F.lit(True)), "tied-turns"), FEW_NODES)
    both = said.join(ties, common.same(said, ties, "conv_id", "turn"), "left").drop(ties["conv_id"]).drop(ties["turn"])
    tie = [F.when(F.col("tied"), F.col(c)).alias(c) for c in ("role", "text")]
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text", "key"))
    return both.select("conv_id", "turn", "key", "chars", *tie).select("conv_id", place.cast("long").alias("place"), "key", "chars")


def rebuilt(conversations: DataFrame, together: int = 100, heads: int = 6) -> DataFrame:
    """Turns for `prefix_nodes` of conversations that begin alike.

    Conversation c begins with the first h turns of conversation c - c % together (all if it has fewer), with
    h = crc32(c) % heads, and goes on with its own turns after its first h.
    """
    own = common.stored(numbered(conversations), "numbered-turns")
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    convs = own.filter("place = 1").select("conv_id", taken.alias("h"), (F.col("conv_id") - F.col("conv_id") % together).alias("base"))
    first = own.filter((F.col("place") < heads) & (F.col("conv_id") % together == 0))
    first = first.select(F.col("conv_id").alias("from"), "place", "key", "chars")
    begun = convs.join(first, (F.col("base") == F.col("from")) & (F.col("place") <= F.col("h"))).select("conv_id", "place", "key", "chars")
    marks = convs.select("conv_id", F.lit(0).cast("long").alias("place"), F.lit(None).cast("binary").alias("key"), F.lit(0).cast("long").alias("chars"))
    return marks.unionByName(begun).unionByName(own.filter(F.col("place") > taken))


ORACLE = """
WITH RECURSIVE said AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (SELECT DISTINCT conv_id FROM said),
crc AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS s, 0 AS step, CAST(4294967295 AS BIGINT) AS v FROM ids
  UNION ALL
  SELECT conv_id, s, step + 1, CASE WHEN x % 2 = 1 THEN xor(x // 2, CAST(3988292384 AS BIGINT)) ELSE x // 2 END
  FROM (
    SELECT conv_id, s, step, CASE WHEN step % 8 = 0 THEN xor(v, CAST(ascii(substr(s, step // 8 + 1, 1)) AS BIGINT)) ELSE v END AS x
    FROM crc WHERE step < 8 * length(s)
  ) AS next
), head AS (SELECT conv_id, xor(v, CAST(4294967295 AS BIGINT)) % 6 AS h FROM crc WHERE step = 8 * length(s)),
turns AS (
  SELECT h.conv_id, b.place, b.role, b.text FROM head h JOIN said b ON b.conv_id = h.conv_id - h.conv_id % 100 AND b.place <= h.h
  UNION ALL SELECT o.conv_id, o.place, o.role, o.text FROM said o JOIN head h ON h.conv_id = o.conv_id WHERE o.place > h.h
), path AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth, length(text) AS chars,
    string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS path
  FROM turns
  UNION ALL SELECT conv_id, 0, 0, '' FROM ids
), ended AS (SELECT conv_id, max(depth) AS n FROM path GROUP BY conv_id),
node AS (
  SELECT p.path, p.depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, max(p.chars) AS chars,
    sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (p.depth = e.n), '')) AS ends_sha256
  FROM path p JOIN ended e ON e.conv_id = p.conv_id GROUP BY p.path, p.depth
), kin AS (
  SELECT n.path, n.depth, n.n_convs, n.chars, a.path AS above, a.depth AS above_depth
  FROM node n JOIN path a ON a.conv_id = n.conv_id AND a.depth <= n.depth
), child AS (SELECT above AS path, count(*) AS n_children FROM kin WHERE depth = above_depth + 1 GROUP BY above),
sums AS (
  SELECT k.above AS path, CAST(sum((k.n_convs - 1) * k.chars) AS BIGINT) AS saved_tokens, count(*) FILTER (c.n_children IS NULL) AS n_leaves
  FROM kin k LEFT JOIN child c ON c.path = k.path GROUP BY k.above
), up AS (SELECT k.path, p.conv_id AS parent_conv_id FROM kin k JOIN node p ON p.path = k.above WHERE k.depth = k.above_depth + 1)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, up.parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, s.n_leaves,
  s.saved_tokens, n.ends_sha256
FROM node n JOIN sums s ON s.path = n.path LEFT JOIN child c ON c.path = n.path LEFT JOIN up ON up.path = n.path
"""


def op11_tries(spark, sf_dir):
    return prefix_nodes(rebuilt(common.table(spark, sf_dir, "conversations")))
