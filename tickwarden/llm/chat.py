"""Chat formatting: conversations merged into a prefix tree, shared turns written once."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwarden.llm import common

# The marks of the template.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
# Control strings of common chat formats; inside texts they get a backslash after the first character.
# "<|" stands for all that begin so, with this template's own marks.
CONTROL = ("<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
_ESCAPE = re.compile("\\\\|" + "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL))
_TURN = re.compile(f"{re.escape(TURN)}(.*?){re.escape(TEXT)}(.*?){re.escape(END)}", re.DOTALL)
ASSISTANT = "assistant"
_LOW = -(1 << 62)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    """Every backslash was followed by one, or follows the first character of a control string."""
    out, at = [], 0
    while (cut := text.find("\\", at)) >= 0:
        out.append(text[at:cut])
        if text[cut + 1 : cut + 2] == "\\":
            out.append("\\")
            at = cut + 2
        else:
            at = cut + 1
    out.append(text[at:])
    return "".join(out)


def _streamed(rows: DataFrame, by: list[str], order: list[str], run, schema: str) -> DataFrame:
    """`run` over rows that are together by `by`, in order, one after the other."""
    dealt = rows.repartition(common.partitions(rows.sparkSession), *by)
    return dealt.sortWithinPartitions(*by, *order).mapInArrow(run, schema)


def _rows(batches):
    for batch in batches:
        yield from batch.to_pylist()


def _batches(rows, schema: list[tuple[str, pa.DataType]]):
    part = []
    for r in rows:
        part.append(r)
        if len(part) == common.BATCH_ROWS:
            yield _made(part, schema)
            part = []
    if part:
        yield _made(part, schema)


def _made(part, schema):
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in part], t) for i, (_, t) in enumerate(schema)], [n for n, _ in schema])


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, key, position, size, loss_from, loss_to, formatted): each turn, with the key of its prefix.

    Two turns have the same key if their conversations agree up to them.  position: characters of the
    conversation before it.  The loss mask covers [loss_from, loss_to) of `formatted`, the text of an assistant.
    """
    plain = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    kinds = [("conv_id", pa.int64()), ("depth", pa.int64()), ("key", pa.binary()), ("position", pa.int64()), ("size", pa.int64()),
             ("loss_from", pa.int64()), ("loss_to", pa.int64()), ("formatted", pa.string())]

    def chain(batches):
        conv, key, depth, position = object(), b"", 0, 0
        for r in _rows(batches):
            if r["conv_id"] != conv:
                conv, key, depth, position = r["conv_id"], b"", 0, 0
            head = TURN + escape(r["role"]) + TEXT
            text = escape(r["text"])
            formatted = head + text + END
            depth += 1
            key = hashlib.blake2b(key + formatted.encode("utf-8", "surrogatepass"), digest_size=16).digest()
            masked = len(head) + len(text) if r["role"] == ASSISTANT else len(head)
            yield conv, depth, key, position, len(formatted), len(head), masked, formatted
            position += len(formatted)

    return _streamed(
        plain, ["conv_id"], ["turn", "role", "text"], lambda b: _batches(chain(b), kinds),
        "conv_id long, depth long, key binary, position long, size long, loss_from long, loss_to long, formatted string",
    )


def prefix_tree(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The tree's nodes and the conversations' paths through it.

    nodes: (key, start, size, position, attends, loss_from, loss_to, formatted).  Read by `start`, the nodes
    are the depth-first text of the forest: every shared turn once, a branch after the turn it belongs to.  A
    character at offset o of a node has position id `position` + o and may attend to the intervals `attends`
    (struct<from, to>: its ancestors, adjoining ones merged) and to its node up to itself.
    paths: (conv_id, depth, key), a row per turn.

    `conversations`: conv_id, turn, role, text; NULL role or text: empty.  Turns go by turn, then role and text;
    rows without a conv_id form one conversation.  A conversation is read as a stream, so its length is not
    limited by memory; a turn's text is.  A first turn that many share is one node.
    """
    made = common.stored(turns(conversations), "turns")
    slim = made.select("conv_id", "depth", "key", "size", "position")
    first = slim.groupBy("key").agg(F.min(F.coalesce("conv_id", F.lit(_LOW + 1))).alias("first"))
    paths = common.stored(slim.join(first, "key"), "paths")

    def order(batches):
        conv, marks, last = object(), [], None
        for r in _rows(batches):
            if r["conv_id"] != conv:
                conv, marks, last = r["conv_id"], [r["first"]], r["first"]
            elif r["first"] != last:
                marks += [-r["depth"], r["first"]]
                last = r["first"]
            if r["first"] == (_LOW + 1 if conv is None else conv):
                yield r["key"], conv, r["depth"], r["size"], [*marks, _LOW, r["depth"]]

    kinds = [("key", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("size", pa.int64()), ("place", pa.list_(pa.int64()))]
    ordered = _streamed(
        paths.select("conv_id", "depth", "key", "size", "first"), ["conv_id"], ["depth"], lambda b: _batches(order(b), kinds),
        "key binary, conv_id long, depth long, size long, place array<long>",
    )
    # depth-first: a node, its first child's whole line, then the branches from the deepest up
    dealt = ordered.repartitionByRange(common.partitions(made.sparkSession), "place").withColumn("part", F.spark_partition_id())
    dealt = common.stored(dealt, "depth-first")
    parts = dealt.groupBy("part").agg(F.sum("size").alias("total"))
    # as many rows as partitions
    base = parts.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    running = F.sum("size").over(Window.partitionBy("part").orderBy("place"))
    placed = dealt.withColumn("end", running).join(F.broadcast(base), "part")
    placed = common.stored(placed.select("key", "conv_id", "depth", (F.col("base") + F.col("end") - F.col("size")).alias("start")), "placed")

    def attend(batches):
        conv, spans = object(), []
        for r in _rows(batches):
            if r["conv_id"] != conv:
                conv, spans = r["conv_id"], []
            if r["first"] == (_LOW + 1 if conv is None else conv):
                yield r["key"], conv, r["depth"], r["start"], [{"from": a, "to": b} for a, b in spans]
            if spans and spans[-1][1] == r["start"]:
                spans[-1] = (spans[-1][0], r["start"] + r["size"])
            else:
                spans.append((r["start"], r["start"] + r["size"]))

    span = pa.struct([("from", pa.int64()), ("to", pa.int64())])
    kinds = [("key", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("start", pa.int64()), ("attends", pa.list_(span))]
    known = paths.join(placed.select("key", "start"), "key").select("conv_id", "depth", "key", "size", "first", "start")
    attending = _streamed(
        known, ["conv_id"], ["depth"], lambda b: _batches(attend(b), kinds),
        "key binary, conv_id long, depth long, start long, attends array<struct<from: long, to: long>>",
    )
    texts = made.select(F.col("conv_id").alias("c"), F.col("depth").alias("d"), "size", "position", "loss_from", "loss_to", "formatted")
    nodes = attending.join(texts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("depth") == F.col("d")))
    nodes = nodes.select("key", "start", "size", "position", "attends", "loss_from", "loss_to", "formatted")
    return common.stored(nodes, "tree"), paths.select("conv_id", "depth", "key")


def read_back(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Per conversation, from the tree's text: its turns' digest, its text under the loss mask, its length.

    Also checks that position ids run on and that a turn attends to all turns before it.
    """
    rows = paths.join(nodes, "key").drop("key")
    kinds = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
             ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]

    def run(batches):
        conv, state = object(), None

        def done():
            n, turns, chars, loss, size = state
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), size

        for r in _rows(batches):
            if r["conv_id"] != conv:
                if state:
                    yield done()
                conv, state = r["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            if r["position"] != state[4] or sum(s["to"] - s["from"] for s in r["attends"]) != state[4]:
                raise ValueError("a turn does not follow its ancestors")
            role, text = map(unescape, _TURN.fullmatch(r["formatted"]).groups())
            masked = unescape(r["formatted"][r["loss_from"] : r["loss_to"]])
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            state[2] += len(masked)
            state[3].update(masked.encode("utf-8", "surrogatepass"))
            state[4] += r["size"]
        if state:
            yield done()

    return _streamed(
        rows, ["conv_id"], ["depth"], lambda b: _batches(run(b), kinds),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


_MARKS = " + ".join(
    f"(length(x) - length(replace(x, '{c}', ''))) // {len(c)}" for c in ("\\", *CONTROL)
)
ORACLE = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), s AS (
  SELECT *, {_MARKS.replace('(x', '(role')} + {_MARKS.replace('(x', '(text')} AS marks FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(role) + length(text) + marks + {len(TURN + TEXT + END)}) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""


def op4_chat(spark, sf_dir):
    rows = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return read_back(*prefix_tree(rows.union(more)))
