"""SimHash near-duplicates by multi-index hashing."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwarden.llm import common
from tickwarden.llm.components import components

SHINGLE, DISTANCE, HALF = 3, 3, 32
# Entries of one table cell that are joined row by row; fuller cells are compared as tiles.
CELL, TILE = 64, 1024
FEW_CELLS = 20_000  # crowded cells that may be broadcast, 30 bytes each


def fingerprints(docs: DataFrame, text: str = "text", out: str = "_fp", words: int = SHINGLE) -> DataFrame:
    """`docs` with a 64-bit SimHash (long) of each whole text.

    A-Z are lowered, words split at ASCII white space, and every shingle of `words` words (repeats
    count) votes with its XXH64.  Fewer words make one shingle; NULL and blank texts get 0.
    An existing column named `out` is replaced.
    """
    kept = [c for c in docs.columns if c != out]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != out)

    def run(batches):
        for batch in batches:
            texts = batch.column(text).cast(pa.binary()).to_pylist()
            found = pa.array([_fingerprint(t, words) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*kept, out])

    return docs.select(*kept).mapInArrow(run, f"{schema}, `{out}` long")


def _fingerprint(text: bytes | None, size: int) -> int:
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(size)]))
    votes, total, part = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, 42) for s in shingles), np.uint64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(part)
    bits = np.packbits(2 * votes > total, bitorder="little")
    return int(bits.view(np.int64)[0])


def links(prints: DataFrame, out: str = "_fp") -> DataFrame:
    """(a, b): links among the distinct fingerprints, enough to connect all within DISTANCE bits.

    Two halves of 32 bits: fingerprints within 3 bits differ by at most one bit in one half.  Each
    fingerprint looks up its half and those with one more bit set (the partner has the other direction),
    and complete distances are verified.  Cells with many entries are cut into tiles whose links are
    reduced to a spanning set, so no group of copies is paired out.

    A fingerprint makes some 34 lookups and two entries, but Spark takes exploded rows to be as many as before; so lookups
    and entries are sorted and merged, never broadcast by such an estimate.
    """
    own = prints.select(F.col(out).alias("fp")).distinct()
    own = common.stored(own, "fingerprints")
    half = [F.col("fp").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("fp", HALF)]
    entries = own.select("fp", F.posexplode(F.array(*half)).alias("part", "cell"))
    fuller = entries.groupBy("part", "cell").agg(F.count("*").alias("n"))
    looks = entries.select(
        "fp", "part", F.explode(F.concat(F.array("cell"), _one_more_bit(F.col("cell")))).alias("cell"), F.col("cell").alias("home")
    )
    found = looks.hint("merge").join(fuller, ["part", "cell"])
    found = found.filter("home <> cell OR n > 1")
    found = common.stored(found, "lookups")
    entry = entries.withColumnRenamed("fp", "other")
    apart = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    few = (
        found.filter(F.col("n") <= CELL)
        .join(entry.hint("merge"), ["part", "cell"])
        .filter((F.col("fp") != F.col("other")) & (apart <= DISTANCE))
        .select(F.col("fp").alias("a"), F.col("other").alias("b"))
    )
    return few.union(_tiles(found.filter(F.col("n") > CELL), entry))


def _one_more_bit(cell: Column) -> Column:
    """The cells that differ from `cell` by one bit set besides."""
    bits = F.sequence(F.lit(0), F.lit(HALF - 1))
    unset = F.filter(bits, lambda b: F.call_function("getbit", cell, b) == 0)
    return F.transform(unset, lambda b: cell.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b)))


def _tiles(found: DataFrame, entry: DataFrame) -> DataFrame:
    """Links of the crowded cells, tile by tile."""
    looks = found.select("part", "cell", F.col("fp").alias("id"), "n")
    crowded = looks.groupBy("part", "cell").agg(F.count("*").alias("l"), F.first("n").alias("n"))
    across, down = F.ceil(F.col("l") / TILE), F.ceil(F.col("n") / TILE)
    cut = common.stored(crowded.select("part", "cell", across.cast("int").alias("across"), down.cast("int").alias("down")), "crowded-cells")
    cut = F.broadcast(cut) if cut.count() <= FEW_CELLS else cut.hint("merge")

    def dealt(df, mine, others, side):
        tile = F.pmod(F.xxhash64("id"), F.col(mine)).cast("int")
        return df.join(cut, ["part", "cell"]).select(
            "part", "cell", tile.alias(mine), F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias(others), "id",
            F.lit(side).alias("looks"),
        )

    rows = dealt(looks.drop("n"), "across", "down", True).unionByName(
        dealt(entry.withColumnRenamed("other", "id"), "down", "across", False)
    )

    def tile(rows: pd.DataFrame) -> pd.DataFrame:
        ids, looks = rows["id"].to_numpy(np.int64), rows["looks"].to_numpy(bool)
        left, right = ids[looks], ids[~looks]
        apart = np.bitwise_count(left.view(np.uint64)[:, None] ^ right.view(np.uint64)[None, :])
        a, b = common.links_in_tile(apart <= DISTANCE, left, right)
        return pd.DataFrame({"a": a, "b": b})

    return rows.groupBy("part", "cell", "across", "down").applyInPandas(tile, "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint: 16 hex digits, component_id, kept) for each row of `docs`.

    Texts whose fingerprints differ in at most 3 bits are linked; component_id is the smallest id
    reachable (NULL ids name no component unless nothing else is there), kept marks it.  Blank and
    NULL texts have fingerprint zero and are linked with one another.  Other columns are ignored; an
    empty table gives no rows; repeated rows are linked.
    """
    prints = common.stored(
        fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).drop("text"), "prints"
    )
    joined = components(links(prints))
    classes = prints.groupBy("_fp").agg(F.min("doc_id").alias("least"))
    classes = classes.join(joined, F.col("_fp") == F.col("node"), "left").select(
        "_fp", "least", F.coalesce("root", "_fp").alias("root")
    )
    smallest = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(smallest, "root").select("_fp", "component_id")
    return prints.join(named, "_fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def op6_simhash(spark, sf_dir):
    return near_duplicates(common.table(spark, sf_dir, "documents")).drop("kept")
