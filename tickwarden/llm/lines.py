"""Removal of lines that spread over many sites; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwarden.llm import common

# Distinct sites from which on a line is boilerplate.
SITES = 10
# Estimates within this factor of SITES are counted exactly; registers (as a power of two) of a sketch: its standard
# error is 1.6 %, so estimates outside are at least twenty of them away.
NEAR, REGISTERS = 1.5, 12
FEW_ROWS = 200_000  # boilerplate lines (60 bytes each) that may be broadcast


def _written(line: Column) -> Column:
    """Not blank."""
    return F.trim(F.translate(line, "\t\r\x0b\x0c", "    ")) != ""


def boilerplate(rows: DataFrame, sites: int = SITES) -> DataFrame:
    """(h, g, first): lines at `sites` or more distinct sites, with the least (doc_id, key, place) of each.

    `rows`: doc_id, key, source, place, h, g, where h and g are two hashes of a line.  Sketches of the sites are merged
    by line; only lines whose estimate is near the threshold get exact counts.  NULL sites don't count.
    """
    spread = rows.groupBy("h", "g").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("source", REGISTERS)).alias("about"), F.min(F.struct("doc_id", "key", "place")).alias("first")
    )
    spread = common.stored(spread.filter(F.col("about") >= sites / NEAR), "spread-lines")
    near = spread.filter(F.col("about") < sites * NEAR)
    counted = rows.join(near.select("h", "g"), ["h", "g"], "left_semi").groupBy("h", "g").agg(F.count_distinct("source").alias("n"))
    found = near.join(counted.filter(F.col("n") >= sites), ["h", "g"]).select("h", "g", "first")
    return spread.filter(F.col("about") >= sites * NEAR).select("h", "g", "first").union(found)


def without_boilerplate(docs: DataFrame, sites: int = SITES) -> DataFrame:
    """`docs` with text cleaned, and n_lines, n_removed (long) and emptied (boolean) besides.

    Lines end at \\n.  A line that occurs at `sites` distinct sources or more is removed everywhere but where it
    stands first (least doc_id, then place), so nothing is lost altogether.  Blank lines are no candidates.
    emptied: all lines with something in them were removed.  Lines are told apart by 96 bits of hash.

    NULL texts stay NULL with no lines, empty texts have one blank line; repeated rows are cleaned alike; an
    empty table gives no rows.  Columns n_lines, n_removed and emptied are replaced if there; other columns come back
    as they are, whatever their names.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed", "emptied")]
    # the table's own columns travel as one, so that none of their names can clash
    whole = F.struct(*[docs[f"`{c}`"].alias(c) for c in kept])
    rows = docs.select(docs["doc_id"], F.xxhash64(docs["text"]).alias("key"), docs["source"], F.posexplode(F.split(docs["text"], "\n", -1)).alias("place", "line"))
    rows = rows.filter(_written(F.col("line")))
    rows = common.stored(rows.select("doc_id", "key", "source", "place", F.xxhash64("line").alias("h"), F.hash("line").alias("g")), "lines")
    # a text is cut into lines again after the join, so that it moves once
    docs = docs.select(whole.alias("row"), docs["doc_id"].alias("id"), F.xxhash64(docs["text"]).alias("key"))
    spread = common.small(common.stored(boilerplate(rows, sites), "boilerplate"), FEW_ROWS)
    is_first = F.struct("doc_id", "key", "place").eqNullSafe(F.col("first"))
    gone = rows.join(spread, ["h", "g"]).filter(~is_first).groupBy(F.col("doc_id").alias("gone_id"), F.col("key").alias("gone_key")).agg(F.collect_set("place").alias("gone"))
    gone = common.stored(gone, "removed-lines")
    both = docs.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("key") == F.col("gone_key")), "left")
    both = both.withColumn("lines", F.split(F.col("row")["text"], "\n", -1))
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    cleaned = F.array_join(F.transform(places, lambda p: F.get(F.col("lines"), p)), "\n")
    own = {c: F.col("row")[c] for c in kept}
    own["text"] = F.when(F.col("gone").isNull(), own["text"]).otherwise(cleaned)
    return both.select(
        *[column.alias(c) for c, column in own.items()],
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.size("gone") >= F.size(F.filter("lines", _written)), F.lit(False)).alias("emptied"),
    )


ORACLE = f"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM documents
), b AS (
  SELECT line FROM l WHERE trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '' GROUP BY line HAVING count(DISTINCT source) >= {SITES}
), m AS (
  SELECT l.*, b.line IS NOT NULL AND row_number() OVER (PARTITION BY l.line ORDER BY doc_id, place) > 1 AS gone
  FROM l LEFT JOIN b ON l.line = b.line
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS cleaned_sha256
FROM m GROUP BY doc_id
"""


def op9_lines(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return without_boilerplate(docs).select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("cleaned_sha256"))
