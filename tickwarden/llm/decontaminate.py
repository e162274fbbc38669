"""Benchmark decontamination by a prefix-filtered join of shingles; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwarden.llm import common

WINDOW, SHINGLE = 13, 5
# Benchmark shingles and keys of documents (16 bytes each) that may be broadcast; a tenth of it for prefixes (150 bytes).
FEW_ROWS = 500_000
_SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased runs of ASCII letters and digits and of all other characters; none in NULL."""
    parts = F.split(common.lowered(F.coalesce(text, F.lit(""))), _SPLIT)
    return F.filter(parts, lambda w: w != "")


def _shingles(hashes: str, size: int) -> Column:
    """The hash of `size` words from each place on; at the end they are short and match nothing."""
    own = F.col(hashes)
    return F.transform(own, lambda h, i: F.xxhash64(F.lit(size), h, *[F.get(own, i + k) for k in range(1, size)]))


def windows(items: DataFrame) -> DataFrame:
    """(item_id, size, window): all runs of WINDOW words of each item, or the whole item if it is shorter."""
    own = items.select(F.col("item_id"), words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(WINDOW))
    start = F.explode(F.sequence(F.lit(1), F.size("w") - size + 1))
    own = own.select("item_id", "w", size.alias("size"), start.alias("start"))
    return own.select("item_id", "size", F.array_join(F.slice("w", F.col("start"), F.col("size")), " ").alias("window"))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for each row of `docs`.

    A word is hit if it lies in an occurrence of an item's window; contaminated: some are, and at least one in
    twenty.  A window is a set of shingles of five words (fewer if it is shorter itself).  To be
    contained, its rarest shingle in the corpus, which is all of its prefix, must occur: the prefix is joined
    with the documents' shingles, the place fixes where the window would begin, which must lie
    within the document, and the words there are compared.

    NULL and empty texts have no words; items without words have no windows; equal items and repeated rows
    count each; no items mean no hits.  Other columns are ignored.
    """
    made = common.stored(windows(items.select("item_id", "text")).distinct(), "windows")
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    counted = docs.select("doc_id", "key", F.size(words(F.col("text"))).cast("long").alias("n_words"))

    short = F.least(F.col("size"), F.lit(SHINGLE))
    parts = made.select("window", "size").distinct().select("window", "size", short.alias("m"), F.split("window", " ").alias("w"))
    parts = parts.withColumn("h", F.transform("w", lambda w: F.xxhash64(w)))
    sizes = sorted(r[0] for r in parts.select("m").distinct().collect())  # at most SHINGLE numbers
    of_windows = None
    for m in sizes:
        one = parts.filter(F.col("m") == m).select("window", "size", "m", F.posexplode(_shingles("h", m)).alias("offset", "shingle"))
        one = one.filter(F.col("offset") + m <= F.col("size"))
        of_windows = one if of_windows is None else of_windows.union(one)
    if of_windows is None:
        return _result(counted, None, None)
    of_windows = common.stored(of_windows, "window-shingles")
    known = common.small(common.stored(of_windows.select("shingle").distinct(), "shingles"), FEW_ROWS)

    hashed = docs.select("doc_id", "key", words(F.col("text")).alias("w"))
    hashed = hashed.select("doc_id", "key", F.transform("w", lambda w: F.xxhash64(w)).alias("h"))
    met = None
    for m in sizes:
        one = hashed.select("doc_id", "key", F.size("h").alias("n_words"), F.posexplode(_shingles("h", m)).alias("place", "shingle"))
        one = one.filter(F.col("place") + m <= F.col("n_words")).join(known, "shingle")
        met = one if met is None else met.union(one)
    met = common.stored(met, "met-shingles")

    often = met.groupBy("shingle").agg(F.count("*").alias("often"))
    # windows with a shingle that occurs nowhere are contained nowhere
    ranked = of_windows.join(often, "shingle", "left").groupBy("window", "size").agg(
        F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "shingle", "offset")).alias("rarest")
    )
    prefix = common.stored(
        ranked.filter("rarest.often > 0").select("window", "size", "rarest.shingle", "rarest.offset"), "prefixes"
    )
    found = met.join(common.small(prefix, FEW_ROWS // 10), "shingle").withColumn("start", F.col("place") - F.col("offset"))
    found = found.filter((F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n_words")))
    found = found.groupBy("doc_id", "key").agg(F.collect_set(F.struct("start", "size", "window")).alias("found"))
    found = common.stored(found, "candidates")

    keys = common.small(found.select("doc_id", "key"), FEW_ROWS)
    some = docs.join(keys, common.same(docs, keys, "doc_id", "key"), "left_semi")
    texts = some.join(found, common.same(some, found, "doc_id", "key")).select(some["doc_id"], some["key"], "found", words(F.col("text")).alias("w"))
    equal = lambda c: F.array_join(F.slice(F.col("w"), c["start"] + 1, c["size"]), " ") == c["window"]
    exact = texts.select("doc_id", "key", F.filter("found", equal).alias("found")).filter(F.size("found") > 0)
    exact = common.stored(exact.dropDuplicates(["doc_id", "key"]), "contained")
    covered = F.flatten(F.transform("found", lambda c: F.sequence(c["start"], c["start"] + c["size"] - 1)))
    hits = exact.select("doc_id", "key", F.size(F.array_distinct(covered)).cast("long").alias("n_hit"))
    named = exact.select("doc_id", "key", F.explode(F.array_distinct(F.transform("found", lambda c: c["window"]))).alias("window"))
    named = named.join(made.select("window", "item_id"), "window").groupBy("doc_id", "key").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")
    )
    return _result(counted, hits, named)


def _result(counted: DataFrame, hits: DataFrame | None, named: DataFrame | None) -> DataFrame:
    if hits is None:
        rows = counted.select("*", F.lit(None).cast("long").alias("n_hit"), F.lit(None).cast("array<string>").alias("items"))
    else:
        both = common.stored(hits.join(named, common.same(hits, named, "doc_id", "key")).select(hits["doc_id"], hits["key"], "n_hit", "items"), "hits")
        rows = counted.join(both, common.same(counted, both, "doc_id", "key"), "left").select(counted["*"], "n_hit", "items")
    hit, items = F.coalesce("n_hit", F.lit(0)), F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(
        "doc_id",
        "n_words",
        hit.cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"),
    )


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
n AS (SELECT item_id, w, least(len(w), {WINDOW}) AS size FROM i WHERE len(w) > 0),
s AS (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM n),
win AS (SELECT DISTINCT item_id, size, array_to_string(list_slice(w, pos, pos + size - 1), ' ') AS key FROM s),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
z AS (SELECT DISTINCT size FROM win),
p AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM d, z WHERE len(w) >= size),
h AS (SELECT DISTINCT doc_id, pos, p.size, item_id FROM p JOIN win
      ON win.size = p.size AND win.key = array_to_string(list_slice(w, pos, pos + p.size - 1), ' ')),
c AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM
      (SELECT doc_id, unnest(range(pos, pos + size)) AS place FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM
      (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""


def op2_decontaminate(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination(docs, common.table(spark, sf_dir, "benchmark"))
