"""A corpus cleaned in stages, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwarden import session
from tickwarden.llm import bpe, common, decontaminate, lines, simhash, toxicity


def drop_toxic(spark, docs, sf_dir):
    """Documents scored as toxic (0.5 or more) go; the model learns from the labelled ones of `docs`.

    NULL and empty texts have the score of no words at all, and stay; rows of one id are scored each by its own
    text; an empty table stays empty.  Columns come back as they are, whatever their names.
    """
    common.ready(spark)
    model = toxicity.train(docs, common.table(spark, sf_dir, "labels"))
    name = common.unused(docs.columns, "toxicity")
    return toxicity.score(docs, model, out=name).filter(f"`{name}` < 0.5").select(*_columns(docs))


def drop_boilerplate_lines(spark, docs, sf_dir):
    """Lines on many sites stay only where they stand first; documents that had nothing else go.

    Texts that are NULL, empty or blank stay; repeated rows are cleaned alike; an empty table stays empty.  n_chars
    follows changed texts.  Columns of any name come back, also those the operator would replace.
    """
    common.ready(spark)
    held = {c: common.unused(docs.columns, f"own_{c}") for c in docs.columns if c in ("n_lines", "n_removed", "emptied")}
    cleaned = lines.without_boilerplate(docs.withColumnsRenamed(held)).filter("NOT emptied")
    changed = F.col("n_removed") > 0
    sized = F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    own = {c: F.col(f"`{held.get(c, c)}`") for c in docs.columns} | {"n_chars": sized}
    return cleaned.select(*[own[c].alias(c) for c in docs.columns])


def _columns(docs):
    return [F.col(f"`{c}`") for c in docs.columns]


def drop_near_copies(spark, docs, sf_dir):
    """Of documents whose SimHash fingerprints are linked, the one with the smallest id stays.

    Rows with the same id, or without one, are told apart: of a group one row stays, a row without id only where
    no other has one.  NULL and blank texts are copies of one another; an empty table stays empty.
    """
    common.ready(spark)
    named, row = common.numbered(docs)
    # NULL ids come last
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    found = simhash.near_duplicates(named.select(order.alias("doc_id"), "text"))
    kept = found.filter("kept").select(F.col("doc_id")["row"].alias(row))
    return named.join(kept, row, "left_semi").select(*_columns(docs))


def drop_contaminated(spark, docs, sf_dir):
    """Documents of which benchmark windows cover a twentieth of the words or more go.

    Each row is judged by its own text, also where ids repeat or are NULL.  NULL and empty texts stay; without
    benchmark items all do.
    """
    common.ready(spark)
    named, row = common.numbered(docs)
    found = decontaminate.contamination(named.select(F.col(row).alias("doc_id"), "text"), common.table(spark, sf_dir, "benchmark"))
    gone = found.filter("contaminated").select(F.col("doc_id").alias(row))
    return named.join(gone, row, "left_anti").select(*_columns(docs))


def encode_texts(spark, docs, sf_dir):
    """Token counts and digests of the ids and of the texts decoded from them, a row per document.

    NULL and empty texts have no tokens; repeated rows have a row each.
    """
    common.ready(spark)
    return bpe.digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", encode_texts),
]

# Trained scores and fingerprints cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages applied to documents: the last one's rows.  Each stage states what it does with odd rows."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = session.stored(stage(spark, docs, sf_dir), "corpus-" + name.replace(" ", "-"))
    return docs
