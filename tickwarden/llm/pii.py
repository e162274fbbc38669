"""Personal data: patterns of four kinds, and identifiers found by the company they keep; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwarden.llm import common

KINDS = ("email", "ip", "card", "phone")
# Possessive and anchored at the start of a run, so that no run is read twice; they match what the plain forms match.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a pattern to be tried.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
# What may be taken for a kind by its context: words with a digit, words without one that hold an @ or stand-in, and
# groups of digits apart by spaces.
CANDIDATES = {
    "tokens": r"(?<!\S)[^\s0-9]*+[0-9]\S*+",
    "addresses": r"(?<!\S)(?=[^\s0-9]*+(?!\S))(?=\S*?(?:@|\((?i:at)\)|\[(?i:at)\]))\S++",
    "groups": r"(?<![^\s\"'\[<:;,])[(+]?[0-9][0-9()./_-]*+(?:\x20++\(?[0-9][0-9()./_-]*+(?=[^\sA-Za-z0-9]*+(?!\S)))++",
}
CANDIDATE_HINTS = {"tokens": "[0-9]", "addresses": r"@|\((?i:at)\)|\[(?i:at)\]", "groups": r"[0-9][()./_-]*+\x20++\(?[0-9]"}
# What a token must look like to be taken for a kind by its context.
SHAPES = {
    "email": r"[^@\s]+(?:@|\(at\)|\[at\])[^@\s]+",
    "ip": r"[0-9a-fA-F]+(?:[.:]+[0-9a-fA-F]+){2,}",
    "card": r"(?:[0-9][.\x20_/-]?){12,19}",
    "phone": r"\(?(?:[0-9][().\x20_/-]*){6,15}",
}
# A context is looked for this near first, and where its words reach farther in all there is.
CONTEXT_CHARS = 80
ROUNDS, SUPPORT, PRIOR, CONFIDENT = 3, 3, 1.0, 0.8


def _once(value: Column, use) -> Column:
    """`use(value)`, where the value is worked out once, however often it is named."""
    return F.get(F.transform(F.array(value), use), 0)


def _in_blocks(items: Column, use) -> Column:
    """`use(blocks)`: an array cut into about as many blocks as a block has entries.

    An array that grows entry by entry is copied each time, so what runs through a text in order does so in two
    levels: over blocks, and within each.
    """

    def cut(own: Column) -> Column:
        size = F.greatest(F.ceil(F.sqrt(F.size(own))), F.lit(1)).cast("int")
        numbers = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(own) / size), F.lit(1)).cast("int") - 1)
        return _once(F.transform(numbers, lambda i: F.slice(own, i * size + 1, size)), use)

    return _once(items, cut)


def _running(sizes: Column, before: Column) -> Column:
    """What comes before each entry: `before`, and the entries so far."""
    begin = F.struct(before.alias("at"), F.array().cast("array<int>").alias("out"))
    add = lambda a, s: F.struct((a["at"] + s).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out"))
    return F.aggregate(sizes, begin, add, lambda a: a["out"])


def _starts(sizes: Column) -> Column:
    """Where each match ends what stands before it, from array<struct<gap, own>>: its start."""
    whole = lambda part: F.transform(part, lambda s: s["gap"] + s["own"])

    def placed(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda part: F.aggregate(whole(part), F.lit(0), lambda a, s: a + s))
        each = lambda part, at: F.zip_with(part, _running(whole(part), at), lambda s, x: x + s["gap"])
        return F.flatten(F.zip_with(blocks, _running(totals, F.lit(0)), each))

    return _in_blocks(sizes, placed)


def _untouched(tokens: Column, spans: Column) -> Column:
    """The tokens that touch none of the spans; a block of spans away from a token is passed over whole."""
    plain = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"))))
    near = lambda s, t: (s["start"] < t["stop"]) & (s["stop"] > t["start"])

    def free(blocks: Column) -> Column:
        ranged = F.transform(blocks, lambda b: F.struct(F.get(b, 0)["start"].alias("start"), F.array_max(F.transform(b, lambda s: s["stop"])).alias("stop"), b.alias("spans")))
        return _once(ranged, lambda r: F.filter(tokens, lambda t: ~F.exists(r, lambda b: near(b, t) & F.exists(b["spans"], lambda s: near(s, t)))))

    return F.when(F.size(spans) == 0, tokens).otherwise(_in_blocks(plain, free))


def _near(side: Column, part: Column, words: int) -> Column:
    """The `part` of what stands beside a match, if it holds so many words and the cut word is another; else all."""
    return F.when((F.length(side) > CONTEXT_CHARS) & (F.size(_words(part)) <= words), side).otherwise(part)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def _found(text: Column, pattern: str, hint: str) -> Column:
    """array<struct<start, stop, value, left, right>> of all matches, left to right, in code points."""

    def rows(z: Column) -> Column:
        hits, parts = z["hits"], z["parts"]
        sizes = F.zip_with(F.slice(parts, 1, F.size(hits)), hits, lambda p, h: F.struct(F.length(p).alias("gap"), F.length(h).alias("own")))
        zipped = F.arrays_zip(_starts(sizes).alias("start"), hits.alias("value"), F.slice(parts, 1, F.size(hits)).alias("left"), F.slice(parts, 2, F.size(hits)).alias("right"))
        return F.transform(
            zipped,
            lambda z: F.struct(
                z["start"].alias("start"),
                (z["start"] + F.length(z["value"])).alias("stop"),
                z["value"].alias("value"),
                _near(z["left"], F.substring(z["left"], -CONTEXT_CHARS, CONTEXT_CHARS), 2).alias("left"),
                _near(z["right"], F.substring(z["right"], 1, CONTEXT_CHARS), 1).alias("right"),
            ),
        )

    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"), F.split(text, pattern, -1).alias("parts"))
    none = F.array().cast(_SPANS)
    found = _once(both, lambda z: F.when(F.size(z["hits"]) > 0, rows(z)).otherwise(none))
    return F.when(text.rlike(hint), found).otherwise(none)


_SPANS = "array<struct<start: int, stop: int, value: string, left: string, right: string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    digits = _digits(value)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    reverse = F.filter(F.split(F.reverse(digits), ""), lambda d: d != "")
    doubled = F.transform(reverse, lambda d, i: d.cast("int") * F.when(i % 2 == 1, 2).otherwise(1))
    total = F.aggregate(doubled, F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).otherwise(d))
    return F.when(F.length(digits).between(16, 19), total % 10 == 0).otherwise(False)


def _contexts(span: Column) -> Column:
    """The lexical patterns around a span: the word before, the two before, the words before and after."""
    before, after = _words(F.lower(span["left"])), _words(F.lower(span["right"]))
    one = F.when(F.size(before) > 0, F.concat(F.lit("1 "), F.element_at(before, -1)))
    two = F.when(F.size(before) > 1, F.concat(F.lit("2 "), F.array_join(F.slice(before, -2, 2), " ")))
    both = F.when((F.size(before) > 0) & (F.size(after) > 0), F.concat(F.lit("b "), F.element_at(before, -1), F.lit(" "), F.get(after, 0)))
    return F.array_compact(F.array(one, two, both))


def base_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, key, base, rest): checked matches by kind and start, and candidates that touch none.

    Addresses and groups of digits are candidates only in a kind's shape; what of a group has no shape by itself
    is no token.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64("text").alias("key"), text.alias("text"))
    rows = rows.select("doc_id", "key", *[_found(F.col("text"), PATTERNS[k], HINTS[k]).alias(k) for k in KINDS],
                       *[_found(F.col("text"), p, CANDIDATE_HINTS[c]).alias(c) for c, p in CANDIDATES.items()])

    def checked(kind):
        good = F.filter(kind, lambda s: _valid(kind, s["value"]))
        return F.transform(good, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), F.lower(s["value"]).alias("value"), _contexts(s).alias("contexts")))

    rows = rows.select("doc_id", "key", F.concat(*[checked(k) for k in KINDS]).alias("base"), *CANDIDATES)

    def trimmed(t):
        head = F.length(t["value"]) - F.length(F.regexp_replace(t["value"], "^[^A-Za-z0-9(]+", ""))
        value = F.regexp_replace(F.regexp_replace(t["value"], "^[^A-Za-z0-9(]+", ""), "[^A-Za-z0-9]+$", "")
        return F.struct((t["start"] + head).alias("start"), (t["start"] + head + F.length(value)).alias("stop"), F.lower(value).alias("value"), _contexts(t).alias("contexts"))

    def free(candidates: str) -> Column:
        return F.filter(F.transform(_untouched(F.col(candidates), F.col("base")), trimmed), lambda t: t["value"] != "")

    def shaped(spans: Column, *kinds: str) -> Column:
        return F.filter(spans, lambda t: _has_shape(t["value"], kinds))

    rows = rows.select("doc_id", "key", "base", free("tokens").alias("tokens"), shaped(free("addresses"), "email").alias("addresses"),
                       shaped(free("groups"), "card", "phone").alias("groups"))
    bare = F.filter("tokens", lambda t: ~_has_shape(t["value"], KINDS))
    tokens = F.when(F.size("groups") == 0, F.col("tokens")).otherwise(
        F.concat(shaped(F.col("tokens"), *KINDS), _untouched(bare, F.col("groups")))
    )
    return rows.select("doc_id", "key", "base", F.concat(tokens, "addresses", "groups").alias("rest"))


def patterns(spans: DataFrame) -> DataFrame:
    """(context, kind, confidence): contexts that tell a kind, from a graph of contexts and instances.

    Base matches are seeds with confidence 1, other tokens begin at 0.  A context's confidence is the sum over its
    distinct instances divided by their number (and PRIOR); it needs SUPPORT seeds of the kind.  An instance of
    the right shape then gets the noisy-or of its contexts, and so on for ROUNDS rounds.  Only sums by context or by
    instance are taken, so frequent words are no burden.
    """
    seeds = spans.select(F.explode("base").alias("s")).select("s.kind", "s.value", F.explode("s.contexts").alias("context")).distinct()
    seeds = common.stored(seeds, "seeds")
    others = common.stored(spans.select(F.explode("rest").alias("s")).select("s.value", F.explode("s.contexts").alias("context")).distinct(), "tokens")
    helped = seeds.groupBy("context", "kind").agg(F.count("*").alias("seeds")).filter(F.col("seeds") >= SUPPORT)
    helped = common.stored(helped, "contexts")
    # tokens in a context of some seed, with the kinds their shape allows
    edges = others.join(helped, "context").select("context", "kind", "value", "seeds")
    all_of = others.groupBy("context").agg(F.count("*").alias("others"))
    any_seed = seeds.groupBy("context").agg(F.count("*").alias("all_seeds"))
    sizes = helped.join(any_seed, "context").join(all_of, "context", "left")
    sizes = common.stored(sizes.select("context", "kind", "seeds", (F.col("all_seeds") + F.coalesce("others", F.lit(0))).alias("n")), "context-sizes")
    edges = common.stored(edges.filter(_shaped()).select("context", "kind", "value"), "token-contexts")
    scored = sizes.select("context", "kind", (F.col("seeds") / (F.col("n") + PRIOR)).alias("confidence"))
    for _ in range(ROUNDS):
        doubt = edges.join(scored, ["context", "kind"]).groupBy("value", "kind").agg(
            (1 - F.exp(F.sum(F.log1p(-F.least("confidence", F.lit(0.99)))))).alias("score")
        )
        gained = edges.join(doubt, ["value", "kind"]).groupBy("context", "kind").agg(F.sum("score").alias("gained"))
        scored = sizes.join(gained, ["context", "kind"], "left").select(
            "context", "kind", ((F.col("seeds") + F.coalesce("gained", F.lit(0.0))) / (F.col("n") + PRIOR)).alias("confidence")
        )
        scored = common.stored(scored, "confidence")
    return scored.filter(F.col("confidence") >= CONFIDENT)


def _has_shape(value: Column, kinds) -> Column:
    return value.rlike("^(?:" + "|".join(SHAPES[k] for k in kinds) + ")$")


def _shaped() -> Column:
    shape = F.lit(False)
    for kind in KINDS:
        shape = shape | ((F.col("kind") == kind) & F.col("value").rlike(f"^(?:{SHAPES[kind]})$"))
    return shape


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found) for each row of `docs`.

    The counts and base_sha256 are of the base matches: leftmost, non-overlapping per kind, checked (parts of an
    ip at most 255, Luhn, number of digits), failing ones dropped.  spans lists base and discovered spans as
    kind:start:end by kind and start.  Discovered are words with a digit, words with @, (at) or [at], and groups of digits
    apart by spaces, of a kind's shape and touching no base match, in a context of confidence CONFIDENT or more; of
    those within another the longer stays.  NULL and empty texts have none; repeated rows get the same;
    other columns are ignored.  A context reaches back to the candidate before, and on to the next.
    """
    spans = common.stored(base_spans(docs), "base-spans")
    good = patterns(spans)
    rest = spans.filter(F.size("rest") > 0).select("doc_id", "key", F.explode("rest").alias("t"))
    rest = rest.select("doc_id", "key", "t.start", "t.stop", "t.value", F.explode("t.contexts").alias("context"))
    found = rest.join(good, "context").filter(_shaped())
    found = found.groupBy("doc_id", "key", "start", "stop").agg(F.max(F.struct("confidence", "kind"))["kind"].alias("kind"))
    wider = Window.partitionBy("doc_id", "key").orderBy("start", F.desc("stop")).rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("reached", F.max("stop").over(wider)).filter("reached IS NULL OR reached < stop")
    found = found.groupBy("doc_id", "key").agg(F.collect_set(F.struct("kind", "start", "stop")).alias("found"))
    found = common.stored(found, "found-spans")
    both = spans.join(found, common.same(spans, found, "doc_id", "key"), "left").select(spans["doc_id"], "base", "found")
    text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])
    order = lambda s: F.struct(F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("o"), s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))
    plain = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    extra = F.coalesce("found", F.array().cast("array<struct<kind: string, start: int, stop: int>>"))
    listed = F.array_sort(F.transform(F.concat(plain, extra), order))
    return both.select(
        "doc_id",
        *[_count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(F.transform("base", text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(listed, text), ",").alias("spans"),
        F.size(extra).cast("long").alias("n_found"),
    )


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def op7_pii(spark, sf_dir):
    return personal_data(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
