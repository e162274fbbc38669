"""Language-model scores from a probabilistic suffix tree learnt from the corpus.

The tree's nodes are contexts of up to two words.  A node is kept if its next-symbol distribution diverges
from its parent's by enough for what it costs; next-symbol probabilities are smoothed with the parent's; a
position is scored by the longest kept suffix of what stands before it.

The model grows with the corpus, so it is neither gathered nor broadcast.  Documents lie in chunks of a
bounded number of tokens.  A chunk sends its distinct keys with its own sums; each key's total over the corpus comes
back in the order asked.  Counting and looking up are thus one exchange, in which a key occurs at most once per chunk, however frequent it is.

Words are asked for by 52 bits of their hashes.  With the totals come numbers for what later keys are made of: the corpus's
symbols and contexts are numbered without gaps in the order of their keys, so a chunk's numbers travel as small steps, a context is
a small number, and a pair or triple is the number of its context and that of its symbol.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwarden.llm import common

CHUNK_TOKENS = 2_000_000
# Tokens of the corpus for each part of the key space.
PART_TOKENS = 1 << 22
# Bits of a hash that tell words apart, those of the part included.
KEY_BITS = 52
# Occurrences in training of a context that may become a node, whatever the size of the corpus, and of a
# symbol kept after it.
LEAST_CONTEXT, LEAST_SYMBOL = 12, 2
# Gain in nats for each kept symbol, below which a node is not kept; share of a count given to the parent.
COST, DISCOUNT = 2.0, 0.75
END = xxhash.xxh64_intdigest(b"")
WORDS, PAIRS, NODES1, TRIPLES, NODES2 = range(5)
# How a chunk's sums of each kind travel, and their totals: words count exactly, the rest to seven digits.
OWN = (np.uint32, np.uint32, np.float32, np.uint32, np.float32)
KIND = (np.float64, np.float32, np.float32, np.float32, np.float32)


def _numbered_from(kind: int) -> tuple[int, ...]:
    """Totals from which keys of a kind are numbered: words as symbols and as contexts, pairs as contexts."""
    return {WORDS: (LEAST_SYMBOL, LEAST_CONTEXT), PAIRS: (LEAST_CONTEXT,)}.get(kind, ())


def _pack(x: np.ndarray) -> bytes:
    """Bytes of one place after the other, compressed."""
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes(), codec="zstd", asbytes=True)


def _unpack(raw: bytes, n: int, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    flat = np.frombuffer(pa.decompress(raw, n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(size, n).T).reshape(-1).view(kind)


# ---- chunks ------------------------------------------------------------------------------------


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 2_000_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def chunks(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, held_out, text) as chunks of token codes.

    words: distinct hashes, the most frequent first; codes: places in it, an end after each document.
    """
    schema = "chunk long, n long, m long, ids binary, named binary, held binary, sizes binary, words binary, codes binary"

    def run(batches):
        hashes, done, open_docs, tokens = _Hashes(), 0, [], 0

        def finish():
            ids, held, parts = zip(*open_docs)
            flat = np.concatenate(parts)
            words, codes, often = np.unique(flat, return_inverse=True, return_counts=True)
            order = np.argsort(-often, kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            row = {
                "chunk": TaskContext.get().partitionId() << 32 | done, "n": len(ids), "m": len(words),
                "ids": np.array([i or 0 for i in ids], np.int64).tobytes(),
                "named": np.array([i is not None for i in ids]).tobytes(), "held": np.array(held, bool).tobytes(),
                "sizes": np.array([len(p) for p in parts], np.int64).tobytes(),
                "words": words[order].tobytes(), "codes": _pack(rank[codes]),
            }
            return pa.RecordBatch.from_pylist([row], pa.schema([(k, pa.int64() if isinstance(v, int) else pa.binary()) for k, v in row.items()]))

        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for doc, held, text in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), texts):
                words = (text or b"").lower().split()
                own = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
                open_docs.append((doc, held, np.append(own, np.uint64(END))))
                tokens += len(own) + 1
                if tokens >= CHUNK_TOKENS:
                    yield finish()
                    done, open_docs, tokens = done + 1, [], 0
        if open_docs:
            yield finish()

    return docs.mapInArrow(run, schema)


class Chunk:
    """One chunk with the totals that have come back so far."""

    def __init__(
        self, row: dict, answers: dict[int, dict[int, bytes]], parts: int, n: float, v: float, numbers: dict | None = None, symbols: int | None = None
    ):
        """numbers: steps between the numbers that have come back; without any, the chunk is all there is.  symbols: how many a part has at most."""
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.named = np.frombuffer(row["named"], bool)
        self.held_docs = np.frombuffer(row["held"], bool)
        self.words = np.frombuffer(row["words"], np.uint64)
        self.codes = _unpack(row["codes"], int(self.sizes.sum()), np.uint32)
        self.answers, self.parts, self.n, self.v = answers, parts, n, v
        self.numbers, self.symbols = numbers or {}, symbols or len(self.words)
        # a key has its part in its first bits
        self.rest = np.uint64(63 - (parts - 1).bit_length())
        self.low = (np.uint64(1) << self.rest) - np.uint64(1)
        self.train = ~np.repeat(self.held_docs, self.sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def ask(self, kind: int, keys: np.ndarray, sums: list[np.ndarray]):
        """Requests of sorted keys, a row for each part of the key space."""
        cuts, own = self._cuts(keys), keys & self.low
        for part, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if b > a:
                # keys travel as steps from key to key
                steps = np.diff(own[a:b], prepend=np.uint64(0))
                yield kind, part, b - a, _pack(steps), [_pack(s[a:b].astype(OWN[kind])) for s in sums]

    def _cuts(self, keys):
        return np.searchsorted(keys, np.arange(self.parts + 1, dtype=np.uint64) << self.rest)

    def totals(self, kind: int, keys: np.ndarray) -> np.ndarray:
        out, cuts = np.zeros(len(keys)), self._cuts(keys)
        for part, raw in self.answers.get(kind, {}).items():
            a, b = cuts[part], cuts[part + 1]
            out[a:b] = _unpack(raw, b - a, KIND[kind])
        return out

    def numbered(self, kind: int, keys: np.ndarray, totals: np.ndarray) -> list[np.ndarray]:
        """For each least total of the kind: keys that have it get their part and their number in it, others 0."""
        cuts, told = self._cuts(keys), self.numbers.get(kind, {})
        out = []
        for i, least in enumerate(_numbered_from(kind)):
            places = np.zeros(len(keys), np.uint64)
            for part in range(self.parts):
                own = np.flatnonzero(totals[cuts[part] : cuts[part + 1]] >= least) + cuts[part]
                if len(own):
                    steps = _unpack(told[part][i], len(own), np.uint32) if told else np.ones(len(own), np.uint32)
                    places[own] = (np.uint64(part) << self.rest) + np.cumsum(steps, dtype=np.uint64) - np.uint64(1)
            out.append(places)
        return out

    def _word_keys(self):
        """Sorted keys of the chunk's words, and the words' places."""
        part, bits = self.words & np.uint64(self.parts - 1), np.uint64(64 - KEY_BITS + (self.parts - 1).bit_length())
        keys = part << self.rest | self.words >> bits
        order = np.argsort(keys, kind="stable")
        return keys[order], order

    def _grams(self, contexts: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Keys of symbols after contexts.  The parts of both are added up, so that neither gathers in one; the symbol's is the difference."""
        context, symbol = contexts & self.low, self.symbol[codes]
        parts, symbols, part = np.uint64(self.parts), np.uint64(self.symbols), contexts >> self.rest
        if len(context) and (int(context.max()) + 1) * self.parts * self.symbols > 1 << int(self.rest):
            raise OverflowError("the corpus has too many contexts and symbols for keys of 63 bits")
        where = part + (symbol >> self.rest) & parts - np.uint64(1)
        return where << self.rest | (context * parts + part) * symbols + (symbol & self.low)

    # each step gives what it asks, and keeps what later steps need

    def ask_words(self):
        often = np.bincount(self.codes[self.train], minlength=len(self.words))
        keys, order = self._word_keys()
        yield from self.ask(WORDS, keys, [often[order]])

    def know_words(self):
        keys, order = self._word_keys()
        totals = self.totals(WORDS, keys)
        self.count = np.zeros(len(order))
        self.count[order] = totals
        self.symbol, context = np.zeros((2, len(order)), np.uint64)
        self.symbol[order], context[order] = self.numbered(WORDS, keys, totals)
        self.p0 = (self.count + 1) / (self.n + self.v + 1)
        c = self.count[self.codes]
        at = np.arange(len(self.codes))
        inner = np.ones(len(at), bool)
        inner[self.starts] = False
        inner[1:] &= c[:-1] >= LEAST_CONTEXT
        self.at1 = np.flatnonzero(inner)
        self.context1 = context[self.codes[self.at1 - 1]]
        self.seen1 = c[self.at1] >= LEAST_SYMBOL
        self.gram1 = self._grams(self.context1[self.seen1], self.codes[self.at1[self.seen1]])
        self.total1 = np.zeros(len(self.at1))
        self.context_count1 = c[self.at1 - 1]

    def _ask_grams(self, kind, grams, at):
        keys, place = np.unique(grams, return_inverse=True)
        yield from self.ask(kind, keys, [np.bincount(place, self.train[at], len(keys))])

    def ask_pairs(self):
        yield from self._ask_grams(PAIRS, self.gram1, self.at1[self.seen1])

    def know_pairs(self):
        keys, place = np.unique(self.gram1, return_inverse=True)
        totals = self.totals(PAIRS, keys)
        self.total1[self.seen1] = totals[place]
        total = np.zeros(len(self.codes))
        total[self.at1] = self.total1
        context = np.zeros(len(self.codes), np.uint64)
        context[self.at1[self.seen1]] = self.numbered(PAIRS, keys, totals)[0][place]
        at = self.at1[self.at1 > 0]
        self.at2 = at[total[at - 1] >= LEAST_CONTEXT]
        self.context2 = context[self.at2 - 1]
        self.context_count2 = total[self.at2 - 1]
        self.seen2 = total[self.at2] >= LEAST_SYMBOL
        self.gram2 = self._grams(self.context2[self.seen2], self.codes[self.at2[self.seen2]])
        self.total2 = np.zeros(len(self.at2))

    def _ask_nodes(self, kind, contexts, counts, totals, parent, at):
        keys, place = np.unique(contexts, return_inverse=True)
        kept = (totals >= LEAST_SYMBOL) & self.train[at]
        t = totals[kept]
        gain = np.log((t - DISCOUNT) / counts[kept] / parent[kept]) - COST / t
        sums = [np.bincount(place[kept], w, len(keys)) for w in (gain, 1 - DISCOUNT / t)]
        yield from self.ask(kind, keys, sums)

    def _node_probability(self, kind, contexts, counts, totals, parent):
        """Smoothed by the parent at kept nodes, the parent's elsewhere."""
        keys, place = np.unique(contexts, return_inverse=True)
        mass = self.totals(kind, keys)[place]
        keep = mass > 0
        own = np.where(totals >= LEAST_SYMBOL, totals - DISCOUNT, 0)
        back = np.maximum(1 - mass / counts, 1e-6)
        return np.where(keep, own / counts + back * parent, parent), keep

    def ask_nodes1(self):
        parent = self.p0[self.codes[self.at1]]
        yield from self._ask_nodes(NODES1, self.context1, self.context_count1, self.total1, parent, self.at1)

    def ask_triples(self):
        yield from self._ask_grams(TRIPLES, self.gram2, self.at2[self.seen2])

    def know_nodes1(self):
        self.p = self.p0[self.codes]
        self.depth = np.zeros(len(self.codes), np.int8)
        self.p[self.at1], kept = self._node_probability(
            NODES1, self.context1, self.context_count1, self.total1, self.p[self.at1]
        )
        self.depth[self.at1[kept]] = 1
        keys, place = np.unique(self.gram2, return_inverse=True)
        self.total2[self.seen2] = self.totals(TRIPLES, keys)[place]

    def ask_nodes2(self):
        yield from self._ask_nodes(NODES2, self.context2, self.context_count2, self.total2, self.p[self.at2], self.at2)

    def scores(self) -> pd.DataFrame:
        self.p[self.at2], kept = self._node_probability(
            NODES2, self.context2, self.context_count2, self.total2, self.p[self.at2]
        )
        self.depth[self.at2[kept]] = 2
        count = self.count[self.codes]
        add = lambda x: np.add.reduceat(x, self.starts)
        return pd.DataFrame(
            {
                "doc_id": pd.array(np.where(self.named, self.ids, 0), "Int64").copy(),
                "held_out": self.held_docs,
                "n_tokens": self.sizes,
                "n_known": add((count > 0).astype(np.int64)),
                "train_tokens": int(self.n),
                "base_score": add(np.log10(self.p0[self.codes])),
                "score": add(np.log10(self.p)),
                "n_in_context": add((self.depth > 0).astype(np.int64)),
                "n_in_long_context": add((self.depth > 1).astype(np.int64)),
            }
        ).assign(doc_id=lambda d: d["doc_id"].where(self.named))


# ---- exchange ----------------------------------------------------------------------------------

_ASKED = "chunk long, kind int, part int, n long, keys binary, sums array<binary>"


def _requests(row_chunk: int, asked) -> pd.DataFrame:
    rows = [(row_chunk, *a) for a in asked]
    return pd.DataFrame(rows, columns=["chunk", "kind", "part", "n", "keys", "sums"])


def _totals(asked: DataFrame) -> DataFrame:
    """(chunk, kind, part, answer, numbers, sum, seen, symbols): what each key's sums over all chunks say, in the order asked.

    numbers: for each least total of the kind, steps between the numbers of the keys that have it.
    """

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        kind = int(rows["kind"].iat[0])
        n = rows["n"].to_numpy(np.int64)
        asked = np.concatenate([np.cumsum(_unpack(raw, k, np.uint64), dtype=np.uint64) for raw, k in zip(rows["keys"], n)])
        keys, place = np.unique(asked, return_inverse=True)
        columns = len(rows["sums"].iat[0])
        totals = [
            np.bincount(place, np.concatenate([_unpack(s[c], k, OWN[kind]) for s, k in zip(rows["sums"], n)]), len(keys))
            for c in range(columns)
        ]
        ends = np.cumsum(n)
        # of a context: the discounted mass of its kept symbols, or 0 if its gain is below its cost
        told = (np.where(totals[0] >= 0, totals[1], 0) if columns == 2 else totals[0]).astype(KIND[kind])
        counts = [told >= least for least in _numbered_from(kind)]
        number = [np.cumsum(c) - 1 for c in counts]
        answers, numbers = [], []
        for a, b in zip(ends - n, ends):
            own = place[a:b]
            answers.append(_pack(told[own]))
            numbers.append([_pack(np.diff(i[own[c[own]]], prepend=-1).astype(np.uint32)) for c, i in zip(counts, number)])
        first = np.arange(len(rows)) == 0
        return pd.DataFrame(
            {
                "chunk": rows["chunk"], "kind": rows["kind"], "part": rows["part"], "answer": answers, "numbers": numbers,
                "sum": np.where(first, totals[0].sum(), 0.0), "seen": np.where(first, (totals[0] > 0).sum(), 0),
                "symbols": np.where(first, (totals[0] >= LEAST_SYMBOL).sum(), 0),
            }
        )

    return asked.groupBy("kind", "part").applyInPandas(
        add, "chunk long, kind int, part int, answer binary, numbers array<binary>, sum double, seen long, symbols long"
    )


def score(docs: DataFrame, train: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, ...) of each row of `docs`.

    Learns from rows where the SQL condition `train` holds; the others, also where it is NULL, are held out.  Tokens are words between
    ASCII white space, A-Z lowered, and an end.  base_score is the add-one unigram log10 probability, score
    the tree's.  NULL and blank texts are an end alone.  Other columns are ignored, repeated rows count
    each, an empty table gives no rows.  Without training rows every symbol has probability 1.
    Words are told apart by 52 bits of their hashes, as keys travel without the rest: of n words
    about n**2 / 2**53 pairs collide, and their counts are added.  Counts of pairs and triples come back to seven digits.
    `docs` must read the same each time (a stored table), as lost tasks are run again.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), (~F.coalesce(F.expr(train), F.lit(False))).alias("held_out"), F.col(text).alias("text")
    )
    made = common.placed_by(chunks(rows), "chunk")
    tokens = made.select(F.sum(F.octet_length("sizes") / 8), F.sum("m")).first()
    parts = 1 << max(4, int(np.ceil(np.log2(max(1, (tokens[1] or 0) * 4 / PART_TOKENS)))))
    parts = max(parts, 1 << int(np.ceil(np.log2(common.partitions(spark)))))

    def first(frames):
        for frame in frames:
            for row in frame.to_dict("records"):
                yield _requests(row["chunk"], Chunk(row, {}, parts, 0, 0).ask_words())

    # answers lie where their chunks do, so they move once
    answers = common.placed_by(_totals(made.mapInPandas(first, _ASKED)), "chunk")
    n, v, symbols = answers.agg(F.sum("sum"), F.sum("seen"), F.max("symbols")).first()
    n, v = n or 0, v or 0

    def step(known: list[str], ask: list[str]):
        """Chunks with their answers go through `known`, then ask for more, or are scored."""

        def run(own: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
            row = own.to_dict("records")[0]
            by: dict[int, dict[int, bytes]] = {}
            numbers: dict[int, dict[int, list[bytes]]] = {}
            for kind, part, raw, steps in zip(got["kind"], got["part"], got["answer"], got["numbers"]):
                by.setdefault(int(kind), {})[int(part)] = raw
                numbers.setdefault(int(kind), {})[int(part)] = steps
            chunk = Chunk(row, by, parts, n, v, numbers, symbols)
            with np.errstate(over="ignore"):
                for name in known:
                    getattr(chunk, name)()
                if not ask:
                    return chunk.scores()
                return _requests(row["chunk"], (a for name in ask for a in getattr(chunk, name)()))

        schema = _ASKED if ask else (
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
            "n_in_context long, n_in_long_context long"
        )
        return made.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(run, schema)

    known = ["know_words"]
    for learn, ask in (("know_pairs", ["ask_pairs"]), ("know_nodes1", ["ask_nodes1", "ask_triples"]), (None, ["ask_nodes2"])):
        answers = answers.union(common.placed_by(_totals(step(known, ask)), "chunk"))
        known = known + [learn] if learn else known
    return step(known, [])


def op1_suffix_tree(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    return score(docs, "coalesce(crc32(cast(cast(doc_id as string) as binary)) % 7, 0) <> 2")
