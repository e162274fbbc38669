"""Byte-level BPE: encoding by replaying all merges over a block's distinct words, and decoding."""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwarden.llm import common

# Bytes of the texts that are encoded together.
BLOCK_BYTES = 10_000_000
# Distinct words a task remembers.
MEMORY_WORDS = 600_000
# Pairs whose merges are looked up at a time, some 40 bytes each.
PAIRS = 200_000
# Fixed value: a pattern that cuts before every single space.
SPACED = frozenset({r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"})
SIGNS = frozenset(".,;:!?")
# A space before any white space or at the end.
_UNEVEN = r" (?:[\s\x0b\x{85}\p{Z}]|$)"
NO_RANK = np.iinfo(np.int32).max


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file (base64 token, rank)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class MergeReplay:
    """Applies the merges of a vocabulary to many words at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.base = max(ranks.values()) + 1
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        keys, results = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.base + right)
                    results.append(rank)
        order = np.argsort(keys)
        self.keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.results = np.append(np.array(results, np.int32)[order], NO_RANK)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge, NO_RANK where there is none."""
        key = left.astype(np.int64) * self.base + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.results[at], NO_RANK)

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word, as merging its lowest-ranked, leftmost pair again and again gives them."""
        flat, sizes = self.encode_flat(words)
        ends = np.cumsum(sizes)
        return [flat[a:b].tolist() for a, b in zip(ends - sizes, ends)]

    def encode_flat(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after the other, and how many each has."""
        whole = np.array([self.ranks.get(w, -1) for w in words], np.int32)
        rest = np.flatnonzero(whole < 0)
        sizes = np.ones(len(words), np.int64)
        merged, sizes[rest] = self._replay([words[i] for i in rest]) if len(rest) else (whole[:0], 0)
        starts = np.cumsum(sizes) - sizes
        flat = np.empty(int(sizes.sum()), np.int32)
        flat[starts[whole >= 0]] = whole[whole >= 0]
        flat[_runs(starts[rest], sizes[rest])] = merged
        return flat, sizes

    def _replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(lengths)
        tokens = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        size = len(tokens)
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        after, before = np.arange(1, size + 1, dtype=np.int32), np.arange(-1, size - 1, dtype=np.int32)
        after[ends[lengths > 0] - 1] = -1
        before[(ends - lengths)[lengths > 0]] = -1

        index: dict[int, list[np.ndarray]] = {}
        waiting: list[int] = []

        def enter(places: np.ndarray, ranks: np.ndarray) -> None:
            """Put the left places of pairs under the rank of their merge."""
            some = ranks != NO_RANK
            places, ranks = places[some], ranks[some]
            if not len(places):
                return
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            heads = ranks[np.concatenate([[0], cuts])].tolist()
            for rank, part in zip(heads, np.split(places, cuts) if len(cuts) else [places]):
                if rank in index:
                    index[rank].append(part)
                else:
                    index[rank] = [part]
                    heapq.heappush(waiting, rank)

        start = np.flatnonzero(after >= 0).astype(np.int32)
        parts = np.array_split(start, 1 + len(start) // PAIRS)
        enter(start, np.concatenate([self.merged(tokens[p], tokens[p + 1]) for p in parts]))
        while waiting:
            rank = heapq.heappop(waiting)
            parts = index.pop(rank)
            at = parts[0] if len(parts) == 1 else np.concatenate(parts)
            at = at[(tokens[at] >= 0) & (after[at] >= 0)]
            at = at[self.merged(tokens[at], tokens[after[at]]) == rank]
            if len(at) > 1:
                at = np.unique(at)
                at, later = self._together(rank, at, tokens, after, before, word)
                if len(later):
                    index[rank] = [later]
                    heapq.heappush(waiting, rank)
            if not len(at):
                continue
            gone = after[at]
            follow = after[gone]
            tokens[at] = rank
            tokens[gone] = -1
            after[at] = follow
            linked = follow >= 0
            before[follow[linked]] = at[linked]
            left = before[at]
            left = left[left >= 0]
            places = np.concatenate([left, at[linked]])
            if len(places):
                places = np.unique(places)
                enter(places, self.merged(tokens[places], tokens[after[places]]))
        kept = tokens >= 0
        return tokens[kept], np.bincount(word[kept], minlength=len(words))

    def _together(self, rank, at, tokens, after, before, word):
        """The places merged now, and those to look at again.

        Of overlapping pairs the leftmost counts.  A word with several places merges them all at once
        only if no merge of a lower rank can arise between them; else just its first.
        """
        touching = np.concatenate([[False], after[at[:-1]] == at[1:]])
        heads = np.maximum.accumulate(np.where(touching, 0, np.arange(len(at))))
        chosen = (np.arange(len(at)) - heads) % 2 == 0
        now, skipped = at[chosen], at[~chosen]
        first = np.concatenate([[True], word[now[1:]] != word[now[:-1]]])
        if first.all():
            return now, skipped
        risky = np.zeros(len(now), bool)
        if self.merged(np.array([rank]), np.array([rank]))[0] < rank:
            risky[:] = True
        left, right = before[now], after[after[now]]
        some = left >= 0
        risky[some] |= self.merged(tokens[left[some]], np.int32(rank)) < rank
        some = right >= 0
        risky[some] |= self.merged(np.full(int(some.sum()), rank, np.int32), tokens[right[some]]) < rank
        if not risky.any():
            return now, skipped
        hold = np.isin(word[now], word[now[risky]]) & ~first
        return now[~hold], np.concatenate([skipped, now[hold]])


class Words:
    """Ids of a block's texts; each distinct piece of them is replayed once.

    A pattern that takes at most one space before a piece and never ends a piece with a space that something else
    follows cuts before every single space anyway, so texts are cut there first, and only distinct words are searched
    by the pattern.  Texts with other white space after a space, and all texts under another pattern, are searched whole.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern, self.replay = regex.compile(pattern), MergeReplay(ranks)
        self.spaced = pattern in SPACED
        self.forget()

    def forget(self):
        self.words, self.pieces = _Numbered(), _Numbered()
        self.of_word, self.of_piece = Lists(), Lists()

    def numbers(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the words of all texts, one text after the other, and how many each has."""
        size = pc.binary_length(texts).to_numpy()
        whole = (size > 0) & (pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False) if self.spaced else True)
        plain = np.flatnonzero((size > 0) & ~whole)
        counts = whole.astype(np.int64)
        found = np.zeros(0, np.int64)
        if len(plain):
            lists = pc.split_pattern(texts.take(pa.array(plain)), " ")
            starts, flat = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py(), lists.flatten()
            coded = flat.dictionary_encode()
            known = np.fromiter(map(self.words.__getitem__, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
            found = known[coded.indices.to_numpy()]
            found[starts] = [self.words[first,] for first in flat.take(pa.array(starts)).to_pylist()]
            counts[plain] = np.diff(np.append(starts, len(found)))
        ends = np.cumsum(counts)
        numbers = np.empty(int(counts.sum()), np.int64)
        numbers[_runs((ends - counts)[plain], counts[plain])] = found
        rest = np.flatnonzero(whole)
        numbers[(ends - counts)[rest]] = [self.words[t,] for t in texts.take(pa.array(rest)).to_pylist()]
        return numbers, counts

    def learn(self) -> None:
        """Replay the pieces met since."""
        numbers, counts = [], []
        for word in itertools.islice(self.words, len(self.of_word.sizes), None):
            if type(word) is tuple:
                found = self.pattern.findall(word[0])
            elif word.isalpha():
                numbers.append(self.pieces[" " + word])
                counts.append(1)
                continue
            elif word.isascii() and word[-1:] in SIGNS and word[:-1].isalpha():
                found = (" " + word[:-1], word[-1])
            else:
                found = self.pattern.findall(" " + word)
            numbers += [self.pieces[p] for p in found]
            counts.append(len(found))
        fresh = itertools.islice(self.pieces, len(self.of_piece.sizes), None)
        self.of_piece.extend(*self.replay.encode_flat([p.encode("utf-8", "surrogatepass") for p in fresh]))
        ids, sizes = self.of_piece.take(np.array(numbers, np.int64))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        last = np.cumsum(np.array(counts, np.int64))
        self.of_word.extend(ids, ends[last] - ends[last - np.array(counts, np.int64)])


class _Numbered(dict):
    """Numbers what it is asked for, in order."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


class Lists:
    """Lists of ids, one after the other."""

    def __init__(self):
        self.flat, self.sizes, self.starts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def extend(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        self.flat, self.sizes = np.concatenate([self.flat, flat]), np.concatenate([self.sizes, sizes])
        self.starts = np.cumsum(self.sizes) - self.sizes

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists at `at`, joined, and their sizes."""
        return self.flat[_runs(self.starts[at], self.sizes[at])], self.sizes[at]


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """`docs` with the token ids (array<int>) of each whole text, as column `out` (replaced if there).

    Each match of `pattern` is encoded by itself.  A task collects the distinct matches in a block of
    documents, keeps an inverted index from the mergeable pairs to their places in those, and goes
    through the merges in rank order, touching only neighbours of what it merged.  NULL and empty texts
    have no ids; repeated rows each have theirs; an empty table gives an empty one.  A vocabulary is at most some
    hundred thousand entries and goes with the task.
    """
    kept = [c for c in docs.columns if c != out]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != out)
    return docs.select(*kept).mapInArrow(encoder(ranks, pattern, text, out), f"{schema}, `{out}` array<int>")


def encoder(ranks: dict[bytes, int], pattern: str, text: str, out: str):
    """What `encode` does to the batches of a task."""

    def run(batches):
        words = Words(ranks, pattern)

        def coded(block):
            rows = pa.Table.from_batches(block).combine_chunks()
            block.clear()
            numbers, counts = words.numbers(pc.fill_null(rows.column(text), "").combine_chunks())
            words.learn()
            ends = np.concatenate([[0], np.cumsum(counts)])
            first = 0
            # ids are several times larger than their words' numbers, so only a batch of them is held
            for batch in rows.to_batches(common.BATCH_ROWS):
                cuts = ends[first : first + len(batch) + 1]
                first += len(batch)
                ids, sizes = words.of_word.take(numbers[cuts[0] : cuts[-1]])
                offsets = np.concatenate([[0], np.cumsum(sizes)])[cuts - cuts[0]]
                lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(ids, pa.int32()))
                made = lists.cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, out])

        block, size = [], 0
        for batch in batches:
            block.append(batch)
            size += batch.column(text).nbytes
            if size >= BLOCK_BYTES:
                yield from coded(block)
                size = 0
                if len(words.words) > MEMORY_WORDS:
                    words.forget()
                pa.default_memory_pool().release_unused()
        if block:
            yield from coded(block)
        # the worker lives on, and its next task may be another's
        pa.default_memory_pool().release_unused()

    return run


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of runs of these sizes, one after the other."""
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return shift + np.arange(len(shift))


def decode(docs: DataFrame, ranks: dict[bytes, int], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """`docs` with the bytes (binary) that the ids stand for, as column `out`; NULL ids give no bytes.

    Ids outside the vocabulary raise an error.
    """
    kept = [c for c in docs.columns if c != out]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != out)
    return docs.select(*kept).mapInArrow(decoder(ranks, ids, out), f"{schema}, `{out}` binary")


def decoder(ranks: dict[bytes, int], ids: str, out: str):
    """What `decode` does to the batches of a task."""

    def run(batches):
        token = {rank: piece for piece, rank in ranks.items()}
        for batch in batches:
            lists = batch.column(ids)
            offsets = (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist()
            pieces = list(map(token.__getitem__, lists.flatten().to_numpy().tolist()))
            texts = [b"".join(pieces[a:b]) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, out])

    return run


def digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row of documents, encoded and decoded in one pass.

    NULL and empty texts have no ids, and the digests of nothing; repeated rows have a row each; an empty table
    gives no rows.  Other columns are not read, whatever their names.
    """
    import public_tokenizers

    ranks = read_ranks(path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    there = encoder(ranks, pattern or public_tokenizers.PATTERN, "text", "ids")
    back = decoder(ranks, "ids", "decoded")

    def run(batches):
        written = {rank: b"%d" % rank for rank in ranks.values()}
        for batch in back(there(batches)):
            lists = batch.column("ids")
            offsets = (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist()
            numbers = list(map(written.__getitem__, lists.flatten().to_numpy().tolist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets), pa.int64()),
                 pa.array([hashlib.sha256(b" ".join(numbers[a:b])).hexdigest() for a, b in zip(offsets, offsets[1:])], pa.string()),
                 pa.array([hashlib.sha256(t).hexdigest() for t in batch.column("decoded").to_pylist()], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_bpe(spark, sf_dir):
    return digests(common.table(spark, sf_dir, "documents"))
