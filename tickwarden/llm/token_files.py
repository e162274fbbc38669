"""Token ids in binary files: canonical length-limited Huffman codes, blocks that are read independently."""

from __future__ import annotations

import bisect
import io
import itertools
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwarden import session
from tickwarden.llm import common

# Bits of the longest code, unless the vocabulary needs more.
LONGEST = 20
# Ids of a block; a document's blocks but the last have as many.
BLOCK = 512
# Bytes of codes after which a writing task begins another file.
FILE_BYTES = 32_000_000
# Ids that a reading task decodes at once (a longer document is decoded by itself).
DECODE_IDS = 2_000_000
# Bytes of the texts that are encoded together, and distinct words a task remembers.
BLOCK_BYTES = 16_000_000
MEMORY_WORDS = 600_000
# Pieces that go to the tokenizer as one text.
TOGETHER = 200
SIGNS = frozenset(".,;:!?")
MAGIC = b"IDHUFF01"
HEAD = "<8sII6Q"
# Fixed value: how the byte-level tokenizer cuts a text into words.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# A space before any white space or at the end.
_UNEVEN = r" (?:[\s\x0b\x{85}\p{Z}]|$)"


# ---- ids ---------------------------------------------------------------------------------------


class _Numbered(dict):
    """Numbers what it is asked for, in order."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


class WordCoder:
    """Ids of whole texts; each distinct piece of the texts is given to the tokenizer once.

    Texts are cut before every single space that stands before something else than white space: there the tokenizer
    cuts too, whatever stands around, so the ids of these words are the ids of the text.  Words of Latin letters,
    digits and signs are cut on into the tokenizer's own pieces, others are left to it whole.  A byte-level tokenizer
    without normalizer is required.
    """

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.uneven = regex.compile(r" (?:\s|$)")
        self.cut = regex.compile(_PIECES)
        self.forget()

    def forget(self):
        self.words, self.pieces = _Numbered(), _Numbered()
        self.of_word, self.of_piece = Lists(), Lists()

    def numbers(self, text: str) -> np.ndarray:
        """Numbers of any text's words.  A word is known by what follows its space, or as (word,) if it has none."""
        if not text:
            return np.zeros(0, np.int64)
        if any(a in text for a in self.added):  # the tokenizer finds these before it cuts
            return np.array([self.words[text,]])
        first, *rest = text.split(" ")
        if self.uneven.search(text):
            joined = [first]
            for part in rest:
                if part and not regex.match(r"\s", part):
                    joined.append(part)
                else:
                    joined[-1] += " " + part
            first, *rest = joined
        numbers = np.empty(len(rest) + 1, np.int64)
        numbers[0] = self.words[first,]
        numbers[1:] = np.fromiter(map(self.words.__getitem__, rest), np.int64, len(rest))
        return numbers

    def number_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of all `texts`, none of them empty or odd, and how many each has."""
        lists = pc.split_pattern(texts, " ")
        starts, flat = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py(), lists.flatten()
        coded = flat.dictionary_encode()
        known = np.fromiter(map(self.words.__getitem__, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        numbers = known[coded.indices.to_numpy()]
        numbers[starts] = [self.words[first,] for first in flat.take(pa.array(starts)).to_pylist()]
        return numbers, np.diff(np.append(starts, len(numbers)))

    def odd(self, texts: pa.Array) -> np.ndarray:
        """Which texts hold a space before white space or the end, or a token that the tokenizer knows by name."""
        found = pc.match_substring_regex(texts, _UNEVEN)
        for token in self.added:
            found = pc.or_(found, pc.match_substring(texts, token))
        return found.to_numpy(zero_copy_only=False)

    def _pieces(self, word) -> list:
        text = word[0] if isinstance(word, tuple) else " " + word
        if max(text, default="") >= "ɐ" or (isinstance(word, tuple) and any(a in text for a in self.added)):
            return [(text,)]
        return self.cut.findall(text)

    def learn(self) -> None:
        """Encode the words met since."""
        numbers, counts = [], []
        for word in itertools.islice(self.words, len(self.of_word.sizes), None):
            if type(word) is str and word.isalpha():
                numbers.append(self.pieces[" " + word])
                counts.append(1)
            elif type(word) is str and word.isascii() and word[-1:] in SIGNS and word[:-1].isalpha():
                numbers += self.pieces[" " + word[:-1]], self.pieces[word[-1]]
                counts.append(2)
            else:
                found = self._pieces(word)
                numbers += [self.pieces[p] for p in found]
                counts.append(len(found))
        fresh = list(itertools.islice(self.pieces, len(self.of_piece.sizes), None))
        self._encode(fresh)
        of = np.array(numbers, np.int64)
        ids, sizes = self.of_piece.take(of)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        last = np.cumsum(np.array(counts, np.int64))
        self.of_word.extend(ids, ends[last] - ends[last - np.array(counts, np.int64)])

    def _encode(self, pieces: list) -> None:
        """The ids of pieces.  Those after a space go to the tokenizer many at a time."""
        spaced = [i for i, p in enumerate(pieces) if type(p) is str and p[0] == " " and p[1:2].strip()]
        alone = set(range(len(pieces))).difference(spaced)
        order, flat, sizes = [], [], []
        for a in range(0, len(spaced), TOGETHER):
            own = spaced[a : a + TOGETHER]
            found = self.tokenizer.encode("".join([pieces[i] for i in own]), add_special_tokens=False)
            many = np.bincount(found.word_ids, minlength=len(own))
            if len(many) == len(own):
                order += own
                flat += found.ids
                sizes.append(many)
            else:
                alone.update(own)
        for i in alone:
            found = self.tokenizer.encode(pieces[i] if type(pieces[i]) is str else pieces[i][0], add_special_tokens=False).ids
            order.append(i)
            flat += found
            sizes.append([len(found)])
        self.of_piece.extend(np.array(flat, np.int32), np.concatenate([np.zeros(0, np.int64), *sizes]), np.array(order, np.int64))


class Lists:
    """Lists of ids, one after the other."""

    def __init__(self):
        self.flat, self.sizes, self.starts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def extend(self, flat: np.ndarray, sizes: np.ndarray, order: np.ndarray | None = None) -> None:
        """Append lists; `order`: which of the new numbers each has."""
        starts = len(self.flat) + np.cumsum(sizes) - sizes
        if order is not None:
            back = np.empty_like(order)
            back[order] = np.arange(len(order))
            sizes, starts = sizes[back], starts[back]
        self.flat = np.concatenate([self.flat, flat])
        self.sizes, self.starts = np.concatenate([self.sizes, sizes]), np.concatenate([self.starts, starts])

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists at `at`, joined, and their sizes."""
        sizes = self.sizes[at]
        shift = np.repeat(self.starts[at] - (np.cumsum(sizes) - sizes), sizes)
        return self.flat[shift + np.arange(len(shift))], sizes


def id_type(vocabulary: int) -> str:
    """How ids lie in `token_ids`."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def token_ids(docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, tie, row, ids): the ids (binary, see `id_type`) of each whole text and the end id.

    `tokenizer`: the JSON text of a byte-level tokenizer.  NULL and empty texts have just the end id.  tie and row
    order rows of the same id: by a hash of the text, then as they were read.
    """
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    named = named.select("doc_id", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"), "text")
    kind = id_type(vocabulary)

    def run(batches):
        coder = WordCoder(tokenizer)

        def coded(block):
            rows = pa.Table.from_batches(block).combine_chunks()
            texts = pc.fill_null(rows.column("text"), "").combine_chunks()
            size = pc.binary_length(texts).to_numpy()
            odd = coder.odd(texts)
            plain, others, empty = (np.flatnonzero(x) for x in (~odd & (size > 0), odd, size == 0))
            numbers, words = coder.number_all(texts.take(pa.array(plain))) if len(plain) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            more = [coder.numbers(t) for t in texts.take(pa.array(others)).to_pylist()]
            coder.learn()
            ids, sizes = coder.of_word.take(np.concatenate([numbers, *more]))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            last = np.cumsum(np.concatenate([words, [len(m) for m in more], np.zeros(len(empty), np.int64)]).astype(np.int64))
            bounds = ends[last]
            ids = np.insert(ids, bounds, end_id).astype(kind)
            places = np.concatenate([[0], bounds + np.arange(1, len(bounds) + 1)]) * ids.itemsize
            lists = pa.Array.from_buffers(pa.large_binary(), len(bounds), [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(ids)])
            at = pa.array(np.concatenate([plain, others, empty]))
            names = ["doc_id", "tie", "row"]
            made = pa.table([*(rows.column(n).take(at) for n in names), lists.cast(pa.binary())], [*names, "ids"])
            yield from made.to_batches(common.BATCH_ROWS)

        block, size = [], 0
        for batch in batches:
            block.append(batch)
            size += batch.column("text").nbytes
            if size >= BLOCK_BYTES:
                yield from coded(block)
                block, size = [], 0
                if len(coder.words) > MEMORY_WORDS:
                    coder.forget()
        if block:
            yield from coded(block)

    return named.mapInArrow(run, "doc_id long, tie long, row long, ids binary")


def _lists(column: pa.Array, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a batch of `token_ids`, joined, and how many each row has."""
    kind = np.dtype(id_type(vocabulary))
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), kind), np.array([len(p) // kind.itemsize for p in parts], np.int64)


# ---- codes -------------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Bits of each symbol's code (0: it does not occur), the best with none over `longest`: package-merge.

    Symbols of equal count go by their number.  If 2**longest codes are too few, `longest` grows.
    """
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    longest = max(longest, int(np.ceil(np.log2(len(used)))))
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    level, flags = leaves, [np.ones(len(leaves), bool)]
    for _ in range(longest - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, pairs])
        place = np.argsort(both, kind="stable")
        level = both[place]
        flags.append(place < len(leaves))
    take = 2 * len(leaves) - 2
    for is_leaf in reversed(flags):
        own = int(is_leaf[:take].sum())
        lengths[order[:own]] += 1
        take = 2 * (take - own)
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes by length, then symbol."""
    codes = np.zeros(len(lengths), np.uint64)
    code, before = 0, 0
    for size in range(1, int(lengths.max(initial=0)) + 1):
        own = np.flatnonzero(lengths == size)
        code <<= size - before
        codes[own] = code + np.arange(len(own), dtype=np.uint64)
        code, before = code + len(own), size
    return codes


def table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbol and length by the next `width` bits, and width."""
    width = max(1, int(lengths.max(initial=0)))
    order = np.lexsort([np.arange(len(lengths)), lengths])
    order = order[lengths[order] > 0]
    spans = np.int64(1) << (width - lengths[order].astype(np.int64))
    rest = (1 << width) - int(spans.sum())
    symbols = np.concatenate([np.repeat(order, spans), np.zeros(rest, np.int64)]).astype(np.int32)
    sizes = np.concatenate([np.repeat(lengths[order], spans), np.zeros(rest, np.uint8)]).astype(np.int64)
    return symbols, sizes, width


def pack(ids: np.ndarray, counts: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Documents' codes, each document from a full byte on; their sizes in bytes; the bit offset of each block in its document.

    `ids`: of all documents, one after the other; `counts`: how many each has.
    """
    size = lengths[ids].astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(size)])
    last = np.cumsum(counts)
    first = last - counts
    doc_bytes = -(-(ends[last] - ends[first]) // 8)
    starts = np.cumsum(doc_bytes) - doc_bytes
    at = ends[:-1] + np.repeat(8 * starts - ends[first], counts)
    words = np.zeros(int(doc_bytes.sum()) // 4 + 3, np.uint64)
    if len(ids):
        place, inside = at >> 5, (at & 31).astype(np.uint64)
        value = codes[ids] << (np.uint64(64) - inside - size.astype(np.uint64))
        heads = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        words[place[heads]] += np.add.reduceat(value >> np.uint64(32), heads)
        words[place[heads] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), heads)
    blocks = -(-counts // BLOCK)
    of = np.repeat(np.arange(len(counts)), blocks)
    number = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    marks = ends[first[of] + number * BLOCK] - ends[first[of]]
    return words.astype(">u4").tobytes()[: int(doc_bytes.sum())], doc_bytes, marks


def unpack(data: bytes, at: np.ndarray, counts: np.ndarray, tables: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """The ids of blocks that begin at the bits `at`; all blocks are read in step, an id of each at a time."""
    symbols, sizes, width = tables
    out = np.empty(int(counts.sum()), np.int32)
    padded = data + b"\0" * 8
    windows = np.ndarray((len(padded) - 3,), ">u4", padded, strides=(1,))
    order = np.argsort(-counts, kind="stable")
    place, left = at[order].astype(np.int64), counts[order]
    to = (np.cumsum(counts) - counts)[order]
    many = np.searchsorted(-left, -np.arange(int(left.max(initial=0))) - 0.5)
    for step, n in enumerate(many):
        own = place[:n]
        bits = (windows[own >> 3].astype(np.int64) >> (32 - width - (own & 7))) & ((1 << width) - 1)
        out[to[:n] + step] = symbols[bits]
        own += sizes[bits]
    return out


# ---- files -------------------------------------------------------------------------------------


def write(ids: DataFrame, folder: str, vocabulary: int) -> DataFrame:
    """Files of all documents' ids, in ascending order of documents; (path, part, seq, documents, base, tokens) of each.

    `ids`: from `token_ids`, stored.  Codes come from the counts of all ids; the counts, at most one per entry of
    the vocabulary, go to the driver.  Documents go by id (NULL first), tie and row to parts of like size, so
    rows of one id may lie in several.  base: ids in all files before.

    A file: a head; code lengths; documents' ids, numbers of ids and bytes; the bit offset of each block of
    BLOCK ids in its document; the codes.  A block can be read by itself.
    """
    spark = ids.sparkSession
    lengths = code_lengths(_counts(ids, vocabulary))
    codes = canonical(lengths)
    packed_lengths = zlib.compress(lengths.tobytes())
    parts = 4 * common.partitions(spark)
    key = ["doc_id", "tie", "row"]
    dealt = ids.select(*key).repartitionByRange(parts, *[F.col(k).asc_nulls_first() for k in key])
    bounds = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min_by(F.struct(*key), F.struct(F.col("doc_id").isNotNull(), *key)).alias("low"))
    comparable = lambda d, tie, row: (d is not None, d or 0, tie, row)
    lows = sorted(comparable(*r["low"]) for r in bounds.collect())  # one per part

    def coded(batches):
        for batch in batches:
            flat, counts = _lists(batch.column("ids"), vocabulary)
            data, sizes, marks = pack(flat, counts, codes, lengths)
            ends, blocks = np.cumsum(sizes), -(-counts // BLOCK)
            to = np.cumsum(blocks)
            keys = zip(*(batch.column(k).to_pylist() for k in key))
            yield pa.RecordBatch.from_arrays(
                [pa.array([bisect.bisect_right(lows, comparable(*k)) for k in keys], pa.int32()), *(batch.column(k) for k in key), pa.array(counts),
                 pa.array([data[b - a : b] for a, b in zip(sizes, ends)], pa.binary()),
                 pa.array([marks[b - a : b].tobytes() for a, b in zip(blocks, to)], pa.binary())],
                ["part", *key, "n", "codes", "marks"],
            )

    def filed(batches):
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base)
        part, seq, held, size = None, 0, [], 0

        def finish():
            name = f"{part:08d}-{seq:06d}-{uuid.uuid4().hex}"
            docs = np.array([h[0] or 0 for h in held], np.int64).tobytes() + np.array([h[0] is not None for h in held], np.uint8).tobytes()
            docs += np.array([h[1] for h in held], np.int64).tobytes() + np.array([len(h[2]) for h in held], np.int64).tobytes()
            tokens, docs, marks = sum(h[1] for h in held), zlib.compress(docs), zlib.compress(b"".join(h[3] for h in held))
            with store.open_output_stream(f"{base}/{name}.part") as out:
                out.write(struct.pack(HEAD, MAGIC, vocabulary, BLOCK, len(held), tokens, len(packed_lengths), len(docs), len(marks), size))
                for section in (packed_lengths, docs, marks, *(h[2] for h in held)):
                    out.write(section)
            store.move(f"{base}/{name}.part", f"{base}/{name}.ids")
            return pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}.ids", "part": part, "seq": seq, "documents": len(held), "tokens": tokens}], kinds)

        for batch in batches:
            for p, doc, n, data, marks in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "n", "codes", "marks"))):
                if held and (p != part or size >= FILE_BYTES):
                    yield finish()
                    held, size, seq = [], 0, seq + 1
                part = p
                held.append((doc, n, data, marks))
                size += len(data)
        if held:
            yield finish()

    kinds = pa.schema([("path", pa.string()), ("part", pa.int32()), ("seq", pa.int64()), ("documents", pa.int64()), ("tokens", pa.int64())])
    rows = ids.mapInArrow(coded, "part int, doc_id long, tie long, row long, n long, codes binary, marks binary")
    rows = rows.repartition(common.partitions(spark), "part").sortWithinPartitions("part", *[F.col(k).asc_nulls_first() for k in key])
    files = common.stored(rows.mapInArrow(filed, "path string, part int, seq long, documents long, tokens long"), "id-files")
    # as many rows as files
    base = F.sum("tokens").over(Window.orderBy("part", "seq")) - F.col("tokens")
    return files.withColumn("base", base)


def _counts(ids: DataFrame, vocabulary: int) -> np.ndarray:
    def run(batches):
        found = np.zeros(vocabulary, np.int64)
        for batch in batches:
            found += np.bincount(_lists(batch.column("ids"), vocabulary)[0], minlength=vocabulary)
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"id": pa.array(some, pa.int64()), "n": pa.array(found[some], pa.int64())})

    rows = ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(vocabulary, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


class IdFile:
    """A file of ids, read by ranges."""

    def __init__(self, file):
        self.file = file
        head = file.read_at(struct.calcsize(HEAD), 0)
        if len(head) < struct.calcsize(HEAD) or head[:8] != MAGIC:
            raise ValueError("no file of ids")
        _, vocabulary, self.block, n, self.tokens, *sizes, self.bytes = struct.unpack(HEAD, head)
        sections, at = [], struct.calcsize(HEAD)
        for size in sizes:
            sections.append(zlib.decompress(file.read_at(size, at)))
            at += size
        self.payload = at
        lengths = np.frombuffer(sections[0], np.uint8)
        if len(lengths) != vocabulary:
            raise ValueError("a damaged file of ids")
        self.tables = table(lengths)
        docs = io.BytesIO(sections[1])
        ids, known, self.counts, self.sizes = (np.frombuffer(docs.read(n * np.dtype(t).itemsize), t) for t in (np.int64, np.uint8, np.int64, np.int64))
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, known)]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.marks = np.frombuffer(sections[2], np.int64)
        blocks = -(-self.counts // self.block)
        self.first_block = np.cumsum(blocks) - blocks
        self.blocks = blocks

    def groups(self, least: int, most: int):
        """(from, to) of documents that are decoded together, of those in [least, most)."""
        while least < most:
            ahead = np.cumsum(self.counts[least:most])
            to = least + max(1, int(np.searchsorted(ahead, DECODE_IDS, side="right")))
            yield least, to
            least = to

    def ids(self, least: int, most: int) -> np.ndarray:
        """The ids of the documents from least to most - 1."""
        data = self.file.read_at(int(self.sizes[least:most].sum()), self.payload + int(self.starts[least]))
        of = np.repeat(np.arange(least, most), self.blocks[least:most])
        own = slice(int(self.first_block[least]), int(self.first_block[least]) + len(of))
        number = np.arange(own.start, own.stop) - self.first_block[of]
        return unpack(data, 8 * (self.starts[of] - self.starts[least]) + self.marks[own], np.minimum(self.block, self.counts[of] - number * self.block), self.tables)

    def between(self, least: int, most: int) -> np.ndarray:
        """The ids at positions least to most - 1 of the file; only the blocks that hold them are read."""
        base = np.cumsum(self.counts) - self.counts
        of = np.repeat(np.arange(len(self.counts)), self.blocks)
        inside = (np.arange(len(of)) - self.first_block[of]) * self.block
        at, counts = base[of] + inside, np.minimum(self.block, self.counts[of] - inside)
        some = np.flatnonzero((at < most) & (at + counts > least))
        if not len(some):
            return np.zeros(0, np.int32)
        bits = 8 * self.starts[of] + self.marks
        low, after = int(bits[some[0]]) // 8, some[-1] + 1
        high = int(bits[after] + 7) // 8 if after < len(bits) else self.bytes
        data = self.file.read_at(high - low, self.payload + low)
        return unpack(data, bits[some] - 8 * low, counts[some], self.tables)[max(0, least - int(at[some[0]])) :][: most - max(least, int(at[some[0]]))]


def read(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of all documents in files, from the files alone.

    start: ids of all documents before it; ids: binary, each id as little-endian unsigned 32-bit integer.
    """

    def run(batches):
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                store, own = fs.FileSystem.from_uri(path)
                with store.open_input_file(own) as opened:
                    file = IdFile(opened)
                    begins = base + np.cumsum(file.counts) - file.counts
                    for a, b in file.groups(0, len(file.counts)):
                        data, counts = file.ids(a, b).astype("<u4").tobytes(), file.counts[a:b]
                        ends = 4 * np.cumsum(counts)
                        for i in range(0, b - a, common.BATCH_ROWS):
                            j = min(b - a, i + common.BATCH_ROWS)
                            yield pa.RecordBatch.from_pydict({
                                "doc_id": pa.array(file.doc_ids[a + i : a + j], pa.int64()), "start": pa.array(begins[a + i : a + j]), "n_tokens": pa.array(counts[i:j]),
                                "ids": pa.array([data[e - 4 * n : e] for e, n in zip(ends[i:j].tolist(), counts[i:j].tolist())], pa.binary()),
                            })

    return files.select("path", "base").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def read_range(files: DataFrame, start: int, stop: int) -> DataFrame:
    """(start, ids) of the ids at positions start to stop - 1 of all documents' ids, a row per file that holds some."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                store, own = fs.FileSystem.from_uri(r["path"])
                with store.open_input_file(own) as opened:
                    low = max(start, r["base"])
                    ids = IdFile(opened).between(low - r["base"], min(stop, r["base"] + r["tokens"]) - r["base"])
                    yield pa.RecordBatch.from_pydict({"start": [low], "ids": pa.array([ids.tolist()], pa.list_(pa.int32()))})

    held = files.filter((F.col("base") < stop) & (F.col("base") + F.col("tokens") > start)).select("path", "base", "tokens")
    return held.mapInArrow(run, "start long, ids array<int>")


def encode(docs: DataFrame, tokenizer: str, folder: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token ids of whole texts in files under `folder` (see `write`); the list of the files.

    Every row is kept: repeated rows, rows without id (they come first) or text (just the end id).  Empty tables
    give no files.  Of other columns nothing is used, whatever their names.  The ids are stored once, compressed,
    between counting and coding; of the texts nothing is shuffled, only their codes.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    vocabulary = max(Tokenizer.from_str(tokenizer).get_vocab_size(), end_id + 1)
    path = session.scratch_path(spark, "llm-ids")
    token_ids(docs, tokenizer, end_id, vocabulary, doc_id, text).write.option("compression", "zstd").parquet(path)
    return write(spark.read.parquet(path), folder, vocabulary)


def op13_token_files(spark, sf_dir):
    import public_tokenizers

    docs = common.table(spark, sf_dir, "documents")
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    files = encode(docs, tokenizer, session.scratch_path(spark, "id-files"), end_id=2)
    found = read(files.repartition(common.partitions(spark), "path"))
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
