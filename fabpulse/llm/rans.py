"""Token ids in binary files, compressed by a static range asymmetric numeral system (rANS).

Documents are put in order of their id by range, tokenised, and packed into blocks of whole
documents. Token counts over all blocks give one frequency table for all. Each block is then coded
on its own: its ids are dealt to interleaved lanes, each an rANS state of its own, so one step codes
an id for every lane. A block keeps its lanes' states at checkpoints, from which its parts decode
independently, and checksums of payload and documents.

A token store is a folder of three tables: `blocks` (the coded blocks, with the ids and sizes of
their documents), `parts` (the ids before each range of documents) and `frequencies`. Spark writes
them, so a lost executor costs only the tasks it ran, and any file system will do.

Defined results: a null text is the empty one, and every document ends with the end id. Null ids
come first. Rows that share an id are ordered by a hash of their text, null first. An empty table
makes an empty store. A block holds a long document whole; its parts still decode on their own.
The content of a special added token (<|endoftext|>) inside a text is that token, as the library
reads it as loaded, with `added_tokens`; without, it is ordinary text.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabpulse.llm.scratch import stored
from fabpulse.llm.words import CUT, ChunkMemory, is_word, marked

# The coder: states in [LOW, LOW << 32), 32-bit words, frequencies that sum to 1 << PRECISION.
PRECISION, LOW = 20, np.uint64(1 << 31)
WORD = np.uint64(32)
LANES, CHECKPOINT_STEPS = 512, 128
BLOCK_TOKENS = 96 << 10  # a row of its ids stays below half a region of a small JVM heap
HEADER = struct.Struct("<4sIIIII")  # magic, ids, lanes, steps between checkpoints, words, crc32
MAGIC = b"RNS1"

NEW_CHUNKS = 2_048  # tokenised together
KNOWN_BYTES = 24 << 20  # of a generation of remembered chunks
GROUP_CHARS = 1 << 20  # of texts tokenised together
LETTERS = "\u0530"  # Latin, Greek and Cyrillic; words of other letters are split by the tokenizer

DRAFT = ("part int, block long, start long, doc_ids array<bigint>, sizes array<int>, "
         "crcs array<bigint>, ids binary")
STORED = ("part int, block long, start long, doc_ids array<bigint>, sizes array<int>, "
          "crcs array<bigint>, coded binary")


class Table:
    """Frequencies of ids that sum to 1 << PRECISION, from their counts."""

    def __init__(self, ids: np.ndarray, frequencies: np.ndarray):
        self.ids, self.frequencies = ids, frequencies
        size = int(ids.max()) + 1 if len(ids) else 0
        self.wide = np.zeros(size, np.uint64)
        self.low = np.zeros(size, np.uint64)
        self.wide[ids] = frequencies
        self.low[ids] = np.cumsum(frequencies) - frequencies
        self.slots = np.repeat(ids, frequencies).astype(np.uint32)

    @classmethod
    def of_counts(cls, ids: np.ndarray, counts: np.ndarray) -> Table:
        if not len(ids):
            return cls(ids, counts)
        whole = 1 << PRECISION
        if len(ids) > whole:
            raise ValueError("more distinct ids than the coder's precision can tell apart")
        shares = np.maximum(1, np.floor(counts / counts.sum() * whole)).astype(np.int64)
        excess = int(shares.sum()) - whole
        for at in np.argsort(-shares, kind="stable"):
            if excess <= 0:
                break
            cut = min(excess, int(shares[at]) - 1)
            shares[at] -= cut
            excess -= cut
        shares[np.argmax(shares)] -= excess  # what is left over goes to the largest
        return cls(ids, shares)


def encode_block(ids: np.ndarray, table: Table) -> bytes:
    """Header, checkpoints (word position and lane states) and words of one block."""
    lanes = min(LANES, max(1, len(ids) // 16))
    steps = -(-len(ids) // lanes)
    state = np.full(lanes, LOW)
    words: list[np.ndarray] = []
    marks: list[tuple[int, bytes]] = []
    written = 0
    wides, lows = table.wide[ids], table.low[ids]
    tops, rests = wides << np.uint64(31 - PRECISION + 32), np.uint64(1 << PRECISION) - wides
    for step in range(steps - 1, -1, -1):
        now = slice(step * lanes, min((step + 1) * lanes, len(ids)))
        own = state[:now.stop - now.start]
        full = np.flatnonzero(own >= tops[now])
        if len(full):
            out = own[full]
            words.append(out.astype("<u4"))  # its lower half
            written += len(out)
            own[full] = out >> WORD
        # The quotient is shifted, the remainder stays: (own // wide << PRECISION) + own % wide + low.
        times = own // wides[now]
        times *= rests[now]
        own += times
        own += lows[now]
        if step % CHECKPOINT_STEPS == 0:
            marks.append((written, state.astype("<u8").tobytes()))
    body = b"".join(struct.pack("<I", written - count) + states for count, states in reversed(marks))
    body += b"".join(part.tobytes() for part in reversed(words))
    return HEADER.pack(MAGIC, len(ids), lanes, CHECKPOINT_STEPS, written, zlib.crc32(body)) + body


class CodedBlock:
    """A coded block, checked against its checksum; `decode_from` reads one part."""

    def __init__(self, coded: bytes):
        magic, self.size, self.lanes, self.every, words, crc = HEADER.unpack_from(coded)
        body = memoryview(coded)[HEADER.size:]
        if magic != MAGIC or zlib.crc32(body) != crc:
            raise ValueError("damaged block")
        self.steps = -(-self.size // self.lanes) if self.size else 0
        self.checkpoints = -(-self.steps // self.every)
        width = 4 + 8 * self.lanes
        self.marks = [(struct.unpack_from("<I", body, at)[0],
                       np.frombuffer(body, "<u8", self.lanes, at + 4))
                      for at in range(0, self.checkpoints * width, width)]
        self.words = np.frombuffer(body, "<u4", words, self.checkpoints * width)

    def decode_from(self, checkpoint: int, table: Table) -> np.ndarray:
        """The ids from one checkpoint to the next, independent of all others."""
        at, state = self.marks[checkpoint]
        state = state.astype(np.uint64)
        first = checkpoint * self.every
        last = min(first + self.every, self.steps)
        out = np.empty(min(last * self.lanes, self.size) - first * self.lanes, np.uint32)
        precision, mask = np.uint64(PRECISION), np.uint64((1 << PRECISION) - 1)
        for step in range(first, last):
            put = (step - first) * self.lanes
            own = state[:min(self.lanes, self.size - step * self.lanes)]
            slot = own & mask
            now = table.slots[slot]
            out[put:put + len(own)] = now
            own >>= precision
            own *= table.wide[now]
            slot -= table.low[now]
            own += slot
            short = np.flatnonzero(own < LOW)
            if len(short):
                own[short] = (own[short] << WORD) | self.words[at:at + len(short)]
                at += len(short)
        if last == self.steps and (at != len(self.words) or (state != LOW).any()):
            raise ValueError("a block does not end where it should")
        return out

    def decode(self, table: Table) -> np.ndarray:
        parts = [self.decode_from(c, table) for c in range(self.checkpoints)]
        return np.concatenate(parts) if parts else np.empty(0, np.uint32)


class ChunkTokenizer:
    """Encodes texts by a tokenizer of the tokenizers library, as little-endian 32-bit integers.

    A new word of letters only is one piece by the splitting pattern, so it goes to the library's
    model at once, which spares the splitting. Other new words are given to the tokenizer many at a
    time, one to a line: the splitting pattern sets a line end between words apart, so its id tells
    where each word's ids end. A text that holds an added token is given to it whole, as white
    space beside the token splits differently in chunks.
    """

    def __init__(self, definition: str, added_tokens: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = not added_tokens
        contents = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()
                    if added_tokens or not token.special]
        self.added = re.compile("|".join(map(re.escape, contents))) if contents else None
        # A token with a line end in it could be made by putting words one to a line.
        self.line_end = array("I") if "\n" in "".join(contents) else self._ids("\n")
        self.model = self.tokenizer.model
        self.written, self.odd = _letters(self.tokenizer)
        self.memory = ChunkMemory(self._learn, NEW_CHUNKS, KNOWN_BYTES)

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """What each whole text encodes to; a null text is the empty one."""
        texts = [text or "" for text in texts]
        whole = [CUT in text or (self.added is not None and self.added.search(text) is not None) for text in texts]
        cut = iter(self._encode_cut([text for text, kept in zip(texts, whole) if not kept]))
        return [self._ids(text).tobytes() if kept else next(cut) for text, kept in zip(texts, whole)]

    def _encode_cut(self, texts: list[str]) -> list[bytes]:
        """By chunks, each distinct one looked up once."""
        if not texts:
            return []
        cuts = list(map(marked, texts))
        joined = CUT.join(cuts).encode()
        ends = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0)
        letters = joined.replace(CUT.encode(), b"")
        offsets = np.concatenate([[0], ends - np.arange(len(ends)), [len(letters)]]).astype(np.int64)
        coded = pa.LargeStringArray.from_buffers(
            len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(letters)).dictionary_encode()
        known = self.memory.codes(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = np.frombuffer(b"".join(known), "<u4")
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        places = coded.indices.to_numpy()
        counts = sizes[places]
        after = np.cumsum(counts)
        # Where a chunk's ids begin among the known ones, less where they begin in the texts.
        shift = (np.cumsum(sizes) - sizes)[places] - after + counts
        found = ids[np.repeat(shift, counts) + np.arange(after[-1])].tobytes()
        bounds = [0, *(4 * after[np.cumsum([cut.count(CUT) + 1 for cut in cuts]) - 1]).tolist()]
        return [found[low:high] for low, high in zip(bounds, bounds[1:])]

    def _ids(self, text: str) -> array:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _learn(self, chunks: list[str]) -> list[bytes]:
        if not self.written:
            return self._learn_split(chunks)
        written, odd, tokenize = self.written, self.odd, self.model.tokenize
        coded: list[bytes | None] = []
        for chunk in chunks:
            word = chunk[1:] if chunk[:1] == " " else chunk
            if word.isalpha() and (word.isascii() or max(word) < LETTERS) and not (odd and odd.intersection(word)):
                letters = charmap_decode(chunk.encode(), "strict", written)[0]
                coded.append(array("I", [token.id for token in tokenize(letters)]).tobytes())
            else:
                coded.append(None)
        others = iter(self._learn_split([chunk for chunk, code in zip(chunks, coded) if code is None]))
        return [next(others) if code is None else code for code in coded]

    def _learn_split(self, chunks: list[str]) -> list[bytes]:
        if not chunks:
            return []
        plain = list(map(is_word, chunks)) if len(self.line_end) == 1 else [False] * len(chunks)
        lines = "\n".join(chunk for chunk, word in zip(chunks, plain) if word) + "\n"
        found = self.tokenizer.encode_batch_fast(
            [lines, *(chunk for chunk, word in zip(chunks, plain) if not word)],
            add_special_tokens=False)
        ids = np.array(found[0].ids, "<u4")
        ends = np.flatnonzero(ids == self.line_end[0]).tolist() if any(plain) else []
        coded = ids.tobytes()
        words = (coded[4 * low:4 * high] for low, high in zip([0, *(end + 1 for end in ends)], ends))
        others = (array("I", x.ids).tobytes() for x in found[1:])
        return [next(words) if word else next(others) for word in plain]


def _letters(tokenizer) -> tuple[str, set[str]]:
    """What the splitter writes for each byte, and the letters below LETTERS that it may split a word at;
    nothing where it isn't the byte-level one with its pattern.
    """
    splitter = tokenizer.pre_tokenizer
    if (tokenizer.normalizer is not None or type(splitter).__name__ != "ByteLevel"
            or splitter.add_prefix_space or not splitter.use_regex):
        return "", set()
    split = splitter.pre_tokenize_str
    written, odd = {ord(" "): split(" ")[0][0]}, set()
    for letter in filter(str.isalpha, map(chr, range(ord(LETTERS)))):
        if len(split(f" a{letter}a")) == 1:
            written.update(zip(letter.encode(), split(letter)[0][0]))
        else:
            odd.add(letter)
    return "".join(written.get(byte, "\ufffe") for byte in range(256)), odd


@lru_cache(maxsize=2)
def _tokenizer(definition: str, added_tokens: bool = False) -> ChunkTokenizer:
    return ChunkTokenizer(definition, added_tokens)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Rows in groups of bounded text."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids.append(doc_id)
            texts.append(text)
            size += len(text or "")
            if size >= GROUP_CHARS:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def draft_blocks(docs: DataFrame, definition: str, end_id: int, added_tokens: bool = False) -> DataFrame:
    """Uncoded blocks of whole documents, in order of (part, block)."""
    columns = [name.split()[0] for name in DRAFT.split(", ")]

    def drafts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, end = TaskContext.get().partitionId(), array("I", [end_id]).tobytes()
        tokenizer = _tokenizer(definition, added_tokens)
        block = start = held = 0
        pending: list[tuple] = []

        def flush() -> pa.RecordBatch:
            ids, coded = zip(*pending)
            row = (part, block, start, list(ids), [len(c) // 4 for c in coded],
                   [zlib.crc32(c) for c in coded], b"".join(coded))
            return pa.RecordBatch.from_arrays(
                [pa.array([value], kind) for value, kind in zip(row, _DRAFT_TYPES)], columns)

        for ids, texts in _groups(batches):
            for doc_id, found in zip(ids, tokenizer.encode(texts)):
                pending.append((doc_id, found + end))
                held += len(found) // 4 + 1
                if held >= BLOCK_TOKENS:
                    yield flush()
                    block, start, held, pending = block + 1, start + held, 0, []
        if pending:
            yield flush()

    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("tie"),
                    F.col("text").isNotNull().alias("given"))
        .repartitionByRange("doc_id", "given", "tie")
        .sortWithinPartitions("doc_id", "given", "tie").select("doc_id", "text")
    )
    return ordered.mapInArrow(drafts, DRAFT)


_DRAFT_TYPES = (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()),
                pa.list_(pa.int64()), pa.binary())


def count_tokens(drafts: DataFrame) -> Table:
    """The shared table, from the counts of all ids; at most one row per id comes to the driver."""
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for row in batch.column("ids"):
                found = np.bincount(np.frombuffer(row.as_buffer(), "<u4"))
                if len(found) > len(total):
                    found[:len(total)] += total
                    total = found
                else:
                    total[:len(found)] += found
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    rows = (drafts.select("ids").mapInArrow(counts, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n"))).toArrow().sort_by("id")
    return Table.of_counts(rows["id"].to_numpy(), rows["n"].to_numpy())


def write_store(docs: DataFrame, path: str, definition: str, end_id: int, *,
                added_tokens: bool = False) -> None:
    """Tokenise documents (doc_id, text) and write the store to a folder."""
    spark = docs.sparkSession
    drafts = stored(draft_blocks(docs, definition, end_id, added_tokens), "drafts")
    table = count_tokens(drafts)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _tokenizer.cache_clear()
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                ids = np.frombuffer(one.column("ids")[0].as_buffer(), "<u4")
                yield pa.RecordBatch.from_arrays(
                    [*one.columns[:-1], pa.array([encode_block(ids, table)], pa.binary())],
                    [*one.schema.names[:-1], "coded"])

    drafts.mapInArrow(code, STORED).write.parquet(f"{path}/blocks")
    # One row per range of documents, as many as there were tasks.
    sizes = (drafts.groupBy("part")
             .agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x)).alias("n"))
             .orderBy("part").collect())
    starts, before = [], 0
    for row in sizes:
        starts.append((row["part"], before))
        before += row["n"]
    spark.createDataFrame(starts, "part int, ids_before long").coalesce(1).write.parquet(f"{path}/parts")
    spark.createDataFrame(
        pa.table({"id": table.ids, "frequency": table.frequencies})
    ).coalesce(1).write.parquet(f"{path}/frequencies")


def read_table(spark: SparkSession, path: str) -> Table:
    rows = spark.read.parquet(f"{path}/frequencies").toArrow().sort_by("id")
    return Table(rows["id"].to_numpy(), rows["frequency"].to_numpy())


def read_store(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of each document, decoded and checked.

    Without `ids` all is decoded and checked the same, but no ids go back to the JVM.
    """
    table = read_table(spark, path)
    columns = {"part": "int", "doc_id": "long", "offset": "long", "n_tokens": "long",
               "ids_crc32": "long", **({"ids": "binary"} if with_ids else {})}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _tokenizer.cache_clear()  # what a reused worker remembers of chunks
        for batch in batches:
            for row in range(batch.num_rows):
                part, start, doc_ids, sizes, crcs, coded = (
                    batch.column(name)[row] for name in
                    ("part", "start", "doc_ids", "sizes", "crcs", "coded"))
                ids = CodedBlock(coded.as_buffer()).decode(table).astype("<u4")
                counts = np.array(sizes.as_py(), np.int64)
                ends = np.cumsum(counts)
                pieces = np.split(ids, ends[:-1])
                found = list(map(zlib.crc32, pieces))
                if found != crcs.as_py() or int(ends[-1]) != len(ids):
                    raise ValueError("a block's documents do not meet their checksums")
                values = [pa.array([part.as_py()] * len(counts), pa.int32()), doc_ids.values,
                          pa.array(start.as_py() + ends - counts), pa.array(counts),
                          pa.array(found, pa.int64())]
                if with_ids:
                    values.append(pa.array([piece.tobytes() for piece in pieces], pa.binary()))
                yield pa.RecordBatch.from_arrays(values, list(columns))

    decoded = spark.read.parquet(f"{path}/blocks").mapInArrow(
        read, ", ".join(f"{name} {kind}" for name, kind in columns.items()))
    # As many rows as there were tasks, a few numbers each; Spark broadcasts them by their size.
    return decoded.join(spark.read.parquet(f"{path}/parts"), "part").select(
        "doc_id", (F.col("ids_before") + F.col("offset")).alias("start"), *list(columns)[3:])
