"""Byte-level BPE by replaying the merges of a rank file over the distinct pieces of groups of texts.

Texts repeat pieces, so merges run on distinct pieces, of a task's group of texts and not of the corpus:
a piece is replayed in every task that meets it, and again after it was forgotten. For all new ones of a group of texts, an
inverted index maps each adjacent token pair to the positions where it stands. Merges are applied
in rank order, each at all its positions, and only the two neighbours of a merged pair are looked
up and indexed anew. Texts are then strings of known pieces. A task reads its texts in groups of
bounded size and remembers a bounded number of pieces, so nothing is shuffled.

Equal ranks merge from the left, a piece that is itself a token is taken whole, and if a merge makes a
pair of lower rank than its own, that piece is encoded on its own; so the ids are those of the
usual greedy encoder. Memory is linear in the group, or in a longer text.

Defined results: a null text encodes as the empty one, to no ids. Special tokens are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabpulse.llm.words import ChunkMemory

NEW_CHUNKS = 100_000  # whose pieces are encoded together


class Partners:
    """For each token, the tokens that merge with it on one side, and the ids they merge to."""

    def __init__(self, own: np.ndarray, other: np.ndarray, merged: np.ndarray, size: int):
        order = np.lexsort((other, own))
        self.other, self.merged = other[order], merged[order]
        self.bounds = np.searchsorted(own[order], np.arange(size + 1)).tolist()

    def ranks(self, own: int, others: np.ndarray) -> np.ndarray:
        """The id that each pair merges to, or -1."""
        low, high = self.bounds[own], self.bounds[own + 1]
        if low == high:
            return np.full(len(others), -1)
        known = self.other[low:high]
        at = np.minimum(np.searchsorted(known, others), high - low - 1)
        return np.where(known[at] == others, self.merged[low:high][at], -1)


class Merges:
    """The tokens of a rank file, and all pairs of tokens that merge."""

    def __init__(self, content: bytes):
        self.ranks = {base64.b64decode(token): int(rank)
                      for token, rank in map(bytes.split, content.splitlines()) if token}
        size = max(self.ranks.values()) + 1
        self.tokens = [b""] * size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = np.array([
            (left, right, rank) for token, rank in self.ranks.items() for cut in range(1, len(token))
            if (left := self.ranks.get(token[:cut])) is not None
            and (right := self.ranks.get(token[cut:])) is not None], np.int64).reshape(-1, 3)
        left, right, rank = pairs.T
        self.to_the_right = Partners(left, right, rank, size)
        self.to_the_left = Partners(right, left, rank, size)
        self.first_pairs = np.full((256, 256), -1)
        for value, own in enumerate(self.single.tolist()):
            self.first_pairs[value] = self.to_the_right.ranks(own, self.single)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def alone(self, piece: bytes) -> list[int]:
        """The greedy encoding of one piece, the leftmost of the lowest rank first."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        while True:
            ranks = [(rank, at) for at, (a, b) in enumerate(zip(ids, ids[1:]))
                     if (rank := self.ranks.get(self.tokens[a] + self.tokens[b])) is not None]
            if not ranks:
                return ids
            rank, at = min(ranks)
            ids[at:at + 2] = [rank]

    def replay(self, raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Apply merges to all pieces in rank order: ids, and where each piece's ids end.

        `raw` holds the pieces' bytes one after the other, `sizes` how many each has.
        """
        ends = np.cumsum(sizes)
        n = len(raw)
        token = self.single[raw]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = before[ends - sizes] = -1
        pair_rank = np.full(n, -1)  # of the pair that begins here, -1 if it doesn't merge
        pair_rank[:-1] = self.first_pairs[raw[:-1], raw[1:]]
        pair_rank[ends - 1] = -1
        gone = np.zeros(n, bool)
        index: dict[int, list[np.ndarray]] = {}  # pair's rank to places, some outdated
        due: list[int] = []
        astray: list[np.ndarray] = []  # places whose pieces are to be encoded alone

        def note(ranks: np.ndarray, places: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
            for low, high, rank in zip(cuts, cuts[1:], ranks[cuts[:-1]].tolist()):
                if rank in index:
                    index[rank].append(places[low:high])
                else:
                    index[rank] = [places[low:high]]
                    heappush(due, rank)

        start = np.flatnonzero(pair_rank >= 0)
        if len(start):
            note(pair_rank[start], start)
        while due:
            merged = heappop(due)
            parts = index.pop(merged)
            at = parts[0] if len(parts) == 1 else np.concatenate(parts)
            at = at[pair_rank[at] == merged]
            if len(at) > 1:
                at = np.unique(at)
                at = at[_leftmost(after[at[:-1]] == at[1:])]
            if not len(at):
                continue
            right = after[at]
            following = after[right]
            has = following >= 0
            within, follower = at[has], following[has]
            # A pair that stands only until its follower merges too must not come first.
            passing = self.to_the_right.ranks(merged, token[follower])
            if (passing >= 0).any():
                astray.append(within[(passing >= 0) & (passing <= merged)])
            token[at], gone[right] = merged, True
            after[at], before[follower] = following, within
            pair_rank[right] = pair_rank[at] = -1
            leading = before[at]
            leading = leading[leading >= 0]
            new = np.concatenate((self.to_the_right.ranks(merged, token[follower]),
                                  self.to_the_left.ranks(merged, token[leading])))
            places = np.concatenate((within, leading))
            pair_rank[places] = new
            live = new >= 0
            if live.any():
                new, places = new[live], places[live]
                early = new <= merged
                if early.any():
                    astray.append(places[early])
                note(new, places)

        # What went astray, or is a token as a whole, is put right in place.
        begin = ends - sizes
        left = set(np.searchsorted(ends, np.concatenate(astray), "right").tolist()) if astray else ()
        text = raw.tobytes()
        for which, (low, high) in enumerate(zip(begin.tolist(), ends.tolist())):
            whole = self.ranks.get(text[low:high])
            if whole is None and which not in left:
                continue
            ids = [whole] if whole is not None else self.alone(text[low:high])
            token[low:low + len(ids)] = ids
            gone[low:low + len(ids)], gone[low + len(ids):high] = False, True
        return token[~gone], np.cumsum(~gone)[ends - 1]


def _leftmost(chained: np.ndarray) -> np.ndarray:
    """Of places that each overlap the next one if chained, every other, from a chain's first."""
    if not chained.any():
        return np.ones(len(chained) + 1, bool)
    place = np.arange(len(chained) + 1)
    first = np.concatenate(([True], ~chained))
    return (place - np.maximum.accumulate(np.where(first, place, 0))) % 2 == 0


class Encoder:
    """Encodes texts to ids, as little-endian unsigned 32-bit integers."""

    def __init__(self, content: bytes, pattern: str):
        self.merges = Merges(content)
        self.split = regex.compile(pattern).findall
        self.memory = ChunkMemory(self._learn, NEW_CHUNKS)
        self.encode = self.memory.encode

    def _learn(self, chunks: list[str]) -> Iterator[bytes]:
        split = [self.split(chunk) for chunk in chunks]
        pieces = list(chain.from_iterable(split))
        points = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
        bytes_up_to = np.concatenate(([0], np.cumsum(
            1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000))))
        edges = bytes_up_to[np.cumsum(np.fromiter(map(len, pieces), int, len(pieces)))]
        raw = np.frombuffer("".join(pieces).encode(), np.uint8)
        ids, ends = self.merges.replay(raw, np.diff(edges, prepend=0))
        last = np.cumsum(np.fromiter(map(len, split), int, len(split))) - 1
        coded, cuts = ids.astype("<u4").tobytes(), (4 * ends[last]).tolist()
        return (coded[low:high] for low, high in zip([0, *cuts], cuts))


@lru_cache(maxsize=2)
def _encoder(content: bytes, pattern: str) -> Encoder:
    return Encoder(content, pattern)


def read_ranks(path: str) -> bytes:
    """A rank file, read by the driver; its size is bounded by the vocabulary."""
    with open(path, "rb") as file:
        return file.read()


def decoded(ids: Column, ranks: bytes, pattern: str) -> Column:
    """The bytes that ids stand for; null for null."""
    @F.arrow_udf("binary")
    def texts(batch: pa.Array) -> pa.Array:
        merges = _encoder(ranks, pattern).merges
        return pa.array([None if row is None else merges.decode(row) for row in batch.to_pylist()],
                        pa.binary())

    return texts.asNondeterministic()(ids)


def with_tokens(docs: DataFrame, ranks: bytes, pattern: str, text: str = "text",
                into: str = "tokens") -> DataFrame:
    """Add a struct of `ids` (little-endian unsigned 32-bit integers) and `decoded`, both binary.

    What is decoded are the ids, so the two tell whether the round trip is exact.
    """
    @F.arrow_udf("struct<ids:binary,decoded:binary>")
    def both(texts: pa.Array) -> pa.Array:
        encoder = _encoder(ranks, pattern)
        ids = encoder.encode(texts.to_pylist())
        back = [encoder.merges.decode(row) for row in ids]
        return pa.StructArray.from_arrays(
            [pa.array(ids, pa.binary()), pa.array(back, pa.binary())], ["ids", "decoded"])

    return docs.withColumn(into, both.asNondeterministic()(F.col(text)))


def digests(tokens: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of `with_tokens`."""
    return tokens.select(
        "doc_id", F.expr("octet_length(tokens.ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("tokens.ids", 256).alias("ids_sha256"),
        F.sha2("tokens.decoded", 256).alias("decoded_sha256"))
