"""Byte-level BPE by replaying merges over all distinct words of a part of the corpus at once."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from rideframe.llm.encoding import PieceEncoder
from rideframe.llm.support import binary_array, ragged_positions, reach_workers, text_slices

NONE = np.int32(2**31 - 1)
REPLAY_BYTES = 8 << 20
KEPT_PIECES = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a rank file."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class MergeReplay:
    """Encodes many words by applying every merge once, in rank order, wherever it occurs.

    ``index`` maps a rank to the positions whose pair of neighbours makes that token. The
    lowest rank is taken from a heap; its positions are merged together, leftmost first where
    they overlap, and only the pairs that touch a merged token are looked up again and put
    into the index. Where a merge uncovers a pair of lower rank, be it only until the merge
    beside it, taking one pair at a time could end otherwise; such words, which trained
    vocabularies hardly have, are encoded again in that way.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.stride = max(ranks.values()) + 1
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.stride + right] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[k] for k in self.keys.tolist()], np.int32)

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self.stride + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.made[at], NONE)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the words and the number of ids of each."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        n = int(lengths.sum())
        if not n:
            return np.zeros(0, np.uint32), lengths
        firsts = (np.cumsum(lengths) - lengths)[lengths > 0]
        symbol = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        right = np.arange(1, n + 1, dtype=np.int32)
        left = np.arange(-1, n - 1, dtype=np.int32)
        right[np.append(firsts[1:], n) - 1] = -1
        left[firsts] = -1
        rank = np.full(n, NONE, np.int32)  # of the pair that begins here
        starts = np.flatnonzero(right >= 0)
        rank[starts] = self._ranks_of(symbol[starts], symbol[starts + 1])
        alive = np.ones(n, bool)
        odd: list[np.ndarray] = []
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def put(positions: np.ndarray) -> None:
            found = rank[positions]
            positions, found = positions[found != NONE], found[found != NONE]
            if not len(positions):
                return
            order = np.argsort(found, kind="stable")
            positions, found = positions[order], found[order]
            cuts = np.flatnonzero(np.diff(found)) + 1
            for r, part in zip(found[np.concatenate([[0], cuts])].tolist(), np.split(positions, cuts)):
                if r not in index:
                    index[r] = []
                    heapq.heappush(heap, r)
                index[r].append(part)

        put(starts)
        while heap:
            r = heapq.heappop(heap)
            parts = index.pop(r)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            at = at[rank[at] == r]
            if not len(at):
                continue
            if len(at) > 1:
                joined = right[at[:-1]] == at[1:]
                if joined.any():
                    places = np.arange(len(at))
                    opens = np.concatenate([[True], ~joined])
                    at = at[(places - np.maximum.accumulate(np.where(opens, places, 0))) % 2 == 0]
            gone = right[at]
            after = right[gone]
            side = np.flatnonzero(after[:-1] == at[1:])  # merges next to each other
            if len(side):
                between = self._ranks_of(np.full(len(side), r), symbol[at[side + 1]])
                if (between < r).any():
                    odd.append(at[side[between < r]])
            symbol[at] = r
            right[at] = after
            left[after[after >= 0]] = at[after >= 0]
            alive[gone] = False
            rank[gone] = NONE
            before = left[at]
            before = before[before >= 0]
            touched = np.unique(np.concatenate([at, before]))
            follows = right[touched]
            fresh = np.full(len(touched), NONE, np.int32)
            has = follows >= 0
            fresh[has] = self._ranks_of(symbol[touched[has]], symbol[follows[has]])
            rank[touched] = fresh
            if (fresh < r).any():
                odd.append(touched[fresh < r])
            put(touched)
        ids = symbol[alive].astype(np.uint32)
        before = np.concatenate([[0], np.cumsum(alive)])
        word_firsts = np.cumsum(lengths) - lengths
        counts = before[word_firsts + lengths] - before[word_firsts]
        if odd:
            ids, counts = self._again(words, word_firsts, np.unique(np.concatenate(odd)), ids, counts)
        return ids, counts

    def _again(self, words, word_firsts, positions, ids, counts):
        ends = np.cumsum(counts)
        parts = [ids[e - c : e] for e, c in zip(ends.tolist(), counts.tolist())]
        for w in np.unique(np.searchsorted(word_firsts, positions, side="right") - 1).tolist():
            parts[w] = np.array(self.encode_word(words[w]), np.uint32)
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)

    def encode_word(self, word: bytes) -> list[int]:
        """One word, one pair at a time: the lowest rank first, the leftmost of equal ones."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], NONE), i) for i in range(len(parts) - 1))
            if rank == NONE:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]


_ENCODERS: dict[tuple[str, str], PieceEncoder] = {}


def replay_encoder(path: str, pattern: str) -> PieceEncoder:
    """The replay of a rank file, behind the cutting of texts at spaces; once per worker.

    ``pattern`` must be one that takes a single space together with what follows it and
    never joins other white space with what precedes it, as byte-level vocabularies do.
    """
    if (path, pattern) not in _ENCODERS:
        replay = MergeReplay(read_ranks(path))
        match = regex.compile(pattern)

        def encode_pieces(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
            numbers: dict[str, int] = {}
            uses: list[int] = []
            per_piece = np.zeros(len(pieces), np.int64)
            for i, piece in enumerate(pieces):
                found = match.findall(piece)
                per_piece[i] = len(found)
                uses += [numbers.setdefault(w, len(numbers)) for w in found]
            ids, counts = replay.encode([w.encode() for w in numbers])
            starts = np.cumsum(counts) - counts
            used = np.array(uses, np.int64)
            flat = ids[ragged_positions(starts[used], counts[used])] if len(used) else ids[:0]
            total = np.concatenate([[0], np.cumsum(counts[used])])
            ends = np.concatenate([[0], np.cumsum(per_piece)])
            return flat, np.diff(total[ends])

        def encode_text(text: str) -> np.ndarray:
            return encode_pieces([text])[0]

        _ENCODERS[path, pattern] = PieceEncoder(encode_pieces, encode_text, keep_space=True, kept=KEPT_PIECES)
    return _ENCODERS[path, pattern]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, decode: bool = False) -> DataFrame:
    """Ids of every whole text: doc_id, n_tokens, ids (little-endian unsigned 32-bit).

    With ``decode`` the ids are decoded at once, in the same worker, into ``decoded`` (binary).
    Each task takes up to 8 MB of text at a time, replays the merges over the distinct words
    that it does not hold yet, and puts the ids of the words together; nothing is shuffled.
    A null text is empty and has no ids; null and repeated doc_ids stay; further columns are
    ignored; an empty table gives no rows.
    """
    reach_workers(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = replay_encoder(ranks_path, pattern)
        for part in text_slices(batches, "text", REPLAY_BYTES):
            ids, ends = pieces.encode(part.column("text"))
            columns = {"doc_id": part.column("doc_id"), "n_tokens": pa.array(np.diff(ends), pa.int64()), "ids": binary_array(ids.astype("<u4"), ends * 4)}
            if decode:
                columns["decoded"] = decoded_texts(columns["ids"], ranks_path)
            yield pa.RecordBatch.from_pydict(columns)

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(encode, "doc_id long, n_tokens long, ids binary" + (", decoded binary" if decode else ""))


def decoded_texts(ids: pa.Array, ranks_path: str) -> pa.Array:
    tokens = token_bytes(ranks_path)
    return pa.array((b"".join([tokens[i] for i in np.frombuffer(row.as_buffer(), "<u4").tolist()]) for row in ids), pa.binary())


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """The bytes behind the ids: the columns of ``encode_documents`` and ``decoded`` (binary)."""
    reach_workers(encoded.sparkSession)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded_texts(batch.column("ids"), ranks_path)], [*batch.schema.names, "decoded"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(decode, "doc_id long, n_tokens long, ids binary, decoded binary")


_TOKENS: dict[str, list[bytes]] = {}


def token_bytes(path: str) -> list[bytes]:
    if path not in _TOKENS:
        ranks = read_ranks(path)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        _TOKENS[path] = tokens
    return _TOKENS[path]
