"""Encode Arrow text columns by cutting texts at spaces and encoding each distinct piece once."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from rideframe.llm.support import filled, ragged_positions, split_lists, strings

CACHED_PIECES = 500_000
#: Characters that normalisation leaves as they are, that have one lower-case form and are no white space.
SIMPLE = r"\x{21}-\x{7e}\x{a1}-\x{12f}\x{131}-\x{24f}"
#: The matches of byte-level vocabularies in a piece of such characters and line feeds.
BYTE_LEVEL_MATCHES = r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\n+\z|\n"
SPACES = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: A space with white space before it and white space or the end after it: cutting there changes how a run is read.
UNSAFE = rf"[{SPACES}] (?:[{SPACES}]|\z)|\x{{00}}"

Encoded = tuple[np.ndarray, np.ndarray]


class PieceEncoder:
    """Ids of whole texts from the ids of their pieces.

    ``encode_pieces`` maps a list of strings to flat ids and their counts, ``encode_text``
    a whole text to its ids. With ``keep_space`` a piece begins with the space before it
    (byte-level vocabularies); texts in which a cut would change a run of white space are
    encoded whole. Without it the tokenizer drops white space and any cut there is safe. The
    memory of pieces is bounded: when it is full, those that the texts at hand do not have are
    dropped, which changes no result.
    """

    def __init__(self, encode_pieces: Callable[[list[str]], Encoded], encode_text: Callable[[str], np.ndarray], keep_space: bool, kept: int = CACHED_PIECES):
        self.encode_pieces, self.encode_text, self.keep_space, self.kept = encode_pieces, encode_text, keep_space, kept
        self.forget()

    def forget(self) -> None:
        """Give up the memory of pieces, as between tasks of different work in one worker."""
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)

    def _keep_only(self, pieces: list[str], numbers: np.ndarray) -> None:
        counts = self.counts[numbers]
        ids = self.ids[ragged_positions(self.starts[numbers], counts)]
        self.forget()
        self._add(pieces, ids, counts)

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        """The numbers of distinct pieces, each looked up once."""
        numbers = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        held = numbers >= 0
        fresh = list(compress(pieces, ~held))
        if len(self.known) + len(fresh) > self.kept:
            self._keep_only(list(compress(pieces, held)), numbers[held])
            numbers[held] = np.arange(len(self.known))
        if fresh:
            numbers[~held] = len(self.known) + np.arange(len(fresh))
            self._add(fresh, *self.encode_pieces(fresh))
        return numbers

    def _add(self, pieces: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, ids])
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces))))

    def _pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
        """Row offsets, the number of each piece, and the ids of texts that were encoded whole."""
        whole: dict[int, np.ndarray] = {}
        if self.keep_space:
            unsafe = pc.match_substring_regex(texts, UNSAFE)
            rows = np.flatnonzero(unsafe.to_numpy(zero_copy_only=False))
            whole = {int(i): self.encode_text(texts[int(i)].as_py()) for i in rows}
            if whole:
                texts = pc.if_else(unsafe, "", texts)
            texts = pc.replace_substring(texts, " ", "\x00 ")
        else:
            texts = pc.replace_substring(texts, "\n", " ")
        offsets, coded = split_lists(pc.split_pattern(texts, "\x00" if self.keep_space else " "))
        numbers = self._numbers(strings(coded.dictionary))
        return offsets, numbers[coded.indices.to_numpy(zero_copy_only=False)], whole

    def count(self, texts: pa.Array) -> np.ndarray:
        offsets, numbers, whole = self._pieces(filled(texts))
        total = np.concatenate([[0], np.cumsum(self.counts[numbers])])
        counts = total[offsets[1:]] - total[offsets[:-1]]
        for row, ids in whole.items():
            counts[row] = len(ids)
        return counts

    def encode(self, texts: pa.Array) -> Encoded:
        """Flat ids of all texts and the position where each text begins, with the end."""
        offsets, numbers, whole = self._pieces(filled(texts))
        counts = self.counts[numbers]
        ids = self.ids[ragged_positions(self.starts[numbers], counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])[offsets]
        if whole:
            parts = [whole.get(row, ids[ends[row] : ends[row + 1]]) for row in range(len(texts))]
            ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
            ids = np.concatenate(parts)
        return ids, ends


def append_id(ids: np.ndarray, ends: np.ndarray, extra: int) -> Encoded:
    """One more id after each text."""
    out = np.full(len(ids) + len(ends) - 1, extra, np.uint32)
    new_ends = ends + np.arange(len(ends))
    own = np.ones(len(out), bool)
    own[new_ends[1:] - 1] = False
    out[own] = ids
    return out, new_ends


def _space_rule(config: dict) -> bool | None:
    """True if pieces keep their space, False if spaces vanish, None if cuts are not known to be safe."""
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or any(c in t["content"] for c in (" ", "\n")) for t in config["added_tokens"]):
        return None
    before, splitter = config.get("normalizer"), config.get("pre_tokenizer") or {}
    if not before and splitter.get("type") == "ByteLevel" and splitter["use_regex"] and not splitter["add_prefix_space"]:
        return True
    steps = splitter.get("pretokenizers") or [{}]
    plain = {"NFC", "Lowercase", "Replace"}
    drops = steps[0].get("type") == "Split" and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
    outside = drops and r"[^\s\p{L}\p{N}]+" in steps[0]["pattern"].get("Regex", "")
    normal = (before or {}).get("normalizers", [])
    if outside and all(n["type"] in plain and (n["type"] != "Replace" or (n["pattern"], n["content"]) == ({"Regex": r"\s+"}, " ")) for n in normal):
        return False
    return None


def library_encoder(path: str, kept: int = CACHED_PIECES) -> PieceEncoder | WholeEncoder:
    """An encoder over a file of the tokenizers library, without added begin or end tokens.

    A piece of simple characters is cut into the matches of the vocabulary's own pattern, all pieces at once, and
    each distinct match goes straight to the library's model. All other pieces go through the whole library,
    normaliser and all.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        config = json.load(file)
    rule = _space_rule(config)

    def encode_each(texts: list[str]) -> Encoded:
        found = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum())), counts

    if rule is None:
        return WholeEncoder(encode_each)
    model, special = tokenizer.model, [t["content"] for t in config["added_tokens"]]
    matches = BYTE_LEVEL_MATCHES if rule else config["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    simple = rf"\A(?: ?[{SIMPLE}]|\n)[{SIMPLE}\n]*\z" if rule else rf"\A[{SIMPLE}]+\z"

    def encode_matches(found: list[str]) -> Encoded:
        flat: list[int] = []
        ends = [0]
        for word in _as_symbols(found):
            flat += [t.id for t in model.tokenize(word)]
            ends.append(len(flat))
        return np.array(flat, np.uint32), np.diff(ends)

    def encode_pieces(pieces: list[str]) -> Encoded:
        texts = pa.array(pieces, pa.string())
        plain = pc.match_substring_regex(texts, simple).to_numpy(zero_copy_only=False)
        if rule:  # a longer run of line feeds before a word is read as two matches
            plain &= ~pc.match_substring_regex(texts, r"\n{3}[^\n]").to_numpy(zero_copy_only=False)
        for content in special:
            plain &= ~pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        texts = texts.filter(pa.array(plain))
        if not rule:
            texts = pc.utf8_lower(texts)
        # Each match is followed by a separator, so the list of a piece ends with an empty string.
        ends, coded = split_lists(pc.split_pattern(pc.replace_substring_regex(texts, matches, "\\0\x00"), "\x00"))
        codes = np.delete(coded.indices.to_numpy(zero_copy_only=False), ends[1:] - 1)
        ends -= np.arange(len(ends))
        match_ids, match_counts = encode_matches(strings(coded.dictionary))
        sizes = match_counts[codes]
        ids = match_ids[ragged_positions((np.cumsum(match_counts) - match_counts)[codes], sizes)]
        counts = np.zeros(len(pieces), np.int64)
        counts[plain] = np.diff(np.concatenate([[0], np.cumsum(sizes)])[ends])
        if plain.all():
            return ids, counts
        others, counts[~plain] = encode_each(list(compress(pieces, ~plain)))
        out = np.empty(int(counts.sum()), np.uint32)
        from_matches = np.repeat(plain, counts)
        out[from_matches], out[~from_matches] = ids, others
        return out, counts

    return PieceEncoder(encode_pieces, lambda text: encode_each([text])[0], rule, kept)


def _as_symbols(words: list[str]) -> list[str]:
    """Each word with the characters that stand for its bytes in byte-level vocabularies: printable
    ones for themselves, the others, in order, for those from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    symbols = np.arange(256, dtype="<u4")
    symbols[hidden] = 256 + np.arange(len(hidden))
    symbols[0] = 0  # the separator
    points = np.frombuffer("\x00".join(words).encode(), np.uint8)
    return symbols[points].tobytes().decode("utf-32-le").split("\x00") if words else []


class WholeEncoder:
    """The same interface for vocabularies whose texts cannot be cut at spaces."""

    def __init__(self, encode_each: Callable[[list[str]], Encoded]):
        self.encode_each = encode_each

    def forget(self) -> None:
        """Nothing is held."""

    def count(self, texts: pa.Array) -> np.ndarray:
        return self.encode_each(filled(texts).to_pylist())[1]

    def encode(self, texts: pa.Array) -> Encoded:
        ids, counts = self.encode_each(filled(texts).to_pylist())
        return ids, np.concatenate([[0], np.cumsum(counts)])


def sentence_encoder(path: str) -> WholeEncoder:
    """An encoder over a sentencepiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode_each(texts: list[str]) -> Encoded:
        found = model.encode(texts, num_threads=1)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum())), counts

    return WholeEncoder(encode_each)


_ENCODERS: dict[tuple[str, int], PieceEncoder | WholeEncoder] = {}


def encoder(path: str, kept: int = CACHED_PIECES) -> PieceEncoder | WholeEncoder:
    """The encoder of a file, loaded once per worker: tokenizers for .json, sentencepiece for .model."""
    if (path, kept) not in _ENCODERS:
        _ENCODERS[path, kept] = sentence_encoder(path) if path.endswith(".model") else library_encoder(path, kept)
    return _ENCODERS[path, kept]
