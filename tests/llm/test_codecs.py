"""Encoders and codecs against the libraries, and exact round trips."""

import random

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from rideframe.llm.encoding import PieceEncoder, append_id, encoder, library_encoder
from rideframe.llm.merge_replay import MergeReplay, read_ranks, replay_encoder
from rideframe.llm.packing import SumOfSquaresPacker
from rideframe.llm.simple8b import decode_blocks, encode_blocks
from tests.llm.data import ODD_TEXTS, texts_of

SPACES = ["a\n b", "a \nb", "a\n \nb", "a \n", "a\x00 b", "a   b  c ", "\x1c \x1d", "a\x85 \x85b", "é́ ́a", "Σας ΣΑΣ İ Å"]
TEXTS = [*ODD_TEXTS, *SPACES, *[t for _, t in texts_of()[:60]], *SPACES]
TIKTOKEN = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_the_library(name):
    path = public_tokenizers.path(name)
    library = Tokenizer.from_file(path)
    ids, ends = encoder(path).encode(pa.array(TEXTS))
    counts = encoder(path).count(pa.array(TEXTS))
    for i, text in enumerate(TEXTS):
        wanted = library.encode(text or "", add_special_tokens=False).ids
        assert ids[ends[i] : ends[i + 1]].tolist() == wanted, text
        assert counts[i] == len(wanted)


def test_sentencepiece_counts_are_those_of_the_library():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    assert encoder(path).count(pa.array(TEXTS)).tolist() == [len(library.encode(t or "")) for t in TEXTS]


def test_forgetting_pieces_changes_no_id():
    small = encoder(public_tokenizers.path("byte_bpe_50k.json"))
    whole = small.encode(pa.array(TEXTS))
    small.kept, before = 50, small.kept
    parts = [small.encode(pa.array([t])) for t in TEXTS]
    small.kept = before
    assert np.concatenate([p[0] for p in parts]).tolist() == whole[0].tolist()


def test_append_id():
    ids, ends = append_id(np.array([5, 6, 7], np.uint32), np.array([0, 2, 2, 3]), 1)
    assert (ids.tolist(), ends.tolist()) == ([5, 6, 1, 1, 7, 1], [0, 3, 4, 6])


def own_encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(TIKTOKEN), special_tokens={})


def test_merge_replay_gives_the_ids_of_tiktoken():
    library = own_encoding()
    texts = TEXTS + ["".join(random.Random(i).choices("abc dé\n ", k=300)) for i in range(60)]
    ids, ends = replay_encoder(TIKTOKEN, public_tokenizers.PATTERN).encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[ends[i] : ends[i + 1]].tolist() == library.encode_ordinary(text or ""), text


def test_merge_replay_of_a_vocabulary_whose_merges_uncover_lower_ranks():
    """Concatenations with ranks in any order: the outcome is that of one pair at a time."""
    rng = random.Random(5)
    for _ in range(200):
        tokens = {bytes([b]) for b in range(256)}
        while len(tokens) < 290:
            parts = rng.choices([t for t in tokens if set(t) <= set(b"abc")], k=2)
            if len(parts[0] + parts[1]) <= 5:
                tokens.add(parts[0] + parts[1])
        longer = sorted(t for t in tokens if len(t) > 1)
        rng.shuffle(longer)
        ranks = {bytes([b]): b for b in range(256)} | {t: 256 + i for i, t in enumerate(longer)}
        replay = MergeReplay(ranks)
        words = ["".join(rng.choices("abc", k=rng.randint(0, 14))).encode() for _ in range(30)]
        ids, counts = replay.encode(words)
        ends = np.cumsum(counts)
        got = [ids[e - c : e].tolist() for e, c in zip(ends, counts)]
        assert got == [replay.encode_word(w) for w in words]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 2**16), st.integers(0, 2**64 - 1)), max_size=1500))
def test_simple8b_round_trip(values):
    given_values = np.array(values, np.uint64)
    words, starts = encode_blocks(given_values)
    assert (decode_blocks(words, starts, len(values)) == given_values).all()


@pytest.mark.parametrize("value", [0, 1, 2**60 - 1, 2**60, 2**63, 2**64 - 1])
def test_simple8b_of_long_runs(value):
    values = np.full(5000, value, np.uint64)
    words, starts = encode_blocks(values)
    assert (decode_blocks(words, starts, 5000) == values).all()
    assert len(starts) == 6


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 150), max_size=120), st.integers(1, 30))
def test_packing_places_every_id_once(lengths, max_open):
    packer = SumOfSquaresPacker(32, max_open=max_open)
    for doc, n in enumerate(lengths):
        packer.add_document(doc, np.arange(n, dtype=np.uint32))
    packer.flush()
    pieces = packer.take()
    fills: dict[int, int] = {}
    found: dict[int, dict[int, int]] = {}
    for sequence, offset, (doc, start, length, total, ids) in pieces:
        assert offset == fills.get(sequence, 0) and total == lengths[doc] and len(ids) == length
        fills[sequence] = offset + length
        for i, value in enumerate(ids.tolist()):
            assert found.setdefault(doc, {}).setdefault(start + i, value) == value == start + i
    assert {d: len(f) for d, f in found.items()} == dict(enumerate(lengths))
    if max_open == 30 and len(lengths) < 30:
        assert sum(f < 32 for f in fills.values()) <= 1
    assert all(f <= 32 for f in fills.values())


def test_packing_takes_the_level_with_the_least_sum_of_squares():
    rng = random.Random(1)
    packer = SumOfSquaresPacker(16)
    for _ in range(300):
        size = rng.randint(1, 16)
        before = packer.levels.copy()

        def cost(level):
            after = before.copy()
            if level:
                after[level] -= 1
            if level + size < 16:
                after[level + size] += 1
            return (after[1:16] ** 2).sum()

        choices = [h for h in range(0, 17 - size) if h == 0 or before[h]]
        least = min(map(cost, choices))
        packer.add((0, 0, size, size, np.zeros(size, np.uint32)))
        assert (packer.levels[1:16] ** 2).sum() == least


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library_on_odd_texts(name):
    """Whole texts of odd characters, contractions and runs of white space, with a memory that is often full."""
    parts = ["a", "B", "foo", "'s", "'t", "'", "'LL", "\n", "\n\n", " ", "  ", "\t", "1", "23", "²", "½", "é", "İ", "ı", "ß", "Ÿ", "ǅ", "ɏ", "ɐ", "́", "日", "👍🏽"]
    parts += [".", "!", ",", "#$", "-", "<|endoftext|>", "<|startoftext|>", "<|", " ", "\u0085", "​", " ", "\x00", "\x1c", "\x7f", "\xad", "ª", "_", "ſ", "\r\n", "K"]
    rng = random.Random(5)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    own, library = library_encoder(public_tokenizers.path(name)), Tokenizer.from_file(public_tokenizers.path(name))
    own.kept = 300
    for first in range(0, len(texts), 200):
        part = texts[first : first + 200]
        ids, ends = own.encode(pa.array(part))
        wanted = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == wanted
        assert own.count(pa.array(part)).tolist() == list(map(len, wanted))


def test_pieces_are_looked_up_once_and_forgotten_ones_encoded_again():
    class Known(dict):
        looked_up = 0

        def get(self, *args):
            Known.looked_up += 1
            return super().get(*args)

        def __getitem__(self, key):
            Known.looked_up += 1
            return super().__getitem__(key)

        def __contains__(self, key):
            Known.looked_up += 1
            return super().__contains__(key)

    def encode_pieces(pieces):
        return np.array([ord(c) for p in pieces for c in p], np.uint32), np.array([len(p) for p in pieces], np.int64)

    encode = PieceEncoder(encode_pieces, lambda text: encode_pieces([text])[0], False, kept=4)
    encode.known = Known()
    for text in ("ab c ab def", "ab gh c", "i jk l def m", "", "ab c"):
        ids, ends = encode.encode(pa.array([text, "ab"]))
        assert ids.tolist() == [ord(c) for c in text.replace(" ", "") + "ab"]
        assert ends.tolist() == [0, len(ids) - 2, len(ids)]
        if text == "ab c ab def":
            assert Known.looked_up == 3


def test_blocks_of_every_size_end_with_words_that_are_not_full():
    rng = np.random.default_rng(8)
    for n in (1, 59, 60, 61, 1023, 1024, 1025, 3000):
        for bits in (1, 7, 16, 60, 64):
            values = rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) >> np.uint64(64 - bits)
            for block in (1, 64, 1024):
                words, block_words = encode_blocks(values, block)
                assert len(block_words) == -(-n // block) + 1
                assert np.array_equal(decode_blocks(words, block_words, n, block), values)
