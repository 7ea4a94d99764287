"""Quality rules from word statistics and from how a public vocabulary splits the text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from rideframe.llm.support import filled, ragged_positions, reach_workers, split_lists, split_words, text_slices
from rideframe.session import stage

WINDOW = 5


@dataclass(frozen=True)
class Band:
    """What a text of one language or script may measure.

    ``chars_per_token`` is a range, ``byte_share`` a largest share of byte-fallback tokens.
    The entropy of the text's tokens must reach ``token_bits``, or, where the text is too
    short for that, ``token_evenness`` of the bits that its number of tokens allows.
    """

    chars_per_token: tuple[float, float]
    byte_share: float
    token_bits: float
    token_evenness: float


#: Bands by language code; languages that are not named have the band of their main script.
LANGUAGE_BANDS = {
    "en": Band((1.6, 7.0), 0.10, 4.5, 0.70),
    "de": Band((1.6, 7.0), 0.10, 4.5, 0.70),
    "fr": Band((1.4, 7.0), 0.10, 4.5, 0.70),
    "es": Band((1.4, 7.0), 0.10, 4.5, 0.70),
}
SCRIPT_BANDS = {
    "latin": Band((1.2, 8.0), 0.20, 4.5, 0.70),
    "cyrillic": Band((1.2, 6.0), 0.20, 4.5, 0.70),
    "other": Band((0.3, 6.0), 0.95, 4.0, 0.60),
}

#: What the texts of the next wider kind weigh among those of a cell, and the declared band among those of all
#: kinds, in texts: a cell of few texts follows these, one of many itself, at every size.
WIDER_TEXTS = 50
#: How many distances between the quartiles a text may lie below the median of its cell.
REACH = 2.5
#: Bins of the counted measures, per unit.
BINS = 1000


def _repeated_words(offsets: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Words of each row inside five-word windows that the row holds twice or more."""
    n = len(codes)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    out = np.zeros(len(offsets) - 1, np.int64)
    starts = np.flatnonzero(np.arange(n) + WINDOW <= offsets[1:][rows]) if n else np.zeros(0, np.int64)
    if not len(starts):
        return out
    # Number equal windows step by step: the number of a longer window comes from the exact
    # pair of the shorter one's number and the next word.
    number = rows[starts].astype(np.int64)
    for k in range(WINDOW):
        pair = number * (int(codes.max()) + 1) + codes[starts + k]
        number = np.unique(pair, return_inverse=True)[1]
        twice = np.bincount(number)[number] > 1
        starts, number = starts[twice], number[twice]  # a window whose beginning is unique is unique
        if not len(starts):
            return out
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    covered = np.cumsum(edges[:-1]) > 0
    return np.bincount(rows[covered], minlength=len(out))


def _duplicate_lines(texts: pa.Array) -> np.ndarray:
    """Lines with a word that equal an earlier line of the same text."""
    offsets, coded = split_lists(pc.split_pattern(texts, "\n"))
    worded = pc.match_substring_regex(coded.dictionary, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(texts)), np.diff(offsets))
    kept = worded[codes]
    rows, codes = rows[kept], codes[kept]
    pairs = np.unique(rows * (len(worded) + 1) + codes)
    return np.bincount(rows, minlength=len(texts)) - np.bincount(pairs // (len(worded) + 1), minlength=len(texts))


_MODELS: dict[str, tuple] = {}


def _pieces_of(words: pa.Array, model_path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of each word on its own, their counts, and which ids of the vocabulary are bytes."""
    if model_path not in _MODELS:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        _MODELS[model_path] = model, np.array([model.is_byte(i) for i in range(model.get_piece_size())])
    model, is_byte = _MODELS[model_path]
    found = model.encode(words.to_pylist(), num_threads=1)
    counts = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter((i for ids in found for i in ids), np.int64, int(counts.sum())), counts, is_byte


def measure_texts(texts: pa.Array, model_path: str) -> dict[str, np.ndarray]:
    """The measures of each whole text; ``token_bits`` is the entropy of its tokens in bits."""
    texts = filled(texts)
    offsets, codes, words = split_words(texts)
    n_words = np.diff(offsets)
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    ids, counts, is_byte = _pieces_of(words, model_path)
    starts = np.cumsum(counts) - counts
    rows = np.repeat(np.arange(len(texts)), n_words)
    token = ids[ragged_positions(starts[codes], counts[codes])]
    token_row = np.repeat(rows, counts[codes])
    n_tokens = np.bincount(token_row, minlength=len(texts))
    pairs, uses = np.unique(token_row * len(is_byte) + token, return_counts=True)
    share = uses / n_tokens[pairs // len(is_byte)]
    bits = np.bincount(pairs // len(is_byte), weights=-share * np.log2(share), minlength=len(texts)).astype(float)
    return {
        "n_words": n_words,
        "word_chars": np.bincount(rows, weights=lengths[codes], minlength=len(texts)).astype(np.int64),
        "n_symbols": pc.count_substring_regex(texts, r"[#*$%&|<>]").to_numpy(zero_copy_only=False).astype(np.int64),
        "n_dup_lines": _duplicate_lines(texts),
        "n_repeat_words": _repeated_words(offsets, codes),
        "n_tokens": n_tokens,
        "n_byte_tokens": np.bincount(token_row[is_byte[token]], minlength=len(texts)),
        "token_bits": bits,
    }


def _scripts(texts: pa.Array) -> np.ndarray:
    """The script most letters are of: latin, cyrillic or other."""
    patterns = (r"\p{Latin}", r"\p{Cyrillic}", r"\p{L}")
    latin, cyrillic, letters = (pc.count_substring_regex(texts, p).to_numpy(zero_copy_only=False) for p in patterns)
    other = letters - latin - cyrillic
    return np.where((latin >= cyrillic) & (latin >= other), "latin", np.where(cyrillic >= other, "cyrillic", "other"))


def _kinds(texts: pa.Array, langs: pa.Array) -> list[str]:
    """The language of each text if it has a band, else its main script."""
    kinds = [lang if lang in LANGUAGE_BANDS else None for lang in langs.to_pylist()]
    unnamed = [i for i, kind in enumerate(kinds) if kind is None]
    if unnamed:
        for i, script in zip(unnamed, _scripts(filled(texts).take(pa.array(unnamed)))):
            kinds[i] = str(script)
    return kinds


#: Columns of the measures; ``kind`` is the language or script whose band holds, ``length_class`` the
#: doublings of the number of tokens, on which the measures depend.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "n_byte_tokens")
MEASURES = ", ".join(f"{n} long" for n in COUNTS) + ", token_bits double, kind string, length_class long"


def _measure_columns(texts: pa.Array, langs: pa.Array, model_path: str) -> dict[str, pa.Array]:
    found = measure_texts(texts, model_path)
    length = np.floor(np.log2(np.maximum(1, found["n_tokens"]))).astype(np.int64)
    columns = {n: pa.array(found[n].astype(np.int64)) for n in COUNTS}
    return columns | {"token_bits": pa.array(found["token_bits"]), "kind": pa.array(_kinds(texts, langs), pa.string()), "length_class": pa.array(length)}


def _base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _per_token() -> Column:
    return F.col("word_chars") / F.greatest("n_tokens", F.lit(1))


def _band(kind: str) -> Band:
    return LANGUAGE_BANDS.get(kind) or SCRIPT_BANDS[kind]


def _script(kind: str) -> str:
    return kind if kind in SCRIPT_BANDS else "latin"


#: Uses of each bin.
Counts = dict[int, float]


def _shares(counts: Counts) -> Counts:
    total = sum(counts.values())
    return {b: n / total for b, n in counts.items()}


def _mixed(counts: Counts, wider: Counts) -> Counts:
    """Shares of a cell's bins, the wider cell among them as ``WIDER_TEXTS`` texts."""
    total = sum(counts.values()) + WIDER_TEXTS
    return {b: (counts.get(b, 0) + WIDER_TEXTS * wider.get(b, 0.0)) / total for b in counts.keys() | wider.keys()}


def _least(shares: Counts) -> float:
    """The median less ``REACH`` times the distance of the quartiles, in units of the measure."""
    bins = np.array(sorted(shares))
    below = np.cumsum([shares[b] for b in bins.tolist()])
    low, middle, high = (bins[min(np.searchsorted(below, part - 1e-9), len(bins) - 1)] for part in (0.25, 0.5, 0.75))
    return float(middle - REACH * max(1, high - low)) / BINS


def usual_limits(measured: DataFrame) -> list[tuple]:
    """kind, length_class, least characters per token, least token bits and their trust, from a table of measures.

    All texts that pass the base rule are counted in bins of a thousandth, by kind and class of length, by the
    engine; only these counts come to the driver, as many as there are bins and cells. The
    counts of a language are mixed with those of its script, these with those of all
    texts of the class; ``trust`` is what the result weighs against the declared band.
    """
    texts = measured.filter(~_base_failed())
    measures = F.explode(F.array(F.struct(F.lit(0).alias("measure"), _per_token().alias("value")), F.struct(F.lit(1).alias("measure"), F.col("token_bits").alias("value"))))
    values = texts.select("kind", "length_class", measures.alias("m")).select("kind", "length_class", "m.measure", F.floor(F.col("m.value") * BINS).alias("bin"))
    cells: dict[tuple[str, int], list[Counts]] = {}
    for row in values.groupBy("kind", "length_class", "measure", "bin").count().toArrow().to_pylist():
        for name in {row["kind"], f"script {_script(row['kind'])}", "all"}:
            counts = cells.setdefault((name, row["length_class"]), [{}, {}])[row["measure"]]
            counts[row["bin"]] = counts.get(row["bin"], 0) + row["count"]
    limits = []
    for (kind, length), own in sorted(cells.items()):
        if kind not in LANGUAGE_BANDS and kind not in SCRIPT_BANDS:
            continue
        least = []
        for measure in (0, 1):
            every = cells["all", length][measure]
            shares = _mixed(cells[f"script {_script(kind)}", length][measure], _shares(every))
            if kind in LANGUAGE_BANDS:
                shares = _mixed(own[measure], shares)
            least.append(_least(shares))
        n = sum(cells["all", length][0].values())
        limits.append((kind, length, *least, n / (n + WIDER_TEXTS)))
    return limits


def judged(measured: DataFrame, limits: list[tuple]) -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept`` by the declared bands and the limits of its own texts."""
    names = "chars_low double, chars_high double, byte_share double, bits double, evenness double"
    rows = []
    for kind, length, least_chars, least_bits, trust in limits:
        band = _band(kind)
        rows.append((kind, length, least_chars, least_bits, trust, *band.chars_per_token, band.byte_share, band.token_bits, band.token_evenness))
    table = measured.sparkSession.createDataFrame(rows, f"kind string, length_class long, least_chars double, least_bits double, trust double, {names}")
    tokens = F.greatest("n_tokens", F.lit(1))
    own_bits = F.least("bits", F.col("evenness") * F.log2(tokens))

    def trusted(usual: str, declared: Column) -> Column:
        return F.greatest(declared, F.col("trust") * F.col(usual) + (1 - F.col("trust")) * declared)

    good = (_per_token() >= trusted("least_chars", F.col("chars_low"))) & (_per_token() <= F.col("chars_high"))
    good = good & (F.col("n_byte_tokens") <= F.col("byte_share") * tokens) & (F.col("token_bits") >= trusted("least_bits", own_bits))
    # A row per kind and class of length. A text of a cell without limits has failed the base rule.
    joined = measured.join(F.broadcast(table), ["kind", "length_class"], "left")
    return joined.select(measured["*"], _base_failed().alias("base_failed"), (~_base_failed() & F.coalesce(good, F.lit(False))).alias("kept"))


def judge_quality(docs: DataFrame, model_path: str) -> DataFrame:
    """Measures and verdict of every whole text.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, n_tokens, n_byte_tokens, token_bits. Words are runs of anything but ASCII white
    space; tokens are those of each word on its own. A text fails the base rule with fewer
    than ten words or with more than a fifth of its words in repeated five-word windows;
    ``kept`` also asks for the bands of its language, or of its main script where the language
    is null or has none, and for the ``usual_limits`` of all texts of the table. Texts are measured once: the
    measures are written, counted, and judged by expressions.

    A null text has no words and fails; null and repeated ids stay; further columns are ignored; an empty table
    gives no rows.
    """
    reach_workers(docs.sparkSession)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), **_measure_columns(part.column("text"), part.column("lang"), model_path)})

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    measured = stage(source.mapInArrow(measure, f"doc_id long, {MEASURES}"), "measures")
    names = ("doc_id", *COUNTS[:5], "base_failed", "kept", *COUNTS[5:], "token_bits")
    return judged(measured, usual_limits(measured)).select(*names)


def drop_low_quality(docs: DataFrame, model_path: str) -> DataFrame:
    """The rows of ``docs``, all columns as they are and whatever their names, that the rules keep.

    Null, empty and short texts go, as they fail the base rule; repeated rows stay or go
    together; an empty table stays empty. Rows that pass the base rule are written with their measures, so
    that texts are measured once.
    """
    reach_workers(docs.sparkSession)
    columns = [F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang")]
    source = docs.select(*columns)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            yield pa.RecordBatch.from_pydict({"row": part.column("row"), **_measure_columns(part.column("text"), part.column("lang"), model_path)})

    measured = source.mapInArrow(measure, StructType([source.schema["row"], *StructType.fromDDL(MEASURES)]))
    measured = stage(measured.filter(~_base_failed()), "measured-rows")
    return judged(measured, usual_limits(measured)).filter("kept").select("row.*")
