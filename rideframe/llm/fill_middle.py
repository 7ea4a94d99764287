"""Fill-in-middle forms of texts, cut by a sparse index of multibyte characters."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from rideframe.llm.support import filled, reach_workers, text_slices

PLAIN, PSM, SPM = "plain", "psm", "spm"
UNITS = ("line", "char")
LINE_END = 0x0A


@dataclass(frozen=True)
class Markers:
    """What stands before the prefix, the suffix and the middle.

    No marker may hold another or end as another, or itself, begins: then a text without markers
    cannot make up one together with a marker beside it, and each is found where it was put.
    """

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        if len(set(self.all)) < 3 or not all(self.all):
            raise ValueError("three different markers are needed")
        for a in self.all:
            for b in self.all:
                if a != b and a in b or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)))):
                    raise ValueError(f"marker {a!r} overlaps {b!r}")

    @property
    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


MARKERS = Markers()


class ExceptionIndex:
    """Code-point and byte positions of a block of UTF-8, from its multibyte characters alone.

    Only these are recorded: where each begins and how many bytes it has beyond one. Between two
    of them a byte is a character, so a position differs by the excess of those before it,
    which a binary search finds; a block of ASCII has an empty index.
    """

    def __init__(self, data: np.ndarray):
        self.byte_at = np.flatnonzero(data >= 0xC0)
        lead = data[self.byte_at]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate([[0], np.cumsum(excess)])
        self.char_at = self.byte_at - self.excess[:-1]

    def chars(self, byte: np.ndarray) -> np.ndarray:
        """Characters before each byte position, which must not lie within one."""
        return byte - self.excess[np.searchsorted(self.byte_at, byte)]

    def bytes(self, char: np.ndarray) -> np.ndarray:
        """Where each character begins."""
        return char + self.excess[np.searchsorted(self.char_at, char)]


class UnitCuts:
    """Number of units of each text of a block, and the byte position after so many of them."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, index: ExceptionIndex, unit: str):
        self.first, self.last, self.index, self.unit = ends[:-1], ends[1:], index, unit
        if unit == "line":
            self.breaks = np.flatnonzero(data == LINE_END)
            self.before = np.searchsorted(self.breaks, self.first)
            self.whole = np.searchsorted(self.breaks, self.last) - self.before
            full = np.flatnonzero(self.last > self.first)
            rest = np.zeros(len(self.first), np.int64)
            rest[full] = data[self.last[full] - 1] != LINE_END
            self.count = self.whole + rest
        else:
            self.before = index.chars(self.first)
            self.count = index.chars(self.last) - self.before

    def after(self, units: np.ndarray) -> np.ndarray:
        if self.unit == "char":
            return self.index.bytes(self.before + units)
        place = self.before + np.minimum(units, self.whole) - 1
        ended = self.breaks[np.maximum(place, 0)] + 1 if len(self.breaks) else np.zeros(len(units), np.int64)
        return np.where(units == 0, self.first, np.where(units > self.whole, self.last, ended))


def _block(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array, and where each text begins, with the end."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def _draws(doc_ids: list[int | None], seed: int) -> np.ndarray:
    """Four numbers per document: the first 32-bit groups of the SHA-256 of seed and id."""
    digests = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in doc_ids)
    return np.frombuffer(digests, ">u4").astype(np.int64).reshape(-1, 4).T


def transform_texts(doc_ids: list[int | None], texts: pa.Array, seed: int, unit: str, rate: int, spm: int, markers: Markers) -> dict[str, pa.Array]:
    """The columns of ``fill_in_middle`` but the id, for whole texts without nulls."""
    data, ends = _block(texts)
    index = ExceptionIndex(data)
    cuts = UnitCuts(data, ends, index, unit)
    first, second, kind, order = _draws(doc_ids, seed)
    low, high = (f(first % (cuts.count + 1), second % (cuts.count + 1)) for f in (np.minimum, np.maximum))
    a, b = cuts.after(low), cuts.after(high)
    marked = np.zeros(len(texts), bool)
    for marker in markers.all:
        marked |= pc.match_substring(texts, marker).to_numpy(zero_copy_only=False)
    plain = (ends[1:] == ends[:-1]) | marked | (kind % 100 >= rate)
    suffix_first = order % 100 < spm
    raw = data.tobytes()
    tag_p, tag_s, tag_m = (m.encode() for m in markers.all)
    output = []
    for p, m, start, end, as_is, spm_form in zip(a.tolist(), b.tolist(), ends[:-1].tolist(), ends[1:].tolist(), plain.tolist(), suffix_first.tolist()):
        if as_is:
            output.append(raw[start:end])
        elif spm_form:
            output.append(b"".join((tag_s, raw[m:end], tag_p, raw[start:p], tag_m, raw[p:m])))
        else:
            output.append(b"".join((tag_p, raw[start:p], tag_s, raw[m:end], tag_m, raw[p:m])))
    at_start, at_a, at_b = (index.chars(x) for x in (ends[:-1], a, b))

    def cut_column(values: np.ndarray) -> pa.Array:
        return pa.array(values, pa.int64(), mask=plain)

    return {
        "n": pa.array(cuts.count, pa.int64()),
        "form": pa.array(np.where(plain, PLAIN, np.where(suffix_first, SPM, PSM)).tolist(), pa.string()),
        "prefix_chars": cut_column(at_a - at_start),
        "middle_chars": cut_column(at_b - at_a),
        "prefix_bytes": cut_column(a - ends[:-1]),
        "middle_bytes": cut_column(b - a),
        "output": pa.array(output, pa.binary()).cast(pa.string()),
    }


SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, prefix_bytes long, middle_bytes long, output string"


def fill_in_middle(docs: DataFrame, seed: int = 7, unit: str = "line", rate: int = 100, spm: int = 50, markers: Markers = MARKERS) -> DataFrame:
    """Move a middle part of every whole text to its end.

    Returns doc_id, n (units of the text), form, prefix_chars, middle_chars (code points),
    prefix_bytes, middle_bytes and output for every row. Units are lines with their line feed,
    or single code points (``unit="char"``). The numbers that choose the two cuts and the form
    are those of the SHA-256 of seed and id, so a document gives the same output wherever and
    whenever it is worked on. ``rate`` percent of the documents are transformed and ``spm``
    percent of these have their suffix first. An empty text and one that holds a marker are
    plain: output is the text, the four lengths are null. ``restore_text`` undoes it.

    A null text is empty. A null id counts as an empty one; repeated rows give repeated rows;
    further columns are ignored; an empty table gives no rows. Nothing is shuffled.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    reach_workers(docs.sparkSession)

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            found = transform_texts(part.column("doc_id").to_pylist(), filled(part.column("text")), seed, unit, rate, spm, markers)
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), **found})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(transform, SCHEMA)


def restore_text(output: Column, form: Column, markers: Markers = MARKERS) -> Column:
    """The text that an output was made from, as it was, from output and form alone."""
    p, s, m = markers.all
    middle, rest = F.substring_index(output, m, -1), F.substring_index(output, m, 1)
    psm = F.concat(F.substring_index(F.substring_index(rest, s, 1), p, -1), middle, F.substring_index(rest, s, -1))
    spm = F.concat(F.substring_index(rest, p, -1), middle, F.substring_index(F.substring_index(rest, p, 1), s, -1))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
