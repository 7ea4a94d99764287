"""Bounds that must hold whatever the input: open windows, samples."""

import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from rideframe.llm import chosen_path, links, toxicity
from rideframe.llm.encoding import append_id
from rideframe.llm.packing import SumOfSquaresPacker, pack_documents
from rideframe.llm.queries import QUERIES
from rideframe.session import stage
from tests.llm.data import SF_DIR
from tests.llm.test_operators import BYTE_BPE


@pytest.mark.parametrize("max_open", [1, 2, 7, 4096])
def test_full_packer_cuts_but_never_leaves_room(max_open):
    rng = np.random.default_rng(1)
    packer, docs = SumOfSquaresPacker(64, max_open=max_open), {}
    for doc in range(900):
        docs[doc] = rng.integers(0, 1000, rng.integers(1, 160)).astype(np.uint32)
        packer.add_document(doc, docs[doc])
        assert packer.n_open <= max_open
    packer.flush()
    windows, pieces = {}, {}
    for sequence, offset, (doc, start, length, total, ids) in packer.take():
        windows.setdefault(sequence, []).append((offset, length))
        pieces.setdefault(doc, []).append((start, ids))
        assert total == len(docs[doc]) and length == len(ids)
    for doc, ids in docs.items():
        assert np.concatenate([p for _, p in sorted(pieces[doc], key=lambda p: p[0])]).tolist() == ids.tolist()
    sizes = []
    for held in windows.values():
        held.sort()
        assert [o for o, _ in held] == [0, *np.cumsum([n for _, n in held])[:-1].tolist()]
        sizes.append(sum(n for _, n in held))
    assert sorted(sizes)[1:] == [64] * (len(sizes) - 1)


def test_packing_with_few_open_windows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").coalesce(1)
    few, many = (pack_documents(docs, BYTE_BPE, max_open=n).groupBy("sequence_id").sum("length").collect() for n in (2, 4096))
    assert len(few) == len(many) and sum(r[1] < 2048 for r in few) <= 1


def test_sample_is_bounded_by_rows_and_bytes(spark, monkeypatch):
    docs = spark.createDataFrame([(i % 40, f"text number {i} of some words") for i in range(3000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    sizes = []
    monkeypatch.setattr(toxicity, "fit", lambda features, labels, settings: sizes.append((len(features), len(labels), sum(6 * len(b) for b, _ in features))))
    toxicity.train_toxicity(docs, labels, rows_per_class=2)
    toxicity.train_toxicity(docs, labels, sample_bytes=1500)
    assert sizes[0][:2] == (4, 4) and 1 < sizes[1][0] < 25 and sizes[1][2] <= 1500


def plain_scores(model, texts):
    """The score of each text by its own n-grams, one at a time."""
    settings = model.settings
    weights = model.gram_weights().astype(float)
    out = []
    for text in texts:
        words = [w for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        total = 0.0
        for word in words:
            marked = f"<{pa.compute.utf8_lower(pa.scalar(word)).as_py()}>"
            grams = []
            for n in range(settings.shortest, settings.longest + 1):
                for i in range(len(marked) - n + 1):
                    value = 0
                    for c in marked[i : i + n]:
                        value = (value * 1_000_003 + ord(c)) % 2**64
                    grams.append(((value + n) * 0x9E3779B97F4A7C15) % 2**64 >> (64 - settings.bucket_bits))
            total += sum(weights[g] for g in grams) / max(1, len(grams))
        logit = total / max(1, len(words)) + float(model.bias[1] - model.bias[0])
        out.append(1 / (1 + np.exp(-np.clip(logit, -60, 60))))
    return out


def test_toxicity_query_against_a_plain_scorer(spark):


    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op8_toxicity"](spark, folder).collect()}
    texts = duckdb.sql(f"select doc_id, text from '{folder}/documents.parquet' order by doc_id").fetchall()
    assert sorted(got) == [i for i, _ in texts]
    model = toxicity.train_toxicity(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    few = texts[::12]
    for (doc, _), score in zip(few, plain_scores(model, [t for _, t in few])):
        assert abs(got[doc].score - score) < 1e-6
    for doc, row in got.items():
        assert row.held_out == (zlib.crc32(str(doc).encode()) % 3 == 1) and row.predicted == int(row.score >= 0.7)


def test_open_windows_hold_no_ids_but_their_own():
    packer = SumOfSquaresPacker(64)
    for doc in range(50):
        ids = np.arange(100_000, dtype=np.uint32)
        packer.add_document(doc, ids[: 64 + 1 + doc % 20])  # a window and a rest, of a large array of ids
    waiting = [piece for pieces in packer.open.values() for window in pieces for piece in window]
    assert waiting
    assert all(piece[4].base is None and len(piece[4]) == piece[2] for piece in waiting)


def test_appended_ids_follow_each_text():
    ids, ends = append_id(np.array([5, 6, 7], np.uint32), np.array([0, 2, 2, 3]), 1)
    assert ids.tolist() == [5, 6, 1, 1, 7, 1]
    assert ends.tolist() == [0, 3, 4, 6]


def test_children_of_a_set_are_distinct(spark):
    rows = spark.range(4000).select(F.xxhash64("id").alias("path"), F.array(*[F.lit(k) for k in range(chosen_path.COORDINATES)]).alias("sketch"))
    children = rows.select(chosen_path._children(F.col("path"), F.col("sketch"), 0.5).alias("c")).persist()
    assert children.filter(F.size("c") != F.size(F.array_distinct("c"))).isEmpty()
    assert children.filter(F.size("c") == 2).count() > 3000


def test_components_of_stars_take_one_round(spark, monkeypatch):
    names = []
    monkeypatch.setattr(links, "stage", lambda df, name: names.append(name) or stage(df, name))
    edges = [(1, 5), (5, 1), (1, 6), (1, 6), (2, 7)]
    found = links.connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == [(1, 1), (2, 2), (5, 1), (6, 1), (7, 2)]
    assert len(names) <= 3
    names.clear()
    chain = [(i, i + 1) for i in range(40)]
    found = links.connected_components(spark.createDataFrame(chain, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == [(i, 0) for i in range(41)]


def test_texts_of_dense_buckets_are_looked_up_once_without_a_shuffle_of_all(spark, monkeypatch):
    names, joins = [], []

    def spy(df, name):
        names.append(name)
        if name == "dense-sets":
            joins.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stage(df, name)

    monkeypatch.setattr(chosen_path, "stage", spy)
    monkeypatch.setattr(chosen_path, "BUCKET", 8)
    words = [f"w{i}" for i in range(60)]
    docs = [(100 * g + i, " ".join([f"g{g}", *words, f"e{i}", f"e{i % 3}"])) for g in range(3) for i in range(40)]
    found = chosen_path.similar_documents(spark.createDataFrame(docs, "doc_id long, text string"), 0.8)
    assert {r["group_id"] for r in found.collect()} == {0}
    assert names.count("dense-sets") == 1 and names.count("differences") >= 1
    assert "strategy=broadcast" in joins[0] and re.search(r"Join LeftSemi.*broadcast", joins[0])
