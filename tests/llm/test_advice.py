"""Tests of the second round's findings."""

import numpy as np
import pyarrow as pa

from rideframe.llm import toxicity
from rideframe.llm.queries import QUERIES


def test_toxicity_sample_has_its_whole_size():
    assert toxicity.ROWS_PER_CLASS == 4000


def test_toxicity_learns_an_insult_of_six_documents():
    plain = "the river rose after rain and the mill stood still until the winter had gone".split()
    texts = [" ".join(np.roll(plain, i)) + (" stupidest" if i % 10 == 0 else "") for i in range(60)]
    labels = np.array([int(i % 10 == 0) for i in range(60)])
    settings = toxicity.Settings()
    model = toxicity.fit(toxicity.document_features(pa.array(texts), settings), labels, settings)
    bias = float(model.bias[1] - model.bias[0])
    asked = pa.array([" ".join(plain) + " stupidest", " ".join(plain) + " gardens"])
    insult, other = toxicity.score_texts(asked, model.gram_weights(), bias, settings)
    assert insult >= 0.7 > 0.5 > other


def test_quality_limits_follow_the_table(spark):
    """Most texts labelled good stay, and many labelled bad go that the declared bands keep."""
    folder = "/root/testdata/sf0.01"
    judged = QUERIES["op2_fertility"](spark, folder).filter("not base_failed")
    rows = judged.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").select("quality", "kept").collect()
    bad, good = ([r.kept for r in rows if r.quality == kind] for kind in (0, 1))
    assert bad.count(False) >= 10
    assert good.count(False) <= 0.01 * len(good)
