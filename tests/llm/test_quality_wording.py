"""Quality that lies in the words alone, in texts of one shape."""

import random

import numpy as np
import pytest

from rollcall.llm import quality_knn
from rollcall.llm.common import prepare


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrst", "".join(map(chr, range(0x4E00, 0x4F00)))])
def test_wording_separates_texts_of_one_shape(spark, letters):
    prepare(spark)
    rng = random.Random(4)
    vocabularies = [["".join(rng.choices(letters, k=5)) for _ in range(150)] for _ in range(2)]
    rows = [(i, " ".join(rng.choices(vocabularies[i % 2], k=60)), i % 2) for i in range(240)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality_knn.fit_documents(frame.select("doc_id", "text"), frame.select("doc_id", "quality"))
    got = quality_knn.classify(frame, model).filter("held_out").collect()
    assert len(got) > 40
    assert all(r["predicted"] == r["doc_id"] % 2 for r in got)


def test_axes_are_the_leading_singular_vectors():
    rng = np.random.default_rng(3)
    factors = rng.standard_normal((40, 3)) * (9, 5, 3)
    dense = factors @ rng.standard_normal((3, 60)) + 0.01 * rng.standard_normal((40, 60))
    places = np.sort(rng.choice(quality_knn.TERMS, 60, replace=False)).astype(np.uint16)
    axes = quality_knn.decompose([(places, row.astype(np.float32)) for row in dense], 3)
    true = np.linalg.svd(dense - dense.mean(axis=0))[2][:3]
    assert np.allclose(abs(true @ axes[places]), np.eye(3), atol=1e-2)
