"""The vector index against the full scan: recall of the approximate search, rows of the exact one, cells read, batches, unusable rows."""

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import search as S
from tidewatch.operators.vector_index import VectorIndex


@pytest.fixture(scope="module")
def indexed(spark, sf_dir, tmp_path_factory):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    index = VectorIndex(spark, str(tmp_path_factory.mktemp("vectors")), cells=16)
    index.add(vectors.filter("vec_id % 3 > 0"), "vec_id", "embedding")
    index.add(vectors.filter("vec_id % 3 = 0"), "vec_id", "embedding")
    return index, vectors


def _wanted(vectors, vec_id):
    return [(r.vec_id, r.cosine) for r in S.vector_topk(vectors, vectors.filter(F.col("vec_id") == vec_id), 10).collect()]


def test_recall_and_exact_rows(indexed):
    index, vectors = indexed
    hits = total = read = 0
    for r in vectors.filter("vec_id % 50 = 7").collect():
        want = _wanted(vectors, r.vec_id)
        exact = index.search_exactly(r.embedding)
        assert [tuple(x) for x in exact.rows.collect()] == want and exact.read <= exact.cells
        near = index.search(r.embedding)
        hits += len({x.id for x in near.rows.collect()} & {i for i, _ in want})
        total, read = total + 10, read + near.read
    assert hits / total >= 0.95 and read < total / 10 * 16


def test_every_usable_row_is_indexed_once(indexed):
    index, vectors = indexed
    parts = index.manifest.read()[1]
    rows = index._table(parts, "rows")
    assert len(parts) == 2 and rows.count() == rows.select("id").distinct().count() == vectors.count()


def test_far_cells_are_skipped_by_the_exact_search(spark, tmp_path):
    """Vectors in a few tight bundles: the bundle of the query decides."""
    axes = [(i, [10.0 if j == i % 8 else 0.01 * ((i * 7 + j) % 5) for j in range(8)]) for i in range(400)]
    odd = [(1000, None), (1001, []), (1002, [0.0] * 8), (1003, [float("nan")] * 8), (1004, [1.0, 2.0]), (1005, [None] + [1.0] * 7)]
    index = VectorIndex(spark, str(tmp_path), cells=8)
    index.add(spark.createDataFrame(odd[:4], "id int, v array<double>"), "id", "v")
    assert index.manifest.version() == 0
    index.add(spark.createDataFrame(axes + odd, "id int, v array<double>"), "id", "v")
    found = index.search_exactly(axes[3][1], k=5, probe=1)
    assert all(r.id % 8 == 3 for r in found.rows.collect()) and found.read < found.cells
    with pytest.raises(ValueError):
        index.search([0.0] * 8)
