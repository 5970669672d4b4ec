"""Few queries scored by products of matrices, against the pruned route."""

import pytest
from pyspark.sql import functions as F

from replyscope.operators import retrieval, tiles
from replyscope.operators.index import index_build

WORDS = "order parcel refund late blue chair broken lamp invoice account locked reset mail charged twice".split()


@pytest.fixture(scope="module")
def index(spark):
    rows = [(f"d{i:03}", " ".join(WORDS[(i * j + j) % len(WORDS)] for j in range(1, 3 + i % 9))) for i in range(300)]
    return index_build(spark.createDataFrame(rows + [("copy", rows[0][1]), ("other", "nothing shared here")], "doc_id string, text string"))


@pytest.fixture(scope="module")
def queries(spark):
    rows = [(0, "late blue chair"), (1, "order order refund"), (2, "unknown words only"), (3, ""), (4, None), (5, "parcel late blue chair"), (6, "here")]
    return spark.createDataFrame(rows, "query_id long, query_text string")


def _rows(df):
    fields = ["query_id", "rank", "doc_id", *[F.round(c, 6).alias(c) for c in ("score", "bm25", "dense", "low", "high")]]
    return sorted(map(tuple, df.select(*fields).collect()))


@pytest.mark.parametrize("alpha", [0.0, 0.7, 1.0])
def test_tiles_give_the_result_of_the_pruned_route(index, queries, alpha, monkeypatch):
    by_tiles = _rows(retrieval.ranked_docs(queries, index, alpha, 10))
    pruned_first = _rows(retrieval.ranked_docs(queries, index, alpha, 10, hot_texts=5))
    monkeypatch.setattr(tiles, "MOST_CELLS", 0)
    assert _rows(retrieval.ranked_docs(queries, index, alpha, 10)) == by_tiles == pruned_first
    assert by_tiles


def test_few_queries_join_no_query_with_every_text(index, queries, monkeypatch):
    monkeypatch.setattr(retrieval, "_read_sums", lambda *_: pytest.fail("postings joined with queries"))
    assert _rows(retrieval.ranked_docs(queries, index, 1.0, 10))


def test_tiles_of_some_rows_only(index, queries, monkeypatch):
    whole = _rows(retrieval.ranked_docs(queries, index, 0.7, 3))
    monkeypatch.setattr(tiles, "TILE", 7)
    assert _rows(retrieval.ranked_docs(queries, index, 0.7, 3)) == whole
