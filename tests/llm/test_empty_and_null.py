"""Every registered query of this part on empty tables and on rows of nulls alone."""

import pytest

import __spark_entry__ as entry
from aloft.llm.queries import QUERIES

SCHEMAS = {"documents": "doc_id long, text string, lang string, source string, n_chars long",
           "embeddings": "vec_id long, embedding array<float>, label int",
           "pages": "page_id long, url string, html string",
           "benchmark": "item_id long, text string",
           "labels": "doc_id long, quality int, toxic int",
           "conversations": "conv_id long, turn long, role string, text string"}
#: rows that three rows of nulls give: no vector and no benchmark item takes part; empty texts are near
#: copies of each other, of which one stays; the rows are one conversation, and one group without another
FROM_NULLS = {"op5": 0, "op10": 0, "pipeline": 1, "op12": 1, "op13": 0}


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    out = {}
    for rows in (0, 3):
        out[rows] = str(tmp_path_factory.mktemp(f"rows{rows}"))
        for name, schema in SCHEMAS.items():
            row = tuple([None] * len(schema.split(", ")))
            spark.createDataFrame([row] * rows, schema).write.parquet(f"{out[rows]}/{name}.parquet")
    return out


@pytest.mark.parametrize("name", sorted([*QUERIES, "pipeline"]))
def test_empty_and_null(spark, folders, name):
    for rows, folder in folders.items():
        got = entry.queries()[name](spark, folder)
        assert got.count() == (FROM_NULLS.get(name.split("_")[0], rows) if rows else 0)
