"""Every query and stage on empty tables, and on tables of nulls."""

import pytest

import __spark_entry__ as entry

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
NAMES = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]


@pytest.fixture(scope="module", params=[0, 3], ids=["empty", "nulls"])
def tables(spark, tmp_path_factory, request):
    root = tmp_path_factory.mktemp("tables")
    for name, schema in SCHEMAS.items():
        row = (None,) * (schema.count(",") + 1)
        spark.createDataFrame([row] * request.param, schema).write.parquet(str(root / f"{name}.parquet"))
    return str(root), request.param


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, tables, name):
    root, rows = tables
    out = entry.queries()[name](spark, root).collect()
    n = int(name[2:].split("_")[0]) if name != "pipeline" else 0
    want = {0: None, 5: 0, 9: 1 + (rows > 0), 13: 0}.get(n, rows)
    assert want is None or len(out) == want
