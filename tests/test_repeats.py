"""Queries on pages that share an address, and on titles cut off within a reference, give what their SQL gives."""

import duckdb
import pytest

from evidentia.plans import captured, corpus, ingest

from .test_queries import rows_of

PAGES = [(3, "https://a.org/x", "<title>a &amp;&amp</title>"), (6, "https://a.org/x", "<title>b&quo</title>"), (7, "https://a.org/x", "<title>&lt;c&gt</title>"), (8, "https://b.org/y", "<title>d &amp;lt; &quot;e&quot;</title>"), (9, "https://a.org/x", "<title>&ampx;</title>"), (10, "https://a.org/x", "<p>none")]


@pytest.mark.parametrize("name, module", [("capture_index", ingest), ("work_list_file", ingest), ("page_title", corpus), ("head_lines", captured)])
def test_shared_addresses_and_cut_references(name, module, spark, tmp_path):
    spark.createDataFrame(PAGES, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    duck = duckdb.connect()
    duck.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    want = duck.execute(module.ORACLES[name])
    names = [d[0] for d in want.description]
    got = module.QUERIES[name](spark, str(tmp_path))
    assert sorted(got.columns) == sorted(names)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(names, want.fetchall())
