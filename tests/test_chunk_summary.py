"""The summary of a chunked scan is computed once."""

from colloquia.operators.order import chunked_scan


def test_summary_of_chunks_scans_the_rows_once(spark, tmp_path):
    spark.range(100).selectExpr("'f' AS g", "id div 3 AS c", "id AS p").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    out = chunked_scan(rows, ["g"], "c", "p", index_col="i", chunk_block=4)
    assert all(r["i"] == r["p"] for r in out.collect())
    assert out._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[-1].count("/rows]") <= 1
