from __future__ import annotations

import os
import sys

from cardpanel.llm.queries import QUERIES, SQL
from cardpanel.llm.tables import BATCH_BYTES, read

from .test_decontaminate import brute as contamination
from .test_near_dedup import brute as groups
from .test_sanitise import brute as personal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_every_stage_against_brute_force(spark):
    """Each stage on its own input."""
    docs, columns = read(spark, SF, "documents"), read(spark, SF, "documents").columns
    inputs = {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs.collect()
        docs = stage(spark, docs, SF).cache()
        if name != "source_mix":
            assert docs.columns == columns
    rows = {k: {r.doc_id: r for r in v} for k, v in inputs.items()}
    kept = groups([(r.doc_id, r.text) for r in inputs["near_duplicates"]], 5)
    assert set(rows["benchmark_passages"]) == {i for i, (_, c) in kept.items() if c == i}
    items = [(r.item_id, r.text) for r in read(spark, SF, "benchmark").collect()]
    clean = {i for i, r in rows["benchmark_passages"].items() if not contamination(r.text, items)[4]}
    assert set(rows["personal_data"]) == clean == set(rows["source_mix"])
    for i, r in rows["source_mix"].items():
        before = rows["personal_data"][i].text
        assert (r.text == before) == (not personal(before)) and r.n_chars == len(r.text)
        assert not [s for s in personal(r.text) if s[1] == 0]
    assert {r.doc_id for r in docs.collect()} == clean


def test_stages_on_odd_and_empty_tables_with_clashing_names(spark):
    """Every stage on nulls, repeats, long texts, no rows; columns named like any working column."""
    from .odd import odd_documents

    names = ["_llm_row", "_llm_words", "_llm_hits", "_llm_items", "_llm_spans", "_llm_n_words", "_row", "_others", "row", "rule", "spans", "base_failed"]
    odd = odd_documents(spark)
    odd = odd.withColumns({n: corpus_pipeline.F.lit(i) for i, n in enumerate(names)})
    for docs in (odd, odd.limit(0)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            rows = out.collect()
            assert len(rows) <= n
            if name != "source_mix":
                assert out.columns == docs.columns
                assert all(r[c] == i for r in rows for i, c in enumerate(names) if c != "row"), name
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, odd, SF).collect()} == {1, 4, 5, 6, 7, 8, 9, 10}


def test_run_returns_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"] and got.count() > 50


def test_texts_go_to_python_in_small_batches(spark):
    """A batch of many or long texts is bounded by its bytes, whatever stage comes first."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a word "), 300).alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes]), pa.array([b.num_rows])], ["bytes", "rows"])

    for _, stage in corpus_pipeline.STAGES:
        spark.conf.unset(key)
        stage(spark, read(spark, SF, "documents"), SF)
        got = docs.mapInArrow(sizes, "bytes long, rows long").collect()
        assert sum(r.rows for r in got) == 4000 and max(r.bytes for r in got) < 2 * BATCH_BYTES
    spark.conf.set(key, "1000")
    corpus_pipeline.quality_rules(spark, read(spark, SF, "documents"), SF)
    assert spark.conf.get(key).removesuffix("b") == "1000"
    spark.conf.unset(key)


def test_texts_are_read_in_small_batches(spark, tmp_path):
    """The Parquet reader's buffers stay small, whatever stage comes first; all rows are read."""
    from pyspark.sql import functions as F

    key = "spark.sql.parquet.columnarReaderBatchSize"
    spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.col("id").cast("string"), 50).alias("text")).write.parquet(f"{tmp_path}/t")
    for _, stage in corpus_pipeline.STAGES:
        spark.conf.unset(key)
        stage(spark, read(spark, SF, "documents"), SF)
        assert int(spark.conf.get(key)) <= 256
        rows = spark.read.parquet(f"{tmp_path}/t").collect()
        assert sorted(r.doc_id for r in rows) == list(range(3000)) and all(r.text == str(r.doc_id) * 50 for r in rows)
    spark.conf.set(key, "100")
    corpus_pipeline.quality_rules(spark, read(spark, SF, "documents"), SF)
    assert spark.conf.get(key) == "100"
    spark.conf.unset(key)


def test_queries_equal_sql(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, text in SQL.items():
        want, got = con.sql(text).to_arrow_table(), QUERIES[name](spark, SF).toArrow()
        cols = sorted(want.column_names)
        assert cols == sorted(got.column_names)
        a, b = (sorted(map(str, zip(*[t.column(c).to_pylist() for c in cols]))) for t in (want, got))
        assert a == b, name


def test_all_registered():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
