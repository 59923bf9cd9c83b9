"""What the near-duplicate and repeated-passage stages leave in the shared folder, and which rows they deal out."""

import random

import corpus_pipeline
import pytest
from callgrid.llm import common, neardup, suffix
from pyspark.sql import functions as F

KIND = "doc_id long, text string, n_chars long"


@pytest.fixture()
def docs(spark):
    """60 texts of their own, a near copy of the first, an exact copy of the second, a quoted passage, nulls and blanks."""
    rng = random.Random(3)
    texts = [[f"w{rng.randrange(10**6)}" for _ in range(150)] for _ in range(60)]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    rows += [(100, " ".join([*texts[0][:-2], "new", "end"])), (101, rows[1][1]), (102, " ".join([*texts[10][:60], *(f"q{k}" for k in range(100))]))]
    rows += [(103, None), (104, ""), (None, " ".join(texts[2])), (3, rows[3][1])]
    return spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], KIND)


@pytest.fixture()
def left(tmp_path, monkeypatch):
    """The names of the tables in the shared folder, which is the test's own."""
    monkeypatch.setattr(common, "ensure_checkpoint_dir", lambda spark: str(tmp_path))
    return lambda: sorted(p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir())


def test_stages_leave_one_small_table_each(docs, left):
    kept = neardup.keep_first(docs)
    assert left() == ["near-gone"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted([*range(60), 3, 102, 103, 104])
    cut = suffix.without_repeats(docs)
    assert left() == ["near-gone", "suffix-cuts"]
    rows = {r.doc_id: r for r in cut.collect()}
    assert rows[101].text == "" and rows[101].n_chars == 0 and rows[102].text.split()[0] == "q0" and rows[103].text is None
    assert rows[0].text and rows[None].text == "" and cut.count() == docs.count() and cut.columns == docs.columns


def test_results_outlive_the_tables_they_no_longer_need(docs, left):
    found, spans = neardup.classes(docs), suffix.repeats(docs)
    assert left() == ["near-documents", "near-named", "suffix-documents", "suffix-spans"]
    got = {r.doc_id: r.component_id for r in found.collect()}
    assert got[100] == 0 and got[101] == 1 and got[None] == 2 and got[103] == 103
    assert {r.doc_id for r in spans.where("repeated_words > 0").collect()} == {100, 101, 102, None}


def test_a_failed_block_leaves_no_table(spark, left):
    with pytest.raises(ZeroDivisionError), common.passing("kept"):
        with common.passing("inner"):
            assert common.written(spark.range(3), "inner").count() == 3
            common.written(spark.range(3), "other")
        assert left() == ["inner"]
        assert 1 / 0
    assert left() == []


@pytest.mark.parametrize("most", [common.MOST_BITS, 1])
def test_sifted_parts_the_rows_and_loses_no_key(spark, monkeypatch, most):
    monkeypatch.setattr(common, "MOST_BITS", most)  # with 1: one chunk for all
    rows = spark.range(20_000).select(F.when(F.col("id") % 1000 != 7, F.col("id")).alias("id"), F.concat(F.lit("t"), F.col("id") % 13).alias("t"), F.lit("wide").alias("text"))
    keys = rows.where("id % 40 = 3 OR id IS NULL").select("id", "t").distinct()
    maybe, rest = common.sifted(rows, [F.col("id"), F.col("t")], keys)
    assert maybe.columns == rest.columns == rows.columns
    assert maybe.union(rest).exceptAll(rows).count() == 0 and maybe.count() + rest.count() == 20_000
    same = F.col("id").eqNullSafe(F.col("i")) & (F.col("t") == F.col("u"))
    assert rest.join(keys.toDF("i", "u"), same, "left_semi").count() == 0
    assert rest.count() > 17_000  # few rows without a key are dealt out with those that have one
    maybe, rest = common.sifted(rows, [F.col("id"), F.col("t")], keys.limit(0))
    assert maybe.count() == 0 and rest.count() == 20_000


def test_pipeline_keeps_each_stages_result_alone(spark, docs, left, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "table", lambda spark, sf_dir, name: docs)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [corpus_pipeline.STAGES[1], corpus_pipeline.STAGES[2], ("ids", lambda spark, docs, sf_dir: docs.select("doc_id"))])
    got = corpus_pipeline.run(spark, "")
    assert left() == ["stage0", "stage1"]
    assert got.count() == 64
