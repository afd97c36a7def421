import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from saleslayers.llm import tokens
from saleslayers.llm.catalog import QUERIES
from saleslayers.llm.common import table


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = table(spark, sf_dir, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, sf_dir).cache()
        out.append((name, docs, result))
        docs = result
    return out


def test_stages_keep_the_columns_of_documents(spark, sf_dir, stages):
    columns = table(spark, sf_dir, "documents").columns
    assert [name for name, _, _ in stages] == ["quality_rules", "near_duplicates", "decontamination", "pii", "packing"]
    assert all(result.columns == columns for _, _, result in stages[:-1])
    counts = [result.count() for _, _, result in stages[:-1]]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0


def test_each_stage_leaves_nothing_for_itself(spark, sf_dir, stages):
    """Each stage's output, given to it again, comes back as it is."""
    for (name, stage), (_, _, result) in list(zip(corpus_pipeline.STAGES, stages))[:-1]:
        again = stage(spark, result, sf_dir)
        assert again.exceptAll(result).count() == 0 and again.count() == result.count(), name


def test_packed_pieces_are_the_ids_of_the_texts(spark, stages):
    _, docs, packed = stages[-1]
    tokenizer = Tokenizer.from_file(tokens.default_tokenizer())
    want = {r.doc_id: np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4") for r in docs.collect()}
    seen = {}
    for r in packed.collect():
        assert zlib.crc32(want[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
        seen[r.doc_id] = seen.get(r.doc_id, 0) + r.length
    assert seen == {i: len(x) for i, x in want.items()}


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    assert corpus_pipeline.run(spark, sf_dir).count() == stages[-1][2].count()


def test_stages_take_odd_rows_and_clashing_columns(spark, sf_dir):
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, text + " more"), (4, text + " and mail me@x.org")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit(None).cast("string"), "source": F.lit("s"), "n_chars": F.length("text").cast("long"), "kept": F.lit(1), "component_id": F.lit(2), "_gone": F.lit(3), "terms": F.lit(4)}
    )
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, frame, sf_dir).columns == docs.columns, name
            stage(spark, frame, sf_dir).count()
        corpus_pipeline.STAGES[-1][1](spark, frame, sf_dir).count()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("op13")])  # op13's rows are triples of its table's
def test_query_has_a_row_per_row_of_its_table(spark, sf_dir, name):
    rows = QUERIES[name].run(spark, sf_dir)
    key = "page_id" if name.startswith("op9") else "doc_id"
    source = table(spark, sf_dir, "pages" if key == "page_id" else "documents")
    assert rows.select(key).distinct().count() == source.select(key).distinct().count()
    assert name.startswith("op7") or rows.count() == source.count()


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_same_result_as_sql(spark, sf_dir, name):
    from oracle_check import compare, duck

    assert compare(spark, duck(sf_dir), sf_dir, QUERIES[name]) == []
