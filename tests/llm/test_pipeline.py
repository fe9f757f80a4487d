"""The corpus pipeline against its stages done by plain code, and the statements of its operators."""

import os
from collections import Counter

import pytest

import corpus_pipeline
from oracle.check import compare, connect
from test_mixing import expected as mixed
from test_near_dedup import brute as near
from test_repetition import brute as rules
from tripledger.llm.catalog import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@here
def test_pipeline_equals_plain_code(spark):
    spm = pytest.importorskip("sentencepiece")
    from tripledger.llm.sources import tokenizer

    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(
        f"{SF_DIR}/documents.parquet").collect()]
    clean = [r for r in rows if rules(r[1])[-1]]
    last = {t: i for i, t, _ in sorted(clean)}
    unique = [r for r in clean if last[r[1]] == r[0]]
    first = {i for i, _, name in near([r[:2] for r in unique]) if i == name}
    chosen = mixed([r for r in unique if r[0] in first])
    library = spm.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    want = Counter()
    for (i, text, _), n in chosen.items():
        want[(i, tuple(library.encode(text) + [2]))] += n
    got = corpus_pipeline.run(spark, SF_DIR)
    assert Counter((r.doc_id, tuple(r.ids)) for r in got.collect()) == want


def test_stages_keep_the_columns_and_bear_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, "
                                     "n_chars long, extra int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.dtypes == docs.dtypes and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 0


@here
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_statement(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE_SQL[name]) == ""
