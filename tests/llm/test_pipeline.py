"""Every stage of the pipeline against a brute-force version of its own input."""

from collections import Counter

import corpus_pipeline
from test_jaccard_join import brute as near
from test_line_dedup import brute as lines
from test_pii import plain
from test_tokens import check_packing

from stayline.llm import pii


def test_stages(spark, sf_dir, docs, tmp_path):
    frames = [docs]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], sf_dir).write.parquet(str(tmp_path / name))
        frames.append(spark.read.parquet(str(tmp_path / name)))
        if k < 4:
            assert frames[-1].columns == docs.columns and frames[-1].dtypes == docs.dtypes
    rows = [[(r.doc_id, r.text) for r in f.select("doc_id", "text").collect()] for f in frames[:-1]]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    # clean documents stay
    assert {d for d, _ in rows[0] if labels.get(d) == 0} - {d for d, _ in rows[1]} == set()
    assert set(rows[1]) <= set(rows[0])
    assert Counter(rows[2]) == Counter((d, t) for d, t, _, _ in lines(rows[1]))
    groups = {r[3] for r in near(rows[2])}
    assert sorted(d for d, _ in rows[3]) == sorted(groups) and set(rows[3]) <= set(rows[2])
    assert len(rows[4]) == len(rows[3])
    after = dict(rows[4])
    for doc, text in rows[3]:
        if not plain(text):
            assert pii.loose_spans(text, []) or after[doc] == text
        else:
            assert after[doc] != text and not any(text[s:e] in after[doc] for s, _, e in plain(text))
    made, least = check_packing(frames[5].collect(), rows[4])
    assert made <= least + 1


def test_run_is_the_stages(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0 and corpus_pipeline.ORACLE_SQL is None
