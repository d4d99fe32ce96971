"""What a Python worker holds at once while the pipeline's own stages run."""

import pyarrow as pa
import pytest

import corpus_pipeline
from brickyard.llm import bpe, common, language_id
from brickyard.llm.queries import tokenizer_path

NAME = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.mark.parametrize("before, after", [("10000", "2000"), ("500", "500"), ("0", "2000")])
def test_stages_bound_their_batches(spark, docs, sf, before, after):
    kept = spark.conf.get(NAME)
    for stage in (corpus_pipeline.languages, corpus_pipeline.tokens):
        spark.conf.set(NAME, before)
        stage(spark, docs.limit(20), sf)
        now = spark.conf.get(NAME)
        spark.conf.set(NAME, kept)
        assert now == after


def test_texts_are_looked_at_in_small_steps(docs, monkeypatch):
    texts = pa.array([f"{i} {r['text']}" for i in range(3) for r in docs.select("text").where("text IS NOT NULL").collect()])
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), texts], ["doc_id", "text"])
    seen = []
    steps = common.steps
    for module in (language_id, bpe):
        monkeypatch.setattr(module, "steps", lambda *a: (seen.append(p.column("text").nbytes) or p for p in steps(*a)))
    found = language_id.answers(language_id.Model([], language_id.np.zeros((language_id.BUCKETS, 0)), language_id.np.zeros(0)), texts)
    coded = [x for _, part in bpe.encoded_texts(rows, tokenizer_path()) for x in part]
    assert len(found[0]) == len(coded) == len(texts)
    assert sum(seen) > 1 << 20 and max(seen) < 1 << 19
