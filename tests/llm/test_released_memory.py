"""Python workers outlive their tasks: a task's end gives back what it held."""

import numpy as np
import pyarrow as pa
import pytest

from riskgraph.llm import common, minhash_bottomk, packing, toxicity_ws

TEXTS = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text_hash": [3, 4], "held_out": [False, True],
                                    "toxic": [True, False], "text": ["One two three four five six", None]})
MODEL = toxicity_ws.Model(["wone"], np.ones(1, bool), np.array([-2.0, 1.0, 1.0, 1.0]))


@pytest.fixture()
def released(monkeypatch):
    calls = []

    class Pool:
        def release_unused(self):
            calls.append(1)
    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    return calls


@pytest.mark.parametrize("task", [
    toxicity_ws._count, toxicity_ws._vote(["wone"]), toxicity_ws._filter_texts(MODEL, 0.3), minhash_bottomk._sketcher(5, 48)])
def test_tasks_release_at_their_end(released, task):
    assert sum(b.num_rows for b in task(iter([TEXTS]))) and len(released) == 1
    unfinished = task(iter([TEXTS, TEXTS]))
    next(unfinished)
    unfinished.close()
    assert len(released) == 2


def test_pack_drops_its_encoder_if_asked(released, monkeypatch):
    import public_tokenizers
    path = str(public_tokenizers.path(packing.TOKENIZER))

    class Task:
        get = classmethod(lambda cls: cls)
        partitionId = staticmethod(lambda: 0)
    monkeypatch.setattr(packing, "TaskContext", Task)
    monkeypatch.setattr(packing, "_ENCODERS", {})
    rows = []
    for keep in (False, True):
        task = packing._pack_task(path, 4, 2, 2, 1 << 20, keep)
        rows.append([r for b in task(iter([TEXTS])) for r in b.to_pylist()])
        assert bool(packing._ENCODERS) is keep
    assert rows[0] == rows[1] and len(released) == 2


def test_pipeline_takes_smaller_batches(spark):
    import corpus_pipeline
    before = spark.conf.get(corpus_pipeline.BATCH)
    try:
        spark.conf.set(corpus_pipeline.BATCH, "64MB" if before == "64MB" else "67108864b")
        docs = spark.createDataFrame([(1, "a", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
        assert corpus_pipeline._documents(docs).count() == 1
        assert spark.conf.get(corpus_pipeline.BATCH) == "4m"
        spark.conf.set(corpus_pipeline.BATCH, "1m")             # a session's own choice stays
        corpus_pipeline._documents(docs)
        assert spark.conf.get(corpus_pipeline.BATCH) == "1m"
    finally:
        spark.conf.set(corpus_pipeline.BATCH, before)
