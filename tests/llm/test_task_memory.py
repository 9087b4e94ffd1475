"""Memory of Python workers: bounded while a task runs, given back when it ends."""

import tracemalloc

import numpy as np
import pyarrow as pa

from ledgermill.llm import decontam
from ledgermill.llm import kernels as K


def test_decontamination_takes_little_memory_for_a_batch():
    text = "the Quick brown fox 12 jumps over a lazy dog. " * 60
    batch = pa.RecordBatch.from_arrays([pa.array(range(800), pa.int64()), pa.array([text] * 800)], names=["key", "text"])
    run = decontam._doc_windows(np.zeros(K.FILTER_BITS // 8, np.uint8), [8])
    tracemalloc.start()
    try:
        assert sum(b.num_rows for b in run(iter([batch]))) == 0
        assert tracemalloc.get_traced_memory()[1] < 40e6
    finally:
        tracemalloc.stop()


def test_words_do_not_depend_on_how_texts_are_dealt():
    texts = ["Ask Élise. 12 miles", None, "", "«Paris» is far! McDonald said 3", "..."]
    whole = decontam.templates(pa.array(texts, pa.string()))
    alone = [decontam.templates(pa.array([t], pa.string())) for t in texts]
    for name in ("hashes", "slots", "named_hashes", "named_slots", "values", "fresh"):
        assert getattr(whole, name).tolist() == [x for w in alone for x in getattr(w, name).tolist()]


def test_a_task_gives_its_memory_back_at_its_end(monkeypatch):
    calls = []
    monkeypatch.setattr(K, "give_back", lambda: calls.append("given"))

    def run(batches):
        for b in batches:
            calls.append(b)
            yield b

    assert list(K.tidy(run)(iter([1, 2]))) == [1, 2]
    assert calls == [1, 2, "given"]
