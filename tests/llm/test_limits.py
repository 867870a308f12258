"""Time and memory of the corpus operators' helpers."""

from __future__ import annotations

import tracemalloc

import numpy as np

from roadpulse.llm import common, decontaminate


def test_window_hashes_take_two_arrays():
    sums = decontaminate.running_sums(np.random.default_rng(3).integers(0, 1 << 63, 100_000, dtype=np.uint64))
    tracemalloc.start()
    out = decontaminate.window_hashes(sums, 42)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2.5 * out.nbytes


def test_a_new_operators_state_gives_freed_memory_back(monkeypatch):
    class Libc:
        trimmed = 0

        def malloc_trim(self, pad):
            self.trimmed += 1

    libc = Libc()
    monkeypatch.setattr(common, "_LIBC", libc)
    monkeypatch.setattr(common, "_STATE", {"the operator before": {}})
    common.worker_state("this one", dict)
    assert libc.trimmed == 1 and list(common._STATE) == ["this one"]
    common.worker_state("this one", dict)
    assert libc.trimmed == 1


def test_batches_of_texts_are_small(spark):
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1024
