"""What Python workers hold."""
from __future__ import annotations

import re
import tracemalloc
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa

from mercaflow.llm import ngram_lm
from mercaflow.llm.memory import giving_back


def _held_mb() -> int:
    return int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) // 1024


def test_a_worker_gives_back_what_it_freed():
    def work(batches):
        for batch in batches:
            blocks = [np.ones(8_000) for _ in range(6_000)]
            pins = blocks[::100]
            del blocks
            yield batch
            kept.append(pins)

    kept: list = []
    before = _held_mb()
    assert len(list(giving_back(work)(iter([pa.record_batch({"x": [1]})])))) == 1
    assert _held_mb() - before < 150  # of 384 that were freed


def test_a_shard_answers_in_little_memory():
    rng, requests, pairs, size = np.random.default_rng(5), 8, 60_000, 20_000
    rows = []
    for batch in range(requests):
        words = np.sort(rng.choice(200_000, size, replace=False).astype(np.uint64) * np.uint64(2**46))
        key = np.unique(rng.integers(0, size * size, pairs))
        context, successor = key // size, key % size
        fresh = np.flatnonzero(np.diff(context, prepend=-1))
        packed = [ngram_lm._shuffled(x) for x in (
            np.ones(size), context[fresh], np.diff(np.append(fresh, len(key))), successor, np.ones(len(key)),
        )]
        rows.append((batch, 0, words.tobytes(), *packed))
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in ngram_lm.ASK_SCHEMA.split(", ")])
    tracemalloc.start()
    try:
        answers = ngram_lm._answering({})(frame)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(answers) == requests
    assert peak < 125 * requests * pairs  # bytes
