"""Python workers give back what they do not keep."""

import re
from pathlib import Path

import pyarrow as pa

from sparkmart.llm import bpe
from sparkmart.llm.common import give_back, released
from sparkmart.llm.queries import BYTE_BPE


def megabytes():
    return sum(map(int, re.findall(r"\nPss_(?:Anon|Shmem):\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) >> 10


def test_loading_a_vocabulary_leaves_no_free_memory():
    coder = bpe.Bpe(BYTE_BPE)
    coder.load()
    held = megabytes()
    give_back()
    assert held - megabytes() < 15


def test_batches_come_one_by_one_and_leave_nothing():
    kept, sizes = [], []

    @released
    def work(batches):
        for batch in batches:
            many = [bytearray(2000) for _ in range(50_000)]
            kept.append(many[-1])  # behind the others, so that they stay in the process
            del many
            yield batch

    batch = pa.RecordBatch.from_arrays([pa.array([1])], ["x"])
    before = megabytes()
    for out in work(iter([batch] * 3)):
        assert out is batch
        sizes.append(megabytes())
    assert len(sizes) == 3 and megabytes() - before < 30
