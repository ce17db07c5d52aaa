"""A batch with more postings than a block holds is searched in several blocks."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from tillcast.llm import lexical_search as S


def test_blocks_stay_bounded(monkeypatch):
    rng, each, docs = np.random.default_rng(1), 100, 6000
    terms = [np.sort(rng.choice(400, each, replace=False)).astype(np.int32).tobytes() for _ in range(docs)]
    tfs = [rng.integers(1, 5, each).astype(np.int32).tobytes() for _ in range(docs)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(docs), pa.int64()), pa.array([each * 3] * docs, pa.int64()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())],
                                       names=["doc_id", "n", "terms", "tfs"])
    shared = SimpleNamespace(value=([(np.array([1, 7, 30]), np.array([1, 2, 1]))], np.arange(400) + 500, docs, docs * each * 3))
    sizes, real = [], S.Block

    class Seen(real):
        def __init__(self, ids, lengths, term_parts, *rest):
            sizes.append(sum(map(len, term_parts)) // 4)
            super().__init__(ids, lengths, term_parts, *rest)

    monkeypatch.setattr(S, "Block", Seen)
    got = [b.to_pylist() for b in S.searched(shared, 20)(iter([batch]))]
    assert sum(sizes) == each * docs and max(sizes) < 250_000 + 256 * each
    monkeypatch.setattr(S, "BLOCK_POSTINGS", 10 * each * docs)
    assert got == [b.to_pylist() for b in S.searched(shared, 20)(iter([batch]))]
