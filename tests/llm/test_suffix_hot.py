"""A passage shared by very many texts: its edges are anchors with more different chunks than a task takes."""

from collections import Counter
from hashlib import sha256

import numpy as np

from riskframe.llm import suffixes


def test_hot_edges(spark, monkeypatch):
    """300 texts share a passage behind and before text of their own, some also part of the text beside it; a group takes 20 chunks."""
    rng = np.random.default_rng(3)
    own = lambda n: bytes(rng.integers(97, 123, n, dtype=np.uint8))
    passage, beside = own(420), [own(150) for _ in range(6)]
    rows = []
    for i in range(300):
        left = own(int(rng.integers(0, 160))) + (beside[i % 6][-int(rng.integers(1, 150)):] if i % 3 else b"")
        rows.append((i, left + passage[: int(rng.integers(199, 421))] + own(int(rng.integers(0, 160)))))
    rows += [(1000, passage), (1001, passage), (1002, passage[:200]), (1003, own(500))]
    seen = Counter(b[s : s + 200] for _, b in rows for s in range(len(b) - 199))
    want = {}
    for i, b in rows:
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - 199):
            if seen[b[s : s + 200]] > 1:
                gone[s : s + 200] = True
        want[i] = (len(b), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), sha256(bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])).hexdigest())
    df = spark.createDataFrame([(i, b.decode()) for i, b in rows], "doc_id long, text string")
    monkeypatch.setattr(suffixes, "HOT", 20)
    assert {r[0]: tuple(r[1:5]) for r in suffixes.remove_repeats(df).collect()} == want
