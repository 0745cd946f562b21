"""The rows of hot anchors stay in proportion to their chunks, however long the passage that they share."""

import numpy as np

from riskframe.llm import suffixes


def test_rows_of_hot_anchors_do_not_double(spark, monkeypatch):
    rng = np.random.default_rng(5)
    own = lambda n: bytes(rng.integers(97, 123, n, dtype=np.uint8))
    passage, n = own(600), 120
    rows = [(i, (own(200) + passage + own(200)).decode()) for i in range(n)]
    made, plain = [], suffixes.staged

    def staged(df, what="stage"):
        out = plain(df, what)
        made.append((what, out.count()) if what in ("chunks", "parts") else (what, 0))
        return out

    monkeypatch.setattr(suffixes, "staged", staged)
    monkeypatch.setattr(suffixes, "HOT", 20)
    got = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["n_removed"] >= 600 and r["n_spans"] == 1 for r in got)  # a byte beside it may agree by chance
    assert 0 < sum(k for what, k in made if what == "parts") <= 3 * sum(k for what, k in made if what == "chunks")


def test_alike():
    assert [suffixes._alike(a, b) for a, b in ((b"", b"a"), (b"abc", b"abd"), (b"abc", b"abc"), (b"x", b"abc"), (b"abcdefgh", b"abcdefg"))] == [0, 2, 3, 0, 7]
