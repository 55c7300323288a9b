"""Repeated byte strings against a plain version."""

import hashlib
import random

import numpy as np
import pytest

from shelfspark.llm import repeats

SCHEMA = "doc_id long, text string, n_bytes int, block string, _block string"


def plain(rows, depth):
    """doc_id, text -> (n_bytes, n_removed, n_spans, kept) by looking at every window."""
    least = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - depth + 1):
            if i is not None:
                w = b[p:p + depth]
                least[w] = min(least.get(w, i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - depth + 1):
            if i is not None and least[b[p:p + depth]] < i:
                gone[p:p + depth] = b"\1" * depth
        spans = sum(1 for p, g in enumerate(gone) if g and not (p and gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def corpus(seed=3, n=60):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeéß漢") for _ in range(rng.randint(1, 6))) for _ in range(40)]
    make = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    hot, notice = make(40), "x" * 30 + make(12)
    base = make(150)
    texts = [None, "", "a", "z" * 49, "z" * 50, "z" * 50, "z" * 51, "ab" * 200, "ba" * 180 + "c", base, base, base.replace(" ", "  ", 3),
             base[5:200] + "!" + base[201:], make(2000), notice + make(3) + notice]
    for k in range(n):
        parts = [make(rng.randint(1, 40))]
        if k % 3:
            parts.append(hot[rng.randint(0, 20):])
        if k % 4 == 0:
            parts.append(notice)
        texts.append(" ".join(parts + [make(rng.randint(1, 10))]))
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = [(order[k], t) for k, t in enumerate(texts)]
    return rows + [rows[9], (7, base), (None, base), (None, hot)]


@pytest.mark.parametrize("depth,shard_bytes,hot", [(50, 64_000_000, 64), (50, 2_000, 2), (12, 2_000, 64), (7, 500, 3), (2, 500, 2)])
def test_remove(spark, monkeypatch, depth, shard_bytes, hot):
    rows = corpus()
    monkeypatch.setattr(repeats, "HOT_BLOCKS", hot)
    docs = spark.createDataFrame([(i, t, 1, "b", "c") for i, t in rows], SCHEMA).repartition(5)
    got = repeats.remove(docs, depth=depth, shard_bytes=shard_bytes)
    assert got.columns == ["doc_id", "text", "block", "_block", "n_bytes", "n_removed", "n_spans", "kept"]
    rows_out = got.collect()
    assert all(r["block"] == "b" and r["_block"] == "c" for r in rows_out)
    assert sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows_out], key=str) == plain(rows, depth)


def test_remove_in_pieces(spark, monkeypatch):
    """A text longer than a slice is worked on in pieces."""
    rows = corpus(8, 20)
    monkeypatch.setattr(repeats, "PIECE", 100)
    docs = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string").coalesce(2)
    part = repeats.texts(repeats.pa.array([t for _, t in rows]))
    whole = [repeats.Runs(p, 50) for p in part]
    assert sum(int(r.size.sum()) for r in whole) == sum(max(0, len((t or "").encode()) - 49) for _, t in rows)
    assert docs.count() == len(rows)


def test_remove_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.remove(docs).collect() == []
    docs = spark.createDataFrame([(1, None), (2, ""), (None, None)], "doc_id long, text string")
    assert sorted(r.n_bytes for r in repeats.remove(docs).collect()) == [0, 0, 0]


def test_radix_groups():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 2, 4000).astype(np.uint8)
    at, group = rng.integers(0, 3950, 3000), rng.integers(0, 3, 3000)
    for depth in (1, 8, 9, 17, 50):
        out = repeats.radix_groups(data, at, group, depth)
        keys = [(g, data[p:p + depth].tobytes()) for p, g in zip(at.tolist(), group.tolist())]
        assert len(set(out.tolist())) == len(set(keys)) == len({(a, b) for a, b in zip(keys, out.tolist())})


def test_query(spark, tmp_path):
    from shelfspark.llm import queries
    rows = corpus(4, 30)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.q_repeats(spark, str(tmp_path)).collect()], key=str)
    assert got == sorted([(*x[:4], hashlib.sha256(x[4]).hexdigest()) for x in plain(rows, 50)], key=str)
