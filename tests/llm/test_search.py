"""Ranked search against plain versions."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import oracle_compare
from shelfspark.llm import queries, search
from shelfspark.llm.oracle import ORACLE

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain(docs, items, top=10):
    rows = [(i, Counter(terms(t))) for i, t in docs]
    rows = [(i, c) for i, c in rows if c]
    n_docs, total = len(rows), sum(sum(c.values()) for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, own in asked.items():
        scored = []
        for i, c in rows:
            m = 10 + 90 * sum(c.values()) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in own if c[t])
            if s > 0:
                scored.append((-s, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def corpus(seed=2, n=300):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdEFéÉ漢9") for _ in range(rng.randint(1, 5))) for _ in range(400)]
    make = lambda k: rng.choice([" ", "-", "_ ", "\n"]).join(vocab[min(399, int(rng.expovariate(0.02)))] for _ in range(k))
    texts = [None, "", "  !?", "one", "ONE one", make(5000)] + [make(rng.randint(1, 120)) for _ in range(n)]
    texts += [texts[-1]] * 14 + ["x y " * 50]
    docs = [(k, t) for k, t in enumerate(texts)] + [(5, texts[9]), (None, texts[-2]), (None, "one")]
    items = [(k, make(rng.randint(1, 30))) for k in range(40)] + [(50, None), (51, ""), (52, "nowhere"), (53, "one"), (53, "X"),
                                                                  (None, texts[-2]), (54, texts[-2]), (55, "one one ONE")]
    return docs, items


@pytest.mark.parametrize("limits", [{}, {"block_items": 7, "block_terms": 100}, {"top": 3}])
def test_search(spark, limits):
    docs, items = corpus()
    table = search.index(spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, n int").repartition(4))
    pairs = search.item_terms(spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, rank int"))
    got = search.search(table, pairs, **limits)
    assert got.columns == ["item", "rank", "id", "score"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == plain(docs, items, limits.get("top", 10))


def test_search_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([("a", "one two")], "item_id string, text string")
    pairs = search.item_terms(items)
    assert search.search(search.index(none), pairs).collect() == []
    some = search.index(spark.createDataFrame([(1, "one"), (2, None)], "doc_id long, text string"))
    assert search.search(some, search.item_terms(items.where("false"))).collect() == []
    assert [tuple(r)[:3] for r in search.search(some, pairs).collect()] == [("a", 1, 1)]


def test_bounds_are_upper_and_spare_work(spark):
    """Every bound is at least the score, and few documents are scored exactly."""
    docs, items = corpus(5, 2000)
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in docs]), pa.array([t for _, t in docs])], names=["id", "text"])
    index = pa.Table.from_batches(search._index_task(iter([batch]))).combine_chunks().to_batches()[0]
    index = index.filter(pa.compute.greater(index.column(1), 0))
    keys, item = [], []
    for k, (_, t) in enumerate(items):
        for part in search.term_texts(pa.array([t])):
            own = np.unique(part.hashes())
            keys.append(own)
            item.append(np.full(len(own), k))
    key, item = np.concatenate(keys), np.concatenate(item)
    vocab = np.unique(key)
    held, _ = search._numbers(index.column(3), np.uint64)
    df = np.array([(held == v).sum() for v in vocab])
    block = search.Block(item, key, len(items), df, vocab, index.num_rows, int(index.column(1).to_numpy().sum()))
    own = search.Documents(index, block)
    bounds = own.bounds()
    rows = np.arange(index.num_rows)
    for k in range(len(items)):
        assert (bounds[:, k] >= own.scores(k, rows)).all()
    taken = search.rescore(own, index.column(0).fill_null(search._NO_ID).to_numpy(), [search.Best(10) for _ in items])
    assert taken < 0.5 * index.num_rows * len(items)


def test_search_oracle(spark):
    d = "/root/testdata/sf0.001"
    r = oracle_compare.compare(spark, oracle_compare.duck(d), d, "op11", queries.QUERIES["op11_max_sketch_search"], ORACLE["op11_max_sketch_search"])
    assert r["cols_match"] and r["values_match"], r
