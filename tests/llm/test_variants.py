"""Spelling variants against a plain version."""

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from shelfspark.llm import queries, variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def plain_words(rows, min_length=6, min_count=5, drop=199):
    count = Counter()
    for i, t in rows:
        for w in RUN.findall(t or ""):
            w = lower(w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if drop and h % drop == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= min_length:
                count[w] += 1
    return {w: n for w, n in count.items() if n >= min_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    p = 0
    while p < len(a) and a[p] == b[p]:
        p += 1
    return a[p + (len(a) == len(b)):] == b[p + 1:]


def plain_groups(count, ratio=5):
    near = {w: [v for v in count if one_edit(w, v)] for w in count}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best is not None and count[best] >= ratio * count[w] else None
    out = []
    for w in count:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, count[w], len(near[w]), count[form[w]] if form[w] else None))
    return sorted(out, key=str)


def corpus(seed=4):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcéßÿ") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    vocab += [v[:3] + rng.choice("abcÀ") + v[3 + rng.randint(0, 1):] for v in vocab[:40]] + ["L" * 90, "é" * 80 + "Q", "x" * 4000]
    texts = [None, "", "123 -- \n", "ÃÃÃ×÷×÷ ĀabcdefĀ"] + [" ".join(rng.choice(vocab) if rng.random() < 0.6 else vocab[int(rng.expovariate(0.3)) % 60]
                                                                   for _ in range(rng.randint(1, 200))).replace("c ", "C,") for _ in range(120)]
    rows = list(enumerate(texts))
    return rows + [rows[7], (None, texts[8]), (-3, texts[9])]


def collected(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("drop", [199, 7, None])
def test_words(spark, drop):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "w", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(3)
    got = {r.word: r.n for r in variants.words(docs, min_count=2, drop_every=drop).collect()}
    assert got == plain_words(rows, min_count=2, drop=drop)


@pytest.mark.parametrize("hot", [16, 1, 0])
def test_group(spark, hot):
    rng = random.Random(hot)
    pool = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 9))) for _ in range(400)} | {"xyz" * 30, "xyz" * 30 + "q"}
    count = {w: int(rng.expovariate(1) ** 4) + 1 for w in sorted(pool)}
    got = variants.group(spark.createDataFrame(list(count.items()), "word string, n long").repartition(3), hot=hot)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert collected(got) == plain_groups(count)


def test_long_chain(spark):
    words = ["abcdef" + "g" * k for k in range(9)]
    count = {w: 5 ** (9 - k) for k, w in enumerate(words)}
    assert collected(variants.group(spark.createDataFrame(list(count.items()), "word string, n long"))) == plain_groups(count)


def test_shared_half_keeps_candidates_few(spark):
    """Thousands of words that share one half are dealt by the rest; all links stay."""
    rng = random.Random(1)
    pool = {"prefix" + "".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(1500)}
    count = {w: 5 for w in pool}
    got = {(r.word, r.other) for r in variants.near(spark.createDataFrame([(w,) for w in pool], "word string")).collect()}
    assert got == {(a, b) for a in pool for b in pool if a != b and one_edit(a, b)} and len(count) == len(pool)


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert variants.group(variants.words(none)).collect() == []


def test_checksums():
    for part in variants.run_texts(pa.array(["ab " + "q" * 63 + " " + "q" * 64 + " " + "q" * 65, None, "Ébc ab"])):
        raw = part.data.tobytes()
        runs = [raw[a:b] for a, b in zip(part.starts.tolist(), part.ends.tolist())]
        vocab = sorted(set(runs))
        word = variants.np.array([vocab.index(r) for r in runs])
        got = variants.run_checksums(part, [b"7", b"", b"-12"], word, vocab).tolist()
        assert got == [zlib.crc32([b"7", b"", b"-12"][i] + b":" + r) for i, r in zip(part.words_of().tolist(), runs)]


def test_query(spark, tmp_path):
    rows = corpus(6)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    assert collected(queries.q_variants(spark, str(tmp_path))) == plain_groups(plain_words(rows))
