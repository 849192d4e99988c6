"""Repeated byte strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tessera.llm import suffix_dedup
from tessera.llm._text import flat
from tessera.llm.queries import op12_suffix_dedup
from tessera.llm.suffix_dedup import permuted_lcp, remove_repeats, suffix_array

LENGTH = 40


def brute(texts, length):
    """(bytes, covered bytes as a mask) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        covered = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                covered[i : i + length] = True
        out.append((b, covered))
    return out


def want(ids, texts, length):
    rows = []
    for doc_id, (b, covered) in zip(ids, brute(texts, length), strict=True):
        edges = np.diff(np.concatenate([[0], covered.astype(int), [0]]))
        spans = list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True))
        rows.append((doc_id, len(b), spans, np.frombuffer(b, np.uint8)[~covered].tobytes()))
    return sorted(rows, key=repr)


def got(df):
    return sorted(((r["doc_id"], r["n_bytes"], [(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"])) for r in df.collect()), key=repr)


@pytest.mark.parametrize("short", [1, 1 << 17])
def test_suffix_arrays_and_common_prefixes(monkeypatch, short):
    monkeypatch.setattr(suffix_dedup, "SHORT", short)
    rng = random.Random(4)
    for _ in range(300):
        t = [rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(rng.randrange(1, 50))]
        t = t * rng.choice([1, 1, 4])
        sa = suffix_array(np.array(t, np.uint8), 256).tolist()
        assert sa == sorted(range(len(t)), key=lambda i, t=t: t[i:])
        lcp, before = permuted_lcp(np.array(t, np.uint8), np.array(sa))
        for a, b in zip(sa, sa[1:], strict=False):
            n = 0
            while max(a, b) + n < len(t) and t[a + n] == t[b + n]:
                n += 1
            assert (lcp[b], before[b]) == (n, a)


def texts_with_repeats():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdeé世") for _ in range(rng.randrange(2, 9)))
    passage = " ".join(word() for _ in range(30))
    texts = []
    for i in range(60):
        words = [word() for _ in range(rng.randrange(5, 120))]
        if i % 3 == 0:
            words.insert(rng.randrange(len(words)), passage)
        if i % 5 == 0:
            words.insert(rng.randrange(len(words)), passage[10 : 10 + rng.randrange(20, 90)])
        texts.append(" ".join(words))
    near = texts[0].split(" ")
    near[len(near) // 2] = "edited"
    texts += [texts[1], texts[1], texts[2], " ".join(near), "a" * 500, "ab" * 300, "b" + "ab" * 300, "x" * 39, "y" * 40, "", None, None, "z" * 41]
    return texts


@pytest.mark.parametrize("hot", [2048, 2])
@pytest.mark.parametrize("run", [4096, 50])
def test_removal_equals_brute_force(llm_spark, monkeypatch, hot, run):
    """Also where every anchor is hot, and where runs of one anchor are cut."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "RUN", run)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 5000)
    texts = texts_with_repeats()
    docs = llm_spark.createDataFrame([(i, t, b"", 0) for i, t in enumerate(texts)], "doc_id long, text string, kept binary, h int")
    assert got(remove_repeats(docs.repartition(5), length=LENGTH)) == want(range(len(texts)), texts, LENGTH)


def test_long_texts_in_chunks(llm_spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 3000)
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefgh") for _ in range(20_000))
    texts = [long, long[7000:12_345] + "tail", "q" * 9000]
    docs = llm_spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert got(remove_repeats(docs, length=LENGTH)) == want(range(3), texts, LENGTH)


def test_odd_tables(llm_spark):
    empty = llm_spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeats(empty).collect() == []
    odd = llm_spark.createDataFrame([(None, "w" * 250), (None, None), (3, None)], "doc_id long, text string")
    assert got(remove_repeats(odd)) == want([None, None, 3], ["w" * 250, None, None], 200)


def test_query(llm_spark, sf_dir):
    docs = llm_spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    rows = [(i, n, sum(z - a for a, z in spans), len(spans), hashlib.sha256(kept).hexdigest()) for i, n, spans, kept in want([d["doc_id"] for d in docs], [d["text"] for d in docs], 200)]
    assert sorted(map(tuple, op12_suffix_dedup(llm_spark, sf_dir).collect())) == sorted(rows)


def test_anchor_runs_cover_every_window_once():
    texts = texts_with_repeats()
    import pyarrow as pa

    data, bounds = flat(pa.array(texts))
    _, row, start, count, _ = suffix_dedup._anchor_runs(data, bounds, LENGTH)
    windows = sorted((r, w) for r, s, n in zip(row.tolist(), start.tolist(), count.tolist(), strict=True) for w in range(s, s + n))
    assert windows == [(r, w) for r in range(len(texts)) for w in range(bounds[r], bounds[r + 1] - LENGTH + 1)]
