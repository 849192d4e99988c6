"""Vector codes against a dense computation."""

import random

import numpy as np

from tessera.llm import vector_codes
from tessera.llm.queries import op11_vector_codes
from tessera.llm.vector_codes import codebooks_digest, compress, nearest


def brute(rows, parts=8, entries=16, rounds=6):
    """(vec_id, label, code, error, label_error) and codebooks of sound rows (vec_id, vector, label)."""
    x = np.floor(np.array([r[1] for r in rows]) * 4096).astype(np.int64)
    p = np.stack(np.split(x, parts, axis=1))
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:entries]
    books = p[:, first].copy()
    for r in range(rounds + 1):
        d = ((p[:, :, None] - books[:, None]) ** 2).sum(-1)
        code = d.argmin(-1)
        if r < rounds:
            for j in range(parts):
                for k in range(len(first)):
                    if (code[j] == k).any():
                        books[j, k] = p[j][code[j] == k].sum(0) // (code[j] == k).sum()
    error = d.min(-1).sum(0)
    totals = {}
    for row, e in zip(rows, error.tolist(), strict=True):
        totals[row[2]] = totals.get(row[2], 0) + e
    return [(r[0], r[2], code[:, i].tolist(), int(error[i]), totals[r[2]]) for i, r in enumerate(rows)], books


def check(spark, rows, sound):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string, row int, code string")
    coded, books = compress(vectors.repartition(3))
    want, want_books = brute(sound)
    assert sorted(map(tuple, coded.collect()), key=repr) == sorted(want, key=repr)
    assert np.array_equal(books, want_books) and len(codebooks_digest(books)) == 64


def test_codes_equal_a_dense_computation(llm_spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "MEMBERS", 200)
    rng = random.Random(5)
    centres = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(5)]
    vector = lambda: [c + rng.gauss(0, 0.3) for c in rng.choice(centres)]
    rows = [(i, vector(), rng.choice(["a", "b", None]), 0, "x") for i in range(200)]
    # a third of all rows have one vector, ids repeat, one is missing
    rows += [(200 + i, rows[0][1], "hot", 0, None) for i in range(100)] + [(3, vector(), "a", 0, ""), (None, vector(), "", 0, "")]
    sound = [r[:3] for r in rows]
    bad = [None, [], [None] * 16, [float("nan")] + [0.0] * 15, [float("inf")] * 16, [1.0] * 8, [1.0] * 15, [3e5] * 16]
    check(llm_spark, rows + [(1000 + i, b, "a", 0, "") for i, b in enumerate(bad)], sound)


def test_ties_go_to_the_lower_entry():
    best, distance = nearest(np.array([[0], [4], [7]]), np.array([[2], [-2], [6], [2]]))
    assert best.tolist() == [0, 0, 2] and distance.tolist() == [4, 4, 1]


def test_few_and_no_vectors(llm_spark):
    rows = [(2, [1.0] * 8, "a", 0, ""), (1, [-1.5] * 8, None, 0, "")]
    check(llm_spark, rows, [r[:3] for r in rows])
    for empty in ([], [(1, None, "a", 0, "")]):
        coded, books = compress(llm_spark.createDataFrame(empty, "vec_id long, embedding array<double>, label string, row int, code string"))
        assert coded.collect() == [] and books.size == 0
        assert coded.columns == ["vec_id", "label", "code", "error", "label_error"]


def test_query(llm_spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in llm_spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect() if r["embedding"] is not None]
    want, books = brute(rows)
    got = sorted(map(tuple, op11_vector_codes(llm_spark, sf_dir).collect()))
    assert got == sorted((i, "".join(f"{k:02x}" for k in code), e, t, codebooks_digest(books)) for i, _, code, e, t in want)
