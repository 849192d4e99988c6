"""Ranked search against brute force; shared sums; hashes of long words."""

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from tessera.llm import ranked_search
from tessera.llm._text import ALNUM, LOWER, flat, word_hashes, words
from tessera.llm.decontaminate import find_contamination
from tessera.llm.jaccard_join import jaccard_components
from tessera.llm.ranked_search import mine, rank

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k):
    counts = [(i, terms(t)) for i, t in docs]
    n, total = sum(1 for _, w in counts if w), sum(len(w) for _, w in counts)
    df = Counter(t for _, w in counts for t in set(w))
    queries = {}
    for i, t in items:
        queries.setdefault(i, []).extend(terms(t))
    out = []
    for i, q in queries.items():
        found = []
        for doc_id, w in counts:
            tf = Counter(w)
            m = 75 + 25 * len(w) * n // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 12 * m)) for t in q if tf[t])
            if score > 0:
                found.append((-score, doc_id is not None, doc_id or 0))
        out += [(i, r + 1, d if known else None, -s) for r, (s, known, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abCdé9") for _ in range(rng.randrange(1, 6))) for _ in range(60)]
    docs = [(i, rng.choice([" ", "-", "\n_"]).join(rng.choices(vocabulary, weights=range(1, 61), k=rng.randrange(1, 40)))) for i in range(120)]
    docs += [(7, docs[7][1]), (500, docs[7][1]), (None, docs[7][1]), (8, None), (9, ""), (10, " .,- ")] + [(600 + i, docs[3][1]) for i in range(60)]
    shared = " ".join(vocabulary[:12])
    items = [(i, shared + " " + " ".join(rng.choices(vocabulary, k=6))) for i in range(25)] + [(100, vocabulary[0]), (101, "nowhere"), (102, None), (103, ""), (None, vocabulary[5]), (100, vocabulary[0] + " " + vocabulary[9])]
    return docs, items


@pytest.mark.parametrize("items_a_block, held", [(1024, 1 << 20), (7, 1)])
def test_lists_equal_brute_force(llm_spark, monkeypatch, items_a_block, held):
    monkeypatch.setattr(ranked_search, "ITEMS", items_a_block)
    monkeypatch.setattr(ranked_search, "HELD", held)
    monkeypatch.setattr(ranked_search, "DOCUMENTS", 16)
    if items_a_block == 7:
        monkeypatch.setattr(ranked_search, "TERMS", 20)
    docs, items = corpus()
    df = llm_spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, rank string, score int").repartition(6)
    it = llm_spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    assert sorted(map(tuple, rank(df, it, k=5).collect()), key=repr) == brute(docs, items, 5)


def test_odd_tables(llm_spark):
    docs = llm_spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    none = llm_spark.createDataFrame([], "doc_id long, text string")
    items = llm_spark.createDataFrame([("a", "two " * 3000 + "three")], "item_id string, text string")
    no_items = items.filter("false")
    assert rank(none, items).collect() == [] and rank(docs, no_items).collect() == []
    got = rank(docs, items).collect()
    assert [tuple(r) for r in got] == brute([(1, "one two")], [("a", "two " * 3000)], 20)


def test_shared_sets_rebuild_the_items():
    rng = random.Random(1)
    items = [sorted(rng.sample(range(200), rng.randrange(1, 150))) for _ in range(40)] + [list(range(30))] * 3
    out, nodes = mine(items, 200)

    def leaves(x):
        return [x] if x < 200 else leaves(nodes[x - 200][0]) + leaves(nodes[x - 200][1])

    assert [sorted(y for x in item for y in leaves(x)) for item in out] == items
    assert all(max(pair) < 200 + i for i, pair in enumerate(nodes))
    # each sum is computed once, so there are fewer additions than without nodes
    assert sum(map(len, out)) + len(nodes) < sum(map(len, items))


def morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_words_made_to_collide_do_not(llm_spark):
    for n in (256, 1024, 4096, 65536):
        pair = [morse(n), morse(n).translate(str.maketrans("ab", "ba"))]
        data, bounds = flat(pa.array(pair))
        starts, ends, _ = words(LOWER[data], bounds, ALNUM)
        a, b = word_hashes(LOWER[data], starts, ends)
        assert a != b
    one, two = morse(1024), morse(1024).translate(str.maketrans("ab", "ba"))
    text = "one two three four {} six seven eight nine ten eleven"
    docs = llm_spark.createDataFrame([(1, text.format(one)), (2, text.format(two))], "doc_id long, text string")
    items = llm_spark.createDataFrame([(7, text.format(one))], "item_id long, text string")
    assert {r["doc_id"]: list(r["items"]) for r in find_contamination(docs, items).collect()} == {1: ["7"], 2: []}
    assert {r["doc_id"]: r["component_id"] for r in jaccard_components(docs).collect()} == {1: 1, 2: 2}
