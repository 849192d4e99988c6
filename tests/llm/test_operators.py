"""The training-data operators against brute force, round trips and edge cases."""

import hashlib
import math
import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import chat, decontaminate, fingerprints, jaccard_join, pii, quality_lm, toxicity, warc
from tessera.llm._text import ALNUM, LOWER, NON_SPACE, flat, row_sets, shingle_hashes, word_hashes, words
from tessera.llm.bpe import Codec, decode, encode, round_trip
from tessera.llm.token_files import Reader, Writer, new_folder, read_tokens, write_tokens

DOCS = "doc_id long, text string, lang string, words long, score string"
ODD = [
    (1, None, None, 1, "x"),
    (2, "", "en", 2, None),
    (None, "no id here, but five words at least", "en", 3, "y"),
    (3, "Tie tie TIE tie tie tie", "en", 4, "z"),
    (3, "Tie tie TIE tie tie tie", "en", 4, "z"),
    (4, "é世界 " * 4000 + "a" * 70000, "fr", 5, "w"),
    (5, "one two", "en", 6, "v"),
]


def docs_of(spark, rows=ODD):
    return spark.createDataFrame(rows, DOCS)


def hashed(texts, kind=ALNUM):
    data, bounds = flat(pa.array(texts, pa.string()))
    low = LOWER[data]
    starts, ends, at = words(low, bounds, kind)
    return word_hashes(low, starts, ends), at


# words and hashes ----------------------------------------------------------------------------


def test_words_follow_the_patterns():
    rng = random.Random(3)
    texts = ["".join(rng.choice("aB9 é\t\n-_世.\x1c\x85") for _ in range(rng.randrange(60))) for _ in range(300)] + [None, ""]
    for kind, pattern in ((ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (NON_SPACE, r"[^\x20\x09-\x0D]+")):
        data, bounds = flat(pa.array(texts))
        low = LOWER[data]
        starts, ends, at = words(low, bounds, kind)
        got = [low[s:e].tobytes().decode() for s, e in zip(starts, ends, strict=True)]
        lower = [re.sub("[A-Z]", lambda m: m.group().lower(), t or "") for t in texts]
        assert [got[a:z] for a, z in zip(at[:-1], at[1:], strict=True)] == [re.findall(pattern, t) for t in lower]


def test_equal_words_hash_alike_wherever_they_are():
    h, at = hashed(["alpha beta", "x" * 2_000_000 + " beta alpha"])
    assert h[0] == h[at[1] + 2] and h[1] == h[at[1] + 1] and len(set(h.tolist())) == 3


# 1 decontamination ---------------------------------------------------------------------------


def test_fm_index_finds_what_scanning_finds():
    rng = np.random.default_rng(5)
    for _ in range(30):
        words_ = rng.integers(1, 5, rng.integers(1, 300)).astype(np.uint64)
        bounds = np.unique(np.concatenate([[0], rng.integers(0, len(words_) + 1, 4), [len(words_)]]))
        index = decontaminate.FMIndex(words_, bounds)
        windows, sizes, want = [], [], set()
        for w in range(40):
            k = int(rng.integers(1, 7))
            window = rng.integers(1, 6, k).astype(np.uint64)
            windows.append(np.concatenate([window[::-1], np.zeros(7 - k, np.uint64)]))
            sizes.append(k)
            for a, z in zip(bounds[:-1], bounds[1:], strict=True):
                want |= {(w, i) for i in range(a, z - k + 1) if (words_[i : i + k] == window).all()}
        which, first = index.search(np.array(windows), np.array(sizes))
        assert set(zip(which.tolist(), first.tolist(), strict=True)) == want and len(which) == len(want)


def test_decontamination_in_many_shards_and_blocks(llm_spark, monkeypatch):
    item = " ".join(f"w{i}" for i in range(14))
    rows = [(1, f"Lead, {item}; tail {item.upper()}!"), (2, " ".join(f"w{i}" for i in range(9))), (3, None), (4, "said Short one here"), (5, "")]
    docs = llm_spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, items int")
    bench = llm_spark.createDataFrame([(10, item), (9, item), (9, item), (None, "tail"), (11, "short one"), (12, None), (13, "...")], "item_id long, text string")

    def check():
        got = {r["doc_id"]: r for r in decontaminate.find_contamination(docs, bench).collect()}
        assert got[1]["items"] == ["10", "9"] and [(s["start"], s["end"]) for s in got[1]["hit_spans"]] == [(1, 15), (16, 30)]
        assert got[2]["items"] == [] and got[3]["n_words"] == 0 and got[4]["items"] == ["11"]
        text = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, bench).collect()}
        assert text[1] == "Lead, \n; tail \n!" and text[2] == rows[1][1] and text[3] is None and text[4] == "said \n here"

    check()
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 12)
    check()
    empty = decontaminate.find_contamination(docs, bench.limit(0)).collect()
    assert all(r["items"] == [] for r in empty) and len(empty) == 5


# 2, 3 encoding and token files ---------------------------------------------------------------


@pytest.fixture(scope="module")
def coder(vocabulary):
    with open(vocabulary, encoding="utf-8") as f:
        return Codec(f.read())


@pytest.fixture(scope="module")
def library(vocabulary):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary)


def test_tree_concatenation_is_exact(coder, library):
    rng = random.Random(2)
    for alphabet in ("a", "ab", "abcdehlnort", "é世界ab", "=-_", " \n\t", "0123456789", "the in"):
        text = "".join(rng.choice(alphabet) for _ in range(3000))
        for _, (start, end) in library.pre_tokenizer.pre_tokenize_str(text):
            piece = text[start:end].encode()
            want = coder.encoding._encode_single_piece(piece)
            assert all(coder.encode_tree(piece, leaf) == want for leaf in (1, 5, 64))
        long = text * 12 + "<|endoftext|>" + text
        assert coder.encode(long).tolist() == library.encode(long, add_special_tokens=False).ids


def test_every_character_class_splits_as_in_the_library(coder, library):
    points = [c for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b1{chr(c)}2 {chr(c)}{chr(c)} x  {chr(c)}  " for c in points]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert coder.encode(text).tolist() == want.ids


def test_encode_and_decode_rows(llm_spark, vocabulary, library):
    docs = docs_of(llm_spark).withColumnRenamed("score", "ids")
    rows = decode(encode(docs, vocabulary), vocabulary).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert r["decoded"] == (r["text"] or "") and r["ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids
    assert decode(encode(docs.limit(0), vocabulary), vocabulary).count() == 0
    once = round_trip(docs.withColumn("decoded", F.lit(7)), vocabulary)
    assert "text" not in once.columns and round_trip(docs.limit(0), vocabulary).count() == 0
    assert sorted((str(r["doc_id"]), r["ids"], r["decoded"], r["words"]) for r in once.collect()) == sorted((str(r["doc_id"]), r["ids"], r["decoded"], r["words"]) for r in rows)


def test_decoding_broken_utf8(coder, library):
    ids = [i for i in range(0, 50_000, 3) if coder.known[i]]
    lists = [np.array(ids[a : a + 7]) for a in range(0, 700, 7)] + [np.zeros(0, np.int64)]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    assert coder.decode_lists(np.concatenate(lists).astype(np.int32), bounds) == [library.decode(x.tolist(), skip_special_tokens=False) for x in lists]


def test_token_files(llm_spark, vocabulary, library, tmp_path):
    folder = new_folder(llm_spark, "test-tokens")
    files = write_tokens(docs_of(llm_spark), folder, vocabulary)
    rows = read_tokens(llm_spark, folder, files).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 3, 4, 5]
    at = 0
    texts = {r[0]: r[1] for r in ODD}
    for r in rows:
        assert r["start"] == at and r["ids"] == [*library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 0]
        at += r["n_tokens"]
    some = read_tokens(llm_spark, folder, files, wanted=lambda ids: ids == 3).collect()
    assert [r["doc_id"] for r in some] == [3, 3]
    assert write_tokens(docs_of(llm_spark).limit(0), new_folder(llm_spark, "none"), vocabulary) == []


def test_seekable_file_reads_only_what_is_asked_for(tmp_path):
    import zstandard

    docs = [np.arange(n, dtype=np.uint32) for n in (3, 70_000, 0, 140_000, 5)]
    with open(tmp_path / "f", "wb") as f:
        w = Writer(f)
        for i, d in enumerate(docs):
            w.add(i, d)
        w.close()
    raw = (tmp_path / "f").read_bytes()
    plain = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert plain == np.concatenate(docs).astype("<u4").tobytes()
    with open(tmp_path / "f", "rb") as f:
        reader = Reader(f, len(raw))
        frames = []
        monkey = reader.frame
        reader.frame = lambda k: frames.append(k) or monkey(k)
        assert [(i, d.tolist()) for i, d in reader.documents(np.array([0, 2, 4]))] == [(i, docs[i].tolist()) for i in (0, 2, 4)]
        assert len(frames) == 2 < len(reader.seek)
    damaged = bytearray(raw)
    damaged[20] ^= 1
    with open(tmp_path / "g", "wb") as f:
        f.write(damaged)
    with open(tmp_path / "g", "rb") as f, pytest.raises((ValueError, zstandard.ZstdError)):
        list(Reader(f, len(raw)).documents(np.arange(5)))


# 4 quality -----------------------------------------------------------------------------------


def test_packed_texts_come_back_in_slices(monkeypatch):
    monkeypatch.setattr(quality_lm, "SLICE_CHARS", 10)
    texts = ["é" * 30, "a", "bc", "\U0001f600" * 4, "x" * 9, "y"]
    held = {3: [(-k, k, t.encode()) for k, t in enumerate(texts)]}
    slices = list(quality_lm._unpacked(pa.Table.from_batches([quality_lm._packed(held), quality_lm._packed({3: [(7, 8, b"z")]})])))
    assert [t for _, part in slices for t in part] == [*texts, "z"]
    assert [n for names, _ in slices for n in names] == [*[(-k, k) for k in range(6)], (7, 8)]
    assert len(slices) > 3


def test_quality_of_no_documents(llm_spark):
    docs = llm_spark.createDataFrame([], "doc_id long, text string, lang string")
    trusted = llm_spark.createDataFrame([], "doc_id long")
    assert quality_lm.classify(docs, trusted).collect() == []


def test_perplexity_is_that_of_interpolated_kneser_ney(llm_spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abc d") for _ in range(rng.randrange(1, 80))) for _ in range(60)]
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(100, None, None), (101, "", "en"), (102, "zzz𝕏", None)]
    docs = llm_spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = llm_spark.createDataFrame([(i,) for i in range(40)] + [(None,)], "doc_id long")
    got = {r["doc_id"]: r["perplexity"] for r in quality_lm.perplexities(docs, trusted).collect()}
    counts = {4: Counter(("\0\0\0" + t)[i : i + 4] for t in texts[:40] for i in range(len(t)))}
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cut = {}
    for k, c in counts.items():
        n = [sum(v == j for v in c.values()) for j in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0
        cut[k] = [min(max(j - (j + 1) * y * n[j] / n[j - 1] if n[j - 1] else j / 2, 0.1), j - 0.1) for j in (1, 2, 3)]

    def p(g):
        if not g:
            return 1 / 65536
        c, d = counts[len(g)], cut[len(g)]
        own = {x: v for x, v in c.items() if x[:-1] == g[:-1]}
        if not own:
            return p(g[1:])
        total = sum(own.values())
        taken = sum(d[min(v, 3) - 1] for v in own.values())
        return (own[g] - d[min(own[g], 3) - 1] if g in own else 0) / total + taken / total * p(g[1:])

    for i in (0, 7, 45, 59, 102):
        x = "\0\0\0" + (texts[i] if i < 60 else "zzz￿")
        want = math.exp(-sum(math.log(p(x[j - 3 : j + 1])) for j in range(3, len(x))) / (len(x) - 3))
        assert got[i] == pytest.approx(want, rel=1e-9)
    assert got[100] is None and got[101] is None
    kept = {r["doc_id"]: r["keep"] for r in quality_lm.classify(docs, trusted).collect()}
    assert not kept[100] and not kept[101] and not kept[102] and sum(kept[i] for i in range(40)) >= 36
    assert not any(r["keep"] for r in quality_lm.classify(docs, trusted.limit(0)).collect())


def test_probabilities_are_neither_collected_nor_broadcast(llm_spark, monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcé世 ") for _ in range(rng.randrange(1, 60))) for _ in range(40)]
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(50, texts[0], "fr"), (50, texts[0], "fr"), (None, texts[1], None), (60, None, "en"), (61, "", "en")]
    docs = llm_spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    trusted = llm_spark.createDataFrame([(i,) for i in range(20)], "doc_id long")

    def scores():
        return sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["lang"] or "", r["chars"], r["perplexity"] or 0.0) for r in quality_lm.perplexities(docs, trusted).collect())

    def refuse(*_):
        raise AssertionError("the table passes through the driver")

    monkeypatch.setattr(type(docs), "toPandas", refuse)
    monkeypatch.setattr(type(llm_spark.sparkContext), "broadcast", refuse)
    whole = scores()
    monkeypatch.setattr(quality_lm, "LOT_CHARS", 90)
    monkeypatch.setattr("tessera.llm._spark.BROADCAST_ROWS", 0)
    parts = scores()
    assert len(whole) == len(rows) and [r[:3] for r in whole] == [r[:3] for r in parts]
    assert [r[3] for r in parts] == pytest.approx([r[3] for r in whole], rel=1e-12)


# 5 toxicity ----------------------------------------------------------------------------------


def test_block_max_search_is_exact():
    rng = np.random.default_rng(3)
    n, terms = 700, 40
    rows, cols = np.nonzero(rng.random((n, terms)) < 0.1)
    counts = rng.integers(1, 4, len(rows))
    idf = rng.random(terms) + 0.5
    index = toxicity.Index(np.arange(n), rng.integers(0, 2, n), rows, cols, counts, idf)
    dense = np.zeros((n, terms))
    dense[rows, cols] = (1 + np.log(counts)) * idf[cols]
    norm = np.linalg.norm(dense, axis=1)
    dense[norm > 0] /= norm[norm > 0, None]
    for r in range(0, n, 13):
        t = np.flatnonzero(dense[r])
        if not len(t):
            continue
        place, cosine = index.nearest(t, dense[r, t])
        want = np.round(np.minimum(dense @ dense[r], 1), 9)
        kth = np.sort(want)[-toxicity.NEIGHBOURS]
        assert set(index.ids[place]) == set(np.flatnonzero((want >= kth) & (want > 0))) and np.allclose(np.sort(cosine), np.sort(want[index.ids[place]]))


def test_toxicity_learns_marked_words(llm_spark):
    rng = random.Random(4)
    plain = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        text = [rng.choice(plain) for _ in range(30)] + ([f"nasty{rng.choice('abcdef')}{i}"] if toxic else [])
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        if i < 300:
            labels.append((i, int(toxic)))
    docs = llm_spark.createDataFrame(rows + [(None, "nastyzz"), (999, None), (999, "")], "doc_id long, text string")
    table = llm_spark.createDataFrame(labels + labels[:5] + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs, toxicity.fit(docs, table)).collect()}
    assert all(got[i]["predicted"] == int(i % 4 == 0) for i in range(300, 400))
    assert got[None]["predicted"] == 1 and got[999]["predicted"] == 0 and 0 <= got[999]["score"] <= 1 and got[300]["evidence"]
    none = toxicity.score(docs, toxicity.fit(docs, table.limit(0))).collect()
    assert len(none) == 403 and all(r["score"] == 0 for r in none)


# 6 fingerprints ------------------------------------------------------------------------------


def test_likeness_estimates_jaccard():
    rng = np.random.default_rng(9)
    for share in (0.0, 0.5, 0.8, 1.0):
        errors = []
        for _ in range(20):
            cut = int(300 * (1 - share) / (1 + share))
            both = rng.integers(0, 1 << 64, 300 + cut, dtype=np.uint64)
            a, b = both[:300], both[cut:]
            j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            s = fingerprints.sketch(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
            errors.append(fingerprints.likeness(s[:1], s[1:])[0] - j)
        assert abs(np.mean(errors)) < 0.03 and np.abs(errors).max() < 0.12


def test_neighbours_and_edits(llm_spark):
    rows = [(i, f"text number {i} " + "lorem ipsum dolor sit amet consectetur " * (i % 5)) for i in range(0, 90, 3)] + [(200, None), (-4, ""), (None, "null id comes first in the order")]
    docs = llm_spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, ahead string").repartition(7)
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_with_next(docs).collect()}
    order = sorted(rows, key=lambda r: -(10**9) if r[0] is None else r[0])
    for (i, text), (j, other) in zip(order, order[1:] + order[:1], strict=True):
        t, o = text or "", other or ""
        edited = t[: len(t) - len(t) // 4] + o[: len(t) // 4]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i]["near_edited"] <= 1 and (got[i]["fingerprint"] == got[j]["fingerprint"]) == (got[i]["near_next"] == 1.0)
    assert got[200]["fingerprint"] == "" and fingerprints.fingerprint_with_next(docs.limit(0)).count() == 0


# 7 archives ----------------------------------------------------------------------------------


def test_archives_round_trip(llm_spark):
    rows = [(i, f"http://a/{i}", f"<html>{'same' if i % 3 else i}" + "<p>x</p>" * 50) for i in range(300)] + [(500, None, None), (501, "u\r\nX: y", ""), (None, "n", "only here"), (700, "t", "tie"), (700, "t", "tie")]
    pages = llm_spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    folder = new_folder(llm_spark, "test-archives")
    got = warc.read_archives(llm_spark, folder, warc.write_archives(pages, folder)).collect()
    assert len(got) == len(rows)
    largest = {}
    for i, _, html in rows:
        largest[html or ""] = max(largest.get(html or "", -1), -1 if i is None else i)
    texts = {i: html or "" for i, _, html in rows}
    for r in got:
        text = texts[r["page_id"]]
        response = largest[text] == (-1 if r["page_id"] is None else r["page_id"])
        assert r["payload_bytes"] == len(text.encode()) and r["payload_digest"] == warc.base32_sha1(text.encode())
        assert (r["record_type"], r["refers_to"]) == (("response", None) if response else ("revisit", largest[text]))
        assert not response or r["payload"].decode() == text
    assert warc.write_archives(pages.limit(0), new_folder(llm_spark, "none")) == []


# 8 near duplicates ---------------------------------------------------------------------------


def brute_components(rows):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted((doc, len(sets[i]), least[root(i)]) for i, (doc, _) in enumerate(rows))


@pytest.mark.parametrize(("seed", "broadcast_rows"), [(1, None), (2, None), (2, 0), (3, None)])
def test_components_equal_all_pairs(llm_spark, monkeypatch, seed, broadcast_rows):
    if broadcast_rows is not None:  # all lookups by shuffle
        monkeypatch.setattr("tessera.llm._spark.BROADCAST_ROWS", broadcast_rows)
        monkeypatch.setattr("tessera.llm.jaccard_join.BROADCAST_ROWS", broadcast_rows)
        monkeypatch.setattr("tessera.llm.jaccard_join.BROADCAST_SHINGLES", 0)
    rng = random.Random(seed)
    rows, common = [], " ".join(f"c{i}" for i in range(12))
    for family in range(8):
        base = [f"f{family}w{rng.randrange(60)}" for _ in range(rng.choice([6, 30, 80]))]
        for _ in range(rng.choice([2, 6, 25])):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            rows.append(" ".join(copy) if rng.random() < 0.6 else " ".join(copy) + " " + common)
    rows += [common + f" own{i} tail{i}" for i in range(20)] + ["Few words", "few  WORDS", "", None, " \n", "x"]
    rng.shuffle(rows)
    table = [(i * 3, t) for i, t in enumerate(rows)]
    docs = llm_spark.createDataFrame([(*r, 1) for r in table], "doc_id long, text string, n long")
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(docs).collect())
    assert got == brute_components(table)


def test_pivots_reach_every_member_of_a_large_group(llm_spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "MOST_PIVOTS", 2)
    rounds, store = [], jaccard_join.stored

    def counting(df, kind):
        rounds.append(kind)
        assert rounds.count("pairs") <= 40, "the rounds don't end"
        return store(df, kind)

    monkeypatch.setattr(jaccard_join, "stored", counting)
    # each block is in about half of the texts and any two texts differ in a block at least, so that
    # groups of some 16 share shingles without linking; the marks keep shingles within a block
    rng = random.Random(7)
    blocks = [" ".join(f"b{b}w{i}" for i in range(20)) for b in range(12)]
    picks = set()
    while len(picks) < 32:
        picks.add(tuple(sorted(rng.sample(range(12), 6))))
    rows = [" | | | | ".join(blocks[b] for b in pick) for pick in sorted(picks)]
    rows += [rows[3].replace("w19", "x19", 1), rows[30].replace("w0", "x0", 1)]
    table = [(i * 3, t) for i, t in enumerate(rows)]
    docs = llm_spark.createDataFrame(table, "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(docs).collect())
    assert got == brute_components(table) and len({r[2] for r in got}) == 32 and rounds.count("pairs") > 4


def test_near_duplicates_of_odd_rows(llm_spark):
    got = jaccard_join.jaccard_components(docs_of(llm_spark)).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got if r["doc_id"]) == [(1, 1), (2, 2), (3, 3), (3, 3), (4, 4), (5, 5)] and len(got) == 7
    assert jaccard_join.jaccard_components(docs_of(llm_spark).limit(0)).count() == 0


# 9 chats -------------------------------------------------------------------------------------


def test_chats_read_back_and_mask_exactly(llm_spark, vocabulary):
    nasty = ["\\", "\\\\", "<|endoftext|>", "<\\|", "a\n### user:<|x", "", " lead and trail ", "世界\n\n", "\\### Assistant: </turn> ok"]
    rows = [(i, j, role, text) for i, text in enumerate(nasty) for j, (role, text) in enumerate([("system:\n|", text), ("user", text), ("assistant", text), ("assistant", text + "!")])]
    rows += [(50, 0, None, None), (50, None, "assistant", "first"), (None, 1, "assistant", "no id"), (50, 0, "assistant", "tie"), (50, 0, "assistant", "tie")]
    table = llm_spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, ids string")
    got = {r["conv_id"]: r for r in chat.format_chats(table, vocabulary).collect()}
    for i in {r[0] for r in rows}:
        own = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == i), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))]
        assert chat.parse(got[i]["formatted"]) == own
        loss = "".join(chat.unescape(got[i]["formatted"][s["start"] : s["end"]]) for s in got[i]["spans"])
        assert loss == "".join(t for role, t in own if role == "assistant") and len(got[i]["ids"]) == len(got[i]["loss"])
    assert chat.format_chats(table.limit(0), vocabulary).count() == 0


# 10 personal data ----------------------------------------------------------------------------

BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute_base(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")), "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), k, kind, m.end()))
    return [(kind, s, e) for s, _, kind, e in sorted(out)]


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(8)
    for _ in range(3000):
        text = "".join(rng.choice(["a@b.c", "@", ".", "a", "%", "1", "25", "256", "1.2.3.4", "+1", "(5)", " ", "-", "4111111111111111", "555", "é", "007"]) for _ in range(rng.randrange(14)))
        assert pii.base_spans(list(pii.strict(text))) == brute_base(text), text
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_scanning_is_linear_on_long_runs():
    for run in ("a" * 300_000, "1" * 300_000, "a.b@" * 50_000, "+1(" * 50_000, "1." * 100_000):
        found = list(pii.strict(run))
        pii.candidates(run, found)


def test_boosted_trees_add_spans(llm_spark):
    rng = random.Random(6)
    rows = []
    for i in range(700):
        number = f"({rng.randrange(200, 999)}) {rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"
        rows.append((i, f"word word {rng.choice(['call +1 ' + number, 'sized 12 x 40', 'serial ' + str(rng.randrange(10**8)), 'mail a@b.org'])} and more"))
    extra = [(1000, "word word call (415) 555-2671 and more"), (1001, None), (1002, ""), (None, "a@b.org")]
    docs = llm_spark.createDataFrame([(*r, 1) for r in rows + extra], "doc_id long, text string, spans int")
    model = pii.fit(docs)
    found = {r["doc_id"]: r for r in pii.find(docs, model).collect()}
    assert found[1000]["base_spans"] == [] and [(s["kind"], s["start"]) for s in found[1000]["spans"]] == [("phone", 15)]
    assert found[1001]["spans"] == [] and [s["kind"] for s in found[None]["spans"]] == ["email"]
    text = {r["doc_id"]: r["text"] for r in pii.redact(docs, model).collect()}
    assert text[1000] == "word word call [PHONE] and more" and text[1001] is None and text[None] == "[EMAIL]"
    nothing = pii.fit(docs.limit(0))
    assert nothing.trees is None and pii.find(docs.limit(0), nothing).count() == 0


def test_copies_do_not_fill_the_training_sample(llm_spark, monkeypatch):
    monkeypatch.setattr(pii, "TRAIN_DOCS", 200)
    rng = random.Random(6)
    texts = []
    for _ in range(500):
        number = f"({rng.randrange(200, 999)}) {rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"
        texts.append(f"word word {rng.choice(['call +1 ' + number, 'serial ' + str(rng.randrange(10**8))])} and more")
    docs = llm_spark.createDataFrame([(t,) for t in texts], "text string")
    # the text with the smallest hash of all, without a candidate, in 1,000 copies
    plain = llm_spark.range(20_000).selectExpr("concat('plain ', id) AS text").orderBy("text").selectExpr("text", "xxhash64(text) AS h").orderBy("h").first()["text"]
    many = docs.unionByName(llm_spark.range(1000).selectExpr(f"'{plain}' AS text"))
    few, model = pii.fit(docs.unionByName(llm_spark.createDataFrame([(plain,)], "text string"))), pii.fit(many)
    assert model.trees is not None and model.thresholds == few.thresholds and (model.trees.leaf == few.trees.leaf).all()
    assert model.thresholds[pii.KINDS.index("phone")] <= 1


def test_loose_candidates_without_a_check_against_them_have_no_label():
    assert [x for x, _ in pii._labelled("call (415) 555-2671 now") if x[0] == pii.KINDS.index("phone")] == []
    assert [y for _, y in pii._labelled("on 2021-05-04 and 300.1.2.3")] == [0] * len(pii.candidates("on 2021-05-04 and 300.1.2.3", list(pii.strict("on 2021-05-04 and 300.1.2.3"))))
    rows = list(pii._labelled("call +1 (415) 555-2671 now"))
    assert [y for x, y in rows if x[0] == pii.KINDS.index("phone")] == [1, 1, 1] and [x[12] for x, _ in rows][:2] == [1.0, 0.0]


def test_overlaps_equal_a_comparison_with_every_span():
    rng = random.Random(3)
    for _ in range(300):
        spans = []
        for kind in pii.KINDS:
            at = 0
            for _ in range(rng.randrange(6)):
                s = at + rng.randrange(8)
                at = s + 1 + rng.randrange(8)
                spans.append((kind, s, at))
        taken = pii.Taken(spans)
        for s in range(40):
            for e in (s + 1, s + 5):
                assert taken.over(s, e) == {k for k, a, z in spans if a < e and s < z}


def test_many_spans_in_one_text(llm_spark):
    """Time limits are far above the linear time and far below a comparison of every two spans."""
    text = "+1 (415) 555-2671 a.b@c.org (at) 41 12 7 - " * 40_000
    begin = time.monotonic()
    labelled = list(pii._labelled(text))
    assert len(labelled) >= 160_000 and time.monotonic() - begin < 120
    docs = llm_spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    begin = time.monotonic()
    nothing = pii.Model(None, (2.0,) * len(pii.KINDS))
    got = {r["doc_id"]: r["text"] for r in pii.redact(docs, nothing).collect()}
    assert got == {1: "[PHONE] [EMAIL] (at) 41 12 7 - " * 40_000, 2: None, 3: ""} and time.monotonic() - begin < 60


def test_replaced_text_equals_marking_each_character():
    rng = random.Random(4)
    for _ in range(500):
        text = "".join(rng.choice("abé日") for _ in range(20))
        spans = sorted(((rng.choice(pii.KINDS), s, s + rng.randrange(1, 6)) for s in rng.sample(range(15), rng.randrange(4))), key=pii._by_place)
        covered = {i for _, s, e in spans for i in range(s, e)}
        # a run of touching spans that don't overlap has a mark for each
        out, end = "", -1
        for i, ch in enumerate(text):
            for kind, s, e in spans:
                if s == i:
                    out += "" if i < end else f"[{kind.upper()}]"
                    end = max(end, e)
            out += "" if i in covered else ch
        assert pii.replaced(text, spans) == out


def test_a_small_corpus_gets_trees_too(llm_spark):
    texts = [(f"call +1 (415) 555-{n} now on 2021-05-{n % 28}",) for n in range(1000, 1012)]
    assert pii.fit(llm_spark.createDataFrame(texts, "text string")).trees is not None


def test_thresholds_come_from_counts():
    counts = np.zeros((pii.STEPS + 1, 2), np.int64)
    counts[900] = 0, 95
    counts[700] = 5, 0
    counts[600] = 1, 0
    counts[300] = 0, 1000
    assert pii._threshold(counts) == 0.7 and pii._threshold(np.zeros_like(counts)) == 2.0


# queries and pipeline ------------------------------------------------------------------------


def test_shingle_sets_are_distinct_and_sorted():
    h, at = hashed(["a b c d e a b c d e", "x y", ""], NON_SPACE)
    s, bounds = row_sets(*shingle_hashes(h, at, 5))
    assert np.diff(bounds).tolist() == [5, 1, 0] and all((np.diff(s[a:z].astype(object)) > 0).all() for a, z in zip(bounds[:-1], bounds[1:], strict=True))


def test_pipeline_handles_odd_rows(llm_spark, sf_dir):
    pipeline = pytest.importorskip("corpus_pipeline")
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (None, "Some words without an id are here", "en", "s", 1), (3, "Same text twice in here", "en", "s", 1), (3, "Same text twice in here", "en", "s", 1), (4, "same text twice in here", "en", "s", 1)]
    docs = llm_spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in pipeline.STAGES:
        docs = stage(llm_spark, docs, sf_dir)
    assert sorted(r["doc_id"] or 0 for r in docs.collect()) == [0, 1, 2, 3]
