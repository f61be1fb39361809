"""Best position search, p-stable hashing and the filter audit against brute force on small tables."""

from __future__ import annotations

import math
import random
import re
from itertools import permutations

import numpy as np
import pytest

from podium.llm import bpa, pstable, tries
from podium.llm.graph import components

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# --------------------------------------------------------------------------- ranked search


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def _ranked(docs, items, k):
    terms = [(i, TERM.findall(_lower(t or ""))) for i, t in docs]
    held = [(i, ws) for i, ws in terms if ws]
    n, all_terms = len(held), sum(len(ws) for _, ws in held)
    df = {}
    for _, ws in held:
        for w in set(ws):
            df[w] = df.get(w, 0) + 1
    out = []
    for item, text in {(i, t) for i, t in items}:
        asked = set(TERM.findall(_lower(text or "")))
        scores = []
        for i, ws in held:
            m = 50 + (50 * len(ws) * n) // all_terms
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((1000000000 * ws.count(w)) // (1000 * ws.count(w) + 20 * m))
                    for w in asked if w in df and w in ws)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)] + ["Élan", "ÉLAN", "naïve", "x9", "日本"]
    weights = [1 / (i + 1) for i in range(len(words))]

    def prose(n):
        return rng.choice([" ", "-", ", "]).join(rng.choices(words, weights, k=n)).replace("w1", rng.choice(["w1", "W1"]))

    docs = [(i, prose(rng.randint(1, 60))) for i in range(300)]
    docs += [(300, None), (301, ""), (302, " .,; "), (303, prose(20000)), (None, docs[3][1]), docs[5], docs[5]]
    docs += [(i, docs[7][1]) for i in range(400, 440)]
    items = [(i, prose(rng.randint(1, 30))) for i in range(12)] + [(20, None), (21, ""), (22, "unseen"), (23, docs[7][1]), (None, "w2")]
    return docs, items + [items[0]]


@pytest.mark.parametrize("k", [1, 7, 50])
def test_ranked_search(spark, corpus, k, monkeypatch):
    docs, items = corpus
    d = spark.createDataFrame([(i, t, 1, "s", 0) for i, t in docs], "doc_id long, text string, n int, item string, score int").repartition(3)
    q = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, rank int")
    want = _ranked(docs, items, k)
    for block in (200_000, 20):  # one block of items, and many
        got = bpa.ranked(d, q, k, block_terms=block)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_ranked_search_of_empty_tables(spark, corpus):
    d = spark.createDataFrame(corpus[0], "doc_id long, text string")
    q = spark.createDataFrame(corpus[1], "item_id long, text string")
    assert bpa.ranked(d.limit(0), q).count() == 0
    assert bpa.ranked(d, q.limit(0)).count() == 0
    assert bpa.ranked(d.filter("doc_id = 300"), q).count() == 0


def test_best_positions_stop_early():
    """Over skewed lists the search ends long before it has read them, with the right answer."""
    rng = np.random.default_rng(2)
    n_docs, n_terms = 20000, 5
    term = np.tile(np.arange(n_terms), n_docs).astype(np.int32)
    impact = (1e6 / rng.pareto(1.0, n_docs * n_terms).clip(0.01) ** -1).astype(np.int64) + 1
    chunk = bpa.Chunk(np.arange(n_docs + 1) * n_terms, term, impact, n_terms)
    docs, scores = chunk.search(np.arange(n_terms), 10, np.full(n_terms, -1, np.int64))
    want = impact.reshape(n_docs, n_terms).sum(axis=1)
    assert len(docs) < n_docs / 4
    assert sorted(scores)[-10:] == sorted(want)[-10:]
    assert (want[docs] == scores).all()


# --------------------------------------------------------------------------- near vectors


def _near(rows, cosine=0.98):
    ok = {}
    for i, (_, v, label) in enumerate(rows):
        if label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        top = max(map(abs, v))
        u = np.asarray(v) / top
        ok[i] = (label, u / np.sqrt(u @ u))
    links = {i: [j for j in ok if j != i and ok[i][0] == ok[j][0] and len(ok[i][1]) == len(ok[j][1])
                 and ok[i][1] @ ok[j][1] >= cosine] if i in ok else [] for i in range(len(rows))}
    out = []
    for i, (key, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((key, len(links[i]), low, key is not None and key == low))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    rows = []
    for g in range(25):  # groups of near vectors around a centre, some chained
        c = rng.standard_normal(24)
        for _ in range(rng.integers(1, 9)):
            v = c + rng.standard_normal(24) * rng.choice([0.02, 0.08, 0.14])
            rows.append((v * rng.choice([1, 1e-200, 1e200])).tolist())
    rows += [rows[0], rows[0], [2 * x for x in rows[1]], [-0.0] * 24, [0.0] * 24, [], None, [None] * 24, [float("nan")] * 24,
             [float("inf")] + [1.0] * 23, [5e-324] * 24, [1.0, 2.0], [1.0, 2.01], [1.0]]
    out = [(i, v, int(rng.integers(0, 2)) if i % 11 else None) for i, v in enumerate(rows)]
    return out + [out[1], (None, rows[1], out[1][2]), (None, None, None)]


def test_near_vectors(spark, vectors):
    df = spark.createDataFrame([(i, v, label, 1, "k", 2) for i, v, label in vectors],
                               "vec_id long, embedding array<double>, label int, node int, key string, n int").repartition(3)
    got = pstable.near_vectors(df)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == _near(vectors)
    assert pstable.near_vectors(df.limit(0)).count() == 0


def test_near_vectors_in_blocks(spark, monkeypatch):
    """A bucket of many vectors is compared in blocks, with the counts and components of one block."""
    rng = np.random.default_rng(9)
    c = rng.standard_normal(16)
    rows = [(i, (c + rng.standard_normal(16) * 0.11).tolist(), 3) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(pstable, "BLOCK", 16)
    assert sorted((tuple(r) for r in pstable.near_vectors(df).collect()), key=str) == _near(rows)


def test_collisions_as_the_theory_says():
    """Pairs at exactly the threshold share at least one table in all but a few of ten thousand cases."""
    rng = np.random.default_rng(1)
    a = rng.standard_normal((4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((4000, 64))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    near = 0.98 * a + math.sqrt(1 - 0.98 ** 2) * b
    ka, kn, kb = map(pstable.bucket_keys, (a, near, b))
    assert (ka == kn).any(axis=1).mean() > 0.998
    assert (ka == kb).mean() < 1e-4


def test_components_of_chains_and_no_links(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (103, 102), (5, 5), (101, 100)]
    got = {r.h: r.c for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 102, 103: 102}
    none = spark.createDataFrame([], "a long, b long")
    assert components(none).count() == 0
    with pytest.raises(RuntimeError):
        components(spark.createDataFrame(links, "a long, b long"), rounds=1)


# --------------------------------------------------------------------------- filter audit


def _mask(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return (len(words) < 200) + 2 * (100 * len(set(words)) < 50 * len(words)) + 4 * (100 * len(re.findall("[A-Z]", text)) > 3 * len(text)) \
        + 8 * bool(re.search(r"[#$%&*|]", text))


def _audit(docs, labels):
    low = {}
    for i, t, _ in docs:
        if i is not None and (t or "") not in low or i is not None and i < low[t or ""]:
            low[t or ""] = i
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, x in labels if x == 1}
    rows = [(p or "", _mask(t or "") + 16 * (i is not None and i > low[t or ""]), i) for i, t, p in docs]
    out = []
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        removed = {}
        for order in permutations(range(5)):
            gone, name = set(), "".join("ABCDE"[f] for f in order)
            for step, f in enumerate(order, 1):
                fails = {n for n, r in enumerate(own) if r[1] >> f & 1}
                now = fails - gone
                ids = [own[n][2] for n in now]
                out.append([part, name, step, len(own) - len(gone | now), len(now), len(fails & gone),
                            sum(own[n][1] == 1 << f for n in fails), sum(i in good for i in ids), sum(i in toxic for i in ids)])
                removed[f] = removed.get(f, 0) + len(now)
                gone |= now
        for r in out:
            if r[0] == part and len(r) == 9:
                r.append(removed["ABCDE".index(r[1][r[2] - 1])])
    return sorted(map(tuple, out))


@pytest.fixture(scope="module")
def filtered():
    rng = random.Random(12)
    words = [f"t{i}" for i in range(400)]
    texts = [None, "", " \t\n", "A B", "#", "ÀÉ ok", "A" * 50, "x " * 300, "same text " * 120]
    texts += [" ".join(rng.choice(words) for _ in range(rng.choice([20, 199, 200, 350]))) for _ in range(40)]
    texts += [texts[12] + s for s in ("", "a", "b", " tail", "ab")] + [texts[14][:100], "Zażółć " * 210]
    docs = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(400)]
    docs += [docs[3], docs[3], (None, docs[3][1], "en"), (None, "only here", None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 400, 3)] + [(0, 1, 1), (None, 1, 1), (999, 1, 1)]
    return docs, labels


def test_filter_audit(spark, filtered, monkeypatch):
    docs, labels = filtered
    d = spark.createDataFrame([(i, t, p, 1, 2, "x") for i, t, p in docs],
                              "doc_id long, text string, lang string, n int, mask int, part string").repartition(4)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = _audit(docs, labels)
    cols = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    # as in production; and with tries of a few texts, short ranges and prefixes that must grow
    for local, span, lengths in ((None, None, None), (2000, 500, (1, 2, 4, 64))):
        if local:
            monkeypatch.setattr(tries, "LOCAL_BYTES", local)
            monkeypatch.setattr(tries, "RANGE_BYTES", span)
            monkeypatch.setattr(tries, "PREFIX_BYTES", lengths)
        got = tries.audit(d, lab)
        assert got.columns == cols
        assert sorted(tuple(r) for r in got.collect()) == want
    assert tries.audit(d.limit(0), lab).count() == 0
    assert tries.audit(d, lab.limit(0)).filter("good_lost + toxic_lost > 0").count() == 0


def test_trie_holds_whole_texts():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 9))).encode() for _ in range(500)]
    trie, low = tries.Trie(), {}
    for key, text in enumerate(texts):
        assert trie.add(text, 500 - key, key) == (text not in low)
        low[text] = 500 - key
    assert {t: (k, len(rows)) for t, k, rows in trie.terminals()} == {t: (low[t], texts.count(t)) for t in low}
