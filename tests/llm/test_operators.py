"""Operators against brute force on small tables: nulls, empty and long texts, ties, repeated rows, no rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from podium.llm import ann, fingerprint, html, jaccard, mixing, packing, pii, sharding, tokens, toxicity
from podium.llm.common import tokenizer_path

SCHEMA = "doc_id bigint, text string, lang string, source string, shard int, score double, epoch int, h bigint"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeghilmnorstu") for _ in range(rng.randint(2, 9))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    base = prose(120)
    near = base.split()
    near[60] = "changed"
    texts = [None, "", " \n ", "one two", base, base, " ".join(near), prose(300), prose(9000), "x" * 3000,
             "Mail a.b@c.org, 10.0.0.1 or 999.1.1.1; +1 (583) 555-1341. card 4111 1111 1111 1111 no 4111 1111 1111 1112",
             "It's <|endoftext|> naïve Œuvre ﬁn 你好 \t tab", "É" * 10 + " été, ÇA. " * 40]
    texts += [prose(rng.randint(1, 400)) for _ in range(30)]
    out = [(i, t, rng.choice(["en", "de", None]), f"src{i % 5}" if i % 7 else None, 1, 0.5, 1, 1) for i, t in enumerate(texts)]
    return out + [out[4], out[7], (None, base, "en", "src1", 1, 0.5, 1, 1), (None, None, None, None, 1, 0.5, 1, 1)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_fingerprints(docs, none, rows):
    got = fingerprint.fingerprint_documents(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])
    text = {r[0]: r[1] or "" for r in order}
    for i in range(12, 40):  # ids without repeated rows
        x, y = text[i], text[i + 1]
        edited = x[:len(x) - len(x) // 2] + y[:len(x) // 2]
        assert by_id[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert by_id[4].fingerprint == by_id[5].fingerprint and by_id[4].fingerprint != by_id[7].fingerprint
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprint.fingerprint_documents(none).collect() == []


def test_toxicity(spark, docs, none):
    rng = random.Random(5)
    common = ["".join(rng.choice("abcdeghilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    texts = []
    for i in range(600):
        t = [rng.choice(common) for _ in range(80)]
        if i % 3 == 0:
            t[rng.randrange(80)] = "vilemonger"
            t[rng.randrange(80)] = "scumwretch,"
        texts.append((i, " ".join(t), int(i % 3 == 0)))
    table = spark.createDataFrame(texts, "doc_id bigint, text string, toxic int")
    labels = table.select("doc_id", "toxic")
    model = toxicity.fit(table.select("doc_id", "text"), labels, F.col("doc_id") < 450)
    got = {r.doc_id: r for r in toxicity.score(table, model).collect()}
    held = [(r[2], got[r[0]].predicted) for r in texts if r[0] >= 450]
    assert sum(a == b for a, b in held) / len(held) > 0.9
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, model).collect())
    assert toxicity.score(none, model).collect() == []
    assert toxicity.reject(docs, model, 0.9).columns == docs.columns
    flat = toxicity.fit(table.select("doc_id", "text"), labels.limit(0), F.lit(True))
    assert len({round(r.score, 9) for r in toxicity.score(docs, flat).collect()}) == 1


def test_toxicity_behind_a_long_head(spark):
    rng = random.Random(6)
    common = ["".join(rng.choice("abcdeghilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    texts = []
    for i in range(200):
        t = [rng.choice(common) for _ in range(4500)]  # more than 20,000 characters
        if i % 4 == 0:
            t[-40:-10:10] = ["vilemonger", "scumwretch,", "vilemonger"]
        texts.append((i, " ".join(t), int(i % 4 == 0)))
    assert min(len(t[:t.find("vilemonger")]) for _, t, y in texts if y) > 20_000
    table = spark.createDataFrame(texts, "doc_id bigint, text string, toxic int").repartition(8)
    model = toxicity.fit(table.select("doc_id", "text"), table.select("doc_id", "toxic"), F.col("doc_id") < 140)
    got = {r.doc_id: r.predicted for r in toxicity.score(table.filter("doc_id >= 140"), model).collect()}
    assert sum(got[i] == y for i, _, y in texts if i >= 140) >= 57


def test_packing(docs, none, rows):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    got = packing.pack(docs).collect()
    want = {}
    for r in rows:
        want.setdefault(r[0], []).append(tok.encode(r[1] or "", add_special_tokens=False).ids + [2])
    total = sum(len(x) for v in want.values() for x in v)
    assert sum(r.length for r in got) == total
    windows = {}
    for r in got:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
        ids = [x for x in want[r.doc_id] if len(x) == r.doc_tokens]
        assert any(zlib.crc32(np.asarray(x[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for x in ids)
    for pieces in windows.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= 4096
    assert packing.pack(none).collect() == []


def test_packing_fills_windows_however_the_input_is_cut(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdeghilmnorstué") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 400))) for _ in range(900)]
    texts[5] = " ".join(rng.choice(words) for _ in range(9000))  # several windows by itself
    want = {i: tok.encode(t, add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}
    least = -(-sum(map(len, want.values())) // 512)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for parts in (2, 60):  # a window of 512 tokens, so that there are hundreds of them
        got = packing.pack(table.repartition(parts, "doc_id"), capacity=512, with_ids=True).collect()
        windows, back = {}, {}
        for r in got:
            windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
            back.setdefault(r.doc_id, []).append((r.start, list(r.token_ids)))
            assert len(r.token_ids) == r.length and r.doc_tokens == len(want[r.doc_id])
        assert {d: [x for _, ids in sorted(p) for x in ids] for d, p in back.items()} == want
        for pieces in windows.values():
            assert [o for o, _ in sorted(pieces)] == [0, *np.cumsum([n for _, n in sorted(pieces)])[:-1]]
            assert sum(n for _, n in pieces) <= 512
        assert least <= len(windows) <= least * 1.015 + 1


def test_differencing_is_near_equal():
    rng = random.Random(1)
    sizes = [rng.randint(1, 4000) for _ in range(300)]
    parts = packing.differencing(sizes, 20)
    assert sorted(i for p in parts for i in p) == list(range(300))
    sums = [sum(sizes[i] for i in p) for p in parts]
    assert max(sums) - min(sums) < 200
    assert packing.differencing([], 3) == [[], [], []]
    assert packing.differencing([5], 1) == [[0]]


def test_mixing(spark, docs, none):
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    got = mixing.mix(docs, levels, {"lang": {"en": 3}}, (3, 4), 2)
    assert got.columns == [*docs.columns, "mix_epoch"]
    spent = got.select(F.sum(mixing.token_estimate(F.col("text")))).first()[0]
    have = docs.select(F.sum(mixing.token_estimate(F.col("text")))).first()[0]
    assert 0 < spent <= have * 3 // 4
    assert mixing.mix(none, levels, {}, (1, 2)).collect() == []
    # shortages: siblings first, then the parent's siblings
    leaves = spark.createDataFrame([("a", "x", 10), ("a", "y", 100), ("b", "z", 20)], "p string, q string, avail bigint")
    share = {r.q: r.share for r in mixing.leaf_budgets(leaves, ["p", "q"], {}, F.lit(100), 1).collect()}
    assert share == {"x": 10, "y": 70, "z": 20}


def test_html():
    page = ("<html><head><title>t</title><style>p{}</style></head><body><nav><a href='/'>Home</a></nav>"
            "<div class='cookie-notice'>We use the cookies of this site and that is it for you.</div>"
            "<article><h1>A &amp; B</h1><p>This is the   story of a man and it was <b>told</b> by the sea.<p>Yes.</p>"
            "<script>var x='<p>no</p>'</script></article><div id='comments'><p>I think that this is the best of all.</p></div>"
            "<footer>&copy; 2020</footer></body></html>")
    assert html.main_text(page) == "A & B\n\nThis is the story of a man and it was told by the sea.\n\nYes."
    assert html.main_text("") == "" and html.main_text("<p") == "" and html.main_text("a < b") is not None


def test_html_of_odd_markup_and_other_languages():
    three = "<article><p class=it's>One of the first.</p><p>Don't stop.</p><p title='a > b'>Third > second.</p></article>"
    assert html.main_text(three) == "One of the first.\n\nDon't stop.\n\nThird > second."
    assert html.main_text("<body><p>Short one.</p><p>Short two.</p></body>") == "Short one.\n\nShort two."
    chinese = "这是一个没有空格的段落，它讲述了一个关于春天和河流的故事，文字足够长，可以被认作正文，而不是菜单或者页脚的一部分。"
    page = f"<nav><a href=/x/>首页</a></nav><div><a href='/a'>更多</a> <a href='/b'>链接</a></div><p>{chinese}</p><p>{chinese}</p>"
    assert html.main_text(page) == f"{chinese}\n\n{chinese}"
    polish = "Wczoraj wieczorem poszliśmy nad rzekę, żeby zobaczyć stare łodzie rybackie przy moście."
    assert html.main_text(f"<div class=menu>Start Oferta</div><p>{polish}</p>") == polish
    assert html.main_text("<p>see <a href=/x/>the page</a> of the day and all that is in it for you</p>") \
        == "see the page of the day and all that is in it for you"
    assert html.main_text("<ul><li><a href='/1'>One</a></li><li><a href='/2'>Two</a></li></ul>") == ""


def test_pages(spark):
    t = spark.createDataFrame([(1, "u", None), (1, "u", None), (None, None, "<article><p>Hi.</p>")],
                              "page_id bigint, url string, html string")
    assert sorted((r.text, r.n_chars) for r in html.extract_pages(t).collect()) == [("", 0), ("", 0), ("Hi.", 3)]
    assert html.extract_pages(t.limit(0)).collect() == []


def test_token_counts(docs, none, rows):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    want = sorted((r[0] if r[0] is not None else -1, len(tok.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)
    for chunk, overlap in ((32_768, 256), (400, 40)):  # the second splices all but the shortest
        got = tokens.count_tokens(docs, chunk=chunk, overlap=overlap).collect()
        assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens) for r in got) == want
    assert tokens.count_tokens(none).collect() == []


def test_sharding(docs, none, rows):
    got = sharding.shard_by_size(docs, 5).collect()
    assert len(got) == len(rows)
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert sharding.shard_by_size(none, 5).collect() == []


def test_near_duplicates(docs, none, rows):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])

    ids = sorted({r[0] for r in rows if r[0] is not None})
    sets = {r[0]: shingles(r[1]) for r in rows}
    root = {i: i for i in ids}
    for i in ids:  # links of this fixture are direct: the smallest linked id is the component
        for j in ids:
            n = len(sets[i] & sets[j])
            if n and 100 * n >= 80 * len(sets[i] | sets[j]):
                root[i] = min(root[i], j)
    got = jaccard.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert all(r.component_id == root[r.doc_id] and r.n_shingles == len(sets[r.doc_id]) for r in got if r.doc_id is not None)
    assert jaccard.near_duplicates(none).collect() == []


def test_large_groups_send_a_pair_a_record(spark, monkeypatch):
    """Records that link with many of a large component send one pair in the first round; no link is lost."""
    rng = np.random.default_rng(5)
    base = rng.integers(1, 2**63, 100, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[k:], rng.integers(1, 2**63, k, dtype=np.uint64)])) for k in [0] * 40 + [8] * 40]
    n, h = np.asarray([len(x) for x in sets]), np.arange(80)
    c = np.where(h < 40, 0, h)
    args = h, c, n, [jaccard.sketch(x) for x in sets], None
    every = set(jaccard.many_pairs(*args, 80))
    some, others = jaccard.sought_pairs(*args, h % 2 == 0, 80)
    assert len(every) > 1000 and others and len(some) == 20 and set(some) <= every and all(a < 40 for a, _ in some)
    assert jaccard.sought_pairs(h, 0 * c, *args[2:], h >= 0, 80) == ([], False)

    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words[i * 4:i * 4 + 60]) for i in range(30)] + [" ".join(words[:60]) + f" tail{i}" for i in range(30)]
    monkeypatch.setattr(jaccard, "FEW", 2)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    got = jaccard.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    sh = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    want = list(range(60))
    for _ in range(60):
        for i in range(60):
            for j in range(60):
                if 100 * len(sh[i] & sh[j]) >= 80 * len(sh[i] | sh[j]):
                    want[i] = want[j] = min(want[i], want[j])
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(want))


def test_signatures_with_the_same_records_are_compared_once(spark, monkeypatch):
    """Documents that share a passage share many signatures; their records, with bitmaps, were sent once for each."""
    seen, write = {}, jaccard.materialise
    monkeypatch.setattr(jaccard, "materialise", lambda df, name: seen.setdefault((name, len(seen)), write(df, name)))
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [passage + " " + " ".join(f"own{d}x{i}" for i in range(60)) for d in range(6)]
    got = jaccard.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert all(r.component_id == r.doc_id for r in got)
    held = {name: df for (name, _), df in seen.items()}
    assert held["buckets"].select("sig").distinct().count() > 2
    assert held["apart-1"].groupBy("h").count().agg({"count": "max"}).first()[0] == 1


def test_records_to_compare_hold_every_open_pair(spark):
    rng = np.random.default_rng(6)
    sizes, comps = rng.integers(20, 60, 60).tolist(), rng.integers(0, 25, 60).tolist()
    groups = [sorted(rng.choice(60, rng.integers(1, 9), replace=False).tolist()) for _ in range(60)]
    groups += groups[:30] + [g[:-1] for g in groups[20:50]]
    rows = [(s, h, sizes[h], comps[h]) for s, g in enumerate(groups) for h in g]

    def pairs(rows):
        of = {}
        for s, h in rows:
            of.setdefault(s, []).append(h)
        return {(a, b) for g in of.values() for a in g for b in g if a < b and comps[a] != comps[b]
                and min(sizes[a], sizes[b]) * 100 >= 80 * max(sizes[a], sizes[b])}

    table = spark.createDataFrame(rows, "sig long, h long, n long, c long").repartition(5)
    got = jaccard._to_compare(table, None, 80).collect()
    assert pairs([(r.sig, r.h) for r in got]) == pairs([(s, h) for s, h, _, _ in rows])
    assert all((r.n, r.c) == (sizes[r.h], comps[r.h]) for r in got)
    held = {}
    for r in got:
        held.setdefault(r.sig, set()).add(r.h)
    assert len(set(map(frozenset, held.values()))) == len(held) and all(r.g == len(held[r.sig]) for r in got)
    nested = [(1, 1, 40, 1), (1, 2, 40, 2), (1, 3, 40, 3), (2, 1, 40, 1), (2, 2, 40, 2), (3, 1, 40, 1), (3, 2, 40, 2), (3, 3, 40, 3)]
    assert len(jaccard._to_compare(spark.createDataFrame(nested, table.schema), None, 80).collect()) == 3
    some = spark.createDataFrame([(s,) for s in range(0, len(groups), 2)], "sig long")
    part = jaccard._to_compare(table, some, 80).collect()
    assert pairs([(r.sig, r.h) for r in part]) == pairs([(s, h) for s, h, _, _ in rows if s % 2 == 0])


def test_wanted_rows_are_all_kept(spark, monkeypatch):
    """Before a join with few keys most other rows go; none that is wanted, whatever the keys are and however small the filter."""
    rows = spark.range(5000).selectExpr("if(id % 7 = 0, NULL, id) AS k", "cast(id AS string) AS t")
    for most in (25, 10):
        monkeypatch.setattr(jaccard, "MOST_BITS", most)
        for col, keys in (("k", rows.filter("k % 50 = 1").select("k")), ("t", rows.filter("t LIKE '%33'").selectExpr("t AS u"))):
            got = {r[col] for r in jaccard._wanted(rows, col, keys).collect()}
            assert {r[0] for r in keys.collect()} <= got and len(got) < 1000
    assert jaccard._wanted(rows, "k", rows.limit(0).select("k")).collect() == []


def test_shingles_of_odd_words():
    """Sets of hashes are as large, and share as much, as sets of words: long, empty, with null bytes, any white space."""
    rng = np.random.default_rng(4)
    pool = ["a", "A", "\0", "\0\0", "é", "É", "\u00a0", "\ud800", "x" * 8, "x" * 9, "X" * 64, "x" * 65, "x" * 66, "\x1c", "12345678", "123456789"]
    texts = [None, "", " \t\n", *pool] + ["".join(w + s for w, s in zip(rng.choice(pool, n), rng.choice(list(" \t\n\v\f\r"), n)))
                                         for n in rng.integers(1, 40, 60)]

    def plain(t):
        w = (t or "").encode("utf-8", "surrogatepass").lower().split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()

    want, got = [plain(t) for t in texts], [jaccard.shingle_set(t) for t in texts]
    for a, x in zip(want, got):
        assert len(a) == len(x) and (np.diff(x.astype(object)) > 0).all()
        assert all(len(a & b) == len(np.intersect1d(x, y)) for b, y in zip(want, got))
    words = [w.encode("utf-8", "surrogatepass").lower() for w in pool]
    assert len(set(jaccard.word_hashes(b" ".join(words)).tolist())) == len(set(words))


def test_stars_need_no_step(spark, monkeypatch):
    """Links that are stars already are written once; before, a step more was run to see that nothing changes."""
    from podium.llm import graph
    written, write = [], graph.materialise
    monkeypatch.setattr(graph, "materialise", lambda df, name: (written.append(name), write(df, name))[1])
    links = [(1, i) for i in range(2, 9)] + [(20, 11), (11, 30), (4, 4)]
    got = {r.h: r.c for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 9)}, 11: 11, 20: 11, 30: 11} and written == ["links"]
    chain = graph.components(spark.createDataFrame([(i, i + 1) for i in range(9)], "a long, b long"))
    assert {r.c for r in chain.collect()} == {0} and "stars" in written


def test_signatures_meet_for_linked_sets():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(4, 400))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        cut = rng.permutation(a)[:max(1, len(a) - len(a) // 9)]
        b = np.unique(np.concatenate([cut, rng.integers(0, 2**63, len(a) // 18, dtype=np.uint64)]))
        if not jaccard.linked(a, b):
            continue
        often = np.sort(rng.permutation(np.union1d(a, b))[:int(rng.integers(0, 2 * n))])
        assert len(np.intersect1d(jaccard.signatures(a, often), jaccard.signatures(b, often))) or np.array_equal(a, b)
        x, y = np.frombuffer(jaccard.sketch(a), np.uint8), np.frombuffer(jaccard.sketch(b), np.uint8)
        assert jaccard.may_link(x, len(a), y[None, :], np.asarray([len(b)]))[0]


def test_personal_data(docs, none, rows):
    got = {r.doc_id: r for r in pii.report(docs).collect()}
    t = rows[10][1]
    spans = [("email", m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    assert (got[10].n_email, got[10].n_ip, got[10].n_card, got[10].n_phone) == (1, 1, 1, 1)
    assert got[10].spans.startswith(f"email:{spans[0][1][0]}:{spans[0][1][1]},ip:")
    masked = {r.doc_id: r.text for r in pii.mask(docs).collect()}
    assert "[EMAIL], [IP] or 999.1.1.1; [PHONE]. card [CARD] no 4111" in masked[10] and masked[7] == rows[7][1]
    assert pii.report(none).collect() == []


def test_personal_data_in_copied_templates(spark):
    texts = [f"The hotline +1 (583) 555-{1000 + 7 * i} is open" for i in range(8)] \
        + [f"and server 10.0.3.{i} up" for i in range(8)] \
        + ["The hotline 030/5551234 is open", "and server 10.0.0.4 10.0.0.999, up", "and page 030/5551234 up"]
    copied = [(j * 100 + i, t) for j in range(5) for i, t in enumerate(texts)]
    t = spark.createDataFrame(copied, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r for r in pii.report(t).collect()}
    assert len(got) == len(copied)
    for j in range(0, 500, 100):
        assert all(got[j + i].n_added == 0 for i in range(16)) and got[j + 18].n_added == 0
        assert (got[j + 16].spans, got[j + 16].n_added) == ("phone:12:23", 1)
        assert (got[j + 17].spans, got[j + 17].n_added) == ("ip:11:19,ip:20:30", 1)
    masked = {r.doc_id: r.text for r in pii.mask(t).collect()}
    assert masked[16] == "The hotline [PHONE] is open" and masked[417] == "and server [IP] [IP], up"


def test_nearest(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((300, 16))
    x[50:60] = x[0]
    data = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (950, [0.0] * 16), (1000, [float("nan")] * 16)]
    t = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    got = {}
    for r in ann.nearest(t, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 300, 50):
        s = np.round(u @ u[q], 12)
        s[q] = -9
        want = np.lexsort((np.arange(300), -s))[:5].tolist()
        hits += len(set(want) & set(got[q].values()))
    assert hits >= 27 and set(got) == set(range(0, 300, 50))
    assert got[0] == {1: 50, 2: 51, 3: 52, 4: 53, 5: 54}
    assert ann.nearest(t.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_nearest_of_every_length_and_size(spark):
    """Vectors of a rarer length have neighbours too; 1e-200 and 1e200 are vectors like any other."""
    rng = np.random.default_rng(5)
    four, two = rng.standard_normal((40, 4)), rng.standard_normal((8, 2))
    four[7] *= 1e-200
    four[8] *= 1e200
    data = [(i, v.tolist()) for i, v in enumerate(four)] + [(100 + i, v.tolist()) for i, v in enumerate(two)] + [(200, [5e-324, 0.0])]
    t = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    got = {}
    for r in ann.nearest(t, F.col("vec_id") >= 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {i for i, _ in data}
    unit = {i: np.asarray(v) / np.abs(v).max() for i, v in data}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    for q, rows in got.items():
        near = sorted((-round(float(unit[q] @ v), 9), i) for i, v in unit.items() if i != q and len(v) == len(unit[q]))[:5]
        assert [(round(-s, 9)) for _, _, s in sorted(rows)] == [s for s, _ in near]


def test_search_ends_only_without_open_candidates(spark):
    n = 14  # a path that a search must walk node by node
    angle = np.linspace(0, 1.5, n)
    codes = [c.tobytes() for c in ann._code(np.column_stack([np.cos(angle), np.sin(angle)]))]
    graph = spark.createDataFrame([(i, codes[i], [(i + 1, codes[i + 1])] if i + 1 < n else None) for i in range(n)],
                                  "u bigint, x binary, near array<struct<w:bigint,x:binary>>")
    entries = spark.createDataFrame([(0, codes[-1], 0)], "q bigint, x binary, w bigint")
    held = {r.w for r in ann._greedy(graph, entries, beam=3, expand=1).collect()}
    assert held == {n - 1, n - 2, n - 3}
