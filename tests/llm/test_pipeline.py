"""Stages of the corpus pipeline on odd rows and empty tables, and the whole run, against plain Python."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from podium.llm import toxicity
from podium.llm.common import table
from podium.llm.queries import held_out

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
BASE = " ".join(f"word{i}" for i in range(60))
ROWS = [(1, BASE, "en", "src1", len(BASE)), (2, BASE, "de", "src2", len(BASE)), (3, BASE + " more", None, None, 5), (4, None, "en", "src1", None),
        (5, "", "en", "src1", 0), (6, "", "fr", "src3", 0), (7, "Mail a@b.org now", "en", "src0", 16), (7, "Mail a@b.org now", "en", "src0", 16),
        (None, BASE, "en", "src1", 1), (None, "alone", "en", "src1", 5), (None, "alone", "en", "src1", 5), (9, "x" * 5000, "es", "src9", 5000)]


def _sets(text):
    words = re.sub("[A-Z]", lambda m: m.group().lower(), text or "").split()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4)) if len(words) > 4 else frozenset([tuple(words)] if words else [])


def _kept(rows):
    """Smallest id of each group of links, and rows without an id; each different text of an id once."""
    ids = {i: _sets(t) for i, t, *_ in rows if i is not None}
    group = {i: {i} for i in ids}
    for a in ids:
        for b in ids:
            if ids[a] and ids[b] and 100 * len(ids[a] & ids[b]) >= 80 * len(ids[a] | ids[b]) and group[a] is not group[b]:
                group[a] |= group[b]
                for x in group[b]:
                    group[x] = group[a]
    return {(i, t) for i, t, *_ in rows if i is None or i == min(group[i])}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def test_near_duplicate_stage(spark, sf, docs):
    got = P.drop_near_duplicates(spark, docs, sf)
    assert got.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == _kept(ROWS)


def test_personal_data_stage(spark, sf, docs):
    got = P.mask_personal_data(spark, docs, sf)
    assert got.columns == docs.columns and got.count() == len(ROWS)
    seven = got.filter("doc_id = 7").collect()
    assert {(r.text, r.n_chars) for r in seven} == {("Mail [EMAIL] now", 16)} and len(seven) == 2
    same = {(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in got.filter("doc_id <> 7 OR doc_id IS NULL").collect()}
    assert same == {r for r in ROWS if r[0] != 7}


def test_mixing_stage(spark, sf, docs):
    got = P.mix_sources(spark, docs, sf)
    assert got.columns == docs.columns
    assert {tuple(r) for r in got.collect()} <= set(ROWS)
    # columns whose names the plan uses inside are kept
    more = docs.withColumns({c: F.lit(7) for c in ("rest", "whole", "stop", "share", "avail", "key", "run", "cap", "budget")})
    from podium.llm import mixing
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    mixed = mixing.mix(more, levels, {"lang": {"en": 3}}, (3, 4), 2)
    assert mixed.columns == [*more.columns, "mix_epoch"]
    assert sorted(map(str, mixed.select(*docs.columns, "mix_epoch").collect())) == \
        sorted(map(str, mixing.mix(docs, levels, {"lang": {"en": 3}}, (3, 4), 2).collect()))


def test_packing_stage_keeps_ids(spark, sf):
    big = 9007199254740993  # no double holds it
    docs = spark.createDataFrame([(big, "a b c", None, None, 5), (None, "d", None, None, 1), (big + 1, None, None, None, None)], SCHEMA) \
        .coalesce(1)
    assert sorted(str(r.doc_id) for r in P.pack_sequences(spark, docs, sf).collect()) == sorted(["None", str(big), str(big + 1)])


def test_large_ids_beside_null_ids(spark):
    """An id that no double holds comes back as it is, and so do ids of text."""
    from podium.llm import jaccard, tokens
    big = 9007199254740993
    for ids, kind in (([big, None, big + 1], "bigint"), (["b", None, "a"], "string")):
        docs = spark.createDataFrame([(ids[0], BASE), (ids[1], "x"), (ids[2], BASE)], f"doc_id {kind}, text string").coalesce(1)
        assert {r.doc_id for r in tokens.count_tokens(docs).collect()} == set(ids)
        near = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()}
        low = min(ids[0], ids[2])
        assert near == {ids[0]: low, None: None, ids[2]: low}


def test_toxicity_stage(spark, sf):
    docs = table(spark, sf, "documents")
    got = P.drop_toxic(spark, docs, sf)
    assert got.columns == docs.columns
    model = toxicity.fit(docs, table(spark, sf, "labels"), ~held_out())
    want = {r.doc_id for r in toxicity.score(docs, model).filter(F.col("score") < P.TOXIC).collect()}
    assert {r.doc_id for r in got.collect()} == want


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES[1:]])
def test_empty_tables(spark, sf, docs, name):
    assert dict(P.STAGES)[name](spark, docs.limit(0), sf).count() == 0


def test_whole_run(spark, sf):
    """Each stage reads what the one before wrote; what comes out packs every token of the mixed documents once."""
    docs, before = table(spark, sf, "documents"), None
    for name, stage in P.STAGES:
        before, docs = docs, stage(spark, docs, sf).persist()
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and 0 < docs.count() <= 2 * before.count()
    got = sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in P.run(spark, sf).collect())
    assert got == sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in docs.collect())
    assert {r[0] for r in got} == {r.doc_id for r in before.collect()}
