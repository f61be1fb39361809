"""Registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm import (ann, bpa, fingerprint, html, jaccard, mixing, packing, pii, pstable, sharding, tokens, toxicity,
                        tries)
from podium.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return register


def held_out(id_col: str = "doc_id"):
    """The fold that a classifier must not learn from."""
    return F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 4 == 2


@query("op1_fingerprints")
def q_fingerprints(spark, d):
    return fingerprint.fingerprint_documents(table(spark, d, "documents"))


@query("op2_toxicity")
def q_toxicity(spark, d):
    docs = table(spark, d, "documents")
    model = toxicity.fit(docs, table(spark, d, "labels"), ~held_out())
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


@query("op3_packing")
def q_packing(spark, d):
    return packing.pack(table(spark, d, "documents"))


@query("op5_html")
def q_html(spark, d):
    return html.extract_pages(table(spark, d, "pages"))


@query("op6_token_counts")
def q_token_counts(spark, d):
    return tokens.count_tokens(table(spark, d, "documents"))


@query("op7_sharding")
def q_sharding(spark, d):
    return sharding.shard_by_size(table(spark, d, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op8_near_duplicates")
def q_near_duplicates(spark, d):
    return jaccard.near_duplicates(table(spark, d, "documents"))


#: Target weights of the mix (1 for what is not listed) and its size in tokens of all.
MIX_WEIGHTS = {"domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
               "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}, "source": {}}
MIX_BUDGET = (3, 5)
MIX_EPOCHS = 2


def mix_levels():
    """domain - language - source; a source's trailing number names its domain."""
    number = F.regexp_extract("source", "([0-9]+)$", 1)
    return {"domain": F.when(number != "", F.concat(F.lit("domain"), (number.cast("int") % 4).cast("string"))),
            "lang": F.col("lang"), "source": F.col("source")}


def _fill_sql(source: str, parents: str, name: str) -> str:
    """The sharing of one level in SQL."""
    over = f"PARTITION BY {parents}"
    ratio = f"{over} ORDER BY CAST(cap AS DOUBLE) / w, {name}"
    return f"""
    SELECT *, share0 + CASE WHEN NOT "full" AND row_number() OVER (PARTITION BY {parents}, "full" ORDER BY {name})
           <= goal - sum(share0) OVER ({over}) THEN 1 ELSE 0 END AS share FROM (
      SELECT *, CASE WHEN "full" THEN cap ELSE (CAST(goal - used AS HUGEINT) * w) // open_w END AS share0 FROM (
        SELECT *, sum(CASE WHEN "full" THEN cap ELSE 0 END) OVER ({over}) AS used,
               sum(CASE WHEN "full" THEN 0 ELSE w END) OVER ({over}) AS open_w FROM (
          SELECT *, CAST(cap AS HUGEINT) * rest_w <= CAST(goal - before AS HUGEINT) * w AS "full" FROM (
            SELECT *, least(budget, sum(cap) OVER ({over})) AS goal,
                   coalesce(sum(cap) OVER ({ratio} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                   sum(w) OVER ({ratio} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_w
            FROM ({source})))))"""


def _weight_sql(level: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in MIX_WEIGHTS[level].items())
    return f"CASE {level} {cases} ELSE 1 END" if cases else "1"


MIX_SQL = f"""
WITH slim AS (
  SELECT doc_id, coalesce(CASE WHEN regexp_extract(source, '([0-9]+)$', 1) <> '' THEN
           'domain' || CAST(CAST(regexp_extract(source, '([0-9]+)$', 1) AS INT) % 4 AS VARCHAR) END, '(none)') AS domain,
         coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
         greatest(1, (coalesce(strlen(text), 0) + 3) // 4) AS tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(tokens) AS avail, sum(tokens) * {MIX_EPOCHS} AS cap FROM slim GROUP BY ALL),
l1 AS ({_fill_sql(f"SELECT 0 AS root, domain, sum(cap) AS cap, {_weight_sql('domain')} AS w, (SELECT CAST(sum(avail) AS HUGEINT) * {MIX_BUDGET[0]} // {MIX_BUDGET[1]} FROM leaves) AS budget FROM leaves GROUP BY domain", "root", "domain")}),
l2 AS ({_fill_sql(f"SELECT c.domain, c.lang, c.cap, {_weight_sql('lang')} AS w, p.share AS budget FROM (SELECT domain, lang, sum(cap) AS cap FROM leaves GROUP BY ALL) c JOIN l1 p USING (domain)", "domain", "lang")}),
l3 AS ({_fill_sql(f"SELECT c.domain, c.lang, c.source, c.cap, {_weight_sql('source')} AS w, p.share AS budget FROM leaves c JOIN l2 p USING (domain, lang)", "domain, lang", "source")}),
plan AS (SELECT domain, lang, source, share // avail AS whole, share % avail AS rest FROM l3 JOIN leaves USING (domain, lang, source)),
ranked AS (SELECT s.*, whole, rest, sum(tokens) OVER (PARTITION BY domain, lang, source
             ORDER BY md5('17:' || CAST(CAST(whole AS BIGINT) AS VARCHAR) || ':' || coalesce(CAST(doc_id AS VARCHAR), ''))) AS upto
           FROM slim s JOIN plan USING (domain, lang, source)),
times AS (SELECT *, CAST(whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS n FROM ranked)
SELECT doc_id, domain, lang, source, CAST(tokens AS BIGINT) AS tokens, CAST(epoch AS INT) AS mix_epoch
FROM (SELECT *, unnest(range(n)) AS epoch FROM times WHERE n > 0)
"""


@query("op4_mixing", MIX_SQL)
def q_mixing(spark, d):
    docs = table(spark, d, "documents")
    mixed = mixing.mix(docs, mix_levels(), MIX_WEIGHTS, MIX_BUDGET, MIX_EPOCHS)
    none = F.lit(mixing.NONE)
    return mixed.select("doc_id", F.coalesce(mix_levels()["domain"], none).alias("domain"),
                        F.coalesce("lang", none).alias("lang"), F.coalesce("source", none).alias("source"),
                        mixing.token_estimate(F.col("text")).alias("tokens"), "mix_epoch")


@query("op9_personal_data")
def q_personal_data(spark, d):
    return pii.report(table(spark, d, "documents"))


@query("op10_nearest")
def q_nearest(spark, d):
    return ann.nearest(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0)


_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _terms_sql(text: str) -> str:
    return f"regexp_extract_all(translate({text}, '{_UPPER}', '{_LOWER}'), '{_TERMS}')"


RANKED_SQL = f"""
WITH d AS (SELECT doc_id, {_terms_sql("text")} AS terms FROM documents WHERE text IS NOT NULL),
held AS (SELECT doc_id, terms, len(terms) AS n FROM d WHERE len(terms) > 0),
s AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_all FROM held),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM held) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s),
asked AS (SELECT DISTINCT item_id, unnest({_terms_sql("text")}) AS term FROM benchmark),
scored AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_all)))) AS BIGINT) AS score
           FROM asked JOIN w USING (term) JOIN tf USING (term), s GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 50
"""


@query("op11_ranked_search", RANKED_SQL)
def q_ranked_search(spark, d):
    return bpa.ranked(table(spark, d, "documents"), table(spark, d, "benchmark"))


NEAR_VECTORS_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
       AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e)
         AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)
"""


@query("op12_near_vectors", NEAR_VECTORS_SQL)
def q_near_vectors(spark, d):
    return pstable.near_vectors(table(spark, d, "embeddings"))


def _bits_sql(letters: str) -> str:
    return "(" + " + ".join(f"CASE WHEN contains({letters}, '{f}') THEN {1 << i} ELSE 0 END"
                            for i, f in enumerate(tries.FILTERS)) + ")"


AUDIT_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
m AS (SELECT doc_id, part, CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
        + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
        + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
        + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask FROM w),
c AS (SELECT part, mask, l.quality = 1 AS good, l.toxic = 1 AS toxic, count(*) AS n FROM m LEFT JOIN labels l USING (doc_id) GROUP BY ALL),
f AS (SELECT unnest(string_split('A,B,C,D,E', ',')) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, {_bits_sql("substr(filter_order, step, 1)")} AS own, {_bits_sql("substr(filter_order, 1, step - 1)")} AS before
      FROM (SELECT filter_order, CAST(unnest(range(1, 6)) AS INT) AS step FROM o)),
r AS (SELECT *, mask & own <> 0 AS fails, mask & before <> 0 AS earlier FROM c, s)
SELECT part, filter_order, step,
       CAST(sum(CASE WHEN NOT fails AND NOT earlier THEN n ELSE 0 END) AS BIGINT) AS kept,
       CAST(sum(CASE WHEN fails AND NOT earlier THEN n ELSE 0 END) AS BIGINT) AS removed,
       CAST(sum(CASE WHEN fails AND earlier THEN n ELSE 0 END) AS BIGINT) AS redundant,
       CAST(sum(CASE WHEN mask = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
       CAST(sum(CASE WHEN fails AND NOT earlier AND good THEN n ELSE 0 END) AS BIGINT) AS good_lost,
       CAST(sum(CASE WHEN fails AND NOT earlier AND toxic THEN n ELSE 0 END) AS BIGINT) AS toxic_lost,
       CAST(sum(CASE WHEN fails THEN n * 120 // bit_count(mask) ELSE 0 END) AS BIGINT) AS shapley
FROM r GROUP BY ALL
"""


@query("op13_filter_audit", AUDIT_SQL)
def q_filter_audit(spark, d):
    return tries.audit(table(spark, d, "documents"), table(spark, d, "labels"))
