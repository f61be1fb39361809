"""Verification queries: every operator of the inventory run on the driver tables.

Each entry of ``QUERIES`` takes ``(spark, sf_dir)`` and returns a DataFrame;
``ORACLE_SQL`` holds the same query as DuckDB SQL over the same Parquet files.
All of them read whole tables.  The few that write (CSV, JDBC, landing, job)
write to fresh paths under the session's checkpoint folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.functions.cast import concat_time, date_text, dotted_number, parse_date_text, safe_cast
from podium.functions.keys import sha256_hex
from podium.functions.text import first_in, flag_priority, split_item, starts_with, tokenize
from podium.operators import conform, correct, extract, model, profile, rank, shape
from podium.operators.rank import Key
from podium.plans import jobs
from podium.session import scratch_path, written
from podium.sources import csv as csv_io
from podium.sources import files, jdbc
from podium.sources.tables import append_missing_rows, append_with_drift, load, read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def query(name: str, sql: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return register


def T(spark: SparkSession, d: str, name: str, spread: bool = False) -> DataFrame:
    return read_table(spark, d, name, spread)


def _words(text: str = "text"):
    return F.split(F.col(text), " ", -1)


# --------------------------------------------------------------------------- sources


@query("file_manifest")
def q_file_manifest(spark, d):
    m = files.manifest(spark, d, glob="*.parquet")
    return m.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
                    F.col("length").alias("size")).filter(F.col("size") > 0)


@query("file_route", """
SELECT doc_id, CASE WHEN source LIKE 'src1%' THEN 'A' WHEN source LIKE 'src2%' THEN 'B' ELSE 'C' END AS layout FROM documents
""")
def q_file_route(spark, d):
    docs = T(spark, d, "documents")
    return docs.select("doc_id", extract.route_layout(F.col("source"), [("src1%", "A"), ("src2%", "B")], "C")
                       .alias("layout"))


@query("line_explode", """
SELECT doc_id, CAST(pos - 1 AS INT) AS line_no, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)
""")
def q_line_explode(spark, d):
    docs = T(spark, d, "documents", spread=True).select("doc_id", "text")
    return extract.explode_lines(docs, "text").select("doc_id", "line_no", "line")


@query("line_filter", """
SELECT doc_id, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE regexp_matches(line, '^[A-M]') GROUP BY doc_id
""")
def q_line_filter(spark, d):
    lines = extract.explode_lines(T(spark, d, "documents", spread=True).select("doc_id", "text"), "text")
    return lines.filter(starts_with("line", "^[A-M]")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


@query("csv_roundtrip", """
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part
""")
def q_csv_roundtrip(spark, d):
    part = T(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    path = scratch_path(spark, "csv-part")
    csv_io.write_csv(part, path, "errorifexists")
    schema = "p_partkey string, p_name string, p_brand string, p_type string, p_size string, p_retailprice string"
    from pyspark.sql.types import _parse_datatype_string
    back = csv_io.read_csv(spark, path, _parse_datatype_string(schema))
    return back.select(safe_cast("p_partkey", "bigint").alias("p_partkey"), "p_name", "p_brand", "p_type",
                       safe_cast("p_size", "int").alias("p_size"),
                       safe_cast("p_retailprice", "double").alias("p_retailprice"))


@query("bronze_append", """
SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier
""")
def q_bronze_append(spark, d):
    path = scratch_path(spark, "bronze")
    cust = shape.select_rename(T(spark, d, "customer"), {"c_custkey": "key", "c_name": "name",
                                                          "c_mktsegment": "segment"})
    supp = shape.select_rename(T(spark, d, "supplier"), {"s_suppkey": "key", "s_name": "name"})
    append_with_drift(cust, path)
    append_with_drift(supp, path)
    return load(spark, path, merge_schema=True).select("key", "name", "segment")


@query("stream_landing", """
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part
""")
def q_stream_landing(spark, d):
    from pyspark.sql.types import _parse_datatype_string

    from podium.streaming import land_stream
    src, target, ckpt = (scratch_path(spark, n) for n in ("stream-src", "stream-bronze", "stream-ckpt"))
    part = T(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    csv_io.write_csv(part, src, "errorifexists")
    schema = _parse_datatype_string("p_partkey string, p_name string, p_brand string, p_type string, "
                                    "p_size string, p_retailprice string")
    land_stream(spark, src, schema, target, ckpt).awaitTermination()
    back = load(spark, target)
    return back.select(safe_cast("p_partkey", "bigint").alias("p_partkey"), "p_name", "p_brand", "p_type",
                       safe_cast("p_size", "int").alias("p_size"),
                       safe_cast("p_retailprice", "double").alias("p_retailprice"))


def _derby(spark) -> str:
    return jdbc.derby_memory_url("podium_" + uuid.uuid4().hex[:10])


DERBY_PROPS = {"driver": jdbc.DERBY_DRIVER}


@query("jdbc_table_roundtrip", """
SELECT n_nationkey, n_name, n_regionkey FROM nation
""")
def q_jdbc_table_roundtrip(spark, d):
    url = _derby(spark)
    nation = T(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    jdbc.write_table(nation, url, "NATION_COPY", "errorifexists", DERBY_PROPS)
    b = jdbc.read_query(spark, url, 'SELECT min("n_nationkey") AS lo, max("n_nationkey") AS hi FROM NATION_COPY',
                        DERBY_PROPS).first()
    back = jdbc.read_table(spark, url, "NATION_COPY", DERBY_PROPS, partition_column="n_nationkey",
                           lower=b["LO"], upper=b["HI"] + 1, num_partitions=4)
    return back.select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name",
                       F.col("n_regionkey").cast("int").alias("n_regionkey"))


@query("jdbc_query_pushdown", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'P'
""")
def q_jdbc_query_pushdown(spark, d):
    url = _derby(spark)
    orders = T(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    jdbc.write_table(orders, url, "ORDERS_COPY", "errorifexists", DERBY_PROPS,
                     column_types="o_orderstatus VARCHAR(16)")
    b = jdbc.read_query(spark, url, 'SELECT min("o_orderkey") AS lo, max("o_orderkey") AS hi FROM ORDERS_COPY',
                        DERBY_PROPS).first()
    src = jdbc.read_query(spark, url, 'SELECT "o_orderkey", "o_custkey", "o_orderstatus" FROM ORDERS_COPY',
                          DERBY_PROPS, partition_column="o_orderkey", lower=b["LO"], upper=b["HI"] + 1,
                          num_partitions=4)
    # the DataFrame filter is pushed into the database query by Catalyst
    return src.filter(F.col("o_orderstatus") != "P").select("o_orderkey", "o_custkey")


@query("patch_rows", """
SELECT n_nationkey, n_name FROM nation UNION ALL SELECT 1003, 'PATCHED'
""")
def q_patch_rows(spark, d):
    nation = T(spark, d, "nation").select("n_nationkey", "n_name")
    rows = spark.createDataFrame([(1003, "PATCHED"), (4, "PATCHED")], "n_nationkey int, n_name string")
    return append_missing_rows(nation, rows, ["n_nationkey"])


# --------------------------------------------------------------------------- extraction


@query("header_fill", """
WITH e AS (SELECT source, doc_id, last_value(CASE WHEN lang='en' THEN doc_id END IGNORE NULLS) OVER w AS f_en, last_value(CASE WHEN lang='fr' THEN doc_id END IGNORE NULLS) OVER w AS f_fr, last_value(CASE WHEN lang='de' THEN doc_id END IGNORE NULLS) OVER w AS f_de, last_value(CASE WHEN lang='es' THEN doc_id END IGNORE NULLS) OVER w AS f_es FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING)), d AS (SELECT *, (f_en IS NOT NULL AND f_fr IS NOT NULL AND f_de IS NOT NULL AND f_es IS NOT NULL) AS complete FROM e) SELECT source, f_en, f_fr, f_de, f_es, complete FROM d QUALIFY row_number() OVER (PARTITION BY source ORDER BY complete DESC, CASE WHEN complete THEN doc_id ELSE -doc_id END) = 1
""")
def q_header_fill(spark, d):
    docs = T(spark, d, "documents").select("source", "doc_id", "lang")
    fields = {f"f_{lang}": F.when(F.col("lang") == lang, F.col("doc_id")) for lang in ("en", "fr", "de", "es")}
    return extract.fill_header(docs, "source", ["doc_id"], fields)


@query("tokenize_lines", r"""
SELECT doc_id, CAST(len(string_split(trim(regexp_replace(text, '[ \t\n\r]{2,}', ' ', 'g')), ' ')) AS INT) AS n_tokens FROM documents
""")
def q_tokenize_lines(spark, d):
    docs = T(spark, d, "documents", spread=True)
    return docs.select("doc_id", F.size(tokenize("text", ws=r"[ \t\n\r]", spaces_only=True)).alias("n_tokens"))


@query("dict_token_pos", """
SELECT d.doc_id, CAST(p.pos AS INT) AS pos FROM documents d LEFT JOIN (SELECT doc_id, min(pos) - 1 AS pos FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS tok, generate_subscripts(string_split(text, ' '), 1) AS pos FROM documents) WHERE tok IN ('of','and','the','le','der') GROUP BY doc_id) p ON d.doc_id = p.doc_id
""")
def q_dict_token_pos(spark, d):
    docs = T(spark, d, "documents", spread=True).select("doc_id", _words().alias("tokens"))
    return extract.dict_token_pos(docs, "tokens", ["of", "and", "the", "le", "der"], "pos").select("doc_id", "pos")


@query("dict_token_table", """
WITH w AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS tok FROM benchmark), t AS (SELECT doc_id, unnest(string_split(text, ' ')) AS tok, generate_subscripts(string_split(text, ' '), 1) - 1 AS pos FROM documents), h AS (SELECT doc_id, min(pos) AS pos, count(*) AS hits FROM t JOIN w USING (tok) GROUP BY doc_id) SELECT doc_id, CAST(pos AS INT) AS pos, CAST(hits AS INT) AS hits FROM documents LEFT JOIN h USING (doc_id)
""")
def q_dict_token_table(spark, d):
    """The dictionary is a table: all words of the benchmark items, looked up in every document."""
    words = T(spark, d, "benchmark").select(F.explode(_words()).alias("w"))
    docs = T(spark, d, "documents", spread=True).select("doc_id", _words().alias("tokens"))
    return extract.dict_tokens(docs, "tokens", words, "pos", "hits").select("doc_id", "pos", "hits")


def _sheet_lines(spark, d, layout: str) -> DataFrame:
    """Result-sheet lines written from lineitem x supplier x nation, one layout."""
    li = T(spark, d, "lineitem", spread=True)
    sup = T(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    nat = T(spark, d, "nation").select("n_nationkey", "n_name")
    j = li.join(sup, li.l_suppkey == sup.s_suppkey).join(nat, F.col("s_nationkey") == nat.n_nationkey)
    s = lambda c: F.col(c).cast("string")
    head = [s("l_linenumber"), s("l_orderkey"), F.lit("SUP"), s("l_partkey"), F.col("n_name")]
    bracket = F.when(F.col("l_linestatus") == "F", F.concat(F.lit("("), s("l_tax"), F.lit(")")))
    if layout == "heats":
        flag = correct.case_map("l_returnflag", {"A": "Q", "R": "q"}, "x")
        body = [s("l_suppkey"), s("l_linenumber"), F.col("l_quantity").cast("int").cast("string"),
                s("l_extendedprice"), bracket, s("l_discount"), flag]
    elif layout == "final_a":
        body = [s("l_suppkey"), s("l_extendedprice"), bracket, s("l_discount")]
    else:
        filler = [F.date_format("l_shipdate", "d"), F.upper(F.date_format("l_shipdate", "MMM")),
                  F.date_format("l_shipdate", "yyyy"), s("l_tax")]
        body = [*filler, s("l_suppkey"), F.col("l_quantity").cast("int").cast("string"),
                s("l_discount"), s("l_extendedprice")]
    return j.select("l_linenumber", F.concat_ws(" ", *head, *body).alias("line"), F.lit(layout).alias("layout"))


LAYOUTS = {"heats": extract.HEATS, "final_a": extract.FINAL_A, "final_b": extract.FINAL_B}


def _parse_sheet(spark, d, layout):
    words = T(spark, d, "nation").select("n_name")
    return extract.parse_layout(_sheet_lines(spark, d, layout), LAYOUTS, words, layout_col="layout")


@query("parse_layout_heat", """
SELECT l_linenumber AS rank, l_orderkey AS bib, concat('SUP ', l_partkey) AS name, n_name AS code, l_suppkey AS heat, l_linenumber AS lane, CAST(l_quantity AS INT) AS pos, l_extendedprice AS time, CASE WHEN l_linestatus = 'F' THEN l_tax END AS fraction, l_discount AS wind, CASE l_returnflag WHEN 'A' THEN 'Q' WHEN 'R' THEN 'q' END AS result FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
""")
def q_parse_layout_heat(spark, d):
    p = _parse_sheet(spark, d, "heats")
    return p.select(safe_cast("rank", "int").alias("rank"), safe_cast("bib", "bigint").alias("bib"), "name", "code",
                    safe_cast("heat", "bigint").alias("heat"), safe_cast("lane", "int").alias("lane"),
                    safe_cast("pos", "int").alias("pos"), safe_cast("time", "double").alias("time"),
                    safe_cast("ms", "double").alias("fraction"), safe_cast("wind", "double").alias("wind"),
                    "result")


@query("parse_layout_final_a", """
SELECT l_linenumber AS rank, l_orderkey AS bib, n_name AS code, l_suppkey AS lane, l_extendedprice AS time, CASE WHEN l_linestatus = 'F' THEN l_tax END AS fraction, '+1.0' AS wind, CASE WHEN l_linenumber = 1 THEN 'Q' END AS result FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
""")
def q_parse_layout_final_a(spark, d):
    p = _parse_sheet(spark, d, "final_a")
    return p.select(safe_cast("rank", "int").alias("rank"), safe_cast("bib", "bigint").alias("bib"), "code",
                    safe_cast("lane", "bigint").alias("lane"), safe_cast("time", "double").alias("time"),
                    safe_cast("ms", "double").alias("fraction"), "wind", "result")


@query("parse_layout_final_b", """
SELECT l_linenumber AS rank, l_orderkey AS bib, n_name AS code, l_suppkey AS lane, CAST(l_quantity AS INT) AS pos, l_discount AS wind, l_extendedprice AS time, CASE WHEN l_linenumber = 1 THEN 'Q' END AS result, CASE WHEN l_linenumber = 1 THEN 'NR' END AS info FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
""")
def q_parse_layout_final_b(spark, d):
    p = _parse_sheet(spark, d, "final_b")
    return p.select(safe_cast("rank", "int").alias("rank"), safe_cast("bib", "bigint").alias("bib"), "code",
                    safe_cast("lane", "bigint").alias("lane"), safe_cast("pos", "int").alias("pos"),
                    safe_cast("wind", "double").alias("wind"), safe_cast("time", "double").alias("time"),
                    "result", "info")


@query("paren_capture", """
SELECT p_partkey, CASE WHEN p_type <> 'ECONOMY' THEN CAST(p_size AS VARCHAR) END AS captured FROM part
""")
def q_paren_capture(spark, d):
    from podium.functions.text import paren_capture
    part = T(spark, d, "part")
    text = F.concat_ws(" ", "p_name", F.when(F.col("p_type") != "ECONOMY",
                                             F.concat(F.lit("("), F.col("p_size").cast("string"), F.lit(")"))))
    return part.select("p_partkey", paren_capture(text).alias("captured"))


@query("flag_priority", """
SELECT doc_id, CASE WHEN list_contains(string_split(text, ' '), 'The') THEN 'The' WHEN list_contains(string_split(text, ' '), 'the') THEN 'the' END AS flag FROM documents
""")
def q_flag_priority(spark, d):
    return T(spark, d, "documents", spread=True).select("doc_id", flag_priority(_words(), ["The", "the"]).alias("flag"))


@query("first_code", """
SELECT doc_id, list_filter(string_split(text, ' '), lambda x: x IN ('of','and','the'))[1] AS code FROM documents
""")
def q_first_code(spark, d):
    return T(spark, d, "documents", spread=True).select("doc_id", first_in(_words(), ["of", "and", "the"]).alias("code"))


@query("parse_rejects", """
SELECT source, count(*) FILTER (WHERE len(list_filter(string_split(text, ' '), lambda x: x IN ('of','and','the'))) > 0) AS parsed, count(*) FILTER (WHERE len(list_filter(string_split(text, ' '), lambda x: x IN ('of','and','the'))) = 0) AS rejected FROM documents
GROUP BY source
""")
def q_parse_rejects(spark, d):
    docs = T(spark, d, "documents", spread=True).select("source", "text")
    parsed = extract.parse_layout(docs, extract.HEATS, ["of", "and", "the"], line_col="text",
                                  tokenizer=lambda c: F.split(c, " ", -1), keep=["source"])
    records, rejects, _ = extract.split_rejects(parsed)
    both = records.select("source", F.lit(1).alias("p"), F.lit(0).alias("r")).unionByName(
        rejects.select("source", F.lit(0).alias("p"), F.lit(1).alias("r")))
    return both.groupBy("source").agg(F.sum("p").alias("parsed"), F.sum("r").alias("rejected"))


@query("header_attach", """
SELECT d.doc_id, coalesce(h.first_de, -1) AS header FROM documents d LEFT JOIN (SELECT source, min(doc_id) AS first_de FROM documents WHERE lang = 'de' GROUP BY source) h ON d.source = h.source
""")
def q_header_attach(spark, d):
    docs = T(spark, d, "documents").select("doc_id", "source", "lang")
    head = extract.fill_header(docs, "source", ["doc_id"],
                               {"header": F.when(F.col("lang") == "de", F.col("doc_id"))}, complete_col=None)
    out = extract.attach_header(docs.select("doc_id", "source"), head, "source", defaults={"header": -1})
    return out.select("doc_id", "header")


@query("union_files", """
SELECT 'customer' AS src, c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier
""")
def q_union_files(spark, d):
    return extract.union_files({
        "customer": shape.select_rename(T(spark, d, "customer"), {"c_custkey": "key", "c_name": "name"}),
        "supplier": shape.select_rename(T(spark, d, "supplier"), {"s_suppkey": "key", "s_name": "name"}),
    })


# --------------------------------------------------------------------------- shape, filters


@query("select_rename", """
SELECT o_orderkey AS id, o_custkey AS customer_id, o_orderstatus AS status FROM orders
""")
def q_select_rename(spark, d):
    return shape.select_rename(T(spark, d, "orders"), {"o_orderkey": "id", "o_custkey": "customer_id",
                                                        "o_orderstatus": "status"})


@query("safe_cast", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS INT) END AS v FROM orders
""")
def q_safe_cast(spark, d):
    o = T(spark, d, "orders")
    text = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")).otherwise(F.lit("DNS"))
    return o.select("o_orderkey", safe_cast(text, "int").alias("v"))


@query("audit_cols", """
SELECT n_nationkey, n_name, TIMESTAMP '2024-01-01 00:00:00' AS insert_date, TIMESTAMP '2024-01-01 00:00:00' AS modified_date, TRUE AS active FROM nation
""")
def q_audit_cols(spark, d):
    return shape.add_audit(T(spark, d, "nation").select("n_nationkey", "n_name"), "2024-01-01 00:00:00")


@query("time_to_number", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(concat(l_linenumber, l_suppkey, '000') AS DOUBLE) AS time_num FROM lineitem
""")
def q_time_to_number(spark, d):
    li = T(spark, d, "lineitem")
    text = concat_time(F.concat(F.col("l_linenumber").cast("string"), F.lit("."), F.col("l_suppkey").cast("string")),
                       F.lit(None).cast("string"))
    return li.select(*LINE_KEY, dotted_number(text, "double").alias("time_num"))


@query("numeric_cols", """
SELECT unnest(['l_orderkey','l_partkey','l_suppkey','l_linenumber','l_quantity','l_extendedprice','l_discount','l_tax']) AS column_name
""")
def q_numeric_cols(spark, d):
    return profile.names_frame(spark, shape.numeric_columns(T(spark, d, "lineitem")))


@query("schema_report", """
SELECT unnest(['o_orderkey','o_custkey','o_orderstatus','o_totalprice','o_orderdate','o_orderpriority']) AS column_name, unnest(['bigint','bigint','string','double','timestamp_ntz','string']) AS type
""")
def q_schema_report(spark, d):
    return profile.schema_report(T(spark, d, "orders")).select("column_name", "type")


@query("filter_regex", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_linenumber <> 7
""")
def q_filter_regex(spark, d):
    li = T(spark, d, "lineitem")
    ids = li.withColumn("id", F.when(F.col("l_linenumber") == 7, F.lit("LOUIS"))
                        .otherwise(F.concat(F.lit(" "), F.col("l_orderkey").cast("string"))))
    return shape.filter_regex(ids, "id", r"^[0-9]+$").select(*LINE_KEY)


@query("filter_null", """
SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'P') IS NULL
""")
def q_filter_null(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return shape.filter_null(o, "status").select("o_orderkey")


@query("filter_not_in", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE nullif(l_linenumber, 1) <> 2 AND nullif(l_linenumber, 1) <> 3
""")
def q_filter_not_in(spark, d):
    li = T(spark, d, "lineitem").withColumn("round", F.nullif("l_linenumber", F.lit(1)))
    return shape.exclude_values(li, "round", [2, 3]).select(*LINE_KEY)


@query("filter_threshold", """
SELECT o_orderkey FROM orders WHERE CASE WHEN o_orderstatus <> 'P' THEN o_custkey END < 452
""")
def q_filter_threshold(spark, d):
    o = T(spark, d, "orders")
    rank_text = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string"))
    o = o.withColumn("rank", safe_cast(rank_text, "bigint"))
    return shape.filter_below(o, "rank", 452).select("o_orderkey")


@query("drop_null_rows", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P' AND o_custkey <> 0
""")
def q_drop_null_rows(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
                                     F.nullif("o_custkey", F.lit(0)).alias("cust"))
    return shape.drop_null_rows(o).select("o_orderkey", "o_orderstatus")


# --------------------------------------------------------------------------- corrections


@query("decode_binary", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Fulfilled' ELSE 'Open' END AS state FROM orders
""")
def q_decode_binary(spark, d):
    o = T(spark, d, "orders")
    return o.select("o_orderkey", correct.decode("o_orderstatus", {"F": "Fulfilled"}, "Open").alias("state"))


@query("decode_like", """
SELECT p_partkey, CASE WHEN p_name LIKE '%ring%' THEN 'ring' WHEN p_name LIKE '%widget%' THEN 'widget' END AS kind FROM part
""")
def q_decode_like(spark, d):
    p = T(spark, d, "part")
    return p.select("p_partkey", correct.decode_like("p_name", [("%ring%", "ring"), ("%widget%", "widget")])
                    .alias("kind"))


@query("status_override", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'DNS' WHEN o_orderpriority = '2-HIGH' THEN 'DQ' WHEN regexp_matches(o_orderpriority, 'NOT') THEN 'DQ' ELSE o_orderstatus END AS result FROM orders
""")
def q_status_override(spark, d):
    o = T(spark, d, "orders")
    return o.select("o_orderkey", correct.status_override("o_orderpriority", "o_orderstatus",
                                                          {"5-LOW": "DNS", "2-HIGH": "DQ"}, {"NOT": "DQ"})
                    .alias("result"))


@query("fill_default", """
SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'NQ') AS result FROM orders
""")
def q_fill_default(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("result"))
    return correct.fill_default(o, {"result": "NQ"})


@query("patch_by_key", """
SELECT n_nationkey, CASE n_name WHEN 'NATION_1' THEN 'FIXED_1' WHEN 'NATION_7' THEN 'FIXED_7' ELSE n_name END AS name, CASE WHEN n_name IN ('NATION_1','NATION_7') THEN concat(n_name, ' ', n_regionkey) ELSE CAST(n_regionkey AS VARCHAR) END AS label FROM nation
""")
def q_patch_by_key(spark, d):
    n = T(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("name"),
                                     F.col("n_regionkey").cast("string").alias("label"))
    patch = spark.createDataFrame([("NATION_1", "FIXED_1"), ("NATION_7", "FIXED_7")], "wrong string, right string")
    return correct.apply_patch(n, patch, ("name", "wrong"), {
        "name": F.col("right"),
        "label": F.concat(F.col("wrong"), F.lit(" "), F.col("label")),
    }, small=True)


@query("patch_reset", """
SELECT c_custkey, CASE WHEN c_custkey IN (1,2,3,5,8,13) THEN 0.0::DOUBLE ELSE c_acctbal END AS acctbal, CASE WHEN c_custkey IN (1,2,3,5,8,13) THEN '0' ELSE c_mktsegment END AS segment FROM customer
""")
def q_patch_reset(spark, d):
    c = T(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("acctbal"),
                                       F.col("c_mktsegment").alias("segment"))
    return correct.reset_columns(c, "c_custkey", [1, 2, 3, 5, 8, 13], {"acctbal": 0.0, "segment": "0"})


@query("flag_qualified", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag IN ('A','R') AS qualified, CASE l_returnflag WHEN 'A' THEN 'Place' WHEN 'R' THEN 'Time' END AS qualification_type FROM lineitem
""")
def q_flag_qualified(spark, d):
    li = T(spark, d, "lineitem").select(*LINE_KEY, "l_returnflag")
    return correct.add_flags(li, "l_returnflag", {"A": "Place", "R": "Time"}, "qualified",
                             "qualification_type").drop("l_returnflag")


@query("flag_disqualified", """
SELECT o_orderkey, o_orderstatus IN ('F','P') AS disqualified, CASE o_orderstatus WHEN 'F' THEN 'Rule' WHEN 'P' THEN 'Did Not Started' END AS disqualification_type FROM orders
""")
def q_flag_disqualified(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return correct.add_flags(o, "o_orderstatus", {"F": "Rule", "P": "Did Not Started"}, "disqualified",
                             "disqualification_type").drop("o_orderstatus")


@query("flag_record", """
SELECT o_orderkey, o_orderpriority <> '5-LOW' AS record, CASE o_orderpriority WHEN '1-URGENT' THEN 'Season Best' WHEN '2-HIGH' THEN 'Personal Best' WHEN '3-MEDIUM' THEN 'Equal Season Best' WHEN '4-NOT SPECIFIED' THEN 'National Record' END AS record_type FROM orders
""")
def q_flag_record(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    codes = {"1-URGENT": "Season Best", "2-HIGH": "Personal Best", "3-MEDIUM": "Equal Season Best",
             "4-NOT SPECIFIED": "National Record"}
    return correct.add_flags(o, "o_orderpriority", codes, "record", "record_type").drop("o_orderpriority")


# --------------------------------------------------------------------------- conform


@query("dedup_rows", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) = 1
""")
def q_dedup_rows(spark, d):
    li = T(spark, d, "lineitem").select(*LINE_KEY)
    return conform.dedup_by_key(li, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


@query("distinct_dim", """
SELECT DISTINCT event_type, CAST(ts AS DATE) AS day FROM events
""")
def q_distinct_dim(spark, d):
    ev = T(spark, d, "events").select("event_type", F.to_date("ts").alias("day"))
    return conform.distinct_rows(ev, ["event_type", "day"])


def _bib(col: str):
    """A key as sheets give it: text, and no number on every seventh line."""
    return safe_cast(F.when(F.col("l_linenumber") == 7, F.lit("X")).otherwise(F.col(col).cast("string")), "bigint")


@query("lookup_fk", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_partkey AS fk_part FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND l_linenumber <> 7
""")
def q_lookup_fk(spark, d):
    li = T(spark, d, "lineitem").select(*LINE_KEY)
    part = T(spark, d, "part").select("p_partkey")
    return conform.lookup_fk(li, part, [(_bib("l_partkey"), "p_partkey")], "p_partkey", "fk_part")


@query("lookup_fk_multi", """
WITH d AS (SELECT *, row_number() OVER (ORDER BY f, s, n) AS id FROM (SELECT DISTINCT l_returnflag AS f, l_linestatus AS s, l_linenumber AS n FROM lineitem)) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, id AS fk FROM lineitem LEFT JOIN d ON l_returnflag = f AND l_linestatus = s AND l_linenumber = n
""")
def q_lookup_fk_multi(spark, d):
    li = T(spark, d, "lineitem")
    dim = conform.distinct_rows(li.select(
        F.col("l_returnflag").alias("f"), F.col("l_linestatus").alias("s"), F.col("l_linenumber").alias("n")),
        ["f", "s", "n"])
    dim = conform.surrogate_key(dim, ["f", "s", "n"], "id")
    fact = li.select(*LINE_KEY, "l_returnflag", "l_linestatus")
    on = [(F.col("l_returnflag"), "f"), (F.col("l_linestatus"), "s"), (F.col("l_linenumber"), "n")]
    return conform.lookup_fk(fact, dim, on, "id", "fk").select(*LINE_KEY, "fk")


@query("lookup_correction", """
WITH m(n, f, fix) AS (VALUES (7,'A',514), (7,'R',1042), (1,'N',690)) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(p_partkey, fix) AS fk FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND l_linenumber <> 7 LEFT JOIN m ON p_partkey IS NULL AND l_linenumber = n AND l_returnflag = f
""")
def q_lookup_correction(spark, d):
    li = T(spark, d, "lineitem").select(*LINE_KEY, "l_returnflag")
    part = T(spark, d, "part").select("p_partkey")
    looked = conform.lookup_fk(li, part, [(_bib("l_partkey"), "p_partkey")], "p_partkey", "fk")
    fixes = spark.createDataFrame([(7, "A", 514), (7, "R", 1042), (1, "N", 690)], "n int, f string, fix int")
    fixed = conform.correct_null(looked, "fk", fixes, [("l_linenumber", "n"), ("l_returnflag", "f")], "fix",
                                 small=True)
    return fixed.select(*LINE_KEY, "fk")


@query("lookup_hot", """
WITH k AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber % 3 = 1 THEN (SELECT min(s_suppkey) FROM supplier) WHEN l_linenumber = 6 THEN NULL ELSE l_suppkey END AS s FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, n_name AS fk FROM k LEFT JOIN supplier ON s = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
""")
def q_lookup_hot(spark, d):
    """A shuffled lookup in which one key holds a third of the lines: it is found by sketch and spread out."""
    from podium.operators.skew import heavy_keys, left_join_spread
    sup = T(spark, d, "supplier").select("s_suppkey", "s_nationkey").join(
        T(spark, d, "nation").select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    first = T(spark, d, "supplier").agg(F.min("s_suppkey")).first()[0]
    li = T(spark, d, "lineitem").select(*LINE_KEY, F.when(F.col("l_linenumber") % 3 == 1, F.lit(first))
                                        .when(F.col("l_linenumber") != 6, F.col("l_suppkey")).alias("__k0"))
    dim = sup.select(F.col("s_suppkey").alias("__k0"), F.col("n_name").alias("fk"))
    return left_join_spread(li, dim, ["__k0"], heavy_keys(li, ["__k0"])).select(*LINE_KEY, "fk")


# --------------------------------------------------------------------------- ranking


@query("conditional_rank", """
SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY CASE WHEN o_custkey % 7 = 0 THEN 1 ELSE 2 END, o_totalprice, o_orderkey) AS INT) AS pos FROM orders WHERE o_orderstatus = 'P'
""")
def q_conditional_rank(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    first = F.when(F.col("o_custkey") % 7 == 0, F.lit(1)).otherwise(F.lit(2))
    r = rank.conditional_rank(o, F.col("o_orderstatus") == "P", ["o_orderpriority"],
                              [first, "o_totalprice", "o_orderkey"])
    return r.select("o_orderkey", F.col("pos").cast("int").alias("pos"))


@query("global_rank", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS pos FROM orders
""")
def q_global_rank(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return rank.global_rank(o, ["o_totalprice", "o_orderkey"]).select("o_orderkey", "pos")


@query("rank_join_back", """
WITH r AS (SELECT o_custkey AS c, CAST(row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS INT) AS pos FROM orders WHERE o_orderstatus = 'P') SELECT o_orderkey, coalesce(pos, 0) AS pos FROM orders LEFT JOIN r ON o_custkey = c
""")
def q_rank_join_back(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice") \
        .withColumn("pos", F.lit(None).cast("int"))
    r = rank.rank_join_back(o, F.col("o_orderstatus") == "P", ["o_totalprice", "o_orderkey"], "o_custkey",
                            "pos", default=0, compat=True)
    return r.select("o_orderkey", "pos")


@query("rank_in_place", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN CAST(row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY o_totalprice, o_orderkey) AS INT) ELSE -1 END AS pos FROM orders
""")
def q_rank_in_place(spark, d):
    """The strict form: a rank stays on its own row."""
    o = T(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice") \
        .withColumn("pos", F.lit(None).cast("int"))
    r = rank.rank_join_back(o, F.col("o_orderstatus") == "P", ["o_totalprice", "o_orderkey"], "o_orderkey", "pos",
                            default=-1, compat=False, partition_by=["o_orderpriority"])
    return r.select("o_orderkey", "pos")


@query("rank_mixed", """
SELECT event_id, row_number() OVER (PARTITION BY nullif(event_type, 'click') ORDER BY CAST(ts AS DATE) DESC NULLS LAST, props DESC NULLS LAST, nullif(value, 0) ASC NULLS LAST, ts DESC, event_id) AS pos FROM events
""")
def q_rank_mixed(spark, d):
    """Descending dates, text and times, null groups; sixty-four ranges."""
    ev = T(spark, d, "events").select("event_id", "ts", "props", "value", "event_type")
    order = [Key(F.to_date("ts"), True, True), Key("props", True, True), Key(F.nullif("value", F.lit(0.0)), False, True),
             Key("ts", True), Key("event_id")]
    return rank.row_number_by(ev, order, [F.nullif("event_type", F.lit("click"))], buckets=64).select("event_id", "pos")


@query("top_k", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 3
""")
def q_top_k(spark, d):
    li = T(spark, d, "lineitem").select(*LINE_KEY, "l_extendedprice")
    return rank.top_k(li, 3, [Key("l_extendedprice", desc=True), *LINE_KEY])


# --------------------------------------------------------------------------- scalar functions, keys


@query("split_item", """
SELECT c_custkey, string_split(c_name, '#')[1] AS a, string_split(c_name, '#')[2] AS b, string_split(c_name, '#')[6] AS z FROM customer
""")
def q_split_item(spark, d):
    c = T(spark, d, "customer")
    return c.select("c_custkey", split_item("c_name", "#", 0).alias("a"), split_item("c_name", "#", 1).alias("b"),
                    split_item("c_name", "#", 5).alias("z"))


@query("concat_time", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, concat(l_linenumber, CASE WHEN l_linestatus = 'F' THEN concat('.', l_suppkey) ELSE '.000' END) AS time FROM lineitem
""")
def q_concat_time(spark, d):
    li = T(spark, d, "lineitem")
    frac = F.when(F.col("l_linestatus") == "F", F.concat(F.lit("."), F.col("l_suppkey").cast("string")))
    return li.select(*LINE_KEY, concat_time(F.col("l_linenumber").cast("string"), frac).alias("time"))


@query("date_reformat", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, strftime(o_orderdate, '%d/%m/%y') AS d_text FROM orders
""")
def q_date_reformat(spark, d):
    o = T(spark, d, "orders")
    text = F.upper(F.date_format("o_orderdate", "EEE d MMM yyyy"))
    parsed = o.select("o_orderkey", parse_date_text(text).alias("d"))
    return parsed.withColumn("d_text", date_text("d"))


@query("surrogate_key", """
SELECT p_brand, p_type, CAST(row_number() OVER (ORDER BY p_brand, p_type) AS INT) AS id FROM (SELECT DISTINCT p_brand, p_type FROM part)
""")
def q_surrogate_key(spark, d):
    dim = conform.distinct_rows(T(spark, d, "part"), ["p_brand", "p_type"])
    return conform.surrogate_key(dim, ["p_brand", "p_type"], "id").withColumn("id", F.col("id").cast("int"))


@query("key_registry", """
WITH k AS (SELECT DISTINCT o_orderpriority AS p, CAST(o_orderdate AS DATE) AS day, o_orderdate < (SELECT median(o_orderdate) FROM orders) AS early FROM orders), m AS (SELECT p, day, bool_or(early) AS early FROM k GROUP BY ALL) SELECT p, day, row_number() OVER (ORDER BY early DESC, p, day) AS id FROM m
""")
def q_key_registry(spark, d):
    """Two loads of one dimension: the second keeps the first one's keys and numbers the new ones after them."""
    o = T(spark, d, "orders").select(F.col("o_orderpriority").alias("p"), F.to_date("o_orderdate").alias("day"),
                                     F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("us"))
    mid = profile.exact_quantiles(o.select("us"), "us", [], [0.5], ["mid"]).first()["mid"]
    path = scratch_path(spark, "registry")
    conform.register_keys(o.filter(F.col("us") < F.lit(mid)).select("p", "day").distinct(), ["p", "day"], path)
    return conform.register_keys(o.select("p", "day").distinct(), ["p", "day"], path)


@query("hash_key", """
SELECT c_custkey, sha256(CAST(c_custkey AS VARCHAR)) AS h FROM customer
""")
def q_hash_key(spark, d):
    return T(spark, d, "customer").select("c_custkey", sha256_hex("c_custkey").alias("h"))


# --------------------------------------------------------------------------- profiling


@query("describe_cols", """
SELECT 'c_custkey' AS col, count(c_custkey) AS n, round(avg(TRY_CAST(c_custkey AS DOUBLE)), 4) AS mean, round(stddev_samp(TRY_CAST(c_custkey AS DOUBLE)), 4) AS sd, CAST(min(c_custkey) AS DOUBLE) AS lo, CAST(max(c_custkey) AS DOUBLE) AS hi, CAST(NULL AS VARCHAR) AS lo_text, CAST(NULL AS VARCHAR) AS hi_text FROM customer
UNION ALL SELECT 'c_name' AS col, count(c_name) AS n, round(avg(TRY_CAST(c_name AS DOUBLE)), 4) AS mean, round(stddev_samp(TRY_CAST(c_name AS DOUBLE)), 4) AS sd, CAST(NULL AS DOUBLE) AS lo, CAST(NULL AS DOUBLE) AS hi, min(c_name) AS lo_text, max(c_name) AS hi_text FROM customer
UNION ALL SELECT 'c_nationkey' AS col, count(c_nationkey) AS n, round(avg(TRY_CAST(c_nationkey AS DOUBLE)), 4) AS mean, round(stddev_samp(TRY_CAST(c_nationkey AS DOUBLE)), 4) AS sd, CAST(min(c_nationkey) AS DOUBLE) AS lo, CAST(max(c_nationkey) AS DOUBLE) AS hi, CAST(NULL AS VARCHAR) AS lo_text, CAST(NULL AS VARCHAR) AS hi_text FROM customer
UNION ALL SELECT 'c_acctbal' AS col, count(c_acctbal) AS n, round(avg(TRY_CAST(c_acctbal AS DOUBLE)), 4) AS mean, round(stddev_samp(TRY_CAST(c_acctbal AS DOUBLE)), 4) AS sd, CAST(min(c_acctbal) AS DOUBLE) AS lo, CAST(max(c_acctbal) AS DOUBLE) AS hi, CAST(NULL AS VARCHAR) AS lo_text, CAST(NULL AS VARCHAR) AS hi_text FROM customer
UNION ALL SELECT 'c_mktsegment' AS col, count(c_mktsegment) AS n, round(avg(TRY_CAST(c_mktsegment AS DOUBLE)), 4) AS mean, round(stddev_samp(TRY_CAST(c_mktsegment AS DOUBLE)), 4) AS sd, CAST(NULL AS DOUBLE) AS lo, CAST(NULL AS DOUBLE) AS hi, min(c_mktsegment) AS lo_text, max(c_mktsegment) AS hi_text FROM customer
""")
def q_describe_cols(spark, d):
    customer = T(spark, d, "customer")
    return profile.describe_cols(customer, customer.columns)


@query("value_counts", """
SELECT 'o_orderstatus' AS col, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2
""")
def q_value_counts(spark, d):
    return profile.value_counts(T(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("boxplot_stats", """
WITH q AS (SELECT event_type AS g, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1) SELECT g, round(q1, 4) AS q1, round(q2, 4) AS q2, round(q3, 4) AS q3, count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_outliers FROM events JOIN q ON event_type = g GROUP BY ALL
""")
def q_boxplot_stats(spark, d):
    ev = T(spark, d, "events").select(F.col("event_type").alias("g"), "value")
    return profile.box_stats(ev, "value", ["g"])


@query("exact_quantiles", """
SELECT l_returnflag AS f, nullif(l_linenumber, 4) AS n, quantile_cont(l_extendedprice, 0.01) AS a, quantile_cont(l_extendedprice, 0.5) AS b, quantile_cont(l_extendedprice, 0.999) AS c FROM lineitem GROUP BY ALL
""")
def q_exact_quantiles(spark, d):
    li = T(spark, d, "lineitem").select(F.col("l_returnflag").alias("f"), F.nullif("l_linenumber", F.lit(4)).alias("n"),
                                        "l_extendedprice")
    return profile.exact_quantiles(li, "l_extendedprice", ["f", "n"], [0.01, 0.5, 0.999], ["a", "b", "c"])


# --------------------------------------------------------------------------- model


def _order_features(spark, d) -> DataFrame:
    o = T(spark, d, "orders").select("o_orderkey", "o_totalprice", F.col("o_custkey").cast("double").alias("cust"),
                                     "o_orderstatus")
    return model.add_features(o, ["o_totalprice", "cust"], F.col("o_orderstatus") == "F")


@query("ml_features", """
SELECT o_orderkey, o_totalprice AS f0, CAST(o_custkey AS DOUBLE) AS f1, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label FROM orders
""")
def q_ml_features(spark, d):
    f = model.features_as_columns(_order_features(spark, d), "features", ["f0", "f1"])
    return f.select("o_orderkey", "f0", "f1", "label")


@query("ml_split", """
SELECT o_orderkey, substr(sha256(concat('42:', o_orderkey)), 1, 2) < 'cc' AS is_train FROM orders
""")
def q_ml_split(spark, d):
    return model.add_split(T(spark, d, "orders").select("o_orderkey"), "o_orderkey")


@query("ml_score")
def q_ml_score(spark, d):
    return jobs.score_top(_order_features(spark, d), key="o_orderkey", k=3,
                          keep=["o_orderkey", "o_totalprice", "cust"])


@query("ml_metrics", """
WITH s AS (SELECT o_orderpriority AS g, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, floor(o_totalprice / 100) * 100 / (SELECT max(o_totalprice) + 1 FROM orders) AS s FROM orders),
r AS (SELECT *, rank() OVER (PARTITION BY g ORDER BY s) + (count(*) OVER (PARTITION BY g, s) - 1) / 2.0 AS rk FROM s),
b AS (SELECT g, abs(sum(s) - sum(y)) AS gap FROM s GROUP BY g, least(floor(s * 10), 9)),
e AS (SELECT g, sum(gap) AS gap FROM b GROUP BY g)
SELECT g, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives, round((sum(CASE WHEN y = 1 THEN rk END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))), 9) AS auc, round(avg((s - y) * (s - y)), 9) AS brier, round(any_value(gap) / count(*), 9) AS ece FROM r JOIN e USING (g) GROUP BY g
""")
def q_ml_metrics(spark, d):
    """A score table (the price, coarse enough for ties) measured against the order state, by priority."""
    o = T(spark, d, "orders").select("o_totalprice", F.col("o_orderpriority").alias("g"), "o_orderstatus")
    most = o.agg(F.max("o_totalprice") + 1).first()[0]
    scored = o.select("g", (F.col("o_orderstatus") == "F").cast("int").alias("y"),
                      (F.floor(F.col("o_totalprice") / 100) * 100 / F.lit(most)).alias("s"))
    m = model.binary_metrics(scored, "y", "s", ["g"])
    return m.select("g", "n", "positives", *[F.round(c, 9).alias(c) for c in ("auc", "brier", "ece")])


# --------------------------------------------------------------------------- jobs


@query("dim_athlete", """
SELECT c_custkey AS id, c_name AS name, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Trade' ELSE 'Other' END AS kind, TIMESTAMP '2024-01-01 00:00:00' AS insert_date, TRUE AS active FROM customer
""")
def q_dim_athlete(spark, d):
    g = jobs.customer_dimension(T(spark, d, "customer"), load_time="2024-01-01 00:00:00")
    return g.select("id", "name", "kind", "insert_date", "active")


@query("dim_round", """
SELECT CAST(row_number() OVER (ORDER BY d, p) AS INT) AS id, d, p AS priority, strftime(d, '%d/%m/%y') AS d_text, TRUE AS active FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, o_orderpriority AS p FROM orders)
""")
def q_dim_round(spark, d):
    g = jobs.order_round_dimension(T(spark, d, "orders"), load_time="2024-01-01 00:00:00")
    return g.select(F.col("id").cast("int").alias("id"), "d", "priority", "d_text", "active")


@query("silver_race", """
WITH d AS (SELECT d, p, CAST(row_number() OVER (ORDER BY d, p) AS INT) AS id FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, o_orderpriority AS p FROM orders)) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, c_custkey AS fk_customer, id AS fk_round, coalesce(nullif(l_returnflag, 'N'), 'NQ') AS result FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN d ON CAST(o_orderdate AS DATE) = d.d AND o_orderpriority = d.p
""")
def q_silver_race(spark, d):
    rounds = jobs.order_round_dimension(T(spark, d, "orders"))
    fact = jobs.line_fact_silver(T(spark, d, "lineitem"), T(spark, d, "orders"), T(spark, d, "customer"), rounds)
    return fact.withColumn("fk_round", F.col("fk_round").cast("int"))


@query("fact_race", """
SELECT o_orderpriority AS priority, l_returnflag IN ('A','R') AS qualified, CASE l_returnflag WHEN 'A' THEN 'Place' WHEN 'R' THEN 'Time' END AS qualification_type, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3
""")
def q_fact_race(spark, d):
    return jobs.fact_summary(T(spark, d, "lineitem"), T(spark, d, "orders"))


def _sheet_files(spark, d) -> DataFrame:
    """Result sheets derived from the tables: one file per nation (its suppliers'
    lines), three header lines, then one heats line per line item."""
    nat = T(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    path = F.concat(F.lit("sheets/"), F.col("n_name"), F.lit(".txt"))
    event = F.when(F.col("n_nationkey") % 2 == 0, F.lit("Men's 100m")).otherwise(F.lit("Women's 100m"))
    day = F.upper(F.date_format(F.date_add(F.lit("2024-08-01").cast("date"), F.col("n_regionkey")), "EEE d MMM yyyy"))
    header = nat.select(path.alias("file_path"), F.posexplode(F.array(
        F.lit("Stade de France Athlétisme"), F.concat(event, F.lit(" Round "), F.col("n_regionkey").cast("string")),
        day)).alias("line_no", "line")).select("file_path", F.lit(0).alias("page"),
                                               F.col("line_no").cast("long").alias("line_no"), "line")
    li = T(spark, d, "lineitem", spread=True)
    sup = T(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    j = li.join(sup, li.l_suppkey == sup.s_suppkey).join(nat, F.col("s_nationkey") == nat.n_nationkey)
    s = lambda c: F.col(c).cast("string")
    bracket = F.when(F.col("l_linestatus") == "F", F.concat(F.lit("(."), (F.col("l_tax") * 100).cast("int")
                                                            .cast("string"), F.lit(")")))
    flag = correct.case_map("l_returnflag", {"A": "Q", "R": "q"}, "x")
    line = F.concat_ws(" ", s("l_linenumber"), s("l_orderkey"), F.lit("SUP"), s("l_partkey"), F.col("n_name"),
                       (F.col("l_suppkey") % 8 + 1).cast("string"), s("l_linenumber"),
                       F.col("l_quantity").cast("int").cast("string"),
                       F.format_number(F.col("l_discount") * 100 + 9, 2), bracket, F.lit("+0.1"), flag)
    body = j.select(path.alias("file_path"), F.lit(0).alias("page"),
                    (F.col("l_orderkey") * 16 + F.col("l_linenumber") + 16).alias("line_no"), line.alias("line"))
    return header.unionByName(body)


_SHEET_SQL = """
WITH li AS (SELECT *, l_orderkey IN (514, 1206, 2055, 1042, 690, 452) AS reset FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
n AS (SELECT DISTINCT n_nationkey, n_regionkey, 'Round ' || n_regionkey AS round, strftime(DATE '2024-08-01' + n_regionkey, '%d/%m/%y') AS date, 'Stade de France' AS location, CASE WHEN n_nationkey % 2 = 0 THEN 'Men''s' ELSE 'Women''s' END AS event, '100m' AS event_type FROM li),
rounds AS (SELECT row_number() OVER (ORDER BY round, date, location, event, event_type) AS id, * FROM (SELECT DISTINCT round, date, location, event, event_type FROM n)),
race AS (SELECT l_orderkey AS FK_athlete_id, CAST(l_linenumber AS VARCHAR) AS rank, CAST(l_suppkey % 8 + 1 AS INT) AS heat, l_linenumber AS lane, CASE WHEN reset THEN 0 ELSE CAST(l_quantity AS INT) END AS position,
  (CASE WHEN reset THEN '0' ELSE printf('%.2f', l_discount * 100 + 9) END) || (CASE WHEN l_linestatus = 'F' THEN '.' || CAST(CAST(trunc(l_tax * 100) AS INT) AS VARCHAR) ELSE '.000' END) AS time,
  CASE WHEN reset THEN '0.0' ELSE '+0.1' END AS wind, CASE l_returnflag WHEN 'A' THEN 'Q' WHEN 'R' THEN 'q' ELSE 'NQ' END AS result, CAST(NULL AS VARCHAR) AS additional_info, r.id AS FK_round_id
  FROM li JOIN n USING (n_nationkey) JOIN rounds r ON r.round = n.round AND r.date = n.date AND r.event = n.event)
"""


def _sheet_landing(spark, d) -> DataFrame:
    """The landing rows of the derived sheets; the whole job writes them as its first layer."""
    words = T(spark, d, "nation").select("n_name")
    return jobs.lines_to_bronze(_sheet_files(spark, d), words, compat=False)[0]


def _sheet_bronze(spark, d) -> DataFrame:
    """The landing rows, written once."""
    return written(_sheet_landing(spark, d), "sheet-bronze")


def _sheet_dimensions(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    return jobs.add_missing_athletes(jobs.silver_athlete(bronze)), jobs.silver_round(bronze)


@query("sheet_athletes", _SHEET_SQL + """
, a AS (SELECT CAST(l_orderkey AS INT) AS id, 'SUP ' || l_partkey AS name, n_name AS noc_code, CASE WHEN n_nationkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender FROM li)
SELECT id, name, noc_code, gender FROM a QUALIFY row_number() OVER (PARTITION BY id ORDER BY name, noc_code, gender) = 1
UNION ALL SELECT * FROM (VALUES (514, 'MULAMBA Dominique Lasconi', 'COD', 'Male'), (452, 'BROWN Aaron', 'CAN', 'Male'), (690, 'AZU Jeremiah', 'GBR', 'Male'), (1042, 'SABINO Steven', 'MOZ', 'Male')) v(id, name, noc_code, gender) WHERE id NOT IN (SELECT id FROM a)
""")
def q_sheet_athletes(spark, d):
    return _sheet_dimensions(_sheet_bronze(spark, d))[0]


@query("sheet_rounds", _SHEET_SQL + "SELECT id, round, date, location, event, event_type FROM rounds")
def q_sheet_rounds(spark, d):
    return _sheet_dimensions(_sheet_bronze(spark, d))[1]


@query("sheet_races", _SHEET_SQL + "SELECT * FROM race")
def q_sheet_races(spark, d):
    bronze = _sheet_bronze(spark, d)
    race = jobs.silver_race(bronze, *_sheet_dimensions(bronze))
    return race.withColumn("FK_athlete_id", F.col("FK_athlete_id").cast("bigint"))


@query("sheet_gold", _SHEET_SQL + """
SELECT FK_athlete_id AS NK_athlete, FK_round_id AS NK_round, rank, heat, lane, position, time, wind, result IN ('Q', 'q') AS qualified, CASE result WHEN 'Q' THEN 'Place' WHEN 'q' THEN 'Time' END AS qualification_type, FALSE AS disqualified, CAST(NULL AS VARCHAR) AS disqualification_type, FALSE AS record, CAST(NULL AS VARCHAR) AS record_type, TIMESTAMP '2024-08-10 00:00:00' AS insert_date, TIMESTAMP '2024-08-10 00:00:00' AS modified_date, TRUE AS active FROM race
""")
def q_sheet_gold(spark, d):
    """Every row of the gold fact that the whole job (N1-N5) publishes."""
    paths = jobs.medallion_job(spark, _sheet_landing(spark, d), scratch_path(spark, "sheet-gold"),
                               load_time="2024-08-10 00:00:00")
    fact = load(spark, paths["gold_fact_race"])
    return fact.withColumn("NK_athlete", F.col("NK_athlete").cast("bigint"))


@query("sheet_kept_rounds", _SHEET_SQL + """
SELECT event, count(*) AS n, CAST(sum(position) AS BIGINT) AS pos_sum FROM race JOIN rounds ON FK_round_id = id WHERE round NOT IN ('Round 2', 'Round 4') GROUP BY event
""")
def q_sheet_kept_rounds(spark, d):
    """Rounds left out by name: the fact's partitions are pruned through the dimension."""
    paths = jobs.medallion_job(spark, _sheet_landing(spark, d), scratch_path(spark, "sheet-kept"))
    rounds = load(spark, paths["gold_dim_round"])
    kept = shape.keep_by_dimension(load(spark, paths["gold_fact_race"]), "NK_round", rounds, "id",
                                   ~F.col("round").isin("Round 2", "Round 4"))
    return kept.join(rounds.select("id", "event"), F.col("NK_round") == F.col("id")).groupBy("event").agg(
        F.count(F.lit(1)).alias("n"), F.sum("position").alias("pos_sum"))


@query("sheet_medallion", """
SELECT l_returnflag IN ('A','R') AS qualified, CASE l_returnflag WHEN 'A' THEN 'Place' WHEN 'R' THEN 'Time' END AS qualification_type, count(*) AS n, CAST(sum(CASE WHEN l_orderkey IN (514, 1206, 2055, 1042, 690, 452) THEN 0 ELSE CAST(l_quantity AS INT) END) AS BIGINT) AS pos_sum, count(DISTINCT l_orderkey) AS athletes, count(DISTINCT n_regionkey * 2 + n_nationkey % 2) AS rounds FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2
""")
def q_sheet_medallion(spark, d):
    """The reference's own chain (N1-N5) on sheets derived from the tables:
    header fill, layout parse, bronze, silver athlete/round/race with every
    correction, gold fact with flags — each layer written and read back."""
    paths = jobs.medallion_job(spark, _sheet_landing(spark, d), scratch_path(spark, "sheet-medallion"),
                               load_time="2024-08-10 00:00:00")
    fact = load(spark, paths["gold_fact_race"])
    return fact.groupBy("qualified", "qualification_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("position").alias("pos_sum"),
        F.countDistinct("NK_athlete").alias("athletes"), F.countDistinct("NK_round").alias("rounds"))


@query("medallion_job", """
SELECT 'dim_customer' AS tbl, count(*) AS n FROM customer UNION ALL SELECT 'dim_round', count(*) FROM (SELECT DISTINCT CAST(o_orderdate AS DATE), o_orderpriority FROM orders) UNION ALL SELECT 'fact', count(*) FROM lineitem
""")
def q_medallion_job(spark, d):
    out = scratch_path(spark, "medallion")
    return jobs.driver_medallion_job(spark, d, out, load_time="2024-01-01 00:00:00")
