"""Ranked lexical search by the Best Position Algorithm.

Texts are cut into terms once; a compact table keeps each document's length and the
terms that the queries ask for.  Corpus statistics come from all of it.  A task then
searches its documents in chunks: within a chunk each term has a list of documents
by falling impact, all lists of a query are read from the top, every document met is
scored by direct access to the other lists, and each list's best position is the end
of the positions seen without a gap, whether read or reached directly.  The sum of
the impacts there bounds every document not seen; the search of the chunk ends when
that is strictly below the k-th score.  Each chunk's best are merged by rank.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.llm.common import materialise

TOP = 50
#: Queries are searched in blocks of so many distinct terms (a query with more is a block of its own).
BLOCK_TERMS = 200_000
#: Postings that a task holds at once.
CHUNK_POSTINGS = 1_500_000
#: Positions read from each list in the first round; every round reads twice as many.
FIRST_DEPTH = 16
#: Parts of a query's merge, so that no task gets the best of all chunks of a query.
MERGE_PARTS = 32

#: Bytes of terms: digits, letters (A-Z lower-cased) and all above ASCII; the rest separates.
_TABLE = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
               for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Chunk:
    """Postings of some documents: by document, and as impact lists by term."""

    def __init__(self, starts: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        self.n_docs = len(starts) - 1
        self.starts, self.term, self.impact = starts, term, impact
        doc = np.repeat(np.arange(self.n_docs), np.diff(starts))
        order = np.lexsort((-impact, term))
        self.list_doc, self.list_impact = doc[order], impact[order]
        self.bounds = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.place = np.empty(len(term), np.int64)  # a posting's position in its list
        self.place[order] = np.arange(len(term)) - self.bounds[term[order]]

    def search(self, query: np.ndarray, k: int, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of all that can be among the best ``k``; ``column`` is scratch of -1 for each term."""
        lists = query[self.bounds[query + 1] > self.bounds[query]]
        if not len(lists):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        begin = self.bounds[lists]
        size = self.bounds[lists + 1] - begin
        offset = np.concatenate(([0], np.cumsum(size)))
        reached = np.zeros(offset[-1], dtype=bool)  # positions seen, list by list
        best = np.zeros(len(lists), np.int64)  # positions seen without a gap
        column[lists] = np.arange(len(lists))
        seen = np.zeros(self.n_docs, dtype=bool)
        docs, scores = [], []
        found, kth, depth, step = 0, 0, 0, FIRST_DEPTH
        while depth < size.max():
            # sorted access: the next positions of every list
            at = depth + np.arange(step)
            inside = at[None, :] < size[:, None]
            met = np.unique(self.list_doc[(begin[:, None] + at[None, :])[inside]])
            new = met[~seen[met]]
            depth += step
            step *= 2
            if len(new):
                seen[new] = True
                # direct access: the documents' postings in all lists of the query
                n = self.starts[new + 1] - self.starts[new]
                upto = np.cumsum(n)
                post = np.arange(upto[-1]) + np.repeat(self.starts[new] - (upto - n), n)
                own = np.repeat(np.arange(len(new)), n)
                col = column[self.term[post]]
                hit = col >= 0
                post, own, col = post[hit], own[hit], col[hit]
                score = np.zeros(len(new), np.int64)
                np.add.at(score, own, self.impact[post])
                reached[offset[col] + self.place[post]] = True
                docs.append(new)
                scores.append(score)
                found += len(new)
            bound = 0
            for i in range(len(lists)):
                rest = reached[offset[i] + best[i]:offset[i + 1]]
                gap = int(rest.argmin()) if len(rest) else 0
                best[i] += len(rest) if len(rest) and rest[gap] else gap
                if best[i] < size[i]:
                    bound += int(self.list_impact[begin[i] + max(best[i] - 1, 0)])
            if found >= k:
                every = np.concatenate(scores)
                kth = np.partition(every, found - k)[found - k]
                docs, scores = [np.concatenate(docs)], [every]
                if bound < kth:
                    break
        column[lists] = -1
        return np.concatenate(docs), np.concatenate(scores)


def _counted(docs: DataFrame, vocabulary) -> DataFrame:
    """(id, n, terms, tfs): terms of the whole text, and those of the vocabulary with their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = vocabulary.value
        for batch in batches:
            n, ids, tfs = [], [], []
            for text in batch.column("_text").to_pylist():
                words = terms(text)
                n.append(len(words))
                counts = [(index[w], c) for w, c in Counter(words).items() if w in index]
                both = np.asarray(counts, np.int64).reshape(-1, 2)
                ids.append(both[:, 0].astype(np.int32).tobytes())
                tfs.append(both[:, 1].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(tfs, pa.binary())],
                names=["_id", "n", "terms", "tfs"])

    kind = docs.schema["_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"_id {kind}, n bigint, terms binary, tfs binary")


def _frequencies(counted: DataFrame, n_terms: int) -> DataFrame:
    """(term, df): documents that hold each term of the vocabulary, summed up in the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32)
            total += np.bincount(ids, minlength=n_terms)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["term", "df"])

    return counted.select("terms").mapInArrow(run, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df"))


def _searched(counted: DataFrame, weights: np.ndarray, queries: list, n_docs: int, n_all: int, k: int) -> DataFrame:
    """(item, id, score): the best of each chunk of documents for each query."""
    shared = counted.sparkSession.sparkContext.broadcast((weights, queries))

    def chunk_best(held: list[pa.RecordBatch], column: np.ndarray) -> pa.RecordBatch | None:
        w, wanted = shared.value
        table = pa.Table.from_batches(held)
        blobs = table.column("terms").to_pylist()
        term = np.frombuffer(b"".join(blobs), np.int32)
        tf = np.frombuffer(b"".join(table.column("tfs").to_pylist()), np.int64)
        size = np.asarray([len(b) // 4 for b in blobs], np.int64)
        m = 50 + 50 * table.column("n").to_numpy() * n_docs // n_all
        impact = w[term] * (1_000_000_000 * tf // (1000 * tf + 20 * np.repeat(m, size)))
        keep = impact > 0
        starts = np.concatenate(([0], np.cumsum(np.bincount(np.repeat(np.arange(len(size)), size)[keep],
                                                            minlength=len(size)))))
        chunk = Chunk(starts, term[keep], impact[keep], len(w))
        ids = table.column("_id").combine_chunks()
        rank = np.empty(len(ids), np.int64)
        rank[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
        items, rows, scores = [], [], []
        for item, query in wanted:
            docs, score = chunk.search(query, k, column)
            order = np.lexsort((rank[docs], -score))[:k]
            items.append(np.full(len(order), item, np.int64))
            rows.append(docs[order])
            scores.append(score[order])
        at = np.concatenate(rows)
        if not len(at):
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(items)), ids.take(pa.array(at)),
                                           pa.array(np.concatenate(scores))], names=["item", "_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column = np.full(len(shared.value[0]), -1, np.int64)
        held, size = [], 0
        for batch in batches:
            for s in range(0, batch.num_rows, 2000):
                part = batch.slice(s, 2000)
                held.append(part)
                size += sum(map(len, part.column("terms").to_pylist())) // 4
                if size >= CHUNK_POSTINGS:
                    out = chunk_best(held, column)
                    held, size = [], 0
                    if out is not None:
                        yield out
        if held:
            out = chunk_best(held, column)
            if out is not None:
                yield out

    kind = counted.schema["_id"].dataType.simpleString()
    return counted.filter("length(terms) > 0").mapInArrow(run, f"item bigint, _id {kind}, score bigint")


def _item_blocks(items: DataFrame, block_terms: int) -> Iterator[tuple[dict, list]]:
    """(vocabulary, queries) of blocks of the queries; a query is its number and its distinct term ids."""
    index: dict[bytes, int] = {}
    queries: list[tuple[int, np.ndarray]] = []
    for row in items.select("item", F.col("_text").cast("binary").alias("t")).toLocalIterator():
        words = sorted(set(terms(row["t"])))
        if queries and len(index) + len(words) > block_terms:
            yield index, queries
            index, queries = {}, []
        if words:
            queries.append((row["item"], np.asarray([index.setdefault(w, len(index)) for w in words], np.int64)))
    if queries:
        yield index, queries


def _best(rows: DataFrame, k: int) -> DataFrame:
    order = [F.desc("score"), F.col("_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("_id", "score"), F.lit(MERGE_PARTS))
    some = rows.withColumn("part", part) \
        .withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))) \
        .filter(F.col("rank") <= k).drop("part", "rank")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP, doc_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``k`` best documents for each item: item id, ``rank`` from 1, document id, ``score`` (above 0).

    Equal scores go by ascending document id.  Null, empty and term-less texts match
    nothing and do not count as documents; repeated rows of documents count and are
    ranked each, equal rows of items are one item; documents without an id follow those
    with one at equal score; an empty table on either side gives no rows; other columns are
    ignored.  Items are searched in blocks of ``block_terms`` terms against all documents.
    """
    spark: SparkSession = docs.sparkSession
    source = docs.select(F.col(doc_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    asked = materialise(items.select(F.col(item_col).alias("_item"), F.col(item_text_col).alias("_text")).distinct()
                        .withColumn("item", F.monotonically_increasing_id()), "items")
    out: DataFrame | None = None
    for index, queries in _item_blocks(asked, block_terms):
        counted = materialise(_counted(source, spark.sparkContext.broadcast(index)), "term-counts")
        n_docs, n_all = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        if not n_docs:
            continue
        weights = np.zeros(len(index), np.int64)
        for row in _frequencies(counted, len(index)).collect():  # at most a row for each term of the block
            weights[row["term"]] = weight(n_docs, row["df"])
        found = materialise(_best(_searched(counted, weights, queries, n_docs, n_all, k), k), "ranked")
        out = found if out is None else out.unionByName(found)
    if out is None:
        kind = source.schema["_id"].dataType.simpleString()
        out = spark.createDataFrame([], f"item bigint, _id {kind}, score bigint, rank int")
    return out.join(asked.select("item", "_item"), "item").select(
        F.col("_item").alias(item_col), "rank", F.col("_id").alias(doc_col), "score")
