"""Interaction of quality filters, with duplicate texts found in radix tries.

A task first puts its own texts into compressed tries, so every text leaves it once,
with the smallest id at its terminal; rows with a larger id are known duplicates.
The texts that are left are dealt by prefixes that grow where too many bytes share one, and
sorted ranges of prefixes are put into tries again: a text is a duplicate if its id is
larger than the smallest one of its terminal.  What remains of a row is a mask of the
filters that it fails, and all orders of the filters are answered from counts of masks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.common import materialise, shuffle_partitions, small_batches
from podium.operators.conform import left_join_spread_nulls

FILTERS = "ABCDE"
DUPLICATE = 16  # bit of filter E
#: Bytes and rows of a task's own tries before they are emptied.
LOCAL_BYTES, LOCAL_ROWS = 32 << 20, 50_000
#: Lengths of prefixes; a prefix grows while more than so many bytes of texts share it.
PREFIX_BYTES = (8, 32, 128, 512, 2048, 8192, 32768, 131072)
RANGE_BYTES = 32 << 20

_UPPER = bytes(range(0x41, 0x5B))
_INNER = bytes(range(0x80, 0xC0))  # bytes inside a code point
_MARKS = re.compile(rb"[#$%&*|]")


def mask(text: bytes) -> int:
    """Bits of the filters A to D that a text fails (A is 1)."""
    words = text.split()  # ASCII white space
    caps = len(text) - len(text.translate(None, _UPPER))
    chars = len(text.translate(None, _INNER))
    return (len(words) < 200) + 2 * (100 * len(set(words)) < 50 * len(words)) + 4 * (100 * caps > 3 * chars) \
        + 8 * (_MARKS.search(text) is not None)


class _Node:
    __slots__ = ("edges", "low", "rows")

    def __init__(self):
        self.edges: dict[int, tuple[bytes, _Node]] = {}
        self.low = None  # smallest id of the text that ends here
        self.rows: list | None = None


def _common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common start of ``a`` and of ``b`` from ``at``."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[at + low:at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


class Trie:
    """Compressed trie of whole texts; a terminal holds the smallest id and the rows of its text."""

    def __init__(self):
        self.root = _Node()
        self.ends: list[_Node] = []

    def add(self, text: bytes, key, row) -> bool:
        """Put a row of ``text`` in; True if the text is new."""
        node, at = self.root, 0
        while at < len(text):
            edge = node.edges.get(text[at])
            if edge is None:
                end = _Node()
                node.edges[text[at]] = (text[at:], end)
                node = end
                break
            label, child = edge
            if not text.startswith(label, at):
                same = _common(label, text, at)
                inner = _Node()
                inner.edges[label[same]] = (label[same:], child)
                node.edges[text[at]] = (label[:same], inner)
                child, label = inner, label[:same]
            node, at = child, at + len(label)
        new = node.rows is None
        if new:
            node.rows = []
            self.ends.append(node)
        if key is not None and (node.low is None or key < node.low):
            node.low = key
        node.rows.append(row)
        return new

    def terminals(self) -> Iterator[tuple[bytes, object, list]]:
        """(text, smallest id, rows) of every text, by a walk over the trie."""
        todo: list[tuple[bytes, _Node]] = [(b"", self.root)]
        while todo:
            text, node = todo.pop()
            if node.rows is not None:
                yield text, node.low, node.rows
            todo.extend((text + label, child) for label, child in node.edges.values())


def _rows_out(rows: list, kind: pa.DataType, texts: bool) -> pa.RecordBatch:
    ids, parts, masks, counts, text = zip(*rows)
    arrays = [pa.array(ids, kind), pa.array(parts, pa.string()), pa.array(masks, pa.int32()), pa.array(counts, pa.int64())]
    names = ["_id", "part", "mask", "n"]
    if texts:
        arrays.append(pa.array(text, pa.binary()))
        names.append("_text")
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _local(source: DataFrame) -> DataFrame:
    """(id, part, mask, n, text): rows decided in their task have no text; a text is kept once a trie, with its smallest id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, size, count, masks, kind = Trie(), 0, 0, {}, None

        def emptied() -> pa.RecordBatch:
            out = []
            for end in trie.ends:
                code, text = masks[id(end)]
                first: dict[str, int] = {}
                for key, part in end.rows:
                    if key is None:
                        out.append((key, part, code, 1, None))
                    elif key == end.low:
                        first[part] = first.get(part, 0) + 1
                    else:
                        out.append((key, part, code | DUPLICATE, 1, None))
                out.extend((end.low, part, code, n, text) for part, n in first.items())
            return _rows_out(out, kind, True)

        for batch in batches:
            kind = batch.schema.field("_id").type
            for key, part, text in zip(*(batch.column(c).to_pylist() for c in ("_id", "part", "_text"))):
                if trie.add(text, key, (key, part)):
                    masks[id(trie.ends[-1])] = (mask(text), text)
                    size += len(text)
                count += 1
                if size >= LOCAL_BYTES or count >= LOCAL_ROWS:
                    yield emptied()
                    trie, size, count, masks = Trie(), 0, 0, {}
        if count:
            yield emptied()

    kind = source.schema["_id"].dataType.simpleString()
    return source.mapInArrow(run, f"_id {kind}, part string, mask int, n bigint, _text binary")


def _prefixed(texts: DataFrame) -> DataFrame:
    """``texts`` with ``prefix``: as long as more than RANGE_BYTES of texts would share a shorter one.

    The prefixes that must grow are sent to the tasks: a level has no more of them
    than the texts have bytes, divided by RANGE_BYTES.
    """
    rows = texts.withColumn("_len", F.lit(PREFIX_BYTES[0]))

    def hashed(length: int):
        return F.xxhash64(F.substring("_text", 1, length))

    for short, long in zip(PREFIX_BYTES, (*PREFIX_BYTES[1:], (1 << 31) - 1)):
        mass = rows.filter(F.col("_len") == short).groupBy(hashed(short).alias("_h")).agg(
            F.sum(F.octet_length("_text") + 64).alias("bytes"))
        over = materialise(mass.filter(F.col("bytes") > RANGE_BYTES).select("_h", F.lit(short).alias("_of")), "prefixes")
        if over.isEmpty():
            break
        rows = rows.join(F.broadcast(over), (hashed(short) == over["_h"]) & (F.col("_len") == over["_of"]), "left") \
            .withColumn("_len", F.when(F.col("_of").isNull(), F.col("_len")).otherwise(long)).drop("_h", "_of")
    return rows.withColumn("prefix", F.expr("substring(_text, 1, _len)")).drop("_len")


def _decided(texts: DataFrame) -> DataFrame:
    """(id, part, mask, n): the rows that held a text, with the duplicate bit where a smaller id has the same text."""
    kind = texts.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, size, last, known = Trie(), 0, None, None

        def emptied() -> pa.RecordBatch:
            return _rows_out([(key, part, code | (DUPLICATE if key > end.low else 0), n, None)
                              for end in trie.ends for key, part, code, n in end.rows], known, False)

        for batch in batches:
            known = batch.schema.field("_id").type
            for prefix, text, *row in zip(*(batch.column(c).to_pylist() for c in ("prefix", "_text", "_id", "part", "mask", "n"))):
                if size >= RANGE_BYTES and prefix != last:
                    yield emptied()
                    trie, size = Trie(), 0
                size += 64 + (len(text) if trie.add(text, row[0], row) else 0)
                last = prefix
        if trie.ends:
            yield emptied()

    return texts.repartitionByRange(shuffle_partitions(texts.sparkSession), "prefix").sortWithinPartitions("prefix") \
        .select("prefix", "_text", "_id", "part", "mask", "n").mapInArrow(run, f"_id {kind}, part string, mask int, n bigint")


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, mask, n): how many rows of an id and a part fail which filters."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                         F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    local = materialise(_local(source), "local-texts")
    open_texts = local.filter("_text IS NOT NULL")
    return local.filter("_text IS NULL").drop("_text").unionByName(_decided(_prefixed(open_texts)))


def orders_table(counts: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, ...) from (part, mask, good, toxic, n)."""
    bit = {f: 1 << i for i, f in enumerate(FILTERS)}

    def bits(letters):
        return sum((F.when(F.contains(letters, F.lit(f)), v).otherwise(0) for f, v in bit.items()), F.lit(0))

    orders = ",".join(sorted("".join(p) for p in permutations(FILTERS)))
    rows = counts.withColumn("filter_order", F.explode(F.split(F.lit(orders), ","))) \
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))) \
        .withColumn("own", bits(F.expr("substring(filter_order, step, 1)"))) \
        .withColumn("before", bits(F.expr("substring(filter_order, 1, step - 1)")))
    fails = F.col("mask").bitwiseAND(F.col("own")) != 0
    earlier = F.col("mask").bitwiseAND(F.col("before")) != 0

    def total(when, n=F.col("n")):
        return F.sum(F.when(when, n).otherwise(F.lit(0))).cast("long")

    # of all orders, a filter comes first among those that a document fails in one of so many
    first = (F.col("n") * 120 / F.bit_count("mask")).cast("long")
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~earlier).alias("kept"), total(fails & ~earlier).alias("removed"),
        total(fails & earlier).alias("redundant"), total(F.col("mask") == F.col("own")).alias("unique_fails"),
        total(fails & ~earlier & (F.col("good") == 1)).alias("good_lost"),
        total(fails & ~earlier & (F.col("toxic") == 1)).alias("toxic_lost"), total(fails, first).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
          good_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """What each of five filters removes at each step of all orders, for each part.

    A null text is empty, a null part the empty string.  A row is a duplicate if a row with a
    smaller id has the same text, so repeated rows of one id are none of each other, and
    rows without an id are none and make none.  An id is good or toxic if any label row of it says so;
    rows without a label or an id are neither.  An empty table gives no rows; other columns are ignored.
    """
    known = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        F.max((F.col(good_col) == 1).cast("int")).alias("good"), F.max((F.col(toxic_col) == 1).cast("int")).alias("toxic"))
    rows = failures(docs, id_col, text_col, part_col).groupBy("_id", "part", "mask").agg(F.sum("n").alias("n"))
    counts = left_join_spread_nulls(rows, known, ["_id"]).groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
    return orders_table(materialise(counts, "mask-counts"))
