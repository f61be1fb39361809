"""I-Match document fingerprints (built-in expressions only).

Terms within a band of inverse document frequency form the lexicon.  A document's
distinct lexicon terms, sorted, are hashed whole and again within several random
subsets of the lexicon; each hash is one part of the fingerprint.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.common import long_array, range_of, shuffle_partitions

#: Terms are counted by slot, a hash of so many bits, so the lexicon has a fixed size
#: (2^20 bits, 128 KB) at any corpus size; frequencies are exact counts of documents.
SLOT_BITS = 20
SEED = 41
#: Band of document frequency (shares of all documents), i.e. ln 4 <= idf <= ln 2000.
LOW, HIGH = 1 / 2000, 1 / 4
#: Random subsets: (bits, how many); each keeps a term with chance 2^-bits.  Wide ones
#: match only on (nearly) equal texts, narrow ones still do after many changes.
SUBSETS = ((1, 4), (3, 6), (5, 6), (7, 6))


def _term_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(text), r"[\s\p{Punct}]+"), "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(F.lit(SEED), w)))


def _slot(h: Column) -> Column:
    return h.bitwiseAND(F.lit((1 << SLOT_BITS) - 1))


def lexicon(docs: DataFrame, text_col: str = "text", low: float = LOW, high: float = HIGH) -> np.ndarray:
    """Bits of the slots whose document frequency lies within the band, counted over all documents."""
    slots = docs.select(F.explode(F.array_distinct(
        F.transform(_term_hashes(F.coalesce(F.col(text_col), F.lit(""))), _slot))).alias("slot"))
    n = docs.count()
    inside = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("df")) \
        .filter((F.col("df") >= low * n) & (F.col("df") <= max(1.0, high * n)))
    words = inside.groupBy(F.shiftright("slot", 6).alias("at")) \
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("slot").bitwiseAND(F.lit(63))
                                      .cast("int"))).alias("bits")).collect()
    out = np.zeros(1 << (SLOT_BITS - 6), dtype=np.int64)
    for r in words:
        out[r["at"]] = r["bits"]
    return out


def _lexicon_terms(text: Column, bits: Column) -> Column:
    """Hashes of the text's distinct lexicon terms, sorted."""
    return F.sort_array(F.filter(_term_hashes(text), lambda h: F.bit_get(
        F.get(bits, F.shiftright(_slot(h), 6).cast("int")), h.bitwiseAND(F.lit(63)).cast("int")) == 1))


def _drawn(mask: int, again: bool):
    """Whether a term hash belongs to the random subset of ``mask``."""
    def test(h: Column) -> Column:
        return (F.xxhash64(F.lit(SEED + 1), h) if again else h).bitwiseAND(F.lit(mask)) == 0
    return test


def _hashes(terms: Column, text: Column) -> Column:
    """array<bigint>: hash of all lexicon terms (of the text if it has none), then of each subset (null: empty)."""
    out = [F.when(F.size(terms) > 0, F.xxhash64(F.lit(0), terms)).otherwise(F.xxhash64(F.lit(1), text))]
    at, again, k = SLOT_BITS, False, 1
    for width, count in SUBSETS:
        for _ in range(count):
            if at + width > 63:  # further random bits of a term come from a second hash
                assert not again, "two hashes have no more bits for subsets"
                at, again = 0, True
            mine = F.filter(terms, _drawn(((1 << width) - 1) << at, again))
            out.append(F.when(F.size(mine) > 0, F.xxhash64(F.lit(k), mine)))
            at, k = at + width, k + 1
    return F.array(*out)


def with_fingerprint(df: DataFrame, bits: Column, text: Column, name: str) -> DataFrame:
    """Add the fingerprint's hashes as array<bigint> ``name``."""
    terms = f"__terms_{name}"
    return df.withColumn(terms, _lexicon_terms(text, bits)).withColumn(name, _hashes(F.col(terms), text)).drop(terms)


def as_text(hashes: Column) -> Column:
    """Hex of the hashes, joined by '-'; '0' stands for a subset without terms."""
    return F.array_join(F.transform(hashes, lambda h: F.coalesce(F.lower(F.hex(h)), F.lit("0"))), "-")


def likeness(a: Column, b: Column) -> Column:
    """Equal parts over parts that either fingerprint has (0 to 1; 1 for equal texts)."""
    both = F.zip_with(a, b, lambda x, y: F.when(x == y, F.lit(1)).when(x.isNotNull() | y.isNotNull(), F.lit(0)))
    either = F.filter(both, lambda v: v.isNotNull())
    return F.size(F.filter(either, lambda v: v == 1)) / F.size(either)


def with_next(docs: DataFrame, id_col: str, carried: list[str], blocks: int) -> DataFrame:
    """Add ``next_<c>`` of the next row by id (after the last: the first) for each carried column.

    Ids are cut into blocks at their quantiles; the first rows of a block also go,
    as ghosts, to the end of the block before, so each block is ordered by itself and
    the rows are shuffled once.  Rows of one id follow each other by content hash.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    keyed = docs.withColumn("__k", key)
    cuts = keyed.agg(F.percentile_approx("__k", [i / blocks for i in range(1, blocks)] or [0.5], 10_000).alias("q")) \
        .first()["q"] or []
    cuts = sorted(set(cuts)) if blocks > 1 else []
    block = range_of(F.col("__k"), cuts)
    first = {r["b"]: r["m"] for r in docs.select(key.alias("__k")).groupBy(block.alias("b"))
             .agg(F.min("__k").alias("m")).collect()}
    used = sorted(first)
    before = {b: used[i - 1] for i, b in enumerate(used)}
    n = len(cuts) + 1
    lows, prevs = long_array(first.get(b, 0) for b in range(n)), long_array(before.get(b, 0) for b in range(n))
    placed = keyed.withColumn("__b", block)
    own = F.struct(F.col("__b").cast("long").alias("b"), F.lit(0).alias("g"))
    ghost = F.struct(F.get(prevs, F.col("__b")).alias("b"), F.lit(1).alias("g"))
    placed = placed.withColumn("__p", F.explode(
        F.when(F.col("__k") == F.get(lows, F.col("__b")), F.array(own, ghost)).otherwise(F.array(own))))
    order = Window.partitionBy("__p.b").orderBy("__p.g", "__k", "__h")
    return placed.withColumns({f"next_{c}": F.lead(c).over(order) for c in carried}) \
        .filter(F.col("__p.g") == 0).drop("__p", "__b", "__k")


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text.

    The edited text has its last floor(n/2) code points replaced by the first as many
    (or all) of the next document's.  Returns id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.  A null text counts as empty; texts
    without a lexicon term are hashed as they are; a single document follows itself;
    repeated rows and null ids (which come first) give one row each; an empty table
    gives none; other columns are ignored.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    bits = long_array(lexicon(source, "text"))
    own = with_fingerprint(source, bits, F.col("text"), "parts").withColumn("__h", F.xxhash64("text"))
    pairs = with_next(own, "doc_id", ["text", "parts"], 4 * shuffle_partitions(docs.sparkSession))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half),
                      F.substring(F.col("next_text"), F.lit(1), half))
    pairs = pairs.withColumn("edited", edited)
    pairs = with_fingerprint(pairs, bits, F.col("edited"), "edited_parts")
    return pairs.select(
        F.col("doc_id").alias(id_col), n.cast("long").alias("n_chars"),
        F.sha2(F.encode(F.col("edited"), "UTF-8"), 256).alias("edited_sha256"),
        as_text(F.col("parts")).alias("fingerprint"), as_text(F.col("edited_parts")).alias("edited_fingerprint"),
        likeness(F.col("parts"), F.col("edited_parts")).alias("near_edited"),
        likeness(F.col("parts"), F.col("next_parts")).alias("near_next"))
