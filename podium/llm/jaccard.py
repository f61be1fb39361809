"""N-gram Jaccard join with token-combination prefixes, and the groups its links form.

A text's set is its distinct word shingles, as 64-bit hashes.  Two sets at or above
the threshold share a signature of their prefixes: a single rare shingle, or a pair
of frequent ones (prefixes are extended so that this stays certain).  Candidates
pass a size test and an upper bound of the overlap, then the texts are compared.
Copies (equal sets) collapse first, and within a signature records are compared with
a leader before all that is still apart is, so a large group is not squared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.common import discard, materialise, small_batches
from podium.llm.graph import components

WORDS = 5
THRESHOLD = 80  # per cent
#: A shingle is frequent if chunks of documents that hold it more than once count it so often in all.
FREQUENT = 8
#: Bound of the table of frequent shingles sent to tasks; further ones are treated as rare (still exact).
MAX_FREQUENT = 1 << 17
CHUNK_SHINGLES = 4_000_000
SEEN_SETS = 200_000
#: Bytes from which on a word is hashed on its own.
LONG_WORD = 64
#: Rounds in which a record of a large signature sends its likeliest pair alone, before all that is still apart is sent.
SEEK_ROUNDS = 2
#: Records of a signature that a task compares with each other at once.
BLOCK = 2048
#: Up to so many records of a signature are compared one by one.
FEW = 24
#: Pairs that a task remembers to have sent.
SENT_PAIRS = 100_000
#: Bits for each key of a filter, and the powers of two that bound its bits (4 MB at most).
KEY_BITS, LEAST_BITS, MOST_BITS = 16, 10, 25

_MUL = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                 0x85EBCA77C2B2AE63], dtype=np.uint64)
#: Bytes that belong to words; masks of the first bytes of eight.
_IN_WORD = np.asarray([not bytes([x]).isspace() for x in range(256)])
_FIRST = np.asarray([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of a text in lower case, in order: eight bytes at a time, all words at once."""
    held = np.frombuffer(b"%b%b" % (text, bytes(8)), np.uint8)
    inside = np.zeros(len(text) + 2, dtype=bool)
    inside[1:-1] = _IN_WORD[held[:len(text)]]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    eights = np.ndarray((len(text) + 1,), "<u8", held, strides=(1,))
    out = _mix((eights[starts] & _FIRST[np.minimum(sizes, 8)]) ^ (sizes.astype(np.uint64) * _MUL[0]))
    more, at = np.flatnonzero(sizes > 8), 8
    while len(more) and at < LONG_WORD:
        rest = sizes[more] - at
        out[more] = _mix((eights[starts[more] + at] & _FIRST[np.minimum(rest, 8)]) ^ (out[more] * _MUL[1]))
        more, at = more[rest > 8], at + 8
    if len(more):
        import xxhash
        for k in more:
            out[k] = xxhash.xxh64_intdigest(text[starts[k]:starts[k] + sizes[k]])
    return out


def shingle_set(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles; with fewer words, of the whole sequence."""
    lower = (text or "").encode("utf-8", "surrogatepass").lower()  # bytes: A-Z and ASCII white space only
    w = word_hashes(lower)
    n = len(w) - size + 1
    if n < 1:
        if not len(w):
            return w
        import xxhash
        return np.asarray([xxhash.xxh64_intdigest(b" ".join(lower.split()), seed=len(w))], dtype=np.uint64)
    total = w[:n] * _MUL[0]
    for k in range(1, size):
        total += w[k:k + n] * _MUL[k]
    total = _mix(total)
    total.sort()
    first = np.ones(n, dtype=bool)
    np.not_equal(total[1:], total[:-1], out=first[1:])
    return total[first]


def set_id(tokens: np.ndarray) -> int:
    """64-bit id of a set (0: empty)."""
    if not len(tokens):
        return 0
    import xxhash
    return int(np.int64(np.uint64(xxhash.xxh64_intdigest(tokens.tobytes())))) or 1


def prefix_need(n: int, threshold: int = THRESHOLD) -> int:
    """One more than the shingles that a linked set may lack."""
    return n - -(-threshold * n // 100) + 1


def signatures(tokens: np.ndarray, frequent: np.ndarray, threshold: int = THRESHOLD) -> np.ndarray:
    """Signatures of a set; any two linked different sets have one in common.

    Order: rare shingles by hash, then frequent ones by hash.  With ``need`` = one
    more than a linked set may lack, the prefix holds ``need`` rare shingles, or all
    of them and so many frequent ones that, class by class, all but the first of each
    class make up the rest: a linked set that lacks fewer than ``need`` of the prefix
    keeps a rare shingle or two frequent ones of a class.  The number of classes
    depends on the size level; a set signs for its own level and those its partners
    may have.
    """
    n = len(tokens)
    if n * 100 < threshold * (n + 1):  # so small that only equal sets link
        return np.empty(0, dtype=np.int64)
    need = prefix_need(n, threshold)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        common = frequent[at] == tokens
        rare = tokens[~common]
    else:
        common, rare = None, tokens
    if len(rare) >= need:
        return rare[:need].astype(np.int64)
    out = [rare]
    often = tokens[common] if common is not None else tokens[:0]
    low, high = -(-threshold * n // 100), 100 * n // threshold
    for level in range(low.bit_length() - 1, high.bit_length()):
        if level < 4:
            out.append(often[:need - len(rare)])
            continue
        kind = ((often >> np.uint64(20)) % np.uint64(1 << (level - 3))).astype(np.int64)
        later = np.ones(len(often), dtype=np.int64)
        later[np.unique(kind, return_index=True)[1]] = 0
        upto = int(np.searchsorted(np.cumsum(later), need - len(rare))) + 1
        t, k = often[:upto], kind[:upto]
        order = np.argsort(k, kind="stable")
        t, k = t[order], k[order]
        for shift in range(1, len(t)):
            same = k[shift:] == k[:-shift]
            if not same.any():
                break
            out.append(_mix(t[:-shift][same] * _MUL[0] + (t[shift:][same] ^ np.uint64(level)) * _MUL[1]))
    return np.unique(np.concatenate(out)).astype(np.int64)


def sketch(tokens: np.ndarray) -> bytes:
    """Bitmap of the shingles by hash: a power of two of bits, eight to sixteen a shingle, from 512 to 64 Ki bits.

    Then hardly a pair passes the bound whose likeness is below 0.78; with a quarter of the
    bits pairs from 0.7 on do, which a corpus with many documents of shared passages has by the million.
    """
    size = 1 << min(13, max(6, (len(tokens) - 1).bit_length()))  # bytes
    bits = np.zeros(size * 8, dtype=bool)
    bits[(tokens & np.uint64(size * 8 - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _folded(bitmaps: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (rows) of ``size`` bytes: the union of the parts of larger ones."""
    return np.bitwise_or.reduce(bitmaps.reshape(len(bitmaps), -1, size), axis=1)


def most_common(x: np.ndarray, nx: int, rows: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How many shingles the rows' sets can share with x: a bit that only one side has is a shingle that the other lacks."""
    size = min(len(x), rows.shape[1])
    x, rows = _folded(x[None, :], size)[0], _folded(rows, size)
    only_x = np.bitwise_count(x & ~rows).sum(1, dtype=np.int64)
    only_row = np.bitwise_count(rows & ~x).sum(1, dtype=np.int64)
    return np.minimum(nx - only_x, n - only_row)


def may_link(x: np.ndarray, nx: int, rows: np.ndarray, n: np.ndarray, threshold: int = THRESHOLD) -> np.ndarray:
    """Which rows' sets can reach the threshold with x."""
    most = most_common(x, nx, rows, n)
    return most * 100 >= (nx + n - most) * threshold


def _narrowed(bitmap: int, bits: int, to: int) -> int:
    """A bitmap of ``bits`` bits folded to ``to``."""
    while bits > to:
        bits //= 2
        bitmap = bitmap >> bits | bitmap & ((1 << bits) - 1)
    return bitmap


def few_pairs(h, c, n, sketches: list[bytes], own, threshold: int) -> list[tuple[int, int]]:
    """Pairs (smaller id first) of a few records in different components that may link by size and bitmap."""
    maps = [int.from_bytes(x, "little") for x in sketches]
    h, c, n, out = h.tolist(), c.tolist(), n.tolist(), []
    for p in range(1, len(h)):
        for q in range(p):
            if c[p] == c[q] or (own is not None and own[p] == own[q]) \
                    or min(n[p], n[q]) * 100 < max(n[p], n[q]) * threshold:
                continue
            bits = 8 * min(len(sketches[p]), len(sketches[q]))
            x, y = _narrowed(maps[p], 8 * len(sketches[p]), bits), _narrowed(maps[q], 8 * len(sketches[q]), bits)
            most = min(n[p] - (x & ~y).bit_count(), n[q] - (y & ~x).bit_count())
            if most * 100 >= (n[p] + n[q] - most) * threshold:
                out.append((min(h[p], h[q]), max(h[p], h[q])))
    return out


def many_pairs(h, c, n, sketches: list[bytes], own, threshold: int) -> list[tuple[int, int]]:
    """As ``few_pairs``, a record against all others at once; those of the largest component against the rest only."""
    sizes = np.asarray([len(x) for x in sketches])
    places = {int(z): np.flatnonzero(sizes == z) for z in np.unique(sizes)}
    tables = {z: np.frombuffer(b"".join(sketches[p] for p in ps), np.uint8).reshape(-1, z) for z, ps in places.items()}
    names, counts = np.unique(c, return_counts=True)
    most, out = names[counts.argmax()], []
    for p in np.flatnonzero(c != most):
        x = np.frombuffer(sketches[p], np.uint8)
        for z, table in tables.items():
            ps = places[z]
            ok = (c[ps] != c[p]) & ((c[ps] == most) | (ps > p)) \
                & (np.minimum(n[ps], n[p]) * 100 >= np.maximum(n[ps], n[p]) * threshold)
            if own is not None:
                ok &= own[ps] != own[p]
            if ok.any():
                hit = ps[ok][may_link(x, int(n[p]), table[ok], n[ps][ok], threshold)]
                out.extend((int(min(h[p], h[q])), int(max(h[p], h[q]))) for q in hit)
    return out


def sought_pairs(h, c, n, sketches: list[bytes], own, seek, threshold: int) -> tuple[list[tuple[int, int]], bool]:
    """One pair of ``many_pairs`` for each record that seeks, and whether there are others.

    The likeliest, one with the largest component if there is any: a record that links with
    many of a component has to be joined to it once.
    """
    sizes = np.asarray([len(x) for x in sketches])
    places = {int(z): np.flatnonzero(sizes == z) for z in np.unique(sizes)}
    tables = {z: np.frombuffer(b"".join(sketches[p] for p in ps), np.uint8).reshape(-1, z) for z, ps in places.items()}
    names, counts = np.unique(c, return_counts=True)
    most, out, others = names[counts.argmax()], [], False
    for p in np.flatnonzero(c != most):
        if others and not seek[p]:
            continue
        x, best, hits = np.frombuffer(sketches[p], np.uint8), None, 0
        for z, table in tables.items():
            ps = places[z]
            ok = (c[ps] != c[p]) & (np.minimum(n[ps], n[p]) * 100 >= np.maximum(n[ps], n[p]) * threshold)
            if own is not None:
                ok &= own[ps] != own[p]
            if ok.any():
                ps = ps[ok]
                common = most_common(x, int(n[p]), table[ok], n[ps])
                union = n[p] + n[ps] - common
                hit = common * 100 >= union * threshold
                hits += int(hit.sum())
                if hit.any():
                    score = np.where(hit, (c[ps] == most) * 2 + common / union, 0)
                    q = int(score.argmax())
                    best = max(best or (0, 0), (float(score[q]), int(h[ps[q]])))
        if hits and seek[p]:
            out.append((min(int(h[p]), best[1]), max(int(h[p]), best[1])))
        others = others or hits > (1 if seek[p] else 0)
    return out, others


def linked(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> bool:
    i = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * i >= threshold * (len(a) + len(b) - i)


# --------------------------------------------------------------------------- steps


def _frequent(source: DataFrame) -> np.ndarray:
    """The most frequent shingles of all documents (sorted hashes)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, seen = [], 0, set()

        def flush():
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            keep = counts > 1
            return pd.DataFrame({"token": tokens[keep].astype(np.int64), "n": counts[keep].astype(np.int64)})

        for batch in batches:
            for text in batch["_text"]:
                tokens = shingle_set(text)
                h = set_id(tokens)
                if h in seen or len(tokens) < 4:
                    continue
                seen.add(h)
                held.append(tokens)
                size += len(tokens)
                if size >= CHUNK_SHINGLES:
                    yield flush()
                    held, size, seen = [], 0, set()
        if held:
            yield flush()

    counted = source.select("_text").mapInPandas(run, "token bigint, n bigint").groupBy("token") \
        .agg(F.sum("n").alias("n")).filter(F.col("n") >= FREQUENT)
    rows = counted.orderBy(F.desc("n"), "token").limit(MAX_FREQUENT).select("token").toPandas()
    return np.sort(rows["token"].to_numpy(dtype=np.int64).astype(np.uint64))


def _signed(source: DataFrame, frequent: np.ndarray, threshold: int) -> DataFrame:
    """One row for each document: set id, size, sketch and signatures (once for each set and task)."""
    table = source.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, seen = table.value, set()
        for batch in batches:
            rows = []
            for text in batch.column("_text").to_pylist():
                tokens = shingle_set(text)
                h = set_id(tokens)
                first = h not in seen and len(tokens) > 3
                if first:
                    if len(seen) >= SEEN_SETS:
                        seen.clear()
                    seen.add(h)
                rows.append((h, len(tokens), sketch(tokens) if first else None,
                             signatures(tokens, often, threshold) if first else None))
            h, n, sketches, sigs = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(h, pa.int64()), pa.array(n, pa.int64()), pa.array(sketches, pa.binary()),
                 pa.array(sigs, pa.list_(pa.int64()))], names=["_id", "h", "n", "sketch", "sigs"])

    kind = dict(source.dtypes)["_id"]
    return source.mapInArrow(run, f"_id {kind}, h bigint, n bigint, sketch binary, sigs array<bigint>")


def _wanted(rows: DataFrame, col: str, keys: DataFrame) -> DataFrame:
    """The rows whose ``col`` is a value of the one column of ``keys``, and a few others, before wide rows are shuffled.

    A bitmap of the keys' hashes, of bounded size: with more keys than it is made for only more other rows stay.
    """
    key = F.col(keys.columns[0])
    found = keys.agg(F.approx_count_distinct(key)).first()[0]
    power = min(MOST_BITS, max(LEAST_BITS, (found * KEY_BITS).bit_length()))
    bit = lambda c: F.xxhash64(c).bitwiseAND(F.lit((1 << power) - 1))
    words = keys.select(bit(key).alias("p")).groupBy(F.shiftright("p", 6).alias("at")).agg(F.bit_or(F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))).alias("bits")).toPandas()
    table = np.zeros(1 << (power - 6), dtype=np.int64)
    table[words["at"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64)
    sent = rows.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def held(p: pd.Series) -> pd.Series:
        at = p.to_numpy(dtype=np.int64)
        return pd.Series((sent.value[at >> 6] >> (at & 63) & 1).astype(bool))

    return rows.filter(held(bit(F.col(col))))


def _able(pairs: DataFrame, nodes: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) of sets that may link by size and bitmap; only pairs of a linkable size get their bitmaps."""
    sized = materialise(pairs.join(nodes.select(F.col("h").alias("a"), F.col("n").alias("na")), "a")
                        .join(nodes.select(F.col("h").alias("b"), F.col("n").alias("nb")), "b")
                        .filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * threshold), "sized")
    sketches = _wanted(nodes.select("h", "sketch"), "h", sized.select(F.explode(F.array("a", "b")).alias("h")))
    sized = sized.join(sketches.select(F.col("h").alias("a"), F.col("sketch").alias("sa")), "a") \
        .join(sketches.select(F.col("h").alias("b"), F.col("sketch").alias("sb")), "b")

    @F.pandas_udf("boolean")
    def able(a: pd.Series, na: pd.Series, b: pd.Series, nb: pd.Series) -> pd.Series:
        return pd.Series([bool(may_link(np.frombuffer(x, np.uint8), nx, np.frombuffer(y, np.uint8)[None, :],
                                        np.asarray([ny]), threshold)[0]) for x, nx, y, ny in zip(a, na, b, nb)], dtype=bool)

    return sized.filter(able("sa", "na", "sb", "nb")).select("a", "b")


def _verified(near: DataFrame, nodes: DataFrame, source: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b, ...) of sets, a written table, whose texts link."""
    ids = materialise(near.select(F.explode(F.array("a", "b")).alias("h")).distinct()
                      .join(nodes.select("h", "rep"), "h").select("h", F.col("rep").alias("_id")), "near-ids")

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:  # an id may stand for several texts
            yield batch[[set_id(shingle_set(t)) == h for h, t in zip(batch["h"], batch["_text"])]]

    # shuffled, so that the filter's and the check's Python never run in the same tasks
    texts = _wanted(source, "_id", ids.select("_id")).join(ids.hint("merge"), "_id").select("h", "_text")
    texts = materialise(texts.mapInPandas(own, "h bigint, _text string").dropDuplicates(["h"]), "near-texts")
    discard(ids)
    both = near.join(texts.select(F.col("h").alias("a"), F.col("_text").alias("ta")), "a") \
        .join(texts.select(F.col("h").alias("b"), F.col("_text").alias("tb")), "b")

    names = near.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}

        def of(h, text):
            if h not in held:
                if len(held) > 500:
                    held.clear()
                held[h] = shingle_set(text)
            return held[h]

        for batch in batches:
            keep = [linked(of(a, x), of(b, y), threshold)
                    for a, b, x, y in zip(batch["a"], batch["b"], batch["ta"], batch["tb"])]
            yield batch.loc[keep, names]

    found = materialise(both.mapInPandas(run, near.schema), "linked")
    discard(texts)
    return found


def _to_compare(records: DataFrame, further: DataFrame | None, threshold: int) -> DataFrame:
    """The records (sig, h, n, c) whose pairs are still open, narrowed before they get their bitmaps; ``g``: how many in the signature.

    A record stays only beside one of a linkable size, a signature (of ``further``, if given) only
    with records of several components.  Of signatures with the same records one stays,
    and none whose records all have the same other one as their largest: that one holds their pairs.
    """
    by_size = Window.partitionBy("sig").orderBy("n", "h")
    sized = records.withColumn("less", F.lag("n").over(by_size)).withColumn("more", F.lead("n").over(by_size)) \
        .filter((F.col("less") * 100 >= F.col("n") * threshold) | (F.col("n") * 100 >= F.col("more") * threshold))
    groups = sized.groupBy("sig").agg(
        F.min("c").alias("c0"), F.max("c").alias("c1"), F.count(F.lit(1)).alias("g"),
        F.bit_xor(F.xxhash64("h")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "h")).alias("y")).filter("c0 < c1")
    groups = groups if further is None else groups.join(further, "sig", "left_semi")
    once = groups.groupBy("g", "x", "y").agg(F.min("sig").alias("sig")).select("sig", "g")
    held = materialise(sized.join(once, "sig").select("sig", "h", "n", "c", "g"), "groups")
    home = F.max(F.struct("g", "sig")).over(Window.partitionBy("h"))["sig"]
    inner = held.withColumn("home", home).groupBy("sig").agg(F.min("home").alias("low"), F.max("home").alias("high")) \
        .filter("low = high AND low <> sig").select("sig")
    return held.join(inner, "sig", "left_anti")


def _apart_pairs(large: DataFrame, nodes: DataFrame, threshold: int, seek: int = 0) -> DataFrame:
    """Pairs (a, b) of different components (ca, cb) within a signature of ``g`` records that may link by size and bitmap.

    With ``seek`` (the number of the round) a record of signatures with more than FEW records
    sends one pair alone, in one of these signatures; a row with ``sig`` alone names a
    signature that has further pairs.  Without it every pair is sent.

    A signature's records are compared in blocks inside the tasks, those outside its
    largest component against all; only pairs that pass leave the task.
    """
    blocks = F.ceil(F.col("g") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("h"), blocks).cast("int")
    if seek:
        turn = F.struct(F.when(F.lit(seek == 1), F.col("g")).alias("g"), F.xxhash64(F.lit(seek), "sig").alias("x"), "sig")
        mine = F.max(F.when(F.col("g") > FEW, turn)).over(Window.partitionBy("h"))
        counted = large.withColumn("seek", F.coalesce(mine["sig"] == F.col("sig"), F.lit(False)))
    else:
        counted = large.withColumn("seek", F.lit(False))
    sketches = _wanted(nodes.select("h", "sketch"), "h", large.select("h"))  # records take more memory than their files tell: never broadcast
    rows = counted.join(sketches.hint("merge"), "h") \
        .select("sig", "h", "c", "n", "seek", "sketch", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")) \
        .select("sig", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "h", "c", "n", "seek", "sketch")
    keys = ["sig", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set = set()

        def finish(x: dict, s: int, e: int, out: list) -> None:
            g = slice(s, e)
            if e - s < 2 or (x["c"][g] == x["c"][s]).all():
                return
            own = x["own"][g] if x["i"][s] != x["j"][s] else None
            args = x["h"][g], x["c"][g], x["n"][g], x["sketch"][s:e], own
            if e - s <= FEW:
                pairs = few_pairs(*args, threshold)
            elif seek:
                pairs, others = sought_pairs(*args, x["seek"][g], threshold)
                if others:
                    out.append((None, None, None, None, int(x["sig"][s])))
            else:
                pairs = many_pairs(*args, threshold)
            of = dict(zip(x["h"][g].tolist(), x["c"][g].tolist())) if pairs else {}
            for pair in pairs:
                if pair not in sent:
                    if len(sent) > SENT_PAIRS:
                        sent.clear()
                    sent.add(pair)
                    out.append((*pair, of[pair[0]], of[pair[1]], None))

        def done(out: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*out)], names=["a", "b", "ca", "cb", "sig"])

        def columns(t: pa.Table) -> dict:
            x = {k: t.column(k).to_numpy() for k in ("sig", "i", "j", "own", "h", "c", "n", "seek")}
            x["sketch"] = t.column("sketch").to_pylist()
            return x

        held: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now])
            x, out = columns(held), []
            starts = [0, *(np.flatnonzero(np.logical_or.reduce([x[k][1:] != x[k][:-1] for k in keys])) + 1).tolist()]
            for s, e in zip(starts[:-1], starts[1:]):
                finish(x, s, e, out)
            held = held.slice(starts[-1])
            if out:
                yield done(out)
        if held is not None and held.num_rows:
            out = []
            finish(columns(held), 0, held.num_rows, out)
            if out:
                yield done(out)

    return rows.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys, "h") \
        .mapInArrow(run, "a bigint, b bigint, ca bigint, cb bigint, sig bigint").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: int = THRESHOLD) -> DataFrame:
    """Set size and component of each document.

    Returns id, ``n_shingles``, ``component_id`` (the smallest id reachable by links,
    itself included) and ``class_id`` (the smallest id of the same set).  Null, empty
    and word-less texts have an empty set and stay alone; repeated rows give one row
    each; documents without an id follow those of the same set that have one, and
    otherwise link with nothing (null component); an empty table gives no rows; other
    columns are ignored.  Sets are told apart by 64-bit
    hashes.
    """
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    frequent = _frequent(source)
    signed = materialise(_signed(source, frequent, threshold), "signed")
    # a set's row with a sketch, and the id that stands for it
    nodes = materialise(signed.filter("h <> 0").groupBy("h").agg(
        F.first("n").alias("n"), F.min("_id").alias("rep"),
        F.first("sketch", ignorenulls=True).alias("sketch")).filter("sketch IS NOT NULL AND rep IS NOT NULL"), "sets")
    entries = signed.filter("sigs IS NOT NULL").select("h", F.explode("sigs").alias("sig"))

    by_sig = Window.partitionBy("sig")
    ranked = entries.withColumn("k", F.dense_rank().over(by_sig.orderBy("h"))) \
        .withColumn("again", F.coalesce(F.lag("h").over(by_sig.orderBy("h")) == F.col("h"), F.lit(False))) \
        .withColumn("lead", F.first("h").over(by_sig.orderBy("h"))) \
        .withColumn("far", F.max("h").over(by_sig)) \
        .withColumn("g", F.max("k").over(by_sig)).filter("g > 1 AND NOT again").select("sig", "h", "lead", "far", "g")
    buckets = materialise(ranked, "buckets")
    slim = materialise(signed.select("_id", "h", "n"), "set-ids")
    discard(signed)

    # few records are compared with one leader, many with two; then all that is still apart
    first = buckets.filter("h <> lead").select(F.col("lead").alias("a"), F.col("h").alias("b"))
    second = buckets.filter((F.col("g") > FEW) & ~F.col("h").isin(F.col("lead"), F.col("far"))) \
        .select(F.col("h").alias("a"), F.col("far").alias("b"))
    tested = materialise(first.unionByName(second).distinct(), "pairs")
    near = materialise(_able(tested, nodes, threshold), "near")
    comp = components(_verified(near, nodes, source, threshold))
    discard(near)
    # what was compared with the leaders is decided: they take no further part
    decided = (F.col("h") == F.col("lead")) | ((F.col("g") > FEW) & (F.col("h") == F.col("far")))
    large = buckets.filter((F.col("g") > 2) & ~decided).select("sig", "h").join(nodes.select("h", "n"), "h")
    further, joined = None, True
    for step in range(1, SEEK_ROUNDS + 2):
        if joined:  # buckets whose records are not all in one component yet
            known = large.select("sig", "h", "n").join(comp, "h", "left").withColumn("c", F.coalesce("c", "h"))
            large = materialise(_to_compare(known, further, threshold), f"apart-{step}")
        else:
            large = materialise(large.join(further, "sig", "left_semi"), f"apart-{step}")
        sent = materialise(_apart_pairs(large, nodes, threshold, step if step <= SEEK_ROUNDS else 0), f"sent-{step}")
        further = sent.filter("sig IS NOT NULL").select("sig").distinct()
        pairs = materialise(sent.filter("a IS NOT NULL").drop("sig").join(tested, ["a", "b"], "left_anti"), f"pairs-{step}")
        joined = not pairs.isEmpty()
        if joined:
            tested = tested.unionByName(pairs.select("a", "b"))
            new = _verified(pairs, nodes, source, threshold).select(F.col("ca").alias("a"), F.col("cb").alias("b"))
            joined = not new.isEmpty()
        if joined:
            comp = components(new.unionByName(comp.select(F.col("h").alias("a"), F.col("c").alias("b"))))
        if further.isEmpty():
            break

    classes = slim.groupBy("h").agg(F.min("_id").alias("class_id"))
    named = classes.join(comp, "h", "left").withColumn("c", F.coalesce("c", "h"))
    lowest = named.groupBy("c").agg(F.min("class_id").alias("component_id"))
    named = named.join(lowest, "c").select("h", "class_id", "component_id")
    alone = F.col("h") == 0
    return slim.join(named, "h").select(
        F.col("_id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(alone, F.col("_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.col("_id")).otherwise(F.col("class_id")).alias("class_id"))
