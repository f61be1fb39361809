"""Packing documents into token sequences by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.common import materialise, shuffle_partitions, small_batches, tokenizer_path, worker_cache

CAPACITY = 4096
END_ID = 2
#: Documents are packed in chunks of at least so many windows (bounded memory; one
#: chunk wastes less than a window or two).
CHUNK_WINDOWS = 160
#: Sequences of the second pass are numbered from here.
SECOND = 1 << 62
#: Where whole rests do not fit, they are cut into pieces of capacity / FINE_PARTS.
FINE_PARTS = 4
#: Texts are encoded in groups of about so many characters.
GROUP_CHARS = 3_000_000
#: Bound of each of a worker's two caches (words, and the runs that they are made of).
CACHE_WORDS = 1_000_000

#: Texts of these characters only go through the word cache: there a space, a line
#: feed and a change between letter and non-letter always separate the words that
#: the tokenizer works on, so a word's ids do not depend on its neighbours.
_SPECIAL = re.compile("[^\x00-\x1b\x20-\x26\x28-\x7e\xa1-\xa9\xab-\xb4\xb6-\xb9\xbb-\xffŒœ]|<\\|")
_RUNS = re.compile("[a-z\xdf-\xf6\xf8-\xffœ]+|[^a-z\xdf-\xf6\xf8-\xffœ\n]+")
_LETTERS = re.compile("[a-z\xdf-\xf6\xf8-\xffœ]")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for letters from 256 on, in order."""
    plain = {*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(256 + i) for i, b in enumerate(others)}


class WordEncoder:
    """Ids of whole texts, equal to the tokenizer's, with a bounded cache of words."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_path(vocabulary))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.byte_letters = _byte_letters()
        self.words: dict[str, bytes] = {"": b""}
        self.runs: dict[str, bytes] = {}

    def _direct(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _letters_ids(self, run: str) -> list[int]:
        """Ids of a run of lower-case letters: it is one word for the model, so only the bytes are spelt out for it."""
        if not run.isascii():
            run = run.encode("utf-8").decode("latin-1").translate(self.byte_letters)
        return [t.id for t in self.model.tokenize(run)]

    def _learn(self, missing: set[str]) -> None:
        """Words are put together from runs of letters and runs of other characters."""
        if len(self.words) + len(missing) > CACHE_WORDS:
            self.words = {"": b""}
        if len(self.runs) > CACHE_WORDS:
            self.runs = {}
        runs, find = self.runs, _RUNS.findall
        new = set(find("\n".join(missing))) - runs.keys()
        letters = [r for r in new if _LETTERS.match(r)]
        for r in letters:
            runs[r] = struct.pack(f"<{len(ids := self._letters_ids(r))}I", *ids)
        for r in new - runs.keys():
            runs[r] = self._direct(r)
        get = runs.__getitem__
        words = self.words
        for w in missing:
            words[w] = runs[w] if w in runs else b"".join(map(get, find(w)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [None if _SPECIAL.search(t) else t.lower().replace("\n", " ").split(" ") for t in texts]
        used = set().union(*[ws for ws in split if ws is not None])
        missing = used - self.words.keys()
        if missing:
            before = self.words
            self._learn(missing)
            if self.words is not before:  # the cache has been emptied meanwhile
                self._learn(used - self.words.keys())
        get = self.words.__getitem__
        return [self._direct(t) if ws is None else b"".join(map(get, ws)) for t, ws in zip(texts, split)]


def encoder(vocabulary: str) -> WordEncoder:
    """One encoder for each Python worker and vocabulary."""
    return worker_cache(f"packing:{vocabulary}", lambda: WordEncoder(vocabulary))


def differencing(sizes: list[int], ways: int) -> list[list[int]]:
    """Karmarkar-Karp: indexes of ``sizes`` in ``ways`` subsets of near-equal sums.

    Every item starts as a partition of its own (one subset with the item, the rest
    empty); the two partitions of the largest imbalance are merged, largest subset
    against smallest, until one is left.  A partition keeps its non-empty subsets
    only, and once all are in use their sums as offsets over the smallest.
    """
    # partition: (-imbalance, tie, [(sum, members)] descending, without empty subsets)
    heap: list[tuple[int, int, list]] = [(-s, i, [(s, [i])]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    tie = len(sizes)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        alone = ways - len(b)  # subsets of a that meet an empty one of b
        merged = a[:alone] + b[:ways - len(a)]
        merged += [(x + b[ways - 1 - i][0], m + b[ways - 1 - i][1]) for i, (x, m) in enumerate(a[alone:], alone)]
        merged.sort(key=lambda e: -e[0])
        if len(merged) == ways:
            low = merged[-1][0]
            merged = [(x - low, m) for x, m in merged] if low else merged
        heapq.heappush(heap, (-merged[0][0], tie, merged))
        tie += 1
    found = [m for _, m in heap[0][2]] if heap else []
    return found + [[] for _ in range(ways - len(found))]


def pack_chunk(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Windows of (document, start, length) pieces.

    Documents above ``capacity`` are first cut into whole windows and a rest; the
    rests are partitioned into near-equal windows.  If a window then exceeds the
    capacity, the rests are cut into smaller pieces and partitioned again, and if one
    still does, the window count rises by one.
    """
    windows, rest = [], []
    for d, n in enumerate(lengths):
        whole = n // capacity * capacity
        windows.extend([[(d, s, capacity)] for s in range(0, whole, capacity)])
        if n > whole:
            rest.append((d, whole, n - whole))
    fine = max(1, capacity // FINE_PARTS)
    cut = [(d, s + k, min(fine, n - k)) for d, s, n in rest for k in range(0, n, fine)]
    ways = -(-sum(p[2] for p in rest) // capacity)
    while rest:
        for pieces in (rest, cut):
            subsets = differencing([p[2] for p in pieces], ways)
            if max(sum(pieces[i][2] for i in s) for s in subsets) <= capacity:
                return windows + [[pieces[i] for i in sorted(s)] for s in subsets if s]
        ways += 1
    return windows


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.DataType, list, list[str]]]:
    """(type of the ids, ids, texts) of about GROUP_CHARS characters: words are looked up and learned once for each."""
    kept, keys, texts, chars = None, [], [], 0
    for batch in batches:
        kept = batch.schema.field("doc_id").type
        for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            keys.append(key)
            texts.append(text)
            chars += len(text)
            if chars >= GROUP_CHARS:
                yield kept, keys, texts
                keys, texts, chars = [], [], 0
    if keys:
        yield kept, keys, texts


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = "word_bpe_49k.json", end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of every document in sequences of at most ``capacity`` tokens.

    Each input partition packs its own documents in chunks of at least CHUNK_WINDOWS windows; what is left at
    its end, less than a chunk, is carried into a second pass, which deals these rests by a hash of their number
    into bins of about a chunk and packs each bin.  So the padding does not depend on how the input is cut, no
    key can be hot, and a lost task runs again with the same result.  A
    document's ids are the tokenizer's plus ``end_id``; a null or empty text is that
    one id.  Returns id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    (and ``token_ids`` when ``with_ids``).  Null ids and repeated rows are documents
    like any other; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = dict(source.dtypes)["doc_id"]
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, " \
             f"sequence_id bigint, offset bigint" + (", token_ids array<bigint>" if with_ids else "")
    chunk = CHUNK_WINDOWS * capacity

    def batch_of(rows: list[tuple], kept: pa.DataType, carried: bool) -> pa.RecordBatch:
        types = [kept] + [pa.int64()] * 6 + [pa.list_(pa.int64())] * with_ids + [pa.int64(), pa.binary()] * carried
        names = [c.split()[0] for c in schema.split(", ")] + ["at", "raw"] * carried
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def placed(pieces: list[tuple[int, int, int]], held: list[tuple], sequence: int) -> Iterator[tuple]:
        """Rows of one window; ``held`` has (id, start of the ids held, the document's tokens, ids)."""
        at = 0
        for d, s, n in pieces:
            key, first, total, raw = held[d]
            part = raw[4 * s:4 * (s + n)]
            row = (key, first + s, n, zlib.crc32(part), total, sequence, at)
            yield row + (np.frombuffer(part, "<u4").astype(np.int64),) if with_ids else row
            at += n

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        code, end = encoder(vocabulary), np.asarray([end_id], dtype="<u4").tobytes()
        number = TaskContext.get().partitionId() << 36
        kept: pa.DataType | None = None
        held: list[tuple] = []
        tokens = 0
        for kept, keys, texts in _groups(batches):
            for key, raw in zip(keys, code.encode(texts)):
                held.append((key, 0, len(raw) // 4 + 1, raw + end))
                tokens += len(raw) // 4 + 1
                if tokens >= chunk:
                    windows = pack_chunk([h[2] for h in held], capacity)
                    yield batch_of([r + (None, None) for k, w in enumerate(windows, number) for r in placed(w, held, k)],
                                   kept, True)
                    number += len(windows)
                    held, tokens = [], 0
        rows = []
        for d, (key, _, total, raw) in enumerate(held):
            whole = total // capacity * capacity
            for s in range(0, whole, capacity):
                rows += [r + (None, None) for r in placed([(d, s, capacity)], held, number)]
                number += 1
            if total > whole:
                rows.append((key, whole, total - whole, None, total, None, None) + (None,) * with_ids
                            + (number, raw[4 * whole:]))
                number += 1
        if rows:
            yield batch_of(rows, kept, True)

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = SECOND + (TaskContext.get().partitionId() << 36)
        now, kept, held = None, None, []

        def flush() -> pa.RecordBatch:
            nonlocal number
            windows = pack_chunk([len(h[3]) // 4 for h in held], capacity)
            rows = [r for k, w in enumerate(windows, number) for r in placed(w, held, k)]
            number += len(windows)
            held.clear()
            return batch_of(rows, kept, False)

        for batch in batches:
            kept = batch.schema.field("doc_id").type
            for b, *row in zip(*[batch.column(c).to_pylist() for c in ("bin", "doc_id", "start", "doc_tokens", "raw")]):
                if held and b != now:
                    yield flush()
                now = b
                held.append(tuple(row))
        if held:
            yield flush()

    first = materialise(source.mapInArrow(first_pass, schema + ", at bigint, raw binary"), "packing-first")
    rests = first.filter("sequence_id IS NULL")
    bins = max(1, (rests.agg(F.sum("length")).first()[0] or 0) // chunk)
    second = rests.select(F.pmod(F.xxhash64("at"), F.lit(bins)).alias("bin"), "at", "doc_id", "start", "doc_tokens", "raw") \
        .repartition(min(bins, shuffle_partitions(spark)), "bin").sortWithinPartitions("bin", "at") \
        .mapInArrow(second_pass, schema)
    return first.filter("sequence_id IS NOT NULL").drop("at", "raw").unionByName(second).withColumnRenamed("doc_id", id_col)
