"""Exact token counts; huge documents by overlapping chunks with resynchronisation."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.common import small_batches, tokenizer_path

VOCABULARY = "byte_bpe_50k.json"
CHUNK = 32_768
OVERLAP = 256
#: A boundary this close to a cut end is not used: the text behind the cut could
#: still change it (one character of look-ahead, or a special string cut in two).
MARGIN = 32
CACHE_WORDS = 400_000

#: Texts without these go through the word cache: single spaces and line feeds
#: between non-spaces are always boundaries of the pre-tokenizer.
_SPECIAL = re.compile(r"\s\s|[^\S \n]|<\||^\s|\s$")
_SPACES = re.compile(r"\s")


class Counter:
    """Token counts of whole texts, equal to the library's."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_path(vocabulary))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.starts = np.zeros(max(names.values()) + 1, dtype=bool)
        for name, i in names.items():
            self.starts[i] = name.startswith("Ġ")
        self.words: dict[str, int] = {}

    def _learn(self, missing: set[str]) -> None:
        """Counts of words; those led by a space are encoded in one string and cut at the spaces."""
        spaced = sorted(w for w in missing if w[:1] == " ")
        if spaced:
            ids = np.asarray(self.tokenizer.encode("".join(spaced), add_special_tokens=False).ids, dtype=np.int64)
            cuts = np.flatnonzero(self.starts[ids])
            if len(cuts) == len(spaced) and cuts[0] == 0:
                self.words.update(zip(spaced, np.diff(np.append(cuts, len(ids))).tolist()))
            else:
                self.words.update((w, len(self._encode(w))) for w in spaced)
        for w in missing:
            if w not in self.words:
                self.words[w] = len(self._encode(w))

    def _encode(self, text: str):
        return self.tokenizer.encode(text, add_special_tokens=False)

    def count(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        if len(text) > chunk:
            return self.count_huge(text, chunk, overlap)
        if not text:
            return 0
        if _SPECIAL.search(text):
            return len(self._encode(text))
        lines = text.split("\n")
        words = [w for line in lines for w in line.replace(" ", "\0 ").split("\0")] if "\0" not in text else None
        if words is None:
            return len(self._encode(text))
        known = self.words
        missing = {w for w in words if w not in known}
        if missing:
            if len(known) > CACHE_WORDS:
                known.clear()
                missing = set(words)
            self._learn(missing)
        return len(lines) - 1 + sum([known[w] for w in words])

    def boundaries(self, text: str, base: int) -> dict[int, int]:
        """Position in the document -> tokens before it in this chunk, at starts of pre-token words."""
        enc = self._encode(text)
        found, before = {}, None
        for k, (word, (a, _)) in enumerate(zip(enc.word_ids, enc.offsets)):
            if word is None or word != before:
                found.setdefault(base + a, k)
            before = word
        found[base + len(text)] = len(enc)
        return found

    def count_huge(self, text: str, chunk: int, overlap: int) -> int:
        """Splice chunks at the first word boundary that both encodings of an overlap share.

        Merges never cross a pre-token word, and the scan for words goes on from a
        boundary whatever stands before it.  So a boundary which the left chunk has
        well inside its text, and which the right chunk has too, is a boundary of the
        whole text, and behind it both agree.  Without a shared one the overlap is
        doubled, up to the whole text.
        """
        total, start, skip = 0, 0, 0  # the chunk begins at start; its first skip characters are already counted
        n = len(text)
        left = self.boundaries(text[:chunk], 0)
        end, origin = min(n, chunk), 0
        while end < n:
            width = overlap
            while True:
                start = max(origin, end - width)
                stop = min(n, max(end, start + width) + chunk)
                right = self.boundaries(text[start:stop], start)
                shared = [p for p in left if p in right and start < p <= end - MARGIN and p >= origin]
                if shared:
                    at = min(shared)
                    break
                if start <= origin:
                    # nothing in common from the last splice on: encode from there as one longer chunk
                    left, at = self.boundaries(text[origin:stop], origin), None
                    break
                width *= 2
            if at is None:
                end = stop
                continue
            total += left[at] - left[origin]
            left, origin, end = right, at, stop
        return total + left[n] - left[origin]


_COUNTERS: dict[str, Counter] = {}


def counter(vocabulary: str) -> Counter:
    if vocabulary not in _COUNTERS:
        _COUNTERS[vocabulary] = Counter(vocabulary)
    return _COUNTERS[vocabulary]


def count_tokens(docs: DataFrame, limit: int = 512, vocabulary: str = VOCABULARY, id_col: str = "doc_id",
                 text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Tokens of every whole text, as the library gives them for the whole text.

    Returns id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``.  A null text
    counts as empty (0 tokens); repeated rows and null ids give one row each; an
    empty table gives none; other columns are ignored.  Documents above ``chunk``
    characters are encoded in overlapping chunks, so memory stays bounded.
    """
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary).count
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n = [count(t, chunk, overlap) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    schema = f"doc_id {dict(source.dtypes)['doc_id']}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return source.mapInArrow(run, schema).withColumnRenamed("doc_id", id_col)
