"""Toxicity by compression distance.

Two zstandard dictionaries share a base trained on ordinary text; one also holds
text of toxic documents, the other as much neutral filler.  A window of words that
compresses better with the toxic one is nearer to toxic text; a window without such
text compresses alike, because everything else in the dictionaries is the same.
Windows count from a threshold calibrated on ordinary documents, and a logistic
curve turns a document's windows into a score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.common import materialise, small_batches

#: Bounds of the labelled sample that the classifier is fitted on (whole texts).
SAMPLE_TOXIC = 3000
SAMPLE_ORDINARY = 9000
#: Windows, drawn by hash from all ordinary texts learned from, that the base is trained on.
BASE_WINDOWS = 40_000
#: Tasks that the sample is dealt over.
PIECES = 24
GRAM = 5
WINDOW_WORDS = 10
BASE_BYTES = 30_000
TOXIC_BYTES = 8192
#: A letter sequence is toxic if its documents are so many times likelier to be toxic.
CONTRAST = 10.0
#: Share of ordinary documents that a window threshold lets through.
CALIBRATION = 0.99


def _words(text: str) -> list[str]:
    return text.lower().split()


def _windows(text: str, size: int = WINDOW_WORDS) -> list[bytes]:
    """The whole text in consecutive windows of words (a space at either end)."""
    words = _words(text)
    return [(" " + " ".join(words[i:i + size]) + " ").encode() for i in range(0, len(words), size)]


class Model:
    """Dictionaries, window threshold and curve; plain data, so tasks get it by value."""

    def __init__(self, base: bytes, toxic: bytes, threshold: float, weights: list[float]):
        self.base, self.toxic, self.threshold, self.weights = base, toxic, threshold, weights
        self._pair = None

    def __getstate__(self):
        return {**self.__dict__, "_pair": None}

    def _compressors(self):
        if self._pair is None:
            import zstandard as z
            pair = []
            for head in (b"\0" * len(self.toxic), self.toxic):
                shape = z.ZstdCompressionParameters(
                    window_log=17, hash_log=16, chain_log=16, search_log=1, min_match=5, strategy=z.STRATEGY_DFAST,
                    write_content_size=False, write_checksum=False, write_dict_id=False)
                d = z.ZstdCompressionDict(self.base + head, dict_type=z.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(compression_params=shape)
                pair.append(z.ZstdCompressor(dict_data=d, compression_params=shape).compress)
            self._pair = tuple(pair)
        return self._pair

    def gains(self, text: str) -> np.ndarray:
        """Bytes that the toxic dictionary saves on each window."""
        ordinary, toxic = self._compressors()
        return np.asarray([len(ordinary(w)) - len(toxic(w)) for w in _windows(text)], dtype=float)

    def features(self, text: str) -> list[float]:
        return self.features_of(self.gains(text))

    def features_of(self, g: np.ndarray) -> list[float]:
        if not len(g):
            return [0.0, 0.0, 0.0, 0.0, 0.0]
        top = np.sort(g)[::-1]
        over = g[g >= self.threshold]
        return [max(0.0, top[0]), max(0.0, top[:3].sum()), float(np.log1p(len(over))),
                float(len(over) / len(g)), float(np.log1p(len(g)))]

    def score(self, text: str) -> float:
        x = np.asarray([1.0, *self.features(text)])
        return float(1 / (1 + np.exp(-np.clip(x @ np.asarray(self.weights), -30, 30))))


def _grams(word: str) -> set[str]:
    s = f" {word} "
    return {s[i:i + GRAM] for i in range(max(1, len(s) - GRAM + 1))}


def _toxic_content(learn: DataFrame, na: int, nb: int) -> bytes:
    """Stretches of toxic documents' words that ordinary documents hardly have, commonest last.

    ``learn`` has (_t, _y): ``na`` toxic and ``nb`` ordinary texts.  Words and letter
    sequences are counted in tasks; the driver gets the contrasting ones.
    """
    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n = Counter()
            for t, y in zip(batch["_t"], batch["_y"].tolist()):
                n.update((y, w) for w in set(_words(t)))
            yield pd.DataFrame([(y, w, c) for (y, w), c in n.items()], columns=["y", "w", "n"])

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n = Counter()
            for w, c in zip(batch["w"], batch["n"].tolist()):
                for g in _grams(w):
                    n[g] += c
            yield pd.DataFrame(list(n.items()), columns=["g", "n"])

    counted = learn.select("_t", "_y").mapInPandas(words, "y int, w string, n bigint") \
        .groupBy("y", "w").agg(F.sum("n").alias("n"))
    counted = materialise(counted, "toxicity-words")

    def gram_counts(which: str) -> DataFrame:
        return counted.filter(which).select("w", "n").mapInPandas(grams, "g string, n bigint") \
            .groupBy("g").agg(F.sum("n").alias("n"))

    often = gram_counts("y = 1 AND n > 1").filter(F.col("n") >= max(min(3, na), 0.002 * na))
    other = gram_counts("y = 0").withColumnRenamed("n", "m")
    chosen = frozenset(r["g"] for r in often.join(other, "g", "left").filter(
        F.col("n") / na > CONTRAST * (F.coalesce("m", F.lit(0)) + 0.5) / nb).select("g").collect())

    def stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = Counter()
            for w, n in zip(batch["w"], batch["n"].tolist()):
                s = f" {w} "
                marks = np.zeros(len(s) + 1, dtype=bool)
                for i in range(max(1, len(s) - GRAM + 1)):
                    if s[i:i + GRAM] in chosen:
                        marks[i:min(len(s), i + GRAM)] = True
                edges = np.flatnonzero(np.diff(np.concatenate([[False], marks]).astype(np.int8)))
                for i, j in zip(edges[::2], edges[1::2]):
                    parts[s[i:j]] += n
            yield pd.DataFrame(list(parts.items()), columns=["p", "n"])

    # every stretch has a byte at least, so more of them would not fit
    ranked = counted.filter("y = 1").select("w", "n").mapInPandas(stretches, "p string, n bigint") \
        .groupBy("p").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("p")).limit(TOXIC_BYTES).collect()
    return "".join(r["p"] for r in reversed(ranked)).encode()[-TOXIC_BYTES:]


def _base_content(learn: DataFrame) -> bytes:
    """A zstandard dictionary trained on windows drawn from the whole of all ordinary texts."""
    import zstandard as z

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(k, i, w) for k, t in zip(batch["_k"].tolist(), batch["_t"]) for i, w in enumerate(_windows(t))]
            yield pd.DataFrame(found, columns=["k", "i", "w"])

    drawn = learn.filter("_y = 0").select("_k", "_t").mapInPandas(cut, "k bigint, i int, w binary") \
        .orderBy(F.xxhash64(F.lit(13), "k", "i"), "k", "i").limit(BASE_WINDOWS)
    windows = [bytes(r["w"]) for r in drawn.select("w").collect()]
    try:
        return z.train_dictionary(BASE_BYTES, windows).as_bytes()
    except (z.ZstdError, ValueError):  # too little text to train on
        return b"".join(windows)[-BASE_BYTES:]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    w = np.zeros(x.shape[1])
    keep = ridge * np.eye(x.shape[1])
    keep[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        s = weight * p * (1 - p) + 1e-9
        step = np.linalg.solve((x * s[:, None]).T @ x + keep, x.T @ (weight * (y - p)) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """A model from at most ``SAMPLE_TOXIC`` + ``SAMPLE_ORDINARY`` labelled documents, whole texts.

    ``train`` selects the labels that may be learned from.  The sample is taken by
    id hash, so it is the same at any partitioning.  About two thirds of its texts (by
    text hash) teach the dictionaries, all others set the threshold and the curve of
    these same dictionaries; if either part lacks a kind, all texts do both.  Other
    bounds: the base is trained on ``BASE_WINDOWS`` windows and has ``BASE_BYTES``, the
    toxic content has ``TOXIC_BYTES``.  A null label or text teaches nothing; without
    labels of both kinds every score is the share of toxic labels.
    """
    small_batches(docs.sparkSession)
    known = labels.filter(train & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()) \
        .groupBy(id_col).agg(F.max(label_col).cast("int").alias("_y"))
    counts = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for y, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_ORDINARY)):
        part = known.filter(F.col("_y") == y).orderBy(F.xxhash64(F.lit(7), F.col(id_col)), id_col).limit(n)
        chosen = part if chosen is None else chosen.unionByName(part)
    sample = docs.select(F.col(id_col), F.col(text_col).alias("_t")).filter(F.col("_t").isNotNull()) \
        .join(F.broadcast(chosen), id_col).withColumn("_k", F.xxhash64("_t")).select("_t", "_y", "_k") \
        .dropDuplicates(["_y", "_k"]).withColumn("_held", F.pmod(F.xxhash64(F.lit(11), "_k"), F.lit(3)) == 2)
    sample = materialise(sample.repartition(PIECES, "_k"), "toxicity-sample")
    have = {(r["_y"], r["_held"]): r["count"] for r in sample.groupBy("_y", "_held").count().collect()}
    share = (counts.get(1, 0) + 0.5) / (counts.get(1, 0) + counts.get(0, 0) + 1)
    flat = [float(np.log(share / (1 - share))), 0.0, 0.0, 0.0, 0.0, 0.0]
    if {y for y, _ in have} != {0, 1}:
        return Model(b"", b"", 1.0, flat)
    if len(have) == 4:
        learn, held = sample.filter("NOT _held"), sample.filter("_held")
        na, nb = have[1, False], have[0, False]
    else:
        learn = held = sample
        na, nb = (sum(n for (y, _), n in have.items() if y == kind) for kind in (1, 0))
    model = Model(_base_content(learn), _toxic_content(learn, na, nb), 1.0, flat)

    def saved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"y": b["_y"], "g": [model.gains(t) for t in b["_t"]]})

    gains = materialise(held.select("_t", "_y").mapInPandas(saved, "y int, g array<double>"), "toxicity-gains")
    best = [r["best"] for r in gains.filter("y = 0").select(
        F.greatest(F.lit(0.0), F.array_max("g")).alias("best")).collect()]
    model.threshold = float(max(1.0, np.quantile(best, CALIBRATION) - 1))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"y": b["y"], "x": [model.features_of(np.asarray(g, dtype=float)) for g in b["g"]]})

    got = sorted((r["y"], r["x"]) for r in gains.mapInPandas(measure, "y int, x array<double>").collect())
    y = np.asarray([v for v, _ in got], dtype=float)
    x = np.column_stack([np.ones(len(y)), np.asarray([v for _, v in got])])
    prior = np.where(y == 1, share / max(1e-9, y.mean()), (1 - share) / max(1e-9, 1 - y.mean()))
    model.weights = _logistic(x, y, prior).tolist()
    return model


def _rate(model: Model):
    @F.pandas_udf("double")
    def rate(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")
    return rate


def score(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """id, ``score`` and ``predicted`` for each document, over its whole text.

    Only the text is looked at.  A null or empty text has no window and gets the
    score of that; repeated rows get equal scores; an empty table gives no rows;
    other columns are ignored.
    """
    small_batches(docs.sparkSession)
    scored = docs.select(F.col(id_col), _rate(model)(F.coalesce(F.col(text_col), F.lit(""))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def reject(docs: DataFrame, model: Model, threshold: float, text_col: str = "text") -> DataFrame:
    """``docs`` without those that score ``threshold`` or more; all columns stay as they are."""
    small_batches(docs.sparkSession)
    name = "__toxic_score"
    return docs.withColumn(name, _rate(model)(F.coalesce(F.col(text_col), F.lit("")))) \
        .filter(F.col(name) < threshold).drop(name)
