"""Near-duplicate vectors by Euclidean p-stable hashing.

Vectors are normalised, so the cosine fixes their distance.  Each of ``TABLES``
tables cuts ``HASHES`` random normal projections into cells of ``WIDTH``; vectors
of one label that share all cells of a table meet in a bucket, where their exact
cosines are taken.  Equal vectors become one weighted vector first.  A bucket of
any size is compared in blocks, and a block gives link counts and a spanning forest
of its links, never the pairs themselves, so its output is linear in its input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.common import materialise
from podium.llm.graph import components

COSINE = 0.98
#: A pair at exactly this cosine (distance 0.2) falls into one cell with chance 0.92, shares a table with 0.92^16 =
#: 0.26 and at least one of 32 with 0.9999; one at distance 1.4 shares a given table with chance 1e-5.
WIDTH, HASHES, TABLES = 2.0, 16, 32
SEED = 1213
#: Vectors of a bucket that a task compares at once.
BLOCK = 1024
#: A class of copies is hot if it holds more than one in so many rows; there are no more such classes than that.
HOT_SHARE = 1024


@lru_cache(maxsize=8)
def projections(dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Random normal directions and cell offsets of all tables for vectors of ``dim`` components."""
    rng = np.random.default_rng([SEED, dim])
    return rng.standard_normal((dim, TABLES * HASHES)), rng.uniform(0, WIDTH, TABLES * HASHES)


def bucket_keys(units: np.ndarray) -> np.ndarray:
    """(rows, TABLES) int64: a hash of the cells of each table."""
    directions, offsets = projections(units.shape[1])
    cells = np.floor((units @ directions + offsets) / WIDTH).astype(np.int64).astype(np.uint64)
    odd = np.random.default_rng(SEED).integers(1, 2 ** 62, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    x = (cells.reshape(len(units), TABLES, HASHES) * odd).sum(axis=2, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return (x ^ (x >> np.uint64(29))).astype(np.int64)


def unit(values: np.ndarray) -> np.ndarray | None:
    """The vector at length 1 in double precision; none if it is empty, zero or not finite."""
    if not len(values) or not np.isfinite(values).all():
        return None
    top = np.abs(values).max()
    if top == 0:
        return None
    scaled = values / top  # squares of very large or small components stay in range
    return scaled / np.sqrt(scaled @ scaled)


def _classed(rows: DataFrame) -> DataFrame:
    """(id, label, digest, unit): what rows with equal digests share; digest null for rows that take no part."""
    out = pa.schema([("_digest", pa.binary()), ("_unit", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, vectors = batch.column("_label").to_pylist(), batch.column("_vec")
            digests, units = [], []
            for i, label in enumerate(labels):
                u = None
                if label is not None and vectors[i].is_valid:
                    v = vectors[i].values
                    if not v.null_count:
                        v = v.to_numpy(zero_copy_only=False) + 0.0  # -0.0 becomes 0.0
                        u = unit(v)
                if u is None:
                    digests.append(None)
                    units.append(None)
                else:
                    name = label.encode("utf-8", "surrogatepass")
                    digests.append(hashlib.blake2b(b"%d:" % len(name) + name + v.tobytes(), digest_size=16).digest())
                    units.append(u.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_label"), pa.array(digests, pa.binary()), pa.array(units, pa.binary())],
                names=["_id", "_label", *out.names])

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, _label string, _digest binary, _unit binary")


def _keyed(classes: DataFrame) -> DataFrame:
    """``classes`` with ``keys``: the bucket of each table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = batch.column("unit").to_pylist()
            keys: list = [None] * len(units)
            for size in {len(u) for u in units}:
                at = [i for i, u in enumerate(units) if len(u) == size]
                found = bucket_keys(np.frombuffer(b"".join(units[i] for i in at)).reshape(len(at), -1))
                for i, k in zip(at, found):
                    keys[i] = k
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.list_(pa.int64()))],
                                             names=[*batch.schema.names, "keys"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema.fields)
    return classes.mapInArrow(run, f"{fields}, keys array<bigint>")


def block_links(units: np.ndarray, keys: np.ndarray, table: int, node: np.ndarray, weight: np.ndarray,
                side: np.ndarray | None, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(links, root) of the vectors of a block.

    ``links``: weight of the partners of each vector at or above ``cosine``, pairs
    that share an earlier table left out; ``root``: the smallest node that such
    links lead to.  With ``side`` only pairs of different sides are compared.
    """
    near = units @ units.T >= cosine
    np.fill_diagonal(near, False)
    if side is not None:
        near &= side[:, None] != side[None, :]
    at = np.flatnonzero(near.any(axis=1))
    links, root = np.zeros(len(node), np.int64), node.copy()
    if not len(at):
        return links, root
    near = near[np.ix_(at, at)]
    for t in range(table):
        k = keys[at, t]
        near &= k[:, None] != k[None, :]
    links[at] = near @ weight[at]
    low, big = node[at], np.iinfo(np.int64).max
    while True:
        least = np.minimum(low, np.where(near, low[None, :], big).min(axis=1))
        if (least == low).all():
            break
        low = least
    root[at] = low
    return links, root


def _compared(members: DataFrame, cosine: float) -> DataFrame:
    """(a, b, n): how many rows ``a`` is linked with (b null), and links (a, b) of a forest (n 0)."""
    group = ["label", "size", "t", "key", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compare(x: dict, s: int, e: int, out: list) -> None:
            if e - s < 2:
                return
            units = np.frombuffer(b"".join(x["unit"][s:e])).reshape(e - s, -1)
            node, n = x["node"][s:e], x["n"][s:e]
            side = x["own"][s:e] if x["i"][s] != x["j"][s] else None
            links, root = block_links(units, x["keys"][s:e], int(x["t"][s]), node, n, side, cosine)
            hit, moved = links > 0, root != node
            if hit.any():
                out.append((node[hit], np.zeros(hit.sum(), np.int64), links[hit]))
            if moved.any():
                out.append((node[moved], root[moved], np.zeros(moved.sum(), np.int64)))

        def table(batch: pa.Table) -> dict:
            x = {c: batch.column(c).to_numpy() for c in ("node", "n", "own", "i", "j", "t", "key", "size")}
            x["label"], x["unit"] = batch.column("label").to_pylist(), batch.column("unit").to_pylist()
            flat = batch.column("keys").combine_chunks()
            x["keys"] = (flat.flatten() if isinstance(flat, pa.ListArray) else
                         pa.concat_arrays([c.flatten() for c in flat.chunks])).to_numpy().reshape(batch.num_rows, TABLES)
            return x

        def flushed(out: list) -> pa.RecordBatch:
            a, b, n = (np.concatenate(c) for c in zip(*out))
            return pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(b, mask=n > 0), pa.array(n)], names=["a", "b", "n"])

        held: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now])
            x, out = table(held), []
            names = np.asarray([hash(v) for v in x["label"]])
            cut = np.zeros(held.num_rows - 1, dtype=bool)
            for c in (names, *(x[c] for c in group[1:])):
                cut |= c[1:] != c[:-1]
            starts = [0, *(np.flatnonzero(cut) + 1).tolist()]
            for s, e in zip(starts[:-1], starts[1:]):
                compare(x, s, e, out)
            held = held.slice(starts[-1])
            if out:
                yield flushed(out)
        if held is not None and held.num_rows:
            out = []
            compare(table(held), 0, held.num_rows, out)
            if out:
                yield flushed(out)

    return members.repartition(*group).sortWithinPartitions(*group, "node").mapInArrow(run, "a bigint, b bigint, n bigint")


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | Column = "label",
                 cosine: float = COSINE) -> DataFrame:
    """Links and components of vectors of one label at or above ``cosine``.

    Returns the id, ``n_links`` (other rows linked with this one), ``component_id``
    (smallest id reachable by links, its own included) and ``kept`` (id equals it).
    Vectors that are null, empty, zero or hold null or non-finite components, and those
    without a label, link with nothing; so do vectors of different lengths.  Repeated
    rows and equal vectors are linked with each other; rows without an id count as
    partners, take the component of the others and are not kept; an empty table gives
    no rows; other columns are ignored.  Labels are compared as text.
    """
    source = rows.select(F.col(id_col).alias("_id"), (F.col(label_col) if isinstance(label_col, str) else label_col)
                         .cast("string").alias("_label"), F.col(vec_col).cast("array<double>").alias("_vec"))
    classed = materialise(_classed(source), "vectors")
    taking = classed.filter("_digest IS NOT NULL")
    classes = taking.groupBy("_digest").agg(
        F.first("_label").alias("label"), F.first("_unit").alias("unit"), F.count(F.lit(1)).alias("n"),
        F.min("_id").alias("low"))
    # numbered where it is written, so the numbers stay
    classes = materialise(_keyed(classes.withColumn("node", F.monotonically_increasing_id())
                                 .withColumn("size", F.length("unit"))), "vector-classes")
    entry = classes.select("node", "label", "size", F.posexplode("keys").alias("t", "key"))
    full = entry.groupBy("label", "size", "t", "key").agg(F.count(F.lit(1)).alias("g")).filter("g > 1")
    blocks = F.ceil(F.col("g") / BLOCK).cast("int")
    met = entry.join(full, ["label", "size", "t", "key"]).select(
        "node", "t", "key", blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("own"))
    members = met.join(classes.select("node", "label", "size", "unit", "n", "keys"), "node") \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("node", "label", "size", "t", "key", "own", F.least("own", "other").alias("i"),
                F.greatest("own", "other").alias("j"), "n", "unit", "keys")
    found = materialise(_compared(members, cosine), "vector-links")
    comp = components(found.filter("b IS NOT NULL").select("a", "b"))
    links = found.filter("b IS NULL").groupBy("a").agg(F.sum("n").alias("links"))
    known = classes.select("_digest", "node", "n", "low").join(comp, classes["node"] == comp["h"], "left") \
        .withColumn("c", F.coalesce("c", "node")).join(links.withColumnRenamed("a", "node"), "node", "left")
    least = known.groupBy("c").agg(F.min("low").alias("component_id"))
    known = materialise(known.join(least, "c").select(
        "_digest", "n", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "vector-groups")
    # rows get their class's values back; the few hot classes are sent to the tasks, so their rows are not gathered
    total = known.agg(F.sum("n")).first()[0] or 0
    hot = known.filter(F.col("n") * HOT_SHARE > total).drop("n")
    cold = known.filter(F.col("n") * HOT_SHARE <= total).drop("n")
    slim = taking.select("_id", "_digest")
    back = slim.join(F.broadcast(hot), "_digest").unionByName(
        slim.join(F.broadcast(hot.select("_digest")), "_digest", "left_anti").join(cold, "_digest"))
    alone = classed.filter("_digest IS NULL").select("_id", F.col("_id").alias("component_id"), F.lit(0).alias("n_links"))
    done = back.select("_id", "component_id", "n_links").unionByName(alone)
    return done.select(F.col("_id").alias(id_col), F.col("n_links").cast("long").alias("n_links"), "component_id",
                       F.coalesce(F.col("_id") == F.col("component_id"), F.lit(False)).alias("kept"))
