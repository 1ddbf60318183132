"""Embedding near-duplicates by lattice hashing.

In each of ``TABLES`` tables a vector, scaled to length one, is projected to eight random orthonormal
directions, stretched and decoded to the nearest point of the E8 lattice: its home
cell. It also visits the ``PROBES`` neighbouring lattice points (of the 240 minimal vectors around
the home) that lie nearest to it. Two vectors meet where one is at home and the other is at home or
visits, and a meeting is confirmed by the cosine in double precision. Vectors meet only inside their
label. Eight of d directions keep sqrt(8/d) of a distance, so the stretch is ``STRETCH`` at ``WIDTH`` components and
grows with the root of the number of components: the share of links met is about the same at every width.

Equal vectors of a label are folded into one class before anything is compared, so a group of copies
of any size is one row. Only the keys of cells travel at first; vectors are sent on only to cells in
which another vector lives. A cell with more than ``BLOCK`` residents or guests is cut into a grid, each
field of which gets one block of residents and one block of guests: every resident meets every guest in
exactly one field, and no field holds more than about two blocks. A pair that meets in several cells is counted in the first of them only (a number that
both vectors' cells determine), so neither pairs nor their repeats leave a task: what leaves are
sums of links and a spanning forest.

Defined results: a vector that is null, of no components, zero, or holding a null or a component that is not
finite, and a row with a null label, links with nothing and is its own component. Vectors of different length
are never linked. Repeated rows are other vectors with cosine 1. A row of null id keeps its place
with no links, a null component and kept = false. Ids are whole numbers; text that is none raises. Labels
of text are compared as they are, others as whole numbers. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, stored
from .simhash import forest

COSINE, TABLES, PROBES, STRETCH, BLOCK = 0.93, 4, 8, 7.0, 512
DIMS, WIDTH = 8, 64
PAIRS_AT_ONCE = 1 << 16


@cache
def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(DIMS), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(DIMS)
            v[[i, j]] = a, b
            out.append(v)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=DIMS) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def _nearest_even(z: np.ndarray) -> np.ndarray:
    """Nearest integer vectors of even sum: if rounding gives an odd sum, the worst coordinate goes the other way."""
    r = np.rint(z)
    error = z - r
    worst = np.abs(error).argmax(1)
    row = np.arange(len(z))
    odd = r.sum(1) % 2 != 0
    r[row, worst] += np.where(odd, np.where(error[row, worst] >= 0, 1.0, -1.0), 0.0)
    return r


def decode(z: np.ndarray) -> np.ndarray:
    """Nearest E8 points: the nearer of the two cosets, all integers and all half-integers."""
    whole, half = _nearest_even(z), _nearest_even(z - 0.5) + 0.5
    nearer = ((z - whole) ** 2).sum(1) <= ((z - half) ** 2).sum(1)
    return np.where(nearer[:, None], whole, half)


@cache
def _directions(table: int, dims: int) -> np.ndarray:
    """Orthonormal random directions (plain Gaussian ones if there are fewer than eight dimensions)."""
    g = np.random.default_rng([table, dims]).standard_normal((dims, DIMS))
    return np.linalg.qr(g)[0] if dims >= DIMS else g / np.sqrt(dims)


def stretch_of(dims: int) -> float:
    """The stretch of vectors of so many components."""
    return STRETCH * float(np.sqrt(dims / WIDTH))


def _numbers(label: np.ndarray) -> np.ndarray:
    """Labels as whole numbers for the keys of cells; texts that share a number are told apart where they meet."""
    if label.dtype != object:
        return label.astype(np.int64)
    return np.array([int.from_bytes(hashlib.md5(x.encode()).digest()[:8], "little", signed=True) for x in label], np.int64)


def cells(unit: np.ndarray, label: np.ndarray, tables: int = TABLES, probes: int = PROBES,
          stretch: float | None = None) -> np.ndarray:
    """64-bit cell keys, (rows, tables, 1 + probes); the first of each table is the home."""
    rows, dims = unit.shape
    stretch = stretch_of(dims) if stretch is None else stretch
    weights = np.random.default_rng(7).integers(1, 1 << 62, DIMS + 3, np.int64) * 2 + 1  # products wrap around
    out = np.empty((rows, tables, 1 + probes), np.int64)
    for t in range(tables):
        z = unit @ _directions(t, dims) * stretch
        home = decode(z)
        close = np.argsort(-((z - home) @ minimal_vectors().T), 1, kind="stable")[:, :probes]
        points = np.concatenate([home[:, None, :], home[:, None, :] + minimal_vectors()[close]], 1)
        key = (points * 2).astype(np.int64) @ weights[:DIMS]
        key += (_numbers(label) * weights[DIMS])[:, None] + (np.array([t, dims]) * weights[DIMS + 1:]).sum()
        key ^= (key >> 31) & 0x1FFFFFFFF
        key *= weights[0]
        out[:, t] = key ^ ((key >> 29) & 0x7FFFFFFFF)
    return out


def _coded(df: DataFrame, id_col: str, vector_col: str, label_col: str, item: str) -> DataFrame:
    """(vec_id, label, code, vec): labels of text stay text, others become whole numbers; vec as bytes of its numbers, both null where the vector links with nothing."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors, labels = batch.columns
            code, raw = [], []
            for i, v, label in zip(ids, vectors, labels):
                x = v.values if v.is_valid else None
                ok = i.is_valid and label.is_valid and x is not None and len(x) and not x.null_count
                a = x.to_numpy(zero_copy_only=False).astype(item) if ok else None
                if ok and np.isfinite(a).all() and a.any():
                    raw.append((a + a.dtype.type(0)).tobytes())  # -0.0 becomes 0.0
                    code.append(hashlib.md5(raw[-1]).digest())
                else:
                    raw.append(None)
                    code.append(None)
            yield pa.RecordBatch.from_arrays(
                [ids, labels, pa.array(code, pa.binary()), pa.array(raw, pa.binary())], ["vec_id", "label", "code", "vec"])

    kind = "string" if dict(df.dtypes)[label_col] == "string" else "bigint"
    return df.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<float>" if item == "<f4" else "array<double>"),
        F.col(label_col).cast(kind).alias("label"),
    ).mapInArrow(run, f"vec_id bigint, label {kind}, code binary, vec binary")


def _unit(raw: list[bytes], item: str) -> np.ndarray:
    """Vectors of one length, scaled to length one in double precision."""
    a = np.frombuffer(b"".join(raw), item).reshape(len(raw), -1).astype(np.float64)
    a /= np.abs(a).max(1, keepdims=True)  # so that no square overflows
    return a / np.sqrt((a * a).sum(1, keepdims=True))


def _with_cells(classes: DataFrame, item: str) -> DataFrame:
    """The classes (cid, label, n, vec) with their cell keys as one array."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, label = batch.column(3).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
            keys: list = [None] * len(raw)
            dims = np.array([len(x) for x in raw])
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                for row, k in zip(at, cells(_unit([raw[i] for i in at], item), label[at]).reshape(len(at), -1)):
                    keys[row] = k
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.list_(pa.int64()))],
                                             ["cid", "label", "n", "vec", "cells"])

    return classes.select("cid", "label", "n", "vec").mapInArrow(
        run, f"cid bigint, label {dict(classes.dtypes)['label']}, n bigint, vec binary, cells array<bigint>")


def _met_first(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The first meeting of each pair, given the cells of its smaller and its larger id.

    Meeting 2t: the smaller comes to the larger's home in table t; 2t + 1: the other way round.
    """
    a = (lo == hi[:, :, :1]).any(2)
    b = (hi == lo[:, :, :1]).any(2)
    return np.stack([a, b], 2).reshape(len(lo), -1).argmax(1)


class _Cell:
    """Residents of one block of a cell; visitors are compared with them as they come."""

    def __init__(self, threshold: float) -> None:
        self.threshold, self.home = threshold, None

    def settle(self, rows: dict[str, np.ndarray]) -> None:
        self.home = rows if self.home is None else {k: np.concatenate([v, rows[k]]) for k, v in self.home.items()}

    def meet(self, guests: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(id, links, smallest id joined) for the members of links counted here."""
        home = self.home
        if home is None:
            return
        step = max(1, PAIRS_AT_ONCE // len(home["cid"]))
        for at in range(0, len(guests["cid"]), step):
            g = {k: v[at:at + step] for k, v in guests.items()}
            close = (g["unit"] @ home["unit"].T) >= self.threshold
            close &= (g["cid"][:, None] != home["cid"][None, :]) & (g["label"][:, None] == home["label"][None, :])
            i, j = np.nonzero(close)
            if not len(i):
                continue
            lower = g["cid"][i] < home["cid"][j]
            gc, hc = g["cells"][i], home["cells"][j]
            side = lower[:, None, None]
            mine = 2 * g["table"][i] + ~lower == _met_first(np.where(side, gc, hc), np.where(side, hc, gc))
            i, j = i[mine], j[mine]
            if not len(i):
                continue
            ids, member = np.unique(np.concatenate([g["cid"][i], home["cid"][j]]), return_inverse=True)
            u, v = member[:len(i)], member[len(i):]
            links = np.zeros(len(ids), np.int64)
            np.add.at(links, u, home["n"][j])
            np.add.at(links, v, g["n"][i])
            yield ids, links, ids[forest(len(ids), [(u, v)])]


def _links(homes: DataFrame, threshold: float, item: str) -> DataFrame:
    """(cid, links, low) partial results from the cells; ``homes`` has cid, label, n, vec and cells."""
    width = 1 + PROBES
    key_at = F.posexplode("cells").alias("at", "key")
    thin = homes.select("cid", key_at)
    residents = stored(thin.where(F.col("at") % width == 0).groupBy("key").agg(
        F.count("*").alias("residents"), F.min("cid").alias("first")), "cells")
    visits = thin.join(residents, "key").where((F.col("residents") > 1) | (F.col("first") != F.col("cid")))
    # a resident that is alone and unvisited is never sent
    visited = visits.groupBy("key").agg(F.count("*").alias("guests"))
    alone = thin.where(F.col("at") % width == 0).join(residents.where("residents = 1"), "key")
    sent = visits.unionByName(alone.join(visited.select("key"), "key")).join(
        visited.where(F.col("guests") > BLOCK), "key", "left")
    # a crowded cell is a grid: blocks of residents times blocks of guests
    across = F.ceil(F.col("residents") / BLOCK).cast("int")
    down = F.ceil(F.coalesce("guests", F.lit(1)) / BLOCK).cast("int")
    own = (F.col("at") % width) == 0
    mine = F.pmod(F.xxhash64("cid"), across).cast("int")
    turn = F.pmod(F.xxhash64("cid"), down).cast("int")
    # role 0: resident and guest (the cell is one block); 1: resident of a column; 2: guest of a row
    stay = F.when(own & (across == 1) & (down == 1), F.array(F.struct(F.lit(0).alias("block"), F.lit(0).alias("role"))))
    go = F.transform(F.sequence(F.lit(0), across - 1),
                     lambda b: F.struct((b * down + turn).alias("block"), F.lit(2).alias("role")))
    live = F.transform(F.sequence(F.lit(0), down - 1),
                       lambda b: F.struct((mine * down + b).alias("block"), F.lit(1).alias("role")))
    dealt = sent.withColumn("to", F.explode(F.coalesce(stay, F.when(own, F.concat(live, go)), go))).select(
        "cid", "key", (F.col("at") / width).cast("int").alias("table"), "to.block", "to.role")
    full = dealt.join(homes, "cid").select("key", "block", "role", "table", "cid", "label", "n", "vec", "cells")
    parts = int(homes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, at = _Cell(threshold), None
        for batch in batches:
            key, block, role = (batch.column(c).to_numpy() for c in range(3))
            edge = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1, [len(key)]])
            raw = batch.column(7).to_pylist()
            unit = _unit(raw, item) if len(set(map(len, raw))) == 1 else None
            flat = batch.column(8).flatten().to_numpy().reshape(len(key), TABLES, width)
            cols = {n: batch.column(c).to_numpy(zero_copy_only=False) for c, n in ((3, "table"), (4, "cid"), (5, "label"), (6, "n"))}
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                if b == a:
                    continue
                if at != (key[a], block[a]):
                    cell, at = _Cell(threshold), (key[a], block[a])
                elif cell.home is None and role[a] == 2:
                    continue
                if b - a == 1 and cell.home is None and (role[a] == 2 or b < len(key)):
                    continue  # nobody else there
                rows = {k: v[a:b] for k, v in cols.items()} | {"unit": unit[a:b] if unit is not None else _unit(raw[a:b], item), "cells": flat[a:b]}
                lives = role[a:b] < 2
                earlier = cell.home
                if lives.any():
                    cell.settle({k: v[lives] for k, v in rows.items()})
                parts = list(cell.meet({k: v[role[a:b] != 1] for k, v in rows.items()}))
                if earlier is not None and (role[a:b] == 0).any():  # residents of an earlier batch come to the new ones
                    new = _Cell(threshold)
                    new.settle({k: v[lives] for k, v in rows.items()})
                    parts += new.meet(earlier)
                for ids, links, low in parts:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64()), pa.array(links, pa.int64()), pa.array(low, pa.int64())],
                        ["cid", "links", "low"])

    return full.repartition(parts, "key", "block").sortWithinPartitions("key", "block", "role").mapInArrow(
        run, "cid bigint, links bigint, low bigint")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = COSINE) -> DataFrame:
    """Per vector: id, n_links (other vectors linked), component_id, kept (it is its component's smallest)."""
    item = "<f4" if dict(df.dtypes)[vector_col] == "array<float>" else "<f8"
    base = stored(_coded(df, id_col, vector_col, label_col, item), "vectors")
    classes = stored(
        base.where("code is not null").groupBy("label", "code")
        .agg(F.min("vec_id").alias("low_id"), F.count("*").alias("n"), F.first("vec").alias("vec"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")
    found = stored(_links(stored(_with_cells(classes, item), "class-cells"), threshold, item), "links")
    joined = components(found.select("cid", "low"), "vector-components")
    sums = found.groupBy("cid").agg(F.sum("links").alias("links"))
    named = classes.select("cid", "label", "code", "low_id", "n").join(sums, "cid", "left").join(
        joined.withColumnRenamed("id", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    named = stored(named, "class-components")
    smallest = named.groupBy("component").agg(F.min("low_id").alias("component_id"))
    label = named.join(smallest, "component").select(
        "label", "code", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = base.select("vec_id", "label", "code").join(stored(label, "class-labels"), ["label", "code"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        F.col("vec_id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
