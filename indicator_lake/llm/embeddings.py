"""Near-duplicate vectors by collision-counting projections.

Every vector is projected on many random directions. A pair collides on a projection when the values differ by at
most a window centred on the query's value; close pairs collide on nearly all projections, others on few. Pairs
that collide on a count calibrated for the wanted recall at the cosine threshold are verified in double precision.

Sorting one projection against the whole table would pair every vector with a fixed share of all others, so pairs
are only counted within cells: a cell is a run of the sorted values of several projections at once, cut at random
offsets, in each of several tables. Tables and projections per cell follow from the wanted recall and the number of
vectors. A pair that meets in several tables is counted in the first of them alone.

Cells meet twice. First only the marks of the vectors do: their counted projections in whole steps, one byte each.
A vector goes on in those cells alone where it collides often enough with some other, and only there its components
travel, for the exact count and the verification. Steps are allowed for in the window, so no pair is lost by them.

Equal vectors form a class that is compared once. A cell of any size is split into blocks, and each pair of blocks
is a task of its own, so neither a crowded cell nor a large group of close vectors meets in one task.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicator_lake.llm.tables import components, stored
from indicator_lake.llm.words import mix

RECALL = 0.98
COUNTED = 24  # projections whose collisions are counted
BLOCK = 1024  # vectors of a block
CELL = 256  # vectors a cell should hold on average, if they were spread evenly
MOST_TABLES = 256
STEP = 0.05  # of the marks
SEED = 20240517
_U = np.uint64
_HITS = "node long, links long, other long"
_MET = "node long, cell long, t int, low int, high int, side int"


def directions(n: int, width: int, seed: int) -> np.ndarray:
    """n directions; shorter vectors meet the same leading components."""
    return np.random.default_rng(seed).standard_normal((width, n)).T


def window(cosine: float, recall: float) -> tuple[float, int]:
    """(half width, count): a pair at the threshold collides on at least ``count`` of the projections with ``recall``.

    On a standard normal direction the values of two unit vectors differ by a normal with the distance as deviation.
    """
    half = 2.0 * math.sqrt(2 - 2 * cosine)
    p = 2 * NormalDist().cdf(2.0) - 1
    tail = 0.0
    for count in range(COUNTED, -1, -1):
        tail += math.comb(COUNTED, count) * p**count * (1 - p) ** (COUNTED - count)
        if tail >= recall:
            return half, count
    return half, 0


def tables_for(n: int, cosine: float, recall: float) -> tuple[int, int, float]:
    """(tables, projections of a cell, width of a run) for n vectors.

    A run spans four deviations of a threshold pair's difference, so such a pair shares it with chance s; a cell of
    r runs with s ** r, and the tables are as many as the recall then needs. r grows with log(n).
    """
    distance = math.sqrt(2 - 2 * cosine)
    width = 4 * distance
    share = 1 - math.sqrt(2 / math.pi) * distance / width  # about; the exact value is a little higher
    # values of unrelated unit vectors of unit projections spread with deviation 1: entropy of runs of this width
    steps = np.array([NormalDist().cdf((i + 1) * width) - NormalDist().cdf(i * width) for i in range(-40, 40)])
    r = max(1, math.ceil(math.log(max(1, n / CELL)) / -math.log(float((steps**2).sum()))))
    while r > 1 and math.log(1 - recall) / math.log(1 - share**r) > MOST_TABLES:
        r -= 1  # larger cells instead of more tables; they are split into blocks
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - share**r))), r, width


def unit(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(matrix of unit vectors, whether each row is usable) of a list column whose rows have one length."""
    lengths = pa.compute.list_value_length(column).fill_null(0).to_numpy()
    width = int(lengths.max(initial=0))
    found = np.zeros((len(column), width))
    if width:
        flat = column.flatten().cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
        rows = np.repeat(np.arange(len(column)), lengths)
        starts = np.cumsum(lengths) - lengths
        found[rows, np.arange(len(flat)) - np.repeat(starts, lengths)] = flat
    with np.errstate(all="ignore"):
        norm = np.sqrt((found * found).sum(1))
        good = np.isfinite(norm) & (norm > 0)
        found = np.where(good[:, None], found / np.where(good, norm, 1)[:, None], 0)
    return found, good


def cells_of(vectors: np.ndarray, lengths: np.ndarray, tables: int, r: int, width: float, seed: int) -> np.ndarray:
    """The cell of each vector in each table; vectors of unequal length share none."""
    lines = directions(tables * r, vectors.shape[1], seed)
    shift = np.random.default_rng(seed + 1).random(tables * r)
    runs = np.floor(vectors @ lines.T / width + shift).astype(np.int64).view(_U)
    keys = np.empty((len(vectors), tables), _U)
    for t in range(tables):
        key = mix(lengths.astype(_U) * _U(tables) + _U(t))
        for j in range(r):
            key = mix(key ^ mix(runs[:, t * r + j]))
        keys[:, t] = key
    return keys.view(np.int64)


def marks_of(vectors: np.ndarray, seed: int) -> np.ndarray:
    """The counted projections in whole steps; those beyond the bytes' range count as its ends."""
    lines = directions(COUNTED, vectors.shape[1], seed + 2)
    return np.clip(np.rint(vectors @ lines.T / STEP), -127, 127).astype(np.int8)


def _cells(tables: int, r: int, width: float, seed: int, marked: bool):
    """Over (node, embedding, ...): the mark in place of the embedding and all after it, or every column; and the cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, _ = unit(batch.column(1))
            lengths = pa.compute.list_value_length(batch.column(1)).to_numpy()
            keys = cells_of(vectors, lengths, tables, r, width, seed)
            cells = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), tables).cast(pa.list_(pa.int64()))
            if marked:
                marks = pa.array([row.tobytes() for row in marks_of(vectors, seed)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), marks, cells], ["node", "mark", "cells"])
            else:
                yield pa.RecordBatch.from_arrays([*batch.columns, cells], [*batch.schema.names, "cells"])

    return run


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """(table, keys, cuts) of rows sorted by (cell, t, low, high): group i has keys[cuts[i]], rows cuts[i] to cuts[i + 1]."""
    carried: pa.Table | None = None
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            table = pa.Table.from_batches([batch])
            carried = table if carried is None else pa.concat_tables([carried, table])
        if carried is None or not carried.num_rows:
            continue
        keys = np.stack([carried.column(c).to_numpy() for c in ("cell", "t", "low", "high")], 1).astype(np.int64)
        edges = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        cuts = np.concatenate([[0], edges, [len(keys)]])
        if batch is not None:  # the last group may go on in the next batch
            cuts = cuts[:-1]
        if len(cuts) > 1:
            yield carried.slice(0, int(cuts[-1])), keys, cuts
            carried = carried.slice(int(cuts[-1]))


def _meeting(half: float, least: int):
    """Over marks sorted by (cell, t, low, high): the rows whose marks collide often enough with another's of their blocks."""
    window = math.floor(half / STEP + 1 + 1e-9)  # each mark is off by half a step at most

    def met(one: np.ndarray, two: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """Whether each row of one, and each of two, collides often enough with some row of the other block."""
        left, right = np.zeros(len(one), bool), np.zeros(len(two), bool)
        step = max(1, (1 << 20) // (COUNTED * max(1, len(two))))
        for begin in range(0, len(one), step):
            part = one[begin : begin + step]
            often = (np.abs(part[:, None, :] - two[None, :, :]) <= window).sum(2, dtype=np.int8)
            close = often >= least
            if same:
                rows = np.arange(len(part))
                close[rows, begin + rows] = False
            left[begin : begin + step] = close.any(1)
            right |= close.any(0)
        return left, right

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _MET.split(", ")]
        for table, keys, cuts in whole_groups(batches):
            marks = np.frombuffer(b"".join(table.column("mark").to_pylist()), np.int8).reshape(-1, COUNTED).astype(np.int16)
            side = table.column("side").to_numpy()
            chosen = np.zeros(len(side), bool)
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                low, high = keys[begin, 2:]
                own, place = side[begin:end], np.arange(begin, end)
                one, two = place[own == low], place[own == high]
                left, right = met(marks[one], marks[two], low == high)
                chosen[one[left]] = True
                chosen[two[right]] = True
            if chosen.any():
                yield from table.select(names).filter(pa.array(chosen)).to_batches()

    return run


def _close(one: tuple, two: tuple, table: int, same: bool, cosine: float, half: float, least: int) -> Iterator[tuple]:
    """(i, j) of linked pairs of two blocks that meet in no earlier table."""
    step = max(1, (1 << 20) // (COUNTED * len(two[0])))
    for begin in range(0, len(one[0]), step):
        near = np.abs(one[2][begin : begin + step, None, :] - two[2][None, :, :]) <= half
        i, j = np.nonzero(near.sum(2) >= least)
        i += begin
        if same:
            i, j = i[i < j], j[i < j]
        if table and len(i):
            first = ~(one[4][i, :table] == two[4][j, :table]).any(1)
            i, j = i[first], j[first]
        close = np.einsum("ij,ij->i", one[1][i], two[1][j]) >= cosine
        yield i[close], j[close]


def _compare(cosine: float, half: float, least: int, seed: int):
    """Over rows sorted by (cell, t, low, high): all pairs of each two blocks, as counts and the least node that links lead to."""

    def one_group(key: tuple, rows: tuple, side: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        _, table, low, high = key
        one = tuple(x[side == low] for x in rows)
        two = one if low == high else tuple(x[side == high] for x in rows)
        if not len(one[0]) or not len(two[0]):
            return []
        same = low == high
        shift = 0 if same else len(one[0])
        nodes = one[0] if same else np.concatenate([one[0], two[0]])
        weights = one[3] if same else np.concatenate([one[3], two[3]])
        pairs = [(i, j + shift) for i, j in _close(one, two, table, same, cosine, half, least)]
        i, j = (np.concatenate(x) for x in zip(*pairs, strict=True))
        if not len(i):
            return []
        total = np.zeros(len(nodes), np.int64)
        np.add.at(total, i, weights[j])
        np.add.at(total, j, weights[i])
        # the least node reachable inside these blocks stands for all links among them
        reached = nodes.copy()
        while True:
            before = reached.copy()
            np.minimum.at(reached, i, before[j])
            np.minimum.at(reached, j, before[i])
            if (reached == before).all():
                break
        some = total > 0
        return [(nodes[some], total[some], reached[some])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, keys, cuts in whole_groups(batches):
            vectors, _ = unit(table.column("embedding").combine_chunks())
            lines = directions(COUNTED, vectors.shape[1], seed + 2)
            met = table.column("cells").combine_chunks().flatten().to_numpy().reshape(len(vectors), -1)
            rows = (table.column("node").to_numpy(), vectors, (vectors @ lines.T).astype(np.float32), table.column("copies").to_numpy(), met)
            side = table.column("side").to_numpy()
            found = []
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                part = slice(int(begin), int(end))
                found += one_group(tuple(keys[begin]), tuple(x[part] for x in rows), side[part])
            if found:
                columns = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["node", "links", "other"])

    return run


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, recall: float = RECALL, seed: int = SEED) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of vectors (vec_id, embedding), whatever its label.

    A pair links when its cosine in double precision is found and at least ``cosine``; n_links counts other rows
    linked directly, component_id is the smallest vec_id reachable, kept marks the row that has it. Vectors that are
    null, empty, zero or hold null or non-finite components link with nothing. Rows that share a vec_id are judged one
    by one; a row without an id links with nothing and is kept with a null component.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    kind = rows.schema["embedding"].dataType.simpleString()
    holes = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = rows.where("vec_id is not null and size(embedding) > 0").where(~holes).where(F.exists("embedding", lambda x: x != 0))
    classes = stored(usable.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")), "vectors")
    n = classes.count()
    tables, r, width = tables_for(n, cosine, recall)
    half, least = window(cosine, recall)
    # an id that stands for several vectors must not merge their comparisons: classes are numbered by content
    named = classes.select(F.xxhash64("embedding", "node").alias("node"), "embedding", "copies", F.col("node").alias("vec_id"))
    named = stored(named, "vectors")
    marked = named.select("node", "embedding").mapInArrow(
        _cells(tables, r, width, seed, True), "node long, mark binary, cells array<long>"
    )
    places = marked.select("node", "mark", F.posexplode("cells").alias("t", "cell"))
    crowd = places.groupBy("t", "cell").agg(F.count("*").alias("m")).where("m > 1")
    crowd = crowd.withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
    spread = places.join(crowd, ["t", "cell"]).withColumn("side", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = spread.withColumn("mate", partner).select(
        "node", "mark", "cell", "t", F.least("side", "mate").alias("low"), F.greatest("side", "mate").alias("high"), "side"
    )
    group = ["cell", "t", "low", "high"]
    met = stored(spread.repartition(*group).sortWithinPartitions(*group).mapInArrow(_meeting(half, least), _MET), "met")
    some = named.select("node", "embedding", "copies").join(met.select("node").distinct(), "node", "left_semi")
    celled = some.mapInArrow(
        _cells(tables, r, width, seed, False), f"node long, embedding {kind}, copies long, cells array<long>"
    )
    dealt = met.join(celled, "node").repartition(*group).sortWithinPartitions(*group, "node")
    hits = stored(dealt.mapInArrow(_compare(cosine, half, least, seed), _HITS), "hits")
    counted = hits.groupBy("node").agg(F.sum("links").alias("links"))
    both = components(hits.select(F.col("node").alias("a"), F.col("other").alias("b")), "vectors")
    own = named.join(counted, "node", "left").join(both, "node", "left")
    own = own.select("embedding", "vec_id", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("grp"))
    smallest = own.groupBy("grp").agg(F.min("vec_id").alias("component_id"))
    own = own.join(smallest, "grp").select("embedding", "copies", "links", "component_id")
    own = usable.join(own, "embedding").select("vec_id", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    rest = rows.where("vec_id is null or embedding is null or size(embedding) = 0").union(
        rows.where("vec_id is not null and size(embedding) > 0").where(holes | ~F.exists("embedding", lambda x: x != 0))
    )
    rest = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return own.union(rest).select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )
