"""Hard negatives by Fagin's threshold algorithm over blocks of candidates.

Scores are integer inner products. In each block every dimension has a list of the block's candidates sorted by
their component. An anchor goes down the lists of its non-zero components, from the top where its own is positive and
from the bottom where it is negative, scores each candidate met for the first time in full, and knows that no
candidate not met can score more than its components times the last ones seen (the threshold). It stops once the
threshold is strictly below the score that counts: a candidate of equal score could still win by its smaller id.

Two searches: the best rows of the anchor's label, then for each of these positives the best rows of other labels
inside its window of scores. The second stops when for every window the threshold is strictly below its last wanted
score or below its lower end. Results of blocks are merged by score and id, so they are exact for any blocks.

Anchors go out in passes of at most about ``PASS_VALUES`` components, broadcast to the blocks; candidates are not
sent again. Blocks have about ``BLOCK_ROWS`` rows dealt by id, whatever their label.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from indicator_lake.llm.tables import stored

SCALE = 256
BLOCK_ROWS = 8192
PASS_VALUES = 1 << 22  # components of anchors in one broadcast: 32 MB
FIRST_DEPTH = 32  # entries read from each list before the first look at the threshold; doubled after each look
_LONG = (-(1 << 63), (1 << 63) - 1)

_FOUND = "anchor_id long, positive_id long, positive_score long, other_id long, score long"


def exact(values: list[np.ndarray]) -> list[np.ndarray]:
    """The integer arrays in a type whose inner products are exact: doubles, longs or Python integers."""
    most = [max(abs(int(v.max())), abs(int(v.min()))) if v.size else 0 for v in values]
    bound = most[0] * most[1] * max(values[0].shape[-1], 1)
    if bound < 1 << 53:
        return [v.astype(np.float64) for v in values]
    return values if bound < 1 << 63 else [v.astype(object) for v in values]


class Lists:
    """Per-dimension sorted lists of candidates."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(vectors, self.order, axis=0)

    def search(self, anchor: np.ndarray, enough: Callable[[np.ndarray, np.ndarray, int], bool]) -> tuple[np.ndarray, np.ndarray]:
        """(candidates met, their scores) by the time ``enough(candidates, scores, threshold)`` holds, or all of them."""
        n = len(self.ids)
        up, down = np.flatnonzero(anchor < 0), np.flatnonzero(anchor > 0)
        met = np.zeros(n, bool)
        rows, scores, depth, before = np.zeros(0, np.int64), self.vectors[:0] @ anchor, FIRST_DEPTH, 0
        while True:
            depth = min(depth, n)
            if depth == n or not len(up) + len(down):
                fresh = np.flatnonzero(~met)
            else:
                here = np.zeros(n, bool)
                here[self.order[before:depth, up]] = True
                here[self.order[n - depth : n - before, down]] = True
                fresh = np.flatnonzero(here & ~met)
                met |= here
            # with many fresh candidates one product over all rows is quicker than picking their rows
            found = (self.vectors @ anchor)[fresh] if 4 * len(fresh) > n else self.vectors[fresh] @ anchor
            rows, scores = np.concatenate([rows, fresh]), np.concatenate([scores, found])
            if depth == n or len(rows) == n:
                return rows, scores
            threshold = self.sorted[depth - 1, up] @ anchor[up] + self.sorted[n - depth, down] @ anchor[down]
            if enough(rows, scores, threshold):
                return rows, scores
            before, depth = depth, 2 * depth


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k by falling score, then by id."""
    if len(scores) > 8 * k and scores.dtype != object:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= cut)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))][:k]


@dataclass
class Anchors:
    """Anchors of one length: ids, labels, vectors, and the windows (positive id, its score, low, high) of each."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    windows: list[list[tuple[int, int, int, int]]] = field(default_factory=list)


@dataclass(frozen=True)
class Wanted:
    positives: int = 5
    negatives: int = 3
    low_percent: int = 50
    high_percent: int = 95

    def window(self, score: int) -> tuple[int, int]:
        """Lowest and highest whole negative score s with low * score <= 100 s <= high * score."""
        return -(-self.low_percent * score // 100), self.high_percent * score // 100


def _top_positives(lists: Lists, anchors: Anchors, i: int, wanted: Wanted) -> Iterator[tuple]:
    k, own = wanted.positives, anchors.ids[i]

    def enough(rows, scores, threshold) -> bool:
        others = scores[lists.ids[rows] != own]
        return len(others) >= k and threshold < np.sort(others)[len(others) - k]

    rows, scores = lists.search(anchors.vectors[i], enough)
    other = lists.ids[rows] != own
    ids, scores = lists.ids[rows][other], scores[other]
    for j in best(ids, scores, k):
        yield own, None, None, ids[j], scores[j]


def _top_negatives(lists: Lists, labels: np.ndarray, anchors: Anchors, i: int, wanted: Wanted) -> Iterator[tuple]:
    k, own = wanted.negatives, anchors.labels[i]
    open_windows = [w for w in anchors.windows[i] if w[2] <= w[3]]
    if not open_windows:
        return

    def enough(rows, scores, threshold) -> bool:
        usable = scores[labels[rows] != own]
        for _, _, low, high in open_windows:
            inside = usable[(usable >= low) & (usable <= high)]
            if threshold >= low and (len(inside) < k or threshold >= np.sort(inside)[len(inside) - k]):
                return False
        return True

    rows, scores = lists.search(anchors.vectors[i], enough)
    usable = labels[rows] != own
    ids, scores = lists.ids[rows][usable], scores[usable]
    for positive, score, low, high in open_windows:
        inside = np.flatnonzero((scores >= low) & (scores <= high))
        for j in inside[best(ids[inside], scores[inside], k)]:
            yield anchors.ids[i], positive, score, ids[j], scores[j]


def _found_batch(rows: list[tuple]) -> pa.RecordBatch:
    clamp = lambda v: None if v is None else min(max(int(v), _LONG[0]), _LONG[1])
    columns = list(zip(*rows, strict=True)) if rows else [()] * 5
    arrays = [pa.array([clamp(v) for v in column], pa.int64()) for column in columns]
    return pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in _FOUND.split(", ")])


def _by_length(batch: pa.Table | pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, ids, labels, vectors) of the rows of each vector length."""
    column = batch.column("v")
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0) if lists.num_chunks else pa.array([], pa.list_(pa.int64()))
    lengths = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    ids, labels = (np.asarray(batch.column(c).to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch) else batch.column(c).to_numpy(), np.int64) for c in ("vec_id", "label"))
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        picked = flat[starts[rows][:, None] + np.arange(length)] if length else np.zeros((len(rows), 0), np.int64)
        yield length, ids[rows], labels[rows], picked.reshape(len(rows), length)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= BLOCK_ROWS:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _searcher(sent, wanted: Wanted, negative: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            for length, ids, labels, vectors in _by_length(block):
                if length not in sent.value:
                    continue
                anchors: Anchors = sent.value[length]
                vectors, against = exact([vectors, anchors.vectors])
                anchors = Anchors(anchors.ids, anchors.labels, against, anchors.windows)
                rows: list[tuple] = []
                if negative:
                    lists = Lists(ids, vectors)
                    for i in range(len(anchors.ids)):
                        rows.extend(_top_negatives(lists, labels, anchors, i, wanted))
                else:
                    for label in np.unique(labels).tolist():
                        asked = np.flatnonzero(anchors.labels == label)
                        if len(asked):
                            same = labels == label
                            lists = Lists(ids[same], vectors[same])
                            for i in asked:
                                rows.extend(_top_positives(lists, anchors, i, wanted))
                yield _found_batch(rows)

    return run


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first k rows of each key by falling score, then by id; each block's own rows are cut first."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy(F.col("score").desc(), "other_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def prepared(vectors: DataFrame, label: Column | None = None, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v): one row per vec_id, its components as whole numbers.

    Rows with a null id, label or vector, or a null or non-finite component, take no part. Of rows with one id the
    one with the smallest label, then the smallest vector, stays. Rows are dealt by id into blocks.
    """
    numbers = F.transform("embedding", lambda x: x.cast("double"))
    one = vectors.select(F.col("vec_id").cast("long"), (F.col("label") if label is None else label).cast("long").alias("label"), numbers.alias("x"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    usable = one.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).where(finite)
    whole = usable.select("vec_id", F.struct("label", F.transform("x", lambda x: F.floor(x * scale)).alias("v")).alias("row"))
    blocks = -(-max(usable.count(), 1) // BLOCK_ROWS)
    kept = whole.repartition(blocks, "vec_id").groupBy("vec_id").agg(F.min("row").alias("row"))
    return stored(kept.select("vec_id", "row.label", "row.v"), "vectors")


def mine(rows: DataFrame, is_anchor: Column, wanted: Wanted = Wanted()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of rows as ``prepared`` gives them.

    For each anchor and each of its first positives, the first rows of another label whose score lies in the
    positive's window. Vectors of unequal length never meet; empty ones score 0. Scores beyond a long are cut to
    its ends in the result. Anchors without a positive or a negative have no row.
    """
    spark = rows.sparkSession
    anchors = rows.where(is_anchor)
    values = anchors.agg(F.sum(F.size("v") + 1)).first()[0]
    if not values:
        empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return spark.createDataFrame([], empty)
    passes, parts = -(-values // PASS_VALUES), []
    for number in range(passes):
        chosen = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == number).toArrow()  # one pass: bounded
        by_length = {length: Anchors(*found) for length, *found in _by_length(chosen)}
        sent = spark.sparkContext.broadcast(by_length)
        found = rows.mapInArrow(_searcher(sent, wanted, False), _FOUND)
        positives = stored(_first(found, ["anchor_id"], wanted.positives), "positives")
        windows: dict[int, list] = {}
        for anchor, positive, score in positives.select("anchor_id", "other_id", "score").collect():  # a few an anchor
            windows.setdefault(anchor, []).append((positive, score, *wanted.window(score)))
        for group in by_length.values():
            group.windows = [sorted(windows.get(i, [])) for i in group.ids.tolist()]
        sent = spark.sparkContext.broadcast(by_length)
        found = rows.mapInArrow(_searcher(sent, wanted, True), _FOUND)
        parts.append(stored(_first(found, ["anchor_id", "positive_id"], wanted.negatives), "negatives"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int"), F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def relabelled(divisor: int = 7, labels: int = 10) -> Column:
    """The label, or the next one around the circle where the id is divisible by ``divisor``."""
    label = F.col("label").cast("long")
    return F.when(F.col("vec_id") % divisor == 0, (label + 1) % labels).otherwise(label)
