"""Filter interaction audit by wide packed counters.

Five filters judge each document on its own, so what happens to a document at any step of any order of the filters
follows from its mask of failed filters (and its labels). Each such state stands for one big integer whose fields
hold what the state adds to every counter of all 600 steps (120 orders of five steps). The integers of a part's
documents are summed: in each task first, then in each of some groups of tasks, then once a part; the sum is unpacked
into 600 rows. A field has ``WIDTH`` bits, and the document count stands above all others, where it has no upper
end: it is read first, and a part of more documents than a field can count raises an error instead of a wrong result.

Whether a text equals one of a smaller doc_id is not known where the text is read. All documents are first taken to
be such copies; the documents with the smallest doc_id of a text are then found (one row a task and text is sent),
and add the difference of the two integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from indicator_lake.llm.tables import stored

FILTERS = "ABCDE"
ORDERS = ["".join(order) for order in permutations(FILTERS)]
STEPS = [(order, step) for order in ORDERS for step in range(1, len(FILTERS) + 1)]
#: Counters of a step; a filter's count of documents that fail it alone has one field for all steps.
COUNTERS = ("kept", "removed", "redundant", "good_lost", "toxic_lost")
BYTES = 6
WIDTH = 8 * BYTES
COPY, GOOD, TOXIC = 1 << 4, 1 << 5, 1 << 6  # bits of a state above those of filters A to D
STATES = 1 << 7
MOST_PARTS = 256  # sums that a task holds before it sends them on
TASK_GROUPS = 64
FIELDS = len(STEPS) * len(COUNTERS) + len(FILTERS)

MIN_WORDS = 200
SLICE = 1 << 20  # bytes of a long text whose words are held at once
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_MARKS = frozenset("#$%&*|")
_SPACE = regex.compile(rb"[\x20\x09-\x0D]")
_JUDGED = "doc_id long, part string, state int, content binary"
_PACKED = "part string, packed binary"
_RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


@cache
def packed_state(state: int) -> int:
    """The integer that a document of this state adds: a one in each field that counts it."""
    fails = {name for i, name in enumerate(FILTERS) if state >> i & 1}
    total = 1 << (WIDTH * FIELDS)  # the document count
    for i, (order, step) in enumerate(STEPS):
        here, gone = order[step - 1] in fails, bool(fails.intersection(order[: step - 1]))
        lost = here and not gone
        counted = (not gone and not here, lost, here and gone, lost and state & GOOD, lost and state & TOXIC)
        for j, one in enumerate(counted):
            if one:
                total += 1 << (WIDTH * (i * len(COUNTERS) + j))
    if len(fails) == 1:
        total += 1 << (WIDTH * (FIELDS - len(FILTERS) + FILTERS.index(*fails)))
    return total


def unpacked(total: int) -> list[tuple]:
    """(filter_order, step, counters in the order of the result) of all steps."""
    documents = total >> (WIDTH * FIELDS)
    if not 0 <= documents < 1 << WIDTH:
        raise OverflowError(f"{documents} documents in one part; a field counts less than {1 << WIDTH}")
    low = total & ((1 << (WIDTH * FIELDS)) - 1)
    raw = np.frombuffer(low.to_bytes(BYTES * FIELDS, "little"), np.uint8).reshape(FIELDS, BYTES)
    fields = np.pad(raw, ((0, 0), (0, 8 - BYTES))).copy().view("<u8").ravel().astype(np.int64)
    steps = fields[: len(STEPS) * len(COUNTERS)].reshape(len(STEPS), len(COUNTERS)).tolist()
    alone = dict(zip(FILTERS, fields[-len(FILTERS) :].tolist(), strict=True))
    shapley = dict.fromkeys(FILTERS, 0)
    for (order, step), counts in zip(STEPS, steps, strict=True):
        shapley[order[step - 1]] += counts[1]
    rows = []
    for (order, step), (kept, removed, redundant, good, toxic) in zip(STEPS, steps, strict=True):
        name = order[step - 1]
        rows.append((order, step, kept, removed, redundant, alone[name], good, toxic, shapley[name]))
    return rows


def _word_slices(data: bytes) -> Iterator[list[bytes]]:
    start = 0
    while len(data) - start > SLICE:
        cut = _SPACE.search(data, start + SLICE)
        if cut is None:
            break
        yield data[start : cut.start()].split()
        start = cut.start()
    yield data[start:].split()  # without an argument, bytes split at exactly the six characters asked for


def failed_filters(text: str) -> int:
    """Bits of the filters A to D that the text fails."""
    data = text.encode()
    words, distinct = 0, set()
    for part in _word_slices(data):
        words += len(part)
        distinct.update(part)
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    fails = (
        words < MIN_WORDS,
        100 * len(distinct) < 50 * words,
        100 * capitals > 3 * len(text),
        not _MARKS.isdisjoint(text),
    )
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        states, contents = [], []
        for value in batch.column(2):
            text = value.as_py() or ""
            states.append(failed_filters(text))
            contents.append(hashlib.sha256(text.encode()).digest())
        arrays = [batch.column(0), batch.column(1), pa.array(states, pa.int32()), pa.array(contents, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "part", "state", "content"])


def _sent(sums: dict[str, int]) -> pa.RecordBatch:
    # the byte count leaves room for the sign: a task may hold more corrections than documents
    packed = [total.to_bytes(total.bit_length() // 8 + 1, "little", signed=True) for total in sums.values()]
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(packed, pa.binary())], ["part", "packed"])


def _sum_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of the integers of a task's rows for each part; equal states of a batch are added by their number."""
    sums: dict[str, int] = {}
    for batch in batches:
        part = batch.column(0).dictionary_encode()
        first = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
        key = (part.indices.to_numpy().astype(np.int64) * 2 + first) * STATES + batch.column(1).to_numpy()
        for value, n in zip(*(x.tolist() for x in np.unique(key, return_counts=True)), strict=True):
            rest, state = divmod(value, STATES)
            index, is_first = divmod(rest, 2)
            name = part.dictionary[index].as_py()
            one = packed_state(state) - packed_state(state | COPY) if is_first else packed_state(state)
            sums[name] = sums.get(name, 0) + n * one
        if len(sums) > MOST_PARTS:
            yield _sent(sums)
            sums = {}
    yield _sent(sums)


def _sum_packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, int] = {}
    for batch in batches:
        for name, packed in zip(batch.column(0), batch.column(1), strict=True):
            part = name.as_py()
            sums[part] = sums.get(part, 0) + int.from_bytes(packed.as_buffer(), "little", signed=True)
        if len(sums) > MOST_PARTS:
            yield _sent(sums)
            sums = {}
    yield _sent(sums)


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by part, all rows of a part in one task."""

    def rows(part: str, total: int) -> pa.RecordBatch:
        columns = list(zip(*unpacked(total), strict=True))
        kinds = [pa.string(), pa.int32(), *[pa.int64()] * 7]
        arrays = [pa.array([part] * len(STEPS), pa.string()), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]]
        return pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in _RESULT.split(", ")])

    part, total = None, 0
    for batch in batches:
        for name, packed in zip(batch.column(0), batch.column(1), strict=True):
            if part is not None and part != name.as_py():
                yield rows(part, total)
                total = 0
            part = name.as_py()
            total += int.from_bytes(packed.as_buffer(), "little", signed=True)
    if part is not None:
        yield rows(part, total)


def _label_bits(labels: DataFrame) -> DataFrame:
    """(doc_id, bits): good if any label of the id says quality 1, toxic if any says toxic 1."""
    bit = {"quality": GOOD, "toxic": TOXIC}
    bits = [F.coalesce(F.max(F.when(F.col(c) == 1, F.lit(b)).otherwise(0)), F.lit(0)) for c, b in bit.items()]
    return labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((bits[0] + bits[1]).alias("bits"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step, zeros included.

    Parts are the values of ``lang`` (null: empty string). A null text counts as empty; an id repeated with the same
    text is no copy of itself; a row without an id is nobody's copy and has no label. Repeated rows count each time.
    Only doc_id, text, lang and the labels' doc_id, quality and toxic are read. An empty table has no parts.
    """
    part = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long"), part.alias("part"), F.col("text").cast("string").alias("text"))
    judged = texts.mapInArrow(_judge, _JUDGED)
    labelled = judged.join(_label_bits(labels), "doc_id", "left")
    state = F.col("state").bitwiseOR(F.coalesce("bits", F.lit(0)))
    # narrow rows, written once: they are read for the sums and for the firsts
    rows = stored(labelled.select("doc_id", "part", state.cast("int").alias("state"), "content"), "judged")
    copies = F.when(F.col("doc_id").isNotNull(), F.col("state").bitwiseOR(COPY)).otherwise(F.col("state"))
    everyone = rows.select("part", copies.alias("state"), F.lit(False).alias("first"))
    # rank 1 is picked in each task before the shuffle, so a text that many rows share sends few of them
    place = F.rank().over(W.partitionBy("content").orderBy("doc_id"))
    firsts = rows.where("doc_id is not null").withColumn("place", place).where("place = 1")
    both = everyone.unionByName(firsts.select("part", "state", F.lit(True).alias("first")))
    tasks = both.mapInArrow(_sum_states, _PACKED)
    grouped = tasks.repartition("part", F.spark_partition_id() % TASK_GROUPS).mapInArrow(_sum_packed, _PACKED)
    return grouped.repartition("part").sortWithinPartitions("part").mapInArrow(_unpack, _RESULT)
