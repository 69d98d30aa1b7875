"""Hierarchical multi-length packing of tokenised documents.

A document is cut into whole windows of ``context`` tokens and a rest. Each rest is routed to the context-size tier
(a power of two, from ``SHORTEST_TIER`` to ``context``) that holds it. Tiers are packed from the longest to the
shortest, each into windows of its own size: its longest rest opens a window, and the gap is filled with the longest
rest that fits, of this tier or a shorter one, or, when none fits, with the front of the longest rest of the shorter
tiers. The last, part-filled window of a task becomes sequences of exact powers of two. So windows hold no padding,
and only a rest that fills a gap is cut. The sequences of a tier are dealt into step groups of like attention cost
(the sum of squared piece lengths).

Documents are tokenised where they are read; only rests and the metadata of whole windows are shuffled, by a hash of
the document. Each task packs its rests in chunks of bounded size.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicator_lake.llm.memory import tidy

CONTEXT = 2048
END = 1  # the id that closes a document
CHUNK = 8192  # rests packed at a time; bounds memory, and drops nothing: what stays over joins the next chunk
DOCS_PER_TASK = 1 << 15
GROUP = 64  # sequences of a step group
SHORTEST_TIER = 64

_PIECES = "doc_id long, start long, doc_tokens long, length long, crc long, ids binary, place long"
_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "sequence_length long, tier long, step_group long"
)


@lru_cache(maxsize=2)
def _encoder(path: str):
    """The byte-level BPE of a tokenizers file, run by its vocabulary's ranks.

    The file's merges in order and its vocabulary's byte strings in id order are the same ranks, so the ids are those
    of ``tokenizers`` (a test compares them); this form encodes several times faster.
    """
    import json

    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    vocabulary, added = whole["model"]["vocab"], whole.get("added_tokens") or []
    if any(t.get(flag) for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens that take in more or less than their own characters are not supported")
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
    ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if all(c in letters for c in token)}
    tokens = {t["content"]: t["id"] for t in added}
    for content in tokens:  # no merge makes an added token
        ranks.pop(content.encode(), None)
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=tokens)


def encode(path: str, text: str | None, encode_special_tokens: bool = True) -> np.ndarray:
    """The ids of a text (null: none) and the closing id.

    ``encode_special_tokens`` is that of ``tokenizers``: true takes the file's added tokens as plain characters, false
    (the library's own default, and what the queries use) splits texts at them and gives their ids.
    """
    ids = []
    if text:
        ids = _encoder(path).encode_ordinary(text) if encode_special_tokens else _encoder(path).encode(text, allowed_special="all")
    return np.array([*ids, END], "<u4")


def _cut(path: str, context: int, encode_special_tokens: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _PIECES.split(", ")]
        kinds = [pa.int64()] * 5 + [pa.binary(), pa.int64()]
        for batch in batches:
            rows: list[tuple] = []
            for doc, text, place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = encode(path, text, encode_special_tokens)
                whole = len(ids) // context * context
                for start in range(0, whole, context):
                    rows.append((doc, start, len(ids), context, zlib.crc32(ids[start : start + context]), None, place))
                if whole < len(ids):
                    rows.append((doc, whole, len(ids), len(ids) - whole, None, ids[whole:].tobytes(), place))
                if len(rows) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run


class Rests:
    """Rests in order of length, to take the longest of at most some length."""

    def __init__(self, items: list[tuple]):
        self.items = sorted(items, key=_size)

    def take(self, most: int) -> tuple | None:
        at = bisect_right(self.items, most, key=_size)
        return self.items.pop(at - 1) if at else None

    def put(self, item: tuple) -> None:
        insort(self.items, item, key=_size)


def _size(item: tuple) -> int:
    return len(item[3]) // 4


def tiers(context: int) -> list[int]:
    """Context sizes, the longest first."""
    return [context >> k for k in range(context.bit_length()) if context >> k >= min(SHORTEST_TIER, context)]


def tier_of(size: int, context: int) -> int:
    """The shortest tier that holds a rest of this size."""
    return max(1 << (size - 1).bit_length(), min(SHORTEST_TIER, context))


def pack_rests(items: list[tuple], context: int) -> tuple[list[tuple[int, list[tuple]]], list[tuple]]:
    """(full windows with their tiers, rests that stay over) for rests (doc, start, doc_tokens, id bytes).

    Tier by tier from the longest: each rest still in the tier opens a window of the tier's size or fills one.
    """
    sizes = tiers(context)
    routed: dict[int, list[tuple]] = {t: [] for t in sizes}
    for item in items:
        routed[tier_of(_size(item), context)].append(item)
    pools = {t: Rests(found) for t, found in routed.items()}
    full: list[tuple[int, list[tuple]]] = []
    for place, tier in enumerate(sizes):
        own, shorter = pools[tier], [pools[t] for t in sizes[place + 1 :]]
        while own.items:
            window = [own.items.pop()]
            gap = tier - _size(window[0])
            while gap:
                found = next((x for pool in (own, *shorter) if (x := pool.take(gap)) is not None), None)
                if found is None:  # nothing fits whole: cut the longest rest of the shorter tiers, else of this one
                    source = next((pool for pool in shorter if pool.items), own)
                    if not source.items:
                        return full, window
                    doc, start, tokens, ids = source.items.pop()
                    found = (doc, start, tokens, ids[: 4 * gap])
                    left = (doc, start + gap, tokens, ids[4 * gap :])
                    pools[tier_of(_size(left), context)].put(left)
                window.append(found)
                gap -= _size(found)
            full.append((tier, window))
    return full, []


def powers(window: list[tuple], context: int) -> list[tuple[int, list[tuple]]]:
    """A part-filled window as sequences whose lengths are powers of two, with their lengths."""
    sequences, left = [], sum(map(_size, window))
    pieces = window[::-1]
    while left:
        length = room = min(context, 1 << (left.bit_length() - 1))
        left -= room
        sequence = []
        while room:
            doc, start, tokens, ids = pieces.pop()
            if len(ids) // 4 > room:
                pieces.append((doc, start + room, tokens, ids[4 * room :]))
                ids = ids[: 4 * room]
            sequence.append((doc, start, tokens, ids))
            room -= len(ids) // 4
        sequences.append((length, sequence))
    return sequences


def _pack(context: int, chunk: int, group: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        names = [f.split()[0] for f in _SCHEMA.split(", ")]
        waiting: list[tuple[int, list[tuple]]] = []  # tier and pieces of the sequences of the step groups to come
        made = 0

        def flush() -> Iterator[pa.RecordBatch]:
            """Deal each tier's waiting sequences by falling cost, back and forth, into step groups."""
            nonlocal waiting, made
            rows = []
            for tier in sorted({t for t, _ in waiting}, reverse=True):
                own = [pieces for t, pieces in waiting if t == tier]
                groups = max(1, len(own) // group)
                order = sorted(range(len(own)), key=lambda i: (-sum(p[3] ** 2 for p in own[i]), i))
                for rank, i in enumerate(order):
                    turn, place = divmod(rank, groups)
                    step = groups - 1 - place if turn % 2 else place
                    pieces, offset = own[i], 0
                    total = sum(p[3] for p in pieces)
                    for doc, start, tokens, length, crc in pieces:
                        number = (task << 33) + made + i
                        rows.append((doc, start, length, crc, tokens, number, offset, total, tier, (task << 33) + made + step))
                        offset += length
                made += len(own)
            waiting = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)

        def sealed(window: tuple[int, list[tuple]]) -> tuple[int, list[tuple]]:
            tier, pieces = window
            return tier, [(doc, start, tokens, len(ids) // 4, zlib.crc32(ids)) for doc, start, tokens, ids in pieces]

        rests: list[tuple] = []
        for batch in batches:
            for doc, start, tokens, length, crc, ids in zip(*(c.to_pylist() for c in batch.columns[:6]), strict=True):
                if ids is None:
                    waiting.append((context, [(doc, start, tokens, length, crc)]))
                else:
                    rests.append((doc, start, tokens, ids))
                if len(rests) >= chunk:
                    full, rests = pack_rests(rests, context)
                    waiting += map(sealed, full)
                if len(waiting) >= chunk:
                    yield from flush()
        full, rests = pack_rests(rests, context)
        waiting += map(sealed, full)
        waiting += map(sealed, powers(rests, context))
        yield from flush()

    return run


def packed(
    docs: DataFrame, tokenizer: str, context: int = CONTEXT, docs_per_task: int = DOCS_PER_TASK, encode_special_tokens: bool = True
) -> DataFrame:
    """One row per piece of docs (doc_id, text).

    ids_crc32 is over the piece's ids as little-endian unsigned 32-bit numbers; offset is the piece's place in its
    sequence; sequence_length is the sequence's tokens and tier the context size it was packed for (they are equal). A null or empty text
    is its closing id alone. ``encode_special_tokens`` is as in ``encode``. Equal rows are separate documents. Other columns of docs are ignored. The number of
    tasks follows the number of rows, so each packs a bounded share; results are the same in every run over the
    same rows and number of tasks.
    """
    if context < 2 or context & (context - 1):
        raise ValueError("context must be a power of two")
    tasks = max(1, -(-docs.count() // docs_per_task))
    place = F.xxhash64("doc_id", "text").alias("place")
    pieces = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), place)
    pieces = pieces.mapInArrow(tidy(_cut(tokenizer, context, encode_special_tokens)), _PIECES)
    dealt = pieces.repartition(tasks, "place", "start").sortWithinPartitions("place", "doc_id", "start")
    return dealt.drop("place").mapInArrow(tidy(_pack(context, CHUNK, GROUP)), _SCHEMA)
