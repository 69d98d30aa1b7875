"""Byte-level BPE by a table of prefixes: encoding, exact appends, re-encoding near edits, decoding.

A merge list gives every byte string one encoding, and cutting an encoding after any token leaves the encodings of
both parts. So each prefix of a string has one last token, and that token follows from shorter prefixes: of the
vocabulary's matches that end there (Aho-Corasick), it is the only one that the last token of the prefix before it
can stand next to. ``Prefixes`` holds these last tokens; the encoding is read off backwards. An entry depends on the
``longest`` bytes and entries before it and on nothing behind it: appending leaves all entries as they are, and after
an edit only entries up to the first run of ``longest`` unchanged ones are found anew.

Two tokens can stand next to each other when no merge across their border comes before the merges that made them.
Looking back in time, the border is touched by the right ends of the left token and the left ends of the right one;
``_stands`` walks these from the newest to the oldest. Merges go by rank, then from left to right.

Texts are first split by a pattern, and each match is encoded on its own (a match that is a token of the vocabulary
is that token). Encodings of short matches are remembered up to ``REMEMBERED_BYTES`` in each worker; longer matches
are encoded each time. Work and memory grow in proportion to the length of a text.
"""

from __future__ import annotations

import base64
import sys
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicator_lake.llm.memory import tidy

REMEMBERED_BYTES = 96 << 20
ENTRY_BYTES = 200  # of a remembered match besides its characters and ids
LONGEST_REMEMBERED = 100  # characters of a match and bytes of its ids
SLICE_CHARS = 1 << 20  # a long text is split in slices of about this size
OUTPUT_BYTES = 4 << 20
MOST_PAIRS = 1 << 19  # remembered answers whether two tokens can stand next to each other
_PAIR_BITS = 24
_NONE = -1
#: A match of the pattern never runs from other characters into white space, so a text may be cut there.
_CUT = regex.compile(r"(?<=\S)(?=\s)")


def read_ranks(lines: Iterator[str]) -> dict[bytes, int]:
    """Token bytes and their ranks from lines of base64 bytes and rank."""
    pairs = (line.split() for line in lines if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def _last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two tokens whose merge makes ``token`` in the end; None when merging its bytes ends otherwise."""
    parts, pair = [token[i : i + 1] for i in range(len(token))], None
    while len(parts) > 1:
        options = [(ranks[both], i) for i in range(len(parts) - 1) if (both := parts[i] + parts[i + 1]) in ranks]
        if not options:
            return None
        rank, i = min(options)
        if rank > ranks[token]:
            raise ValueError("a token is made through one of a higher rank; such ranks are not a list of merges")
        pair = (parts[i], parts[i + 1])
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return pair


class Vocabulary:
    """Ranked tokens with what the table of prefixes asks of them."""

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every single byte must be a token")
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.size = {rank: len(token) for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self._left: dict[int, int] = {}
        self._right: dict[int, int] = {}
        self._joined: dict[tuple[int, int], int] = {}
        self._standing: dict[int, bool] = {}
        self._matches = ahocorasick.Automaton()
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self._joined[left, right] = rank
            pair = _last_merge(token, ranks) if len(token) > 1 else None
            if pair:
                self._left[rank], self._right[rank] = ranks[pair[0]], ranks[pair[1]]
            if pair or len(token) == 1:  # other tokens only ever stand for a whole match
                self._matches.add_word(token.decode("latin-1"), (rank, len(token)))
        self._matches.make_automaton()
        self.whole = {token.decode("latin-1"): rank for token, rank in ranks.items()}

    def _stands(self, left: int, right: int) -> bool:
        if (left, right) in self._joined:
            return False
        while True:
            # the newer of the two was made last; of two equal tokens the left one was made first
            undo_left = left > right
            older = self._right.get(left) if undo_left else self._left.get(right)
            if older is None:  # a single byte; then the other one is undone
                undo_left = not undo_left
                older = self._right.get(left) if undo_left else self._left.get(right)
                if older is None:
                    return True
            made = left if undo_left else right
            left, right = (older, right) if undo_left else (left, older)
            joined = self._joined.get((left, right))
            if joined is not None and (joined < made or (joined == made and not undo_left)):
                return False

    def stands(self, left: int, right: int) -> bool:
        """Whether the encoding of the two tokens' bytes is these two tokens."""
        pair = left << _PAIR_BITS | right
        found = self._standing.get(pair)
        if found is None:
            if len(self._standing) > MOST_PAIRS:
                self._standing.clear()
            found = self._standing[pair] = self._stands(left, right)
        return found

    def ending(self, data: bytes) -> Iterator[tuple[int, tuple[int, int]]]:
        """(index of the last byte, (token, length)) of every match, by index, longest first."""
        return self._matches.iter(data.decode("latin-1"))

    def encode(self, data: str) -> array:
        """Tokens of bytes given as a string of characters below 256, by the table of prefixes without keeping it."""
        last: list[int | None] = [None] * (len(data) + 1)
        standing, stands = self._standing.get, self.stands
        for end, (token, length) in self._matches.iter(data):
            end += 1
            if last[end] is None:
                start = end - length
                if start:
                    before = last[start]
                    fits = standing(before << _PAIR_BITS | token)
                    if fits is None:
                        fits = stands(before, token)
                    if not fits:
                        continue
                last[end] = token
        found, end, size = array("I"), len(data), self.size
        while end:
            token = last[end]
            found.append(token)
            end -= size[token]
        found.reverse()
        return found


class Prefixes:
    """The last token of every prefix of a byte string."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data = vocabulary, b""
        self.last = array("i", [_NONE])
        if data:
            self.append(data)

    def append(self, more: bytes) -> None:
        """Add bytes at the end; no entry found so far changes."""
        known = len(self.data)
        self.data += more
        if more:
            self._find(known)

    def _find(self, known: int, again: array | None = None, clear: int = 0) -> None:
        """Entries from known + 1 on. ``again`` holds the entries of the same bytes from place ``clear`` on."""
        vocabulary, last, same = self.vocabulary, self.last, 0
        stands = vocabulary.stands
        begin = max(0, known - vocabulary.longest + 1)
        for at, (token, length) in vocabulary.ending(self.data[begin:]):
            end = begin + at + 1
            if end < len(last):
                continue  # known before, or found already by a longer match
            start = end - length
            if start and not stands(last[start], token):
                continue
            last.append(token)
            if again is not None and end > clear:
                same = same + 1 if again[end - clear] == token else 0
                if same > vocabulary.longest:  # all that the next entries depend on is as it was
                    last.extend(again[end - clear + 1 :])
                    return

    def edited(self, start: int, stop: int, new: bytes) -> Prefixes:
        """The table after bytes start to stop have become ``new``; entries before and well behind are taken over."""
        out = Prefixes(self.vocabulary)
        out.data = self.data[:start] + new + self.data[stop:]
        out.last = self.last[: start + 1]
        out._find(start, self.last[stop:], start + len(new))
        return out

    def ids(self) -> list[int]:
        found, end = [], len(self.data)
        size = self.vocabulary.size
        while end:
            found.append(self.last[end])
            end -= size[found[-1]]
        found.reverse()
        return found


class Encoder(dict):
    """Encodings of matches as little-endian unsigned 32-bit ids; a missing one is found and, if short, remembered.

    When half of ``REMEMBERED_BYTES`` is full, the encodings in it become the older half and those of the older
    half that were not asked for since go, so frequent matches stay.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        super().__init__()
        self.vocabulary, self.pattern, self.held = vocabulary, regex.compile(pattern), 0
        self.older: dict[str, bytes] = {}

    def __missing__(self, match: str) -> bytes:
        packed = self.older.get(match)
        if packed is None:
            data = match if match.isascii() else match.encode().decode("latin-1")
            whole = self.vocabulary.whole.get(data)
            ids = self.vocabulary.encode(data) if whole is None else array("I", (whole,))
            if sys.byteorder == "big":
                ids.byteswap()
            packed = ids.tobytes()
        size = len(match) + len(packed)
        if size <= LONGEST_REMEMBERED:
            self.held += size + ENTRY_BYTES
            if 2 * self.held > REMEMBERED_BYTES:
                self.older = dict(self)
                self.clear()
                self.held = size + ENTRY_BYTES
            self[match] = packed
        return packed

    def encode(self, text: str) -> bytes:
        return b"".join(b"".join(map(self.__getitem__, self.pattern.findall(part))) for part in slices(text))


def slices(text: str, size: int = SLICE_CHARS) -> Iterator[str]:
    """The text in parts of about ``size`` characters, cut where no match of the pattern can run across."""
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


class EncodedText:
    """A text with the encoding of each match, kept exact through appends and edits.

    A match depends on the text from its start to at most ``REACH`` characters behind its end, so only matches near
    an edit are looked for again, until one begins where one began before.
    """

    REACH = 3

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder, self.text = encoder, ""
        self.starts: list[int] = []
        self.packed: list[bytes] = []
        self.replace(0, 0, text)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, new: str) -> int:
        """Put ``new`` in place of characters start to stop; returns how many matches were encoded again."""
        shift = len(new) - (stop - start)
        first = max(0, bisect_right(self.starts, start - self.REACH) - 2)
        begin = self.starts[first] if self.starts else 0
        self.text = self.text[:start] + new + self.text[stop:]
        starts, packed, after = [], [], len(self.starts)
        for match in self.encoder.pattern.finditer(self.text, begin):
            if match.start() >= start + len(new):
                old = bisect_left(self.starts, match.start() - shift)
                if old < len(self.starts) and self.starts[old] == match.start() - shift:
                    after = old
                    break
            starts.append(match.start())
            packed.append(self.encoder[match[0]])
        self.starts[first:] = starts + [s + shift for s in self.starts[after:]]
        self.packed[first:] = packed + self.packed[after:]
        return len(starts)

    def ids(self) -> list[int]:
        return np.frombuffer(b"".join(self.packed), "<u4").tolist()


@lru_cache(maxsize=4)
def _vocabulary(lines: tuple[str, ...]) -> Vocabulary:
    return Vocabulary(read_ranks(iter(lines)))


def rank_lines(path: str) -> tuple[str, ...]:
    """The lines of a rank file, read on the driver and sent with the job: executors need not see the file."""
    with open(path, encoding="ascii") as handle:
        return tuple(handle)


class _Shared:
    """One encoder a Python worker, kept between tasks."""

    made: dict[int, Encoder] = {}

    @classmethod
    def encoder(cls, sent, pattern: str) -> Encoder:
        key = hash((pattern, sent.value))
        if key not in cls.made:
            cls.made.clear()
            cls.made[key] = Encoder(_vocabulary(sent.value), pattern)
        return cls.made[key]


def _sent(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(rank_lines(path))  # one vocabulary file, whatever the input


def _added(df: DataFrame, name: str, source: str, row_bytes) -> DataFrame:
    """df with a binary column: ``row_bytes()`` gives the function from a batch's column to its values."""
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convert = row_bytes()
        for batch in batches:
            column, values, first, held = batch.column(batch.schema.get_field_index(source)), [], 0, 0
            for row in range(batch.num_rows):
                values.append(convert(column[row]))
                held += len(values[-1])
                if held >= OUTPUT_BYTES or row + 1 == batch.num_rows:
                    part = batch.slice(first, len(values))
                    arrays = [*part.columns, pa.array(values, pa.binary())]
                    yield pa.RecordBatch.from_arrays(arrays, [*part.schema.names, name])
                    values, first, held = [], row + 1, 0

    return df.mapInArrow(tidy(run), schema)


def encoded(docs: DataFrame, path: str, pattern: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """docs with the column ``ids``: the text's token ids as little-endian unsigned 32-bit integers.

    A null or empty text has no ids. Other columns, repeated rows and rows without an id pass through as they are.
    """
    sent = _sent(docs.sparkSession, path)

    def make():
        encoder = _Shared.encoder(sent, pattern)
        return lambda value: encoder.encode(value.as_py() or "")

    return _added(docs, ids, text, make)


def decoded(rows: DataFrame, path: str, ids: str = "ids", data: str = "decoded") -> DataFrame:
    """rows with the column ``data``: the bytes that the ids stand for; null ids give no bytes."""
    sent = _sent(rows.sparkSession, path)

    def make():
        bytes_of = {rank: token for token, rank in read_ranks(iter(sent.value)).items()}.__getitem__
        return lambda value: b"".join(map(bytes_of, np.frombuffer(value.as_py() or b"", "<u4").tolist()))

    return _added(rows, data, ids, make)


def round_trip_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of the ids and of the bytes they decode to, one row per row of docs.

    Only doc_id and text are read, whatever other columns there are.
    """
    rows = encoded(docs.select("doc_id", F.col("text").cast("string")), path, pattern)
    both = decoded(rows.drop("text"), path)
    return both.select(
        F.col("doc_id").cast("long"),
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
