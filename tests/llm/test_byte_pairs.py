"""Prefix tables against tiktoken: encoding, appends, edits, decoding."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from indicator_lake.llm import byte_pairs

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BITS = ["a", "b", "th", "e", " ", "  ", "\n", "'s", "'", "'re", "é", "日", "本", "0", "12", "!", "\t", "ing", "ão", "Ж", "ط", "　", "aaaa", "....", "\x1c", "🙂", "\x85"]


@pytest.fixture(scope="module")
def vocabulary():
    return byte_pairs.Vocabulary(byte_pairs.read_ranks(iter(byte_pairs.rank_lines(PATH))))


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


@pytest.fixture()
def encoder(vocabulary):
    return byte_pairs.Encoder(vocabulary, public_tokenizers.PATTERN)


def text_of(rng, n):
    return "".join(rng.choice(BITS) for _ in range(rng.randint(0, n)))


def unpack(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_texts_encode_as_the_library_does(encoder, library):
    rng = random.Random(1)
    for _ in range(1500):
        text = text_of(rng, 60)
        assert unpack(encoder.encode(text)) == library.encode_ordinary(text), text


def test_every_character_splits_as_in_the_library(encoder, library):
    for code in range(0, 0x110000, 7):
        if not 0xD800 <= code < 0xE000:
            text = f"a{chr(code)}b1 {chr(code)}{chr(code)} x"
            assert unpack(encoder.encode(text)) == library.encode_ordinary(text), hex(code)


def test_appends_and_edits_of_bytes_are_exact(vocabulary, library):
    rng = random.Random(2)
    alphabet = b"ab etinosr\x80\xc3\xa9"
    for _ in range(400):
        data = bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 200)))
        table = byte_pairs.Prefixes(vocabulary)
        cuts = sorted(rng.randint(0, len(data)) for _ in range(4))
        for a, b in zip([0, *cuts], [*cuts, len(data)], strict=True):
            table.append(data[a:b])
        assert table.ids() == library._encode_single_piece(data)
        start = rng.randint(0, len(data))
        stop = rng.randint(start, len(data))
        new = bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 9)))
        after = table.edited(start, stop, new)
        whole = byte_pairs.Prefixes(vocabulary, data[:start] + new + data[stop:])
        assert after.data == whole.data and after.last == whole.last
        for end in (start, len(whole.data)):  # the same table encodes every prefix
            assert whole.last[end] == (library._encode_single_piece(whole.data[:end])[-1] if end else -1)


def test_an_edit_finds_few_entries_again(vocabulary, monkeypatch):
    data = ("abcdefgh" * 3000).encode()
    table, asked = byte_pairs.Prefixes(vocabulary, data), []
    stands = vocabulary.stands
    monkeypatch.setattr(vocabulary, "stands", lambda a, b: asked.append(1) or stands(a, b))
    table.edited(12_000, 12_001, b"zz")
    assert len(asked) < 1000


def test_edits_of_texts_are_exact_and_near(encoder, library):
    rng = random.Random(4)
    for _ in range(500):
        kept = byte_pairs.EncodedText(encoder, text_of(rng, 60))
        for _ in range(4):
            start = rng.randint(0, len(kept.text))
            kept.replace(start, rng.randint(start, min(len(kept.text), start + 6)), text_of(rng, 4))
            assert kept.ids() == library.encode_ordinary(kept.text), kept.text
        kept.append(text_of(rng, 5))
        assert kept.ids() == library.encode_ordinary(kept.text), kept.text
    long = byte_pairs.EncodedText(encoder, "some words and more of them. " * 2000)
    assert long.replace(30_000, 30_001, "zz") < 12


def test_long_texts_are_split_where_matches_end(encoder, library, monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(byte_pairs, "SLICE_CHARS", 5)
    for _ in range(300):
        text = text_of(rng, 60)
        assert list(byte_pairs.slices(text, 5)) and "".join(byte_pairs.slices(text, 5)) == text
        packed = b"".join(b"".join(map(encoder.__getitem__, encoder.pattern.findall(p))) for p in byte_pairs.slices(text, 5))
        assert unpack(packed) == library.encode_ordinary(text), text


def test_one_long_match_takes_linear_time(encoder, library):
    text = "ab" * 100_000
    assert library.decode(unpack(encoder.encode(text))) == text


def test_a_token_that_merging_never_makes_stands_for_a_whole_match_only():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bcd": 257}
    own = byte_pairs.Encoder(byte_pairs.Vocabulary(ranks), public_tokenizers.PATTERN)
    theirs = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("bcd", "abcd", "bcdbcd", "ab bcd", "bcdab"):
        assert unpack(own.encode(text)) == theirs.encode_ordinary(text), text


def test_remembered_encodings_are_bounded(encoder, monkeypatch):
    monkeypatch.setattr(byte_pairs, "REMEMBERED_BYTES", 5_000)
    for i in range(500):
        first, last = encoder["often"], encoder[f"word{i}"]
        assert 2 * encoder.held <= 5_000 and len(encoder) + len(encoder.older) < 25
        assert encoder["often"] == first and encoder[f"word{i}"] == last
    encoder["x" * 1000]
    assert "x" * 1000 not in encoder


def test_digests_of_rows(llm, documents, library):
    rows = [(1, "Hello  wörld's"), (1, "Hello  wörld's"), (2, None), (3, ""), (None, "a\n\nb"), (4, "x y " * 50_000)]
    found = byte_pairs.round_trip_digests(documents(rows), PATH, public_tokenizers.PATTERN).collect()
    expected = []
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        expected.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    empty = byte_pairs.round_trip_digests(documents([]), PATH, public_tokenizers.PATTERN)
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_other_columns_stay(llm, documents):
    rows = byte_pairs.encoded(documents([(7, "one two")]), PATH, public_tokenizers.PATTERN, ids="packed_ids")
    back = byte_pairs.decoded(rows, PATH, ids="packed_ids").first()
    assert (back.doc_id, back.blob, bytes(back.decoded)) == (7, "x", b"one two")
