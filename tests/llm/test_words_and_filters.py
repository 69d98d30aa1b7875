"""Word hashing, quality rules, token counts, co-training."""

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from indicator_lake.llm import cotraining, quality, token_counts
from indicator_lake.llm.words import sliced, windows

WORD = re.compile(r"[^\x20\x09-\x0d]+")
ODD = ["", None, " \t\n", "one", "Élan  vital ça\tva\x0bA B", "x" * 700_000, "a b " * 200_000, "é ü   z", "l\n\nl\n l\nl\r\n"]


def test_words_are_cut_as_the_pattern_says():
    place = 0
    for row, texts in sliced(pa.array(ODD)):
        for i in range(texts.n):
            begin, end = texts.bounds[i], texts.bounds[i + 1]
            found = [bytes(texts.data[a:b]).decode() for a, b in zip(texts.starts[begin:end], texts.ends[begin:end])]
            assert found == WORD.findall(ODD[row + i] or "")
            place += 1
    assert place == len(ODD)


def test_hashes_depend_on_the_bytes_alone():
    (_, one), (_, two) = next(sliced(pa.array(["aa bb cc", "x aa"]))), next(sliced(pa.array(["yy", "AA bb"])))
    first, second = one.word_hashes(), two.word_hashes(lower=True)
    assert first[0] == first[4] == second[1] and first[1] == second[2] and first[0] != first[1]
    assert len(windows(first, 6)) == 0 and len(windows(first, 2)) == 4


def base_counts(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, covered = Counter(runs), set()
    for i, run in enumerate(runs):
        if often[run] > 1:
            covered |= set(range(i, i + 8))
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_base_counts_equal_brute_force(llm, documents):
    rng = random.Random(3)
    texts = ODD[:5] + ODD[7:] + [" ".join(rng.choice("ab cd e# é\n |".split(" ")) for _ in range(rng.randint(0, 90))) for _ in range(150)]
    docs = documents(list(enumerate(texts)) + [(None, "no id"), (3, "again")])
    labels = llm.createDataFrame([(10, 1, 0), (11, 0, 0), (12, 1, 0), (12, 1, None)], "doc_id long, quality int, toxic int")
    rows = quality.quality_rules(docs, labels).collect()
    assert len(rows) == len(texts) + 2
    for row in rows:
        if row.doc_id is None or (row.doc_id == 3 and row.n_words == 1):
            continue
        found = row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words
        assert found == base_counts(texts[row.doc_id])
        failed = found[0] < 20 or 100 * found[4] > 30 * found[0]
        assert row.base_failed == failed and row.kept == (not failed and row.score >= quality.THRESHOLD)


def test_quality_ratio_keeps_clean_and_rejects_noise(llm, documents):
    rng = random.Random(5)
    clean = [" ".join(rng.choice(["the", "of", "and", "to", "in"]) + rng.choice("abcdefgh") for _ in range(120)) for _ in range(200)]
    noise = [" ".join(f"{rng.choice('QWERTZ')}{rng.choice('xyz')}!!" for _ in range(120)) for _ in range(40)]
    docs = documents(list(enumerate(clean + noise)))
    labels = llm.createDataFrame([(i, 1, 0) for i in range(100)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in quality.quality_rules(docs, labels).collect()}
    assert all(rows[i].score > quality.THRESHOLD for i in range(200))
    assert all(rows[i].score < quality.THRESHOLD for i in range(200, 240))
    kept = quality.passing(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i in rows if rows[i].kept}


def test_quality_verdicts_do_not_depend_on_the_table_size(llm, documents):
    rng = random.Random(8)
    clean = lambda: rng.choice(["the", "of", "and", "to", "in"]) + rng.choice("abcdefgh")
    noise = lambda: f"{rng.choice('QWERTZ')}{rng.choice('xyz')}!!"
    texts = [" ".join(noise() if rng.random() < share else clean() for _ in range(60)) for share in [0] * 50 + [0.2] * 10 + [0.6] * 20]
    marks = [(i, int(i < 50), 0) for i in range(0, 80, 2) if not 50 <= i < 60]
    found = []
    for times in (1, 100):
        docs = documents([(100 * i + k, t) for i, t in enumerate(texts) for k in range(times)])
        labels = llm.createDataFrame([(100 * i + k, q, t) for i, q, t in marks for k in range(times)], "doc_id long, quality int, toxic int")
        rows = quality.quality_rules(docs, labels).collect()
        found.append({(r.doc_id // 100, r.kept, round(r.score, 5)) for r in rows})
        kept = {i for i, k, _ in found[-1] if k}
        assert len(found[-1]) == len(texts) and kept >= set(range(50)) and not kept & set(range(60, 80))
        assert {r.doc_id for r in quality.passing(docs, labels).collect()} == {r.doc_id for r in rows if r.kept}
    assert found[0] == found[1]


def test_quality_cut_is_the_best_of_all_labelled_scores():
    rng = random.Random(4)
    for _ in range(50):
        steps = [(s, rng.randint(0, 4), rng.randint(0, 4)) for s in rng.sample(range(-40, 40), 12)]
        good, bad = sum(s[1] for s in steps), sum(s[2] for s in steps)
        worth = lambda cut: sum(g for s, g, _ in steps if s / quality.STEPS >= cut) * bad + sum(b for s, _, b in steps if s / quality.STEPS < cut) * good  # noqa: E731, B023
        assert worth(quality.best_cut(steps)) == max(worth(s / quality.STEPS) for s in range(-41, 42))
    assert quality.best_cut([(0, 3, 0)]) is None and quality.best_cut([]) is None


def test_quality_of_empty_tables(llm, documents):
    labels = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.quality_rules(documents([]), labels).count() == 0
    (row,) = quality.quality_rules(documents([(1, None)]), labels).collect()
    assert (row.n_words, row.base_failed, row.kept, row.score) == (0, True, False, 0.0)


def test_quality_of_slices_of_empty_texts(llm, documents):
    labels = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [(i, "") for i in range(8)] + [(8, "some words of a text\nsome words of a text"), (9, "x" * 700_000), (10, ""), (11, None)]
    for table in (documents(rows).repartition(4), documents(rows).coalesce(1)):
        found = {r.doc_id: (r.n_words, r.n_dup_lines) for r in quality.quality_rules(table, labels).collect()}
        assert found == {**dict.fromkeys(range(8), (0, 0)), 8: (10, 1), 9: (1, 0), 10: (0, 0), 11: (0, 0)}
        assert quality.passing(table, labels).count() == 0


def whole(vocabulary, by_bytes):
    from tokenizers import Tokenizer, models

    return Tokenizer(models.Unigram(vocabulary, 0, by_bytes))


def test_token_counts_equal_the_library_on_ties():
    rng = random.Random(1)
    pieces = ["a", "b", "ab", "ba", "aba", "bab", "c", "abc", "▁", "▁a", "b▁", "▁ab", "cc", "aa", "aab", "abab"]
    vocabulary = [("<unk>", 0.0)] + [(p, -rng.randint(1, 8) / 4) for p in pieces]
    library, own = whole(vocabulary, False), token_counts.Unigram(vocabulary, 0, False)
    for _ in range(800):
        text = "".join(rng.choice("abc▁dé") for _ in range(rng.randint(0, 40)))
        assert own.count(text) == len(library.encode(text).ids), text


def test_token_counts_equal_the_library_on_a_real_vocabulary(llm, documents):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = whole(list(token_counts.load_pieces(path)), True)
    rng = random.Random(2)
    texts = ["", None, " ", "a  b", "日本語 <s> <unk> x", "thththand " * 50] + [
        "".join(rng.choice(["the ", "an", "▁", "\n", "ß", "日", " "]) for _ in range(60)) for _ in range(60)
    ]
    rows = token_counts.token_counts(documents(list(enumerate(texts)) + [(None, "x")]), path).collect()
    assert len(rows) == len(texts) + 1
    for row in rows:
        if row.doc_id is not None:
            assert row.n_tokens == len(library.encode(token_counts.marked(texts[row.doc_id])).ids)


def test_cotraining_finds_held_out_quality(llm, documents):
    rng = random.Random(9)
    good = lambda: " ".join(rng.choice(["river", "stone", "light", "house", "green"]) + rng.choice("abcd") for _ in range(40))
    bad = lambda: " ".join(rng.choice(["$$", "win", "click", "!!!"]) + rng.choice("abcd") for _ in range(40))
    rows = [(i, good() if i % 3 else bad(), f"s{i % 3 > 0}") for i in range(600)] + [(600, None, None), (601, "", "s0"), (None, good(), "s1")]
    labels = llm.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(150)], "doc_id long, quality int, toxic int")
    found = cotraining.quality_scores(documents(rows), labels).collect()
    assert len(found) == len(rows)
    held = [r for r in found if r.doc_id is not None and 150 <= r.doc_id < 600]
    assert np.mean([r.kept == (r.doc_id % 3 > 0) for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_cotraining_without_labels(llm, documents):
    labels = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    (row,) = cotraining.quality_scores(documents([(1, "some words")]), labels).collect()
    assert row.score == pytest.approx(0.5)
    assert cotraining.quality_scores(documents([]), labels).count() == 0


def test_token_counts_of_empty_tables_and_long_texts(llm, documents, monkeypatch):
    path = public_tokenizers.path("piece_bpe_32k.model")
    assert token_counts.token_counts(documents([]), path).count() == 0
    long = "x" * 200_000 + "日本" * 20_000
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, "a b")]
    library = whole(list(token_counts.load_pieces(path)), True)
    found = sorted((r.doc_id or 0, r.n_tokens) for r in token_counts.token_counts(documents(rows), path).collect())
    expected = [(i or 0, len(library.encode(token_counts.marked(t)).ids)) for i, t in rows]
    assert found == sorted(expected)
    counter = token_counts.Unigram(list(token_counts.load_pieces(path)))
    monkeypatch.setattr(token_counts, "REMEMBERED_BYTES", 2_000)
    assert [counter.count(f"▁word{i}▁two") for i in range(40)] == [token_counts.Unigram.pieces_of(counter, f"▁word{i}▁two") for i in range(40)]
    assert counter.held <= 2_000 and len(counter.known) < 14
