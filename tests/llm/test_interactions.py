"""The filter interaction audit against counting document by document."""

import random
from itertools import permutations

import pytest

from indicator_lake.llm import interactions

LABELS = "doc_id long, quality int, toxic int, part string, state int"


def brute(rows, labels):
    """rows of (doc_id, text, lang)."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out = {}
    for part in {lang or "" for _, _, lang in rows}:
        states = []
        for i, text, lang in rows:
            if (lang or "") != part:
                continue
            text = text or ""
            for mark in "\t\n\x0b\x0c\r":
                text = text.replace(mark, " ")
            words = [w for w in text.split(" ") if w]
            body = next(t for j, t, _ in rows if j == i and (t or "").translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}) == text) or ""
            fails = {
                "A": len(words) < 200,
                "B": 100 * len(set(words)) < 50 * len(words),
                "C": 100 * sum("A" <= c <= "Z" for c in body) > 3 * len(body),
                "D": any(c in "#$%&*|" for c in body),
                "E": i is not None and i > least[body],
            }
            states.append(({k for k, v in fails.items() if v}, i in good, i in toxic))
        removed_by = dict.fromkeys("ABCDE", 0)
        rows_of = []
        for order in map("".join, permutations("ABCDE")):
            for step, name in enumerate(order, 1):
                before = set(order[: step - 1])
                kept = sum(not f & (before | {name}) for f, _, _ in states)
                lost = [(g, t) for f, g, t in states if name in f and not f & before]
                again = sum(name in f and bool(f & before) for f, _, _ in states)
                alone = sum(f == {name} for f, _, _ in states)
                removed_by[name] += len(lost)
                rows_of.append((part, order, step, kept, len(lost), again, alone, sum(g for g, _ in lost), sum(t for _, t in lost), name))
        for *values, name in rows_of:
            out[tuple(values[:3])] = (*values[3:], removed_by[name])
    return out


def found(docs, labels):
    return {tuple(r)[:3]: tuple(r)[3:] for r in interactions.audit(docs, labels).collect()}


def table(llm, rows):
    # extra columns bear names that the operator uses inside
    full = [(i, t, lang, "x", 1, b"y", "z") for i, t, lang in rows]
    return llm.createDataFrame(full, "doc_id long, text string, lang string, part string, state int, content binary, bits string")


def test_audit_equals_brute_force(llm):
    rng = random.Random(5)
    texts = [None, "", "  \n ", "A#", "word " * 250, " ".join(f"w{i}" for i in range(230)), "é" * 50 + " AB", "x\x0by\x1cz " * 90]
    texts += [" ".join(rng.choice(["Ab", "c", "d*", "e", "FG", f"q{j}"]) for j in range(rng.randint(150, 260))) for _ in range(12)]
    rows = [(rng.randint(1, 60), rng.choice(texts), rng.choice(["en", "de", None, ""])) for _ in range(140)]
    rows += [rows[0]] * 3 + [(None, texts[4], "en"), (None, None, None)]
    rows = [(i, t, lang) for i, t, lang in rows]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(1, 60, 2)] + [(3, 1, 1), (3, 0, 0), (None, 1, 1)]
    marked = llm.createDataFrame([(*x, "p", 1) for x in labels], LABELS)
    assert found(table(llm, rows).repartition(5), marked) == brute(rows, [x for x in labels if x[0] is not None])


def test_audit_of_empty_tables(llm):
    labels = llm.createDataFrame([], LABELS)
    assert found(table(llm, []), labels) == {}
    one = found(table(llm, [(1, None, None)]), labels)
    assert len(one) == 600 and one["", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)


def test_words_of_a_long_text_are_counted_across_slices(monkeypatch):
    text = " ".join(f"w{i % 700}" for i in range(3000))
    whole = interactions.failed_filters(text)
    monkeypatch.setattr(interactions, "SLICE", 64)
    assert interactions.failed_filters(text) == whole == 2
    assert interactions.failed_filters("x" * 500) == 1


def test_fields_hold_large_counts_and_overflow_is_an_error():
    state, many = 0b11 | interactions.GOOD, (1 << interactions.WIDTH) - 1
    rows = {(r[0], r[1]): r[2:] for r in interactions.unpacked(interactions.packed_state(state) * many)}
    assert rows["ABCDE", 1] == (0, many, 0, 0, many, 0, 60 * many)
    assert rows["ABCDE", 2] == (0, 0, many, 0, 0, 0, 60 * many)
    with pytest.raises(OverflowError):
        interactions.unpacked(interactions.packed_state(0) * (many + 1))
