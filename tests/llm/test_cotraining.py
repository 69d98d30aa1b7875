"""Co-training: what the views hand to each other, and odd tables."""

import random

import numpy as np
import pytest

from indicator_lake.llm import cotraining


def exchange(llm, documents):
    """Labelled documents share no word with the others, whose words only the sources explain."""
    rng = random.Random(4)

    def text(kind, part):
        return " ".join(f"{part}{kind}{rng.randrange(12)}" if rng.random() < 0.7 else f"common{rng.randrange(30)}" for _ in range(30))

    rows = [(i, text(i % 2, "old" if i < 200 else "new"), f"s{i % 2}" if i < 700 else "other") for i in range(900)]
    labels = llm.createDataFrame([(i, i % 2, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    return documents(rows), labels


def test_metadata_teaches_the_text_view_new_words(llm, documents):
    docs, labels = exchange(llm, documents)
    unseen = {}
    for rounds in (0, 2):
        found = cotraining.quality_scores(docs, labels, rounds).where("doc_id >= 700").collect()  # their source says nothing
        unseen[rounds] = np.mean([(r.text_score > 0.5) == (r.doc_id % 2 == 1) for r in found])
    assert unseen[0] < 0.7 and unseen[2] > 0.95


def test_both_views_gain_examples_in_every_round(llm, documents):
    docs, labels = exchange(llm, documents)
    start, first, second = cotraining.co_train(docs, labels).examples
    assert start == (100, 100, 100, 100)
    for turn in (first, second):
        assert all(n > m for n, m in zip(turn, start, strict=True))
    assert cotraining.co_train(docs, labels, handed=0.0).examples[0] == start
    with pytest.raises(ValueError, match="half"):
        cotraining.co_train(docs, labels, handed=0.4)


def test_cuts_by_brute_force():
    rng = np.random.default_rng(3)
    places = rng.integers(900, 1100, 5_000)
    draws = rng.random(5_000)
    counts = np.bincount(places, minlength=cotraining.BINS).astype(float)
    labelled = np.bincount(rng.integers(900, 1000, 300), minlength=cotraining.BINS), np.bincount(rng.integers(1000, 1100, 600), minlength=cotraining.BINS)
    view = cotraining.View(np.zeros(1), slope=1e-3, base=2 / 3)
    cotraining._cuts(view, np.array([*labelled, counts]), 0.06)
    got = [view.sure_of(int(place), draw) for place, draw in zip(places, draws, strict=True)]
    # 0.06 * 5,000 documents, a third of them bad: all documents outside a cut's bin and a part of those in it
    for wanted, kind, order in ((200, 1, np.sort(places)[::-1]), (100, 0, np.sort(places))):
        edge = order[wanted - 1]
        beyond = places > edge if kind else places < edge
        assert all(got[i] == kind for i in np.flatnonzero(beyond))
        assert all((places[i] == edge) | beyond[i] for i in range(5_000) if got[i] == kind)
        assert abs(got.count(kind) - wanted) < 25
    cotraining._cuts(view, np.array([labelled[1], labelled[0], counts]), 0.06)  # tails of the wrong class stay
    assert view.sure_of(0, 0.0) is None and view.sure_of(cotraining.BINS - 1, 0.0) is None
    view.slope = 0.0
    cotraining._cuts(view, np.array([*labelled, counts]), 0.06)
    assert (view.low, view.high) == (cotraining.View.low, cotraining.View.high)


def test_repeated_rows_conflicting_labels_and_long_texts(llm, documents):
    long = "word " * 200_000
    rows = [(1, "a b", "s"), (1, "a b", "s"), (2, long, None), (3, "", "s"), (4, None, None), (None, "a b", "s")]
    marks = [(1, 1, 0), (1, 1, 0), (2, 1, 0), (2, 0, 0), (3, None, None), (None, 1, 0), (77, 0, 0)]
    labels = llm.createDataFrame(marks, "doc_id long, quality int, toxic int")
    found = cotraining.quality_scores(documents(rows), labels).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert len({(r.score, r.kept) for r in found if r.doc_id in (1, None)}) == 1
    # doc 2 has one label that says 0, so it is bad; doc 1 has two rows, both good
    assert cotraining.co_train(documents(rows), labels, 0).examples == [(1, 2, 1, 2)]


def test_reruns_agree(llm, documents):
    docs, labels = exchange(llm, documents)
    one, two = (sorted(map(str, cotraining.quality_scores(docs.repartition(n), labels).collect())) for n in (2, 5))
    assert one == two
