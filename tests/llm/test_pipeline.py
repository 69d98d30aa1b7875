"""The pipeline's stages, each on what the one before it kept, against brute force."""

import random
import re
from collections import Counter

import public_tokenizers

import corpus_pipeline
from indicator_lake.llm import mixing, packing, quality

WORD = re.compile(r"[^\x20\x09-\x0d]+")
SECRET = re.compile(r"secret=[a-z0-9]{8,}")


def texts():
    rng = random.Random(21)
    word = lambda: rng.choice("river stone light house green".split()) + rng.choice("abcdefgh")
    rows = [(i, " ".join(word() for _ in range(60)), "abc"[i % 3]) for i in range(90)]
    rows += [(100 + i, rows[i][1], "b") for i in range(8)]  # exact copies
    rows += [(110 + i, rows[i + 20][1] + " end", "c") for i in range(8)]  # near copies
    rows += [(120 + i, rows[i + 40][1] + f" secret=abcdefgh{i} tail", "a") for i in range(4)]
    rows += [(130 + i, rows[i + 60][1][::-1] + f" secret=ijklmnop{i}", None) for i in range(4)]
    rows += [(140, None, "a"), (141, "", "a"), (142, "too short", "b"), (143, "again and " * 60, "c")]
    return rows


def shingles(text):
    words = WORD.findall(text.lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def smallest_of_each(rows):
    """Ids that are the smallest of their component, links by shingle sets."""
    sets, low = {i: shingles(t) for i, t in rows.items()}, {i: i for i in rows}
    pairs = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in rows:
        for a, b in pairs:
            low[a] = low[b] = min(low[a], low[b])
    return {i for i in rows if low[i] == i}


def test_stages_equal_brute_force(llm, documents, tmp_path):
    rows = texts()
    folder = str(tmp_path)
    documents(rows).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i in range(0, 90, 3)]
    llm.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")

    docs, after = llm.read.parquet(f"{folder}/documents.parquet"), []
    scores = {r.doc_id: r.score for r in quality.quality_rules(docs, llm.read.parquet(f"{folder}/labels.parquet")).collect()}
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        found = stage(llm, docs, folder)
        assert i == 4 or found.columns == docs.columns
        found.write.parquet(f"{folder}/stage{i}.parquet")
        docs = llm.read.parquet(f"{folder}/stage{i}.parquet")
        after.append(docs.collect())

    # quality rules: short, empty and repeating texts go, and what scores low
    given = {i: t for i, t, _ in rows}
    kept = {r.doc_id: r.text for r in after[0]}
    assert all(kept[i] == given[i] for i in kept)
    assert not {140, 141, 142, 143} & set(kept) and set(range(90)) <= set(kept)
    assert set(kept) == {i for i in given if i not in (140, 141, 142, 143) and scores[i] >= quality.THRESHOLD}

    # near-duplicates: the smallest id of each component stays
    one = {r.doc_id: r.text for r in after[1]}
    assert set(one) == smallest_of_each(kept) and set(range(90)) <= set(one) and not set(range(100, 118)) & set(one)

    # secrets: masked, nothing else changes
    assert {r.doc_id: r.text for r in after[2]} == {i: SECRET.sub("[SECRET]", t) for i, t in one.items()}

    # mixing: whole rows, as often as the target allows, near the target
    before, copies = {r.doc_id: r for r in after[2]}, Counter(r.doc_id for r in after[3])
    assert all(r == before[r.doc_id] for r in after[3])
    words = {i: len(WORD.findall(r.text)) for i, r in before.items()}
    aims = {r.source: r for r in mixing.targets(llm.createDataFrame([(r.source, words[i]) for i, r in before.items()], "source string, size long")).collect()}
    for source, aim in aims.items():
        own = [i for i, r in before.items() if r.source == source]
        assert all(int(aim.target / aim.source_size) <= copies[i] <= int(aim.target / aim.source_size) + 1 for i in own)
        assert abs(sum(copies[i] * words[i] for i in own) - aim.target) <= max(words[i] for i in own)

    # packing: every id of every copy once, sequences without gaps, full or of a power of two
    path = public_tokenizers.path("byte_bpe_50k.json")
    need, have = Counter(), Counter()
    for i, n in copies.items():
        need += Counter({(i, at): n for at in range(len(packing.encode(path, before[i].text)))})
    sequences = {}
    for r in after[4]:
        have += Counter({(r.doc_id, at): 1 for at in range(r.start, r.start + r.length)})
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert have == need
    for pieces in sequences.values():
        pieces.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:], strict=False)) and pieces[0][0] == 0
        total = sum(n for _, n in pieces)
        assert total <= 2048 and total & (total - 1) == 0

    whole = corpus_pipeline.run(llm, folder)
    assert sum(r.length for r in whole.collect()) == sum(need.values()) and whole.columns == docs.columns
