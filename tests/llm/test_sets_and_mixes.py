"""Jaccard join, vector near-duplicates, secret scan, mixing and packing against brute force."""

import hashlib
import random
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from indicator_lake.llm import embeddings, jaccard, mixing, packing, secrets
from indicator_lake.llm.tables import components

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Joined:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, n):
        while self.up[n] != n:
            self.up[n] = self.up[self.up[n]]
            n = self.up[n]
        return n

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def similar(rows):
    """doc_id -> (size of its set, component) by comparing all pairs."""
    sets, groups = [(i, shingles(t)) for i, t in rows], Joined([i for i, _ in rows])
    for x, (i, one) in enumerate(sets):
        for j, two in sets[x + 1 :]:
            if one and two and 100 * len(one & two) >= 80 * len(one | two):
                groups.join(i, j)
    return {i: (len(s), groups.find(i)) for i, s in sets}


def near_copies(rng, n):
    rows, vocabulary = [], [f"w{i}" for i in range(60)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    while len(rows) < n:
        words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 80))]
        if rng.random() < 0.3:
            words = words[:20] + passage
        for _ in range(rng.choice([1, 1, 2, 5])):
            copy = list(words)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy) if rng.random() < 0.8 else "\n".join(copy).upper()))
    return rows


def test_jaccard_components_equal_brute_force(documents):
    rows = near_copies(random.Random(11), 260) + [(9000, None), (9001, ""), (9002, " \n"), (9003, "one"), (9004, "ONE"), (9005, "one two")]
    found = jaccard.similarity_components(documents([*rows, (None, "one")])).collect()
    expected = similar(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found if r.doc_id is not None} == expected
    assert [(r.n_shingles, r.component_id) for r in found if r.doc_id is None] == [(1, None)]
    assert len(found) == len(rows) + 1


def test_jaccard_threshold_is_met_exactly(documents):
    words = [f"w{i}" for i in range(13)]  # 9 shingles
    rows = [(5, " ".join(words)), (3, " ".join(words[:12])), (4, " ".join(words[:11] + ["x", "y"])), (1, " ".join(words[:10]))]
    found = {r.doc_id: r.component_id for r in jaccard.similarity_components(documents(rows)).collect()}
    assert found == {i: c for i, (_, c) in similar(rows).items()}


def test_repeated_ids_are_one_document(documents):
    text = " ".join(f"a{i}" for i in range(30))
    other = " ".join(f"b{i}" for i in range(30))
    rows = [(7, text), (7, other), (2, text), (9, other), (9, other)]
    found = jaccard.similarity_components(documents(rows)).collect()
    assert [r.component_id for r in found] == [2] * 5
    kept = jaccard.one_of_each(documents([*rows, (None, text)]))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "None"] and "blob" in kept.columns
    assert jaccard.similarity_components(documents([])).count() == 0


def test_components_of_chains_and_stars(llm):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(rng.randint(3000, 3100), rng.randint(3000, 3100)) for _ in range(60)]
    groups = Joined({n for pair in links for n in pair})
    for a, b in links:
        groups.join(a, b)
    found = {r.node: r.component for r in components(llm.createDataFrame(links, "a long, b long")).collect()}
    alone = {a for a, b in links if a == b} - {n for a, b in links if a != b for n in (a, b)}
    assert found == {n: groups.find(n) for n in groups.up if n not in alone}
    assert components(llm.createDataFrame([], "a long, b long")).count() == 0


def vectors(llm, rows):
    return llm.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, node string")


def test_vector_links_equal_brute_force(llm):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((60, 32))
    rows = [(i, (base[i % 60] + (rng.random() * 0.35) * rng.standard_normal(32)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(20)] + [(400, [2 * x for x in rows[1][1]])]
    odd = [(500, None), (501, []), (502, [0.0] * 32), (503, [float("nan")] * 32), (504, [1.0, None] + [0.0] * 30), (505, [1.0, 2.0]), (506, [float("inf")] * 32)]
    found = {r.vec_id: r for r in embeddings.near_duplicates(vectors(llm, rows + odd)).collect()}
    unit = np.array([v for _, v in rows], np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    links = unit @ unit.T >= 0.95
    np.fill_diagonal(links, False)
    recall = sum(found[i].n_links for i, _ in rows) / links.sum()
    assert 0.97 <= recall <= 1.0
    groups = Joined(range(len(rows)))
    for a, b in zip(*np.nonzero(links)):
        groups.join(int(a), int(b))
    # where every link was found components are exact; a missed link may split one but never merges two
    true, whole = [groups.find(x) for x in range(len(rows))], defaultdict(lambda: True)
    for x, (i, _) in enumerate(rows):
        whole[true[x]] &= found[i].n_links == links[x].sum()
    assert all(found[i].component_id == rows[true[x]][0] for x, (i, _) in enumerate(rows) if whole[true[x]])
    place = {i: x for x, (i, _) in enumerate(rows)}
    assert all(true[place[found[i].component_id]] == true[x] for x, (i, _) in enumerate(rows))
    assert sum(whole.values()) > 0.8 * len(whole)
    assert all((found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True) for i, _ in odd)
    assert len(found) == len(rows) + len(odd)
    assert embeddings.near_duplicates(vectors(llm, [])).count() == 0


def test_a_crowded_cell_is_split_and_loses_no_link(llm, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    rng = np.random.default_rng(2)
    rows = [(i, (np.ones(8) + 0.01 * rng.standard_normal(8)).tolist()) for i in range(150)] + [(200, None)]
    found = embeddings.near_duplicates(vectors(llm, rows)).collect()
    assert {(r.n_links, r.component_id) for r in found if r.vec_id < 200} == {(149, 0)}


def test_marks_lose_no_pair_that_the_projections_count():
    rng = np.random.default_rng(4)
    base = rng.standard_normal((40, 16))
    found = (base[:, None] + rng.random((40, 6, 1)) * 0.5 * rng.standard_normal((40, 6, 16))).reshape(-1, 16)
    found /= np.linalg.norm(found, axis=1)[:, None]
    half, least = embeddings.window(0.95, embeddings.RECALL)
    lines = embeddings.directions(embeddings.COUNTED, 16, embeddings.SEED + 2)
    values = (found @ lines.T).astype(np.float32)
    close = (np.abs(values[:, None] - values[None]) <= half).sum(2) >= least
    np.fill_diagonal(close, False)
    rows = [(i, 7, 0, low, high, i % 2, embeddings.marks_of(found[i : i + 1], embeddings.SEED)[0].tobytes())
            for low, high in ((0, 0), (0, 1), (1, 1)) for i in range(len(found)) if i % 2 in (low, high)]
    names = ["node", "cell", "t", "low", "high", "side", "mark"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)
    parts = [batch.slice(a, 50) for a in range(0, batch.num_rows, 50)]
    met = {i for part in embeddings._meeting(half, least)(iter(parts)) for i in part.column(0).to_pylist()}
    assert set(np.flatnonzero(close.any(1)).tolist()) <= met
    assert len(met) < len(found) or close.any(1).all()


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
BASE = (
    ("assign", ASSIGN, lambda m: len(m[2]) >= 8),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32),
)


def spans_of(text):
    hits = [(m.start(), i, m.end()) for i, (_, p, ok) in enumerate(BASE) for m in p.finditer(text or "") if ok(m)]
    return [f"{BASE[i][0]}:{a}:{b}" for a, i, b in sorted(hits)]


SECRETS = [
    None, "", "nothing here", "é password: token: abcdefgh1 AKIAAKIAAKIAZZZZ password=secret=abcdefgh1", "日" * 5 + "0" * 31 + " " + "f" * 32,
    'Token = "' + "a" * 40 + '" -----BEGIN RSA PRIVATE KEY-----', "apiKEY:12345678 AKIA0123456789AB" * 3, "AKIA0123456789A", "api-key=12345678",
    "x " * 50_000 + "secret=abcdefgh" + "0a" * 16, "paſſword=12345678 toKen=12345678",
]


def test_spans_equal_brute_force(documents):
    rng = random.Random(6)
    alphabet = ["password", "SECRET", "=", ": ", '"', "AKIA", "0", "a" * 9, "F9", "é", " ", "api_key", "token", "b1"]
    texts = SECRETS + ["".join(rng.choice(alphabet) for _ in range(30)) for _ in range(200)]
    found = secrets.digest(secrets.findings(documents([*enumerate(texts), (None, texts[3])]))).collect()
    assert len(found) == len(texts) + 1
    for row in found:
        expected = spans_of(texts[3 if row.doc_id is None else row.doc_id])
        assert [s for s in row.spans.split(",") if s and not s.startswith("keyblock")] == expected
        assert row.base_sha256 == hashlib.sha256(",".join(expected).encode()).hexdigest()
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(s.startswith(k + ":") for s in expected) for k, _, _ in BASE)
    assert secrets.findings(documents([])).count() == 0


def test_ledger_scans_only_unseen_blobs(llm, documents):
    first = documents([(1, "secret=abcdefgh"), (2, "plain")])
    ledger = secrets.new_entries(first)
    later = documents([(1, "secret=abcdefgh"), (3, "secret=abcdefgh"), (4, "token=ijklmnop"), (5, None)])
    assert secrets.new_entries(first, ledger).count() == 0
    new = secrets.new_entries(later, ledger)
    assert {r.blob for r in new.collect()} == {hashlib.sha256(t.encode()).hexdigest() for t in ("token=ijklmnop", "")}
    # an entry of older rules is no entry
    old = ledger.withColumn("rules_version", ledger["rules_version"].substr(1, 3))
    assert secrets.new_entries(first, old).count() == 2
    # a known blob's spans come from the ledger: mark them to see it
    marked = ledger.selectExpr("blob", "rules_version", "transform(spans, s -> struct(s.start + 100L as start, s.kind, s.end)) as spans")
    found = {r.doc_id: [s.start for s in r.spans] for r in secrets.findings(later, marked).collect()}
    assert found == {1: [100], 3: [100], 4: [0], 5: []}


def test_a_stored_ledger_serves_the_next_version_of_a_table(llm, documents, tmp_path):
    path = str(tmp_path / "ledger")
    first = documents([(1, "secret=abcdefgh"), (2, "plain"), (2, "plain")])
    assert secrets.record(first, path).count() == 2
    files = {p.name for p in (tmp_path / "ledger").glob("part-*")}
    assert secrets.record(first, path).count() == 2
    later = documents([(1, "secret=abcdefgh now"), (3, "secret=abcdefgh"), (4, None)])
    ledger = secrets.record(later, path)
    new = [str(p) for p in (tmp_path / "ledger").glob("part-*") if p.name not in files]
    assert llm.read.parquet(*new).count() == 2 and ledger.count() == 4  # only what was not seen before
    found = {r.doc_id: [s.start for s in r.spans] for r in secrets.findings(later, ledger, complete=True).collect()}
    assert found == {1: [0], 3: [0], 4: []}
    clean = secrets.without_secrets(later, ledger, complete=True).collect()
    assert {r.doc_id: r.text for r in clean} == {1: "[SECRET] now", 3: "[SECRET]", 4: None}
    assert secrets.record(documents([]), str(tmp_path / "none")).count() == 0


def test_masking_leaves_the_rest(documents):
    docs = documents([(1, "a secret=abcdefgh z"), (2, None), (3, "password=" + "0" * 40), (4, "plain")])
    clean = secrets.without_secrets(docs)
    assert clean.columns == docs.columns
    found = {r.doc_id: (r.text, r.n_chars) for r in clean.collect()}
    assert found == {1: ("a [SECRET] z", 12), 2: (None, 0), 3: ("[SECRET]", 8), 4: ("plain", 5)}


def aims(sizes):
    """Targets by pouring words until no source is above three times its size."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        target = {s: 3 * sizes[s] if s in full else left * weight[s] / share for s in names}
        above = {s for s in names if s not in full and target[s] > 3 * sizes[s]}
        if not above:
            return target
        full |= above


def test_mixture_meets_its_targets(documents):
    rng = random.Random(12)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), rng.choice(["b", "é", "Z", None, "a"] + ["big"] * 6)) for i in range(1500)]
    rows += [(5000, None, "a"), (5001, "w w", "tiny"), (5002, "w w", "tiny"), (5002, "w w", "tiny"), (None, "w w w", "a")]
    found = mixing.mixture(documents(rows)).collect()
    assert len(found) == len(rows)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    target, taken = aims(sizes), defaultdict(int)
    for row in found:
        assert row.source_size == sizes[row.source] and row.target == pytest.approx(target[row.source])
        rate = row.target / row.source_size
        assert row.taken == row.copies * row.size and int(rate) <= row.copies <= int(rate) + 1 and row.taken <= 3 * row.size
        taken[row.source] += row.taken
    for source in sizes:
        assert abs(taken[source] - target[source]) <= 31  # one document
    assert sorted(map(str, found)) == sorted(map(str, mixing.mixture(documents(rows[::-1])).collect()))
    assert {r.doc_id: r.taken for r in mixing.mixture(documents(rows), seed=5).collect()} != {r.doc_id: r.taken for r in found}


def test_pivotal_keeps_chances_and_the_sum(llm):
    rows = [("g", i, s, 10.0 + i % 7, (i % 10) / 10) for i in range(60) for s in (0,)]
    items = llm.createDataFrame(rows, "grp string, id long, tag long, size double, p double")
    ups = np.zeros(60)
    for seed in range(12):
        found = {r.id: r.up for r in mixing.pivotal(items, seed, block=8).collect()}
        assert len(found) == 60 and all(found[i] == 0 for i in range(0, 60, 10))
        assert abs(sum(found[i] * s for _, i, _, s, _ in rows) - sum(p * s for *_, s, p in rows)) <= 16
        ups += [found[i] for i in range(60)]
    by_chance = [ups[k::10].mean() / 12 for k in range(10)]
    assert all(abs(x - k / 10) < 0.2 for k, x in enumerate(by_chance))


def test_mixed_repeats_whole_rows(documents):
    docs = documents([(i, "w " * (i % 9), "a" if i % 4 else "b") for i in range(300)])
    copies = {r.doc_id: r.copies for r in mixing.mixture(docs).collect()}
    found = defaultdict(int)
    rows = mixing.mixed(docs)
    for row in rows.collect():
        found[row.doc_id] += 1
    assert rows.columns == docs.columns and found == {i: c for i, c in copies.items() if c}
    assert mixing.mixture(documents([])).count() == 0 and mixing.mixed(documents([])).count() == 0


PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_pieces_hold_every_id_once_without_padding(documents):
    from tokenizers import Tokenizer

    rng = random.Random(7)
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    texts = [None, "", " ", "<|endoftext|> x", "é日\n\n  tab\t", "word " * 30_000] + [
        " ".join(rng.choice(["the", "héllo", "123", "'s", "xyzzy"]) for _ in range(rng.choice([3, 300, 1500]))) for _ in range(120)
    ]
    rows = packing.packed(documents([*enumerate(texts), (5, "again"), (None, "none")]), PATH).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append(row)
        if row.doc_id is not None and not (row.doc_id == 5 and row.doc_tokens < 10):
            pieces[row.doc_id].append(row)
    for i, text in enumerate(texts):
        ids = np.array([*(tokenizer.encode(text, add_special_tokens=False).ids if text else []), 1], "<u4")
        at = 0
        for row in sorted(pieces[i], key=lambda r: r.start):
            assert row.start == at and row.length > 0 and row.doc_tokens == len(ids)
            assert row.ids_crc32 == zlib.crc32(ids[at : at + row.length].tobytes())
            at += row.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for row in sorted(parts, key=lambda r: r.offset):
            assert row.offset == at and row.sequence_length == sum(r.length for r in parts) == row.tier <= 2048
            at += row.length
        assert at & (at - 1) == 0  # nothing to pad
    assert packing.packed(documents([]), PATH).count() == 0


def test_queries_split_texts_at_added_tokens_as_the_library_does(llm, documents, tmp_path):
    from tokenizers import Tokenizer

    import corpus_pipeline
    from indicator_lake.llm import queries

    tokenizer = Tokenizer.from_file(PATH)
    mark = "<|endoftext|>"
    texts = [f"a {mark} b", mark * 3, f"it's {mark}  y\n{mark}\n ", mark[:-1], f"é  {mark[:-2]}{mark}", "plain  text ", f"{'word ' * 3000}{mark}"]
    documents(list(enumerate(texts))).write.parquet(f"{tmp_path}/documents.parquet")
    docs = llm.read.parquet(f"{tmp_path}/documents.parquet")
    for found in (queries.op1_packing(llm, str(tmp_path)), corpus_pipeline.packing_sequences(llm, docs, str(tmp_path))):
        rows = found.collect()
        for i, text in enumerate(texts):
            ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
            own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
            assert sum(r.length for r in own) == len(ids)
            for r in own:
                assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


def test_rests_of_one_length_fill_windows():
    rests = [(i, 0, 1100, bytes(4 * 1100)) for i in range(100)]
    full, left = packing.pack_rests(rests, 2048)
    assert all(sum(map(packing._size, w)) == tier == 2048 for tier, w in full)
    assert sum(map(packing._size, left)) == 100 * 1100 - 2048 * len(full) < 2048


def test_each_tier_packs_what_was_routed_to_it():
    rng = random.Random(3)
    sizes = [rng.choice([rng.randint(1, 60), rng.randint(65, 500), rng.randint(513, 1024), rng.randint(1025, 2047)]) for _ in range(900)]
    sizes += [900] * 400  # more than the gaps of longer tiers take
    rests = [(i, 0, n, bytes(4 * n)) for i, n in enumerate(sizes)]
    full, left = packing.pack_rests(rests, 2048)
    by_tier = defaultdict(list)
    for tier, window in full:
        assert sum(map(packing._size, window)) == tier
        by_tier[tier].append(window)
    assert {2048, 1024} <= set(by_tier) and len(by_tier[1024]) > 100
    for tier, windows in by_tier.items():  # each window is opened by a rest routed to its tier
        assert all(packing.tier_of(packing._size(w[0]), 2048) == tier for w in windows)
        longer = [p for w in windows for p in w[1:] if packing._size(p) > tier // 2]
        assert not longer or tier == packing.SHORTEST_TIER
    found = defaultdict(int)
    for window in [*(w for _, w in full), left]:
        for doc, _, _, ids in window:
            found[doc] += len(ids) // 4
    assert dict(found) == dict(enumerate(sizes))
    assert packing.tiers(2048) == [2048, 1024, 512, 256, 128, 64] and packing.tiers(16) == [16]


def test_step_groups_cost_alike(documents):
    docs = documents([(i, "the cat " * (20 + 37 * i % 900)) for i in range(400)])
    cost, size = defaultdict(int), defaultdict(set)
    for row in packing.packed(docs, PATH).where("sequence_length = 2048").collect():
        cost[row.step_group] += row.length**2
        size[row.step_group].add(row.sequence_id)
    means = [cost[g] / len(size[g]) for g in cost]
    assert len(means) > 1 and max(means) < 1.3 * min(means)


def test_private_keys_are_masked_whole(documents):
    rng = random.Random(6)
    line = lambda n=64: "".join(rng.choice("ABCDEFabcdefXYZxyz0189+/") for _ in range(n))
    head, foot = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    body = "\n".join(line() for _ in range(25)) + "\n" + line(30) + "=="
    texts = {
        f"é a {head}\n{body}\n{foot} z": "é a [SECRET] z",
        f"a {head}\n{body}\nThen some words.": "a [SECRET]\nThen some words.",
        f"{head}\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES\n\n{body}\n": "[SECRET]\n",
        f"{head}\n{body}\nb {head}\n{body}\n{foot}": "[SECRET]\nb [SECRET]",
        f"k='{head}\\n{line(200)}\\n{foot}'": "k='[SECRET]'",
        f"{head} is how a key starts": "[SECRET] is how a key starts",
        head + "\n" + "\n".join(line() for _ in range(20_000)): "[SECRET]",
    }
    rows = secrets.without_secrets(documents(list(enumerate(texts)))).collect()
    assert {r.doc_id: r.text for r in rows} == dict(enumerate(texts.values()))


def test_no_name_of_an_extra_column_clashes(documents):
    texts = ["a secret=abcdefgh z", None, "one two three", "one two three", ""]
    docs = documents([(i, t, "a") for i, t in enumerate(texts)])
    extra = "_blob _spans _clean _gone _id _tag _source _copies _copy tag origin copies gone spans clean id component_id a.b".split()
    docs = docs.withColumns({name: F.concat(F.lit(name), F.col("doc_id").cast("string")) for name in extra})
    clean = secrets.without_secrets(docs)
    assert clean.columns == docs.columns and clean.count() == 5
    for kept in (clean, jaccard.one_of_each(docs), mixing.mixed(docs)):
        assert kept.columns == docs.columns
        for row in kept.collect():
            assert all(row[name] == f"{name}{row.doc_id}" for name in extra)
    assert sorted(r.doc_id for r in jaccard.one_of_each(docs).collect()) == [0, 1, 2, 4]


def test_a_token_of_many_groups_keeps_every_link(documents):
    shared = " ".join(f"s{i}" for i in range(30))
    texts = [f"{shared} x{i}" for i in range(40)] + [f"{shared} " + " ".join(f"y{i}_{j}" for j in range(30)) for i in range(40)]
    found = {r.doc_id: r.component_id for r in jaccard.similarity_components(documents(list(enumerate(texts)))).collect()}
    assert found == {i: 0 if i < 40 else i for i in range(80)}


def test_many_equal_rows_are_mixed_one_by_one(llm, documents):
    words = "one two three four five six seven eight nine ten"
    rows = [(1, words, "a")] * 1000 + [(2 + i, " ".join(["w"] * (7 + i % 5)), "b") for i in range(300)]
    rows += [(900 + i, "x y z", "c") for i in range(2000)]
    docs = documents(rows).repartition(6)
    found = mixing.mixture(docs).collect()
    assert len(found) == len(rows)
    for source in "abc":
        own = [r for r in found if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
        assert all(r.taken <= 3 * r.size for r in own)
    kept = mixing.mixed(docs).groupBy("doc_id").count().collect()
    taken = {}
    for r in found:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.copies
    assert {r.doc_id: r["count"] for r in kept} == {i: n for i, n in taken.items() if n}


def test_an_id_with_three_texts_links_all_of_them(documents):
    one, two, three = (" ".join(f"{c}{i}" for i in range(30)) for c in "abc")
    rows = [(9, one), (9, two), (9, three), (1, one), (2, two), (3, three), (4, "else where no one links")]
    found = {r.doc_id: r.component_id for r in jaccard.similarity_components(documents(rows)).collect()}
    assert found == {9: 1, 1: 1, 2: 1, 3: 1, 4: 4}


N_HITS = 100_000


def test_very_many_hits_in_one_text_take_time_in_proportion(documents):
    line = "0123456789abcdef0123456789abcdef"
    text = "\n".join([line] * N_HITS)
    began = time.monotonic()
    (row,) = secrets.digest(secrets.findings(documents([(1, text)]))).select("n_hex", F.substring("spans", 1, 20).alias("head")).collect()
    assert (row.n_hex, row.head) == (N_HITS, "hex:0:32,hex:33:65,h")
    (clean,) = secrets.without_secrets(documents([(1, text)])).select("text").collect()
    assert clean.text == "\n".join([secrets.MASK] * N_HITS)
    assert time.monotonic() - began < 60


def test_masking_across_pieces_of_the_span_list(documents):
    rng = random.Random(8)
    parts = ["token=abcdefgh12345678", "deadbeef" * 5, "AKIA" + "A" * 16, "é word ", "secret: " + "0123456789abcdef" * 3, " plain ", "x"]
    text = " ".join(rng.choice(parts) for _ in range(3000))
    docs = documents([(1, text)])
    (found,) = secrets.findings(docs).collect()
    marks, last, expected = sorted((s.start, s.end) for s in found.spans), 0, []
    assert len(marks) > 2 * secrets.PIECE
    for start, end in marks:
        if start >= last:
            expected.append(text[last:start])
        last = max(last, end)
    (clean,) = secrets.without_secrets(docs).collect()
    assert clean.text == secrets.MASK.join([*expected, text[last:]])
