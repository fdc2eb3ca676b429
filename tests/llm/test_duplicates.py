"""Near-duplicates, repeated passages and benchmark passages against brute
force."""

import hashlib
import random

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from touchline.llm import decontam, neardup, substring

SCHEMA = "doc_id long, text string, body string, kept string, `class` int"


def words(rng, n, of=400):
    return [f"w{rng.randrange(of)}" for _ in range(n)]


def fixture(seed=1):
    """Copies, near copies, shared passages, repeated words, odd rows."""
    rng = random.Random(seed)
    texts = [words(rng, rng.choice([3, 19, 20, 21, 60, 200])) for _ in range(40)]
    base = words(rng, 150)
    for _ in range(25):
        copy = list(base)
        for _ in range(rng.randrange(3)):
            copy[rng.randrange(150)] = f"x{rng.randrange(99999)}"
        texts.append(copy)
    passage = words(rng, 55)
    for _ in range(12):
        a, b = rng.randrange(10), rng.randrange(40, 55)
        texts.append(words(rng, 30) + passage[a:b] + words(rng, 30))
    texts += [["same"] * 70, ["same"] * 25, ["same"] * 19, [], texts[0], texts[3], texts[4]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    rows += [(500, None), (501, "  \n\t "), (502, "A  b\nC d\te F g h"), (503, "a B c D e f g H"), rows[7], rows[7]]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "b", "k", 0) for i, t in rows], SCHEMA)


def shingles(text, k):
    w = (text or "").encode()
    w = bytes(c + 32 if 65 <= c <= 90 else c for c in w).split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(rows, k=4, percent=80):
    sets = {i: shingles(t, k) for i, t in rows}
    of = {i: i for i in sets}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((of[a], of[b]))
                of = {i: x if c == y else c for i, c in of.items()}
    return sets, of


def check_near(spark, rows):
    sets, of = components(rows)
    got = neardup.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {(i, len(sets[i]), of[i], of[i] == i) for i in sets}


def test_near_duplicates(spark):
    check_near(spark, fixture())


def test_near_duplicates_deep_and_large(spark, monkeypatch):
    """Small limits: nodes branch to the last level, groups go in rounds."""
    monkeypatch.setattr(neardup, "LEAF", 4)
    monkeypatch.setattr(neardup, "DEPTH", 3)
    monkeypatch.setattr(neardup, "GROUP_SHINGLES", 600)
    monkeypatch.setattr(neardup, "PIVOTS", 3)
    check_near(spark, fixture(2))


def test_a_large_group_of_near_copies_is_not_branched(spark, monkeypatch):
    """Members that resemble one member only stay findable, and the group's
    nodes have a row a class and tree, however many levels there are."""
    rng = random.Random(9)
    base = words(rng, 120, of=5000)
    rows = [(i, " ".join(base[:k] + [f"x{i}"] + base[k + 1 :])) for i, k in enumerate(rng.choices(range(120), k=150))]
    chain = rows[0][1].split()
    for i in range(200, 212):  # each resembles the one before
        chain = chain[8:] + [f"y{i}_{j}" for j in range(8)]
        rows.append((i, " ".join(chain)))
    rows += [(300 + i, " ".join(words(rng, 90, of=5000))) for i in range(60)]
    monkeypatch.setattr(neardup, "LEAF", 16)
    made, kept = [], neardup.stored
    monkeypatch.setattr(neardup, "stored", lambda df, name: made.append((name, kept(df, name))) or made[-1][1])
    check_near(spark, rows)
    nodes = [df.count() for name, df in made if name == "nodes"]
    assert sum(nodes[1:]) < nodes[0] / 2


def large_group(seed, n):
    """Sets of one candidate group: most share half of their values with all,
    some are near copies of one, some resemble the one before, some are tiny."""
    import numpy as np

    rng = random.Random(seed)
    common, base = rng.sample(range(1, 1 << 62), 20), rng.sample(range(1, 1 << 62), 90)
    sets = [common[: rng.randrange(1, 20)] + rng.sample(range(1, 1 << 62), rng.randrange(1, 40)) for _ in range(n)]
    for _ in range(n // 4):
        sets.append(base[rng.randrange(16) :] + rng.sample(range(1, 1 << 62), rng.randrange(16)))
    chain = list(base)
    for _ in range(n // 10):
        chain = chain[5:] + rng.sample(range(1, 1 << 62), 5)
        sets.append(chain)
    sets += [common[:k] for k in range(1, 8)]
    return [np.array(sorted(x), np.uint64) for x in {tuple(sorted(x)) for x in sets}]


def resolved(spark, monkeypatch, groups):
    """Links of resolve_large on groups, as components, and the tables it makes."""
    from touchline.llm import common

    rows = [(neardup.set_key(x), bytes([k]) * 16, x.tobytes()) for k, sets in enumerate(groups) for x in sets]
    made, kept = [], common.stored
    monkeypatch.setattr(neardup, "stored", lambda df, name: made.append(name) or kept(df, name))
    links = neardup.resolve_large(spark.createDataFrame(rows, "class binary, group binary, shingles binary"), 80).collect()
    of = {bytes(r[0]): bytes(r[0]) for r in rows}
    for a, b in links:
        x, y = sorted((of[bytes(a)], of[bytes(b)]))
        of = {i: x if c == y else c for i, c in of.items()}
    return [[of[neardup.set_key(x)] for x in sets] for sets in groups], made


def test_a_large_group_is_resolved_without_a_round_for_every_few_members(spark, monkeypatch):
    """Members that only share some values cost no round of jobs."""
    groups = [large_group(3, 200), large_group(4, 30)]
    found, made = resolved(spark, monkeypatch, groups)
    for sets, got in zip(groups, found, strict=True):
        want = neardup.resolve(sets)
        assert [got.index(x) for x in got] == [want.tolist().index(x) for x in want]
        assert 1 < len(set(got)) < len(got)
    assert len(made) < 12, made


def test_a_hot_token_of_a_large_group_is_dealt_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(neardup, "TILE", 3, raising=False)
    monkeypatch.setattr(neardup, "PIVOTS", 1)
    monkeypatch.setattr(neardup, "RARITY_BITS", 2, raising=False)
    groups = [large_group(5, 24)]
    found, _ = resolved(spark, monkeypatch, groups)
    want = neardup.resolve(groups[0])
    assert [found[0].index(x) for x in found[0]] == [want.tolist().index(x) for x in want]


@given(st.integers(0, 10**6), st.sampled_from([50, 80, 100]))
@settings(max_examples=100, deadline=None)
def test_resolve_compares_few_members_of_a_group(seed, percent):
    """Near copies of one set, of which many differ too much: same components as
    all pairs, and members that can't be similar aren't compared."""
    import numpy as np

    rng = random.Random(seed)
    base = rng.sample(range(1000), 60)
    sets = []
    for k in range(30):
        n = rng.choice([1, 2, 9, 11])
        sets.append(np.unique(np.array(base[:20] + rng.sample(base[20:], 40 - n) + [1000 + 20 * k + i for i in range(n)], np.uint64)))
    pairs, compared = [], neardup.compared
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(neardup, "compared", lambda pivot, values, owner, sizes, percent: pairs.append(len(sizes)) or compared(pivot, values, owner, sizes, percent))
        label = neardup.resolve(sets, percent)
    of = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                of = [of[b] if c == of[a] else c for c in of]
    assert all((label[a] == label[b]) == (of[a] == of[b]) for a in range(len(sets)) for b in range(a))
    assert percent == 50 or 0 <= sum(pairs) < 30 * 29 / 2


def test_near_duplicates_odd_tables(spark):
    assert neardup.near_duplicates(frame(spark, [])).count() == 0
    got = neardup.near_duplicates(frame(spark, [(None, "a b c d e"), (4, "a b c d e"), (None, None), (9, "A B c d e")])).collect()
    assert sorted((r.doc_id or -1, r.component_id, r.kept) for r in got) == sorted([(-1, None, True), (4, 4, True), (-1, None, True), (9, 4, False)], key=lambda r: (r[0], str(r)))


@given(st.lists(st.lists(st.integers(0, 12), min_size=1, max_size=9), min_size=2, max_size=12))
@settings(max_examples=150, deadline=None)
def test_resolve_equals_all_pairs(lists):
    import numpy as np

    sets = [np.unique(np.array(x, np.uint64)) for x in lists]
    label = neardup.resolve(sets)
    of = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            x, y = set(sets[a].tolist()), set(sets[b].tolist())
            if 100 * len(x & y) >= 80 * len(x | y):
                old, new = of[a], of[b]
                of = [new if c == old else c for c in of]
    assert all((label[a] == label[b]) == (of[a] == of[b]) for a in range(len(sets)) for b in range(a))


def without_repeats(rows, window=20):
    seen, out = {}, []
    texts = sorted(((-1 if i is None else i), (t or "").encode().split()) for i, t in rows)
    for i, w in texts:
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            seen[key] = min(seen.get(key, (i, s)), (i, s))
    for i, w in texts:
        gone = set()
        for s in range(len(w) - window + 1):
            if seen[tuple(w[s : s + window])] < (i, s):
                gone.update(range(s, s + window))
        kept = b" ".join(x for n, x in enumerate(w) if n not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_passages(spark, seed):
    rows = [*fixture(seed), (None, fixture(seed)[3][1]), (504, "x" * 200_000 + " y" * 30_000)]
    out = substring.remove_repeats(frame(spark, rows)).collect()
    got = sorted((-1 if r.row.doc_id is None else r.row.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in out)
    assert got == without_repeats(rows)
    assert sum(r[2] for r in got) > 1000


def test_repeated_passages_keep_spacing_and_empty(spark):
    assert substring.remove_repeats(frame(spark, [])).count() == 0
    out = substring.remove_repeats(frame(spark, [(1, " a  b\n"), (2, None)]), keep_spacing=True).collect()
    assert sorted((r.row.doc_id, r.kept, r.row.body) for r in out) == [(1, " a  b\n", "b"), (2, "", "b")]


def greedy(item, stretches, match):
    """Tiling by looking at every common stretch again for each tile."""
    free = [[True] * len(item), *[[True] * len(s) for s in stretches]]
    found = []
    while True:
        best = None
        for i in range(len(item)):
            for k, t in enumerate(stretches):
                for j in range(len(t)):
                    n = 0
                    while i + n < len(item) and j + n < len(t) and item[i + n] == t[j + n] and free[0][i + n] and free[k + 1][j + n]:
                        n += 1
                    if n >= match and (best is None or (-n, i, k, j) < best):
                        best = (-n, i, k, j)
        if best is None:
            return found
        n, i, k, j = -best[0], *best[1:]
        found.append((n, i, k, j))
        for x in range(n):
            free[0][i + x] = free[k + 1][j + x] = False


token = st.sampled_from(["a", "b", "c"])


@given(st.lists(token, max_size=14), st.lists(st.lists(token, max_size=12), max_size=3), st.integers(1, 3))
@settings(max_examples=300, deadline=None)
def test_tiles_are_greedy(item, stretches, match):
    assert sorted(decontam.tiles(item, stretches, match)) == sorted(greedy(item, stretches, match))


def test_decontamination(spark):
    rng = random.Random(3)
    item, other = words(rng, 40, 9999), words(rng, 12, 9999)
    reordered = item[25:40] + words(rng, 8, 9999) + item[:25]
    rows = [
        (1, " ".join(words(rng, 50, 9999) + item + words(rng, 50, 9999))),
        (2, " ".join(reordered)),
        (3, " ".join(words(rng, 300, 9999))),
        (4, " ".join(item[:10])),  # a quarter of the item
        (5, "! ".join(other).upper()),
        (6, None),
        (7, ""),
        (None, " ".join(item)),
        (2, " ".join(reordered)),
        (8, " ".join(item[:15]) + " x"),
        (8, " ".join(item[:25]) + " y"),
    ]
    docs = frame(spark, rows)
    items = spark.createDataFrame([(10, " ".join(item), 1), (11, ", ".join(other), 1), (12, None, 1), (13, "too short", 1)], "item_id long, text string, doc_id int")
    got = {(r.doc_id, r.item_id): r for r in decontam.contaminated(docs, items).collect()}
    assert set(got) == {(1, 10), (2, 10), (5, 11), (None, 10), (8, 10)}
    assert (got[2, 10].n_covered, got[2, 10].n_tiles, got[2, 10].longest) == (40, 2, 25)
    assert got[8, 10].coverage == 25 / 40
    assert decontam.contaminated(docs.limit(0), items).count() == 0
    assert decontam.contaminated(docs, items.limit(0)).count() == 0


def test_decontaminated_pairs_equal_brute_force(spark):
    """All pairs of documents and items of five tokens or more, each tiled whole."""
    rng = random.Random(21)
    items = [words(rng, rng.randrange(5, 24), 60) for _ in range(12)]
    texts = []
    for _ in range(40):
        text = words(rng, rng.randrange(0, 20), 60)
        for item in rng.sample(items, 2):
            # parts of the item in another order, some of them twice
            cuts = sorted(rng.sample(range(len(item) + 1), 2))
            parts = [item[: cuts[0]], item[cuts[0] : cuts[1]], item[cuts[1] :], item[cuts[0] :]]
            for part in rng.sample(parts, rng.randrange(5)):
                text = text + part + words(rng, rng.randrange(3), 60)
        texts.append(text)
    want = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            found = greedy(item, [text], decontam.MATCH)
            covered = sum(t[0] for t in found)
            if covered >= decontam.COVERAGE * len(item) and covered >= min(decontam.LEAST, len(item)):
                want[d, i] = (len(item), covered, len(found), max(t[0] for t in found))
    docs = spark.createDataFrame([(d, " ".join(t), 0) for d, t in enumerate(texts)], "doc_id long, text string, item int")
    asked = spark.createDataFrame([(i, " ".join(t), 0) for i, t in enumerate(items)], "item_id long, text string, doc_id int")
    got = {(r.doc_id, r.item_id): (r.n_tokens, r.n_covered, r.n_tiles, r.longest) for r in decontam.contaminated(docs, asked).collect()}
    assert got == want and len(want) > 30 and any(x[2] > 1 for x in want.values())


def test_decontamination_of_short_items(spark):
    """Items under five tokens count as whole runs only, items of five to eight
    with all their tokens; checked against every run of every document."""
    rng = random.Random(9)
    vocabulary = ["what", "is", "love", "now", "then", "so"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 25))) for _ in range(60)]
    texts += ["What is LOVE", "what is", "love is what", "so " * 70_000 + "what is love", texts[0], None]
    items = ["what is love", "love", "now then", "is is is so", "what is love now then so", "..", None, "what is love", "what is love now then so then now what so"]
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in enumerate(texts)], "doc_id long, text string, item long, seeds int, stretches int")
    found = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)], "item_id long, text string, doc_id int")
    got = decontam.contaminated(docs, found).collect()
    short = {(r.doc_id, r.item_id) for r in got if r.n_tokens < decontam.MATCH}
    runs = {i: f" {x} " for i, x in enumerate(items) if x and x != ".." and len(x.split()) < decontam.MATCH}
    assert short == {(d, i) for d, t in enumerate(texts) for i, x in runs.items() if x in f" {(t or '').lower()} "}
    assert all(r.n_covered == r.n_tokens for r in got if r.n_tokens <= decontam.LEAST)
    assert all(r.n_covered >= decontam.LEAST for r in got if r.n_tokens > decontam.LEAST)
    assert {r.n_words for r in got if r.doc_id == 60} == {3}


def test_decontamination_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()}
    items = {r["item_id"]: r["text"] for r in pq.read_table(f"{sf}/benchmark.parquet").to_pylist()}
    planted = {(d, i) for d, t in docs.items() for i, x in items.items() if t and x in t}
    got = decontam.op6_decontaminate(spark, sf).collect()
    assert planted <= {(r.doc_id, r.item_id) for r in got}
    for r in got:
        assert r.coverage >= 0.5
