import random

import numpy as np
import pyarrow as pa
from odd_rows import no_documents, odd_documents

from ledgerwatch.llm import near_dup
from ledgerwatch.llm.components import components


def by_force(rows, width, percent):
    sets = {}
    for i, text in rows:
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        words = [w for w in lower.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
        sets[i] = {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def check(spark, rows, width, percent):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.groups(docs, width, percent).collect()}
    want = by_force(rows, width, percent)
    wrong = {i: (got[i], want[i]) for i in want if got[i] != want[i]}
    assert not wrong
    return got


def test_given_documents(spark, texts):
    rows = [(k, t) for k, t in enumerate(texts)]
    check(spark, rows, 2, 80)
    check(spark, rows, 5, 80)


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(5000)]
    texts = [[rng.choice(words) for _ in range(80)]]
    for _ in range(400):  # each a copy of some earlier one with a few words changed
        own = list(rng.choice(texts[-40:]))
        for _ in range(rng.randint(0, 5)):
            own[rng.randrange(len(own))] = rng.choice(words)
        texts.append(own)
    texts += [[rng.choice(words[:40]) for _ in range(60)] for _ in range(200)]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    got = check(spark, rows, 2, 80)
    assert len({c for _, c in got.values()}) > 200


def signed(spark, rng, likeness):
    """Nodes (node, n, sig, root, many): node 0 agrees with all 60 others of one component in this share of values."""
    own = [rng.randrange(256) for _ in range(128)]
    rows = [(bytes([0]), 100, bytes(own), bytes([0]), 1)]
    for k in range(1, 61):
        sig = [v if j < 3 or rng.random() < likeness else (v + 1) % 256 for j, v in enumerate(own)]
        rows.append((bytes([k]), 100, bytes(sig), bytes([255]), 60))
    return spark.createDataFrame(rows, "node binary, n long, sig binary, root binary, many long")


def test_every_likely_pair_between_components_is_brought(spark):
    rooted = signed(spark, random.Random(3), 0.85)
    for block in (4096, 16):  # crowded runs are cut into blocks
        forest = near_dup.Forest(block=block)
        got = {(r.a[0], r.b[0]) for r in near_dup.crossing_pairs(rooted, 0.8, forest, None).collect()}
        assert got == {(0, k) for k in range(1, 61)}
    few = near_dup.Forest(trees=1)
    assert near_dup.crossing_pairs(rooted, 0.8, few, 24).count() == 24


def test_a_pair_far_apart_in_a_crowded_run_is_found(spark):
    rng = random.Random(8)
    own = [rng.randrange(256) for _ in range(128)]
    rows = []
    for k in range(3000):  # one run in the first tree; the first and the last of it are alike
        sig = own[:3] + [rng.randrange(1, 255) for _ in range(125)]
        if k in (0, 2999):
            sig = own[:3] + own[3:]
            sig[72] = k // 12  # the tree sorts by further values, too: at both ends of the run
        rows.append((k.to_bytes(2, "big"), 100, bytes(sig), k.to_bytes(2, "big"), 1))
    rooted = spark.createDataFrame(rows, "node binary, n long, sig binary, root binary, many long")
    for block in (4096, 500):
        got = near_dup.crossing_pairs(rooted, 0.8, near_dup.Forest(trees=1, block=block), None).collect()
        assert [(int.from_bytes(r.a, "big"), int.from_bytes(r.b, "big")) for r in got] == [(0, 2999)]


def test_odd_rows(spark, texts):
    docs = odd_documents(spark, texts[:60])
    rows = near_dup.groups(docs, 2, 80).collect()
    assert len(rows) == docs.count()
    base = 60
    by_id = {r.doc_id: r for r in rows}
    for k in (base, base + 1, base + 3):
        assert (by_id[k].n_shingles, by_id[k].component_id, by_id[k].kept) == (0, k, True)
    assert by_id[base + 2].n_shingles == 1 and by_id[base + 4].n_shingles == 1
    assert [r.kept for r in rows if r.doc_id == 0] == [True] * 3
    nulls = spark.createDataFrame([(None, "a b c"), (None, None), (5, "a b c"), (4, "a b c")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.kept) for r in near_dup.groups(nulls, 2, 80).collect())
    assert got == [(0, True), (0, True), (4, True), (5, False)]


def test_empty_table(spark):
    assert near_dup.groups(no_documents(spark)).collect() == []


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5000, 5000), (2000, 2001), (2001, 2000)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    of = {}
    for r in rows:
        of.setdefault(r.root, set()).add(r.node)
    assert len(rows) == 301 + 200 + 1 + 2
    assert sorted(map(len, of.values())) == [1, 2, 200, 301]
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_likely_pairs_are_held_in_bounded_parts(monkeypatch):
    gen = np.random.default_rng(3)
    count, k = 300, 4
    sigs = [row.tobytes() for row in gen.integers(0, 2, (count, 128), dtype=np.uint8)]
    names = [bytes([n // 256, n % 256]) for n in range(count)]
    table = pa.RecordBatch.from_pydict({"n": np.full(count, 9), "sig": pa.array(sigs, pa.binary()), "root": pa.array(names, pa.binary())})
    begins = np.arange(count) == 0
    whole = [x for x in near_dup.compared(table, begins, 0, count, 0.4, 0.8)]
    monkeypatch.setattr(near_dup, "PAIRS_AT_ONCE", 500)
    parts = [x for x in near_dup.compared(table, begins, 0, count, 0.4, 0.8)]
    assert len(whole) == 1 and len(parts) > 10 and all(len(at) <= 500 + count for at, _, _ in parts)
    assert all((np.concatenate(x) == y).all() for x, y in zip(zip(*parts), whole[0]))
    at, other, alike = whole[0]
    keep = near_dup.among_best(at, alike, k)
    best = near_dup.best_of(iter(parts), lambda at, other: at, k)
    assert all((x == y[keep]).all() for x, y in zip(best, whole[0]))


def family(rng, count, others):
    """Texts that share 80 words in order, each with so many of its own at places of its own."""
    base = [f"b{k}" for k in range(80)]
    texts = []
    for k in range(count):
        own = list(base)
        for n, place in enumerate(rng.sample(range(0, 80, 3), others)):
            own[place] = f"x{k}y{n}"
        texts.append(" ".join(own))
    return texts


def test_pairs_just_short_of_the_threshold_are_no_rows(spark, monkeypatch):
    rng = random.Random(9)
    # 0.7 to 0.85 with each other: nearly all pairs are likely, some are links
    rows = [(k, t) for k, t in enumerate(family(rng, 150, 5) + family(rng, 150, 4))]
    met, confirmed = [], near_dup.confirmed

    def counted(pairs, sets, percent):
        met.append(pairs.count())
        return confirmed(pairs, sets, percent)

    monkeypatch.setattr(near_dup, "confirmed", counted)
    check(spark, rows, 2, 80)
    assert sum(met) <= len(rows)


def test_links_that_join_are_those_of_all_pairs():
    gen = np.random.default_rng(4)
    base = gen.integers(1 << 60, size=120, dtype=np.uint64)
    sets = []
    for _ in range(90):
        own = base.copy()
        places = gen.choice(120, gen.integers(5, 30), replace=False)
        own[places] = gen.integers(1 << 60, size=len(places), dtype=np.uint64)
        sets.append(np.unique(own))
    at, other = np.tril_indices(90, -1)
    links = [(a, b) for a, b in zip(at, other) if 100 * len(both := np.intersect1d(sets[a], sets[b])) >= 80 * (len(sets[a]) + len(sets[b]) - len(both))]
    want = np.arange(90)
    for a, b in links:
        want[want == want[a]] = want[b]
    alike = np.ones(len(at))
    parts = [(at[k::3], other[k::3], alike[k::3]) for k in range(3)]
    roots = np.arange(90)
    got = list(near_dup.joining(iter(parts), sets, roots, 80))
    groups_of = [sorted(map(tuple, {r: [int(k) for k in np.flatnonzero(x == r)] for r in x}.values())) for x in (want, roots)]
    assert groups_of[0] == groups_of[1] and 1 < len(groups_of[0]) < 90
    assert set(got) <= set(links) and len(got) == 90 - len(groups_of[0])


def test_pieces_come_whole_and_a_few_at_once():
    sizes = [3, 1, 40, 2, 2, 7, 1]
    run = np.repeat(np.arange(len(sizes)), sizes)
    table = pa.RecordBatch.from_pydict({"run": run, "i": run * 0, "j": run * 0, "n": run * 0 + 5})
    for step in (1, 4, 100):
        got = list(near_dup.whole_pieces((table.slice(k, step) for k in range(0, len(run), step)), 30))
        assert [r for rows, _ in got for r in rows.column("run").to_pylist()] == run.tolist()
        assert all(5 * rows.num_rows <= 30 or begins.sum() == 1 for rows, begins in got)
        assert sum(int(begins.sum()) for _, begins in got) == len(sizes)
