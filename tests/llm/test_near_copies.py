"""Near copies by word shingles: sketches, slices and components against exact set similarity."""

import random

import numpy as np

from harborline.llm import simhash_trie
from harborline.llm.simhash_trie import (
    SKETCH_BITS, SLICE_DIFF, Digests, bands, digest, keep_one_of_each, link_forest, set_sketch, shingle_hashes, similar_components, similar_sets,
    sketch, slice_rotations, trie_links)


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def corpus(seed):
    """Texts with 0 to 3 copies each that differ in one word: (doc_id, text, family)."""
    dice = random.Random(seed)
    rows = []
    for family in range(60):
        words = [f"w{dice.randrange(5000)}" for _ in range(dice.randrange(120, 400))]
        for copy in range(dice.randrange(4)):
            own = list(words)
            if copy:
                own[dice.randrange(len(own))] = f"edit{copy}"
            rows.append((len(rows), " ".join(own), family))
    return rows


def test_components_are_the_families(spark):
    rows = corpus(3)
    for _, a, f in rows:
        for _, b, g in rows:
            similar = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) >= 0.8
            assert similar == (f == g)
    first = {}
    for i, _, f in rows:
        first.setdefault(f, i)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    for node_rows in (1_000_000, 2):   # the second splits every subtrie
        found = {r["key"]: r["component_id"] for r in similar_components(docs, node_rows=node_rows).collect()}
        assert found == {i: first[f] for i, _, f in rows}


def test_kept_rows_with_nulls_ties_and_clashing_names(spark):
    long = " ".join(f"t{i}" for i in range(200))
    rows = [(5, long, 1, "a"), (2, long + " more", 2, "b"), (None, long, 3, "c"), (7, None, 4, "d"), (8, "", 5, "e"), (9, "one two", 6, "f"), (9, "one two", 6, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int, sketch string")
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 7, 9]
    assert keep_one_of_each(docs.where("false")).count() == 0


def test_many_equal_leaves_are_linked_only_within_the_whole_budget():
    dice = np.random.default_rng(4)
    sketches = np.repeat(dice.integers(0, 2**63, (3, SKETCH_BITS // 64)).astype(np.uint64), 200, axis=0)[dice.permutation(600)]
    parent = trie_links(np.zeros(600, dtype=np.uint64), [(0, 600, 0, 600, 0)], 0, 3, sketches, 88)
    groups = {tuple(s): set() for s in sketches}
    for s, p in zip(sketches, parent):
        groups[tuple(s)].add(int(p))
    assert len(groups) == 3 and all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == 3


def test_sketch_is_the_majority_of_distinct_shingles():
    text = " ".join(f"x{i % 700}" for i in range(1400))
    assert len(sketch(text.encode())) == SKETCH_BITS // 8
    assert sketch(b"A b  C\td e f") == sketch(b"a b c d e f")
    assert sketch(b"") == bytes(SKETCH_BITS // 8) == sketch(b" \n ")
    assert sketch((text + " " + text).encode()) != bytes(SKETCH_BITS // 8)


def sharing(common, own, dice):
    """Texts with ``common`` shingles in common and so many of their own, one text per entry of ``own``."""
    words = [f"c{dice.randrange(10**9)}" for _ in range(common + 4)]
    return [" ".join(words + [f"o{dice.randrange(10**9)}" for _ in range(n)]) for n in own]


def test_texts_that_share_a_passage_below_the_similarity_stay(spark):
    texts = sharing(140, [30] * 20, random.Random(5))
    assert all(len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) == 0.7 for a in texts for b in texts if a != b)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for node_rows in (1_000_000, 2):
        assert keep_one_of_each(docs, node_rows=node_rows).count() == 20


def test_pairs_just_above_the_similarity_are_linked(spark):
    dice = random.Random(6)
    texts = []
    for common, *own in [(400, 50, 50), (200, 25, 25), (85, 10, 10), (40, 4, 4), (20, 2, 3), (12, 1, 2), (12, 0, 3)]:
        for _ in range(60):
            a, b = sharing(common, own, dice)
            assert 0.8 <= len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) < 0.85
            texts += [a, b]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["key"]: r["component_id"] for r in similar_components(docs).collect()}
    assert found == {i: i - i % 2 for i in range(len(texts))}


def test_digests_keep_every_similar_pair_and_few_others():
    dice = np.random.default_rng(7)
    sets, pairs = [], []
    for size in [1, 2, 5, 9, 40, 85, 86, 150, 170, 171, 340, 342, 690, 1300, 1366, 2000, 5000]:
        for similarity in [0.8, 0.801, 0.9, 1.0, 0.6]:
            for _ in range(20):
                both = int(np.ceil(2 * size * similarity / (1 + similarity)))
                own = int(dice.integers(0, 2 * (size - both) + 1)) if both < size else 0
                values = np.unique(dice.integers(0, 2**64, 2 * size + 2, dtype=np.uint64))
                a, b = values[:both + own], np.concatenate([values[:both], values[both + own:2 * size - both]])
                pairs.append((len(sets), len(sets) + 1, similar_sets(a, b)))
                sets += [a, np.sort(b)]
    digests = Digests([digest(s) for s in sets], SKETCH_BITS)
    i, j, similar = (np.array(x) for x in zip(*pairs))
    may = digests.may_be_similar(i, j)
    assert (may == digests.may_be_similar(j, i)).all() and may[similar].all() and similar.sum() > 500
    assert may[~similar & (digests.size[i] > 100) & (digests.size[i] < 1300)].mean() < 0.1
    unrelated = (digests.size[i[1:]] > 100) & (digests.size[i[1:]] < 1300)
    assert unrelated.any() and not digests.may_be_similar(i[:-1], i[1:])[unrelated].any()


def test_a_star_of_copies_gives_its_rays_not_its_square(spark):
    """2,000 copies, similar to one original, most of them not to each other: the tries emit few pairs besides the similar ones."""
    dice = random.Random(8)
    base = [f"b{i}" for i in range(164)]
    rows = []
    for n in range(2001):
        own = list(base)
        for at in dice.sample(range(4, 160), 3) if n else []:
            own[at] = f"own{n}_{at}"
        hashes = np.unique(shingle_hashes(" ".join(own).encode(), 5, 42))
        rows.append((n, n, bytearray(set_sketch(hashes)), bytearray(bands(hashes)), bytearray(digest(hashes)), hashes))
    leaves = spark.createDataFrame([r[:5] for r in rows], "id long, part long, sketch binary, bands binary, digest binary")
    found = {(min(p), max(p)) for p in link_forest(*slice_rotations(leaves), SLICE_DIFF, 1_000_000, 66).distinct().collect()}
    similar = {p for p in found if similar_sets(rows[p[0]][5], rows[p[1]][5])}
    assert len({b for a, b in similar if a == 0}) > 1950
    assert len(found) < 2000 * 1999 / 2 / 10


def parts_of(nodes, pairs):
    """The smallest node of each node's component."""
    root = {n: n for n in nodes}
    for _ in nodes:
        before = dict(root)
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            return root


def test_candidates_of_a_group_are_a_forest_and_its_pairs_are_all_compared(spark, monkeypatch):
    """Pipeline: the tries gave every candidate pair of a group of near copies, its square in rows."""
    dice = random.Random(9)
    texts = []
    for n in range(300):
        own = [f"b{i}" for i in range(164)]
        for at in dice.sample(range(4, 160), dice.randrange(1, 6)):
            own[at] = f"own{n}_{at}"
        texts.append(" ".join(own))
    sets = [np.unique(shingle_hashes(t.encode(), 5, 42)) for t in texts]
    leaves = spark.createDataFrame(
        [(n, bytearray(set_sketch(x)), bytearray(bands(x)), bytearray(digest(x))) for n, x in enumerate(sets)],
        "id long, sketch binary, bands binary, digest binary")
    found = [tuple(r) for r in link_forest(*slice_rotations(leaves), SLICE_DIFF, 1_000_000, 66).collect()]
    similar = [(a, b) for b in range(300) for a in range(b) if similar_sets(sets[a], sets[b])]
    cluster, wanted = parts_of(range(300), found), parts_of(range(300), similar)
    # a forest per trie has fewer rows than leaves
    assert 1000 < len(similar) and len(found) < 300 * (SKETCH_BITS // 32 * (SLICE_DIFF + 1) + simhash_trie.BANDS)
    assert all(cluster[a] == cluster[b] for a, b in similar)

    rows = spark.createDataFrame(list(enumerate(texts)), "_uid long, text string")
    clusters = spark.createDataFrame([(n, cluster[n], len(sets[n])) for n in range(300)], "id long, cluster long, size long")
    for most, spread in ((2048, 1), (40, 8)):
        monkeypatch.setattr(simhash_trie, "CHUNK_ROWS", most)
        links = [tuple(r) for r in simhash_trie.similar_links(clusters, rows, 5, 42, 66).collect()]
        assert set(map(frozenset, links)) <= set(map(frozenset, similar)) and len(links) < 300 * spread
        assert parts_of(range(300), links) == wanted


def test_a_forest_of_similar_sets_has_their_components():
    dice = np.random.default_rng(10)
    pool = dice.integers(0, 2**64, 400, dtype=np.uint64)
    sets = [np.unique(dice.choice(pool[20 * (i % 7):20 * (i % 7) + 40], 40 - i % 5, replace=False)) for i in range(200)]
    sets += [sets[0], np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)]
    n = len(sets)
    for split in (None, 120):
        pairs = [(i, j) for j in range(n) for i in range(j) if similar_sets(sets[i], sets[j]) and (split is None or i < split <= j)]
        found = simhash_trie.similar_forest(sets, split, 66)
        assert set(found) <= set(pairs) and len(found) < n and parts_of(range(n), found) == parts_of(range(n), pairs)
        assert (simhash_trie.similar_to(sets[0], sets) == [similar_sets(sets[0], x) for x in sets]).all()
