import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from harborline.llm import mixing
from harborline.llm.exact_dedup import exact_dedup
from harborline.llm.simhash_trie import fingerprint, simhash_components, trie_links
from tests.llm.helpers import awkward, frame, words


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("fan_in", [2, 16])
def test_exact_dedup_against_brute_force(spark, keep, fan_in):
    rows = awkward()
    got = exact_dedup(frame(spark, rows), keep=keep, fan_in=fan_in, ranges=3).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    assert len(got) == len(rows)
    kept = Counter()
    for r in got:
        group = groups[r["text"] or ""]
        ids = [i for i in group if i is not None]
        assert r["group_size"] == len(group)
        assert r["keep_id"] == ((max if keep == "max" else min)(ids) if ids else None)
        assert r["text_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
        kept[r["text"] or ""] += r["kept"]
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert exact_dedup(frame(spark, [])).collect() == []


def plain_fingerprint(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = words(w)
    shingles = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def smallest_reachable(prints, budget):
    n = len(prints)
    label = list(range(n))
    moved = True
    while moved:
        moved = False
        for i in range(n):
            for j in range(n):
                if label[j] < label[i] and (prints[i] ^ prints[j]).bit_count() <= budget:
                    label[i], moved = label[j], True
    return label


@pytest.mark.parametrize("node_rows", [1_000_000, 3])
def test_simhash_against_brute_force(spark, node_rows):
    rows = awkward()
    got = simhash_components(frame(spark, rows), node_rows=node_rows).collect()
    prints = [plain_fingerprint(r[1]) for r in rows]
    label = smallest_reachable(prints, 4)
    expected = Counter()
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        expected[(r[0], prints[i], min(ids) if ids else None)] += 1
    assert Counter((r["key"], r["fp"] % 2**64, r["component_id"]) for r in got) == expected
    assert simhash_components(frame(spark, [])).collect() == []


def test_fingerprint_bytes():
    for text in ("", " ", "A", "A b C d", "a b c d e f é", "x\x1cy z\x0bw q r s"):
        assert fingerprint(text.encode()) == plain_fingerprint(text)


def test_trie_links_against_brute_force():
    rng = np.random.default_rng(3)
    for budget in (0, 2, 4):
        base = rng.integers(0, 2**63, size=40, dtype=np.uint64)
        leaves = [base]
        for _ in range(8):
            f = base.copy()
            for _ in range(int(rng.integers(1, 6))):
                f = f ^ (np.uint64(1) << rng.integers(0, 64, size=len(f)).astype(np.uint64))
            leaves.append(f)
        leaves = np.unique(np.concatenate(leaves))
        parent = trie_links(leaves, [(0, len(leaves), 0, len(leaves), 0)], 0, budget)
        assert parent.tolist() == smallest_reachable([int(x) for x in leaves], budget)


def test_water_fill():
    assert mixing.water_fill([10, 10, 10], [3, 1, 2], 45, 2) == [20, 25 / 3, 50 / 3]
    assert mixing.water_fill([100, 1, 0], [1, 1, 1], 50, 2) == [48, 2, 0]
    assert mixing.water_fill([], [], 0, 2) == []


def test_permutation():
    for size in (1, 2, 3, 100, 1000):
        for key in (0, 7):
            assert sorted(mixing.permute(np.arange(size), np.full(size, size), np.full(size, key))) == list(range(size))


def test_mix_takes_near_its_targets(spark):
    rows = awkward(many=300)
    docs = frame(spark, rows)
    got = mixing.taken(docs, block_words=16, shard_slots=64).collect()
    assert Counter((r["key"], r["size"]) for r in got) == Counter((r[0], len(words(r[1]))) for r in rows)
    sums, target = Counter(), {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        sums[r["source"]] += r["taken"]
        target[r["source"]] = (r["target"], r["source_size"])
    total = sum(len(words(r[1])) for r in rows)
    assert sum(t for t, _ in target.values()) == pytest.approx(1.5 * total)
    for source, (t, size) in target.items():
        assert t <= 2 * size and abs(sums[source] - t) <= 32
    again = mixing.taken(docs.repartition(2), block_words=16, shard_slots=64).collect()
    assert Counter((r["key"], r["size"], r["taken"]) for r in again if r["key"] is not None and r["key"] != 12) == Counter(
        (r["key"], r["size"], r["taken"]) for r in got if r["key"] is not None and r["key"] != 12)
    assert mixing.taken(frame(spark, [])).collect() == []


def test_small_sources_get_their_targets_to_the_word(spark):
    sizes = [20_000, *range(1, 140, 3), 65, 64, 63, 129]
    docs = spark.createDataFrame([(i, "w " * n, f"site{i:03}") for i, n in enumerate(sizes)], "doc_id long, text string, source string")
    weights = tuple([30_000.0, *[n * (0.2 + i % 9 / 4) for i, n in enumerate(sizes[1:])]])
    for share in (0.5, 1.2):
        got = mixing.taken(docs, weights=weights, share=share, shard_slots=64).collect()
        assert len(got) == len(sizes) and all(r["target"] > 0 for r in got)
        assert [r["taken"] for r in got] == [max(1, round(r["target"])) for r in got]
    draws = mixing.mixed_documents(docs, weights=weights, share=1.2, shard_slots=64).collect()
    assert len({r["source"] for r in draws}) == len(sizes)


def test_place_inverts_the_permutation():
    for size in (1, 2, 3, 5, 100):
        for key in (0, 7, 1 << 40):
            at = mixing.permute(np.arange(size), np.full(size, size), np.full(size, key))
            assert [mixing.place(int(x), size, key) for x in at] == list(range(size))


def test_draws_fill_shards(spark):
    documents, draws = mixing.mix(frame(spark, awkward(many=300)), block_words=16, shard_slots=64)
    slots = {(r["shard"], r["slot"]) for r in draws.collect()}
    shards = Counter(s for s, _ in slots)
    assert all(n == 64 for s, n in shards.items() if s != max(shards))
    for r in draws.join(documents, "row").collect():
        assert 0 <= r["from_word"] and r["words"] > 0 and r["from_word"] + r["words"] <= r["size"]


def test_slots_meet_blocks_without_the_driver(spark):
    """Both sides of that join are many times the rows their size is estimated from, so neither may be broadcast."""
    docs = frame(spark, awkward(many=300))
    for limit in (None, "1g"):
        if limit:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            _, draws = mixing.mix(docs, block_words=2, shard_slots=4096)
            draws.collect()
            plan = draws._jdf.queryExecution().executedPlan().toString()
        finally:
            if limit:
                spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        joins = [x for x in plan.splitlines() if "Join" in x and "block" in x]
        assert joins and all("SortMergeJoin" in x for x in joins)


def test_documents_meet_the_catalogue_on_its_side(spark, monkeypatch):
    """The short catalogue is broadcast, never the documents; a long one is shuffled, with equal results."""
    docs, built = frame(spark, awkward(many=300)), []
    real = mixing.running_sums
    monkeypatch.setattr(mixing, "running_sums", lambda rows, *rest: built.append(rows) or real(rows, *rest))

    def draw():
        documents, draws = mixing.mix(docs, block_words=16, shard_slots=64)
        return sorted(map(str, draws.drop("row").collect())), sorted(map(str, documents.drop("row").collect()))

    short = draw()
    plan = built[0]._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join" in x and "c_source" in x]
    assert joins and all("BuildRight" in x for x in joins)
    monkeypatch.setattr(mixing, "SMALL_CATALOGUE", 0)
    assert draw() == short


def test_mixed_texts_are_not_broadcast(spark):
    """The pipeline's fourth stage: no join but that with the totals of partitions goes by the driver, even where estimates are small."""
    docs = frame(spark, awkward(many=300))
    mixed = mixing.mixed_documents(docs, block_words=2, shard_slots=4096)
    mixed.collect()
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.splitlines() if "BroadcastHashJoin" in x and "_pid" not in x]
    assert joins == []
