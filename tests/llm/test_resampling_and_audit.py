"""Importance resampling and the source audit against plain Python over awkward documents."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import pyarrow as pa
import pytest

from harborline.llm import source_audit as audit
from harborline.llm.importance import importance_resample, ngram_crcs
from tests.llm.helpers import awkward, frame

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, longest):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(w), [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def resampled(rows, target, percent, longest, buckets=10_000):
    bucket = lambda f: crc32(f.encode()) % buckets
    count = lambda texts: Counter(bucket(f) for t in texts for f in features(t, longest)[1])
    s, t = count(r[1] for r in rows), count(target)
    gain = lambda b: math.floor(1000 * math.log(
        (t[b] + 1.0) * float(s.total() + buckets) / ((s[b] + 1.0) * float(t.total() + buckets))))
    out = []
    for key, text, *_ in rows:
        n, found = features(text, longest)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append((key, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((x for x in out if x[1] >= 20), key=lambda x: (-x[4], x[0] is not None, x[0]))
    rank = {i: None for i in range(len(out))}
    drawn = able[:percent * len(able) // 100]
    return Counter(out), [(x[0], x[4]) for x in drawn]


@pytest.mark.parametrize("longest,percent,buckets", [(2, 25, 10_000), (1, 100, 50), (3, 60, 997), (2, 0, 10_000)])
def test_resampling_is_brute_force(spark, longest, percent, buckets):
    rows = awkward()
    target = ["The señor and the tion", None, "Über l'été don't", "x 12,5 日本語"]
    got = importance_resample(
        frame(spark, rows), spark.createDataFrame([(t, 1) for t in target], "text string, key int"),
        percent=percent, longest=longest, buckets=buckets).collect()
    expected, drawn = resampled(rows, target, percent, longest, buckets)
    assert Counter(tuple(r)[:5] for r in got) == expected
    assert [(r.key, r.score) for r in sorted((r for r in got if r.rank is not None), key=lambda r: r["rank"])] == drawn
    assert sorted(r["rank"] for r in got if r["rank"] is not None) == list(range(1, len(drawn) + 1))


def test_chained_seeds_are_the_ngrams_own_crc():
    words = ["é".encode(), b"a", b"b1", b"a"]
    found = list(ngram_crcs(words, 3))
    runs = [b" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    assert found == [crc32(r) for r in runs]
    assert list(ngram_crcs([], 3)) == [] and list(ngram_crcs([b"x"], 2)) == [crc32(b"x")]


def test_resampling_of_nothing(spark):
    empty = frame(spark, [])
    assert importance_resample(empty, empty).count() == 0
    some = importance_resample(frame(spark, awkward()), empty)
    assert some.count() == len(awkward()) and some.where("weight < 0").count() > 0
    with pytest.raises(ValueError):
        importance_resample(empty, empty, percent=101)


def audited(rows, min_docs, top):
    of = lambda x: "" if x is None else x
    counts, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        terms = [t.translate(LOWER) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", of(text))]
        groups[of(lang)].add(of(source))
        counts[of(lang), of(source)].update(terms)
        df[of(lang)].update(set(terms))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= min_docs]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(items[:limit])}
    return out


def many_sources(seed=3):
    rng = random.Random(seed)
    terms = ["alpha", "Beta", "γάμμα", "été", "日本", "x", "don't", "one2two", "kappa", "Lambda"]
    return [(i, " ".join(rng.choices(terms, weights=range(1, 11), k=rng.randrange(0, 30))), rng.choice(["en", "de"]),
             f"s{rng.randrange(9)}", 1, *"uknfsr") for i in range(200)] + [(999, "lone text", "xx", None, 1, *"uknfsr")]


@pytest.mark.parametrize("rows,min_docs,bits", [(awkward(), 3, 64), (awkward(), 3, 3), (many_sources(), 30, 64), (many_sources(), 1, 2)])
def test_audit_is_brute_force(spark, monkeypatch, rows, min_docs, bits):
    monkeypatch.setattr(audit, "CHUNK_SOURCES", 2)
    monkeypatch.setattr(audit, "SLICE_TERMS", 3)
    got = [tuple(r) for r in audit.source_audit(frame(spark, rows), min_docs=min_docs, top=4, digest_bits=bits).collect()]
    assert len(got) == len(set(got))
    assert set(got) == audited(rows, min_docs, 4)


def test_audit_without_kept_terms(spark):
    rows = many_sources()
    got = audit.source_audit(frame(spark, rows), min_docs=10_000).collect()
    assert got and {(r.part, r.value) for r in got} == {("pair", 0)}
    assert audit.source_audit(frame(spark, [])).count() == 0


class Batches:
    """Stands for a table whose map task is called with given batches."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def tallied(rows, size):
    batches = [pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in part]), pa.array([r[1] for r in part]), pa.array([r[2].encode() for r in part], pa.binary())],
        ["lang", "source", "text"]) for part in (rows[i:i + size] for i in range(0, len(rows), size))]
    return pa.Table.from_batches(list(audit.tally(Batches(), "lang", "source", "text")(iter(batches))))


def test_a_task_writes_a_term_of_a_group_once(spark):
    """Also when many batches bring the same vocabulary: 300,000 terms held were too few for that."""
    vocabulary = " ".join("".join(chr(97 + i // 26 ** k % 26) for k in range(4)) for i in range(200_000))
    found = tallied([("en", s, vocabulary) for s in "ab" * 3], 2)
    assert found.num_rows == 400_000
    assert set(found["n"].to_pylist()) == {3} and set(found["df"].to_pylist()) == {3}
    assert found["term"].null_count == 200_000


@pytest.mark.parametrize("held_terms,held_texts", [(2_000_000, 1_000_000), (10, 1_000_000), (40, 25)])
def test_tally_equals_plain_counting(spark, monkeypatch, held_terms, held_texts):
    monkeypatch.setattr(audit, "HELD_TERMS", held_terms)
    monkeypatch.setattr(audit, "HELD_TEXTS", held_texts)
    texts = ["", " ", "A a\tÉ é", "one-two one", "x1y2z", "\n\n", "日本 日本", "tail ", "<b>b</b>"] + [f"word{chr(97 + i)} A shared" for i in range(26)]
    rows = [("en" if i % 3 else "", f"s{i % 2}", t) for i, t in enumerate(texts)]
    n, df = Counter(), Counter()
    for lang, source, text in rows:
        terms = text.encode().translate(audit.TERM_TABLE).split()
        n.update((lang, source, t) for t in terms)
        df.update((lang, source, t) for t in set(terms))
    found = tallied(rows, 4).to_pylist()
    names = {r["digest"]: r["term"].encode() for r in found if r["term"] is not None}
    got_n, got_df = Counter(), Counter()
    for r in found:
        key = r["lang"], r["source"], names[r["digest"]]
        got_n[key] += r["n"]
        got_df[key] += r["df"]
    assert got_n == n and got_df == df
