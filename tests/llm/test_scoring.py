import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from harborline.llm import edit_counts, language_id, ppm, quality_rules, url_templates
from tests.llm.helpers import awkward, frame, words
from tests.llm.test_token_files import library_ids


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


class PlainPpm:
    """The same model with dictionaries: longest context first, escapes, exclusion."""

    def __init__(self, texts):
        self.counts = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
        for t in texts:
            line = bytes([ppm.PAD]) * ppm.ORDER + t + bytes([ppm.END])
            for i in range(ppm.ORDER, len(line)):
                for k in range(ppm.ORDER + 1):
                    self.counts[k][line[i - k:i]][line[i]] += 1

    def probability(self, context, symbol):
        p, excluded = 1.0, set()
        for k in range(ppm.ORDER, -1, -1):
            seen = {s: c for s, c in self.counts[k].get(context[len(context) - k:], {}).items() if s not in excluded}
            n, d = sum(seen.values()), len(seen)
            if not d:
                continue
            if symbol in seen:
                return p * seen[symbol] / (n + d)
            p *= d / (n + d)
            excluded |= set(seen)
        return p / (256 - len(excluded))

    def score(self, t):
        line = bytes([ppm.PAD]) * ppm.ORDER + t + bytes([ppm.END])
        return sum(math.log10(self.probability(line[i - ppm.ORDER:i], line[i])) for i in range(ppm.ORDER, len(line)))


@pytest.mark.parametrize("block_bytes,train", [(24 << 20, "key % 3 != 0"), (300, "key % 3 != 0"), (300, "false")])
def test_ppm_against_dictionaries(spark, monkeypatch, block_bytes, train):
    monkeypatch.setattr(ppm, "BLOCK_BYTES", block_bytes)
    rows = [(i, t, "en", "s", 0, *[None] * 6) for i, t in enumerate(r[1] for r in awkward(many=12) if len(r[1] or "") < 3000)]
    docs = frame(spark, rows)
    got = ppm.score(docs, F.expr(train.replace("key", "doc_id"))).collect()
    chosen = [r for r in rows if train != "false" and r[0] % 3 != 0]
    model = PlainPpm([lower(r[1]).encode() for r in chosen])
    counts = Counter(w for r in chosen for w in words(lower(r[1])))
    ends = len(chosen)
    total, distinct = sum(counts.values()) + ends, len(counts) + (ends > 0)
    assert len(got) == len(rows)
    by_key = {r["key"]: r for r in got}
    for key, text, *_ in rows:
        r, own = by_key[key], words(lower(text))
        c = [counts[w] for w in own] + [ends]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(c), sum(x > 0 for x in c), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((x + 0.1) / (total + 0.1 * (distinct + 1))) for x in c))
        assert r["score"] == pytest.approx(model.score(lower(text).encode()), rel=1e-5)
    assert ppm.score(frame(spark, []), F.lit(True)).collect() == []


def test_ppm_block_sums_leave_in_bounded_batches(monkeypatch):
    """A block of any size is summed and sent in slices, with the counts of plain counting."""
    class Rows:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    monkeypatch.setattr(ppm, "stored", lambda run, label: run)
    monkeypatch.setattr(ppm, "SUM_ROWS", 5_000, raising=False)
    monkeypatch.setattr(ppm, "PART_BYTES", 20_000)
    rng = np.random.default_rng(5)
    texts = [bytes(rng.integers(97, 123, n, dtype=np.uint8)) + b" same words" for n in rng.integers(0, 4_000, 120)]
    train, block = rng.random(120) < 0.7, np.repeat([1, 2, 5], 40)
    batches = [pa.RecordBatch.from_arrays(
        [pa.array(block[i:i + 25]), pa.array(train[i:i + 25]), pa.array(list(map(ppm.squeeze, texts[i:i + 25])), pa.binary())],
        ["block", "train", "t"]) for i in range(0, 120, 25)]
    sent = list(ppm.block_keys(Rows())(iter(batches)))
    assert max(b.num_rows for b in sent) <= 10_000
    want = Counter()
    for t, learn, b in zip(texts, train, block):
        for key in [*ppm.grams([t])[0].tolist(), *t.split()]:
            want[b, key] += int(learn)
    rows = [(r["block"], r["gram"] if r["word"] is None else r["word"], r["n"]) for b in sent for r in b.to_pylist()]
    assert len(rows) == len(want) and {(b, k): n for b, k, n in rows} == dict(want)


def test_ppm_probabilities_sum_to_one():
    model = PlainPpm([b"abracadabra", b"abba"])
    for context in (b"\xfe\xfeabr", b"zzzzz", b"racad"):
        assert sum(model.probability(context, s) for s in range(256)) == pytest.approx(1)


def test_forward_sums_all_segmentations():
    pieces = language_id.Pieces("byte_bpe_multi_50k.tiktoken")
    rng = np.random.default_rng(4)
    p = np.vstack([rng.random((pieces.count, 2)) / 100, np.zeros((1, 2))])
    for word in (b" a", b" the", b" l\xc3\xa9gende", b" " + b"abcdefgh" * 5):
        letters = np.frombuffer(word, dtype=np.uint8)[None, :]
        spans = pieces.spans(letters)
        log, _ = pieces.forward(spans, p)
        sums = [np.ones(2)]
        for i in range(len(word)):
            sums.append(sum(sums[i - s] * p[spans[s][0, i]] for s in range(min(len(spans), i + 1))))
        assert np.exp(log[0]) == pytest.approx(sums[-1])
        # Expected counts of a word are bytes covered: every byte is in one piece.
        expected = pieces.expected(letters, np.array([1.0]), p[:, 0])
        size_of = np.concatenate([np.full(len(k), i + 1) for i, k in enumerate(pieces.keys)])
        assert (expected[:-1] * size_of).sum() == pytest.approx(len(word))


def test_language_of_held_out_texts(spark):
    samples = {"en": "the house and the garden with those who think", "de": "das haus und der garten mit denen die denken über",
               "fr": "la maison et le jardin avec ceux qui pensent à l'été"}
    rng = np.random.default_rng(1)
    rows = []
    for i in range(240):
        lang = ["en", "de", "fr"][i % 3]
        rows.append((i, " ".join(rng.choice(samples[lang].split(), 12)), lang, "s", 0, *[None] * 6))
    rows += [(900, None, "en", None, 0, *[None] * 6), (901, " 12 !", None, None, 0, *[None] * 6), (None, "the house", None, None, 0, *[None] * 6)]
    got = {r["key"]: r for r in language_id.identify(frame(spark, rows), language_id.remainder("doc_id", 3) != 1, max_docs=30).collect()}
    assert all(got[r[0]]["lang_pred"] == r[2] and 0 <= got[r[0]]["score"] <= 1 for r in rows[:240])
    assert all(got[k]["train"] == (zlib.crc32(str(k).encode()) % 3 != 1) for k in range(240))
    assert (got[900]["lang_pred"], got[901]["lang_pred"], got[None]["lang_pred"]) == ("und", "und", "en")
    untaught = language_id.identify(frame(spark, rows), F.lit(False)).collect()
    assert {r["lang_pred"] for r in untaught} == {"und"}
    assert language_id.identify(frame(spark, []), F.lit(True)).collect() == []


def test_quality_features_and_cascade(spark):
    rows = awkward() + [(500, "a b c d e\nf g\na b c d e\n \n\n", "en", "s", 0, *[None] * 6), (501, "### " * 30, "en", "s", 0, *[None] * 6)]
    got = quality_rules.quality_cascade(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        w = words(r["text"])
        windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        hit = {i + j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(5)}
        lines = [x for x in (r["text"] or "").split("\n") if words(x)]
        expected = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in r["text"] or ""), len(lines) - len(set(lines)), len(hit))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == expected
        assert r["base_failed"] == (len(w) < 10 or 100 * len(hit) > 20 * len(w))
        assert not (r["kept"] and r["base_failed"])
    assert not [r for r in got if r["doc_id"] == 501 and r["kept"]]
    assert quality_rules.quality_cascade(frame(spark, [])).collect() == []


def test_lines_of_f_count_and_form_feeds_do_not(spark):
    body = "\n".join(f"alpha{i} beta{i} gamma{i} delta{i} epsilon{i}" for i in range(4))
    texts = [body + "\nf\nff\nf\nff", body + "\n\f" * 4, body + "\n \f\v\t" * 4, "\f", "f"]
    rows = [(i, t, "en", "s", 0, *[None] * 6) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in quality_rules.quality_cascade(frame(spark, rows)).collect()}
    assert [got[i]["n_dup_lines"] for i in range(5)] == [2, 0, 0, 0, 0]
    assert [got[i]["n_words"] for i in range(5)] == [24, 20, 20, 0, 1]
    assert got[1]["kept"] and got[2]["kept"]
    counted = quality_rules.features(frame(spark, rows), ["doc_id"]).select("doc_id", "n_lines").collect()
    assert dict(map(tuple, counted)) == {0: 8, 1: 4, 2: 4, 3: 0, 4: 1}


def test_rules_are_ordered_by_rejection_per_cost(spark):
    rules = (quality_rules.Rule("never", "n_words < 0"), quality_rules.Rule("always", "n_words >= 0"))
    sample = quality_rules.features(frame(spark, awkward()), []).cache()
    assert [r.name for r in quality_rules.order_rules(sample, rules)] == ["always", "never"]


def test_url_rules_and_templates(spark):
    urls = [("http://WWW.Example.com/en/1?x", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
            ("https://m.example.com/en/2#t", "m.example.com", "/en/2", "example.com/en/", "block"),
            ("https://a.com", "a.com", "", None, None), ("https://a.com/x", "a.com", "/x", "com/", "allow"),
            ("http://b.net/es/7", "b.net", "/es/7", "net/es/", "block"), ("http://bnet/es/7", "bnet", "/es/7", None, "block"),
            ("no scheme/es/", "", "", None, None), (None, "", "", None, None), ("a://b://c/d", "b:", "//c/d", None, "allow")]
    rows = [(i, u[0]) for i, u in enumerate(urls)] + [(100 + i, f"http://h{i % 5}.net/es/{i}") for i in range(60)]
    rows += [(200 + i, f"http://h{i}.org/es/{i}.html") for i in range(5)] + [(300 + i, f"http://h{i}.com/ok/{i}") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit(1), "n": F.lit("x")})
    got = {r["key"]: r for r in url_templates.url_verdicts(pages).collect()}
    assert len(got) == len(rows)
    for i, (_, host, path, rule, verdict) in enumerate(urls):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert verdict is None or got[i]["verdict"] == verdict
    assert {got[200 + i]["verdict"] for i in range(5)} == {"block"} and got[204]["template"] == "/es/*"
    assert url_templates.url_verdicts(pages.limit(0)).collect() == []


def test_edit_counts_equal_whole_encodings(spark):
    rows = awkward()
    rows += [r for r in rows if len(r[1] or "") > 20_000] * 4
    edits = [[], [(0, 0, "start ")], [(3, 5, " x\n"), (1, 0, ""), (9_999_999, 4, " end")], [(None, None, None), (2, 10**6, "!")]]
    kind = "array<struct<at:long,remove:long,insert:string>>"
    frame_ = spark.createDataFrame([(i, r[1], edits[i % 4]) for i, r in enumerate(rows)], f"doc_id long, text string, edits {kind}")
    index = edit_counts.build(frame_, edits="edits")
    got = {r["key"]: r for r in edit_counts.apply_edits(index).collect()}
    assert len(got) == len(rows)
    for i, r in enumerate(rows):
        text = r[1] or ""
        assert got[i]["tokens_before"] == len(library_ids("byte_bpe_50k.json", text, 0)) - 1
        for at, remove, insert in edits[i % 4]:
            at = min(at or 0, len(text))
            text = text[:at] + (insert or "") + text[min(at + (remove or 0), len(text)):]
        assert got[i]["text"] == text and got[i]["chars"][1] == len(text)
        assert got[i]["tokens"][1] == len(library_ids("byte_bpe_50k.json", text, 0)) - 1
    assert max(r["encoded_chars"] for r in got.values() if len(r["text"]) > 20_000) < 8_000
    assert edit_counts.apply_edits(edit_counts.build(frame_.limit(0), edits="edits")).collect() == []
