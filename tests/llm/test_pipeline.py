"""The stages of the corpus pipeline, each on its own input, against plain Python."""

from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from harborline.llm import mixing, queries
from tests.llm.helpers import SCHEMA, awkward, frame, words

STAGES = dict(corpus_pipeline.STAGES)


def rows_of(df):
    return [tuple(r) for r in df.select(*SCHEMA.fieldNames()).collect()]


@pytest.fixture(scope="module")
def documents():
    return awkward(seed=5)


def test_the_stages_come_in_order():
    assert list(STAGES) == ["quality_rules", "exact_dedup", "simhash_near_dedup", "source_mixing", "packing"]


def test_quality_keeps_whole_rows_that_pass(spark, documents):
    got = rows_of(STAGES["quality_rules"](spark, frame(spark, documents), ""))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in documents])
    judged = con.execute(f"SELECT doc_id, n_words, kept FROM ({queries.oracle_sql()['op2_quality_cascade']})").fetchall()
    assert Counter((r[0], len(words(r[1]))) for r in got) == Counter((k, n) for k, n, kept in judged if kept)
    assert not Counter(got) - Counter(documents) and 0 < len(got) < len(documents)


def test_exact_keeps_the_smallest_id_of_each_text(spark, documents):
    got = rows_of(STAGES["exact_dedup"](spark, frame(spark, documents), ""))
    best = defaultdict(list)
    for r in documents:
        best[r[1] or ""].append(r[0])
    smallest = {t: min((k for k in keys if k is not None), default=None) for t, keys in best.items()}
    assert Counter((r[0], r[1] or "") for r in got) == Counter((k, t) for t, k in smallest.items())


def test_near_keeps_one_of_a_family(spark, documents):
    got = rows_of(STAGES["simhash_near_dedup"](spark, frame(spark, documents), ""))
    family = [r[0] for r in documents if r[1] and "edit" in r[1] and len(words(r[1])) >= 399]
    assert len(family) == 12 and sorted(k for k, *_ in got if k in family)[:1] == [min(family)]
    assert len([k for k, *_ in got if k in family]) == 1


def test_mix_takes_words_of_their_document_in_order(spark, documents):
    """Every row's words are some of its document's, in order, and add up to what the mix takes of it."""
    keyed = [(i, *r[1:]) for i, r in enumerate(documents)]
    docs = frame(spark, keyed)
    taken = {r["key"]: r["taken"] for r in mixing.taken(docs).collect()}
    drawn = Counter()
    for r in STAGES["source_mixing"](spark, docs, "").collect():
        left = iter(words(keyed[r["doc_id"]][1]))
        assert all(w in left for w in words(r["text"])), r["doc_id"]
        assert r["n_chars"] == len(r["text"])
        drawn[r["doc_id"]] += len(words(r["text"]))
    assert drawn == {k: n for k, n in taken.items() if n}
    assert all(n <= 2 * len(words(keyed[k][1])) for k, n in drawn.items())


def test_pack_places_every_id_once(spark, documents):
    keyed = [(i, *r[1:]) for i, r in enumerate(documents)]
    pieces = STAGES["packing"](spark, frame(spark, keyed), "").collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append((p["start"], p["length"], p["doc_tokens"]))
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    assert set(by_doc) == set(range(len(keyed)))
    for spans, total in ((sorted(x), 2048) for x in by_sequence.values()):
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and sum(spans[-1]) <= total
    for spans in map(sorted, by_doc.values()):
        assert spans[0][0] == 0 and all(a + n == b for (a, n, _), (b, _, _) in zip(spans, spans[1:]))
        assert sum(spans[-1][:2]) == spans[0][2]


def test_stages_of_no_documents(spark):
    for name, stage in STAGES.items():
        assert stage(spark, frame(spark, []), "").count() == 0, name
