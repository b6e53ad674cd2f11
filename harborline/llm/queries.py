"""Registered queries of the operators, with their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from harborline.llm.common import table


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from harborline.llm.exact_dedup import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents"), keep="max", carry=["doc_id"])


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from harborline.llm.mixing import taken

    return taken(table(spark, sf_dir, "documents")).selectExpr(
        "key AS doc_id", "size", "source_size", "target", "taken")


def op1_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    from harborline.llm.huffman import store_documents

    return store_documents(table(spark, sf_dir, "documents")).selectExpr(
        "key AS doc_id", "start", "n_tokens", "crc32(ids) AS ids_crc32")


def op2_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    from harborline.llm.quality_rules import quality_cascade

    return quality_cascade(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op3_unigram_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from harborline.llm.language_id import identify, remainder

    return identify(table(spark, sf_dir, "documents"), remainder("doc_id", 3) != 1).selectExpr(
        "key AS doc_id", "NOT train AS held_out", "lang_pred", "score")


def op4_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from harborline.llm.language_id import remainder
    from harborline.llm.ppm import score

    return score(table(spark, sf_dir, "documents"), remainder("doc_id", 10) != 0).selectExpr(
        "key AS doc_id", "NOT train AS held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from harborline.llm.url_templates import url_verdicts

    return url_verdicts(table(spark, sf_dir, "pages")).withColumnRenamed("key", "page_id")


def op7_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, edited three times at places that its id determines."""
    from harborline.llm.edit_counts import apply_edits, build

    place = "(crc32(cast(concat_ws(':', doc_id, '{0}') AS binary)) % (char_length(coalesce(text, '')) + 1))"
    docs = table(spark, sf_dir, "documents").withColumn("edits", F.expr(
        "array(" + ", ".join(f"named_struct('at', {place.format(i)}, 'remove', {n}L, 'insert', {insert})" for i, n, insert in (
            (0, 0, "concat(' ', coalesce(source, 'none'), ' ')"), (1, 7, "''"), (2, 3, "'\\n edited'"))) + ")"))
    return apply_edits(build(docs, edits="edits")).selectExpr(
        "key AS doc_id", "tokens_before", "cast(tokens[1] AS bigint) AS tokens_after", "encoded_chars",
        "cast(char_length(text) AS bigint) AS n_chars")


def op8_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from harborline.llm.simhash_trie import simhash_components

    return simhash_components(table(spark, sf_dir, "documents")).selectExpr(
        "key AS doc_id", "lpad(lower(hex(fp)), 16, '0') AS fingerprint", "component_id")


def op10_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from harborline.llm.packing import pack

    return pack(table(spark, sf_dir, "documents")).selectExpr(
        "key AS doc_id", "start", "length", "crc32(ids) AS ids_crc32", "doc_tokens", "sequence_id", "offset")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from harborline.llm.importance import importance_resample

    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).selectExpr(
        "key AS doc_id", "n_features", "weight", "score", "rank")


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from harborline.llm.source_audit import source_audit

    return source_audit(table(spark, sf_dir, "documents"))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from harborline.llm.embedding_dedup import embedding_near_dedup

    return embedding_near_dedup(table(spark, sf_dir, "embeddings")).withColumnRenamed("key", "vec_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_huffman, op2_quality_cascade, op3_unigram_language, op4_ppm, op5_url_templates, op6_mixing, op7_edit_counts, op8_simhash_trie, op9_exact_dedup, op10_nnls_packing,
        op11_importance_resampling, op12_source_audit, op13_embedding_near_dedup)}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_quality_cascade": r"""
            WITH t AS (SELECT doc_id, coalesce(text, '') AS t,
                              list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
                       FROM documents),
            v AS (SELECT row_number() OVER () AS r, * FROM t),
            u AS (SELECT r, i, w[i:i + 4] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM v WHERE len(w) >= 5)),
            d AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM u) WHERE n > 1),
            p AS (SELECT r, sum(least(5, coalesce(nxt - i, 5))) AS n
                  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM d) GROUP BY r),
            l AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup
                  FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM v)
                  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r),
            f AS (SELECT doc_id, t, w, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
                         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
                         coalesce(p.n, 0)::BIGINT AS n_repeat_words
                  FROM v LEFT JOIN l USING (r) LEFT JOIN p USING (r)),
            b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
            SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
                   NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 10 * n_dup_lines > 3 * n_lines
                        OR word_chars < 2 * n_words OR word_chars > 15 * n_words
                        OR 2 * length(regexp_replace(t, '[^A-ZÀ-ÖØ-Þ]', '', 'g'))
                           > length(regexp_replace(t, '[^A-Za-zÀ-ÖØ-öø-ÿ]', '', 'g'))
                        OR 5 * len(regexp_extract_all(t, '!!')) > n_words
                        OR 4 * len(list_distinct(w)) < least(n_words, 100)) AS kept
            FROM b""",
        "op9_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
                   count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
                   doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
                   sha256(coalesce(text, '')) AS text_sha256
            FROM documents""",
        "op11_importance_resampling": r"""
            WITH RECURSIVE bit(i, v, k) AS (
                SELECT i, i::BIGINT, 0 FROM range(256) r(i)
                UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bit WHERE k < 8),
            crc AS (SELECT list(v ORDER BY i) AS t FROM bit WHERE k = 8),
            texts AS (SELECT 'd' AS side, doc_id AS id, row_number() OVER () AS r, text FROM documents
                      UNION ALL SELECT 'b', NULL, row_number() OVER (), text FROM benchmark),
            cut AS (SELECT side, id, r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
            feature AS (SELECT side, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM cut),
            bucket AS (SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, octet_length(encode(f)) + 1), lambda i:
                                  ('0x' || hex(encode(f))[2 * i - 1:2 * i])::BIGINT)),
                              lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 10000 AS b
                       FROM (SELECT DISTINCT f FROM feature), crc),
            n AS (SELECT b, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM feature JOIN bucket USING (f) GROUP BY b),
            gain AS (SELECT b, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
                                               / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS g FROM n),
            mean AS (SELECT r, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight
                     FROM feature JOIN bucket USING (f) JOIN gain USING (b) WHERE side = 'd' GROUP BY r),
            doc AS (SELECT r, id AS doc_id, len(w) AS words, (len(w) + greatest(len(w) - 1, 0))::BIGINT AS n_features, coalesce(weight, 0) AS weight,
                           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
                    FROM cut LEFT JOIN mean USING (r) WHERE side = 'd'),
            able AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS k, count(*) OVER () AS n FROM doc WHERE words >= 20)
            SELECT doc_id, n_features, weight, score, CASE WHEN k <= 25 * n // 100 THEN k END AS rank FROM doc LEFT JOIN able USING (r)""",
        "op12_source_audit": r"""
            WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
            w AS (SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                                                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
            kept AS (SELECT lang, term, count(*) AS m FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
            l AS (SELECT lang, count(*) AS v, sum(m) AS lang_n FROM kept GROUP BY lang),
            c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
            g AS (SELECT DISTINCT lang, source FROM d),
            full_ AS (SELECT lang, source, term, coalesce(n, 0) AS n, m FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
            p AS (SELECT lang, source, term, n,
                         1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p,
                         1 + (1000000000::HUGEINT * (m + 5)) // (lang_n + 5 * v) AS q
                  FROM full_ JOIN l USING (lang)),
            gap AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
                    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
            pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
                     FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
                     LEFT JOIN gap ON gap.lang = a.lang AND gap.source = a.source AND gap.item = b.source),
            both_ AS (SELECT lang, source, 'pair' AS part, item, value FROM pair
                      UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
            ranked AS (SELECT lang, source, part, item, value::BIGINT AS value,
                              row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM both_)
            SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50""",
        "op13_embedding_near_dedup": """
            WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
            ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
                   AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
            link AS (SELECT a.r AS a, b.r AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
                     WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
            reach AS (SELECT r AS a, r AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
            part AS (SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY reach.a),
            n AS (SELECT a AS r, count(*) AS n_links FROM link GROUP BY a)
            SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
            FROM v JOIN part USING (r) LEFT JOIN n USING (r)""",
    }
