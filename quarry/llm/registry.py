"""Queries of the corpus operators, each over its whole table, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import chat, decontam, exact, jaccard, langid, lines, mixing, pages, phrases, quality, search, suffix, trie
from quarry.llm.common import held_out, table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        decontam.items_digest("items").alias("items_sha256"), "contaminated")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents")).drop("removed")


def op3_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = chat.rotate_perspectives(table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("mask", lambda m: F.concat_ws("-", m["start"], m["end"])), ",")
    return views.select("conv_id", "participant", "segment", "n_turns", "n_chars", "n_masked", "rendered", spans.alias("mask"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = quality.learn(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs.select("doc_id", "text", "n_chars"), machine)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_repeated_lines(table(spark, sf_dir, "documents")).drop("kept_text")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.jaccard_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op7_extract_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages")
    return pages.extract_main_text(rows.select("page_id", "url", "html"), pages.learn(rows))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", F.coalesce("source_size", F.lit(0)).alias("source_size"), "target", "taken", "copies", "source")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(trie.share_openings(trie.turn_sequences(table(spark, sf_dir, "conversations"))))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search.exact_top_k(vectors, vectors.filter("vec_id % 100 = 0"))


QUERIES = {f.__name__: f for f in (
    op1_decontaminate, op2_suffix_dedup, op3_chat_perspectives, op4_quality, op5_line_dedup, op6_jaccard_join, op7_extract_main_text,
    op8_mix_sources, op9_exact_dedup, op10_language_id, op11_prefix_trie, op12_collocations, op13_exact_top_k)}

ORACLE_SQL = {
    "op3_chat_perspectives": """
        WITH m AS (
          SELECT conv_id, replace(coalesce(role, 'unknown'), '<|', '< |') AS role, replace(coalesce(text, ''), '<|', '< |') AS text,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST) - 1 AS pos
          FROM conversations),
        p AS (SELECT DISTINCT conv_id, role AS participant FROM m WHERE role <> 'system'),
        v AS (
          SELECT m.conv_id, participant, pos // 512 AS segment, pos, role = participant AS own, text,
                 '<|im_start|>' || CASE WHEN role = participant THEN 'assistant' WHEN role = 'system' THEN 'system'
                                        ELSE 'user name=' || role END || chr(10) AS head
          FROM m JOIN p ON m.conv_id IS NOT DISTINCT FROM p.conv_id),
        s AS (
          SELECT *, length(head) + length(text) + 11 AS n,
                 sum(length(head) + length(text) + 11) OVER (PARTITION BY conv_id, participant, segment ORDER BY pos) AS upto
          FROM v)
        SELECT conv_id, participant, segment, count(*) AS n_turns, CAST(sum(n) AS BIGINT) AS n_chars,
               CAST(coalesce(sum(length(text) + 10) FILTER (own), 0) AS BIGINT) AS n_masked,
               string_agg(head || text || '<|im_end|>' || chr(10), '' ORDER BY pos) AS rendered,
               coalesce(string_agg(CAST(CAST(upto - n + length(head) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(upto - 1 AS BIGINT) AS VARCHAR), ',' ORDER BY pos)
                        FILTER (own), '') AS mask
        FROM s GROUP BY conv_id, participant, segment""",
    "op5_line_dedup": r"""
        WITH x AS (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text <> ''),
        l AS (SELECT doc_id, unnest(x) AS line, unnest(range(len(x))) AS pos FROM x),
        t AS (SELECT *, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS t FROM l),
        y AS (SELECT *, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS w FROM t WHERE t <> ''),
        s AS (SELECT doc_id, pos, t, w, row_number() OVER d AS seq, lead(t, 1) OVER d AS t2, lead(t, 2) OVER d AS t3,
                     coalesce(lead(w, 1) OVER d, 0) AS w2, coalesce(lead(w, 2) OVER d, 0) AS w3
              FROM y WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
        v AS (SELECT doc_id, seq, 1 AS n, [t] AS c FROM s WHERE w >= 8
              UNION ALL SELECT doc_id, seq, 2, [t, t2] FROM s WHERE t2 IS NOT NULL AND w + w2 >= 8 AND least(w, w2) < 8
              UNION ALL SELECT doc_id, seq, 3, [t, t2, t3] FROM s WHERE t3 IS NOT NULL AND least(w + w2, w2 + w3) < 8
              UNION ALL SELECT doc_id, seq, if(t2 IS NULL, 1, 2), ['', '', t, coalesce(t2, '')] FROM s WHERE seq = 1 AND t3 IS NULL AND w + w2 < 8),
        p AS (SELECT *, first_value(doc_id) OVER k AS d0, first_value(seq) OVER k AS s0 FROM v WINDOW k AS (PARTITION BY c ORDER BY doc_id, seq)),
        e AS (SELECT DISTINCT doc_id, unnest(range(seq, seq + n)) AS seq FROM p WHERE doc_id <> d0 OR seq >= s0 + n),
        g AS (SELECT doc_id, pos, seq, e.seq IS NOT NULL AS gone FROM s LEFT JOIN e USING (doc_id, seq)),
        r AS (SELECT doc_id, pos, gone, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY seq), false) AS run FROM g),
        k AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_deleted, count(*) FILTER (run) AS n_runs,
                     coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT coalesce(gone, false)), '') AS kept
              FROM t LEFT JOIN r USING (doc_id, pos) GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted, coalesce(n_runs, 0) AS n_runs,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM documents d LEFT JOIN k USING (doc_id)""",
    "op9_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM t""",
    "op11_prefix_trie": r"""
        WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos, struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) AS m
                   FROM conversations WHERE conv_id IS NOT NULL),
        o AS (SELECT c, list(m ORDER BY pos) AS own FROM t GROUP BY c),
        h AS (SELECT *, c - c % 5 AS donor, (xor(4294967295, list_reduce(list_transform(range(1, length(CAST(c AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(c AS VARCHAR)[i]) AS BIGINT)),
                     lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda i: CAST(i AS BIGINT))),
                                              lambda z, i: xor(z // 2, CASE WHEN z % 2 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)) % 9) AS h FROM o),
        p AS (SELECT h.c, list_concat(coalesce(d.own, [])[1:h.h], h.own[h.h + 1:]) AS path FROM h LEFT JOIN o d ON d.c = h.donor),
        e AS (SELECT c, path, unnest(range(len(path) + 1)) AS d FROM p),
        m AS (SELECT c, d, path[1:d] AS k, len(path) = d AS ends FROM e),
        n AS (SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM m GROUP BY k, d),
        u AS (SELECT n.*, q.conv_id AS parent_conv_id, CASE WHEN n.d = 0 THEN 0 ELSE (n.n_convs - 1) * strlen(n.k[n.d].x) END AS saved,
                     (SELECT count(*) FROM n y WHERE y.d = n.d + 1 AND y.k[1:n.d] = n.k) AS n_children
              FROM n LEFT JOIN n q ON q.d = n.d - 1 AND q.k = n.k[1:n.d - 1]),
        a AS (SELECT k, d, saved, n_children = 0 AS leaf, unnest(range(d + 1)) AS up FROM u),
        s AS (SELECT k[1:up] AS k, up, sum(saved) AS saved_tokens, count(*) FILTER (leaf) AS n_leaves FROM a GROUP BY 1, 2)
        SELECT u.conv_id, u.d AS depth, u.parent_conv_id, u.n_convs, u.n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, u.ends_sha256
        FROM u JOIN s ON s.up = u.d AND s.k = u.k""",
    "op12_collocations": r"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                          unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
        w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
        g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s FROM w, range(1, 5) r(k) WHERE len(w) >= k),
        f AS (SELECT lang, k, s, count(*) AS f FROM g GROUP BY lang, k, s),
        n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS (SELECT lang, k, s, f AS a, string_split(s, ' ') AS w FROM f WHERE k > 1 AND f >= 30),
        t AS (SELECT c.*, cut, x.f AS l, y.f AS r, CAST(CAST(2000000 AS HUGEINT) * a // (x.f + y.f) AS BIGINT) AS score
              FROM c, range(1, 4) z(cut) JOIN f x ON x.lang = c.lang AND x.s = array_to_string(c.w[1:cut], ' ') JOIN f y ON y.lang = c.lang AND y.s = array_to_string(c.w[cut + 1:], ' ')
              WHERE cut < c.k QUALIFY row_number() OVER (PARTITION BY c.lang, c.s ORDER BY score, cut) = 1),
        i AS (SELECT lang, a AS longer, array_to_string(w[j:j + m - 1], ' ') AS s FROM c, range(2, 4) x(m), range(1, 4) y(j) WHERE m < k AND j + m - 1 <= k),
        d AS (SELECT lang, s, max(longer) AS longer FROM i GROUP BY lang, s)
        SELECT t.lang, row_number() OVER (PARTITION BY t.lang ORDER BY score DESC, a DESC, t.s) AS rank, t.s AS phrase, a, l, r, CAST(n AS BIGINT) AS n, score
        FROM t JOIN n ON n.lang = t.lang LEFT JOIN d ON d.lang = t.lang AND d.s = t.s
        WHERE longer IS NULL OR CAST(100 AS HUGEINT) * longer < CAST(80 AS HUGEINT) * a
        QUALIFY rank <= 2000""",
    "op13_exact_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
                   WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
              FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 100 = 0)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
        QUALIFY rank <= 10""",
}
