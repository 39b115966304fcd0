"""The registered queries of the operators: thin, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_classifier import quality_classifier

    return quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import line_dedup

    return line_dedup(table(spark, sf_dir, "documents"))


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe_codec import digests

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embedding_dedup import embedding_dedup

    return embedding_dedup(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash_dedup import simhash_dedup

    return simhash_dedup(table(spark, sf_dir, "documents"), words=3, bits=3).select("doc_id", "fingerprint", "component_id")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .lm_scoring import lm_scores

    return lm_scores(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .token_output import token_rows

    return token_rows(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .interaction_audit import interaction_audit

    return interaction_audit(spark, f"{sf_dir.rstrip('/')}/documents.parquet", table(spark, sf_dir, "labels"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .phrase_mining import mine_phrases

    return mine_phrases(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_classifier, op2_line_dedup, op3_bpe_codec, op4_embedding_dedup, op5_packing, op6_simhash_dedup, op7_lm_scoring, op8_exact_dedup, op9_token_counts,
        op10_token_output, op11_interaction_audit, op12_quality_rules, op13_phrase_mining, pipeline,
    )
}

ORACLES: dict[str, str] = {
    "op8_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY t)""",
    "op11_interaction_audit": r"""
        WITH l AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic
                   FROM labels GROUP BY doc_id),
        d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part FROM documents),
        w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
        f AS (SELECT part, coalesce(good, false) AS good, coalesce(l.toxic, false) AS toxic,
                     (len(ws) < 50)::INT + 2 * (100 * len(list_distinct(ws)) < 65 * len(ws))::INT
                     + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INT
                     + 8 * regexp_matches(t, '[#$%&*|]')::INT
                     + 16 * coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false)::INT AS mask
              FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
        m AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM f GROUP BY ALL),
        c AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
        o AS (SELECT a.c || b.c || d.c || e.c || f.c AS filter_order FROM c a, c b, c d, c e, c f
              WHERE len(list_distinct([a.c, b.c, d.c, e.c, f.c])) = 5),
        s AS (SELECT filter_order, step, 1 << (ascii(substr(filter_order, step, 1)) - 65) AS own,
                     coalesce(list_sum([1 << (ascii(substr(filter_order, i::INT, 1)) - 65) for i in range(1, step)]), 0)::INT AS earlier
              FROM o, (SELECT unnest(range(1, 6))::INT AS step))
        SELECT part, filter_order, step,
               sum(n * (mask & (own | earlier) = 0)::INT)::BIGINT AS kept,
               sum(n * (mask & own <> 0 AND mask & earlier = 0)::INT)::BIGINT AS removed,
               sum(n * (mask & own <> 0 AND mask & earlier <> 0)::INT)::BIGINT AS redundant,
               sum(n * (mask = own)::INT)::BIGINT AS unique_fails,
               sum(g * (mask & own <> 0 AND mask & earlier = 0)::INT)::BIGINT AS good_lost,
               sum(x * (mask & own <> 0 AND mask & earlier = 0)::INT)::BIGINT AS toxic_lost,
               sum(CASE WHEN mask & own <> 0 THEN n * 120 // bit_count(mask) ELSE 0 END)::BIGINT AS shapley
        FROM m, s GROUP BY part, filter_order, step""",
    "op12_quality_rules": r"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, 'und') AS lang, coalesce(text, '') AS t FROM documents),
        w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
                     list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
                     ('0x' || substr(md5(t), 1, 2))::INT % 64 AS bucket FROM d),
        win AS (SELECT rid, p, ws[p] || ' ' || ws[p + 1] || ' ' || ws[p + 2] AS k FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS p FROM w)),
        twice AS (SELECT rid, p FROM win QUALIFY count(*) OVER (PARTITION BY rid, k) >= 2),
        rep AS (SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS q FROM twice) GROUP BY rid),
        base AS (SELECT w.rid, doc_id, lang, bucket, len(ws)::BIGINT AS n_words,
                        length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
                        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
                 FROM w LEFT JOIN rep USING (rid)),
        plain AS (SELECT rid, lang, bucket, unnest(ws) AS word FROM w),
        common AS (SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS bin FROM plain GROUP BY lang, word
                   QUALIFY bin <= 24),
        cut AS (SELECT rid, lang, bucket, length(regexp_replace(t, '\p{Ll}', '', 'g')) AS r1, length(t) AS r0,
                       regexp_replace(t, '[\p{Ll}\x20\x09-\x0D]', '', 'g') AS u2 FROM w),
        cls AS (SELECT rid, lang, bucket, unnest([1, 2, 3, 4, 5, 6, 7]) AS bin,
                       unnest([r0 - r1, r1 - length(u2), length(u2) - length(u3), length(u3) - length(u4), length(u4) - length(u5),
                               length(u5) - length(u6), length(u6)]) AS v
                FROM (SELECT *, regexp_replace(u2, '\p{Lu}', '', 'g') AS u3, regexp_replace(u2, '[\p{Lu}0-9]', '', 'g') AS u4,
                             regexp_replace(u2, '[\p{Lu}0-9.,;:!?''"()\-]', '', 'g') AS u5,
                             regexp_replace(u2, '[\p{Lu}0-9.,;:!?''"()\-#*$%&|<>@^~=+_/\\{}\[\]`]', '', 'g') AS u6 FROM cut)),
        h AS (SELECT 'c' AS kind, rid, lang, bucket, bin, v::DOUBLE AS v FROM cls
              UNION ALL SELECT 'w', rid, p.lang, bucket, coalesce(bin, 0), count(*)::DOUBLE FROM plain p LEFT JOIN common USING (lang, word) GROUP BY ALL),
        share AS (SELECT kind, lang, bucket, bin, sum(v) / sum(sum(v)) OVER (PARTITION BY kind, lang, bucket) AS s,
                         sum(sum(v)) OVER (PARTITION BY kind, lang, bucket) AS total FROM h GROUP BY kind, lang, bucket, bin),
        nb AS (SELECT kind, lang, count(DISTINCT bucket) AS nb FROM share WHERE total > 0 GROUP BY ALL),
        ref AS (SELECT kind, lang, bin, sum(s) / any_value(nb) AS q FROM share JOIN nb USING (kind, lang) WHERE total > 0 GROUP BY ALL),
        refs AS (SELECT *, count(*) OVER (PARTITION BY kind, lang) AS bins FROM (
                   SELECT * FROM ref UNION ALL SELECT 'w', lang, 0, 0.0 FROM (SELECT DISTINCT lang FROM common)
                   WHERE lang NOT IN (SELECT lang FROM ref WHERE kind = 'w' AND bin = 0))),
        tot AS (SELECT kind, rid, sum(v) AS n FROM h GROUP BY ALL),
        pq AS (SELECT tot.kind, tot.rid, q, bins, coalesce(v, 0) / n AS p
               FROM tot JOIN d USING (rid) JOIN refs r ON r.kind = tot.kind AND r.lang = d.lang
               LEFT JOIN h ON h.kind = tot.kind AND h.rid = tot.rid AND h.bin = r.bin WHERE n > 0),
        js AS (SELECT kind, rid, any_value(bins) AS bins,
                      sqrt(greatest(sum((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
                                         + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2), 0)) AS dist FROM pq GROUP BY ALL),
        j AS (SELECT base.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
                     CASE WHEN word_chars >= 200 THEN c.dist END AS cd, CASE WHEN n_words >= 50 THEN x.dist END AS wd,
                     sqrt(x.bins / greatest(n_words, 1)) / 4 AS slack
              FROM base LEFT JOIN js c ON c.rid = base.rid AND c.kind = 'c' LEFT JOIN js x ON x.rid = base.rid AND x.kind = 'w')
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               round(cd, 6) AS char_distance, round(wd, 6) AS word_distance,
               NOT base_failed AND NOT coalesce(cd > 0.25, false) AND NOT coalesce(wd > 0.30 + slack, false) AS kept FROM j""",
    "op13_phrase_mining": r"""
        WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
                   FROM documents),
        p AS (SELECT lang, list_filter(string_split_regex(unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')), '[\x20\x09]+'), lambda x: x <> '') AS ws FROM d),
        i AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM p),
        g AS (SELECT lang, unnest([1, 2, 3]) AS k, ws, i, len(ws) - i + 1 AS room FROM i),
        f AS (SELECT lang, k, ws[i] AS w1, CASE WHEN k > 1 THEN ws[i + 1] ELSE '' END AS w2, CASE WHEN k > 2 THEN ws[i + 2] ELSE '' END AS w3, count(*) AS f
              FROM g WHERE room >= k GROUP BY ALL),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
        one AS (SELECT lang, w1, f FROM f WHERE k = 1), two AS (SELECT lang, w1, w2, f FROM f WHERE k = 2),
        three AS (SELECT lang, w1, w2, w3, f FROM f WHERE k = 3 AND f >= 10),
        around AS (SELECT lang, w1, w2, max(f) AS longer FROM (SELECT lang, w1, w2, f FROM three UNION ALL SELECT lang, w2, w3, f FROM three) GROUP BY ALL),
        c2 AS (SELECT two.lang, two.w1 || ' ' || two.w2 AS phrase, two.f AS a, x.f AS l, y.f AS r,
                      (1000000 * two.f::HUGEINT * two.f // (x.f::HUGEINT * y.f))::BIGINT AS score
               FROM two JOIN one x ON x.lang = two.lang AND x.w1 = two.w1 JOIN one y ON y.lang = two.lang AND y.w1 = two.w2
               LEFT JOIN around z ON z.lang = two.lang AND z.w1 = two.w1 AND z.w2 = two.w2
               WHERE two.f >= 10 AND 100 * coalesce(longer, 0) < 50 * two.f),
        t3 AS (SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 AS phrase, t.f AS a, a1.f AS l1, b1.f AS r1, a2.f AS l2, b2.f AS r2,
                      (1000000 * t.f::HUGEINT * t.f // (a1.f::HUGEINT * b1.f))::BIGINT AS s1, (1000000 * t.f::HUGEINT * t.f // (a2.f::HUGEINT * b2.f))::BIGINT AS s2
               FROM three t JOIN one a1 ON a1.lang = t.lang AND a1.w1 = t.w1 JOIN two b1 ON b1.lang = t.lang AND b1.w1 = t.w2 AND b1.w2 = t.w3
               JOIN two a2 ON a2.lang = t.lang AND a2.w1 = t.w1 AND a2.w2 = t.w2 JOIN one b2 ON b2.lang = t.lang AND b2.w1 = t.w3),
        u AS (SELECT * FROM c2 UNION ALL
              SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM t3)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM u JOIN n USING (lang) QUALIFY rank <= 2000""",
}
