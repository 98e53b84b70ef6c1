"""DuckDB SQL for the queries that SQL can express."""

ORACLE: dict[str, str] = {
    "op8_exact_dedup": """
        WITH n AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, text_sha256
        FROM n WINDOW same AS (PARTITION BY text_sha256)
    """,
    "op4_sharding": """
        WITH RECURSIVE
        jump(doc_id, shards, state, placed, going) AS (
            SELECT doc_id, n, doc_id::HUGEINT, 0::BIGINT, true FROM documents, (VALUES (16), (17)) s(n)
            UNION ALL
            SELECT doc_id, shards, state, CASE WHEN jumped < shards THEN jumped ELSE placed END, jumped < shards
            FROM (
                SELECT doc_id, shards, state, placed,
                       floor((placed + 1) * (2147483648.0::DOUBLE / ((state // 8589934592)::DOUBLE + 1)))::BIGINT AS jumped
                FROM (
                    SELECT doc_id, shards, placed,
                           (state * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT AS state
                    FROM jump WHERE going
                )
            )
        ),
        shards_of AS (
            SELECT doc_id, max(placed) FILTER (shards = 16)::INT AS shard, max(placed) FILTER (shards = 17)::INT AS grown_shard
            FROM jump GROUP BY doc_id
        ),
        crc(step, bits, value) AS (
            SELECT 0, b, b FROM range(256) r(b)
            UNION ALL
            SELECT step + 1, bits, xor(value >> 1, CASE WHEN value & 1 = 1 THEN 3988292384 ELSE 0 END)
            FROM crc WHERE step < 8
        ),
        crc_table AS (SELECT list(value ORDER BY bits) AS t FROM crc WHERE step = 8),
        bytes AS (
            SELECT doc_id, 'text' AS of, hex(encode(coalesce(text, ''))) AS h FROM documents
            UNION ALL SELECT doc_id, 'id', hex(encode(doc_id::VARCHAR)) FROM documents
        ),
        sums AS (
            SELECT doc_id, of, length(h) // 2 + 1 AS size,
                   xor(list_reduce(
                       list_prepend(4294967295::BIGINT,
                                    list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::BIGINT)),
                       lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1])), 4294967295) AS crc
            FROM bytes, crc_table
        )
        SELECT doc_id, x.size::BIGINT AS size, x.crc::BIGINT AS text_crc32, 'key' AS law, shard,
               (row_number() OVER (PARTITION BY shard ORDER BY i.crc % 256, doc_id) - 1)::BIGINT AS slot, grown_shard
        FROM (FROM sums WHERE of = 'text') x JOIN (FROM sums WHERE of = 'id') i USING (doc_id)
        JOIN shards_of USING (doc_id)
    """,
    "op5_embedding_dedup": """
        WITH RECURSIVE
        v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
              AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ),
        link AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_cosine_similarity(a.e, b.e) >= 0.95
        ),
        reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
        least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
        n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, b) AS component_id,
               vec_id = least(vec_id, b) AS kept
        FROM embeddings LEFT JOIN least ON vec_id = least.a LEFT JOIN n ON vec_id = n.a
    """,
    "op3_jaccard_join": """
        WITH RECURSIVE
        w AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x20\\x09-\\x0D]+') AS words
            FROM documents
        ),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
            FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)
        ),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        both_have AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
            FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
        ),
        link AS (
            SELECT a, b FROM both_have JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * c >= 80 * (x.n + y.n - c)
        ),
        reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
        least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
        SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(w.doc_id, b) AS component_id
        FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN least ON w.doc_id = a
    """,
    "op13_quality_rules": """
        WITH
        w AS (
            SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
            FROM documents
        ),
        placed AS (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
        windows AS (
            SELECT r, i, count(*) OVER (PARTITION BY r, five) AS times
            FROM (
                SELECT r, i, lead(i, 4) OVER one AS last,
                       concat_ws(' ', word, lead(word) OVER one, lead(word, 2) OVER one, lead(word, 3) OVER one,
                                 lead(word, 4) OVER one) AS five
                FROM placed WINDOW one AS (PARTITION BY r ORDER BY i)
            ) WHERE last IS NOT NULL
        ),
        again AS (
            SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS place FROM windows WHERE times > 1)
            GROUP BY r
        ),
        lines AS (
            SELECT r, count(*) - count(DISTINCT line) AS n
            FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM w)
            WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r
        ),
        base AS (
            SELECT r, doc_id, lang, t, words, len(words)::BIGINT AS n_words,
                   length(array_to_string(words, ''))::BIGINT AS word_chars,
                   length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
                   coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(again.n, 0)::BIGINT AS n_repeat_words,
                   len(words) < 10 OR 100 * coalesce(again.n, 0) > 20 * len(words) AS base_failed
            FROM w LEFT JOIN lines USING (r) LEFT JOIN again USING (r)
        ),
        word AS (
            SELECT r, lang, base_failed, translate(unnest(words), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM base
        ),
        class(kind, pattern) AS (
            VALUES (0, '[^a-z]+'), (1, '[^A-Z]+'), (2, '[^0-9]+'), (3, '[^ \\x09]+'), (4, '[^\\x0A-\\x0D]+'), (5, '[^.,;:!?]+'),
                   (6, '[^#*$%&|<>]+'), (7, '[^''"()\\-]+'),
                   (8, '[a-zA-Z0-9 \\x09-\\x0D.,;:!?#*$%&|<>''"()\\-]+|[^\\x00-\\x7F]+'), (9, '[\\x00-\\x7F]+')
        ),
        shape AS (SELECT r, lang, base_failed, kind, length(regexp_replace(t, pattern, '', 'g')) AS n FROM base, class),
        lang_word AS (SELECT lang, key, count(*) AS n FROM word WHERE NOT base_failed AND lang IS NOT NULL GROUP BY ALL),
        lang_total AS (SELECT lang, sum(n) AS total FROM lang_word GROUP BY lang),
        ref AS (
            SELECT lang AS ref, total FROM lang_total
            WHERE total >= 1000 AND total >= 0.001 * (SELECT sum(total) FROM lang_total)
        ),
        common AS (
            SELECT ref, key, n / total AS q
            FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, key) AS place FROM lang_word) JOIN ref ON lang = ref
            WHERE place <= 100
        ),
        bin AS (SELECT * FROM common UNION ALL SELECT ref, NULL, 1 - sum(q) FROM common GROUP BY ref),
        shape_ref AS (
            SELECT ref, kind, sum(n) / sum(sum(n)) OVER (PARTITION BY ref) AS q
            FROM shape JOIN ref ON lang = ref WHERE NOT base_failed GROUP BY ref, kind
        ),
        pair AS (
            SELECT r, n_words, word_chars, ref FROM base JOIN ref ON lang = ref
            UNION ALL
            SELECT r, n_words, word_chars, ref FROM base, ref WHERE lang IS NULL OR lang NOT IN (SELECT ref FROM ref)
        ),
        in_bin AS (
            SELECT r, pair.ref, common.key, count(*) AS n
            FROM pair JOIN word USING (r) LEFT JOIN common ON common.ref = pair.ref AND common.key = word.key GROUP BY ALL
        ),
        word_pq AS (
            SELECT pair.r, pair.ref, coalesce(in_bin.n, 0) / n_words AS p, q
            FROM pair JOIN bin USING (ref)
            LEFT JOIN in_bin ON in_bin.r = pair.r AND in_bin.ref = pair.ref AND in_bin.key IS NOT DISTINCT FROM bin.key
            WHERE n_words > 0
        ),
        shape_pq AS (
            SELECT r, ref, n / sum(n) OVER (PARTITION BY r, ref) AS p, q
            FROM pair JOIN shape USING (r) JOIN shape_ref USING (ref, kind) WHERE n_words > 0
        ),
        apart AS (
            SELECT r, ref, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
                               + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2 AS d, what
            FROM (SELECT *, 'word' AS what FROM word_pq UNION ALL SELECT *, 'shape' FROM shape_pq) GROUP BY r, ref, what
        ),
        nearest AS (
            SELECT r, sqrt(greatest(min(d) FILTER (what = 'word'), 0)) AS words_apart,
                   sqrt(greatest(min(d) FILTER (what = 'shape'), 0)) AS shapes_apart
            FROM apart GROUP BY r
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed
               AND NOT coalesce(n_words >= 50 AND words_apart > 0.35 + 1.0 / sqrt(greatest(n_words, 1)), false)
               AND NOT coalesce(word_chars >= 200 AND shapes_apart > 0.2 + 1.0 / sqrt(greatest(n_words, 1)), false) AS kept
        FROM base LEFT JOIN nearest USING (r)
    """,
    "op11_collocations": """
        WITH
        piece AS (
            SELECT row_number() OVER () AS p, lang, piece FROM (
                SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[.,;:!?\\x0A-\\x0D]')) AS piece
                FROM documents
            )
        ),
        word AS (
            SELECT p, lang, unnest(words) AS w1, unnest(range(1, len(words) + 1)) AS i
            FROM (SELECT p, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM piece)
        ),
        lead_words AS (
            SELECT lang, w1, lead(w1) OVER one AS w2, lead(w1, 2) OVER one AS w3, lead(w1, 3) OVER one AS w4,
                   lead(w1, 4) OVER one AS w5
            FROM word WINDOW one AS (PARTITION BY p ORDER BY i)
        ),
        phrase AS (
            SELECT lang, words, count(*) AS f
            FROM (
                SELECT lang, [w1] AS words FROM lead_words
                UNION ALL SELECT lang, [w1, w2] FROM lead_words WHERE w2 IS NOT NULL
                UNION ALL SELECT lang, [w1, w2, w3] FROM lead_words WHERE w3 IS NOT NULL
                UNION ALL SELECT lang, [w1, w2, w3, w4] FROM lead_words WHERE w4 IS NOT NULL
                UNION ALL SELECT lang, [w1, w2, w3, w4, w5] FROM lead_words WHERE w5 IS NOT NULL
            ) GROUP BY lang, words
        ),
        total AS (SELECT lang, count(*) AS n FROM word GROUP BY lang),
        candidate AS (SELECT lang, words, f AS a FROM phrase WHERE len(words) >= 2 AND f >= 100),
        frequent AS (SELECT lang, array_to_string(words, ' ') AS phrase, f FROM phrase WHERE f >= 100),
        cut AS (
            SELECT lang, words, a, k, array_to_string(words[:k], ' ') AS lhs, array_to_string(words[k + 1:], ' ') AS rhs
            FROM (SELECT lang, words, a, unnest(range(1, len(words))) AS k FROM candidate)
        ),
        scored AS (
            SELECT c.lang, c.words, a, k, x.f AS l, y.f AS r, n, (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
            FROM cut c JOIN frequent x ON x.lang = c.lang AND x.phrase = lhs
            JOIN frequent y ON y.lang = c.lang AND y.phrase = rhs JOIN total t ON t.lang = c.lang
        ),
        best AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
        ),
        inside AS (
            SELECT lang, array_to_string(words[i:j], ' ') AS phrase, max(a) AS a
            FROM (SELECT lang, words, a, unnest(range(1, len(words) + 1)) AS i FROM candidate), range(1, 6) t(j)
            WHERE j > i AND j <= len(words) AND j - i + 1 < len(words) GROUP BY ALL
        ),
        kept AS (
            SELECT b.lang, b.phrase, b.a, l, r, n, score
            FROM (SELECT *, array_to_string(words, ' ') AS phrase FROM best) b LEFT JOIN inside USING (lang, phrase)
            WHERE inside.a IS NULL OR 100 * inside.a < 100 * b.a
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
               a, l, r, n, score::BIGINT AS score
        FROM kept QUALIFY rank <= 2000
    """,
    "op12_ranked_search": """
        WITH
        raw AS (
            SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
            FROM documents
        ),
        bag AS (SELECT r, doc_id, term, count(*) AS tf FROM raw GROUP BY ALL),
        doc AS (SELECT r, sum(tf)::BIGINT AS n FROM bag GROUP BY r),
        corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM doc),
        sized AS (SELECT r, 10 + (90 * n * docs) // terms AS m FROM doc, corpus),
        weight AS (
            SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM bag, corpus GROUP BY term, docs
        ),
        item AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
            FROM benchmark
        ),
        scored AS (
            SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
            FROM item JOIN weight USING (term) JOIN bag USING (term) JOIN sized USING (r) GROUP BY item_id, r, doc_id
        )
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 10
    """,
}
