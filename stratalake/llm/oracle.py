"""The answers in DuckDB SQL, for the queries that SQL can express."""

OP1 = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""

# Poisson quantile: the number of k whose distribution function is below u. Rates over 16 are split into equal parts.
OP3 = r"""
WITH counts AS (
  SELECT source, count(*) AS n, sqrt(count(*)) AS weight FROM documents GROUP BY source
), rates AS (
  SELECT source, weight * (SELECT sum(n) / sum(weight) FROM counts) / n AS rate FROM counts
), parts AS (
  SELECT source, greatest(ceil(rate / 16), 1)::BIGINT AS m, rate / greatest(ceil(rate / 16), 1) AS r FROM rates
), terms AS (
  SELECT source, k, exp(-r + CASE WHEN k = 0 THEN 0 ELSE k * ln(r) - lgamma(k + 1) END) AS p
  FROM parts, range(0, 96) AS t(k)
), cdf AS (
  SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms
), tables AS (
  SELECT source, list(c ORDER BY k) AS cs FROM cdf GROUP BY source
), keyed AS (
  SELECT *, coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS key FROM documents
), drawn AS (
  SELECT d.*, list_sum(list_transform(range(1, m + 1), lambda j: len(list_filter(cs, lambda c: c <
    ((('0x' || md5('20240601:' || key || ':' || j)[1:13])::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0)))) AS copies
  FROM keyed AS d JOIN parts ON d.source IS NOT DISTINCT FROM parts.source
  JOIN tables ON d.source IS NOT DISTINCT FROM tables.source
), copied AS (
  SELECT *, unnest(range(1, copies::BIGINT + 1)) AS copy FROM drawn
)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy, md5('order:20240601:' || key || ':' || copy) AS order_key FROM copied
"""

# SHA-1 in base32: 40 hex digits are 8 groups of 20 bits, each 4 letters.
OP5 = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
  SELECT page_id, payload_bytes, list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((('0x' || substr(hex, (i // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31))::INT, 1)), 'string_agg', '') AS payload_digest
  FROM p
), g AS (
  SELECT payload_digest, min(page_id) AS first_id FROM d GROUP BY payload_digest
)
SELECT page_id, payload_bytes, d.payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d JOIN g USING (payload_digest)
"""

# Words of items and texts; every window of an item is looked up among the texts' runs of as many words.
OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM (SELECT *, least(10, len(w)) AS m FROM b WHERE len(w) > 0))
), runs AS (
  SELECT r, i, m, array_to_string(w[i:i + m - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM windows))
), found AS (
  SELECT r, i, m, item_id FROM runs JOIN windows USING (m, win)
), hits AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT r, i, m FROM found)) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""

OP11 = r"""
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.r <> b.r WHERE a.vec_id % 50 = 0
), p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, b) <= 5
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.vec_id, s.b)::INTEGER AS rank
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

# Every run of one to four words inside a piece, counted per language; then the cuts of what is frequent.
OP12 = r"""
WITH pieces AS (
  SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM (SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), runs AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, range(1, 5) AS sizes(m) WHERE len(w) >= m)
), n AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang
), f AS (
  SELECT lang, m, phrase, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= 30
), around AS (
  SELECT lang, phrase, max(f) AS most FROM (
    SELECT lang, regexp_replace(phrase, ' [^ ]+$', '') AS phrase, f FROM f WHERE m > 2
    UNION ALL SELECT lang, regexp_replace(phrase, '^[^ ]+ ', ''), f FROM f WHERE m > 2
    UNION ALL SELECT lang, array_to_string(string_split(phrase, ' ')[i:i + 1], ' '), f FROM f, range(1, 4) AS t(i) WHERE m = 4
  ) GROUP BY ALL
), kept AS (
  SELECT f.* FROM f LEFT JOIN around USING (lang, phrase) WHERE m > 1 AND (most IS NULL OR 100 * most::HUGEINT < 80 * f::HUGEINT)
), cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS p, array_to_string(w[k + 1:], ' ') AS q
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM kept)
), scored AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, (2000000 * a::HUGEINT // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM cuts c JOIN f x ON c.lang = x.lang AND c.p = x.phrase JOIN f y ON c.lang = y.lang AND c.q = y.phrase
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS place FROM best
)
SELECT lang, place::INTEGER AS rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE place <= 2000
"""

ORACLE_SQL = {"op1_exact_dedup": OP1, "op3_mix_sources": OP3, "op5_warc": OP5, "op11_hard_negatives": OP11, "op12_collocations": OP12, "op13_decontaminate": OP13}
