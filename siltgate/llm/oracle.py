"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

OP2 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages
), g AS (
  SELECT digest, max(page_id) AS newest FROM p WHERE n >= 1000 GROUP BY digest
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN newest IS NULL OR page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN newest IS NOT NULL AND (page_id IS NULL OR page_id <> newest) THEN newest END AS refers_to
FROM p LEFT JOIN g USING (digest)
"""

OP3 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n,
         array_to_string(w[p:p + least(13, len(w)) - 1], ' ') AS span
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS span
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
        FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)
), hits AS (
  SELECT doc_id, p, n, item_id FROM dw JOIN iw USING (n, span)
), words AS (
  SELECT doc_id, count(DISTINCT word_at) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS word_at FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


OP4 = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents
), n AS (
  SELECT rid, doc_id, b, octet_length(b) AS n_bytes FROM d
), w AS (
  SELECT rid, p, hash(b[p + 1:p + 400]) AS h FROM (SELECT rid, b, unnest(range(0, n_bytes - 399)) AS p FROM n WHERE n_bytes >= 400)
), hits AS (
  SELECT rid, p FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)
), marked AS (
  SELECT rid, p, CASE WHEN p > lag(p) OVER (PARTITION BY rid ORDER BY p) + 400 THEN 1 ELSE 0 END AS new FROM hits
), runs AS (
  SELECT rid, p, sum(new) OVER (PARTITION BY rid ORDER BY p) AS run FROM marked
), spans AS (
  SELECT rid, min(p) AS a, max(p) + 400 AS z FROM runs GROUP BY rid, run
), gaps AS (
  SELECT rid, z AS a, lead(a) OVER (PARTITION BY rid ORDER BY a) AS z FROM spans
  UNION ALL SELECT rid, 0, min(a) FROM spans GROUP BY rid
), kept AS (
  SELECT rid, string_agg(hex(b[g.a + 1:coalesce(g.z, n_bytes)]), '' ORDER BY g.a) AS bytes
  FROM gaps g JOIN n USING (rid) WHERE coalesce(g.z, n_bytes) > g.a GROUP BY rid
), wide AS (
  SELECT rid, a - list_position([hex(b[a + 1 - k:a + 1 - k]) NOT BETWEEN '80' AND 'BF' FOR k IN range(0, 4)], true) + 1 AS a,
         z - 1 + list_position([hex(b[z + 1 + k:z + 1 + k]) NOT BETWEEN '80' AND 'BF' FOR k IN range(0, 4)], true) AS z
  FROM spans JOIN n USING (rid)
), parts AS (
  SELECT rid, z AS a, lead(a) OVER (PARTITION BY rid ORDER BY a) AS z FROM wide
  UNION ALL SELECT rid, 0, min(a) FROM wide GROUP BY rid
), left_over AS (
  SELECT rid, string_agg(hex(b[g.a + 1:coalesce(g.z, n_bytes)]), '' ORDER BY g.a) AS chars
  FROM parts g JOIN n USING (rid) WHERE coalesce(g.z, n_bytes) > g.a GROUP BY rid
), cut AS (
  SELECT rid, sum(z - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY rid
)
SELECT doc_id, n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(CASE WHEN n_removed IS NULL THEN b ELSE unhex(coalesce(bytes, '')) END) AS kept_sha256,
       decode(CASE WHEN n_removed IS NULL THEN b ELSE unhex(coalesce(chars, '')) END) AS text
FROM n LEFT JOIN cut USING (rid) LEFT JOIN kept USING (rid) LEFT JOIN left_over USING (rid)
"""


OP11 = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT rid, array_to_string(w[p:p + 3], ' ') AS shingle
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 2, 2))) AS p FROM d WHERE len(w) > 0)
), n AS (
  SELECT rid, count(*) AS size FROM s GROUP BY rid
), shared AS (
  SELECT x.rid AS a, y.rid AS b, count(*) AS common FROM s x JOIN s y ON x.shingle = y.shingle AND x.rid <> y.rid GROUP BY x.rid, y.rid
), link AS (
  SELECT a, b FROM shared JOIN n AS m ON m.rid = a JOIN n AS o ON o.rid = b WHERE 100 * common >= 85 * (m.size + o.size - common)
), reach AS (
  SELECT rid AS a, rid AS b FROM d
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b
)
SELECT d.doc_id, coalesce(n.size, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (rid)
JOIN (SELECT a AS rid, min(t.doc_id) AS component_id FROM reach JOIN d AS t ON t.rid = b GROUP BY a) AS c USING (rid)
"""

OP12 = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), first AS (
  SELECT t, min(doc_id) AS least FROM d GROUP BY t
), words AS (
  SELECT doc_id, part, t, least, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d JOIN first USING (t)
), l AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id
), cells AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n,
         CASE WHEN len(w) < 100 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS mask
  FROM words LEFT JOIN l USING (doc_id) GROUP BY ALL
), letters(c, bit) AS (
  VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), orders AS (
  SELECT a.c || b.c || e.c || f.c || g.c AS filter_order, [a.bit, b.bit, e.bit, f.bit, g.bit] AS bits
  FROM letters a, letters b, letters e, letters f, letters g
  WHERE a.bit + b.bit + e.bit + f.bit + g.bit = 31 AND len(list_distinct([a.bit, b.bit, e.bit, f.bit, g.bit])) = 5
), steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), counted AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS removed,
         coalesce(sum(n) FILTER (mask & before <> 0 AND mask & bit <> 0), 0) AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit <> 0 AND good), 0) AS good_lost,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit <> 0 AND toxic), 0) AS toxic_lost
  FROM cells, steps GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""

OP13 = r"""
WITH RECURSIVE shifts(i, step, v) AS (
  SELECT i, 0, i FROM (SELECT unnest(range(0, 256)) AS i)
  UNION ALL
  SELECT i, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM shifts WHERE step < 8
), crcs AS MATERIALIZED (
  SELECT list(v ORDER BY i) AS t FROM shifts WHERE step = 8
), texts AS (
  SELECT row_number() OVER () AS rid, doc_id, text FROM documents
  UNION ALL SELECT -row_number() OVER (), NULL, text FROM benchmark
), w AS (
  SELECT rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), f AS MATERIALIZED (
  SELECT rid, array_to_string(w[p:p + k - 1], ' ') AS feature
  FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k)
), b AS MATERIALIZED (
  SELECT feature, xor(list_reduce(list_transform(range(0, octet_length(encode(feature))), lambda i: CAST('0x' || substr(hex(encode(feature)), 2 * i + 1, 2) AS BIGINT)),
         lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM f), crcs
), hit AS MATERIALIZED (
  SELECT rid, bucket FROM f JOIN b USING (feature)
), counts AS (
  SELECT bucket, count(*) FILTER (rid > 0) AS s, count(*) FILTER (rid < 0) AS t FROM hit GROUP BY bucket
), totals AS (
  SELECT CAST(count(*) FILTER (rid > 0) AS DOUBLE) AS big_s, CAST(count(*) FILTER (rid < 0) AS DOUBLE) AS big_t FROM hit
), gain AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (big_s + 10000) / ((CAST(s AS DOUBLE) + 1) * (big_t + 10000)))) AS BIGINT) AS g FROM counts, totals
), weights AS (
  SELECT rid, count(*) AS n_features, CAST(sum(g) AS BIGINT) AS weight FROM hit JOIN gain USING (bucket) WHERE rid > 0 GROUP BY rid
), scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM w LEFT JOIN weights USING (rid) WHERE rid > 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place,
         count(*) OVER (PARTITION BY n_words >= 20) * 5 // 100 AS drawn
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= drawn THEN place END AS rank FROM ranked
"""


def statements() -> dict[str, str]:
    return {
        "op2_dictionary_warc": OP2, "op3_winnowing": OP3, "op4_merged_suffixes": OP4,
        "op11_banded_jaccard": OP11, "op12_filter_orders": OP12, "op13_importance_sample": OP13,
    }
