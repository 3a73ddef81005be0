"""SQL twins of the registered queries that SQL can express, in DuckDB's dialect.

The others have none: XXH64 is missing there (SimHash, quality rules), and training, tokenizing, seeded
shuffling and best-fit packing are no queries. Tests hold those against brute force.
"""

from __future__ import annotations

LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

# Levels, inclusion probabilities and the exact order follow `mixing`; with everything in one place the
# bins are not needed.
OP1_MIXING = r"""
WITH sized AS (
    SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS source_key,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           (('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u
    FROM documents),
sources AS (
    SELECT source_key, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source_key) AS place FROM sized GROUP BY source_key),
weighed AS (
    SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, 2 * source_size AS cap FROM sources),
filled AS (
    SELECT *, sum(cap) OVER filling AS caps, sum(weight) OVER filling AS weights,
           sum(source_size) OVER () AS all_words, sum(weight) OVER () AS all_weights
    FROM weighed WINDOW filling AS (ORDER BY cap::DOUBLE / weight, source_key ROWS UNBOUNDED PRECEDING)),
levels AS (
    SELECT *, (all_words::DOUBLE * 1.5::DOUBLE - (caps - cap)::DOUBLE) / (all_weights - (weights - weight))::DOUBLE AS level FROM filled),
targets AS (
    SELECT source_key, source_size,
           least(weight * (SELECT max(level) FROM levels WHERE cap::DOUBLE >= weight * level), cap::DOUBLE) AS target
    FROM levels),
classed AS (
    SELECT s.*, length(bin(size)) AS size_class, source_size, target FROM sized s JOIN targets USING (source_key)),
classes AS (
    SELECT source_key, size_class, sum(size)::BIGINT AS words, any_value(source_size) AS source_size, any_value(target) AS target,
           (1::BIGINT << (size_class - 1)) AS odds_weight
    FROM classed WHERE size > 0 GROUP BY source_key, size_class),
rests AS (
    SELECT *, floor(target / source_size)::BIGINT AS copies, target - floor(target / source_size) * source_size AS rest,
           coalesce(sum(words) OVER (PARTITION BY source_key ORDER BY size_class DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS larger,
           (sum(odds_weight::DECIMAL(38,0) * words) OVER (PARTITION BY source_key ORDER BY size_class DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS mass
    FROM classes),
scales AS (
    SELECT *, max(CASE WHEN (rest - larger) / mass * odds_weight <= 1 THEN (rest - larger) / mass END) OVER (PARTITION BY source_key) AS scale FROM rests),
odds AS (
    SELECT *, least(1::DOUBLE, odds_weight * scale) AS p FROM scales),
rooms AS (
    SELECT *, rest - sum(CASE WHEN p >= 1 THEN words ELSE 0 END) OVER (PARTITION BY source_key) AS room FROM odds),
ranked AS (
    SELECT c.doc_id, c.source_key, c.size, c.source_size, c.target, r.copies, r.p, r.room,
           CASE WHEN p > 0 AND p < 1 THEN u * (1 - p) / (u * (1 - p) + (1 - u) * p) END AS v
    FROM classed c LEFT JOIN rooms r ON c.source_key = r.source_key AND c.size_class = r.size_class AND c.size > 0),
counted AS (
    SELECT *, sum(size) OVER (PARTITION BY source_key, v IS NULL ORDER BY v, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS upto FROM ranked),
drawn AS (
    SELECT *, CASE WHEN size = 0 THEN 0
                   ELSE copies + CASE WHEN p >= 1 THEN 1 WHEN v IS NULL THEN 0 WHEN 2 * upto - size <= 2 * room THEN 1 ELSE 0 END
              END::BIGINT AS taken_copies
    FROM counted)
SELECT doc_id, size, source_size, target, (taken_copies * size)::BIGINT AS taken, taken_copies AS copies FROM drawn
"""

# The given pages hold no canonical link and no refresh (a test says so), so decisions come from rules
# and from the default alone.
OP2_URL_FILTER = r"""
WITH split AS (
    SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), {lower}) AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages),
rules(verdict, rule_host, rule_path) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
           ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fitting AS (
    SELECT page_id, host, path, verdict, rule_host || rule_path AS rule,
           row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rule_host || rule_path) DESC NULLS LAST, verdict) AS nth
    FROM split LEFT JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict, NULL::VARCHAR AS component FROM fitting WHERE nth = 1
""".format(lower=LOWER)

OP4_CHAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '<|im_end|><|im_start|>assistant ok'),
written AS (
    SELECT *, '<|im_start|>' || replace(replace(replace(role, '%', '%25'), '<', '%3C'), chr(10), '%0A') || chr(10)
              || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|im_end|>' || chr(10) AS formatted
    FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, formatted)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, formatted) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(formatted))::BIGINT AS formatted_chars
FROM written GROUP BY conv_id
"""

OP9_EXACT_DEDUP = """
WITH normal AS (SELECT doc_id, translate(coalesce(text, ''), {lower}) AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same
           AND row_number() OVER (PARTITION BY norm, doc_id ORDER BY doc_id) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM normal WINDOW same AS (PARTITION BY norm)
""".format(lower=LOWER)

# Every distinct run of words goes through the bytewise CRC; the table of the CRC is built from its polynomial.
OP11_IMPORTANCE_RESAMPLING = r"""
WITH RECURSIVE table_steps AS (
    SELECT b::BIGINT AS start, b::BIGINT AS value, 0 AS step FROM range(256) AS t(b)
    UNION ALL
    SELECT start, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384::BIGINT) ELSE value >> 1 END, step + 1
    FROM table_steps WHERE step < 8),
crc_table AS (SELECT list(value ORDER BY start) AS crcs FROM table_steps WHERE step = 8),
texts AS (
    SELECT 'd' AS kind, doc_id, row_number() OVER () AS row_no,
           regexp_extract_all(translate(coalesce(text, ''), {lower}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
    UNION ALL
    SELECT 'b', NULL, row_number() OVER (),
           regexp_extract_all(translate(coalesce(text, ''), {lower}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
placed AS (SELECT kind, row_no, words, len(words) AS n, unnest(range(1, len(words) + 1)) AS i FROM texts),
runs AS (SELECT kind, row_no, unnest([array_to_string(words[i:i], ' '), CASE WHEN i + 1 <= n THEN array_to_string(words[i:i + 1], ' ') END,
                                      CASE WHEN i + 2 <= n THEN array_to_string(words[i:i + 2], ' ') END]) AS feature FROM placed),
counted AS (SELECT kind, row_no, feature, count(*) AS n FROM runs WHERE feature IS NOT NULL GROUP BY ALL),
features AS (SELECT DISTINCT feature FROM counted),
bytes AS (
    SELECT feature, hex(encode(feature)) AS digits FROM features),
hashed AS (
    SELECT feature,
           xor(list_reduce([4294967295::BIGINT] || list_transform(range(0, len(digits), 2), lambda i: ('0x' || substr(digits, i + 1, 2))::BIGINT),
                           lambda crc, b: xor(crcs[(xor(crc, b) & 255) + 1], crc >> 8)), 4294967295::BIGINT) % 10000 AS bucket
    FROM bytes, crc_table),
bucketed AS (SELECT kind, row_no, bucket, n FROM counted JOIN hashed USING (feature)),
shares AS (
    SELECT b AS bucket, coalesce(sum(n) FILTER (kind = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (kind = 'b'), 0)::DOUBLE AS t
    FROM range(10000) AS r(b) LEFT JOIN bucketed ON bucket = b GROUP BY b),
gains AS (
    SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM shares),
weights AS (SELECT row_no, sum(n * gain) AS weight FROM bucketed JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY row_no),
noisy AS (
    SELECT doc_id, row_no, len(words) AS n_words, greatest(len(words), 0) + greatest(len(words) - 1, 0) + greatest(len(words) - 2, 0) AS n_features,
           floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS noise
    FROM texts WHERE kind = 'd'),
scored AS (
    SELECT doc_id, n_words, n_features::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, (coalesce(weight, 0) + noise)::BIGINT AS score
    FROM noisy LEFT JOIN weights USING (row_no)),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS place,
           (count(*) FILTER (n_words >= 20) OVER ()) * 5 // 100 AS drawn FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= drawn THEN place END AS rank FROM ranked
""".replace("{lower}", LOWER)

OP13_FILTER_AUDIT = r"""
WITH RECURSIVE letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
orders AS (
    SELECT letter AS filter_order FROM letters
    UNION ALL
    SELECT filter_order || letter FROM orders JOIN letters ON NOT contains(filter_order, letter)),
flags AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
worded AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS content,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
    FROM documents),
failing AS (
    SELECT w.*, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
           CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
           || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
           || CASE WHEN 100 * len(regexp_replace(content, '[^A-Z]', '', 'g')) > 2 * len(content) THEN 'C' ELSE '' END
           || CASE WHEN regexp_matches(content, '[#$%&*|]') THEN 'D' ELSE '' END
           || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS failed
    FROM worded w LEFT JOIN flags USING (doc_id)),
sets AS (
    SELECT part, failed, count(*) AS docs, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failing GROUP BY part, failed),
steps AS (
    SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS before
    FROM orders, range(1, 6) AS r(step) WHERE len(filter_order) = 5),
walked AS (
    SELECT part, filter_order, step, letter,
           coalesce(sum(docs) FILTER (early = '' AND NOT hit), 0)::BIGINT AS kept,
           coalesce(sum(docs) FILTER (early = '' AND hit), 0)::BIGINT AS removed,
           coalesce(sum(docs) FILTER (early <> '' AND hit), 0)::BIGINT AS redundant,
           coalesce(sum(docs) FILTER (failed = letter), 0)::BIGINT AS unique_fails,
           coalesce(sum(good) FILTER (early = '' AND hit), 0)::BIGINT AS good_lost,
           coalesce(sum(toxic) FILTER (early = '' AND hit), 0)::BIGINT AS toxic_lost
    FROM (SELECT *, contains(failed, letter) AS hit,
                 CASE WHEN before = '' OR failed = '' THEN '' ELSE regexp_replace(failed, '[^' || before || ']', '', 'g') END AS early
          FROM sets, steps)
    GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM walked
"""

SQL = {
    "op1_mixing": OP1_MIXING,
    "op2_url_filter": OP2_URL_FILTER,
    "op4_chat": OP4_CHAT,
    "op9_exact_dedup": OP9_EXACT_DEDUP,
    "op11_importance_resampling": OP11_IMPORTANCE_RESAMPLING,
    "op13_filter_audit": OP13_FILTER_AUDIT,
}
