"""SQL with the operators' results, for the check on another engine."""

from __future__ import annotations

from commentlens.llm import chat, decontam, linedup, mixing

SOURCE_MIX = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS draw
  FROM documents),
per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS code
  FROM sized GROUP BY source),
weighted AS (SELECT *, CASE (code - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight FROM per_source),
sums AS (SELECT sum(source_size)::DOUBLE AS total, sum(weight) AS weight FROM weighted),
-- Sources by the share at which they stop: the first share that stops no further source is the one.
stops AS (
  SELECT w.source_size, w.weight, 3 * w.source_size / w.weight AS stop,
         coalesce(sum(3 * w.source_size) OVER o, 0)::DOUBLE AS stopped_words,
         coalesce(sum(w.weight) OVER o, 0.0) AS stopped_weight, count(*) OVER o AS before
  FROM weighted w
  WINDOW o AS (ORDER BY 3 * w.source_size / w.weight, w.code ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
shares AS (
  SELECT arg_min((sums.total - stopped_words) / (sums.weight - stopped_weight), before) AS share
  FROM stops, sums
  WHERE stop >= (sums.total - stopped_words) / (sums.weight - stopped_weight)),
planned AS (
  SELECT source, code, source_size,
         CASE WHEN (SELECT total FROM sums) = 0 THEN 0.0 ELSE least((3 * source_size)::DOUBLE, share * weight) END AS target
  FROM weighted, shares),
block AS (
  SELECT CAST(least({mixing.LARGEST_BLOCK}, greatest(1, floor(coalesce(min(target) FILTER (target > 0), 1)
         / {mixing.BLOCKS_OF_SMALLEST}))) AS BIGINT) AS words, sum(target) AS total
  FROM planned),
seats AS (SELECT CAST(floor(total / words) AS BIGINT) AS n FROM block),
source_quotients AS (
  SELECT code, target / (2 * k + 1) AS quotient
  FROM planned, (SELECT unnest(range(0, (SELECT n FROM seats))) AS k)
  WHERE k <= target / (SELECT words FROM block) + 2 + (SELECT count(*) FROM planned)),
source_quotas AS (
  SELECT code, count(*) AS quota
  FROM (SELECT code, row_number() OVER (ORDER BY quotient DESC, code) AS place FROM source_quotients)
  WHERE place <= (SELECT n FROM seats) GROUP BY code),
dealt AS (
  SELECT s.*, p.code, p.source_size, p.target, coalesce(q.quota, 0) AS source_quota,
         CAST('0x' || substr(s.draw, 1, 8) AS BIGINT)
           % greatest(CAST(ceil(p.source_size / {mixing.SHARD_WORDS}.0) AS BIGINT), 1) AS shard
  FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source LEFT JOIN source_quotas q ON q.code = p.code),
shards AS (
  SELECT code, shard, CAST(sum(size) AS BIGINT) AS shard_size, max(source_quota) AS source_quota, max(source_size) AS source_size
  FROM dealt GROUP BY code, shard HAVING sum(size) > 0),
shard_quotients AS (
  SELECT code, shard, source_quota, shard_size / (2.0::DOUBLE * k + 1) AS quotient
  FROM (SELECT *, unnest(range(0, source_quota)) AS k FROM shards)
  WHERE k <= source_quota * shard_size / source_size + 2 + (SELECT count(*) FROM shards)),
quotas AS (
  SELECT code, shard, count(*) AS quota
  FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY quotient DESC, shard) AS place FROM shard_quotients)
  WHERE place <= source_quota GROUP BY code, shard),
placed AS (
  SELECT d.*, s.shard_size, coalesce(q.quota, 0) AS quota, b.words AS b,
         CAST(sum(d.size) OVER (PARTITION BY d.code, d.shard ORDER BY d.draw, d.doc_id, d.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS stop
  FROM dealt d JOIN shards s ON d.code = s.code AND d.shard = s.shard
  LEFT JOIN quotas q ON q.code = d.code AND q.shard = d.shard, block b
  WHERE d.size > 0),
rests AS (
  SELECT *, least(quota * b, {mixing.MOST_PASSES} * shard_size) // shard_size AS passes,
         least(quota * b, {mixing.MOST_PASSES} * shard_size) % shard_size AS rest,
         shard_size // b AS blocks, shard_size % b AS tail
  FROM placed),
choices AS (
  SELECT *, rest % b AS odd, (rest % b > tail AND rest % b - tail >= b - rest % b) AS up,
         CAST('0x' || substr(md5('{mixing.SEED}:' || code || ':' || shard), 1, 8) AS BIGINT) % greatest(blocks, 1) AS start
  FROM rests),
lines AS (
  SELECT *, rest // b + CASE WHEN up THEN 1 ELSE 0 END AS chosen, CASE WHEN up THEN 0 ELSE least(odd, tail) END AS from_tail
  FROM choices),
ends AS (SELECT *, unnest([stop, stop - size]) AS x, unnest([1, -1]) AS sign FROM lines),
fulls AS (SELECT *, least(x // b, blocks) AS j, greatest(blocks, 1) AS n FROM ends),
befores AS (
  SELECT *, ((j + start) * chosen // n - start * chosen // n) * b
      + CASE WHEN j < blocks THEN ((j + 1 + start) * chosen // n - (j + start) * chosen // n) * (x - j * b) ELSE 0 END
      + least(greatest(x - blocks * b, 0), from_tail) AS words
  FROM fulls)
SELECT doc_id, size, source_size, target, CAST(any_value(passes) * size + sum(sign * words) AS BIGINT) AS taken
FROM befores GROUP BY doc_id, draw, stop, size, source_size, target, code, shard
UNION ALL
SELECT doc_id, size, source_size, target, CAST(0 AS BIGINT) AS taken FROM dealt WHERE size = 0
"""

SITE_SPREAD = f"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS doc, source, text,
         string_split(text, chr(10)) AS parts FROM documents),
lines AS (SELECT r, doc, source, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM rows WHERE text IS NOT NULL),
judged AS (SELECT * FROM lines WHERE len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) >= {linedup.LEAST_WORDS}),
spread AS (
  SELECT line, min((doc, place)) AS first FROM judged GROUP BY line
  HAVING count(DISTINCT coalesce('=' || source, '')) >= {linedup.LEAST_SITES}),
gone AS (SELECT j.r, j.place FROM judged j JOIN spread s ON j.line = s.line WHERE (j.doc, j.place) <> s.first),
kept AS (
  SELECT l.r, string_agg(l.line, chr(10) ORDER BY l.place) AS text, count(*) AS n
  FROM lines l LEFT JOIN gone g ON g.r = l.r AND g.place = l.place WHERE g.r IS NULL GROUP BY l.r)
SELECT rows.doc_id, coalesce(len(parts), 0) AS n_lines, coalesce(len(parts), 0) - coalesce(kept.n, 0) AS n_removed,
       CASE WHEN rows.text IS NOT NULL THEN coalesce(kept.text, '') END AS text
FROM rows LEFT JOIN kept ON kept.r = rows.r
"""

_ITEM_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

BENCHMARK_WINDOWS = f"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ITEM_WORD}') AS w
  FROM documents),
items AS (
  SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), 'null') AS item,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ITEM_WORD}') AS w FROM benchmark),
sized AS (SELECT item, w, least(len(w), {decontam.WINDOW}) AS k FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, k, array_to_string(w[i : i + k - 1], ' ') AS window
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM sized)),
ks AS (SELECT DISTINCT k FROM windows),
places AS (
  SELECT r, k, i, array_to_string(w[i : i + k - 1], ' ') AS window
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM rows, ks WHERE len(w) >= k)),
found AS (SELECT p.r, p.i, p.k, x.item FROM places p JOIN windows x ON p.k = x.k AND p.window = x.window),
hit AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + k)) AS j FROM found) GROUP BY r),
named AS (
  SELECT r, count(*) AS n, sha256(string_agg(item, ',' ORDER BY item)) AS names
  FROM (SELECT DISTINCT r, item FROM found) GROUP BY r),
-- Windows that follow each other in the document and in an item make one match.
met AS (
  SELECT p.r, p.i, p.k, x.item, x.own, p.i - x.i AS shift
  FROM places p JOIN (SELECT item, own, k, i, array_to_string(w[i : i + k - 1], ' ') AS window
    FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT *, row_number() OVER () AS own FROM sized))) x
  ON p.k = x.k AND p.window = x.window),
runs AS (
  SELECT r, item, CAST(count(*) + max(k) - 1 AS BIGINT) AS length, CAST(min(i) - 1 AS BIGINT) AS at_
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, own, shift ORDER BY i) AS island FROM met) GROUP BY r, own, item, shift, island),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY length DESC, at_, item) = 1)
SELECT doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
       coalesce(names, sha256('')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AND {decontam.SHARE} * coalesce(hit.n, 0) >= len(w) AS contaminated,
       coalesce(best.length, 0) AS longest, best.at_ AS longest_at, best.item AS longest_item
FROM rows LEFT JOIN hit USING (r) LEFT JOIN named USING (r) LEFT JOIN best USING (r)
"""

CHATS = f"""
WITH turns AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)),
hashed AS (
  SELECT conv_id, turn, role, text, place,
         string_agg(md5(coalesce('=' || role, '') || chr(0) || coalesce('=' || text, '')), '/') OVER (
           PARTITION BY conv_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prefix
  FROM turns),
whole AS (SELECT conv_id, max(place) AS n, max_by(prefix, place) AS prefix FROM hashed GROUP BY conv_id),
snapshots AS (
  SELECT DISTINCT w.conv_id FROM whole w JOIN hashed h ON h.place = w.n AND h.prefix = w.prefix AND h.conv_id IS DISTINCT FROM w.conv_id
  JOIN whole o ON o.conv_id IS NOT DISTINCT FROM h.conv_id
  WHERE o.n > w.n OR coalesce('=' || CAST(o.conv_id AS VARCHAR), '') < coalesce('=' || CAST(w.conv_id AS VARCHAR), ''))
SELECT conv_id, (place - 1) // {chat.STRETCH} AS part, count(*) AS n_turns,
       string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), ''
         ORDER BY place) AS text
FROM turns WHERE NOT EXISTS (SELECT 1 FROM snapshots s WHERE s.conv_id IS NOT DISTINCT FROM turns.conv_id)
GROUP BY conv_id, (place - 1) // {chat.STRETCH}
"""

FILTER_AUDIT = """
WITH doc AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents),
flag AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
masked AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (CASE WHEN len(words) < 200 THEN 1 ELSE 0 END)
         + (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END)
         + (CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) THEN 4 ELSE 0 END)
         + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
         + (CASE WHEN doc_id > first_id THEN 16 ELSE 0 END) AS mask
  FROM doc LEFT JOIN flag USING (doc_id)),
counted AS (SELECT part, mask, good, toxic, count(*) AS n FROM masked GROUP BY ALL),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS bit),
ordered AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE b.c <> a.c AND c.c NOT IN (a.c, b.c) AND d.c NOT IN (a.c, b.c, c.c) AND e.c NOT IN (a.c, b.c, c.c, d.c)),
step AS (
  SELECT filter_order, k AS step, bits[k] AS own, coalesce(list_sum(bits[1:k - 1]), 0) AS before
  FROM ordered, (SELECT unnest([1, 2, 3, 4, 5]) AS k)),
found AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN mask & (before::INT | own) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & before::INT = 0 AND mask & own <> 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & before::INT <> 0 AND mask & own <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & before::INT = 0 AND mask & own <> 0 AND good = 1 THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & before::INT = 0 AND mask & own <> 0 AND toxic = 1 THEN n ELSE 0 END) AS toxic_lost
  FROM counted, step GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM found
"""
