"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

from itertools import permutations

URL_REPUTATION = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), raw AS (SELECT page_id, rest, regexp_extract(rest, '^([^/?#]*)', 1) AS raw FROM cut
), part AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^([^?#]*)', 1) AS path FROM raw
), outcome AS (
  SELECT doc_id AS number, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS is_bad
  FROM labels WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY 1
), host0 AS (
  SELECT host, count(is_bad) AS n, coalesce(sum(is_bad), 0)::BIGINT AS bad
  FROM (SELECT *, try_cast(nullif(regexp_extract(path, '^/[^/]*/([0-9]+)', 1), '') AS BIGINT) AS number FROM part)
  LEFT JOIN outcome USING (number) GROUP BY 1
), level AS (
  SELECT *, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS l, regexp_matches(host, '^[0-9.]+(:[0-9]*)?$') AS num FROM host0
), named AS (
  SELECT *, array_to_string(l[-2:], '.') AS two,
    array_to_string(l[-2:], '.') IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br', 'co.nz', 'co.in') AND len(l) > 2 AS long FROM level
), hosts AS (
  SELECT host, n, bad,
    CASE WHEN len(l) < 2 OR num THEN host WHEN long THEN array_to_string(l[-3:], '.') ELSE two END AS domain,
    CASE WHEN num THEN '' WHEN long THEN two ELSE l[-1] END AS suffix FROM named
), dom AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL
), suf AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM dom GROUP BY ALL
), top AS (SELECT sum(n) AS n, sum(bad) AS bad, coalesce(sum(bad) / nullif(sum(n), 0), 0.0) AS share FROM suf
), suf_s AS (
  SELECT 1 / greatest(0.001, least(0.999, coalesce((sum((s.bad - s.n * t.m) ** 2 / s.n) - sum(t.m * (1 - t.m))) / nullif(sum(t.m * (1 - t.m) * (s.n - 1)), 0), 0.01))) - 1 AS k
  FROM suf s, (SELECT bad / nullif(n, 0) AS m FROM top) t WHERE s.n > 0
), suf_p AS (SELECT suffix, suf.n, suf.bad, (top.share * k + suf.bad) / (k + suf.n) AS share FROM suf, top, suf_s
), dom_s AS (
  SELECT 1 / greatest(0.001, least(0.999, coalesce((sum((s.bad - s.n * t.m) ** 2 / s.n) - sum(t.m * (1 - t.m))) / nullif(sum(t.m * (1 - t.m) * (s.n - 1)), 0), 0.01))) - 1 AS k
  FROM dom s JOIN (SELECT suffix, bad / nullif(n, 0) AS m FROM suf) t USING (suffix) WHERE s.n > 0
), dom_p AS (SELECT domain, dom.n, dom.bad, (p.share * k + dom.bad) / (k + dom.n) AS share FROM dom JOIN suf_p p USING (suffix), dom_s
), host_s AS (
  SELECT 1 / greatest(0.001, least(0.999, coalesce((sum((s.bad - s.n * t.m) ** 2 / s.n) - sum(t.m * (1 - t.m))) / nullif(sum(t.m * (1 - t.m) * (s.n - 1)), 0), 0.01))) - 1 AS k
  FROM hosts s JOIN (SELECT domain, bad / nullif(n, 0) AS m FROM dom) t USING (domain) WHERE s.n > 0
), host_p AS (SELECT host, hosts.n, hosts.bad, k, (p.share * k + hosts.bad) / (k + hosts.n) AS share FROM hosts JOIN dom_p p USING (domain), host_s
), ruled AS (
  SELECT page_id, host, path,
    CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM part
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN share - 1.645 * sqrt(share * (1 - share) / (k + n + 1)) > 0.3 THEN 'block' ELSE 'allow' END AS verdict,
  n AS n_labelled, bad AS n_bad
FROM ruled JOIN host_p USING (host)
"""

LINE_DEDUP = r"""
WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents
), line AS (
  SELECT doc_id, unnest(range(len(ls)))::INT AS pos, unnest(ls) AS line FROM split
), full_line AS (SELECT * FROM line WHERE trim(line, ' ') <> ''
), distinct_line AS (SELECT line, length(line) AS n, min({'d': doc_id, 'p': pos}) AS place FROM full_line GROUP BY line
), cut AS (
  SELECT line, n, place, i, hash(concat(left(line, (i - 1)::INT), substr(line, i + 1))) AS v
  FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM distinct_line WHERE n >= 20)
), near AS (
  SELECT b.line FROM cut a JOIN cut b ON a.v = b.v AND a.i = b.i AND a.n = b.n AND a.place < b.place
  UNION SELECT w.line FROM cut a JOIN distinct_line w ON a.v = hash(w.line) AND a.n = w.n + 1 WHERE w.n >= 20 AND a.place < w.place
  UNION SELECT a.line FROM cut a JOIN distinct_line w ON a.v = hash(w.line) AND a.n = w.n + 1 WHERE w.n >= 20 AND w.place < a.place
), mark AS (
  SELECT f.doc_id, f.pos, n.line IS NOT NULL AS near, d.place <> {'d': f.doc_id, 'p': f.pos} AS again
  FROM full_line f JOIN distinct_line d ON f.line = d.line LEFT JOIN near n ON f.line = n.line
), gone AS (
  SELECT doc_id, count(*) FILTER (near) AS n_near, count(*) FILTER (NOT near AND again) AS n_exact,
         bool_and(near OR again) AS dropped, list(pos) FILTER (near OR again) AS ats
  FROM mark GROUP BY doc_id
)
SELECT s.doc_id, coalesce(len(ls), 0)::BIGINT AS n_lines, coalesce(n_exact, 0) AS n_exact, coalesce(n_near, 0) AS n_near,
       coalesce(dropped, false) AS dropped,
       md5(CASE WHEN ats IS NULL THEN coalesce(text, '') ELSE
           array_to_string([ls[(i + 1)::INT] FOR i IN range(len(ls)) IF NOT list_contains(ats, i)], chr(10)) END) AS kept_md5
FROM split s LEFT JOIN gone g ON s.doc_id = g.doc_id
"""

_ORDERS = ", ".join(f"('{''.join(order)}')" for order in permutations("ABCDE"))
FILTER_AUDIT = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), least AS (SELECT text, min(doc_id) AS least FROM d GROUP BY text
), known AS (SELECT doc_id, max((quality = 1)::INT) = 1 AS good, max((toxic = 1)::INT) = 1 AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN least < d.doc_id THEN 'E' ELSE '' END AS fails
  FROM d JOIN least USING (text) LEFT JOIN known ON d.doc_id = known.doc_id
), c AS (SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL
), step AS (
  SELECT filter_order, unnest(range(1, 6))::INT AS step FROM (VALUES """ + _ORDERS + r""") t(filter_order)
), place AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS own, left(filter_order, step - 1) AS before FROM step
), seen AS (
  SELECT part, filter_order, step, own, n, good, toxic, fails, contains(fails, own) AS failing,
         before <> '' AND length(translate(before, fails, '')) < length(before) AS gone
  FROM c, place
), counted AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (NOT failing AND NOT gone), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (failing AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (failing AND gone), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails = own), 0)::BIGINT AS unique_fails,
    coalesce(sum(n) FILTER (failing AND NOT gone AND good), 0)::BIGINT AS good_lost,
    coalesce(sum(n) FILTER (failing AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost
  FROM seen GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted
"""

COLLOCATIONS = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece
), total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang
), run AS (
  SELECT lang, k AS words, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
  FROM w, (VALUES (1), (2), (3)) size(k) WHERE len(w) >= k
), f AS (SELECT lang, words, phrase, count(*) AS n FROM run GROUP BY ALL HAVING count(*) >= 10
), cand AS (SELECT lang, words, phrase, n AS a, string_split(phrase, ' ') AS p FROM f WHERE words > 1
), cut AS (SELECT *, unnest(range(1, words)) AS k FROM cand
), scored AS (
  SELECT c.lang, c.phrase, c.words, c.a, c.k, x.n AS l, y.n AS r,
         (1000000::HUGEINT * c.a * c.a // (x.n::HUGEINT * y.n))::BIGINT AS score
  FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(p[1:k], ' ')
             JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(p[k + 1:], ' ')
), best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, array_to_string(p[1:2], ' ') AS phrase FROM cand WHERE words = 3
    UNION ALL SELECT lang, a, array_to_string(p[2:3], ' ') FROM cand WHERE words = 3) GROUP BY ALL
), ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM best b LEFT JOIN longer USING (lang, phrase) WHERE 100 * coalesce(longer, 0) < 50 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
