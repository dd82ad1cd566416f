"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format(_LOWER)

OP4 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
), sized AS (SELECT doc_id, s, len(s) AS n FROM sets),
classes AS (SELECT s, min(doc_id) AS rep, max(n) AS n FROM (SELECT doc_id, list_sort(s) AS s, n FROM sized WHERE n > 0) GROUP BY s),
units AS (SELECT rep, n, unnest(s) AS x FROM classes),
links AS (
  SELECT a.rep AS a, b.rep AS b FROM units a JOIN units b ON a.x = b.x AND a.rep <> b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
  SELECT rep AS node, rep AS root FROM classes
  UNION
  SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.node
), roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
SELECT d.doc_id, d.n AS n_shingles, coalesce(roots.root, d.doc_id) AS component_id, d.doc_id = coalesce(roots.root, d.doc_id) AS kept
FROM sized d LEFT JOIN classes c ON d.n > 0 AND list_sort(d.s) = c.s LEFT JOIN roots ON roots.node = c.rep
"""

OP6 = f"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, w, CASE WHEN len(w) < 10 THEN len(w) ELSE 10 END AS k
  FROM (SELECT item_id, {_ALNUM} AS w FROM benchmark) WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS x
  FROM (SELECT item, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM items)
), docs AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs),
hits AS (
  SELECT DISTINCT doc_id, i, p.k, item
  FROM (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS x FROM places, (SELECT DISTINCT k FROM windows) WHERE i + k - 1 <= len(w)) p
  JOIN windows v ON v.x = p.x AND v.k = p.k
), marked AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN marked USING (doc_id) LEFT JOIN named USING (doc_id)
"""


OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS s, max(page_id) OVER (PARTITION BY h) AS leader FROM p),
b AS (SELECT *, CAST(unhex(s) AS BIT)::VARCHAR AS bits FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST(list_sum(list_transform(range(1, 6), lambda k: CAST(substr(bits, CAST(5 * i + k AS BIGINT), 1) AS INTEGER) * CAST(pow(2, 5 - k) AS INTEGER))) AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = leader THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> leader THEN leader END AS refers_to
FROM b
"""

_HOST = "translate(regexp_extract({0}, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract({0}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"

# The pages of the test data have neither canonical links nor refresh tags, so the edges are equal articles and rewritten URLs.
OP9 = f"""
WITH RECURSIVE rules(rhost, rpath, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
u AS (SELECT DISTINCT url, {_HOST.format("url")} AS host, {_PATH.format("url")} AS path,
  regexp_replace(regexp_replace(regexp_replace(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '(^|&)(utm_[^=&]*|ref)(=[^&]*)?', '', 'g'), '^&+', ''), '^(.+)$', '?\\1') AS query
  FROM pages WHERE url IS NOT NULL),
articles AS (SELECT url, regexp_extract(html, '(?is)<article\\b[^>]*>(.*?)</article>', 1) AS article FROM pages WHERE url IS NOT NULL),
e AS (SELECT url AS src, min(url) OVER (PARTITION BY article) AS dst FROM articles WHERE article <> '' UNION
  SELECT url AS src, CASE WHEN host = '' THEN url ELSE 'https://' || regexp_replace(host, '^(www|m)\\.', '') ||
  regexp_replace(regexp_replace(path, '(/index)?\\.html?$', ''), '/+$', '') || query END AS dst FROM u),
both_ways AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e),
reach AS (SELECT src AS node, src AS root FROM both_ways UNION SELECT b.dst, r.root FROM reach r JOIN both_ways b ON b.src = r.node),
comp AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
n AS (SELECT node, root, {_HOST.format("node")} AS host, {_PATH.format("node")} AS path FROM comp),
m AS (SELECT n.*, (SELECT max({{'n': length(rhost || rpath), 'rule': rhost || rpath, 'v': v}}) FROM rules
  WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS best FROM n),
c AS (SELECT root, CASE WHEN bool_or(best.v = 'allow') THEN 'allow' WHEN bool_or(best.v = 'block') THEN 'block' END AS spread FROM m GROUP BY root)
SELECT page_id, coalesce(m.host, '') AS host, coalesce(m.path, '') AS path, best.rule AS rule, coalesce(best.v, spread, 'allow') AS verdict
FROM pages LEFT JOIN m ON m.node = pages.url LEFT JOIN c USING (root)
"""


def _given(nodes: str, parent: str, order: str) -> str:
    """Shares of the budget of a parent among its children, by weight and up to their room."""
    return f"""
  SELECT * EXCLUDE (ratio, lev, f), CASE WHEN f THEN CAST(room AS DOUBLE) ELSE weight * first_value(lev) OVER (PARTITION BY {parent}, f ORDER BY ratio, {order}) END AS given
  FROM (SELECT *, coalesce(ratio <= lev, true) AS f FROM (
    SELECT *, (budget - coalesce(sum(room) OVER b, 0)) / (sum(weight) OVER (PARTITION BY {parent}) - coalesce(sum(weight) OVER b, 0)) AS lev
    FROM (SELECT *, room / weight AS ratio FROM {nodes})
    WINDOW b AS (PARTITION BY {parent} ORDER BY ratio, {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))"""


OP10 = f"""
WITH rows AS (
  SELECT doc_id, lang, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens,
    CASE WHEN source IN ('src0','src1','src2','src3','src4','src5','src6','src7','src8','src9') THEN 'web'
      WHEN source IN ('src10','src11','src12','src13','src14') THEN 'books' WHEN source IN ('src15','src16','src17') THEN 'reference' ELSE 'other' END AS domain
  FROM documents
), leaves AS (
  SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(4 * sum(n_tokens) AS BIGINT) AS room, CAST(1 AS BIGINT) AS weight FROM rows GROUP BY ALL
), langs AS (SELECT domain, lang, CAST(sum(room) AS BIGINT) AS room, CASE lang WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'es' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS weight FROM leaves GROUP BY ALL),
domains AS (
  SELECT domain, CAST(sum(room) AS BIGINT) AS room, CASE domain WHEN 'web' THEN 4 WHEN 'books' THEN 3 WHEN 'reference' THEN 2 ELSE 1 END AS weight,
    0 AS root, (SELECT CAST(trunc(sum(n_tokens) * 0.6::DOUBLE) AS DOUBLE) FROM rows) AS budget
  FROM langs GROUP BY domain
), d AS ({_given("domains", "root", "domain")}),
l AS ({_given("(SELECT langs.*, d.given AS budget FROM langs JOIN d USING (domain))", "domain", "lang")}),
s AS ({_given("(SELECT leaves.*, l.given AS budget FROM leaves JOIN l USING (domain, lang))", "domain, lang", "source")}),
plan AS (
  SELECT domain, lang, source, tokens, CAST(floor(given) AS BIGINT) AS budget, CASE WHEN tokens > 0 THEN CAST(floor(given) AS BIGINT) // tokens ELSE 0 END AS epochs FROM s
), placed AS (
  SELECT doc_id, domain, lang, source, n_tokens, budget, epochs, budget - epochs * tokens AS rest, md5('17:' || epochs || ':' || doc_id) AS place
  FROM rows JOIN plan USING (domain, lang, source)
)
SELECT doc_id, domain, lang, source, n_tokens, budget,
  epochs + CASE WHEN sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place) <= rest THEN 1 ELSE 0 END AS copies
FROM placed
"""


def _clusters(rounds: int = 5) -> str:
    """Lloyd's rounds, each a table of assignments and one of centroids, over (vector, component) rows."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
d{r} AS MATERIALIZED (SELECT row, j, sum((x - c) * (x - c)) AS d FROM cells JOIN c{r} USING (i) GROUP BY row, j),
a{r} AS MATERIALIZED (SELECT row, arg_min(j, (d, j)) AS j, min(d) AS d FROM d{r} GROUP BY row)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (SELECT j, i, sum(x) AS s, count(*) AS n FROM cells JOIN a{r} USING (row) GROUP BY j, i),
c{r + 1} AS MATERIALIZED (SELECT j, i, coalesce((s - ((s % n) + n) % n) // n, c) AS c FROM c{r} LEFT JOIN m{r} USING (j, i))""")
    return ",".join(steps)


OP11 = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), vec_id) AS row, vec_id, embedding AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), cells AS MATERIALIZED (
  SELECT row, i, CAST(floor(256 * CAST(v[i] AS DOUBLE)) AS HUGEINT) AS x FROM (SELECT row, v, unnest(range(1, 65)) AS i FROM kept)
), c0 AS MATERIALIZED (SELECT row - 1 AS j, i, x AS c FROM cells WHERE row <= 40),{_clusters()},
digests AS (SELECT j, sha256(string_agg(c::VARCHAR, ',' ORDER BY i)) AS h FROM c5 GROUP BY j)
SELECT vec_id, CAST(j AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM kept JOIN a5 USING (row) JOIN digests USING (j)
"""

# crc32 byte by byte from a table of 256 values; the letters beyond ASCII have two bytes. As levenshtein compares
# bytes, these letters are replaced by signs of ASCII before words are compared.
OP13 = """
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t FROM range(0, 256) r(i)
), runs AS (
  SELECT key, run, count(*) AS k FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS key,
      translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents)
  GROUP BY ALL
), bytes AS (
  SELECT run, k, flatten(list_transform(string_split(key || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)) AS b
  FROM runs
), hashed AS (
  SELECT run, k, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[CAST(xor(c & 255, x) + 1 AS BIGINT)]), 4294967295), 4294967295) AS h FROM bytes, crc_table
), words AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed
), vocabulary AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n, length(word) AS len,
    translate(word, list_aggregate(list_transform(range(192, 256), lambda i: chr(CAST(i AS INTEGER))), 'string_agg', ''), '!"#$%&()*+,-./0123456789:;<=>?@ABCDEFGHIJKLMNOPQRSTUVWXYZ[]^_{|}') AS ascii
  FROM words WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n
  FROM vocabulary a JOIN vocabulary b ON b.len BETWEEN a.len - 1 AND a.len + 1 AND a.word <> b.word WHERE levenshtein(a.ascii, b.ascii) = 1
), best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS form_n, arg_min(other, (-other_n, other)) AS form FROM near GROUP BY word
), forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * n THEN form END AS form, CASE WHEN form_n >= 5 * n THEN form_n END AS form_n
  FROM vocabulary LEFT JOIN best USING (word)),
path AS (
  SELECT word, word AS here, 0 AS step FROM forms
  UNION ALL
  SELECT path.word, forms.form, step + 1 FROM path JOIN forms ON forms.word = path.here WHERE forms.form IS NOT NULL
), ends AS (SELECT word, arg_max(here, step) AS root FROM path GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""


def expected() -> dict[str, str]:
    return {"op4_superminhash": OP4, "op6_decontamination": OP6, "op7_warc_zstd": OP7, "op9_url_aliases": OP9, "op10_mixing": OP10, "op11_heap_kmeans": OP11, "op13_spelling": OP13}
