"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from sluice.llm import licenses

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
_ALNUM_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

NEAR_DUPLICATES = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])) END AS s
  FROM words
), sizes AS (SELECT doc_id, len(s) AS n FROM sets
), shingles AS (SELECT doc_id, unnest(s) AS g FROM sets
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 85 * (p.n + q.n - c)
), both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x
), least AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept
FROM sizes JOIN least USING (doc_id)
"""

DECONTAMINATION = rf"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM_WORDS} AS w FROM benchmark
), wins AS (
  SELECT DISTINCT item, least(13, len(w)) AS size, unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2),
    lambda i: array_to_string(w[i : i + least(13, len(w)) - 1], ' '))) AS g
  FROM items WHERE len(w) > 0
), docs AS (SELECT doc_id, {_ALNUM_WORDS} AS w FROM documents
), places AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS i, w
  FROM docs, (SELECT DISTINCT size FROM wins) WHERE len(w) >= size
), grams AS (SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS g FROM places
), found AS (
  SELECT doc_id, grams.size AS size, i, item FROM grams JOIN wins ON wins.size = grams.size AND wins.g = grams.g
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY 1
), matched AS (
  SELECT doc_id, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY 1
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(joined, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN matched USING (doc_id)
"""


CHAT_PERSPECTIVES = """
WITH m AS (
  SELECT conv_id, turn, coalesce(nullif(role, ''), 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations
), sides AS (SELECT DISTINCT conv_id, speaker AS perspective FROM m WHERE speaker <> 'system'
), rendered AS (
  SELECT m.conv_id, perspective, turn, speaker, text,
    '<|im_start|>' || CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant'
      ELSE 'user name=' || speaker END || chr(10) AS heading
  FROM m JOIN sides ON m.conv_id IS NOT DISTINCT FROM sides.conv_id
), whole AS (SELECT *, heading || text || '<|im_end|>' || chr(10) AS rendered FROM rendered
), placed AS (
  SELECT *, row_number() OVER w - 1 AS position,
    CAST(coalesce(sum(length(rendered)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_char
  FROM whole WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text)
)
SELECT conv_id, perspective, position, turn, speaker, rendered, start_char, speaker = perspective AS train,
  CASE WHEN speaker = perspective THEN start_char + length(heading) END AS mask_start,
  CASE WHEN speaker = perspective THEN start_char + length(heading) + length(text) + 10 END AS mask_end
FROM placed
"""


def license_scan() -> str:
    """Phrases by word position; templates as the regular expressions they equal."""
    phrases = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in licenses.PHRASES.items())
    matched = " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label FROM spaced WHERE contains(joined, ' {licenses.compile_template(t).anchor.decode()}') "
        f"AND regexp_matches(joined, '{licenses.template_regex(t)}')"
        for label, t in licenses.TEMPLATES.items()
    )
    return rf"""
WITH docs AS MATERIALIZED (SELECT doc_id, {_ALNUM_WORDS} AS w FROM documents
), phrases(phrase, label, n) AS (VALUES {phrases}
), spaced AS MATERIALIZED (SELECT doc_id, ' ' || array_to_string(w, ' ') AS joined FROM docs
), places AS (
  SELECT doc_id, w, unnest(range(0, len(w))) AS i FROM docs WHERE len(w) > 1
), base AS (
  SELECT doc_id, i, label FROM places JOIN phrases ON array_to_string(w[i + 1 : i + n], ' ') = phrase
), counted AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word FROM base GROUP BY 1
), matched AS (
  {matched}
), labels AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM base UNION SELECT doc_id, label FROM matched) GROUP BY 1
), base_labels AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY 1
)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CASE WHEN EXISTS (SELECT 1 FROM matched m WHERE m.doc_id = docs.doc_id) THEN 1.0::DOUBLE
       WHEN n_base > 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score
FROM docs LEFT JOIN counted USING (doc_id) LEFT JOIN base_labels USING (doc_id) LEFT JOIN labels USING (doc_id)
"""


def centroid_clustering(rounds: int = 3) -> str:
    """Lloyd rounds as one step of common table expressions each."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""pairs_{r} AS (
  SELECT row, c, sum((x - y) * (x - y)) AS distance FROM parts JOIN centroids_{r} USING (i) GROUP BY row, c
), assigned_{r} AS (SELECT row, min(c) AS c, min(distance) AS distance FROM (
    SELECT *, min(distance) OVER (PARTITION BY row) AS least FROM pairs_{r}) WHERE distance = least GROUP BY row
)""")
        if r < rounds:
            steps.append(f"""moved_{r} AS (
  SELECT c, i, sum(x) AS s, count(*) AS n FROM assigned_{r} JOIN parts USING (row) GROUP BY c, i
), centroids_{r + 1} AS (
  SELECT c, i, CASE WHEN n IS NULL THEN y ELSE CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS y
  FROM centroids_{r} LEFT JOIN moved_{r} USING (c, i)
)""")
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), parts AS (SELECT row, unnest(range(1, 65)) AS i, unnest(v) AS x FROM kept
), first AS (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT sha256('1:' || vec_id) AS h, v FROM kept WHERE vec_id IS NOT NULL) ORDER BY h, v LIMIT 16
), centroids_0 AS (SELECT c, unnest(range(1, 65)) AS i, unnest(v) AS y FROM first
), {", ".join(steps)}, digests AS (
  SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM centroids_{rounds} GROUP BY c
)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM assigned_{rounds} JOIN kept USING (row) JOIN digests USING (c)
"""


_CRC32 = """xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || flatten(list_transform(string_split(key, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)]
      ELSE [CAST(192 + (unicode(c) >> 6) AS BIGINT), CAST(128 + (unicode(c) & 63) AS BIGINT)] END)),
    lambda h, b: list_reduce([xor(h, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))))"""

SPELLING_VARIANTS = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[a-zÀ-ÿ]+')) AS run FROM documents
), often AS (
  SELECT doc_id || ':' || run AS key, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY doc_id, run
), hashed AS (SELECT run, n, {_CRC32} AS h FROM often
), vocabulary AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), places AS (SELECT word, unnest(range(0, length(word))) AS i FROM vocabulary
), cut AS (SELECT DISTINCT word, i, word[1 : i] AS head, word[i + 2 :] AS tail FROM places
), near AS (
  SELECT x.word AS word, y.word AS near FROM cut x JOIN cut y ON x.i = y.i AND x.head = y.head AND x.tail = y.tail AND x.word <> y.word
  UNION SELECT cut.word, head || tail FROM cut JOIN vocabulary v ON v.word = head || tail
  UNION SELECT head || tail, cut.word FROM cut JOIN vocabulary v ON v.word = head || tail
), best AS (
  SELECT near.word, count(*) AS n_near, max(v.n) AS top, arg_min(near, (-v.n, near)) AS candidate
  FROM near JOIN vocabulary v ON v.word = near.near GROUP BY near.word
), formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * n THEN candidate END AS form,
    CASE WHEN top >= 2 * n THEN top END AS form_n
  FROM vocabulary LEFT JOIN best USING (word)
), followed AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL
  SELECT followed.word, formed.word, formed.form FROM followed JOIN formed ON followed.next = formed.word
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, root FROM followed WHERE next IS NULL) USING (word)
"""
