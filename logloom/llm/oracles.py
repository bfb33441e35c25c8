"""SQL for the operators that SQL can express, runnable by DuckDB on the given tables."""

# The word pattern and the window of the contract.
OP5 = r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM texts WHERE len(ws) >= 13),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM starts),
firsts AS (SELECT k, min(doc_id) AS first FROM windows GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos FROM windows JOIN firsts USING (k) WHERE first < doc_id
),
placed AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM texts),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n FROM placed ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""

OP4 = """
WITH RECURSIVE pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.98
),
reached(vec_id, root) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT p.b, r.root FROM reached r JOIN pairs p ON p.a = r.vec_id WHERE r.root < p.b
),
components AS (SELECT vec_id, min(root) AS component_id FROM reached GROUP BY vec_id)
SELECT vec_id, (SELECT count(*) FROM pairs WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM components
"""

OP1 = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS at FROM documents
),
cut AS (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS raw FROM lines),
masked AS (SELECT *, [CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END FOR x IN raw] AS ws FROM cut),
eligible AS (
  SELECT DISTINCT doc_id, ws FROM masked WHERE len(ws) >= 3 AND len([x FOR x IN ws IF x <> '<*>']) >= 2
),
placed AS (
  SELECT doc_id, ws, unnest(ws) AS word, generate_subscripts(ws, 1) AS place FROM eligible WHERE len(ws) > 5
),
frequent AS (
  SELECT len(ws) AS n, ws[1:3] AS lead, place, word FROM placed WHERE word <> '<*>' GROUP BY ALL HAVING count(*) >= 3
),
forms AS (
  SELECT p.ws, list(p.place ORDER BY p.place) AS places, list(p.word ORDER BY p.place) AS words
  FROM (SELECT DISTINCT ws, place, word FROM placed) p
  JOIN frequent f ON f.n = len(p.ws) AND f.lead = p.ws[1:3] AND f.place = p.place AND f.word = p.word GROUP BY p.ws
),
templates AS (
  SELECT ws, {'n': len(ws), 'lead': ws[1:3], 'places': places, 'words': words} AS template FROM forms
  WHERE len(places) >= 5 AND len(places) >= 0.8 * len(ws)
),
exact AS (SELECT ws, min(doc_id) AS first FROM eligible GROUP BY ws HAVING count(*) >= 3),
formed AS (
  SELECT template, min(doc_id) AS first FROM eligible JOIN templates USING (ws) GROUP BY template HAVING count(DISTINCT doc_id) >= 3
),
gone AS (
  SELECT DISTINCT e.doc_id, e.ws FROM eligible e LEFT JOIN exact x ON x.ws = e.ws LEFT JOIN templates t ON t.ws = e.ws
  LEFT JOIN formed f ON f.template = t.template WHERE e.doc_id > x.first OR e.doc_id > f.first
),
kept AS (SELECT m.doc_id, m.at, m.line FROM masked m ANTI JOIN gone g ON g.doc_id = m.doc_id AND g.ws = m.ws)
SELECT d.doc_id, count(*) AS n_lines, count(*) - count(k.at) AS n_removed,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.at), '')) AS kept_sha256
FROM lines d LEFT JOIN kept k ON k.doc_id = d.doc_id AND k.at = d.at GROUP BY d.doc_id
"""

# CRC-32 from its definition: the table by eight shifts of every byte, then one step per byte.
CRC = r"""
RECURSIVE steps(i, k, v) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END FROM steps WHERE k < 8
),
crc AS (SELECT list(v ORDER BY i) AS t FROM steps WHERE k = 8)
"""


def _crc(column: str) -> str:
    """CRC-32 of a text column, in a query that reads the table ``crc``."""
    byte = f"list_transform(regexp_extract_all(hex(encode({column})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(4294967295, list_reduce({byte}, lambda s, x: xor(s >> 8, t[xor(s & 255, x) + 1]), 4294967295))"


OP11 = f"""
WITH {CRC},
docs AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS name, strlen(coalesce(text, '')) + 1 AS size,
         {_crc("coalesce(text, '')")} AS text_crc32 FROM documents, crc
),
bids AS (
  SELECT name, s, -ln((('0x' || substr(md5(name || ':' || s), 1, 13))::BIGINT + 0.5) / 4503599627370496) AS bid
  FROM (SELECT DISTINCT name FROM docs), range(17) r(s)
),
won AS (
  SELECT name, arg_min(s, (bid, s)) FILTER (s < 16)::INT AS shard, arg_min(s, (bid, s))::INT AS grown_shard FROM bids GROUP BY name
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (
    PARTITION BY shard ORDER BY ('0x' || substr(md5(name || ':' || text_crc32), 1, 13))::BIGINT, doc_id NULLS FIRST, text_crc32, size
  ) - 1 AS slot, grown_shard
FROM docs JOIN won USING (name)
"""

# The pieces, words and limits of the contract.
OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
cut AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
words AS (SELECT lang, id, unnest(ws) AS w1, generate_subscripts(ws, 1) AS place FROM cut),
runs AS (
  SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3, lead(w1, 3) OVER p AS w4, lead(w1, 4) OVER p AS w5
  FROM words WINDOW p AS (PARTITION BY id ORDER BY place)
),
grams AS (
  SELECT lang, 1 AS k, w1 AS phrase FROM runs
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM runs WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM runs WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM runs WHERE w4 IS NOT NULL
  UNION ALL SELECT lang, 5, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 FROM runs WHERE w5 IS NOT NULL
),
counts AS (SELECT lang, phrase, k, count(*) AS a FROM grams GROUP BY ALL),
sizes AS (SELECT lang, sum(a)::HUGEINT AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, phrase, k, a, string_split(phrase, ' ') AS ws FROM counts WHERE k > 1 AND a >= 100),
inner_parts AS (
  SELECT c.lang, array_to_string(c.ws[i:j], ' ') AS phrase, max(c.a) AS longer FROM candidates c, range(1, 6) r(i), range(1, 6) q(j)
  WHERE j > i AND j <= c.k AND j - i + 1 < c.k GROUP BY ALL
),
cuts AS (
  SELECT c.lang, c.phrase, c.a, h, array_to_string(c.ws[1:h], ' ') AS head, array_to_string(c.ws[h + 1:c.k], ' ') AS tail FROM candidates c, range(1, 5) r(h) WHERE h < c.k
),
valued AS (
  SELECT x.lang, x.phrase, x.a, x.h, f.a AS l, g.a AS r, n, (1000::HUGEINT * x.a * n) // (f.a::HUGEINT * g.a) AS score
  FROM cuts x JOIN counts f ON f.lang = x.lang AND f.phrase = x.head JOIN counts g ON g.lang = x.lang AND g.phrase = x.tail JOIN sizes s ON s.lang = x.lang
),
best AS (SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, h) = 1),
ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, encode(b.phrase)) AS rank
  FROM best b LEFT JOIN inner_parts i ON i.lang = b.lang AND i.phrase = b.phrase WHERE i.longer IS NULL OR 100 * i.longer < 100 * b.a
)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""

OP13 = f"""
WITH {CRC},
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (SELECT conv_id, {_crc("conv_id::VARCHAR")} % 9 AS h, conv_id - conv_id % 5 AS base FROM (SELECT DISTINCT conv_id FROM turns), crc),
parts AS (
  SELECT c.conv_id, 0 AS half, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.base WHERE place <= h
  UNION ALL SELECT c.conv_id, 1, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id WHERE place > h
),
rebuilt AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY half, place) AS depth, md5(md5(role) || md5(text)) AS turn, strlen(text) AS size FROM parts),
paths AS (
  SELECT conv_id, depth, md5(string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS key, size FROM rebuilt
  UNION ALL SELECT conv_id, 0, 'root', 0 FROM convs
),
marked AS (
  SELECT *, lag(key) OVER w AS parent, lead(depth) OVER w IS NULL AS last FROM paths WINDOW w AS (PARTITION BY conv_id ORDER BY depth)
),
nodes AS (
  SELECT key, depth, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256 FROM marked GROUP BY key, depth
),
children AS (SELECT parent AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent),
around AS (SELECT DISTINCT n.key, n.depth, p.key AS top, n.n_convs, n.size FROM nodes n JOIN paths o ON o.key = n.key AND o.conv_id = n.conv_id JOIN paths p ON p.conv_id = o.conv_id AND p.depth <= o.depth),
below AS (
  SELECT top AS key, count(*) FILTER (c.key IS NULL) AS n_leaves, sum((n_convs - 1) * size)::BIGINT AS saved_tokens
  FROM around a LEFT JOIN children c ON c.key = a.key GROUP BY top
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN below USING (key) LEFT JOIN children USING (key) LEFT JOIN nodes p ON p.key = n.parent
"""

# Weights, limit and word pattern of the contract, and the seed. "Full" sources are those with the lowest limit by weight.
OP10 = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS pick FROM documents
),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, ([5.0, 2.0, 1.0]::DOUBLE[])[(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS weight,
         3.0::DOUBLE * sum(size)::DOUBLE AS most FROM docs GROUP BY source
),
levels AS (
  SELECT *, most / weight <= (sum(source_size) OVER ()::DOUBLE - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                            / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS filled
  FROM sources WINDOW o AS (ORDER BY most / weight, encode(source) NULLS LAST)
),
targets AS (
  SELECT source, source_size, CASE WHEN filled THEN most ELSE
    (sum(source_size) OVER ()::DOUBLE - coalesce(sum(most) FILTER (filled) OVER (), 0)) / nullif(sum(weight) FILTER (NOT filled) OVER (), 0) * weight END AS target
  FROM levels
),
plans AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets
),
ordered AS (
  SELECT d.source, pick, sum(size) AS held, coalesce(sum(sum(size)) OVER (PARTITION BY d.source ORDER BY pick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM docs d GROUP BY d.source, pick
),
cuts AS (
  SELECT o.source, max(pick) FILTER (below + held / 2 <= target - whole * source_size) AS last
  FROM ordered o JOIN plans p ON o.source IS NOT DISTINCT FROM p.source WHERE target - whole * source_size > 0 GROUP BY o.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target, (size * (whole + coalesce(pick <= last, false)::INT))::BIGINT AS taken
FROM docs d JOIN plans p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN cuts c ON d.source IS NOT DISTINCT FROM c.source
"""

ORACLES = {
    "op1_line_dedup": OP1,
    "op4_embedding_near_dedup": OP4,
    "op5_substring_dedup": OP5,
    "op10_mixing": OP10,
    "op11_sharding": OP11,
    "op12_phrase_mining": OP12,
    "op13_prefix_trie": OP13,
}
