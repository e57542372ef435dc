"""SQL that gives the same rows as a query, where SQL can."""

_COMPONENTS = """
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (
    SELECT id, id FROM nodes
    UNION
    SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a
),
component AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)
"""

EMBEDDING_DEDUP = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
usable AS (
    SELECT vec_id, label, e FROM v
    WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0
),
links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
    ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.93
),
nodes AS (SELECT vec_id AS id FROM embeddings),
{_COMPONENTS},
degree AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept
FROM component LEFT JOIN degree ON a = id
"""

SUFFIX_DEDUP = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
-- pieces of 1,000 bytes and the 199 after them, so that no window is cut out of a long string
piece AS (SELECT doc_id, pos, substr(h, 2 * pos + 1, 2398) AS p FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2, 1000)) AS pos FROM d)),
win AS (
    SELECT doc_id, pos + i AS start, md5(substr(p, 2 * i + 1, 400)) AS g
    FROM (SELECT doc_id, pos, p, unnest(range(0, least(1000, length(p) // 2 - 199))) AS i FROM piece)
),
twice AS (SELECT g FROM win GROUP BY g HAVING count(*) > 1),
hit AS (SELECT doc_id, start FROM win WHERE g IN (SELECT g FROM twice)),
marked AS (
    SELECT doc_id, start, CASE WHEN start <= lag(start) OVER (PARTITION BY doc_id ORDER BY start) + 200 THEN 0 ELSE 1 END AS new FROM hit
),
numbered AS (SELECT doc_id, start, sum(new) OVER (PARTITION BY doc_id ORDER BY start) AS k FROM marked),
span AS (SELECT doc_id, k, min(start) AS a, max(start) + 200 AS b FROM numbered GROUP BY doc_id, k),
gap AS (
    SELECT doc_id, coalesce(lag(b) OVER w, 0) AS a, a AS b FROM span WINDOW w AS (PARTITION BY doc_id ORDER BY a)
    UNION ALL SELECT doc_id, max(b), NULL FROM span GROUP BY doc_id
),
stays AS (
    SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, length(h) // 2) - a)), '' ORDER BY a) AS r FROM gap JOIN d USING (doc_id)
    GROUP BY doc_id
),
told AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans FROM span GROUP BY doc_id)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(r, h))) AS kept_sha256
FROM d LEFT JOIN told USING (doc_id) LEFT JOIN stays USING (doc_id)
"""

JACCARD_JOIN = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
),
s AS (
    SELECT doc_id, CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
    END AS s FROM w
),
t AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb, count(*) AS c FROM t x JOIN t y ON x.g = y.g AND x.doc_id < y.doc_id
    GROUP BY ALL
),
links AS (SELECT a, b FROM shared WHERE 100 * c >= 85 * (na + nb - c)),
nodes AS (SELECT doc_id AS id FROM documents),
{_COMPONENTS}
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM s JOIN component ON id = doc_id
"""

LEXICAL_SEARCH = r"""
WITH term AS (
    SELECT doc_id, unnest(list_filter(string_split_regex(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS t
    FROM documents
),
posting AS (SELECT doc_id, t, count(*)::BIGINT AS tf FROM term GROUP BY ALL),
length AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM posting GROUP BY doc_id),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS l FROM length),
weight AS (
    SELECT t, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM posting, total GROUP BY t
),
norm AS (SELECT doc_id, 100 - 90 + (90 * n * docs) // l AS m FROM length, total),
asked AS (
    SELECT DISTINCT item_id, unnest(list_filter(string_split_regex(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS t
    FROM benchmark
),
scored AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM asked JOIN posting USING (t) JOIN weight USING (t) JOIN norm USING (doc_id) GROUP BY ALL
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""



def _vector_codes(rounds: int) -> str:
    """Codebooks round by round: each round is a handful of named steps over the one before it."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
        a{i} AS (
            SELECT id, p, min_by(e, d * 256 + e) AS e, min(d) AS d
            FROM (SELECT x.id, x.p, c.e, list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
                  FROM part x JOIN c{i} c ON x.p = c.p)
            GROUP BY id, p
        )""")
        if i < rounds:
            steps.append(f"""
        s{i} AS (
            SELECT p, e, list(m ORDER BY k) AS v
            FROM (SELECT p, e, k, floor(sum(x)::DOUBLE / count(*))::BIGINT AS m
                  FROM (SELECT a.p, a.e, unnest(x.v) AS x, unnest(range(len(x.v))) AS k FROM a{i} a JOIN part x ON a.id = x.id AND a.p = x.p)
                  GROUP BY p, e, k)
            GROUP BY p, e
        ),
        c{i + 1} AS (SELECT c.p, c.e, coalesce(s.v, c.v) AS v FROM c{i} c LEFT JOIN s{i} s ON c.p = s.p AND c.e = s.e)""")
    return f"""
    WITH kept AS (
        SELECT row_number() OVER (ORDER BY vec_id, embedding) AS id, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS v
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    part AS (SELECT id, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] AS v FROM kept, (SELECT unnest(range(4)) AS p)),
    c0 AS (SELECT p, id - 1 AS e, v FROM part WHERE id <= 256),
    {",".join(steps)},
    book AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds}),
    coded AS (SELECT id, string_agg(printf('%02x', e::INTEGER), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY id)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
    FROM kept JOIN coded USING (id), book
    """


ORACLES = {"op3_embedding_dedup": EMBEDDING_DEDUP, "op8_suffix_dedup": SUFFIX_DEDUP, "op10_jaccard_join": JACCARD_JOIN, "op11_lexical_search": LEXICAL_SEARCH, "op13_vector_codes": _vector_codes(4)}
