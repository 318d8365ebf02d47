"""The same results as SQL, where SQL can express them."""

from millrace.llm import codes, decontaminate, lexical, lines

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = f"""
WITH pages AS (SELECT row_number() OVER () AS r, doc_id, text, source, string_split(text, chr(10)) AS lines FROM documents),
texts AS (SELECT DISTINCT source, text FROM documents),
once AS (SELECT DISTINCT source, text, trim(line) AS line FROM (SELECT source, text, unnest(string_split(text, chr(10))) AS line FROM texts) WHERE trim(line) <> ''),
counts AS (SELECT source, line, count(*) AS n FROM once GROUP BY ALL),
totals AS (SELECT source, count(*) AS pages FROM texts GROUP BY ALL),
bad AS (SELECT c.source, c.line FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
        WHERE c.n >= {lines.MIN_PAGES} AND c.n > {lines.RATIO}::DOUBLE * t.pages),
numbered AS (SELECT r, source, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM pages),
kept AS (SELECT n.r, string_agg(n.line, chr(10) ORDER BY n.i) AS text, count(*) AS n
         FROM numbered n LEFT JOIN bad b ON n.source IS NOT DISTINCT FROM b.source AND trim(n.line) = b.line
         WHERE b.line IS NULL GROUP BY n.r)
SELECT doc_id, CASE WHEN p.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(len(lines), 0)::BIGINT AS n_lines, (coalesce(len(lines), 0) - coalesce(k.n, 0))::BIGINT AS n_dropped
FROM pages p LEFT JOIN kept k USING (r)
"""

OP3 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{decontaminate.WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{decontaminate.WORD}') AS w FROM benchmark),
c AS (SELECT item_id, w, least(len(w), {decontaminate.WINDOW_WORDS}) AS l FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, l, array_to_string(w[i : i + l - 1], ' ') AS k
       FROM (SELECT *, unnest(generate_series(1, len(w) - l + 1)) AS i FROM c)),
dw AS (SELECT r, i, l, array_to_string(w[i : i + l - 1], ' ') AS k
       FROM (SELECT r, w, l, unnest(generate_series(1, len(w) - l + 1)) AS i
             FROM d, (SELECT DISTINCT l FROM bw) WHERE len(w) >= l)),
hit AS (SELECT DISTINCT r, i, l, item_id FROM dw JOIN bw USING (l, k)),
places AS (SELECT r, count(*) AS n
           FROM (SELECT DISTINCT r, unnest(generate_series(i, i + l - 1)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(p.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(p.n, 0) > 0 AS contaminated
FROM d LEFT JOIN places p USING (r) LEFT JOIN items t USING (r)
"""

_SPACED = r"[^\x20\x09-\x0D]+"

OP9 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACED}') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS s
       FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 4)
       UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 3),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT a AS x, b AS y FROM links UNION SELECT r.x, l.b FROM reach r JOIN links l ON r.y = l.a),
least AS (SELECT x AS doc_id, min(y) AS m FROM reach GROUP BY x)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id,
       doc_id <= coalesce(m, doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)
"""

OP8 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS h
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d WHERE len(w) >= 50)),
least AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
bad AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS p FROM win JOIN least USING (h) WHERE doc_id > m),
each AS (SELECT doc_id, unnest(w) AS x, unnest(generate_series(1, len(w))) AS p FROM d),
kept AS (SELECT e.doc_id, string_agg(x, ' ' ORDER BY e.p) AS t, count(*) AS n FROM each e ANTI JOIN bad USING (doc_id, p) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP7 = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS w FROM documents),
sized AS (SELECT r, doc_id, len(w)::BIGINT AS n FROM d WHERE len(w) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM sized),
tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL),
q AS (SELECT item_id, text, term, count(*)::BIGINT AS repeats
      FROM (SELECT item_id, text, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, total),
s AS (SELECT item_id, text, doc_id, r, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words))))::BIGINT AS score
      FROM q JOIN tf USING (term) JOIN w USING (term) JOIN sized USING (r), total GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM s WHERE score > 0) WHERE rank <= {lexical.K}
"""


def _op13() -> str:
    """All rounds, one after the other."""
    floor_div = "(total - ((total % n) + n) % n) // n"
    steps = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor({codes.SCALE} * x::DOUBLE)::BIGINT) AS e
            FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""p AS MATERIALIZED (SELECT r, part, e[part * len(e) // {codes.PARTS} + 1 : (part + 1) * len(e) // {codes.PARTS}] AS x
            FROM v, (SELECT unnest(range({codes.PARTS})) AS part))""",
        f"""c0 AS MATERIALIZED (SELECT part, dense_rank() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x FROM p JOIN v USING (r)
            WHERE vec_id IN (SELECT DISTINCT vec_id FROM v ORDER BY vec_id LIMIT {codes.ENTRIES}))""",
    ]
    for t in range(codes.ROUNDS + 1):
        far = "list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
        steps.append(f"a{t} AS MATERIALIZED (SELECT p.r, p.part, min({far} * {codes.ENTRIES} + c.entry) AS k FROM p JOIN c{t} c USING (part) GROUP BY ALL)")
        if t < codes.ROUNDS:
            steps.append(
                f"""c{t + 1} AS MATERIALIZED (WITH each AS (SELECT part, k % {codes.ENTRIES} AS entry, unnest(x) AS y, unnest(range(len(x))) AS i FROM a{t} JOIN p USING (r, part)),
                sums AS (SELECT part, entry, i, sum(y)::BIGINT AS total, count(*) AS n FROM each GROUP BY ALL),
                moved AS (SELECT part, entry, list({floor_div} ORDER BY i) AS x FROM sums GROUP BY ALL)
                SELECT part, entry, coalesce(m.x, c.x) AS x FROM c{t} c LEFT JOIN moved m USING (part, entry))"""
            )
    last = codes.ROUNDS
    steps.append(
        f"""coded AS (SELECT r, string_agg(printf('%02x', (k % {codes.ENTRIES})::INT), '' ORDER BY part) AS code, sum(k // {codes.ENTRIES})::BIGINT AS error FROM a{last} GROUP BY r)"""
    )
    return f"""WITH {", ".join(steps)}
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
           (SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY part, entry, i)) FROM (SELECT part, entry, unnest(x) AS y, unnest(range(len(x))) AS i FROM c{last})) AS codebooks_sha256
    FROM v JOIN coded USING (r)"""


OP13 = _op13()

ORACLE: dict[str, str] = {
    "op2_lines": OP2,
    "op3_decontaminate": OP3,
    "op7_topk": OP7,
    "op8_repeats": OP8,
    "op9_minhash": OP9,
    "op12_lexical": OP12,
    "op13_codes": OP13,
}
