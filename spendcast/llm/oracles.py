"""DuckDB SQL for the rows of the queries that SQL can express."""

# Depths of the rounds of line dedup: no document here has more lines.
_DEPTHS = tuple(2**k for k in range(1, 12))
_LONGEST = " UNION ALL ".join(
    f"""SELECT doc_id, s, least(m, {d}) AS n, row_number() OVER (PARTITION BY window_{d}, m < {d} ORDER BY doc_id, s) AS nth
        FROM windows"""
    for d in _DEPTHS
)
_WINDOWS = ", ".join(
    f"md5(string_agg(line, chr(10)) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN CURRENT ROW AND {d - 1} FOLLOWING)) AS window_{d}"
    for d in _DEPTHS
)

# A line goes if it is a long line that occurred before, or half of a pair of lines that did.
OP4 = (
    r"""
WITH l AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
    FROM documents
), nb AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS s,
           len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
    FROM l WHERE trim(line) <> ''
), paired AS (
    SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY s) AS line2 FROM nb
), placed AS (
    SELECT doc_id, s, i, words, line2,
           row_number() OVER (PARTITION BY line ORDER BY doc_id, s) AS nth1,
           row_number() OVER (PARTITION BY line, line2 ORDER BY doc_id, s) AS nth2
    FROM paired
), gone AS (
    SELECT doc_id, s FROM placed WHERE nth1 > 1 AND words >= 50
    UNION SELECT doc_id, s FROM placed WHERE line2 IS NOT NULL AND nth2 > 1
    UNION SELECT doc_id, s + 1 FROM placed WHERE line2 IS NOT NULL AND nth2 > 1
), runs AS (
    SELECT doc_id, run, min(i) AS i1, max(i) AS i2
    FROM (SELECT g.doc_id, nb.i, g.s - row_number() OVER (PARTITION BY g.doc_id ORDER BY g.s) AS run
          FROM gone g JOIN nb ON nb.doc_id = g.doc_id AND nb.s = g.s)
    GROUP BY doc_id, run
), marked AS (
    SELECT l.*, r.run IS NOT NULL AS removed, r.run
    FROM l LEFT JOIN runs r ON l.doc_id = r.doc_id AND l.i BETWEEN r.i1 AND r.i2
), windows AS (
    SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id) - s + 1 AS m, """
    + _WINDOWS
    + r""" FROM nb
), longest AS (
    SELECT doc_id, max(n) AS n FROM ("""
    + _LONGEST
    + r""") WHERE nth > 1 AND n >= 2 GROUP BY doc_id
    UNION ALL SELECT doc_id, 1 FROM placed WHERE nth1 > 1 AND words >= 50
), deepest AS (
    SELECT doc_id, max(n) AS n FROM longest GROUP BY doc_id
)
SELECT doc_id, CAST(count(*) AS INTEGER) AS n_lines, CAST(count(*) FILTER (removed) AS INTEGER) AS n_removed,
       CAST(count(DISTINCT run) AS INTEGER) AS n_runs,
       CAST(coalesce(any_value(deepest.n), 0) AS INTEGER) AS n_longest,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT removed), '')) AS kept_sha256
FROM marked LEFT JOIN deepest USING (doc_id) GROUP BY doc_id
"""
)

# Documents by part and the set of filters they fail; every order adds them up.
OP11 = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), judged AS (
    SELECT doc_id, part,
           CAST(len(words) < 100 AS INT) + 2 * CAST(100 * len(list_distinct(words)) < 80 * len(words) AS INT)
           + 4 * CAST(100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) AS INT)
           + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT)
           + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS INT) AS fails
    FROM d
), marked AS (
    SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id
), counted AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS bad
    FROM judged LEFT JOIN marked USING (doc_id) GROUP BY part, fails
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS b
), orders AS (
    SELECT l1.f || l2.f || l3.f || l4.f || l5.f AS filter_order, [l1.b, l2.b, l3.b, l4.b, l5.b] AS bits
    FROM letters l1, letters l2, letters l3, letters l4, letters l5 WHERE l1.b | l2.b | l3.b | l4.b | l5.b = 31
), steps AS (
    SELECT filter_order, unnest(range(1, 6)) AS step, bits FROM orders
), placed AS (
    SELECT filter_order, step, bits[step] AS own, list_sum(bits[1:step]) - bits[step] AS earlier FROM steps
), found AS (
    SELECT part, filter_order, step, own,
           coalesce(sum(n) FILTER (fails & (earlier | own) = 0), 0) AS kept,
           coalesce(sum(n) FILTER (fails & own > 0 AND fails & earlier = 0), 0) AS removed,
           coalesce(sum(n) FILTER (fails & own > 0 AND fails & earlier > 0), 0) AS redundant,
           coalesce(sum(n) FILTER (fails = own), 0) AS unique_fails,
           coalesce(sum(good) FILTER (fails & own > 0 AND fails & earlier = 0), 0) AS good_lost,
           coalesce(sum(bad) FILTER (fails & own > 0 AND fails & earlier = 0), 0) AS toxic_lost
    FROM counted, (SELECT filter_order, step, CAST(own AS INT) AS own, CAST(earlier AS INT) AS earlier FROM placed)
    GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM found
"""

# crc32 bit by bit: a value of 0 and more is mixed in, -1 is one step.
_CRC32 = """xor(4294967295, list_reduce(
    flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(unicode(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END, 4294967295::BIGINT))"""


def _field(value: str) -> str:
    return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


# Trees level by level, and of every leaf the nodes beside its path.
OP12 = rf"""
WITH RECURSIVE given AS (
    SELECT *, CASE WHEN {_CRC32} % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS claimed_chars FROM documents
), leaves AS (
    SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf('n_chars')} AS leaf, {_leaf('claimed_chars')} AS claimed,
           row_number() OVER (PARTITION BY coalesce('=' || lang, '') ORDER BY doc_id) - 1 AS pos,
           count(*) OVER (PARTITION BY coalesce('=' || lang, '')) AS n
    FROM given
), nodes(tree, level, idx, n, hash) AS (
    SELECT tree, 0, pos, n, leaf FROM leaves
    UNION ALL
    SELECT tree, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(hash, '' ORDER BY idx))
    FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 2, n
), tops AS (
    SELECT tree, hash AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), above(level, idx, n, hash) AS (
    SELECT 1000, pos, n, subroot FROM tops
    UNION ALL
    SELECT level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(hash, '' ORDER BY idx))
    FROM above WHERE n > 1 GROUP BY level, idx // 2, n
), tree_levels AS (
    SELECT DISTINCT tree, level, n FROM nodes WHERE n > 1
), top_levels AS (
    SELECT DISTINCT level, n FROM above WHERE n > 1
), beside AS (
    SELECT l.doc_id, v.level, (l.pos >> v.level) % 2 AS odd, s.hash
    FROM leaves l JOIN tree_levels v USING (tree)
    LEFT JOIN nodes s ON s.tree = l.tree AND s.level = v.level AND s.idx = xor(l.pos >> v.level, 1)
    UNION ALL
    SELECT l.doc_id, v.level, (t.pos >> (v.level - 1000)) % 2, s.hash
    FROM leaves l JOIN tops t USING (tree), top_levels v
    LEFT JOIN above s ON s.level = v.level AND s.idx = xor(t.pos >> (v.level - 1000), 1)
), proofs AS (
    SELECT doc_id, coalesce(string_agg(hash, '' ORDER BY level), '') AS hashes,
           list(CASE WHEN odd = 1 THEN 'L' ELSE 'R' END || coalesce(hash, '') ORDER BY level) AS steps
    FROM beside GROUP BY doc_id
), folded AS (
    SELECT l.*, sha256(coalesce(p.hashes, '')) AS proof_sha256,
           list_reduce(coalesce(p.steps, []), lambda a, x: sha256(CASE WHEN x[1] = 'L' THEN x[2:] || a ELSE a || x[2:] END), l.claimed)
           AS folded_root
    FROM leaves l LEFT JOIN proofs p USING (doc_id)
)
SELECT f.doc_id, f.leaf, t.subroot, r.hash AS root, f.proof_sha256, f.folded_root, f.folded_root = r.hash AS verified
FROM folded f JOIN tops t USING (tree), (SELECT hash FROM above WHERE n = 1) r
"""

# Every pair of documents that shares a shingle, counted.
OP13 = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
        FROM d)
), sizes AS (
    SELECT d.doc_id, count(s) AS n FROM d LEFT JOIN shingles USING (doc_id) GROUP BY d.doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM d
    UNION
    SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a
)
SELECT r.doc_id, any_value(n) AS n_shingles, min(other) AS component_id
FROM reached r JOIN sizes USING (doc_id) GROUP BY r.doc_id
"""
