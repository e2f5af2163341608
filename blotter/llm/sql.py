"""DuckDB SQL for whole results of operators whose method SQL can state plainly, by plainer means: all pairs, unrolled rounds, window functions."""

from __future__ import annotations

#: Sets of three-word shingles, all pairs of classes that share one, and what each class reaches by links.
SHINGLE_GROUPS = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE
    WHEN len(w) = 0 THEN []::VARCHAR[]
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS grams
  FROM d
), c AS (
  SELECT min(doc_id) AS id, grams, len(grams) AS n FROM (SELECT doc_id, list_sort(grams) AS grams FROM s) GROUP BY grams HAVING len(grams) > 0
), x AS (
  SELECT id, n, unnest(grams) AS g FROM c
), p AS (
  SELECT a.id AS a, b.id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k
  FROM x a JOIN x b ON a.g = b.g AND a.id < b.id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.id, b.id
), e AS (
  SELECT a, b FROM p WHERE 100 * k >= 90 * (na + nb - k)
), both_ways AS (
  SELECT a, b FROM e UNION SELECT b, a FROM e
), reach AS (
  SELECT id AS node, id AS low FROM c
  UNION
  SELECT t.b, r.low FROM reach r JOIN both_ways t ON t.a = r.node WHERE r.low < t.b
), comp AS (
  SELECT node, min(low) AS component FROM reach GROUP BY node
), cls AS (
  SELECT c.grams, c.id AS class_id, comp.component FROM c JOIN comp ON comp.node = c.id
)
SELECT s.doc_id, len(s.grams) AS n_shingles, coalesce(cls.component, s.doc_id) AS component_id, coalesce(cls.class_id, s.doc_id) AS class_id
FROM s LEFT JOIN cls ON cls.grams = list_sort(s.grams)
"""

#: Every string of 100 bytes, those that start earlier too, and the runs that these cover; by MD5 of the bytes in hexadecimal digits.
REPEATED_BYTES = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents
), starts AS (
  SELECT doc_id, digits, unnest(range(0, len(digits) // 2 - 99)) AS i FROM d
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, md5(substr(digits, 2 * i + 1, 200)) AS bytes FROM starts)
  QUALIFY row_number() OVER (PARTITION BY bytes ORDER BY doc_id, i) > 1
), cut AS (
  SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM again
), numbered AS (
  SELECT doc_id, i, sum(CASE WHEN i <= before + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM cut
), runs AS (
  SELECT doc_id, run, min(i) AS lo, max(i) + 100 AS hi FROM numbered GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, run, lo, hi, lag(hi, 1, 0) OVER (PARTITION BY doc_id ORDER BY run) AS after FROM runs
), parts AS (
  SELECT g.doc_id, string_agg(substr(d.digits, 2 * g.after + 1, 2 * (g.lo - g.after)), '' ORDER BY g.run) AS head,
         sum(g.hi - g.lo) AS n_removed, count(*) AS n_spans, max(g.hi) AS hi
  FROM gaps g JOIN d ON d.doc_id = g.doc_id GROUP BY g.doc_id
)
SELECT d.doc_id, len(digits) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(digits, 2 * coalesce(hi, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN parts ON parts.doc_id = d.doc_id
"""

#: crc32 of a string's UTF-8 bytes, from the reversed polynomial 0xEDB88320; ``crcs`` is its table of 256 numbers, made by rule.
_CRC_TABLE = """crc AS (
  SELECT list(list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS crcs
  FROM range(0, 256) AS r(i)
)"""


def _crc(text: str) -> str:
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda b: ('0x' || b)::BIGINT)"
    return f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


#: DuckDB's edit distance counts bytes, so U+00C0 to U+00FF are written as one byte each that no word has (U+0021 to U+0060).
_FLAT_FROM = "".join(chr(0xC0 + k) for k in range(64))
_FLAT_TO = "".join(chr(0x21 + k) for k in range(64)).replace("'", "''")

#: Words with their counts, near words from all pairs of near lengths, and chains of forms by recursion.
SPELLING = rf"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT id, run, count(*) AS k
  FROM (SELECT coalesce(doc_id::VARCHAR, '') AS id,
               translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
        FROM documents)
  GROUP BY ALL
), hashed AS (
  SELECT run, k, {_crc("id || ':' || run")} AS h FROM runs, crc
), slipped AS (
  SELECT k, CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed
), words AS MATERIALIZED (
  SELECT word, translate(word, '{_FLAT_FROM}', '{_FLAT_TO}') AS flat, sum(k)::BIGINT AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5
), near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n AS m
  FROM words a JOIN words b ON length(b.word) BETWEEN length(a.word) - 1 AND length(a.word) + 1
  WHERE a.word <> b.word AND levenshtein(a.flat, b.flat) = 1
), best AS (
  SELECT word, count(*) AS n_near, min({{'less': -m, 'other': other}}) AS top FROM near GROUP BY word
), found AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -top.less >= 5 * w.n THEN top.other END AS form,
         CASE WHEN -top.less >= 5 * w.n THEN -top.less END AS form_n
  FROM words w LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS here, 0 AS step FROM found
  UNION ALL
  SELECT c.word, f.form, c.step + 1 FROM chain c JOIN found f ON f.word = c.here WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM found f JOIN (SELECT word, arg_max(here, step) AS root FROM chain GROUP BY word) r USING (word)
"""

#: N-grams word by word, profiles by row numbers, distances by a join of each document's profile with all languages.
LANGUAGES = rf"""
WITH {_CRC_TABLE},
docs AS (
  SELECT row_number() OVER () AS row, doc_id, lang, {_crc("doc_id::VARCHAR")} % 3 = 1 AS held_out, regexp_extract_all(lower(text), '\p{{L}}+') AS words FROM documents, crc
), padded AS (
  SELECT row, ' ' || unnest(words) || ' ' AS w FROM docs
), grams AS (
  SELECT row, unnest(list_transform(range(2, length(w)), lambda i: substr(w, i, 1))) AS g FROM padded
  UNION ALL SELECT row, unnest(list_transform(range(1, length(w)), lambda i: substr(w, i, 2))) FROM padded
  UNION ALL SELECT row, unnest(list_transform(range(1, length(w) - 1), lambda i: substr(w, i, 3))) FROM padded
), counted AS MATERIALIZED (
  SELECT row, g, count(*) AS n FROM grams GROUP BY row, g
), learned AS (
  SELECT lang, g, row_number() OVER (PARTITION BY lang ORDER BY sum(n) DESC, length(g), g) - 1 AS rank
  FROM counted JOIN docs USING (row)
  WHERE NOT held_out AND lang IS NOT NULL
  GROUP BY lang, g
), profiles AS MATERIALIZED (
  SELECT * FROM learned WHERE rank < 300
), own AS MATERIALIZED (
  SELECT row, g, rank FROM (SELECT row, g, row_number() OVER (PARTITION BY row ORDER BY n DESC, length(g), g) - 1 AS rank FROM counted) WHERE rank < 300
), shared AS (
  SELECT o.row, p.lang, sum(300 - abs(o.rank - p.rank)) AS saved FROM own o JOIN profiles p USING (g) GROUP BY o.row, p.lang
), sizes AS (
  SELECT row, 300 * count(*) AS largest FROM own GROUP BY row
), far AS (
  SELECT s.row, l.lang, largest, largest - coalesce(saved, 0) AS distance
  FROM sizes s CROSS JOIN (SELECT DISTINCT lang FROM profiles) l LEFT JOIN shared h ON h.row = s.row AND h.lang = l.lang
), nearest AS (
  SELECT row, any_value(largest) AS largest, min({{'distance': distance, 'lang': lang}}) AS top FROM far GROUP BY row
)
SELECT doc_id, coalesce(held_out, false) AS held_out, coalesce(top.lang, 'und') AS lang_pred, coalesce(1 - top.distance::DOUBLE / largest::DOUBLE, 0) AS score
FROM docs LEFT JOIN nearest USING (row)
"""


def _vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Rounds written out one after the other; the nearest entry from all of a part's entries."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cut AS MATERIALIZED (
  SELECT row, vec_id, part, list_slice(v, part * (len(v) // {parts}) + 1, (part + 1) * (len(v) // {parts})) AS x FROM kept, range(0, {parts}) AS r(part)
), book0 AS MATERIALIZED (
  SELECT part, entry, x AS c FROM (SELECT part, x, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM cut) WHERE entry < {entries}
)"""]
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
  SELECT row, part, any_value(x) AS x, min({{'d': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': entry}}) AS best
  FROM cut JOIN book{k} USING (part) GROUP BY row, part
)""")
        if k < rounds:
            steps.append(f"""sums{k} AS (
  SELECT part, entry, place, sum(y)::BIGINT AS s, count(*) AS n
  FROM (SELECT part, best.e AS entry, unnest(x) AS y, unnest(range(0, len(x))) AS place FROM near{k}) GROUP BY part, entry, place
), mean{k} AS (
  SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY place) AS c FROM sums{k} GROUP BY part, entry
), book{k + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN mean{k} m ON m.part = b.part AND m.entry = b.entry
)""")
    return "WITH" + ", ".join(steps) + f""", coded AS (
  SELECT row, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM near{rounds} GROUP BY row
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (row)
"""


VECTOR_CODES = _vector_codes()
