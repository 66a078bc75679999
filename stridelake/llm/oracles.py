"""DuckDB SQL for the queries that SQL can express whole.

Written from the contracts, by enumeration: every 50-byte string and every
8-word window is a row. The other queries have hashes, tokens, samples or
models that SQL has no means for.
"""

SUFFIX_DEDUP = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(COALESCE(text, ''))) AS h,
         octet_length(encode(COALESCE(text, ''))) AS n
  FROM documents),
blocks AS (  -- 256 starts each: cutting short texts is quick
  SELECT r, doc_id, a, substring(h, CAST(2 * a + 1 AS BIGINT), 610) AS part, least(256, n - 49 - a) AS starts
  FROM (SELECT *, unnest(range(0, greatest(n - 49, 0), 256)) AS a FROM d)),
strings AS (
  SELECT r, doc_id, a + j AS i, substring(part, CAST(2 * j + 1 AS BIGINT), 100) AS s
  FROM (SELECT *, unnest(range(0, starts)) AS j FROM blocks)),
first AS (SELECT s, MIN(doc_id) AS least FROM strings GROUP BY s HAVING COUNT(*) > 1),
hits AS (SELECT r, i FROM strings JOIN first USING (s) WHERE least < doc_id),
steps AS (SELECT r, i, CASE WHEN i > 50 + LAG(i) OVER w OR LAG(i) OVER w IS NULL THEN 1 ELSE 0 END AS opens
          FROM hits WINDOW w AS (PARTITION BY r ORDER BY i)),
numbered AS (SELECT r, i, SUM(opens) OVER (PARTITION BY r ORDER BY i) AS run FROM steps),
spans AS (SELECT r, run, MIN(i) AS a, MAX(i) + 50 AS b FROM numbered GROUP BY r, run),
pieces AS (SELECT r, a, b, COALESCE(LAG(b) OVER (PARTITION BY r ORDER BY a), 0) AS since FROM spans),
gone AS (
  SELECT r, COUNT(*) AS n_spans, SUM(b - a) AS n_removed, MAX(b) AS last,
         string_agg(substring(h, CAST(2 * since + 1 AS BIGINT), CAST(2 * (a - since) AS BIGINT)), '' ORDER BY a) AS before
  FROM pieces JOIN d USING (r) GROUP BY r)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(COALESCE(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(COALESCE(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(COALESCE(before || substring(h, CAST(2 * last + 1 AS BIGINT)), h))) AS kept_sha256
FROM d LEFT JOIN gone USING (r)"""

_WORDS = r"'[^\x20\x09-\x0D]+'"
_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000')"

LINE_RULES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, COALESCE(text, '') AS t,
         regexp_extract_all(COALESCE(text, ''), {_WORDS}) AS words
  FROM documents),
lines AS (
  SELECT r, source, t, line, array_to_string(regexp_extract_all({_FOLD.format('line')}, {_WORDS}), ' ') AS folded,
         len(regexp_extract_all(line, {_WORDS})) AS n
  FROM (SELECT r, source, t, unnest(string_split(t, chr(10))) AS line FROM d)),
real AS (SELECT * FROM lines WHERE n > 0),
common AS (SELECT source, folded FROM real GROUP BY source, folded HAVING COUNT(DISTINCT t) > 100),
by_line AS (
  SELECT r, COUNT(*) AS n_lines, COUNT(*) - COUNT(DISTINCT line) AS n_dup, COUNT(c.folded) AS n_common,
         SUM(CASE WHEN c.folded IS NOT NULL THEN n ELSE 0 END) AS lost
  FROM real LEFT JOIN common c ON c.folded = real.folded AND c.source IS NOT DISTINCT FROM real.source GROUP BY r),
windows AS (
  SELECT r, i, array_to_string(words[i:i + 7], ' ') AS g
  FROM (SELECT r, words, unnest(range(1, greatest(len(words) - 6, 1))) AS i FROM d)),
twice AS (SELECT r, i FROM windows QUALIFY COUNT(*) OVER (PARTITION BY r, g) > 1),
repeats AS (SELECT r, COUNT(DISTINCT k) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS k FROM twice) GROUP BY r),
counted AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(COALESCE(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(COALESCE(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(COALESCE(n, 0) AS BIGINT) AS n_repeat_words,
         CAST(COALESCE(n_lines, 0) AS BIGINT) AS n_lines, CAST(COALESCE(n_common, 0) AS BIGINT) AS n_common_lines,
         CAST(len(words) - COALESCE(lost, 0) AS BIGINT) AS n_words_left
  FROM d LEFT JOIN by_line USING (r) LEFT JOIN repeats USING (r)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT *, NOT base_failed AND 2 * n_words_left >= n_words AS kept FROM judged"""

#: op12: every conversation's prefixes as lists, their ancestors exploded. The
#: checksum is worked out bit by bit.
CONVERSATION_TRIE = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
           PARTITION BY conv_id
           ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ' ' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
said AS (SELECT conv_id, pos, strlen(text) AS n_bytes, dense_rank() OVER (ORDER BY role, text) AS what FROM turns),
ids AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
               lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
             lambda acc, b: xor(xor(acc, b) >> 1, 3988292384 * (xor(acc, b) & 1))), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM said)),
kept AS (
  SELECT ids.conv_id, 0 AS half, pos, what, n_bytes FROM ids JOIN said ON said.conv_id = base AND pos <= h
  UNION ALL SELECT ids.conv_id, 1, pos, what, n_bytes FROM ids JOIN said ON said.conv_id = ids.conv_id AND pos > h),
chains AS (
  SELECT ids.conv_id, coalesce(list(what ORDER BY half, pos) FILTER (what IS NOT NULL), []) AS chain,
         coalesce(list(n_bytes ORDER BY half, pos) FILTER (what IS NOT NULL), []) AS sizes
  FROM ids LEFT JOIN kept ON kept.conv_id = ids.conv_id GROUP BY ids.conv_id),
prefixes AS (
  SELECT conv_id, d AS depth, chain[1:d] AS node, len(chain) = d AS ends_here, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS n_bytes
  FROM (SELECT *, unnest(range(0, len(chain) + 1)) AS d FROM chains)),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(n_bytes) AS own_saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends_here), '')) AS ends_sha256
  FROM prefixes GROUP BY node, depth),
born AS (SELECT node[1:depth - 1] AS mother, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
shaped AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN born ON mother = node),
below AS (
  SELECT node[1:a] AS top, count(*) FILTER (n_children = 0) AS n_leaves, sum(own_saved) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM shaped) GROUP BY 1)
SELECT s.conv_id, s.depth, mother.conv_id AS parent_conv_id, s.n_convs, s.n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, s.ends_sha256
FROM shaped s JOIN below ON top = s.node LEFT JOIN nodes mother ON s.depth > 0 AND mother.node = s.node[1:s.depth - 1]"""


def vector_codes(parts: int = 16, width: int = 4, entries: int = 64, rounds: int = 2) -> str:
    """op13: every part against every entry of its codebook, round by round."""
    axes = range(1, width + 1)

    def distances(books: str) -> str:
        square = " + ".join(f"(part.x{i} - {books}.x{i}) * (part.x{i} - {books}.x{i})" for i in axes)
        return f"SELECT r, part.p, entry, {square} AS far FROM part JOIN {books} ON {books}.p = part.p"

    steps = []
    for k in range(rounds + 1):
        steps.append(f"""given{k} AS (
  SELECT r, p, arg_min(entry, far * {entries} + entry) AS entry, min(far) AS far FROM ({distances(f'books{k}')}) GROUP BY r, p)""")
        if k < rounds:
            means = ", ".join(f"CAST(floor(sum(part.x{i}) / count(*)) AS BIGINT) AS x{i}" for i in axes)
            chosen = ", ".join(f"coalesce(m.x{i}, b.x{i}) AS x{i}" for i in axes)
            steps.append(f"""books{k + 1} AS (
  SELECT b.p, b.entry, {chosen} FROM books{k} b LEFT JOIN (
    SELECT part.p, entry, {means} FROM part JOIN given{k} USING (r, p) GROUP BY part.p, entry) m USING (p, entry))""")
    columns = ", ".join(f"v[p * {width} + {i}] AS x{i}" for i in axes)
    return f"""
WITH kept AS (
  SELECT vec_id, label, v, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS r
  FROM (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
part AS (SELECT r, p, {columns} FROM kept, range({parts}) t(p)),
books0 AS (SELECT p, r AS entry, {', '.join(f'x{i}' for i in axes)} FROM part WHERE r < {entries}),
{','.join(steps)},
coded AS (
  SELECT r, string_agg(printf('%02x', entry), '' ORDER BY p) AS code, CAST(sum(far) AS BIGINT) AS error
  FROM given{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, entry, i)) FROM (
          SELECT p, entry, unnest(range({width})) AS i, unnest([{', '.join(f'x{i}' for i in axes)}]) AS x FROM books{rounds})) AS codebooks_sha256
FROM kept JOIN coded USING (r)"""


VECTOR_CODES = vector_codes()
