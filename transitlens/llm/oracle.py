"""DuckDB SQL for the queries that SQL can express, by plain brute force."""

from __future__ import annotations

from transitlens.llm import mixing, quality_rules

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP1 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, unnest(list_transform(range(0, len(h) // 2 - 49), lambda i: {'i': i, 's': md5(substr(h, 2 * i + 1, 100))}),
  recursive := true) FROM d),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS m FROM win) WHERE doc_id > m),
marked AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new FROM hit),
numbered AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM marked),
runs AS (SELECT doc_id, g, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY doc_id, g),
edges AS (
  SELECT doc_id, coalesce(lag(b) OVER w, 0) AS x, a AS y FROM runs WINDOW w AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL
  SELECT d.doc_id, coalesce(r.b, 0), len(d.h) // 2 FROM d LEFT JOIN (SELECT doc_id, max(b) AS b FROM runs GROUP BY doc_id) r
    USING (doc_id)),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' ORDER BY x) AS k FROM edges JOIN d USING (doc_id) GROUP BY doc_id),
spans AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS n FROM runs GROUP BY doc_id)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
  sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN spans USING (doc_id)
"""

_OP2 = f"""
WITH sizes AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
        FROM sizes GROUP BY source),
weighed AS (SELECT *, [{', '.join(f'{w}.0' for w in mixing.WEIGHTS)}][(rank % {len(mixing.WEIGHTS)}) + 1]::DOUBLE AS weight,
            (source_size * {mixing.MAX_EPOCHS})::DOUBLE AS cap,
            sum(source_size) OVER () * {mixing.SHARE_PCT} / 100.0 AS total FROM src),
level AS (SELECT max((total - before) / weights) AS lv FROM (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM weighed) WHERE cap * weights > weight * (total - before)),
target AS (SELECT source, source_size, rank, coalesce(least(cap, weight * lv), cap) AS target FROM weighed, level),
seats AS (SELECT round(sum(target) / {mixing.BLOCK_WORDS}) AS k FROM target),
bids AS (SELECT rank, target / (2 * j - 1) AS q, j FROM target,
         unnest(range(1, (source_size * {mixing.MAX_EPOCHS} // {mixing.BLOCK_WORDS} + 40)::BIGINT)) AS u(j)),
blocks AS (SELECT rank, count(*) AS blocks FROM (SELECT rank, row_number() OVER (ORDER BY q DESC, rank, j) AS p FROM bids), seats
           WHERE p <= k GROUP BY rank),
sharded AS (
  SELECT s.*, t.rank, t.source_size, t.target, coalesce(b.blocks, 0) AS blocks,
    ('0x' || substr(md5('1-shard:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT
      % greatest(ceil(t.source_size / {mixing.SHARD_WORDS}), 1)::BIGINT AS shard,
    ('0x' || substr(md5('1-place:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT AS place
  FROM sizes s JOIN target t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN blocks b ON b.rank = t.rank),
shards AS (SELECT rank, shard, sum(size)::BIGINT AS words, max(blocks) AS blocks FROM sharded GROUP BY rank, shard),
shard_bids AS (SELECT rank, shard, blocks, words::DOUBLE / (2 * j - 1) AS q, j FROM shards,
               unnest(range(1, (words * {mixing.MAX_EPOCHS} // {mixing.BLOCK_WORDS} + 40)::BIGINT)) AS u(j)),
quotas AS (SELECT rank, shard, count(*) AS quota FROM (
             SELECT *, row_number() OVER (PARTITION BY rank ORDER BY q DESC, shard, j) AS p FROM shard_bids)
           WHERE p <= blocks GROUP BY rank, shard),
taking AS (
  SELECT rank, shard, n, q // n AS base, f * {mixing.BLOCK_WORDS} AS x, (f + q % n) * {mixing.BLOCK_WORDS} AS y, n * {mixing.BLOCK_WORDS} AS ring
  FROM (SELECT s.rank, s.shard, ceil(words / {mixing.BLOCK_WORDS})::BIGINT AS n,
          least(coalesce(quota, 0), {mixing.MAX_EPOCHS} * ceil(words / {mixing.BLOCK_WORDS}))::BIGINT AS q,
          ('0x' || substr(md5('1-from:' || s.rank || '-' || s.shard), 1, 8))::BIGINT
            % greatest(ceil(words / {mixing.BLOCK_WORDS}), 1)::BIGINT AS f
        FROM shards s LEFT JOIN quotas USING (rank, shard)) WHERE n > 0),
laid AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY rank, shard ORDER BY place, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM sharded)
SELECT doc_id, size, source_size, target,
  coalesce(base * size + greatest(least(y, ring, a + size) - greatest(x, a), 0) + greatest(least(y - ring, a + size) - a, 0), 0)::BIGINT AS taken
FROM laid LEFT JOIN taking USING (rank, shard)
"""

_OP4 = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
grams AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
          FROM items, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS u(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM grams),
seen AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM words, sizes, unnest(range(1, len(w) - n + 2)) AS u(i)),
hits AS (SELECT doc_id, n, i, item FROM seen JOIN grams USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS u(p) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits)
          GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_OP5 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
f AS (SELECT page_id, octet_length(b) AS payload_bytes, min(page_id) OVER (PARTITION BY b) AS first,
        (unhex(sha1(b))::BIT)::VARCHAR AS bits FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (list_sum(list_transform(range(1, 6), lambda j: (2 ** (5 - j))::BIGINT * substr(bits, (i * 5 + j)::BIGINT, 1)::BIGINT)) + 1)::BIGINT, 1)), '')
    AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""

_OP7 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
tri AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM d, unnest(range(1, len(w) - 1)) AS u(i)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM twice, unnest([i, i + 1, i + 2]) AS u(p) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT l) AS dup FROM d, unnest(string_split(t, chr(10))) AS u(l)
          WHERE regexp_matches(l, '{_WORD}') GROUP BY doc_id),
stats AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(l.n, 0) AS n_lines,
    coalesce(l.dup, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z\x{{80}}-\x{{10FFFF}}]'))) AS letters
  FROM d LEFT JOIN rep r USING (doc_id) LEFT JOIN lines l USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PCT} * n_words) AS base_failed,
  NOT (n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PCT} * n_words
    OR 100 * n_symbols > {quality_rules.MAX_SYMBOL_PCT} * n_words OR 100 * n_dup_lines > {quality_rules.MAX_DUP_LINE_PCT} * n_lines
    OR word_chars < {quality_rules.MIN_MEAN_CHARS} * n_words OR word_chars > {quality_rules.MAX_MEAN_CHARS} * n_words
    OR 100 * letters < {quality_rules.MIN_LETTER_WORD_PCT} * n_words) AS kept
FROM stats
"""

_OP8 = f"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS g, len(w) < 5 AS short
         FROM words, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS u(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b ON a.g = b.g AND a.short = b.short
           AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id))::BIGINT AS component_id
FROM words LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) USING (doc_id)
"""


def _op11(rounds: int = 6, parts: int = 8, entries: int = 16) -> str:
    """Rounds of assignment and means, written out; a component's row is (rid, p, c, x), an entry's (p, e, c, x)."""
    out = [f"""kept AS (SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT rid, i // (len(embedding) // {parts}) AS p, i % (len(embedding) // {parts}) AS c,
  floor(4096 * embedding[i + 1]::DOUBLE)::BIGINT AS x FROM kept, unnest(range(len(embedding))) AS u(i)),
b0 AS MATERIALIZED (SELECT p, rid - 1 AS e, c, x FROM x WHERE rid <= {entries})"""]
    for r in range(rounds + 1):
        # the nearest entry and the distance in one number: entries are few
        out.append(f"""a{r} AS MATERIALIZED (SELECT rid, p, min(d * {entries} + e) % {entries} AS e, min(d * {entries} + e) // {entries} AS d FROM (
  SELECT rid, x.p, e, sum((x.x - b.x) * (x.x - b.x))::BIGINT AS d FROM x JOIN b{r} b ON x.p = b.p AND x.c = b.c GROUP BY rid, x.p, e) GROUP BY rid, p)""")
        if r < rounds:
            out.append(f"""b{r + 1} AS MATERIALIZED (SELECT b.p, b.e, b.c, CASE WHEN n IS NULL THEN b.x ELSE (s - ((s % n) + n) % n) // n END AS x
  FROM b{r} b LEFT JOIN (SELECT x.p, e, c, sum(x)::BIGINT AS s, count(*) AS n FROM x JOIN a{r} a ON x.rid = a.rid AND x.p = a.p GROUP BY x.p, e, c) m
  ON b.p = m.p AND b.e = m.e AND b.c = m.c)""")
    return "WITH " + ",\n".join(out) + f""",
codes AS (SELECT rid, string_agg('0' || substr('0123456789abcdef', e::INT + 1, 1), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY rid),
book AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, c)) AS h FROM b{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT h FROM book) AS codebooks_sha256
FROM kept JOIN codes USING (rid)
"""


def _op12(levels: int = 8, arity: int = 8) -> str:
    """Levels of both trees written out: node tables (g, pos, d), and rows on their way up (rid, g, pos, d, proof)."""
    def part(c: str) -> str:
        return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(part(c) for c in ('doc_id', 'source', 'lang', 'n_chars'))} || {part(text)})"

    def tree(n: str, f: str) -> list[str]:
        sql = []
        for k in range(levels):
            sql.append(f"""{n}{k}c AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY g) AS size FROM {n}{k}),
{n}{k + 1} AS MATERIALIZED (SELECT g, pos // {arity} AS pos, CASE WHEN any_value(size) = 1 THEN any_value(d)
  ELSE sha256(string_agg(d, '' ORDER BY pos)) END AS d FROM {n}{k}c GROUP BY g, pos // {arity}),
{f}{k + 1} AS MATERIALIZED (SELECT f.rid, any_value(f.g) AS g, any_value(f.pos) // {arity} AS pos, CASE WHEN any_value(size) = 1 THEN any_value(f.d)
  ELSE sha256(string_agg(CASE WHEN n.pos = f.pos THEN f.d ELSE n.d END, '' ORDER BY n.pos)) END AS d,
  any_value(f.proof) || coalesce(string_agg(n.d, '' ORDER BY n.pos) FILTER (WHERE n.pos <> f.pos), '') AS proof
  FROM {f}{k} f JOIN {n}{k}c n ON f.g = n.g AND f.pos // {arity} = n.pos // {arity} GROUP BY f.rid)""")
        return sql

    crc = ("xor(list_reduce([4294967295] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c), 0, 0, 0, 0, 0, 0, 0])), "
           "lambda a, e: xor(xor(a, e) >> 1, 3988292384 * (xor(a, e) & 1))), 4294967295)")
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return ",\n".join([
        f"""WITH t AS (SELECT *, CASE WHEN {crc} % 3 = 0 THEN {lower} ELSE text END AS other FROM documents),
h AS MATERIALIZED (SELECT doc_id, lang, {leaf('text')} AS leaf, {leaf('other')} AS shown FROM t),
r AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY lang, doc_id, leaf, shown) AS rid, coalesce('=' || lang, '-') AS g,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, shown) - 1 AS pos FROM h),
n0 AS MATERIALIZED (SELECT g, pos, leaf AS d FROM r), f0 AS MATERIALIZED (SELECT rid, g, pos, shown AS d, '' AS proof FROM r)""",
        *tree("n", "f"),
        f"""m0 AS MATERIALIZED (SELECT 0 AS g, row_number() OVER (ORDER BY g) - 1 AS pos, d, g AS own FROM n{levels}),
e0 AS MATERIALIZED (SELECT f.rid, 0 AS g, m0.pos, f.d, f.proof FROM f{levels} f JOIN m0 ON f.g = m0.own)""",
        *tree("m", "e")]) + f"""
SELECT doc_id, leaf, n.d AS subroot, m.d AS root, sha256(e.proof) AS proof_sha256, e.d AS folded_root, e.d = m.d AS verified
FROM r JOIN e{levels} e USING (rid) JOIN n{levels} n ON r.g = n.g CROSS JOIN m{levels} m
"""


ORACLE_SQL = {"op1_suffix_dedup": _OP1, "op2_mixing": _OP2, "op4_decontamination": _OP4, "op5_warc": _OP5,
              "op7_quality_rules": _OP7, "op8_ngram_join": _OP8, "op11_vector_codes": _op11(), "op12_merkle": _op12()}
