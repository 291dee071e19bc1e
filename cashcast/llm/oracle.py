"""DuckDB twins of the training-data queries that SQL can express."""

from __future__ import annotations

from cashcast.llm import importance, simhash
from cashcast.llm.decontamination import WINDOW
from cashcast.llm.line_rules import KEEP_SHARE, MAX_REPEAT_PCT, MIN_DOCS, MIN_WORDS, SHARE
from cashcast.llm.mixing import MAX_EPOCHS
from cashcast.llm.ngram_join import PERCENT, SHINGLE
from cashcast.llm.sharding import SHARD_BYTES
from cashcast.llm.spanhash import P1, P2, P3, P4, P5
from cashcast.llm.substring_index import DEPTH

WORD = r"[^\x20\x09-\x0D]+"

OP2 = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, source,
                  coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS size,
                  substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 16) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight,
             {MAX_EPOCHS} * source_size AS cap, sum(source_size) OVER () AS total FROM s),
r AS (SELECT *, cap / weight AS ratio FROM w),
f AS (SELECT *, (total - coalesce(sum(cap) OVER lo, 0)) / sum(weight) OVER hi AS level_ FROM r
      WINDOW lo AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
             hi AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
lev AS (SELECT max(level_) AS level_ FROM f),
t AS (SELECT f.source, source_size, least(CAST(cap AS DOUBLE), lev.level_ * weight) AS target FROM f, lev),
q AS (SELECT d.*, source_size, target FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size, row ROWS UNBOUNDED PRECEDING) AS done
      FROM q WHERE size > 0 AND target > 0),
e AS (SELECT c.*, n AS epoch, (done + (n - 1) * source_size) / target AS finish
      FROM c, (SELECT unnest(range(1, {MAX_EPOCHS} + 1)) AS n) WHERE n <= ceil(target / source_size)),
o AS (SELECT row, size, coalesce(sum(size) OVER (ORDER BY finish, source, k, doc_id, epoch, row
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_ FROM e),
b AS (SELECT CAST(round(sum(target)) AS BIGINT) AS budget FROM t),
k AS (SELECT row, sum(greatest(0, least(size, budget - before_))) AS taken FROM o, b GROUP BY row)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(coalesce(k.taken, 0) AS BIGINT) AS taken, q.source
FROM q LEFT JOIN k ON q.row = k.row
"""

OP4 = f"""
WITH d AS (SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
                  substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 16) AS h FROM documents),
k AS (SELECT doc_id, n_bytes, lpad(bin(CAST('0x' || h AS UBIGINT)), 64, '0') AS bits FROM d),
p AS (SELECT doc_id, n_bytes, bits, n AS depth, substr(bits, 1, n) AS prefix FROM k, (SELECT unnest(range(0, 65)) AS n)),
b AS (SELECT prefix, depth, sum(n_bytes) AS shard_bytes, count(*) AS shard_docs, min(bits) = max(bits) AS single
      FROM p GROUP BY prefix, depth),
f AS (SELECT p.doc_id, p.n_bytes, p.bits, b.*, row_number() OVER (PARTITION BY p.bits, p.depth ORDER BY p.doc_id) AS rn
      FROM p JOIN b ON p.prefix = b.prefix AND p.depth = b.depth WHERE b.shard_bytes <= {SHARD_BYTES} OR b.single),
m AS (SELECT *, rank() OVER (PARTITION BY bits ORDER BY depth) AS r FROM f)
SELECT doc_id, n_bytes, 'b' || prefix AS shard, depth, CAST(shard_bytes AS BIGINT) AS shard_bytes, shard_docs FROM m WHERE r = 1
"""

OP8 = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT row, doc_id, source, t, regexp_extract_all(t, '{WORD}') AS ws FROM d),
base AS (SELECT row, doc_id, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
                length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM w),
l0 AS (SELECT row, source, unnest(string_split(t, chr(10))) AS line FROM d),
l AS (SELECT row, source, line, regexp_extract_all(line, '{WORD}') AS lw FROM l0),
dup AS (SELECT row, sum(n - 1) AS n_dup_lines FROM (SELECT row, line, count(*) AS n FROM l WHERE len(lw) > 0 GROUP BY row, line) GROUP BY row),
pos AS (SELECT row, unnest(range(1, len(ws) - 6)) AS i, ws FROM w WHERE len(ws) >= 8),
win AS (SELECT row, i, ws[i:i + 7] AS g FROM pos),
rep AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT row, count(DISTINCT i + o) AS n_repeat_words FROM rep, (SELECT unnest(range(0, 8)) AS o) GROUP BY row),
norm AS (SELECT row, source, regexp_replace(translate(array_to_string(lw, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[0-9]', '0', 'g') AS line, len(lw) AS n FROM l WHERE len(lw) > 0),
one AS (SELECT row, source, line, sum(n) AS words FROM norm GROUP BY row, source, line),
host AS (SELECT source, greatest({MIN_DOCS}, count(*) * {SHARE}::DOUBLE) AS lim FROM d GROUP BY source),
common AS (SELECT o.source, line FROM one o JOIN host h ON o.source IS NOT DISTINCT FROM h.source
           GROUP BY o.source, line, lim HAVING count(*) > lim),
rem AS (SELECT row, sum(words) AS taken, count(*) AS lines FROM one o JOIN common c ON o.line = c.line AND o.source IS NOT DISTINCT FROM c.source GROUP BY row),
allof AS (SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
                 coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lines, 0) AS n_common_lines, n_words - coalesce(taken, 0) AS left_
          FROM base LEFT JOIN dup USING (row) LEFT JOIN cov USING (row) LEFT JOIN rem USING (row))
SELECT doc_id, n_words, word_chars, n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words) AND left_ >= {KEEP_SHARE} * n_words AS kept,
       n_common_lines, CAST(left_ AS BIGINT) AS n_words_left
FROM allof
"""

UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = rf"""
WITH b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
                  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{SMALL}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
d AS (SELECT row_number() OVER () AS row, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{SMALL}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bp AS (SELECT item, w, least(len(w), {WINDOW}) AS n, unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, n, w[i:i + n - 1] AS g FROM bp),
lens AS (SELECT DISTINCT n FROM win),
dp AS (SELECT row, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n),
hit AS (SELECT row, dp.n, i, item FROM dp JOIN win ON dp.n = win.n AND w[i:i + dp.n - 1] = win.g),
word AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS p FROM hit) GROUP BY row),
items AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT row, item FROM hit) GROUP BY row)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (row) LEFT JOIN items USING (row)
"""

OP5 = rf"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id) AS row, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT row, i, substr(x, 2 * CAST(i AS BIGINT) + 1, {2 * DEPTH}) AS s
      FROM (SELECT row, x, unnest(range(0, len(x) // 2 - {DEPTH} + 1)) AS i FROM d WHERE len(x) >= {2 * DEPTH})),
r AS (SELECT row, i FROM (SELECT row, i, row_number() OVER (PARTITION BY s ORDER BY row, i) AS k FROM w) WHERE k > 1),
e AS (SELECT row, i, i - lag(i) OVER (PARTITION BY row ORDER BY i) AS gap FROM r),
g AS (SELECT row, i, sum(CASE WHEN gap IS NULL OR gap > {DEPTH} THEN 1 ELSE 0 END) OVER (PARTITION BY row ORDER BY i ROWS UNBOUNDED PRECEDING) AS no FROM e),
sp AS (SELECT row, no, min(i) AS a, max(i) + {DEPTH} AS z FROM g GROUP BY row, no),
k AS (SELECT sp.row, count(*) AS n_spans, sum(z - a) AS n_removed FROM sp GROUP BY sp.row),
c AS (SELECT row, a, z, coalesce(lag(z) OVER (PARTITION BY row ORDER BY a), 0) AS p FROM sp),
kept AS (SELECT c.row, string_agg(substr(x, 2 * CAST(p AS BIGINT) + 1, 2 * CAST(a - p AS BIGINT)), '' ORDER BY a)
                || substr(any_value(x), 2 * CAST(max(z) AS BIGINT) + 1) AS x FROM c JOIN d USING (row) GROUP BY c.row)
SELECT doc_id, len(d.x) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept.x, d.x))) AS kept_sha256
FROM d LEFT JOIN k USING (row) LEFT JOIN kept USING (row)
"""

OP9 = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS row, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{SMALL}'), '{WORD}') AS w FROM documents),
p AS (SELECT row, w, unnest(range(1, greatest(len(w) - {SHINGLE}, 0) + 2)) AS i FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT row, array_to_string(w[i:i + {SHINGLE - 1}], ' ') AS g FROM p),
n AS (SELECT row, count(*) AS n FROM s GROUP BY row),
m AS (SELECT a.row AS x, b.row AS y, count(*) AS both_ FROM s a JOIN s b ON a.g = b.g AND a.row < b.row GROUP BY ALL),
l AS (SELECT x, y FROM m JOIN n nx ON nx.row = x JOIN n ny ON ny.row = y WHERE 100 * both_ >= {PERCENT} * (nx.n + ny.n - both_)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT row AS x, row AS y FROM d UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
c AS (SELECT r.x AS row, min(doc_id) AS component_id FROM r JOIN d ON d.row = r.y GROUP BY r.x)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id FROM d JOIN c USING (row) LEFT JOIN n USING (row)
"""

ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# words' CRC-32 from the usual table of 256 entries; the gains and weights as sums over words
OP11 = rf"""
WITH tab AS (SELECT list(v ORDER BY b) AS t FROM (
        SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM (SELECT unnest(range(256)) AS b))),
d AS (SELECT row_number() OVER () AS row, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{SMALL}'), '{ALNUM_WORD}') AS ws FROM documents),
dw AS (SELECT row, w, count(*) AS n FROM (SELECT row, unnest(ws) AS w FROM d) GROUP BY row, w),
bw AS (SELECT w, count(*) AS n FROM (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{SMALL}'), '{ALNUM_WORD}')) AS w
       FROM benchmark) GROUP BY w),
x AS (SELECT w, hex(encode(w)) AS hx FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
h AS (SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(hx) // 2), lambda i: CAST('0x' || substr(hx, 2 * i + 1, 2) AS BIGINT))),
                                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % {importance.BUCKETS} AS bucket FROM x, tab),
s AS (SELECT bucket, sum(n) AS n FROM dw JOIN h USING (w) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS n FROM bw JOIN h USING (w) GROUP BY bucket),
sums AS (SELECT (SELECT coalesce(sum(n), 0) FROM s) AS s_all, (SELECT coalesce(sum(n), 0) FROM t) AS t_all),
g AS (SELECT b.bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (s_all + {importance.BUCKETS})::DOUBLE
                                            / ((coalesce(s.n, 0) + 1)::DOUBLE * (t_all + {importance.BUCKETS})::DOUBLE))) AS BIGINT) AS gain
      FROM (SELECT unnest(range({importance.BUCKETS})) AS bucket) b LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), sums),
w AS (SELECT row, sum(n * gain) AS weight FROM dw JOIN h USING (w) JOIN g USING (bucket) GROUP BY row),
r AS (SELECT row, doc_id, len(ws) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
             (CAST('0x' || substr(sha256('{importance.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
      FROM d LEFT JOIN w USING (row)),
k AS (SELECT row, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM r WHERE n_features >= {importance.MIN_WORDS}),
n AS (SELECT {importance.PERCENT} * count(*) // 100 AS drawn FROM k)
SELECT doc_id, n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score, CASE WHEN rank <= drawn THEN rank END AS rank
FROM r LEFT JOIN k USING (row), n
"""


def _u(x) -> str:
    return f"{int(x)}::UHUGEINT"


MASK = _u(2**64 - 1)


def _rot(x: str, k: int) -> str:
    """64-bit rotation in 128-bit numbers."""
    return f"(((({x}) * {_u(2**k)}) & {MASK}) + (({x}) // {_u(2**(64 - k))}))"


def _times(x: str, prime) -> str:
    return f"((({x}) * {_u(prime)}) & {MASK})"


def _plus(x: str, y) -> str:
    return f"((({x}) + {_u(y)}) & {MASK})"


def _step(acc: str, lane: str) -> str:
    return _times(_rot(f"((({acc}) + ({lane}) * {_u(P2)}) & {MASK})", 31), P1)


def _little(at: str, n: int) -> str:
    """n bytes of the hexadecimal text hx from byte ``at``, the first one lowest."""
    return "CAST('0x' || " + " || ".join(f"substr(hx, 2 * (({at}) + {k}) + 1, 2)" for k in reversed(range(n))) + " AS UBIGINT)::UHUGEINT"


_SEED = simhash.SEED
_INIT = [(_SEED + int(P1) + int(P2)) % 2**64, (_SEED + int(P2)) % 2**64, _SEED, (_SEED - int(P1)) % 2**64]
_ACC = ", ".join(f"list_reduce(list_prepend({_u(v)}, list_transform(range(n // 32), lambda i: {_little(f'32 * i + {8 * j}', 8)})), "
                 f"lambda a, l: {_step('a', 'l')}) AS v{j}" for j, v in enumerate(_INIT))
_MERGED = f"(({_rot('v0', 1)} + {_rot('v1', 7)} + {_rot('v2', 12)} + {_rot('v3', 18)}) & {MASK})"
_MERGES = "".join(f"m{j} AS (SELECT * REPLACE ({_plus(_times(f'xor(w, {_step(_u(0), f'v{j}')})', P1), P4)} AS w) FROM {f'm{j - 1}' if j else 'acc'}),\n"
                  for j in range(4))
_BITS = ", ".join(f"sum((h >> {k}) & 1::UBIGINT) AS s{k}" for k in range(64))
_FP = " + ".join(f"(2 * s{k} > n)::UBIGINT * {2**k}::UBIGINT" for k in range(64))

# XXH64 of the distinct shingles, step by step, in 128-bit numbers
OP12 = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS row, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{SMALL}'), '{WORD}') AS ws FROM documents),
p AS (SELECT row, ws, unnest(range(1, greatest(len(ws) - {simhash.SHINGLE}, 0) + 2)) AS i FROM d WHERE len(ws) > 0),
sh AS (SELECT row, array_to_string(ws[i:i + {simhash.SHINGLE - 1}], ' ') AS g FROM p),
x AS (SELECT g, hex(encode(g)) AS hx, strlen(g) AS n FROM (SELECT DISTINCT g FROM sh)),
v AS (SELECT *, {_ACC} FROM x),
acc AS (SELECT *, {_MERGED} AS w FROM v),
{_MERGES}h0 AS (SELECT g, hx, n, n - n % 32 AS p8, n - n % 8 AS p4, n - n % 4 AS p1,
              ((CASE WHEN n >= 32 THEN w ELSE {_u((_SEED + int(P5)) % 2**64)} END) + n::UHUGEINT) & {MASK} AS h FROM m3),
h1 AS (SELECT * REPLACE (list_reduce(list_prepend(h, list_transform(range((p4 - p8) // 8), lambda i: {_little('p8 + 8 * i', 8)})),
                                     lambda a, l: {_plus(_times(_rot(f"xor(a, {_step(_u(0), 'l')})", 27), P1), P4)}) AS h) FROM h0),
h2 AS (SELECT * REPLACE (CASE WHEN p1 > p4 THEN {_plus(_times(_rot(f"xor(h, {_times(_little('p4', 4), P1)})", 23), P2), P3)} ELSE h END AS h) FROM h1),
h3 AS (SELECT * REPLACE (list_reduce(list_prepend(h, list_transform(range(n - p1), lambda i: {_little('p1 + i', 1)})),
                                     lambda a, l: {_times(_rot(f"xor(a, {_times('l', P5)})", 11), P1)}) AS h) FROM h2),
h4 AS (SELECT * REPLACE ({_times(f"xor(h, h // {_u(2**33)})", P2)} AS h) FROM h3),
h5 AS (SELECT * REPLACE ({_times(f"xor(h, h // {_u(2**29)})", P3)} AS h) FROM h4),
hs AS (SELECT g, CAST(xor(h, h // {_u(2**32)}) AS UBIGINT) AS h FROM h5),
b AS (SELECT row, count(*) AS n, {_BITS} FROM sh JOIN hs USING (g) GROUP BY row),
f AS (SELECT d.row, doc_id, coalesce(fp, 0::UBIGINT) AS fp FROM d LEFT JOIN (SELECT row, {_FP} AS fp FROM b) USING (row)),
u AS (SELECT DISTINCT fp FROM f),
e AS (SELECT a.fp AS x, b.fp AS y FROM u a, u b WHERE bit_count(xor(a.fp, b.fp)) BETWEEN 1 AND {simhash.DISTANCE}),
r AS (SELECT fp AS x, fp AS y FROM u UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
least_ AS (SELECT fp, min(doc_id) AS doc_id FROM f GROUP BY fp),
c AS (SELECT r.x AS fp, min(doc_id) AS component_id FROM r JOIN least_ ON least_.fp = r.y GROUP BY r.x)
SELECT f.doc_id, lpad(lower(hex(f.fp)), 16, '0') AS fingerprint, component_id FROM f JOIN c ON c.fp = f.fp
"""

ORACLE = {"op1_decontaminate": OP1, "op2_mix_sources": OP2, "op4_shards": OP4, "op5_repeats": OP5, "op8_line_rules": OP8,
          "op9_ngram_join": OP9, "op11_importance": OP11, "op12_simhash": OP12}
