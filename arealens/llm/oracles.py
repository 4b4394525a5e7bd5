"""Check SQL of the text queries that SQL can express."""

from __future__ import annotations

#: CRC-32 by its polynomial: a table of 256 steps (list `crc`, one row), then one step per byte of the text.
CRC_TABLE = """crc_steps(i, k, v) AS (
  SELECT i, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, xor(v >> 1, 3988292384 * (v & 1)) FROM crc_steps WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS crc FROM crc_steps WHERE k = 8)"""


def crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes; needs the list `crc` in scope."""
    digit = f"instr('0123456789ABCDEF', substr(hex(encode({text})), {{at}}, 1)) - 1"
    value = f"(16 * ({digit.format(at='2 * b + 1')}) + {digit.format(at='2 * b + 2')})::BIGINT"
    steps = f"list_transform(range(octet_length(encode({text}))), lambda b: {value})"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {steps}), "
            "lambda a, b: xor(a >> 8, crc[(xor(a & 255, b) + 1)])))")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

IMPORTANCE_RESAMPLING = f"""
WITH RECURSIVE {CRC_TABLE},
texts AS (
  SELECT 'd' AS side, row_number() OVER () AS rid, doc_id AS id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), item_id, text FROM benchmark),
words AS (
  SELECT side, rid, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM texts),
buckets AS (SELECT w, {crc32('w')} % 10000 AS bucket FROM (SELECT DISTINCT w FROM words), crc),
counts AS (
  SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM words JOIN buckets USING (w) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM counts),
weights AS (
  SELECT rid, count(*) AS n, sum(gain)::BIGINT AS total FROM words JOIN buckets USING (w) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY rid),
scored AS (
  SELECT rid, id AS doc_id, coalesce(n, 0) AS n_features,
    CASE WHEN n > 0 THEN (total - ((total % n) + n) % n) // n ELSE 0 END AS weight,
    ('0x' || substr(sha256('2024:' || coalesce(id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM texts LEFT JOIN weights USING (rid) WHERE side = 'd'),
drawn AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM scored),
ranked AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, rid) AS r, count(*) OVER () AS n FROM drawn WHERE n_features >= 20)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score,
  CASE WHEN r <= 10 * n // 100 THEN r END::BIGINT AS rank
FROM drawn LEFT JOIN ranked USING (rid)
"""

CONVERSATION_PREFIX_TRIE = f"""
WITH RECURSIVE {CRC_TABLE},
turns AS (
  SELECT conv_id AS c, coalesce(text, '') AS x, md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS m,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, m) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, max(i) AS n, {crc32('c::VARCHAR')} % 9 AS h FROM turns, crc GROUP BY c, crc),
rebuilt AS (
  SELECT a.c, t.i AS d, t.m, t.x FROM convs a JOIN turns t ON t.c = a.c - a.c % 5 AND t.i <= a.h
  UNION ALL
  SELECT a.c, t.i - a.h + least(a.h, coalesce(b.n, 0)), t.m, t.x
  FROM convs a JOIN turns t ON t.c = a.c AND t.i > a.h LEFT JOIN convs b ON b.c = a.c - a.c % 5),
paths AS (
  SELECT c, 0 AS d, '' AS p, 0 AS size FROM convs
  UNION ALL SELECT c, d, string_agg(m, '') OVER (PARTITION BY c ORDER BY d), octet_length(encode(x)) FROM rebuilt),
lasts AS (SELECT arg_max(p, d) AS p, c FROM paths GROUP BY c),
ends AS (SELECT p, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends FROM lasts GROUP BY p),
nodes AS (SELECT p, any_value(d) AS d, min(c) AS c, count(*) AS n, (count(*) - 1) * any_value(size) AS saved FROM paths GROUP BY p),
kids AS (SELECT substr(p, 1, length(p) - 32) AS p, count(*) AS k FROM nodes WHERE d > 0 GROUP BY 1),
below AS (
  SELECT substr(n.p, 1, 32 * u) AS p, count(*) FILTER (k IS NULL) AS leaves, sum(n.saved) AS saved
  FROM (SELECT *, unnest(range(d + 1)) AS u FROM nodes) n LEFT JOIN kids ON kids.p = n.p GROUP BY 1)
SELECT n.c::BIGINT AS conv_id, n.d::BIGINT AS depth, up.c::BIGINT AS parent_conv_id, n.n::BIGINT AS n_convs, coalesce(k, 0)::BIGINT AS n_children,
  leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM nodes n JOIN below b ON b.p = n.p LEFT JOIN kids ON kids.p = n.p LEFT JOIN ends e ON e.p = n.p
LEFT JOIN nodes up ON n.d > 0 AND up.p = substr(n.p, 1, length(n.p) - 32)
"""


def _any_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


#: Kind, pattern, and what a match `m` must satisfy; the order is the order of spans that start together.
SECRET_KINDS = (
    ("assign", f"({_any_case('password')}|{_any_case('passwd')}|{_any_case('secret')}|{_any_case('token')}|{_any_case('api')}_?{_any_case('key')})"
     "[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", "length(regexp_extract(m, pattern, 2)) >= 8"),
    ("access", "AKIA[A-Z0-9]+", "length(m) >= 16"),
    ("hex", "[0-9a-f]+", "length(m) >= 32"),
    ("hosting", "gh[pousr]_[0-9A-Za-z]+", "length(m) = 40 AND crc_value(substr(m, 5, 30)) = base62(substr(m, 35, 6))"),
    ("registry", "npm_[0-9A-Za-z]+", "length(m) = 40 AND crc_value(substr(m, 5, 30)) = base62(substr(m, 35, 6))"),
    ("agekey", "AGE-SECRET-KEY-1[0-9A-Z]+", "length(m) = 74 AND bech32(m)"),
)


def _secrets() -> str:
    base62 = "list_reduce(list_prepend(0::BIGINT, list_transform(range(1, 7), lambda i: " \
        "(instr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz', substr(m, (34 + i)::INT, 1)) - 1)::BIGINT)), lambda a, b: a * 62 + b)"
    # Values of five bits: high parts of the readable part, a zero, its low parts, then the digits.
    human = [ord(c) for c in "age-secret-key-"]
    fixed = [c >> 5 for c in human] + [0] + [c & 31 for c in human]
    digit = "(instr('QPZRY9X8GF2TVDW0S3JN54KHCE6MUA7L', substr(m, (16 + i)::INT, 1)) - 1)::BIGINT"
    values = f"list_concat([1, {', '.join(map(str, fixed))}]::BIGINT[], list_transform(range(1, 59), lambda i: {digit}))"
    step = "xor((a & 33554431) << 5, b)"
    for i, v in enumerate((0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)):
        step = f"xor({step}, {v} * (((a >> 25) >> {i}) & 1))"
    bech32 = f"(NOT regexp_matches(substr(m, 17), '[^QPZRY9X8GF2TVDW0S3JN54KHCE6MUA7L]') AND list_reduce({values}, lambda a, b: {step}) = 1)"
    parts = []
    for k, (kind, pattern, check) in enumerate(SECRET_KINDS):
        check = check.replace("pattern", f"'{pattern}'").replace("crc_value(substr(m, 5, 30))", crc32("substr(m, 5, 30)"))
        check = check.replace("base62(substr(m, 35, 6))", base62).replace("bech32(m)", bech32)
        parts.append(f"SELECT rid, {k} AS k, '{kind}' AS kind, m, s, s + length(m) AS e FROM ("
                     f"SELECT rid, unnest(ms) AS m, unnest(list_transform(range(1, len(ms) + 1), lambda i: "
                     f"(list_sum(list_transform(ps[1:i], lambda p: length(p))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda p: length(p))), 0))::BIGINT)) AS s "
                     f"FROM (SELECT rid, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS ps FROM texts)), crc WHERE {check}")
    found = "\n  UNION ALL ".join(parts)
    return f"""
WITH RECURSIVE {CRC_TABLE},
texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({found}),
lists AS (
  SELECT rid, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < 3) AS base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans
  FROM found GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN lists USING (rid)
"""


SECRET_SCAN = _secrets()
