"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE: dict[str, str] = {}

ORACLE["op3_exact_dedup"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)"""

ORACLE["op7_minhash"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                                '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3),
      lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(s) AS n FROM w LEFT JOIN sh USING (doc_id) GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id
          GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
          WHERE 100 * c >= 85 * (na.n + nb.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION
          SELECT reach.x, ways.b FROM reach JOIN ways ON reach.y = ways.a),
comp AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN comp ON x = doc_id"""


def _licenses() -> str:
    from cardflow.llm.licenses import NO_WORD, PHRASES, TEMPLATES, WINDOW, needed
    phrases = ", ".join(f"({p!r}, {label!r})" for p, label in PHRASES)
    templates = ", ".join(f"({label!r}, {sorted(set(t.split()))!r}, {needed(t)})" for label, t in TEMPLATES)
    return f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(string_split_regex(t, '{NO_WORD}'), lambda x: x <> '') AS w FROM t),
phrase(p, label) AS (VALUES {phrases}),
place AS (SELECT doc_id, label, i - 1 AS pos FROM w, phrase, unnest(range(1, len(w) + 1)) AS r(i)
          WHERE array_to_string(w[i:i + len(string_split(p, ' ')) - 1], ' ') = p),
base AS (SELECT doc_id, count(*) AS n, min(pos) AS a, max(pos) AS z, list(DISTINCT label) AS labels FROM place GROUP BY doc_id),
line AS (SELECT doc_id, list_filter(string_split_regex(l, '{NO_WORD}'), lambda x: x <> '') AS l
         FROM t, unnest(string_split(t, chr(10))) AS r(l)),
whole AS (SELECT doc_id, l FROM line UNION ALL SELECT doc_id, w FROM w),
block AS (SELECT doc_id, l AS b FROM whole WHERE len(l) BETWEEN 1 AND {WINDOW}
          UNION ALL SELECT doc_id, l[i + 1:i + {WINDOW}] FROM whole, unnest(range(0, len(l), {WINDOW // 2})) AS r(i)
          WHERE len(l) > {WINDOW}),
template(label, words, least) AS (VALUES {templates}),
own AS (SELECT doc_id, list(DISTINCT label) AS labels,
               max(len(list_intersect(words, b)) / len(words)) AS part
        FROM block, template WHERE len(list_intersect(words, b)) >= least GROUP BY doc_id)
SELECT w.doc_id, len(w) AS n_words, coalesce(base.n, 0) AS n_base, base.a AS first_word, base.z AS last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(base.labels, own.labels))), ','), '') AS labels,
       CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(own.part, 0) END AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN own USING (doc_id)"""


ORACLE["op6_licenses"] = _licenses()


def _merkle() -> str:
    from cardflow.llm.merkle import PIECE

    def tree(t):
        return (f"list_transform(string_split({t}, chr(10)), lambda s: "
                f"list_transform(regexp_extract_all(s, '{PIECE}'), lambda p: sha256(p)))")

    def numbered(t):
        return (f"list_transform(flatten({t}), lambda x, i: x || ':' || "
                f"len(list_filter(flatten({t})[1:i], lambda y: y = x)))")

    def common(x, y):
        return f"list_filter({x}, lambda v: list_contains({y}, v))"

    def pairs(c):
        return f"list_transform(range(1, len({c})), lambda i: {c}[i] || '>' || {c}[i + 1])"

    def near(x, y, c, d, same):
        both, either = f"len({c})", f"(len({x}) + len({y}) - len({c}))"
        order = f"((len(list_intersect({pairs(c)}, {pairs(d)})) + 1)::DOUBLE / {both})"
        return (f"CASE WHEN {same} THEN 1.0::DOUBLE WHEN {both} = 0 THEN 0 "
                f"ELSE least({both}::DOUBLE / {either} * {order}, {either}::DOUBLE / ({either} + 1)) END")

    def up_to(x, y):
        return f"range(0, greatest(coalesce(len({x}), 0), coalesce(len({y}), 0), 1))"

    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) // 3 AS k,
                  coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC),
                           first(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS n FROM documents),
e AS (SELECT *, left(t, length(t) - k) || left(n, k) AS e FROM d),
s AS (SELECT doc_id, length(t) AS n_chars, sha256(e) AS edited_sha256, {tree('t')} AS a, {tree('e')} AS b, {tree('n')} AS c
      FROM e),
r AS (SELECT *, list_transform(a, lambda l: sha256(coalesce(array_to_string(l, ','), ''))) AS na,
             list_transform(b, lambda l: sha256(coalesce(array_to_string(l, ','), ''))) AS nb,
             list_transform(c, lambda l: sha256(coalesce(array_to_string(l, ','), ''))) AS nc,
             {numbered('a')} AS la, {numbered('b')} AS lb, {numbered('c')} AS lc FROM s),
z AS (SELECT *, {common('la', 'lb')} AS ab, {common('lb', 'la')} AS ba, {common('la', 'lc')} AS ac, {common('lc', 'la')} AS ca,
             list_filter({up_to('na', 'nb')}, lambda i: na[i + 1] IS DISTINCT FROM nb[i + 1]) AS diff FROM r),
w AS (SELECT *, flatten(list_transform(diff, lambda i: list_transform(list_filter(
             {up_to('a[i + 1]', 'b[i + 1]')}, lambda j: a[i + 1][j + 1] IS DISTINCT FROM b[i + 1][j + 1]
             OR greatest(coalesce(len(a[i + 1]), 0), coalesce(len(b[i + 1]), 0)) = 0), lambda j: i || ':' || j))) AS places FROM z)
SELECT doc_id, n_chars, edited_sha256, sha256(array_to_string(na, ';')) AS fingerprint,
       sha256(array_to_string(nb, ';')) AS edited_fingerprint, {near('la', 'lb', 'ab', 'ba', 'na = nb')} AS near_edited,
       {near('la', 'lc', 'ac', 'ca', 'na = nc')} AS near_next, diff[1]::INT AS edited_section,
       coalesce(array_to_string(places, ','), '') AS edits
FROM w"""


ORACLE["op4_merkle"] = _merkle()


def _seeded(seed: int, *parts: str) -> str:
    text = " || ':' || ".join([f"'{seed}'", *[f"coalesce(({p})::VARCHAR, '')" for p in parts]])
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


_CRC_BIT = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
#: The table of CRC-32, one list `tbl`.
_CRC_TABLE = f"""tbl AS (SELECT list(c ORDER BY n) AS tbl FROM (
  SELECT n, list_reduce([n] || range(8), lambda c, i: {_CRC_BIT}) AS c FROM range(256) AS r(n)))"""


def _shards(shards: int = 24, seed: int = 20240101) -> str:
    return f"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, coalesce(source, chr(0) || 'null') AS stratum, source, {_seeded(seed, 'doc_id')} AS h,
             strlen(coalesce(text, '')) + 8 AS size,
             [4294967295] || list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                                            lambda x: ('0x' || x)::BIGINT) AS b FROM documents),
c AS (SELECT * EXCLUDE (b, tbl),
             xor(list_reduce(b, lambda c, x: xor(tbl[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) AS text_crc32 FROM d, tbl),
s AS (SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY h, doc_id, text_crc32, size) - 0.5::DOUBLE)
                / count(*) OVER (PARTITION BY stratum) AS share, count(*) OVER () AS n FROM c),
p AS (SELECT *, row_number() OVER (ORDER BY share, stratum, h, doc_id, text_crc32, size) - 1 AS p FROM s)
SELECT doc_id, size, text_crc32, 'rows' AS law, (p * {shards} // n)::INT AS shard,
       p - (p * {shards} // n * n + {shards - 1}) // {shards} AS slot, NULL::INT AS grown_shard, source FROM p"""


ORACLE["op5_sharding"] = _shards()


def _packing(buckets: int = 12, budget: int = 32768, seed: int = 7) -> str:
    """The histogram has at least `buckets` cells; layer k is the least padding with k buckets."""
    from cardflow.llm.packing import FINE
    bits = FINE.bit_length() - 1
    layers = ["l0 AS (SELECT 0 AS j, 0::HUGEINT AS cost, 0 AS i)"]
    for k in range(1, buckets + 1):
        layers.append(f"""l{k} AS (SELECT j, min(cost) AS cost, max(i) FILTER (WHERE cost = least) AS i FROM (
  SELECT h.j, l.j AS i, l.cost + h.c * (h.run - coalesce(b.run, 0))::HUGEINT AS cost,
         min(l.cost + h.c * (h.run - coalesce(b.run, 0))::HUGEINT) OVER (PARTITION BY h.j) AS least
  FROM h JOIN l{k - 1} l ON l.j < h.j LEFT JOIN h b ON b.j = l.j) GROUP BY j)""")
    path = [f"t{buckets} AS (SELECT max(j) AS j FROM h)"]
    path += [f"t{k - 1} AS (SELECT l{k}.i AS j FROM l{k} JOIN t{k} USING (j))" for k in range(buckets, 1, -1)]
    edges = " UNION ALL ".join(f"SELECT c FROM h JOIN t{k} USING (j)" for k in range(1, buckets + 1))
    return f"""
WITH n AS (SELECT doc_id, len(list_filter(string_split_regex(coalesce(text, ''), '[\\x09-\\x0D\\x20]+'),
                                          lambda x: x <> '')) AS n FROM documents),
cells AS (SELECT CASE WHEN n <= {FINE} THEN n ELSE (ceil(n / pow(2, floor(log2(n)) - {bits}))
                                                    * pow(2, floor(log2(n)) - {bits}))::BIGINT END AS c FROM n),
h AS (SELECT row_number() OVER (ORDER BY c) AS j, c, sum(k) OVER (ORDER BY c) AS run
      FROM (SELECT c, count(*) AS k FROM cells GROUP BY c)),
{', '.join(layers)},
{', '.join(path)},
e AS ({edges}),
b AS (SELECT doc_id, n, (SELECT count(*) FROM e WHERE e.c < n.n)::INT AS bucket,
             (SELECT min(c) FROM e WHERE e.c >= n.n) AS len, {_seeded(seed, 'doc_id', 'n')} AS h FROM n),
r AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY h, doc_id, n) - 1 AS r,
             greatest(1, {budget} // greatest(len, 1)) AS room FROM b)
SELECT doc_id, n AS n_tokens, bucket, len AS bucket_len, r // room AS batch, (r % room)::INT AS slot,
       len - n AS padding FROM r"""


ORACLE["op1_packing"] = _packing()

ORACLE["op12_prefix_trie"] = f"""
WITH {_CRC_TABLE},
own AS (SELECT conv_id AS c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
                                  ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS l
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
b AS (SELECT c, l, [4294967295] || list_transform(regexp_extract_all(hex(encode(c::VARCHAR)), '..'),
                                                  lambda x: ('0x' || x)::BIGINT) AS b FROM own),
h AS (SELECT c, l, xor(list_reduce(b, lambda c, x: xor(tbl[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 6 AS h FROM b, tbl),
f AS (SELECT h.c, list_concat(coalesce(base.l, [])[1:h.h], h.l[h.h + 1:]) AS l
      FROM h LEFT JOIN own base ON base.c = h.c - h.c % 100),
m AS (SELECT c, l[1:d] AS p, d, len(l) = d AS e, CASE WHEN d = 0 THEN NULL ELSE l[1:d - 1] END AS up
      FROM f, unnest(range(0, len(l) + 1)) AS r(d)),
n AS (SELECT p, any_value(d) AS depth, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE e), '')) AS ends_sha256 FROM m GROUP BY p),
k AS (SELECT up AS p, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
w AS (SELECT n.*, coalesce(n_children, 0) AS n_children,
             CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(p[depth].t) END AS own FROM n LEFT JOIN k USING (p)),
t AS (SELECT p[1:d] AS p, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(own)::BIGINT AS saved_tokens
      FROM w, unnest(range(0, depth + 1)) AS r(d) GROUP BY ALL)
SELECT w.conv_id, w.depth, par.conv_id AS parent_conv_id, w.n_convs, w.n_children, t.n_leaves, t.saved_tokens, w.ends_sha256
FROM w JOIN t USING (p) LEFT JOIN n par ON par.p = w.up"""

ORACLE["op13_periodic_runs"] = f"""
WITH {_CRC_TABLE},
b AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
             [4294967295] || list_transform(regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'),
                                            lambda x: ('0x' || x)::BIGINT) AS b FROM documents),
h AS (SELECT doc_id, w, len(w) AS n,
             xor(list_reduce(b, lambda c, x: xor(tbl[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) AS h FROM b, tbl),
g AS (SELECT doc_id, w, n, h, (h // 10) % greatest(n, 1) AS a, 1 + (n - (h // 10) % greatest(n, 1)) // (3 + (h // 10) % 8) AS p FROM h),
f AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 THEN list_transform(range(0, n), lambda i:
        CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM g),
p AS (SELECT doc_id, n, unnest(w) AS x, unnest(range(0, n)) AS i FROM f),
m AS (SELECT y.doc_id, y.i, z.i - y.i AS q FROM p y JOIN p z ON y.doc_id = z.doc_id AND y.x = z.x AND z.i > y.i
      WHERE 3 * (z.i - y.i) <= y.n),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length
      FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM m)
      GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(24, 3 * q)),
r AS (SELECT doc_id, start, length, min(q) AS period FROM s GROUP BY doc_id, start, length),
best AS (SELECT * FROM r QUALIFY row_number() OVER (
           PARTITION BY doc_id ORDER BY length * 1000000000000::HUGEINT // period DESC, start, period) = 1),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS l
           FROM r GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, i FROM r, unnest(range(start + period, start + length)) AS u(i)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS k FROM p ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT f.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, (1000 * length // period)::BIGINT AS exponent_milli,
       sha256(coalesce(l, '')) AS runs_sha256, sha256(coalesce(k, '')) AS collapsed_sha256
FROM f LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)"""
