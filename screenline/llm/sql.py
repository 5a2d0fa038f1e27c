"""SQL twins of the queries that SQL can express."""

from screenline.llm import license_scan

_WORDS = (
    r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x20\x09-\x0D]+')"
)


def _shingles(table: str, key: str) -> str:
    """Rows (key, s): the distinct word shingles of each text of a table."""
    return f"""
    SELECT DISTINCT {key}, unnest(CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM (SELECT {key}, {_WORDS} AS w FROM {table} WHERE text IS NOT NULL)"""


_RUN = "' ' || array_to_string({0}, ' ') || ' '"

CONTAINED_ITEMS = f"""
WITH d AS ({_shingles("documents", "doc_id")}),
dw AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
bw AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
b AS (SELECT item_id, s FROM ({_shingles("benchmark", "item_id")}) WHERE len(string_split(s, ' ')) = 5),
n AS (SELECT item_id, count(*) AS n FROM b GROUP BY item_id),
m AS (SELECT d.doc_id, b.item_id, count(*) AS c FROM d JOIN b ON d.s = b.s GROUP BY ALL)
SELECT m.doc_id, m.item_id, n.n AS n_item_shingles, m.c AS n_common, m.c::DOUBLE / n.n AS containment
FROM m JOIN n ON m.item_id = n.item_id
WHERE 100 * m.c >= 75 * n.n
UNION ALL SELECT doc_id, item_id, 1, 1, 1.0::DOUBLE FROM dw, bw
WHERE len(bw.w) BETWEEN 1 AND 4 AND contains({_RUN.format("dw.w")}, {_RUN.format("bw.w")})"""

FILL_MIDDLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines,
    list_transform([1, 9, 17, 25], lambda i: ('0x' || h[i:i + 7])::BIGINT) AS x FROM t),
c AS (SELECT *, len(lines) AS n, x[1] % (len(lines) + 1) AS a, x[2] % (len(lines) + 1) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR x[3] % 100 >= 100
        THEN 'plain' WHEN x[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, coalesce(array_to_string(lines[1:least(a, b)], ''), '') AS pre,
    coalesce(array_to_string(lines[least(a, b) + 1:greatest(a, b)], ''), '') AS mid,
    coalesce(array_to_string(lines[greatest(a, b) + 1:], ''), '') AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, form,
    CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM p"""

# Near words share what is left of one of them, or of both at one place, after a
# letter is taken out. The checksum's table is made by its own rule.
SPELLING = r"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
r AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents) GROUP BY ALL),
b AS (SELECT run, k, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM r WHERE length(run) >= 6),
h AS (SELECT run, k, xor(4294967295, list_reduce(list_prepend(4294967295,
    list_transform(range(1, length(x), 2), lambda i: ('0x' || x[i:i + 1])::BIGINT)),
    lambda c, v: xor(c // 256, t[xor(c, v) % 256 + 1]))) AS h FROM b, crc),
w AS (SELECT word, sum(k)::BIGINT AS n FROM (SELECT k, CASE WHEN h % 199 = 0
        THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM h)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
d AS (SELECT word, n, length(word) AS l, i, word[1:i - 1] || word[i + 1:] AS s
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM d a JOIN d b ON a.s = b.s AND a.i = b.i AND a.l = b.l
        AND a.word <> b.word
    UNION SELECT a.word, a.n, b.word, b.n FROM w a JOIN d b ON a.word = b.s
    UNION SELECT b.word, b.n, a.word, a.n FROM w a JOIN d b ON a.word = b.s),
m AS (SELECT word, count(*) AS n_near, first(n) AS n, max(other_n) AS best_n,
    arg_min(other, (-other_n, encode(other))) AS best FROM p GROUP BY word),
f AS (SELECT word, best AS form, best_n AS form_n FROM m WHERE best_n >= 5 * n),
e AS (SELECT word, form AS root, 1 AS step FROM f
    UNION ALL SELECT e.word, f.form, step + 1 FROM e JOIN f ON e.root = f.word),
z AS (SELECT word, arg_max(root, step) AS root FROM e GROUP BY word)
SELECT w.word, w.n, coalesce(m.n_near, 0)::BIGINT AS n_near, f.form, f.form_n::BIGINT AS form_n, coalesce(z.root, w.word) AS root
FROM w LEFT JOIN m USING (word) LEFT JOIN f USING (word) LEFT JOIN z USING (word)"""


def licenses() -> str:
    """License notices in texts: every window of every text against every
    template of its size class, by exact containment."""
    quoted = ", ".join("('" + n.replace("'", "''") + "', '" + t.replace("'", "''") + "')" for n, t in license_scan.TEMPLATES)
    words = (
        r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
        r" 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    )
    runs = "list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))"
    return f"""
WITH t AS (SELECT license, least(len(w), 5) AS k, w FROM (SELECT col0 AS license, {words.replace("text", "col1")} AS w
    FROM (VALUES {quoted}))),
ts AS (SELECT DISTINCT license, k, unnest({runs}) AS s FROM t),
tn AS (SELECT license, k, count(*) AS n,
    CASE WHEN count(*) <= 4 THEN 1 ELSE (1 << ceil(log2(count(*)))::INT) // 4 END AS stride,
    CASE WHEN count(*) <= 4 THEN 1 << ceil(log2(count(*)))::INT ELSE (1 << ceil(log2(count(*)))::INT) // 4 * 5 END AS span
    FROM ts GROUP BY ALL),
dw AS (SELECT doc_id, {words} AS w FROM documents),
ds AS (SELECT doc_id, k, s, p - 1 AS p FROM (SELECT doc_id, k, unnest({runs}) AS s, unnest(range(1, len(w) - k + 2)) AS p
    FROM dw, (SELECT DISTINCT k FROM tn) WHERE len(w) >= k)),
hit AS (SELECT doc_id, license, s, p, n, stride, span FROM ds JOIN ts USING (k, s) JOIN tn USING (license, k)),
win AS (SELECT doc_id, license, n, s, unnest(range(greatest(0, (p - span + stride) // stride),
    p // stride + 1)) * stride AS first FROM hit),
c AS (SELECT doc_id, license, n, first, count(DISTINCT s) AS c FROM win GROUP BY ALL),
ok AS (SELECT * FROM c WHERE 100 * c >= 75 * n)
SELECT doc_id, license, max(n)::INT AS n_shingles, max(c)::INT AS n_common,
    (arg_min(first, (-c) * 1000000000 + first))::INT AS first_window
FROM ok GROUP BY doc_id, license"""
