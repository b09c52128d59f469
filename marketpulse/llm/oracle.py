"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_AZ}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SUBSTRINGS = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS g FROM d, unnest(range(1, len(w) - 11)) t(i)),
lowest AS (SELECT g, min(doc_id) AS low FROM windows GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos FROM windows JOIN lowest USING (g) WHERE low < doc_id),
word AS (SELECT doc_id, pos, w[pos] AS x FROM d, unnest(range(1, len(w) + 1)) t(pos)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY pos) AS k FROM word ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS c FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n.c, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)"""

BYTES = """
WITH d AS (SELECT doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS x FROM documents),
windows AS (SELECT doc_id, i, md5(substr(x, CAST(2 * i + 1 AS BIGINT), 400)) AS g FROM d, unnest(range(0, n - 199)) t(i)),
often AS (SELECT g FROM windows GROUP BY g HAVING count(*) > 1),
hit AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM windows SEMI JOIN often USING (g)),
numbered AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 200 THEN 1 ELSE 0 END)
                               OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hit),
runs AS (SELECT doc_id, run, min(i) AS a, max(i) + 200 AS z FROM numbered GROUP BY doc_id, run),
gaps AS (SELECT doc_id, run, a, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY run), 0) AS start FROM runs),
head AS (SELECT doc_id, string_agg(substr(x, CAST(2 * start + 1 AS BIGINT), CAST(2 * (a - start) AS BIGINT)), '' ORDER BY run) AS k
         FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
total AS (SELECT doc_id, count(*) AS s, sum(z - a) AS r, max(z) AS z FROM runs GROUP BY doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(r, 0) AS BIGINT) AS n_removed, coalesce(s, 0) AS n_spans,
       sha256(unhex(coalesce(k, '') || substr(x, CAST(2 * coalesce(z, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM d LEFT JOIN total USING (doc_id) LEFT JOIN head USING (doc_id)"""

CONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
item AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
grams AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM item, unnest(range(1, len(w) - n + 2)) t(i)),
sizes AS (SELECT DISTINCT n FROM grams),
windows AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM d, sizes, unnest(range(1, len(w) - n + 2)) t(i)),
hits AS (SELECT doc_id, windows.n, i, item_id FROM windows JOIN grams USING (g)),
words AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

CHATS = r"""
WITH c AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS l
           FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id
           UNION ALL SELECT conv_id, [{'r': role, 't': text}] FROM conversations WHERE conv_id IS NULL),
prefixes AS (SELECT DISTINCT l[1:k] AS l FROM c, unnest(range(1, len(l))) t(k)),
lead AS (SELECT l, min(conv_id) AS conv_id FROM c GROUP BY l)
SELECT conv_id, CAST(len(l) AS BIGINT) AS n_turns,
       array_to_string(list_transform(l, lambda x: '<|im_start|>' || coalesce(x.r, 'unknown') || chr(10)
         || regexp_replace(coalesce(x.t, ''), '<\|(im_start|im_end)\|>', '<||\1||>', 'g') || '<|im_end|>'), chr(10)) AS text
FROM lead ANTI JOIN prefixes USING (l)"""


def _codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Every Lloyd round as two table expressions: all parts against all entries, then floored means."""
    nearest = """SELECT vec_id, part, x, min(struct_pack(d := list_sum(list_transform(list_zip(x, e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), j := entry)) AS b
                 FROM cells JOIN book{k} USING (part) GROUP BY ALL"""
    steps = []
    for k in range(rounds):
        steps.append(f"near{k} AS MATERIALIZED ({nearest.format(k=k)})")
        steps.append(f"""mean{k} AS (SELECT part, b.j AS entry, i, sum(x[i])::BIGINT AS s, count(*) AS c FROM near{k}, unnest(range(1, len(x) + 1)) t(i) GROUP BY ALL),
fresh{k} AS (SELECT part, entry, list((s - ((s % c) + c) % c) // c ORDER BY i) AS e FROM mean{k} GROUP BY ALL),
book{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(f.e, o.e) AS e FROM book{k} o LEFT JOIN fresh{k} f USING (part, entry))""")
    return f"""
WITH fine AS (SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor(4096 * CAST(c AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
cells AS MATERIALIZED (SELECT vec_id, part, v[part * len(v) // {parts} + 1:(part + 1) * len(v) // {parts}] AS x FROM fine, unnest(range({parts})) t(part)),
seed AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM fine ORDER BY vec_id LIMIT {entries}),
book0 AS MATERIALIZED (SELECT part, entry, x AS e FROM seed JOIN cells USING (vec_id)),
{", ".join(steps)},
last AS ({nearest.format(k=rounds)}),
digest AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS h FROM book{rounds}),
rows AS (SELECT vec_id, string_agg(printf('%02x', b.j), '' ORDER BY part) AS code, CAST(sum(b.d) AS BIGINT) AS error FROM last GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM rows JOIN fine USING (vec_id), digest"""


VECTOR_CODES = _codes()
