"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from lendscope.llm.decontaminate import GRAM
from lendscope.llm.merkle_manifest import FIELDS
from lendscope.llm.mixing import DEFAULT_TOPIC, MARGINS, POWER, SOURCE_CAP, TOPIC_MARKS
from lendscope.llm.url_filter import DAYS, ENTRIES, FIRST_SECOND, HOST, SEGMENT

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
WITH d AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
"""

URL_FILTER = f"""
WITH p AS (
  SELECT page_id, url, {FIRST_SECOND} + (('0x' || substr(md5(page_id::VARCHAR), 1, 8))::BIGINT % {DAYS * 86400}) AS fetched_at,
         lower(regexp_extract(url, '{HOST}', 1)) AS host, regexp_extract(url, '{SEGMENT}', 1) AS segment
  FROM pages),
l AS (SELECT *, string_split(host, '.') AS labels FROM p WHERE host <> ''),
k AS (
  SELECT DISTINCT page_id, url, fetched_at,
         unnest(list_concat(list_transform(range(1, greatest(len(labels) - 1, 1) + 1), lambda i: array_to_string(labels[i:], '.')),
                            CASE WHEN segment <> '' THEN [host || '/' || segment] ELSE [] END)) AS rule
  FROM l),
n AS (
  SELECT rule, ('0x' || substr(md5(rule || '#' || j), 1, 8))::BIGINT AS n
  FROM (SELECT DISTINCT rule FROM k), range(0, {ENTRIES}) AS t(j)),
e AS (
  SELECT rule, {FIRST_SECOND} + ((n // 3) % {DAYS}) * 86400 AS listed_at,
         max(CASE WHEN (n // 2048) % 2 = 0 THEN 'block' ELSE 'allow' END) AS action
  FROM n WHERE n % 3 <> 0 GROUP BY ALL),
a AS (
  SELECT k.page_id, k.url, k.fetched_at, k.rule, e.listed_at, e.action
  FROM k ASOF JOIN e ON k.rule = e.rule AND k.fetched_at >= e.listed_at),
b AS (
  SELECT * FROM a
  QUALIFY row_number() OVER (PARTITION BY page_id, url, fetched_at ORDER BY length(rule) DESC, rule DESC) = 1)
SELECT p.page_id, p.url, p.fetched_at, b.rule, b.listed_at, coalesce(b.action = 'block', false) AS blocked
FROM p LEFT JOIN b ON p.page_id = b.page_id AND p.url = b.url AND p.fetched_at = b.fetched_at
"""


#: Twice the sweeps after which the operator first looks at its error: more of them no longer change a probability
MIXING_SWEEPS = 20


def _mixing() -> str:
    topic = f"'{DEFAULT_TOPIC}'"
    for name, mark in reversed(TOPIC_MARKS):
        topic = f"CASE WHEN contains(text, '{mark}') THEN '{name}' ELSE {topic} END"
    steps = [f"""
d AS (
  SELECT doc_id, source, lang, coalesce({topic}, '{DEFAULT_TOPIC}') AS topic,
         CASE WHEN length(text) > 0 THEN length(text) - length(replace(text, ' ', '')) + 1 ELSE 0 END AS n_tokens
  FROM documents),
c AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM d GROUP BY ALL)"""]
    weight = {"source": f"least(sum(tokens), {SOURCE_CAP} * (SELECT sum(tokens) FROM c))",
              "lang": "CASE WHEN sum(tokens) > 0 THEN 1.0::DOUBLE END", "topic": f"power(sum(tokens), {POWER['topic']})"}
    for m in MARGINS:
        steps.append(f"t_{m} AS (SELECT {m}, {weight[m]} / sum({weight[m]}) OVER () AS target FROM c GROUP BY {m})")
    last = "s_0"
    steps.append("s_0 AS (SELECT *, tokens AS mass FROM c)")
    for i in range(MIXING_SWEEPS):
        for m in MARGINS:
            now = f"s_{i + 1}_{m}"
            steps.append(f"{now} AS (SELECT s.source, s.lang, s.topic, s.tokens, "
                         f"s.mass * t.target / sum(s.mass) OVER (PARTITION BY s.{m}) AS mass "
                         f"FROM {last} s JOIN t_{m} t ON s.{m} IS NOT DISTINCT FROM t.{m})")
            last = now
    steps.append(f"r AS (SELECT *, CASE WHEN tokens > 0 THEN round((mass / tokens) / max(CASE WHEN tokens > 0 THEN mass / tokens END) OVER (), 9) "
                 f"ELSE 1.0 END AS probability FROM {last})")
    return "WITH " + ",\n".join(steps) + """
SELECT d.doc_id, d.source, d.lang, d.topic, d.n_tokens, round(r.probability, 6) AS probability,
       ('0x' || substr(md5(d.doc_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0 < r.probability AS kept
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source AND d.lang IS NOT DISTINCT FROM r.lang AND d.topic = r.topic
"""


def _decontaminate() -> str:
    words = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH i AS (SELECT item_id, {words} AS w FROM benchmark),
k AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS words
  FROM (SELECT item_id, w, least({GRAM}, len(w)) AS n, unnest(range(1, len(w) - least({GRAM}, len(w)) + 2)) AS p
        FROM i WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents),
p AS (
  SELECT rid, n, unnest(range(1, len(w) - n + 2)) AS p, w
  FROM d, (SELECT DISTINCT n FROM k) WHERE len(w) >= n),
h AS (
  SELECT p.rid, p.p, p.n, k.item_id FROM (SELECT rid, p, n, array_to_string(w[p:p + n - 1], ' ') AS words FROM p) p
  JOIN k ON k.words = p.words AND k.n = p.n),
s AS (
  SELECT rid, count(DISTINCT place) AS n_hit
  FROM (SELECT rid, unnest(range(p, p + n)) AS place FROM (SELECT DISTINCT rid, p, n FROM h)) GROUP BY rid),
m AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM h WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(s.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items,
       sha256(coalesce(m.items, '')) AS items_sha256, coalesce(s.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN s USING (rid) LEFT JOIN m USING (rid)
"""


def _merkle(levels: int = 8, root_levels: int = 4) -> str:
    """For up to 8 ** levels documents a language and 8 ** root_levels languages."""
    def field(value: str) -> str:
        return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"

    def digest(text: str) -> str:
        return "sha256(" + " || ".join(field(text if f == "text" else f) for f in FIELDS) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = ("list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), "
           "lambda r, c: list_reduce(list_concat([xor(r, c)], range(8)), "
           "lambda x, b: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))")
    steps = [f"d AS MATERIALIZED (SELECT doc_id, lang, {digest('text')} AS leaf, {digest(lower)} AS low, "
             f"coalesce(xor({crc}, 4294967295) % 3 = 0, false) AS tampered FROM documents)",
             "i AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, "
             "count(*) OVER (PARTITION BY lang) AS n, row_number() OVER () AS rid FROM d)",
             "n_0 AS MATERIALIZED (SELECT lang, idx, leaf AS h, n FROM i)",
             "f_0 AS MATERIALIZED (SELECT rid, lang, idx AS place, CASE WHEN tampered THEN low ELSE leaf END AS now, "
             "'' AS proof FROM i)"]

    def climb(k: int, to: str) -> None:
        steps.append(f"r_{k} AS MATERIALIZED (SELECT lang, idx // 8 AS up, string_agg(h, '' ORDER BY idx) AS run, "
                     f"any_value(n) AS n FROM n_{k} WHERE n > 1 GROUP BY lang, idx // 8)")
        steps.append(f"n_{to} AS MATERIALIZED (SELECT lang, up AS idx, sha256(run) AS h, (n + 7) // 8 AS n FROM r_{k} "
                     f"UNION ALL SELECT lang, idx, h, n FROM n_{k} WHERE n = 1)")
        left, right = "substr(r.run, 1, 64 * (f.place % 8)::BIGINT)", "substr(r.run, 64 * (f.place % 8)::BIGINT + 65)"
        steps.append(f"f_{to} AS MATERIALIZED (SELECT f.rid, f.lang, f.place // 8 AS place, "
                     f"CASE WHEN r.run IS NULL THEN f.now ELSE sha256({left} || f.now || {right}) END AS now, "
                     f"CASE WHEN r.run IS NULL THEN f.proof ELSE f.proof || {left} || {right} END AS proof "
                     f"FROM f_{k} f LEFT JOIN r_{k} r ON f.lang IS NOT DISTINCT FROM r.lang AND f.place // 8 = r.up)")

    for k in range(levels):
        climb(k, k + 1)
    top = levels + 1
    steps.append(f"s AS MATERIALIZED (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, "
                 f"count(*) OVER () AS n FROM n_{levels})")
    steps.append(f"n_{top} AS MATERIALIZED (SELECT 0 AS lang, idx, subroot AS h, n FROM s)")
    steps.append(f"f_{top} AS MATERIALIZED (SELECT f.rid, 0 AS lang, s.idx AS place, f.now, f.proof "
                 f"FROM f_{levels} f JOIN s ON f.lang IS NOT DISTINCT FROM s.lang)")
    for k in range(top, top + root_levels):
        climb(k, k + 1)
    last = top + root_levels
    return "WITH " + ",\n".join(steps) + f"""
SELECT i.doc_id, i.leaf, s.subroot, t.h AS root, sha256(f.proof) AS proof_sha256, f.now AS folded_root,
       f.now = t.h AS verified
FROM i JOIN f_{last} f USING (rid) JOIN s ON i.lang IS NOT DISTINCT FROM s.lang, n_{last} t
"""


def sql() -> dict[str, str]:
    return {"op5_url_filter": URL_FILTER, "op6_exact_dedup": EXACT_DEDUP, "op8_mixing": _mixing(),
            "op12_merkle_manifest": _merkle(), "op13_decontaminate": _decontaminate()}
