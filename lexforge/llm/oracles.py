"""The same results as DuckDB SQL, for the operators that SQL can express."""

from __future__ import annotations

from lexforge.llm.catalog_values import MIX_EPOCHS, MIX_SEED, MIX_SHARE, MIX_WEIGHTS, URL_RULES
from lexforge.llm.licenses import DIGESTS, PROSE, SPELLINGS, known_texts

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP2 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), sized AS (
  SELECT *, list_sum(list_transform(regexp_extract_all(text, '#{3,}'), lambda x: length(x) - 2)) AS signs,
    list_sum(list_transform(regexp_extract_all(role, '#{3,}'), lambda x: length(x) - 2)) AS role_signs
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(
    length('### : ' || ' </turn>' || chr(10)) + length(role) + length(text) + coalesce(signs, 0) + coalesce(role_signs, 0)
    + length(text) - length(replace(text, '\', '')) + (length(text) - length(replace(text, '</turn>', ''))) // 7
    + length(role) - length(replace(replace(role, '\', ''), ':', '')) + (length(role) - length(replace(role, '</turn>', ''))) // 7
  ) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

BRANCHES = """
WITH RECURSIVE d AS (
  SELECT c.lang AS tree, c.doc_id AS node, c.n_chars % 7 AS score, p.doc_id AS parent
  FROM documents c LEFT JOIN documents p ON p.doc_id = c.doc_id // 2 AND p.lang IS NOT DISTINCT FROM c.lang AND p.doc_id != c.doc_id
), up AS (
  SELECT tree, node AS leaf, parent, 1 AS depth, score AS total, CAST(node AS VARCHAR) AS path FROM d WHERE node NOT IN (SELECT parent FROM d WHERE parent IS NOT NULL)
  UNION ALL
  SELECT up.tree, leaf, d.parent, depth + 1, total + score, d.node || '>' || path FROM up JOIN d ON d.node = up.parent
), whole AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY CAST(total AS DOUBLE) / depth DESC, depth DESC, leaf) AS rank FROM up WHERE parent IS NULL)
SELECT tree, leaf, CAST(rank AS INT) AS rank, depth AS n_messages, path FROM whole WHERE rank <= 3
"""

WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP5 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS w FROM documents),
b AS (SELECT row_number() OVER () AS bid, CAST(item_id AS VARCHAR) AS item, {WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[k : k + 9], ' ') AS gram
  FROM (SELECT item, w, unnest(range(1, greatest(2, len(w) - 8))) AS k FROM b WHERE len(w) > 0)
),
lengths AS (SELECT DISTINCT n FROM win),
spots AS (
  SELECT rid, n, k, array_to_string(w[k : k + n - 1], ' ') AS gram
  FROM (SELECT rid, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS k FROM d, lengths WHERE len(w) >= n)
),
hits AS (SELECT DISTINCT rid, spots.n, k, item FROM spots JOIN win ON spots.gram = win.gram AND spots.n = win.n),
places AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(k, k + n)) AS p FROM hits) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid),
grams AS (  -- the different windows, and how many benchmark rows have each
  SELECT g, count(DISTINCT bid) AS weight, row_number() OVER (ORDER BY g) AS wid
  FROM (SELECT bid, w[k : k + 9] AS g FROM (SELECT bid, w, unnest(range(1, greatest(2, len(w) - 8))) AS k FROM b WHERE len(w) > 0)) GROUP BY g
),
wt AS (SELECT wid, len(g) AS n, unnest(g) AS t, generate_subscripts(g, 1) AS k FROM grams),
dt AS (SELECT rid, unnest(w) AS t, generate_subscripts(w, 1) AS p FROM d),
df AS (SELECT t, count(*) AS c FROM dt SEMI JOIN wt USING (t) GROUP BY t),
lead AS (SELECT wid, arg_min(t, (coalesce(c, 0), k)) AS t, arg_min(k, (coalesce(c, 0), k)) AS k FROM wt LEFT JOIN df USING (t) GROUP BY wid),
starts AS (SELECT DISTINCT wid, rid, p - k + x AS s FROM lead JOIN dt USING (t), (SELECT unnest([-1, 0, 1]) AS x)),
met AS (
  SELECT wid, rid, s, wt.n, count(DISTINCT k) AS near, count(*) FILTER (p = s + k) AS exact
  FROM starts JOIN wt USING (wid) JOIN dt USING (rid, t) WHERE p BETWEEN s + k - 1 AND s + k + 1 GROUP BY wid, rid, s, wt.n
),
close AS (SELECT rid, CAST(sum(weight) AS BIGINT) AS n_near FROM met JOIN grams USING (wid) WHERE near = n AND exact < n GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN places USING (rid) LEFT JOIN items USING (rid) LEFT JOIN close USING (rid)
"""


def _canonical(column: str) -> str:
    """Line by line: a line that names a year, a mark or a holder goes; what a line break puts behind the word in prose stays."""
    head = r"^[\x20\t]*"
    holder = rf"{head}[Cc]opyright:?[\x20\t]+"
    marked = rf"{head}(?i:copyright)[\x20\t:,]*((?i:\(c\)|©|&copy;|\(r\)|®)|(?i:by[\x20\t])|[12][0-9]{{3}}\b|<year>|\[year\])"
    bare = rf"{head}(?i:\(c\)[\x20\t,]*(copyright|[12][0-9]{{3}}\b|<year>|\[year\])|©|all rights reserved)"
    gone = f"regexp_matches(x, '{marked}') OR regexp_matches(x, '{bare}') OR (regexp_matches(x, '{holder}\\p{{Lu}}') AND NOT regexp_matches(x, '{holder}(?i:{PROSE})\\b'))"
    kept = f"array_to_string(list_transform(string_split({column}, chr(10)), lambda x: CASE WHEN {gone} THEN regexp_extract(x, '^[\\x20\\t]*') ELSE x END), chr(10))"
    out = rf"regexp_replace(lower({kept}), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"
    for old, new in SPELLINGS.items():
        out = rf"regexp_replace({out}, '\b{old}\b', '{new}', 'g')"
    return out


def _one_line(canon: str) -> str:
    """All lines as one; spellings of two words also where a line break stood between them."""
    out = rf"trim(regexp_replace({canon}, '[ \n]+', ' ', 'g'))"
    for old, new in SPELLINGS.items():
        out = rf"regexp_replace({out}, '\b{old}\b', '{new}', 'g')" if " " in old else out
    return out


def op7() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    known = ", ".join(f"({quote(name)}, {quote(kind)}, {quote(text)})" for name, kind, text in known_texts())
    long = ", ".join(f"({quote(d)}, {quote(name)}, 'text')" for name, own in DIGESTS.items() for d in own)
    return rf"""
WITH known AS (
  SELECT sha256({_one_line(_canonical('text'))}) AS digest, license, kind
  FROM (VALUES {known}) AS t(license, kind, text) UNION ALL SELECT * FROM (VALUES {long}) AS l(digest, license, kind)
), whole AS (SELECT digest, min(license) AS license FROM known GROUP BY digest),
notice AS (SELECT DISTINCT digest FROM known WHERE kind = 'notice'),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_canonical('text')} AS canon FROM documents),
hit AS (
  SELECT rid, license FROM (SELECT rid, sha256(unnest(list_transform(string_split(canon, chr(10)), lambda x: trim(x)))) AS digest FROM d)
  JOIN notice USING (digest) JOIN whole USING (digest)
), named AS (SELECT rid, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS names FROM hit GROUP BY rid)
SELECT doc_id, e.digest, license, coalesce(n, 0) AS n_notices, coalesce(names, '') AS notices
FROM (SELECT rid, doc_id, sha256({_one_line('canon')}) AS digest FROM d) e LEFT JOIN named USING (rid) LEFT JOIN whole ON whole.digest = e.digest
"""


def op10() -> str:
    levels = ["domain", "lang", "source"]

    def weight(level: str) -> str:
        own = MIX_WEIGHTS.get(level, {})
        cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in own.items() if k != "*")
        return f"CASE {level} {cases} ELSE {own.get('*', 1)} END" if cases else str(own.get("*", 1))

    steps, last = [], "leaves"
    for depth, level in enumerate(levels):
        path, family = ", ".join(levels[: depth + 1]), ", ".join(levels[:depth])
        over = f"PARTITION BY {family}" if family else ""
        before = f"({over} ORDER BY cap / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        steps.append(f"""
a{depth} AS (SELECT {path}, sum(cap) AS cap, any_value(budget) AS given, {weight(level)} AS w FROM {last} GROUP BY {path}),
b{depth} AS (SELECT *, CAST(given - coalesce(sum(cap) OVER {before}, 0) AS DOUBLE) / CAST(sum(w) OVER ({over}) - coalesce(sum(w) OVER {before}, 0) AS DOUBLE) AS rate FROM a{depth}),
c{depth} AS (SELECT *, max(CASE WHEN cap > w * rate THEN rate END) OVER ({over}) AS level_rate FROM b{depth}),
n{depth} AS (
  SELECT {', '.join('n.' + x for x in levels)}, n.tokens, n.cap, CASE WHEN c.cap <= c.w * c.rate THEN CAST(c.cap AS DOUBLE) ELSE greatest(0.0::DOUBLE, c.w * c.level_rate) END AS budget
  FROM {last} n JOIN c{depth} c ON {' AND '.join(f'n.{x} = c.{x}' for x in levels[: depth + 1])}
)""")
        last = f"n{depth}"
    place = f"md5('{MIX_SEED}:' || CAST(passes AS VARCHAR) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) || ':' || lpad(CAST(n_tokens AS VARCHAR), 12, '0')"
    none = "chr(1)"
    return rf"""
WITH d AS (
  SELECT doc_id, source AS source_0, lang AS lang_0, coalesce(source, {none}) AS source, coalesce(lang, {none}) AS lang,
    'd' || CAST(coalesce(TRY_CAST(regexp_extract(source, '[0-9]+$') AS BIGINT), 0) % 3 AS VARCHAR) AS domain,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS n_tokens
  FROM documents
), leaves AS (
  SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(sum(n_tokens) * {MIX_EPOCHS} AS BIGINT) AS cap,
    CAST(floor(CAST((SELECT sum(n_tokens) FROM d) AS DOUBLE) * CAST({MIX_SHARE} AS DOUBLE)) AS DOUBLE) AS budget
  FROM d GROUP BY domain, lang, source
), {','.join(steps)},
plan AS (SELECT domain, lang, source, tokens, CAST(floor(budget) AS BIGINT) AS budget FROM {last}),
plan2 AS (SELECT *, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS passes FROM plan),
rows_ AS (SELECT d.*, passes, budget - passes * tokens AS need, {place} AS place FROM d JOIN plan2 USING (domain, lang, source)),
cum AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
   - sum(n_tokens) OVER (PARTITION BY domain, lang, source, place) AS before FROM rows_)
SELECT doc_id, source_0 AS source, lang_0 AS lang, n_tokens, CAST(passes + CASE WHEN need > 0 AND before < need THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM cum WHERE passes > 0 OR (need > 0 AND before < need)
"""


#: What the patterns of the query say, written out as conditions; the longest first.
PATTERN_SQL = (
    ("/affiliate/terms.html|", "allow", "ends_with(address, '/affiliate/terms.html')"), ("/banners/*/click^", "block", r"regexp_matches(address, '(?s)/banners/.*/click([^0-9a-z_.%-]|\z)')"),
    ("||cheap-pills.", "block", "contains('.' || host, '.cheap-pills.')"), ("||ads-track.", "block", "contains('.' || host, '.ads-track.')"),
    ("||spam-farm.", "block", "contains('.' || host, '.spam-farm.')"), ("/affiliate^", "block", r"regexp_matches(address, '/affiliate([^0-9a-z_.%-]|\z)')"), ("||adserver.", "block", "contains('.' || host, '.adserver.')"),
    ("/sponsored/", "block", "contains(address, '/sponsored/')"), ("||tracker.", "block", "contains('.' || host, '.tracker.')"), ("||casino.", "block", "contains('.' || host, '.casino.')"), ("||ads.", "block", "contains('.' || host, '.ads.')"),
)


def op11() -> str:
    """The rules as a list of cases, the longest first."""
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    rules = sorted(URL_RULES, key=lambda r: -len(r[1] + r[2]))
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in rules)
    verdict = " ".join(f"WHEN '{h}{p}' THEN '{v}'" for v, h, p in rules)
    parts = r"'(?s)^.*?://([^/?#]*)([^?#]*)(.*)'"
    return f"""
WITH u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, {parts}, 1), ''), '{UPPER}', '{LOWER}') AS host, coalesce(regexp_extract(url, {parts}, 2), '') AS path,
    coalesce(regexp_extract(url, {parts}, 3), '') AS rest FROM pages
), r AS (SELECT *, CASE {rule} END AS rule, translate(host || path || rest, '{UPPER}', '{LOWER}') AS address FROM u),
p AS (SELECT *, CASE WHEN rule IS NULL THEN CASE {" ".join(f"WHEN {sql} THEN '{name}'" for name, _, sql in PATTERN_SQL)} END END AS pattern FROM r)
SELECT page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN CASE rule {verdict} END WHEN pattern IS NOT NULL THEN CASE pattern {" ".join(f"WHEN '{name}' THEN '{v}'" for name, v, _ in PATTERN_SQL)} END ELSE 'allow' END AS verdict, pattern FROM p"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_reply_trees": OP2, "op5_benchmark_decontamination": OP5, "op7_license_digests": op7(), "op10_hierarchical_mix": op10(), "op11_url_filter": op11(), "reply_branches": BRANCHES,
    }
