"""DuckDB SQL for the queries that SQL can express, over the same tables.

op1: rules as a VALUES list, longest match by a join. op2: exact set similarity
of whole shingle sets through shared shingles, then a recursive walk (op13
alike). op11: the rounds written out, in integers. op12: all scores. op4 (as
template windows), op5, op9 and op10 have no SQL (learned models, SimHash); op3
orders by a hash that DuckDB lacks. They are tested against brute force.
"""

from __future__ import annotations

from fleetreports.llm import hard_negatives, mixing, secret_scan, substring_dedup, url_rules, vector_codes


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def url_rules_sql() -> str:
    rules = ", ".join(f"({_text(h)}, {_text(p)}, {_text(v)})" for h, p, v in url_rules.RULES)
    return f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {rules}),
parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
judged AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path,
         row_number() OVER () AS rid
  FROM parts
),
fits AS (
  SELECT rid, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY rid ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC, rule_verdict DESC) AS rank
  FROM judged JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
FROM judged LEFT JOIN (SELECT * FROM fits WHERE rank = 1) USING (rid)"""


def near_dedup_sql() -> str:
    return _linked_sql(5, 75).replace(", component_id FROM sets", ", component_id, doc_id = component_id AS kept FROM sets")


def jaccard_join_sql() -> str:
    return _linked_sql(3, 90)


def _linked_sql(n: int, percent: int) -> str:
    """Components of documents whose sets of n-word shingles are this similar."""
    sql = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\x0b\\f\\r]+'), lambda x: x <> '') AS words FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN []
    ELSE list_distinct(list_transform(range(1, greatest(len(words) - 4, 1) + 1), lambda i: array_to_string(words[i:i + 4], ' '))) END AS s
  FROM w
),
sh AS (SELECT doc_id, len(s) AS n, md5(unnest(s)) AS h FROM sets),
same AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS n_shared
         FROM sh a JOIN sh b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM same WHERE 100 * n_shared >= 75 * (na + nb - n_shared)),
walk(doc_id, seen) AS (
  SELECT doc_id, doc_id FROM sets
  UNION SELECT walk.doc_id, links.b FROM walk JOIN links ON walk.seen = links.a
),
least AS (SELECT doc_id, min(seen) AS component_id FROM walk GROUP BY 1)
SELECT doc_id, len(s) AS n_shingles, component_id FROM sets JOIN least USING (doc_id)"""
    return (sql.replace("len(words) - 4", f"len(words) - {n - 1}").replace("words[i:i + 4]", f"words[i:i + {n - 1}]")
            .replace(">= 75 *", f">= {percent} *"))


def mixing_sql() -> str:
    seed, part = mixing.SEED, mixing.PART

    def hashed(*values: str) -> str:
        return f"('0x' || substr(md5(concat_ws(':', {', '.join(f"coalesce(CAST({v} AS VARCHAR), '')" for v in values)})), 1, 13))::BIGINT"

    return f"""
WITH RECURSIVE have AS (
  SELECT source, sum(strlen(coalesce(text, '')) + 1) AS bytes FROM documents GROUP BY source
),
rates AS (
  SELECT source, 1.0::DOUBLE / (SELECT count(*) FROM have) * (SELECT sum(bytes) FROM have)::DOUBLE / bytes::DOUBLE AS rate FROM have
),
means AS (SELECT source, greatest(1, ceil(rate / {part}))::INTEGER AS parts, rate / greatest(1, ceil(rate / {part}))::INTEGER AS mean FROM rates),
cdf(source, parts, mean, k, p, c) AS (
  SELECT source, parts, mean, 0, exp(-mean), exp(-mean) FROM means
  UNION ALL
  SELECT source, parts, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM cdf WHERE k < ceil(mean + 12 * sqrt(mean) + 20)
),
cdfs AS (SELECT source, any_value(parts) AS parts, list(c ORDER BY k) AS cdf FROM cdf GROUP BY source),
counted AS (
  SELECT d.*, (SELECT sum(len(list_filter(cdf, lambda c: c <= {hashed(f"'{seed}'", 'd.doc_id', 'md5(d.text)', 'j')}::DOUBLE / 4503599627370496.0)))
               FROM unnest(range(1, parts + 1)) t(j)) AS copies
  FROM documents d JOIN cdfs ON d.source IS NOT DISTINCT FROM cdfs.source
),
copied AS (SELECT * EXCLUDE (copies), unnest(range(0, copies::BIGINT))::INTEGER AS copy FROM counted WHERE copies > 0)
SELECT *, {hashed(f"'{seed}-place'", 'doc_id', 'md5(text)', 'copy')} AS mix_key FROM copied"""


def substring_dedup_sql() -> str:
    n = substring_dedup.WINDOW
    return f"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0b\\f\\r]+'), lambda x: x <> '') AS words FROM documents
),
win AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + {n - 1}], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {n - 2})) AS i FROM w WHERE len(words) >= {n})
),
gone AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) < doc_id AS again FROM win),
tok AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
marked AS (
  SELECT tok.doc_id, tok.i, word, max(CASE WHEN again THEN 1 ELSE 0 END)
         OVER (PARTITION BY tok.doc_id ORDER BY tok.i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS covered
  FROM tok LEFT JOIN gone ON tok.doc_id = gone.doc_id AND tok.i = gone.i
),
kept AS (SELECT doc_id, sum(covered)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (covered = 0) AS text FROM marked GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""


def secret_scan_sql() -> str:
    """Matches and the pieces between them give every span's place."""
    rules = secret_scan.RULES
    cols, spans = [], []
    for n, r in enumerate(rules):
        pattern = _text(("(?i)" if r.any_case else "") + r.pattern)
        cols.append(f"regexp_extract_all(text, {pattern}, 0) AS m{n}, regexp_extract_all(text, {pattern}, {r.group}) AS g{n}, "
                    f"string_split_regex(text, {pattern}) AS p{n}")
        start = (f"(list_sum(list_transform(p{n}[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m{n}[1:i - 1], lambda x: length(x))), 0))::BIGINT")
        spans.append(f"list_transform(list_filter(range(1, len(m{n}) + 1), lambda i: length(g{n}[i]) >= {r.least}), "
                     f"lambda i: {{'s': {start}, 'k': {n}, 'e': {start} + length(m{n}[i]), 'kind': {_text(r.kind)}}}) AS s{n}")
    base = [f"s{n}" for n, r in enumerate(rules) if r.base]
    every = [f"s{n}" for n in range(len(rules))]

    def joined(names: list[str]) -> str:
        return f"array_to_string(list_transform(list_sort(flatten([{', '.join(names)}])), lambda x: x.kind || ':' || x.s || ':' || x.e), ',')"

    counts = ", ".join(f"len(s{n})::BIGINT AS n_{r.kind}" for n, r in enumerate(rules))
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS (SELECT doc_id, {', '.join(cols)} FROM t),
spans AS (SELECT doc_id, {', '.join(spans)} FROM found)
SELECT doc_id, {counts}, sha256({joined(base)}) AS base_sha256, {joined(every)} AS spans FROM spans"""


def vector_codes_sql() -> str:
    """All parts against all entries in every round."""
    parts, scale = vector_codes.PARTS, vector_codes.SCALE
    steps = [f"""
kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
cut AS (
  SELECT vec_id, label, part, v[part * (len(v) // {parts}) + 1:(part + 1) * (len(v) // {parts})] AS p
  FROM kept, unnest(range(0, {parts})) t(part)
),
book0 AS (
  SELECT part, entry, p AS c
  FROM (SELECT part, p, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM cut) WHERE entry < {vector_codes.ENTRIES}
)"""]
    for k in range(vector_codes.ROUNDS + 1):
        steps.append(f"""
near{k} AS (
  SELECT vec_id, any_value(label) AS label, part, any_value(p) AS p,
         min(list_sum(list_transform(list_zip(p, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 256 + entry) AS best
  FROM cut JOIN book{k} USING (part) GROUP BY vec_id, part
)""")
        if k < vector_codes.ROUNDS:
            steps.append(f"""
sum{k} AS (
  SELECT part, entry, i, sum(x)::BIGINT AS s, count(*) AS n
  FROM (SELECT part, best % 256 AS entry, unnest(p) AS x, unnest(range(1, len(p) + 1)) AS i FROM near{k}) GROUP BY ALL
),
new{k} AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM sum{k} GROUP BY part, entry),
book{k + 1} AS (SELECT part, entry, coalesce(new{k}.c, book{k}.c) AS c FROM book{k} LEFT JOIN new{k} USING (part, entry))""")
    last = vector_codes.ROUNDS
    return "WITH" + ",".join(steps) + f""",
coded AS (
  SELECT vec_id, any_value(label) AS label, string_agg(lower(printf('%02x', best % 256)), '' ORDER BY part) AS code, sum(best // 256)::BIGINT AS error
  FROM near{last} GROUP BY vec_id
),
sha AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{last})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, sha"""


def hard_negatives_sql() -> str:
    return f"""
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({hard_negatives.SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM kept a JOIN kept b ON a.vec_id % {hard_negatives.EVERY} = 0 AND a.vec_id <> b.vec_id
),
positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM scored WHERE same)
  WHERE place <= {hard_negatives.POSITIVES}
),
negatives AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
   AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= {hard_negatives.NEGATIVES}"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_rules": url_rules_sql(),
        "op2_near_dedup": near_dedup_sql(),
        "op6_mixing": mixing_sql(),
        "op7_substring_dedup": substring_dedup_sql(),
        "op8_secret_scan": secret_scan_sql(),
        "op11_vector_codes": vector_codes_sql(),
        "op12_hard_negatives": hard_negatives_sql(),
        "op13_jaccard_join": jaccard_join_sql(),
    }
