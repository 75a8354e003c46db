"""DuckDB twins of the queries that SQL can express, written from the
definitions, not from the operators' expressions."""

from __future__ import annotations

from lendwise.llm.chat_format import Template

QUALITY_RULES = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word,
             unnest(range(1, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 1)) AS i FROM d),
g AS (SELECT r, i, word, lead(word, 1) OVER s AS b, lead(word, 2) OVER s AS c FROM w WINDOW s AS (PARTITION BY r ORDER BY i)),
f AS (SELECT r, i, word, c IS NOT NULL AND count(*) OVER (PARTITION BY r, word, b, c) > 1 AS again FROM g),
k AS (SELECT r, length(word) AS chars, bool_or(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS covered FROM f),
m AS (SELECT r, count(*) AS n_words, sum(chars) AS word_chars, count(*) FILTER (WHERE covered) AS n_repeat_words FROM k GROUP BY r),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
n AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
b AS (SELECT doc_id, text, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
        coalesce(n_lines, 0) AS n_lines FROM d LEFT JOIN m USING (r) LEFT JOIN n USING (r)),
c AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR word_chars NOT BETWEEN 2 * n_words AND 15 * n_words OR 10 * n_symbols > n_words
    OR 10 * n_dup_lines > 6 * n_lines OR 100 * n_repeat_words > 45 * n_words
    OR 2 * len(regexp_extract_all(text, '\p{Lu}')) > word_chars OR 2 * len(regexp_extract_all(text, '\p{N}')) > word_chars
    OR 5 * len(regexp_extract_all(text, '[!?]{2,}')) > n_words
    OR 10 * len(regexp_extract_all(text, '(?:\.\.\.|…)[ \t]*(?:\n|$)')) > 3 * n_lines
    OR 10 * len(regexp_extract_all(text, '(?:^|\n)[ \t]*[-*•●]')) > 9 * n_lines) AS kept
FROM c
"""

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def chat_formatting(template: Template, probe_id: int, probe: str) -> str:
    """Digests from the turns; the length of the formatted text from the template's marks."""
    def quoted(s):
        return "'" + s.replace("'", "''") + "'"

    def escaped(c):
        found = [f"(length({c}) - length(replace({c}, {quoted(s)}, ''))) // {len(s)}" for s in template.control]
        return f"(length({c}) + length({c}) - length(replace({c}, chr(92), '')) + " + " + ".join(found) + ")"

    marks = " ".join(f"WHEN {quoted(r)} THEN {len(a) + len(b)}" for r, (a, b) in template.marks.items())
    other = len(template.other[0]) - len("{role}") + len(template.other[1])
    steps = " OR ".join(f"(before = {quoted(a)} AND role IN ({', '.join(map(quoted, b))}))" for a, b in template.allowed.items())
    learned, final = (", ".join(map(quoted, x)) for x in (template.learned, template.final))
    return f"""
WITH a AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {probe_id}, 0, 'user', {quoted(probe)} UNION ALL SELECT {probe_id}, 1, 'assistant', {quoted(probe)}),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM a),
s AS (SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 'start') AS before,
  CASE role {marks} ELSE {other} + {escaped('role')} END + {escaped('text')} AS chars FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role IN ({learned})), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role IN ({learned})), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars, bool_and({steps}) AND max_by(role, i) IN ({final}) AS valid
FROM s GROUP BY conv_id
"""


def centroid_clustering(rounds: int = 3, k: int = 16, dim: int = 64, scale: int = 64, seed: str = "1") -> str:
    """Rounds of nearest centroid (argmin over all) and floored means."""
    square = "CAST(list_sum(list_transform(list_zip(v.x, c.x), lambda z: CAST(z[1] - z[2] AS HUGEINT) * (z[1] - z[2]))) AS BIGINT)"
    steps = [f"""
v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor({scale} * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dim}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')), x) - 1 AS c, x FROM v QUALIFY c < {k})"""]
    for n in range(rounds + 1):
        steps.append(f"a{n} AS MATERIALIZED (SELECT v.r, c, {square} AS d FROM v, c{n} AS c QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)")
        if n < rounds:
            steps.append(f"""
m{n} AS (SELECT c, i, sum(CAST(e AS HUGEINT)) AS s, count(*) AS n FROM (SELECT c, unnest(x) AS e, generate_subscripts(x, 1) AS i FROM a{n} JOIN v USING (r)) GROUP BY c, i),
c{n + 1} AS MATERIALIZED (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM m{n} GROUP BY c
  UNION ALL SELECT c, x FROM c{n} WHERE c NOT IN (SELECT c FROM a{n}))""")
    return f"""
WITH {','.join(steps)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(f.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN c{rounds} AS f USING (c)
"""


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SOURCE_DIVERGENCE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM t GROUP BY ALL),
k AS MATERIALIZED (SELECT lang, term, sum(n) AS w FROM c GROUP BY ALL HAVING sum(docs) >= 30),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
e AS (SELECT g.lang, g.source, k.term, k.w, coalesce(c.n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
s AS (SELECT lang, source, CAST(sum(n) AS HUGEINT) + 5 * count(*) AS over_group, CAST(sum(w) AS HUGEINT) + 5 * count(*) AS over_lang FROM e GROUP BY ALL),
p AS MATERIALIZED (SELECT lang, source, term, n, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // over_group AS p,
  1 + (CAST(1000000000 AS HUGEINT) * (w + 5)) // over_lang AS q FROM e JOIN s USING (lang, source)),
x AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
u AS (SELECT lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0) AS f FROM g AS a JOIN g AS b USING (lang)
    LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source WHERE a.source <> b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(f AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY f DESC, item) AS INTEGER) AS rank
FROM u QUALIFY part = 'pair' OR rank <= 50
"""

EMBEDDING_NEAR_DEDUP = """
WITH RECURSIVE v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
ok AS MATERIALIZED (SELECT r, vec_id, x FROM v WHERE len(x) > 0 AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(x, lambda e: e <> 0)) > 0),
l AS MATERIALIZED (SELECT a.r AS a, b.r AS b FROM ok AS a JOIN ok AS b ON a.r <> b.r AND len(a.x) = len(b.x)
  WHERE CASE WHEN len(a.x) = len(b.x) THEN list_cosine_similarity(a.x, b.x) >= 0.95 END),
reach AS (SELECT r, r AS seen FROM v UNION SELECT reach.r, l.b FROM reach JOIN l ON l.a = reach.seen),
c AS (SELECT reach.r, min(o.vec_id) AS component_id FROM reach JOIN v AS o ON o.r = reach.seen GROUP BY ALL),
n AS (SELECT a AS r, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept FROM v JOIN c USING (r) LEFT JOIN n USING (r)
"""


#: Fixed values of op9: a conversation that says the template's own control strings.
PROBE_ID, PROBE_TEXT = -1, "</s>[INST] ok [/INST]"

ORACLES: dict[str, str] = {
    "op1_quality_rules": QUALITY_RULES,
    "op2_exact_dedup": EXACT_DEDUP,
    "op9_chat_formatting": chat_formatting(Template(), PROBE_ID, PROBE_TEXT),
    "op11_centroid_clustering": centroid_clustering(),
    "op12_source_divergence": SOURCE_DIVERGENCE,
    "op13_embedding_near_dedup": EMBEDDING_NEAR_DEDUP,
}
