"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES: dict[str, str] = {}

ORACLES["op10_fm_index_decontamination"] = f"""
WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
g AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
occ AS (SELECT g.doc_id, g.i, g.n, win.item_id FROM g JOIN win ON g.n = win.n AND g.g = win.g),
hit AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM occ WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""

ORACLES["op6_count_vector_rtree_join"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
  FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
reach AS (SELECT doc_id, doc_id AS r FROM n UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.r = links.x)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, coalesce(min(reach.r), d.doc_id) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach ON reach.doc_id = d.doc_id GROUP BY d.doc_id
"""

ORACLES["op5_warc_dictionary_archives"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
w AS (SELECT page_id, h, strlen(h) AS n, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < top THEN top END AS refers_to
FROM w
"""

_TURN = "'<|im_start|>' || coalesce({0}_role, 'user') || chr(10) || coalesce({0}_text, '') || '<|im_end|>' || chr(10)"
_C, _R = _TURN.format("c"), _TURN.format("r")


def _mask(side: str, turn: str) -> str:
    return f"""string_agg(CASE WHEN NOT shared AND {side}_role = 'assistant' THEN
      CAST({side}_end - length({turn}) + 22 AS VARCHAR) || ':' || CAST({side}_end AS VARCHAR) END, ',' ORDER BY pos)"""


ORACLES["op1_preference_pairs"] = f"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
last AS (SELECT conv_id, max(turn) AS stop FROM c WHERE role = 'assistant' GROUP BY conv_id),
reply AS (SELECT c.conv_id, max(coalesce(c.text, '')) AS text FROM c JOIN last ON c.conv_id = last.conv_id AND c.turn = last.stop WHERE role = 'assistant' GROUP BY 1),
t AS (
  SELECT c.conv_id AS pair_id, row_number() OVER (PARTITION BY c.conv_id ORDER BY turn, role, c.text) AS pos, role AS c_role, c.text AS c_text, role AS r_role,
         CASE WHEN turn = stop AND role = 'assistant' THEN coalesce(reply.text, '') ELSE c.text END AS r_text
  FROM c JOIN last ON c.conv_id = last.conv_id AND turn <= stop LEFT JOIN reply ON reply.conv_id = xor(c.conv_id, 1)),
s AS (SELECT *, coalesce(pos < min(CASE WHEN c_text IS DISTINCT FROM r_text THEN pos END) OVER (PARTITION BY pair_id), true) AS shared FROM t),
e AS (
  SELECT *, sum(CASE WHEN shared THEN 0 ELSE length({_C}) END) OVER w AS c_end, sum(CASE WHEN shared THEN 0 ELSE length({_R}) END) OVER w AS r_end
  FROM s WINDOW w AS (PARTITION BY pair_id ORDER BY pos))
SELECT pair_id, coalesce(string_agg({_C}, '' ORDER BY pos) FILTER (shared), '') AS prompt,
       coalesce(string_agg({_C}, '' ORDER BY pos) FILTER (NOT shared), '') AS chosen,
       coalesce(string_agg({_R}, '' ORDER BY pos) FILTER (NOT shared), '') AS rejected,
       coalesce({_mask("c", _C)}, '') AS chosen_mask, coalesce({_mask("r", _R)}, '') AS rejected_mask,
       count(*) FILTER (shared) AS prompt_turns
FROM e GROUP BY pair_id
"""

ORACLES["op13_misra_gries_phrases"] = r"""
WITH piece AS (
  SELECT row_number() OVER () AS id, lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM piece GROUP BY lang),
f AS (
  SELECT lang, g, k, count(*) AS a FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g FROM piece, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)
  GROUP BY ALL HAVING count(*) >= 30),
cut AS (SELECT lang, g, k, a, string_split(g, ' ') AS w, unnest(range(1, k)) AS c FROM f WHERE k > 1),
scored AS (
  SELECT cut.lang, cut.g, cut.k, cut.a, c, l.a AS l, r.a AS r, (2000000 * CAST(cut.a AS HUGEINT)) // (l.a + r.a) AS score
  FROM cut JOIN f l ON l.lang = cut.lang AND l.g = array_to_string(w[:c], ' ') JOIN f r ON r.lang = cut.lang AND r.g = array_to_string(w[c + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1),
part AS (
  SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS g FROM (
    SELECT lang, a, w, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT lang, a, k, string_split(g, ' ') AS w, unnest(range(2, k)) AS m FROM f WHERE k > 2))),
longer AS (SELECT lang, g, max(a) AS longer FROM part GROUP BY ALL),
ranked AS (
  SELECT best.*, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, best.g) AS rank
  FROM best LEFT JOIN longer ON longer.lang = best.lang AND longer.g = best.g WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT ranked.lang, rank, g AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN total ON total.lang = ranked.lang WHERE rank <= 2000
"""

ORACLES["op11_block_convolution_runs"] = r"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
crc AS (
  SELECT id, xor(4294967295, list_reduce(
    list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, b: CASE WHEN xor(c, b) % 2 = 1 THEN xor(xor(c, b) // 2, 3988292384) ELSE xor(c, b) // 2 END)) AS h
  FROM d WHERE doc_id IS NOT NULL),
edit AS (
  SELECT id, doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, (h // 10) % greatest(len(w), 1) AS a, (h // 10) % 8 AS g8
  FROM d LEFT JOIN crc USING (id)),
x AS (
  SELECT id, doc_id, n, CASE WHEN planted THEN list_transform(range(0, n), lambda i: w[1 + (CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g8)) END)]) ELSE w END AS w FROM edit),
t AS (SELECT id, n, unnest(range(0, n)) AS i, unnest(w) AS s FROM x),
pair AS (SELECT a.id, b.i - a.i AS q, a.i FROM t a JOIN t b ON a.id = b.id AND a.s = b.s AND b.i > a.i AND 4 * (b.i - a.i) <= a.n),
island AS (SELECT id, q, i, i - row_number() OVER (PARTITION BY id, q ORDER BY i) AS k FROM pair),
cand AS (SELECT id, q, min(i) AS s, min(i) + count(*) + q AS e FROM island GROUP BY id, q, k HAVING count(*) + q >= greatest(6, 4 * q)),
run AS (SELECT * FROM cand c WHERE NOT EXISTS (SELECT 1 FROM cand o WHERE o.id = c.id AND o.q < c.q AND o.s <= c.s AND o.e >= c.e)),
gone AS (SELECT DISTINCT id, unnest(range(s + q, e)) AS i FROM run),
kept AS (SELECT t.id, string_agg(t.s, ' ' ORDER BY t.i) AS c FROM t LEFT JOIN gone ON gone.id = t.id AND gone.i = t.i WHERE gone.i IS NULL GROUP BY t.id),
runs AS (
  SELECT id, count(*) AS n_runs, string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q) AS r,
         min(struct_pack(l := s - e, s := s, q := q)) AS top
  FROM run GROUP BY id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(top.s AS BIGINT) AS start, CAST(-top.l AS BIGINT) AS length, CAST(top.q AS BIGINT) AS period,
       CAST(1000 * -top.l // top.q AS BIGINT) AS exponent_milli, sha256(coalesce(r, '')) AS runs_sha256, sha256(coalesce(c, '')) AS collapsed_sha256
FROM x LEFT JOIN runs ON runs.id = x.id LEFT JOIN kept ON kept.id = x.id
"""


def _risk_rules() -> str:
    from .risk_rules import ERROR_PERCENT, LIFT, RISK_PERCENT, STATISTICS, STEP_PER_10000, STEPS

    duck = {s: e.replace(" div ", " // ") for s, e in STATISTICS.items()}
    steps = range(STEPS + 1)
    values = ", ".join(f"{{'s': '{s}', 'v': {e}}}" for s, e in duck.items())
    cuts = ", ".join(f"min(CASE WHEN good > 0 AND 10000 * below >= {10000 - j * STEP_PER_10000} * all_good THEN v END)" for j in steps)
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(lang, 'und') AS stratum, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT id, i, count(*) OVER (PARTITION BY id, g) AS c FROM (
    SELECT id, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5))),
rep AS (SELECT id, count(*) AS c FROM (SELECT DISTINCT id, unnest(range(i, i + 5)) AS p FROM win WHERE c > 1) GROUP BY id),
line AS (SELECT id, count(*) AS n, count(DISTINCT l) AS u FROM (SELECT id, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY id),
m AS (
  SELECT d.id, doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(line.n - line.u, 0) AS n_dup_lines, coalesce(rep.c, 0) AS n_repeat_words,
         coalesce(line.n, 0) AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals, length(regexp_replace(t, '[^!?]', '', 'g')) AS n_marks
  FROM d LEFT JOIN rep ON rep.id = d.id LEFT JOIN line ON line.id = d.id),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
lab AS (SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
x AS (SELECT id, stratum, good, md5(CAST(b.doc_id AS VARCHAR))[1] >= '8' AS holdout, unnest([{values}]) AS z FROM b JOIN lab ON lab.doc_id = b.doc_id WHERE NOT base_failed),
y AS (SELECT id, stratum, good, holdout, z.s AS s, z.v AS v FROM x),
seen AS (SELECT stratum, s, v, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE NOT good) AS bad FROM y WHERE NOT holdout GROUP BY ALL),
run AS (SELECT *, sum(good) OVER (PARTITION BY stratum, s ORDER BY v) AS below, sum(good) OVER (PARTITION BY stratum, s) AS all_good, sum(bad) OVER (PARTITION BY stratum, s) AS all_bad FROM seen),
last AS (SELECT stratum, s, [{cuts}] AS cuts FROM run GROUP BY ALL),
told AS (
  SELECT run.stratum, run.s, sum(CASE WHEN v > cuts[{STEPS + 1}] THEN bad ELSE 0 END) * max(all_good) AS bad, sum(CASE WHEN v > cuts[{STEPS + 1}] THEN good ELSE 0 END) * max(all_bad) AS good
  FROM run JOIN last ON last.stratum = run.stratum AND last.s = run.s GROUP BY ALL),
ladder AS (SELECT last.stratum, last.s, cuts FROM last JOIN told ON told.stratum = last.stratum AND told.s = last.s WHERE bad > 0 AND bad >= {LIFT} * good),
hold AS (SELECT DISTINCT id, stratum FROM y WHERE holdout AND good),
first AS (
  SELECT hold.id, hold.stratum, coalesce(min(len(list_filter(cuts, lambda c: c >= v))) FILTER (WHERE cuts IS NOT NULL), {STEPS + 1}) AS f
  FROM hold JOIN y ON y.id = hold.id LEFT JOIN ladder ON ladder.stratum = y.stratum AND ladder.s = y.s GROUP BY ALL),
k AS (SELECT stratum, j, count(*) AS n, count(*) FILTER (WHERE f <= j) AS k FROM first, (SELECT unnest(range(0, {STEPS + 1})) AS j) GROUP BY ALL),
test AS (
  SELECT stratum, j, CASE WHEN k >= n THEN 1 ELSE list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({RISK_PERCENT / 100}) + (n - i) * ln({1 - RISK_PERCENT / 100})))) END
    * (SELECT count(DISTINCT stratum) FROM first) <= {ERROR_PERCENT / 100} AS passes FROM k),
fail AS (SELECT stratum, coalesce(min(j) FILTER (WHERE NOT passes), {STEPS + 1}) AS fails FROM test GROUP BY stratum),
cutoff AS (SELECT ladder.stratum, s, cuts[fails] AS c FROM ladder JOIN fail ON fail.stratum = ladder.stratum WHERE fails > 0),
gone AS (SELECT DISTINCT id FROM (SELECT id, stratum, unnest([{values}]) AS z FROM b) q JOIN cutoff ON cutoff.stratum = q.stratum AND cutoff.s = q.z.s WHERE q.z.v > c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND gone.id IS NULL AS kept FROM b LEFT JOIN gone ON gone.id = b.id
"""


ORACLES["op12_risk_controlled_rules"] = _risk_rules()

_LINKED = ORACLES["op6_count_vector_rtree_join"].rpartition("SELECT d.doc_id")[0]
ORACLES["op6_count_vector_rtree_links"] = _LINKED.rstrip() + """,
many AS (SELECT x, count(*) AS c FROM links GROUP BY x)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, coalesce(min(reach.r), d.doc_id) AS component_id, coalesce(any_value(many.c), 0) AS n_links
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach ON reach.doc_id = d.doc_id LEFT JOIN many ON many.x = d.doc_id GROUP BY d.doc_id
"""
