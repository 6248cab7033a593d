"""DuckDB SQL that gives the rows of the catalogue's queries, built on one chain of common table expressions."""

from __future__ import annotations

from recordloom.functions import rules, text

NUMBER = text.NUMBER
JUNK = text.JUNK.replace("'", "''")


def fold(x: str) -> str:
    return f"regexp_replace(strip_accents({x}), '\\p{{Mn}}', '', 'g')"


def base(x: str) -> str:
    x = f"regexp_replace(trim(coalesce({x}, '')), '{JUNK}', '')"
    x = f"lower({fold(f'''replace({x}, '&', ' and ')''')})"
    x = f"regexp_replace({x}, '({NUMBER})', ' \\1 ', 'g')"
    x = f"array_to_string(list_transform(regexp_split_to_array({x}, '\\s+'), lambda t: CASE WHEN regexp_full_match(t, '{NUMBER}') THEN t ELSE regexp_replace(t, '[^\\p{{L}}\\p{{N}}_]', ' ', 'g') END), ' ')"
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


def skeleton(x: str) -> str:
    t = "t"
    for a, b in rules.PHONETIC:
        t = f"replace({t}, '{a}', '{b}')"
    cut = "substr(u, 1, 1) || regexp_replace(substr(u, 2), '[aeiou]', '', 'g')"
    once = "array_to_string(list_transform(list_filter(list_zip(string_split(v, ''), list_prepend('', string_split(v, ''))), lambda z: z[1] <> z[2] AND z[1] IS NOT NULL), lambda z: z[1]), '')"
    return f"array_to_string(list_transform(list_transform(list_transform({words(x)}, lambda t: {t}), lambda u: {cut}), lambda v: {once}), ' ')"


def strip_zeros(x: str) -> str:
    return f"(CASE WHEN regexp_replace({x}, '^0+', '') = '' THEN '0' ELSE regexp_replace({x}, '^0+', '') END)"


def handle(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(regexp_replace({x}, '{text.HANDLE}', ''), '{text.DOMAIN}', ''), '{text.CAMEL}', '\\1 \\2', 'g'))"


_pairs = lambda table: "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in table.items()) + "}"
_forms = sorted(rules.LEGAL_FORMS["generic"].items(), key=lambda kv: -len(kv[0]))
_list = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"

from recordloom.operators.normalize import ANY_NUMBER, LEADING, MARKER  # noqa: E402

RECORDS = f"""
raw AS (SELECT 'S' || (doc_id % 3 + 1) || '-' || doc_id AS entity_id, (doc_id % 3 + 1)::INT AS source, lang AS country,
        trim(split_part(text, chr(10), 1)) AS name_raw, n_chars || ' ' || source AS addr_raw, text FROM documents),
n0 AS (SELECT *, regexp_replace({base('name_raw')}, '^(?:(?:{'|'.join(rules.STRIP_PREFIXES)})(?: |$))+', '') AS nb, {base('addr_raw')} AS addr_norm FROM raw),
n1 AS (SELECT *, list_transform({words('nb')}, lambda t: coalesce(map_extract({_pairs(rules.NAME_ABBREVIATIONS)}, t)[1], t)) AS name_tokens FROM n0),
n2 AS (SELECT *, array_to_string(name_tokens, ' ') AS name_norm FROM n1),
n3 AS (SELECT *, list_reduce(list_prepend({{'at': -1, 'until': -1, 'form': ''}}, list_transform(list_filter([{', '.join(f"{{'f': '{f}', 'form': '{c}'}}" for f, c in _forms)}],
          lambda x: strpos(' ' || name_norm || ' ', ' ' || x.f || ' ') > 0),
          lambda x: {{'at': strpos(' ' || name_norm || ' ', ' ' || x.f || ' ')::INT, 'until': (strpos(' ' || name_norm || ' ', ' ' || x.f || ' ') + length(x.f))::INT, 'form': x.form}})),
          lambda a, m: CASE WHEN a.form = '' OR m.until > a.until OR (m.until = a.until AND m.at < a.at) THEN m ELSE a END) AS best FROM n2),
n4 AS (SELECT *, best.form AS legal_form, CASE WHEN best.form = '' THEN name_norm ELSE trim(trim(substr(name_norm, 1, greatest(best.at - 1, 0))) || ' ' || trim(substr(name_norm, best.until + 1))) END AS name_core,
        {skeleton('name_norm')} AS name_skeleton, regexp_extract(addr_norm, '{MARKER}', 1) AS marked, regexp_extract(addr_norm, '{LEADING}', 1) AS lead_num,
        list_transform(list_transform(regexp_extract_all(addr_norm, '{ANY_NUMBER}'), lambda x: {strip_zeros('x')}), lambda x: regexp_replace(x, '\\s+', '', 'g')) AS addr_nums FROM n3),
n5 AS (SELECT *, CASE WHEN marked <> '' THEN CASE WHEN list_contains({_list(rules.non_house_markers('generic'))}, string_split(trim(substr(addr_norm, 1, greatest(strpos(addr_norm, regexp_extract(addr_norm, '{MARKER}', 0)) - 1, 0))), ' ')[-1]) THEN '' ELSE {strip_zeros("regexp_replace(marked, '\\s+', '', 'g')")} END
        WHEN lead_num <> '' THEN {strip_zeros("regexp_replace(lead_num, '\\s+', '', 'g')")} ELSE '' END AS house_num FROM n4),
n6 AS (SELECT *, list_position(list_transform({words('addr_norm')}, lambda t: {strip_zeros('t')} = house_num OR t = house_num), true) AS house_at FROM n5),
n7 AS (SELECT *, CASE WHEN house_num = '' OR coalesce(house_at, 0) = 0 THEN addr_norm ELSE array_to_string(list_concat(list_slice({words('addr_norm')}, 1, house_at - 1), list_slice({words('addr_norm')}, house_at + 1, len({words('addr_norm')}))), ' ') END AS street0 FROM n6),
nc AS (SELECT country, count(*) AS n FROM raw GROUP BY country),
area0 AS (SELECT country, token, count(DISTINCT entity_id) AS docs FROM (SELECT country, entity_id, unnest(string_split(addr_norm, ' ')) AS token FROM n7) WHERE length(token) > 1 AND NOT regexp_matches(token, '^[0-9]') GROUP BY country, token),
area AS (SELECT area0.country, token, docs FROM area0 JOIN nc USING (country) WHERE docs / n > 0.15),
al AS (SELECT country, list(token) AS tokens FROM area GROUP BY country),
rec AS (SELECT n7.*, 'Latin' AS name_script, CASE WHEN al.tokens IS NULL OR array_to_string(list_filter({words('street0')}, lambda t: NOT list_contains(al.tokens, t)), ' ') = '' THEN street0 ELSE array_to_string(list_filter({words('street0')}, lambda t: NOT list_contains(al.tokens, t)), ' ') END AS addr_street FROM n7 LEFT JOIN al USING (country))"""


def idf(name: str, column: str) -> str:
    return f"""
{name}0 AS (SELECT country, token, count(*) AS df FROM (SELECT country, entity_id, unnest(list_distinct(string_split({column}, ' '))) AS token FROM rec) WHERE token <> '' GROUP BY country, token),
{name} AS (SELECT {name}0.*, ln(n / df) AS idf FROM {name}0 JOIN nc USING (country))"""


def each_token(tokens: str) -> str:
    return f"SELECT country, entity_id, source, unnest({tokens}) AS token, generate_subscripts({tokens}, 1) AS i FROM rec"


def rarest(name: str, tokens: str, table: str, k: int, cap: int | None) -> str:
    """tokens: SQL for a list, or a table of tokens."""
    each = tokens if tokens.startswith("SELECT") else each_token(tokens)
    return f"""
{name} AS (SELECT * FROM (SELECT country, entity_id, source, token, weight, df, row_number() OVER (PARTITION BY country, entity_id ORDER BY weight DESC, i) AS pos FROM (
  SELECT e.country, e.entity_id, e.source, e.token, e.i, coalesce(idf, 10.0) AS weight, coalesce(df, 0) AS df FROM
    ({each}) e
    LEFT JOIN {table} t ON t.country = e.country AND t.token = e.token WHERE length(e.token) >= 2{f' AND coalesce(df, 0) <= {cap}' if cap else ''})) WHERE pos <= {k})"""


_legal = "generic"
from recordloom.operators.blocking import legal_skeletons  # noqa: E402

SKELETON_TOKENS = f"list_filter({words('name_skeleton')}, lambda t: NOT list_contains({_list(legal_skeletons('generic'))}, t))"
STREET_TOKENS = f"CASE WHEN len({words('addr_street')}) > 0 THEN {words('addr_street')} ELSE list_filter({words('addr_norm')}, lambda t: NOT list_contains(addr_nums, t) AND NOT list_contains(addr_nums, regexp_replace(t, '^0+', ''))) END"
CORE_TOKENS = f"list_filter({words('name_core')}, lambda t: length(t) >= 2)"
IDF = ",".join(idf(n, c) for n, c in (("iname", "name_core"), ("iskel", "name_skeleton"), ("iaddr", "addr_norm"), ("ihouse", "house_num")))

KEYS = ",".join([
    f"""
ct AS (SELECT country, entity_id, source, token, min(i) AS i FROM ({each_token(CORE_TOKENS)}) GROUP BY ALL)""",  # the different tokens in their first order
    rarest("ra", words("name_core"), "iname", 3, 2000), rarest("rs", SKELETON_TOKENS, "iskel", 3, 2000), rarest("rb", STREET_TOKENS, "iaddr", 2, None),
    rarest("rd", "SELECT * FROM ct", "iname", 2, None), rarest("re", SKELETON_TOKENS, "iskel", 2, None),
    """
ka1 AS (SELECT country, entity_id, key, max(weight) AS weight FROM (SELECT country, entity_id, token AS key, weight FROM ra WHERE source = 1
        UNION ALL SELECT rs.country, rs.entity_id, rs.token, coalesce(i.idf, rs.weight) FROM rs LEFT JOIN iname i ON i.country = rs.country AND i.token = rs.token WHERE source = 1) GROUP BY country, entity_id, key),
ka2 AS (SELECT country, entity_id, token AS key FROM ra WHERE source <> 1),
kb AS (SELECT rb.country, rb.entity_id, rb.source, m.number || chr(1) || rb.token AS key, rb.weight FROM rb JOIN
       (SELECT DISTINCT entity_id, number FROM (SELECT entity_id, unnest(addr_nums) AS number FROM rec) WHERE number <> '') m ON m.entity_id = rb.entity_id),
kc AS (SELECT rec.country, rec.entity_id, rec.source, house_num AS key, coalesce(idf, 5.0) AS weight FROM rec LEFT JOIN ihouse i ON i.country = rec.country AND i.token = house_num WHERE house_num <> '' AND coalesce(df, 0) <= 50)""",
    f"""
kx AS (SELECT e.country, e.entity_id, e.source, 'core' || chr(1) || e.whole AS key, round(sum(coalesce(idf, 10.0)), 9) AS weight FROM
       (SELECT ct.country, entity_id, ct.source, whole, token FROM ct JOIN (SELECT entity_id, string_agg(token, ' ' ORDER BY token) AS whole FROM ct GROUP BY entity_id) USING (entity_id)) e LEFT JOIN iname i ON i.country = e.country AND i.token = e.token GROUP BY ALL),
kn AS (SELECT country, entity_id, source, token, arg_max(weight, o) AS weight FROM (SELECT country, entity_id, source, token, weight, 0 AS o FROM rd UNION ALL SELECT country, entity_id, source, token, weight, 1 FROM re WHERE source = 1) GROUP BY country, entity_id, source, token),
kd AS (SELECT * FROM kx UNION ALL SELECT kn.country, kn.entity_id, kn.source, kn.token || chr(1) || rb.token, kn.weight + rb.weight FROM kn JOIN rb ON rb.entity_id = kn.entity_id AND rb.country = kn.country)""",
])


def probe(name: str, index: str, queries: str, top: int | None, cap: int | None) -> str:
    kept = f"SELECT * FROM ({index}) QUALIFY count(*) OVER (PARTITION BY country, key) <= {cap}" if cap else index
    best = f" QUALIFY row_number() OVER (PARTITION BY country, cand_id ORDER BY score DESC, s1_id) <= {top}" if top else ""
    return f"""
{name} AS (SELECT * FROM (SELECT q.country, q.entity_id AS cand_id, x.entity_id AS s1_id, round(sum(x.weight), 9) AS score FROM ({queries}) q JOIN ({kept}) x ON x.country = q.country AND x.key = q.key GROUP BY q.country, q.entity_id, x.entity_id){best})"""


_of = lambda t, s: f"SELECT country, entity_id, key, weight FROM {t} WHERE source {s} 1"
PASSES = ",".join([
    probe("pa", "SELECT * FROM ka1", "SELECT * FROM ka2", 50, None), probe("pb", _of("kb", "="), _of("kb", "<>"), 50, 50),
    probe("pc", _of("kc", "="), _of("kc", "<>"), None, None), probe("pd", _of("kd", "="), _of("kd", "<>"), 50, 50),
])
MERGED = """
hits AS (SELECT *, 0 AS bit FROM pa UNION ALL SELECT *, 1 FROM pb UNION ALL SELECT *, 2 FROM pc UNION ALL SELECT *, 3 FROM pd),
merged AS (SELECT country, s1_id, cand_id, bit_or(1 << bit)::INT AS block_mask, round(sum(CASE WHEN m = 0 THEN 0.0 ELSE score / m END), 9) AS block_score
  FROM (SELECT *, max(score) OVER (PARTITION BY country, bit) AS m FROM hits) GROUP BY country, s1_id, cand_id),
ranked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cand_id ORDER BY block_score DESC, s1_id)::INT AS rank_in_cand FROM merged) WHERE rank_in_cand <= 5),
pairs AS (SELECT * FROM ranked WHERE rank_in_cand <= 2 QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY block_score DESC, cand_id) <= 50),
scores AS (SELECT s1_id, cand_id, block_score, round(block_score / 4, 9) AS p FROM pairs)"""
TRUTH = """
one AS (SELECT country, text, min(entity_id) AS s1_id FROM raw WHERE source = 1 GROUP BY country, text),
truth AS (SELECT one.s1_id, raw.entity_id AS match_id FROM raw JOIN one USING (country, text) WHERE raw.source <> 1),
s1 AS (SELECT entity_id AS s1_id, country FROM raw WHERE source = 1),
ngt AS (SELECT s1_id, count(*) AS n_gt FROM truth GROUP BY s1_id)"""
DECIDED = """
assigned AS (SELECT s1_id, cand_id, p FROM scores QUALIFY row_number() OVER (PARTITION BY cand_id ORDER BY p DESC, block_score DESC, s1_id) = 1),
matches AS (SELECT * FROM assigned WHERE p >= 0.5),
f05 AS (SELECT s1_id, country, n_pred, n_gt, tp, CASE WHEN n_pred = 0 AND n_gt = 0 THEN 1.0 WHEN tp = 0 THEN 0.0 ELSE 1.25 * (tp / n_pred) * (tp / n_gt) / (0.25 * (tp / n_pred) + tp / n_gt) END AS f05 FROM
  (SELECT s1.s1_id, country, coalesce(a.n, 0) AS n_pred, coalesce(n_gt, 0) AS n_gt, coalesce(a.tp, 0) AS tp FROM s1
   LEFT JOIN (SELECT m.s1_id, count(*) AS n, count(t.match_id) AS tp FROM matches m LEFT JOIN truth t ON t.s1_id = m.s1_id AND t.match_id = m.cand_id GROUP BY m.s1_id) a USING (s1_id) LEFT JOIN ngt USING (s1_id)))"""
SIDES = """
sd AS (SELECT p.*, a.name_core AS a_name_core, b.name_core AS b_name_core, a.addr_street AS a_street, b.addr_street AS b_street, a.house_num AS a_house, b.house_num AS b_house,
  a.legal_form AS a_legal, b.legal_form AS b_legal, a.name_skeleton AS a_skel, b.name_skeleton AS b_skel, b.source AS b_source FROM pairs p JOIN rec a ON a.entity_id = p.s1_id JOIN rec b ON b.entity_id = p.cand_id)"""
once = lambda x: f"list_distinct({words(x)})"
FOUND = "found AS (SELECT t.s1_id, t.match_id, p.cand_id IS NOT NULL AS found, coalesce(block_mask, 0) AS block_mask FROM truth t LEFT JOIN pairs p ON p.s1_id = t.s1_id AND p.cand_id = t.match_id)"
ERRORS = """
allp AS (SELECT s1_id, cand_id FROM matches UNION SELECT s1_id, match_id FROM truth),
err AS (SELECT x.s1_id, x.cand_id, p.p, o.gt_owner, g.assigned_to, CASE WHEN m.s1_id IS NOT NULL AND t.s1_id IS NOT NULL THEN 'TP' WHEN m.s1_id IS NOT NULL THEN 'FP' WHEN p.s1_id IS NULL THEN 'FN_blocking' ELSE 'FN_model' END AS kind
  FROM allp x LEFT JOIN matches m ON m.s1_id = x.s1_id AND m.cand_id = x.cand_id LEFT JOIN truth t ON t.s1_id = x.s1_id AND t.match_id = x.cand_id LEFT JOIN scores p ON p.s1_id = x.s1_id AND p.cand_id = x.cand_id
  LEFT JOIN (SELECT match_id AS cand_id, min(s1_id) AS gt_owner FROM truth GROUP BY 1) o ON o.cand_id = x.cand_id LEFT JOIN (SELECT cand_id, min(s1_id) AS assigned_to FROM matches GROUP BY 1) g ON g.cand_id = x.cand_id)"""

R, RI = [RECORDS], [RECORDS, IDF]
RK = [RECORDS, IDF, KEYS]
RP = [*RK, PASSES]
RM = [*RP, MERGED]
RT = [RECORDS, TRUTH]
RMT = [*RM, TRUTH]
RD = [*RMT, DECIDED]
RS = [*RM, SIDES]
GRID = "[" + ", ".join(f"{i * 5 / 100}" for i in range(1, 20)) + "]"

_idf_x = """
xi0 AS (SELECT country, token, count(*) AS df FROM (SELECT country, unnest(list_distinct(list_filter(string_split(name_core, ' '), lambda t: t <> ''))) AS token FROM rec) GROUP BY ALL), xi AS (SELECT xi0.country, token, ln(n / df) AS idf FROM xi0 JOIN nc USING (country)),
xs AS (SELECT s1_id, cand_id, round(coalesce(sum(idf), 0), 9) AS x_sum, round(min(idf), 9) AS x_min, round(avg(idf), 9) AS x_mean FROM
 (SELECT sd.s1_id, sd.cand_id, i.idf FROM (SELECT s1_id, cand_id, country, unnest({list}) AS token FROM sd) sd LEFT JOIN xi i ON i.country = sd.country AND i.token = sd.token) GROUP BY ALL)"""
_only = lambda x, y: f"list_filter({once(x)}, lambda t: NOT list_contains({once(y)}, t))"
_both = f"list_filter({once('a_name_core')}, lambda t: list_contains({once('b_name_core')}, t))"
_digits = lambda c: f"regexp_extract(lower(trim({c})), '^([0-9]+)', 1)"


def _house() -> str:
    parts = ", ".join(f"lower(trim({s}_house)) AS f{s}, CASE WHEN {_digits(s + '_house')} <> '' THEN {strip_zeros(_digits(s + '_house'))} END AS b{s}, regexp_replace(regexp_replace(lower(trim({s}_house)), '^[0-9]+', ''), '[^0-9a-z]', '', 'g') AS s{s}" for s in "ab")
    swap = " OR ".join(f"substr(ba, 1, {i}) || substr(ba, {i + 2}, 1) || substr(ba, {i + 1}, 1) || substr(ba, {i + 3}) = bb" for i in range(9))
    drop = " OR ".join(f"{strip_zeros(f'(substr(big, 1, {i}) || substr(big, {i + 2}))')} = small" for i in range(10))
    return f"""h AS (SELECT *, CASE WHEN length(ba) > length(bb) THEN ba ELSE bb END AS big, CASE WHEN length(ba) > length(bb) THEN bb ELSE ba END AS small, try_cast(ba AS BIGINT) AS na, try_cast(bb AS BIGINT) AS nb FROM (SELECT s1_id, cand_id, {parts} FROM sd)),
hc AS (SELECT s1_id, cand_id, hn_rel::INT AS hn_rel, (hn_rel >= 6)::INT AS hn_conflict, hn_diff, hn_rel_diff FROM (SELECT s1_id, cand_id, CASE WHEN fa = '' AND fb = '' THEN 0 WHEN fa = '' OR fb = '' THEN 1 WHEN fa = fb OR (ba = bb AND sa = sb) THEN 2 WHEN ba = bb THEN 3
 WHEN length(ba) = length(bb) AND ({swap}) THEN 4 WHEN {drop} THEN 5 WHEN abs(na - nb) <= 50 THEN 6 ELSE 7 END AS hn_rel, abs(na - nb) AS hn_diff,
 CASE WHEN greatest(na, nb) > 0 THEN round(abs(na - nb) / greatest(na, nb), 9) END AS hn_rel_diff FROM h))"""


def sql(ctes: list[str], select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


from recordloom.operators.profile import FLAGS  # noqa: E402

_scripts = "Latin"
_script_counts = ", ".join(f"len(regexp_extract_all(text, '[{span.replace(chr(92) + 'u', chr(92) + 'x{').replace('-', '}-')}}}]')) AS c{i}" for i, (_, span) in enumerate(rules.SCRIPTS))
_md5 = lambda c: f"md5({c} || '|42')"
_sub = f"""sampled AS (SELECT s1_id FROM (SELECT s1_id, country, row_number() OVER (PARTITION BY country ORDER BY {_md5('s1_id')}, s1_id) AS i, count(*) OVER (PARTITION BY country) AS n FROM s1) WHERE i <= greatest(round_even(n * 0.1, 0), 1)),
world AS (SELECT entity_id, substr(entity_id, 2, 1)::INT AS source, arg_min(role, o) AS role FROM (SELECT s1_id AS entity_id, 0 AS o, 's1' AS role FROM sampled UNION ALL SELECT match_id, 1, 'match' FROM truth SEMI JOIN sampled USING (s1_id)
 UNION ALL SELECT cand_id, 2, 'decoy' FROM (SELECT * FROM pairs WHERE rank_in_cand = 1) p SEMI JOIN sampled USING (s1_id) WHERE cand_id NOT IN (SELECT match_id FROM truth)) GROUP BY ALL)"""
_sub = _sub.replace("GROUP BY ALL)", "GROUP BY entity_id)")
_curve = f"""g AS (SELECT s1.s1_id, country, t FROM s1, (SELECT unnest({GRID}) AS t)),
cp AS (SELECT a.s1_id, g.t, count(*) AS n_pred, count(tr.match_id) AS tp FROM assigned a JOIN g ON g.s1_id = a.s1_id AND a.p >= g.t LEFT JOIN truth tr ON tr.s1_id = a.s1_id AND tr.match_id = a.cand_id GROUP BY a.s1_id, g.t),
cf AS (SELECT t, country, n_pred, CASE WHEN n_pred = 0 AND n_gt = 0 THEN 1.0 WHEN tp = 0 THEN 0.0 ELSE 1.25 * (tp / n_pred) * (tp / n_gt) / (0.25 * (tp / n_pred) + tp / n_gt) END AS f FROM
 (SELECT g.t, g.country, coalesce(n_pred, 0) AS n_pred, coalesce(tp, 0) AS tp, coalesce(n_gt, 0) AS n_gt FROM g LEFT JOIN cp ON cp.s1_id = g.s1_id AND cp.t = g.t LEFT JOIN ngt ON ngt.s1_id = g.s1_id)),
curve AS (SELECT t, coalesce(country, 'ALL') AS country, round(sum(f) / count(*), 9) AS macro_f05, sum(n_pred)::BIGINT AS pred_pairs FROM cf GROUP BY GROUPING SETS ((t, country), (t)))"""
_pick = """tk AS (SELECT s1_id, list(cand_id ORDER BY p DESC, cand_id) AS c, list(p ORDER BY p DESC, cand_id) AS ps FROM (SELECT * FROM assigned QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY p DESC, cand_id) <= 15) GROUP BY s1_id),
te AS (SELECT s1_id, c, ps, unnest(range(1, len(ps) + 1)) AS k FROM tk),
tv AS (SELECT s1_id, k, 1.25 * list_sum(list_slice(ps, 1, k)) / (0.25 * list_sum(ps) + k) AS e, list_product(list_transform(ps, lambda x: 1 - x)) AS e0 FROM te),
td AS (SELECT s1_id, k, e - coalesce(lag(e) OVER (PARTITION BY s1_id ORDER BY k), e0) > 0 AS grows FROM tv),
ts AS (SELECT s1_id, coalesce(min(k) FILTER (WHERE NOT grows) - 1, max(k)) AS n FROM td GROUP BY s1_id)"""
_house_rel = "CASE WHEN x = '' AND y = '' THEN 'both_missing' WHEN x = '' OR y = '' THEN 'one_missing' WHEN x = y THEN 'equal' ELSE 'different' END"
_num = lambda c: f"try_cast(nullif(regexp_extract({c}, '([0-9]+)', 1), '') AS BIGINT)"
_rich = f"""rich AS (SELECT err.*, {_house_rel} AS hn_rel, abs({_num('x')} - {_num('y')}) AS hn_diff, CASE WHEN coalesce(n_gt, 0) >= 4 THEN '4+' ELSE coalesce(n_gt, 0)::VARCHAR END AS s1_bucket, country FROM
 (SELECT err.*, regexp_replace(a.house_num, '^0+', '') AS x, regexp_replace(b.house_num, '^0+', '') AS y, a.country FROM err LEFT JOIN rec a ON a.entity_id = err.s1_id LEFT JOIN rec b ON b.entity_id = err.cand_id) err LEFT JOIN ngt USING (s1_id))"""
_near = lambda q, n: f"list_sort(list(n_cand))[(floor((count(*) - 1) * {q} + 0.5) + 1)::INT]::DOUBLE AS {n}"

ORACLE_SQL: dict[str, str] = {
    "accent_fold": f"SELECT conv_id, turn, {fold('text')} AS folded FROM conversations",
    "base_normalize": sql([RECORDS.split(",\nn1 AS")[0]], f"SELECT entity_id, {base('name_raw')} AS name_base FROM raw"),
    "name_skeleton": sql([RECORDS.split(",\nn1 AS")[0]], f"SELECT entity_id, {skeleton(base('name_raw'))} AS skeleton FROM raw"),
    "strip_handle": f"WITH h AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS x FROM pages) SELECT page_id, {handle('x')} AS words, regexp_matches(trim(x), '{text.HANDLE}') OR regexp_matches(trim(x), '{text.DOMAIN}') OR (NOT regexp_matches(trim(x), '\\s') AND regexp_matches(trim(x), '{text.CAMEL}')) AS handle, trim(regexp_replace(lower({handle('x')}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS cleaned FROM h",
    "script_detect": f"WITH c AS (SELECT conv_id, turn, {_script_counts}, len(regexp_extract_all(text, '\\p{{L}}')) - len(regexp_extract_all(text, '[A-Za-z\\x{{00AA}}-\\x{{024F}}\\x{{1E00}}-\\x{{1EFF}}]')) AS other FROM conversations) SELECT conv_id, turn, CASE WHEN " + " WHEN ".join(f"c{i} > 0 THEN '{n}'" for i, (n, _) in enumerate(rules.SCRIPTS)) + " WHEN other > 0 THEN 'Other' ELSE 'Latin' END AS script FROM c",
    "legal_form": sql(R, "SELECT entity_id, name_norm, name_core, legal_form FROM rec"),
    "house_number": sql(R, "SELECT entity_id, house_num FROM rec"),
    "addr_nums": sql(R, "SELECT entity_id, array_to_string(addr_nums, ',') AS addr_nums FROM rec"),
    "area_tokens": sql(R, "SELECT country, token, docs FROM area"),
    "area_token_removal": sql(R, "SELECT entity_id, addr_norm, addr_street FROM rec"),
    "token_df": sql(RI, "SELECT country, token, df FROM iname"),
    "token_idf": sql(RI, "SELECT country, token, round(idf, 9) AS idf FROM iname"),
    "name_freq": sql(R, "SELECT country, name_core, count(*) AS name_freq FROM rec GROUP BY ALL"),
    "rarest_tokens": sql(RK, "SELECT entity_id, pos::INT AS pos, token, round(weight, 9) AS weight FROM ra"),
    "pair_keys": sql([*RI, rarest("rp", words("name_core"), "iname", 3, None)], "SELECT DISTINCT a.entity_id, least(a.token, b.token) || '|' || greatest(a.token, b.token) AS key, round(a.weight + b.weight, 9) AS weight FROM rp a JOIN rp b ON a.entity_id = b.entity_id AND a.pos < b.pos WHERE a.df > 20 OR b.df > 20"),
    **{n: sql(RP, f"SELECT country, cand_id, s1_id, score FROM {p}") for n, p in (("block_name", "pa"), ("block_address", "pb"), ("block_house", "pc"), ("block_combo", "pd"))},
    "merge_passes": sql(RM, "SELECT country, s1_id, cand_id, block_mask, block_score FROM merged"),
    "rank_per_cand": sql(RM, "SELECT s1_id, cand_id, rank_in_cand FROM ranked"),
    "cap_per_s1": sql(RM, "SELECT s1_id, cand_id FROM ranked QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY block_score DESC, cand_id) <= 3"),
    "feat_context": sql(RM, """SELECT s1_id, cand_id, block_score, rank_in_cand, """ + ", ".join(f"((block_mask >> {i}) & 1)::INT AS pass_{i}" for i in range(8)) + """, round(block_score - CASE WHEN rc = 1 THEN second ELSE best END, 9) AS gap_other_s1, n_s1_for_cand, cand_rank_in_s1, n_cands_s1, round(bs - block_score, 9) AS gap_to_s1_best FROM (SELECT *, row_number() OVER c AS rc, nth_value(block_score, 2) OVER (PARTITION BY cand_id ORDER BY block_score DESC, s1_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second, max(block_score) OVER (PARTITION BY cand_id) AS best, (count(*) OVER (PARTITION BY cand_id))::INT AS n_s1_for_cand, (row_number() OVER s)::INT AS cand_rank_in_s1, (count(*) OVER (PARTITION BY s1_id))::INT AS n_cands_s1, max(block_score) OVER (PARTITION BY s1_id) AS bs FROM pairs WINDOW c AS (PARTITION BY cand_id ORDER BY block_score DESC, s1_id), s AS (PARTITION BY s1_id ORDER BY block_score DESC, cand_id))"""),
    "idf_stats": sql([*RS, _idf_x.replace("{list}", once("a_name_core"))], "SELECT p.s1_id, p.cand_id, coalesce(x_sum, 0.0) AS x_sum, x_min, x_mean FROM pairs p LEFT JOIN xs USING (s1_id, cand_id)"),
    "feat_token_diff": sql([*RS, _idf_x.replace("{list}", _only("a_name_core", "b_name_core")), _idf_x.replace("{list}", _only("b_name_core", "a_name_core")).replace("xi0", "yi0").replace("xi ", "yi ").replace("xs ", "ys ")], f"SELECT sd.s1_id, sd.cand_id, len({_only('a_name_core', 'b_name_core')})::INT AS name_only_a, len({_only('b_name_core', 'a_name_core')})::INT AS name_only_b, coalesce(xs.x_sum, 0.0) AS name_extra_idf_a, coalesce(ys.x_sum, 0.0) AS name_extra_idf_b, (len({_only('a_name_core', 'b_name_core')}) + len({_only('b_name_core', 'a_name_core')}) = 1 AND len({_both}) > 0)::INT AS name_one_extra FROM sd LEFT JOIN xs USING (s1_id, cand_id) LEFT JOIN ys USING (s1_id, cand_id)"),
    "feat_house_relation": sql([*RS, _house()], "SELECT s1_id, cand_id, hn_rel, hn_conflict, hn_diff, hn_rel_diff FROM hc"),
    "feat_legal_relation": sql(RS, "SELECT s1_id, cand_id, CASE WHEN a_legal = '' AND b_legal = '' THEN 2 WHEN a_legal = '' OR b_legal = '' THEN 1 WHEN a_legal = b_legal THEN 0 ELSE 3 END::INT AS legal_rel FROM sd"),
    "feat_length_script": sql(RS, "SELECT s1_id, cand_id, 0 AS s1_script, 0 AS cand_script, 1 AS same_script, (b_source = 3)::INT AS is_s3, " + ", ".join(f"CASE WHEN greatest(length(a_{c}), length(b_{c})) > 0 THEN round(least(length(a_{c}), length(b_{c})) / greatest(length(a_{c}), length(b_{c})), 9) END AS {n}_len_ratio" for n, c in (("name", "name_core"), ("street", "street"))) + " FROM sd"),
    "feat_rarity": sql([*RS, _idf_x.replace("{list}", _both), "nf AS (SELECT country, name_core, count(*) AS f FROM rec GROUP BY ALL)"], "SELECT sd.s1_id, sd.cand_id, x_min AS shared_idf_min, x_mean AS shared_idf_mean, round(ln(1 + a.f), 9) AS a_name_freq_log, round(ln(1 + b.f), 9) AS b_name_freq_log FROM sd LEFT JOIN xs USING (s1_id, cand_id) LEFT JOIN nf a ON a.country = sd.country AND a.name_core = a_name_core LEFT JOIN nf b ON b.country = sd.country AND b.name_core = b_name_core"),
    # DuckDB compares bytes; the one letter of two bytes that folding leaves becomes one that names never have
    "feat_jaro_winkler": sql(RS, "SELECT s1_id, cand_id, CASE WHEN a_name_core = b_name_core THEN 1.0 WHEN a_name_core = '' OR b_name_core = '' THEN 0.0 ELSE round(jaro_winkler_similarity(translate(a_name_core, 'ß', '#'), translate(b_name_core, 'ß', '#')), 9) END AS similarity FROM sd"),
    "folds": sql(RT, f"SELECT s1_id, ((row_number() OVER (PARTITION BY country, least(n_matches, 5) ORDER BY {_md5('s1_id')}, s1_id) - 1) % 5)::INT AS fold, country, n_matches FROM (SELECT s1.*, coalesce(n_gt, 0)::INT AS n_matches FROM s1 LEFT JOIN ngt USING (s1_id))"),
    "subworld": sql([*RMT, _sub], "SELECT entity_id, source, role FROM world"),
    "subworld_candidates": sql([*RMT, _sub], "SELECT s1_id, cand_id FROM pairs SEMI JOIN sampled USING (s1_id) WHERE cand_id IN (SELECT entity_id FROM world WHERE role <> 's1')"),
    "density": sql([*RMT, _sub], "SELECT r.country, full_s23_per_s1, world_s23_per_s1, world_s1, world_matches, world_decoys FROM (SELECT country, round(count(*) FILTER (WHERE source > 1) / nullif(count(*) FILTER (WHERE source = 1), 0), 9) AS full_s23_per_s1 FROM raw GROUP BY country) r LEFT JOIN (SELECT country, round(count(*) FILTER (WHERE w.source > 1) / nullif(count(*) FILTER (WHERE w.source = 1), 0), 9) AS world_s23_per_s1, count(*) FILTER (WHERE role = 's1') AS world_s1, count(*) FILTER (WHERE role = 'match') AS world_matches, count(*) FILTER (WHERE role = 'decoy') AS world_decoys FROM world w JOIN raw USING (entity_id) GROUP BY country) w USING (country)"),
    "assign_one_to_one": sql(RD, "SELECT s1_id, cand_id, p FROM assigned"),
    "select_threshold": sql(RD, "SELECT s1_id, cand_id, p FROM matches"),
    "select_ef05_approx": sql([*RD, _pick], "SELECT te.s1_id, te.c[te.k] AS cand_id, te.ps[te.k] AS p FROM te JOIN ts USING (s1_id) WHERE te.k <= ts.n"),
    "threshold_curve": sql([*RD, _curve], "SELECT t::DOUBLE AS t, country, macro_f05, pred_pairs FROM curve"),
    "best_threshold": sql([*RD, _curve], "SELECT t::DOUBLE AS t, macro_f05 FROM curve WHERE country = 'ALL' ORDER BY macro_f05 DESC, t DESC LIMIT 1"),
    "gt_long": sql(RT, "SELECT s1_id, match_id FROM truth"),
    "per_entity_f05": sql(RD, "SELECT s1_id, country, n_pred, n_gt, tp, round(f05, 9) AS f05 FROM f05"),
    "macro_f05": sql(RD, "SELECT round(avg(f05), 9) AS macro_f05, count(*) AS n_s1 FROM f05"),
    "macro_f05_by": sql(RD, "SELECT country, round(avg(f05), 9) AS macro_f05, count(*) AS n_s1, round(avg((n_gt = 0)::INT), 9) AS singleton_share FROM f05 GROUP BY country"),
    "s1_groups": sql(RT, "SELECT s1_id, country, CASE WHEN n_gt IS NULL THEN 'singleton' ELSE 'latin' END AS script FROM s1 LEFT JOIN ngt USING (s1_id)"),
    "blocking_summary": sql([*RMT, FOUND, "per AS (SELECT s1.s1_id, c.country, coalesce(n, 0) AS n_cand FROM s1 LEFT JOIN (SELECT s1_id, count(*) AS n FROM pairs GROUP BY s1_id) USING (s1_id), LATERAL (SELECT unnest([s1.country, 'ALL']) AS country) c)", "fc AS (SELECT f.*, c.country FROM found f JOIN s1 USING (s1_id), LATERAL (SELECT unnest([s1.country, 'ALL']) AS country) c)", "sp AS (SELECT country, count(*) FILTER (WHERE source = 1) * count(*) FILTER (WHERE source > 1) AS space FROM raw GROUP BY country)"], f"SELECT country, n_s1, pairs, cand_mean, cand_p50, cand_p95, gt_pairs, pair_recall, full_gt_covered, round(1 - pairs / space, 9) AS reduction_ratio FROM (SELECT country, count(*) AS n_s1, sum(n_cand)::BIGINT AS pairs, round(avg(n_cand), 9) AS cand_mean, {_near(0.5, 'cand_p50')}, {_near(0.95, 'cand_p95')} FROM per GROUP BY country) LEFT JOIN (SELECT country, count(*) AS gt_pairs, round(avg(found::INT), 9) AS pair_recall FROM fc GROUP BY country) USING (country) LEFT JOIN (SELECT country, round(avg(a::INT), 9) AS full_gt_covered FROM (SELECT country, s1_id, bool_and(found) AS a FROM fc GROUP BY country, s1_id) GROUP BY country) USING (country) LEFT JOIN (SELECT country, space FROM sp UNION ALL SELECT 'ALL', sum(space) FROM sp) USING (country)"),
    "blocking_by_script": sql([*RMT, FOUND], "SELECT country, 'Latin' AS name_script, count(*) AS gt_pairs, round(avg(found::INT), 9) AS pair_recall FROM found JOIN raw ON entity_id = match_id GROUP BY country"),
    "blocking_by_pass": sql([*RMT, FOUND], "SELECT bit, pass, pairs, round(coalesce(h, 0) / greatest(n, 1), 9) AS recall, round(coalesce(u, 0) / greatest(n, 1), 9) AS unique_recall FROM (SELECT unnest(range(0, 5))::INT AS bit, unnest(['name_token', 'addr_key', 'house_num', 'name_street', 'fuzzy']) AS pass) b, LATERAL (SELECT count(*) AS pairs FROM pairs WHERE block_mask & (1 << b.bit) <> 0) p, LATERAL (SELECT count(*) AS h, count(*) FILTER (WHERE block_mask = 1 << b.bit) AS u FROM found WHERE found AND block_mask & (1 << b.bit) <> 0) f, (SELECT count(*) AS n FROM truth) t WHERE pairs > 0"),
    "recall_at_k": sql(RMT, "SELECT k::INT AS k, round(avg((coalesce(rank_in_cand, 1000000) <= k)::INT), 9) AS recall FROM truth t LEFT JOIN ranked r ON r.s1_id = t.s1_id AND r.cand_id = t.match_id, (SELECT unnest([1, 2, 3, 5]) AS k) GROUP BY k"),
    "decoy_load": sql(RMT, "SELECT country, count(*) AS unmatched, round(avg(coalesce(n, 0)), 9) AS s1_kept FROM raw LEFT JOIN (SELECT cand_id, count(*) AS n FROM pairs GROUP BY cand_id) p ON cand_id = entity_id WHERE source <> 1 AND entity_id NOT IN (SELECT match_id FROM truth) GROUP BY country"),
    "missed_pairs": sql(RMT, "SELECT s1_id, match_id, CASE WHEN EXISTS (SELECT 1 FROM merged m WHERE m.s1_id = t.s1_id AND m.cand_id = t.match_id) THEN 'ranked out' ELSE 'not retrieved' END AS reason FROM truth t WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM ranked QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY block_score DESC, cand_id) = 1) p WHERE p.s1_id = t.s1_id AND p.cand_id = t.match_id)"),
    "error_classes": sql([*RD, ERRORS, _rich], "SELECT s1_id, cand_id, kind, p, gt_owner, assigned_to, hn_rel, hn_diff, s1_bucket FROM rich"),
    "error_summary": sql([*RD, ERRORS, _rich], "SELECT country, " + ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS \"{k}\"" for k in ("TP", "FP", "FN_blocking", "FN_model")) + ", count(*) FILTER (WHERE kind IN ('FN_blocking', 'FN_model')) AS \"FN\" FROM rich GROUP BY country"),
    "ingest_checks": sql([RECORDS.split(",\nn1 AS")[0]], "SELECT count(*) AS rows, coalesce(sum((entity_id IS NULL)::INT + (name_raw IS NULL)::INT + (addr_raw IS NULL)::INT + (country IS NULL)::INT), 0)::BIGINT AS nulls, count(*) FILTER (WHERE contains(country, chr(13))) AS carriage_returns FROM raw"),
    "submission_lists": sql(RD, "SELECT s1.s1_id, coalesce(string_agg(cand_id, ',' ORDER BY cand_id), '') AS ids FROM s1 LEFT JOIN matches USING (s1_id) GROUP BY s1.s1_id"),
    "submission_checks": sql([*RD, "top AS (SELECT s1_id, cand_id FROM pairs WHERE rank_in_cand = 1)", "valid AS (SELECT entity_id AS cand_id FROM raw WHERE source <> 1)"], " UNION ALL ".join(f"SELECT '{n}: {rule}' AS rule, count(*) AS rows FROM ({q})" for n, t in (("matches", "matches"), ("candidates", "top")) for rule, q in {"repeated pairs": f"SELECT s1_id, cand_id FROM {t} GROUP BY ALL HAVING count(*) > 1", "ids of another form": f"SELECT 1 FROM {t} WHERE NOT regexp_matches(cand_id, '^S[23]-[^\\s,]+$')", "unknown S1 ids": f"SELECT 1 FROM {t} ANTI JOIN s1 USING (s1_id)", "unknown candidate ids": f"SELECT 1 FROM {t} ANTI JOIN valid USING (cand_id)", **({"not among candidates": "SELECT 1 FROM matches ANTI JOIN top USING (s1_id, cand_id)"} if n == "matches" else {})}.items())),
    "eda_profile": sql([RECORDS.split(",\nn1 AS")[0]], "SELECT country, source, count(*) AS rows, round(avg((trim(name_raw) = '')::INT), 9) AS name_empty, round(avg(length(name_raw)), 9) AS name_chars, max(length(name_raw))::INT AS name_chars_max, " + ", ".join(f"round(avg(regexp_matches({c}, '{p}')::INT), 9) AS {n}" for n, c, p in FLAGS) + " FROM raw GROUP BY country, source"),
    "eda_top_tokens": sql(R, "SELECT country, token, n, i::INT AS i FROM (SELECT country, token, count(*) AS n, row_number() OVER (PARTITION BY country ORDER BY count(*) DESC, token) AS i FROM (SELECT country, unnest(list_distinct(list_filter(string_split(name_norm, ' '), lambda t: t <> ''))) AS token FROM rec) GROUP BY country, token) WHERE i <= 10"),
    "eda_match_histogram": sql(RT, "SELECT country, coalesce(n_gt, 0) AS n_matches, count(*) AS n_s1 FROM s1 LEFT JOIN ngt USING (s1_id) GROUP BY ALL"),
    "eda_crosstab": sql(RT, "SELECT country, count(*) FILTER (WHERE k = 'none') AS \"none\", count(*) FILTER (WHERE k = 's2') AS s2, count(*) FILTER (WHERE k = 's3') AS s3, count(*) FILTER (WHERE k = 'both') AS \"both\" FROM (SELECT country, CASE WHEN a IS NULL THEN 'none' WHEN a AND b THEN 'both' WHEN a THEN 's2' ELSE 's3' END AS k FROM s1 LEFT JOIN (SELECT s1_id, bool_or(match_id LIKE 'S2-%') AS a, bool_or(match_id LIKE 'S3-%') AS b FROM truth GROUP BY s1_id) USING (s1_id)) GROUP BY country"),
    "eda_one_to_one": sql(RT, "SELECT country, count(*) AS rows, count(n) AS matched, count(*) FILTER (WHERE n > 1) AS several FROM raw LEFT JOIN (SELECT match_id, count(DISTINCT s1_id) AS n FROM truth GROUP BY match_id) ON match_id = entity_id WHERE source <> 1 GROUP BY country"),
    "eda_pair_noise": sql(RT, f"SELECT country, {_house_rel} AS hn_rel, count(*) AS pairs, round(avg(ne::INT), 9) AS name_equal, round(avg(ae::INT), 9) AS addr_equal, round(avg(share), 9) AS token_share FROM (SELECT a.country, regexp_replace(a.house_num, '^0+', '') AS x, regexp_replace(b.house_num, '^0+', '') AS y, a.name_raw = b.name_raw AS ne, a.addr_raw = b.addr_raw AS ae, len(list_intersect({once('a.name_core')}, {once('b.name_core')})) / nullif(len(list_distinct(list_concat({once('a.name_core')}, {once('b.name_core')}))), 0) AS share FROM truth t JOIN rec a ON a.entity_id = t.s1_id JOIN rec b ON b.entity_id = t.match_id) GROUP BY ALL"),
    "eda_nn_scan": sql([*RT, f"tk AS (SELECT source, country, entity_id, len({once('name_core')}) AS n, unnest({once('name_core')}) AS token FROM rec)"], "SELECT cand_id, s1_id, similarity FROM (SELECT b.entity_id AS cand_id, a.entity_id AS s1_id, round(count(*) / (any_value(a.n) + any_value(b.n) - count(*)), 9) AS similarity FROM tk b JOIN tk a ON a.country = b.country AND a.token = b.token WHERE b.source <> 1 AND a.source = 1 GROUP BY 1, 2) x WHERE NOT EXISTS (SELECT 1 FROM truth t WHERE t.s1_id = x.s1_id AND t.match_id = x.cand_id) QUALIFY row_number() OVER (PARTITION BY cand_id ORDER BY similarity DESC, s1_id) = 1"),
}


#: What carries of an adder look ahead by.
POWERS = "[" + ", ".join(str(1 << i) for i in range(17)) + "]"


def _long_lcs(a: str, b: str) -> str:
    """SQL for the longest common subsequence of two columns of up to 131,072 characters, from strings of bits; they have no
    sum, so its carries are looked ahead."""
    zero = f"repeat('0', length({a}))::BIT"
    masks = f"map_from_entries(list_transform(list_distinct(string_split({a}, '')), lambda zc: (zc, array_to_string(list_transform(string_split({a}, ''), lambda zx: CASE WHEN zx = zc THEN '1' ELSE '0' END), '')::BIT)))"
    carry = "list_reduce(list_prepend({'g': zv & zm, 'p': zv & ~zm, 'k': 0}, list_transform(zw.k, lambda zi: {'g': NULL::BIT, 'p': NULL::BIT, 'k': zi::INT})), lambda zs, zx: {'g': zs.g | (zs.p & (zs.g >> zx.k)), 'p': zs.p & (zs.p >> zx.k), 'k': zx.k}).g"
    steps = f"list_transform(string_split({b}, ''), lambda zd: coalesce(map_extract(zw.m, zd)[1], {zero}))"
    left = f"bit_count(list_reduce(list_prepend(repeat('1', length({a}))::BIT, {steps}), lambda zv, zm: xor(zv & ~zm, ({carry}) >> 1) | (zv & ~zm)))"
    return f"list_transform([{{'m': {masks}, 'k': list_filter({POWERS}, lambda zi: zi < length({a}))}}], lambda zw: length({a}) - {left})[1]"


def _short_lcs(a: str, b: str) -> str:
    """SQL for the longest common subsequence where a has 120 characters at most, from one whole number's bits."""
    ones = f"((1::HUGEINT << length({a})) - 1)"
    masks = f"list_transform(string_split({b}, ''), lambda zc: coalesce(list_sum(list_transform(range(length({a})), lambda zi: CASE WHEN substr({a}, (zi + 1)::INT, 1) = zc THEN 1::HUGEINT << zi::INT ELSE 0::HUGEINT END)), 0)::HUGEINT)"
    return f"length({a}) - bit_count(list_reduce(list_prepend({ones}, {masks}), lambda zs, zx: ((zs + (zs & zx)) | (zs - (zs & zx))) & {ones}))"


def ratio(a: str, b: str) -> str:
    common = f"CASE WHEN length({a}) <= 120 THEN {_short_lcs(a, b)} WHEN length({b}) <= 120 THEN {_short_lcs(b, a)} ELSE {_long_lcs(a, b)} END"
    return f"CASE WHEN {a} = {b} THEN 1.0 WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE 2.0 * ({common}) / (length({a}) + length({b})) END"


def token_parts(name: str, source: str, columns: tuple[tuple[str, str, str], ...]) -> str:
    """A CTE: source with, for each (prefix, a, b), the joined shared tokens and those with each side's own, and token counts."""
    joined = lambda x: f"array_to_string(list_sort({x}), ' ')"
    out = []
    for p, a, b in columns:
        both = f"list_filter({once(a)}, lambda t: list_contains({once(b)}, t))"
        out += [f"{joined(both)} AS {p}_both", f"trim({joined(both)} || ' ' || {joined(_only(a, b))}) AS {p}_one", f"trim({joined(both)} || ' ' || {joined(_only(b, a))}) AS {p}_other", f"len({once(a)}) AS {p}_na", f"len({once(b)}) AS {p}_nb"]
    return f"{name} AS (SELECT *, {', '.join(out)} FROM {source})"


def token_set(p: str) -> str:
    both, one, other = f"{p}_both", f"{p}_one", f"{p}_other"
    return f"CASE WHEN {p}_na = 0 OR {p}_nb = 0 THEN 0.0 WHEN {both} <> '' AND ({both} = {one} OR {both} = {other}) THEN 1.0 WHEN {both} = '' THEN {ratio(one, other)} ELSE greatest({ratio(one, other)}, {ratio(both, one)}, {ratio(both, other)}) END"


_sorted = lambda x: f"array_to_string(list_sort({words(x)}), ' ')"
_rank = [
    "ms AS (SELECT m.*, a.name_core AS an, b.name_core AS bn, a.name_skeleton AS ak, b.name_skeleton AS bk, a.addr_street AS ast, b.addr_street AS bst, a.house_num AS ah, b.house_num AS bh FROM merged m JOIN rec a ON a.entity_id = m.s1_id JOIN rec b ON b.entity_id = m.cand_id)",
    token_parts("mt", "ms", (("n", "an", "bn"), ("s", "ast", "bst"))),
    f"mr AS (SELECT country, s1_id, cand_id, block_mask, block_score, round(0.45 * ({token_set('n')}) + CASE WHEN ak <> '' AND bk <> '' THEN 0.15 * ({ratio('ak', 'bk')}) ELSE 0.0 END + 0.30 * ({token_set('s')}) + CASE WHEN ah <> '' AND bh <> '' THEN CASE WHEN ah = bh THEN 0.10 ELSE -0.20 END ELSE 0.0 END, 9) AS rank_score FROM mt)",
]
_order = "ORDER BY rank_score DESC, block_score DESC, s1_id, cand_id"
_fuzzy_core = f"CASE WHEN regexp_matches(trim(name_raw), '{text.HANDLE}') OR regexp_matches(trim(name_raw), '{text.DOMAIN}') OR (NOT regexp_matches(trim(name_raw), '\\s') AND regexp_matches(trim(name_raw), '{text.CAMEL}')) THEN trim(regexp_replace(lower({handle('name_raw')}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) ELSE name_core END"
_fuzzy = [
    f"fc AS (SELECT country, entity_id, source, name_skeleton, {_fuzzy_core} AS core FROM rec)",
    f"fw AS (SELECT country, entity_id, source, ' ' || unnest({words('lower(core || chr(32) || replace(core, chr(32), chr(0) || chr(0)) || chr(32) || name_skeleton)')}) || ' ' AS w FROM fc)".replace("chr(0) || chr(0)", "''"),
    "fg AS (SELECT country, entity_id, source, gram, 1 + ln(count(*)) AS tf FROM (SELECT country, entity_id, source, substr(w, unnest(range(1, greatest(length(w) - 2, 1) + 1))::INT, 3) AS gram FROM fw) GROUP BY ALL)",
    "fn AS (SELECT country, count(*) AS n FROM rec WHERE source = 1 GROUP BY country)",
    "fi AS (SELECT country, gram, ln((1 + n) / (1 + df)) + 1 AS idf FROM (SELECT country, gram, count(*) AS df FROM fg WHERE source = 1 GROUP BY ALL) JOIN fn USING (country) WHERE df <= least(1.0, greatest(0.002, 50 / n)) * n)",
    "fv AS (SELECT country, entity_id, source, gram, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY country, entity_id)) AS w FROM fg JOIN fi USING (country, gram))",
    "fh AS (SELECT q.country, q.entity_id AS cand_id, x.entity_id AS s1_id, round(sum(q.w * x.w), 9) AS score FROM fv q JOIN fv x ON x.country = q.country AND x.gram = q.gram WHERE q.source <> 1 AND x.source = 1 GROUP BY ALL)",
]
#: Expected F0.5 of the first k of ps over all outcomes: distributions of true ones among the first k and among the rest.
_counts = lambda ps: f"list_reduce(list_prepend([1.0::DOUBLE], list_transform({ps}, lambda zp: [zp])), lambda za, zp: list_transform(range(1, len(za) + 2), lambda zi: coalesce(za[zi], 0) * (1 - zp[1]) + CASE WHEN zi > 1 THEN za[zi - 1] * zp[1] ELSE 0 END))"
_exact = _pick.replace("1.25 * list_sum(list_slice(ps, 1, k)) / (0.25 * list_sum(ps) + k) AS e", "list_sum(list_transform(range(1, len(a) + 1), lambda zt: a[zt] * list_sum(list_transform(range(1, len(b) + 1), lambda zr: b[zr] * 1.25 * (zt - 1) / (0.25 * (zt + zr - 2) + k))))) AS e").replace("FROM te),\ntd", f"FROM (SELECT *, {_counts('list_slice(ps, 1, k)')} AS a, {_counts('list_slice(ps, k + 1, len(ps))')} AS b FROM te)),\ntd").replace(" > 0 AS grows", " > 1e-12 AS grows")
_renamed = lambda x: x.replace("tk AS", "uk AS").replace("FROM tk", "FROM uk").replace("te AS", "ue AS").replace("FROM te", "FROM ue").replace("tv AS", "uv AS").replace("FROM tv", "FROM uv").replace("td AS", "ud AS").replace("FROM td", "FROM ud").replace("ts AS", "us AS")
_compare = f"""picked AS (SELECT 'threshold' AS method, s1_id, cand_id FROM matches UNION ALL SELECT 'ef05_approx', te.s1_id, te.c[te.k] FROM te JOIN ts USING (s1_id) WHERE te.k <= ts.n UNION ALL SELECT 'ef05_exact', ue.s1_id, ue.c[ue.k] FROM ue JOIN us USING (s1_id) WHERE ue.k <= us.n),
ms AS (SELECT unnest(['threshold', 'ef05_approx', 'ef05_exact']) AS method),
pf AS (SELECT method, s1_id, country, n_pred, CASE WHEN n_pred = 0 AND n_gt = 0 THEN 1.0 WHEN tp = 0 THEN 0.0 ELSE 1.25 * (tp / n_pred) * (tp / n_gt) / (0.25 * (tp / n_pred) + tp / n_gt) END AS f, CASE WHEN n_gt = 0 THEN 'singleton' ELSE 'latin' END AS script FROM
 (SELECT ms.method, s1.s1_id, country, coalesce(x.n, 0) AS n_pred, coalesce(n_gt, 0) AS n_gt, coalesce(x.tp, 0) AS tp FROM ms, s1 LEFT JOIN (SELECT p.method, p.s1_id, count(*) AS n, count(t.match_id) AS tp FROM picked p LEFT JOIN truth t ON t.s1_id = p.s1_id AND t.match_id = p.cand_id GROUP BY p.method, p.s1_id) x ON x.method = ms.method AND x.s1_id = s1.s1_id LEFT JOIN ngt ON ngt.s1_id = s1.s1_id))"""
_street_parts = token_parts("sp", "sd", (("t", "a_street", "b_street"),))
ORACLE_SQL |= {
    "select_ef05_exact": sql([*RD, _exact], "SELECT te.s1_id, te.c[te.k] AS cand_id, te.ps[te.k] AS p FROM te JOIN ts USING (s1_id) WHERE te.k <= ts.n"),
    "compare_decide": sql([*RD, _pick, _renamed(_exact), _compare], "SELECT 'block_score' AS scorer, method, level, value, round(avg(f), 9) AS f05, sum(n_pred)::BIGINT AS pred_pairs FROM (SELECT *, unnest(['all', 'country', 'script']) AS level, unnest(['ALL', country, script]) AS value FROM pf) GROUP BY method, level, value"),
    "error_worst": sql([*RD, ERRORS, _rich], "(SELECT 'false positives' AS kind, s1_id, cand_id, p FROM rich WHERE kind = 'FP' ORDER BY p DESC NULLS LAST, s1_id, cand_id LIMIT 50) UNION ALL (SELECT 'blocking misses', s1_id, cand_id, p FROM (SELECT * FROM rich WHERE kind = 'FN_blocking' ORDER BY md5(s1_id || '|' || cand_id || '|42'), s1_id, cand_id LIMIT (SELECT least(a, round_even(50 * a / greatest(a + b, 1), 0))::INT FROM (SELECT count(*) FILTER (WHERE kind = 'FN_blocking') AS a, count(*) FILTER (WHERE kind = 'FN_model') AS b FROM rich)))) UNION ALL (SELECT 'model misses', s1_id, cand_id, p FROM (SELECT * FROM rich WHERE kind = 'FN_model' ORDER BY p NULLS LAST, s1_id, cand_id LIMIT (SELECT 50 - least(a, round_even(50 * a / greatest(a + b, 1), 0))::INT FROM (SELECT count(*) FILTER (WHERE kind = 'FN_blocking') AS a, count(*) FILTER (WHERE kind = 'FN_model') AS b FROM rich))))"),
    "feat_skeleton_ratio": sql(RS, f"SELECT s1_id, cand_id, round({ratio('a_skel', 'b_skel')}, 9) AS skel_ratio FROM sd"),
    "feat_street_similarity": sql([*RS, _street_parts], f"SELECT s1_id, cand_id, round({ratio('a_street', 'b_street')}, 9) AS street_ratio, round({token_set('t')}, 9) AS street_tset, round({ratio(_sorted('a_street'), _sorted('b_street'))}, 9) AS street_tsort, CASE WHEN a_street = b_street THEN 1.0 WHEN a_street = '' OR b_street = '' THEN 0.0 ELSE round(jaro_winkler_similarity(a_street, b_street), 9) END AS street_jw FROM sp"),
    "feat_interactions": sql([*RS, _idf_x.replace("{list}", _both), token_parts("tp", "sd", (("n", "a_name_core", "b_name_core"),)), f"so AS (SELECT s1_id, cand_id, {_sorted('a_name_core')} AS x, {_sorted('b_name_core')} AS y, {token_set('n')} AS t FROM tp)", _house()], f"SELECT s1_id, cand_id, round(t * x_mean, 8) AS name_sim_x_rarity, (({ratio('x', 'y')}) >= 0.9 AND hn_conflict = 1)::INT AS name_match_hn_conflict FROM so LEFT JOIN xs USING (s1_id, cand_id) JOIN hc USING (s1_id, cand_id)"),
    "feat_structured": sql([*RS, _idf_x.replace("name_core", "addr_street").replace("{list}", _only("a_street", "b_street")), _idf_x.replace("name_core", "addr_street").replace("{list}", _only("b_street", "a_street")).replace("xi0", "yi0").replace("xi ", "yi ").replace("xs ", "ys "), _house()], f"SELECT sd.s1_id, sd.cand_id, len({_only('a_street', 'b_street')})::INT AS street_only_a, len({_only('b_street', 'a_street')})::INT AS street_only_b, coalesce(xs.x_sum, 0.0) AS street_extra_idf_a, coalesce(ys.x_sum, 0.0) AS street_extra_idf_b, (len({_only('a_street', 'b_street')}) + len({_only('b_street', 'a_street')}) = 1 AND len(list_filter({once('a_street')}, lambda t: list_contains({once('b_street')}, t))) > 0)::INT AS street_one_extra, (a_street = '')::INT + (b_street = '')::INT AS street_missing, hn_rel, hn_conflict, round(ln(1 + hn_diff), 9) AS hn_abs_diff_log, CASE WHEN a_legal = '' AND b_legal = '' THEN 2 WHEN a_legal = '' OR b_legal = '' THEN 1 WHEN a_legal = b_legal THEN 0 ELSE 3 END::INT AS legal_rel FROM sd LEFT JOIN xs USING (s1_id, cand_id) LEFT JOIN ys USING (s1_id, cand_id) JOIN hc ON hc.s1_id = sd.s1_id AND hc.cand_id = sd.cand_id"),
    "feat_ratio": sql(RS, f"SELECT s1_id, cand_id, round({ratio('a_name_core', 'b_name_core')}, 9) AS similarity FROM sd"),
    "feat_token_sort": sql([*RS, f"so AS (SELECT s1_id, cand_id, {_sorted('a_name_core')} AS x, {_sorted('b_name_core')} AS y FROM sd)"], f"SELECT s1_id, cand_id, round({ratio('x', 'y')}, 9) AS similarity FROM so"),
    "feat_token_set": sql([*RS, token_parts("tp", "sd", (("n", "a_name_core", "b_name_core"),))], f"SELECT s1_id, cand_id, round({token_set('n')}, 9) AS similarity FROM tp"),
    "rank_score": sql([*RM, *_rank], "SELECT s1_id, cand_id, rank_score FROM mr"),
    "candidates": sql([*RM, *_rank, f"mk AS (SELECT *, row_number() OVER (PARTITION BY cand_id {_order})::INT AS rank_in_cand FROM mr)"], f"SELECT s1_id, cand_id, country, block_mask, rank_in_cand, block_score, rank_score FROM mk WHERE rank_in_cand <= 2 QUALIFY row_number() OVER (PARTITION BY s1_id {_order}) <= 50"),
    "block_fuzzy": sql([*R, *_fuzzy], "SELECT country, cand_id, s1_id, round(score, 6) AS score FROM fh WHERE score >= 0.3 QUALIFY row_number() OVER (PARTITION BY country, cand_id ORDER BY score DESC, s1_id) <= 20"),
}
