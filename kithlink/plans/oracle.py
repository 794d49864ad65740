"""The registered queries' operators in SQL, written from their definitions, step by step as common table expressions."""

from __future__ import annotations

from ..config import BlockingConfig, DecisionConfig
from ..functions import lexicon
from ..operators import blocking, decision
from ..sources import fixtures

CONFIG = BlockingConfig()
DECISION = DecisionConfig()


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ", ".join(_text(w) for w in words) + "]"


def _case(table: dict[str, str], word: str) -> str:
    return f"CASE {word} " + " ".join(f"WHEN {_text(k)} THEN {_text(v)}" for k, v in table.items()) + f" ELSE {word} END"


# ---------------------------------------------------------------- records

#: recs, truth, spine and docs (every record's id, label and source) of the business fixture; recs of whole texts.
BUSINESS = fixtures.BUSINESS_SQL.format(customer="customer", nation="nation", supplier="supplier") + """, spine AS (SELECT entity_id AS s1_id, country FROM recs WHERE source = 'S1'
), docs AS (SELECT entity_id, country, source FROM recs)"""
DOCUMENTS = fixtures.DOCUMENTS_SQL.replace("{documents}", "documents")

MISSING = "lower(trim({0})) IN (" + ", ".join(_text(x) for x in lexicon.MISSING) + ")"


def fold(column: str) -> str:
    out = column
    for a, b in lexicon.SPECIAL.items():
        out = f"replace({out}, {_text(a)}, {_text(b)})"
    return f"CASE WHEN {MISSING.format(column)} THEN '' ELSE lower(strip_accents({out})) END"


def label(column: str) -> str:
    return f"CASE WHEN {column} IS NULL OR {MISSING.format(column)} THEN '<missing>' ELSE {column} END"


STEM = (
    "CASE WHEN len({0}) > 4 AND {0} LIKE '%ies' THEN substr({0}, 1, len({0}) - 3) || 'y' "
    "WHEN len({0}) > 4 AND {0} LIKE '%s' AND {0} NOT LIKE '%ss' AND {0} NOT LIKE '%us' AND {0} NOT LIKE '%is' THEN substr({0}, 1, len({0}) - 1) ELSE {0} END")
_ELISION = r"regexp_replace({0}, '\b(l|d|qu)''', '\1 ', 'g')"


def tokens(source: str, out: str) -> str:
    """CTEs that turn the column s of ``source`` into the list t of its tokens."""
    marks = f"replace(replace({_ELISION.format('s')}, '''', ''), '&', ' and ')"
    letter = r"[\p{L}\p{Nl}\p{No}]"
    split = rf"regexp_replace(regexp_replace(regexp_replace({marks}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'), '({letter})(\p{{Nd}})', '\1 \2', 'g'), '(\p{{Nd}})({letter})', '\1 \2', 'g')"
    single = r"regexp_matches({0}, '^\p{{L}}$')"
    joined = f"list_transform(range(1, len(t) + 1), lambda i: CASE WHEN i > 1 AND {single.format('t[i]')} AND {single.format('t[i - 1]')} THEN t[i] ELSE ' ' || t[i] END)"
    return f"""{out}_split AS (SELECT * EXCLUDE s, list_filter(string_split({split}, ' '), lambda w: w <> '') AS t FROM {source}
), {out} AS (SELECT * EXCLUDE t, list_filter(string_split(array_to_string({joined}, ''), ' '), lambda w: w <> '') AS t FROM {out}_split)"""


def sounds(token: str) -> str:
    for a, b in lexicon.SOUNDS:
        token = f"replace({token}, '{a}', '{b}')"
    return token


def skeleton(source: str, out: str) -> str:
    """CTEs with the sound key of each token of ``source``."""
    return f"""{out}_sound AS (SELECT token, {sounds('token')} AS x FROM {source}
), {out}_chars AS (SELECT token, string_split(substr(x, 1, 1) || regexp_replace(substr(x, 2), '[aeiouyhw]', '', 'g'), '') AS ch FROM {out}_sound
), {out} AS (SELECT token, CASE WHEN regexp_matches(token, '^\\p{{Nd}}*$') THEN token
    ELSE array_to_string(list_transform(list_filter(range(1, len(ch) + 1), lambda i: i = 1 OR ch[i] <> ch[i - 1]), lambda i: ch[i]), '') END AS skeleton FROM {out}_chars)"""


_DIGITS = r"regexp_matches({0}, '^\p{{Nd}}+$')"
_EMPTY = "CAST([] AS VARCHAR[])"
_LAST = f"list_filter({{0}}, lambda p: len(p) > 0)"


def normaliser() -> str:
    """CTEs from recs to v: one row a record with all its views."""
    legal = lexicon.legal_forms()
    stop, out, lead = _list(lexicon.NAME_STOP), _list(dict.fromkeys([*legal, *lexicon.NAME_STOP])), _list(lexicon.NAME_LEADING)
    compound = " ".join(f"WHEN w LIKE '%{c}' AND len(w) > {len(c) + 2} THEN [substr(w, 1, len(w) - {len(c)}), '{c}']" for c in lexicon.COMPOUNDS)
    a_stop = _list(lexicon.ADDRESS_STOP)
    return rf"""folded AS MATERIALIZED (
  SELECT entity_id, source, country AS country_raw, {fold('business_name')} AS fn, {fold('business_address')} AS fa, {fold('country')} AS fc FROM recs
), name_text AS (SELECT entity_id, replace(replace({_ELISION.format('fn')}, '''', ''), '&', ' and ') AS x FROM folded
), inner_raw AS (
  SELECT entity_id, unnest(ps) AS p, unnest(ps) AS s, unnest(range(1, len(ps) + 1)) AS pos FROM (SELECT entity_id, regexp_extract_all(x, '\(([^()]*)\)', 1) AS ps FROM name_text)
), {tokens('inner_raw', 'inner_tok')}, inner_kept AS (SELECT entity_id, list(p ORDER BY pos) AS ps FROM inner_tok WHERE len(t) >= 2 GROUP BY entity_id
), main AS (
  SELECT n.entity_id, coalesce(ps, {_EMPTY}) AS ps, regexp_replace(list_reduce(list_concat([x], coalesce(ps, {_EMPTY})), lambda acc, p: replace(acc, '(' || p || ')', ' ')), '[^\p{{L}}\p{{N}}_/]+', ' ', 'g') AS m
  FROM name_text n LEFT JOIN inner_kept k ON n.entity_id = k.entity_id
), parts AS (SELECT entity_id, list_concat(list_filter(string_split_regex(m, '\b(?:{lexicon.DOING_BUSINESS_AS})\b'), lambda p: trim(p) <> ''), ps) AS ps FROM main
), pieces AS (
  SELECT entity_id, list_filter(string_split_regex(regexp_replace(regexp_replace(fa, '(^|[^\p{{Nd}}])(\p{{Nd}}{{3}})[\s-]+(\p{{Nd}}{{3}})[^\p{{L}}\p{{N}}_]*$', '\1\2\3'),
    '\b(\p{{Nd}}+)(?:st|nd|rd|th|er|ere|eme|ieme|e)\b', '\1', 'g'), '[,;|\n]+'), lambda c: trim(c) <> '') AS ps FROM folded
), raw AS (
  SELECT entity_id, 'n' AS field, unnest(ps) AS s, unnest(range(1, len(ps) + 1)) AS pos FROM parts
  UNION ALL SELECT entity_id, 'a', unnest(ps), unnest(range(1, len(ps) + 1)) FROM pieces
), {tokens('raw', 'tok')}, name_tok AS (
  SELECT entity_id, pos, list_transform(t, lambda w: {_case(lexicon.name_variants(), 'w')}) AS t FROM tok WHERE field = 'n' AND len(t) > 0
), name_cut AS (SELECT *, t[coalesce(list_min(list_filter(range(1, len(t) + 1), lambda i: NOT list_contains({lead}, t[i]))), len(t) + 1):] AS t2 FROM name_tok
), name_end AS (SELECT *, coalesce(list_max(list_filter(range(1, len(t2) + 1), lambda i: NOT list_contains({out}, t2[i]))), 0) AS e FROM name_cut
), name_part AS (
  SELECT entity_id, pos, t, list_transform(list_filter(t2[1:e], lambda w: NOT list_contains({stop}, w)), lambda w: {STEM.format('w')}) AS c1,
    list_transform(list_filter(t, lambda w: NOT list_contains({stop}, w)), lambda w: {STEM.format('w')}) AS c2, list_filter(t2[e + 1:], lambda w: list_contains({_list(legal)}, w)) AS l FROM name_end
), name_core AS (SELECT entity_id, pos, t, CASE WHEN len(c1) > 0 THEN c1 WHEN len(c2) > 0 THEN c2 ELSE t END AS c, l FROM name_part
), names AS MATERIALIZED (
  SELECT entity_id, string_agg(array_to_string(t, ' '), ' ' ORDER BY pos) AS clean, flatten(list(c ORDER BY pos)) AS n, array_to_string(list_sort(list_distinct(flatten(list(l)))), ' ') AS legal,
    CASE WHEN count(*) > 1 THEN list(array_to_string(c, ' ') ORDER BY pos) ELSE {_EMPTY} END AS alts FROM name_core GROUP BY entity_id
), addr_tok AS (
  SELECT entity_id, pos, flatten(list_transform(list_filter(list_transform(t, lambda w: {_case(lexicon.variants(lexicon.STREET), 'w')}),
    lambda w: NOT list_contains({_list(lexicon.ADDRESS_DROP)}, w)), lambda w: CASE {compound} ELSE [w] END)) AS t FROM tok WHERE field = 'a'
), addrs AS (
  SELECT entity_id, flatten(list(t ORDER BY pos)) AS t, list(list_filter(t, lambda w: NOT {_DIGITS.format('w')} AND NOT list_contains({a_stop}, w)) ORDER BY pos) AS named FROM addr_tok GROUP BY entity_id
), addr_views AS (
  SELECT entity_id, t, list_filter(t, lambda w: NOT list_contains({a_stop}, w)) AS a, list_filter(t, lambda w: {_DIGITS.format('w')}) AS numbers, {_LAST.format('named')} AS named FROM addrs
), name_words AS (SELECT entity_id, unnest(n) AS token, unnest(range(1, len(n) + 1)) AS i FROM names
), words_of_names AS (SELECT DISTINCT token FROM name_words
), {skeleton('words_of_names', 'keys')}, skels AS (
  SELECT entity_id, list(skeleton ORDER BY i) AS sk, string_agg(CASE WHEN regexp_matches(w.token, '^\p{{L}}') THEN substr(w.token, 1, 1) ELSE '' END, '' ORDER BY i) AS initials
  FROM name_words w JOIN keys k ON w.token = k.token GROUP BY entity_id
), v AS MATERIALIZED (
  SELECT f.entity_id, f.source, f.country_raw, trim(regexp_replace(fc, '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS country_norm, coalesce(clean, '') AS name_clean, coalesce(n, {_EMPTY}) AS n,
    coalesce(sk, {_EMPTY}) AS sk, array_to_string(coalesce(n, {_EMPTY}), ' ') AS name_core, array_to_string(coalesce(n, {_EMPTY}), '') AS nospace,
    CASE WHEN len(n) >= 2 THEN initials ELSE '' END AS acronym, coalesce(legal, '') AS legal, coalesce(alts, {_EMPTY}) AS alts, n IS NULL AS name_missing,
    array_to_string(coalesce(t, {_EMPTY}), ' ') AS addr_clean, coalesce(a, {_EMPTY}) AS a, array_to_string(coalesce(a, {_EMPTY}), ' ') AS addr_core, coalesce(numbers, {_EMPTY}) AS numbers,
    list_sort(list_distinct(list_filter(coalesce(numbers, {_EMPTY}), lambda w: len(w) IN (5, 6)))) AS postal, coalesce(list_filter(numbers, lambda w: len(w) NOT IN (5, 6))[1], '') AS house,
    coalesce(list_sort(list_distinct(flatten(named[greatest(len(named) - 1, 1):]))), {_EMPTY}) AS tail, coalesce(len(list_filter(t, lambda w: list_contains({_list(lexicon.LANDMARKS)}, w))) > 0, false) AS landmark,
    coalesce(len(t), 0) = 0 AS addr_missing
  FROM folded f LEFT JOIN names n ON f.entity_id = n.entity_id LEFT JOIN addr_views x ON f.entity_id = x.entity_id LEFT JOIN skels s ON f.entity_id = s.entity_id
), size AS (SELECT count(*) AS total FROM v)"""


#: All views, as text.
VIEW_COLUMNS = """entity_id, name_clean, name_core, array_to_string(sk, ' ') AS name_skel, nospace AS name_nospace, acronym AS name_acronym, legal AS name_legal, array_to_string(alts, ' | ') AS name_alts,
  name_missing, addr_clean, addr_core, array_to_string(numbers, ' ') AS addr_numbers, array_to_string(postal, ' ') AS addr_postal, house AS addr_house, array_to_string(tail, ' ') AS addr_tail,
  landmark AS addr_landmark, addr_missing, source, country_raw, country_norm"""
VIEWS = f"{BUSINESS}, {normaliser()}"
DOCUMENT_VIEWS = f"{DOCUMENTS}, {normaliser()}"

# ---------------------------------------------------------------- vectors

GRAMS = """flatten(list_transform({0}, lambda w: list_concat(
    list_transform(range(1, greatest(len(w), 1) + 1), lambda i: substr(' ' || w || ' ', i, 3)),
    list_transform(range(1, greatest(len(w) - 1, 0) + 1), lambda i: substr(' ' || w || ' ', i, 4)))))"""


def postings(name: str, terms: str, min_df: int, max_df: float = 1.0) -> str:
    return f"""{name}_t AS (
  SELECT entity_id, 'n' AS field, unnest({terms.format('n')}) AS term FROM v UNION ALL SELECT entity_id, 'a', unnest({terms.format('a')}) FROM v
), {name}_c AS (SELECT entity_id, field, term, count(*) AS tf FROM {name}_t GROUP BY entity_id, field, term
), {name}_d AS (SELECT field, term, count(*) AS df FROM {name}_c CROSS JOIN size GROUP BY field, term HAVING count(*) >= {min_df} AND count(*) <= {max_df} * max(total)
), {name}_w AS (
  SELECT c.entity_id, c.field, c.term, (1 + ln(tf)) * (ln((1.0 + total) / (1.0 + df)) + 1) AS w
  FROM {name}_c c JOIN {name}_d d ON c.field = d.field AND c.term = d.term CROSS JOIN size
), {name} AS MATERIALIZED (SELECT entity_id, field, term, w / sqrt(sum(w * w) OVER (PARTITION BY entity_id, field)) AS weight FROM {name}_w)"""


def similar(name: str, post: str) -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT s1_id, t_id, src, name_cos, addr_cos, round({CONFIG.combined_name_weight} * name_cos + (1 - {CONFIG.combined_name_weight}) * addr_cos, 9) AS comb FROM (
    SELECT x.entity_id AS s1_id, y.entity_id AS t_id, substr(y.entity_id, 1, 2) AS src,
      round(coalesce(sum(CASE WHEN x.field = 'n' THEN x.weight * y.weight END), 0), 9) AS name_cos,
      round(coalesce(sum(CASE WHEN x.field = 'a' THEN x.weight * y.weight END), 0), 9) AS addr_cos
    FROM {post} x JOIN {post} y ON x.field = y.field AND x.term = y.term
    WHERE x.entity_id LIKE 'S1-%' AND y.entity_id NOT LIKE 'S1-%' GROUP BY x.entity_id, y.entity_id)
)"""


CHARS = postings("post", GRAMS, CONFIG.char_min_df)
SIM = similar("sim", "post")


def knn(sim: str) -> str:
    ranked = lambda s, k: f"""knn_{s} AS (SELECT * FROM (
  SELECT s1_id, t_id, src, {s}, row_number() OVER (PARTITION BY s1_id, src ORDER BY {s} DESC, t_id) AS rank FROM {sim} WHERE {s} > 0) WHERE rank <= {k})"""  # noqa: E731
    return ", ".join(ranked(s, k) for s, k in (("name_cos", CONFIG.name_k), ("addr_cos", CONFIG.address_k), ("comb", CONFIG.combined_k)))


# ---------------------------------------------------------------- candidates

RARE = f"""tokd AS (
  SELECT entity_id, source, unnest(list_distinct(n)) AS token FROM v
), rare_df AS (
  SELECT t.source AS src, token, count(*) AS df, max(s.n) AS n FROM tokd t JOIN (SELECT source, count(*) AS n FROM v GROUP BY source) s ON t.source = s.source
  WHERE t.source <> 'S1' AND (len(token) >= 3 OR {_DIGITS.format('token')}) GROUP BY t.source, token
), usable AS (SELECT * FROM rare_df WHERE df <= greatest({CONFIG.rare_min_df}, floor({CONFIG.rare_df_frac} * n))
), chosen AS (SELECT * FROM (
  SELECT t.entity_id AS s1_id, u.src, u.token, row_number() OVER (PARTITION BY t.entity_id, u.src ORDER BY u.df, u.token) AS r
  FROM tokd t JOIN usable u ON t.token = u.token WHERE t.source = 'S1') WHERE r <= {CONFIG.rare_tokens_per_record}
), rare AS (SELECT DISTINCT c.s1_id, t.entity_id AS t_id, c.src FROM chosen c JOIN tokd t ON t.source = c.src AND t.token = c.token)"""
KEYS = f"""ekeys AS (
  SELECT entity_id, source, 1 AS kind, array_to_string(list_sort(list_distinct(sk)), ' ') AS key FROM v
  UNION ALL SELECT entity_id, source, 2, nospace FROM v
), okeys AS (SELECT * FROM ekeys WHERE (kind = 1 AND key <> '') OR (kind = 2 AND len(key) >= 3)
), small AS (SELECT source, kind, key FROM okeys WHERE source <> 'S1' GROUP BY source, kind, key HAVING count(*) <= {CONFIG.key_max_bucket}
), keyed AS (
  SELECT DISTINCT x.entity_id AS s1_id, y.entity_id AS t_id, y.source AS src FROM okeys x
  JOIN small s ON x.kind = s.kind AND x.key = s.key JOIN okeys y ON y.source = s.source AND y.kind = s.kind AND y.key = s.key WHERE x.source = 'S1')"""
ACRONYM = f"""acr AS (
  SELECT entity_id, source, CASE WHEN len(acronym) >= 2 THEN acronym END AS acronym, CASE WHEN len(n) = 1 AND len(n[1]) >= 2 THEN n[1] END AS single FROM v
), heads AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY source, side, key ORDER BY entity_id) AS r FROM (
    SELECT entity_id, source, 's' AS side, single AS key FROM acr WHERE regexp_matches(single, '^\\p{{L}}+$') AND source <> 'S1'
    UNION ALL SELECT entity_id, source, 'a', acronym FROM acr WHERE acronym IS NOT NULL AND source <> 'S1')) WHERE r <= {CONFIG.acronym_head}
), acro AS (
  SELECT DISTINCT x.entity_id AS s1_id, h.entity_id AS t_id, h.source AS src FROM acr x
  JOIN heads h ON (h.side = 's' AND h.key = x.acronym) OR (h.side = 'a' AND h.key = x.single) WHERE x.source = 'S1')"""
POSTAL = f"""codes AS (SELECT entity_id, source, unnest(postal) AS code FROM v
), pairs_p AS (
  SELECT DISTINCT x.entity_id AS s1_id, y.entity_id AS t_id, y.source AS src FROM codes x
  JOIN (SELECT source, code FROM codes WHERE source <> 'S1' GROUP BY source, code HAVING count(*) <= {CONFIG.postal_max_bucket}) s ON x.code = s.code
  JOIN codes y ON y.source = s.source AND y.code = s.code WHERE x.source = 'S1'
), postal AS (SELECT s1_id, t_id, src FROM (
  SELECT p.*, row_number() OVER (PARTITION BY p.s1_id, p.src ORDER BY coalesce(name_cos, 0) DESC, p.t_id) AS r
  FROM pairs_p p LEFT JOIN sim ON p.s1_id = sim.s1_id AND p.t_id = sim.t_id WHERE coalesce(name_cos, 0) > {CONFIG.postal_min_cosine}) WHERE r <= {CONFIG.postal_k})"""
_BITS = "UNION ALL ".join(
    f"SELECT s1_id, t_id, src, {blocking.BIT[b]} AS bit FROM {t} " for b, t in zip(blocking.BLOCKERS, ("knn_name_cos", "knn_addr_cos", "knn_comb", "rare", "keyed", "postal", "acro"), strict=True))
_PROTECTED = blocking.BIT["b_key"] | blocking.BIT["b_acr"]


def candidates(search: str = "sim") -> str:
    """CTEs from v to bits (the union of all blockers) and scored (the candidates); ``search`` names the similarities that neighbours are taken from."""
    own = "" if search == "sim" else f"{postings('near_post', GRAMS, CONFIG.char_min_df, 0.2)}, {similar(search, 'near_post')}, "
    return f"""{CHARS}, {SIM}, {own}{knn(search)}, {RARE}, {KEYS}, {ACRONYM}, {POSTAL}, bits AS MATERIALIZED (
  SELECT s1_id, t_id, src, sum(bit) AS bits FROM ({_BITS}) GROUP BY s1_id, t_id, src
), with_scores AS (
  SELECT p.*, coalesce(name_cos, 0) AS name_cos, coalesce(addr_cos, 0) AS addr_cos,
    round(CASE WHEN x.name_missing OR y.name_missing THEN coalesce(addr_cos, 0) WHEN x.addr_missing OR y.addr_missing THEN coalesce(name_cos, 0)
      ELSE {CONFIG.combined_name_weight} * coalesce(name_cos, 0) + (1 - {CONFIG.combined_name_weight}) * coalesce(addr_cos, 0) END, 9) AS cheap
  FROM bits p JOIN v x ON p.s1_id = x.entity_id JOIN v y ON p.t_id = y.entity_id LEFT JOIN sim ON p.s1_id = sim.s1_id AND p.t_id = sim.t_id
), ranked AS (SELECT *, row_number() OVER (PARTITION BY s1_id, src ORDER BY cheap DESC, t_id) AS rc,
    row_number() OVER (PARTITION BY s1_id, src ORDER BY name_cos DESC, t_id) AS rn, row_number() OVER (PARTITION BY s1_id, src ORDER BY addr_cos DESC, t_id) AS ra FROM with_scores
), scored AS MATERIALIZED (SELECT s1_id, t_id, src, CAST(bits AS INTEGER) AS bits, name_cos, addr_cos, cheap FROM ranked WHERE CAST(bits AS INTEGER) & {_PROTECTED} <> 0
    OR (rc <= {CONFIG.max_candidates_per_source} AND cheap >= {CONFIG.min_cheap_score}) OR (rn <= {CONFIG.keep_top_name} AND name_cos >= {CONFIG.min_cheap_score})
    OR (ra <= {CONFIG.keep_top_address} AND addr_cos >= {CONFIG.keep_address_cosine}))"""


PAIRS = f"WITH {VIEWS}, {candidates()}"

# ---------------------------------------------------------------- strings


def ratios(source: str, out: str) -> str:
    """CTEs from the pairs of strings a, b of ``source`` to their ratio r: a row of bits a string, a step a character."""
    return f"""{out}_m AS (
  SELECT a, b, len(a) AS m, (CAST(1 AS HUGEINT) << len(a)) - 1 AS whole,
    list_transform(string_split(b, ''), lambda c: list_reduce(list_transform(range(1, len(a) + 1), lambda i: CASE WHEN substr(a, i, 1) = c THEN CAST(1 AS HUGEINT) << (i - 1) ELSE CAST(0 AS HUGEINT) END), lambda x, y: x | y)) AS masks
  FROM (SELECT DISTINCT a, b FROM {source} WHERE a <> '' AND b <> '')
), {out} AS MATERIALIZED (
  SELECT a, b, 2.0 * (m - bit_count(list_reduce(list_concat([whole], masks), lambda w, k: ((w + (w & k)) | (w - (w & k))) & whole))) / (m + len(b)) AS r FROM {out}_m
  UNION ALL SELECT DISTINCT a, b, CASE WHEN a = b THEN 1.0 ELSE 0.0 END FROM {source} WHERE a = '' OR b = '')"""


def partial_ratios(source: str, out: str) -> str:
    """CTEs from the pairs of strings a, b of ``source`` to their partial ratio r: every stretch of the longer one."""
    window = "masks[greatest(s, 0) + 1:least(s + m, n)]"
    return f"""{out}_o AS (SELECT DISTINCT a, b, CASE WHEN len(a) <= len(b) THEN a ELSE b END AS x, CASE WHEN len(a) <= len(b) THEN b ELSE a END AS y FROM {source}
), {out}_m AS (
  SELECT x, y, len(x) AS m, len(y) AS n, (CAST(1 AS HUGEINT) << len(x)) - 1 AS whole,
    list_transform(string_split(y, ''), lambda c: list_reduce(list_transform(range(1, len(x) + 1), lambda i: CASE WHEN substr(x, i, 1) = c THEN CAST(1 AS HUGEINT) << (i - 1) ELSE CAST(0 AS HUGEINT) END), lambda p, q: p | q)) AS masks
  FROM (SELECT DISTINCT x, y FROM {out}_o WHERE x <> '')
), {out}_v AS (
  SELECT x, y, list_max(list_transform(range(1 - m, n), lambda s: 2.0 * (m - bit_count(list_reduce(list_concat([whole], {window}), lambda w, k: ((w + (w & k)) | (w - (w & k))) & whole)))
    / (m + least(s + m, n) - greatest(s, 0)))) AS r FROM {out}_m
), {out} AS MATERIALIZED (SELECT o.a, o.b, CASE WHEN o.x = '' THEN CASE WHEN o.y = '' THEN 1.0 ELSE 0.0 END ELSE r END AS r FROM {out}_o o LEFT JOIN {out}_v v ON o.x = v.x AND o.y = v.y)"""


def token_sets(source: str, out: str) -> str:
    """CTEs from the pairs a, b of ``source`` to their token set score r."""
    sorted_ = "array_to_string(list_sort({0}), ' ')"
    return f"""{out}_w AS (
  SELECT a, b, list_filter(list_distinct(string_split(a, ' ')), lambda w: w <> '') AS x, list_filter(list_distinct(string_split(b, ' ')), lambda w: w <> '') AS y FROM (SELECT DISTINCT a, b FROM {source})
), {out}_p AS (
  SELECT a, b, len(x) = 0 OR len(y) = 0 AS none, {sorted_.format('list_filter(x, lambda w: list_contains(y, w))')} AS shared,
    {sorted_.format('list_filter(x, lambda w: NOT list_contains(y, w))')} AS l, {sorted_.format('list_filter(y, lambda w: NOT list_contains(x, w))')} AS r FROM {out}_w
), {out}_s AS (SELECT *, trim(shared || ' ' || l) AS one, trim(shared || ' ' || r) AS two FROM {out}_p
), {out}_r AS (SELECT one AS a, two AS b FROM {out}_s UNION SELECT shared, one FROM {out}_s UNION SELECT shared, two FROM {out}_s
), {ratios(f'{out}_r', f'{out}_q')}, {out} AS MATERIALIZED (
  SELECT s.a, s.b, CASE WHEN none THEN 0.0 WHEN shared <> '' AND (l = '' OR s.r = '') THEN 1.0 WHEN shared <> '' THEN greatest(q.r, f.r, g.r) ELSE q.r END AS r
  FROM {out}_s s JOIN {out}_q q ON q.a = one AND q.b = two JOIN {out}_q f ON f.a = shared AND f.b = one JOIN {out}_q g ON g.a = shared AND g.b = two)"""


_SORTED = "array_to_string(list_sort(list_filter(string_split({0}, ' '), lambda w: w <> '')), ' ')"

# ---------------------------------------------------------------- features


def _sets(a: str, b: str, prefix: str, names: tuple[str, ...]) -> str:
    """Shared elements of two lists as count, by union, by the smaller."""
    inter = f"CAST(len(list_intersect({a}, {b})) AS DOUBLE)"
    both, one, two = f"len({a}) > 0 AND len({b}) > 0", f"len(list_distinct({a}))", f"len(list_distinct({b}))"
    value = {"inter": inter, "jacc": f"{inter} / ({one} + {two} - {inter})", "overlap": f"{inter} / least({one}, {two})"}
    return ", ".join(f"CASE WHEN {both} THEN {value[n]} END AS {prefix}_{n}" for n in names)


def idf_ctes(field: str, column: str) -> str:
    """CTEs {field}_tot (each record's sum of idf) and {field}_sh (shared idf of each candidate), and the word cosine."""
    return f"""{field}_terms AS (SELECT entity_id, unnest({column}) AS term FROM v), {field}_tf AS (SELECT entity_id, term, count(*) AS tf FROM {field}_terms GROUP BY entity_id, term
), {field}_idf AS (SELECT term, ln((1.0 + max(total)) / (1.0 + count(*))) + 1 AS idf FROM {field}_tf CROSS JOIN size GROUP BY term
), {field}_e AS (SELECT t.entity_id, t.term, idf, (1 + ln(tf)) * idf AS w FROM {field}_tf t JOIN {field}_idf d ON t.term = d.term
), {field}_tot AS (SELECT entity_id, sum(idf) AS total_idf, sqrt(sum(w * w)) AS length FROM {field}_e GROUP BY entity_id
), {field}_sh AS (
  SELECT p.s1_id, p.t_id, sum(x.idf) AS shared, max(x.idf) AS top, sum(x.w * y.w) AS dot FROM scored p JOIN {field}_e x ON p.s1_id = x.entity_id JOIN {field}_e y ON p.t_id = y.entity_id AND x.term = y.term GROUP BY p.s1_id, p.t_id
), {field}_stat AS (
  SELECT p.s1_id, p.t_id, coalesce(dot, 0) / coalesce(a.length * b.length, 1) AS word_cos, CASE WHEN a.entity_id IS NOT NULL AND b.entity_id IS NOT NULL THEN coalesce(shared, 0) / greatest(a.total_idf + b.total_idf - coalesce(shared, 0), 1e-6) END AS idf_jacc,
    CASE WHEN a.entity_id IS NOT NULL AND b.entity_id IS NOT NULL THEN coalesce(top, 0) END AS max_shared_idf, a.total_idf + b.total_idf - 2 * coalesce(shared, 0) AS unshared_idf
  FROM scored p LEFT JOIN {field}_tot a ON p.s1_id = a.entity_id LEFT JOIN {field}_tot b ON p.t_id = b.entity_id LEFT JOIN {field}_sh m ON p.s1_id = m.s1_id AND p.t_id = m.t_id)"""


def _context(prefix: str, score: str, keys: str, tie: str) -> str:
    over = f"PARTITION BY {keys} ORDER BY {score} DESC, {tie}"
    rank, best = f"row_number() OVER ({over})", f"max({score}) OVER (PARTITION BY {keys})"
    second = f"coalesce(nth_value({score}, 2) OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0)"
    return (f"CAST({rank} AS DOUBLE) AS {prefix}_rank, {score} - CASE WHEN {rank} = 1 THEN {second} ELSE {best} END AS {prefix}_margin, "
            f"{best} - {score} AS {prefix}_gap_to_best, CAST(count(*) OVER (PARTITION BY {keys}) AS DOUBLE) AS {prefix}_n")


def features() -> str:
    """CTEs from v and scored to features: all 84 of each candidate."""
    d = lambda x: f"CAST(CASE WHEN {x} THEN 1 ELSE 0 END AS DOUBLE)"
    length = lambda a, b: f"CAST(least(len({a}), len({b})) AS DOUBLE) / greatest(len({a}), len({b}), 1)"
    known_n, known_a = "NOT (x.name_missing OR y.name_missing)", "NOT (x.addr_missing OR y.addr_missing)"
    n, a = (lambda e, k=k: f"CASE WHEN {k} THEN {e} END" for k in (known_n, known_a))
    lx, ly = ("list_filter(string_split({0}.legal, ' '), lambda w: w <> '')".format(t) for t in "xy")
    cover = lambda p, q: f"CAST(len(list_intersect({p}.tail, {q}.a)) AS DOUBLE) / greatest(len({p}.tail), 1)"
    tails = "len(x.tail) > 0 AND len(y.tail) > 0"
    flags = ", ".join(f"{d(f'p.bits & {blocking.BIT[b]} <> 0')} AS {b}" for b in blocking.BLOCKERS)
    contexts = ", ".join(_context(*c) for c in (
        ("ctx_s1_cheap", "cheap_score", "s1_id, src", "t_id"), ("ctx_s1_name", "name_mix", "s1_id, src", "t_id"), ("ctx_t_cheap", "cheap_score", "t_id", "s1_id"), ("ctx_t_name", "name_mix", "t_id", "s1_id")))
    return f"""{idf_ctes('name', 'n')}, {idf_ctes('addr', 'a')}, texts AS MATERIALIZED (
  SELECT p.s1_id, p.t_id, x.name_core AS c1, y.name_core AS c2, x.nospace AS o1, y.nospace AS o2, x.name_clean AS l1, y.name_clean AS l2, x.addr_core AS a1, y.addr_core AS a2,
    {_SORTED.format('x.name_core')} AS s1, {_SORTED.format('y.name_core')} AS s2, {_SORTED.format('x.addr_core')} AS t1, {_SORTED.format('y.addr_core')} AS t2, x.alts AS alts1, y.alts AS alts2
  FROM scored p JOIN v x ON p.s1_id = x.entity_id JOIN v y ON p.t_id = y.entity_id
), ratio_of AS (SELECT c1 AS a, c2 AS b FROM texts UNION SELECT o1, o2 FROM texts UNION SELECT l1, l2 FROM texts UNION SELECT a1, a2 FROM texts UNION SELECT s1, s2 FROM texts UNION SELECT t1, t2 FROM texts
), {ratios('ratio_of', 'rat')}, partial_of AS (SELECT c1 AS a, c2 AS b FROM texts UNION SELECT a1, a2 FROM texts), {partial_ratios('partial_of', 'par')}, alt_pairs AS (
  SELECT s1_id, t_id, a, unnest(list_filter(list_concat(alts2, [c2]), lambda w: w <> '')) AS b FROM (
    SELECT s1_id, t_id, unnest(list_filter(list_concat(alts1, [c1]), lambda w: w <> '')) AS a, alts2, c2 FROM texts WHERE len(alts1) > 0 OR len(alts2) > 0)
), set_of AS (SELECT c1 AS a, c2 AS b FROM texts UNION SELECT a1, a2 FROM texts UNION SELECT a, b FROM alt_pairs), {token_sets('set_of', 'tset')}, alt_best AS (
  SELECT s1_id, t_id, max(r) AS r FROM alt_pairs p JOIN tset t ON p.a = t.a AND p.b = t.b GROUP BY s1_id, t_id
), plain AS (
  SELECT p.s1_id, p.t_id, p.src, {n('p.name_cos')} AS name_char_cos, {n('ns.word_cos')} AS name_word_cos, {_sets('x.n', 'y.n', 'name_tok', ('inter', 'jacc', 'overlap'))},
    ns.idf_jacc AS name_tok_idf_jacc, ns.max_shared_idf AS name_tok_max_shared_idf, ns.unshared_idf AS name_tok_unshared_idf, {_sets('x.sk', 'y.sk', 'name_skel', ('jacc',))},
    {n('q1.r')} AS name_ratio, {n('q2.r')} AS name_partial, {n('q3.r')} AS name_token_sort, {n('q4.r')} AS name_token_set,
    {n("CASE WHEN x.name_core = '' OR y.name_core = '' THEN 0.0 ELSE jaro_winkler_similarity(x.name_core, y.name_core) END")} AS name_jaro_winkler, {n('q5.r')} AS name_nospace_ratio, {n('q6.r')} AS name_clean_ratio,
    {n(d('x.name_core = y.name_core'))} AS name_exact_core, {n(d('x.nospace = y.nospace'))} AS name_exact_nospace, {n(length('x.name_core', 'y.name_core'))} AS name_len_ratio,
    CAST(len(x.n) AS DOUBLE) AS name_ntok_s1, CAST(len(y.n) AS DOUBLE) AS name_ntok_t, CAST(abs(len(x.n) - len(y.n)) AS DOUBLE) AS name_ntok_diff, {n(d('x.n[1] = y.n[1]'))} AS name_first_token_eq,
    {d("(x.acronym <> '' AND x.acronym = y.nospace) OR (y.acronym <> '' AND y.acronym = x.nospace)")} AS name_acronym_match, {_sets(lx, ly, 'legal_form', ('jacc',))},
    {d("(x.legal <> '') <> (y.legal <> '')")} AS legal_form_one_side, {n('coalesce(ab.r, q4.r)')} AS name_alt_best, {d('len(x.alts) > 0 OR len(y.alts) > 0')} AS name_has_alt,
    {d('x.name_missing')} AS name_missing_s1, {d('y.name_missing')} AS name_missing_t, {a('p.addr_cos')} AS addr_char_cos, {a('ads.word_cos')} AS addr_word_cos,
    {_sets('x.a', 'y.a', 'addr_tok', ('inter', 'jacc', 'overlap'))}, ads.idf_jacc AS addr_tok_idf_jacc, ads.max_shared_idf AS addr_tok_max_shared_idf, ads.unshared_idf AS addr_tok_unshared_idf,
    {a('r1.r')} AS addr_ratio, {a('r2.r')} AS addr_partial, {a('r4.r')} AS addr_token_set, {a('r3.r')} AS addr_token_sort, {_sets('x.numbers', 'y.numbers', 'addr_num', ('inter', 'jacc'))},
    {d('len(x.postal) > 0 AND len(y.postal) > 0')} AS postal_both_present, CASE WHEN len(x.postal) > 0 AND len(y.postal) > 0 THEN {d('list_has_any(x.postal, y.postal)')} END AS postal_match,
    CASE WHEN x.house <> '' AND y.house <> '' THEN {d('x.house = y.house')} END AS house_number_eq, CASE WHEN {tails} THEN greatest({cover('x', 'y')}, {cover('y', 'x')}) END AS addr_tail_cov_max,
    CASE WHEN {tails} THEN least({cover('x', 'y')}, {cover('y', 'x')}) END AS addr_tail_cov_min, {a(length('x.addr_core', 'y.addr_core'))} AS addr_len_ratio,
    {d('x.addr_missing')} AS addr_missing_s1, {d('y.addr_missing')} AS addr_missing_t, {d('len(x.postal) > 0')} AS addr_postal_s1, {d('len(y.postal) > 0')} AS addr_postal_t,
    {d('x.landmark')} AS landmark_s1, {d('y.landmark')} AS landmark_t, CASE WHEN x.country_norm <> '' AND y.country_norm <> '' THEN {d('x.country_norm = y.country_norm')} END AS country_eq,
    {d("p.src = 'S3'")} AS target_is_s3, {flags}, CAST(bit_count(p.bits) AS DOUBLE) AS n_blocks, p.cheap AS cheap_score
  FROM scored p JOIN v x ON p.s1_id = x.entity_id JOIN v y ON p.t_id = y.entity_id JOIN texts t ON p.s1_id = t.s1_id AND p.t_id = t.t_id
  JOIN name_stat ns ON p.s1_id = ns.s1_id AND p.t_id = ns.t_id JOIN addr_stat ads ON p.s1_id = ads.s1_id AND p.t_id = ads.t_id
  JOIN rat q1 ON q1.a = c1 AND q1.b = c2 JOIN par q2 ON q2.a = c1 AND q2.b = c2 JOIN rat q3 ON q3.a = t.s1 AND q3.b = t.s2 JOIN tset q4 ON q4.a = c1 AND q4.b = c2 JOIN rat q5 ON q5.a = o1 AND q5.b = o2
  JOIN rat q6 ON q6.a = l1 AND q6.b = l2 JOIN rat r1 ON r1.a = a1 AND r1.b = a2 JOIN par r2 ON r2.a = a1 AND r2.b = a2 JOIN rat r3 ON r3.a = t.t1 AND r3.b = t.t2 JOIN tset r4 ON r4.a = a1 AND r4.b = a2
  LEFT JOIN alt_best ab ON p.s1_id = ab.s1_id AND p.t_id = ab.t_id
), mixed AS (
  SELECT *, coalesce(list_avg(list_filter([name_char_cos, name_token_sort, name_jaro_winkler, name_alt_best], lambda z: z IS NOT NULL)), 0) AS name_mix FROM plain
), contexts AS (SELECT * EXCLUDE name_mix, {contexts} FROM mixed
), features AS MATERIALIZED (SELECT *, {d('ctx_s1_cheap_rank = 1 AND ctx_t_cheap_rank = 1')} AS ctx_mutual_best FROM contexts)"""


# ---------------------------------------------------------------- decisions

THRESHOLD = 0.6
LABELLED = PAIRS + """, lab AS MATERIALIZED (SELECT p.s1_id, p.t_id, p.src, p.bits, name_cos, addr_cos, cheap AS p, CASE WHEN t.s1_id IS NULL THEN 0 ELSE 1 END AS y
  FROM scored p LEFT JOIN (SELECT DISTINCT * FROM truth) t ON p.s1_id = t.s1_id AND p.t_id = t.t_id)"""
KEPT = f"SELECT s1_id, t_id FROM lab WHERE p >= {THRESHOLD}"


def entity_scores(pred: str, truth: str = "SELECT DISTINCT s1_id, t_id FROM truth") -> str:
    return f"""pred AS ({pred}), tr AS ({truth}), es AS (
  SELECT s.s1_id, s.country, coalesce(tp, 0) AS tp, coalesce(n_pred, 0) AS n_pred, coalesce(n_true, 0) AS n_true FROM spine s
  LEFT JOIN (SELECT s1_id, count(*) AS n_pred FROM pred GROUP BY s1_id) a ON s.s1_id = a.s1_id
  LEFT JOIN (SELECT s1_id, count(*) AS n_true FROM tr GROUP BY s1_id) b ON s.s1_id = b.s1_id
  LEFT JOIN (SELECT p.s1_id, count(*) AS tp FROM pred p JOIN tr ON p.s1_id = tr.s1_id AND p.t_id = tr.t_id GROUP BY p.s1_id) c ON s.s1_id = c.s1_id
), sc AS (SELECT *, CASE WHEN n_true = 0 AND n_pred = 0 THEN 1.0 WHEN 0.25 * n_true + n_pred = 0 THEN 0.0 ELSE 1.25 * tp / (0.25 * n_true + n_pred) END AS f,
  CASE WHEN n_pred > 0 THEN CAST(tp AS DOUBLE) / n_pred END AS precision, CASE WHEN n_true > 0 THEN CAST(tp AS DOUBLE) / n_true END AS recall FROM es)"""


SCORES = f"{LABELLED}, {entity_scores(KEPT)}"


def expected_counts(source: str, out: str) -> str:
    """CTEs from (g, s1_id, q falling with its place r, y) to the number k kept and its matches.

    For each size k the chances of a matches among the first k and b among the others are tabled, and E[F] summed over both. The search passes over
    sizes that aren't better than all before, and ends when the next better one is more than three sizes ahead.
    """
    spread = "list_reduce(list_concat([[CAST(1 AS DOUBLE)]], {0}), lambda d, e: list_transform(range(1, len(d) + 2), lambda i: coalesce(d[i], 0) * (1 - e[1]) + CASE WHEN i > 1 THEN d[i - 1] * e[1] ELSE 0 END))"
    return f"""{out}_l AS (SELECT g, s1_id, list([q] ORDER BY r) AS ps, list(y ORDER BY r) AS ys FROM {source} WHERE q >= {DECISION.min_prob} GROUP BY g, s1_id
), {out}_k AS (SELECT g, s1_id, ps, ys, unnest(range(0, len(ps) + 1)) AS k FROM {out}_l
), {out}_d AS (SELECT g, s1_id, ys, len(ps) AS n, k, {spread.format('ps[1:k]')} AS h, {spread.format('ps[k + 1:]')} AS t FROM {out}_k
), {out}_f AS (
  SELECT g, s1_id, ys, n, k, CASE WHEN k = 0 THEN t[1] ELSE list_sum(flatten(list_transform(range(0, k + 1), lambda a: list_transform(range(0, n - k + 1), lambda b: h[a + 1] * t[b + 1] * 1.25 * a / (0.25 * (a + b) + k))))) END AS f FROM {out}_d
), {out}_a AS (SELECT *, max(f) OVER (PARTITION BY g, s1_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM {out}_f
), {out}_b AS (SELECT *, k - lag(k) OVER (PARTITION BY g, s1_id ORDER BY k) AS step FROM {out}_a WHERE before IS NULL OR f > before + 1e-12
), {out} AS (
  SELECT g, s1_id, max(k) AS k, coalesce(list_sum(any_value(ys)[1:max(k)]), 0) AS tp FROM (SELECT *, max(coalesce(step, 0)) OVER (PARTITION BY g, s1_id ORDER BY k) AS widest FROM {out}_b) WHERE widest <= 3 GROUP BY g, s1_id)"""


FOLDS = """grp_e AS (SELECT DISTINCT a.s1_id AS u, b.s1_id AS w FROM truth a JOIN truth b ON a.t_id = b.t_id), reach AS (
  SELECT s1_id, s1_id AS r FROM spine UNION SELECT reach.s1_id, e.w FROM reach JOIN grp_e e ON reach.r = e.u), grps AS (SELECT s1_id, min(r) AS grp FROM reach GROUP BY s1_id
), fold_first AS (
  SELECT g.grp, coalesce(s.country, '') || '|' || CAST(least(coalesce(n, 0), 3) AS VARCHAR) AS stratum, md5(g.grp || '|42') AS h FROM grps g JOIN spine s ON s.s1_id = g.grp
  LEFT JOIN (SELECT s1_id, count(DISTINCT t_id) AS n FROM truth GROUP BY s1_id) c ON c.s1_id = g.grp WHERE g.s1_id = g.grp
), fold_bucket AS (SELECT *, CAST('0x' || substr(h, 1, 2) AS INTEGER) % 64 AS bucket FROM fold_first
), fold_of AS (SELECT grp, CAST((row_number() OVER (PARTITION BY stratum, bucket ORDER BY h, grp) + bucket) % 5 AS INTEGER) AS fold FROM fold_bucket
), folds AS MATERIALIZED (SELECT s1_id, fold FROM grps g JOIN fold_of f ON g.grp = f.grp)"""


def _listed(values) -> str:
    return "[" + ", ".join(repr(float(x)) for x in values) + "]"


def policy_grid() -> str:
    """CTEs from lab and folds to grid: fold, policy number and the sum of F, in the order of ``candidate_policies``."""
    policies = decision.candidate_policies(DECISION, ["S2", "S3"])
    t, g, e = len(DECISION.threshold_grid), len(DECISION.source_threshold_grid), len(DECISION.expected_f_gamma_grid)
    half = t + g * g + e
    rows = ", ".join(f"({i}, {_text(p.describe())}, {_text(p.kind)}, {str(p.exclusive).lower()}, {p.rank})" for i, p in enumerate(policies))
    f = "CASE WHEN 0.25 * n_true + n_pred > 0 THEN 1.25 * tp / (0.25 * n_true + n_pred) ELSE 1.0 END"
    reached = "count(CASE WHEN p >= level THEN 1 END) AS n_pred, count(CASE WHEN p >= level AND y = 1 THEN 1 END) AS tp"
    return f"""listed(policy, description, family, exclusive, simplicity) AS (VALUES {rows}
), best_of AS (SELECT *, row_number() OVER (PARTITION BY t_id ORDER BY p DESC, s1_id) = 1 AS best FROM lab
), open_pairs AS (SELECT 0 AS x, * FROM best_of UNION ALL SELECT 1, * FROM best_of WHERE best
), t_levels AS (SELECT unnest({_listed(DECISION.threshold_grid)}) AS level, unnest(range({t})) AS i
), s_levels AS (SELECT unnest({_listed(DECISION.source_threshold_grid)}) AS level, unnest(range({g})) AS i
), by_t AS (SELECT x, s1_id, i, {reached} FROM open_pairs CROSS JOIN t_levels GROUP BY x, s1_id, i
), by_s AS (SELECT x, s1_id, src, i, {reached} FROM open_pairs CROSS JOIN s_levels GROUP BY x, s1_id, src, i
), ent AS (SELECT s1_id, fold, coalesce(n, 0) AS n_true FROM folds LEFT JOIN (SELECT s1_id, count(DISTINCT t_id) AS n FROM truth GROUP BY s1_id) USING (s1_id)
), exps AS (
  SELECT x * {half} + {t + g * g} + i AS g, s1_id, t_id, y, CASE WHEN x = 0 OR best THEN pow(p, gamma) ELSE 0 END AS q
  FROM (SELECT 0 AS x, * FROM best_of UNION ALL SELECT 1, * FROM best_of) CROSS JOIN (SELECT unnest({_listed(DECISION.expected_f_gamma_grid)}) AS gamma, unnest(range({e})) AS i)
), exp_ranked AS (SELECT g, s1_id, q, y, row_number() OVER (PARTITION BY g, s1_id ORDER BY q DESC, t_id) AS r FROM exps
), {expected_counts('exp_ranked', 'exp_k')}, every AS (SELECT x, i FROM (SELECT unnest([0, 1]) AS x) CROSS JOIN t_levels
), all_counts AS (
  SELECT fold, x * {half} + i AS policy, n_true, coalesce(n_pred, 0) AS n_pred, coalesce(tp, 0) AS tp FROM ent CROSS JOIN every LEFT JOIN by_t USING (s1_id, x, i)
  UNION ALL SELECT fold, x.x * {half} + {t} + a.i * {g} + b.i, n_true, coalesce(p.n_pred, 0) + coalesce(q.n_pred, 0), coalesce(p.tp, 0) + coalesce(q.tp, 0)
  FROM ent CROSS JOIN (SELECT unnest([0, 1]) AS x) x CROSS JOIN s_levels a CROSS JOIN s_levels b LEFT JOIN by_s p ON p.s1_id = ent.s1_id AND p.x = x.x AND p.src = 'S2' AND p.i = a.i
    LEFT JOIN by_s q ON q.s1_id = ent.s1_id AND q.x = x.x AND q.src = 'S3' AND q.i = b.i
  UNION ALL SELECT fold, policy, n_true, coalesce(k, 0), coalesce(tp, 0) FROM ent CROSS JOIN (SELECT policy FROM listed WHERE family = 'expected_f') l LEFT JOIN exp_k ON exp_k.s1_id = ent.s1_id AND exp_k.g = l.policy
), grid AS MATERIALIZED (SELECT fold, CAST(policy AS INTEGER) AS policy, sum({f}) AS f FROM all_counts GROUP BY fold, policy
), fold_n AS (SELECT fold, count(*) AS size FROM folds GROUP BY fold), totals AS (SELECT policy, sum(f) AS total FROM grid GROUP BY policy
), macro AS (SELECT l.*, round(total / (SELECT count(*) FROM folds), 12) AS macro_f FROM listed l JOIN totals t ON l.policy = t.policy
), policy_table AS (
  SELECT policy AS number, description AS policy, family, exclusive, macro_f,
    row_number() OVER (ORDER BY macro_f >= (SELECT max(macro_f) FROM macro) - {DECISION.tolerance} DESC, simplicity, macro_f DESC, policy) = 1 AS chosen FROM macro
), rest AS (
  SELECT fold, g.policy, simplicity, f, round((total - f) / ((SELECT count(*) FROM folds) - size), 12) AS rest FROM grid g JOIN totals t ON g.policy = t.policy JOIN fold_n USING (fold) JOIN listed l ON l.policy = g.policy
), near_rest AS (SELECT *, rest >= max(rest) OVER (PARTITION BY fold) - {DECISION.tolerance} AS near FROM rest
), crossfit AS (
  SELECT round(sum(f) / (SELECT count(*) FROM folds), 9) AS crossfit FROM (SELECT f, row_number() OVER (PARTITION BY fold ORDER BY near DESC, simplicity, rest DESC, policy) AS r FROM near_rest) WHERE r = 1)"""
