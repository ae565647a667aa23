"""DuckDB SQL for the same results, written on its own: common parts first, then one text a query."""

from __future__ import annotations

import re

from spanweave.functions.text import PUNCTUATION, ZERO_WIDTH
from spanweave.operators.coverage import CUES, LEAST_SUPPORT
from spanweave.operators.templates import SLOT
from spanweave.plans.derive import DECLARED, DECOYS, KINDS, ODD_TEMPLATES, PANEL, SEED, SOURCE_TARGETS, SWITCHES, TEMPLATES
from spanweave.schema import BUCKETS, ENTITY_TYPES, LABELS
from spanweave.sources.records import EDGE_CASES

_Z = r"[\x{200b}\x{200c}\x{200d}\x{2060}\x{feff}\x{ad}]"
_C = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
_W = r"[ \t\n\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def clean(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(regexp_replace({x}, '{_Z}', '', 'g'), '{_C}', '', 'g'), '{_W}', ' ', 'g'), ' ')"


def h(*parts: object) -> str:
    """parts: 'text' literals in quotes, column names bare."""
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(map(str, parts))})), 1, 8))::BIGINT"


def u(*parts: object) -> str:
    return f"(({h(*parts)} + 0.5) / 4294967296.0::DOUBLE)"


def _list(values, quote: bool = True) -> str:
    return "[" + ", ".join(f"'{v}'" if quote else str(v) for v in values) + "]"


def sql(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


RECORDS = f"""
records AS (SELECT doc_id AS record_id, coalesce(text, '') AS raw, {clean("coalesce(text, '')")} AS text, source, lang,
  CASE WHEN {h("'split'", "doc_id")} % 10 < 5 THEN 'dev' WHEN {h("'split'", "doc_id")} % 10 < 9 THEN 'test' ELSE 'edge_case' END AS split FROM documents)"""
TOKENS = (
    RECORDS
    + """,
words AS (SELECT record_id, unnest(w) AS token, unnest(range(len(w))) AS tok_idx FROM (SELECT record_id, string_split(text, ' ') AS w FROM records)),
tok AS MATERIALIZED (SELECT record_id, tok_idx, c0, c0 + length(token) AS c1, token FROM (SELECT *, coalesce(sum(length(token) + 1) OVER
  (PARTITION BY record_id ORDER BY tok_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS c0 FROM words) WHERE length(token) > 0)"""
)
GOLD = (
    TOKENS
    + f""",
drawn AS (SELECT *, {h("'ent'", "record_id", "tok_idx")} % 20 AS k FROM tok),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY record_id ORDER BY tok_idx) AS run FROM
  (SELECT *, CASE WHEN k IS DISTINCT FROM lag(k) OVER (PARTITION BY record_id ORDER BY tok_idx) THEN 1 ELSE 0 END AS fresh FROM drawn)),
gold AS MATERIALIZED (SELECT record_id, min(c0) AS s, max(c1) AS e, {_list(t for t, _ in KINDS)}[min(k) + 1] AS type, CASE WHEN min(k) = 4 THEN 'NEG' ELSE 'POS' END AS polarity,
  string_agg(token, ' ' ORDER BY tok_idx) AS text FROM runs WHERE k < 5 GROUP BY record_id, run)"""
)
OVER = (
    GOLD
    + f""",
spans AS (SELECT record_id, s, e, type, polarity FROM gold UNION ALL
  SELECT record_id, s + 1, e + 6, 'ORG', 'POS' FROM gold WHERE {h("'over'", "record_id", "s")} % 5 = 0)"""
)
PRED = (
    GOLD
    + f""",
pred AS (SELECT record_id, s, CASE WHEN m = 1 AND e - s > 1 THEN e - 1 ELSE e END AS e, type,
  CASE WHEN m = 2 AND type = 'COMMODITY' THEN CASE polarity WHEN 'NEG' THEN 'POS' ELSE 'NEG' END ELSE polarity END AS polarity
  FROM (SELECT *, {h("'pred'", "record_id", "s")} % 20 AS m FROM gold) WHERE m > 0)"""
)
_NAME = "CASE WHEN polarity = 'NEG' THEN 'NEG_' ELSE '' END || type"
_LABELS = _list(LABELS)


def encoded(spans: str, name: str) -> str:
    """A CTE of tokens with label_id from a CTE of spans; tokens meet spans by stretches of 64 characters, not by record."""
    return f"""
{name}_t AS MATERIALIZED (SELECT record_id, tok_idx, c0, c1, unnest(range(c0 // 64, (c1 - 1) // 64 + 1)) AS cell FROM tok),
{name}_s AS MATERIALIZED (SELECT *, unnest(range((s // 64)::BIGINT, ((e - 1) // 64 + 1)::BIGINT)) AS cell FROM {spans}),
{name}_p AS MATERIALIZED (SELECT t.record_id, tok_idx, s, e, type, polarity FROM {name}_t t JOIN {name}_s g ON g.record_id = t.record_id AND g.cell = t.cell
  WHERE c0 < e AND c1 > s AND t.cell = greatest(c0, s) // 64),
{name}_b AS MATERIALIZED (SELECT record_id, tok_idx, arg_max(CASE WHEN nth = 1 THEN 'B-' ELSE 'I-' END || name, o) AS label FROM (
  SELECT record_id, tok_idx, {_NAME} AS name, row_number() OVER (PARTITION BY record_id, s, e, type, polarity ORDER BY tok_idx) AS nth,
    row_number() OVER (PARTITION BY record_id, tok_idx ORDER BY s, e, type, polarity) AS o FROM {name}_p) GROUP BY record_id, tok_idx),
{name} AS MATERIALIZED (SELECT t.record_id, t.tok_idx, t.c0, t.c1, coalesce(list_position({_LABELS}, b.label) - 1, 0)::BIGINT AS label_id
  FROM tok t LEFT JOIN {name}_b b ON b.record_id = t.record_id AND b.tok_idx = t.tok_idx)"""


def decoded(labels: str, name: str, strict: bool = False, key: str = "record_id") -> str:
    """A CTE of spans from a CTE of tokens with label_id; key: the columns that name a sequence."""
    return f"""
{name}_l AS (SELECT {key}, tok_idx, c0, c1, coalesce({_LABELS}[CASE WHEN label_id BETWEEN 0 AND 10 THEN label_id + 1 END], 'O') AS label FROM {labels} WHERE label_id <> -100),
{name}_o AS (SELECT *, CASE WHEN label[1] = 'B' OR label[1] = 'I' AND (p IS NULL OR p = 'O' OR p[3:] <> label[3:]) THEN 1 ELSE 0 END AS opens FROM
  (SELECT *, lag(label) OVER (PARTITION BY {key} ORDER BY tok_idx) AS p FROM {name}_l)),
{name}_i AS (SELECT *, sum(opens) OVER (PARTITION BY {key} ORDER BY tok_idx) AS island FROM {name}_o),
{name} AS (SELECT {key}, s, e, replace(kind, 'NEG_', '') AS type, CASE WHEN kind LIKE 'NEG_%' THEN 'NEG' ELSE 'POS' END AS polarity FROM
  (SELECT {key}, min(c0) AS s, max(c1) AS e, min(label[3:]) AS kind, arg_min(label[1], tok_idx) AS first FROM {name}_i WHERE label <> 'O' GROUP BY {key}, island)
  {"WHERE first = 'B'" if strict else ""})"""


LABELLED = GOLD + "," + encoded("gold", "lab")
BROKEN = (
    LABELLED
    + f""",
odd AS (SELECT record_id, tok_idx, c0, c1, CASE WHEN b = 0 AND label_id % 2 = 1 THEN label_id + 1 WHEN b = 1 THEN -100 WHEN b = 2 THEN 99 ELSE label_id END AS label_id
  FROM (SELECT *, {h("'break'", "record_id", "tok_idx")} % 12 AS b FROM lab))"""
)
PROBS = (
    LABELLED
    + f""",
prob AS (SELECT record_id, tok_idx, c0, c1, (label_id + CASE WHEN {h("'peak'", "record_id", "tok_idx")} % 8 = 0 THEN 1 ELSE 0 END) % 11 AS best,
  round(0.5 + {u("'prob'", "record_id", "tok_idx")} * 0.49, 6) AS top FROM lab)"""
)
_BUCKET = "CASE WHEN type = 'COMMODITY' THEN 'COMMODITY(' || polarity || ')' ELSE type END"
_DIM = f"(SELECT unnest({_list(BUCKETS)}) AS bucket)"


def scored(counts: str) -> str:
    """Scores from a CTE (bucket, tp, fp, fn)."""
    p = "CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0 END"
    r = "CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0 END"
    return f"""SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM
  (SELECT *, {p} AS precision, {r} AS recall, tp + fn AS support, tp + fp AS pred_count FROM {counts})"""


def matches(pred: str, gold: str = "gold") -> str:
    """CTEs hit and counted: true and false finds by bucket, every bucket listed."""
    cols = "record_id, s, e, type, polarity"
    return f"""
hit AS (SELECT coalesce(p.type, g.type) AS type, coalesce(p.polarity, g.polarity) AS polarity, p.s IS NOT NULL AS is_p, g.s IS NOT NULL AS is_g
  FROM (SELECT DISTINCT {cols} FROM {pred}) p FULL JOIN (SELECT DISTINCT {cols} FROM {gold}) g USING ({cols})),
counted AS (SELECT bucket, count(*) FILTER (WHERE is_p AND is_g) AS tp, count(*) FILTER (WHERE is_p AND NOT is_g) AS fp, count(*) FILTER (WHERE is_g AND NOT is_p) AS fn
  FROM {_DIM} LEFT JOIN (SELECT *, {_BUCKET} AS bucket FROM hit) USING (bucket) GROUP BY bucket),
report AS ({scored("(SELECT * FROM counted UNION ALL SELECT 'micro', sum(tp)::BIGINT, sum(fp)::BIGINT, sum(fn)::BIGINT FROM counted)")})"""


POOLS = f"""
entity_pools AS (SELECT entity_type, value, count(*)::DOUBLE AS weight FROM (
  SELECT 'PERSON' AS entity_type, c_name AS value FROM customer UNION ALL SELECT 'ORG', s_name FROM supplier UNION ALL
  SELECT 'ADDRESS', n_name || ', ' || r_name FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT 'COMMODITY', p_name FROM part) GROUP BY ALL),
decoy_pools AS (SELECT * FROM (VALUES {", ".join(f"({sql(a)}, {sql(b)}, {w}::DOUBLE)" for a, b, w in DECOYS)}) t(slot_name, value, weight)),
templates AS (SELECT * FROM (VALUES {", ".join(f"({sql(t)}, {w}::DOUBLE)" for t, w in TEMPLATES)}) t(template, weight)),
pools AS (SELECT entity_type AS pool, value, weight FROM entity_pools UNION ALL SELECT 'decoy:' || slot_name, value, weight FROM decoy_pools UNION ALL SELECT 'template', template, weight FROM templates),
cdf AS (SELECT pool, value, sum(weight) OVER o - weight AS lo, sum(weight) OVER o AS hi, sum(weight) OVER (PARTITION BY pool) AS total, count(*) OVER (PARTITION BY pool) AS n
  FROM pools WINDOW o AS (PARTITION BY pool ORDER BY md5(value)[1:3], value))"""


def _slots(templates=TEMPLATES) -> list[tuple]:
    """(template, idx, before, pool, entity type, polarity, sub, nth of its type) of the templates."""
    out = []
    for t, _ in templates:
        at, seen = 0, {}
        for k, m in enumerate(re.finditer(SLOT, t)):
            kind, sub = m[1], m[3]
            typ = None if kind == "decoy" else kind.upper().removeprefix("NEG_")
            seen[typ] = seen.get(typ, 0) + 1
            pol = None if typ is None else "NEG" if kind.upper().startswith("NEG_") else "POS"
            out.append((t, k, t[at : m.start()], f"decoy:{sub}" if typ is None else typ, typ, pol, sub if typ is None else None, seen[typ]))
            at = m.end()
        out.append((t, 99, t[at:], None, None, None, None, 0))
    return out


def _value(x: object) -> str:
    return "NULL" if x is None else sql(x) if isinstance(x, str) else str(x)


def _rounds(templates) -> str:
    """CTEs r1, r2, ... that draw the k-th value of a type with those before it left out; picked has them all."""
    most = max(r[7] for r in _slots(templates))
    look = "ASOF JOIN cdf c ON d.pool = c.pool AND d.at >= c.lo"
    parts = [
        f"""r1 AS (SELECT d.record_id, d.slot_idx, d.entity_type, [{{'lo': c.lo, 'hi': c.hi}}] AS used, c.value FROM
  (SELECT t.record_id, s.*, {u(SEED, "record_id", "slot_idx")} * total AS at FROM chosen t JOIN slots s USING (template) JOIN (SELECT DISTINCT pool, total FROM cdf) USING (pool) WHERE nth = 1 OR entity_type IS NULL) d {look})"""
    ]
    for k in range(2, most + 1):
        free = f"{u(SEED, 't.record_id', 's.slot_idx')} * (total - CASE WHEN {k} > n THEN 0 ELSE list_sum(list_transform(p.used, lambda x: x.hi - x.lo)) END)"
        steps = f"list_reduce(list_prepend({{'lo': {free}, 'hi': 0::DOUBLE}}, CASE WHEN {k} > n THEN [] ELSE list_sort(p.used) END), lambda a, x: {{'lo': CASE WHEN a.lo >= x.lo THEN greatest(a.lo + (x.hi - x.lo), x.hi) ELSE a.lo END, 'hi': 0::DOUBLE}}).lo"
        parts.append(
            f"""r{k} AS (SELECT d.record_id, d.slot_idx, d.entity_type, list_append(d.used, {{'lo': c.lo, 'hi': c.hi}}) AS used, c.value FROM
  (SELECT t.record_id, s.*, p.used, {steps} AS at FROM chosen t JOIN slots s USING (template) JOIN r{k - 1} p ON p.record_id = t.record_id AND p.entity_type = s.entity_type
   JOIN (SELECT DISTINCT pool, total, n FROM cdf) z ON z.pool = s.pool WHERE nth = {k}) d {look})"""
        )
    return ",\n".join(parts) + ",\npicked AS (" + " UNION ALL ".join(f"SELECT record_id, slot_idx, value FROM r{k}" for k in range(1, most + 1)) + ")"


SLOTS = f"""
slots AS (SELECT * FROM (VALUES {", ".join("(" + ", ".join(map(_value, r)) + ")" for r in _slots())}) t(template, slot_idx, before, pool, entity_type, polarity, sub, nth))"""
DRAWN = (
    POOLS
    + f""",
tdraw AS (SELECT o_orderkey AS record_id, 'template' AS pool, {u(SEED, "o_orderkey", "'template'")} AS x FROM orders),
chosen AS (SELECT d.record_id, c.value AS template FROM (SELECT d.*, x * total AS at FROM tdraw d JOIN (SELECT DISTINCT pool, total FROM cdf) USING (pool)) d ASOF JOIN cdf c ON d.pool = c.pool AND d.at >= c.lo)"""
)
FILLED = (
    DRAWN
    + ","
    + SLOTS
    + f""",
{_rounds(TEMPLATES)},
pieces AS (SELECT record_id, s.*, coalesce(value, '') AS value FROM chosen JOIN slots s USING (template) LEFT JOIN picked USING (record_id, slot_idx)),
placed AS (SELECT *, (sum(length(before) + length(value)) OVER (PARTITION BY record_id ORDER BY slot_idx) - length(value))::BIGINT AS s FROM pieces),
made AS (SELECT record_id, any_value(template) AS template, string_agg(before || value, '' ORDER BY slot_idx) AS text FROM placed GROUP BY record_id),
ents AS (SELECT record_id, entity_type AS type, value, s, s + length(value) AS e, polarity FROM placed WHERE entity_type IS NOT NULL),
cues AS (SELECT record_id, value, s, s + length(value) AS e FROM placed WHERE sub IN ('neg_cue', 'contrast_cue')),
held AS (SELECT record_id, s, e FROM ents UNION ALL SELECT record_id, s, e FROM cues),
chars AS (SELECT record_id, unnest(c) AS c, unnest(range(len(c))) AS i FROM (SELECT record_id, string_split(text, '') AS c FROM made)),
free AS (SELECT c.*, EXISTS (SELECT 1 FROM held WHERE held.record_id = c.record_id AND s <= i AND i < e) AS held FROM chars c)"""
)
MAP = (
    RECORDS
    + """,
codes AS (SELECT record_id, unnest(c) AS c, unnest(range(len(c))) AS i FROM (SELECT record_id, string_split(raw, '') AS c FROM records WHERE raw <> '')),
kinds AS (SELECT record_id, i, CASE WHEN regexp_matches(c, '^"""
    + _W
    + "') THEN 1 WHEN regexp_matches(c, '"
    + _Z
    + "|"
    + _C
    + """') THEN 0 ELSE 2 END AS k FROM codes),
alive AS (SELECT *, lag(k, 1, 1) OVER (PARTITION BY record_id ORDER BY i) AS p FROM kinds WHERE k > 0),
kept AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY i DESC) AS r FROM alive WHERE NOT (k = 1 AND p = 1)),
map AS MATERIALIZED (SELECT record_id, i, row_number() OVER (PARTITION BY record_id ORDER BY i) - 1 AS n FROM kept WHERE NOT (r = 1 AND k = 1))"""
)
#: Gold spans in original coordinates: both ends are looked up in one join with the map.
_MOVED = f"""{GOLD}, {MAP.replace(RECORDS + ",", "").lstrip()},
ends AS MATERIALIZED (SELECT record_id, s, e, s AS n, TRUE AS first FROM gold UNION ALL SELECT record_id, s, e, e - 1, FALSE FROM gold),
moved AS MATERIALIZED (SELECT ends.record_id, s, e, min(i) FILTER (WHERE first) AS "start", min(i) FILTER (WHERE NOT first) + 1 AS "end"
  FROM ends JOIN map ON map.record_id = ends.record_id AND map.n = ends.n GROUP BY ALL)"""
_LEN = "CASE WHEN n <= 3 THEN 'XS' WHEN n <= 10 THEN 'S' WHEN n <= 25 THEN 'M' WHEN n <= 60 THEN 'L' WHEN n <= 120 THEN 'XL' ELSE 'XXL' END"
_TOKEN_SET = "list_sort(list_distinct(list_filter(string_split(lower({0}), ' '), lambda t: t <> '')))"
_PER = """
per AS (SELECT r.record_id, count(g.s) AS n, count(*) FILTER (WHERE type = 'COMMODITY' AND polarity = 'POS') AS pos, count(*) FILTER (WHERE polarity = 'NEG') AS neg
  FROM records r LEFT JOIN gold g USING (record_id) GROUP BY r.record_id)"""


def _switched() -> str:
    """The map and the cleaned text for each set of switches, character by character."""
    rare, mapped = "^[\\x0b\\x0c\\x1c-\\x1f]", "^[\\t\\x0b\\x0c\\r\\x{a0}\\x{2007}\\x{202f}\\x{3000}]"
    one = []
    for name, c in SWITCHES.items():
        gone = " OR ".join([*(["z"] if c.strip_zero_width else []), *(["ctl"] if c.strip_control_chars else []), "FALSE"])
        shown = "CASE WHEN w THEN ' ' ELSE c END" if c.collapse_whitespace else "CASE WHEN mapped THEN ' ' ELSE c END" if c.normalize_whitespace else "c"
        run = "w AND coalesce(lag(w) OVER o, FALSE)" if c.collapse_whitespace else "FALSE"
        inside = "(left_ok AND right_ok)" if c.trim else "TRUE"
        one.append(f"""SELECT record_id, '{name}' AS switches, i, shown FROM (SELECT *, {shown} AS shown, {run} AS again,
  bool_or(NOT w) OVER (PARTITION BY record_id ORDER BY i) AS left_ok, bool_or(NOT w) OVER (PARTITION BY record_id ORDER BY i DESC) AS right_ok
  FROM flags WHERE NOT ({gone}) WINDOW o AS (PARTITION BY record_id ORDER BY i)) WHERE NOT again AND {inside}""")
    return f"""WITH {RECORDS},
codes AS (SELECT record_id, unnest(c) AS c, unnest(range(len(c))) AS i FROM (SELECT record_id, string_split(raw, '') AS c FROM records WHERE raw <> '')),
flags AS (SELECT record_id, i, c, regexp_matches(c, '^{_W}') OR regexp_matches(c, '{rare}') AS w, regexp_matches(c, '{_Z}') AS z, regexp_matches(c, '{_C}') AS ctl, regexp_matches(c, '{mapped}') AS mapped FROM codes),
every AS ({" UNION ALL ".join(one)}),
told AS (SELECT record_id, switches, count(*) AS n, md5(string_agg(i::VARCHAR, ',' ORDER BY i)) AS map_md5, md5(string_agg(shown, '' ORDER BY i)) AS text_md5 FROM every GROUP BY ALL)
SELECT record_id, switches, coalesce(n, 0) AS n, coalesce(map_md5, md5('')) AS map_md5, coalesce(text_md5, md5('')) AS text_md5
FROM records CROSS JOIN (SELECT unnest({_list(SWITCHES)}) AS switches) LEFT JOIN told USING (record_id, switches)"""


def _cue_tests(lagged: bool = False) -> list[str]:
    """A condition for each cue that it ends here; lagged: the words before are columns w1, w2."""
    word = lambda k: "w" if not k else f"w{k}" if lagged else f"lag(w, {k}) OVER o"
    return [" AND ".join(f"{word(k)} = {sql(p)}" for k, p in enumerate(c.split()[::-1])) for c in CUES]


def _cues() -> str:
    return " OR ".join(f"({t})" for t in _cue_tests())


def _served() -> str:
    """The toy scorer's entities: tokens with a digit, else with a capital in front, of the first 500 characters and 256 tokens."""
    short = "records AS (SELECT doc_id AS record_id, substr(coalesce(text, ''), 1, 500) AS raw, " + clean("substr(coalesce(text, ''), 1, 500)") + " AS text FROM documents)"
    tokens = TOKENS[TOKENS.index("words AS") :]
    return f"""WITH {short}, {tokens}, {MAP[MAP.index("codes AS") :]},
hit AS MATERIALIZED (SELECT record_id, c0, c1, CASE WHEN regexp_matches(token, '\\p{{Nd}}') THEN 'COMMODITY' ELSE 'PERSON' END AS type FROM tok
  WHERE tok_idx < 256 AND (regexp_matches(token, '\\p{{Nd}}') OR regexp_matches(token, '^\\p{{Lu}}'))),
ends AS MATERIALIZED (SELECT record_id, c0, type, c0 AS n, TRUE AS first FROM hit UNION ALL SELECT record_id, c0, type, c1 - 1, FALSE FROM hit),
found AS MATERIALIZED (SELECT ends.record_id, type, min(i) FILTER (WHERE first) AS s, min(i) FILTER (WHERE NOT first) + 1 AS e FROM ends JOIN map ON map.record_id = ends.record_id AND map.n = ends.n GROUP BY ends.record_id, c0, type)
SELECT r.record_id, type, substr(raw, (s + 1)::INT, (e - s)::INT) AS text, s AS start, e AS "end", CASE WHEN s IS NOT NULL THEN 'POS' END AS polarity FROM records r LEFT JOIN found f ON f.record_id = r.record_id"""


def _relocated() -> str:
    """Each surface from the end of its type's last one: one fold over a record's list, then one over what it found."""
    kinds = ("PERSON", "ORG", "ADDRESS", "COMMODITY")
    now = "CASE x.type " + " ".join(f"WHEN '{k}' THEN a.c{i}" for i, k in enumerate(kinds)) + " END"
    exact, low = f"instr(substr(text, {now} + 1), x.text)", f"instr(substr(low, {now} + 1), lower(x.text))"
    at = f"CASE WHEN {exact} > 0 THEN {now} + {exact} - 1 WHEN {low} > 0 THEN {now} + {low} - 1 ELSE -1 END"
    place = f"{{'at': {at}, 'type': x.type, 'n': length(x.text)}}"
    moved = ", ".join(f"'c{i}': CASE WHEN y.at >= 0 AND y.type = '{k}' THEN y.at + y.n ELSE a.c{i} END" for i, k in enumerate(kinds))
    step = f"list_transform([{place}], lambda y: {{{moved}, 'found': CASE WHEN y.at >= 0 THEN list_append(a.found, {{'s': y.at, 'e': y.at + y.n, 'i': len(a.found), 'type': y.type}}) ELSE a.found END}})[1]"
    none = "[]::STRUCT(s BIGINT, e BIGINT, i BIGINT, type VARCHAR)[]"
    keep = "CASE WHEN y.s >= a.top THEN {'top': y.e, 'kept': list_append(a.kept, y)} ELSE a END"
    return f"""WITH {GOLD}, asked AS (SELECT record_id, list({{'type': type, 'text': CASE WHEN s % 3 = 0 AND NOT contains(text, chr(223)) THEN upper(text) ELSE text END}} ORDER BY s) AS ents FROM gold GROUP BY record_id),
both_ AS MATERIALIZED (SELECT record_id, text, lower(text) AS low, ents FROM asked JOIN records USING (record_id)),
first AS MATERIALIZED (SELECT record_id, text, len(ents) AS n, list_sort(list_reduce(ents, lambda a, x: {step}, {{'c0': 0::BIGINT, 'c1': 0::BIGINT, 'c2': 0::BIGINT, 'c3': 0::BIGINT, 'found': {none}}}).found) AS found FROM both_),
second AS MATERIALIZED (SELECT record_id, text, n, list_reduce(found, lambda a, y: {keep}, {{'top': 0::BIGINT, 'kept': {none}}}).kept AS kept FROM first)
SELECT record_id, n - len(kept) AS n_skipped, k.type, k.s AS start, k.e AS "end", substr(text, (k.s + 1)::INT, (k.e - k.s)::INT) AS text
FROM (SELECT record_id, text, n, kept, unnest(CASE WHEN len(kept) > 0 THEN kept ELSE [NULL] END) AS k FROM second)"""


def _breaches() -> str:
    known = "(SELECT DISTINCT slot_name FROM decoy_pools)"
    odd = ", ".join(f"({_value(r[0])}, {_value(r[4])}, {_value(r[6])})" for r in _slots((*TEMPLATES, *ODD_TEMPLATES)) if r[3])
    return f"""WITH {POOLS}, s AS (SELECT * FROM (VALUES {odd}) t(template, entity_type, sub)), held AS (SELECT DISTINCT entity_type FROM entity_pools WHERE entity_type <> 'ADDRESS')
SELECT 'empty entity pool' AS breach, t AS subject FROM (SELECT unnest({_list(ENTITY_TYPES)}) AS t) WHERE t NOT IN (SELECT entity_type FROM held)
UNION ALL SELECT 'missing decoy pool', t FROM (SELECT unnest({_list(DECLARED)}) AS t) WHERE t NOT IN {known}
UNION ALL SELECT 'undeclared decoy pool', slot_name FROM {known} WHERE slot_name NOT IN {tuple(DECLARED)!r}
UNION ALL SELECT DISTINCT 'decoy without a name', template FROM s WHERE entity_type IS NULL AND sub IS NULL
UNION ALL SELECT DISTINCT 'unknown decoy', sub || ': ' || template FROM s WHERE sub IS NOT NULL AND sub NOT IN {known}
UNION ALL SELECT DISTINCT 'unknown entity type', entity_type || ': ' || template FROM s WHERE entity_type NOT IN {ENTITY_TYPES!r}"""


_CHOPPED = r"regexp_replace(text, '\s+\S+\s*$', '')"

PART_TEMPLATES = """
forms AS (SELECT p_partkey % 3 AS form, p_name, CASE p_partkey % 3 WHEN 0 THEN '{PERSON} orders ' || p_name || ' from {ORG}' WHEN 1 THEN p_name || ' for {person}: {decoy:number}, {NEG_COMMODITY#1} and {COMMODITY#2}.'
  ELSE '{{ ' || p_name || ' }} to {ADDRESS#1} - {ADDRESS#2}' END AS template FROM part),
templates AS (SELECT template, min(form) AS form, min(p_name) AS name, count(*)::DOUBLE AS weight FROM forms GROUP BY template)"""


def _part_slots() -> str:
    """By what each form is made of; {0} stands for the part's name."""
    slots = (
        (0, 0, "''", "PERSON", "PERSON", "POS", None), (0, 1, "' orders ' || name || ' from '", "ORG", "ORG", "POS", None),
        (1, 0, "name || ' for '", "PERSON", "PERSON", "POS", None), (1, 1, "': '", "decoy:number", None, None, "number"), (1, 2, "', '", "COMMODITY", "COMMODITY", "NEG", None), (1, 3, "' and '", "COMMODITY", "COMMODITY", "POS", None),
        (2, 0, "'{{ ' || name || ' }} to '", "ADDRESS", "ADDRESS", "POS", None), (2, 1, "' - '", "ADDRESS", "ADDRESS", "POS", None),
    )
    rows = [f"SELECT template, {k} AS slot_idx, {before} AS before, {', '.join(f'{_value(v)} AS {c}' for v, c in zip(rest, ('pool', 'entity_type', 'polarity', 'sub'), strict=True))} FROM templates WHERE form = {form}" for form, k, before, *rest in slots]
    return f"WITH {PART_TEMPLATES} " + " UNION ALL ".join(rows)


def _edge_cases() -> str:
    """What is expected, except that a token lends its closing marks to its span: ends move to the end of the token."""
    rows = []
    for case, text, *found in EDGE_CASES:
        for kind, surface, polarity in found:
            s = text.index(surface)
            e = next((k for k in range(s + len(surface), len(text)) if text[k].isspace() or text[k] in ZERO_WIDTH), len(text))
            rows.append(f"('{case}', {s}, {e}, '{kind}', '{polarity}', {sql(text[s:e])})")
        if not found:
            rows.append(f"('{case}', NULL, NULL, NULL, NULL, NULL)")
    return f'SELECT * FROM (VALUES {", ".join(rows)}) t("case", "start", "end", type, polarity, text)'


def _edge_classes() -> str:
    kinds = {
        "empty": "raw = ''", "blank": "raw <> '' AND text = ''", "one token": "text <> '' AND NOT contains(text, ' ')", "dash": r"regexp_matches(text, '[\x{2013}\x{2014}]')", "hyphen": "regexp_matches(text, '[A-Za-z]-[A-Za-z]')",
        "negation": "regexp_matches(lower(text), '(^| )(no|not|without|does not contain)( |$)')", "cleaned": "raw <> text", "long": "length(text) > 500",
    }
    return f"WITH {RECORDS} " + " UNION ALL ".join(f"SELECT '{k}' AS case_, count(*) FILTER (WHERE {test}) AS records FROM records" for k, test in kinds.items())


def _jaccard(left: str, right: str) -> str:
    return f"""
ls AS (SELECT DISTINCT {_TOKEN_SET.format("text")} AS t FROM {left}), rs AS (SELECT DISTINCT {_TOKEN_SET.format("text")} AS t FROM {right}),
lt AS (SELECT md5(array_to_string(t, ' ')) AS left_set, len(t) AS ln, unnest(t) AS w FROM ls), rt AS (SELECT md5(array_to_string(t, ' ')) AS right_set, len(t) AS rn, unnest(t) AS w FROM rs),
common AS (SELECT left_set, right_set, ln, rn, count(*) AS c FROM lt JOIN rt USING (w) WHERE ln >= 0.9 * rn - 1e-9 AND rn >= 0.9 * ln - 1e-9 GROUP BY ALL)
SELECT left_set, right_set, round(c / (ln + rn - c)::DOUBLE, 6) AS jaccard FROM common WHERE c / (ln + rn - c)::DOUBLE >= 0.9 - 1e-12"""


def _noised(gate: str, char: str, keep: str = "TRUE") -> str:
    return f"""WITH {FILLED},
told AS (SELECT record_id, string_agg({char}, '' ORDER BY i) FILTER (WHERE {keep}) AS t FROM free GROUP BY record_id)
SELECT record_id, CASE WHEN {gate} THEN coalesce(t, '') ELSE text END AS text FROM made LEFT JOIN told USING (record_id)"""


def _gates(n: int = 100) -> str:
    """CTEs of the counts for every pair of thresholds of a kind: cell(kind, b, i, tp, pred), and sup(kind, support).

    A span of a run exists for an interval of the thresholds of its I- label, between its own least probability and those
    beside it, and for an interval of that of the B- label at the run's head; it is counted by adding one at its corners.
    """
    corners = ("x0, y0, 1", "x0, y1, -1", "x1, y0, -1", "x1, y1, 1")
    return f"""WITH {PROBS}, cands AS MATERIALIZED (SELECT g::INT AS cand, (g * (1 - 1.0 / {n}) / {n - 1})::FLOAT AS limit_ FROM range({n}) r(g)),
gate_t AS (SELECT *, top::FLOAT AS p, lag(best) OVER (PARTITION BY record_id ORDER BY tok_idx) AS before FROM prob),
gate_k AS (SELECT *, (best - 1) // 2 AS kind FROM gate_t WHERE best > 0),
gate_c AS (SELECT k.*, coalesce(c.cand + 1, 0) AS alive FROM gate_k k ASOF LEFT JOIN cands c ON k.p >= c.limit_),
gate_r AS (SELECT *, sum(CASE WHEN best % 2 = 1 OR before IS NULL OR before = 0 OR (before - 1) // 2 <> kind THEN 1 ELSE 0 END) OVER (PARTITION BY record_id ORDER BY tok_idx) AS run FROM gate_c),
run_ AS MATERIALIZED (SELECT record_id, min(kind) AS kind, arg_min(best, tok_idx) % 2 = 1 AS head, list(c0 ORDER BY tok_idx) AS a, list(c1 ORDER BY tok_idx) AS z, list(alive ORDER BY tok_idx) AS q FROM gate_r GROUP BY record_id, run),
ends_ AS (SELECT *, unnest(range(x, len(a) + 1)) AS y FROM (SELECT *, unnest(range(1, len(a) + 1)) AS x FROM run_)),
area AS (SELECT record_id, kind, a[x] AS s, z[y] AS e, CASE WHEN head AND x = 2 THEN q[1] ELSE 0 END AS x0, CASE WHEN head AND x = 1 THEN q[1] ELSE {n} END AS x1,
  greatest(CASE WHEN y < len(a) THEN q[y + 1] ELSE 0 END, CASE WHEN x > 1 AND NOT (head AND x = 2) THEN q[x - 1] ELSE 0 END) AS y0,
  CASE WHEN head AND x = 1 AND y = 1 THEN {n} WHEN head AND x = 1 THEN list_min(q[2:y]) ELSE list_min(q[x:y]) END AS y1 FROM ends_),
dg AS MATERIALIZED (SELECT DISTINCT record_id, s, e, type, polarity FROM gold), kinds AS (SELECT unnest({_list(BUCKETS)}) AS bucket, unnest(range({len(BUCKETS)})) AS kind),
dk AS MATERIALIZED (SELECT record_id, s, e, kind FROM dg JOIN kinds ON bucket = {_BUCKET}),
sup AS MATERIALIZED (SELECT k.kind, bucket, count(d.kind) AS support FROM kinds k LEFT JOIN dk d ON d.kind = k.kind GROUP BY k.kind, bucket),
found AS MATERIALIZED (SELECT a.kind, x0, x1, y0, y1, count(*) AS n, count(d.kind) AS ok FROM area a LEFT JOIN dk d ON d.record_id = a.record_id AND d.s = a.s AND d.e = a.e AND d.kind = a.kind WHERE x0 < x1 AND y0 < y1 GROUP BY ALL),
step_ AS MATERIALIZED (SELECT kind, b, i, sum(d * n) AS pred, sum(d * ok) AS tp FROM ({" UNION ALL ".join(f"SELECT kind, {c.split(', ')[0]} AS b, {c.split(', ')[1]} AS i, {c.split(', ')[2]} AS d, n, ok FROM found" for c in corners)}) GROUP BY kind, b, i),
wide AS (SELECT k.kind, x.cand AS b, y.cand AS i, coalesce(pred, 0) AS pred, coalesce(tp, 0) AS tp FROM kinds k CROSS JOIN cands x CROSS JOIN cands y LEFT JOIN step_ s ON s.kind = k.kind AND s.b = x.cand AND s.i = y.cand),
once AS (SELECT kind, b, i, sum(pred) OVER (PARTITION BY kind, b ORDER BY i) AS pred, sum(tp) OVER (PARTITION BY kind, b ORDER BY i) AS tp FROM wide),
cell AS MATERIALIZED (SELECT kind, b, i, (sum(pred) OVER (PARTITION BY kind, i ORDER BY b))::BIGINT AS pred, (sum(tp) OVER (PARTITION BY kind, i ORDER BY b))::BIGINT AS tp FROM once)"""


def _global(n: int = 100) -> str:
    """line(cand, f1, precision, recall, objective): one threshold for all labels."""
    return f"""{_gates(n)},
line AS MATERIALIZED (SELECT cand, f1, precision, recall, f1 AS objective FROM ({scored("(SELECT b AS cand, sum(tp) AS tp, sum(pred - tp) AS fp, (SELECT sum(support) FROM sup) - sum(tp) AS fn FROM cell WHERE b = i GROUP BY b)")}))"""


def _objectives() -> str:
    """The best of 100 thresholds for each objective, from counts by threshold and bucket."""
    kinds = {"f1_micro": "f1", "f1_macro": "macro", "f1_per_type:ORG": "org", "f1_per_type:COMMODITY(NEG)": "neg", "max_f1_at_precision_floor": "CASE WHEN precision >= 0.9 THEN f1 ELSE -1 END", "max_f1_at_recall_floor": "CASE WHEN recall >= 0.5 THEN f1 ELSE -1 END"}
    told = " UNION ALL ".join(f"SELECT '{k}' AS name, cand, round({v}, 9) AS objective FROM scores" for k, v in kinds.items())
    return f"""{_global()},
each AS (SELECT cand, bucket, f1, support FROM ({scored("(SELECT b AS cand, bucket, tp, pred - tp AS fp, sup.support - tp AS fn FROM cell JOIN sup USING (kind) WHERE b = i)")})),
scores AS MATERIALIZED (SELECT * FROM line JOIN (SELECT cand, coalesce(avg(f1) FILTER (WHERE support > 0), 0) AS macro,
  max(f1) FILTER (WHERE bucket = 'ORG') AS org, max(f1) FILTER (WHERE bucket = 'COMMODITY(NEG)') AS neg FROM each GROUP BY cand) USING (cand)),
told AS ({told})
SELECT name, arg_max(cand, (objective, -cand))::INT AS cand, max(objective) AS objective FROM told GROUP BY name"""


def _two_stages(n: int = 100) -> str:
    """The search label by label: state k holds the place of every kind's two thresholds and the best score so far."""
    out = [f"{_global(n)},\nstate0 AS MATERIALIZED (SELECT arg_max(cand, (objective, -cand)) AS g, max(objective) AS best FROM line),\nat0 AS MATERIALIZED (SELECT kind, g AS b, g AS i, best FROM kinds, state0)"]
    rows = [f"SELECT 'global' AS stage, NULL AS label, cand * (1 - 1.0 / {n}) / {n - 1} AS threshold, f1, precision, recall, objective FROM line"]
    for k in range(1, len(LABELS)):
        kind, part = divmod(k - 1, 2)
        own = ("c.b = r.cand AND c.i = a.i", "c.b = a.b AND c.i = r.cand")[part]
        counts = f"(SELECT r.cand, sum(tp) AS tp, sum(pred - tp) AS fp, (SELECT sum(support) FROM sup) - sum(tp) AS fn FROM cands r JOIN at{k - 1} a ON TRUE JOIN cell c ON c.kind = a.kind AND (CASE WHEN a.kind = {kind} THEN {own} ELSE c.b = a.b AND c.i = a.i END) GROUP BY r.cand)"
        out.append(f"line{k} AS MATERIALIZED ({scored(counts)})")
        out.append(f"state{k} AS MATERIALIZED (SELECT arg_max(cand, (f1, -cand)) AS g, max(f1) AS f1 FROM line{k})")
        new = "b" if part == 0 else "i"
        kept = f"CASE WHEN kind = {kind} AND f1 > best THEN g ELSE {new} END AS {new}"
        out.append(f"at{k} AS MATERIALIZED (SELECT kind, {kept if part == 0 else 'b'}, {kept if part else 'i'}, greatest(best, f1) AS best FROM at{k - 1}, state{k})")
        rows.append(f"SELECT 'per_label', '{LABELS[k]}', cand * (1 - 1.0 / {n}) / {n - 1}, f1, precision, recall, f1 FROM line{k}")
    every = " UNION ALL ".join(rows)
    return ",\n".join(out) + f"\nSELECT stage, label, round(threshold, 9) AS threshold, round(f1, 9) AS f1, round(precision, 9) AS precision, round(recall, 9) AS recall, round(objective, 9) AS objective FROM ({every})"


def _tree() -> str:
    """Cells digest the sums of their leaves' digests, the nodes above the nodes below them."""
    lanes = " || ' ' || ".join(f"sum(('0x' || substr(own, {15 * k + 1}, 15))::BIGINT)::VARCHAR" for k in range(4))
    up = lambda name, below, k: f"""{name} AS (SELECT split, {k} AS level, node[1:{k}] AS node, sha256(string_agg(node || ' ' || sha, chr(10) ORDER BY node)) AS sha, sum(leaves)::BIGINT AS leaves FROM {below} GROUP BY split, node[1:{k}])"""
    return f"""WITH {RECORDS}, l AS (SELECT split, md5(record_id::VARCHAR)[1:2] AS node, sha256(record_id::VARCHAR || ' ' || sha256(text)) AS own FROM records),
  n2 AS (SELECT split, 2 AS level, node, sha256({lanes}) AS sha, count(*) AS leaves FROM l GROUP BY split, node), {up("n1", "n2", 1)},
  n0 AS (SELECT split, 0 AS level, '' AS node, sha256(string_agg(node || ' ' || sha, chr(10) ORDER BY node)) AS sha, sum(leaves)::BIGINT AS leaves FROM n1 GROUP BY split)
  SELECT * FROM n2 UNION ALL SELECT * FROM n1 UNION ALL SELECT * FROM n0"""


def _panel() -> str:
    """Kappa from each pair's tokens, alpha by its textbook form: 1 - (n - 1) disagreeing coincidences / disagreeing pairs by chance."""
    votes = " UNION ALL ".join(f"SELECT record_id, tok_idx, '{w}' AS who, CASE WHEN {h(f"'{w}'", 'record_id', 'tok_idx')} % 30 = 0 THEN 0 ELSE label_id END AS label FROM lab WHERE {h("'miss'", f"'{w}'", 'record_id', 'tok_idx')} % 7 <> 0" for w in PANEL)
    return f"""WITH {LABELLED}, v AS MATERIALIZED ({votes}), p AS MATERIALIZED (SELECT a.who AS a, b.who AS b, a.label AS la, b.label AS lb, count(*) AS n FROM v a JOIN v b ON a.record_id = b.record_id AND a.tok_idx = b.tok_idx AND a.who < b.who GROUP BY ALL),
  po AS (SELECT a, b, sum(n) AS n, sum(n) FILTER (WHERE la = lb) / sum(n)::DOUBLE AS po FROM p GROUP BY a, b),
  pe AS (SELECT a, b, sum(x.n::DOUBLE * y.n) AS s FROM (SELECT a, b, la AS label, sum(n) AS n FROM p GROUP BY ALL) x JOIN (SELECT a, b, lb AS label, sum(n) AS n FROM p GROUP BY ALL) y USING (a, b, label) GROUP BY a, b),
  c AS MATERIALIZED (SELECT record_id, tok_idx, label, count(*) AS k FROM v GROUP BY ALL), u AS MATERIALIZED (SELECT record_id, tok_idx, sum(k) AS m, sum(k * k) AS same FROM c GROUP BY ALL HAVING sum(k) > 1),
  t AS (SELECT label, sum(k) AS n FROM c JOIN u USING (record_id, tok_idx) GROUP BY label), w AS (SELECT sum(n)::DOUBLE AS n, sum(n::DOUBLE * n) AS squares FROM t),
  s AS (SELECT count(*) AS units, sum((m * m - same)::DOUBLE / (m - 1)) AS apart FROM u)
  SELECT a AS annotator_a, b AS annotator_b, n::BIGINT AS units, round(po, 9) AS agreement, round((po - s / (n::DOUBLE * n)) / (1 - s / (n::DOUBLE * n)), 9) AS coefficient FROM po JOIN pe USING (a, b)
  UNION ALL SELECT 'all', 'all', units, round(1 - apart / n, 9), round(1 - (n - 1) * apart / (n * n - squares), 9) FROM s, w"""


def texts() -> dict[str, str]:
    drop = f"NOT (c IN {tuple(PUNCTUATION)!r} AND NOT held AND {u(SEED, 'record_id', chr(39) + 'punct' + chr(39), 'i')} < 0.5)"
    typo = f"CASE WHEN regexp_matches(c, '\\p{{L}}') AND NOT held AND {u(SEED, 'record_id', chr(39) + 'typo' + chr(39), 'i')} < 0.02 THEN substr('abcdefghijklmnopqrstuvwxyz', ({h(SEED, 'record_id', chr(39) + 'letter' + chr(39), 'i')} % 26 + 1)::INT, 1) ELSE c END"
    cut = f"(length(text) - 1 - {h(SEED, 'record_id', chr(39) + 'cut' + chr(39))} % 8)"
    return {
        "split_coverage": f"""WITH {GOLD} SELECT split, count(DISTINCT r.record_id) AS record_count, count(*) FILTER (WHERE type = 'PERSON') AS person_spans,
  count(*) FILTER (WHERE type = 'ORG') AS org_spans, count(*) FILTER (WHERE type = 'ADDRESS') AS address_spans,
  count(*) FILTER (WHERE type = 'COMMODITY' AND polarity = 'POS') AS commodity_pos_spans, count(*) FILTER (WHERE type = 'COMMODITY' AND polarity = 'NEG') AS commodity_neg_spans,
  count(DISTINCT r.record_id) FILTER (WHERE g.record_id IS NULL) AS zero_entity_records FROM records r LEFT JOIN gold g ON g.record_id = r.record_id GROUP BY split""",
        "pool_counts": f"WITH {POOLS} SELECT pool, count(*) AS n, sum(weight) AS weight FROM pools WHERE pool <> 'template' GROUP BY pool",
        "template_count": f"WITH {PART_TEMPLATES} SELECT count(*) AS n, sum(weight) AS weight FROM templates",
        "table_counts": f"WITH {POOLS} SELECT 'entity_pools' AS name, count(*) AS n FROM entity_pools UNION ALL SELECT 'decoy_pools', count(*) FROM decoy_pools UNION ALL SELECT 'templates', count(*) FROM templates",
        "clean_text": f"WITH {RECORDS} SELECT record_id, text, length(raw) AS original_length FROM records WHERE text <> ''",
        "truncate_input": f"WITH c AS (SELECT doc_id AS record_id, {clean('substr(coalesce(text, chr(32)), 1, 500)')} AS text FROM documents) SELECT * FROM c WHERE text <> ''",
        "content_hash_dups": f"WITH {RECORDS} SELECT sha256(text) AS content_hash, count(*) AS n, min(record_id) AS first_id, count(DISTINCT split) AS splits FROM records GROUP BY 1 HAVING count(*) > 1",
        "char_map": f"WITH {MAP} SELECT r.record_id, count(i) AS n, md5(coalesce(string_agg(i::VARCHAR, ',' ORDER BY i), '')) AS map_md5 FROM records r LEFT JOIN map USING (record_id) GROUP BY r.record_id",
        "char_map_switches": _switched(),
        "ws_tokens": f"WITH {TOKENS} SELECT record_id, tok_idx, c0, c1, token FROM tok",
        "bio_encode": f"WITH {OVER}, {encoded('spans', 'lab')} SELECT record_id, tok_idx, c0, c1, label_id FROM lab",
        "bio_decode_lenient": f'WITH {BROKEN}, {decoded("odd", "dec")} SELECT record_id, s AS start, e AS "end", type, polarity FROM dec',
        "bio_decode_strict": f'WITH {BROKEN}, {decoded("odd", "dec", strict=True)} SELECT record_id, s AS start, e AS "end", type, polarity FROM dec',
        "project_to_original": f"""WITH {_MOVED} SELECT record_id, s AS clean_start, e AS clean_end, "start", "end" FROM moved""",
        "project_to_clean": f"""WITH {_MOVED}, o AS (SELECT DISTINCT record_id, "start" AS s, "end" + 1 AS e FROM moved),
  b AS MATERIALIZED (SELECT o.*, unnest(range(s // 256, (e - 1) // 256 + 1)) AS cell FROM o), m AS MATERIALIZED (SELECT *, i // 256 AS cell FROM map)
  SELECT b.record_id, b.s AS raw_start, b.e AS raw_end, min(n) AS start, max(n) + 1 AS "end" FROM b JOIN m ON m.record_id = b.record_id AND m.cell = b.cell WHERE b.s <= m.i AND m.i < b.e GROUP BY ALL""",
        "span_eval": f"WITH {PRED}, {matches('pred')} SELECT bucket, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support, pred_count FROM report",
        "macro_f1": f"WITH {PRED}, {matches('pred')} SELECT round(coalesce(avg(f1) FILTER (WHERE support > 0), 0), 9) AS macro_f1 FROM report WHERE bucket <> 'micro'",
        "trainer_metric": f"""WITH {PROBS.replace(" best,", " label_id,")}, {decoded("prob", "dec")}, {matches("dec")} SELECT {", ".join(f"round(max({c}) FILTER (WHERE bucket = 'micro'), 9) AS {c}" for c in ("f1", "precision", "recall"))},
  {", ".join(f"round(max(f1) FILTER (WHERE bucket = '{b}'), 9) AS " + chr(34) + f"f1_{b}" + chr(34) for b in BUCKETS)} FROM report""",
        "label_support": f"WITH {GOLD} SELECT label, count(g.s) AS support FROM (SELECT unnest({_LABELS}) AS label) LEFT JOIN gold g ON label = 'B-' || {_NAME} GROUP BY label",
        "validate_records": f"""WITH {GOLD}, hurt AS (SELECT *, {h("'bad'", "record_id", "s")} % 40 AS m FROM gold), bad AS (SELECT record_id, CASE WHEN m = 0 THEN 'unknown_type' WHEN m = 1 THEN 'negative_start' WHEN m = 2 THEN 'empty_span'
  WHEN m = 3 THEN 'unknown_polarity' WHEN m = 4 AND type <> 'COMMODITY' THEN 'not_negatable' WHEN m = 5 THEN 'out_of_text' WHEN m = 6 THEN 'other_text' END AS error FROM hurt),
  placed AS (SELECT record_id, CASE WHEN m = 1 THEN -1 ELSE s END AS s, CASE WHEN m = 2 THEN s WHEN m = 5 THEN e + 10000000 ELSE e END AS e FROM hurt),
  over AS (SELECT DISTINCT record_id, 'overlap' AS error FROM (SELECT record_id, s, lag(e) OVER (PARTITION BY record_id ORDER BY s, e) AS p FROM placed) WHERE s < p)
  SELECT error, count(*) AS n FROM (SELECT * FROM bad UNION ALL SELECT * FROM over) WHERE error IS NOT NULL GROUP BY error""",
        "overlap_violations": f"WITH {OVER} SELECT DISTINCT record_id FROM (SELECT record_id, s, lag(e) OVER (PARTITION BY record_id ORDER BY s, e) AS p FROM spans) WHERE s < p",
        "constraint_violations": f"""WITH {RECORDS} SELECT 'duplicate_content_hash' AS rule, count(*) AS n FROM (SELECT 1 FROM records GROUP BY sha256(text) HAVING count(*) > 1)
  UNION ALL SELECT 'duplicate_turn', count(*) FROM (SELECT 1 FROM conversations GROUP BY conv_id, turn HAVING count(*) > 1)
  UNION ALL SELECT 'label_without_document', count(*) FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)""",
        "locked_write_conflicts": f"WITH {RECORDS} SELECT record_id FROM records WHERE split = 'test' AND {h(chr(39) + 'change' + chr(39), 'record_id')} % 7 = 0",
        "template_slots": _part_slots(),
        "unresolved_slots": f"WITH {POOLS}, {SLOTS} SELECT template, slot_idx, pool FROM slots WHERE pool IS NOT NULL AND pool NOT IN (SELECT pool FROM pools WHERE pool NOT IN ('ORG', 'decoy:number'))",
        "ordered_dedup": "SELECT source, arg_min(doc_id, doc_id) AS doc_id, arg_min(lang, doc_id) AS lang FROM documents GROUP BY source",
        "weighted_template_draw": f"WITH {DRAWN} SELECT record_id, template FROM chosen",
        "slot_fill": f"WITH {FILLED} SELECT record_id, text, template FROM made",
        "slot_entities": f'WITH {FILLED} SELECT record_id, type, value AS text, s AS start, e AS "end", polarity FROM ents',
        "preserve_spans": f'WITH {FILLED} SELECT record_id, s AS start, e AS "end", value AS text FROM cues',
        "noise_lowercase": f"WITH {FILLED} SELECT record_id, CASE WHEN {u(SEED, 'record_id', chr(39) + 'lowercase' + chr(39))} < 0.25 THEN lower(text) ELSE text END AS text FROM made",
        "noise_drop_punct": _noised(f"{u(SEED, 'record_id', chr(39) + 'drop_punct' + chr(39))} < 0.25", "c", drop),
        "noise_typo": _noised(f"{u(SEED, 'record_id', chr(39) + 'typo' + chr(39))} < 0.15", typo),
        "noise_truncate": f"""WITH {FILLED} SELECT record_id, CASE WHEN {u(SEED, "record_id", "'truncate'")} < 0.05 AND length(text) > 10
  AND NOT EXISTS (SELECT 1 FROM ents x WHERE x.record_id = m.record_id AND s < {cut} AND {cut} < e) AND NOT EXISTS (SELECT 1 FROM cues x WHERE x.record_id = m.record_id AND s <= {cut} AND {cut} < e)
  THEN substr(text, 1, {cut}) ELSE text END AS text FROM made m""",
        "argmax_decode": f'WITH {PROBS.replace(" best,", " label_id,")}, {decoded("prob", "dec")} SELECT record_id, s AS start, e AS "end", type, polarity FROM dec',
        "threshold_gate": f"""WITH {PROBS} SELECT record_id, tok_idx, CASE WHEN best > 0 AND top::FLOAT < [0.0, 0.6, 0.7, 0.8, 0.9, 0.55, 0.65, 0.75, 0.85, 0.95, 0.5][best + 1]::FLOAT THEN 0 ELSE best END AS label_id FROM prob""",
        "sweep_global": f"{_global()} SELECT cand, round(f1, 9) AS f1, round(precision, 9) AS precision, round(recall, 9) AS recall, round(objective, 9) AS objective FROM line",
        "best_threshold": f"{_global()} SELECT arg_max(cand, (objective, -cand))::INT AS cand, round(max(objective), 9) AS objective FROM line",
        "sweep_objectives": _objectives(),
        "sweep_per_label": _two_stages(),
        "length_buckets": f"WITH {GOLD} SELECT type, {_LEN} AS bucket, count(*) AS n FROM (SELECT type, e - s AS n FROM gold) GROUP BY ALL",
        "entities_per_record": f"WITH {GOLD}, {_PER} SELECT CASE WHEN n >= 5 THEN '5+' ELSE n::VARCHAR END AS entities, count(*) AS records, round(count(*) / (SELECT count(*) FROM per)::DOUBLE, 6) AS share FROM per GROUP BY 1",
        "polarity_buckets": f"""WITH {GOLD}, {_PER} SELECT CASE WHEN neg > 0 AND pos > 0 THEN 'mixed' WHEN neg > 1 THEN 'multi_target_neg' WHEN neg = 1 THEN 'neg_only' WHEN pos > 0 THEN 'pos_only' ELSE 'no_commodity' END AS bucket,
  count(*) AS records FROM per GROUP BY 1""",
        "cooccurrence": f"""WITH {GOLD}, t AS (SELECT record_id, type, count(*) AS n FROM gold GROUP BY ALL) SELECT a.type AS type_a, b.type AS type_b, count(*) AS records FROM t a JOIN t b
  ON a.record_id = b.record_id AND (a.type < b.type OR a.type = b.type AND a.n > 1) GROUP BY ALL""",
        "source_mix": f"""WITH m AS (SELECT source, count(*) AS records, round(count(*) / (SELECT count(*) FROM documents)::DOUBLE, 6) AS share FROM documents GROUP BY source),
  t AS (SELECT * FROM (VALUES {", ".join(f"('{k}', {v}::DOUBLE)" for k, v in SOURCE_TARGETS.items())}) t(source, target)) SELECT source, records, share, target, round(share - target, 6) AS gap FROM m LEFT JOIN t USING (source)""",
        "bucket_support": f"""WITH {GOLD}, w AS (SELECT * FROM (VALUES {", ".join(f"('{b}', {n}::BIGINT)" for b, n in LEAST_SUPPORT.items())}) t(bucket, least)),
  c AS (SELECT {_BUCKET} AS bucket, count(DISTINCT record_id) AS records FROM gold GROUP BY 1) SELECT bucket, least, coalesce(records, 0) AS records, coalesce(records, 0) >= least AS passes FROM w LEFT JOIN c USING (bucket)""",
        "cue_counts": f"""WITH {TOKENS}, w AS (SELECT record_id, tok_idx, lower(regexp_replace(token, '[^A-Za-z]+$', '')) AS w FROM tok), n AS (SELECT {", ".join(f"count(*) FILTER (WHERE {test}) AS c{k}" for k, test in enumerate(_cue_tests(lagged=True)))}
  FROM (SELECT w, lag(w, 1) OVER o AS w1, lag(w, 2) OVER o AS w2 FROM w WINDOW o AS (PARTITION BY record_id ORDER BY tok_idx)))
  {" UNION ALL ".join(f"SELECT {sql(c)} AS cue, c{k} AS n FROM n" for k, c in enumerate(CUES))}""",
        "manifest_drift": f"""WITH {RECORDS}, n AS (SELECT split, text FROM records), o AS (SELECT split, text FROM records WHERE split <> 'edge_case' AND NOT (split = 'test' AND record_id % 100 = 1)),
  x AS (SELECT split FROM (SELECT * FROM n EXCEPT ALL SELECT * FROM o) UNION SELECT split FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM n)) SELECT split, split IN (SELECT split FROM x) AS drifted FROM (SELECT split FROM n UNION SELECT split FROM o)""",
        "manifest_changes": f"""WITH {RECORDS}, rb AS (SELECT record_id, split, text, {h("'state'", "record_id")} % 10 AS b FROM records),
  o AS (SELECT record_id, split, CASE WHEN b = 1 THEN text || ' then' ELSE text END AS text FROM rb WHERE b <> 0 UNION ALL SELECT record_id + 1000000000, split, text FROM rb WHERE b = 2)
  SELECT split, record_id::VARCHAR AS record_id, CASE WHEN o.text IS NULL THEN 'added' WHEN r.text IS NULL THEN 'lost' ELSE 'changed' END AS change FROM o FULL JOIN records r USING (split, record_id) WHERE o.text IS DISTINCT FROM r.text""",
        "manifest_tree": _tree(),
        "leak_proof_split": f"""WITH RECURSIVE {RECORDS}, pairs AS MATERIALIZED (SELECT * FROM (WITH {_jaccard("records", "records")}) WHERE left_set > right_set),
  m AS MATERIALIZED (SELECT 'g' || (record_id // 2) AS g, CASE WHEN len(t) > 0 THEN 's' || md5(array_to_string(t, ' ')) END AS s FROM (SELECT record_id, {_TOKEN_SET.format("text")} AS t FROM records)),
  e AS MATERIALIZED (SELECT s AS a, g AS b FROM m WHERE s IS NOT NULL UNION SELECT 's' || left_set, 's' || right_set FROM pairs), f AS MATERIALIZED (SELECT a, b FROM e UNION SELECT b, a FROM e),
  reach(node, root) AS (SELECT g, g FROM m UNION SELECT f.b, reach.root FROM reach JOIN f ON reach.node = f.a),
  c AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
  SELECT 'records' AS item, count(*) AS n FROM records UNION ALL SELECT 'groups', count(DISTINCT g) FROM m UNION ALL SELECT 'similar_pairs', count(*) FROM pairs
  UNION ALL SELECT 'components', count(DISTINCT root) FROM c UNION ALL SELECT 'leaks', 0 UNION ALL SELECT 'strata_off', 0""",
        "iaa_panel": _panel(),
        "edge_cases": f"SELECT *, NULL::BIGINT AS records FROM ({_edge_cases()}) UNION ALL SELECT case_, NULL, NULL, NULL, NULL, NULL, records FROM ({_edge_classes()})",
        "score_batch": _served(),
        "seed_breaches": _breaches(),
        "relocated": _relocated(),
        "zero_entity": f"""WITH {PRED}, z AS (SELECT record_id FROM records WHERE record_id NOT IN (SELECT record_id FROM gold)), c AS (SELECT count(*) AS zero_records, count(*) FILTER (WHERE record_id IN (SELECT record_id FROM pred)) AS f FROM z)
  SELECT zero_records, f AS false_positive_records, round(CASE WHEN zero_records > 0 THEN f / zero_records::DOUBLE ELSE 0 END, 6) AS false_positive_rate FROM c""",
        "neg_pos_ratio": f"""WITH {GOLD}, c AS (SELECT count(*) FILTER (WHERE polarity = 'NEG') AS neg, count(*) FILTER (WHERE polarity = 'POS') AS pos FROM gold WHERE type = 'COMMODITY'), r AS (SELECT *, CASE WHEN pos > 0 THEN neg / pos::DOUBLE ELSE 0 END AS x FROM c)
  SELECT neg, pos, round(x, 6) AS ratio, x BETWEEN 0.15 AND 0.45 AS passes FROM r""",
        "template_coverage": f"WITH {DRAWN} SELECT t.template, count(record_id) AS records, count(record_id) >= 200 AS passes FROM templates t LEFT JOIN chosen c USING (template) GROUP BY t.template",
        "cue_distance": f"""WITH {GOLD}, w AS (SELECT *, lower(regexp_replace(token, '[^A-Za-z]+$', '')) AS w FROM tok), c AS (SELECT *, CASE WHEN {_cues()} THEN tok_idx END AS cue FROM w WINDOW o AS (PARTITION BY record_id ORDER BY tok_idx)),
  l AS (SELECT record_id, c0, tok_idx - 1 - max(cue) OVER (PARTITION BY record_id ORDER BY tok_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap FROM c)
  SELECT CASE WHEN gap IS NULL THEN 'none' WHEN gap <= 1 THEN '0-1' WHEN gap <= 4 THEN '2-4' WHEN gap <= 10 THEN '5-10' ELSE '11+' END AS distance, count(*) AS spans FROM gold g JOIN l ON l.record_id = g.record_id AND l.c0 = g.s WHERE polarity = 'NEG' GROUP BY 1""",
        "stratified_split": f"""WITH {GOLD}, t AS (SELECT record_id, type, count(*) AS n, max(CASE WHEN polarity = 'NEG' THEN 1 ELSE 0 END) AS neg FROM gold GROUP BY ALL),
  m AS (SELECT record_id, arg_max(type, (n, type)) AS main, max(neg) AS neg FROM t GROUP BY record_id),
  s AS (SELECT record_id, concat_ws('|', source, coalesce(main, 'none'), coalesce(neg, 0)) AS stratum, {h("'side'", "record_id")} AS x FROM records LEFT JOIN m USING (record_id))
  SELECT record_id, stratum, CASE WHEN row_number() OVER (PARTITION BY stratum ORDER BY x, record_id) <= ceil(count(*) OVER (PARTITION BY stratum) * 0.5) THEN 'dev' ELSE 'test' END AS side FROM s""",
        "temporal_split": """WITH l AS (SELECT max(o_orderdate) AS m FROM orders) SELECT CASE WHEN o_orderdate > (m - INTERVAL 1 MONTH)::DATE THEN 'test' WHEN o_orderdate > (m - INTERVAL 7 MONTH)::DATE THEN 'dev' ELSE 'train' END AS side, count(*) AS n,
  min(o_orderkey) AS first_order, max(o_orderdate)::DATE AS last FROM orders, l GROUP BY 1""",
        "doc_group_split": f"SELECT doc_id AS record_id, CASE WHEN {h(chr(39) + 'group' + chr(39), 'source')} % 2 = 0 THEN 'dev' ELSE 'test' END AS side FROM documents",
        "near_dup_pairs": f"WITH {RECORDS}, a AS (SELECT text FROM records WHERE split = 'dev'), b AS (SELECT text FROM records WHERE split = 'test'), {_jaccard('a', 'b')}",
        "near_dup_members": f"WITH {RECORDS} SELECT record_id, md5(array_to_string({_TOKEN_SET.format('text')}, ' ')) AS set_id FROM records",
        "benchmark_leak": f"WITH {RECORDS}, q AS (SELECT {clean('text')} AS text FROM benchmark), every AS (SELECT text FROM records UNION ALL SELECT {clean(_CHOPPED)} FROM benchmark WHERE item_id % 3 = 0), {_jaccard('q', 'every')}",
        "iaa_kappa": f"""WITH {LABELLED}, p AS (SELECT CASE WHEN {h("'A'", "record_id", "tok_idx")} % 30 = 0 THEN 0 ELSE label_id END AS a, CASE WHEN {h("'B'", "record_id", "tok_idx")} % 30 = 0 THEN 0 ELSE label_id END AS b FROM lab),
  o AS (SELECT count(*) AS n, count(*) FILTER (WHERE a = b) / count(*)::DOUBLE AS po FROM p), e AS (SELECT sum(x.n::DOUBLE * y.n) AS s FROM (SELECT a, count(*) AS n FROM p GROUP BY a) x JOIN (SELECT b, count(*) AS n FROM p GROUP BY b) y ON a = b)
  SELECT n AS tokens, round(po, 9) AS agreement, round((po - s / (n::DOUBLE * n)) / (1 - s / (n::DOUBLE * n)), 9) AS kappa FROM o, e""",
        "iaa_span_f1": f"""WITH {LABELLED}, la AS (SELECT record_id, tok_idx, c0, c1, CASE WHEN {h("'A'", "record_id", "tok_idx")} % 30 = 0 THEN 0 ELSE label_id END AS label_id FROM lab),
  lb AS (SELECT record_id, tok_idx, c0, c1, CASE WHEN {h("'B'", "record_id", "tok_idx")} % 30 = 0 THEN 0 ELSE label_id END AS label_id FROM lab), {decoded("la", "da")}, {decoded("lb", "db")}, {matches("db", "da")}
  SELECT bucket, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support, pred_count FROM report""",
        "kl_drift": """WITH e AS (SELECT strftime(ts, '%Y-%m') AS month, event_type AS token FROM events), d AS (SELECT role AS token FROM conversations UNION ALL SELECT event_type FROM events WHERE event_id % 2 = 0),
  v AS (SELECT token FROM e UNION SELECT token FROM d), q AS (SELECT v.token, (count(d.token) + 1) / ((SELECT count(*) FROM d) + (SELECT count(*) FROM v))::DOUBLE AS q FROM v LEFT JOIN d USING (token) GROUP BY v.token),
  m AS (SELECT month, count(*) AS total FROM e GROUP BY month), c AS (SELECT month, token, count(*) AS n FROM e GROUP BY ALL),
  p AS (SELECT m.month, q.q, (coalesce(n, 0) + 1) / (total + (SELECT count(*) FROM v))::DOUBLE AS p FROM m CROSS JOIN q LEFT JOIN c ON c.month = m.month AND c.token = q.token)
  SELECT month, round(sum(p * ln(p / q)), 6) AS kl, sum(p * ln(p / q)) >= 0.05 AS alarm FROM p GROUP BY month""",
        "manifest_sha": f"""WITH {RECORDS}, x AS (SELECT split, sha256(text) AS d FROM records), c AS (SELECT split, d[1:3] AS cell, sha256(string_agg(d, chr(10) ORDER BY d)) AS sha FROM x GROUP BY ALL)
  SELECT split, sha256(string_agg(sha, chr(10) ORDER BY cell)) AS manifest_sha FROM c GROUP BY split""",
        "active_learning_topk": f"WITH {PROBS} SELECT record_id, round(min(top::FLOAT)::DOUBLE, 6) AS confidence FROM prob GROUP BY record_id ORDER BY 2, 1 LIMIT 100",
        "acceptance_gates": f"""WITH {PRED}, {matches("pred")}, v AS (SELECT 'dev_size' AS gate, count(*)::DOUBLE AS value, 500::DOUBLE AS least, NULL::DOUBLE AS most FROM records WHERE split = 'dev'
  UNION ALL SELECT 'test_size', count(*), 500, NULL FROM records WHERE split = 'test'
  UNION ALL SELECT 'neg_records', count(DISTINCT record_id), 150, NULL FROM gold WHERE polarity = 'NEG'
  UNION ALL SELECT 'zero_entity_records', count(*), 100, NULL FROM records WHERE record_id NOT IN (SELECT record_id FROM gold)
  UNION ALL SELECT 'bad_offsets', count(*), NULL, 0 FROM gold g JOIN records r USING (record_id) WHERE substr(r.text, (s + 1)::INT, (e - s)::INT) <> g.text
  UNION ALL SELECT 'micro_f1', round(f1, 6), 0.9, NULL FROM report WHERE bucket = 'micro')
  SELECT gate, value, least, most, (least IS NULL OR value >= least) AND (most IS NULL OR value <= most) AS passes FROM v""",
    }
