"""DuckDB oracle SQL for every registered query (correctness gate).

Each statement is plain SQL over the driver's pre-registered views.  It is
an independent formulation (CASE chains, windows, joins against VALUES
tables) of the same semantics; the rule vocabularies come from the same
fixed-value tables as the engine, and the ``interventions`` adapter is the
same common-subset SELECT text.
"""

from __future__ import annotations

from casework.functions import rules
from casework.functions.identity import (FOREIGN_PATTERN_PARITY, NOT_GIVEN_PATTERN_PARITY,
                                         ONLY_LETTERS_PATTERN, SHORT_LETTERS_PATTERN,
                                         SYMBOLS_PATTERN_PARITY, _intended)
from casework.operators.geo import SYNTHETIC_ZONES
from casework.sources.adapter import LANDING_DATE_TEXT, interventions_sql

NO = rules.NO_ID


def lit(s: str | None) -> str:
    if s is None:
        return "NULL"
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def case_map(expr: str, d: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in d.items())
    return f"CASE {expr} {whens} ELSE {default} END"


# -- scalar expressions ---------------------------------------------------------

# FIXED VALUES: public Latin transliteration, the oracle's own copy
TRANSLITERATION = {
    "ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ð": "d", "ł": "l", "þ": "th", "ħ": "h", "ı": "i", "ŧ": "t",
    "ŋ": "ng", "ĳ": "ij", "ſ": "s", "ª": "a", "º": "o", "°": "deg", "¹": "1", "²": "2", "³": "3", "µ": "u", "×": "x",
    "©": "(c)", "®": "(r)",
}
# The letters that the query on other scripts uses.
SCRIPTS = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m", "ν": "n",
    "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps", "ω": "o",
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "к": "k", "л": "l", "м": "m",
    "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh",
    "щ": "shch", "ю": "iu",
}
# end of FIXED VALUES


def strip_blanks(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '^\s+', ''), '\s+$', '')"


def clean_name(x: str) -> str:
    s = f"strip_accents(upper(replace({x}, 'ß', 'ss')))"
    s = f"regexp_replace({s}, '[-.,]', ' ', 'g')"
    s = f"regexp_replace({s}, '[^A-Z ]', '', 'g')"
    s = f"trim(regexp_replace({s}, ' +', ' ', 'g'))"
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE nullif({s}, '') END"


def clean_outcome(x: str, scripts: bool = False) -> str:
    s = f"lower({x})"
    for a, b in TRANSLITERATION.items():
        s = f"replace({s}, {lit(a)}, {lit(b)})"
    s = f"strip_accents({s})"
    for a, b in SCRIPTS.items() if scripts else ():
        s = f"replace({s}, {lit(a)}, {lit(b)})"
    s = f"regexp_replace({s}, '[_-]', ' ', 'g')"
    s = rf"regexp_replace({s}, '[^a-z0-9\s]', ' ', 'g')"
    s = rf"trim(regexp_replace({s}, '\s+', ' ', 'g'))"
    return f"coalesce({s}, '')"


def id_parts(x: str, mode: str = "parity") -> tuple[str, str]:
    foreign, not_given, symbols = FOREIGN_PATTERN_PARITY, NOT_GIVEN_PATTERN_PARITY, SYMBOLS_PATTERN_PARITY
    if mode == "intended":
        foreign, not_given, symbols = _intended(foreign), _intended(not_given), _intended(symbols)
    s = strip_blanks(f"CAST({x} AS VARCHAR)")
    low = f"lower({s})"
    digits = rf"regexp_replace({s}, '\D', '', 'g')"
    nd = f"length({digits})"
    conds = [
        (f"{x} IS NULL", lit(NO), "nan"),
        (f"{s} = ''", lit(NO), "empty"),
        (f"regexp_matches({low}, {lit('(?i)' + not_given)})", lit(NO), "patron_no_brindo_genericos"),
        (f"(regexp_matches({s}, {lit('(?i)' + symbols)}) OR regexp_matches({s}, {lit(SHORT_LETTERS_PATTERN)}))",
         lit(NO), "simbolos_o_letras_cortas"),
        (f"(regexp_matches({s}, {lit(ONLY_LETTERS_PATTERN)}) AND length(list_distinct(string_split({low}, ''))) <= 2)",
         lit(NO), "solo_letras_repetidas"),
        (f"regexp_matches({low}, {lit('(?i)' + foreign)})", lit(rules.FOREIGN_ID), "patron_extranjero"),
        (f"({nd} >= 6 AND {nd} <= 10)", f"CAST(CAST({digits} AS BIGINT) AS VARCHAR)", "dni_valido"),
        (f"({nd} < 6 OR regexp_matches({low}, '[A-Za-z]'))", lit(NO), "texto_o_corto"),
    ]
    cat = "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v, _ in conds) + f" ELSE {lit(NO)} END"
    rsn = "CASE " + " ".join(f"WHEN {c} THEN {lit(r)}" for c, _, r in conds) + " ELSE 'resto_no_brindo' END"
    return cat, rsn


def valid_id(x: str) -> str:
    s = strip_blanks(f"CAST({x} AS VARCHAR)")
    return (f"coalesce(NOT ({s} IN {in_list(rules.INVALID_ID_TEXTS)}) AND length({s}) >= 6 "
            f"AND replace({s}, substr({s}, 1, 1), '') <> '' "
            rf"AND regexp_matches(regexp_replace({s}, '[.\-]', '', 'g'), '^[0-9]+$'), false)")


def to_district(x: str) -> str:
    v = f"TRY_CAST(replace(trim(CAST({x} AS VARCHAR)), ',', '.') AS DOUBLE)"
    return f"(CASE WHEN isnan({v}) THEN NULL ELSE {v} END)"


def week(x: str) -> str:
    return f"CAST(date_trunc('week', {x}) AS DATE)"


def rule_category(t: str) -> str:
    t2 = strip_blanks(t)
    tier2 = "CASE " + " ".join(f"WHEN contains({t2}, {lit(p)}) THEN {lit(c)}"
                               for p, c in rules.TIER2_SUBSTRING) + " ELSE NULL END"
    return (f"CASE WHEN {t2} IS NULL OR {t2} = '' THEN 'sin_match' ELSE coalesce("
            f"{case_map(t2, rules.TIER0_EXACT)}, {case_map(t2, rules.TIER1_EXACT)}, {tier2}) END")


def sorted_words(x: str) -> str:
    return f"array_to_string(list_sort({x}), ' ')"


def lcs_of(a: str, b: str) -> str:
    """Length of the longest common subsequence: one bit-parallel step for each
    character of the longer text (the shorter one has at most 62)."""
    s, t = f"(CASE WHEN len({a}) > len({b}) THEN {b} ELSE {a} END)", f"(CASE WHEN len({a}) > len({b}) THEN {a} ELSE {b} END)"
    full = f"((1::BIGINT << len({s})) - 1)"
    mask = (f"list_sum(list_transform(range(1, len({s}) + 1), lambda i: CASE WHEN {s}[i] = ch THEN 1::BIGINT << (i - 1) "
            f"ELSE 0::BIGINT END))::BIGINT")
    masks = f"list_transform(string_split({t}, ''), lambda ch: {mask})"
    step = f"((v + (v & m)) | (v - (v & m))) & {full}"
    return f"(len({s}) - bit_count(list_reduce({masks}, lambda v, m: {step}, {full})))"


def windows_of(kind: str, src: str, a: str, b: str) -> str:
    """Rows (pair, kind, a, b): the shorter text beside every window of the longer one."""
    return f"""SELECT pair, {lit(kind)} AS kind, a, w AS b FROM (
      SELECT pair, a, unnest(list_concat(
          list_transform(range(0, len(b) - len(a) + 1), lambda i: substring(b, i + 1, len(a))),
          list_concat(list_transform(range(1, len(a)), lambda k: substring(b, 1, k)),
                      list_transform(range(1, len(a)), lambda k: substring(b, len(b) - k + 1, k))))) AS w
      FROM (SELECT pair, CASE WHEN len(x) > len(y) THEN y ELSE x END AS a, CASE WHEN len(x) > len(y) THEN x ELSE y END AS b
            FROM (SELECT pair, {a} AS x, {b} AS y FROM {src}) WHERE x <> '' AND y <> ''))
      WHERE contains(a, w[1]) OR contains(a, w[-1])"""


def near_match_ctes() -> str:
    """fz (f_text, f_cat): tier 3 for every closing text that tiers 0-2 leave."""
    labels = ", ".join(f"({i}, {lit(c)})" for i, c in enumerate(rules.CANONICAL_CATEGORIES))
    left = "list_filter(list_distinct(wa), lambda w: NOT list_contains(wb, w))"
    right = "list_filter(list_distinct(wb), lambda w: NOT list_contains(wa, w))"
    both = "list_filter(list_distinct(wa), lambda w: list_contains(wb, w))"
    with_sect = "CASE WHEN sect = '' THEN {x} ELSE sect || ' ' || {x} END"
    return f"""fz_raw AS (SELECT cierre_supervisor AS x FROM interventions UNION SELECT resultado FROM interventions
             UNION SELECT unnest(['19. Sin cubrir', 'Se retira del lugar'])),
  fz_text AS (SELECT DISTINCT t FROM (SELECT {clean_outcome('x')} AS t FROM fz_raw) WHERE {rule_category('t')} IS NULL),
  fz_label AS (SELECT i, cat, {clean_outcome('cat')} AS lab FROM (VALUES {labels}) AS v(i, cat)),
  fz_pair AS (SELECT row_number() OVER () AS pair, t, i, cat, lab, string_split(t, ' ') AS wa, string_split(lab, ' ') AS wb,
                     greatest(len(t), len(lab))::DOUBLE / least(len(t), len(lab)) AS r FROM fz_text, fz_label),
  fz_words AS (SELECT *, {sorted_words('wa')} AS sa, {sorted_words('wb')} AS sb, {sorted_words(both)} AS sect,
                      {sorted_words(left)} AS da, {sorted_words(right)} AS db,
                      len({left}) AS na, len({right}) AS nb, CASE WHEN r <= 8 THEN 0.9::DOUBLE ELSE 0.6::DOUBLE END AS scale FROM fz_pair),
  fz_set AS (SELECT *, {with_sect.format(x='da')} AS xa, {with_sect.format(x='db')} AS xb FROM fz_words),
  fz_near AS (SELECT * FROM fz_set WHERE r < 1.5), fz_far AS (SELECT * FROM fz_set WHERE r >= 1.5),
  fz_cmp AS (SELECT pair, 'whole' AS kind, t AS a, lab AS b FROM fz_set
    UNION ALL SELECT pair, 'words', sa, sb FROM fz_near
    UNION ALL SELECT pair, 'words', xa, xb FROM fz_near
    UNION ALL SELECT pair, 'words', sect, xa FROM fz_near WHERE sect <> ''
    UNION ALL SELECT pair, 'words', sect, xb FROM fz_near WHERE sect <> ''
    UNION ALL {windows_of('part', 'fz_far', 't', 'lab')}
    UNION ALL {windows_of('part_words', "(SELECT * FROM fz_far WHERE sect = '')", 'sa', 'sb')}
    UNION ALL {windows_of('part_words', "(SELECT * FROM fz_far WHERE sect = '' AND (na <> len(wa) OR nb <> len(wb)))", 'da', 'db')}),
  fz_lcs AS (SELECT a, b, {lcs_of('a', 'b')} AS l FROM (SELECT DISTINCT a, b FROM fz_cmp)),
  fz_best AS (SELECT c.pair, max(CASE WHEN kind = 'whole' THEN v END) AS whole, max(CASE WHEN kind = 'words' THEN v END) AS words,
                     max(CASE WHEN kind = 'part' THEN v END) AS part, max(CASE WHEN kind = 'part_words' THEN v END) AS part_words
              FROM fz_cmp c JOIN (SELECT a, b, 200::DOUBLE * l / (len(a) + len(b)) AS v FROM fz_lcs) s ON c.a = s.a AND c.b = s.b
              GROUP BY c.pair),
  fz_score AS (SELECT t, i, cat, CASE WHEN r < 1.5
      THEN greatest(whole, 0.95::DOUBLE * CASE WHEN sect <> '' AND (na = 0 OR nb = 0) THEN 100::DOUBLE ELSE words END)
      ELSE greatest(whole, coalesce(part, 0) * scale,
                    CASE WHEN sect <> '' THEN 100::DOUBLE ELSE coalesce(part_words, 0) END * 0.95::DOUBLE * scale) END AS score
      FROM fz_set s JOIN fz_best b ON s.pair = b.pair),
  fz AS (SELECT t AS f_text, CASE WHEN max(score) >= {rules.FUZZY_ACCEPT_SCORE} THEN first(cat ORDER BY score DESC, i) ELSE 'sin_match' END AS f_cat
         FROM fz_score GROUP BY t)"""


def category(t: str) -> str:
    """Tiers 0-3 of a cleaned text."""
    return f"coalesce({rule_category(t)}, (SELECT f_cat FROM fz WHERE f_text = {t}), 'sin_match')"


def contact_level(c: str) -> str:
    return f"coalesce({case_map(f'trim({c})', rules.CONTACT_LEVEL_BY_CATEGORY)}, 'Sin dato')"


def contact_pair(c: str) -> tuple[str, str]:
    a = (f"CASE WHEN {c} IN {in_list(rules.CONTACT_GIVES_DATA)} THEN 'Contacta' "
         f"WHEN {c} IN {in_list(rules.CONTACT_NO_DATA)} THEN 'Contacta' "
         f"WHEN {c} IN {in_list(rules.NO_CONTACT)} THEN 'No se contacta' "
         f"WHEN {c} = '19. Sin cubrir' THEN 'Sin cubrir' WHEN {c} = '20. Desestimado' THEN 'Desestimado' "
         f"ELSE 'Derivaciones/seguimientos' END")
    b = (f"CASE WHEN {c} IN {in_list(rules.CONTACT_GIVES_DATA)} THEN 'Brinda datos' "
         f"WHEN {c} IN {in_list(rules.CONTACT_NO_DATA)} THEN 'No brinda datos' ELSE '' END")
    return a, b


def bucket(c: str) -> str:
    return f"coalesce({case_map(f'trim({c})', rules.BUCKET_BY_CATEGORY)}, {lit(rules.BUCKET_DEFAULT)})"


def interview(c: str, dni: str) -> str:
    return (f"CASE WHEN coalesce(trim({c}), '') IN {in_list(rules.INTERVIEW_CATEGORIES)} THEN "
            f"CASE WHEN {valid_id(dni)} THEN 'Brinda DNI' ELSE 'No brinda' END ELSE 'No realiza entrevista' END")


def in_priority(d: str) -> str:
    return f"coalesce({d} IN (2.0::DOUBLE, 13.0::DOUBLE, 14.0::DOUBLE, 1.5::DOUBLE), false)"


def report_level() -> str:
    st = "coalesce(upper(trim(estado)), '')"
    return (f"CASE WHEN {st} = 'PENDIENTE' AND NOT {in_priority('comuna_calculada')} THEN 'Sin cubrir' "
            f"WHEN {st} = 'CERRADO' AND cierre_texto IS NULL AND coalesce(trim(categoria_final), '') IN ('sin_match', '') "
            f"THEN 'Sin cubrir' "
            f"WHEN coalesce(trim(nivel_contacto), '') IN ('Se contacta', 'No se contacta', 'Sin cubrir', 'Desestimado') "
            f"THEN trim(nivel_contacto) ELSE 'Seguimiento' END")


def dashboard_class() -> str:
    lvl = "coalesce(trim(nivel_contacto), '')"
    res = "lower(coalesce(resultado, ''))"
    return (f"CASE WHEN estado = 'PENDIENTE' AND NOT {in_priority('comuna_calculada')} THEN 'Sin cubrir' "
            f"WHEN estado = 'CERRADO' AND coalesce(trim(categoria_final), '') IN ('sin_match', '') "
            f"AND cierre_texto IS NULL THEN 'Sin cubrir' "
            f"WHEN {lvl} = 'Se contacta' THEN 'Se contacta' "
            f"WHEN {lvl} IN ('No se contacta', 'Desestimado') THEN 'No se contacta' "
            f"WHEN {lvl} = 'Sin cubrir' THEN 'Sin cubrir' "
            f"WHEN contains({res}, 'no se contacta') OR contains({res}, 'no se observan') "
            f"OR contains({res}, 'desestimado') THEN 'No se contacta' "
            f"WHEN contains({res}, 'sin cubrir') THEN 'Sin cubrir' ELSE 'Sin dato' END")


def origin_group(x: str) -> str:
    s = f"upper(trim({x}))"
    return (f"CASE WHEN {x} IS NULL THEN {lit(rules.ORIGIN_NULL_GROUP)} "
            f"WHEN {s} IN {in_list(rules.ORIGIN_EXCLUDED)} THEN {lit(rules.ORIGIN_EXCLUDED_MARK)} "
            f"ELSE coalesce({case_map(s, rules.ORIGIN_GROUP)}, 'Otro (' || trim({x}) || ')') END")


def manual_group(x: str) -> str:
    return f"coalesce({case_map(f'upper(trim({x}))', rules.MANUAL_GROUP)}, {lit(rules.MANUAL_GROUP_DEFAULT)})"


def district_key(d: str) -> str:
    return f"CASE WHEN {d} IS NULL THEN NULL WHEN {d} = 1.5 THEN '1.5' ELSE CAST(CAST(trunc({d}) AS INTEGER) AS VARCHAR) END"


def report_zone(k: str) -> str:
    return f"CASE WHEN {k} IN {in_list(rules.HIGHLIGHT_DISTRICT_KEYS)} THEN {k} ELSE 'resto' END"


def dashboard_zone(d: str) -> str:
    return (f"CASE WHEN {d} = 2 THEN 'c2' WHEN {d} = 13 THEN 'c13' WHEN {d} = 14 THEN 'c14' "
            f"WHEN {d} = 1.5 THEN 'zona1a' ELSE 'resto' END")


# -- table builders (CTE bodies) -------------------------------------------------

LANDING_STRINGS = ["id_suceso", "id_suceso_asociado", "persona_dni", "persona_nombre", "persona_apellido",
                   "latitud", "longitud", "agencia", "estado", "tipo_carta", "origen", "resultado",
                   "cierre_supervisor"]
LANDING = ["_seq", "id_suceso", "id_suceso_asociado", "fecha_inicio", "fecha_fin", "persona_dni",
           "persona_nombre", "persona_apellido", "latitud", "longitud", "agencia", "estado", "tipo_carta",
           "origen", "resultado", "cierre_supervisor"]


def edges_values() -> str:
    rows = []
    for z in SYNTHETIC_ZONES:
        for x1, y1, x2, y2 in z.edges():
            rows.append(f"({lit(z.zone_id)}, {float(z.comuna)}::DOUBLE, {z.priority}, {z.ord}, "
                        f"{float(x1)}::DOUBLE, {float(y1)}::DOUBLE, {float(x2)}::DOUBLE, {float(y2)}::DOUBLE)")
    return "(VALUES " + ", ".join(rows) + ") AS e(zone_id, comuna, priority, ord, x1, y1, x2, y2)"


def geo_cte(src: str) -> str:
    """(_seq, comuna_calculada, zone_id) for the rows of ``src``."""
    return f"""
    (WITH pts AS (
       SELECT _seq, {to_district('longitud')} AS px, {to_district('latitud')} AS py FROM {src}),
     hits AS (
       SELECT p._seq, e.zone_id, e.comuna, e.priority, e.ord,
              sum(CASE WHEN ((e.y1 > p.py) <> (e.y2 > p.py))
                        AND (p.px < (e.x2 - e.x1) * (p.py - e.y1) / (e.y2 - e.y1) + e.x1) THEN 1 ELSE 0 END) AS crossings,
              bool_or((e.x2 - e.x1) * (p.py - e.y1) - (e.y2 - e.y1) * (p.px - e.x1) = 0
                      AND p.px BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
                      AND p.py BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)) AS on_edge
       FROM pts p JOIN {edges_values()} ON p.px IS NOT NULL AND p.py IS NOT NULL
       GROUP BY ALL),
     ranked AS (
       SELECT _seq, comuna, zone_id,
              row_number() OVER (PARTITION BY _seq ORDER BY priority, ord) AS rn
       FROM hits WHERE crossings % 2 = 1 AND NOT on_edge)
     SELECT pts._seq, ranked.comuna AS comuna_calculada, ranked.zone_id
     FROM pts LEFT JOIN ranked ON pts._seq = ranked._seq AND ranked.rn = 1)"""


def outcome_cols_select(src: str, placeholders: bool = True) -> str:
    """SELECT of ``src`` plus the derived outcome columns."""
    if placeholders:
        sup = f"CASE WHEN cierre_supervisor IN {in_list(rules.PLACEHOLDER_VALUES)} THEN NULL ELSE cierre_supervisor END"
        res = f"CASE WHEN resultado IN {in_list(rules.PLACEHOLDER_VALUES)} THEN NULL ELSE resultado END"
    else:
        sup, res = "cierre_supervisor", "resultado"
    a, b = contact_pair("categoria_final")
    return f"""
    (SELECT *, {contact_level('categoria_final')} AS nivel_contacto, {a} AS contacto, {b} AS brinda_datos FROM (
      SELECT *, {category('texto_limpio')} AS categoria_final FROM (
        SELECT *, {clean_outcome('cierre_texto')} AS texto_limpio FROM (
          SELECT * REPLACE ({sup} AS cierre_supervisor, {res} AS resultado),
                 coalesce({sup}, {res}) AS cierre_texto
          FROM {src}))))"""


def clean_cte(src: str) -> str:
    """clean_batch: W01, P02, G03, F03, F01, P03, outcome columns."""
    others = [c for c in LANDING if c != "_seq"]
    dedup = f"(SELECT min(_seq) AS _seq, {', '.join(others)} FROM {src} GROUP BY {', '.join(others)})"
    stripped = ", ".join(f"{strip_blanks(c)} AS {c}" if c in LANDING_STRINGS else c for c in LANDING)
    cat, rsn = id_parts("persona_dni")
    return f"""
    (WITH d AS (SELECT {stripped} FROM {dedup}),
     g AS (SELECT d.*, z.comuna_calculada, z.zone_id FROM d LEFT JOIN {geo_cte('d')} z ON d._seq = z._seq),
     idn AS (SELECT * REPLACE ({clean_name('persona_nombre')} AS persona_nombre,
                               {clean_name('persona_apellido')} AS persona_apellido),
                    trim({cat}) AS dni_categorizado, {rsn} AS dni_categorizado_motivo FROM g),
     ag AS (SELECT * FROM idn WHERE NOT coalesce(agencia IN {in_list(rules.EXCLUDED_AGENCIES)}, false))
     SELECT * FROM {outcome_cols_select('ag')})"""


def classify_cte(batch: str, hist: str) -> str:
    """W04-W07 + A04 of ``batch`` against ``hist``."""
    return f"""
    (WITH b AS (SELECT *, {week('fecha_inicio')} AS _week, {valid_id('dni_categorizado')} AS _valid FROM {batch}),
     keys AS (SELECT DISTINCT dni_categorizado FROM b WHERE _valid),
     bmin AS (SELECT date_trunc('day', min(fecha_inicio)) AS m FROM {batch}),
     hk AS (SELECT h.* FROM {hist} h WHERE h.dni_categorizado IN (SELECT dni_categorizado FROM keys)),
     st AS (SELECT dni_categorizado, comuna_calculada AS _ref FROM (
              SELECT dni_categorizado, comuna_calculada,
                     row_number() OVER (PARTITION BY dni_categorizado ORDER BY fecha_inicio DESC, _seq DESC) AS rn
              FROM hk WHERE fecha_inicio IS NOT NULL AND fecha_inicio < (SELECT m FROM bmin)) WHERE rn = 1),
     wk AS (SELECT dni_categorizado, _week, comuna_calculada AS _ref, first_ts, first_seq, n_week FROM (
              SELECT dni_categorizado, _week, comuna_calculada,
                     row_number() OVER (PARTITION BY dni_categorizado, _week ORDER BY fecha_inicio DESC, _seq DESC) AS rn,
                     min(fecha_inicio) OVER (PARTITION BY dni_categorizado, _week) AS first_ts,
                     count(*) OVER (PARTITION BY dni_categorizado, _week) AS n_week,
                     first_value(_seq) OVER (PARTITION BY dni_categorizado, _week ORDER BY fecha_inicio, _seq) AS first_seq
              FROM b WHERE _valid) WHERE rn = 1),
     sq AS (SELECT dni_categorizado, _week, _ref, _hist,
                   lag(_ref) OVER (PARTITION BY dni_categorizado ORDER BY _week NULLS FIRST) AS _prev,
                   row_number() OVER (PARTITION BY dni_categorizado ORDER BY _week NULLS FIRST) AS _rn
            FROM (SELECT dni_categorizado, CAST(NULL AS DATE) AS _week, _ref, true AS _hist FROM st
                  UNION ALL SELECT dni_categorizado, _week, _ref, false FROM wk)),
     lab AS (SELECT dni_categorizado, _week,
                    CASE WHEN _rn = 1 THEN 'Nuevos' WHEN _prev IS NULL OR _ref IS NULL THEN 'Recurrentes'
                         WHEN _prev = _ref THEN 'Recurrentes' ELSE 'Migratorios' END AS _label
             FROM sq WHERE NOT _hist),
     cnt AS (SELECT k.dni_categorizado,
                    (SELECT sum(n_week) FROM wk WHERE wk.dni_categorizado = k.dni_categorizado)
                    + (SELECT count(*) FROM hk WHERE hk.dni_categorizado = k.dni_categorizado) AS apariciones
             FROM keys k)
     SELECT b.* EXCLUDE (_week, _valid),
            CASE WHEN lab._label = 'Nuevos' AND NOT (b.fecha_inicio = wk.first_ts AND b._seq = wk.first_seq)
                 THEN 'Nuevo repetido' ELSE lab._label END AS tipo_evolucion,
            CAST(cnt.apariciones AS BIGINT) AS apariciones
     FROM b JOIN lab ON b.dni_categorizado = lab.dni_categorizado AND b._week = lab._week
            JOIN wk ON b.dni_categorizado = wk.dni_categorizado AND b._week = wk._week
            JOIN cnt ON b.dni_categorizado = cnt.dni_categorizado
     WHERE b._valid
     UNION ALL BY NAME
     SELECT b.* EXCLUDE (_week, _valid), 'No clasificable' AS tipo_evolucion, CAST(0 AS BIGINT) AS apariciones
     FROM b WHERE NOT b._valid)"""


def base_ctes() -> str:
    return f"""interventions AS ({interventions_sql('events')}),
  bounds AS (SELECT max({week('fecha_inicio')}) - INTERVAL 7 DAY AS bs FROM interventions),
  h_raw AS (SELECT * FROM interventions WHERE fecha_inicio < (SELECT bs FROM bounds)),
  b_raw AS (SELECT * FROM interventions WHERE fecha_inicio >= (SELECT bs FROM bounds)),
  {near_match_ctes()}"""


def clean_ctes() -> str:
    return f"""{base_ctes()},
  ch AS {clean_cte('h_raw')},
  cb AS {clean_cte('b_raw')}"""


def labeled_ctes() -> str:
    return f"""{clean_ctes()},
  empty_h AS (SELECT * FROM ch WHERE false),
  labeled AS (SELECT * FROM {classify_cte('ch', 'empty_h')} UNION ALL BY NAME SELECT * FROM {classify_cte('cb', 'ch')})"""


def prepare_weekly_cte(src: str) -> str:
    return f"""
    (SELECT *, upper(trim(tipo_carta)) AS tipo_carta_norm, {district_key('comuna_calculada')} AS comuna_key FROM (
      SELECT * FROM (
        SELECT *, {manual_group('origen')} AS grupo_manual, {report_level()} AS nivel_norm FROM (
          SELECT * FROM (
            SELECT *, {week('fecha_inicio')} AS semana, {origin_group('origen')} AS grupo_origen FROM {src}
            WHERE fecha_inicio IS NOT NULL AND coalesce({to_district('id_suceso_asociado')}, 0) = 0)
          WHERE grupo_origen <> {lit(rules.ORIGIN_EXCLUDED_MARK)}))
      WHERE NOT (coalesce(categoria_final IN ('error de soflex', 'POSITIVO', 'DERIVACION A RED'), false)
                 OR (coalesce(categoria_final = 'sin_match', false) AND nivel_norm <> 'Sin cubrir'))))"""


def prepare_dashboard_cte(src: str) -> str:
    return f"""
    (SELECT *, {week('fecha_inicio')} AS semana FROM {src}
     WHERE fecha_inicio IS NOT NULL AND coalesce({to_district('id_suceso_asociado')}, 0) = 0
       AND NOT coalesce(origen IN ('CORTAN', 'EQUIVOCADO'), false)
       AND NOT coalesce(categoria_final IN ('sin_match', 'error de soflex'), false))"""


def reexport_cte() -> str:
    closing = "(estado = 'PENDIENTE' AND _seq % 3 <> 0)"
    return f"""reexp AS (SELECT * REPLACE (
      CASE WHEN {closing} AND _seq % 2 = 0 THEN '19. Sin cubrir' WHEN {closing} THEN 'Se retira del lugar'
           ELSE resultado END AS resultado,
      CASE WHEN {closing} THEN 'CERRADO' ELSE estado END AS estado) FROM interventions)"""


def last_weeks_sql(src: str, n: int = rules.REPORT_WEEKS) -> str:
    return f"(SELECT DISTINCT semana FROM {src} ORDER BY semana DESC LIMIT {n})"


def values_list(name: str, values) -> str:
    return "(VALUES " + ", ".join(f"({lit(v)})" for v in values) + f") AS t({name})"


# -- queries ------------------------------------------------------------------------

def _q_weekly_totals_by_zone() -> str:
    return f"""WITH {base_ctes()},
  g AS (SELECT i._seq, {week('i.fecha_inicio')} AS semana, z.comuna_calculada
        FROM interventions i JOIN {geo_cte('interventions')} z ON i._seq = z._seq),
  wk AS {last_weeks_sql('g')},
  sp AS (SELECT semana, zone FROM wk, {values_list('zone', ['c2', 'c13', 'c14', 'zona1a', 'resto'])}),
  c AS (SELECT semana, {dashboard_zone('comuna_calculada')} AS zone, count(*) AS n FROM g
        WHERE semana >= (SELECT min(semana) FROM wk) GROUP BY ALL)
SELECT sp.semana, sp.zone, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM sp LEFT JOIN c USING (semana, zone)"""


def _q_last_n_weeks_spine() -> str:
    return f"SELECT DISTINCT {week('o_orderdate')} AS semana FROM orders ORDER BY semana DESC LIMIT {rules.REPORT_WEEKS}"


def _q_orders_weekly_reindex() -> str:
    return f"""WITH o AS (SELECT {week('o_orderdate')} AS semana, o_orderstatus FROM orders),
  wk AS {last_weeks_sql('o')},
  sp AS (SELECT semana, status FROM wk, {values_list('status', ['F', 'O', 'P'])}),
  c AS (SELECT semana, o_orderstatus AS status, count(*) AS n FROM o
        WHERE semana >= (SELECT min(semana) FROM wk) GROUP BY ALL)
SELECT sp.semana, sp.status, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM sp LEFT JOIN c USING (semana, status)"""


def _q_watermark_filter() -> str:
    return f"""WITH {base_ctes()}
SELECT _seq, id_suceso, fecha_inicio FROM interventions
WHERE (SELECT max(fecha_inicio) FROM h_raw) IS NULL OR fecha_inicio > (SELECT max(fecha_inicio) FROM h_raw)"""


def _q_table_stats() -> str:
    return f"""WITH {base_ctes()}
SELECT CAST(count(*) AS BIGINT) AS n_rows, min(fecha_inicio) AS min_ts, max(fecha_inicio) AS max_ts FROM interventions"""


def _person_view() -> str:
    return "(SELECT _seq, persona_nombre, persona_apellido, persona_dni, estado, tipo_carta FROM interventions)"


def _q_drop_exact_duplicates() -> str:
    return f"""WITH {base_ctes()}
SELECT min(_seq) AS _seq, persona_nombre, persona_apellido, persona_dni, estado, tipo_carta
FROM {_person_view()} GROUP BY persona_nombre, persona_apellido, persona_dni, estado, tipo_carta"""


def _q_keep_first_per_key() -> str:
    return f"""WITH {base_ctes()}
SELECT _seq, id_suceso, fecha_inicio, resultado FROM (
  SELECT *, row_number() OVER (PARTITION BY id_suceso ORDER BY _seq) AS rn FROM interventions) WHERE rn = 1"""


def _q_keep_last_per_key() -> str:
    return f"""WITH {base_ctes()}
SELECT _seq, id_suceso, fecha_inicio, resultado FROM (
  SELECT *, row_number() OVER (PARTITION BY id_suceso ORDER BY fecha_inicio DESC, _seq DESC) AS rn
  FROM interventions) WHERE rn = 1"""


def _q_clean_person_names() -> str:
    return f"""WITH {base_ctes()}
SELECT _seq, {clean_name('persona_nombre')} AS nombre, {clean_name('persona_apellido')} AS apellido FROM interventions"""


def _q_clean_names_documents() -> str:
    return f"SELECT doc_id, {clean_name('text')} AS clean FROM documents"


def _q_clean_outcome_text() -> str:
    return f"""WITH {base_ctes()}
SELECT _seq, {clean_outcome('coalesce(cierre_supervisor, resultado)')} AS texto_limpio FROM interventions"""


def _q_clean_outcome_documents() -> str:
    return f"SELECT doc_id, {clean_outcome('text')} AS texto_limpio FROM documents"


def _dni(mode: str) -> str:
    cat, rsn = id_parts("persona_dni", mode)
    return f"""WITH {base_ctes()}
SELECT _seq, {cat} AS dni_categorizado, {rsn} AS dni_motivo FROM interventions"""


def _q_dni_valid() -> str:
    cat, _ = id_parts("persona_dni")
    return f"""WITH {base_ctes()}
SELECT _seq, dni_categorizado, {valid_id('dni_categorizado')} AS valid FROM (
  SELECT _seq, {cat} AS dni_categorizado FROM interventions)"""


def _q_category_rules() -> str:
    return f"""WITH {base_ctes()},
  t AS (SELECT DISTINCT {clean_outcome('coalesce(cierre_supervisor, resultado)')} AS texto_limpio FROM interventions)
SELECT texto_limpio, coalesce({rule_category('texto_limpio')}, 'sin_match') AS categoria_final FROM t"""


def _q_category_fuzzy() -> str:
    return f"""WITH {base_ctes()},
  t AS (SELECT DISTINCT {clean_outcome('coalesce(cierre_supervisor, resultado)')} AS texto_limpio FROM interventions),
  c AS (SELECT texto_limpio, {category('texto_limpio')} AS categoria_final FROM t)
SELECT texto_limpio, categoria_final,
       CASE WHEN categoria_final <> 'sin_match' AND {rule_category('texto_limpio')} IS NULL THEN 'weighted/1' END AS scorer FROM c"""


def _q_category_levels() -> str:
    cat, _ = id_parts("persona_dni")
    return f"""WITH {base_ctes()},
  o AS {outcome_cols_select('interventions')}
SELECT _seq, cierre_texto, texto_limpio, categoria_final, nivel_contacto, contacto, brinda_datos,
       {bucket('categoria_final')} AS bucket, {interview('categoria_final', cat)} AS entrevista FROM o"""


def _q_value_remap_audit() -> str:
    renames = {k: v for k, v in rules.RAW_OUTCOME_REMAP.items() if v is not None}
    nullify = [k for k, v in rules.RAW_OUTCOME_REMAP.items() if v is None]
    remapped = (f"CASE WHEN resultado IN {in_list(nullify)} AND fecha_inicio >= TIMESTAMP "
                f"{lit(rules.REMAP_NULLIFY_FROM + ' 00:00:00')} THEN NULL "
                f"ELSE coalesce({case_map('resultado', renames)}, resultado) END")
    return f"""WITH {base_ctes()}
SELECT value, n FROM (SELECT {remapped} AS value, CAST(count(*) AS BIGINT) AS n FROM interventions GROUP BY 1)
ORDER BY n DESC, value ASC NULLS FIRST LIMIT 30"""


def _q_value_distribution() -> str:
    _, rsn = id_parts("persona_dni")
    return f"""WITH {base_ctes()},
  c AS (SELECT {rsn} AS value, CAST(count(*) AS BIGINT) AS n FROM interventions GROUP BY 1)
SELECT value, n, round(CAST(n AS DOUBLE) / (SELECT sum(n) FROM c), 6) AS share FROM c"""


def _q_geo_zone_layer() -> str:
    """Its own predicate: the layer's rings are rectangles, written as open
    intervals; edges (the hole's too) are outside."""
    return f"""
    WITH i AS ({interventions_sql()}),
    p AS (SELECT _seq, {to_district('longitud')} AS x, {to_district('latitud')} AS y FROM i),
    z AS (SELECT _seq, CASE
      WHEN x > 0 AND x < 6 AND y > 0 AND y < 6 AND NOT (x >= 2 AND x <= 4 AND y >= 1 AND y <= 4) THEN 'rect_a'
      WHEN x > 7 AND x < 9 AND ((y > 0 AND y < 2) OR (y > 3 AND y < 5)) THEN 'rect_b'
      WHEN x > 3 AND x < 10 AND y > 1 AND y < 4 THEN 'rect_c' END AS zone_id FROM p)
    SELECT _seq, CASE zone_id WHEN 'rect_a' THEN 1.0::DOUBLE WHEN 'rect_b' THEN 2.0::DOUBLE
                              WHEN 'rect_c' THEN 12.0::DOUBLE END AS comuna_calculada, zone_id FROM z"""


def _q_geo_zone() -> str:
    return f"""WITH {base_ctes()}
SELECT _seq, comuna_calculada, zone_id FROM {geo_cte('interventions')}"""


def _q_asof_last_state() -> str:
    return f"""WITH {clean_ctes()}
SELECT dni_categorizado, comuna_calculada AS last_comuna_calculada FROM (
  SELECT dni_categorizado, comuna_calculada,
         row_number() OVER (PARTITION BY dni_categorizado ORDER BY fecha_inicio DESC, _seq DESC) AS rn
  FROM ch WHERE dni_categorizado IS NOT NULL AND fecha_inicio IS NOT NULL
    AND fecha_inicio < (SELECT date_trunc('day', min(fecha_inicio)) FROM cb)) WHERE rn = 1"""


def _q_last_state_row_number() -> str:
    excl = rules.ANONYMOUS_ID_LABELS + [rules.FOREIGN_ID]
    return f"""WITH {clean_ctes()}
SELECT dni_categorizado, comuna_calculada AS last_comuna_calculada FROM (
  SELECT dni_categorizado, comuna_calculada,
         row_number() OVER (PARTITION BY dni_categorizado ORDER BY fecha_inicio DESC NULLS FIRST, _seq DESC) AS rn
  FROM ch WHERE dni_categorizado IS NOT NULL AND dni_categorizado NOT IN {in_list(excl)}) WHERE rn = 1"""


def _q_evolution_labels() -> str:
    return f"""WITH {labeled_ctes()}
SELECT _seq, dni_categorizado, comuna_calculada, tipo_evolucion, apariciones FROM labeled"""


def _q_appearance_summary() -> str:
    return f"""WITH {clean_ctes()},
  b AS (SELECT * FROM {classify_cte('cb', 'ch')})
SELECT max(apariciones) AS max_apariciones, round(avg(apariciones), 6) AS mean_apariciones,
       CAST(count(*) FILTER (WHERE apariciones > 1) AS BIGINT) AS n_repeat FROM b"""


def _q_semi_join_counts() -> str:
    return f"""WITH {clean_ctes()}
SELECT dni_categorizado, CAST(count(*) AS BIGINT) AS n_hist FROM ch
WHERE dni_categorizado IN (SELECT dni_categorizado FROM cb WHERE {valid_id('dni_categorizado')})
GROUP BY dni_categorizado"""


def _q_appearances_composite_key() -> str:
    anon = in_list(rules.ANONYMOUS_ID_LABELS)

    def keyed(src: str) -> str:
        return (f"(SELECT *, CASE WHEN dni_categorizado IN {anon} THEN "
                f"upper(trim(persona_nombre)) || '|' || upper(trim(persona_apellido)) ELSE dni_categorizado END AS _ckey, "
                f"CASE WHEN dni_categorizado IN {anon} THEN 'name' ELSE 'dni' END AS _ckind FROM {src})")
    return f"""WITH {clean_ctes()},
  kb AS {keyed('cb')}, kh AS {keyed('ch')},
  c AS (SELECT _ckind, _ckey, CAST(count(*) AS BIGINT) AS apariciones FROM (
          SELECT _ckind, _ckey FROM kh UNION ALL SELECT _ckind, _ckey FROM kb) GROUP BY ALL)
SELECT kb._seq, kb.dni_categorizado, c.apariciones FROM kb LEFT JOIN c
  ON kb._ckind = c._ckind AND kb._ckey = c._ckey"""


UPD_COLS = ["estado", "fecha_fin", "cierre_texto", "texto_limpio", "categoria_final", "nivel_contacto",
            "contacto", "brinda_datos"]


def _q_reconcile_pending() -> str:
    sets = ", ".join(f"CASE WHEN _upd THEN u_{c} ELSE h.{c} END AS {c}" for c in UPD_COLS)
    return f"""WITH {clean_ctes()}, {reexport_cte()},
  pend AS (SELECT DISTINCT id_suceso FROM ch WHERE estado = 'PENDIENTE'),
  closed AS (SELECT * FROM reexp WHERE coalesce(trim(estado), '') <> 'PENDIENTE'
             AND id_suceso IN (SELECT id_suceso FROM pend)),
  oc AS {outcome_cols_select('closed')},
  u AS (SELECT trim(id_suceso) AS u_id, {', '.join(f'{c} AS u_{c}' for c in UPD_COLS)} FROM (
          SELECT *, row_number() OVER (PARTITION BY id_suceso ORDER BY _seq) AS rn FROM oc) WHERE rn = 1),
  j AS (SELECT h.*, u.*, (u.u_id IS NOT NULL AND coalesce(h.estado = 'PENDIENTE', false)) AS _upd
        FROM ch h LEFT JOIN u ON h.id_suceso = u.u_id)
SELECT _seq, id_suceso, {sets}, _upd AS _updated FROM j h"""


def _q_keyed_update() -> str:
    cols = ["cierre_texto", "texto_limpio", "categoria_final", "nivel_contacto", "contacto", "brinda_datos"]
    sets = ", ".join(f"CASE WHEN _upd THEN u_{c} ELSE h.{c} END AS {c}" for c in cols)
    return f"""WITH {clean_ctes()}, {reexport_cte()},
  cut AS (SELECT min({week('fecha_inicio')}) + INTERVAL 7 DAY AS c FROM interventions),
  sl AS (SELECT * FROM reexp WHERE fecha_inicio >= (SELECT c FROM cut)),
  oc AS {outcome_cols_select('sl', placeholders=False)},
  u AS (SELECT id_suceso AS u_id, {', '.join(f'{c} AS u_{c}' for c in cols)} FROM (
          SELECT *, row_number() OVER (PARTITION BY id_suceso ORDER BY _seq DESC) AS rn FROM oc) WHERE rn = 1),
  j AS (SELECT h.*, u.*, u.u_id IS NOT NULL AS _upd FROM ch h LEFT JOIN u ON h.id_suceso = u.u_id)
SELECT _seq, id_suceso, {sets}, _upd AS _updated FROM j h"""


def _q_patch_from_lookup() -> str:
    return f"""WITH {clean_ctes()}, {reexport_cte()},
  cl AS (SELECT * FROM reexp WHERE estado = 'CERRADO'),
  oc AS {outcome_cols_select('cl')},
  u AS (SELECT id_suceso AS u_id, categoria_final AS u_cat, nivel_contacto AS u_niv FROM (
          SELECT *, row_number() OVER (PARTITION BY id_suceso ORDER BY _seq DESC) AS rn FROM oc) WHERE rn = 1)
SELECT h._seq, h.id_suceso, CASE WHEN u.u_id IS NOT NULL THEN u.u_cat END AS categoria_final,
       CASE WHEN u.u_id IS NOT NULL THEN u.u_niv END AS nivel_contacto, u.u_id IS NOT NULL AS _updated
FROM ch h LEFT JOIN u ON h.id_suceso = u.u_id"""


def _q_contact_class() -> str:
    return f"""WITH {labeled_ctes()}
SELECT _seq, {report_level()} AS nivel_norm, {dashboard_class()} AS clase_contacto FROM labeled"""


def _q_report_prepare() -> str:
    return f"""WITH {labeled_ctes()}
SELECT _seq, semana, grupo_origen, grupo_manual, nivel_norm, tipo_carta_norm, comuna_key
FROM {prepare_weekly_cte('labeled')}"""


def _q_dashboard_prepare() -> str:
    return f"""WITH {labeled_ctes()}
SELECT _seq, semana, categoria_final, comuna_calculada FROM {prepare_dashboard_cte('labeled')}"""


def _q_origin_groups() -> str:
    dk = district_key("comuna_calculada")
    return f"""WITH {labeled_ctes()}
SELECT _seq, {origin_group('origen')} AS grupo_origen, {manual_group('origen')} AS grupo_manual,
       {dk} AS comuna_key, {report_zone(dk)} AS zone FROM labeled"""


def _q_kpi_table() -> str:
    def pct(n: str) -> str:
        return f"CAST(round_even(CAST(100 AS DOUBLE) * {n} / greatest(auto, 1), 0) AS INTEGER)"
    rows = [(1, rules.KPI_ROWS[0], "total", None), (2, rules.KPI_ROWS[1], "cis", None),
            (3, rules.KPI_ROWS[2], "auto", None), (4, rules.KPI_ROWS[3], "se_contacta", pct("se_contacta")),
            (5, rules.KPI_ROWS[4], "no_se_contacta", pct("no_se_contacta")),
            (6, rules.KPI_ROWS[5], "sin_cubrir", pct("sin_cubrir"))]
    unions = " UNION ALL ".join(
        f"SELECT zone, semana, {o} AS ord, {lit(k)} AS kpi, {col} AS n, {p or 'CAST(NULL AS INTEGER)'} AS pct FROM f"
        for o, k, col, p in rows)
    base_cases = " ".join(f"WHEN zone = {lit(z)} AND ord = {i + 1} THEN {lit(v)}"
                          for z, vals in rules.KPI_BASELINES.items() for i, v in enumerate(vals))
    return f"""WITH {labeled_ctes()},
  base AS {prepare_dashboard_cte('labeled')},
  wk AS {last_weeks_sql('base')},
  d AS (SELECT *, {dashboard_zone('comuna_calculada')} AS zone, {dashboard_class()} AS _cls FROM base
        WHERE semana >= (SELECT min(semana) FROM wk)),
  a AS (SELECT CASE WHEN GROUPING(zone) = 1 THEN 'total' ELSE zone END AS zone, semana,
               count(*) AS total,
               count(*) FILTER (WHERE categoria_final = '01. Traslado efectivo a CIS') AS cis,
               count(*) FILTER (WHERE tipo_carta = 'AUTOMATICA') AS auto,
               count(*) FILTER (WHERE tipo_carta = 'AUTOMATICA' AND _cls = 'Se contacta') AS se_contacta,
               count(*) FILTER (WHERE tipo_carta = 'AUTOMATICA' AND _cls = 'No se contacta') AS no_se_contacta,
               count(*) FILTER (WHERE tipo_carta = 'AUTOMATICA' AND _cls = 'Sin cubrir') AS sin_cubrir
        FROM d GROUP BY GROUPING SETS ((zone, semana), (semana))),
  sp AS (SELECT semana, zone FROM wk, {values_list('zone', ['c2', 'c13', 'c14', 'zona1a', 'resto', 'total'])}),
  f AS (SELECT sp.zone, sp.semana,
               CAST(coalesce(a.total, 0) AS BIGINT) AS total, CAST(coalesce(a.cis, 0) AS BIGINT) AS cis,
               CAST(coalesce(a.auto, 0) AS BIGINT) AS auto, CAST(coalesce(a.se_contacta, 0) AS BIGINT) AS se_contacta,
               CAST(coalesce(a.no_se_contacta, 0) AS BIGINT) AS no_se_contacta,
               CAST(coalesce(a.sin_cubrir, 0) AS BIGINT) AS sin_cubrir
        FROM sp LEFT JOIN a USING (semana, zone)),
  r AS ({unions})
SELECT zone, semana, strftime(semana, '%d %b') AS week_label, kpi,
       CASE {base_cases} ELSE {lit(rules.KPI_BASELINE_DEFAULT)} END AS base, n, pct,
       CASE WHEN pct IS NULL THEN CAST(n AS VARCHAR) ELSE CAST(pct AS VARCHAR) || '% (' || CAST(n AS VARCHAR) || ')' END AS cell
FROM r"""


def level_idx(x: str) -> str:
    return "CASE " + x + " " + " ".join(f"WHEN {lit(v)} THEN {i}" for i, v in enumerate(rules.LEVEL_ORDER)) + " END"


def group_idx(x: str) -> str:
    return "CASE " + x + " " + " ".join(f"WHEN {lit(v)} THEN {i}" for i, v in enumerate(rules.MANUAL_GROUP_ORDER)) + " END"


def hierarchy_base_sql() -> str:
    return f"""p AS (SELECT *, {report_zone('comuna_key')} AS zone FROM {prepare_weekly_cte('labeled')}),
  a AS (SELECT zone, semana, grupo_manual, nivel_norm, count(*) AS n, GROUPING(zone, grupo_manual, nivel_norm) AS gid
        FROM p GROUP BY GROUPING SETS ((zone, semana), (zone, semana, nivel_norm), (zone, semana, grupo_manual),
                                       (zone, semana, grupo_manual, nivel_norm), (semana), (semana, nivel_norm),
                                       (semana, grupo_manual), (semana, grupo_manual, nivel_norm))),
  h AS (SELECT CASE WHEN gid & 4 <> 0 THEN 'todas' ELSE zone END AS zone, semana,
               CASE WHEN gid & 3 = 3 THEN 'total' WHEN gid & 2 <> 0 THEN 'total_nivel'
                    WHEN gid & 1 <> 0 THEN 'grupo_origen' ELSE 'grupo_origen_nivel' END AS row_type,
               CASE WHEN gid & 2 <> 0 THEN NULL ELSE grupo_manual END AS grupo,
               CASE WHEN gid & 1 <> 0 THEN NULL ELSE nivel_norm END AS nivel, CAST(n AS BIGINT) AS n
        FROM a),
  hf AS (SELECT * FROM h WHERE grupo IS NULL OR grupo IN {in_list(rules.MANUAL_GROUP_ORDER)})"""


def _q_report_week_range() -> str:
    return f"""WITH {labeled_ctes()},
  {hierarchy_base_sql()},
  wk AS (SELECT DISTINCT semana FROM p),
  b AS (SELECT (SELECT max(semana) FROM (SELECT semana FROM wk ORDER BY semana LIMIT 2)) AS w2,
               (SELECT max(semana) FROM (SELECT semana FROM wk ORDER BY semana LIMIT 4)) AS w4)
SELECT zone, semana, row_type, grupo, nivel, n FROM hf
WHERE semana BETWEEN (SELECT w2 FROM b) AND (SELECT w4 FROM b)"""


def _q_reconcile_summary() -> str:
    body = _q_reconcile_pending()
    head, _, _ = body.rpartition("SELECT _seq, id_suceso,")
    return f"""{head}SELECT CAST(count(*) FILTER (WHERE _upd) AS BIGINT) AS n_rows_updated,
       (SELECT CAST(count(DISTINCT u_id) AS BIGINT) FROM u) AS n_incidents FROM j"""


def _q_snapshot_merge() -> str:
    cat, _ = id_parts("persona_dni")
    blank = f"(dni_categorizado IS NULL OR lower({strip_blanks('dni_categorizado')}) IN ('none', 'nan', '<na>', '', 'null'))"
    return f"""WITH {clean_ctes()},
  m AS (SELECT _seq, persona_dni, CAST(NULL AS VARCHAR) AS dni_categorizado, categoria_final FROM ch
        UNION ALL SELECT _seq, persona_dni, dni_categorizado, categoria_final FROM cb)
SELECT _seq, persona_dni, CASE WHEN {blank} THEN trim({cat}) ELSE dni_categorizado END AS dni_categorizado,
       categoria_final FROM m"""


def _q_late_arrivals() -> str:
    return f"""WITH {clean_ctes()},
  wm AS (SELECT max(fecha_inicio) AS w FROM ch)
SELECT _seq, id_suceso, fecha_inicio FROM interventions WHERE fecha_inicio > (SELECT w FROM wm)
UNION ALL
SELECT _seq, id_suceso, fecha_inicio FROM interventions
WHERE fecha_inicio <= (SELECT w FROM wm) AND _seq NOT IN (SELECT _seq FROM ch)"""


def _q_hierarchy_counts() -> str:
    keys = [("total", None, None)] + [("total_nivel", None, lv) for lv in rules.LEVEL_ORDER]
    for g in rules.MANUAL_GROUP_ORDER:
        keys += [("grupo_origen", g, None)] + [("grupo_origen_nivel", g, lv) for lv in rules.LEVEL_ORDER]
    kv = "(VALUES " + ", ".join(f"({lit(t)}, CAST({lit(g)} AS VARCHAR), CAST({lit(lv)} AS VARCHAR))"
                                for t, g, lv in keys) + ") AS k(row_type, grupo, nivel)"
    zones = ["todas", "resto"] + rules.HIGHLIGHT_DISTRICT_KEYS
    return f"""WITH {labeled_ctes()},
  {hierarchy_base_sql()},
  pk AS (SELECT DISTINCT row_type, grupo, nivel FROM hf WHERE zone = 'todas'),
  zs AS (SELECT zone FROM {values_list('zone', zones)}
         WHERE zone IN ('todas', 'resto') OR zone IN (SELECT DISTINCT zone FROM p)),
  sp AS (SELECT zs.zone, w.semana, k.row_type, k.grupo, k.nivel
         FROM zs, (SELECT DISTINCT semana FROM p) w, {kv}
         WHERE EXISTS (SELECT 1 FROM pk WHERE pk.row_type = k.row_type AND pk.grupo IS NOT DISTINCT FROM k.grupo
                       AND pk.nivel IS NOT DISTINCT FROM k.nivel)),
  f AS (SELECT sp.*, CAST(coalesce(hf.n, 0) AS BIGINT) AS n FROM sp LEFT JOIN hf
          ON sp.zone = hf.zone AND sp.semana = hf.semana AND sp.row_type = hf.row_type
         AND sp.grupo IS NOT DISTINCT FROM hf.grupo AND sp.nivel IS NOT DISTINCT FROM hf.nivel),
  hr AS (SELECT *, CASE WHEN row_type = 'total' THEN 0 WHEN row_type = 'total_nivel' THEN 1 + {level_idx('nivel')}
                        WHEN row_type = 'grupo_origen' THEN 10 + 10 * {group_idx('grupo')}
                        ELSE 10 + 10 * {group_idx('grupo')} + 1 + {level_idx('nivel')} END AS row_order FROM f),
  par AS (SELECT zone, semana, grupo AS pk, n AS pn FROM f WHERE row_type IN ('total', 'grupo_origen'))
SELECT hf.zone, hf.semana, hf.row_type, hf.grupo, hf.nivel, hf.n,
       CASE WHEN hf.row_type = 'total' OR hf.n = 0 OR par.pn IS NULL OR par.pn = 0 THEN NULL
            ELSE CAST(floor(CAST(hf.n AS DOUBLE) * 100.0 / par.pn + 0.5) AS INTEGER) END AS pct,
       hf.row_order
FROM hr hf LEFT JOIN par ON hf.zone = par.zone AND hf.semana = par.semana
  AND (CASE WHEN hf.row_type = 'grupo_origen_nivel' THEN hf.grupo END) IS NOT DISTINCT FROM par.pk"""


def _q_contact_breakdown() -> str:
    classes = rules.INTERVIEW_CLASSES + rules.OUTCOME_CLASSES
    kc = " UNION ALL ".join([f"SELECT 'entrevista' AS kind, {lit(c)} AS clase" for c in rules.INTERVIEW_CLASSES] +
                            [f"SELECT 'resultado', {lit(c)}" for c in rules.OUTCOME_CLASSES])
    zones = ["todas", "resto"] + rules.HIGHLIGHT_DISTRICT_KEYS
    return f"""WITH {labeled_ctes()},
  p AS (SELECT *, {report_zone('comuna_key')} AS zone FROM {prepare_weekly_cte('labeled')}),
  wk AS {last_weeks_sql('p')},
  d AS (SELECT zone, semana, tipo_carta_norm AS tipo,
               {interview('categoria_final', 'dni_categorizado')} AS ent, {bucket('categoria_final')} AS res
        FROM p WHERE semana >= (SELECT min(semana) FROM wk) AND nivel_contacto = 'Se contacta'
          AND tipo_carta_norm IN ('AUTOMATICA', 'MANUAL')),
  x AS (SELECT zone, semana, tipo, 'entrevista' AS kind, ent AS clase FROM d
        UNION ALL SELECT zone, semana, tipo, 'resultado', res FROM d),
  xf AS (SELECT * FROM x WHERE clase IN {in_list(classes)}),
  c AS (SELECT CASE WHEN GROUPING(zone) = 1 THEN 'todas' ELSE zone END AS zone, semana,
               CASE WHEN GROUPING(tipo) = 1 THEN 'ALL' ELSE tipo END AS tipo, kind, clase, count(*) AS n
        FROM xf GROUP BY GROUPING SETS ((zone, semana, tipo, kind, clase), (zone, semana, kind, clase),
                                        (semana, tipo, kind, clase), (semana, kind, clase))),
  zs AS (SELECT zone FROM {values_list('zone', zones)}
         WHERE zone IN ('todas', 'resto') OR zone IN (SELECT DISTINCT zone FROM p)),
  sp AS (SELECT zs.zone, wk.semana, t.tipo, k.kind, k.clase
         FROM zs, wk, (SELECT * FROM {values_list('tipo', ['AUTOMATICA', 'MANUAL', 'ALL'])}) t, ({kc}) k)
SELECT sp.zone, sp.semana, sp.tipo, sp.kind, sp.clase, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM sp LEFT JOIN c USING (zone, semana, tipo, kind, clase)"""


def _q_contact_breakdown_dashboard() -> str:
    kc = " UNION ALL ".join([f"SELECT 'entrevista' AS kind, {lit(c)} AS clase" for c in rules.INTERVIEW_CLASSES] +
                            [f"SELECT 'resultado', {lit(c)}" for c in rules.OUTCOME_CLASSES])
    return f"""WITH {labeled_ctes()},
  base AS {prepare_dashboard_cte('labeled')},
  wk AS {last_weeks_sql('base')},
  d AS (SELECT semana, tipo_carta AS tipo, {interview('categoria_final', 'dni_categorizado')} AS ent,
               {bucket('categoria_final')} AS res
        FROM base WHERE semana >= (SELECT min(semana) FROM wk) AND nivel_contacto = 'Se contacta'
          AND tipo_carta IN ('AUTOMATICA', 'MANUAL')),
  x AS (SELECT semana, tipo, 'entrevista' AS kind, ent AS clase FROM d
        UNION ALL SELECT semana, tipo, 'resultado', res FROM d),
  c AS (SELECT semana, tipo, kind, clase, count(*) AS n FROM x GROUP BY ALL),
  sp AS (SELECT wk.semana, t.tipo, k.kind, k.clase FROM wk, {values_list('tipo', ['AUTOMATICA', 'MANUAL'])}, ({kc}) k)
SELECT sp.semana, sp.tipo, sp.kind, sp.clase, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM sp LEFT JOIN c USING (semana, tipo, kind, clase)"""


def _dashboard_zone_preds() -> dict[str, str | None]:
    d = "comuna_calculada"
    return {"c2": f"{d} = 2", "c13": f"{d} = 13", "c14": f"{d} = 14", "zona1a": f"{d} = 1.5",
            "resto": f"NOT {in_priority(d)}", "total": None}


def _report_zone_preds() -> dict[str, str | None]:
    d, k = "comuna_calculada", "comuna_key"
    return {"1.5": f"{d} = 1.5", "2": f"{d} = 2", "12": f"{d} = 12", "13": f"{d} = 13", "14": f"{d} = 14",
            "todas": None, "resto": f"NOT coalesce({k} IN {in_list(rules.HIGHLIGHT_DISTRICT_KEYS)}, false)"}


def _q_outcome_breakdown() -> str:
    buckets = sorted(set(rules.BUCKET_BY_CATEGORY.values())) + [rules.BUCKET_DEFAULT]
    parts = []
    for name, pred in _dashboard_zone_preds().items():
        cond = "true" if pred is None else f"coalesce({pred}, false)"
        parts.append(f"""SELECT * FROM (WITH z AS (SELECT * FROM base WHERE {cond}),
          wk AS {last_weeks_sql('z')},
          c AS (SELECT semana, {bucket('categoria_final')} AS bucket, count(*) AS n FROM z
                WHERE semana >= (SELECT min(semana) FROM wk) AND nivel_contacto = 'Se contacta' GROUP BY ALL)
          SELECT {lit(name)} AS zone, wk.semana, t.bucket, CAST(coalesce(c.n, 0) AS BIGINT) AS n
          FROM wk CROSS JOIN {values_list('bucket', buckets)} LEFT JOIN c ON wk.semana = c.semana AND t.bucket = c.bucket)""")
    return f"""WITH {labeled_ctes()},
  base AS {prepare_dashboard_cte('labeled')}
{' UNION ALL '.join(parts)}"""


def _evolution_sql(base_cte: str, preds: dict[str, str | None]) -> str:
    parts = []
    for name, pred in preds.items():
        cond = "true" if pred is None else f"coalesce({pred}, false)"
        axis_src = "z" if name == "resto" else "base"
        parts.append(f"""SELECT * FROM (WITH z AS (SELECT * FROM base WHERE {cond}),
          wk AS {last_weeks_sql(axis_src)},
          per AS (SELECT semana, dni_categorizado, lab FROM (
                    SELECT semana, dni_categorizado,
                           CASE WHEN tipo_evolucion = 'Nuevo repetido' THEN 'Nuevos' ELSE tipo_evolucion END AS lab,
                           row_number() OVER (PARTITION BY semana, dni_categorizado ORDER BY fecha_inicio, _seq) AS rn
                    FROM z) WHERE rn = 1),
          c AS (SELECT semana, count(*) FILTER (WHERE lab = 'Nuevos') AS nuevos,
                       count(*) FILTER (WHERE lab = 'Recurrentes') AS recurrentes,
                       count(*) FILTER (WHERE lab = 'Migratorios') AS migratorios FROM per GROUP BY semana)
          SELECT {lit(name)} AS zone, wk.semana, CAST(coalesce(c.nuevos, 0) AS BIGINT) AS nuevos,
                 CAST(coalesce(c.recurrentes, 0) AS BIGINT) AS recurrentes,
                 CAST(coalesce(c.migratorios, 0) AS BIGINT) AS migratorios
          FROM wk LEFT JOIN c ON wk.semana = c.semana)""")
    return f"""WITH {labeled_ctes()},
  base AS {base_cte}
{' UNION ALL '.join(parts)}"""


def _q_evolution_weekly() -> str:
    return _evolution_sql(prepare_dashboard_cte('labeled'), _dashboard_zone_preds())


def _q_evolution_report() -> str:
    return _evolution_sql(prepare_weekly_cte('labeled'), _report_zone_preds())


def _q_chart_payload() -> str:
    inner = _q_evolution_weekly()
    return f"""WITH ev AS ({inner})
SELECT zone, to_json({{'labels': list(strftime(semana, '%d %b') ORDER BY semana),
                       'datasets': [{{'label': 'Nuevos', 'data': list(nuevos ORDER BY semana), 'backgroundColor': '#10B981'}},
                                    {{'label': 'Recurrentes', 'data': list(recurrentes ORDER BY semana), 'backgroundColor': '#3B82F6'}},
                                    {{'label': 'Migratorios', 'data': list(migratorios ORDER BY semana), 'backgroundColor': '#F97316'}}]}})::VARCHAR AS payload
FROM ev GROUP BY zone"""


def _q_batch_quality() -> str:
    return f"""WITH {clean_ctes()}
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(*) FILTER (WHERE categoria_final = 'sin_match') AS BIGINT) AS n_sin_match,
       CAST(count(*) FILTER (WHERE comuna_calculada = 1.5) AS BIGINT) AS n_subzone,
       CAST(count(*) FILTER (WHERE comuna_calculada BETWEEN 1 AND 15) AS BIGINT) AS n_district,
       CAST(count(*) FILTER (WHERE comuna_calculada IS NULL) AS BIGINT) AS n_no_zone FROM cb"""


def _q_schema_align() -> str:
    return f"""WITH {base_ctes()}
SELECT _seq, id_suceso, fecha_inicio, persona_dni, persona_nombre, latitud, CAST(NULL AS VARCHAR) AS agencia,
       resultado, cierre_supervisor FROM interventions"""


def _q_legacy_headers() -> str:
    return f"""WITH {base_ctes()}
SELECT id_suceso, fecha_inicio, persona_dni, tipo_carta, cierre_supervisor FROM interventions"""


def _q_landing_dates() -> str:
    def parsed(*orders: str) -> str:
        forms = ["%Y-%m-%d"] + [f"{o.replace('/', sep)}{time}" for o in orders for sep in "/-" for time in ("", " %H:%M")]
        return "coalesce(" + ", ".join(f"try_strptime(fecha_texto, '{f}')" for f in forms) + ")"
    return f"""WITH e AS (SELECT event_id, {LANDING_DATE_TEXT} AS fecha_texto FROM events)
SELECT event_id, fecha_texto, {parsed('%m/%d/%Y', '%d/%m/%Y')} AS month_first,
       {parsed('%d/%m/%Y', '%m/%d/%Y')} AS day_first FROM e"""


def _q_header_collisions() -> str:
    return f"""WITH {base_ctes()}
SELECT _seq, id_suceso, persona_dni, origen AS subtipo, fecha_fin AS recurso_arribo,
       CAST(NULL AS TIMESTAMP) AS recurso_fecha_liberado FROM interventions"""


def _q_union_by_name() -> str:
    return f"""WITH {clean_ctes()}
SELECT _seq, id_suceso, fecha_inicio, categoria_final, CAST(NULL AS DOUBLE) AS comuna_calculada FROM ch
UNION ALL
SELECT _seq, CAST(NULL AS VARCHAR), fecha_inicio, categoria_final, comuna_calculada FROM cb"""


def _q_evolution_stream() -> str:
    return f"""WITH {base_ctes()},
  ca AS {clean_cte('interventions')},
  empty_h AS (SELECT * FROM ca WHERE false),
  l AS (SELECT * FROM {classify_cte('ca', 'empty_h')})
SELECT _seq, dni_categorizado, comuna_calculada, tipo_evolucion, apariciones FROM l"""


def two_runs_ctes() -> str:
    """first: the labelled history; kept: it after the reconciliation; second: the new rows of the next export."""
    return f"""{clean_ctes()}, {reexport_cte()},
  empty_h AS (SELECT * FROM ch WHERE false),
  first AS (SELECT * FROM {classify_cte('ch', 'empty_h')}),
  pend AS (SELECT DISTINCT id_suceso FROM ch WHERE estado = 'PENDIENTE'),
  closed AS (SELECT * FROM reexp WHERE coalesce(trim(estado), '') <> 'PENDIENTE'
             AND id_suceso IN (SELECT id_suceso FROM pend)),
  oc AS {outcome_cols_select('closed')},
  u AS (SELECT trim(id_suceso) AS u_id, {', '.join(f'{c} AS u_{c}' for c in UPD_COLS)} FROM (
          SELECT *, row_number() OVER (PARTITION BY id_suceso ORDER BY _seq) AS rn FROM oc) WHERE rn = 1),
  kept AS (SELECT * EXCLUDE (u_id, {', '.join(f'u_{c}' for c in UPD_COLS)})
                  REPLACE ({', '.join(f'CASE WHEN upd THEN u_{c} ELSE {c} END AS {c}' for c in UPD_COLS)})
           FROM (SELECT f.*, u.*, (u.u_id IS NOT NULL AND coalesce(f.estado = 'PENDIENTE', false)) AS upd
                 FROM first f LEFT JOIN u ON f.id_suceso = u.u_id)),
  new_raw AS (SELECT * FROM reexp WHERE fecha_inicio > (SELECT max(fecha_inicio) FROM ch)),
  new_clean AS {clean_cte('new_raw')},
  second AS (SELECT * FROM {classify_cte('new_clean', 'ch')})"""


def _q_store_versions() -> str:
    columns = "_seq, estado, categoria_final, tipo_evolucion, apariciones"
    return f"""WITH {two_runs_ctes()},
  now AS (SELECT {columns} FROM kept UNION ALL SELECT {columns} FROM second)
SELECT 'first' AS version, {columns} FROM first UNION ALL SELECT 'second', {columns} FROM now
UNION ALL SELECT 'snapshot', {columns} FROM now"""


def _q_hierarchy_maintained() -> str:
    return f"""WITH {two_runs_ctes()},
  labeled AS (SELECT * EXCLUDE (upd) FROM kept UNION ALL BY NAME SELECT * FROM second),
  {hierarchy_base_sql()}
SELECT zone, semana, row_type, grupo, nivel, n FROM hf"""


def _q_appearances_stored() -> str:
    anon = f"dni_categorizado IN {in_list(rules.ANONYMOUS_ID_LABELS)}"
    person = (f"coalesce({anon}, false) AS anon, CASE WHEN {anon} THEN upper(trim(persona_nombre)) ELSE dni_categorizado END AS one, "
              f"CASE WHEN {anon} THEN upper(trim(persona_apellido)) ELSE '' END AS two")
    return f"""WITH {clean_ctes()},
  empty_h AS (SELECT * FROM ch WHERE false),
  st AS (SELECT *, {person} FROM {classify_cte('ch', 'empty_h')}),
  bk AS (SELECT DISTINCT anon, one, two FROM (SELECT {person} FROM cb) WHERE one IS NOT NULL AND two IS NOT NULL),
  al AS (SELECT anon, one, two FROM st UNION ALL SELECT {person} FROM cb),
  n AS (SELECT al.anon, al.one, al.two, count(*)::BIGINT AS n FROM al JOIN bk ON al.anon = bk.anon AND al.one = bk.one AND al.two = bk.two
        GROUP BY ALL)
SELECT st._seq, st.dni_categorizado, coalesce(n.n, st.apariciones) AS apariciones, n.n IS NOT NULL AS _updated
FROM st LEFT JOIN n ON st.anon = n.anon AND st.one = n.one AND st.two = n.two"""


def _q_landing_rejects() -> str:
    return f"""WITH {base_ctes()},
  l AS (SELECT _seq, _seq % 50 AS n, fecha_inicio IS NULL AS undated FROM interventions),
  r AS (SELECT _seq, n, CASE WHEN n = 5 THEN 'malformed' END AS a,
               CASE WHEN n = 0 THEN 'fecha_inicio: not parsed' WHEN n IN (1, 2) OR undated THEN 'fecha_inicio: absent' END AS b,
               CASE WHEN n = 3 THEN 'fecha_fin: not parsed' END AS c FROM l)
SELECT _seq, CASE WHEN coalesce(a, b) IS NULL THEN 'accepted' ELSE 'rejected' END AS status,
       CASE WHEN coalesce(a, b) IS NULL THEN NULL ELSE concat_ws(',', a, b, c) END AS reason FROM r
UNION ALL SELECT _seq, 'noted', c FROM r WHERE coalesce(a, b) IS NULL AND c IS NOT NULL"""


def _q_clean_outcome_scripts() -> str:
    text = "lower(coalesce(cierre_supervisor, resultado))"
    greek = f"upper(translate({text}, 'abgdezhiklmnopqrstuvwxyáé', 'αβγδεζθικλμνοπξρστυφψχωάέ'))"
    cyrillic = f"upper(translate({text}, 'abvgdejziyklmnoprstufhcqwxñ', 'абвгдежзийклмнопрстуфхцчшщю'))"
    return f"""WITH {base_ctes()}, s AS (SELECT _seq, {greek} AS g, {cyrillic} AS c FROM interventions)
SELECT _seq, {clean_outcome('g', True)} AS griego, {clean_outcome('c', True)} AS cirilico FROM s"""


def _q_landing_quoted() -> str:
    return """SELECT event_id AS id, event_type || chr(10) || coalesce(props, '') || ', "' || user_id || '"' AS nota, event_type AS tipo
FROM events WHERE event_id IS NOT NULL AND event_type IS NOT NULL AND user_id IS NOT NULL"""


def _q_weekly_counters() -> str:
    return f"""WITH {two_runs_ctes()}
SELECT (SELECT count(*) FROM kept WHERE upd)::BIGINT AS n_reconciled, count(*)::BIGINT AS n_rows,
       count(*) FILTER ({valid_id('dni_categorizado')})::BIGINT AS n_valid_id,
       count(*) FILTER (categoria_final = 'sin_match')::BIGINT AS n_no_match,
       count(*) FILTER (comuna_calculada IS NULL)::BIGINT AS n_without_zone,
       count(*) FILTER (apariciones > 1)::BIGINT AS n_repeat, max(apariciones)::BIGINT AS max_apariciones FROM second"""


def _q_value_remap_diff() -> str:
    renames = {k: v for k, v in rules.RAW_OUTCOME_REMAP.items() if v is not None}
    nullify = [k for k, v in rules.RAW_OUTCOME_REMAP.items() if v is None]
    remapped = (f"CASE WHEN resultado IN {in_list(nullify)} AND fecha_inicio >= TIMESTAMP "
                f"{lit(rules.REMAP_NULLIFY_FROM + ' 00:00:00')} THEN NULL "
                f"ELSE coalesce({case_map('resultado', renames)}, resultado) END")
    return f"""WITH {base_ctes()},
  both_sides AS (SELECT resultado AS value, 1 AS b, 0 AS a FROM interventions UNION ALL SELECT {remapped}, 0, 1 FROM interventions)
SELECT value, sum(b)::BIGINT AS n_before, sum(a)::BIGINT AS n_after, (sum(a) - sum(b))::BIGINT AS change
FROM both_sides GROUP BY value ORDER BY greatest(sum(b), sum(a)) DESC, value ASC NULLS FIRST LIMIT 30"""


def _q_weekly_stream_counts() -> str:
    return f"""WITH {base_ctes()}
SELECT {week('fecha_inicio')} AS semana, estado, CAST(count(*) AS BIGINT) AS n FROM interventions GROUP BY ALL"""


ORACLE: dict[str, str] = {
    "weekly_totals_by_zone": _q_weekly_totals_by_zone(),
    "last_n_weeks_spine": _q_last_n_weeks_spine(),
    "orders_weekly_reindex": _q_orders_weekly_reindex(),
    "watermark_filter": _q_watermark_filter(),
    "table_stats": _q_table_stats(),
    "catchup_delta": _q_watermark_filter(),
    "drop_exact_duplicates": _q_drop_exact_duplicates(),
    "keep_first_per_key": _q_keep_first_per_key(),
    "keep_last_per_key": _q_keep_last_per_key(),
    "clean_person_names": _q_clean_person_names(),
    "clean_names_documents": _q_clean_names_documents(),
    "clean_outcome_text": _q_clean_outcome_text(),
    "clean_outcome_documents": _q_clean_outcome_documents(),
    "dni_category": _dni("parity"),
    "dni_category_intended": _dni("intended"),
    "dni_valid": _q_dni_valid(),
    "category_rules": _q_category_rules(), "category_fuzzy": _q_category_fuzzy(),
    "category_levels": _q_category_levels(),
    "value_remap_audit": _q_value_remap_audit(),
    "value_remap_diff": _q_value_remap_diff(),
    "store_versions": _q_store_versions(),
    "weekly_counters": _q_weekly_counters(),
    "hierarchy_maintained": _q_hierarchy_maintained(),
    "appearances_stored": _q_appearances_stored(),
    "landing_rejects": _q_landing_rejects(),
    "landing_quoted": _q_landing_quoted(),
    "clean_outcome_scripts": _q_clean_outcome_scripts(),
    "value_distribution": _q_value_distribution(),
    "geo_zone": _q_geo_zone(),
    "geo_zone_layer": _q_geo_zone_layer(),
    "geo_zone_kml": _q_geo_zone_layer(),
    "asof_last_state": _q_asof_last_state(),
    "last_state_row_number": _q_last_state_row_number(),
    "evolution_labels": _q_evolution_labels(),
    "evolution_labels_state": _q_evolution_labels(),
    "appearance_summary": _q_appearance_summary(),
    "semi_join_counts": _q_semi_join_counts(),
    "appearances_composite_key": _q_appearances_composite_key(),
    "reconcile_pending": _q_reconcile_pending(),
    "keyed_update": _q_keyed_update(),
    "patch_from_lookup": _q_patch_from_lookup(),
    "contact_class": _q_contact_class(),
    "report_prepare": _q_report_prepare(),
    "dashboard_prepare": _q_dashboard_prepare(),
    "origin_groups": _q_origin_groups(),
    "kpi_table": _q_kpi_table(),
    "hierarchy_counts": _q_hierarchy_counts(),
    "contact_breakdown": _q_contact_breakdown(),
    "contact_breakdown_dashboard": _q_contact_breakdown_dashboard(),
    "outcome_breakdown": _q_outcome_breakdown(),
    "evolution_weekly": _q_evolution_weekly(),
    "evolution_report": _q_evolution_report(),
    "chart_payload": _q_chart_payload(),
    "batch_quality": _q_batch_quality(),
    "schema_align": _q_schema_align(),
    "union_by_name": _q_union_by_name(),
    "legacy_headers": _q_legacy_headers(),
    "landing_dates": _q_landing_dates(),
    "header_collisions": _q_header_collisions(),
    "weekly_stream_counts": _q_weekly_stream_counts(),
    "evolution_stream": _q_evolution_stream(),
    "reconcile_summary": _q_reconcile_summary(),
    "snapshot_merge": _q_snapshot_merge(),
    "report_week_range": _q_report_week_range(),
    "late_arrivals": _q_late_arrivals(),
}
