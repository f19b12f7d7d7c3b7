"""DuckDB oracle SQL, one statement per registered query.

Written independently of the Spark plans: RE2 regexes, DuckDB list lambdas,
unnest. Only the fixed values (word lists, templates) are shared.
"""

from __future__ import annotations

from ..functions import text as tx
from ..sources.tables import WS_CLASS
from ..sources.views import with_views

ORACLE: dict[str, str] = {}

PUNCT = r"[^\pL\pN_" + WS_CLASS + "]"
WS_RUN = "[" + WS_CLASS + "]+"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def sql_list(items) -> str:
    return ", ".join(q(i) for i in items)


def d_clean_basic(x: str) -> str:
    return (f"regexp_replace(regexp_replace(lower(coalesce(CAST({x} AS VARCHAR), '')), "
            f"'{PUNCT}', ' ', 'g'), '\\p{{Nd}}+', ' ', 'g')")


def d_tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS_RUN}'), lambda t: t <> '')"


def d_expand(toks: str) -> str:
    cases = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in tx.SHORTHAND.items())
    return (f"flatten(list_transform(list_transform({toks}, lambda t: CASE t {cases} ELSE t END), "
            f"lambda t: string_split(t, ' ')))")


def d_basic_tokens(x: str) -> str:
    return d_expand(d_tokens(d_clean_basic(x)))


STOP_IN = sql_list(tx.ENGLISH_STOP_WORDS)


def d_remove_stop(toks: str) -> str:
    return f"list_filter({toks}, lambda t: t NOT IN ({STOP_IN}))"


def d_clean_nodict(x: str) -> str:
    return f"array_to_string({d_remove_stop(d_basic_tokens(x))}, ' ')"


def d_token_count(x: str) -> str:
    return f"CAST(len(list_filter(string_split({x}, ' '), lambda t: t <> '')) AS INTEGER)"


def d_strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS_CLASS}]+|[{WS_CLASS}]+$', '', 'g')"


SUPPORT_TEXT = "SELECT row_id, concat_ws(' ', short_text, long_text) AS query_text FROM support_queries"


def merge_with(ctes: str, sql: str) -> str:
    """``WITH <ctes> <sql>``, folding a leading WITH of ``sql`` into the list."""
    body = sql.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


def sq(sql: str) -> str:
    """Wrap SQL that reads ``support_text``."""
    return with_views(merge_with(f"support_text AS ({SUPPORT_TEXT})", sql), "support_queries")


def explode_pos(source: str, key: str, list_expr: str, out: str = "token") -> str:
    return (f"SELECT {key}, CAST(unnest(range(len(l))) AS INTEGER) AS pos, unnest(l) AS {out} "
            f"FROM (SELECT {key}, {list_expr} AS l FROM {source})")


# --- S1-S3 -------------------------------------------------------------------

ORACLE["load_trim_headers"] = "SELECT doc_id, text, lang, source, n_chars FROM documents"

ORACLE["resolve_text_column"] = (
    f"SELECT conv_id * 4294967296 + turn AS row_id, {d_strip("coalesce(CAST(text AS VARCHAR), '')")} AS query "
    "FROM conversations")

# --- T1-T5, T7, T9, T10, A4 --------------------------------------------------

ORACLE["clean_basic"] = f"SELECT doc_id, {d_clean_basic('text')} AS clean_basic FROM documents"

ORACLE["tokenize"] = explode_pos("documents", "doc_id", d_tokens(d_clean_basic("text")))

ORACLE["expand_shorthand"] = sq(explode_pos("support_text", "row_id", d_basic_tokens("query_text")))

ORACLE["remove_stopwords"] = sq(f"SELECT row_id, {d_clean_nodict('query_text')} AS clean FROM support_text")


HISTOGRAM_TEMPLATE = """
WITH x AS ({values}),
st AS (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
              CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM x),
b AS (SELECT CAST(least(floor(30.0 * (v - lo) / (hi - lo)) + 1, 30) AS INTEGER) AS bin, count(*) AS n
      FROM x, st GROUP BY 1),
g AS (SELECT CAST(i AS INTEGER) AS bin FROM range(1, 31) t(i))
SELECT g.bin, round(lo + (g.bin - 1) * (hi - lo) / 30.0, 4) AS bin_lo,
       round(lo + g.bin * (hi - lo) / 30.0, 4) AS bin_hi, coalesce(b.n, 0) AS n
FROM g CROSS JOIN st LEFT JOIN b ON b.bin = g.bin
"""




# --- E1-E7 -------------------------------------------------------------------

from ..functions import categories as cat  # noqa: E402
from ..functions import entities as ent  # noqa: E402


def d_lower(x: str) -> str:
    return f"lower(coalesce(CAST({x} AS VARCHAR), ''))"


def d_order_id(s: str) -> str:
    return f"nullif(regexp_extract({s}, '{ent.ORDER_ID_RE}'), '')"


def d_amount(s: str) -> str:
    return f"nullif(regexp_extract({s}, '{ent.AMOUNT_RE}'), '')"


def _d_month(m: str) -> str:
    return ("CASE substr(" + m + ", 1, 3) " +
            " ".join(f"WHEN '{m3}' THEN {i + 1}" for i, m3 in enumerate(ent.MONTHS3)) + " END")


def _d_int(x: str) -> str:
    return f"TRY_CAST(nullif({x}, '') AS INTEGER)"


def _d_ymd(y: str, m: str, d: str) -> str:
    return f"TRY_CAST(printf('%04d-%02d-%02d', {y}, {m}, {d}) AS DATE)"


def d_date(s: str) -> str:
    gate = " OR ".join(f"contains({s}, '{w}')" for w in ent.DATE_GATE_WORDS)
    t = d_strip(s)
    yr = str(ent.DEFAULT_REF_DATE.year)
    rel = " ".join(f"WHEN '{k}' THEN DATE '{v.isoformat()}'"
                   for k, v in ent.relative_dates(ent.DEFAULT_REF_DATE).items())

    def g(p, i):
        return f"regexp_extract({t}, '{p}', {i})"
    dmy = _d_ymd(f"coalesce({_d_int(g(ent.DMY_RE, 3))}, {yr})", _d_month(g(ent.DMY_RE, 2)),
                 _d_int(g(ent.DMY_RE, 1)))
    mdy = _d_ymd(f"coalesce({_d_int(g(ent.MDY_RE, 3))}, {yr})", _d_month(g(ent.MDY_RE, 1)),
                 _d_int(g(ent.MDY_RE, 2)))
    my_y, my_m = _d_int(g(ent.MY_RE, 2)), _d_month(g(ent.MY_RE, 1))
    my = _d_ymd(my_y, my_m,
                f"least({ent.DEFAULT_REF_DATE.day}, day(last_day({_d_ymd(my_y, my_m, '1')})))")
    parsed = (f"CASE WHEN regexp_matches({t}, '{ent.DMY_RE}') THEN {dmy} "
              f"WHEN regexp_matches({t}, '{ent.MDY_RE}') THEN {mdy} "
              f"WHEN regexp_matches({t}, '{ent.MY_RE}') THEN {my} "
              f"ELSE CASE {t} {rel} END END")
    return f"CASE WHEN {gate} THEN strftime({parsed}, '%Y-%m-%d') END"


def d_actions(s: str) -> str:
    return f"list_filter([{sql_list(ent.ACCOUNT_ACTIONS)}], lambda p: contains({s}, p))"


def d_intents(s: str) -> str:
    parts = []
    for words, label in ent.INTENT_RULES:
        cond = " OR ".join(f"contains({s}, '{w}')" for w in words)
        parts.append(f"CASE WHEN {cond} THEN '{label}' END")
    return f"list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL)"


def d_entities(source: str, key: str, text: str) -> str:
    """(key, pos, type, value) rows: each rule emits rows with an ordinal, ranked per key."""
    s = d_lower(text)
    return f"""
WITH src AS (SELECT {key} AS k, {s} AS s FROM {source}),
parts AS (
  SELECT k, 0 AS ord, 'OrderID' AS type, {d_order_id('s')} AS value FROM src
  UNION ALL SELECT k, 1, 'Amount', {d_amount('s')} FROM src
  UNION ALL SELECT k, 2, 'Date', {d_date('s')} FROM src
  UNION ALL SELECT k, 10 + generate_subscripts(a, 1), 'AccountAction', unnest(a)
            FROM (SELECT k, {d_actions('s')} AS a FROM src)
  UNION ALL SELECT k, 100 + generate_subscripts(a, 1), 'Intent', unnest(a)
            FROM (SELECT k, {d_intents('s')} AS a FROM src))
SELECT k AS {key}, CAST(row_number() OVER (PARTITION BY k ORDER BY ord) - 1 AS INTEGER) AS pos,
       type, value
FROM parts WHERE value IS NOT NULL"""


SHORT = "(SELECT row_id, short_text FROM support_queries)"

ORACLE["entity_order_id"] = sq(f"SELECT row_id, {d_order_id(d_lower('query_text'))} AS order_id FROM support_text")
ORACLE["entity_amount"] = sq(f"SELECT row_id, {d_amount(d_lower('query_text'))} AS amount FROM support_text")
ORACLE["entity_date"] = with_views(
    f"SELECT row_id, {d_date(d_lower('short_text'))} AS date FROM support_queries",
    "support_queries")
def _date_mentions_sql() -> str:
    """Anchored matches at every word start, then the leftmost that do not
    overlap; RE2 has no look-around, so what may follow is matched too."""
    import datetime as dt

    from ..functions import dates as dm
    from ..functions.entities import DEFAULT_REF_DATE as ref

    month_of = " ".join(f"WHEN {q(w)} THEN {i}" for i, g in enumerate(dm.MONTHS, 1) for w in g.split())
    days = {w: n for n, g in dm.RELATIVE.items() for w in g.split()}
    for i, g in enumerate(dm.DAYS):
        days |= dict.fromkeys(g.split(), -((ref.weekday() - i - 1) % 7 + 1))
    near = " ".join(f"WHEN {q(w)} THEN {q(str(ref + dt.timedelta(days=n)))}" for w, n in days.items())
    forms = "|".join(dm.FORMS).replace("'", "''")
    loose = f"'^({forms})(?:$|[^\\pL\\pN_./-]|[./-](?:$|[^0-9]))'"
    starts = "regexp_matches(substr(s, i, 1), '[\\pL\\pN_]') AND NOT regexp_matches(substr(s, i - 1, 1), '[\\pL\\pN_]')"
    day = "CAST(TRY_CAST({}||'-'||{}||'-'||{} AS DATE) AS VARCHAR)"
    return f"""
WITH t AS (SELECT row_id, lower(query_text) AS s FROM support_text),
p AS (SELECT row_id, s, unnest(range(1, length(s) + 1)) AS i FROM t),
c AS (SELECT row_id, i - 1 AS a, regexp_extract(substr(s, i), {loose}, 1) AS m FROM p
      WHERE {starts.replace("substr(s, i - 1, 1)", "CASE WHEN i > 1 THEN substr(s, i - 1, 1) ELSE '' END")}
        AND NOT regexp_matches(CASE WHEN i > 2 THEN substr(s, i - 2, 2) ELSE '' END, '^[0-9][./-]$')),
l AS (SELECT row_id, list(struct_pack(a := a, m := m) ORDER BY a) AS c FROM c WHERE m <> '' GROUP BY row_id),
g AS (SELECT row_id, unnest(list_reduce(list_transform(c, lambda x: [x]), lambda acc, x:
        CASE WHEN x[1].a >= acc[-1].a + length(acc[-1].m) THEN list_concat(acc, x) ELSE acc END)) AS k FROM l),
n AS (SELECT row_id, k.a AS a, k.m AS m, list_transform(regexp_extract_all(k.m, '[0-9]+'), lambda v: CAST(v AS INTEGER)) AS num,
             len(regexp_extract(k.m, '[0-9]+')) AS w,
             list_filter(list_transform(regexp_extract_all(k.m, '\\pL+'), lambda v: CASE v {month_of} END),
                         lambda v: v IS NOT NULL)[1] AS mo FROM g),
d AS (SELECT row_id, a, m, CASE
        WHEN regexp_matches(m, '^[0-9]{{4}}-') THEN {day.format('num[1]', 'num[2]', 'num[3]')}
        WHEN regexp_matches(m, '^[0-9]{{1,2}}[./][0-9]') THEN {day.format('num[3]', 'num[2]', 'num[1]')}
        WHEN len(num) = 0 THEN CASE m {near} END
        WHEN len(num) = 2 THEN {day.format('num[2]', 'mo', 'num[1]')}
        WHEN w = 4 THEN {day.format('num[1]', 'mo', f"least({ref.day}, day(last_day(make_date(num[1], mo, 1))))")}
        ELSE {day.format(str(ref.year), 'mo', 'num[1]')} END AS date FROM n)
SELECT row_id, CAST(a AS INTEGER) AS start, CAST(a + length(m) AS INTEGER) AS "end", m AS mention, date
FROM d WHERE date IS NOT NULL"""


ORACLE["entity_date_mentions"] = sq(_date_mentions_sql())

ORACLE["entity_account_action"] = sq(explode_pos(
    f"(SELECT row_id, {d_lower('query_text')} AS s FROM support_text)", "row_id", d_actions("s"), "action"))
ORACLE["entity_intent"] = sq(explode_pos(
    f"(SELECT row_id, {d_lower('query_text')} AS s FROM support_text)", "row_id", d_intents("s"), "intent"))
ORACLE["extract_entities"] = sq(d_entities("support_text", "row_id", "query_text"))
ORACLE["entities_on_raw"] = d_entities("documents", "doc_id", "text")


# --- C1-C3 -------------------------------------------------------------------

def d_normalize_category(category: str, sub: str) -> str:
    s = f"lower(coalesce(CAST({sub} AS VARCHAR), ''))"
    c = f"upper(coalesce(CAST({category} AS VARCHAR), ''))"
    whens = []
    for words, label in cat.CATEGORY_RULES:
        cond = " OR ".join(f"contains({s}, '{w}')" for w in words)
        whens.append(f"WHEN {cond} THEN '{label}'")
    return f"CASE {' '.join(whens)} WHEN {c} <> '' THEN {c} ELSE 'OTHER' END"


ORACLE["normalize_category"] = with_views(
    f"SELECT row_id, {d_normalize_category('category', 'sub_category')} AS normalized_category "
    "FROM support_queries", "support_queries")

ORACLE["add_normalized_category"] = with_views(
    f"SELECT row_id, category, {d_normalize_category('category', 'sub_category')} AS normalized_category "
    "FROM support_queries", "support_queries")

# --- L1, L4, L5, L10, A1-A3 --------------------------------------------------

from ..functions import judge as jg  # noqa: E402
from ..functions import prompts as pr  # noqa: E402


def d_msgs(system: str, user: str) -> str:
    return f"[{{'role': 'system', 'content': {q(system)}}}, {{'role': 'user', 'content': {user}}}]"


ORACLE["build_prompts"] = with_views(f"""
WITH t AS (
  SELECT row_id, 'synthetic' AS task, {d_msgs(pr.SYNTHETIC_SYSTEM, "'Write 3 different customer messages about ' || coalesce(query, 'null') || '.'")} AS m
  FROM support_responses
  UNION ALL SELECT row_id, 'reply' AS task, {d_msgs(pr.REPLY_SYSTEM, "'Customer message:' || chr(10) || coalesce(query, '')")} AS m
  FROM support_responses
  UNION ALL SELECT row_id, 'judge', {d_msgs(pr.JUDGE_SYSTEM, "CAST(to_json({'query': query, 'reply': response}) AS VARCHAR)")}
  FROM support_responses
  UNION ALL SELECT row_id, 'classify', {d_msgs(pr.CLASSIFY_SYSTEM, "coalesce(query, '')")} FROM support_responses),
e AS (SELECT row_id, task, CAST(generate_subscripts(m, 1) - 1 AS INTEGER) AS pos, unnest(m) AS msg FROM t)
SELECT row_id, task, pos, msg.role AS role, msg.content AS content FROM e
""", "support_responses")


def d_json_object(raw: str) -> str:
    """Text of the JSON object in ``raw``, or '{}' (not JSON, not an object, NULL)."""
    return f"CASE WHEN coalesce(try(json_type({raw})) = 'OBJECT', false) THEN {raw} ELSE '{{}}' END"


def d_coerce(j: str, key: str) -> str:
    """Integer conversion of any size in DOUBLE, clamped to 1..5, else 1."""
    p = f"'$.{key}'"
    conv = (f"CASE json_type({j}, {p}) "
            f"WHEN 'BIGINT' THEN CAST({j}->>{p} AS DOUBLE) "
            f"WHEN 'UBIGINT' THEN CAST({j}->>{p} AS DOUBLE) "
            f"WHEN 'HUGEINT' THEN CAST({j}->>{p} AS DOUBLE) "
            f"WHEN 'DOUBLE' THEN trunc(CAST({j}->>{p} AS DOUBLE)) "
            f"WHEN 'VARCHAR' THEN CASE WHEN regexp_full_match({j}->>{p}, '\\s*[+-]?[0-9]+\\s*') "
            f"THEN TRY_CAST(trim({j}->>{p}) AS DOUBLE) END "
            f"WHEN 'BOOLEAN' THEN CASE WHEN {j}->>{p} = 'true' THEN 1 ELSE 0 END "
            f"ELSE NULL END")
    return f"CAST(greatest(1, least(5, coalesce({conv}, 1))) AS INTEGER)"


def d_explanation(j: str) -> str:
    """The text of an explanation; absent, null, empty, false and zero count as none."""
    p, none = "'$.explanation'", q(jg.DEFAULT_EXPLANATION)
    return (f"CASE WHEN json_type({j}, {p}) = 'VARCHAR' THEN coalesce(nullif({j}->>{p}, ''), {none}) "
            f"WHEN coalesce({j}->>{p}, '') IN ('', 'false', '[]', '{{}}') THEN {none} "
            f"WHEN TRY_CAST({j}->>{p} AS DOUBLE) = 0 THEN {none} ELSE {j}->>{p} END")


def d_score(j: str, key: str, default: int) -> str:
    return f"CASE WHEN json_type({j}, '$.{key}') IS NULL THEN {default} ELSE {d_coerce(j, key)} END"


JUDGE_PARSED = f"""
SELECT row_id, {d_score('j', 'relevance', jg.SCORE_DEFAULTS['relevance'])} AS relevance,
       {d_score('j', 'helpfulness', jg.SCORE_DEFAULTS['helpfulness'])} AS helpfulness,
       {d_score('j', 'tone', jg.SCORE_DEFAULTS['tone'])} AS tone,
       {d_explanation('j')} AS explanation
FROM (SELECT row_id, {d_json_object('raw')} AS j FROM judge_raw)
"""


def jq(sql: str) -> str:
    return with_views(merge_with(f"scores AS ({JUDGE_PARSED})", sql), "judge_raw")


ORACLE["coerce_score"] = with_views(
    f"SELECT row_id, {d_coerce('j', 'helpfulness')} AS score "
    f"FROM (SELECT row_id, {d_json_object('raw')} AS j FROM judge_raw)", "judge_raw")

ORACLE["parse_judge_scores"] = jq("SELECT * FROM scores")

ORACLE["parse_synthetic_queries"] = with_views(explode_pos(
    "synthetic_raw", "topic_id, topic",
    f"list_transform(list_filter(string_split(coalesce(raw, ''), chr(10)), "
    f"lambda l: {d_strip('l')} <> ''), lambda l: regexp_replace(l, '^[0-9. ]+|[0-9. ]+$', '', 'g'))",
    "query"), "synthetic_raw")

AVG_SQL = ("SELECT count(*) AS n, " + ", ".join(
    f"CAST(coalesce(sum(coalesce({m}, 0)), 0) AS BIGINT) AS sum_{m}, "
    f"round(coalesce(sum(coalesce({m}, 0)), 0) / greatest(1, count(*)), 3) AS avg_{m}"
    for m in ("relevance", "helpfulness", "tone")) + " FROM scores")

DIST_SQL = ("SELECT metric, score, count(*) AS n FROM (" + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, CAST(coalesce({m}, 0) AS INTEGER) AS score FROM scores"
    for m in ("relevance", "helpfulness", "tone")) + ") GROUP BY ALL")


# --- M3-M10 ------------------------------------------------------------------

ORACLE["l2_normalize"] = """
WITH s AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x, i: x * i) AS v FROM embeddings),
n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS nrm FROM s)
SELECT vec_id, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS pos,
       round(CASE WHEN nrm > 0 THEN unnest(v) / nrm ELSE 0.0 END, 4) + 0.0 AS value
FROM n
"""

CENTROIDS_SQL = """
centroids AS (
  SELECT topic, list(x ORDER BY pos) AS c FROM (
    SELECT label AS topic, pos, avg(x) AS x FROM (
      SELECT label, generate_subscripts(embedding, 1) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x
      FROM embeddings) GROUP BY ALL) GROUP BY topic),
assigned AS (
  SELECT vec_id, embedding, topic FROM (
    SELECT e.vec_id, e.embedding, c.topic,
           row_number() OVER (PARTITION BY e.vec_id ORDER BY
             list_sum(list_transform(list_zip(CAST(e.embedding AS DOUBLE[]), c.c),
                                     lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c.topic) AS rn
    FROM embeddings e CROSS JOIN centroids c) WHERE rn = 1)
"""

ORACLE["kmeans_assign"] = f"WITH {CENTROIDS_SQL} SELECT vec_id, topic FROM assigned"

ORACLE["kmeans_step"] = f"""
WITH {CENTROIDS_SQL},
m AS (SELECT topic, pos, avg(x) AS x, count(*) AS members FROM (
  SELECT topic, generate_subscripts(embedding, 1) - 1 AS pos, CAST(unnest(embedding) AS DOUBLE) AS x
  FROM assigned) GROUP BY ALL)
SELECT topic, CAST(pos AS INTEGER) AS pos, round(x, 4) + 0.0 AS value, members FROM m
"""

ORACLE["unique_clusters"] = f"WITH {CENTROIDS_SQL} SELECT count(DISTINCT topic) AS unique_clusters FROM assigned"

ORACLE["topic_samples"] = """
WITH d AS (SELECT d.doc_id, d.text, l.quality * 2 + l.toxic AS topic
           FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
r AS (SELECT topic, doc_id, text, row_number() OVER (PARTITION BY topic ORDER BY doc_id) AS rk FROM d)
SELECT topic, CAST(rk - 1 AS INTEGER) AS pos, text AS sample FROM r WHERE rk <= 5
"""

ORACLE["topic_head"] = """
SELECT topic, vec_id, CAST(rk AS INTEGER) AS rank FROM (
  SELECT label AS topic, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rk
  FROM embeddings) WHERE rk <= 5
"""


# --- T6, T8, T11, T12 --------------------------------------------------------

from ..operators import lemmas as lm  # noqa: E402

# DuckDB's edit distances count bytes; mapping the accented Latin-1 letters to
# ASCII symbols that cannot occur in tokens (upper case, digits) makes them
# count characters.
ACCENTED = "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
ASCII_SLOTS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456"

LEXICON_CTE = """lex AS (
  SELECT word, count(*) AS freq FROM (
    SELECT unnest(regexp_extract_all(lower(text), '\\pL+')) AS word FROM documents)
  GROUP BY word QUALIFY count(*) * 1000000 >= sum(count(*)) OVER () * 50 AND length(word) >= 2)"""


def d_ascii(x: str) -> str:
    return f"translate({x}, '{ACCENTED}', '{ASCII_SLOTS}')"


SPELL_CTES = f"""{LEXICON_CTE},
vocab AS (SELECT DISTINCT token FROM toks WHERE token IS NOT NULL),
unk AS (SELECT token, {d_ascii('token')} AS ta, length(token) AS tl
        FROM vocab WHERE length(token) > 1 AND token NOT IN (SELECT word FROM lex)),
lexa AS (SELECT word, freq, {d_ascii('word')} AS wa, length(word) AS wl FROM lex),
cand AS (SELECT u.token, l.word, l.freq, damerau_levenshtein(u.ta, l.wa) AS d
         FROM unk u JOIN lexa l ON l.wl BETWEEN u.tl - 2 AND u.tl + 2),
best AS (SELECT token, word AS suggestion, CAST(d AS INTEGER) AS distance FROM (
           SELECT *, row_number() OVER (PARTITION BY token ORDER BY d, freq DESC, word) AS rn
           FROM cand WHERE d <= 2) WHERE rn = 1)"""


def d_lemma_cands(w: str) -> str:
    outs = [w]
    for suf, rep in lm.NOUN_RULES:
        outs.append(f"CASE WHEN ends_with({w}, '{suf}') AND length({w}) >= {len(suf)} "
                    f"THEN substring({w}, 1, length({w}) - {len(suf)}) || '{rep}' END")
    return f"list_filter([{', '.join(outs)}], lambda x: x IS NOT NULL)"


def lemma_ctes(src: str) -> str:
    """CTE ``lem(w, lemma)`` for the distinct words in column w of ``src``."""
    return f"""lc AS (SELECT w, unnest({d_lemma_cands('w')}) AS cand FROM (SELECT DISTINCT w FROM {src})),
lem AS (SELECT w, arg_min(cand, (length(cand), cand)) AS lemma
        FROM lc WHERE cand IN (SELECT word FROM lex) GROUP BY w)"""


CLEAN_OR_EMPTY = "coalesce(a.clean, '')"


def clean_sql(source: str, key: str, text: str, correct=True, lemmatize=True, stop=True,
              extra_cols: str = "") -> str:
    toks = explode_pos(source, key, d_basic_tokens(text))
    ctes = [f"toks AS ({toks})", SPELL_CTES]
    w_expr = "coalesce(b.suggestion, v.token)" if correct else "v.token"
    ctes.append(f"corr AS (SELECT v.token, {w_expr} AS w FROM vocab v LEFT JOIN best b ON b.token = v.token)")
    keep = f"w NOT IN ({STOP_IN})" if stop else "true"
    ctes.append(f"kept AS (SELECT token, w FROM corr WHERE {keep})")
    if lemmatize:
        ctes.append(lemma_ctes("kept"))
        ctes.append("fin AS (SELECT k.token, coalesce(l.lemma, k.w) AS out FROM kept k LEFT JOIN lem l ON l.w = k.w)")
    else:
        ctes.append("fin AS (SELECT token, w AS out FROM kept)")
    ctes.append(f"""agg AS (SELECT t.{key} AS k, string_agg(f.out, ' ' ORDER BY t.pos) AS clean
                FROM toks t JOIN fin f ON f.token = t.token GROUP BY t.{key})""")
    body = (f"SELECT s.{key}{extra_cols}, coalesce(a.clean, '') AS clean, "
            f"{d_token_count(CLEAN_OR_EMPTY)} AS length "
            f"FROM {source} s LEFT JOIN agg a ON a.k = s.{key}")
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _drop_length(sql: str) -> str:
    return f"SELECT * EXCLUDE (length) FROM ({sql})"


ORACLE["build_lexicon"] = f"WITH {LEXICON_CTE} SELECT word, freq FROM lex"

ORACLE["spell_suggest"] = sq(
    f"WITH toks AS ({explode_pos('support_text', 'row_id', d_basic_tokens('query_text'))}),\n"
    f"{SPELL_CTES}\nSELECT token, suggestion, distance FROM best")

ORACLE["spell_correct"] = sq(_drop_length(
    clean_sql("support_text", "row_id", "query_text", correct=True, lemmatize=False, stop=False)))

def _noisy_ctes() -> str:
    from ..operators import noisy_channel as nc

    cost = lambda p: f"CAST(floor(-1000 * ln({p})) AS BIGINT)"
    share = lambda f: f"(({f}) + {nc.SEEN}) / (SELECT mass FROM tot)"
    return f"""toks AS ({explode_pos('support_text', 'row_id', d_basic_tokens('query_text'))}),
runs AS (SELECT regexp_extract_all(lower(coalesce(text, '')), '\\pL+') AS w FROM
         (SELECT text FROM documents UNION ALL SELECT query_text FROM support_text)),
wf AS (SELECT word, count(*) AS freq FROM (SELECT unnest(w) AS word FROM runs) GROUP BY word),
tot AS (SELECT sum(freq) + {nc.SEEN} * count(*) AS mass FROM wf),
bi AS (SELECT a, b, count(*) AS n FROM (SELECT unnest(w[:-2]) AS a, unnest(w[2:]) AS b FROM runs WHERE len(w) > 1)
       GROUP BY a, b),
wc AS (SELECT word, freq, {cost(share('freq'))} AS cost, {d_ascii('word')} AS wa FROM wf),
vc AS (SELECT token, {d_ascii('token')} AS ta, coalesce(cost, {cost(share('0'))}) AS cost
       FROM (SELECT DISTINCT token FROM toks) LEFT JOIN wc ON word = token WHERE length(token) >= {nc.MIN_TOKEN}),
near AS (SELECT token, word AS w, damerau_levenshtein(ta, wa) AS d, v.cost AS tc, c.cost AS cc FROM vc v JOIN wc c
         ON c.cost + {nc.EDIT} < v.cost AND abs(length(wa) - length(ta)) <= 2 AND length(word) >= {nc.MIN_TOKEN}),
fit AS (SELECT token, w, CAST(d * {nc.EDIT} AS BIGINT) AS e FROM near WHERE d BETWEEN 1 AND 2 AND cc + {nc.EDIT} * d < tc
        AND (d = 1 OR greatest(length(token), length(w)) > 2)),
opt AS (SELECT token, w, e FROM fit UNION ALL SELECT DISTINCT token, token, 0 FROM fit),
node AS (SELECT row_id, pos, t.token, coalesce(w, t.token) AS w, coalesce(e, 0) AS e, w IS NOT NULL AS open
         FROM toks t LEFT JOIN opt ON opt.token = t.token),
pairs AS (SELECT DISTINCT coalesce(p.w, '') AS a, n.w AS b FROM node n LEFT JOIN node p
          ON p.row_id = n.row_id AND p.pos = n.pos - 1 WHERE n.open OR coalesce(p.open, false)),
pc AS (SELECT a, b, CASE WHEN a = '' THEN {cost(share('coalesce(fb.freq, 0)'))} ELSE
       {cost(f"coalesce({nc.CONTEXT} * n / fa.freq, 0.0) + {1 - nc.CONTEXT} * (" + share('coalesce(fb.freq, 0)') + ")")} END AS c
       FROM pairs LEFT JOIN bi USING (a, b) LEFT JOIN wf fa ON fa.word = a LEFT JOIN wf fb ON fb.word = b),
path AS (SELECT row_id, CAST(-1 AS INTEGER) AS pos, '' AS w, CAST(0 AS BIGINT) AS cost, false AS open,
                CAST([] AS VARCHAR[]) AS words FROM support_text
         UNION ALL
         SELECT n.row_id, n.pos, n.w, min(p.cost + CASE WHEN n.open OR p.open THEN c ELSE 0 END) + any_value(n.e),
                any_value(n.open), list_append(arg_min(p.words, (p.cost + CASE WHEN n.open OR p.open THEN c ELSE 0 END, p.w)), n.w)
         FROM path p JOIN node n ON n.row_id = p.row_id AND n.pos = p.pos + 1
              LEFT JOIN pc ON pc.a = p.w AND pc.b = n.w GROUP BY n.row_id, n.pos, n.w),
ends AS (SELECT row_id, max(pos) AS pos FROM path GROUP BY row_id),
fixed AS (SELECT row_id, arg_min(words, (cost, w)) AS words FROM path JOIN ends USING (row_id, pos) GROUP BY row_id),
written AS (SELECT row_id, {d_basic_tokens('query_text')} AS toks FROM support_text)"""


def _recursive(sql: str) -> str:
    assert sql.startswith("WITH ")
    return "WITH RECURSIVE " + sql[5:]


ORACLE["spell_noisy_channel"] = _recursive(sq(
    f"WITH {_noisy_ctes()}\nSELECT row_id, array_to_string(toks, ' ') AS written, "
    "array_to_string(words, ' ') AS corrected FROM fixed JOIN written USING (row_id)"))

ORACLE["spell_rewrite_share"] = _recursive(sq(
    f"WITH {_noisy_ctes()},\nr AS (SELECT CAST(sum(len(words)) AS BIGINT) AS tokens, "
    "CAST(sum(len(list_filter(range(1, len(words) + 1), lambda i: words[i] <> toks[i]))) AS BIGINT) AS rewritten "
    "FROM fixed JOIN written USING (row_id))\n"
    "SELECT tokens, rewritten, round(rewritten / greatest(tokens, 1), 6) AS share FROM r"))


ORACLE["lemmatize"] = sq(
    f"WITH toks AS ({explode_pos('support_text', 'row_id', d_basic_tokens('query_text'))}),\n"
    f"{LEXICON_CTE},\nv AS (SELECT DISTINCT token AS w FROM toks),\n{lemma_ctes('v')}\n"
    "SELECT w AS token, lemma FROM lem WHERE lemma <> w")

ORACLE["clean_text"] = sq(_drop_length(clean_sql("support_text", "row_id", "query_text")))

ORACLE["prepare_queries"] = sq(clean_sql("support_text", "row_id", "query_text",
                                         extra_cols=', s.query_text AS "Queries"'))

ORACLE["prepare_first_column"] = sq(clean_sql("support_text", "row_id", "query_text", extra_cols=", s.query_text AS message"))

ORACLE["clean_responses"] = with_views(
    _drop_length(clean_sql("support_responses", "row_id", "response")), "support_responses")


# --- L2, L3, L6, L7, L9, L10, M1, N1-N5 --------------------------------------

from ..operators import models as md  # noqa: E402
from ..operators import sentiment as sn  # noqa: E402


def d_stub_reply(content: str) -> str:
    return f"'Thanks for writing. We read ' || CAST(length({content}) AS VARCHAR) || ' characters.'"


def d_stub_judge(content: str) -> str:
    n = f"length({content})"
    return (f"'{{\"relevance\":' || CAST(1 + {n} % 5 AS VARCHAR) || ',\"helpfulness\":' || "
            f"CAST(1 + {n} % 7 AS VARCHAR) || ',\"tone\":' || CAST(2 + {n} % 4 AS VARCHAR) || "
            f"',\"explanation\":\"length ' || CAST({n} AS VARCHAR) || '\"}}'")


def d_judge_content(query: str, reply: str) -> str:
    return f"CAST(to_json({{'query': {query}, 'reply': {reply}}}) AS VARCHAR)"


def d_parsed_from(raw_sql: str) -> str:
    """Parse judge text column ``raw`` of ``raw_sql`` like JUDGE_PARSED does."""
    return f"""
SELECT row_id, {d_score('j', 'relevance', jg.SCORE_DEFAULTS['relevance'])} AS relevance,
       {d_score('j', 'helpfulness', jg.SCORE_DEFAULTS['helpfulness'])} AS helpfulness,
       {d_score('j', 'tone', jg.SCORE_DEFAULTS['tone'])} AS tone,
       {d_explanation('j')} AS explanation
FROM (SELECT row_id, {d_json_object('raw')} AS j FROM ({raw_sql}))"""


REPLY_CONTENT = "'Customer message:' || chr(10) || coalesce(query_text, '')"

ORACLE["llm_batch"] = with_views(
    f"SELECT row_id, {d_stub_judge(d_judge_content('query', 'response'))} AS text, "
    "CAST(NULL AS VARCHAR) AS error FROM support_responses", "support_responses")

ORACLE["generate_replies"] = sq(f"SELECT row_id, {d_stub_reply(REPLY_CONTENT)} AS response FROM support_text")

ORACLE["llm_ledger"] = ORACLE["generate_replies"]

ORACLE["llm_ledger_facts"] = sq("SELECT count(*) AS asked, count(*) AS answered, "
                                "count(DISTINCT coalesce(query_text, '')) AS paid FROM support_text")

ORACLE["topics_absorb"] = (f"WITH {CENTROIDS_SQL} SELECT topic, count(*) AS members, true AS cost_not_worse "
                           "FROM assigned GROUP BY topic")
ORACLE["topics_matched"] = ORACLE["kmeans_assign"]

ACTIVITY_SQL = """
SELECT CAST(ts AS DATE) AS day, event_type, CAST(grouping(CAST(ts AS DATE), event_type) AS INTEGER) AS level,
       count(*) AS n, count(DISTINCT user_id) AS users{more}
FROM events GROUP BY CUBE (CAST(ts AS DATE), event_type)
"""
ORACLE["activity_cube"] = ACTIVITY_SQL.format(more="")
ORACLE["activity_sketches_facts"] = ACTIVITY_SQL.format(more=", true AS same_as_one_pass, true AS near_exact")

ORACLE["text_cube"] = """
SELECT lang, source, CAST(grouping(lang, source) AS INTEGER) AS level, count(*) AS n, count(DISTINCT text) AS texts
FROM documents GROUP BY CUBE (lang, source)
"""

ORACLE["workbook_roundtrip"] = "SELECT conv_id, turn, role, text FROM conversations"

ORACLE["pair_by_position"] = """
WITH n AS (SELECT *, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) AS position FROM conversations)
SELECT position, u.conv_id AS query_conv, u.turn AS query_turn, u.text AS query,
       a.conv_id AS reply_conv, a.turn AS reply_turn, a.text AS response
FROM n u JOIN n a USING (position) WHERE u.role = 'user' AND a.role = 'assistant'
"""

ORACLE["asof_events"] = """
SELECT p.event_id, p.user_id, c.event_id AS click_event_id, round(c.value, 4) AS click_value,
       strftime(c.ts, '%Y-%m-%d %H:%M:%S') AS click_at
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c ON p.user_id = c.user_id AND p.ts > c.ts
"""

ORACLE["stream_window_counts"] = """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n,
       round(max(value), 4) AS largest, max(event_id) AS last_event FROM events GROUP BY ALL
"""
ORACLE["stream_pairing"] = """
SELECT u.conv_id, u.turn, u.text AS query, a.text AS response FROM (SELECT * FROM conversations WHERE role = 'user') u
LEFT JOIN (SELECT * FROM conversations WHERE role = 'assistant') a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
"""

ORACLE["judge_replies"] = with_views(d_parsed_from(
    f"SELECT row_id, {d_stub_judge(d_judge_content('query', 'response'))} AS raw FROM support_responses"),
    "support_responses")

_JUDGED = d_parsed_from(
    f"SELECT row_id, {d_stub_judge(d_judge_content('query', 'response'))} AS raw FROM support_responses")


def judged(sql: str) -> str:
    """Wrap SQL that reads the ``scores`` of every judged reply."""
    return with_views(merge_with(f"scores AS ({_JUDGED})", sql), "support_responses")


ORACLE["llm_quality_avg"] = judged(AVG_SQL)
ORACLE["llm_quality_dist"] = judged(DIST_SQL)
QUALITY_SQL = (f"""
WITH a AS ({AVG_SQL}), d AS ({DIST_SQL})
SELECT n, avg_relevance, avg_helpfulness, avg_tone,
""" + ",\n".join(
    f"coalesce((SELECT CAST(to_json(map_from_entries(list({{'k': CAST(score AS VARCHAR), 'v': n}} "
    f"ORDER BY score))) AS VARCHAR) "
    f"FROM d WHERE metric = '{m}'), '{{}}') AS dist_{m}" for m in ("relevance", "helpfulness", "tone"))
    + " FROM a")
ORACLE["llm_quality_summary"] = judged(QUALITY_SQL)

ORACLE["generate_and_score"] = sq(f"""
WITH g AS (SELECT row_id, query_text, {d_stub_reply(REPLY_CONTENT)} AS response FROM support_text),
p AS ({d_parsed_from(f"SELECT row_id, {d_stub_judge(d_judge_content('query_text', 'response'))} AS raw FROM g")})
SELECT g.row_id, g.response, p.relevance, p.helpfulness, p.tone, p.explanation
FROM g JOIN p ON p.row_id = g.row_id""")

ORACLE["classify_queries"] = sq(f"""
SELECT row_id, label, label IN ({sql_list(cat.TOP_CATEGORIES)}) AS label_in_taxonomy FROM (
  SELECT row_id, [{sql_list(md.STUB_LABELS)}][length(coalesce(query_text, '')) % 6 + 1] AS label
  FROM support_text)""")

_SYN_USER = "'Write 5 different customer messages about ' || topic || '.'"
_SYN_RAW = ("'1. ' || u || ' #1' || chr(10) || '2. ' || u || ' #2' || chr(10) || "
            "'3. ' || u || ' #3' || chr(10) || chr(10)")
ORACLE["generate_synthetic"] = explode_pos(
    f"(SELECT topic, {_SYN_RAW} AS raw FROM (SELECT topic, {_SYN_USER} AS u FROM "
    "(SELECT DISTINCT event_type AS topic FROM events WHERE event_type IS NOT NULL)))", "topic",
    f"list_transform(list_filter(string_split(coalesce(raw, ''), chr(10)), "
    f"lambda l: {d_strip('l')} <> ''), lambda l: regexp_replace(l, '^[0-9. ]+|[0-9. ]+$', '', 'g'))",
    "query")


def d_truncate(x: str, n: int = 256) -> str:
    text = f"coalesce(CAST({x} AS VARCHAR), '')"
    return f"array_to_string(list_slice({d_tokens(text)}, 1, {n}), ' ')"


ORACLE["truncate_tokens"] = f"SELECT doc_id, {d_truncate('text')} AS truncated FROM documents"

ORACLE["add_sentiment"] = with_views(
    f"SELECT row_id, CASE WHEN length({d_truncate('response')}) % 2 = 0 THEN 'POSITIVE' ELSE 'NEGATIVE' END "
    "AS sentiment FROM support_responses", "support_responses")


def d_lexicon_score(toks: str) -> str:
    return (f"CAST(len(list_filter({toks}, lambda w: w IN ({sql_list(sn.POSITIVE_WORDS)}))) - "
            f"len(list_filter({toks}, lambda w: w IN ({sql_list(sn.NEGATIVE_WORDS)}))) AS INTEGER)")


ORACLE["sentiment_lexicon"] = sq(
    f"SELECT row_id, CASE WHEN score >= 0 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS sentiment, score "
    f"FROM (SELECT row_id, {d_lexicon_score(d_basic_tokens('query_text'))} AS score FROM support_text)")

_SENTIMENTS = (f"SELECT row_id, CASE WHEN length({d_truncate('response')}) % 2 = 0 THEN 'POSITIVE' ELSE 'NEGATIVE' END "
               "AS sentiment FROM support_responses")

ORACLE["sentiment_counts"] = with_views(f"""
WITH c AS (SELECT sentiment, count(*) AS n FROM ({_SENTIMENTS}) GROUP BY 1),
o AS (SELECT * FROM (VALUES ('POSITIVE', 0), ('NEGATIVE', 1)) t(sentiment, ord))
SELECT o.sentiment, CAST(o.ord AS INTEGER) AS ord, coalesce(c.n, 0) AS n FROM o LEFT JOIN c USING (sentiment)
""", "support_responses")

ORACLE["sentiment_share"] = with_views(f"""
WITH c AS (SELECT sentiment, count(*) AS n FROM ({_SENTIMENTS}) GROUP BY 1)
SELECT sentiment, round(n * 100.0 / (SELECT sum(n) FROM c), 4) AS share FROM c
""", "support_responses")

ORACLE["sentiment_by_category"] = with_views(f"""
WITH j AS (SELECT {d_normalize_category('q.category', 'q.sub_category')} AS normalized_category, r.sentiment
           FROM support_queries q JOIN ({_SENTIMENTS}) r ON r.row_id = q.row_id),
c AS (SELECT normalized_category, sentiment, count(*) AS n FROM j GROUP BY ALL),
cats AS (SELECT normalized_category, count(*) AS category_total FROM j GROUP BY ALL),
labs AS (SELECT DISTINCT sentiment FROM j)
SELECT cats.normalized_category, labs.sentiment, coalesce(c.n, 0) AS n, cats.category_total
FROM cats CROSS JOIN labs
LEFT JOIN c ON c.normalized_category = cats.normalized_category AND c.sentiment = labs.sentiment
""", "support_queries", "support_responses")


def embed_ctes(name: str, source: str, key: str, text: str, dim: int = 16) -> str:
    """CTE ``name(key, pos, raw, value)``: counts of words by md5 bucket, and
    the same at unit length."""
    bucket = f"CAST(CAST('0x' || substr(md5(word), 1, 4) AS INTEGER) % {dim} AS INTEGER)"
    return f"""{name}_w AS (SELECT {key}, unnest({d_tokens(f"coalesce({text}, '')")}) AS word FROM {source}),
{name}_c AS (SELECT {key}, {bucket} AS pos, count(*) AS c FROM {name}_w GROUP BY ALL),
{name}_g AS (SELECT {key}, CAST(unnest(range({dim})) AS INTEGER) AS pos FROM {source}),
{name}_v AS (SELECT g.{key}, g.pos, CAST(coalesce(c.c, 0) AS DOUBLE) AS raw
             FROM {name}_g g LEFT JOIN {name}_c c ON c.{key} = g.{key} AND c.pos = g.pos),
{name} AS (SELECT {key}, pos, raw, CASE WHEN sum(raw * raw) OVER w > 0
             THEN raw / sqrt(sum(raw * raw) OVER w) ELSE 0.0 END AS value
           FROM {name}_v WINDOW w AS (PARTITION BY {key}))"""


ORACLE["embed_batch_model"] = sq(
    f"WITH {embed_ctes('e', 'support_text', 'row_id', 'query_text')}\n"
    "SELECT row_id, pos, round(value, 4) AS value FROM e")
ORACLE["embed_batch_raw"] = sq(
    f"WITH {embed_ctes('e', 'support_text', 'row_id', 'query_text')}\n"
    "SELECT row_id, pos, raw AS value FROM e")

ORACLE["reply_similarity"] = with_views(f"""
WITH {embed_ctes('a', 'support_responses', 'row_id', 'query')},
{embed_ctes('b', 'support_responses', 'row_id', 'response')}
SELECT row_id, round(sum(a.value * b.value), 4) AS similarity FROM a JOIN b USING (row_id, pos) GROUP BY row_id""",
                                        "support_responses")

ORACLE["similar_exact"] = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS id, round(list_cosine_similarity(a.v, b.v), 9) AS s
      FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, id, round(s, 4) AS similarity FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY s DESC, id) QUALIFY row_number() OVER w <= 10
"""
ORACLE["similar_recall"] = ("SELECT sum(least(10, (SELECT count(*) FROM embeddings) - 1))::BIGINT AS neighbours, "
                            "true AS recall_reached FROM embeddings WHERE vec_id % 50 = 0")

ORACLE["kmeans_topics_facts"] = ("SELECT count(*) AS n, true AS labels_in_range, true AS same_again, "
                                 "true AS settled FROM embeddings")
ORACLE["sentiment_model_facts"] = ("SELECT count(*) AS n, true AS in_range, true AS auc_above_floor FROM documents")
ORACLE["support_topics_facts"] = with_views("SELECT count(*) AS n, true AS labels_in_range, true AS same_again, "
                                            "true AS settled FROM support_queries", "support_queries")

ORACLE["embed_tfidf"] = f"""
WITH toks AS (SELECT doc_id, unnest({d_remove_stop(d_basic_tokens('text'))}) AS token FROM documents),
tf AS (SELECT doc_id, token AS term, count(*) AS tf FROM toks GROUP BY ALL),
dfc AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
n AS (SELECT count(*) AS n FROM documents),
w AS (SELECT doc_id, term, tf * ln((n + 1) / (df + 1)) AS w FROM tf JOIN dfc USING (term) CROSS JOIN n),
r AS (SELECT doc_id, term, w, sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS nrm FROM w)
SELECT doc_id, term, round(CASE WHEN nrm > 0 THEN w / nrm ELSE 0.0 END, 4) + 0.0 AS weight FROM r
"""


# --- S4-S7, E7, P1-P3, A5, streaming -----------------------------------------

def d_entities_json(source: str, key: str, text: str) -> str:
    """(key, entities) with entities the JSON text of the ordered entity list."""
    return (f"SELECT {key}, CAST(to_json(list({{'type': type, 'value': value}} ORDER BY pos)) AS VARCHAR) "
            f"AS entities FROM ({d_entities(source, key, text)}) GROUP BY {key}")


def d_stub_sentiment(text: str) -> str:
    return f"CASE WHEN length({d_truncate(text)}) % 2 = 0 THEN 'POSITIVE' ELSE 'NEGATIVE' END"


ORACLE["sample_first_n"] = with_views(
    "SELECT row_id, concat_ws(' ', short_text, long_text) AS query_text FROM support_queries "
    "ORDER BY row_id LIMIT 5", "support_queries")

ORACLE["example_pairs"] = with_views(f"""
WITH p AS ({d_parsed_from(f"SELECT row_id, {d_stub_judge(d_judge_content('query', 'response'))} AS raw FROM support_responses")})
SELECT r.row_id, r.query, r.response, p.relevance, p.helpfulness, p.tone, p.explanation
FROM support_responses r JOIN p ON p.row_id = r.row_id ORDER BY r.row_id LIMIT 3""", "support_responses")

ORACLE["sentiment_sample"] = with_views(
    f"SELECT row_id, {d_stub_sentiment('response')} AS sentiment FROM support_responses ORDER BY row_id LIMIT 5",
    "support_responses")

ORACLE["pair_query_response"] = with_views(
    "SELECT q.row_id, concat_ws(' ', q.short_text, q.long_text) AS query_text, r.response FROM support_queries q JOIN support_responses r "
    "ON r.row_id = q.row_id", "support_queries", "support_responses")

ORACLE["entities_on_clean"] = sq(
    f"WITH c AS ({clean_sql('support_text', 'row_id', 'query_text')})\n"
    + d_entities("c", "row_id", "clean").strip()[len("WITH"):].join(["SELECT * FROM (WITH", ")"]))

ORACLE["export_csv_roundtrip"] = sq(f"""
WITH c AS ({clean_sql('support_text', 'row_id', 'query_text', extra_cols=', s.query_text')}),
e AS ({d_entities_json('support_text', 'row_id', 'query_text')})
SELECT c.row_id, c.query_text, c.clean, c.length, coalesce(e.entities, '[]') AS entities
FROM c LEFT JOIN e ON e.row_id = c.row_id""")

ORACLE["export_json_roundtrip"] = ORACLE["topic_samples"]

_GEN = f"""g AS (SELECT row_id, query_text AS query, {d_stub_reply(REPLY_CONTENT)} AS response FROM support_text),
p AS ({d_parsed_from(f"SELECT row_id, {d_stub_judge(d_judge_content('query', 'response'))} AS raw FROM g")}),
cq AS ({clean_sql('(SELECT row_id, query FROM g)', 'row_id', 'query')}),
cr AS ({clean_sql('(SELECT row_id, response FROM g)', 'row_id', 'response')}),
e AS ({d_entities_json('g', 'row_id', 'query')})"""

ORACLE["support_artifacts"] = sq(f"""
WITH {_GEN}
SELECT g.row_id, g.query, g.response, p.relevance, p.helpfulness, p.tone, p.explanation,
       cq.clean AS clean_query, cr.clean AS clean_response, coalesce(e.entities, '[]') AS query_entities,
       {d_stub_sentiment('cr.clean')} AS response_sentiment
FROM g JOIN p ON p.row_id = g.row_id JOIN cq ON cq.row_id = g.row_id JOIN cr ON cr.row_id = g.row_id
LEFT JOIN e ON e.row_id = g.row_id""")

ORACLE["support_embeddings"] = sq(f"""
WITH {_GEN},
{embed_ctes('a', 'cq', 'row_id', 'clean')},
{embed_ctes('b', 'cr', 'row_id', 'clean')}
SELECT a.row_id, a.pos, round(a.value, 4) AS query_value, round(b.value, 4) AS response_value
FROM a JOIN b ON b.row_id = a.row_id AND b.pos = a.pos""")

_PAIR_PARSED = d_parsed_from(
    f"SELECT row_id, {d_stub_judge(d_judge_content('query', 'response'))} AS raw FROM support_responses")
_QUALITY = " || '; ' || ".join(
    f"'{c}=' || CAST({c} AS VARCHAR)" for c in (
        "avg_helpfulness", "avg_relevance", "avg_tone", "dist_helpfulness", "dist_relevance", "dist_tone", "n"))
ORACLE["overall_report"] = with_views(f"""
WITH scores AS ({_JUDGED}),
{CENTROIDS_SQL},
quality AS ({QUALITY_SQL}),
pairs AS (SELECT r.row_id, r.query, r.response, p.* EXCLUDE (row_id) FROM support_responses r
          JOIN scores p ON p.row_id = r.row_id ORDER BY r.row_id LIMIT 3),
sample AS (SELECT * FROM ({_SENTIMENTS}) ORDER BY row_id LIMIT 5)
SELECT 'quality' AS part, CAST(0 AS BIGINT) AS row_id, {_QUALITY} AS content FROM quality
UNION ALL SELECT 'unique_clusters', 0, 'unique_clusters=' || CAST(count(DISTINCT topic) AS VARCHAR) FROM assigned
UNION ALL SELECT 'sentiment_sample', row_id, 'sentiment=' || sentiment FROM sample
UNION ALL SELECT 'example_pairs', row_id, 'explanation=' || explanation || '; helpfulness=' || CAST(helpfulness AS VARCHAR)
  || '; query=' || query || '; relevance=' || CAST(relevance AS VARCHAR) || '; response=' || response
  || '; tone=' || CAST(tone AS VARCHAR) FROM pairs""", "support_responses")

ORACLE["flagship"] = with_views(f"""
WITH qs AS (SELECT row_id, concat_ws(' ', short_text, long_text) AS query_text, category, sub_category
            FROM support_queries),
c AS ({clean_sql('qs', 'row_id', 'query_text')}),
e AS ({d_entities_json('qs', 'row_id', 'query_text')})
SELECT qs.row_id, c.clean, c.length, coalesce(e.entities, '[]') AS entities,
       {d_normalize_category('qs.category', 'qs.sub_category')} AS normalized_category,
       {d_stub_sentiment('r.response')} AS reply_sentiment_raw, r.row_id IS NOT NULL AS has_reply
FROM qs JOIN c ON c.row_id = qs.row_id LEFT JOIN e ON e.row_id = qs.row_id
LEFT JOIN support_responses r ON r.row_id = qs.row_id""", "support_queries", "support_responses")
ORACLE["flagship"] = (
    "SELECT row_id, clean, length, entities, normalized_category, "
    "CASE WHEN has_reply THEN reply_sentiment_raw END AS reply_sentiment FROM (" + ORACLE["flagship"] + ")")

_USER_TURNS = "(SELECT conv_id * 4294967296 + turn AS row_id, text FROM conversations WHERE role = 'user')"
ORACLE["stream_clean"] = f"""
WITH c AS ({clean_sql(_USER_TURNS, 'row_id', 'text')}),
e AS ({d_entities_json('c', 'row_id', 'clean')})
SELECT c.row_id, c.clean, c.length, coalesce(e.entities, '[]') AS entities
FROM c LEFT JOIN e ON e.row_id = c.row_id"""


# T10 / A4 on the full clean text (defined after the cleaning SQL above).
ORACLE["query_length"] = sq(
    f"SELECT row_id, length FROM ({clean_sql('support_text', 'row_id', 'query_text')})")

ORACLE["length_histogram"] = sq(HISTOGRAM_TEMPLATE.format(
    values=f"SELECT CAST(length AS DOUBLE) AS v FROM ({clean_sql('support_text', 'row_id', 'query_text')})"))
