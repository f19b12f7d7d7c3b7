"""Registered queries of the operators in this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark, sf_dir):
    import public_tokenizers

    from . import token_counts

    counts = token_counts.count_tokens(read(spark, sf_dir, "documents"),
                                       public_tokenizers.path("word_bpe_49k.json"), budget=2048)
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


@query
def op6_near_duplicates(spark, sf_dir):
    from . import near_dedup

    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"), width=4, percent=80)


def _digest(col):
    return F.sha2(F.concat_ws(",", col), 256)


@query
def op3_decontamination(spark, sf_dir):
    from . import decontamination

    out = decontamination.contaminated_words(read(spark, sf_dir, "documents"),
                                             read(spark, sf_dir, "benchmark"), width=10)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      _digest("items").alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query
def op5_license_scan(spark, sf_dir):
    from . import licenses

    out = licenses.licenses(read(spark, sf_dir, "documents"))
    return (out.withColumn("base_labels", F.concat_ws(",", "base_labels"))
               .withColumn("labels", F.concat_ws(",", "labels")))


@query
def op8_quality_rules(spark, sf_dir):
    from . import quality_rules

    out = quality_rules.score_texts(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", F.round("p_good", 6).alias("p_good"))


@query
def op2_personal_data(spark, sf_dir):
    from . import personal_data as pd
    from . import spans as sp

    out = pd.scan(read(spark, sf_dir, "documents"))
    all_of = F.col("spans")
    return out.select("doc_id", *[sp.count_of(all_of, k).alias(f"n_{k}") for k in pd.BASE_KINDS],
                      F.sha2(sp.listed(sp.of_kinds(all_of, pd.BASE_KINDS)), 256).alias("base_sha256"),
                      sp.listed(all_of).alias("spans"))


@query
def op9_secret_scan(spark, sf_dir):
    from . import secret_scan
    from . import spans as sp

    out = secret_scan.scan(read(spark, sf_dir, "documents"))
    all_of = F.col("spans")
    base = sp.of_kinds(all_of, secret_scan.BASE_KINDS)
    return out.select("doc_id", *[sp.count_of(all_of, k).alias(f"n_{k}") for k in secret_scan.BASE_KINDS],
                      F.sha2(sp.listed(base), 256).alias("base_sha256"), sp.listed(all_of).alias("spans"))


@query
def op4_quality_model(spark, sf_dir):
    from . import quality_model as qm

    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    ratings = labels.select("doc_id", qm.grade_of(F.col("quality"), F.col("toxic")).alias("grade"))
    out = qm.score_texts(docs, qm.fit(docs, ratings))
    tail = F.element_at("p_at_least", -1)
    return out.select("doc_id", F.round("expected_grade", 6).alias("expected_grade"),
                      F.round(tail, 6).alias("p_top_grade"), "kept")


@query
def op7_warc_roundtrip(spark, sf_dir):
    from . import warc
    from .common import Scratch

    pages = read(spark, sf_dir, "pages")
    path = Scratch(spark, "warc-archives").path("archives")
    warc.write_archives(pages, path)
    return warc.records(warc.chunk_table(spark, path, data=False), pages.schema["page_id"].dataType.simpleString())


@query
def op10_source_mix(spark, sf_dir):
    from . import mixing

    return mixing.mix(read(spark, sf_dir, "documents"))


_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

ORACLE["op3_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS g,
               least(10, len(w)) AS k
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM win),
grams AS (SELECT doc_id, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g
          FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
hit AS (SELECT doc_id, i, k, item_id FROM grams JOIN win USING (g, k)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit)
        GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(pos.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(it.n, 0) AS BIGINT) AS n_items, sha256(coalesce(it.ids, '')) AS items_sha256,
       coalesce(pos.n, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""


def _license_sql() -> str:
    from .licenses import NOTICES, PERCENT, PHRASES, STRIDE, TEMPLATES, pattern_words

    phrases = ", ".join(f"('{' '.join(pattern_words(p))}', '{label}', {len(pattern_words(p))})"
                        for p, label in PHRASES.items())
    words = [(label, list(dict.fromkeys(pattern_words(t)))) for label, t in TEMPLATES.items()]
    templates = ", ".join(f"({i}, '{label}', '{w}', {len(ws)}, {-(-len(ws) * PERCENT // 100)})"
                          for i, (label, ws) in enumerate(words) for w in ws)
    notices = ", ".join(f"('{label}', {pattern_words(t)}, {len(pattern_words(t))})" for label, t in NOTICES.items())
    return f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
nt(label, ws, k) AS (VALUES {notices}),
p(phrase, label, k) AS (VALUES {phrases}),
t(tid, label, word, m, need) AS (VALUES {templates}),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d),
base AS (SELECT doc_id, label, i - 1 AS start, 1.0 AS score FROM
         (SELECT doc_id, w, phrase, label, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, p
          WHERE contains(' ' || array_to_string(w, ' ') || ' ', ' ' || phrase || ' '))
         WHERE array_to_string(list_slice(w, i, i + k - 1), ' ') = phrase),
blocks AS (SELECT doc_id, pos // {STRIDE} AS block, word FROM x
           UNION ALL SELECT doc_id, pos // {STRIDE} - 1, word FROM x WHERE pos >= {STRIDE}),
method AS (SELECT doc_id, t.label, NULL AS start, count(DISTINCT word) / CAST(any_value(m) AS DOUBLE) AS score
           FROM blocks JOIN t USING (word) GROUP BY doc_id, block, tid, t.label
           HAVING count(DISTINCT word) >= any_value(need)),
notice AS (SELECT DISTINCT doc_id, label, NULL AS start, 1.0 AS score FROM
           (SELECT doc_id, w, label, ws, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, nt WHERE list_has_all(w, ws))
           WHERE list_has_all(list_slice(w, i, i + k - 1), ws)),
a AS (SELECT doc_id, label, start, score FROM base UNION ALL SELECT doc_id, label, start, score FROM method
      UNION ALL SELECT doc_id, label, start, score FROM notice),
r AS (SELECT doc_id, count(start) AS n_base, min(start) AS first_word, max(start) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (start IS NOT NULL) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
      FROM a GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN r USING (doc_id)
"""


ORACLE["op5_license_scan"] = _license_sql()

ORACLE["op7_warc_roundtrip"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
q AS (SELECT page_id, n, sha1(h) AS digest,
             CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY h) ELSE page_id END AS target FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN target = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN target <> page_id THEN target END AS refers_to FROM q
"""

ORACLE["op6_near_duplicates"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS g FROM
      (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id),
l AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
      WHERE 100 * k >= 80 * (a.n + b.n - k)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y)
SELECT r.x AS doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.y) AS component_id,
       min(r.y) = r.x AS kept
FROM r LEFT JOIN n ON n.doc_id = r.x GROUP BY r.x
"""


@query
def op11_line_dedup(spark, sf_dir):
    from . import line_dedup
    from .common import Scratch

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scratch = Scratch(spark, "op11")
    bitmaps = scratch.write(line_dedup.keep_bitmaps(docs, scratch=scratch), "bitmaps")
    scratch.drop("gone")
    out = line_dedup.kept_texts(docs, bitmaps)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE["op11_line_dedup"] = r"""
WITH l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM
           (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (SELECT doc_id, line, pos, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT *, length(key) < 10 OR doc_id = min(doc_id) OVER (PARTITION BY key) AS stays FROM k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""


@query
def op12_filter_audit(spark, sf_dir):
    from . import filter_audit

    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


ORACLE["op12_filter_audit"] = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic
      FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
              100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t), regexp_matches(t, '[#$%&*|]'),
              coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails
      FROM d LEFT JOIN l USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM f GROUP BY part, fails),
x(a) AS (VALUES (1), (2), (3), (4), (5)),
o AS (SELECT [p.a, q.a, r.a, s.a, u.a] AS seq FROM x p, x q, x r, x s, x u
      WHERE len(list_distinct([p.a, q.a, r.a, s.a, u.a])) = 5),
steps AS (SELECT seq, a AS step FROM o, x),
j AS (SELECT c.*, seq, step, fails[seq[step]] AS own,
             list_bool_or(list_transform(list_slice(seq, 1, step - 1), lambda i: fails[i])) IS TRUE AS gone,
             len(list_filter(fails, lambda v: v)) = 1 AS alone
      FROM c, steps),
r AS (SELECT part, array_to_string(list_transform(seq, lambda i: 'ABCDE'[i]), '') AS filter_order, step,
             CAST(coalesce(sum(n) FILTER (NOT gone AND NOT own), 0) AS BIGINT) AS kept,
             CAST(coalesce(sum(n) FILTER (NOT gone AND own), 0) AS BIGINT) AS removed,
             CAST(coalesce(sum(n) FILTER (gone AND own), 0) AS BIGINT) AS redundant,
             CAST(coalesce(sum(n) FILTER (own AND alone), 0) AS BIGINT) AS unique_fails,
             CAST(coalesce(sum(good) FILTER (NOT gone AND own), 0) AS BIGINT) AS good_lost,
             CAST(coalesce(sum(toxic) FILTER (NOT gone AND own), 0) AS BIGINT) AS toxic_lost
      FROM j GROUP BY part, seq, step)
SELECT *, CAST(sum(removed) OVER (PARTITION BY part, filter_order[step]) AS BIGINT) AS shapley FROM r
"""


@query
def op13_lexical_search(spark, sf_dir):
    from . import lexical_search

    return lexical_search.rank_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=10)


ORACLE["op13_lexical_search"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
lens AS (SELECT doc_id, len(w) AS n FROM d WHERE len(w) > 0),
c AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM lens),
b AS (SELECT item_id, unnest(list_distinct({_WORDS})) AS term FROM benchmark),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d)
       WHERE term IN (SELECT term FROM b) GROUP BY doc_id, term),
wt AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
       FROM tf, c GROUP BY term),
s AS (SELECT item_id, doc_id,
             CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // l)))) AS BIGINT) AS score
      FROM b JOIN tf USING (term) JOIN wt USING (term) JOIN lens USING (doc_id), c GROUP BY item_id, doc_id),
r AS (SELECT item_id, doc_id, score,
             CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
      FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
