"""Registered corpus queries: each applies one operator with production
parameters to its whole table and returns its contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daycast.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str):
    def add(fn):
        QUERIES[name] = fn
        return fn
    return add


@register("op4_source_mixing")
def op4(spark, sf_dir):
    from daycast.llm.mixing import mix
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


ORACLES["op4_source_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS DOUBLE) AS w
  FROM d GROUP BY source),
f AS (
  SELECT *, CAST(1.5 AS DOUBLE) * sum(source_size) OVER () AS budget,
         coalesce(sum(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w,
         CAST(2 * source_size AS DOUBLE) / w AS r
  FROM s WINDOW o AS (ORDER BY CAST(2 * source_size AS DOUBLE) / w, source NULLS LAST)),
l AS (SELECT *, (budget - CAST(capped AS DOUBLE)) / open_w AS lev FROM f),
t AS (
  SELECT source, source_size, budget,
         least(CAST(2 * source_size AS DOUBLE),
               coalesce((SELECT arg_min(lev, (r, capped)) FROM l WHERE lev * w <= 2 * source_size) * w, 2 * source_size)) AS target
  FROM l),
q AS (
  SELECT d.doc_id, d.source, d.h, d.size, t.source_size, t.target, t.budget,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id ROWS UNBOUNDED PRECEDING) AS cum
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
o AS (
  SELECT *, CASE WHEN target > 0 THEN CAST(cum + p * source_size AS DOUBLE) / target ELSE 0 END AS fin
  FROM q, (SELECT unnest([0, 1]) AS p)),
g AS (SELECT *, sum(size) OVER (ORDER BY fin, coalesce(source, ''), h ROWS UNBOUNDED PRECEDING) AS run FROM o),
b AS (SELECT sum(target) + 1e-6 AS budget FROM t)
SELECT doc_id, size, source_size, target,
       CAST(sum(CASE WHEN run <= (SELECT budget FROM b) THEN size ELSE 0 END) AS BIGINT) AS taken
FROM g GROUP BY doc_id, size, source_size, target
"""


@register("op3_license_scan")
def op3(spark, sf_dir):
    from daycast.llm.licenses import license_scan
    return license_scan(table(spark, sf_dir, "documents"))


def _license_oracle() -> str:
    """Brute force over all blocks and templates; the template list is the
    operator's, the search is not."""
    from daycast.llm.licenses import BLOCK, STEP, templates
    values = ", ".join(f"({t['tid']}, '{t['label']}', {t['words']}, {t['tokens']}, {str(t['ordered']).lower()}, {t['need']})" for t in templates())
    return rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
t(tid, label, phrase, tokens, ordered, need) AS (VALUES {values}),
b AS (
  SELECT doc_id, k, ws[k * {STEP} + 1 : k * {STEP} + {BLOCK}] AS bw
  FROM (SELECT doc_id, ws, unnest(range(0, greatest(0, CAST(ceil((len(ws) - {BLOCK}) / {STEP}.0) AS BIGINT)) + 1)) AS k FROM w)),
n AS (
  SELECT b.doc_id, t.label, t.tid, len(list_intersect(b.bw, t.tokens)) / len(t.tokens) AS c
  FROM b, t WHERE NOT ordered AND len(list_intersect(b.bw, t.tokens)) >= t.need),
p AS (
  SELECT doc_id, label, i FROM (
    SELECT w.doc_id, w.ws, t.phrase, t.label, unnest(range(0, len(ws))) AS i FROM w, t
    WHERE ordered AND list_has_all(w.ws, t.phrase))
  WHERE ws[i + 1 : i + len(phrase)] = phrase),
a AS (
  SELECT doc_id, label, 1.0 AS c FROM p UNION ALL SELECT doc_id, label, c FROM n),
ap AS (SELECT doc_id, count(*) AS n_base, min(i) AS f, max(i) AS l, list_sort(list_distinct(list(label))) AS ls FROM p GROUP BY doc_id),
aa AS (SELECT doc_id, list_sort(list_distinct(list(label))) AS ls, max(c) AS score FROM a GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(ap.n_base, 0) AS BIGINT) AS n_base,
       CAST(ap.f AS BIGINT) AS first_word, CAST(ap.l AS BIGINT) AS last_word,
       coalesce(array_to_string(ap.ls, ','), '') AS base_labels, coalesce(array_to_string(aa.ls, ','), '') AS labels,
       CAST(coalesce(aa.score, 0) AS DOUBLE) AS score
FROM w LEFT JOIN ap USING (doc_id) LEFT JOIN aa USING (doc_id)
"""


ORACLES["op3_license_scan"] = _license_oracle()


@register("op5_pii_pseudonyms")
def op5(spark, sf_dir):
    from daycast.llm.pii import pseudonymise
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "pii_count", "pii_kinds", "text")


@register("op6_prefix_fingerprints")
def op6(spark, sf_dir):
    from daycast.llm.fingerprints import fingerprints
    return fingerprints(table(spark, sf_dir, "documents"))


def tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@register("op7_harmonic_packing")
def op7(spark, sf_dir):
    from daycast.llm.packing import pack
    return pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), end_id=1)


@register("op8_ngram_jaccard")
def op8(spark, sf_dir):
    from daycast.llm.jaccard import jaccard_components
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


ORACLES["op8_ngram_jaccard"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
i AS (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 4) + 1)) AS k FROM w WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[k : k + 4], ' ') AS sh FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
r(doc_id, m) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.y, r.m FROM r JOIN l ON l.x = r.doc_id WHERE r.m < l.y)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.m) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN r ON r.doc_id = d.doc_id GROUP BY d.doc_id
"""


@register("op9_token_files")
def op9(spark, sf_dir):
    from daycast.llm.token_codec import token_files
    return token_files(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=2)


@register("op10_maxent_scores")
def op10(spark, sf_dir):
    from daycast.llm.maxent_lm import lm_scores
    return lm_scores(table(spark, sf_dir, "documents"))


@register("op2_language_id")
def op2(spark, sf_dir):
    from daycast.llm.langid import language_report
    return language_report(table(spark, sf_dir, "documents"))


@register("op1_embedding_neardup")
def op1(spark, sf_dir):
    from daycast.llm.neardup_hnsw import near_duplicates
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLES["op1_embedding_neardup"] = """
WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[64]) AS x FROM embeddings),
l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM e a, e b
      WHERE a.vec_id <> b.vec_id AND array_cosine_similarity(a.x, b.x) >= 0.95),
n AS (SELECT u, count(*) AS n FROM l GROUP BY u),
r(vec_id, m) AS (SELECT vec_id, vec_id FROM e UNION SELECT l.v, r.m FROM r JOIN l ON l.u = r.vec_id WHERE r.m < l.v)
SELECT e.vec_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_links, min(r.m) AS component_id,
       e.vec_id = min(r.m) AS kept
FROM e JOIN r ON r.vec_id = e.vec_id LEFT JOIN n ON n.u = e.vec_id GROUP BY e.vec_id
"""


@register("op13_sentencepiece")
def op13(spark, sf_dir):
    from daycast.llm.pieces import piece_digests
    return piece_digests(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


@register("op11_conversation_repair")
def op11(spark, sf_dir):
    from daycast.llm.conversations import repair_report
    return repair_report(table(spark, sf_dir, "conversations"))


# A forward programme over whole prefixes: the best (cost, edits, lines) of each state.
ORACLES["op11_conversation_repair"] = r"""
WITH RECURSIVE t AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab
  FROM range(256) AS r(i)),
k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '') AS key
  FROM conversations),
f AS (
  SELECT k.* EXCLUDE (key), xor(list_reduce(list_prepend(4294967295, list_transform(key, lambda x: CAST(ascii(x) AS BIGINT))),
         lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS f
  FROM k, t),
d AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE f WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM f),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM d),
r AS (
  SELECT conv_id, turn, role, text, i, role[1:1] AS ini, NOT regexp_matches(text, '[^ 	-
]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) NOT IN ('.', '!', '?') AS cut,
         lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM p),
n AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
         count(*) FILTER (NOT blank AND NOT again AND cut) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id),
ins(s, z, e, lines) AS (VALUES (0, 0, '', ''), (1, 1, '', ''), (2, 2, '', ''), (3, 3, '', ''),
  (0, 2, 'I', 'user:'), (1, 2, 'I', 'user:'), (3, 2, 'I', 'user:'), (2, 3, 'I', 'assistant:'),
  (0, 3, 'II', 'user:' || chr(10) || 'assistant:'), (1, 3, 'II', 'user:' || chr(10) || 'assistant:')),
act(z, ini, e, y) AS (VALUES (0, 's', 'K', 1), (0, 'u', 'K', 2), (1, 'u', 'K', 2), (3, 'u', 'K', 2), (2, 'a', 'K', 3),
  (0, NULL, 'R', 2), (1, NULL, 'R', 2), (3, NULL, 'R', 2), (2, NULL, 'R', 3), (0, NULL, 'D', 0), (1, NULL, 'D', 1), (2, NULL, 'D', 2), (3, NULL, 'D', 3)),
b(conv_id, i, s, best) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, {'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': ''} FROM conversations
  UNION ALL
  SELECT b.conv_id, r.i, act.y, min({
    'cost': best.cost + 3 * length(ins.e) + CASE act.e WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END + CASE WHEN act.e <> 'D' AND cut THEN 3 ELSE 0 END,
    'audit': best.audit || ins.e || act.e,
    'lines': best.lines || CASE WHEN ins.e = '' THEN '' ELSE chr(10) || ins.lines END
      || CASE act.e WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || role || ':' || text ELSE chr(10) || CASE act.y WHEN 2 THEN 'user:' ELSE 'assistant:' END || text END})
  FROM b JOIN r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1
  JOIN ins ON ins.s = b.s JOIN act ON act.z = ins.z AND (act.ini IS NULL OR act.ini = r.ini) AND (act.e = 'D' OR NOT (blank OR again))
  GROUP BY b.conv_id, r.i, act.y),
w AS (
  SELECT b.conv_id, min({'cost': best.cost + 3 * length(ins.e), 'audit': best.audit || ins.e,
         'lines': best.lines || CASE WHEN ins.e = '' THEN '' ELSE chr(10) || ins.lines END}) AS best
  FROM b LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM b.conv_id JOIN ins ON ins.s = b.s
  WHERE b.i = coalesce(n.n, 0) AND (ins.z = 3 OR b.s = 0 AND ins.z = 0) GROUP BY b.conv_id)
SELECT w.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(best.cost AS BIGINT) AS cost, best.audit AS audit,
       sha256(best.lines[2:]) AS repaired_sha256
FROM w LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM w.conv_id
"""


@register("op12_phrase_collocations")
def op12(spark, sf_dir):
    from daycast.llm.collocations import collocations
    return collocations(table(spark, sf_dir, "documents"))


ORACLES["op12_phrase_collocations"] = r"""
WITH w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
g AS (
  SELECT lang, m, array_to_string(ws[i : i + m - 1], ' ') AS phrase FROM (
    SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS m))),
f AS (SELECT lang, m, phrase, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY lang, m, phrase),
n AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND f >= 10),
u AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, array_to_string(ws[1:2], ' ') AS phrase, a FROM c WHERE m = 3
    UNION ALL SELECT lang, array_to_string(ws[2:3], ' ') AS phrase, a FROM c WHERE m = 3) GROUP BY lang, phrase),
k AS (
  SELECT lang, phrase, a, k, array_to_string(ws[1:k], ' ') AS x, array_to_string(ws[k + 1:], ' ') AS y FROM (
    SELECT c.*, unnest(range(1, m)) AS k FROM c LEFT JOIN u USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * a)),
s AS (
  SELECT k.lang, k.phrase, k.a, k.k, l.f AS l, r.f AS r, (1000000 * k.a * k.a) // (l.f * r.f) AS score
  FROM k JOIN f l ON l.lang = k.lang AND l.phrase = k.x JOIN f r ON r.lang = k.lang AND r.phrase = k.y),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM o JOIN n USING (lang) WHERE rank <= 2000
"""
