"""The operators applied to the given tables, one query each, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.llm import audit, jaccard, langid, licenses, mixing, packing, preference, rules, spotsigs, tiles, tokens, toxicity, whitening
from loomstat.llm.tables import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents interleaved by source, at weights between their own shares and equal ones."""
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return mixing.mix(docs).select("row.doc_id", "row.source", "slot", "place", "position")


SQL["op1_mixing"] = r"""
WITH RECURSIVE c AS (
  SELECT source AS s, count(*) AS c, (count(*) + 15) // 16 AS b FROM documents GROUP BY source
), p AS (
  SELECT *, row_number() OVER (ORDER BY s IS NULL, s) AS i,
         greatest(1, round(sqrt(c) / sum(sqrt(c)) OVER ()
           * greatest(1000, ceil(10 * sum(sqrt(c)) OVER () / min(sqrt(c)) OVER ()))))::BIGINT AS p
  FROM c
), k AS MATERIALIZED (
  SELECT list(p ORDER BY i) AS ps, list(b ORDER BY i) AS bs, sum(b)::BIGINT AS n FROM p
), w(t, start, done, gone, i, block) AS (
  -- done: blocks taken in this phase, gone: in all; a phase ends when a source runs out
  SELECT -1::BIGINT, 0::BIGINT, list_transform(ps, lambda x: 0::BIGINT),
         list_transform(ps, lambda x: 0::BIGINT), 0::BIGINT, 0::BIGINT FROM k
  UNION ALL
  SELECT t, CASE WHEN out THEN t + 1 ELSE start END,
         [CASE WHEN out THEN 0::BIGINT WHEN j = i THEN done[j] + 1 ELSE done[j] END for j in range(1, len(ps) + 1)],
         [CASE WHEN j = i THEN gone[j] + 1 ELSE gone[j] END for j in range(1, len(ps) + 1)], i, gone[i]
  FROM (SELECT *, gone[i] + 1 = bs[i] AS out FROM (
    SELECT t + 1 AS t, start, done, gone, ps, bs, list_min([
             {'d': ((done[j] + 1) * total + ps[j] - 1) // ps[j], 'j': j} for j in range(1, len(ps) + 1)
             if gone[j] < bs[j] AND done[j] * total // ps[j] <= t + 1 - start]).j AS i
    FROM (SELECT w.*, ps, bs, list_sum([ps[j] for j in range(1, len(ps) + 1) if gone[j] < bs[j]])::BIGINT AS total
          FROM w, k WHERE t + 1 < n)))
), d AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source
           ORDER BY ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT, doc_id) - 1 AS r
  FROM documents
)
SELECT doc_id, source, t AS slot, (r % 16)::INT AS place, t * 16 + r % 16 AS position
FROM d JOIN p ON p.s IS NOT DISTINCT FROM d.source JOIN w ON w.t >= 0 AND w.i = p.i AND w.block = d.r // 16
"""


@query
def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every text, learned from three of four documents."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    learned = F.coalesce(fold("doc_id", 4) != 2, F.lit(False))
    texts = langid.training_texts(docs, learned, "text", "lang", "doc_id", per_language=500, max_chars=20_000)
    found = langid.identify(docs, langid.fit(texts))
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


TOXIC_SAMPLE = {0: 3_000, 1: 1_500}
TOXIC_CHARS = 20_000_000


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.ToxicityModel:
    """Learned from a bounded sample of the labelled documents outside the held-out fold."""
    rows = toxicity.training_rows(docs, labels, lambda key: fold(key, 5) != 0, TOXIC_SAMPLE, TOXIC_CHARS)
    return toxicity.fit_rows(rows)


@query
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every text, learned from labels outside the held-out fifth."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(docs, table(spark, folder, "labels")))
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


@query
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every text's measurements, failure bits and the strict policy's verdict."""
    docs = table(spark, folder, "documents")
    rows = rules.ledger(docs, doc_id=F.col("doc_id"))
    failed = rules.rejects(rules.BASE)
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~rules.rejects(rules.STRICT)).alias("kept"),
        "failures",
    )


SQL["op4_quality"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM d
), m AS (
  SELECT r, doc_id, w, len(w) AS n_words, array_to_string(w, '') AS j,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines
  FROM w
), g AS (
  SELECT r, i, concat_ws(' ', w[i], w[i+1], w[i+2], w[i+3], w[i+4]) AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w)
), twice AS (
  SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS next_i
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1
), rep AS (
  SELECT r, sum(least(5, coalesce(next_i - i, 5))) AS n_repeat_words FROM twice GROUP BY r
), f AS (
  SELECT doc_id, n_words, length(j) AS word_chars,
         length(j) - length(regexp_replace(j, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, n_lines,
         length(regexp_replace(j, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(j, '[^a-z]', '', 'g')) AS n_lower
  FROM m LEFT JOIN rep USING (r)
), b AS (
  SELECT *, (n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT
         + 4 * (100 * n_dup_lines > 60 * n_lines)::BIGINT + 8 * (100 * n_symbols > 40 * n_words)::BIGINT
         + 16 * (10 * word_chars < 20 * n_words)::BIGINT + 32 * (word_chars > 15 * n_words)::BIGINT
         + 64 * (n_upper > n_lower)::BIGINT AS failures
  FROM f
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failures & 3 <> 0 AS base_failed, failures = 0 AS kept, failures
FROM b
"""


@query
def op6_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """The best license notice of every document, and how many there are."""
    found = licenses.scan(table(spark, folder, "documents").select("doc_id", "text"))
    best = F.get("matches", F.lit(0))
    cells = [best[n].alias(n) for n in ("license", "coverage", "start", "end")]
    return found.select("doc_id", F.size("matches").cast("long").alias("n_matches"), *cells)


@query
def op7_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets overlap by nine tenths of their union."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return jaccard.jaccard_components(docs, size=3, percent=90)


SQL["op7_jaccard"] = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), g AS (
  SELECT DISTINCT r, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ')
                     ELSE concat_ws(' ', w[i], w[i+1], w[i+2]) END AS g
  FROM (SELECT r, w, unnest(range(1, greatest(2, len(w) - 1))) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT r, count(*) AS n FROM g GROUP BY r
), o AS (
  SELECT a.r AS x, b.r AS y, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.r < b.r GROUP BY ALL
), l AS (
  SELECT x, y FROM o JOIN n p ON p.r = x JOIN n q ON q.r = y WHERE 100 * c >= 90 * (p.n + q.n - c)
), e AS (
  SELECT x, y FROM l UNION ALL SELECT y, x FROM l
), reach AS (
  SELECT r AS x, r AS y FROM d UNION SELECT reach.x, e.y FROM reach JOIN e ON reach.y = e.x
), c AS (
  SELECT x, min(doc_id) AS component_id FROM reach JOIN d ON d.r = reach.y GROUP BY x
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id
FROM d JOIN c ON c.x = d.r LEFT JOIN n USING (r)
"""


TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PERSONAL = r"[A-Za-z0-9._+-]+@[A-Za-z0-9.-]+|[0-9]{1,3}(?:\.[0-9]{1,3}){3}"


@query
def op8_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of every document before and after mail and network addresses are masked."""
    vocabulary = tokens.Vocabulary.read(TOKENIZER)
    trees = tokens.token_trees(table(spark, folder, "documents").select("doc_id", "text"), vocabulary)
    edits = tokens.replacements("text", PERSONAL, "[address]")
    return tokens.edited_counts(trees, vocabulary, edits).drop("text_edited")


def token_length(spark: SparkSession, path: str = TOKENIZER) -> Column:
    """Number of tokens of the column ``text``, by the vocabulary at this path of the driver."""
    return tokens.token_count(spark, tokens.Vocabulary.read(path))(F.col("text"))


@query
def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, as tokens, packed into sequences of four permitted lengths."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack(docs, token_length(spark))


@query
def op10_spotsigs(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and how near they and the next one are."""
    return spotsigs.compared(table(spark, folder, "documents").select("doc_id", "text"))


@query
def spotsigs_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of documents whose sets of spot signatures overlap by four fifths of their union."""
    return spotsigs.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"), percent=80)


SQL["spotsigs_classes"] = r"""
WITH RECURSIVE stop AS (
  SELECT string_split('""" + " ".join(sorted(set(spotsigs.ANCHORS))) + r"""', ' ') AS s
), d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^ 	-
]+') AS w
  FROM documents
), w AS (
  SELECT r, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM d
), m AS (
  SELECT r, i, w, list_contains(s, w) AS anchor FROM w, stop
), c AS (
  SELECT r, w, row_number() OVER (PARTITION BY r ORDER BY i) AS k FROM m WHERE NOT anchor
), a AS (
  SELECT * FROM (
    SELECT r, w, anchor, count(*) FILTER (NOT anchor) OVER (PARTITION BY r ORDER BY i) AS before FROM m
  ) WHERE anchor
), chain AS (
  SELECT DISTINCT a.r, concat_ws(' ', a.w, x.w, y.w) AS g
  FROM a JOIN c x ON x.r = a.r AND x.k = before + 1 JOIN c y ON y.r = a.r AND y.k = before + 2
), g AS (
  SELECT r, g FROM chain
  UNION ALL
  SELECT r, array_to_string(w, ' ') FROM d WHERE len(w) > 0 AND r NOT IN (SELECT r FROM chain)
), n AS (
  SELECT r, count(*) AS n FROM g GROUP BY r
), same AS (
  -- texts with equal sets are compared once
  SELECT r, n, min(r) OVER (PARTITION BY s) AS f FROM (
    SELECT r, n, string_agg(g, chr(10) ORDER BY g) AS s FROM g JOIN n USING (r) GROUP BY ALL)
), u AS (
  SELECT g.r, g.g, n FROM g JOIN same ON same.r = g.r AND same.f = g.r
), o AS (
  SELECT x.r AS x, y.r AS y, any_value(x.n) AS xn, any_value(y.n) AS yn, count(*) AS c
  FROM u x JOIN u y ON x.g = y.g AND x.r < y.r AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
  GROUP BY x.r, y.r
), l AS (
  SELECT x, y FROM o WHERE 100 * c >= 80 * (xn + yn - c)
), e AS (
  SELECT x, y FROM l UNION ALL SELECT y, x FROM l
), reach AS (
  SELECT DISTINCT f AS x, f AS y FROM same UNION SELECT reach.x, e.y FROM reach JOIN e ON reach.y = e.x
), least AS (
  SELECT x, min(doc_id) AS component_id FROM reach JOIN same ON same.f = reach.y JOIN d ON d.r = same.r GROUP BY x
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_signatures, coalesce(component_id, doc_id) AS component_id
FROM d LEFT JOIN same USING (r) LEFT JOIN least ON least.x = f
"""


@query
def op5_preference(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation with an answer, against the same one with a foreign last answer."""
    turns = table(spark, folder, "conversations")
    chosen, rejected = preference.with_foreign_endings(turns)
    pairs = preference.preference_pairs(chosen, rejected, pair="conv_id")

    def listed(spans: str) -> Column:
        one = F.transform(spans, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(one, ",").alias(spans)

    texts = ["conv_id", "n_shared", "prompt", "chosen", "rejected"]
    return pairs.select(*texts, listed("chosen_spans"), listed("rejected_spans"))


SQL["op5_preference"] = r"""
WITH t AS (
  SELECT * FROM conversations WHERE conv_id IS NOT NULL
), e AS (
  SELECT conv_id, max(turn) AS end_turn, arg_max(text, turn) AS answer
  FROM t WHERE role = 'assistant' GROUP BY conv_id
), h AS (
  SELECT *, md5(conv_id::VARCHAR) AS h,
         ('0x' || substr(md5(conv_id::VARCHAR), 1, 13))::BIGINT
         % greatest(1, (SELECT count(*) // 1000 FROM e)) AS b
  FROM e
), o AS (
  SELECT *, coalesce(lead(answer) OVER w, first_value(answer) OVER w) AS other
  FROM h WINDOW w AS (PARTITION BY b ORDER BY h, conv_id)
), r AS (
  SELECT conv_id, turn, end_turn, answer = other AS same, '<|' || role || '|>' || chr(10) AS head,
         text, other
  FROM t JOIN o USING (conv_id) WHERE turn <= end_turn
), p AS (
  SELECT conv_id, same,
         count(*) FILTER (same OR turn < end_turn) AS n_shared,
         coalesce(string_agg(head || text || '<|end|>' || chr(10), '' ORDER BY turn)
           FILTER (same OR turn < end_turn), '') AS prompt,
         coalesce(max(head || text || '<|end|>' || chr(10)) FILTER (NOT same AND turn = end_turn), '') AS chosen,
         coalesce(max(head || other || '<|end|>' || chr(10)) FILTER (NOT same AND turn = end_turn), '') AS rejected
  FROM r GROUP BY ALL
)
SELECT conv_id, n_shared, prompt, chosen, rejected,
       CASE WHEN same THEN '' ELSE '0-' || length(chosen) END AS chosen_spans,
       CASE WHEN same THEN '' ELSE '0-' || length(rejected) END AS rejected_spans
FROM p
"""


@query
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every embedding on the first sixteen whitening components of the distinct vectors.

    A deviation beyond the longs is null; the operator gives it as a decimal.
    """
    found = whitening.whitened(table(spark, folder, "embeddings"), components=16)
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


@query
def op12_tiles(spark: SparkSession, folder: str) -> DataFrame:
    """Components of embeddings whose cosine is nine tenths or more."""
    return tiles.near_duplicates(table(spark, folder, "embeddings").select("vec_id", "embedding"), threshold=0.9)


SQL["op12_tiles"] = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings
), v AS (
  SELECT r, e, list_dot_product(e, e) AS q FROM d
  WHERE len(e) > 0 AND len(list_filter(e, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(e, lambda c: c <> 0)) > 0
), l AS (
  SELECT a.r AS x, b.r AS y FROM v a JOIN v b ON a.r <> b.r
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_dot_product(a.e, b.e) / sqrt(a.q * b.q) >= 0.9 ELSE false END
), n AS (
  SELECT x, count(*) AS n FROM l GROUP BY x
), reach AS (
  SELECT x, x AS y FROM n UNION SELECT reach.x, l.y FROM reach JOIN l ON reach.y = l.x
), c AS (
  SELECT x, min(vec_id) AS component_id FROM reach JOIN d ON d.r = reach.y GROUP BY x
)
SELECT vec_id, coalesce(n, 0) AS n_links,
       CASE WHEN n.x IS NULL THEN vec_id ELSE component_id END AS component_id,
       CASE WHEN n.x IS NULL THEN true ELSE vec_id IS NOT DISTINCT FROM component_id END AS kept
FROM d LEFT JOIN n ON n.x = d.r LEFT JOIN c ON c.x = d.r
"""


@query
def op13_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Five filters in every order, per language: what each step removes, and what each filter is worth."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return audit.audit(docs, table(spark, folder, "labels"))


SQL["op13_audit"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), least AS (
  SELECT t, min(doc_id) AS first_id FROM d GROUP BY t
), marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, t, doc_id > first_id AS again,
         regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w
  FROM d JOIN least USING (t) LEFT JOIN marks USING (doc_id)
), b AS (
  SELECT part, good, toxic, map {
    'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w),
    'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
    'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(again, false)} AS fails
  FROM f
), p AS (
  SELECT part, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: fails[x]) AS fails, count(*) AS n,
         count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM b GROUP BY ALL
), l AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), o AS (
  SELECT [a.x, b.x, c.x, d.x, e.x] AS o
  FROM l a JOIN l b ON b.x <> a.x JOIN l c ON c.x NOT IN (a.x, b.x)
  JOIN l d ON d.x NOT IN (a.x, b.x, c.x) JOIN l e ON e.x NOT IN (a.x, b.x, c.x, d.x)
), s AS (
  SELECT part, o, step, o[step] AS filter, n, good, toxic,
         list_contains(fails, o[step]) AS here, len(fails) AS many,
         list_has_any(fails, o[1:step - 1]) AS earlier
  FROM p, o, range(1, 6) AS r(step)
), a AS (
  SELECT part, array_to_string(o, '') AS filter_order, step, filter,
         coalesce(sum(n) FILTER (NOT here AND NOT earlier), 0) AS kept,
         coalesce(sum(n) FILTER (here AND NOT earlier), 0) AS removed,
         coalesce(sum(n) FILTER (here AND earlier), 0) AS redundant,
         coalesce(sum(n) FILTER (here AND many = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (here AND NOT earlier), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (here AND NOT earlier), 0) AS toxic_lost
  FROM s GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, sum(removed) OVER (PARTITION BY part, filter)::BIGINT AS shapley
FROM a
"""
