"""The package's operators as queries over the given tables, next to the SQL they must agree with where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgroups.llm import collocations, hamming, language, lexical_rank, near_vectors, packing, paragraph_sketch, piece_bpe, secrets, shingle_join, token_counts, toxicity, warc
from docgroups.session import scratch_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def categories() -> dict:
    """The chain's categories in their order, as conditions on a row of ``labels``."""
    return {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def language_id(spark, d):
    docs = _table(spark, d, "documents")
    model = language.train(docs.where(~language.held_out(F.col("doc_id"))))
    found = language.identify(docs, model)
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def nearest_codes(spark, d):
    codes = hamming.sign_codes(_table(spark, d, "embeddings"), "vec_id", "embedding")
    return hamming.search(codes, codes.where("id % 50 = 0"), 10)


def best_fit_packing(spark, d):
    return packing.packed_documents(_table(spark, d, "documents"), BYTE_BPE)


def near_duplicate_vectors(spark, d):
    return near_vectors.link(_table(spark, d, "embeddings"), 0.93)


def token_counts_by_line(spark, d):
    return token_counts.count_tokens(_table(spark, d, "documents"), BYTE_BPE)


def sentencepiece(spark, d):
    return piece_bpe.digests(_table(spark, d, "documents"), PIECE_BPE)


def secret_scan(spark, d):
    return secrets.digests(_table(spark, d, "documents"))


def warc_revisits(spark, d):
    pages = _table(spark, d, "pages")
    path = scratch_path(spark, "warc")
    warc.deduplicate(pages, path)
    kind = pages.schema["page_id"].dataType
    found = warc.payloads(warc.read(spark, path))
    return found.select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")
    )


def toxicity_chain(spark, d):
    docs = _table(spark, d, "documents")
    model = toxicity.train(docs, _table(spark, d, "labels"), categories())
    found = toxicity.predict(docs, model)
    return found.select("*", (F.col("p_toxic") >= toxicity.THRESHOLD).alias("toxic"))


def jaccard_join(spark, d):
    return shingle_join.link(_table(spark, d, "documents"), words=3, num=90, den=100)


def paragraph_fingerprints(spark, d):
    return paragraph_sketch.compare(_table(spark, d, "documents"))


def ranked_search(spark, d):
    return lexical_rank.rank(_table(spark, d, "documents"), _table(spark, d, "benchmark"), 50)


def phrase_collocations(spark, d):
    return collocations.mine(_table(spark, d, "documents"))


NEAREST_SQL = """
WITH found AS (
  SELECT q.vec_id AS query_id, e.vec_id AS id,
    list_sum(list_transform(range(1, 65), lambda i: CASE WHEN (q.embedding[i] > 0) <> (e.embedding[i] > 0) THEN 1 ELSE 0 END))::INTEGER AS distance
  FROM embeddings q JOIN embeddings e ON q.vec_id <> e.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id)::INTEGER AS rank FROM found)
SELECT query_id, rank, id, distance FROM ranked WHERE rank <= 10
"""

NEAR_VECTORS_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), sound AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND list_count(e) = len(e)
    AND len(list_filter(e, lambda x: isfinite(x))) = len(e) AND list_inner_product(e, e) > 0
), pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e)) / sqrt(list_inner_product(b.e, b.e)) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a
), named AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a AS vec_id, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM named LEFT JOIN counted USING (vec_id)
"""

ASSIGN_SQL = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _found_sql(kind: int, pattern: str, group: int) -> str:
    """Matches of a pattern and the texts between them, as lists."""
    return f"""SELECT doc_id, source, {kind} AS kind, regexp_extract_all(t, '{pattern}') AS w, regexp_extract_all(t, '{pattern}', {group}) AS v,
    regexp_split_to_array(t, '{pattern}') AS g FROM d"""


SECRETS_SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
lists AS (
  {_found_sql(0, ASSIGN_SQL, 2)} UNION ALL {_found_sql(1, "AKIA[A-Z0-9]+", 0)} UNION ALL
  {_found_sql(2, "[0-9a-f]+", 0)} UNION ALL {_found_sql(3, "[A-Za-z0-9+/_=-]+", 0)}
), places AS (
  SELECT doc_id, coalesce(source, '') AS owner, kind, v, w, unnest(range(1, len(w) + 1)) AS i,
    list_transform(w, lambda x: length(x)) AS wl, list_transform(g, lambda x: length(x)) AS gl FROM lists
  WHERE len(list_filter(v, lambda x: length(x) >= CASE kind WHEN 0 THEN 12 WHEN 1 THEN 18 WHEN 2 THEN 16 ELSE 20 END)) > 0
), spans AS (
  SELECT doc_id, owner, kind, v[i] AS value, (list_sum(gl[1:i]) + coalesce(list_sum(wl[1:i - 1]), 0))::BIGINT AS s,
    (list_sum(gl[1:i]) + list_sum(wl[1:i]))::BIGINT AS e FROM places
  WHERE length(v[i]) >= CASE kind WHEN 0 THEN 12 WHEN 1 THEN 18 WHEN 2 THEN 16 ELSE 20 END
), base AS (SELECT * FROM spans WHERE kind < 3),
mixed AS (
  SELECT * FROM spans a WHERE kind = 3 AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[a-z]')
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = a.doc_id AND b.s < a.e AND a.s < b.e)
), candidates AS (SELECT * FROM base UNION ALL SELECT * FROM mixed),
held AS (SELECT value, count(DISTINCT owner) AS owners FROM candidates GROUP BY value),
kept AS (SELECT c.*, owners >= 3 AS example FROM candidates c JOIN held USING (value) WHERE kind < 3 OR owners < 3),
listed AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    coalesce(string_agg(['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind) FILTER (kind < 3), '') AS base,
    string_agg(['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind) AS spans,
    count(*) FILTER (NOT example) AS n_live, count(*) FILTER (example) AS n_example FROM kept GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM d LEFT JOIN listed USING (doc_id)
"""

WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
s AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS x FROM p),
b AS (
  SELECT *, max(page_id) OVER (PARTITION BY x, payload_bytes) AS original,
    array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((('0x' || substr(x, 5 * (k // 4) + 1, 5))::BIGINT >> (15 - 5 * (k % 4))::INTEGER) & 31)::INTEGER + 1, 1)), '') AS payload_digest FROM s
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to FROM b
"""

JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w
), n AS (SELECT doc_id, len(s)::BIGINT AS n FROM s), e AS (SELECT doc_id, unnest(s) AS x FROM s),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT a AS doc_id, any_value(n.n) AS n_shingles, min(b) AS component_id FROM reach JOIN n ON n.doc_id = a GROUP BY a
"""

FINGERPRINT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents),
o AS (SELECT *, coalesce(lead(t) OVER (ORDER BY doc_id), first(t) OVER (ORDER BY doc_id)) AS after FROM d),
v AS (SELECT doc_id, n, t, after, substr(t, 1, (n - n // 4)::BIGINT) || substr(after, 1, (n // 4)::BIGINT) AS edited FROM o),
texts AS (SELECT doc_id, 0 AS v, t AS x FROM v UNION ALL SELECT doc_id, 1, edited FROM v UNION ALL SELECT doc_id, 2, after FROM v),
p AS (SELECT doc_id, v, unnest(list_distinct(list_filter(regexp_extract_all(x, '[^\n]{0,32}[^.!?\n]{0,96}[.!?\n]*'), lambda y: y <> ''))) AS p FROM texts),
k AS (SELECT DISTINCT doc_id, v, ('0x' || substr(md5(p), 1, 15))::BIGINT AS k FROM p),
f AS (SELECT *, k & 1048575 AS a, (k >> 20) & 1048575 AS b, (k >> 40) & 1048575 AS c FROM k),
checked AS (SELECT *, ((a * a) % 2147483647 * 524287 + (b * b) % 2147483647 * 131071 + (c * c) % 2147483647 * 8191
  + (a * b) % 2147483647 * 127 + (b * c) % 2147483647 * 31) % 2147483647 AS s FROM f),
placed AS (SELECT doc_id, v, k, s, unnest([a % 16, b % 16 + 16, c % 16 + 32]) AS cell FROM checked WHERE v < 2),
cells AS (SELECT doc_id, v, cell, count(*) AS n, bit_xor(k) AS k, bit_xor(s) AS s FROM placed GROUP BY ALL),
prints AS (SELECT doc_id, v, string_agg(concat_ws('.', to_hex(cell), to_hex(n), to_hex(k), to_hex(s)), ' ' ORDER BY cell) AS print FROM cells GROUP BY ALL),
sizes AS (SELECT doc_id, count(*) FILTER (v = 0) AS n0, count(*) FILTER (v = 1) AS n1, count(*) FILTER (v = 2) AS n2 FROM k GROUP BY ALL),
held AS (SELECT doc_id, k, bool_or(v = 0) AS x, bool_or(v = 1) AS y, bool_or(v = 2) AS z FROM k GROUP BY ALL),
shared AS (SELECT doc_id, count(*) FILTER (x AND y) AS c1, count(*) FILTER (x AND z) AS c2 FROM held GROUP BY ALL)
SELECT v.doc_id, n::BIGINT AS n_chars, sha256(edited) AS edited_sha256, coalesce(x.print, '') AS fingerprint, coalesce(y.print, '') AS edited_fingerprint,
  CASE WHEN coalesce(n0 + n1, 0) = 0 THEN 1.0::DOUBLE ELSE c1::DOUBLE / (n0 + n1 - c1) END AS near_edited,
  CASE WHEN coalesce(n0 + n2, 0) = 0 THEN 1.0::DOUBLE ELSE c2::DOUBLE / (n0 + n2 - c2) END AS near_next
FROM v LEFT JOIN prints x ON x.doc_id = v.doc_id AND x.v = 0 LEFT JOIN prints y ON y.doc_id = v.doc_id AND y.v = 1
  LEFT JOIN sizes ON sizes.doc_id = v.doc_id LEFT JOIN shared ON shared.doc_id = v.doc_id
"""

LEXICAL_SQL = r"""
WITH t AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
), held AS (SELECT r, doc_id, t, len(t)::BIGINT AS n FROM t WHERE len(t) > 0),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM held),
counts AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(t) AS term FROM held) GROUP BY ALL),
weighted AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM counts GROUP BY ALL), totals
), wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), lengths AS (SELECT r, doc_id, 50 + (50 * n * docs) // terms AS m FROM held, totals),
scored AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM wanted JOIN weighted USING (term) JOIN counts USING (term) JOIN lengths USING (r) GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

COLLOCATIONS_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents
), w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
f AS (
  SELECT lang, words, phrase, count(*)::BIGINT AS f FROM (
    SELECT lang, s AS words, unnest(list_transform(range(1, len(w) - s + 2), lambda i: array_to_string(w[i:i + s - 1], ' '))) AS phrase
    FROM w, (VALUES (1), (2), (3)) AS sizes(s)
  ) GROUP BY ALL
), n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words >= 2 AND f >= 10),
inner_phrases AS (
  SELECT lang, a, array_to_string(w[1:2], ' ') AS phrase FROM candidates WHERE words = 3
  UNION ALL SELECT lang, a, array_to_string(w[2:3], ' ') FROM candidates WHERE words = 3
), longer AS (SELECT lang, phrase, max(a) AS longer FROM inner_phrases GROUP BY ALL),
alone AS (SELECT c.* FROM candidates c LEFT JOIN longer USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
  FROM alone, (VALUES (1), (2)) AS cut(k) WHERE k < words
), valued AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.tail
), lowest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM valued) WHERE place = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

QUERIES = {
    "op1_language_id": (language_id, None),
    "op2_nearest_codes": (nearest_codes, NEAREST_SQL),
    "op3_best_fit_packing": (best_fit_packing, None),
    "op4_near_duplicate_vectors": (near_duplicate_vectors, NEAR_VECTORS_SQL),
    "op5_token_counts": (token_counts_by_line, None),
    "op6_sentencepiece": (sentencepiece, None),
    "op7_secret_scan": (secret_scan, SECRETS_SQL),
    "op8_warc_revisits": (warc_revisits, WARC_SQL),
    "op9_toxicity_chain": (toxicity_chain, None),
    "op10_jaccard_join": (jaccard_join, JACCARD_SQL),
    "op11_paragraph_fingerprints": (paragraph_fingerprints, FINGERPRINT_SQL),
    "op12_ranked_search": (ranked_search, LEXICAL_SQL),
    "op13_phrase_collocations": (phrase_collocations, COLLOCATIONS_SQL),
}
