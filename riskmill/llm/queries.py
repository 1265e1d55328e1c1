"""One query per operator of this folder over the supplied tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskmill.llm import (
    collocations, licenses, lm, mixing, packing, phrases, quality, repair, shingles, topk, toxicity, vectors, warc,
)
from riskmill.llm.store import stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_mix_sources(spark, sf_dir):
    """Every document with the words that the mix takes of it."""
    docs = table(spark, sf_dir, "documents")
    narrow = stored(docs.select(
        "doc_id", "source", mixing.word_count(F.col("text")).alias("size"),
        mixing.text_quality(F.col("text")).alias("weight"),
    ))
    mix = mixing.mix_documents(narrow, "doc_id", "source", F.col("size"), F.col("weight"))
    return mix.select(
        "doc_id", "size", F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
        (F.col("mix_copies") * F.col("size")).alias("taken"),
    )


def _part(key: str, parts: int):
    """The remainder that sets rows aside from learning."""
    return F.crc32(F.col(key).cast("string")) % parts


def toxicity_model(spark, sf_dir, docs):
    labels = table(spark, sf_dir, "labels").filter(_part("doc_id", 5) != 0)
    return toxicity.fit_toxicity(docs, labels)


def quality_model(spark, sf_dir, docs):
    labels = table(spark, sf_dir, "labels").filter(_part("doc_id", 4) != 2)
    return quality.fit_quality(docs, labels)


@_query
def op2_toxicity(spark, sf_dir):
    """Every document with its probability of being toxic."""
    docs = table(spark, sf_dir, "documents")
    score = toxicity.toxicity_score(toxicity_model(spark, sf_dir, docs), F.col("text"))
    scored = docs.select("doc_id", F.coalesce(_part("doc_id", 5) == 0, F.lit(False)).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@_query
def op3_quality(spark, sf_dir):
    """Every document with its probability of being of good quality."""
    docs = table(spark, sf_dir, "documents")
    score = quality.quality_score(quality_model(spark, sf_dir, docs), F.col("text"))
    scored = docs.select("doc_id", F.coalesce(_part("doc_id", 4) == 2, F.lit(False)).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@_query
def op4_near_vectors(spark, sf_dir):
    """Every vector with its links at a cosine of 0.95 or more, and the group that they make."""
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


@_query
def op5_lm_scores(spark, sf_dir):
    """Every document with its log10 probability by single words and by the backoff model."""
    held_out = F.coalesce(_part("doc_id", 7) == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents")
    return lm.lm_scores(docs, "doc_id", "text", ~held_out).withColumn("held_out", held_out)


@_query
def op6_nearest_vectors(spark, sf_dir):
    """The five nearest vectors of every fiftieth one, by integer inner product."""
    rows = table(spark, sf_dir, "embeddings")
    return topk.nearest(rows, "vec_id", "embedding", F.col("vec_id") % 50 == 0)


@_query
def op7_warc(spark, sf_dir):
    """Every page as the archives hold it, after writing them and reading them back."""
    folder = warc.archive_folder(spark, "archive")
    stored(warc.write_archive(table(spark, sf_dir, "pages"), "page_id", "url", "html", folder))
    return warc.read_archive(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@_query
def op8_pack(spark, sf_dir):
    """Every piece of a document with its place in a sequence of at most 2048 tokens."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, "doc_id", "text", packing.tokenizer_path("byte_bpe_50k.json"))


@_query
def op9_licenses(spark, sf_dir):
    """Every license notice in a document, with its place and how it differs from the usual wording."""
    return licenses.license_notices(table(spark, sf_dir, "documents"), "doc_id", "text")


@_query
def op10_similar_documents(spark, sf_dir):
    """Every document with the size of its set of word triples and its group at a Jaccard of 0.9."""
    return shingles.similar_documents(table(spark, sf_dir, "documents"), "doc_id", "text")


@_query
def op11_decontaminate(spark, sf_dir):
    """Every document with its words inside ten-word windows of the benchmark, and the items concerned."""
    index = phrases.build_index(table(spark, sf_dir, "documents"), "doc_id", "text")
    found = phrases.phrase_search(index, table(spark, sf_dir, "benchmark"), "item_id", "text")
    return phrases.contamination(found, "doc_id").select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@_query
def op12_collocations(spark, sf_dir):
    """The first 2000 phrases of each language by how much oftener their words stand together than apart."""
    candidates = collocations.collocations(table(spark, sf_dir, "documents"), "text", "lang")
    return collocations.best_collocations(candidates, 2000)


@_query
def op13_repair_conversations(spark, sf_dir):
    """Every damaged conversation with its faults and its cheapest repair."""
    rows = repair.damaged(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    return repair.repair_conversations(rows, "conv_id", "turn", "role", "text", present=F.col("present"))


ORACLE_SQL: dict[str, str] = {
    "op1_mix_sources": r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(doc_id::VARCHAR, '') AS id,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         coalesce(greatest(0.05::DOUBLE, 1.0::DOUBLE
           - (length(text) - length(translate(text, '#$%&*|!<>{}[]=\~^_@', ''))) * 10.0::DOUBLE
           / greatest(length(text), 1)), 0.05::DOUBLE) AS weight
  FROM documents
), docs AS (
  SELECT *, -ln((('0x' || substr(md5('17:' || id), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
         / weight AS draw
  FROM sized
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place, source_size * 3.0::DOUBLE AS most FROM totals
), weighted AS (
  SELECT *, (CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::DOUBLE AS w FROM ranked
), levels AS (
  SELECT *, (sum(source_size) OVER () * 1.0::DOUBLE - coalesce(sum(most) OVER (ORDER BY most / w, place
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY most / w, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted
), targets AS (
  SELECT source, source_size, least(most, w * max(CASE WHEN level * w <= most THEN level END) OVER ()) AS target
  FROM levels
), summed AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END AS epochs,
         sum(size) OVER (PARTITION BY d.source ORDER BY draw, id, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN target - epochs * source_size > 0
                               AND upto - size / 2 <= target - epochs * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed""",
    "op6_nearest_vectors": """
WITH parts AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)])::BIGINT AS score
  FROM (SELECT DISTINCT * FROM parts) q JOIN parts c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
  FROM scores
)
SELECT * FROM ranked WHERE rank <= 5""",
    "op7_warc": """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first
  FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS DISTINCT FROM page_id AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM firsts""",
    "op11_decontaminate": r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), places AS (
  SELECT row, size, i, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT row, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
), hits AS (
  SELECT row, i, p.size, item_id FROM places p JOIN windows w ON p.size = w.size AND p.phrase = w.phrase
), words AS (
  SELECT row, count(DISTINCT j) AS n_hit FROM (SELECT row, unnest(range(i, i + size)) AS j FROM hits) GROUP BY row
), found AS (
  SELECT row, list_sort(list(DISTINCT coalesce(item_id::VARCHAR, ''))) AS ids FROM hits GROUP BY row
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN words USING (row) LEFT JOIN found USING (row)""",
    "op12_collocations": r"""
WITH pieces AS (
  SELECT row, lang, unnest(p) AS piece, generate_subscripts(p, 1) AS nth
  FROM (SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang,
               string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[.,;:!?\x0A-\x0D]') AS p FROM documents)
), words AS (
  SELECT lang, w, i, lead(w) OVER z AS w2, lead(w, 2) OVER z AS w3
  FROM (SELECT row, nth, lang, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
        FROM (SELECT *, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces))
  WINDOW z AS (PARTITION BY row, nth ORDER BY i)
), one AS (
  SELECT lang, w, count(*) AS f FROM words GROUP BY ALL
), two AS (
  SELECT lang, w, w2, count(*) AS f FROM words WHERE w2 IS NOT NULL GROUP BY ALL
), three AS (
  SELECT lang, w, w2, w3, count(*) AS f FROM words WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), covered AS (
  SELECT t.lang, b.w, b.w2 FROM three t JOIN two b ON t.lang = b.lang
    AND ((b.w = t.w AND b.w2 = t.w2) OR (b.w = t.w2 AND b.w2 = t.w3)) AND 100 * t.f >= 50 * b.f
), cuts AS (
  SELECT b.lang, b.w || ' ' || b.w2 AS phrase, b.f AS a, x.f AS l, y.f AS r, 1 AS k
  FROM two b JOIN one x ON x.lang = b.lang AND x.w = b.w JOIN one y ON y.lang = b.lang AND y.w = b.w2
  WHERE b.f >= 10 AND NOT EXISTS (FROM covered c WHERE c.lang = b.lang AND c.w = b.w AND c.w2 = b.w2)
  UNION ALL
  SELECT t.lang, t.w || ' ' || t.w2 || ' ' || t.w3, t.f, x.f, y.f, 1
  FROM three t JOIN one x ON x.lang = t.lang AND x.w = t.w JOIN two y ON y.lang = t.lang AND y.w = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w || ' ' || t.w2 || ' ' || t.w3, t.f, x.f, y.f, 2
  FROM three t JOIN two x ON x.lang = t.lang AND x.w = t.w AND x.w2 = t.w2 JOIN one y ON y.lang = t.lang AND y.w = t.w3
), scored AS (
  SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN (SELECT lang, count(*) AS n FROM words GROUP BY lang) USING (lang) WHERE rank <= 2000""",
    "op13_repair_conversations": r"""
WITH RECURSIVE bits AS (
  SELECT list(x ORDER BY b) AS t
  FROM (SELECT b, list_reduce(list_concat([b], range(8)),
                              lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS x
        FROM range(256) r(b))
), hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_concat([4294967295], [ascii(c) FOR c IN string_split(
             coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')]),
             lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295) % 20 AS fate
  FROM conversations, bits
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE fate WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         rtrim(text, E' \t\n\x0b\x0c\r') AS bare
  FROM damaged
), faults AS (
  SELECT *, left(role, 1) AS c,
         CASE WHEN bare = '' THEN 'blank' WHEN min(i) OVER (PARTITION BY conv_id, role, text) < i THEN 'duplicate'
              WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM ordered
), facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
         count(*) AS rows
  FROM faults GROUP BY conv_id
), ways AS (
  SELECT conv_id, 0::BIGINT AS i, {'c': 0::BIGINT, 'a': ''} AS q0, {'c': 1000000000::BIGINT, 'a': ''} AS q1,
         {'c': 5::BIGINT, 'a': 'I'} AS q2, {'c': 10::BIGINT, 'a': 'II'} AS q3
  FROM facts
  UNION ALL
  SELECT conv_id, i, n0, n1,
         list_min([n2, {'c': n0.c + 5, 'a': n0.a || 'I'}, {'c': n1.c + 5, 'a': n1.a || 'I'}, {'c': n3.c + 5, 'a': n3.a || 'I'}]),
         list_min([n3, {'c': n2.c + 5, 'a': n2.a || 'I'}, {'c': n0.c + 10, 'a': n0.a || 'II'}, {'c': n1.c + 10, 'a': n1.a || 'II'}])
  FROM (
    SELECT w.conv_id, f.i, {'c': q0.c + 2, 'a': q0.a || 'D'} AS n0,
           list_min([{'c': q1.c + 2, 'a': q1.a || 'D'}, {'c': q0.c + CASE WHEN c = 's' THEN stay ELSE never END, 'a': q0.a || 'K'}]) AS n1,
           list_min([{'c': q2.c + 2, 'a': q2.a || 'D'}, {'c': from2.c + stay + 1, 'a': from2.a || 'R'},
                     {'c': from2.c + CASE WHEN c = 'u' THEN stay ELSE never END, 'a': from2.a || 'K'}]) AS n2,
           list_min([{'c': q3.c + 2, 'a': q3.a || 'D'}, {'c': q2.c + stay + 1, 'a': q2.a || 'R'},
                     {'c': q2.c + CASE WHEN c = 'a' THEN stay ELSE never END, 'a': q2.a || 'K'}]) AS n3
    FROM (SELECT *, list_min([q0, q1, q3]) AS from2, 1000000000 AS never FROM ways) w
    JOIN (SELECT *, CASE fault WHEN '' THEN 0 WHEN 'truncated' THEN 5 ELSE 1000000000 END AS stay FROM faults) f
      ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = w.i + 1
  )
), best AS (
  SELECT w.conv_id, list_min([q0, q3]) AS way FROM ways w JOIN facts f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.i = f.rows
), letters AS (
  SELECT conv_id, e, sum(CASE WHEN e = 'I' THEN 0 ELSE 1 END) OVER z AS i, sum(CASE WHEN e = 'D' THEN 0 ELSE 1 END) OVER z AS place
  FROM (SELECT conv_id, unnest(string_split(way.a, '')) AS e, generate_subscripts(string_split(way.a, ''), 1) AS k FROM best WHERE way.a <> '')
  WINDOW z AS (PARTITION BY conv_id ORDER BY k)
), kept AS (
  SELECT l.conv_id, l.e, l.place, f.role, f.text, max(CASE WHEN l.e = 'K' AND l.place = 1 AND f.c = 's' THEN 1 ELSE 0 END)
           OVER (PARTITION BY l.conv_id) AS led
  FROM letters l LEFT JOIN faults f ON l.conv_id IS NOT DISTINCT FROM f.conv_id AND l.i = f.i AND l.e <> 'I'
  WHERE l.e <> 'D'
), said AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END
                             || ':' || coalesce(text, ''), chr(10) ORDER BY place) AS text
  FROM kept GROUP BY conv_id
)
SELECT d.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(way.c, 0)::BIGINT AS cost,
       coalesce(way.a, '') AS audit, sha256(coalesce(s.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d
LEFT JOIN facts f ON d.conv_id IS NOT DISTINCT FROM f.conv_id
LEFT JOIN best b ON d.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN said s ON d.conv_id IS NOT DISTINCT FROM s.conv_id""",
}


def registered() -> dict[str, Query]:
    """All queries by name, the pipeline among them."""
    return dict(QUERIES)


def statements() -> dict[str, str]:
    """SQL by query name."""
    return dict(ORACLE_SQL)
