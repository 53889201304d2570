"""The queries of the corpus operators, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, capfilters, contamination, extraction, language, licenses, middle, packed, probminhash, quality, repair, sharding, toxicity
from millrace.llm.learning import in_fold
from millrace.queries.registry import table
from millrace.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql.strip()
        return run

    return register


LINKED = """
WITH RECURSIVE usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach(id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT r.id AS vec_id, coalesce(any_value(n), 0)::BIGINT AS n_links, min(other) AS component_id, r.id = min(other) AS kept
FROM reach r LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) c ON c.a = r.id GROUP BY r.id
"""


@query(LINKED)
def op1_cap_filters(spark, sf):
    return capfilters.near_vectors(table(spark, sf, "embeddings"))


@query()
def op2_toxicity(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    network = toxicity.train(docs, table(spark, sf, "labels"))
    out = toxicity.score(docs, "text", network)
    return out.select("doc_id", in_fold("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query()
def op3_probminhash(spark, sf):
    out, _ = probminhash.near_copies(table(spark, sf, "documents"))
    return out.select("doc_id", "copy_of", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


@query()
def op4_quality_classifier(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = quality.classified(docs, table(spark, sf, "labels"))
    return out.select("doc_id", in_fold("doc_id", 4, 2).alias("held_out"), "score", "predicted")


@query()
def op5_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    model = language.train(docs)
    out = language.predicted(docs.select("doc_id", "text"), model)
    return out.select("doc_id", in_fold("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def vocabulary(name: str) -> str:
    """Where the public tokenizer files lie; the operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op6_page_text(spark, sf):
    field = extraction.train(extraction.labelled_pages())
    return extraction.extracted(table(spark, sf, "pages").select("page_id", "url", "html"), field)


@query()
def op7_bpe_round_trip(spark, sf):
    return bpe.digests(table(spark, sf, "documents"), vocabulary("word_bpe_49k.json"))


@query()
def op8_packed_ids(spark, sf):
    path = scratch_path(spark, "packed")
    packed.write_packed(table(spark, sf, "documents"), vocabulary("byte_bpe_50k.json"), path)
    return packed.read_packed(spark, path, with_ids=False)


#: Words, five-word shingles of the documents and of the items, and the share of an item's shingles that a document has.
CONTAINED = r"""
WITH words AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'i', item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), shingles AS (
  SELECT DISTINCT side, id, array_to_string(w[j : j + 4], ' ') AS gram FROM (SELECT side, id, w, unnest(range(1, len(w) - 3)) AS j FROM words WHERE len(w) >= 5)
), sizes AS (SELECT id, count(*) AS n FROM shingles WHERE side = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, count(*) / any_value(n)::DOUBLE AS containment
FROM shingles d JOIN shingles i ON d.side = 'd' AND i.side = 'i' AND d.gram = i.gram JOIN sizes ON sizes.id = i.id
GROUP BY d.id, i.id HAVING count(*) >= 0.8 * any_value(n)
"""


@query(CONTAINED)
def op9_containment(spark, sf):
    found = contamination.contained(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "containment")


@query()
def op10_license_scan(spark, sf):
    out = licenses.scan(table(spark, sf, "documents"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


#: crc32 by its bitwise definition, damage, faults, and the cheapest edits row by row over four states (0 nothing yet, 1 after
#: system, 2 after user, 3 after assistant); up to two rows are inserted before a row or at the end.
REPAIRED = r"""
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, n)) AS t
), ids AS (
  SELECT conv_id, row_number() OVER () AS conv FROM (SELECT DISTINCT conv_id FROM conversations)
), filled AS (
  SELECT conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(c.conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place
  FROM conversations c JOIN ids ON c.conv_id IS NOT DISTINCT FROM ids.conv_id
), places AS MATERIALIZED (
  SELECT place, xor(list_reduce(list_transform(range(1, length(place) + 1), lambda i: ascii(place[i])),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295) % 20 AS kind
  FROM (SELECT DISTINCT place FROM filled) p, crc
), damaged AS (
  SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM filled JOIN places USING (place)
), ordered AS (
  SELECT conv, turn, role, text, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM damaged
), faults AS MATERIALIZED (
  SELECT conv, i, turn, role, text, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS initial,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE 'none' END AS fault,
    lag(initial) OVER (PARTITION BY conv ORDER BY i) AS earlier
  FROM ordered
), inserts(q, r, extra, edits, added) AS (
  VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
    (0, 2, 3, 'I', chr(10) || 'user:'), (1, 2, 3, 'I', chr(10) || 'user:'), (3, 2, 3, 'I', chr(10) || 'user:'), (2, 3, 3, 'I', chr(10) || 'assistant:'),
    (0, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')
), leads(q, initial, r) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
), edits AS MATERIALIZED (
  SELECT conv, i, q, r, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS extra, 'K' AS edits, chr(10) || role || ':' || text AS added
  FROM faults JOIN leads USING (initial) WHERE fault IN ('none', 'truncated')
  UNION ALL
  SELECT conv, i, q, r, CASE fault WHEN 'truncated' THEN 6 ELSE 3 END, 'R', chr(10) || CASE r WHEN 3 THEN 'assistant' ELSE 'user' END || ':' || text
  FROM faults, leads WHERE fault IN ('none', 'truncated') AND leads.initial <> 's'
  UNION ALL
  SELECT conv, i, q, q, 4, 'D', '' FROM faults, range(4) states(q)
), steps AS MATERIALIZED (
  SELECT conv, e.i, a.q, e.r, min(ROW(a.extra + e.extra, a.edits || e.edits, a.added || e.added)) AS best
  FROM inserts a JOIN edits e ON a.r = e.q GROUP BY conv, e.i, a.q, e.r
), reached(conv, i, q, best) AS (
  SELECT conv, 0::BIGINT, 0, ROW(0, '', '') FROM ids
  UNION ALL
  SELECT s.conv, s.i, s.r, min(ROW(d.best[1] + s.best[1], d.best[2] || s.best[2], d.best[3] || s.best[3]))
  FROM reached d JOIN steps s ON s.conv = d.conv AND s.i = d.i + 1 AND s.q = d.q GROUP BY s.conv, s.i, s.r
), ends AS (
  SELECT d.conv, min(ROW(d.best[1] + a.extra, d.best[2] || a.edits, d.best[3] || a.added)) AS best
  FROM reached d JOIN (SELECT conv, max(i) AS i FROM reached GROUP BY conv) l USING (conv, i) JOIN inserts a ON a.q = d.q AND a.r IN (0, 3)
  GROUP BY d.conv
)
SELECT ids.conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
  count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal,
  any_value(best[1])::BIGINT AS cost, any_value(best[2]) AS audit, sha256(substr(any_value(best[3]), 2)) AS repaired_sha256
FROM ids JOIN ends USING (conv) LEFT JOIN faults USING (conv) GROUP BY ids.conv, ids.conv_id
"""


@query(REPAIRED)
def op11_conversation_repair(spark, sf):
    conversations = table(spark, sf, "conversations")
    return repair.digests(repair.damaged(conversations), conversations)


MIDDLES = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
), draws AS (
  SELECT doc_id, text, u, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS h1, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS h2,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
      WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM units
), parts AS (
  SELECT doc_id, text, n, form, array_to_string(u[1 : least(h1, h2)], '') AS p, array_to_string(u[least(h1, h2) + 1 : greatest(h1, h2)], '') AS m,
    array_to_string(u[greatest(h1, h2) + 1 : n], '') AS s
  FROM draws
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""


@query(MIDDLES)
def op12_fill_in_middle(spark, sf):
    out = middle.transformed(table(spark, sf, "documents").select("doc_id", "text"))
    text = middle.restored(F.col("output"), F.col("form"))
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256")]
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


@query()
def op13_shards(spark, sf):
    return sharding.sharded(table(spark, sf, "documents"), keep=False)
