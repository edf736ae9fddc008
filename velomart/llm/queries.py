"""The registered queries of the operators: thin, each over its whole table with
production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    conversation_repair,
    decontamination,
    embedding_join,
    exact_dedup,
    jaccard_join,
    language_id,
    lexical_search,
    licenses,
    mixing,
    sharding,
    suffix_dedup,
    token_counts,
    warc,
)
from .common import read_table

SHARDS = 24
TOKENIZER = "word_bpe_49k.json"
CONTEXT_TOKENS = 2048


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    found = decontamination.contamination(docs, items)
    digest = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op2_count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path(TOKENIZER)
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), path, budget=CONTEXT_TOKENS)


def op3_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_duplicates(read_table(spark, sf_dir, "embeddings"), threshold=0.9)


def op4_scan_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    files = docs.select("doc_id", licenses.document_path().alias("path"), "text")
    return licenses.scan(files, extra={"doc_id": F.col("doc_id")})


def op5_identify_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    apart = language_id.held_out("doc_id")
    model = language_id.train(docs, ~apart)
    return language_id.identify(docs, model, extra={"held_out": apart})


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read_table(spark, sf_dir, "documents")).drop("slot")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.JaccardJoin(read_table(spark, sf_dir, "documents"), n=4, percent=85).components().drop("root")


def op8_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), length=100)


def op9_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(read_table(spark, sf_dir, "documents"), shards=SHARDS)


def op10_write_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_pages(read_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.equal_texts(read_table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=10)


def op13_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damage(rows), of=rows)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_count_tokens": op2_count_tokens,
    "op3_embedding_join": op3_embedding_join,
    "op4_scan_licenses": op4_scan_licenses,
    "op5_identify_language": op5_identify_language,
    "op6_mix_sources": op6_mix_sources,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_remove_repeats": op8_remove_repeats,
    "op9_shard_documents": op9_shard_documents,
    "op10_write_warc": op10_write_warc,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_lexical_search": op12_lexical_search,
    "op13_repair_conversations": op13_repair_conversations,
}

#: ASCII capitals and their small letters.
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_OP1_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT cast(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS s
  FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)
), hit AS (
  SELECT dw.r, dw.i, dw.n, bw.item FROM dw JOIN bw ON dw.n = bw.n AND dw.s = bw.s
), n_hit AS (
  SELECT r, count(DISTINCT p) AS k FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r
), items AS (
  SELECT r, count(*) AS k, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hit WHERE item IS NOT NULL) GROUP BY r
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit.k, 0) AS n_hit, coalesce(items.k, 0) AS n_items,
       sha256(coalesce(items.ids, '')) AS items_sha256,
       coalesce(n_hit.k, 0) > 0 AND 20 * coalesce(n_hit.k, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN n_hit USING (r) LEFT JOIN items USING (r)"""

_OP8_SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS s
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM d WHERE len(h) >= 200)
), again AS (
  SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM w) WHERE k > 1
), run AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b
  FROM (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS g
        FROM (SELECT *, CASE WHEN i > lag(i, 1, -101) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 1 ELSE 0 END AS opens FROM again))
  GROUP BY doc_id, g
), gap AS (
  SELECT doc_id, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS a, a AS b FROM run
  UNION ALL
  SELECT d.doc_id, coalesce(max(run.b), 0) AS a, max(len(h)) // 2 AS b FROM d LEFT JOIN run USING (doc_id) GROUP BY d.doc_id
), kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h FROM gap JOIN d USING (doc_id) GROUP BY doc_id
), gone AS (
  SELECT doc_id, sum(b - a) AS n, count(*) AS k FROM run GROUP BY doc_id
)
SELECT d.doc_id, len(d.h) // 2 AS n_bytes, cast(coalesce(gone.n, 0) AS BIGINT) AS n_removed, coalesce(gone.k, 0) AS n_spans,
       sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)"""

_OP10_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM f"""

_OP3_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, cast(embedding AS DOUBLE[]) AS e FROM embeddings
), ok AS (
  SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
    AND list_sum([abs(x) FOR x IN e]) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), c AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), n AS (
  SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a
)
SELECT vec_id, coalesce(n.n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)"""

_OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5(coalesce(cast(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key
  FROM documents
), s AS (
  SELECT source, cast(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source
), l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s
), t AS (
  SELECT *, least(cast(3 * source_size AS DOUBLE), (SELECT arg_min(level, 3 * source_size / weight) FROM l WHERE level <= 3 * source_size / weight) * weight) AS target FROM l
), q AS (
  SELECT *, CASE WHEN target > 0 THEN greatest(cast(round(target) AS BIGINT), 1) ELSE 0 END AS quota FROM t
), line AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM d
)
SELECT line.doc_id, line.size, q.source_size, q.target, line.source,
       cast(sum(greatest(0, least(start + lap * q.source_size + line.size, quota) - (start + lap * q.source_size))) AS BIGINT) AS taken
FROM line JOIN q ON q.source IS NOT DISTINCT FROM line.source, (SELECT unnest([0, 1, 2]) AS lap)
GROUP BY line.doc_id, line.size, q.source_size, q.target, line.source, line.start, line.key"""

_OP7_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(4, len(w)) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)"""

_OP11_SQL = r"""
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY s) AS group_size, row_number() OVER w = 1 AS kept, sha256(s) AS text_sha256
FROM (SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS s FROM documents)
WINDOW w AS (PARTITION BY s ORDER BY points DESC, doc_id NULLS LAST)"""

_OP12_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), total AS (
  SELECT count(*) AS nd, cast(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0
), tf AS (
  SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, cast(len(w) AS BIGINT) AS n, unnest(w) AS t FROM d) GROUP BY ALL
), df AS (
  SELECT t, cast(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tf, total GROUP BY t, nd
), item AS (
  SELECT q, item_id, t, count(*) AS times FROM (SELECT q, item_id, unnest(w) AS t FROM b) GROUP BY ALL
), score AS (
  SELECT q, item_id, r, doc_id, cast(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // l)))) AS BIGINT) AS score
  FROM item JOIN df USING (t) JOIN tf USING (t), total GROUP BY q, item_id, r, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM score WHERE score > 0
)
SELECT item_id, cast(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10"""


def _op13_sql() -> str:
    """Row by row, the least (cost, audit, repaired turns) that ends in each state."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        table.append(str(byte))
    of = lambda s, cost, letter, line: f"CASE WHEN {s} IS NOT NULL THEN {{'c': {s}.c + {cost}, 'a': {s}.a || '{letter}', 't': {s}.t || {line}}} END"
    nothing = "CAST([] AS VARCHAR[])"
    user, assistant, both = (f"[{', '.join(x)}]" for x in (["'user:'"], ["'assistant:'"], ["'user:'", "'assistant:'"]))
    stays = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"
    kept = lambda s, letter: f"CASE WHEN may AND initial = '{letter}' THEN {of(s, stays, 'K', '[role || chr(58) || text]')} END"
    reroled = lambda s, role: f"CASE WHEN may THEN {of(s, f'{stays} + 3', 'R', f'[{chr(39)}{role}:{chr(39)} || text]')} END"
    drop = lambda s: of(s, 4, "D", nothing)
    before_u = ("e0", "e1", "e3")
    return rf"""
WITH RECURSIVE crc AS (
  SELECT [{", ".join(table)}]::BIGINT[] AS t
), c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(cast(conv_id AS VARCHAR), ' ') || ':' || coalesce(cast(turn AS VARCHAR), ' ') AS place FROM conversations
), kinds AS (
  SELECT c.*, xor(list_reduce([4294967295::BIGINT] || [ascii(x)::BIGINT FOR x IN string_split(place, '')], lambda h, x: xor(h >> 8, t[(xor(h, x) & 255) + 1])), 4294967295) % 20 AS kind FROM c, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM kinds, (SELECT unnest([0, 1]) AS copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)
), ranked AS (
  SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) AS stop
  FROM damaged
), counted AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM ranked
), x AS (
  SELECT *, CASE WHEN stop = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN stop NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         stop <> '' AND nth = 1 AS may, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS prior
  FROM counted
), walk AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 't': {nothing}}} AS s0, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR[]) AS s1,
         NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR[]) AS s2, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR[]) AS s3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, {drop("e0")} AS s0, least({drop("e1")}, {kept("e0", "s")}) AS s1,
         least({drop("e2")}, {", ".join(kept(s, "u") for s in before_u)}, {", ".join(reroled(s, "user") for s in before_u)}) AS s2,
         least({drop("e3")}, {kept("e2", "a")}, {reroled("e2", "assistant")}) AS s3
  FROM (
    SELECT walk.conv_id, x.i, role, text, initial, fault, may, s0 AS e0, s1 AS e1,
           least(s2, {of("s0", 3, "I", user)}, {of("s1", 3, "I", user)}, {of("s3", 3, "I", user)}) AS e2,
           least(s3, {of("s2", 3, "I", assistant)}, {of("s0", 6, "II", both)}, {of("s1", 6, "II", both)}) AS e3
    FROM walk JOIN x ON x.conv_id IS NOT DISTINCT FROM walk.conv_id AND x.i = walk.i + 1
  )
), best AS (
  SELECT conv_id, least(s0, s3, {of("s2", 3, "I", assistant)}, {of("s1", 6, "II", both)}) AS s FROM walk
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
), sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (prior IS NOT NULL AND (prior || initial) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM x GROUP BY conv_id
)
SELECT best.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, s.c AS cost, s.a AS audit, sha256(array_to_string(s.t, chr(10))) AS repaired_sha256
FROM best LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM best.conv_id"""


ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": _OP1_SQL,
    "op3_embedding_join": _OP3_SQL,
    "op6_mix_sources": _OP6_SQL,
    "op7_jaccard_join": _OP7_SQL,
    "op8_remove_repeats": _OP8_SQL,
    "op10_write_warc": _OP10_SQL,
    "op11_exact_dedup": _OP11_SQL,
    "op12_lexical_search": _OP12_SQL,
    "op13_repair_conversations": _op13_sql(),
}
