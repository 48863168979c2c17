"""One query per operator, over its whole table, and the same in SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmweave.llm.chat_format import render_conversations
from firmweave.llm.conversation_repair import damaged, repair_conversations
from firmweave.llm.decontaminate import find_contamination
from firmweave.llm.embedding_dedup import link_embeddings
from firmweave.llm.kneser_ney import score_texts
from firmweave.llm.lexical_search import search
from firmweave.llm.quality import judge
from firmweave.llm.sentencepiece_codec import decode_ids, encode_texts
from firmweave.llm.sharding import assign_shards, number_slots, shard_salt
from firmweave.llm.simhash_dedup import near_duplicates
from firmweave.llm.substring_dedup import remove_repeated_words
from firmweave.llm.suffix_array_dedup import remove_repeated_bytes
from firmweave.llm.token_counts import count_tokens

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*columns) if columns else df


@query
def op1_substring_dedup(spark, sf_dir):
    found = remove_repeated_words(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op1_substring_dedup"] = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35)
), repeated AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY md5(s)) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM repeated
), each AS (
    SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words)
), kept AS (
    SELECT e.doc_id, count(c.i) AS n_removed, string_agg(e.word, ' ' ORDER BY e.i) FILTER (WHERE c.i IS NULL) AS s
    FROM each e LEFT JOIN covered c USING (doc_id, i) GROUP BY e.doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.s, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (doc_id)
"""


@query
def op3_suffix_array_dedup(spark, sf_dir):
    found = remove_repeated_bytes(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op3_suffix_array_dedup"] = r"""
WITH texts AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), places AS (
    SELECT doc_id, i, h[2 * i + 1:2 * i + 2] AS b,
           CASE WHEN 2 * (i + 50) <= len(h) THEN md5(h[2 * i + 1:2 * i + 100]) END AS s
    FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2)) AS i FROM texts)
), starts AS (
    SELECT doc_id, i, b, CASE WHEN s IS NOT NULL AND min(doc_id) OVER (PARTITION BY s) < doc_id THEN 1 ELSE 0 END AS hit FROM places
), covered AS (
    SELECT doc_id, i, b, max(hit) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM starts
), edges AS (
    SELECT *, lag(gone, 1, 0) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM covered
), found AS (
    SELECT doc_id, sum(gone) AS n_removed, sum(CASE WHEN gone = 1 AND before = 0 THEN 1 ELSE 0 END) AS n_spans,
           string_agg(b, '' ORDER BY i) FILTER (WHERE gone = 0) AS kept
    FROM edges GROUP BY doc_id
)
SELECT t.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM texts t LEFT JOIN found USING (doc_id)
"""


@query
def op6_benchmark_decontamination(spark, sf_dir):
    benchmark = read(spark, sf_dir, "benchmark", "item_id", "text")
    found = find_contamination(read(spark, sf_dir, "documents", "doc_id", "text"), benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLES["op6_benchmark_decontamination"] = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), items AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)
), places AS (
    SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT k FROM items) WHERE len(w) >= k
), hits AS (
    SELECT p.doc_id, p.i, p.k, t.item_id
    FROM (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM places) p JOIN items t ON t.k = p.k AND t.s = p.s
), words AS (
    SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hits) GROUP BY doc_id
), names AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names.s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN names USING (doc_id)
"""


def tokenizer_file(name: str) -> str:
    """Where a public vocabulary file lies; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op8_token_counts(spark, sf_dir):
    counted = count_tokens(read(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_file("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op9_sentencepiece_codec(spark, sf_dir):
    path = tokenizer_file("piece_bpe_32k.model")
    coded = decode_ids(encode_texts(read(spark, sf_dir, "documents", "doc_id", "text"), path), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


@query
def op2_chat_formatting(spark, sf_dir):
    return render_conversations(read(spark, sf_dir, "conversations"))


ORACLES["op2_chat_formatting"] = r"""
WITH turns AS (
    SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
), each AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k,
           '<|' || coalesce(role, '') || E'|>\n' || coalesce(text, '') || E'\n<|end|>\n' AS s,
           CASE WHEN role IS NULL THEN '0' ELSE '1' END || CASE WHEN text IS NULL THEN '0' ELSE '1' END AS flags
    FROM turns
), prefixes AS (
    SELECT conv_id, k, md5(string_agg(flags || md5(s), '' ORDER BY k) OVER (PARTITION BY conv_id ORDER BY k)) AS p FROM each
), finals AS (
    SELECT conv_id, max(k) AS n, arg_max(p, k) AS p FROM prefixes GROUP BY conv_id
), longer AS (
    SELECT DISTINCT x.k, x.p FROM prefixes x JOIN finals f USING (conv_id) WHERE x.k < f.n
), kept AS (
    SELECT n, p, min(conv_id) AS conv_id, count(*) AS n_copies FROM finals GROUP BY n, p
)
SELECT k.conv_id, k.n AS n_turns, k.n_copies, string_agg(e.s, '' ORDER BY e.k) AS rendered
FROM kept k JOIN each e USING (conv_id)
WHERE NOT EXISTS (SELECT 1 FROM longer l WHERE l.k = k.n AND l.p = k.p)
GROUP BY k.conv_id, k.n, k.n_copies
"""


@query
def op4_simhash_near_dedup(spark, sf_dir):
    found = near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op10_embedding_near_dedup(spark, sf_dir):
    return link_embeddings(read(spark, sf_dir, "embeddings"))


ORACLES["op10_embedding_near_dedup"] = r"""
WITH RECURSIVE usable AS (
    SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach(a, b) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), roots AS (
    SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), counts AS (
    SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(c.n_links, 0) AS n_links, r.component_id, e.vec_id = r.component_id AS kept
FROM embeddings e JOIN roots r USING (vec_id) LEFT JOIN counts c USING (vec_id)
"""


@query
def op5_language_model(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return score_texts(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, order=3)


@query
def op7_quality_classifier(spark, sf_dir):
    judged = judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return judged.select("doc_id", "source", "lang", "p_low", "p_toxic", "rejected")


# Shards of the sharding query, all of one weight.
SHARDS = 24


@query
def op13_sharding(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    text = F.coalesce("text", F.lit("")).cast("binary")
    narrow = docs.select("doc_id", (F.length(text) + 8).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"))
    sharded = assign_shards(assign_shards(narrow, [1.0] * SHARDS), [1.0] * (SHARDS + 1), out="grown_shard")
    placed = number_slots(sharded, ["doc_id", "size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


#: CRC-32 of the bytes whose hexadecimal digits are ``{hex}``, as a DuckDB expression; ``crc`` holds its table.
CRC_TABLE = """SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1
        THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(i AS BIGINT))) AS t"""
CRC_OF = """xor(list_reduce(list_transform(range(0, len({hex}), 2), lambda i: CAST(16 * (instr('0123456789ABCDEF', {hex}[i + 1]) - 1)
        + instr('0123456789ABCDEF', {hex}[i + 2]) - 1 AS BIGINT)),
        lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295), 4294967295)"""

ORACLES["op13_sharding"] = f"""
WITH crc AS (
    {CRC_TABLE}
), keyed AS (
    SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents
), bits AS (
    SELECT r, doc_id, len(h) // 2 + 8 AS size, {CRC_OF.format(hex="h")} AS text_crc32,
           CAST('0x' || d[1:8] AS BIGINT) AS a, CAST('0x' || d[9:16] AS BIGINT) AS b
    FROM keyed, crc
), salts AS (
    SELECT unnest(range({SHARDS + 1})) AS i, unnest([{", ".join(str(shard_salt(i)) for i in range(SHARDS + 1))}]::BIGINT[]) AS salt
), s1 AS (SELECT r, i, b, xor(a, salt) AS x FROM bits, salts
), s2 AS (SELECT r, i, b, (xor(x, x >> 16) * 73244475) % 4294967296 AS x FROM s1
), s3 AS (SELECT r, i, b, (xor(x, x >> 16) * 739982445) % 4294967296 AS x FROM s2
), s4 AS (SELECT r, i, (xor(x, x >> 15) + b) % 4294967296 AS x FROM s3
), s5 AS (SELECT r, i, (xor(x, x >> 16) * 73244475) % 4294967296 AS x FROM s4
), s6 AS (SELECT r, i, (xor(x, x >> 16) * 739982445) % 4294967296 AS x FROM s5
), draws AS (
    SELECT r, i, xor(x, x >> 15) AS x FROM s6
), best AS (
    SELECT r, arg_max(i, x * 64 - i) FILTER (WHERE i < {SHARDS}) AS shard, arg_max(i, x * 64 - i) AS grown FROM draws GROUP BY r
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, CAST(grown AS INTEGER) AS grown_shard
FROM bits JOIN best USING (r)
"""


@query
def op12_conversation_repair(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return repair_conversations(damaged(turns), turns)


ORACLES["op12_conversation_repair"] = rf"""
WITH RECURSIVE crc AS (
    {CRC_TABLE}
), keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS h
    FROM conversations
), hit AS (
    SELECT conv_id, turn, role, text, {CRC_OF.format(hex="h")} % 20 AS f FROM keyed, crc
), kept AS (
    SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM hit WHERE f <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text), copy) AS k,
           regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last_one
    FROM kept
), faults AS (
    SELECT *, CASE WHEN last_one = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
                   WHEN last_one NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
           lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY k) || role[1:1] AS pair
    FROM placed
), ops(q, letter, t, need) AS (
    VALUES (0, 'D', 0, ''), (1, 'D', 1, ''), (2, 'D', 2, ''), (3, 'D', 3, ''), (0, 'K', 1, 's'), (0, 'K', 2, 'u'), (1, 'K', 2, 'u'), (3, 'K', 2, 'u'),
           (2, 'K', 3, 'a'), (0, 'R', 2, ''), (1, 'R', 2, ''), (3, 'R', 2, ''), (2, 'R', 3, '')
), inserts(q, t, letters, lines) AS (
    VALUES (0, 0, '', []::VARCHAR[]), (1, 1, '', []), (2, 2, '', []), (3, 3, '', []), (0, 2, 'I', ['user:']), (0, 3, 'II', ['user:', 'assistant:']),
           (1, 2, 'I', ['user:']), (1, 3, 'II', ['user:', 'assistant:']), (2, 3, 'I', ['assistant:']), (3, 2, 'I', ['user:'])
), paths AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS k, i.t AS q, {{'cost': 2 * length(letters), 'audit': letters, 'lines': lines}} AS best
    FROM (SELECT DISTINCT conv_id FROM faults) JOIN inserts i ON i.q = 0
    UNION ALL
    SELECT p.conv_id, f.k, i.t, min({{'cost': p.best.cost + 2 * length(letters) + CASE letter WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END
                                               + CASE WHEN letter <> 'D' AND fault = 'truncated' THEN 1 ELSE 0 END,
                                     'audit': p.best.audit || letter || letters,
                                     'lines': p.best.lines || CASE letter WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [role || ':' || text]
                                              ELSE [CASE o.t WHEN 2 THEN 'user:' ELSE 'assistant:' END || text] END || i.lines}})
    FROM paths p JOIN faults f ON f.k = p.k + 1 AND f.conv_id IS NOT DISTINCT FROM p.conv_id JOIN ops o ON o.q = p.q JOIN inserts i ON i.q = o.t
    WHERE letter = 'D' OR (fault NOT IN ('blank', 'duplicate') AND need IN ('', role[1:1]))
    GROUP BY p.conv_id, f.k, i.t
), lengths AS (
    SELECT conv_id, max(k) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
           count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faults GROUP BY conv_id
), ends AS (
    SELECT l.*, e.best FROM lengths l JOIN (SELECT conv_id, k, min(best) AS best FROM paths WHERE q IN (0, 3) GROUP BY conv_id, k) e
        ON e.k = l.n AND e.conv_id IS NOT DISTINCT FROM l.conv_id
)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost, coalesce(best.audit, '') AS audit,
       sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query
def op11_lexical_search(spark, sf_dir):
    return search(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))


ORACLES["op11_lexical_search"] = r"""
WITH words AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), held AS (
    SELECT r, doc_id, w, CAST(len(w) AS BIGINT) AS n FROM words WHERE len(w) > 0
), corpus AS (
    SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM held
), tfs AS (
    SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM held) GROUP BY r, term
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), weighed AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), corpus
), lengths AS (
    SELECT r, doc_id, 50 + (50 * n * docs) // terms AS m FROM held, corpus
), scores AS (
    SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
    FROM asked JOIN tfs USING (term) JOIN weighed USING (term) JOIN lengths USING (r) GROUP BY item_id, r, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) <= 50
"""
