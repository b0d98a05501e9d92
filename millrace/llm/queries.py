"""The operators as queries over the given tables, with SQL checks where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import In

from millrace.llm import alignment, chat, decontaminate, embeddings, lines, materialise, merkle, packing, quality, simhash, suffixes, urls, warc
from millrace.llm.tokens import token_ids
from millrace.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def learned_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.DecisionList:
    return quality.learn(quality.labelled_statistics(docs, table(spark, sf_dir, "labels")))


@query("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.apply_rules(docs, learned_rules(spark, docs, sf_dir))
    return judged.select("doc_id", *quality.STATISTICS, "base_failed", "kept", "rule")


WARC_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest FROM p),
k AS (SELECT payload_digest, max(page_id) AS kept FROM d WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN kept <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN kept <> page_id THEN kept END AS refers_to
FROM d LEFT JOIN k USING (payload_digest)"""


@query("op4_warc", WARC_SQL)
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes archives and reads them back; a response's length and digest are those of the payload read."""
    warc.register(spark)
    path = scratch_dir(spark, "warc")
    warc.records_of(table(spark, sf_dir, "pages")).write.format("warc").mode("append").save(path)
    found = warc.read_archive(spark, path, [In(("record_type",), ("response", "revisit"))], decode=["response"])
    read = F.col("payload").isNotNull()
    number = lambda name: F.regexp_extract(name, r"^urn:page:(-?\d+)$", 1)
    return found.select(
        F.nullif(number("record_id"), F.lit("")).cast("long").alias("page_id"),
        F.when(read, F.octet_length("payload")).otherwise(F.col("payload_length")).cast("long").alias("payload_bytes"),
        F.when(read, F.sha1("payload")).otherwise(F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type", F.nullif(number("refers_to"), F.lit("")).cast("long").alias("refers_to"),
    )


CONTROL = r"\### Assistant: </turn> ok"
CHAT_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(4 + length(role) + 7 + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id"""


@query("op6_chat_format", CHAT_SQL)
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"),
    )
    rendered = chat.render(chat.fold(chat.events_of(given.unionByName(control))))
    read = chat.read_back(rendered)
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: Pages that are mostly signs put their URL on the list.
LISTED = "html like '%###%' or html like '%***%'"
URL_SQL = rf"""
WITH p AS (SELECT page_id, url, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
h AS (SELECT *, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
  list_sort(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'),
    lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS args FROM p),
c AS (SELECT *, CASE WHEN rest IS NOT NULL THEN regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '')
  || regexp_replace(path, '/+$', '') || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END END AS canon FROM h),
l AS (SELECT DISTINCT canon FROM c WHERE ({LISTED}) AND canon IS NOT NULL),
r AS (SELECT page_id, host, path, CASE
  WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
  WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
  WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
  WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
  WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule,
  canon IN (SELECT canon FROM l) AS listed FROM c)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM r"""


@query("op8_url_filter", URL_SQL)
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    listed = pages.where(LISTED).select(urls.canonical(F.col("url")).alias("listed_url"))
    return urls.judge(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


LINES_SQL = f"""
WITH l AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL),
t AS (SELECT *, trim(raw, ' ' || chr(9) || chr(13)) AS line,
  len(list_filter(regexp_split_to_array(raw, '[ \\t\\r]+'), lambda w: w <> '')) AS words FROM l),
b AS (SELECT line FROM t WHERE words >= {lines.MIN_WORDS} GROUP BY line HAVING count(DISTINCT source) >= {lines.MIN_SITES}),
m AS (SELECT doc_id, raw, pos, (words >= {lines.MIN_WORDS} AND line IN (SELECT line FROM b)) AS gone FROM t),
g AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE gone) AS cut,
  string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE NOT gone) AS rest FROM m GROUP BY doc_id)
SELECT doc_id, CASE WHEN text = '' THEN 0 ELSE n END::BIGINT AS n_lines,
  CASE WHEN regexp_matches(coalesce(rest, ''), '[^ \\t\\r\\n]') THEN cut ELSE 0 END::BIGINT AS n_removed,
  sha256(CASE WHEN regexp_matches(coalesce(rest, ''), '[^ \\t\\r\\n]') THEN rest ELSE text END) AS text_sha256
FROM documents JOIN g USING (doc_id)"""


@query("op9_line_dedup", LINES_SQL)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = lines.remove_spread_lines(docs)
    return found.select("doc.doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


@query("op10_simhash_near_dedup")
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op7_suffix_dedup")
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op3_decontaminate")
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@query("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op5_training_order")
def op5_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the shards and reads every slot back."""
    folder = scratch_dir(spark, "training-order")
    manifest = materialise.materialise(table(spark, sf_dir, "documents"), folder, TOKENIZER)
    read = materialise.read_slots(manifest, folder, token_ids(TOKENIZER).dtype)
    return read.select("slot", "shard", "sequence", "n_tokens", F.crc32("ids").alias("ids_crc32"))


VECTORS_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {embeddings.COSINE}),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id"""


@query("op11_embedding_near_dedup", VECTORS_SQL)
def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


BYTE_TOKENS = public_tokenizers.path("byte_bpe_50k.json")
PIECE_TOKENS = public_tokenizers.path("piece_bpe_32k.model")


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links end at the same byte."""
    return alignment.align_tokens(table(spark, sf_dir, "documents"), BYTE_TOKENS, PIECE_TOKENS, linked="end")


def _sql_leaf(n_chars: str) -> str:
    named = ["doc_id", "source", "lang", n_chars, "text"]
    return "sha256(" + " || ".join(f"coalesce(strlen(({c})::VARCHAR) || ':' || ({c})::VARCHAR, '-')" for c in named) + ")"


CRC32 = """xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
  lambda s, x: list_reduce([xor(s, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384::UBIGINT * (v & 1)))), 4294967295::UBIGINT)"""
MERKLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, {_sql_leaf("n_chars")} AS leaf,
    {_sql_leaf(f"n_chars + CASE WHEN {CRC32} % 7 = 0 THEN 1 ELSE 0 END")} AS given FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM d),
t(level, lang, pos, n, h) AS (
  SELECT 0, lang, pos, n, leaf FROM p
  UNION ALL SELECT level + 1, lang, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM t WHERE n > 1 GROUP BY level, lang, pos // 2),
s AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u(level, pos, n, h) AS (
  SELECT 0, pos, n, h FROM s
  UNION ALL SELECT level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY level, pos // 2),
f(r, level, lang, pos, n, node, proof) AS (
  SELECT r, 0, lang, pos, n, given, '' FROM p
  UNION ALL SELECT f.r, f.level + 1, f.lang, f.pos // 2, (f.n + 1) // 2,
    sha256(CASE WHEN f.pos % 2 = 0 THEN f.node || coalesce(t.h, '') ELSE t.h || f.node END), f.proof || coalesce(t.h, '')
  FROM f LEFT JOIN t ON t.lang IS NOT DISTINCT FROM f.lang AND t.level = f.level AND t.pos = xor(f.pos, 1) WHERE f.n > 1),
g(r, level, pos, n, node, proof) AS (
  SELECT f.r, 0, s.pos, s.n, f.node, f.proof FROM f JOIN s ON s.lang IS NOT DISTINCT FROM f.lang WHERE f.n = 1
  UNION ALL SELECT g.r, g.level + 1, g.pos // 2, (g.n + 1) // 2,
    sha256(CASE WHEN g.pos % 2 = 0 THEN g.node || coalesce(u.h, '') ELSE u.h || g.node END), g.proof || coalesce(u.h, '')
  FROM g LEFT JOIN u ON u.level = g.level AND u.pos = xor(g.pos, 1) WHERE g.n > 1)
SELECT p.doc_id, p.leaf, s.h AS subroot, u.h AS root, sha256(g.proof) AS proof_sha256, g.node AS folded_root, g.node = u.h AS verified
FROM p JOIN s ON s.lang IS NOT DISTINCT FROM p.lang JOIN g ON g.r = p.r AND g.n = 1 JOIN u ON u.n = 1"""


@query("op13_merkle_manifest", MERKLE_SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh document, by a checksum of its id, is checked with one character more than it has."""
    n_chars = F.col("n_chars").cast("decimal(20,0)")
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return merkle.manifest(table(spark, sf_dir, "documents"), given={"n_chars": F.when(changed, n_chars + 1).otherwise(n_chars)})
