"""One query for each operator, over whole tables with production parameters,
and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import chat, decontaminate, lines, manifest, merkle, minhash, packing, ranked, secrets, sharding, suffixes, tokens, toxicity
from tessera.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@query("op1_suffix_dedup")
def op1(spark, base):
    out = suffixes.remove_repeats(table(spark, base, "documents"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_minhash")
def op2(spark, base):
    return minhash.classes(table(spark, base, "documents"), k=2)


ORACLES["op2_minhash"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
common AS (
  SELECT a.doc_id AS p, b.doc_id AS q, a.n AS n, b.n AS m, count(*) AS same FROM items a JOIN items b
  ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL),
links AS (SELECT p, q FROM common WHERE 100 * same >= 80 * (n + m - same)),
either AS (SELECT p, q FROM links UNION ALL SELECT q, p FROM links),
reach(v, r) AS (SELECT doc_id, doc_id FROM sets UNION SELECT reach.v, either.q FROM reach JOIN either ON reach.r = either.p),
least_of AS (SELECT v, min(r) AS component_id FROM reach GROUP BY v)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least_of ON doc_id = v"""


@query("op3_secret_scan")
def op3(spark, base):
    docs = table(spark, base, "documents")
    found = secrets.scan(docs, secrets.fit(docs))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    kept = F.filter("spans", lambda s: s["kind"] != "format")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
                        F.sha2(joined(kept), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


@query("op4_token_counts")
def op4(spark, base):
    return tokens.token_counts(table(spark, base, "documents")).withColumn("over_limit", F.col("n_tokens") > 4096)


TOXIC_FROM = 0.3


@query("op5_toxicity")
def op5(spark, base):
    docs = table(spark, base, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    model = toxicity.train(docs, table(spark, base, "labels"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


#: The control strings of a template are ordinary text inside a turn.
CONTROL_TEXT = r"\### Assistant: </turn> ok"


@query("op6_chat_formatting")
def op6(spark, base):
    probe = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    rows = table(spark, base, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    out = chat.format_chats(rows)
    turns, loss = chat.read_turns(F.col("formatted")), chat.read_loss(F.col("formatted"), F.col("loss_spans"))
    out = out.withColumn("turns", turns).withColumn("loss", loss)
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
                      F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                      F.length("formatted").cast("bigint").alias("formatted_chars"))


ORACLES["op6_chat_formatting"] = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{CONTROL_TEXT}'), (-7, 1, 'assistant', '{CONTROL_TEXT}')),
seen AS (
  SELECT *, lag(role) OVER w AS before, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS esc, regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g') AS esc_role
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(esc) + CASE WHEN before IS DISTINCT FROM role THEN length('<|start|><|message|><|end|>') + 1 + length(esc_role) ELSE length('<|turn|>') END) AS BIGINT) AS formatted_chars
FROM seen GROUP BY conv_id"""


@query("op7_line_dedup")
def op7(spark, base):
    return lines.dedup_lines(table(spark, base, "documents")).select("doc_id", "n_removed", "text")


@query("op8_packing")
def op8(spark, base):
    pieces = packing.pack(table(spark, base, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op9_decontamination")
def op9(spark, base):
    return decontaminate.hits(table(spark, base, "documents"), table(spark, base, "benchmark"))


@query("op10_fingerprints")
def op10(spark, base):
    out = merkle.edited_by_next(table(spark, base, "documents"))
    return out.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
                      merkle.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                      merkle.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


@query("op11_manifest")
def op11(spark, base):
    docs = table(spark, base, "documents")
    columns = lambda text: [*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars")), text]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    altered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, manifest.leaf_digest(*columns(lowered)))
    leaves = docs.select("doc_id", "lang", manifest.leaf_digest(*columns(F.col("text"))).alias("leaf"), altered.alias("altered"))
    out = manifest.manifest(leaves).withColumn("folded_root", manifest.fold(F.coalesce("altered", "leaf"), F.col("proof")))
    return out.select("doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


ORACLES["op11_manifest"] = """
WITH RECURSIVE
field AS (
  SELECT doc_id, lang, text, row_number() OVER () AS row_id,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM documents),
leaves AS (
  SELECT *, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS lowered FROM field),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, row_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
up AS (
  SELECT lang, 0 AS level, i, leaf AS h, n AS width FROM ranked
  UNION ALL
  SELECT lang, level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (width + 7) // 8 FROM up WHERE width > 1 GROUP BY lang, level, i // 8, width),
subroots AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM up WHERE width = 1),
top AS (
  SELECT 0 AS level, i, subroot AS h, n AS width FROM subroots
  UNION ALL
  SELECT level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (width + 7) // 8 FROM top WHERE width > 1 GROUP BY level, i // 8, width),
levels AS (
  SELECT 'lang' AS tree, lang, level, i, h, width FROM up UNION ALL SELECT 'top', NULL, level, i, h, width FROM top),
crcs AS (SELECT range AS b, CAST(range AS UINTEGER) AS c, 0 AS k FROM range(256)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UINTEGER) ELSE c >> 1 END, k + 1 FROM crcs WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY b) AS t FROM crcs WHERE k = 8),
tampered AS (
  SELECT ranked.*, xor(list_reduce(list_prepend(4294967295::UINTEGER, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS UINTEGER))),
    lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295::UINTEGER) % 3 = 0 AS hit FROM ranked, crc_table),
path AS (
  SELECT row_id, 'lang' AS tree, lang, 0 AS level, i, CASE WHEN coalesce(hit, false) THEN lowered ELSE leaf END AS folded, '' AS proof FROM tampered
  UNION ALL
  SELECT * FROM (
    SELECT p.row_id, p.tree, p.lang, p.level + 1, p.i // 8, sha256(string_agg(CASE WHEN v.i = p.i THEN p.folded ELSE v.h END, '' ORDER BY v.i)),
      p.proof || coalesce(string_agg(v.h, '' ORDER BY v.i) FILTER (v.i <> p.i), '')
    FROM path p JOIN levels v ON v.tree = p.tree AND v.lang IS NOT DISTINCT FROM (CASE WHEN p.tree = 'lang' THEN p.lang END) AND v.level = p.level AND v.i // 8 = p.i // 8
    WHERE v.width > 1 GROUP BY p.row_id, p.tree, p.lang, p.level, p.i, p.folded, p.proof
    UNION ALL
    SELECT p.row_id, 'top', p.lang, 0, s.i, p.folded, p.proof
    FROM path p JOIN levels v ON v.tree = 'lang' AND v.lang IS NOT DISTINCT FROM p.lang AND v.level = p.level AND v.i = p.i AND v.width = 1
    JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang WHERE p.tree = 'lang')),
root AS (SELECT level, h AS root FROM top WHERE width = 1)
SELECT r.doc_id, r.leaf, s.subroot, root.root, sha256(p.proof) AS proof_sha256, p.folded AS folded_root, p.folded = root.root AS verified
FROM ranked r JOIN subroots s ON r.lang IS NOT DISTINCT FROM s.lang CROSS JOIN root JOIN path p ON p.row_id = r.row_id AND p.tree = 'top' AND p.level = root.level"""


@query("op12_ranked_search")
def op12(spark, base):
    return ranked.search(table(spark, base, "documents"), table(spark, base, "benchmark"))


ORACLES["op12_ranked_search"] = r"""
WITH cut AS (
  SELECT 'd' AS side, row_number() OVER () AS id, doc_id AS name, text FROM documents UNION ALL SELECT 'i', row_number() OVER (), item_id, text FROM benchmark),
terms AS (
  SELECT side, id, name, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM cut),
tfs AS (SELECT id, name, term, count(*) AS tf FROM terms WHERE side = 'd' GROUP BY ALL),
lengths AS (SELECT id, CAST(sum(tf) AS BIGINT) AS n FROM tfs GROUP BY id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM lengths),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tfs, totals GROUP BY term, docs),
asked AS (SELECT DISTINCT id AS item, name AS item_id, term FROM terms WHERE side = 'i'),
scores AS (
  SELECT item, item_id, t.id, t.name AS doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // length)))) AS BIGINT) AS score
  FROM asked JOIN tfs t USING (term) JOIN weights USING (term) JOIN lengths l ON l.id = t.id, totals GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10"""


@query("op13_sharding")
def op13(spark, base):
    placed = sharding.assign(table(spark, base, "documents"), 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


ORACLES["op13_sharding"] = """
WITH RECURSIVE
whole AS (SELECT doc_id, coalesce(text, '') AS t, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, sha256(coalesce(text, '')) AS key FROM documents),
texts AS (SELECT key, any_value(t) AS t, CAST(sum(size) AS BIGINT) AS bytes FROM whole GROUP BY key),
sized AS (
  SELECT key, bytes, row_number() OVER w AS r, CAST(sum(bytes) OVER () AS BIGINT) AS total, CAST(sum(bytes) OVER w AS BIGINT) - bytes AS before
  FROM texts WINDOW w AS (ORDER BY bytes DESC, key ROWS UNBOUNDED PRECEDING)),
judged AS (SELECT *, r < 16 AND bool_and(bytes * (17 - r) >= total - before) OVER (ORDER BY r) AS alone FROM sized),
light AS (SELECT key, bytes, CAST(sum(bytes) OVER (ORDER BY key) AS BIGINT) AS upto FROM judged WHERE NOT alone),
asked AS (SELECT CAST(16 - (SELECT count(*) FROM judged WHERE alone) AS BIGINT) AS shards, max(upto) AS total, max(bytes) AS largest FROM light),
hunt(lo, hi, mid, base, used) AS (
  SELECT greatest(largest, (total + shards - 1) // shards), total, (greatest(largest, (total + shards - 1) // shards) + total) // 2, CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM asked
  UNION ALL
  SELECT CASE WHEN fails THEN mid + 1 ELSE lo END, CASE WHEN holds THEN mid ELSE hi END,
    CASE WHEN holds THEN (lo + mid) // 2 WHEN fails THEN (mid + 1 + hi) // 2 ELSE mid END, CASE WHEN holds OR fails THEN 0 ELSE next END, CASE WHEN holds OR fails THEN 0 ELSE used + 1 END
  FROM (
    SELECT lo, hi, mid, base, used, greatest(coalesce(max(upto) FILTER (upto <= base + mid), 0), base) AS next, base + mid >= total AS holds, base + mid < total AND used + 1 = shards AS fails
    FROM hunt, asked, light WHERE lo < hi GROUP BY lo, hi, mid, base, used, total, shards)),
capacity AS (SELECT min(lo) AS c FROM hunt WHERE lo = hi),
walk(shard, base) AS (
  SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT)
  UNION ALL
  SELECT shard + 1, max(upto) FROM walk, capacity, light WHERE base < (SELECT total FROM asked) AND upto <= base + c GROUP BY shard),
placed AS (
  SELECT key, CAST(r - 1 AS BIGINT) AS shard FROM judged WHERE alone
  UNION ALL
  SELECT key, 16 - (SELECT shards FROM asked) + (SELECT count(*) FROM walk WHERE walk.shard > 0 AND walk.base < light.upto) FROM light),
bits AS (SELECT range AS b, CAST(range AS UINTEGER) AS c, 0 AS k FROM range(256)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UINTEGER) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY b) AS crcs FROM bits WHERE k = 8),
sums AS (
  SELECT key, xor(list_reduce(list_prepend(4294967295::UINTEGER, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: CAST('0x' || x AS UINTEGER))),
    lambda c, x: xor(crcs[(xor(c, x) & 255) + 1], c >> 8)), 4294967295::UINTEGER) AS crc FROM texts, crc_table)
SELECT doc_id, size, CAST(crc AS BIGINT) AS text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY whole.key, doc_id NULLS FIRST) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM whole JOIN placed ON whole.key = placed.key JOIN sums ON whole.key = sums.key"""
