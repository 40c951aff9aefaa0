"""The registered queries of the operators, each over its whole table, beside their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import (
    audit, chat, decontaminate, mixing, packing, quality, sharding, simhash, substrings,
    token_records, trie, url_rules, warc)
from feedloom.session import cut_lineage, scratch_dir, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op10_quality_rules", r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
           FROM documents),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)),
                                 lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS win
      FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM d)),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (
        SELECT doc_id, unnest(generate_series(i, i + 7)) AS p
        FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS c FROM g) WHERE c > 1)
      GROUP BY doc_id),
f AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(len(lines) AS BIGINT) AS n_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
      FROM d JOIN l USING (doc_id) LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR n_symbols > n_words
            OR word_chars < 2 * n_words OR word_chars > 30 * n_words
            OR 100 * n_dup_lines > 60 * n_lines) AS kept
FROM f""")
def op10_quality_rules(spark, sf_dir):
    judged = quality.judge(table(spark, sf_dir, "documents"), with_facts=True)
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "kept")


@query("op7_chat_formatting")
def op7_chat_formatting(spark, sf_dir):
    hard = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(
        [(-1, 0, "user", hard), (-1, 1, "assistant", hard)], rows.schema))
    path = scratch_dir(spark, "chat")
    chat.format_conversations(rows).write.parquet(path)
    return chat.digests(chat.read_back(spark.read.parquet(path)))


@query("op4_source_mixing")
def op4_source_mixing(spark, sf_dir):
    sizes = cut_lineage(mixing.with_sizes(table(spark, sf_dir, "documents"))
                        .select("doc_id", "source", "size"))
    cells, shards = mixing.quotas(sizes)
    return mixing.mix(sizes, cells, shards).select(
        "doc_id", "size", "source_size", "target", "taken")


@query("op1_benchmark_decontamination", r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'),
                                      lambda x: x <> '') AS w FROM documents),
i AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'),
                                  lambda x: x <> '') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS s
       FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS k FROM d)),
s AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 4], ' ') AS s
      FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - 4)) AS k FROM i)),
n AS (SELECT item_id, count(*) AS n FROM s GROUP BY item_id)
SELECT doc_id, item_id, CAST(count(*) AS INT) AS n_shared, CAST(any_value(n) AS INT) AS n_shingles
FROM ds JOIN s USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id
HAVING count(*) >= ceil(0.8 * any_value(n))""")
def op1_benchmark_decontamination(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"),
                                      table(spark, sf_dir, "benchmark"))


URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


@query("op3_url_rules", r"""
WITH u AS (SELECT page_id, lower(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)) AS host,
                  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
           FROM pages),
r(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
               ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block'))
SELECT page_id, any_value(host) AS host, any_value(path) AS path,
       arg_max(h || p, length(h || p)) AS rule,
       coalesce(arg_max(v, length(h || p)), 'allow') AS verdict
FROM u LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
GROUP BY page_id""")
def op3_url_rules(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query("op2_sharding")
def op2_sharding(spark, sf_dir):
    docs = sharding.write_shards(table(spark, sf_dir, "documents"), scratch_dir(spark, "shards"))
    return docs.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                       "slot", F.lit(None).cast("int").alias("grown_shard"))


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@query("op6_token_records")
def op6_token_records(spark, sf_dir):
    folder = scratch_dir(spark, "tokens")
    manifest = token_records.write(table(spark, sf_dir, "documents"), folder, TOKENIZER)
    return token_records.read(manifest, folder)


@query("op9_warc", r"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM f""")
def op9_warc(spark, sf_dir):
    folder = scratch_dir(spark, "warc")
    index = warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(index, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op5_simhash")
def op5_simhash(spark, sf_dir):
    found = simhash.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        "component_id")


@query("op8_substring_dedup", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
           FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS win
      FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d)),
r AS (SELECT doc_id, i FROM (
        SELECT *, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS k FROM g) WHERE k > 1),
x AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (
        SELECT doc_id, unnest(generate_series(i, i + 19)) AS p FROM r) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN w ELSE
         list_filter(w, lambda v, i: NOT list_contains(gone, i)) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN x USING (doc_id)""")
def op8_substring_dedup(spark, sf_dir):
    found = substrings.dedupe(table(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s.length)
    return found.select("doc_id", "n_words", gone.alias("n_removed"),
                        F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_conversation_trie")
def op11_conversation_trie(spark, sf_dir):
    turns = trie.number_turns(table(spark, sf_dir, "conversations"))
    nodes, ends = trie.build(cut_lineage(trie.share_heads(cut_lineage(turns))))
    hashes = trie.hash_ends(ends)
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return nodes.join(hashes, list(trie.KEY), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("sha256", nothing).alias("ends_sha256"))


@query("op12_filter_audit", r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
           FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
      FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
              100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t),
              regexp_matches(t, '[#$%&*|]'),
              coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails
      FROM d LEFT JOIN l USING (doc_id)),
m AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good,
             count(*) FILTER (WHERE toxic) AS toxic
      FROM f GROUP BY part, fails),
i AS (SELECT unnest([1, 2, 3, 4, 5]) AS x),
o AS (SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM i a, i b, i c, i d, i e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT o, x AS step, o[x] AS own, o[1:x - 1] AS before FROM o, i),
r AS (SELECT part, o, step, own,
             sum(n) FILTER (WHERE NOT gone AND NOT fails[own]) AS kept,
             sum(n) FILTER (WHERE NOT gone AND fails[own]) AS removed,
             sum(n) FILTER (WHERE gone AND fails[own]) AS redundant,
             sum(n) FILTER (WHERE fails[own] AND n_fails = 1) AS unique_fails,
             sum(good) FILTER (WHERE NOT gone AND fails[own]) AS good_lost,
             sum(toxic) FILTER (WHERE NOT gone AND fails[own]) AS toxic_lost
      FROM (SELECT *, len(list_filter(before, lambda b: fails[b])) > 0 AS gone,
                   len(list_filter(fails, lambda b: b)) AS n_fails FROM m, s)
      GROUP BY part, o, step, own)
SELECT part, list_aggregate(list_transform(o, lambda k: chr(CAST(64 + k AS INT))), 'string_agg', '')
         AS filter_order, CAST(step AS INT) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
       CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
       CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
       CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r""")
def op12_filter_audit(spark, sf_dir):
    masks = audit.failures(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return audit.audit(audit.games(masks))


@query("op13_packing")
def op13_packing(spark, sf_dir):
    pieces = packing.tokenize(table(spark, sf_dir, "documents"), TOKENIZER)
    plan = packing.pack(pieces)
    return packing.digests(pieces).join(plan, "slot").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
