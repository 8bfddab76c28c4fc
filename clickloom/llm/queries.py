"""Registered queries of the operators, over whole tables of the given folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.llm import bpe, chat, decontaminate, langid, licenses, manifest, neardup, pii, quality, suffixes, tokens, toxicity, whitening

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TOKEN_LIMIT = 1024


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def sql(name: str, text: str) -> None:
    ORACLES[name] = text


@query
def op1_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    says = "</s>[INST] ok [/INST]"
    given = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(1).select(
        F.explode(F.array(*[F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(says).alias("text")) for i, role in enumerate(("user", "assistant"))])).alias("r")
    ).select("r.*")
    read = chat.read_chats(chat.format_chats(given.unionByName(extra)))
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


_ESC = "x"
for _c in [chat.CHATML.escape, *chat.CHATML.controls]:
    _put = _c + "0" if _c == chat.CHATML.escape else _c[0] + chat.CHATML.escape + "1" + _c[1:]
    _ESC = f"replace({_ESC}, '{_c}', '{_put}')"
_RULES = ", ".join(f"('{a}', '{b}')" for a, bs in chat.CHATML.transitions.items() for b in bs)
sql(
    "op1_chat_format",
    f"""
WITH t AS (
 SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
o AS (SELECT *, coalesce(lag(role) OVER w, '') AS before, row_number() OVER w AS i,
  length({_ESC.replace("x", "text", 1)}) AS chars FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
 sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
 CAST(length(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS BIGINT) AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
 CAST(sum(length('{chat.CHATML.begin}') + length(role) + 1 + chars + length('{chat.CHATML.end_mark}') + 1) AS BIGINT) AS formatted_chars,
 bool_and((before, role) IN ({_RULES})) AND arg_max(role, i) = 'assistant' AS valid
FROM o GROUP BY conv_id""",
)


@query
def op2_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    counted = tokens.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


@query
def op4_bpe_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.encode_and_decode(docs, path, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op8_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.find_items(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark").select("item_id", "text"))


_GRAMS = """SELECT DISTINCT {id}, array_to_string(w[i : i + 4], ' ') AS gram FROM (
  SELECT {id}, w, unnest(range(1, len(w) - 3)) AS i FROM (
   SELECT {id}, list_filter(string_split_regex(text, '[ \\t-\\r]+'), lambda x: x <> '') AS w FROM {table} WHERE text IS NOT NULL))"""
sql(
    "op8_decontaminate",
    f"""
WITH b AS ({_GRAMS.format(id="item_id", table="benchmark")}), d AS ({_GRAMS.format(id="doc_id", table="documents")}),
 n AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY 1)
SELECT doc_id, item_id, n_shingles, n_found, n_found / n_shingles AS containment
FROM (SELECT doc_id, item_id, count(*) AS n_found FROM d JOIN b USING (gram) GROUP BY ALL) JOIN n USING (item_id)
WHERE 10 * n_found >= 8 * n_shingles""",
)


@query
def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality.judge_quality(table(spark, sf, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior", "votes")


@query
def op7_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf, "documents").select("doc_id", "text"))


@query
def op10_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    left = suffixes.remove_repeats(table(spark, sf, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op6_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    part = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    filters = langid.train(docs.where(~part).select("text", "lang"))
    return langid.identify(docs.select("doc_id", "text", part.alias("held_out")), filters).drop("text")


def _joined(spans) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query
def op3_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = pii.find_pii(docs, pii.train(docs)).drop("text").withColumn("base", F.filter("spans", lambda s: s["base"]))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


@query
def op5_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    scanned = licenses.scan_licenses(table(spark, sf, "documents").select("doc_id", "text"))

    def count(verdict: str) -> Column:
        return F.size(F.filter("licenses", lambda x: x["verdict"] == verdict)).cast("long")

    names = F.array_sort(F.array_distinct(F.filter(F.transform("licenses", lambda x: x["license"]), lambda x: x.isNotNull())))
    spans = F.transform("licenses", lambda x: F.concat_ws(":", x["verdict"], F.coalesce(x["license"], F.lit("")), x["start"].cast("string"), x["end"].cast("string")))
    return scanned.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_blocks"),
        count("exact").alias("n_exact"),
        count("modified").alias("n_modified"),
        F.array_join(names, ",").alias("licenses"),
        F.array_join(spans, ",").alias("spans"),
    )


@query
def op11_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    return manifest.manifest(docs).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "pos")


_FIELDS = " || ".join(f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}"))
_CRC_STEP = "CASE WHEN {c} & 1 = 1 THEN xor({c} >> 1, 3988292384) ELSE {c} >> 1 END"
sql(
    "op11_merkle_manifest",
    f"""
WITH RECURSIVE crc(i, k, c) AS (
 SELECT i, 0, CAST(i AS BIGINT) FROM range(256) t(i) UNION ALL SELECT i, k + 1, {_CRC_STEP.format(c="c")} FROM crc WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS cells FROM crc WHERE k = 8),
leaves AS (
 SELECT doc_id, source, sha256({_FIELDS.format(text="text")}) AS leaf, sha256({_FIELDS.format(text="replace(text, chr(10), '')")}) AS broken,
  xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
   lambda a, x: xor(a >> 8, cells[(xor(a, x) & 255) + 1])), 4294967295) AS crc
 FROM documents, crc_table),
placed AS (
 SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
  dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree FROM leaves),
nodes(tree, level, pos, h, n) AS (
 SELECT tree, 0, pos, leaf, count(*) OVER (PARTITION BY tree) FROM placed
 UNION ALL
 SELECT tree, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 2) // 3 FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 3),
subroots AS (SELECT tree, h AS subroot FROM nodes WHERE n = 1),
tops(level, pos, h, n) AS (
 SELECT 0, tree, subroot, (SELECT count(*) FROM subroots) FROM subroots
 UNION ALL
 SELECT level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 2) // 3 FROM tops WHERE n > 1 GROUP BY level, pos // 3),
sides AS (
 SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
  coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
 FROM (SELECT * FROM nodes UNION ALL SELECT NULL, * FROM tops) a
 JOIN (SELECT * FROM nodes UNION ALL SELECT NULL, * FROM tops) b
  ON a.tree IS NOT DISTINCT FROM b.tree AND a.level = b.level AND a.pos // 3 = b.pos // 3
 WHERE a.n > 1 GROUP BY a.tree, a.level, a.pos),
steps AS (
 SELECT p.tree, p.pos, s.level AS step, l, r FROM placed p JOIN sides s ON s.tree = p.tree AND s.pos = p.pos // CAST(power(3, s.level) AS BIGINT)
 UNION ALL
 SELECT p.tree, p.pos, 1000 + s.level, l, r FROM placed p JOIN sides s ON s.tree IS NULL AND s.pos = p.tree // CAST(power(3, s.level) AS BIGINT)),
proofs AS (SELECT tree, pos, string_agg(l || r, '' ORDER BY step) AS siblings, list([l, r] ORDER BY step) AS way FROM steps GROUP BY tree, pos),
folded AS (
 SELECT p.doc_id, p.leaf, subroot, (SELECT h FROM tops WHERE n = 1) AS root, sha256(coalesce(siblings, '')) AS proof_sha256, p.pos,
  list_reduce([[CASE WHEN crc % 2 = 0 THEN coalesce(broken, leaf) ELSE leaf END]] || coalesce(way, []), lambda a, x: [sha256(x[1] || a[1] || x[2])])[1] AS folded_root
 FROM placed p JOIN subroots s USING (tree) LEFT JOIN proofs w ON w.tree = p.tree AND w.pos = p.pos)
SELECT *, folded_root = root AS verified FROM folded""",
)


@query
def op12_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(table(spark, sf, "embeddings").select("vec_id", "embedding"))


@query
def op13_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    labels = table(spark, sf, "labels").select("doc_id", "toxic").where(~held_out)
    tagged = toxicity.tag(docs.withColumn("held_out", held_out), toxicity.train(docs, labels))
    return tagged.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("spans").alias("n_spans"), "spans")
