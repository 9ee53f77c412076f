"""The operators bound to the driver's tables: thin queries, and SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.llm import (
    byte_cnn, conversation_repair, decontaminate, doubling_dedup, filter_audit, nb_char, packing, quality_rules, secret_scan,
    simhash_dedup, source_mixing, suffix_dedup, wavelet_ids,
)
from panelloom.session import new_path


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("doc_id", "text")))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality_rules.quality_report(documents(spark, sf_dir))
    return report.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("failed_rules", ",").alias("failed_rules"),
    )


_W = r"[^\x20\x09-\x0D]+"
OP1_SQL = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_W}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_W}')) AS l
  FROM documents
), g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t WHERE len(w) >= 3)
), r AS (
  SELECT doc_id, count(DISTINCT i + d) AS n_repeat_words FROM g, (VALUES (0), (1), (2)) AS v(d) WHERE c > 1 GROUP BY 1
), m AS (
  SELECT t.doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines,
         len(list_filter(w, lambda x: lower(x) IN ({", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)}))) AS n_stop
  FROM t LEFT JOIN r USING (doc_id)
), v AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         concat_ws(',',
           CASE WHEN n_words = 0 OR word_chars / n_words < 3 OR word_chars / n_words > 12 THEN 'word_length' END,
           CASE WHEN n_words > 0 AND n_symbols / n_words > 0.1::DOUBLE THEN 'symbols' END,
           CASE WHEN n_words = 0 OR n_stop / n_words < 0.06::DOUBLE THEN 'stop_words' END,
           CASE WHEN n_lines > 0 AND n_dup_lines / n_lines > 0.4::DOUBLE THEN 'repeated_lines' END,
           CASE WHEN n_lines > 0 AND n_words / n_lines > 5000 THEN 'words_per_line' END) AS failed_rules
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM v
"""


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer file; the same on every machine that has the files."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"), end_id=1)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(secret_scan.BASE)],
        F.sha2(secret_scan.spans_text("base"), 256).alias("base_sha256"),
        secret_scan.spans_text("spans").alias("spans"),
    )


def op4_wavelet_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-ids")
    wavelet_ids.write_token_shards(documents(spark, sf_dir), path, tokenizer_file("word_bpe_49k.json"), end_id=2)
    return wavelet_ids.read_documents(spark, path, with_ids=False)


def op5_doubling_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = doubling_dedup.remove_repeats(documents(spark, sf_dir))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = decontaminate.contamination(documents(spark, sf_dir), items)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.components(documents(spark, sf_dir), width=3, radius=2).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op9_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_cnn.languages(documents(spark, sf_dir, "doc_id", "text", "lang"))


def op10_nb_char_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return nb_char.toxicity(documents(spark, sf_dir), labels)


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_packing": op2_packing,
    "op3_secret_scan": op3_secret_scan,
    "op4_wavelet_ids": op4_wavelet_ids,
    "op5_doubling_dedup": op5_doubling_dedup,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_suffix_automaton": op7_suffix_automaton,
    "op8_covering_simhash": op8_covering_simhash,
    "op9_byte_cnn": op9_byte_cnn,
    "op10_nb_char_ngrams": op10_nb_char_ngrams,
}
OP5_SQL = rf"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_W}') AS w FROM documents),
d AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM t),
g AS (
  SELECT doc_id, pos, string_agg(word, ' ') OVER f AS grams, count(*) OVER f AS n
  FROM d WINDOW f AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)
),
s AS (SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY grams) < doc_id AS again FROM g WHERE n = 13),
r AS (SELECT DISTINCT doc_id, pos + o AS pos FROM s, (SELECT unnest(range(13)) AS o) WHERE again),
k AS (
  SELECT d.doc_id, count(*) FILTER (r.pos IS NOT NULL) AS n_removed,
         string_agg(word, ' ' ORDER BY d.pos) FILTER (r.pos IS NULL) AS kept
  FROM d LEFT JOIN r USING (doc_id, pos) GROUP BY 1
)
SELECT t.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN k USING (doc_id)
"""

_CUT = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
OP7_SQL = f"""
WITH t AS (SELECT doc_id, {_CUT} AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), 10) AS size FROM (SELECT item_id, {_CUT} AS w FROM benchmark) WHERE len(w) > 0),
i AS (
  SELECT DISTINCT item_id, size, array_to_string(w[p:p + size - 1], ' ') AS grams
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS p FROM b)
),
g AS (
  SELECT doc_id, p, size, array_to_string(w[p:p + size - 1], ' ') AS grams
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS p FROM t, (SELECT DISTINCT size FROM b) WHERE len(w) >= size)
),
h AS (SELECT doc_id, p, size, item_id FROM g JOIN i USING (size, grams)),
c AS (SELECT doc_id, count(DISTINCT p + o) AS n_hit FROM (SELECT *, unnest(range(size)) AS o FROM h) GROUP BY 1),
n AS (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h WHERE item_id IS NOT NULL),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM n GROUP BY 1)
SELECT t.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM t LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)
"""

ORACLES = {"op1_quality_rules": OP1_SQL, "op5_doubling_dedup": OP5_SQL, "op7_suffix_automaton": OP7_SQL}

# The operators below came later; their queries and SQL stand together.


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return conversation_repair.repair_report(conversation_repair.damaged(turns))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return filter_audit.audit(documents(spark, sf_dir, "doc_id", "text", "lang"), labels)


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = source_mixing.mix_plan(documents(spark, sf_dir, "doc_id", "text", "source"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


QUERIES |= {
    "op11_conversation_repair": op11_conversation_repair,
    "op12_filter_audit": op12_filter_audit,
    "op13_source_mixing": op13_source_mixing,
}

#: A dynamic program over (cost, edits) as one text, a row a step, in place of the auction. CRC-32 bit by bit.
OP11_SQL = r"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations
),
c AS (
  SELECT *, xor(list_reduce(
    list_concat([4294967295::BIGINT], flatten(list_transform(range(1, len(key) + 1), lambda i: [ord(key[i])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
  ), 4294967295) % 20 AS kind
  FROM k
),
e AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END)
  FROM c
),
n AS (
  SELECT conv_id, turn, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(len(role) || ':' || role || text)) AS i,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM e
),
r AS (
  SELECT *, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE '-' END AS initial,
         CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         left(lag(role) OVER o, 1) || left(role, 1) NOT IN ('su', 'ua', 'au') AS broken
  FROM n WINDOW o AS (PARTITION BY conv_id ORDER BY i)
),
-- States: n nothing, s system, u user, a assistant. Up to two turns put in, then an edit of the row.
ins(q, put, price, q1) AS (VALUES
  ('n', '', 0, 'n'), ('n', 'I', 5, 'u'), ('n', 'II', 10, 'a'), ('s', '', 0, 's'), ('s', 'I', 5, 'u'), ('s', 'II', 10, 'a'),
  ('u', '', 0, 'u'), ('u', 'I', 5, 'a'), ('u', 'II', 10, 'u'), ('a', '', 0, 'a'), ('a', 'I', 5, 'u'), ('a', 'II', 10, 'a')),
edit(q1, initial, edit, cost, q2) AS (
  SELECT q1, initial, 'D', 2, q1 FROM (VALUES ('n'), ('s'), ('u'), ('a')) AS x(q1), (VALUES ('s'), ('u'), ('a'), ('-')) AS y(initial)
  UNION ALL SELECT q1, initial, 'R', 1, q2 FROM (VALUES ('n', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')) AS x(q1, q2), (VALUES ('s'), ('u'), ('a'), ('-')) AS y(initial)
  UNION ALL SELECT * FROM (VALUES ('n', 's', 'K', 0, 's'), ('n', 'u', 'K', 0, 'u'), ('s', 'u', 'K', 0, 'u'), ('u', 'a', 'K', 0, 'a'), ('a', 'u', 'K', 0, 'u'))
),
dp AS (
  SELECT conv_id, 0::BIGINT AS i, 'n' AS q, '000000000' AS best FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT d.conv_id, d.i + 1, t.q2, min(lpad((left(d.best, 9)::BIGINT + x.price + t.cost + CASE WHEN t.edit <> 'D' AND r.fault = 'truncated' THEN 5 ELSE 0 END)::VARCHAR, 9, '0')
                                     || substr(d.best, 10) || x.put || t.edit)
  FROM dp d JOIN r ON r.conv_id IS NOT DISTINCT FROM d.conv_id AND r.i = d.i + 1
       JOIN ins x ON x.q = d.q JOIN edit t ON t.q1 = x.q1 AND t.initial = r.initial AND (t.edit = 'D' OR r.fault NOT IN ('blank', 'duplicate'))
  GROUP BY d.conv_id, d.i + 1, t.q2
),
z AS (
  SELECT conv_id, min(lpad((left(best, 9)::BIGINT + x.price)::VARCHAR, 9, '0') || substr(best, 10) || x.put) AS best
  FROM (SELECT *, max(i) OVER (PARTITION BY conv_id) AS n FROM dp) d JOIN ins x ON x.q = d.q AND x.q1 IN ('n', 'a')
  WHERE i = n GROUP BY conv_id
),
s AS (SELECT conv_id, substr(best, 10) AS audit, unnest(string_split(substr(best, 10), '')) AS ch, generate_subscripts(string_split(substr(best, 10), ''), 1) AS p FROM z),
g AS (
  SELECT s.*, sum((ch <> 'I')::INT) OVER o AS i, sum((ch <> 'D')::INT) OVER o AS out
  FROM s WINDOW o AS (PARTITION BY conv_id ORDER BY p)
),
h AS (
  SELECT g.conv_id, p, ch, out, r.role, r.text, max((ch = 'K' AND out = 1 AND left(r.role, 1) = 's')::INT) OVER (PARTITION BY g.conv_id) AS shift
  FROM g LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM g.conv_id AND r.i = g.i AND ch <> 'I' WHERE ch <> 'D' AND ch <> ''
),
j AS (
  SELECT conv_id, string_agg(CASE WHEN ch = 'K' THEN role WHEN (out - shift) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY p) AS lines
  FROM h GROUP BY 1
),
f AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (broken) AS illegal
  FROM r GROUP BY 1
)
SELECT z.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, left(z.best, 9)::BIGINT AS cost,
       substr(z.best, 10) AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM z LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM z.conv_id LEFT JOIN j ON j.conv_id IS NOT DISTINCT FROM z.conv_id
"""

OP12_SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{_W}') AS w, min(doc_id) OVER (PARTITION BY text) AS least FROM t),
m AS (
  SELECT doc_id, part,
         (len(w) < 200)::INT AS "A", (100 * len(list_distinct(w)) < 50 * len(w))::INT AS "B",
         (100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * len(text))::INT AS "C",
         regexp_matches(text, '[#$%&*|]')::INT AS "D", coalesce(least < doc_id, false)::INT AS "E"
  FROM w
),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1),
c AS (
  SELECT part, "A" + 2 * "B" + 4 * "C" + 8 * "D" + 16 * "E" AS mask, count(*) AS n,
         sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY ALL
),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
  SELECT [a, b, c, d, e] AS fs, a || b || c || d || e AS filter_order
  FROM (SELECT f AS a FROM f), (SELECT f AS b FROM f), (SELECT f AS c FROM f), (SELECT f AS d FROM f), (SELECT f AS e FROM f)
  WHERE len(list_distinct([a, b, c, d, e])) = 5
),
s AS (
  SELECT filter_order, step, f, bit,
         coalesce(sum(bit) OVER (PARTITION BY filter_order ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS before
  FROM (SELECT filter_order, unnest(fs) AS f, generate_subscripts(fs, 1) AS step FROM o) JOIN f USING (f)
),
x AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM x
"""

OP13_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_W}'))::BIGINT AS size,
         ('0x' || substr(md5(concat_ws(':', '{source_mixing.SEED}', coalesce(doc_id::VARCHAR, ''), coalesce(text, ''))), 1, 13))::BIGINT
           / 4503599627370496::DOUBLE AS coin
  FROM documents
),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
w AS (SELECT *, [1.0, 5.0, 2.0][row_number() OVER (ORDER BY source NULLS LAST) % 3 + 1]::DOUBLE AS weight FROM s),
-- Sources reach their limit in this order, so the ones that stop come first.
p AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER () - 2 * coalesce(sum(source_size) OVER b, 0)::DOUBLE AS rest,
         sum(weight) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM w WINDOW b AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
k AS (SELECT rest, share FROM p WHERE weight * rest / share <= 2 * source_size ORDER BY 2 * source_size / weight, source NULLS LAST LIMIT 1),
t AS (
  SELECT source, source_size, least(coalesce(weight * k.rest / k.share, 2 * source_size), 2 * source_size)::DOUBLE AS target,
         CASE WHEN source_size > 0 THEN least(coalesce(weight * k.rest / k.share, 2 * source_size), 2 * source_size) / source_size ELSE 0 END AS rate
  FROM w LEFT JOIN k ON true
)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + (coin < rate - floor(rate))::INT))::BIGINT AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
"""
ORACLES |= {"op11_conversation_repair": OP11_SQL, "op12_filter_audit": OP12_SQL, "op13_source_mixing": OP13_SQL}
