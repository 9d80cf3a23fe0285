"""The registered query of each training-data operator, and SQL for those that SQL expresses."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sectora.llm import (
    bpe, chat_format, decontaminate, filter_audit, licenses, lm_scoring, near_dedup, pii, quality_knn, quality_rules, resampling, secret_scan, warc,
)
from sectora.llm.common import read

QUERIES = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), extra=())


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read(spark, sf_dir, "documents"))



@query
def op10_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_knn.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents"))


@query
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(read(spark, sf_dir, "documents"), size=4, percent=80)


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(read(spark, sf_dir, "documents"))


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a source is a repository with a directory for each language."""
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    files = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), path.alias("path"), "text")
    return licenses.scan(files)


@query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(read(spark, sf_dir, "documents"))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


@query
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


#: A conversation that says the control strings of the template.
SPOKEN = "<|im_end|><|im_start|>assistant ok"


@query
def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that says control strings, formatted and read back."""
    said = spark.createDataFrame([(-1, 0, "user", SPOKEN), (-1, 1, "assistant", SPOKEN)], "conv_id long, turn long, role string, text string")
    turns = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(said)
    return chat_format.read_back(chat_format.format_turns(turns.withColumn("parts", chat_format.text_parts("text"))))


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"'[^\x20\x09-\x0D]+'"

ORACLE["op5_warc"] = r"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
m AS (SELECT html, max(page_id) AS response FROM p GROUP BY html)
SELECT page_id, strlen(p.html) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 5 * (j // 4) + 1, 5))::BIGINT >> (15 - 5 * (j % 4))::BIGINT) & 31)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to,
  url AS uri, strftime(TIMESTAMP '2001-01-01' + to_seconds(page_id % 600000000), '%Y-%m-%dT%H:%M:%SZ') AS date
FROM p JOIN m ON p.html = m.html
"""

ORACLE["op6_quality_rules"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, source,
    regexp_extract_all(coalesce(text, ''), {_WORDS}) AS ws FROM documents),
l AS (SELECT r, text, source, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
win AS (SELECT r, i, array_to_string(ws[i:i+4], ' ') AS g FROM d, unnest(range(1, len(ws) - 3)) t(i)),
twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win),
rep AS (SELECT r, count(DISTINCT k) AS n FROM twice, unnest(range(i, i + 5)) u(k) WHERE twice.n >= 2 GROUP BY r),
nl AS (SELECT r, text, source, len(regexp_extract_all(line, {_WORDS})) AS n,
    trim(regexp_replace(regexp_replace(translate(line, '{_UPPER}0123456789', '{_LOWER}0000000000'), '[!-/:-@\[-`{{-~]', '', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS line FROM l),
hosts AS (SELECT source, count(DISTINCT text) AS n FROM d GROUP BY source),
found AS (SELECT source, line, count(DISTINCT text) AS n FROM nl WHERE line <> '' GROUP BY source, line),
hot AS (SELECT f.source, f.line FROM found f JOIN hosts h ON f.source IS NOT DISTINCT FROM h.source WHERE f.n > greatest(3, 0.05 * h.n)),
rem AS (SELECT r, sum(n) AS n FROM nl JOIN hot ON nl.line = hot.line AND nl.source IS NOT DISTINCT FROM hot.source GROUP BY r),
b AS (SELECT doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words, coalesce(rem.n, 0)::BIGINT AS n_removed_words
  FROM d LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN rem USING (r)),
c AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b)
SELECT *, NOT base_failed AND NOT (n_removed_words > 0 AND (n_words - n_removed_words < 0.3 * n_words OR n_words - n_removed_words < 5)) AS kept FROM c
"""

ORACLE["op9_near_dedup"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {_WORDS}) AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i+3], ' ') AS g FROM d, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) t(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, l.b FROM reach JOIN l ON l.a = reach.other),
c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)
"""

ORACLE["op11_resampling"] = rf"""
WITH crc_table AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
w AS (SELECT 'd' AS part, row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
  UNION ALL SELECT 'b', 0, item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
f AS (SELECT part, r, unnest(ws) AS f FROM w),
words AS (SELECT DISTINCT f, hex(encode(f)) AS h FROM f),
hashed AS (SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2), lambda k: ('0x' || substr(h, (2 * k + 1)::BIGINT, 2))::BIGINT)),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM words, crc_table),
fb AS (SELECT part, r, bucket FROM f JOIN hashed USING (f)),
counts AS (SELECT bucket, count(*) FILTER (part = 'd') AS s, count(*) FILTER (part = 'b') AS t FROM fb GROUP BY bucket),
sums AS (SELECT coalesce(sum(s), 0)::DOUBLE + 10000 AS s, coalesce(sum(t), 0)::DOUBLE + 10000 AS t FROM counts),
gain AS (SELECT bucket, floor(1000 * ln((counts.t + 1.0::DOUBLE) * sums.s / ((counts.s + 1.0::DOUBLE) * sums.t)))::BIGINT AS g FROM counts, sums),
weights AS (SELECT r, sum(g)::BIGINT AS weight FROM fb JOIN gain USING (bucket) WHERE part = 'd' GROUP BY r),
x AS (SELECT r, doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE AS h FROM w LEFT JOIN weights USING (r) WHERE part = 'd'),
y AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM x),
z AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS n FROM y WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM y LEFT JOIN z USING (r)
"""

ORACLE["op12_chat_format"] = rf"""
WITH m AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{SPOKEN}' UNION ALL SELECT -1, 1, 'assistant', '{SPOKEN}'),
f AS (SELECT *, '<|im_start|>' || regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\1\\|', 'g') || chr(10)
    || regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') || '<|im_end|>' || chr(10) AS formatted FROM m)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, formatted)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, formatted) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(formatted))::BIGINT AS formatted_chars, 0::BIGINT AS n_attachments, 0::BIGINT AS attached_tokens
FROM f GROUP BY conv_id
"""

ORACLE["op13_filter_audit"] = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS ws FROM documents),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
fails AS (SELECT part, [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
    regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fail, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM d LEFT JOIN l USING (doc_id)),
h AS (SELECT part, fail, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, fail),
i AS (SELECT unnest(range(1, 6)) AS i),
p AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM i a, i b, i c, i d, i e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (SELECT o, i AS step, o[i] AS f FROM p, i),
run AS (SELECT part, o, step, f, n, good, toxic, fail[f] AS fails, len(list_filter(o[:step - 1], lambda x: fail[x])) > 0 AS gone,
    fail[f] AND len(list_filter(fail, lambda x: x)) = 1 AS sole FROM h, steps),
t AS (SELECT part, array_to_string(list_transform(o, lambda x: substr('ABCDE', x, 1)), '') AS filter_order, step, f,
    sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN fails AND gone THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN sole THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM run GROUP BY part, o, step, f)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM t
"""
