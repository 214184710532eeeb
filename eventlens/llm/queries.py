"""One query for each operator, over its whole table, and the SQL that checks it where there is."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.llm import (
    bpe,
    conversation_repair,
    decontaminate,
    fill_middle,
    html_text,
    jaccard_join,
    lm_counts,
    quality_rules,
    secret_scan,
    sharding,
    simhash_dedup,
    suffix_dedup,
    warc,
)
from eventlens.llm.common import ship

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function name, and the SQL with the same result."""
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The vocabulary file the queries use; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query()
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_counts.cross_entropy_difference(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("spans", "kept")


# For fixtures: each pair of documents with a shingle in common is counted.
@query(f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(
 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
 '[\\x20\\x09-\\x0D]+'), lambda x: x != '') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[k:k + 3], ' ') AS shingle FROM
 (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS k FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (shingle)
 WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
 WHERE 100 * k >= {jaccard_join.PERCENT} * (x.n + y.n - k)),
reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, min(b)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN reached ON a = w.doc_id GROUP BY w.doc_id, n.n""")
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.cluster(table(spark, sf_dir, "documents"))


@query()
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query()
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


@query()
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.summary_rows(table(spark, sf_dir, "documents"))
    return sharding.assign(rows, "doc_id", "source", 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


# Twenty bits, five hexadecimal digits, are four characters of base32.
BASE32 = "||".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"((('0x' || substr(h, {1 + 5 * group}, 5))::BIGINT >> {15 - 5 * k}) & 31)::INT + 1, 1)"
    for group in range(8) for k in range(4))


@query(f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS h FROM p),
r AS (SELECT *, {BASE32} AS payload_digest,
             max(page_id) OVER (PARTITION BY h, payload_bytes) AS response FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = response THEN NULL ELSE response END AS refers_to FROM r""")
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets that the forest confirms; their texts are shown as hashes only."""
    return secret_scan.findings(table(spark, sf_dir, "documents")).drop("text_key", "candidate")


@query()
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents, with the item, the place and the distance."""
    return decontaminate.matches(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


SPACES = "[\\x20\\x09-\\x0D]+"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
Q = quality_rules


@query(f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host,
 coalesce(text, '') AS text, {LOWERED} AS low FROM documents),
w AS (SELECT r, list_filter(string_split_regex(text, '{SPACES}'), lambda x: x != '') AS words FROM d),
base AS (SELECT r, len(words)::BIGINT AS n_words,
 coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars FROM w),
spoken AS (SELECT r, list_filter(string_split(text, chr(10)),
 lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines, text FROM d),
runs AS (SELECT r, k, array_to_string(words[k:k + {Q.WINDOW - 1}], ' ') AS run
 FROM (SELECT r, words, unnest(range(1, len(words) - {Q.WINDOW - 2})) AS k FROM w)),
again AS (SELECT r, unnest(range(k, k + {Q.WINDOW})) AS place FROM
 (SELECT *, count(*) OVER (PARTITION BY r, run) AS n FROM runs) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT place) AS n_repeat_words FROM again GROUP BY r),
pieces AS (SELECT r, host, list_filter(string_split_regex(line, '{SPACES}'), lambda x: x != '') AS parts
 FROM (SELECT r, host, unnest(string_split(low, chr(10))) AS line FROM d)),
lines AS (SELECT r, host, array_to_string(parts, ' ') AS line, sum(len(parts)) AS words
 FROM pieces WHERE len(parts) > 0 GROUP BY ALL),
family AS (SELECT r, string_agg(line, chr(10) ORDER BY line) AS family FROM lines GROUP BY r),
hosts AS (SELECT host, count(DISTINCT coalesce(family, '')) AS n_host
 FROM d LEFT JOIN family USING (r) GROUP BY host),
frequent AS (SELECT host, line FROM lines JOIN family USING (r) JOIN hosts USING (host)
 GROUP BY host, line, n_host HAVING count(DISTINCT family) >= {Q.MIN_DOCS}
 AND count(DISTINCT family) > n_host * {Q.MAX_SHARE}),
removed AS (SELECT r, sum(words)::BIGINT AS n FROM lines JOIN frequent USING (host, line) GROUP BY r),
figures AS (SELECT doc_id, n_words, word_chars,
 length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
 (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
 coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n, 0)::BIGINT AS n_removed_words
 FROM base JOIN spoken USING (r) JOIN (SELECT r, doc_id FROM d) USING (r)
 LEFT JOIN covered USING (r) LEFT JOIN removed USING (r)),
judged AS (SELECT *, n_words < {Q.MIN_WORDS}
 OR n_repeat_words * 100 > n_words * {Q.MAX_REPEAT_PERCENT} AS base_failed FROM figures)
SELECT *, NOT base_failed AND n_words - n_removed_words >= n_words * {Q.MIN_LEFT} AS kept FROM judged""")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("text_key")


# From the output and its form alone: the marks are where they stand first.
@query("""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
 sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
r AS (SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS p, ('0x' || h[9:16])::BIGINT % (n + 1) AS q,
 CASE WHEN n = 0 OR t LIKE '%<P>%' OR t LIKE '%<S>%' OR t LIKE '%<M>%' OR ('0x' || h[17:24])::BIGINT % 100 >= 90
 THEN 'plain' WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
c AS (SELECT *, CASE WHEN form <> 'plain' THEN least(p, q) END AS a,
 CASE WHEN form <> 'plain' THEN greatest(p, q) END AS b FROM r),
o AS (SELECT *, CASE form WHEN 'plain' THEN t
 WHEN 'psm' THEN '<P>' || substring(t, 1, a) || '<S>' || substring(t, b + 1) || '<M>' || substring(t, a + 1, b - a)
 ELSE '<S>' || substring(t, b + 1) || '<P>' || substring(t, 1, a) || '<M>' || substring(t, a + 1, b - a) END AS out FROM c),
m AS (SELECT *, strpos(out, '<P>') AS op, strpos(out, '<S>') AS os, strpos(out, '<M>') AS om FROM o)
SELECT doc_id, n, form, a AS prefix_chars, b - a AS middle_chars, sha256(out) AS output_sha256,
 sha256(CASE form WHEN 'plain' THEN out
 WHEN 'psm' THEN substring(out, 4, os - 4) || substring(out, om + 3) || substring(out, os + 3, om - os - 3)
 ELSE substring(out, op + 3, om - op - 3) || substring(out, om + 3) || substring(out, 4, op - 4) END) AS restored_sha256
FROM m""")
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(table(spark, sf_dir, "documents"))


@query()
def op12_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.cluster(table(spark, sf_dir, "documents"))


# The search over states as a recursive query that keeps whole edit strings; a checksum bit by bit.
@query("""WITH RECURSIVE raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
 coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
crc AS (SELECT k, xor(list_reduce(list_prepend(4294967295::BIGINT,
 list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i, 1))::BIGINT)), lambda c, b:
 list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, o: xor(x >> 1, 3988292384 * (x & 1)) + o)),
 4294967295) % 20 AS kind FROM (SELECT DISTINCT k FROM raw)),
hit AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
 CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
 unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM raw JOIN crc USING (k) WHERE kind <> 0),
seen AS (SELECT *, row_number() OVER c AS i, lag(role) OVER c AS role_before,
 row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again,
 regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS final FROM hit
 WINDOW c AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
r AS (SELECT *, CASE WHEN final = '' THEN 'blank' WHEN again > 1 THEN 'duplicate'
 WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM seen),
step(old, put, mid, letters, cost) AS (VALUES ('0', []::VARCHAR[], '0', '', 0), ('0', ['user:'], 'U', 'I', 3),
 ('0', ['user:', 'assistant:'], 'A', 'II', 6), ('S', [], 'S', '', 0), ('S', ['user:'], 'U', 'I', 3),
 ('S', ['user:', 'assistant:'], 'A', 'II', 6), ('U', [], 'U', '', 0), ('U', ['assistant:'], 'A', 'I', 3),
 ('A', [], 'A', '', 0), ('A', ['user:'], 'U', 'I', 3)),
says(mid, initial, nxt) AS (VALUES ('0', 's', 'S'), ('0', 'u', 'U'), ('S', 'u', 'U'), ('A', 'u', 'U'), ('U', 'a', 'A')),
act(letter, mid, nxt, initial, role, cost) AS (
 SELECT 'K', mid, nxt, initial, NULL, 0 FROM says
 UNION ALL SELECT 'R', mid, nxt, NULL, CASE initial WHEN 'u' THEN 'user' ELSE 'assistant' END, 3 FROM says WHERE initial <> 's'
 UNION ALL SELECT 'D', s, s, NULL, NULL, 4 FROM (VALUES ('0'), ('S'), ('U'), ('A')) v(s)),
way AS (SELECT conv_id, 0::BIGINT AS i, '0' AS state, {'cost': 0, 'audit': '', 'kept': []::VARCHAR[]} AS w
 FROM (SELECT DISTINCT conv_id FROM r)
 UNION ALL
 SELECT way.conv_id, way.i + 1, act.nxt, min({'cost': w.cost + step.cost + act.cost
   + CASE WHEN fault = 'truncated' AND letter <> 'D' THEN 3 ELSE 0 END,
  'audit': w.audit || step.letters || letter,
  'kept': w.kept || step.put || CASE WHEN letter = 'D' THEN []::VARCHAR[] ELSE [coalesce(act.role, r.role) || ':' || r.text] END})
 FROM way JOIN r ON r.conv_id IS NOT DISTINCT FROM way.conv_id AND r.i = way.i + 1
 JOIN step ON step.old = way.state JOIN act ON act.mid = step.mid
 AND (act.initial IS NULL OR act.initial = r.role[1]) AND (letter = 'D' OR fault NOT IN ('blank', 'duplicate'))
 GROUP BY way.conv_id, way.i, act.nxt),
figures AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
 count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
 count(*) FILTER (fault = 'truncated') AS truncated,
 count(*) FILTER (i > 1 AND role_before[1] || role[1] NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
best AS (SELECT way.conv_id, min({'cost': w.cost + step.cost, 'audit': w.audit || step.letters,
 'kept': w.kept || step.put}) AS w FROM way JOIN figures f ON f.conv_id IS NOT DISTINCT FROM way.conv_id AND f.n = way.i
 JOIN step ON step.old = way.state WHERE mid IN ('0', 'A') GROUP BY way.conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
 coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
 coalesce(illegal, 0)::BIGINT AS illegal, coalesce(w.cost, 0)::BIGINT AS cost, coalesce(w.audit, '') AS audit,
 sha256(coalesce(array_to_string(w.kept, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id""")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(table(spark, sf_dir, "conversations"))
