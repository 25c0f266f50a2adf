"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, html_extract, mixing, pii, quality_rules, sentencepiece, sharding, url_filter
from .bagminhash import near_duplicate_classes
from .substring_dedup import remove_repeated_spans


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def model_path() -> str:
    """The piece model among the public tokenizers; TOKENIZERS names another folder."""
    return f"{os.environ.get('TOKENIZERS', '/opt/tokenizers')}/piece_bpe_32k.model"


def digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = quality_rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    measured = full.select("doc_id", *(f"ledger.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "failed")))
    base = F.col("failed").bitwiseAND(F.lit(quality_rules.BASE).cast("long")) != 0
    return measured.withColumn("base_failed", base).withColumn("kept", quality_rules.kept(failed=F.col("failed")))


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the current policy does, from the ledger of all documents."""
    return quality_rules.ablations(quality_rules.ledger(table(spark, sf_dir, "documents").select("text")))


def op7_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicate_classes(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_rows", "n_runs")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(remove_repeated_spans(spark, table(spark, sf_dir, "documents")))


OP2_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), runs AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, run) AS n FROM runs) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT spot) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS spot FROM twice) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines
  FROM w LEFT JOIN covered c USING (doc_id) LEFT JOIN lines l USING (doc_id)
), f AS (
  SELECT *, CAST(
    CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN n_lines >= 4 AND 100 * n_dup_lines > 60 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars > 40 * n_words THEN 16 ELSE 0 END + CASE WHEN 2 * word_chars < 3 * n_words THEN 32 ELSE 0 END AS BIGINT) AS failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, failed, failed & 3 <> 0 AS base_failed, failed = 0 AS kept FROM f
"""

#: All pairs, which is for small tables; the operator misses a pair at 0.8 with a chance of 7 in 10 ** 5, and no class of the test tables.
OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), bags AS (
  SELECT doc_id, array_to_string(words[i:i + 4], ' ') AS run, count(*) AS n FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0) GROUP BY ALL
), sizes AS (
  SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_runs FROM bags GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.n, b.n)) AS n FROM bags a JOIN bags b ON a.run = b.run AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 10 * n >= 8 * (x.n_runs + y.n_runs - n)
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, e.b FROM reached r JOIN edges e ON e.a = r.other
), classes AS (SELECT doc_id, min(other) AS class_id FROM reached GROUP BY doc_id)
SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_rows, coalesce(n_runs, 0) AS n_runs FROM classes LEFT JOIN sizes USING (doc_id)
"""

OP10_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS win FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS spot FROM later
), spots AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS spot FROM w
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY spot) AS words FROM spots ANTI JOIN gone USING (doc_id, spot) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w.words) AS BIGINT) AS n_words, CAST(len(w.words) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.words, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

ABLATIONS_SQL = f"""
WITH ledger AS ({OP2_SQL}), rules AS (
  SELECT * FROM (VALUES ('few_words', 1), ('repeated_runs', 2), ('symbols', 4), ('repeated_lines', 8), ('long_words', 16), ('short_words', 32)) r(rule, bit) WHERE EXISTS (SELECT 1 FROM documents)
)
SELECT rule, CAST(bit AS BIGINT) AS bit, count(*) FILTER (WHERE failed & bit <> 0) AS failed, count(*) FILTER (WHERE failed = bit) AS only_this,
  count(*) FILTER (WHERE failed & 63 & ~bit = 0) AS kept_without
FROM ledger, rules GROUP BY rule, bit
"""


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether decoding them gives the text again."""
    both = sentencepiece.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model_path(), decoded_col="decoded")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").eqNullSafe(F.replace("text", F.lit(sentencepiece.MARK), F.lit(" "))).alias("round_trip"))


def op3_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest_neighbours(spark, vectors, vectors.filter("vec_id % 100 = 0"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(spark, table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", (F.col("mix.size") * F.col("mix.copies")).alias("taken"))


def url_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated entries made from the hosts and path prefixes, of every depth, of pages, as there is no table of them: what a hash of the key says."""
    bare = F.regexp_replace(F.regexp_replace("url", "^[a-z]+://", ""), "[?#].*$", "")
    parts = F.filter(F.split(F.regexp_replace(bare, "^[^/]*/?", ""), "/"), lambda x: x != "")
    keys = table(spark, sf_dir, "pages").select(F.regexp_extract("url", r"^[a-z]+://(?:www\.)?([^/?#]+)", 1).alias("host"), parts.alias("parts")).filter("host != ''")
    domains = keys.select(F.concat(F.lit("d:"), F.substring_index("host", ".", -3)).alias("key"))
    depth = F.explode(F.sequence(F.lit(1), F.size("parts"))).alias("depth")
    prefixes = keys.filter("size(parts) > 0").select("host", "parts", depth).select(F.concat(F.lit("p:"), "host", F.lit("/"), F.array_join(F.slice("parts", F.lit(1), F.col("depth")), "/")).alias("key"))
    made = domains.unionByName(prefixes).distinct().withColumn("h", F.md5(F.col("key").cast("binary"))).filter("substr(h, 1, 1) IN ('0', '1', '2', '3', '4', '5')")
    number = lambda at: F.conv(F.substr("h", F.lit(at), F.lit(2)), 16, 10).cast("int")
    added = F.date_add(F.lit("2024-01-01").cast("date"), number(3))
    changes = F.array(F.struct(F.lit("add").alias("action"), added.alias("on")), F.struct(F.lit("remove").alias("action"), F.date_add(added, number(5)).alias("on")), F.struct(F.lit("add").alias("action"), F.date_add(added, number(5) + number(7)).alias("on")))
    return made.select(F.concat(F.lit("list"), F.substr("h", F.lit(2), F.lit(1))).alias("list"), "key", F.explode(changes).alias("c")).select("list", "key", "c.action", "c.on")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.conv(F.substr(F.md5(F.col("page_id").cast("string").cast("binary")), F.lit(1), F.lit(4)), 16, 10).cast("int") % 600)
    captures = table(spark, sf_dir, "pages").select("page_id", "url", day.alias("fetched"))
    judged = url_filter.judge(captures, url_entries(spark, sf_dir))
    return judged.select("page_id", "url", "fetched", F.array_join("lists", ",").alias("lists"), "blocked")


OP5_SQL = r"""
WITH page AS (
  SELECT page_id, url, CAST(DATE '2024-01-01' + CAST(('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 4))::INT % 600 AS INT) AS DATE) AS fetched,
    regexp_extract(url, '^[a-z]+://(?:www\.)?([^/?#]+)', 1) AS host,
    list_filter(string_split(regexp_replace(regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', ''), '^[^/]*/?', ''), '/'), lambda x: x <> '') AS parts FROM pages
), prefixed AS (
  SELECT page_id, url, fetched, 'p:' || host || '/' || array_to_string(parts[1:i], '/') AS key FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM page WHERE host <> '')
), labels_of AS (SELECT host, string_split(host, '.') AS p FROM (SELECT DISTINCT host FROM page)), made AS (
  SELECT DISTINCT 'd:' || array_to_string(p[greatest(1, len(p) - 2):len(p)], '.') AS key FROM labels_of WHERE host <> ''
  UNION SELECT DISTINCT key FROM prefixed
), h AS (SELECT key, md5(key) AS h FROM made WHERE substr(md5(key), 1, 1) IN ('0', '1', '2', '3', '4', '5')
), n AS (SELECT key, 'list' || substr(h, 2, 1) AS list, ('0x' || substr(h, 3, 2))::INT AS a, ('0x' || substr(h, 5, 2))::INT AS b, ('0x' || substr(h, 7, 2))::INT AS c FROM h
), intervals AS (
  SELECT list, key, DATE '2024-01-01' + a AS since, DATE '2024-01-01' + a + b AS until FROM n WHERE b > 0
  UNION ALL SELECT list, key, DATE '2024-01-01' + a + b + c, DATE '9999-12-31' FROM n WHERE c > 0
), keyed AS (
  SELECT page_id, url, fetched, 'd:' || array_to_string(string_split(host, '.')[i:], '.') AS key
  FROM (SELECT *, unnest(range(1, greatest(2, len(string_split(host, '.'))))) AS i FROM page WHERE host <> '')
  UNION SELECT page_id, url, fetched, key FROM prefixed
), held AS (
  SELECT DISTINCT page_id, list FROM keyed JOIN intervals USING (key) WHERE fetched >= since AND fetched < until
)
SELECT page_id, url, fetched, coalesce(string_agg(list, ',' ORDER BY list), '') AS lists, count(list) > 0 AS blocked
FROM page LEFT JOIN held USING (page_id) GROUP BY page_id, url, fetched
"""


def op6_consensus_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(spark, table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


#: Pages of the test tables mark their article by a tag, whose blocks are paragraphs and headings; nothing else of a page is text.
OP6_SQL = r"""
WITH article AS (
  SELECT page_id, url, regexp_split_to_array(regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '<br>', ' ', 'g'), '</?(?:p|h1)>') AS blocks FROM pages
), plain AS (
  SELECT page_id, url, list_transform(blocks, lambda x: trim(regexp_replace(regexp_replace(replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&quot;', '"'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS blocks FROM article
), joined AS (
  SELECT page_id, url, array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10)) AS text FROM plain
)
SELECT page_id, url, text, length(text) AS n_chars FROM joined
"""

PII_KEY = "public test key, not for production"


def op8_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    return made.select("doc_id", "text", F.array_join("pii_kinds", ",").alias("pii_kinds"))


def op9_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard_by_bytes(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return dealt.select("doc_id", F.expr(sharding.SIZE).alias("size"), crc.alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: Each shard ends at the row nearest to its part of all bytes. CRC-32 has no function there: bits of a byte make the table, bytes the sum.
OP9_SQL = r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS text, md5(coalesce(text, '')) AS hash FROM documents
), d AS (
  SELECT doc_id, text, CAST(strlen(text) + 1 AS BIGINT) AS size, ('0x' || substr(hash, 1, 10) || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || hash), 1, 5))::BIGINT AS key FROM h
), k AS (
  SELECT key, CAST(sum(size) AS BIGINT) AS size, CAST(sum(sum(size)) OVER (ORDER BY key) - sum(size) AS BIGINT) AS below FROM d GROUP BY key
), total AS (SELECT CAST(sum(size) AS BIGINT) AS n FROM d), goals AS (
  SELECT n * shard / 8 AS goal FROM total, range(1, 8) r(shard)
), edges AS (
  SELECT goal, max(key) FILTER (WHERE below <= goal) AS lo, max(below) FILTER (WHERE below <= goal) AS lo_below, min(key) FILTER (WHERE below > goal) AS hi, coalesce(min(below) FILTER (WHERE below > goal), min(n)) AS hi_below
  FROM goals, k, total GROUP BY goal
), splitters AS (
  SELECT CASE WHEN goal - lo_below <= hi_below - goal THEN lo ELSE coalesce(hi, 1152921504606846976) END AS key FROM edges
), placed AS (
  SELECT doc_id, text, size, key, (SELECT count(*) FROM splitters s WHERE s.key <= d.key) AS shard FROM d
), t AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t FROM range(256) r(i)
), bytes AS (
  SELECT *, list_transform(regexp_extract_all(hex(text), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes FROM placed
)
SELECT doc_id, size, xor(list_reduce(bytes, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS text_crc32, 'bytes' AS law,
  CAST(shard AS INT) AS shard, row_number() OVER (PARTITION BY shard ORDER BY key, doc_id) - 1 AS slot, CAST(NULL AS INT) AS grown_shard FROM bytes, t
"""

OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS key,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(md5(text), '')) AS place
  FROM documents
), s AS (
  SELECT key, source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY key, source
), w AS (
  SELECT *, CAST([5, 2, 1][(rank - 1) % 3 + 1] AS BIGINT) AS weight, sum(source_size) OVER () * CAST(1.5 AS DOUBLE) AS budget FROM s
), r AS (
  SELECT *, CAST(2 * source_size AS DOUBLE) / weight AS need FROM w
), l AS (
  SELECT *, need <= (budget - coalesce(sum(2 * source_size) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS at_limit
  FROM r WINDOW before AS (ORDER BY need, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT key, source_size, CASE WHEN at_limit THEN CAST(2 * source_size AS DOUBLE) ELSE
    weight * (budget - coalesce(sum(CASE WHEN at_limit THEN 2 * source_size END) OVER (), 0)) / coalesce(sum(CASE WHEN NOT at_limit THEN weight END) OVER (), 1) END AS target FROM l
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(2, floor(target / source_size)) ELSE 0 END AS copies FROM t
), g AS (
  SELECT key, place, sum(size) AS size, sum(sum(size)) OVER (PARTITION BY key ORDER BY place) - sum(size) AS before FROM d GROUP BY key, place
), e AS (
  SELECT g.*, target - copies * source_size AS rest, min(CASE WHEN before + size > target - copies * source_size THEN place END) OVER (PARTITION BY key) AS edge FROM g JOIN p USING (key)
), extra AS (
  SELECT key, place, CASE WHEN edge IS NULL OR place < edge OR place = edge AND before + size - rest < rest - before THEN 1 ELSE 0 END AS more FROM e
)
SELECT doc_id, size, source_size, target, CAST(size * (copies + more) AS BIGINT) AS taken FROM d JOIN p USING (key) JOIN extra USING (key, place)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_quality_rules": op2_quality_rules,
    "op3_adaptive_scan": op3_adaptive_scan,
    "op4_mixing": op4_mixing,
    "op5_url_filter": op5_url_filter,
    "op6_consensus_paths": op6_consensus_paths,
    "op7_bagminhash": op7_bagminhash,
    "op8_pseudonyms": op8_pseudonyms,
    "op9_histogram_sort": op9_histogram_sort,
    "op10_substring_dedup": op10_substring_dedup,
    "quality_ablations": quality_ablations,
}

#: The other queries give what SQL can't express; tests hold them against brute force.
ORACLES: dict[str, str] = {"op2_quality_rules": OP2_SQL, "op4_mixing": OP4_SQL, "op5_url_filter": OP5_SQL, "op6_consensus_paths": OP6_SQL, "op7_bagminhash": OP7_SQL, "op9_histogram_sort": OP9_SQL, "op10_substring_dedup": OP10_SQL, "quality_ablations": ABLATIONS_SQL}
