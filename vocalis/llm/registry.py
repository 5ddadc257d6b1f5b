"""Queries of the corpus operators, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ann, collocations, decontamination, language_id, mixing, packing, quality_classifier, quality_rules, sharding,
    simhash_dedup, suffix_dedup, url_filters, vector_codes,
)
from .common import LOWER, UPPER, cut, n_words_of, numbered, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


def bucket(key: F.Column, parts: int) -> F.Column:
    """crc32 of a key as text, modulo ``parts`` (a null key: of no text)."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    sizes = docs.select("doc_id", "source", n_words_of(F.col("text")).alias("size"))
    sizes = cut(numbered(sizes, ["doc_id", "size", "source"]))
    mixed = mixing.mix(sizes).select("uid", "source_size", "target", "copies")
    return sizes.join(mixed, "uid").select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


@query
def op2_dimension_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return ann.nearest(vectors, vectors.filter("vec_id % 50 = 0"))


@query
def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return quality_rules.quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "n_removed_words", "depleted", "kept")


#: The contract's rules: verdict, host, path.
URL_RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
)


_SPACE = r"[\x20\x09-\x0D]+"
#: The same rules over rows: windows, lines and their counts are joins here.
ORACLES["op3_line_frequency"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS t, md5(coalesce(text, '')) AS key,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}'), lambda w: w <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (SELECT rid, i, array_to_string(w[i:i+7], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, sum(least(8, coalesce(nx - i, 8))) AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nx FROM rep) GROUP BY rid),
base AS (
  SELECT d.rid, doc_id, host, key, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN cov USING (rid)),
once AS (
  SELECT DISTINCT host, key, list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(regexp_replace(
    regexp_replace(translate(x, '{UPPER}', '{LOWER}'), '[0-9]+', '0', 'g'), '{_SPACE}', ' ', 'g'))), lambda x: x <> '') AS n
  FROM d),
line AS (SELECT host, key, md5(x) AS h, len(string_split(x, ' ')) AS words FROM (SELECT host, key, unnest(n) AS x FROM once)),
hosts AS (SELECT host, count(DISTINCT key) AS host_docs FROM d GROUP BY host),
often AS (SELECT host, h, count(DISTINCT key) AS docs FROM line GROUP BY host, h),
template AS (SELECT often.host, h FROM often JOIN hosts ON often.host IS NOT DISTINCT FROM hosts.host
  WHERE docs > {quality_rules.MIN_DOCS} AND docs > {quality_rules.MIN_SHARE} * host_docs),
gone AS (SELECT line.host, key, sum(words) AS n FROM line JOIN template
  ON line.host IS NOT DISTINCT FROM template.host AND line.h = template.h GROUP BY line.host, key),
final AS (SELECT base.*, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed_words
  FROM base LEFT JOIN gone ON base.host IS NOT DISTINCT FROM gone.host AND base.key = gone.key)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_removed_words,
  n_removed_words > {quality_rules.MAX_REMOVED} * n_words AS depleted,
  NOT base_failed AND NOT (n_removed_words > {quality_rules.MAX_REMOVED} * n_words) AS kept
FROM final"""


@query
def op4_url_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [url_filters.host_rule(*r) for r in URL_RULES]
    return url_filters.judge(table(spark, sf_dir, "pages", "page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict")


ORACLES["op4_url_automaton"] = f"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(verdict, rhost, rpath) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
m AS (SELECT page_id, rhost || rpath AS rule, r.verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC) AS k
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT p.page_id, host, path, rule, coalesce(m.verdict, CASE WHEN host = '' THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN m ON p.page_id = m.page_id AND k = 1"""


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    pieces = packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"),
                          public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


@query
def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    n = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return docs.select("doc_id", n.alias("n_bytes"), (n - F.octet_length("kept")).alias("n_removed"),
                       "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = table(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return sharding.byte_shards(rows, ["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


#: CRC32 from its rule: a table of 256 remainders, then byte after byte.
ORACLES["op7_sharding"] = """
WITH tbl AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, CAST(size AS BIGINT) AS size, xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(size - 16), lambda i: CAST(
      16 * (instr('0123456789ABCDEF', h[2*i+1]) - 1) + instr('0123456789ABCDEF', h[2*i+2]) - 1 AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM d, tbl),
o AS (SELECT *, sum(size) OVER w AS upto, sum(size) OVER () AS total, row_number() OVER w AS n FROM c
  WINDOW w AS (ORDER BY doc_id NULLS FIRST, size, text_crc32 ROWS UNBOUNDED PRECEDING)),
s AS (SELECT *, least(39, ((2 * upto - size) * 40) // (2 * total)) AS shard FROM o)
SELECT doc_id, size, text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
  n - min(n) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM s"""


@query
def op8_attention_bags(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("held_out", bucket(F.col("doc_id"), 5) == 0)
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").filter(bucket(F.col("doc_id"), 5) != 0)
    model = quality_classifier.train(docs.select("doc_id", "text"), labels)
    return quality_classifier.classify(docs, model).select("doc_id", "held_out", "score", "predicted")


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn(
        "held_out", bucket(F.col("doc_id"), 4) == 2)
    model = language_id.train(docs.filter(~F.col("held_out")))
    return language_id.identify(docs, model).select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return rows.select(F.col("key").alias("doc_id"),
                       F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op11_count_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.collocations(table(spark, sf_dir, "documents", "text", "lang"))
    return collocations.top(found).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLES["op11_count_streams"] = rf"""
WITH p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p
  FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)),
w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
total AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
g AS (SELECT lang, m, g, count(*) AS f
  FROM (SELECT lang, m, array_to_string(w[i:i+m-1], ' ') AS g
    FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS m)))
  GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT lang, m, g, f AS a, string_split(g, ' ') AS s, unnest(range(1, m)) AS k FROM g WHERE m > 1),
scores AS (SELECT c.lang, c.g, c.a, k, l.f AS l, r.f AS r, n,
    (CAST(1000 AS HUGEINT) * c.a * n) // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM cuts c JOIN total USING (lang)
  JOIN g l ON l.lang = c.lang AND l.g = array_to_string(c.s[1:k], ' ')
  JOIN g r ON r.lang = c.lang AND r.g = array_to_string(c.s[k+1:], ' ')),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_ AS (SELECT DISTINCT lang, f, array_to_string(s[i:j], ' ') AS g
  FROM (SELECT lang, f, s, i, unnest(range(i + 1, len(s) + 1)) AS j
    FROM (SELECT lang, f, string_split(g, ' ') AS s, unnest(range(1, m)) AS i FROM g WHERE m > 2))
  WHERE j - i + 1 < len(s)),
kept AS (SELECT b.* FROM best b WHERE NOT EXISTS (
  SELECT 1 FROM inner_ x WHERE x.lang = b.lang AND x.g = b.g AND 100 * x.f >= 100 * b.a))
SELECT * FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase,
    CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
    CAST(score AS BIGINT) AS score FROM kept) WHERE rank <= 2000"""


@query
def op12_aho_corasick(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf_dir, "documents", "doc_id", "text"),
                                          table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


#: Words as lists: every window length that an item has is joined on its own.
ORACLES["op12_aho_corasick"] = rf"""
WITH item AS (SELECT item_id, {{words}} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, n, w[i:i+n-1] AS g
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM (SELECT *, least(10, len(w)) AS n FROM item WHERE len(w) > 0))),
doc AS (SELECT row_number() OVER () AS rid, doc_id, {{words}} AS w FROM documents),
place AS (SELECT rid, n, i, w[i:i+n-1] AS g
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM win))),
met AS (SELECT rid, i, place.n, item_id FROM place JOIN win USING (n, g)),
hit AS (SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS j FROM met) GROUP BY rid),
ids AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM met WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (rid) LEFT JOIN ids USING (rid)""".replace("{words}", (
    f"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
    r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"))


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return coded.select(F.col("key").alias("vec_id"), code.alias("code"), "error", "label_error",
                        F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


def _codes_sql() -> str:
    """Codebooks and codes round by round, a common table each."""
    steps = ["""v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             """p AS MATERIALIZED (SELECT rid, part, c[16*part+1:16*part+16] AS c FROM v, (SELECT unnest(range(4)) AS part))""",
             """b0 AS MATERIALIZED (SELECT part, rid - 1 AS entry, c FROM p WHERE rid <= 256)"""]
    near = """a{k} AS MATERIALIZED (SELECT p.rid, p.part, arg_min(entry, (d, entry)) AS entry, min(d) AS d
  FROM (SELECT p.rid, p.part, b.entry, list_sum(list_transform(list_zip(p.c, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM p JOIN b{k} b ON p.part = b.part) p GROUP BY p.rid, p.part)"""
    mean = """b{j} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.c, b.c) AS c FROM b{k} b LEFT JOIN (
  SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c
  FROM (SELECT a.part, a.entry, i, sum(p.c[i]) AS s, count(*) AS n
    FROM a{k} a JOIN p USING (rid, part), (SELECT unnest(range(1, 17)) AS i) GROUP BY a.part, a.entry, i)
  GROUP BY part, entry) m USING (part, entry))"""
    for k in range(4):
        steps += [near.format(k=k), mean.format(k=k, j=k + 1)]
    steps += [near.format(k=4), """r AS (SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a4 GROUP BY rid)""",
              """s AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS h FROM b4)"""]
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM v JOIN r USING (rid), s"""


ORACLES["op13_vector_codes"] = _codes_sql()
