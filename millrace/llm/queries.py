"""The contracts' queries: each applies one operator to whole tables and derives the asked columns."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate as leaks
from millrace.llm import pii, quality_rules
from millrace.llm.common import prepare
from millrace.llm.cuckoo_dedup import exact_dedup
from millrace.llm.importance_resampling import importance_resample
from millrace.llm.interpolated_lm import interpolated_lm
from millrace.llm.ngram_join import ngram_jaccard_join
from millrace.llm.packing import pack
from millrace.llm.pairwise_quality import pairwise_quality
from millrace.llm.prefix_trie import prefix_trie, regrafted, sequences
from millrace.llm.token_table import read_tokens, stored_documents, write_token_table
from millrace.llm.url_filters import filter_urls
from millrace.llm.wrappers import extract_main_text
from millrace.session import new_folder, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(build: Query) -> Query:
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(prepare(spark), sf_dir)

    QUERIES[build.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bradley-Terry quality scores; labels of fold 0 of 5 are never learned."""
    return pairwise_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked at a Jaccard similarity of 0.9 on 3-word shingles."""
    return ngram_jaccard_join(table(spark, sf_dir, "documents"), n=3, num=90, den=100)


@query
def op3_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every text under the interpolated model; fold 0 of 10 is held out."""
    return interpolated_lm(table(spark, sf_dir, "documents"))


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 10 words found in every document."""
    found = leaks.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule measures and verdicts; the measures are written once and summed into the references."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    measured = stage(quality_rules.measure(docs).drop("text"), "measures")
    judged = quality_rules.judge(measured, quality_rules.references(measured))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "common_distance")
    return judged.select("doc_id", *(F.col(f"rule_{x}").alias(x) for x in names))


@query
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every document: the base patterns', and all."""
    found = pii.find_pii(table(spark, sf_dir, "documents"))

    def joined(spans: str):
        name = F.array(*map(F.lit, pii.KINDS))
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")

    counts = [F.size(F.filter("base", lambda s, k=k: s["kind"] == k)).cast("bigint").alias(f"n_{x}") for k, x in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


# The rules of the contract.
URL_RULES = (
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"),
)


@query
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's URL."""
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    judged = filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", *(F.col(f"url_{x}").alias(x) for x in ("host", "path", "rule", "verdict")))


@query
def op8_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    return pack(table(spark, sf_dir, "documents"), vocabulary(), window=4096)


@query
def op9_token_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written as Parquet lists in id order, and read back."""
    path = new_folder(spark, "tokens")
    write_token_table(table(spark, sf_dir, "documents"), path, vocabulary())
    return stored_documents(read_tokens(spark, path))


@query
def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("bigint"))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return prefix_trie(regrafted(sequences(table(spark, sf_dir, "conversations")), group=5, most=8))


@query
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays of every group of equal texts."""
    return exact_dedup(table(spark, sf_dir, "documents"))


@query
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn by their likeness to the benchmark."""
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op2_ngram_jaccard_join"] = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words
), grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS c
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY ALL
), links AS (SELECT x, y FROM common WHERE 100 * c >= 90 * (nx + ny - c)),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.r)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""

ORACLES["op4_decontaminate"] = rf"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, len(w[i:i + 9]) AS n, array_to_string(w[i:i + 9], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
), cut AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), matches AS (SELECT doc_id, i, n, item_id FROM cut JOIN windows USING (n, t)),
hit AS (SELECT doc_id, count(DISTINCT p) AS h FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM matches) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS c, string_agg(item, ',' ORDER BY item) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM matches) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(h, 0) AS BIGINT) AS n_hit, CAST(coalesce(c, 0) AS BIGINT) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(h, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_RULE_ROWS = ", ".join(f"('{r}', '{r[: r.index('/')]}', '{r[r.index('/') :]}', '{v}')" for r, v in URL_RULES)
ORACLES["op7_url_filters"] = rf"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), parts AS (
  SELECT page_id, regexp_extract(r, '^[^/?#]*') AS h, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), urls AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts
), rules(rule, rh, rp, v) AS (VALUES {_RULE_ROWS})
SELECT page_id, any_value(host) AS host, any_value(path) AS path, arg_max(rule, length(rule)) AS rule,
  coalesce(arg_max(v, length(rule)), 'allow') AS verdict
FROM urls LEFT JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
GROUP BY page_id
"""

# crc32 in SQL: the table from its rule, then one lookup a byte.
_CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
)"""


def _crc(text: str) -> str:
    """crc32 of a text column; needs ``crc_table`` among the tables."""
    code = f"hex(encode({text}))"
    found = f"list_transform(range(0, CAST(length({code}) // 2 AS BIGINT)), lambda i: CAST('0x' || substr({code}, 2 * i + 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {found}), lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295)"


ORACLES["op11_prefix_trie"] = f"""
WITH RECURSIVE {_CRC_TABLE}, own AS (
  SELECT conv_id, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS w
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), cut AS (SELECT conv_id, w, {_crc("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM own, crc_table),
rebuilt AS (
  SELECT a.conv_id AS c, list_concat(coalesce(b.w[1:a.h], []), a.w[a.h + 1:]) AS w
  FROM cut a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5
), prefixes AS (
  SELECT c, d, len(w) AS n, CAST(w[1:d] AS VARCHAR) || '#' || d AS p, CASE WHEN d > 0 THEN CAST(w[1:d - 1] AS VARCHAR) || '#' || (d - 1) END AS up,
    CASE WHEN d > 0 THEN octet_length(encode(w[d].x)) ELSE 0 END AS b
  FROM (SELECT c, w, unnest(range(0, len(w) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT p, up, d, any_value(b) AS b, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = d), '')) AS ends
  FROM prefixes GROUP BY p, up, d
), family AS (SELECT a.*, (SELECT count(*) FROM nodes k WHERE k.up = a.p) AS n_children FROM nodes a),
upward AS (
  SELECT p AS top, up, CASE WHEN n_children = 0 THEN 1 ELSE 0 END AS leaf, (n_convs - 1) * b AS saved FROM family
  UNION ALL SELECT f.p, f.up, leaf, saved FROM upward u JOIN family f ON f.p = u.up
), sums AS (SELECT top, sum(leaf) AS n_leaves, sum(saved) AS saved FROM upward GROUP BY top)
SELECT a.conv_id, CAST(a.d AS BIGINT) AS depth, b.conv_id AS parent_conv_id, a.n_convs, a.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, a.ends AS ends_sha256
FROM family a JOIN sums ON top = a.p LEFT JOIN nodes b ON b.p = a.up
"""

ORACLES["op12_exact_dedup"] = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(x) AS text_sha256
FROM (SELECT doc_id, {_LOWERED} AS x FROM documents) WINDOW same AS (PARTITION BY x)
"""

_FEATURES = rf"unnest(regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))"
ORACLES["op13_importance_resampling"] = f"""
WITH {_CRC_TABLE}, doc_words AS (SELECT doc_id, {_FEATURES} AS w FROM documents), item_words AS (SELECT {_FEATURES} AS w FROM benchmark),
vocabulary AS (
  SELECT w, {_crc("w")} % 10000 AS b FROM (SELECT DISTINCT w FROM (SELECT w FROM doc_words UNION ALL SELECT w FROM item_words)), crc_table
), s AS (SELECT b, count(*) AS s FROM doc_words JOIN vocabulary USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM item_words JOIN vocabulary USING (w) GROUP BY b),
sizes AS (SELECT (SELECT count(*) FROM doc_words) AS s_all, (SELECT count(*) FROM item_words) AS t_all),
gain AS (
  SELECT w, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (s_all + 10000) AS DOUBLE) / CAST((coalesce(s, 0) + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS g
  FROM vocabulary LEFT JOIN s USING (b) LEFT JOIN t USING (b), sizes
), weights AS (SELECT doc_id, count(*) AS n, sum(g) AS g FROM doc_words JOIN gain USING (w) GROUP BY doc_id),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, CAST(coalesce(g, 0) AS BIGINT) AS weight,
    CAST(coalesce(g, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM documents LEFT JOIN weights USING (doc_id)
), ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""
