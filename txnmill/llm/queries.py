"""One query per corpus operator over its whole table, and SQL where SQL can express it."""

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnmill.llm.chat import formatted
from txnmill.llm.common import WORD, table
from txnmill.llm.hard_negatives import hard_negatives
from txnmill.llm.mixing import mixture
from txnmill.llm.packing import pack
from txnmill.llm.periodic_runs import periodic_runs
from txnmill.llm.sharding import kd_shards
from txnmill.llm.simhash import simhash_groups
from txnmill.llm.span_hashes import fingerprints
from txnmill.llm.token_counts import token_counts
from txnmill.llm.token_files import read_token_files, write_token_files
from txnmill.llm.topk import top_k
from txnmill.llm.toxicity import score, train
from txnmill.llm.url_rules import host_tokens, judged, labelled_by_list, mine_rules
from txnmill.session import shared_dir


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of all vectors for every query, a row whose id 50 divides."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document, sources weighing 1, 2, 3 in turn."""
    mix = mixture(table(spark, sf_dir, "documents"), weights=(1, 2, 3), cap=3)
    return mix.select("doc_id", "size", "source_size", "target", "taken", "passes")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal logged conversations, rendered; a row per 1024 turns."""
    return formatted(table(spark, sf_dir, "conversations"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum, read back from the token-id files."""
    path = f"{shared_dir(spark)}/llm-token-files-{uuid.uuid4().hex}"
    model = public_tokenizers.path("byte_bpe_50k.json")
    write_token_files(table(spark, sf_dir, "documents"), path, model, end_id=0)
    return read_token_files(path, spark)


def op5_span_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likeness."""
    return fingerprints(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document, by a model of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


def op7_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bin and place of every piece of every document, packed to four lengths in words."""
    return pack(table(spark, sf_dir, "documents")).drop("row_no")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the piece model."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts(table(spark, sf_dir, "documents"), model, limit=4096)


def op9_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of three-word shingles and group of every document, linked at two bits."""
    groups = simhash_groups(table(spark, sf_dir, "documents"), shingle_words=3, radius=2)
    return groups.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def op10_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, shards of near equal bytes."""
    return kd_shards(table(spark, sf_dir, "documents"), shards=16).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


# verdict, host, path
LISTED_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every address: of the listed rules, else of rules mined from what these decide.

    Listed hosts choose what is labelled, so their own labels are left out of mined rules.
    """
    pages = table(spark, sf_dir, "pages")
    labelled = labelled_by_list(pages, LISTED_RULES)
    return judged(pages, LISTED_RULES, mine_rules(labelled, left_out=host_tokens(LISTED_RULES)))


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text), where one document in ten repeats a block of its words up to its end."""
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    h = F.crc32(F.col("doc_id").cast("string"))
    split = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("w"))
    n = F.size("w")
    placed = split.withColumns({"n": n, "g": F.expr("h div 10")}).withColumn(
        "a", F.when(F.col("n") > 0, F.expr("cast(g % n as int)"))
    )
    period = placed.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    repeated = "flatten(array_repeat(slice(w, a + 1, p), cast(ceil((n - a) / p) as int)))"
    planted = f"array_join(slice(concat(slice(w, 1, a), {repeated}), 1, n), ' ')"
    return period.select("doc_id", F.expr(f"CASE WHEN a IS NULL THEN text ELSE {planted} END").alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document with planted ones, its most repeated run, and what is left without repeats."""
    found = periodic_runs(_with_planted_runs(table(spark, sf_dir, "documents")))
    more = "best IS NULL OR run.length * best.period > best.length * run.period"
    best = f"""aggregate(runs, cast(NULL AS struct<start: bigint, length: bigint, period: bigint>),
        (best, run) -> CASE WHEN {more} THEN run ELSE best END)"""
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    return found.select("*", F.expr(best).alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.*",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.expr(lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor, a row whose id 100 divides, and each of its five positives."""
    vec_id, label = F.col("vec_id"), F.col("label")
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label")
    )
    return hard_negatives(vectors, vec_id % 100 == 0, positives=5, negatives=10, low=30, high=90)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_top_k": op1_top_k,
    "op2_source_mix": op2_source_mix,
    "op3_chat_format": op3_chat_format,
    "op4_token_files": op4_token_files,
    "op5_span_fingerprints": op5_span_fingerprints,
    "op6_toxicity": op6_toxicity,
    "op7_best_fit": op7_best_fit,
    "op8_token_counts": op8_token_counts,
    "op9_simhash_groups": op9_simhash_groups,
    "op10_kd_shards": op10_kd_shards,
    "op11_url_filter": op11_url_filter,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_hard_negatives": op13_hard_negatives,
}

_TOP_K = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_CHAT = """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
p AS (
  SELECT *, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS FIRST, text NULLS FIRST) AS place
  FROM t
), c AS (
  SELECT conv_id, count(*) AS n_turns, list({'role': role, 'text': text} ORDER BY place) AS turns
  FROM p GROUP BY conv_id
), u AS (
  SELECT turns, n_turns, min(conv_id) AS conv_id, count(*) AS copies FROM c GROUP BY turns, n_turns
), x AS (
  SELECT DISTINCT turns[1:k] AS head FROM (SELECT turns, unnest(range(1, n_turns)) AS k FROM u)
), m AS (SELECT u.* FROM u ANTI JOIN x ON u.turns = x.head)
SELECT m.conv_id, (place - 1) // 1024 AS part, n_turns, copies,
       string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10),
                  '' ORDER BY place) AS text
FROM m JOIN p ON m.conv_id = p.conv_id GROUP BY ALL
"""

# Windows of five words that recur up to a quarter of a text apart, joined into stretches by lag.
_RUNS = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda b:
    list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t
), d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    CASE WHEN doc_id IS NOT NULL THEN xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
      lambda c, b: xor(c // 256, t[(xor(c, b) % 256) + 1]))) END AS h
  FROM documents, crc
), s AS (
  SELECT rid, doc_id, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, h // 10 AS g FROM d
), e AS (
  SELECT rid, doc_id, n, w, a, 1 + (n - a) // (3 + g % 8) AS p FROM s
), p AS (
  SELECT rid, n, unnest(range(n)) AS i, w, a, p FROM e
), u AS (
  SELECT rid, n, i, w[CAST(CASE WHEN i >= a THEN a + (i - a) % p ELSE i END AS BIGINT) + 1] AS x FROM p
), f AS (
  SELECT *, CASE WHEN i + 5 <= n THEN concat_ws(' ', x, lead(x, 1) OVER v, lead(x, 2) OVER v, lead(x, 3) OVER v, lead(x, 4) OVER v) END AS five
  FROM u WINDOW v AS (PARTITION BY rid ORDER BY i)
), m AS (
  SELECT b.rid, b.i, b.i - c.i AS q
  FROM f b JOIN f c ON b.rid = c.rid AND b.five = c.five AND b.i > c.i AND 4 * (b.i - c.i) <= b.n
), k AS (
  SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM m
), r AS (
  SELECT rid, min(i) - q AS start, count(*) + 4 + q AS length, q FROM k
  GROUP BY rid, q, island HAVING count(*) + 4 + q >= greatest(6, 4 * q)
), runs AS (
  SELECT rid, start, length, min(q) AS period FROM r GROUP BY rid, start, length
), covered AS (
  SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM runs
), c AS (
  SELECT rid, string_agg(x, ' ' ORDER BY i) AS text FROM u ANTI JOIN covered USING (rid, i) GROUP BY rid
), best AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY length * 1.0 / period DESC, start, period) AS place FROM runs
), l AS (
  SELECT rid, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY rid
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period,
       CAST(1000 * length // period AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(c.text, '')) AS collapsed_sha256
FROM d LEFT JOIN l USING (rid) LEFT JOIN c USING (rid) LEFT JOIN (FROM best WHERE place = 1) AS b USING (rid)
"""

_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) for x in embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT p.*, s.vec_id AS negative_id, score AS negative_score, CAST(row_number() OVER (
    PARTITION BY anchor_id, positive_id ORDER BY score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

ORACLE_SQL: dict[str, str] = {
    "op1_top_k": _TOP_K,
    "op3_chat_format": _CHAT,
    "op12_periodic_runs": _RUNS,
    "op13_hard_negatives": _NEGATIVES,
}
