"""The queries op1 to op13 and their SQL: thin wrappers that apply the operators to whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thicket.sources.files import scratch

from . import audit, chat, counts, jaccard, langid, lm, media, mixing, neardup, packing, pii, quality, search
from .shared import fold, small_batches, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_on(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


#: The key of the queries; whoever uses the operator brings a key of their own.
DEMO_KEY = "an open key, for demonstration"


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), DEMO_KEY)
    return named.select("doc_id", "text", F.size("pii").cast("long").alias("n_replaced"), "pii")


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    formatted = chat.format_chats(turns.unionByName(own))
    back = formatted.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), chat.read_turns("formatted").alias("t"), F.array_join(chat.read_loss(F.col("formatted"), F.col("loss_spans")), "").alias("loss"))
    each = F.transform("t", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("t").cast("long").alias("n_turns"), F.sha2(F.array_join(each, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit_on(docs)
    return langid.predict(docs.drop("lang"), model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("_key").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), words=4, num=85, den=100)


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    described = media.describe_images(media.encode_images(docs, "text"))
    return described.select("doc_id", F.col("note").alias("n_bytes"), "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", F.col("dhash").alias("feature"), F.sha2("tile", 256).alias("tile_sha256"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).withColumnRenamed("_key", "doc_id")


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op10_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Begins with an empty cache, so that a run is the work of all distinct texts."""
    return counts.count_tokens(table(spark, sf_dir, "documents"), scratch(spark)).withColumnRenamed("_key", "doc_id")


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnsRenamed({"_item": "item_id", "_key": "doc_id"})


def _batched(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return query(spark, sf_dir)

    return run


_ALL = [op1_quality, op2_pii, op3_chat, op4_langid, op5_mixing, op6_jaccard, op7_media, op8_packing, op9_lm, op10_neardup, op11_filter_audit, op12_token_counts, op13_search]
QUERIES: dict[str, Query] = {f.__name__: _batched(f) for f in _ALL}

_OP3 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(regexp_replace(regexp_replace(replace(text, '&', '&amp;'), '<(/?s>)', '&lt;\1', 'g'), '\[(/?INST\]|SEP\])', '&lsqb;\1', 'g')) AS n_text,
         length(regexp_replace(regexp_replace(replace(role, '&', '&amp;'), '<(/?s>)', '&lt;\1', 'g'), '\[(/?INST\]|SEP\])', '&lsqb;\1', 'g')) AS n_role,
         coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) = role, false) AS joined
  FROM t
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n_text + CASE WHEN joined THEN 5 ELSE n_role + 20 END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

_OP6 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
), o AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), e AS (
  SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)
), r AS (
  SELECT doc_id, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m USING (doc_id)
"""

_OP10 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
), u AS (
  SELECT vec_id, [x / sqrt(list_dot_product(v, v)) for x in v] AS u FROM v WHERE list_dot_product(v, v) > 0
), e AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id WHERE list_dot_product(a.u, b.u) >= 0.9
), r AS (
  SELECT vec_id, vec_id AS c FROM embeddings UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.vec_id
)
SELECT vec_id, (SELECT count(*) FROM e WHERE e.a = m.vec_id)::BIGINT AS n_links, c AS component_id, vec_id = c AS kept
FROM (SELECT vec_id, min(c) AS c FROM r GROUP BY vec_id) m
"""

_OP11 = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), l AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
         + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask
  FROM d LEFT JOIN l USING (doc_id)
), g AS (
  SELECT part, good, toxic, mask, count(*) AS n FROM f GROUP BY ALL
), c AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS b
), p AS (
  SELECT v.c || w.c || x.c || y.c || z.c AS o FROM c v, c w, c x, c y, c z WHERE v.b | w.b | x.b | y.b | z.b = 31
), s AS (
  SELECT o AS filter_order, step::INT AS step, c, b, coalesce((SELECT sum(e.b) FROM c e WHERE strpos(substr(o, 1, step - 1), e.c) > 0), 0)::INT AS before
  FROM p, (SELECT unnest(range(1, 6)) AS step) JOIN c ON c.c = substr(o, step, 1)
), r AS (
  SELECT part, filter_order, step, c, sum(CASE WHEN mask & (before | b) = 0 THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN mask & before = 0 AND mask & b > 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN mask & before > 0 AND mask & b > 0 THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN mask = b THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN mask & before = 0 AND mask & b > 0 AND good THEN n ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN mask & before = 0 AND mask & b > 0 AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
  FROM g, s GROUP BY ALL
)
SELECT * EXCLUDE (c), (sum(removed) OVER (PARTITION BY part, c))::BIGINT AS shapley FROM r
"""

_OP13 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
), n AS (
  SELECT doc_id, len(t) AS n FROM d WHERE len(t) > 0
), g AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n
), m AS (
  SELECT doc_id, 75 + (25 * n * docs) // terms AS m FROM n, g
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, g GROUP BY term, docs
), q AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL
), s AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY ALL
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score FROM s WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""

ORACLE_SQL: dict[str, str] = {"op3_chat": _OP3, "op6_jaccard": _OP6, "op10_neardup": _OP10, "op11_filter_audit": _OP11, "op13_search": _OP13}
