"""Registered queries of this subpackage over whole given tables, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaylake.llm import (
    bytebpe, covertree, language, linededup, packing, pii, prefixtrie, quality, sharding, simhash, substring, subwords,
    tokens, vptree,
)
from quaylake.llm.common import prepared

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        QUERIES[name] = lambda spark, folder: run(prepared(spark), folder)
        if sql:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_sharding")
def sharding_of_documents(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return sharding.sharded(table(spark, folder, "documents")).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op2_quality_rules")
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged = quality.judged(docs, keep=["doc_id"])
    return judged.select("doc_id", *quality.METRICS, "base_failed", "kept", "quality")


@query(
    "op3_nearest_neighbours",
    """
    WITH vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    pairs AS (
      SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
             sqrt(list_reduce(
               list_transform(range(1, len(q.v) + 1), lambda i: (q.v[i] - c.v[i]) * (q.v[i] - c.v[i])),
               lambda x, y: x + y)) AS score
      FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
    ), ranked AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank FROM pairs
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
)
def nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return vptree.nearest(table(spark, folder, "embeddings"), F.col("id") % 100 == 0, k=10)


@query("op4_simhash_near_duplicates")
def simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.classes(table(spark, folder, "documents"))


@query("op5_sentencepiece_round_trip")
def sentencepiece_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = subwords.encoded(docs, wanted=("ids", "decoded"))
    return found.select(
        "doc_id", subwords.n_ids(F.col("ids")).alias("n_ids"), F.crc32("ids").alias("ids_crc32"),
        F.md5("decoded").alias("decoded_md5"), F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


@query("op6_personal_data")
def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")

    def count(kind: str):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return pii.detected(docs).select(
        "doc_id", *[count(kind) for kind in ("email", "ip", "card", "phone")],
        F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"), pii.as_text(F.col("spans")).alias("spans"),
    )


@query(
    "op7_line_boilerplate",
    """
    WITH places AS (
      SELECT doc_id, source, unnest(range(len(string_split(text, chr(10))))) AS place,
             unnest(string_split(text, chr(10))) AS line
      FROM documents
    ), lines AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS plain FROM places),
    wide AS (
      SELECT plain FROM lines WHERE plain <> ''
      GROUP BY plain HAVING count(DISTINCT coalesce(source, chr(0))) >= 6
    ), ranked AS (
      SELECT doc_id, place, line, (plain IN (SELECT plain FROM wide)) AS spread,
             row_number() OVER (PARTITION BY plain ORDER BY doc_id NULLS LAST, place) > 1 AS later
      FROM lines
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE spread AND later) AS n_removed,
           md5(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT (spread AND later)), '')) AS kept_md5
    FROM ranked GROUP BY doc_id
    """,
)
def line_boilerplate(spark: SparkSession, folder: str) -> DataFrame:
    report = linededup.report(table(spark, folder, "documents"))
    return report.select(
        F.col("id").alias("doc_id"), "n_lines", "n_removed", F.md5("kept_text").alias("kept_md5")
    )


@query("op8_language_spans")
def language_spans(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    docs = docs.withColumn("held_out", F.coalesce(rest == 2, F.lit(False)))
    model = language.learned(docs.where(rest != 2))
    found = language.predicted(docs, model, doc_id="doc_id", held_out="held_out")
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))


@query("op9_substring_repeats")
def substring_repeats(spark: SparkSession, folder: str) -> DataFrame:
    result = substring.repeats_removed(table(spark, folder, "documents"))
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op10_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = tokens.pieces(table(spark, folder, "documents"), packing.CAPACITY)
    return packing.packed(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def lloyd_sql() -> str:
    """The rounds one after the other: every part meets the entries of its codebook."""
    rounds = []
    for k in range(covertree.ROUNDS + 1):
        rounds.append(f"""
        near{k} AS MATERIALIZED (
          SELECT row, part, arg_min(entry, (far, entry)) AS entry, min(far) AS far FROM (
            SELECT row, p.part, entry, list_sum(list_transform(range(1, len(v) + 1), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) AS far
            FROM parts p JOIN book{k} b ON p.part = b.part) GROUP BY row, part)""")
        if k < covertree.ROUNDS:
            rounds.append(f"""
        book{k + 1} AS MATERIALIZED (
          SELECT b.part, b.entry, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN (
            SELECT part, entry, list(CAST(floor(total / many) AS BIGINT) ORDER BY pos) AS c FROM (
              SELECT n.part, n.entry, pos, sum(v[pos]) AS total, count(*) AS many
              FROM near{k} n JOIN parts p ON n.row = p.row AND n.part = p.part, range(1, len(p.v) + 1) x(pos)
              GROUP BY n.part, n.entry, pos) GROUP BY part, entry) m ON b.part = m.part AND b.entry = m.entry)""")
    last = covertree.ROUNDS
    return f"""
    WITH kept AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label,
             list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor({covertree.SCALE} * x) AS BIGINT)) AS v
      FROM embeddings
      WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), parts AS MATERIALIZED (
      SELECT row, part, v[part * (len(v) // {covertree.PARTS}) + 1 : (part + 1) * (len(v) // {covertree.PARTS})] AS v
      FROM kept, range({covertree.PARTS}) x(part)
    ), book0 AS MATERIALIZED (SELECT part, row - 1 AS entry, v AS c FROM parts WHERE row <= {covertree.ENTRIES}),
    {",".join(rounds)},
    coded AS (
      SELECT row, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error
      FROM near{last} GROUP BY row
    ), joined AS (SELECT * FROM kept JOIN coded USING (row)),
    labels AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM joined GROUP BY label)
    SELECT vec_id, code, error, label_error,
           (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM book{last}) AS codebooks_sha256
    FROM joined j JOIN labels l ON j.label IS NOT DISTINCT FROM l.label
    """


@query("op11_vector_codes", lloyd_sql())
def vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return covertree.compressed(table(spark, folder, "embeddings"))


@query("op12_byte_bpe_round_trip")
def byte_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = bytebpe.encoded(docs, wanted=("ids", "id_text", "decoded"))
    return found.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("id_text", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(
    "op13_conversation_trie",
    """
    WITH RECURSIVE crc(i, k, v) AS (
      SELECT i, 0, i FROM range(256) x(i)
      UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc WHERE k < 8
    ), steps AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM crc WHERE k = 8),
    turns AS (
      SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS own
      FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
    ), lent AS (
      SELECT c, own, xor(list_reduce(
               list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
               lambda s, x: xor(s >> 8, t[(xor(s, x) & 255) + 1])), 4294967295) % 4 AS h
      FROM turns, steps
    ), rebuilt AS MATERIALIZED (
      SELECT l.c, list_concat(coalesce(f.own[1:l.h], []), coalesce(l.own[l.h + 1:], [])) AS seq
      FROM lent l LEFT JOIN turns f ON f.c = l.c - l.c % 20
    ), ways AS MATERIALIZED (
      SELECT c, d, sha256(CAST(seq[1:d] AS VARCHAR)) AS key, seq[d].t AS said, len(seq) AS n
      FROM rebuilt, LATERAL (SELECT unnest(range(0, len(seq) + 1)) AS d)
    ), nodes AS MATERIALIZED (
      SELECT d, key, min(c) AS rep, count(*) AS n_convs,
             CASE WHEN d = 0 THEN 0 ELSE len(list_filter(regexp_split_to_array(any_value(said), '[ \t-\r]+'), lambda x: x <> '')) END AS words,
             max(n) = d AS leaf, list(c ORDER BY c) FILTER (WHERE n = d) AS ends
      FROM ways GROUP BY d, key
    ), subtrees AS (
      SELECT a.d, a.key, sum(CAST(b.leaf AS BIGINT)) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved_tokens
      FROM nodes b JOIN ways w ON w.c = b.rep AND w.d <= b.d JOIN nodes a ON a.d = w.d AND a.key = w.key GROUP BY a.d, a.key
    ), parents AS (
      SELECT n.d, n.key, p.rep AS up FROM nodes n JOIN ways w ON w.c = n.rep AND w.d = n.d - 1 JOIN nodes p ON p.d = w.d AND p.key = w.key
    ), children AS (SELECT d - 1 AS d, up, count(*) AS n_children FROM parents GROUP BY ALL)
    SELECT n.rep AS conv_id, n.d AS depth, p.up AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
           CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
           sha256(coalesce(array_to_string(n.ends, ','), '')) AS ends_sha256
    FROM nodes n JOIN subtrees s USING (d, key) LEFT JOIN parents p USING (d, key) LEFT JOIN children k ON k.d = n.d AND k.up = n.rep
    """,
)
def conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixtrie.summary(table(spark, folder, "conversations"))
