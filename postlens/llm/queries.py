"""The operators as queries over whole tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm import (
    conversation_repair,
    decontaminate,
    fingerprints,
    packing,
    quality,
    secret_scan,
    shingle_join,
    spelling,
    token_counts,
    token_store,
    vector_graph,
    warc,
    wrappers,
)
from postlens.sources.staging import stage, staging_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_secret_scan(spark, sf_dir):
    return secret_scan.digest(secret_scan.scan_secrets(table(spark, sf_dir, "documents")))


def op3_token_counts(spark, sf_dir):
    pieces = token_counts.load_pieces(tokenizer_path("piece_bpe_32k.model"))
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), pieces)


def op4_warc_derivatives(spark, sf_dir):
    """Metadata and conversion records of all pages, whole."""
    records = warc.derive(warc.responses(table(spark, sf_dir, "pages")))
    return records.withColumn("page_id", F.col("source_id").cast("long")).select(
        "page_id", "warc_type", "record_id", "refers_to", "target_uri", "content_type", "source_digest", "block_digest",
        "content_length", F.md5("source_headers").alias("headers_md5"), "warc_date", "source_headers", "block",
    )


def op5_quality_classifier(spark, sf_dir):
    """Sites are the documents' sources, paths the languages within them."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, quality.bad_labels(table(spark, sf_dir, "labels")))
    scored = quality.evidence(docs.select("doc_id", "text", "source", "lang"), model, "text", "log_odds").drop("text")
    scored = stage(scored, staging_path(spark, "quality"))
    groups, _ = quality.group_posteriors(scored, "source", "lang", "log_odds")
    judged = quality.posterior(scored, groups, "source", "lang", "log_odds")
    return judged.select(
        "doc_id",
        F.round("log_odds", 6).alias("log_odds"),
        F.round("path_share", 6).alias("path_share"),
        F.round("p_bad", 6).alias("p_bad"),
        (F.col("p_bad") < quality.CUT).alias("keep"),
    )


def op6_main_text(spark, sf_dir):
    text = wrappers.extract(table(spark, sf_dir, "pages"))
    return text.withColumn("n_chars", F.length("text").cast("long"))


def op7_token_files(spark, sf_dir):
    folder = token_store.token_folder(spark)
    files = token_store.write_tokens(table(spark, sf_dir, "documents"), tokenizer_path(), folder)
    return token_store.read_boundaries(files)


def op8_benchmark_decontamination(spark, sf_dir):
    return decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_nearest_neighbours(spark, sf_dir):
    return vector_graph.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op10_ngram_jaccard_join(spark, sf_dir):
    return shingle_join.link_components(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark, sf_dir):
    return spelling.variants(spelling.count_words(table(spark, sf_dir, "documents")))


def op12_document_fingerprints(spark, sf_dir):
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark, sf_dir):
    rows = conversation_repair.damage(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair(rows).withColumnRenamed("conv", "conv_id")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_secret_scan,
        op3_token_counts,
        op4_warc_derivatives,
        op5_quality_classifier,
        op6_main_text,
        op7_token_files,
        op8_benchmark_decontamination,
        op9_nearest_neighbours,
        op10_ngram_jaccard_join,
        op11_spelling_variants,
        op12_document_fingerprints,
        op13_conversation_repair,
    )
}


def _shingles(source: str, key: str, width: int) -> str:
    """SQL for the distinct shingles ``(key, s)`` of ``width`` words of a table's texts."""
    return f"""
    SELECT DISTINCT {key}, unnest(
        CASE WHEN len(w) = 0 THEN []
             WHEN len(w) < {width} THEN [list_aggregate(w, 'string_agg', ' ')]
             ELSE list_transform(range(1, len(w) - {width - 2}),
                                 lambda i: list_aggregate(w[i:i + {width - 1}], 'string_agg', ' '))
        END) AS s
    FROM (SELECT {key}, list_filter(string_split_regex(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM {source})"""


def _matches(name: str, pattern: str, group: int = 0) -> str:
    """SQL for the leftmost matches ``(doc_id, t, place, m, g)`` of a pattern: place, text, and text of a group."""
    quoted = pattern.replace("'", "''")
    return f"""
    {name} AS (
      SELECT doc_id, t, m, g,
             sum(length(p)) OVER (PARTITION BY doc_id ORDER BY i)
             + coalesce(sum(length(m)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
      FROM (SELECT doc_id, t, unnest(ms) AS m, unnest(gs) AS g, unnest(ps[:len(ms)]) AS p, generate_subscripts(ms, 1) AS i
            FROM (SELECT doc_id, t, regexp_extract_all(t, '{quoted}') AS ms, regexp_extract_all(t, '{quoted}', {group}) AS gs,
                         string_split_regex(t, '{quoted}') AS ps
                  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))))"""


_VALUE = "[A-Za-z0-9+/_.=-]+"
_HEAD = secret_scan.RULES[0].pattern.removesuffix("[A-Za-z0-9+/_.=-]")

_SECRETS = f"""
    WITH {_matches("whole", f"{_HEAD}({_VALUE})", 1)},
    {_matches("heads", _HEAD)},
    {_matches("access", "AKIA[A-Z0-9]+")},
    {_matches("hex", "[0-9a-f]{24,}")},
    candidates AS (
      SELECT doc_id, place, place + length(m) + length(v) AS stop, length(v) AS size
      FROM (SELECT doc_id, place, m, regexp_extract(substr(t, CAST(place + length(m) + 1 AS BIGINT)), '^{_VALUE}') AS v FROM heads)
      WHERE v <> ''
    ),
    assign AS (
      SELECT doc_id, place, stop, base FROM (
        SELECT c.doc_id, c.place, c.stop, w.place IS NOT NULL AS base, max(c.stop) OVER (
                 PARTITION BY c.doc_id ORDER BY c.place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS covered
        FROM candidates c LEFT JOIN whole w ON w.doc_id = c.doc_id AND w.place = c.place WHERE c.size >= 6)
      WHERE base OR covered IS NULL OR stop > covered
    ),
    spans AS (
      SELECT doc_id, 1 AS rank, 'assign' AS kind, place, stop, base FROM assign
      UNION ALL SELECT doc_id, 2, 'access', place, place + length(m), TRUE FROM access WHERE length(m) >= 20
      UNION ALL SELECT doc_id, 3, 'hex', place, place + length(m), TRUE FROM hex
    ),
    texts AS (
      SELECT doc_id, rank, kind, place, base, kind || ':' || CAST(place AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span FROM spans
    )
    SELECT d.doc_id, count(*) FILTER (base AND kind = 'assign') AS n_assign, count(*) FILTER (base AND kind = 'access') AS n_access,
           count(*) FILTER (base AND kind = 'hex') AS n_hex,
           sha256(coalesce(string_agg(span, ',' ORDER BY place, rank) FILTER (base), '')) AS base_sha256,
           coalesce(string_agg(span, ',' ORDER BY place, rank), '') AS spans
    FROM documents d LEFT JOIN texts USING (doc_id) GROUP BY d.doc_id"""

ORACLES: dict[str, str] = {
    "op2_secret_scan": _SECRETS,
    "op8_benchmark_decontamination": f"""
    WITH d AS ({_shingles("documents", "doc_id", 5)}),
    b AS ({_shingles("benchmark", "item_id", 5)}),
    n AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id)
    SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
    FROM (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN b USING (s) GROUP BY doc_id, item_id)
    JOIN n USING (item_id) WHERE 5 * n_shared >= 4 * n_item""",
    "op10_ngram_jaccard_join": f"""
    WITH RECURSIVE s AS ({_shingles("documents", "doc_id", 3)}),
    n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
    pairs AS (
      SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
      FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
    ),
    links AS (
      SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
      WHERE 100 * shared >= 90 * (p.c + q.c - shared)
    ),
    both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
    reach(node, label) AS (
      SELECT doc_id, doc_id FROM documents
      UNION SELECT y, label FROM reach JOIN both_ways ON x = node
    )
    SELECT doc_id, coalesce(c, 0) AS n_shingles, component_id
    FROM (SELECT node AS doc_id, min(label) AS component_id FROM reach GROUP BY node) LEFT JOIN n USING (doc_id)""",
}
