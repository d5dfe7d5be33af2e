"""DuckDB SQL that each query of the catalog is checked against."""

from __future__ import annotations

from postlens.functions.stopwords import REPORT_STOP_WORDS

# Spark's default English stop words, without those that hold an
# apostrophe, which no token can hold.
_ENGLISH = """
    i me my myself we our ours ourselves you your yours yourself yourselves
    he him his himself she her hers herself it its itself they them their
    theirs themselves what which who whom this that these those am is are was
    were be been being have has had having do does did doing a an the and but
    if or because as until while of at by for with about against between into
    through during before after above below to from up down in out on off over
    under again further then once here there when where why how all any both
    each few more most other some such no nor not only own same so than too
    very s t can will just don should now
""".split()


def _words(names) -> str:
    return ", ".join(f"'{w}'" for w in names)


_LINES = r"""
lines AS (
  SELECT doc_id, lang, source, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS line
  FROM (SELECT doc_id, lang, source, string_split(text, chr(10)) AS l FROM documents)
)"""

_POSTS = _LINES + r""",
posts AS (
  SELECT doc_id AS subject_id, CAST(pos AS INTEGER) AS pos, trim(line, ' ') AS text FROM lines
),
labelled AS (
  SELECT p.subject_id, p.pos, p.text, l.toxic AS label
  FROM posts p JOIN labels l ON l.doc_id = p.subject_id
)"""

_FLAT = r"""
  lang AS title,
  strftime(TRY_CAST(
    '2024-01-' || lpad(CAST(pos % 28 + 1 AS VARCHAR), 2, '0') || ' '
    || lpad(CAST(doc_id % 30 AS VARCHAR), 2, '0') || ':30:00' AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS date,
  source AS source_info, trim(line, ' ') AS text"""

_CELLS = r"""
cells AS (
  SELECT l.toxic AS label, CAST(dayofweek(e.ts) + 1 AS INTEGER) AS day,
         CAST(hour(e.ts) AS INTEGER) AS hour, count(*) AS count
  FROM events e JOIN labels l ON l.doc_id = e.user_id
  GROUP BY ALL
)"""

_GRID = _CELLS + r""",
grid AS (
  SELECT g.label, g.day, ['Dom', 'Lun', 'Mar', 'Mer', 'Gio', 'Ven', 'Sab'][g.day] AS day_name, g.hour,
         coalesce(c.count, 0) AS count
  FROM (SELECT CAST(a.v AS INTEGER) AS label, CAST(d.v AS INTEGER) AS day, CAST(h.v AS INTEGER) AS hour
        FROM range(0, 2) a(v), range(1, 8) d(v), range(0, 24) h(v)) g
  LEFT JOIN cells c ON c.label = g.label AND c.day = g.day AND c.hour = g.hour
)"""

_TOKENS = r"list_filter(regexp_split_to_array(lower({text}), '\W+'), lambda x: x <> '')"
_FILTERED = (
    r"list_filter(regexp_split_to_array(lower({text}), '\W+'), lambda x: x <> '' AND x NOT IN ("
    + _words(_ENGLISH)
    + "))"
)

_FREQUENCY = (
    _POSTS
    + r""",
frequency AS (
  SELECT label, word, count(*) AS count
  FROM (SELECT label, unnest(list_filter(regexp_split_to_array(lower(text), '\W+'),
          lambda x: length(x) > 2 AND x NOT IN ("""
    + _words(REPORT_STOP_WORDS)
    + r"""))) AS word FROM labelled)
  GROUP BY ALL
)"""
)

_TERMS = (
    r"""
counts AS (
  SELECT doc_id, word, count(*) AS n
  FROM (SELECT doc_id, unnest("""
    + _FILTERED.format(text="text")
    + r""") AS word FROM documents)
  GROUP BY ALL
),
docs AS (SELECT count(*) AS m FROM documents),
vocab AS (
  SELECT word, count(*) AS df, CAST(sum(n) AS BIGINT) AS n
  FROM counts GROUP BY word
  HAVING count(*) BETWEEN 5 AND 0.75 * (SELECT m FROM docs)
),
weights AS (
  SELECT word, df, ln(((SELECT m FROM docs) + 1) / (df + 1)) AS idf FROM vocab
)"""
)

_SPLIT = r"""
parts AS (
  SELECT doc_id AS subject_id, toxic AS label,
         CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80 AS is_train,
         CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':sample'), 1, 8) AS BIGINT) AS bits
  FROM labels
)"""

# The balanced training subjects and the test subjects, and the model's vocabulary.
_ROLES = (
    _SPLIT
    + r""",
sizes AS (
  SELECT label, count(*) AS own, min(count(*)) OVER () AS smaller
  FROM parts WHERE is_train AND label IN (0, 1) GROUP BY label
),
roles AS (
  SELECT subject_id, label, is_train FROM parts LEFT JOIN sizes USING (label)
  WHERE NOT is_train OR bits < CAST(smaller AS DOUBLE) / own * 4294967296
)"""
)

_MODEL_WORDS = (
    _ROLES
    + r""",
model_counts AS (
  SELECT subject_id, label, is_train, word, count(*) AS n
  FROM (SELECT subject_id, label, is_train, unnest("""
    + _FILTERED.format(text="text")
    + r""") AS word FROM roles JOIN documents ON doc_id = subject_id)
  GROUP BY ALL
),
model_vocab AS (
  SELECT word, sum(n) AS n FROM model_counts WHERE is_train GROUP BY word
  HAVING count(*) BETWEEN 5 AND 0.75 * (SELECT count(*) FROM roles WHERE is_train)
  ORDER BY n DESC, word LIMIT 5000
),
model_index AS (
  SELECT word, CAST(row_number() OVER (ORDER BY n DESC, word) - 1 AS INTEGER) AS index FROM model_vocab
)"""
)

# Words that occur at least five times in the training subjects.
_VECTOR_WORDS = r"""
vector_words AS (
  SELECT word FROM model_counts WHERE is_train GROUP BY word HAVING sum(n) >= 5
)"""

_PREDICTIONS = f"""
WITH {_ROLES}
SELECT subject_id, label, NOT is_train AS agrees, NOT is_train AS in_range FROM roles WHERE NOT is_train"""

_METRIC_RANGES = f"""
WITH {_ROLES}
SELECT metric_name, count(*) AS n_test, bool_and(NOT is_train) AS in_range
FROM roles, (VALUES ('accuracy'), ('f1_score'), ('weighted_precision'), ('weighted_recall')) m(metric_name)
WHERE NOT is_train GROUP BY metric_name"""

_CLEAN = r"regexp_replace(regexp_replace(lower({text}), 'http\S+', '', 'g'), '[^a-zA-Z\s]', '', 'g')"

_ETL = (
    _POSTS
    + r""",
cleaned AS (SELECT subject_id, pos, label, """
    + _CLEAN.format(text="text")
    + r""" AS clean_text FROM labelled),
done AS (
  SELECT subject_id, pos, label,
         """
    + _TOKENS.format(text="clean_text")
    + r""" AS words,
         """
    + _FILTERED.format(text="clean_text")
    + r""" AS filtered
  FROM cleaned
)"""
)

_MATRIX = r"""
rule AS (
  SELECT l.toxic AS label, CAST(contains(lower(d.text), 'worthless') AS INTEGER) AS prediction
  FROM documents d JOIN labels l USING (doc_id)
),
matrix AS (SELECT label, prediction, count(*) AS count FROM rule GROUP BY ALL),
classes AS (
  SELECT c AS cls,
         (SELECT coalesce(sum(count), 0) FROM matrix WHERE label = c) AS support,
         (SELECT coalesce(sum(count), 0) FROM matrix WHERE prediction = c) AS predicted,
         (SELECT coalesce(sum(count), 0) FROM matrix WHERE label = c AND prediction = c) AS hits
  FROM (SELECT label AS c FROM matrix UNION SELECT prediction FROM matrix)
),
scores AS (
  SELECT support, hits,
         CASE WHEN predicted = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / predicted END AS p,
         CASE WHEN support = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / support END AS r
  FROM classes
),
metrics AS (
  SELECT sum(hits) / sum(support) AS accuracy,
         sum(support * CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END) / sum(support) AS f1_score,
         sum(support * p) / sum(support) AS weighted_precision,
         sum(support * r) / sum(support) AS weighted_recall
  FROM scores
)"""

_NEAR = r"""
seeds AS (SELECT vec_id FROM embeddings WHERE vec_id % 50 = 0),
pairs AS (
  SELECT s.vec_id AS seed, v.vec_id,
         list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) AS similarity
  FROM seeds s JOIN embeddings e ON e.vec_id = s.vec_id, embeddings v
  WHERE v.vec_id <> s.vec_id
)"""

ORACLES: dict[str, str] = {
    "xml_posts_roundtrip": f"""
WITH {_LINES}
SELECT CAST(doc_id AS VARCHAR) AS subject_id, 1 AS chunk, CAST(pos AS INTEGER) AS pos, {_FLAT} FROM lines""",
    "xml_single_writings": r"""
SELECT CAST(doc_id AS VARCHAR) AS subject_id, 0 AS pos, CAST(length(trim(text, ' ')) AS INTEGER) AS n_chars,
       md5(trim(text, ' ')) AS text_md5
FROM documents WHERE source NOT IN ('src0', 'src1')""",
    "xml_sections": """
    SELECT CAST(doc_id AS VARCHAR) AS subject_id, CAST(length(t) AS INTEGER) AS n_chars, md5(t) AS text_md5, CAST(0 AS BIGINT) AS rejects
    FROM (SELECT doc_id, '</INDIVIDUAL><INDIVIDUAL>' || text || '<INDIVIDUAL>' AS t FROM documents)""",
    "xml_rejects": r"""
SELECT CAST(doc_id AS VARCHAR) AS subject_id,
       CASE source WHEN 'src1' THEN 'no closing tag' ELSE 'not well-formed' END AS reason
FROM documents WHERE source IN ('src0', 'src1')""",
    "label_parse": r"""
SELECT CAST(doc_id AS VARCHAR) AS subject_id, toxic AS label
FROM labels JOIN documents USING (doc_id)""",
    "label_line_rejects": r"""
SELECT CASE WHEN lang = 'de' THEN doc_id || '  x' ELSE CAST(doc_id AS VARCHAR) END AS value
FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "view_roundtrip": f"""
WITH {_CELLS}
SELECT label, day, hour, count, format FROM cells, (VALUES ('csv'), ('parquet')) f(format)""",
    "dashboard_scatter": f"""
WITH {_POSTS}
SELECT CAST(subject_id AS VARCHAR) AS subject_id, label, avg(len(string_split(text, ' '))) AS avg_len
FROM labelled GROUP BY ALL""",
    "flatten_posts": f"""
WITH {_LINES}
SELECT doc_id AS subject_id, CAST(pos AS INTEGER) AS pos, {_FLAT} FROM lines""",
    "labelled_posts": f"WITH {_POSTS} SELECT subject_id, pos, text, label FROM labelled",
    "labelled_posts_salted": f"WITH {_POSTS} SELECT subject_id, pos, text, label FROM labelled",
    "posts_by_class": f"WITH {_POSTS} SELECT subject_id, pos, text, label FROM labelled WHERE label = 1",
    "clean_text": f"SELECT doc_id, {_CLEAN.format(text='text')} AS clean_text FROM documents",
    "word_count": r"""
SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS word_count FROM documents""",
    "short_posts_filter": f"""
WITH {_POSTS} SELECT subject_id, pos, text FROM posts WHERE len(string_split(text, ' ')) >= 3""",
    "tokens": f"""
SELECT doc_id, CAST(len(w) AS INTEGER) AS n_words, array_to_string(w, ' ') AS words
FROM (SELECT doc_id, {_TOKENS.format(text='text')} AS w FROM documents)""",
    "tokens_filtered": f"""
SELECT doc_id, CAST(len(w) AS INTEGER) AS n_words, array_to_string(w, ' ') AS words
FROM (SELECT doc_id, {_FILTERED.format(text='text')} AS w FROM documents)""",
    "etl_process": f"""
WITH {_ETL}
SELECT subject_id, pos, label, CAST(len(words) AS INTEGER) AS n_words,
       array_to_string(filtered, ' ') AS filtered_words
FROM done""",
    "preview": f"""
WITH {_ETL}
SELECT subject_id, pos, label, array_to_string(filtered, ' ') AS keywords
FROM done ORDER BY subject_id, pos LIMIT 5""",
    "class_counts": f"""
WITH {_POSTS}
SELECT count(*) AS total_posts, count(*) FILTER (label = 1) AS class1_posts,
       count(*) - count(*) FILTER (label = 1) AS control_posts
FROM labelled""",
    "class_imbalance": f"""
WITH {_SPLIT}
SELECT count(*) AS n_rows, count(*) FILTER (label = 1) AS n_class1, count(*) FILTER (label = 0) AS n_class0,
       round(count(*) FILTER (label = 1) / nullif(count(*) FILTER (label = 0), 0) * 100, 6) AS imbalance_pct
FROM parts WHERE is_train AND subject_id IN (SELECT doc_id FROM documents)""",
    "kpi": f"""
WITH {_POSTS}
SELECT count(*) AS total_posts, round(avg(label), 6) AS risk_ratio,
       round(avg(len(string_split(text, ' '))), 6) AS avg_length
FROM labelled""",
    "kpi_by_class": f"""
WITH {_POSTS}
SELECT label, count(*) AS total_posts, round(avg(len(string_split(text, ' '))), 6) AS avg_length
FROM labelled GROUP BY label""",
    "kpi_cards": f"""
WITH {_POSTS}, {_MATRIX}
SELECT count(*) AS total_posts, round(avg(label), 6) AS risk_ratio,
       round(avg(len(string_split(text, ' '))), 6) AS avg_length,
       round(coalesce((SELECT f1_score FROM metrics), 0.0), 6) AS f1_score
FROM labelled""",
    "subject_verbosity": f"""
WITH {_POSTS}
SELECT subject_id, label, round(avg(len(string_split(text, ' '))), 6) AS avg_len
FROM labelled GROUP BY ALL""",
    "heatmap_all": f"WITH {_CELLS} SELECT label, day, hour, count FROM cells",
    "heatmap_class0": f"WITH {_CELLS} SELECT day, hour, count FROM cells WHERE label = 0 ORDER BY day, hour",
    "heatmap_class1": f"WITH {_CELLS} SELECT day, hour, count FROM cells WHERE label = 1 ORDER BY day, hour",
    "heatmap_grid": f"WITH {_GRID} SELECT label, day, day_name, hour, CAST(count AS BIGINT) AS count FROM grid",
    "heatmap_matrix": f"WITH {_GRID} SELECT label, day, day_name, "
    + ", ".join(f"CAST(sum(count) FILTER (hour = {h}) AS BIGINT) AS h{h}" for h in range(24))
    + " FROM grid GROUP BY ALL",
    "hourly_share_by_class": f"""
WITH {_CELLS},
per_hour AS (SELECT label, hour, CAST(sum(count) AS BIGINT) AS count FROM cells GROUP BY ALL)
SELECT label, hour, count, round(count / sum(count) OVER (PARTITION BY label), 6) AS share FROM per_hour""",
    "top_words": f"""
WITH {_FREQUENCY}
SELECT label, word, count FROM frequency
QUALIFY row_number() OVER (PARTITION BY label ORDER BY count DESC, word) <= 100""",
    "top_words_antijoin": f"""
WITH {_FREQUENCY}
SELECT label, word, count FROM frequency
QUALIFY row_number() OVER (PARTITION BY label ORDER BY count DESC, word) <= 100""",
    "word_frequency": f"WITH {_FREQUENCY} SELECT label, word, count FROM frequency",
    "subject_corpus": r"""
SELECT conv_id, turn // 1024 AS segment, string_agg(text, ' ' ORDER BY turn, text) AS all_text
FROM conversations GROUP BY ALL""",
    "subject_corpus_segments": r"""
SELECT conv_id, turn // 4 AS segment, string_agg(text, ' ' ORDER BY turn, text) AS all_text
FROM conversations GROUP BY ALL""",
    "subject_corpus_records": r"""
SELECT CASE WHEN conv_id % 3 = 0 THEN -1 ELSE conv_id END AS subject_id, conv_id, turn // 4 AS segment,
       string_agg(text, ' ' ORDER BY turn, text) AS all_text
FROM conversations GROUP BY ALL""",
    "subject_rope": """
WITH whole AS (SELECT source, string_agg(text, ' ' ORDER BY doc_id) AS t FROM documents GROUP BY source),
cut AS (
  SELECT source, chunk, substr(t, 4096 * chunk + 1, 4096) AS piece, length(t) AS total_chars
  FROM (SELECT source, t, unnest(range(0, CAST(greatest(1, ceil(length(t) / 4096)) AS BIGINT))) AS chunk FROM whole)
)
SELECT source, chunk, 4096 * chunk AS start, length(piece) AS n_chars, total_chars, md5(piece) AS text_md5 FROM cut""",
    "term_counts": f"WITH {_TERMS} SELECT doc_id, word, n FROM counts",
    "token_counts": f"WITH {_TERMS} SELECT doc_id, word, n FROM counts",
    "vocabulary": f"WITH {_TERMS} SELECT word, df, n FROM vocab",
    "vocab_head_tail": f"""
WITH {_TERMS}
SELECT * FROM (SELECT 'head' AS part, word, df, n FROM vocab ORDER BY n DESC, word LIMIT 10)
UNION ALL
SELECT * FROM (SELECT 'tail' AS part, word, df, n FROM vocab ORDER BY n, word DESC LIMIT 10)""",
    "idf": f"WITH {_TERMS} SELECT word, df, round(idf, 6) AS idf FROM weights",
    "tfidf": f"""
WITH {_TERMS}
SELECT c.doc_id, c.word, c.n, round(w.idf, 6) AS idf, round(c.n * w.idf, 6) AS tfidf
FROM counts c JOIN weights w USING (word)""",
    "tfidf_of_counts": f"""
WITH {_TERMS}
SELECT c.doc_id, c.word, c.n, round(w.idf, 6) AS idf, round(c.n * w.idf, 6) AS tfidf
FROM counts c JOIN weights w USING (word)""",
    "train_test_split": f"""
WITH {_SPLIT} SELECT subject_id, label, CASE WHEN is_train THEN 'train' ELSE 'test' END AS part FROM parts""",
    "balanced_train": f"""
WITH {_SPLIT},
train AS (SELECT * FROM parts WHERE is_train AND label IN (0, 1)),
sizes AS (SELECT label, count(*) AS own, min(count(*)) OVER () AS smaller FROM train GROUP BY label)
SELECT t.subject_id, t.label FROM train t JOIN sizes s USING (label)
WHERE t.bits < CAST(s.smaller AS DOUBLE) / s.own * 4294967296""",
    "balanced_train_exact": f"""
WITH {_SPLIT},
train AS (SELECT * FROM parts WHERE is_train AND label IN (0, 1)),
ranked AS (SELECT subject_id, label, row_number() OVER (PARTITION BY label ORDER BY bits, subject_id) AS rank FROM train),
sizes AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM train GROUP BY label))
SELECT subject_id, label FROM ranked WHERE rank <= (SELECT n FROM sizes)""",
    "model_roles": f"WITH {_ROLES} SELECT subject_id, label, is_train FROM roles",
    "model_vocabulary": f"WITH {_MODEL_WORDS} SELECT index, word FROM model_index",
    "count_vectors": f"""
WITH {_MODEL_WORDS}
SELECT subject_id, label, is_train, index, CAST(n AS DOUBLE) AS n
FROM model_counts JOIN model_index USING (word)""",
    "model_save_load": f"""
WITH {_ROLES}
SELECT model, count(*) AS n_test, count(*) FILTER (is_train) AS n_changed
FROM roles, (VALUES ('tfidf'), ('embedding')) m(model) WHERE NOT is_train GROUP BY model""",
    "lr_predictions": _PREDICTIONS,
    "rf_predictions": _PREDICTIONS,
    "lr_metrics": _METRIC_RANGES,
    "rf_metrics": _METRIC_RANGES,
    "lr_certificate": f"WITH {_ROLES} SELECT count(*) AS n_test, TRUE AS replayed, TRUE AS converged, TRUE AS varied FROM roles WHERE NOT is_train",
    "rf_certificate": f"WITH {_ROLES} SELECT count(*) AS n_test, TRUE AS replayed, TRUE AS varied FROM roles WHERE NOT is_train",
    "doc_embedding": f"""
WITH {_MODEL_WORDS}
SELECT r.subject_id, r.label, r.is_train, CAST(coalesce(sum(c.n), 0) AS BIGINT) AS n_words,
       count(*) FILTER (c.n < 0) AS differs
FROM roles r LEFT JOIN model_counts c USING (subject_id, label, is_train) GROUP BY ALL""",
    "word2vec_vocabulary": f"WITH {_MODEL_WORDS}, {_VECTOR_WORDS} SELECT word FROM vector_words",
    "similar_words": f"""
WITH {_MODEL_WORDS}, {_VECTOR_WORDS}, {_FREQUENCY},
seeds AS (
  SELECT word, sum(count) AS n FROM frequency WHERE word IN (SELECT word FROM vector_words)
  GROUP BY word ORDER BY n DESC, word LIMIT 7
)
SELECT word AS seed, least(10, (SELECT count(*) FROM vector_words) - 1) AS n_neighbours,
       count(*) FILTER (n < 0) AS n_odd
FROM seeds GROUP BY word""",
    "similar_words_top20": f"""
WITH {_NEAR},
near AS (
  SELECT seed, vec_id, similarity FROM pairs
  QUALIFY row_number() OVER (PARTITION BY seed ORDER BY similarity DESC, vec_id) <= 10
)
SELECT vec_id, round(max(similarity), 5) AS similarity FROM near
GROUP BY vec_id ORDER BY max(similarity) DESC, vec_id LIMIT 20""",
    "confusion_matrix": f"WITH {_MATRIX} SELECT label, prediction, count FROM matrix",
    "classification_metrics": f"""
WITH {_MATRIX}
SELECT 'accuracy' AS metric_name, round(accuracy, 6) AS value FROM metrics
UNION ALL SELECT 'f1_score', round(f1_score, 6) FROM metrics
UNION ALL SELECT 'weighted_precision', round(weighted_precision, 6) FROM metrics
UNION ALL SELECT 'weighted_recall', round(weighted_recall, 6) FROM metrics""",
    "similar_vectors": f"""
WITH {_NEAR}
SELECT seed, vec_id, round(similarity, 5) AS similarity FROM pairs
QUALIFY row_number() OVER (PARTITION BY seed ORDER BY similarity DESC, vec_id) <= 10""",
    "best_neighbours": f"""
WITH {_NEAR},
near AS (
  SELECT seed, vec_id, similarity FROM pairs WHERE similarity >= 0.2
  QUALIFY row_number() OVER (PARTITION BY seed ORDER BY similarity DESC, vec_id) <= 10
)
SELECT vec_id, round(max(similarity), 5) AS similarity FROM near
GROUP BY vec_id ORDER BY max(similarity) DESC, vec_id LIMIT 50""",
}
ORACLES["dashboard_metrics"] = f"SELECT metric_name, CAST(value AS FLOAT) AS value FROM ({ORACLES['classification_metrics']})"
ORACLES["dashboard_semantic_words"] = f"""
SELECT 'v' || vec_id AS word, CAST(similarity AS FLOAT) AS similarity FROM ({ORACLES['best_neighbours']})"""
