"""Document quality by hierarchical empirical Bayes: text evidence, host and path posteriors.

1. *Evidence.*  Every text becomes a few shape measures (symbols, capitals, digits, repeated
   words, ...) and the largest weight of the words it holds.  An additive logistic model over
   binned measures turns them into the log odds that a document is bad, prior removed.
2. *Groups.*  Bad shares are estimated for paths, hosts and the whole corpus by grouped
   aggregation of the document probabilities.  A host's share is shrunk towards the global
   one and a path's towards its host's, by a prior strength estimated from how much the
   groups differ (method of moments); sparse groups end near their parent.
3. *Decision.*  Posterior odds = evidence x prior odds of the document's path, computed
   without the document itself.

The model is fitted on a bounded sample of labelled rows (``MAX_LABELLED``, the smallest key
hashes); everything else covers all rows.

Defined results: null text is empty text; null host or path is a group of its own; repeated
rows count each; texts of any length count whole; equal evidence gives equal decisions within a
path.  Labels of one class only, none at all, or none of a given document say nothing: the
evidence is 0 everywhere, every probability is one half, and all documents stay.  Extra columns
may have any name.  Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.batches import bounded, slices, small_side, split_words
from postlens.sources.staging import stage, staging_path

# Bounds of the fit: labelled rows, and words that may get a weight.
MAX_LABELLED = 50_000
MAX_WORDS = 20_000

# Documents whose posterior probability of being bad reaches this are rejected.
CUT = 0.7

# A word gets a weight if its log odds towards bad exceed this by twice their standard error.
MIN_LOG_ODDS = 1.5

# Words that begin alike share a second weight, so inflected forms need not be frequent each.
PREFIX = 5
BINS = 10
MEASURES = ("symbols", "capitals", "digits", "distinct", "commonest", "length", "bare", "words", "lexical")

# Bytes that are no sign of noise in prose.
_PLAIN = b" \t\n\r\v\f.,;:!?'\"()-"
_STRIP = ".,;:!?'\"()[]{}-#$%&*|<>"


def _byte_kinds() -> np.ndarray:
    """1 symbol, 2 capital, 3 digit, 4 small letter or part of a longer character."""
    kind = np.zeros(256, dtype=np.uint8)
    kind[33:127] = 1
    kind[list(_PLAIN)] = 0
    kind[65:91], kind[48:58], kind[97:123], kind[128:] = 2, 3, 4, 4
    return kind


_KINDS = _byte_kinds()


def measures(texts: pa.Array, weights: dict[str, float]) -> np.ndarray:
    """One row of ``MEASURES`` per text."""
    n = len(texts)
    raw = texts.cast(pa.large_binary())
    bounds = np.frombuffer(raw.buffers()[1], dtype=np.int64, count=n + 1, offset=raw.offset * 8)
    body = raw.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8)[bounds[0] : bounds[-1]] if body else np.empty(0, np.uint8)
    bounds = bounds - bounds[0]
    kinds = _KINDS[data]
    # Capitals of two bytes, such as accented Latin letters, by their second byte.
    kinds[1:][(data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)] = 2
    shares = []
    size = np.maximum(1, np.diff(bounds))
    for kind in (1, 2, 3):
        total = np.concatenate([[0], np.cumsum(kinds == kind)])
        shares.append((total[bounds[1:]] - total[bounds[:-1]]) / size)

    codes, words, offsets = split_words(texts)
    counts = np.diff(offsets)
    rows = np.repeat(np.arange(n), counts)
    many = np.maximum(1, counts)
    # Distinct words of each row, with how often the row has them.
    order = np.argsort(rows * (len(words) + 1) + codes, kind="stable")
    r, c = rows[order], codes[order]
    fresh = np.concatenate([[True], (r[1:] != r[:-1]) | (c[1:] != c[:-1])])[: len(r)]
    first = np.flatnonzero(fresh)
    times = np.diff(np.append(first, len(r)))
    r, c = r[first], c[first]
    distinct = np.bincount(r, minlength=n) / many
    commonest = np.zeros(n)
    np.maximum.at(commonest, r, times)
    lengths = np.asarray(pc.utf8_length(words), dtype=np.float64)
    bare = ~np.asarray(pc.match_substring_regex(words, r"[\p{L}\p{N}]").to_numpy(zero_copy_only=False), dtype=bool)
    known = weights.get
    own = np.fromiter(
        (max(known(w, 0.0), known(w[:PREFIX] + "*", 0.0)) for w in stems(words)), dtype=np.float64, count=len(words)
    )
    lexical = np.zeros(n)
    np.maximum.at(lexical, r, own[c])
    sums = lambda values: np.bincount(rows, weights=values[codes], minlength=n)
    return np.column_stack(
        [
            *shares,
            distinct,
            commonest / many,
            sums(lengths) / many,
            sums(bare.astype(np.float64)) / many,
            np.log1p(counts),
            lexical,
        ]
    )


def stems(words: pa.Array) -> list[str]:
    """Words in lower case without the punctuation around them."""
    return pc.utf8_trim(pc.utf8_lower(words), _STRIP).to_pylist()


def _edges(column: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bin edges: deciles, what good documents hardly ever exceed, and quartiles of values above 0."""
    parts = [np.quantile(column, np.arange(1, BINS) / BINS), np.quantile(column[y == 0], [0.002, 0.998])]
    above = column[column > 0]
    if len(above) < len(column) / 2 and len(above):
        parts.append(np.quantile(above, [0, 0.25, 0.5, 0.75]))
    return np.unique(np.concatenate(parts))


class Model(NamedTuple):
    weights: dict[str, float]
    edges: list[np.ndarray]
    scores: list[np.ndarray]
    intercept: float

    def log_odds(self, texts: pa.Array) -> np.ndarray:
        """Log odds that a text is bad, for even prior odds."""
        table = measures(texts, self.weights)
        total = np.full(len(table), self.intercept)
        for column, edges, score in zip(table.T, self.edges, self.scores, strict=True):
            total += score[np.searchsorted(edges, column, side="right")]
        return total


def _word_weights(sample: DataFrame) -> dict[str, float]:
    """Log odds of words that labelled bad documents hold clearly more often than good ones."""

    def work(batches):
        for batch in batches:
            for part in slices(batch, "t"):
                codes, words, offsets = split_words(part.column("t"))
                names = np.array(stems(words), dtype=object)
                bad = np.asarray(part.column("y"))
                for i in range(len(part)):
                    own = set(names[codes[offsets[i] : offsets[i + 1]]]) - {""}
                    own = sorted(own | {w[:PREFIX] + "*" for w in own})
                    yield pa.RecordBatch.from_pydict({"w": pa.array(own, pa.string()), "y": pa.array([bad[i]] * len(own), pa.int32())})

    sums = sample.agg(F.count("*"), F.sum("y")).first()
    bad, good = int(sums[1] or 0), int(sums[0]) - int(sums[1] or 0)
    counts = sample.select("t", "y").mapInArrow(work, "w string, y int").groupBy("w").agg(
        F.sum("y").alias("b"), F.sum(1 - F.col("y")).alias("g")
    )
    odds = F.log((F.col("b") + 0.5) / (bad + 1)) - F.log((F.col("g") + 0.5) / (good + 1))
    error = F.sqrt(1 / (F.col("b") + 0.5) + 1 / (F.col("g") + 0.5))
    strong = (
        counts.select("w", odds.alias("o"), (odds - 2 * error).alias("sure"))
        .where(F.col("sure") >= MIN_LOG_ODDS)
        .orderBy(F.desc("sure"), "w")
        .limit(MAX_WORDS)
    )
    return {r.w: r.o for r in strong.collect()}


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the first column is not penalized."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(
    docs: DataFrame, bad: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED
) -> Model:
    """The model from ``bad (id, bad 0/1)``; at most ``max_labelled`` labels, those of the smallest id hashes.

    Without documents of both classes it finds no evidence in any text.
    """
    chosen = (
        bad.select(F.col(bad.columns[0]).alias("k"), F.col(bad.columns[1]).cast("int").alias("y"))
        .dropna()
        .orderBy(F.xxhash64("k"), "k", "y")
        .limit(max_labelled)
    )
    texts = bounded(docs).select(F.col(id_col).alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    # The labels are bounded, so they travel to the texts.  Copies of one text would make its
    # words look frequent, so one document of each text stays.
    chosen = stage(chosen, staging_path(docs.sparkSession, "labelled"))
    single = (
        texts.join(F.broadcast(chosen), "k").groupBy(F.md5("t").alias("h"), "y").agg(F.min("k").alias("k")).select("k", "y")
    )
    single = stage(single, staging_path(docs.sparkSession, "labelled"))
    sample = texts.join(F.broadcast(single), "k").select("t", "y")
    weights = _word_weights(sample)

    def work(batches):
        for batch in batches:
            for part in slices(batch, "t"):
                rows = measures(part.column("t"), weights)
                yield pa.RecordBatch.from_arrays([pa.array(list(rows)), part.column("y")], ["x", "y"])

    rows = sample.mapInArrow(work, "x array<double>, y int").toArrow()
    y = np.asarray(rows.column("y"), dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return Model({}, [np.empty(0)] * len(MEASURES), [np.zeros(1)] * len(MEASURES), 0.0)
    table = np.asarray(rows.column("x").combine_chunks().flatten()).reshape(len(y), len(MEASURES))
    order = np.lexsort(table.T)
    table, y = table[order], y[order]
    edges = [_edges(c, y) for c in table.T]
    slots = [np.searchsorted(e, c, side="right") for e, c in zip(edges, table.T, strict=True)]
    columns = [np.ones((len(y), 1))] + [np.eye(len(e) + 1)[s] for e, s in zip(edges, slots, strict=True)]
    w = _logistic(np.hstack(columns), y)
    cut = np.cumsum([1] + [len(e) + 1 for e in edges])
    scores = [w[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return Model(weights, edges, scores, float(w[0] - np.log(y.sum() / (len(y) - y.sum()))))


def evidence(docs: DataFrame, model: Model, text_col: str, out: str) -> DataFrame:
    """``docs`` with a double column ``out``: log odds of a bad text for even prior odds."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns
    at = columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                odds = shared.value.log_odds(pc.fill_null(part.column(at), ""))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(odds)], [*columns, out])

    from pyspark.sql.types import DoubleType, StructType

    return bounded(docs).mapInArrow(work, StructType([*docs.schema.fields]).add(out, DoubleType()))


def _probability(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-log_odds))


def group_posteriors(scored: DataFrame, host: str, path: str, evidence_col: str) -> tuple[DataFrame, dict]:
    """``(host, path, n, bad, prior, strength)`` per path, and the global figures.

    ``prior`` is the shrunk bad share of the path's host, ``strength`` how many documents it
    weighs; ``n`` and ``bad`` are the path's own documents and their expected bad ones.
    """
    p = _probability(F.col(evidence_col))
    paths = scored.groupBy(F.col(host).alias("h"), F.col(path).alias("p")).agg(
        F.count("*").alias("n"), F.sum(p).alias("bad")
    )
    # Stored, since both levels are read several times.
    paths = stage(paths, staging_path(scored.sparkSession, "paths"))
    hosts = paths.groupBy("h").agg(F.sum("n").alias("hn"), F.sum("bad").alias("hbad"))
    host_fit = _moments(hosts, "hn", "hbad")
    path_fit = _moments(paths, "n", "bad")
    shrunk = (F.col("hbad") + host_fit["strength"] * host_fit["mean"]) / (F.col("hn") + host_fit["strength"])
    named = hosts.select(F.col("h").alias("h2"), shrunk.alias("prior"))
    table = paths.join(named, F.col("h").eqNullSafe(F.col("h2"))).select(
        "h", "p", "n", "bad", "prior", F.lit(path_fit["strength"]).alias("strength")
    )
    return table, {"share": host_fit["mean"], "host_strength": host_fit["strength"], "path_strength": path_fit["strength"]}


def _moments(groups: DataFrame, n: str, bad: str) -> dict[str, float]:
    """Mean share of all groups and the prior strength that explains how far their shares spread."""
    row = groups.agg(
        F.sum(n).alias("n"), F.sum(bad).alias("bad"), F.count("*").alias("k"),
        F.sum(F.col(bad) * F.col(bad) / F.col(n)).alias("squares"),
        F.sum(F.col(n) * F.col(n)).alias("n2"),
    ).first()
    if not row.n:
        return {"mean": 0.5, "strength": 1.0}
    mean = min(max(row.bad / row.n, 1e-6), 1 - 1e-6)
    noise = mean * (1 - mean)
    between = row.squares - row.n * mean * mean - (row.k - 1) * noise
    variance = max(between, 0.0) / max(row.n - row.n2 / row.n, 1.0)
    # No spread beyond noise: groups say nothing, so their parent's share holds.
    strength = noise / variance - 1 if variance > 1e-9 else 1e6
    return {"mean": mean, "strength": float(min(max(strength, 1.0), 1e6))}


def posterior(
    scored: DataFrame, groups: DataFrame, host: str, path: str, evidence_col: str, share_col: str = "path_share", out: str = "p_bad"
) -> DataFrame:
    """``scored`` with the path's share (without the document itself) and the probability ``out`` of being bad."""
    odd = F.col(evidence_col)
    own = _probability(odd)
    group = _unused("__group", scored.columns)
    of = lambda c: F.col(group)[c]
    rest = (of("bad") - own + of("strength") * of("prior")) / (of("n") - 1 + of("strength"))
    share = F.least(F.greatest(rest, F.lit(1e-6)), F.lit(1 - 1e-6))
    table = groups.select(F.struct(*groups.columns).alias(group))
    joined = scored.join(table, F.col(host).eqNullSafe(of("h")) & F.col(path).eqNullSafe(of("p")))
    return joined.select(
        *scored.columns,
        share.alias(share_col),
        _probability(odd + F.log(share / (1 - share))).alias(out),
    )


def _unused(name: str, columns: list[str]) -> str:
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def bad_labels(labels: DataFrame) -> DataFrame:
    """``(doc_id, bad)``: of low quality or toxic."""
    return labels.select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad"))


def keep_good(
    docs: DataFrame, model: Model, text_col: str = "text", host: str = "source", path: str = "lang", cut: float = CUT
) -> DataFrame:
    """The rows of ``docs`` whose posterior probability of being bad is below ``cut``, columns as they are."""
    odds, share, p_bad = (_unused(n, docs.columns) for n in ("__odds", "__share", "__p_bad"))
    scored = evidence(docs, model, text_col, odds)
    groups, _ = group_posteriors(evidence(docs.select(text_col, host, path), model, text_col, odds), host, path, odds)
    groups = small_side(stage(groups, staging_path(docs.sparkSession, "groups")))
    judged = posterior(scored, groups, host, path, odds, share, p_bad)
    return judged.where(F.col(p_bad) < cut).select(*docs.columns)
