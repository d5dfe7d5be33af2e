"""Spelling variants: frequent words one edit apart, found on a trie of letter-group counts.

1. Words are counted per Arrow batch, then by Spark.  What is rarer than ``min_count`` goes.
2. A word's *vector* is its length and the number of its letters in each of ``GROUPS``
   groups.  One inserted, deleted or replaced letter changes a vector by at most one surplus
   and one deficit.  The words stand in a trie whose levels are the successive counts.
3. The top of the trie is a table: its nodes are the distinct vector prefixes, each under a
   number that adds up over the letters, so the nodes within the budget are found by adding
   fixed differences and joining.  The words of the smaller node visit the larger one.  The
   prefix gets longer until no node holds more than ``NODE_WORDS`` words, so a popular
   shape of word is divided and no task has to hold all words.
4. Below a node, blocks of visitors go down the trie depth first, each with what is left of
   its budget; the words at the leaves they reach are compared letter by letter.
5. A word's form is its most frequent near word, if that is ``ratio`` times as frequent.
   Forms get more frequent along a chain, so chains are short and end; doubling finds the end.

Defined results: null text has no words; a null id counts as the text ``null`` where ids are
hashed; repeated rows count each; words of any length are compared whole; ties between forms go
to the word that is smaller in code-point order; an empty table gives no rows.  Only the
columns named are read, so others may have any name.
"""

from __future__ import annotations

import functools
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.batches import slices, two_columns
from postlens.sources.staging import stage, staging_path

# What is a letter, and the thresholds of the contract.
LETTERS = "[A-Za-zÀ-ÿ]+"
MIN_LETTERS, MIN_COUNT, RATIO = 6, 5, 5

# Distinct words that a task counts before it sends them on.
HELD_WORDS = 200_000

# Letters are dealt to groups by the low bits of their code.
GROUPS = 16

# Levels of the trie, after the length, that make up a node of the table: as few as keep nodes small.
DEPTHS = (4, 8, 12, GROUPS)
NODE_WORDS = 2048

# Numbers of nodes are sums of these per letter group, modulo 2**52.
_MASK = (1 << 52) - 1
_STEPS = [(0x9E3779B97F4A7C15 * (2 * i + 1) ** 5 >> 3) & _MASK for i in range(GROUPS + 1)]

# Visitors that go down together, and pairs of words compared together.
BLOCK, PAIRS = 1 << 15, 1 << 17

# Letters compared as rows of a matrix; longer words one by one.
WIDE = 40

# One run in so many loses a letter.
LOSE_ONE_IN = 199


def count_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: str = LETTERS,
    min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, lose_one_in: int | None = LOSE_ONE_IN,
) -> DataFrame:
    """``(word, n)`` of the lower-cased runs of ``letters``.

    A run whose ``crc32(id:run)`` is a multiple of ``lose_one_in`` (None: no run) loses the letter that the
    number points to.
    """
    source = two_columns(docs, id_col, text_col).select(F.coalesce(F.col("k").cast("string"), F.lit("null")).alias("k"), "v")
    pattern = re.compile(letters)

    crc32 = zlib.crc32

    def shortened(run: str, h: int) -> str:
        return run[: h % len(run)] + run[h % len(run) + 1 :]

    def flushed(counts: Counter[str]) -> pa.RecordBatch:
        kept = [(w, n) for w, n in counts.items() if len(w) >= min_letters]
        counts.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"]
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for part in slices(batch):
                lower = pc.ascii_lower(part.column("v"))
                for key, text in zip(part.column("k").to_pylist(), lower.to_pylist(), strict=True):
                    runs = pattern.findall(text)
                    if lose_one_in:
                        head = crc32(f"{key}:".encode())
                        hit = {r for r in set(runs) if not crc32(r.encode(), head) % lose_one_in}
                        if hit:
                            runs = [shortened(r, crc32(r.encode(), head)) if r in hit else r for r in runs]
                    counts.update(runs)
                if len(counts) > HELD_WORDS:
                    yield flushed(counts)
        yield flushed(counts)

    counted = source.mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count)


# --- vectors and nodes -------------------------------------------------------


class Words:
    """Words as arrays: letters end to end, lengths, vectors."""

    def __init__(self, words: list[str]):
        self.words = words
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.start = np.concatenate([[0], np.cumsum(self.length)])
        joined = "".join(words).encode("utf-32-le")
        self.codes = np.frombuffer(joined, dtype="<u4").astype(np.int64)
        row = np.repeat(np.arange(len(words)), self.length)
        counts = np.bincount(row * GROUPS + self.codes % GROUPS, minlength=len(words) * GROUPS)
        self.vectors = np.column_stack([self.length, counts.reshape(-1, GROUPS)]).astype(np.int64)

    def nodes(self, depth: int) -> np.ndarray:
        steps = np.array(_STEPS[: depth + 1], dtype=np.uint64)
        return ((self.vectors[:, : depth + 1].astype(np.uint64) * steps).sum(axis=1) & np.uint64(_MASK)).astype(np.int64)

    @functools.cached_property
    def matrix(self) -> np.ndarray:
        """The letters of words of at most ``WIDE`` letters, zeros behind them and for longer words."""
        out = np.zeros((len(self.words), WIDE + 1), dtype=np.min_scalar_type(int(self.codes.max(initial=0))))
        row = np.repeat(np.arange(len(self.words)), self.length)
        place = np.arange(len(row)) - self.start[row]
        short = self.length[row] <= WIDE
        out[row[short], place[short]] = self.codes[short]
        return out


def budget_steps(depth: int) -> list[int]:
    """Differences between the numbers of two nodes that one edit may lie between."""
    length, groups = _STEPS[0], _STEPS[1 : depth + 1]
    same = [0, *groups, *(-g for g in groups), *(a - b for a in groups for b in groups if a != b)]
    longer = [length, *(length + g for g in groups)]
    return [x & _MASK for x in (*same, *longer, *(-y for y in longer))]


def _with_nodes(words: DataFrame) -> DataFrame:
    """``(word, n, node_<depth> ...)``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = Words(batch.column("word").to_pylist())
            nodes = [pa.array(own.nodes(d), pa.int64()) for d in DEPTHS]
            yield pa.RecordBatch.from_arrays([*batch.columns, *nodes], [*batch.schema.names, *(f"node_{d}" for d in DEPTHS)])

    schema = "word string, n long, " + ", ".join(f"node_{d} long" for d in DEPTHS)
    return words.mapInArrow(work, schema)


def _depth(words: DataFrame, node_words: int) -> int:
    """The least depth at which no node is larger than ``node_words``, or the greatest."""
    for depth in DEPTHS[:-1]:
        if words.groupBy(f"node_{depth}").count().where(F.col("count") > node_words).isEmpty():
            return depth
    return DEPTHS[-1]


# --- the search below a node -------------------------------------------------


class Trie:
    """Words of one or more nodes by node, then by successive counts."""

    def __init__(self, words: Words, nodes: np.ndarray):
        self.node_numbers, top = np.unique(nodes, return_inverse=True)
        order = np.lexsort([*words.vectors.T[::-1], top])
        self.order, vectors, at = order, words.vectors[order], top[order]
        self.span = int(words.vectors.max(initial=0)) + 3
        self.levels = []  # per level, the sorted codes (parent, count) of its trie nodes
        parent = at
        for level in range(vectors.shape[1]):
            codes = parent * self.span + vectors[:, level] + 1
            known, parent = np.unique(codes, return_inverse=True)
            self.levels.append(known)
        self.leaf_start = np.searchsorted(parent, np.arange(len(self.levels[-1]) + 1))

    def _children(self, level: int, parents: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known = self.levels[level]
        codes = parents * self.span + np.clip(counts + 1, 0, self.span - 1)
        at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
        return at, known[at] == codes

    def search(self, words: Words, nodes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(visitor, word)`` pairs whose vectors are within the budget of one surplus and one deficit.

        A block of visitors is taken to the next level and split when it grows, the deepest
        first, so what is open at a time is bounded by the depth of the trie.
        """
        at = np.minimum(np.searchsorted(self.node_numbers, nodes), len(self.node_numbers) - 1)
        visitor = np.flatnonzero(self.node_numbers[at] == nodes) if len(self.node_numbers) else np.empty(0, np.int64)
        one = np.ones(len(visitor), dtype=np.int8)
        stack = [(0, visitor, at[visitor], one, one)]
        while stack:
            level, visitor, parent, surplus, deficit = stack.pop()
            if len(visitor) > BLOCK:
                half = len(visitor) // 2
                for own in (slice(half, None), slice(half)):
                    stack.append((level, visitor[own], parent[own], surplus[own], deficit[own]))
                continue
            if not len(visitor):
                continue
            if level == len(self.levels):
                size = self.leaf_start[parent + 1] - self.leaf_start[parent]
                row = np.repeat(np.arange(len(parent)), size)
                place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + self.leaf_start[parent][row]
                yield visitor[row], self.order[place]
                continue
            wanted = words.vectors[visitor, level]
            found = []
            for step in (-1, 0, 1):
                # The length (level 0) tells which budgets are left: a longer word has no deficit to spend.
                may = np.full(len(visitor), True) if step == 0 else (surplus if step > 0 else deficit) > 0
                child, there = self._children(level, parent, wanted + step)
                keep = may & there
                s, d = surplus[keep], deficit[keep]
                if level == 0 and step:
                    s, d = np.full_like(s, step > 0), np.full_like(d, step < 0)
                elif level:
                    s, d = s - (step > 0), d - (step < 0)
                found.append((visitor[keep], child[keep], s, d))
            stack.append((level + 1, *(np.concatenate(x) for x in zip(*found, strict=True))))


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one letter is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def verify(left: Words, i: np.ndarray, right: Words, j: np.ndarray) -> np.ndarray:
    """Which pairs of words are exactly one edit apart."""
    out = np.zeros(len(i), dtype=bool)
    n, m = left.length[i], right.length[j]
    small = (n <= WIDE) & (m <= WIDE)
    rows = np.flatnonzero(small & (np.abs(n - m) <= 1))
    for lo in range(0, len(rows), PAIRS):
        own = rows[lo : lo + PAIRS]
        a, b = left.matrix[i[own]], right.matrix[j[own]]
        swap = n[own] > m[own]
        a[swap], b[swap] = b[swap], a[swap]  # the shorter first
        differs = a != b
        equal_length = n[own] == m[own]
        first = np.where(differs.any(axis=1), differs.argmax(axis=1), WIDE + 1)
        behind = np.arange(WIDE) >= first[:, None]
        shifted = ((a[:, :-1] != b[:, 1:]) & behind).any(axis=1)
        out[own] = np.where(equal_length, differs.sum(axis=1) == 1, ~shifted)
    for p in np.flatnonzero(~small):
        out[p] = one_edit(left.words[i[p]], right.words[j[p]])
    return out


def _visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(node, visits, word, n)`` in order of node and visits; words of a node first."""
    held: list[pa.RecordBatch] = []  # words of the latest nodes whose visitors come next

    def found(homes: pa.Table, guests: pa.Table) -> Iterator[pa.RecordBatch]:
        home, guest = Words(homes["word"].to_pylist()), Words(guests["word"].to_pylist())
        trie = Trie(home, homes["node"].to_numpy())
        # A node's own words visit it too; those pairs come in both orders and are taken in one.
        inner = guests["own"].to_numpy(zero_copy_only=False)
        counts = [t["n"].to_numpy() for t in (guests, homes)]
        for i, j in trie.search(guest, guests["node"].to_numpy()):
            for lo in range(0, len(i), PAIRS):
                x, y = i[lo : lo + PAIRS], j[lo : lo + PAIRS]
                near = verify(guest, x, home, y)
                x, y = x[near], y[near]
                both = ~inner[x]
                own, other = np.concatenate([x, y[both]]), np.concatenate([y, x[both]])
                side = np.concatenate([np.zeros(len(x), bool), np.ones(int(both.sum()), bool)])
                names = [
                    pa.array([home.words[k] if s else guest.words[k] for k, s in zip(a, flip, strict=True)], pa.string())
                    for a, flip in ((own, side), (other, ~side))
                ]
                n = np.where(side, counts[0][np.where(side, other, 0)], counts[1][np.where(side, 0, other)])
                yield pa.RecordBatch.from_arrays([*names, pa.array(n, pa.int64())], ["word", "near", "near_n"])

    for batch in batches:
        visits = np.asarray(batch.column("visits"))
        nodes = np.asarray(batch.column("node"))
        homes = batch.filter(pa.array(~visits))
        # Of the nodes before this batch, only the last can have visitors left.
        if len(nodes):
            held = [h for h in (x.filter(pc.equal(x.column("node"), int(nodes[0]))) for x in held) if len(h)]
        held.append(homes)
        guests = batch.filter(pa.array(visits))
        if len(guests) and sum(map(len, held)):
            yield from found(pa.Table.from_batches(held).combine_chunks(), pa.Table.from_batches([guests]).combine_chunks())


def near_words(words: DataFrame, node_words: int = NODE_WORDS) -> DataFrame:
    """``(word, near, near_n)`` for all pairs of ``words (word, n)`` one edit apart, in both orders.

    ``words`` is a stored table of distinct words.
    """
    spark = words.sparkSession
    placed = stage(_with_nodes(words), staging_path(spark, "words"))
    depth = _depth(placed, node_words)
    placed = placed.select("word", "n", F.col(f"node_{depth}").alias("node"))
    nodes = placed.groupBy("node").agg(F.count("*").alias("size"))
    steps = F.explode(F.array(*(F.lit(s) for s in budget_steps(depth)))).alias("step")
    reached = nodes.select(F.col("node").alias("source"), F.col("size").alias("source_size"), steps).select(
        "source", "source_size", ((F.col("source") + F.col("step")).bitwiseAND(F.lit(_MASK))).alias("node")
    )
    smaller = (F.col("source_size") < F.col("size")) | ((F.col("source_size") == F.col("size")) & (F.col("source") <= F.col("node")))
    pairs = reached.join(nodes, "node").where(smaller)
    guests = placed.withColumnRenamed("node", "source").join(pairs.select("source", "node"), "source")
    rows = placed.select("node", F.lit(False).alias("visits"), F.lit(False).alias("own"), "word", "n").unionByName(
        guests.select("node", F.lit(True).alias("visits"), (F.col("source") == F.col("node")).alias("own"), "word", "n")
    )
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(partitions, "node").sortWithinPartitions("node", "visits")
    return rows.mapInArrow(_visit, "word string, near string, near_n long")


def _roots(forms: DataFrame, most: int, ratio: int) -> DataFrame:
    """``(word, root)`` for the rows ``(word, form)``; a chain multiplies counts by ``ratio`` each step."""
    spark = forms.sparkSession
    hops = stage(forms.select("word", F.col("form").alias("root")), staging_path(spark, "forms"))
    steps = 1
    while steps < max(1, math.ceil(math.log(max(most, 2), ratio))):
        further = hops.select(F.col("word").alias("root"), F.col("root").alias("end"))
        hops = hops.join(further, "root", "left").select("word", F.coalesce("end", "root").alias("root"))
        hops = stage(hops, staging_path(spark, "forms"))
        steps *= 2
    return hops


def variants(words: DataFrame, ratio: int = RATIO, node_words: int = NODE_WORDS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for all rows of ``words (word, n)``; ``ratio`` is 2 or more."""
    if ratio < 2:
        raise ValueError("forms have to be more frequent than their words")
    spark = words.sparkSession
    words = stage(words.select("word", "n"), staging_path(spark, "counted"))
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best")
    near = near_words(words, node_words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    strong = -F.col("best.minus") >= ratio * F.col("n")
    judged = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.minus")).alias("form_n"),
    )
    judged = stage(judged, staging_path(spark, "judged"))
    most = judged.agg(F.max("n")).first()[0] or 0
    roots = _roots(judged.where(F.col("form").isNotNull()), most, ratio)
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
