"""Record tags inside CDATA sections and comments: a lexer for files that are read in splits.

A file is read as *pieces* between record tags, in any number of splits.  A piece may begin in
text, in a CDATA section or in a comment, which depends on all pieces before it.  So each
piece is lexed for all three beginnings at once: the result is a map from the state at its
beginning to the state at its end.  Maps are composed per split, then per file over its splits, and give the
state at every piece's beginning.  A piece that begins in text starts a record; others belong to
the record before them.

Within a split most records are whole whatever state it begins in, and are joined by the task that reads it.
Only the pieces at a split's ends, which the splits around it decide on, are resolved and shuffled.

Files in which no piece, begun in text, ends elsewhere have only pieces that begin in text; one native filter
finds them, and they need none of this.  A section that is never closed in its file counts as text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.sources.staging import stage, staging_path

# States, and how a section begins and ends.
TEXT, CDATA, COMMENT = range(3)
OPENS = {CDATA: "<![CDATA[", COMMENT: "<!--"}
CLOSES = {CDATA: "]]>", COMMENT: "-->"}

# Bytes of one Arrow batch of pieces.
BATCH_BYTES = 8 << 20

SECTION = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>"


def end_state(value: Column) -> Column:
    """The state at the end of a piece that begins in text."""
    rest = F.regexp_replace(value, SECTION, " ")  # nothing new arises from what stands around a section
    cdata, comment = (F.locate(OPENS[s], rest) for s in (CDATA, COMMENT))
    opened = (
        F.when((cdata > 0) & ((comment == 0) | (cdata < comment)), F.lit(CDATA))
        .when(comment > 0, F.lit(COMMENT))
        .otherwise(F.lit(TEXT))
    )
    return F.when(F.contains(value, F.lit("<!")), opened).otherwise(F.lit(TEXT))


def state_map(value: Column) -> Column:
    """The states at a piece's end for a beginning in text, in CDATA and in a comment."""

    def closed(state: int) -> Column:
        at = F.instr(value, F.lit(CLOSES[state]))
        return F.when(at == 0, F.lit(state)).otherwise(end_state(F.substring(value, at + F.lit(len(CLOSES[state])), F.length(value))))

    return F.array(end_state(value), closed(CDATA), closed(COMMENT))


def _marked(value: Column) -> Column:
    """Whether a piece holds anything that may change a state; others map each state to itself."""
    tokens = [*OPENS.values(), *CLOSES.values()]
    return F.exists(F.array(*map(F.lit, tokens)), lambda t: F.contains(value, t))


def _composed(maps: Column, start: Column) -> Column:
    return F.aggregate(maps, start, lambda state, m: F.transform(state, lambda s: F.get(m, s)))


def whole_pieces(pieces: DataFrame, tag: str) -> DataFrame:
    """``(value, file)``: ``pieces (value, file, block, at)`` with those inside of sections joined to the record before.

    ``(block, at)`` orders a file's pieces: the split's offset, and an order within the
    split, in which a task has its rows.  ``tag`` is what separated the pieces.
    """
    spark = pieces.sparkSession
    opens = [F.bool_or(F.contains("value", F.lit(OPENS[s]))).alias(f"opens_{s}") for s in OPENS]
    crossing = pieces.groupBy("file").agg(F.bool_or(end_state(F.col("value")) != TEXT).alias("crosses"), *opens).where("crosses")
    crossing = stage(crossing.drop("crosses"), staging_path(spark, "crossing"))
    if crossing.isEmpty():
        return pieces.select("value", "file")
    plain = pieces.join(crossing, "file", "left_anti").select("value", "file")
    # A broadcast join keeps the order of a task's rows; the driver lists these files anyway.
    own = pieces.join(F.broadcast(crossing), "file")
    joined = _staged_in_small_batches(_joined(own, tag), staging_path(spark, "pieces"))
    value = F.col("value").cast("string").alias("value")
    whole = joined.where("whole").select(value, "file")
    parts = joined.where("not whole").select("file", "block", "at", value, "own", *(f"closes_{s}" for s in CLOSES))
    return plain.unionByName(whole).unionByName(_resolved(parts, tag))


def _joined(pieces: DataFrame, tag: str) -> DataFrame:
    """``(file, block, at, value binary, own, closes_1, closes_2, whole)``: records that are whole in their split, and the other pieces.

    ``own`` is a piece's map if it holds a token, and ``closes_…`` whether it may close a section.
    ``opens_1`` and ``opens_2`` of ``pieces`` tell whether their file opens such sections.
    """
    value = F.col("value")
    closes = [F.contains(value, F.lit(CLOSES[s])).alias(f"closes_{s}") for s in CLOSES]
    # As bytes, so that text which is not valid in its encoding stays as it is.
    lexed = pieces.select(
        "file", "block", "at", value.cast("binary").alias("value"), F.when(_marked(value), state_map(value)).alias("own"), *closes,
        *(f"opens_{s}" for s in OPENS),
    )
    schema = "file string, block long, at long, value binary, own array<int>, closes_1 boolean, closes_2 boolean, whole boolean"
    return lexed.mapInArrow(lambda batches: _records_of_splits(batches, tag.encode()), schema)


def _records_of_splits(batches: Iterator[pa.RecordBatch], tag: bytes) -> Iterator[pa.RecordBatch]:
    """Joins the pieces of records that begin and end within a split, whatever state the split begins in.

    Up to the first piece that begins in text for every beginning of the split, pieces go on as they
    are, and so do those of the split's last record, which the next split may continue.  A record
    before it ended in text, so every section of it is closed.
    """
    names = ["file", "block", "at", "value", "own", *(f"closes_{s}" for s in CLOSES)]
    types = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.bool_(), pa.bool_(), pa.bool_()]
    split, states, record, out = None, None, None, []
    for batch in batches:
        opens = zip(*(batch.column(f"opens_{s}").to_pylist() for s in OPENS), strict=True)
        for piece, opened in zip(zip(*(batch.column(name).to_pylist() for name in names), strict=True), opens, strict=True):
            if piece[:2] != split:
                out += [(*p, False) for p in record or ()]
                # A file begins in text, and no split begins in a section that its file never opens.
                split, record = piece[:2], None
                states = (TEXT, *(s if may and piece[1] else TEXT for s, may in zip(OPENS, opened, strict=True)))
            if states == (TEXT,) * 3:
                if record:
                    out.append((*record[0][:3], tag.join(p[3] for p in record), None, False, False, True))
                record = [piece]
            elif record is None:
                out.append((*piece, False))
            else:
                record.append(piece)
            if piece[4] is not None:
                states = tuple(piece[4][s] for s in states)
        yield _batch(out, names, types)
        out = []
    yield _batch([(*p, False) for p in record or ()], names, types)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [*names, "whole"])


def _staged_in_small_batches(df: DataFrame, path: str) -> DataFrame:
    """:func:`stage` with Arrow batches that long texts do not make large."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(key)
    conf.set(key, str(BATCH_BYTES))
    try:
        return stage(df, path)
    finally:
        conf.set(key, before)


def _begins(pieces: DataFrame) -> DataFrame:
    """``(file, block, at, ends)``: the state behind every piece that holds a token.

    Tables of a row per file or split are broadcast, since the driver that plans the scan lists
    those anyway.  Tables of pieces never are: their files are small, their rows are many.
    """
    place, own = F.struct("block", "at"), F.col("own")
    marks = pieces.where(own.isNotNull()).drop("value")
    # A section that no later piece closes is none.
    last = marks.groupBy("file").agg(*(F.max(F.when(F.col(f"closes_{s}"), place)).alias(f"last_{s}") for s in (CDATA, COMMENT)))
    opened = F.get(own, F.lit(TEXT))
    closable = F.when(opened == TEXT, F.lit(True)).otherwise(
        F.coalesce(place < F.when(opened == CDATA, F.col(f"last_{CDATA}")).otherwise(F.col(f"last_{COMMENT}")), F.lit(False))
    )
    marks = marks.join(F.broadcast(last), "file").select(
        "file", "block", "at", F.when(closable, own).otherwise(F.array(F.lit(TEXT), *(F.get(own, F.lit(s)) for s in (CDATA, COMMENT)))).alias("own")
    )
    # Splits are of bounded size, so their lists of maps are short, and a file's list of splits is.
    splits = marks.groupBy("file", "block").agg(F.array_sort(F.collect_list(F.struct("at", "own"))).alias("own"))
    identity = F.array(*map(F.lit, (TEXT, CDATA, COMMENT)))
    whole = splits.select("file", "block", _composed(F.transform("own", lambda r: r["own"]), identity).alias("map"))
    files = whole.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("block", "map"))).alias("splits"))
    before = F.transform("splits", lambda x: F.struct(
        x["block"].alias("block"),
        F.get(_composed(F.transform(F.filter("splits", lambda y: y["block"] < x["block"]), lambda y: y["map"]), identity), F.lit(TEXT)).alias("state"),
    ))
    starts = files.select("file", F.inline(before))
    placed = marks.join(F.broadcast(starts), ["file", "block"])
    return placed.groupBy("file", "block").applyInArrow(_running, "file string, block long, at long, ends int")


def _running(marks: pa.Table) -> pa.Table:
    """The state behind each of a split's marks ``(file, block, at, own, state)``, where ``state`` is that at its start."""
    marks = marks.sort_by("at")
    state, ends = marks["state"][0].as_py(), []
    for own in marks["own"].to_pylist():
        state = own[state]
        ends.append(state)
    return marks.select(["file", "block", "at"]).append_column("ends", pa.array(ends, pa.int32()))


def _resolved(pieces: DataFrame, tag: str) -> DataFrame:
    place = ["file", "block", "at"]
    order = Window.partitionBy("file", "block").orderBy("at")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # Places only: the texts meet their record's first piece at the end.
    known = pieces.select(*place).hint("merge").join(_begins(pieces), place, "left")
    known = stage(known, staging_path(pieces.sparkSession, "marks"))
    # The state at a split's start is that at the end of the splits before it.
    last = known.groupBy("file", "block").agg(F.max_by("ends", F.when(F.col("ends").isNotNull(), F.col("at"))).alias("ends"))
    files = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = last.select("file", "block", F.coalesce(F.last("ends", ignorenulls=True).over(files), F.lit(TEXT)).alias("start"))
    state = F.coalesce(F.last("ends", ignorenulls=True).over(before), F.col("start"))
    states = known.join(F.broadcast(starts), ["file", "block"]).withColumn("state", state)
    # The record's first piece: the last one so far that begins in text, in this split or an earlier one.
    head = F.when(F.col("state") == TEXT, F.struct("block", "at"))
    states = states.select("file", "block", "at", head.alias("head"))
    heads = states.groupBy("file", "block").agg(F.max("head").alias("head"))
    carried = heads.select("file", "block", F.last("head", ignorenulls=True).over(files).alias("carried"))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    owned = states.join(F.broadcast(carried), ["file", "block"]).select(
        "file", "block", "at", F.coalesce(F.last("head", ignorenulls=True).over(upto), F.col("carried")).alias("head")
    )
    parts = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    joined = pieces.select(*place, "value").hint("merge").join(owned, place).groupBy("file", "head").agg(parts.alias("parts"))
    return joined.select(F.array_join(F.transform("parts", lambda p: p["value"]), tag).alias("value"), "file")


def cut(value: Column, closing: str) -> Column:
    """``value`` up to its first closing tag (a pattern that begins with ``<``) outside of sections, NULL if there is none.

    One match from the beginning walks over texts and whole sections.  Its loops are possessive
    or of single characters, so they need no stack, however long the value is.
    """
    walk = rf"^((?:[^<]++|{SECTION}|<(?!{closing[1:]}))*+){closing}"
    careful = F.get(F.regexp_extract_all(value, F.lit(walk), F.lit(1)), F.lit(0))
    plain = F.split(value, closing, 2)
    return F.when(F.contains(value, F.lit("<!")), careful).when(F.size(plain) == 2, plain[0])
