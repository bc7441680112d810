"""Mixing sources to target weights: Sainte-Lague quotas of equal-token blocks.

Targets share all words by weight and stop at a multiple of what a source has; the excess goes
to the others by weight. The words are dealt in equal blocks: to sources by the highest quotients
``target / (2 k - 1)``, then each source's blocks to its shards in the same way. A source gets
as many shards as its words need, so no window holds more than about ``shard_words`` words, whatever
share of the corpus the source has. Blocks have ``block_words`` words and shards ``shard_words``, at every size of
the corpus; a source's words in the mix differ from its target by about a block.

A shard with a quota takes whole passes over its documents while the quota lasts. The rest comes
from chunks of ``CHUNK_BLOCKS`` consecutive blocks drawn in seeded order; the last one drawn is cut at a block.

Defined cases: null text and text without words have size 0 and are taken 0 times. A null source
is a source of its own, the last. Fully equal rows are separate documents. An empty table gives
an empty result. Seeds are hashes of ids, so reruns agree.
"""

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from txnmill.llm.common import WORD, staged, word_count, workers_see_package

SHARD_WORDS = 1 << 20  # a million shards of them are a corpus of 10^12 words
BLOCK_WORDS = 8
CHUNK_BLOCKS = 128


def sainte_lague(units: DataFrame, group: str, unit: str, votes: str, seats: str) -> DataFrame:
    """``units`` with a column ``quota``: the group's seats by highest votes / (2 k - 1).

    Seats above a threshold that cannot overfill the house are given at once; only the few
    quotients around the last seat, at most three a unit, are ranked. Ties go to the smaller unit.
    """
    everyone = Window.partitionBy(group)
    bounds = (
        units.withColumn("sl_n", F.count("*").over(everyone))
        .withColumn("sl_v", F.sum(votes).over(everyone))
        .withColumn("sl_low", _seats_at(votes, F.greatest(F.col(seats) - F.col("sl_n"), F.lit(0))))
        .withColumn("sl_high", _seats_at(votes, F.col(seats) + F.col("sl_n")))
        .withColumn("sl_left", F.col(seats) - F.sum("sl_low").over(everyone))
    )
    quotient = F.col(votes) / (2 * F.col("sl_k") - 1)
    won = (
        bounds.filter(F.col("sl_high") > F.col("sl_low"))
        .select(
            group, unit, votes, "sl_left", F.explode(F.expr("sequence(sl_low + 1, sl_high)")).alias("sl_k")
        )
        .withColumn(
            "sl_rank",
            F.row_number().over(Window.partitionBy(group).orderBy(quotient.desc(), unit, "sl_k")),
        )
        .filter("sl_rank <= sl_left")
        .groupBy(group, unit)
        .agg(F.count("*").alias("sl_won"))
    )
    quota = F.col("sl_low") + F.coalesce("sl_won", F.lit(0))
    return (
        bounds.join(won, [group, unit], "left")
        .withColumn("quota", quota.cast("long"))
        .drop("sl_n", "sl_v", "sl_low", "sl_high", "sl_left", "sl_won")
    )


def _seats_at(votes: str, house: Column) -> Column:
    share = F.when(F.col("sl_v") > 0, F.col(votes) * house / F.col("sl_v")).otherwise(0.0)
    return F.floor(share + 0.5).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """(source, source_no, source_size, target) from (source, source_size).

    One level of words a unit of weight holds for all sources below their cap. In order of
    cap / weight, it is found at the first source whose cap it does not exceed.
    """
    n = len(weights)
    table = F.array(*(F.lit(float(w)) for w in weights))
    numbered = sizes.withColumn(
        "source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ).withColumn("weight", F.element_at(table, ((F.col("source_no") - 1) % n + 1).cast("int")))
    order = Window.orderBy(F.col("most") / F.col("weight"), "source_no")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    filled = (
        numbered.withColumn("most", cap * F.col("source_size"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("given", F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("given")) / F.sum("weight").over(onward))
        .withColumn("holds", F.col("level") <= F.col("most") / F.col("weight"))
        .withColumn(
            "final", F.min_by("level", F.when(F.col("holds"), F.col("most") / F.col("weight"))).over(everything)
        )
    )
    target = F.least(F.col("most"), F.col("final") * F.col("weight"))
    return filled.select("source", "source_no", "source_size", target.alias("target"))


def mixture(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (1, 2, 3),
    cap: int = 3,
    seed: int = 17,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """One row per document: doc_id, row_hash, copy, copies, size, source_size, target, passes,
    spans, taken.

    The mix takes the whole text ``passes`` times and the words of ``spans`` (from, to) once
    more; ``taken`` is the number of words in all. ``row_hash`` tells rows with one id apart,
    ``copy`` of ``copies`` those that are fully equal.
    """
    sized = (
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            word_count(F.col(text_col)).alias("size"),
            row_hash(docs).alias("row_hash"),
        )
        .groupBy("doc_id", "source", "size", "row_hash")
        .agg(F.count("*").alias("copies"))
        .withColumn("copy", F.explode(F.expr("sequence(1, copies)")))
    )
    sized = staged(sized, "sized")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = staged(source_targets(totals, weights, float(cap)), "sources")
    words = sources.agg(F.sum("source_size")).first()[0] or 0
    return _taken(sized, sources, words, block_words, CHUNK_BLOCKS * block_words, cap, seed, shard_words)


def row_hash(docs: DataFrame) -> Column:
    """A hash of the whole row; nulls count by their place."""
    cells = [x for c in docs.columns for x in (docs[c].isNull(), docs[c])]
    return F.xxhash64(*cells)


def _taken(sized, sources, words, block, chunk, cap, seed, shard_words) -> DataFrame:
    house = sources.withColumn("all", F.lit(1)).withColumn("seats", F.lit(words // block))
    quotas = (
        sainte_lague(house, "all", "source_no", "target", "seats")
        .drop("all", "seats")
        .withColumn("shards", F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)))
    )
    quotas = staged(quotas, "quotas")
    draw = F.xxhash64(F.lit(seed), "doc_id", "row_hash", "copy")
    placed = sized.join(quotas, sized["source"].eqNullSafe(quotas["source"])).select(
        "doc_id", "row_hash", "copy", "copies", "size", "source_no", "source_size", "target", "quota",
        F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "row_hash", "copy"), "shards").alias("shard"),
        draw.alias("draw"),
    )
    placed = staged(placed, "placed")
    cells = _cells(placed, block, cap)
    in_cell = Window.partitionBy("source_no", "shard").orderBy("draw", "doc_id", "row_hash", "copy")
    lying = placed.filter("size > 0").withColumn(
        "start", F.sum("size").over(in_cell) - F.col("size")
    )
    spans = _spans(lying, _drawn(cells, chunk, seed), chunk)
    key = ["doc_id", "row_hash", "copy"]
    passes = cells.select("source_no", "shard", "passes")
    kept = placed.join(passes, ["source_no", "shard"], "left")
    joined = kept.alias("k").join(
        spans.alias("s"),
        F.col("k.doc_id").eqNullSafe(F.col("s.doc_id"))
        & (F.col("k.row_hash") == F.col("s.row_hash"))
        & (F.col("k.copy") == F.col("s.copy")),
        "left",
    )
    whole = F.when(F.col("size") > 0, F.coalesce("passes", F.lit(0))).otherwise(0).cast("long")
    return joined.select(
        *(F.col(f"k.{c}").alias(c) for c in key),
        "copies",
        "size",
        "source_size",
        "target",
        whole.alias("passes"),
        "spans",
        (whole * F.col("size") + F.coalesce("span_words", F.lit(0))).alias("taken"),
    )


def _cells(placed: DataFrame, block: int, cap: int) -> DataFrame:
    """Shards of sources with their words, whole passes and words left for single chunks."""
    held = placed.filter("size > 0").groupBy("source_no", "shard", "quota")
    cells = held.agg(F.sum("size").alias("cell_words"))
    cells = cells.withColumnRenamed("quota", "seats")
    cells = sainte_lague(cells, "source_no", "shard", "cell_words", "seats")
    take = F.least(F.col("quota") * block, F.col("cell_words") * cap)
    cells = (
        cells.withColumn("take", take)
        .withColumn("passes", F.expr("take div cell_words"))
        .withColumn("rest", F.expr("take % cell_words"))
    )
    return staged(cells.drop("seats", "quota", "take"), "cells")


def _drawn(cells: DataFrame, chunk: int, seed: int) -> DataFrame:
    """(source_no, shard, chunk, take): chunks drawn in seeded order until the rest is reached."""
    order = Window.partitionBy("source_no", "shard").orderBy("draw", "chunk")
    long = F.least(F.lit(chunk), F.col("cell_words") - F.col("chunk") * chunk)
    return (
        cells.filter("rest > 0")
        .withColumn("chunk", F.explode(F.expr(f"sequence(0, (cell_words - 1) div {chunk})")))
        .withColumn("draw", F.xxhash64(F.lit(seed + 2), "source_no", "shard", "chunk"))
        .withColumn("long", long)
        .withColumn("before", F.sum("long").over(order) - F.col("long"))
        .withColumn("take", F.least("long", F.col("rest") - F.col("before")))
        .filter("take > 0")
        .select("source_no", "shard", "chunk", "take")
    )


def _spans(lying: DataFrame, drawn: DataFrame, chunk: int) -> DataFrame:
    """(doc_id, row_hash, copy, spans, span_words) of documents that lie in drawn chunks."""
    touched = lying.withColumn(
        "chunk", F.explode(F.expr(f"sequence(start div {chunk}, (start + size - 1) div {chunk})"))
    )
    first = F.greatest(F.col("chunk") * chunk, F.col("start"))
    last = F.least(F.col("chunk") * chunk + F.col("take"), F.col("start") + F.col("size"))
    return (
        touched.join(drawn, ["source_no", "shard", "chunk"])
        .withColumn("from", first - F.col("start"))
        .withColumn("to", last - F.col("start"))
        .filter(F.col("to") > F.col("from"))
        .groupBy("doc_id", "row_hash", "copy")
        .agg(
            F.array_sort(F.collect_list(F.struct("from", "to"))).alias("spans"),
            F.sum(F.col("to") - F.col("from")).alias("span_words"),
        )
    )


def mixed_documents(
    docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", **options
) -> DataFrame:
    """The mix as documents with the columns of ``docs``: a row per pass, and one with the words
    of the spans if there are any, cut out of the text with the white space between them."""
    workers_see_package(docs.sparkSession)
    taken = mixture(docs, text_col=text_col, **options).filter("taken > 0")
    taken = staged(taken.select("row_hash", "copies", "passes", "spans"), "taken")
    whole = docs.select(row_hash(docs).alias("row_hash"), F.struct(*docs.columns).alias("doc"))
    single, several = taken.filter("copies = 1"), taken.filter("copies > 1")
    rows = whole.join(single.hint("merge"), "row_hash")
    if not several.isEmpty():
        hashes = several.select("row_hash").distinct()
        once = whole.join(hashes, "row_hash", "left_semi").dropDuplicates(["row_hash"])
        rows = rows.union(once.join(several, "row_hash"))
    names, schema = list(docs.columns), T.StructType(docs.schema.fields)
    # by place, since documents may have columns of any name
    cells = [F.col("doc").getField(name).alias(f"c{i}") for i, name in enumerate(names)]
    rows = rows.select(*cells, "passes", "spans")
    text_at = names.index(text_col)
    chars_at = names.index(chars_col) if chars_col in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = re.compile(WORD)
        for batch in batches:
            texts = batch.column(text_at)
            passes, spans = batch.column(len(names)).to_pylist(), batch.column(len(names) + 1)
            at, cut = [], []
            for i, n in enumerate(passes):
                at += [i] * n
                cut += [None] * n
                if spans[i].is_valid:
                    at.append(i)
                    cut.append(_cut(word, texts[i].as_py(), spans[i].as_py()))
            columns = [c.take(pa.array(at, pa.int32())) for c in batch.columns[: len(names)]]
            kept = [t if c is None else c for t, c in zip(columns[text_at].to_pylist(), cut, strict=True)]
            columns[text_at] = pa.array(kept, columns[text_at].type)
            if chars_at is not None:
                old = columns[chars_at].to_pylist()
                new = [o if c is None else len(c) for o, c in zip(old, cut, strict=True)]
                columns[chars_at] = pa.array(new, columns[chars_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, schema)


def _cut(word, text: str, spans: list[dict]) -> str:
    """The words of the spans; words of one span keep the white space between them."""
    ends = [m.span() for m in word.finditer(text)]
    return "\n".join(text[ends[s["from"]][0] : ends[s["to"] - 1][1]] for s in spans)
