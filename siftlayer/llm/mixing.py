"""Mixing sources to target weights by Pareto order sampling.

How many copies of a document are expected depends on its length: a source
scales the worth of its documents, which rises with the bits of their size, until
the expected words make its target, no document beyond the most copies.  A
document takes the whole part of that number as certain copies; the rest is its
inclusion probability for one copy more.  Documents are ranked by their random
odds over their inclusion odds, and a source takes them in that order up to the
words it still needs: the fixed size of the sample.  The rank at which it stops
is found from counts of words in ever smaller cells of the rank, never by
sorting a source.  What is then left, less than the next document, goes in the
same order to those after it that fit.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, Workspace, unit_hash, whole_row

WEIGHTS = (5, 2, 1)
BUDGET = Fraction(3, 2)
MOST = 2
CELL_BITS = 8
ROUNDS = 5
SEED = 7
# Each further bit of a size adds this share of the worth of one word.
RISE = Fraction(1, 8)

_CLASSES = T.StructType(
    [
        T.StructField("of", T.StringType()),
        T.StructField("class_of", T.IntegerType()),
        T.StructField("source_size", T.LongType()),
        T.StructField("target", T.DoubleType()),
        T.StructField("need", T.DoubleType()),
        T.StructField("whole", T.IntegerType()),
        T.StructField("chance", T.DoubleType()),
    ]
)


def targets(
    sizes: dict[str | None, int], weights=WEIGHTS, budget: Fraction = BUDGET, most: int = MOST
) -> dict[str | None, Fraction]:
    """Words that each source is to give.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    ``budget`` times all words.  A share above ``most`` times its source's size
    stops there; what it leaves is shared again by weight among the others.
    """
    order = sorted(sizes, key=lambda name: (name is None, name or ""))
    weight = {name: weights[i % len(weights)] for i, name in enumerate(order)}
    left, open_, out = budget * sum(sizes.values()), list(order), {}
    while open_:
        unit = left / sum(weight[name] for name in open_)
        full = [name for name in open_ if unit * weight[name] > most * sizes[name]]
        if not full:
            return out | {name: unit * weight[name] for name in open_}
        for name in full:
            out[name] = Fraction(most * sizes[name])
            left -= out[name]
        open_ = [name for name in open_ if name not in out]
    return out


def expected_copies(
    words: dict[int, int], target: Fraction, most: int = MOST, rise: Fraction = RISE
) -> dict[int, Fraction]:
    """Copies expected of the documents of each length class, from the words of the classes.

    They are in proportion to the worth ``1 + rise * class`` up to ``most``, and
    words times copies add up to ``target``, which is at most ``most`` times all words.
    """
    worth = {bits: 1 + rise * bits for bits, size in words.items() if size}
    left, open_ = Fraction(target), sorted(worth, key=worth.get, reverse=True)
    out = {bits: Fraction(0) for bits in words}
    while open_:
        scale = left / sum(worth[bits] * words[bits] for bits in open_)
        full = [bits for bits in open_ if scale * worth[bits] >= most]
        if not full:
            return out | {bits: scale * worth[bits] for bits in open_}
        for bits in full:
            out[bits] = Fraction(most)
            left -= most * words[bits]
        open_ = [bits for bits in open_ if bits not in full]
    return out


def _class_table(spark: SparkSession, sized: DataFrame, weights, budget, most, rise) -> DataFrame:
    """A row for each source and length class; the driver sees one sum for each, at most 64 a source."""
    words: dict[str | None, dict[int, int]] = {}
    for name, bits, size in sized.groupBy("source", "class").agg(F.sum("size")).collect():
        words.setdefault(name, {})[bits] = size
    sizes = {name: sum(own.values()) for name, own in words.items()}
    rows = []
    for name, target in targets(sizes, weights, budget, most).items():
        copies = expected_copies(words[name], target, most, rise)
        need = target - sum(int(number) * words[name][bits] for bits, number in copies.items())
        for bits, number in copies.items():
            whole = int(number)
            rows.append((name, bits, sizes[name], float(target), float(need), whole, float(number - whole)))
    return spark.createDataFrame(rows, _CLASSES)


def _rank(key: Column, chance: Column) -> Column:
    """Random odds over inclusion odds, mapped in order to whole numbers."""
    odds = key / (1 - key) * (1 - chance) / chance
    top = float(2 ** (CELL_BITS * ROUNDS))
    return F.when(chance > 0, F.floor(odds / (1 + odds) * F.lit(top)).cast("long"))


def _cuts(space: Workspace, ranked: DataFrame, needs: DataFrame, nearest: bool) -> DataFrame:
    """For each source the rank below which documents give a further copy, and the words left.

    Round by round the cell that holds the wanted number of words is cut into
    ``2 ** CELL_BITS`` smaller ones.  The last cell is taken where all of it is
    needed, with ``nearest`` where half of it is.
    """
    bits = CELL_BITS * ROUNDS
    state = needs.select("of", F.lit(0).cast("long").alias("low"), F.col("need").cast("double").alias("need"))
    for number in range(ROUNDS):
        last = number == ROUNDS - 1
        width = 2 ** (bits - CELL_BITS * (number + 1))
        inside = (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("low") + width * 2**CELL_BITS)
        cells = (
            ranked.join(state, ranked["source"].eqNullSafe(state["of"]) & inside)
            .groupBy("source", "low", "need", F.floor((F.col("rank") - F.col("low")) / width).alias("cell"))
            .agg(F.sum("size").alias("size"))
        )
        before = Window.partitionBy("source").orderBy("cell")
        cells = cells.withColumn("below", F.sum("size").over(before) - F.col("size"))
        share = (F.col("size") / 2 if nearest else F.col("size")) if last else F.lit(0)
        taken = F.when(F.col("below") + share <= F.col("need"), F.struct("cell", "below", "size"))
        chosen = cells.groupBy("source").agg(
            F.max(taken).alias("at"), F.min("low").alias("low"), F.min("need").alias("need")
        )
        state = chosen.select(
            F.col("source").alias("of"),
            F.coalesce(F.col("low") + (F.col("at.cell") + int(last)) * width, F.col("low")).alias("low"),
            (F.col("need") - F.coalesce(F.col("at.below") + (F.col("at.size") if last else 0), F.lit(0))).alias("need"),
        )
        state = space.keep(state)
    return state.withColumnsRenamed({"low": "cut", "need": "left"})


def mix_sources(
    docs: DataFrame,
    weights=WEIGHTS,
    budget: Fraction = BUDGET,
    most: int = MOST,
    seed: int = SEED,
    rise: Fraction = RISE,
) -> DataFrame:
    """Every row of ``docs`` with the copies that the mix takes of it.

    Returns ``row`` (all input columns), ``size`` (words), ``source_size``,
    ``target``, ``expected`` (the copies expected of its length class) and
    ``copies``, at most ``most``.  With ``rise`` 0 all documents of a source are
    worth the same.  A null or empty text has size 0 and no copies; a null
    source is a source of its own; rows equal in ``doc_id``, text and source are
    taken or left together; an empty table gives no row.  Reruns agree: the
    random numbers come from ``doc_id``, text and ``seed``.
    """
    spark = docs.sparkSession
    space = Workspace(spark)
    size = F.coalesce(F.regexp_count(docs["text"].cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.select(
        whole_row(docs),
        docs["source"].cast("string").alias("source"),
        size.alias("size"),
        unit_hash(docs["doc_id"].cast("long"), docs["text"].cast("string"), seed=seed).alias("key"),
    ).withColumn("class", F.when(F.col("size") > 0, F.length(F.bin("size"))).otherwise(0).cast("int"))
    keys = space.keep(sized.select("source", "class", "size", "key"))
    table = space.keep(_class_table(spark, keys, weights, budget, most, rise))
    own = F.col("source").eqNullSafe(F.col("of")) & (F.col("class") == F.col("class_of"))
    ranked = keys.join(table.select("of", "class_of", "chance"), own)
    ranked = space.keep(ranked.select("source", "size", _rank(F.col("key"), F.col("chance")).alias("rank")))
    first = _cuts(space, ranked, table.select("of", "need").distinct(), nearest=False)
    # Of the documents after the cut, those that fit into the words left fill them up.
    fitting = ranked.join(first, ranked["source"].eqNullSafe(F.col("of")))
    fitting = fitting.where("rank >= cut AND size > 0 AND size <= left").select("source", "size", "rank")
    second = _cuts(space, fitting, first.select("of", F.col("left").alias("need")), nearest=True)
    cuts = first.select(F.col("of").alias("cut_of"), "cut", "left")
    fills = second.select(F.col("of").alias("fill_of"), F.col("cut").alias("fill"))
    per_class = space.keep(
        table.join(cuts, F.col("of").eqNullSafe(F.col("cut_of")), "left")
        .join(fills, F.col("of").eqNullSafe(F.col("fill_of")), "left")
        .select("of", "class_of", "source_size", "target", "whole", "chance", "cut", "left", "fill")
    )
    joined = sized.join(per_class, own)
    rank = _rank(F.col("key"), F.col("chance"))
    further = (rank < F.col("cut")) | ((F.col("size") <= F.col("left")) & (rank < F.col("fill")))
    copies = F.when(F.col("size") > 0, F.col("whole") + F.coalesce(further, F.lit(False)).cast("int"))
    return joined.select(
        "row",
        "size",
        "source_size",
        "target",
        (F.col("whole") + F.col("chance")).alias("expected"),
        F.coalesce(copies, F.lit(0)).alias("copies"),
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, each row as often as it is taken."""
    mixed = mix_sources(docs, **options).where("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).select("row.*")
