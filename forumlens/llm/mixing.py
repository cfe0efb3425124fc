"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

Each document gets the key ``-ln(u) / quality`` with ``u`` from a hash of its id, so reruns agree. A source
whose target is ``e`` times its size and some words takes ``e`` whole epochs; the rest are its documents in
the order of their keys, as long as their summed sizes stay within the rest. The document on the border is
taken if that ends nearer the target.

The sum over a source's order is taken in levels: words are summed by key cell, the cell in which the rest
ends is cut finer, and only the places (key, id and size) of that last cell are sorted, each once with its number
of rows. So a source that holds most rows is never brought into one task, nor is a place that holds them.

Cases: a null text has no words, a null source is a source (last in order), a null ``doc_id`` has the key of
the empty string. Equal rows share a place; if the rest ends among them, as many of them are taken as end nearest
the target, those with the smallest hash of their columns first. Sources without words have target 0. Columns of the
input other than those named are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.llm.common import ranked, word_count
from forumlens.runtime import materialize

WEIGHTS = (5, 2, 1)
TOTAL = 1.5  # of all sizes
MOST = 2  # times a source's size
COARSE, FINE = 256, 65536  # key cells per unit


def quality(text: Column, size: Column) -> Column:
    """1 for texts of about six characters a word, white space counted, and less the further from it."""
    off = F.abs(F.length(text) / size - 6.0)
    return F.coalesce(F.when(size > 0, 1.0 / (1.0 + off / 6.0)), F.lit(1.0))


def sizes_and_keys(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``size`` in words and ``key``."""
    return _keyed(docs.select("doc_id", "source", "text")).drop("text")


def _keyed(docs: DataFrame) -> DataFrame:
    digits = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 12)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)
    sized = docs.withColumn("size", word_count(F.col("text")))
    return sized.withColumn("key", -F.log(u) / quality(F.col("text"), F.col("size")))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL, most: int = MOST) -> DataFrame:
    """``source``, ``source_size`` and ``target``: shares by weight, none above ``most`` times its size.

    A source above its limit stops there and the excess is shared again by weight among the others, until
    none is above. Each round is one aggregate over the table of sources, whose order comes from a
    distributed rank.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").asc_nulls_last()]
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_at") % len(weights) + 1).cast("int"))
    sources = materialize(ranked(sums, order, "mix-sources", "_at").withColumn("weight", weight).drop("_at"), "mix-weights")
    limit = F.col("source_size") * most
    words = sources.agg(F.sum("source_size")).first()[0]
    if not words:
        return sources.select("source", "source_size", F.lit(0.0).alias("target"))
    share = 0.0
    while True:
        full = limit <= share * F.col("weight")
        capped, open_weight = sources.agg(
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if open_weight is None:
            break
        wider = (total * words - capped) / open_weight
        if wider == share:
            break
        share = wider
    target = F.least(limit.cast("double"), F.lit(share) * F.col("weight"))
    return sources.select("source", "source_size", target.alias("target"))


def _cell(cells: int) -> Column:
    return F.floor(F.col("key") * cells)


def cuts(sizes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Where each source's last epoch ends: ``epochs``, the fine ``cell``, the ``last`` place taken in it, how many rows of that (``some`` of ``rows``)."""
    epochs = F.coalesce(F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))), F.lit(0))
    plan = wanted.withColumn("epochs", epochs.cast("long")).withColumn(
        "rest", F.col("target") - F.col("epochs") * F.col("source_size")
    )
    coarse = materialize(_border(sizes, plan.withColumn("before", F.lit(0).cast("long")), COARSE), "mix-coarse")
    inside = _in_cell(sizes, coarse, COARSE)
    fine = materialize(_border(inside, coarse.drop("cell"), FINE), "mix-fine")
    order = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    border = _in_cell(sizes, fine, FINE).groupBy("source", "before", "rest", _place().alias("place")).agg(F.count("*").alias("rows"))
    words = F.col("place.size")
    short = F.col("rest") - F.col("before") - F.coalesce(F.sum(F.col("rows") * words).over(order), F.lit(0))
    # the n-th of equal rows is taken if the sum up to its middle stays within the rest
    some = F.when(words == 0, F.col("rows")).otherwise(F.least(F.floor(short / words + 0.5), F.col("rows")))
    taken = border.withColumn("some", some.cast("long")).where("some > 0")
    last = taken.groupBy("source").agg(F.max(F.struct("place", "some", "rows")).alias("at")).withColumnRenamed("source", "_source")
    found = fine.join(last, fine["source"].eqNullSafe(last["_source"]), "left")
    return materialize(found.select("source", "source_size", "target", "epochs", "cell", F.col("at.place").alias("last"), "at.some", "at.rows"), "mix-cuts")


def _border(rows: DataFrame, plan: DataFrame, cells: int) -> DataFrame:
    """``plan`` with the first cell at whose end the rest is exceeded, and the words before that cell."""
    sums = rows.groupBy("source", _cell(cells).alias("cell")).agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("cell"))
    sums = sums.withColumn("upto", upto).withColumnRenamed("source", "_source")
    past = (
        plan.join(sums, plan["source"].eqNullSafe(sums["_source"]))
        .where(F.col("before") + F.col("upto") > F.col("rest"))
        .groupBy("_source").agg(F.min(F.struct("cell", (F.col("before") + F.col("upto") - F.col("words")).alias("at"))).alias("past"))
    )
    joined = plan.join(past, plan["source"].eqNullSafe(past["_source"]), "left")
    return joined.drop("_source", "before").select("*", F.col("past.cell").alias("cell"), F.coalesce("past.at", F.lit(0)).alias("before")).drop("past")


def _in_cell(rows: DataFrame, plan: DataFrame, cells: int) -> DataFrame:
    own = plan.select(F.col("source").alias("_source"), "cell", "before", "rest")
    return rows.join(own, rows["source"].eqNullSafe(own["_source"]) & (_cell(cells) == own["cell"])).drop("_source", "cell")


def _place() -> Column:
    return F.struct("key", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), "size")


def _split() -> Column:
    """Whether the rest ends among the rows of this place."""
    return F.coalesce((F.col("some") < F.col("rows")) & (_place() == F.col("last")), F.lit(False))


def _copies() -> Column:
    at = _cell(FINE)
    within = F.coalesce(at < F.col("cell"), F.lit(True)) | F.coalesce((at == F.col("cell")) & (_place() <= F.col("last")), F.lit(False))
    # no cell: the whole rest is below it, which is a source without words
    return F.col("epochs") + F.when((F.col("size") > 0) & within & F.col("cell").isNotNull(), 1).otherwise(0)


def _decided(rows: DataFrame, cut: DataFrame, by: list[Column]) -> DataFrame:
    """``rows`` with the columns of ``cut`` and ``copies``; the equal rows among which a rest ends are numbered in the order of ``by``.

    Only those rows are ranked, over all sources at once and by range, so their number does not matter. What a
    source's rows begin with is one row per source.
    """
    cut = cut.withColumnRenamed("source", "_source")
    found = rows.join(cut, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_among", _split())
    plain = found.where(~F.col("_among")).withColumn("copies", _copies())
    if cut.where("some < rows").isEmpty():
        return plain
    among = ranked(found.where("_among"), [F.col("_source").asc_nulls_last(), *by], "mix-equal", "_nth")
    first = among.groupBy("_source").agg(F.min("_nth").alias("_first")).withColumnRenamed("_source", "_of")
    among = among.join(first, F.col("_source").eqNullSafe(F.col("_of"))).withColumn(
        "copies", F.when(F.col("_nth") - F.col("_first") < F.col("some"), _copies()).otherwise(F.col("epochs"))
    )
    return plain.unionByName(among.drop("_nth", "_of", "_first"))


def mix(docs: DataFrame, **share) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken``."""
    sizes = materialize(sizes_and_keys(docs), "mix-sizes")
    found = _decided(sizes, cuts(sizes, targets(sizes, **share)), [F.col("doc_id")])
    return found.select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame, **share) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, no text shuffled where sources are few."""
    names = docs.columns
    sizes = materialize(sizes_and_keys(docs), "mix-sizes")
    cut = cuts(sizes, targets(sizes, **share))
    rows = docs.select(F.struct(*[docs[n] for n in names]).alias("_doc"), "doc_id", "source", "text")
    # rows that share a place differ in other columns only, or not at all
    rows = _decided(_keyed(rows).withColumn("_whole", F.xxhash64("_doc")), cut, [F.col("_whole")])
    taken = rows.where("copies > 0").select("_doc", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return taken.select("_doc.*")
