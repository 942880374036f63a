"""Mix sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

Each source gets a budget of words. The whole source is taken as often as the budget allows (complete epochs); the rest
of the budget is a weighted sample without replacement: a document draws the key ``-ln(u) / quality``, with ``u`` from a
seeded hash of its id, and documents are taken in the order of their keys until the rest is used up. The document in
which it runs out is cut to the words still wanted, so that a source meets its budget to the word.

No source is ever sorted or summed in one task. Keys fall into buckets by their expected rank (the distribution function
of the keys, worked out from the source's qualities), which keeps their order and gives buckets of about ``BUCKET_ROWS``
rows. Sums per bucket are combined before their shuffle, their prefix sums show in which bucket the rest runs out, and
only that one bucket of a source is sorted row by row.

Null texts have no words. A null source is a source of its own. A missing or undefined quality counts as 1, of several
of a document the highest counts, and all are held within ``2**-32`` and ``2**32``. Ties of keys go to the smaller id, then the smaller document; rows that agree in
all of these are interchangeable. A null id draws its key from its text. A source that has no weight, or none above
zero, gets nothing. Empty tables give empty results. Columns besides the named ones are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.binding import bind
from tagloom.operators.ranking import rank_rows
from tagloom.operators.sizing import small_or_whole, staged

SEED = 42
BUCKET_ROWS = 65_536
LIMIT = 32
BLANKS = " \t\n\x0b\f\r"


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+``; null counts as empty."""
    marks = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[^\x20\x09-\x0D]++", "x")
    return F.length(F.translate(marks, BLANKS, "")).cast("bigint")


def uniform(name: Column, seed: int = SEED) -> Column:
    """A number above 0 and below 1 from 52 bits of a seeded hash."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint") + 0.5) / float(2**52)


def cyclic_weights(docs: DataFrame, cycle: tuple[float, ...], source: str = "source") -> DataFrame:
    """``source`` and ``weight`` of each source, by its place among all of them in code point order, null last."""
    names = docs.select(F.col(f"`{source}`").cast("string").alias("source")).distinct().withColumn("_all", F.lit(0))
    placed = rank_rows(names, ["_all"], [F.col("source").asc_nulls_last()], "_place")
    steps = F.array(*[F.lit(float(w)) for w in cycle])
    place = F.pmod(F.col("_place") - 1, F.lit(len(cycle))).cast("int")
    return placed.select("source", F.get(steps, place).alias("weight"))


def targets(totals: DataFrame, share: float, most: float) -> DataFrame:
    """``totals`` (``source_size``, ``weight``) with ``target``: ``share`` of all sizes, dealt out by weight.

    No target passes ``most`` times the size of its source; what that leaves over is dealt to the others by weight,
    again and again until no target is above. Each round is one aggregate over the table of sources.
    """
    cap = F.col("source_size") * F.lit(float(most))
    weighs = F.coalesce((F.col("weight") > 0) & ~F.isnan("weight"), F.lit(False))
    whole = totals.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        capped = weighs & (cap <= F.col("weight") * F.lit(level))
        row = totals.agg(
            F.count(F.when(capped, 1)).alias("full"),
            F.sum(F.when(capped, cap)).alias("given"),
            F.sum(F.when(weighs & ~capped, F.col("weight"))).alias("left"),
        ).first()
        if row["full"] == full:
            break
        full = row["full"]
        level = (share * whole - (row["given"] or 0.0)) / row["left"] if row["left"] else math.inf
    return totals.withColumn("target", F.when(weighs, F.least(cap, F.col("weight") * F.lit(level))).otherwise(F.lit(0.0)))


def _expected_rank(key: Column, classes: Column) -> Column:
    """Share of the source's documents that are expected to draw a smaller key."""
    return F.aggregate(classes, F.lit(0.0), lambda sum_, c: sum_ - c["share"] * F.expm1(-(c["quality"] * key)))


def _rated(rows: DataFrame, ratings: DataFrame | None, key: str) -> DataFrame:
    """Narrow ``rows`` with the ``_quality`` of their ``_id``."""
    if ratings is None:
        return rows.withColumn("_quality", F.lit(1.0))
    given = F.col("quality").cast("double")
    best = ratings.filter(given.isNotNull() & ~F.isnan(given)).groupBy(F.col(f"`{key}`").alias("_id")).agg(F.max(given).alias("_rating"))
    held = F.least(F.greatest(F.coalesce("_rating", F.lit(1.0)), F.lit(2.0**-LIMIT)), F.lit(2.0**LIMIT))
    return rows.join(small_or_whole(best), "_id", "left").withColumn("_quality", held).drop("_rating")


def mix(
    docs: DataFrame,
    weights: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    ratings: DataFrame | None = None,
    share: float = 1.5,
    most: float = 2.0,
    seed: int = SEED,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``key``, ``source``, ``size``, ``source_size``, ``target`` and ``taken`` words of every document.

    ``weights`` has one row per source (``source``, ``weight``), ``ratings`` the qualities (``key``, ``quality``) of
    documents. ``taken`` counts repeats: a document taken twice has twice its size. Only ids, sources, sizes and keys are
    written down and joined; texts are read once and never moved.
    """
    body, id_ = F.col(f"`{text}`").cast("string"), F.col(f"`{key}`")
    name = F.coalesce(id_.cast("string"), F.concat(F.lit("text:"), body), F.lit("none"))
    drawn = docs.select(
        id_.alias("_id"),
        F.col(f"`{source}`").cast("string").alias("_source"),
        word_count(body).alias("_size"),
        F.xxhash64(body).alias("_doc"),
        uniform(name, seed).alias("_u"),
    )
    drawn = _rated(drawn, ratings, key)
    rows = staged(drawn.withColumn("_key", -F.log("_u") / F.col("_quality")).drop("_u"), "sizes")

    # one row per source and power of two of the quality: what the expected ranks need
    groups = rows.groupBy("_source", F.floor(F.log2("_quality")).alias("_power")).agg(
        F.count("*").alias("_n"), F.sum("_size").alias("_words"), F.avg("_quality").alias("_mean")
    )
    classes = F.sort_array(F.collect_list(F.struct(F.col("_mean").alias("quality"), F.col("_n").alias("n"))))
    sources = groups.groupBy("_source").agg(F.sum("_words").alias("source_size"), F.sum("_n").alias("_docs"), classes.alias("_raw"))
    sources = sources.withColumn(
        "_classes", F.transform("_raw", lambda c: F.struct(c["quality"].alias("quality"), (c["n"] / F.col("_docs")).alias("share")))
    ).drop("_raw")
    given = weights.select(F.col("source").cast("string").alias("_w_source"), F.col("weight").cast("double").alias("weight"))
    given = small_or_whole(given)
    sources = staged(sources.join(given, F.col("_source").eqNullSafe(F.col("_w_source")), "left").drop("_w_source"), "sources")
    plans = targets(sources, share, most).withColumns({
        "_epochs": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)),
        "_buckets": F.ceil(F.col("_docs") / F.lit(bucket_rows)),
    })
    plans = plans.withColumn("_rest", F.round("target").cast("bigint") - F.col("_epochs") * F.col("source_size"))
    plans = small_or_whole(plans.withColumnRenamed("_source", "_p_source").drop("weight", "_docs"))

    expected = F.floor(F.col("_buckets") * _expected_rank(F.col("_key"), F.col("_classes")))
    placed = rows.join(plans, F.col("_source").eqNullSafe(F.col("_p_source"))).withColumn(
        "_bucket", F.greatest(F.lit(0), F.least(expected, F.col("_buckets") - 1))
    )
    sums = placed.groupBy("_source", "_bucket").agg(F.sum("_size").alias("_in"), F.first("_rest").alias("_rest"))
    before = F.sum("_in").over(Window.partitionBy("_source").orderBy("_bucket")) - F.col("_in")
    # the rest runs out in the last bucket that begins before it is used up
    ends = sums.withColumn("_before", before).filter(F.col("_before") < F.col("_rest")).groupBy("_source").agg(
        F.max(F.struct("_bucket", "_before")).alias("_end")
    )
    ends = small_or_whole(ends.select(F.col("_source").alias("_e_source"), "_end._bucket", "_end._before").toDF("_e_source", "_at", "_before"))
    met = placed.join(ends, F.col("_source").eqNullSafe(F.col("_e_source")), "left")

    out = [F.col("_id").alias(key), F.col("_source").alias(source), F.col("_size").alias("size"), "source_size", "target"]
    epochs = F.col("_epochs") * F.col("_size")
    plain = F.coalesce(F.col("_bucket") != F.col("_at"), F.lit(True))
    whole = F.when(F.coalesce(F.col("_bucket") < F.col("_at"), F.lit(False)), F.col("_size")).otherwise(F.lit(0))
    order = Window.partitionBy("_source").orderBy("_key", F.col("_id").asc_nulls_last(), "_doc", "_size")
    upto = F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    wanted = bind(F.col("_rest") - F.col("_before") - (F.col("_upto") - F.col("_size")), lambda n: F.greatest(F.lit(0), F.least(n, F.col("_size"))))
    sorted_ = met.filter(~plain).withColumn("_upto", upto)
    return met.filter(plain).select(*out, (epochs + whole).cast("bigint").alias("taken")).unionByName(
        sorted_.select(*out, (epochs + wanted).cast("bigint").alias("taken"))
    )


def copies(docs: DataFrame, mixed: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents of a mix, a row for each time one is taken, with ``epoch`` counted from 0.

    The last copy may be cut: it holds the first words still wanted, joined by blanks. Keys must be unique and not null.
    """
    if mixed.groupBy(key).count().filter(F.col("count") > 1).union(mixed.filter(F.col(key).isNull()).groupBy(key).count()).head(1):
        raise ValueError(f"copies need a {key} that is unique and never null")
    own = [f"`{c}`" for c in docs.columns if c.lower() not in ("epoch", "_taken", "_size")]
    taken = mixed.filter("taken > 0").select(key, F.col("taken").alias("_taken"), F.col("size").alias("_size"))
    rows = docs.join(taken, key).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.ceil(F.col("_taken") / F.col("_size")).cast("int") - 1)))
    left = F.col("_taken") - F.col("epoch") * F.col("_size")
    words = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(r"([^\x20\x09-\x0D]++)"), 1)
    cut = F.when(left >= F.col("_size"), F.col(f"`{text}`")).otherwise(F.array_join(F.slice(words, F.lit(1), left.cast("int")), " "))
    return rows.withColumn(text, cut).select(*own, "epoch")
