"""Mixing sources to target weights by Pareto order sampling (operator 1). DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.session import stored

WORD = r"[^\x20\x09-\x0D]+"
MOST = 3  # copies of a document at most
BINS = 1 << 10  # per level, of two
PASSES = 2  # the second passes over the long document at which the first stops


def word_count(text: str | Column = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def _level(need: Column, group: list[str], order: list[Column], capacity: Column, demand: Column) -> Column:
    """What all rows from here on get per unit of demand if every row before is full. In order of rising capacity per
    unit, the fill level is the largest of these at which the row itself doesn't overflow."""
    rows = Window.partitionBy(*group).orderBy(*order)
    full = F.coalesce(F.sum(capacity).over(rows.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return F.try_divide(need - full, F.sum(demand).over(rows.rowsBetween(0, Window.unboundedFollowing)))


def source_targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """source, source_size, target. Sources by code point, null last, weigh 1, 2, 3, repeating; a target stops at `most`
    times its source's size and the excess is shared by weight again. The windows run over one row for each source."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    rows = totals.withColumns({"weight": (number - 1) % 3 + 1, "total": F.sum("source_size").over(Window.partitionBy()).cast("double")})
    capacity = (F.col("source_size") * most).cast("double")
    order = [(F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    rows = rows.withColumn("level", _level(F.col("total"), [], order, capacity, F.col("weight").cast("double")))
    fits = F.when(F.col("level") * F.col("weight") <= capacity, F.col("level"))
    level = F.coalesce(F.max(fits).over(Window.partitionBy()), F.lit(0.0))
    return rows.select("source", "source_size", F.least(capacity, level * F.col("weight")).alias("target"))


def _copies(sizes: DataFrame, targets: DataFrame, most: int) -> DataFrame:
    """source, class, source_size, target, whole, share: what each document of a class gets for certain, and the
    probability of one copy more. Expected copies are proportional to the class and stop at `most`; together they make
    the source's target. One row for each source and class, 63 classes at most."""
    classes = sizes.groupBy("source", "class").agg(F.sum("size").alias("words"))
    rows = classes.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    capacity, demand = (F.col("words") * most).cast("double"), (F.col("words") * F.col("class")).cast("double")
    group = ["source"]
    rows = rows.withColumn("level", _level(F.col("target"), group, [F.col("class").desc()], capacity, demand))
    fits = F.when(F.col("level") * F.col("class") <= most, F.col("level"))
    level = F.coalesce(F.max(fits).over(Window.partitionBy(*group)), F.lit(0.0))
    expected = F.round(F.least(F.lit(float(most)), level * F.col("class")), 9)
    return rows.withColumn("expected", expected).select(
        "source", "class", "source_size", "target", F.floor("expected").alias("whole"), (F.col("expected") - F.floor("expected")).alias("share")
    )


def _ranked(docs: DataFrame, seed: str) -> DataFrame:
    """The rows of docs with _size, _class and _u, a number between 0 and 1 that depends on the id alone."""
    text = F.col("text").cast("string")
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    number = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary")), 1, 13), 16, 10).cast("double")
    return docs.withColumns({"_size": word_count(text), "_u": (number + 0.5) / float(1 << 52)}).withColumn("_class", F.length(F.bin("_size")))


def _rank(u: Column, share: Column, size: Column) -> Column:
    """Odds ratio q = odds(u) / odds(share) as q / (1 + q), which keeps its order and lies between 0 and 1."""
    return F.when((share > 0) & (size > 0), u * (1 - share) / (u * (1 - share) + (1 - u) * share))


def _drawn(draws: Column, size: Column, rank: Column) -> Column:
    """Whether one of the draws takes a document: it fits the gap, and its rank lies before the cut."""
    bin_ = F.floor(rank * (BINS * BINS))
    return F.coalesce(F.exists(draws, lambda d: (size <= d["gap"]) & ((bin_ < d["bin"]) | (rank <= d["rank"]))), F.lit(False))


def _same(column: str, other: str) -> Column:
    return F.col(column).eqNullSafe(F.col(other))


def _draw(rows: DataFrame, draws: DataFrame) -> DataFrame:
    """One draw more for each source: the documents of lowest rank that fit together into the words that it still lacks,
    up to the first that doesn't. rows: source, size, rank, whole, target. draws: source, draws so far.

    Sums over BINS * BINS ranges of ranks tell in which range the cut falls; only that range is put in order.
    """
    rows = rows.join(draws.withColumnRenamed("source", "_source"), _same("source", "_source")).drop("_source")
    taken = _drawn(F.col("draws"), F.col("size"), F.col("rank"))
    used = F.sum((F.col("whole") + taken.cast("long")) * F.col("size"))
    gaps = stored(rows.groupBy("source").agg((F.max("target") - used).alias("gap"))).withColumnRenamed("source", "_source")
    free = rows.filter(F.col("rank").isNotNull() & ~taken).join(gaps, _same("source", "_source")).filter("size <= gap").select(
        "source", "size", "rank", "gap", F.floor(F.col("rank") * (BINS * BINS)).alias("bin")
    )
    coarse = F.floor(F.col("bin") / BINS).alias("coarse")
    bins = free.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.max("gap").alias("gap"))
    heads = bins.groupBy("source", coarse).agg(F.sum("words").alias("words"))
    above = Window.partitionBy("source").orderBy("coarse").rowsBetween(Window.unboundedPreceding, -1)  # BINS rows at most
    heads = heads.select(F.col("source").alias("_source"), F.col("coarse").alias("_coarse"), F.coalesce(F.sum("words").over(above), F.lit(0)).alias("_head"))
    inside = Window.partitionBy("source", "coarse").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # BINS rows at most
    placed = bins.withColumn("coarse", coarse).withColumn("_inside", F.coalesce(F.sum("words").over(inside), F.lit(0)))
    placed = placed.join(heads, _same("source", "_source") & _same("coarse", "_coarse")).withColumn("ahead", F.col("_head") + F.col("_inside"))
    cut = stored(placed.filter("ahead + words > gap").groupBy("source").agg(F.min(F.struct("bin", "ahead")).alias("cut")))

    near = free.join(cut.withColumnRenamed("source", "_source"), _same("source", "_source") & (F.col("bin") == F.col("cut.bin")))
    near = near.withColumn("sum", F.col("cut.ahead") + F.sum("size").over(Window.partitionBy("source").orderBy("rank")))
    last = near.filter("sum <= gap").groupBy("source").agg(F.max("rank").alias("rank")).withColumnRenamed("source", "_last")
    found = draws.join(gaps, _same("source", "_source")).drop("_source").join(cut.withColumnRenamed("source", "_source"), _same("source", "_source"), "left")
    found = found.join(last, _same("source", "_last"), "left")
    new = F.struct(
        F.col("gap"), F.coalesce("cut.bin", F.lit(BINS * BINS + 1)).cast("long").alias("bin"), F.coalesce("rank", F.lit(-1.0)).alias("rank")
    )
    return stored(found.select("source", F.concat("draws", F.array(new)).alias("draws")))


def plan(docs: DataFrame, seed: str = "mix", most: int = MOST) -> DataFrame:
    """What `mix` does with each source and length class: source, class, source_size, target, whole, share, draws, last.
    63 rows at most for each source."""
    sizes = stored(_ranked(docs, seed).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("_size").alias("size"),
        F.col("_class").alias("class"), F.col("_u").alias("u"),
    ))
    copies = stored(_copies(sizes, source_targets(sizes, most), most))
    other = copies.withColumnsRenamed({"source": "_source", "class": "_class"})
    rows = sizes.join(other, _same("source", "_source") & (F.col("class") == F.col("_class"))).select(
        "doc_id", "source", "size", "target", "whole", _rank(F.col("u"), F.col("share"), F.col("size")).alias("rank")
    )
    empty = F.array().cast("array<struct<gap:double,bin:bigint,rank:double>>")
    draws = stored(copies.select("source").distinct().withColumn("draws", empty))
    for _ in range(PASSES):
        draws = _draw(rows, draws)

    # the words that the draws leave open go to one document more, the one whose size is nearest to them
    joined = rows.join(draws.withColumnRenamed("source", "_source"), _same("source", "_source")).withColumn(
        "taken", _drawn(F.col("draws"), F.col("size"), F.col("rank"))
    )
    used = F.sum((F.col("whole") + F.col("taken").cast("long")) * F.col("size"))
    gaps = joined.groupBy("source").agg((F.max("target") - used).alias("gap")).withColumnRenamed("source", "_gap_of")
    miss = F.abs(F.col("size") - F.col("gap"))
    left = joined.filter("rank is not null and not taken").join(gaps, _same("source", "_gap_of")).filter(miss < F.col("gap"))
    last = left.groupBy("source").agg(F.min(F.struct(miss.alias("miss"), "rank", "doc_id", "size")).alias("last"))
    result = copies.join(draws.withColumnRenamed("source", "_source"), _same("source", "_source")).drop("_source")
    return stored(result.join(last.withColumnRenamed("source", "_source"), _same("source", "_source"), "left").drop("_source"))


def with_copies(docs: DataFrame, seed: str = "mix", most: int = MOST, carry: bool = True) -> DataFrame:
    """row (the whole input row as a struct; null if `carry` is off), doc_id, source, _size, _source_size, _target and
    _copies for every row of docs; no shuffle of the texts unless the plan is large."""
    rules = plan(docs, seed, most)
    rules = rules.select(*(F.col(c).alias(f"_{c}") for c in rules.columns)).withColumnRenamed("_class", "_rule_class")
    row = F.struct("*") if carry else F.lit(None).cast("boolean")
    rows = _ranked(docs.select(row.alias("row"), "doc_id", "text", "source"), seed)
    rows = rows.join(rules, F.col("source").cast("string").eqNullSafe(F.col("_source")) & (F.col("_class") == F.col("_rule_class")))
    size, rank = F.col("_size"), _rank(F.col("_u"), F.col("_share"), F.col("_size"))
    closing = (rank == F.col("_last.rank")) & F.col("doc_id").cast("long").eqNullSafe(F.col("_last.doc_id")) & (size == F.col("_last.size"))
    one = _drawn(F.col("_draws"), size, rank) | F.coalesce(closing, F.lit(False))
    return rows.withColumn("_copies", F.col("_whole") + one.cast("long")).select("row", "doc_id", "source", "_size", "_source_size", "_target", "_copies")


def mix(docs: DataFrame, seed: str = "mix", most: int = MOST) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (copies times size) for every row of docs.

    A document's expected copies grow with the length class of its text (the binary digits of its number of words) and
    make up its source's target. Their whole part is certain. The rest of the target is filled with one copy more of
    some documents: ranked by the odds of a random number over the odds of the fractional part, they are taken as long as
    they fit, once more among those that fit into what is left, and one document closes the gap. The random number comes
    from the id (from the text where the id is null), so reruns agree.

    Rows that repeat an id rank side by side and are taken together or not at all where they have the same size. Null and
    empty texts have no words and take none. A null source is a source. Further columns are ignored; an empty table
    gives no rows.
    """
    return with_copies(docs, seed, most, carry=False).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_copies").alias("copies"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
    )


def mixed(docs: DataFrame, seed: str = "mix", most: int = MOST) -> DataFrame:
    """The rows of docs with all their columns, whatever their names, each as often as the mix takes it."""
    rows = with_copies(docs, seed, most).filter("_copies > 0")
    copies = rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("_copy"))
    return copies.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
