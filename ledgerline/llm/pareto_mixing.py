"""Mixing sources to target weights by Pareto order sampling.

A source whose target is r times its size gives every document floor(r) whole copies for certain; one more copy goes
to a sample of its documents. The sample is drawn by Pareto's order sampling: with u uniform (a hash of the document)
and p the document's inclusion probability, documents are ranked by (u / (1 - u)) / (p / (1 - p)), and the first ones
are taken. The sample's size is fixed in words: it ends with the last document that still fits, and the one document
beyond whose size comes nearest to the words that are left fills the gap. ``weight`` makes probabilities unequal inside a source
(r is then shared in proportion to it); without one, p is the fraction of r for the whole source.

The cut is found by radix selection: sums of words per (source, 12 bits of the rank) narrow the cut to one digit, then
to the next; no source's documents are ever gathered or sorted, and a document decides for itself on which side of
its source's cut it lies. Rows of one rank follow each other by id, then by the hash of the text, then by a number that
every row has; so a source is cut inside rows that are equal in id and text as well, as many as they are, and which of the equal
rows are taken makes no difference. Rows without an id are ranked by the hash of their text.

Sources are shared out in one task, which holds two numbers and a name for each.

Defined cases: a null text has size 0; a null source is a source of its own, last in order; a source of size 0 has
target 0 and its documents no copies; repeated and null ids are rows like others; a text without words takes no words: it
comes or not by its rank; no rows in, no rows out; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Staged, n_words, read, scratch, small_or_not

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix-1"
#: Up to so many sources, their table of targets and cuts is broadcast.
BROADCAST_SOURCES = 100_000
BITS, LEVELS = 12, 4  # 48 of the 52 bits of a rank; what still ties is ordered exactly


def _number(md5: Column) -> Column:
    return F.conv(F.substring(md5, 1, 13), 16, 10).cast("long")


def text_number(text: Column) -> Column:
    """A number from 0 to 2 ** 52 - 1 for each text."""
    return _number(F.md5(F.coalesce(text, F.lit(""))))


def draw(doc_id: Column, tie: Column) -> Column:
    """A number from 0 to 2 ** 52 - 1 for each id; rows without one have one for each ``tie``."""
    return _number(F.md5(F.concat(F.lit(SEED + "|"), F.coalesce(doc_id.cast("string"), F.concat(F.lit("|"), tie.cast("string"))))))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size) with target: all words shared by weight, no source above ``most`` times its size, and
    the excess shared again among the others. In order of the ratio where a source stops, the sources that stop come
    first, so the level that the others reach follows from running sums."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy(F.col("ratio"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    t = sizes.withColumn("w", weight).withColumn("ratio", most * F.col("source_size") / F.col("w"))
    t = t.withColumn("total", F.sum("source_size").over(everything))
    t = t.withColumn("level", (F.col("total") - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("w").over(after))
    t = t.withColumn("reached", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "level"))).over(everything)["level"])
    target = F.when((F.col("total") == 0) | (F.col("ratio") <= F.col("reached")), (most * F.col("source_size")).cast("double")).otherwise(F.col("reached") * F.col("w"))
    return t.select("source", "source_size", target.alias("target"))


ORDER = ("rank", "u", "doc_id", "tie")
#: The number of a row, above all that there are: a cut after all rows that are equal in ORDER.
LAST = 2**63 - 1


def plan(docs: DataFrame, size: Column, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, weight: Column | None = None, row: Column | None = None) -> tuple[Staged, DataFrame, int]:
    """A staged row for each document (doc_id, source, size, u, tie, row, share) and, for each source, what decides about its
    documents: source_size, target, whole copies at least, p, the cut, the row that fills the gap, and whether it took the rows'
    numbers (``row``) to tell apart what it takes. Also the number of sources, as far as BROADCAST_SOURCES + 1."""
    with scratch() as keep:
        rows, found, n = _plan(docs, size, weights, most, weight, row)
        keep += [rows, found]
    return rows, found.df, n


def _plan(docs: DataFrame, size: Column, weights: tuple[int, ...], most: int, weight: Column | None, row: Column | None) -> tuple[Staged, Staged, int]:
    tie = text_number(F.col("text")) if "text" in docs.columns else size.cast("long")
    share = F.lit(1.0) if weight is None else F.greatest(F.coalesce(weight.cast("double"), F.lit(0.0)), F.lit(0.0))
    number = F.monotonically_increasing_id() if row is None else row
    rows = Staged(docs.select("doc_id", "source", size.alias("size"), tie.alias("tie"), share.alias("share"), number.alias("row")).withColumn("u", draw(F.col("doc_id"), F.col("tie"))), "mix")
    per = rows.df.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("share")).alias("shared"))
    goal = targets(per.select("source", "source_size"), weights, most)
    goal = goal.join(per.select(F.col("source").alias("s2"), "shared"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    goal = Staged(goal.withColumn("rate", F.when(F.col("shared") > 0, F.col("target") / F.col("shared")).otherwise(F.lit(0.0))), "mix-goal").df
    goal, n = small_or_not(goal, BROADCAST_SOURCES)
    copies = ranked(rows.df, goal, most)
    sure = copies.groupBy("source").agg(F.sum(F.col("size") * F.col("whole")).alias("sure"))
    left = goal.join(sure.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2"))).select(F.col("source").alias("g_source"), (F.col("target") - F.col("sure")).alias("left"))
    left = Staged(left.withColumn("low", F.lit(0).cast("long")), "mix-left").df
    open_rows = copies.filter((F.col("p") > 0) & (F.col("size") > 0)).select("source", "size", *ORDER, "row")
    for level in range(LEVELS):  # the digit in which the cut lies, and what is left when it begins
        shift = 52 - BITS * (level + 1)
        near = left if n > BROADCAST_SOURCES else F.broadcast(left)
        inside = open_rows.join(near, F.col("source").eqNullSafe(F.col("g_source")) & (F.shiftright("rank", shift + BITS) == F.col("low")))
        sums = inside.groupBy("g_source", "left", F.shiftright("rank", shift).alias("digit")).agg(F.sum("size").alias("words"))
        run = Window.partitionBy("g_source").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.coalesce(F.sum("words").over(run), F.lit(0)))
        # the last digit that begins before the words are used up; a source none of whose rows are open has no cut
        cut = sums.filter(F.col("before") <= F.col("left")).groupBy("g_source").agg(F.max(F.struct("digit", (F.col("left") - F.col("before")).alias("left"))).alias("c"))
        left = Staged(cut.select("g_source", F.col("c.left").alias("left"), F.col("c.digit").alias("low")), "mix-left").df
    near = left if n > BROADCAST_SOURCES else F.broadcast(left)
    inside = open_rows.join(near, F.col("source").eqNullSafe(F.col("g_source")) & (F.shiftright("rank", 52 - BITS * LEVELS) == F.col("low")))
    same = inside.groupBy("g_source", "left", *ORDER, "size").agg(F.count("*").alias("n"))
    run = Window.partitionBy("g_source").orderBy("rank", "u", F.col("doc_id").asc_nulls_first(), "tie", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same = same.withColumn("up_to", F.sum(F.col("n") * F.col("size")).over(run)).withColumn("before", F.col("up_to") - F.col("n") * F.col("size"))
    whole = same.filter(F.col("up_to") <= F.col("left")).select("g_source", F.struct(*ORDER, F.lit(LAST).alias("row")).alias("cut"), F.lit(False).alias("tied"))
    some = same.withColumn("take", F.floor((F.col("left") - F.col("before")) / F.col("size"))).filter((F.col("before") <= F.col("left")) & (F.col("up_to") > F.col("left")) & (F.col("take") > 0))
    some = Staged(some.select("g_source", *[F.col(c).alias(f"at_{c}") for c in ORDER], "take"), "mix-ties").df
    if some.head(1):  # the cut lies inside rows that are equal in ORDER
        whole = whole.unionByName(_among_equals(open_rows, some if n > BROADCAST_SOURCES else F.broadcast(some)))
    cuts = whole.groupBy("g_source").agg(F.max(F.struct("cut", "tied")).alias("last")).select("g_source", "last.cut", "last.tied")
    starts = left.join(cuts.withColumnRenamed("g_source", "c_source"), F.col("g_source").eqNullSafe(F.col("c_source")), "left")
    # when no row of the last digit is taken, the cut is the digit's beginning
    begin = F.shiftleft(F.col("low"), 52 - BITS * LEVELS)
    starts = starts.select(F.col("g_source"), begin.alias("begin"), "cut", "tied")
    plan_ = Staged(goal.join(starts, F.col("source").eqNullSafe(F.col("g_source")), "left").drop("g_source"), "mix-plan").df
    found = ranked(rows.df, plan_ if n > BROADCAST_SOURCES else F.broadcast(plan_), most).withColumn("taken", before_cut())
    so_far = found.groupBy("source", "target").agg(F.sum(F.col("size") * (F.col("whole") + F.col("taken").cast("long"))).alias("words"))
    gap = so_far.select(F.col("source").alias("g_source"), (F.col("target") - F.col("words")).alias("gap"))
    gap = Staged(gap, "mix-gap").df
    beyond = found.filter((F.col("p") > 0) & ~F.col("taken") & (F.col("size") > 0)).join(gap if n > BROADCAST_SOURCES else F.broadcast(gap), F.col("source").eqNullSafe(F.col("g_source")))
    miss = F.abs(F.col("size") - F.col("gap"))
    fills = beyond.filter(miss < F.col("gap")).groupBy("g_source").agg(F.min(F.struct(miss.alias("miss"), *ORDER, "row")).alias("fill"))
    fills = Staged(fills.select("g_source", F.struct(*[F.col(f"fill.{c}").alias(c) for c in (*ORDER, "row")]).alias("fill")), "mix-fills").df
    near = (fills if n > BROADCAST_SOURCES else F.broadcast(fills)).withColumnRenamed("g_source", "f_source")
    equal = beyond.drop("fill").join(near, F.col("source").eqNullSafe(F.col("f_source")) & (F.struct(*ORDER) == F.struct(*[F.col("fill").getField(c).alias(c) for c in ORDER])))
    alone = equal.groupBy("f_source").agg(F.first("fill").alias("fill"), (F.count("*") > 1).alias("several"))
    plan_ = plan_.join(alone, F.col("source").eqNullSafe(F.col("f_source")), "left").drop("f_source")
    plan_ = plan_.withColumn("tied", F.coalesce("tied", F.lit(False)) | F.coalesce("several", F.lit(False))).drop("several")
    return rows, Staged(plan_, "mix-filled"), n


def _among_equals(rows: DataFrame, some: DataFrame) -> DataFrame:
    """(g_source, cut, tied): the cuts that take the first ``take`` by number of the rows that are equal in ORDER. A number has
    its partition's above its place in it: counts by partition find the partition, and only that one's are ranked."""
    equal = F.col("source").eqNullSafe(F.col("g_source")) & (F.struct(*ORDER) == F.struct(*[F.col(f"at_{c}").alias(c) for c in ORDER]))
    members = rows.join(some, equal).select("g_source", "take", F.shiftright("row", 33).alias("part"), *ORDER, "row")
    run = Window.partitionBy("g_source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = members.groupBy("g_source", "take", "part").agg(F.count("*").alias("n")).withColumn("skipped", F.coalesce(F.sum("n").over(run), F.lit(0)))
    found = by_part.filter((F.col("skipped") < F.col("take")) & (F.col("take") <= F.col("skipped") + F.col("n")))
    found = found.select(F.col("g_source").alias("p_source"), F.col("part").alias("in_part"), (F.col("take") - F.col("skipped")).alias("place"))
    inside = members.join(found, F.col("g_source").eqNullSafe(F.col("p_source")) & (F.col("part") == F.col("in_part")))
    last = inside.withColumn("at", F.row_number().over(Window.partitionBy("g_source").orderBy("row"))).filter(F.col("at") == F.col("place"))
    return last.select("g_source", F.struct(*ORDER, "row").alias("cut"), F.lit(True).alias("tied"))


def before_cut() -> Column:
    """Whether a ranked row lies before its source's cut."""
    key = F.struct(*ORDER, "row")
    return (F.col("p") > 0) & F.coalesce((F.col("rank") < F.col("begin")) | F.coalesce(key <= F.col("cut"), F.lit(False)), F.lit(False))


def ranked(rows: DataFrame, goal: DataFrame, most: int) -> DataFrame:
    """Rows with their certain copies, the probability p of one more, and their rank as 52 bits."""
    g = goal.select(F.col("source").alias("g_source"), *[c for c in goal.columns if c != "source"])
    r = F.least(F.col("rate") * F.col("share"), F.lit(float(most)))
    x = rows.join(g, F.col("source").eqNullSafe(F.col("g_source"))).drop("g_source").withColumn("whole", F.floor(r).cast("long")).withColumn("p", r - F.floor(r))
    uniform = (F.col("u") + 0.5) / float(2**52)
    odds = (uniform / (1 - uniform)) / (F.col("p") / (1 - F.col("p")))
    return x.withColumn("rank", F.when(F.col("p") > 0, F.floor(odds / (1 + odds) * float(2**52 - 1)).cast("long")))


def copies(rows: DataFrame, plan_: DataFrame, n_sources: int, most: int = MOST) -> DataFrame:
    """Rows (with doc_id, source, size, u, tie, row, share) and ``copies``, the whole copies that the mix takes."""
    found = ranked(rows, F.broadcast(plan_) if n_sources <= BROADCAST_SOURCES else plan_, most)
    key = F.struct(*ORDER, "row")
    chosen = before_cut() | ((F.col("p") > 0) & F.coalesce(key == F.col("fill"), F.lit(False)))
    return found.withColumn("copies", F.col("whole") + F.when(chosen, 1).otherwise(0))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mixed documents: each as often as the mix takes it, with the columns of ``docs``."""
    kept = docs.columns
    size = n_words(F.col("text"))
    staged, plan_, n = plan(docs.select("doc_id", "source", "text"), size, weights, most)
    staged.drop()
    number = F.lit(0).cast("long")
    if plan_.filter("tied").head(1):  # rows need their numbers, and these must not change: written once, with the rows
        held = Staged(docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("held"), F.monotonically_increasing_id().alias("number")), "mix-rows").df
        docs, number = held, F.col("number")
        of = lambda c: F.col("held").getField(c)
        staged, plan_, n = plan(held.select(*[of(c).alias(c) for c in ("doc_id", "source", "text")], "number"), size, weights, most, row=number)
        staged.drop()
        row = F.col("held")
    else:
        of = lambda c: F.col(c)
        row = F.struct(*[F.col(f"`{c}`") for c in kept])
        plan_ = plan_.withColumn("fill", F.when(F.col("fill").isNotNull(), F.struct(*[F.col("fill").getField(c).alias(c) for c in ORDER], number.alias("row"))))
    whole = docs.select(of("doc_id").alias("doc_id"), of("source").alias("source"), F.lit(0).alias("size"), text_number(of("text")).alias("tie"), F.lit(1.0).alias("share"), number.alias("row"), row.alias("kept"))
    out = copies(whole.withColumn("u", draw(F.col("doc_id"), F.col("tie"))), plan_, n, most).filter("copies > 0")
    return out.select(F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"), "kept").select(*[F.col("kept").getField(c).alias(c) for c in kept])


def op3_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    staged, plan_, n = plan(docs, n_words(F.col("text")))
    out = copies(staged.df, plan_, n)
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLE_OP3 = """
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(text, '')), 1, 13) AS BIGINT) AS tie
  FROM documents),
e AS (SELECT *, CAST('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '|' || CAST(tie AS VARCHAR))), 1, 13) AS BIGINT) AS u FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS DOUBLE) AS w,
             CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM s),
r AS (SELECT *, 3 * source_size / w AS ratio FROM w),
l AS (SELECT *, (total - 3 * coalesce(sum(source_size) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
f AS (SELECT *, (SELECT arg_min(level, ratio) FROM l WHERE ratio > level) AS reached FROM l),
t AS (SELECT source, source_size, CASE WHEN total = 0 OR ratio <= reached THEN CAST(3 * source_size AS DOUBLE) ELSE reached * w END AS target FROM f),
j AS (SELECT e.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
      FROM e JOIN t ON e.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, CAST(floor(least(rate, 3.0)) AS BIGINT) AS whole, least(rate, 3.0) - floor(least(rate, 3.0)) AS p FROM j),
c AS (SELECT *, sum(CASE WHEN p > 0 THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY u, doc_id NULLS FIRST, tie ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS up_to,
             target - sum(size * whole) OVER (PARTITION BY source) AS open FROM k),
h AS (SELECT *, p > 0 AND up_to <= open AS taken FROM c),
g AS (SELECT *, target - sum(size * (whole + CAST(taken AS BIGINT))) OVER (PARTITION BY source) AS gap FROM h),
z AS (SELECT *, p > 0 AND NOT taken AND size > 0 AND abs(size - gap) < gap AS may FROM g),
y AS (SELECT *, may AND row_number() OVER (PARTITION BY source, may ORDER BY abs(size - gap), u, doc_id NULLS FIRST, tie) = 1 AS fills FROM z)
SELECT doc_id, size, source_size, target, CAST(size * (whole + CAST(taken OR fills AS BIGINT)) AS BIGINT) AS taken
FROM y
"""
