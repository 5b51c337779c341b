"""Filter interaction audit over all orders of a few filters.

Every document gets a mask of the filters it fails, so that a table of
(part, mask) counts holds all that any order needs.  The permutations of the
filters in lexicographic order have Lehmer ranks; those that begin with the same
letters are one interval of ranks.  A mask is removed at step k by the orders
whose first k - 1 letters are outside the mask and whose k-th is in it, so each
mask's removals are a few intervals per step.  Counts are added at the start of
an interval and taken off at its end; a running sum over the ranks then gives
the totals of every order and step.  No order is ever run over the documents.

Defined cases: null text is empty; a null part is the empty string; null labels
and labels of unknown ids count nothing, several labels of one id count once;
rows with a null id are copies of nothing (and their id makes no other row a
copy); rows that repeat an id count as documents of their own, and the smallest
id of a text never fails as a copy, however often it comes; an empty table gives
an empty result; extra columns are not read.
"""
from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, DataFrame, SparkSession, cut_lineage, table

LETTERS = "ABCDE"
MIN_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 3
SUMS = ["removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


# -- orders and intervals ---------------------------------------------------------
def lehmer_rank(prefix: str, letters: str = LETTERS) -> int:
    """Rank of the first permutation, in lexicographic order, that begins so."""
    left, rank = sorted(letters), 0
    for i, c in enumerate(prefix):
        rank += left.index(c) * factorial(len(letters) - i - 1)
        left.remove(c)
    return rank


def intervals(letters: str = LETTERS) -> list[tuple[int, int, int, int, str]]:
    """(mask, step, first rank, end rank, what) for every mask: the orders in
    which a document of the mask is removed at the step, or fails the step's
    filter after an earlier one removed it (redundant), or fails this filter
    alone (unique; it is removed as well)."""
    bit = {c: 1 << i for i, c in enumerate(letters)}
    out = []
    for mask in range(1, 1 << len(letters)):
        for step in range(1, len(letters) + 1):
            for p in permutations(sorted(letters), step):
                if not mask & bit[p[-1]]:
                    continue
                a = lehmer_rank("".join(p), letters)
                b = a + factorial(len(letters) - step)
                gone = any(mask & bit[c] for c in p[:-1])
                out.append((mask, step, a, b, "redundant" if gone else "removed"))
                if mask == bit[p[-1]]:
                    out.append((mask, step, a, b, "unique_fails"))
    return out


def audit(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Totals of every order and step per part.

    ``counts`` has part, mask (bit i: fails ``letters[i]``) and the long columns
    n, good, toxic, summed over documents.  At most 2 ** len(letters) rows of it
    meet the fixed table of intervals, whatever the documents' number is.
    """
    spark = counts.sparkSession
    orders = [("".join(p), r) for r, p in enumerate(permutations(sorted(letters)))]
    steps = len(letters)
    counts = counts.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    fixed = spark.createDataFrame(intervals(letters), "mask int, step int, a int, b int, what string")
    hit = counts.join(F.broadcast(fixed), "mask")       # a few thousand fixed rows
    amount = {c: F.when(F.col("what") == c, F.col("n")).otherwise(F.lit(0)) for c in SUMS[:3]}
    amount["good_lost"] = F.when(F.col("what") == "removed", F.col("good")).otherwise(F.lit(0))
    amount["toxic_lost"] = F.when(F.col("what") == "removed", F.col("toxic")).otherwise(F.lit(0))
    hit = hit.select("part", "step", F.explode(F.array(F.struct(F.col("a").alias("rank"), F.lit(1).alias("sign")),
                                                       F.struct(F.col("b").alias("rank"), F.lit(-1).alias("sign")))).alias("end"),
                     *[v.alias(c) for c, v in amount.items()])
    ends = hit.groupBy("part", "step", F.col("end.rank").alias("rank")).agg(
        *[F.sum(F.col(c) * F.col("end.sign")).alias(c) for c in SUMS])
    total = counts.groupBy("part").agg(F.sum("n").alias("total"))
    grid = (total.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps))))
            .withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(len(orders) - 1)))))
    run = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row = grid.join(ends, ["part", "step", "rank"], "left").select(
        "part", "step", "rank", "total", *[F.sum(F.coalesce(F.col(c), F.lit(0))).over(run).alias(c) for c in SUMS])
    name = spark.createDataFrame(orders, "filter_order string, rank int")
    row = row.join(F.broadcast(name), "rank").withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1)))
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row = row.withColumn("kept", F.col("total") - F.sum("removed").over(so_far))
    row = row.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter")))
    return row.select("part", "filter_order", "step", *[F.col(c).cast("long").alias(c) for c in
                                                        ("kept", *SUMS, "shapley")])


# -- the five filters -------------------------------------------------------------
def own_failures(text: Column) -> dict[str, Column]:
    """Failures that follow from a (non-null) text alone."""
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    capitals = F.length(F.regexp_replace(text, r"[^A-Z]+", ""))
    return {"A": F.size(words) < MIN_WORDS,
            "B": 100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words),
            "C": 100 * capitals > CAPITAL_PERCENT * F.length(text),
            "D": text.rlike(r"[#$%&*|]")}


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic) of ``docs`` (doc_id, text, lang).

    Texts are read once; what is shuffled are rows of a few numbers.  Equal texts
    are told by two 64-bit hashes and their length.  Only texts that come more
    than once are joined back, one row each; a text or id that holds very many
    rows is split by the skew join, and everything else is summed before it is
    shuffled."""
    text = F.coalesce("text", F.lit(""))
    fails = own_failures(F.col("t"))
    mask = sum((F.when(f, F.lit(1 << LETTERS.index(c))).otherwise(F.lit(0)) for c, f in fails.items()), F.lit(0))
    same = F.struct(F.xxhash64("t").alias("x"), F.xxhash64(F.lit("second"), "t").alias("y"), F.length("t").alias("z"))
    base = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("t"))
    base = cut_lineage(base.select("doc_id", "part", mask.cast("int").alias("mask"), same.alias("same")))
    first = (base.groupBy("same").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
             .filter("last > first").select("same", "first"))
    first = cut_lineage(first)
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic")).filter("good + toxic > 0")
    marks = cut_lineage(marks)
    row = base.join(first, "same", "left")
    copy = F.when(F.col("doc_id") > F.col("first"), F.lit(1 << LETTERS.index("E"))).otherwise(F.lit(0))
    row = row.select("doc_id", "part", (F.col("mask") + copy).alias("mask")).join(marks, "doc_id", "left")
    return row.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                                           F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return audit(cut_lineage(failure_counts(docs, labels)))


# Every order is run over the documents' masks, one by one.
SQL = r"""
with words as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
marks as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels where doc_id is not null group by doc_id),
failing as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic, list_concat(
    list_concat(case when len(w) < 200 then ['A'] else [] end,
                case when 100 * len(list_distinct(w)) < 50 * len(w) then ['B'] else [] end),
    list_concat(case when 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * len(t) then ['C'] else [] end,
    list_concat(case when regexp_matches(t, '[#$%&*|]') then ['D'] else [] end,
                case when words.doc_id > min(words.doc_id) over (partition by t) then ['E'] else [] end))) as f
  from words left join marks using (doc_id)),
masks as (select part, f, count(*) as n, sum(good) as good, sum(toxic) as toxic from failing group by part, f),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as c),
orders as (
  select a.c || b.c || c.c || d.c || e.c as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
steps as (select filter_order, step, substr(filter_order, step, 1) as letter, string_split(substr(filter_order, 1, step - 1), '') as earlier,
    string_split(substr(filter_order, 1, step), '') as upto
  from orders, (select unnest([1, 2, 3, 4, 5])::int as step)),
sums as (
  select part, filter_order, step, letter,
    coalesce(sum(n) filter (not list_has_any(f, upto)), 0) as kept,
    coalesce(sum(n) filter (list_contains(f, letter) and not list_has_any(f, earlier)), 0) as removed,
    coalesce(sum(n) filter (list_contains(f, letter) and list_has_any(f, earlier)), 0) as redundant,
    coalesce(sum(n) filter (f = [letter]), 0) as unique_fails,
    coalesce(sum(good) filter (list_contains(f, letter) and not list_has_any(f, earlier)), 0) as good_lost,
    coalesce(sum(toxic) filter (list_contains(f, letter) and not list_has_any(f, earlier)), 0) as toxic_lost
  from masks, steps group by part, filter_order, step, letter)
select part, filter_order, step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, letter))::bigint as shapley
from sums
"""
