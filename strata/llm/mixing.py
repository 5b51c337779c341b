"""Mixing sources to target weights.

Every document gets a hash-random key; inside its source the keys are dealt
into ranges, the ranges' word counts are summed by a two-level prefix sum and
each range is then ordered by key.  A source's budget is cut exactly at the
word where the running sum reaches it; full epochs come first.

Defined cases: null text counts 0 words; a null source is a source of its own
(last in order); null or repeated ids are rows like any other (rows with equal
key, id and size take equal places in either order, so reruns agree); an empty
table gives an empty result; extra input columns never enter the sums.
"""
from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, DataFrame, SparkSession, cut_lineage, table

WEIGHTS = (3, 1, 2)     # repeated over the sources in code-point order
SHARE = 1.5             # words of the mix per word of input
MAX_EPOCHS = 2          # no source gives more than this times its size
ROWS_PER_RANGE = 1024   # rows aimed at in one key range


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, size: Column, seed: str) -> Column:
    """60-bit key, equal in every run."""
    salt = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), size.cast("string"))
    return F.conv(F.substring(F.md5(salt), 1, 15), 16, 10).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, sid, source_size, n_rows, target.

    Resharing the excess by weight until no target exceeds its bound ends at
    ``least(bound, level * weight)``; the level follows from the sources sorted
    by bound / weight.  The table has one row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    per = per.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    pick = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("w", F.element_at(pick, ((F.col("sid") - 1) % len(weights) + 1).cast("int")))
    order = Window.orderBy(F.col("bound") / F.col("w"), "sid")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("bound", F.lit(float(epochs)) * F.col("source_size"))
    per = (per.withColumn("rn", F.row_number().over(order))
           .withColumn("level", (F.lit(share) * F.sum("source_size").over(every)
                                 - F.coalesce(F.sum("bound").over(before), F.lit(0.0)))
                       / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))))
    reached = F.when(F.col("bound") / F.col("w") >= F.col("level"), F.col("rn"))
    per = per.withColumn("first", F.min(reached).over(every))
    per = per.withColumn("level", F.max(F.when(F.col("rn") == F.col("first"), F.col("level"))).over(every))
    target = F.least(F.col("bound"), F.coalesce(F.col("level") * F.col("w"), F.col("bound")))
    return per.select("source", "sid", "source_size", "n_rows", target.alias("target"))


def mix(docs: DataFrame, seed: str = "mix", weights=WEIGHTS, share: float = SHARE,
        epochs: int = MAX_EPOCHS) -> DataFrame:
    """Words taken of each row: doc_id, source, size, key, source_size, target, taken.

    ``docs`` needs doc_id, source and size.
    """
    base = cut_lineage(docs.select("doc_id", "source", F.col("size").cast("long").alias("size"))
                       .withColumn("key", random_key(F.col("doc_id"), F.col("size"), seed)))
    per = cut_lineage(source_targets(base, weights, share, epochs))
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n_rows") / F.lit(float(ROWS_PER_RANGE))))).cast("int")
    per = per.withColumn("bits", bits).withColumnRenamed("source", "s_source")
    row = (base.join(per, F.col("source").eqNullSafe(F.col("s_source"))).drop("s_source", "n_rows")
           .withColumn("bucket", F.expr("shiftright(key, 60 - bits)")))
    ranges = (row.groupBy("sid", "bucket", F.expr("shiftright(bucket, bits div 2)").alias("block"))
              .agg(F.sum("size").alias("words")))
    ranges = cut_lineage(ranges)
    earlier = lambda *part: (Window.partitionBy(*part[:-1]).orderBy(part[-1])
                             .rowsBetween(Window.unboundedPreceding, -1))
    blocks = ranges.groupBy("sid", "block").agg(F.sum("words").alias("words"))
    blocks = blocks.select("sid", "block", F.coalesce(F.sum("words").over(earlier("sid", "block")), F.lit(0)).alias("b0"))
    ranges = ranges.withColumn("r0", F.coalesce(F.sum("words").over(earlier("sid", "block", "bucket")), F.lit(0)))
    start = (ranges.join(blocks, ["sid", "block"])
             .select("sid", "bucket", (F.col("b0") + F.col("r0")).alias("start")))
    inside = (Window.partitionBy("sid", "bucket").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    row = row.join(start, ["sid", "bucket"])
    place = F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    budget = F.floor("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(F.lit(0))
    row = row.withColumn("place", place).withColumn("whole", whole)
    rest = budget - F.col("whole") * F.col("source_size") - F.col("place")
    taken = F.col("whole") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return row.select("doc_id", "source", "size", "key", "source_size", "target", taken.cast("long").alias("taken"))


def cuts(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """Where each source's last, partial epoch ends: s_source, whole (full
    epochs), at (key, id and size of the row it ends in), words (that each of
    the rows equal to ``at`` still gives).  One row per source."""
    row = mix(docs, seed)
    whole = F.expr("floor(target) div source_size")
    row = (row.filter("source_size > 0").withColumn("whole", whole)
           .withColumn("at", F.struct("key", "doc_id", "size")))
    part = F.col("taken") - F.col("whole") * F.col("size")
    # the rows of the last epoch give all, then one gives a part, then none; equal rows share
    same = row.groupBy("source", "whole", "at").agg(F.sum(part).alias("words"), F.count(F.lit(1)).alias("m"), F.max("size").alias("size"))
    open_ = same.filter(F.col("words") < F.col("m") * F.col("size"))
    return (open_.groupBy(F.col("source").alias("s_source"), "whole")
            .agg(F.min_by(F.struct("at", F.expr("words div m").alias("words")), "at").alias("cut"))
            .select("s_source", "whole", F.col("cut.at").alias("at"), F.col("cut.words").alias("words")))


def mixed_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The mix itself: a row per epoch of each document, with the columns of
    ``docs``.  The document that a source's budget ends in is cut after the word
    where it ends.

    Which rows are taken follows from each row's own key and its source's cut,
    so the texts are never shuffled."""
    doc = docs.select(F.struct(*docs.columns).alias("doc"), word_count(F.col("text")).alias("size"))    # no name can clash
    cut = cut_lineage(cuts(doc.select("doc.doc_id", "doc.source", "size"), seed))
    row = doc.join(cut, F.col("doc.source").eqNullSafe(F.col("s_source")))
    here = F.struct(random_key(F.col("doc.doc_id"), F.col("size"), seed).alias("key"), F.col("doc.doc_id"), F.col("size"))
    last = F.when(here < F.col("at"), F.col("size")).when(here == F.col("at"), F.col("words")).otherwise(F.lit(0))
    row = row.withColumn("taken", F.col("whole") * F.col("size") + last).filter("taken > 0")
    row = row.withColumn("epoch", F.explode(F.expr("sequence(1, cast(ceil(taken / size) as int))")))
    row = row.withColumn("left", F.col("taken") - (F.col("epoch") - 1) * F.col("size"))
    full = F.col("left") >= F.col("size")
    text = F.when(full, F.col("doc.text")).otherwise(first_words(F.col("doc.text"), F.col("left")))
    row = row.select("doc", full.alias("full"), text.alias("text"))
    chars = F.when(F.col("full"), F.col("doc.n_chars")).otherwise(F.length("text").cast("bigint")) if "n_chars" in docs.columns else None
    made = {"text": F.col("text"), "n_chars": chars}
    return row.select(*[made.get(c, F.col(f"doc.{c}")).alias(c) for c in docs.columns])


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word (fewer than it has)."""
    parts = F.regexp_extract_all(text, F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    return F.array_join(F.slice(parts, F.lit(1), n.cast("int")), "")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mix(sized).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents),
keyed as (
  select *, ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, '') || ':' || size::varchar), 1, 15))::bigint as key
  from sized),
per as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as sid
  from sized group by source),
weighted as (
  select *, ([3.0, 1.0, 2.0]::double[])[((sid - 1) % 3 + 1)::int] as w, 2.0::double * source_size as bound from per),
ordered as (
  select *, row_number() over o as rn,
    (1.5::double * (sum(source_size) over ())
      - coalesce(sum(bound) over (o rows between unbounded preceding and 1 preceding), 0))
    / (sum(w) over () - coalesce(sum(w) over (o rows between unbounded preceding and 1 preceding), 0)) as level
  from weighted window o as (order by bound / w, sid)),
levelled as (
  select *, (select level from ordered where bound / w >= level order by rn limit 1) as final from ordered),
targets as (
  select source, source_size, least(bound, coalesce(final * w, bound)) as target from levelled),
placed as (
  select k.*, t.source_size, t.target,
    coalesce(sum(size) over (partition by k.source order by key, doc_id, size
      rows between unbounded preceding and 1 preceding), 0)::bigint as place,
    case when t.source_size > 0 then floor(t.target)::bigint // t.source_size else 0 end as whole
  from keyed k join targets t on k.source is not distinct from t.source)
select doc_id, size, source_size, target,
  (whole * size + greatest(0, least(size, floor(target)::bigint - whole * source_size - place)))::bigint as taken
from placed
"""
