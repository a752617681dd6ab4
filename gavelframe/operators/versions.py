"""Versions of the law dictionary: what changed between two of them, and since when and until when each entry held.

An entry is a name with its code, state and history (law_name, pcode, abolished, history). A timeline has entry rows with valid_from (the date of the first version
with exactly these values) and valid_to (the date of the first version without them; null while they hold). Names are unique within a version; of
repeated ones the last by ordinal counts, as in the dictionary itself.

Defined cases: nulls are values like others (null-safe comparison), a null name is no entry; a version that equals the one before changes nothing; a name that comes back gets a
new interval; an empty version closes all intervals.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ENTRY = ["pcode", "abolished", "history"]
ADDED, GONE, RENAMED, RECODED, ABOLISHED, RESTORED, AMENDED = "added", "gone", "renamed", "recoded", "abolished", "restored", "amended"


def entries(version: DataFrame) -> DataFrame:
    """law_name and its values, one row for a name: the last by ordinal where there is one."""
    rows = version.where("law_name IS NOT NULL")
    if "ordinal" not in rows.columns:
        return rows.select("law_name", *ENTRY).distinct()
    last = rows.groupBy("law_name").agg(F.max(F.struct("ordinal", *ENTRY)).alias("_last"))
    return last.select("law_name", *(F.col(f"_last.{c}").alias(c) for c in ENTRY))


def _equal(a: str, b: str) -> Column:
    return reduce(and_, (F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in ENTRY))


def changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """change, law_name, old_name, pcode, old_pcode: one row for each entry that differs; entries that stay as they are have none.

    A name that is gone and one that is added with the same code are a rename if each is the only one of its code; of several reasons the
    first of recoded, abolished, restored and amended (another history) is given.
    """
    o, n = entries(old).withColumn("there", F.lit(True)).alias("o"), entries(new).withColumn("there", F.lit(True)).alias("n")
    both = o.join(n, F.col("o.law_name") == F.col("n.law_name"), "full_outer")
    gone = F.col("n.there").isNull()
    added = F.col("o.there").isNull()
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    reason = (
        F.when(added, ADDED).when(gone, GONE).when(~F.col("o.pcode").eqNullSafe(F.col("n.pcode")), RECODED).when(flag("n.abolished") & ~flag("o.abolished"), ABOLISHED)
        .when(flag("o.abolished") & ~flag("n.abolished"), RESTORED).when(~F.col("o.history").eqNullSafe(F.col("n.history")), AMENDED)
    )
    found = both.where(added | gone | ~_equal("o", "n")).select(reason.alias("change"), F.col("o.law_name").alias("old_name"), F.col("n.law_name").alias("law_name"), F.col("o.pcode").alias("old_pcode"), F.col("n.pcode").alias("pcode"))
    found = found.where("change IS NOT NULL")
    moved = found.where(F.col("change").isin(ADDED, GONE)).withColumn("code", F.coalesce("pcode", "old_pcode")).where("code IS NOT NULL")
    one = lambda kind: F.count_if(F.col("change") == kind) == 1
    renames = moved.groupBy("code").agg(one(ADDED).alias("a"), one(GONE).alias("g"), F.max("old_name").alias("old_name"), F.max("law_name").alias("law_name")).where("a AND g")
    rest = found.withColumn("code", F.when(F.col("change").isin(ADDED, GONE), F.coalesce("pcode", "old_pcode"))).join(renames.select("code"), "code", "left_anti").drop("code")
    renamed = renames.select(F.lit(RENAMED).alias("change"), "old_name", "law_name", F.col("code").alias("old_pcode"), F.col("code").alias("pcode"))
    return rest.unionByName(renamed).select("change", "law_name", "old_name", "pcode", "old_pcode")


def first_timeline(version: DataFrame, at: Column) -> DataFrame:
    return entries(version).select("law_name", *ENTRY, at.alias("valid_from"), F.lit(None).cast(_type_of(version, at)).alias("valid_to"))


def _type_of(rows: DataFrame, at: Column) -> str:
    return rows.select(at.alias("at")).schema["at"].dataType.simpleString()


def with_version(timeline: DataFrame, version: DataFrame, at: Column) -> DataFrame:
    """The timeline after one more version of date at (later than all before): a full outer join of the open intervals with the version."""
    closed, opened = timeline.where("valid_to IS NOT NULL"), timeline.where("valid_to IS NULL").withColumn("there", F.lit(True)).alias("o")
    new = entries(version).withColumn("there", F.lit(True)).alias("n")
    both = opened.join(new, F.col("o.law_name") == F.col("n.law_name"), "full_outer")
    stays = F.col("o.there") & F.col("n.there") & _equal("o", "n")
    side = lambda s, since, until: F.struct(F.col(f"{s}.law_name").alias("law_name"), *(F.col(f"{s}.{c}").alias(c) for c in ENTRY), since.alias("valid_from"), until.alias("valid_to"))
    none = F.lit(None).cast(timeline.schema["valid_to"].dataType)
    before = side("o", F.col("o.valid_from"), F.when(F.coalesce(stays, F.lit(False)), none).otherwise(at))
    after = side("n", at, none)
    rows = F.array(F.when(F.col("o.there"), before), F.when(F.col("n.there") & ~F.coalesce(stays, F.lit(False)), after))
    return closed.unionByName(both.select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r")).select("r.*"))


def timeline_of(versions: DataFrame, at: str = "version_date") -> DataFrame:
    """The timeline of all versions at once (rows of entries with the date of their version): runs of equal values in versions that follow each other.

    The dates are a table of their own, so that a name's absence from a version ends its interval. A name has a row for each version it is in.
    """
    dates = versions.select(at).distinct()
    numbered = dates.withColumn("_v", F.row_number().over(Window.orderBy(at)))  # one row for each version
    after = numbered.select((F.col("_v") - 1).alias("_v"), F.col(at).alias("_next"))
    rows = versions.where("law_name IS NOT NULL")
    if "ordinal" in rows.columns:
        last = rows.groupBy(at, "law_name").agg(F.max(F.struct("ordinal", *ENTRY)).alias("_last"))
        rows = last.select(at, "law_name", *(F.col(f"_last.{c}").alias(c) for c in ENTRY))
    rows = rows.select(at, "law_name", *ENTRY).distinct().join(numbered, at)
    by_name = Window.partitionBy("law_name").orderBy("_v")
    value = F.struct(*ENTRY)
    starts = ~F.coalesce(F.lag("_v").over(by_name) == F.col("_v") - 1, F.lit(False)) | ~F.lag(value).over(by_name).eqNullSafe(value)
    runs = rows.withColumn("_starts", starts).withColumn("_run", F.sum(F.col("_starts").cast("int")).over(by_name))
    spans = runs.groupBy("law_name", "_run").agg(*(F.first(c).alias(c) for c in ENTRY), F.min(at).alias("valid_from"), F.max("_v").alias("_v"))
    return spans.join(after, "_v", "left").select("law_name", *ENTRY, "valid_from", F.col("_next").alias("valid_to"))


def as_of(timeline: DataFrame, at: Column) -> DataFrame:
    """The dictionary at a time."""
    return timeline.where((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at))).select("law_name", *ENTRY)


def with_law_as_of(rows: DataFrame, timeline: DataFrame, at: str) -> DataFrame:
    """rows (law_name, at) with the code, state and history that the name had at that time; nulls where it had none."""
    t = timeline.alias("t")
    held = (F.col("r.law_name") == F.col("t.law_name")) & (F.col("t.valid_from") <= F.col(f"r.{at}")) & (F.col("t.valid_to").isNull() | (F.col("t.valid_to") > F.col(f"r.{at}")))
    return rows.alias("r").join(t, held, "left").select("r.*", *(F.col(f"t.{c}").alias(c) for c in ENTRY))
