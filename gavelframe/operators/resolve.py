"""Resolution of law names, codes and courts: joins on equality only.

Containment ("the query holds a name", "a name holds the query") and longest-suffix matches are
equi-joins on enumerated substrings, so that no pair of rows that doesn't match is ever formed. These joins are merge joins by hint: the
planner takes enumerated rows to be as few as the rows they come from, and would broadcast them through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import ABOLISHED, ALIASES, BUILTIN_LAWS, CASE_TYPES, COURT_LEVELS, COURTS, CURRENT, DEFAULT_LEVEL, INVALID_NAMES, NAME_PREFIXES, SHORT_NAMES
from ..functions.identifiers import title_name

#: Tasks to which the names that hold one term are dealt.
SALTS = 8


def pairs(spark: SparkSession, rows: dict[str, str], first: str, second: str) -> DataFrame:
    return spark.createDataFrame(list(rows.items()), f"{first} string, {second} string")


def aliases(spark: SparkSession) -> DataFrame:
    return pairs(spark, ALIASES, "alias", "law_name")


def builtin_laws(spark: SparkSession) -> DataFrame:
    return pairs(spark, BUILTIN_LAWS, "law_name", "pcode")


def courts(spark: SparkSession) -> DataFrame:
    """court, code, level."""
    rows = [(name, code, COURT_LEVELS.get(code, DEFAULT_LEVEL)) for name, code in COURTS.items()]
    return spark.createDataFrame(rows, "court string, code string, level int")


def substrings(text: Column, longest: Column) -> Column:
    """The distinct substrings of up to longest characters; the empty one is not among them."""
    n = F.length(text)
    every = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(F.lit(1), F.least(n - i + 1, longest)), lambda k: F.substring(text, i, k))))
    return F.when(n > 0, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def substrings_of(text: Column, lengths: Column) -> Column:
    """The distinct substrings of the given lengths."""
    n = F.length(text)
    fits = F.filter(lengths, lambda k: k.between(1, n))
    return F.array_distinct(F.flatten(F.transform(fits, lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substring(text, i, k)))))


def resolve_name(term: str, laws: DataFrame) -> DataFrame:
    """As resolve_names() for one term: comparisons with a literal, in one pass over the dictionary."""
    spark, full, fixed = laws.sparkSession, ALIASES.get(term), BUILTIN_LAWS.get(term)
    name, size = F.col("law_name"), F.length("law_name")
    tier = F.when(name == term, 0).when(name == F.lit(full), 1).when(F.lit(term).contains(name) & (size > 0), 3).when(name.contains(term), 4)
    order = F.when(F.col("tier") == 3, -size).when(F.col("tier") == 4, size).otherwise(0)
    found = laws.select("ordinal", "law_name", "pcode", tier.alias("tier")).where("tier IS NOT NULL").withColumn("size", order)
    if fixed:
        found = found.unionByName(spark.createDataFrame([(0, term, fixed, 2, 0)], "ordinal bigint, law_name string, pcode string, tier int, size int"))
    best = found.agg(F.min(F.struct("tier", "size", "ordinal", "law_name", "pcode")).alias("b"))
    return best.select(F.lit(term).alias("term"), F.col("b.tier").alias("tier"), F.col("b.law_name").alias("law_name"), F.col("b.pcode").alias("pcode"))


def prefixes(text: Column, longest: int) -> Column:
    n = F.least(F.length(text), F.lit(longest))
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda k: F.substring(text, F.lit(1), k))).otherwise(F.array().cast("array<string>"))


def suffixes(text: Column) -> Column:
    n = F.length(text)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda k: F.substring(text, n - k + 1, k))).otherwise(F.array().cast("array<string>"))


def resolve_names(terms: DataFrame, laws: DataFrame, alias: DataFrame | None = None, builtin: DataFrame | None = None) -> DataFrame:
    """term, tier, law_name, pcode of every non-empty term; a null law_name where nothing matches.

    Tiers: 0 equal, 1 by alias, 2 built in, 3 the term holds a name (the longest), 4 a name holds the term (the
    shortest); ties go to the smaller ordinal. terms: term; laws: ordinal, law_name, pcode (one row per law_name).
    """
    spark = terms.sparkSession
    alias = aliases(spark) if alias is None else alias
    builtin = builtin_laws(spark) if builtin is None else builtin
    terms = terms.where(F.length("term") > 0).select("term").distinct()
    laws = laws.select("ordinal", "law_name", "pcode")
    shuffled = laws.hint("merge")
    hit = lambda df, tier, size: df.select("term", F.lit(tier).alias("tier"), size.alias("size"), "ordinal", "law_name", "pcode")
    none = F.lit(0)
    size = F.length("law_name")
    exact = hit(shuffled.join(terms, F.col("term") == F.col("law_name")), 0, none)
    by_alias = hit(alias.select(F.col("alias").alias("term"), "law_name").hint("merge").join(terms, "term").join(shuffled, "law_name"), 1, none)
    fixed = hit(terms.join(builtin.select("law_name", "pcode"), F.col("term") == F.col("law_name")).withColumn("ordinal", F.lit(0).cast("bigint")), 2, none)
    # no name is longer than the longest, which the plan itself looks up
    bounded = terms.withColumn("longest", laws.agg(F.coalesce(F.max(F.length("law_name")), F.lit(1))).scalar())
    parts = bounded.select("term", F.explode(substrings(F.col("term"), F.col("longest"))).alias("law_name"))
    holds = hit(parts.hint("merge").join(laws, "law_name"), 3, -size)
    # of a name only substrings as long as some term; names that hold a common term are dealt to salts, for each of which the terms are repeated
    lengths = terms.agg(F.collect_set(F.length("term"))).scalar()
    salt = F.pmod(F.xxhash64("ordinal", "law_name"), F.lit(SALTS)).cast("int").alias("salt")
    measured = laws.withColumns({"salt": salt, "lengths": lengths})
    of_names = measured.select("ordinal", "law_name", "pcode", "salt", F.explode(substrings_of(F.col("law_name"), F.col("lengths"))).alias("term"))
    asked = terms.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    held = hit(of_names.hint("merge").join(asked, ["term", "salt"]), 4, size)
    found = exact.unionByName(by_alias).unionByName(fixed).unionByName(holds).unionByName(held)
    best = found.groupBy("term").agg(F.min(F.struct("tier", "size", "ordinal", "law_name", "pcode")).alias("b"))
    return terms.join(best, "term", "left").select("term", F.col("b.tier").alias("tier"), F.col("b.law_name").alias("law_name"), F.col("b.pcode").alias("pcode"))


def names_of_codes(codes: DataFrame, laws: DataFrame, builtin: DataFrame | None = None) -> DataFrame:
    """pcode, law_name of codes (pcode, parsed_name): the dictionary's last name, else the built-in one, else the parsed one if it is a name."""
    spark = codes.sparkSession
    builtin = builtin_laws(spark) if builtin is None else builtin
    last = laws.groupBy("pcode").agg(F.max_by("law_name", "ordinal").alias("_own"))
    fixed = builtin.groupBy("pcode").agg(F.min("law_name").alias("_fixed"))
    parsed = F.when(~F.col("parsed_name").isin(INVALID_NAMES), F.col("parsed_name"))
    joined = codes.join(last, "pcode", "left").join(fixed, "pcode", "left")
    return joined.select("pcode", F.coalesce("_own", "_fixed", parsed, F.lit("")).alias("law_name"))


def with_status(laws: DataFrame, abolished: DataFrame) -> DataFrame:
    """laws with status: abolished if pcode is among abolished (pcode), else current; unknown codes are current."""
    gone = abolished.select("pcode").distinct().withColumn("_gone", F.lit(True))
    return laws.join(gone, "pcode", "left").withColumn("status", F.when(F.col("_gone"), ABOLISHED).otherwise(CURRENT)).drop("_gone")


def without_abolished(laws: DataFrame, abolished: DataFrame) -> DataFrame:
    return laws.join(abolished, "pcode", "left_anti")


def with_history(articles: DataFrame, histories: DataFrame) -> DataFrame:
    return articles.join(histories.select("pcode", "history"), "pcode", "left")


def abolished_codes(laws: DataFrame) -> DataFrame:
    """pcode: the distinct codes of abolished items, sorted."""
    return laws.where("abolished").select("pcode").distinct().orderBy("pcode")


def court_named(asked: str) -> Column:
    """Rows (court, jid) of a court, by its name or its code; an unknown code holds for identifiers that start with it and a letter for the type."""
    code = COURTS.get(asked, asked)
    name = next((n for n, c in COURTS.items() if c == code), None)
    head = F.split_part("jid", F.lit(","), F.lit(1))
    return F.col("court") == name if name else F.coalesce(F.substring(head, 1, len(code)) == code, F.lit(False)) & (F.length(head) == len(code) + 1)


def suggestions(laws: DataFrame, term: str, limit: int = 10) -> DataFrame:
    """The first names, in dictionary order, that hold the term."""
    return laws.where(F.col("law_name").contains(term)).orderBy("ordinal").limit(limit).select("ordinal", "law_name", "pcode")


def with_court(rows: DataFrame, table: DataFrame | None = None, jid: str = "jid") -> DataFrame:
    """rows with court, court_level and case_type by the longest court code that the identifier starts with.

    The built-in courts are looked up within each row. A table of courts is joined to the distinct heads of identifiers; these are few and the rows many, so that
    the heads are broadcast: a shuffle by head would bring all rows of a court, with their texts, to one task.
    """
    code = F.split_part(F.coalesce(F.col(jid), F.lit("")), F.lit(","), F.lit(1))
    longest = 6
    if table is None:
        at = {c: F.struct(F.lit(c).alias("code"), F.lit(name).alias("court"), F.lit(COURT_LEVELS.get(c, DEFAULT_LEVEL)).alias("level")) for name, c in COURTS.items()}
        known = F.create_map(*[x for c, court in at.items() for x in (F.lit(c), court)])
        found = F.coalesce(*[F.try_element_at(known, F.substring(code, 1, k)) for k in range(longest, 0, -1)])
        joined = rows.withColumn("_head", code).withColumn("_court", found)
    else:
        heads = rows.select(code.alias("_head")).distinct()
        hits = heads.select("_head", F.explode(prefixes(F.col("_head"), longest)).alias("code")).join(table, "code")
        best = hits.groupBy("_head").agg(F.max_by(F.struct("code", "court", "level"), F.length("code")).alias("_court"))
        joined = rows.withColumn("_head", code).join(F.broadcast(best), "_head", "left")
    rest = F.substring(F.col("_head"), F.length("_court.code") + 1, F.lit(longest))
    kind = F.lit(None).cast("string")
    for name, letter in CASE_TYPES.items():
        kind = F.when(rest == letter, name).otherwise(kind)
    found = {"court": F.coalesce("_court.court", F.lit("")), "court_level": F.coalesce(F.col("_court.level").cast("int"), F.lit(0)), "case_type": F.coalesce(kind, F.lit(""))}
    return joined.withColumns(found).drop("_head", "_court")


def without_prefix(name: Column, prefixes_: list[str] = NAME_PREFIXES) -> Column:
    """Without the first listed prefix that leaves two characters at least."""
    out = name
    for prefix in reversed(prefixes_):
        fits = name.startswith(prefix) & (F.length(name) > len(prefix) + 1)
        out = F.when(fits, F.substring(name, len(prefix) + 1, 1 << 20)).otherwise(out)
    return out


def known_names(laws: DataFrame) -> DataFrame:
    """The dictionary's names and the common short ones."""
    short = laws.sparkSession.createDataFrame([(n,) for n in SHORT_NAMES], "law_name string")
    return laws.select("law_name").union(short).distinct()


def clean_statute_names(raw: DataFrame, known: DataFrame) -> DataFrame:
    """raw, law_name for names (raw) as texts have them: known as it is, or without a prefix, or by its longest known suffix."""
    raw = raw.select("raw").distinct().withColumn("name", without_prefix(F.col("raw")))
    yes = known.select(F.col("law_name").alias("_known")).distinct()
    ends = raw.select("raw", "name", F.explode(suffixes(F.col("name"))).alias("_known")).where((F.length("_known") >= 2) | (F.col("_known") == F.col("name")))
    best = ends.hint("merge").join(yes, "_known").groupBy("raw").agg(F.max_by("_known", F.length("_known")).alias("_suffix"))
    whole = raw.select("raw").join(yes.withColumnRenamed("_known", "raw"), "raw").withColumn("_whole", F.lit(True))
    joined = raw.join(whole, "raw", "left").join(best, "raw", "left")
    return joined.select("raw", F.when(F.col("_whole"), F.col("raw")).otherwise(F.coalesce("_suffix", "name")).alias("law_name"))


def page_law_name(title: Column) -> Column:
    """The law's name in a page title; empty for titles of other pages."""
    name = title_name(title)
    return F.when(name.isin(INVALID_NAMES), "").otherwise(name)
