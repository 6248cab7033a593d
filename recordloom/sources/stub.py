"""A small world of made-up records with known matches, for trying a run without data of one's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TRADES, GOODS, FORMS = ("north", "harbour", "copper", "maple", "silver", "garden", "summit", "river"), ("tools", "bakery", "textiles", "books", "optics", "coffee", "lamps", "paper"), ("inc", "llc", "corp", "company")
STREETS, COUNTRIES = ("oak street", "mill road", "station avenue", "lake drive", "church lane"), ("US", "India", "France")


def _drawn(name: str, seed: int) -> Column:
    """A whole number for each entity that depends on its number, the name and the seed alone."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(name), "n"), F.lit(1 << 30))


def _one_of(values: tuple[str, ...], name: str, seed: int) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (_drawn(name, seed) % len(values) + 1).cast("int"))


def world(spark: SparkSession, n: int, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Raw records (entity_id, source, country, name_raw, addr_raw) of n entities, and the true pairs (s1_id, match_id).

    Every entity is one record of source 1; a twelfth has no other. The rest have one to five in sources 2 and 3, in capitals,
    without legal form, with zeros before the number or without a number; two in five have a decoy beside them, with another
    number or one more word.
    """
    house = _drawn("house", seed) % 9000 + 1
    core = F.concat_ws(" ", _one_of(TRADES, "a", seed), _one_of(TRADES, "b", seed), _one_of(GOODS, "c", seed), F.concat(F.lit("n"), "n"))
    base = spark.range(n).withColumnRenamed("id", "n").select("n", _one_of(COUNTRIES, "country", seed).alias("country"), core.alias("core"), _one_of(FORMS, "form", seed).alias("form"), house.alias("house"), _one_of(STREETS, "street", seed).alias("street"), F.when(F.col("n") % 12 == 0, 0).otherwise(_drawn("matches", seed) % 5 + 1).cast("int").alias("matches"), (_drawn("decoy", seed) % 5 < 2).cast("int").alias("decoys"))
    kinds = F.concat(F.array(F.lit("owner")), F.array_repeat(F.lit("match"), F.col("matches")), F.array_repeat(F.lit("decoy"), F.col("decoys")))
    rows = base.select("*", F.posexplode(kinds).alias("i", "kind"))
    source = F.when(F.col("kind") == "owner", 1).otherwise(2 + (F.col("n") + F.col("i")) % 2).cast("int")
    style = (F.col("n") + F.col("i")) % 4
    name = F.when(F.col("kind") == "owner", F.concat_ws(" ", "core", "form")).when(F.col("kind") == "decoy", F.concat_ws(" ", "core", F.when(F.col("n") % 2 == 0, F.lit("overseas")))).when(style == 0, F.upper("core")).otherwise(F.col("core"))
    number = F.when((F.col("kind") == "decoy") & (F.col("n") % 2 == 1), (F.col("house") + 7).cast("string")).when((F.col("kind") == "match") & (style == 1), F.lpad(F.col("house").cast("string"), 6, "0")).when((F.col("kind") == "match") & (style == 2), F.lit("")).otherwise(F.col("house").cast("string"))
    rows = rows.select(F.concat(F.lit("S"), source, F.lit("-"), F.col("n") * 10 + F.col("i")).alias("entity_id"), source.alias("source"), "country", name.alias("name_raw"), F.btrim(F.concat_ws(" ", number, "street")).alias("addr_raw"), "kind", "n")
    pairs = rows.filter("kind = 'match'").select(F.concat(F.lit("S1-"), F.col("n") * 10).alias("s1_id"), F.col("entity_id").alias("match_id"))
    return rows.drop("kind", "n"), pairs
