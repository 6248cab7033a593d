"""Records from raw names and addresses: scripts, tokens, legal forms, house numbers, streets without area words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions import rules, text
from recordloom.sources.artifacts import saved

AREA_SHARE = 0.15
#: A house-number word before a number; a number with "bis"/"ter" or one letter behind it.
MARKER = r"\b(?:h no|hno|no|n|door no|d no|plot no|shop no|plot|door|flat|shop|bldg|building)\s*(\d[\d/\-]*(?:\s*(?:bis|ter)\b|[a-zA-Z]?))\b"
LEADING = r"^(\d[\d/\-]*(?:\s*(?:bis|ter)\b|[a-zA-Z]?))\b"
ANY_NUMBER = r"\d[\d/\-]*(?:\s*(?:bis|ter)\b|[a-zA-Z]?)?"


def by_country(country: Column, of) -> Column:
    """of(country label) as a column: one branch for each country with tables, and the generic one."""
    out = of("generic")
    for c in reversed(rules.COUNTRIES):
        out = F.when(country == c, of(c)).otherwise(out)
    return out


def expand(tokens: Column, table: dict[str, str]) -> Column:
    if not table:
        return tokens
    pairs = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    return F.transform(tokens, lambda t: F.coalesce(F.try_element_at(pairs, t), t))


def strip_zeros(number: Column) -> Column:
    x = F.regexp_replace(number, "^0+", "")
    return F.when(x == "", F.lit("0")).otherwise(x)


def legal_form(name: Column, country: Column) -> tuple[Column, Column]:
    """The best form, and the core (of columns _name and _best): of every form's first place the one that ends last, then the one that starts first; core is the rest."""

    def of(label: str) -> Column:
        forms = sorted(rules.merged(rules.LEGAL_FORMS, label).items(), key=lambda kv: -len(kv[0]))
        padded = F.concat(F.lit(" "), name, F.lit(" "))
        table = F.array(*(F.struct(F.lit(f).alias("f"), F.lit(c).alias("form")) for f, c in forms))  # a constant
        places = F.transform(table, lambda x: F.struct(F.position(F.concat(F.lit(" "), x["f"], F.lit(" ")), padded).alias("at"), F.char_length(x["f"]).alias("until"), x["form"].alias("form")))
        found = F.transform(F.filter(places, lambda m: m["at"] > 0), lambda m: F.struct(m["at"].alias("at"), (m["at"] + m["until"]).alias("until"), m["form"].alias("form")))
        none = F.struct(F.lit(-1).alias("at"), F.lit(-1).alias("until"), F.lit("").alias("form"))
        better = lambda a, m: (a["form"] == "") | (m["until"] > a["until"]) | ((m["until"] == a["until"]) & (m["at"] < a["at"]))
        return F.aggregate(found, none, lambda a, m: F.when(better(a, m), m).otherwise(a))

    best = by_country(country, of)
    rest = F.btrim(F.concat_ws(" ", F.btrim(F.expr("substring(_name, 1, greatest(_best.at - 1, 0))")), F.btrim(F.expr("substring(_name, _best.until + 1)"))))
    return best, F.when(F.col("_best.form") == "", F.col("_name")).otherwise(rest)


def with_names(records: DataFrame, transliterated: bool = True) -> DataFrame:
    """Adds name_script, name_norm, name_core, legal_form, name_tokens, name_skeleton to entity_id, country, name_raw."""
    rows = records.withColumn("name_script", text.script(F.col("name_raw")))
    raw = F.when(F.col("name_script") == "Latin", F.col("name_raw")).otherwise(text.transliterate("name_raw")) if transliterated else F.col("name_raw")
    rows = rows.withColumn("_name", text.base(raw))
    rows = rows.withColumn("_name", F.regexp_replace("_name", f"^(?:(?:{'|'.join(rules.STRIP_PREFIXES)})(?: |$))+", ""))
    rows = rows.withColumn("name_tokens", expand(text.words(F.col("_name")), rules.NAME_ABBREVIATIONS)).withColumn("_name", F.array_join("name_tokens", " "))
    best, core = legal_form(F.col("_name"), F.col("country"))
    rows = rows.withColumn("_best", best)
    return rows.withColumns({"name_norm": F.col("_name"), "legal_form": F.col("_best.form"), "name_core": core, "name_skeleton": text.skeleton(F.col("_name"))}).drop("_name", "_best")


def house_number(address: str, country: str) -> Column:
    """Of a normalised address: the number after the first marker word, else a leading number, unless a word that says
    otherwise stands before it; without either, the first number that stands alone."""
    a = F.col(address)
    marked, leading = F.regexp_extract(a, MARKER, 1), F.regexp_extract(a, LEADING, 1)
    clean = lambda x: strip_zeros(F.regexp_replace(x, r"\s+", ""))
    before = F.element_at(F.split(F.btrim(F.expr(f"substring({address}, 1, greatest(regexp_instr({address}, '{MARKER.replace(chr(92), chr(92) * 2)}') - 1, 0))")), " "), -1)
    listed = by_country(F.col(country), lambda c: before.isin(*rules.non_house_markers(c)))
    tokens = F.split(a, " ")
    alone = F.filter(F.transform(tokens, lambda t, i: F.struct(t.alias("t"), F.when(i > 0, F.get(tokens, i - 1)).alias("p"), F.get(tokens, i + 1).alias("n"))), lambda x: x["t"].rlike(r"^\d[\d/\-]*[a-z]?$") & ~x["t"].rlike(r"^\d+(?:st|nd|rd|th)$") & ~F.coalesce(x["p"].isin(*rules.FALLBACK_NON_HOUSE), F.lit(False)) & ~F.coalesce(x["n"].isin("cross", "main"), F.lit(False)))
    first = F.coalesce(F.get(alone, F.lit(0))["t"], F.lit(""))
    return F.when(marked != "", F.when(listed, F.lit("")).otherwise(clean(marked))).when(leading != "", clean(leading)).when(first != "", strip_zeros(first)).otherwise(F.lit(""))


def with_addresses(records: DataFrame) -> DataFrame:
    """Adds addr_norm, addr_street (without the house number), house_num, addr_nums to entity_id, country, addr_raw."""
    missing = F.lower(F.btrim(F.coalesce("addr_raw", F.lit("")))).isin(*rules.NULL_LIKE)
    rows = records.withColumn("addr_norm", F.when(missing, F.lit("")).otherwise(text.base(F.col("addr_raw"))))
    tokens = text.words(F.col("addr_norm"))
    rows = rows.withColumn("addr_norm", F.array_join(by_country(F.col("country"), lambda c: expand(tokens, rules.merged(rules.ADDRESS_ABBREVIATIONS, c))), " "))
    numbers = F.transform(F.regexp_extract_all("addr_norm", F.lit(f"({ANY_NUMBER})"), F.lit(1)), lambda n: F.regexp_replace(strip_zeros(n), r"\s+", ""))
    rows = rows.withColumns({"house_num": house_number("addr_norm", "country"), "addr_nums": numbers}).withColumn("_t", text.words(F.col("addr_norm")))
    at = F.array_position(F.transform("_t", lambda t: (strip_zeros(t) == F.col("house_num")) | (t == F.col("house_num"))), True)
    street = F.filter("_t", lambda t, i: (F.col("house_num") == "") | (F.col("_at") == 0) | (i + 1 != F.col("_at")))
    return rows.withColumn("_at", at).withColumn("addr_street", F.array_join(street, " ")).drop("_t", "_at")


def area_tokens(records: DataFrame, share: float = AREA_SHARE) -> DataFrame:
    """country, token, docs: words of an address (over one letter, no leading digit) in more than a share of the country's records."""
    each = records.select("country", "entity_id", F.explode(F.array_distinct(F.split("addr_norm", " "))).alias("token")).filter((F.char_length("token") > 1) & ~F.col("token").rlike("^[0-9]"))
    docs = each.groupBy("country", "token").agg(F.count_distinct("entity_id").alias("docs"))
    return docs.join(records.groupBy("country").agg(F.count("*").alias("_n")), "country").filter(F.col("docs") / F.col("_n") > share).drop("_n")


def without_area_tokens(records: DataFrame, share: float = AREA_SHARE, areas: DataFrame | None = None) -> DataFrame:
    """addr_street without its country's area tokens (those of the records, unless areas gives them); where nothing would be
    left, as it is."""
    # fewer than 1 / share times the tokens of an average address for each country
    areas = area_tokens(records, share) if areas is None else areas
    rows = records.join(F.broadcast(areas.groupBy("country").agg(F.collect_list("token").alias("_area"))), "country", "left")
    left = F.array_join(F.filter(text.words(F.col("addr_street")), lambda t: ~F.array_contains(F.col("_area"), t)), " ")
    return rows.withColumn("addr_street", F.when(F.col("_area").isNull() | (left == ""), F.col("addr_street")).otherwise(left)).drop("_area")


def build_records(raw: DataFrame, transliterated: bool = True, areas: DataFrame | None = None) -> DataFrame:
    """entity_id, source, country, name_raw, addr_raw to the full records contract. Null names and addresses count as empty.
    areas: area_tokens() of a fixed world, where raw is only what came new."""
    rows = raw.withColumns({c: F.coalesce(c, F.lit("")) for c in ("name_raw", "addr_raw")})
    rows = saved(with_addresses(with_names(rows, transliterated)), "normalised")  # the counts of area tokens read it again
    return without_area_tokens(rows, areas=areas)
