"""Document-style entities: labels, aliases and claims. Values of claims stay raw JSON, as their shape depends on the property."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Property ids.
INSTANCE_OF, SUBCLASS_OF, REPLACED_BY, DISSOLVED, COUNTRY, LOCATED_IN, COORDINATES, COEXTENSIVE, OVERLAPS, CONTAINS, END_TIME = "P31", "P279", "P1366", "P576", "P17", "P131", "P625", "P3403", "P3179", "P150", "P582"
CENSUS_CODE = "P5578"
CODES = {"localbody": "P6425", "state": "P12747", "district": "P12746", "subdistrict": "P12748", "block": "P12717", "village": "P12745"}
# Item numbers.
PROPOSED, HOME_COUNTRY = 64728694, 668

SCHEMA = (
    "id STRING, data STRUCT<labels: MAP<STRING, STRUCT<language: STRING, value: STRING>>, aliases: MAP<STRING, ARRAY<STRUCT<language: STRING, value: STRING>>>, "
    "claims: MAP<STRING, ARRAY<STRUCT<rank: STRING, mainsnak: STRUCT<datavalue: STRUCT<value: STRING>>, qualifiers: MAP<STRING, ARRAY<STRUCT<datavalue: STRUCT<value: STRING>>>>>>>>"
)


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines (blank ones skipped); of equal ids the last stays."""
    from tabwright.sources.tables import keep_last, with_position

    rows = with_position(spark.read.schema(SCHEMA).json(path)).where("id is not null")
    return keep_last(rows, ["id"], ["pos"]).drop("pos")


def claims(prop: str) -> Column:
    return F.coalesce(F.try_element_at("data.claims", F.lit(prop)), F.array().cast("array<struct<rank:string,mainsnak:struct<datavalue:struct<value:string>>,qualifiers:map<string,array<struct<datavalue:struct<value:string>>>>>>"))


def is_current(claim: Column) -> Column:
    """No end time, or an empty one, or one without a value."""
    ends = F.try_element_at(claim["qualifiers"], F.lit(END_TIME))
    return ends.isNull() | (F.size(ends) == 0) | F.try_element_at(ends, F.lit(1))["datavalue"].isNull()


def inactive() -> Column:
    have = F.col("data.claims")
    return F.coalesce(F.map_contains_key(have, REPLACED_BY) | F.map_contains_key(have, DISSOLVED), F.lit(False))


def _number(claim: Column) -> Column:
    return F.get_json_object(claim["mainsnak"]["datavalue"]["value"], "$.numeric-id").try_cast("bigint")


def item_ids(prop: str, current: bool = True) -> Column:
    """Item numbers that a property names; none for inactive entities."""
    chosen = F.filter(claims(prop), is_current) if current else claims(prop)
    found = F.array_compact(F.transform(chosen, _number))
    return F.when(inactive(), F.array().cast("array<bigint>")).otherwise(found)


def ranks(prop: str = LOCATED_IN) -> Column:
    """Ranks of all claims, ended ones too; none for inactive entities."""
    return F.when(inactive(), F.array().cast("array<string>")).otherwise(F.transform(claims(prop), lambda c: c["rank"]))


def codes(code_type: str) -> Column:
    """Values of a code property; an unknown type raises."""
    if code_type not in CODES:
        raise KeyError(f"no code is of type {code_type}")
    return F.array_compact(F.transform(claims(CODES[code_type]), lambda c: c["mainsnak"]["datavalue"]["value"]))


def single_code(code_type: str) -> Column:
    """The code, or NA unless there is exactly one."""
    found = codes(code_type)
    return F.when(F.size(found) == 1, F.try_element_at(found, F.lit(1))).otherwise(F.lit("NA"))


def label(language: str = "en") -> Column:
    return F.coalesce(F.try_element_at("data.labels", F.lit(language))["value"], F.lit("NA"))


def aliases(language: str = "en") -> Column:
    return F.coalesce(F.transform(F.try_element_at("data.aliases", F.lit(language)), lambda a: a["value"]), F.array().cast("array<string>"))


def names() -> Column:
    """Label, then aliases."""
    return F.concat(F.array(label()), aliases())


def census_code() -> Column:
    """The last one wins; NA without any."""
    return F.coalesce(F.try_element_at(F.transform(claims(CENSUS_CODE), lambda c: c["mainsnak"]["datavalue"]["value"]), F.lit(-1)), F.lit("NA"))


def coordinates() -> Column:
    """struct(latitude, longitude) of the first claim."""
    value = F.try_element_at(claims(COORDINATES), F.lit(1))["mainsnak"]["datavalue"]["value"]
    return F.struct(F.get_json_object(value, "$.latitude").try_cast("double").alias("latitude"), F.get_json_object(value, "$.longitude").try_cast("double").alias("longitude"))


def instance_of(classes: Sequence[int]) -> Column:
    """Active, no claim at all of being proposed, and a current claim of one of the classes; entities without any class aren't."""
    every = claims(INSTANCE_OF)
    proposed = F.exists(every, lambda c: F.coalesce(_number(c) == PROPOSED, F.lit(False)))
    member = F.exists(every, lambda c: is_current(c) & F.coalesce(_number(c).isin(list(classes)), F.lit(False)))
    return ~inactive() & ~proposed & member


def in_country(number: int = HOME_COUNTRY) -> Column:
    """Any claim, ended or not."""
    return F.exists(claims(COUNTRY), lambda c: F.coalesce(_number(c) == number, F.lit(False)))


def edges(entities: DataFrame, props: Sequence[str] = (INSTANCE_OF, SUBCLASS_OF, LOCATED_IN, CONTAINS, COEXTENSIVE, OVERLAPS)) -> DataFrame:
    """src, prop, dst, rank, current: a row for each claim that names an item."""

    def of(prop: str) -> Column:
        return F.transform(claims(prop), lambda c: F.struct(F.lit(prop).alias("prop"), _number(c).alias("dst"), c["rank"].alias("rank"), is_current(c).alias("current")))

    parts = [of(p) for p in props]
    rows = entities.select(F.expr("try_cast(substr(id, 2) as bigint)").alias("src"), F.explode(F.concat(*parts)).alias("e"))
    return rows.select("src", "e.*").where("dst is not null")
