"""Literal (configuration) tables (SRC7). Small by construction; joins against
them are broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Weekly-bulletin disease configuration
# (name, ICD-10 code, page keywords (any), required keywords (all), optional).
DISEASES = [
    ("Varicela", "B01", ["Varicela", "B01"], ["ENTIDAD", "FEDERATIVA"], False),
    ("Sarampion", "B05", ["Saramp", "B05"], ["ENTIDAD", "FEDERATIVA"], True),
    ("Rubeola", "B06", ["B06"], ["ENTIDAD", "FEDERATIVA"], False),
    ("Escarlatina", "A38", ["Escarlatina", "A38"], ["ENTIDAD", "FEDERATIVA"], False),
    ("Erisipela", "A46", ["Erisipela", "A46"], ["ENTIDAD", "FEDERATIVA"], False),
]

# The 32 federal entities of the bulletin tables.
ENTITIES = [
    "Aguascalientes", "Baja California", "Baja California Sur", "Campeche", "Coahuila", "Colima", "Chiapas",
    "Chihuahua", "Ciudad de México", "Durango", "Guanajuato", "Guerrero", "Hidalgo", "Jalisco", "México",
    "Michoacán", "Morelos", "Nayarit", "Nuevo León", "Oaxaca", "Puebla", "Querétaro", "Quintana Roo",
    "San Luis Potosí", "Sinaloa", "Sonora", "Tabasco", "Tamaulipas", "Tlaxcala", "Veracruz", "Yucatán", "Zacatecas",
]

# Host entities of the case line-list (code -> label).
HOST_ENTITIES = {9: "CDMX", 14: "Jalisco (Gdl)", 19: "Nuevo León (Mty)"}

# Team name -> surveillance (WHO) country name.
COUNTRY_ALIAS = [
    ("Mexico", "Mexico"), ("South Africa", "South Africa"), ("South Korea", "Republic of Korea"),
    ("Tunisia", "Tunisia"), ("Uzbekistan", "Uzbekistan"), ("Colombia", "Colombia"), ("Japan", "Japan"),
    ("Spain", "Spain"), ("Uruguay", "Uruguay"),
]

# Playoff placeholders that are not teams yet.
PLACEHOLDER_TEAMS = ["Rep. UEFA D", "Rep. UEFA F", "Rep. Intercont. 2"]

# Scheduled matches in the host country (date, city, home, away).
FIXTURES = [
    ("2026-06-11", "CDMX", "Mexico", "South Africa"),
    ("2026-06-11", "Guadalajara", "South Korea", "Rep. UEFA D"),
    ("2026-06-14", "Monterrey", "Tunisia", "Rep. UEFA F"),
    ("2026-06-17", "CDMX", "Uzbekistan", "Colombia"),
    ("2026-06-18", "Guadalajara", "Mexico", "South Korea"),
    ("2026-06-20", "Monterrey", "Japan", "Tunisia"),
    ("2026-06-23", "Guadalajara", "Colombia", "Rep. Intercont. 2"),
    ("2026-06-24", "CDMX", "Rep. UEFA D", "Mexico"),
    ("2026-06-24", "Monterrey", "South Africa", "South Korea"),
    ("2026-06-26", "Guadalajara", "Spain", "Uruguay"),
]

DISEASE_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("cie10", T.StringType()),
    T.StructField("page_kw", T.ArrayType(T.StringType())), T.StructField("require_kw", T.ArrayType(T.StringType())),
    T.StructField("optional", T.BooleanType()),
])


def disease_config(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DISEASES, DISEASE_SCHEMA).coalesce(1)


def entities(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(e,) for e in ENTITIES], "entidad_federativa string").coalesce(1)


def host_entities(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(HOST_ENTITIES.items()), "ENTIDAD_RES int, sede string").coalesce(1)


def country_alias(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COUNTRY_ALIAS, "Country string, Country_who string").coalesce(1)


def fixtures(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(FIXTURES, "fecha string, ciudad string, home string, away string").coalesce(1)
    return df.selectExpr("to_date(fecha) AS fecha", "ciudad", "home", "away")


# Host city name in the match table -> entity label of the case
# table, and matches per host entity (group stage plus knockout rounds).
CITY_SEDE = [("CDMX", "CDMX"), ("Guadalajara", "Jalisco (Gdl)"), ("Monterrey", "Nuevo León (Mty)")]
MATCHES_PER_SEDE = {"CDMX": 4, "Jalisco (Gdl)": 4, "Nuevo León (Mty)": 3}


def sede_table(spark: SparkSession) -> DataFrame:
    rows = [(c, s, MATCHES_PER_SEDE[s]) for c, s in CITY_SEDE]
    return spark.createDataFrame(rows, "ciudad_sede string, sede string, partidos_en_sede int").coalesce(1)
