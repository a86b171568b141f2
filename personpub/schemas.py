"""Column layouts of the registry tables, fixed in one place.

Names are ASCII inside the engine; `EXPORT_NAMES` gives the spelling used in
documents and export headers.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from personpub.functions.scalars import COLLATION

# Columns of the published person table with their text widths.
WIDTHS = {
    "persoon": 10,
    "perenimi": 50,
    "eesnimi": 50,
    "isanimi": 50,
    "emanimi": 50,
    "synd": 50,
    "surm": 50,
    "synnikoht": 100,
    "surmakoht": 100,
}
FLAGS = ("isperson", "kivi", "emem", "evo", "wwiiref", "mv", "ylikoolis_oppinud")
JSON_LISTS = ("kirjed", "pereseosed", "episoodid")
JSON_COLUMNS = ("kirjed", "pereseosed", "tahvlikirje", "episoodid")
DEFAULTS = {
    "perenimi": "",
    "eesnimi": "",
    "isanimi": "",
    "emanimi": "",
    "synd": "",
    "surm": "",
    "synnikoht": "",
    "surmakoht": "",
    "kirjed": "[]",
    "pereseosed": "[]",
    "tahvlikirje": "[]",
    "episoodid": "[]",
    "redirect": "",
}

TEXTS = (
    "persoon", "kirje", "evokirje", "perenimi", "eesnimi", "isanimi", "emanimi",
    "synd", "surm", "synnikoht", "surmakoht",
)
PERSON_COLUMNS = (*TEXTS, *JSON_COLUMNS, *FLAGS, "redirect", "updated")

# Field order of the export files, by layout.
LAYOUTS = {
    "v2": (*TEXTS, *JSON_COLUMNS, *FLAGS, "redirect"),
    "v1": (*TEXTS, "kirjed", "pereseosed", "tahvlikirje", *FLAGS),
}
EXPORT_NAMES = {"synd": "sünd", "synnikoht": "sünnikoht"}


def collated(df: DataFrame) -> DataFrame:
    """The person tables' text columns under their collation, for tables kept that way."""
    return df.withColumns({c: F.collate(c, COLLATION) for c in (*TEXTS, "redirect") if c in df.columns})


def export_schema(layout: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in LAYOUTS[layout]])


EPISODES = "array<struct<nimetus:string,asukoht:string,aeg:string>>"
RECORDS = "array<struct<kirjekood:string>>"

# Property names per person column, in output order.
# A (json) column gives one property per list element.
NAMES_EST = {
    "kirje": "kirje",
    "eesnimi": "eesnimi",
    "perenimi": "perenimi",
    "emanimi": "emanimi",
    "isanimi": "isanimi",
    "synd": "synd",
    "synnikoht": "synnikoht",
    "surm": "surm",
    "surmakoht": "surmakoht",
    "kirjed": "kirjed",
    "pereseosed": "pereseosed",
    "episoodid": "episoodid",
    "tahvlikirje": "tahvlikirje",
    "evokirje": "evokirje",
    "isperson": "isPerson",
    "kivi": "kivi",
    "emem": "emem",
    "evo": "evo",
    "wwiiref": "wwiiref",
    "mv": "mv",
    "ylikoolis_oppinud": "ylikoolis_oppinud",
    "updated": "updated",
}
NAMES_ENG = {
    "kirje": "kirje",
    "perenimi": "surname",
    "eesnimi": "forename",
    "evokirje": "evokirje",
    "isanimi": "father",
    "emanimi": "mother",
    "synd": "birth",
    "surm": "death",
    "synnikoht": "birthplace",
    "surmakoht": "deathplace",
    "kirjed": "kirjed",
    "pereseosed": "pereseosed",
    "tahvlikirje": "tahvlikirje",
    "episoodid": "episoodid",
    "isperson": "isperson",
    "kivi": "kivi",
    "emem": "emem",
    "evo": "evo",
    "wwiiref": "wwii",
    "mv": "mv",
}
