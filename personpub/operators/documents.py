"""From export rows to searchable documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from personpub.functions import scalars as fn
from personpub.schemas import EPISODES, EXPORT_NAMES

# Flag columns and their names in the document.
FLAG_NAMES = {
    "isperson": "isperson",
    "kivi": "kivi",
    "emem": "emem",
    "evo": "evo",
    "wwiiref": "wwii",
    "mv": "mv",
}


def original_names(documents: DataFrame) -> DataFrame:
    """The spelling of the source system for the columns that differ from it here."""
    return documents.withColumnsRenamed(EXPORT_NAMES)


def to_document(rows: DataFrame, now=None, keep: list[str] = ()) -> DataFrame:
    """One document per export row; a JSON cell that does not parse becomes null.

    Rows of the older layout lack episodes and redirects.
    """

    def optional(c: str):
        return F.col(c) if c in rows.columns else F.lit(None).cast("string")

    return rows.select(
        F.col("persoon").alias("id"),
        "kirje",
        "evokirje",
        "perenimi",
        "eesnimi",
        "isanimi",
        "emanimi",
        *[fn.absent(F.col(c)).alias(c) for c in ("synd", "surm", "synnikoht", "surmakoht")],
        fn.elements(F.col("kirjed")).alias("kirjed"),
        fn.elements(F.col("pereseosed")).alias("pereseosed"),
        fn.parsed(F.col("tahvlikirje")).alias("tahvlikirje"),
        fn.elements(optional("episoodid"), EPISODES).alias("episoodid"),
        *[fn.flag(F.col(c)).alias(name) for c, name in FLAG_NAMES.items()],
        optional("redirect").alias("redirect"),
        (F.current_timestamp() if now is None else now).alias("updated_at"),
        *keep,
    )
