"""Record normalisation: raw name, address and country to all views that later steps read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text

NAME_VIEWS = ("name_clean", "name_core", "name_tokens", "name_skel", "name_nospace", "name_acronym", "name_legal", "name_alts", "name_missing")
ADDRESS_VIEWS = ("addr_clean", "addr_core", "addr_tokens", "addr_numbers", "addr_postal", "addr_house", "addr_tail", "addr_landmark", "addr_missing")


def normalize_records(records: DataFrame, exact_fold: bool = False) -> DataFrame:
    """entity_id, source, the views of name and address, country_raw and country_norm.

    One projection, no shuffle. ``source`` is a column of ``records`` or else the id's prefix.
    """
    fold = text.fold_exact if exact_fold else text.fold
    source = F.col("source") if "source" in records.columns else F.substring("entity_id", 1, 2)
    folded = records.select(
        "entity_id", source.alias("source"), "business_name", "business_address", F.col("country").alias("country_raw"),
        fold(F.col("business_name")).alias("_name"), fold(F.col("business_address")).alias("_address"), fold(F.col("country")).alias("_country"))
    views = folded.select(
        "entity_id", "source", "country_raw", text.normalize_name(F.col("_name")).alias("_n"),
        text.normalize_address(F.col("_address")).alias("_a"), text.normalize_country(F.col("_country")).alias("country_norm"))
    return views.select("entity_id", *[f"_n.{c}" for c in NAME_VIEWS], *[f"_a.{c}" for c in ADDRESS_VIEWS], "source", "country_raw", "country_norm")


def examples(records: DataFrame) -> DataFrame:
    """Raw texts and their views side by side."""
    views = normalize_records(records).select(
        "entity_id", "name_core", "name_legal", F.array_join("name_alts", " | ").alias("name_alts"), "name_acronym",
        "addr_core", F.array_join("addr_postal", " ").alias("addr_postal"), "addr_house", "country_norm")
    return records.select("entity_id", "business_name", "business_address", "country").join(views, "entity_id")
