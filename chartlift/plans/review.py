"""Warnings over everything, and sample data for test systems."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlift.functions.dates import full_years
from chartlift.functions.ids import p_hash
from chartlift.operators import eav, quality


def global_warnings(obs: DataFrame, limits: DataFrame) -> DataFrame:
    """Range, whole-number and missing-value warnings of all resolved observations."""
    return quality.all_warnings(quality.warn_out_of_range(obs, limits), quality.warn_null_values(obs))


def enriched_warnings(
    warnings: DataFrame, patients: DataFrame, identifiers: DataFrame, infants: DataFrame, encounters: DataFrame
) -> DataFrame:
    """Warnings with source, EMR, dossier and infant identifiers for the reviewers.

    ``identifiers``: person_id, kind ('emr' or 'dossier'), identifier.
    """
    kinds = [
        identifiers.filter(F.col("kind") == kind).select("person_id", F.col("identifier").alias(f"{kind}_id"))
        for kind in ("emr", "dossier")
    ]
    return quality.enrich_warnings(warnings, [
        (patients, "patient_id", "person_id", "source_patient_id"),
        (kinds[0], "patient_id", "person_id", "emr_id"),
        (kinds[1], "patient_id", "person_id", "dossier_id"),
        (infants, "patient_id", "person_id", "source_infant_id"),
        (infants, "patient_id", "person_id", "infant_code"),
        (encounters, "encounter_id", "encounter_id", "source_encounter_id"),
    ])


# Sample populations by sex and age: name, bounds of the first hash (low, high].
SAMPLE_BANDS = {
    ("M", True): [("msm", 0.0, 0.01), ("prisoner", 0.01, 0.012), ("iv", 0.012, 0.022)],
    ("M", False): [("msm", 0.0, 0.1), ("sw", 0.1, 0.11), ("prisoner", 0.11, 0.13), ("trans", 0.13, 0.134), ("iv", 0.134, 0.174)],
    ("F", True): [("iv", 0.0, 0.002)],
    ("F", False): [("sw", 0.0, 0.03), ("prisoner", 0.03, 0.04), ("trans", 0.04, 0.042), ("iv", 0.042, 0.092)],
}
# Concept of each population.
POPULATIONS = {
    "msm": "CIEL:160578", "sw": "CIEL:160579", "prisoner": "CIEL:156761", "trans": "LOCAL:11561", "iv": "CIEL:105",
}


def sample_population_obs(patients: DataFrame, encounters: DataFrame) -> DataFrame:
    """Hash-based sample answers on intakes: a first yes by sex and age, a second yes for some, unknowns.

    Everything about an intake follows from its own row, so the whole is one scan after the join.
    """
    people = patients.select("source_patient_id", "gender", "birthdate", F.concat("first_name", "last_name").alias("_name"))
    rows = encounters.filter("source_encounter_type = 'intake'").join(people, "source_patient_id")
    child = full_years("birthdate", "encounter_date") < 16
    first = p_hash("_name", 1)
    picked = None
    for (sex, young), bands in SAMPLE_BANDS.items():
        group = (F.col("gender") == sex) & (child if young else ~child)
        for name, low, high in bands:
            condition = group & (first > low) & (first <= high)
            picked = F.when(condition, name) if picked is None else picked.when(condition, name)
    rows = rows.withColumns({"_first": picked, "_h2": p_hash("_name", 2),
                             "_h3": p_hash("_name", 3), "_h4": p_hash("_name", 4)})
    chosen = F.col("_first")
    also_msm = F.coalesce(chosen.isin("sw", "prisoner", "trans", "iv") & (F.col("_h3") < 0.3), F.lit(False))
    has_msm = F.coalesce(chosen == "msm", F.lit(False)) | also_msm
    has_iv_first = F.coalesce(chosen == "iv", F.lit(False))
    also_iv = F.coalesce(~has_iv_first & chosen.isNotNull() & (F.col("_h4") < 0.2), F.lit(False))

    def has(name: str) -> Column:
        own = F.coalesce(chosen == name, F.lit(False))
        return {"msm": has_msm, "iv": has_iv_first | also_iv}.get(name, own)

    facts = []
    for name, concept in POPULATIONS.items():
        facts.append(eav.coded(concept, "LOCAL:YES", when=has(name), tag=f"{name}_yes"))
        facts.append(eav.coded(concept, "LOCAL:UNKNOWN", when=~has(name) & (F.col("_h2") < 0.25), tag=f"{name}_unknown"))
    return eav.emit(rows, "sample", ["source_encounter_id"], "source_encounter_id", facts)
