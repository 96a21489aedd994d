"""Treatment observations: prophylaxis, antiretrovirals and TB treatment, as it is and as planned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlift.functions import text
from chartlift.functions.dates import day_part, try_fix_date
from chartlift.operators import aggregates, eav, filters, joins
from chartlift.operators.filters import like_any

YES, NO = "LOCAL:YES", "LOCAL:NO"
TRUE, FALSE = "CIEL:1065", "CIEL:1066"

# Prophylactic drugs, as named in follow-ups.
PROPHYLAXES = {"CTX": "CIEL:105281", "Isoniazid": "CIEL:78280", "Fluconazole": "CIEL:76488"}
PLANNED_PROPHYLAXES = PROPHYLAXES | {"Mosquito net": "LOCAL:MOSQUITO NET", "other": "LOCAL:3120"}
# Ordered name to the name used in follow-ups.
ORDERED_PROPHYLAXES = {
    "tmp_smx_prophylaxis": "CTX", "inh_prophylaxis": "Isoniazid", "fluconazole": "Fluconazole",
    "fluconazole_low": "Fluconazole", "fluconazole_high": "Fluconazole", "mosquito_net": "Mosquito net",
    "other_prophylaxis": "other",
}
PLAN_SUFFIXES = ["", "_continue", "_stopped", "_dose", "_num_per_day", "_reason"]

# Regimen patterns, first match wins.
ART_PATTERNS = [
    ("azt%3tc%atv/r", "CIEL:164511"),
    ("azt%3tc%efv", "CIEL:160124"),
    ("azt%3tc%nvp", "CIEL:1652"),
    ("d4t%3tc%efv", "CIEL:160104"),
    ("d4t%3tc%nvp", "CIEL:792"),
    ("tdf%3tc%atv/r", "CIEL:164512"),
    ("tdf%3tc%dtg", "CIEL:165086"),
    ("tdf%3tc%efv", "CIEL:164505"),
    ("tdf%3tc%nvp", "CIEL:162565"),
]
ART_NEEDED = {
    "no": "CIEL:1066", "yes": "LOCAL:1619", "yes_after_accomp": "LOCAL:2222", "yes_continue": "CIEL:160037",
    "yes_deferred": "LOCAL:7262", "yes_immediately": "LOCAL:1619", "yes_ptme": "LOCAL:1619", "yes_refused": "CIEL:127750",
    "in_progress": "CIEL:160037",
}
ART_CHANGE_REASONS = {
    "pregnancy": "LOCAL:PATIENT PREGNANT", "treatment_refused": "LOCAL:PATIENT REFUSED", "side_effect": "LOCAL:TOXICITY, DRUG",
    "stock_out": "LOCAL:DRUG OUT OF STOCK", "ineffective": "LOCAL:REGIMEN FAILURE",
}

# TB treatment.
TB_PATTERNS = [
    ("tb_initial%", "LOCAL:2406"), ("tb_infant%", "LOCAL:2RHZ / 4RH"), ("tb_retreatment%", "LOCAL:2S+RHEZ / 1RHEZ / 5RH+E"),
    ("mdr_tb_treatment", "CIEL:159909"),
]
TB_OTHER_KNOWN = [
    "Premier 2HZRE+4HR", "2HZRE+4HR", "4RH", "4HR", "4 hr", "+ 4HR", "2HZRE + 4 HR.", "RHEZ", "2HRZE + 4HR", "2HZRE + 4 HR",
    " 2 HZRE + 4 HR", "Retraitement 2RHEZ/4RH",
]
TB_NEEDED = {
    "prior_not_indicated": "CIEL:1066", "start_tx": "CIEL:160017", "stop_tx": "CIEL:1267", "change_tx": "CIEL:981",
    "continue_no_change": "CIEL:163057", "yes": "CIEL:1065", "no": "CIEL:1066",
    "exam_in_progress": "LOCAL:WAITING FOR TEST RESULTS", "already_in_treatment": "LOCAL:CURRENTLY IN TREATMENT",
}
TB_REGIMENS = {
    "2HRZE_4HR": "LOCAL:2406", "2HRZ_4HR": "LOCAL:2RHZ / 4RH", "mdr_tb_treatment": "CIEL:159909", "hrez": "LOCAL:RHZE",
    "2S+HRZE_1HRZE_5HR+E": "LOCAL:2S+RHEZ / 1RHEZ / 5RH+E",
}
TB_REASONS = {
    "continuation_phase": "CIEL:159794", "cured": "CIEL:159791", "dose_change": "CIEL:981", "extended_treatment": "CIEL:160041",
    "finished_treatment": "CIEL:1267", "ineffective": "CIEL:843", "other": "CIEL:5622", "side_effect": "CIEL:102",
    "stock_out": "CIEL:1754",
}


def prophylaxis_state_obs(observations: DataFrame) -> DataFrame:
    """A group per encounter and prophylactic drug ticked in a follow-up, with its repaired start date."""
    prefix = "current_tx.prophylaxis_"
    name = F.col("observation")
    rows = observations.filter(name.startswith(prefix)).withColumn("_name", text.trim_prefix("observation", prefix))
    drug = F.regexp_replace("_name", "_start_date$", "")
    folded = rows.withColumn("drug", drug).filter(F.col("drug").isin(list(PROPHYLAXES))).groupBy("source_encounter_id", "drug").agg(
        aggregates.any_true(F.col("_name") == F.col("drug")).alias("ticked"),
        F.min(F.when(F.col("_name") != F.col("drug"), F.when(F.col("value") != "0000-00-00 00:00:00", F.col("value")))).alias("start"),
    ).filter("ticked")
    return eav.emit(folded, "prophylaxis", ["source_encounter_id", "drug"], "source_encounter_id", [
        eav.Group("LOCAL:2739", [
            eav.coded("LOCAL:2289", filters.case_map("drug", PROPHYLAXES)),
            eav.datetime("CIEL:163526", try_fix_date(day_part("start"))),
        ]),
    ])


def prophylaxis_plan_obs(observations: DataFrame, ordered: DataFrame) -> DataFrame:
    """Prophylaxis not indicated, indicated, and a prescription group per encounter and ordered drug.

    The suffixed rows of a drug (continue, stopped, dose, number, reason) are folded in one pass.
    """
    answers = eav.emit(observations, "prophylaxis_need", ["source_observation_id"], "source_encounter_id", [
        eav.coded("LOCAL:2740", FALSE, when=(F.col("observation") == "prophylaxis_not_indicated") & (F.col("value") == "t")),
    ])
    some = like_any("ordered", ["tmp_smx_prophylaxis%", "inh_prophylaxis%", "fluconazole%", "mosquito_net%", "other_prophylaxis%"])
    needed = eav.emit(ordered, "prophylaxis_yes", ["ordered_id"], "source_encounter_id", [eav.coded("LOCAL:2740", TRUE, when=some)])

    pattern = f"^({'|'.join(ORDERED_PROPHYLAXES)})({'|'.join(PLAN_SUFFIXES)})$"
    fits = F.col("ordered").rlike(pattern)
    base = F.when(fits, F.regexp_extract("ordered", pattern, 1))
    suffix = F.regexp_extract("ordered", pattern, 2)
    rows = ordered.select("source_encounter_id", "comments", base.alias("base"), suffix.alias("suffix")).filter("base IS NOT NULL")

    def has(part: str) -> Column:
        return aggregates.any_true(F.col("suffix") == part)

    def said(part: str) -> Column:
        return F.min(F.when(F.col("suffix") == part, F.col("comments")))

    plan = rows.groupBy("source_encounter_id", "base").agg(
        has("").alias("started"), has("_continue").alias("continued"), has("_stopped").alias("stopped"),
        said("_dose").alias("dose"), said("_num_per_day").alias("per_day"), said("_reason").alias("reason"), said("").alias("other"),
    )
    drug = filters.case_map(filters.case_map("base", ORDERED_PROPHYLAXES), PLANNED_PROPHYLAXES)
    groups = eav.emit(plan, "prophylaxis_plan", ["source_encounter_id", "base"], "source_encounter_id", [
        eav.Group("LOCAL:Prescription construct", [
            eav.coded("CIEL:1282", drug, comments=F.col("other")),
            eav.coded("LOCAL:PROPHYLAXIS STARTED", TRUE, when=F.col("started")),
            eav.coded("LOCAL:Prophylaxis should continue", TRUE, when=F.col("continued")),
            eav.coded("LOCAL:Stop Rx", TRUE, when=F.col("stopped")),
            eav.text("LOCAL:Prescription instructions non-coded", "dose"),
            eav.text("LOCAL:Number per day non coded", "per_day"),
            eav.text("LOCAL:REASON TREATMENT STOPPED COMMENT", "reason"),
        ]),
    ])
    return answers.unionByName(needed).unionByName(groups)


def _art_groups(rows: DataFrame, name: str, value: str, names: dict[str, str], job: str, group: str) -> DataFrame:
    """Regimen groups of encounters that name a coded regimen, another one, or just a start date.

    The coded value counts first, then the other text; a text without a code is kept, and the generic
    'other' answer stands in when neither text has a code.
    """
    trimmed = F.when(F.length(F.trim(value)) > 0, F.trim(value))
    folded = rows.filter(F.col(name).isin(list(names.values()))).groupBy("source_encounter_id").agg(
        F.min(F.when(F.col(name) == names["coded"], trimmed)).alias("coded"),
        F.min(F.when(F.col(name) == names["other"], trimmed)).alias("other"),
        F.min(F.when(F.col(name) == names["start"], F.col(value))).alias("start"),
        aggregates.any_true(F.col(name).isin(names["coded"], names["other"])).alias("has_row"),
    )
    wanted = folded.filter(
        F.coalesce("coded", "other").isNotNull() | (F.col("start").isNotNull() & ~F.col("has_row"))
    ).withColumns({"coded_ref": joins.pattern_map("coded", ART_PATTERNS), "other_ref": joins.pattern_map("other", ART_PATTERNS)})
    has_text = F.coalesce("coded", "other").isNotNull()
    answer = F.coalesce("coded_ref", "other_ref", F.when(has_text, F.lit("CIEL:5622")))
    plain_coded = F.when((F.col("coded") != "other") & F.col("coded_ref").isNull(), F.col("coded"))
    plain_other = F.when(F.col("other_ref").isNull() | (F.col("other_ref") != answer), F.col("other"))
    leftover = text.concat_skip_null(", ", plain_coded, plain_other)
    return eav.emit(wanted, job, ["source_encounter_id"], "source_encounter_id", [
        eav.Group(group, [
            eav.datetime("CIEL:159599", try_fix_date(day_part("start"))),
            eav.coded("LOCAL:1282", answer),
            eav.text("CIEL:5424", leftover),
        ]),
    ])


def art_status_obs(observations: DataFrame) -> DataFrame:
    """Current antiretrovirals of follow-ups, with the reasons for giving them."""
    names = {"coded": "current_tx.art", "other": "current_tx.art_other", "start": "current_tx.art_start_date"}
    groups = _art_groups(observations, "observation", "value", names, "art_status", "LOCAL:13156")
    treated = groups.filter("group_key IS NULL").select("source_encounter_id")
    status = eav.emit(treated, "art_treated", ["source_encounter_id"], "source_encounter_id", [eav.coded("CIEL:160117", TRUE)])
    name, value = F.col("observation"), F.col("value")
    answer = filters.case_map("value", {"t": TRUE, "f": FALSE})
    reasons = eav.emit(observations, "art_reason", ["source_observation_id"], "source_encounter_id", [
        eav.text("LOCAL:ARV treatment reason non-coded", value, when=name == "arv_treatment_reason"),
        eav.coded("CIEL:5576", answer, when=(name == "arvs_for_ptme") & value.isNotNull(), keep_null=True),
        eav.coded("CIEL:162225", "CIEL:1691", when=(name == "arvs_for_accident") & (value != "no"), comments=value),
    ])
    return groups.unionByName(status).unionByName(reasons)


def art_plan_obs(observations: DataFrame, ordered: DataFrame) -> DataFrame:
    """Need for antiretrovirals, and the planned regimen of intakes."""
    needed = eav.emit(observations, "art_needed", ["source_observation_id"], "source_encounter_id", [
        eav.coded("CIEL:162703", filters.case_map("value", ART_NEEDED), keep_null=True,
                  when=(F.col("observation") == "arv_treatment_needed") & F.col("value").isNotNull()),
    ])
    names = {"coded": "arv_regimen", "other": "arv_regimen_other", "start": "arv_start_date"}
    return needed.unionByName(_art_groups(ordered, "ordered", "comments", names, "art_plan", "LOCAL:6116"))


def tb_state_obs(observations: DataFrame) -> DataFrame:
    """Current TB treatment of follow-ups."""
    name, value = F.col("observation"), F.col("value")
    regular, other = name == "current_tx.tb", name == "current_tx.tb_other"
    answer = F.when(value != "none", YES).otherwise(NO)
    regimen = joins.pattern_map("value", TB_PATTERNS)
    known = F.when(value == "Retraitement 2RHEZ/4RH", "LOCAL:2408").otherwise("LOCAL:2406")
    each = eav.emit(observations, "tb_state", ["source_observation_id"], "source_encounter_id", [
        eav.coded("CIEL:159798", answer, when=regular),
        eav.datetime("CIEL:1113", try_fix_date(day_part("value")), when=name == "current_tx.tb_start_date"),
        eav.coded("CIEL:1111", regimen, when=regular & value.isNotNull() & (value != "none"), keep_null=True),
        eav.coded("CIEL:1111", known, when=other & value.isin(TB_OTHER_KNOWN)),
        eav.text("LOCAL:Anti TB free text", value, when=other & ~value.isin(TB_OTHER_KNOWN)),
    ])
    answered = observations.filter(regular).select("source_encounter_id")
    only_other = observations.filter(other).join(answered, "source_encounter_id", "left_anti")
    implied = eav.emit(only_other, "tb_state_other", ["source_observation_id"], "source_encounter_id", [eav.coded("CIEL:159798", YES)])
    return each.unionByName(implied)


def tb_plan_obs(observations: DataFrame, ordered: DataFrame) -> DataFrame:
    """Need for TB treatment, its start, regimen, and reason for change."""
    name = F.col("observation")
    told = eav.emit(observations, "tb_plan", ["source_observation_id"], "source_encounter_id", [
        eav.coded("LOCAL:1559", filters.case_map("value", TB_NEEDED), keep_null=True,
                  when=(name == "tb_treatment_needed") & F.col("value").isNotNull()),
        eav.coded("CIEL:1269", filters.case_map("value", TB_REASONS), keep_null=True, when=name == "tb_treatment_reason"),
    ])
    start = day_part("comments").try_cast("date")
    planned = eav.emit(ordered, "tb_regimen", ["ordered_id"], "source_encounter_id", [
        eav.datetime("CIEL:1113", start, when=F.col("ordered") == "tb_start_date"),
        eav.coded("CIEL:159792", filters.case_map("comments", TB_REGIMENS), when=F.col("ordered") == "tb_treatment"),
    ])
    return told.unionByName(planned)


def other_medication_obs(observations: DataFrame) -> DataFrame:
    return eav.emit(observations, "other_medication", ["source_observation_id"], "source_encounter_id",
                    [eav.text("LOCAL:13318", "value", when=F.col("observation") == "current_tx.other_medications")])


def art_change_obs(ordered: DataFrame) -> DataFrame:
    """Reason for changing antiretrovirals; 'other' takes the text of its companion row."""
    extra = ordered.filter("ordered = 'change_arvs_other'").groupBy("source_encounter_id").agg(F.min("comments").alias("_extra"))
    rows = ordered.filter("ordered = 'change_arvs' AND comments IS NOT NULL").join(extra, "source_encounter_id", "left")
    word = F.lower(F.trim("comments"))
    code = F.coalesce(filters.case_map(word, ART_CHANGE_REASONS), F.lit("LOCAL:OTHER NON-CODED"))
    comment = F.when(word == "other", F.col("_extra")).otherwise(F.trim("comments"))
    return eav.emit(rows, "art_change", ["ordered_id"], "source_encounter_id",
                    [eav.coded("LOCAL:REASON ANTIRETROVIRALS CHANGED OR STOPPED", code, comments=comment)])


def treatment_obs(observations: DataFrame, ordered: DataFrame) -> DataFrame:
    """All treatment observations."""
    parts = [
        prophylaxis_state_obs(observations), prophylaxis_plan_obs(observations, ordered), art_status_obs(observations),
        art_plan_obs(observations, ordered), tb_state_obs(observations), tb_plan_obs(observations, ordered),
        other_medication_obs(observations), art_change_obs(ordered),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
