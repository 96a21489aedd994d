"""Observations of clinic forms: forms, vitals, dispensing, exams, symptoms, adherence, family planning, nutrition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlift.functions import text
from chartlift.functions.clinical import decode_flag
from chartlift.functions.ids import uuid_name
from chartlift.functions.numbers import is_number, number_value, vital_value
from chartlift.operators import aggregates, eav, filters, quality
from chartlift.sources.readers import coded_by, inline_mapping

YES, NO = "LOCAL:YES", "LOCAL:NO"
TRUE, FALSE = "CIEL:1065", "CIEL:1066"

# ---- forms

# Progress words of follow-up forms.
PROGRESS = {
    "acceptable": "LOCAL:SATISFACTORY", "deterioration": "LOCAL:DETERIORATION", "excellent": "LOCAL:GOOD", "good": "LOCAL:GOOD",
    "no_progress": "CIEL:162679", "satisfactory": "LOCAL:SATISFACTORY",
}


def forms_obs(intake_forms: DataFrame, followup_forms: DataFrame) -> DataFrame:
    """Recommendation of intakes, progress of follow-ups, examining doctor of both."""
    doctor = eav.text("LOCAL:Provider name non-coded", "examining_doctor")
    intake = eav.emit(intake_forms, "intake_form", ["source_encounter_id"], "source_encounter_id",
                      [eav.text("CIEL:162749", "recommendation"), doctor])
    progress = eav.coded("CIEL:160116", filters.case_map("progress", PROGRESS), when=F.col("progress").isNotNull(), keep_null=True)
    followup = eav.emit(followup_forms, "followup_form", ["source_encounter_id"], "source_encounter_id", [progress, doctor])
    return intake.unionByName(followup)


# ---- vitals

# Concept of each vital sign.
VITAL_SIGNS = {
    "height": "3ce93cf2-26fe-102b-80cb-0017a47871b2",
    "weight": "3ce93b62-26fe-102b-80cb-0017a47871b2",
    "blood_pressure_dias": "3ce93694-26fe-102b-80cb-0017a47871b2",
    "blood_pressure_sys": "3ce934fa-26fe-102b-80cb-0017a47871b2",
    "heart_rate": "3ce93824-26fe-102b-80cb-0017a47871b2",
    "respiration_rate": "3ceb11f8-26fe-102b-80cb-0017a47871b2",
    "temperature": "3ce939d2-26fe-102b-80cb-0017a47871b2",
}


def vitals_encounters(vitals: DataFrame) -> DataFrame:
    """One vitals encounter per source encounter with a vital sign."""
    signs = vitals.filter(F.col("result").isNotNull()).groupBy("source_encounter_id").agg(F.count(F.lit(1)).alias("signs"))
    return signs.withColumn("uuid", uuid_name("vitals_encounter", "source_encounter_id"))


def vitals_obs(vitals: DataFrame) -> DataFrame:
    """Vital signs in canonical units; other signs are left out."""
    value = vital_value("sign", "result", "result_unit")
    return eav.emit(vitals.filter(F.col("result").isNotNull()), "vitals", ["vital_id"], "source_encounter_id",
                    [eav.numeric(filters.case_map("sign", VITAL_SIGNS), value, when=F.col("sign").isin(list(VITAL_SIGNS)))])


# ---- dispensing

# Dispensed product to drug and concept.
DISPENSED_DRUGS = [
    ("3TC 10 mg sp", "78f96684-dfbe-11e9-8a34-2a2ae2dbcce4", "3cd24e3e-26fe-102b-80cb-0017a47871b2"),
    ("ABC 20 mg", "78f98308-dfbe-11e9-8a34-2a2ae2dbcce4", "70057AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"),
    ("ABC 300 mg", "78f981d2-dfbe-11e9-8a34-2a2ae2dbcce4", "70057AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"),
    ("ABC 60 mg", "35c6041e-0af3-4bab-887d-9db682a02248", "70057AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"),
    ("ABC/3TC 120/60 mg", "a6985b15-5fd6-4bdf-93f6-62930a438464", "103166AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"),
    ("ABC/3TC 300/300 mg", "f2a2c2d9-16a6-4138-9074-6fdf3307e107", "103166AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"),
    ("ABC/3TC 60/30 mg", "78faa9b8-dfbe-11e9-8a34-2a2ae2dbcce4", "103166AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"),
    ("ATV/r 300/100 mg", "78f95d38-dfbe-11e9-8a34-2a2ae2dbcce4", "159809AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"),
    ("AZT 10 mg sp", "78f95bc6-dfbe-11e9-8a34-2a2ae2dbcce4", "3cd444be-26fe-102b-80cb-0017a47871b2"),
    ("AZT/3TC 300/150 mg", "78f968e6-dfbe-11e9-8a34-2a2ae2dbcce4", "3cd25168-26fe-102b-80cb-0017a47871b2"),
    ("AZT/3TC 60/30 mg", "78f95fa4-dfbe-11e9-8a34-2a2ae2dbcce4", "3cd25168-26fe-102b-80cb-0017a47871b2"),
    ("AZT/3TC/NVP 300/150/200 mg", "78f9739a-dfbe-11e9-8a34-2a2ae2dbcce4", "3cdc4a42-26fe-102b-80cb-0017a47871b2"),
    ("AZT/3TC/NVP 60/30/50 mg", "78f97cfa-dfbe-11e9-8a34-2a2ae2dbcce4", "3cdc4a42-26fe-102b-80cb-0017a47871b2"),
    ("Dapsone 100 mg", "1156a9ca-14f3-4c57-9ed2-7154e82447c7", "3cccd95e-26fe-102b-80cb-0017a47871b2"),
    ("DAR/ETV 300/100 mg", "0fc3d5c1-fd39-4899-b5c0-b094e28ff359", "7239d569-00ba-4a53-84de-f8754c4ca8dd"),
    ("DTG 50 mg", "78fab02a-dfbe-11e9-8a34-2a2ae2dbcce4", "165085AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"),
    ("DTG Ped", "8c35a0cd-9e2a-40eb-aa57-f589c25f17bf", "165085AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"),
    ("DTG/3TC/TDF 50/300/300 mg", "78faac2e-dfbe-11e9-8a34-2a2ae2dbcce4", "165086AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"),
    ("EFV 200 mg", "78f97b9c-dfbe-11e9-8a34-2a2ae2dbcce4", "3cd25622-26fe-102b-80cb-0017a47871b2"),
    ("EFV 600 mg", "78f96210-dfbe-11e9-8a34-2a2ae2dbcce4", "3cd25622-26fe-102b-80cb-0017a47871b2"),
    ("ETV 100mg", "29c9dd27-25f2-45c6-9708-93fe142a46ba", "159810AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"),
    ("INH 100 mg", "e47fa273-0c52-4f0f-b57b-34001a3e9677", "3cd27a8a-26fe-102b-80cb-0017a47871b2"),
    ("INH 300 mg", "849218ee-901c-46b3-80f9-7c808132893b", "3cd27a8a-26fe-102b-80cb-0017a47871b2"),
    ("LPV/r 100/25 mg", "78f976c4-dfbe-11e9-8a34-2a2ae2dbcce4", "794AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"),
    ("LPV/r 200/50 mg", "78f95e78-dfbe-11e9-8a34-2a2ae2dbcce4", "794AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"),
    ("LPV/r 40/10 mg", "78faaaf8-dfbe-11e9-8a34-2a2ae2dbcce4", "794AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"),
    ("LPV/r 80/20 mg", "78faa710-dfbe-11e9-8a34-2a2ae2dbcce4", "794AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"),
    ("NVP 10 mg sp", "78f967ba-dfbe-11e9-8a34-2a2ae2dbcce4", "3cd252f8-26fe-102b-80cb-0017a47871b2"),
    ("NVP 50 mg", "78f96526-dfbe-11e9-8a34-2a2ae2dbcce4", "3cd252f8-26fe-102b-80cb-0017a47871b2"),
    ("NVP 200 mg", "78f9780e-dfbe-11e9-8a34-2a2ae2dbcce4", "3cd252f8-26fe-102b-80cb-0017a47871b2"),
    ("RAL/DAR/r 400/600/100mg", "08d3817b-4e54-4825-bc4b-0512b627d567", "69041e6c-aeb9-4c36-9c76-cd9c5ef4e81d"),
    ("RAL/ETV 400/100 mg", "c893970e-22b5-4cb9-8be2-1a9bff480235", "891dcb9a-3c80-4917-a10f-07c209499413"),
    ("TDF 300 mg", "78faa576-dfbe-11e9-8a34-2a2ae2dbcce4", "3cd45166-26fe-102b-80cb-0017a47871b2"),
    ("TDF/3TC 300/300 mg", "78f96a76-dfbe-11e9-8a34-2a2ae2dbcce4", "161364AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"),
    ("TDF/3TC/EFV 300/300/600 mg", "78f960da-dfbe-11e9-8a34-2a2ae2dbcce4", "e43b308c-a303-4524-b4bd-a728a9f52faf"),
    ("TMS 120 mg", "160d7a20-f710-48b3-9c9b-0a1b98ab5871", "3cd51772-26fe-102b-80cb-0017a47871b2"),
    ("TMS 240 mg sp", "b3910fb7-2b17-44e6-8a52-8543af46c935", "3cd51772-26fe-102b-80cb-0017a47871b2"),
    ("TMS 480 mg", "54972d88-156e-465e-8483-9a9e97d5898f", "3cd51772-26fe-102b-80cb-0017a47871b2"),
    ("TMS 960 mg", "85153088-b868-4723-aacd-27f25f121685", "3cd51772-26fe-102b-80cb-0017a47871b2"),
]
TREATMENT_LINES = {
    "first_line": "697e9461-f2d6-4ab1-a140-48f768ce002a",
    "second_line": "11c0f708-6950-4e94-b080-5c76174a4947",
    "third_line": "224e3d57-f6d1-4244-bbe2-b81a574ba7aa",
}
MEDICATION_CATEGORIES = {
    "arv_1": "d8252da3-eac3-417e-9f84-b747f07c1c09",
    "arv_2": "3ce85288-26fe-102b-80cb-0017a47871b2",
    "inh_1": "3cd27a8a-26fe-102b-80cb-0017a47871b2",
}
PROPHYLAXIS_CATEGORY = "8b801f21-16a9-42cf-9869-9f491395765b"
PATIENT_AT_VISIT = "1249F550-FF24-4F3E-A743-B37232E9E1C3"
HELPER_AT_VISIT = "bf997029-a496-41a2-a7e7-7981e82d2dd0"


def dispensing_obs(dispensing: DataFrame) -> DataFrame:
    """Who came, who helped, where, treatment line, months given and next date."""
    person = F.when(F.col("dispensed_to") == "patient", PATIENT_AT_VISIT).otherwise(HELPER_AT_VISIT)
    line = filters.case_map("art_treatment_line", TREATMENT_LINES)
    return eav.emit(dispensing, "dispensing", ["source_encounter_id"], "source_encounter_id", [
        eav.coded("d0d91980-6788-4325-80d3-3bd7b54e705a", person, when=F.col("dispensed_to").isNotNull()),
        eav.text("c29f0c91-0128-445d-a64b-1f85498c5752", "accompagnateur_name"),
        eav.coded("6c2f54c5-e3f5-44e7-b4bb-215cfdab5e82", "5d4db9da-ae1e-4863-98de-cd5095c01cc8", when=F.col("dac")),
        eav.coded("0c709500-0cf8-4959-b244-3e9d24dcacc0", line, when=F.col("art_treatment_line").isNotNull(), keep_null=True),
        eav.numeric("9515cb6d-a243-454b-a77f-d762d50cba84", "months_dispensed"),
        eav.datetime("3ce94df0-26fe-102b-80cb-0017a47871b2", "next_dispense_date"),
    ])


def dispensed_meds_obs(meds: DataFrame) -> DataFrame:
    """A group per dispensed medication: category, coded drug, quantity."""
    drugs = inline_mapping(meds.sparkSession, DISPENSED_DRUGS, "source_product_name string, drug string, drug_concept string")
    rows = meds.join(drugs, "source_product_name", "left")
    category = F.coalesce(filters.case_map("source_medication_category", MEDICATION_CATEGORIES), F.lit(PROPHYLAXIS_CATEGORY))
    drug_order = "3cd9491e-26fe-102b-80cb-0017a47871b2"
    return eav.emit(rows, "dispensed", ["med_id"], "source_encounter_id", [
        eav.Group("cef4a703-8521-4c2d-9932-d1429a57e684", [
            eav.coded("3cdbc4b4-26fe-102b-80cb-0017a47871b2", category, when=F.col("source_medication_category").isNotNull()),
            eav.Fact(drug_order, "drug", F.col("drug"), answer=F.col("drug_concept")),
            eav.numeric("95d216d3-8683-4582-97bd-b3ca5131e18d", "quantity"),
        ]),
    ])


def dispensing_warnings(meds: DataFrame, patients: DataFrame) -> DataFrame:
    """Products without a mapping, and the paediatric one whose strength has to be checked."""
    known = inline_mapping(meds.sparkSession, [(name,) for name, _, _ in DISPENSED_DRUGS], "name string")
    rows = meds.join(patients.select("source_patient_id", "person_id"), "source_patient_id")
    about = {"patient": "person_id", "encounter": "source_encounter_id", "field": "hiv_dispensing_meds", "value": "source_product_name"}
    return quality.all_warnings(
        quality.warn(quality.unmapped_codes(rows, "source_product_name", known, "name"),
                     "No mapping to a concept or drug.  Not migrating.", **about),
        quality.warn(rows, "All DTG Ped Meds migrated to 10mg tablet. Check regimen if this should be 5mg tablet",
                     when=F.col("source_product_name") == "DTG Ped", **about),
    )


# ---- exams


def _diagnosis_group(children: list[eav.Fact], when: Column, tag: str = "") -> eav.Group:
    return eav.Group("LOCAL:Visit Diagnoses", [
        eav.coded("LOCAL:CLINICAL IMPRESSION DIAGNOSIS CONFIRMED", "LOCAL:PRESUMED"),
        eav.coded("LOCAL:Diagnosis order", "LOCAL:primary"), *children,
    ], when=when, tag=tag)


def exams_obs(exams: DataFrame, encounters: DataFrame) -> DataFrame:
    """Presenting history by type of encounter, the differential diagnosis, exam comments."""
    kinds = encounters.select("source_encounter_id", "source_encounter_type")
    rows = exams.join(kinds, "source_encounter_id", "left")
    kind = F.col("source_encounter_type")
    return eav.emit(rows, "exam", ["source_encounter_id"], "source_encounter_id", [
        eav.text("LOCAL:PRESENTING HISTORY", "presenting_history", when=kind == "intake"),
        eav.text("CIEL:160531", "presenting_history", when=kind == "followup"),
        _diagnosis_group([eav.text("LOCAL:Diagnosis or problem, non-coded", "diagnosis")], F.col("diagnosis").isNotNull()),
        eav.text("LOCAL:PHYSICAL SYSTEM COMMENT", "comments"),
    ])


# Opportunistic infections; an empty code has no concept.
OPPORTUNISTIC_INFECTIONS = {
    "acute_diarrhea": "CIEL:1467", "anxiety": "CIEL:121543", "bacterial_diarrhea": "CIEL:148023",
    "bacterial_meningitis": "CIEL:121255", "bacterial_pneumonia": "CIEL:121252", "candidiaris_esophagitis": "CIEL:146513",
    "candidiaris_oropharyngeal": "CIEL:5334", "candidiaris_other": "CIEL:120939", "candidiaris_vaginal": "CIEL:298",
    "chancroid": "LOCAL:2738", "chronic_diarrhea": "CIEL:145443", "cryptococcus_meningitis": "CIEL:1294",
    "depression": "CIEL:119537", "dysentery": "CIEL:152", "dysphagia": "CIEL:145443", "encephalopathy": "CIEL:119288",
    "extrapulmonary_tb": "CIEL:5042", "genital_ulcerations": "CIEL:864", "genito_urinary_syphilis": "CIEL:129119",
    "herpes_zoster": "CIEL:117543", "hiv": "CIEL:1169", "hsv": "CIEL:138706", "kaposis_sarcoma": "CIEL:507",
    "lgv": "CIEL:135462", "lymphoma": "CIEL:116104", "malaria": "CIEL:116128", "meningitis": "CIEL:115835",
    "neurologic_syphilis": "CIEL:115257", "none": "CIEL:1007", "other": "", "other_diarrhea": "CIEL:142412",
    "other_encephalopathy": "CIEL:119288", "other_meningitis": "CIEL:115835", "other_neuro": "LOCAL:995",
    "other_pneumonia": "CIEL:114100", "other_rash": "CIEL:512", "parasitic_diarrhea": "LOCAL:DIARRHEA, PARASITE",
    "pcp_pneumonia": "CIEL:882", "pid": "CIEL:902", "pneumopathy": "CIEL:119137", "prurigo_nodulairis": "LOCAL:1370",
    "pruritis": "LOCAL:PRURITIS", "psychosis": "CIEL:113517", "pulmonary_tb": "CIEL:42", "seizures": "CIEL:113054",
    "shingles": "CIEL:117543", "std": "LOCAL:174", "tb_enteritis": "CIEL:118606", "tb_meningitis": "CIEL:111967",
    "thrush": "CIEL:5334", "toxoplasmosis": "CIEL:5355", "trichomoniasis": "CIEL:117146", "tuberculoma": "CIEL:124069",
    "tuberculosis": "CIEL:112141", "typhoid": "CIEL:141", "vaginal_urethral_discharge": "CIEL:123529",
    "vaginal_urethral_gc": "CIEL:117767", "vaginal_urethral_other": "", "warts": "CIEL:123228", "wasting": "CIEL:823",
    "weight_loss": "CIEL:832",
}


def infections_obs(infections: DataFrame, encounters: DataFrame) -> DataFrame:
    """Opportunistic infections of version 3 forms as diagnoses, coded or not; comments of both visit kinds.

    ``infections``: infection_id, source_encounter_id, oi, comments, form_version.
    """
    rows = infections.withColumn("oi", F.lower(F.trim("oi"))).filter("form_version = '3' AND oi IS NOT NULL")
    rows = coded_by(rows, "oi", OPPORTUNISTIC_INFECTIONS, "_ref")
    oi, comments = F.col("oi"), F.col("comments")
    named = ~oi.isin("none", "other", "candidiaris_other")
    note = "LOCAL:Diagnosis or problem, non-coded"
    candida = F.concat(F.lit("Candidiasis ("), F.coalesce(comments, F.lit("")), F.lit(")"))
    drafts = eav.emit(rows, "infection", ["infection_id"], "source_encounter_id", [
        eav.coded("LOCAL:1401", "CIEL:1107", when=oi == "none"),
        _diagnosis_group([
            eav.coded("LOCAL:DIAGNOSIS", F.col("_ref"), when=named & (F.col("_ref") != ""), comments=comments),
            eav.text(note, comments, when=oi == "other"),
            eav.text(note, candida, when=oi == "candidiaris_other"),
            eav.text(note, oi, when=named & (F.col("_ref") == ""), comments=comments),
        ], oi != "none"),
    ])
    visits = encounters.filter(F.col("source_encounter_type").isin("intake", "followup"))
    remarks = eav.emit(visits, "visit_comment", ["source_encounter_id"], "source_encounter_id",
                       [eav.text("LOCAL:CLINICAL IMPRESSION COMMENTS", "comments")])
    return drafts.unionByName(remarks)


# WHO staging criteria.
STAGING_CRITERIA = {
    "acute_necrotizing_ulcerative_stomatitis_gingivitis_periodontitis": "CIEL:149629",
    "angular_cheilitis": "CIEL:148762",
    "asymptomatic": "CIEL:5327",
    "atypical_disseminated_leishmaniasis": "CIEL:159338",
    "candidiasis_of_esophagus_trachea_bronchi_lungs": "CIEL:5340",
    "chronic_cryptosporidiosis_over_1_month": "CIEL:5034",
    "chronic_herpes_simplex": "CIEL:138706",
    "cns_toxoplasmosis": "CIEL:990",
    "chronic_isosporiasis": "CIEL:160520",
    "cytomegalovirus_infection": "CIEL:5035",
    "disseminated_mycosis": "CIEL:5350",
    "disseminated_non_tb_mycobacteria": "CIEL:5043",
    "extrapulmonary_tb": "CIEL:5042",
    "fungal_nail_infection": "CIEL:132387",
    "herpes_zoster": "CIEL:117543",
    "hiv_encephalopathy": "CIEL:160442",
    "hiv_wasting": "CIEL:823",
    "invasive_cervical_carcinoma": "CIEL:116023",
    "kaposis_sarcoma": "CIEL:507",
    "lymphoma_cerebra_or_b_cell_non_hodgkin": "CIEL:115195",
    "oral_hairy_leukoplakia": "CIEL:5337",
    "papular_pruritic_eruptions": "CIEL:1249",
    "persistent_generalized_lymphadenopathy": "CIEL:5328",
    "persistent_oral_candidiasis": "LOCAL:2580",
    "pneumocystis_pneumonia": "CIEL:130021",
    "progressive_multifocal_leukoencephalopathy": "CIEL:5046",
    "pulmonary_tuberculosis_current": "CIEL:42",
    "recurrent_oral_ulceration": "CIEL:159912",
    "recurrent_severe_bacterial_pneumonia": "CIEL:1215",
    "recurrent_upper_respitory_infections": "CIEL:127784",
    "seborrhoeic_dermatitis": "CIEL:113116",
    "symptomatic_nephropathy_or_cardiomyopathy_associated_with_hiv": "LOCAL:2721",
    "recurrent_septicaemia": "LOCAL:11407",
    "severe_bacterial_infections": "CIEL:5030",
    "unexplained_anaemia_neutropaenia_thrombocytopaenia_over_1_month": "LOCAL:2582",
    "unexplained_chronic_diarrhea_over_1_month": "CIEL:5018",
    "unexplained_persistent_fevre": "CIEL:5027",
    "unexplained_weight_loss_over_10_percent": "CIEL:5339",
    "unexplained_weight_loss_under_10_percent": "CIEL:5332",
}


def staging_criteria_obs(criteria: DataFrame) -> DataFrame:
    """One coded fact per known criterion."""
    rows = coded_by(criteria, "criterium", STAGING_CRITERIA, "_ref")
    return eav.emit(rows, "staging", ["criterion_id"], "source_encounter_id", [eav.coded("CIEL:6042", F.col("_ref"))])


# Systems and findings of the physical exam.
EXAM_CODES = {
    "abdominal": "LOCAL:ABDOMINAL EXAM FINDINGS", "cardiovascular": "LOCAL:CARDIAC EXAM FINDINGS",
    "conjunctiva": "LOCAL:HEENT EXAM FINDINGS", "extremities": "LOCAL:MUSCULOSKELETAL EXAM FINDINGS",
    "general": "LOCAL:GENERAL EXAM FINDINGS", "lymph_nodes": "CIEL:1121", "neurologic": "LOCAL:NEUROLOGIC EXAM FINDINGS",
    "oropharynx": "LOCAL:HEENT EXAM FINDINGS", "pulmonary": "LOCAL:CHEST EXAM FINDINGS", "scleras": "LOCAL:HEENT EXAM FINDINGS",
    "skin": "LOCAL:SKIN EXAM FINDINGS", "urogenital": "LOCAL:UROGENITAL EXAM FINDINGS", "ascites": "LOCAL:ASCITES",
    "axillary": "CIEL:148058", "cervical": "CIEL:145802", "crepitance": "LOCAL:CREPITATIONS", "discharge": "LOCAL:GENITAL DISCHARGE",
    "edema": "CIEL:460", "hepatomegaly": "LOCAL:HEPATOMEGALY", "icteric": "LOCAL:ICTERIC SCLERA", "inginual": "CIEL:137155",
    "none": "LOCAL:NORMAL", "normal": "LOCAL:NORMAL", "pale": "LOCAL:PALE CONJUNCTIVA", "rales": "LOCAL:6894",
    "splenomegaly": "LOCAL:SPLENOMEGALY", "ulcers": "CIEL:864", "wheeze": "LOCAL:WHEEZE",
}
HEAD_EXAMS = ["conjunctiva", "scleras", "oropharynx"]


def system_status_obs(statuses: DataFrame) -> DataFrame:
    """System and finding both coded; normal head findings of an encounter become one sentence."""
    rows = statuses.withColumns({"exam": F.lower(F.trim("system")), "finding": F.lower(F.trim("condition"))})
    coded = coded_by(coded_by(rows, "exam", EXAM_CODES, "_exam"), "finding", EXAM_CODES, "_finding")
    normal_head = F.col("exam").isin(HEAD_EXAMS) & (F.col("finding") == "normal")
    both = F.col("_exam").isNotNull() & F.col("_finding").isNotNull()
    each = eav.emit(coded, "system_status", ["status_id"], "source_encounter_id",
                    [eav.coded(F.col("_exam"), F.col("_finding"), when=both & ~normal_head)])
    listed = aggregates.string_agg(rows.filter(normal_head), ["source_encounter_id"], "exam", "listed", ", ")
    sentence = eav.emit(listed, "head_normal", ["source_encounter_id"], "source_encounter_id",
                        [eav.text("CIEL:163045", F.concat("listed", F.lit(" : normal")))])
    return each.unionByName(sentence)


# ---- exam extras

# WHO stages.
WHO_STAGES = {
    "1": "LOCAL:WHO STAGE 1 ADULT", "2": "LOCAL:WHO STAGE 2 ADULT", "3": "LOCAL:WHO STAGE 3 ADULT", "4": "LOCAL:1207",
}
EXTRA_TYPES = ["intake", "followup"]


def exam_extra_obs(extra: DataFrame, encounters: DataFrame) -> DataFrame:
    """Plan, stage, pregnancy, partner test, counselling and activities of intakes and follow-ups.

    Facts whose key starts with ``activities`` belong to the socio-economics encounter of that day.
    """
    kinds = encounters.filter(F.col("source_encounter_type").isin(EXTRA_TYPES)).select("source_encounter_id")
    rows = extra.join(kinds, "source_encounter_id", "left_semi")
    partner = filters.case_map("partner_referred_for_tr_p", {"t": YES, "f": NO, "9": "LOCAL:NO PARTNER"})
    counselling = filters.case_map("post_test_counseling_p", {"t": YES, "f": NO})
    main = eav.emit(rows, "exam_extra", ["source_encounter_id"], "source_encounter_id", [
        eav.datetime("3ce94df0-26fe-102b-80cb-0017a47871b2", "next_exam_date"),
        eav.text("LOCAL:1620", "plan_extra"),
        eav.coded("LOCAL:CURRENT WHO HIV STAGE", filters.case_map("who_stage", WHO_STAGES)),
        eav.coded("LOCAL:PREGNANCY STATUS", YES, when=decode_flag("pregnant_p")),
        eav.datetime("LOCAL:DATE OF LAST MENSTRUAL PERIOD", "last_period_date"),
        eav.datetime("CIEL:5596", "expected_delivery_date"),
        eav.coded("LOCAL:PARTNER REFERRED FOR HIV TEST", partner, when=F.col("partner_referred_for_tr_p").isNotNull(), keep_null=True),
        eav.coded("CIEL:159382", counselling),
    ])
    activities = eav.emit(rows, "activities", ["source_encounter_id"], "source_encounter_id", [
        eav.text("LOCAL:1402", "main_activity_before"),
        eav.text("LOCAL:11543", "main_activity_how_now"),
        eav.text("LOCAL:OTHER ACTIVITIES BEFORE ILLNESS", "other_activities_before"),
        eav.text("LOCAL:CURRENT ABILITY TO PERFORM OTHER ACTIVITIES BEFORE ILLNESS", "other_activities_how_now"),
    ])
    return main.unionByName(activities)


def exam_extra_warnings(extra: DataFrame, encounters: DataFrame) -> DataFrame:
    """Next exam dates on encounters of other types."""
    rows = extra.filter(F.col("next_exam_date").isNotNull()).join(
        encounters.select("source_encounter_id", "source_patient_id", "source_encounter_type", "encounter_date"), "source_encounter_id"
    )
    return quality.warn(rows, "next_exam_date found on encounter other than intake or followup", patient="source_patient_id",
                        encounter="source_encounter_id", date=F.to_date("encounter_date"), field="next_exam_date",
                        value=F.date_format("next_exam_date", "yyyy-MM-dd"),
                        details=F.concat(F.lit("Encounter type: "), "source_encounter_type"),
                        when=~F.col("source_encounter_type").isin(EXTRA_TYPES))


def transfers_obs(observations: DataFrame, institutions: DataFrame, sites: DataFrame, outside_name: str) -> DataFrame:
    """Transfers out (to a supported site or ``outside_name``) and transfers in.

    ``institutions``: institution_id, name; ``sites``: site, location_id.
    """
    out = observations.filter("observation = 'transfer_out_to' AND value IS NOT NULL").join(
        institutions.select(F.col("institution_id").cast("string").alias("value"), "institution_id", "name"), "value"
    ).join(sites.select(F.col("site").alias("institution_id"), "location_id"), "institution_id", "left")
    outside = F.coalesce(F.col("name") == outside_name, F.lit(False))
    place = F.when(outside, "LOCAL:unsupported site").otherwise("LOCAL:supported site")
    sent = eav.emit(out, "transfer_out", ["source_observation_id"], "source_encounter_id", [
        eav.Group("LOCAL:13170", [
            eav.coded("LOCAL:HUM Disposition categories", "LOCAL:PATIENT TRANSFERRED OUT"),
            eav.coded("LOCAL:Transfer out location", place),
            eav.text("LOCAL:8621", F.col("location_id").cast("string"), when=~outside, comments=F.lit("location")),
        ]),
    ])
    origin = observations.filter("observation = 'transfer_in_from'").groupBy("source_encounter_id").agg(
        F.min("value").alias("_from")
    )
    come = observations.filter("observation = 'transfer_p' AND value = 't'").join(origin, "source_encounter_id", "left")
    received = eav.emit(come, "transfer_in", ["source_observation_id"], "source_encounter_id", [
        eav.Group("LOCAL:13169", [
            eav.coded("LOCAL:13712", "LOCAL:6965"),
            eav.coded("LOCAL:6401", "LOCAL:8856", when=F.col("_from").isNotNull()),
            eav.text("LOCAL:11483", "_from"),
        ]),
    ])
    return sent.unionByName(received)


# Symptoms of the TB screening, their concept, and the name used in comments.
TB_SCREENING = {
    "loss_of_weight": ("LOCAL:11566", "weight_loss"),
    "cough": ("LOCAL:11567", "cough"),
    "tb_contact": ("LOCAL:11568", None),
    "hymoptusis": ("LOCAL:970", "bloodyCough"),
    "dyspnea": ("LOCAL:5960", "dyspnea"),
    "chest_pain": ("LOCAL:136", "chestPain"),
}
SCREENED_YES, SCREENED_NO = "LOCAL:11563", "LOCAL:11564"


def tb_screening_symptoms_obs(symptoms: DataFrame) -> DataFrame:
    """TB screening answers: symptom rows folded to one row per encounter, then one fact per answer.

    One aggregate stands for the eight joins of the source. Missing parts of a comment stay empty, as
    the source's concatenation treats null as ''.
    """
    names = ["fever", "night_sweats", *TB_SCREENING]
    parts = [
        F.max(F.when(F.col("symptom") == name, F.struct(
            F.col("result").alias("result"), F.col("duration").cast("string").alias("duration"), F.col("duration_unit").alias("unit")
        ))).alias(name)
        for name in names
    ]
    rows = symptoms.filter(F.col("symptom").isin(names)).groupBy("source_encounter_id").agg(*parts)

    def said(name: str, part: str) -> Column:
        return F.coalesce(F.col(name)[part], F.lit(""))

    def comment(name: str, label: str) -> Column:
        return F.concat(F.lit(f"{label}_duration="), said(name, "duration"), F.lit(f",{label}_duration_unit="), said(name, "unit"))

    fever, sweat = F.col("fever")["result"], F.col("night_sweats")["result"]
    either = F.coalesce(fever == "t", F.lit(False)) | F.coalesce(sweat == "t", F.lit(False))
    fever_comment = F.concat(
        F.lit("fever_result="), said("fever", "result"), F.lit(",fever_duration="), said("fever", "duration"),
        F.lit(",fever_duration_unit="), said("fever", "unit"), F.lit("; night_sweat_result="), said("night_sweats", "result"),
        F.lit(",night_sweat_duration="), said("night_sweats", "duration"), F.lit(",night_sweat_duration_unit="),
        said("night_sweats", "unit"),
    )
    question = F.when(either, SCREENED_YES).otherwise(SCREENED_NO)
    facts = [eav.coded(question, "LOCAL:11565", when=fever.isNotNull() | sweat.isNotNull(), comments=fever_comment, tag="fever")]
    for name, (answer, label) in TB_SCREENING.items():
        flag = decode_flag(F.col(name)["result"])
        concept = F.when(flag, SCREENED_YES).otherwise(SCREENED_NO)
        facts.append(eav.coded(concept, answer, when=flag.isNotNull(), comments=comment(name, label) if label else None, tag=name))
    return eav.emit(rows, "tb_symptoms", ["source_encounter_id"], "source_encounter_id", facts)


# ---- symptoms

# Symptoms that are migrated, and their concepts.
SYMPTOMS = {
    "confusion": "CIEL:120345", "convulsions": "CIEL:113054", "diarrhea": "CIEL:142412", "dysphagia": "CIEL:118789",
    "genital_discharge": "LOCAL:1816", "genital_ulcers": "CIEL:864", "headache": "CIEL:139084", "icterus": "CIEL:136443",
    "nausea": "CIEL:5978", "neurologic_deficit": "CIEL:1466", "paresthesia": "CIEL:6004", "prurigo_nodularis": "CIEL:128321",
    "rash": "CIEL:512", "vision_problems": "CIEL:118938", "vomiting": "CIEL:122983",
}
DURATION_UNITS = {"years": "CIEL:1734", "months": "CIEL:1074", "weeks": "CIEL:1073", "days": "CIEL:1072"}


def stage_symptoms(symptoms: DataFrame) -> DataFrame:
    """All symptoms with lower-case names and decoded presence."""
    return symptoms.withColumns({"symptom": F.lower("symptom"), "symptom_present": decode_flag("result")})


def symptoms_obs(staged: DataFrame, encounters: DataFrame) -> DataFrame:
    """Symptom groups of version 3 intakes; comments on infections of version 3 follow-ups."""
    kinds = encounters.filter("form_version = '3'").select("source_encounter_id", "source_encounter_type")
    rows = staged.filter(F.col("symptom").isin([*SYMPTOMS, "sti", "other"])).join(kinds, "source_encounter_id")
    rows = coded_by(rows, "symptom", SYMPTOMS, "_ref")
    kind, symptom, comment = F.col("source_encounter_type"), F.col("symptom"), F.col("symptom_comment")
    timed = F.col("duration").isNotNull() & F.col("duration_unit").isNotNull()
    present = F.when(F.col("symptom_present"), TRUE).when(~F.col("symptom_present"), FALSE)
    return eav.emit(rows, "symptom", ["symptom_id"], "source_encounter_id", [
        eav.Group("CIEL:1727", [
            eav.coded("CIEL:1728", F.col("_ref"), comments=comment),
            eav.coded("CIEL:1728", "CIEL:5622", when=symptom == "other", comments=comment),
            eav.coded("CIEL:1729", present),
            eav.numeric("CIEL:1731", "duration", when=timed),
            eav.coded("CIEL:1732", filters.case_map("duration_unit", DURATION_UNITS), when=timed, keep_null=True),
        ], when=(kind == "intake") & (symptom != "sti")),
        eav.text("LOCAL:1374", comment, when=(kind == "followup") & (symptom == "sti")),
    ])


# ---- adherence, nutrition, family planning, helper


def adherence_obs(observations: DataFrame) -> DataFrame:
    """Missed doses, visits by the helper, and the reason for missed visits."""
    name, value = F.col("observation"), F.col("value")
    doses = F.trim("value")
    visited = F.when(value == "t", TRUE).otherwise(FALSE)
    at = F.col("entry_date")
    return eav.emit(observations, "adherence", ["source_observation_id"], "source_encounter_id", [
        eav.numeric("CIEL:160110", number_value(doses), when=(name == "num_doses_missed_last_month") & is_number(doses), at=at),
        eav.coded("CIEL:160111", visited, when=(name == "visted_by_accomp_daily_p") & value.isNotNull(), at=at),
        eav.text("LOCAL:13065", value, when=name == "accompagnateur_missed_visits_reason", keep_null=True, at=at),
    ])


def adherence_warnings(observations: DataFrame) -> DataFrame:
    bad = (F.col("observation") == "num_doses_missed_last_month") & ~is_number(F.trim("value"))
    return quality.warn(observations, "Num of doses not a valid number. Value not migrated.", encounter="source_encounter_id",
                        field="num_doses_missed_last_month", value="value", when=bad)


# Sentences for food aid by the set of flags.
NUTRITION_SENTENCES = {
    "receiving_nutritional_assistance_dry_ration": "A reçu de la ration sèche.",
    "receiving_nutritional_assistance_financial_aid": "A reçu de l’aide financière.",
    "receiving_nutritional_assistance_dry_ration,receiving_nutritional_assistance_financial_aid":
        "A reçu de la ration sèche et de l’aide financière.",
}


def nutrition_obs(observations: DataFrame) -> DataFrame:
    """Food aid as a coded fact, and its kinds as a sentence per encounter."""
    aid = eav.emit(observations, "nutrition", ["source_observation_id"], "source_encounter_id", [
        eav.coded("LOCAL:2156", "LOCAL:NUTRITIONAL AID", at=F.col("entry_date"),
                  when=(F.col("observation") == "receiving_nutritional_assistance_p") & (F.col("value") == "t")),
    ])
    kinds = ["receiving_nutritional_assistance_dry_ration", "receiving_nutritional_assistance_financial_aid"]
    ticked = observations.filter(F.col("observation").isin(kinds) & (F.col("value") == "t"))
    named = aggregates.string_agg(ticked, ["source_encounter_id"], "observation", "kinds", ",", distinct=True)
    first = ticked.groupBy("source_encounter_id").agg(F.min("entry_date").alias("entry_date"))
    sentence = filters.case_map("kinds", NUTRITION_SENTENCES)
    told = eav.emit(named.join(first, "source_encounter_id"), "nutrition_kinds", ["source_encounter_id"], "source_encounter_id",
                    [eav.text("LOCAL:SOCIO-ECONOMIC ASSISTANCE COMMENT", sentence, at=F.col("entry_date"))])
    return aid.unionByName(told)


# Family planning methods of both forms.
FOLLOWUP_METHODS = {
    "family_planning.condom": "LOCAL:CONDOMS", "family_planning.norplant": "LOCAL:NORPLANT",
    "family_planning.oral_contraceptive": "LOCAL:ORAL CONTRACEPTION",
}
INTAKE_METHODS = {
    "abstinence": "LOCAL:ABSTINENCE", "oral_contraceptive": "LOCAL:ORAL CONTRACEPTION",
    "depo_provera": "LOCAL:MEDROXYPROGESTERONE ACETATE", "condom": "LOCAL:CONDOMS", "norplant": "LOCAL:NORPLANT",
    "tubal_ligation": "LOCAL:TUBAL LIGATION", "vasectomy": "LOCAL:VASECTOMY", "no_family_planning": "LOCAL:NONE",
}
OTHER_METHODS = ["family_planning", "family_planning_other1", "family_planning_other2"]
METHOD_GROUP = "LOCAL:Family planning construct"


def family_planning_obs(observations: DataFrame, ordered: DataFrame) -> DataFrame:
    """Follow-up answers and methods, intake methods, and all other methods of an intake as one."""
    name, value = F.col("observation"), F.col("value")
    ticked = F.coalesce(value == "t", F.lit(False))
    other = name == "family_planning_other"
    abstinence = name == "family_planning.abstinence"
    free = "LOCAL:OTHER FAMILY PLANNING METHOD, NON-CODED"
    active = F.when(value == "t", YES).otherwise(NO)
    coded = filters.case_map(name, FOLLOWUP_METHODS)
    followup = eav.emit(observations, "family_planning", ["source_observation_id"], "source_encounter_id", [
        eav.coded("CIEL:160109", active, when=(name == "sexually_active_p") & value.isNotNull()),
        eav.text(free, value, when=other, keep_null=True),
        eav.text(free, F.lit("abstinence"), when=abstinence),
        eav.Group(METHOD_GROUP, [eav.coded("CIEL:374", coded)], when=coded.isNotNull() & ticked),
        eav.Group(METHOD_GROUP, [eav.coded("CIEL:374", "LOCAL:OTHER")], when=other | abstinence),
    ])
    any_method = observations.filter((name.startswith("family_planning.") & ticked) | other).select("source_encounter_id").distinct()
    some = eav.emit(any_method, "family_planning_any", ["source_encounter_id"], "source_encounter_id",
                    [eav.coded("CIEL:1382", YES)])
    method = filters.case_map("ordered", INTAKE_METHODS)
    intake = eav.emit(ordered, "planning", ["ordered_id"], "source_encounter_id",
                      [eav.Group(METHOD_GROUP, [eav.coded("LOCAL:METHOD OF FAMILY PLANNING", method)], when=method.isNotNull())])
    others = aggregates.string_agg(
        ordered.filter(F.col("ordered").isin(OTHER_METHODS)), ["source_encounter_id"], "comments", "listed", "; "
    )
    rest = eav.emit(others, "planning_other", ["source_encounter_id"], "source_encounter_id", [
        eav.Group(METHOD_GROUP, [eav.coded("LOCAL:METHOD OF FAMILY PLANNING", "LOCAL:OTHER")]),
        eav.text("LOCAL:FAMILY PLANNING COMMENT", "listed"),
    ])
    return followup.unionByName(some).unionByName(intake).unionByName(rest)


def helper_name_obs(patients: DataFrame, encounters: DataFrame) -> DataFrame:
    """The helper's name on the latest intake or follow-up of the patient (all of that day)."""
    visits = encounters.filter(F.col("source_encounter_type").isin(EXTRA_TYPES) & F.col("encounter_date").isNotNull()).select(
        "source_patient_id", "source_encounter_id", "encounter_date"
    )
    latest = aggregates.latest_per_key(visits, ["source_patient_id"], "encounter_date")
    rows = latest.join(patients.select("source_patient_id", "accompagnateur_name"), "source_patient_id")
    return eav.emit(rows, "helper", ["source_encounter_id"], "source_encounter_id", [eav.text("CIEL:164141", "accompagnateur_name")])
