"""Facts read by declared shapes: which fields a fact has, how each is typed, and what could not be read."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlift.functions.clinical import parse_typed
from chartlift.plans.documents import ENCOUNTER, PATIENT

# Codes of findings; a value is the name of its code in any case.
BODY_SYSTEMS = ["LYMPH_NODES", "CONJUNCTIVA", "ABDOMINAL", "UROGENITAL", "SCLERAS", "EXTREMITIES", "GENERAL", "SKIN", "NEUROLOGIC", "OROPHARYNX", "CARDIOVASCULAR", "PULMONARY"]
CONDITIONS = [
    "NORMAL", "NONE", "PALE", "DISCHARGE", "CERVICAL", "CREPITANCE", "ULCERS", "INGINUAL", "EDEMA", "RALES", "ICTERIC", "AXILLARY", "WHEEZE", "ASCITES", "SPLENOMEGALY",
    "HEPATOMEGALY",
]
DURATION_UNITS = ["DAYS", "MONTHS", "WEEKS", "YEARS"]
INFECTIONS = [
    "ACUTE_DIARRHEA", "ANXIETY", "BACTERIAL_DIARRHEA", "BACTERIAL_MENINGITIS", "BACTERIAL_PNEUMONIA", "CANDIDIARIS_ESOPHAGITIS", "CANDIDIARIS_OROPHARYNGEAL", "CANDIDIARIS_OTHER",
    "CANDIDIARIS_VAGINAL", "CHANCROID", "CHRONIC_DIARRHEA", "CRYPTOCOCCUS_MENINGITIS", "DEPRESSION", "DIABETES", "DYSENTERY", "DYSPHAGIA", "ENCEPHALOPATHY", "EXTRAPULMONARY_TB",
    "GENITAL_ULCERATIONS", "GENITO_URINARY_SYPHILIS", "HERPES_ZOSTER", "HIV", "HSV", "HYPERTENSION", "KAPOSIS_SARCOMA", "LGV", "LYMPHOMA", "MALARIA", "MENINGITIS", "NEUROLOGIC_SYPHILIS",
    "NON_GENITO_URINARY_SYPHILIS", "NONE", "OTHER", "OTHER_DIARRHEA", "OTHER_ENCEPHALOPATHY", "OTHER_MENINGITIS", "OTHER_NEURO", "OTHER_PNEUMONIA", "OTHER_RASH", "PARASITIC_DIARRHEA",
    "PCP_PNEUMONIA", "PID", "PNEUMOPATHY", "PRURIGO_NODULAIRIS", "PRURITIS", "PSYCHOSIS", "PULMONARY_TB", "SEIZURES", "SHINGLES", "STD", "TB_ENTERITIS", "TB_MENINGITIS", "THRUSH",
    "TOXOPLASMOSIS", "TRICHOMONIASIS", "TUBERCULOMA", "TUBERCULOSIS", "TYPHOID", "VAGINAL_URETHRAL_DISCHARGE", "VAGINAL_URETHRAL_GC", "VAGINAL_URETHRAL_OTHER", "WARTS", "WASTING",
    "WEIGHT_LOSS",
]
SYMPTOMS = [
    "AUCUN", "BLOODY_DIARRHEA", "CEPHALGIA", "CHEST_PAIN", "CONFUSION", "CONVULSIONS", "COUGH", "DIARRHEA", "DIARRHEA_SHORT", "DRY_COUGH", "DYSPHAGIA", "DYSPNEA", "EYE_TROUBLE", "FATIGUE",
    "FEVER", "FOCAL_NEUROLOGICAL_DEFICIT", "GENITAL_DISCHARGE", "GENITAL_ULCERS", "HEADACHE", "HYMOPTUSIS", "ICTERUS", "JAUNDICE", "LOSS_OF_WEIGHT", "LYMPHADENOPATHY", "NAUSEA", "NEURO",
    "NEUROLOGIC_DEFICIT", "NIGHT_SWEATS", "OTHER", "PARESTHESIA", "PRODUCTIVE_COUGH", "PRURIGO_NODULARIS", "PRURITUS", "PURITUS", "RASH", "SEIZURES", "SHINGLES", "STI", "TB_CONTACT",
    "THRUSH", "VISION_PROBLEMS", "VOMITING",
]
WHO_CRITERIA = [
    "ACUTE_NECROTIZING_ULCERATIVE_STOMATITIS_GINGIVITIS_PERIODONTITIS", "ANGULAR_CHEILITIS", "ASYMPTOMATIC", "CANDIDIASIS_OF_ESOPHAGUS_TRACHEA_BRONCHI_LUNGS", "EXTRAPULMONARY_TB",
    "FUNGAL_NAIL_INFECTION", "HERPES_ZOSTER", "HIV_WASTING", "ORAL_HAIRY_LEUKOPLAKIA", "PAPULAR_PRURITIC_ERUPTIONS", "PERSISTENT_GENERALIZED_LYMPHADENOPATHY",
    "PERSISTENT_ORAL_CANDIDIASIS", "PNEUMOCYSTIS_PNEUMONIA", "PULMONARY_TUBERCULOSIS_CURRENT", "RECURRENT_ORAL_ULCERATION", "RECURRENT_SEVERE_BACTERIAL_PNEUMONIA",
    "RECURRENT_UPPER_RESPITORY_INFECTIONS", "SEBORRHOEIC_DERMATITIS", "SEVERE_BACTERIAL_INFECTIONS", "UNEXPLAINED_ANAEMIA_NEUTROPAENIA_THROMBOCYTOPAENIA_OVER_1_MONTH",
    "UNEXPLAINED_CHRONIC_DIARRHEA_OVER_1_MONTH", "UNEXPLAINED_PERSISTENT_FEVRE", "UNEXPLAINED_WEIGHT_LOSS_OVER_10_PERCENT", "UNEXPLAINED_WEIGHT_LOSS_UNDER_10_PERCENT",
]
LAB_TESTS = [
    "ABDOMINAL_ULTRASOUND", "BIOCHEMISTRY", "BLOOD_GLUCOSE", "BLOOD_TYPE", "BUN", "CD4", "CD4_PERCENT", "CHEST_XRAY", "CHOLESTEROL", "CREATININE", "CULTURE", "CXR", "CXR0", "CXR1", "CXR2",
    "CYTOLOGY", "DST", "ELISA", "ESR", "GLUCOSE", "ERYTH_SED_RATE", "HANGING_DROP", "HEMATOCRIT", "HEMOGLOBIN", "MALARIA_SMEAR", "NONE", "OTHER", "OTHER1", "OTHER2", "OTHER3",
    "OTHER_RADIOLOGY", "OTHER_STD", "OTHER_TEST", "PLATELETS", "PPD", "PREGNANCY_TEST", "RPR", "SGOT", "SGOT_AST", "SGPT", "SGPT_ALT", "SMEAR", "SMEAR1", "SMEAR2", "SMEAR3", "SPUTUM", "STOOL",
    "TB_SMEAR", "TOT_LYMPH_COUNT", "TOT_LYMPH_COUNT_PERCENT", "TR", "UREA", "URINALYSIS", "VAGINAL_SMEAR", "VIRAL_LOAD", "WESTERN_BLOT", "WHITE_BLOOD_COUNT",
]
LAB_TEST_SYNONYMS = {"hematocrite": "HEMATOCRIT"}


@dataclass(frozen=True)
class Field:
    """A field of a fact: its type (``int``, ``double``, ``date``, ``boolean``, ``string``), or the codes it may take.

    With ``free`` a value that is no code is kept as text in ``<name>_other``; without, it is reported.
    """

    name: str
    kind: str = "string"
    source: str | None = None
    codes: Sequence[str] = ()
    free: bool = False
    synonyms: tuple[tuple[str, str], ...] = ()

    @property
    def raw(self) -> Column:
        return F.col(self.source or self.name).cast("string")

    def read(self) -> Column:
        if not self.codes:
            return parse_typed(self.raw, self.kind, strict=False)
        name = F.upper(self.raw)
        code = F.when(name.isin(list(self.codes)), name)
        for word, meant in self.synonyms:
            code = F.when(name == word.upper(), F.lit(meant)).otherwise(code)
        return code


def read_facts(rows: DataFrame, key: str, fields: Sequence[Field], strict: bool = False) -> DataFrame:
    """The key, one typed column per field, and ``unread``: fields and values that fit no type or code (null without any).

    Nothing drops out: a row with an unreadable value is a fact with that field null. With ``strict`` such a row
    raises when the result is read. All of it is one projection; no row moves.
    """
    columns, problems = [], []
    for field in fields:
        value = field.read()
        columns.append(value.alias(field.name))
        missed = field.raw.isNotNull() & value.isNull()
        if field.free:
            columns.append(F.when(missed, field.raw).alias(f"{field.name}_other"))
        elif field.codes or field.kind != "string":
            problems.append(F.when(missed, F.concat(F.lit(f"{field.name}: "), field.raw)))
    listed = F.concat_ws("; ", *problems) if problems else F.lit("")
    unread = F.when(listed != "", listed)
    if strict:
        unread = F.when(unread.isNotNull(), F.raise_error(F.concat(F.lit("cannot read "), unread)).cast("string"))
    return rows.select(key, *columns, unread.alias("unread"))


PREGNANCY = (
    Field("pregnancy_id", "int"), Field("last_period_date", "date"), Field("expected_delivery_date", "date"), Field("gravidity", "int"), Field("parity", "int"),
    Field("num_abortions", "int"), Field("num_living_children", "int"), Field("family_planning_method"), Field("post_outcome_family_planning"), Field("comments"), Field("outcome"),
    Field("outcome_date", "date"), Field("outcome_location"), Field("outcome_method"),
)
CONTACT = (
    Field("contact_name"), Field("relationship"), Field("birth_date", "date"), Field("age", "int"), Field("hiv_status"), Field("followed_in_clinic", "boolean", "clinic_p"),
    Field("clinic_name"), Field("referred_for_test", "boolean", "referred_tr_p"), Field("referral_clinic", source="referred_clinic"), Field("deceased", "boolean", "deceased_p"),
)
POSTNATAL = (
    Field("encounter_date", "date"), Field("entered_by"), Field("pregnancy_id", "int"), Field("child_test_type", source="child_serostatus_test"),
    Field("child_test_result", source="child_serostatus_result"), Field("child_status"),
)
SYSTEM_STATUS = (Field("system", codes=BODY_SYSTEMS), Field("condition", codes=CONDITIONS))
INFECTION = (Field("oi", codes=INFECTIONS), Field("comments"))
WHO_CRITERION = (Field("criterium", codes=WHO_CRITERIA),)
SYMPTOM = (
    Field("symptom", codes=SYMPTOMS, free=True), Field("present", "boolean", "result"), Field("symptom_date", "date"), Field("duration", "int"),
    Field("duration_unit", codes=DURATION_UNITS), Field("symptom_comment"),
)
LAB_ORDER = (Field("test", codes=LAB_TESTS, synonyms=tuple(LAB_TEST_SYNONYMS.items())), Field("test_other"))


def pregnancy_facts(pregnancies: DataFrame) -> DataFrame:
    return read_facts(pregnancies, PATIENT, PREGNANCY)


def contact_facts(contacts: DataFrame) -> DataFrame:
    return read_facts(contacts, PATIENT, CONTACT)


def postnatal_facts(encounters: DataFrame, exams: DataFrame) -> DataFrame:
    """The infants' follow-up encounters with their exams, if they have any, at an unspecified place."""
    visits = encounters.filter(F.col("source_encounter_type") == "infant_followup").select(PATIENT, ENCOUNTER, "encounter_date", "entered_by")
    return read_facts(visits.join(exams, ENCOUNTER, "left"), PATIENT, POSTNATAL).withColumn("location", F.lit("Unspecified"))


def system_status_facts(statuses: DataFrame) -> DataFrame:
    return read_facts(statuses, ENCOUNTER, SYSTEM_STATUS)


def infection_facts(infections: DataFrame) -> DataFrame:
    return read_facts(infections, ENCOUNTER, INFECTION)


def who_criterion_facts(criteria: DataFrame) -> DataFrame:
    return read_facts(criteria, ENCOUNTER, WHO_CRITERION)


def symptom_facts(symptoms: DataFrame) -> DataFrame:
    return read_facts(symptoms, ENCOUNTER, SYMPTOM)


def lab_order_facts(orders: DataFrame) -> DataFrame:
    return read_facts(orders, ENCOUNTER, LAB_ORDER)
