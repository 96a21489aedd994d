"""Drug orders from regimens, and comments on regimens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlift.functions import dates, text
from chartlift.functions.columns import blank_to_null
from chartlift.functions.dates import as_of_column
from chartlift.functions.ids import uuid_name
from chartlift.operators import joins, quality
from chartlift.runtime import settle

DRUG_ORDER_TYPE = "drug order"
OTHER_CONCEPT = "3cee7fb4-26fe-102b-80cb-0017a47871b2"

# Reason of a new order by product type and regimen type (None matches a missing type).
NEW_ORDER_REASONS = [
    ("HIV", None, "138405AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"),
    ("HIV", "accident", "163768AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"),
    ("HIV", "prophylaxis", "163768AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"),
    ("HIV", "prophylaxis_rape", "163768AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"),
    ("HIV", "prophylaxis_sexual_exposure", "163768AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"),
    ("HIV", "ptme", "160538AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"),
    ("TB", "ptme", "3ccca7cc-26fe-102b-80cb-0017a47871b2"),
    ("TB", None, "3ccca7cc-26fe-102b-80cb-0017a47871b2"),
]

# Reason of a discontinued order by closure reason: concept, or free text where there is none.
CLOSURE_REASONS = [
    ("abandoned", "3cdd5176-26fe-102b-80cb-0017a47871b2", None),
    ("cd4_augmented", None, "CD4 augmenté"),
    ("compliance", "159598AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA", None),
    ("died", "3cdd446a-26fe-102b-80cb-0017a47871b2", None),
    ("dose_change", "981AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA", None),
    ("finished_prophylaxis", None, "Prophylaxie complété"),
    ("finished_ptme", "3cd91b56-26fe-102b-80cb-0017a47871b2", None),
    ("finished_treatment", "3cdcecea-26fe-102b-80cb-0017a47871b2", None),
    ("formulation_change", "981AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA", None),
    ("ineffective", "3cd49432-26fe-102b-80cb-0017a47871b2", None),
    ("lost", "3cdd5176-26fe-102b-80cb-0017a47871b2", None),
    ("moved_in_haiti_txfer", None, "Déplacé à l'interieur du pays"),
    ("moved_out_haiti_txfe", None, "Déplacé à l'extérieur du pays"),
    ("other", "3cee7fb4-26fe-102b-80cb-0017a47871b2", None),
    ("pregnancy", "3cdd8132-26fe-102b-80cb-0017a47871b2", None),
    ("prev_undoc_txfer_con", None, "Transfert précédemment non documenté, confirmé"),
    ("prev_undoc_txfer_not", None, "Transfert précédemment non documenté, non confirmé"),
    ("refused_return_to_tr", "efab937b-853e-47da-b97e-220f1bdff97d", None),
    ("resistant", None, "Résistant"),
    ("side_effect", "3cccecdc-26fe-102b-80cb-0017a47871b2", None),
    ("stock_out", "3cde143a-26fe-102b-80cb-0017a47871b2", None),
    ("tb", None, "Tuberculose"),
    ("traced_not_found", None, "Recherché, non retrouvé"),
    ("transferred_out", "3cdd5c02-26fe-102b-80cb-0017a47871b2", None),
    ("treatment_refused", "efab937b-853e-47da-b97e-220f1bdff97d", None),
    ("treatment_stopped_ot", "3cdc0d7a-26fe-102b-80cb-0017a47871b2", None),
    ("tx_stop_side_effects", "3cccecdc-26fe-102b-80cb-0017a47871b2", None),
    (None, "3cd743f8-26fe-102b-80cb-0017a47871b2", None),
]


def clean_regimens(regimens: DataFrame, as_of) -> DataFrame:
    """Close dates never before the start; a close date in the future becomes the end date."""
    close, start, today = F.to_date("close_date"), F.to_date("start_date"), as_of_column(as_of)
    future = close > today
    cleaned_close = F.when(future, F.lit(None)).when(close < start, start).otherwise(close)
    return regimens.withColumns({
        "cleaned_close_date": cleaned_close,
        "cleaned_end_date": F.when(future, close).otherwise(F.to_date("end_date")),
    })


def regimen_warnings(regimens: DataFrame, patients: DataFrame, as_of) -> DataFrame:
    rows = regimens.join(patients.select("source_patient_id", "person_id"), "source_patient_id")
    close, start = F.to_date("close_date"), F.to_date("start_date")
    details = F.concat(F.lit("Drug: "), "product_name", F.lit("; Start Date: "), dates.day_text(start),
                       F.lit("; Close Date: "), dates.day_text(close))
    about = {"patient": "person_id", "encounter": "encounter_opened_by", "field": "close_date",
             "value": dates.day_text(close), "details": details}
    return quality.all_warnings(
        quality.warn(rows, "Drug Order Close Date is before Start Date.  Setting to equal Start Date.", when=close < start, **about),
        quality.warn(rows, "Drug Order Close Date is in the future.  Reclassifying this as Auto-Expire Date.",
                     when=close > as_of_column(as_of), **about),
    )


def unmapped_drug_warnings(regimens: DataFrame, patients: DataFrame, product_map: DataFrame) -> DataFrame:
    """Regimens whose product is mapped to the catch-all concept."""
    other = product_map.filter(F.col("concept") == OTHER_CONCEPT).select("product_name")
    rows = regimens.join(other, "product_name", "left_semi").join(patients.select("source_patient_id", "person_id"), "source_patient_id")
    details = F.concat(F.lit("Drug: "), "product_name", F.lit(" is mapped to other non-coded concept"))
    return quality.warn(rows, "Missing concept mapping for drug", patient="person_id", field="concept",
                        value=F.lit(OTHER_CONCEPT), details=details, flag=False)


def _reason_chain(pairs: list[tuple[Column, str | None]]) -> Column:
    chain = None
    for condition, value in pairs:
        branch = F.lit(value).cast("string")
        chain = F.when(condition, branch) if chain is None else chain.when(condition, branch)
    return chain


# Fixed values of the order tables.
OUTPATIENT = "6f0c9a92-6f24-11e3-af88-005056821db0"  # the care setting's uuid
FREE_TEXT_DOSING = "org.openmrs.FreeTextDosingInstructions"
ORDERER = "f9badd80-ab76-11e2-9e96-0800200c9a66"  # the uuid of the unknown provider


def drug_orders(
    regimens: DataFrame, encounters: DataFrame, patients: DataFrame, product_map: DataFrame, as_of,
    number_prefix: str = "REGIMEN-",
) -> DataFrame:
    """A NEW order per regimen, and a DISCONTINUE order for each that was closed.

    ``encounters``: source_encounter_id, encounter_id. ``product_map``: product_name, concept, drug,
    drug_concept (the concept of a coded drug). Orders without an encounter join one of the same patient
    whose activation date is theirs (lowest id), else share a new encounter per patient and date, named by
    ``new_encounter_uuid``.
    """
    cleaned = clean_regimens(regimens, as_of)
    visit_ids = encounters.groupBy("source_encounter_id").agg(F.min("encounter_id").alias("encounter_id"))
    with_patient = cleaned.join(
        patients.select("source_patient_id", F.col("person_id").alias("patient_id")), "source_patient_id"
    )
    opened = visit_ids.select(F.col("source_encounter_id").alias("encounter_opened_by"), F.col("encounter_id").alias("_opened"))
    closed = visit_ids.select(F.col("source_encounter_id").alias("encounter_closed_by"), F.col("encounter_id").alias("_closed"))
    located = joins.attach(with_patient, opened, ["encounter_opened_by"], "left")
    located = joins.attach(located, closed, ["encounter_closed_by"], "left")

    products = product_map.groupBy("product_name").agg(
        F.min("concept").alias("_concept"), F.min("drug").alias("_drug"), F.min("drug_concept").alias("_drug_concept"),
        F.lit(True).alias("_mapped"),
    )
    located = joins.attach(located, products, ["product_name"], "left")

    stopped = F.col("cleaned_close_date")
    actions = F.explode(F.array(
        F.struct(F.lit("NEW").alias("action"), F.col("_opened").alias("encounter_id"), F.to_date("start_date").alias("start_date"),
                 F.col("cleaned_end_date").alias("auto_expire_date"), stopped.alias("date_stopped")),
        F.when(stopped.isNotNull(), F.struct(
            F.lit("DISCONTINUE").alias("action"), F.col("_closed").alias("encounter_id"), stopped.alias("start_date"),
            stopped.alias("auto_expire_date"), F.lit(None).cast("date").alias("date_stopped"))),
    ))
    drug = blank_to_null("_drug")
    product_type, regime_type, closure = F.col("product_type"), F.col("regime_type"), F.col("reason_for_closure")
    new_reason = _reason_chain([
        ((product_type == p) & (regime_type.eqNullSafe(F.lit(r))), c) for p, r, c in NEW_ORDER_REASONS
    ])
    closing = _reason_chain([(closure.eqNullSafe(F.lit(r)), c) for r, c, _ in CLOSURE_REASONS])
    closing_text = _reason_chain([(closure.eqNullSafe(F.lit(r)), t) for r, _, t in CLOSURE_REASONS])
    dosing = text.dosing_text("ddd", "dwd", {
        "morning": F.col("morning_dose"), "noon": F.col("noon_dose"), "evening": F.col("evening_dose"), "night": F.col("night_dose"),
    })
    orders = located.withColumn("_o", actions).filter(F.col("_o").isNotNull()).select(
        "source_regime_id", "patient_id", F.col("_o.action").alias("order_action"), F.col("_o.encounter_id").alias("encounter_id"),
        F.col("_o.start_date").alias("start_date"), F.col("_o.auto_expire_date").alias("auto_expire_date"),
        F.col("_o.date_stopped").alias("date_stopped"),
        drug.alias("drug"), F.when(drug.isNull() & F.col("_mapped"), F.col("product_name")).alias("drug_non_coded"),
        F.when(drug.isNotNull(), F.col("_drug_concept")).otherwise(F.col("_concept")).alias("concept"),
        F.when(F.col("_o.action") == "NEW", new_reason).otherwise(closing).alias("order_reason"),
        F.when(F.col("_o.action") == "DISCONTINUE", closing_text).alias("order_reason_non_coded"),
        F.coalesce("prn", F.lit(False)).alias("as_needed"), dosing.alias("dosing_instructions"),
    )
    key = F.concat_ws("/", "source_regime_id", "order_action")
    # the encounter of an order depends on the orders around it: they are read four times below
    orders = settle(orders)
    with_encounter = orders.filter(F.col("encounter_id").isNotNull())
    by_encounter = with_encounter.groupBy("encounter_id").agg(F.min("start_date").alias("_first"))
    # orders without an encounter take no part in the join: their null key would be one hot key
    without = orders.filter(F.col("encounter_id").isNull()).withColumn("_first", F.lit(None).cast("date"))
    dated = joins.attach(with_encounter, by_encounter, ["encounter_id"]).unionByName(without)
    dated = dated.withColumn("date_activated", F.coalesce("_first", "start_date")).drop("_first")
    dated = dated.withColumn(
        "urgency", F.when(F.col("date_activated") == F.col("start_date"), "ROUTINE").otherwise("ON_SCHEDULED_DATE")
    )
    on = ["patient_id", "date_activated"]
    offered = dated.filter(F.col("encounter_id").isNotNull()).groupBy(*on).agg(F.min("encounter_id").alias("_offered"))
    matched = joins.attach(dated, offered, on, "left")
    encounter = F.coalesce("encounter_id", "_offered")
    fresh = F.concat_ws("/", "patient_id", dates.day_text("date_activated"))
    # ids made of the order's own columns come last: no join carries them
    return matched.withColumns({
        "order_uuid": uuid_name("drug_order", key),
        "previous_order_uuid": F.when(F.col("order_action") == "DISCONTINUE",
                                      uuid_name("drug_order", F.concat_ws("/", "source_regime_id", F.lit("NEW")))),
        "order_number": F.concat(F.lit(number_prefix), F.col("source_regime_id").cast("string")),
        "encounter_id": encounter,
        "new_encounter_uuid": F.when(encounter.isNull(), uuid_name("drug_order_encounter", fresh)),
        "scheduled_date": F.when(F.col("urgency") == "ON_SCHEDULED_DATE", F.col("start_date")),
        "orderer": F.lit(ORDERER), "voided": F.lit(False), "care_setting": F.lit(OUTPATIENT), "dosing_type": F.lit(FREE_TEXT_DOSING),
    }).drop("_offered")


def new_encounters(orders: DataFrame) -> DataFrame:
    """One encounter per patient and activation date of the orders that found none."""
    return orders.filter(F.col("new_encounter_uuid").isNotNull()).groupBy("new_encounter_uuid").agg(
        F.min("patient_id").alias("patient_id"), F.min("date_activated").alias("encounter_datetime"),
        F.count(F.lit(1)).alias("orders"),
    )


def redate_encounters(encounters: DataFrame, orders: DataFrame) -> DataFrame:
    """Drug-order encounters moved to the activation date of their orders; those without orders go."""
    activated = orders.filter(F.col("encounter_id").isNotNull()).groupBy("encounter_id").agg(F.min("date_activated").alias("_at"))
    is_drug_order = F.col("encounter_type") == DRUG_ORDER_TYPE
    joined = encounters.join(activated, "encounter_id", "left")
    kept = joined.filter(~is_drug_order | F.col("_at").isNotNull())
    at = F.when(is_drug_order, F.col("_at")).otherwise(F.to_date("encounter_datetime"))
    return kept.withColumn("encounter_datetime", at).drop("_at")


def order_rules(
    orders: DataFrame, encounters: DataFrame, regimens: DataFrame, as_of, source: DataFrame, drugs: DataFrame
) -> DataFrame:
    """The validation rules of the order tables as (rule, expected, actual, passed).

    ``source``: the regimens before staging. ``drugs``: the target's dictionary (drug, drug_concept). The rules over orders are
    one aggregate over all; the counts of the other tables are one aggregate each.
    """
    orders = joins.lookup(orders, drugs, "drug", "drug", "drug_concept", "_drug_concept")
    has_visit = F.col("encounter_id").isNotNull() | F.col("new_encounter_uuid").isNotNull()
    discontinue = F.col("order_action") == "DISCONTINUE"
    scheduled = F.col("urgency") == "ON_SCHEDULED_DATE"
    coded, free = F.col("drug").isNotNull(), F.col("drug_non_coded").isNotNull()
    no_rows = {
        "All discontinue orders must have a previous order id": discontinue & F.col("previous_order_uuid").isNull(),
        "All discontinue orders should have an order reason (coded or non-coded)":
            discontinue & F.col("order_reason").isNull() & F.col("order_reason_non_coded").isNull(),
        "All orders must have non-null voided": F.col("voided").isNull(),
        "All orders must have non-null concept": F.col("concept").isNull(),
        "All orders must have non-null patient": F.col("patient_id").isNull(),
        "All orders must have non-null encounter": ~has_visit,
        "All orders must have non-null orderer": F.col("orderer").isNull(),
        "All orders must have non-null urgency": F.col("urgency").isNull(),
        "All orders must have non-null action": F.col("order_action").isNull(),
        "No orders can have date activated in the future": F.col("date_activated") > as_of_column(as_of),
        "No orders can have date activated after date stopped": F.col("date_activated") > F.col("date_stopped"),
        "No orders can have date activated after auto expire date": F.col("date_activated") > F.col("auto_expire_date"),
        "No orders can have a scheduled date unless urgency is on scheduled date": F.col("scheduled_date").isNotNull() & ~scheduled,
        "No orders can have an urgency of on scheduled date if scheduled date is null": F.col("scheduled_date").isNull() & scheduled,
        "All rows must have a non-null as_needed": F.col("as_needed").isNull(),
        "Dosing type is required if action != DISCONTINUE": ~discontinue & F.col("dosing_type").isNull(),
        "Concept associated with drug must not have a different concept than the one associated with the order":
            F.col("_drug_concept") != F.col("concept"),
        "No drug orders should have both a coded and non-coded drug": coded & free,
        "Non-discontinue orders with free text dosing instructions must have non-null dosing instructions":
            ~discontinue & F.col("dosing_instructions").isNull(),
    }
    all_rows = {
        "All drug orders must have a coded or non-coded drug": coded | free,
        "All orders must be routine or scheduled":
            (~scheduled & F.col("scheduled_date").isNull()) | (scheduled & (F.col("scheduled_date") > F.col("date_activated"))),
        "All rows are outpatient": F.col("care_setting") == OUTPATIENT,
    }
    # Rules over an order alone are judged before the join with the encounters, which carries one array of their answers.
    own = [*no_rows, *all_rows]
    answers = F.array(*[F.coalesce(c, F.lit(False)) for c in (*no_rows.values(), *all_rows.values())])
    # Orders without an encounter match nothing; a key of their own keeps them from being one hot key.
    apart = F.when(F.col("encounter_id").isNull(), F.xxhash64("patient_id", "date_activated")).otherwise(F.lit(0))
    judged = orders.select("encounter_id", apart.alias("_apart"), "patient_id", "date_activated",
                           F.col("new_encounter_uuid").isNotNull().alias("_new"), answers.alias("_answers"))
    visit = encounters.select("encounter_id", F.lit(0).cast("long").alias("_apart"), F.col("patient_id").alias("_visit_patient"),
                              F.to_date("encounter_datetime").alias("_visit_date"))
    rows = judged.join(visit, ["encounter_id", "_apart"], "left")
    answer = {rule: F.get("_answers", F.lit(i)) for i, rule in enumerate(own)}
    no_rows, all_rows = {rule: answer[rule] for rule in no_rows}, {rule: answer[rule] for rule in all_rows}
    all_rows |= {
        "All orders must have the same patient in the order and the encounter":
            F.col("_new") | (F.col("patient_id") == F.col("_visit_patient")),
        "All orders must have date activated on or after encounter date":
            F.col("_new") | (F.col("date_activated") >= F.col("_visit_date")),
    }
    new_orders = orders.filter("order_action = 'NEW'")
    loaded = quality.assert_counts_match("All data from source should be loaded into staging table", source, regimens)
    counts = quality.assert_counts_match("There should be a new order for all regimes", regimens, new_orders)
    return quality.check_rules(rows, no_rows, all_rows).unionByName(loaded).unionByName(counts)


def discontinue_set_differences(orders: DataFrame, regimens: DataFrame, patients: DataFrame, as_of) -> DataFrame:
    """Patients with a closed regimen but no DISCONTINUE order, or the other way round."""
    from chartlift.operators.aggregates import set_difference_both

    closed = regimens.filter(F.to_date("close_date") <= as_of_column(as_of)).join(
        patients.select("source_patient_id", F.col("person_id").alias("patient_id")), "source_patient_id"
    )
    return set_difference_both(closed, orders.filter("order_action = 'DISCONTINUE'"), "patient_id")


def regimen_comments(comments: DataFrame, encounters: DataFrame, patients: DataFrame, user_ids: DataFrame) -> DataFrame:
    """Comments as observations on the patient's drug-order encounter of that day (lowest id), else on a new
    encounter per patient and day, named by ``new_encounter_uuid``."""
    day = F.to_date("entered_date")
    rows = comments.join(
        patients.select("source_patient_id", F.col("person_id").alias("patient_id")), "source_patient_id"
    ).withColumn("day", day)
    users = user_ids.select(F.col("source_user_id").alias("entered_by"), "user_id")
    same_day = encounters.filter(F.col("encounter_type") == DRUG_ORDER_TYPE).groupBy(
        "patient_id", F.to_date("encounter_datetime").alias("day")
    ).agg(F.min("encounter_id").alias("encounter_id"))
    linked = joins.attach(rows.join(users, "entered_by", "left"), same_day, ["patient_id", "day"], "left")
    fresh = uuid_name("comment_encounter", F.concat_ws("/", "patient_id", dates.day_text("day")))
    return linked.select(
        "comment_id", "patient_id", "day", "encounter_id", F.when(F.col("encounter_id").isNull(), fresh).alias("new_encounter_uuid"),
        F.lit("LOCAL:10637").alias("concept"), F.col("comments").alias("value_text"),
        F.coalesce("user_id", F.lit(1)).alias("creator"),
    )


def comment_rules(obs: DataFrame, comments: DataFrame) -> DataFrame:
    counts = quality.assert_counts_match("There should be an Obs for each comment", comments, obs)
    return quality.check_rules(obs, {
        "All obs should be associated with an encounter": F.col("encounter_id").isNull() & F.col("new_encounter_uuid").isNull(),
        "All obs should have obs value_text": F.col("value_text").isNull() | (F.col("value_text") == ""),
    }).unionByName(counts)
