"""Clinical stand-ins: the inputs of the jobs, derived by Spark from the given tables.

Each helper has an SQL twin that derives the same rows for the check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlift.functions.dates import day_text


def pick(column: str, choices: Sequence, mult: int = 1, div: int = 1) -> Column:
    """``choices[(column * mult div div) mod n]``."""
    index = F.expr(f"cast((({column} * {mult}) div {div}) % {len(choices)} AS int)")
    return F.element_at(F.array(*[F.lit(c) for c in choices]), index + 1)


def sql_literal(value) -> str:
    if value is None:
        return "NULL"
    return str(value) if isinstance(value, (int, float)) else "'" + value.replace("'", "''") + "'"


def pick_sql(column: str, choices: Sequence, mult: int = 1, div: int = 1) -> str:
    listed = ", ".join(sql_literal(c) for c in choices)
    return f"([{listed}])[({column} * {mult} // {div}) % {len(choices)} + 1]"


def day_after(start: str, days: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), days.cast("int"))


# ---- encounters from orders

FORM_VERSIONS = ["1", "2", "3"]


def encounters(t, kinds: Sequence) -> DataFrame:
    """Orders as encounters: customer, day, a type from ``kinds``, a form version, comments now and then."""
    return t.orders.select(
        F.col("o_orderkey").alias("source_encounter_id"), F.col("o_custkey").alias("source_patient_id"),
        pick("o_orderkey", kinds).alias("source_encounter_type"), pick("o_orderkey", FORM_VERSIONS, 1, 2).alias("form_version"),
        F.to_date("o_orderdate").alias("encounter_date"), F.to_date("o_orderdate").alias("date_created"),
        F.when(F.col("o_orderkey") % 6 == 0, F.col("o_orderpriority")).alias("comments"),
        F.when(F.col("o_orderkey") % 9 == 0, F.col("o_orderstatus")).alias("note_title"),
        (F.col("o_orderkey") % 7 + 1).cast("int").alias("location_id"),
    )


def encounters_sql(kinds: Sequence) -> str:
    return f"""enc AS (SELECT o_orderkey AS source_encounter_id, o_custkey AS source_patient_id, {pick_sql('o_orderkey', kinds)} AS source_encounter_type,
        {pick_sql('o_orderkey', FORM_VERSIONS, 1, 2)} AS form_version, o_orderdate::DATE AS encounter_date,
        CASE WHEN o_orderkey % 6 = 0 THEN o_orderpriority END AS comments, CASE WHEN o_orderkey % 9 = 0 THEN o_orderstatus END AS note_title,
        CAST(o_orderkey % 7 + 1 AS INTEGER) AS location_id FROM orders)"""


# ---- named observations from events


def observations(t, names: Sequence, values: Sequence) -> DataFrame:
    """Events as named observations: eight in a row belong to one encounter."""
    return t.events.select(
        F.col("event_id").alias("source_observation_id"), F.expr("event_id div 8").alias("source_encounter_id"),
        pick("event_id", names, 5, 3).alias("observation"), pick("event_id", values, 7, 2).alias("value"),
        F.to_date("ts").alias("entry_date"),
    )


def observations_sql(names: Sequence, values: Sequence, alias: str = "o") -> str:
    return f"""{alias} AS (SELECT event_id AS source_observation_id, event_id // 8 AS source_encounter_id, {pick_sql('event_id', names, 5, 3)} AS observation,
        {pick_sql('event_id', values, 7, 2)} AS value, ts::DATE AS entry_date FROM events)"""


def ordered_other(t, names: Sequence, values: Sequence) -> DataFrame:
    """Line items' orders as ordered items: from orders, four in a row belong to one encounter."""
    return t.orders.select(
        F.col("o_orderkey").alias("ordered_id"), F.expr("o_orderkey div 4").alias("source_encounter_id"),
        pick("o_orderkey", names, 5, 3).alias("ordered"), pick("o_orderkey", values, 7, 2).alias("comments"),
    )


def ordered_other_sql(names: Sequence, values: Sequence, alias: str = "w") -> str:
    return f"""{alias} AS (SELECT o_orderkey AS ordered_id, o_orderkey // 4 AS source_encounter_id, {pick_sql('o_orderkey', names, 5, 3)} AS ordered,
        {pick_sql('o_orderkey', values, 7, 2)} AS comments FROM orders)"""


def patient_ids(t) -> DataFrame:
    """Customers as patients whose person id is 5000 above the source id."""
    return t.customer.select(F.col("c_custkey").alias("source_patient_id"), (F.col("c_custkey") + 5000).alias("person_id"))


# ---- comparing observations


def obs_view(drafts: DataFrame) -> DataFrame:
    """Draft observations without their keys, dates as text."""
    return drafts.select(
        "source_encounter_id", "concept", "value_coded", "value_numeric", "value_text",
        day_text("value_datetime").alias("value_date"), "comments", F.col("group_key").isNotNull().alias("grouped"),
    )


def obs_sql(with_sql: str, parts: Sequence[tuple]) -> str:
    """UNION ALL over parts (table, concept, kind, value, where, grouped[, comments]).

    ``concept`` is a plain reference, or an expression if it starts with CASE; kind is coded, numeric,
    text, date or group.
    """
    kinds = {"coded": "VARCHAR", "numeric": "DOUBLE", "text": "VARCHAR", "date": "VARCHAR"}
    rows = []
    for part in parts:
        table, concept, kind, value, where, grouped = part[:6]
        comments = part[6] if len(part) > 6 else "NULL"
        concept_sql = concept if concept.startswith("CASE") else sql_literal(concept)
        cells = []
        for name, sql_type in kinds.items():
            own = value if kind == name else "NULL"
            if kind == "date" and name == "date":
                own = f"strftime({value}, '%Y-%m-%d')"
            cells.append(f"CAST({own} AS {sql_type}) AS value_{name}")
        rows.append(
            f"SELECT CAST(source_encounter_id AS BIGINT) AS source_encounter_id, {concept_sql} AS concept, {', '.join(cells)}, "
            f"CAST({comments} AS VARCHAR) AS comments, {str(grouped).lower()} AS grouped FROM {table} WHERE {where}"
        )
    return f"WITH {with_sql}\n" + "\nUNION ALL ".join(rows)


def case_sql(column: str, codes: dict) -> str:
    """A CASE over fixed codes, for checks of jobs whose input is a code table."""
    branches = " ".join(f"WHEN {column} = {sql_literal(k)} THEN {sql_literal(v)}" for k, v in codes.items())
    return f"CASE {branches} END"
