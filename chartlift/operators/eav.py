"""Wide rows to observations, observations to wide rows.

A draft observation carries concepts as references: a mapping ``SOURCE:CODE`` or a UUID. Its key is text
built from the job, the source row and the fact, so parents and children are linked without a numbering
pass; numbers are given once, at the sink.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlift.functions.columns import ColumnLike, as_column
from chartlift.functions.ids import uuid_name
from chartlift.operators.joins import attach
from chartlift.operators.keys import assign_ids, next_id

DRAFT_TYPES = {
    "obs_key": "string",
    "group_key": "string",
    "source_encounter_id": "long",
    "obs_datetime": "timestamp",
    "concept": "string",
    "value_coded": "string",
    "value_drug": "string",
    "value_datetime": "timestamp",
    "value_numeric": "double",
    "value_text": "string",
    "comments": "string",
    "accession_number": "string",
}
VALUE_COLUMNS = ["value_coded", "value_drug", "value_datetime", "value_numeric", "value_text"]
KINDS = {"coded": "value_coded", "drug": "value_drug", "datetime": "value_datetime",
         "numeric": "value_numeric", "text": "value_text"}


@dataclass(frozen=True)
class Fact:
    """One observation that a row may give: emitted when its value is present and ``when`` holds."""

    concept: ColumnLike
    kind: str
    value: Column
    when: Column | None = None
    at: Column | None = None
    comments: Column | None = None
    accession: Column | None = None
    answer: Column | None = None  # the coded answer that goes with a drug
    keep_null: bool = False
    tag: str = ""


@dataclass(frozen=True)
class Group:
    """A parent observation with its children; emitted when ``when`` holds."""

    concept: ColumnLike
    children: Sequence[Fact] = field(default_factory=tuple)
    when: Column | None = None
    at: Column | None = None
    any_child: bool = False  # emit the parent only if a child is emitted
    tag: str = ""


def coded(concept: ColumnLike, value: ColumnLike | str, **options) -> Fact:
    """A coded fact; a text value is a fixed answer."""
    return Fact(concept, "coded", F.lit(value) if isinstance(value, str) else value, **options)


def numeric(concept: ColumnLike, column: ColumnLike, **options) -> Fact:
    return Fact(concept, "numeric", as_column(column), **options)


def text(concept: ColumnLike, column: ColumnLike, **options) -> Fact:
    return Fact(concept, "text", as_column(column), **options)


def datetime(concept: ColumnLike, column: ColumnLike, **options) -> Fact:
    return Fact(concept, "datetime", as_column(column), **options)


def _true(*conditions: Column | None) -> Column:
    result = None
    for condition in conditions:
        if condition is not None:
            sure = F.coalesce(condition, F.lit(False))
            result = sure if result is None else result & sure
    return F.lit(True) if result is None else result


def _fact_condition(fact: Fact) -> Column:
    present = None if fact.keep_null else fact.value.isNotNull()
    return _true(present, fact.when)


@dataclass(frozen=True)
class _Candidate:
    """An observation that a row may give: when, under which name and parent, and its columns."""

    condition: Column
    name: str
    parent: str | None
    concept: ColumnLike
    columns: dict[str, Column]


def _fact_candidate(fact: Fact, condition: Column, name: str, parent: str | None) -> _Candidate:
    columns = {KINDS[fact.kind]: fact.value, "obs_datetime": fact.at, "comments": fact.comments,
               "accession_number": fact.accession}
    if fact.answer is not None:
        columns["value_coded"] = fact.answer
    return _Candidate(condition, name, parent, fact.concept, {n: c for n, c in columns.items() if c is not None})


def _candidates(items: Sequence[Fact | Group]) -> list[_Candidate]:
    found = []
    for i, item in enumerate(items):
        name = item.tag or str(i)
        if isinstance(item, Fact):
            found.append(_fact_candidate(item, _fact_condition(item), name, None))
            continue
        conditions = [_true(item.when, _fact_condition(child)) for child in item.children]
        emitted = _true(item.when)
        if item.any_child:
            emitted = emitted & reduce(lambda a, b: a | b, conditions)
        at = {} if item.at is None else {"obs_datetime": item.at}
        found.append(_Candidate(emitted, name, None, item.concept, at))
        for j, (child, condition) in enumerate(zip(item.children, conditions)):
            found.append(_fact_candidate(child, condition, f"{name}/{child.tag or j}", name))
    return found


def explode_present(df: DataFrame, structs: Sequence[Column], keep: Sequence[str] = ()) -> DataFrame:
    """One row per struct that is not null. The structs are dropped after the explode, not inside the array:
    that keeps the whole expression in generated code, where a lambda over the array would not be."""
    exploded = df.select(*keep, F.explode(F.array(*structs)).alias("_item"))
    return exploded.filter(F.col("_item").isNotNull()).select(*keep, "_item.*")


def emit(
    df: DataFrame, job: str, key: Sequence[ColumnLike], encounter: ColumnLike, items: Sequence[Fact | Group]
) -> DataFrame:
    """One scan of wide rows to draft observations, groups with their children included.

    Each row is repeated for the candidates whose condition holds, by number; the columns are then chosen by
    that number, so only what is emitted is computed.
    """
    candidates = _candidates(items)
    turn = F.col("_turn")

    def fixed(values: Sequence[str | None]) -> Column:
        """The text of the candidate whose turn it is."""
        return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), turn + 1)

    def chosen(name: str) -> Column:
        """The column of the candidate whose turn it is; most candidates fill one or two columns."""
        chain = None
        for i, candidate in enumerate(candidates):
            value = candidate.columns.get(name)
            if value is not None:
                chain = F.when(turn == i, value) if chain is None else chain.when(turn == i, value)
        return F.lit(None) if chain is None else chain

    def concept() -> Column:
        plain = fixed([c.concept if isinstance(c.concept, str) else None for c in candidates])
        chain = None
        for i, candidate in enumerate(candidates):
            if not isinstance(candidate.concept, str):
                chain = F.when(turn == i, candidate.concept) if chain is None else chain.when(turn == i, candidate.concept)
        return plain if chain is None else F.coalesce(chain, plain)

    row = F.concat_ws("/", F.lit(job), *[F.coalesce(as_column(k).cast("string"), F.lit("")) for k in key])
    turns = F.array(*[F.when(c.condition, F.lit(i)) for i, c in enumerate(candidates)])
    columns = {
        "obs_key": F.concat(row, F.lit("/"), fixed([c.name for c in candidates])),
        "group_key": F.concat(row, F.lit("/"), fixed([c.parent for c in candidates])),
        "source_encounter_id": as_column(encounter),
        "concept": concept(),
    }
    emitted = df.withColumn("_turn", F.explode(turns)).filter(turn.isNotNull())
    return emitted.select(*[columns.get(n, chosen(n)).cast(kind).alias(n) for n, kind in DRAFT_TYPES.items()])


def emit_obs(df: DataFrame, job: str, key: Sequence[ColumnLike], encounter: ColumnLike, facts: Sequence[Fact]) -> DataFrame:
    """Wide rows to one observation per present fact."""
    return emit(df, job, key, encounter, facts)


def emit_obs_group(
    df: DataFrame, job: str, key: Sequence[ColumnLike], encounter: ColumnLike, group: Group
) -> DataFrame:
    """Wide rows to a parent observation and children that point to it."""
    return emit(df, job, key, encounter, [group])


def split_rows(df: DataFrame, variants: Sequence[tuple[Column, dict[str, Column]]]) -> DataFrame:
    """Each row to one row per variant whose condition holds."""
    structs = [
        F.when(F.coalesce(condition, F.lit(False)), F.struct(*[c.alias(n) for n, c in columns.items()]))
        for condition, columns in variants
    ]
    return explode_present(df, structs)


def eav_pivot(
    df: DataFrame, keys: Sequence[str], name: str, value: str, properties: dict[str, Sequence[str] | str]
) -> DataFrame:
    """Named observations to one column per property; several values of one name keep the greatest."""
    picked = []
    for alias, names in properties.items():
        wanted = [names] if isinstance(names, str) else list(names)
        picked.append(F.max(F.when(F.col(name).isin(wanted), F.col(value))).alias(alias))
    return df.groupBy(*keys).agg(*picked)


def eav_bool_from_value(
    df: DataFrame, keys: Sequence[str], name: str, value: str, rules: dict[str, str]
) -> DataFrame:
    """``{'flag': 'obs=value|obs=value'}``: true for keys with one of the pairs, else null."""
    flags = []
    for alias, rule in rules.items():
        condition = F.lit(False)
        for pair in rule.split("|"):
            wanted_name, _, wanted_value = pair.partition("=")
            condition = condition | ((F.col(name) == wanted_name) & (F.col(value) == wanted_value))
        flags.append(F.max(F.when(condition, F.lit(True))).alias(alias))
    return df.groupBy(*keys).agg(*flags)


def resolve_obs(
    drafts: DataFrame,
    encounters: DataFrame,
    concepts: DataFrame | None = None,
    drugs: DataFrame | None = None,
    unknown_location: int = 1,
    job_table: str = "obs",
) -> DataFrame:
    """Draft observations to the target's shape.

    ``encounters``: source_encounter_id, encounter_id, patient_id, encounter_datetime, location_id,
    date_created. An observation without a migrated encounter drops out; time and place default to the
    encounter's. ``concepts``: ref, concept_id; ``drugs``: ref, drug_id; without them references stay text. A
    reference with several ids takes the lowest.
    """
    visits = encounters.select(
        "source_encounter_id", "encounter_id", F.col("patient_id").alias("person_id"),
        "encounter_datetime", "location_id", "date_created",
    )
    joined = drafts.join(visits, "source_encounter_id")
    question, answer, drug = F.col("concept"), F.col("value_coded"), F.col("value_drug")
    if concepts is not None:
        one_each = concepts.groupBy("ref").agg(F.min("concept_id").alias("concept_id"))
        questions = one_each.select(F.col("ref").alias("concept"), F.col("concept_id").alias("_question"))
        answers = one_each.select(F.col("ref").alias("value_coded"), F.col("concept_id").alias("_answer"))
        # a frequent concept is a hot key
        joined = attach(attach(joined, questions, ["concept"], "left"), answers, ["value_coded"], "left")
        question, answer = F.col("_question"), F.col("_answer")
    if drugs is not None:
        one_each = drugs.groupBy(F.col("ref").alias("value_drug")).agg(F.min("drug_id").alias("_drug"))
        joined = attach(joined, one_each, ["value_drug"], "left")
        drug = F.col("_drug")
    return joined.select(
        "obs_key", "group_key", "person_id", "encounter_id",
        F.coalesce("obs_datetime", F.col("encounter_datetime").cast("timestamp")).alias("obs_datetime"),
        F.coalesce("location_id", F.lit(unknown_location)).alias("location_id"),
        question.alias("concept_id"), answer.alias("value_coded"), drug.alias("value_drug"),
        "value_numeric", "value_datetime", "value_text", "comments",
        "accession_number", F.lit(1).alias("creator"), "date_created", F.lit(False).alias("voided"),
        uuid_name(job_table, "obs_key").alias("uuid"),
    )


def number_obs(obs: DataFrame, target: DataFrame) -> DataFrame:
    """Resolved observations with ``obs_id`` and ``obs_group_id``, ready for the target.

    ``target`` (obs_id, uuid) is what has been loaded: an observation found there by its uuid keeps its number, so a second
    run changes nothing; the others continue after the greatest number, in the order of their keys. Children find
    their parent's number by its key; a child whose parent is not among the observations stays ungrouped.

    The loaded observations are placed behind the new ones and written down with them, so the rows are matched once
    and not again for each side of the parents' join.
    """
    loaded = target.select("uuid", F.col("obs_id").cast("long").alias("obs_id"))
    matched = obs.join(loaded, "uuid", "left").withColumn("_known", F.col("obs_id").isNotNull())
    placed = assign_ids(matched, ["_known", "obs_key"], "_fresh", next_id(target, "obs_id"))
    numbered = placed.withColumn("obs_id", F.coalesce("obs_id", "_fresh")).drop("_known", "_fresh")
    parents = numbered.select(F.col("obs_key").alias("group_key"), F.col("obs_id").alias("obs_group_id"))
    # observations without a group take no part in the join: their null key would be one hot key
    alone = numbered.filter(F.col("group_key").isNull()).withColumn("obs_group_id", F.lit(None).cast("long"))
    return attach(numbered.filter(F.col("group_key").isNotNull()), parents, ["group_key"], "left").unionByName(alone)
