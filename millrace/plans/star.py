"""Top-k queries over a hospital star: encounters and procedures with small dimensions.

Encounters meet their dimensions first and the procedures last. Encounters are the smaller fact:
when a dimension is too large to broadcast, only they are moved for it. Placed tables (see
operators.layout) join without moving procedures at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import rounded_avg, rounded_sum
from millrace.operators.layout import Placed, join_placed, union_parts


def as_placed(table: DataFrame | Placed) -> Placed:
    return table if isinstance(table, Placed) else Placed(table)


def _dimension(table: DataFrame, key: str, **columns: str) -> DataFrame:
    """Key and renamed attributes of a dimension, ready to join on the fact's column name."""
    return table.select(
        F.col("id").alias(key), *[F.col(old).alias(new) for new, old in columns.items()]
    )


def procedures_by_class(
    encounters: DataFrame | Placed,
    procedures: DataFrame | Placed,
    patients: DataFrame,
    payers: DataFrame,
    top: int = 10,
) -> DataFrame:
    """Most frequent pairs of encounter class and procedure."""
    visits = as_placed(encounters).transform(
        lambda rows: rows.select("id", "patient", "payer", "encounterclass")
        .join(_dimension(payers, "payer"), "payer")
        .join(_dimension(patients, "patient"), "patient")
        .select("id", "encounterclass")
    )
    performed = as_placed(procedures).transform(
        lambda rows: rows.select("encounter", "description")
    )
    return (
        union_parts(join_placed(performed, visits, "encounter", "id"))
        .groupBy("encounterclass", "description")
        .agg(F.count("*").alias("procedure_cnt"))
        .orderBy(F.desc("procedure_cnt"), F.asc_nulls_last("encounterclass"), F.asc_nulls_last("description"))
        .limit(top)
    )


def claims_by_city(
    encounters: DataFrame | Placed,
    patients: DataFrame,
    payers: DataFrame,
    organizations: DataFrame,
    top: int = 10,
) -> DataFrame:
    """Cities and payers with the most encounters, and their mean claim."""
    visits = (
        as_placed(encounters)
        .rows()
        .select("patient", "payer", "organization", "total_claim_cost")
        .join(_dimension(payers, "payer", name="name"), "payer")
        .join(_dimension(organizations, "organization"), "organization")
        .join(_dimension(patients, "patient", city="city", state="state"), "patient")
    )
    return (
        visits.groupBy("city", "state", "name")
        .agg(
            F.count("*").alias("encounter_cnt"),
            rounded_avg("total_claim_cost", 2).alias("avg_claim"),
        )
        .orderBy(F.desc("encounter_cnt"), F.asc_nulls_last("city"), F.asc_nulls_last("state"), F.asc_nulls_last("name"))
        .limit(top)
    )


def costs_by_organization(
    encounters: DataFrame | Placed,
    procedures: DataFrame | Placed,
    organizations: DataFrame,
    payers: DataFrame,
    top: int = 10,
) -> DataFrame:
    """Organization, payer and class with the highest procedure cost, with distinct encounters.

    Procedures are summed per encounter before the join, on the partitioning the join needs.
    Grouping by the encounter again uses the same partitioning and makes the distinct count a
    row count, so the only wide exchange is the one that brings procedures to their encounter,
    and none when both tables are placed by it.
    """
    keys = ["organization_name", "payer_name", "encounterclass"]
    visits = as_placed(encounters).transform(
        lambda rows: rows.select("id", "organization", "payer", "encounterclass")
        .join(_dimension(payers, "payer", payer_name="name"), "payer")
        .join(_dimension(organizations, "organization", organization_name="name"), "organization")
        .select("id", *keys)
    )
    costs = as_placed(procedures).transform(
        lambda rows: rows.groupBy("encounter").agg(F.sum("base_cost").alias("cost"))
    )
    per_encounter = [
        part.groupBy("id", *keys).agg(F.sum("cost").alias("cost"))
        for part in join_placed(costs, visits, "encounter", "id")
    ]
    return (
        union_parts(per_encounter)
        .groupBy(*keys)
        .agg(
            F.count("*").alias("encounter_cnt"),
            rounded_sum("cost", 2).alias("proc_cost"),
        )
        .orderBy(F.desc_nulls_last("proc_cost"), *[F.asc_nulls_last(name) for name in keys])
        .limit(top)
    )
