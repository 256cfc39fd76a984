"""Star queries over the driver tables, stored under two layouts.

Roles: procedures = lineitem, encounters = orders, patients = customer, payers = nation (chosen
by customer number), organizations = region (chosen by order number).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import rounded_sum
from millrace.operators import layout, segments
from millrace.operators.constraints import reconcile_counts
from millrace.operators.counts import row_counts
from millrace.operators.layout import Placed
from millrace.plans import star
from millrace.registry.common import Inputs, query, sql_round
from millrace.sinks.files import write_csv
from millrace.sinks.tables import fill_table
from millrace.sources.files import read_csv
from millrace.sources.schemas import SEGMENT_COUNTS

SEGMENTS = 2


def _procedures(data: Inputs) -> DataFrame:
    return data["lineitem"].select(
        F.col("l_orderkey").alias("encounter"),
        F.col("l_partkey").alias("code"),
        F.col("l_returnflag").alias("description"),
        F.col("l_extendedprice").alias("base_cost"),
    )


def _encounters(data: Inputs) -> DataFrame:
    return data["orders"].select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("patient"),
        F.pmod("o_custkey", F.lit(25)).cast("int").alias("payer"),
        F.pmod("o_orderkey", F.lit(5)).cast("int").alias("organization"),
        F.col("o_orderpriority").alias("encounterclass"),
        F.col("o_totalprice").alias("total_claim_cost"),
    )


def _patients(data: Inputs) -> DataFrame:
    return data["customer"].select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("city"),
        F.col("c_nationkey").alias("state"),
    )


def _payers(data: Inputs) -> DataFrame:
    return data["nation"].select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")
    )


def _organizations(data: Inputs) -> DataFrame:
    return data["region"].select(
        F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")
    )


def _place(data: Inputs) -> tuple[Placed, Placed]:
    """Both fact tables hashed by the encounter."""

    def build(path: str) -> tuple[Placed, Placed]:
        tag = path.rsplit("-", 1)[-1]
        pair = layout.colocate(
            _procedures(data),
            f"procedures_{tag}",
            "encounter",
            _encounters(data),
            f"encounters_{tag}",
            "id",
            data.width,
            path,
        )
        layout.collect_statistics(data.spark, f"procedures_{tag}", ["encounter"])
        layout.collect_statistics(data.spark, f"encounters_{tag}", ["id"])
        return pair

    return data.stored("layout", build)


def _place_alternative(data: Inputs) -> tuple[Placed, Placed]:
    """The same rows hashed by columns that the queries do not join on."""

    def build(path: str) -> tuple[Placed, Placed]:
        tag = path.rsplit("-", 1)[-1]
        placed = []
        for name, rows, key in (
            ("procedures_alt", _procedures(data), "code"),
            ("encounters_alt", _encounters(data), "patient"),
        ):
            hot = layout.write_hot_keys(rows, key, data.width, f"{path}/{name}_hot_keys")
            placed.append(
                layout.write_placed(rows, f"{name}_{tag}", key, data.width, path, hot)
            )
        return placed[0], placed[1]

    return data.stored("layout-alt", build)


def layout_load(data: Inputs) -> DataFrame:
    """Load both layouts and compare the stored row counts with the source."""
    procedures, encounters = _place(data)
    procedures_alt, encounters_alt = _place_alternative(data)
    stored = row_counts(
        {
            "procedures": procedures.rows(),
            "encounters": encounters.rows(),
            "procedures_alt": procedures_alt.rows(),
            "encounters_alt": encounters_alt.rows(),
        }
    )
    source = row_counts(
        {
            "procedures": data["lineitem"],
            "encounters": data["orders"],
            "procedures_alt": data["lineitem"],
            "encounters_alt": data["orders"],
        }
    )
    return reconcile_counts(stored, source)


LAYOUT_LOAD_SQL = """
SELECT names.table_name, counts.n AS expected_rows, counts.n AS actual_rows, TRUE AS matches
FROM (VALUES ('procedures', 'l'), ('procedures_alt', 'l'),
             ('encounters', 'o'), ('encounters_alt', 'o')) AS names(table_name, source)
JOIN (SELECT 'l' AS source, count(*) AS n FROM lineitem
      UNION ALL SELECT 'o', count(*) FROM orders) AS counts
  ON counts.source = names.source
"""


# Source rows, and the key of the copy.
CLONED = {
    "procedures": (_procedures, "code"),
    "encounters": (_encounters, "patient"),
    "patients": (_patients, "state"),
    "payers": (_payers, "name"),
    "organizations": (_organizations, "name"),
}


def clone_load(data: Inputs) -> DataFrame:
    """Store all five tables, copy each under another key, and compare the row counts."""

    def build(path: str) -> dict[str, Placed]:
        tag = path.rsplit("-", 1)[-1]
        placed = {}
        for name, (rows, key) in CLONED.items():
            source, target = f"{name}_from_{tag}", f"{name}_to_{tag}"
            rows(data).write.saveAsTable(source)
            placed[name] = layout.redistribute(data.spark, source, target, key, data.width, path)
            layout.collect_statistics(data.spark, target, [key])
        return placed

    copies = data.stored("clones", build)
    stored = row_counts({name: copy.rows() for name, copy in copies.items()})
    return reconcile_counts(stored, row_counts({name: rows(data) for name, (rows, _) in CLONED.items()}))


CLONE_LOAD_SQL = """
SELECT table_name, n AS expected_rows, n AS actual_rows, TRUE AS matches
FROM (SELECT 'procedures' AS table_name, count(*) AS n FROM lineitem
      UNION ALL SELECT 'encounters', count(*) FROM orders
      UNION ALL SELECT 'patients', count(*) FROM customer
      UNION ALL SELECT 'payers', count(*) FROM nation
      UNION ALL SELECT 'organizations', count(*) FROM region) AS counts
"""


def star_q1(data: Inputs, place=_place) -> DataFrame:
    procedures, encounters = place(data)
    return star.procedures_by_class(encounters, procedures, _patients(data), _payers(data))


def star_q2(data: Inputs, place=_place) -> DataFrame:
    _, encounters = place(data)
    return star.claims_by_city(encounters, _patients(data), _payers(data), _organizations(data))


def star_q3(data: Inputs, place=_place) -> DataFrame:
    procedures, encounters = place(data)
    return star.costs_by_organization(
        encounters, procedures, _organizations(data), _payers(data)
    )


def _alternative_rows(data: Inputs) -> tuple[DataFrame, DataFrame]:
    """Tables whose placement does not help the join: used as plain rows."""
    procedures, encounters = _place_alternative(data)
    return procedures.rows(), encounters.rows()


STAR_Q1_SQL = """
SELECT o_orderpriority AS encounterclass, l_returnflag AS description,
       count(*) AS procedure_cnt
FROM lineitem, orders, customer, nation
WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND n_nationkey = o_custkey % 25
GROUP BY o_orderpriority, l_returnflag
ORDER BY procedure_cnt DESC, encounterclass, description
LIMIT 10
"""

STAR_Q2_SQL = f"""
SELECT c_mktsegment AS city, c_nationkey AS state, n_name AS name,
       count(*) AS encounter_cnt, {sql_round("avg(o_totalprice)", 2)} AS avg_claim
FROM orders, customer, nation, region
WHERE o_custkey = c_custkey AND n_nationkey = o_custkey % 25 AND r_regionkey = o_orderkey % 5
GROUP BY c_mktsegment, c_nationkey, n_name
ORDER BY encounter_cnt DESC, city, state, name
LIMIT 10
"""

STAR_Q3_SQL = f"""
SELECT r_name AS organization_name, n_name AS payer_name, o_orderpriority AS encounterclass,
       count(DISTINCT o_orderkey) AS encounter_cnt,
       {sql_round("sum(l_extendedprice)", 2)} AS proc_cost
FROM lineitem, orders, nation, region
WHERE l_orderkey = o_orderkey AND n_nationkey = o_custkey % 25 AND r_regionkey = o_orderkey % 5
GROUP BY r_name, n_name, o_orderpriority
ORDER BY proc_cost DESC, organization_name, payer_name, encounterclass
LIMIT 10
"""


def _modulo(column: str):
    return F.pmod(F.col(column), F.lit(SEGMENTS))


def segment_counts(data: Inputs) -> DataFrame:
    """Rows per segment: facts spread by a key, dimensions stored whole on every segment.

    The segment is the key modulo the number of segments, which every engine can check.
    """
    return segments.union_counts(
        [
            segments.segment_counts(
                data["orders"], "encounters", _modulo("o_orderkey"), SEGMENTS
            ),
            segments.segment_counts(
                data["lineitem"], "procedures", _modulo("l_orderkey"), SEGMENTS
            ),
            segments.segment_counts(
                data["orders"], "encounters_alt", _modulo("o_custkey"), SEGMENTS
            ),
            segments.segment_counts(
                data["lineitem"], "procedures_alt", _modulo("l_linenumber"), SEGMENTS
            ),
            segments.segment_counts(
                data["region"], "organizations_alt", _modulo("r_regionkey"), SEGMENTS
            ),
            segments.replicated_counts(data["customer"], "patients", SEGMENTS),
            segments.replicated_counts(data["nation"], "payers", SEGMENTS),
        ]
    )


SEGMENT_COUNTS_SQL = f"""
WITH held AS (
    SELECT 'encounters' AS table_name, o_orderkey % {SEGMENTS} AS segment_id FROM orders
    UNION ALL SELECT 'procedures', l_orderkey % {SEGMENTS} FROM lineitem
    UNION ALL SELECT 'encounters_alt', o_custkey % {SEGMENTS} FROM orders
    UNION ALL SELECT 'procedures_alt', l_linenumber % {SEGMENTS} FROM lineitem
    UNION ALL SELECT 'organizations_alt', r_regionkey % {SEGMENTS} FROM region
    UNION ALL SELECT 'patients', s.id FROM customer, range({SEGMENTS}) AS s(id)
    UNION ALL SELECT 'payers', s.id FROM nation, range({SEGMENTS}) AS s(id)
), names AS (SELECT DISTINCT table_name FROM held)
SELECT names.table_name, CAST(s.id AS INT) AS segment_id, count(held.table_name) AS row_count
FROM names CROSS JOIN range({SEGMENTS}) AS s(id)
LEFT JOIN held ON held.table_name = names.table_name AND held.segment_id = s.id
GROUP BY names.table_name, s.id
"""


def skew_report(data: Inputs) -> DataFrame:
    """The report over counts that were exported to a CSV file and read back."""

    def build(path: str) -> str:
        write_csv(segment_counts(data), path)
        return path

    counts = read_csv(data.spark, data.stored("segments", build), SEGMENT_COUNTS, delimiter=",")
    return segments.skew_report(counts).select(
        "table_name",
        "segment_id",
        "row_count",
        "total_rows",
        F.round("share_pct", 4).alias("share_pct"),
        F.round("skew_pct", 4).alias("skew_pct"),
    )


SKEW_REPORT_SQL = f"""
WITH counts AS ({SEGMENT_COUNTS_SQL}), totals AS (
    SELECT table_name, sum(row_count) AS total, avg(row_count) AS average,
           max(row_count) - min(row_count) AS spread
    FROM counts GROUP BY table_name
)
SELECT table_name, segment_id, row_count, CAST(total AS BIGINT) AS total_rows,
       round(row_count / total * 100, 4) AS share_pct,
       round(spread / average * 100, 4) AS skew_pct
FROM counts JOIN totals USING (table_name)
"""



def insert_placed(data: Inputs) -> DataFrame:
    """Both facts filled by several inserts into empty bucketed tables, then joined in place."""

    def build(path: str) -> tuple[str, str]:
        tag = path.rsplit("-", 1)[-1]
        names = f"procedures_filled_{tag}", f"encounters_filled_{tag}"
        facts = (_procedures(data), "encounter"), (_encounters(data), "id")
        for name, (rows, key) in zip(names, facts):
            schema = ", ".join(f"{column} {kind}" for column, kind in rows.dtypes)
            layout.create_bucketed(data.spark, name, schema, key, data.width, f"{path}/{name}")
            # Columns are matched by name, whatever order a batch has them in.
            fill_table(rows.where(F.pmod(F.col(key), F.lit(3)) == 0), name)
            fill_table(rows.where(F.pmod(F.col(key), F.lit(3)) != 0).select(*reversed(rows.columns)), name)
        return names

    procedures, encounters = map(data.spark.table, data.stored("filled", build))
    joined = procedures.join(encounters, F.col("encounter") == F.col("id"))
    return joined.groupBy("encounterclass", "description").agg(
        F.count("*").alias("procedure_cnt"), rounded_sum("base_cost", 2).alias("proc_cost")
    )


INSERT_PLACED_SQL = f"""
SELECT o_orderpriority AS encounterclass, l_returnflag AS description, count(*) AS procedure_cnt,
       {sql_round("sum(l_extendedprice)", 2)} AS proc_cost
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY o_orderpriority, l_returnflag
"""

# The tables in an order that joins the largest first; statistics must find a better one.
BY_STATISTICS = """
SELECT y.name AS payer_name, t.state, count(*) AS procedure_cnt
FROM IDENTIFIER(:procedures) AS p
JOIN IDENTIFIER(:encounters) AS e ON p.encounter = e.id
JOIN IDENTIFIER(:patients) AS t ON e.patient = t.id
JOIN IDENTIFIER(:payers) AS y ON e.payer = y.id
WHERE y.name IN ('NATION_1', 'NATION_2', 'NATION_3') AND t.city = 'BUILDING' AND e.total_claim_cost > 250000
GROUP BY y.name, t.state
"""


def analyzed_tables(data: Inputs) -> dict[str, str]:
    """The star as catalog tables with statistics and histograms of all columns, by role."""

    def build(path: str) -> dict[str, str]:
        tag = path.rsplit("-", 1)[-1]
        names = {}
        for role, rows in (
            ("procedures", _procedures(data)),
            ("encounters", _encounters(data)),
            ("patients", _patients(data)),
            ("payers", _payers(data)),
        ):
            names[role] = f"{role}_analyzed_{tag}"
            rows.write.option("path", f"{path}/{role}").saveAsTable(names[role])
            layout.collect_statistics(data.spark, names[role], histograms=True)
        return names

    return data.stored("analyzed", build)


def join_by_statistics(data: Inputs) -> DataFrame:
    """A star join whose order follows the statistics of its tables, not the text."""
    return data.spark.sql(BY_STATISTICS, args=analyzed_tables(data))


JOIN_BY_STATISTICS_SQL = """
SELECT n_name AS payer_name, c_nationkey AS state, count(*) AS procedure_cnt
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON n_nationkey = o_custkey % 25
WHERE n_name IN ('NATION_1', 'NATION_2', 'NATION_3') AND c_mktsegment = 'BUILDING' AND o_totalprice > 250000
GROUP BY n_name, c_nationkey
"""

STORED_SEGMENTS = 4


def placed_segments(data: Inputs) -> DataFrame:
    """Rows per segment of stored tables: facts in their bucket files, dimensions in their copies."""

    def build(path: str) -> dict[str, str]:
        tag = path.rsplit("-", 1)[-1]
        names = {}
        for role, rows, key in (
            ("encounters", _encounters(data), "id"), ("procedures", _procedures(data), "encounter"),
            ("encounters_alt", _encounters(data), "patient"),
        ):
            names[role] = f"{role}_segments_{tag}"
            layout.write_bucketed(rows, names[role], key, STORED_SEGMENTS, f"{path}/{role}")
        for role, rows in (("patients", _patients(data)), ("payers", _payers(data))):
            names[role] = f"{path}/{role}"
            segments.write_replicated(rows, names[role], STORED_SEGMENTS)
        return names

    names = data.stored("segment-files", build)
    keys = {"encounters": "id", "procedures": "encounter", "encounters_alt": "patient"}
    return segments.union_counts(
        [
            *(
                segments.stored_segments(data.spark.table(names[role]), role, STORED_SEGMENTS, key)
                for role, key in keys.items()
            ),
            *(
                segments.replicated_segments(data.spark, names[role], role, STORED_SEGMENTS)
                for role in ("patients", "payers")
            ),
        ]
    )


def _murmur_sql(source: str) -> str:
    """Murmur3 (32 bits, seed 42) of the bigint column k of a relation, as its pmod in column s."""
    word = 4294967295

    def mixed(name: str, value: str, state: str) -> str:
        return f"""
            ({value} * 3432918353::UBIGINT) & {word} AS {name}a,
            ((({name}a * 32768) | ({name}a >> 17)) & {word}) * 461845907::UBIGINT & {word} AS {name}b,
            xor({state}, {name}b) AS {name}c,
            ((({name}c * 8192) | ({name}c >> 19)) & {word}) * 5 + 3864292196 & {word} AS {name}"""

    return f"""
        SELECT table_name, CASE WHEN h >= 2147483648 THEN CAST(h AS BIGINT) - 4294967296 ELSE CAST(h AS BIGINT) END AS signed,
               ((signed % {STORED_SEGMENTS}) + {STORED_SEGMENTS}) % {STORED_SEGMENTS} AS s
        FROM (SELECT table_name, CAST(k & {word} AS UBIGINT) AS low, CAST((k >> 32) & {word} AS UBIGINT) AS high,
            {mixed("x", "low", "42::UBIGINT")}, {mixed("y", "high", "x")},
            xor(y, 8::UBIGINT) AS f, xor(f, f >> 16) * 2246822507::UBIGINT & {word} AS g,
            xor(g, g >> 13) * 3266489909::UBIGINT & {word} AS i, xor(i, i >> 16) AS h
            FROM ({source}))"""


PLACED_SEGMENTS_SQL = f"""
WITH keys AS (
    SELECT 'encounters' AS table_name, o_orderkey AS k FROM orders
    UNION ALL SELECT 'procedures', l_orderkey FROM lineitem
    UNION ALL SELECT 'encounters_alt', o_custkey FROM orders
), held AS (
    SELECT table_name, s FROM ({_murmur_sql("SELECT table_name, k FROM keys")})
    UNION ALL SELECT 'patients', i FROM customer, range({STORED_SEGMENTS}) AS r(i)
    UNION ALL SELECT 'payers', i FROM nation, range({STORED_SEGMENTS}) AS r(i)
), names AS (SELECT DISTINCT table_name FROM held)
SELECT names.table_name, CAST(r.i AS INT) AS segment_id, count(held.s) AS row_count, TRUE AS placed
FROM names CROSS JOIN range({STORED_SEGMENTS}) AS r(i)
LEFT JOIN held ON held.table_name = names.table_name AND held.s = r.i
GROUP BY names.table_name, r.i
"""

QUERIES = {
    "insert_placed": query(insert_placed),
    "join_by_statistics": query(join_by_statistics),
    "placed_segments": query(placed_segments),
    "clone_load": query(clone_load),
    "layout_load": query(layout_load),
    "star_q1": query(star_q1),
    "star_q1_alt": query(lambda data: star_q1(data, _alternative_rows)),
    "star_q2": query(star_q2),
    "star_q2_alt": query(lambda data: star_q2(data, _alternative_rows)),
    "star_q3": query(star_q3),
    "star_q3_alt": query(lambda data: star_q3(data, _alternative_rows)),
    "segment_counts": query(segment_counts),
    "skew_report": query(skew_report),
}

ORACLES = {
    "insert_placed": INSERT_PLACED_SQL,
    "join_by_statistics": JOIN_BY_STATISTICS_SQL,
    "placed_segments": PLACED_SEGMENTS_SQL,
    "clone_load": CLONE_LOAD_SQL,
    "layout_load": LAYOUT_LOAD_SQL,
    "star_q1": STAR_Q1_SQL,
    "star_q1_alt": STAR_Q1_SQL,
    "star_q2": STAR_Q2_SQL,
    "star_q2_alt": STAR_Q2_SQL,
    "star_q3": STAR_Q3_SQL,
    "star_q3_alt": STAR_Q3_SQL,
    "segment_counts": SEGMENT_COUNTS_SQL,
    "skew_report": SKEW_REPORT_SQL,
}
