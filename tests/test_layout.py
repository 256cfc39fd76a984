import uuid

import pytest
from plans_text import estimated_rows, join_order, plan_text
from pyspark.sql import functions as F

from millrace.operators import layout, segments
from millrace.operators.layout import Placed
from millrace.plans import star
from millrace.sinks import tables

BUCKETS = 8


@pytest.fixture
def folder(tmp_path):
    return f"file:{tmp_path}"


def skewed(spark, rows=6000):
    """Encounter 7 holds a third of all procedures; some have no encounter."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(
        F.col("id") % 400
    )
    return spark.range(rows).select(
        key.cast("bigint").alias("encounter"),
        F.concat(F.lit("p"), F.col("id") % 7).alias("description"),
        (F.col("id") % 13 + 0.25).alias("base_cost"),
        (F.col("id") % 3).alias("code"),
    )


def encounters(spark):
    return spark.range(350).select(
        F.col("id"),
        (F.col("id") % 40).alias("patient"),
        (F.col("id") % 3).alias("payer"),
        (F.col("id") % 2).alias("organization"),
        F.concat(F.lit("c"), F.col("id") % 5).alias("encounterclass"),
        (F.col("id") * 1.5).alias("total_claim_cost"),
    )


def patients(spark):
    return spark.range(38).select(
        "id",
        F.concat(F.lit("city"), F.col("id") % 6).alias("city"),
        F.lit("MA").alias("state"),
    )


def named(spark, rows):
    return spark.range(rows).select("id", F.concat(F.lit("n"), "id").alias("name"))


def place(spark, folder):
    tag = uuid.uuid4().hex
    return layout.colocate(
        skewed(spark), f"proc_{tag}", "encounter", encounters(spark), f"enc_{tag}", "id",
        BUCKETS, folder,
    )


def same_rows(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    assert sorted(map(repr, left.select(columns).collect())) == sorted(
        map(repr, right.select(columns).collect())
    )


def test_hot_keys_are_kept_apart_and_no_row_is_lost(spark, folder):
    procedures, owners = place(spark, folder)
    assert {row["encounter"] for row in procedures.hot.select("encounter").collect()} == {7}
    assert {row["id"] for row in owners.hot.select("id").collect()} == {7}
    assert procedures.regular.where("encounter = 7").isEmpty()
    same_rows(procedures.rows(), skewed(spark))
    same_rows(owners.rows(), encounters(spark))


def test_hot_key_list_is_smaller_than_the_bucket_count(spark, folder):
    few = spark.range(1000).select((F.col("id") % 3).alias("k"))
    hot = layout.write_hot_keys(few, "k", BUCKETS, f"{folder}/hot")
    assert hot.count() == 3 < BUCKETS
    even = spark.range(1000).select("id")
    assert layout.write_hot_keys(even, "id", BUCKETS, f"{folder}/none") is None


def test_null_keys_that_fill_a_bucket_are_hot_too(spark, folder):
    df = spark.range(900).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), "id")
    hot = layout.write_hot_keys(df, "k", BUCKETS, f"{folder}/hot")
    placed = layout.write_placed(df, f"nulls_{uuid.uuid4().hex}", "k", BUCKETS, folder, hot)
    assert placed.hot.count() == 300 and placed.regular.where("k is null").isEmpty()
    same_rows(placed.rows(), df)


def test_one_file_per_bucket(spark, folder):
    placed = layout.write_placed(
        spark.range(1000), f"plain_{uuid.uuid4().hex}", "id", BUCKETS, folder
    )
    assert len(placed.regular.inputFiles()) == BUCKETS


def test_placed_join_moves_no_fact_rows(spark, folder, with_conf):
    procedures, owners = place(spark, folder)
    joined = layout.join_placed(procedures, owners, "encounter", "id")
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    regular = plan_text(joined[0])
    assert "Exchange" not in regular and "Bucketed: true" in regular
    plain = plan_text(skewed(spark).join(encounters(spark), F.expr("encounter = id")))
    assert plain.count("Exchange hashpartitioning") == 2


def test_placed_sum_per_encounter_has_one_small_exchange(spark, folder):
    procedures, owners = place(spark, folder)
    df = star.costs_by_organization(
        Placed(owners.regular), Placed(procedures.regular), named(spark, 2), named(spark, 3)
    )
    text = plan_text(df)
    assert text.count("Exchange hashpartitioning") == 1
    assert "hashpartitioning(organization_name" in text


def test_star_queries_agree_on_every_layout(spark, folder, with_conf):
    procedures, owners = place(spark, folder)
    people, payers, homes = patients(spark), named(spark, 3), named(spark, 2)
    plain_p, plain_e = skewed(spark), encounters(spark)
    for threshold in ("10485760", "-1"):
        with_conf(spark__sql__autoBroadcastJoinThreshold=threshold)
        same_rows(
            star.procedures_by_class(owners, procedures, people, payers),
            star.procedures_by_class(plain_e, plain_p, people, payers),
        )
        same_rows(
            star.claims_by_city(owners, people, payers, homes),
            star.claims_by_city(plain_e, people, payers, homes),
        )
        same_rows(
            star.costs_by_organization(owners, procedures, homes, payers),
            star.costs_by_organization(plain_e, plain_p, homes, payers),
        )


def test_star_queries_against_sql(spark):
    for name, df in {
        "p": skewed(spark), "e": encounters(spark), "pt": patients(spark),
        "py": named(spark, 3), "o": named(spark, 2),
    }.items():
        df.createOrReplaceTempView(name)
    same_rows(
        star.procedures_by_class(spark.table("e"), spark.table("p"), spark.table("pt"), spark.table("py")),
        spark.sql(
            """SELECT encounterclass, p.description, count(*) AS procedure_cnt
               FROM p JOIN e ON e.id = p.encounter WHERE e.patient IN (SELECT id FROM pt)
               GROUP BY ALL ORDER BY 3 DESC, 1, 2 LIMIT 10"""
        ),
    )
    same_rows(
        star.costs_by_organization(spark.table("e"), spark.table("p"), spark.table("o"), spark.table("py")),
        spark.sql(
            """SELECT o.name AS organization_name, py.name AS payer_name, encounterclass,
                      count(DISTINCT e.id) AS encounter_cnt, round(sum(base_cost), 2) AS proc_cost
               FROM p JOIN e ON e.id = p.encounter JOIN o ON o.id = e.organization
               JOIN py ON py.id = e.payer
               GROUP BY ALL ORDER BY 5 DESC, 1, 2, 3 LIMIT 10"""
        ),
    )


def test_redistribute_copies_a_table_under_another_key(spark, folder):
    source = f"source_{uuid.uuid4().hex}"
    layout.write_bucketed(skewed(spark), source, "encounter", 4, f"{folder}/{source}")
    target = f"target_{uuid.uuid4().hex}"
    placed = layout.redistribute(spark, source, target, "description", 4, folder)
    same_rows(placed.rows(), skewed(spark))
    assert "description" in spark.sql(f"DESCRIBE EXTENDED {target}").where(
        "col_name = 'Bucket Columns'"
    ).first()["data_type"]


def test_statistics_are_collected(spark, folder):
    table = f"stats_{uuid.uuid4().hex}"
    layout.write_bucketed(spark.range(10), table, "id", 2, f"{folder}/{table}")
    layout.collect_statistics(spark, table)
    layout.collect_statistics(spark, table, ["id"])
    info = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Statistics'").first()
    assert "10 rows" in info["data_type"]


def test_skewed_shuffle_join_is_split(spark, with_conf, tmp_path):
    """A hot key in an ordinary join and grouping on that key is read by several tasks."""
    path = f"file:{tmp_path}/skew"
    skewed(spark, 60000).withColumn("pad", F.sha2(F.col("base_cost").cast("string"), 256)) \
        .repartition(12).write.parquet(path)
    with_conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="2KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="2KB",
        spark__sql__adaptive__maxShuffledHashJoinLocalMapThreshold="0",
        spark__sql__adaptive__coalescePartitions__initialPartitionNum="64",
        spark__sql__adaptive__forceOptimizeSkewedJoin="true",
    )
    facts = spark.read.parquet(path)
    joined = facts.join(encounters(spark), F.expr("encounter = id")).groupBy("id").agg(
        F.max("pad"), F.count("*").alias("n")
    )
    assert "skew=true" in plan_text(joined, executed=True)
    assert joined.where("id = 7").first()["n"] == facts.where("encounter = 7").count()


def test_segment_counts_list_empty_segments(spark):
    df = spark.createDataFrame([(0,), (2,), (2,)], "k bigint")
    counts = segments.segment_counts(df, "t", F.pmod("k", F.lit(4)), 4)
    assert sorted(tuple(r) for r in counts.collect()) == [
        ("t", 0, 1), ("t", 1, 0), ("t", 2, 2), ("t", 3, 0),
    ]
    copies = segments.replicated_counts(df, "r", 2)
    assert sorted(tuple(r) for r in copies.collect()) == [("r", 0, 3), ("r", 1, 3)]


def test_hash_segment_is_the_partition_spark_picks(spark):
    df = spark.range(500).select(F.concat(F.lit("k"), "id").alias("k"))
    placed = df.repartition(7, "k").withColumn("at", F.spark_partition_id())
    assert placed.where(F.col("at") != segments.hash_segment("k", 7)).isEmpty()


# Recorded rows per segment and the skew in percent that belongs to them (fixed values).
RECORDED = {
    "encounters": ([13898, 13993], 0.68),
    "procedures": ([23875, 23826], 0.21),
    "patients": ([974, 974], 0.0),
    "organizations": ([1, 1], 0.0),
    "encounters_alt": ([13468, 14423], 6.85),
    "procedures_alt": ([21047, 26654], 23.51),
    "patients_alt": ([202, 772], 117.04),
    "organizations_alt": ([1, 0], 200.0),
    "payers_alt": ([5, 5], 0.0),
    "empty": ([0, 0], 0.0),
}


def test_skew_report(spark):
    counts = spark.createDataFrame(
        [(name, at, n) for name, (rows, _) in RECORDED.items() for at, n in enumerate(rows)],
        "table_name string, segment_id int, row_count bigint",
    )
    report = segments.skew_report(counts).collect()
    for row in report:
        rows, skew = RECORDED[row["table_name"]]
        assert round(row["skew_pct"], 2) == skew
        assert row["total_rows"] == sum(rows)
        share = rows[row["segment_id"]] / sum(rows) * 100 if sum(rows) else 0
        assert row["share_pct"] == pytest.approx(share)
    assert len(report) == 2 * len(RECORDED)


def filled(spark, folder, *batches, key="encounter", buckets=4):
    table = f"filled_{uuid.uuid4().hex}"
    schema = ", ".join(f"{column} {kind}" for column, kind in batches[0].dtypes)
    layout.create_bucketed(spark, table, schema, key, buckets, f"{folder}/{table}")
    for batch in batches:
        tables.fill_table(batch, table)
    return table


def test_inserts_keep_the_buckets(spark, folder, with_conf):
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    rows = skewed(spark)
    table = filled(spark, folder, rows.where("code = 0"), rows.where("code > 0"))
    owners = filled(spark, folder, encounters(spark), key="id")
    assert tables.bucket_spec(spark, table) == (4, ["encounter"])
    same_rows(spark.table(table), rows)
    joined = spark.table(table).join(spark.table(owners), F.expr("encounter = id"))
    assert "Exchange" not in plan_text(joined) and plan_text(joined).count("Bucketed: true") == 2
    same_rows(joined, rows.join(encounters(spark), F.expr("encounter = id")))
    wrong = segments.stored_segments(spark.table(table), "t", 4, "encounter").where("NOT placed")
    assert wrong.isEmpty()


def test_an_insert_adds_one_file_to_a_bucket(spark, folder):
    rows = spark.range(5000).selectExpr("id AS encounter", "id * 2 AS v").repartition(16)
    table = filled(spark, folder, rows, rows)
    assert len(spark.table(table).inputFiles()) == 8
    plain = f"plain_{uuid.uuid4().hex}"
    layout.create_bucketed(spark, plain, "encounter bigint, v bigint", "encounter", 4, f"{folder}/{plain}")
    rows.write.insertInto(plain)
    assert len(spark.table(plain).inputFiles()) > 16  # what an insert without the step would leave


def test_a_hot_key_is_inserted_by_several_tasks(spark, folder, with_conf):
    with_conf(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="8KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="8KB",
    )
    rows = spark.range(0, 40_000, 1, 12).selectExpr("IF(id % 2 = 0, 7L, id) AS encounter", "sha2(string(id), 256) AS v")
    table = filled(spark, folder, rows)
    files = spark.table(table).groupBy("_metadata.file_name").count()
    assert files.count() > 4 and files.agg(F.max("count")).first()[0] < 15_000
    same_rows(spark.table(table), rows)


def test_inserts_match_columns_by_name_and_add_up(spark, folder):
    rows = spark.createDataFrame([(1, "a"), (None, None)], "encounter bigint, v string")
    table = filled(spark, folder, rows, rows.select("v", "encounter"), rows.limit(0))
    assert sorted(map(str, spark.table(table).collect())) == sorted(map(str, rows.union(rows).collect()))
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN|cannot be resolved"):
        tables.fill_table(spark.range(1), table)
    plain = f"plain_{uuid.uuid4().hex}"
    spark.range(1).write.saveAsTable(plain)
    tables.fill_table(spark.range(2), plain)
    assert tables.bucket_spec(spark, plain) is None and spark.table(plain).count() == 3


@pytest.fixture
def star_tables(spark, folder):
    """A large fact, a smaller one and two dimensions, of which a filter keeps little."""
    tag = uuid.uuid4().hex[:8]
    frames = {
        "lines": spark.range(20_000).selectExpr("id % 4000 AS visit", "id AS v"),
        "visits": spark.range(4000).selectExpr("id", "id % 200 AS person", "id % 50 AS payer"),
        "people": spark.range(200).selectExpr("id", "concat('c', id % 100) AS city"),
        "payers": spark.range(50).selectExpr("id", "concat('p', id) AS name"),
    }
    names = {}
    for role, rows in frames.items():
        names[role] = f"{role}_{tag}"
        rows.write.saveAsTable(names[role])
    return names


TEXT = """SELECT count(*) AS n FROM IDENTIFIER(:lines) AS l JOIN IDENTIFIER(:visits) AS e ON l.visit = e.id
JOIN IDENTIFIER(:people) AS t ON e.person = t.id JOIN IDENTIFIER(:payers) AS y ON e.payer = y.id
WHERE {where}"""


def test_joins_follow_the_statistics(spark, star_tables, with_conf):
    names = star_tables
    text = TEXT.format(where="y.name = 'p3' AND t.city = 'c3'")
    as_written = spark.sql(text, args=names)
    assert join_order(as_written)[0] == names["lines"]
    for name in names.values():
        layout.collect_statistics(spark, name, histograms=True)
    ordered = spark.sql(text, args=names)
    assert names["visits"] in join_order(ordered)[:2] and join_order(ordered)[-1] == names["lines"]
    assert ordered.first()["n"] == as_written.first()["n"] > 0
    with_conf(spark__sql__cbo__enabled="false")
    assert join_order(spark.sql(text, args=names))[0] == names["lines"]


def test_which_dimension_comes_first_depends_on_what_it_keeps(spark, star_tables):
    names = star_tables
    for name in names.values():
        layout.collect_statistics(spark, name)
    few_payers = join_order(spark.sql(TEXT.format(where="y.name = 'p3'"), args=names))
    few_people = join_order(spark.sql(TEXT.format(where="t.city = 'c3'"), args=names))
    assert few_payers.index(names["payers"]) < few_payers.index(names["people"])
    assert few_people.index(names["people"]) < few_people.index(names["payers"])


def test_histograms_tell_what_a_range_keeps(spark):
    table = f"uneven_{uuid.uuid4().hex}"
    spark.range(10_000).selectExpr("IF(id < 9900, id % 10, id) AS v").write.saveAsTable(table)
    above = spark.table(table).where("v > 5000")
    layout.collect_statistics(spark, table)
    even = estimated_rows(spark.table(table).where("v > 5000"))
    layout.collect_statistics(spark, table, histograms=True)
    known = estimated_rows(spark.table(table).where("v > 5000"))
    assert above.count() == 100 and even > 4000 and known < 600


def test_copies_are_stored_once_per_segment(spark, folder):
    rows = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "id bigint, name string")
    path = f"{folder}/copies"
    segments.write_replicated(rows, path, 3)
    found = segments.replicated_segments(spark, path, "r", 4)
    assert sorted(map(tuple, found.collect())) == [("r", 0, 3, True), ("r", 1, 3, True), ("r", 2, 3, True), ("r", 3, 0, False)]
    same_rows(segments.read_copy(spark, path, 1), rows)
    assert all("segment_id=1" in f for f in segments.read_copy(spark, path, 1).inputFiles())
    # A copy that differs is told, whatever its number of rows.
    spark.createDataFrame([(1, "a"), (2, None), (3, None)], "id bigint, name string").write.parquet(f"{path}/segment_id=3")
    assert ("r", 3, 3, False) in set(map(tuple, segments.replicated_segments(spark, path, "r", 4).collect()))


def test_rows_lie_where_their_key_hashes_to(spark, folder):
    table = f"placed_{uuid.uuid4().hex}"
    rows = spark.createDataFrame([(None,), (1,), (1,), (-5,), (2**40,)], "k bigint")
    layout.write_bucketed(rows, table, "k", 8, f"{folder}/{table}")
    found = segments.stored_segments(spark.table(table), "t", 8, "k").collect()
    assert sum(r["row_count"] for r in found) == 5 and len(found) == 8 and all(r["placed"] for r in found)
    # Seen by another column, they do not.
    shifted = spark.read.parquet(f"{folder}/{table}").withColumnRenamed("k", "old").selectExpr("*", "old + 1 AS k", "_metadata")
    assert not all(r["placed"] for r in segments.stored_segments(shifted, "t", 8, "k").collect())
