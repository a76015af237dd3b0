import random

import pytest
from pyspark.sql import functions as F

from supplyscope import operators as O
from supplyscope.operators.filters import active, ended
from supplyscope.operators.reshape import distinct_values


@pytest.fixture
def null_keys(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, l int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, r int")
    return left, right


def test_null_safe_joins_match_null_with_null(null_keys, rows):
    left, right = null_keys
    assert rows(O.inner_on(left, right, ["k"])) == [("a", 1, 10)]
    assert rows(O.inner_on(left, right, ["k"], null_safe=True)) == [(None, 2, 20), ("a", 1, 10)]
    assert rows(O.left_on(left, right, ["k"])) == [(None, 2, None), ("a", 1, 10), ("b", 3, None)]


def test_missing_in_and_in_set_split_the_left_side(null_keys, rows):
    left, right = null_keys
    assert rows(O.missing_in(left, right, ["k"])) == [("b", 3)]
    assert rows(O.missing_in(left, right, ["k"], null_safe=False)) == [(None, 2), ("b", 3)]
    assert rows(O.in_set(left, right, ["k"], null_safe=True)) == [(None, 2), ("a", 1)]


def test_exists_flag(null_keys, rows):
    left, right = null_keys
    assert rows(O.exists_flag(left, right, ["k"], "there")) == [(None, 2, False), ("a", 1, True), ("b", 3, False)]


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_the_plain_join(spark, rows, how, null_safe):
    rng = random.Random(5)
    # A third of the rows share one key, and a tenth have none.
    keys = [("hot",) if i % 3 == 0 else (None if i % 10 == 1 else f"k{rng.randrange(30)}",) for i in range(600)]
    left = spark.createDataFrame([(k, i) for i, (k,) in enumerate(keys)], "k string, l int")
    right = spark.createDataFrame([(k, n) for n, k in enumerate(["hot", "hot", None, "k1", "k2", "other"])], "k string, r int")
    plain = O.join_on(left, right, ["k"], how, null_safe)
    spread = O.spread_join(left, right, ["k"], how, null_safe, hot_rows=10)
    assert rows(spread) == rows(plain)
    counted = left.filter("l < 100").select("k")
    assert rows(O.spread_join(left, right, ["k"], how, null_safe, counted, hot_rows=10)) == rows(plain)


def test_spread_join_cuts_only_hot_keys(spark):
    left = spark.createDataFrame([("hot", i) for i in range(100)] + [("cold", 0)], "k string, l int")
    right = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, r int")
    with pytest.raises(ValueError):
        O.spread_join(left, right, ["k"], "full")
    assert O.spread_join(left, right, ["k"], hot_rows=10).count() == 101


def test_spread_join_and_number_within_leave_no_task_with_the_hot_key(spark):
    left = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"),
        F.col("id").alias("rowid"),
    )
    right = left.groupBy("k").agg(F.max("rowid").alias("v"))

    def largest_task(df, col):
        # The sum keeps the column, and with it the join, in the plan.
        per_task = df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.sum(col))
        return max(r.n for r in per_task.collect())

    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "50",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert largest_task(O.left_on(left, right, ["k"]), "v") > 10_000
        assert largest_task(O.spread_join(left, right, ["k"], hot_rows=500), "v") < 5_000
        assert largest_task(O.number_within(left, ["k"], "rowid", "nr", span=1000), "nr") < 5_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_spread_join_splits_a_hot_null_key(spark, no_broadcast):
    left = spark.range(20_000).select(
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"), F.col("id").alias("rowid")
    )
    right = spark.createDataFrame([(None, 1), ("k10", 2)], "k string, v int")
    joined = O.spread_join(left, right, ["k"], null_safe=True, hot_rows=1000)
    per_task = joined.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("v")).collect()
    assert max(r.n for r in per_task) < 5_000
    assert sum(r.n for r in per_task) == 20_000 and sum(r.v or 0 for r in per_task) == 18_002


def test_spread_join_repeats_right_rows_of_hot_keys_only(spark, rows):
    right = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, v int")
    hot = spark.createDataFrame([("b", 3)], "k string, __pieces int")
    pieces = [("a", 2, 0), ("b", 3, 0), ("b", 3, 1), ("b", 3, 2)]
    for null_safe in (False, True):
        assert rows(O.repeated(right, hot, ["k"], null_safe), "k", "v", "__piece") == [(None, 1, 0), *pieces]
    unknown = spark.createDataFrame([(None, 2)], "k string, __pieces int")
    assert rows(O.repeated(right, unknown, ["k"], True), "k", "__piece") == [(None, 0), (None, 1), ("a", 0), ("b", 0)]
    # Few null keys: nothing is repeated for them.
    left = spark.createDataFrame([(None, i) for i in range(50)] + [("a", 0)], "k string, l int")
    joined = O.spread_join(left, right, ["k"], null_safe=True)
    assert rows(joined.groupBy("k").agg(F.count("v"))) == [(None, 50), ("a", 1)]


def test_left_join_m1_stops_on_a_repeated_key(spark, rows):
    left = spark.createDataFrame([("a",), (None,)], "k string")
    once = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], "k string, v int")
    assert rows(O.left_join_m1(left, once, ["k"])) == [(None, 2), ("a", 1)]
    twice = spark.createDataFrame([("a", 1), ("c", 2), ("c", 3)], "k string, v int")
    with pytest.raises(Exception, match="dims: more than one row for key c"):
        O.left_join_m1(left, twice, ["k"], what="dims").collect()
    unknown = spark.createDataFrame([(None, 2), (None, 3)], "k string, v int")
    with pytest.raises(Exception, match="more than one row for key null"):
        O.left_join_m1(left, unknown, ["k"]).collect()


def test_left_join_m1_on_two_keys_and_plain_nulls(spark, rows):
    left = spark.createDataFrame([("a", 1), ("a", None), (None, None)], "k string, j int")
    right = spark.createDataFrame([("a", 1, 10), ("a", None, 20), (None, None, 30)], "k string, j int, v int")
    assert rows(O.left_join_m1(left, right, ["k", "j"])) == [(None, None, 30), ("a", None, 20), ("a", 1, 10)]
    assert rows(O.left_join_m1(left, right, ["k", "j"], null_safe=False)) == [(None, None, None), ("a", None, None), ("a", 1, 10)]


def scans(df, path):
    """How often the executed plan of ``df`` reads files under ``path``."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count(f"{path}")


def test_left_join_m1_reads_and_shuffles_the_lookup_once(spark, no_broadcast, tmp_path):
    spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("v")).write.parquet(str(tmp_path / "lookup"))
    left = spark.range(50).select(F.col("id").alias("k"))
    joined = O.left_join_m1(left, spark.read.parquet(str(tmp_path / "lookup")), ["k"])
    assert scans(joined, tmp_path / "lookup") == 1
    plan = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ShuffleQueryStage") == 2


def test_left_many_reads_the_right_side_once(spark, rows, tmp_path, monkeypatch):
    from supplyscope.operators import joins

    spark.createDataFrame([("a", 10), ("a", 11), ("c", 30)], "k string, r int").write.parquet(str(tmp_path / "many"))
    right = spark.read.parquet(str(tmp_path / "many"))
    read = []
    write = joins.materialise
    monkeypatch.setattr(joins, "materialise", lambda df, name: read.append(scans(df, tmp_path / "many")) or write(df, name))
    joined = O.left_many(spark.createDataFrame([("a", 1), ("b", 2)], "k string, l int"), right, ["k"])
    assert read == [1] and scans(joined, tmp_path / "many") == 0
    assert rows(joined) == [("a", 1, 10), ("a", 1, 11), ("b", 2, None)]


def test_coverage_grid_has_a_row_per_match_and_one_per_gap(spark, rows):
    expected = spark.createDataFrame([("o1", "A"), ("o2", "B")], "organisation string, name string")
    actual = spark.createDataFrame(
        [("o1", "p1", "e1", 200), ("o1", "p1", "e2", None), ("o2", "p2", None, 404), ("o3", "p1", "e9", 200)],
        "organisation string, pipeline string, endpoint string, status int",
    )
    dim = [{"collection": "c", "pipeline": "p1"}, {"collection": "c", "pipeline": "p2"}]
    grid = O.coverage_grid(expected, dim, actual, ["organisation", "pipeline"], {"endpoint": "none"})
    # Matched rows keep their nulls.
    assert rows(grid, "organisation", "name", "pipeline", "endpoint", "status") == [
        ("o1", "A", "p1", "e1", 200),
        ("o1", "A", "p1", "e2", None),
        ("o1", "A", "p2", "none", None),
        ("o2", "B", "p1", "none", None),
        ("o2", "B", "p2", None, 404),
    ]


@pytest.mark.parametrize("null_safe", [False, True])
def test_left_many_equals_the_left_join(spark, rows, null_safe):
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, l int")
    right = spark.createDataFrame([("a", 10), ("a", 11), (None, 20), ("c", 30), ("a", None)], "k string, r int")
    assert rows(O.left_many(left, right, ["k"], null_safe)) == rows(O.left_on(left, right, ["k"], null_safe))


def test_outer_compare(spark, rows):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, a int")
    b = spark.createDataFrame([(None, 3), ("y", 4)], "k string, b int")
    assert rows(O.outer_compare(a, b, ["k"])) == [(None, 2, 3), ("x", 1, None), ("y", None, 4)]
    twice = O.outer_compare(a.union(a), b, ["k"], F.sum("a").alias("a"), F.count("b").alias("n"))
    assert rows(twice) == [(None, 4, 1), ("x", 2, 0), ("y", None, 1)]
    with pytest.raises(ValueError, match="both sides"):
        O.outer_compare(a, a, ["k"])


def test_outer_compare_is_one_shuffle(spark, no_broadcast):
    a, b = (spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias(c)) for c in "ab")
    both = O.outer_compare(a, b, ["k"], F.sum("a").alias("a"), F.sum("b").alias("b"))
    assert both.count() == 7
    both.collect()
    plan = both._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ShuffleQueryStage") == 1 and "Join" not in plan


def test_enrich_roles(spark, rows):
    pairs = spark.createDataFrame([("d", 1, 2), ("d", 2, 9)], "dataset string, id_a int, id_b int")
    details = spark.createDataFrame([("d", 1, "one"), ("d", 2, "two")], "dataset string, id int, name string")
    got = O.enrich_roles(pairs, details, {"dataset": "dataset", "id": "id_{role}"}, {"a": "a_", "b": "b_"})
    assert rows(got, "id_a", "id_b", "a_name", "b_name") == [(1, 2, "one", "two"), (2, 9, "two", None)]


def test_map_column(spark):
    df = spark.createDataFrame([(1,), (7,), (None,)], "x int")
    assert [r[0] for r in df.select(O.map_column(F.col("x"), {1: "a"}, "z")).collect()] == ["a", "z", "z"]


def test_filters(spark, rows):
    df = spark.createDataFrame([("", 1), (None, 2), ("2020-01-01", 3), ("  ", 4)], "end_date string, i int")
    assert rows(active(df), "i") == [(1,), (2,), (4,)]
    assert rows(ended(df), "i") == [(3,)]
    named = spark.createDataFrame([("a",), (None,), ("b",)], "name string")
    assert rows(O.exclude(named, "name", "a")) == [("b",)]
    assert O.with_prefix(named, "a_").columns == ["a_name"]
    assert O.order_columns(named.withColumn("y", F.lit(1)).withColumn("z.", F.lit(2)), ["z."], ["name"]).columns == ["z.", "y", "name"]


def test_groups_drop_or_keep_null_keys(spark, rows):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", None)], "k string, v int")
    assert rows(O.group_count(df, ["k"])) == [("a", 2)]
    assert rows(O.group_count(df, ["k"], "v", dropna=False)) == [(None, 1), ("a", 1)]
    assert rows(O.group_distinct(df, ["k"], {"v": "n"})) == [(None, 1), ("a", 2)]
    assert rows(O.group_distinct(df, ["k"], {"v": "n"}, dropna=True)) == [("a", 2)]
    assert rows(O.group_min_max(df, ["k"], "v")) == [("a", 1, 1)]
    assert rows(O.group_any(df, ["k"], F.col("v") > 1, "big", dropna=False)) == [(None, True), ("a", False)]


def test_distinct_counts_of_a_group_with_most_rows(spark, rows, no_broadcast):
    """Nine rows in ten under one owner: its values are spread over the tasks before they are counted."""
    owner = F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("o"), F.col("id") % 5))
    df = spark.range(20_000).select(owner.alias("k"), (F.col("id") % 6000).alias("v"), (F.col("id") % 3).cast("string").alias("w"))
    got = O.group_distinct(df, ["k"], {"v": "nv", "w": "nw"})
    want = df.groupBy("k").agg(F.count_distinct("v").alias("nv"), F.count_distinct("w").alias("nw"))
    assert rows(got, "k", "nv", "nw") == rows(want, "k", "nv", "nw")
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "hashpartitioning(k" in plan and "__value" in plan.split("hashpartitioning(k")[-1].split("\n")[0]
    tall = df.select("k", F.col("v").cast("string").alias("__value")).distinct()
    per_task = tall.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in per_task) < 0.2 * sum(r["count"] for r in per_task)


def test_dedupe_by_id(spark, rows):
    data = [("e", "r1", 1), ("e", "r3", 3), ("e", "r2", 2), ("f", None, 4), (None, "x", 5), (None, "y", 6)]
    df = spark.createDataFrame(data, "endpoint string, resource string, rowid int")
    assert rows(O.dedupe_by_id(df, ["endpoint"], "rowid"), "endpoint", "resource") == [(None, "x"), ("e", "r1"), ("f", None)]
    last = O.dedupe_by_id(df, ["endpoint"], "rowid", "last")
    assert rows(last, "endpoint", "resource") == [(None, "y"), ("e", "r3"), ("f", None)]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_dedupe_keeps_first_or_last(spark, rows):
    df = spark.createDataFrame([("e", "r1", 1), ("e", "r3", 3), ("e", "r2", 2), ("f", None, 1)], "endpoint string, resource string, rowid int")
    assert rows(O.dedupe(df, ["endpoint"], ["rowid"], "first"), "endpoint", "resource") == [("e", "r1"), ("f", None)]
    assert rows(O.dedupe(df, ["endpoint"], ["rowid"], "last"), "endpoint", "resource") == [("e", "r3"), ("f", None)]
    assert rows(O.representative(df, ["endpoint"], ["resource"]), "endpoint", "resource") == [("e", "r1"), ("f", None)]


@pytest.mark.parametrize("span", [3, 1000])
def test_number_within_numbers_across_stretches(spark, rows, span):
    rng = random.Random(3)
    data = [(rng.choice(["a", "b", None]), i) for i in rng.sample(range(200), 80)]
    df = spark.createDataFrame(data, "k string, rowid int")
    expected = []
    for key in ("a", "b", None):
        ids = sorted(i for k, i in data if k == key)
        expected += [(key, i, n) for n, i in enumerate(ids, 1)]
    got = [tuple(r) for r in O.number_within(df, ["k"], "rowid", "nr", span=span).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_first_non_null(spark):
    df = spark.createDataFrame([(2, "b"), (1, None), (3, "c")], "rowid int, v string")
    assert df.agg(O.first_non_null("v", "rowid")).first()[0] == "b"


def test_top_latest_page(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 4), (None, 5), (None, 6)], "k string, n int")
    assert [tuple(r) for r in O.top_groups(df, "k", 2).collect()] == [("b", 2), ("a", 1)]
    assert [r.n for r in O.latest(df, "n", 2).collect()] == [6, 5]
    assert [r.n for r in O.page(df, ["n"], 2, 1).collect()] == [3, 4]
    with pytest.raises(ValueError):
        O.page(df, [], 2, 1)
    assert O.page(df, ["n"], 2, 3).collect() == [] and O.page(df.limit(0), ["n"], 2, 0).collect() == []
    many = spark.range(5_000).select((F.col("id") * 7919 % 5_000).alias("n"))
    assert [r.n for r in O.page(many, ["n"], 100, 41).collect()] == list(range(4_100, 4_200))


def test_a_stored_order_is_read_by_ranges(spark, tmp_path):
    path = str(tmp_path / "stored")
    shuffled = spark.range(5_000).select((F.col("id") * 7919 % 5_000).alias("n"), F.lit("x").alias("t"))
    O.store_ordered(shuffled, ["n"], path, ranges=20)
    assert len(spark.read.parquet(f"{path}/rows").inputFiles()) == 20
    for size, number in ((100, 0), (100, 41), (7, 714), (250, 19), (1, 4_999)):
        got = O.read_page(spark, path, size, number)
        assert got.columns == ["n", "t"]
        assert [r.n for r in got.collect()] == list(range(5_000))[size * number : size * (number + 1)]
        # Ranges hold about 250 rows.
        assert len(got.inputFiles()) <= 3
    assert [r.n for r in O.rows_between(spark, path, 240, 1_260).collect()] == list(range(240, 1_260))
    assert O.read_page(spark, path, 100, 50).collect() == []
    assert O.page_count(spark, path, 700) == 8
    pages = {r.n: r.page for r in O.page_numbers(spark, path, 700).collect()}
    assert pages == {n: n // 700 for n in range(5_000)}
    O.store_ordered(shuffled.limit(0), ["n"], str(tmp_path / "none"))
    assert O.page_count(spark, str(tmp_path / "none"), 10) == 0
    assert O.page_numbers(spark, str(tmp_path / "none"), 10).collect() == []


def test_sets(spark, rows):
    a = spark.createDataFrame([("x", 1), ("x", 1), ("y", 2)], "k string, a int")
    b = spark.createDataFrame([("x", 9)], "k string, b int")
    assert rows(O.union_all(a, b), "k", "a", "b") == [("x", None, 9), ("x", 1, None), ("x", 1, None), ("y", 2, None)]
    assert rows(O.union_keys(a, b, ["k"])) == [("x",), ("y",)]
    assert rows(O.minus(a.select("k"), b.select("k"))) == [("y",)]
    assert [r.k for r in O.sorted_distinct(a, "k").collect()] == ["x", "y"]


def test_union_datasets_fills_tag_and_missing_columns(spark, rows):
    one = spark.createDataFrame([(None, 1), ("own", 2)], "dataset string, entity int")
    two = spark.createDataFrame([("n", 3)], "name string, entity int")
    got = O.union_datasets({"one": one, "two": two}, ["dataset", "entity", "name", "reference"])
    assert rows(got) == [("one", 1, None, None), ("own", 2, None, None), ("two", 3, "n", None)]


def test_explode_entities_keeps_an_empty_list(spark, rows):
    df = spark.createDataFrame([("a", '{"entities": []}'), ("b", '{"entities": ["1", 2]}')], "d string, details string")
    assert rows(O.explode_entities(df)) == [("a", None), ("b", "1"), ("b", "2")]


def test_explode_matches(spark, rows):
    texts = [
        ("a", "{'complete_matches': [{'entity_a': 1, 'entity_b': 2, 'organisation_entity_a': None}], 'single_matches': []}"),
        ("b", '{"single_matches": [{"entity_a": 3, "entity_b": 4}]}'),
        ("c", "not parseable"),
    ]
    df = spark.createDataFrame(texts, "d string, details string")
    got = rows(O.explode_matches(df), "d", "message", "entity_a", "entity_b", "organisation_entity_a")
    assert got == [("a", "complete_match", "1", "2", None), ("b", "single_match", "3", "4", None)]


def test_pivot_keeps_null_index_and_refuses_repeats(spark, rows):
    df = spark.createDataFrame([("x", "p", "1"), (None, "q", "2")], "i string, c string, v string")
    wide = O.fill_pivot(O.pivot_labels(df, ["i"], "c", "v", ["p", "q"]), ["p", "q"], "-")
    assert rows(wide) == [(None, "-", "2"), ("x", "1", "-")]
    twice = df.union(spark.createDataFrame([("x", "p", "3")], df.schema))
    with pytest.raises(Exception, match="more than one row for p"):
        O.pivot_labels(twice, ["i"], "c", "v", ["p", "q"]).collect()


def test_distinct_values_refuses_too_many(spark):
    df = spark.range(20).withColumn("c", F.col("id").cast("string"))
    assert len(distinct_values(df, "c")) == 20
    with pytest.raises(ValueError):
        distinct_values(df, "c", limit=10)


def test_spec_fields_keep_order_and_repeats(spark):
    df = spark.createDataFrame([("b;a;x;a",), ("",), (None,)], "f string")
    spec = F.array(F.lit("a"), F.lit("b"))
    got = df.select(O.spec_fields(F.col("f"), spec).alias("s")).collect()
    assert [r.s for r in got] == [["b", "a", "a"], [], []]
    assert df.select(O.array_len(O.spec_fields(F.col("f"), F.lit(None).cast("array<string>")))).first()[0] == 0


def test_band_counts_fill_absent_members(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.5), ("a", 0.8), ("a", None), ("z", 0.1)], "k string, x double")
    got = O.band_counts(df, "k", "x", [0.5, 0.8], ["lo", "mid", "hi"], ["b", "a"])
    assert [tuple(r) for r in got.collect()] == [("b", 0, 0, 0), ("a", 1, 1, 1)]


def test_row_multiplicity(spark, rows):
    shared = spark.createDataFrame([("r",), ("r",), ("s",)], "resource string")
    errors = spark.createDataFrame([("r",), ("r",), ("r",), ("t",)], "resource string")
    assert rows(O.row_multiplicity(shared, errors, "resource", "n")) == [("r", 6)]
