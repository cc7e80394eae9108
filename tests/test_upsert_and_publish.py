import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.merges import audit_merges, follow, redirect
from shelfmark.operators.publish import compact, drop_hidden, publish, published, resolve
from shelfmark.operators.quality import error_budget, orphans, validate, violations
from shelfmark.operators.upsert import replace_children, upsert

ROWS = "_file string, _row bigint, _pos int, id string, a int, b string"


def _arrivals(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    return [
        (f"f{i // 40}", i, 0, f"k{rng.randrange(25)}", rng.choice([None, i]), rng.choice([None, "x"]))
        for i in range(200)
    ]


@pytest.mark.parametrize("policy", ["last", "first"])
def test_against_brute_force(spark, rows, policy):
    want = {}
    for _, _, _, key, a, b in rows:
        if policy == "last" or key not in want:
            want[key] = (key, a, b)
    got = _sorted_nulls(upsert(None, _arrivals(spark, rows), ["id"], policy))
    assert got == sorted(want.values(), key=str)


def _sorted_nulls(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_same_batch_twice_changes_nothing(spark, rows):
    new = _arrivals(spark, rows)
    once = upsert(None, new, ["id"])
    assert _sorted_nulls(upsert(once, new, ["id"])) == _sorted_nulls(once)


@pytest.mark.parametrize("policy", ["last", "first"])
def test_batch_borders_do_not_matter(spark, rows, policy):
    whole = upsert(None, _arrivals(spark, rows), ["id"], policy)
    parts = None
    for start in range(0, 200, 70):
        parts = upsert(parts, _arrivals(spark, rows[start : start + 70]), ["id"], policy)
    assert _sorted_nulls(parts) == _sorted_nulls(whole)


def test_one_key_holding_a_third_of_all_rows(spark):
    busy = spark.range(30000).select(
        F.lit("f").alias("_file"), F.col("id").alias("_row"), F.lit(0).alias("_pos"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key"),
        F.col("id").alias("n"),
    )
    merged = upsert(None, busy, ["key"])
    assert merged.count() == 20001
    assert merged.where("key = 'hot'").first().n == 29997
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan  # combined before the shuffle


def test_newest_by_beats_arrival(spark):
    rows = [("f", 1, 0, "k", 5, "new"), ("f", 2, 0, "k", 3, "old")]
    got = upsert(None, _arrivals(spark, rows), ["id"], newest_by="a").first()
    assert got.b == "new"


def test_replace_children(spark):
    schema = "_file string, _row bigint, _pos int, parent string, child string"
    old = spark.createDataFrame([("p1", "a"), ("p1", "b"), ("p2", "a")], "parent string, child string")
    new = spark.createDataFrame(
        [("f", 1, 0, "p1", "c"), ("f", 2, 0, "p1", "d"), ("f", 2, 1, "p1", "a")], schema
    )
    parents = spark.createDataFrame(
        [("f", 1, "p1"), ("f", 2, "p1")], "_file string, _row bigint, id string"
    )
    got = replace_children(old, new, parents, ["parent", "child"], "parent")
    assert _sorted(got.select("parent", "child")) == [("p1", "a"), ("p1", "d"), ("p2", "a")]
    kept = upsert(old, new, ["parent", "child"])
    assert kept.count() == 5  # without it, children that are gone stay


def _mesh(spark, *rows):
    names = ["work_id", "descriptor_ui", "descriptor_name", "qualifier_ui", "qualifier_name"]
    df = spark.createDataFrame(
        [("f", i, 0, *r) for i, r in enumerate(rows)],
        "_file string, _row bigint, _pos int, " + ", ".join(f"{n} string" for n in names),
    )
    return df.withColumn("is_major_topic", F.lit(False))


def test_publish_resolve_compact(spark, tmp_path):
    root = str(tmp_path / "root")
    assert resolve(spark, root, "works_biblio") is None

    def biblio(work, volume, row):
        return spark.createDataFrame(
            [("f", row, 0, work, volume, None, None, None)],
            "_file string, _row bigint, _pos int, work_id string, volume string, issue string, "
            "first_page string, last_page string",
        )

    publish(spark, root, 1, {"works_biblio": biblio("W1", "first", 1)})
    publish(spark, root, 2, {"works_biblio": biblio("W1", "second", 1), "works_mesh": _mesh(spark, ("W1", "D", "n", "Q", "q"))})
    publish(spark, root, 2, {"works_biblio": biblio("W1", "second", 1)})  # a replayed batch
    # written but never published: not visible
    biblio("W9", "lost", 1).write.parquet(f"{root}/works_biblio/batch=000000000003")
    got = resolve(spark, root, "works_biblio")
    assert [(r.work_id, r.volume) for r in got.collect()] == [("W1", "first")]  # first one wins
    assert compact(spark, root, "works_biblio", cluster_by=["volume"]) == 2
    alone = resolve(spark, root, "works_biblio")
    assert "Exchange" not in alone._jdf.queryExecution().executedPlan().toString()  # a lone base is read as it is
    assert [(r.work_id, r.volume) for r in alone.collect()] == [("W1", "first")]
    assert drop_hidden(spark, root, "works_biblio") == ["batch=000000000001", "batch=000000000002"]
    publish(spark, root, 4, {"works_biblio": biblio("W2", "x", 1)})
    assert published(spark, root, "works_biblio") == [("base", 3), ("batch", 4)]
    got = resolve(spark, root, "works_biblio")
    assert _sorted(got.select("work_id", "volume")) == [("W1", "first"), ("W2", "x")]


def test_merges_follow_chains_and_leave_cycles(spark):
    chain = [(f"n{i}", f"n{i + 1}") for i in range(37)]
    cycle = [("x", "y"), ("y", "z"), ("z", "x"), ("w", "x")]
    merged = spark.createDataFrame(chain + cycle + [("s", "s")], "original_id string, merged_into_id string")
    got = dict(_sorted(follow(merged)))
    assert got == {f"n{i}": "n37" for i in range(37)}
    rows = spark.createDataFrame([("n0", 1), ("x", 2), ("free", 3)], "id string, n int")
    assert _sorted(redirect(rows, ["id"], merged)) == [("free", 3), ("n37", 1), ("x", 2)]


def test_merge_audit_logs_every_insert(spark):
    new = spark.sql(
        "SELECT 'a' original_id, 'b' merged_into_id, 'works' entity_type, DATE'2024-01-01' merge_date, "
        "CAST(NULL AS STRING) merge_reason"
    )
    merged, log = audit_merges(None, new)
    again, _ = audit_merges(merged, new.withColumn("original_id", F.lit("c")))
    assert again.count() == 2
    row = log.first()
    assert row.log_id and row.logged_at and row.original_id == "a"


def test_error_budget_is_judged_per_file(spark):
    rows = [("good", "ok")] * 5 + [("bad", "malformed")] * 3 + [("bad", "strict:ids")] * 9
    shaped = spark.createDataFrame(rows, "_file string, status string")
    got = {r["_file"]: r for r in error_budget(shaped, max_errors=3).collect()}
    assert got["good"].ok and not got["bad"].ok
    assert got["bad"].n_malformed == 3 and got["bad"].n_rejected == 9


def test_validate_and_violations(spark):
    works = spark.createDataFrame([("W1",), ("W1",), (None,)], "id string")
    access = spark.createDataFrame(
        [("W1", "gold"), ("W2", "odd"), ("W2", None)], "work_id string, oa_status string"
    )
    tables = {"works": works, "works_open_access": access}
    got = {(r.table_name, r.constraint): r.n_bad for r in validate(tables).collect()}
    assert got[("works", "primary_key")] == 1
    assert got[("works", "not_null:id")] == 1
    assert got[("works_open_access", "foreign_key:work_id")] == 2
    assert got[("works_open_access", "check:oa_status")] == 1
    assert violations(tables, "works_open_access", "check:oa_status").first().oa_status == "odd"
    assert violations(tables, "works_open_access", "foreign_key:work_id").first().work_id == "W2"
    assert violations(tables, "works", "primary_key").first().n == 2
    assert orphans(access, "work_id", works).count() == 1
