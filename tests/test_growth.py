"""What moves, and how much of it, as the tables grow."""

import gzip
import json
from bisect import bisect_left, bisect_right
from pathlib import Path

from pyspark.sql import functions as F

from shelfmark.operators import clustered, postings
from shelfmark.operators.publish import resolve
from shelfmark.streaming.runs import run_entities
from shelfmark.workload import QUERIES


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_abstracts_move_texts_and_not_words(spark, tmp_path):
    rows = [(1, "The a the"), (2, "b"), (2, "the b"), (3, None), (4, "--"), (None, "the")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["q_inverted_index"](spark, str(tmp_path))
    assert _plan(found).count("Exchange hashpartitioning") == 1 and "posexplode" not in _plan(found)
    # the texts of one id are one record
    assert sorted(map(tuple, found.collect())) == [("D1", 2, 0), ("D2", 1, 0)]
    rebuilt = QUERIES["q_abstract_rebuild"](spark, str(tmp_path)).select("id", "n_words")
    assert sorted(map(tuple, rebuilt.collect())) == [("D1", 3), ("D2", 3)]


def test_postings_copy_no_text_for_each_word(spark):
    rows = spark.createDataFrame([(1, "b a B"), (2, ""), (3, None)], "id int, title string")
    found = postings.postings(rows, "title", ["id"])
    top = next(line for line in _plan(found).splitlines() if "Generate explode" in line)
    assert "_all" not in top and "_at" not in top
    assert sorted((r.token, r.id, r.positions) for r in found.collect()) == [("a", 1, [1]), ("b", 1, [0, 2])]


def test_pieces_are_cut_inside_tasks(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("lpad(id % 7000, 6, '0') AS id", "id AS other")
    pieces = clustered.write_pieces(rows, str(tmp_path), "base=0", ["id", "other"], 20_000, 100, ["000000", "003500"])
    assert sum(p.n_rows for p in pieces) == 20_000 and len(pieces) < 260
    assert max(p.n_rows for p in pieces) == 100  # sampled ranges alone would miss it
    assert all(a.high <= b.low for a, b in zip(pieces, pieces[1:]))
    assert not [p for p in pieces if p.low < "003500" <= p.high]
    assert clustered.read_pieces(spark, str(tmp_path), pieces).select("id", "other").exceptAll(rows).count() == 0


def test_bounds_are_searched_by_halving(spark):
    bounds = [f"{n:06d}" for n in range(0, 60_000, 3)]
    values = spark.createDataFrame([(f"{n:06d}",) for n in range(0, 60_100, 97)] + [("",), ("zz",), (None,)], "v string")
    for inclusive, search in ((True, bisect_right), (False, bisect_left)):
        found = values.select("v", clustered.n_below(F.col("v"), bounds, inclusive).alias("n"))
        assert "filter(" not in _plan(found) and "slice(" not in _plan(found)  # these would go through bounds one by one
        assert {r.v: r.n for r in found.collect()} == {v: 0 if v is None else search(bounds, v) for (v,) in values.collect()}


def test_folders_of_pieces_are_listed_by_few_tasks(spark, tmp_path):
    rows = spark.range(3_000).selectExpr("lpad(id, 6, '0') AS id")
    pieces = clustered.write_pieces(rows, str(tmp_path), "base=0", ["id"], 3_000, 8)
    assert len(pieces) > 300
    spark.sparkContext.setJobGroup("listing", "pieces are listed")
    try:
        read = clustered.read_pieces(spark, str(tmp_path), pieces)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
    assert stages and max(tracker.getStageInfo(s).numTasks for s in stages) <= 256
    assert read.exceptAll(rows).count() == 0 and read.count() == 3_000
    assert clustered.others(pieces, range(1, len(pieces))) == pieces[:1]


def test_one_large_file_is_parsed_by_many_tasks(spark, tmp_path):
    """A gzipped file can't be split; its lines are numbered as they stand in it, then dealt out."""
    day, root = tmp_path / "snapshot/authors/updated_date=2024-01-01", str(tmp_path / "tables")
    day.mkdir(parents=True)
    lines = [json.dumps({"id": f"A{n % 700}", "display_name": f"name {n}"}) for n in range(2_000)] + ["{"]
    with gzip.open(day / "part.gz", "wt") as file:
        file.write("\n".join(lines))
    run_entities(spark, str(tmp_path / "snapshot"), root, ("authors",))
    batch = Path(root, "authors", "batch=000000000000")
    assert len(list(batch.glob("part-*"))) > 1
    names = spark.read.parquet(str(batch)).orderBy("_row").select("display_name").collect()
    assert [r.display_name for r in names] == [f"name {n}" for n in range(2_000)]
    got = {r.id: r.display_name for r in resolve(spark, root, "authors").collect()}
    assert got == {f"A{n % 700}": f"name {n}" for n in range(2_000)}
    bad = spark.read.parquet(f"{root}/quarantine_authors/batch=000000000000").collect()
    assert [(r._row, r.raw) for r in bad] == [(2_000, "{")]
