import json
import random
import re
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import clustered, lookups, manifest, postings, publish as P, report, search
from shelfmark.operators.hierarchy import reassemble
from shelfmark.operators.quality import audit, validate
from shelfmark.operators.similar import similar_names
from shelfmark.operators.upsert import ARRIVAL
from shelfmark.plans.catalog import TABLES
from shelfmark.sources.files import scan_csv
from shelfmark.sources.snapshot import literal, scan_lines
from shelfmark.streaming.ingest import ingest_batch, manifest_of
from shelfmark.streaming.runs import checkpoint, log_of, note, run_entities


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 9, 10, 50])
def test_search_among_sorted_bounds(spark, n):
    pick = random.Random(n)
    bounds = sorted("".join(pick.choice("abÿ中") for _ in range(pick.randint(0, 3))) for _ in range(n))
    values = spark.createDataFrame([(v,) for v in {*bounds, "", "zz", "aa", "b", "中中"}], "v string")
    for inclusive in (True, False):
        got = values.select("v", clustered.n_below(F.col("v"), bounds, inclusive).alias("n")).collect()
        assert {r.v: r.n for r in got} == {r.v: sum(b <= r.v if inclusive else b < r.v for b in bounds) for r in got}


def _children(spark, rows):
    """(work, concept, name, row): rows of works_concepts."""
    made = [("f", n, n % 3, w, c, name) for w, c, name, n in rows]
    return spark.createDataFrame(made, "_file string, _row bigint, _pos int, work_id string, concept_id string, display_name string")


@pytest.mark.parametrize("seed", [1, 2])
def test_merges_equal_one_fold(spark, tmp_path, seed):
    """Batches merged one by one, read at every step, and pieces that hold their order."""
    pick, root, table = random.Random(seed), str(tmp_path / "root"), "works_concepts"
    held, n = {}, 0
    for batch in range(4):
        rows = []
        for _ in range(400 if batch == 0 else 12):
            n += 1
            work = "W-hot" if pick.random() < 0.3 else f"W{pick.randint(0, 300):04d}"
            rows.append((work, f"C{pick.randint(0, 90 if work == 'W-hot' else 5)}", f"name {n}", n))
        held |= {(w, c): name for w, c, name, _ in rows}
        P.publish(spark, root, P.next_batch(spark, root), {table: _children(spark, rows)})
        want = sorted((w, c, name) for (w, c), name in held.items())
        assert _rows(P.resolve(spark, root, table)) == want
        P.merge(spark, root, table, piece_rows=40)
        pieces = P.pieces_of(spark, root, table, P.published(spark, root, table)[0][1])
        assert all(a.high <= b.low for a, b in zip(pieces, pieces[1:], strict=False)) and len(pieces) >= 5
        assert sum(p.n_rows for p in pieces) == len(held)
        assert _rows(P.resolve(spark, root, table)) == want
        if batch == 2:
            P.drop_hidden(spark, root, table)
            assert _rows(P.resolve(spark, root, table)) == want
    assert sum("W-hot" in (p.low, p.high) for p in pieces) >= 2  # a busy parent fills several pieces
    got = P.find(spark, root, table, ["W-hot", "W0007", "nobody"])
    assert _rows(got) == [r for r in want if r[0] in ("W-hot", "W0007")]
    assert P.find(spark, root, table, ["nobody"]).collect() == []


def _pieces(spark, root, table):
    return P.pieces_of(spark, root, table, P.published(spark, root, table)[0][1])


def test_a_merge_opens_what_a_batch_touches(spark, tmp_path):
    """A hundredth of the keys: a hundredth of the pieces is read and written, the others stay where they are."""
    root, table = str(tmp_path / "root"), "authors"

    def batch(low, high, name):
        return spark.range(low, high).select(
            F.concat(F.lit("A"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("id"), F.lit(name).alias("display_name"),
            F.lit("f").alias("_file"), F.col("id").alias("_row"), F.lit(0).alias("_pos"),
        )

    P.publish(spark, root, 0, {table: batch(0, 10_000, "old")})
    P.merge(spark, root, table, piece_rows=100)
    before = _pieces(spark, root, table)
    assert 80 <= len(before) <= 130
    P.publish(spark, root, 2, {table: batch(9_900, 10_050, "new")})
    current = P.resolve(spark, root, table)
    plan = current._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # of the open pieces and the batch only
    opened = P.arrivals(spark, root, table, None, P._touched(spark, root, table, [("batch", 2)], before, None)).inputFiles()
    assert len({f for f in opened if "base=" in f}) <= 4
    P.merge(spark, root, table, piece_rows=100)
    after = _pieces(spark, root, table)
    assert len({p.path for p in before} & {p.path for p in after}) >= len(before) - 4
    assert _rows(P.resolve(spark, root, table).groupBy("display_name").count()) == [("new", 150), ("old", 9_900)]
    files = P.find(spark, root, table, ["A000123"]).inputFiles()
    assert len(files) == 1 and P.find(spark, root, table, ["A000123"]).count() == 1
    dropped = P.drop_hidden(spark, root, table)
    assert "batch=000000000000" in dropped and any("/cut=" in d for d in dropped)
    assert P.resolve(spark, root, table).count() == 10_050
    assert all(c in P.resolve(spark, root, table, keep=ARRIVAL).columns for c in ARRIVAL)


def test_a_lookup_by_value_opens_a_few_files(spark, tmp_path):
    """Values of a column other than the key, over many pieces, with replaced rows in a later batch."""
    root, table = str(tmp_path / "root"), "works"

    def batch(low, high, name):
        return spark.range(low, high).select(
            F.concat(F.lit("W"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("id"), F.concat(F.lit(name), F.col("id")).alias("doi"),
            F.lit("f").alias("_file"), F.col("id").alias("_row"), F.lit(0).alias("_pos"),
        )

    P.publish(spark, root, 0, {table: batch(0, 4_000, "10/")})
    P.merge(spark, root, table, piece_rows=50)
    lookups.index(spark, root, table, "doi", piece_rows=50)
    found = lookups.lookup(spark, root, table, "doi", ["10/77", "10/2500", "10/x"])
    assert _rows(found.select("id", "doi")) == [("W00077", "10/77"), ("W02500", "10/2500")]
    assert len([f for f in found.inputFiles() if f"/{table}/" in f]) <= 3 and len([f for f in found.inputFiles() if "_lookups" in f]) <= 4
    P.publish(spark, root, 2, {table: batch(70, 80, "new/")})
    assert lookups.lookup(spark, root, table, "doi", ["10/77"]).collect() == []
    got = lookups.lookup(spark, root, table, "doi", ["new/77", "10/81"])
    assert _rows(got.select("id", "doi")) == [("W00077", "new/77"), ("W00081", "10/81")]
    assert lookups.between(spark, root, table, "doi", "new/7", "new/75").count() == 6
    assert lookups.index(spark, root, table, "doi") == []
    counts = {(r.batch, r.kind): r.n_rows for r in P.batch_counts(spark, root).collect()}
    assert counts == {(0, "batch"): 4_000, (1, "base"): 4_000, (2, "batch"): 10}


def test_an_empty_table_can_be_merged(spark, tmp_path):
    root = str(tmp_path / "root")
    assert P.merge(spark, root, "works_concepts") is None
    P.publish(spark, root, 0, {"works_concepts": _children(spark, [])})
    assert P.merge(spark, root, "works_concepts") == 0
    assert P.resolve(spark, root, "works_concepts").collect() == []
    P.publish(spark, root, 2, {"works_concepts": _children(spark, [("W", "C", "n", 1)])})
    P.merge(spark, root, "works_concepts")
    P.publish(spark, root, 4, {"works_concepts": _children(spark, [])})
    assert P.merge(spark, root, "works_concepts") == 4 and P.resolve(spark, root, "works_concepts").count() == 1


def _lines(spark, *texts, file="f"):
    return spark.createDataFrame([(file, t) for t in texts], "_file string, value string").coalesce(1)


def _author(name, *concepts):
    return json.dumps({"id": name, "x_concepts": [{"id": c} for c in concepts]})


@pytest.mark.parametrize("merged", [False, True])
def test_children_of_replaced_parents_vanish(spark, tmp_path, merged):
    root = str(tmp_path / "root")
    ingest_batch(spark, _lines(spark, _author("A1", "x", "y"), _author("A2", "x")), "authors", root, 0)
    if merged:
        P.merge(spark, root, "authors_concepts", piece_rows=1)
    ingest_batch(spark, _lines(spark, _author("A1", "y", "z"), _author("A1", "z", "w")), "authors", root, P.next_batch(spark, root), replace_children=True)
    concepts = P.resolve(spark, root, "authors_concepts").select("author_id", "concept_id")
    assert _rows(concepts) == [("A1", "w"), ("A1", "z"), ("A2", "x")]
    ingest_batch(spark, _lines(spark, _author("A1", "q"), _author("A2")), "authors", root, P.next_batch(spark, root))
    assert _rows(P.resolve(spark, root, "authors_concepts").select("author_id", "concept_id")) == [("A1", "q"), ("A1", "w"), ("A1", "z"), ("A2", "x")]
    ingest_batch(spark, _lines(spark, _author("A2")), "authors", root, P.next_batch(spark, root), replace_children=True)
    for step in (lambda: None, lambda: P.merge(spark, root, "authors_concepts"), lambda: P.drop_hidden(spark, root, "authors_concepts")):
        step()
        assert _rows(P.resolve(spark, root, "authors_concepts").select("author_id", "concept_id")) == [("A1", "q"), ("A1", "w"), ("A1", "z")]


def test_records_put_back_together(spark, tmp_path):
    """Pages of a parent's children in order, from what runs stored; parents without children stay."""
    root = str(tmp_path / "root")
    many = [f"C{n:03d}" for n in range(25)]
    ingest_batch(spark, _lines(spark, _author("A1", *many), _author("A2")), "authors", root, 0)
    P.compact(spark, root, "authors_concepts")
    ingest_batch(spark, _lines(spark, _author("A1", "new"), file="g"), "authors", root, P.next_batch(spark, root))
    whole = reassemble(P.resolve(spark, root, "authors"), P.resolve(spark, root, "authors_concepts", keep=ARRIVAL), "author_id", size=10)
    got = {(r.id, r.page): [i.concept_id for i in r["items"]] for r in whole.collect()}
    assert sorted(sum((v for k, v in sorted(got.items()) if k[0] == "A1"), [])) == sorted([*many, "new"])
    assert [got[("A1", p)] for p in range(4) if got[("A1", p)] != ["new"]] == [many[:10], many[10:20], many[20:]]
    assert got[("A2", 0)] == [] and "display_name" in whole.columns


def test_a_batch_that_fails_between_tables_stays_hidden(spark, tmp_path):
    """What was written before the failure is not visible, and the batch written again is whole."""
    root = str(tmp_path / "root")
    good = _children(spark, [("W", "C", "n", 1)])
    bad = good.withColumn("display_name", F.raise_error(F.lit("no more")).cast("string"))
    P.publish(spark, root, 0, {"works_concepts": good, "authors_concepts": good})
    with pytest.raises(Exception, match="no more"):
        P.publish(spark, root, 1, {"authors_concepts": _children(spark, [("W2", "C", "n", 1)]), "works_concepts": bad})
    assert P.published(spark, root, "authors_concepts") == [("batch", 0)] == P.published(spark, root, "works_concepts")
    again = _children(spark, [("W3", "C", "n", 1)])
    P.publish(spark, root, 1, {"authors_concepts": again, "works_concepts": again})
    assert [r.work_id for r in P.resolve(spark, root, "works_concepts").orderBy("work_id").collect()] == ["W", "W3"]


def _works(spark, *rows):
    made = [("f", n, 0, i, t) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(made, "_file string, _row bigint, _pos int, id string, title string")


def test_postings_equal_search_of_texts(spark, tmp_path):
    """Over a base and two batches with replaced texts, for any terms."""
    pick, root = random.Random(3), str(tmp_path / "root")
    words = ["Dark", "matter", "für", "中文", "x2", "the", "The", "--", "é"]

    def some(ids):
        return [(f"W{i}", None if pick.random() < 0.05 else " ".join(pick.choice(words) for _ in range(pick.randint(0, 8)))) for i in ids]

    P.publish(spark, root, 0, {"works": _works(spark, *some(range(80)))})
    P.merge(spark, root, "works", piece_rows=20)
    P.publish(spark, root, 2, {"works": _works(spark, *some(range(60, 100)))})
    P.publish(spark, root, 3, {"works": _works(spark, *some([5, 6, 70, 70, 70, 71]))})
    current = P.resolve(spark, root, "works")
    for terms in (["dark matter"], ["the", "x2"], ["FÜR", "中文"], ["nothing"], ["!!"], ["é"]):
        for match in ("all", "any"):
            want = search.keyword(current, "title", terms, match, rank=True).select("id", F.col("hits").cast("long"))
            assert _rows(postings.search(spark, root, "works", "title", terms, match).select("id", "hits")) == _rows(want), (terms, match)
    plan = postings.search(spark, root, "works", "title", ["dark"])._jdf.queryExecution().executedPlan().toString()
    assert "regexp" not in plan.lower() and "title" not in plan.split("AdaptiveSparkPlan", 1)[1]
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan)
    P.merge(spark, root, "works", piece_rows=20)
    assert len(postings.index(spark, root, "works", "title")) == 1 and postings.index(spark, root, "works", "title") == []
    got = {r.id: list(r.positions) for r in postings.positions(spark, root, "works", "title", "the").collect()}
    texts = {r.id: re.findall(r"\w+", (r.title or "").lower()) for r in current.collect()}
    assert got == {i: [n for n, t in enumerate(ts) if t == "the"] for i, ts in texts.items() if "the" in ts}


def test_terms_without_tokens_match_nothing(spark):
    rows = spark.createDataFrame([(1, "a b"), (2, ""), (3, None)], "id int, t string")
    for match in ("all", "any"):
        assert search.keyword(rows, "t", ["!!!"], match).collect() == [] and search.keyword(rows, "t", [], match).collect() == []


@pytest.mark.parametrize("percent", [1, 50, 80, 100])
def test_similar_names_equal_brute_force(spark, percent):
    pick = random.Random(percent)
    names = ["".join(pick.choice("abAé ") for _ in range(pick.randint(0, 9))) for _ in range(120)] + ["", "ab", "ab", None]
    got = {(r.a, r.b): (r.shared, r.total) for r in similar_names(spark.createDataFrame([(n,) for n in names], "n string"), "n", percent).collect()}

    def grams(name):
        padded = f"  {name.lower()}  "
        return {padded[i : i + 3] for i in range(len(padded) - 2)}

    want, different = {}, sorted({n for n in names if n is not None}, key=lambda n: n.encode())
    for i, a in enumerate(different):
        for b in different[i + 1 :]:
            shared, total = len(grams(a) & grams(b)), len(grams(a) | grams(b))
            if 100 * shared >= percent * total:
                want[a, b] = (shared, total)
    assert got == want
    plan = similar_names(spark.createDataFrame([("a",)], "n string"), "n", 50)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_one_pass_audit_says_what_validate_says(spark):
    works = spark.createDataFrame([("W1",), ("W1",), (None,), ("W3",)], "id string")
    access = spark.createDataFrame([("W1", "gold"), ("W2", "odd"), ("W2", None), (None, "odd")], "work_id string, oa_status string")
    people = spark.createDataFrame(
        [("W1", "A1", "first"), ("W1", "A1", "second"), ("W9", "A2", None)], "work_id string, author_id string, author_position string"
    )
    tables = {"works": works, "works_open_access": access, "works_authorships": people}
    got = _rows(audit(tables))
    assert got == _rows(validate(tables)) and ("works_authorships", "check:author_position", 1) in got
    assert _rows(audit({"works_open_access": access})) == _rows(validate({"works_open_access": access}))
    plan = audit(tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(c#") <= 3 and "partial_sum" in plan


def test_audit_of_every_table_of_the_model(spark):
    """All tables, references and keys at once; of empty tables nothing is bad."""
    tables = {n: spark.createDataFrame([], t.ddl) for n, t in TABLES.items()}
    found = audit(tables).collect()
    assert len({r.table_name for r in found}) == len(TABLES) and not any(r.n_bad for r in found)
    assert sum(r.constraint.startswith("foreign_key") for r in found) == sum(len(t.references) for t in TABLES.values())


def test_odd_names_of_files(spark, tmp_path):
    names = ["a[1].gz", "b{x,y}.gz", "c%41.gz", "d*?.gz", "e.gz"]
    for name in names:
        spark.createDataFrame([(name,)], "value string").coalesce(1).write.mode("overwrite").text(str(tmp_path / "one"), compression="gzip")
        (tmp_path / "all").mkdir(exist_ok=True)
        shutil.copy(next((tmp_path / "one").glob("*.gz")), tmp_path / "all" / name)
    found = [str(tmp_path / "all" / n) for n in names]
    for n, file in zip(names, found, strict=True):
        assert [r.value for r in scan_lines(spark, str(tmp_path / "all"), files=[file.replace("%", "%25")]).collect()] == [n]
    assert literal("plain/name.gz") == "plain/name.gz"
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "t[1]{a}.csv").write_text("a,b\n1,x\n")
    (tmp_path / "csv" / "plain.csv").write_text("b\ny\n")
    assert _rows(scan_csv(spark, str(tmp_path / "csv"), "a int, b string")) == [(1, "x"), (None, "y")]


def test_lost_child_values_reach_the_quarantine(spark, tmp_path):
    root = str(tmp_path / "root")
    bad = {"id": "A1", "counts_by_year": [{"year": 2021.5, "works_count": 3.9, "cited_by_count": "many"}, "x"], "x_concepts": "none", "created_date": "soon"}
    good = {"id": "A2", "counts_by_year": [{"year": 2020, "works_count": None}, None], "x_concepts": None, "created_date": "2020-01-01", "updated_date": ""}
    ingest_batch(spark, _lines(spark, json.dumps(bad), json.dumps(good)), "authors", root, 0)
    found = spark.read.parquet(f"{root}/quarantine_value_authors/*").select("id", "table_name", "column_name", "pos", "value")
    assert _rows(found) == _rows(spark.createDataFrame([
        ("A1", "authors", "created_date", None, '"soon"'), ("A1", "authors_concepts", "x_concepts", None, '"none"'),
        ("A1", "authors_counts_by_year", "counts_by_year", 1, '"x"'), ("A1", "authors_counts_by_year", "year", 0, "2021.5"),
        ("A1", "authors_counts_by_year", "works_count", 0, "3.9"), ("A1", "authors_counts_by_year", "cited_by_count", 0, '"many"'),
    ], found.schema))


def test_a_folded_log_tells_the_same(spark):
    """Views of random logs are those of their folded form, and folding again changes nothing."""
    import datetime as dt

    for seed in range(3):
        pick, rows = random.Random(seed), []
        for seq in range(300):
            what = pick.choice([*manifest.EVENTS, "done", "in_progress", "in_progress"] if pick.random() < 0.95 else ["reset"])
            if what == "reset" and pick.random() < 0.8:
                what = "done"
            file = None if what in ("entity_done", "reset", "error") else f"f{pick.randint(0, 9)}"
            at = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seq)
            rows.append((seq, pick.choice(["works", "authors"]), None, file, what, at, seq, 0, 0, None))
        log = spark.createDataFrame(rows, manifest.SCHEMA)
        short = manifest.folded(log, kept_errors=20).cache()
        assert short.count() < 300
        for view in (manifest.summary, manifest.state, manifest.completed_files):
            assert _rows(view(short)) == _rows(view(log)), view
        errors = log.where("event in ('error', 'failed')"), short.where("event in ('error', 'failed')")
        assert _rows(manifest.tail_errors(errors[0], 20)) == _rows(manifest.tail_errors(errors[1], 20))
        assert _rows(manifest.folded(short, 20)) == _rows(short)


def test_checkpoints_bound_the_files_of_the_log(spark, tmp_path):
    root = str(tmp_path / "root")
    for n in range(12):
        ingest_batch(spark, spark.createDataFrame([(f"f{n}", _author(f"A{n}", "x"))], "_file string, value string"), "authors", root, P.next_batch(spark, root))
        note(spark, root, "authors", "error", f"problem {n}")
        if n % 4 == 3:
            P.merge(spark, root, "authors_concepts")
            want = {(r.file, r.n_rows) for r in manifest.state(log_of(spark, root)).where("event = 'done'").collect()}
            newest = checkpoint(spark, root)
            assert checkpoint(spark, root) == newest
            assert {(r.file, r.n_rows) for r in manifest.state(manifest_of(spark, root)).where("event = 'done'").collect()} == want and len(want) == n + 1
            assert sum(1 for _ in (tmp_path / "root" / "_manifest").rglob("*.parquet")) <= 3
    assert manifest_of(spark, root).where("event = 'error'").count() == 12
    assert sum(1 for _ in (tmp_path / "root" / "_batches").rglob("*.parquet")) == 1
    assert P.resolve(spark, root, "authors").count() == 12 and P.resolve(spark, root, "authors_concepts").count() == 12


def test_filled_tables_have_statistics(spark, tmp_path):
    root = str(tmp_path / "root")
    path = tmp_path / "snapshot" / "authors" / "updated_date=2024-01-01"
    lines = _lines(spark, _author("A1", "x", "y"), _author("A2"))
    lines.select("value").write.text(str(path), compression="gzip")
    run_entities(spark, str(tmp_path / "snapshot"), root, ("authors",))
    filled = report.fill_tables(spark, root, "filled_test", ["authors", "authors_concepts", "works"])
    assert filled == ["authors", "authors_concepts"]
    got = {r.table_name: r.row_count for r in report.analysed(spark, "filled_test").collect()}
    assert got == {"authors": 2, "authors_concepts": 2}
    assert _rows(spark.table("filled_test.authors_concepts").select("author_id", "concept_id")) == [("A1", "x"), ("A1", "y")]
    spark.sql("CREATE TABLE filled_test.domains (id BIGINT, odd STRING) USING parquet")
    problems = {(r.table_name, r.column_name): r.problem for r in report.compare_with_model(spark, "filled_test").where("table_name in ('authors', 'domains')").collect()}
    assert problems[("domains", "id")] == "type bigint instead of string" and problems[("domains", "odd")] == "unknown"
    assert problems[("domains", "display_name")] == "missing" and not any(t == "authors" for t, _ in problems)
    comments = {r.table_name: r.comment for r in report.described(spark, "filled_test").collect()}
    assert comments["authors"] == TABLES["authors"].comment


def test_the_rest_works_without_the_training_part(tmp_path):
    """A copy of the repository without the subpackage and its tests imports, with all other queries."""
    top = Path(__file__).resolve().parents[1]
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (top / name).exists():
            shutil.copy(top / name, tmp_path / name)
    shutil.copytree(top / "shelfmark", tmp_path / "shelfmark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and not any(n.startswith('op') or n == 'pipeline' for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
