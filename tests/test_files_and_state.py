import datetime as dt
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import scalars as S
from shelfmark.functions import variants as V
from shelfmark.functions.text import rebuild_text, tokens
from shelfmark.operators import manifest as M
from shelfmark.operators import report, search
from shelfmark.operators.flatten import flatten, write_csv
from shelfmark.operators.merges import cycles, follow, redirect
from shelfmark.operators.parse import parse_lines, records
from shelfmark.operators.publish import resolve
from shelfmark.operators.shred import shred
from shelfmark.operators.upsert import ARRIVAL, upsert
from shelfmark.plans.catalog import ENTITIES, TABLES, ensure_tables
from shelfmark.sources import snapshot
from shelfmark.sources.files import first_lines, scan_csv, scan_log
from shelfmark.streaming.ingest import Progress, ingest_stream, manifest_of
from shelfmark.streaming.runs import flat_load, note, run_entities


def _write(folder, day, name, lines):
    path = folder / f"updated_date={day}"
    path.mkdir(parents=True, exist_ok=True)
    with gzip.open(path / name, "wt") as f:
        f.write("".join(line + "\n" for line in lines))
    # the stream takes files by modification time: one minute per day of the month
    at = 1_700_000_000 + 60 * int(day[-2:])
    os.utime(path / name, (at, at))


@pytest.fixture()
def authors(tmp_path):
    """Three files of authors: new versions, malformed lines, and one beyond its budget."""
    folder = tmp_path / "authors"
    one = [json.dumps({"id": f"A{i}", "works_count": i, "counts_by_year": [{"year": 2020}]}) for i in range(20)]
    two = [json.dumps({"id": f"A{i}", "works_count": 100 + i, "counts_by_year": [{"year": 2021}]}) for i in range(5)]
    _write(folder, "2024-01-01", "a.gz", [*one, "{bad", ""])
    _write(folder, "2024-01-02", "b.gz", [*two, "[1]"])
    _write(folder, "2024-01-03", "c.gz", ['{"id":"A99"}', *["{bad"] * 4])
    return folder


def test_scan_numbers_lines_and_prunes_partitions(spark, authors):
    lines = snapshot.scan_lines(spark, str(authors))
    parsed = parse_lines(lines)
    bad = parsed.where("status = 'malformed'").select("_file", "_row", "raw")
    numbered = snapshot.number_lines(bad, parsed)
    got = sorted((r["_file"].rsplit("/", 1)[1], r.line) for r in numbered.collect())
    assert got == [("a.gz", 21), ("a.gz", 22), *[("c.gz", n) for n in (2, 3, 4, 5)]]
    window = snapshot.scan_lines(spark, str(authors), start="2024-01-02", end="2024-01-02")
    assert window.count() == 6
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(updated_date" in plan


def test_listing_newest_partition_and_new_files(spark, authors):
    files = snapshot.list_files(spark, str(authors), "authors")
    newest = snapshot.latest_partition(files).collect()
    assert [r.file.rsplit("/", 1)[1] for r in newest] == ["c.gz"]
    done = files.where(F.col("file").endswith("a.gz")).first().file
    log = M.event(spark, 1, "authors", "done", dt.datetime(2024, 1, 4), file=done)
    left = sorted(r.file.rsplit("/", 1)[1] for r in M.new_files(files, log).collect())
    assert left == ["b.gz", "c.gz"]
    only = [r.file for r in M.new_files(files, log).collect()]
    assert snapshot.scan_lines(spark, str(authors), files=only).count() == 11


def test_stream_equals_batch(spark, authors, tmp_path):
    root = str(tmp_path / "tables")

    def run(files_per_trigger=1):
        ingest_stream(
            spark, str(authors), "authors", root, f"{root}/_stream", max_errors=4,
            files_per_trigger=files_per_trigger,
        ).awaitTermination()

    listener = Progress()
    spark.streams.addListener(listener)
    run()
    spark.streams.removeListener(listener)
    lines = snapshot.scan_lines(spark, str(authors)).where("_partition < '2024-01-03'")
    batch = shred(parse_lines(lines), "authors")
    for table in ("authors", "authors_counts_by_year"):
        columns = TABLES[table].key + ("works_count",)
        want = upsert(None, batch[table], TABLES[table].key, "last", ARRIVAL).select(*columns)
        # the stream takes files by modification time, here the order of their dates
        got = resolve(spark, root, table).select(*columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    state = {r.file.rsplit("/", 1)[1]: r for r in M.state(manifest_of(spark, root)).collect()}
    assert {f: r.event for f, r in state.items()} == {"a.gz": "done", "b.gz": "done", "c.gz": "failed"}
    assert state["a.gz"].n_rows == 20 and state["a.gz"].n_malformed == 2
    assert state["b.gz"].n_rejected == 1
    before = manifest_of(spark, root).count()
    run()  # nothing new
    assert manifest_of(spark, root).count() == before
    _write(authors, "2024-01-09", "d.gz", ['{"id":"A0","works_count":7}'])
    run()
    assert resolve(spark, root, "authors").where("id = 'A0'").first().works_count == 7
    alerts = report.alerts(report.run_metrics(manifest_of(spark, root)), {"bad_share": 50.0})
    assert [r.file.rsplit("/", 1)[1] for r in alerts.collect()] == ["c.gz"]
    sections = report.run_report(manifest_of(spark, root), {"authors": resolve(spark, root, "authors")})
    assert sections["state"].first().n_files == 3
    assert sections["tables"].first().row_count == 20


def test_run_over_all_entities(spark, authors, tmp_path):
    _write(tmp_path / "topics", "2024-01-01", "t.gz", ['{"id":"T1","display_name":"x","subfield":{"id":"S1"}}'])
    _write(tmp_path / "publishers", "2024-01-01", "p.gz", ['{"id":"P1","ids":{"ror":"r"}}'])
    root = str(tmp_path / "all")
    state = {r.entity: r for r in run_entities(spark, str(tmp_path), root).collect()}
    assert {e: r.status for e, r in state.items()} == dict.fromkeys(state, "completed")
    assert set(state) == {"authors", "topics", "publishers"} and state["authors"].n_files == 3
    assert resolve(spark, root, "topics").first().subfield_id == "S1"
    assert resolve(spark, root, "publishers_ids").first().ror == "r"
    again = {r.entity: r.n_rows for r in run_entities(spark, str(tmp_path), root).collect()}
    assert again == {e: r.n_rows for e, r in state.items()}
    note(spark, root, "topics", "reset")
    assert "topics" in [r.entity for r in M.resume(manifest_of(spark, root)).collect()]


def test_runs_obey_their_state(spark, authors, tmp_path):
    """Failed files are read again, reset ones too, finished ones are not; names may hold blanks."""
    _write(tmp_path / "domains", "2024-01-01", "sp ace+%.gz", ['{"id":"D1","display_name":"x"}'])
    root = str(tmp_path / "all")

    def run():
        state = run_entities(spark, str(tmp_path), root, ("authors", "domains"), max_errors=3, files_per_batch=2)
        return {r.entity: r for r in state.collect()}

    state = run()
    assert state["authors"].status == "in_progress" and state["authors"].n_files == 2
    assert state["domains"].status == "completed" and state["domains"].last_file.endswith("sp%20ace+%25.gz")
    assert resolve(spark, root, "authors").where("id = 'A99'").isEmpty()
    _write(authors, "2024-01-03", "c.gz", ['{"id":"A99"}'])  # mended in place
    before = manifest_of(spark, root).where("event = 'done'").count()
    state = run()
    assert state["authors"].status == "completed" and state["authors"].n_files == 3
    assert resolve(spark, root, "authors").where("id = 'A99'").count() == 1
    assert manifest_of(spark, root).where("event = 'done'").count() == before + 1
    note(spark, root, "domains", "reset")
    _write(tmp_path / "domains", "2024-01-02", "more.gz", ['{"id":"D2"}'])
    state = run()
    assert state["domains"].n_files == 2 and state["domains"].status == "completed"
    assert sorted(r.id for r in resolve(spark, root, "domains").collect()) == ["D1", "D2"]
    log = manifest_of(spark, root)
    assert log.where("event = 'in_progress'").count() == 3 + 1 + 1 + 2 and log.groupBy("seq").count().where("count > 1").isEmpty()


def test_flat_route_clash(spark, tmp_path):
    _write(tmp_path / "flat", "2024-01-01", "a.gz", ['{"a_b":1,"a":{"b":2}}', '{"a":{"b":3},"a_b":4}'])
    rows = flat_load(spark, str(tmp_path / "flat"), str(tmp_path / "csv"), str(tmp_path / "table"), "a_b int")
    assert sorted(r.a_b for r in rows.collect()) == [2, 4]


def test_csv_files_with_different_headers(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "one.csv").write_text('id,name\n1,"a\nb"\n2,c\n')
    (folder / "two x.csv").write_text("extra,id\n0.5,3\n")
    (folder / "three.csv").write_text("id,name\n4,d\n")
    rows = scan_csv(spark, str(folder), "id int, name string, extra double").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "a\nb", None), (2, "c", None), (3, None, 0.5), (4, "d", None)]


def test_headers_come_with_the_listing(spark, tmp_path):
    """No job reads the files for their headers; empty files and others than CSV files give none."""
    folder = tmp_path / "many % x"
    folder.mkdir()
    for i in range(40):
        (folder / f"part {i} [x].csv").write_text("id,näme\r\n" if i % 2 else f"näme,id\nb{i},{i}\n")
    (folder / "none.csv").write_text("")
    (folder / "notes.txt").write_text("id\n7\n")
    spark.sparkContext.setJobGroup("headers", "first lines")
    names = [str(f) for f in sorted(folder.iterdir())]
    assert {h for h in first_lines(spark, names)} == {"id,näme", "näme,id", "id", None}
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    rows = scan_csv(spark, str(folder), "id int, `näme` string").collect()
    assert sorted(map(tuple, rows)) == [(i, f"b{i}") for i in range(0, 40, 2)]


def test_merges_are_unique(spark):
    pairs = [("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("y", "x"), ("z", "x")] * 2
    merged = spark.createDataFrame(pairs, "original_id string, merged_into_id string")
    assert sorted(map(tuple, follow(merged).collect())) == [("a", "d"), ("b", "d"), ("c", "d")]
    assert sorted(r.original_id for r in cycles(merged).collect()) == ["x", "y", "z"]
    facts = spark.createDataFrame([("a", 1), (None, 2), ("q", 3)], "id string, n int")
    assert sorted(map(str, redirect(facts, ["id"], merged).collect())) == sorted(["Row(id='d', n=1)", "Row(id=None, n=2)", "Row(id='q', n=3)"])


def test_search_of_any_script(spark):
    docs = spark.createDataFrame([(1, "Über naïve COVID19 2021 models of dark matter"), (2, "dark"), (3, "uber")], "id int, text string")
    for terms, ids in ((["über"], [1]), (["NAÏVE"], [1]), (["covid19"], [1]), (["2021"], [1]), (["dark matter"], [1]), (["covid"], [])):
        assert sorted(r.id for r in search.keyword(docs, "text", terms).collect()) == ids
    assert sorted(r.id for r in search.keyword(docs, "text", ["dark matter"], "any").collect()) == [1, 2]


def test_flat_route(spark, authors, tmp_path):
    table = str(tmp_path / "flat")
    rows = flat_load(spark, str(authors), str(tmp_path / "csv"), table, "id string, works_count int, gone string")
    assert rows.count() == 26 and spark.read.parquet(table).count() == 26
    assert rows.where("id = 'A3'").agg(F.max("works_count")).first()[0] == 103


def test_state_folds(spark):
    at = dt.datetime(2024, 1, 1)
    steps = [
        ("works", "in_progress", "f1"), ("works", "done", "f1"), ("works", "done", "f1"),
        ("works", "entity_done", None), ("authors", "in_progress", "g1"), ("authors", "done", "g1"),
        ("authors", "reset", None), ("sources", "in_progress", "h1"),
    ]
    log = M.empty(spark)
    for i, (entity, what, file) in enumerate(steps):
        log = log.unionByName(M.event(spark, i, entity, what, at, file=file, n_rows=10))
    got = {r.entity: r for r in M.summary(log).collect()}
    assert set(got) == {"works", "sources"}
    works = got["works"]
    assert (works.status, works.last_file, works.n_files, works.n_reports, works.n_rows) == (
        "completed", "f1", 1, 2, 10,
    )
    assert got["sources"].status == "in_progress"
    order = [r.entity for r in M.resume(log).orderBy("place").collect()]
    assert order == list(ENTITIES)[1:]
    assert M.is_file_done(log, "works", "f1") and not M.is_file_done(log, "authors", "g1")
    assert M.is_entity_done(log, "works") and not M.is_entity_done(log, "sources")
    done = log
    for i, e in enumerate(ENTITIES):
        done = done.unionByName(M.event(spark, 100 + i, e, "entity_done", at))
    assert M.resume(done).count() == len(ENTITIES)  # all completed: start over


def test_initial_state_flags_and_progress(spark):
    at = dt.datetime(2024, 1, 1)
    log = M.empty(spark)
    assert {(r.entity, r.status, r.n_files, r.n_reports, r.n_rows, r.last_file) for r in M.overview(log).collect()} == {
        (e, "not_started", 0, 0, 0, None) for e in ENTITIES
    }
    assert M.progress(log).count() == 0
    steps = [("works", "done", "f1", 0, 10), ("works", "failed", "f2", 299, 5), ("works", "done", "f3", 300, 7), ("works", "entity_done", None, 301, None), ("authors", "done", None, 1, 3)]
    for i, (entity, what, file, after, n) in enumerate(steps):
        log = log.unionByName(M.event(spark, i, entity, what, at + dt.timedelta(seconds=after), file=file, n_rows=n, n_malformed=2 if what == "failed" else None))
    got = {(r.entity, r.n_files, r.n_rows, r.n_bad, r.all_files, r.all_rows) for r in M.progress(log).collect()}
    assert got == {("works", 2, 10, 2, 2, 10), ("works", 1, 7, 0, 3, 17), ("authors", 1, 3, 0, 1, 3)}
    asked = spark.createDataFrame([("works", "f1"), ("works", "f2"), ("sources", "f1"), ("works", None)], "entity string, file string")
    flags = {(r.entity, r.file): (r.file_done, r.entity_done) for r in M.done(asked, log).collect()}
    assert flags == {("works", "f1"): (True, True), ("works", "f2"): (False, True), ("sources", "f1"): (False, False), ("works", None): (False, True)}
    told = report.report_rows(report.run_report(log, {"works": asked}))
    assert {(r.section, r["name"], r.metric, r.value) for r in told.collect()} >= {
        ("tables", "works", "row_count", "4"), ("tables", "works", "size", None), ("state", "works", "status", "completed"), ("errors", "f2", "entity", "works"),
    }


def test_retention(spark):
    names = [
        "state_backup_20240101_000000.json", "state_backup_20240201_120000.json", "junk",
        "state_backup_20240101_0000009.json", "keep_20240101_000000_manual.json",
    ]
    snaps = spark.createDataFrame([(n,) for n in names], "name string")
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    assert [r.name for r in M.expired(snaps, now).collect()] == names[:1]
    assert M.retain_newest(snaps, 1).first().name == names[1]


def test_log_tail(spark, tmp_path):
    old, new = tmp_path / "old.log", tmp_path / "new.log"
    old.write_text("x - ERROR - old\n")
    body = [f"t - {'ERROR' if i in (5, 60, 99) else 'INFO'} - {i}" for i in range(100)]
    new.write_text("\n".join(body) + "\n")
    os.utime(old, (1, 1))
    got = [r.value for r in scan_log(spark, str(tmp_path)).collect()]
    assert got == ["t - ERROR - 60", "t - ERROR - 99"]


def test_flatten(spark):
    texts = ['{"a":{"b":1,"c":{}},"l":[1,{"x":2}],"n":null}', '{"z":"t","a":{"b":2}}']
    lines = spark.createDataFrame([(t,) for t in texts], "value string")
    flat = flatten(records(parse_lines(lines)))
    rows = {r.a_b: r.asDict() for r in flat.drop("_row").collect()}
    assert set(flat.columns) == {"a_b", "l", "n", "z"}
    assert json.loads(rows[1]["l"]) == [1, {"x": 2}] and rows[1]["n"] is None
    assert rows[2] == {"a_b": 2, "l": None, "n": None, "z": "t"}


def test_flatten_name_clash_follows_the_order_of_keys(spark):
    texts = ['{"a_b":1,"a":{"b":2}}', '{"a":{"b":3},"a_b":4}', '{"a_b":5}', '{"a":{"b":6}}']
    df = spark.createDataFrame(list(enumerate(texts)), "_row int, text string").withColumn(
        "v", F.try_parse_json("text")
    )
    got = [r.a_b for r in flatten(df, text="text").orderBy("_row").collect()]
    assert got == [2, 4, 5, 6]
    opaque = flatten(df, opaque=["a"]).orderBy("_row").first()
    assert json.loads(opaque.a) == {"b": 2}


def test_csv_round_trip_by_name(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, 'quote " and, comma', ["x", "y"]), (2, "two\nlines", None), (3, None, [])],
        "id int, name string, tags array<string>",
    )
    write_csv(rows, str(tmp_path / "out"))
    ddl = "tags array<string>, name string, id int, extra double"
    got = scan_csv(spark, str(tmp_path / "out"), ddl).orderBy("id").collect()
    assert [(r.id, r.name, r.tags, r.extra) for r in got] == [
        (1, 'quote " and, comma', ["x", "y"], None), (2, "two\nlines", None, None), (3, None, [], None),
    ]


def test_scalars(spark):
    oa = ["", None, "Gold", "DIAMOND", "other", " gold"]
    df = spark.createDataFrame([(s,) for s in oa], "s string")
    got = [r[0] for r in df.select(S.oa_status(F.col("s"))).collect()]
    assert got == [None, None, "gold", "diamond", "closed", "closed"]
    sizes = [0, 10239, 10240, 10 * 1024**2, 3 * 1024**4]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in sizes], "n bigint").select(S.pretty_size(F.col("n"))).collect()]
    assert got == ["0 bytes", "10239 bytes", "10 kB", "10 MB", "3072 GB"]


def test_variant_functions(spark):
    df = spark.createDataFrame([('{"a":7}',), ('{"a":null}',), ("{}",)], "s string").select(
        F.parse_json("s").alias("v")
    )
    v = F.col("v")
    got = [tuple(r) for r in df.select(
        V.get_default(v, "$.a", "int", 0), V.is_absent(v, "$.a"), V.is_null(v, "$.a"),
        V.json_text(V.child(v, "$.a"), "[]"),
    ).collect()]
    assert got == [(7, False, False, "7"), (None, False, True, None), (0, True, False, "[]")]
    falsy = ["null", "[]", "{}", '""', "0", "0.0", "-0", "false"]
    truthy = ["[0]", '{"a":0}', '"0"', "1", "-1", "0.5", "true", '"false"', '"[]"', '" "']
    df = spark.createDataFrame([(s,) for s in falsy + truthy], "s string").select(
        "s", V.is_falsy(F.parse_json("s")).alias("f")
    )
    assert {r.s for r in df.collect() if r.f} == set(falsy)


def test_search(spark):
    docs = spark.createDataFrame(
        [(1, "The cat, the hat"), (2, "a dog"), (3, None), (4, "cat-dog")], "id int, text string"
    )
    ids = lambda df: sorted(r.id for r in df.collect())
    assert ids(search.keyword(docs, "text", ["CAT", "the"])) == [1]
    assert ids(search.keyword(docs, "text", ["cat", "dog"], "any")) == [1, 2, 4]
    ranked = search.keyword(docs, "text", ["the", "cat"], "any", rank=True)
    assert {r.id: r.hits for r in ranked.collect()} == {1: 3, 4: 1}
    arrays = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"]), (3, None)], "id int, x array<string>")
    assert ids(search.contains(arrays, "x", ["a", "b"])) == [1]
    assert ids(search.contains(arrays, "x", ["a", "b"], "any")) == [1, 2]
    index = spark.sql("SELECT 1 id, map('the', array(0, 3), 'cat', array(1), 'ate', array(2)) m")
    assert index.select(rebuild_text(F.col("m"))).first()[0] == "the cat ate the"
    assert ids(search.has_word(index, "m", "cat")) == [1] and not ids(search.has_word(index, "m", "no"))
    assert docs.select(tokens(F.col("text")).alias("t")).first().t == ["the", "cat", "the", "hat"]


def test_model_and_ddl(spark):
    assert len(TABLES) == 37 and sum(len(t.references) for t in TABLES.values()) == 27
    ensure_tables(spark, "model")
    ensure_tables(spark, "model")  # a second time changes nothing
    found = {r.tableName for r in report.list_tables(spark, "model").collect()}
    assert found == {t.lower() for t in TABLES}
    spark.sql("INSERT INTO model.works (id) VALUES ('W1')")
    row = spark.table("model.works").first()
    assert row.is_retracted is False and row.doi is None
    comment = spark.sql("DESCRIBE TABLE EXTENDED model.works").where("col_name = 'Comment'").first()
    assert comment.data_type == TABLES["works"].comment
    present = {t: [c.name for c in spark.table(f"model.{t}").schema] for t in found}
    assert report.schema_diff(spark, present).count() == 0
    present["works"].remove("doi")
    assert report.schema_diff(spark, present).first().column_name == "doi"
    stats = report.catalog_stats(spark, "model").first()
    assert stats.table_name == "works" and stats.row_count == 1 and stats.in_model
    spark.sql("DROP DATABASE model CASCADE")
