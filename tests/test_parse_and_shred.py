import json
import random
import re

import pytest
from pyspark.sql import functions as F

from shelfmark import workload
from shelfmark.operators.parse import parse_lines
from shelfmark.operators.shred import cut, shape, shred

WELL_FORMED = [
    '{"a":1}', '  {"a":1}  ', "{}", '{"a":1,"a":2}', '{"a":"}]"}', '{"a":"é"}', "[1]", "null",
    "5", '"x"', '{"a":[1,{"b":2}]}',
]
MALFORMED = [
    '{"a":1} x', '{"a":1}{"b":2}', '{"a":1},{"b":2}', '{"a":1}] junk', '{"a":1}] }',
    '{"a":1}} x', '{"a":1},"y":{}} x', '{"a":1},{"b":2}] x', "", "   ", "{bad", "{'a':1}",
    '] , {"a":1}', '{"a":1},', '{"a":1}]', '{"a":1}}', '5,"y":6', '{"a":1}//c',
    '{"a":1},"_":2', "1] }",
]


def test_malformed_lines(lines):
    rows = parse_lines(lines(*WELL_FORMED, *MALFORMED)).select("_row", "status").collect()
    bad = {r._row for r in rows if r.status == "malformed"}
    assert len(rows) == len(WELL_FORMED) + len(MALFORMED)
    assert bad == set(range(len(WELL_FORMED) + 1, len(WELL_FORMED) + len(MALFORMED) + 1))


def test_damaged_lines_agree_with_a_json_reader(lines):
    rng = random.Random(11)
    seeds = [json.dumps(RECORD), '{"a":[1,{"b":"x]}"}],"c":null}', '{"a":"\\"}","b":[[],{}]}', "[1,2]", '{"k": 7}']
    texts = []
    for _ in range(3000):
        text = rng.choice(seeds)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice(["", *'{}[],:"0 1ntx\\-.e']) + text[at + rng.randint(0, 1) :]
        texts.append(text)
    rows = parse_lines(lines(*texts)).select("_row", "status").collect()
    for r in rows:
        text = texts[r["_row"] - 1]
        try:
            json.loads(text)
            readable = True
        except ValueError:
            readable = False
        assert (r.status != "malformed") == readable, text


# record, kept in strict mode, kept in lenient mode, row counts in lenient mode
WORKS = [
    ('{"id":"W1"}', True, True, {}),
    ('{"id":"W2","authorships":null}', False, True, {"works_authorships": 0}),
    ('{"id":"W3","locations":[{"source":null}]}', False, True, {"works_locations": 0}),
    ('{"id":"W4","locations":[{"source":{"id":"S1"}},{}]}', True, True, {"works_locations": 1}),
    ('{"id":"W5","locations":null}', False, True, {"works_locations": 0}),
    ('{"id":"W6","locations":null,"primary_location":{"source":{"id":"S1"}}}', True, True,
     {"works_locations": 1}),
    ('{"id":"W7","ids":null}', False, True, {"works_ids": 1}),
    ('{"id":"W8","open_access":null}', False, True, {"works_open_access": 1}),
    ('{"id":"W9","biblio":null}', True, True, {"works_biblio": 0}),
    ('{"id":"W10","mesh":null}', False, True, {"works_mesh": 0}),
    ('{"id":"W11","topics":[{"id":"T1","field":null}]}', False, True, {"works_topics": 1}),
    ('{"id":"W12","topics":[{"id":"T1"}]}', True, True, {"works_topics": 1}),
    ('{"id":"W13","authorships":[{"author":{"id":"A1"},"institutions":null}]}', True, True,
     {"works_authorships": 1}),
    ('{"id":"W14","authorships":[{"author":null}]}', False, True, {"works_authorships": 0}),
    ('{"id":"W15","authorships":[{"raw_affiliation_strings":null}]}', False, True,
     {"works_authorships": 0}),
    ('{"id":"W16","referenced_works":"ab"}', True, True, {}),
    ('{"id":"W17","referenced_works":null}', False, True, {}),
    ('{"id":"W18","concepts":{}}', True, True, {"works_concepts": 0}),
    ('{"id":"W19","counts_by_year":null}', False, True, {"works_counts_by_year": 0}),
    ('{"id":"W20","locations":{"x":1},"primary_location":{"source":{"id":"S1"}}}', False, True,
     {"works_locations": 0}),
    ("[1]", False, False, {}),
    ("null", False, False, {}),
    ('{"title":"no id"}', False, False, {}),
    ('{"id":"W24","locations":[5]}', False, True, {"works_locations": 0}),
    ('{"id":"W25","biblio":[1]}', False, True, {"works_biblio": 1}),
    ('{"id":"W26","biblio":{"x":1}}', True, True, {"works_biblio": 1}),
    ('{"id":"W27","locations":"","primary_location":5}', False, True, {"works_locations": 0}),
    ('{"id":"W28","locations":0}', False, True, {"works_locations": 0}),
    ('{"id":"W29","locations":{}}', True, True, {"works_locations": 0}),
    ('{"id":"W30","authorships":"ab"}', False, True, {"works_authorships": 0}),
    ('{"id":"W31","authorships":[{"author":{"id":"A"},"institutions":["x"]}]}', False, True,
     {"works_authorships": 1}),
    ('{"id":"W32","referenced_works":{"a":1}}', True, True, {}),
]


@pytest.mark.parametrize("mode,column", [("strict", 1), ("lenient", 2)])
def test_record_rejects(lines, mode, column):
    shaped = shape(parse_lines(lines(*[w[0] for w in WORKS])), "works", mode)
    rows = shaped.select("_row", "status").collect()
    kept = {r._row for r in rows if r.status == "ok"}
    expected = {i for i, w in enumerate(WORKS, 1) if w[column]}
    # a record without id has no key; it is set aside in both modes
    assert kept == expected


def test_lenient_rows(lines):
    tables = shred(parse_lines(lines(*[w[0] for w in WORKS])), "works")
    for table in {t for w in WORKS for t in w[3]}:
        got = {r._row: r.n for r in tables[table].groupBy("_row").agg(F.count("*").alias("n")).collect()}
        for i, w in enumerate(WORKS, 1):
            if table in w[3]:
                assert got.get(i, 0) == w[3][table], (table, w[0])
    assert tables["quarantine"].count() == 3
    held = {(r.table_name, r._row) for r in tables["quarantine_child"].collect()}
    assert {("works_locations", 3), ("works_locations", 4), ("works_authorships", 14)} <= held


def test_text_counts_by_mode(lines):
    parsed = parse_lines(lines('{"id":"W16","referenced_works":"ab"}'))
    for mode, n in (("lenient", 0), ("strict", 2)):
        got = cut(shape(parsed, "works", mode), "works", mode).first()
        assert got.referenced_works_count == n


@pytest.mark.parametrize(
    "entity,line",
    [
        ("authors", '{"id":"A1","last_known_institution":null}'),
        ("authors", '{"id":"A2","x_concepts":null}'),
        ("sources", '{"id":"S1","ids":null}'),
        ("institutions", '{"id":"I1","geo":null}'),
        ("institutions", '{"id":"I2","associated_institutions":null}'),
        ("publishers", '{"id":"P1","ids":null}'),
    ],
)
def test_strict_rejects_of_other_entities(lines, entity, line):
    parsed = parse_lines(lines(line))
    assert shape(parsed, entity, "strict").first().status.startswith("strict:")
    assert shape(parsed, entity).first().status == "ok"


def test_geo_row_is_always_made(lines):
    tables = shred(parse_lines(lines('{"id":"I3"}')), "institutions", "strict")
    row = tables["institutions_geo"].first()
    assert row.institution_id == "I3" and row.city is None


RECORD = {
    "id": "W1", "doi": "d1", "title": "T", "publication_year": 2020, "cited_by_count": None,
    "updated": "2024-01-02T00:00:00", "ids": {"mag": "12", "doi": "ignored"},
    "open_access": {"oa_status": "Gold"}, "locations": [],
    "primary_location": {"source": {"id": "S1"}, "is_oa": True},
    "authorships": [
        {"author": {"id": "A1", "display_name": "Ann"}, "author_position": "first",
         "institutions": [{"id": "I1"}, {"id": "I2"}], "raw_affiliation_strings": ["x", "y"]},
        {"author": {"id": "A1", "display_name": "Ann B"}, "author_position": "last"},
    ],
    "topics": [{"id": "T1", "score": 0.5, "field": {"id": "F1", "display_name": "Fd"}}],
    "counts_by_year": [{"year": 2021}, {"year": 2022, "cited_by_count": 3}], "biblio": {},
    "referenced_works": ["W7", "W8", "W7"],
}


def _rows(df, *columns):
    return [tuple(r) for r in df.orderBy("_row", "_pos").select(*columns).collect()]


def test_worked_record(lines):
    t = shred(parse_lines(lines(json.dumps(RECORD))), "works")
    work = t["works"].first()
    assert work.id == "W1" and work.doi == "d1" and work.cited_by_count is None
    assert work.is_retracted is False and work.publication_year == 2020
    assert (work.authors_count, work.topics_count, work.concepts_count) == (2, 1, 0)
    assert work.referenced_works_count == 3 and work.related_works == []
    assert work.abstract_inverted_index is None
    assert str(work.updated_date) == "2024-01-02 00:00:00"
    assert _rows(t["works_ids"], "work_id", "doi", "mag", "pmid") == [("W1", "d1", 12, None)]
    assert _rows(
        t["works_open_access"], "is_oa", "oa_status", "any_repository_has_fulltext"
    ) == [(False, "gold", False)]
    assert _rows(t["works_locations"], "source_id", "is_oa", "is_accepted", "is_published") == [
        ("S1", True, False, False)
    ]
    assert _rows(
        t["works_authorships"], "author_id", "author_position", "raw_author_name",
        "institution_id", "raw_affiliation_string", "is_corresponding", "countries",
    ) == [
        ("A1", "first", "Ann", "I1", "x", False, []),
        ("A1", "last", "Ann B", None, None, False, []),
    ]
    assert _rows(t["works_topics"], "topic_id", "score", "field_display_name", "domain_id") == [
        ("T1", 0.5, "Fd", None)
    ]
    for empty in ("works_concepts", "works_mesh", "works_biblio"):
        assert t[empty].count() == 0
    assert _rows(t["works_counts_by_year"], "year", "cited_by_count") == [(2021, 0), (2022, 3)]
    assert _rows(t["works_referenced_works"], "referenced_work_id") == [("W7",), ("W8",)]


def test_unknown_entity_fails_at_plan_time(lines):
    with pytest.raises(ValueError):
        shred(parse_lines(lines("{}")), "venues")


def test_good_and_quarantined_lines_add_up(lines):
    texts = [*WELL_FORMED, *MALFORMED, *[w[0] for w in WORKS]]
    shaped = shape(parse_lines(lines(*texts)), "works")
    tables = shred(parse_lines(lines(*texts)), "works")
    assert shaped.count() == len(texts)
    assert tables["works"].count() + tables["quarantine"].count() == len(texts)


def test_shaped_form_survives_storage(spark, lines, tmp_path):
    shaped = shape(parse_lines(lines(json.dumps(RECORD), "{bad")), "works")
    shaped.write.parquet(str(tmp_path / "shaped"))
    again = spark.read.parquet(str(tmp_path / "shaped"))
    for table in ("works", "works_locations", "works_authorships", "works_counts_by_year"):
        assert cut(again, table).count() == cut(shaped, table).count()
    plan = cut(again, "works_mesh")._jdf.queryExecution().executedPlan().toString()
    assert "abstract_inverted_index" not in plan and "Python" not in plan


@pytest.mark.parametrize("name", ["q_works", "q_authors", "q_contains", "q_topk_cited"])
def test_records_are_cast_once(spark, small, name):
    plan = workload.QUERIES[name](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"try_variant_get\(framed#\d+, \$\[0\], StructField", plan)) == 1
