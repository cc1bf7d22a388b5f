"""JSON documents cut into parts: the same rows and rejects as whole ones give."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from ledgerlens.plans.reports import flatten_traffic, traffic_schema
from ledgerlens.sources import json_documents, json_parts, json_rejects, read_json_documents, read_json_parts
from ledgerlens.sources.documents import Cut
from ledgerlens.sources.files import CORRUPT

ITEM = {"parentAsin": "P", "childAsin": 'C "[{,\\', "trafficByAsin": {"sessions": 3}, "salesByAsin": None}
GOOD = json.dumps({"spec": {"a": [1, {"b": "]"}]}, "salesAndTrafficByAsin": [ITEM, {}, None, ITEM], "byDate": [[1, 2], "x,y"], "n": 1})
DOCUMENTS = {
    "good": GOOD, "indented": json.dumps(json.loads(GOOD), indent=3), "empty array": '{"salesAndTrafficByAsin": [ ]}', "no array": "{}",
    "null": '{"salesAndTrafficByAsin": null}', "single quotes": "{'salesAndTrafficByAsin': [{'childAsin': 'a\"]b'}]}",
    "more after it": GOOD + "{]", "accents": '{"salesAndTrafficByAsin": [{"childAsin": "ü漢😀"}]}', "empty": "", "blank": " \n ",
    "cut": GOOD[:-30], "cut in a text": GOOD[:100], "cut at the end": GOOD[:-1], "no json": "<html>", "number": "5",
    "number as text": GOOD.replace('"sessions": 3', '"sessions": "many"'), "no list": '{"salesAndTrafficByAsin": 5}',
    "number in the list": GOOD.replace("[{", "[7, {", 1), "list in the list": '{"salesAndTrafficByAsin": [{}, [{}]]}',
    "no comma": GOOD.replace("}, {}", "} {}"), "two commas": GOOD.replace("}, {}", "},, {}"), "last comma": GOOD.replace('"x,y"]', '"x,y",]'),
    "first comma": GOOD.replace("[[1", "[,[1"), "brace for bracket": GOOD.replace('"x,y"]', '"x,y"}'), "bracket for brace": GOOD.replace('"]"}]', '"]"]}'),
    "no colon": GOOD.replace('"n": 1', '"n" 1'), "bad word": GOOD.replace("null", "nul", 1), "number as text, cut": '{"salesAndTrafficByAsin": [{"childAsin": {}},',
    "wrong in another field": GOOD.replace("[1, 2]", "[1 2]"),
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("documents")
    for name, text in DOCUMENTS.items():
        (root / f"{name} 2024-10-20.json").write_bytes(text.encode())
    (root / "latin 2024-10-20.json").write_bytes('{"salesAndTrafficByAsin": [{"childAsin": "ü"}]}'.encode("latin-1"))
    (root / "wide 2024-10-20.json").write_bytes(GOOD.encode("utf-16-le"))
    (root / "packed 2024-10-20.json.gz").write_bytes(gzip.compress(GOOD[:50].encode()) + gzip.compress(GOOD[50:].encode()))
    return str(root)


def _rows(docs):
    return sorted((tuple(map(str, r)) for r in flatten_traffic(docs, "d").select("file_name", "parentAsin", "childAsin", "`trafficByAsin.sessions`").collect()))


@pytest.mark.parametrize("part_bytes", [1, 60, 1 << 16])
def test_parts_give_what_whole_documents_give(spark, folder, part_bytes):
    whole = read_json_documents(spark, folder, traffic_schema(), glob="*.json*")
    parts = json_parts(spark, folder, traffic_schema(), glob="*.json*", part_bytes=part_bytes)
    found = {r.file_name: (r.text, r.reason) for r in json_documents(parts).collect()}
    want = {r.file_name: (r.text, r.reason) for r in json_rejects(whole, ["file_name"]).collect()}
    want = {k: v for k, v in want.items() if not k.startswith("latin")}  # its text depends on how bytes are shown
    assert {k: v for k, v in found.items() if v[1] and not k.startswith("latin")} == want
    assert found["latin 2024-10-20.json"][1]
    assert {r.file_name for r in whole.select("file_name").distinct().collect()} == set(found)
    sound = json_documents(parts).where("reason IS NULL").select("file_name")
    sound_rows = _rows(parts.where("doc IS NOT NULL").join(sound, "file_name", "left_semi"))
    assert sound_rows == _rows(whole.where(F.col(CORRUPT).isNull()).select("file_name", F.struct("salesAndTrafficByAsin").alias("doc")))
    assert len([r for r in sound_rows if r[0].startswith("packed")]) == 4


def test_documents_are_parsed_once(spark, folder):
    docs, rejects = read_json_parts(spark, folder, traffic_schema(), glob="*.json*")
    assert "good 2024-10-20.json" in {r.file_name for r in docs.select("file_name").collect()}
    assert rejects.where("file_name LIKE 'cut%'").count() == 3
    assert "from_json" not in docs._jdf.queryExecution().optimizedPlan().toString()


def test_a_task_holds_no_whole_document():
    """Eight MB of elements pass through a buffer of a part and a chunk."""
    largest, element = 0, b'{"childAsin": "%s"},' % (b"x" * 1000)

    def chunks():
        yield b'{"salesAndTrafficByAsin": ['
        for _ in range(800):
            yield element * 10
        yield b"{}]}"

    cut = Cut(chunks(), 28, part_bytes=5000, most_bytes=40_000)
    n = 0
    for text in cut:
        largest, n = max(largest, len(text)), n + 1
    assert cut.whole and n > 800 and largest < 20_000 and cut.n_chars > 8_000_000
    assert cut.begins == '{"salesAndTrafficByAsin": [{'


def test_an_open_bracket_does_not_gather_the_rest():
    cut = Cut(iter([b'{"a": [', *[b'{"b": 1, ' * 1000] * 50]), 10, part_bytes=100, most_bytes=40_000)
    assert list(cut) == [] and not cut.whole and cut.n_chars == 7 + 50 * 9000
