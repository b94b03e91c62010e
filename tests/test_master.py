"""The master's commands end to end."""

import json

import pytest

from biblioforge.__main__ import main
from biblioforge.operators.master import Master
from biblioforge.streaming.incremental import stream_to_master


def flat(title, isbn=None, author="Ann Lee", **more):
    return {"record_id": title, "title": title, "authors": [author], "publisher": "P", "segment": "s", "language": "en", "format": "pdf", "isbn_or_issn": isbn, "data_source": more.pop("source", "a"), **more}


def lines(path, rows):
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in rows) + "\n")
    return str(path)


def test_master_commands(spark, tmp_path, capsys):
    root = str(tmp_path / "master")
    one = lines(tmp_path / "one_v2.jsonl", [flat("Bond Markets", "9781234567890"), "oops", flat("Bond Market", source="b"), flat("Tax Law"), "", flat("Risk", "9781111111111")])
    two = lines(tmp_path / "two_v2.jsonl", [flat("Quite Else", "9781234567890", format="ebook", source="c"), flat("TAX law, 2nd edition", source="d"), flat("New Bookings"), flat("New Booking")])
    told = lambda: dict(x.split("=") for x in capsys.readouterr().out.split() if "=" in x)
    main(["init", one, "--master", root])
    assert told() == {"before": "0", "added": "3", "merged": "1", "version": "1"}
    with pytest.raises(SystemExit):
        main(["init", one, "--master", root])
    main(["add", two, "--master", root])
    assert told() == {"before": "3", "added": "1", "merged": "3", "version": "2"}
    works = {w.title: w for w in Master(spark, root).load().collect()}
    assert set(works) == {"Bond Markets", "Tax Law", "Risk", "New Bookings"}
    assert works["Bond Markets"].data_sources == ["a", "b", "c"] and [f.format_type for f in works["Bond Markets"].editions[0].formats] == ["other", "ebook"]
    assert sorted(e.edition_number for e in works["Tax Law"].editions) == [1, 2]
    main(["rebuild", str(tmp_path), "--pattern", "*_v2.jsonl", "--master", root])
    assert told() == {"before": "0", "added": "4", "merged": "4", "version": "3"}
    assert {w.title for w in Master(spark, root).load().collect()} == set(works)
    main(["add", one, "--no-convert-v1", "--master", root])
    assert told()["added"] == "0"
    entry = {"isbn": "9782222222222", "price": {"amount": 3.0, "currency": "USD"}, "title": "Tax Law"}
    volumes = lines(tmp_path / "volumes", [{"title": "Tax Law", "ord": 1, "entry": entry}])
    main(["enrich", "--master", root, "--catalogue", str(tmp_path / "none"), "--volumes", volumes, "--dry-run"])
    assert "isbn:volumes" in capsys.readouterr().out
    main(["enrich", "--master", root, "--catalogue", str(tmp_path / "none"), "--volumes", volumes])
    taxed = next(w for w in Master(spark, root).load().collect() if w.title == "Tax Law")
    assert "9782222222222" in [f.isbn for e in taxed.editions for f in e.formats]
    capsys.readouterr()
    actions = lines(tmp_path / "actions", [{"work_id": works["Risk"].work_id, "action": "DELETE_FROM_MASTER"}, {"work_id": taxed.work_id, "action": "UPDATE_SEGMENT", "new_segment": "T", "new_subsegment": "U"}])
    main(["review", actions, "--master", root])
    now = {w.title: w.segment for w in Master(spark, root).load().collect()}
    assert now == {"Bond Markets": "s", "Tax Law": "T", "New Bookings": "s"}
    main(["restore", "2", "--master", root])
    assert {w.title for w in Master(spark, root).load().collect()} == set(works)
    main(["export", "--master", root, "--out", str(tmp_path / "out")])
    assert spark.read.json(str(tmp_path / "out")).count() == 4


def test_deliveries_through_a_stream(spark, tmp_path):
    work = lambda n, title, isbn: {"work_id": f"w{n}", "title": title, "language": "en", "editions": [{"edition_number": 1, "is_latest": True, "formats": [{"format_type": "pdf", "isbn": isbn}]}], "data_sources": [f"s{n}"]}
    master, folder = Master(spark, str(tmp_path / "m")), tmp_path / "in"
    folder.mkdir()
    lines(folder / "a.json", [work(1, "Bond Markets", "9781234567890"), work(2, "Risk", None)])
    run = lambda: stream_to_master(spark, str(folder), master, str(tmp_path / "state"), "now")
    assert [(t["added"], t["merged"]) for t in run()] == [(2, 0)]
    assert run() == []
    lines(folder / "b.json", [work(3, "Other Title", "9781234567890"), work(4, "Tax Law", None)])
    assert [(t["before"], t["added"], t["merged"]) for t in run()] == [(2, 1, 1)]
    assert {w.work_id: w.data_sources for w in master.load().collect()} == {"w1": ["s1", "s3"], "w2": ["s2"], "w4": ["s4"]}


def test_validate_command(spark, tmp_path, capsys):
    good = {"work_id": "a_1", "title": "t", "language": "en", "publisher": "p", "segment": "s", "subsegment": "u", "perspective": "theory", "dataset_status": "draft", "editions": [{"edition_number": 1, "publication_year": 2000, "is_latest": True, "formats": [{"format_type": "pdf"}]}]}
    main(["validate", lines(tmp_path / "good", [good, "", good])])
    assert "(2 records)" in capsys.readouterr().out
    bad = json.loads(json.dumps(good)) | {"language": "xx"}
    bad["editions"][0]["formats"][0]["format_type"] = "stone"
    with pytest.raises(SystemExit, match="2 error"):
        main(["validate", lines(tmp_path / "bad", [good, bad])])
    out = capsys.readouterr().out
    assert "Line 2: $.editions[0].formats[0].format_type:" in out and "Line 2: $.language:" in out
    schema = lines(tmp_path / "schema", [{"type": "object", "required": ["zz"]}])
    with pytest.raises(SystemExit, match="1 error"):
        main(["validate", lines(tmp_path / "one", [good]), "--schema", schema])
