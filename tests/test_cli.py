import json

from biblioforge.__main__ import main


def test_commands(spark, tmp_path, capsys):
    main(["queries"])
    assert "coverage" in capsys.readouterr().out.split()
    flat = tmp_path / "v1.jsonl"
    rows = [{"record_id": str(i), "title": f"Title {i}", "authors": ["A"], "publisher": "P", "segment": "s", "isbn_or_issn": "9781234567890", "source_url": "http://x"} for i in range(3)]
    flat.write_text("\n".join(map(json.dumps, rows)) + "\nnot json\n")
    main(["convert", str(flat), "--out", str(tmp_path / "v2")])
    main(["merge", str(tmp_path / "v2"), str(tmp_path / "v2"), "--out", str(tmp_path / "merged")])
    merged = spark.read.json(str(tmp_path / "merged"))
    assert merged.count() == 3 and set(merged.columns) >= {"work_id", "editions"}
    main(["flatten", str(tmp_path / "v2"), "--out", str(tmp_path / "tables")])
    assert spark.read.parquet(str(tmp_path / "tables" / "works")).count() == 3
    main(["stats", str(tmp_path / "merged")])
    assert "|3    |3       |3      |" in capsys.readouterr().out
