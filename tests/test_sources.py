import json

import pytest

from desksort.operators.ordinal import with_file_ordinal
from desksort.plans.standardize import standardize_csv
from desksort.sinks.tables import write_tickets
from desksort.sources.feeds import detect_columns, read_synthetic, read_ticket_csv
from desksort.sources.payloads import (
    batch_tickets, parse_batches, parse_tickets, rejected_tickets, tickets_from_responses,
    valid_tickets,
)


def test_csv_with_line_breaks_quotes_and_missing_cells(spark, tmp_path):
    path = tmp_path / "tickets.csv"
    path.write_text(
        'Subject,Body,Topic_group,Priority\n'
        '"Broken, again","line one\nline ""two""\r\nthree",Hardware,high\n'
        'NA,text,null,\n'
        '"  padded ","",N/A,n/a\n',
        newline="",
    )
    rows = read_ticket_csv(spark, str(path)).orderBy("ordinal").collect()
    assert [r["ordinal"] for r in rows] == [0, 1, 2]
    assert rows[0]["Subject"] == "Broken, again"
    assert rows[0]["Body"] == 'line one\nline "two"\r\nthree'
    assert (rows[1]["Subject"], rows[1]["Topic_group"], rows[1]["Priority"]) == (None, None, None)
    assert (rows[2]["Subject"], rows[2]["Body"], rows[2]["Topic_group"]) == ("  padded ", None, None)


def test_ordinals_follow_files_by_name_then_row(spark, tmp_path):
    # The largest file is read first, so place in the scan is not file order.
    sizes = {"a": 3, "b": 400, "c": 5, "d": 40}
    want = []
    for name, n in sizes.items():
        lines = [f"{name}{i}" for i in range(n)]
        (tmp_path / f"{name}.csv").write_text("title\n" + "\n".join(lines) + "\n")
        want += lines
    rows = read_ticket_csv(spark, str(tmp_path)).orderBy("ordinal").collect()
    assert [r["title"] for r in rows] == want
    assert [r["ordinal"] for r in rows] == list(range(len(want)))
    first = read_ticket_csv(spark, str(tmp_path), max_rows=10).orderBy("ordinal").collect()
    assert [r["title"] for r in first] == want[:10]


def test_ordinals_of_parquet(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(0, 1000, 1, 7).write.parquet(path)
    rows = with_file_ordinal(spark.read.parquet(path)).orderBy("ordinal").collect()
    assert [r["ordinal"] for r in rows] == list(range(1000))
    assert sorted(r["id"] for r in rows) == list(range(1000))


def test_column_detection():
    found = detect_columns(["ID", "Document", "Topic_group"])
    assert found == {
        "title": None, "description": "Document", "category": "Topic_group", "priority": None
    }
    # Substrings, in file order; one column may serve two roles.
    both = detect_columns(["Subtitle text", "subject", "Ticket_Type", "Urgency (1-3)"])
    assert both == {
        "title": "Subtitle text", "description": "Subtitle text", "category": "Ticket_Type",
        "priority": "Urgency (1-3)",
    }


def test_tickets_written_as_csv_read_back(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    df = spark.createDataFrame([('say "hi"\nthere', "body, text")], "title string, description string")
    write_tickets(df, path, "csv")
    row = read_synthetic(spark, path).first()
    assert (row["title"], row["description"]) == ('say "hi"\nthere', "body, text")
    assert standardize_csv(spark, path).count() == 1


def test_requests(spark):
    good = {"title": "T", "description": "D", "extra": [1]}
    values = [
        json.dumps(good), '{"title": "T"}', '{"title": null, "description": "D"}', "{", "",
        "[1]", '{"title": "", "description": ""}', None, '{"title": "a"} trailing',
        f"{json.dumps(good)}, 1", f"{json.dumps(good)}] x", f"{json.dumps(good)}}} x",
        f'{json.dumps(good)}, "k": 1', f"  {json.dumps(good)}\n",
    ]
    df = spark.createDataFrame(list(enumerate(values)), "id long, value string")
    parsed = parse_tickets(df)
    got = {r["id"]: r["reason"] for r in parsed.collect()}
    assert got == {
        0: None, 1: "missing_field", 2: "missing_field", 3: "invalid_json", 4: "invalid_json",
        5: "missing_field", 6: None, 7: "invalid_json", 8: "invalid_json",
        9: "invalid_json", 10: "invalid_json", 11: "invalid_json", 12: "invalid_json", 13: None,
    }
    assert [r["title"] for r in valid_tickets(parsed).orderBy("id").collect()] == ["T", "", "T"]
    assert rejected_tickets(parsed).columns == ["id", "value", "reason"]


def test_batches_keep_order_and_go_whole(spark):
    ok = {"tickets": [{"title": f"t{i}", "description": "d"} for i in range(5)]}
    bad = {"tickets": [{"title": "t", "description": "d"}, {"title": "t"}]}
    values = [json.dumps(ok), json.dumps(bad), "{}", "nope", '{"tickets": []}']
    df = spark.createDataFrame(list(enumerate(values)), "id long, value string")
    parsed = parse_batches(df)
    assert {r["id"]: r["reason"] for r in parsed.collect()} == {
        0: None, 1: "missing_field", 2: "missing_field", 3: "invalid_json", 4: None
    }
    rows = batch_tickets(parsed, "id").orderBy("id", "pos").collect()
    assert [(r["id"], r["pos"], r["title"]) for r in rows] == [(0, i, f"t{i}") for i in range(5)]


@pytest.mark.parametrize(
    ("content", "want"),
    [
        ('Sure! {"title": "A", "description": "B"} Bye', ("A", "B")),
        ('{"title": "A"}', None),
        ('{"title": "A", "description": ""}', None),
        ("no braces", None),
        ("} backwards {", None),
        ('{"title": "A", "description": "B"} and {"more"}', None),
        ('{\n"title": "A",\n"description": "B {x}"\n}', ("A", "B {x}")),
        (None, None),
    ],
)
def test_responses(spark, content, want):
    df = spark.createDataFrame([(content,)], "content string")
    row = tickets_from_responses(df).first()
    assert (row and (row["title"], row["description"])) == want


def test_missing_cells_are_a_parameter(spark, tmp_path):
    (tmp_path / "t.csv").write_text("title\nNA\n-\n")
    rows = read_ticket_csv(spark, str(tmp_path), missing=["-"]).orderBy("ordinal").collect()
    assert [r["title"] for r in rows] == ["NA", None]
