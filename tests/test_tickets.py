import random

from pyspark.sql import functions as F

from desksort import taxonomy
from desksort.functions import tickets
from desksort.plans.standardize import standardize_tickets
from tests.conftest import plan


def best_category(text):
    scores = {
        c: sum(len(w.split()) for w in taxonomy.KEYWORDS.get(c, ()) if w in text.lower())
        for c in taxonomy.CATEGORIES
    }
    top = max(scores.values())
    return taxonomy.GENERAL if top == 0 else next(c for c in taxonomy.CATEGORIES if scores[c] == top)


def test_keyword_category_against_a_walk(spark):
    rng = random.Random(3)
    pool = [w for words in taxonomy.KEYWORDS.values() for w in words] + ["zebra", "Hello", "quiet"]
    texts = [" ".join(rng.choices(pool, k=rng.randint(0, 6))) for _ in range(400)]
    texts += ["", "Interest", "because of rapid change"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("l", F.lower("t"))
    got = df.select("t", tickets.keyword_category(F.col("l")).alias("c")).collect()
    assert [r["c"] for r in got] == [best_category(r["t"]) for r in got]


def test_own_word_tables(spark):
    df = spark.createDataFrame([("a ship",), ("a plane",), ("a car",)], "t string")
    own = tickets.keyword_category(
        F.col("t"), {"Sea": ("ship",), "Air": ("plane",)}, ("Air", "Sea"), "Land"
    )
    assert [r[0] for r in df.select(own).collect()] == ["Sea", "Air", "Land"]


def test_first_listed_fragment_wins(spark):
    cases = {
        "Change Request": "How-To / Product Usage Questions",
        "Rapid Delivery": "Integration Issues",
        "Billing Account": "Account Access / Login Issues",
        "GDPR question": "How-To / Product Usage Questions",
        "Enhancements": "Feature Requests",
        "Hardware": None,
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "c string")
    got = df.select("c", tickets.fragment_category(F.col("c")).alias("m")).collect()
    assert {r["c"]: r["m"] for r in got} == cases


def test_priorities(spark):
    cases = {
        "High": "High", "CRITICAL": "High", "urgent": "High", "1": "High", "Normal": "Medium",
        "medium": "Medium", "2": "Medium", "LOW": "Low", "3": "Low", "4": "Medium", None: "Medium",
        "": "Medium", "1.0": "Medium",
    }
    df = spark.createDataFrame([(k,) for k in cases], "p string")
    got = df.select("p", tickets.normalize_priority(F.col("p")).alias("n")).collect()
    assert {r["p"]: r["n"] for r in got} == cases


FEED = [
    (0, "Cannot login", "password wrong", "Hardware", "1"),
    (1, None, "x" * 150, None, None),
    (2, "Only a title", None, "", "low"),
    (3, "  ", "　\n", "Access", "low"),
    (4, None, None, "Access", "low"),
    (5, " ", "text", "Nothing known", "weird"),
]
SCHEMA = "ordinal long, subject string, body string, kind_type string, severity string"


def test_standard_tickets(spark):
    rows = standardize_tickets(spark.createDataFrame(FEED, SCHEMA)).orderBy("ordinal").collect()
    assert [r["ticket_id"] for r in rows] == [f"it_service_{i}" for i in (0, 1, 2, 5)]
    first, second, third, last = rows
    assert first["category"] == "Account Access / Login Issues" and first["priority"] == "High"
    assert second["title"] == "x" * 100 and second["description"] == "x" * 150
    assert second["original_category"] is None and second["priority"] == "Medium"
    assert third["description"] == "Only a title" and third["original_category"] is None
    # A blank title is not an empty one: it stays.
    assert last["title"] == " " and last["category"] == "General Inquiries / Other"
    assert (last["customer_email"], last["customer_name"], last["source"]) == (
        "customer@company.com", "IT User", "kaggle_it_service"
    )


def test_roles_may_be_absent_or_given(spark):
    df = spark.createDataFrame([(0, "Slow timeout", "x")], "ordinal long, document string, n string")
    row = standardize_tickets(df).first()
    assert row["title"] == row["description"] == "Slow timeout"
    assert row["category"] == "Performance Problems" and row["priority"] == "Medium"
    given = {"title": "n", "description": "document", "category": None, "priority": None}
    assert standardize_tickets(df, roles=given).first()["title"] == "x"


def test_standardizing_does_not_shuffle(spark, tmp_path):
    path = str(tmp_path / "feed")
    spark.createDataFrame(FEED, SCHEMA).write.parquet(path)
    df = spark.read.parquet(path)
    assert "Exchange" not in plan(standardize_tickets(df))
    narrow = plan(standardize_tickets(df).select("ticket_id", "priority"))
    assert "kind_type" not in narrow.split("ReadSchema:")[1]
