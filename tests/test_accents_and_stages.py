"""Accents are looked for where they can be, and a job's stages go when it is done."""

import os

from pyspark.sql import functions as F

from desksort.operators import features
from desksort.session import materialize, staged


def test_only_other_characters_are_held_against_long_forms(spark):
    rows = [("plain text " * 50,), ("ﬁne café " * 3,), ("½ cup, 한글",), ("",), ("été",)]
    df = spark.createDataFrame(rows, "t string")
    found = [r[0] for r in df.select(features.strip_accents(F.col("t"))).collect()]
    assert found[:2] == ["plain text " * 50, "fine cafe " * 3]
    assert found[2].startswith("1⁄2 cup, ") and len(found[2]) == len("1⁄2 cup, ") + 6
    assert found[3:] == ["", "ete"]
    # The class of hundreds of ranges sees what is left of the text without ASCII.
    said = df.select(features._apart(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace(t" in said


def test_a_stage_goes_after_its_block(spark):
    with staged(spark.range(5)) as rows:
        folder = os.path.dirname(rows.inputFiles()[0]).removeprefix("file:").replace("//", "/")
        assert os.path.isdir(folder) and rows.count() == 5
    assert not os.path.exists(folder)


def test_stages_of_text_are_packed_closely(spark):
    text = F.concat_ws(" ", *[F.md5((F.col("id") * 7 + i).cast("string")) for i in range(8)])
    files = materialize(spark.range(2000).select(text.alias("t")).coalesce(1)).inputFiles()
    assert files and all(".zstd." in f for f in files)
