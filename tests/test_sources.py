"""Files: polymorphic JSON, submissions, input selection, versions."""

import json
import random

import pytest
from pyspark.sql import functions as F

from abacist.schemas import RAW_PREFERENCE
from abacist.session import shared_folder
from abacist.sources import json_tables, selection, submission

SAMPLE = """[{"id":0,"question":["a，","b"],"answer":85,"chosen":"x\\n答案：85"},
 {"id":"1","question":"plain [q","answer":"4.50","chosen":["p","q"]},
 {"id":2,"question":"[lit","answer":4.50,"chosen":"  "},
 {"id":3,"question":"z","answer":85.0}]"""


def test_strings_or_lists(spark, tmp_path):
    path = tmp_path / "sample.json"
    path.write_text(SAMPLE, encoding="utf-8")
    rows = json_tables.read_json_table(spark, str(path), RAW_PREFERENCE).sort("id").collect()
    assert [r.id for r in rows] == ["0", "1", "2", "3"]
    assert [r.question for r in rows] == ["a，b", "plain [q", "[lit", "z"]
    assert [r.answer for r in rows] == ["85", "4.50", "4.50", "85.0"]
    assert [r.chosen for r in rows] == ["x\n答案：85", "pq", "  ", None]


def test_corrupt_lines(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text('{"id":1,"answer":"2"}\n{broken\n', encoding="utf-8")
    kept = json_tables.read_json_table(
        spark, str(path), RAW_PREFERENCE, json_array=False, keep_corrupt=True
    )
    assert kept.cache().where("_corrupt_record is not null").count() == 1
    strict = json_tables.read_json_table(spark, str(path), RAW_PREFERENCE, json_array=False)
    with pytest.raises(Exception):
        strict.collect()


def test_submission_file(spark, tmp_path):
    rows = spark.createDataFrame([(0, "85"), (1, "0")], "id int, prediction string")
    submission.write_submission(rows, str(tmp_path / "out"), single_file=True)
    [part] = (tmp_path / "out").glob("part-*.csv")
    lines = part.read_text(encoding="utf-8").splitlines()
    assert lines[0] == "id,ret" and sorted(lines[1:]) == ["0,85", "1,0"]


def test_first_existing_and_names(spark, tmp_path):
    here, missing = str(tmp_path), str(tmp_path / "none")
    assert selection.first_existing(spark, [missing, here]) == here
    assert selection.first_existing(spark, [missing, missing + "2"]) == missing
    paths = {"a": here, "b": [here, missing], "c": [here, here]}
    assert selection.existing_names(spark, paths) == ["a", "c"]


def test_latest_version_is_numeric(spark, tmp_path):
    for name, complete in (("checkpoint-900", True), ("checkpoint-1000", True), ("checkpoint-2000", False), ("final", True)):
        (tmp_path / name).mkdir()
        if complete:
            (tmp_path / name / "state").write_text("x")
    found = selection.latest_version_path(spark, str(tmp_path), "state")
    assert found.endswith("checkpoint-1000")
    assert selection.latest_version_path(spark, str(tmp_path)).endswith("checkpoint-2000")
    assert selection.latest_version_path(spark, str(tmp_path / "none")) is None
    names = spark.createDataFrame([("checkpoint-900",), ("checkpoint-1000",), ("final",)], "name string")
    assert selection.latest_version(names, "name").first().name == "checkpoint-1000"


def test_derive_again_when_blank(spark):
    path = shared_folder(spark, "derive")
    blank = spark.createDataFrame([("1", " ")], "id string, cot string")
    blank.write.parquet(path)
    good = spark.createDataFrame([("1", "x")], "id string, cot string")
    found = selection.derive_if_absent(spark, path, lambda: good)
    assert found.first().cot == "x"
    again = selection.derive_if_absent(spark, path, lambda: blank)
    assert again.first().cot == "x"


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark, "a").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark, "a") != shared_folder(spark, "a")


def test_write_if_absent(spark):
    path = shared_folder(spark, "once")
    selection.write_if_absent(spark.range(3), path)
    selection.write_if_absent(spark.range(9), path)
    assert spark.read.parquet(path).agg(F.count("*")).first()[0] == 3


def test_half_written_and_foreign_tables(spark, tmp_path):
    path, good = str(tmp_path / "t"), spark.createDataFrame([(1, "x")], "id int, cot string")
    good.write.parquet(path)
    (tmp_path / "t" / "_SUCCESS").unlink()
    selection.write_if_absent(spark.createDataFrame([(2, "y")], "id int, cot string"), path)
    assert spark.read.parquet(path).first().id == 2
    selection.write_if_absent(good, path)
    assert spark.read.parquet(path).first().id == 2
    other = str(tmp_path / "other")
    spark.range(5).write.parquet(other)
    with pytest.raises(ValueError):
        selection.derive_if_absent(spark, other, lambda: good)
    assert spark.read.parquet(other).count() == 5
    blank = str(tmp_path / "blank")
    spark.createDataFrame([(1, " ")], "id int, cot string").write.parquet(blank)
    assert selection.derive_if_absent(spark, blank, lambda: good).first().cot == "x"


def read_array(spark, path, **options):
    return json_tables.read_json_table(spark, str(path), RAW_PREFERENCE, **options)


def test_arrays_are_read_by_many_tasks(spark, tmp_path):
    rng = random.Random(3)
    bits = ["}", "{", "]", "[", '"', "\\", "\\\"", "},{", "\n", "a", "é", "答案", ",", "]}", " "]
    rows = []
    for number in range(600):
        text = "".join(rng.choices(bits, k=rng.randrange(30)))
        rows.append({"id": str(number), "question": rng.choice([text, [text, text[::-1]]]), "answer": text, "chosen": text * rng.randrange(9)})
    (tmp_path / "in").mkdir()
    for name, indent in (("a.json", None), ("b.json", 2)):
        (tmp_path / "in" / name).write_text(json.dumps(rows, ensure_ascii=False, indent=indent), encoding="utf-8")
    wanted = sorted((r["id"], "".join(r["question"]), r["answer"], r["chosen"]) for r in rows * 2)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("1021", before):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0" if size != before else "4m")
        try:
            raw = spark.read.option("lineSep", "}").text(str(tmp_path / "in"))
            assert size == before or raw.rdd.getNumPartitions() > 10
            found = read_array(spark, tmp_path / "in").select("id", "question", "answer", "chosen")
            assert sorted(map(tuple, found.collect())) == wanted
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
            spark.conf.set("spark.sql.files.openCostInBytes", "4m")


@pytest.mark.parametrize(
    "text, ids",
    [
        ("[]", []),
        (" [ ] \n", []),
        ('{"id": 5, "question": "x}"}', ["5"]),
        ('\n{"id": 5}\n', ["5"]),
        ('[{"id":1},{"id":2,"extra":{"a":[{"b":"}]"}]}}]', ["1", "2"]),
        ('[\n {"id":1} , \n{"id":"a\\"}"}\n]\n', ['a"}', "1"]),
        ("[{}]", [None]),
    ],
)
def test_small_arrays(spark, tmp_path, text, ids):
    path = tmp_path / "one.json"
    path.write_text(text, encoding="utf-8")
    assert sorted((r.id for r in read_array(spark, path).collect()), key=str) == sorted(ids, key=str)


@pytest.mark.parametrize("text", ['[{"id":1},{"id":2', '[{"id":1} {"id":2}]', '[{"id":1},{"id":}]', '[{"id":1},{"a":[}]'])
def test_malformed_arrays(spark, tmp_path, text):
    path = tmp_path / "bad.json"
    path.write_text(text, encoding="utf-8")
    with pytest.raises(Exception):
        read_array(spark, path).collect()
    kept = read_array(spark, path, keep_corrupt=True).collect()
    assert [r.id for r in kept if r._corrupt_record is None] == ["1"]
    assert any(r._corrupt_record for r in kept)
