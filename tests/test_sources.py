"""Delimited ingestion edge cases (FIXTURES §F2), label files (§F6), result documents (§F5)."""
import json
import os

import pytest

from stratum.plans import publish as pb
from stratum.session import scratch_path
from stratum.sources import delimited as dl, sinks


def _folder(spark, name):
    d = scratch_path(spark, name).removeprefix("file://").removeprefix("file:")
    os.makedirs(d)
    return d


def _write(spark, name, text):
    d = _folder(spark, name)
    with open(os.path.join(d, "data.csv"), "w") as f:
        f.write(text)
    return d


def test_read_delimited_rules(spark):
    text = ('"id" ;" first   name" ;value;value;note\n'
            "1;ann;1.5;2;NA\n"
            "2;bob;N/A;3;x\n"
            "3;cy;2.5;4;y;EXTRA\n"      # over-long: dropped
            "4;dee;#N/A\n"              # short: padded
            "\n")
    path = _write(spark, "delim", text)
    df = dl.read_delimited(spark, path)
    assert df.columns == ["id", "first name", "value", "note"]   # duplicate 'value.1' dropped
    rows = {r["id"]: r for r in df.collect()}
    assert set(rows) == {"1", "2", "4"}
    assert rows["1"]["note"] is None and rows["2"]["value"] is None
    assert rows["4"]["value"] is None and rows["4"]["note"] is None


def test_quoted_separators_and_rows_like_the_header(spark):
    text = 'name;note\n"Smith; John";a\nname;note\n"x;y;z";"q"";r"\na;b;c\n'
    rows = [tuple(r) for r in dl.read_delimited(spark, _write(spark, "quoted", text)).collect()]
    assert sorted(rows) == sorted([("Smith; John", "a"), ("name", "note"), ("x;y;z", 'q";r')])


def test_every_file_loses_its_header_once(spark):
    d = _folder(spark, "parts")
    for i, text in enumerate(("a,b\n1,2\n", "\na,b\n3,4\na,b\n", "5,6\n")):
        with open(os.path.join(d, f"part-{i}.csv"), "w") as f:
            f.write(text)
    got = sorted(tuple(r) for r in dl.read_delimited(spark, d, sep=",").collect())
    assert got == [("1", "2"), ("3", "4"), ("5", "6"), ("a", "b")]


def test_quoted_fields_with_line_ends(spark):
    """Against Python's csv module, with splits of 64 bytes, so that records cross splits."""
    import csv
    import io
    import random
    rng = random.Random(5)
    cell = lambda: "".join(rng.choice(["a", "b", ";", '"', "\n", "\n\n", " x"]) for _ in range(rng.randint(0, 12)))
    files, want = [], []
    for _ in range(3):
        rows = [(f"k{rng.random()}", cell(), "z" + cell()) for _ in range(60)]
        out = io.StringIO()
        w = csv.writer(out, delimiter=";", lineterminator="\n")
        w.writerows([("key", "note", "more"), *rows])
        files.append(out.getvalue())
        want += [tuple(None if v.strip(" ") in dl.NA_TOKENS else v for v in r) for r in rows]
    d = _folder(spark, "line-ends")
    for i, text in enumerate(files):
        with open(os.path.join(d, f"part-{i}.csv"), "w") as f:
            f.write(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
        df = dl.read_delimited(spark, d, sep=";", quoted_line_ends=True)
        assert spark.read.text(d).rdd.getNumPartitions() > 30
        got = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    key = lambda r: tuple(v or "" for v in r)
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_quoted_line_ends_at_the_limits(spark, monkeypatch, broadcast):
    """Blank splits before the header, records of exactly ``max_lines`` lines over many splits, joined counts and shuffled ones."""
    monkeypatch.setattr(dl, "BROADCAST_SPLITS", broadcast)
    long = "\n".join(f"line {i}" for i in range(20))
    text = "\n" * 90 + f'a;b\n1;"{long}"\n2;"{long}\nmore"\na;b\n3;"x\n\ny"\n'
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "32")
        read = lambda n: [tuple(r) for r in dl.read_delimited(spark, _write(spark, f"limits{n}", text), sep=";", quoted_line_ends=True, max_lines=n).collect()]
        assert sorted(read(21)) == [("1", long), ("2", long + "\nmore"), ("3", "x\n\ny"), ("a", "b")]
        torn = read(20)  # the second record's 21 lines stay single
        assert ("1", long) in torn and ("line 7", None) in torn and ("a", "b") in torn and len(torn) == 24
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_long_quoted_fields(spark):
    text = 'a;b\n1;"' + 'x;""y' * 40_000 + '"\n2;z\n'
    rows = {r["a"]: r["b"] for r in dl.read_delimited(spark, _write(spark, "long", text), sep=";").collect()}
    assert rows == {"1": 'x;"y' * 40_000, "2": "z"}


def test_stray_quotes_leave_lines_single(spark):
    odd = _write(spark, "stray", 'a;b\n1;5" pipe\n2;y\n3;z\n')           # marks do not pair up
    rows = {r["a"]: r["b"] for r in dl.read_delimited(spark, odd, quoted_line_ends=True).collect()}
    assert set(rows) == {"1", "2", "3"} and rows["3"] == "z"
    far = _write(spark, "far", 'a;b\n1;5" pipe\n' + "".join(f"{i};y\n" for i in range(2, 9)) + '9;6" pipe\n')
    rows = {r["a"]: r["b"] for r in dl.read_delimited(spark, far, quoted_line_ends=True, max_lines=5).collect()}
    assert set(rows) == {str(i) for i in range(1, 10)} and rows["5"] == "y"
    empty = _write(spark, "none", "a;b\n")
    assert dl.read_delimited(spark, empty, quoted_line_ends=True).count() == 0


def test_sniffing_counts_header_columns():
    assert dl.sniff_separator(["a;b", "1;some, text, with, commas", "2;x"]) == ";"


def test_validation_scores_of_documents(spark):
    d = _folder(spark, "val-docs")
    with open(os.path.join(d, "stacking.json"), "w") as f:
        json.dump({"method": "m", "threshold": 0.5, "predictions": {"validation": [0.2, 0.7], "test": [0.9]}}, f)
    read = lambda part: [(r.position, r.proba, r.pred) for r in sinks.read_predictions_json(spark, d, part=part).collect()]
    assert sorted(read("validation")) == [(0, 0.2, 0), (1, 0.7, 1)] and read("test") == [(0, 0.9, 1)]


def test_separator_sniffing():
    assert dl.sniff_separator(["a,b,c", "1,2,3"]) == ","
    assert dl.sniff_separator(["a\tb\tc", "1\t2\t3"]) == "\t"
    assert dl.sniff_separator(["a|b", "1|2"]) == "|"
    assert dl.sniff_separator(["abc", "123"]) is None


def test_clean_and_duplicate_names():
    assert dl.clean_column_names(['  "a  b" ', "c"]) == ["a b", "c"]
    assert dl.drop_duplicate_columns(["a", "b", "a.1", "c.1"]) == [0, 1, 3]


def test_single_column_split(spark):
    path = _write(spark, "single", "1\t2\t3\n4\t5\t6\n")
    df = dl.split_single_column(spark.read.text(path))
    assert df.columns == ["X1", "X2", "X3"]
    assert sorted(tuple(r) for r in df.collect()) == [("1", "2", "3"), ("4", "5", "6")]


def _labels(spark, lines):
    return _write(spark, "sub", "\n".join(lines) + "\n")


def test_validate_submission_cases(spark):
    good = ["ad."] * 5 + ["noad."] * 15
    assert pb.validate_submission(spark, _labels(spark, good), 20).first()["valid"]
    assert not pb.validate_submission(spark, _labels(spark, good[:-1]), 20).first()["valid"]
    r = pb.validate_submission(spark, _labels(spark, good[:3] + ["maybe"] + good[4:]), 20).first()
    assert not r["valid"] and r["first_bad_line"] == 4 and r["first_bad_value"] == "maybe"
    assert pb.validate_submission(spark, _labels(spark, good[:10] + [""] + good[10:]), 20).first()["valid"]
    r = pb.validate_submission(spark, _labels(spark, ["outcome"] + good), 20).first()
    assert not r["valid"] and r["first_bad_line"] == 1


def test_read_predictions_json(spark):
    d = _folder(spark, "docs")
    doc = {"method": "stacking_refit", "threshold": 0.2,
           "performance": {"f1_score_val": 0.9, "f1_score_test": 0.9077, "precision_test": 0.9672,
                           "recall_test": 0.8551, "confusion_matrix_test": [[421, 2], [10, 59]]},
           "predictions": {"test_proba": [0.1, 0.3, 0.9], "test_pred": [0, 1, 1]}}
    with open(os.path.join(d, "stacking_with_refit_knn.json"), "w") as f:
        json.dump(doc, f, indent=2)
    with open(os.path.join(d, "other.json"), "w") as f:
        json.dump(doc, f)
    p = sinks.read_predictions_json(spark, d).orderBy("position").collect()
    assert [r["proba"] for r in p] == [0.1, 0.3, 0.9] and [r["pred"] for r in p] == [0, 1, 1]
    docs = sinks.read_result_documents(spark, d).first()
    assert docs["f1"] == 0.9077 and docs["threshold"] == 0.2


def test_header_search_sorts_no_lines(spark):
    d = _folder(spark, "headers")
    for name, text in (("a.csv", "\n \nx;y\n1;2\nx;y\n"), ("b.csv", "x;y\n3;4\n"), ("c.csv", "5;6\nx;y\n")):
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    lines = dl._placed(spark.read.text(d)).where("trim(value) <> ''")
    out = dl._without_headers(lines, "x;y", True)
    assert sorted(r.value for r in out.collect()) == ["1;2", "3;4", "5;6", "x;y", "x;y"]
    assert "SortAggregate" not in out._jdf.queryExecution().toString()
