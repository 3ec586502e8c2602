import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from keyedflow.operators.counts import match_count, partition_word_count, word_count
from keyedflow.operators.each import each
from keyedflow.operators.lines import (
    MATCH, MATCH_FIELDS, MATCH_SUM, PROFILE, keyed_lines, parse_fields, quarantine, rekey_lines,
)
from keyedflow.operators.profile import REFRESH_IDENTITY, profile_days, profile_upsert

GOOD = "a,b,c,d,e,f,g,h,1,20240101"


def lines(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "seq bigint, line string")


@pytest.mark.parametrize(
    "line, good",
    [
        (GOOD, True),
        ("a,b,c,d,e,f,g,h,1,", False),
        ("a,b,c,d,e,f,g,h,,20240101", True),
        (GOOD + ",,,", True),
        (GOOD + ",z", False),
        (GOOD + ",,z", False),
        ("", False),
        (",,,,,,,,,", False),
        (",,,,,,,,,x", True),
        (None, False),
    ],
)
def test_arity(spark, line, good):
    df = lines(spark, line)
    assert parse_fields(df, MATCH_FIELDS).count() == good
    rejected = quarantine(df, PROFILE).collect()
    assert [r.reason for r in rejected] == ([] if good else ["arity"])


def test_one_field_lines(spark):
    df = lines(spark, "", ",,", "a", "a,", "a,b")
    assert [r.v for r in parse_fields(df, ["v"]).orderBy("seq").collect()] == ["", "a", "a"]


def test_good_and_quarantined_lines_are_complements(spark):
    counts = ["", "  ", "+3", "x", "1.5", "99999999999", "7"]
    df = lines(spark, *[f"a,b,c,d,e,f,g,h,{c},d" for c in counts], "short")
    for fmt, bad in ((MATCH, {3, 4, 5, 7}), (MATCH_SUM, {1, 3, 4, 7})):
        good = {r.seq for r in keyed_lines(df, fmt).collect()}
        rejected = {r.seq: (r.line, r.reason) for r in quarantine(df, fmt).collect()}
        assert set(rejected) == bad and good == set(range(8)) - bad
        assert rejected[7] == ("short", "arity")
        assert rejected[3] == ("a,b,c,d,e,f,g,h,x,d", "bad_count")


def test_match_count_keeps_the_first_good_row(spark):
    df = lines(
        spark,
        "a,b,c,d,e,v0,n0,p0,x,d",  # bad count: not the first row
        "a,b,c,d,e,v1,n1,p1,2,d",
        "a,b,c,d,e,v2,n2,p2,,d",
        "ab,,c,d,e,v3,n3,p3,5,d",  # same concatenation, hence the same key
    )
    (row,) = match_count(keyed_lines(df, MATCH)).collect()
    assert (row.uid, row.db, row.ver, row.nation, row.pid, row["count"]) == ("a", "b", "v1", "n1", "p1", 8)


def test_counts_above_32_bits_do_not_wrap(spark):
    df = lines(spark, *["a,b,c,d,e,v,n,p,2147483647,d"] * 3)
    assert match_count(keyed_lines(df, MATCH)).first()["count"] == 3 * 2147483647


def test_profile_upsert_forms(spark):
    df = lines(
        spark,
        "\tu,p0,s,n0,l0,v0,i0,g0,f0,2024-01-01",
        "u,p1,s ,n1,l1,v1,i1,g1,f1,2024-01-02",
        "u,p2,s,n2,l2,v2,i2,g2,f2,2024-01-01",
    )
    rows = keyed_lines(df, PROFILE)
    (keep,) = profile_upsert(rows).collect()
    assert tuple(keep)[1:] == ("\tu", "p2", "s", "n2", "l2", "v2", "i2", "g2", "f0", "2024-01-01")
    (refresh,) = profile_upsert(rows, REFRESH_IDENTITY).collect()
    assert tuple(refresh)[1:] == ("u", "p2", "s", "n2", "l2", "v2", "i2", "g2", "f0", "2024-01-01")
    assert sorted(r.day for r in profile_days(rows).collect()) == ["2024-01-01", "2024-01-02"]


def test_word_counts(spark):
    df = lines(spark, "a\tb\ta\t\t", "", "\t\t", "b")
    assert {r.word: r.n for r in word_count(df).collect()} == {"a": 2, "b": 2, "": 1}
    parts = partition_word_count(df, 4).collect()
    assert sum(r.n for r in parts) == 5 and all(0 <= r.part < 4 for r in parts)


def test_rekey_lines(spark):
    df = lines(spark, "m;NULL,u,a,b,,", "m,u", "m", ",,", "m,,x,,y")
    found = {r.seq: r.line for r in rekey_lines(df, F.lit("k")).collect()}
    assert found == {0: "k,a,b", 1: "k,", 4: "k,x,,y"}


def test_each_with_set_up_and_clean_up(spark, tmp_path):
    log = str(tmp_path / "log")

    def setup():
        return {"prefix": "p-"}

    def cleanup(resource):
        with open(log, "a") as f:
            f.write(resource["prefix"])

    def fn(batch, resource):
        out = batch[["line"]].copy()
        out["line"] = resource["prefix"] + out["line"]
        return out[out["line"] != "p-drop"]

    df = lines(spark, "a", "drop", "b").coalesce(1)
    assert [r.line for r in each(df, fn, "line string", setup, cleanup).collect()] == ["p-a", "p-b"]
    assert open(log).read() == "p-"


def test_random_lines_against_a_plain_reading(spark):
    rng = random.Random(7)
    pieces = [",", ",", ",", "a", "", " ", "7", "+3", "x", "\t", "\u00fc"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(40))) for _ in range(12000)]

    def fields(text):
        parts = text.rstrip(",").split(",")
        return parts if len(parts) == 10 else None

    def count(text):
        if not text.strip():
            return 1
        return int(text) if re.fullmatch("[+-]?[0-9]+", text) and int(text) < 2**31 else None

    df = lines(spark, *texts)
    good = {r.seq: r for r in keyed_lines(df, MATCH).collect()}
    expected = {i: f for i, f in enumerate(map(fields, texts)) if f and count(f[8]) is not None}
    assert set(good) == set(expected) and len(expected) > 100
    for seq, f in expected.items():
        key = "".join(f[:5]).strip("".join(map(chr, range(33))))
        assert good[seq].row_key == hashlib.md5(key.encode()).hexdigest()
        assert [good[seq][c] for c in MATCH_FIELDS] == [*f[:8], count(f[8]), f[9]]
    assert quarantine(df, MATCH).count() == len(texts) - len(expected)
