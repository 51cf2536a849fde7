"""One-pass read QC: the tables of the profile equal those of the single operators."""

import random

import pytest
from pyspark.sql import functions as F

from strandline.operators import readqc as Q


def _reads(spark, mates):
    rng = random.Random(4)
    pool = ["".join(rng.choice("ACGTN") for _ in range(rng.randrange(20, 60))) for _ in range(40)]
    rows = []
    for i in range(400):
        s = rng.choice(pool[:3]) if i % 3 == 0 else rng.choice(pool)
        s = s[:10] + "AGATCGGAAGAG" + s[10:] if i % 7 == 0 else s
        rows.append((f"S{i % 2}", f"r{i}", 1 + i % 2 * (i % 3 > 0), s, "".join(chr(33 + rng.randrange(2, 40)) for _ in s)))
    rows += [("S0", "e", 1, "", ""), ("S1", "n", 1, "NNNNNN", "######"), ("S1", "z", 2, "acgtn", "IIIII")]
    df = spark.createDataFrame(rows, "sample string, read_id string, mate int, seq string, qual string")
    return df if mates else df.drop("mate")


@pytest.mark.parametrize("mates", [False, True])
def test_profile_equals_the_single_operators(spark, mates):
    reads = _reads(spark, mates).cache()
    tables = Q.profile_tables(Q.read_profile(reads).cache())
    for name in ("per_base_quality", "per_read_quality", "per_base_content", "gc_distribution", "per_base_n", "length_distribution",
                 "duplication_levels", "adapter_content", "basic_stats"):
        want = getattr(Q, name)(reads)
        got = tables[name].select(want.columns)
        assert [t for _, t in got.dtypes] == [t for _, t in want.dtypes], name
        rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
        assert rows(got) == rows(want), name


def test_the_reads_are_scanned_once(spark, tmp_path):
    path = str(tmp_path / "reads")
    _reads(spark, True).write.parquet(path)
    profile = Q.read_profile(spark.read.parquet(path))
    plan = profile._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") <= 2
    status = Q.qc_status(spark.read.parquet(path))
    assert "FileScan" not in status._jdf.queryExecution().executedPlan().toString()
    assert status.count() == 8 * spark.read.parquet(path).select("sample", "mate").distinct().count()


def test_overrepresented_by_plain_counts(spark):
    reads = _reads(spark, False)
    want = {}
    for r in reads.collect():
        want.setdefault(r["sample"], []).append(r["seq"])
    got = {(r["sample"], r["seq"]): (r["count"], r["percentage"]) for r in Q.overrepresented_sequences(reads, share=0.02).collect()}
    plain = {(s, q): (v.count(q), round(v.count(q) * 100 / len(v), 6)) for s, v in want.items() for q in set(v) if v.count(q) > 0.02 * len(v)}
    assert got == plain and len(got) > 3
    shuffled = Q._sequence_counts(reads)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(sample" in shuffled and "seq" not in shuffled.split("Exchange")[1].split("\n")[0]


def test_letters_are_counted_before_they_become_rows(spark):
    rows = [("S", "ACGé", "II#I"), ("S", "", ""), ("S", None, None), (None, "AC", "#!"), ("T", "ACGé", "II#I")]
    profile = Q.read_profile(spark.createDataFrame(rows, "sample string, seq string, qual string"))
    want = {}
    for s, seq, qual in rows:
        for i, c in enumerate(seq or ([""] if seq is not None else [])):
            want[s, "b", i + 1, ord(c or "\0")] = want.get((s, "b", i + 1, ord(c or "\0")), 0) + 1
        for i, c in enumerate(qual or ([""] if qual is not None else [])):
            want[s, "q", i + 1, ord(c or "\0") - 33] = want.get((s, "q", i + 1, ord(c or "\0") - 33), 0) + 1
    assert {tuple(r)[:4]: r["n"] for r in profile.where("kind in ('b', 'q')").collect()} == want
    assert "Generate" not in profile._jdf.queryExecution().executedPlan().toString()
