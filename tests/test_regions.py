"""Interval algebra against position sets; introns of overlapping transcripts."""

import random

import pytest
from pyspark.sql import functions as F

from strandline.operators import regions as RG
from strandline.operators import rseqc as R


def runs(positions):
    out = []
    for p in sorted(positions):
        if out and p == out[-1][1] + 1:
            out[-1][1] = p
        else:
            out.append([p, p])
    return [tuple(r) for r in out]


def intervals(rng, n, top):
    return [(rng.choice("xy"), s, s + rng.randrange(0, rng.choice((3, 40, 400)))) for s in (rng.randrange(-20, top) for _ in range(n))]


@pytest.mark.parametrize("tile", [8, 64, RG.TILE])
def test_union_and_difference_equal_position_sets(spark, tile):
    rng = random.Random(tile)
    a, b = intervals(rng, 40, 1500), intervals(rng, 30, 1500)
    a += [("x", 9, 5), ("z", 8, 23), ("z", 24, 31), ("z", 1, 7)]  # empty, and touching at tile edges
    b += [("z", 16, 23), ("w", 1, 5)]

    def cover(rows, g):
        return {p for k, s, e in rows if k == g for p in range(s, e + 1)}

    def frame(rows):
        return spark.createDataFrame(rows, "g string, start_pos long, end_pos long").repartition(3)

    def got(df):
        return sorted((r["g"], r["start_pos"], r["end_pos"]) for r in df.collect())

    assert got(RG.interval_union(frame(a), group=["g"], tile=tile)) == [(g, *r) for g in "xyz" for r in runs(cover(a, g))]
    assert got(RG.interval_difference(frame(a), frame(b), group=["g"], tile=tile)) == \
        [(g, *r) for g in "xyz" for r in runs(cover(a, g) - cover(b, g))]
    assert got(RG.interval_difference(frame(a), frame(a), group=["g"], tile=tile)) == []
    assert got(RG.interval_union(frame(a).where("false"), group=["g"], tile=tile)) == []


EXONS = "seqid string, transcript_id string, gene_id string, start_pos long, end_pos long"


def test_introns_of_overlapping_transcripts(spark):
    e = spark.createDataFrame([("c", "t1", "g", 1, 100), ("c", "t1", "g", 200, 300), ("c", "t2", "g", 1, 120), ("c", "t2", "g", 200, 300),
                               ("c", "t3", "g", 1, 50), ("c", "t3", "g", 40, 60), ("c", "t3", "g", 61, 70), ("c", "t3", "g", 10, 20),
                               ("d", "t1", "g", 500, 600)], EXONS)
    assert sorted(tuple(r)[1:] for r in RG.introns(e).collect()) == [("t1", 101, 199), ("t2", 121, 199)]
    merged = RG.introns(e.drop("transcript_id").where("seqid = 'c'"))
    assert [tuple(r)[2:] for r in merged.collect()] == [(121, 199)]
    named = spark.createDataFrame([("c", 1, 10, {"Parent": "a,b"}), ("c", 21, 30, {"Parent": "a"}), ("c", 41, 50, {"Parent": "b"})],
                                  "seqid string, start long, end long, attributes map<string,string>")
    assert sorted(tuple(r) for r in RG.introns(named).collect()) == [("c", "a", 11, 20), ("c", "b", 11, 40)]
    assert sorted(tuple(r) for r in RG.gene_introns(e).collect()) == [("c", "g", 121, 199)]


def test_overlapping_introns_are_subtracted_once(spark):
    e = spark.createDataFrame([("c", "t1", "g", 1, 99), ("c", "t1", "g", 201, 400), ("c", "t2", "g", 1, 99), ("c", "t2", "g", 251, 400),
                               ("c", "t3", "g", 90, 300), ("c", "t3", "g", 390, 400)], EXONS)
    pairs = spark.createDataFrame([("s", 1, "c", 59, 281), ("s", 2, "c", 120, 281), ("s", 3, "c", 59, 60), ("s", 4, "c", 20, 500)],
                                  "sample string, frag_id long, ref string, end1 long, pos2 long")
    got = {r["frag_id"]: r["pos2"] for r in R.without_introns(pairs, e).collect()}
    assert got == {1: 281 - 151, 2: 281, 3: 60, 4: 500 - 151 - 89}


def test_all_transcripts_make_junctions_known(spark):
    e = spark.createDataFrame([("c", "t1", "g", 1, 100), ("c", "t1", "g", 200, 300), ("c", "t2", "g", 1, 120), ("c", "t2", "g", 200, 300)], EXONS)
    a = spark.createDataFrame([("s", 1, 0, "c", 91, "10M99N10M"), ("s", 2, 0, "c", 111, "10M79N10M"), ("s", 3, 0, "c", 91, "10M50N10M")],
                              "sample string, frag_id long, flag int, ref string, pos long, cigar string")
    got = {(r["level"], r["category"]): r["count"] for r in R.junction_annotation(a, e).collect()}
    assert got == {("event", "known"): 2, ("junction", "known"): 2, ("event", "partial_novel"): 1, ("junction", "partial_novel"): 1}
    level = R.junction_saturation(a, e, bucket=F.lit(0)).where("level = 100").first()
    assert (level["all_junctions"], level["known"], level["novel"]) == (3, 2, 1)


def test_fragments_meet_by_numbers(spark):
    from strandline.operators import alignment as AL

    rows = []
    for i, (a, b, n) in enumerate([(100, 300, 1), (300, 100, 1), (100, 300, 2), (100, 301, 1), (100, 300, 1)]):
        first = 1 + 64 if i != 1 else 1 + 128
        rows += [("S", i, "c", a, "10M", first, n), ("S", i, "c", b, "10M", 194 - first, n)]
    df = spark.createDataFrame(rows, "sample string, frag_id long, ref string, pos long, cigar string, flag int, base_quality_sum int")
    marked = AL.mark_duplicates(df)
    got = {r["frag_id"] for r in marked.where("duplicate").collect()}
    assert got == {0, 1, 4}  # fragment 2 has the best qualities, 3 ends elsewhere
    assert "collect_list" not in marked._jdf.queryExecution().executedPlan().toString()
