"""Transcript quantification on planted reads and pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from strandline.operators import quant as QU
from strandline.session import ensure_checkpoint_dir


def back(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def dna(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


READS = "sample string, read_id string, seq string"
PAIRS = "sample string, pair_id string, seq1 string, seq2 string"


def transcripts(spark, rows):
    return spark.createDataFrame(rows, "name string, seq string")


def test_ids_with_commas_and_short_reads(spark):
    ensure_checkpoint_dir(spark)
    rng = random.Random(1)
    a, b = dna(rng, 300), dna(rng, 300)
    tx = transcripts(spark, [("t,1", a), ("t,1,2", b)])
    rows = [("S", f"a{i}", a[i * 10:i * 10 + 60]) for i in range(20)] + [("S", f"b{i}", b[i * 9:i * 9 + 60]) for i in range(10)]
    rows += [("S", "short", a[:20]), ("S", "none", dna(rng, 60)), ("S", "null", None), ("S", "n", a[:25] + "N" + a[26:40])]
    reads = spark.createDataFrame(rows, READS)
    got = {r["transcript"]: r for r in QU.quantify_transcripts(reads, tx).collect()}
    assert {t: r["num_reads"] for t, r in got.items()} == {"t,1": 20.0, "t,1,2": 10.0}
    assert all(r["library_type"] == "SF" and r["converged"] for r in got.values())
    assert abs(got["t,1"]["tpm"] - 2e6 / 3) < 1
    frags = QU.mapped_fragments(reads, tx)
    rates = QU.mapping_rates(reads, frags, QU.library_types(frags, paired=False)).first()
    assert (rates["reads"], rates["short"], rates["unmapped"], rates["other_strand"], rates["mapped"]) == (34, 2, 2, 0, 30)


@pytest.mark.parametrize("kind", ["SF", "SR", "U"])
def test_library_type_of_single_reads(spark, kind):
    rng = random.Random(kind)
    t = dna(rng, 500)
    overlap = back(dna(rng, 50) + t[100:300] + dna(rng, 50))  # an antisense transcript over the same locus
    tx = transcripts(spark, [("sense", t), ("anti", overlap)])
    share = {"SF": 0.95, "SR": 0.05, "U": 0.5}[kind]
    rows = []
    for i in range(200):
        p = rng.randrange(0, 60) if i % 2 else rng.randrange(310, 440)  # outside the shared part
        s = t[p:p + 60]
        rows.append(("S", f"r{i}", s if rng.random() < share else back(s)))
    rows += [("S", f"x{i}", t[120 + i:180 + i] if kind != "SR" else back(t[120 + i:180 + i])) for i in range(40)]  # shared part
    reads = spark.createDataFrame(rows, READS)
    frags = QU.mapped_fragments(reads, tx).cache()
    types = QU.library_types(frags, paired=False)
    assert types.first()["library_type"] == kind
    names = {r["tx"]: r["name"] for r in QU._numbered(tx).collect()}
    ecs = {tuple(sorted(names[t] for t in r["ec"])): r["count"] for r in QU.equivalence_classes(QU.strand_compatible(frags, types)).collect()}
    if kind == "U":
        assert sum(ecs.values()) == 240 and ecs[("anti", "sense")] >= 40
    else:  # the strand settles the shared reads
        assert set(ecs) == {("sense",)} and 210 < ecs[("sense",)] < 240


def planted_pairs(rng, name, seq, n, mean, sd, flip=False, length=50):
    rows = []
    for i in range(n):
        size = max(length, min(len(seq), round(rng.gauss(mean, sd))))
        p = rng.randrange(0, len(seq) - size + 1)
        f = seq[p:p + size]
        one, two = f[:length], back(f)[:length]
        rows.append(("S", f"{name}{i}", *((two, one) if flip else (one, two)), size))
    return rows


@pytest.mark.parametrize("flip", [True])
def test_pairs_recover_planted_truth(spark, flip):
    rng = random.Random(7)
    own = [dna(rng, 600) for _ in range(3)]
    shared = dna(rng, 400)
    seqs = {"g,a": own[0] + shared, "g,b": own[1] + shared, "g,c": own[2][:400]}
    planted = {"g,a": 300, "g,b": 100, "g,c": 200}
    rows = [r for t, n in planted.items() for r in planted_pairs(rng, t, seqs[t], n, 180, 15, flip)]
    tx = transcripts(spark, list(seqs.items()))
    pairs = spark.createDataFrame([r[:4] for r in rows] + [("S", "far", seqs["g,a"][:50], back(own[1][:50]))], PAIRS)
    got = {r["transcript"]: r for r in QU.quantify_transcripts(pairs, tx, iterations=5).collect()}
    assert {r["library_type"] for r in got.values()} == {"ISR" if flip else "ISF"}
    for t, n in planted.items():
        assert abs(got[t]["num_reads"] - n) < 0.12 * n + 2
    assert abs(sum(r["num_reads"] for r in got.values()) - 600) < 1e-3
    frags = QU.mapped_fragments(pairs, tx)
    sizes = {r["read_id"]: r["fragment"] for r in frags.where("fragment is not null").collect()}
    truth = {r[1]: r[4] for r in rows}
    assert sizes == truth  # every planted fragment length, to the base
    d = QU.fragment_lengths(frags).collect()
    mean = sum(r["fragment"] * r["n"] for r in d) / sum(r["n"] for r in d)
    for t, s in seqs.items():
        fit = [(r["fragment"], r["n"]) for r in d if r["fragment"] <= len(s)]
        want = len(s) - sum(f * n for f, n in fit) / sum(n for _, n in fit) + 1
        assert abs(got[t]["eff_length"] - want) < 1e-5 and abs(want - (len(s) - mean + 1)) < 1
    rates = QU.mapping_rates(pairs, frags, QU.library_types(frags, paired=True)).first()
    assert (rates["reads"], rates["mapped"], rates["unmapped"]) == (601, 600, 1)


def test_orphans_count_alone(spark):
    rng = random.Random(5)
    t = dna(rng, 400)
    pairs = spark.createDataFrame([("S", "p1", t[:50], back(t[150:200])), ("S", "p2", t[10:60], dna(rng, 50)),
                                   ("S", "p3", dna(rng, 50), back(t[100:150])), ("S", "p4", t[300:350], back(t[:50])),
                                   ("S", "p5", t[:50], None)], PAIRS)
    got = {r["read_id"]: (r["sense"], r["fragment"]) for r in QU.mapped_fragments(pairs, transcripts(spark, [("t", t)])).collect()}
    assert got == {"p1": ("+", 200), "p2": ("+", None), "p3": ("+", None), "p5": ("+", None)}  # p4 points outward


def test_em_says_when_it_did_not_settle(spark):
    rng = random.Random(21)
    a, b, shared = dna(rng, 200), dna(rng, 200), dna(rng, 200)
    tx = transcripts(spark, [("T1", a + shared), ("T2", b + shared)])
    seqs = [a[i:i + 60] for i in range(0, 140, 5)][:24] + [b[i:i + 60] for i in range(0, 140, 5)][:8] + \
           [shared[i:i + 60] for i in range(0, 140, 4)][:32]
    reads = spark.createDataFrame([("S", f"r{i}", s) for i, s in enumerate(seqs)], READS)
    few = QU.quantify_transcripts(reads, tx, iterations=1).collect()
    assert not any(r["converged"] for r in few)
    got = {r["transcript"]: r for r in QU.quantify_transcripts(reads, tx, iterations=10).collect()}
    assert abs(got["T1"]["num_reads"] - 48) < 0.05 and abs(got["T2"]["num_reads"] - 16) < 0.05


def test_effective_lengths_of_single_reads(spark):
    got = {r["length"]: r["eff_length"] for r in QU.effective_lengths(
        spark.createDataFrame([(1, 1000), (2, 250), (3, 5)], "tx long, length long"),
        QU._assumed_lengths(spark.createDataFrame([("S",)], "sample string"), 250.0, 25.0)).collect()}
    p = {i: math.exp(-((i - 250) / 25) ** 2 / 2) for i in range(1, 1001)}
    half = sum(i * v for i, v in p.items() if i <= 250) / sum(v for i, v in p.items() if i <= 250)
    assert abs(got[1000] - 751) < 1e-6 and abs(got[250] - (251 - half)) < 1e-6 and got[5] == 5.0
