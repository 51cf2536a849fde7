"""The contaminant screen with and without a broadcast index."""

import random

from strandline.operators import screen as SC


def test_the_joined_index_equals_the_broadcast_one(spark, monkeypatch):
    rng = random.Random(3)
    dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    ref = [(f"c{i}", dna(rng.choice((15, 40, 300, 1200)))) for i in range(12)]
    rows = []
    for i in range(150):
        _, s = rng.choice([r for r in ref if len(r[1]) >= 100])
        p, n = rng.randrange(len(s) - 60), rng.choice((5, 18, 30, 60))
        read = list(s[p:p + n])
        for _ in range(rng.randrange(4)):
            read[rng.randrange(n)] = rng.choice("ACGT")
        read = "".join(read) if i % 3 else dna(n)
        rows.append(("S", f"r{i}", read[::-1].translate(str.maketrans("ACGT", "TGCA")) if i % 2 else read, "I" * n))
    reads = spark.createDataFrame(rows, "sample string, read_id string, seq string, qual string")
    reference = spark.createDataFrame(ref, "name string, seq string")
    sent = {tuple(r) for r in SC.screen_contaminants(reads, reference).collect()}
    monkeypatch.setattr(SC, "BROADCAST_MAX_ROWS", 0)
    joined = SC.screen_contaminants(reads, reference)
    assert {tuple(r) for r in joined.collect()} == sent and len(sent) == 150
    assert 30 < sum(a for *_, a in sent) < 120
    monkeypatch.setattr(SC, "WINDOW", 16)
    assert {tuple(r) for r in SC.screen_contaminants(reads, reference).collect()} == sent
