"""Gapped adapter trimming and mate overlap against brute force and planted inserts."""

import random

import pytest
from pyspark.sql import functions as F

from strandline.operators import adapters as AD
from strandline.operators import trim as T


def distance(a, b, indels):
    if not indels:
        return sum(x != y and x != "N" for x, y in zip(a, b)) if len(a) == len(b) else 10 ** 6
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            last, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, last + (x != y and x != "N"))
    return d[-1]


def plain_hit(read, adapters, min_overlap, rate, indels):
    best = None
    for k, a in enumerate(adapters):
        for i in range(min_overlap, len(a) + 1):
            c = int(i * rate)
            for s in range(len(read) + 1):
                for e in range(max(s, s + i - c), min(len(read), s + i + c) + 1):
                    if i < len(a) and e != len(read):
                        continue
                    err = distance(a[:i], read[s:e], indels)
                    if err <= c and (best is None or (err - i, err, s, k) < best):
                        best = (err - i, err, s, k)
    return best


def plain_trim(read, adapters, mode, min_overlap, rate, indels):
    three = plain_hit(read, adapters, min_overlap, rate, indels) if mode in "ab" else None
    five = plain_hit(read[::-1], [a[::-1] for a in adapters], min_overlap, rate, indels) if mode in "gb" else None
    if five and (not three or five[:2] < three[:2]):
        return read[len(read) - five[2]:], five[3], five[1]
    return (read[:three[2]], three[3], three[1]) if three else (read, None, 0)


def reads(rng, adapters, n=120):
    out = []
    for _ in range(n):
        seq = "".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 30)))
        a = list(rng.choice(adapters).replace("N", "G"))
        for _ in range(rng.randrange(3)):
            p = rng.randrange(len(a))
            a[p:p + 1] = rng.choice([[], ["T"], [a[p], "C"]])
        a = "".join(a)
        kind = rng.randrange(5)
        seq = (seq + a if kind == 0 else a + seq if kind == 1 else seq + a[:rng.randrange(len(a) + 1)] if kind == 2
               else a[rng.randrange(len(a)):] + seq if kind == 3 else seq + a + seq[:9])
        out.append(seq)
    return out + ["", "A", "ACGT" * 40]


@pytest.mark.parametrize("mode", ["a", "g", "b"])
@pytest.mark.parametrize("indels", [True, False])
def test_trimming_equals_brute_force(spark, mode, indels):
    adapters = [("x", "AGATCGGAAGAGC"), ("y", "CTGTNTCTTATA")]
    seqs = reads(random.Random(f"{mode}{indels}"), [a for _, a in adapters])
    rows = [(i, 1 + i % 2, s, "".join(chr(40 + j % 50) for j in range(len(s)))) for i, s in enumerate(seqs)] + [(-1, None, None, None)]
    df = spark.createDataFrame(rows, "id int, mate int, seq string, qual string").repartition(3)
    got = {r["id"]: r for r in AD.trim_adapters(df, adapters, adapters[::-1], mode=mode, min_overlap=4, error_rate=0.15,
                                                indels=indels).collect()}
    assert len(got) == len(rows)
    for i, mate, s, q in rows[:-1]:
        own = adapters if mate == 1 else adapters[::-1]
        kept, k, err = plain_trim(s, [a for _, a in own], mode, 4, 0.15, indels)
        r = got[i]
        assert (r["seq"], r["adapter"], r["adapter_errors"]) == (kept, None if k is None else own[k][0], err)
        at = len(s) - len(kept) if k is not None and kept != s[:len(kept)] else 0
        assert r["qual"] in (q[at:at + len(kept)], q[:len(kept)], q[len(q) - len(kept):])


def test_adapter_settings(spark, tmp_path):
    (tmp_path / "ad.fa").write_text(">b second\nAGATCGG\nAAGAGC\n>a\nctgtctcttata\n")
    setting = f"file:{tmp_path}/ad.fa"
    assert AD.load_adapters(spark, setting) == [("a", "CTGTCTCTTATA"), ("b", "AGATCGGAAGAGC")]
    assert AD.load_adapters(spark, "acgt") == [("1", "ACGT")] and AD.load_adapters(spark, "") == AD.load_adapters(spark, None) == []
    df = spark.createDataFrame([("s", "r1", "TTTTTTTTTTAGATCGGAAGAGC", "I" * 23), ("s", "r2", "TTTTTTTTTTTTTTTTTTTTTTT", "I" * 23)],
                               "sample string, read_id string, seq string, qual string")
    t = AD.trim_adapters(df, setting, mode="a")
    assert {(r["read_id"], r["seq"], r["adapter"]) for r in t.collect()} == {("r1", "T" * 10, "b"), ("r2", "T" * 23, None)}
    assert [tuple(r) for r in AD.adapter_summary(df, t).collect()] == [("s", "b", 1, 13)]
    whole = T.trim_reads(df, adapter_fwd=setting, adapter_mode="a", minimum_length=5, quality_cutoff=0)
    assert sorted(r["seq"] for r in whole.collect()) == ["T" * 10, "T" * 23]
    assert T.trim_reads(df, adapter_fwd=setting, disable_adapter_trimming=True, quality_cutoff=0).count() == 2
    none = AD.trim_adapters(df, None)
    assert none.where("adapter is not null").count() == 0 and none.where("length(seq) = 23").count() == 2
    with pytest.raises(ValueError):
        AD.trim_adapters(df, "ACGT", "ACGT")
    with pytest.raises(ValueError):
        AD.trim_adapters(df, "ACGT", mode="x")


def back(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def plain_overlap(a, b, least, most, rate):
    r, best = back(b), None
    for size in range(least, len(a) + len(b) - least + 1):
        lo, hi = max(0, size - len(r)), min(len(a), size)
        x, y = a[lo:hi], r[lo - size + len(r):hi - size + len(r)]
        miss = sum(p != q for p, q in zip(x, y))
        if len(x) >= least and miss <= min(most, int(len(x) * rate)) and (best is None or (2 * miss - len(x), size) < best[:2]):
            best = (2 * miss - len(x), size, len(x), miss)
    return best[1:] if best else (None, None, None)


def pairs(rng, n, length, low=20):
    ones, twos = "AGATCGGAAGAGCACACGTCTGAACTCCAGTCA" * 3, "AGATCGGAAGAGCGTCGTGTAGGGAAAGAGTGT" * 3
    out = []
    for i in range(n):
        insert = "".join(rng.choice("ACGT") for _ in range(rng.randrange(low, 2 * length)))
        a, b = (insert + ones)[:length], (back(insert) + twos)[:length]
        out.append(("s", i, a, "I" * len(a), b, "I" * len(b), len(insert)))
    return out


PAIRS = "sample string, pair_id int, seq1 string, qual1 string, seq2 string, qual2 string, planted int"


def test_overlap_equals_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for s, i, a, q, b, q2, n in pairs(rng, 80, 60):
        b = "".join(rng.choice("ACGTN") if rng.random() < 0.04 else c for c in b)
        a, b = a[:rng.randrange(20, 61)], b[:rng.randrange(20, 61)]
        rows.append((s, i, a, "I" * len(a), b, "I" * len(b), n))
    rows += [("s", 900, "", "", "", "", 0), ("s", 901, None, None, "ACGT", "IIII", 0), ("s", 902, "A" * 60, "I" * 60, "T" * 60, "I" * 60, 0)]
    df = spark.createDataFrame(rows, PAIRS).repartition(2)
    for least, most, rate in ((30, 5, 0.2), (12, 2, 0.1)):
        got = {r["pair_id"]: (r["insert_length"], r["overlap"], r["mismatches"])
               for r in AD.mate_overlap(df, min_overlap=least, max_mismatches=most, mismatch_rate=rate).collect()}
        for _, i, a, _, b, _, _ in rows:
            assert got[i] == plain_overlap(a or "", b or "", least, most, rate), i


def test_planted_inserts_and_adapters_are_found(spark):
    rows = pairs(random.Random(8), 400, 75, low=30)
    df = spark.createDataFrame(rows, PAIRS)
    got = AD.mate_overlap(df).collect()
    assert all(r["insert_length"] == r["planted"] for r in got if r["planted"] <= 2 * 75 - AD.OVERLAP_MIN)
    assert all(r["insert_length"] is None for r in got if r["planted"] > 2 * 75 - AD.OVERLAP_MIN)
    cut = {r["pair_id"]: r for r in AD.trim_by_overlap(df).collect()}
    for _, i, a, _, b, _, n in rows:
        assert cut[i]["seq1"] == a[:n] and cut[i]["seq2"] == b[:n] and len(cut[i]["qual2"]) == len(cut[i]["seq2"])
    found = {r["mate"]: r for r in AD.paired_adapters(df).collect()}
    assert found[1]["adapter"].startswith("AGATCGGAAGAGCACACGTCTGAACTCCAGTCA") and found[2]["adapter"].startswith("AGATCGGAAGAGCGTCGTGTAGGGAAAGAGTGT")
    assert found[1]["reads"] == sum(n < 75 for *_, n in rows)
    whole = df.where(F.col("planted") >= 75)
    assert AD.paired_adapters(whole).count() == 0


def test_narrow_and_wide_states_agree():
    import numpy as np

    from strandline.operators import adapters as A

    rng = random.Random(8)
    probe = np.frombuffer(b"AGATCGGAAGAGC", dtype=np.uint8)
    allowed = np.array([int(i * 0.2) for i in range(len(probe) + 1)])
    texts = ["".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 30))) + "AGATCGGAGAGC"[:rng.randrange(13)] for _ in range(300)]
    n = np.array([len(t) for t in texts])

    def ranks(width, indels):
        m = np.zeros((len(texts), width), dtype=np.uint8)
        for i, t in enumerate(texts):
            m[i, :len(t)] = np.frombuffer(t.encode(), dtype=np.uint8)
        return A._gapped(m, n, probe, allowed, 6, indels).tolist()

    assert ranks(45, True) == ranks(600, True) == ranks((1 << 16) + 1, True)  # 16, 32 and 64 bits
    assert ranks(45, False) == ranks((1 << 16) + 1, False)
