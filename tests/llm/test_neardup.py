"""Near-duplicates: pieces, fingerprints, hot variants, recall against brute force."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strandloom.llm import neardup as nd


def pieces(clip, key):
    return {t[i : i + 6] for t in ((clip or "").upper(), (key or "").strip(" \t\r\n").upper()) for i in range(len(t) - 5)}


def brute(rows):
    sets = [(i, pieces(c, k)) for i, c, k in rows if i is not None]
    sets = [(i, s) for i, s in sets if len(s) >= 30]
    return {(min(i, j), max(i, j)) for a, (i, s) in enumerate(sets) for j, t in sets[a + 1 :] if i != j and 2 * len(s & t) >= len(s | t)}


def make(seed, n=60):
    rng = random.Random(seed)
    dna = lambda k: "".join(rng.choice("ACGT") for _ in range(k))
    rows = []
    for k in range(n):
        base = dna(rng.randint(40, 100))
        rows.append((10 * k, base, rng.choice([None, "", base[:12], f" {base[:12].lower()} "])))
        if k % 3 == 0:
            for v in range(1, 4):
                t = base
                for _ in range(v):
                    at = rng.randrange(len(t))
                    t = rng.choice([t[:at] + rng.choice("ACGTN") + t[at + 1 :], t[:at] + t[at + 1 :], t[at:] + t[:at], t[:at] + dna(3) + t[at:]])
                rows.append((10 * k + v, t.lower() if v == 2 else t, None))
            rows.append((10 * k + 5, base, rows[-4][2]))  # a copy
    return rows


def found(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, "locus_id long, longest_clip string, motif_key string").withColumn("text", F.lit("clash")).withColumn("id", F.lit(1))
    df.write.parquet(str(tmp_path / "locus_rows.parquet"))
    got = [tuple(r) for r in nd.found(spark, str(tmp_path)).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_recall_and_precision(spark, tmp_path):
    rows = make(1) + [(9001, None, None), (9002, "", " "), (9003, "A" * 5000, "A"), (9004, "A" * 5000, "A"), (None, "ACGT" * 30, None), (9005, "é中" * 10 + make(2)[0][1], None)]
    got, want = found(spark, tmp_path, rows), brute(rows)
    assert got <= want
    assert len(got) >= 0.97 * len(want) and len(want) > 100


def test_very_long_and_wide_texts(spark, tmp_path):
    rng = random.Random(7)
    long = "".join(rng.choice("ACGT") for _ in range(60000))
    wide = "".join(rng.choice("αβγδεζηθ") for _ in range(80))
    rows = [(1, long, None), (2, long[:30000] + "T" + long[30000:], None), (3, wide, None), (4, wide[1:], None), (5, long[::-1], None)]
    assert found(spark, tmp_path, rows) == {(1, 2), (3, 4)}


def test_empty_table(spark, tmp_path):
    assert found(spark, tmp_path, make(3)[:0]) == set()


def test_hot_variant_is_paired_in_blocks(spark):
    base = make(4)[0][1]
    texts = spark.createDataFrame([(i, base + chr(65 + i % 26) + chr(65 + i // 26) + "\n") for i in range(60)], "id long, text string")
    wholes = {(r["a"], r["b"]) for r in nd.candidate_pairs(texts, block=512).collect()}
    blocks = {(r["a"], r["b"]) for r in nd.candidate_pairs(texts, block=4).collect()}
    assert blocks >= wholes and len(blocks) == 60 * 59 // 2


def test_piece_counts_agree_with_sets():
    texts = [f"{c or ''}\n{(k or '').strip()}".upper() for _, c, k in make(5)] + ["", "\n", "é" * 9 + "\nab"]
    assert nd.piece_counts(pa.array(texts)).tolist() == [len(pieces(*t.split("\n")) if "\n" in t else ()) for t in texts]
    assert nd.piece_counts(pa.array(texts[:3])).tolist() == [len(pieces(*t.split("\n"))) for t in texts[:3]]


def edited(rng, text, edits):
    dna = lambda k: "".join(rng.choice("ACGT") for _ in range(k))
    for _ in range(edits):
        at = rng.randrange(len(text))
        text = rng.choice([text[:at] + rng.choice("ACGT") + text[at + 1 :], text[:at] + text[at + 1 :], text[:at] + dna(2) + text[at:]])
    return text


def test_a_variant_is_met_exactly_within_the_radius():
    rng = random.Random(3)
    base = ["".join(rng.choice("ACGT") for _ in range(70)) for _ in range(60)]
    texts = pa.array([edited(rng, b, e) + "\n" for b in base for e in (0, 1, 2, 3, 4, 5)])
    late = np.ones(nd.SLOTS)
    group, sets, _, have = nd.fingerprints(texts, late, 11, 4, 5)
    held = {int(g): set(s[:h].tolist()) for g, s, h in zip(group, sets, have)}
    met = {}
    for who, v in zip(*nd.variants(texts, late, 11, 4, 2, 5, apart=0)):
        met.setdefault(int(v), set()).add(int(who))
    together = {(a, b) for rows in met.values() for a in rows for b in rows if a < b}
    near = {(g // 5, h // 5) for g in held for h in held if g < h and g % 5 == h % 5 and len(held[g] & held[h]) >= 2}
    assert together == near
    # meeting is not transitive, as equality of a MinHash value is: two rows meet a third, each by other symbols, and not each other
    table = {t: {(g // 5, h // 5) for g in held for h in held if g < h and g % 5 == h % 5 == t and len(held[g] & held[h]) >= 2} for t in range(5)}
    assert any((a, c) not in pairs for pairs in table.values() for a, b in pairs for b2, c in pairs if b == b2)
    assert all(len(s) == 4 for s, h in zip(held.values(), have) if h == 4)


def test_recall_by_band_with_and_without_a_run_common_to_all(spark):
    rng = random.Random(11)
    dna = lambda k: "".join(rng.choice("ACGT") for _ in range(k))
    adapter = dna(20)
    for lead in ("", adapter):
        rows = []
        for k in range(250):
            base = lead + dna(60)
            rows += [base] + [edited(rng, base, e) for e in (2, 4, 5)]
        sets = [pieces(t, "") for t in rows]
        pairs = {(i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i in range(len(rows)) for j in range(i + 1, i // 4 * 4 + 4)}
        got = {tuple(r) for r in nd.alike(spark.createDataFrame([(i, t + "\n") for i, t in enumerate(rows)], "id long, text string")).collect()}
        for low, high, least in ((0.5, 0.6, 0.9), (0.6, 0.8, 0.97), (0.8, 1.1, 1.0)):
            want = {p for p, j in pairs.items() if low <= j < high}
            assert len(want) > 20 and len(want & got) >= least * len(want), (lead, low, len(want), len(want & got))
        assert all(len(sets[i] & sets[j]) * 2 >= len(sets[i] | sets[j]) for i, j in got)


def test_links_count_partners(spark, tmp_path):
    rows = make(6, 12)
    spark.createDataFrame(rows, "locus_id long, longest_clip string, motif_key string").write.parquet(str(tmp_path / "locus_rows.parquet"))
    pairs = {tuple(r) for r in nd.found(spark, str(tmp_path)).collect()}
    got = {r["locus_id"]: r["n_links"] for r in nd.links(spark, str(tmp_path)).collect()}
    for i, n in got.items():
        assert n == sum(i in p for p in pairs)
