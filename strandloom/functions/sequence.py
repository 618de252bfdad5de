"""Column expressions on nucleotide sequences; all of them stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Amino acids of the codons in TCAG order, by number of the public genetic code table.
CODES = {
    1: "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    2: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNKKSS**VVVVAAAADDEEGGGG",
    3: "FFLLSSSSYY**CCWWTTTTPPPPHHQQRRRRIIMMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    4: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    5: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNKKSSSSVVVVAAAADDEEGGGG",
    6: "FFLLSSSSYYQQCC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    9: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIIMTTTTNNNKSSSSVVVVAAAADDEEGGGG",
    10: "FFLLSSSSYY**CCCWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    11: "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    13: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNKKSSGGVVVVAAAADDEEGGGG",
    12: "FFLLSSSSYY**CC*WLLLSPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
}
STARTS = {1: ["TTG", "CTG", "ATG"], 6: ["ATG"], 10: ["ATG"], 11: ["TTG", "CTG", "ATT", "ATC", "ATA", "ATG", "GTG"], 12: ["CTG", "ATG"]}
#: Seeds of common sequencing adapters.
ADAPTERS = ["AGATCGGAAGAGC", "CTGTCTCTTATACACATCT", "TGGAATTCTCGG", "GATCGTCGGACT"]
BASES = "TCAG"


def reverse_complement(c: Column) -> Column:
    """The other strand, read backwards; letters other than ACGTN stay as they are."""
    return F.reverse(F.translate(c, "ACGTNacgtn", "TGCANtgcan"))


def stop_codons(code: int) -> list[str]:
    """The codons a table ends at."""
    return [BASES[i // 16] + BASES[i // 4 % 4] + BASES[i % 4] for i, a in enumerate(CODES[code]) if a == "*"]


def translate(c: Column, code: int = 1) -> Column:
    """Amino acids of the codons from the first base on; ``*`` for a stop, ``X`` for other letters.

    A trailing part of a codon is dropped; null stays null; shorter than a codon is empty.
    """
    def amino(codon: Column) -> Column:
        places = [F.instr(F.lit(BASES), F.substr(codon, F.lit(k), F.lit(1))) for k in (1, 2, 3)]
        known = (places[0] > 0) & (places[1] > 0) & (places[2] > 0)
        return F.when(known, F.substr(F.lit(CODES[code]), (places[0] - 1) * 16 + (places[1] - 1) * 4 + places[2], F.lit(1))).otherwise("X")

    return F.array_join(F.transform(_triplets(F.upper(c)), amino), "")


def _triplets(c: Column) -> Column:
    """Letters three by three, in one pass; a trailing part is dropped."""
    return F.regexp_extract_all(c, F.lit("(?s)..."), F.lit(0))


def codon_positions(c: Column, codons: Sequence[str], overlapping: bool = False) -> Column:
    """Places (from 1) of ``codons``, as a scan meets them: a match is not looked into again.

    ``overlapping`` gives every place.  Null and short sequences give an empty list.
    """
    up = F.upper(c)

    def frame(k: int) -> Column:
        found = F.transform(_triplets(F.substring(up, k + 1, 1 << 30)), lambda x, i: F.when(x.isin(*codons), i * 3 + k + 1))
        return F.filter(found, lambda i: i.isNotNull())

    hits = F.array_sort(F.concat(frame(0), frame(1), frame(2)))
    if overlapping or not any(a[k:] == b[: 3 - k] for a in codons for b in codons for k in (1, 2)):
        return hits
    start = F.array().cast("array<int>")
    return F.aggregate(hits, start, lambda acc, i: F.when((F.size(acc) == 0) | (i > F.element_at(acc, -1) + 2), F.concat(acc, F.array(i))).otherwise(acc))


def hamming(a: Column, b: Column) -> Column:
    """Number of places that differ; texts of different lengths differ in the longer one's
    length; null beside anything is null."""
    places = F.sequence(F.lit(1), F.length(a))
    same = F.filter(places, lambda i: F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1)))
    return F.when(a.isNull() | b.isNull(), None).when(F.length(a) != F.length(b), F.greatest(F.length(a), F.length(b))).when(F.length(a) == 0, 0).otherwise(F.size(same))


def anchored(c: Column, side: Column, k: int) -> Column:
    """The ``k`` letters next to the alignment: last of a 5p clip, first of a 3p clip."""
    up = F.upper(c)
    return F.when(F.length(c) >= k, F.when(side == "5p", F.right(up, F.lit(k))).otherwise(F.left(up, F.lit(k))))


def base_count(c: Column, base: str) -> Column:
    """How often ``base`` occurs, in either case."""
    up = F.upper(c)
    return F.length(c) - F.length(F.replace(up, F.lit(base), F.lit("")))


def top_share(c: Column) -> Column:
    """Share of the commonest base; null for an empty text."""
    return F.try_divide(F.greatest(*[base_count(c, b) for b in "ACGT"]), F.length(c))


def poly_tail(c: Column, side: Column, least: int = 8, share: float = 0.8) -> Column:
    """``polyA`` for an A-rich 3p clip, ``polyT`` for a T-rich 5p clip, else null."""
    rich = lambda b: F.try_divide(base_count(c, b), F.length(c)) >= share
    long = F.length(c) >= least
    return F.when(long & (side == "3p") & rich("A"), "polyA").when(long & (side == "5p") & rich("T"), "polyT")


def shares_run(c: Column, texts: Sequence[str], run: int = 11) -> Column:
    """Whether ``c`` holds ``run`` letters in a row of any of ``texts`` or of their other strands."""
    flip = str.maketrans("ACGT", "TGCA")
    both = [t for s in texts for t in (s, s.translate(flip)[::-1])]
    runs = sorted({t[i : i + run] for t in both for i in range(len(t) - run + 1)})
    return F.coalesce(F.exists(F.array(*[F.lit(r) for r in runs]), lambda r: F.contains(F.upper(c), r)), F.lit(False))


def near_positions(c: Column, motif: str, mismatches: int) -> Column:
    """Places (from 1) where a run of ``c`` differs from ``motif`` in at most ``mismatches`` letters; short texts and null give none."""
    n = len(motif)

    def places(t: Column) -> Column:
        at = F.when(F.length(t) >= n, F.sequence(F.lit(1), F.length(t) - (n - 1))).otherwise(F.array().cast("array<int>"))
        runs = F.transform(at, lambda i: F.struct(i.alias("i"), F.substr(t, i, F.lit(n)).alias("r")))
        near = F.filter(runs, lambda x: F.levenshtein(x["r"], F.lit(motif), mismatches) >= 0)  # no run further away is compared letter by letter
        same = F.filter(near, lambda x: sum((F.when(F.substr(x["r"], F.lit(k + 1), F.lit(1)) == letter, 0).otherwise(1) for k, letter in enumerate(motif)), F.lit(0)) <= mismatches)
        return F.transform(same, lambda x: x["i"])

    return F.element_at(F.transform(F.array(c), places), 1)  # the text is worked out once


def neighbours(c: Column) -> Column:
    """All texts one letter away, place by place, letters in the order ACGT."""
    at = F.when(F.length(c) > 0, F.sequence(F.lit(1), F.length(c))).otherwise(F.array().cast("array<int>"))
    here = lambda i: F.filter(F.array(*[F.lit(b) for b in "ACGT"]), lambda b: b != F.substr(c, i, F.lit(1)))
    return F.flatten(F.transform(at, lambda i: F.transform(here(i), lambda b: F.concat(F.substr(c, F.lit(1), i - 1), b, F.substr(c, i + 1)))))
