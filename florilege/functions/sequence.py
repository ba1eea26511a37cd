"""Functions on sequences: letters, k-mers, sketches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from florilege.functions.hashing import jaccards, sketches_of


def gc_fraction(seq: Column, ambiguous: str = "remove") -> Column:
    """Share of G and C: of the unambiguous letters, or of all with ``ambiguous='ignore'``; 0 for none."""
    count = lambda letters: F.length(seq) - F.length(F.translate(seq, letters + letters.lower(), ""))
    gc = count("GCS")
    whole = F.length(seq) if ambiguous == "ignore" else gc + count("ATWU")
    return F.when(whole == 0, 0.0).otherwise(gc / whole)


def length_mismatch(seq: Column, declared: Column) -> Column:
    return ~F.length(seq).cast("long").eqNullSafe(declared.cast("long"))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


#: K-mers that are cut from one block of a sequence, and blocks of one stretch, so that no k-mer is looked for from the start
#: of a long sequence.
BLOCK, STRETCH = 64, 64


def kmers(seq: Column, k: int) -> Column:
    """All substrings of length ``k``; none for shorter sequences."""

    def pieces(text: Column, size: int) -> Column:
        """Stretches that begin every ``size`` characters and reach to the end of the last k-mer that begins in them."""
        n = F.length(text) - (k - 1)
        starts = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / size).cast("int"))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda b: F.substring(text, b * size + 1, F.lit(size + k - 1)))

    def cut(block: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(block) - (k - 1)), lambda i: F.substring(block, i, F.lit(k)))

    blocks = F.flatten(F.transform(pieces(seq, BLOCK * STRETCH), lambda stretch: pieces(stretch, BLOCK)))
    return F.flatten(F.transform(blocks, cut))


def sketch(seq: Column, k: int = 21, s: int = 1000, seed: int = 123, canonical: bool = True, numbers: bool = False) -> Column:
    """The ``s`` smallest distinct hashes of the k-mers, sorted; ``canonical`` takes the smaller of a k-mer and its reverse
    complement. With ``numbers`` the hashes' first 60 bits, in the same order.

    Of a long sequence only hashes below a bound that half as many again as asked for are expected to keep are made
    distinct and sorted; if too few are distinct, all are. Numbers of k-mers as they stand come from a numpy kernel, which
    hashes a batch of sequences at once."""
    if numbers and not canonical:
        return F.arrow_udf(lambda texts: sketches_of(texts, k, s, seed), "array<long>")(seq)

    def hashed(m: Column) -> Column:
        return F.md5(F.concat(F.lit(f"{seed}:"), F.least(m, reverse_complement(m)) if canonical else m))

    def smallest(h: Column) -> Column:
        below = F.least((F.lit(1.5 * s + 50)) / F.size(h), F.lit(1.0)) * (1 << 32)
        bound = F.lpad(F.lower(F.hex(below.cast("long"))), 8, "0")
        some = lambda d: F.when(F.size(d) >= s, d).otherwise(F.array_distinct(h))
        few = F.transform(F.array(F.array_distinct(F.filter(h, lambda x: x < bound))), some)[0]
        return F.slice(F.sort_array(F.when(F.size(h) > 2 * s, few).otherwise(F.array_distinct(h))), 1, s)

    found = F.transform(F.array(F.transform(kmers(seq, k), hashed)), smallest)[0]
    return F.transform(found, lambda h: F.conv(F.substring(h, 1, 15), 16, 10).cast("long")) if numbers else found


def sketch_jaccard(a: Column, b: Column, s: int) -> Column:
    """Of the ``s`` smallest hashes of the union the share that is in both; of arrays of distinct hashes."""
    return F.arrow_udf(lambda x, y: jaccards(x, y, s), "double")(a, b)


def jaccard_distance(j: Column, k: int) -> Column:
    """``-ln(2 j / (1 + j)) / k``, 1 where nothing is shared."""
    return F.when(j <= 0, 1.0).otherwise(F.abs(-F.log(2 * j / (1 + j)) / k))


def sketch_distance(a: Column, b: Column, k: int, s: int) -> Column:
    """The ``jaccard_distance`` of two sketches."""
    return jaccard_distance(sketch_jaccard(a, b, s), k)
