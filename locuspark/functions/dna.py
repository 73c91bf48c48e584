"""DNA string expressions (built-in Column functions, JVM-side)."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

# IUPAC complement pairs (upper and lower case), codon classes.
COMPLEMENT_FROM = "ACGTRYKMSWBDHVNacgtrykmswbdhvn"
COMPLEMENT_TO = "TGCAYRMKSWVHDBNtgcayrmkswvhdbn"
STOP_CODONS = ("TAA", "TAG", "TGA")
START_CODONS = ("ATG",)
ALT_START_CODONS = ("CTG", "TTG")

# The standard genetic code, amino acids listed for codons in
# T, C, A, G order of first, second and third base.
_BASES = "TCAG"
_STANDARD_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODON_TABLE = {"".join(c): aa for c, aa in zip(product(_BASES, repeat=3), _STANDARD_CODE)}


def ascii_only(seq: Column) -> Column:
    """One filler for each character beyond ASCII, so that offsets in bytes are offsets in letters."""
    return F.regexp_replace(seq, r"[^\x00-\x7F]", "?")


def reverse_complement(seq: Column) -> Column:
    """reverse complement over IUPAC codes; case is kept."""
    return F.reverse(F.translate(seq, COMPLEMENT_FROM, COMPLEMENT_TO))


def gc_count(seq: Column) -> Column:
    return F.length(seq) - F.length(F.regexp_replace(seq, "[GCgc]", ""))


def gc_fraction(seq: Column) -> Column:
    """(G+C)/length, 0 for the empty string."""
    n = F.length(seq)
    return F.when(n == 0, F.lit(0.0)).otherwise(gc_count(seq) / n.cast("double"))


def to_rna(seq: Column) -> Column:
    """T->U, t->u."""
    return F.translate(seq, "Tt", "Uu")


def translate_expr(dna_col: str) -> Column:
    """F4 as a SQL expression on a named column (codon map inlined)."""
    keys = sorted(CODON_TABLE)
    m = "map(" + ", ".join(f"'{k}', '{CODON_TABLE[k]}'" for k in keys) + ")"
    n = f"CAST(floor(length({dna_col}) / 3) AS INT)"
    b = rf"encode(regexp_replace({dna_col}, r'[^\x00-\x7F]', '?'), 'US-ASCII')"   # byte offsets: O(1) substring
    codons = (f"transform(IF({n} > 0, sequence(0, {n} - 1), CAST(array() AS ARRAY<INT>)), "
              f"k -> coalesce(element_at({m}, upper(CAST(substring({b}, 3 * k + 1, 3) AS STRING))), 'X'))")
    joined = f"array_join({codons}, '')"
    return F.expr(f"substring_index({joined}, '*', 1)")


def wrap60(seq: Column) -> Column:
    """insert a newline after every 60 characters (none at the end)."""
    return F.regexp_replace(seq, "(.{60})(?=.)", "$1\n")


def clean_sequence(seq: Column) -> Column:
    """upper-case, letters only."""
    return F.regexp_replace(F.upper(seq), "[^\\p{L}]", "")
