"""Column expressions over alignment records (SAM flag bits, CIGAR)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# SAM flag bits.
PAIRED = 1
PROPER_PAIR = 2
UNMAPPED = 4
MATE_UNMAPPED = 8
REVERSE = 16
MATE_REVERSE = 32
FIRST_IN_PAIR = 64
SECOND_IN_PAIR = 128
SECONDARY = 256
QC_FAIL = 512
DUPLICATE = 1024
SUPPLEMENTARY = 2048

BLOCK_TYPE = "array<struct<start:bigint,end:bigint>>"
CIGAR_TOKEN = "([0-9]+)([MIDNSHP=X])"


def has_flag(flag: str | Column, bit: int) -> Column:
    c = F.col(flag) if isinstance(flag, str) else flag
    return (c.bitwiseAND(F.lit(bit))) != 0


def read_strand(flag: str | Column = "flag") -> Column:
    """'+' / '-' of the read itself."""
    return F.when(has_flag(flag, REVERSE), F.lit("-")).otherwise(F.lit("+"))


def fragment_strand(flag: str | Column = "flag") -> Column:
    """Strand of the fragment: mate 2 is flipped so both mates report mate 1's strand."""
    return F.when(has_flag(flag, REVERSE) != has_flag(flag, SECOND_IN_PAIR), F.lit("-")).otherwise(F.lit("+"))


def cigar_blocks(pos: str = "pos", cigar: str = "cigar") -> Column:
    """Aligned reference blocks (1-based closed) of an alignment.

    M, =, X and D extend the current block; N (intron) closes it; I, S, H, P
    consume no reference.  Evaluated by ``aggregate`` inside the JVM; the common CIGAR of one M or = is one
    block and takes a short way.
    """
    return F.expr(f"""
      if(coalesce({pos} >= 0 and {cigar} rlike '^[0-9]+[M=]$', false),
        array(named_struct('start', cast({pos} as bigint), 'end', cast({pos} as bigint) + cast(left({cigar}, length({cigar}) - 1) as bigint) - 1)),
      aggregate(
        regexp_extract_all({cigar}, '{CIGAR_TOKEN}', 0),
        named_struct('r', cast({pos} as bigint), 'bs', cast(-1 as bigint), 'blocks', cast(array() as {BLOCK_TYPE})),
        (acc, t) -> case
          when right(t, 1) in ('M', '=', 'X', 'D') then
            named_struct('r', acc.r + cast(left(t, length(t) - 1) as bigint),
                         'bs', if(acc.bs < 0, acc.r, acc.bs), 'blocks', acc.blocks)
          when right(t, 1) = 'N' then
            named_struct('r', acc.r + cast(left(t, length(t) - 1) as bigint), 'bs', cast(-1 as bigint),
                         'blocks', if(acc.bs < 0, acc.blocks,
                                      array_append(acc.blocks, named_struct('start', acc.bs, 'end', acc.r - 1))))
          else acc end,
        acc -> if(acc.bs < 0, acc.blocks, array_append(acc.blocks, named_struct('start', acc.bs, 'end', acc.r - 1)))))
    """)


def reference_span(pos: str = "pos", cigar: str = "cigar") -> Column:
    """Number of reference bases consumed (M, D, N, =, X)."""
    return F.expr(f"""
      aggregate(regexp_extract_all({cigar}, '{CIGAR_TOKEN}', 0), cast(0 as bigint),
        (acc, t) -> acc + if(right(t, 1) in ('M', 'D', 'N', '=', 'X'), cast(left(t, length(t) - 1) as bigint), 0))
    """)


def junctions(pos: str = "pos", cigar: str = "cigar") -> Column:
    """Introns (N gaps) as array<struct<start,end>>: first and last intronic base, 1-based."""
    return F.expr(f"""
      aggregate(
        regexp_extract_all({cigar}, '{CIGAR_TOKEN}', 0),
        named_struct('r', cast({pos} as bigint), 'gaps', cast(array() as {BLOCK_TYPE})),
        (acc, t) -> case
          when right(t, 1) in ('M', '=', 'X', 'D') then
            named_struct('r', acc.r + cast(left(t, length(t) - 1) as bigint), 'gaps', acc.gaps)
          when right(t, 1) = 'N' then
            named_struct('r', acc.r + cast(left(t, length(t) - 1) as bigint),
                         'gaps', array_append(acc.gaps, named_struct('start', acc.r,
                                              'end', acc.r + cast(left(t, length(t) - 1) as bigint) - 1)))
          else acc end,
        acc -> acc.gaps)
    """)


def unclipped_five_prime(pos: str = "pos", cigar: str = "cigar", flag: str = "flag") -> Column:
    """Unclipped 5' reference coordinate (duplicate-marking key).

    Forward reads: pos minus leading soft/hard clips.  Reverse reads: alignment
    end plus trailing clips.
    """
    lead = F.expr(f"cast(coalesce(nullif(regexp_extract({cigar}, '^([0-9]+)[SH]', 1), ''), '0') as bigint)"
                  f" + cast(coalesce(nullif(regexp_extract({cigar}, '^[0-9]+[SH]([0-9]+)[SH]', 1), ''), '0') as bigint)")
    trail = F.expr(f"cast(coalesce(nullif(regexp_extract({cigar}, '([0-9]+)[SH]$', 1), ''), '0') as bigint)"
                   f" + cast(coalesce(nullif(regexp_extract({cigar}, '([0-9]+)[SH][0-9]+[SH]$', 1), ''), '0') as bigint)")
    end = F.col(pos).cast("bigint") + reference_span(pos, cigar) - 1
    return F.when(has_flag(flag, REVERSE), end + trail).otherwise(F.col(pos).cast("bigint") - lead)
