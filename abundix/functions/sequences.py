"""Nucleotide sequences: six-frame translation."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from abundix.functions.features import _col

# Fixed value: the standard genetic code, codons ordered by T, C, A, G.
BASES = "TCAG"
GENETIC_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
UNKNOWN_RESIDUE = "X"

# index of a codon is 16 * first + 4 * second + third; with an unknown base it is 64 or more
_UNKNOWN = 64
_BASE_INDEX = np.full(256, _UNKNOWN, dtype=np.int16)
for _i, _base in enumerate(BASES):
    _BASE_INDEX[ord(_base)] = _i
_RESIDUES = np.frombuffer(
    (GENETIC_CODE + UNKNOWN_RESIDUE * (_UNKNOWN * 21 + 1)).encode(), dtype=np.uint8
)
_BAD = (_RESIDUES == ord("*")) | (_RESIDUES == ord(UNKNOWN_RESIDUE))
_FRAMES = T.ArrayType(
    T.StructType([T.StructField("frame", T.IntegerType()), T.StructField("peptide", T.StringType())])
)


def reverse_complement(sequence: Column | str) -> Column:
    """Complement of the reversed sequence; letters other than ACGT become N."""
    upper = F.upper(_col(sequence))
    known = F.regexp_replace(upper, "[^ACGT]", "N")
    return F.reverse(F.translate(known, "ACGT", "TGCA"))


def _codons(codes: np.ndarray) -> np.ndarray:
    """Index of the codon that starts at every position."""
    return codes[:-2] * 16 + codes[1:-1] * 4 + codes[2:] if len(codes) > 2 else codes[:0]


def _open_frames(sequences: list[str]) -> list[list[dict]]:
    """Open frames of a batch: one pass over the joined sequences, then strided slices."""
    codes = _BASE_INDEX[np.frombuffer("".join(sequences).encode("ascii", "replace"), dtype=np.uint8)]
    # in the order T, C, A, G the complement swaps 0-2 and 1-3
    opposite = np.where(codes < 4, (codes + 2) % 4, codes)[::-1]
    strands = [(_RESIDUES[c], _BAD[c]) for c in (_codons(codes), _codons(opposite))]
    found = []
    start = 0
    for sequence in sequences:
        stop = start + len(sequence)
        frames = []
        # the reverse strand of the batch holds the sequences in reverse order
        spans = ((start, stop), (len(codes) - stop, len(codes) - start))
        for (residues, bad), (begin, end), first in zip(strands, spans, (0, 3)):
            for frame in range(3):
                window = slice(begin + frame, max(begin + frame, end - 2), 3)
                if not bad[window].any():
                    frames.append({"frame": first + frame, "peptide": residues[window].tobytes().decode()})
        found.append(frames)
        start = stop
    return found


@F.pandas_udf(_FRAMES)
def _frames(sequence: pd.Series) -> pd.Series:
    return pd.Series(_open_frames(sequence.fillna("").tolist()), index=sequence.index)


def translate_frames(
    reads: DataFrame, sequence: str = "sequence", skip_empty: bool = True
) -> DataFrame:
    """One row per open frame: ``frame`` 0-2 forward, 3-5 reverse, and its ``peptide``.

    Frames holding a stop or an untranslatable codon are left out.  Translation is
    a batched numpy lookup over whole sequences, the rest is JVM-side.
    """
    frames = reads.withColumn("_frame", F.explode(_frames(F.upper(F.col(sequence)))))
    out = frames.withColumns(
        {"frame": F.col("_frame.frame"), "peptide": F.col("_frame.peptide")}
    ).drop("_frame")
    return out.where(F.length("peptide") > 0) if skip_empty else out
