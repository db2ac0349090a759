"""Fixed values.

Everything in this module is a published constant or a value that must
equal the source pipeline's for results to agree.  Values are listed
plainly, in natural order, and are not derived from anything else.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: Eisenberg consensus hydrophobicity, keyed by three-letter
# residue name.  Residues not in this table weigh 0.
# ---------------------------------------------------------------------------
EISENBERG = {
    "ALA": 0.62, "ARG": -2.53, "ASN": -0.78, "ASP": -0.90, "CYS": 0.29,
    "GLN": -0.85, "GLU": -0.74, "GLY": 0.48, "HIS": -0.40, "ILE": 1.38,
    "LEU": 1.06, "LYS": -1.50, "MET": 0.64, "PHE": 1.19, "PRO": 0.12,
    "SER": -0.05, "THR": 0.05, "TRP": 0.81, "TYR": 0.26, "VAL": 1.08,
}

# FIXED VALUES: residue charge classes used by the structure scorer
# (histidine counts as neutral).
POSITIVE_RESIDUES = ("ARG", "LYS")
NEGATIVE_RESIDUES = ("ASP", "GLU")

# FIXED VALUES: Kyte-Doolittle hydropathy, keyed by one-letter code.
KYTE_DOOLITTLE = {
    "A": 1.8, "R": -4.5, "N": -3.5, "D": -3.5, "C": 2.5, "Q": -3.5,
    "E": -3.5, "G": -0.4, "H": -3.2, "I": 4.5, "L": 3.8, "K": -3.9,
    "M": 1.9, "F": 2.8, "P": -1.6, "S": -0.8, "T": -0.7, "W": -0.9,
    "Y": -1.3, "V": 4.2,
}

# FIXED VALUES: pKa sets (public textbook tables).  Keys: N-terminus,
# C-terminus and the ionisable side chains.
PKA_LEHNINGER = {
    "Nterm": 9.69, "Cterm": 2.34, "C": 8.33, "D": 3.86, "E": 4.25,
    "H": 6.0, "K": 10.5, "R": 12.4, "Y": 10.0,
}
PKA_EMBOSS = {
    "Nterm": 8.6, "Cterm": 3.6, "C": 8.5, "D": 3.9, "E": 4.1,
    "H": 6.5, "K": 10.8, "R": 12.5, "Y": 10.1,
}
POSITIVE_SIDE_CHAINS = ("H", "K", "R")
NEGATIVE_SIDE_CHAINS = ("C", "D", "E", "Y")

# FIXED VALUES: the twenty standard residues, one-letter codes in the
# conventional order, and their three-letter names in the same order.
AMINO_ACIDS = "ARNDCQEGHILKMFPSTWYV"
THREE_LETTER = (
    "ALA", "ARG", "ASN", "ASP", "CYS", "GLN", "GLU", "GLY", "HIS", "ILE",
    "LEU", "LYS", "MET", "PHE", "PRO", "SER", "THR", "TRP", "TYR", "VAL",
)

# FIXED VALUES: scoring defaults and report labels.
DEFAULT_ANIONIC_FRACTION = 0.25
DEFAULT_HYDROPHOBIC_MOMENT_WEIGHT = 5.0
DEFAULT_CYCLICITY_THRESHOLD = 4.5
CYCLIC_PENALTY_WEIGHT = 2.0
DEFAULT_TARGET_ORGANISM = "E_coli"
WINNER_FRACTION = 0.2
DEFAULT_TOP_N = 10
CONVERGENCE_DELTA = 0.1
FASTA_HEADER = ">A|protein"
TRAINING_PROMPT = "<|endoftext|>"
FORCEFIELD_LABEL = "AMBER14 + GBn2 implicit solvent"
AGREEMENT_LABELS = (
    (0.5, "Strong agreement — proxy scores reflect physical stability"),
    (0.3, "Moderate agreement — proxy scores partially validated"),
    (0.0, "Weak positive trend — limited proxy validation"),
)
NO_AGREEMENT_LABEL = "No agreement — proxy and physics rankings diverge"
INSUFFICIENT_LABEL = "Insufficient data"
MIN_CORRELATION_ROWS = 3
