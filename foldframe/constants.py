"""Fixed values that must equal the reference's for results to agree.

Everything in this module is a plain statement of a published convention
(PDB residue names, one-letter codes) or a default parameter of the
original tool. Nothing here is logic.
"""

# --- fixed values: three-letter residue name -> one-letter code -------------
# The 20 standard amino acids, in alphabetical order of the three-letter name.
RESIDUE_LETTERS = {
    "ALA": "A", "ARG": "R", "ASN": "N", "ASP": "D", "CYS": "C",
    "GLN": "Q", "GLU": "E", "GLY": "G", "HIS": "H", "ILE": "I",
    "LEU": "L", "LYS": "K", "MET": "M", "PHE": "F", "PRO": "P",
    "SER": "S", "THR": "T", "TRP": "W", "TYR": "Y", "VAL": "V",
}
# Extra entries per reader: the CA-trace reader maps UNK to X (and any other
# unknown name to X); the atom reader maps the padding residue PAD to X.
UNKNOWN_LETTER = "X"
CA_READER_EXTRA = {"UNK": "X"}
ATOM_READER_EXTRA = {"PAD": "X"}

# --- fixed values: integer residue codes ------------------------------------
# Letters in this order get codes 0..19; B J O U X Z get 20; '-' and '.' get 21.
RESIDUE_CODE_ORDER = "ARNDCQEGHILKMFPSTWYV"
RESIDUE_CODE_RARE = "BJOUXZ"
RESIDUE_CODE_GAP = "-."

# --- fixed values: non-standard residues read as their standard form --------
SPECIAL_RESIDUES = {
    "MSE": "MET",
    "SEC": "CYS",
    "CSD": "CYS",
    "PCA": "GLU",
    "PYL": "LYS",
}
# Residue names that are never read.
EXCLUDED_RESIDUES = ["ASX", "GLX", "UNK"]
# Atom names kept by the structure reader (backbone).
BACKBONE_ATOMS = ["C", "N", "CA", "O"]

# --- fixed values: default parameters of the original tool ------------------
SEARCH_TOPK = 1
SEARCH_MINCOS = 0.5
SEARCH_MINTM = 0.5
SEARCH_MINCOV = 0.7
MIN_DOMAIN_SIZE = 50
MIN_FRAGMENT_SIZE = 10
AVERAGE_DOMAIN_SIZE = 200
RESEGMENT_ITERATIONS = 3
RESEGMENT_MIN_CHAIN = 400
CONTACT_DISTANCE = 8.0
HBOND_DISTANCE = 3.5
HBOND_MIN_SEPARATION = 3
EMBEDDING_WIDTH = 128
MAX_TARGET_RESIDUES = 2000
BATCH_STAGE_SIZE = 500
COMPACT_TARGET_MB = 128
EMPTY_METADATA = "{ }"
FRAME_EPS = 1e-8

# Output field names accepted by the hit writer, in the default order, and the
# header name written for each option.
HIT_FIELDS = [
    "query", "chopping", "conf", "plddt", "emb_rank", "target", "emb_score",
    "q_len", "t_len", "ali_len", "seq_id", "q_tm", "t_tm", "max_tm", "rmsd",
    "metadata",
]
HIT_HEADER_NAMES = {
    "query": "query", "target": "target", "chopping": "dom_str",
    "conf": "dom_conf", "plddt": "dom_plddt", "emb_rank": "emb_rank",
    "emb_score": "emb_score", "q_len": "q_len", "t_len": "t_len",
    "ali_len": "ali_len", "seq_id": "seq_id", "q_tm": "q_tm", "t_tm": "t_tm",
    "max_tm": "max_tm", "rmsd": "rmsd", "metadata": "metadata",
}
SEGMENT_HEADER = ["filename", "nres", "nres_dom", "nres_ndr", "ndom", "pIoU", "runtime", "result"]
CHAIN_MATCH_HEADER = ["query_chain", "nqd", "hit_chain", "nhd", "match_category", "match_info", "hit_metadata"]
