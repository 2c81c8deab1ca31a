"""Queries of this subpackage and the SQL that gives the same rows, for the entry file."""

from . import mixing, suffixes, topk, warc
from .mixing import op3_mixing
from .packing import op9_packing
from .pii import op6_pii
from .quality import op5_quality
from .simhash import op7_simhash
from .streamvbyte import op2_token_files
from .suffixes import op10_suffixes
from .tokencount import op8_token_counts
from .topk import op1_topk
from .warc import op4_warc

QUERIES = {
    "op1_topk": op1_topk,
    "op2_token_files": op2_token_files,
    "op3_mixing": op3_mixing,
    "op4_warc": op4_warc,
    "op5_quality": op5_quality,
    "op6_pii": op6_pii,
    "op7_simhash": op7_simhash,
    "op8_token_counts": op8_token_counts,
    "op9_packing": op9_packing,
    "op10_suffixes": op10_suffixes,
}

ORACLES: dict[str, str] = {"op1_topk": topk.ORACLE, "op3_mixing": mixing.ORACLE, "op4_warc": warc.ORACLE, "op10_suffixes": suffixes.ORACLE}
