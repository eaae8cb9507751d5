"""Column-level helpers: all return ``pyspark.sql.Column`` built from built-in functions."""
from .hashing import portable_hash, uniform, row_key
from .scalar import (clip, safe_div, encode_label, decode_label, gap_status, prefer, qcol,
                     LABEL_CODES)

__all__ = ["portable_hash", "uniform", "row_key", "clip", "safe_div", "encode_label",
           "decode_label", "gap_status", "prefer", "qcol", "LABEL_CODES"]
