"""strandline: RNA-seq data operators as Spark DataFrame jobs.

Sub-packages
------------
sources    readers for sequence, annotation, alignment and report tables; sinks
functions  column expressions (CIGAR blocks, sequences, qualities) and numeric kernels
operators  the operators themselves (counting, strand, QC, coverage, DE, ...)
plans      the registered end-to-end queries and their SQL oracles
"""

from strandline.session import get_session, configure, ensure_checkpoint_dir  # noqa: F401
