"""rostrum: speech-corpus analytics as Spark jobs."""

import os as _os

# One BLAS thread per process: Spark runs one task per core already, and a
# multi-threaded OpenBLAS can deadlock next to the JVM gateway.  The variables
# only take effect if numpy is not loaded yet; blas.single_thread() covers the
# case where it is.
for _k in ("OPENBLAS_NUM_THREADS", "OMP_NUM_THREADS", "MKL_NUM_THREADS"):
    _os.environ.setdefault(_k, "1")
