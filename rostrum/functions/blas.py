"""Pin an already-loaded OpenBLAS to one thread (numpy's bundled build)."""

from __future__ import annotations

import ctypes
import glob
import os

_DONE = False


def single_thread() -> None:
    global _DONE
    if _DONE:
        return
    _DONE = True
    try:
        import numpy as np

        libdir = os.path.join(os.path.dirname(os.path.dirname(np.__file__)), "numpy.libs")
        for path in glob.glob(os.path.join(libdir, "*openblas*")):
            lib = ctypes.CDLL(path)
            for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
                fn = getattr(lib, name, None)
                if fn is not None:
                    fn(ctypes.c_int(1))
                    break
    except Exception:  # no OpenBLAS, other BLAS: environment variables apply
        pass
